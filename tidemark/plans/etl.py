"""The end-to-end run: extract, check, transform, check, load."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from tidemark.functions.geo import DEFAULT_MAX_KM, DEFAULT_PRECISION, NORTH_AMERICA, Extent
from tidemark.operators.clean import clean_climate, clean_observations, clean_occurrences
from tidemark.operators.climate import monthly_climate
from tidemark.operators.columns import missing_columns, project_fields, rename_observations, rename_occurrences
from tidemark.operators.grid import assign_to_nearest_cell, grid_catalog, snap_to_grid
from tidemark.operators.quality import CRITICAL_COLUMNS, overall, run_suites
from tidemark.operators.taxonomy import NAMES_PER_CELL, community_by_cell
from tidemark.plans.fuse import fuse
from tidemark.plans.warehouse import Warehouse, load_warehouse
from tidemark.schemas import CLIMATE_FIELDS, OBSERVATION_FIELDS, OCCURRENCE_FIELDS
from tidemark.sinks.files import write_quality_report, write_stage_tables
from tidemark.sources.files import cached_extract


@dataclass(frozen=True)
class Transformed:
    """Clean tables, cell catalogue, the cells' communities and the fused table, all lazy."""

    observations: DataFrame
    occurrences: DataFrame
    climate: DataFrame
    catalog: DataFrame
    communities: DataFrame
    fused: DataFrame


def _with_order(df: DataFrame, order: str | None, fields: list[tuple[str, str]]) -> list[tuple[str, str]]:
    """The canonical fields plus the column that tells the encounter order."""
    known = {n for n, _ in fields}
    if order is None or order in known or order not in df.columns:
        return fields
    return [*fields, (order, df.schema[order].dataType.simpleString())]


def clean_cells(observations: DataFrame, precision: float = DEFAULT_PRECISION, extent: Extent = NORTH_AMERICA) -> DataFrame:
    """The clean observations with their cells, in the canonical fields."""
    return project_fields(snap_to_grid(clean_observations(observations, extent), precision=precision), OBSERVATION_FIELDS)


def transform(
    observations: DataFrame, occurrences: DataFrame, climate: DataFrame, *, occurrence_order: str = "event_date",
    climate_order: str = "date", precision: float = DEFAULT_PRECISION, max_km: float = DEFAULT_MAX_KM,
    extent: Extent = NORTH_AMERICA, catalog: DataFrame | None = None, names_per_cell: int = NAMES_PER_CELL,
) -> Transformed:
    """Clean the sources, snap and assign cells, aggregate, and fuse.

    ``names_per_cell``: how many species names a cell's community lists.

    A catalogue written by an earlier step spares deriving it again for each source.
    The cleaners keep only ``extent``, which bounds the cells and so every table that
    is joined to the observations; those pass through without a shuffle.
    """
    obs = clean_cells(observations, precision, extent)
    catalog = grid_catalog(obs) if catalog is None else catalog
    near = {"max_km": max_km, "precision": precision, "extent": extent}
    occ = assign_to_nearest_cell(clean_occurrences(occurrences, extent), catalog, **near)
    cli = assign_to_nearest_cell(clean_climate(climate, extent), catalog, **near)
    occ = project_fields(occ, _with_order(occ, occurrence_order, OCCURRENCE_FIELDS))
    cli = project_fields(cli, _with_order(cli, climate_order, CLIMATE_FIELDS))
    communities = community_by_cell(occ, occurrence_order, names_per_cell)
    fused = fuse(obs, monthly_climate(cli, climate_order), communities, extent, precision)
    return Transformed(obs, occ, cli, catalog, communities, fused)


def first_pass_catalog(observations: DataFrame, precision: float = DEFAULT_PRECISION, extent: Extent = NORTH_AMERICA) -> DataFrame:
    """The cell catalogue alone; it depends on nothing but the observations."""
    return grid_catalog(snap_to_grid(clean_observations(observations, extent), precision=precision))


@dataclass
class RunConfig:
    """Where a run reads from and writes to, and how strict its checks are.

    ``extract_climate`` receives the cell catalogue and returns the readings.
    ``gate="warn"`` loads whatever the checks say; ``"fail"`` stops on a failed rule.
    """

    work_dir: str
    extract_observations: Callable[[], DataFrame]
    extract_occurrences: Callable[[], DataFrame]
    extract_climate: Callable[[DataFrame], DataFrame]
    current_year: int
    gate: str = "warn"
    load_id: str | None = None
    append: bool = True
    transform_options: dict = field(default_factory=dict)
    load_options: dict = field(default_factory=dict)


@dataclass(frozen=True)
class RunResult:
    paths: dict[str, str]
    reports: dict[str, dict[str, str]]
    missing: list[str]
    warehouse: Warehouse


def gate(report: DataFrame, mode: str, stage: str) -> None:
    failed = [r for r in overall(report).collect() if r["passed"] < r["total"]]  # at most one row per dataset
    for row in failed:
        print(f"{row['dataset']} [{stage}]: {row['passed']} of {row['total']} rules passed")
    if failed and mode == "fail":
        raise ValueError(f"quality gate failed at stage {stage}")


def run(spark: SparkSession, cfg: RunConfig) -> RunResult:
    """Run all steps in order. Every step ends in written tables and the next one starts from them."""
    base = cfg.work_dir.rstrip("/")
    options = cfg.transform_options
    extent, precision = options.get("extent", NORTH_AMERICA), options.get("precision", DEFAULT_PRECISION)
    with ThreadPoolExecutor(1) as pool:  # occurrences wait for nothing
        landed = pool.submit(cached_extract, spark, f"{base}/raw/occurrences", cfg.extract_occurrences)
        observations = cached_extract(spark, f"{base}/raw/observations", cfg.extract_observations)
        # Observations are cleaned once: the catalogue is that of the written table.
        paths = write_stage_tables({"observations": clean_cells(observations, precision, extent)}, f"{base}/clean")
        paths |= write_stage_tables({"catalog": grid_catalog(spark.read.parquet(paths["observations"]))}, f"{base}/clean")
        catalog = spark.read.parquet(paths["catalog"])
        climate = cached_extract(spark, f"{base}/raw/climate", lambda: cfg.extract_climate(catalog))
        occurrences = landed.result()

    named, named_occurrences = rename_observations(observations), rename_occurrences(occurrences)
    missing = missing_columns(named, CRITICAL_COLUMNS)
    if missing:
        print(f"observations lack {', '.join(missing)}")

    reports = {}

    def checked(stage: str, obs: DataFrame, cli: DataFrame, occ: DataFrame) -> None:
        reports[stage] = write_quality_report(run_suites(obs, cli, occ, cfg.current_year, stage), base, stage)
        written = spark.read.parquet(reports[stage]["rules"])
        gate(written, cfg.gate, stage)

    checked("pre", named, climate, named_occurrences)
    result = transform(observations, occurrences, climate, catalog=catalog, **options)
    paths |= write_stage_tables({"occurrences": result.occurrences, "climate": result.climate}, f"{base}/clean")
    # The fused table is aggregated from the clean tables just written, not from the sources again.
    read = {name: spark.read.parquet(path) for name, path in paths.items()}
    by_cell = community_by_cell(
        read["occurrences"], options.get("occurrence_order", "event_date"), options.get("names_per_cell", NAMES_PER_CELL))
    paths |= write_stage_tables({"communities": by_cell}, f"{base}/clean")
    communities = spark.read.parquet(paths["communities"])
    monthly = monthly_climate(read["climate"], options.get("climate_order", "date"))
    paths |= write_stage_tables({"fused": fuse(read["observations"], monthly, communities, extent, precision)}, f"{base}/clean")
    checked("post", read["observations"], read["climate"], read["occurrences"])
    warehouse = load_warehouse(
        spark.read.parquet(paths["fused"]), f"{base}/warehouse", cfg.load_id, cfg.append,
        communities=communities, extent=extent, precision=precision, **cfg.load_options)
    return RunResult(paths, reports, missing, warehouse)
