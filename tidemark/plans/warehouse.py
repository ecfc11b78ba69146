"""Star schema: dimensions, fact and species bridge."""

from __future__ import annotations

import uuid
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.geo import DEFAULT_PRECISION, Extent
from tidemark.functions.keys import number_part, surrogate_key
from tidemark.functions.values import blank_to_null, decade, first_nonblank, first_number, norm_number
from tidemark.operators.columns import quoted
from tidemark.plans.fuse import lookup_cells
from tidemark.schemas import RANKS, WAVE_COLUMNS
from tidemark.session import drop_path, materialize, path_exists, scratch_dir

SAMPLING_COLUMNS = ["sampling_method", "concentration_class_range", "concentration_class_text"]
LOCATION_COLUMNS = ["latitude", "longitude", "ocean", "marine_setting"]
DATE_COLUMNS = ["full_date", "year", "month", "day", "quarter", "decade"]
SPECIES_RANKS = ["kingdom", "phylum", "class", "order_name", "family", "genus"]
SPECIES_COLUMNS = ["scientific_name", *SPECIES_RANKS]

# Table names, surrogate keys and foreign keys of the star schema.
PRIMARY_KEYS = {
    "dim_sampling_method": "sampling_method_id",
    "dim_climate": "climate_id",
    "dim_location": "location_id",
    "dim_date": "date_id",
    "dim_species": "species_id",
    "species_communities": "community_id",
}
DATE_FK = "dim_date_date_id"
CLIMATE_FK = "dim_climate_climate_id"
LOCATION_FK = "dim_location_location_id"
SAMPLING_FK = "dim_sampling_method_sampling_method_id"
SPECIES_FK = "dim_species_species_id"
FACT_FK = "fact_microplastics_observation_id"
FACT, BRIDGE = "fact_microplastics", "microplastics_species_bridge"
COMMUNITIES = "species_communities"
# Ending of the tables that list the members each load refers to.
REFERENCES = "_references"
FACT_COLUMNS = ["observation_id", "measurement", "unit", DATE_FK, CLIMATE_FK, LOCATION_FK, SAMPLING_FK]
BRIDGE_COLUMNS = [FACT_FK, DATE_FK, SPECIES_FK]

# The written tables; every one is partitioned by ``load_id``, the fact also by year.
_DOUBLES = ", ".join(f"{c} double" for c in WAVE_COLUMNS)
TABLE_DDL = {
    "dim_date": "date_id string, full_date date, year int, month int, day int, quarter int, decade int",
    "dim_location": "location_id string, latitude double, longitude double, ocean string, marine_setting string",
    "dim_climate": f"climate_id string, {_DOUBLES}",
    "dim_sampling_method": "sampling_method_id string, sampling_method string, "
                           "concentration_class_range string, concentration_class_text string",
    "dim_species": "species_id string, scientific_name string, kingdom string, phylum string, class string, "
                   "order_name string, family string, genus string",
    FACT: "observation_id string, measurement double, unit string, dim_date_date_id string, "
          "dim_climate_climate_id string, dim_location_location_id string, "
          "dim_sampling_method_sampling_method_id string, community_id string, obs_year int",
    BRIDGE: "fact_microplastics_observation_id string, dim_date_date_id string, dim_species_species_id string",
    COMMUNITIES: "community_id string, species_ids array<string>",
}

# Fixed value: the shortest name taken.
MIN_NAME_LENGTH = 2


def _first_text(df: DataFrame, *names: str) -> Column:
    present = [quoted(n) for n in names if n in df.columns]
    return first_nonblank(*present) if present else F.lit(None).cast("string")


def _first_number(df: DataFrame, *names: str) -> Column:
    present = [quoted(n) for n in names if n in df.columns]
    return first_number(*present) if present else F.lit(None).cast("double")


def _any_present(columns: list[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.col(c).isNotNull() for c in columns])


def location_key() -> Column:
    return surrogate_key(F.col("ocean"), F.col("marine_setting"), numbers=[number_part("latitude"), number_part("longitude")])


def climate_key() -> Column:
    return surrogate_key(numbers=[number_part(c) for c in WAVE_COLUMNS])


def sampling_key() -> Column:
    return surrogate_key(*[F.col(c) for c in SAMPLING_COLUMNS])


def date_key() -> Column:
    return surrogate_key(F.col("full_date").cast("string"))


def species_key() -> Column:
    return surrogate_key(F.col("scientific_name"), F.col("genus"))


def _species_columns(df: DataFrame) -> list[Column]:
    return [
        _first_text(df, "scientific_name", "scientific_name_species").alias("scientific_name"),
        *[_first_text(df, r, f"{r}_species").alias(n) for r, n in zip(RANKS, SPECIES_RANKS, strict=True)],
    ]


def _with_members(named: DataFrame, explode_species: bool) -> DataFrame:
    """Rows of names and ranks with their species, and an id of these: a hash of the species' keys.

    Without ``explode_species`` the whole text is one species, whose key then is the id.
    """
    if explode_species:
        each = F.transform(F.split("scientific_name", r"\|"), lambda n: blank_to_null(n))
        wanted = F.array_distinct(F.filter(each, lambda n: F.length(n) >= MIN_NAME_LENGTH))
        single = lambda n: surrogate_key(n, F.col("genus"))
        members = F.transform(wanted, lambda n: F.struct(single(n).alias("species_id"), n.alias("scientific_name")))
        ids = F.array_sort(F.transform("species", lambda s: s["species_id"]))
        community = F.when(F.size("species") > 0, F.md5(F.array_join(ids, ",")))
    else:
        long_enough = F.length("scientific_name") >= MIN_NAME_LENGTH
        members = F.when(long_enough, F.array(F.struct(species_key().alias("species_id"), F.col("scientific_name"))))
        community = F.get("species", F.lit(0))["species_id"]
    return named.withColumn("species", members).withColumn("community_id", community)


def cell_members(communities: DataFrame, explode_species: bool = False) -> DataFrame:
    """The dictionary of communities: for each cell its ranks, its species and their id."""
    named = communities.select("grid_id", "grid_lat", "grid_lon", *_species_columns(communities))
    return _with_members(named, explode_species)


def normalized(fused: DataFrame, order_by: str = "objectid", named: bool = True) -> DataFrame:
    """Normalised attributes of the rows, with their names and ranks or, where these are known by cell, with the cell."""
    return fused.select(
        F.col(order_by).alias("_order") if order_by in fused.columns else F.lit(None).cast("bigint").alias("_order"),
        F.col("date").cast("date").alias("full_date"),
        norm_number(_first_number(fused, "latitude", "latitude_micro")).alias("latitude"),
        norm_number(_first_number(fused, "longitude", "longitude_micro")).alias("longitude"),
        _first_text(fused, "ocean", "ocean_micro").alias("ocean"),
        _first_text(fused, "marine_setting", "marine_setting_micro").alias("marine_setting"),
        *[norm_number(_first_number(fused, c, f"{c}_climate")).alias(c) for c in WAVE_COLUMNS],
        *[_first_text(fused, c).alias(c) for c in SAMPLING_COLUMNS],
        _first_number(fused, "microplastics_measurement").alias("measurement"),
        _first_text(fused, "unit").alias("unit"),
        *(_species_columns(fused) if named else ["grid_id"]),
        F.monotonically_increasing_id().alias("_row"),
    )


def reference_keys(null_keys: str = "equal") -> dict[str, Column]:
    """The keys of the members that a normalised row refers to; null without a value to refer to."""
    def member(key: Column, parts: list[str]) -> Column:
        if null_keys == "equal":
            return key
        missing = F.lit(False)
        for p in parts:
            missing = missing | F.col(p).isNull()
        return F.when(missing, surrogate_key(key, F.col("_row").cast("string"))).otherwise(key)

    located = F.col("latitude").isNotNull() & F.col("longitude").isNotNull()
    return {
        "date_id": F.when(F.col("full_date").isNotNull(), date_key()),
        "location_id": F.when(located, member(location_key(), LOCATION_COLUMNS)),
        "climate_id": F.when(_any_present(WAVE_COLUMNS), member(climate_key(), WAVE_COLUMNS)),
        "sampling_method_id": F.when(_any_present(SAMPLING_COLUMNS), member(sampling_key(), SAMPLING_COLUMNS)),
    }


def with_keys(
    fused: DataFrame, order_by: str = "objectid", null_keys: str = "equal", explode_species: bool = False,
    communities: DataFrame | None = None, extent: Extent | None = None, precision: float = DEFAULT_PRECISION,
) -> DataFrame:
    """Normalised attributes, and the key of every dimension member a row refers to.

    Because keys are hashes of the normalised values, no members are looked up for them.
    ``null_keys="equal"`` treats null attributes as equal; ``"distinct"`` makes a
    row with a null attribute a member of its own, as a database unique key would. Such a
    member is only stable once these rows are written.
    ``explode_species`` refers each row to the single species of its cell instead of
    the whole community.

    With ``communities`` (one row per cell, as :func:`community_by_cell` returns them) rows get the id
    of their cell's community, and no row's names are read or hashed; without, the names must be in ``fused``.
    The cells are broadcast when ``extent`` bounds them.
    """
    keyed = normalized(fused, order_by, named=communities is None).withColumns(reference_keys(null_keys))
    if communities is None:
        return _with_members(keyed, explode_species)
    ids = cell_members(communities, explode_species).select("grid_id", "grid_lat", "grid_lon", "community_id")
    return lookup_cells(keyed, ids, extent, precision).drop("grid_lat", "grid_lon")


# ---------------------------------------------------------------- dimensions

def _members(keyed: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """One row per key. The key stands for the columns, so any row of a group will do."""
    return keyed.where(F.col(key).isNotNull()).select(key, *columns).distinct()


def dim_date(keyed: DataFrame) -> DataFrame:
    days = keyed.where("date_id IS NOT NULL").select("date_id", "full_date").distinct()
    year = F.year("full_date")
    return days.select(
        "date_id", "full_date", year.alias("year"), F.month("full_date").alias("month"),
        F.dayofmonth("full_date").alias("day"), F.quarter("full_date").alias("quarter"), decade(year).alias("decade"),
    )


def dim_location(keyed: DataFrame) -> DataFrame:
    return _members(keyed, "location_id", LOCATION_COLUMNS)


def dim_climate(keyed: DataFrame) -> DataFrame:
    return _members(keyed, "climate_id", WAVE_COLUMNS)


def dim_sampling_method(keyed: DataFrame) -> DataFrame:
    return _members(keyed, "sampling_method_id", SAMPLING_COLUMNS)


def dim_species(keyed: DataFrame, cells: DataFrame | None = None) -> DataFrame:
    """Entries of measured rows; the other ranks come from the first row that names the entry.

    With ``cells`` (from :func:`cell_members`) rows are reduced to the first of each cell and no
    name is grouped at their grain. Without, they are first reduced to distinct entries.
    """
    measured = keyed.where("measurement IS NOT NULL AND community_id IS NOT NULL")
    if cells is not None:
        first = measured.groupBy("grid_id").agg(F.min("_order").alias("_order"))
        measured = first.join(cells.select("grid_id", "species", *SPECIES_RANKS), "grid_id")
    entries = (
        measured.select("_order", *SPECIES_RANKS, F.explode("species").alias("_s"))
        .select("_order", "_s.species_id", "_s.scientific_name", *SPECIES_RANKS)
        .groupBy("species_id", *SPECIES_COLUMNS).agg(F.min("_order").alias("_first"))
    )
    chosen = F.min_by(F.struct(*SPECIES_COLUMNS), F.struct("_first", *SPECIES_COLUMNS))
    return entries.groupBy("species_id").agg(chosen.alias("_e")).select("species_id", "_e.*")


def species_communities(keyed: DataFrame, cells: DataFrame | None = None) -> DataFrame:
    """(community_id, species_ids) of the communities that measured rows refer to."""
    used = keyed.where("measurement IS NOT NULL AND community_id IS NOT NULL")
    if cells is not None:
        used = cells.join(used.select("community_id").distinct(), "community_id", "left_semi")
    ids = F.array_sort(F.transform("species", lambda s: s["species_id"]))
    return used.groupBy("community_id").agg(F.first(ids).alias("species_ids"))


DIMENSIONS = {
    "dim_date": dim_date,
    "dim_location": dim_location,
    "dim_climate": dim_climate,
    "dim_sampling_method": dim_sampling_method,
    "dim_species": dim_species,
}


def members_of(keyed: DataFrame, cells: DataFrame | None = None) -> dict[str, DataFrame]:
    """The members of every dimension, and the communities."""
    taking_cells = (dim_species, species_communities)
    builders = {**DIMENSIONS, COMMUNITIES: species_communities}
    return {name: build(keyed, cells) if build in taking_cells else build(keyed) for name, build in builders.items()}


def members_by_value(rows: DataFrame, cells: DataFrame, extent: Extent | None = None, precision: float = DEFAULT_PRECISION) -> dict[str, DataFrame]:
    """What :func:`members_of` returns, from normalised rows without keys, null attributes being equal.

    Rows are reduced to distinct values first, so that keys are worked out for members and not for rows, and each
    dimension reads its own columns only. Species are those of the cells that have a measured row.
    """
    keys = reference_keys()

    def members(key: str, columns: list[str]) -> DataFrame:
        return rows.select(*columns).distinct().select(keys[key].alias(key), *columns).where(F.col(key).isNotNull())

    first = rows.where("measurement IS NOT NULL").groupBy("grid_id").agg(F.min("_order").alias("_order"), F.max("measurement").alias("measurement"))
    used = lookup_cells(first, cells.select("grid_id", "grid_lat", "grid_lon", "community_id"), extent, precision)
    return {
        "dim_date": dim_date(members("date_id", ["full_date"])),
        "dim_location": members("location_id", LOCATION_COLUMNS),
        "dim_climate": members("climate_id", WAVE_COLUMNS),
        "dim_sampling_method": members("sampling_method_id", SAMPLING_COLUMNS),
        "dim_species": dim_species(used, cells),
        COMMUNITIES: species_communities(used, cells),
    }


def new_members(existing: DataFrame | None, built: DataFrame, key: str) -> DataFrame:
    """Members that are not there yet; existing ones keep what they hold."""
    return built if existing is None else built.join(existing.select(key), key, "left_anti")


def upsert_members(existing: DataFrame | None, built: DataFrame, key: str) -> DataFrame:
    return built if existing is None else existing.unionByName(new_members(existing, built, key))


# ---------------------------------------------------------------- fact and bridge

def fact_rows(keyed: DataFrame, load_id: str) -> DataFrame:
    """Measured rows with their keys, a row id, the year for pruning, and the id of their community.

    The row id is numbered within the load, without a shuffle. It is only stable once
    the rows are written, so the bridge is taken from the written fact.
    """
    return keyed.where("measurement IS NOT NULL").select(
        F.concat(F.lit(f"{load_id}-"), F.monotonically_increasing_id().cast("string")).alias("observation_id"),
        "measurement", "unit",
        F.col("date_id").alias(DATE_FK), F.col("climate_id").alias(CLIMATE_FK),
        F.col("location_id").alias(LOCATION_FK), F.col("sampling_method_id").alias(SAMPLING_FK),
        F.when(F.col("date_id").isNotNull(), F.col("community_id")).alias("community_id"), F.year("full_date").alias("obs_year"),
    )


def by_year(rows: DataFrame, year: str) -> DataFrame:
    """Rows of a year are brought together, for files of a fair size; large years are split."""
    return rows.hint("rebalance", year)


def bridge_rows(fact: DataFrame, communities: DataFrame) -> DataFrame:
    """Unique (fact, species) pairs with the date. Species keys are distinct within a community."""
    return fact.where("community_id IS NOT NULL").join(communities, "community_id").select(
        F.col("observation_id").alias(FACT_FK), DATE_FK, F.explode(F.array_distinct("species_ids")).alias(SPECIES_FK)
    )


@dataclass(frozen=True)
class Warehouse:
    """The seven tables, and the communities that facts refer to by a small id.

    Marts sum facts by community and look the species up afterwards, which spares the join of the two
    largest tables; the bridge table itself is there for SQL written against the star schema.
    """

    dim_date: DataFrame
    dim_location: DataFrame
    dim_climate: DataFrame
    dim_sampling_method: DataFrame
    dim_species: DataFrame
    fact: DataFrame
    bridge: DataFrame
    communities: DataFrame

    def tables(self) -> dict[str, DataFrame]:
        return {
            **{name: getattr(self, name) for name in DIMENSIONS},
            FACT: self.fact.select(*FACT_COLUMNS),
            BRIDGE: self.bridge.select(*BRIDGE_COLUMNS),
        }

    def register_views(self) -> None:
        """Temporary views under the star-schema names, for ``spark.sql``."""
        for name, df in self.tables().items():
            df.createOrReplaceTempView(name)


def build_warehouse(fused: DataFrame, load_id: str = "load", communities: DataFrame | None = None,
                    explode_species: bool = False, **options) -> Warehouse:
    """The tables as lazy frames (not written)."""
    keyed = with_keys(fused, communities=communities, explode_species=explode_species, **options)
    members = members_of(keyed, None if communities is None else cell_members(communities, explode_species))
    known = members.pop(COMMUNITIES)
    fact = fact_rows(keyed, load_id)
    return Warehouse(fact=fact, bridge=bridge_rows(fact, known), communities=known, **members)


def _read_table(spark: SparkSession, base: str, name: str) -> DataFrame:
    return spark.read.schema(f"{TABLE_DDL[name]}, load_id string").parquet(f"{base}/{name}")


def _read_references(spark: SparkSession, base: str, name: str) -> DataFrame:
    return spark.read.schema(f"{PRIMARY_KEYS[name]} string, load_id string").parquet(f"{base}/{name}{REFERENCES}")


def read_warehouse(spark: SparkSession, path: str) -> Warehouse:
    base = path.rstrip("/")
    read = {name: _read_table(spark, base, name).drop("load_id") for name in TABLE_DDL}
    return Warehouse(fact=read.pop(FACT), bridge=read.pop(BRIDGE), communities=read.pop(COMMUNITIES), **read)


def member_loads(spark: SparkSession, path: str, name: str) -> DataFrame:
    """Each member's key with the loads that refer to it. The tables of references hold whole members; only their keys are read."""
    references = _read_references(spark, path.rstrip("/"), name)
    return references.groupBy(PRIMARY_KEYS[name]).agg(F.array_sort(F.collect_set("load_id")).alias("loads"))


def _write_members(df: DataFrame, target: str) -> None:
    """Replace the loads that ``df`` has rows of, and no others."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("load_id").parquet(target)


def drop_unused_members(spark: SparkSession, path: str) -> None:
    """Remove the members that no load refers to any more. Only the loads that brought such members are rewritten."""
    base = path.rstrip("/")
    for name, key in PRIMARY_KEYS.items():
        stored = _read_table(spark, base, name)
        used = _read_references(spark, base, name).select(key).distinct()
        marked = stored.join(used.withColumn("_used", F.lit(True)), key, "left")
        counts = marked.groupBy("load_id").agg(F.count("_used").alias("used"), F.count("*").alias("n")).where("used < n").collect()
        if not counts:  # at most one row for each load
            continue
        kept = stored.where(F.col("load_id").isin([r["load_id"] for r in counts])).join(used, key, "left_semi")
        _write_members(kept, f"{base}/{name}")
        for row in counts:
            if not row["used"]:
                drop_path(spark, f"{base}/{name}/load_id={row['load_id']}")


def load_warehouse(
    fused: DataFrame, path: str, load_id: str | None = None, append: bool = True,
    communities: DataFrame | None = None, explode_species: bool = False, order_by: str = "objectid", null_keys: str = "equal",
    extent: Extent | None = None, precision: float = DEFAULT_PRECISION,
) -> Warehouse:
    """Write a load into the warehouse at ``path`` and return the tables.

    Every table is partitioned by load. Dimensions receive only members they lack; facts
    of a further load are added without comparing them to earlier ones. Repeating a load
    under its own id replaces what it wrote, so a load that broke off is simply run again; the members it
    refers to are kept beside each dimension, so that a repeated load removes only members that no load uses.
    With ``append=False`` all earlier loads are dropped. One load runs at a time.

    With ``communities`` and equal null attributes, members are the distinct values of the rows, and rows get their keys as
    they are written, after they were dealt out by year. Else rows with their names and keys are written once, into a
    table of their own that is deleted at the end.
    ``fused`` and ``communities`` should be written tables.
    """
    spark = fused.sparkSession
    base = path.rstrip("/")
    load_id = load_id or uuid.uuid4().hex[:12]
    part = f"load_id={load_id}"
    if not append:
        for name in TABLE_DDL:
            drop_path(spark, f"{base}/{name}")
            drop_path(spark, f"{base}/{name}{REFERENCES}")
    repeated = path_exists(spark, f"{base}/{FACT}/{part}")
    scratch = scratch_dir(spark, "load")
    cells = None if communities is None else materialize(cell_members(communities, explode_species), f"{scratch}/cells")
    if cells is not None and null_keys == "equal":
        rows = normalized(fused, order_by, named=False)
        built = members_by_value(rows, cells, extent, precision)
        dealt = by_year(rows.where("measurement IS NOT NULL").drop("_order", "_row").withColumn("_year", F.year("full_date")), "_year")
        ids = cells.select("grid_id", "grid_lat", "grid_lon", "community_id")
        facts = fact_rows(lookup_cells(dealt.withColumns(reference_keys()), ids, extent, precision), load_id)
    else:
        keyed = materialize(with_keys(fused, order_by, null_keys, explode_species, communities, extent, precision), f"{scratch}/keyed")
        built = members_of(keyed, cells)
        facts = by_year(fact_rows(keyed, load_id), "obs_year")

    def write_dimension(name: str, built: DataFrame) -> None:
        key = PRIMARY_KEYS[name]
        members = materialize(built, f"{base}/{name}{REFERENCES}/{part}")
        existing = _read_table(spark, base, name) if path_exists(spark, f"{base}/{name}") else None
        fresh = new_members(existing, members, key).withColumn("load_id", F.lit(load_id))
        if repeated and existing is not None:  # what this load brought before stays, until it is known to be unused
            fresh = fresh.unionByName(existing.where(F.col("load_id") == load_id))
        _write_members(fresh, f"{base}/{name}")

    with ThreadPoolExecutor(len(built)) as pool:  # small tables that do not depend on each other
        list(pool.map(write_dimension, *zip(*built.items(), strict=True)))
    facts.write.mode("overwrite").partitionBy("obs_year").parquet(f"{base}/{FACT}/{part}")
    written = _read_table(spark, base, FACT).where(F.col("load_id") == load_id)
    known = _read_table(spark, base, COMMUNITIES).drop("load_id")
    bridge_rows(written, known).write.mode("overwrite").parquet(f"{base}/{BRIDGE}/{part}")
    if repeated:
        drop_unused_members(spark, base)
    drop_path(spark, scratch)
    return read_warehouse(spark, base)


# ---------------------------------------------------------------- checks and counts

def integrity_violations(wh: Warehouse) -> DataFrame:
    """Rows per foreign key that refer to no member; all must be zero.

    Keys are reduced to distinct values with their counts before the anti join; not those of facts, of which there are
    nearly as many as rows.
    """
    references = [
        (FACT, wh.fact, DATE_FK, wh.dim_date, "date_id"),
        (FACT, wh.fact, CLIMATE_FK, wh.dim_climate, "climate_id"),
        (FACT, wh.fact, LOCATION_FK, wh.dim_location, "location_id"),
        (FACT, wh.fact, SAMPLING_FK, wh.dim_sampling_method, "sampling_method_id"),
        (BRIDGE, wh.bridge, FACT_FK, wh.fact, "observation_id"),
        (BRIDGE, wh.bridge, DATE_FK, wh.dim_date, "date_id"),
        (BRIDGE, wh.bridge, SPECIES_FK, wh.dim_species, "species_id"),
    ]
    checks = []
    for table, rows, fk, parent, pk in references:
        used = rows.where(F.col(fk).isNotNull()).select(F.col(fk).alias(pk), F.lit(1).cast("bigint").alias("n"))
        if fk != FACT_FK:
            used = used.groupBy(pk).agg(F.sum("n").alias("n"))
        orphans = used.join(parent.select(pk), pk, "left_anti")
        checks.append(orphans.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("violations")).select(
            F.lit(table).alias("table_name"), F.lit(fk).alias("foreign_key"), "violations"))
    result = checks[0]
    for check in checks[1:]:
        result = result.unionByName(check)
    return result


def load_stats(fused: DataFrame, order_by: str = "objectid", **options) -> DataFrame:
    """Rows inserted, skipped as unmeasured, and linked to species."""
    keyed = with_keys(fused, order_by, **options)
    measured = F.col("measurement").isNotNull()
    linked = measured & F.col("date_id").isNotNull() & F.col("community_id").isNotNull()
    return keyed.agg(
        F.count_if(measured).alias("inserted"), F.count_if(~measured).alias("skipped"),
        F.count_if(linked).alias("with_species"),
    )


def table_counts(wh: Warehouse) -> DataFrame:
    counts = [df.agg(F.count("*").alias("n_rows")).select(F.lit(n).alias("table_name"), "n_rows")
              for n, df in wh.tables().items()]
    result = counts[0]
    for c in counts[1:]:
        result = result.unionByName(c)
    return result
