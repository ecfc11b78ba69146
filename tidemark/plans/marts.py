"""The analytic marts over the star schema.

Each mart first sums the fact per foreign key, species key included, and joins the
dimensions to these sums. So a location or date with very many facts is combined
before anything is shuffled, the joins see each key once, and counting species needs
no second copy of the rows. Dimensions are joined without hints: Spark broadcasts the
ones whose files are small.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.values import wave_band
from tidemark.plans.warehouse import (
    CLIMATE_FK, DATE_FK, LOCATION_COLUMNS, LOCATION_FK, SAMPLING_COLUMNS, SAMPLING_FK, SPECIES_RANKS, Warehouse,
)

TOP_ROWS = 100


NULL_SALTS = 64


def with_attributes(sums: DataFrame, members: DataFrame, key: str, spread_by: Sequence[str]) -> DataFrame:
    """Left join of unique members by ``key``.

    Rows without the key match nothing; they are dealt out by a hash of their other keys, so that they do not all
    meet in one task where the members are not broadcast.
    """
    salt = F.concat(F.lit("-"), F.pmod(F.xxhash64(*spread_by), F.lit(NULL_SALTS)).cast("string"))
    joined = sums.withColumn("_at", F.coalesce(F.col(key), salt)).join(members.withColumnRenamed(key, "_member"), F.col("_at") == F.col("_member"), "left")
    return joined.drop("_at", "_member")


def summed_facts(wh: Warehouse, fact: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Counts and moments per key combination and species.

    Facts are summed per key and community first; only then are the species of the communities looked
    up and unfolded. A community appears once under each of its species; the first of them carries
    the sums, so averages and counts are not inflated.
    """
    value = F.col("measurement")
    sums = fact.groupBy(*keys, "community_id").agg(
        F.count(value).alias("n"), F.sum(value).alias("s"), F.max(value).alias("mx"), F.min(value).alias("mn"),
        F.var_pop(value).alias("var"),
    )
    listed = with_attributes(sums, wh.communities, "community_id", keys)
    unfolded = listed.select(*keys, "n", "s", "mx", "mn", "var", F.posexplode_outer("species_ids").alias("_pos", "species_id"))
    first = F.coalesce(F.col("_pos"), F.lit(0)) == 0
    return unfolded.select(*keys, "species_id", *[F.when(first, F.col(c)).alias(c) for c in ("n", "s", "mx", "mn", "var")])


def n_observations() -> Column:
    return F.sum("n")


def mean_measurement() -> Column:
    return F.try_divide(F.sum("s"), F.sum("n"))


def with_deviation(sums: DataFrame, facts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Add the squared distance of each group's mean from the mean over ``keys``, once for each measurement.

    Taking the means first keeps digits that the difference of two large sums would lose. They come from ``facts``, counts ``n``
    and sums ``s`` with the keys' columns and nothing else, so that neither species nor climate is looked up for them. The
    means are as few as the result's rows.
    """
    means = facts.groupBy(*[F.col(k).alias(f"_{k}") for k in keys]).agg(mean_measurement().alias("_mean"))
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys])
    apart = F.try_divide(F.col("s"), F.col("n")) - F.col("_mean")
    return sums.join(means, same, "left").withColumn("dev", F.col("n") * apart * apart).drop("_mean", *[f"_{k}" for k in keys])


def _totals(fact: DataFrame, key: str) -> DataFrame:
    return fact.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("measurement").alias("n"), F.sum("measurement").alias("s"))


def std_measurement() -> Column:
    """Population standard deviation from the variances within the groups and the distances between them."""
    return F.sqrt(F.try_divide(F.coalesce(F.sum(F.col("n") * F.col("var")), F.lit(0.0)) + F.coalesce(F.sum("dev"), F.lit(0.0)), F.sum("n")))


def mean_wave(column: str) -> Column:
    """Mean of a climate value over observations, from the observation count of each climate row.

    Climate values are kept to six decimals, so the sum is taken in decimals: it is exact,
    and the mean does not depend on the order in which tasks are combined. Values that such a decimal cannot hold, which no
    ocean has, are summed as doubles.
    """
    value = F.col(column)
    fits = F.abs(value) < 1e12
    exact = F.sum(F.when(fits, value.cast("decimal(18,6)") * F.col("n"))).cast("double")
    others = F.sum(F.when(~fits, value * F.col("n")))
    total = F.when(others.isNull(), exact).otherwise(others + F.coalesce(exact, F.lit(0.0)))
    return F.try_divide(total, F.sum(F.when(value.isNotNull(), F.col("n"))))


def n_species() -> Column:
    return F.count_distinct("species_id")


def _with_climate(sums: DataFrame, wh: Warehouse, how: str = "left") -> DataFrame:
    climate = wh.dim_climate.withColumnRenamed("climate_id", CLIMATE_FK)
    if how == "inner":
        return sums.join(climate, CLIMATE_FK)
    return with_attributes(sums, climate, CLIMATE_FK, [c for c in sums.columns if c != CLIMATE_FK])


def _with_location(sums: DataFrame, wh: Warehouse) -> DataFrame:
    return sums.join(wh.dim_location.withColumnRenamed("location_id", LOCATION_FK), LOCATION_FK)


def _with_date(sums: DataFrame, wh: Warehouse) -> DataFrame:
    return sums.join(wh.dim_date.withColumnRenamed("date_id", DATE_FK), DATE_FK)


def kpi_summary(wh: Warehouse) -> DataFrame:
    """One row of totals.

    The distinct counts are over foreign keys, so no dimension is joined for them; the
    wave averages come from the observation count of each climate row.
    """
    facts = wh.fact.agg(
        F.count("*").alias("total_observaciones"),
        F.count_distinct(LOCATION_FK).alias("total_ubicaciones"),
        F.count_distinct(DATE_FK).alias("total_fechas"),
        F.count_distinct(CLIMATE_FK).alias("total_registros_clima"),
        F.avg("measurement").alias("avg_microplasticos"), F.max("measurement").alias("max_microplasticos"),
        F.min("measurement").alias("min_microplasticos"), F.stddev_pop("measurement").alias("std_microplasticos"),
    )
    named = wh.communities.join(wh.fact.select("community_id").distinct(), "community_id", "left_semi")
    species = named.select(F.explode("species_ids").alias("id")).agg(F.count_distinct("id").alias("total_especies"))
    waves = wh.fact.where(F.col(CLIMATE_FK).isNotNull()).groupBy(CLIMATE_FK).agg(F.count("*").alias("n"))
    waves = _with_climate(waves, wh, "inner").agg(
        mean_wave("wave_height_max").alias("avg_wave_height"), mean_wave("swell_wave_height_max").alias("avg_swell_height"),
    )
    parts = facts.unionByName(species, allowMissingColumns=True).unionByName(waves, allowMissingColumns=True)
    order = ["total_observaciones", "total_ubicaciones", "total_fechas", "total_especies", "total_registros_clima",
             "avg_microplasticos", "max_microplasticos", "min_microplasticos", "std_microplasticos",
             "avg_wave_height", "avg_swell_height"]
    return parts.agg(*[F.max(c).alias(c) for c in order])


def _location_groups(wh: Warehouse):
    sums = summed_facts(wh, wh.fact.where(F.col(LOCATION_FK).isNotNull()), [LOCATION_FK, CLIMATE_FK])
    placed = _with_location(_with_climate(sums, wh), wh).where("latitude IS NOT NULL AND longitude IS NOT NULL")
    return placed.groupBy(*LOCATION_COLUMNS)


def critical_zones(wh: Warehouse, limit: int | None = TOP_ROWS) -> DataFrame:
    """Locations above the mean of all facts, highest first; all of them without a limit."""
    overall = wh.fact.agg(F.avg("measurement").alias("overall")).scalar()
    zones = _location_groups(wh).agg(
        n_observations().alias("num_observaciones"), mean_measurement().alias("avg_microplasticos"),
        F.max("mx").alias("max_microplasticos"), n_species().alias("num_especies"),
        mean_wave("wave_height_max").alias("avg_wave_height"),
        mean_wave("swell_wave_height_max").alias("avg_swell_height"),
        mean_wave("wave_period_max").alias("avg_wave_period"),
    )
    ranked = zones.where(F.col("avg_microplasticos") > overall).orderBy(
        F.desc("avg_microplasticos"), "num_especies", *LOCATION_COLUMNS)
    return ranked if limit is None else ranked.limit(limit)


def temporal_trends(wh: Warehouse, first_year: int | None = None, last_year: int | None = None) -> DataFrame:
    """Aggregates by month, of a range of years if one is given. The range prunes fact partitions."""
    def within(column: str) -> Column:
        low = F.lit(True) if first_year is None else F.col(column) >= first_year
        return F.col(column).isNotNull() & low & (F.lit(True) if last_year is None else F.col(column) <= last_year)

    facts = wh.fact.where(within("obs_year"))
    dated = _with_date(_with_climate(summed_facts(wh, facts, [DATE_FK, CLIMATE_FK]), wh), wh)
    return dated.where(within("year")).groupBy("year", "month", "quarter", "decade").agg(
        n_observations().alias("num_observaciones"), mean_measurement().alias("avg_microplasticos"),
        n_species().alias("num_especies"), mean_wave("wave_height_max").alias("avg_wave_height"),
        mean_wave("swell_wave_height_max").alias("avg_swell_height"),
        mean_wave("wave_period_max").alias("avg_wave_period"),
        mean_wave("wave_direction_dominant").alias("avg_wave_direction"),
    ).orderBy("year", "month")


def ocean_comparison(wh: Warehouse) -> DataFrame:
    """Ocean and setting with spread, species and phylum counts."""
    sums = summed_facts(wh, wh.fact.where(F.col(LOCATION_FK).isNotNull()), [LOCATION_FK, CLIMATE_FK])
    placed = _with_location(_with_climate(sums, wh), wh).where("ocean IS NOT NULL")
    placed = placed.join(wh.dim_species.select("species_id", "phylum"), "species_id", "left")
    totals = _with_location(_totals(wh.fact, LOCATION_FK), wh).where("ocean IS NOT NULL")
    return with_deviation(placed, totals, ["ocean", "marine_setting"]).groupBy("ocean", "marine_setting").agg(
        n_observations().alias("num_observaciones"), mean_measurement().alias("avg_microplasticos"),
        std_measurement().alias("std_microplasticos"), n_species().alias("num_especies"),
        F.count_distinct("phylum").alias("num_phylums"), mean_wave("wave_height_max").alias("avg_wave_height"),
        mean_wave("swell_wave_height_max").alias("avg_swell_height"),
    ).orderBy(F.desc("avg_microplasticos"), "ocean", "marine_setting")


def biodiversity(wh: Warehouse, limit: int | None = TOP_ROWS) -> DataFrame:
    """Taxonomic groups by number of species; all of them without a limit, as roll-ups need.

    Here a measurement counts once under every species of the group it is linked to, as
    in a join of species to facts; observations of a group are counted once. Facts are
    summed per species list before the lists are unfolded and joined to the species.
    """
    ranks = SPECIES_RANKS[:-1]
    lists = wh.fact.where("community_id IS NOT NULL").groupBy("community_id", CLIMATE_FK).agg(
        F.count("*").alias("n"), F.sum("measurement").alias("s")).join(wh.communities, "community_id")
    known = wh.dim_species.where("kingdom IS NOT NULL").select("species_id", *ranks)
    linked = lists.withColumn("species_id", F.explode("species_ids")).join(known, "species_id")
    # What a list has in a group: its sums, and its species there, at most the length of the list.
    shares = linked.groupBy(*ranks, "community_id", CLIMATE_FK).agg(
        F.max("n").alias("n"), F.max("s").alias("s"), F.collect_set("species_id").alias("members"))
    shares = shares.select(*ranks, CLIMATE_FK, "s", F.col("n").alias("rows_once"), F.size("members").alias("k"),
                           F.posexplode("members").alias("_pos", "species_id"))
    first = F.col("_pos") == 0
    weighted = shares.select(
        *ranks, CLIMATE_FK, "species_id", F.when(first, F.col("rows_once")).alias("rows_once"),
        F.when(first, F.col("rows_once") * F.col("k")).alias("n"), F.when(first, F.col("s") * F.col("k")).alias("s"))
    groups = _with_climate(weighted, wh).groupBy(*ranks).agg(
        n_species().alias("num_especies"), F.sum("rows_once").alias("num_observaciones"),
        mean_measurement().alias("avg_microplasticos"), mean_wave("wave_height_max").alias("avg_wave_height"),
    ).orderBy(F.desc("num_especies"), *ranks)
    return groups if limit is None else groups.limit(limit)


def climate_correlation(wh: Warehouse, min_observations: int = 2) -> DataFrame:
    """Mean measurement per combination of wave values."""
    sums = summed_facts(wh, wh.fact.where(F.col(CLIMATE_FK).isNotNull()), [CLIMATE_FK])
    known = _with_climate(sums, wh, "inner").where("wave_height_max IS NOT NULL OR swell_wave_height_max IS NOT NULL")
    order = ["wave_height_max", "wave_period_max", "swell_wave_height_max", "wave_direction_dominant",
             "wind_wave_direction_dominant"]
    return known.groupBy(*order).agg(
        mean_measurement().alias("avg_microplasticos"), n_observations().alias("num_observaciones"),
        n_species().alias("num_especies"),
    ).where(F.col("num_observaciones") >= min_observations).orderBy(F.desc("avg_microplasticos"), *order)


def sampling_effectiveness(wh: Warehouse) -> DataFrame:
    sums = summed_facts(wh, wh.fact.where(F.col(SAMPLING_FK).isNotNull()), [SAMPLING_FK, CLIMATE_FK])
    methods = wh.dim_sampling_method.where("sampling_method IS NOT NULL").withColumnRenamed("sampling_method_id", SAMPLING_FK)
    totals = _totals(wh.fact, SAMPLING_FK).join(methods, SAMPLING_FK)
    return with_deviation(_with_climate(sums, wh).join(methods, SAMPLING_FK), totals, SAMPLING_COLUMNS).groupBy(*SAMPLING_COLUMNS).agg(
        n_observations().alias("num_observaciones"), mean_measurement().alias("avg_microplasticos"),
        F.min("mn").alias("min_microplasticos"), F.max("mx").alias("max_microplasticos"),
        std_measurement().alias("std_microplasticos"), n_species().alias("num_especies"),
        mean_wave("wave_height_max").alias("avg_wave_height"),
    ).orderBy(F.desc("num_observaciones"), *SAMPLING_COLUMNS)


def wave_band_impact(wh: Warehouse) -> DataFrame:
    sums = summed_facts(wh, wh.fact.where(F.col(CLIMATE_FK).isNotNull()), [CLIMATE_FK])
    known = _with_climate(sums, wh, "inner").where("wave_height_max IS NOT NULL")
    return known.groupBy(wave_band("wave_height_max").alias("oleaje_categoria")).agg(
        n_species().alias("num_especies"), mean_measurement().alias("avg_microplasticos"),
        n_observations().alias("num_observaciones"), mean_wave("wave_height_max").alias("avg_wave_height"),
        mean_wave("swell_wave_height_max").alias("avg_swell"),
    ).orderBy("avg_wave_height")


def hotspots(wh: Warehouse) -> DataFrame:
    return _location_groups(wh).agg(
        mean_measurement().alias("microplasticos"), n_species().alias("biodiversidad"),
        mean_wave("wave_height_max").alias("oleaje"), mean_wave("swell_wave_height_max").alias("swell"),
        n_observations().alias("observaciones"),
    ).where("microplasticos IS NOT NULL")


def decades(wh: Warehouse) -> DataFrame:
    facts = wh.fact.where(F.col(DATE_FK).isNotNull())
    dated = _with_date(_with_climate(summed_facts(wh, facts, [DATE_FK, CLIMATE_FK]), wh), wh)
    return dated.where("decade IS NOT NULL").groupBy("decade").agg(
        n_observations().alias("observaciones"), mean_measurement().alias("avg_microplasticos"),
        n_species().alias("especies"), mean_wave("wave_height_max").alias("avg_oleaje"),
    ).orderBy("decade")
