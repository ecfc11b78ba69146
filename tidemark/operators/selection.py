"""Values at given ranks, found in rounds of bin counts.

A round counts the values of a range in bins that follow their order, keeps the bin with the wanted rank, and goes on
within that bin's least and greatest value. Each round is one aggregate of a fixed number of bins, combined on the
map side, however many rows there are; nothing is sorted and no value is approximated. A bin with few different
values ends the search. The rows are read once for each round, so they should be a written table or an aggregate of few columns.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from decimal import Decimal
from math import inf, isinf, nan

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.columns import quoted

BINS = 1024
# A range with no more rows than this is counted by value.
FEW = 4096


@dataclass(frozen=True)
class Rank:
    """The value at a rank: tests for the rows before it and equal to it, and how many there are of each."""

    lower: Column
    equal: Column
    n_lower: int
    n_equal: int


def orderable(kind: T.DataType) -> bool:
    return isinstance(kind, (T.NumericType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType, T.StringType, T.BinaryType))


def _key(column: str, kind: T.DataType) -> Column:
    """A number, text or bytes in the same order as the column."""
    c = quoted(column)
    if isinstance(kind, T.BooleanType):
        return c.cast("int")
    if isinstance(kind, T.DateType):
        return F.unix_date(c)
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.unix_micros(c.cast("timestamp"))
    return c


def _text_bins(key: Column, low: bytes | str, high: bytes | str) -> Column:
    """Two bytes after those that the least and the greatest text share; a text that ends comes before all others."""
    a, b = (x.encode() if isinstance(x, str) else bytes(x) for x in (low, high))
    same = next((i for i, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), min(len(a), len(b)))
    raw = key.cast("binary")

    def byte(i: int) -> Column:
        value = F.conv(F.hex(F.substring(raw, i + 1, 1)), 16, 10).cast("int") + 1
        return F.when(F.octet_length(raw) > i, value).otherwise(0)

    return byte(same) * 257 + byte(same + 1)


def _share(key: Column, low: Column, high: Column) -> Column:
    """Where a number lies between two, from 0 to 1; ranges too wide for a double are halved."""
    k, a, b = (x.cast("double") for x in (key, low, high))
    return F.when(b - a == inf, (k / 2 - a / 2) / (b / 2 - a / 2)).otherwise((k - a) / (b - a))


def _spread_share(key: Column, low: Column, high: Column) -> Column:
    """The same by orders of magnitude, for values that crowd at one end of their range. No double is below e**-750 of another."""
    most = F.greatest(F.abs(low), F.abs(high)).cast("double")

    def magnitude(x: Column) -> Column:
        part = F.abs(x.cast("double")) / most
        return F.when(part > 0, F.signum(x.cast("double")) * (F.log(part) + 750)).otherwise(0.0)

    a, b = magnitude(low), magnitude(high)
    return F.when(a == b, 0.0).otherwise((magnitude(key) - a) / (b - a))


def _exact_share(key: Column, low: int | Decimal, high: int | Decimal) -> Column:
    """The same for whole and decimal numbers, with the difference taken before digits are lost."""
    low_value = F.lit(low).cast("decimal(20,0)") if isinstance(low, int) else F.lit(low)
    apart = F.try_subtract(key.cast("decimal(20,0)") if isinstance(low, int) else key, low_value).cast("double")
    return F.coalesce(apart / F.lit(float(high - low)), _share(key, F.lit(low), F.lit(high)))


def _bin(share: Column) -> Column:
    return F.least(F.lit(BINS - 1), F.floor(share * BINS)).cast("int")


def value_at_rank(df: DataFrame, column: str, rank: int) -> Rank | None:
    """The value at a rank from 1 in ascending order, nulls first and NaN last; None if there are fewer rows."""
    kind = df.schema[column].dataType
    if not orderable(kind):
        raise TypeError(f"{column} has no order that can be counted: {kind.simpleString()}")
    key = _key(column, kind)
    floating = isinstance(kind, (T.FloatType, T.DoubleType))
    odd = [F.isnan(key), key == F.lit(-inf), key == F.lit(inf)] if floating else [F.lit(False)] * 3
    plain = F.when(~(odd[0] | odd[1] | odd[2]), key) if floating else key
    top = df.agg(
        F.count_if(key.isNull()).alias("nulls"), *[F.count_if(F.coalesce(t, F.lit(False))).alias(n) for t, n in zip(odd, ("nan", "below", "above"), strict=True)],
        F.count(plain).alias("n"), F.min(plain).alias("lo"), F.max(plain).alias("hi"),
    ).first()
    missing = key.isNull()

    def found(lower: Column, equal: Column, n_lower: int, n_equal: int) -> Rank:
        return Rank(F.coalesce(lower, F.lit(False)), F.coalesce(equal, F.lit(False)), n_lower, n_equal)

    before = 0
    for n, equal, lower in ((top["nulls"], missing, F.lit(False)), (top["below"], odd[1], missing)):
        if rank <= before + n:
            return found(lower, equal, before, n)
        before += n
    if rank > before + top["n"]:
        before += top["n"]
        for n, equal, lower in ((top["above"], odd[2], missing | (key < F.lit(inf))), (top["nan"], odd[0], missing | ~F.isnan(key))):
            if rank <= before + n:
                return found(lower, equal, before, n)
            before += n
        return None
    low, high, n = top["lo"], top["hi"], top["n"]
    rows = df.select(key.alias("k"))
    k, by_value, spread = F.col("k"), False, False
    while low != high:
        inside = rows.where(k.between(F.lit(low), F.lit(high)))
        if n <= FEW or by_value:
            counted = inside.groupBy("k").agg(F.count("*").alias("n"), F.min("k").alias("lo"), F.max("k").alias("hi")).select(F.col("lo").alias("at"), "n", "lo", "hi")
        else:
            if isinstance(kind, (T.StringType, T.BinaryType)):
                at = _text_bins(k, low, high)
            elif isinstance(low, (int, Decimal)):
                at = _bin(_exact_share(k, low, high))
            else:
                at = _bin((_spread_share if spread else _share)(k, F.lit(low), F.lit(high)))
            counted = inside.groupBy(at.alias("at")).agg(F.count("*").alias("n"), F.min("k").alias("lo"), F.max("k").alias("hi"))
        # At most BINS bins (257 * 257 for texts), or FEW values.
        for row in sorted(counted.collect(), key=lambda r: r["at"]):
            if rank <= before + row["n"]:
                by_value = not spread and (low, high) == (row["lo"], row["hi"])  # decimals too close for a double to tell apart
                spread = floating and not spread and 4 * row["n"] > n
                low, high, n = row["lo"], row["hi"], row["n"]
                break
            before += row["n"]
    return found(missing | (key < F.lit(low)), key == F.lit(low), before, n)


def quantiles(values: DataFrame, probabilities: Sequence[float]) -> DataFrame:
    """(column_name, p, quantile): linearly interpolated quantiles of the doubles ``value`` per ``column_name``, nulls left out.

    All columns and probabilities go through each round together. What is collected are the bins of the wanted ranks: a
    number set by the columns and probabilities, not by the rows. NaN comes last.
    """
    finite = F.when(~(F.isnan("value") | (F.abs("value") == inf)), F.col("value"))
    totals = values.where("value IS NOT NULL").groupBy("column_name").agg(
        F.count("*").alias("n"), F.count_if(F.isnan("value")).alias("nan"), F.count_if(F.col("value") == -inf).alias("below"),
        F.count_if(F.col("value") == inf).alias("above"), F.min(finite).alias("lo"), F.max(finite).alias("hi")).collect()
    wanted: dict[tuple, tuple[int, int, float]] = {}
    ranges: dict[tuple[str, int], list] = {}  # (column, rank from 0): low, high, rows before low, rows within, whether to bin by magnitude
    exact: dict[tuple[str, int], float] = {}
    for t in totals:
        for p in probabilities:
            position = p * (t["n"] - 1)
            low = int(position)
            wanted[t["column_name"], p] = (low, min(low + 1, t["n"] - 1), position - low)
            for rank in wanted[t["column_name"], p][:2]:
                at = (t["column_name"], rank)
                within = t["n"] - t["nan"] - t["above"] - t["below"]
                if rank < t["below"] or rank >= t["below"] + within:
                    exact[at] = -inf if rank < t["below"] else inf if rank < t["n"] - t["nan"] else nan
                else:
                    ranges[at] = [t["lo"], t["hi"], t["below"], within, False]
    spark = values.sparkSession
    while True:
        for at in [a for a, r in ranges.items() if r[0] == r[1]]:
            exact[at] = ranges.pop(at)[0]
        if not ranges:
            break
        open_ranges = sorted({(c, r[0], r[1], r[3] <= FEW, r[4]) for (c, _), r in ranges.items()})
        listed = spark.createDataFrame(open_ranges, "column_name string, low double, high double, by_value boolean, spread boolean")
        inside = values.join(F.broadcast(listed), "column_name").where(F.col("value").between(F.col("low"), F.col("high")))
        ends = (F.col("value"), F.col("low"), F.col("high"))
        share = F.when(F.col("spread"), _spread_share(*ends)).otherwise(_share(*ends))
        at = F.when(F.col("by_value"), F.col("value")).otherwise(_bin(share).cast("double"))
        counted = inside.groupBy("column_name", "low", "high", "spread", at.alias("at")).agg(
            F.count("*").alias("n"), F.min("value").alias("lo"), F.max("value").alias("hi")).collect()
        bins: dict[tuple, list] = {}
        for row in sorted(counted, key=lambda r: r["at"]):
            bins.setdefault((row["column_name"], row["low"], row["high"], row["spread"]), []).append(row)
        for (column, rank), r in ranges.items():
            for row in bins[column, r[0], r[1], r[4]]:
                if rank < r[2] + row["n"]:
                    r[:] = [row["lo"], row["hi"], r[2], row["n"], not r[4] and 4 * row["n"] > r[3]]
                    break
                r[2] += row["n"]
    rows = []
    for (column, p), (a, b, share) in wanted.items():
        low, high = exact[column, a], exact[column, b]
        rows.append((column, float(p), low if not share or low == high or isinf(low) else low + (high - low) * share))
    return spark.createDataFrame(rows, "column_name string, p double, quantile double")
