"""Duplicates, unions, top rows and sampling."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.columns import quoted
from tidemark.operators.selection import orderable, value_at_rank
from tidemark.operators.skew import semi_join_counted


def keep_last(df: DataFrame, keys: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """The last row of each key by the given order.

    An aggregate instead of a ranking window: each task first reduces its own rows, so
    a key with very many rows never lands whole in one task. Null keys are one group.
    """
    row = F.struct(*[quoted(c) for c in df.columns])
    order = F.struct(*[quoted(c) for c in order_by])
    kept = df.groupBy(*[quoted(k) for k in keys]).agg(F.max_by(row, order).alias("_row"))
    return kept.select("_row.*")


def union_by_name(first: DataFrame, *others: DataFrame) -> DataFrame:
    """Rows of all frames, columns matched by name; absent columns are null."""
    for other in others:
        first = first.unionByName(other, allowMissingColumns=True)
    return first


def duplicate_groups(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Values that occur more than once, with ``n`` rows each. Nulls compare equal."""
    columns = list(columns or df.columns)
    return df.groupBy(*[quoted(c) for c in columns]).agg(F.count("*").alias("n")).where("n > 1")


def duplicate_rows(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Every member of every duplicated group (on all columns unless a subset is named)."""
    columns = list(columns or df.columns)
    return semi_join_counted(df, duplicate_groups(df, columns), columns, "n")


def count_duplicate_groups(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    return duplicate_groups(df, columns).agg(F.count("*").alias("duplicated_groups"))


# Heads up to this size are small enough for every task to hold one.
SMALL_HEAD = 10_000


def head_rows(df: DataFrame, order_by: Sequence[str], n: int) -> DataFrame:
    """The first ``n`` rows in a stated order, nulls first; which of rows with equal keys are taken is not defined.

    For a small head every task keeps its first ``n`` rows. For a large one the value of the ``n``-th row is found by
    counting in rounds, column by column, and only rows up to it are sorted; then no task holds ``n`` rows. Columns of
    nested types, which cannot be counted so, take the first way at any size.
    """
    order = [quoted(c) for c in order_by]
    if n <= SMALL_HEAD or not all(orderable(df.schema[c].dataType) for c in order_by):
        return df.orderBy(*order).limit(n)
    before, tied, left = F.lit(False), F.lit(True), n
    for column in order_by:
        at = value_at_rank(df.where(tied), column, left)
        if at is None:
            return df.orderBy(*order)
        before, tied, left = before | (tied & at.lower), tied & at.equal, left - at.n_lower
        if at.n_equal == left:
            return df.where(before | tied).orderBy(*order)
    return df.where(before).unionByName(df.where(tied).limit(left)).orderBy(*order)


def _hash_order(id_columns: Sequence[str], seed: int):
    """The first 60 bits of a hash that databases have too."""
    text = F.concat_ws("|", *[F.coalesce(quoted(c).cast("string"), F.lit("~")) for c in id_columns], F.lit(str(seed)))
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("bigint")


def sample_fraction(df: DataFrame, fraction: float, id_columns: Sequence[str], seed: int = 42) -> DataFrame:
    """A repeatable share of the rows, chosen by a hash of their id; no shuffle."""
    if not 0 < fraction < 1:
        return df
    buckets = 1_000_000
    return df.where(F.pmod(_hash_order(id_columns, seed), F.lit(buckets)) < int(fraction * buckets))


def sample_cap(
    df: DataFrame, id_columns: Sequence[str], max_rows: int | None = None, fraction: float | None = None, seed: int = 42
) -> DataFrame:
    """A share of the rows, or at most ``max_rows`` of them; the whole frame when neither is set."""
    if fraction is not None and 0 < fraction < 1:
        return sample_fraction(df, fraction, id_columns, seed)
    if max_rows is not None and max_rows > 0:
        hashed = df.withColumn("_order", _hash_order(id_columns, seed))
        return head_rows(hashed, ["_order", *id_columns], max_rows).drop("_order")
    return df
