"""Surrogate keys: a hash of the natural key, so looking one up needs no join."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions.values import as_column

SEPARATOR = "|"
NULL_TOKEN = "~"


def number_part(value: str | Column) -> Column:
    """A number of at most six decimals as a whole count of millionths, which every engine prints alike."""
    number = as_column(value)
    millionths = F.rint(number * 1e6)
    # Beyond a bigint such a number has no decimals to round; its own digits are the key.
    return F.when(F.abs(millionths) < 9e18, millionths.try_cast("bigint").cast("string")).otherwise(number.cast("string"))


def surrogate_key(*texts: Column, numbers: Sequence[Column] = ()) -> Column:
    """md5 over the parts, numbers first; null equals null and nothing else.

    Parts start with a mark that the null token lacks, and separators in texts are escaped, so different parts never
    make the same string. Numbers, as :func:`number_part` writes them, have nothing to escape.
    """
    def marked(p: Column) -> Column:
        return F.coalesce(F.concat(F.lit("="), p), F.lit(NULL_TOKEN))

    def escaped(p: Column) -> Column:
        return F.replace(F.replace(p.cast("string"), F.lit("\\"), F.lit("\\\\")), F.lit(SEPARATOR), F.lit("\\" + SEPARATOR))

    return F.md5(F.concat_ws(SEPARATOR, *[marked(n) for n in numbers], *[marked(escaped(t)) for t in texts]))
