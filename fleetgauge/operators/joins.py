"""Join helpers."""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Text bytes and eight bytes a column up to which a side may be broadcast.
BROADCAST_BYTES = 256 << 20


def fits_broadcast(df: DataFrame, rows: int, size: int = BROADCAST_BYTES) -> bool:
    """Whether ``df`` has at most ``rows`` rows and about ``size`` bytes; counted in parallel."""
    width = reduce(add, [F.coalesce(F.octet_length(F.col(f"`{c}`").cast("string")), F.lit(0)) + 8
                         for c in df.columns])
    found = df.agg(F.count(F.lit(1)).alias("n"), F.sum(width.cast("long")).alias("size")).first()
    return found["n"] <= rows and (found["size"] or 0) <= size


def sized_join_side(df: DataFrame, max_rows: int, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Hint how a batch frame is to be joined, after measuring it.

    Up to both bounds it is broadcast, otherwise it joins by sort and merge, where
    adaptive execution can split hot keys of a batch join. Use it where Spark
    cannot see sizes: stream-static joins, and frames that grow by ``explode``.
    """
    return F.broadcast(df) if fits_broadcast(df, max_rows, max_bytes) else df.hint("merge")


def spread_join(left: DataFrame, right: DataFrame, key: str, by: str, salts: int) -> DataFrame:
    """Left join on ``key`` in which the rows of a key meet in ``salts`` groups, by a hash of ``by``.

    Every row of ``right`` is copied to each group, so the right side grows by that factor.
    """
    if salts <= 1:
        return left.join(right, key, "left")
    salted = left.withColumn("_salt", F.pmod(F.xxhash64(by), F.lit(salts)).cast("int"))
    copies = right.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return salted.join(copies, [key, "_salt"], "left").drop("_salt")


def stream_join_side(df: DataFrame, max_rows: int, salts: int) -> tuple[DataFrame, int]:
    """The static side of a streaming join, and the salts to join it with.

    It is measured once: up to ``max_rows`` it is broadcast, which needs no salt.
    """
    if fits_broadcast(df, max_rows):
        return F.broadcast(df), 1
    return df.hint("merge"), salts
