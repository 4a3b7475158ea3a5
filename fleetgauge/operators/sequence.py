"""The previous value in a keyed sequence, also when one key is huge."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Groups that the rows without a time are spread over; only the last of each goes on.
UNTIMED_GROUPS = 1024


def with_previous(
    df: DataFrame,
    key: str,
    time: str,
    value: str,
    ties: Sequence[str],
    output: str,
    piece: str = "HOUR",
    most: int = 1_000_000,
) -> DataFrame:
    """Add ``output``: ``value`` of the row before, per key, by ``time`` then ``ties``.

    Rows without a time come before all others of their key and are not returned;
    nor are rows without a key.

    A window over a key runs it in one task. Here each key is cut into pieces of
    time (a unit of ``date_trunc``), every key alike. Pieces with more than ``most``
    rows are cut finer, into minutes, and those with sixty times as many into seconds;
    they are found by counting, which brings copies of a piece together before it
    shuffles, and there is at most one for every ``most`` rows of the table. A first window
    works inside the pieces; a second one over the first and last rows of the pieces of a
    key carries the value over the borders. So a task holds up to ``most`` rows of a key and
    piece (or those of one second), or two rows for each piece of a key.
    """
    order = [time, *ties]
    untimed = F.col(time).isNull()
    # any spread will do: of rows without a time only the very last is followed
    spread = F.when(untimed, F.pmod(F.xxhash64(*ties, value), F.lit(UNTIMED_GROUPS)))
    inside = Window.partitionBy(key, "_piece", "_spread").orderBy(*order)
    keyed = df.filter(F.col(key).isNotNull()).withColumn("_piece", F.date_trunc(piece, F.col(time)))
    full = (
        keyed.groupBy(F.col(key).alias("_full_key"), F.col("_piece").alias("_full_piece"))
        .agg(F.count(F.lit(1)).alias("_full_rows")).filter(F.col("_full_rows") > most)
    )
    finer = F.when(F.col("_full_rows") > 60 * most, F.date_trunc("SECOND", F.col(time))).when(
        F.col("_full_rows").isNotNull(), F.date_trunc("MINUTE", F.col(time)))
    placed = keyed.join(
        F.broadcast(full), (F.col(key) == F.col("_full_key")) & (F.col("_piece") == F.col("_full_piece")),
        "left").withColumn("_piece", F.coalesce(finer, "_piece"))
    cut = (
        placed.withColumn("_spread", spread)
        .withColumns({"_before": F.lag(F.struct(F.col(value).alias("v"))).over(inside),
                      "_after": F.lead(key).over(inside)})
        .filter(~untimed | F.col("_after").isNull())
    )
    first, last = F.col("_before").isNull(), F.col("_after").isNull()
    # rows between stay with their piece, those at a border meet per key
    borders = Window.partitionBy(key, "_between").orderBy(*order, ~first)
    carried = cut.withColumn("_between", F.when(~first & ~last, F.col("_piece"))).withColumn(
        output, F.when(first, F.lag(value).over(borders)).otherwise(F.col("_before.v")))
    return carried.filter(~untimed).select(*df.columns, output)
