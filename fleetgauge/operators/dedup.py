"""De-duplication with a repeatable survivor.

Both operators reduce each map partition before the shuffle (a partial
aggregate, a partial window group limit), so a key that holds a large part of
all rows costs one row per map task after the shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import (
    BooleanType,
    DateType,
    NumericType,
    TimestampNTZType,
    TimestampType,
)


# Types that a hash aggregate can update in place. With any other type in its
# buffer (text, structs) Spark sorts instead, which takes about twice as long.
IN_PLACE = (NumericType, BooleanType, DateType, TimestampType, TimestampNTZType)


def keep_one(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per key; NULL keys count as equal. The survivor is a whole row.

    On a stream this is the watermarked ``dropDuplicates`` (first arrival wins).
    On a batch the choice does not depend on the order of rows: the row that is
    least in the order of its other columns wins or, if all of these have a fixed
    width, the one with the least hash.
    """
    rest = [c for c in df.columns if c not in keys]
    if df.isStreaming or not rest:
        return df.dropDuplicates(list(keys))
    if all(isinstance(df.schema[c].dataType, IN_PLACE) for c in rest):
        # null flags, because NULL does not change a hash
        rank = F.xxhash64(*rest, *[F.isnull(c) for c in rest])
        ranked = df.withColumn("_rank", rank)
        kept = ranked.groupBy(*keys).agg(*[F.min_by(c, "_rank").alias(c) for c in rest])
        return kept.select(df.columns)
    kept = df.groupBy(*keys).agg(F.min(F.struct(*rest)).alias("_least"))
    return kept.select(*[F.col(f"_least.{c}").alias(c) if c in rest else F.col(c)
                         for c in df.columns])


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """The first row of each key in the given order.

    Columns missing from ``order`` should be appended by the caller, so that
    ties have one outcome.
    """
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_place", place).filter("_place = 1").drop("_place")
