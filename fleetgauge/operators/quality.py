"""Row, duplicate and NULL counts of a table."""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

COPIES = "_copies"


def count_copies(df: DataFrame) -> DataFrame:
    """The distinct rows of ``df`` with the number of times each occurs."""
    return df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias(COPIES))


def profile_columns(columns: list[str]) -> list[Column]:
    """Aggregates over :func:`count_copies` that profile the original rows."""
    nulls = reduce(add, [F.when(F.col(c).isNull(), 1).otherwise(0) for c in columns])
    copies = F.col(COPIES)
    none = F.lit(0).cast("bigint")
    return [
        F.coalesce(F.sum(copies), none).alias("rows_fetched"),
        F.coalesce(F.sum(copies - 1), none).alias("duplicate_rows"),
        F.coalesce(F.sum(copies * nulls), none).alias("null_cells"),
        F.coalesce(F.sum(copies - 1), none).alias("rows_removed"),
        F.count(F.lit(1)).alias("final_rows"),
    ]


def quality_profile(df: DataFrame) -> DataFrame:
    """One row: rows fetched, duplicates, NULL cells, rows removed, rows left.

    One shuffle of the rows (combined on the map side) answers all five.
    """
    return count_copies(df).agg(*profile_columns(df.columns))
