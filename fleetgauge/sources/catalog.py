"""Tables by name, and the JDBC sink."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession


def register_table(spark: SparkSession, name: str, path: str) -> DataFrame:
    """Make a Parquet directory queryable as ``name``, with its partitions.

    A table that is registered at the same place stays: new columns are added and partitions
    follow the folders, so readers always find it. It is defined anew only if its place
    changed, or a column was removed or has another type, which no table can follow.
    """
    if not _follow(spark, name, path):
        location = path.replace("'", "\\'")
        spark.sql(f"DROP TABLE IF EXISTS {name}")
        spark.sql(f"CREATE TABLE {name} USING parquet LOCATION '{location}'")
    if any(c.isPartition for c in spark.catalog.listColumns(name)):
        spark.sql(f"MSCK REPAIR TABLE {name} SYNC PARTITIONS")
    spark.catalog.refreshTable(name)
    return spark.table(name)


def _follow(spark: SparkSession, name: str, path: str) -> bool:
    """Whether the registered table could be made to fit the folder's columns."""
    if not spark.catalog.tableExists(name):
        return False
    described = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect()}
    place = spark._jvm.org.apache.hadoop.fs.Path
    qualified = place(path).getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(place(path))
    if "Location" not in described or not qualified.toUri().equals(
            place(described["Location"]).toUri()):
        return False
    there = {c.name: c for c in spark.catalog.listColumns(name)}
    now = {f.name: f.dataType.simpleString() for f in spark.read.option("mergeSchema", True).parquet(path).schema}
    if any(now.get(c.name) != c.dataType for c in there.values()):
        return False
    added = [f"`{c}` {kind}" for c, kind in now.items() if c not in there]
    if added:
        spark.sql(f"ALTER TABLE {name} ADD COLUMNS ({', '.join(added)})")
    return True


def read_view(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


def write_jdbc(df: DataFrame, url: str, table: str, properties: Mapping[str, str],
               chunk: int = 1000, connections: int = 8) -> None:
    """Replace a database table; executors insert in chunks over few connections."""
    (df.write.format("jdbc").mode("overwrite").options(**properties)
     .option("url", url).option("dbtable", table)
     .option("batchsize", chunk).option("numPartitions", connections).save())
