"""Fleet inputs derived from orders, customer, nation, region and events.

Each customer is a vehicle, each order an assignment, a refuel and a service;
events are telemetry. Bad values, copies and gaps are put in on
purpose. ``samples.oracle`` says the same in SQL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetgauge.operators.dedup import keep_first

ARRIVALS = 6
FIRST_SNAPSHOT_END = "2001-01-01 00:00:00"
# The columns in use. A stated schema spares the job that reads it from a file footer.
TABLES = {
    "events": "event_id BIGINT, user_id BIGINT",
    "orders": "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, "
              "o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING",
    "customer": "c_custkey BIGINT, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING",
    "nation": "n_nationkey INT, n_regionkey INT",
    "region": "r_regionkey INT, r_name STRING",
}
ZONES = """
    SELECT 'Z1' AS zone_id, 12.5e0 AS min_lat, 12.8e0 AS max_lat, 77.2e0 AS min_lon, 77.5e0 AS max_lon
    UNION ALL SELECT 'Z2', 12.7e0, 12.9e0, 77.4e0, 77.6e0
    UNION ALL SELECT 'Z3', 12.1e0, 12.2e0, 77.8e0, 77.9e0
"""


class FleetSample:
    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def _table(self, name: str, stream: bool = False) -> DataFrame:
        path = f"{self.folder}/{name}.parquet"
        if stream:  # a stream takes a single file only by a pattern
            return self.spark.readStream.schema(TABLES[name]).parquet(path[:-1] + "?")
        return self.spark.read.schema(TABLES[name]).parquet(path)

    def _sent(self, stream: bool = False) -> DataFrame:
        return self._table("events", stream).selectExpr(
            "event_id",
            "concat('VIN', CAST(1000 + user_id AS STRING)) AS vin",
            "CASE WHEN event_id % 33 = 0 THEN NULL ELSE CAST(60 + (event_id * 37) % 81 AS INT) END AS speed",
            "CAST(1000 + (event_id * 53) % 4001 AS INT) AS rpm",
            "12.0e0 + CAST((event_id * 7919) % 10000 AS DOUBLE) / 1e4 AS lat",
            "77.0e0 + CAST((event_id * 104729) % 10000 AS DOUBLE) / 1e4 AS lon",
            "1704067200 + event_id * 3 AS event_timestamp",
            "explode(CASE WHEN event_id % 20 = 0 THEN array(1, 2) ELSE array(1) END) AS copy",
        )

    def events(self, stream: bool = False) -> DataFrame:
        """Parsed telemetry; every 20th event arrives twice, every 33rd has no speed."""
        return self._sent(stream).drop("event_id", "copy")

    def write_arrivals(self, path: str) -> str:
        """The telemetry as JSON lines in ``ARRIVALS`` folders, written in the order of arrival.

        The second copy of an event comes one folder later, every 17th event one and every 29th
        four folders after its time. A stream that takes one file at a time reads them in order.
        """
        sent = self._sent()
        columns = [c for c in sent.columns if c not in ("event_id", "copy")]
        last = sent.agg(F.max("event_id")).first()[0] or 0
        arrival = F.expr(
            f"least({ARRIVALS - 1}, CAST(floor(event_id * {ARRIVALS} / {last + 1}) AS INT) + copy - 1 "
            "+ CASE WHEN event_id % 29 = 0 THEN 4 WHEN event_id % 17 = 0 THEN 1 ELSE 0 END)")
        lines = sent.select(F.to_json(F.struct(*columns)).alias("value"), arrival.alias("arrival"))
        for n in range(ARRIVALS):
            # one file, but read and filtered in as many tasks as the table has
            lines.filter(F.col("arrival") == n).select("value").repartition(1).write.text(f"{path}/{n}")
        return f"{path}/*"

    def messages(self, stream: bool = False) -> DataFrame:
        """The same telemetry as JSON messages."""
        events = self.events(stream)
        return events.select(
            F.to_json(F.struct(*events.columns)).cast("binary").alias("value"),
            F.timestamp_seconds("event_timestamp").alias("timestamp"),
        )

    def _assignments(self) -> DataFrame:
        """Customers in debt have vehicles that send no telemetry. Eight vins share two drivers."""
        return (
            self._table("orders").join(self._table("customer"), F.col("o_custkey") == F.col("c_custkey"))
            .join(self._table("nation"), F.col("c_nationkey") == F.col("n_nationkey"))
            .join(self._table("region"), F.col("n_regionkey") == F.col("r_regionkey"))
            .selectExpr(
                "concat(CASE WHEN c_acctbal >= 0 THEN 'VIN' ELSE 'SPARE' END, "
                "CAST(1000 + o_custkey AS STRING)) AS vin",
                "concat('D', CAST(CAST(floor(o_custkey / 8) * 2 + o_orderkey % 2 AS BIGINT) "
                "AS STRING)) AS driver_id",
                "o_orderdate", "o_orderkey", "r_name AS region")
        )

    def assignment_snapshot(self, before: str | None = None) -> DataFrame:
        """The latest assignment of each vin, of those that started before a time."""
        rows = self._assignments()
        if before:
            rows = rows.filter(F.col("o_orderdate") < F.lit(before).cast("timestamp_ntz"))
        latest = keep_first(rows, ["vin"], [F.desc("o_orderdate"), F.desc("o_orderkey")])
        return latest.selectExpr(
            "vin", "driver_id", "CAST(o_orderdate AS DATE) AS start_date",
            "CAST(NULL AS DATE) AS end_date",
            "CAST(500 + o_orderkey % 1000 AS DOUBLE) AS daily_rate", "region")

    def dimension(self) -> DataFrame:
        """Current assignments. Rebalanced, so that a join shuffles them anew, like the stored
        table they stand for: only then can adaptive execution split a hot vin of the join."""
        current = self.assignment_snapshot().select("vin", "driver_id", "daily_rate", "region")
        return current.hint("rebalance")

    def raw_assignment(self) -> DataFrame:
        return self._assignments().selectExpr(
            "vin", "driver_id",
            "CAST(unix_timestamp(CAST(o_orderdate AS TIMESTAMP)) AS STRING) AS start_timestamp",
            "CAST(NULL AS STRING) AS end_timestamp",
            "CASE WHEN o_orderkey % 103 = 0 THEN 'n/a' "
            "ELSE CAST(500 + o_orderkey % 1000 AS STRING) END AS daily_rate",
            "region")

    def raw_registry(self) -> DataFrame:
        """The richest customers registered under another number."""
        return self._table("customer").selectExpr(
            "concat(CASE WHEN c_acctbal < 9000 THEN 'VIN' ELSE 'OLD' END, "
            "CAST(1000 + c_custkey AS STRING)) AS vin", "c_mktsegment AS model",
            "CAST(2000 + c_custkey % 25 AS STRING) AS mfg_year",
            "CASE WHEN c_custkey % 3 = 0 THEN 'DIESEL' ELSE 'PETROL' END AS fuel_type")

    def raw_fuel(self) -> DataFrame:
        """Every 25th transaction is there twice."""
        return self._table("orders").selectExpr(
            "CAST(o_orderkey AS STRING) AS transaction_id",
            "concat('VIN', CAST(1000 + o_custkey AS STRING)) AS vin",
            "date_format(CAST(o_orderdate AS TIMESTAMP) "
            "+ make_interval(0, 0, 0, 0, 0, 0, o_orderkey % 86400), 'yyyy-MM-dd HH:mm:ss') AS timestamp",
            "CASE WHEN o_orderkey % 101 = 0 THEN 'n/a' WHEN o_orderkey % 211 = 0 THEN '0' "
            "ELSE CAST(20 + o_orderkey % 40 AS STRING) END AS fuel_liters",
            "CAST(datediff(o_orderdate, DATE'1995-01-01') * 100 + o_orderkey % 97 AS STRING) "
            "AS odometer_reading",
            "explode(CASE WHEN o_orderkey % 25 = 0 THEN array(1, 2) ELSE array(1) END) AS copy",
        ).drop("copy")

    def raw_maintenance(self) -> DataFrame:
        """Every order is a service, but only urgent ones have a date that can be read."""
        return self._table("orders").selectExpr(
            "concat('VIN', CAST(1000 + o_custkey AS STRING)) AS vin",
            "CASE WHEN o_orderpriority = '1-URGENT' "
            "THEN CAST(CAST(o_orderdate AS DATE) AS STRING) ELSE 'n/a' END AS service_date",
            "o_orderstatus AS service_type")

    def zones(self) -> DataFrame:
        return self.spark.sql(ZONES)
