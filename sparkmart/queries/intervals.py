"""Intervals, readiness, run metrics, routing, state."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkmart.functions import temporal
from sparkmart.operators import intervals, loads
from sparkmart.operators.state import StateTable
from sparkmart.queries.registry import query, table
from sparkmart.runtime import scratch_path

# start of the daily interval (09:30 at UTC+7) that holds ts
_START_SQL = "(date_trunc('day', ts - INTERVAL 150 MINUTE) + INTERVAL 150 MINUTE)"


@query("route_odd_even", "SELECT event_id, CASE WHEN minute(ts) % 2 = 0 THEN 'even_task' ELSE 'odd_task' END AS branch FROM events")
def route_odd_even(spark: SparkSession, sf_dir: str) -> DataFrame:
    branches = intervals.split_routes(table(spark, sf_dir, "events"), "ts")
    return branches["even_task"].unionByName(branches["odd_task"]).select("event_id", "branch")


@query(
    "interval_slice",
    "SELECT * FROM events WHERE ts >= TIMESTAMP '2024-01-05 02:30:00' AND ts < TIMESTAMP '2024-01-20 02:30:00'",
)
def interval_slice(spark: SparkSession, sf_dir: str) -> DataFrame:
    return intervals.slice_interval(table(spark, sf_dir, "events"), "ts", "2024-01-05 02:30:00", "2024-01-20 02:30:00")


@query(
    "interval_backfill",
    f"""
    WITH days AS (SELECT CAST(unnest(generate_series(DATE '2023-12-30', DATE '2024-02-02', INTERVAL 1 DAY)) AS DATE) AS day),
    i AS (SELECT day, day + INTERVAL 150 MINUTE AS interval_start, day + INTERVAL 1 DAY + INTERVAL 150 MINUTE AS interval_end FROM days),
    g AS (SELECT {_START_SQL} AS interval_start, count(*) AS n,
                 CAST(sum(CAST(value AS DECIMAL(18, 2))) AS DOUBLE) AS total FROM events GROUP BY 1)
    SELECT i.day, i.interval_start, i.interval_end, g.n, g.total FROM i LEFT JOIN g ON i.interval_start = g.interval_start
    """,
)
def interval_backfill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All days in one job, written as one partition each and read back."""
    days = intervals.daily_intervals(spark, "2023-12-30", "2024-02-02")
    total = F.sum(F.col("value").cast("decimal(18,2)")).cast("double").alias("total")
    filled = intervals.backfill(
        table(spark, sf_dir, "events"), "ts", days, [F.count(F.lit(1)).alias("n"), total]
    )
    path = scratch_path(spark, "backfill")
    intervals.write_intervals(filled, path)
    return spark.read.parquet(path)


@query(
    "interval_readiness",
    """
    WITH m AS (SELECT DISTINCT date_trunc('minute', ts) AS minute FROM events WHERE event_type <> 'error'),
    w AS (SELECT event_id, date_trunc('minute', ts) AS c, date_trunc('minute', ts) - INTERVAL 2 MINUTE AS p
          FROM events WHERE event_type = 'error')
    SELECT event_id, c IN (SELECT minute FROM m) AS current_ready, p IN (SELECT minute FROM m) AS previous_ready,
           c IN (SELECT minute FROM m) AND p IN (SELECT minute FROM m) AS ready
    FROM w
    """,
)
def interval_readiness(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    wanted = events.filter("event_type = 'error'").select("event_id", "ts")
    checked = intervals.readiness(wanted, events.filter("event_type <> 'error'"), "ts")
    return checked.select("event_id", "current_ready", "previous_ready", "ready")


@query(
    "interval_macros",
    f"""
    SELECT event_id, strftime({_START_SQL}, '%Y-%m-%d') AS ds,
           strftime({_START_SQL}, '%Y-%m-%dT%H:%M:%S+00:00') AS ts_label,
           strftime({_START_SQL}, '%Y-%m-%dT%H:%M:%S+00:00') AS interval_start,
           strftime({_START_SQL} + INTERVAL 1 DAY, '%Y-%m-%dT%H:%M:%S+00:00') AS interval_end
    FROM events
    """,
)
def interval_macros(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("event_id", intervals.interval_start("ts").alias("start"))
    labels = temporal.interval_labels(F.col("start"), F.col("start") + F.expr("INTERVAL 1 DAY"))
    return events.select("event_id", *[c.alias(name) for name, c in labels.items()])


@query(
    "latest_run",
    "SELECT user_id, arg_max(date_trunc('minute', ts), ts) AS interval_start FROM events GROUP BY user_id",
)
def latest_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    runs = table(spark, sf_dir, "events").withColumn(
        "interval_start", temporal.floor_to_minute("ts").cast("timestamp_ntz")
    )
    return intervals.latest_run(runs, ["user_id"], "ts", "interval_start", "event_id")


@query(
    "run_metrics",
    """
    SELECT date_trunc('day', ts) AS window_start, event_type, count(*) AS runs, max(value * 1000) AS max_ms,
           quantile_disc(value * 1000, 0.5) AS p50_ms, quantile_disc(value * 1000, 0.9) AS p90_ms
    FROM events GROUP BY 1, 2
    """,
)
def run_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return intervals.run_metrics(table(spark, sf_dir, "events"), "ts", "event_type", "value", "1 day", [0.5, 0.9])


@query("label_values", "SELECT DISTINCT event_type FROM events")
def label_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    return intervals.label_values(table(spark, sf_dir, "events"), "event_type")


@query("watermark_max", "SELECT 'events' AS table_name, max(event_id) AS last_id FROM events")
def watermark_max(spark: SparkSession, sf_dir: str) -> DataFrame:
    table(spark, sf_dir, "events").createOrReplaceTempView("events_target")
    mark = loads.last_id(spark, "events_target", "event_id")
    return spark.createDataFrame([("events", mark)], "table_name string, last_id long")


@query(
    "state_table",
    """
    SELECT CAST(user_id AS VARCHAR) AS key, arg_max(props, ts) AS value, max(ts) AS updated_at FROM events GROUP BY user_id
    """,
)
def state_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event sets the state of its user; the current values are read back."""
    state = StateTable(spark, scratch_path(spark, "state"))
    events = table(spark, sf_dir, "events")
    state.set_all(
        events.select(
            F.col("user_id").cast("string").alias("key"),
            F.col("props").alias("value"),
            F.col("ts").alias("updated_at"),
            F.col("event_id").alias("seq"),
        )
    )
    return state.current().withColumn("updated_at", F.col("updated_at").cast("timestamp_ntz"))
