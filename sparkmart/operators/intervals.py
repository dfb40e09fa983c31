"""Data intervals, backfill, readiness, run metrics and routing."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkmart.functions.temporal import even_minute, floor_to_minute
from sparkmart.operators.stats import quantiles_by
from sparkmart.runtime import materialize, scratch_path


def slice_interval(df: DataFrame, ts: str, start: datetime | str, end: datetime | str) -> DataFrame:
    """Rows with ``start <= ts < end``; a plain comparison, so it is pushed to the scan."""
    kind = dict(df.dtypes)[ts]
    return df.filter((F.col(ts) >= F.lit(start).cast(kind)) & (F.col(ts) < F.lit(end).cast(kind)))


def daily_intervals(
    spark: SparkSession, first_day: str, last_day: str, zone: str = "Asia/Jakarta", at: str = "09:30:00"
) -> DataFrame:
    """One row per daily interval that starts at ``at`` in ``zone``; the bounds are UTC times without zone.

    The rows cover the days in between only, one per day.
    """
    return spark.sql(
        """
        SELECT day,
               CAST(to_utc_timestamp(CAST(concat(day, ' ', :at) AS TIMESTAMP_NTZ), :zone) AS TIMESTAMP_NTZ) AS interval_start,
               CAST(to_utc_timestamp(CAST(concat(date_add(day, 1), ' ', :at) AS TIMESTAMP_NTZ), :zone) AS TIMESTAMP_NTZ)
                 AS interval_end
        FROM (SELECT explode(sequence(CAST(:first AS DATE), CAST(:last AS DATE), INTERVAL 1 DAY)) AS day)
        """,
        args={"at": at, "zone": zone, "first": first_day, "last": last_day},
    )


def interval_start(ts: str, zone: str = "Asia/Jakarta", at: str = "09:30:00") -> Column:
    """Start (UTC) of the daily interval that holds a time: computed per row, without a join."""
    h, m, s = at.split(":")
    offset = f"INTERVAL '{h}:{m}:{s}' HOUR TO SECOND"
    local_day = F.expr(f"date_trunc('DAY', from_utc_timestamp(`{ts}`, '{zone}') - {offset})")
    return F.to_utc_timestamp(local_day + F.expr(offset), F.lit(zone)).cast("timestamp_ntz")


def backfill(df: DataFrame, ts: str, intervals: DataFrame, aggregates: Sequence[Column], zone: str = "Asia/Jakarta",
             at: str = "09:30:00") -> DataFrame:
    """All intervals in one grouped job; intervals without rows are kept with empty aggregates."""
    grouped = df.groupBy(interval_start(ts, zone, at).alias("interval_start")).agg(*aggregates)
    return intervals.join(grouped, "interval_start", "left")


def write_intervals(df: DataFrame, path: str, partition: str = "day") -> None:
    """Write one partition per interval; a repeated run replaces just the partitions it produces."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(partition).parquet(path)


def readiness(expected: DataFrame, present: DataFrame, ts: str, lag_minutes: int = 2) -> DataFrame:
    """For each expected time: is its minute, and the one ``lag_minutes`` before, there upstream?

    The minutes present are few however many rows there are; they are written, so that Spark knows it.
    """
    minutes = materialize(present.select(floor_to_minute(ts).alias("minute")).distinct(), "minutes")
    wanted = expected.withColumn("current_minute", floor_to_minute(ts)).withColumn(
        "previous_minute", F.col("current_minute") - F.expr(f"INTERVAL {int(lag_minutes)} MINUTES")
    )
    now = minutes.select(F.col("minute").alias("current_minute"), F.lit(True).alias("current_ready"))
    before = minutes.select(F.col("minute").alias("previous_minute"), F.lit(True).alias("previous_ready"))
    return (
        wanted.join(now, "current_minute", "left")
        .join(before, "previous_minute", "left")
        .withColumns(
            {
                "current_ready": F.coalesce("current_ready", F.lit(False)),
                "previous_ready": F.coalesce("previous_ready", F.lit(False)),
            }
        )
        .withColumn("ready", F.col("current_ready") & F.col("previous_ready"))
    )


def latest_run(runs: DataFrame, by: Sequence[str], started: str, value: str, tie: str) -> DataFrame:
    """``value`` of the most recent run of each group."""
    return runs.groupBy(*by).agg(F.max_by(value, F.struct(started, tie)).alias(value))


def run_metrics(runs: DataFrame, ts: str, label: str, seconds: str, every: str, quantiles: Sequence[float]) -> DataFrame:
    """Metric series per label and time window in milliseconds, with its exact quantiles."""
    series = runs.select(F.window(ts, every)["start"].alias("window_start"), F.col(label), (F.col(seconds) * 1000).alias("__ms"))
    by = ["window_start", label]
    totals = series.groupBy(*by).agg(F.count(F.lit(1)).alias("runs"), F.max("__ms").alias("max_ms"))
    found = quantiles_by(series, by, "__ms", {f"p{round(q * 100)}_ms": q for q in quantiles})
    on = [totals[c].eqNullSafe(found[c]) for c in by]
    return totals.join(found, on, "left").select(*[totals[c] for c in totals.columns], *[found[c] for c in found.columns if c not in by])


def label_values(df: DataFrame, label: str) -> DataFrame:
    return df.select(label).distinct()


# fixed values: names of the two branches
EVEN, ODD = "even_task", "odd_task"


def route(ts: str) -> Column:
    """Branch name of a row: even minutes go one way, odd minutes the other."""
    return F.when(even_minute(ts), EVEN).otherwise(ODD)


def split_routes(df: DataFrame, ts: str) -> dict[str, DataFrame]:
    """The two branches of one input, which is read once: one write by branch, each output reads its own partition."""
    routed = df.withColumn("branch", route(ts))
    names = [c for c in routed.columns if c != "branch"]
    path = scratch_path(df.sparkSession, "routes")
    routed.write.partitionBy("branch").parquet(path)
    schema = T.StructType([*routed.select(names).schema.fields, T.StructField("branch", T.StringType())])
    written = df.sparkSession.read.schema(schema).parquet(path)
    return {name: written.filter(F.col("branch") == name).select(routed.columns) for name in (EVEN, ODD)}
