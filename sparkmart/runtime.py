"""Session settings and the shared scratch area used for written intermediate tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_LOCAL_ROOTS: dict[str, str] = {}


def local_session(app_name: str = "sparkmart", cores: int | str = "*", **conf: str) -> SparkSession:
    """A local session for tests and benchmarks; clusters bring their own session."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.shuffle.partitions", "8")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_root(spark: SparkSession) -> str:
    """Folder for written intermediates: the cluster's ``spark.checkpoint.dir``.

    Only a local-mode session without that setting gets a temporary folder; on a cluster a
    machine-local folder would not be visible to the executors, so that is an error.
    """
    app_id = spark.sparkContext.applicationId
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by driver and executors")
        if app_id not in _LOCAL_ROOTS:
            _LOCAL_ROOTS[app_id] = tempfile.mkdtemp(prefix="sparkmart-")
        base = _LOCAL_ROOTS[app_id]
    return f"{base.rstrip('/')}/sparkmart-{app_id}"


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path under the scratch root; every call returns a new one."""
    return f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex[:12]}"


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once and read it back, which cuts the lineage and survives executor loss."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_scratch(spark: SparkSession) -> None:
    """Remove this application's written intermediates and scratch databases, when nothing reads them any more."""
    root = scratch_root(spark)
    for database in spark.catalog.listDatabases():
        if f"{database.locationUri}/".replace("file:///", "file:/").find(root.replace("file:///", "file:/").removeprefix("file:")) >= 0:
            spark.sql(f"DROP DATABASE {database.name} CASCADE")
    path = spark._jvm.org.apache.hadoop.fs.Path(root)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def scratch_database(spark: SparkSession, label: str = "mart") -> str:
    """Create a database whose tables live under the scratch root and return its name."""
    name = f"{label}_{uuid.uuid4().hex[:10]}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{scratch_path(spark, name)}'")
    return name
