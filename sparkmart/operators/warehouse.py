"""News star schema: dimensions with surrogate keys, tag-bridge fact, idempotent reload."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkmart.functions.temporal import date_parts, parse_day_first
from sparkmart.functions.text import split_list
from sparkmart.operators.position import with_position
from sparkmart.operators.quality import keep_first
from sparkmart.operators.state import CommitLog, VersionTaken
from sparkmart.runtime import materialize

# columns of the written rows that all six loads read
DATED = ["seq", "title", "description", "url", "category", "source_category", "tags", "live", "in_pagination", "date"]
# fixed values: the reasons a row is rejected, in the order in which they are looked for
REJECT_REASONS = ("date_null", "category", "source_category", "date", "article")


def insert_absent(candidates: DataFrame, existing: DataFrame | None, natural: Sequence[str]) -> DataFrame:
    """The candidates whose natural key the existing table does not hold yet."""
    if existing is None:
        return candidates
    return candidates.join(existing.select(*natural), list(natural), "left_anti")


def assign_keys(new: DataFrame, existing: DataFrame | None, key: str, natural: Sequence[str], wide: bool = False) -> DataFrame:
    """Existing rows with their keys plus the new rows numbered after the highest key.

    ``new`` holds each natural key once. Numbers follow natural-key order, so a repeated run gives
    the same keys. ``wide`` rows are not sorted and written for it, see :func:`_numbered_by_key`.
    """
    fresh = insert_absent(new, existing, natural)
    highest = (existing.agg(F.max(key)).first()[0] if existing is not None else None) or 0
    numbered = _numbered_by_key(new, fresh, key, natural, highest + 1) if wide else with_position(fresh, natural, name=key, start=highest + 1)
    numbered = numbered.select(key, *new.columns)
    return numbered if existing is None else existing.select(key, *new.columns).unionByName(numbered)


def _numbered_by_key(new: DataFrame, fresh: DataFrame, key: str, natural: Sequence[str], start: int) -> DataFrame:
    """The ``fresh`` of the ``new`` rows, numbered in natural-key order: the keys alone are sorted, and the rows joined to them.

    Where keys repeat or are null after all, the rows themselves are sorted.
    """
    keys = materialize(fresh.groupBy(*natural).agg(F.count(F.lit(1)).alias("__n")), "natural-keys")
    unfit = reduce(lambda x, y: x | y, [F.col(c).isNull() for c in natural], F.col("__n") > 1)
    if not keys.filter(unfit).isEmpty():
        return with_position(fresh, natural, name=key, start=start)
    numbers = with_position(keys.drop("__n"), natural, name=key, start=start)
    return new.join(numbers.hint("shuffle_hash"), list(natural))  # one number per row: too many to broadcast


def _dated(news: DataFrame) -> DataFrame:
    """Rows that have a readable date, with it parsed; the others take no part in the load."""
    if news.columns == DATED:
        return news
    return news.withColumn("date", publication_day(news)).filter("date IS NOT NULL")


def dated(news: DataFrame) -> DataFrame:
    """What the loads need of the dated rows, written once: the news are read and their dates parsed a single time."""
    rows = _dated(news).withColumn("in_pagination", pagination_flag(news))
    return materialize(rows.select(*DATED), "dated-news")


def publication_day(news: DataFrame) -> Column:
    """The day of ``updated``: parsed from a text, or taken from the time that cleaning made of it."""
    is_text = dict(news.dtypes)["updated"] == "string"
    return parse_day_first("updated") if is_text else F.col("updated").cast("date")


def new_dates(news: DataFrame) -> DataFrame:
    days = _dated(news).select("date").distinct()
    return days.withColumns(date_parts(F.col("date")))


def new_names(news: DataFrame, column: str) -> DataFrame:
    return _dated(news).select(F.col(column).alias("name")).filter("name IS NOT NULL").distinct()


def new_tags(news: DataFrame) -> DataFrame:
    return _dated(news).select(F.explode(split_list("tags")).alias("name")).distinct()


def new_articles(news: DataFrame) -> DataFrame:
    """One row per url: the first to arrive (by ``seq``) with title, description and url."""
    complete = _dated(news).select("seq", "title", "description", "url").dropna()
    return keep_first(complete, ["url"], "seq").drop("seq").select("title", "description", "url")


@dataclass(frozen=True)
class Star:
    """The dimension tables and the fact of the news mart; None stands for a table not loaded yet."""

    dim_date: DataFrame | None = None
    dim_category: DataFrame | None = None
    dim_source_category: DataFrame | None = None
    dim_tag: DataFrame | None = None
    dim_article: DataFrame | None = None
    fact_news: DataFrame | None = None


def load_dimensions(news: DataFrame, star: Star = Star()) -> Star:
    """The dimensions after the load: what was there keeps its key, what is new gets the next ones.

    The five loads are independent, so their jobs are submitted side by side.
    """
    loads = {
        "dim_date": (new_dates(news), "date_id", ["date"]),
        "dim_category": (new_names(news, "category"), "category_id", ["name"]),
        "dim_source_category": (new_names(news, "source_category"), "source_category_id", ["name"]),
        "dim_tag": (new_tags(news), "tag_id", ["name"]),
        "dim_article": (new_articles(news), "news_id", ["url"]),
    }
    with ThreadPoolExecutor(max_workers=len(loads)) as pool:
        running = {
            name: pool.submit(assign_keys, new, getattr(star, name), key, natural, name == "dim_article")
            for name, (new, key, natural) in loads.items()
        }
        return replace(star, **{name: job.result() for name, job in running.items()})


def _renamed(dim: DataFrame, key: str, natural: str, alias: str) -> DataFrame:
    return dim.select(F.col(key), F.col(natural).alias(alias))


def lookup(news: DataFrame, star: Star) -> DataFrame:
    """The rows with the four dimension keys looked up and ``reject_reason`` (NULL for good rows).

    Dimensions are joined without a hint: Spark broadcasts those whose measured size allows it, and
    splits skewed partitions of the others.
    """
    dated = news.withColumn("date", publication_day(news))
    found = (
        dated.join(_renamed(star.dim_category, "category_id", "name", "category"), "category", "left")
        .join(
            _renamed(star.dim_source_category, "source_category_id", "name", "source_category"),
            "source_category",
            "left",
        )
        .join(star.dim_date.select("date_id", "date"), "date", "left")
        .join(star.dim_article.select("news_id", "url"), "url", "left")
    )
    missing = (
        F.col("updated").isNull(),
        F.col("category_id").isNull(),
        F.col("source_category_id").isNull(),
        F.col("date_id").isNull(),
        F.col("news_id").isNull(),
    )
    reason = F.coalesce(*[F.when(test, F.lit(name)) for name, test in zip(REJECT_REASONS, missing)])
    return found.withColumn("reject_reason", reason)


def rejects(news: DataFrame, star: Star) -> DataFrame:
    return lookup(news, star).filter("reject_reason IS NOT NULL").select("seq", "url", "reject_reason")


def live_flag(news: DataFrame) -> Column:
    """True for 'Yes'; anything else, including NULL, is false."""
    return F.coalesce(F.col("live") == "Yes", F.lit(False))


def pagination_flag(news: DataFrame) -> Column:
    """The column itself; false only where the whole column is missing."""
    return F.col("in_pagination") if "in_pagination" in news.columns else F.lit(False)


FACT_KEYS = ["news_id", "date_id", "category_id", "source_category_id", "tag_id"]


def new_facts(news: DataFrame, star: Star) -> DataFrame:
    """The fact rows the load adds: one per article, date, category, source category and tag.

    The first row to arrive wins, a row without tags gives none, and keys the fact already holds are
    left alone. Copies are removed by natural key before any lookup, so a heavily repeated article
    reaches the joins once per combination.
    """
    natural = ["url", "date", "category", "source_category", "tag"]
    bridged = _dated(news).select(
        "seq",
        "url",
        "date",
        "category",
        "source_category",
        F.explode(split_list("tags")).alias("tag"),
        live_flag(news).alias("is_live"),
        pagination_flag(news).alias("in_pagination"),
    )
    first = keep_first(bridged.dropna(subset=natural), natural, "seq")
    rows = (
        first.join(_renamed(star.dim_category, "category_id", "name", "category"), "category")
        .join(
            _renamed(star.dim_source_category, "source_category_id", "name", "source_category"), "source_category"
        )
        .join(star.dim_date.select("date_id", "date"), "date")
        .join(_renamed(star.dim_tag, "tag_id", "name", "tag"), "tag")
        .join(star.dim_article.select("news_id", "url"), "url")
        .select(*FACT_KEYS, "is_live", "in_pagination")
    )
    return insert_absent(rows, star.fact_news, FACT_KEYS)


def load_fact(news: DataFrame, star: Star) -> DataFrame:
    """The fact after the load."""
    added = new_facts(news, star)
    return added if star.fact_news is None else star.fact_news.unionByName(added)


DIMENSION_KEYS = {
    "dim_date": "date_id",
    "dim_category": "category_id",
    "dim_source_category": "source_category_id",
    "dim_tag": "tag_id",
    "dim_article": "news_id",
}


# what a load appends carries its id here; only rows of finished loads are read
LOAD_ID = "load_id"


def _folder(spark: SparkSession, database: str) -> str:
    return spark.catalog.getDatabase(database).locationUri.rstrip("/")


def _loads(spark: SparkSession, database: str) -> CommitLog:
    return CommitLog(spark, f"{_folder(spark, database)}/_loads")


def _stored(spark: SparkSession, database: str, loads: Sequence[str]) -> Star:
    found = {}
    for name in [*DIMENSION_KEYS, "fact_news"]:
        if loads and spark.catalog.tableExists(f"{database}.{name}"):
            rows = spark.table(f"{database}.{name}").filter(F.col(LOAD_ID).isin(list(loads)))
            found[name] = rows.drop(LOAD_ID)
    return Star(**found)


def read_star(spark: SparkSession, database: str) -> Star:
    """The star as stored in a database by finished loads; all of it is None before the first one has finished."""
    return _stored(spark, database, _loads(spark, database).latest([])[1])


def _append(rows: DataFrame, load: str, database: str, name: str) -> None:
    target = rows.withColumn(LOAD_ID, F.lit(load)).write.mode("append").format("parquet").partitionBy(LOAD_ID)
    target.saveAsTable(f"{database}.{name}")


def load_star_tables(news: DataFrame, database: str) -> Star:
    """Load news into the star of a database: dimensions first, then the fact, each by appending what is new.

    The rows of a load become visible together, when the next version of the list of finished loads is written after
    the last table; that file is created by one writer only. Of two loads that began at the same version, the second to
    finish fails, as both may have given the same keys, and can be run again. A load that broke off or failed leaves
    rows that are never read (:func:`remove_unread` drops them), and a repeated load adds nothing.
    """
    spark = news.sparkSession
    log = _loads(spark, database)
    version, finished = log.latest([])
    before = _stored(spark, database, finished)
    load = uuid.uuid4().hex
    rows = dated(news)
    after = load_dimensions(rows, before)
    for name, key in DIMENSION_KEYS.items():
        known = getattr(before, name)
        highest = (known.agg(F.max(key)).first()[0] if known is not None else None) or 0
        _append(getattr(after, name).filter(F.col(key) > highest), load, database, name)
    with_new = _stored(spark, database, [*finished, load])
    _append(new_facts(rows, replace(with_new, fact_news=before.fact_news)), load, database, "fact_news")
    _finish(log, version, [*finished, load])
    return read_star(spark, database)


def _finish(log: CommitLog, version: int, loads: list[str]) -> None:
    try:
        log.commit(version + 1, loads)
    except VersionTaken as taken:
        raise RuntimeError("another load into this database has finished meanwhile; run this one again") from taken


def compact_star(spark: SparkSession, database: str) -> Star:
    """Write the rows of all finished loads as those of one, so that reads have one load to look for.

    It is a commit like that of a load: readers see the rows of before or the same rows of after.
    """
    log = _loads(spark, database)
    version, finished = log.latest([])
    if len(finished) > 1:
        load = uuid.uuid4().hex
        star = _stored(spark, database, finished)
        for name in [*DIMENSION_KEYS, "fact_news"]:
            _append(getattr(star, name), load, database, name)
        _finish(log, version, [load])
        log.forget(version)
    return read_star(spark, database)


def remove_unread(spark: SparkSession, database: str) -> int:
    """Drop the rows of loads that broke off, failed or were compacted, and return the number of such loads.

    Run it while no load and no reader of an older version is at work.
    """
    finished = set(_loads(spark, database).latest([])[1])
    path = spark._jvm.org.apache.hadoop.fs.Path(_folder(spark, database))
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    tracked = spark.conf.get("spark.sql.catalogImplementation") == "hive"
    gone = set()
    for name in [*DIMENSION_KEYS, "fact_news"]:
        table = spark._jvm.org.apache.hadoop.fs.Path(path, name)
        if not spark.catalog.tableExists(f"{database}.{name}") or not fs.exists(table):
            continue
        for status in fs.listStatus(table):
            load = status.getPath().getName().removeprefix(f"{LOAD_ID}=")
            if status.isDirectory() and load not in finished and status.getPath().getName() != load:
                if tracked:
                    spark.sql(f"ALTER TABLE {database}.{name} DROP IF EXISTS PARTITION ({LOAD_ID} = '{load}')")
                fs.delete(status.getPath(), True)
                gone.add(load)
        spark.catalog.refreshTable(f"{database}.{name}")
    return len(gone)


def load_star(news: DataFrame, star: Star = Star()) -> Star:
    rows = dated(news)
    dims = load_dimensions(rows, star)
    return replace(dims, fact_news=load_fact(rows, dims))


def star_extract(star: Star) -> DataFrame:
    """Distinct article, category and date combinations of the fact, with descriptive columns.

    The distinct runs on the keys before the joins (names and dates are unique in their dimensions,
    urls in the articles), so tags do not multiply the wide rows.
    """
    keys = star.fact_news.select("news_id", "category_id", "date_id").distinct()
    return (
        keys.join(star.dim_category, "category_id")
        .join(star.dim_date, "date_id")
        .join(star.dim_article, "news_id")
        .select(
            "title",
            F.col("name").alias("category"),
            F.col("date").alias("publication_date"),
            "url",
            F.col("description").alias("summary"),
        )
    )
