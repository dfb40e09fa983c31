"""News star schema, its reload, and the flows around it."""

from __future__ import annotations

from dataclasses import replace
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkmart.operators import warehouse as wh
from sparkmart.plans import news as news_plan
from sparkmart.queries import fixtures as fx
from sparkmart.queries.quality import interpolation_ctes
from sparkmart.queries.registry import query, table
from sparkmart.queries.sources import HEADING_SQL
from sparkmart.runtime import materialize, scratch_database


def star_ctes(phase: str = "1") -> str:
    """The star schema as CTEs. ``phase`` tells the load in which a row arrives first; keys follow it."""

    def dim(name: str, key: str, column: str) -> str:
        return f"""
        {name} AS (SELECT row_number() OVER (ORDER BY phase, name) AS {key}, name
                   FROM (SELECT {column} AS name, min(phase) AS phase FROM d WHERE {column} IS NOT NULL GROUP BY {column}) x)"""

    return f"""
    n AS (SELECT *, {phase} AS phase, CASE WHEN updated <> 'n/a' THEN CAST(strptime(updated, '%d-%m-%Y') AS DATE) END AS date
          FROM ({fx.NEWS_SQL}) raw),
    d AS (SELECT * FROM n WHERE date IS NOT NULL),
    tagged AS (SELECT * FROM (SELECT * EXCLUDE (tags), trim(unnest(string_split(tags, ','))) AS tag FROM d) x WHERE tag <> ''),
    dim_date AS (SELECT row_number() OVER (ORDER BY phase, date) AS date_id, date, CAST(day(date) AS INTEGER) AS day,
                        CAST(month(date) AS INTEGER) AS month, CAST(year(date) AS INTEGER) AS year
                 FROM (SELECT date, min(phase) AS phase FROM d GROUP BY date) x),
    {dim('dim_category', 'category_id', 'category')},
    {dim('dim_source_category', 'source_category_id', 'source_category')},
    dim_tag AS (SELECT row_number() OVER (ORDER BY phase, tag) AS tag_id, tag AS name
                FROM (SELECT tag, min(phase) AS phase FROM tagged GROUP BY tag) x),
    dim_article AS (SELECT row_number() OVER (ORDER BY phase, url) AS news_id, title, description, url
                    FROM (SELECT *, row_number() OVER (PARTITION BY url ORDER BY seq) AS rn FROM d WHERE description IS NOT NULL) x
                    WHERE rn = 1),
    fact AS (SELECT a.news_id, dd.date_id, c.category_id, s.source_category_id, t.tag_id, coalesce(f.live = 'Yes', false) AS is_live,
                    f.in_pagination
             FROM (SELECT *, row_number() OVER (PARTITION BY url, date, category, source_category, tag ORDER BY seq) AS rn
                   FROM tagged) f
             JOIN dim_article a ON a.url = f.url JOIN dim_date dd ON dd.date = f.date
             JOIN dim_category c ON c.name = f.category JOIN dim_source_category s ON s.name = f.source_category
             JOIN dim_tag t ON t.name = f.tag
             WHERE f.rn = 1)
    """


_STAR = star_ctes()
_TWO_LOADS = star_ctes("CASE WHEN seq <= (SELECT max(doc_id) // 2 FROM documents) THEN 1 ELSE 2 END")


@query("dim_date", f"WITH {_STAR} SELECT * FROM dim_date")
def dim_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wh.assign_keys(wh.new_dates(fx.news(spark, sf_dir)), None, "date_id", ["date"])


@query("dim_category", f"WITH {_STAR} SELECT * FROM dim_category")
def dim_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wh.assign_keys(wh.new_names(fx.news(spark, sf_dir), "category"), None, "category_id", ["name"])


@query("dim_source_category", f"WITH {_STAR} SELECT * FROM dim_source_category")
def dim_source_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = wh.new_names(fx.news(spark, sf_dir), "source_category")
    return wh.assign_keys(names, None, "source_category_id", ["name"])


@query("dim_tag", f"WITH {_STAR} SELECT * FROM dim_tag")
def dim_tag(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wh.assign_keys(wh.new_tags(fx.news(spark, sf_dir)), None, "tag_id", ["name"])


@query("dim_article", f"WITH {_STAR} SELECT * FROM dim_article")
def dim_article(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wh.assign_keys(wh.new_articles(fx.news(spark, sf_dir)), None, "news_id", ["url"])


def _user_halves(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    events = table(spark, sf_dir, "events")
    middle = events.agg(F.expr("max(event_id) div 100")).first()[0]
    early = events.filter(F.col("event_id") <= middle).select(F.col("user_id").alias("name")).distinct()
    return early, events.select(F.col("user_id").alias("name")).distinct()


_USERS = """
    u AS (SELECT user_id AS name, min(CASE WHEN event_id <= (SELECT max(event_id) // 100 FROM events) THEN 1 ELSE 2 END) AS phase
          FROM events GROUP BY user_id)
"""


@query("dim_keys", f"WITH {_USERS} SELECT row_number() OVER (ORDER BY phase, name) AS user_key, name FROM u")
def dim_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users seen early have their keys already; the others are numbered after them."""
    early, everyone = _user_halves(spark, sf_dir)
    existing = materialize(wh.assign_keys(early, None, "user_key", ["name"]), "dim")
    return wh.assign_keys(everyone, existing, "user_key", ["name"])


@query("dim_incremental", f"WITH {_USERS} SELECT name FROM u WHERE phase = 2")
def dim_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    early, everyone = _user_halves(spark, sf_dir)
    return wh.insert_absent(everyone, early, ["name"])


def _stored(star: wh.Star) -> wh.Star:
    """The star with every table written, as a load leaves it."""
    names = ("dim_date", "dim_category", "dim_source_category", "dim_tag", "dim_article", "fact_news")
    done = {n: materialize(getattr(star, n), n) for n in names if getattr(star, n) is not None}
    return replace(star, **done)


@query("fact_news", f"WITH {_STAR} SELECT * FROM fact")
def fact_news(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wh.load_star(fx.news(spark, sf_dir)).fact_news


@query(
    "fact_rejects",
    f"""
    WITH {_STAR}
    SELECT seq, url, CASE WHEN updated IS NULL THEN 'date_null'
      WHEN category IS NULL OR category NOT IN (SELECT name FROM dim_category) THEN 'category'
      WHEN source_category IS NULL OR source_category NOT IN (SELECT name FROM dim_source_category) THEN 'source_category'
      WHEN date IS NULL THEN 'date'
      WHEN url NOT IN (SELECT url FROM dim_article) THEN 'article' END AS reject_reason
    FROM n WHERE reject_reason IS NOT NULL
    """,
)
def fact_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    news = fx.news(spark, sf_dir)
    return wh.rejects(news, wh.load_dimensions(news))


@query("fact_news_reload", f"WITH {_TWO_LOADS} SELECT * FROM fact")
def fact_news_reload(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The older half of the news is loaded into tables, then all of it: only what is new is added."""
    news = fx.news(spark, sf_dir)
    middle = table(spark, sf_dir, "documents").agg(F.expr("max(doc_id) div 2")).first()[0]
    database = scratch_database(spark)
    wh.load_star_tables(news.filter(F.col("seq") <= middle), database)
    return wh.load_star_tables(news, database).fact_news


# distinct keys of the fact first, then their names
_EXTRACT = """
    SELECT title, category, publication_date, url, summary
    FROM (SELECT news_id, category_id, date_id FROM fact GROUP BY ALL) AS link
    JOIN (SELECT news_id, title, url, description AS summary FROM dim_article) AS art USING (news_id)
    JOIN (SELECT category_id, name AS category FROM dim_category) AS cat USING (category_id)
    JOIN (SELECT date_id, date AS publication_date FROM dim_date) AS day USING (date_id)
    GROUP BY ALL
"""


@query("star_extract", f"WITH {_STAR} {_EXTRACT}")
def star_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wh.star_extract(wh.load_star(fx.news(spark, sf_dir)))


_PUNCT = r"[^\p{L}\p{N}_\s\p{Z}\x{1c}-\x{1f}\x{85}]"


@query(
    "dim_cleaned",
    f"""
    WITH {_STAR}, e AS ({_EXTRACT})
    SELECT row_number() OVER (ORDER BY url, publication_date, category) AS cleaned_id,
           regexp_replace(title, '{_PUNCT}', '', 'g') AS title, category, CAST(publication_date AS TIMESTAMP) AS publication_date,
           url, regexp_replace(summary, '{_PUNCT}', '', 'g') AS summary
    FROM e
    """,
)
def dim_cleaned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flat table after two runs; the second finds everything loaded."""
    target = f"{scratch_database(spark)}.dim_cleaned"
    star = _stored(wh.load_star(fx.news(spark, sf_dir)))
    rows = materialize(news_plan.cleaned_rows(star, datetime(2025, 1, 1)), "cleaned")
    for _ in range(2):
        news_plan.load_cleaned(rows, target)
    return spark.table(target).drop("processed_date")


_NEWS_TYPES = "CASE WHEN updated <> 'n/a' THEN strptime(updated, '%d-%m-%Y') END"


def _filled(column: str) -> str:
    return (
        f"coalesce({column}, (SELECT {column} FROM kept WHERE {column} IS NOT NULL GROUP BY {column} "
        f"ORDER BY count(*) DESC, {column} LIMIT 1)) AS {column}"
    )


@query(
    "news_clean",
    f"""
    WITH raw AS ({fx.NEWS_SQL}),
    kept AS (SELECT * EXCLUDE (rn, updated), {_NEWS_TYPES} AS updated
             FROM (SELECT *, row_number() OVER (PARTITION BY url ORDER BY seq) AS rn FROM raw) x WHERE rn = 1),
    {interpolation_ctes('kept', 'updated', 'seq')}
    SELECT seq, title, {_filled('description')}, url, {_filled('category')}, {_filled('source_category')}, {_filled('tags')},
           updated, {_filled('live')}, in_pagination
    FROM filled
    """,
)
def news_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """News with full-row copies among them: deduplicated by url, then every gap filled."""
    news = fx.news(spark, sf_dir)
    copies = news.unionAll(news.filter("seq % 50 = 0"))
    cleaned, _ = news_plan.clean_and_validate(copies, ["url"], ["seq"], {"seq": "bigint"}, {"seq": (0, 10**9)}, "news")
    return cleaned


# the sharp s has no single upper-case letter: it becomes two
_UPPER_HEADINGS = f"SELECT page_id, upper(replace(title, 'ß', 'ss')) AS title FROM ({HEADING_SQL}) h"


@query("etl_news", _UPPER_HEADINGS)
def etl_news(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = f"{scratch_database(spark)}.headings"
    news_plan.etl_headings(table(spark, sf_dir, "pages"), target, "h1", ["page_id"])
    return spark.table(target)


@query("elt_news", _UPPER_HEADINGS)
def elt_news(spark: SparkSession, sf_dir: str) -> DataFrame:
    database = scratch_database(spark)
    news_plan.elt_headings(table(spark, sf_dir, "pages"), f"{database}.raw", f"{database}.headings", "h1", ["page_id"])
    return spark.table(f"{database}.headings")
