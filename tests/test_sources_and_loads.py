import json
import random
from datetime import datetime
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from sparkmart import runtime
from sparkmart.functions import temporal, text
from sparkmart.operators import changes, intervals, loads, quality, warehouse
from sparkmart.operators.state import CommitLog, StateTable, VersionTaken
from sparkmart.operators.warehouse import Star, load_star, load_star_tables, lookup, read_star, rejects
from sparkmart.plans import news, sales
from sparkmart.plans.extract_load import TableSpec, param_query, specs_from
from sparkmart.plans.models import Model, Project
from sparkmart.queries.basics import example_project
from sparkmart.runtime import materialize, scratch_database, scratch_path
from sparkmart.sources import files, jdbc, markup, registry, sinks
from sparkmart.streaming.ingest import ingest_files, landing_stream
from sparkmart.streaming.upsert import IncrementalSink, upsert_stream


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


ADDRESSES = '''id,location_id,address_1,address_2,city,postal_code
1,1,"2600 Middlefield Road",,"Redwood City",94063
20,21,"24 Second Avenue, #5","Suite ""B""",San Mateo,"94025-9881"
'''


def test_csv_three_ways(spark, tmp_path):
    path = tmp_path / "addresses.csv"
    path.write_text(ADDRESSES)
    schema = "id long, location_id long, address_1 string, address_2 string, city string, postal_code string"
    typed = files.read_csv(spark, str(path), schema)
    assert rows(typed)[1][:4] == (20, 21, "24 Second Avenue, #5", 'Suite "B"')
    strings = files.read_csv_strings(spark, str(path))
    assert [t for _, t in strings.dtypes] == ["string"] * 6
    assert strings.filter("id = '1'").first()["address_2"] == ""
    raw = [r["fields"] for r in files.read_csv_raw(spark, str(path)).collect()]
    assert raw[0][:2] == ["id", "location_id"] and len(raw) == 3
    assert files.read_csv(spark, str(path)).schema["id"].dataType.simpleString() == "int"


def test_one_file_is_read_by_several_tasks(spark, tmp_path):
    path = tmp_path / "big.csv"
    path.write_text("id,t\n" + "".join(f"{i},{'x' * 80}\n" for i in range(20_000)))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "256k")
    try:
        df = files.read_csv(spark, str(path), "id long, t string")
        assert df.rdd.getNumPartitions() > 1 and df.count() == 20_000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_a_folder_of_two_sql_files_is_refused(spark, tmp_path):
    for n in "ab":
        (tmp_path / f"{n}.sql").write_text("SELECT 1")
    with pytest.raises(ValueError):
        files.query_file(spark, str(tmp_path))


def test_workbook_files_with_other_column_order(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps({"t": {"columns": ["id", "name"], "rows": [["1", "ann"]]}}))
    (tmp_path / "b.json").write_text(json.dumps({"t": {"columns": ["name", "id"], "rows": [["bob", "2"]]}}))
    assert rows(markup.read_workbook(spark, str(tmp_path))["t"].select("id", "name")) == [("1", "ann"), ("2", "bob")]


def test_json_array(spark, tmp_path):
    posts = [{"userId": 1 + i // 10, "id": i + 1, "title": f"t{i}", "body": "a\nb"} for i in range(20)]
    (tmp_path / "posts.json").write_text(json.dumps(posts, indent=2))
    df = files.read_json_array(spark, str(tmp_path / "posts.json"), "userId long, id long, title string, body string")
    assert df.count() == 20 and df.filter("id = 11").first()["userId"] == 2 and df.first()["body"] == "a\nb"


def test_null_literal_rule(spark):
    values = [None, "NULL", "_NULL", "__NULL", "", "null", "_x", "a,b\n\"c\""]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i long, v string")
    path = sinks.write_delimited(df, f"{scratch_path(spark, 'n')}.ssv")
    assert rows(files.read_delimited(spark, path, df.schema, multi_line=True)) == rows(df)
    assert df.select(text.escape_null(F.col("v"))).collect()[1][0] == "_NULL"


def test_unknown_extension(spark):
    with pytest.raises(ValueError):
        files.separator_for("x.txt")
    assert files.separator_for("a/b.psv", psv="|") == "|"


def test_workbook_arrays_objects_and_filter(spark, tmp_path):
    book = {
        "names": ["t", "u"],
        "tables": {
            "t": {"columns": ["a", "b"], "rows": [[1, "x"], [2, None]]},
            "u": {"columns": ["c"], "rows": [{"c": True}, {"d": 1}]},
        },
    }
    (tmp_path / "many.json").write_text(json.dumps(book))
    sheets = markup.read_workbook(spark, str(tmp_path / "many.json"))
    assert rows(sheets["t"]) == [("1", "x"), ("2", None)]
    assert rows(sheets["u"]) == rows(spark.createDataFrame([("true",), (None,)], "c string"))
    assert set(markup.read_workbook(spark, str(tmp_path / "many.json"), ["u"])) == {"u"}
    (tmp_path / "one.json").write_text(json.dumps({"s": book["tables"]["t"]}))
    assert set(markup.read_workbook(spark, str(tmp_path / "one.json"))) == {"s"}


def test_block_report(spark, tmp_path):
    rule = "-" * 50
    body = (
        "=== REPORT ===\nTotal Section: 3\nPass Rate: 33.3%\n\n"
        f"Section 1:\nJudul: # 1. Intro\nStatus: LULUS\nCatatan: fine\n\nsecond\n{rule}\n"
        f"Section 2:\nJudul: ## 1.1 What?\nStatus: TIDAK LULUS\nCatatan: no\n{rule}\n"
        f"Section 5:\nJudul: ## 1.2\nStatus: TIDAK LULUS [CATATAN] too long\nCatatan: a\n- b\n{rule}\n"
    )
    (tmp_path / "report.txt").write_text(body)
    assert rows(markup.read_block_report(spark, str(tmp_path / "report.txt"))) == [
        (1, "# 1. Intro", "LULUS", "fine\n\nsecond", True),
        (2, "## 1.1 What?", "TIDAK LULUS", "no", False),
        (5, "## 1.2", "TIDAK LULUS", "a\n- b", False),
    ]


def test_headings(spark):
    html = "<H2 class='x'>A <b>bold</b> &amp;lt; move</H2><h2></h2><p><h20>no</h20><h2\n>two\nlines</h2 >"
    df = spark.createDataFrame([(1, html), (2, "none")], "id long, html string")
    assert [r["title"] for r in markup.headings(df).collect()] == ["A bold &lt; move", "", "two\nlines"]


def test_jdbc_options():
    target = jdbc.Connection("jdbc:postgresql://host/db", {"user": "u", "driver": "d"})
    plain = jdbc.jdbc_options(target, "public.users", 500, None)
    assert plain["dbtable"] == "public.users" and plain["fetchsize"] == "500" and plain["user"] == "u"
    split = jdbc.jdbc_options(target, " SELECT * FROM t", 10, jdbc.KeyRange("id", 1, 100, 8))
    assert split["dbtable"] == "( SELECT * FROM t) q"
    assert (split["partitionColumn"], split["numPartitions"]) == ("id", "8")


def test_registered_sources(spark):
    declaration = registry.load_declaration("sources: [{name: shop, tables: [{name: items}, {name: buyers}]}]")
    assert registry.table_names(declaration) == {"shop": ["items", "buyers"]}
    path = sinks.write_staging(spark.range(3), scratch_path(spark, "src"))
    registry.register_sources(spark, declaration, {"items": path, "buyers": path})
    assert spark.table("shop__items").count() == 3


def test_table_sets(spark):
    database = scratch_database(spark)
    for name in ("a", "b", "c"):
        loads.replace_table(spark.range(2), f"{database}.{name}")
    assert set(registry.table_set(spark, database)) == {"a", "b", "c"}
    assert set(registry.table_set(spark, database, ["a", "b"], {"b": "z"})) == {"a", "z"}


def test_incremental_load_modes(spark):
    table = f"{scratch_database(spark)}.posts"
    df = spark.range(1, 6).withColumnRenamed("id", "id")
    assert loads.load(df, table, "incremental").mode == "replace"  # no table yet
    again = loads.load(spark.range(1, 9), table, "incremental")
    assert (again.mode, again.last_id) == ("append", 5)
    assert [r["id"] for r in spark.table(table).orderBy("id").collect()] == list(range(1, 9))
    assert loads.load(spark.range(2), table, "full").mode == "replace"
    assert spark.table(table).count() == 2
    with pytest.raises(ValueError):
        loads.load(df, table, "weekly")


def test_broken_constraint_writes_nothing(spark):
    table = f"{scratch_database(spark)}.t"
    df = spark.createDataFrame([("ok",), (None,)], "v string")
    with pytest.raises(quality.ConstraintError):
        loads.load_constrained(df, table, [quality.Rule("v")])
    assert not spark.catalog.tableExists(table)


def test_trim_blank(spark):
    grid = spark.createDataFrame(
        [(0, "h1", "h2", "", None), (1, "a", None, None, ""), (2, "b", "", None, ""), (3, "c", "", "late", ""), (4, "", None, "", "")],
        "pos long, c0 string, c1 string, c2 string, c3 string",
    )
    trimmed = changes.trim_blank(grid, "pos")
    assert trimmed.columns == ["pos", "c0", "c1", "c2"] and trimmed.count() == 4


def test_changes_match_null_conditions(spark):
    t = spark.createDataFrame([(1, None, 1), (2, "a", 2), (3, "b", 3)], "k long, c string, v long")
    out = changes.apply_changes(
        t,
        ["c"],
        updates=spark.createDataFrame([(None, 10)], "c string, v long"),
        deletes=spark.createDataFrame([("b",)], "c string"),
        inserts=spark.createDataFrame([(9, "z")], "k long, c string"),
    )
    assert rows(out) == [(1, None, 10), (2, "a", 2), (9, "z", None)]


def test_models(spark):
    project = example_project()
    assert project.order(["second"]) == ["first", "second"]
    assert (project.materialization("first"), project.materialization("second")) == ("table", "view")
    ids = spark.createDataFrame([(1,), (5,)], "p_size int")
    built = project.run(spark, {"ids": ids, "gaps": spark.range(1)}, scratch_database(spark))
    report = {(r["model"], r["test"]): r["violations"] for r in project.test(built).collect()}
    assert report == {("first", "unique"): 0, ("first", "not_null"): 1, ("second", "unique"): 0, ("second", "not_null"): 0}
    order = sales.sales_project().order(["view_customer_product_sales"])
    assert order[-1] == "view_customer_product_sales" and set(order[:-1]) == {"fact_sales", "dim_customers", "dim_products"}
    with pytest.raises(ValueError):
        project.add(Model("first", lambda: None))
    odd = Project()
    odd.add(Model("x", lambda: None, materialized="cube"))
    with pytest.raises(ValueError):
        odd.materialization("x")


def test_parameters(spark):
    spark.range(10).createOrReplaceTempView("ten")
    sql = "SELECT count(*) AS n FROM ten WHERE id >= :low"
    assert param_query(spark, sql, {"low": 0}, {"low": 7}).first()["n"] == 3
    with pytest.raises(KeyError):
        param_query(spark, sql, {"low": 0}, {"high": 1})
    specs = specs_from("[orders, {name: t, ingest_type: incremental, key: k, columns: [k]}]")
    assert specs == [TableSpec("orders"), TableSpec("t", "incremental", "k", ("k",))]


def _news(spark):
    data = [
        # seq, title, description, url, category, source_category, tags, updated, live
        (1, "A", "d", "u1", "c1", "s1", "x, y ,,x", "01-02-2025", "Yes"),
        (2, "A2", "d2", "u1", "c1", "s1", "x", "1/2/2025", None),
        (3, "B", "d", "u2", None, "s1", "x", "02-02-2025", "No"),
        (4, "C", None, "u3", "c1", "s2", "z", "02-02-2025", "Yes"),
        (5, "D", "d", "u4", "c2", "s1", None, "03-02-2025", "Yes"),
        (6, "E", "d", "u5", "c9", "s9", "q", None, "Yes"),
        (7, "F", "d", "u6", "c1", "s1", "x", "someday", "Yes"),
    ]
    return spark.createDataFrame(
        data, "seq long, title string, description string, url string, category string, source_category string, tags string, "
        "updated string, live string"
    )


def _written(star):
    return Star(**{n: materialize(getattr(star, n), n) for n in Star.__dataclass_fields__})


def test_star_load_and_reload(spark):
    source = _news(spark)
    star = _written(load_star(source))
    assert rows(star.dim_category) == [(1, "c1"), (2, "c2")]
    assert rows(star.dim_tag.select("name")) == [("x",), ("y",), ("z",)]
    assert rows(star.dim_article.select("url", "title")) == [("u1", "A"), ("u2", "B"), ("u4", "D")]
    # u1 with tags x and y on one date, first row wins; the column in_pagination is missing
    assert sorted(tuple(r)[-2:] for r in star.fact_news.collect()) == [(True, False)] * 2
    reasons = {r["seq"]: r["reject_reason"] for r in rejects(source, star).collect()}
    assert reasons == {3: "category", 4: "article", 6: "date_null", 7: "date"}
    assert lookup(source, star).count() == 7
    again = load_star(source, star)
    for name in Star.__dataclass_fields__:
        assert rows(getattr(again, name)) == rows(getattr(star, name)), name
    more = source.filter("seq = 1").withColumns({"seq": F.lit(8).cast("long"), "url": F.lit("u0"), "category": F.lit("a0")})
    grown = load_star(source.unionByName(more), star)
    assert rows(grown.dim_category) == [(1, "c1"), (2, "c2"), (3, "a0")]
    assert grown.fact_news.count() == 4


def test_star_tables_are_loaded_once(spark):
    source, database = _news(spark), scratch_database(spark)
    for _ in range(2):
        star = load_star_tables(source, database)
        assert star.fact_news.count() == 2 and star.dim_article.count() == 3 and star.dim_date.count() == 3
    assert rows(star.dim_category) == [(1, "c1"), (2, "c2")]


def test_a_broken_load_is_not_seen(spark, monkeypatch):
    source, database = _news(spark), scratch_database(spark)
    load_star_tables(source.filter("seq = 1"), database)
    before = {n: rows(getattr(read_star(spark, database), n)) for n in Star.__dataclass_fields__}

    def broken(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as patched:
        patched.setattr(warehouse, "new_facts", broken)
        with pytest.raises(RuntimeError):
            load_star_tables(source, database)
    assert spark.table(f"{database}.dim_article").count() > len(before["dim_article"])
    assert {n: rows(getattr(read_star(spark, database), n)) for n in Star.__dataclass_fields__} == before
    star = load_star_tables(source, database)
    assert star.fact_news.count() == 2 and star.dim_article.count() == 3
    assert star.dim_article.select("news_id").distinct().count() == 3


def test_of_two_loads_that_finish_together_one_fails(spark, monkeypatch):
    source, database = _news(spark), scratch_database(spark)
    load_star_tables(source.filter("seq = 1"), database)
    finish = warehouse._finish

    def late(log, version, loads):
        # another load commits between this one's last table and its own commit
        monkeypatch.setattr(warehouse, "_finish", finish)
        load_star_tables(source.filter("seq < 3"), database)
        finish(log, version, loads)

    monkeypatch.setattr(warehouse, "_finish", late)
    with pytest.raises(RuntimeError, match="another load"):
        load_star_tables(source, database)
    star = load_star_tables(source, database)
    assert star.dim_article.select("news_id").distinct().count() == star.dim_article.count() == 3
    before = {n: rows(getattr(star, n)) for n in Star.__dataclass_fields__}
    star = warehouse.compact_star(spark, database)
    assert {n: rows(getattr(star, n)) for n in Star.__dataclass_fields__} == before
    assert len(warehouse._loads(spark, database).latest()[1]) == 1
    assert warehouse.remove_unread(spark, database) >= 3 and warehouse.remove_unread(spark, database) == 0
    assert {n: rows(getattr(read_star(spark, database), n)) for n in Star.__dataclass_fields__} == before
    assert load_star_tables(source, database).fact_news.count() == len(before["fact_news"])


def test_versions_are_written_once(spark, tmp_path):
    log, other = (CommitLog(spark, f"{tmp_path}/log") for _ in range(2))
    assert log.latest("none") == (0, "none")
    log.commit(1, ["a"])
    with pytest.raises(VersionTaken):
        other.commit(1, ["b"])
    (tmp_path / "log" / f"{2:020d}.json").write_text("[")  # a writer that died
    assert other.latest() == (2, ["a"])
    other.commit(3, ["a", "c"])
    other.forget(3)
    assert log.latest() == (3, ["a", "c"]) and log._numbers() == [3]


def test_news_flow_from_csv(spark):
    source = _news(spark).filter("seq < 7")
    path, staging = scratch_path(spark, "csv"), scratch_path(spark, "staging")
    sinks.write_csv(source, path)
    schema = ", ".join(f"{c} {t}" for c, t in source.dtypes)
    star = news.load_news(spark, path, schema, staging, scratch_database(spark))
    # every gap is filled: texts with the most frequent value, the last date with the one before it
    assert rows(star.dim_article.select("url")) == [("u1",), ("u2",), ("u3",), ("u4",), ("u5",)]
    assert star.fact_news.count() == 2 + 1 + 1 + 1 + 1 and star.dim_date.count() == 3


def test_cleaned_load_can_be_repeated(spark):
    star = _written(load_star(_news(spark)))
    cleaned = materialize(news.cleaned_rows(star, datetime(2025, 1, 1)), "cleaned")
    table = f"{scratch_database(spark)}.dim_cleaned"
    for mode, size in (("skip_existing", 1), ("skip_existing", 1), ("append", 2)):
        news.load_cleaned(cleaned, table, mode)
        assert spark.table(table).count() == size
    assert sorted(r["cleaned_id"] for r in spark.table(table).collect()) == [1, 2]
    with pytest.raises(ValueError):
        news.load_cleaned(cleaned, table, "maybe")


def test_cleaned_load_sorts_and_compares_keys_alone(spark):
    """Two runs write long texts to the table and nowhere else; what is new in the second is numbered after the first."""
    rng = random.Random(8)
    day, letters = datetime(2024, 5, 1), "abcdefghijklmnopqrstuvwxyz0123456789"
    texts = ["".join(rng.choices(letters, k=3000)) for _ in range(60)]
    data = [(f"t{i}", "c", day, f"u{i:02}", t, day) for i, t in enumerate(texts)]
    kinds = "title string, category string, publication_date timestamp_ntz, url string, summary string, processed_date timestamp_ntz"
    first, both = (spark.createDataFrame(x, kinds) for x in (data[20:], [*data, data[3]]))
    table = f"{scratch_database(spark)}.dim_cleaned"
    root = Path(scratch_path(spark, "x")).parent
    seen = set(root.iterdir())
    for _ in range(2):
        news.load_cleaned(first, table)
    written = sum(f.stat().st_size for d in set(root.iterdir()) - seen for f in d.rglob("*.parquet"))
    assert written < sum(map(len, texts[20:])) / 4
    news.load_cleaned(both, table)
    found = {r["cleaned_id"]: (r["url"], r["summary"]) for r in spark.table(table).collect()}
    order = [*data[20:], *data[:4], data[3], *data[4:20]]  # a repeated key takes two numbers
    assert found == {i: (r[3], r[4]) for i, r in enumerate(order, 1)}


@pytest.mark.parametrize("odd", [[], [("b", 1, "again")], [(None, 1, "no key")]])
def test_keys_of_wide_rows_are_those_of_narrow_ones(spark, odd):
    data = [("c", 2, "x"), ("a", 1, "y"), ("b", 1, "z"), ("b", 0, "w"), ("d", 5, "v"), *odd]
    new = spark.createDataFrame(data, "k string, n long, t string").repartition(3)
    known = spark.createDataFrame([(7, "d", 5, "old")], "id long, k string, n long, t string")
    for existing in (None, known):
        got, want = ([(r["id"], r["k"], r["n"]) for r in warehouse.assign_keys(new, existing, "id", ["k", "n"], wide).collect()] for wide in (True, False))
        assert sorted(got, key=repr) == sorted(want, key=repr) and len(got) == len(data)


def test_punctuation_is_unicode_aware(spark):
    df = spark.createDataFrame([("héllo, wörld! x_1 … “q” ¼²",)], "t string")
    assert df.select(text.strip_punctuation("t")).first()[0] == "héllo wörld x_1  q ¼²"


def test_state_keeps_the_last_write(spark):
    state = StateTable(spark, scratch_path(spark, "state"))
    assert state.get("k", 0) == 0
    state.set("k", {"nama": "x"})
    state.set("k", {"nama": "y"}, seq=1)
    state.set("other", 5)
    assert state.get("k") == {"nama": "y"} and state.current().count() == 2


def test_intervals(spark):
    days = intervals.daily_intervals(spark, "2024-03-30", "2024-04-01", "Europe/Berlin", "09:30:00")
    starts = [r["interval_start"] for r in days.orderBy("day").collect()]
    assert starts == [datetime(2024, 3, 30, 8, 30), datetime(2024, 3, 31, 7, 30), datetime(2024, 4, 1, 7, 30)]
    df = spark.createDataFrame([(datetime(2024, 1, 1, 2, 29, 59),), (datetime(2024, 1, 1, 2, 30),)], "ts timestamp_ntz")
    got = [r[0] for r in df.select(intervals.interval_start("ts")).collect()]
    assert got == [datetime(2023, 12, 31, 2, 30), datetime(2024, 1, 1, 2, 30)]
    branches = df.select(temporal.even_minute("ts")).collect()
    assert [r[0] for r in branches] == [False, True]


def test_file_arrival(spark):
    landing, target, offsets = (scratch_path(spark, x) for x in ("landing", "target", "offsets"))
    for i in range(2):
        spark.range(i * 10, i * 10 + 10).write.parquet(f"{landing}/{i}")
        stream = landing_stream(spark, f"{landing}/*", spark.range(1).schema)
        ingest_files(stream, target, offsets).awaitTermination()
    assert [r["id"] for r in spark.read.parquet(target).orderBy("id").collect()] == list(range(20))


def test_repeated_batch_changes_nothing(spark):
    schema = spark.createDataFrame([], "id long, v string").schema
    state = StateTable(spark, scratch_path(spark, "state"))
    sink = IncrementalSink(spark, scratch_path(spark, "sink"), schema, "id", ["v"], state)
    first = spark.createDataFrame([(1, "a"), (2, "b"), (2, "a")], schema)
    second = spark.createDataFrame([(2, "x"), (3, "c")], schema)
    for batch, batch_id in ((first, 0), (first, 0), (second, 1), (second, 1)):
        sink.write(batch, batch_id)
    assert rows(sink.rows(spark).drop("batch_id")) == [(1, "a"), (2, "a"), (3, "c")]
    assert state.get("last_batch") == 1


def test_upsert_stream_resumes(spark):
    schema = spark.createDataFrame([], "id long, v string").schema
    landing, offsets = scratch_path(spark, "landing"), scratch_path(spark, "offsets")
    sink = IncrementalSink(spark, scratch_path(spark, "sink"), schema, "id", ["v"], StateTable(spark, scratch_path(spark, "s")))
    for i in range(2):
        spark.createDataFrame([(i, "a"), (1, "b")], schema).write.parquet(f"{landing}/{i}")
        upsert_stream(landing_stream(spark, f"{landing}/*", schema), sink, offsets).awaitTermination()
    assert rows(sink.rows(spark).select("id")) == [(0,), (1,)]


def test_scratch_of_the_application_is_removed(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(runtime, "scratch_root", lambda _: f"{tmp_path}/own")
    materialize(spark.range(5), "t")
    name = scratch_database(spark)
    spark.range(3).write.saveAsTable(f"{name}.t")
    runtime.drop_scratch(spark)
    assert not list(tmp_path.iterdir()) and not spark.catalog.databaseExists(name)


@pytest.mark.parametrize("seed", [1, 2])
def test_line_breaks_in_quotes_are_read_in_splits(spark, tmp_path, seed):
    """Random records over many small splits, with doubled and stray quotes and both kinds of line ends."""
    rng = random.Random(seed)
    want = []
    for f in range(2):
        end = rng.choice(["\n", "\r\n"])
        made = [
            (str(i), "".join(rng.choices(["a", '"', "\n", ",", "é", "\r\n", "x" * 40, ""], k=rng.randint(0, 12))), rng.choice(["plain", '5" x', "", "a b"]))
            for i in range(60)
        ]
        with open(tmp_path / f"{f}.csv", "w", newline="", encoding="utf8") as out:
            out.write(f"id,te xt,third{end}")
            for a, b, c in made:
                quoted = b.replace('"', '""')
                out.write(f'{a},"{quoted}",{c}{end}')
        want += made
    size = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(size)
    spark.conf.set(size, "300")
    try:
        assert spark.read.text(str(tmp_path)).rdd.getNumPartitions() > 4
        assert sorted(map(tuple, files.read_csv_strings(spark, str(tmp_path)).collect())) == sorted(want)
        typed = files.read_csv(spark, str(tmp_path))
        assert typed.dtypes == [("id", "bigint"), ("te xt", "string"), ("third", "string")] and typed.count() == 120
        raw = [tuple(r["fields"]) for r in files.read_csv_raw(spark, str(tmp_path)).collect()]
        assert sorted(raw) == sorted(want + [("id", "te xt", "third")] * 2)
    finally:
        spark.conf.set(size, before)


def test_unlike_updates_of_one_key_are_refused(spark):
    table = spark.createDataFrame([(1, "a"), (2, "b")], "k long, v string")
    same = spark.createDataFrame([(1, "x"), (1, "x")], "k long, v string")
    assert rows(changes.apply_changes(table, ["k"], updates=same)) == [(1, "x"), (2, "b")]
    with pytest.raises(ValueError, match="unlike updates"):
        changes.apply_changes(table, ["k"], updates=same.unionAll(table))
