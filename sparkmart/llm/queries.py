"""The registered queries of this subpackage and, where SQL can express them, their DuckDB counterparts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkmart.llm import char_models, gam, jaccard_join, licences, nn_descent, packing, phrases, prefix_trie, quality_rules, unigram_count, url_filter, word_bpe, zip_warc

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

_WORDS = r"'[^\x20\x09-\x0D]+'"


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql.strip()
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: host, path, action of the fixed rules
URL_RULES = (("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow"))


@query("op5_url_filter", r"""
WITH p AS (
  SELECT page_id, coalesce(translate(regexp_extract(url, '(?s)\A.*?://([^/?#]*)', 1),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
    coalesce(regexp_extract(url, '(?s)\A.*?://[^/?#]*([^?#]*)', 1), '') AS path FROM pages
), r(rh, rp, action) AS (VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')),
best AS (
  SELECT p.*, (SELECT min({'len': -length(rh || rp), 'rule': rh || rp, 'action': action}) FROM r
    WHERE (host = rh OR ends_with(host, '.' || rh)) AND starts_with(path, rp)) AS b FROM p
)
SELECT page_id, host, path, b.rule AS rule, coalesce(b.action, 'allow') AS verdict FROM best
""")
def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(list(URL_RULES), "host string, path string, action string")
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return url_filter.verdicts(pages, rules).select("page_id", "host", "path", "rule", "verdict")


_SHIFT = f"greatest(0, length(bin(value)) - {quality_rules.BITS})"
_RULES_SQL = rf"""
WITH w AS (
  SELECT row_number() OVER () AS r, doc_id, lang, source, coalesce(text, '') AS text FROM documents
), t AS (
  SELECT r, doc_id, lang, source, text, regexp_extract_all(text, {_WORDS}) AS words FROM w
), win AS (
  SELECT r, i, words[i:i + 2] AS three FROM (SELECT r, words, unnest(range(1, len(words) - 1)) AS i FROM t)
), cover AS (
  SELECT r, count(DISTINCT i + k) AS n_repeat_words
  FROM (SELECT r, i, count(*) OVER (PARTITION BY r, three) AS times FROM win), (SELECT unnest([0, 1, 2]) AS k)
  WHERE times > 1 GROUP BY r
), ln AS (
  SELECT r, line, count(*) AS times FROM (SELECT r, unnest(string_split(text, chr(10))) AS line FROM t)
  WHERE regexp_matches(line, {_WORDS}) GROUP BY r, line
), dup AS (
  SELECT r, sum(times)::BIGINT AS n_lines, sum(times - 1)::BIGINT AS n_dup_lines FROM ln GROUP BY r
), c AS (
  SELECT r, doc_id, lang, source, len(words)::BIGINT AS n_words,
    coalesce(length(array_to_string(words, '')), 0)::BIGINT AS word_chars,
    (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
    coalesce(n_lines, 0) AS n_lines, coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words
  FROM t LEFT JOIN dup USING (r) LEFT JOIN cover USING (r)
), b AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM c
), v AS (
  SELECT r, lang, source, unnest([{{'metric': 'symbols', 'value': 1000 * n_symbols // n_words}},
    {{'metric': 'dup_lines', 'value': 1000 * n_dup_lines // greatest(n_lines, 1)}},
    {{'metric': 'repeats', 'value': 1000 * n_repeat_words // n_words}},
    {{'metric': 'word_length', 'value': 1000 * word_chars // n_words}},
    {{'metric': 'words', 'value': n_words}}, {{'metric': 'lines', 'value': greatest(n_lines, 1)}}], recursive := true) FROM b WHERE NOT base_failed
), s AS (
  SELECT lang, source, metric, (value >> {_SHIFT}) << {_SHIFT} AS bucket FROM v
), level AS (
  SELECT lang, source, metric, bucket, count(*) AS n, grouping(lang) + grouping(source) AS up
  FROM s GROUP BY GROUPING SETS ((lang, source, metric, bucket), (lang, metric, bucket), (metric, bucket))
), run AS (
  SELECT *, sum(n) OVER (PARTITION BY up, lang, source, metric ORDER BY bucket) AS upto, sum(n) OVER (PARTITION BY up, lang, source, metric) AS total FROM level
), q AS (
  SELECT up, lang, source, metric, max(total) AS n, min(bucket) FILTER (upto * 1000 >= total * 250) AS q250, min(bucket) FILTER (upto * 1000 >= total * 500) AS q500,
    min(bucket) FILTER (upto * 1000 >= total * 750) AS q750, min(bucket) FILTER (upto * 1000 >= total * 999) AS q999
  FROM run GROUP BY up, lang, source, metric
), own AS (
  SELECT l.up, l.lang, l.source, l.metric, l.n::HUGEINT AS n, CASE l.metric WHEN 'symbols' THEN l.q750 + 24000 // w.q500 WHEN 'dup_lines' THEN l.q999 + 1000 // k.q500
      WHEN 'repeats' THEN l.q999 + 12000 // w.q500 ELSE l.q500 + 14 * greatest(least(l.q500 - l.q250, l.q750 - l.q500), 75) END AS high,
    CASE l.metric WHEN 'word_length' THEN l.q500 - 14 * greatest(least(l.q500 - l.q250, l.q750 - l.q500), 75) ELSE 0 END AS low
  FROM q l JOIN q w ON w.metric = 'words' AND w.up = l.up AND w.lang IS NOT DISTINCT FROM l.lang AND w.source IS NOT DISTINCT FROM l.source
  JOIN q k ON k.metric = 'lines' AND k.up = l.up AND k.lang IS NOT DISTINCT FROM l.lang AND k.source IS NOT DISTINCT FROM l.source
  WHERE l.metric NOT IN ('words', 'lines')
), fence AS (
  SELECT o.lang, o.source, o.metric,
    (o.n * o.low + {quality_rules.MIX} * ((t.n * t.low + {quality_rules.MIX} * g.low) // (t.n + {quality_rules.MIX}))) // (o.n + {quality_rules.MIX}) AS low,
    (o.n * o.high + {quality_rules.MIX} * ((t.n * t.high + {quality_rules.MIX} * g.high) // (t.n + {quality_rules.MIX}))) // (o.n + {quality_rules.MIX}) AS high
  FROM own o JOIN own t ON t.up = 1 AND t.metric = o.metric AND t.lang IS NOT DISTINCT FROM o.lang JOIN own g ON g.up = 2 AND g.metric = o.metric WHERE o.up = 0
), bad AS (
  SELECT DISTINCT r FROM v JOIN fence f ON v.metric = f.metric AND v.lang IS NOT DISTINCT FROM f.lang AND v.source IS NOT DISTINCT FROM f.source
  WHERE value > high OR value < low
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND r NOT IN (SELECT r FROM bad) AS kept FROM b
"""


@query("op10_quality_rules", _RULES_SQL)
def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    rows, counts, kept = quality_rules.judge(docs, ["doc_id"])
    return rows.select(
        "doc_id",
        *[F.col(f"{counts}.{c}") for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")],
        quality_rules.base_failed(counts).alias("base_failed"),
        F.col(kept).alias("kept"),
    )


@query("op8_jaccard_join", rf"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), {_WORDS}) AS words
  FROM documents
), s AS (
  SELECT DISTINCT doc_id, CASE WHEN len(words) < 5 THEN words ELSE words[i:i + 4] END AS shingle
  FROM (SELECT doc_id, words, unnest(range(1, greatest(len(words) - 4, least(len(words), 1)) + 1)) AS i FROM w)
), n AS (
  SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
), h AS (
  SELECT doc_id, md5(array_to_string(shingle, ' ')) AS h FROM s
), o AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS k FROM h x JOIN h y ON x.h = y.h AND x.doc_id <> y.doc_id GROUP BY ALL
), link AS (
  SELECT a, b FROM o JOIN n x ON a = x.doc_id JOIN n y ON b = y.doc_id WHERE 100 * k >= 75 * (x.n + y.n - k)
), reach AS (
  SELECT a, b FROM link UNION SELECT r.a, l.b FROM reach r JOIN link l ON r.b = l.a
), least AS (
  SELECT a, min(b) AS b FROM reach GROUP BY a
)
SELECT doc_id, coalesce(n, 0) AS n_shingles, least(doc_id, coalesce(b, doc_id)) AS component_id
FROM w LEFT JOIN n USING (doc_id) LEFT JOIN least ON doc_id = a
""")
def op8_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return jaccard_join.jaccard_components(docs).select(
        F.col("id").alias("doc_id"), "n_shingles", F.col("component").alias("component_id")
    )


@query("op9_quality_classifier")
def op9_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = gam.train(docs, table(spark, sf_dir, "labels"))
    rows = gam.scored(docs, model, "score", keep=["doc_id"])
    return rows.select(
        "doc_id", gam.held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= gam.LEAST).cast("int").alias("predicted")
    )


@query("op2_best_fit_packing")
def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


@query("op3_word_bpe")
def op3_word_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = word_bpe.round_trip(table(spark, sf_dir, "documents"))
    return rows.select(
        F.col("id").alias("doc_id"),
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(" ", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query("op4_zip_warc", f"""
WITH p AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages
), f AS (
  SELECT *, CASE WHEN payload_bytes >= {zip_warc.SMALLEST_REVISIT} THEN min(page_id) OVER (PARTITION BY payload_digest) ELSE page_id END AS first FROM p
)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> first THEN first END AS refers_to FROM f
""")
def op4_zip_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    kind = pages.schema["page_id"].dataType
    rows = zip_warc.round_trip(pages)
    return rows.select(
        F.col("page").cast(kind).alias("page_id"),
        "payload_bytes",
        F.when(F.col("type") == "response", F.sha2("payload", 256)).otherwise(F.col("declared")).alias("payload_digest"),
        F.col("type").alias("record_type"),
        F.col("refers_to").cast(kind).alias("refers_to"),
    )


@query("op6_token_counts")
def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return unigram_count.counted(table(spark, sf_dir, "documents"), keep=["doc_id"])


def _licence_sql() -> str:
    known = ", ".join(f"('{licences.reduced(s)}', '{name}')" for name, s in licences.SENTENCES)
    cut = "text"
    for pattern, by in licences.CUTS:
        cut = f"regexp_replace({cut}, '{pattern}', '{by}', 'g')".replace("$1", r"\1").replace("\x01", "' || chr(1) || '").replace("\x02", "' || chr(2) || '")
    steps = []
    for i, (licence, names) in enumerate(licences.RULES):
        want = "".join(f"<{n}>" for n in names)
        when = f"contains(rest, '{want}') AND NOT list_contains(hits, '{licence}')" + (" AND len(hits) = 0" if licence in licences.LAST_RESORT else "")
        steps.append(
            f"s{i + 1} AS (SELECT doc_id, n_known, replace(rest, '{want}', '|') AS rest, "
            f"CASE WHEN {when} THEN list_append(hits, '{licence}') ELSE hits END AS hits FROM s{i})"
        )
    return rf"""
WITH known(sentence, name) AS (VALUES {known}),
cut AS (
  SELECT doc_id, string_split(regexp_replace(translate({cut}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^a-z0-9' || chr(1) || chr(2) || ']+', ' ', 'g'), chr(1)) AS parts FROM documents
), segment AS (
  SELECT doc_id, place, list_filter(list_transform(string_split(part, chr(2)), lambda x: trim(x)), lambda x: x <> '') AS lines
  FROM (SELECT doc_id, unnest(range(1, len(parts) + 1)) AS place, unnest(parts) AS part FROM cut)
), line AS (
  SELECT doc_id, place, lines, len(lines) AS n, unnest(range(1, len(lines) + 1)) AS first FROM segment
), run AS (
  SELECT doc_id, place, n, first, k AS last, array_to_string(lines[first:k], ' ') AS sentence
  FROM (SELECT *, unnest(range(first, least(first + {licences.longest_run()}, n + 1))) AS k FROM line)
), seen AS (
  SELECT * FROM run JOIN known USING (sentence)
), whole AS (
  SELECT * FROM seen x WHERE NOT EXISTS (
    FROM seen y WHERE y.doc_id = x.doc_id AND y.place = x.place AND y.first <= x.first AND y.last >= x.last AND y.last - y.first > x.last - x.first)
), s0 AS (
  SELECT doc_id, count(*) AS n_known, string_agg(CASE WHEN gap THEN '|' ELSE '' END || '<' || name || '>', '' ORDER BY place, first) AS rest,
    []::VARCHAR[] AS hits
  FROM (
    SELECT *, CASE WHEN place = lag(place) OVER w THEN first > lag(last) OVER w + 1
      ELSE place > lag(place) OVER w + 1 OR first > 1 OR lag(last) OVER w < lag(n) OVER w END AS gap
    FROM whole WINDOW w AS (PARTITION BY doc_id ORDER BY place, first)
  ) GROUP BY doc_id
), {', '.join(steps)}
SELECT doc_id, coalesce(array_to_string(hits, ','), '') AS licences, coalesce(n_known, 0) AS n_known,
  coalesce(length(rest) - length(replace(rest, '<', '')), 0) AS n_unmatched
FROM documents LEFT JOIN s{len(licences.RULES)} USING (doc_id)
"""


@query("op7_licence_scan", _licence_sql())
def op7_licence_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.recognised(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


@query("op1_nn_descent", """
WITH RECURSIVE v AS (
  SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), link AS (
  SELECT x.vec_id AS a, y.vec_id AS b FROM v x JOIN v y ON x.vec_id <> y.vec_id AND len(x.e) = len(y.e)
  WHERE list_cosine_similarity(x.e, y.e) >= 0.9
), reach AS (
  SELECT a, b FROM link UNION SELECT r.a, l.b FROM reach r JOIN link l ON r.b = l.a
), c AS (
  SELECT vec_id, (SELECT count(*) FROM link WHERE a = vec_id) AS n_links,
    least(vec_id, coalesce((SELECT min(b) FROM reach WHERE a = vec_id), vec_id)) AS component_id FROM embeddings
)
SELECT *, vec_id = component_id AS kept FROM c
""")
def op1_nn_descent(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, _ = nn_descent.near_vectors(table(spark, sf_dir, "embeddings"))
    return rows.select(
        F.col("id").alias("vec_id"), "n_links", F.col("component").alias("component_id"), (F.col("id") == F.col("component")).alias("kept")
    )


@query("op11_phrases", r"""
WITH piece AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(text,
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents
), t AS (
  SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM piece
), total AS (
  SELECT lang, sum(len(w))::HUGEINT AS n FROM t GROUP BY lang
), f AS (
  SELECT lang, g, count(*)::HUGEINT AS f FROM (
    SELECT lang, w[i:i + k - 1] AS g FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM t, (SELECT unnest(range(1, 6)) AS k)))
  GROUP BY lang, g HAVING count(*) >= 100
), c AS (
  SELECT lang, g, f AS a FROM f WHERE len(g) > 1
), inside AS (
  SELECT lang, sub, max(a) AS most FROM (
    SELECT lang, a, g, k, unnest([g[i:i + k - 1] for i in range(1, len(g) - k + 2)]) AS sub FROM c, (SELECT unnest(range(2, 5)) AS k) WHERE k < len(g))
  GROUP BY lang, sub
), cut AS (
  SELECT c.lang, c.g, c.a, n, k, x.f AS l, y.f AS r, 1000 * c.a * n // (x.f * y.f) AS score
  FROM (SELECT *, unnest(range(1, len(g))) AS k FROM c) c JOIN total USING (lang)
  JOIN f x ON x.lang = c.lang AND x.g = c.g[1:k] JOIN f y ON y.lang = c.lang AND y.g = c.g[k + 1:]
), best AS (
  SELECT * FROM cut QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, k) = 1
), named AS (
  SELECT best.*, array_to_string(g, ' ') AS phrase FROM best LEFT JOIN inside i ON i.lang = best.lang AND i.sub = best.g WHERE coalesce(most < a, true)
)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase,
  a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n::BIGINT AS n, score::BIGINT AS score
FROM named QUALIFY rank <= 2000
""")
def op11_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(table(spark, sf_dir, "documents"))


@query("op12_prefix_trie", r"""
WITH crc AS (
  SELECT [list_reduce(list_concat([i], range(8)), lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END)
    for i in range(256)] AS t
), turns AS (
  SELECT conv_id, list({'role': coalesce(role, ''), 'text': coalesce(text, '')} ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS s
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id
), head AS (
  SELECT conv_id, s, xor(list_reduce(list_concat([4294967295], [ascii(x)::BIGINT for x in string_split(conv_id::VARCHAR, '')]),
    lambda c, b: xor(c // 256, t[xor(c, b) % 256 + 1])), 4294967295) % 6 AS h FROM turns, crc
), whole AS (
  SELECT a.conv_id, list_concat(coalesce(b.s[1:h], []), a.s[h + 1:]) AS s FROM head a LEFT JOIN turns b ON b.conv_id = a.conv_id - a.conv_id % 100
), node AS (
  SELECT path, depth, min(conv_id) AS conv_id, count(*) AS n_convs, depth > 0 AS inner,
    sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (last), '')) AS ends_sha256
  FROM (SELECT conv_id, s[1:d] AS path, d AS depth, len(s) = d AS last FROM (SELECT conv_id, s, unnest(range(0, len(s) + 1)) AS d FROM whole))
  GROUP BY path, depth
), child AS (
  SELECT path[1:depth - 1] AS up, count(*) AS n FROM node WHERE depth > 0 GROUP BY up
), own AS (
  SELECT node.*, coalesce(n, 0) AS n_children, (n_convs - 1) * CASE WHEN depth > 0 THEN length(path[depth].text) ELSE 0 END AS saved
  FROM node LEFT JOIN child ON up = path
), sums AS (
  SELECT top, count(*) FILTER (n_children = 0) AS n_leaves, sum(saved)::BIGINT AS saved_tokens
  FROM (SELECT path[1:d] AS top, n_children, saved FROM (SELECT *, unnest(range(0, depth + 1)) AS d FROM own)) GROUP BY top
)
SELECT o.conv_id, o.depth, p.conv_id AS parent_conv_id, o.n_convs, o.n_children, n_leaves, saved_tokens, o.ends_sha256
FROM own o JOIN sums ON top = o.path LEFT JOIN node p ON o.depth > 0 AND p.depth = o.depth - 1 AND p.path = o.path[1:o.depth - 1]
""")
def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.prefix_trie(table(spark, sf_dir, "conversations"))


@query("op13_char_models")
def op13_char_models(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    rows, lang, score, rejected = char_models.identified(docs, char_models.learned(docs), keep=["doc_id"])
    return rows.select("doc_id", char_models.held_out(F.col("doc_id")).alias("held_out"), lang, score, rejected)
