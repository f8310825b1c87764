"""The registered queries of this subpackage: each applies its operator to whole tables."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from migrascope.llm import (
    chat,
    decontaminate,
    hnsw,
    jaccard,
    language,
    license_scan,
    mixing,
    prefix_trie,
    repair,
    secrets,
    substring,
    toxicity,
    url_filter,
)
from migrascope.llm.common import fresh, row_key, saved, ship, table

Query = Callable[[SparkSession, str], DataFrame]

URL_RULES = [
    url_filter.Rule("com/", url_filter.ALLOW),
    url_filter.Rule("example.com/en/", url_filter.BLOCK),
    url_filter.Rule("www.example.com/en/", url_filter.ALLOW),
    url_filter.Rule("net/es/", url_filter.BLOCK),
    url_filter.Rule("net/fr/", url_filter.BLOCK),
]
TOXIC_FROM = 0.3
REPEAT_WORDS = 50
MIX_FRACTION = 0.5
NGRAM_RULE = jaccard.Rule(shingle=4, percent=85)


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict on every page. The small labelled table holds urls that the rules decide."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    located = pages.select("url", url_filter.host_of(F.col("url")).alias("host"), url_filter.path_of(F.col("url")).alias("path"))
    ruled = located.select("url", url_filter.rule_columns(URL_RULES)["rule_verdict"].alias("verdict"))
    label = (F.col("verdict") == url_filter.BLOCK).cast("int")
    model = url_filter.train(url_filter.labelled_sample(ruled, "url", label))
    return url_filter.judge(pages, URL_RULES, model).select("page_id", "host", "path", "rule", "verdict", "score")


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.learn(docs, table(spark, sf_dir, "labels"))
    return toxicity.add_score(docs, model).select(
        "doc_id",
        toxicity.held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= TOXIC_FROM).cast("int").alias("predicted"),
    )


def op3_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and conversation -7, which comes as a record of messages."""
    turns = chat.turns_of_table(table(spark, sf_dir, "conversations"))
    said = "\\### Assistant: </turn> ok"
    record = F.to_json(
        F.struct(
            F.array(
                *(F.struct(F.lit(r).alias("role"), F.lit(said).alias("content")) for r in ("user", "assistant"))
            ).alias("messages")
        )
    )
    own = spark.range(1).select(F.lit(-7).cast("long").alias("conv_id"), record.alias("record"))
    added = chat.turns_of_records(own, "conv_id", "record").drop("layout")
    return chat.read_back(chat.segments(turns.unionByName(added)))


def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(table(spark, sf_dir, "documents"))


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark passage, with the passage and how it was told."""
    return decontaminate.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = substring.identified(table(spark, sf_dir, "documents"))
    return substring.kept(docs, substring.repeated(docs, REPEAT_WORDS), REPEAT_WORDS)


def measured(docs: DataFrame) -> DataFrame:
    """Documents with their topic, told by plain markers, and their words; names that are taken grow longer."""
    text = F.coalesce("text", F.lit(""))
    marks = {"legal": ("icense", "ICENSE"), "credential": ("token", "TOKEN", "assword", "AKIA"), "table": (" | ",)}
    topic = F.lit("prose")
    for name, found in reversed(marks.items()):
        topic = F.when(functools.reduce(lambda x, y: x | y, (F.contains(text, F.lit(m)) for m in found)), name).otherwise(topic)
    return docs.withColumns({fresh(docs, "topic"): topic, fresh(docs, "n_words"): mixing.n_words(F.col("text"))})


def mixed(docs: DataFrame) -> DataFrame:
    """The drawn documents of the mixture: half of all words, raked to source, language and topic."""
    topic, words = fresh(docs, "topic"), fresh(docs, "n_words")
    rows = measured(docs)
    margins = [
        mixing.Margin("source", power=0.7),
        mixing.Margin("lang", shares=(("en", 0.55), ("de", 0.16), ("fr", 0.16), ("es", 0.13))),
        mixing.Margin(topic, power=0.8),
    ]
    cells = saved(mixing.cells_of(rows, margins, words))
    odds = mixing.calibrate(mixing.rake(cells, margins), MIX_FRACTION)
    return mixing.sample(rows, odds, margins, "doc_id", ["text"])


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    return mixed(docs).drop("text")


def op8_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return hnsw.nearest(vectors, F.col("vec_id") % 50 == 0, k=5)


def op9_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.join(table(spark, sf_dir, "documents"), NGRAM_RULE)


def secret_rows(docs: DataFrame) -> DataFrame:
    """Input of the secret scan: repositories are a source's languages, owners are the sources."""
    return docs.select(
        row_key(F.col("doc_id"), F.col("text")).alias("row"),
        "doc_id",
        F.concat_ws("/", "source", "lang").alias("repo"),
        F.col("source").alias("owner"),
        "text",
    )


def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.report(secrets.judged(secret_rows(table(spark, sf_dir, "documents"))))


def op11_structure_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations")
    return repair.repair(repair.damaged(rows), repair.turns_of(rows))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = prefix_trie.turns_of(table(spark, sf_dir, "conversations"))
    return prefix_trie.trie(prefix_trie.rebuilt(turns), turns.select("conv_id").distinct())


def op13_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = language.learn(docs.filter(~language.held_out(F.col("doc_id"))))
    told = language.predict(docs.select("doc_id", "text"), model)
    return told.select("doc_id", language.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "accepted")


OPERATORS = (op1_url_filter, op2_toxicity, op3_chat_format, op4_license_scan, op5_decontamination, op6_substring_dedup, op7_mixing, op8_nearest_neighbours, op9_ngram_jaccard, op10_secret_scan, op11_structure_repair, op12_prefix_trie, op13_language_id)


def shipped(query: Query) -> Query:
    """The query, after the package has been sent to the Python workers."""

    @functools.wraps(query)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship(spark)
        return query(spark, sf_dir)

    return run


QUERIES: dict[str, Query] = {f.__name__: shipped(f) for f in OPERATORS}

# DuckDB SQL for the queries that it can express over whole texts.
CHAT_SQL = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
escaped AS (
  SELECT *, replace(replace(replace(text, '\', '\\'), '<turn', '\lturn'), '</turn', '\l/turn') AS body,
         replace(replace(replace(replace(role, '\', '\\'), '<turn', '\lturn'), '</turn', '\l/turn'), chr(10), '\n') AS head
  FROM turns),
segments AS (SELECT *, '<turn ' || head || chr(10) || body || '</turn>' || chr(10) AS segment FROM escaped)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, segment)) AS turns_sha256,
       cast(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS bigint) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, segment) FILTER (role = 'assistant'), '')) AS loss_sha256,
       cast(sum(length(segment)) AS bigint) AS formatted_chars
FROM segments GROUP BY conv_id
"""

REPEATS_SQL = rf"""
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
starts AS (SELECT doc_id, words, unnest(range(1, len(words) - {REPEAT_WORDS} + 2)) AS p FROM w WHERE len(words) >= {REPEAT_WORDS}),
windows AS (SELECT doc_id, p, sha256(array_to_string(words[p:p + {REPEAT_WORDS} - 1], ' ')) AS k FROM starts),
firsts AS (SELECT k, min(doc_id) AS least FROM windows GROUP BY k),
gone AS (SELECT DISTINCT doc_id, unnest(range(p, p + {REPEAT_WORDS})) AS i FROM windows JOIN firsts USING (k) WHERE doc_id > least),
listed AS (SELECT doc_id, list(i) AS places FROM gone GROUP BY doc_id),
kept AS (
  SELECT doc_id, words, CASE WHEN places IS NULL THEN words
                             ELSE list_filter(words, lambda x, i: NOT list_contains(places, i)) END AS stay
  FROM w LEFT JOIN listed USING (doc_id))
SELECT doc_id, len(words) AS n_words, len(words) - len(stay) AS n_removed, sha256(array_to_string(stay, ' ')) AS kept_sha256
FROM kept
"""

LINKS_SQL = rf"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS words FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, unnest(CASE
    WHEN len(words) >= {NGRAM_RULE.shingle}
      THEN list_transform(range(1, len(words) - {NGRAM_RULE.shingle} + 2), lambda i: array_to_string(words[i:i + {NGRAM_RULE.shingle} - 1], ' '))
    WHEN len(words) > 0 THEN [array_to_string(words, ' ')] ELSE [] END) AS s
  FROM w),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
common AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c
  FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL),
links AS (
  SELECT x, y FROM common JOIN sizes p ON p.doc_id = x JOIN sizes q ON q.doc_id = y
  WHERE 100 * c >= {NGRAM_RULE.percent} * (p.n + q.n - c)),
both_ways AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
reach AS (
  SELECT x AS d, y AS r FROM both_ways
  UNION SELECT reach.d, both_ways.y FROM reach JOIN both_ways ON reach.r = both_ways.x),
least_of AS (SELECT d, min(r) AS r FROM reach GROUP BY d)
SELECT w.doc_id, coalesce(n, 0) AS n_shingles, least(w.doc_id, coalesce(r, w.doc_id)) AS component_id
FROM w LEFT JOIN sizes ON sizes.doc_id = w.doc_id LEFT JOIN least_of ON d = w.doc_id
"""

CRC_SQL = """
crc_table AS (
  SELECT list(list_reduce([i::UBIGINT] || [0::UBIGINT for k in range(8)],
                          lambda c, x: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384::UBIGINT) ELSE c >> 1 END) ORDER BY i) AS t
  FROM range(256) r(i)),
crcs AS (
  SELECT name, xor(list_reduce([4294967295::UBIGINT] || list_transform(string_split(name, ''), lambda ch: ascii(ch)::UBIGINT),
                               lambda c, b: xor(c >> 8, t[(xor(c, b) & 255)::INT + 1])), 4294967295::UBIGINT) AS crc
  FROM (SELECT DISTINCT name FROM names), crc_table)"""

REPAIR_SQL = rf"""
WITH RECURSIVE original AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS name FROM conversations),
names AS (SELECT name FROM original), {CRC_SQL},
damaged AS (
  SELECT conv_id, turn, CASE WHEN crc % 20 = 4 THEN 'user' ELSE role END AS role,
         CASE crc % 20 WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM original JOIN crcs USING (name), range(CASE WHEN crc % 20 = 3 THEN 2 ELSE 1 END) WHERE crc % 20 <> 0),
placed AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i FROM damaged),
judged AS (
  SELECT *, CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'blank'
                 WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'duplicate'
                 WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*\z') THEN 'truncated' END AS fault,
         left(role, 1) AS h, lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) AS before
  FROM placed),
steps AS (
  SELECT conv_id, 0::BIGINT AS i, {{'c': 0, 'w': '', 'o': ''}} AS e, NULL::STRUCT(c INTEGER, w VARCHAR, o VARCHAR) AS s,
         NULL::STRUCT(c INTEGER, w VARCHAR, o VARCHAR) AS u, NULL::STRUCT(c INTEGER, w VARCHAR, o VARCHAR) AS a
  FROM (SELECT DISTINCT conv_id FROM judged)
  UNION ALL
  SELECT conv_id, i, {{'c': e.c + 2, 'w': e.w || 'D', 'o': e.o}},
         CASE WHEN h = 's' AND free THEN least(s2, {{'c': e.c + more, 'w': e.w || 'K', 'o': e.o || said}}) ELSE s2 END,
         CASE WHEN free THEN least(u2, {{'c': x.c + more + (h <> 'u')::INT, 'w': x.w || CASE WHEN h = 'u' THEN 'K' ELSE 'R' END,
                                         'o': x.o || CASE WHEN h = 'u' THEN said ELSE chr(10) || 'user:' || text END}}) ELSE u2 END,
         CASE WHEN free AND u1 IS NOT NULL
              THEN least(a2, {{'c': u1.c + more + (h <> 'a')::INT, 'w': u1.w || CASE WHEN h = 'a' THEN 'K' ELSE 'R' END,
                               'o': u1.o || CASE WHEN h = 'a' THEN said ELSE chr(10) || 'assistant:' || text END}}) ELSE a2 END
  FROM (
    SELECT *, CASE WHEN s IS NOT NULL THEN {{'c': s.c + 2, 'w': s.w || 'D', 'o': s.o}} END AS s2,
           {{'c': u1.c + 2, 'w': u1.w || 'D', 'o': u1.o}} AS u2, {{'c': a1.c + 2, 'w': a1.w || 'D', 'o': a1.o}} AS a2,
           least(e, s, a1) AS x
    FROM (
      SELECT *, least(a, {{'c': u1.c + 5, 'w': u1.w || 'I', 'o': u1.o || chr(10) || 'assistant:'}}) AS a1
      FROM (
        SELECT t.conv_id, j.i, e, s, a, h, role, text, chr(10) || role || ':' || text AS said,
               fault IS NULL OR fault = 'truncated' AS free, CASE WHEN fault = 'truncated' THEN 5 ELSE 0 END AS more,
               least(u, {{'c': least(e, s, a).c + 5, 'w': least(e, s, a).w || 'I', 'o': least(e, s, a).o || chr(10) || 'user:'}}) AS u1
        FROM steps t JOIN judged j ON j.conv_id IS NOT DISTINCT FROM t.conv_id AND j.i = t.i + 1)))),
lasts AS (
  SELECT conv_id, least(e, a, {{'c': ua.c + 5, 'w': ua.w || 'I', 'o': ua.o || chr(10) || 'assistant:'}}) AS best
  FROM (SELECT *, least(u, CASE WHEN s IS NOT NULL THEN {{'c': s.c + 5, 'w': s.w || 'I', 'o': s.o || chr(10) || 'user:'}} END,
                        {{'c': e.c + 5, 'w': e.w || 'I', 'o': e.o || chr(10) || 'user:'}}) AS ua
        FROM steps QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY i DESC) = 1)),
counts AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
         count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
         count(*) FILTER (fault = 'truncated') AS truncated,
         count(*) FILTER (before IS NOT NULL AND before || h NOT IN ('su', 'ua', 'au')) AS illegal
  FROM judged GROUP BY conv_id)
SELECT o.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(best.c, 0)::BIGINT AS cost,
       coalesce(best.w, '') AS audit, sha256(coalesce(substr(best.o, 2), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM original) o
LEFT JOIN counts c ON c.conv_id IS NOT DISTINCT FROM o.conv_id LEFT JOIN lasts l ON l.conv_id IS NOT DISTINCT FROM o.conv_id
"""

TRIE_SQL = rf"""
WITH own AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) - 1 AS pos, role, text
  FROM (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL)),
names AS (SELECT conv_id::VARCHAR AS name FROM own), {CRC_SQL},
ids AS (
  SELECT o.conv_id, o.conv_id - o.conv_id % 5 AS base, (crc % 9)::BIGINT AS h, least(crc % 9, coalesce(b.n, 0))::BIGINT AS taken
  FROM (SELECT DISTINCT conv_id FROM own) o JOIN crcs ON name = o.conv_id::VARCHAR
  LEFT JOIN (SELECT conv_id, count(*) AS n FROM own GROUP BY conv_id) b ON b.conv_id = o.conv_id - o.conv_id % 5),
rebuilt AS (
  SELECT ids.conv_id, pos, role, text FROM ids JOIN own ON own.conv_id = base AND pos < taken
  UNION ALL SELECT ids.conv_id, pos - h + taken, role, text FROM ids JOIN own ON own.conv_id = ids.conv_id AND pos >= h),
paths AS (
  SELECT conv_id, pos + 1 AS depth, octet_length(encode(text)) AS bytes,
         string_agg(md5(length(role) || ':' || role || ':' || text), '') OVER (PARTITION BY conv_id ORDER BY pos) AS path FROM rebuilt
  UNION ALL SELECT conv_id, 0, 0, '' FROM ids),
lengths AS (SELECT conv_id, max(depth) AS n FROM paths GROUP BY conv_id),
nodes AS (
  SELECT path, depth, min(conv_id) AS conv_id, count(*) AS n_convs, (count(*) - 1) * min(bytes) AS own,
         string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (n = depth) AS ended
  FROM paths JOIN lengths USING (conv_id) GROUP BY path, depth),
children AS (SELECT left(path, 32 * (depth - 1)) AS path, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY 1),
ancestors AS (SELECT left(path, 32 * d) AS path, own, n_children FROM nodes LEFT JOIN children USING (path), range(depth + 1) r(d)),
sums AS (SELECT path, count(*) FILTER (n_children IS NULL) AS n_leaves, sum(own)::BIGINT AS saved_tokens FROM ancestors GROUP BY path)
SELECT x.conv_id, x.depth, p.conv_id AS parent_conv_id, x.n_convs, coalesce(n_children, 0) AS n_children, n_leaves, saved_tokens,
       sha256(coalesce(x.ended, '')) AS ends_sha256
FROM nodes x JOIN sums USING (path) LEFT JOIN children USING (path)
LEFT JOIN nodes p ON x.depth > 0 AND p.depth = x.depth - 1 AND p.path = left(x.path, 32 * (x.depth - 1))
"""

ORACLES: dict[str, str] = {
    "op3_chat_format": CHAT_SQL,
    "op6_substring_dedup": REPEATS_SQL,
    "op9_ngram_jaccard": LINKS_SQL,
    "op11_structure_repair": REPAIR_SQL,
    "op12_prefix_trie": TRIE_SQL,
}
