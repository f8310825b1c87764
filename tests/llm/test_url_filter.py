import math
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from migrascope.llm import queries, url_filter

URLS = [
    "http://a.com/x", "https://WWW.Example.com/en/1?q#f", "http://example.com/en/2", "http://b.example.com/en", "x://net/es/1",
    "y://m.net/fr/2", "z://net/de/3", "http://evilcom/x", "http://a.com", "no scheme", "", None, "http://c.org/en/é?x",
    "://://net/es/", "http://" + "a" * 20_000 + ".net/es/" + "b" * 20_000, "http://a.com/x", "http://h.com/a\nb",
]


def expected(url):
    m = re.search(r"://([^/?#]*)([^?#]*)", url or "")
    host, path = ("".join(c.lower() if "A" <= c <= "Z" else c for c in m[1]), m[2]) if m else ("", "")
    fits = [r for r in queries.URL_RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    best = max(fits, key=lambda r: len(r.text), default=None)
    return host, path, best.text if best else None, best.verdict if best else None


@pytest.fixture(scope="module")
def model(spark):
    rows = [(f"http://h{i}.org/{'es' if i % 2 else 'en'}/{i}", i % 2) for i in range(200)]
    labelled = spark.createDataFrame([*rows, (None, 1), ("http://x.org", None)], "url string, label int")
    return url_filter.train(url_filter.labelled_sample(labelled, "url", F.col("label")))


def test_rules_and_parts(spark, model):
    pages = spark.createDataFrame([(i, u, "taken", 9) for i, u in enumerate(URLS)], "page_id long, url string, host string, score int")
    rows = url_filter.judge(pages, queries.URL_RULES, model).collect()
    assert len(rows) == len(URLS)
    for r in rows:
        host, path, rule, verdict = expected(r.url)
        assert (r.host, r.path, r.rule) == (host, path, rule)
        assert r.verdict == (verdict or ("block" if r.score > 0.5 else "allow"))


def test_scores_equal_the_regression_by_hand(spark, model):
    frame = spark.createDataFrame([("h9.org", "/es/9"), ("h8.org", "/en/8"), ("", "")], "host string, path string")
    host, path = F.col("host"), F.col("path")
    rows = frame.select("path", url_filter.gram_buckets(host, path).alias("b"), model.score(host, path).alias("s")).collect()
    for r in rows:
        logit = model.intercept + np.mean([model.weights[b] for b in r.b]) if r.b else model.intercept
        assert r.s == pytest.approx(1 / (1 + math.exp(-logit)))
    assert rows[0].s > 0.9 and rows[1].s < 0.1


def test_held_out_urls_are_told_apart(spark, model):
    rows = [(f"http://q{i}.org/{'es' if i % 2 else 'en'}/{i}", i % 2) for i in range(1000, 1200)]
    pages = spark.createDataFrame(rows, "url string, truth int")
    judged = url_filter.judge(pages, [], model).select(((F.col("verdict") == "block").cast("int") == F.col("truth")).alias("right"))
    assert judged.filter("right").count() >= 190


def test_empty_and_one_class(spark):
    empty = spark.createDataFrame([], "url string, label int")
    none = url_filter.train(empty)
    pages = spark.createDataFrame([("http://a.org/x",)], "url string")
    assert url_filter.judge(pages, [], none).first().verdict == "allow"
    assert url_filter.judge(pages.limit(0), [], none).count() == 0
    one = url_filter.train(spark.createDataFrame([("http://a.org/x", 1), ("http://b.org", 1)], "url string, label int"))
    assert url_filter.judge(pages, [], one).first().verdict == "block"


def test_query(spark):
    pages = spark.read.parquet(f"{entry.ENTRY_FOLDER}/pages.parquet")
    df = entry.queries()["op1_url_filter"](spark, entry.ENTRY_FOLDER)
    plan = df._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Pandas", plan)
    rows = {r.page_id: r for r in df.collect()}
    assert len(rows) == pages.count()
    for p in pages.select("page_id", "url").collect():
        r = rows[p.page_id]
        host, path, rule, verdict = expected(p.url)
        assert (r.host, r.path, r.rule) == (host, path, rule) and r.verdict == (verdict or r.verdict)
