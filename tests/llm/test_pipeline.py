import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import brute
import corpus_pipeline as pipeline

FOLDER = entry.ENTRY_FOLDER.replace("sf0.001", "sf0.01")  # the smallest has too few labels to learn from


@pytest.fixture(scope="module")
def steps(spark, tmp_path_factory):
    """Input and output of every stage over the smallest tables, with odd rows added."""
    folder = FOLDER
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    odd = spark.createDataFrame([(900_001, None, None, None, None), (900_002, "", "en", "src0", 0), (None, "no id here", "en", "src0", 10), (900_002, "", "en", "src0", 0)], docs.schema)
    now, out = docs.unionByName(odd).withColumn("score", F.lit("clash")), []
    for i, (name, stage) in enumerate(pipeline.STAGES):
        path = str(tmp_path_factory.mktemp(f"{i}-{name}") / "out")
        stage(spark, now, folder).write.parquet(path)
        after = spark.read.parquet(path)
        out.append((name, now, after))
        now = after
    return out


def test_stages_keep_the_columns(steps):
    assert [s[0] for s in steps] == ["toxicity", "near-copies", "decontamination", "secrets", "mixing"]
    for _, before, after in steps[:-1]:
        assert after.columns == before.columns and after.count() > 0


def test_each_stage_only_takes_away_rows(steps):
    for name, before, after in steps:
        same = [c for c in before.columns if name != "secrets" or c not in ("text", "n_chars")]
        assert after.select(same).exceptAll(before.select(same)).count() == 0, name
    assert steps[3][1].count() == steps[3][2].count()


def test_toxic_rows_go_and_odd_rows_stay(steps):
    _, before, after = steps[0]
    assert after.count() < before.count() and after.filter("doc_id IS NULL OR doc_id > 900000").count() == 4


def test_one_of_each_group_stays(steps):
    _, before, after = steps[1]
    rows = [(r.doc_id, r.text) for r in before.filter("doc_id IS NOT NULL").collect()]
    groups = brute.components(rows, pipeline.NEAR_RULE.shingle, pipeline.NEAR_RULE.percent)
    assert sorted(r.doc_id for r in after.filter("doc_id IS NOT NULL").collect()) == sorted(d for d, (_, c) in groups.items() if c == d)
    assert after.filter("doc_id IS NULL").count() == 1


def test_leaking_documents_go(spark, steps):
    _, before, after = steps[2]
    plain = lambda t: " ".join(re.findall(r"[^\W_]+", (t or "").lower()))
    items = [plain(r.text) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    left = [plain(r.text) for r in after.collect()]
    assert not any(f" {i} " in f" {t} " for i in items for t in left)
    clean = [r.doc_id for r in before.collect() if not any(" ".join(i.split()[:6]) in plain(r.text) for i in items)]
    assert set(clean) <= {r.doc_id for r in after.collect()}


def test_live_secrets_are_replaced(steps):
    _, before, after = steps[3]
    texts = {r.doc_id: r.text for r in before.collect()}
    for r in after.collect():
        if r.text != texts[r.doc_id]:
            assert brute.base_spans(texts[r.doc_id]) and "[secret]" in r.text and r.n_chars == len(r.text)


def test_run_equals_the_stages(spark, tmp_path):
    rows = pipeline.run(spark, entry.ENTRY_FOLDER)
    assert {"doc_id", "text", "weight", "probability"} <= set(rows.columns) and rows.count() > 0
    again = entry.queries()["pipeline"](spark, entry.ENTRY_FOLDER)
    assert sorted(r.doc_id for r in again.select("doc_id").collect()) == sorted(r.doc_id for r in rows.select("doc_id").collect())
