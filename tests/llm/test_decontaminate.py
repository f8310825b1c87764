import random

import numpy as np
import pytest

import __spark_entry__ as entry
from migrascope.llm import decontaminate as d

rng = random.Random(7)
VOCABULARY = ["".join(rng.choice("abcdefghij") for _ in range(rng.randrange(2, 8))) for _ in range(800)]
COMMON = ["the", "of", "and", "to", "in"]


def prose(n, seed):
    r = random.Random(seed)
    return [r.choice(COMMON) if r.random() < 0.4 else r.choice(VOCABULARY) for _ in range(n)]


def lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(row[j] + 1 if x == y else max(row[j + 1], new[-1]))
        row = new
    return row[-1]


def test_bitwise_subsequence_equals_the_table():
    r = random.Random(1)
    for _ in range(300):
        a, b = ([r.randrange(6) for _ in range(r.randrange(1, 70))] for _ in range(2))
        assert d.common(d.masks_of(np.array(a, np.uint64)), len(a), b) == lcs(a, b)


def test_axes_span_the_leading_directions():
    r = np.random.default_rng(0)
    a = r.standard_normal((300, 8)) @ np.diag([9, 8, 7, 6, 5, 0.1, 0.1, 0.1]) @ r.standard_normal((8, 60))
    omega = r.standard_normal((60, 20))
    got = d.axes(a.T @ a @ omega, omega, 5)
    _, _, vt = np.linalg.svd(a, full_matrices=False)
    assert np.linalg.svd(got.T @ vt[:5].T)[1].min() > 0.999


@pytest.fixture(scope="module")
def corpus(spark):
    items = [(i, " ".join(prose(20 + 2 * i, 5000 + i)) + ". The answer " + " ".join(prose(3, 900 + i))) for i in range(20)]
    items += [(98, None), (99, "")]
    docs = [(i, " ".join(prose(300, i))) for i in range(150)]
    leaks = set()
    for n, (i, text) in enumerate(items[:20]):
        words = text.split()
        kind = n % 4
        if kind == 1:  # noise after words, capitals
            words = [w.upper() + "&&&" for w in words]
        if kind == 2:  # a paraphrase: every sixth word replaced
            words = [("swapped" if k % 6 == 5 and k < len(words) - 5 else w) for k, w in enumerate(words)]
        before, after = prose(37 + n, 500 + n), prose(200, 700 + n)
        docs.append((1000 + i, " ".join([*before, *words, *after])))
        leaks.add((1000 + i, i))
    half = items[3][1].split()[:10]
    docs += [(2000, " ".join([*prose(100, 3000), *half, *prose(100, 3001)])), (2001, None), (2002, ""), (None, items[0][1])]
    leaks.add((None, 0))
    docs.append((1000, docs[150][1]))  # a repeated row
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    return frame, spark.createDataFrame(items, "item_id long, text string"), leaks


def test_leaks_found_and_clean_left(corpus):
    docs, items, leaks = corpus
    rows = d.leaks(docs, items).collect()
    assert {(r.doc_id, r.item_id) for r in rows} == leaks and len(rows) == len(leaks) + 1
    for r in rows:
        assert 0.6 <= r.coverage <= 1 and r.lcs > 0


def test_search_finds_what_comparing_all_windows_finds(corpus):
    docs, items, _ = corpus
    texts = [(r.doc_id, d.plain(d.pa.array([r.text], d.pa.string()))) for r in docs.filter("doc_id < 1100").collect()]
    found = set()
    for r in items.filter("length(text) > 0").collect():
        item = d.plain(d.pa.array([r.text])).hash.tolist()
        for doc_id, words in texts:
            own = words.hash.tolist()
            for at in range(0, len(own), 8):
                near = own[max(0, at - len(item)) : at + 32 + len(item)]
                if len(set(near) & set(item)) >= 0.6 * len(set(item)) and lcs(item, near) >= 0.8 * len(item):
                    found.add((doc_id, r.item_id))
                    break
    got = {(r.doc_id, r.item_id) for r in d.leaks(docs, items).filter("coverage >= 0.8").collect()}
    assert found <= got


def test_blocks_and_empty_inputs(spark, corpus, monkeypatch):
    docs, items, leaks = corpus
    monkeypatch.setattr(d, "ITEM_BLOCK", 7)
    assert {(r.doc_id, r.item_id) for r in d.leaks(docs, items).collect()} == leaks
    assert d.leaks(docs.limit(0), items).count() == 0
    assert d.leaks(docs, items.limit(0)).count() == 0


def test_answer_column_decides_paraphrases(spark, corpus):
    docs, _, _ = corpus
    words = prose(40, 12_345)
    partial = [w if k % 3 else "other" for k, w in enumerate(words)]  # two thirds in order
    frame = docs.unionByName(spark.createDataFrame([(1, " ".join(partial) + " forty two")], "doc_id long, text string"))
    for answer, expected in (("forty two", {1}), ("never said", set())):
        items = spark.createDataFrame([(5, " ".join(words), answer)], "item_id long, text string, answer string")
        got = {r.doc_id for r in d.leaks(frame, items, d.F.col("answer")).collect()}
        assert got == expected, answer


def test_query_finds_every_whole_passage(spark):
    read = lambda t: spark.read.parquet(f"{entry.ENTRY_FOLDER}/{t}.parquet")
    plain = lambda t: " ".join(w for w in "".join(c.lower() if c.isalnum() else " " for c in t or "").split())
    items = {r.item_id: plain(r.text) for r in read("benchmark").collect()}
    expected = {(r.doc_id, i) for r in read("documents").collect() for i, t in items.items() if f" {t} " in f" {plain(r.text)} "}
    got = {(r.doc_id, r.item_id) for r in entry.queries()["op5_decontamination"](spark, entry.ENTRY_FOLDER).collect()}
    assert expected and expected <= got


def checked(item, doc):
    """Whether any window of the document passes the check, without looking for candidates."""
    size = len(item)
    masks = d.masks_of(item)
    answer = item[-3:]
    if d.common(masks, size, doc) < 0.6 * size:
        return False
    for at in range(0, len(doc), 16):
        text = doc[max(0, at - size) : at + 32 + size]
        share = d.common(masks, size, text) / size
        if share >= 0.8 or share >= 0.6 and d.common(d.masks_of(answer), 3, text) == 3:
            return True
    return False


def test_planted_items_are_found_as_by_comparing_all(spark):
    """Short, adjacent and edited items in real documents: as many as the check finds over all windows."""
    read = lambda t: [r.text or "" for r in spark.read.parquet(f"{entry.ENTRY_FOLDER}/{t}.parquet").collect()]
    r = random.Random(3)
    texts = [" ".join("".join(c if c.isascii() and c.isalnum() else " " for c in t).split()) for t in read("benchmark")]
    texts = [t.split() for t in dict.fromkeys(texts) if len(t.split()) >= 12]
    texts = [t[: r.choice([6, 9, 12, len(t)])] for t in texts]
    items = [(i, " ".join(t), " ".join(t[-3:])) for i, t in enumerate(texts)]
    docs = []
    for i, text in enumerate(read("documents")[:400]):
        own, planted = text.split(), []
        for at in range(r.choice([1, 2, 3])):
            words = list(r.choice(texts))
            if at == 1 and i % 3 == 0:
                words = [w for k, w in enumerate(words) if k % 4 != 1]
            planted += words
        at = r.randrange(len(own) + 1)
        docs.append((i, " ".join([*own[:at], *planted, *own[at:]])))
    hashes = lambda rows: [d.plain(d.pa.array([t], d.pa.string())).hash for t in rows]
    of_docs = [h.tolist() for h in hashes(t for _, t in docs)]
    expected = {(n, i) for i, own in enumerate(hashes(t for _, t, _ in items)) for n, doc in enumerate(of_docs) if checked(own, doc)}
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    benchmark = spark.createDataFrame(items, "item_id long, text string, answer string")
    got = {(row.doc_id, row.item_id) for row in d.leaks(frame, benchmark, d.F.col("answer")).collect()}
    assert len(expected) > 300 and got == expected
