import random
import zlib

import brute
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from migrascope.llm import toxicity
from migrascope.llm.toxicity import Automaton, Entry, Scorer, entry as allowed

BAD = ["worthless", "idiot", "scumbag"]


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def test_automaton_equals_edit_distance():
    rng = random.Random(3)
    lexicon = ["idiot", "worthless", "trash", "scum", "moron", "disgusting"]
    automaton = Automaton([allowed(w) for w in lexicon])
    for _ in range(4000):
        word = list(rng.choice(lexicon))
        for _ in range(rng.randrange(4)):
            at = rng.randrange(len(word) + 1)
            kind = rng.randrange(3)
            if kind == 0:
                word.insert(at, rng.choice("abehrst"))
            elif word and at < len(word):
                word[at : at + 1] = [] if kind == 1 else [rng.choice("abehrst")]
        word = "".join(word)
        near = [w for w in lexicon if distance(w, word) <= toxicity.edits(w)]
        want = "exact" if word in lexicon else "near" if near else None
        assert automaton.match(word) == want, word


def test_stems_match_longer_words_only():
    automaton = Automaton([allowed("réeux", stem=True), allowed("idiot")])
    assert automaton.match("réeuxment") == "stem" and automaton.match("réeux") is None
    assert automaton.match("rèeuxment") == "near stem" and automaton.match("rèex") is None
    assert automaton.match("réeu") is None and automaton.match("idiots") == "near" and automaton.match("") is None


def test_quotation_counts_less_and_address_more():
    scorer = Scorer([allowed("idiot")])
    plain = scorer.features("well the idiot came by again")[0]
    assert scorer.features('he wrote "the idiot" in the letter')[0] < plain < scorer.features("you idiot came by again")[0]
    assert scorer.features("an 1diot, or an id!ot: twice")[0] > 0 and scorer.features("nothing here") == [0.0] * 4


def test_words_are_cut_at_inner_punctuation():
    scorer = Scorer([allowed("idiot"), allowed("scum"), allowed("stupid", stem=True)])
    kinds = {w: [h[0] for h in scorer.found(w)] for w in ("idiot/moron", "idiot...scum", "id!ot", "scumm", "stupdity", "fine/day", "--", "")}
    assert kinds == {
        "idiot/moron": ["exact"],
        "idiot...scum": ["exact", "exact"],
        "id!ot": ["near"],
        "scumm": ["near"],
        "stupdity": ["near stem"],
        "fine/day": [],
        "--": [],
        "": [],
    }


def test_neighbours_in_clean_documents_forbid_edits(spark):
    clean = [(0, "the closer and lower slum of scab"), (0, "a closer look at the slum"), (0, "scam here"), (0, "well spoken")]
    sample = spark.createDataFrame([*clean, *[(1, "you losers and scumm")] * 3], "toxic long, text string")
    entries = [allowed("loser"), allowed("scum"), allowed("moro"), allowed("spoke", stem=True)]
    kept, innocent = toxicity.permitted(sample, entries, 3, 4)
    assert innocent == {"closer", "slum"}  # of two clean documents; ``losers`` marks the toxic ones
    assert {e.term: e.edits for e in kept} == {"loser": 1, "scum": 0, "moro": 1, "spoke": 1}
    scorer = Scorer(kept, innocent)
    assert scorer.found("closer") == [] and [h[0] for h in scorer.found("losers")] == ["near"] and scorer.found("scam") == []


def test_scores_equal_all_distances(spark):
    """Scores of whole rows next to edit distances to every entry and context windows counted one by one."""
    rng = random.Random(9)
    entries = [allowed("idiot"), allowed("scum"), allowed("worthless"), allowed("stupid", stem=True), Entry("trash", False, 0)]
    model = toxicity.Model(entries, [1.5, 0.7, 2.0, -0.3], -2.0, frozenset({"idiom", "slum"}))
    pool = ["idiot", "idiom", "1diot,", "scum", "slum", "scam", "'worthles'", "wortless", "stupidity", "stuppidly", "trash", "trush"]
    pool += ["you", "said", '"well', 'good"', "«so»", "fine", "day", "idiot/scum", "not-so-stupider", "...", "(dich)"] + ["so", "it", "goes"] * 6
    rows = [(i, " ".join(rng.choice(pool) for _ in range(rng.randrange(60)))) for i in range(300)]
    docs = spark.createDataFrame([*rows, (300, None), (301, '"idiot"')], "doc_id long, text string")
    got = {r.doc_id: r.score for r in toxicity.add_score(docs, model).collect()}
    for doc_id, text in [*rows, (300, None), (301, '"idiot"')]:
        assert got[doc_id] == pytest.approx(brute.toxic_score(text, model, distance), abs=1e-12), text


@pytest.fixture(scope="module")
def corpus(spark):
    rng = random.Random(1)
    words = ["".join(rng.choice("aeionrst") for _ in range(rng.randrange(3, 9))) for _ in range(500)]
    rows, labels = [], []
    for i in range(900):
        toxic = i % 6 == 0
        text = [rng.choice(words) for _ in range(40)]
        if toxic:
            for _ in range(3):
                text[rng.randrange(40)] = rng.choice(BAD)
        rows.append((i, " ".join(text)))
        labels.append((i, int(toxic)))
    # labels of held-out rows are turned round: they must teach nothing
    shown = [(i, (1 - t) if zlib.crc32(str(i).encode()) % 4 == 2 else t) for i, t in labels]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    return docs, spark.createDataFrame(shown, "doc_id long, toxic int"), dict(labels)


def test_held_out_accuracy(spark, corpus):
    docs, labels, truth = corpus
    model = toxicity.learn(docs, labels)
    assert {e.term for e in model.entries if not e.stem} >= set(BAD)
    rows = toxicity.add_score(docs, model).withColumn("held", toxicity.held_out(F.col("doc_id"))).collect()
    held = [r for r in rows if r.held]
    assert all((r.score >= 0.3) == bool(truth[r.doc_id]) for r in held) and len(held) > 150
    typo = spark.createDataFrame([(1, "you are an idoit and wortless"), (2, "all fine here")], "doc_id long, text string")
    got = {r.doc_id: r.score for r in toxicity.add_score(typo, model).collect()}
    assert got[1] > got[2]


def test_odd_rows(spark, corpus, docs):
    model = toxicity.learn(*corpus[:2])
    odd = docs([(1, None), (2, ""), (2, ""), (None, "idiot " * 50_000), (3, "fine", None, None)])
    out = toxicity.add_score(odd.withColumn("score", F.lit("mine")), model, score="_score")
    rows = out.collect()
    assert len(rows) == 5 and {r.score for r in rows} == {"mine"} and all(0 <= r._score <= 1 for r in rows)
    assert max(rows, key=lambda r: r._score).doc_id is None
    assert toxicity.add_score(odd.limit(0), model).count() == 0


def test_without_labels(spark, corpus):
    docs_, labels, _ = corpus
    for few in (labels.limit(0), labels.withColumn("toxic", F.lit(None).cast("int")), labels.withColumn("toxic", F.lit(0))):
        model = toxicity.learn(docs_, few)
        assert toxicity.add_score(docs_.limit(3), model).agg(F.max("score")).first()[0] == 0.0
    assert toxicity.add_score(docs_.limit(3), toxicity.learn(docs_, labels.withColumn("toxic", F.lit(1)))).agg(F.min("score")).first()[0] > 0.9


def test_query(spark):
    rows = entry.queries()["op2_toxicity"](spark, entry.ENTRY_FOLDER).collect()
    assert len(rows) == spark.read.parquet(f"{entry.ENTRY_FOLDER}/documents.parquet").count()
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and r.predicted == int(r.score >= 0.3)
