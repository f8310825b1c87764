import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from migrascope.llm import language

WORDS = {"en": "the quick brown fox jumps over the lazy dog while they were thinking about things",
         "de": "der schnelle braune fuchs springt über den faulen hund während sie darüber nachdenken",
         "fr": "le rapide renard brun saute par dessus le chien paresseux pendant qu'ils réfléchissent"}


@pytest.fixture
def learned(docs):
    rows = [(i, " ".join(w for _, w in sorted(zip(range(i, i + 20), text.split() * 2))), lang) for lang, text in WORDS.items() for i in range(5)]
    return language.learn(docs(rows))


def told(df):
    return {r.doc_id: (r.lang_pred, r.score, r.accepted) for r in df.collect()}


def test_answers(docs, learned):
    rows = [(1, "they jumps over the brown dog"), (2, "SIE SPRINGT ÜBER DEN HUND"), (3, None), (4, ""), (5, "12 34 !!"), (6, "the lazy dog. " * 100_000), (7, "le chien brun\n\t saute"), (None, "x")]
    result = told(language.predict(docs(rows), learned))
    assert [result[i][0] for i in (1, 2, 6, 7)] == ["en", "de", "en", "fr"] and result[6][2]
    assert all(result[i] == ("und", 0.0, False) for i in (3, 4, 5))
    assert result[None][0] in WORDS and 0 <= result[None][1] <= 1


def test_sizes_by_hand(docs, learned):
    """The answer is the least sum over all pieces of the whole text, as encoded one by one."""
    text = " ".join([*WORDS["de"].split(), *WORDS["fr"].split()] * 7 + WORDS["de"].split() * 30)
    plain, encoders = language.cleaned(text), learned.encoders()
    sums = [sum(len(e.compress(plain[i : i + language.PIECE])) for i in range(0, len(plain), language.PIECE)) for _, e in encoders]
    best = min(range(len(sums)), key=sums.__getitem__)
    (row,) = language.predict(docs([(1, text)]), learned).collect()
    assert (row.lang_pred, row.score) == (encoders[best][0], 1 - sums[best] / min(s for i, s in enumerate(sums) if i != best))


def test_narrow_margins_are_rejected(docs, learned):
    rows = [(1, "zzz"), (2, WORDS["en"])]
    result = told(language.predict(docs(rows), learned, margin=0.05))
    assert not result[1][2] and result[2][2]
    assert language.choose([7, 5, 5]) == (1, 0.0) and language.choose([3]) == (0, 1.0)


def test_edge_cases(spark, docs, learned):
    nothing = language.learn(docs([(1, "word", None), (2, None, "en"), (3, "77", "de")]))
    assert nothing.samples == () and told(language.predict(docs([(1, "word")]), nothing)) == {1: ("und", 0.0, False)}
    assert language.learn(docs([])).samples == () and language.predict(docs([]), learned).count() == 0
    one = language.learn(docs([(1, "word", "en")]))
    assert told(language.predict(docs([(1, "other")]), one)) == {1: ("en", 1.0, True)}
    clash = docs([(1, WORDS["fr"])]).withColumns({"lang_pred": F.lit("kept"), "Score": F.lit(7)})
    (row,) = language.predict(clash, learned).collect()
    assert row["lang_pred"] == "kept" and row["Score"] == 7 and row["_lang_pred"] == "fr"


def test_held_out_accuracy(spark):
    folder = entry.ENTRY_FOLDER.replace("0.001", "0.01")
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "lang")
    result = entry.queries()["op13_language_id"](spark, folder).join(docs, "doc_id")
    held = result.filter("held_out AND lang_pred <> 'und'")
    assert held.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("double"))).first()[0] > 0.97
    sure = held.filter("accepted").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("double")), F.count("*")).first()
    assert sure[0] > 0.98 and sure[1] > 0.8 * held.count()
