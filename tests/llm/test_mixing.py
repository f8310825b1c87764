import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from migrascope.llm import mixing
from migrascope.llm.mixing import Margin

MARGINS = [Margin("source", power=0.5), Margin("lang", shares=(("en", 0.5), ("de", 0.3), ("zz", 0.2))), Margin("topic")]


@pytest.fixture(scope="module")
def rows(spark):
    data = []
    for i in range(4000):
        source = None if i % 50 == 0 else f"s{min(i % 7, 3)}"
        data.append((i, source, ["en", "de", "fr"][i * 7 % 11 % 3], "t" + str(i % 5 // 4), 1 + i % 90, "x"))
    return spark.createDataFrame(data, "doc_id long, source string, lang string, topic string, tokens long, weight string")


@pytest.fixture(scope="module")
def cells(rows):
    return mixing.rake(mixing.cells_of(rows, MARGINS, "tokens"), MARGINS)


def by_hand(table, goals, rounds=200):
    """Raking of a dense array to goals per axis."""
    w = table.astype(float).copy()
    for _ in range(rounds):
        for axis, goal in enumerate(goals):
            other = tuple(k for k in range(w.ndim) if k != axis)
            sums = w.sum(axis=other)
            shape = [1] * w.ndim
            shape[axis] = -1
            w *= (np.array(goal) * table.sum() / np.maximum(sums, 1e-300)).reshape(shape)
    return w


def test_raking_equals_plain_fitting_and_meets_the_margins(cells):
    raked = cells.toPandas()
    total = raked.tokens.sum()
    assert raked.error.iloc[0] <= mixing.TOLERANCE and raked.weight.sum() == pytest.approx(total)
    names = [sorted(raked[m.column].fillna("~").unique()) for m in MARGINS]
    dense = np.zeros([len(n) for n in names])
    for r in raked.itertuples():
        dense[tuple(n.index(v if isinstance(v, str) else "~") for n, v in zip(names, (r.source, r.lang, r.topic), strict=True))] = r.tokens
    natural = [dense.sum(axis=tuple(k for k in range(3) if k != a)) / total for a in range(3)]
    source = np.sqrt(natural[0]) / np.sqrt(natural[0]).sum()
    free = natural[1][names[1].index("fr")]
    lang = [{"en": 0.5 / 0.8 * (1 - free), "de": 0.3 / 0.8 * (1 - free), "fr": free}[n] for n in names[1]]
    expected = by_hand(dense, [source, lang, natural[2]])
    for r in raked.itertuples():
        at = tuple(n.index(v if isinstance(v, str) else "~") for n, v in zip(names, (r.source, r.lang, r.topic), strict=True))
        assert r.weight == pytest.approx(expected[at], rel=1e-3)


@pytest.mark.parametrize("fraction", [0.1, 0.5, 0.9, 1.0])
def test_probabilities_meet_the_budget(cells, fraction):
    odds = mixing.calibrate(cells, fraction).toPandas()
    assert odds.probability.between(0, 1).all()
    assert (odds.probability * odds.tokens).sum() == pytest.approx(fraction * odds.tokens.sum(), rel=1e-6)
    open_ = odds[odds.probability < 1]
    ratio = open_.probability * open_.tokens / open_.weight
    assert len(open_) == 0 or ratio.max() == pytest.approx(ratio.min())


def test_sample_follows_the_probabilities(rows, cells):
    odds = mixing.calibrate(cells, 0.5)
    drawn = mixing.sample(rows, odds, MARGINS, "doc_id", ["topic"])
    again = mixing.sample(rows.repartition(7), odds, MARGINS, "doc_id", ["topic"])
    assert drawn.exceptAll(again).count() == 0 and drawn.columns == [*rows.columns, "_weight", "probability", "error"]
    assert drawn.filter("source IS NULL").count() > 0
    expected = odds.agg(F.sum(F.col("probability") * F.col("documents"))).first()[0]
    assert drawn.count() == pytest.approx(expected, rel=0.1)


def test_small_values_meet_their_goals_and_unmet_margins_show(spark):
    rows = [(i, "tiny" if i == 0 else f"s{i % 3}", ["en", "de"][i % 2], 1 + i % 7) for i in range(3000)]
    df = spark.createDataFrame(rows, "doc_id long, source string, lang string, tokens long")
    margins = [Margin("source", power=0.5), Margin("lang", shares=(("en", 0.9), ("de", 0.1)))]
    raked = mixing.rake(mixing.cells_of(df, margins, "tokens"), margins).toPandas()
    natural = raked.groupby("source").tokens.sum() / raked.tokens.sum()
    goal = natural**0.5 / (natural**0.5).sum()
    assert (abs(raked.groupby("source").weight.sum() / raked.tokens.sum() / goal - 1) <= 2e-6).all() and raked.error.max() <= mixing.TOLERANCE
    apart = df.withColumn("lang", F.when(F.col("source") == "s0", "en").otherwise("de"))  # source fixes language
    odds = mixing.calibrate(mixing.rake(mixing.cells_of(apart, margins, "tokens"), margins, rounds=4), 0.5)
    assert mixing.sample(apart, odds, margins, "doc_id", ["lang"]).first().error > 0.01


def test_odd_tables(spark):
    schema = "doc_id long, source string, lang string, topic string, tokens long"
    empty = spark.createDataFrame([], schema)
    odds = mixing.calibrate(mixing.rake(mixing.cells_of(empty, MARGINS, "tokens"), MARGINS), 0.5)
    assert mixing.sample(empty, odds, MARGINS, "doc_id", ["topic"]).count() == 0
    few = spark.createDataFrame([(1, "a", "en", "t", 0), (1, "a", "en", "t", 0), (None, None, None, None, 5)], schema)
    odds = mixing.calibrate(mixing.rake(mixing.cells_of(few, MARGINS, "tokens"), MARGINS), 1.0)
    assert mixing.sample(few, odds, MARGINS, "doc_id", ["topic"]).count() == 3
    text = spark.createDataFrame([(None,), ("",), ("a　b c\x0bd " * 10_000,)], "text string")
    assert sorted(r[0] for r in text.select(mixing.n_words(F.col("text"))).collect()) == [0, 0, 30_000]


def test_query(spark):
    docs = spark.read.parquet(f"{entry.ENTRY_FOLDER}/documents.parquet")
    rows = entry.queries()["op7_mixing"](spark, entry.ENTRY_FOLDER).collect()
    ids = {r.doc_id for r in docs.select("doc_id").collect()}
    assert 0 < len(rows) < len(ids) and {r.doc_id for r in rows} <= ids
    assert all(0 < r.probability <= 1 and r.weight >= 0 for r in rows)


def test_query_draws_what_plain_raking_says(spark):
    """The drawn rows of the query, from a dense table raked by hand and the same hash draw."""
    from migrascope.llm import queries

    docs = spark.read.parquet(f"{entry.ENTRY_FOLDER}/documents.parquet").select("doc_id", "text", "lang", "source")
    rows = queries.measured(docs).withColumn("u", mixing.uniform(1, F.xxhash64("doc_id"))).collect()
    names = [sorted({r[c] for r in rows}) for c in ("source", "lang", "topic")]
    dense = np.zeros([len(n) for n in names])
    for r in rows:
        dense[tuple(n.index(r[c]) for n, c in zip(names, ("source", "lang", "topic"), strict=True))] += r.n_words
    natural = [dense.sum(axis=tuple(k for k in range(3) if k != a)) / dense.sum() for a in range(3)]
    given = {"en": 0.55, "de": 0.16, "fr": 0.16, "es": 0.13}
    lang = np.array([given[n] for n in names[1]])
    goals = [natural[0] ** 0.7 / (natural[0] ** 0.7).sum(), lang / lang.sum(), natural[2] ** 0.8 / (natural[2] ** 0.8).sum()]
    weight = by_hand(dense, goals, 40)
    low, high = 0.0, 1e6
    for _ in range(200):
        mid = (low + high) / 2
        low, high = (mid, high) if np.minimum(weight * mid, dense).sum() < queries.MIX_FRACTION * dense.sum() else (low, mid)
    odds = np.divide(np.minimum(weight * low, dense), dense, out=np.full(dense.shape, queries.MIX_FRACTION), where=dense > 0)
    at = lambda r: odds[tuple(n.index(r[c]) for n, c in zip(names, ("source", "lang", "topic"), strict=True))]
    drawn = {r.doc_id for r in entry.queries()["op7_mixing"](spark, entry.ENTRY_FOLDER).collect()}
    sure = {r.doc_id for r in rows if r.u < at(r) * (1 - 1e-3)}
    assert sure <= drawn <= {r.doc_id for r in rows if r.u < at(r) * (1 + 1e-3)}


def test_a_round_of_raking_is_no_single_plan(spark, rows, monkeypatch, capsys):
    """One plan of all margins reads the cells 2 ** margins times, which fills the driver."""
    leaves, written = [], mixing.written

    def seen(df, name):
        capsys.readouterr()
        df.explain()
        leaves.append(capsys.readouterr().out.count("Scan "))
        return written(df, name)

    monkeypatch.setattr(mixing, "written", seen)
    mixing.rake(mixing.cells_of(rows, MARGINS, "tokens"), MARGINS, rounds=2)
    assert len(leaves) == 2 * len(MARGINS) and max(leaves) <= 3
