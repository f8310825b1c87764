from pyspark.sql import functions as F

import __spark_entry__ as entry
import brute
from migrascope.llm import queries, secrets
from migrascope.llm.common import row_key

EXAMPLE = "AKIA" + "EXAMPLE0123456789"
LIVE = "password = 'xK9+mQ2/vT7=pL4z'"
TEXTS = [
    "API_KEY: \"abc\" token=abcdefghijkl Secret : 'short' passwd=ABCDEF0123456789", "apikey=" + "0123456789abcdef" * 2,
    "x" + "a" * 15 + " " + "f" * 16 + "g" + "0" * 17, "AKIA123 AKIA" + "Z" * 14 + " AKIA" + "Z" * 13, "ſecret=abcdefghijklmn toKen=abcdefghijklmn",
    "é😀 token = \"2abc3ff2ca8fb1e4c565a0eb63815530a948bdde\" é", "password==password=secretsecretsecret", None, "", "deadbeef" * 40_000,
]


def report(frame):
    return secrets.report(secrets.judged(queries.secret_rows(frame))).collect()


def test_base_spans_stay(spark, docs):
    frame = docs([(i, t) for i, t in enumerate(TEXTS)])
    rows = {r.doc_id: r for r in report(frame)}
    assert len(rows) == len(TEXTS)
    for i, text in enumerate(TEXTS):
        base = brute.base_spans(text)
        counts = [sum(s.startswith(k) for s in base) for k in ("assign", "access", "hex")]
        assert [rows[i].n_assign, rows[i].n_access, rows[i].n_hex] == counts, text
        assert rows[i].base_sha256 == brute.sha(",".join(base))
        assert set(base) <= set(rows[i].spans.split(",") if rows[i].spans else [])


def test_examples_are_told_from_live_credentials(docs):
    rows = [(i, f"see {EXAMPLE} here", "en", f"src{i % 5}") for i in range(30)]
    rows += [(100, f"mine: {LIVE}", "en", "src1"), (101, f"mine: {LIVE}", "fr", "src1"), (102, "secret=aaaaaaaaaaaaaaaa", "en", "src9")]
    rows += [(103, "use ghp_" + "a1B2c3D4e5" * 3, "en", None)]
    got = {r.doc_id: r for r in report(docs([(*r, None) for r in rows]))}
    assert all(got[i].n_live == 0 and got[i].n_access == 1 for i in range(30))
    assert got[100].n_live == got[101].n_live == 1 and got[102].n_live == 0
    assert got[103].n_live == 1 and got[103].spans == "live:4:38" and got[103].n_assign == 0
    inner = f"mine: {LIVE}".index("xK9")
    assert got[100].spans.split(",")[-1] == f"live:{inner}:{inner + 16}"


def test_many_repositories_of_one_owner_make_an_example(spark):
    schema = "row string, doc_id long, repo string, owner string, text string"
    rows = [(f"{i}", i, f"r{i % n}", o, f"password = 'xK9+mQ2/vT7=p{o}{n}'") for o, n in (("a", 3), ("b", 4)) for i in range(10 * n, 11 * n)]
    rows += [(f"s{i}", 100 + i, f"r{i}", f"o{i % 2}", "password = 'Zq8+wE4/rT2=yU6i'") for i in range(6)]
    got = {r.doc_id: len(r.live) for r in secrets.judged(spark.createDataFrame(rows, schema)).collect()}
    assert all(got[i] == 1 for i in range(30, 33)) and all(got[i] == 0 for i in range(40, 44)) and all(got[100 + i] == 1 for i in range(6))


def test_repeated_rows_missing_values_and_empty_table(spark, docs):
    frame = docs([(1, LIVE), (1, LIVE), (None, LIVE, None, None), (2, None, None, None)])
    rows = sorted(report(frame.withColumnRenamed("n_chars", "row")), key=lambda r: r.doc_id or 0)
    assert [r.n_live for r in rows] == [1, 1, 1, 0] and rows[1].n_assign == 1
    assert report(frame.limit(0)) == []


def test_redaction_touches_live_spans_only(spark, docs):
    rows = [(i, f"see {EXAMPLE} here", "en", f"src{i}") for i in range(5)] + [(9, f"a {LIVE} b {LIVE} é"), (10, None), (11, "clean")]
    frame = docs([(*r, *["en", "src0"][len(r) - 2 :], None) if len(r) < 4 else (*r, None) for r in rows])
    judged = secrets.judged(queries.secret_rows(frame))
    out = secrets.redacted(frame, judged, row_key(F.col("doc_id"), F.col("text")))
    got = {r.doc_id: r.text for r in out.collect()}
    assert out.schema == frame.schema and got[9] == "a password = '[secret]' b password = '[secret]' é"
    assert {k: v for k, v in got.items() if k != 9} == {r[0]: r[1] for r in rows if r[0] != 9}


def test_query(spark):
    """Base spans and live spans of every document, counted over all pairs of secret and document."""
    rows = spark.read.parquet(f"{entry.ENTRY_FOLDER}/documents.parquet").collect()
    seen = {}
    for r in rows:
        for _, _, _, a, b in secrets.spans_of(r.text or ""):
            repos, owners = seen.setdefault(r.text[a:b], (set(), set()))
            repos.add("/".join(x for x in (r.source, r.lang) if x is not None))
            owners.add(r.source)
    live = {s for s, (repos, owners) in seen.items() if len(owners) <= 2 and len(repos) <= 3 * len(owners) and secrets.entropy(s) >= 2.5}
    text = {r.doc_id: r.text or "" for r in rows}
    found = 0
    for r in entry.queries()["op10_secret_scan"](spark, entry.ENTRY_FOLDER).collect():
        base = brute.base_spans(text[r.doc_id])
        own = {(a, b) for _, _, _, a, b in secrets.spans_of(text[r.doc_id]) if text[r.doc_id][a:b] in live}
        assert r.base_sha256 == brute.sha(",".join(base)) and r.n_live == len(own)
        assert set(filter(None, r.spans.split(","))) == set(base) | {f"live:{a}:{b}" for a, b in own}
        found += len(own)
    assert found > 0
