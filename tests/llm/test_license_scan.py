import random

import __spark_entry__ as entry
from migrascope.llm import license_scan
from migrascope.llm.license_scan import Index, align, fingerprints, plain_words

MIT = license_scan.TEMPLATES["MIT"]
LINE = license_scan.TEMPLATES["MIT line"]


def local(template, ids):
    """Best local alignment over the whole table: matched words of the best score."""
    best = (0, 0)
    above = [(0, 0)] * (len(ids) + 1)
    for w in template:
        row = [(0, 0)]
        for j, x in enumerate(ids, 1):
            cell = max(
                (above[j - 1][0] + (2 if x == w else -1), above[j - 1][1] + (x == w)),
                (above[j][0] - 1, above[j][1]), (row[-1][0] - 1, row[-1][1]), (0, 0),
            )
            cell = cell if cell[0] > 0 else (0, 0)
            row.append(cell)
            best = max(best, cell)
        above = row
    return best


def test_banded_alignment_equals_the_full_table():
    rng = random.Random(5)
    for _ in range(60):
        template = [rng.randrange(12) for _ in range(30)]
        ids = [rng.randrange(12, 40) for _ in range(10)] + template + [rng.randrange(12, 40) for _ in range(10)]
        for _ in range(rng.randrange(4)):
            at = rng.randrange(12, 36)
            ids[at : at + 1] = [] if rng.random() < 0.4 else [99] * rng.randrange(1, 3)
        got = align(template, ids, 10)
        assert got[0] == local(template, ids)[1]


def test_shared_runs_share_a_fingerprint():
    rng = random.Random(2)
    guarantee = license_scan.GRAM + license_scan.SPAN - 1
    for _ in range(300):
        shared = [rng.randrange(50) for _ in range(guarantee)]
        one, two = ([rng.randrange(50) for _ in range(9)] + shared + [rng.randrange(50) for _ in range(9)] for _ in range(2))
        assert {h for h, _ in fingerprints(one)} & {h for h, _ in fingerprints(two)}


def test_spans_and_coverage(spark, docs):
    notice = f"intro words here. {MIT.replace('software', 'SOFTWARE')}! and more"
    edited = "a b c " + MIT.replace("free of charge", "at no cost") + " d"
    rows = docs([(1, notice), (2, f"x {LINE}. y {LINE}"), (3, "released under the"), (4, None), (5, ""), (6, edited), (6, edited), (None, LINE)])
    found = license_scan.scan(rows.withColumnRenamed("lang", "license"))
    got = sorted(((r.doc_id or 0, r.license, r.start, r.end, round(r.coverage, 2)) for r in found.collect()))
    start = notice.index("Permission")
    assert [g for g in got if g[0] == 1] == [(1, "MIT", start, start + len(MIT), 1.0)]
    assert [g for g in got if g[0] == 2] == [(2, "MIT line", 2, 2 + len(LINE), 1.0), (2, "MIT line", 6 + len(LINE), 6 + 2 * len(LINE), 1.0)]
    assert [g[:2] for g in got if g[0] == 6] == [(6, "MIT")] * 2 and got[0][:2] == (0, "MIT line")
    assert {g[0] for g in got} == {0, 1, 2, 6}
    assert license_scan.scan(rows.limit(0)).count() == 0


def test_very_long_text():
    index = Index(license_scan.TEMPLATES)
    found = index.matches(plain_words("the of and software " * 50_000 + MIT + " the" * 50_000), 0.8)
    assert [m.template for m in found] == ["MIT"] and found[0].matched == found[0].size


def test_query(spark):
    lines = [v for k, v in license_scan.TEMPLATES.items() if k.endswith("line")]
    rows = spark.read.parquet(f"{entry.ENTRY_FOLDER}/documents.parquet").select("doc_id", "text").collect()
    plain = {r.doc_id: " ".join(plain_words(r.text)) for r in rows}
    exact = {d for d, t in plain.items() if any(" ".join(plain_words(v)) in t for v in lines)}
    got = entry.queries()["op4_license_scan"](spark, entry.ENTRY_FOLDER).collect()
    assert exact and {r.doc_id for r in got if r.coverage == 1.0} == exact


def test_whole_licences_are_told_from_their_openings(spark, docs):
    """A full text is reported to its last word, a text that ends early with the share it has."""
    ends = {"MIT": "DEALINGS IN THE SOFTWARE", "BSD-2-Clause": "POSSIBILITY OF SUCH DAMAGE", "BSD-3-Clause": "POSSIBILITY OF SUCH DAMAGE"}
    for name, end in ends.items():
        assert license_scan.TEMPLATES[name].rstrip(".").endswith(end)
    texts = {i: license_scan.TEMPLATES[name] for i, name in enumerate(ends)}
    mit = plain_words(MIT)
    cut = mit.index("noninfringement")
    rows = docs([*((i, f"before it: {t} And after.") for i, t in texts.items()), (7, " ".join(mit[:cut])), (8, license_scan.BSD_OPENING)])
    found = [tuple(r) for r in license_scan.scan(rows, least=0.3).collect()]
    for i, name in enumerate(ends):
        size = len(plain_words(texts[i]))
        own = [f for f in found if f[0] == i]
        assert own[0] == (i, name, 1.0, size, 11, 11 + len(texts[i].rstrip("."))) and all(f[3] <= size for f in own)
    assert [f[1:4] for f in found if f[0] == 7] == [("MIT", cut / len(mit), cut)] and 0.5 < cut / len(mit) < 0.8
    opening = len(plain_words(license_scan.BSD_OPENING))
    assert {f[1]: f[2] for f in found if f[0] == 8} == {n: opening / len(plain_words(license_scan.TEMPLATES[n])) for n in list(ends)[1:]}
    assert {r.doc_id for r in license_scan.scan(rows).collect()} == set(texts)


def longest_common(template, ids):
    """Words of the template that occur in the text in order, over the whole table."""
    above = [0] * (len(ids) + 1)
    for w in template:
        row = [0]
        for j, x in enumerate(ids, 1):
            row.append(above[j - 1] + 1 if x == w else max(above[j], row[-1]))
        above = row
    return above[-1]


def test_texts_that_the_band_parts_are_chained(spark, docs):
    """Words put in between clauses, or a holder's long name for a short one: whole coverage and outer span."""
    bsd = license_scan.TEMPLATES["BSD-3-Clause"]
    filler = "Owing to a request by our office of records a remark stands here"
    texts = [
        MIT.replace("The above copyright", f"{filler} The above copyright"),
        bsd.replace("the copyright holder nor", "the Regents of all Colleges and Schools in that large old Town nor"),
        MIT.replace("AUTHORS OR COPYRIGHT", "MANY PEOPLE WHO WROTE LARGE AND SMALL PARTS OF THIS OVER LONG YEARS OR COPYRIGHT"),
    ]
    got = {r.doc_id: r for r in license_scan.scan(docs([(i, f"so: {t} end") for i, t in enumerate(texts)])).collect()}
    for i, (name, text) in enumerate(zip(("MIT", "BSD-3-Clause", "MIT"), texts, strict=True)):
        words = plain_words(license_scan.TEMPLATES[name])
        assert got[i].license == name and (got[i].start, got[i].end) == (4, 4 + len(text.rstrip(".")))
        assert got[i].matched_words >= longest_common(words, plain_words(text)) - 2


def test_chains_against_the_longest_common_subsequence():
    """A template with foreign words put in and own words left out anywhere keeps all words that are left."""
    rng = random.Random(11)
    template = [f"w{i}" for i in range(120)]
    index = Index({"T": " ".join(template)})
    for _ in range(60):
        text, gone = list(template), 0
        for _ in range(rng.randrange(5)):
            at = rng.randrange(8, len(text) - 8)
            if rng.random() < 0.5:
                text[at:at] = ["zz"] * rng.randrange(1, 60)
            elif gone < 12:
                n = rng.randrange(1, 4)
                gone += n
                del text[at : at + n]
        found = index.matches(["zz"] * 5 + text + ["zz"] * 5, 0.8)
        best = longest_common(template, text)
        assert len(found) == 1 and found[0].matched == best and (found[0].first, found[0].last) == (5, 5 + len(text))
    twice = index.matches(template + ["zz"] * 3 + template, 0.8)
    assert [(m.first, m.last, m.matched) for m in twice] == [(0, 120, 120), (123, 243, 120)]
    far = index.matches(template[:60] + ["zz"] * 121 + template[60:], 0.4)
    assert [m.matched for m in far] == [60, 60]
