import re

import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from migrascope.llm import words

TEXT = st.one_of(st.none(), st.text(alphabet="aAbé \t\n\x0b\x85\u3000z", max_size=60))


@settings(max_examples=200, deadline=None)
@given(st.lists(TEXT, max_size=8), st.integers(1, 4), st.integers(0, 3))
def test_words_and_runs_equal_those_of_a_pattern(rows, k, skip):
    column = pa.array(rows, pa.string()).slice(skip)
    found = words.split(column)
    expected = [re.findall(r"[^\x20\x09-\x0D]+", r or "") for r in rows[skip:]]
    got = [
        [found.data[s:e].tobytes().decode() for s, e in zip(found.start[a:b], found.end[a:b], strict=True)]
        for a, b in zip(found.first[:-1], found.first[1:], strict=True)
    ]
    assert got == expected
    flat = [w for row in expected for w in row]
    assert len(set(found.hash.tolist())) == len(set(flat))
    hashes, inside = words.grams(found, k)
    by_hash = {}
    for i in range(len(hashes)):
        if inside[i]:
            assert by_hash.setdefault(int(hashes[i]), tuple(flat[i : i + k])) == tuple(flat[i : i + k])
    runs = {tuple(row[i : i + k]) for row in expected for i in range(len(row) - k + 1)}
    assert set(by_hash.values()) == runs


def test_very_long_words():
    column = pa.array(["y" * 600 + " " + "y" * 601, "y" * 600, "Y" * 600])
    found = words.split(column, lower=True)
    assert found.hash[0] == found.hash[2] == found.hash[3] != found.hash[1]
