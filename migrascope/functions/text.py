"""Text expressions: padding, industry categories and keyword scores."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from migrascope import dims

EXACT_CODE_LENGTH = 5  # longer codes are compared whole, shorter ones as a prefix


def sql_text(value: str) -> str:
    escaped = value.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"


def text_array(items: list[str]) -> Column:
    """A constant array, written as one SQL expression."""
    return F.expr(f"array({', '.join(sql_text(i) for i in items)})")


def zero_pad(text: Column, width: int) -> Column:
    """Left-pad with zeros; text already wider stays as it is (lpad alone would cut it)."""
    return F.when(F.length(text) < width, F.lpad(text, width, "0")).otherwise(text)


def county_fips(state: Column, county: Column) -> Column:
    return F.concat(zero_pad(state, 2), zero_pad(county, 3))


def code_matches(code: Column, wanted: str) -> Column:
    return code.startswith(wanted) if len(wanted) <= EXACT_CODE_LENGTH else code == wanted


def any_of(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions)


def category(code: Column, rules: dict[str, list[str]], precedence: str = "last_wins") -> Column:
    """Category of an industry code.

    ``last_wins``: of several matching rules the last listed decides. ``most_specific``: the
    longest matching code decides.
    """
    code = code.cast("string")
    if precedence == "last_wins":
        ordered = [(name, codes) for name, codes in rules.items()][::-1]
    elif precedence == "most_specific":
        single = [(name, [c]) for name, codes in rules.items() for c in codes]
        ordered = sorted(single, key=lambda rule: -len(rule[1][0]))
    else:
        raise ValueError(f"unknown precedence {precedence!r}")
    hits = [F.when(any_of([code_matches(code, c) for c in codes]), name) for name, codes in ordered]
    return F.coalesce(*hits, F.lit(dims.OTHER_CATEGORY))


def relevant_industry(code: Column, rules: dict[str, list[str]]) -> Column:
    """Does the code share its first two digits with any configured code?

    Longer configured codes begin with a listed two-digit prefix, so this one test covers them.
    """
    prefixes = sorted({c[:2] for codes in rules.values() for c in codes})
    return F.substring(code.cast("string"), 1, 2).isin(prefixes)


def keywords_found(name: Column, keywords: list[str], word_boundary: bool = False) -> Column:
    """Distinct keywords that occur in the lower-cased name, found in one pass over it.

    A lookahead reports the longest keyword starting at each position. Shorter keywords that the
    longest one begins with are then added, since they occur there as well. With
    ``word_boundary`` only whole words count.
    """
    words = sorted({k.lower() for k in keywords})
    by_initial: dict[str, list[str]] = {}
    for word in sorted(words, key=lambda w: (-len(w), w)):
        by_initial.setdefault(word[0], []).append(re.escape(word[1:]))
    longest = "|".join(f"{re.escape(c)}(?:{'|'.join(rest)})" for c, rest in sorted(by_initial.items()))
    edge = r"\b" if word_boundary else ""
    found = F.regexp_extract_all(F.lower(name), F.lit(f"{edge}(?=((?:{longest}){edge}))"), F.lit(1))

    def whole(word: str, part: str) -> bool:
        following = word[len(part)]
        return not word_boundary or not (following.isalnum() or following == "_")

    contained = {
        word: [p for p in words if word != p and word.startswith(p) and whole(word, p)] for word in words
    }
    entries = [
        f"{sql_text(word)}, array({', '.join(sql_text(p) for p in [word, *parts])})"
        for word, parts in contained.items()
        if parts
    ]
    if not entries:
        return F.array_distinct(found)
    parts_of = F.expr(f"map({', '.join(entries)})")
    expanded = F.transform(found, lambda w: F.coalesce(F.element_at(parts_of, w), F.array(w)))
    return F.array_distinct(F.flatten(expanded))


def keyword_score(found: Column, keywords: list[str]) -> Column:
    """Share of the keywords among those found; NULL (no name) counts as none."""
    hits = F.array_intersect(found, text_array([k.lower() for k in keywords]))
    return F.when(F.size(found) > 0, F.size(hits)).otherwise(0) / F.lit(float(len(keywords)))


def first_best(names: list[str], scores: list[Column]) -> Column:
    """Name of the highest score; the first listed wins a tie."""
    values = F.array(*scores)
    best = F.array_position(values, F.array_max(values)).cast("int")
    return F.element_at(text_array(names), best)


def display_name(name: Column) -> Column:
    return F.initcap(F.trim(name))
