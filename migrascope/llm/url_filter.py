"""URL filter: host and path rules, and a logistic regression on hashed character n-grams for the rest.

Everything on the scoring path is a SQL expression: n-grams are taken from the array of characters, hashed
to a bucket, and looked up in the array of weights, which holds ``BUCKETS`` numbers whatever the input.

Defined cases: a null url, or one without ``://``, has an empty host and path, fits no rule and is judged by
the method; an empty url table gives no rows; repeated urls are judged alike; of rules of equal length that
fit, a blocking one wins; without labelled urls every undecided url is allowed. Other columns pass through,
and a clash with a result column is resolved in favour of the result.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizerModel, Normalizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from migrascope.llm.common import lower_ascii, saved

BUCKETS = 4096
GRAMS = (3, 4)
LABELLED_ROWS = 4000  # bound of the labelled sample that the regression is fitted on
ALLOW, BLOCK = "allow", "block"


@dataclass(frozen=True)
class Rule:
    """``text`` is a host, a slash and the rest of a path prefix."""

    text: str
    verdict: str

    @property
    def host(self) -> str:
        return self.text.partition("/")[0]

    @property
    def path(self) -> str:
        return "/" + self.text.partition("/")[2]

    def fits(self, host: Column, path: Column) -> Column:
        own = (host == self.host) | F.endswith(host, F.lit(f".{self.host}"))
        return own & F.startswith(path, F.lit(self.path))


@dataclass(frozen=True)
class Model:
    weights: list[float] = field(default_factory=lambda: [0.0] * BUCKETS)
    intercept: float = 0.0

    def score(self, host: Column, path: Column) -> Column:
        """Probability that the url is to be blocked."""
        weights = F.split(F.lit(",".join(map(repr, self.weights))), ",").cast("array<double>")
        features = gram_buckets(host, path)
        total = F.aggregate(features, F.lit(0.0), lambda acc, b: acc + F.get(weights, b))
        logit = F.lit(self.intercept) + total / F.greatest(F.size(features), F.lit(1))
        return 1 / (1 + F.exp(-logit))


def host_of(url: Column) -> Column:
    return lower_ascii(F.coalesce(F.regexp_extract(url, "://([^/?#]*)", 1), F.lit("")))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, "://[^/?#]*([^?#]*)", 1), F.lit(""))


def gram_buckets(host: Column, path: Column) -> Column:
    """Buckets of all character n-grams of host and path, which are hashed apart."""

    def grams(part: str, text: Column, n: int) -> Column:
        letters = F.split(F.concat(F.lit("^"), text, F.lit("$")), "")
        count = F.greatest(F.size(letters) - n + 1, F.lit(0))
        shifted = [F.slice(letters, F.lit(j + 1), count) for j in range(n)]  # no look-ups by place
        return F.transform(
            F.arrays_zip(*shifted),
            lambda g: F.pmod(F.xxhash64(F.lit(f"{part}{n}"), *(g[str(j)] for j in range(n))), F.lit(BUCKETS)).cast("int"),
        )

    return F.concat(*(grams(p, t, n) for p, t in (("host", host), ("path", path)) for n in GRAMS))


def labelled_sample(urls: DataFrame, url: str, label: Column, rows: int = LABELLED_ROWS) -> DataFrame:
    """At most ``rows`` labelled urls, chosen by hash: a small table of (url, label)."""
    known = urls.select(F.col(url).alias("url"), label.alias("label")).filter("label IS NOT NULL AND url IS NOT NULL")
    return known.dropDuplicates().orderBy(F.xxhash64("url"), "url", "label").limit(rows)


def train(labelled: DataFrame) -> Model:
    """Fits (url, label), label 1 for block. The table is small; a larger one is the caller's choice."""
    rows = saved(labelled.select("url", F.col("label").cast("double").alias("label")).dropna())
    if rows.isEmpty():
        return Model()
    words = F.transform(gram_buckets(host_of(F.col("url")), path_of(F.col("url"))), lambda b: b.cast("string"))
    vocabulary = [str(i) for i in range(BUCKETS)]
    counts = CountVectorizerModel.from_vocabulary(vocabulary, inputCol="grams", outputCol="counts")
    features = Normalizer(p=1.0, inputCol="counts", outputCol="features")
    frame = features.transform(counts.transform(rows.select("label", words.alias("grams"))))
    fitted = LogisticRegression(maxIter=60, regParam=1e-5).fit(frame)
    intercept = max(-50.0, min(50.0, float(fitted.intercept)))  # one class only: the fit is at infinity
    return Model([float(w) for w in fitted.coefficients], intercept)


def judge(pages: DataFrame, rules: list[Rule], model: Model, url: str = "url", cut: float = 0.5) -> DataFrame:
    """Adds host, path, rule, score and verdict to every row."""
    located = pages.withColumns({"host": host_of(F.col(url)), "path": path_of(F.col(url))})
    decided = located.withColumns(rule_columns(rules))
    scored = decided.withColumn("score", model.score(F.col("host"), F.col("path")))
    own = F.when(F.col("score") > cut, BLOCK).otherwise(ALLOW)
    return scored.withColumn("verdict", F.coalesce("rule_verdict", own)).drop("rule_verdict")


def rule_columns(rules: list[Rule]) -> dict[str, Column]:
    """The longest fitting rule and its verdict, over columns host and path."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r.text), r.verdict == BLOCK, r.text)):
        fits = rule.fits(F.col("host"), F.col("path"))
        name, verdict = F.when(fits, rule.text).otherwise(name), F.when(fits, rule.verdict).otherwise(verdict)
    return {"rule": name, "rule_verdict": verdict}
