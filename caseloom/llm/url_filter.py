"""URL filters: host and path rules, and logistic regression for all other URLs.

The classifier reads hashed character n-grams of host and path. It is trained from a
small labelled table, at most ``MAX_ROWS`` distinct rows of it, with Spark's own estimators; its
coefficients and the feature space have a fixed size. Scoring is one narrow stage.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import Pipeline
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caseloom.llm.common import ascii_lower

BLOCK, ALLOW = "block", "allow"
FEATURES = 1 << 14
GRAMS = (2, 3, 4)
MAX_ROWS = 20_000
ITERATIONS, PENALTY = 30, 1e-4


@dataclass(frozen=True)
class Rule:
    """``name`` is host and path in one, such as ``example.com/de/``."""

    verdict: str
    name: str

    @property
    def host(self) -> str:
        return self.name.partition("/")[0]

    @property
    def path(self) -> str:
        return "/" + self.name.partition("/")[2] if "/" in self.name else ""


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty for null or without ``://``."""
    at = F.locate("://", url)
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return ascii_lower(host), path


def rule_of(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """The name of the longest rule that fits, else null."""
    found = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r.name), r.name)):
        fits = (host == rule.host) | host.endswith("." + rule.host)
        found = F.when(fits & path.startswith(rule.path), F.lit(rule.name)).otherwise(found)
    return found


def rule_verdict(name: Column, rules: Sequence[Rule]) -> Column:
    blocked = [rule.name for rule in rules if rule.verdict == BLOCK]
    return F.when(name.isin(blocked), BLOCK).when(name.isNotNull(), ALLOW)


def grams(host: Column, path: Column) -> Column:
    """Character n-grams, those of the host and of the path told apart."""
    parts = []
    for mark, part in (("h", host), ("p", path)):
        ends = F.concat(F.lit("^"), part, F.lit("$"))
        for n in GRAMS:
            found = F.regexp_extract_all(ends, F.lit(rf"(?s)(?=(.{{{n}}}))"), 1)
            parts.append(F.transform(found, lambda g, m=mark: F.concat(F.lit(m), g)))
    return F.concat(*parts)


class UrlClassifier:
    """``train`` on ``host, path, label`` (1: block), then ``score``.

    Without rows of both labels there is nothing to learn; the one label there is, or
    0 for an empty table, is then everyone's.
    """

    def __init__(self, model=None, constant: float = 0.0):
        self.model, self.constant = model, constant

    @classmethod
    def train(cls, labelled: DataFrame, max_rows: int = MAX_ROWS) -> UrlClassifier:
        """Of a longer table, the ``max_rows`` distinct rows with the smallest URL hash are taken, with counts."""
        few = (
            labelled.where("label is not null")
            .select("host", "path", F.col("label").cast("double").alias("label"))
            .groupBy("host", "path", "label")
            .agg(F.count("*").cast("double").alias("n"))
            .orderBy(F.xxhash64("host", "path"), "host", "path", "label")
            .limit(max_rows)
        )
        few = few.withColumn("grams", grams(F.col("host"), F.col("path")))
        few = few.select("grams", "label", "n").persist()
        try:
            seen = [row["label"] for row in few.select("label").distinct().collect()]
            if len(seen) < 2:
                return cls(constant=seen[0] if seen else 0.0)
            steps = [
                HashingTF(inputCol="grams", outputCol="features", numFeatures=FEATURES, binary=True),
                LogisticRegression(maxIter=ITERATIONS, regParam=PENALTY, standardization=False, weightCol="n"),
            ]
            return cls(Pipeline(stages=steps).fit(few))
        finally:
            few.unpersist()

    def score(self, urls: DataFrame, into: str = "block_score") -> DataFrame:
        """``urls`` (with ``host`` and ``path``) and the probability of label 1."""
        if self.model is None:
            return urls.withColumn(into, F.lit(self.constant))
        keep = [name for name in urls.columns if name != into]
        row = F.struct(*[F.col(name) for name in keep]).alias("row")
        ready = urls.select(row, grams(F.col("host"), F.col("path")).alias("grams"))
        scored = self.model.transform(ready)
        return scored.select("row.*", vector_to_array("probability")[1].alias(into))


def judge(
    pages: DataFrame, url: str, rules: Sequence[Rule], classifier: UrlClassifier, cut: float = 0.5
) -> DataFrame:
    """``pages`` with ``host, path, rule, block_score, verdict``: the rule's, else the classifier's.

    Null and malformed URLs have an empty host and path and are judged by the classifier's
    constant term. Existing columns of these names are replaced. Rows are neither lost nor merged.
    """
    new = ("host", "path", "rule", "block_score", "verdict")
    host, path = url_parts(F.col(url))
    # The page's own columns ride in a struct, away from the names used here.
    df = pages.select(F.struct(*pages.columns).alias("page"), host.alias("host"), path.alias("path"))
    df = df.withColumn("rule", rule_of(F.col("host"), F.col("path"), rules))
    df = classifier.score(df, "block_score")
    by_score = F.when(F.col("block_score") >= cut, BLOCK).otherwise(ALLOW)
    df = df.withColumn("verdict", F.coalesce(rule_verdict(F.col("rule"), rules), by_score))
    own = [f"page.`{name}`" for name in pages.columns if name not in new]
    return df.select(*own, *new)


def rule_labels(pages: DataFrame, url: str, rules: Sequence[Rule]) -> DataFrame:
    """``host, path, label`` of the URLs that a rule decides, as a labelled table."""
    host, path = url_parts(F.col(url))
    df = pages.select(host.alias("host"), path.alias("path"))
    name = rule_of(F.col("host"), F.col("path"), rules)
    label = F.when(rule_verdict(name, rules) == BLOCK, 1).when(name.isNotNull(), 0)
    return df.select("host", "path", label.alias("label")).where("label is not null")
