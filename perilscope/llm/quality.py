"""Quality classifier: a sparse ensemble of rules over text statistics.

Small trees are grown on the labelled rows; every path from a root to a node is a conjunctive rule;
a lasso logistic regression weighs the rules, most of them with nothing; what is left is compiled
into one Spark column expression.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from ..session import materialize
from .common import id_remainder, text_col

TREES, DEPTH, LASSO, SEED = 20, 3, 0.0005, 7


def statistics(text: Column) -> dict[str, Column]:
    """Named statistics of a text, all finite; of an empty text all are 0."""
    words = F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")
    lines = F.split(text, "\n")
    n, n_words, n_lines = F.length(text), F.size("_w"), F.size("_l")

    def per(a: Column, b: Column) -> Column:
        return F.when(b > 0, a / b).otherwise(F.lit(0.0)).cast("double")

    def kept(pattern: str) -> Column:
        return F.length(F.regexp_replace(text, pattern, ""))

    next_word = F.zip_with(F.slice("_w", 1, F.greatest(n_words - 1, F.lit(0))), F.slice("_w", 2, F.greatest(n_words - 1, F.lit(0))),
                           lambda a, b: a == b)
    return {
        "_w": words, "_l": lines,
        "words": n_words.cast("double"),
        "word_length": per(n - kept(r"[^\x20\x09-\x0D]+"), n_words),
        "distinct_words": per(F.size(F.array_distinct("_w")), n_words),
        "repeated_next": per(F.size(F.filter(next_word, lambda x: x)), n_words),
        "distinct_lines": per(F.size(F.array_distinct("_l")), n_lines),
        "line_words": per(n_words, n_lines),
        "symbols": per(kept(r"[\p{L}\p{N}\s.,;:!?'\"()-]+"), n),
        "marks": per(n - kept(r"[.,;:!?'\"()-]+"), n),
        "upper": per(kept(r"[^\p{Lu}]+"), n),
        "digits": per(kept(r"[^0-9]+"), n),
        "exclaims": per(n - F.length(F.translate(text, "!", "")), n),
        "bars": per(n - F.length(F.translate(text, "|", "")), n),
        "symbol_words": per(F.size(F.filter("_w", lambda w: w.rlike(r"[^\p{L}\p{N}.,;:!?'\"()]$"))), n_words),
    }


FEATURES = [
    "words", "word_length", "distinct_words", "repeated_next", "distinct_lines", "line_words", "symbols",
    "marks", "upper", "digits", "exclaims", "bars", "symbol_words"]


def with_statistics(docs: DataFrame) -> DataFrame:
    """``doc_id`` and the statistics of every text (null: empty)."""
    d = docs.select("doc_id", text_col().alias("_text"))
    s = statistics(F.col("_text"))
    d = d.withColumns({"_w": s["_w"], "_l": s["_l"]})
    return d.select("doc_id", *[s[c].alias(c) for c in FEATURES])


@dataclass(frozen=True)
class Rule:
    """All of ``terms`` (feature, is above, threshold) hold."""
    terms: tuple[tuple[str, bool, float], ...]

    def column(self) -> Column:
        hold = F.lit(True)
        for name, above, at in self.terms:
            hold = hold & ((F.col(name) > at) if above else (F.col(name) <= at))
        return hold


@dataclass
class Model:
    """``bias`` and weighted rules; the score is the logistic of their sum."""
    bias: float
    rules: list[tuple[Rule, float]]

    def score(self) -> Column:
        total = F.lit(float(self.bias))
        for rule, weight in self.rules:
            total = total + F.when(rule.column(), F.lit(float(weight))).otherwise(F.lit(0.0))
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-total))


def _simplify(terms: list[tuple[str, bool, float]]) -> Rule:
    """The tightest bound of each (feature, side), in a fixed order."""
    best: dict[tuple[str, bool], float] = {}
    for name, above, at in terms:
        old = best.get((name, above))
        best[name, above] = at if old is None else (max if above else min)(old, at)
    return Rule(tuple((n, a, v) for (n, a), v in sorted(best.items())))


def tree_paths(debug: str, features: list[str]) -> list[Rule]:
    """A rule for every node below a root, read from a forest's printed form."""
    found: dict[Rule, None] = {}
    path: list[tuple[int, tuple[str, bool, float]]] = []
    for line in debug.splitlines():
        m = re.match(r"(\s*)(If|Else) \(feature (\d+) (<=|>) (-?[\d.eE+-]+)\)", line)
        if "Tree" in line and not m:
            path = []
        if m:
            depth = len(m[1])
            path = [p for p in path if p[0] < depth]
            path.append((depth, (features[int(m[3])], m[4] == ">", float(m[5]))))
            found[_simplify([t for _, t in path])] = None
    return list(found)


def fit(rows: DataFrame, *, features=FEATURES, trees: int = TREES, depth: int = DEPTH, lasso: float = LASSO,
        seed: int = SEED) -> Model:
    """Fits on ``rows``: the features and a 0/1 ``label``; all rows take part, on the executors.

    The trees are a random forest.  For the lasso the rows are combined by the set of rules that hold
    and the label, so what it goes over is the distinct patterns with their counts.  Without rows of
    both labels the score is the same for all texts: (ones + 1) / (rows + 2).
    """
    from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
    from pyspark.ml.functions import array_to_vector

    n, ones = rows.agg(F.count(F.lit(1)), F.coalesce(F.sum("label"), F.lit(0))).first()
    if not 0 < ones < n:
        p = (ones + 1) / (n + 2)
        return Model(math.log(p / (1 - p)), [])
    vectors = rows.select(array_to_vector(F.array(*features)).alias("features"), F.col("label").cast("double"))
    forest = RandomForestClassifier(numTrees=trees, maxDepth=depth, seed=seed, subsamplingRate=0.7, maxBins=64,
                                    featureSubsetStrategy="onethird").fit(vectors)
    rules = tree_paths(forest.toDebugString, list(features))
    if not rules:
        return Model(math.log(ones / (n - ones)), [])
    held = F.array(*[r.column().cast("double") for r in rules])
    patterns = rows.select(held.alias("held"), "label").groupBy("held", "label").agg(
        F.count(F.lit(1)).cast("double").alias("weight"))
    patterns = materialize(patterns, "rule-patterns").select(
        array_to_vector("held").alias("features"), F.col("label").cast("double"), "weight")
    lr = LogisticRegression(elasticNetParam=1.0, regParam=lasso, maxIter=60, weightCol="weight",
                            standardization=False).fit(patterns)
    kept = [(r, float(w)) for r, w in zip(rules, lr.coefficients.toArray()) if w != 0.0]
    return Model(float(lr.intercept), kept)


def labelled(rows: DataFrame, labels: DataFrame, label: str) -> DataFrame:
    """``rows`` of the training folds with their 0/1 ``label``.

    A training row's crc32(id as text) mod 3 is not 1.  Null ids and null labels are left out; of
    several labels of one id the larger counts.
    """
    one = labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull() & (id_remainder(3) != 1)).groupBy(
        F.col("doc_id").alias("_label_id")).agg(F.max(F.col(label).cast("int")).alias("label"))
    return rows.join(one, rows["doc_id"] == one["_label_id"]).drop("_label_id")


def classify(docs: DataFrame, labels: DataFrame, *, label: str = "quality", threshold: float = 0.5,
             **how) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every document, empty texts too.

    The statistics are stored first, so each text is read once; training joins labels to these
    narrow rows.  Rows that repeat an id are scored each; a null text counts as empty; an empty table
    gives no rows.
    """
    s = materialize(with_statistics(docs), "quality-statistics")
    model = fit(materialize(labelled(s, labels, label), "quality-training"), **how)
    return s.select("doc_id", (id_remainder(3) == 1).alias("held_out"), model.score().alias("score")) \
            .withColumn("predicted", (F.col("score") >= threshold).cast("int"))
