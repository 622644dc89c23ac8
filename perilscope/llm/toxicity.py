"""Toxicity by weak supervision: many voters, a generative label model, a linear classifier.

1. Voters: words and word beginnings that toxic texts of a bounded labelled sample use far more
   often, and a few patterns.  Each votes "toxic" or abstains on every document.
2. Label model: a two-class latent model of the votes of *all* documents, fitted by expectation
   maximisation.  It estimates how often each voter fires in either class (its accuracy) and the
   correlations of voters within the toxic class; voters that repeat each other share their weight.
   The share of toxic texts and the first rates are the labelled sample's.
3. A logistic regression is trained on the posterior labels and scores every document.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from ..session import materialize
from .common import id_remainder, text_col
from .quality import labelled

#: bound of the labelled sample from which the lexicon is drawn (the rows with the smallest digests)
SAMPLE_ROWS = 20_000
LEXICON_VOTERS = 56
BEGINNINGS = (4, 5, 6)
MIN_SHARE = 0.005          # of the toxic sample that must use a term
MIN_LOG_ODDS = 2.0
ROUNDS = 4
CORRELATED = 0.3           # correlations up to this are read as independence
MIN_G2 = 30.0              # likelihood ratio of a term; chance alone stays below it among a million terms
THRESHOLD = 0.7
#: pattern voters, over the whole text
PATTERNS = (r"!!", r"\?\?", r"(?i:\byou (?:are|re)\b)", r"\b\p{Lu}{4,}\b \b\p{Lu}{4,}\b", r"[*#$%&]{3,}")


def words(text: Column) -> Column:
    return F.array_remove(F.array_distinct(F.split(F.lower(text), r"[^\p{L}\p{N}]+")), "")


def _beginnings(ws: Column, k: int, among: list[str] | None = None) -> Column:
    """``<first k letters>*`` of the words of more than k letters (that begin with one of ``among``)."""
    longer = F.filter(ws, lambda x: (F.length(x) > k) if among is None else (
        (F.length(x) > k) & F.substring(x, 1, k).isin(among)))
    return F.transform(longer, lambda x: F.concat(F.substring(x, 1, k), F.lit("*")))


def candidates(text: Column) -> Column:
    """Distinct words, and a beginning marked with ``*`` for every longer word (repeats kept)."""
    return F.transform(F.array(words(text)), lambda ws: F.concat(ws, *[_beginnings(ws, k) for k in BEGINNINGS]))[0]


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, rows: int = SAMPLE_ROWS) -> DataFrame:
    """``doc_id, text, label`` of at most ``rows`` labelled training rows, chosen by digest of the id.

    The chosen ids are at most ``rows``, so they are broadcast and no text is moved.
    """
    ids = labelled(labels.select("doc_id").distinct(), labels, label) \
        .orderBy(F.md5(F.col("doc_id").cast("string").cast("binary")), "doc_id").limit(rows)
    return docs.select("doc_id", text_col().alias("text")).join(
        F.broadcast(ids.select("doc_id", "label")), "doc_id")


def lexicon(sample: DataFrame, *, voters: int = LEXICON_VOTERS) -> list[str]:
    """The terms that tell toxic sample rows best, without those that repeat a chosen beginning.

    Terms are counted by family of copies, not by row.

    Terms of the toxic rows are counted first; the few that a share of them use (their number is
    bounded by the mean terms of a text over that share) are then counted in the clean rows.
    """
    # copies of one text tell no more than one of them: a family shares the smallest hash of its long words
    long_words = F.filter(words(F.col("text")), lambda w: F.length(w) > 8)
    sample = sample.withColumn("family", F.coalesce(F.array_min(F.transform(long_words, lambda w: F.xxhash64(w))), F.col("doc_id")))
    n = {r["label"]: r["n"] for r in sample.groupBy("label").agg(F.count_distinct("family").alias("n")).collect()}
    toxic, clean = n.get(1, 0), n.get(0, 0)
    if not toxic:
        return []
    least = max(3, math.ceil(MIN_SHARE * toxic))
    # of a beginning it counts whether one word has it (``*``) or two different words do (``**``)
    used = sample.select("doc_id", "family", "label", F.explode(candidates(F.col("text"))).alias("stem"))

    def per_text(rows: DataFrame) -> DataFrame:
        n = rows.groupBy("doc_id", "family", "stem").agg(F.count(F.lit(1)).alias("n"))
        return n.select("family", F.explode(F.when(F.col("n") > 1, F.array("stem", F.concat("stem", F.lit("*"))))
                                  .otherwise(F.array("stem"))).alias("term")).distinct()

    often = per_text(used.where("label = 1")).groupBy("term").agg(F.count(F.lit(1)).alias("in_toxic")).where(
        F.col("in_toxic") >= least)
    often = materialize(often, "toxic-terms")
    stems = often.select(F.regexp_replace("term", r"\*\*$", "*").alias("stem")).distinct()
    in_clean = per_text(used.where("label = 0").join(F.broadcast(stems), "stem", "left_semi")).groupBy("term").agg(
        F.count(F.lit(1)).alias("in_clean"))
    rows = often.join(in_clean, "term", "left").na.fill(0).collect()

    def g2(a: int, b: int) -> float:
        """Likelihood ratio of "toxic texts use it more often", 0 below the least log odds."""
        if math.log((a + 0.5) / (toxic + 1)) - math.log((b + 0.5) / (clean + 1)) < MIN_LOG_ODDS:
            return 0.0
        cells = ((a, toxic, a + b), (b, clean, a + b), (toxic - a, toxic, toxic + clean - a - b),
                 (clean - b, clean, toxic + clean - a - b))
        return 2 * sum(x * math.log(x * (toxic + clean) / (row * col)) for x, row, col in cells if x)

    ranked = sorted(((g, r["term"]) for r in rows if (g := g2(r["in_toxic"], r["in_clean"])) >= MIN_G2),
                    key=lambda x: (-x[0], len(x[1]), x[1]))
    chosen: list[str] = []
    for _, term in ranked:
        if len(chosen) >= voters:
            break
        plain = term.rstrip("*")
        # what starts with a chosen beginning, or is the beginning of a chosen term, says little new
        if not any(plain.startswith(c.rstrip("*")) for c in chosen if c.endswith("*")) and not (
                term.endswith("*") and any(c.startswith(plain) for c in chosen)):
            chosen.append(term)
    return chosen


def votes(text: Column, terms: list[str]) -> Column:
    """The voters' bits as a long: bit k is set if term k (then pattern k) votes toxic."""
    whole = [t for t in terms if not t.endswith("*")]
    stems = sorted({t.rstrip("*") for t in terms if t.endswith("*")})
    by_length = {k: [t for t in stems if len(t) == k] for k in BEGINNINGS}

    def hits(ws: Column) -> Column:
        parts = [F.filter(ws, lambda x: x.isin(whole))] if whole else []
        parts += [_beginnings(ws, k, by_length[k]) for k in BEGINNINGS if by_length[k]]
        return F.concat(*parts) if parts else F.array().cast("array<string>")

    def marked(h: Column) -> Column:
        once = F.array_distinct(h)
        twice = F.filter(once, lambda p: F.size(F.filter(h, lambda x: x == p)) > 1)
        return F.filter(F.concat(once, F.transform(twice, lambda p: F.concat(p, F.lit("*")))), lambda x: x.isin(terms))

    bits = F.lit(0).cast("bigint")
    if terms:
        number = F.create_map(*[x for i, t in enumerate(terms) for x in (F.lit(t), F.lit(i))])
        found = F.transform(F.transform(F.array(words(text)), hits), marked)[0]
        bits = F.aggregate(found, bits, lambda a, h: a.bitwiseOR(
            F.call_function("shiftleft", F.lit(1).cast("bigint"), number[h])))
    for i, p in enumerate(PATTERNS):
        bits = bits.bitwiseOR(F.when(text.rlike(p), F.lit(1 << (len(terms) + i))).otherwise(F.lit(0)).cast("bigint"))
    return bits


@dataclass
class LabelModel:
    """Share of toxic texts, each voter's rate of firing in either class, and the voters'
    correlations within the toxic class (0 for those read as independent, and on the diagonal)."""
    prior: float
    toxic: np.ndarray
    clean: np.ndarray
    rho: np.ndarray

    def posterior(self, x: np.ndarray) -> np.ndarray:
        # an abstention says nothing: a lexicon of one language is silent on texts of another
        # voters that repeat each other share their weight where they fire together; alone each has all of it
        weight = x * np.log(self.toxic / self.clean) / (1 + x @ self.rho)
        z = math.log(self.prior / (1 - self.prior)) + weight.sum(1)
        return 1 / (1 + np.exp(-np.clip(z, -500, 500)))


def _bits(v: np.ndarray, n: int) -> np.ndarray:
    return (v.astype("u8")[:, None] >> np.arange(n, dtype="u8") & np.uint64(1)).astype("f8")


def _moments(patterns: DataFrame, model: LabelModel, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Class-weighted sums over all documents: [texts, votes] and pairwise votes of the toxic and the
    clean class, each of (n + 1)^2 numbers, added up by Spark."""
    def run(batches):
        import pyarrow as pa
        total = np.zeros((2, n + 1, n + 1))
        for b in batches:
            x = _bits(b.column(0).to_numpy(zero_copy_only=False), n)
            w = b.column(1).to_numpy(zero_copy_only=False).astype("f8")
            p = model.posterior(x)
            x = np.hstack([np.ones((len(x), 1)), x])
            total[0] += (x * (w * p)[:, None]).T @ x
            total[1] += (x * (w * (1 - p))[:, None]).T @ x
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(total.size)), pa.array(total.ravel())], ["k", "v"])

    out = np.zeros(2 * (n + 1) ** 2)
    for r in patterns.mapInArrow(run, "k bigint, v double").groupBy("k").agg(F.sum("v").alias("v")).collect():
        out[r["k"]] = r["v"]
    both = out.reshape(2, n + 1, n + 1)
    return both[0], both[1]


def label_model(patterns: DataFrame, start: LabelModel, n: int, *, rounds: int = ROUNDS) -> LabelModel:
    """Expectation maximisation over ``bits, n`` (distinct votes with their documents)."""
    model = start
    for _ in range(rounds):
        t, c = _moments(patterns, model, n)

        def rates(m: np.ndarray) -> np.ndarray:
            return np.clip((m[0, 1:] + 0.1) / (m[0, 0] + 1.0), 1e-6, 1 - 1e-6)

        # correlation of two voters within a class, beyond what their rates explain
        rho = np.zeros((n, n))
        if t[0, 0] > 1:
            r = t[0, 1:] / t[0, 0]
            var = np.maximum(r * (1 - r), 1e-9)
            rho = (t[1:, 1:] / t[0, 0] - np.outer(r, r)) / np.sqrt(np.outer(var, var))
            rho = np.where((rho > CORRELATED) & (np.outer(r, r) >= 1e-8), rho, 0.0)
            np.fill_diagonal(rho, 0)
        model = LabelModel(model.prior, rates(t), rates(c), rho)
    return model


def _start(sample: DataFrame, n: int) -> LabelModel:
    """Rates of the voters in the labelled sample: the classes are named by it, the rest is learnt."""
    sums = {r["label"]: r for r in sample.groupBy("label").agg(
        F.count(F.lit(1)).alias("n"), *[F.sum(F.call_function("shiftright", "bits", F.lit(k)).bitwiseAND(F.lit(1))).alias(f"v{k}")
                                        for k in range(n)]).collect()}

    def rates(label: int) -> tuple[int, np.ndarray]:
        r = sums.get(label)
        m = r["n"] if r else 0
        return m, np.array([((r[f"v{k}"] or 0) if r else 0) + 0.5 for k in range(n)]) / (m + 1.0)

    (nt, t), (nc, c) = rates(1), rates(0)
    return LabelModel(min(max((nt + 0.5) / (nt + nc + 1), 1e-3), 0.5), np.clip(t, 1e-4, 1 - 1e-4),
                      np.clip(c, 1e-4, 1 - 1e-4), np.zeros((n, n)))


@dataclass
class Classifier:
    """Voters with the bias and weights of the linear model over their bits."""
    terms: list[str]
    bias: float
    weights: list[float]

    def score(self, bits: Column) -> Column:
        total = F.lit(self.bias)
        for k, w in enumerate(self.weights):
            total = total + _bit(bits, k).cast("double") * F.lit(w)
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-total))


def _bit(bits: Column, k: int) -> Column:
    return F.call_function("shiftright", bits, F.lit(k)).bitwiseAND(F.lit(1))


def train(voted: DataFrame, sample: DataFrame, terms: list[str]) -> Classifier:
    """The linear model on the label model's posteriors.

    ``voted``: the ``bits`` of all documents; ``sample``: ``label, bits`` of the labelled sample.
    """
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.functions import array_to_vector

    n = len(terms) + len(PATTERNS)
    patterns = materialize(voted.groupBy("bits").agg(F.count(F.lit(1)).alias("n")), "vote-patterns")
    model = label_model(patterns, _start(sample, n), n)

    def run(batches):
        import pyarrow as pa
        for b in batches:
            p = model.posterior(_bits(b.column(0).to_numpy(zero_copy_only=False), n))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(p)], ["bits", "n", "p"])

    soft = patterns.mapInArrow(run, "bits bigint, n bigint, p double")
    each = F.array(*[_bit(F.col("bits"), k).cast("double") for k in range(n)])
    both = materialize(soft.select(each.alias("x"), F.explode(F.array(
        F.struct(F.lit(1.0).alias("label"), (F.col("n") * F.col("p")).alias("weight")),
        F.struct(F.lit(0.0).alias("label"), (F.col("n") * (1 - F.col("p"))).alias("weight")))).alias("s")
    ).select("x", "s.label", "s.weight").where("weight > 0"), "posterior-labels")
    lr = LogisticRegression(regParam=1e-6, maxIter=60, weightCol="weight", standardization=False).fit(
        both.select(array_to_vector("x").alias("features"), "label", "weight"))
    return Classifier(terms, float(lr.intercept), [float(w) for w in lr.coefficients.toArray()])


def fit(docs: DataFrame, labels: DataFrame, *, label: str = "toxic",
        sample_rows: int = SAMPLE_ROWS) -> tuple[Classifier, DataFrame]:
    """The classifier and the stored ``doc_id, bits`` of all documents.

    Without toxic or without clean rows in the labelled sample there is nothing to tell apart: the
    score is then (toxic + 1) / (labelled + 2) for every document.
    """
    sample = materialize(labelled_sample(docs, labels, label, sample_rows), "toxicity-sample")
    seen = {r["label"]: r["n"] for r in sample.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    both = bool(seen.get(0) and seen.get(1))
    terms = lexicon(sample) if both else []
    voted = materialize(docs.select("doc_id", votes(text_col(), terms).alias("bits")), "votes")
    if not both:
        p = (seen.get(1, 0) + 1) / (sum(seen.values()) + 2)
        return Classifier([], math.log(p / (1 - p)), []), voted
    return train(voted, sample.select("label", votes(F.col("text"), terms).alias("bits")), terms), voted


def classify(docs: DataFrame, labels: DataFrame, *, threshold: float = THRESHOLD, **how) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every document.

    A null text counts as empty and gets the score of a text on which no voter fires; rows that
    repeat an id are scored each; an empty table gives no rows.
    """
    model, voted = fit(docs, labels, **how)
    return voted.select("doc_id", (id_remainder(3) == 1).alias("held_out"), model.score(F.col("bits")).alias("score")) \
                .withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def clean(docs: DataFrame, labels: DataFrame, *, threshold: float = THRESHOLD, **how) -> DataFrame:
    """The rows of ``docs`` whose score is below ``threshold``, with all their columns."""
    model, _ = fit(docs, labels, **how)
    bits = F.transform(F.array(votes(text_col(), model.terms)), lambda b: model.score(b))[0]
    return docs.where(bits < threshold)
