"""Language-model scores: a log-bilinear neural model trained with noise-contrastive estimation.

The model predicts the class of a token from the classes of the two tokens before it.  The most
frequent tokens are classes of their own; every other token belongs to a class by its shape, within
which it has its smoothed share.  So each token has a normalised probability, also one never seen:

    P(token | context) = P(class | context) * (c + 0.1) / (C + 0.1 (V + 1))     (c, C, V of the class)

Counts (of tokens and of class triples) cover all training texts and are added up by Spark.  The fit
weighs every counted triple by its count: the contexts are dealt to parts, tasks improve the
parameters on their part in numpy, and each round takes the mean.  Scoring is by matrix products of
whole blocks of contexts.  Tokens are bytes; the end of a text is ``b""``.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, functions as F

from ..session import materialize
from .common import id_remainder

OWN_CLASSES = 480
#: tokens of at least this share of all tokens are looked up in the task: at most 1 / share of them
FREQUENT_SHARE = 1e-6
SMOOTH = 0.1
DIM, NOISE, BATCH, RATE, SEED = 24, 256, 256, 0.1, 11
ROUNDS, STEPS = 12, 250
#: contexts of a part: at most (classes + 1) ** 2 / PART_CONTEXTS parts, whatever the corpus
PART_CONTEXTS = 20_000
#: into so many pieces of equal weight, or more, a part's contexts are cut, so that none rules a step
PIECES = 20_000
END = b""
COUNTER_ENTRIES = 400_000
CHUNK_BYTES = 4_000_000

_DIGIT, _SYMBOL = re.compile(rb"[0-9]"), re.compile(rb"[^a-z0-9.,;:!?'\"()\x80-\xff-]")


def tokens(text: bytes | None) -> list[bytes]:
    """Words (A-Z in lower case), then the end; bytes split on exactly the ASCII white space."""
    words = text.lower().split() if text else []
    words.append(END)
    return words


def shape(token: bytes) -> int:
    """One of 32 classes of tokens that have none of their own."""
    last = token[-1:]
    tail = 1 if last == b"." else 2 if last in (b",", b";", b":") else 3 if last in (b"!", b"?") else 0
    kind = (0 if token.isalpha() else 1) if token.isascii() else 2       # plain, with marks, other letters
    if _DIGIT.search(token) or _SYMBOL.search(token):
        kind = 3
    return (tail * 4 + kind) * 2 + (len(token) > 8)


SHAPES = 32


@dataclass
class Model:
    """Token classes, their totals, and the fitted parameters.

    Classes: own tokens first, then the shapes, then the start of a text (a context only).
    """
    own: dict[bytes, int]
    denominators: np.ndarray        # per shape: C + 0.1 (V + 1)
    first: np.ndarray               # scores of (class before the last, class)
    last: np.ndarray                # scores of (last class, class)
    bias: np.ndarray

    @property
    def size(self) -> int:
        return len(self.bias)

    def log_totals(self, before: np.ndarray, last: np.ndarray) -> np.ndarray:
        """ln of the sum over all classes, for each context."""
        out = np.empty(len(before), "f4")
        for lo in range(0, len(before), 4096):
            z = self.first[before[lo:lo + 4096]] + self.last[last[lo:lo + 4096]] + self.bias
            top = z.max(1, keepdims=True)
            out[lo:lo + 4096] = (top + np.log(np.exp(z - top).sum(1, keepdims=True)))[:, 0]
        return out


class Coder:
    """Classes of tokens; shapes of tokens seen are kept in a bounded cache."""

    def __init__(self, own: dict[bytes, int]):
        self.own, self.cache, self.start = own, dict(own), len(own) + SHAPES

    def codes(self, words: list[bytes]) -> np.ndarray:
        if len(self.cache) > COUNTER_ENTRIES:
            self.cache = dict(self.own)
        cache = self.cache
        for w in {w for w in words if w not in cache}:
            cache[w] = len(self.own) + shape(w)
        return np.fromiter(map(cache.__getitem__, words), "i8", len(words))

    def contexts(self, code: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Classes of the two tokens before each, texts laid end to end."""
        begin = np.concatenate([[0], np.cumsum(length)[:-1]])
        last, before = np.roll(code, 1), np.roll(code, 2)
        last[begin] = before[begin] = self.start
        second = begin[length > 1] + 1
        before[second] = self.start
        return before, last


def _chunks(texts: list[bytes | None]):
    lo = size = 0
    for i, t in enumerate(texts):
        size += len(t or b"")
        if size >= CHUNK_BYTES:
            yield lo, i + 1
            lo, size = i + 1, 0
    if lo < len(texts):
        yield lo, len(texts)


def _training(docs: DataFrame) -> DataFrame:
    return docs.where(id_remainder(10) != 0)


def token_counts(docs: DataFrame) -> DataFrame:
    """``token, n`` (stored) over all texts of ``docs``; tasks count before the shuffle."""
    def run(batches):
        import pyarrow as pa

        def flush(c: Counter):
            return pa.RecordBatch.from_arrays([pa.array(list(c), pa.binary()), pa.array(list(c.values()), pa.int64())],
                                              ["token", "n"])
        count: Counter = Counter()
        for b in batches:
            for text in b.column(0).to_pylist():
                count.update(tokens(text))
                if len(count) > COUNTER_ENTRIES:
                    yield flush(count)
                    count = Counter()
        yield flush(count)

    texts = docs.select(F.col("text").cast("string").cast("binary"))
    return materialize(texts.mapInArrow(run, "token binary, n bigint").groupBy("token").agg(F.sum("n").alias("n")), "token-counts")


def triple_counts(docs: DataFrame, own: dict[bytes, int]) -> DataFrame:
    """``key, n`` of the class triples of all texts: key = (before * size + last) * size + class."""
    def run(batches):
        import pyarrow as pa
        coder = Coder(own)
        m = coder.start + 1
        for b in batches:
            texts = b.column(0).to_pylist()
            for lo, hi in _chunks(texts):
                words = [tokens(t) for t in texts[lo:hi]]
                length = np.array([len(w) for w in words])
                code = coder.codes([w for ws in words for w in ws])
                before, last = coder.contexts(code, length)
                key, n = np.unique((before * m + last) * m + code, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(n)], ["key", "n"])

    texts = docs.select(F.col("text").cast("string").cast("binary"))
    return texts.mapInArrow(run, "key bigint, n bigint").groupBy("key").agg(F.sum("n").alias("n"))


def nce_start(frequency: np.ndarray, *, dim: int = DIM, seed: int = SEED) -> dict[str, np.ndarray]:
    """Parameters before the fit, from the classes' counts: biases at the log frequencies, vectors near 0
    (the untrained model is the class unigram)."""
    rng = np.random.default_rng(seed)
    size = len(frequency)
    q = (frequency + 0.5) / (frequency + 0.5).sum()
    p = {"r": rng.normal(0, 0.1, (size + 1, dim)), "w": rng.normal(0, 0.1, (size, dim)), "b": np.log(q),
         "c1": np.eye(dim) + rng.normal(0, 0.01, (dim, dim)), "c2": np.eye(dim) * 0.5 + rng.normal(0, 0.01, (dim, dim))}
    return {k: v.astype("f4") for k, v in p.items()}


def _add_rows(out: np.ndarray, at: np.ndarray, rows: np.ndarray) -> None:
    order = np.argsort(at, kind="stable")
    first = np.flatnonzero(np.diff(at[order], prepend=-1))
    out[at[order][first]] += np.add.reduceat(rows[order], first, axis=0)


def nce_pass(p: dict, seen: dict, key: np.ndarray, n: np.ndarray, frequency: np.ndarray, rng: np.random.Generator, *,
             noise: int = NOISE, batch: int = BATCH, rate: float = RATE, pieces: int = PIECES, passes: int | None = None) -> None:
    """Improve the parameters ``p`` (and Adagrad's sums ``seen``) in place on all triples ``key, n``.

    A context is the sum of its two classes' vectors, each by its position's matrix; a class scores
    by its product with its own vector and its bias.  Each step tells the counted classes of a batch
    of contexts from ``noise`` classes a token drawn from their frequencies; the expectation over the
    draws is taken whole, class by class.  A context's counts, cut into equal pieces where they are
    large, weigh as much as they are.  Without ``passes``: whole passes until there are STEPS steps.
    """
    if not len(key):
        return
    size = len(frequency)
    m = size + 1
    q = (frequency + 0.5) / (frequency + 0.5).sum()
    kq = (noise * q).astype("f4")
    log_kq = np.log(kq)
    order = np.argsort(key, kind="stable")
    key, n = key[order], n[order]
    context, start = np.unique(key // m, return_index=True)
    held = np.diff(start, append=len(key))
    total, target = np.add.reduceat(n, start), key % m
    times = np.minimum(total, np.ceil(total * (pieces / total.sum()))).astype("i8")
    unit = times.sum() / (times * total.sum())               # weights: 1 for the mean piece
    rows = np.repeat(np.arange(len(context)), times)
    for _ in range(passes or math.ceil(STEPS / math.ceil(len(rows) / batch))):
        shuffled = rng.permutation(rows)
        for lo in range(0, len(rows), batch):
            i = shuffled[lo:lo + batch]
            before, last, many = context[i] // m, context[i] % m, held[i]
            at = np.repeat(np.arange(len(i)), many)
            of = np.arange(len(at)) + np.repeat(start[i] - np.cumsum(many) + many, many)
            counted = np.zeros((len(i), size), "f4")
            counted[at, target[of]] = n[of] * unit[i][at]
            rl, rb = p["r"][last], p["r"][before]
            h = rl @ p["c1"] + rb @ p["c2"]
            z = h @ -p["w"].T
            z += log_kq - p["b"]
            np.exp(np.clip(z, -30, 30, out=z), out=z)
            z += 1                                           # 1 / P(data)
            slope = (total[i] * unit[i]).astype("f4")[:, None] * kq
            slope += counted
            slope /= z
            np.subtract(counted, slope, out=slope)           # counted * (1 - P(data)) - noise * P(data)
            gh = slope @ p["w"]
            g = {"r": np.zeros_like(p["r"]), "w": slope.T @ h, "b": slope.sum(0), "c1": rl.T @ gh, "c2": rb.T @ gh}
            _add_rows(g["r"], last, gh @ p["c1"].T)
            _add_rows(g["r"], before, gh @ p["c2"].T)
            for name in p:
                step = g[name] * np.float32(noise / len(i))
                seen[name] += step * step
                p[name] += np.float32(rate) * step / np.sqrt(seen[name])


def nce_scores(p: dict) -> tuple[np.ndarray, ...]:
    """Scores by the class before the last, by the last class, and biases."""
    return p["r"] @ p["c2"] @ p["w"].T, p["r"] @ p["c1"] @ p["w"].T, p["b"]


def _sums(p: dict) -> dict[str, np.ndarray]:
    return {k: np.full_like(v, 0.1) for k, v in p.items()}


def fit_nce(sample: np.ndarray, size: int, *, dim: int = DIM, noise: int = NOISE, batch: int = BATCH,
            epochs: int = 3, rate: float = RATE, seed: int = SEED) -> tuple[np.ndarray, ...]:
    """The fit to ``sample`` (key, n) in this process: ``epochs`` passes, scores as of ``nce_scores``."""
    frequency = np.bincount(sample[:, 0] % (size + 1), weights=sample[:, 1], minlength=size)
    p = nce_start(frequency, dim=dim, seed=seed)
    nce_pass(p, _sums(p), sample[:, 0], sample[:, 1], frequency, np.random.default_rng(seed),
             noise=noise, batch=batch, rate=rate, passes=epochs)
    return nce_scores(p)


def deal_triples(triples: DataFrame, size: int) -> DataFrame:
    """``part, key, n`` (stored): all triples, one row a part with its whole contexts (int64 bytes).

    The classes bound the contexts, so also the parts and a part's length; counts only grow.
    """
    triples = materialize(triples, "class-triples")
    context = F.expr(f"key div {size + 1}")
    parts = max(1, math.ceil(triples.select(context.alias("c")).distinct().count() / PART_CONTEXTS))

    def pack(table):
        import pyarrow as pa
        key, n = (table.column(c).to_numpy() for c in ("key", "n"))
        order = np.argsort(key)
        return pa.table({"part": table.column("part").slice(0, 1), "key": pa.array([key[order].tobytes()], pa.binary()),
                         "n": pa.array([n[order].tobytes()], pa.binary())})

    dealt = triples.select(F.pmod(F.xxhash64(context), F.lit(parts)).alias("part"), "key", "n").repartition(parts, "part")
    return materialize(dealt.groupBy("part").applyInArrow(pack, "part bigint, key binary, n binary"), "dealt-triples")


def train(dealt: DataFrame, frequency: np.ndarray, *, rounds: int = ROUNDS, pieces: int = PIECES) -> dict[str, np.ndarray]:
    """The parameters fitted to all triples: every round each part improves them on its own triples, and
    the mean by the parts' tokens is kept (of Adagrad's sums too)."""
    p = nce_start(frequency)
    seen = _sums(p)
    spark = dealt.sparkSession
    for turn in range(rounds):
        shared = spark.sparkContext.broadcast((p, seen, frequency))

        def run(batches, shared=shared, turn=turn):
            import pyarrow as pa
            for b in batches:
                for part, key, n in zip(*(b.column(i).to_pylist() for i in range(3))):
                    own, sums = ({k: v.copy() for k, v in d.items()} for d in shared.value[:2])
                    n = np.frombuffer(n, "i8")
                    nce_pass(own, sums, np.frombuffer(key, "i8"), n, shared.value[2],
                             np.random.default_rng([SEED, turn, part]), pieces=pieces)
                    flat = np.concatenate([v.ravel() for d in (own, sums) for v in d.values()])
                    yield pa.RecordBatch.from_arrays([pa.array([part]), pa.array([int(n.sum())]), pa.array([flat.tobytes()], pa.binary())],
                                                     ["part", "tokens", "flat"])

        found = sorted(dealt.select("part", "key", "n").mapInArrow(run, "part bigint, tokens bigint, flat binary").collect())
        shared.destroy()
        if not found:
            break
        mean = sum(np.frombuffer(r["flat"], "f4").astype("f8") * r["tokens"] for r in found) / sum(r["tokens"] for r in found)
        cut = np.cumsum([v.size for d in (p, seen) for v in d.values()])[:-1]
        flat = iter(np.split(mean.astype("f4"), cut))
        p, seen = ({k: next(flat).reshape(v.shape) for k, v in d.items()} for d in (p, seen))
    return p


def fit(docs: DataFrame, counts: DataFrame, *, pieces: int = PIECES) -> Model:
    """The model of the training texts ``docs``, whose token counts are ``counts``."""
    top = counts.where(F.length("token") >= 0).orderBy(F.col("n").desc(), "token").limit(OWN_CLASSES).collect()
    own = {bytes(r["token"]): i for i, r in enumerate(top)}

    def by_shape(batches):
        import pyarrow as pa
        s = np.zeros((SHAPES, 2), "i8")
        for b in batches:
            for t, n in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                if t not in own:
                    s[shape(t)] += (n, 1)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(SHAPES)), pa.array(s[:, 0]), pa.array(s[:, 1])], ["shape", "c", "v"])

    denominators = np.full(SHAPES, SMOOTH)
    frequency = np.array([r["n"] for r in top] + [0] * SHAPES, "f8")
    for r in counts.mapInArrow(by_shape, "shape bigint, c bigint, v bigint").groupBy("shape").agg(
            F.sum("c").alias("c"), F.sum("v").alias("v")).collect():
        denominators[r["shape"]] = r["c"] + SMOOTH * (r["v"] + 1)
        frequency[len(own) + r["shape"]] = r["c"]
    dealt = deal_triples(triple_counts(docs, own), len(own) + SHAPES)
    return Model(own, denominators, *nce_scores(train(dealt, frequency, pieces=pieces)))


class Scorer:
    """Scores chunks of texts with everything a task knows: the model and the frequent tokens' counts."""

    def __init__(self, model: Model, frequent: dict[bytes, int]):
        self.model, self.frequent, self.coder = model, frequent, Coder(model.own)
        m = model.size + 1
        self.totals = np.full(m * m, np.nan, "f4")               # ln of the sums, by context, as they come up
        self.log_c = {t: math.log10(n + SMOOTH) for t, n in frequent.items()}
        self.log_class = np.concatenate([np.zeros(len(model.own)), np.log10(model.denominators)])

    def score(self, texts: list[bytes | None]):
        """Per text: tokens, frequent tokens, their part of the base sum and of the score, the other tokens."""
        m, model = self.model.size + 1, self.model
        words = [tokens(t) for t in texts]
        length = np.array([len(w) for w in words])
        flat = [w for ws in words for w in ws]
        code = self.coder.codes(flat)
        before, last = self.coder.contexts(code, length)
        context = before * m + last
        new = np.unique(context[np.isnan(self.totals[context])])
        self.totals[new] = model.log_totals(new // m, new % m)
        ln = model.first[before, code] + model.last[last, code] + model.bias[code] - self.totals[context]
        in_class = code >= len(model.own)
        log_c = np.fromiter((self.log_c.get(w, np.nan) for w in flat), "f8", len(flat))
        known = ~np.isnan(log_c)
        c = np.where(known, log_c, 0.0)
        at = np.concatenate([[0], np.cumsum(length)[:-1]])
        base = np.add.reduceat(c, at)
        score = np.add.reduceat(ln.astype("f8") / math.log(10) + np.where(in_class, c - self.log_class[code], 0.0), at)
        rare = [[flat[i] for i in np.flatnonzero(~known[a:a + n]) + a] for a, n in zip(at, length)]
        return length, np.add.reduceat(known.astype("i8"), at), base, score, rare


def score_documents(docs: DataFrame, *, draws: int = PIECES, frequent_share: float = FREQUENT_SHARE) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` of every document.

    base_score: the smoothed unigram log10 probability; score: the model's.  Null and empty texts are
    the end token alone.  Training texts are those whose crc32(id as text) mod 10 is not 0; without
    any, all counts are 0 and the model is uniform over its classes.  Rows that repeat an id are
    scored each.

    Frequent tokens are looked up in the task (their number is bounded by 1 / ``frequent_share``);
    the occurrences of all others are joined with the stored counts and added up by row.
    ``draws``: the pieces of the fit (PIECES); all triples are in it, whatever their number.
    """
    texts = _training(docs.select("doc_id", "text"))
    counts = token_counts(texts)
    n, v = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first()
    model = fit(texts, counts, pieces=draws)
    often = counts.where(F.col("n") >= max(1.0, frequent_share * n)).toPandas()
    frequent = dict(zip(map(bytes, often["token"]), often["n"].tolist()))
    frequent.update({t: 0 for t in model.own if t not in frequent})
    shared = docs.sparkSession.sparkContext.broadcast((model, frequent))

    def run(batches):
        import pyarrow as pa
        scorer = Scorer(*shared.value)
        for b in batches:
            ids, held, texts = (b.column(i).to_pylist() for i in range(3))
            for lo, hi in _chunks(texts):
                length, known, base, score, rare = scorer.score(texts[lo:hi])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids[lo:hi], pa.int64()), pa.array(held[lo:hi], pa.bool_()), pa.array(length), pa.array(known),
                     pa.array(base), pa.array(score), pa.array(rare, pa.list_(pa.binary()))],
                    ["doc_id", "held_out", "n_tokens", "n_frequent", "base", "part", "rare"])

    rows = docs.select(F.col("doc_id").cast("bigint"), (id_remainder(10) == 0).alias("held_out"),
                       F.col("text").cast("string").cast("binary")).mapInArrow(
        run, "doc_id bigint, held_out boolean, n_tokens bigint, n_frequent bigint, base double, part double, rare array<binary>")
    rows = materialize(rows.withColumn("row", F.monotonically_increasing_id()), "scored-rows")
    rare = rows.select("row", F.explode("rare").alias("token")).join(counts, "token", "left")
    # per text the sum of log10(c + 0.1) of its other tokens, and how many of them are known
    sums = rare.groupBy("row").agg(F.sum(F.log10(F.coalesce("n", F.lit(0)) + SMOOTH)).alias("more"),
                                   F.count("n").alias("n_more"))
    more, n_more = F.coalesce("more", F.lit(0.0)), F.coalesce("n_more", F.lit(0))
    each = math.log10(n + SMOOTH * (v + 1))
    return rows.drop("rare").join(sums, "row", "left").select(
        "doc_id", "held_out", "n_tokens", (F.col("n_frequent") + n_more).alias("n_known"),
        F.lit(int(n)).cast("bigint").alias("train_tokens"),
        (F.col("base") + more - F.col("n_tokens") * each).alias("base_score"), (F.col("part") + more).alias("score"))
