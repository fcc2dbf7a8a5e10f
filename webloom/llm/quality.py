"""Quality classifier: naive-Bayes support vectors (NB-SVM).

A document is the set of its n-grams, of the whole text, hashed to ``BUCKETS``:
runs of ``GRAMS`` bytes, and runs of up to three word shapes (capitals, last
character, whether the word repeats one of the two before).  Every n-gram indicator is scaled by the log ratio
of its smoothed frequencies in the two classes, each document's vector is divided by its
length (plus a prior, so that a few words weigh little), and a linear hinge-loss model with balanced class costs is fitted by
dual coordinate descent.  Margins become probabilities by a logistic fit on
rows kept out of that fit.

The fit sees a sample of labelled rows, drawn by a hash of doc_id, of about
``SAMPLE`` rows (documented bound; all rows if there are fewer), and of those, in the
order of another hash, as many as have n-gram sets of ``SAMPLE_BYTES`` in all: that is what the
driver holds.  A doc_id that repeats is learnt from once, by its text of the smallest hash.
Scores need one pass over the documents and a model of fixed size.

Only the text is an input of a score.  Rows whose crc32(doc_id) mod 4 is 2 are
held out and never learnt from.  Defined results: null text scores as the
empty one; null doc_id is not held out and has no label; contradictory labels
of one doc_id count by their mean (1 from one half on), null labels not at
all; without two classes to learn from, every score is the share of label 1
(0.5 if there is none); repeated rows score alike; an empty table gives no
rows; extra columns pass through ``keep_good`` untouched.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from webloom.llm.common import Scratch, in_pieces, mix64, prepare, utf8, with_columns, word_bounds, word_hashes

GRAMS = (1, 2, 3, 4)
BUCKETS = 1 << 18
SAMPLE = 12_000
SAMPLE_BYTES = 256 << 20
SMOOTHING = 1.0
COST = 1.0
EPOCHS = 20
THRESHOLD = 0.7
#: Share of a usual document's squared length that is added to every one.
PRIOR = 0.1
_PIECE = 1 << 20


def shapes(text: bytes) -> np.ndarray:
    """A number for the shape of each word."""
    b, starts, ends = word_bounds(text)
    if not len(starts):
        return np.zeros(0, dtype=np.uint64)
    kind = _KIND[b]
    h = word_hashes(text)
    again = np.zeros(len(h), dtype=np.uint64)
    again[2:] = h[2:] == h[:-2]
    again[1:] |= (h[1:] == h[:-1]).astype(np.uint64) * np.uint64(2)
    return ((kind[starts] * np.uint64(8) + kind[np.minimum(starts + 1, ends - 1)]) * np.uint64(8) + kind[ends - 1]) * np.uint64(4) + again


#: lower case or not ASCII, capital, digit, full stop or comma, other
_KIND = np.array([0 if c >= 128 or 97 <= c <= 122 else 1 if 65 <= c <= 90 else 2 if 48 <= c <= 57 else 3 if c in b".,"
                  else 4 for c in range(256)], dtype=np.uint64)


class Grams:
    """n-gram sets of texts; the flag table is reused from text to text."""

    def __init__(self):
        self.flags = np.zeros(BUCKETS, dtype=bool)

    def flag(self, code: np.ndarray, kind: int) -> None:
        self.flags[((code + np.uint64(kind << 40)) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(46)] = True

    def __call__(self, text: bytes) -> np.ndarray:
        for at in range(0, len(text), _PIECE):  # bounded work space; pieces overlap by an n-gram
            b = np.frombuffer(text[at:at + _PIECE + max(GRAMS) - 1], dtype=np.uint8).astype(np.uint64)
            code = np.zeros(len(b), dtype=np.uint64)
            for n in range(1, max(GRAMS) + 1):
                if len(b) < n:
                    break
                code = (code[:len(b) - n + 1] << np.uint64(8)) | b[n - 1:]
                if n in GRAMS:
                    self.flag(code, n)
        shape = shapes(text)
        code = np.zeros(len(shape), dtype=np.uint64)
        for n in range(1, min(3, len(shape)) + 1):
            code = (code[:len(shape) - n + 1] << np.uint64(12)) | shape[n - 1:]
            self.flag(code, 10 + n)
        found = np.flatnonzero(self.flags)
        self.flags[found] = False
        return found


class Model:
    """weights / sqrt(squares + prior) + bias is the margin; a, b its logistic fit."""

    def __init__(self, weights, squares, bias, a, b, prior=1.0):
        self.weights, self.squares, self.bias, self.a, self.b, self.prior = weights, squares, bias, a, b, prior

    def margin(self, grams: np.ndarray) -> float:
        return float(self.weights[grams].sum() / np.sqrt(self.squares[grams].sum() + self.prior) + self.bias)

    def score(self, grams: np.ndarray) -> float:
        return float(1 / (1 + np.exp(-(self.a * self.margin(grams) + self.b))))


def log_count_ratio(rows: list[np.ndarray], y: np.ndarray) -> np.ndarray:
    counts = np.full((2, BUCKETS), SMOOTHING)
    for r, t in zip(rows, y):
        counts[t, r] += 1  # a set: each n-gram once
    return np.log(counts[1] / counts[1].sum()) - np.log(counts[0] / counts[0].sum())


def hinge(rows: list[np.ndarray], values: list[np.ndarray], y: np.ndarray, cost: float = COST,
          epochs: int = EPOCHS, tolerance: float = 0.02) -> tuple[np.ndarray, float]:
    """Linear hinge-loss model by dual coordinate descent; costs balance the classes."""
    sign = np.where(y == 1, 1.0, -1.0)
    upper = cost * len(y) / (2 * np.where(y == 1, y.sum(), len(y) - y.sum()))
    alpha, w, bias = np.zeros(len(y)), np.zeros(BUCKETS), 0.0
    norm = np.array([float(v @ v) for v in values]) + 1.0
    rng = np.random.default_rng(0)
    for _ in range(epochs):
        worst = 0.0
        for i in rng.permutation(len(y)):
            r, v = rows[i], values[i]
            grad = sign[i] * (w[r] @ v + bias) - 1.0
            new = min(max(alpha[i] - grad / norm[i], 0.0), upper[i])
            step = new - alpha[i]
            if step:
                worst = max(worst, abs(step) * norm[i])
                alpha[i] = new
                w[r] += (step * sign[i]) * v
                bias += step * sign[i]
        if worst < tolerance:
            break
    return w, bias


def logistic(margins: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and offset of P(1 | margin), with targets drawn in by the class sizes."""
    pos, neg = y.sum(), len(y) - y.sum()
    t = np.where(y == 1, (pos + 1) / (pos + 2), 1 / (neg + 2))
    x = np.column_stack([margins, np.ones(len(y))])
    beta = np.array([1.0, 0.0])
    loss = lambda b: float(np.sum(np.logaddexp(0, x @ b) - t * (x @ b)))
    for _ in range(100):
        p = 1 / (1 + np.exp(-(x @ beta)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + 1e-6 * np.eye(2), x.T @ (p - t))
        size = 1.0
        while size > 1e-6 and loss(beta - size * step) > loss(beta):
            size /= 2
        beta = beta - size * step
        if np.abs(size * step).max() < 1e-8:
            break
    return float(max(beta[0], 1e-3)), float(beta[1])


def fit(rows: list[np.ndarray], y: np.ndarray, check: np.ndarray) -> Model:
    """``check`` marks the rows that only the logistic fit sees."""
    zero = np.zeros(BUCKETS, dtype=np.float32)
    both = lambda m: 0 < y[m].sum() < m.sum()
    if not len(y) or not both(np.ones(len(y), bool)):
        share = float(np.clip(y.mean() if len(y) else 0.5, 1e-6, 1 - 1e-6))
        return Model(zero, zero, 0.0, 1.0, float(np.log(share / (1 - share))))
    if not both(check) or not both(~check):
        check = np.zeros(len(y), bool)
    learn = np.flatnonzero(~check)
    ratio = log_count_ratio([rows[i] for i in learn], y[learn])
    squares = ratio ** 2
    prior = PRIOR * float(np.median([squares[rows[i]].sum() for i in learn])) + 1e-9
    values = [(ratio[r] / np.sqrt(squares[r].sum() + prior)).astype(np.float32) for r in (rows[i] for i in learn)]
    w, bias = hinge([rows[i] for i in learn], values, y[learn])
    model = Model((ratio * w).astype(np.float32), squares.astype(np.float32), bias, 1.0, 0.0, prior)
    seen = np.flatnonzero(check) if check.any() else learn
    model.a, model.b = logistic(np.array([model.margin(rows[i]) for i in seen]), y[seen])
    return model


def held_out(doc_id="doc_id") -> F.Column:
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, sample_bytes: int = SAMPLE_BYTES) -> Model:
    prepare(docs.sparkSession)
    known = (labels.select(F.col("doc_id").cast("long").alias("_q_id"), F.col("quality").cast("double").alias("_q"))
             .filter("_q_id IS NOT NULL AND _q IS NOT NULL").filter(~held_out("_q_id"))
             .groupBy("_q_id").agg((F.avg("_q") >= 0.5).cast("int").alias("_q")))
    rate = min(1.0, sample / max(1, known.count()))
    u = F.pmod(F.xxhash64("_q_id", F.lit(9)), F.lit(1 << 30))
    drawn = known.filter(u < int(rate * (1 << 30)))
    # bounded: about `sample` rows of two numbers
    rows = docs.select("doc_id", "text").join(F.broadcast(drawn), F.col("doc_id") == F.col("_q_id"))

    def grams(batches):
        of = Grams()
        for b in in_pieces(batches):
            found = [of(t).astype(np.int32) for t in utf8(b.column("text"))]
            yield with_columns(b, ["_q_id", "_q", "_q_hash"], grams=pa.array([f.tobytes() for f in found], pa.binary()))

    found = (rows.select("_q_id", "_q", F.xxhash64("text").alias("_q_hash"), "text")
             .mapInArrow(grams, "_q_id long, _q int, _q_hash long, grams binary"))
    scratch = Scratch(docs.sparkSession, "quality")
    stored = one = scratch.save(found.groupBy("_q_id", "_q").agg(F.min_by("grams", F.struct("_q_hash", "grams")).alias("grams")))
    sizes = one.select("_q_id", F.octet_length("grams").alias("n")).toPandas().assign(place=lambda d: mix64(d["_q_id"].to_numpy().astype(np.uint64)))
    sizes = sizes.sort_values("place", kind="stable")
    fits = sizes["_q_id"][sizes["n"].cumsum() <= sample_bytes]
    if len(fits) < len(sizes):
        one = one.join(F.broadcast(docs.sparkSession.createDataFrame([(int(i),) for i in fits], "_q_id long")), "_q_id")
    got = one.toArrow()
    scratch.drop(stored)
    ids, y = got.column("_q_id").to_numpy(), got.column("_q").to_numpy()
    sets = [s for chunk in got.column("grams").chunks for s in _views(chunk)]
    order = sorted(range(len(ids)), key=lambda i: (ids[i], len(sets[i]), sets[i][:50].tolist()))
    return fit([sets[i] for i in order], y[order], ids[order] % 5 == 3)


def _views(chunk: pa.Array) -> list[np.ndarray]:
    """The n-gram sets in a chunk, without copies."""
    _, offsets, data = chunk.buffers()
    at = np.frombuffer(offsets, dtype=np.int32)[chunk.offset:chunk.offset + len(chunk) + 1]
    if data is None:
        return [np.zeros(0, dtype=np.int32)] * len(chunk)
    return [np.frombuffer(data, dtype=np.int32, count=(b - a) // 4, offset=a) for a, b in zip(at[:-1].tolist(), at[1:].tolist())]


def _scores(model):
    of, m = Grams(), model.value
    return lambda batch: np.array([m.score(of(t)) for t in utf8(batch.column("text"))], dtype=np.float64)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, held_out, score) of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        of = _scores(shared)
        for b in in_pieces(batches):
            yield with_columns(b, ["doc_id", "held_out"], score=pa.array(of(b)))
    rows = docs.select("doc_id", held_out().alias("held_out"), "text")
    return rows.mapInArrow(run, "doc_id long, held_out boolean, score double")


def keep_good(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` whose score reaches the threshold."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        of = _scores(shared)
        for b in in_pieces(batches):
            yield b.filter(pa.array(of(b) >= threshold))
    return docs.mapInArrow(run, docs.schema)
