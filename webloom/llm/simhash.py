"""SimHash near-duplicates by the generalised pigeonhole principle.

A fingerprint bit is set if it is set in over half of the XXH64 hashes of a
text's word shingles.  Equal fingerprints collapse to one entry.  To find all
pairs within ``distance`` bits, correlated bits (measured on a bounded sample of
fingerprints) are grouped into partitions, and each partition i gets its own
threshold t_i with sum(t_i + 1) = distance + 1: whenever two fingerprints differ
in at most ``distance`` bits, they differ in at most t_i bits of some
partition i.  Dynamic programming picks the thresholds (and the number of
partitions) by estimated probes and candidates.  Every fingerprint is indexed
by its exact bits of each partition and probes all values within t_i; the
join verifies the full distance, so only links come out of it.

The sample steers cost, never the result.  Links are reduced to components by
``components``; copies are never expanded into pairs.

Defined results: null, empty and white-space texts have fingerprint 0, linked
like any other; repeated rows keep their own row; documents with a null doc_id
get a fingerprint but are in no component; an empty table gives no rows; very
long texts are hashed in pieces.
"""

from __future__ import annotations

from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from webloom.llm.common import Scratch, in_pieces, utf8, with_columns
from webloom.llm.components import connected_components

SHINGLE_WORDS = 4
DISTANCE = 4
SEED = 42
SAMPLE = 20_000
MAX_PARTITIONS = 5
#: Cost of a probe row (written, shuffled, sorted) against that of a candidate (one comparison in the merge).
PROBE_COST = 10.0
_PIECE = 1 << 16


def fingerprint(text: bytes, shingle_words: int = SHINGLE_WORDS) -> int:
    """The SimHash of a UTF-8 text as an unsigned number."""
    words = text.lower().split()  # of bytes: A-Z only, ASCII white space
    if not words:
        return 0
    n = max(1, len(words) - shingle_words + 1)
    ones = np.zeros(64, dtype=np.int64)
    digest = xxhash.xxh64_digest
    for i in range(0, n, _PIECE):
        part = words[i:i + min(_PIECE, n - i) + shingle_words - 1]
        line = b" ".join(part)
        ends = np.cumsum(np.fromiter(map(len, part), np.int64, len(part)) + 1)
        m = max(1, len(part) - shingle_words + 1)
        lows = [0, *(ends[:m - 1]).tolist()]
        highs = (ends[shingle_words - 1:shingle_words - 1 + m] - 1).tolist() if len(part) >= shingle_words else [len(line)]
        h = b"".join([digest(line[a:b], SEED) for a, b in zip(lows, highs)])  # big-endian
        bits = np.unpackbits(np.frombuffer(h, dtype=np.uint8).reshape(m, 8), axis=1)
        for j in range(0, m, 255):  # sums of 255 bits fit a byte
            ones += np.add.reduce(bits[j:j + 255], axis=0, dtype=np.uint8)
    return int(np.packbits(2 * ones > n).view(">u8")[0])


def fingerprints(docs: DataFrame, shingle_words: int = SHINGLE_WORDS) -> DataFrame:
    """(doc_id, fp long) of every row."""
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return _with_fingerprint(slim, "fp", shingle_words, ["doc_id"])


def _with_fingerprint(docs: DataFrame, name: str, shingle_words: int, keep: list[str]) -> DataFrame:
    """Some columns of ``docs`` and the fingerprint of its text."""
    def run(batches):
        for b in in_pieces(batches):
            fp = np.array([fingerprint(t, shingle_words) for t in utf8(b.column("text"))], dtype=np.uint64)
            yield with_columns(b, keep, **{name: pa.array(fp.view(np.int64))})
    return docs.mapInArrow(run, StructType([*(docs.schema[c] for c in keep), StructField(name, LongType())]))


def group_bits(bits: np.ndarray, parts: int) -> list[list[int]]:
    """Partitions of the 64 bit positions: correlated bits go together.

    Greedy: a partition starts with the free bit that is most correlated with
    the others and takes the free bits most correlated with its own."""
    spread = bits.std(axis=0) > 0
    corr = np.zeros((64, 64))
    if spread.sum() > 1:
        corr[np.ix_(spread, spread)] = np.abs(np.corrcoef(bits[:, spread].T))
    np.fill_diagonal(corr, 0)
    free, out = list(range(64)), []
    for p in range(parts):
        want = len(free) // (parts - p)
        own = [max(free, key=lambda b: (corr[b, free].sum(), -b))]
        free.remove(own[0])
        while len(own) < want:
            own.append(max(free, key=lambda b: (corr[b, own].sum(), -b)))
            free.remove(own[-1])
        out.append(sorted(own))
    return out


def _near(keys: np.ndarray, width: int) -> list[float]:
    """Share of pairs of sampled keys within 0, 1, 2, ... bits (estimated)."""
    rng = np.random.default_rng(1)
    a, b = rng.permutation(keys), rng.permutation(keys)
    counts = np.bincount(np.bitwise_count(a[:, None] ^ b[None, :256]).ravel(), minlength=width + 1)
    values, times = np.unique(keys, return_counts=True)
    n = len(keys)
    same = max((times * (times - 1)).sum() / max(1, n * (n - 1)), 2.0 ** -width)
    shares = [same]
    for t in range(1, width + 1):
        seen = counts[:t + 1].sum() / counts.sum()
        uniform = sum(comb(width, i) for i in range(t + 1)) / 2.0 ** width
        shares.append(max(seen, uniform, shares[-1]))
    return shares


def allocate(cost: list[list[float]], total: int) -> tuple[float, list[int]]:
    """Thresholds of least cost: cost[i][t + 1] for threshold t = -1, 0, ...
    (-1: partition not probed), with sum(t + 1) = total; dynamic programming."""
    best: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
    for row in cost:
        new: dict[int, tuple[float, list[int]]] = {}
        for used, (c, chosen) in best.items():
            for t1 in range(min(len(row), total - used + 1)):
                key, value = used + t1, (c + row[t1], [*chosen, t1 - 1])
                if key not in new or value < new[key]:
                    new[key] = value
        best = new
    return best[total]


def plan(sample: np.ndarray, n: int, distance: int = DISTANCE) -> tuple[list[list[int]], list[int]]:
    """Partitions of the bits and their thresholds for n fingerprints."""
    bits = np.unpackbits(sample.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").astype(float)
    options = []
    for parts in range(1, min(MAX_PARTITIONS, distance + 1) + 1):
        groups = group_bits(bits, parts)
        cost = []
        for g in groups:
            keys = (bits[:, g] @ (2.0 ** np.arange(len(g)))).astype(np.uint64)
            shares = _near(keys, len(g))
            cost.append([0.0] + [n * PROBE_COST * (sum(comb(len(g), i) for i in range(t + 1)) + 1) + n * n * shares[t]
                                 for t in range(min(distance, len(g)) + 1)])
        options.append((*allocate(cost, distance + 1), groups))
    _, thresholds, groups = min(options, key=lambda o: o[0])
    return groups, thresholds


def _mask(bits) -> int:
    return int(np.array(sum(1 << b for b in bits), dtype=np.uint64).view(np.int64))


def _probes(i: int, mask, flips) -> F.Column:
    own = F.col("fp").bitwiseAND(mask)
    return F.transform(flips, lambda f: F.struct(F.lit(i).alias("p"), own.bitwiseXOR(f).alias("key")))


def links(fps: DataFrame, distance: int = DISTANCE, sample: int = SAMPLE) -> DataFrame:
    """Pairs (x, y), x < y, of the distinct fingerprints in ``fps`` (fp) that
    differ in at most ``distance`` bits.  A pair may come out more than once."""
    n = fps.count()
    u = F.pmod(F.xxhash64("fp"), F.lit(1 << 30))
    rate = min(1.0, sample / max(1, n))
    drawn = np.array([r[0] for r in fps.filter(u < int(rate * (1 << 30))).limit(2 * sample).collect()], dtype=np.int64)
    if n < 2 or not len(drawn):
        return fps.select(F.col("fp").alias("x"), F.col("fp").alias("y")).limit(0)
    parts, thresholds = plan(drawn.view(np.uint64), n, distance)
    index, probe = [], []
    for i, (bits, t) in enumerate(zip(parts, thresholds)):
        if t < 0:
            continue
        mask = F.lit(_mask(bits))
        index.append(F.struct(F.lit(i).alias("p"), F.col("fp").bitwiseAND(mask).alias("key")))
        flips = F.array(*[F.lit(_mask(c)) for k in range(t + 1) for c in combinations(bits, k)])
        probe.append(_probes(i, mask, flips))
    have = fps.select(F.col("fp").alias("x"), F.explode(F.array(*index)).alias("at")).select("x", "at.p", "at.key")
    want = fps.select(F.col("fp").alias("y"), F.explode(F.concat(*probe)).alias("at")).select("y", "at.p", "at.key")
    near = F.bit_count(F.col("x").bitwiseXOR(F.col("y"))) <= distance
    # each fingerprint both is indexed and probes: a pair is met from both sides, one is enough
    return have.join(want, (have.p == want.p) & (have.key == want.key) & (have.x < want.y) & near).select("x", "y")


def _components(rows: DataFrame, distance: int, scratch: Scratch) -> DataFrame:
    """(fp, component): the smallest fingerprint reachable from each fingerprint of ``rows``."""
    nodes = scratch.save(rows.select("fp").distinct())
    joined = connected_components(links(nodes, distance).select(F.col("x").alias("a"), F.col("y").alias("b")), scratch)
    return scratch.save(nodes.join(joined, nodes.fp == joined.node, "left").select("fp", F.coalesce("component", "fp").alias("component")))


def near_duplicates(docs: DataFrame, shingle_words: int = SHINGLE_WORDS, distance: int = DISTANCE) -> DataFrame:
    """(doc_id, fp, component_id) of every row of ``docs`` (doc_id, text): component_id is the smallest
    doc_id reachable over linked texts.  A doc_id that repeats has a row for each of its rows, with the
    component of that row's text; rows without a doc_id have none."""
    scratch = Scratch(docs.sparkSession, "simhash")
    rows = scratch.save(fingerprints(docs, shingle_words))
    first = scratch.save(rows.filter("doc_id IS NOT NULL").groupBy("fp").agg(F.min("doc_id").alias("first")))
    named = _components(first, distance, scratch)
    smallest = scratch.save(named.join(first, "fp").groupBy("component").agg(F.min("first").alias("component_id")))
    named = scratch.save(named.join(smallest, "component").select("fp", "component_id"))
    return rows.join(named, "fp", "left").select(
        "doc_id", "fp", F.when(F.col("doc_id").isNotNull(), F.col("component_id")).alias("component_id"))


def keep_one(docs: DataFrame, shingle_words: int = SHINGLE_WORDS, distance: int = DISTANCE) -> DataFrame:
    """``docs`` without near-duplicates: of each component of linked texts the row with the smallest
    doc_id stays; rows without a doc_id stay.  If that doc_id repeats, the row with the component's
    smallest fingerprint of it stays, of several the one with the smallest hash of its text and then of the
    whole row; so a doc_id with texts that are not linked keeps one row for each.  Null text is empty.
    Extra columns pass through, whatever their names."""
    scratch = Scratch(docs.sparkSession, "simhash-kept")
    rows = scratch.save(fingerprints(docs, shingle_words).filter("doc_id IS NOT NULL"))
    one = rows.groupBy("fp").agg(F.min("doc_id").alias("id"))
    named = _components(rows, distance, scratch)
    best = scratch.save(one).join(named, "fp").groupBy("component").agg(F.min(F.struct("id", "fp")).alias("c"))
    again = rows.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select(F.col("doc_id").alias("id"), F.lit(True).alias("again"))
    kept = scratch.save(best.select("c.id", "c.fp").join(again, "id", "left").fillna(False, ["again"]))
    # rows stream past a hash table of the ids: texts are shuffled once and not sorted
    single, repeated = kept.filter("NOT again").hint("shuffle_hash"), kept.filter("again")
    out = docs.join(single, docs["doc_id"] == single["id"], "left_semi").unionByName(docs.filter(docs["doc_id"].isNull()))
    if repeated.take(1):  # of doc_ids that repeat, the text decides which row it is
        name = "_sim"
        while name in docs.columns:
            name += "_"
        ids = repeated.select("id").distinct()
        found = _with_fingerprint(docs.join(ids, docs["doc_id"] == ids["id"], "left_semi"), name, shingle_words, docs.columns)
        found = found.join(repeated, (found["doc_id"] == repeated["id"]) & (found[name] == repeated["fp"]), "left_semi")
        row = F.struct(*docs.columns)
        order = F.struct(F.xxhash64(F.coalesce("text", F.lit(""))), F.xxhash64(F.to_json(row)))
        out = out.unionByName(found.groupBy("doc_id", name).agg(F.min_by(row, order).alias(f"{name}_row")).select(f"{name}_row.*"))
    return out
