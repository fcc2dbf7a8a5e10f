"""Substring de-duplication by relative Lempel-Ziv parsing.

Documents are parsed against a reference that is the corpus itself, indexed in
blocks.  A block is a run of consecutive 50-word windows that share their
minimizer (the 20-word seed of least hash inside each window), so any two equal
windows lie in blocks with the same seed: looking up a document's seeds finds
every reference block that can hold one of its windows.

1. One pass cuts documents into blocks: seed, content hash, place.
2. Blocks whose seed occurs in one document only drop out: nothing there repeats.
3. Equal blocks collapse to the first document that has them; later ones are
   copied whole from it.
4. Different blocks with the same seed are compared window by window (each
   distinct block once), which finds where a copy begins or ends inside one.
5. Each document is factored greedily: the pieces found are joined along
   (reference document, offset) into maximal factors, the parse always
   takes the factor that reaches furthest.  A window across the border of two
   factors is never assumed; it counts only if its own lookup found it.

Words of a factor (at least 50) whose reference has a smaller doc_id are
duplicate spans.  Hot passages: equal blocks are aggregated before they meet, the
joins' sides are plain tables in the shared folder so that adaptive execution
splits a hot seed; no group is collected but a document's own pieces.  Text is
read three times and only documents with pieces are shuffled with theirs: a
fixed-size bitmap of hashed ids goes ahead of the exact join.

Blocks are compared by seed and content, 128 bits together.  Defined results:
null text has no words; texts under 50 words lose nothing; rows with a null
doc_id lose nothing and are no reference; rows that repeat a doc_id are not
each other's reference; an empty table gives no rows; extra columns are
not read; very long texts are parsed whole.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from webloom.llm.common import Runs, Scratch, in_pieces, utf8, with_columns, word_hashes

WINDOW = 50
SEED = 20
_BITS = 24
_SEED_ODD, _RUN_ODD = 0xB5AD4ECEDA1CE2A9, 0xC2B2AE3D27D4EB4F


def cut_blocks(words: np.ndarray, window: int = WINDOW, seed: int = SEED):
    """(seed hash, content hash, first window, windows) of each block."""
    n = len(words) - window + 1
    if n <= 0:
        return (np.zeros(0, np.uint64),) * 2 + (np.zeros(0, np.int64),) * 2
    grams = len(words) - seed + 1
    at = np.arange(grams)
    g = Runs(words, _SEED_ODD)(at, at + seed)
    wide = window - seed + 1
    least = np.empty(n, dtype=np.int64)
    for i in range(0, n, 1 << 18):
        part = np.lib.stride_tricks.sliding_window_view(g[i:min(n, i + (1 << 18)) + wide - 1], wide)
        least[i:i + len(part)] = part.argmin(axis=1) + np.arange(i, i + len(part))
    starts = np.flatnonzero(np.diff(least, prepend=-1))
    counts = np.diff(starts, append=n)
    return g[least[starts]], Runs(words, _RUN_ODD)(starts, starts + counts + window - 1), starts, counts


def factors(pos, n, ref, ref_pos, window: int = WINDOW) -> list[tuple[int, int, int, int]]:
    """Greedy parse: (start, length, reference, start there) of disjoint duplicate spans, in order.

    Each piece says that windows pos .. pos + n - 1 occur in ``ref`` from ref_pos on."""
    order = np.lexsort((pos, ref_pos - pos, ref))
    whole: list[list[int]] = []
    for p, k, r, q in zip(pos[order].tolist(), n[order].tolist(), ref[order].tolist(), ref_pos[order].tolist()):
        if whole and whole[-1][2] == r and whole[-1][3] == q - p and p <= whole[-1][1]:
            whole[-1][1] = max(whole[-1][1], p + k)
        else:
            whole.append([p, p + k, r, q - p])  # windows [p, p + k) along one diagonal
    whole.sort()
    out, done, i = [], 0, 0
    while i < len(whole):
        best = None  # reaches furthest among those that start at or before the end so far
        at = max(done, whole[i][0])
        while i < len(whole) and whole[i][0] <= at:
            if best is None or whole[i][1] > best[1]:
                best = whole[i]
            i += 1
        end = best[1] + window - 1
        if end > done:
            start = max(done, best[0])
            out.append((start, end - start, best[2], start + best[3]))
            done = end
    return out


_SPAN = pa.list_(pa.struct([("start", pa.int32()), ("length", pa.int32()), ("ref", pa.int64()), ("ref_start", pa.int32())]))
_SPAN_SQL = "array<struct<start:int,length:int,ref:long,ref_start:int>>"


def _text_hash(text: bytes) -> int:
    return xxhash.xxh32_intdigest(text) - (1 << 31)


def _digest(words: list[bytes]) -> str:
    return hashlib.sha256(b" ".join(words)).hexdigest()


def _survey(window: int, seed: int):
    def run(batches):
        for b in in_pieces(batches):
            at, cols = [], [[] for _ in range(6)]
            for k, text in enumerate(utf8(b.column("text"))):
                words = word_hashes(text)
                a, c, s, n = cut_blocks(words, window, seed)
                at.append(np.full(len(a) + 1, k))
                own = _text_hash(text)
                for col, first, rest in zip(cols, (own, 0, 0, len(words), 0), (np.full(len(a), own), a.view(np.int64), c.view(np.int64), s, n)):
                    col.append(np.concatenate([np.array([first], dtype=np.int64), rest]))
                cols[5] += [_digest(text.split()), *[None] * len(a)]
            if not at:
                continue
            kinds = (pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.int32())
            arrays = [pa.array(np.concatenate(x)).cast(t) for x, t in zip(cols, kinds)]
            yield pa.RecordBatch.from_arrays([b.column("doc_id").take(pa.array(np.concatenate(at))), *arrays, pa.array(cols[5], pa.string())],
                                             ["doc_id", "t", "a", "c", "s", "n", "sha"])
    return run


def _some(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """(doc_id, t, text) of the documents whose doc_id may be in ``ids``: a bitmap
    of 2^24 hashed ids (bounded) lets all that are through, and few others."""
    place = F.pmod(F.xxhash64(F.col("doc_id").cast("long")), F.lit(1 << _BITS))
    bit = F.expr("shiftleft(1L, cast(_place % 64 as int))")
    rows = (ids.select("doc_id").distinct().select(place.alias("_place"))
            .groupBy(F.expr("_place div 64").alias("w")).agg(F.bit_or(bit).alias("bits")).toArrow())
    table = np.zeros(1 << (_BITS - 6), dtype=np.int64)
    table[rows.column("w").to_numpy()] = rows.column("bits").to_numpy()
    shared = docs.sparkSession.sparkContext.broadcast(table)

    def run(batches):
        bits = np.unpackbits(shared.value.view(np.uint8), bitorder="little").astype(bool)
        for b in in_pieces(batches):
            b = b.filter(pa.array(bits[b.column("_place").to_numpy()]))
            own = pa.array([_text_hash(t) for t in utf8(b.column("text"))], pa.int32())
            yield with_columns(b, ["doc_id", "text"], t=own)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", place.alias("_place")).filter("doc_id IS NOT NULL")
    return rows.mapInArrow(run, "doc_id long, text string, t int")


def _windows(window: int):
    def run(batches):
        for b in in_pieces(batches):
            out = []
            for text, doc, todo in zip(utf8(b.column("text")), b.column("doc_id").to_pylist(), b.column("todo").to_pylist()):
                words = word_hashes(text)
                runs = Runs(words, _RUN_ODD)
                n = np.array([x["n"] for x in todo])
                k = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                at = np.repeat([x["s"] for x in todo], n) + k
                out.append((np.repeat([x["a"] for x in todo], n), np.repeat([x["c"] for x in todo], n), k,
                            runs(at, at + window).view(np.int64), np.full(len(k), doc), at))
            if out:
                kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int32())
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)).cast(t) for x, t in zip(zip(*out), kinds)],
                                                 ["a", "c", "k", "h", "doc_id", "at"])
    return run


def _parse(window: int):
    def run(batches):
        for b in in_pieces(batches):
            counts, removed, shas, spans = [], [], [], []
            for text, pieces in zip(utf8(b.column("text")), b.column("pieces").to_pylist()):
                words = text.split()
                found = factors(*(np.array([p[f] for p in pieces], dtype=np.int64) for f in ("p", "n", "ref", "q")), window)
                kept, done = [], 0
                for start, length, *_ in found:
                    kept += words[done:start]
                    done = start + length
                kept += words[done:]
                counts.append(len(words))
                removed.append(len(words) - len(kept))
                shas.append(_digest(kept))
                spans.append([dict(zip(("start", "length", "ref", "ref_start"), f)) for f in found])
            yield with_columns(b, ["doc_id"], n_words=pa.array(counts, pa.int64()), n_removed=pa.array(removed, pa.int64()),
                               kept_sha256=pa.array(shas, pa.string()), spans=pa.array(spans, _SPAN))
    return run


def find_repeats(docs: DataFrame, window: int = WINDOW, seed: int = SEED) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256, spans) of every row of ``docs``
    (doc_id, text); spans are (start, length, ref, ref_start) in words."""
    scratch = Scratch(docs.sparkSession, "substring")
    seen = scratch.save(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        _survey(window, seed), "doc_id long, t int, a long, c long, s int, n int, sha string"))
    blocks = seen.filter("n > 0 AND doc_id IS NOT NULL").select("a", "c", "doc_id", "t", "s", "n")
    seeds = scratch.save(blocks.groupBy("a").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high"))
                         .filter("low < high").select("a"))
    blocks = scratch.save(blocks.join(seeds, "a"))
    equal = scratch.save(blocks.groupBy("a", "c").agg(F.min(F.struct("doc_id", "t", "s", "n")).alias("first"),
                                                      F.max("doc_id").alias("last")))
    copied = (blocks.join(equal.filter("last > first.doc_id"), ["a", "c"]).filter("doc_id > first.doc_id")
              .select("doc_id", "t", F.col("s").alias("p"), "n", F.col("first.doc_id").alias("ref"), F.col("first.s").alias("q")))
    mixed = scratch.save(equal.groupBy("a").agg(F.min("first.doc_id").alias("low"), F.max("first.doc_id").alias("high"))
                         .filter("low < high").select("a"))
    todo = scratch.save(equal.join(mixed, "a").groupBy("first.doc_id", "first.t")
                        .agg(F.collect_list(F.struct("a", "c", "first.s", "first.n")).alias("todo")))
    windows = scratch.save(_some(docs, todo).join(todo, ["doc_id", "t"]).select("doc_id", "text", "todo")
                           .mapInArrow(_windows(window), "a long, c long, k int, h long, doc_id long, at int"))
    first = scratch.save(windows.groupBy("a", "h").agg(F.min(F.struct("doc_id", "at")).alias("src"), F.max("doc_id").alias("last"))
                         .filter("last > src.doc_id").select("a", "h", "src"))
    part = scratch.save(windows.join(first, ["a", "h"]).filter("doc_id > src.doc_id")
                        .select("a", "c", "k", "doc_id", "src").distinct())
    partly = blocks.join(part, ["a", "c", "doc_id"]).select(
        "doc_id", "t", (F.col("s") + F.col("k")).alias("p"), F.lit(1).alias("n"),
        F.col("src.doc_id").alias("ref"), F.col("src.at").alias("q"))
    pieces = scratch.save(copied.unionByName(partly).groupBy("doc_id", "t")
                          .agg(F.collect_list(F.struct("p", "n", "ref", "q")).alias("pieces")))
    parsed = _some(docs, pieces).join(pieces, ["doc_id", "t"]).select("doc_id", "text", "pieces").mapInArrow(
        _parse(window), f"doc_id long, n_words long, n_removed long, kept_sha256 string, spans {_SPAN_SQL}")
    whole = seen.filter("n = 0").join(pieces.select("doc_id", "t"), ["doc_id", "t"], "left_anti").select(
        "doc_id", F.col("s").cast("long").alias("n_words"), F.lit(0).cast("long").alias("n_removed"),
        F.col("sha").alias("kept_sha256"), F.expr(f"cast(array() as {_SPAN_SQL})").alias("spans"))
    return parsed.unionByName(whole)
