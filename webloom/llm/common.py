"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from webloom.session import Scratch as _Scratch
from webloom.session import ensure_checkpoint_dir, ship_package

#: Java pattern of a word: everything between ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def prepare(spark: SparkSession) -> None:
    """Shared folder and package shipping, needed once per application."""
    ensure_checkpoint_dir(spark)
    ship_package(spark)


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Lazy scan of one input table."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def n_words(text) -> F.Column:
    """Number of words; null text has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def ascii_lower(col) -> F.Column:
    """Lower-cases A-Z and nothing else."""
    return F.translate(col, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def hash60(text) -> F.Column:
    """60 bits of the MD5 of a string, as a long that is never negative; null is the empty string."""
    digest = F.md5(F.coalesce(text, F.lit("")).cast("binary"))
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("long")


class Scratch(_Scratch):
    """Scratch tables of an operator; makes the session ready for it."""

    def __init__(self, spark: SparkSession, name: str):
        prepare(spark)
        super().__init__(spark, name)


def cut_points(*columns: np.ndarray) -> np.ndarray:
    """Starts of the runs of equal keys, and the length at the end."""
    n = len(columns[0])
    new = np.zeros(n, dtype=bool)
    for c in columns:
        new[1:] |= c[1:] != c[:-1]
    if n:
        new[0] = True
    return np.append(np.flatnonzero(new), n)


_POWERS = np.ones(1, dtype=np.uint64)
#: Bytes of a text that are hashed at a time.
_PIECE = 1 << 20
_ODD = np.uint64(0x9E3779B97F4A7C15)


def _powers(n: int) -> np.ndarray:
    global _POWERS
    if len(_POWERS) < n:
        p = np.full(max(n, 2 * len(_POWERS), 256), _ODD, dtype=np.uint64)
        p[0] = 1
        _POWERS = np.multiply.accumulate(p)
    return _POWERS


def mix64(h: np.ndarray) -> np.ndarray:
    """SplitMix64's finaliser on an array of uint64."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


#: Rows of a batch that are worked on at a time; results are handed on piece by piece.
PIECE_ROWS = 1024


def in_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Short slices of the batches, so that a task holds little besides them."""
    for b in batches:
        for i in range(0, b.num_rows, PIECE_ROWS):
            yield b.slice(i, PIECE_ROWS)


def utf8(texts: pa.Array) -> Iterator[bytes]:
    """The texts as UTF-8, one at a time; null is empty."""
    for x in texts.cast(pa.binary()):
        yield x.as_py() or b""


def with_columns(batch: pa.RecordBatch, keep: list[str], **columns: pa.Array) -> pa.RecordBatch:
    """Some columns of a batch, untouched, and new ones."""
    return pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), *columns.values()], [*keep, *columns])


def word_bounds(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes as an array, and the starts and ends of the words in it."""
    b = np.frombuffer(data, dtype=np.uint8)
    inside = np.empty(len(b) + 2, dtype=np.int8)
    inside[0] = inside[-1] = 0
    inside[1:-1] = (b != 32) & ((b < 9) | (b > 13))
    edge = np.diff(inside)
    return b, np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def word_hashes(data: bytes) -> np.ndarray:
    """A 64-bit hash of each word of a UTF-8 text, in order."""
    b, starts, ends = word_bounds(data)
    if not len(starts):
        return np.zeros(0, dtype=np.uint64)
    if len(b) > _PIECE:  # bounded work space for very long texts
        cuts = np.searchsorted(ends, np.arange(0, int(ends[-1]) + _PIECE, _PIECE), "right")
        return np.concatenate([_hash_words(b, starts[i:j], ends[i:j]) for i, j in zip(cuts[:-1], cuts[1:]) if j > i])
    return _hash_words(b, starts, ends)


def _hash_words(b: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    lens = ends - starts
    first = np.cumsum(lens) - lens
    at = np.arange(int(lens.sum())) - np.repeat(first, lens)
    letters = b[at + np.repeat(starts, lens)].astype(np.uint64) + np.uint64(1)
    sums = np.add.reduceat(letters * _powers(int(lens.max()))[at], first)
    return mix64(sums ^ (lens.astype(np.uint64) << np.uint64(56)))


class Runs:
    """Hashes of any runs of a word sequence, from prefix sums: a run's hash is
    the sum of word x odd^offset, so equal runs hash alike wherever they are."""

    _tables: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def __init__(self, words: np.ndarray, odd: int):
        odd |= 1
        power, inverse = self._tables.get(odd, (np.zeros(0, np.uint64),) * 2)
        if len(power) < len(words) + 1:
            n = max(len(words) + 1, 2 * len(power), 4096)
            tables = []
            for base in (odd, pow(odd, -1, 1 << 64)):
                p = np.full(n, base, dtype=np.uint64)
                p[0] = 1
                tables.append(np.multiply.accumulate(p))
            power, inverse = self._tables[odd] = tuple(tables)
        self.inverse = inverse
        self.sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(words * power[:len(words)], dtype=np.uint64)])

    def __call__(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mix64((self.sums[ends] - self.sums[starts]) * self.inverse[starts] + (ends - starts).astype(np.uint64))
