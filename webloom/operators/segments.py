"""An inverted index in immutable segments that takes batches of pages.

A batch becomes a segment: its postings sorted by (term, doc_id), and the list of its pages.
Pages that earlier segments hold as well are entered in the *delete lists* of those, so the
latest version of a page is the only one seen, and no stored posting is read or rewritten by a
batch.  Readers scan the segments; only one with a delete list checks its postings against that
list (a join with ids, not with versions), so a keyword filter is pushed to every scan.

Segments are merged in tiers: of every ``fanout`` segments of about one size one is made, so n pages lie in
at most (fanout - 1) segments a tier, in log(n) tiers, and a posting is rewritten once a tier.  A
segment of which half is deleted is rewritten at once, and one that is all deleted goes.

Layout::

    data/<folder>/{docs,postings,deleted}    a batch or a merge; folders are never changed
    versions/<n>.json                        the segments and delete lists of version n

A version is swapped by a rename (see ``versions``): a job that dies before changes nothing.  The version names
the last batch of each stream, so a batch that is replayed is not added twice.

Results: a null text has no postings but replaces the page's earlier text; pages without an id are
left out; an id that repeats in a batch counts by its greatest text; columns but the two named are not stored.
"""

from __future__ import annotations

import uuid
from collections import defaultdict
from math import log

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from webloom.operators.index import term_freqs
from webloom.operators.versions import VersionFiles

FANOUT = 8
#: Segments up to ``fanout`` times as many pages are of the lowest tier.
SMALL = 1000
#: Delete lists up to as many ids are sent to all tasks.
BROADCAST_IDS = 1_000_000

DOCS = "doc_id string, _seg int"
POSTINGS = "term string, doc_id string, tf int, _seg int"


class SegmentIndex:
    """The index in ``path``; ``create`` or ``open`` one."""

    def __init__(self, spark: SparkSession, path: str, fanout: int = FANOUT):
        self.spark, self.path, self.fanout = spark, path.rstrip("/"), fanout
        self.files = VersionFiles(spark, path)

    # ------------------------------------------------------------ versions
    @classmethod
    def create(cls, spark: SparkSession, path: str, fanout: int = FANOUT) -> SegmentIndex:
        """A new index, or an empty version of the one that is there."""
        index = cls(spark, path, fanout)
        index.files.commit(index.files.last() + 1, {"fanout": fanout, "segments": [], "batches": {}})
        return index

    @classmethod
    def open(cls, spark: SparkSession, path: str) -> SegmentIndex:
        return cls(spark, path, cls(spark, path).files.read()["fanout"])

    @classmethod
    def open_or_create(cls, spark: SparkSession, path: str, fanout: int = FANOUT) -> SegmentIndex:
        return cls.open(spark, path) if VersionFiles(spark, path).last() else cls.create(spark, path, fanout)

    def segments(self) -> list[dict]:
        """The segments: number, folder, pages, deleted pages, folders of delete lists."""
        return self.files.read()["segments"]

    # -------------------------------------------------------------- writing
    def _write(self, number: int, docs: DataFrame, postings: DataFrame, stored: bool = False) -> dict:
        """Stores a segment; its entry in the version.  ``stored``: the postings come from stored segments."""
        name = f"{number}-{uuid.uuid4().hex}"
        folder = f"{self.path}/data/{name}"
        seg = F.lit(number).alias("_seg")
        docs.select("doc_id", seg).write.parquet(f"{folder}/docs")
        # Range partitioning samples its input first: stored, a text is tokenized once.
        rows = postings.select("term", "doc_id", "tf", seg)
        if not stored:
            rows.write.parquet(f"{folder}/unsorted")
            rows = self.spark.read.schema(POSTINGS).parquet(f"{folder}/unsorted")
        (rows.repartitionByRange("term", "doc_id").sortWithinPartitions("term", "doc_id")
         .write.option("parquet.block.size", 8 << 20).parquet(f"{folder}/postings"))
        if not stored:
            fs, raw = self.files.fs(f"{folder}/unsorted")
            fs.delete(raw, True)
        return {"number": number, "folder": name, "docs": self._read("docs", [name], DOCS).count(), "deleted": 0, "lists": []}

    def _delete(self, number: int, state: dict, ids: DataFrame) -> None:
        """Enters ids in the delete lists of the segments that hold them alive."""
        old = state["segments"]
        if not old:
            return
        name = f"{number}-deleted-{uuid.uuid4().hex}"
        folder = f"{self.path}/data/{name}/deleted"
        gone = self._docs(old).join(ids.select("doc_id"), "doc_id", "left_semi")
        gone.withColumn("_part", F.col("_seg")).write.partitionBy("_part").parquet(folder)
        rows = self.spark.read.schema(f"{DOCS}, _part int").parquet(folder)
        counts = dict(rows.groupBy("_part").count().collect())  # a row per segment
        for s in old:
            if counts.get(s["number"]):
                s["deleted"] += counts[s["number"]]
                s["lists"].append(f"{name}/deleted/_part={s['number']}")

    def add(self, pages: DataFrame, id_col: str = "doc_id", text_col: str = "text", stream: str | None = None,
            batch: int | None = None, merge: bool = True) -> bool:
        """Adds a batch of pages, or puts new versions of them; with the name of a ``stream`` and the number of
        its ``batch``, no batch is added again (then False)."""
        number, state = self._next()
        if stream is not None and state["batches"].get(stream, -1) >= batch:
            return False
        texts = (pages.select(F.col(id_col).cast("string").alias("doc_id"), F.col(text_col).alias("text")).filter("doc_id IS NOT NULL")
                 .groupBy("doc_id").agg(F.max("text").alias("text")))
        new = self._write(number, texts, term_freqs(texts))
        self._delete(number, state, self._read("docs", [new["folder"]], DOCS))
        state["segments"].append(new)
        if stream is not None:
            state["batches"][stream] = batch
        self.files.commit(number, state)
        if merge:
            self.merge()
        return True

    def delete(self, ids: DataFrame, id_col: str = "doc_id") -> None:
        """Deletes pages; they may be added again later."""
        number, state = self._next()
        self._delete(number, state, ids.select(F.col(id_col).cast("string").alias("doc_id")))
        self.files.commit(number, state)
        self.merge()

    def _next(self) -> tuple[int, dict]:
        last = self.files.last()
        return last + 1, self.files.read(last)

    # -------------------------------------------------------------- reading
    def _read(self, kind: str, folders: list[str], schema: str) -> DataFrame:
        if not folders:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*(f"{self.path}/data/{f}/{kind}" if kind else f"{self.path}/data/{f}" for f in folders))

    def _alive(self, kind: str, segments: list[dict], schema: str) -> DataFrame:
        """Rows of pages that no delete list of their segment names."""
        clean = self._read(kind, [s["folder"] for s in segments if not s["lists"]], schema)
        cut = [s for s in segments if s["lists"]]
        if not cut:
            return clean
        gone = self._read("", [f for s in cut for f in s["lists"]], DOCS)
        if sum(s["deleted"] for s in cut) <= BROADCAST_IDS:  # counted when they were written
            gone = F.broadcast(gone)
        rest = self._read(kind, [s["folder"] for s in cut], schema).join(gone, ["_seg", "doc_id"], "left_anti")
        return clean.unionByName(rest) if len(cut) < len(segments) else rest

    def _docs(self, segments: list[dict]) -> DataFrame:
        return self._alive("docs", segments, DOCS)

    def docs(self) -> DataFrame:
        """(doc_id) of the pages in the index."""
        return self._docs(self.segments()).select("doc_id")

    def postings(self) -> DataFrame:
        """(term, doc_id, tf) as of now; later batches do not change the frame."""
        return self._alive("postings", self.segments(), POSTINGS).select("term", "doc_id", "tf")

    # ---------------------------------------------------------- maintenance
    def _due(self, segments: list[dict]) -> list[dict]:
        """The next segments to make one of, if any."""
        tiers = defaultdict(list)
        for s in segments:
            live = s["docs"] - s["deleted"]
            if 2 * s["deleted"] >= s["docs"]:
                return [s]
            tiers[max(0, int(log(live / SMALL, self.fanout)))].append(s)
        return next((t for _, t in sorted(tiers.items()) if len(t) >= self.fanout), [])

    def merge(self) -> int:
        """Merges until no tier is full and no segment half deleted; returns the number of merges."""
        done = 0
        while due := self._due(self._next()[1]["segments"]):
            number, state = self._next()
            state["segments"] = [s for s in state["segments"] if s not in due]
            left = [s for s in due if s["docs"] > s["deleted"]]
            if left:
                state["segments"].append(self._write(number, self._docs(left), self._alive("postings", left, POSTINGS), stored=True))
            self.files.commit(number, state)
            done += 1
        return done

    def vacuum(self) -> int:
        """Deletes what the last version does not need; returns the number of folders.  See ``VersionFiles.vacuum``."""
        return self.files.vacuum({f.split("/")[0] for s in self.segments() for f in [s["folder"], *s["lists"]]})
