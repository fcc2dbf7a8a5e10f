"""A keyed table that takes puts and deletes at the cost of what they change.

Layout of the folder::

    data/<batch>/_bucket=<b>/*.parquet    rows of a batch, by the hash of their key
    versions/<n>.json                     what version n of the table consists of

A batch is written as a delta for the buckets it touches, then a version file that lists it is put in
place by one rename; the file with the greatest number is the table.  So a job that dies
before the rename changes nothing (its folder belongs to no version and ``vacuum`` removes it),
and of two writers that raced for a number one fails.  No bucket is rewritten by a put or a delete.

Reading merges a bucket's rows by key: per batch there is one row of a key, so the rows of a key are
as many as the deltas.  A delete hides all rows of earlier batches; of the others the one with the
greatest ``version`` columns, then of the latest batch, is the table's.  Buckets without deltas are read
as they are.  ``compact`` rewrites the buckets that have gathered deltas, and no other.

The version file holds one line per bucket and delta; it and the listing of ``versions`` are all that
the driver reads.  A key that holds a third of a batch is reduced before it moves.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, LongType, StructField, StructType

from webloom.operators.versions import VersionFiles

BUCKETS = 64
MAX_DELTAS = 4


class KeyedTable:
    """The table in ``path``; ``create`` or ``open`` one."""

    def __init__(self, spark: SparkSession, path: str, spec: dict):
        self.spark, self.path = spark, path.rstrip("/")
        self.files = VersionFiles(spark, path)
        self.schema = StructType.fromJson(spec["schema"])
        self.key, self.version, self.buckets = spec["key"], spec["version"], spec["buckets"]
        self.stored = StructType([*self.schema, StructField("_seq", LongType()), StructField("_deleted", BooleanType())])

    # ------------------------------------------------------------ versions
    @classmethod
    def create(cls, spark: SparkSession, path: str, schema: StructType | str, key: list[str], version: list[str] = (),
               buckets: int = BUCKETS) -> KeyedTable:
        """A new empty table, or an empty version of the one that is there with the same layout."""
        schema = schema if isinstance(schema, StructType) else StructType.fromDDL(schema)
        table = cls(spark, path, {"schema": json.loads(schema.json()), "key": list(key), "version": list(version), "buckets": buckets})
        table._commit(table._last() + 1, {})
        return table

    @classmethod
    def open(cls, spark: SparkSession, path: str) -> KeyedTable:
        probe = cls(spark, path, {"schema": StructType([]).jsonValue(), "key": [], "version": [], "buckets": 1})
        return cls(spark, path, probe._state()["spec"])

    def _last(self) -> int:
        return self.files.last()

    def _state(self, number: int | None = None) -> dict:
        return self.files.read(number)

    def _commit(self, number: int, buckets: dict[str, dict]) -> None:
        spec = {"schema": json.loads(self.schema.json()), "key": self.key, "version": self.version, "buckets": self.buckets}
        self.files.commit(number, {"version": number, "spec": spec, "buckets": buckets})

    # -------------------------------------------------------------- writing
    def _bucket(self) -> F.Column:
        return F.pmod(F.xxhash64(*self.key), F.lit(self.buckets)).cast("int")

    def _write(self, rows: DataFrame) -> dict[str, str]:
        """Stores rows that have all stored columns; bucket -> folder."""
        folder = f"{self.path}/data/{uuid.uuid4().hex}"
        (rows.select(*self.stored.names, self._bucket().alias("_bucket")).repartition("_bucket")
         .write.partitionBy("_bucket").parquet(folder))
        fs, at = self.files.fs(folder)
        names = [s.getPath().getName() for s in fs.listStatus(at)]
        return {n.split("=")[1]: f"{folder}/{n}" for n in names if n.startswith("_bucket=")}

    def _add(self, rows: DataFrame, number: int) -> None:
        state = self._state(number - 1)["buckets"]
        for bucket, folder in self._write(rows).items():
            state.setdefault(bucket, {"base": None, "deltas": []})["deltas"].append(folder)
        self._commit(number, state)

    def put(self, rows: DataFrame) -> None:
        """Puts rows; of a batch's rows of one key the one with the greatest ``version`` counts (ties: the
        greatest row).  Missing columns are null."""
        number = self._last() + 1
        others = [c for c in self.schema.names if c not in self.key]
        given = rows.select(*(F.col(f.name).cast(f.dataType) if f.name in rows.columns else F.lit(None).cast(f.dataType).alias(f.name)
                              for f in self.schema))
        order = F.struct(*self.version, F.xxhash64(F.to_json(F.struct(*self.schema.names))))
        one = given.groupBy(*self.key).agg(F.max_by(F.struct(*others), order).alias("_row")).select(*self.key, "_row.*")
        self._add(one.withColumns({"_seq": F.lit(number).cast("long"), "_deleted": F.lit(False)}), number)

    def delete(self, keys: DataFrame) -> None:
        """Deletes the rows of some keys; they may be put again later."""
        number = self._last() + 1
        gone = keys.select(*self.key).distinct()
        self._add(gone.select(*(F.col(f.name).cast(f.dataType) if f.name in self.key else F.lit(None).cast(f.dataType).alias(f.name) for f in self.schema),
                              F.lit(number).cast("long").alias("_seq"), F.lit(True).alias("_deleted")), number)

    # -------------------------------------------------------------- reading
    def _files(self, folders: list[str]) -> DataFrame:
        if not folders:
            return self.spark.createDataFrame([], self.stored)
        return self.spark.read.schema(self.stored).parquet(*folders)

    def _merged(self, rows: DataFrame) -> DataFrame:
        """One row of each key that is not deleted, with the stored columns."""
        others = [n for n in self.stored.names if n not in self.key]
        order = [F.struct(*self.version, "_seq").alias("o")] if self.version else [F.struct("_seq").alias("o")]
        per = rows.groupBy(*self.key).agg(F.collect_list(F.struct(*order, F.struct(*others).alias("r"))).alias("rows"))
        gone = F.coalesce(F.array_max(F.transform(F.filter("rows", lambda x: x["r"]["_deleted"]), lambda x: x["r"]["_seq"])), F.lit(0))
        live = F.filter("rows", lambda x: ~x["r"]["_deleted"] & (x["r"]["_seq"] > F.col("gone")))
        best = F.reduce(F.col("live"), F.try_element_at("live", F.lit(1)), lambda a, x: F.when(x["o"] > a["o"], x).otherwise(a))
        return (per.withColumn("gone", gone).withColumn("live", live).filter(F.size("live") > 0)
                .withColumn("best", best["r"]).select(*self.key, "best.*").select(*self.stored.names))

    def _rows(self, state: dict[str, dict]) -> DataFrame:
        plain = [b["base"] for b in state.values() if b["base"] and not b["deltas"]]
        mixed = [f for b in state.values() if b["deltas"] for f in [b["base"], *b["deltas"]] if f]
        return self._files(plain).unionByName(self._merged(self._files(mixed)))

    def read(self) -> DataFrame:
        """The table as it is now; later puts do not change the frame."""
        return self._rows(self._state()["buckets"]).select(*self.schema.names)

    def get(self, *key) -> DataFrame:
        """The row of one key; reads one bucket."""
        one = self.spark.createDataFrame([key], StructType([self.schema[k] for k in self.key]))
        bucket = str(one.select(self._bucket()).first()[0])
        state = self._state()["buckets"]
        same = [F.col(k).eqNullSafe(F.lit(v)) for k, v in zip(self.key, key)]
        rows = self._rows({b: s for b, s in state.items() if b == bucket}).select(*self.schema.names)
        for s in same:
            rows = rows.filter(s)
        return rows

    # ---------------------------------------------------------- maintenance
    def compact(self, max_deltas: int = MAX_DELTAS) -> list[int]:
        """Rewrites the buckets with at least ``max_deltas`` deltas; returns their numbers."""
        number = self._last() + 1
        state = self._state(number - 1)["buckets"]
        full = {b: s for b, s in state.items() if len(s["deltas"]) >= max_deltas}
        if full:
            folders = self._write(self._rows(full))
            for b in full:  # a bucket whose rows are all deleted has no folder
                state[b] = {"base": folders.get(b), "deltas": []}
            self._commit(number, state)
        return sorted(int(b) for b in full)

    def vacuum(self) -> int:
        """Deletes batches and versions that the last version does not need; returns how many batches.  Not
        to be run while another job writes or reads an older version."""
        return self.files.vacuum({f.rsplit("/", 2)[1] for b in self._state()["buckets"].values() for f in [b["base"], *b["deltas"]] if f})
