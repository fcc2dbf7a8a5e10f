"""Session helpers: one place for the configuration every job relies on.

The library never creates a session behind the caller's back inside an
operator; ``get_session`` is for scripts, tests and the bench.  Operators only
read settings from the active session (checkpoint dir, shuffle partitions).
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings the library depends on.  ANSI mode makes a bad numeric line fail the
# job the way the reference's parser does; UTC keeps timestamps comparable.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.speculation": "false",
    # Checkpoint files go when nothing refers to them any more.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def get_session(master: str | None = None, app: str = "webloom",
                shuffle_partitions: int | None = None,
                extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the library's base settings."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = dict(BASE_CONF)
    if master and master.startswith("local"):
        # Local mode runs everything in the driver JVM; 1g is too small.
        conf["spark.driver.memory"] = "8g"
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster this setting must point at shared storage; it is an error if
    it is unset there, since a folder of one machine is not seen by the others.
    In local mode a fresh scratch folder is created and set.
    """
    sc = spark.sparkContext
    cur = sc.getCheckpointDir()
    if cur:
        return cur
    conf_dir = sc.getConf().get("spark.checkpoint.dir", None)
    if not conf_dir:
        require_local(sc.master)
        conf_dir = tempfile.mkdtemp(prefix="webloom-ckpt-", dir=os.environ.get("WEBLOOM_SCRATCH", "/tmp"))
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir() or conf_dir


def require_local(master: str) -> None:
    if not re.fullmatch(r"local(\[.*\])?", master):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")


def ship_package(spark: SparkSession) -> None:
    """Make ``webloom`` importable in Python workers (``mapInPandas`` steps
    refer to its functions by module): zip the package once per
    SparkContext and ``addPyFile`` it -- what ``--py-files`` does for a
    submitted job.  The zip is code shipped through Spark's file server, so
    a driver-local build folder is fine."""
    sc = spark.sparkContext
    if getattr(sc, "_webloom_shipped", False):
        return
    import zipfile
    pkg = os.path.dirname(os.path.abspath(__file__))
    root = os.path.dirname(pkg)
    out = os.path.join(tempfile.mkdtemp(prefix="webloom-pyfiles-"), "webloom.zip")
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as zf:
        for d, _, names in os.walk(pkg):
            if "__pycache__" in d:
                continue
            for n in names:
                if n.endswith(".py"):
                    full = os.path.join(d, n)
                    zf.write(full, os.path.relpath(full, root))
    sc.addPyFile(out)
    sc._webloom_shipped = True


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path for materialised intermediate tables inside the shared checkpoint folder."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/tables/{name}"


def delete_path(spark: SparkSession, path: str) -> None:
    """Delete a scratch table through Hadoop's file system API."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def path_exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


class Scratch:
    """Intermediate tables in the shared folder: they cut lineage, survive the
    loss of executors, and as plain tables let adaptive execution split a hot
    key of either side of a join.  ``drop`` deletes what a later table replaces."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.base, self.n = spark, scratch_path(spark, f"{name}-{uuid.uuid4().hex}"), 0
        self.paths: dict[int, str] = {}
        self.tables: dict[int, str] = {}

    def save(self, df: DataFrame, partition_by: str | None = None) -> DataFrame:
        self.n += 1
        path = f"{self.base}/{self.n}"
        w = df.write.partitionBy(partition_by) if partition_by else df.write
        w.parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        self.paths[id(out)] = path
        return out

    def save_bucketed(self, df: DataFrame, buckets: int, *keys: str) -> DataFrame:
        """A table whose files are dealt by the hash of ``keys``: a join on them does not move it.
        It is entered in the catalog under a name of its own until it is dropped."""
        self.n += 1
        path, name = f"{self.base}/{self.n}", f"webloom_{uuid.uuid4().hex}"
        (df.repartition(buckets, *keys).write.bucketBy(buckets, *keys).format("parquet").option("path", path).saveAsTable(name))
        out = self.spark.table(name)
        self.paths[id(out)], self.tables[id(out)] = path, name
        return out

    def drop(self, *tables: DataFrame) -> None:
        for t in tables:
            if id(t) in self.tables:
                self.spark.sql(f"DROP TABLE IF EXISTS {self.tables.pop(id(t))}")
            if id(t) in self.paths:
                delete_path(self.spark, self.paths.pop(id(t)))


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint to the shared folder (survives executor loss).

    The frame is persisted first: writing a checkpoint runs a second job over
    the same partitions, which would otherwise recompute them.  The cached
    copy is released once the checkpoint files are written.
    """
    ensure_checkpoint_dir(df.sparkSession)
    df = df.persist()
    out = df.checkpoint(eager=True)
    df.unpersist()
    return out


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
