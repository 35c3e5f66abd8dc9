"""Session set-up, table reading and staging of intermediate results."""

from __future__ import annotations

import atexit
import os
import re
import shutil
import tempfile
import uuid
import zipfile

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_OWN: list[str] = []


def build_session(app: str = "tarnlake", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the engine relies on; what the caller or the cluster sets wins.

    UTC, Arrow transfer, adaptive execution with skew-join splitting. ``conf`` keys use underscores
    for dots (``spark_sql_shuffle_partitions="64"``).
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    base = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.serializer": "org.apache.spark.serializer.KryoSerializer",
    }
    for k, v in (base | {k.replace("_", "."): v for k, v in conf.items()}).items():
        b = b.config(k, v)
    return b.getOrCreate()


def ship(spark: SparkSession) -> None:
    """Send this package to the Python workers once per application, so that they need not have it installed."""
    sc = spark.sparkContext
    if getattr(sc, "_tarnlake_shipped", False):
        return
    root = os.path.dirname(os.path.abspath(__file__))
    folder = tempfile.mkdtemp(prefix="tarnlake-code-")  # on the driver only, which serves it
    atexit.register(shutil.rmtree, folder, True)
    path = os.path.join(folder, "tarnlake.zip")
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for base, _, names in os.walk(root):
            for n in names:
                if n.endswith(".py"):
                    full = os.path.join(base, n)
                    z.write(full, os.path.relpath(full, os.path.dirname(root)))
    sc.addPyFile(path)
    sc._tarnlake_shipped = True


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the lake's Parquet tables under ``sf_dir``."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir`` of the session.

    Only on one machine (tests) may that be unset: a temporary folder is made and used. On a cluster executors couldn't
    read each other's, so an unset folder raises.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if d:
        return d.rstrip("/")
    master = spark.sparkContext.master
    if not re.fullmatch(r"local(\[.*\])?", master):
        raise RuntimeError(f"set spark.checkpoint.dir to a folder that all executors of {master} share")
    if not _OWN or not os.path.isdir(_OWN[0]):
        _OWN[:] = [tempfile.mkdtemp(prefix="tarnlake-")]
        atexit.register(shutil.rmtree, _OWN[0], True)
    return "file://" + _OWN[0]


class Staged:
    """A DataFrame written once to the shared folder and read back: lineage is cut, and the copy
    survives the loss of executors. ``drop()`` removes it once nothing reads it any more. ``counts`` holds how many
    rows each of the given conditions is true for."""

    def __init__(self, df: DataFrame, name: str = "stage", **conditions: Column):
        self.spark = df.sparkSession
        self.path = f"{shared_dir(self.spark)}/tarnlake-{name}-{uuid.uuid4().hex[:12]}"
        df.write.parquet(self.path)
        self.df = self.spark.read.schema(df.schema).parquet(self.path)
        # counted in what was written, a column or two; an observation of the writing would leave the session one that
        # machine-learning tasks can't carry
        self.counts: dict[str, int] = self.df.agg(*[F.count_if(c).alias(k) for k, c in conditions.items()]).first().asDict() if conditions else {}
        atexit.register(self._quietly)

    def drop(self) -> None:
        jvm = self.spark.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(self.path)
        p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
        atexit.unregister(self._quietly)

    def _quietly(self) -> None:
        try:
            if self.path.startswith("file:"):
                shutil.rmtree(self.path.removeprefix("file://").removeprefix("file:"), True)
            else:
                self.drop()
        except Exception:  # the JVM may already be gone at exit
            pass


def stage(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write ``df`` to the shared folder once and return it as a table (see ``Staged``)."""
    return Staged(df, name).df
