"""Helpers shared by the training-text operators.

Intermediate tables are Parquet under the folder that ``spark.checkpoint.dir``
names (shared by driver and executors), so a lost executor costs a task, never
a table, and every later read sees the same rows.
"""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from collections.abc import Callable
from pathlib import Path

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import checkpoint_dir


def shared_dir(spark: SparkSession) -> str:
    """The cluster's checkpoint folder. Only a local master may do without one: it
    gets a temporary folder, which executors of a cluster would not see."""
    d = spark.conf.get("spark.checkpoint.dir", None) or checkpoint_dir(spark)
    if not d and spark.sparkContext.master.split("[")[0] != "local":
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return (d or checkpoint_dir(spark, tempfile.mkdtemp(prefix="dossier-shared-"))).rstrip("/")


class Scratch:
    """A folder of its own in the shared folder, for one run of an operator."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"

    def save(self, df: DataFrame, name: str) -> DataFrame:
        """Writes ``df`` as a table and reads it back: the lineage ends here."""
        path = f"{self.path}/{name}"
        df.write.option("compression", "zstd").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *names: str) -> None:
        """Deletes tables that nothing reads any more."""
        jvm = self.spark.sparkContext._jvm
        for name in names:
            p = jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")
            p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


_SHIPPED: set[str] = set()
_KEPT: dict[object, object] = {}


def kept(name: object, make: Callable[[], object]) -> object:
    """An object that a worker process keeps over its tasks. It keeps one:
    asking for another name drops the last, so tables don't add up."""
    if name not in _KEPT:
        _KEPT.clear()
        _KEPT[name] = make()
    return _KEPT[name]


def ship(spark: SparkSession) -> None:
    """Sends this package to the executors (once per application), as
    ``--py-files`` would: the Python tasks of the operators import it."""
    package = Path(__file__).parents[1]
    if spark.sparkContext.applicationId in _SHIPPED or not package.is_dir():
        return
    archive = Path(tempfile.mkdtemp(prefix="dossier-ship-")) / f"{package.name}.zip"
    with zipfile.ZipFile(archive, "w") as z:
        for f in sorted(package.rglob("*.py")):
            z.write(f, f"{package.name}/{f.relative_to(package)}")
    spark.sparkContext.addPyFile(str(archive))
    _SHIPPED.add(spark.sparkContext.applicationId)


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")


def numbered(df: DataFrame, scratch: Scratch, name: str, *order: str) -> DataFrame:
    """``df`` (written as a table) with ``_index``: 0, 1, ... in the order of
    ``order``, ties in any order. Ranges of the order are numbered in parallel
    and shifted by the sizes of the ranges before, one number per range."""
    spark = df.sparkSession
    n = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    ranged = (df.repartitionByRange(n, *[F.col(c).asc_nulls_last() for c in order])
              .sortWithinPartitions(*[F.col(c).asc_nulls_last() for c in order])
              .withColumn("_at", F.monotonically_increasing_id()))
    ranged = scratch.save(ranged, name)
    part = F.shiftright("_at", 33)
    sizes = {r["p"]: r["n"] for r in
             ranged.groupBy(part.alias("p")).agg(F.count(F.lit(1)).alias("n")).collect()}
    shift, rows = 0, []
    for p in sorted(sizes):
        rows.append((p, shift))
        shift += sizes[p]
    shifts = spark.createDataFrame(rows, "_p long, _shift long")  # one row per range
    return (ranged.withColumn("_p", part).join(F.broadcast(shifts), "_p")
            .withColumn("_index", F.col("_shift") + F.col("_at").bitwiseAND((1 << 33) - 1))
            .drop("_p", "_shift", "_at"))


def components(edges: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """Connected components of the links ``(a, b)``: ``(node, component)`` for
    every node of a link, ``component`` its smallest reachable node.

    Each round hooks every node to its smallest lower neighbour, flattens the
    chains by pointer jumping and contracts the links; all of it in tables."""
    e = edges.filter("a is not null and b is not null and a <> b").select(
        F.least("a", "b").alias("lo"), F.greatest("a", "b").alias("hi")).distinct()
    e = scratch.save(e, f"{name}-links")
    nodes = e.select(F.col("lo").alias("node")).union(e.select("hi")).distinct() \
             .withColumn("component", F.col("node"))
    live, turn = e, 0
    while not live.isEmpty():
        turn += 1
        hook = scratch.save(live.groupBy("hi").agg(F.min("lo").alias("up")), f"{name}-hook-{turn}-0")
        jump = 0
        while True:
            above = hook.select(F.col("hi").alias("up"), F.col("up").alias("upper"))
            if hook.join(above, "up", "left_semi").isEmpty():
                break
            jump += 1
            hook = scratch.save(
                hook.join(above, "up", "left").select("hi", F.coalesce("upper", "up").alias("up")),
                f"{name}-hook-{turn}-{jump}")
        nodes = _lifted(nodes, hook, "component")
        live = _lifted(_lifted(live, hook, "lo"), hook, "hi").filter("lo <> hi").select(
            F.least("lo", "hi").alias("lo"), F.greatest("lo", "hi").alias("hi")).distinct()
        live = scratch.save(live, f"{name}-live-{turn}")
    return nodes


def _lifted(df: DataFrame, hook: DataFrame, c: str) -> DataFrame:
    up = hook.select(F.col("hi").alias(c), F.col("up").alias("_up"))
    return df.join(up, c, "left").withColumn(c, F.coalesce("_up", c)).drop("_up")


def union(parent: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Union of the pairs (a, b) in the forest ``parent`` (flat on return)."""
    while len(a):
        a, b = parent[a], parent[b]
        apart = a != b
        a, b = a[apart], b[apart]
        np.minimum.at(parent, np.maximum(a, b), np.minimum(a, b))
        while True:
            up = parent[parent]
            if np.array_equal(up, parent):
                break
            parent[:] = up
