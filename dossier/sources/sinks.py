"""Sinks: create-if-missing, append, write-new (never in place), versions, text.

Writes go through Spark's committers, so a job either publishes all of its
output or none; a table is never rewritten in place (obfuscating twice or a
half-finished rewrite cannot happen). What takes more than one step (an append
with its rejected rows, the swap to a new version) leaves a state from which the
next call goes on.
"""

from __future__ import annotations

import os
import urllib.parse
import uuid
from collections.abc import Iterator, Sequence

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..operators.manifest import INSERTED, append_applications, outcome
from ..operators.obfuscate import PROFILE_TEXT_COLUMNS, encrypt_with_status


RECORD_END = "\x1e\n"
REJECTED = "_rejected"  # folder in a table, hidden from its readers
STAGING = "_staging-"
VERSION = "version-"
POINTER = "_current"


def _fs(spark: SparkSession, path: str):
    """Hadoop's file system of a path, and the path."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


def _names(spark: SparkSession, path: str) -> list[str]:
    fs, p = _fs(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def _delete(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.delete(p, True)


def ensure_table(spark: SparkSession, path: str, schema: StructType, fmt: str = "parquet") -> bool:
    """Create an empty table with ``schema`` unless ``path`` exists.
    Returns True when it was created."""
    if path_exists(spark, path):
        return False
    spark.createDataFrame([], schema).write.format(fmt).mode("errorifexists").save(path)
    return True


def write_bucketed(df: DataFrame, name: str, key: str, buckets: int) -> None:
    """A catalog table of ``buckets`` buckets by ``key``, each sorted by it, one file
    a bucket. Joins on ``key`` of tables with equally many buckets need no shuffle, and a
    filter on it reads few row groups. Rows without key, which join
    nothing, lie together in one bucket; a hot key makes a large bucket: where it
    holds much of the table, plain tables and AQE's skew join serve better."""
    df.repartition(buckets, key).write.bucketBy(buckets, key).sortBy(key).mode("errorifexists").saveAsTable(name)


def append_rows(df: DataFrame, path: str, fmt: str = "parquet") -> int:
    """Append ``df`` to the table at ``path``; returns the rows written
    (counted while writing, one pass)."""
    obs = Observation("append")
    df.observe(obs, F.count(F.lit(1)).alias("rows")).write.format(fmt).mode("append").save(path)
    return int(obs.get["rows"])


def append_applications_to(spark: SparkSession, manifest: DataFrame, path: str) -> dict:
    """Append the acceptable rows of ``manifest`` to the applications
    table at ``path`` with continued ids; the others are kept beside them with
    the reason (``rejected_applications``). Returns ``{"rows_inserted",
    "rows_skipped"}``, counted while writing (one pass over the manifest).

    One job writes both kinds into a staging folder; once it is committed, the
    rejected files and then the others move to their places. A call that is cut off
    before the commit leaves nothing; after it, ``recover_appends`` (which each
    append calls first) moves the rest."""
    recover_appends(spark, path)
    top = spark.read.parquet(path).agg(F.max("detail_id").alias("detail_id"))
    top = spark.createDataFrame([tuple(top.first())], top.schema)  # fixed: the append must not read its own rows
    good = append_applications(top, manifest).withColumn("outcome", F.lit(INSERTED))
    told = outcome()
    bad = manifest.filter(told != INSERTED).select(F.lit(None).cast("int").alias("detail_id"), *good.columns[1:-1], told.alias("outcome"))
    obs = Observation("append")
    rows = good.unionByName(bad).observe(obs, F.count("detail_id").alias("rows_inserted"),
                                         F.count_if(F.col("detail_id").isNull()).alias("rows_skipped"))
    staging = f"{path.rstrip('/')}/{STAGING}{uuid.uuid4().hex}"
    rows.write.partitionBy("outcome").parquet(staging)
    recover_appends(spark, path)
    return {k: int(v) for k, v in obs.get.items()}


def recover_appends(spark: SparkSession, path: str) -> None:
    """Brings to an end what earlier appends left: a committed staging folder is
    moved into the table, any other one is deleted. One writer at a time."""
    base = path.rstrip("/")
    for name in _names(spark, base):
        if not name.startswith(STAGING):
            continue
        staging = f"{base}/{name}"
        if path_exists(spark, f"{staging}/_SUCCESS"):
            kinds = [k for k in _names(spark, staging) if k.startswith("outcome=")]
            for kind in sorted(kinds, key=lambda k: k == f"outcome={INSERTED}"):  # inserted rows last
                to = base if kind == f"outcome={INSERTED}" else f"{base}/{REJECTED}/{kind.replace('outcome', 'reason', 1)}"
                fs, folder = _fs(spark, to)
                fs.mkdirs(folder)
                for f in _names(spark, f"{staging}/{kind}"):
                    source, target = (_fs(spark, x)[1] for x in (f"{staging}/{kind}/{f}", f"{to}/{f}"))
                    if not f.startswith(("_", ".")) and not fs.rename(source, target):
                        raise OSError(f"cannot move {source} to {target}")
        _delete(spark, staging)


def rejected_applications(spark: SparkSession, path: str) -> DataFrame:
    """The rows that appends to the table at ``path`` did not take, with ``reason``."""
    folder, kept = f"{path.rstrip('/')}/{REJECTED}", spark.read.parquet(path)
    columns = [f.name for f in kept.schema if f.name != "detail_id"]
    found = kept.select(*columns, F.lit(None).cast("string").alias("reason")).limit(0)
    for name in _names(spark, folder):  # one per reason
        told = spark.read.parquet(f"{folder}/{name}").select(*columns, F.lit(urllib.parse.unquote(name.split("=", 1)[1])).alias("reason"))
        found = found.unionByName(told)
    return found


def read_version(spark: SparkSession, path: str) -> DataFrame:
    """The current version of the table that ``swap_table`` keeps at ``path``."""
    return spark.read.parquet(f"{path.rstrip('/')}/{_current(spark, path)}")


def _current(spark: SparkSession, path: str) -> str | None:
    """Name of the version that the pointer tells."""
    fs, p = _fs(spark, f"{path.rstrip('/')}/{POINTER}")
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def _point(spark: SparkSession, path: str, version: str) -> None:
    """Makes ``version`` the current one: a new pointer file takes the old one's
    place by one rename, which HDFS and local file systems do at once."""
    jvm = spark.sparkContext._jvm
    base = path.rstrip("/")
    fs, new = _fs(spark, f"{base}/{POINTER}.{uuid.uuid4().hex}")
    stream = fs.create(new, False)
    stream.write(bytearray(version.encode()))
    stream.close()
    options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    options[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    files = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark.sparkContext._jsc.hadoopConfiguration())
    files.rename(new, _fs(spark, f"{base}/{POINTER}")[1], options)


def swap_table(df: DataFrame, path: str) -> None:
    """``df`` becomes the table at ``path``: it is written as a version of its
    own, then the pointer moves to it. Until then readers see the old version, and
    ``df`` may be made of it; whatever fails before leaves it the current one. The
    version before the current one stays for readers that still hold it;
    older ones and those that were never pointed at go. One writer at a time."""
    spark, base = df.sparkSession, path.rstrip("/")
    version = f"{VERSION}{uuid.uuid4().hex}"
    df.write.mode("errorifexists").parquet(f"{base}/{version}")
    before = _current(spark, base)
    _point(spark, base, version)
    drop_versions(spark, base, keep=[before] if before else [])


def drop_versions(spark: SparkSession, path: str, keep: Sequence[str] = ()) -> None:
    """Deletes versions and pointers that are neither current nor in ``keep``."""
    base, current = path.rstrip("/"), _current(spark, path)
    for name in _names(spark, base):
        if (name.startswith(VERSION) and name != current and name not in keep) or name.startswith(f"{POINTER}."):
            _delete(spark, f"{base}/{name}")


def write_new_table(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Write ``df`` as a new table; fails if ``path`` already exists."""
    df.write.format(fmt).mode("errorifexists").save(path)


def write_text(df: DataFrame, text_col: str, path: str) -> None:
    """The texts of ``text_col`` as lines of text files. A text with line ends
    becomes several lines; ``write_records`` and ``write_text_files`` keep it whole."""
    df.select(F.col(text_col).alias("value")).write.mode("errorifexists").text(path)


def write_records(df: DataFrame, text_col: str, path: str) -> None:
    """The texts of ``text_col`` as records of text files, read back by
    ``read_records``. A record ends with a record separator and a line end, so line
    ends inside a text stay; a text that holds just that sequence fails the write,
    which then publishes nothing. A null text becomes an empty one."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    clear = F.when(F.contains(text, F.lit(RECORD_END)), F.raise_error(F.lit("a text holds the end of a record"))).otherwise(text)
    df.select(clear.alias("value")).write.mode("errorifexists").option("lineSep", RECORD_END).text(path)


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """The records of ``write_records`` as ``value``."""
    return spark.read.option("lineSep", RECORD_END).text(path)


def write_text_files(df: DataFrame, id_col: str, text_col: str, path: str) -> DataFrame:
    """One UTF-8 file per row in the folder ``path`` (a local path or a URI
    that ``pyarrow.fs`` knows), named by the row's id (percent-encoded; unique, not
    null) with ``.txt``. Executors write them, each under a name of its attempt that
    is renamed when the file is whole, so a repeated attempt replaces its own
    files and no half file is seen. Returns ``(id_col, file, n_bytes)`` of what was
    written; writing happens when that is read."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = pafs.FileSystem.from_uri(path if "://" in path else os.path.abspath(path))
        fs.create_dir(root, recursive=True)
        attempt = TaskContext.get().taskAttemptId()
        for batch in batches:
            names, sizes = [], []
            for i, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                if i is None:
                    raise ValueError("a text without id has no file name")
                told = (text.as_py() or "").encode()
                name = urllib.parse.quote(str(i), safe="") + ".txt"
                with fs.open_output_stream(f"{root}/_{name}.{attempt}") as out:
                    out.write(told)
                fs.move(f"{root}/_{name}.{attempt}", f"{root}/{name}")
                names.append(name)
                sizes.append(len(told))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(names, pa.string()), pa.array(sizes, pa.int64())],
                                             names=[id_col, "file", "n_bytes"])

    rows = df.select(id_col, F.col(text_col).cast("string").alias("_text"))
    kind = rows.schema[0].dataType.simpleString()
    return rows.mapInArrow(run, f"`{id_col}` {kind}, file string, n_bytes long")


def encrypt_table(spark: SparkSession, src_path: str, dst_path: str, key: str,
                  fmt: str = "parquet") -> dict:
    """C4: read the profile table, obfuscate it into a *new* table and
    return ``{"rows_processed", "rows_failed"}`` observed during the write."""
    src = spark.read.format(fmt).load(src_path)
    enc = encrypt_with_status(src, key)
    obs = Observation("encrypt")
    out = enc.observe(obs, F.count_if(F.col("ok")).alias("rows_processed"),
                      F.count_if(~F.col("ok")).alias("rows_failed"))
    write_new_table(out.select("applicant_id", *PROFILE_TEXT_COLUMNS), dst_path, fmt)
    m = obs.get
    return {"rows_processed": int(m["rows_processed"]), "rows_failed": int(m["rows_failed"])}


def encrypt_in_place(spark: SparkSession, path: str, key: str) -> dict:
    """The profile table at ``path`` (a ``swap_table``) is replaced by its
    obfuscated form, all or nothing; returns ``{"rows_processed", "rows_failed"}``."""
    obs = Observation("encrypt")
    out = encrypt_with_status(read_version(spark, path), key).observe(
        obs, F.count_if(F.col("ok")).alias("rows_processed"), F.count_if(~F.col("ok")).alias("rows_failed"))
    swap_table(out.select("applicant_id", *PROFILE_TEXT_COLUMNS), path)
    return {k: int(v) for k, v in obs.get.items()}
