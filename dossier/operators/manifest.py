"""C5 seeding: folder-tree manifest, first N files per role, id assignment.

* ``manifest_top_per_role`` is a top-N-per-group: ``row_number() <= N`` by role
  and part of the role (a hash of the file name), then by role. Spark puts a
  partial ``WindowGroupLimit`` before each shuffle; a role that holds a third of
  all files is cut down by ``PARTS`` tasks and the last one reads N rows of each.
* ``append_applications`` numbers new rows consecutively after the table's
  current maximum in manifest order, without a global window over the rows: a
  row's number is the maximum, plus the rows of all earlier ranges of the order,
  plus its place in its own range. Only the table of ranges is summed up.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.sqltext import lit

# Path prefix of manifest entries, files taken per role, rows
# shown in a preview.
CV_PATH_PREFIX = "../data/"
MAX_FILES_PER_ROLE = 20
PREVIEW_ROWS = 10

# What the applications table accepts.
MAX_ROLE_CHARS = 100

INSERTED, NO_APPLICANT, LONG_ROLE = "inserted", "no applicant", "role too long"

PARTS = 64  # of a role, ranked side by side
RANGES = 64  # of the manifest order, numbered side by side
SAMPLE = 64  # rows per range that the bounds are taken from


def manifest_top_per_role(listing: DataFrame, prefix: str = CV_PATH_PREFIX,
                          max_files: int = MAX_FILES_PER_ROLE) -> DataFrame:
    """From ``(application_role, file_name)`` the first
    ``max_files`` files of each role by name; ``applicant_id`` is the rank in
    the role, ``cv_path`` the prefix plus the file name (folder dropped)."""
    rows = listing.select("application_role", "file_name") \
                  .withColumn("_part", F.pmod(F.xxhash64("file_name"), F.lit(PARTS)))
    for by in (["application_role", "_part"], ["application_role"]):
        w = Window.partitionBy(*by).orderBy(F.col("file_name").asc())
        rows = rows.withColumn("applicant_id", F.row_number().over(w).cast("int")) \
                   .filter(F.col("applicant_id") <= max_files)
    return rows.select(F.concat(F.lit(prefix), F.col("file_name")).alias("cv_path"),
                       "application_role", "applicant_id")


def outcome() -> Column:
    """What the applications table makes of a row: ``inserted``, or the reason
    why not (it takes an applicant, and a role that is missing or not too long)."""
    return F.when(F.col("applicant_id").isNull(), NO_APPLICANT) \
            .when(F.char_length("application_role") > MAX_ROLE_CHARS, LONG_ROLE).otherwise(INSERTED)


def acceptable() -> Column:
    """The applications table takes the row."""
    return outcome() == INSERTED


def _order_literal(known: bool, role: str, applicant: int, path: str) -> str:
    return f"named_struct('known', {known}, 'role', {lit(role)}, 'applicant', {applicant}L, 'path', {lit(path)})"


def _range_sql(bounds: list[str], low: int, high: int) -> str:
    """SQL: how many of the sorted ``bounds`` are not above ``_o``, by halving."""
    if low == high:
        return str(low)
    mid = (low + high) // 2
    return f"CASE WHEN _o < {bounds[mid]} THEN {_range_sql(bounds, low, mid)} ELSE {_range_sql(bounds, mid + 1, high)} END"


def append_applications(existing: DataFrame, manifest: DataFrame, ranges: int = RANGES) -> DataFrame:
    """The acceptable manifest rows as new application rows,
    ``detail_id`` continuing after the existing maximum (1 for an empty table)
    in manifest order (role, then applicant_id, then path; a missing role
    first). Re-seeding appends duplicates, as a plain insert does; anti-join
    first to avoid that.

    Rows are dealt to ``ranges`` ranges of that order by bounds which are literals of
    the plan, taken once from at most ``SAMPLE`` rows a range (those of the smallest
    hash); so a role that has all rows is numbered by as many tasks as any. A row's
    number is the maximum, plus the rows of earlier ranges, plus its place in its
    own range. Rows that are equal in all three columns share a range."""
    m = manifest.select("applicant_id", "application_role", "cv_path").filter(acceptable())
    order = F.struct(F.col("application_role").isNotNull().alias("known"), F.coalesce("application_role", F.lit("")).alias("role"),
                     F.col("applicant_id").cast("long").alias("applicant"), F.coalesce("cv_path", F.lit("")).alias("path"))
    hashed = m.select(order.alias("o")).withColumn("h", F.xxhash64("o"))
    sample = sorted(tuple(r["o"]) for r in hashed.orderBy("h").limit(SAMPLE * ranges).collect())
    cut = sorted({sample[len(sample) * i // ranges] for i in range(1, ranges)}) if sample else []
    rows = m.withColumn("_o", order).withColumn("_range", F.expr(_range_sql([_order_literal(*c) for c in cut], 0, len(cut))))
    sizes = rows.groupBy("_range").agg(F.count(F.lit(1)).alias("_n"))  # one row per range
    earlier = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    before = sizes.select("_range", F.coalesce(F.sum("_n").over(earlier), F.lit(0).cast("long")).alias("_before"))
    place = F.row_number().over(Window.partitionBy("_range").orderBy("_o"))
    top = existing.agg(F.coalesce(F.max("detail_id"), F.lit(0)).cast("long").alias("_top"))
    return (rows.withColumn("_place", place).join(F.broadcast(before), "_range")
                .select((top.scalar() + F.col("_before") + F.col("_place")).cast("int").alias("detail_id"),
                        "applicant_id", "application_role", "cv_path"))


def append_audit(manifest: DataFrame) -> DataFrame:
    """How many manifest rows an append writes and how many it skips."""
    return manifest.agg(F.count_if(acceptable()).alias("rows_inserted"),
                        F.count_if(~acceptable()).alias("rows_skipped"))


def manifest_preview(manifest: DataFrame, rows: int = PREVIEW_ROWS) -> DataFrame:
    """The first ``rows`` manifest entries in manifest order plus one
    summary row holding the total and how many were not shown."""
    ordered = manifest.select("applicant_id", "application_role", "cv_path")
    head = ordered.orderBy("application_role", "applicant_id").limit(rows)
    w_pos = F.row_number().over(Window.orderBy("application_role", "applicant_id"))
    head = head.select(w_pos.cast("int").alias("position"), F.lit("file").alias("kind"),
                       "applicant_id", "application_role", "cv_path",
                       F.lit(None).cast("long").alias("total_files"),
                       F.lit(None).cast("long").alias("not_shown"))
    total = ordered.agg(F.count(F.lit(1)).alias("total_files")).select(
        F.lit(None).cast("int").alias("position"), F.lit("summary").alias("kind"),
        F.lit(None).cast("int").alias("applicant_id"), F.lit(None).cast("string").alias("application_role"),
        F.lit(None).cast("string").alias("cv_path"),
        F.col("total_files"), F.greatest(F.col("total_files") - rows, F.lit(0)).alias("not_shown"))
    return head.unionByName(total)
