"""Seed the applications table from a folder tree.

List role folders (paths only; a listing task passes on N names a role at most), keep
the first N files of each role by name, create the table if it is missing and append the rows with
``detail_id`` continuing after the table's maximum. Returns the manifest
size and the number of rows appended (the reference prints both)."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from ..operators.manifest import CV_PATH_PREFIX, MAX_FILES_PER_ROLE, manifest_top_per_role
from ..sources.sinks import append_applications_to, ensure_table
from ..sources.tables import list_folder_tree

APPLICATION_SCHEMA = StructType([
    StructField("detail_id", IntegerType(), False),
    StructField("applicant_id", IntegerType(), False),
    StructField("application_role", StringType(), True),
    StructField("cv_path", StringType(), True),
])


def seed_applications(spark: SparkSession, folder: str, table_path: str,
                      prefix: str = CV_PATH_PREFIX, max_files: int = MAX_FILES_PER_ROLE) -> dict:
    """``{"manifest_rows", "inserted"}``: they differ by the rows that the
    table does not accept (a role of more than 100 characters)."""
    manifest = manifest_top_per_role(list_folder_tree(spark, folder, max_files=max_files), prefix, max_files)
    ensure_table(spark, table_path, APPLICATION_SCHEMA)
    done = append_applications_to(spark, manifest, table_path)
    return {"manifest_rows": done["rows_inserted"] + done["rows_skipped"], "inserted": done["rows_inserted"]}
