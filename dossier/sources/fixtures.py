"""Stand-in inputs derived from the test tables (FIXTURES.md section 3).

The reference's inputs (CV files, an application table and a profile table)
are not shipped; these views give rows of the same schemas from the given
tables. They only shape input -- none of the library's work happens here, and
the operators take nothing from how these rows are made.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .tables import read_table

NL = "\n"


def _s(c) -> F.Column:
    return F.col(c).cast("string") if isinstance(c, str) else c.cast("string")


def scan_tasks(spark: SparkSession) -> int | None:
    """How many tasks the small test files are dealt out to: only what the
    session states as ``spark.dossier.scanTasks`` (bench.py does), else none."""
    n = spark.conf.get("spark.dossier.scanTasks", None)
    return int(n) if n else None


def cv_documents(spark: SparkSession, base_dir: str) -> DataFrame:
    """``(doc_id, cv_path, cv_text)``: CV-shaped text around each document."""
    d = read_table(spark, base_dir, "documents", ["doc_id", "text"], scan_tasks(spark), ["doc_id"])
    doc_id, text = F.col("doc_id"), F.col("text")

    def when_mod(m, r, val, neg=False):
        cond = (doc_id % m != r) if neg else (doc_id % m == r)
        return F.when(cond, F.lit(val)).otherwise(F.lit(""))

    cv = F.concat(
        F.lit("Candidate "), _s(doc_id), F.lit(NL),
        F.lit("Summary" + NL), text, F.lit(NL),
        F.when(doc_id % 3 == 0, F.lit("WORK HISTORY")).otherwise(F.lit("Professional Experience")), F.lit(NL),
        F.lit("Staff Accountant" + NL + "January 2014 to October 2014 Company Name" + NL
              + "- Closed the books for 2013" + NL + NL + "  Kept ledgers" + NL),
        when_mod(4, 0, "Lead Analyst" + NL + "March 2011 to May 2013" + NL + "Reported weekly" + NL),
        when_mod(6, 0, "File not found errors triaged" + NL),
        when_mod(5, 1, "Education and Training" + NL + "Bachelor of Science : Accounting , May 2010"
                 + NL + "State University" + NL, neg=True),
        F.lit("Skills:" + NL + "- Tools: Python, SQL; Excel." + NL + "python,  R, Spark" + NL
              + "Stack: a, b: c" + NL),
        when_mod(7, 0, "Interests" + NL + "chess" + NL + "TECHNICAL SKILLS" + NL + "Kafka, Flink" + NL),
    )
    return d.select(
        "doc_id",
        F.concat(F.lit("../data/"), _s(doc_id), F.lit(".txt")).alias("cv_path"),
        F.when(doc_id % 10 == 0, text).otherwise(cv).alias("cv_text"),
    )


def applications(spark: SparkSession, base_dir: str) -> DataFrame:
    """``(detail_id, applicant_id, application_role, cv_path)``."""
    d = read_table(spark, base_dir, "documents", ["doc_id", "source"])
    doc_id = F.col("doc_id")
    return d.select(
        (doc_id + 1).cast("int").alias("detail_id"),
        ((doc_id * 7) % 2000).cast("int").alias("applicant_id"),
        F.col("source").alias("application_role"),
        F.when(doc_id % 17 == 3, F.lit(None).cast("string"))
         .when(doc_id % 23 == 4, F.lit("../data/missing.txt"))
         .otherwise(F.concat(F.lit("../data/"), _s(doc_id), F.lit(".txt"))).alias("cv_path"),
    )


def manifest_rows(spark: SparkSession, base_dir: str) -> DataFrame:
    """``(applicant_id, application_role, cv_path)``: rows to append, some
    without an applicant or with an overlong role."""
    d = read_table(spark, base_dir, "documents", ["doc_id", "source"])
    doc_id = F.col("doc_id")
    return d.select(F.when(doc_id % 29 != 7, (doc_id % 1000).cast("int")).alias("applicant_id"),
                    F.when(doc_id % 31 == 5, F.repeat("source", F.lit(60))).otherwise(F.col("source")).alias("application_role"),
                    F.concat(F.lit("../data/"), _s(doc_id), F.lit(".txt")).alias("cv_path"))


def profiles(spark: SparkSession, base_dir: str) -> DataFrame:
    """``(applicant_id, first_name, last_name, date_of_birth, address,
    phone_number)``, date_of_birth as text (null, invalid or valid)."""
    c = read_table(spark, base_dir, "customer", ["c_custkey", "c_name", "c_nationkey", "c_mktsegment"])
    n = read_table(spark, base_dir, "nation", ["n_nationkey", "n_name", "n_regionkey"])
    r = read_table(spark, base_dir, "region", ["r_regionkey", "r_name"])
    k = F.col("c_custkey")
    dob = F.concat(
        _s(1950 + k % 50), F.lit("-"),
        F.lpad(_s(1 + k % 12), 2, "0"), F.lit("-"),
        F.lpad(_s(1 + k % 28), 2, "0"),
    )
    return (c.join(n, F.col("c_nationkey") == F.col("n_nationkey"))
             .join(r, F.col("n_regionkey") == F.col("r_regionkey"))
             .select(
                 k.cast("int").alias("applicant_id"),
                 F.col("c_mktsegment").alias("first_name"),
                 F.col("c_name").alias("last_name"),
                 F.when(k % 11 == 0, F.lit(None).cast("string"))
                  .when(k % 13 == 0, F.lit("unknown")).otherwise(dob).alias("date_of_birth"),
                 F.concat(F.col("n_name"), F.lit(", "), F.col("r_name")).alias("address"),
                 F.concat(F.lit("08"), F.lpad(_s(k), 10, "0")).alias("phone_number"),
             ))


# The same views as SQL (runs unchanged in DuckDB); used by the oracle.
CV_DOCUMENTS_SQL = """
SELECT doc_id, concat('../data/', cast(doc_id as varchar(20)), '.txt') AS cv_path,
 CASE WHEN doc_id % 10 = 0 THEN text ELSE
 concat('Candidate ', cast(doc_id as varchar(20)), chr(10),
  'Summary', chr(10), text, chr(10),
  CASE WHEN doc_id % 3 = 0 THEN 'WORK HISTORY' ELSE 'Professional Experience' END, chr(10),
  'Staff Accountant', chr(10), 'January 2014 to October 2014 Company Name', chr(10),
  '- Closed the books for 2013', chr(10), chr(10), '  Kept ledgers', chr(10),
  CASE WHEN doc_id % 4 = 0 THEN concat('Lead Analyst', chr(10), 'March 2011 to May 2013', chr(10), 'Reported weekly', chr(10)) ELSE '' END,
  CASE WHEN doc_id % 6 = 0 THEN concat('File not found errors triaged', chr(10)) ELSE '' END,
  CASE WHEN doc_id % 5 <> 1 THEN concat('Education and Training', chr(10), 'Bachelor of Science : Accounting , May 2010', chr(10), 'State University', chr(10)) ELSE '' END,
  'Skills:', chr(10), '- Tools: Python, SQL; Excel.', chr(10), 'python,  R, Spark', chr(10), 'Stack: a, b: c', chr(10),
  CASE WHEN doc_id % 7 = 0 THEN concat('Interests', chr(10), 'chess', chr(10), 'TECHNICAL SKILLS', chr(10), 'Kafka, Flink', chr(10)) ELSE '' END)
 END AS cv_text
FROM documents
"""

APPLICATIONS_SQL = """
SELECT cast(doc_id + 1 as int) AS detail_id, cast((doc_id * 7) % 2000 as int) AS applicant_id,
 source AS application_role,
 CASE WHEN doc_id % 17 = 3 THEN NULL WHEN doc_id % 23 = 4 THEN '../data/missing.txt'
      ELSE concat('../data/', cast(doc_id as varchar(20)), '.txt') END AS cv_path
FROM documents
"""

MANIFEST_SQL = """
SELECT CASE WHEN doc_id % 29 <> 7 THEN cast(doc_id % 1000 as int) END AS applicant_id,
 CASE WHEN doc_id % 31 = 5 THEN repeat(source, 60) ELSE source END AS application_role,
 concat('../data/', cast(doc_id as varchar(20)), '.txt') AS cv_path
FROM documents
"""

PROFILES_SQL = """
SELECT cast(c_custkey as int) AS applicant_id, c_mktsegment AS first_name, c_name AS last_name,
 CASE WHEN c_custkey % 11 = 0 THEN NULL WHEN c_custkey % 13 = 0 THEN 'unknown'
      ELSE concat(cast(1950 + c_custkey % 50 as varchar(4)), '-',
        lpad(cast(1 + c_custkey % 12 as varchar(2)),2,'0'), '-',
        lpad(cast(1 + c_custkey % 28 as varchar(2)),2,'0')) END AS date_of_birth,
 concat(n_name, ', ', r_name) AS address,
 concat('08', lpad(cast(c_custkey as varchar(10)),10,'0')) AS phone_number
FROM customer JOIN nation ON c_nationkey = n_nationkey
              JOIN region ON n_regionkey = r_regionkey
"""
