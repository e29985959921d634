import os
import shutil
import subprocess
import sys

import duckdb
import pytest

import __spark_entry__ as se
from dossier.plans.catalog import QUERIES
from dossier.plans.oracle import oracle_sql

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer documents conversations".split()


def test_keys_align():
    assert set(QUERIES) == set(oracle_sql()) and len(QUERIES) == 38
    assert set(se.oracle_sql()) <= set(se.queries()) and set(QUERIES) <= set(se.queries())


ROOT = os.path.dirname(os.path.abspath(se.__file__))
TELL = "import __spark_entry__ as se; print(len(se.queries()), len(se.oracle_sql()))"


@pytest.mark.parametrize("gone", [["llm"], ["llm", "corpus_pipeline.py"]])
def test_the_rest_stands_alone(tmpdir_path, gone):
    copy = f"{tmpdir_path}/copy"
    shutil.copytree(ROOT, copy, ignore=shutil.ignore_patterns(".git", "tests", "__pycache__", *gone))
    out = subprocess.run([sys.executable, "-c", TELL], cwd=copy, env={**os.environ, "PYTHONPATH": copy}, capture_output=True, text=True)
    assert out.stdout.split() == [str(len(QUERIES))] * 2, out.stderr


@pytest.mark.parametrize("module", ["tokenizers", "xxhash", "zstandard"])
def test_a_missing_package_takes_no_other_query(module):
    tell = f"import sys; sys.modules[{module!r}] = None; " + TELL
    out = subprocess.run([sys.executable, "-c", tell], cwd=ROOT, env={**os.environ, "PYTHONPATH": ROOT}, capture_output=True, text=True)
    assert int(out.stdout.split()[0]) >= len(QUERIES), out.stderr


def test_entry_runs(spark):
    df = se.entry(spark)
    rows = df.collect()
    assert 0 < len(rows) <= 20
    assert df.columns == ["applicant_id", "name", "total_matches", "matched_keywords", "cv_path",
                          "match_priority", "detail_id"]


FAST = ["application_profiles", "existing_applications", "profile_lookup", "sections", "flat_text",
        "experience_entries", "skills", "keyword_hits", "top_matches", "decrypt_profiles",
        "append_applications", "manifest_preview", "assemble_documents", "profile_by_id", "candidate_summary_all",
        "search_encrypted", "document_report", "append_checked", "append_audit", "keyword_hits_many"]


@pytest.mark.skipif(not os.path.exists(SF), reason="test tables not present")
@pytest.mark.parametrize("name", FAST)
def test_query_matches_oracle_small(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df = se.queries()[name](spark, SF)
    srows = df.collect()
    res = con.execute(se.oracle_sql()[name])
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    assert sorted(df.columns) == sorted(dcols)
    idx = [df.columns.index(c) for c in dcols]
    norm = lambda v: v.isoformat() if hasattr(v, "isoformat") else v
    a = sorted(repr(tuple(norm(r[i]) for i in idx)) for r in srows)
    b = sorted(repr(tuple(norm(v) for v in r)) for r in drows)
    assert a == b
