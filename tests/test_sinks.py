import os

from pyspark.sql.types import IntegerType, StringType, StructField, StructType
import pytest

from dossier.sources import sinks


def test_ensure_append_write(spark, tmpdir_path):
    path = os.path.join(tmpdir_path, "apps")
    schema = StructType([StructField("detail_id", IntegerType()), StructField("cv_path", StringType())])
    assert sinks.ensure_table(spark, path, schema) is True
    assert sinks.ensure_table(spark, path, schema) is False
    df = spark.createDataFrame([(1, "a"), (2, "b")], schema)
    assert sinks.append_rows(df, path) == 2
    assert sinks.append_rows(df, path) == 2  # plain append keeps duplicates
    assert spark.read.parquet(path).count() == 4
    with pytest.raises(Exception):
        sinks.write_new_table(df, path)


def test_encrypt_table_and_text(spark, tmpdir_path):
    src = os.path.join(tmpdir_path, "profiles")
    rows = [(1, "A", "B", None, "x", "08"), (2, "C", None, "2000-01-01", None, "09")]
    spark.createDataFrame(rows, "applicant_id int, first_name string, last_name string, date_of_birth string, "
                                "address string, phone_number string").write.parquet(src)
    dst = os.path.join(tmpdir_path, "profiles_enc")
    audit = sinks.encrypt_table(spark, src, dst, "key")
    assert audit == {"rows_processed": 2, "rows_failed": 0}
    assert spark.read.parquet(dst).count() == 2
    with pytest.raises(Exception):
        sinks.encrypt_table(spark, src, dst, "key")  # never in place / twice
    out = os.path.join(tmpdir_path, "flat")
    sinks.write_text(spark.createDataFrame([("a b",), ("c",)], "t string"), "t", out)
    assert sorted(r.value for r in spark.read.text(out).collect()) == ["a b", "c"]


def test_text_reads_back_unchanged(spark, tmpdir_path):
    texts = ["one line", "two\nlines\r\n\n", "", "ends with a line end\n", "é\x1e x", "a\x1e\x1e"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").repartition(3)
    sinks.write_records(df, "t", f"{tmpdir_path}/records")
    assert sorted(r.value for r in sinks.read_records(spark, f"{tmpdir_path}/records").collect()) == sorted(texts)
    with pytest.raises(Exception):
        sinks.write_records(spark.createDataFrame([("a\x1e\nb",)], "t string"), "t", f"{tmpdir_path}/bad")
    assert not os.path.exists(f"{tmpdir_path}/bad/_SUCCESS")


def test_one_file_per_document(spark, tmpdir_path):
    rows = [("a/b c", "two\nlines"), ("..", ""), ("é", None), ("plain", "x\r\n")]
    df = spark.createDataFrame(rows, "id string, t string").repartition(3)
    for _ in range(2):  # a second run replaces the files
        done = sinks.write_text_files(df, "id", "t", f"{tmpdir_path}/files").collect()
    found = {r["id"]: open(f"{tmpdir_path}/files/{r['file']}", newline="", encoding="utf-8").read() for r in done}
    assert found == {i: t or "" for i, t in rows} and len(os.listdir(f"{tmpdir_path}/files")) == 4


def test_swap_survives_failures(spark, tmpdir_path, monkeypatch):
    path = f"{tmpdir_path}/profiles"
    rows = [(1, "A", "B", None, "x", "08"), (2, "C", None, "2000-01-01", None, "09")]
    plain = spark.createDataFrame(rows, "applicant_id int, first_name string, last_name string, date_of_birth string, "
                                        "address string, phone_number string")
    sinks.swap_table(plain, path)
    held = sinks.read_version(spark, path)
    with monkeypatch.context() as m:  # between writing and the swap
        m.setattr(sinks, "_point", lambda *a: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            sinks.encrypt_in_place(spark, path, "key")
    assert sinks.read_version(spark, path).filter("first_name = 'A'").count() == 1
    with monkeypatch.context() as m:  # after the swap
        m.setattr(sinks, "drop_versions", lambda *a, **k: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            sinks.encrypt_in_place(spark, path, "key")
    assert sinks.read_version(spark, path).filter("first_name = 'A'").count() == 0
    assert held.count() == 2  # a reader of the old version goes on
    again = sinks.read_version(spark, path)
    sinks.swap_table(again.limit(1), path)
    assert sinks.read_version(spark, path).count() == 1 and again.count() == 2
    assert sum(n.startswith("version-") for n in os.listdir(path)) == 2


def test_rejected_rows_are_kept_with_reasons(spark, tmpdir_path, monkeypatch):
    from dossier.plans.seed import APPLICATION_SCHEMA
    path = f"{tmpdir_path}/apps"
    sinks.ensure_table(spark, path, APPLICATION_SCHEMA)
    assert sinks.rejected_applications(spark, path).count() == 0
    m = spark.createDataFrame([(1, "A", "p"), (None, "A", "q"), (2, "x" * 101, "r"), (3, None, "s")],
                              "applicant_id int, application_role string, cv_path string")
    assert sinks.append_applications_to(spark, m, path) == {"rows_inserted": 2, "rows_skipped": 2}
    bad = sorted((r.reason, r.cv_path) for r in sinks.rejected_applications(spark, path).collect())
    assert bad == [("no applicant", "q"), ("role too long", "r")]
    assert sorted(r.detail_id for r in spark.read.parquet(path).collect()) == [1, 2]
    real = sinks.recover_appends
    calls = []
    with monkeypatch.context() as mp:  # cut off between the commit and the move
        mp.setattr(sinks, "recover_appends", lambda *a: real(*a) if not calls.append(1) and len(calls) == 1 else (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            sinks.append_applications_to(spark, m, path)
    assert spark.read.parquet(path).count() == 2
    sinks.recover_appends(spark, path)
    assert sorted(r.detail_id for r in spark.read.parquet(path).collect()) == [1, 2, 3, 4]
    assert sinks.rejected_applications(spark, path).count() == 4
    os.makedirs(f"{path}/_staging-lost/outcome=inserted")  # never committed
    sinks.append_applications_to(spark, m.limit(0), path)
    assert spark.read.parquet(path).count() == 4 and not any(n.startswith("_staging") for n in os.listdir(path))
