import re

from dossier.plans import search
from dossier.plans.catalog import SEARCH_KEYWORDS
from dossier.sources import fixtures as fx
from dossier.sources import sinks

SF = "/root/testdata/sf0.001"


def test_second_scan_is_pushed(spark, tmpdir_path):
    docs = f"{tmpdir_path}/docs"
    fx.cv_documents(spark, SF).select("doc_id", "cv_path", "cv_text").orderBy("cv_path").write.parquet(docs)
    got = search.top_matches(fx.applications(spark, SF), fx.profiles(spark, SF), spark.read.parquet(docs), SEARCH_KEYWORDS, 3)
    plan = got._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in plan.splitlines() if "FileScan" in line and "cv_text" in line]
    assert len(scans) == 1 and re.search(r"PushedFilters: \[[^\]]*In\(cv_path", scans[0]), scans
    rows = got.collect()
    assert len(rows) == 3
    by_id = search.top_matches(fx.applications(spark, SF), fx.profiles(spark, SF), spark.read.parquet(docs), SEARCH_KEYWORDS, 3, doc_key="doc_id")
    assert by_id.collect() == rows
    none = search.top_matches(fx.applications(spark, SF), fx.profiles(spark, SF), spark.read.parquet(docs), "qqqqqqqqqq", 3)
    assert none.count() == 0


def test_joins_on_bucketed_tables_do_not_shuffle(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS dossier_test")
    names = {}
    for name, df, key in (("apps", fx.applications(spark, SF), "cv_path"), ("docs", fx.cv_documents(spark, SF), "cv_path"),
                          ("apps_by_applicant", fx.applications(spark, SF), "applicant_id"), ("profiles", fx.profiles(spark, SF), "applicant_id")):
        names[name] = f"dossier_test.{name}"
        spark.sql(f"DROP TABLE IF EXISTS {names[name]}")
        sinks.write_bucketed(df, names[name], key, 4)
    t = {k: spark.table(v) for k, v in names.items()}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        from dossier.operators import profiles as P
        joined = P.application_profiles(t["apps_by_applicant"], t["profiles"])
        assert "Exchange" not in joined._jdf.queryExecution().executedPlan().toString()
        assert sorted(map(str, joined.collect())) == sorted(map(str, P.application_profiles(fx.applications(spark, SF), fx.profiles(spark, SF)).collect()))
        have = P.existing_applications(t["apps"], t["profiles"], t["docs"])
        plan = have._jdf.queryExecution().executedPlan().toString()
        docs = [k for k, line in enumerate(plan.splitlines()) if "docs" in line and "FileScan" in line]
        assert docs and sum("Exchange" in line for line in plan.splitlines()) <= 2  # of applications and profiles only
        assert have.count() == P.existing_applications(fx.applications(spark, SF), fx.profiles(spark, SF), fx.cv_documents(spark, SF)).count()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.sql("DROP DATABASE dossier_test CASCADE")


def test_encrypted_names_are_dealt_to_tasks(spark):
    """The profiles of a search with a key are spread before their names are decrypted."""
    from dossier.operators import obfuscate
    from dossier.operators import profiles as P
    hidden = obfuscate.encrypt_profiles(fx.profiles(spark, SF), "key")
    named = P.application_profiles(fx.applications(spark, SF), hidden, "key")
    assert named._jdf.queryExecution().optimizedPlan().toString().count("RepartitionByExpression") == 2
    plain = P.application_profiles(fx.applications(spark, SF), fx.profiles(spark, SF))
    assert sorted(map(str, named.collect())) == sorted(map(str, plain.collect()))
