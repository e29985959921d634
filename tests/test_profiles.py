from pyspark.sql import functions as F

from dossier.operators import profiles as P

SCHEMA = ("applicant_id int, first_name string, last_name string, date_of_birth string, "
          "address string, phone_number string")


def test_joins_and_biodata_defaults(spark):
    prof = spark.createDataFrame([(1, "Ana", None, "1990-1-2", None, "08"), (2, "Bo", "Li", "bad", "Addr", None)],
                                 SCHEMA)
    apps = spark.createDataFrame([(10, 1, "R", "../a.txt"), (11, 2, "R", ""), (12, 3, "R", "../c.txt"),
                                  (13, 2, "R", None)],
                                 "detail_id int, applicant_id int, application_role string, cv_path string")
    docs = spark.createDataFrame([("../a.txt",), ("../c.txt",)], "cv_path string")
    j = {r.detail_id: r for r in P.application_profiles(apps, prof).collect()}
    assert set(j) == {10, 11, 13} and j[10].name == "Ana" and j[11].name == "Bo Li"
    assert {r.detail_id for r in P.existing_applications(apps, prof, docs).collect()} == {10}
    out = {r.applicant_id: r for r in P.attach_biodata(apps.select("applicant_id").distinct(),
                                                        P.profile_lookup(prof)).collect()}
    assert (out[1].birthdate, out[1].address, out[1].phone) == ("1990-01-02", None, "08")
    assert (out[2].birthdate, out[2].address, out[2].phone) == ("bad", "Addr", None)
    assert (out[3].birthdate, out[3].address, out[3].phone, out[3].name) == ("N/A", "N/A", "N/A", "")
    one = P.profile_lookup(prof, applicant_id=2).collect()
    assert [r.applicant_id for r in one] == [2]


def test_search_over_obfuscated_profiles(spark):
    from dossier.operators.obfuscate import encrypt_profiles
    from dossier.plans.search import top_matches
    from samples import CV_A
    prof = spark.createDataFrame([(1, "Ana", "Lee", "1990-1-2", "Addr", "08"), (2, "Bo", None, None, None, None)],
                                 SCHEMA)
    apps = spark.createDataFrame([(10, 1, "R", "../a.txt"), (11, 2, "R", "../b.txt")],
                                 "detail_id int, applicant_id int, application_role string, cv_path string")
    docs = spark.createDataFrame([("../a.txt", CV_A), ("../b.txt", CV_A.replace("Excel", "Exel"))],
                                 "cv_path string, cv_text string").withColumn("doc_id", F.lit(0))
    enc = encrypt_profiles(prof, "k")
    plain = [tuple(r) for r in top_matches(apps, prof, docs, "excel, analyst", n=5).collect()]
    hidden = [tuple(r) for r in top_matches(apps, enc, docs, "excel, analyst", n=5, key="k").collect()]
    assert plain == hidden and [r[1] for r in plain] == ["Ana Lee", "Bo"]


def test_one_profile_by_id_is_pushed_down(spark, tmpdir_path):
    rows = [(i, f"n{i}", None, "1990-1-2", None, "08") for i in range(100)]
    spark.createDataFrame(rows, SCHEMA).write.parquet(tmpdir_path + "/p")
    table = spark.read.parquet(tmpdir_path + "/p")
    one = P.profile_lookup(table, applicant_id=7)
    assert "EqualTo(applicant_id,7)" in one._jdf.queryExecution().executedPlan().toString()
    assert [r.first_name for r in one.collect()] == ["n7"]
    assert P.profile_lookup(table, applicant_id=700).collect() == []


def test_top_n_is_checked(spark):
    import pytest

    from dossier.operators.score import top_n
    df = spark.createDataFrame([(1, 5), (2, 9)], "match_priority int, total_matches int")
    for bad in (-1, 1.5, "3", None, True):
        with pytest.raises(ValueError):
            top_n(df, bad, [])
    assert top_n(df, 0, []).collect() == [] and top_n(df, 1, []).first().match_priority == 1
