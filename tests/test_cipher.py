import base64
import binascii

from hypothesis import given, settings, strategies as st

from pyspark.sql import functions as F

from dossier.functions import cipher as C
from dossier.operators import obfuscate, profiles as P

KEY = "k3y-é"
VALUES = [None, "", "Bayu", "Jalan Cisitu 1, Bandung", "0812345", "naïve ü 漢字 😀", "None", "2000-02-29"]


def test_encrypt_by_hand(spark):
    df = spark.createDataFrame([("A",), ("AB",), ("é",), ("Bayu",), ("",), (None,)], "v string")
    got = [tuple(r) for r in df.select(C.xor_encrypt("v", "k"), C.xor_encrypt("v", "k3")).collect()]
    assert got == [("Kg==", "Kg=="), ("Kik=", "KnE="), ("qMI=", "qJo="), ("KQoSHg==", "KVISRg=="), ("", ""), (None, None)]


def test_roundtrip_and_bad_input(spark):
    df = spark.createDataFrame([(v,) for v in VALUES], "v string")
    got = [r[0] for r in df.select(C.xor_decrypt(C.xor_encrypt("v", KEY), KEY)).collect()]
    assert got == VALUES
    bad = ["Q", "QQ", "QUJDR", "qMI=", None, ""]  # no whole quads; then bytes that aren't UTF-8 under this key
    df = spark.createDataFrame([(v,) for v in bad], "v string")
    assert [r[0] for r in df.select(C.xor_decrypt("v", "\x01")).collect()] == [None, None, None, None, None, ""]


def test_padding_is_read_leniently(spark):
    texts = ["QQ==QQ==", "QUI=x", "=QUI=", "!!!", "====", "Q=Q==", "QU=I=", "QUJD=", "QUJDQ", "Q U\nI = !", "QQ=", "QQ=x="]
    df = spark.createDataFrame([(v,) for v in texts], "v string")
    got = [r[0] for r in df.select(C.xor_decrypt("v", "k")).collect()]
    assert got == ["*", "*)", "*)", "", "", "*", "*)", "*)(", None, "*)", None, "*g"]


@settings(max_examples=15, deadline=None)
@given(st.lists(st.text(alphabet="QUJD=+ x!", max_size=14), min_size=20, max_size=60))
def test_lenient_reading_equals_pythons(spark, texts):
    df = spark.createDataFrame([(v,) for v in texts], "v string")
    got = [r[0] for r in df.select(F.try_to_binary(C.lenient_base64(F.col("v")), F.lit("base64"))).collect()]
    for t, g in zip(texts, got):
        try:
            want = base64.b64decode(t)
        except binascii.Error:
            want = None
        assert (None if g is None else bytes(g)) == want, t


@settings(max_examples=10, deadline=None)
@given(st.lists(st.text(max_size=12), min_size=1, max_size=5), st.text(min_size=1, max_size=6))
def test_roundtrip_property(spark, values, key):
    df = spark.createDataFrame([(v,) for v in values], "v string")
    out = df.select(C.xor_decrypt(C.xor_encrypt("v", key), key).alias("d"))
    assert [r.d for r in out.collect()] == values


def test_empty_key_rules(spark):
    df = spark.createDataFrame([("abc",)], "v string")
    r = df.select(C.xor_encrypt("v", ""), C.xor_decrypt("v", "")).first()
    assert r[0] is None and r[1] == "abc"


def test_profiles_encrypt_decrypt_lookup(spark):
    rows = [(1, "Ana", None, "2000-2-9", "Addr", "081"), (2, None, "Lee", None, None, None),
            (3, "X", "Y", "unknown", "A", "0"), (4, "Q", "R", "2001-02-30", "B", "1")]
    df = spark.createDataFrame(rows, "applicant_id int, first_name string, last_name string, "
                                     "date_of_birth string, address string, phone_number string")
    enc = obfuscate.encrypt_profiles(df, KEY)
    back = {r.applicant_id: r for r in P.profile_lookup(enc, KEY).collect()}
    assert str(back[1].date_of_birth) == "2000-02-09" and back[1].date_of_birth_raw is None
    assert back[2].date_of_birth is None and back[2].date_of_birth_raw is None  # None -> 'None' -> null
    assert back[3].date_of_birth is None and back[3].date_of_birth_raw == "unknown"
    assert back[4].date_of_birth is None and back[4].date_of_birth_raw == "2001-02-30"
    assert back[2].first_name is None and back[2].last_name == "Lee"
    audit = obfuscate.encryption_audit(df, KEY).first()
    assert (audit.rows_processed, audit.rows_failed) == (4, 0)


def test_audit_counts_failing_rows(spark, monkeypatch):
    df = spark.createDataFrame([(1, "Ana", "x", None, "A", "1"), (2, "bad", "y", None, "B", "2"), (3, None, None, None, None, None)],
                               "applicant_id int, first_name string, last_name string, date_of_birth string, "
                               "address string, phone_number string")
    real = C.xor_encrypt
    monkeypatch.setattr(obfuscate, "xor_encrypt", lambda c, key: F.when(F.col(c) != "bad", real(c, key))
                        if isinstance(c, str) and c == "first_name" else real(c, key))
    audit = obfuscate.encryption_audit(df, KEY).first()
    assert (audit.rows_processed, audit.rows_failed) == (2, 1)


def test_byte_steps_are_dealt_to_tasks(spark):
    """One split of a small file must not do the work of all rows."""
    df = spark.range(50).selectExpr("CAST(id % 7 AS int) applicant_id", "'A' first_name", "string(id) last_name",
                                    "'2000-02-09' date_of_birth", "'B' address", "'1' phone_number").coalesce(1)
    steps = [obfuscate.encrypt_profiles(df, KEY), obfuscate.encryption_audit(df, KEY), P.profile_lookup(df, KEY), P.decrypt_names(df, KEY)]
    for s in steps:
        assert "RepartitionByExpression" in s._jdf.queryExecution().optimizedPlan().toString()
    assert steps[0].count() == 50
