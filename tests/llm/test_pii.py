import hashlib
import random
import re

from pyspark.sql import functions as F

from dossier.llm.pii import KINDS, find_pii, luhn, mod97

SCHEMA = "doc_id long, text string, email string, digits int, spans string"
STATED = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
          "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def plain_luhn(d):
    total = 0
    for i, c in enumerate(reversed(d)):
        n = int(c) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def base(text):
    out = []
    for kind, p in STATED.items():
        for m in re.finditer(p, text or ""):
            d = re.sub("[^0-9]", "", m[0])
            ok = {"email": True, "ip": all(int(x) <= 255 for x in m[0].split(".")) if kind == "ip" else 0,
                  "card": 16 <= len(d) <= 19 and plain_luhn(d), "phone": 8 <= len(d) <= 15}[kind]
            if ok:
                out.append((kind, m.start(), m.end()))
    return out


def check(spark, texts):
    rows = [(i, t, "e", 1, "s") for i, t in enumerate(texts)]
    got = {r["doc_id"]: r for r in find_pii(spark.createDataFrame(rows, SCHEMA)).collect()}
    for i, t in enumerate(texts):
        want = base(t)
        told = [f"{k}:{a}:{b}" for k, a, b in want]
        own = [s for s in got[i]["spans"].split(",") if s.split(":")[0] in STATED]
        assert own == told, repr(t)
        assert got[i]["base_sha256"] == hashlib.sha256(",".join(told).encode()).hexdigest()
        for k in STATED:
            assert got[i][f"n_{k}"] == sum(x[0] == k for x in want)
    return got


def test_stated_cases(spark):
    texts = ["a@b.c_d@e.f", "a@b@c.d x@y z@w.com", "a@b.c.@d.e é@ü.de x@ñ a@b..c +1@x.y", "1.2.3.4.5.6.7.8 256.1.1.1 00000255.0.0.1",
             "4111 1111 1111 1111 4111-1111-1111-1112 4111111111111111 2", "+1 (212) 555-0100. +12 +1 ((( +123456789012345678 7",
             None, "", "🙂🙂 mail me: 🙂x@y.zz 🙂+49 30 1234567", "9" * 3000 + " " + "a." * 3000 + "@", "1 " * 2500 + "x",
             "@".join(["a.b"] * 900), "x@y.z " * 700 + "1.1.1.1 " * 700]
    check(spark, texts)


def test_random_texts(spark):
    rng = random.Random(13)
    alphabet = ["a", "b1", "@", ".", "-", " ", "+", "4", "11", "é", "(", ")", "\n", "_", "255", "🙂", "x@y.z", "4111111111111111"]
    check(spark, ["".join(rng.choice(alphabet) for _ in range(rng.randrange(60))) for _ in range(4000)])


def test_added_kinds(spark):
    good, bad = "GB82 WEST 1234 5698 7654 32", "GB82 WEST 1234 5698 7654 33"
    texts = [f"my IBAN {good}.", f"x {good.replace(' ', '')} y", f"IBAN {bad}", "SSN 123-45-6789", "see 123-45-6789",
             "SSN 000-45-6789 or 123-45-67890 or 1-123-45-6789 or 123-00-6789"]
    got = check(spark, texts)
    assert [got[i]["spans"] for i in range(6)] == ["iban:8:35", "iban:2:24", "", "ssn:4:15", "", ""]
    assert got[0]["scores"] == "1.0" and got[1]["scores"] == "0.7"


def test_checksums(spark):
    df = spark.createDataFrame([("4111111111111111", "DE89370400440532013000"), ("4111111111111112", "DE88370400440532013000")],
                               "c string, i string")
    assert [tuple(r) for r in df.select(luhn(F.col("c")), mod97(F.col("i")) == 1).collect()] == [(True, True), (False, False)]


def test_no_python_in_the_plan_and_empty(spark, capsys):
    df = find_pii(spark.createDataFrame([], SCHEMA))
    df.explain()
    assert not re.search("Python|Pandas|Arrow", capsys.readouterr().out)
    assert df.count() == 0 and list(KINDS)[:4] == list(STATED)
