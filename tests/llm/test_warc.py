import hashlib
import random
import struct

import pytest
import zstandard

from dossier.llm.common import Scratch
from dossier.llm.warc import (DICT_FRAME, archive, parse, read_archives, read_warc, record, train_dictionary,
                              write_archives)


def rows_of(n=120):
    rng = random.Random(8)
    big = [f"<html><body>{'é<p>text ' * k}</body></html>" for k in (100, 300, 20_000)]
    small = ["", None, "<p>small</p>"]
    rows = [(i, f"http://h.example/{i}?q=ü x", rng.choice(big * 2 + small + [f"<html>{'own ' * 400}{i}</html>"]), "x", 3)
            for i in range(n)]
    return rows + [(n, None, big[0], "x", 3), (None, "u", big[1], "x", 3), (None, "u", "alone" * 900, "x", 3)]


SCHEMA = "page_id long, url string, html string, digest string, n int"


def test_round_trip(spark):
    rows = rows_of()
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    got = read_archives(spark, archive(df)).collect()
    last = {}
    for i, _, h, *_ in rows:
        if i is not None:
            last[h] = max(last.get(h, -1), i)
    assert len(got) == len(rows)
    want = []
    for i, _, h, *_ in rows:
        b = (h or "").encode()
        refers = last[h] if len(b) >= 1000 and last.get(h, i) != i else None
        want.append((i, len(b), hashlib.sha1(b).hexdigest(), "response" if refers is None else "revisit", refers))
    assert sorted(map(str, want)) == sorted(str((r["page_id"], r["payload_bytes"], r["payload_digest"],
                                                 r["record_type"], r["refers_to"])) for r in got)
    texts = {i: h for i, _, h, *_ in rows}
    for r in got:
        if r["record_type"] == "response" and r["page_id"] is not None:
            assert bytes(r["payload"]).decode() == (texts[r["page_id"]] or "")
    urls = {i: u for i, u, *_ in rows}
    assert all(r["url"] == (urls[r["page_id"]] or "about:blank") for r in got if r["page_id"] is not None)


def test_files_are_checked(spark):
    df = spark.createDataFrame(rows_of(60), SCHEMA)
    dictionary = train_dictionary(df)
    files = write_archives(df.coalesce(1), f"{Scratch(spark, 't').path}/a", dictionary, file_bytes=4000).collect()
    assert len(files) > 1 and sum(r["n_records"] for r in files) == 63
    path = files[0]["uri"].removeprefix("file://")
    data = open(path, "rb").read()
    assert struct.unpack("<II", data[:8]) == (DICT_FRAME, len(dictionary)) and len(list(read_warc(path, 7))) > 0
    flipped = bytearray(data)
    flipped[len(data) - 20] ^= 1
    for bad in (data[8:], data[:-3], bytes(flipped), data[:4] + b"\xff\xff\xff\x00" + data[8:], b"", data + b"junk"):
        with open(path + ".bad", "wb") as f:
            f.write(bad)
        with pytest.raises((ValueError, zstandard.ZstdError)):
            list(read_warc(path + ".bad"))


def test_records_are_checked():
    digest = hashlib.sha1(b"abc").hexdigest()
    good = record(5, "u", b"abc", digest, None)
    assert parse(good)[:6] == (5, "u", "response", None, 3, digest)
    assert parse(record(5, "u", b"abc", digest, 9))[:6] == (5, "u", "revisit", 9, 3, digest)
    for bad in (good[:-1], good + b"x", good.replace(b"abc", b"abd"), good.replace(b"WARC/1.1", b"WARC/9"),
                good.replace(b"WARC-Date: ", b"WARC Date "), good.replace(b"urn:page:5", b"urn:page:x")):
        with pytest.raises(ValueError):
            parse(bad)


def test_empty_table(spark):
    assert read_archives(spark, archive(spark.createDataFrame([], SCHEMA))).count() == 0
