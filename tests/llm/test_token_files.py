import random
import zlib

import numpy as np
import public_tokenizers
import pytest
import zstandard
from tokenizers import Tokenizer

from dossier.llm.token_files import FRAME_IDS, FrameReader, read_documents, token_files

PATH = public_tokenizers.path("byte_bpe_50k.json")


def test_round_trip(spark):
    rng, plain = random.Random(5), Tokenizer.from_file(PATH)
    rows = [(i * 3, " ".join(rng.choice(["one", "zwei", "três\n"]) for _ in range(rng.choice([0, 5, 700, 30_000]))), 1, "u")
            for i in range(40)] + [(7, None, 1, "u"), (None, "no id", 1, "u"), (9, "a", 1, "u"), (9, "a", 1, "u")]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "doc_id long, text string, start int, uri string")
    files = token_files(df, PATH, 0, file_ids=200_000)
    got = read_documents(spark, files).collect()
    want, at = [], 0
    for i, t, *_ in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "")):
        ids = plain.encode(t or "", add_special_tokens=False).ids + [0]
        want.append((i, at, len(ids), np.array(ids, "<u4").tobytes()))
        at += len(ids)
    assert sorted(tuple(r)[1:] for r in got) == sorted(w[1:] for w in want)
    assert sorted((r["doc_id"] or -1, r["start"]) for r in got) == sorted((w[0] or -1, w[1]) for w in want)
    crc = {(r["start"], r["ids_crc32"]) for r in read_documents(spark, files, digest=True).collect()}
    assert crc == {(w[1], zlib.crc32(w[3])) for w in want}
    some = read_documents(spark, files, [6, 9, 1000]).collect()
    assert sorted(r["doc_id"] for r in some) == sorted(w[0] for w in want if w[0] in (6, 9))
    assert len(files) > 1 and max(w[2] for w in want) < FRAME_IDS * 4

    path = files[0][0].removeprefix("file://")
    data = open(path, "rb").read()
    reader = FrameReader(files[0][0])
    assert len(zstandard.ZstdDecompressor().decompress(data[:int(reader.at[1])])) == reader.table[0, 1]
    for damaged in (data[:-1], data[:40] + bytes([data[40] ^ 1]) + data[41:], b""):
        with open(path + ".bad", "wb") as f:
            f.write(damaged)
        with pytest.raises((ValueError, zstandard.ZstdError)):
            list(FrameReader(path + ".bad").documents())


def test_empty_table(spark):
    assert token_files(spark.createDataFrame([], "doc_id long, text string"), PATH, 0) == []
    assert read_documents(spark, []).count() == 0
