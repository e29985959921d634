import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from dossier.llm.packing import pack, pack_documents, steps
from dossier.llm.tokens import Encoder

ODD = ["", " ", "a", " a", "a ", "a  b", "a \n b", "x\n\ny", "it.\nWe're 12.5% don't 'S ", "É é ß ΑΣ Σ. İstanbul",
       "a b c\x1cd \x1c e", "<|endoftext|> x <|startoftext|>", "é ́x", "数 字 1²½.", "\t\n", "word,\n", "a b",
       "q.\n\nz !! DEL!! ...", "🙂 🙂🙂.", "x\ny\n z"]


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_ids_equal_the_tokenizers(name):
    path = public_tokenizers.path(name)
    plain, enc, rng = Tokenizer.from_file(path), Encoder(path, limit=50), random.Random(2)
    alphabet = list(" \n.a") + ["the", "é", "'s", "!", "1", "  ", "x,", "\r\n", "ß", "́", "|"]
    texts = ODD + ["".join(rng.choice(alphabet) for _ in range(rng.randrange(40))) for _ in range(3000)]
    want = [np.array(plain.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in texts]
    for t, w in zip(texts, want):
        assert enc.encode(t) == w, repr(t)
    assert list(Encoder(path, 1000).encode_all(texts)) == want


def test_pack_fills_every_window():
    rng = random.Random(3)
    for sizes in ([], [1], [4096], [5000, 3], [rng.randrange(1, 9000) for _ in range(300)], [1] * 300, [3000] * 20):
        seqs = pack(sizes)
        seen = {}
        for q in seqs:
            total = sum(n for _, _, n in q)
            assert total <= 4096 and total & (total - 1) == 0
            for d, s, n in q:
                assert n > 0
                seen.setdefault(d, []).append((s, n))
        for d, size in enumerate(sizes):
            at = 0
            for s, n in sorted(seen[d]):
                assert s == at
                at += n
            assert at == size
        assert len(seqs) - sum(sum(n for _, _, n in q) == 4096 for q in seqs) < 400
        per_step = {}
        for q, k in zip(seqs, steps(seqs)):
            per_step[k] = per_step.get(k, 0) + sum(n for _, _, n in q)
        assert all(v <= 65536 for v in per_step.values())


def test_pieces_hold_each_id_once(spark):
    path = public_tokenizers.path("word_bpe_49k.json")
    plain = Tokenizer.from_file(path)
    rng = random.Random(4)
    rows = [(i, " ".join(rng.choice(["alpha", "beta", "gamma."]) for _ in range(rng.choice([0, 3, 50, 6000]))), "s", 0, 1)
            for i in range(60)] + [(60, None, "s", 0, 1), (None, "x", "s", 0, 1), (3, "again", "s", 0, 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, start string, length int, step_id int")
    got = pack_documents(df.repartition(3, "doc_id"), path, 2, group_tokens=20_000).collect()
    ids = {}
    for i, t, *_ in rows:
        ids.setdefault(i, []).append(plain.encode(t or "", add_special_tokens=False).ids + [2])
    by_doc, by_seq = {}, {}
    for r in got:
        by_doc.setdefault((r["doc_id"], r["doc_tokens"]), []).append(r)
        by_seq.setdefault(r["sequence_id"], []).append(r)
    assert sum(r["length"] for r in got) == sum(len(x) for v in ids.values() for x in v)
    for (i, n), pieces in by_doc.items():
        [own] = [x for x in ids[i] if len(x) == n]
        at = 0
        for r in sorted(pieces, key=lambda r: r["start"]):
            assert r["start"] == at
            part = np.array(own[at:at + r["length"]], "<u4").tobytes()
            assert r["ids_crc32"] == zlib.crc32(part)
            at += r["length"]
        assert at == n
    for pieces in by_seq.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at == pieces[0]["sequence_tokens"] <= 4096
    assert pack_documents(df.limit(0), path, 2).count() == 0


@pytest.mark.parametrize("name,ids", [("byte_bpe_50k.json", [64, 220, 50256, 275]), ("word_bpe_49k.json", [320, 49407, 321])])
def test_added_tokens_as_the_library_has_them(name, ids):
    path, rng = public_tokenizers.path(name), random.Random(6)
    plain, enc = Tokenizer.from_file(path), Encoder(path, limit=50)
    assert np.frombuffer(enc.encode("a <|endoftext|> b"), "<u4").tolist() == ids
    parts = ["<|endoftext|>", "<|startoftext|>", "<|ENDOFTEXT|>", "<|", "|>", " ", "\n", "  ", "the", ".", "x,", "é"]
    texts = ODD + ["".join(rng.choice(parts) for _ in range(rng.randrange(20))) for _ in range(1500)]
    want = [np.array(plain.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in texts]
    for t, w in zip(texts, want):
        assert enc.encode(t) == w, repr(t)
    assert list(Encoder(path, 1000).encode_all(texts)) == want
