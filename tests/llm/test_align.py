import hashlib
import random
from collections import Counter, defaultdict

import public_tokenizers
import sentencepiece
from tokenizers import Tokenizer

from dossier.llm.align import Aligner, align

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
ODD = ["", " ", "a", " a b", "a  b\n\nc", "don't 'S we're.It's", "<|endoftext|> x<|endoftext|>y <s> </s> <0x41> <unk>", "数字。字 ×. ²½. é́ x",
       "🙂 🙂🙂.𝒳𝒴 𝒳", "▁a ▁ b", "a\x1c b\x85 c　d", "\r\n x\r\ny", "\n", "\nx", "x\n", "x\ny\nz", "x .\ny ,z", "a" * 300, "字" * 200,
       "a\u0000b", "\t\tif x:\n\t\t\treturn\n", "ﬁ ½", "a b", "word"]


def byte_table():
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(rest)}


def whole(texts):
    """Each whole text's ids and byte ends, from decoded bytes alone."""
    a, b, table = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B), byte_table()
    a.encode_special_tokens = True
    for t in texts:
        if not t:
            yield None
            continue
        ia, ib = a.encode(" " + t, add_special_tokens=False).ids, b.encode(t)
        ba = [bytes(table[c] for c in a.id_to_token(i)) for i in ia]
        bb = [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in ib]
        if b"".join(ba) != (" " + t).encode() or b"".join(bb) != (" " + t).encode():
            yield None
            continue
        ends = lambda parts: [sum(map(len, parts[:k + 1])) for k in range(len(parts))] if len(parts) < 400 else _ends(parts)
        yield ia, ends(ba), ib, ends(bb)


def _ends(parts):
    out, pos = [], 0
    for p in parts:
        pos += len(p)
        out.append(pos)
    return out


def brute(rows):
    found, counts = list(whole(t for _, t in rows)), Counter()
    links = []
    for f in found:
        own = [(x, y) for x, e in zip(f[0], f[1]) for y, g in ((dict(zip(f[3], f[2])).get(e), e),) if y is not None] if f else []
        links.append(own)
        counts.update(own)
    top = defaultdict(int)
    for (x, y), n in counts.items():
        top[y] = max(top[y], n)
    out = []
    for (i, _), f, own in zip(rows, found, links):
        if not f:
            out.append((i, 0, 0, 0, 0, 0, 0, ""))
            continue
        common = sorted(set(f[1]) & set(f[3]))
        parts, lo = [], 0
        for e in common:
            sides = [",".join(str(x) for x, z in zip(ids, ends) if lo < z <= e) for ids, ends in ((f[0], f[1]), (f[2], f[3]))]
            parts.append("|".join(sides))
            lo = e
        out.append((i, len(f[0]), len(f[2]), len(common), len(own), sum(counts[p] == top[p[1]] for p in own), sum(counts[p] for p in own),
                    hashlib.sha256(";".join(parts).encode()).hexdigest()))
    return out, counts


def made(n):
    rng = random.Random(8)
    alphabet = list(" \n.a,") + ["the", "é", "'s", "!", "1", "  ", "x,", "\r\n", "ß", "́", "|", "字", "𝒳", "▁", "×", "<s>", "ing", " th"]
    return ["".join(rng.choices(alphabet, [4] * 5 + [2] * 13 + [.05] + [2] * 4, k=rng.randrange(50))) for _ in range(n)]


def test_ends_equal_decoded_bytes():
    one = Aligner(A, B)
    texts = [t for t in ODD + made(1500) if t]
    for t, want in zip(texts, whole(texts)):
        got = next(one.spans([" " + t]))
        assert (got and tuple(map(list, got))) == want, repr(t)
    # in chunks, with a small memory
    small = Aligner(A, B, limit=20)
    for t, want, found in zip(texts, whole(texts), small.align_all(texts)):
        assert (sum(f[0] for f in found), sum(f[1] for f in found)) == ((len(want[0]), len(want[2])) if want else (0, 0)), repr(t)


def test_table_against_brute_force(spark):
    rows = list(enumerate(ODD + made(300))) + [(None, "a b"), (None, None), (3, "same"), (3, "same"), (700, "long word, " * 3000)]
    docs = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, block string")
    want, counts = brute(rows)
    for links in (30, 1 << 20):
        got, pairs = align(docs, A, B, links=links)
        assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, want))
    assert {(r["a_id"], r["b_id"]): r["total"] for r in pairs.collect()} == counts
    text = align(docs.filter("doc_id = 14"), A, B, keep_groups=True)[0].first()["groups"]
    assert hashlib.sha256(text.encode()).hexdigest() == want[14][-1]
    assert align(docs.limit(0), A, B)[0].count() == 0


def test_real_texts(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").filter("n_chars < 3000")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    got = align(docs, A, B)[0].collect()
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, brute(rows)[0]))
