import random

import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from dossier.llm.token_counts import count_tokens, counter, pieces, token_counts

FILES = ["byte_bpe_50k.json", "word_bpe_49k.json", "piece_bpe_32k.model"]
ODD = ["", " ", "a", " a b", "a  b\n\nc", "don't 'S we're.It's", "<|endoftext|> x<|endoftext|>y <s> </s>", "数字。字 ×. ²½. é́ x",
       "🙂 🙂🙂.", "▁a ▁ b", "a\x1c b\x85 c　d", "\r\n x\r\ny", "x . y ,z", "a" * 300, "字" * 200, "a\u0000b"]


def plain(name):
    path = public_tokenizers.path(name)
    if name.endswith(".model"):
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        return lambda t: len(model.encode(t))
    tokenizer = Tokenizer.from_file(path)
    return lambda t: len(tokenizer.encode(t, add_special_tokens=False).ids)


@pytest.mark.parametrize("name", FILES)
def test_pieces_add_up(name):
    rng, one, path = random.Random(1), plain(name), public_tokenizers.path(name)
    alphabet = list(" \n.a,") + ["the", "é", "'s", "!", "1", "  ", "x,", "\r\n", "ß", "́", "|", "字", "。", "▁", "×", "<|endoftext|>"]
    texts = ODD + ["".join(rng.choice(alphabet) for _ in range(rng.randrange(80))) for _ in range(2000)]
    want = [one(t) for t in texts]
    for long in (1, 7, 10_000):
        assert count_tokens(texts, path, long, batch_bytes=100).tolist() == want
    cut = counter(path)[1]
    assert (cut is None) == (name == "word_bpe_49k.json")
    assert max(map(len, pieces("word and word " * 1000, cut, 50))) <= (14_000 if cut is None else 60)


@pytest.mark.parametrize("name", FILES)
def test_table(spark, name):
    rows = [(k, t) for k, t in enumerate(ODD)] + [(None, None), (None, "x y"), (3, "x y"), (3, "x y"), (99, "ab cd. " * 60_000)]
    one = plain(name)
    docs = spark.createDataFrame([(i, t, "x", "y") for i, t in rows], "doc_id long, text string, n_tokens string, n_bytes string")
    got = token_counts(docs, public_tokenizers.path(name), limit=2)
    assert got.columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"]
    want = [(i, len((t or "").encode()), one(t or ""), one(t or "") > 2) for i, t in rows]
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, want))
    assert token_counts(docs.limit(0), public_tokenizers.path(name), 2).count() == 0


def test_real_texts(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    one = plain("byte_bpe_50k.json")
    got = {r["doc_id"]: r["n_tokens"] for r in token_counts(docs, public_tokenizers.path("byte_bpe_50k.json"), 1024).collect()}
    assert got == {r["doc_id"]: one(r["text"] or "") for r in docs.collect()}
