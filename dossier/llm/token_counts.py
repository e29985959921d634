"""Token counts of whole texts with a public tokenizer file.

Texts are encoded in batches inside an Arrow function that gives back lengths
only. A batch holds about ``BATCH_BYTES`` whatever the lengths of its texts: a
text of more than ``LONG`` characters is cut at safe boundaries, places where the
tokenizer's own word splitting begins anew, so the pieces' counts add up to the
count of the whole text. A tokenizer for which no such places are known gets
whole texts.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import kept, ship

BATCH_BYTES = 1 << 18
LONG = 1 << 15  # characters
SPAN = 1 << 12  # texts looked at together

# Letters whose class every Unicode version agrees on.
_LETTER = "A-Za-zÀ-ÖØ-öø-ɏЀ-ҁҊ-ӿぁ-ゖァ-ヺ一-龥"
# A single blank or line end between two characters, or a letter before a mark.
BYTE_LEVEL = re.compile(rf"(?<=\S)(?=[ \n]\S)|(?<=[{_LETTER}])(?=[.,;:!?、。，；：！？])")
# A single blank between letters or digits, which the next piece's own blank replaces.
SPACED = re.compile(r"(?<=[^\W_]) (?=[^\W_])")


def _json_counter(path: str) -> tuple[Callable[[list[str]], list[int]], re.Pattern | None]:
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs the tasks in parallel
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    told = json.loads(Path(path).read_text(encoding="utf-8"))
    split = told["pre_tokenizer"] or {}
    plain = (split.get("type") == "ByteLevel" and split.get("use_regex", True) and not split.get("add_prefix_space")
             and not told["normalizer"])
    whole = any(t["lstrip"] or t["rstrip"] or t["single_word"] or BYTE_LEVEL.search(t["content"]) for t in told["added_tokens"])

    def count(texts: list[str]) -> list[int]:
        return [len(e) for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    return count, BYTE_LEVEL if plain and not whole else None


def _model_counter(path: str) -> tuple[Callable[[list[str]], list[int]], re.Pattern | None]:
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    within = any("▁" in model.id_to_piece(i).lstrip("▁") for i in range(model.get_piece_size()))
    own = model.encode("a b") == model.encode("a") + model.encode("b")  # a piece gets the blank that was cut off

    def count(texts: list[str]) -> list[int]:
        return [len(ids) for ids in model.encode(texts, num_threads=1)]

    return count, SPACED if own and not within else None


def counter(path: str) -> tuple[Callable[[list[str]], list[int]], re.Pattern | None]:
    """The worker's counting function for a file, and the places where it may be cut."""
    make = _model_counter if path.endswith(".model") else _json_counter
    return kept(("counter", path), lambda: make(path))


def pieces(text: str, cut: re.Pattern | None, long: int = LONG) -> list[str]:
    """The text in pieces of ``long`` characters or little more, cut at ``cut``."""
    out, at = [], 0
    while cut and len(text) - at > long:
        m = cut.search(text, at + long)
        if not m:
            break
        out.append(text[at:m.start()])
        at = m.end()
    return [*out, text[at:]]


def count_tokens(texts: list[str], path: str, long: int = LONG, batch_bytes: int = BATCH_BYTES) -> np.ndarray:
    """Number of tokens of each text."""
    count, cut = counter(path)
    totals = np.zeros(len(texts), np.int64)
    batch, owners, size = [], [], 0
    for k, text in enumerate(texts):
        for piece in pieces(text, cut, long) if len(text) > long else [text]:
            batch.append(piece)
            owners.append(k)
            size += len(piece) if piece.isascii() else len(piece.encode())
            if size >= batch_bytes:
                np.add.at(totals, owners, count(batch))
                batch, owners, size = [], [], 0
    if batch:
        np.add.at(totals, owners, count(batch))
    return totals


def n_tokens(path: str) -> Callable[[Column], Column]:
    """Column function: tokens of a text (null counts as empty)."""
    @F.arrow_udf("long")
    def counts(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            found = [count_tokens(["" if t is None else t for t in texts.slice(k, SPAN).to_pylist()], path)
                     for k in range(0, len(texts), SPAN)]
            yield pa.array(np.concatenate(found) if found else np.zeros(0, np.int64))
    return counts


def token_counts(docs: DataFrame, path: str, limit: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of ``docs``: its id, ``n_bytes`` (UTF-8), ``n_tokens`` without added
    special tokens, and whether they are more than ``limit``. Special strings in a
    text count as the library has them.

    Row by row, without a shuffle: repeated rows and null ids stay rows of their
    own, a null text has no bytes and no tokens, an empty table no rows. Other columns
    are not read. A long text is one task's work, in batches; a run of
    characters without any safe boundary is encoded at once."""
    ship(docs.sparkSession)
    text = F.coalesce(F.col(text_col), F.lit(""))
    counted = docs.select(F.col(id_col), F.octet_length(text).cast("long").alias("n_bytes"), n_tokens(path)(F.col(text_col)).alias("n_tokens"))
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
