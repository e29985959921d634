"""Language identification by rank-order profiles.

A language's profile is its ``profile_size`` most frequent 1- to 3-grams of
letters (words in lower case with a blank on either side; no n-gram runs over
a blank), counted over a bounded sample of its labelled texts. A document's own
most frequent n-grams are ranked the same way and compared with each profile
by out-of-place distance: the sum over the document's n-grams of the
difference of ranks, or ``profile_size`` where the profile lacks the n-gram.
The nearest language is predicted; the score is 1 minus the distance as a part
of the largest possible one.

The sample: of every language the ``sample_docs`` labelled documents with the
smallest hash of (id, text length), whole texts; rows that agree in id, language
and text length each take a place of the sample, but are learned once, with the
last of their texts in order: a repeated id brings no more. More than
``MOST_LANGS`` labelled languages are an error: their profiles (languages x
``profile_size`` n-grams) travel with the task. Every document is predicted from
its whole text, where it lies.

Defined cases: a null text or one without any letter is ``und`` with score 0,
and so is every text when nothing can be learned; equal distances go to the
first language by name; a null id is predicted, never learned from and not held
out; repeated rows are predicted one by one.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import Scratch, kept

PROFILE_SIZE = 400
SAMPLE_DOCS = 400
MOST_LANGS = 512
UNKNOWN = "und"
_NO_LETTERS = re.compile(r"[\W\d_]+")
_BITS = 21  # of a code point


def grams(text: str) -> tuple[np.ndarray, np.ndarray]:
    """The distinct n-grams of a text as integers, ascending, and their counts."""
    words = _NO_LETTERS.sub(" ", text.lower())
    if not words.strip() or not any(c.isalpha() for c in (words if len(words) < 64 else set(words))):
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    c = np.frombuffer(f" {words.strip()} ".encode("utf-32-le"), "<u4").astype(np.uint64)
    two = (c[:-1] << np.uint64(_BITS)) | c[1:]
    three = ((two[:-1] << np.uint64(_BITS)) | c[2:])[c[1:-1] != 32]
    every = np.concatenate([c[c != 32], two, three])
    every.sort()
    first = np.flatnonzero(np.concatenate([[True], every[1:] != every[:-1]]))
    return every[first], np.diff(np.append(first, len(every)))


def ranked(found: np.ndarray, counts: np.ndarray, size: int) -> np.ndarray:
    """The ``size`` most frequent n-grams, most frequent first."""
    return found[np.argsort(-counts, kind="stable")[:size]]


class Profiles:
    def __init__(self, profiles: dict[str, list[int]], size: int):
        self.size, self.langs, self.key = size, sorted(profiles), uuid.uuid4().hex
        self.known = np.unique(np.array([g for p in profiles.values() for g in p], np.uint64))
        self.rank = np.full((len(self.known) + 1, len(self.langs)), size, np.int32)
        for k, lang in enumerate(self.langs):
            own = np.array(profiles[lang], np.uint64)
            self.rank[np.searchsorted(self.known, own), k] = np.arange(len(own))

    def predict(self, text: str | None) -> tuple[str, float]:
        top = ranked(*grams(text or ""), self.size)
        if not len(top) or not self.langs:
            return UNKNOWN, 0.0
        at = np.searchsorted(self.known, top)
        at[(at == len(self.known)) | (self.known[np.minimum(at, len(self.known) - 1)] != top)] = len(self.known)
        rank = self.rank[at]
        away = np.where(rank == self.size, self.size, np.abs(rank - np.arange(len(top), dtype=np.int32)[:, None]))
        total = away.sum(axis=0)
        best = int(total.argmin())
        return self.langs[best], 1.0 - float(total[best]) / (len(top) * self.size)


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def learn(docs: DataFrame, profile_size: int = PROFILE_SIZE, sample_docs: int = SAMPLE_DOCS) -> Profiles:
    """Profiles from ``(doc_id, text, lang)``; held-out documents and null
    languages are not read."""
    scratch = Scratch(docs.sparkSession, "language")
    h = F.xxhash64("doc_id", F.char_length("text"))
    own = docs.filter(F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & F.col("text").isNotNull()
                      & ~held_out(F.col("doc_id"))).select("doc_id", "lang", "text", h.alias("hash"))
    keys = ["doc_id", "lang", "hash"]
    picked = own.select(*keys, F.pmod(F.hash("hash"), F.lit(256)).alias("part"))
    for by in (["lang", "part"], ["lang"]):  # a frequent language is cut down in parts first
        order = Window.partitionBy(*by).orderBy("hash", "doc_id")
        picked = picked.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= sample_docs)
    picked = scratch.save(picked.select(keys).distinct(), "picked")  # a table, so its size is known to the join
    langs = picked.select("lang").distinct().count()
    if langs > MOST_LANGS:
        raise ValueError(f"{langs} languages are labelled; profiles of at most {MOST_LANGS} fit a task")
    sample = own.join(picked, keys, "left_semi").groupBy(keys).agg(F.max("text").alias("text")).select("lang", "text")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lang, text in zip(*(c.to_pylist() for c in batch.columns)):
                found, n = grams(text)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(found), pa.string()), pa.array(found.astype(np.int64)), pa.array(n)],
                    names=["lang", "gram", "n"])

    counts = sample.mapInArrow(count, "lang string, gram long, n long").groupBy("lang", "gram") \
                   .agg(F.sum("n").alias("n"))
    top = Window.partitionBy("lang").orderBy(F.desc("n"), "gram")
    rows = counts.withColumn("rank", F.row_number().over(top)).filter(F.col("rank") <= profile_size) \
                 .orderBy("lang", "rank").collect()
    profiles: dict[str, list[int]] = {}
    for r in rows:
        profiles.setdefault(r["lang"], []).append(r["gram"])
    return Profiles(profiles, profile_size)


def predictions(docs: DataFrame, profiles: Profiles) -> DataFrame:
    """``doc_id, lang_pred, score`` from ``(doc_id, text)``, one row per row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = kept(("language", profiles.key), lambda: profiles)
        for batch in batches:
            found = [own.predict(t.as_py()) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([x for x, _ in found], pa.string()),
                 pa.array([y for _, y in found], pa.float64())], names=["doc_id", "lang_pred", "score"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")) \
               .mapInArrow(run, "doc_id long, lang_pred string, score double")


def language(profiles: Profiles):
    """A column function: text -> struct ``(lang_pred, score)``."""

    def run(texts: pd.Series) -> pd.DataFrame:
        own = kept(("language", profiles.key), lambda: profiles)
        return pd.DataFrame([own.predict(t) for t in texts], columns=["lang_pred", "score"])

    return F.pandas_udf(run, "lang_pred string, score double")


def has_letter():
    """A column function: whether a text has any letter, as ``predict`` sees it."""
    return F.pandas_udf(lambda texts: texts.map(lambda t: any(c.isalpha() for c in t or "")).astype(bool), "boolean")


def identify(docs: DataFrame, profile_size: int = PROFILE_SIZE, sample_docs: int = SAMPLE_DOCS) -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` for every row of ``docs``."""
    found = predictions(docs, learn(docs, profile_size, sample_docs))
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
