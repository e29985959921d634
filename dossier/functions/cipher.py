"""Repeating-key XOR over UTF-8 bytes, carried as base64 text.

This is obfuscation, not encryption: anyone with one plaintext/ciphertext
pair recovers the key. Use Spark's ``aes_encrypt``/``aes_decrypt`` where the
data must really be protected. The key is always a caller argument.

Both directions are one map-only stage: base64, UTF-8 and null rules are
native column expressions; the byte XOR itself is an Arrow-batched pandas UDF
(numpy over whole batches), since Spark has no binary XOR.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .text import col_

_B64_CHARS = r"[^A-Za-z0-9+/=]"


def _xor_batch(key: bytes):
    """Arrow-batched XOR of binary values with ``key`` repeated from each
    value's first byte: one numpy XOR over the batch's whole data buffer,
    positions taken from the Arrow offsets (no per-row Python)."""
    kb = np.frombuffer(key, dtype=np.uint8)

    def xor(s: pd.Series) -> pd.Series:
        a = pa.array(s, type=pa.binary())
        validity, offs, data = a.buffers()
        offsets = np.frombuffer(offs, dtype=np.int32)[: len(a) + 1]
        start, end = int(offsets[0]), int(offsets[-1])
        body = (np.frombuffer(data, dtype=np.uint8)[start:end].copy() if data is not None and end > start
                else np.zeros(0, dtype=np.uint8))
        pos = np.arange(end - start) - np.repeat(offsets[:-1] - start, np.diff(offsets))
        body ^= kb[pos % len(kb)]
        out = pa.Array.from_buffers(pa.binary(), len(a), [
            validity, pa.py_buffer((offsets - start).astype(np.int32)), pa.py_buffer(body)])
        return out.to_pandas()

    return xor


def _xor_bytes(data: Column, key: str) -> Column:
    """XOR the binary ``data`` with the UTF-8 bytes of ``key`` repeated.

    Spark has no binary XOR; composing it from hex digits and integer XOR in
    higher-order functions works but is interpreted per byte, so this one
    step is a vectorised (Arrow) pandas UDF. Base64 and UTF-8 handling stay
    in native Spark functions around it."""
    return F.pandas_udf(_xor_batch(key.encode("utf-8")), "binary")(data)


def dealt(profiles: DataFrame) -> DataFrame:
    """The rows on as many tasks as there are cores (or as their size asks for): the
    byte steps take far longer than reading, so a scan cuts them in too few splits.
    By all columns: an applicant_id may be missing or repeat."""
    return profiles.repartition(*profiles.columns)


def xor_encrypt(c, key: str | None) -> Column:
    """Null stays null, empty text stays empty, a missing/empty key gives
    null; otherwise ``base64(utf8(c) XOR key)``."""
    c = col_(c)
    if not key:
        return F.lit(None).cast("string")
    return (F.when(c.isNull(), F.lit(None).cast("string"))
             .when(c == "", F.lit(""))
             .otherwise(F.base64(_xor_bytes(F.encode(c, "UTF-8"), key))))


def lenient_base64(c: Column) -> Column:
    """The same data as strict base64, or null where there is none: characters
    outside the alphabet don't count, padding before its place doesn't either,
    and reading stops after complete padding -- as Python's decoder does. Strict
    base64 is left as it is after one test."""
    d = "[A-Za-z0-9+/]"
    strict = c.rlike(f"^(?:{d}{{4}})*+(?:{d}{{2}}==|{d}{{3}}=)?\\z")
    whole, two, three = f"((?:=*{d}=*{d}=?{d}{d})*+)", f"(=*{d}=*{d})==", f"(=*{d}=*{d}=?{d})="
    pattern = f"^{whole}(?:{two}|{three}|=*$)"
    cleaned = F.regexp_replace(c, _B64_CHARS, "")
    a, b, e = (F.replace(F.regexp_extract(cleaned, pattern, i), F.lit("="), F.lit("")) for i in (1, 2, 3))
    return F.when(strict, c).when(cleaned.rlike(pattern), F.concat(a, b, F.when(b != "", "==").otherwise(""),
                                                                   e, F.when(e != "", "=").otherwise("")))


def xor_decrypt(c, key: str | None) -> Column:
    """Empty input or empty key returns the input unchanged; text that is
    not base64 (read leniently) or whose decrypted bytes are not UTF-8 gives
    null."""
    c = col_(c)
    if not key:
        return c
    data = lenient_base64(c)
    plain = F.when(data == "", F.lit("")).otherwise(
        F.try_validate_utf8(_xor_bytes(F.try_to_binary(data, F.lit("base64")), key).cast("string")))
    return F.when(c.isNull() | (c == ""), c).otherwise(plain)


# Fixed value: text form of a missing date before obfuscation.
NONE_TEXT = "None"


def date_text(c) -> Column:
    """``str(date)``; a missing value becomes the text ``'None'``."""
    return F.coalesce(col_(c).cast("string"), F.lit(NONE_TEXT))


def parse_birth_date(c) -> tuple[Column, Column]:
    """``(date, raw)``. ``date`` parses ``%Y-%m-%d`` (one-digit month
    and day accepted); ``raw`` holds the text when it is present but not a
    date. Null, empty and ``'None'`` give two nulls."""
    c = col_(c)
    present = c.isNotNull() & (c != "") & (c != NONE_TEXT)
    d = F.when(present, F.try_to_date(c, "yyyy-M-d"))
    raw = F.when(present & d.isNull(), c)
    return d, raw


def _ship_by_value() -> None:
    """The XOR step runs on Python workers; pickle this module's functions
    by value so workers do not need this package on their path."""
    import sys
    try:
        from pyspark import cloudpickle
        cloudpickle.register_pickle_by_value(sys.modules[__name__])
    except Exception:  # noqa: BLE001
        pass


_ship_by_value()
