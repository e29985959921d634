"""One query per operator over its whole table, and SQL where it can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .align import align
from .common import Scratch, read
from .embed_dedup import embedding_dedup
from .exact_dedup import exact_dedup
from .langid import identify
from .minhash_dedup import near_dedup
from .mixing import mix
from .packing import pack_documents
from .pii import find_pii
from .prefix_trie import prefix_trie, shared_heads
from .suffix_dedup import suffix_dedup
from .token_counts import token_counts
from .token_files import read_documents, token_files
from .warc import archive, read_archives


def tokenizer(name: str) -> str:
    """Path of an installed public tokenizer file."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(read(spark, sf_dir, "documents"))


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup(read(spark, sf_dir, "documents")).drop("spans")


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(read(spark, sf_dir, "documents")).drop("copies")


def op4_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(read(spark, sf_dir, "documents"))


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(read(spark, sf_dir, "documents"), tokenizer("word_bpe_49k.json"), end_id=2)


def op6_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = token_files(read(spark, sf_dir, "documents"), tokenizer("byte_bpe_50k.json"), end_id=0)
    return read_documents(spark, files, digest=True)


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = archive(read(spark, sf_dir, "pages"))
    return read_archives(spark, files, payloads=False).drop("url")


def op8_embed_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup(read(spark, sf_dir, "embeddings"))


def op9_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup(read(spark, sf_dir, "documents"))


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_pii(read(spark, sf_dir, "documents"))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie(shared_heads(read(spark, sf_dir, "conversations"), Scratch(spark, "op11")))


def op12_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(read(spark, sf_dir, "documents"), tokenizer("byte_bpe_50k.json"), limit=1024)


def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, _ = align(read(spark, sf_dir, "documents"), tokenizer("byte_bpe_50k.json"), tokenizer("piece_bpe_32k.model"))
    return docs


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_exact_dedup": op1_exact_dedup,
    "op2_suffix_dedup": op2_suffix_dedup,
    "op3_mixing": op3_mixing,
    "op4_langid": op4_langid,
    "op5_packing": op5_packing,
    "op6_token_files": op6_token_files,
    "op7_warc": op7_warc,
    "op8_embed_dedup": op8_embed_dedup,
    "op9_minhash_dedup": op9_minhash_dedup,
    "op10_pii": op10_pii,
    "op11_prefix_trie": op11_prefix_trie,
    "op12_token_counts": op12_token_counts,
    "op13_alignment": op13_alignment,
}

# SQL of op10: pattern (RE2), what makes a match valid (m: the match, d: its
# digits, a and b: the texts beside it), base score and context words.
_DIGITS = "regexp_replace(m, '[^0-9]', '', 'g')"
_LUHN = ("list_sum(list_transform(range(1, length(d) + 1), lambda i: (CAST(substr(reverse(d), i, 1) AS INT) * "
         "(CASE WHEN i % 2 = 0 THEN 2 ELSE 1 END) - CASE WHEN i % 2 = 0 AND CAST(substr(reverse(d), i, 1) AS INT) > 4 "
         "THEN 9 ELSE 0 END))) % 10 = 0")
_MOD97 = ("list_reduce(list_transform(string_split(substr(n, 5) || substr(n, 1, 4), ''), lambda c: "
          "CASE WHEN c <= '9' THEN ascii(c) - 48 ELSE ascii(c) - 55 END), "
          "lambda x, y: (x * CASE WHEN y < 10 THEN 10 ELSE 100 END + y) % 97) = 1")
_PII = [
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+", "true", 0.8, "mail|contact|write to"),
    ("ip", r"[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+", "coalesce(list_bool_and(list_transform(string_split(m, '.'), "
     "lambda x: coalesce(TRY_CAST(x AS HUGEINT) <= 255, false))), false)", 0.6, "ip|address|host|server"),
    ("card", r"[0-9](?:[\x20-]?[0-9])+", f"CASE WHEN length(d) BETWEEN 16 AND 19 THEN {_LUHN} ELSE false END", 0.7,
     "card|credit|visa|mastercard|payment"),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", "length(d) BETWEEN 8 AND 15", 0.6, "phone|tel|call|mobile|fax"),
    ("iban", r"\b[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?\b",
     f"CASE WHEN length(n) BETWEEN 15 AND 34 THEN {_MOD97} ELSE false END", 0.7, "iban|account|bank|konto"),
    ("ssn", r"\b[0-9]{3}-[0-9]{2}-[0-9]{4}\b", "NOT regexp_matches(m, '^(000|666|9)|-00-|-0000$') "
     "AND right(a, 1) <> '-' AND left(b, 1) <> '-'", 0.4, "ssn|social security|social"),
]


def _pii_sql() -> str:
    kinds = [f"""
        SELECT {k} AS k, '{kind}' AS kind, doc_id, start, start + length(m) AS stop, round({score} + CASE WHEN regexp_matches(
                 lower(right(a, 40) || ' ' || left(b, 40)), '(^|[^a-z])({words})([^a-z]|$)') THEN 0.3 ELSE 0 END, 2) AS score
        FROM (SELECT *, {_DIGITS} AS d, replace(m, ' ', '') AS n FROM (
            SELECT doc_id, ms[i] AS m, gs[i] AS a, gs[i + 1] AS b,
                   CAST(length(array_to_string(gs[1:i], '')) + length(array_to_string(ms[1:i - 1], '')) AS BIGINT) AS start
            FROM (SELECT *, unnest(range(1, len(ms) + 1)) AS i FROM (
                SELECT doc_id, regexp_extract_all(t, '{pattern}') AS ms, string_split_regex(t, '{pattern}') AS gs FROM d))))
        WHERE {valid}""" for k, (kind, pattern, valid, score, words) in enumerate(_PII)]
    told, order = "kind || ':' || start || ':' || stop", "ORDER BY k, start"
    counts = ", ".join(f"count(*) FILTER (WHERE kind = '{kind}') AS n_{kind}" for kind, *_ in _PII[:4])
    return f"""
        WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
        spans AS ({" UNION ALL ".join(kinds)}),
        kept AS (SELECT * FROM spans WHERE k < 4 OR score >= 0.6)
        SELECT d.doc_id, {counts},
               sha256(coalesce(string_agg({told}, ',' {order}) FILTER (WHERE k < 4), '')) AS base_sha256,
               coalesce(string_agg({told}, ',' {order}), '') AS spans,
               coalesce(string_agg(CAST(score AS VARCHAR), ',' {order}), '') AS scores
        FROM d LEFT JOIN kept ON kept.doc_id = d.doc_id GROUP BY d.doc_id"""


ORACLE: dict[str, str] = {
    "op10_pii": _pii_sql(),
    "op1_exact_dedup": """
        WITH g AS (SELECT coalesce(text, '') AS t, max(doc_id) AS keep_id, count(*) AS group_size
                   FROM documents GROUP BY 1)
        SELECT d.doc_id, g.keep_id, g.group_size, d.doc_id = g.keep_id AS kept, sha256(g.t) AS text_sha256
        FROM documents d JOIN g ON coalesce(d.text, '') = g.t""",
    "op7_warc": """
        WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, ''))) AS n, sha1(coalesce(html, '')) AS digest
                   FROM pages),
        g AS (SELECT digest, n, max(page_id) AS first_id FROM p WHERE n >= 1000 GROUP BY 1, 2)
        SELECT page_id, p.n AS payload_bytes, p.digest AS payload_digest,
               CASE WHEN first_id <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN first_id <> page_id THEN first_id END AS refers_to
        FROM p LEFT JOIN g ON p.digest = g.digest AND p.n = g.n""",
    "op8_embed_dedup": """
        WITH RECURSIVE v AS (
            SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
            WHERE label IS NOT NULL AND len(embedding) > 0
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
              AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
        links AS (
            SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b
            ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
            WHERE list_cosine_similarity(a.e, b.e) >= 0.98),
        reach AS (
            SELECT vec_id, vec_id AS other FROM embeddings
            UNION SELECT reach.vec_id, links.b FROM reach JOIN links ON reach.other = links.a),
        n AS (SELECT a, count(*) AS n FROM links GROUP BY a)
        SELECT vec_id, CAST(coalesce(max(n.n), 0) AS BIGINT) AS n_links, min(other) AS component_id,
               vec_id = min(other) AS kept
        FROM reach LEFT JOIN n ON n.a = vec_id GROUP BY vec_id""",
    "op9_minhash_dedup": r"""
        WITH RECURSIVE w AS (
            SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                              'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents),
        s AS (
            SELECT DISTINCT doc_id, array_to_string(ws[i:i + 4], ' ') AS shingle
            FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 4, 1) + 1)) AS i FROM w WHERE len(ws) > 0)),
        n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
        common AS (
            SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b
            ON a.shingle = b.shingle AND a.doc_id <> b.doc_id GROUP BY 1, 2),
        links AS (
            SELECT a, b FROM common JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b
            WHERE 100 * c >= 85 * (x.n + y.n - c)),
        reach AS (
            SELECT doc_id, doc_id AS other FROM documents
            UNION SELECT reach.doc_id, links.b FROM reach JOIN links ON reach.other = links.a)
        SELECT reach.doc_id, coalesce(max(n.n), 0) AS n_shingles, min(other) AS component_id,
               reach.doc_id = min(other) AS kept
        FROM reach LEFT JOIN n ON n.doc_id = reach.doc_id GROUP BY reach.doc_id""",
    "op11_prefix_trie": r"""
        WITH t AS (
            SELECT conv_id, turn, coalesce(role, '') AS r, coalesce(text, '') AS x FROM conversations WHERE conv_id IS NOT NULL),
        own AS (
            SELECT conv_id, list({'r': r, 'x': x} ORDER BY turn NULLS FIRST, left(sha256(strlen(r) || ':' || r || x), 32)) AS ts
            FROM t GROUP BY conv_id),
        head AS (
            SELECT conv_id, ts, conv_id - conv_id % 20 AS base, xor(list_reduce(
                list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT)),
                lambda crc, c: list_reduce([0, 1, 2, 3, 4, 5, 6, 7], lambda y, i: CASE WHEN y & 1 = 1
                    THEN xor(y >> 1, 3988292384) ELSE y >> 1 END, xor(crc, c)), 4294967295), 4294967295) % 4 AS h
            FROM own),
        built AS (
            SELECT head.conv_id, list_concat(coalesce(own.ts[1:h], []), head.ts[h + 1:]) AS ts
            FROM head LEFT JOIN own ON own.conv_id = base),
        passed AS (SELECT conv_id, ts[1:d] AS path, d, len(ts) AS n FROM (
            SELECT *, unnest(range(0, len(ts) + 1)) AS d FROM built)),
        nodes AS (
            SELECT path, d, min(conv_id) AS conv_id, count(*) AS n_convs,
                   (count(*) - 1) * CASE WHEN d = 0 THEN 0 ELSE len(regexp_extract_all(path[d].x, '[^\x20\x09-\x0D]+')) END AS saved,
                   sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE n = d), '')) AS ends_sha256
            FROM passed GROUP BY path, d),
        kids AS (SELECT path[1:d - 1] AS path, count(*) AS n_children FROM nodes WHERE d > 0 GROUP BY 1),
        under AS (
            SELECT path[1:k] AS path, count(*) FILTER (WHERE n_children IS NULL) AS n_leaves, CAST(sum(saved) AS BIGINT) AS saved_tokens
            FROM (SELECT nodes.path, saved, n_children, unnest(range(0, d + 1)) AS k
                  FROM nodes LEFT JOIN kids ON kids.path = nodes.path) GROUP BY 1)
        SELECT nodes.conv_id, nodes.d AS depth, up.conv_id AS parent_conv_id, nodes.n_convs,
               coalesce(n_children, 0) AS n_children, n_leaves, saved_tokens, nodes.ends_sha256
        FROM nodes JOIN under ON under.path = nodes.path LEFT JOIN kids ON kids.path = nodes.path
        LEFT JOIN nodes up ON up.path = nodes.path[1:nodes.d - 1] AND up.d = nodes.d - 1""",
}
