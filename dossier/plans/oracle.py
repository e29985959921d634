"""Reference SQL (DuckDB dialect) for every registered query.

Stated apart from the Spark code, in set/window style, with its own heading
table, keyword lists, limits and counts: lines are unnested with their index,
sections come from running ``max`` over heading positions, entries from
``lead`` and running sums, and occurrences from comparing the text at every
position. Only the stand-in inputs are shared. DuckDB's regex engine (RE2) has
ASCII-only ``\\s``, so whitespace is an explicit class; its ``levenshtein``
counts bytes, so for the ASCII keywords used here every non-ASCII character of
a word is first mapped to one control character, which leaves code-point
distances unchanged.
"""

from __future__ import annotations

import re
from itertools import product

from ..sources.fixtures import APPLICATIONS_SQL, CV_DOCUMENTS_SQL, MANIFEST_SQL, PROFILES_SQL

# Headings in test order. The stripped line is one of the first
# phrases, with or without a colon after it, or it starts with one of the
# second and under 20 characters follow. [x] may be left out.
HEADINGS = [
    ("Summary", ["summary", "objective", "profile", "about me", "ringkasan [pribadi]"], []),
    ("Experience", ["pengalaman [kerja]"], ["[professional] experience[s]", "work history"]),
    ("Education", ["education", "education and training", "education & training", "academic background",
                   "academic qualifications", "training", "pendidikan", "kualifikasi [akademik]"], []),
    ("Skills", ["keahlian"], ["[technical] skills", "competencies", "proficiencies", "kemampuan"]),
    ("Projects", ["projects", "proyek"], []),
    ("Awards", ["awards", "honors", "penghargaan"], []),
    ("Certifications", ["certifications", "certificates", "sertifikasi"], []),
    ("Accomplishments", ["accomplishments", "achievements", "prestasi"], []),
    ("Languages", ["languages", "bahasa"], []),
    ("Interests", ["interests", "minat"], []),
    ("Personal Information", ["personal information", "informasi pribadi"], []),
    ("Additional Information", ["additional information", "informasi tambahan", "lain-lain"], []),
]
TAIL = 20

# The queries' parameters, parsed by hand.
RAW_KEYWORDS = ["license", "lisense", "thing", "reserved", "nation", "machine", "the and", "tionre", "intelligence"]
SEARCH_KEYWORDS = ["license", "lisense", "thing", "reserved", "nation", "the and", "experienec", "tionre"]
SYLLABLES = ["".join(x) for n in (2, 3) for x in product("aeinrst", repeat=n)]
MANY_WORDS = [a + b for a in ("licens", "report", "analyst", "financ", "python", "account", "manag", "engineer")
              for b in ("", "e", "s", "ed", "er", "ing")]
REPORT_KEYWORDS = ["license", "thing", "tionre", "pyton"]
KEY = "dossier-demo-key-é"

# Python's whitespace set as an RE2 class.
WS = r"[\t\n\x0b\x0c\r\x1c-\x1f \x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
LB = r"\r\n|[\n\x0b\x0c\r\x1c-\x1e\x{85}\x{2028}\x{2029}]"


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def strip(x: str) -> str:
    return f"regexp_replace({x}, {q('^' + WS + '+|' + WS + '+$')}, '', 'g')"


def words(x: str) -> str:
    return f"list_filter(string_split_regex({x}, {q(WS + '+')}), lambda w: w <> '')"


def capitalize(x: str) -> str:
    return f"(upper(substr({x}, 1, 1)) || lower(substr({x}, 2)))"


def phrase(p: str) -> str:
    """RE2 for a phrase of ``HEADINGS`` (``~``: a blank)."""
    p = p.replace("-", "\\-").replace(" & ", "~*&~*").replace("[s]", "(s)?")
    p = re.sub(r"^\[(\w+)\] ", r"(\1~+)?", p)
    p = re.sub(r" \[(\w+)\]$", r"(~*\1)?", p)
    return p.replace(" ", "~+").replace("~", WS)


def heading_case(s: str) -> str:
    parts = []
    for name, whole, prefix in HEADINGS:
        rx = "(?i)^(" + "|".join(phrase(p) for p in whole) + f"){WS}*:?{WS}*$"
        parts.append(f"WHEN regexp_matches({s}, {q(rx)}) THEN {q(name)}")
        if prefix:
            m = f"regexp_extract({s}, {q('(?i)^(' + '|'.join(phrase(p) for p in prefix) + ')')}, 0)"
            parts.append(f"WHEN length({m}) > 0 AND length({strip(f'substr({s}, length({m}) + 1)')}) < {TAIL} THEN {q(name)}")
    return "CASE " + " ".join(parts) + " END"


def keywords_values(kws: list[str]) -> str:
    rows = ", ".join(f"({i + 1}, {q(k)})" for i, k in enumerate(kws))
    return f"""kw0(kw_pos, keyword) AS (VALUES {rows}),
kw AS (SELECT *, least(CAST(ceil(0.15 * length(keyword)) AS INTEGER), 3) AS bound FROM kw0)"""


def occurrences(source: str, text: str, kws: list[str]) -> str:
    """CTE ``occ(doc_id, kw_pos, n)``: places of ``source`` where a keyword stands."""
    each = " UNION ALL ".join(
        f"SELECT doc_id, substr({text}, i, {n}) AS part FROM (SELECT doc_id, {text}, "
        f"unnest(range(1, greatest(length({text}) - {n} + 2, 1))) AS i FROM {source})"
        for n in sorted({len(k) for k in kws}))
    return f"""
places AS ({each}),
occ AS MATERIALIZED (
  SELECT doc_id, kw_pos, CAST(count(*) AS INTEGER) AS n FROM places JOIN kw ON part = keyword GROUP BY doc_id, kw_pos)
"""


CV = f"cv_documents AS ({CV_DOCUMENTS_SQL})"
APPS = f"applications AS ({APPLICATIONS_SQL})"
PROFILES = f"profiles AS ({PROFILES_SQL})"
MANIFEST = f"manifest AS ({MANIFEST_SQL})"

LINES = f"""
lines0 AS (
  SELECT doc_id, cv_path, string_split_regex(cv_text, {q(LB)}) AS ls
  FROM cv_documents WHERE cv_text IS NOT NULL AND length(cv_text) > 0),
lines AS (
  SELECT doc_id, cv_path, unnest(ls) AS line, generate_subscripts(ls, 1) - 1 AS pos FROM lines0),
tagged AS (
  SELECT doc_id, cv_path, pos, line, {heading_case(strip('line'))} AS heading FROM lines),
owned AS (
  SELECT *, max(CASE WHEN heading IS NOT NULL THEN pos END)
            OVER (PARTITION BY doc_id ORDER BY pos ROWS UNBOUNDED PRECEDING) AS owner
  FROM tagged),
raw_sections AS (
  SELECT doc_id, cv_path, owner AS pos,
         max(CASE WHEN pos = owner THEN heading END) AS section,
         {strip("coalesce(string_agg(CASE WHEN pos > owner THEN line END, chr(10) ORDER BY pos), '')")} AS content
  FROM owned WHERE owner IS NOT NULL GROUP BY doc_id, cv_path, owner),
sections AS MATERIALIZED (
  SELECT doc_id, cv_path, section, min(pos) AS first_pos, arg_max(content, pos) AS content
  FROM raw_sections GROUP BY doc_id, cv_path, section),
flat AS MATERIALIZED (
  SELECT doc_id, cv_path,
         lower(string_agg(lower(section) || ' ' || lower(replace(replace(content, chr(10), ' '), '•', '')),
                          ' ' ORDER BY first_pos)) AS flat_text
  FROM sections GROUP BY doc_id, cv_path)
"""


def hits_ctes(kws: list[str]) -> str:
    """exact-then-fuzzy hits over ``flat``."""
    return f"""
{keywords_values(kws)},
{occurrences('flat', 'flat_text', kws)},
tokens AS MATERIALIZED (
  SELECT doc_id, word, count(*) AS times, regexp_replace(lower(word), '[^\\x00-\\x7f]', chr(1), 'g') AS low
  FROM (SELECT doc_id, unnest({words('flat_text')}) AS word FROM flat) GROUP BY doc_id, word),
near AS MATERIALIZED (
  SELECT low, kw_pos FROM (SELECT DISTINCT low FROM tokens)
  JOIN kw ON length(low) BETWEEN length(keyword) - bound AND length(keyword) + bound
  WHERE levenshtein(low, keyword) <= bound),
fuzzy AS (
  SELECT t.doc_id, near.kw_pos, sum(t.times) AS n, array_to_string(list_sort(list(t.word)), ', ') AS words
  FROM tokens t JOIN near ON near.low = t.low
  ANTI JOIN occ ON occ.doc_id = t.doc_id AND occ.kw_pos = near.kw_pos
  GROUP BY t.doc_id, near.kw_pos),
found AS (
  SELECT doc_id, kw_pos, 'exact' AS kind, n, NULL AS words FROM occ
  UNION ALL SELECT doc_id, kw_pos, 'fuzzy', n, words FROM fuzzy),
hits AS (
  SELECT f.doc_id, f.cv_path, kw.kw_pos, kw.keyword, kind, CAST(found.n AS INTEGER) AS n, found.words
  FROM found JOIN flat f ON f.doc_id = found.doc_id JOIN kw ON kw.kw_pos = found.kw_pos),
details AS (
  SELECT *, {capitalize('keyword')} || CASE WHEN kind = 'fuzzy' THEN ' (fuzzy)' ELSE '' END || ': '
            || CAST(n AS VARCHAR) || ' occurrence' || CASE WHEN n > 1 THEN 's' ELSE '' END
            || CASE WHEN kind = 'fuzzy' AND words IS NOT NULL THEN ' (kata cocok: ' || words || ')' ELSE '' END
            AS detail
  FROM hits),
scores AS MATERIALIZED (
  SELECT doc_id, cv_path, CAST(sum(n) AS INTEGER) AS total_matches,
         CASE WHEN bool_or(kind = 'exact') THEN 1 ELSE 2 END AS match_priority,
         string_agg(detail, ' | ' ORDER BY kw_pos) AS matched_keywords
  FROM details GROUP BY doc_id, cv_path HAVING sum(n) > 0)
"""


def raw_counts_ctes(kws: list[str]) -> str:
    return f"""
{keywords_values(kws)},
raw AS (SELECT doc_id, lower(text) AS text FROM documents)
"""


def block_lines(section: str, p: str = "b") -> str:
    """Lines of a section block (stripped, split on newline) with E5 flags,
    grouped into entries; CTE names start with ``p``."""
    bullet = "(starts_with({x}, '-') OR starts_with({x}, '*') OR starts_with({x}, '•') " \
             "OR starts_with({x}, '#') OR starts_with({x}, 'o '))"
    s, ns = strip("line"), strip("nxt")
    year = "'\\b\\d{4}\\b'"
    return f"""
{p}blocks AS (
  SELECT doc_id, string_split({strip('content')}, chr(10)) AS ls FROM sections
  WHERE section = {q(section)} AND {strip('content')} <> '' AND position('not found' IN lower(content)) = 0),
{p}lines AS (
  SELECT doc_id, unnest(ls) AS line, generate_subscripts(ls, 1) AS idx FROM {p}blocks),
{p}next AS (
  SELECT *, lead(line) OVER (PARTITION BY doc_id ORDER BY idx) AS nxt FROM {p}lines),
{p}flag AS (
  SELECT doc_id, idx, line,
    ({s} <> '' AND NOT {bullet.format(x=s)} AND (
       regexp_matches({s}, {year})
       OR (nxt IS NOT NULL AND regexp_matches({ns}, {year}) AND NOT {bullet.format(x=ns)}
           AND len({words(s)}) < 7))) AS start
  FROM {p}next),
{p}kept AS (
  SELECT *, sum(CASE WHEN start THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY idx
                                                         ROWS UNBOUNDED PRECEDING) AS grp
  FROM {p}flag WHERE {s} <> ''),
{p}kept2 AS (
  SELECT *, min(idx) OVER (PARTITION BY doc_id, grp) AS first_idx FROM {p}kept),
{p}ent AS (
  SELECT doc_id, grp, {strip('arg_min(line, idx)')} AS head,
         {strip("coalesce(string_agg(CASE WHEN idx > first_idx THEN line END, chr(10) ORDER BY idx), '')")} AS details
  FROM {p}kept2 GROUP BY doc_id, grp)
"""


def entries_sql(section: str, head_name: str) -> str:
    return f"""WITH {CV}, {LINES}, {block_lines(section)}
SELECT doc_id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY grp) AS INTEGER) AS entry_no,
       head AS {head_name}, details FROM bent"""


def skills_ctes() -> str:
    return f"""
sblocks AS (
  SELECT doc_id, content FROM sections
  WHERE section = 'Skills' AND {strip('content')} <> '' AND position('not found' IN lower(content)) = 0),
snorm AS (
  SELECT doc_id, regexp_replace(regexp_replace(content, {q('(?m)^' + WS + '*[-*•–✔]' + WS + '+')}, '', 'g'),
                                {q(WS + '*;' + WS + '*')}, ',', 'g') AS t FROM sblocks),
slines AS (SELECT doc_id, {strip(f"unnest(string_split_regex(t, {q(LB)}))")} AS l FROM snorm),
sparts AS (
  SELECT doc_id, CASE WHEN regexp_matches(l, {q(':' + WS + '+')})
                      THEN regexp_replace(l, {q('^.*?:' + WS + '+')}, '') ELSE l END AS p
  FROM slines WHERE l <> ''),
sitems AS (
  SELECT doc_id, regexp_replace({strip(f"unnest(string_split_regex(p, {q(',' + WS + '*')}))")}, '\\.+$', '') AS s
  FROM sparts),
skill_set AS (
  SELECT DISTINCT doc_id, s FROM sitems
  WHERE length(s) > 1 AND NOT (position(':' IN s) > 0 AND len({words('s')}) < 4)),
skill_lists AS (
  SELECT doc_id, CAST(count(*) AS INTEGER) AS n_skills,
         string_agg(s, ' | ' ORDER BY lower(s), s) AS skills
  FROM skill_set GROUP BY doc_id)
"""


def xor_encrypt_sql(x: str, key: str) -> str:
    """base64 of UTF-8 bytes XOR repeated key bytes (DuckDB: via hex)."""
    kb = list(key.encode("utf-8"))
    karr = "[" + ", ".join(str(b) for b in kb) + "]"
    h = f"hex(encode({x}))"
    body = (f"unhex(array_to_string(list_transform(range(0, CAST(length({h}) / 2 AS BIGINT)), "
            f"lambda i: lpad(hex(xor(CAST(('0x' || substr({h}, CAST(i * 2 + 1 AS BIGINT), 2)) AS INTEGER), "
            f"{karr}[(i % {len(kb)}) + 1])), 2, '0')), ''))")
    return (f"CASE WHEN {x} IS NULL THEN NULL WHEN {x} = '' THEN '' "
            f"ELSE to_base64({body}) END")


def xor_decrypt_sql(x: str, key: str) -> str:
    kb = list(key.encode("utf-8"))
    karr = "[" + ", ".join(str(b) for b in kb) + "]"
    h = f"hex(from_base64({x}))"
    plain = (f"decode(unhex(array_to_string(list_transform(range(0, CAST(length({h}) / 2 AS BIGINT)), "
             f"lambda i: lpad(hex(xor(CAST(('0x' || substr({h}, CAST(i * 2 + 1 AS BIGINT), 2)) AS INTEGER), "
             f"{karr}[(i % {len(kb)}) + 1])), 2, '0')), '')))")
    return f"CASE WHEN {x} IS NULL OR {x} = '' THEN {x} ELSE {plain} END"


def oracle_sql() -> dict[str, str]:
    raw_kws, search_kws, key = RAW_KEYWORDS, SEARCH_KEYWORDS, KEY
    out: dict[str, str] = {}

    out["application_profiles"] = f"""WITH {APPS}, {PROFILES}
SELECT a.detail_id, a.applicant_id, a.application_role, a.cv_path, p.first_name, p.last_name,
       concat_ws(' ', p.first_name, p.last_name) AS name
FROM applications a JOIN profiles p ON a.applicant_id = p.applicant_id"""

    out["existing_applications"] = f"""WITH {APPS}, {PROFILES}, {CV}
SELECT a.detail_id, a.applicant_id, a.application_role, a.cv_path, p.first_name, p.last_name,
       concat_ws(' ', p.first_name, p.last_name) AS name
FROM applications a JOIN profiles p ON a.applicant_id = p.applicant_id
WHERE a.cv_path IS NOT NULL AND a.cv_path <> ''
  AND EXISTS (SELECT 1 FROM cv_documents d WHERE d.cv_path = a.cv_path)"""

    lookup_cols = """applicant_id, first_name, last_name,
  CAST(dob AS VARCHAR) AS date_of_birth,
  CASE WHEN dob IS NULL AND date_of_birth IS NOT NULL AND date_of_birth NOT IN ('', 'None') THEN date_of_birth END
    AS date_of_birth_raw,
  address, phone_number"""
    parse_dob = ("CASE WHEN date_of_birth IS NULL OR date_of_birth IN ('', 'None') THEN NULL "
                 "ELSE try_strptime(date_of_birth, '%Y-%m-%d')::DATE END AS dob")
    out["profile_lookup"] = f"""WITH {PROFILES}, p2 AS (SELECT *, {parse_dob} FROM profiles)
SELECT {lookup_cols} FROM p2"""
    out["profile_by_id"] = out["profile_lookup"] + " WHERE applicant_id = 7"

    out["parse_keywords"] = f"""WITH items AS (
  SELECT conv_id, turn, lower({strip('item')}) AS keyword, idx FROM (
    SELECT conv_id, turn, unnest(string_split(text, ',')) AS item,
           generate_subscripts(string_split(text, ','), 1) AS idx FROM conversations)),
firsts AS (SELECT conv_id, turn, keyword, min(idx) AS idx FROM items WHERE keyword <> ''
           GROUP BY conv_id, turn, keyword)
SELECT conv_id, turn, CAST(row_number() OVER (PARTITION BY conv_id, turn ORDER BY idx) AS INTEGER) AS kw_pos,
       keyword FROM firsts"""

    for name, kws in (("keyword_counts", raw_kws), ("keyword_counts_many", SYLLABLES)):
        out[name] = f"""WITH {raw_counts_ctes(kws)}, {occurrences('raw', 'text', kws)}
SELECT doc_id, kw_pos, keyword, n FROM occ JOIN kw USING (kw_pos)"""

    out["edit_distance"] = f"""WITH {PROFILES}
SELECT applicant_id, first_name, last_name, CAST(levenshtein(first_name, last_name) AS INTEGER) AS distance,
       CAST(CASE WHEN levenshtein(first_name, last_name) <= 9 THEN levenshtein(first_name, last_name) ELSE -1 END
            AS INTEGER) AS distance_within_9
FROM profiles"""

    out["fuzzy_hits"] = f"""WITH {raw_counts_ctes(raw_kws)},
tokens AS (SELECT r.doc_id, kw.kw_pos, kw.keyword, kw.bound, unnest({words('r.text')}) AS word FROM raw r, kw)
SELECT doc_id, kw_pos, keyword, CAST(count(*) AS INTEGER) AS n,
       array_to_string(list_sort(list_distinct(list(word))), ', ') AS words
FROM tokens
WHERE levenshtein(regexp_replace(lower(word), '[^\\x00-\\x7f]', chr(1), 'g'), keyword) <= bound
GROUP BY doc_id, kw_pos, keyword"""

    asked = """
raw AS (SELECT doc_id, lower(text) AS text FROM documents),
kw AS (SELECT DISTINCT lower(regexp_extract(text, '[A-Za-z]{4,9}')) AS keyword FROM conversations
       WHERE regexp_extract(text, '[A-Za-z]{4,9}') <> '')"""
    each = " UNION ALL ".join(
        f"SELECT doc_id, substr(text, i, {n}) AS part FROM (SELECT doc_id, text, "
        f"unnest(range(1, greatest(length(text) - {n} + 2, 1))) AS i FROM raw)" for n in range(4, 10))
    out["keyword_table_counts"] = f"""WITH {asked}
SELECT doc_id, keyword, CAST(count(*) AS INTEGER) AS n FROM ({each}) JOIN kw ON part = keyword GROUP BY doc_id, keyword"""
    out["keyword_table_near"] = f"""WITH {asked},
tokens AS MATERIALIZED (
  SELECT doc_id, word, count(*) AS times, regexp_replace(word, '[^\\x00-\\x7f]', chr(1), 'g') AS low
  FROM (SELECT doc_id, unnest({words('text')}) AS word FROM raw) GROUP BY doc_id, word),
near AS (
  SELECT low, keyword FROM (SELECT DISTINCT low FROM tokens)
  JOIN kw ON abs(length(low) - length(keyword)) <= least(CAST(ceil(0.15 * length(keyword)) AS INTEGER), 3)
  WHERE levenshtein(low, keyword) <= least(CAST(ceil(0.15 * length(keyword)) AS INTEGER), 3))
SELECT doc_id, keyword, CAST(sum(times) AS INTEGER) AS n, array_to_string(list_sort(list(word)), ', ') AS words
FROM tokens JOIN near ON near.low = tokens.low GROUP BY doc_id, keyword"""
    hits = hits_ctes(search_kws)
    out["keyword_hits"] = f"""WITH {CV}, {LINES}, {hits}
SELECT doc_id, kw_pos, keyword, kind, n, words FROM hits"""
    out["keyword_hits_many"] = f"""WITH {CV}, {LINES}, {hits_ctes(MANY_WORDS)}
SELECT doc_id, kw_pos, keyword, kind, n, words FROM hits"""
    out["document_scores"] = f"""WITH {CV}, {LINES}, {hits}
SELECT doc_id, cv_path, total_matches, match_priority FROM scores"""
    out["match_details"] = f"""WITH {CV}, {LINES}, {hits}
SELECT doc_id, cv_path, total_matches, match_priority,
       CAST(total_matches AS VARCHAR) || ' ' || CASE WHEN total_matches <> 1 THEN 'matches' ELSE 'match' END || ' '
       || CASE WHEN match_priority = 1 THEN '(Exact)' ELSE '(Fuzzy Only)' END AS match_label,
       matched_keywords FROM scores"""
    out["top_matches"] = f"""WITH {CV}, {APPS}, {PROFILES}, {LINES}, {hits}
SELECT a.applicant_id, concat_ws(' ', p.first_name, p.last_name) AS name, s.total_matches,
       s.matched_keywords, a.cv_path, s.match_priority, a.detail_id
FROM applications a JOIN scores s ON a.cv_path = s.cv_path JOIN profiles p ON a.applicant_id = p.applicant_id
WHERE a.cv_path <> ''
ORDER BY s.match_priority, s.total_matches DESC, a.applicant_id, a.cv_path, a.detail_id
LIMIT 20"""
    out["search_encrypted"] = out["top_matches"]
    out["scan_totals"] = f"""WITH {CV}, {APPS}, {PROFILES}, {LINES}, {hits}
SELECT count(*) AS cvs_from_db, count(s.total_matches) AS cvs_matched
FROM applications a JOIN profiles p ON a.applicant_id = p.applicant_id
LEFT JOIN scores s ON s.cv_path = a.cv_path AND a.cv_path <> ''"""

    out["section_starts"] = f"""WITH {CV}, {LINES}
SELECT doc_id, CAST(pos AS INTEGER) AS pos, heading AS section, line AS line_text FROM tagged WHERE heading IS NOT NULL"""
    out["sections"] = f"""WITH {CV}, {LINES}
SELECT doc_id, section, CAST(first_pos AS INTEGER) AS first_pos, content FROM sections"""
    out["flat_text"] = f"""WITH {CV}, {LINES}
SELECT doc_id, flat_text FROM flat WHERE length(flat_text) > 0"""
    out["structured_text"] = f"""WITH {CV}, {LINES},
st AS (SELECT doc_id, string_agg(section || chr(10) || chr(10) || content || chr(10) || chr(10), '' ORDER BY first_pos) AS s
       FROM sections GROUP BY doc_id)
SELECT d.doc_id, coalesce(st.s, '') AS structured_text FROM cv_documents d LEFT JOIN st ON st.doc_id = d.doc_id"""
    name = "Education"
    out["section_lookup"] = f"""WITH {CV}, {LINES}
SELECT d.doc_id, {q(name)} AS section, coalesce(s.content, {q(name + ' section not found.')}) AS content
FROM cv_documents d LEFT JOIN sections s ON s.doc_id = d.doc_id AND s.section = {q(name)}"""
    out["experience_entries"] = entries_sql("Experience", "title")
    out["education_entries"] = entries_sql("Education", "main_info")
    out["skills"] = f"""WITH {CV}, {LINES}, {skills_ctes()}
SELECT d.doc_id, coalesce(sl.n_skills, 0) AS n_skills, coalesce(sl.skills, '') AS skills
FROM cv_documents d LEFT JOIN skill_lists sl ON sl.doc_id = d.doc_id"""

    exp_text = lambda head: f"string_agg({head} || ' :: ' || details, ' | ' ORDER BY grp)"
    for query, join, found in (("candidate_summary", "JOIN", "true"),
                               ("candidate_summary_all", "LEFT JOIN", "p.applicant_id IS NOT NULL")):
        out[query] = f"""WITH {CV}, {APPS}, {PROFILES}, {LINES}, {skills_ctes()},
{block_lines('Experience', 'x')}, exp AS (SELECT doc_id, {exp_text('head')} AS experience FROM xent GROUP BY doc_id),
{block_lines('Education', 'e')},
edu AS (SELECT doc_id, {exp_text('head')} AS education FROM eent GROUP BY doc_id),
p2 AS (SELECT *, {parse_dob} FROM profiles)
SELECT a.detail_id, a.applicant_id, a.cv_path, concat_ws(' ', p.first_name, p.last_name) AS name,
       coalesce(CAST(p2.dob AS VARCHAR), CASE WHEN p2.date_of_birth NOT IN ('', 'None') THEN p2.date_of_birth END, 'N/A') AS birthdate,
       CASE WHEN {found} THEN p.address ELSE 'N/A' END AS address,
       CASE WHEN {found} THEN p.phone_number ELSE 'N/A' END AS phone,
       coalesce(sl.skills, '') AS skills, coalesce(exp.experience, '') AS experience,
       coalesce(edu.education, '') AS education
FROM applications a
JOIN cv_documents d ON d.cv_path = a.cv_path
{join} profiles p ON p.applicant_id = a.applicant_id
LEFT JOIN p2 ON p2.applicant_id = a.applicant_id
LEFT JOIN skill_lists sl ON sl.doc_id = d.doc_id
LEFT JOIN exp ON exp.doc_id = d.doc_id
LEFT JOIN edu ON edu.doc_id = d.doc_id
WHERE a.cv_path <> ''"""

    out["document_report"] = f"""WITH {CV}, {LINES}, {keywords_values(REPORT_KEYWORDS)},
texts AS MATERIALIZED (SELECT d.doc_id, coalesce(f.flat_text, '') AS flat_text FROM cv_documents d LEFT JOIN flat f USING (doc_id)),
{occurrences('texts', 'flat_text', REPORT_KEYWORDS)},
tokens AS (SELECT doc_id, unnest({words('flat_text')}) AS word FROM texts),
fz AS (SELECT doc_id, kw_pos, count(*) AS n, array_to_string(list_sort(list_distinct(list(word))), ',') AS words
       FROM tokens JOIN kw ON levenshtein(regexp_replace(lower(word), '[^\\x00-\\x7f]', chr(1), 'g'), keyword) <= bound
       GROUP BY doc_id, kw_pos),
told AS (SELECT t.doc_id, string_agg(concat_ws(':', keyword, coalesce(occ.n, 0), coalesce(fz.n, 0), coalesce(fz.words, '')),
                                     ' | ' ORDER BY kw.kw_pos) AS counts
         FROM texts t CROSS JOIN kw LEFT JOIN occ ON occ.doc_id = t.doc_id AND occ.kw_pos = kw.kw_pos
         LEFT JOIN fz ON fz.doc_id = t.doc_id AND fz.kw_pos = kw.kw_pos GROUP BY t.doc_id),
st AS (SELECT doc_id, string_agg(section || chr(10) || chr(10) || content || chr(10) || chr(10), '' ORDER BY first_pos) AS s
       FROM sections GROUP BY doc_id)
SELECT d.doc_id, coalesce(s.content, 'Experience section not found.') AS section_text, coalesce(st.s, '') AS structured_text,
       t.flat_text, told.counts
FROM cv_documents d LEFT JOIN sections s ON s.doc_id = d.doc_id AND s.section = 'Experience'
LEFT JOIN st ON st.doc_id = d.doc_id JOIN texts t ON t.doc_id = d.doc_id JOIN told ON told.doc_id = d.doc_id"""

    enc_cols = ",\n".join(
        f"  {xor_encrypt_sql(src, key)} AS {c}" for c, src in [
            ("first_name", "first_name"), ("last_name", "last_name"),
            ("date_of_birth", "coalesce(date_of_birth, 'None')"), ("address", "address"),
            ("phone_number", "phone_number")])
    out["encrypt_profiles"] = f"""WITH {PROFILES}
SELECT applicant_id,
{enc_cols}
FROM profiles"""
    dec_cols = ",\n".join(f"  {xor_decrypt_sql(c, key)} AS {c}" for c in
                          ["first_name", "last_name", "date_of_birth", "address", "phone_number"])
    out["decrypt_profiles"] = f"""WITH {PROFILES},
enc AS (SELECT applicant_id,
{enc_cols}
FROM profiles),
dec AS (SELECT applicant_id,
{dec_cols}
FROM enc),
p2 AS (SELECT *, {parse_dob} FROM dec)
SELECT {lookup_cols} FROM p2"""
    ok = " AND ".join(f"(src_{c} IS NULL OR {c} IS NOT NULL)" for c in
                      ["first_name", "last_name", "date_of_birth", "address", "phone_number"])
    out["encryption_audit"] = f"""WITH {PROFILES},
enc AS (SELECT first_name AS src_first_name, last_name AS src_last_name,
               coalesce(date_of_birth, 'None') AS src_date_of_birth, address AS src_address,
               phone_number AS src_phone_number,
{enc_cols}
        FROM profiles)
SELECT CAST(count(*) FILTER (WHERE {ok}) AS BIGINT) AS rows_processed,
       CAST(count(*) FILTER (WHERE NOT ({ok})) AS BIGINT) AS rows_failed FROM enc"""

    manifest = """m AS (
  SELECT '../data/' || file_name AS cv_path, application_role, applicant_id FROM (
    SELECT source AS application_role, CAST(doc_id AS VARCHAR) || '.txt' AS file_name,
           CAST(row_number() OVER (PARTITION BY source ORDER BY CAST(doc_id AS VARCHAR) || '.txt') AS INTEGER)
             AS applicant_id
    FROM documents) WHERE applicant_id <= 20)"""
    out["manifest_top_per_role"] = f"WITH {manifest} SELECT cv_path, application_role, applicant_id FROM m"
    out["append_applications"] = f"""WITH {APPS}, {manifest}
SELECT CAST((SELECT coalesce(max(detail_id), 0) FROM applications)
            + row_number() OVER (ORDER BY application_role, applicant_id) AS INTEGER) AS detail_id,
       applicant_id, application_role, cv_path FROM m"""
    out["append_checked"] = f"""WITH {APPS}, {MANIFEST}
SELECT CAST((SELECT coalesce(max(detail_id), 0) FROM applications)
            + row_number() OVER (ORDER BY application_role, applicant_id, cv_path) AS INTEGER) AS detail_id,
       applicant_id, application_role, cv_path
FROM manifest WHERE applicant_id IS NOT NULL AND length(application_role) <= 100"""
    out["append_audit"] = f"""WITH {MANIFEST}
SELECT count(*) FILTER (WHERE applicant_id IS NOT NULL AND length(application_role) <= 100) AS rows_inserted,
       count(*) FILTER (WHERE applicant_id IS NULL OR length(application_role) > 100) AS rows_skipped FROM manifest"""
    out["manifest_preview"] = f"""WITH {manifest},
head AS (SELECT * FROM m ORDER BY application_role, applicant_id LIMIT 10)
SELECT CAST(row_number() OVER (ORDER BY application_role, applicant_id) AS INTEGER) AS position, 'file' AS kind,
       applicant_id, application_role, cv_path, CAST(NULL AS BIGINT) AS total_files, CAST(NULL AS BIGINT) AS not_shown
FROM head
UNION ALL
SELECT NULL, 'summary', NULL, NULL, NULL, count(*), greatest(count(*) - 10, 0) FROM m"""
    out["assemble_documents"] = """SELECT conv_id, string_agg(coalesce(text, ''), '' ORDER BY turn) AS text
FROM conversations GROUP BY conv_id"""
    return out
