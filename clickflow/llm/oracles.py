"""DuckDB SQL for the dealt queries that SQL can express, over whole tables."""

from __future__ import annotations

from clickflow.llm import conversation_repair as repair
from clickflow.llm import cover_tree, lexical_search, quality_rules, substrings

SPACE = r"[\x20\x09-\x0D]"

_WORDS = rf"""
d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
w AS (
  SELECT doc_id, t, list_filter(string_split_regex(t, '{SPACE}+'), lambda x: x <> '') AS ws FROM d
),
words AS (SELECT doc_id, unnest(ws) AS word, generate_subscripts(ws, 1) AS i FROM w)"""


def _grams(n: int) -> str:
    return f"""
grams{n} AS (
  SELECT doc_id, i, array_to_string(ws[i:i + {n - 1}], ' ') AS g
  FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - {n} + 2)) AS i FROM w)
)"""


def op1_sql() -> str:
    n = substrings.LENGTH
    return f"""WITH {_WORDS}, {_grams(n)},
again AS (SELECT g FROM grams{n} GROUP BY g HAVING count(*) > 1),
gone AS (
  SELECT DISTINCT doc_id, unnest(range(i, i + {n})) AS i FROM grams{n} WHERE g IN (SELECT g FROM again)
),
marked AS (
  SELECT words.doc_id, words.i, word, gone.i IS NOT NULL AS removed
  FROM words LEFT JOIN gone ON words.doc_id = gone.doc_id AND words.i = gone.i
),
kept AS (
  SELECT doc_id, count(*) AS n_words, count(*) FILTER (removed) AS n_removed,
    coalesce(string_agg(word, ' ' ORDER BY i) FILTER (NOT removed), '') AS k
  FROM marked GROUP BY doc_id
)
SELECT d.doc_id, CAST(coalesce(n_words, 0) AS BIGINT) AS n_words,
  CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, sha256(coalesce(k, '')) AS kept_sha256
FROM d LEFT JOIN kept ON d.doc_id = kept.doc_id"""


def op3_sql() -> str:
    lengths = list(quality_rules.NGRAM_LIMITS)
    # An n-gram that repeats starts with a trigram that repeats, so only those are looked at.
    later = ", ".join(
        f"""
grams{n} AS (
  SELECT r3.doc_id, i, array_to_string(ws[i:i + {n - 1}], ' ') AS g
  FROM r3 JOIN w ON r3.doc_id = w.doc_id WHERE i <= len(ws) - {n} + 1
),
chars{n} AS (
  SELECT c.doc_id, sum(length(word)) AS c{n}
  FROM (
    SELECT DISTINCT doc_id, unnest(range(i, i + {n})) AS i
    FROM (SELECT *, row_number() OVER (PARTITION BY doc_id, g ORDER BY i) AS k FROM grams{n}) WHERE k > 1
  ) c JOIN words ON c.doc_id = words.doc_id AND c.i = words.i GROUP BY c.doc_id
)"""
        for n in lengths
    )
    shares = " OR ".join(
        f"coalesce(c{n}, 0) / greatest(word_chars, 1) > {most}" for n, most in quality_rules.NGRAM_LIMITS.items()
    )
    joins = " ".join(f"LEFT JOIN chars{n} USING (doc_id)" for n in lengths)
    return rf"""WITH {_WORDS}, {_grams(3)},
r3 AS (
  SELECT doc_id, i FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, g) AS k FROM grams3) WHERE k > 1
),
rep AS (
  SELECT doc_id, count(DISTINCT j) AS n_repeat_words
  FROM (SELECT doc_id, unnest(range(i, i + 3)) AS j FROM r3) GROUP BY doc_id
), {later},
lines AS (
  SELECT *, row_number() OVER (PARTITION BY doc_id, line ORDER BY i) AS k
  FROM (
    SELECT doc_id, unnest(string_split(t, chr(10))) AS line, generate_subscripts(string_split(t, chr(10)), 1) AS i
    FROM d
  ) WHERE regexp_matches(line, '[^\x20\x09-\x0D]')
),
dup AS (
  SELECT doc_id, count(*) AS n_dup_lines, sum(length(regexp_replace(line, '{SPACE}', '', 'g'))) AS dup_chars
  FROM lines WHERE k > 1 GROUP BY doc_id
),
base AS (
  SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words,
    CAST(length(regexp_replace(t, '{SPACE}', '', 'g')) AS BIGINT) AS word_chars,
    CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
    CAST(coalesce(n_dup_lines, 0) AS BIGINT) AS n_dup_lines,
    CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words,
    len(ws) < {quality_rules.MIN_WORDS} OR 100 * coalesce(n_repeat_words, 0) > 50 * len(ws) AS base_failed,
    coalesce(dup_chars, 0) AS dup_chars
  FROM w LEFT JOIN rep USING (doc_id) LEFT JOIN dup USING (doc_id)
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT (base_failed OR {shares}
    OR dup_chars / greatest(word_chars, 1) > {quality_rules.LINE_LIMIT}
    OR n_symbols > {quality_rules.SYMBOL_LIMIT} * n_words) AS kept,
  CAST(coalesce(c{lengths[0]}, 0) / greatest(word_chars, 1) AS DOUBLE) AS ngram_char_share,
  CAST(dup_chars / greatest(word_chars, 1) AS DOUBLE) AS dup_line_char_share
FROM base {joins}"""


def op9_sql() -> str:
    return f"""WITH RECURSIVE v AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
),
links AS (
  SELECT a.vec_id AS x, b.vec_id AS y FROM v a JOIN v b
  ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_cosine_similarity(a.e, b.e) >= {cover_tree.THRESHOLD}
),
reach AS (
  SELECT vec_id, vec_id AS other FROM embeddings
  UNION
  SELECT r.vec_id, l.y FROM reach r JOIN links l ON r.other = l.x
),
least AS (SELECT vec_id, min(other) AS component_id FROM reach GROUP BY vec_id),
counted AS (SELECT x, count(*) AS n FROM links GROUP BY x)
SELECT e.vec_id, CAST(coalesce(n, 0) AS BIGINT) AS n_links, component_id, e.vec_id = component_id AS kept
FROM embeddings e JOIN least ON e.vec_id = least.vec_id LEFT JOIN counted ON e.vec_id = counted.x"""


def _crc32(text: str) -> str:
    """CRC-32 of an ASCII string, from a table ``crc.t`` made by rule."""
    return (
        f"xor(4294967295, list_reduce(list_transform(string_split({text}, ''), lambda c: CAST(ascii(c) AS BIGINT)), "
        f"lambda a, b: xor(a // 256, crc.t[1 + xor(a, b) % 256]), 4294967295))"
    )


def op11_sql() -> str:
    def step(state: str, cost: str, letter: str, line: str | None) -> str:
        lines = f"{state}.t" if line is None else f"list_append({state}.t, {line})"
        k = f"printf('%09d', CAST({state}.k[:9] AS INTEGER) + {cost}) || {state}.k[10:] || '{letter}'"
        return f"CASE WHEN {state} IS NOT NULL THEN {{'k': {k}, 't': {lines}}} END"

    def least(*states: str) -> str:
        return f"list_sort(list_filter([{', '.join(states)}], lambda x: x IS NOT NULL))[1]"

    def add(state: str, role: str) -> str:
        return f"({step(state, str(repair.INSERT_COST), 'I', repr(role + ':'))})"

    user, both = lambda s: add(s, "user"), lambda s: add(add(s, "user"), "assistant")
    keep = lambda s, r: f"CASE WHEN fault IN (0, 3) AND initial = '{r}' THEN {step(s, 'extra', 'K', 'role || chr(58) || text')} END"
    change = lambda s, r: f"CASE WHEN fault IN (0, 3) THEN {step(s, f'{repair.REROLE_COST} + extra', 'R', f'{r!r} || chr(58) || text')} END"
    gone = lambda s: step(s, str(repair.DELETE_COST), "D", None)
    state = "STRUCT(k VARCHAR, t VARCHAR[])"
    closed = f"""s0 AS c0, s1 AS c1,
      {least('s2', user('s0'), user('s1'), user('s3'))} AS c2,
      {least('s3', add('s2', 'assistant'), both('s0'), both('s1'))} AS c3"""
    return rf"""WITH RECURSIVE crc AS (
  SELECT list_transform(range(256), lambda n: list_reduce(
    range(8), lambda c, i: CASE WHEN c % 2 = 1 THEN xor(3988292384, c // 2) ELSE c // 2 END, n)) AS t
),
fates AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    {_crc32("concat(coalesce(CAST(conv_id AS VARCHAR), ' '), ':', coalesce(CAST(turn AS VARCHAR), ' '))")} % 20 AS fate
  FROM conversations, crc
),
damaged AS (
  SELECT conv_id, turn, CASE WHEN fate = 4 THEN 'user' ELSE role END AS role,
    CASE WHEN fate = 1 THEN '' WHEN fate = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM (SELECT *, unnest(CASE WHEN fate = 3 THEN [1, 2] ELSE [1] END) AS copy FROM fates WHERE fate <> 0)
),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, md5(length(role) || ':' || role || text)) AS i,
    substr(role, 1, 1) AS initial
  FROM damaged
),
faults AS (
  SELECT *, CASE WHEN NOT regexp_matches(text, '[^ 	-
]') THEN 1
      WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 2
      WHEN NOT regexp_matches(text, '[.!?][ 	-
]*\z') THEN 3 ELSE 0 END AS fault,
    lag(initial) OVER (PARTITION BY conv_id ORDER BY i) AS previous
  FROM ranked
),
rows_ AS (SELECT *, CASE WHEN fault = 3 THEN {repair.TRUNCATED_COST} ELSE 0 END AS extra FROM faults),
counted AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
    count(*) FILTER (fault = 1) AS blank, count(*) FILTER (fault = 2) AS duplicate, count(*) FILTER (fault = 3) AS truncated,
    count(*) FILTER (previous IS NOT NULL AND previous || initial NOT IN ('su', 'ua', 'au')) AS illegal, count(*) AS n
  FROM rows_ GROUP BY conv_id
),
dp AS (
  SELECT conv_id, CAST(0 AS BIGINT) AS i, CAST({{'k': '000000000', 't': []}} AS {state}) AS s0,
    CAST(NULL AS {state}) AS s1, CAST(NULL AS {state}) AS s2, CAST(NULL AS {state}) AS s3
  FROM counted
  UNION ALL
  SELECT conv_id, i, {gone('c0')} AS s0, {least(gone('c1'), keep('c0', 's'))} AS s1,
    {least(gone('c2'), *[f(c, r) for c in ('c0', 'c1', 'c3') for f, r in ((keep, 'u'), (change, 'user'))])} AS s2,
    {least(gone('c3'), keep('c2', 'a'), change('c2', 'assistant'))} AS s3
  FROM (
    SELECT d.conv_id, r.i, r.initial, r.role, r.text, r.fault, r.extra, {closed}
    FROM dp d JOIN rows_ r ON r.conv_id = d.conv_id AND r.i = d.i + 1
  )
),
done AS (
  SELECT conv_id, {least('c0', 'c3')} AS best
  FROM (SELECT d.conv_id, {closed} FROM dp d JOIN counted c ON c.conv_id = d.conv_id AND c.n = d.i)
)
SELECT o.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
  coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal,
  CAST(coalesce(CAST(best.k[:9] AS BIGINT), 0) AS BIGINT) AS cost, coalesce(best.k[10:], '') AS audit,
  sha256(coalesce(array_to_string(best.t, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o
LEFT JOIN counted c ON c.conv_id = o.conv_id LEFT JOIN done ON done.conv_id = o.conv_id"""


def op12_sql() -> str:
    digits = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
    five = "CAST('0x' || substr(sha1(h), 1 + 5 * (j // 4), 5) AS BIGINT)"
    return f"""WITH p AS (SELECT page_id, url, coalesce(html, '') AS h FROM pages),
told AS (
  SELECT page_id, CAST(octet_length(encode(h)) AS BIGINT) AS payload_bytes,
    array_to_string(list_transform(range(32), lambda j: substr('{digits}', 1 + ({five} >> CAST(15 - 5 * (j % 4) AS INTEGER)) % 32, 1)), '')
      AS payload_digest,
    row_number() OVER w AS k, first_value(page_id) OVER w AS first_page
  FROM p WINDOW w AS (PARTITION BY h ORDER BY page_id NULLS LAST, url NULLS LAST)
)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN k = 1 THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN k > 1 THEN first_page END AS refers_to
FROM told"""


def op13_sql() -> str:
    def terms(table: str, name: str) -> str:
        folded = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
        return rf"""SELECT {name}, unnest(regexp_extract_all({folded}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM {table}"""

    return f"""WITH t AS ({terms('documents', 'doc_id')}),
sizes AS (SELECT doc_id, count(*) AS n FROM t GROUP BY doc_id),
whole AS (SELECT CAST(count(*) AS BIGINT) AS docs, CAST(sum(n) AS BIGINT) AS words FROM sizes),
tfs AS (SELECT doc_id, term, count(*) AS tf FROM t GROUP BY doc_id, term),
items AS (SELECT DISTINCT item_id, term FROM ({terms('benchmark', 'item_id')})),
weights AS (
  SELECT term, CAST(floor(1000 * ln(CAST(2 * any_value(docs) + 2 AS DOUBLE) / CAST(2 * count(*) + 1 AS DOUBLE))) AS BIGINT) AS w
  FROM tfs, whole WHERE term IN (SELECT term FROM items) GROUP BY term
),
scores AS (
  SELECT item_id, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * docs) // words)))) AS BIGINT) AS score
  FROM items JOIN weights USING (term) JOIN tfs USING (term) JOIN sizes USING (doc_id), whole GROUP BY item_id, doc_id
),
ranked AS (
  SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS "rank", doc_id, score
  FROM scores WHERE score > 0
)
SELECT * FROM ranked WHERE "rank" <= {lexical_search.TOP}"""


def oracle_sql() -> dict[str, str]:
    return {
        "op1_substrings": op1_sql(),
        "op3_quality_rules": op3_sql(),
        "op9_cover_tree": op9_sql(),
        "op11_conversation_repair": op11_sql(),
        "op12_warc": op12_sql(),
        "op13_lexical_search": op13_sql(),
    }
