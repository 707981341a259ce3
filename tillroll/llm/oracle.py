"""SQL counterparts of the queries, where SQL can express them."""

from __future__ import annotations

from tillroll.llm.licences import (
    EDGES,
    HINT,
    NOISE,
    RULES,
    SENTENCES,
    sentence_trie,
)
from tillroll.llm.pii import IBAN_LENGTHS, KEY_SHAPE, SECRET_DIGIT_IN, SECRET_DISTINCT


def _pii_kind(
    number: int, pattern: str, valid: str, score: int, boost: int, context: str, least: int, tail: str = ""
) -> str:
    """Spans of one kind: gaps and matches alternate, so earlier lengths give the start.

    A match may have taken in one character behind the span, a ``tail``, which belongs to the next gap.
    """
    match, gap = "matches[i]", "gaps[i]"
    if tail:
        match = f"regexp_replace(matches[i], '{tail}$', '')"
        gap = f"(CASE WHEN i > 1 THEN regexp_extract(matches[i-1], '{tail}$') ELSE '' END || gaps[i])"
    return f"""
    SELECT doc_id, row_no, {number} AS kind,
           list_sum(list_transform(gaps[1:i], lambda g: length(g)))
             + coalesce(list_sum(list_transform(matches[1:i-1], lambda m: length(m))), 0) AS start,
           length({match}) AS size,
           {score} + CASE WHEN regexp_matches(lower(right({gap}, 40)), '{context}') THEN {boost} ELSE 0 END AS score
    FROM (SELECT *, unnest(range(1, len(matches) + 1)) AS i
          FROM (SELECT doc_id, row_no, regexp_extract_all(text, '{pattern}') AS matches,
                       string_split_regex(text, '{pattern}') AS gaps FROM docs))
    WHERE {valid.replace("$m", match)}
      AND {score} + CASE WHEN regexp_matches(lower(right({gap}, 40)), '{context}') THEN {boost} ELSE 0 END >= {least}"""


_DIGITS = "regexp_replace($m, '[^0-9]', '', 'g')"
_LUHN = f"""list_sum(list_transform(range(1, length({_DIGITS}) + 1), lambda k:
      CASE WHEN k % 2 = 1 THEN CAST({_DIGITS}[length({_DIGITS}) + 1 - k] AS INT)
           ELSE CASE WHEN CAST({_DIGITS}[length({_DIGITS}) + 1 - k] AS INT) > 4
                     THEN 2 * CAST({_DIGITS}[length({_DIGITS}) + 1 - k] AS INT) - 9
                     ELSE 2 * CAST({_DIGITS}[length({_DIGITS}) + 1 - k] AS INT) END END)) % 10 = 0"""
_PLAIN = "replace($m, ' ', '')"
_MOD97 = f"""list_reduce(
      list_prepend(0, list_transform(string_split({_PLAIN}[5:] || {_PLAIN}[1:4], ''), lambda c: ord(c))),
      lambda rest, c: (CASE WHEN c < 65 THEN rest * 10 + c - 48 ELSE rest * 100 + c - 55 END) % 97) = 1"""



def _iban() -> str:
    """Listed countries by their length and up to a character that ends them; others by any length."""
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    listed = {name: size for size, names in IBAN_LENGTHS.items() for name in names.split()}
    shapes = []
    for size, names in IBAN_LENGTHS.items():
        whole, rest = divmod(size - 4, 4)
        end = f" ?[A-Z0-9]{{{rest}}}" if rest else ""
        shapes.append(f"(?:{names.replace(' ', '|')})[0-9]{{2}}(?: ?[A-Z0-9]{{4}}){{{whole}}}{end}(?:[^A-Z0-9]|$)")
    others = "|".join(f"{a}[{''.join(b for b in letters if a + b not in listed)}]" for a in letters)
    return "|".join([*shapes, f"(?:{others})[0-9]{{2}}(?: ?[A-Z0-9]{{4}}){{2,7}}(?: ?[A-Z0-9]{{1,3}})?"])


_SECRET_WORDS = "token|secret|passw|key|auth|credential|bearer"
_PII = f"""
WITH docs AS (SELECT doc_id, coalesce(text, '') AS text, row_number() OVER () AS row_no FROM documents),
found AS ({" UNION ALL ".join([
    _pii_kind(0, r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+", "true", 90, 10, "mail|contact|write", 0),
    _pii_kind(1, r"[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)",
              "list_bool_and(list_transform(string_split($m, '.'), lambda p: length(ltrim(p, '0')) <= 3"
              " AND coalesce(TRY_CAST(right('000' || ltrim(p, '0'), 3) AS INT), 0) <= 255))",
              60, 30, "ip|host|server|address", 0),
    _pii_kind(2, r"[0-9](?:[ -]?[0-9])+", f"length({_DIGITS}) BETWEEN 14 AND 19 AND {_LUHN}", 80, 20,
              "card|visa|credit|pay", 0),
    _pii_kind(3, r"\+[0-9][ ().0-9-]+[0-9]", f"length({_DIGITS}) BETWEEN 10 AND 15", 70, 30,
              "phone|call|tel|mobile", 0),
    _pii_kind(4, _iban(), _MOD97, 90, 10, "iban|account|bank", 0, "[^A-Z0-9]"),
    _pii_kind(5, r"[0-9]+(?:-[0-9]+){2,}",
              "regexp_full_match($m, '[0-9]{3}-[0-9]{2}-[0-9]{4}')"
              " AND NOT regexp_matches($m, '^(?:000|666|9)|-00-|-0000$')",
              40, 40, "ssn|social|security", 60),
    _pii_kind(6, "[A-Za-z0-9_-]{20,}", f"regexp_matches($m, '{KEY_SHAPE}')", 90, 10, _SECRET_WORDS, 0),
    _pii_kind(7, "[A-Za-z0-9_-]{20,}",
              f"NOT regexp_matches($m, '{KEY_SHAPE}') AND regexp_matches($m, '[A-Za-z]')"
              f" AND len(list_distinct(string_split($m, ''))) >= {SECRET_DISTINCT}"
              f" AND length({_DIGITS}) * {SECRET_DIGIT_IN} >= length($m)", 30, 40, _SECRET_WORDS, 60),
])}),
spans AS (
  SELECT row_no, kind, start, score,
         ['email', 'ip', 'card', 'phone', 'iban', 'ssn', 'key', 'secret'][kind + 1] || ':' || start || ':' || (start + size) AS span
  FROM found)
SELECT d.doc_id,
       count(*) FILTER (kind = 0) AS n_email, count(*) FILTER (kind = 1) AS n_ip,
       count(*) FILTER (kind = 2) AS n_card, count(*) FILTER (kind = 3) AS n_phone,
       count(*) FILTER (kind = 4) AS n_iban, count(*) FILTER (kind = 5) AS n_ssn,
       count(*) FILTER (kind = 6) AS n_key, count(*) FILTER (kind = 7) AS n_secret,
       sha256(coalesce(string_agg(span, ',' ORDER BY start, kind) FILTER (kind < 4), '')) AS base_sha256,
       coalesce(string_agg(span, ',' ORDER BY start, kind), '') AS spans,
       coalesce(string_agg(CAST(score AS VARCHAR), ',' ORDER BY start, kind), '') AS scores
FROM docs d LEFT JOIN spans s USING (row_no)
GROUP BY d.row_no, d.doc_id
"""

_KNOWN = ", ".join(f"'{sentence}': '{name}'" for sentence, name in SENTENCES.items())


def _licences() -> str:
    """Rules one after another: each uses up the identifiers it matches."""
    plain = f"replace(regexp_replace(lower(text), '{NOISE}', '  ', 'g'), 'licenc', 'licens')"
    words = f"regexp_replace(regexp_replace(' ' || {plain} || ' ', '{EDGES}', ' ', 'g'), ' +', '  ', 'g')"
    steps, before = [], "joined"
    for i, (name, sequence) in enumerate(RULES):
        piece = "'" + ";" + ";;".join(sequence) + ";" + "'"
        steps.append(
            f"rule{i} AS (SELECT doc_id, n_known, replace(remaining, {piece}, '|') AS remaining,"
            f" CASE WHEN contains(remaining, {piece}) THEN list_append(names, '{name}') ELSE names END"
            f" AS names FROM {before})"
        )
        before = f"rule{i}"
    return f"""
WITH hinted AS (SELECT doc_id, text, MAP {{{_KNOWN}}} AS known,
                       regexp_matches(lower(coalesce(text, '')), '{HINT}') AS hint FROM documents),
found AS (
  SELECT doc_id, CASE WHEN hint THEN list_transform(
      regexp_extract_all({words}, '{sentence_trie()}'),
      lambda m: known[trim(replace(m, '  ', ' '))]) ELSE CAST([] AS VARCHAR[]) END AS ids
  FROM hinted),
joined AS (SELECT doc_id, CAST(len(ids) AS INT) AS n_known,
                  ';' || array_to_string(ids, ';;') || ';' AS remaining, CAST([] AS VARCHAR[]) AS names FROM found),
{", ".join(steps)}
SELECT doc_id, array_to_string(list_sort(list_distinct(names)), ',') AS licences, n_known,
       CAST(len(regexp_extract_all(remaining, '[A-Z0-9_]+')) AS INT) AS n_unmatched
FROM {before}
"""



def _spelling() -> str:
    """CRC-32 by half bytes; words one edit apart share the word less one code point."""
    table = []
    for i in range(16):
        c = i
        for _ in range(4):
            c = (c >> 1) ^ (0xEDB88320 if c & 1 else 0)
        table.append(c)
    entries = ", ".join(str(c) for c in table)
    # The low half of a byte comes first.
    halves = (
        "list_transform(string_split(regexp_replace(hex(encode(id || ':' || run)), '(.)(.)', '\\2\\1', 'g'), ''),"
        " lambda x: CAST(strpos('0123456789ABCDEF', x) - 1 AS BIGINT))"
    )
    crc = (
        f"xor(4294967295, list_reduce(list_prepend(4294967295, {halves}),"
        f" lambda c, x: xor(c >> 4, [{entries}][CAST(xor(c & 15, x) + 1 AS INT)])))"
    )
    return f"""
WITH RECURSIVE runs AS (
  SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS id,
         unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                   '[a-z\u00C0-\u00FF]+')) AS run
  FROM documents),
hashed AS (SELECT run, {crc} AS h FROM runs WHERE length(run) >= 6),
counted AS (
  SELECT CASE WHEN h % 199 = 0 THEN left(run, CAST(h % length(run) AS INT)) || substr(run, CAST(h % length(run) AS INT) + 2)
              ELSE run END AS word
  FROM hashed),
words AS MATERIALIZED (
  SELECT word, count(*) AS n FROM counted WHERE length(word) >= 6 GROUP BY word HAVING count(*) >= 5),
less AS MATERIALIZED (
  SELECT word, n, i, left(word, i - 1) || substr(word, i + 1) AS rest
  FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words)),
near AS (
  SELECT a.word, a.n, b.word AS other, b.n AS other_n
  FROM less a JOIN less b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
  UNION SELECT a.word, a.n, b.word, b.n FROM less a JOIN words b ON a.rest = b.word
  UNION SELECT b.word, b.n, a.word, a.n FROM less a JOIN words b ON a.rest = b.word),
best AS (
  SELECT word, n, count(*) AS n_near,
         first(other ORDER BY other_n DESC, other) AS other, max(other_n) AS other_n
  FROM near GROUP BY word, n),
forms AS MATERIALIZED (
  SELECT w.word, w.n, coalesce(b.n_near, 0) AS n_near,
         CASE WHEN b.other_n >= 5 * w.n THEN b.other END AS form,
         CASE WHEN b.other_n >= 5 * w.n THEN b.other_n END AS form_n
  FROM words w LEFT JOIN best b USING (word)),
steps AS (
  SELECT word, word AS root, form AS next FROM forms
  UNION ALL SELECT s.word, f.word, f.form FROM steps s JOIN forms f ON s.next = f.word)
SELECT f.word, f.form, s.root, f.n, f.n_near, f.form_n
FROM forms f JOIN steps s ON f.word = s.word AND s.next IS NULL
"""


def _codes() -> str:
    """Four rounds of assignment and means, one after another."""
    dot = "list_inner_product(CAST({} AS DOUBLE[]), CAST({} AS DOUBLE[]))"
    far = f"{dot.format('x', 'x')} - 2 * {dot.format('x', 'c')} + {dot.format('c', 'c')}"
    steps = []
    for k in range(5):
        steps.append(
            f"nearest{k} AS MATERIALIZED (SELECT row_no, p.part, min(CAST({far} AS BIGINT) * 256 + entry) AS best"
            f" FROM parts p JOIN book{k} b ON p.part = b.part GROUP BY row_no, p.part)"
        )
        if k < 4:
            steps.append(
                f"means{k} AS (SELECT part, entry, list(mean ORDER BY i) AS c FROM ("
                f" SELECT p.part, best % 256 AS entry, i, CAST(floor(sum(x[i]) / count(*)) AS BIGINT) AS mean"
                f" FROM parts p JOIN nearest{k} m ON p.row_no = m.row_no AND p.part = m.part,"
                f" unnest(range(1, len(x) + 1)) AS t(i) GROUP BY p.part, best % 256, i) GROUP BY part, entry)"
            )
            steps.append(
                f"book{k + 1} AS MATERIALIZED (SELECT b.part, b.entry, coalesce(m.c, b.c) AS c"
                f" FROM book{k} b LEFT JOIN means{k} m ON b.part = m.part AND b.entry = m.entry)"
            )
    return f"""
WITH kept AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY vec_id, ints) AS row_no, vec_id, label, ints
  FROM (SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor(CAST(x AS DOUBLE) * 1024) AS BIGINT)) AS ints
        FROM embeddings
        WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)),
parts AS MATERIALIZED (
  SELECT row_no, part, ints[part * len(ints) // 4 + 1 : (part + 1) * len(ints) // 4] AS x
  FROM kept, unnest(range(0, 4)) AS t(part)),
book0 AS MATERIALIZED (SELECT part, row_no - 1 AS entry, x AS c FROM parts WHERE row_no <= 256),
{", ".join(steps)},
digest AS (
  SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY part, entry)) AS codebooks_sha256 FROM book4),
coded AS MATERIALIZED (
  SELECT row_no, lower(string_agg(printf('%02x', best % 256), '' ORDER BY part)) AS code,
         CAST(sum(best // 256) AS BIGINT) AS error
  FROM nearest4 GROUP BY row_no)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
FROM kept JOIN coded USING (row_no), digest
"""


ORACLE: dict[str, str] = {
    "op3_licences": _licences(),
    "op5_pii": _PII,
    "op12_spelling": _spelling(),
    "op13_codes": _codes(),
}
