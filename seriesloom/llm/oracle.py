"""DuckDB statements for the queries that SQL can express."""

from __future__ import annotations

from . import licences

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _words(text: str) -> str:
    return rf"list_filter(regexp_split_to_array({text}, '[\x20\x09-\x0D]+'), lambda x: x <> '')"


SUBSTRING = f"""
WITH split AS (SELECT doc_id, {_words("coalesce(text, '')")} AS w FROM documents),
windows AS (
  SELECT doc_id, unnest(range(1, len(w) - 11)) AS i,
         unnest(list_transform(range(1, len(w) - 11), lambda i: array_to_string(w[i:i + 12], ' '))) AS g
  FROM split WHERE len(w) >= 13),
first AS (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY g) AS earliest FROM windows),
gone AS (
  SELECT DISTINCT doc_id, i + k AS pos FROM first, (SELECT unnest(range(0, 13)) AS k) WHERE earliest < doc_id),
words AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS pos FROM split),
kept AS (
  SELECT w.doc_id, count(g.pos) AS n_removed,
         string_agg(CASE WHEN g.pos IS NULL THEN word END, ' ' ORDER BY w.pos) AS text
  FROM words w LEFT JOIN gone g ON g.doc_id = w.doc_id AND g.pos = w.pos GROUP BY w.doc_id)
SELECT s.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_removed, 0) AS n_removed,
       sha256(coalesce(k.text, '')) AS kept_sha256
FROM split s LEFT JOIN kept k ON k.doc_id = s.doc_id
"""

NEARDUP = f"""
WITH RECURSIVE split AS (
  SELECT doc_id, {_words(f"translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}')")} AS w FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) = 1 THEN w
                 ELSE list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) END AS s
  FROM split),
shingles AS (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM sets),
links AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM shingles a JOIN shingles b ON a.g = b.g AND a.doc_id <> b.doc_id
  WHERE 5 * least(a.n, b.n) >= 4 * greatest(a.n, b.n)
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))),
reached AS (
  SELECT doc_id, doc_id AS other FROM sets
  UNION SELECT r.doc_id, l.b FROM reached r JOIN links l ON l.a = r.other),
classes AS (SELECT doc_id, min(other) AS component_id FROM reached GROUP BY doc_id)
SELECT s.doc_id, CAST(len(s) AS BIGINT) AS n_shingles, component_id, s.doc_id = component_id AS kept
FROM sets s JOIN classes c ON c.doc_id = s.doc_id
"""


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _licences(percent: int = 80) -> str:
    rows = ", ".join(
        f"({_quoted(name)}, [{', '.join(map(_quoted, licences.bigrams_of(text)))}])"
        for name, text in licences.NOTICES.items()
    )
    return f"""
WITH t(licence, grams) AS (VALUES {rows}),
lines AS (
  SELECT doc_id, unnest(range(0, len(l))) AS line, unnest(l) AS unit
  FROM (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents)),
split AS (
  SELECT doc_id, line,
         string_split(trim(regexp_replace(translate(unit, '{_UPPER}', '{_LOWER}'), '[^a-z0-9]+', ' ', 'g')), ' ') AS w
  FROM lines),
own AS (
  SELECT doc_id, line, list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS own
  FROM split WHERE len(w) > 1),
scored AS (
  SELECT doc_id, line, licence, len(list_intersect(own, grams)) AS shared, len(own) AS size, len(grams) AS template_size
  FROM own, t WHERE {200 - percent} * least(len(own), len(grams)) >= {percent} * greatest(len(own), len(grams)))
SELECT doc_id, line, licence, shared, size, template_size FROM scored
WHERE 200 * shared >= {percent} * (size + template_size)
QUALIFY row_number() OVER (PARTITION BY doc_id, line ORDER BY shared / (size + template_size) DESC, licence) = 1
"""


_CONTROL = r"([<\[])(\\*)(/?s>|/?INST\]|\|endoftext\|>)"

CHAT = f"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, turn, role, '</s>[INST] ok [/INST]' FROM (VALUES (0, 'user'), (1, 'assistant')) v(turn, role)),
longer AS (
  SELECT *, role = 'assistant' AS heard,
         20 + length(regexp_replace(role, '{_CONTROL}', '\\1\\\\\\2\\3', 'g'))
            + length(regexp_replace(text, '{_CONTROL}', '\\1\\\\\\2\\3', 'g')) AS chars
  FROM rows)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (heard), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (heard), '')) AS loss_sha256,
       CAST(sum(chars) AS BIGINT) AS formatted_chars
FROM longer GROUP BY conv_id
"""


def _crc32(text: str) -> str:
    """Unsigned CRC-32 of an ASCII text, byte by byte with the usual table."""
    table = []
    for value in range(256):
        for _ in range(8):
            value = value >> 1 ^ (0xEDB88320 if value & 1 else 0)
        table.append(value)
    step = f"xor(c >> 8, CAST({table} AS BIGINT[])[xor(c, b) % 256 + 1])"
    codes = f"list_transform(string_split({text}, ''), lambda x: CAST(ascii(x) AS BIGINT))"
    return f"xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), {codes}), lambda c, b: {step}), 4294967295)"


def _tree(name: str, key: str, depth: int) -> str:
    """Levels ``name``0 to ``name``depth of trees with the nodes (key, pos, n, digest), and the siblings on each."""
    parts = []
    for k in range(1, depth + 1):
        parts.append(f"""
{name}{k} AS (
  SELECT {key}, pos // 16 AS pos, (n + 15) // 16 AS n,
         CASE WHEN n > 1 THEN sha256(string_agg(digest, '' ORDER BY pos)) ELSE min(digest) END AS digest
  FROM {name}{k - 1} GROUP BY {key}, pos // 16, n)""")
    for k in range(depth):
        run = f"PARTITION BY {key}, pos // 16 ORDER BY pos ROWS BETWEEN"
        parts.append(f"""
{name}_around{k} AS (
  SELECT {key}, pos, n > 1 AS hashed,
         coalesce(string_agg(digest, '') OVER ({run} UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS before,
         coalesce(string_agg(digest, '') OVER ({run} 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS after
  FROM {name}{k})""")
    return ",".join(parts)


def _manifest(depth: int = 5, top: int = 4) -> str:
    """Trees of up to 16 ** depth documents a source and 16 ** top sources."""
    fields = ["CAST(doc_id AS VARCHAR)", "source", "lang", "CAST(n_chars AS VARCHAR)"]

    def leaf(text: str) -> str:
        return "sha256(" + " || ".join(f"coalesce(strlen({f}) || ':' || {f}, '-')" for f in [*fields, text]) + ")"

    steps = [("leaf", k) for k in range(depth)] + [("top", k) for k in range(top)]
    proof, joins = [], []
    for i, (name, k) in enumerate(steps):
        a = f"a{i}"
        match = f"{a}.named = l.named AND {a}.name = l.name AND {a}.pos = l.pos // {16**k}"
        if name == "top":
            match = f"{a}.pos = s.pos // {16**k}"
        joins.append(f"JOIN {name}_around{k} {a} ON {match}")
        proof.append(f"CASE WHEN {a}.hashed THEN {a}.before || {a}.after ELSE '' END")
    chain = []
    for i in range(len(steps)):
        chain.append(f"""
fold{i + 1} AS (
  SELECT * REPLACE (CASE WHEN hashed{i} THEN sha256(before{i} || shown || after{i}) ELSE shown END AS shown)
  FROM fold{i})""")
    sides = ("hashed", "before", "after")
    around = ", ".join(f"a{i}.{side} AS {side}{i}" for i in range(len(steps)) for side in sides)
    return f"""
WITH leaves AS (
  SELECT doc_id, source IS NOT NULL AS named, coalesce(source, '') AS name, {leaf("text")} AS digest,
         CASE WHEN {_crc32("CAST(doc_id AS VARCHAR)")} % 5 = 0
              THEN {leaf(f"translate(text, '{_UPPER}', '{_LOWER}')")} END AS tampered
  FROM documents),
leaf0 AS (
  SELECT *, row_number() OVER (PARTITION BY named, name ORDER BY doc_id NULLS FIRST, digest) - 1 AS pos,
         count(*) OVER (PARTITION BY named, name) AS n
  FROM leaves),{_tree("leaf", "named, name", depth)},
top0 AS (
  SELECT 1 AS one, named, name, digest, row_number() OVER (ORDER BY named, encode(name)) - 1 AS pos,
         count(*) OVER () AS n
  FROM leaf{depth}),{_tree("top", "one", top)},
fold0 AS (
  SELECT l.doc_id, l.digest AS leaf, s.digest AS subroot, r.digest AS root,
         sha256({" || ".join(proof)}) AS proof_sha256, coalesce(l.tampered, l.digest) AS shown, {around}
  FROM leaf0 l JOIN top0 s ON s.named = l.named AND s.name = l.name CROSS JOIN top{top} r
  {" ".join(joins)}),{",".join(chain)}
SELECT doc_id, leaf, subroot, root, proof_sha256, shown AS folded_root, shown = root AS verified
FROM fold{len(steps)}
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op2_substring": SUBSTRING,
        "op7_licences": _licences(),
        "op8_neardup": NEARDUP,
        "op9_chat": CHAT,
        "op11_manifest": _manifest(),
    }
