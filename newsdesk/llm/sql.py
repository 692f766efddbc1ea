"""SQL of the queries that SQL can express, for the same tables."""

from __future__ import annotations

import zlib

from newsdesk.llm import mixing, quality_rules

WORDS = r"[^\x20\x09-\x0D]+"
CAPITALS = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"

_MEASURED = f"""
WITH texts AS MATERIALIZED (
  SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '{WORDS}') AS words,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda l: regexp_matches(l, '{WORDS}')) AS lines
  FROM documents),
spots AS MATERIALIZED (SELECT doc_id, unnest(words) AS w, generate_subscripts(words, 1) AS i FROM texts),
windows AS MATERIALIZED (
  SELECT doc_id, i, concat_ws(' ', w, lead(w, 1) OVER o, lead(w, 2) OVER o, lead(w, 3) OVER o, lead(w, 4) OVER o) AS five, lead(w, 4) OVER o AS last
  FROM spots WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
again AS MATERIALIZED (
  SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, five) AS n FROM windows WHERE last IS NOT NULL) WHERE n > 1),
covered AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM again, range(5) r(k) GROUP BY doc_id),
measured AS MATERIALIZED (
  SELECT t.doc_id, len(words)::BIGINT AS n_words, length(array_to_string(words, ''))::BIGINT AS word_chars,
         len(regexp_extract_all(text, '[#*$%&|<>]'))::BIGINT AS n_symbols, (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
         coalesce(c.n, 0)::BIGINT AS n_repeat_words, len(lines)::BIGINT AS n_lines,
         len(list_filter(words, lambda w: regexp_matches(w, '[A-Za-z]|[^\\x00-\\x7F]')))::BIGINT AS n_letter_words
  FROM texts t LEFT JOIN covered c USING (doc_id)),
ledger AS MATERIALIZED (
  SELECT *, ({" + ".join(f"CASE WHEN {r.fails} THEN {1 << i} ELSE 0 END" for i, r in enumerate(quality_rules.RULES))})::BIGINT AS fail_mask FROM measured)
"""

RULE_LEDGER = f"""{_MEASURED}
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, fail_mask & {quality_rules.policy_mask("base")} <> 0 AS base_failed,
       fail_mask & {quality_rules.policy_mask()} = 0 AS kept, n_lines, n_letter_words, fail_mask
FROM ledger
"""

_POLICY_ROWS = ", ".join(f"('{p}', '{r}', {quality_rules.BIT[r]}, {quality_rules.policy_mask(p)})" for p, names in quality_rules.POLICIES.items() for r in names)
RULE_ABLATIONS = f"""{_MEASURED}
SELECT policy, rule, count(*) FILTER (fail_mask & mask & bit <> 0) AS failed, count(*) FILTER (fail_mask & mask = bit) AS only_this,
       count(*) FILTER (fail_mask & mask = 0) AS kept, bit_or(fail_mask & mask)::BIGINT AS bits_seen
FROM ledger, (VALUES {_POLICY_ROWS}) p(policy, rule, bit, mask) GROUP BY policy, rule
"""

LINE_WINDOWS = f"""
WITH lines AS MATERIALIZED (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS i FROM documents),
windows AS MATERIALIZED (
  SELECT doc_id, i, line AS a, lead(line, 1) OVER o AS b, lead(line, 2) OVER o AS c FROM lines WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
ranked AS (
  SELECT doc_id, i, row_number() OVER (PARTITION BY a, b, c ORDER BY doc_id, i) AS place
  FROM windows WHERE c IS NOT NULL AND regexp_matches(a || b || c, '{WORDS}')),
gone AS MATERIALIZED (SELECT DISTINCT doc_id, i + k AS i FROM ranked, range(3) r(k) WHERE place > 1),
kept AS (
  SELECT l.doc_id, count(g.i) AS n_removed_lines, coalesce(string_agg(line, chr(10) ORDER BY l.i) FILTER (g.i IS NULL), '') AS text
  FROM lines l LEFT JOIN gone g ON l.doc_id = g.doc_id AND l.i = g.i GROUP BY l.doc_id)
SELECT d.doc_id, coalesce(n_removed_lines, 0)::BIGINT AS n_removed_lines, length(CASE WHEN d.text IS NULL THEN NULL ELSE k.text END)::BIGINT AS n_chars_left,
       md5(CASE WHEN d.text IS NULL THEN NULL ELSE k.text END) AS text_md5
FROM documents d LEFT JOIN kept k USING (doc_id)
"""

NEAR_DUPLICATES = f"""
WITH RECURSIVE words AS MATERIALIZED (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), {CAPITALS}), '{WORDS}') AS w FROM documents),
sets AS MATERIALIZED (
  SELECT doc_id, list_sort(list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) = 1 THEN [w[1]]
         ELSE list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) END)) AS s FROM words),
classes AS MATERIALIZED (SELECT s, min(doc_id) AS id, len(s) AS n FROM sets WHERE len(s) > 0 GROUP BY s),
items AS MATERIALIZED (SELECT id, n, unnest(s) AS x FROM classes),
edges AS MATERIALIZED (
  SELECT a.id AS u, b.id AS v FROM items a JOIN items b ON a.x = b.x AND a.id < b.id AND 100 * a.n >= 80 * b.n AND 100 * b.n >= 80 * a.n
  GROUP BY a.id, b.id, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))),
both_ways AS MATERIALIZED (SELECT u, v FROM edges UNION SELECT v, u FROM edges),
reach AS (SELECT u AS id, u AS other FROM both_ways UNION SELECT r.id, b.v FROM reach r JOIN both_ways b ON r.other = b.u),
least AS (SELECT id, min(other) AS component FROM reach GROUP BY id)
SELECT s.doc_id, len(s.s)::BIGINT AS n_shingles, coalesce(l.component, c.id, s.doc_id)::BIGINT AS component_id, s.doc_id = coalesce(l.component, c.id, s.doc_id) AS kept
FROM sets s LEFT JOIN classes c ON s.s = c.s AND len(s.s) > 0 LEFT JOIN least l ON c.id = l.id
"""


def _mixture() -> str:
    """Targets, ROUNDS rounds of raking one dimension after the other, the scale, and the decisions."""
    dims = mixing.DIMENSIONS
    parts = [f"""
WITH counted AS MATERIALIZED (
  SELECT doc_id, coalesce(source, '') AS source, coalesce(lang, '') AS lang, coalesce(text, '') AS text,
         len(regexp_extract_all(coalesce(text, ''), '{WORDS}'))::BIGINT AS n_tokens,
         length(coalesce(text, '')) - length(replace(coalesce(text, ''), chr(10), '')) + 1 AS lines FROM documents),
docs AS MATERIALIZED (
  SELECT *, CASE WHEN n_tokens < 60 THEN 'note' WHEN n_tokens >= 1200 THEN 'long' WHEN n_tokens < 25 * lines THEN 'list' ELSE 'prose' END AS topic FROM counted),
cells AS MATERIALIZED (SELECT source, lang, topic, sum(n_tokens)::DOUBLE AS tokens FROM docs WHERE n_tokens > 0 GROUP BY ALL),
whole AS MATERIALIZED (SELECT sum(tokens) AS total FROM cells)"""]
    for d in dims:
        parts.append(f"t_{d} AS MATERIALIZED (SELECT {d}, r / sum(r) OVER () AS target FROM (SELECT {d}, sum(tokens) ** {mixing.TEMPER} AS r FROM cells GROUP BY {d}))")
        parts.append(f"f_{d}_0 AS MATERIALIZED (SELECT {d}, 1.0::DOUBLE AS factor FROM t_{d})")
    now = {d: f"f_{d}_0" for d in dims}
    for r in range(1, mixing.ROUNDS + 1):
        for d in dims:
            others = [o for o in dims if o != d]
            joins = " ".join(f"JOIN {now[o]} {o}_f USING ({o})" for o in others)
            parts.append(f"f_{d}_{r} AS MATERIALIZED (SELECT c.{d}, any_value(t.target) * (SELECT total FROM whole) / sum(tokens * {' * '.join(f'{o}_f.factor' for o in others)}) AS factor "
                         f"FROM cells c {joins} JOIN t_{d} t ON t.{d} = c.{d} GROUP BY c.{d})")
            now[d] = f"f_{d}_{r}"
    joins = " ".join(f"JOIN {now[d]} {d}_f USING ({d})" for d in dims)
    parts.append(f"rated AS MATERIALIZED (SELECT source, lang, topic, tokens, {' * '.join(f'{d}_f.factor' for d in dims)} AS ratio FROM cells {joins})")
    parts.append(f"""steps AS (
  SELECT ratio, ({mixing.BUDGET} * (SELECT total FROM whole) - coalesce(sum(tokens) OVER (ORDER BY ratio DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
         / sum(tokens * ratio) OVER (ORDER BY ratio DESC ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS scale FROM rated),
chosen AS MATERIALIZED (SELECT scale FROM steps WHERE ratio * scale < 1 ORDER BY ratio DESC LIMIT 1),
final AS MATERIALIZED (SELECT *, least(1.0, ratio * (SELECT scale FROM chosen)) AS probability FROM rated)
SELECT d.doc_id, d.source, d.lang, d.topic, d.n_tokens, round(CASE WHEN n_tokens > 0 THEN ratio ELSE 0 END, 5) AS weight,
       round(CASE WHEN n_tokens > 0 THEN probability ELSE 0 END, 5) AS probability,
       ('0x' || substr(md5('1:' || coalesce(d.doc_id::VARCHAR, '')), 1, 12))::BIGINT::DOUBLE / {1 << 48}::DOUBLE < CASE WHEN n_tokens > 0 THEN probability ELSE 0 END AS kept
FROM docs d LEFT JOIN final f ON d.source = f.source AND d.lang = f.lang AND d.topic = f.topic""")
    return ",\n".join(parts)


MIXTURE = _mixture()


def _manifest(levels: int = 9, arity: int = 8) -> str:
    """`levels` levels of the trees of the languages and of the tree of their roots; a level with one node stays."""
    # The crc32 is linear but for its start and end: entry b of the byte-wise table comes from the crc32 of the byte b ^ 255.
    table = [zlib.crc32(bytes([b ^ 255])) ^ 0xFFFFFFFF ^ 0x00FFFFFF for b in range(256)]
    said = lambda c: f"CASE WHEN {c} IS NULL THEN '-' ELSE strlen({c}::VARCHAR) || ':' || {c}::VARCHAR END"
    fields = lambda text: "sha256(" + " || ".join(said(c) for c in ("doc_id", "source", "lang", "n_chars", text)) + ")"
    parts = [f"""
WITH docs AS MATERIALIZED (SELECT *, translate(text, {CAPITALS}) AS lowered, [{", ".join(map(str, table))}] AS crc FROM documents),
leaves AS MATERIALIZED (
  SELECT doc_id, lang, {fields("text")} AS leaf,
         list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(doc_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT)),
                     lambda c, b: xor(c >> 8, crc[(xor(c, b) & 255) + 1]::BIGINT)) AS crc32, {fields("lowered")} AS other
  FROM docs),
n0 AS MATERIALIZED (
  SELECT lang AS tree, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, leaf AS h, doc_id, leaf,
         CASE WHEN xor(crc32, 4294967295) % 3 = 0 THEN other END AS other FROM leaves),
docs_0 AS MATERIALIZED (SELECT doc_id, tree, leaf, pos, '' AS proof, coalesce(other, leaf) AS folded FROM n0)"""]

    def level(nodes: str, docs: str, above: str, docs_above: str) -> None:
        group = f"(PARTITION BY tree, pos // {arity} ORDER BY pos ROWS BETWEEN"
        parts.append(f"""{nodes}_s AS MATERIALIZED (SELECT tree, pos, h, count(*) OVER (PARTITION BY tree) AS total,
  coalesce(string_agg(h, '') OVER {group} UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS before,
  coalesce(string_agg(h, '') OVER {group} 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS after FROM {nodes})""")
        parts.append(f"""{above} AS MATERIALIZED (SELECT tree, CASE WHEN total = 1 THEN 0 ELSE pos // {arity} END AS pos,
  CASE WHEN any_value(total) = 1 THEN any_value(h) ELSE sha256(string_agg(h, '' ORDER BY pos)) END AS h FROM {nodes}_s GROUP BY 1, CASE WHEN total = 1 THEN 0 ELSE pos // {arity} END)""")
        parts.append(f"""{docs_above} AS MATERIALIZED (SELECT d.* EXCLUDE (pos, proof, folded), d.pos // {arity} AS pos, proof || before || after AS proof,
  CASE WHEN total = 1 THEN folded ELSE sha256(before || folded || after) END AS folded
  FROM {docs} d JOIN {nodes}_s s ON d.tree IS NOT DISTINCT FROM s.tree AND d.pos = s.pos)""")

    for k in range(levels):
        level(f"n{k}", f"docs_{k}", f"n{k + 1}", f"docs_{k + 1}")
    parts.append(f"m0 AS MATERIALIZED (SELECT 0 AS tree, tree AS lang, row_number() OVER (ORDER BY tree NULLS FIRST) - 1 AS pos, h FROM n{levels})")
    parts.append(f"""roots_0 AS MATERIALIZED (SELECT doc_id, leaf, 0 AS tree, h AS subroot, m.pos, proof, folded
  FROM docs_{levels} d JOIN m0 m ON d.tree IS NOT DISTINCT FROM m.lang)""")
    for k in range(levels):
        level(f"m{k}", f"roots_{k}", f"m{k + 1}", f"roots_{k + 1}")
    return ",\n".join(parts) + f"""
SELECT doc_id, leaf, subroot, h AS root, sha256(proof) AS proof_sha256, folded AS folded_root, folded = h AS verified FROM roots_{levels} JOIN m{levels} USING (tree)"""


MANIFEST = _manifest()
