"""DuckDB SQL for those operators that SQL can express, written from the operators' own rules and fixed values."""

from __future__ import annotations

from tradeloom.llm import licenses as lic
from tradeloom.llm import quality as q
from tradeloom.llm import secrets as sec

#: A document's words, from whole texts; rid tells repeated rows apart.
WORDS = r"""
docs AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents),
worded AS (SELECT rid, doc_id, t, list_filter(string_split_regex(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM docs)"""


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def quality(rules: q.Rules = q.Rules()) -> str:
    lost = lambda x, chars: f"(length({x}) - length(translate({x}, {_quoted(chars)}, '')))"
    return rf"""
WITH {WORDS},
windows AS (
  SELECT rid, p, w[p] || ' ' || w[p + 1] || ' ' || w[p + 2] AS g
  FROM (SELECT rid, w, unnest(range(1, len(w) - 1)) AS p FROM worded WHERE len(w) > 2)),
twice AS (SELECT rid, p FROM windows QUALIFY count(*) OVER (PARTITION BY rid, g) > 1),
covered AS (
  SELECT rid, count(DISTINCT p + o) AS n_repeat_words FROM twice, (SELECT unnest([0, 1, 2]) AS o) GROUP BY rid),
lines AS (
  SELECT rid, l, len(list_filter(string_split_regex(l, '[\x20\x09-\x0D]+'), lambda x: x <> '')) AS n
  FROM (SELECT rid, unnest(string_split(t, chr(10))) AS l FROM docs)),
judged AS (
  SELECT rid, l, n, (NOT regexp_matches(l, {_quoted(q.SENTENCE_END)})
      AND NOT (n >= {rules.long_words} AND regexp_matches(l, {_quoted(q.SENTENCE_INSIDE)})))
    OR 100 * ({lost('l', q.SYMBOLS)}
              + {lost("regexp_replace(l, '[!?]{2,}', '##', 'g')", '#')} - {lost('l', '#')}) > {rules.max_marks_pct} * n
    OR ({lost('l', q.SEPARATORS)} >= {rules.min_separators}
        AND n <= {rules.max_entry_words} * ({lost('l', q.SEPARATORS)} + 1))
    OR (n <= {rules.max_stock_words} AND regexp_matches(lower(l), {_quoted('|'.join(q.STOCK_PHRASES))})) AS fails
  FROM lines WHERE n > 0),
per_doc AS (
  SELECT rid, count(*) - count(DISTINCT l) AS n_dup_lines, count(*) AS n_lines,
         count(*) FILTER (NOT fails) AS n_clean_lines, coalesce(sum(n) FILTER (NOT fails), 0) AS n_clean_words
  FROM judged GROUP BY rid),
counted AS (
  SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words,
         length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g')) AS word_chars, {lost('t', q.SYMBOLS)} AS n_symbols,
         coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words,
         coalesce(n_lines, 0) AS n_lines, coalesce(n_clean_lines, 0) AS n_clean_lines,
         CAST(coalesce(n_clean_words, 0) AS BIGINT) AS n_clean_words
  FROM worded LEFT JOIN per_doc USING (rid) LEFT JOIN covered USING (rid))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < {rules.min_words} OR 100 * n_repeat_words > {rules.max_repeat_pct} * n_words AS base_failed,
       NOT (n_words < {rules.min_words} OR 100 * n_repeat_words > {rules.max_repeat_pct} * n_words
            OR 100 * (n_words - n_clean_words) > {rules.max_lost_pct} * n_words) AS kept,
       n_lines, n_clean_lines, n_clean_words
FROM counted"""


def secrets(rules: tuple[sec.Rule, ...] = sec.RULES) -> str:
    parts = []
    for rank, rule in enumerate(rules):
        pattern = _quoted(rule.pattern)
        parts.append(rf"""
  SELECT rid, {rank} AS rank, '{rule.kind}' AS kind, gaps, own, held, {rule.min_length} AS least
  FROM (SELECT rid, string_split_regex(t, {pattern}) AS gaps, regexp_extract_all(t, {pattern}, 0) AS own,
               regexp_extract_all(t, {pattern}, {rule.group}) AS held FROM docs)
  WHERE len(own) > 0""")
    base = len(sec.BASE_RULES)
    return rf"""
WITH docs AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents),
matched AS ({' UNION ALL '.join(parts)}),
steps AS (
  SELECT rid, rank, kind, least, i, length(gaps[i]) AS gap, length(own[i]) AS len, length(held[i]) AS held_len
  FROM (SELECT *, unnest(range(1, len(own) + 1)) AS i FROM matched)),
placed AS (
  SELECT rid, rank, kind, held_len >= least AS passes, len,
         sum(gap + len) OVER (PARTITION BY rid, rank ORDER BY i) AS stop
  FROM steps),
spans AS (
  SELECT rid, rank, kind, CAST(stop - len AS BIGINT) AS start, CAST(stop AS BIGINT) AS stop FROM placed WHERE passes),
texts AS (
  SELECT rid, {', '.join(f"count(*) FILTER (rank = {i}) AS n_{r.kind}" for i, r in enumerate(sec.BASE_RULES))},
         string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, rank) AS spans,
         string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, rank) FILTER (rank < {base}) AS base
  FROM spans GROUP BY rid)
SELECT doc_id, {', '.join(f"coalesce(n_{r.kind}, 0) AS n_{r.kind}" for r in sec.BASE_RULES)},
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM docs LEFT JOIN texts USING (rid)"""


def licenses(threshold: float = 0.8) -> str:
    known = lic.prepared(threshold=threshold)
    rows = ",\n".join(
        f"({i}, {_quoted(t.license)}, [{', '.join(map(_quoted, t.bigrams))}], {t.low}, {t.high})" for i, t in enumerate(known)
    )
    return rf"""
WITH templates(place, license, own, low, high) AS (VALUES {rows}),
docs AS (SELECT row_number() OVER () AS rid, doc_id, lower(coalesce(text, '')) AS t FROM documents),
units AS (
  SELECT DISTINCT rid, u FROM (
    SELECT rid, unnest(string_split(t, chr(10))) AS u FROM docs
    UNION ALL SELECT rid, unnest(string_split_regex(t, '\n[ \t\x0b\f\r]*\n')) FROM docs
    UNION ALL SELECT rid, t FROM docs)),
worded AS (
  SELECT rid, list_filter(string_split_regex(u, '[^a-z0-9]+'), lambda x: x <> '') AS w, row_number() OVER () AS uid FROM units),
paired AS (
  SELECT rid, uid, list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS b
  FROM worded WHERE len(w) > {min(t.low for t in known)}),
scored AS (
  SELECT rid, uid, place, license, 2.0::DOUBLE * len(list_intersect(b, own)) / (len(b) + len(own)) AS dice
  FROM paired JOIN templates ON len(b) BETWEEN low AND high),
matches AS (
  SELECT * FROM scored WHERE dice >= {threshold}
  QUALIFY row_number() OVER (PARTITION BY uid ORDER BY dice DESC, place) = 1),
best AS (
  SELECT rid, arg_max(license, (dice, -place)) AS license, max(dice) AS dice, count(*) AS n_matches,
         string_agg(DISTINCT license, ',' ORDER BY license) AS licenses
  FROM matches GROUP BY rid)
SELECT doc_id, license, coalesce(dice, 0.0::DOUBLE) AS dice, coalesce(n_matches, 0) AS n_matches,
       coalesce(licenses, '') AS licenses
FROM docs LEFT JOIN best USING (rid)"""


def top_k(k: int = 5, scale: int = 256, every: int = 50) -> str:
    return rf"""
WITH whole AS (
  SELECT row_number() OVER () AS rid, vec_id, list_transform(embedding, lambda x: CAST(floor({scale} * CAST(x AS DOUBLE)) AS DOUBLE)) AS x
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT q.rid AS q, q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.x, c.x) AS BIGINT) AS score
  FROM whole q JOIN whole c ON q.vec_id % {every} = 0 AND q.vec_id <> c.vec_id),
ranked AS (
  SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank, vec_id, score FROM scored)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM ranked WHERE rank <= {k}"""


def long_repeats(window: int = 50) -> str:
    return rf"""
WITH {WORDS},
windows AS (
  SELECT rid, doc_id, p, array_to_string(list_slice(w, p, p + {window - 1}), ' ') AS g
  FROM (SELECT rid, doc_id, w, unnest(range(1, len(w) - {window - 2})) AS p FROM worded WHERE len(w) >= {window})),
first AS (SELECT g, min(doc_id) AS doc FROM windows GROUP BY g HAVING min(doc_id) < max(doc_id)),
gone AS (SELECT rid, p FROM windows JOIN first USING (g) WHERE doc_id > doc),
covered AS (SELECT DISTINCT rid, p + o AS i FROM gone, (SELECT unnest(range(0, {window})) AS o)),
placed AS (SELECT rid, i, w[i] AS word FROM (SELECT rid, w, unnest(range(1, len(w) + 1)) AS i FROM worded)),
kept AS (
  SELECT rid, string_agg(word, ' ' ORDER BY i) AS text, count(*) AS n
  FROM placed ANTI JOIN covered USING (rid, i) GROUP BY rid)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(text, '')) AS kept_sha256
FROM worded LEFT JOIN kept USING (rid)"""


def near_copies(words: int = 3, percent: int = 85) -> str:
    """All pairs that share a shingle, counted exactly, then components by repeated least labels."""
    return rf"""
WITH RECURSIVE docs AS (
  SELECT row_number() OVER () AS rid, doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
  FROM documents),
worded AS (SELECT rid, doc_id, list_filter(string_split_regex(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM docs),
shingles AS (
  SELECT DISTINCT rid, doc_id, array_to_string(list_slice(w, p, p + {words - 1}), ' ') AS g
  FROM (SELECT rid, doc_id, w, unnest(CASE WHEN len(w) >= {words} THEN range(1, len(w) - {words - 2}) WHEN len(w) > 0 THEN [1] ELSE [] END) AS p FROM worded)),
sizes AS (SELECT rid, doc_id, count(*) AS n FROM shingles GROUP BY rid, doc_id),
sets AS (SELECT rid, string_agg(g, chr(10) ORDER BY g) AS key FROM shingles GROUP BY rid),
classes AS (SELECT min(rid) AS rid, min(doc_id) AS doc_id, key FROM sets JOIN sizes USING (rid) GROUP BY key),
own AS (SELECT s.g, c.doc_id, z.n FROM classes c JOIN shingles s USING (rid) JOIN sizes z USING (rid)),
links AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM own a JOIN own b ON a.g = b.g AND a.doc_id < b.doc_id
   AND 100 * least(a.n, b.n) >= {percent} * greatest(a.n, b.n)
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= {percent} * (a.n + b.n - count(*))),
ways AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
reached(a, b) AS (SELECT doc_id, doc_id FROM classes UNION SELECT r.a, w.b FROM reached r JOIN ways w ON r.b = w.a),
labels AS (SELECT a AS doc_id, min(b) AS label FROM reached GROUP BY a),
found AS (SELECT s.rid, l.label FROM sets s JOIN classes c USING (key) JOIN labels l ON l.doc_id = c.doc_id)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, coalesce(label, d.doc_id) AS component_id,
       d.doc_id = coalesce(label, d.doc_id) AS kept
FROM docs d LEFT JOIN sizes z ON z.rid = d.rid LEFT JOIN found f ON f.rid = d.rid"""


def centroids(k: int = 16, rounds: int = 3, scale: int = 64, width: int = 64) -> str:
    """Lloyd's rounds over components as rows."""
    below = "(s - ((s % n) + n) % n) // n"  # the floor, where division cuts towards zero
    steps = [
        f"""
kept AS MATERIALIZED (
  SELECT row_number() OVER () AS rid, vec_id, [CAST(floor({scale} * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS v FROM embeddings
  WHERE len(embedding) = {width}
    AND coalesce(list_bool_and([x IS NOT NULL AND NOT isnan(x) AND NOT isinf(x) FOR x IN embedding]), false)),
cells AS MATERIALIZED (SELECT rid, unnest(range(1, {width + 1})) AS i, unnest(v) AS x FROM kept),
first AS (
  SELECT v, row_number() OVER (ORDER BY sha256('1:' || CAST(vec_id AS VARCHAR)), v) - 1 AS c
  FROM kept WHERE vec_id IS NOT NULL QUALIFY c < {k}),
c0 AS (SELECT c, unnest(range(1, {width + 1})) AS i, unnest(v) AS m FROM first)"""
    ]
    for r in range(rounds + 1):
        steps.append(
            f"""
a{r} AS MATERIALIZED (
  SELECT rid, min_by(c, (d, c)) AS c, min(d) AS d
  FROM (SELECT rid, c, CAST(sum((x - m) * (x - m)) AS BIGINT) AS d FROM cells JOIN c{r} USING (i) GROUP BY rid, c) GROUP BY rid)"""
        )
        if r < rounds:
            steps.append(
                f"""
s{r} AS (SELECT c, i, sum(x) AS s, CAST(count(*) AS HUGEINT) AS n FROM cells JOIN a{r} USING (rid) GROUP BY c, i),
c{r + 1} AS MATERIALIZED (
  SELECT c, i, coalesce(CAST({below} AS BIGINT), m) AS m FROM c{r} LEFT JOIN s{r} USING (c, i))"""
            )
    steps.append(
        f"""
digests AS (SELECT c, sha256(string_agg(CAST(m AS VARCHAR), ',' ORDER BY i)) AS h FROM c{rounds} GROUP BY c)"""
    )
    return f"""
WITH {",".join(steps)}
SELECT vec_id, CAST(a.c AS INTEGER) AS cluster, a.d AS distance,
       CAST(sum(a.d) OVER (PARTITION BY a.c) AS BIGINT) AS cluster_inertia, CAST(sum(a.d) OVER () AS BIGINT) AS inertia,
       h AS centroid_sha256
FROM a{rounds} a JOIN kept USING (rid) JOIN digests ON digests.c = a.c"""


#: The checksum of decimal digits, byte by byte, with its table made from the polynomial.
CRC32 = """
crc_table AS (SELECT list_transform(range(256), lambda b: list_reduce(range(8),
  lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, b)) AS t)"""


def _crc32(value: str) -> str:
    digits = f"list_transform(string_split(CAST({value} AS VARCHAR), ''), lambda d: CAST(ord(d) AS BIGINT))"
    return f"xor(list_reduce({digits}, lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]), 4294967295), 4294967295)"


def manifest(levels: int = 8, root_levels: int = 3) -> str:
    """The trees level by level; as many levels as stated, which hold 8 to that power of rows a language (and of languages)."""
    part = lambda c: f"CASE WHEN {c} IS NULL THEN '-' ELSE strlen(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR) END"
    leaf = lambda text: "sha256(" + " || ".join(part(c) for c in ("doc_id", "source", "lang", "n_chars", text)) + ")"
    lower = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    steps = [
        f"""{CRC32},
leaves AS MATERIALIZED (
  SELECT doc_id, coalesce('1' || lang, '0') AS key, {leaf("text")} AS leaf,
         CASE WHEN {_crc32("doc_id")} % 3 = 0 THEN {leaf(lower)} END AS tampered
  FROM documents, crc_table),
rows AS MATERIALIZED (
  SELECT row_number() OVER () AS rid, *, row_number() OVER (PARTITION BY key ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos FROM leaves),
l0 AS (SELECT key, pos, leaf AS d FROM rows),
f0 AS (SELECT rid, key, pos, coalesce(tampered, leaf) AS d, '' AS proof FROM rows)"""
    ]

    def climb(tree: str, fold: str, many: int) -> None:
        for i in range(many):
            one = f"(SELECT key, count(*) AS m FROM {tree}{i} GROUP BY key)"
            steps.append(
                f"""
{tree}{i + 1} AS MATERIALIZED (
  SELECT key, pos // 8 AS pos, sha256(string_agg(d, '' ORDER BY pos)) AS d
  FROM {tree}{i} JOIN {one} USING (key) WHERE m > 1 GROUP BY key, pos // 8
  UNION ALL SELECT key, pos, d FROM {tree}{i} JOIN {one} USING (key) WHERE m = 1),
{fold}{i + 1} AS MATERIALIZED (
  SELECT rid, f.key, CASE WHEN m = 1 THEN f.pos ELSE f.pos // 8 END AS pos,
         CASE WHEN m = 1 THEN f.d ELSE sha256(array_to_string([CASE WHEN x.pos = f.pos THEN f.d ELSE x.d END FOR x IN run], '')) END AS d,
         proof || CASE WHEN m = 1 THEN '' ELSE array_to_string([x.d FOR x IN run IF x.pos <> f.pos], '') END AS proof
  FROM {fold}{i} f JOIN {one} o ON o.key = f.key
  JOIN (SELECT key, pos // 8 AS p, list({{'pos': pos, 'd': d}} ORDER BY pos) AS run FROM {tree}{i} GROUP BY key, pos // 8) r
    ON r.key = f.key AND r.p = f.pos // 8)"""
            )

    climb("l", "f", levels)
    steps.append(
        f"""
subroots AS (SELECT key AS lang, d AS subroot, row_number() OVER (ORDER BY key) - 1 AS pos FROM l{levels}),
r0 AS (SELECT 0 AS key, pos, subroot AS d FROM subroots),
g0 AS (SELECT rid, 0 AS key, s.pos, d, proof FROM f{levels} f JOIN subroots s ON s.lang = f.key)"""
    )
    climb("r", "g", root_levels)
    return f"""
WITH {",".join(steps)}
SELECT doc_id, leaf, subroot, r.d AS root, sha256(proof) AS proof_sha256, g.d AS folded_root, g.d = r.d AS verified
FROM g{root_levels} g JOIN rows USING (rid) JOIN subroots s ON s.lang = rows.key, r{root_levels} r"""
