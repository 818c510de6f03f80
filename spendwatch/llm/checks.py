"""SQL for the text queries that SQL can express."""

from __future__ import annotations

from spendwatch.llm import divergence, ownership

WORDS = "[^\\x20\\x09-\\x0D]+"
LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def repeats_sql(size: int) -> str:
    return f"""
WITH w AS MATERIALIZED (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{WORDS}') AS ws FROM documents),
win AS MATERIALIZED (SELECT doc_id, i, array_to_string(ws[i:i + {size - 1}], ' ') AS s FROM (SELECT *, unnest(range(1, len(ws) - {size - 2})) AS i FROM w)),
early AS (SELECT s, min(doc_id) AS least FROM win GROUP BY s),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + {size})) AS p FROM win JOIN early USING (s) WHERE doc_id > least),
each_word AS (SELECT doc_id, unnest(ws) AS x, generate_subscripts(ws, 1) AS p FROM w),
kept AS (SELECT doc_id, string_agg(x, ' ' ORDER BY p) AS t, count(*) AS n FROM each_word ANTI JOIN gone USING (doc_id, p) GROUP BY 1)
SELECT w.doc_id, len(ws)::BIGINT AS n_words, (len(ws) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM w LEFT JOIN kept ON kept.doc_id = w.doc_id"""


def contamination_sql(size: int) -> str:
    words = f"regexp_extract_all(coalesce({LOWER}, ''), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
    return f"""
WITH b AS (SELECT item_id, {words} AS ws FROM benchmark),
items AS MATERIALIZED (SELECT item_id, len(ws) AS k, array_to_string(ws, ' ') AS s FROM b WHERE len(ws) BETWEEN 1 AND {size - 1}
  UNION ALL SELECT item_id, {size}, array_to_string(ws[i:i + {size - 1}], ' ') FROM (SELECT *, unnest(range(1, len(ws) - {size - 2})) AS i FROM b)),
w AS MATERIALIZED (SELECT doc_id, {words} AS ws FROM documents),
win AS (SELECT doc_id, k, i, array_to_string(ws[i:i + k - 1], ' ') AS s
  FROM (SELECT doc_id, ws, k, unnest(range(1, len(ws) - k + 2)) AS i FROM w, (SELECT DISTINCT k FROM items))),
met AS MATERIALIZED (SELECT win.doc_id, win.i, win.k, items.item_id FROM win JOIN items ON win.k = items.k AND win.s = items.s),
hits AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + k)) AS p FROM met) GROUP BY 1),
named AS (SELECT doc_id, count(*) AS n, string_agg(v, ',' ORDER BY v) AS t FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS v FROM met WHERE item_id IS NOT NULL) GROUP BY 1)
SELECT w.doc_id, len(ws)::BIGINT AS n_words, coalesce(hits.n, 0) AS n_hit, coalesce(named.n, 0) AS n_items, sha256(coalesce(t, '')) AS items_sha256,
  coalesce(hits.n, 0) > 0 AS contaminated
FROM w LEFT JOIN hits ON hits.doc_id = w.doc_id LEFT JOIN named ON named.doc_id = w.doc_id"""


def quality_sql() -> str:
    d = divergence
    of_class = [f"length(t) - length(regexp_replace(t, '{c}', '', 'g'))" for c in d.CLASSES]
    common = [f"len(list_filter(ws, lambda x: x = '{w}'))" for w in d.WORDS]
    listed = ", ".join(f"'{w}'" for w in d.WORDS)
    fixed = ", ".join(f"'{x}'" for x in d.LANGUAGES)
    sums = lambda name, n: "[" + ", ".join(f"sum({name}[{k + 1}])" for k in range(n)) + "]"

    def distance(name: str) -> str:
        half = "CASE WHEN {x} > 0 THEN {x} * log2({x} / (({p} + {q}) / 2)) ELSE 0 END"
        p, q = f"(c.{name}[k] / list_sum(c.{name}))", f"(r.{name}[k] / list_sum(r.{name}))"
        both = half.format(x=p, p=p, q=q) + " + " + half.format(x=q, p=p, q=q)
        return f"""CASE WHEN list_sum(c.{name}) > 0 AND list_sum(r.{name}) > 0
            THEN sqrt(greatest(list_sum(list_transform(range(1, len(c.{name}) + 1), lambda k: {both})) / 2, 0)) ELSE 1 END"""

    return f"""
WITH t0 AS (SELECT doc_id, lang, coalesce(text, '') AS t FROM documents),
t1 AS MATERIALIZED (SELECT *, regexp_extract_all(t, '{WORDS}') AS ws, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS ls,
  [{", ".join(of_class)}] AS cs FROM t0),
win AS MATERIALIZED (SELECT doc_id, i, array_to_string(ws[i:i + 2], ' ') AS s FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 1)) AS i FROM t1)),
rep AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + 3)) AS p FROM win
  WHERE (doc_id, s) IN (SELECT doc_id, s FROM win GROUP BY 1, 2 HAVING count(*) > 1)) GROUP BY 1),
m AS MATERIALIZED (SELECT t1.doc_id, lang, len(ws)::BIGINT AS n_words, (length(t) - cs[{d.SPACE + 1}])::BIGINT AS word_chars, cs[{d.SYMBOL + 1}]::BIGINT AS n_symbols,
  (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines, coalesce(rep.n, 0) AS n_repeat_words,
  list_append(cs, length(t) - list_sum(cs)) AS characters,
  list_append([{", ".join(common)}], len(list_filter(ws, lambda x: x NOT IN ({listed})))) AS words FROM t1 LEFT JOIN rep ON rep.doc_id = t1.doc_id),
base AS MATERIALIZED (SELECT *, n_words < {d.MIN_WORDS} OR 100 * n_repeat_words > {d.MAX_REPEATED} * n_words AS base_failed FROM m),
r AS MATERIALIZED (SELECT lang, {sums("characters", len(d.CLASSES) + 1)} AS characters, {sums("words", len(d.WORDS) + 1)} AS words FROM base
  WHERE NOT base_failed AND lang IS NOT NULL GROUP BY 1 HAVING count(*) >= {d.MIN_REFERENCE} OR lang IN ({fixed})),
far AS (SELECT c.doc_id, min({distance("characters")}) AS cd, min({distance("words")}) AS wd FROM base c JOIN r ON r.lang IN ({fixed}) OR r.lang = c.lang GROUP BY 1)
SELECT base.doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND (coalesce(cd, 1) <= {d.MAX_CHARACTER_DISTANCE} AND (coalesce(wd, 1) <= {d.MAX_COMMON_DISTANCE} OR n_words < {d.MIN_COMMON})
    OR (lang IS NOT NULL AND lang NOT IN ({fixed}) AND lang NOT IN (SELECT lang FROM r)) OR far.doc_id IS NULL) AS kept,
  round(coalesce(cd, 1), 6) AS character_distance, round(coalesce(wd, 1), 6) AS common_distance
FROM base LEFT JOIN far ON far.doc_id = base.doc_id"""


def secrets_sql() -> str:
    o = ownership
    quoted = lambda p: "'" + p.replace("'", "''") + "'"

    def spans(pattern: str, kind: int, group: int, test: str) -> str:
        p = quoted(pattern)
        gaps = "coalesce(list_sum(list_transform(g[1:i], lambda x: length(x))), 0)::BIGINT"
        hits = "coalesce(list_sum(list_transform(h[1:i - 1], lambda x: length(x))), 0)::BIGINT"
        return f"""SELECT doc_id, n, source, {kind} AS kind, a, a + length(h[i]) AS z, v[i] AS value FROM (
          SELECT *, {gaps} + {hits} AS a FROM (SELECT doc_id, n, source, g, h, v, unnest(range(1, len(h) + 1)) AS i FROM (
            SELECT doc_id, n, source, string_split_regex(t, {p}) AS g, regexp_extract_all(t, {p}) AS h, regexp_extract_all(t, {p}, {group}) AS v FROM d)))
          WHERE {test}"""

    name = "['assign', 'access', 'hex', 'live'][kind + 1] || ':' || a || ':' || z"
    short = "v[i]"
    for members, one in zip(o.CLASSES, ("A", "a", "0", "-")):
        short = f"regexp_replace({short}, '[{members}]+', '{one}', 'g')"
    often = (
        f"NOT starts_with(v[i], '{o.INLINE}') AND regexp_matches(v[i], '[0-9]') AND regexp_matches(v[i], '[a-z]') AND regexp_matches(v[i], '[A-Z]') "
        f"AND {o.OF_PLACES} * (length({short}) - 1) >= {o.CHANGES} * (length(v[i]) - 1)"
    )
    form = f"regexp_matches(v[i], '{o.KEY_FORM}') AND length(v[i]) % 4 = 0 AND {often}"
    random = (
        f"length(value) >= {o.LIVE_LENGTH} AND regexp_matches(value, '[0-9]') AND regexp_matches(value, '[A-Za-z]') "
        f"AND len(list_distinct(string_split(value, ''))) >= {o.LIVE_DIFFERENT}"
    )
    least = ", ".join(f"list_min(list_transform(x, lambda y: substr(y, {k * o.SKETCH_SIGNS + 1}, {o.SKETCH_SIGNS})))" for k in range(o.SKETCHES))
    return f"""
WITH d AS MATERIALIZED (SELECT doc_id, row_number() OVER () AS n, source, coalesce(text, '') AS t FROM documents),
base AS MATERIALIZED ({spans(o.ASSIGN, 0, 1, f"length(v[i]) >= {o.MIN_VALUE}")}
  UNION ALL {spans(o.ACCESS, 1, 0, f"length(v[i]) >= {o.MIN_ACCESS}")} UNION ALL {spans("[0-9a-f]+", 2, 0, "length(v[i]) >= 32")}),
cand AS MATERIALIZED (SELECT DISTINCT doc_id, n, source, z - length(value) AS a, z, value FROM (
  SELECT * FROM base UNION ALL {spans(o.PART, 3, 0, often)} UNION ALL {spans(o.WHOLE, 3, 0, form)})),
w AS (SELECT n, regexp_extract_all(t, '[^\\x20\\x09-\\x0D]+') AS w FROM d WHERE n IN (SELECT n FROM cand)),
digests AS (SELECT n, list_transform(CASE WHEN len(w) < {o.SHINGLE} THEN [array_to_string(w, ' ')]
  ELSE [array_to_string(w[i:i + {o.SHINGLE - 1}], ' ') FOR i IN range(1, len(w) - {o.SHINGLE - 2})] END, lambda y: md5(y)) AS x FROM w),
sketch AS MATERIALIZED (SELECT n, unnest(range({o.SKETCHES})) AS place, unnest([{least}]) AS least FROM digests),
owned AS (SELECT value, count(DISTINCT coalesce('=' || source, '')) AS owners FROM cand GROUP BY 1),
repos AS (SELECT value, min(c) AS repos FROM (SELECT value, place, count(DISTINCT least) AS c FROM cand JOIN sketch ON cand.n = sketch.n GROUP BY 1, 2) GROUP BY 1),
known AS (SELECT *, (owners > {o.COPIED_OWNERS} AND repos > {o.COPIED_REPOS}) OR repos > {o.COMMON_REPOS} AS copied FROM owned JOIN repos USING (value)),
judged AS MATERIALIZED (SELECT cand.*, owners, repos, NOT copied AND {random} AS is_live FROM cand JOIN known USING (value)),
every AS (SELECT n, kind, a, z, value FROM base UNION ALL SELECT n, 3, a, z, value FROM judged WHERE is_live),
b AS (SELECT n, count(*) FILTER (kind = 0) AS n_assign, count(*) FILTER (kind = 1) AS n_access, count(*) FILTER (kind = 2) AS n_hex,
  string_agg({name}, ',' ORDER BY a, kind) AS t FROM base GROUP BY 1),
e AS (SELECT n, string_agg({name}, ',' ORDER BY a, kind, z, value) AS t FROM every GROUP BY 1),
j AS (SELECT n, count(*) FILTER (is_live) AS n_live, count(*) FILTER (owners > 1) AS n_shared FROM judged GROUP BY 1),
s AS (SELECT n, string_agg(s, ',' ORDER BY s) AS s FROM (SELECT DISTINCT n, substr(sha256(value), 1, 16) || ':' || owners || ':' || repos AS s FROM judged) GROUP BY 1)
SELECT d.doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex, sha256(coalesce(b.t, '')) AS base_sha256,
  coalesce(e.t, '') AS spans, coalesce(n_live, 0) AS n_live, coalesce(n_shared, 0) AS n_shared, coalesce(s.s, '') AS holders
FROM d LEFT JOIN b ON b.n = d.n LEFT JOIN e ON e.n = d.n LEFT JOIN j ON j.n = d.n LEFT JOIN s ON s.n = d.n"""
