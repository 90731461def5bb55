"""DuckDB SQL of the queries that SQL can express, over the same tables."""

from __future__ import annotations

from siltstone.llm import filter_audit as filter_audit_module
from siltstone.llm import mixing, quality_rules

LIST_WORDS = "regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')"


def _divergence(own: list[str], ref: list[str]) -> str:
    total_p, total_q = " + ".join(own), " + ".join(ref)
    terms = []
    for p, q in zip(own, ref, strict=True):
        p, q = f"({p} / nullif(({total_p})::DOUBLE, 0))", f"({q} / nullif(({total_q})::DOUBLE, 0))"
        terms += [f"CASE WHEN {x} > 0 THEN {x} * log2({x} / (({p} + {q}) / 2)) / 2 WHEN {x} IS NOT NULL THEN 0 END" for x in (p, q)]
    return "sqrt(greatest(" + " + ".join(terms) + ", 0))"


def quality() -> str:
    q = quality_rules
    without = lambda pattern: "length(regexp_replace(t, '{}', '', 'g'))".format(pattern.replace("'", "''"))
    classes = ", ".join(f"length(t) - {without(p)} AS {c}" for c, p in q.CLASSES.items())
    lists = " ".join(f"WHEN '{name}' THEN {found.split()!r}" for name, found in q.COMMON.items())
    commons = ", ".join(f"coalesce(len(list_filter(known, lambda w: w = own[{k + 1}])), 0) AS h_common_{k}" for k in range(q.COMMON_COUNT))
    names = [f"h_{c}" for c in q.CHARS + q.COMMONS]
    sums = ", ".join(f"sum({n})::DOUBLE AS r{n[1:]}" for n in names)
    chars, common = [f"h_{c}" for c in q.CHARS], [f"h_{c}" for c in q.COMMONS]
    refs = lambda own: [f"r{c[1:]}" for c in own]
    rest = " - ".join(["word_chars", *q.CLASSES])
    return f"""
WITH d AS (
  SELECT row_number() OVER () AS id, doc_id, coalesce(text, '') AS t, coalesce(lang, '') AS lang, {LIST_WORDS} AS w FROM documents
), lines AS (
  SELECT id, count(*) - count(DISTINCT x) AS n_dup_lines
  FROM (SELECT id, unnest(string_split(t, chr(10))) AS x FROM d) WHERE regexp_matches(x, '[^\\x20\\x09-\\x0D]') GROUP BY id
), windows AS (
  SELECT id, i, array_to_string(w[i:i + {q.WINDOW - 1}], ' ') AS s FROM (SELECT id, w, unnest(range(1, len(w) - {q.WINDOW - 2})) AS i FROM d WHERE len(w) >= {q.WINDOW})
), twice AS (
  SELECT id, i FROM (SELECT id, i, count(*) OVER (PARTITION BY id, s) AS n FROM windows) WHERE n > 1
), repeats AS (
  SELECT id, count(DISTINCT i + k) AS n_repeat_words FROM twice, (SELECT unnest(range(0, {q.WINDOW})) AS k) GROUP BY id
), m AS (
  SELECT d.*, len(w) AS n_words, {without('[ \\t-\\r]+')} AS word_chars, length(t) AS n_chars, {classes},
    coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words, CASE lang {lists} END AS own
  FROM d LEFT JOIN lines USING (id) LEFT JOIN repeats USING (id)
), k AS (
  SELECT *, symbol AS n_symbols, n_words < {q.MIN_WORDS} OR 100 * n_repeat_words > {q.REPEAT_PERCENT} * n_words AS base_failed,
    list_filter(list_transform(w, lambda x: lower(x)), lambda x: list_contains(own, x)) AS known FROM m
), h AS (
  SELECT *, {", ".join(f"{c} AS h_{c}" for c in q.CLASSES)}, n_chars - word_chars AS h_space, {rest} AS h_other, {commons},
    CASE WHEN own IS NULL THEN 0 ELSE n_words - len(known) END AS h_common_other FROM k
), r AS (
  SELECT lang AS of_lang, {sums} FROM h
  WHERE NOT base_failed AND h_symbol * 100 <= n_chars * {q.SYMBOL_PERCENT} AND h_upper * 100 <= n_chars * {q.UPPER_PERCENT} GROUP BY lang
), j AS (
  SELECT h.*, {_divergence(chars, refs(chars))} AS dc, {_divergence(common, refs(common))} AS dw FROM h LEFT JOIN r ON h.lang = r.of_lang
)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols, n_dup_lines::BIGINT AS n_dup_lines,
  n_repeat_words::BIGINT AS n_repeat_words, base_failed,
  NOT base_failed AND NOT coalesce(dc > {q.CHAR_DISTANCE}, false) AND NOT coalesce(dw > {q.COMMON_DISTANCE} AND n_words >= {q.COMMON_MIN_WORDS}, false) AS kept
FROM j"""


def mixture(weights: dict[str, int], default: int = 1, block: int = mixing.BLOCK) -> str:
    weight = "CASE source " + " ".join(f"WHEN '{s}' THEN {w}" for s, w in weights.items()) + f" ELSE {default} END"
    named = "source IN (" + ", ".join(f"'{s}'" for s in weights) + ")"
    return f"""
WITH RECURSIVE d AS (
  SELECT doc_id, coalesce(source, '') AS source, md5(coalesce(doc_id::VARCHAR, '')) AS digest FROM documents
), s AS (
  SELECT source, n, {weight} AS weight, CASE WHEN {named} THEN '=' || source ELSE '~' END AS entity,
    CASE WHEN {named} THEN 1 ELSE count(*) FILTER (NOT {named}) OVER () END AS step,
    CASE WHEN {named} THEN 0 ELSE row_number() OVER (PARTITION BY {named} ORDER BY source) - 1 END AS nth
  FROM (SELECT source, count(*) AS n FROM d GROUP BY source)
), e AS (
  SELECT entity, sum(weight)::BIGINT AS weight FROM s GROUP BY entity
), a AS (
  SELECT list(entity ORDER BY entity) AS names, list(weight ORDER BY entity) AS ws, sum(weight)::BIGINT AS total FROM e
), fold AS (
  SELECT -1::BIGINT AS slot, list_transform((SELECT ws FROM a), lambda w: 0::BIGINT) AS turns, NULL::STRUCT(due BIGINT, i BIGINT, turn BIGINT) AS p
  UNION ALL
  SELECT slot, list_transform(turns, lambda k, i: CASE WHEN i = p.i THEN k + 1 ELSE k END), p FROM (
    SELECT slot + 1 AS slot, turns, list_min(list_filter(list_transform(turns, lambda k, i:
      CASE WHEN (k * a.total) // a.ws[i] <= slot + 1
        THEN {{'due': ((k + 1) * a.total + a.ws[i] - 1) // a.ws[i], 'i': i::BIGINT, 'turn': k}} END), lambda x: x IS NOT NULL)) AS p
    FROM fold, a WHERE slot + 1 < a.total)
), turns AS (
  SELECT a.names[p.i] AS entity, p.turn AS turn, slot FROM fold, a WHERE slot >= 0
), stop AS (
  SELECT min(blocks // weight * total + slot) AS stop FROM (SELECT *, (n + {block - 1}) // {block} AS blocks FROM s) x, a, turns
  WHERE turns.entity = x.entity AND turn = (blocks % weight) * step + nth
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY digest, doc_id) - 1 AS rank FROM d
), placed AS (
  SELECT ranked.*, weight, entity, step, nth, total, rank // {block} AS block FROM ranked JOIN s USING (source), a
)
SELECT placed.doc_id, placed.source, (block // weight * total + slot)::BIGINT AS slot, (rank % {block})::BIGINT AS place_in_block, block::BIGINT AS block,
  (block * total // weight)::BIGINT AS release, (((block + 1) * total + weight - 1) // weight)::BIGINT AS deadline, block // weight * total + slot < stop.stop AS in_mix
FROM placed JOIN turns ON turns.entity = placed.entity AND turns.turn = (block % weight) * step + nth, stop"""


def line_dedup() -> str:
    return """
WITH l AS (
  SELECT doc_id, unnest(range(0, len(x))) AS line, unnest(x) AS t FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS x FROM documents)
), s AS (
  SELECT t, min({'d': doc_id, 'l': line}) AS pos, any_value(w) AS w FROM (SELECT *, list_distinct(regexp_extract_all(t, '[^\\x20\\x09-\\x0D]+')) AS w FROM l) WHERE len(w) >= 1 GROUP BY t
), u AS (
  SELECT pos, unnest(w) AS tok, len(w) AS n FROM s
), f AS (
  SELECT tok, count(*) AS df FROM u GROUP BY tok
), p AS (
  SELECT pos, n, tok FROM (SELECT pos, n, tok, row_number() OVER (PARTITION BY pos ORDER BY df, tok) AS k FROM u JOIN f USING (tok)) WHERE k <= n - (4 * n + 4) // 5 + 1
), c AS (
  SELECT DISTINCT x.pos AS later, y.pos AS earlier FROM p x JOIN p y ON x.tok = y.tok AND y.pos < x.pos AND x.n * 5 >= y.n * 4 AND y.n * 5 >= x.n * 4
), m AS (
  SELECT DISTINCT later AS pos FROM c JOIN s a ON a.pos = later JOIN s b ON b.pos = earlier
  WHERE 9 * len(list_intersect(a.w, b.w)) >= 4 * (len(a.w) + len(b.w))
), r AS (
  SELECT l.doc_id, l.line, coalesce({'d': l.doc_id, 'l': l.line} > s.pos OR m.pos IS NOT NULL, false) AS gone FROM l LEFT JOIN s ON l.t = s.t LEFT JOIN m ON m.pos = s.pos
)
SELECT doc_id, count(*)::BIGINT AS n_lines, count(*) FILTER (gone)::BIGINT AS n_removed, coalesce(string_agg(line::VARCHAR, ',' ORDER BY line) FILTER (gone), '') AS removed
FROM r GROUP BY doc_id"""


def warc_captures() -> str:
    alphabet = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
    part = lambda k: "('0x' || substr(h, {}, 5))::BIGINT".format(5 * k + 1)
    digits = " || ".join(f"substr('{alphabet}', ((({part(k)} >> {shift}) & 31) + 1)::INT, 1)" for k in range(8) for shift in (15, 10, 5, 0))
    return f"""
WITH p AS (
  SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS payload_bytes, sha1(coalesce(html, '')) AS h,
    strftime(TIMESTAMP '2024-01-01' + to_seconds(page_id % 1000000000), '%Y%m%d%H%M%S') AS timestamp,
    string_split(regexp_replace(lower(regexp_extract(trim(url), '^[A-Za-z]+://([^/?#:]+)', 1)), '^www\\.', ''), '.') AS host,
    regexp_extract(trim(url), '^[A-Za-z]+://[^/?#]+([^?#]*)', 1) AS path, regexp_extract(trim(url), '^[^?#]*([?][^#]+)?', 1) AS query FROM pages
), k AS (
  SELECT *, array_to_string(list_reverse(host), ',') || ')' || CASE path WHEN '' THEN '/' ELSE path END || query AS urlkey FROM p
), f AS (
  SELECT *, min(page_id) OVER (PARTITION BY h) AS first,
    row_number() OVER (ORDER BY urlkey, timestamp, page_id) - 1 AS capture_place, row_number() OVER (PARTITION BY urlkey ORDER BY timestamp, page_id) - 1 AS history_place FROM k
)
SELECT page_id, payload_bytes, {digits} AS payload_digest, CASE WHEN page_id > first THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN page_id > first THEN first END AS refers_to, urlkey, timestamp, capture_place, history_place
FROM f"""


def filter_audit() -> str:
    a = filter_audit_module
    words = "regexp_extract_all(t, '[^\\x20\\x09-\\x0D]+')"
    return f"""
WITH d AS (
  SELECT row_number() OVER () AS id, doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t FROM documents
), w AS (
  SELECT *, {words} AS w, min(doc_id) OVER (PARTITION BY t) AS least FROM d
), l AS (
  SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY doc_id
), m AS (
  SELECT part, [len(w) < {a.LEAST_WORDS}, 100 * len(list_distinct(w)) < {a.LEAST_DISTINCT} * len(w), 100 * (length(t) - length(regexp_replace(t, '[A-Z]', '', 'g'))) > {a.MOST_CAPITALS} * length(t),
    regexp_matches(t, '[#$%&*|]'), coalesce(doc_id, {a.LAST}) > coalesce(least, {a.LAST})] AS fails, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic
  FROM w LEFT JOIN l USING (doc_id)
), c AS (
  SELECT part, fails, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic FROM m GROUP BY ALL
), f AS (
  SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS f
), o AS (
  SELECT [a.f, b.f, c.f, d.f, e.f] AS o FROM f a, f b, f c, f d, f e
  WHERE len(list_distinct([a.f, b.f, c.f, d.f, e.f])) = 5
), s AS (
  SELECT o, unnest(range(1, 6))::INT AS step FROM o
), x AS (
  SELECT part, array_to_string(o, '') AS filter_order, step, o[step] AS f, n, good, toxic,
    len(list_filter(o[:step - 1], lambda y: fails[ascii(y) - 64])) > 0 AS earlier, fails[ascii(o[step]) - 64] AS own, len(list_filter(fails, lambda y: y)) AS k
  FROM c, s
), r AS (
  SELECT part, filter_order, step, f, coalesce(sum(n) FILTER (NOT earlier AND NOT own), 0)::BIGINT AS kept, coalesce(sum(n) FILTER (NOT earlier AND own), 0)::BIGINT AS removed,
    coalesce(sum(n) FILTER (earlier AND own), 0)::BIGINT AS redundant, coalesce(sum(n) FILTER (own AND k = 1), 0)::BIGINT AS unique_fails,
    coalesce(sum(good) FILTER (NOT earlier AND own), 0)::BIGINT AS good_lost, coalesce(sum(toxic) FILTER (NOT earlier AND own), 0)::BIGINT AS toxic_lost
  FROM x GROUP BY ALL
)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, (sum(removed) OVER (PARTITION BY part, f))::BIGINT AS shapley FROM r"""
