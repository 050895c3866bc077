"""DuckDB SQL for the queries of the subpackage that SQL can express."""

from __future__ import annotations

ORACLES: dict[str, str] = {}

ORACLES["op10_quality_rules"] = r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, lang, source, coalesce(text, '') AS t FROM documents
), w AS (
  SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws,
         list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM d
), win AS (
  SELECT rid, i, list_slice(ws, i, i + 7) AS g FROM (SELECT rid, ws, unnest(range(1, len(ws) - 6)) AS i FROM w)
), twice AS (
  SELECT rid, g FROM win GROUP BY ALL HAVING count(*) > 1
), rep AS (
  SELECT rid, count(DISTINCT p) AS n FROM (
    SELECT win.rid, unnest(range(i, i + 8)) AS p FROM win JOIN twice ON win.rid = twice.rid AND win.g = twice.g)
  GROUP BY rid
), c AS (
  SELECT w.rid, doc_id, lang, source, CAST(len(ws) AS BIGINT) AS n_words,
         CAST(coalesce(list_sum(list_transform(ws, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
         CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
         CAST(coalesce(rep.n, 0) AS BIGINT) AS n_repeat_words, CAST(len(lines) AS BIGINT) AS n_lines
  FROM w LEFT JOIN rep ON w.rid = rep.rid
), m AS (
  SELECT *, (1000 * n_symbols) // greatest(word_chars, 1) AS symbols_permille,
         (1000 * n_dup_lines) // greatest(n_lines, 1) AS dup_lines_permille,
         (1000 * n_repeat_words) // greatest(n_words, 1) AS repeat_permille,
         (10 * word_chars) // greatest(n_words, 1) AS word_len_tenths,
         n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM c
), u AS (
  SELECT DISTINCT d.lang, d.source, d.t, base_failed, symbols_permille, dup_lines_permille, repeat_permille, word_len_tenths
  FROM m JOIN d ON m.rid = d.rid
), e AS (
  SELECT lang, source, base_failed, unnest([{'k': 's', 'v': symbols_permille}, {'k': 'd', 'v': dup_lines_permille},
                               {'k': 'r', 'v': repeat_permille}, {'k': 'l', 'v': word_len_tenths}]) AS x FROM u
), b AS (
  SELECT lang, source, CAST(NOT base_failed AS INT) AS ok, x.k AS k, (x.v >> greatest(length(bin(x.v)) - 6, 0)) << greatest(length(bin(x.v)) - 6, 0) AS b
  FROM e
), s AS (
  SELECT 0 AS lvl, lang, source, k, b, sum(ok) AS n FROM b GROUP BY ALL
  UNION ALL SELECT 1, lang, NULL, k, b, sum(ok) FROM b GROUP BY ALL
  UNION ALL SELECT 2, NULL, NULL, k, b, sum(ok) FROM b GROUP BY ALL
), r AS (
  SELECT *, sum(n) OVER (PARTITION BY lvl, lang, source, k ORDER BY b) AS upto,
         sum(n) OVER (PARTITION BY lvl, lang, source, k) AS total FROM s
), q AS (
  SELECT lvl, lang, source, k, any_value(total) AS total, min(b) FILTER (4 * upto >= total) AS q1,
         min(b) FILTER (4 * upto >= 3 * total) AS q3 FROM r GROUP BY lvl, lang, source, k
), f AS (
  SELECT lvl, lang, source, k, total,
         q3 + 3 * greatest(q3 - q1, CASE k WHEN 's' THEN 10 WHEN 'd' THEN 80 WHEN 'r' THEN 60 ELSE 5 END) AS fence FROM q
), p AS (
  SELECT o.lang, o.source, o.k,
         CASE WHEN o.total >= 100 THEN o.fence WHEN g.total >= 100 THEN g.fence ELSE a.fence END AS fence
  FROM f o JOIN f g ON g.lvl = 1 AND o.k = g.k AND o.lang IS NOT DISTINCT FROM g.lang
  JOIN f a ON a.lvl = 2 AND o.k = a.k WHERE o.lvl = 0
), x AS (
  SELECT lang, source, CAST(max(fence) FILTER (k = 's') AS BIGINT) AS max_symbols_permille,
         CAST(max(fence) FILTER (k = 'd') AS BIGINT) AS max_dup_lines_permille,
         CAST(max(fence) FILTER (k = 'r') AS BIGINT) AS max_repeat_permille,
         CAST(max(fence) FILTER (k = 'l') AS BIGINT) AS max_word_len_tenths FROM p GROUP BY lang, source
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       base_failed, NOT base_failed AND symbols_permille <= max_symbols_permille
         AND dup_lines_permille <= max_dup_lines_permille AND repeat_permille <= max_repeat_permille
         AND word_len_tenths <= max_word_len_tenths AS kept,
       symbols_permille, dup_lines_permille, repeat_permille, word_len_tenths,
       max_symbols_permille, max_dup_lines_permille, max_repeat_permille, max_word_len_tenths
FROM m JOIN x ON m.lang IS NOT DISTINCT FROM x.lang AND m.source IS NOT DISTINCT FROM x.source
"""

ORACLES["op2_warc_index"] = r"""
WITH p AS (
  SELECT page_id, coalesce(html, '') AS h, split_part(coalesce(url, ''), '#', 1) AS u FROM pages
), r AS (
  SELECT *, CASE WHEN contains(u, '://') THEN substr(u, strpos(u, '://') + 3) ELSE u END AS rest FROM p
), s AS (
  SELECT *, split_part(rest, '/', 1) AS host, substr(rest, length(split_part(rest, '/', 1)) + 1) AS path FROM r
), n AS (
  SELECT *, lower(list_last(string_split(host, '@'))) AS hp FROM s
), l AS (
  SELECT *, string_split(split_part(hp, ':', 1), '.') AS labels,
         CASE WHEN contains(hp, ':') THEN substr(hp, strpos(hp, ':') + 1) ELSE '' END AS port FROM n
), k AS (
  SELECT page_id, h, sha1(h) AS hex,
         array_to_string(list_reverse(CASE WHEN len(labels) > 1 AND labels[1] = 'www' THEN labels[2:] ELSE labels END), ',')
         || CASE WHEN port IN ('', '80', '443') THEN '' ELSE ':' || port END || ')'
         || CASE WHEN path = '' THEN '/' ELSE path END AS url_key,
         strftime(make_timestamp((1700000000 + page_id) * 1000000), '%Y-%m-%dT%H:%M:%SZ') AS captured FROM l
), b AS (
  SELECT *, array_to_string(list_transform(string_split(hex, ''), lambda c: lpad(bin(CAST('0x' || c AS INT)), 4, '0')), '') AS bits,
         min(page_id) OVER (PARTITION BY hex) AS first_id FROM k
)
SELECT page_id, CAST(strlen(h) AS BIGINT) AS payload_bytes,
       array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
         1 + list_sum(list_transform(range(0, 5), lambda j: CAST(substr(bits, CAST(5 * i + j + 1 AS INT), 1) AS INT) << CAST(4 - j AS INT)))::INT, 1)), '')
         AS payload_digest,
       CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first_id THEN first_id END AS refers_to, url_key, captured,
       row_number() OVER (ORDER BY url_key, captured, page_id) - 1 AS index_pos
FROM b
"""

ORACLES["op4_bit_sliced"] = r"""
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS q
  FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT a.vec_id AS query_id, b.vec_id,
         CAST(coalesce(list_sum(list_transform(list_zip(a.q, b.q), lambda t: coalesce(t[1], 0) * coalesce(t[2], 0))), 0) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id
), r AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INT) AS rank FROM s
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10
"""

ORACLES["op8_tensored_minhash"] = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS ws FROM documents
), g AS (
  SELECT doc_id, unnest(CASE WHEN len(ws) = 0 THEN []
                             WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
                             ELSE list_distinct(list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' '))) END) AS s
  FROM w
), n AS (
  SELECT w.doc_id, CAST(count(s) AS BIGINT) AS n_shingles FROM w LEFT JOIN g ON w.doc_id = g.doc_id GROUP BY w.doc_id
), common AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS shared FROM g x JOIN g y ON x.s = y.s AND x.doc_id < y.doc_id GROUP BY ALL
), e AS (
  SELECT a, b FROM common JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b
  WHERE 100 * shared >= 75 * (na.n_shingles + nb.n_shingles - shared)
), d AS (
  SELECT a, b FROM e UNION ALL SELECT b, a FROM e
), r AS (
  SELECT doc_id AS v, doc_id AS reached FROM n UNION SELECT r.v, d.b FROM r JOIN d ON r.reached = d.a
), c AS (
  SELECT v, min(reached) AS component_id FROM r GROUP BY v
)
SELECT doc_id, n_shingles, component_id, doc_id = component_id AS kept FROM n JOIN c ON n.doc_id = c.v
"""

ORACLES["op13_conversation_repair"] = r"""
WITH RECURSIVE tbl AS (
  SELECT list_transform(range(256), lambda b: list_reduce(range(8),
    lambda c, k: CASE WHEN (c & 1) = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, b)) AS t
), keyed AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS k FROM conversations
), faulty AS (
  SELECT conv_id, turn, role, text, xor(list_reduce(list_transform(string_split(k, ''), lambda x: CAST(unicode(x) AS BIGINT)),
    lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1]), 4294967295), 4294967295) % 20 AS f FROM keyed, tbl
), after AS (
  SELECT conv_id, turn, CASE f WHEN 4 THEN 'user' ELSE role END AS role,
         CASE f WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
         unnest(range(CASE f WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy FROM faulty
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS i,
         row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) > 1 AS seen,
         left(role, 1) AS ini, NOT regexp_matches(text, '[^\x20\x09-\x0D]') AS blank FROM after
), rows_ AS (
  SELECT *, seen AND NOT blank AS dup, NOT blank AND NOT seen
         AND regexp_extract(text, '([^\x20\x09-\x0D])[\x20\x09-\x0D]*$', 1) NOT IN ('.', '!', '?') AS cut,
         lag(ini) OVER (PARTITION BY conv_id ORDER BY i) || ini AS pair FROM ranked
), facts AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (blank) AS blank,
         count(*) FILTER (dup) AS duplicate, count(*) FILTER (cut) AS truncated,
         count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal, max(i) AS n FROM rows_ GROUP BY conv_id
), path AS (
  SELECT conv_id, CAST(0 AS BIGINT) AS i, '0' AS q, {'c': CAST(0 AS BIGINT), 'a': '', 't': CAST([] AS VARCHAR[])} AS best
  FROM (SELECT DISTINCT conv_id FROM rows_)
  UNION ALL
  SELECT conv_id, i, q, min(best) FROM (
    SELECT p.conv_id, r.i, e.q, {'c': p.best.c + len(g.ins) * 2 + e.c, 'a': p.best.a || g.ins || e.a,
      't': list_concat(p.best.t, g.said, CASE e.a WHEN 'D' THEN [] WHEN 'K' THEN [r.role || ':' || r.text]
                                           ELSE [CASE e.q WHEN 'u' THEN 'user:' ELSE 'assistant:' END || r.text] END)} AS best
    FROM path p JOIN rows_ r ON r.conv_id IS NOT DISTINCT FROM p.conv_id AND r.i = p.i + 1
    JOIN (VALUES ('0', '', '0', CAST([] AS VARCHAR[])), ('s', '', 's', []), ('u', '', 'u', []), ('a', '', 'a', []),
                 ('0', 'I', 'u', ['user:']), ('s', 'I', 'u', ['user:']), ('a', 'I', 'u', ['user:']),
                 ('u', 'I', 'a', ['assistant:']), ('0', 'II', 'a', ['user:', 'assistant:']),
                 ('s', 'II', 'a', ['user:', 'assistant:'])) g(f, ins, mid, said) ON g.f = p.q
    JOIN (SELECT conv_id AS cid, i AS ri, f AS mid, x.a AS a, x.c AS c, x.q AS q FROM (
            SELECT conv_id, i, f, unnest([
              {'a': 'D', 'c': 3, 'q': f},
              {'a': CASE WHEN NOT (blank OR dup) AND (ini = nxt OR (ini = 's' AND f = '0')) THEN 'K' END,
               'c': CAST(cut AS INT), 'q': ini},
              {'a': CASE WHEN NOT (blank OR dup) THEN 'R' END, 'c': 2 + CAST(cut AS INT), 'q': nxt}]) AS x
            FROM rows_, (VALUES ('0', 'u'), ('s', 'u'), ('u', 'a'), ('a', 'u')) v(f, nxt))) e
      ON e.cid IS NOT DISTINCT FROM p.conv_id AND e.ri = r.i AND e.mid = g.mid AND e.a IS NOT NULL)
  GROUP BY conv_id, i, q
), ends AS (
  SELECT p.conv_id, min({'c': p.best.c + len(z.ins) * 2, 'a': p.best.a || z.ins, 't': list_concat(p.best.t, z.said)}) AS best
  FROM path p JOIN facts f ON f.conv_id IS NOT DISTINCT FROM p.conv_id AND f.n = p.i
  JOIN (VALUES ('0', '', CAST([] AS VARCHAR[])), ('s', 'II', ['user:', 'assistant:']), ('u', 'I', ['assistant:']), ('a', '', []))
    z(q, ins, said) ON z.q = p.q GROUP BY p.conv_id
)
SELECT c.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(CAST(e.best.c AS BIGINT), 0) AS cost,
       coalesce(e.best.a, '') AS audit, sha256(coalesce(array_to_string(e.best.t, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c
LEFT JOIN facts f ON f.conv_id IS NOT DISTINCT FROM c.conv_id LEFT JOIN ends e ON e.conv_id IS NOT DISTINCT FROM c.conv_id
"""


def _url_level(k: int) -> str:
    """The probabilities of n-grams of k + 1 characters, for op11_url_models."""
    low = "(na + (ka + 1) * (1.0::DOUBLE / 1114112)) / (ta + ka + 1) AS pa, (nr + (kr + 1) * (1.0::DOUBLE / 1114112)) / (tr + kr + 1) AS pr"
    high = ("CASE WHEN ta >= 4 THEN (na + ka * l.pa) / (ta + ka) ELSE l.pa END AS pa, "
            "CASE WHEN tr >= 4 THEN (nr + kr * l.pr) / (tr + kr) ELSE l.pr END AS pr")
    shorter = f"JOIN p{k - 1} l ON l.gram = substring(x.gram, 2)" if k else ""
    return f"""x{k} AS (
  SELECT gram, na, nr, sum(na) OVER c AS ta, sum(nr) OVER c AS tr, CAST(count(*) FILTER (na > 0) OVER c AS DOUBLE) AS ka,
         CAST(count(*) FILTER (nr > 0) OVER c AS DOUBLE) AS kr
  FROM (SELECT substring(win, {6 - k}) AS gram, sum(na) AS na, sum(nr) AS nr FROM c GROUP BY 1) WINDOW c AS (PARTITION BY left(gram, {k}))
), p{k} AS (
  SELECT x.gram, {high if k else low} FROM x{k} x {shorter}
)"""

ORACLES["op11_url_models"] = r"""
WITH u AS (
  SELECT coalesce(url, '') AS url, count(*) AS n FROM pages GROUP BY 1
), r AS (
  SELECT url, CASE WHEN strpos(url, '://') > 0 THEN substring(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM u
), h AS (
  SELECT url, regexp_extract(rest, '^[^/?#]*') AS raw,
         translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         substring(rest, length(regexp_extract(rest, '^[^/?#]*')) + 1) AS behind FROM r
), p AS (
  SELECT url, host, regexp_extract(behind, '^[^?#]*') AS path,
         CASE WHEN strpos(url, '://') > 0 THEN host || behind ELSE url END AS text FROM h
), j AS (
  SELECT *, CASE WHEN (host = 'www.example.com' OR host LIKE '%.www.example.com') AND path LIKE '/en/%' THEN 'www.example.com/en/'
                 WHEN (host = 'example.com' OR host LIKE '%.example.com') AND path LIKE '/en/%' THEN 'example.com/en/'
                 WHEN (host = 'net' OR host LIKE '%.net') AND path LIKE '/es/%' THEN 'net/es/'
                 WHEN (host = 'net' OR host LIKE '%.net') AND path LIKE '/fr/%' THEN 'net/fr/'
                 WHEN (host = 'com' OR host LIKE '%.com') AND path LIKE '/%' THEN 'com/' END AS rule FROM p
), k AS (
  SELECT *, CASE WHEN rule IN ('com/', 'www.example.com/en/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block' END AS verdict,
         left(md5(url), 1) IN ('0', '1', '2') AS held FROM j
), w AS (
  SELECT url, verdict, held, substring(chr(1) || chr(1) || chr(1) || chr(1) || chr(1) || text || chr(2), i, 6) AS win
  FROM (SELECT *, unnest(range(1, length(text) + 2)) AS i FROM k)
), c AS (
  SELECT win, CAST(count(*) FILTER (verdict = 'allow' AND NOT held) AS DOUBLE) AS na,
         CAST(count(*) FILTER (verdict = 'block' AND NOT held) AS DOUBLE) AS nr FROM w GROUP BY win
), """ + ", ".join(_url_level(k) for k in range(6)) + r""", weights AS (
  SELECT gram AS win, CAST(floor(1000.0 * ln(pa / pr) + 0.5) AS BIGINT) AS weight FROM p5
), scores AS (
  SELECT url, any_value(verdict) AS verdict, CAST(floor(sum(weight)::DOUBLE / count(*)) AS BIGINT) AS score
  FROM w JOIN weights USING (win) WHERE held OR verdict IS NULL GROUP BY url
), bins AS (
  SELECT score, count(*) FILTER (verdict = 'allow') AS a, count(*) FILTER (verdict = 'block') AS b
  FROM (SELECT score, verdict FROM scores WHERE verdict IS NOT NULL UNION ALL SELECT 0, NULL) GROUP BY score
), cuts AS (
  SELECT score, sum(a) OVER (ORDER BY score) - a AS a_below, sum(b) OVER (ORDER BY score) - b AS b_below,
         sum(a) OVER () AS all_a, sum(b) OVER () AS all_b FROM bins
), lim AS (
  SELECT coalesce((SELECT score FROM cuts WHERE all_a > 0 AND all_b > 0
                   ORDER BY a_below * all_b + (all_b - b_below) * all_a, abs(score), score LIMIT 1), 0) AS lowest
)
SELECT CAST(g.page_id AS BIGINT) AS page_id, k.host, k.path, k.rule,
       CASE WHEN k.verdict IS NOT NULL THEN k.verdict WHEN s.score < lim.lowest THEN 'block' ELSE 'allow' END AS verdict,
       CASE WHEN k.verdict IS NULL THEN s.score END AS score, CASE WHEN k.verdict IS NULL THEN CAST(lim.lowest AS BIGINT) END AS lowest
FROM pages g JOIN k ON k.url = coalesce(g.url, '') LEFT JOIN scores s ON s.url = k.url, lim
"""
