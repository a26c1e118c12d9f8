"""DuckDB SQL for the operators whose whole result SQL can express."""

from __future__ import annotations

#: Windows of 13 words that also start in a document with a smaller id.
SUBSTRING_DEDUP = r"""WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
win AS (SELECT doc_id, s, array_to_string(w[s + 1:s + 13], ' ') AS g FROM (SELECT doc_id, w, unnest(range(len(w) - 12)) AS s FROM d WHERE len(w) > 12)),
low AS (SELECT g, min(doc_id) AS first FROM win GROUP BY g),
gone AS (SELECT doc_id, list_sort(list(DISTINCT p)) AS p FROM (SELECT doc_id, unnest(range(s, s + 13)) AS p FROM win JOIN low USING (g) WHERE first < doc_id) GROUP BY doc_id),
kept AS (SELECT doc_id, string_agg(x, ' ' ORDER BY i) AS t FROM (SELECT doc_id, unnest(w) AS x, unnest(range(len(w))) AS i FROM d) u
         WHERE NOT EXISTS (SELECT 1 FROM (SELECT doc_id, unnest(p) AS i FROM gone) g WHERE g.doc_id = u.doc_id AND g.i = u.i) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(len(p), 0) AS BIGINT) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN gone USING (doc_id) LEFT JOIN kept USING (doc_id)"""

#: Strings of 50 bytes that also start in a document with a smaller id, on hex text.
RUN_DEDUP = r"""WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
seg AS (SELECT doc_id, base, substr(h, 2 * base + 1, 2 * 305) AS x FROM (SELECT doc_id, h, unnest(range(0, length(h) // 2 - 49, 256)) AS base FROM d WHERE length(h) >= 100)),
win AS (SELECT doc_id, base + i AS s, md5_number(substr(x, 2 * i + 1, 100)) AS g
        FROM (SELECT doc_id, base, x, unnest(range(least(256, length(x) // 2 - 49))) AS i FROM seg)),
low AS (SELECT g, min(doc_id) AS first FROM win GROUP BY g),
bad AS (SELECT doc_id, s, lag(s) OVER (PARTITION BY doc_id ORDER BY s) AS before FROM win JOIN low USING (g) WHERE first < doc_id),
isle AS (SELECT doc_id, s, sum(CASE WHEN before IS NULL OR s - before > 50 THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY s) AS k FROM bad),
run AS (SELECT doc_id, k, min(s) AS a, max(s) + 50 AS b FROM isle GROUP BY doc_id, k),
gap AS (SELECT doc_id, a, b, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS c FROM run),
sums AS (SELECT doc_id, sum(b - a) AS n_removed, count(*) AS n_spans, max(b) AS e FROM run GROUP BY doc_id),
kept AS (SELECT doc_id, string_agg(substr(h, 2 * c + 1, 2 * (a - c)), '' ORDER BY a) AS t FROM gap JOIN d USING (doc_id) GROUP BY doc_id)
SELECT d.doc_id, CAST(length(h) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans,
       sha256(unhex(coalesce(t, '') || substr(h, 2 * coalesce(e, 0) + 1))) AS kept_sha256
FROM d LEFT JOIN sums USING (doc_id) LEFT JOIN kept USING (doc_id)"""

#: Item windows of 13 words (or a whole shorter item) anywhere in a document.
DECONTAMINATION = r"""WITH lowered AS (SELECT 'd' AS side, doc_id AS id, text FROM documents UNION ALL SELECT 'b', item_id, text FROM benchmark),
t AS (SELECT side, id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM lowered),
item AS (SELECT DISTINCT id AS item_id, n, array_to_string(w[s + 1:s + n], ' ') AS g
         FROM (SELECT id, w, least(len(w), 13) AS n, unnest(range(len(w) - least(len(w), 13) + 1)) AS s FROM t WHERE side = 'b' AND len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM item),
win AS (SELECT id AS doc_id, n, s, array_to_string(w[s + 1:s + n], ' ') AS g
        FROM (SELECT id, w, n, unnest(range(len(w) - n + 1)) AS s FROM t, sizes WHERE side = 'd' AND len(w) >= n)),
hit AS (SELECT DISTINCT doc_id, win.n, s, item_id FROM win JOIN item ON win.n = item.n AND win.g = item.g),
cover AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(s, s + n)) AS p FROM hit) GROUP BY doc_id),
named AS (SELECT doc_id, list_sort(list(DISTINCT CAST(item_id AS VARCHAR))) AS items FROM hit WHERE item_id IS NOT NULL GROUP BY doc_id)
SELECT id AS doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(len(items), 0) AS BIGINT) AS n_items,
       sha256(coalesce(array_to_string(items, ','), '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM t LEFT JOIN cover ON cover.doc_id = t.id LEFT JOIN named ON named.doc_id = t.id WHERE side = 'd'"""

#: Scores of every document that holds a term of the item, the 20 best of each item.
SEARCH = r"""WITH low AS (SELECT 'd' AS side, doc_id AS id, text FROM documents UNION ALL SELECT 'b', item_id, text FROM benchmark),
t AS (SELECT side, id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                 '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM low),
size AS (SELECT id AS doc_id, count(*) AS n FROM t WHERE side = 'd' GROUP BY id),
total AS (SELECT CAST(count(*) AS BIGINT) AS docs, CAST(sum(n) AS BIGINT) AS terms FROM size),
asked AS (SELECT id AS item_id, term, count(*) AS q FROM t WHERE side = 'b' GROUP BY id, term),
post AS (SELECT id AS doc_id, term, count(*) AS tf FROM t WHERE side = 'd' AND term IN (SELECT term FROM asked) GROUP BY id, term),
weight AS (SELECT term, CAST(floor(1000 * ln((2 * docs + 2) / (2 * df + 1))) AS BIGINT) AS w
           FROM (SELECT term, count(*) AS df FROM post GROUP BY term), total),
scored AS (SELECT item_id, doc_id, CAST(sum(q * w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * docs) // terms)))) AS BIGINT) AS score
           FROM asked JOIN post USING (term) JOIN weight USING (term) JOIN size USING (doc_id), total GROUP BY item_id, doc_id)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM scored WHERE score > 0) WHERE rank <= 20"""

ORACLES = {"op1_substring_dedup": SUBSTRING_DEDUP, "op3_run_dedup": RUN_DEDUP, "op9_decontamination": DECONTAMINATION, "op12_search": SEARCH}
