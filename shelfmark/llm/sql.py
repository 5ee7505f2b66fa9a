"""DuckDB SQL of those queries that SQL can express.

The others have none: op1's mined rules, op2's and op3's fitted models, op7's bounded-error matches,
op8's and op13's tokenizers, op9's and op12's hashes and op10's traced repairs; their tests compare with brute force.
"""

from __future__ import annotations

from shelfmark.llm import mixing, prefix_trie, rules

DECONTAM = r"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT item_id::VARCHAR AS item, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark WHERE item_id IS NOT NULL),
bi AS (SELECT item, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM b WHERE len(w) > 0),
q AS (SELECT DISTINCT item, least(len(w), 10) AS n, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS win FROM bi),
sizes AS (SELECT DISTINCT n FROM q),
di AS (SELECT rid, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, sizes WHERE len(w) >= n),
m AS (SELECT rid, i, di.n, item FROM di JOIN q ON q.n = di.n AND q.win = array_to_string(w[i:i + di.n - 1], ' ')),
h AS (SELECT rid, count(DISTINCT p)::BIGINT AS n_hit FROM (SELECT rid, unnest(range(i, i + n)) AS p FROM (SELECT DISTINCT rid, i, n FROM m)) GROUP BY rid),
t AS (SELECT rid, count(*)::BIGINT AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT rid, item FROM m) GROUP BY rid)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN h USING (rid) LEFT JOIN t USING (rid)
"""

ORACLES = {"op4_mixing": mixing.ORACLE, "op5_rules": rules.ORACLE, "op6_decontam": DECONTAM, "op11_trie": prefix_trie.ORACLE}
