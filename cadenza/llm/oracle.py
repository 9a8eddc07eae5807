"""DuckDB SQL of the corpus queries that SQL can express."""

from __future__ import annotations

from cadenza.llm.decontaminate import OP2_SQL
from cadenza.llm.divergence import OP11_SQL

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP5_SQL = rf"""
WITH RECURSIVE doc AS (SELECT doc_id, regexp_extract_all({_LOWER}, '[^\x20\x09-\x0D]+') AS ws FROM documents),
shingle AS (SELECT DISTINCT doc_id, s FROM (
    SELECT doc_id, unnest([array_to_string(ws[i:i + 4], ' ') for i in range(1, greatest(len(ws) - 4, 1) + 1)]) AS s FROM doc WHERE len(ws) > 0)),
size AS (SELECT doc_id, count(*) AS n FROM shingle GROUP BY doc_id),
pair AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS n FROM shingle x JOIN shingle y ON x.s = y.s AND x.doc_id < y.doc_id GROUP BY 1, 2),
link AS (SELECT a, b FROM pair JOIN size sa ON sa.doc_id = a JOIN size sb ON sb.doc_id = b WHERE 100 * pair.n >= 75 * (sa.n + sb.n - pair.n)),
edge AS (SELECT a, b FROM link UNION ALL SELECT b, a FROM link),
reach(doc_id, r) AS (SELECT doc_id, doc_id FROM documents UNION SELECT reach.doc_id, edge.b FROM reach JOIN edge ON edge.a = reach.r),
part AS (SELECT doc_id, min(r) AS component_id FROM reach GROUP BY doc_id)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, count(*) OVER (PARTITION BY CASE WHEN n IS NULL THEN doc_id END, k) AS n_copies,
       doc_id = component_id AS kept
FROM documents LEFT JOIN size USING (doc_id) JOIN part USING (doc_id)
LEFT JOIN (SELECT doc_id, string_agg(s, chr(10) ORDER BY s) AS k FROM shingle GROUP BY doc_id) USING (doc_id)
"""

OP4_SQL = """
WITH doc AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
win AS (SELECT doc_id, i, md5(substr(h, 2 * i + 1, 400)) AS w FROM (SELECT doc_id, h, unnest(range(0, len(h) // 2 - 199)) AS i FROM doc WHERE len(h) >= 400)),
hit AS (SELECT doc_id, i FROM win JOIN (SELECT w FROM win GROUP BY w HAVING count(*) > 1) USING (w)),
run AS (SELECT doc_id, min(i) AS a, max(i) + 200 AS b FROM (
    SELECT doc_id, i, sum(new) OVER (PARTITION BY doc_id ORDER BY i) AS r FROM (
        SELECT doc_id, i, CASE WHEN i - lag(i) OVER (PARTITION BY doc_id ORDER BY i) <= 200 THEN 0 ELSE 1 END AS new FROM hit)) GROUP BY doc_id, r),
gap AS (SELECT doc_id, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS a, a AS b FROM run
        UNION ALL SELECT doc_id, max(b), NULL FROM run GROUP BY doc_id),
kept AS (SELECT doc_id, string_agg(substr(h, 2 * a + 1, 2 * (coalesce(b, len(h) // 2) - a)), '' ORDER BY a) AS k FROM gap JOIN doc USING (doc_id) GROUP BY doc_id),
span AS (SELECT doc_id, sum(b - a) AS n_removed, count(*) AS n_spans FROM run GROUP BY doc_id)
SELECT doc_id, CAST(len(h) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans,
       sha256(unhex(coalesce(k, h))) AS kept_sha256
FROM doc LEFT JOIN span USING (doc_id) LEFT JOIN kept USING (doc_id)
"""

OP6_SQL = r"""
WITH doc AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
win AS (SELECT doc_id, i, md5(array_to_string(ws[i:i + 19], ' ')) AS w FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 18)) AS i FROM doc WHERE len(ws) >= 20)),
hit AS (SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY w ORDER BY doc_id, i) AS r FROM win) WHERE r > 1),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 20)) AS i FROM hit),
word AS (SELECT doc_id, i, ws[i] AS w FROM (SELECT doc_id, ws, unnest(range(1, len(ws) + 1)) AS i FROM doc WHERE len(ws) > 0)),
kept AS (SELECT doc_id, string_agg(w, ' ' ORDER BY i) AS k FROM word ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id),
lost AS (SELECT doc_id, count(*) AS n FROM gone GROUP BY doc_id)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(n, 0) AS BIGINT) AS n_removed, sha256(coalesce(k, '')) AS kept_sha256
FROM doc LEFT JOIN lost USING (doc_id) LEFT JOIN kept USING (doc_id)
"""

ORACLE = {
    "op2_benchmark_decontamination": OP2_SQL,
    "op4_suffix_array_dedup": OP4_SQL,
    "op5_minhash_near_dedup": OP5_SQL,
    "op6_substring_dedup": OP6_SQL,
    "op11_source_divergence": OP11_SQL,
}
