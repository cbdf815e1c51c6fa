"""SQL of the queries in stored.py."""

from __future__ import annotations

from wordspan.plans.oracle import MERGED, wc
from wordspan.plans.oracle import SQL as BASE

SQL = {
    "request_log_profile": f"""WITH c AS (SELECT conv_id // 20 % 3 AS validator_uid, conv_id // 20 AS log, {wc("coalesce(text, '')")} AS wc FROM conversations)
SELECT validator_uid, count(*) AS n, min(wc) AS least, max(wc) AS most, avg(wc) AS mean, median(wc)::DOUBLE AS median, count(DISTINCT log) AS files FROM c GROUP BY validator_uid""",
    "catalog_from_files": BASE["catalog_filter"],
    "training_heads": MERGED + """,
p AS (SELECT *, row_number() OVER (ORDER BY md5('42|' || kind || '|' || id || '|' || copy), kind, id, copy) - 1 AS pos, count(*) OVER () AS n FROM merged),
s AS (SELECT *, floor(n * 0.8::DOUBLE)::BIGINT AS a, floor(n * 0.05::DOUBLE)::BIGINT AS b FROM p)
SELECT CASE WHEN pos < a THEN 'train' WHEN pos < a + b THEN 'validation' ELSE 'test' END AS split, pos, kind, id, copy FROM s
WHERE pos < least(120, a) OR (pos >= a AND pos < a + least(10, b)) OR (pos >= a + b AND pos < a + b + 25)""",
}
