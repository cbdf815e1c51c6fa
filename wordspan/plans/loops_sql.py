"""SQL of the queries in loops.py. Runs are replayed by recursion, a step of every lane at a time."""

from __future__ import annotations

from wordspan.plans.generation_sql import FATE, REQUESTS
from wordspan.plans.oracle import MERGED, SAMPLES, WINDOWS, draw, pure, words

#: What each roll stands for, by hand: kind, the seconds it asks to wait, and what it means for model and entry.
FATES = ", ".join(
    f"{{'most': {most}, 'kind': '{kind}', 'wait': {wait}::DOUBLE, 'other': {other}, 'never': {never}}}"
    for most, kind, wait, other, never in [(110, "ok", 0, "true", "false"), (135, "rate", 8, "true", "false"), (145, "rate", 10, "true", "false"), (160, "break", 0, "true", "false"), (170, "content", 0, "true", "false"), (172, "block", 0, "true", "false"), (173, "block", 0, "true", "false"), (185, "entry", 0, "false", "true"), (200, "entry", 0, "false", "false")]
)

SQL: dict[str, str] = {}
SQL["generation_with_cooldowns"] = f"""
WITH RECURSIVE prompts AS (SELECT doc_id AS id, array_to_string(({words('text')})[1:4], ' ') AS prompt FROM documents),
r AS (
  SELECT doc_id % 32 AS lane, list_sort(list({{'due': doc_id / 4 + 1, 'id': doc_id, 'at': doc_id / 4 + 1, 'e': 0, 't': 0, 'b': 0, 'k': 0}})) AS q,
    [{{'name': 'red', 's': 0, 'u': 0.0::DOUBLE, 'p': false}}, {{'name': 'blue', 's': 0, 'u': 0.0::DOUBLE, 'p': false}}, {{'name': 'green', 's': 0, 'u': 0.0::DOUBLE, 'p': false}}, {{'name': 'grey', 's': 0, 'u': 0.0::DOUBLE, 'p': false}}] AS m,
    NULL::BIGINT AS id, NULL::VARCHAR AS status, NULL::VARCHAR AS model, NULL::INTEGER AS attempts, NULL::INTEGER AS asked, NULL::DOUBLE AS waited
  FROM documents GROUP BY 1
  UNION ALL
  SELECT lane, CASE WHEN ends IS NULL THEN list_sort(list_append(rest, after)) ELSE rest END, m2,
    CASE WHEN ends IS NOT NULL THEN x.id END, ends, CASE WHEN ends = 'generated' THEN name END, CASE WHEN ends IS NOT NULL THEN x.e + 1 END, CASE WHEN ends IS NOT NULL THEN asked2 END, CASE WHEN ends IS NOT NULL THEN x.due - x.at END
  FROM (
    SELECT *, CASE WHEN kind = 'ok' THEN 'generated' WHEN failing AND never THEN 'skipped' WHEN failing AND x.e + 1 >= 12 THEN 'failed' END AS ends,
      {{'due': CASE WHEN kind = 'wait' THEN x.due + wait WHEN failing THEN x.due + 5.0 * (x.e + 1) WHEN kind = 'break' THEN x.due + least(60.0, 5.0 * (x.b + 1)) ELSE x.due END,
        'id': x.id, 'at': x.at, 'e': CASE WHEN failing THEN x.e + 1 ELSE x.e END,
        't': CASE WHEN failing THEN 0 WHEN kind IN ('rate', 'content', 'block') THEN x.t + 1 ELSE x.t END,
        'b': CASE WHEN failing THEN 0 WHEN kind = 'break' THEN x.b + 1 ELSE x.b END, 'k': asked2}} AS after
    FROM (
      SELECT *, kind IN ('none', 'entry') OR (kind = 'break' AND x.b + 1 > 20) OR (kind IN ('rate', 'content', 'block') AND x.t + 1 >= 10) AS failing,
        list_transform(m, lambda v: CASE WHEN v.name <> name THEN v
          WHEN kind = 'rate' THEN {{'name': v.name, 's': v.s + 1, 'u': greatest(v.u, x.due + CASE WHEN v.s + 1 >= 3 THEN least(300.0, 30.0 * (v.s + 1)) ELSE wait END), 'p': v.p AND v.s + 1 < 3}}
          WHEN kind = 'content' THEN {{'name': v.name, 's': v.s, 'u': greatest(v.u, x.due + 30.0), 'p': v.p}}
          WHEN kind = 'block' THEN {{'name': v.name, 's': v.s, 'u': 0.0::DOUBLE, 'p': true}} ELSE v END) AS m2
      FROM (
        SELECT lane, x, rest, m, coalesce(name, '') AS name, CASE WHEN name IS NULL THEN x.k ELSE x.k + 1 END AS asked2,
          CASE WHEN name IS NOT NULL THEN fate.kind WHEN cooling IS NULL THEN 'none' ELSE 'wait' END AS kind,
          CASE WHEN name IS NOT NULL THEN fate.wait ELSE greatest(0.5, cooling) END AS wait, coalesce(name IS NOT NULL AND fate.never, false) AS never
        FROM (
          SELECT *, list_filter([{FATES}], lambda f: {draw(9, 'x.id', 'x.k + 1', 'name')} % 200 < f.most)[1] AS fate
          FROM (
            SELECT lane, x, rest, m, free[({draw(0, 'x.id', 'x.k')} % greatest(len(free), 1) + 1)::INTEGER].name AS name,
              list_min(list_transform(list_filter(m, lambda v: x.due < v.u), lambda v: v.u - x.due)) AS cooling
            FROM (SELECT lane, q[1] AS x, q[2:] AS rest, m, list_filter(m, lambda v: NOT v.p AND q[1].due >= v.u) AS free FROM r WHERE len(q) > 0)))))))
SELECT r.id, status, CASE WHEN status = 'generated' THEN trim(model || ' continues ' || prompt) END AS answer, model, attempts, asked, round(waited, 6) AS waited
FROM r JOIN prompts USING (id) WHERE status IS NOT NULL
"""

SLOTS = f"""
s AS (
  SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN 'test' ELSE 'train' END AS split, CASE WHEN doc_id % 3 = 0 THEN doc_id // 3 ELSE doc_id - doc_id // 3 - 1 END AS idx,
    {draw(13, 'doc_id', "'slot'")} % 150 AS fate, ({words("coalesce(text, '')")})[1:40] AS w FROM documents),
slots AS (
  SELECT *, idx // 20 AS chunk_id, CASE WHEN idx // 20 % 7 = 3 THEN 'skipped' WHEN fate = 0 THEN NULL WHEN fate < 10 THEN 'skipped' WHEN fate < 15 THEN 'failed' ELSE 'generated' END AS status FROM s),
filled AS (
  SELECT split, chunk_id, min(idx) FILTER (status = 'generated') AS lo, max(idx) FILTER (status = 'generated') AS hi, count(*) FILTER (status = 'generated') AS n,
    count(*) FILTER (status <> 'generated') AS dropped, count(status) = count(*) AS whole FROM slots GROUP BY split, chunk_id)
"""
SQL["committed_chunks"] = f"WITH {SLOTS} SELECT * FROM filled WHERE n + dropped > 0"
SQL["committed_range"] = f"WITH {SLOTS} SELECT chunk_id, idx, array_to_string(w, ' ') AS text, len(w)::INTEGER AS n, 'm' || doc_id % 5 AS model FROM slots JOIN filled USING (split, chunk_id) WHERE split = 'train' AND idx >= 50 AND idx < 290 AND status = 'generated' AND whole"

SQL["leak_free_split"] = MERGED + """,
g AS (SELECT kind, id, count(*) AS n FROM merged GROUP BY kind, id),
o AS (SELECT *, sum(n) OVER (ORDER BY md5('42|' || kind || '|' || id), kind, id) - n AS start, sum(n) OVER () AS total FROM g)
SELECT CASE WHEN start < floor(total * 0.8::DOUBLE) THEN 'train' WHEN start < floor(total * 0.8::DOUBLE) + floor(total * 0.05::DOUBLE) THEN 'validation' ELSE 'test' END AS split, kind, id, n FROM o"""
SQL["sample_rejects"] = f"""WITH {SAMPLES},
f AS (SELECT conv_id, conv_id % 12 AS k, len(words) AS n, label FROM samples)
SELECT conv_id, CASE WHEN k = 7 THEN 'no index' WHEN k IN (4, 5) OR n = 0 THEN 'no text' WHEN k = 6 THEN 'no model' WHEN k = 2 OR (k = 0 AND n = 1) THEN 'no labels' WHEN k = 0 THEN 'misaligned'
    WHEN k = 1 AND list_contains(label, 1) OR k = 3 THEN 'bad labels' ELSE 'valid' END AS reason,
  CASE WHEN k = 7 THEN 'idx is null' WHEN k = 4 THEN 'text is null' WHEN k = 5 OR n = 0 THEN 'text is blank' WHEN k = 6 THEN 'model is null or blank' WHEN k = 2 OR (k = 0 AND n = 1) THEN 'no label'
    WHEN k = 0 THEN n || ' words, ' || n - 1 || ' labels' WHEN k = 1 AND list_contains(label, 1) THEN list_sum(label)::BIGINT || ' labels, the first 2' WHEN k = 3 THEN '1 labels, the first null' ELSE '' END AS message
FROM f"""
SQL["observed_windows"] = f"WITH {WINDOWS} SELECT count(*) AS windows, sum(len(label))::BIGINT AS words, sum(list_sum(label))::BIGINT AS ones, min(len(label)) AS least, max(len(label)) AS most FROM mixed"
SQL["observed_run"] = f"WITH {REQUESTS}, f AS (SELECT {FATE} AS fate FROM requests) SELECT count(*) FILTER (fate > 1) AS generated, count(*) FILTER (fate = 0) AS skipped, count(*) FILTER (fate = 1) AS failed, count(*) AS total FROM f"
SQL["streamed_to_target"] = f"""WITH {pure('documents', 44, 1, 8, 'ai')},
folders AS (SELECT part, n, sum(n) OVER (ORDER BY md5('44|part=' || part)) AS upto FROM (SELECT doc_id % 16 AS part, count(*) AS n FROM ai GROUP BY 1)),
placed AS (SELECT ai.*, upto - n AS before, row_number() OVER (PARTITION BY part ORDER BY md5('44|' || doc_id || '|' || copy), doc_id, copy) AS place FROM ai JOIN folders ON doc_id % 16 = part)
SELECT doc_id, copy, s, e, text, label FROM placed WHERE before + place <= 700"""
