"""DuckDB SQL for the queries of generation, written apart from the Spark code."""

from __future__ import annotations

from wordspan.operators.modes import BRIDGE, FOLLOW
from wordspan.plans.oracle import ALIGNED, PIECES, SAMPLES, SQL as BASE
from wordspan.plans.oracle import THREE_CUT, TWO_WAY, draw, joined, pure, ranking, words


def listed(values: tuple[str, ...]) -> str:
    return "[" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + "]"


def opening(values: tuple[str, ...]) -> str:
    return f"{listed(values)}[1 + {draw(42, 'doc_id', chr(39) + 'opening' + chr(39))} % {len(values)}]"


NL = "chr(10)"
#: The cuts of other queries as sub-queries: their rows by id.
HALVES, THIRDS = f"({TWO_WAY})", f"({THREE_CUT} SELECT doc_id, how, x, y, z FROM parted)"
WC = f"len({words('text')})"
BUDGET = "greatest(64, 2 * {} + 20)::INTEGER"
REQUESTS = f"""
ap AS (SELECT doc_id, {opening(FOLLOW)} || ' Write ' || need || ' words and nothing else.' || {NL} || {NL} || kept AS prompt, need AS words, budget AS max_tokens, 'append' AS mode FROM ({BASE['append_plan']}) WHERE doc_id % 4 = 0),
hv AS (SELECT doc_id, len({words('prefix')})::INTEGER AS np, len({words('suffix')})::INTEGER AS ns, prefix FROM {HALVES} JOIN documents USING (doc_id) WHERE how IS NOT NULL AND doc_id % 4 = 1 AND {WC} >= 30),
h2 AS (SELECT doc_id, {opening(FOLLOW)} || ' Write ' || ns || ' words and nothing else.' || {NL} || {NL} || prefix AS prompt, ns AS words, {BUDGET.format('(np + ns)')} AS max_tokens, 'halves' AS mode FROM hv),
sw AS (SELECT doc_id, 'Write ' || need || ' words that lead from the first part to the second, and nothing else.' || {NL} || {NL} || 'First part:' || {NL} || head_text || {NL} || {NL} || 'Second part:' || {NL} || tail_text AS prompt,
  need AS words, budget AS max_tokens, 'sandwich' AS mode FROM ({BASE['sandwich_plan']}) WHERE doc_id % 4 = 2),
th AS (SELECT doc_id, y, len(y)::INTEGER AS n, greatest(20, least(len(y) // 2, 150))::INTEGER AS s FROM {THIRDS} JOIN documents USING (doc_id) WHERE how IS NOT NULL AND doc_id % 4 = 3 AND {WC} >= 30),
t2 AS (SELECT doc_id, {opening(BRIDGE)} || ' About ' || s || ' words.' || {NL} || {NL} || 'Text:' || {NL} || array_to_string(y, ' ') AS prompt, s AS words, {BUDGET.format('n')} AS max_tokens, 'thirds' AS mode FROM th),
requests AS (SELECT * FROM ap UNION ALL SELECT * FROM h2 UNION ALL SELECT * FROM sw UNION ALL SELECT * FROM t2)
"""


def segments(source: str) -> str:
    """source: doc_id, text, mode, n_start, n_end."""
    return f"""
src AS ({source}), sw_ AS (SELECT *, {words('text')} AS w FROM src),
seg AS (
  SELECT doc_id, mode, w[1:n_start] AS a, CASE WHEN mode = 'append' THEN [] WHEN n_end > 0 THEN w[greatest(len(w) - n_end + 1, 1):] ELSE w END AS b,
    CASE WHEN mode = 'append' OR n_end = 0 OR n_start + n_end >= len(w) THEN w[n_start+1:] ELSE w[n_start+1:len(w)-n_end] END AS k FROM sw_ WHERE mode IN ('append', 'sandwich')
  UNION ALL SELECT doc_id, mode, CASE WHEN how IS NOT NULL THEN {words('prefix')} END, [], CASE WHEN how IS NOT NULL THEN {words('suffix')} END FROM halves_ JOIN src USING (doc_id) WHERE mode = 'halves'
  UNION ALL SELECT doc_id, mode, x, z, y FROM thirds_ JOIN src USING (doc_id) WHERE mode = 'thirds')
"""


def cuts(documents: str) -> str:
    """The cuts of texts given by a query, instead of those of the table."""
    return f"halves_ AS ({TWO_WAY.replace('FROM documents', f'FROM ({documents})')}), thirds_ AS ({THREE_CUT.replace('FROM documents', f'FROM ({documents})')} SELECT doc_id, how, x, y, z FROM parted)"


MODE = "['append', 'halves', 'sandwich', 'thirds'][1 + doc_id % 4]"
LETTERS = "SELECT doc_id, CASE WHEN doc_id % 6 = 0 THEN upper(text) ELSE text END AS text FROM documents"
STORED = f"""{SAMPLES},
stored AS (SELECT {joined('words')} AS text, CASE conv_id % 10 WHEN 0 THEN label[2:] WHEN 1 THEN list_transform(label, lambda x: x * 2) ELSE label END AS labels, len(words) AS n, 'm' || conv_id % 9 AS model,
  conv_id AS idx, conv_id // 20 AS chunk_id, CASE WHEN conv_id % 4 = 0 THEN 'append' END AS generation_mode, CASE WHEN conv_id % 3 = 0 THEN 'test' ELSE 'train' END AS split FROM samples)
"""
FATE = "('0x' || substr(md5(prompt), 1, 8))::BIGINT % 10"

HASHED = """hashed AS (SELECT conv_id, (i - 1)::INTEGER AS word_pos, words[i] AS word, label[i] AS y, CASE WHEN i <= 40 THEN (('0x' || substr(md5(words[i]), 1, 8))::BIGINT % 21)::DOUBLE / 20 END AS p
  FROM samples, unnest(range(1, len(words) + 1)) AS u(i))"""

SQL = {
    "generation_requests": f"WITH {REQUESTS} SELECT * FROM requests",
    "run_counters": f"""WITH {REQUESTS}, f AS (SELECT mode, {FATE} AS fate FROM requests)
SELECT mode, count(*) FILTER (fate > 1) AS generated, count(*) FILTER (fate = 0) AS skipped, count(*) FILTER (fate = 1) AS failed, count(*) AS total, 100.0::DOUBLE AS done_pct,
  sum(CASE WHEN fate = 1 THEN 10 ELSE 1 END)::BIGINT AS attempts FROM f GROUP BY mode""",
    "source_segments": f"""WITH {cuts('SELECT * FROM documents')}, {segments(f"SELECT doc_id, text, {MODE} AS mode, 3 + doc_id % 5 AS n_start, doc_id % 7 AS n_end FROM documents")}
SELECT doc_id, mode, array_to_string(a, ' ') AS source_start, coalesce(array_to_string(b, ' '), CASE WHEN b IS NOT NULL OR mode = 'halves' THEN '' END) AS source_end, coalesce(array_to_string(k, ' '), CASE WHEN k IS NOT NULL THEN '' END) AS skipped FROM seg""",
    "segment_comparison": f"""WITH {cuts(LETTERS)},
own AS (SELECT doc_id, {words('text')} AS w, 3 + doc_id % 5 AS n_start, doc_id % 4 AS n_end, CASE WHEN doc_id % 4 > 0 THEN 'sandwich' ELSE 'append' END AS detected FROM documents WHERE {WC} >= 15),
made AS (SELECT *, w[1:n_start] AS hs, CASE WHEN n_end > 0 THEN w[len(w)-n_end+1:] ELSE [] END AS he, CASE WHEN doc_id % 5 <> 0 THEN {MODE} ELSE detected END AS mode FROM own),
{segments(f"SELECT doc_id, t.text, mode, n_start, n_end FROM made JOIN ({LETTERS}) t USING (doc_id)")}
SELECT doc_id, detected, m.mode, n_start::INTEGER AS n_start, n_end::INTEGER AS n_end, coalesce(hs = a, false) AS start_match, coalesce(he = b, false) AS end_match, coalesce(len(k), -1)::INTEGER AS n_skipped FROM made m JOIN seg USING (doc_id)""",
    "ready_chunks": """SELECT l_returnflag AS split, l_orderkey // 100 AS chunk_id, count(*) FILTER (l_partkey % 300 >= 30) AS n, count(*) FILTER (l_partkey % 300 < 30) AS dropped FROM lineitem
GROUP BY ALL HAVING count(*) FILTER (l_partkey % 300 = 0) = 0 AND count(*) FILTER (l_partkey % 300 >= 30) > 0""",
    "whole_prompts": THREE_CUT + f"""SELECT doc_id, 'Between the parts below the text said: ' || array_to_string(y[1:12], ' ') || {NL} || {NL} || 'Write ' || len(y) || ' words that lead from the first part to the second, and nothing else.' || {NL} || {NL}
  || 'First part:' || {NL} || array_to_string(x, ' ') || {NL} || {NL} || 'Second part:' || {NL} || array_to_string(z, ' ') AS prompt FROM parted WHERE how IS NOT NULL""",
    "word_predictions": f"""WITH {SAMPLES}, {HASHED}
SELECT conv_id, word_pos, word, p, CASE WHEN p IS NULL THEN '—' WHEN p >= 0.5 THEN 'ai' ELSE 'human' END AS named, round(avg(p) OVER c, 9) AS doc_p, count(*) OVER c AS n_words, count(*) OVER c - count(p) OVER c AS n_skipped,
  coalesce(100.0::DOUBLE * sum((p >= 0.5)::INTEGER) OVER c / count(p) OVER c, 0) AS ai_pct FROM hashed WINDOW c AS (PARTITION BY conv_id)""",
    "evaluated_scorer": f"""WITH {SAMPLES}, {HASHED}, {ranking('conv_id % 4', '(SELECT * FROM hashed WHERE p IS NOT NULL)')},
r AS (SELECT conv_id % 4 AS g, avg(y) AS label_rate, avg(coalesce(p >= 0.5, false)::INTEGER) FILTER (p IS NOT NULL) AS predicted_rate, count(p) AS scored, count(*) - count(p) AS skipped, 100.0::DOUBLE * (count(*) - count(p)) / count(*) AS skipped_pct, avg(((p > 0.5)::INTEGER = y)::INTEGER) AS accuracy FROM hashed GROUP BY 1)
SELECT g AS part, tn, fp, fn, tp, f1, round(ap, 6) AS ap, fp_score, round((fp_score + f1 + ap) / 3, 6) AS reward, round(label_rate, 6) AS label_rate, round(predicted_rate, 6) AS predicted_rate, scored, skipped, skipped_pct, round(accuracy, 6) AS accuracy FROM whole JOIN r USING (g)""",
    "normalised_labels": f"WITH {SAMPLES} SELECT conv_id, label AS from_text, list_transform(range(0, len(label)), lambda k: CASE WHEN k % 5 <> 4 THEN label[k + 1] END) AS from_doubles, label AS from_longs FROM samples",
    "chunk_listing": f"""WITH {STORED}, c AS (SELECT split, chunk_id, min(idx) AS lo, max(idx) AS hi, count(*) AS n, list_sort(list_distinct(list(model))) AS m FROM stored GROUP BY split, chunk_id),
k AS (SELECT *, split || '_' || lo || '_' || hi AS name FROM c)
SELECT split, chunk_id, lo, hi, n, name, row_number() OVER (PARTITION BY split ORDER BY name)::INTEGER AS place, array_to_string(m[1:5], ', ') || CASE WHEN len(m) > 5 THEN ' (+' || len(m) - 5 || ' more)' ELSE '' END AS models FROM k""",
    "chunk_samples": f"WITH {STORED} SELECT idx, model, coalesce(generation_mode, 'sandwich') AS source_mode, len(labels)::INTEGER AS n, text FROM stored WHERE split = 'train' AND idx BETWEEN 7 AND 74 AND len(labels) = n AND len(list_filter(labels, lambda x: x > 1)) = 0",
    "chunk_faults": f"""WITH {STORED}, f AS (SELECT split, len(labels) = n AS fits, len(list_filter(labels, lambda x: x > 1)) = 0 AS ok FROM stored)
SELECT split, count(*) AS n, count(*) FILTER (fits AND ok) AS valid, count(*) FILTER (NOT fits) AS misaligned, count(*) FILTER (fits AND NOT ok) AS bad_labels FROM f GROUP BY split""",
    "token_metrics": f"""WITH {PIECES}, al AS (SELECT conv_id, {ALIGNED} AS l FROM ids),
t AS (SELECT conv_id, i - 1 AS tok, l[i] AS y FROM al, unnest(range(1, len(l) + 1)) AS u(i)),
q AS (SELECT conv_id % 5 AS part, y, ({draw(7, 'conv_id', 'tok', "'m'")} % 21 > 10)::INTEGER AS x FROM t WHERE y <> -100)
SELECT part, count(*) AS kept, avg((x = y)::INTEGER) AS accuracy, coalesce(2 * count(*) FILTER (x = 1 AND y = 1) / nullif(count(*) FILTER (y = 1) + count(*) FILTER (x = 1), 0), 0)::DOUBLE AS f1, avg((y = 1)::INTEGER) AS label_rate, avg((x = 1)::INTEGER) AS predicted_rate FROM q GROUP BY part""",
    "token_row_cache": f"""WITH {PIECES}, cut AS (SELECT conv_id, label, word_ids[1:64] AS word_ids FROM ids)
SELECT conv_id, list_transform(word_ids, lambda x: coalesce(x + 1, 0)::INTEGER) AS input_ids, {ALIGNED} AS labels FROM cut""",
    "windows_to_target": f"""WITH {pure('documents', 44, 1, 8, 'ai')}, ids AS (SELECT doc_id, row_number() OVER (ORDER BY md5('44|' || doc_id), doc_id) - 1 AS place FROM documents WHERE {WC} >= 35)
SELECT ai.* FROM ai JOIN ids USING (doc_id) WHERE place * 8 + copy < 1000""",
    "augment_yield": f"""WITH w AS (SELECT conv_id, count(*) AS n FROM ({BASE['boundary_windows']}) GROUP BY conv_id), s AS (SELECT DISTINCT conv_id FROM conversations)
SELECT count(*) AS sources, coalesce(sum(n), 0)::BIGINT AS windows, count(*) FILTER (n IS NULL) AS skipped, count(*) * 10 AS wanted, (100.0 * sum(n) / (count(*) * 10))::DOUBLE AS yield_pct FROM s LEFT JOIN w USING (conv_id)""",
    "document_scores": "SELECT doc_id, (('0x' || substr(md5(coalesce(text, '')), 1, 8))::BIGINT % 21)::DOUBLE / 20 AS doc_p FROM documents",
    "text_helpers": """SELECT doc_id, left(replace(text, chr(10), ' '), 60) || CASE WHEN length(text) > 60 THEN '...' ELSE '' END AS preview, trim(split_part('  ' || left(text, 12) || ' # ' || source, '#', 1)) AS setting,
CASE WHEN doc_id % 7 <> 0 THEN doc_id * 10 END AS lo, CASE WHEN doc_id % 7 <> 0 THEN doc_id * 10 + 9 END AS hi FROM documents""",
    "score_report": f"""WITH {SAMPLES}, w AS (SELECT conv_id, words, i - 1 AS i, words[i] AS x, CASE WHEN (i - 1) % 11 <> 3 THEN ({draw(7, 'conv_id', '(i - 1)', "'r'")} % 21)::DOUBLE / 20 END AS p FROM samples, unnest(range(1, least(60, len(words)) + 1)) AS u(i)),
l AS (SELECT conv_id, string_agg(CASE WHEN p IS NULL THEN '(' || x || '?)' WHEN p >= 0.5 THEN '[' || x || '*]' ELSE x END, ' ' ORDER BY i) AS line FROM w GROUP BY conv_id)
SELECT conv_id, coalesce(line, '') AS line, ({draw(7, 'conv_id', "'b'")} % 9 > {draw(7, 'conv_id', "'a'")} % 9)::INTEGER AS likelier, round(len(words) * 0.0015::DOUBLE + 50 * 0.002::DOUBLE, 6) AS cost FROM samples LEFT JOIN l USING (conv_id)""",
}
