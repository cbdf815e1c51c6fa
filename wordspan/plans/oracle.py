"""DuckDB SQL for the registered queries, written apart from the Spark code."""

from __future__ import annotations

from wordspan.plans.queries import FAILED as FAILED_ROWS

SPACES = r"\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"


def words(x: str) -> str:
    return rf"regexp_extract_all({x}, '[^{SPACES}]+')"


def wc(x: str) -> str:
    return f"len({words(x)})::INTEGER"


def strip(x: str) -> str:
    return rf"regexp_replace({x}, '^[{SPACES}]+|[{SPACES}]+$', '', 'g')"


def draw(seed: int, *keys: str) -> str:
    return f"('0x' || substr(md5(concat_ws('|', '{seed}', {', '.join(keys)})), 1, 8))::BIGINT"


def joined(x: str) -> str:
    return f"coalesce(array_to_string({x}, ' '), '')"


COUNTED = f"SELECT doc_id, lang, source, {wc('text')} AS wc FROM documents"
INDEXED = f"SELECT doc_id, text, row_number() OVER (ORDER BY doc_id) - 1 AS idx FROM documents WHERE {wc('text')} >= "

SENTENCES = rf"""
base AS (SELECT doc_id, text, {words('text')} AS w, {strip('text')} AS whole FROM documents),
found AS (SELECT doc_id, w, whole, CASE WHEN len(w) = 0 THEN [] ELSE
  list_filter(regexp_extract_all(whole, '[^.!?]*[.!?]+|[^.!?]+$'), lambda s: len({words('s')}) > 0) END AS f FROM base),
cut AS (SELECT doc_id, w, CASE WHEN len(w) > 0 AND len(f) = 0 THEN [whole] ELSE f END AS parts FROM found),
sized AS (SELECT doc_id, w, parts, len(parts)::INTEGER AS n,
  list_transform(range(0, len(parts) + 1), lambda k: coalesce(list_sum(list_transform(parts[1:k], lambda s: length(s))), 0)::BIGINT) AS c FROM cut)
"""

TWO_WAY = f"""
WITH RECURSIVE {SENTENCES},
steps AS (
  SELECT doc_id, n, c, greatest(1, n // 2) AS k, 0 AS i, false AS done FROM sized WHERE n >= 2
  UNION ALL
  SELECT doc_id, n, c, k + d, i + 1, d = 0 FROM (
    SELECT *, CASE WHEN k <= 1 OR k >= n - 1 THEN 0 WHEN c[k+1] > c[n+1] - c[k+1] THEN -1
      WHEN c[k+2] < c[n+1] - c[k+2] THEN 1 ELSE 0 END AS d FROM steps WHERE i < 10 AND NOT done)),
last AS (SELECT doc_id, arg_max(k, i) AS k FROM steps GROUP BY doc_id),
tried AS (SELECT s.doc_id, w, CASE WHEN k IS NOT NULL THEN {words("array_to_string(parts[1:k], '')")} END AS p,
  CASE WHEN k IS NOT NULL THEN {words("array_to_string(parts[k+1:], '')")} END AS s FROM sized s LEFT JOIN last USING (doc_id)),
chosen AS (SELECT *, CASE WHEN p IS NOT NULL AND len(p) >= 2 AND len(s) >= 2 THEN 'sentences' WHEN len(w) >= 30 THEN 'words' END AS how, len(w) // 2 AS h FROM tried)
SELECT doc_id, how, CASE WHEN how IS NULL THEN 'too few words' END AS reason,
  CASE how WHEN 'sentences' THEN array_to_string(p, ' ') WHEN 'words' THEN array_to_string(w[1:h], ' ') END AS prefix,
  CASE how WHEN 'sentences' THEN array_to_string(s, ' ') WHEN 'words' THEN array_to_string(w[h+1:], ' ') END AS suffix
FROM chosen
"""

THREE_CUT = f"""
WITH RECURSIVE {SENTENCES},
steps AS (
  SELECT doc_id, n, c, n // 3 AS a, 2 * n // 3 AS b, 0 AS i, false AS done FROM sized WHERE n >= 3
  UNION ALL
  SELECT doc_id, n, c, a + CASE m WHEN 1 THEN -1 WHEN 3 THEN 1 ELSE 0 END, b + CASE m WHEN 2 THEN -1 WHEN 4 THEN 1 ELSE 0 END, i + 1, m = 0 FROM (
    SELECT *, CASE WHEN a <= 1 OR b <= a + 1 OR b >= n - 1 THEN 0
      WHEN c[a] > c[b+1] - c[a] THEN 1
      WHEN c[b] - c[a+1] > c[n+1] - c[b] THEN 2
      WHEN c[a+2] < c[b+1] - c[a+2] THEN 3
      WHEN c[b+2] - c[a+1] < c[n+1] - c[b+2] THEN 4 ELSE 0 END AS m FROM steps WHERE i < 10 AND NOT done)),
last AS (SELECT doc_id, arg_max(a, i) AS a, arg_max(b, i) AS b FROM steps GROUP BY doc_id),
tried AS (SELECT s.doc_id, w, CASE WHEN a IS NOT NULL THEN {words("array_to_string(parts[1:a], '')")} END AS p1,
  CASE WHEN a IS NOT NULL THEN {words("array_to_string(parts[a+1:b], '')")} END AS p2,
  CASE WHEN a IS NOT NULL THEN {words("array_to_string(parts[b+1:], '')")} END AS p3 FROM sized s LEFT JOIN last USING (doc_id)),
chosen AS (SELECT *, CASE WHEN p1 IS NOT NULL AND least(len(p1), len(p2), len(p3)) >= 2 THEN 'sentences' WHEN len(w) >= 30 THEN 'words' END AS how,
  greatest(2, len(w) // 3) AS f, least(greatest(greatest(2, len(w) // 3) + 2, 2 * len(w) // 3), len(w) - 2) AS g FROM tried),
parted AS (SELECT doc_id, how,
  CASE how WHEN 'sentences' THEN p1 WHEN 'words' THEN w[1:f] END AS x, CASE how WHEN 'sentences' THEN p2 WHEN 'words' THEN w[f+1:g] END AS y,
  CASE how WHEN 'sentences' THEN p3 WHEN 'words' THEN w[g+1:] END AS z FROM chosen)
"""

SAMPLES = f"""
said AS (SELECT conv_id, turn, (role = 'assistant')::INTEGER AS l, {words("coalesce(text, '')")} AS w FROM conversations),
samples AS (SELECT conv_id, flatten(list(w ORDER BY turn, l, w)) AS words,
  flatten(list(list_transform(w, lambda x: l) ORDER BY turn, l, w)) AS label FROM said GROUP BY conv_id)
"""

BOUNDS = "list_filter(range(0, greatest(len(label) - 1, 0)), lambda i: label[i+1] <> label[i+2])"

WINDOWS = f"""
{SAMPLES},
parsed AS (SELECT conv_id, words AS w, label AS l, len(words) AS n, {BOUNDS} AS bounds FROM samples WHERE len(words) >= 2),
tries AS (SELECT conv_id, n, a, bounds[1 + ({draw(42, 'conv_id', 'a', "'b'")} % len(bounds))] AS b
  FROM parsed, (SELECT unnest(range(0, 60)) AS a) WHERE len(bounds) > 0),
drawn AS (SELECT *, {draw(42, 'conv_id', 'a', "'s'")} % (b + 1) AS s0, b + 2 + {draw(42, 'conv_id', 'a', "'e'")} % (n - b - 1) AS e0 FROM tries),
trim AS (SELECT *, greatest(0, e0 - s0 - 350) AS k FROM drawn),
coins AS (SELECT *, coalesce(list_sum(list_transform(range(0, (k + 31) // 32), lambda m:
  bit_count({draw(42, 'conv_id', 'a', "'h'", 'm')} >> (32 - least(32, k - 32 * m))))), 0) AS h FROM trim),
shifted AS (SELECT *, least(greatest(h, k - (e0 - b - 2)), b - s0) AS ds FROM coins),
trimmed AS (SELECT conv_id, n, a, s0 + ds AS s1, e0 - k + ds AS e1 FROM shifted),
lack AS (SELECT *, 35 - (e1 - s1) AS d FROM trimmed),
grow AS (SELECT *, CASE WHEN d > 0 THEN least(s1, greatest((d + 1) // 2, d - (n - e1))) ELSE 0 END AS la FROM lack WHERE d <= 0 OR s1 + n - e1 >= d),
spans AS (SELECT conv_id, a, s1 - la AS s, e1 + greatest(d, 0) - la AS e FROM grow),
firsts AS (SELECT conv_id, s, e, min(a) AS a FROM spans WHERE e - s BETWEEN 35 AND 350 GROUP BY conv_id, s, e),
numbered AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY a) - 1 AS copy FROM firsts),
mixed AS (SELECT conv_id, copy::INTEGER AS copy, s::INTEGER AS s, e::INTEGER AS e, array_to_string(w[s+1:e], ' ') AS text, l[s+1:e] AS label
  FROM numbered JOIN parsed USING (conv_id) WHERE copy < 10)
"""


def pure(source: str, seed: int, label: int, copies: int, name: str) -> str:
    return f"""
{name}_w AS (SELECT doc_id, {words('text')} AS w FROM {source}),
{name}_n AS (SELECT doc_id, k, w, 35 + {draw(seed, 'doc_id', 'k', "'n'")} % (least(350, len(w)) - 34) AS m
  FROM {name}_w, (SELECT unnest(range(0, {copies})) AS k) WHERE len(w) >= 35),
{name}_s AS (SELECT *, {draw(seed, 'doc_id', 'k', "'s'")} % (len(w) - m + 1) AS s FROM {name}_n),
{name} AS (SELECT doc_id, k::INTEGER AS copy, s::INTEGER AS s, (s + m)::INTEGER AS e, array_to_string(w[s+1:s+m], ' ') AS text,
  list_transform(range(0, m), lambda x: {label}::INTEGER) AS label FROM {name}_s)
"""


MERGED = f"""
WITH {WINDOWS}, {pure('documents', 42, 0, 8, 'human')},
merged AS (SELECT 'mixed' AS kind, conv_id AS id, copy, s, e FROM mixed UNION ALL SELECT 'human', doc_id, copy, s, e FROM human)
"""

CHUNKED = "chunked AS (SELECT l_orderkey AS idx, l_orderkey * 10 + l_linenumber AS pos, l_linestatus AS split, l_returnflag AS model, l_orderkey // 500 AS chunk_id FROM lineitem)"

PIECES = f"""
{SAMPLES},
own AS (SELECT conv_id, label, words, flatten(list_transform(range(0, len(words)), lambda i: list_transform(range(0, (length(words[i+1]) + 3) // 4), lambda x: i))) AS o FROM samples),
ids AS (SELECT conv_id, label, list_concat([NULL::BIGINT], list_concat(o, [NULL::BIGINT])) AS word_ids FROM own)
"""
ALIGNED = "list_transform(range(0, len(word_ids)), lambda i: CASE WHEN word_ids[i+1] IS NULL OR (i > 0 AND word_ids[i] IS NOT NULL AND word_ids[i] = word_ids[i+1]) THEN -100 ELSE coalesce(label[word_ids[i+1]+1], -100) END::INTEGER)"



def subwords(most: str) -> str:
    return f"""
{PIECES},
toks AS (SELECT conv_id, unnest(range(0, least({most}, len(word_ids)))) AS tok, unnest(word_ids[1:{most}]) AS word_id FROM ids),
firsts AS (SELECT conv_id, word_id, min(tok) AS tok FROM toks WHERE word_id IS NOT NULL GROUP BY ALL),
truth AS (SELECT conv_id, unnest(range(0, len(label))) AS word_pos, unnest(label) AS y FROM samples),
probs AS (SELECT t.conv_id, t.word_pos::INTEGER AS word_pos, y, CASE WHEN tok IS NOT NULL THEN ({draw(7, 't.conv_id', 'tok', "'t'")} % 21)::DOUBLE / 20 END AS p
  FROM truth t LEFT JOIN firsts f ON t.conv_id = f.conv_id AND t.word_pos = f.word_id)
"""


def scored(key: str = "'w'") -> str:
    return f"""{SAMPLES},
truth AS (SELECT conv_id, unnest(range(0, len(label))) AS word_pos, unnest(label) AS y FROM samples),
scored AS (SELECT conv_id, word_pos, y, ({draw(7, 'conv_id', 'word_pos', key)} % 21)::DOUBLE / 20 AS p FROM truth)"""


def ranking(by: str, source: str) -> str:
    """Confusion counts, average precision and reward of each group."""
    return f"""
conf AS (SELECT {by} AS g, count(*) FILTER (y = 0 AND round_even(p, 0) = 0) AS tn, count(*) FILTER (y = 0 AND round_even(p, 0) = 1) AS fp,
  count(*) FILTER (y = 1 AND round_even(p, 0) = 0) AS fn, count(*) FILTER (y = 1 AND round_even(p, 0) = 1) AS tp FROM {source} GROUP BY 1),
f AS (SELECT *, coalesce(2 * tp / nullif(2 * tp + fp + fn, 0)::DOUBLE, 0.0::DOUBLE) AS f1 FROM conf),
by_score AS (SELECT {by} AS g, p, sum(y) AS pos, count(*) AS m FROM {source} GROUP BY 1, 2),
ran AS (SELECT g, pos, sum(pos) OVER w AS tp, sum(m) OVER w AS n, sum(pos) OVER (PARTITION BY g) AS al FROM by_score WINDOW w AS (PARTITION BY g ORDER BY p DESC)),
precise AS (SELECT g, round(coalesce(sum(pos::DOUBLE * tp / nullif(al::DOUBLE * n, 0)), 0.0::DOUBLE), 10)::DOUBLE AS ap FROM ran GROUP BY g),
whole AS (SELECT g, tn, fp, fn, tp, f1, ap, 1 - fp / (tn + fp + fn + tp)::DOUBLE AS fp_score FROM f JOIN precise USING (g))
"""


SQL: dict[str, str] = {
    "word_profile_by_lang": f"SELECT lang, count(*) AS n, min(wc) AS least, max(wc) AS most, avg(wc) AS mean, median(wc)::DOUBLE AS median FROM ({COUNTED}) GROUP BY lang",
    "word_profile_by_source_file": f"SELECT source, lang, count(*) AS n, min(wc) AS least, max(wc) AS most, count(DISTINCT l2) AS langs FROM (SELECT *, lang AS l2 FROM ({COUNTED})) GROUP BY GROUPING SETS ((source, lang), (source))",
    "shortest_longest_per_group": f"""
WITH c AS ({COUNTED}), a AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY wc, source, doc_id) AS r FROM c),
b AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY wc DESC, source, doc_id) AS r FROM c)
SELECT lang, a.wc AS least, a.source AS least_source, a.doc_id AS least_doc_id, b.wc AS most, b.source AS most_source, b.doc_id AS most_doc_id
FROM a JOIN b USING (lang) WHERE a.r = 1 AND b.r = 1""",
    "upper_median_lengths": f"WITH c AS ({COUNTED}) SELECT lang, min(wc) AS least, list_sort(list(wc))[count(*) // 2 + 1] AS upper_median, max(wc) AS most FROM c GROUP BY lang",
    "filtered_index_range": f"SELECT doc_id, idx, {wc('text')} AS wc FROM ({INDEXED} 30) WHERE idx >= 100 AND idx < 700",
    "source_point_lookup": f"SELECT doc_id, idx, text FROM ({INDEXED} 3) WHERE idx = 123",
    "prefix_source_match": f"""
WITH src AS (SELECT 3 AS least, doc_id, idx, {words('text')} AS w FROM ({INDEXED} 3) UNION ALL SELECT 15, doc_id, idx, {words('text')} FROM ({INDEXED} 15)
  UNION ALL SELECT 30, doc_id, idx, {words('text')} FROM ({INDEXED} 30)),
pr AS (SELECT s.doc_id AS probe_id, CASE WHEN s.doc_id % 3 = 0 THEN coalesce(t.idx, s.idx) ELSE s.idx END + s.doc_id % 5 - 2 AS hint, s.w[1:20] AS p, least(20, len(s.w)) AS k
  FROM src s LEFT JOIN src t ON t.least = 30 AND t.doc_id = s.doc_id WHERE s.least = 3),
direct AS (SELECT probe_id, s.idx FROM pr JOIN src s ON s.least = 3 AND s.idx = hint WHERE s.w[1:k] = p),
near AS (SELECT probe_id, min([s.least, s.idx]) AS b FROM pr JOIN src s ON s.w[1] = p[1] AND s.w[1:k] = p AND s.idx BETWEEN hint - 2000 AND hint + 2000 GROUP BY probe_id)
SELECT probe_id, coalesce(d.idx, n.b[2]) AS idx, CASE WHEN d.idx IS NOT NULL THEN 'index' WHEN n.b IS NOT NULL THEN 'prefix' ELSE 'none' END AS how,
  CASE WHEN d.idx IS NOT NULL THEN 3 ELSE n.b[1]::INTEGER END AS least_words
FROM pr LEFT JOIN direct d USING (probe_id) LEFT JOIN near n USING (probe_id)""",
    "sentence_segments": f"WITH {SENTENCES} SELECT doc_id, (i - 1)::INTEGER AS pos, parts[i] AS sentence, c[i]::INTEGER AS begin FROM sized, unnest(range(1, len(parts) + 1)) AS t(i)",
    "prefix_suffix_split": TWO_WAY,
    "three_part_split": THREE_CUT + "SELECT doc_id, how, CASE WHEN how IS NULL THEN 'too few words' END AS reason, array_to_string(x, ' ') AS begin_text, array_to_string(y, ' ') AS middle_text, array_to_string(z, ' ') AS end_text FROM parted",
    "append_plan": f"""
WITH w AS (SELECT doc_id, {words('text')} AS w FROM documents), d AS (SELECT doc_id, w, (3 + {draw(42, 'doc_id', "'cut'")} % (least(100, len(w)) - 2))::INTEGER AS cut,
  (10 + {draw(42, 'doc_id', "'need'")} % 91)::INTEGER AS need FROM w WHERE len(w) >= 3)
SELECT doc_id, cut, need, cut + need AS total, array_to_string(w[1:cut], ' ') AS kept, greatest(64, 2 * need + 20)::INTEGER AS budget FROM d""",
    "sandwich_plan": f"""
WITH w AS (SELECT doc_id, {words('text')} AS w FROM documents), d AS (SELECT doc_id, w, (50 + {draw(42, 'doc_id', "'need'")} % 251)::INTEGER AS need,
  (3 + {draw(42, 'doc_id', "'start'")} % (greatest(3, least(50, len(w) // 3)) - 2))::INTEGER AS start FROM w WHERE len(w) >= 15),
t AS (SELECT *, (3 + {draw(42, 'doc_id', "'tail'")} % (greatest(3, least(50, len(w) - start - 1)) - 2))::INTEGER AS tail FROM d)
SELECT doc_id, start, tail, need, array_to_string(w[1:start], ' ') AS head_text, array_to_string(w[len(w)-tail+1:], ' ') AS tail_text, greatest(64, 2 * need + 20)::INTEGER AS budget FROM t""",
    "prompt_plan": THREE_CUT + f"""
SELECT doc_id, len(y)::INTEGER AS words, greatest(20, least(len(y) // 2, 150))::INTEGER AS summary_words, greatest(64, 2 * len(y) + 20)::INTEGER AS budget,
  ['Summarise the text in a few sentences.', 'Give a short overview of the text.', 'State the main points of the text.', 'Write a synopsis of the text.'][1 + {draw(42, 'doc_id', "'opening'")} % 4]
  || chr(10) || chr(10) || 'Text:' || chr(10) || array_to_string(y, ' ') AS prompt FROM parted WHERE how IS NOT NULL""",
    "mixed_labels": THREE_CUT + "SELECT doc_id, array_to_string(list_concat(list_concat(x, list_reverse(y)), z), ' ') AS full_text, list_concat(list_concat(list_transform(x, lambda a: 0), list_transform(y, lambda a: 1)), list_transform(z, lambda a: 0)) AS labels FROM parted WHERE how IS NOT NULL",
    "conversation_word_labels": f"WITH {SAMPLES} SELECT conv_id, {joined('words')} AS text, label FROM samples",
    "label_boundaries": f"WITH {SAMPLES} SELECT conv_id, len(label)::INTEGER AS n, {BOUNDS}::INTEGER[] AS boundaries, len({BOUNDS})::INTEGER AS n_boundaries, len(words) = len(label) AS valid FROM samples",
    "detect_mode_distribution": f"""
WITH {SAMPLES}, m AS (SELECT conv_id // 20 AS chunk, CASE WHEN NOT list_contains(label, 1) THEN 'unknown' WHEN label[-1] = 0 THEN 'sandwich' ELSE 'append' END AS mode FROM samples),
c AS (SELECT chunk, mode, count(*) AS n FROM m GROUP BY ALL) SELECT chunk, mode, n, 100.0::DOUBLE * n / sum(n) OVER (PARTITION BY chunk)::DOUBLE AS pct FROM c""",
    "label_segments": f"""
WITH {SAMPLES}, f AS (SELECT conv_id, words AS w, label AS l, coalesce(list_position(label, 1), len(label) + 1) AS z FROM samples),
s AS (SELECT conv_id, w[1:z-1] AS a, list_transform(list_filter(range(1, len(w) + 1), lambda i: l[i] = 1), lambda i: w[i]) AS b,
  list_transform(list_filter(range(1, len(w) + 1), lambda i: i >= z AND l[i] = 0), lambda i: w[i]) AS c FROM f)
SELECT conv_id, {joined('a[1:15]')} AS human_start, {joined('b[1:15]')} AS generated, {joined('c[1:15]')} AS human_end,
  len(a)::INTEGER AS n_human_start, len(b)::INTEGER AS n_generated, len(c)::INTEGER AS n_human_end FROM s""",
    "label_segments_whole": f"""
WITH {SAMPLES}, f AS (SELECT conv_id, words AS w, label AS l, coalesce(list_position(label, 1), len(label) + 1) AS z FROM samples)
SELECT conv_id, {joined('w[1:z-1]')} AS human_start, {joined('list_transform(list_filter(range(1, len(w) + 1), lambda i: l[i] = 1), lambda i: w[i])')} AS generated,
  {joined('list_transform(list_filter(range(1, len(w) + 1), lambda i: i >= z AND l[i] = 0), lambda i: w[i])')} AS human_end FROM f""",
    "one_class_windows": f"WITH {pure('documents', 42, 0, 8, 'human')} SELECT * FROM human",
    "labelled_one_class_windows": f"WITH {pure('(SELECT * FROM documents WHERE doc_id IN (SELECT doc_id FROM labels WHERE quality = 1))', 44, 1, 16, 'ai')} SELECT * FROM ai",
    "boundary_windows": f"WITH {WINDOWS} SELECT * FROM mixed",
    "window_audit": f"""
WITH {WINDOWS}, {pure('documents', 42, 0, 8, 'human')},
a AS (SELECT 'mixed' AS kind, {words('text')} AS w, label FROM mixed UNION ALL SELECT 'human', {words('text')}, label FROM human)
SELECT kind, count(*) AS n, count(*) FILTER (len(w) < 35 OR len(w) > 350) AS bad_length, count(*) FILTER (len(w) <> len(label)) AS bad_align,
  count(*) FILTER (CASE kind WHEN 'mixed' THEN len(list_distinct(label)) < 2 ELSE list_contains(label, 1) END) AS bad_class,
  count(*) FILTER (CASE kind WHEN 'mixed' THEN len({BOUNDS}) = 0 ELSE len({BOUNDS}) > 0 END) AS bad_boundary FROM a GROUP BY kind""",
    "merged_split_counts": MERGED + """,
placed AS (SELECT *, row_number() OVER (ORDER BY md5(concat_ws('|', '42', kind, id, copy)), kind, id, copy) - 1 AS pos, count(*) OVER () AS n FROM merged),
parts AS (SELECT *, CASE WHEN pos < floor(n * 0.8) THEN 'train' WHEN pos < floor(n * 0.8) + floor(n * 0.05) THEN 'validation' ELSE 'test' END AS split FROM placed)
SELECT split, kind, count(*) AS n, min(pos) AS first, max(pos) AS last, sum(e - s)::BIGINT AS words FROM parts GROUP BY split, kind""",
    "chunk_manifest": f"""WITH {CHUNKED} SELECT split, chunk_id, min(idx) AS lo, max(idx) AS hi, count(*) AS n, arg_min(idx, pos) AS first_idx, arg_max(idx, pos) AS last_idx,
  2.0::DOUBLE AS avg_words, 2.0::DOUBLE AS avg_labels, list_sort(list(DISTINCT model)) AS models FROM chunked GROUP BY split, chunk_id""",
    "chunk_range_prune": f"WITH {CHUNKED}, m AS (SELECT split, chunk_id, min(idx) AS lo, max(idx) AS hi, count(*) AS n FROM chunked GROUP BY split, chunk_id) SELECT * FROM m WHERE hi >= 1200 AND lo < 4300",
    "subword_label_alignment": f"WITH {PIECES} SELECT conv_id, len(word_ids)::INTEGER AS n_pieces, ({ALIGNED})[1:256] AS labels FROM ids",
    "subword_label_alignment_whole": f"WITH {PIECES} SELECT conv_id, {ALIGNED} AS labels FROM ids",
    "padded_label_batches": f"""
WITH {PIECES}, c AS (SELECT conv_id, conv_id // 4 AS batch, label, word_ids FROM ids),
w AS (SELECT *, len(word_ids) AS own, max(len(word_ids)) OVER (PARTITION BY batch) AS width FROM c)
SELECT conv_id, batch, list_concat(list_transform(word_ids, lambda x: coalesce(x + 1, 0)::INTEGER), list_transform(range(own, width), lambda x: 0)) AS input_ids,
  list_concat(list_transform(word_ids, lambda x: 1), list_transform(range(own, width), lambda x: 0)) AS attention_mask,
  list_concat({ALIGNED}, list_transform(range(own, width), lambda x: -100)) AS labels FROM w""",
    "first_subword_probs": f"WITH {subwords('len(word_ids)')} SELECT conv_id, word_pos, y, p FROM probs",
    "truncation_fallback": f"""WITH {subwords('256')} SELECT conv_id, avg(((p > 0.5)::INTEGER = y)::INTEGER) AS accuracy, count(p) AS scored, count(*) - count(p) AS skipped, 100.0::DOUBLE * (count(*) - count(p)) / greatest(count(*), 1) AS skipped_pct,
  avg(coalesce(p, 0.0)) AS mean_human, avg(coalesce(p, 1.0)) AS mean_ai, avg(coalesce(p, 0.5)) AS mean_neutral FROM probs GROUP BY conv_id""",
    "confusion_f1": f"WITH {scored()}, {ranking('conv_id % 5', 'scored')} SELECT g AS part, tn, fp, fn, tp, f1 FROM whole",
    "average_precision": f"WITH {scored()}, {ranking('conv_id % 5', 'scored')} SELECT g AS part, ap FROM whole",
    "reward": f"WITH {scored()}, {ranking('1', 'scored')} SELECT tn, fp, fn, tp, f1, ap, fp_score, round((fp_score + f1 + ap) / 3, 10) AS reward FROM whole",
    "model_comparison": f"""WITH {scored()}, own AS (SELECT m AS model_id, conv_id, y, ({draw(7, 'conv_id', 'word_pos', 'm')} % 21)::DOUBLE / 20 AS p FROM truth, (SELECT unnest(['a', 'b', 'c']) AS m)),
{ranking('model_id', 'own')} SELECT g AS model_id, tn, fp, fn, tp, f1, ap, fp_score, round((fp_score + f1 + ap) / 3, 10) AS reward FROM whole""",
    "document_prob_broadcast": f"""WITH {scored()}, z AS (SELECT conv_id, words, ({draw(7, 'conv_id', "'0'")} % 9)::DOUBLE / 2 - 2 AS a, ({draw(7, 'conv_id', "'1'")} % 9)::DOUBLE / 2 - 2 AS b FROM samples),
d AS (SELECT conv_id, words, round(exp(b) / (exp(a) + exp(b)), 10) AS doc_p FROM z), m AS (SELECT conv_id, round(avg(p), 10) AS mean_p FROM scored GROUP BY conv_id)
SELECT conv_id, doc_p, list_transform(words, lambda x: doc_p) AS p, mean_p FROM d LEFT JOIN m USING (conv_id)""",
    "threshold_vs_round": f"WITH {scored()} SELECT p, count(*) AS n, round_even(p, 0)::INTEGER AS rounded, CASE WHEN p >= 0.5 THEN 'ai' ELSE 'human' END AS named, avg(y) AS label_rate FROM scored GROUP BY p",
    "catalog_filter": """
WITH m AS (SELECT p_size AS z, CASE WHEN p_size % 17 = 0 THEN '~' ELSE '' END || lower(replace(p_brand, '#', '-')) || '/' || p_partkey || CASE WHEN p_size % 7 = 0 THEN '-Embed' WHEN p_size % 5 = 0 THEN ':free' ELSE '' END AS id,
  CASE WHEN p_size % 11 = 0 THEN NULL WHEN p_size % 13 = 0 THEN 0 ELSE floor(p_retailprice) / 1000 END AS price,
  CASE WHEN p_size % 11 = 0 THEN 'n/a' WHEN p_size % 13 = 0 THEN '0' ELSE (floor(p_retailprice) / 1000)::VARCHAR END AS prompt FROM part)
SELECT id, prompt, id LIKE '%:free%' OR coalesce(price = 0, false) AS free, coalesce(price <= 1.4, false) AS affordable FROM m
WHERE id NOT LIKE '~%' AND lower(id) NOT LIKE '%embed%' AND z % 3 <> 0 AND z % 19 <> 0 AND z % 23 <> 0""",
}

def marks(x: str, *found: str) -> str:
    return "(" + " OR ".join(f"contains({x}, '{m}')" for m in found) + ")"


def values(*row: object) -> str:
    return "(" + ", ".join("NULL" if v is None else repr(v) for v in row) + ")"


FAILED = "(VALUES " + ", ".join(values(i, *row) for i, row in enumerate(FAILED_ROWS)) + ") v(which, exception, status, text, said, metadata)"
TAXONOMY = f"""
e AS (SELECT user_id AS model, event_id, epoch_us(ts) AS us, epoch_us(ts) // 1000000 AS sec, value, {draw(7, 'event_id', "'kind'")} % {len(FAILED_ROWS)} AS which FROM events WHERE event_type = 'error'),
made AS (SELECT model, event_id, us, sec, exception, status, text, CASE WHEN metadata = '[]' THEN '[]' ELSE '{{"error": {{"message": "' || coalesce(said, '') || '", "metadata": '
  || replace(replace(replace(metadata, '%d', trunc(value)::INTEGER::VARCHAR), '@late', ((sec + 7200) * 1000)::VARCHAR), '@soon', ((sec + 60) * 1000)::VARCHAR) || '}}}}' END AS body FROM e JOIN {FAILED} USING (which)),
said AS (SELECT *, coalesce(nullif(body ->> '$.error.message', ''), text) AS message, lower(text) AS raw,
  coalesce(body ->> '$.error.metadata.retry_after_seconds', body ->> '$.error.metadata.retry_after_seconds_raw') AS asked,
  body ->> '$.error.metadata.headers."X-RateLimit-Remaining"' AS remaining, try_cast(body ->> '$.error.metadata.headers."X-RateLimit-Reset"' AS BIGINT) AS reset FROM made),
one AS (SELECT *, lower(message) AS m, exception = 'rate' OR coalesce(status = 429, false) AS rate_limit,
  {marks('lower(message)', 'daily limit', 'limit_rpd')} OR coalesce(remaining = '0' AND reset / 1000 - sec > 3600, false) AS daily_quota,
  exception IN ('json', 'connection', 'timeout', 'transport') OR (exception = 'runtime' AND contains(raw, 'all models unavailable')) AS transient,
  exception = 'value' AND {marks('raw', 'returned no choices', 'returned empty content')} AS content,
  {marks('raw', 'context length', 'maximum context', 'max context', 'too many tokens', 'token limit')} AS context_length FROM said),
two AS (SELECT *, rate_limit AND NOT daily_quota AND ({marks('m', 'temporarily rate-limited', 'retry shortly')} OR asked IS NOT NULL) AS temporary,
  CASE WHEN exception = 'value' THEN {marks('text', 'words; need at least', 'Could not produce begin, middle, and end')} ELSE context_length END AS non_retryable,
  transient OR content OR exception IN ('server', 'not_found', 'rate') OR coalesce(status IN (402, 403, 404, 429, 500, 502, 503), false) OR (coalesce(status = 400, false) AND {marks('raw', 'provider returned error', 'model_not_available', 'model_not_found', 'non-serverless', 'not found', 'does not exist', 'do not have access', 'no longer available', 'invalid model', 'unsupported model', 'invalid argument', 'invalid_argument')}) AS retry_other_model FROM one),
three AS (SELECT *, retry_other_model AND NOT (transient OR content OR rate_limit OR daily_quota) AS blocks_model, least(60, coalesce(try_cast(asked AS DOUBLE) + 1, 10))::DOUBLE AS wait FROM two),
taxonomy AS (SELECT *, CASE WHEN daily_quota THEN 'quota' WHEN rate_limit THEN 'rate' WHEN content THEN 'content' WHEN blocks_model THEN 'retry' ELSE 'other' END AS kind FROM three)
"""
SQL["prefix_source_texts"] = f"""WITH found AS ({SQL["prefix_source_match"]}),
kept AS (SELECT 3 AS least_words, doc_id, text, idx FROM ({INDEXED} 3) UNION ALL SELECT 15, doc_id, text, idx FROM ({INDEXED} 15) UNION ALL SELECT 30, doc_id, text, idx FROM ({INDEXED} 30))
SELECT probe_id, doc_id, idx, how, text FROM found JOIN kept USING (least_words, idx)"""

SQL["error_taxonomy"] = f"""WITH {TAXONOMY} SELECT event_id, message, rate_limit, daily_quota, temporary, transient, content, context_length, non_retryable, retry_other_model, blocks_model, kind, wait,
  CASE WHEN non_retryable OR daily_quota OR event_id % 13 + 1 >= 12 THEN NULL WHEN transient THEN greatest(7, 5 * (event_id % 13 + 1)) WHEN temporary THEN wait ELSE 5 * (event_id % 13 + 1) END::DOUBLE AS backoff FROM taxonomy"""
STRIKES = f"""{TAXONOMY},
k AS (SELECT *, sec::DOUBLE AS at_s, row_number() OVER (PARTITION BY model ORDER BY us, event_id) AS place FROM taxonomy),
s AS (SELECT *, count(*) FILTER (kind = 'rate') OVER (PARTITION BY model ORDER BY place) AS strikes FROM k),
u AS (SELECT *, CASE WHEN kind = 'rate' AND strikes >= 3 THEN least(300.0, 30.0 * strikes) WHEN kind = 'rate' THEN wait WHEN kind = 'content' THEN 30.0 END AS lasts,
  CASE WHEN kind IN ('quota', 'retry') THEN place END AS b, CASE WHEN kind = 'rate' AND strikes >= 3 THEN place END AS r FROM s),
v AS (SELECT *, max(at_s + lasts) OVER w AS til, max(us / 1e6 + lasts) OVER w AS fine, max(b) OVER w AS lb, max(r) OVER w AS lr FROM u WINDOW w AS (PARTITION BY model ORDER BY place)),
p AS (SELECT *, coalesce(lb > coalesce(lr, 0), false) AS permanent FROM v)
"""
SQL["cooldown_strikes"] = f"WITH {STRIKES} SELECT model, event_id, kind, strikes, til::DOUBLE AS until, permanent, permanent OR coalesce(at_s < til, false) AS blocked FROM p"
SQL["cooldown_stream"] = f"WITH {STRIKES} SELECT model, max(strikes) AS strikes, round(coalesce(max(fine), 0), 3)::DOUBLE AS until, arg_max(permanent, place) AS permanent FROM p GROUP BY model"
SQL["available_models"] = f"""WITH {STRIKES}, ends AS (SELECT model, model % 10 AS part, max(til) AS til, arg_max(permanent, place) AS permanent, max(at_s) AS at_s FROM p GROUP BY model),
n AS (SELECT *, max(at_s) OVER (PARTITION BY part) - 40 AS now FROM ends), c AS (SELECT *, coalesce(now < til, false) AS cooling FROM n),
g AS (SELECT part, coalesce(list_sort(list(model) FILTER (NOT permanent AND NOT cooling)), []) AS models, count(*) FILTER (permanent OR cooling) AS blocked,
  coalesce(greatest(0.5, min(til - now) FILTER (cooling AND NOT permanent)), 0)::DOUBLE AS wait FROM c GROUP BY part)
SELECT part, models, blocked, wait, CASE WHEN len(models) > 0 THEN models[1 + ({draw(11, 'part', "'model'")} % 2147483648) % len(models)] END AS choice FROM g"""
