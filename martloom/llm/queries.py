"""The registered queries of the operators, with their production parameters, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import public_tokenizers

from martloom.llm import decontaminate, language, lm, mixing, negatives, packing, quality, repair, simhash, substring, suffix, toxicity, warc
from martloom.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages"), min_payload=0)


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), threshold=0.3)


def op3_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents"), share=1.5, weights=(3, 1, 2), max_copies=2)
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op4_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.predict(table(spark, sf_dir, "documents"))


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix.digest(table(spark, sf_dir, "documents"), stable=True)


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality.judge(table(spark, sf_dir, "documents"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.digest(table(spark, sf_dir, "documents"), window=35, period=21, stable=True)


def op8_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.scores(table(spark, sf_dir, "documents"))


def op9_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=3, radius=2)


def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.marked(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op11_repair_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    convs = table(spark, sf_dir, "conversations")
    return repair.digest(repair.damaged(convs), convs.select("conv_id"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return negatives.mine(negatives.relabelled(table(spark, sf_dir, "embeddings")), every=100, positives=5, negatives=5, low=80, high=100, scale=256)


def op13_pack_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.digest(table(spark, sf_dir, "documents"), vocabulary=public_tokenizers.path("word_bpe_49k.json"), length=4096, end=2)


QUERIES: dict[str, Query] = {f.__name__: f for f in (
    op1_warc, op2_toxicity, op3_mix_sources, op4_language, op5_suffix_dedup, op6_quality, op7_substring_dedup, op8_lm_scores, op9_simhash_near_dedup, op10_decontaminate,
    op11_repair_conversations, op12_hard_negatives, op13_pack_sequences)}

ORACLE: dict[str, str] = {}

ORACLE["op3_mix_sources"] = r"""
WITH d AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size FROM documents),
z AS (SELECT *, CAST(floor(1000000.0::DOUBLE / (size + 1000)) AS BIGINT) AS score FROM d),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size, CAST(sum(size * score) AS BIGINT) AS scored,
             row_number() OVER (ORDER BY source ASC NULLS LAST) AS rnk FROM z GROUP BY source),
w AS (SELECT *, ([3, 1, 2])[(rnk - 1) % 3 + 1]::DOUBLE AS weight, (source_size * 2)::DOUBLE AS cap FROM s),
l AS (SELECT *, cap / weight AS ratio,
        (1.5::DOUBLE * sum(source_size) OVER () - coalesce(sum(cap) OVER (ORDER BY cap / weight, rnk ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
        / sum(weight) OVER (ORDER BY cap / weight, rnk ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM w),
t AS (SELECT source, source_size, scored, CASE WHEN ratio <= level THEN cap ELSE weight * max(CASE WHEN ratio > level THEN level END) OVER () END AS target FROM l),
g0 AS (SELECT *, CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS rep FROM t),
g AS (SELECT source AS of, source_size, target, floor(rep)::BIGINT AS whole, rep - floor(rep) AS f, target - floor(rep) * source_size AS need,
        CASE WHEN source_size > 0 THEN scored::DOUBLE / source_size / 1000 ELSE 0 END AS mean FROM g0),
u AS (SELECT z.*, g.*, f + f * (1 - f) * (score / 1000.0::DOUBLE - mean) AS p,
        (('0x' || substr(md5(coalesce(doc_id::VARCHAR, 'null') || ':mix'), 1, 13))::BIGINT::DOUBLE + 0.5) / 4503599627370496.0::DOUBLE AS u
      FROM z JOIN g ON z.source IS NOT DISTINCT FROM g.of),
q AS (SELECT *, (u / (1 - u)) * ((1 - p) / p) AS odds FROM u WHERE f > 0 AND size > 0),
r AS (SELECT *, odds / (1 + odds) AS rnk FROM q),
c AS (SELECT *, sum(size) OVER (PARTITION BY of ORDER BY rnk, doc_id) AS upto FROM r),
reached AS (SELECT of, need, coalesce(max(CASE WHEN upto <= need THEN upto END), 0) AS got FROM c GROUP BY of, need),
ends AS (SELECT c.of, arg_min(c.doc_id, (abs(need - got - size), rnk, doc_id)) AS doc_id FROM c JOIN reached USING (of, need)
         WHERE upto > need AND abs(need - got - size) < need - got GROUP BY c.of),
extra AS (SELECT doc_id FROM c WHERE upto <= need UNION ALL SELECT doc_id FROM ends)
SELECT u.doc_id, size, source_size, target, CAST(size * (whole + CASE WHEN e.doc_id IS NULL THEN 0 ELSE 1 END) AS BIGINT) AS taken
FROM u LEFT JOIN extra e ON u.doc_id = e.doc_id
"""

ORACLE["op1_warc"] = r"""
WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS sha FROM pages),
m AS (SELECT *, max(page_id) OVER (PARTITION BY sha) AS last FROM p)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes,
  array_to_string(list_transform(range(0, 32), lambda k: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    CAST(((('0x' || substr(sha, CAST(k // 4 * 5 + 1 AS INT), 5))::BIGINT >> CAST(15 - 5 * (k % 4) AS INT)) & 31) + 1 AS INT), 1)), '') AS payload_digest,
  CASE WHEN page_id = last THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> last THEN last END AS refers_to
FROM m
"""

ORACLE["op6_quality"] = r"""
WITH t AS (SELECT doc_id, lang, source, coalesce(text, '') AS x FROM documents),
w AS (SELECT *, regexp_extract_all(x, '[^\x20\x09-\x0D]+') AS ws, list_filter(string_split(x, chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS ls FROM t),
g AS (SELECT doc_id, i, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] AS s FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 1)) AS i FROM w)),
r AS (SELECT doc_id, i FROM g QUALIFY count(*) OVER (PARTITION BY doc_id, s) > 1),
c AS (SELECT doc_id, count(DISTINCT j) AS n FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS j FROM r) GROUP BY doc_id),
b AS (SELECT w.doc_id, lang, source, CAST(len(ws) AS BIGINT) AS n_words, CAST(length(regexp_replace(x, '[\x20\x09-\x0D]', '', 'g')) AS BIGINT) AS word_chars,
        CAST(length(x) - length(regexp_replace(x, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols, len(ls) AS n_lines,
        CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines, coalesce(c.n, 0) AS n_repeat_words
      FROM w LEFT JOIN c USING (doc_id)),
m AS (SELECT *, (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AS base_failed,
        CASE WHEN n_words > 0 THEN 1000 * word_chars // n_words ELSE 0 END AS f1, CASE WHEN n_words > 0 THEN 1000 * n_symbols // n_words ELSE 0 END AS f2,
        CASE WHEN n_lines > 0 THEN 1000 * n_dup_lines // n_lines ELSE 0 END AS f3, CASE WHEN n_words > 0 THEN 1000 * n_repeat_words // n_words ELSE 0 END AS f4 FROM b),
f AS (SELECT lang, source, unnest([1, 2, 3, 4]) AS k, unnest([f1, f2, f3, f4]) AS v FROM m WHERE NOT base_failed),
bins AS (SELECT lang, source, k, CAST(floor(v / pow(2.0, greatest(length(bin(v)) - 6, 0))) * pow(2.0, greatest(length(bin(v)) - 6, 0)) AS BIGINT) AS bin FROM f),
s AS (SELECT lang, source, k, bin, count(*) AS n FROM bins GROUP BY ALL),
o AS (SELECT *, sum(n) OVER (PARTITION BY lang, source, k ORDER BY bin) AS upto, sum(n) OVER (PARTITION BY lang, source, k) AS size FROM s),
own AS (SELECT lang, source, k, any_value(size) AS size, min(bin) FILTER (10 * upto >= size) AS lo, min(bin) FILTER (10 * upto >= 5 * size) AS mid, min(bin) FILTER (10 * upto >= 9 * size) AS hi FROM o GROUP BY lang, source, k),
s2 AS (SELECT lang, k, bin, sum(n) AS n FROM s GROUP BY ALL),
o2 AS (SELECT *, sum(n) OVER (PARTITION BY lang, k ORDER BY bin) AS upto, sum(n) OVER (PARTITION BY lang, k) AS size FROM s2),
own2 AS (SELECT lang, k, any_value(size) AS size, min(bin) FILTER (10 * upto >= size) AS lo, min(bin) FILTER (10 * upto >= 5 * size) AS mid, min(bin) FILTER (10 * upto >= 9 * size) AS hi FROM o2 GROUP BY lang, k),
s3 AS (SELECT k, bin, sum(n) AS n FROM s GROUP BY ALL),
o3 AS (SELECT *, sum(n) OVER (PARTITION BY k ORDER BY bin) AS upto, sum(n) OVER (PARTITION BY k) AS size FROM s3),
own3 AS (SELECT k, min(bin) FILTER (10 * upto >= size) AS lo, min(bin) FILTER (10 * upto >= 5 * size) AS mid, min(bin) FILTER (10 * upto >= 9 * size) AS hi FROM o3 GROUP BY k),
q AS (SELECT own.lang, own.source, own.k,
        CASE WHEN own.size >= 50 THEN own.lo WHEN own2.size >= 50 THEN own2.lo ELSE own3.lo END AS lo,
        CASE WHEN own.size >= 50 THEN own.mid WHEN own2.size >= 50 THEN own2.mid ELSE own3.mid END AS mid,
        CASE WHEN own.size >= 50 THEN own.hi WHEN own2.size >= 50 THEN own2.hi ELSE own3.hi END AS hi
      FROM own JOIN own2 ON own.lang IS NOT DISTINCT FROM own2.lang AND own.k = own2.k JOIN own3 ON own.k = own3.k),
lim AS (SELECT *, greatest(5 * (hi - mid), ([200, 100, 300, 50])[k]) AS up, greatest(5 * (mid - lo), ([200, 100, 300, 50])[k]) AS down FROM q),
bad AS (SELECT DISTINCT m.doc_id FROM (SELECT doc_id, lang, source, unnest([1, 2, 3, 4]) AS k, unnest([f1, f2, f3, f4]) AS v FROM m) m
        LEFT JOIN lim ON m.lang IS NOT DISTINCT FROM lim.lang AND m.source IS NOT DISTINCT FROM lim.source AND m.k = lim.k
        WHERE coalesce(v NOT BETWEEN lo - down AND hi + up, TRUE))
SELECT m.doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND bad.doc_id IS NULL AS kept
FROM m LEFT JOIN bad ON m.doc_id = bad.doc_id
"""

ORACLE["op7_substring_dedup"] = r"""
WITH w AS (SELECT doc_id, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS ws FROM documents),
p AS (SELECT doc_id, i, array_to_string(ws[i:i + 34], ' ') AS s FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 33)) AS i FROM w)),
r AS (SELECT doc_id, i FROM p QUALIFY count(*) OVER (PARTITION BY md5(s)) > 1),
c AS (SELECT DISTINCT doc_id, unnest(range(i, i + 35)) AS k FROM r),
t AS (SELECT doc_id, k, ws[k] AS word FROM (SELECT doc_id, ws, unnest(range(1, len(ws) + 1)) AS k FROM w)),
k AS (SELECT t.doc_id, count(*) AS n_kept, string_agg(word, ' ' ORDER BY t.k) AS kept FROM t LEFT JOIN c ON t.doc_id = c.doc_id AND t.k = c.k WHERE c.k IS NULL GROUP BY t.doc_id)
SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(len(ws) - coalesce(n_kept, 0) AS BIGINT) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM w LEFT JOIN k ON w.doc_id = k.doc_id
"""

ORACLE["op5_suffix_dedup"] = """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS hx FROM documents),
q AS (SELECT doc_id, base, substr(hx, 2 * base + 1, 1098) AS piece FROM (SELECT doc_id, hx, unnest(range(0, len(hx) // 2 - 49, 500)) AS base FROM d)),
p AS (SELECT doc_id, base + j AS i, substr(piece, 2 * j + 1, 100) AS s FROM (SELECT *, unnest(range(0, least(500, len(piece) // 2 - 49))) AS j FROM q)),
g AS (SELECT s, min(doc_id) AS first FROM p GROUP BY s HAVING min(doc_id) < max(doc_id)),
r AS (SELECT p.doc_id, i FROM p JOIN g ON p.s = g.s WHERE first < p.doc_id),
l AS (SELECT doc_id, i, lag(i) OVER (PARTITION BY doc_id ORDER BY i) AS before FROM r),
n AS (SELECT doc_id, i, sum(CASE WHEN i - before <= 50 THEN 0 ELSE 1 END) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM l),
x AS (SELECT doc_id, min(i) AS a, max(i) + 50 AS b FROM n GROUP BY doc_id, run),
y AS (SELECT *, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS upto FROM x),
k AS (SELECT y.doc_id, sum(b - a) AS n_removed, count(*) AS n_spans, max(b) AS last, string_agg(substr(hx, 2 * upto + 1, 2 * (a - upto)), '' ORDER BY a) AS kept
      FROM y JOIN d ON y.doc_id = d.doc_id GROUP BY y.doc_id)
SELECT d.doc_id, CAST(len(hx) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, coalesce(n_spans, 0) AS n_spans,
  sha256(unhex(CASE WHEN k.doc_id IS NULL THEN hx ELSE kept || substr(hx, 2 * last + 1) END)) AS kept_sha256
FROM d LEFT JOIN k ON d.doc_id = k.doc_id
"""

ORACLE["op11_repair_conversations"] = r"""
WITH RECURSIVE named AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS k FROM conversations),
coded AS (SELECT *, xor(list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(range(1, length(k) + 1), lambda i: [ascii(substr(k, i, 1))::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))),
    lambda c, x: CASE WHEN x >= 0 THEN xor(c, x) ELSE xor(c >> 1, 3988292384 * (c & 1)) END), 4294967295::BIGINT) % 20 AS fault FROM named),
damaged AS (SELECT conv_id, turn, CASE WHEN fault = 4 THEN 'user' ELSE role END AS role,
    CASE WHEN fault = 1 THEN '' WHEN fault = 2 THEN translate(text, '.!?', '') ELSE text END AS text, unnest(CASE WHEN fault = 3 THEN [1, 2] ELSE [1] END) AS copy FROM coded WHERE fault <> 0),
sorted AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS i, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) AS seen FROM damaged),
rows AS (SELECT conv_id, turn, role, text, i, substr(role, 1, 1) AS initial, CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'blank' WHEN seen > 1 THEN 'duplicate'
    WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') THEN 'truncated' ELSE '' END AS fault, lag(substr(role, 1, 1)) OVER (PARTITION BY conv_id ORDER BY i) || substr(role, 1, 1) AS pair FROM sorted),
counts AS (SELECT conv_id, CASE WHEN count(turn) = 0 THEN 0 ELSE max(turn) - min(turn) + 1 - count(DISTINCT turn) END AS gaps, count(*) FILTER (fault = 'blank') AS blank,
    count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated, count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal, count(*) AS n FROM rows GROUP BY conv_id),
inserts AS (SELECT * FROM (VALUES (0, 0, 0), (0, 2, 1), (0, 3, 2), (1, 1, 0), (1, 2, 1), (1, 3, 2), (2, 2, 0), (2, 3, 1), (2, 2, 2), (3, 3, 0), (3, 2, 1), (3, 3, 2)) t(state, upon, times)),
steps AS (SELECT * FROM (VALUES ('D', 0, '', 0, 2), ('D', 1, '', 1, 2), ('D', 2, '', 2, 2), ('D', 3, '', 3, 2), ('K', 0, 's', 1, 0), ('K', 0, 'u', 2, 0), ('K', 1, 'u', 2, 0), ('K', 2, 'a', 3, 0), ('K', 3, 'u', 2, 0),
    ('R', 0, '', 2, 1), ('R', 1, '', 2, 1), ('R', 2, '', 3, 1), ('R', 3, '', 2, 1)) t(edit, upon, initial, next, price)),
ways AS (SELECT conv_id, 0 AS i, 0 AS state, 0 AS cost, '' AS path, '' AS repaired FROM counts
  UNION ALL
  SELECT conv_id, i, state, best.cost, best.path, best.repaired FROM (
    SELECT w.conv_id, w.i + 1 AS i, s.next AS state, min(struct_pack(
        cost := w.cost + 5 * k.times + s.price + CASE WHEN s.edit <> 'D' AND r.fault = 'truncated' THEN 5 ELSE 0 END, path := w.path || repeat('I', k.times::BIGINT) || s.edit,
        repaired := w.repaired || CASE WHEN k.times = 0 THEN '' WHEN w.state = 2 THEN chr(10) || 'assistant:' ELSE chr(10) || 'user:' END
          || CASE WHEN k.times < 2 THEN '' WHEN w.state = 2 THEN chr(10) || 'user:' ELSE chr(10) || 'assistant:' END
          || CASE WHEN s.edit = 'D' THEN '' WHEN s.edit = 'K' THEN chr(10) || r.role || ':' || r.text ELSE chr(10) || CASE WHEN s.next = 3 THEN 'assistant:' ELSE 'user:' END || r.text END)) AS best
    FROM ways w JOIN inserts k ON w.state = k.state JOIN rows r ON w.conv_id IS NOT DISTINCT FROM r.conv_id AND r.i = w.i + 1
    JOIN steps s ON s.upon = k.upon AND (s.initial = '' OR s.initial = r.initial) AND (s.edit = 'D' OR r.fault NOT IN ('blank', 'duplicate'))
    GROUP BY w.conv_id, w.i, s.next)),
ends AS (SELECT w.conv_id, min(struct_pack(cost := w.cost + CASE w.state WHEN 1 THEN 10 WHEN 2 THEN 5 ELSE 0 END, path := w.path || CASE w.state WHEN 1 THEN 'II' WHEN 2 THEN 'I' ELSE '' END,
    repaired := w.repaired || CASE w.state WHEN 1 THEN chr(10) || 'user:' || chr(10) || 'assistant:' WHEN 2 THEN chr(10) || 'assistant:' ELSE '' END)) AS best
  FROM ways w JOIN counts c ON w.conv_id IS NOT DISTINCT FROM c.conv_id AND w.i = c.n GROUP BY w.conv_id)
SELECT o.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, CAST(coalesce(blank, 0) AS BIGINT) AS blank, CAST(coalesce(duplicate, 0) AS BIGINT) AS duplicate, CAST(coalesce(truncated, 0) AS BIGINT) AS truncated,
  CAST(coalesce(illegal, 0) AS BIGINT) AS illegal, CAST(coalesce(best.cost, 0) AS BIGINT) AS cost, coalesce(best.path, '') AS audit, sha256(coalesce(substr(best.repaired, 2), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o LEFT JOIN counts ON o.conv_id IS NOT DISTINCT FROM counts.conv_id LEFT JOIN ends ON o.conv_id IS NOT DISTINCT FROM ends.conv_id
"""

ORACLE["op12_hard_negatives"] = """
WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS q FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
c AS (SELECT vec_id, label, unnest(range(1, len(q) + 1)) AS k, unnest(q) AS x FROM v),
p AS (SELECT a.vec_id AS anchor_id, a.label AS anchor_label, c.vec_id, c.label, CAST(sum(a.x * c.x) AS BIGINT) AS score FROM c a JOIN c ON a.k = c.k WHERE a.vec_id % 100 = 0 GROUP BY ALL),
pos AS (SELECT anchor_id, anchor_label, vec_id AS positive_id, score AS positive_score FROM p WHERE label = anchor_label AND vec_id <> anchor_id
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT pos.anchor_id, positive_id, CAST(row_number() OVER (PARTITION BY pos.anchor_id, positive_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id AS negative_id, positive_score, score AS negative_score
FROM pos JOIN p ON pos.anchor_id = p.anchor_id AND p.label <> pos.anchor_label AND 80 * positive_score <= 100 * score AND score <= positive_score
QUALIFY rank <= 5
"""
