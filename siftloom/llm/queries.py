"""The corpus operators as queries over the tables of a folder, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from pyspark.sql import functions as F

from .audit import filter_audit
from .chat import chat_format, read_back
from .common import crc_mod, table
from .exactdedup import exact_dedup
from .jaccard import similar_groups
from .langid import fit, predict
from .linededup import line_dedup
from .lm import lm_scores
from .merkle import manifest
from .mixing import mix
from .packing import best_fit_packing
from .pieces import round_trip
from .quality import CUTS, quality_rules
from .tokencount import token_counts

Query = Callable[[SparkSession, str], DataFrame]


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held = crc_mod(F.col("doc_id"), 5) == 0
    model = fit(docs, train=~held)
    found = predict(docs.select("doc_id", held.alias("held_out"), "text"), model)
    return found.select("doc_id", "held_out", "lang_pred", "score")


def op2_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return lm_scores(docs, train=crc_mod(F.col("doc_id"), 5) != 1)


def op3_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op6_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return best_fit_packing(table(spark, sf_dir, "documents"))


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    talks = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    more = spark.createDataFrame([(-7, 0, "user", "</s>[INST] ok [/INST]"), (-7, 1, "assistant", "</s>[INST] ok [/INST]")], talks.schema)
    return read_back(chat_format(talks.unionByName(more)))


def op9_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similar_groups(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op11_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = round_trip(table(spark, sf_dir, "documents").select("doc_id", "text"))
    ids = F.array_join(F.col("ids").cast("array<string>"), " ")
    return done.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(ids.cast("binary"), 256).alias("ids_sha256"), F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest(table(spark, sf_dir, "documents"))


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def queries() -> dict[str, Query]:
    found = (op1_language_id, op2_lm_scoring, op3_source_mixing, op4_line_dedup, op5_exact_dedup, op6_best_fit_packing, op7_quality_rules, op8_chat_formatting, op9_ngram_jaccard, op10_token_counts, op11_pieces, op12_merkle_manifest, op13_filter_audit)
    return {f.__name__: f for f in found}


_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

_BLANK = r"[\x20\x09-\x0D]"
_CUTS = "[" + ", ".join(f"{c}::DOUBLE" for c in CUTS) + "]"
_RULES = {"symbols": "n_symbols / greatest(word_chars, 1)", "dup_lines": "n_dup_lines / greatest(n_lines, 1)", "repeats": "n_repeat_words / greatest(n_words, 1)"}
_MET = ", ".join(f"len(list_filter({_CUTS}, lambda c: c >= {m})) AS {r}" for r, m in _RULES.items())
_EACH = f"unnest([{', '.join(f"'{r}'" for r in _RULES)}]) AS rule, unnest([{', '.join(_RULES)}]) AS k"

_SQL = {
    "op3_source_mixing": rf"""WITH d AS (SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size, left(md5(concat(coalesce(CAST(doc_id AS VARCHAR), ''), chr(31), coalesce(text, ''))), 14) AS h FROM documents),
s AS (SELECT source, n, 2.0::DOUBLE * n AS most, [5, 2, 1][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3]::DOUBLE AS weight FROM (SELECT source, CAST(sum(size) AS BIGINT) AS n FROM d GROUP BY 1)),
f AS (SELECT *, most / weight AS full_at, (1.5 * (SELECT sum(n) FROM s) - coalesce(sum(most) OVER w, 0)) / ((SELECT sum(weight) FROM s) - coalesce(sum(weight) OVER w, 0)) AS rate FROM s WINDOW w AS (ORDER BY most / weight, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
t AS (SELECT source, n, round(least(most, weight * (SELECT max(rate) FROM f WHERE rate <= full_at)), 6) AS target FROM f),
b AS (SELECT *, CASE WHEN n = 0 THEN 0 ELSE least(2, CAST(floor(target / n) AS BIGINT)) END AS whole FROM t),
v AS (SELECT source, h, sum(size) AS size, sum(sum(size)) OVER (PARTITION BY source ORDER BY h) AS upto FROM d GROUP BY 1, 2)
SELECT d.doc_id, d.size, b.n AS source_size, b.target, CAST(d.size * (b.whole + CASE WHEN b.target - b.whole * b.n > 0.5 AND (v.upto <= b.target - b.whole * b.n OR (v.upto - v.size <= b.target - b.whole * b.n AND 2 * (b.target - b.whole * b.n - v.upto + v.size) >= v.size)) THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM d JOIN b ON d.source IS NOT DISTINCT FROM b.source JOIN v ON d.source IS NOT DISTINCT FROM v.source AND d.h = v.h""",
    "op7_quality_rules": rf"""WITH w AS (SELECT doc_id, lang, coalesce(text, '') AS x, list_filter(regexp_split_to_array(coalesce(text, ''), '{_BLANK}+'), lambda t: t <> '') AS ws, list_filter(string_split(coalesce(text, ''), chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS ls FROM documents),
b AS (SELECT doc_id, lang, len(ws) AS n_words, CAST(coalesce(list_sum(list_transform(ws, lambda t: length(t))), 0) AS BIGINT) AS word_chars, length(regexp_replace(x, '[^#*$%&|<>]+', '', 'g')) AS n_symbols, len(ls) AS n_lines, len(ls) - len(list_distinct(ls)) AS n_dup_lines FROM w),
g AS (SELECT doc_id, i FROM (SELECT doc_id, i, array_to_string(ws[i:i + 4], ' ') AS five FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 3)) AS i FROM w WHERE len(ws) >= 5)) QUALIFY count(*) OVER (PARTITION BY doc_id, five) > 1),
r AS (SELECT doc_id, count(DISTINCT j) AS n FROM (SELECT doc_id, unnest(range(i, i + 5)) AS j FROM g) GROUP BY 1),
m AS (SELECT b.*, coalesce(r.n, 0) AS n_repeat_words, n_words < 10 OR 100 * coalesce(r.n, 0) > 20 * n_words AS base_failed FROM b LEFT JOIN r USING (doc_id)),
good AS (SELECT doc_id FROM labels WHERE quality IS NOT NULL GROUP BY 1 HAVING max(quality) = 1),
lv AS (SELECT doc_id, lang AS s, substr(md5(CAST(doc_id AS VARCHAR)), 1, 1) IN ('0', '4', '8', 'c') AS orders, {_MET} FROM m JOIN good USING (doc_id) WHERE NOT base_failed),
sz AS (SELECT s, count(*) AS n FROM lv WHERE NOT orders GROUP BY 1 HAVING count(*) * ln(0.97) <= ln(0.05)),
pk AS (SELECT s, k, sum(exp(lgamma(n + 1) - lgamma(k + 1) - lgamma(n - k + 1) + k * ln(0.03) + (n - k) * ln(0.97))) OVER (PARTITION BY s ORDER BY k) AS below FROM (SELECT s, n, unnest(range(0, n + 1)) AS k FROM sz)),
bud AS (SELECT s, max(k) FILTER (WHERE below <= 0.05 / (SELECT count(*) FROM sz)) AS most FROM pk GROUP BY 1),
c AS (SELECT s, rule, unnest(range(0, {len(CUTS)})) AS k FROM (SELECT s, unnest([{', '.join(f"'{r}'" for r in _RULES)}]) AS rule FROM bud)),
o AS (SELECT s, rule, k, count(*) AS n FROM (SELECT s, {_EACH} FROM lv WHERE orders) GROUP BY ALL),
l AS (SELECT c.s, c.rule, c.k, sum(coalesce(o.n, 0)) OVER (PARTITION BY c.s, c.rule ORDER BY c.k) AS lost FROM c LEFT JOIN o ON c.s IS NOT DISTINCT FROM o.s AND c.rule = o.rule AND c.k = o.k),
p AS (SELECT s, rule, k, row_number() OVER (PARTITION BY s ORDER BY lost, k, rule) AS step FROM l),
h AS (SELECT doc_id, s, {_EACH} FROM lv WHERE NOT orders),
f AS (SELECT s, step, sum(count(*)) OVER (PARTITION BY s ORDER BY step) AS lost FROM (SELECT h.doc_id, h.s, min(p.step) AS step FROM h JOIN p ON h.s IS NOT DISTINCT FROM p.s AND h.rule = p.rule AND h.k = p.k GROUP BY 1, 2) GROUP BY 1, 2),
e AS (SELECT b2.s, coalesce(min(f.step) FILTER (WHERE f.lost > b2.most), 1000) AS fail FROM bud b2 LEFT JOIN f ON b2.s IS NOT DISTINCT FROM f.s WHERE b2.most IS NOT NULL GROUP BY 1),
t AS (SELECT p.s, {", ".join(f"min({_CUTS}[p.k + 1]) FILTER (WHERE rule = '{r}') AS {r}" for r in _RULES)} FROM p JOIN e ON p.s IS NOT DISTINCT FROM e.s WHERE p.step < e.fail GROUP BY 1)
SELECT m.doc_id, m.lang, n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND NOT ({" OR ".join(f"coalesce({m} > t.{r}, false)" for r, m in _RULES.items())}) AS kept FROM m LEFT JOIN t ON m.lang IS NOT DISTINCT FROM t.s""",
    "op12_merkle_manifest": f"""WITH RECURSIVE h AS (SELECT doc_id, source, text, {"||".join(f"coalesce(concat(strlen(CAST({c} AS VARCHAR)), ':', {c}), '-')" for c in ("doc_id", "source", "lang", "n_chars"))} AS head,
  list_reduce([4294967295::UBIGINT] || list_transform(string_split(coalesce(CAST(doc_id AS VARCHAR), ''), ''), lambda c: CASE WHEN c = '' THEN NULL ELSE unicode(c)::UBIGINT END),
    lambda a, b: CASE WHEN b IS NULL THEN a ELSE list_reduce([xor(a, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, y: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END) END) AS crc FROM documents),
l AS (SELECT doc_id, source, sha256(head || coalesce(concat(strlen(text), ':', text), '-')) AS leaf, sha256(head || coalesce(concat(strlen(u), ':', u), '-')) AS again
  FROM (SELECT *, CASE WHEN xor(crc, 4294967295) % 2 = 0 THEN replace(text, chr(10), '') ELSE text END AS u FROM h)),
n AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i, count(*) OVER (PARTITION BY source) AS n FROM l),
up AS (SELECT source, 0 AS lv, i, n, leaf AS hash, '' AS pre FROM n
  UNION ALL SELECT source, any_value(lv) + 1, i // 3, any_value((n + 2) // 3), sha256(string_agg(hash, '' ORDER BY i)), string_agg(hash, '' ORDER BY i) FROM up WHERE n > 1 GROUP BY source, i // 3),
s AS (SELECT source, hash, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS i, count(*) OVER () AS n FROM up WHERE n = 1),
top AS (SELECT 0 AS lv, i, n, hash, '' AS pre FROM s
  UNION ALL SELECT any_value(lv) + 1, i // 3, any_value((n + 2) // 3), sha256(string_agg(hash, '' ORDER BY i)), string_agg(hash, '' ORDER BY i) FROM top WHERE n > 1 GROUP BY i // 3),
f AS (SELECT doc_id, source, leaf, i AS own, again AS cur, 0 AS lv, i, '' AS sib FROM n
  UNION ALL SELECT f.doc_id, f.source, f.leaf, f.own, sha256(left(u.pre, CAST(f.i % 3 * 64 AS BIGINT)) || f.cur || substr(u.pre, f.i % 3 * 64 + 65)), f.lv + 1, f.i // 3, f.sib || left(u.pre, CAST(f.i % 3 * 64 AS BIGINT)) || substr(u.pre, f.i % 3 * 64 + 65)
  FROM f JOIN up u ON u.source IS NOT DISTINCT FROM f.source AND u.lv = f.lv + 1 AND u.i = f.i // 3),
a AS (SELECT * FROM f QUALIFY lv = max(lv) OVER (PARTITION BY source)),
g AS (SELECT a.doc_id, a.leaf, s.hash AS subroot, a.cur, 0 AS lv, s.i, a.sib FROM a JOIN s ON a.source IS NOT DISTINCT FROM s.source
  UNION ALL SELECT g.doc_id, g.leaf, g.subroot, sha256(left(u.pre, CAST(g.i % 3 * 64 AS BIGINT)) || g.cur || substr(u.pre, g.i % 3 * 64 + 65)), g.lv + 1, g.i // 3, g.sib || left(u.pre, CAST(g.i % 3 * 64 AS BIGINT)) || substr(u.pre, g.i % 3 * 64 + 65)
  FROM g JOIN top u ON u.lv = g.lv + 1 AND u.i = g.i // 3)
SELECT doc_id, leaf, subroot, top.hash AS root, sha256(sib) AS proof_sha256, cur AS folded_root, cur = top.hash AS verified FROM g JOIN top ON top.n = 1 AND g.lv = top.lv""",
    "op13_filter_audit": r"""WITH w AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS x, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
p AS (SELECT doc_id, part, [CAST(b AS INT) FOR b IN [len(ws) < 50, 100 * len(list_distinct(ws)) < 65 * len(ws), 100 * length(regexp_replace(x, '[^A-Z]+', '', 'g')) > 5 * length(x), regexp_matches(x, '[#$%&*|]'), coalesce(doc_id > min(doc_id) OVER (PARTITION BY x), false)]] AS f FROM w),
l AS (SELECT doc_id, coalesce(max(quality) = 1, false) AS good, coalesce(max(toxic) = 1, false) AS toxic FROM labels GROUP BY 1),
c AS (SELECT part, f, count(*) AS n, count(*) FILTER (WHERE good) AS good, count(*) FILTER (WHERE toxic) AS toxic FROM p LEFT JOIN l USING (doc_id) GROUP BY 1, 2),
k AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS k),
o AS (SELECT a.k || b.k || c.k || d.k || e.k AS filter_order FROM k a, k b, k c, k d, k e WHERE len(list_distinct([a.k, b.k, c.k, d.k, e.k])) = 5),
s AS (SELECT filter_order, step, filter_order[step] AS letter, [strpos('ABCDE', x) FOR x IN string_split(filter_order[1:step - 1], '') IF x <> ''] AS earlier, strpos('ABCDE', filter_order[step]) AS own FROM o, range(1, 6) r(step)),
r AS (SELECT part, filter_order, CAST(step AS INT) AS step, letter,
  CAST(coalesce(sum(n) FILTER (WHERE f[own] = 0 AND NOT gone), 0) AS BIGINT) AS kept,
  CAST(coalesce(sum(n) FILTER (WHERE f[own] = 1 AND NOT gone), 0) AS BIGINT) AS removed,
  CAST(coalesce(sum(n) FILTER (WHERE f[own] = 1 AND gone), 0) AS BIGINT) AS redundant,
  CAST(coalesce(sum(n) FILTER (WHERE f[own] = 1 AND list_sum(f) = 1), 0) AS BIGINT) AS unique_fails,
  CAST(coalesce(sum(good) FILTER (WHERE f[own] = 1 AND NOT gone), 0) AS BIGINT) AS good_lost,
  CAST(coalesce(sum(toxic) FILTER (WHERE f[own] = 1 AND NOT gone), 0) AS BIGINT) AS toxic_lost
  FROM (SELECT c.*, s.*, len(list_filter(earlier, lambda j: f[j] = 1)) > 0 AS gone FROM c, s) GROUP BY 1, 2, 3, 4)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, CAST(sum(removed) OVER (PARTITION BY part, letter) AS BIGINT) AS shapley FROM r""",
    "op5_exact_dedup": f"""WITH n AS (SELECT doc_id, {_LOWER} AS t FROM documents)
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size, doc_id = max(doc_id) OVER w AS kept, sha256(t) AS text_sha256 FROM n WINDOW w AS (PARTITION BY t)""",
    "op8_chat_formatting": r"""WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
n AS (SELECT *, length(text) + len(regexp_extract_all(text, '[<\[]\\*(?:/?INST\]|/?s>|</?SYS>>|/?ROLE\]|\|endoftext\|>)')) + CASE role WHEN 'assistant' THEN 7 WHEN 'system' THEN 15 ELSE 13 END
  + CASE WHEN role IN ('user', 'assistant', 'system') THEN 0 ELSE 13 + length(role) + len(regexp_extract_all(role, '[<\[]\\*(?:/?INST\]|/?s>|</?SYS>>|/?ROLE\]|\|endoftext\|>)')) END AS chars FROM c)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(concat(role, chr(10), text, chr(10)), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256, CAST(sum(chars) AS BIGINT) AS formatted_chars FROM n GROUP BY 1""",
}


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)
