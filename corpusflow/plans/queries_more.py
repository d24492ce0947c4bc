"""Further registered queries: library operators that the first list leaves out,
each with a DuckDB oracle written from the operator's rule.

Speech-like inputs (paths, times, alignments) are derived from the driver tables
by column expressions, the same on both sides.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusflow.functions import channels as C
from corpusflow.functions import metrics as M
from corpusflow.functions import text as TX
from corpusflow.functions.arabic import clean_arabic
from corpusflow.functions.exprs import lambda_expression
from corpusflow.operators import aggs as A
from corpusflow.operators import columns as P
from corpusflow.operators import filters as FL
from corpusflow.operators import folds as W
from corpusflow.operators import joins as J
from corpusflow.operators import shards as SH
from corpusflow.plans.queries import query
from corpusflow.plans.sqlbits import WS, norm, strip
from corpusflow.sources import paths as PATHS
from corpusflow.sources.manifest import SEQ, table

# --- paths: S5-S7, P8, P11-P13 --------------------------------------------------

_LEVELS = ("/d/raw/b{b}/c{c}/dev{d}/20{y}/{m}/{day}/{h}/s{s}/{f}")


def _paths(spark, sf):
    """One audio path for each conversation turn; some with another depth or name."""
    c = table(spark, sf, "conversations").select("conv_id", "turn", "role")
    lit = F.lit
    mid = F.concat(lit("/d/raw/b"), F.col("conv_id") % 2, lit("/c"), F.col("conv_id") % 3, lit("/dev"), F.col("conv_id") % 5, lit("/20"),
                   lit(20) + F.col("conv_id") % 4, lit("/"), F.col("turn") % 12 + 1, lit("/0"), F.col("turn") % 9 + 1, lit("/1"), F.col("turn") % 10)
    name = F.when(F.col("role") == "user", "mic.wav").when(F.col("turn") % 7 == 3, "other.wav").otherwise("spk.wav")
    return c.select(F.concat(mid, F.when(F.col("turn") % 11 == 5, F.lit("")).otherwise(F.concat(lit("/s"), F.col("conv_id"), lit("x"), F.col("turn"))), lit("/"), name).alias("audio_filepath"))


_PATHS_SQL = """SELECT '/d/raw/b' || conv_id % 2 || '/c' || conv_id % 3 || '/dev' || conv_id % 5 || '/20' || (20 + conv_id % 4) || '/' || (turn % 12 + 1)
  || '/0' || (turn % 9 + 1) || '/1' || (turn % 10) || CASE WHEN turn % 11 = 5 THEN '' ELSE '/s' || conv_id || 'x' || turn END || '/'
  || CASE WHEN role = 'user' THEN 'mic.wav' WHEN turn % 7 = 3 THEN 'other.wav' ELSE 'spk.wav' END AS path FROM conversations"""


@query("nine_part_paths", f"""
WITH p AS ({_PATHS_SQL}), s AS (SELECT path, string_split(substr(path, 8), '/') AS x FROM p)
SELECT path AS source_audio_filepath, x[1] AS country, x[2] AS location, x[3] AS device_id,
       x[4] || '-' || x[5] || '-' || x[6] || 'T' || x[7] || ':00:00' AS timestamp, x[8] AS session_id,
       left(x[9], 3) AS channel, x[4] AS year, x[5] AS month, x[6] AS day, x[7] AS hour,
       array_to_string(x[1:8], '/') AS hierarchy
FROM s WHERE len(x) = 9 AND x[9] IN ('mic.wav', 'spk.wav')""")
def q_nine_part_paths(spark, sf):
    return PATHS.nine_part_manifest(_paths(spark, sf), "/d/raw", preserve_structure=True).drop("relative_path")


@query("country_folder_paths", f"""
WITH p AS ({_PATHS_SQL}), s AS (SELECT path, string_split(path, '/') AS x FROM p)
SELECT path AS audio_filepath, '' AS text, x[11] AS session_id, x[6] AS device_id,
       x[7] || '-' || x[8] || '-' || x[9] || 'T' || x[10] || ':00:00' AS timestamp, 'Brand' AS brand, 'Land' AS country,
       'Brand Land' AS dataset_tag, 'employee' AS audio_type
FROM s WHERE path LIKE '/d/raw/b1/c2/%' AND x[-1] = 'spk.wav' AND len(x) >= 12""")
def q_country_folder_paths(spark, sf):
    return PATHS.country_folder_manifest(_paths(spark, sf), "b1", "c2", "Brand", "Land", "spk", "/d/raw")


@query("anchored_paths", f"""
WITH p AS ({_PATHS_SQL}), s AS (SELECT path, string_split(path, '/') AS x FROM p)
SELECT path AS audio_filepath, '' AS text, replace(x[-1], '.wav', '') AS session_id, x[6] AS device_id,
       x[7] || '-' || lpad(x[8], 2, '0') || '-' || x[9] || 'T' || x[10] || ':00:00' AS timestamp, 'Brand' AS brand, 'Land' AS country,
       'Brand Land' AS dataset_tag, 'customer' AS audio_type
FROM s WHERE x[5] = 'c1'""")
def q_anchored_paths(spark, sf):
    return PATHS.anchored_manifest(_paths(spark, sf), "c1", "Brand", "Land")


@query("path_tail_fields", f"""
WITH p AS ({_PATHS_SQL}), s AS (SELECT path, string_split(path, '/') AS x FROM p)
SELECT path AS audio_filepath, CASE WHEN len(x) >= 9 THEN x[-2] END AS session_id, CASE WHEN len(x) >= 9 THEN x[-3] END AS hour,
       CASE WHEN len(x) >= 9 THEN x[-4] END AS day, CASE WHEN len(x) >= 9 THEN x[-5] END AS month, CASE WHEN len(x) >= 9 THEN x[-6] END AS year,
       CASE WHEN len(x) >= 9 THEN x[-7] END AS device_id, CASE WHEN len(x) >= 9 THEN x[-8] END AS location,
       CASE WHEN len(x) >= 9 THEN x[-9] END AS country,
       x[-7] || '_' || x[-6] || x[-5] || x[-4] || '_' || x[-3] || '_' || x[-2] || '.wav' AS name
FROM s""")
def q_path_tail_fields(spark, sf):
    return P.path_tail_fields(_paths(spark, sf)).withColumn("name", P.structured_name(F.col("audio_filepath")))


@query("segment_names", """
WITH n AS (SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN 'au_dev' || doc_id % 5 || '_' || doc_id || '_' || lang ELSE 'seg' || doc_id END AS stem FROM documents)
SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN 'au_dev' || doc_id % 5 ELSE 'unknown_device' END AS device_id,
       CASE WHEN doc_id % 3 = 0 THEN split_part(stem, '_', 4) ELSE stem END AS session_id FROM n""")
def q_segment_names(spark, sf):
    stem = F.when(F.col("doc_id") % 3 == 0, F.concat(F.lit("au_dev"), F.col("doc_id") % 5, F.lit("_"), F.col("doc_id"), F.lit("_"), F.col("lang"))) \
        .otherwise(F.concat(F.lit("seg"), F.col("doc_id")))
    d = table(spark, sf, "documents").select("doc_id", P.segment_meta_from_name(F.concat(F.lit("/x/"), stem, F.lit(".wav"))).alias("m"))
    return d.select("doc_id", "m.device_id", "m.session_id")


@query("relative_paths", f"""
WITH p AS ({_PATHS_SQL})
SELECT CASE WHEN path LIKE '/d/raw/b1/c1/%' THEN substr(path, 14) WHEN path LIKE '/d/raw/b1/%' THEN '../' || substr(path, 11)
            ELSE '../../' || substr(path, 8) END AS audio_filepath FROM p""")
def q_relative_paths(spark, sf):
    return P.change_to_relative_path(_paths(spark, sf), "/d/raw/b1/c1")


# --- projections: P14-P16; expressions: E3, E7 -------------------------------------

@query("promote_predictions", """
SELECT doc_id, 'doc/' || doc_id || CASE WHEN doc_id % 4 = 0 THEN '.mp3' ELSE '.wav' END AS audio_filepath, lang AS orig_text, source AS text
FROM documents WHERE doc_id % 4 <> 0""")
def q_promote_predictions(spark, sf):
    ext = F.when(F.col("doc_id") % 4 == 0, ".mp3").otherwise(".wav")
    d = table(spark, sf, "documents").select("doc_id", F.concat(F.lit("doc/"), F.col("doc_id"), ext).alias("audio_filepath"),
                                             F.col("lang").alias("text"), F.col("source").alias("pred_text"))
    return P.promote_predictions(d)


@query("chat_prompt", """
SELECT conv_id, turn, 'system' AS role, 'Answer in en.' AS content FROM conversations
UNION ALL SELECT conv_id, turn, 'user' AS role, 'Turn ' || turn || ' of ' || conv_id || ': ' || text AS content FROM conversations""")
def q_chat_prompt(spark, sf):
    c = table(spark, sf, "conversations")
    m = P.chat_prompt({"system": "Answer in en.", "user": "Turn {turn} of {conv_id}: {text}"})
    return c.select("conv_id", "turn", F.explode(m).alias("m")).select("conv_id", "turn", "m.role", "m.content")


@query("entity_types", """
WITH t AS (SELECT o_orderkey, [o_orderstatus || ':' || o_orderpriority, 'x', 'k: ' || o_orderstatus, 'z:' || o_orderpriority] AS tags FROM orders)
SELECT o_orderkey, array_to_string(CASE WHEN trim(split_part(tags[1], ':', 2)) = trim(split_part(tags[3], ':', 2)) THEN [trim(split_part(tags[1], ':', 2))]
       ELSE [trim(split_part(tags[1], ':', 2)), trim(split_part(tags[3], ':', 2))] END, '|') AS types FROM t""")
def q_entity_types(spark, sf):
    tags = F.array(F.concat_ws(":", "o_orderstatus", "o_orderpriority"), F.lit("x"), F.concat(F.lit("k: "), F.col("o_orderstatus")),
                   F.concat(F.lit("z:"), F.col("o_orderpriority")))
    return table(spark, sf, "orders").select("o_orderkey", F.array_join(P.entity_types(tags), "|").alias("types"))


@query("expr_slices", """
SELECT doc_id, source[1:3] AS head, substr(lang, 2, 1) AS second, reverse(lang) AS back, abs(doc_id - 500) AS dist,
       least(doc_id, n_chars) AS low FROM documents""")
def q_expr_slices(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", "source", "lang", "n_chars")
    for name, e in (("head", "entry.source[:3]"), ("second", "entry.lang[1]"), ("back", "entry.lang[::-1]"), ("dist", "abs(entry.doc_id - 500)"),
                    ("low", "min(entry.doc_id, entry.n_chars)")):
        d = lambda_expression(d, name, e)
    return d.select("doc_id", "head", "second", "back", "dist", "low")


# --- filters: F10, F16, F18, F19, F21-F23 -----------------------------------------------

@query("drop_pauses", """
SELECT conv_id, turn FROM conversations WHERE turn % 5 <> 2 AND turn % 7 <> 3""")
def q_drop_pauses(spark, sf):
    t = F.when(F.col("turn") % 5 == 2, F.concat("text", F.lit(" (pause 12)"))).when(F.col("turn") % 7 == 3, F.concat(F.lit("(pause 0.5)"), F.col("text"))) \
        .when(F.col("turn") % 3 == 1, F.concat("text", F.lit(" (pause x)"))).otherwise(F.col("text"))
    return FL.drop_pauses(table(spark, sf, "conversations").withColumn("text", t)).select("conv_id", "turn")


@query("length_ratio", """
SELECT o_orderkey, o_custkey FROM orders WHERE o_orderkey > 1 AND o_custkey > 1
AND greatest(o_orderkey / o_custkey, o_custkey / o_orderkey) < 1.5""")
def q_length_ratio(spark, sf):
    return FL.length_ratio_gate(table(spark, sf, "orders").select("o_orderkey", "o_custkey"), "o_orderkey", "o_custkey", 1.5)


@query("probability_gate", "SELECT l_orderkey, l_linenumber, l_discount FROM lineitem WHERE l_discount >= 0.07")
def q_probability_gate(spark, sf):
    return FL.probability_gate(table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_discount"), "l_discount", 0.07)


@query("duration_window", """
SELECT doc_id, n_chars FROM documents WHERE n_chars >= 200 AND n_chars < 2000""")
def q_duration_window(spark, sf):
    return FL.duration_window(table(spark, sf, "documents").select("doc_id", "n_chars"), 200, 2000, "n_chars")


@query("split_membership", """
SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')""")
def q_split_membership(spark, sf):
    c = table(spark, sf, "customer").select(F.col("c_custkey").alias("file_prefix"), F.col("c_mktsegment").alias("split"))
    return FL.split_membership(table(spark, sf, "orders").select("o_orderkey", "o_custkey"), c, F.col("o_custkey"), data_split="BUILDING")


# --- aggregates: A7, A11, A13, A14 ----------------------------------------------------------

@query("session_totals", """
SELECT conv_id, sum(length(text) / 16.0) AS session_duration, count(*) AS segments FROM conversations
WHERE length(text) / 16.0 BETWEEN 1.0 AND 20.0 GROUP BY conv_id""")
def q_session_totals(spark, sf):
    c = table(spark, sf, "conversations").select("conv_id", (F.length("text") / 16.0).alias("duration"))
    return A.session_totals(c, "conv_id", min_duration=1.0, max_duration=20.0)


@query("restored_report", """
SELECT o_orderstatus, o_orderpriority, sum(CASE WHEN o_custkey % 4 <> 0 THEN o_orderkey ELSE 0 END) / 3600.0 AS restored_hours,
       sum(CASE WHEN o_custkey % 4 = 0 THEN o_orderkey ELSE 0 END) / 3600.0 AS lost_hours,
       avg(CASE WHEN o_custkey % 4 <> 0 THEN 1.0 ELSE 0.0 END) * 100 AS restored_pct
FROM orders GROUP BY ALL""")
def q_restored_report(spark, sf):
    o = table(spark, sf, "orders").select("o_orderstatus", "o_orderpriority", F.col("o_orderkey").cast("double").alias("duration"),
                                          F.when(F.col("o_custkey") % 4 == 0, "n/a").otherwise("ok").alias("restored_text"))
    return A.restored_report(o, ["o_orderstatus", "o_orderpriority"])


@query("decision_stats", """
SELECT l_returnflag, count(*) AS n, count(*) / (SELECT count(*) FROM lineitem)::DOUBLE AS rate FROM lineitem GROUP BY l_returnflag""")
def q_decision_stats(spark, sf):
    return A.decision_stats(table(spark, sf, "lineitem").select("l_returnflag"), "l_returnflag")


@query("top_counts", """
SELECT o_custkey, count(*) AS n FROM orders GROUP BY o_custkey ORDER BY n DESC, o_custkey LIMIT 10""")
def q_top_counts(spark, sf):
    return A.top_counts(table(spark, sf, "orders"), "o_custkey", 10)


# --- text: T10, T17, T23, T25 ---------------------------------------------------------------------

@query("arabic_clean_up", r"""
SELECT doc_id, regexp_replace(translate(regexp_replace(regexp_replace(regexp_replace(text, ' +', ' ', 'g'), '\n+', chr(10), 'g'), '^\n|\n$', '', 'g'), '?!:;-.,؟،؛', ''),
       'ـ', '', 'g') AS text FROM documents""")
def q_arabic_clean_up(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", "text")
    return d.select("doc_id", clean_arabic(F.col("text"), remove_punctuation=True, remove_tatweel=True, normalize_ligature=True, normalize=True).alias("text"))


@query("sentences_by_delimiter", f"""
WITH s AS (SELECT doc_id, unnest(string_split(text, '.')) AS x, generate_subscripts(string_split(text, '.'), 1) AS k FROM documents),
t AS (SELECT doc_id, k, {strip('x')} AS sentence FROM s)
SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY k) - 1 AS pos, sentence FROM t WHERE sentence <> ''""")
def q_sentences_by_delimiter(spark, sf):
    return table(spark, sf, "documents").select("doc_id", F.posexplode(TX.sentences_by_delimiter(F.col("text"), ".")).alias("pos", "sentence"))


@query("remove_punctuation", f"""
SELECT doc_id, lower(regexp_replace(translate(text, '!"#$%&()*+,-./:;<=>?@[\\]^_`{{|}}~', ''), '{WS}+', '', 'g')) AS text FROM documents""")
def q_remove_punctuation(spark, sf):
    return table(spark, sf, "documents").select("doc_id", TX.remove_punctuation(F.col("text"), exclude=["'"]).alias("text"))


@query("tokens_to_text", f"""
SELECT doc_id, lower(trim(regexp_replace({norm("replace(replace(text, ',', ' ,'), '.', ' .')")}, ' ([,.!?;:])', '\\1', 'g'))) AS text FROM documents""")
def q_tokens_to_text(spark, sf):
    spaced = F.replace(F.replace("text", F.lit(","), F.lit(" ,")), F.lit("."), F.lit(" ."))
    return table(spark, sf, "documents").select("doc_id", TX.reconstruct_from_tokens(TX.words(spaced), lower_case=True).alias("text"))


# --- metrics: F10 ------------------------------------------------------------------------------------

@query("wer_filter", f"""
WITH w AS (SELECT doc_id, {norm("text")} AS t, doc_id % 3 + 1 AS k FROM documents WHERE len(string_split({norm("text")}, ' ')) > 3),
l AS (SELECT doc_id, k, string_split(t, ' ') AS a FROM w)
SELECT doc_id, round_even(k / len(a)::DOUBLE * 100, 2) AS wer FROM l WHERE round_even(k / len(a)::DOUBLE * 100, 2) <= 5.0""")
def q_wer_filter(spark, sf):
    """The prediction lacks the first one to three words, so that is its distance."""
    w = TX.words(F.col("text"))
    d = table(spark, sf, "documents").select("doc_id", "text").repartition("doc_id").filter(F.size(w) > 3)
    pred = F.array_join(F.slice(w, (F.col("doc_id") % 3 + 2).cast("int"), F.size(w)), " ")
    return FL.drop_high_wer(d.withColumn("pred_text", pred), 5.0, out_col="wer").select("doc_id", "wer")


# --- joins and folds: J10-J12, W8; shards: D7, L5 ------------------------------------------------

def _speech(spark, sf):
    """Conversations as recordings: a segment for each turn."""
    c = table(spark, sf, "conversations").groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct(
        (F.col("turn") * 4.0).alias("start"), (F.col("turn") * 4.0 + 3.0).alias("end")))).alias("segments"), F.max("turn").alias("last"))
    return c.select("conv_id", F.concat(F.lit("/a/"), F.col("conv_id"), F.lit(".wav")).alias("audio_filepath"),
                    (F.col("last") * 4.0 + 4.0).alias("duration"), "segments")


@query("long_split", """
WITH RECURSIVE s AS (SELECT conv_id, max(turn) AS last FROM conversations GROUP BY conv_id),
c AS (SELECT conv_id, last, 0.0::DOUBLE AS begin, 0 AS k, (SELECT min(t.turn) FROM conversations t WHERE t.conv_id = s.conv_id AND t.turn * 4.0 + 3.0 > 10.0) AS over
      FROM s WHERE last * 4.0 + 4.0 >= 10.0
      UNION ALL
      SELECT conv_id, last, (over - 1) * 4.0 + 3.0, k + 1,
             (SELECT min(t.turn) FROM conversations t WHERE t.conv_id = c.conv_id AND t.turn * 4.0 + 3.0 - ((c.over - 1) * 4.0 + 3.0) > 10.0)
      FROM c WHERE over IS NOT NULL),
p AS (SELECT *, count(*) OVER (PARTITION BY conv_id) AS n, lead(begin) OVER (PARTITION BY conv_id ORDER BY k) AS stop FROM c)
SELECT conv_id, '/a/' || conv_id || '.' || (k + 1) || '_of_' || n || '.wav' AS audio_filepath, begin AS "offset",
       coalesce(stop, last * 4.0 + 4.0 - 0.01) - begin AS duration FROM p""")
def q_long_split(spark, sf):
    out = W.split_long(_speech(spark, sf), max_len=10.0, min_len=1.0, sample_rate=100)
    return out.filter("offset IS NOT NULL").select("conv_id", "audio_filepath", "offset", F.bround("duration", 6).alias("duration"))


@query("words_into_segments", """
WITH w AS (SELECT doc_id, unnest(range(0, 30)) AS k FROM documents),
t AS (SELECT doc_id, k, k * 1.0 AS s, k * 1.0 + 0.9 AS e FROM w),
g AS (SELECT unnest(range(0, 5)) AS g),
o AS (SELECT doc_id, k, g, greatest(0.0, least(e, g * 6.0 + 5.5) - greatest(s, g * 6.0)) AS ov FROM t, g)
SELECT doc_id, g AS seg, string_agg('w' || k, ' ' ORDER BY k) AS text FROM o WHERE ov > 0 GROUP BY doc_id, g""")
def q_words_into_segments(spark, sf):
    words = F.transform(F.sequence(F.lit(0), F.lit(29)), lambda k: F.struct(F.concat(F.lit("w"), k).alias("word"), (k * 1.0).alias("start"), (k * 1.0 + 0.9).alias("end")))
    segs = F.transform(F.sequence(F.lit(0), F.lit(4)), lambda g: F.struct((g * 6.0).alias("start"), (g * 6.0 + 5.5).alias("end")))
    d = table(spark, sf, "documents").select("doc_id", words.alias("al"), segs.alias("sg"))
    return d.select("doc_id", F.posexplode(W.words_into_segments(F.col("al"), F.col("sg"))).alias("seg", "s")).select("doc_id", "seg", "s.text")


@query("alignment_merge", """
SELECT o_orderkey, CASE WHEN n > 0 THEN round_even(hi + 0.5 - lo, 3) ELSE 0.0 END AS alignment_duration, coalesce(n, 0) AS n_words
FROM orders LEFT JOIN (SELECT l_orderkey, min(l_linenumber) * 1.0 AS lo, max(l_linenumber) * 1.0 AS hi, count(*) AS n FROM lineitem
                       WHERE l_quantity > 10 GROUP BY l_orderkey) ON l_orderkey = o_orderkey""")
def q_alignment_merge(spark, sf):
    w = F.struct((F.col("l_linenumber") * 1.0).alias("start"), (F.col("l_linenumber") * 1.0 + 0.5).alias("end"))
    al = table(spark, sf, "lineitem").filter("l_quantity > 10").groupBy(F.col("l_orderkey").alias("audio_filepath")).agg(F.array_sort(F.collect_list(w)).alias("alignment"))
    o = table(spark, sf, "orders").select(F.col("o_orderkey").alias("audio_filepath"))
    return J.alignment_merge(o, al).select(F.col("audio_filepath").alias("o_orderkey"), "alignment_duration", F.size("alignment").cast("long").alias("n_words"))


@query("shard_sample_names", """
WITH r AS (SELECT l_orderkey % 4 AS shard_id, '/a.b/' || l_partkey % 50 || '.flac' AS p, l_orderkey * 10 + l_linenumber AS k FROM lineitem),
n AS (SELECT *, row_number() OVER (PARTITION BY shard_id, p ORDER BY k) - 1 AS nth FROM r)
SELECT k, shard_id, p AS abs_audio_filepath,
       '_a_b_' || replace(substr(p, 6), '.flac', '') || CASE WHEN nth > 0 THEN '-sub' || nth ELSE '' END || '.flac' AS audio_filepath FROM n""")
def q_shard_sample_names(spark, sf):
    li = table(spark, sf, "lineitem").select((F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("k"), (F.col("l_orderkey") % 4).alias("shard_id"),
                                             F.concat(F.lit("/a.b/"), F.col("l_partkey") % 50, F.lit(".flac")).alias("audio_filepath"))
    return SH.sample_names(li, order=("k",))


@query("shard_sample_names_cut", """
SELECT conv_id, turn, 'x_' || conv_id || '_' || turn || '_5_2_0.wav' AS audio_filepath, turn + 0.5 AS source_audio_offset FROM conversations""")
def q_shard_sample_names_cut(spark, sf):
    c = table(spark, sf, "conversations").select("conv_id", "turn", F.concat(F.lit("x/"), F.col("conv_id"), F.lit(".wav")).alias("audio_filepath"),
                                                 (F.col("turn") + F.lit(0.5).cast("double")).alias("offset"), F.lit(2.0).cast("double").alias("duration"), F.lit(0).alias("shard_id"))
    return SH.sample_names(c).select("conv_id", "turn", "audio_filepath", "source_audio_offset")


@query("topk_labels", """
WITH s AS (SELECT row_number() OVER () AS rid, l_orderkey, l_linenumber, [{'l': 'qty', 'p': l_quantity / 50}, {'l': 'disc', 'p': l_discount * 10}, {'l': 'tax', 'p': l_tax * 12}] AS x FROM lineitem),
e AS (SELECT rid, l_orderkey, l_linenumber, unnest(x) AS u FROM s),
r AS (SELECT rid, l_orderkey, l_linenumber, u.l AS l, u.p AS p, row_number() OVER (PARTITION BY rid ORDER BY u.p DESC, u.l) AS n FROM e)
SELECT l_orderkey, l_linenumber, max(l) FILTER (n = 1) AS label_1, max(p) FILTER (n = 1) AS label_prob_1,
       max(l) FILTER (n = 2) AS label_2, max(p) FILTER (n = 2) AS label_prob_2 FROM r GROUP BY rid, l_orderkey, l_linenumber""")
def q_topk_labels(spark, sf):
    x = F.array(*[F.struct(F.lit(n).alias("label"), p.alias("prob")) for n, p in
                  (("qty", F.col("l_quantity") / 50), ("disc", F.col("l_discount") * 10), ("tax", F.col("l_tax") * 12))])
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", x.alias("x"))
    return li.select("l_orderkey", "l_linenumber", *[c.alias(n) for n, c in SH.topk_labels(F.col("x"), k=2).items()])


@query("similarity", """
SELECT p_partkey, 100.0 AS same, CASE WHEN length(p_name) > 0 THEN 200.0 * (length(p_name) - 1) / (2 * length(p_name) - 1) ELSE 100.0 END AS shorter
FROM part WHERE length(p_name) > 1""")
def q_similarity(spark, sf):
    p = table(spark, sf, "part").select("p_partkey", "p_name").filter(F.length("p_name") > 1).repartition("p_partkey")
    return p.select("p_partkey", M.similarity(F.col("p_name"), F.col("p_name")).alias("same"),
                    M.similarity(F.col("p_name"), F.expr("substring(p_name, 2)")).alias("shorter"))


# --- two channels: J4, T16, T18 ----------------------------------------------------------------------------
# The speaker's text is the beginning of the microphone's, of a share that depends on the
# turn; so their similarity has a closed form.

_SHARE = "CASE turn % 6 WHEN 0 THEN 1.0 WHEN 1 THEN 0.96 WHEN 2 THEN 0.7 WHEN 3 THEN 0.45 WHEN 4 THEN 0.1 ELSE 0.0 END"


def _two_channels(spark, sf):
    c = table(spark, sf, "conversations").select("conv_id", "turn", F.col("text").alias("mic"))
    c = c.withColumn("spk", F.expr(f"substring(mic, 1, CAST(floor(length(mic) * {_SHARE}) AS INT))")).repartition("conv_id")
    return c.withColumn("sim", M.similarity(F.lower("mic"), F.lower("spk")))


_CHANNELS_SQL = f"""
WITH c AS (SELECT conv_id, turn, text AS mic, left(text, CAST(floor(length(text) * {_SHARE}) AS INT)) AS spk FROM conversations),
s AS (SELECT *, 200.0 * length(spk) / (length(mic) + length(spk)) AS sim,
             list_distinct(list_filter(regexp_split_to_array(lower(mic), '\\s+'), lambda x: x <> '')) AS mw,
             list_distinct(list_filter(regexp_split_to_array(lower(spk), '\\s+'), lambda x: x <> '')) AS sw FROM c),
b AS (SELECT *, CASE WHEN mic = '' OR spk = '' THEN 0.0 ELSE greatest(sim / 100.0, CASE WHEN len(sw) > 0 THEN len(list_intersect(mw, sw)) / len(sw) ELSE 0 END) END AS score FROM s)"""


@query("channel_bleeding", _CHANNELS_SQL + """
SELECT conv_id, turn, score, mic <> '' AND spk <> '' AND score >= 0.98 AS detected FROM b""")
def q_channel_bleeding(spark, sf):
    b = _two_channels(spark, sf).select("conv_id", "turn", C.bleeding(F.col("mic"), F.col("spk"), F.col("sim"), 0.98).alias("b"))
    return b.select("conv_id", "turn", "b.score", "b.detected")


@query("channel_choice", _CHANNELS_SQL + """
SELECT conv_id, turn, CASE WHEN spk = '' THEN mic WHEN score >= 1.01 THEN spk WHEN sim / 100 >= 0.9 THEN spk ELSE mic END AS text,
       CASE WHEN spk = '' THEN 'mic' WHEN sim / 100 >= 0.9 THEN 'spk_validated' WHEN sim / 100 >= 0.6 THEN 'merged' ELSE 'mic' END AS source,
       CASE WHEN spk = '' THEN 0.5 ELSE sim / 100 END AS confidence FROM b""")
def q_channel_choice(spark, sf):
    c = _two_channels(spark, sf)
    b = c.withColumn("b", C.bleeding(F.col("mic"), F.col("spk"), F.col("sim"), 1.01))
    r = b.select("conv_id", "turn", C.corrected(F.col("mic"), F.col("spk"), F.col("sim"), F.col("b.score"), 1.01).alias("r"))
    return r.select("conv_id", "turn", "r.text", "r.source", "r.confidence")


@query("channel_validation", _CHANNELS_SQL + """
SELECT conv_id, turn, CASE WHEN spk = '' THEN mic WHEN sim >= 80 THEN mic ELSE spk END AS text,
       CASE WHEN mic = '' AND spk = '' THEN 0.0 WHEN spk = '' THEN 0.5 ELSE sim / 100 END AS confidence,
       CASE WHEN spk = '' THEN NULL WHEN sim >= 80 THEN 'high' WHEN sim >= 50 THEN 'medium' ELSE 'low' END AS agreement FROM b""")
def q_channel_validation(spark, sf):
    """Of agreeing texts the longer one, of others the speaker's."""
    c = _two_channels(spark, sf)
    sure = C.validated(F.col("mic"), F.col("spk"), F.col("sim"), use_cleaner_channel=False)
    weak = C.validated(F.col("mic"), F.col("spk"), F.col("sim"), use_cleaner_channel=True)
    r = c.select("conv_id", "turn", F.when(F.col("sim") >= 80, sure).otherwise(weak).alias("r"))
    return r.select("conv_id", "turn", "r.text", "r.confidence", "r.agreement")
