"""Registered queries over the driver tables, each with its DuckDB oracle.

Every query reads whole tables (no id subsets, no row caps) and returns a
DataFrame whose column names match the oracle's.  The oracle is ``None``
where SQL cannot express the operator (diffs, sequence folds, seeded
sampling); those are checked against brute-force Python in ``tests/``.
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusflow.functions import metrics as M
from corpusflow.functions import text as TX
from corpusflow.operators import columns as P
from corpusflow.operators import filters as FL
from corpusflow.operators import shards as SH
from corpusflow.plans import flagship as FS
from corpusflow.plans.sqlbits import WS, doc_manifest, n_words, norm, strip, words
from corpusflow.session import small_batches
from corpusflow.sources.manifest import SEQ, documents_manifest, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return deco


def _gate_sql() -> str:
    pats = " OR ".join(f"regexp_matches(' ' || {norm('text')} || ' ', '{p}')" for p in FS.GATE_PATTERNS)
    g = FS.GATE_PARAMS
    return f"""
WITH m AS ({doc_manifest()}),
g AS (SELECT audio_filepath, doc_id, {norm('text')} AS text, duration FROM m WHERE NOT ({pats})),
r AS (SELECT *, {n_words('text')} AS num_words, round_even(length(text) / duration, 2) AS char_rate FROM g
      WHERE duration >= {g['min_duration']} AND duration <= {g['max_duration']}),
k AS (SELECT * FROM r WHERE char_rate >= {g['low_charrate']} AND char_rate <= {g['high_charrate']}),
f AS (SELECT text, min(doc_id) AS doc_id FROM k GROUP BY text)
SELECT k.audio_filepath, k.doc_id, k.text, k.duration, k.num_words, k.char_rate
FROM k JOIN f ON k.doc_id = f.doc_id
ORDER BY k.duration DESC, k.doc_id
"""


@query("flagship_text_gate", _gate_sql())
def flagship_text_gate(spark, sf):
    return FS.flagship(spark, sf)


def _sqlstr(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _orders(spark, sf):
    return table(spark, sf, "orders")


# --- 2.3 projections -----------------------------------------------------------

@query("keep_fields", "SELECT o_orderkey, o_custkey, o_totalprice FROM orders")
def q_keep_fields(spark, sf):
    return P.keep_only_fields(_orders(spark, sf), ["o_orderkey", "o_custkey", "o_totalprice"])


@query("flexible_keep_fields", "SELECT o_orderkey, o_orderstatus FROM orders")
def q_flexible_keep(spark, sf):
    return P.flexible_keep_fields(_orders(spark, sf), ["o_orderkey", "o_orderstatus", "o_comment"])


@query("missing_field_counts",
       "SELECT count(*) FILTER (WHERE o_orderkey IS NULL) AS o_orderkey, count(*) AS o_comment FROM orders")
def q_missing_counts(spark, sf):
    return P.missing_field_counts(_orders(spark, sf), ["o_orderkey", "o_comment"])


@query("drop_fields", "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders")
def q_drop_fields(spark, sf):
    return P.drop_fields(_orders(spark, sf), ["o_orderdate", "o_orderpriority", "o_comment"])


@query("rename_fields", "SELECT o_orderkey AS id, o_orderstatus AS price, o_totalprice AS total, "
                        "o_custkey, o_orderdate, o_orderpriority FROM orders")
def q_rename_fields(spark, sf):
    # applied in order: total <- o_totalprice, then price <- o_orderstatus, id <- o_orderkey
    return P.rename_fields(_orders(spark, sf), {"o_totalprice": "total", "o_orderstatus": "price",
                                                "o_orderkey": "id"})


@query("duplicate_fields", "SELECT *, o_totalprice AS price_copy, o_custkey AS customer FROM orders")
def q_duplicate_fields(spark, sf):
    return P.duplicate_fields(_orders(spark, sf), {"o_totalprice": "price_copy", "o_custkey": "customer"})


@query("constant_fields", "SELECT o_orderkey, 'en' AS lang, 2 AS version FROM orders")
def q_constant_fields(spark, sf):
    return P.add_constant_fields(_orders(spark, sf).select("o_orderkey"), {"lang": "en", "version": 2})


_COMBINE_SQL = f"""
WITH m AS (SELECT d.doc_id, CAST(l.quality AS VARCHAR) AS quality_label,
                  CASE WHEN d.source = 'src0' THEN 'n/a' ELSE d.lang END AS doc_lang
           FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)
SELECT doc_id,
       CASE WHEN quality_label IS NOT NULL AND quality_label <> 'n/a' THEN quality_label
            WHEN doc_lang IS NOT NULL AND doc_lang <> 'n/a' THEN doc_lang ELSE 'n/a' END AS label,
       CASE WHEN quality_label IS NOT NULL AND quality_label <> 'n/a' THEN 'labels'
            WHEN doc_lang IS NOT NULL AND doc_lang <> 'n/a' THEN 'documents' ELSE 'n/a' END AS label_origin
FROM m
"""


@query("combine_sources", _COMBINE_SQL)
def q_combine_sources(spark, sf):
    d = table(spark, sf, "documents")
    lab = table(spark, sf, "labels")
    m = d.join(lab, "doc_id", "left").select(
        "doc_id", F.col("quality").cast("string").alias("quality_label"),
        F.when(F.col("source") == "src0", F.lit("n/a")).otherwise(F.col("lang")).alias("doc_lang"))
    out = P.combine_sources(m, [{"field": "quality_label", "origin_label": "labels"},
                                {"field": "doc_lang", "origin_label": "documents"}], "label")
    return out.select("doc_id", "label", "label_origin")


_PAGES_PATH_SQL = """
WITH p AS (SELECT page_id, string_split(regexp_replace(url, '[?#].*$', ''), '/') AS parts FROM pages)
SELECT page_id,
       regexp_replace(parts[-1], '(.)\\.[^.]*$', '\\1') AS stem,
       parts[3] AS host,
       CASE WHEN len(parts) >= 5 THEN parts[4] END AS lang_dir,
       len(parts) AS depth
FROM p
"""


@query("path_parse", _PAGES_PATH_SQL)
def q_path_parse(spark, sf):
    """S5-S7/P9/P11-P12 building blocks: path split, stem, anchored parts."""
    p = table(spark, sf, "pages")
    parts = F.split(F.regexp_replace("url", "[?#].*$", ""), "/")
    return p.select("page_id",
                    P.file_stem(F.regexp_replace("url", "[?#].*$", "")).alias("stem"),
                    F.element_at(parts, 3).alias("host"),
                    F.when(F.size(parts) >= 5, F.element_at(parts, 4)).alias("lang_dir"),
                    F.size(parts).alias("depth"))


# --- P10 / E2-E9 expressions ---------------------------------------------------

_EXPR = ("entry.l_extendedprice * (1 - entry.l_discount) if entry.l_quantity > 10 "
         "else entry.l_extendedprice // 2")


@query("expr_column", """
SELECT l_orderkey, l_linenumber,
       CASE WHEN l_quantity > 10 THEN l_extendedprice * (1 - l_discount) ELSE floor(l_extendedprice / 2.0) END AS net,
       greatest(l_quantity, l_tax * 2) AS peak,
       l_quantity - 7 * floor(l_quantity / 7.0) AS qmod,
       length(l_returnflag || l_linestatus) AS flag_len,
       (l_returnflag = 'R' AND l_quantity >= 30) OR l_discount > 0.09 AS flagged
FROM lineitem""")
def q_expr_column(spark, sf):
    from corpusflow.functions.exprs import lambda_expression
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice",
                                             "l_discount", "l_tax", "l_returnflag", "l_linestatus")
    li = lambda_expression(li, "net", _EXPR)
    li = lambda_expression(li, "peak", "max(entry.l_quantity, entry.l_tax * 2)")
    li = lambda_expression(li, "qmod", "entry.l_quantity % 7")
    li = lambda_expression(li, "flag_len", "len(entry.l_returnflag + entry.l_linestatus)")
    li = lambda_expression(li, "flagged",
                           "entry.l_returnflag == 'R' and entry.l_quantity >= 30 or entry.l_discount > 0.09")
    return li.select("l_orderkey", "l_linenumber", "net", "peak", "qmod", "flag_len", "flagged")


@query("expr_filter", """
SELECT l_orderkey, l_linenumber, true AS keep FROM lineitem
WHERE l_returnflag = 'R' AND l_quantity >= 30""")
def q_expr_filter(spark, sf):
    from corpusflow.functions.exprs import lambda_expression
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag", "l_quantity")
    out = lambda_expression(li, "keep", "entry.l_returnflag == 'R' and entry.l_quantity >= 30", filter=True)
    return out.select("l_orderkey", "l_linenumber", "keep")


# --- 2.4 filters -----------------------------------------------------------------

for _op, _sym in [("lt", "<"), ("le", "<="), ("eq", "="), ("ne", "IS DISTINCT FROM"), ("ge", ">="), ("gt", ">")]:
    def _mk(op):
        def fn(spark, sf):
            li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
            return FL.preserve_by_value(li, "l_quantity", 25.0, op)
        return fn
    query(f"preserve_by_value_{_op}",
          f"SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE l_quantity {_sym} 25.0")(_mk(_op))


def _docs(spark, sf):
    return documents_manifest(spark, sf)


@query("char_rate", f"""
WITH m AS ({doc_manifest()})
SELECT doc_id, duration FROM m WHERE round_even(length(text) / duration, 2) BETWEEN 10.0 AND 16.0""")
def q_char_rate(spark, sf):
    return FL.drop_high_low_charrate(_docs(spark, sf), 16.0, 10.0).select("doc_id", "duration")


@query("word_rate", f"""
WITH m AS ({doc_manifest()})
SELECT doc_id, duration FROM m WHERE round_even({n_words('text')} / duration, 2) BETWEEN 1.8 AND 2.6""")
def q_word_rate(spark, sf):
    return FL.drop_high_low_wordrate(_docs(spark, sf), 2.6, 1.8).select("doc_id", "duration")


@query("duration_range", f"""
WITH m AS ({doc_manifest()})
SELECT doc_id, duration FROM m WHERE duration BETWEEN 20.0 AND 300.0""")
def q_duration_range(spark, sf):
    return FL.drop_high_low_duration(_docs(spark, sf), 300.0, 20.0).select("doc_id", "duration")


@query("rate_drop_counts", f"""
WITH m AS ({doc_manifest()}), r AS (SELECT round_even(length(text) / duration, 2) AS v FROM m)
SELECT count(*) FILTER (WHERE v < 10.0) AS dropped_low, count(*) FILTER (WHERE v > 16.0) AS dropped_high FROM r""")
def q_rate_drop_counts(spark, sf):
    return FL.high_low_counts(_docs(spark, sf), M.charrate("text", "duration"), 10.0, 16.0)


ALPHABET = ("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789 \n.,'!?;:-|")


@query("non_alphabet", f"""
SELECT doc_id FROM documents WHERE length(translate(text, {_sqlstr(ALPHABET)}, '')) = 0""")
def q_non_alphabet(spark, sf):
    return FL.drop_non_alphabet(_docs(spark, sf), ALPHABET).select("doc_id")


@query("non_alphabet_counts", f"""
WITH c AS (SELECT unnest(string_split(translate(text, {_sqlstr(ALPHABET)}, ''), '')) AS character FROM documents)
SELECT character, count(*) AS n FROM c WHERE character <> '' GROUP BY character""")
def q_non_alphabet_counts(spark, sf):
    return FL.non_alphabet_counts(_docs(spark, sf), ALPHABET)


KEEP_PATTERNS = [r"[ ](the|und|le|el)[ ]", r"[.][ ][A-Z]"]
DROP_PATTERNS = [r"[0-9]{3}", r"@", r"[|]"]


def _any_sql(x, pats):
    return " OR ".join(f"regexp_matches({x}, {_sqlstr(p)})" for p in pats)


@query("regex_none", f"""
SELECT doc_id, {norm('text')} AS text FROM documents
WHERE {_any_sql("' ' || " + norm('text') + " || ' '", KEEP_PATTERNS)}""")
def q_regex_none(spark, sf):
    return FL.drop_if_none_of_regex_match(_docs(spark, sf), KEEP_PATTERNS).select("doc_id", "text")


@query("regex_any", f"""
SELECT doc_id, {norm('text')} AS text FROM documents
WHERE NOT ({_any_sql("' ' || " + norm('text') + " || ' '", DROP_PATTERNS)})""")
def q_regex_any(spark, sf):
    return FL.drop_if_regex_match(_docs(spark, sf), DROP_PATTERNS).select("doc_id", "text")


def _regex_counts_sql():
    padded = "' ' || " + norm("text") + " || ' '"
    first = "CASE " + " ".join(f"WHEN regexp_matches(p, {_sqlstr(pat)}) THEN {i}"
                               for i, pat in enumerate(DROP_PATTERNS)) + " END"
    cnt = "CASE " + " ".join(f"WHEN i = {i} THEN len(regexp_extract_all(p, {_sqlstr(pat)}))"
                             for i, pat in enumerate(DROP_PATTERNS)) + " END"
    names = "[" + ", ".join(_sqlstr(p) for p in DROP_PATTERNS) + "]"
    return f"""
WITH a AS (SELECT {padded} AS p FROM documents), b AS (SELECT p, {first} AS i FROM a),
c AS (SELECT i, {cnt} AS n FROM b WHERE i IS NOT NULL)
SELECT {names}[i + 1] AS pattern, sum(n) AS matches FROM c GROUP BY i"""


@query("regex_match_counts", _regex_counts_sql())
def q_regex_match_counts(spark, sf):
    return FL.regex_match_counts(_docs(spark, sf), DROP_PATTERNS)


SUB_PARAMS = [
    {"pattern": r"[0-9]+", "repl": " <num> "},
    {"pattern": r"([A-Za-z]+)[|]([A-Za-z]+)", "repl": r"\2 \1"},
    {"pattern": r"[.]", "repl": " ! ", "count": 1},
    {"pattern": r"[ ]+,", "repl": ","},
]


def _sub_sql():
    x = "' ' || " + norm("text") + " || ' '"
    for p in SUB_PARAMS:
        flags = ", 'g'" if not p.get("count") else ""
        x = f"regexp_replace({x}, {_sqlstr(p['pattern'])}, {_sqlstr(p['repl'])}{flags})"
    return f"SELECT doc_id, {norm(x)} AS text FROM documents"


@query("sub_regex", _sub_sql())
def q_sub_regex(spark, sf):
    return _docs(spark, sf).select("doc_id", TX.sub_regex(F.col("text"), SUB_PARAMS).alias("text"))


@query("drop_on_attribute", "SELECT doc_id, quality FROM labels WHERE toxic = 0")
def q_drop_on_attribute(spark, sf):
    lab = table(spark, sf, "labels").withColumn("is_toxic", F.col("toxic") == 1)
    return FL.drop_on_attribute(lab, "is_toxic", drop_if_false=False).select("doc_id", "quality")


@query("drop_repeated", f"""
WITH seen AS (SELECT DISTINCT translate(text, '.,!?', '') AS k FROM benchmark)
SELECT doc_id FROM documents WHERE translate(text, '.,!?', '') NOT IN (SELECT k FROM seen)""")
def q_drop_repeated(spark, sf):
    bench = table(spark, sf, "benchmark")
    return FL.drop_repeated_fields(_docs(spark, sf), [bench], punctuations=".,!?").select("doc_id")


@query("drop_duplicates", """
SELECT doc_id, text FROM documents WHERE doc_id IN (SELECT min(doc_id) FROM documents GROUP BY text)""")
def q_drop_duplicates(spark, sf):
    return FL.drop_duplicates(_docs(spark, sf), "text").select("doc_id", "text")


# --- 2.10 metrics ------------------------------------------------------------------
# The prediction is a deterministic corruption of the ASCII-folded text (the
# oracle's edit distance counts bytes, so both sides work on ASCII).

def _ascii(c):
    return F.regexp_replace(c, "[^ -~]", "_")


def _pred(c):
    return F.replace(F.replace(c, F.lit("th"), F.lit("t")), F.lit("e"), F.lit("a"))


_ASCII_SQL = "regexp_replace(text, '[^ -~]', '_', 'g')"
_PRED_SQL = f"replace(replace({_ASCII_SQL}, 'th', 't'), 'e', 'a')"


def _asr_pairs(spark, sf):
    # Python distances dominate: the two columns are dealt out for them
    d = table(spark, sf, "documents").select("doc_id", "text").repartition("doc_id")
    return d.select("doc_id", _ascii(F.col("text")).alias("text")).withColumn("pred_text", _pred(F.col("text")))


@query("cer_filter", f"""
WITH p AS (SELECT doc_id, {_ASCII_SQL} AS t, {_PRED_SQL} AS p FROM documents),
c AS (SELECT doc_id, round_even(levenshtein(t, p) / length(t) * 100, 2) AS cer FROM p)
SELECT doc_id, cer FROM c WHERE cer <= 12.0""")
def q_cer_filter(spark, sf):
    return FL.drop_high_cer(_asr_pairs(spark, sf), 12.0, out_col="cer", on_zero="null").select("doc_id", "cer")


@query("wer_column")
def q_wer_column(spark, sf):
    """A text without words has no rate (null)."""
    return _asr_pairs(spark, sf).select("doc_id", M.wer("text", "pred_text", on_zero="null").alias("wer"))


# --- 2.10 text transforms -------------------------------------------------------------

@query("lower_case", "SELECT doc_id, lower(text) AS text FROM documents")
def q_lower(spark, sf):
    return _docs(spark, sf).select("doc_id", TX.lower("text").alias("text"))


@query("count_words", f"""
SELECT doc_id, {n_words('text')} AS num_words,
       {n_words("regexp_replace(text, '[^a-zA-Z ]', '', 'g')")} AS num_ascii_words FROM documents""")
def q_count_words(spark, sf):
    d = _docs(spark, sf)
    return d.select("doc_id", TX.count_words("text").alias("num_words"),
                    TX.count_words("text", alphabet="a-zA-Z ").alias("num_ascii_words"))


@query("latin_cyrillic", f"""
SELECT doc_id, translate(text, {_sqlstr(TX.LATIN_LOOKALIKE)}, {_sqlstr(TX.CYRILLIC_EQUIVALENT)}) AS text,
       length(text) - length(translate(text, {_sqlstr(TX.LATIN_LOOKALIKE)}, '')) AS replaced
FROM documents""")
def q_latin_cyrillic(spark, sf):
    d = _docs(spark, sf)
    return d.select("doc_id", TX.latin_to_cyrillic("text").alias("text"),
                    TX.latin_lookalike_count("text").alias("replaced"))


@query("make_sentence", f"""
WITH s AS (SELECT doc_id, upper(substr(text, 1, 1)) || substr(text, 2) AS t FROM documents)
SELECT doc_id, CASE WHEN regexp_matches(t, '\\p{{L}}$') THEN t || ':' ELSE t END AS text FROM s""")
def q_make_sentence(spark, sf):
    d = _docs(spark, sf)
    return d.select("doc_id", TX.make_sentence(F.col("text"), on_empty="keep").alias("text"))


# --- 2.5 joins ----------------------------------------------------------------------

@query("inner_join_suffix", """
WITH l AS (SELECT o_custkey AS id, o_totalprice AS amount, o_orderstatus AS status, o_orderkey FROM orders),
r AS (SELECT c_custkey AS id, c_acctbal AS amount, c_mktsegment AS status, c_name FROM customer)
SELECT l.id, l.amount AS amount_x, l.status AS status_x, l.o_orderkey, r.amount AS amount_y, r.status AS status_y,
       r.c_name
FROM l JOIN r ON l.id IS NOT DISTINCT FROM r.id""")
def q_inner_join_suffix(spark, sf):
    from corpusflow.operators.joins import inner_join
    l = _orders(spark, sf).select(F.col("o_custkey").alias("id"), F.col("o_totalprice").alias("amount"),
                                  F.col("o_orderstatus").alias("status"), "o_orderkey")
    r = table(spark, sf, "customer").select(F.col("c_custkey").alias("id"), F.col("c_acctbal").alias("amount"),
                                            F.col("c_mktsegment").alias("status"), "c_name")
    return inner_join(l, r, "id")


@query("inner_join_common", """
WITH l AS (SELECT o_orderkey AS okey, o_orderstatus AS status, o_totalprice FROM orders),
r AS (SELECT l_orderkey AS okey, l_linestatus AS status, l_linenumber FROM lineitem)
SELECT l.okey, l.status, l.o_totalprice, r.l_linenumber FROM l JOIN r
ON l.okey IS NOT DISTINCT FROM r.okey AND l.status IS NOT DISTINCT FROM r.status""")
def q_inner_join_common(spark, sf):
    from corpusflow.operators.joins import inner_join
    l = _orders(spark, sf).select(F.col("o_orderkey").alias("okey"), F.col("o_orderstatus").alias("status"),
                                  "o_totalprice")
    r = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("okey"), F.col("l_linestatus").alias("status"),
                                            "l_linenumber")
    return inner_join(l, r, None)


@query("left_metadata", """
WITH m AS (SELECT DISTINCT p_partkey AS l_partkey, p_brand, p_size FROM part)
SELECT li.l_orderkey, li.l_linenumber, m.p_brand, m.p_size FROM lineitem li LEFT JOIN m USING (l_partkey)""")
def q_left_metadata(spark, sf):
    from corpusflow.operators.joins import left_metadata
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    meta = table(spark, sf, "part").withColumnRenamed("p_partkey", "l_partkey")
    return left_metadata(li, meta, ["l_partkey"], ["p_brand", "p_size"]).drop("l_partkey")


@query("metadata_lookup", """
SELECT o.o_orderkey, coalesce(c.c_name, CAST(o.o_custkey AS VARCHAR)) AS customer_name
FROM orders o LEFT JOIN (SELECT DISTINCT ON (c_custkey) c_custkey, c_name FROM customer ORDER BY c_custkey) c
ON o.o_custkey = c.c_custkey""")
def q_metadata_lookup(spark, sf):
    from corpusflow.operators.joins import metadata_lookup
    o = _orders(spark, sf).select("o_orderkey", "o_custkey")
    c = table(spark, sf, "customer").withColumnRenamed("c_custkey", "o_custkey")
    return metadata_lookup(o, c, ["o_custkey"], "c_name", "customer_name",
                           default=F.col("o_custkey").cast("string")).select("o_orderkey", "customer_name")


@query("upsert_predictions", """
WITH base AS (SELECT 'doc/' || doc_id || '.wav' AS audio_filepath, doc_id, text FROM documents),
p AS (SELECT 'doc/' || d.doc_id || '.wav' AS audio_filepath,
             CASE WHEN l.quality = 1 THEN lower(d.text) ELSE 'pred: ' || d.text END AS text
      FROM labels l JOIN documents d ON l.doc_id = d.doc_id)
SELECT base.audio_filepath, base.doc_id, coalesce(p.text, base.text) AS text
FROM base LEFT JOIN p USING (audio_filepath)""")
def q_upsert_predictions(spark, sf):
    from corpusflow.operators.joins import upsert_predictions
    d = table(spark, sf, "documents")
    lab = table(spark, sf, "labels")
    base = d.select(F.concat(F.lit("doc/"), F.col("doc_id").cast("string"), F.lit(".wav")).alias("audio_filepath"),
                    "doc_id", "text")
    ld = lab.join(d, "doc_id")
    path = F.concat(F.lit("doc/"), F.col("doc_id").cast("string"), F.lit(".wav")).alias("audio_filepath")
    p1 = ld.select(path, F.concat(F.lit("pred: "), F.col("text")).alias("text"), F.lit(1).alias(SEQ))
    p2 = ld.filter(F.col("quality") == 1).select(path, F.lower("text").alias("text"), F.lit(2).alias(SEQ))
    return upsert_predictions(base, p1.unionByName(p2), ["audio_filepath"], ["text"])


@query("reuse_cache", """
WITH ok AS (SELECT doc_id, toxic FROM labels WHERE quality = 1)
SELECT d.doc_id, ok.toxic AS result, ok.doc_id IS NOT NULL AS reused
FROM documents d LEFT JOIN ok USING (doc_id)""")
def q_reuse_cache(spark, sf):
    from corpusflow.operators.joins import split_reuse
    d = table(spark, sf, "documents").select("doc_id")
    cache = table(spark, sf, "labels").select("doc_id", F.col("toxic").alias("result"),
                                              (F.col("quality") == 1).alias("ok"))
    reused, todo = split_reuse(d, cache, ["doc_id"], ["result"])
    return reused.withColumn("reused", F.lit(True)).unionByName(
        todo.withColumn("result", F.lit(None).cast("int")).withColumn("reused", F.lit(False)))


def _turns(spark, sf):
    """Conversation turns as timed segments: session = conv_id, 4 s per turn
    slot, speech length from the text (dyadic, so sums are exact)."""
    c = table(spark, sf, "conversations")
    return c.select("conv_id", "turn", "role", "text",
                    (F.col("turn") * 4.0).alias("offset"),
                    (F.length("text") / 64.0).alias("duration"),
                    F.col("turn").alias(SEQ))


_TURNS_SQL = ("SELECT conv_id, turn, role, text, turn * 4.0 AS \"offset\", length(text) / 64.0 AS duration "
              "FROM conversations")


@query("interval_pair", f"""
WITH t AS ({_TURNS_SQL}),
u AS (SELECT * FROM t WHERE role = 'user'), a AS (SELECT * FROM t WHERE role <> 'user'),
p AS (SELECT u.conv_id, u.turn, a.turn AS r_turn,
             (least(u."offset" + u.duration, a."offset" + a.duration) - greatest(u."offset", a."offset")) AS ov,
             least(u.duration, a.duration) AS mn
      FROM u JOIN a ON u.conv_id = a.conv_id),
g AS (SELECT conv_id, turn, min(r_turn) AS r_turn FROM p WHERE ov > 0 AND mn > 0 AND ov / mn > 0.5
      GROUP BY conv_id, turn)
SELECT u.conv_id, u.turn, g.r_turn FROM u LEFT JOIN g USING (conv_id, turn)""")
def q_interval_pair(spark, sf):
    from corpusflow.operators.joins import first_overlapping
    t = _turns(spark, sf)
    u = t.filter(F.col("role") == "user")
    a = t.filter(F.col("role") != "user")
    out = first_overlapping(u, a, "conv_id", "offset", "duration", ["conv_id", "turn"], ["conv_id", "turn"],
                            min_overlap=0.5, bucket_width=16.0)
    return out.select("conv_id", "turn", "r_turn")


@query("bleeding_match", f"""
WITH t AS ({_TURNS_SQL}),
u AS (SELECT * FROM t WHERE role = 'user'), a AS (SELECT * FROM t WHERE role <> 'user'),
p AS (SELECT u.conv_id, u.turn, a.turn AS r_turn,
             row_number() OVER (PARTITION BY u.conv_id, u.turn ORDER BY a."offset", a.turn) AS nth
      FROM u JOIN a ON u.conv_id = a.conv_id
       AND least(u."offset" + u.duration + 0.5, a."offset" + a.duration) > greatest(u."offset" - 0.5, a."offset")
       AND (least(u."offset" + u.duration + 0.5, a."offset" + a.duration) - greatest(u."offset" - 0.5, a."offset")) / u.duration > 0.5)
SELECT u.conv_id, u.turn, p.r_turn FROM u LEFT JOIN p ON p.conv_id = u.conv_id AND p.turn = u.turn AND p.nth = 1""")
def q_bleeding_match(spark, sf):
    from corpusflow.operators.joins import first_overlapping
    t = _turns(spark, sf)
    u = t.filter(F.col("role") == "user")
    a = t.filter(F.col("role") != "user")
    out = first_overlapping(u, a, "conv_id", "offset", "duration", ["conv_id", "turn"], ["conv_id", "turn"],
                            min_overlap=0.5, bucket_width=16.0, tolerance=0.5, share_of="left", right_order=["offset"])
    return out.select("conv_id", "turn", "r_turn")


@query("paired_exact", """
WITH u AS (SELECT conv_id, turn, printf('%d_%.2f_%.2f', conv_id, turn * 2.0, 2.0) AS k FROM conversations
           WHERE role = 'user'),
a AS (SELECT printf('%d_%.2f_%.2f', conv_id, (turn - 1) * 2.0, 2.0) AS k, max(turn) AS p_turn
      FROM conversations WHERE role = 'assistant' GROUP BY 1)
SELECT u.conv_id, u.turn, a.p_turn FROM u LEFT JOIN a USING (k)""")
def q_paired_exact(spark, sf):
    from corpusflow.operators.joins import exact_pair
    c = table(spark, sf, "conversations")
    u = c.filter(F.col("role") == "user").select(F.col("conv_id").alias("session_id"), "turn",
                                                  (F.col("turn") * 2.0).alias("offset"), F.lit(2.0).alias("duration"))
    a = c.filter(F.col("role") == "assistant").select(
        F.col("conv_id").alias("session_id"), "turn", ((F.col("turn") - 1) * 2.0).alias("offset"),
        F.lit(2.0).alias("duration"), F.col("turn").alias(SEQ))
    out = exact_pair(u, a.drop(SEQ).withColumn(SEQ, F.col("turn")), right_prefix="p_")
    return out.select(F.col("session_id").alias("conv_id"), "turn", "p_turn")


@query("turn_overlap", f"""
WITH t AS ({_TURNS_SQL}),
u AS (SELECT * FROM t WHERE role = 'user'), a AS (SELECT * FROM t WHERE role <> 'user')
SELECT u.conv_id, u.turn, EXISTS (SELECT 1 FROM a WHERE a.conv_id = u.conv_id
       AND a."offset" < u."offset" + u.duration AND a."offset" + a.duration > u."offset") AS has_overlap
FROM u""")
def q_turn_overlap(spark, sf):
    from corpusflow.operators.joins import interval_pairs
    t = _turns(spark, sf)
    u = t.filter(F.col("role") == "user").select("conv_id", "turn", F.col("offset").alias("_s"),
                                                  (F.col("offset") + F.col("duration")).alias("_e"))
    a = t.filter(F.col("role") != "user").select(F.col("conv_id").alias("r_conv_id"), F.col("offset").alias("_rs"),
                                                  (F.col("offset") + F.col("duration")).alias("_re"))
    hits = interval_pairs(u, a, "conv_id", "_s", "_e", "_rs", "_re", 16.0) \
        .filter((F.col("_rs") < F.col("_e")) & (F.col("_re") > F.col("_s"))) \
        .select("conv_id", "turn").distinct().withColumn("has_overlap", F.lit(True))
    return u.join(hits, ["conv_id", "turn"], "left") \
            .select("conv_id", "turn", F.coalesce("has_overlap", F.lit(False)).alias("has_overlap"))


# --- 2.6 aggregations -------------------------------------------------------------------

@query("manifest_totals", f"""
WITH m AS ({doc_manifest()}) SELECT count(*) AS num_entries, round(sum(duration) / 3600.0, 6) AS total_hours FROM m""")
def q_manifest_totals(spark, sf):
    from corpusflow.operators.aggs import manifest_totals
    # summation order differs between engines: compare at 6 decimals
    return manifest_totals(_docs(spark, sf)).withColumn("total_hours", F.round("total_hours", 6))


@query("manifest_stats", """
SELECT event_type AS audio_type, count(DISTINCT user_id) AS devices,
       count(DISTINCT CAST(user_id AS VARCHAR) || '_' || CAST(CAST(ts AS DATE) AS VARCHAR)) AS sessions,
       count(DISTINCT CAST(ts AS DATE)) AS dates, count(*) AS files FROM events GROUP BY event_type""")
def q_manifest_stats(spark, sf):
    from corpusflow.operators.aggs import manifest_stats
    e = table(spark, sf, "events")
    m = e.select(F.col("event_type").alias("audio_type"), F.col("user_id").alias("device_id"),
                 F.concat_ws("_", F.col("user_id").cast("string"), F.to_date("ts").cast("string")).alias("session_id"),
                 F.to_date("ts").alias("date"))
    return manifest_stats(m)


@query("score_histogram", """
WITH s AS (SELECT l_discount * 10 AS score FROM lineitem)
SELECT CAST(least(floor(score * 10), 9) AS INTEGER) AS bin, count(*) AS n FROM s
WHERE score >= 0 AND score <= 1 GROUP BY 1""")
def q_score_histogram(spark, sf):
    from corpusflow.operators.aggs import score_histogram
    li = table(spark, sf, "lineitem").select((F.col("l_discount") * 10).alias("score"))
    return score_histogram(li, "score")


@query("shard_stats", """
SELECT l_linenumber AS shard_id, count(*) AS samples, sum(l_quantity) AS total_duration,
       max(l_quantity) AS max_duration FROM lineitem GROUP BY l_linenumber""")
def q_shard_stats(spark, sf):
    from corpusflow.operators.aggs import shard_stats
    li = table(spark, sf, "lineitem").select(F.col("l_linenumber").alias("shard_id"),
                                             F.col("l_quantity").alias("duration"))
    return shard_stats(li)


@query("acceptance", """
SELECT user_id AS assignment_id, count(*) AS n_ok FROM events
WHERE event_type IN ('click', 'view') AND value * 4 < 75 GROUP BY user_id HAVING count(*) >= 3""")
def q_acceptance(spark, sf):
    from corpusflow.operators.aggs import accepted_assignments
    e = table(spark, sf, "events").select(
        F.col("user_id").alias("assignment_id"),
        F.when(F.col("event_type").isin("click", "view"), "SUBMITTED").otherwise("REJECTED").alias("status"),
        (F.col("value") * 4).alias("wer"))
    return accepted_assignments(e)


@query("banned_assignments", """
SELECT DISTINCT user_id AS assignment_id FROM events
WHERE event_type IN ('click', 'view') AND user_id IN (SELECT user_id FROM events WHERE event_type = 'error'
                                                     GROUP BY user_id HAVING count(*) >= 15)""")
def q_banned(spark, sf):
    from corpusflow.operators.aggs import banned_assignments
    e = table(spark, sf, "events")
    subs = e.select("user_id", F.col("user_id").alias("assignment_id"),
                    F.when(F.col("event_type").isin("click", "view"), "SUBMITTED").otherwise("X").alias("status"))
    banned = e.filter(F.col("event_type") == "error").groupBy("user_id").count().filter(F.col("count") >= 15)
    return banned_assignments(subs, banned)


@query("extension_counts", """
SELECT regexp_extract(regexp_replace(url, '[?#].*$', ''), '\\.([^./]+)$', 1) AS extension, count(*) AS files
FROM pages GROUP BY 1""")
def q_extension_counts(spark, sf):
    from corpusflow.operators.aggs import extension_counts
    p = table(spark, sf, "pages").select(F.regexp_replace("url", "[?#].*$", "").alias("audio_filepath"))
    return extension_counts(p)


@query("dynamic_bucket_bins", """
WITH d AS (SELECT l_quantity AS d FROM lineitem), t AS (SELECT sum(d) AS tot FROM d),
c AS (SELECT d, sum(d) OVER (ORDER BY d ROWS UNBOUNDED PRECEDING) AS cum FROM d),
k AS (SELECT d, floor(cum * 30 / tot) AS ks, floor((cum - d) * 30 / tot) AS kp FROM c, t),
e AS (SELECT d, unnest(generate_series(CAST(kp AS BIGINT) + 1, CAST(ks AS BIGINT))) AS k FROM k WHERE ks > kp)
SELECT k, min(d) AS edge FROM e WHERE k >= 1 AND k < 30 GROUP BY k""")
def q_dynamic_bucket_bins(spark, sf):
    from corpusflow.operators.aggs import dynamic_bucket_bins
    li = table(spark, sf, "lineitem").select(F.col("l_quantity").alias("duration"))
    return dynamic_bucket_bins(li, 30).withColumn("k", F.col("k").cast("long"))


@query("corpus_rates")
def q_corpus_rates(spark, sf):
    return M.corpus_rates(_asr_pairs(spark, sf))


@query("bootstrap_ci")
def q_bootstrap_ci(spark, sf):
    from corpusflow.operators.aggs import bootstrap_ci
    m = _docs(spark, sf).select(SEQ, M.charrate("text", "duration").alias("charrate"),
                                M.wordrate("text", "duration").alias("wordrate"))
    return bootstrap_ci(m, ["charrate", "wordrate"], num_bootstraps=200, seed=42)


# --- 2.7 windows and folds ------------------------------------------------------------------

@query("speaker_runs", """
WITH t AS (SELECT conv_id, turn, role,
                  CASE WHEN lag(role) OVER w IS NULL AND lag(turn) OVER w IS NULL THEN 1
                       WHEN role IS NOT DISTINCT FROM lag(role) OVER w THEN 0 ELSE 1 END AS nr
           FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn))
SELECT conv_id, turn, role, sum(nr) OVER (PARTITION BY conv_id ORDER BY turn ROWS UNBOUNDED PRECEDING) AS run_id
FROM t""")
def q_speaker_runs(spark, sf):
    from corpusflow.operators.folds import speaker_runs
    c = table(spark, sf, "conversations").select("conv_id", "turn", "role")
    return speaker_runs(c, "conv_id", ["turn"], "role")


@query("run_threshold_merge", """
WITH t AS (SELECT conv_id, turn, role, text, turn * 4.0 AS st, turn * 4.0 + length(text) / 64.0 AS en,
                  length(text) / 64.0 AS dur FROM conversations),
a AS (SELECT *, CASE WHEN lag(turn) OVER w IS NULL THEN 1 WHEN role IS NOT DISTINCT FROM lag(role) OVER w THEN 0
                ELSE 1 END AS sc FROM t WINDOW w AS (PARTITION BY conv_id ORDER BY turn)),
b AS (SELECT *, sum(sc) OVER (PARTITION BY conv_id ORDER BY turn ROWS UNBOUNDED PRECEDING) AS run FROM a),
c AS (SELECT *, floor(sum(dur) OVER (PARTITION BY conv_id, run ORDER BY turn ROWS UNBOUNDED PRECEDING) / 20.0) AS mult
      FROM b),
d AS (SELECT *, CASE WHEN sc = 1 OR mult IS DISTINCT FROM lag(mult) OVER (PARTITION BY conv_id ORDER BY turn)
                THEN 1 ELSE 0 END AS chg FROM c),
e AS (SELECT *, sum(chg) OVER (PARTITION BY conv_id ORDER BY turn ROWS UNBOUNDED PRECEDING) AS group_id FROM d)
SELECT conv_id, group_id, min(st) AS st, max(en) AS en, string_agg(text, ' ' ORDER BY turn) AS text,
       arg_min(role, turn) AS role
FROM e GROUP BY conv_id, group_id""")
def q_run_threshold_merge(spark, sf):
    from corpusflow.operators.folds import merge_runs_by_duration
    c = table(spark, sf, "conversations").select(
        "conv_id", "turn", "role", "text", (F.col("turn") * 4.0).alias("st"),
        (F.col("turn") * 4.0 + F.length("text") / 64.0).alias("en"))
    return merge_runs_by_duration(c, "conv_id", ["turn"], "role", "st", "en", "text", threshold=20.0)


@query("turn_manifest", """
WITH a AS (SELECT *, CASE WHEN lag(turn) OVER w IS NULL THEN 1 WHEN role IS NOT DISTINCT FROM lag(role) OVER w
                THEN 0 ELSE 1 END AS nr FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn)),
b AS (SELECT *, sum(nr) OVER (PARTITION BY conv_id ORDER BY turn ROWS UNBOUNDED PRECEDING) AS run_id FROM a),
g AS (SELECT conv_id, run_id, arg_min(role, turn) AS role, min(turn) AS first_turn,
             string_agg(text, ' ' ORDER BY turn) AS text FROM b GROUP BY conv_id, run_id),
h AS (SELECT * FROM g WHERE trim(text) <> '')
SELECT conv_id, run_id, role, first_turn, text,
       row_number() OVER (PARTITION BY conv_id ORDER BY run_id) - 1 AS segment_index FROM h""")
def q_turn_manifest(spark, sf):
    from corpusflow.operators.folds import speaker_turns
    c = table(spark, sf, "conversations").select("conv_id", "turn", "role", "text")
    return speaker_turns(c, "conv_id", "turn", "role", "text")


@query("gap_fill", """
WITH s AS (SELECT conv_id, turn * 4.0 AS st, turn * 4.0 + length(text) / 64.0 AS en, role AS speaker
           FROM conversations),
dur AS (SELECT conv_id, (max(turn) + 1) * 4.0 AS ad FROM conversations GROUP BY conv_id),
g1 AS (SELECT conv_id, coalesce(lag(en) OVER (PARTITION BY conv_id ORDER BY st), 0.0) AS gs, st AS ge FROM s),
last AS (SELECT s.conv_id, arg_max(en, st) AS gs, dur.ad AS ge FROM s JOIN dur USING (conv_id) GROUP BY s.conv_id, dur.ad),
g AS (SELECT * FROM g1 WHERE ge > gs UNION ALL SELECT * FROM last WHERE ge > gs),
p AS (SELECT conv_id, gs, ge, unnest(generate_series(0, CAST(ceil((ge - gs) / 1.5) AS BIGINT) - 1)) AS k FROM g)
SELECT conv_id, speaker, st, en FROM s
UNION ALL
SELECT conv_id, 'no-speaker' AS speaker, gs + k * 1.5 AS st, least(gs + (k + 1) * 1.5, ge) AS en FROM p""")
def q_gap_fill(spark, sf):
    from corpusflow.operators.folds import gap_segments
    c = table(spark, sf, "conversations")
    ad = c.groupBy("conv_id").agg(((F.max("turn") + 1) * 4.0).alias("ad"))
    s = c.select("conv_id", F.col("role").alias("speaker"), (F.col("turn") * 4.0).alias("st"),
                 (F.col("turn") * 4.0 + F.length("text") / 64.0).alias("en")).join(ad, "conv_id")
    return gap_segments(s, "conv_id", "st", "en", "ad", 1.5)


def _word_rows(spark, sf):
    w = table(spark, sf, "documents").select("doc_id", F.posexplode(TX.words(F.col("text"))).alias("pos", "word"))
    return w.withColumn("start", F.col("pos") * 0.5).withColumn("end", F.col("pos") * 0.5 + 0.375)


@query("sentence_segments", f"""
WITH w AS (SELECT doc_id, unnest({words('text')}) AS word, generate_subscripts({words('text')}, 1) - 1 AS pos
           FROM documents),
n AS (SELECT *, lead(word) OVER (PARTITION BY doc_id ORDER BY pos) AS nxt FROM w),
b AS (SELECT *, CASE
        WHEN right(word, 1) IN ('!', '?') THEN 1
        WHEN right(word, 1) <> '.' THEN 0
        WHEN TRY_CAST(word[:-2] AS DOUBLE) IS NOT NULL THEN 0
        WHEN list_contains(string_split('mr mrs ms dr prof sr jr vs etc inc corp ltd co st ave blvd rd ln ct pl sq ft in cm mm kg lb oz pt qt gal mph rpm vol no pg pp ch sec min hr hrs am pm est pst cst mst utc gmt jan feb mar apr may jun jul aug sep oct nov dec mon tue wed thu fri sat sun dept div mgr dir pres vp ceo cfo cto coo evp svp avp', ' '),
                           lower(word[:-2])) THEN 0
        WHEN nxt IS NULL THEN 1
        WHEN regexp_matches(nxt, '^\\p{{Lu}}') THEN 1 ELSE 0 END AS bnd FROM n),
s AS (SELECT *, coalesce(sum(bnd) OVER (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
             AS sentence_id FROM b)
SELECT doc_id, sentence_id, string_agg(word, ' ' ORDER BY pos) AS text,
       round_even(min(pos) * 0.5, 3) AS start, round_even(max(pos) * 0.5 + 0.375, 3) AS "end",
       round_even(round_even(max(pos) * 0.5 + 0.375, 3) - round_even(min(pos) * 0.5, 3), 3) AS duration
FROM s GROUP BY doc_id, sentence_id""")
def q_sentence_segments(spark, sf):
    from corpusflow.operators.folds import sentence_segments
    return sentence_segments(_word_rows(spark, sf), "doc_id", "pos", "word", "start", "end")


# --- 2.8 sort, limit, sample, shards ----------------------------------------------------------

@query("sort_manifest", f"""
WITH m AS ({doc_manifest()}) SELECT doc_id, duration FROM m ORDER BY duration DESC, doc_id""")
def q_sort_manifest(spark, sf):
    return SH.sort_manifest(_docs(spark, sf), "duration", descending=True).select("doc_id", "duration")


@query("limit_entries", "SELECT doc_id, lang FROM documents ORDER BY doc_id LIMIT 100")
def q_limit(spark, sf):
    return SH.limit_entries(_docs(spark, sf).select("doc_id", "lang", SEQ), 100).select("doc_id", "lang")


@query("percent_limit", """
SELECT doc_id FROM (SELECT doc_id, row_number() OVER (ORDER BY doc_id) AS rn FROM documents)
WHERE rn <= (SELECT greatest(1, CAST(floor(count(*) * 5 / 100) AS BIGINT)) FROM documents)""")
def q_percent_limit(spark, sf):
    return SH.percent_limit(_docs(spark, sf).select("doc_id", SEQ), 5).select("doc_id")


@query("sample_fraction")
def q_sample_fraction(spark, sf):
    return SH.sample_fraction(_docs(spark, sf), 0.1, random_state=100).select("doc_id")


@query("shard_equal_chunks")
def q_shard_equal(spark, sf):
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity") \
        .withColumn(SEQ, F.struct("l_orderkey", "l_linenumber"))
    return SH.shard_equal_chunks(li, 16, shuffle=True, shuffle_seed=42).drop(SEQ)


@query("shard_contiguous", """
WITH i AS (SELECT l_orderkey, l_linenumber, row_number() OVER (ORDER BY l_orderkey, l_linenumber) - 1 AS idx,
                  count(*) OVER () AS n FROM lineitem)
SELECT l_orderkey, l_linenumber, CAST(floor(idx / (n // 7)) AS INTEGER) AS shard_id,
       idx - floor(idx / (n // 7)) * (n // 7) AS _shard_pos
FROM i WHERE idx < (n // 7) * 7""")
def q_shard_contiguous(spark, sf):
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber") \
        .withColumn(SEQ, F.struct("l_orderkey", "l_linenumber"))
    return SH.shard_contiguous(li, 7, shuffle=False).drop(SEQ)


@query("shard_keep_files_together")
def q_shard_files_together(spark, sf):
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber") \
        .withColumn("audio_filepath", F.col("l_orderkey").cast("string")) \
        .withColumn(SEQ, F.struct("l_orderkey", "l_linenumber"))
    return SH.shard_contiguous(li, 8, shuffle=True, keep_files_together=True).drop(SEQ)


@query("duration_buckets", """
SELECT l_orderkey, l_linenumber,
       CASE WHEN l_quantity >= 1.0 AND floor((l_quantity - 1.0) / ((50.0 - 1.0) / 4)) < 4
            THEN CAST(floor((l_quantity - 1.0) / ((50.0 - 1.0) / 4)) AS INTEGER)
            WHEN l_quantity >= 1.0 AND l_quantity < 1.0 + 3 * ((50.0 - 1.0) / 4) + ((50.0 - 1.0) / 4) + 1e-5 THEN 3
       END AS bucket_id
FROM lineitem""")
def q_duration_buckets(spark, sf):
    li = table(spark, sf, "lineitem")
    return li.select("l_orderkey", "l_linenumber",
                     SH.duration_bucket(F.col("l_quantity"), 1.0, 50.0, 4).alias("bucket_id"))


@query("round_robin_shards")
def q_round_robin(spark, sf):
    c = table(spark, sf, "conversations").select("conv_id", "turn").withColumn(SEQ, F.struct("conv_id", "turn"))
    return SH.round_robin(c, 4).drop(SEQ)


@query("split_by_duration", """
WITH o AS (SELECT l_orderkey, l_linenumber, l_quantity,
                  coalesce(sum(l_quantity) OVER (ORDER BY l_orderkey, l_linenumber
                                                 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS cum
           FROM lineitem),
tot AS (SELECT sum(l_quantity) AS t FROM lineitem),
s2 AS (SELECT min(cum) AS st FROM o WHERE cum - 0 > (SELECT t / 12 FROM tot)),
s3 AS (SELECT min(cum) AS st FROM o WHERE cum - (SELECT st FROM s2) > (SELECT t / 6 FROM tot))
SELECT l_orderkey, l_linenumber,
       CASE WHEN cum >= 0 AND cum <= (SELECT t / 12 FROM tot) THEN 'dev'
            WHEN cum >= (SELECT st FROM s2) AND cum - (SELECT st FROM s2) <= (SELECT t / 6 FROM tot) THEN 'test'
            ELSE 'train' END AS split
FROM o""")
def q_split_by_duration(spark, sf):
    from corpusflow.operators.folds import take_by_quota
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    tot = li.agg(F.sum("l_quantity")).first()[0]
    out = take_by_quota(li, ["l_orderkey", "l_linenumber"], "l_quantity",
                        [("dev", tot / 12), ("test", tot / 6)])
    return out.select("l_orderkey", "l_linenumber", "split")


@query("split_by_duration_shuffled")
def q_split_shuffled(spark, sf):
    from corpusflow.operators.folds import take_by_quota
    d = _docs(spark, sf)
    tot = d.agg(F.sum("duration")).first()[0]
    order = [SH.hash_order(42, F.col("audio_filepath")), F.col("audio_filepath")]
    return take_by_quota(d, order, "duration", [("dev", tot / 12), ("test", tot / 6)]).select("doc_id", "split")


@query("fixed_cut", f"""
WITH m AS ({doc_manifest()}),
p AS (SELECT doc_id, duration, unnest(generate_series(0, CAST(floor(duration / 30.0) AS BIGINT) - 1)) AS i FROM m)
SELECT doc_id, i * 30.0 AS "offset", 30.0 AS duration FROM p""")
def q_fixed_cut(spark, sf):
    d = _docs(spark, sf).select("doc_id", "duration", "text")
    return SH.split_fixed_duration(d, 30.0).select("doc_id", "offset", "duration")


@query("fixed_cut_keep_last", f"""
WITH m AS ({doc_manifest()}),
p AS (SELECT doc_id, duration AS d, unnest(generate_series(0, CAST(ceil(duration / 30.0) AS BIGINT) - 1)) AS i
      FROM m)
SELECT doc_id, i * 30.0 AS "offset",
       CASE WHEN i < floor(d / 30.0) THEN 30.0 ELSE d - floor(d / 30.0) * 30.0 END AS duration FROM p""")
def q_fixed_cut_keep_last(spark, sf):
    d = _docs(spark, sf).select("doc_id", "duration")
    return SH.split_fixed_duration(d, 30.0, drop_last=False).select("doc_id", "offset", "duration")


# --- E1 list explode, T5 sentences --------------------------------------------------------------

@query("list_to_entries", """
SELECT o.o_orderkey, o.o_orderstatus, l.l_linenumber, l.l_quantity, l.l_returnflag
FROM orders o JOIN lineitem l ON o.o_orderkey = l.l_orderkey""")
def q_list_to_entries(spark, sf):
    from corpusflow.operators.arrays import list_to_entries
    li = table(spark, sf, "lineitem")
    # one manifest row per order holding its line items (an order has at most 7)
    nested = li.groupBy("l_orderkey").agg(F.collect_list(F.struct("l_linenumber", "l_quantity", "l_returnflag"))
                                          .alias("segments"))
    o = _orders(spark, sf).select("o_orderkey", "o_orderstatus")
    rows = o.join(nested, o["o_orderkey"] == nested["l_orderkey"]).drop("l_orderkey")
    return list_to_entries(rows, "segments").select("o_orderkey", "o_orderstatus", "l_linenumber", "l_quantity",
                                                     "l_returnflag")


@query("sentence_split", f"""
WITH a AS (SELECT doc_id, text, regexp_extract_all(text, '[^.!?]*[.!?]') AS pieces FROM documents),
b AS (SELECT doc_id, CASE WHEN len(pieces) > 0 THEN pieces ELSE [text] END AS arr FROM a)
SELECT doc_id, generate_subscripts(arr, 1) - 1 AS idx, {strip('unnest(arr)')} AS text FROM b""")
def q_sentence_split(spark, sf):
    d = _docs(spark, sf)
    return d.select("doc_id", F.posexplode(TX.split_line_by_sentence(F.col("text"), r"[.!?]")).alias("idx", "text"))


# --- text transforms (T6, T8, T11-T13) --------------------------------------------------------------

@query("brackets")
def q_brackets(spark, sf):
    p = table(spark, sf, "pages")
    return p.select("page_id", F.posexplode(TX.extract_from_brackets(F.col("html"), ["<>", "()"]))
                    .alias("idx", "text"))


@query("uppercase_after_period")
def q_uppercase_after_period(spark, sf):
    return _docs(spark, sf).select("doc_id", TX.uppercase_after_period(F.lower("text")).alias("text"))


# Character set per language for the histogram validator
# (letters of the language plus space and basic punctuation).
LANG_CHARSETS = {
    "en": "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ .,'",
    "fr": "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZàâçéèêëîïôûùüÿœ .,'",
    "de": "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZäöüßÄÖÜ .,'",
    "es": "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZáéíñóúü .,'",
}


def _charset_values_sql():
    rows = ", ".join(f"({_sqlstr(k)}, {_sqlstr(v)})" for k, v in LANG_CHARSETS.items())
    return f"(VALUES {rows}) AS cs(lang, charset)"


@query("charset_ratio", f"""
WITH d AS (SELECT doc_id, lang, {strip('text')} AS t FROM documents)
SELECT d.doc_id, CASE WHEN length(t) = 0 THEN 0.0
                      ELSE (length(t) - length(translate(t, cs.charset, ''))) / length(t) END AS hist_token_ratio
FROM d JOIN {_charset_values_sql()} ON d.lang = cs.lang""")
def q_charset_ratio(spark, sf):
    from corpusflow.operators.joins import language_charsets
    cs = spark.createDataFrame(list(LANG_CHARSETS.items()), "lang string, charset string")
    d = language_charsets(_docs(spark, sf), cs)
    return d.select("doc_id", TX.charset_ratio(F.col("text"), F.col("charset")).alias("hist_token_ratio"))


def _hall_sql():
    ws = words("text")
    return f"""
WITH ph AS (SELECT DISTINCT translate({strip('text')}, '.?!', '') AS k FROM conversations WHERE role = 'system'),
d AS (SELECT doc_id, text, {ws} AS ws FROM documents),
f AS (SELECT doc_id, translate({strip('text')}, '.?!', '') AS k,
             len(list_distinct(ws)) / len(ws) <= 0.4 AS hall_repeated_ngrams,
             list_sort(list_transform(ws, lambda x: length(x))) AS lens, len(ws) AS n FROM d)
SELECT doc_id, hall_repeated_ngrams,
       coalesce(lens[-1] >= 25 OR (n > 1 AND (lens[-1] - lens[-2]) / lens[-2] >= 3), false) AS hall_long_word,
       k IN (SELECT k FROM ph) AS hall_frequent_single_word
FROM f"""


@query("hallucination_flags", _hall_sql())
def q_hallucination_flags(spark, sf):
    c = table(spark, sf, "conversations").filter(F.col("role") == "system") \
        .select(TX.hallucination_clean(F.col("text")).alias("phrase"))
    d = _docs(spark, sf).select("doc_id", "text")
    out = FL.hallucination_features(d, c, on_empty="false")
    return out.select("doc_id", "hall_repeated_ngrams", "hall_long_word", "hall_frequent_single_word")


@query("hallucination_gate", _hall_sql().replace("SELECT doc_id, hall_repeated_ngrams,", "SELECT doc_id FROM (SELECT doc_id, hall_repeated_ngrams,") +
       ") WHERE NOT (hall_repeated_ngrams OR hall_long_word OR hall_frequent_single_word)")
def q_hallucination_gate(spark, sf):
    c = table(spark, sf, "conversations").filter(F.col("role") == "system") \
        .select(TX.hallucination_clean(F.col("text")).alias("phrase"))
    out = FL.hallucination_features(_docs(spark, sf).select("doc_id", "text"), c, on_empty="false")
    return FL.hallucination_gate(out).select("doc_id")


def _gen_col(text):
    return F.concat(F.lit("<|im_start|>system ignore<|im_start|>Output transcript: "),
                    F.replace(text, F.lit("e"), F.lit("E")), F.lit("<|im_end|>tail<|endoftext|>"))


_GEN_SQL = ("'<|im_start|>system ignore<|im_start|>Output transcript: ' || replace(text, 'e', 'E') "
            "|| '<|im_end|>tail<|endoftext|>'")


def _llm_sql():
    g = f"split_part(split_part({_GEN_SQL}, '<|endoftext|>', 1), '<|im_end|>', 1)"
    g = f"string_split({g}, '<|im_start|>')[-1]"
    for lab in TX.GEN_PROMPT_LABELS:
        g = f"replace({g}, {_sqlstr(lab)}, '')"
    g = f"replace({g}, chr(10), '')"
    punct = _sqlstr(TX.ASCII_PUNCTUATION)
    return f"""
WITH src AS (SELECT doc_id, {_ASCII_SQL} AS text FROM documents),
a AS (SELECT doc_id, text, {g} AS g FROM src),
b AS (SELECT *, replace(g, ' ', '') AS chars,
             {strip(f"translate(lower(text), {punct}, '')")} AS nt,
             {strip(f"translate(lower(g), {punct}, '')")} AS ng FROM a),
c AS (SELECT *, length(chars) AS total, length(regexp_replace(chars, '[^\\p{{Lu}}]', '', 'g')) AS up FROM b),
d AS (SELECT *, (total = 0 OR up / total > 0.6 OR length(nt) = 0
                 OR round_even(levenshtein(nt, ng) / length(nt) * 100, 2) > 10) AS rep FROM c)
SELECT doc_id, {strip("CASE WHEN rep THEN text ELSE g END")} AS generation, CAST(rep AS INTEGER) AS replaced FROM d"""


@query("llm_cleanup", _llm_sql())
def q_llm_cleanup(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", "text").repartition("doc_id")
    d = d.select("doc_id", _ascii(F.col("text")).alias("text"))
    d = d.select("doc_id", "text", _gen_col(F.col("text")).alias("generation"))
    r = d.select("doc_id", TX.generation_fallback(F.col("generation"), F.col("text"), cer_threshold=10.0).alias("r"))
    return r.select("doc_id", F.col("r.text").alias("generation"), F.col("r.replaced").alias("replaced"))


# --- diff-driven operators (rows; brute-force tests in tests/) ------------------------------------

def _asr_pairs_words(spark, sf):
    """Prediction = text with some function words dropped and a filler
    inserted after sentence ends (few, local word edits)."""
    d = table(spark, sf, "documents").select("doc_id", "text").repartition("doc_id")
    pred = F.regexp_replace(F.regexp_replace(F.col("text"), r" (the|and|of|le|und|el) ", " "), r"\. ", ". um ")
    return d.select("doc_id", "text", pred.alias("pred_text"))


@query("wmr_filter")
def q_wmr_filter(spark, sf):
    small_batches(spark)
    return FL.drop_low_word_match_rate(_asr_pairs_words(spark, sf), 90.0, out_col="wmr", on_zero="null").select("doc_id", "wmr")


def _caption_rows(spark, sf):
    """Caption files from conversations: one file with all turns of each."""
    c = table(spark, sf, "conversations")
    seg = F.struct((F.col("turn") * 3.0).alias("start_time"),
                   (F.col("turn") * 3.0 + F.length("text") / 64.0).alias("end_time"), F.col("text"))
    return c.groupBy("conv_id") \
            .agg(F.array_sort(F.collect_list(F.struct(F.col("turn").alias("k"), seg.alias("s")))).alias("_s")) \
            .select("conv_id", F.transform("_s", lambda x: x["s"]).alias("segments"))


@query("caption_merge")
def q_caption_merge(spark, sf):
    from corpusflow.operators.folds import aggregate_caption_segments
    c = _caption_rows(spark, sf)
    m = c.select("conv_id", F.posexplode(aggregate_caption_segments(F.col("segments"), 20.0))
                 .alias("idx", "seg"))
    return m.select("conv_id", "idx", "seg.start_time", "seg.end_time", "seg.text",
                    (F.col("seg.end_time") - F.col("seg.start_time")).alias("duration"))


@query("rttm_cuts")
def q_rttm_cuts(spark, sf):
    from corpusflow.operators.folds import rttm_cut_points
    c = _caption_rows(spark, sf)
    starts = F.transform("segments", lambda s: s["start_time"])
    dur = F.array_max(F.transform("segments", lambda s: s["end_time"]))
    return c.select("conv_id", F.explode(rttm_cut_points(starts, dur, 20.0)).alias("cut"))


@query("text_lid")
def q_text_lid(spark, sf):
    """Trigram language id trained on the labelled documents, scored on
    every document."""
    from corpusflow.operators.scoring import score_trigram_lid, train_trigram_lid
    small_batches(spark)
    d = table(spark, sf, "documents").select("doc_id", "text", "lang").repartition("doc_id")
    prof = train_trigram_lid(d)
    return score_trigram_lid(d.select("doc_id", "text"), prof, "doc_id").select("doc_id", "label", "label_prob")


@query("lid_accuracy")
def q_lid_accuracy(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", "lang")
    pred = QUERIES["text_lid"](spark, sf)
    return d.join(pred, "doc_id").groupBy("lang").agg(F.avg((F.col("label") == F.col("lang")).cast("double"))
                                                      .alias("accuracy"), F.count("*").alias("n"))


@query("vtt_sentences")
def q_vtt_sentences(spark, sf):
    from corpusflow.operators.folds import sentences_from_captions
    c = _caption_rows(spark, sf)
    return c.select("conv_id", F.posexplode(sentences_from_captions(F.col("segments"), 10.0))
                    .alias("idx", "s")).select("conv_id", "idx", "s.text", "s.start", "s.end", "s.duration")
