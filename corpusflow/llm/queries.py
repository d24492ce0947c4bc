"""Registered queries of the training-data operators and their DuckDB oracles."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusflow.llm import (align, decontam, exact, linededup, minhash, mixing, pieces, ppm, quality, resample, substring,
                            suffix, urlfilter)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def _query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql:
            ORACLES[name] = sql
        return fn
    return register


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# --- 1 -----------------------------------------------------------------------

QUALITY_SQL = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
w AS (SELECT doc_id, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words FROM d),
tri AS (SELECT doc_id, i, words[i] || chr(10) || words[i + 1] || chr(10) || words[i + 2] AS g
        FROM (SELECT doc_id, words, unnest(range(1, len(words) - 1)) AS i FROM w)),
twice AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS n FROM tri) WHERE n > 1),
rep AS (SELECT doc_id, count(DISTINCT i + o) AS n FROM twice, (SELECT unnest([0, 1, 2]) AS o) GROUP BY doc_id),
ln AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS k FROM d),
lw AS (SELECT *, len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS n,
              len(regexp_replace(line, '[^#*$%&|<>]', '', 'g')) AS sym,
              len(regexp_replace(line, '[^|»›·•]', '', 'g')) AS menu,
              (len(line) - len(replace(line, '!!', ''))) // 2 AS shout,
              row_number() OVER (PARTITION BY doc_id, line ORDER BY k) AS nth FROM ln),
lb AS (SELECT *, n > 0 AND (NOT regexp_matches(line, '[.!?…。！？]["''”’»)\]]*[\x20\x09-\x0D]*$') OR 3 * sym > n
              OR 2 * shout > n OR (menu >= 2 AND 4 * menu >= n)
              OR regexp_matches(line, '(?i)(all rights reserved|licen[sc]ed under|released under the|terms of (use|service)|privacy policy|cookie (policy|settings)|accept (all )?cookies|enable javascript|subscribe to our newsletter|sign up for our newsletter|copyright (\(c\)|©))')) AS bad FROM lw),
ls AS (SELECT doc_id, count(*) FILTER (n > 0 AND nth > 1) AS n_dup_lines, count(*) FILTER (n > 0) AS n_lines,
              count(*) FILTER (bad) AS n_bad_lines, coalesce(sum(n) FILTER (bad), 0)::BIGINT AS n_bad_words FROM lb GROUP BY doc_id),
b AS (SELECT w.doc_id, len(words)::BIGINT AS n_words, len(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
             len(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols, ls.n_dup_lines,
             coalesce(rep.n, 0)::BIGINT AS n_repeat_words, n_lines, n_bad_lines, n_bad_words
      FROM w JOIN ls USING (doc_id) LEFT JOIN rep ON rep.doc_id = w.doc_id)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AS base_failed, n_lines, n_bad_lines, n_bad_words,
       NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND 100 * (n_words - n_bad_words) >= 50 * n_words AS kept
FROM b
"""


@_query("op1_quality_rules", QUALITY_SQL)
def op1(spark, sf_dir):
    d = quality.quality_rules(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    q = F.col("quality")
    return d.select("doc_id", *[q[c].alias(c) for c in (
        "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "n_lines",
        "n_bad_lines", "n_bad_words", "kept")])


# --- 2 -----------------------------------------------------------------------

@_query("op2_sentencepiece")
def op2(spark, sf_dir):
    """Piece ids of every whole text; ``round_trip``: decoding gives it back."""
    d = _table(spark, sf_dir, "documents").select("doc_id", "text")
    ids = pieces.encode(d, pieces.default_model(), out="ids", check_col="round_trip", keep_text=False)
    return ids.withColumn("n_tokens", F.coalesce(F.size("ids"), F.lit(0)).cast("long"))


# --- 3 -----------------------------------------------------------------------

@_query("op3_exact_dedup", """
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       doc_id = max(doc_id) OVER g AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW g AS (PARTITION BY coalesce(text, ''))
""")
def op3(spark, sf_dir):
    d = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return exact.exact_dedup(d).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


# --- 4 -----------------------------------------------------------------------

@_query("op4_mix_sources", r"""
WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
r AS (SELECT *, [5, 2, 1][((row_number() OVER (ORDER BY source IS NULL, source COLLATE C) - 1) % 3 + 1)::INT]::BIGINT AS w FROM s),
o AS (SELECT *, coalesce(sum(source_size) OVER before, 0) AS full_size, sum(w) OVER (ORDER BY 2.0 * source_size / w, source_size, source ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS left_w
      FROM r WINDOW before AS (ORDER BY 2.0 * source_size / w, source_size, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
t AS (SELECT sum(source_size) AS total FROM s),
l AS (SELECT (3 * total - 4 * full_size)::BIGINT AS num, (2 * left_w)::BIGINT AS den FROM o, t
      WHERE (3 * total - 4 * full_size)::HUGEINT * w < 2 * source_size * 2 * left_w::HUGEINT
      ORDER BY 2.0 * source_size / w, source_size, source LIMIT 1),
tg AS (SELECT source, source_size, CASE WHEN source_size > 0
        THEN least((2 * source_size)::DOUBLE, w::DOUBLE * num::DOUBLE / den::DOUBLE) ELSE 0.0 END AS target FROM r, l),
x AS (SELECT d.doc_id, size, source_size, target, CASE WHEN source_size > 0 THEN target / source_size ELSE 0.0 END AS rate,
             ('0x' || substr(md5('mix:' || coalesce(d.doc_id::VARCHAR, 'null')), 1, 13))::BIGINT::DOUBLE / 4503599627370496.0 AS u
      FROM d JOIN tg ON d.source IS NOT DISTINCT FROM tg.source)
SELECT doc_id, size, source_size, target,
       (floor(rate) + CASE WHEN u < rate - floor(rate) THEN 1 ELSE 0 END)::BIGINT * size AS taken FROM x
""")
def op4(spark, sf_dir):
    d = _table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return mixing.mix_sources(d, emit=False).select(
        "doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).cast("long").alias("taken"))


# --- 8 -----------------------------------------------------------------------

@_query("op8_suffix_dedup", r"""
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS x FROM documents),
w AS (SELECT doc_id, i, substr(x, 2 * i + 1, 200) AS s FROM (SELECT doc_id, x, unnest(range(0, len(x) // 2 - 99)) AS i FROM d)),
f AS (SELECT doc_id, i, row_number() OVER (PARTITION BY s ORDER BY doc_id, i) AS nth FROM w),
m AS (SELECT doc_id, i, CASE WHEN lag(i) OVER g IS NULL OR i > lag(i) OVER g + 100 THEN 1 ELSE 0 END AS fresh
      FROM f WHERE nth > 1 WINDOW g AS (PARTITION BY doc_id ORDER BY i)),
r AS (SELECT doc_id, run, min(i) AS a, max(i) + 100 AS b
      FROM (SELECT *, sum(fresh) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM m) GROUP BY doc_id, run),
k AS (SELECT doc_id, list({'a': a, 'b': b} ORDER BY a) AS runs, sum(b - a)::BIGINT AS n, count(*) AS c FROM r GROUP BY doc_id),
c AS (SELECT d.doc_id, x, coalesce(n, 0) AS n, coalesce(c, 0) AS c, coalesce([y.a for y in runs], []) || [len(x) // 2] AS stops,
             [0] || coalesce([y.b for y in runs], []) AS begins FROM d LEFT JOIN k USING (doc_id))
SELECT doc_id, (len(x) // 2)::BIGINT AS n_bytes, n AS n_removed, c AS n_spans,
       sha256(unhex(list_aggregate([substr(x, 2 * begins[j] + 1, 2 * (stops[j] - begins[j])) for j in range(1, len(stops) + 1)], 'string_agg', ''))) AS kept_sha256
FROM c
""")
def op8(spark, sf_dir):
    d = suffix.suffix_dedup(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return d.select("doc_id", F.col("n_units").alias("n_bytes"), "n_removed", F.size("removed_spans").cast("long").alias("n_spans"),
                    F.sha2("clean", 256).alias("kept_sha256"))


# --- 9 -----------------------------------------------------------------------

@_query("op9_substring_dedup", r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS x FROM documents),
w AS (SELECT doc_id, i, array_to_string(x[i:i + 12], ' ') AS s FROM (SELECT doc_id, x, unnest(range(1, len(x) - 11)) AS i FROM d)),
f AS (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY s) AS first FROM w),
g AS (SELECT DISTINCT doc_id, i + o AS i FROM f, (SELECT unnest(range(0, 13)) AS o) WHERE first < doc_id),
p AS (SELECT doc_id, unnest(x) AS word, generate_subscripts(x, 1) AS i FROM d),
k AS (SELECT p.doc_id, string_agg(word, ' ' ORDER BY p.i) AS t FROM p ANTI JOIN g USING (doc_id, i) GROUP BY p.doc_id)
SELECT d.doc_id, len(x)::BIGINT AS n_words, coalesce(n, 0) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN (SELECT doc_id, count(*) AS n FROM g GROUP BY doc_id) USING (doc_id) LEFT JOIN k USING (doc_id)
""")
def op9(spark, sf_dir):
    d = substring.substring_dedup(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return d.select("doc_id", F.col("n_units").alias("n_words"), "n_removed", F.sha2("clean", 256).alias("kept_sha256"))


# --- 10 ----------------------------------------------------------------------

URL_RULES = (urlfilter.Rule("allow", "com", "/"), urlfilter.Rule("block", "example.com", "/en/"),
             urlfilter.Rule("allow", "www.example.com", "/en/"), urlfilter.Rule("block", "net", "/es/"),
             urlfilter.Rule("block", "net", "/fr/"))
#: Host names whose canonical URLs make up the list of op10.
LISTED_HOSTS = r"(^|\.)(cheap-pills|spam-farm|free-bets)\."


@_query("op10_url_filter", r"""
WITH p AS (SELECT page_id, translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                  coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path FROM pages),
c AS (SELECT *, regexp_replace(host, '^www\.', '') || regexp_replace(regexp_replace(path, '(/index)?\.html$', ''), '/+$', '') AS canon FROM p),
listed AS (SELECT DISTINCT canon FROM c WHERE regexp_matches(host, '(^|\.)(cheap-pills|spam-farm|free-bets)\.')),
r AS (SELECT * FROM (VALUES ('allow', 'com', '/'), ('block', 'example.com', '/en/'), ('allow', 'www.example.com', '/en/'),
                            ('block', 'net', '/es/'), ('block', 'net', '/fr/')) AS t(v, h, q)),
b AS (SELECT c.*, (SELECT max_by(struct_pack(n := h || q, v := v), len(h || q)) FROM r
                   WHERE (c.host = h OR ends_with(c.host, '.' || h)) AND starts_with(c.path, q)) AS best FROM c)
SELECT page_id, host, path, best.n AS rule,
       coalesce(best.v, CASE WHEN canon IN (SELECT canon FROM listed) THEN 'block' ELSE 'allow' END) AS verdict FROM b
""")
def op10(spark, sf_dir):
    pages = _table(spark, sf_dir, "pages").select("page_id", "url")
    host, path = urlfilter.host_of(F.col("url")), urlfilter.path_of(F.col("url"))
    listed = (pages.select(host.alias("host"), path.alias("path")).filter(F.col("host").rlike(LISTED_HOSTS))
                   .select(urlfilter.canonical(F.col("host"), F.col("path")).alias("canonical")))
    return urlfilter.url_filter(pages, URL_RULES, listed).select("page_id", "host", "path", "rule", "verdict")


# --- 5 -----------------------------------------------------------------------

@_query("op5_ppm_scoring")
def op5(spark, sf_dir):
    d = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return ppm.ppm_scores(d, ppm.held_out_fifth())


# --- 6 -----------------------------------------------------------------------

@_query("op6_minhash_near_dedup", r"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                            'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(words[i:i + 3], ' ') AS g
      FROM (SELECT doc_id, words, unnest(range(1, greatest(len(words) - 3, least(len(words), 1)) + 1)) AS i FROM w)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
c AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS shared FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2),
k AS (SELECT a, b FROM c JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * shared >= 80 * (x.n + y.n - shared)),
r AS (SELECT a, b FROM k UNION SELECT r.a, k.b FROM r JOIN k ON r.b = k.a)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, least(d.doc_id, coalesce(m.b, d.doc_id)) AS component_id,
       d.doc_id = least(d.doc_id, coalesce(m.b, d.doc_id)) AS kept
FROM documents d LEFT JOIN n USING (doc_id) LEFT JOIN (SELECT a, min(b) AS b FROM r GROUP BY a) m ON m.a = d.doc_id
""")
def op6(spark, sf_dir):
    d = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return minhash.near_duplicate_ids(d, params=minhash.MinHashParams(words=4))


# --- 7 -----------------------------------------------------------------------

@_query("op7_line_dedup", r"""
WITH l AS (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS x,
                  generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) - 1 AS p FROM documents),
s AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY p) AS q FROM l WHERE regexp_matches(x, '[^ 	-
]')),
w AS (SELECT *, lead(x) OVER d AS y, lead(p) OVER d AS b FROM s WINDOW d AS (PARTITION BY doc_id ORDER BY q)),
n AS (SELECT doc_id, q, p, b, q + 1 AS e, row_number() OVER (PARTITION BY x, y ORDER BY doc_id, q) AS nth FROM w WHERE y IS NOT NULL
      UNION ALL SELECT doc_id, q, p, p, q, row_number() OVER (PARTITION BY x ORDER BY doc_id, q) FROM s
                WHERE len(regexp_extract_all(x, '[^\x20\x09-\x0D]+')) >= 20),
m AS (SELECT *, CASE WHEN q <= max(e) OVER (PARTITION BY doc_id ORDER BY q, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) + 1 THEN 0 ELSE 1 END AS fresh
      FROM n WHERE nth > 1),
r AS (SELECT doc_id, run, min(p) AS a, max(b) AS b, max(e) - min(q) + 1 AS lines
      FROM (SELECT *, sum(fresh) OVER (PARTITION BY doc_id ORDER BY q, e ROWS UNBOUNDED PRECEDING) AS run FROM m) GROUP BY doc_id, run),
k AS (SELECT doc_id, string_agg(x, chr(10) ORDER BY p) AS t FROM l
      WHERE NOT EXISTS (SELECT 1 FROM r WHERE r.doc_id = l.doc_id AND l.p BETWEEN r.a AND r.b) GROUP BY doc_id),
g AS (SELECT doc_id, sum(lines)::BIGINT AS n_removed, count(*)::BIGINT AS n_runs FROM r GROUP BY doc_id),
c AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id)
SELECT d.doc_id, coalesce(c.n, 0) AS n_lines, coalesce(n_removed, 0) AS n_removed_lines, coalesce(n_runs, 0) AS n_runs,
       sha256(coalesce(k.t, '')) AS kept_sha256
FROM documents d LEFT JOIN c USING (doc_id) LEFT JOIN g USING (doc_id) LEFT JOIN k USING (doc_id)
""")
def op7(spark, sf_dir):
    d = linededup.line_dedup(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return d.select("doc_id", "n_lines", "n_removed_lines", F.size("removed_runs").cast("long").alias("n_runs"),
                    F.sha2(F.coalesce("clean_text", F.lit("")), 256).alias("kept_sha256"))


# --- 11 ----------------------------------------------------------------------

@_query("op11_decontamination", r"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                             '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS x FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS x FROM benchmark),
g AS (SELECT DISTINCT item_id, n, array_to_string(x[k:k + n - 1], ' ') AS s
      FROM (SELECT *, least(len(x), 10) AS n, unnest(range(1, len(x) - least(len(x), 10) + 2)) AS k FROM b WHERE len(x) > 0)),
w AS (SELECT doc_id, k, n, array_to_string(x[k:k + n - 1], ' ') AS s
      FROM (SELECT doc_id, x, n, unnest(range(1, len(x) - n + 2)) AS k FROM d, (SELECT DISTINCT n FROM g))),
h AS (SELECT doc_id, k, n, item_id FROM w JOIN g USING (n, s)),
c AS (SELECT doc_id, count(DISTINCT i) AS n_hit FROM (SELECT doc_id, unnest(range(k, k + n)) AS i FROM (SELECT DISTINCT doc_id, k, n FROM h)) GROUP BY doc_id),
t AS (SELECT doc_id, count(*) AS n_items, string_agg(item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS ids
      FROM (SELECT DISTINCT doc_id, item_id FROM h) GROUP BY doc_id)
SELECT d.doc_id, len(x)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN c USING (doc_id) LEFT JOIN t USING (doc_id)
""")
def op11(spark, sf_dir):
    d = decontam.contamination_report(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return d.select("doc_id", "n_words", "n_hit", F.size("item_ids").cast("long").alias("n_items"),
                    F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"), "contaminated")


# --- 12 ----------------------------------------------------------------------

@_query("op12_importance_resampling", r"""
WITH RECURSIVE bits AS (SELECT i, i::BIGINT AS c, 0 AS k FROM range(256) r(i) UNION ALL
                        SELECT i, xor(c >> 1, CASE WHEN c & 1 = 1 THEN 3988292384 ELSE 0 END), k + 1 FROM bits WHERE k < 8),
tab AS (SELECT list(c ORDER BY i) AS tab FROM bits WHERE k = 8),
d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS x FROM documents),
b AS (SELECT regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS x FROM benchmark),
dw AS (SELECT doc_id, w, count(*) AS n FROM (SELECT doc_id, unnest(x) AS w FROM d) GROUP BY ALL),
bw AS (SELECT w, count(*) AS n FROM (SELECT unnest(x) AS w FROM b) GROUP BY w),
v AS (SELECT w, list_transform(range(strlen(w)), lambda i: ('0x' || substr(hex(encode(w)), 2 * i + 1, 2))::BIGINT) AS y
      FROM (SELECT w FROM dw UNION SELECT w FROM bw)),
f AS (SELECT w, xor(list_reduce(list_prepend(4294967295, y), lambda c, z: xor(c >> 8, tab[(xor(c, z) & 255) + 1])), 4294967295) % 10000 AS k FROM v, tab),
s AS (SELECT k, sum(n)::DOUBLE AS s FROM dw JOIN f USING (w) GROUP BY k),
t AS (SELECT k, sum(n)::DOUBLE AS t FROM bw JOIN f USING (w) GROUP BY k),
a AS (SELECT coalesce((SELECT sum(s) FROM s), 0) AS s_all, coalesce((SELECT sum(t) FROM t), 0) AS t_all),
g AS (SELECT k, floor(1000 * ln((coalesce(t, 0) + 1) * (s_all + 10000) / ((s + 1) * (t_all + 10000))))::BIGINT AS gain FROM s LEFT JOIN t USING (k), a),
m AS (SELECT doc_id, sum(n * gain)::BIGINT AS weight FROM dw JOIN f USING (w) JOIN g USING (k) GROUP BY doc_id),
o AS (SELECT d.doc_id, len(x)::BIGINT AS n_features, coalesce(weight, 0) AS weight,
             ('0x' || substr(sha256('2024:' || d.doc_id), 1, 8))::BIGINT AS h FROM d LEFT JOIN m USING (doc_id)),
z AS (SELECT doc_id, n_features, weight, weight + floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296::DOUBLE)))::BIGINT AS score FROM o),
r AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS place FROM z WHERE n_features >= 20)
SELECT z.doc_id, n_features, weight, score, CASE WHEN place <= (SELECT count(*) FROM r) * 10 // 100 THEN place END AS rank
FROM z LEFT JOIN r USING (doc_id)
""")
def op12(spark, sf_dir):
    d = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return resample.importance_resample(d, _table(spark, sf_dir, "benchmark").select("text"))


# --- 13 ----------------------------------------------------------------------

@_query("op13_cross_tokenizer_alignment")
def op13(spark, sf_dir):
    d = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return align.cross_alignment(d, *align.default_files())
