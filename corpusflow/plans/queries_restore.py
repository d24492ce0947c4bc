"""Registered queries of the sequential rules (greedy fills, utterances, packing) and of the
alignments (restored texts, lines in books, vocabularies), with DuckDB oracles where
SQL can express the rule."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusflow.functions import channels as C
from corpusflow.functions import metrics as M
from corpusflow.functions import restore as R
from corpusflow.operators import aggs as A
from corpusflow.operators import books, greedy, tts
from corpusflow.operators import vocabulary as V
from corpusflow.plans.queries import query
from corpusflow.session import small_batches
from corpusflow.sources.manifest import DOC_DURATION_SQL, documents_manifest, table

# --- D2 ------------------------------------------------------------------------


@query("shard_by_size", f"""
WITH RECURSIVE s AS (SELECT doc_id, row_number() OVER (ORDER BY doc_id) AS k, ceil({DOC_DURATION_SQL} * 32000)::BIGINT AS size FROM documents),
f AS (SELECT doc_id, k, size AS held, 0 AS shard_id FROM s WHERE k = 1
      UNION ALL SELECT s.doc_id, s.k, CASE WHEN f.held + s.size > 20000000 THEN s.size ELSE f.held + s.size END,
                       f.shard_id + CASE WHEN f.held + s.size > 20000000 THEN 1 ELSE 0 END FROM f JOIN s ON s.k = f.k + 1)
SELECT doc_id, shard_id FROM f""")
def q_shard_by_size(spark, sf):
    d = documents_manifest(spark, sf).withColumn("size", F.ceil(greedy.audio_bytes(F.col("duration"))))
    return greedy.shard_by_size(d.select("doc_id", "size"), 20_000_000, "size", ["doc_id"]).select("doc_id", F.col("shard_id").cast("int").alias("shard_id"))


# --- W9 ------------------------------------------------------------------------

def _recordings(spark, sf):
    """Each document as a recording: a segment for every line, two lines a speaker's turn,
    word times from the word's place and length, pauses between lines."""
    worded = table(spark, sf, "documents").filter(F.col("text").rlike(r"[^\x20\x09-\x0D]"))
    d = worded.groupBy("doc_id").agg(F.collect_list("text").alias("t"))

    def lines(t):
        each = F.transform(F.split(t, "\n"), lambda x, i: F.struct(
            i.alias("line"), x.alias("text"), F.filter(F.split(x, r"[\x20\x09-\x0D]+"), lambda y: y != "").alias("w")))
        return F.filter(each, lambda x: F.size(x["w"]) > 0)

    each = F.flatten(F.transform("t", lines))
    begun = d.select("doc_id", F.when(F.size("t") > 1, F.array_sort(each)).otherwise(each).alias("l"))
    # how many words come before each line: where, in all the words, its first one is
    places = F.flatten(F.transform("l", lambda x: F.sequence(F.lit(0), F.size(x["w"]) - 1)))
    firsts = F.filter(F.transform(places, lambda k, i: F.when(k == 0, i)), lambda i: i.isNotNull())
    begun = begun.select("doc_id", "l", firsts.alias("f"))

    def segment(x, before):
        return F.get(F.transform(F.array(before), lambda first: F.struct(
            F.concat(F.lit("S"), F.floor(x["line"] / 2) % 2).alias("speaker"), x["text"].alias("text"),
            F.transform(x["w"], lambda word, k: F.struct(
                word.alias("word"), ((first + k) * 0.5 + x["line"] * 3.0).alias("start"),
                ((first + k) * 0.5 + x["line"] * 3.0 + F.when(F.length(word) % 11 == 0, 25.0).otherwise(0.25 + F.length(word) % 3 * 0.125)).alias("end"))).alias("words"),
            F.struct(F.lit(1.0).alias("pesq_squim"), F.lit(1.0).alias("stoi_squim"), F.lit(1.0).alias("sisdr_squim"),
                     F.when(x["line"] % 5 == 4, 8000).otherwise(16000).alias("bandwidth")).alias("metrics"))), 0)

    return begun.select("doc_id", F.zip_with("l", "f", segment).alias("segments"))


@query("tts_segments", r"""
WITH RECURSIVE l AS (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS x, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) - 1 AS line FROM documents),
t AS (SELECT doc_id, line, unnest(list_filter(regexp_split_to_array(x, '[\x20\x09-\x0D]+'), lambda y: y <> '')) AS word,
             generate_subscripts(list_filter(regexp_split_to_array(x, '[\x20\x09-\x0D]+'), lambda y: y <> ''), 1) AS k FROM l),
u AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY line, k) - 1 AS i FROM t),
w AS (SELECT doc_id, i, word, i * 0.5::DOUBLE + line * 3.0::DOUBLE AS s, i * 0.5::DOUBLE + line * 3.0::DOUBLE + CASE WHEN len(word) % 11 = 0 THEN 25.0::DOUBLE ELSE 0.25::DOUBLE + len(word) % 3 * 0.125::DOUBLE END AS e,
             'S' || (line // 2) % 2 AS speaker, CASE WHEN line % 5 = 4 THEN 8000 ELSE 16000 END AS bw FROM u),
r AS (SELECT *, sum(fresh) OVER (PARTITION BY doc_id ORDER BY i) AS run
      FROM (SELECT *, CASE WHEN speaker IS DISTINCT FROM lag(speaker) OVER (PARTITION BY doc_id ORDER BY i) THEN 1 ELSE 0 END AS fresh FROM w)),
p AS (SELECT doc_id, run, i, s, e, row_number() OVER (PARTITION BY doc_id, run ORDER BY i) AS c FROM r WHERE right(word, 1) IN ('.', '!', '?')),
m AS (SELECT doc_id, run, max(c) AS m FROM p GROUP BY ALL),
o AS (SELECT a.doc_id, a.run, a.c, a.e - a.s >= 5 AS own, coalesce(min(b.c) - 1, any_value(m.m)) AS last
      FROM p a JOIN m USING (doc_id, run) LEFT JOIN p b ON b.doc_id = a.doc_id AND b.run = a.run AND b.c > a.c AND b.e - a.s > 20 GROUP BY ALL),
h AS (SELECT doc_id, run, 1::BIGINT AS c FROM m UNION ALL
      SELECT h.doc_id, h.run, CASE WHEN own THEN h.c + 1 WHEN last > h.c THEN last + 1 ELSE h.c + 2 END
      FROM h JOIN o USING (doc_id, run, c)),
q AS (SELECT doc_id, run, unnest(CASE WHEN own THEN [c] WHEN last > c THEN [last] ELSE [c, c + 1] END) AS c FROM h JOIN o USING (doc_id, run, c)),
f AS (SELECT q.doc_id, q.run, p.i FROM q JOIN p USING (doc_id, run, c)),
b AS (SELECT doc_id, run, min(i) AS a, max(i) AS z FROM r GROUP BY ALL),
g AS (SELECT b.doc_id, b.run, coalesce(lag(f.i) OVER x + 1, b.a) AS a, f.i AS z, false AS rest FROM b JOIN f USING (doc_id, run) WINDOW x AS (PARTITION BY b.doc_id, b.run ORDER BY f.i)
      UNION ALL SELECT b.doc_id, b.run, coalesce(max(f.i) + 1, b.a), b.z, true FROM b LEFT JOIN f USING (doc_id, run) GROUP BY b.doc_id, b.run, b.a, b.z),
j AS (SELECT g.doc_id, g.a, g.z, g.rest OR y.e - x.s > 20 AS cut FROM g JOIN r x ON x.doc_id = g.doc_id AND x.i = g.a JOIN r y ON y.doc_id = g.doc_id AND y.i = g.z WHERE g.a <= g.z),
v AS (SELECT j.doc_id, j.z, j.a AS i, j.a AS first, x.s AS s, x.e AS e, x.bw FROM j JOIN r x ON x.doc_id = j.doc_id AND x.i = j.a WHERE cut
      UNION ALL SELECT doc_id, z, i, CASE WHEN brk THEN i ELSE first END, CASE WHEN brk THEN ns ELSE s END, ne, nbw FROM (
        SELECT v.doc_id, v.z, x.i, v.first, v.s, x.s AS ns, x.e AS ne, x.bw AS nbw,
               x.e - v.s > 20 OR ((x.s - v.e > 2 OR x.bw <> v.bw) AND v.e - v.s >= 5) AS brk
        FROM v JOIN r x ON x.doc_id = v.doc_id AND x.i = v.i + 1 WHERE v.i < v.z)),
k AS (SELECT doc_id, a, z FROM j WHERE NOT cut UNION ALL SELECT doc_id, first, max(i) FROM v GROUP BY doc_id, first)
SELECT k.doc_id, any_value(r.speaker) AS speaker, min_by(r.s, r.i) AS seg_start, max_by(r.e, r.i) AS seg_end, string_agg(r.word, ' ' ORDER BY r.i) AS text, count(*) AS n_words
FROM k JOIN r ON r.doc_id = k.doc_id AND r.i BETWEEN k.a AND k.z GROUP BY k.doc_id, k.a, k.z
HAVING NOT (count(*) = 1 AND max(r.e - r.s) > 20)""")
def q_tts_segments(spark, sf):
    out = tts.tts_segments(_recordings(spark, sf))
    # a plain explode would put a filter on the array before it, and so make the utterances twice
    out = out.select("doc_id", F.explode_outer("segments").alias("u")).filter("u IS NOT NULL")
    return out.select("doc_id", "u.speaker", F.col("u.start").alias("seg_start"), F.col("u.end").alias("seg_end"), "u.text", F.size("u.words").cast("long").alias("n_words"))


# --- T20, T21, T26, T27 ----------------------------------------------------------

@query("restore_punctuation", r"""
WITH d AS (SELECT doc_id, list_filter(regexp_split_to_array(regexp_replace(replace(text, '¿', ' ¿ '), '(\d)[.,](\d)', '\1\2', 'g'), '\s+'), lambda w: w <> '') AS w FROM documents WHERE text IS NOT NULL)
SELECT doc_id, replace(array_to_string(w, ' '), '¿ ', '¿') AS restored FROM d""")
def q_restore_punctuation(spark, sf):
    """Texts against themselves in lower case, without the marks at the ends of words."""
    d = table(spark, sf, "documents").filter("text IS NOT NULL")
    spoken = F.regexp_replace(F.regexp_replace(F.lower("text"), r"(\d)[.,](\d)", "$1$2"), r"(?<=[a-z])[.,!?;:](?=\s|$)", "")
    return d.select("doc_id", R.restore_punctuation(F.col("text"), spoken).alias("restored"))


_NUMERALS = [R.roman(n) for n in range(1, 101)]


@query("roman_numerals", """
WITH n AS (SELECT o_orderkey, o_orderkey % 130 + 1 AS a, o_custkey % 100 + 1 AS b,
                  ['', 'i', 'ii', 'iii', 'iv', 'v', 'vi', 'vii', 'viii', 'ix'] AS ones, ['', 'x', 'xx', 'xxx', 'xl', 'l', 'lx', 'lxx', 'lxxx', 'xc', 'c', 'cx', 'cxx', 'cxxx'] AS tens FROM orders),
r AS (SELECT o_orderkey, a, b, tens[a // 10 + 1] || ones[a % 10 + 1] AS ra, tens[b // 10 + 1] || ones[b % 10 + 1] AS rb FROM n),
x AS (SELECT *, o_orderkey % 3 = 0 AS big, CASE WHEN o_orderkey % 3 = 0 THEN 'El Siglo ' || upper(ra) || ' y rey ' || rb || ' fin' ELSE 'un siglo ' || ra || ' , rey ' || rb || ' siglo ' || rb END AS t FROM r),
y AS (SELECT *, CASE WHEN a > 100 THEN t WHEN big THEN replace(t, 'Siglo ' || upper(ra), 'Siglo Th' || a) ELSE replace(t, 'siglo ' || ra, 'siglo th' || a) END AS u FROM x)
SELECT o_orderkey, replace(u, 'rey ' || rb, 'rey king' || b) AS text FROM y""")
def q_roman_numerals(spark, sf):
    o = table(spark, sf, "orders")
    numeral = F.array(*[F.lit(R.roman(n)) for n in range(1, 131)])
    a, b = (F.element_at(numeral, (c + 1).cast("int")) for c in (F.col("o_orderkey") % 130, F.col("o_custkey") % 100))
    text = (F.when(F.col("o_orderkey") % 3 == 0, F.concat(F.lit("El Siglo "), F.upper(a), F.lit(" y  rey "), b, F.lit(" fin")))
             .otherwise(F.concat(F.lit(" un siglo "), a, F.lit(" , rey "), b, F.lit(" siglo "), b)))
    rules = [(["siglo"], {r: f"th{n + 1}" for n, r in enumerate(_NUMERALS)}), (["reina", "rey"], {r: f"king{n + 1}" for n, r in enumerate(_NUMERALS)})]
    return o.select("o_orderkey", R.write_numerals(text, rules).alias("text"))


@query("book_text", r"""
WITH d AS (SELECT doc_id, regexp_replace(regexp_replace(regexp_replace(coalesce(text, ''), '([.?!])(["''])', '\2\1 ', 'g'), ' +', ' ', 'g'), '([a-z])\. ([a-z])\.', '\1.\2.', 'g') AS t FROM documents),
h AS (SELECT doc_id, regexp_replace(regexp_replace(regexp_replace(t, '([A-Z][a-z]*\.)([\s\x{85}\x{A0}\x{2000}-\x{200A}\x{3000}])', '\1' || chr(1) || '\2', 'g'),
        '([\pL\pN\pM_]\.[\pL\pN\pM_].)([\s])', '\1' || chr(1) || '\2', 'g'), '([\s])([0-9]+[a-z]*\.)', chr(1) || '\1\2', 'g') AS t FROM d),
s AS (SELECT doc_id, list_transform(string_split(regexp_replace(t, '([.?!]|\.”)([\s])', '\1' || chr(2), 'g'), chr(2)), lambda x: replace(x, chr(1), '')) AS s FROM h),
f AS (SELECT doc_id, list_reduce(list_prepend({'last': '', 'done': []::VARCHAR[]}, list_transform(s, lambda x: {'last': x, 'done': []::VARCHAR[]})),
        lambda a, x: CASE WHEN len(a['last']) < 500 THEN {'last': a['last'] || ' ' || x['last'], 'done': a['done']}
                          ELSE {'last': '', 'done': list_append(a['done'], regexp_replace(a['last'], '^\s+|\s+$', '', 'g'))} END) AS f FROM s)
SELECT doc_id, regexp_replace(array_to_string(CASE WHEN len(f['last']) > 0 THEN list_append(f['done'], regexp_replace(f['last'], '^\s+|\s+$', '', 'g')) ELSE f['done'] END, ' '), '\d', '', 'g') AS book FROM f""")
def q_book_text(spark, sf):
    return table(spark, sf, "documents").select("doc_id", R.normal_book(F.coalesce("text", F.lit("")), 500).alias("book"))


@query("write_back_predictions", r"""
WITH w AS (SELECT doc_id, string_split(coalesce(text, ''), ' ') AS w FROM documents)
SELECT doc_id, array_to_string(list_transform(w, lambda x: CASE WHEN x = '' THEN x ELSE '<' || x || '>' END), '|') AS words, len(w)::BIGINT AS n_words FROM w""")
def q_write_back(spark, sf):
    """Words at single blanks, empty ones too; the prediction is the words in brackets."""
    w = F.split(F.coalesce("text", F.lit("")), " ")
    d = table(spark, sf, "documents").select("doc_id", F.transform(w, lambda x, i: F.struct(x.alias("word"), i.alias("at"))).alias("alignment"),
                                             F.transform(F.filter(w, lambda x: x != ""), lambda x: F.concat(F.lit("<"), x, F.lit(">"))).alias("tokens"))
    back = d.select("doc_id", R.write_back(F.col("alignment"), F.col("tokens")).alias("a"))
    return back.select("doc_id", F.array_join(F.col("a.word"), "|").alias("words"), F.size("a").cast("long").alias("n_words"))


# --- J9 ------------------------------------------------------------------------

_CHUNK = 12


@query("lines_in_books", r"""
WITH d AS (SELECT doc_id AS book, regexp_extract_all(coalesce(text, ''), '[\pL\pN]+(?:[''’][\pL\pN]+)*') AS w FROM documents),
c AS (SELECT book, unnest(range(0, len(w) // 12)) AS seq, w FROM d)
SELECT book, seq, CASE WHEN seq % 5 = 3 THEN 'n/a' ELSE lower(regexp_replace(array_to_string(w[12 * seq + 1:12 * seq + 12], ' '), '[^\pL\pN ]', '', 'g')) END AS restored FROM c""")
def q_lines_in_books(spark, sf):
    """Every document is a book, read in lines of twelve words; in every fifth one a word
    was misheard.  What is found has to have the words of the line (case and marks, which
    may differ between places with the same words, are taken off again)."""
    shelf = table(spark, sf, "documents").select(F.col("doc_id").alias("book"), "text")
    w = F.transform(books.book_pieces(F.col("text")), books._normal)
    chunks = shelf.select("book", w.alias("w")).select("book", "w", F.explode(F.sequence(F.lit(0), F.greatest(F.floor(F.size("w") / _CHUNK) - 1, F.lit(0)))).alias("seq")).filter(F.size("w") >= _CHUNK)
    said = F.slice("w", (F.col("seq") * _CHUNK + 1).cast("int"), F.lit(_CHUNK))
    lines = chunks.select("book", "seq", F.array_join(F.when(F.col("seq") % 5 == 3, F.concat(F.slice(said, 1, 6), F.array(F.lit("misheardword")), F.slice(said, 8, 5))).otherwise(said), " ").alias("text"))
    got = books.restore_lines(lines, shelf)
    plain = F.array_join(F.transform(books.book_pieces(F.col("restored")), books._normal), " ")
    return got.select("book", "seq", F.when(F.col("restored") == books.MISSING, F.col("restored")).otherwise(plain).alias("restored"))


# --- A6, A12, T19, T16 -----------------------------------------------------------

@query("bootstrap_exact", """
WITH o AS (SELECT row_number() OVER (ORDER BY o_orderkey) - 1 AS i, (o_orderkey % 101)::DOUBLE AS one, (o_custkey % 97)::DOUBLE AS two FROM orders),
n AS (SELECT count(*) AS n FROM o),
d AS (SELECT b, (i * 7 + b * 13 + i * b) % n AS i FROM o, n, range(20) t(b)),
m AS (SELECT b, avg(one) AS one, avg(two) AS two FROM d JOIN o USING (i) GROUP BY b),
v AS (SELECT 'one' AS system, NULL AS versus, one AS v FROM m UNION ALL SELECT 'two', NULL, two FROM m UNION ALL SELECT 'one', 'two', one - two FROM m)
SELECT system, versus, round(avg(v), 9) AS mean, round(quantile_cont(v, 0.025), 9) AS ci_lower, round(quantile_cont(v, 0.975), 9) AS ci_upper, round(avg(CASE WHEN v > 0 THEN 1.0 ELSE 0.0 END), 9) AS poi
FROM v GROUP BY system, versus""")
def q_bootstrap_exact(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", (F.col("o_orderkey") % 101).alias("one"), (F.col("o_custkey") % 97).alias("two"))
    n = o.count()
    given = spark.range(n * 20).select((F.col("id") % 20).alias("b"), F.floor(F.col("id") / 20).alias("r")).select(
        "b", ((F.col("r") * 7 + F.col("b") * 13 + F.col("r") * F.col("b")) % n).alias("i"))
    r = A.bootstrap_exact(o, ["one", "two"], ["o_orderkey"], indices=given)
    return r.select("system", "versus", *[F.round(c, 9).alias(c) for c in ("mean", "ci_lower", "ci_upper", "poi")])


_MENU_KINDS = {"metals": ("steel", "copper", "brass"), "sauces": ("tin", "nickel"), "plain": ("standard", "economy")}


@query("menu_vocabulary", """
WITH m AS (SELECT lower(p_type) AS name, CASE WHEN p_partkey % 4 = 0 THEN [lower(p_brand), lower(p_name)] ELSE [] END AS o FROM part),
e AS (SELECT CASE WHEN regexp_matches(name, 'steel|copper|brass') THEN 'metals' WHEN regexp_matches(name, 'tin|nickel') THEN 'sauces' WHEN regexp_matches(name, 'standard|economy') THEN 'plain' END AS category, name AS term FROM m
      UNION SELECT 'all_items', name FROM m
      UNION SELECT 'all_items', trim(replace(replace(replace(replace(name, 'small ', ''), 'medium ', ''), 'large ', ''), 'jumbo ', '')) FROM m WHERE regexp_matches(name, 'small|medium|large|jumbo')
      UNION SELECT 'all_items', unnest(o) FROM m
      UNION SELECT 'sauces', x FROM (SELECT unnest(o) AS x FROM m) WHERE contains(x, 'a'))
SELECT category, term FROM e WHERE category IS NOT NULL AND term <> ''""")
def q_menu_vocabulary(spark, sf):
    p = table(spark, sf, "part")
    options = F.when(F.col("p_partkey") % 4 == 0, F.array(F.struct(F.array(F.struct(F.col("p_brand").alias("name")), F.struct(F.col("p_name").alias("name"))).alias("options"))))
    return V.menu_vocabulary(p.select(F.col("p_type").alias("name"), options.alias("option_groups")), _MENU_KINDS, option_category=("sauces", "a"))


@query("vocabulary_correction")
def q_vocabulary_correction(spark, sf):
    """Part names with letters left out, corrected with the words of all part names and
    their pairs; the rule itself is held against a plain version in the tests."""
    p = table(spark, sf, "part").select("p_partkey", F.split(F.lower("p_name"), " ").alias("w"))
    heard = F.transform("w", lambda x, i: F.when((F.col("p_partkey") + i) % 3 == 0, F.concat(F.substring(x, 1, 2), F.substring(x, F.lit(4), F.length(x)))).otherwise(x))
    names = p.select(F.explode("w").alias("item")).union(p.select(F.array_join(F.slice("w", 1, 2), " ").alias("item"))).distinct()
    items = names.select("item", F.xxhash64("item").alias("rank"))
    texts = p.select("p_partkey", F.initcap(F.array_join(heard, " ")).alias("text"))
    return V.correct_vocabulary(texts, "p_partkey", items, {"rd": "red", "bue": "blue"}, misspelt=list("aeiou"))


@query("channel_consensus")
def q_channel_consensus(spark, sf):
    """Each turn against itself with words left out, doubled or misheard, by all strategies;
    the merge is held against hand cases in the tests."""
    small_batches(spark)
    c = table(spark, sf, "conversations").select("conv_id", "turn", F.split(F.coalesce("text", F.lit("")), " ").alias("w"))
    other = F.flatten(F.transform("w", lambda x, i: F.when(i % 7 == 3, F.array().cast("array<string>")).when(i % 7 == 5, F.array(x, F.lit("uh")))
                                  .when(i % 7 == 6, F.array(F.concat(x, F.lit("s")))).otherwise(F.array(x))))
    two = c.select("conv_id", "turn", F.array_join("w", " ").alias("mic"), F.array_join(other, " ").alias("spk"))
    two = two.withColumn("sim", M.similarity(F.lower("mic"), F.lower("spk")))
    merged = [C.validated(F.col("mic"), F.col("spk"), F.col("sim"), strategy=s, use_cleaner_channel=k).alias(f"{s}_{k}".lower())
              for s in ("consensus", "speaker_priority", "best_confidence") for k in (False, True)]
    return two.select("conv_id", "turn", *merged)
