"""Quality rules, exact dedup, mixing and URL filter."""
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

import plain
from corpusflow.llm import exact, mixing, quality, urlfilter


def test_quality_counts(docs, rows):
    got = {r["doc_id"]: r["quality"] for r in quality.quality_rules(docs).collect()}
    assert len(got) == len(rows)
    for i, text, *_ in rows:
        w = plain.words(text)
        tri = [tuple(w[j:j + 3]) for j in range(len(w) - 2)]
        n = Counter(tri)
        rep = {j + k for j, t in enumerate(tri) if n[t] > 1 for k in range(3)}
        lines = [x for x in (text or "").split("\n") if plain.words(x)]
        q = got[i]
        assert (q["n_words"], q["word_chars"], q["n_repeat_words"]) == (len(w), sum(map(len, w)), len(rep))
        assert q["n_symbols"] == len(re.findall(r"[#*$%&|<>]", text or ""))
        assert q["n_dup_lines"] == len(lines) - len(set(lines))
        assert q["base_failed"] == (len(w) < 50 or 100 * len(rep) > 50 * len(w))


@pytest.mark.parametrize("line,fails", [
    ("A plain sentence ends here.", False), ('He said "stop!"', False), ("No end mark", True),
    ("all### words### carry### marks###.", True), ("It costs 5 $ in all the shops of the town.", False),
    ("LOUD!! WORDS!! ONLY!!", True), ("Home | About | Contact.", True), ("All rights reserved.", True),
    ("Licensed under the Apache License, Version 2.0.", True), ("Schluss … \t", False)])
def test_quality_lines(line, fails):
    assert quality.line_fails(line, len(plain.words(line)), quality.QualityParams()) is fails


def test_quality_cleans_and_rejects():
    good = "\n".join(" ".join(f"word{i}x{k}" for k in range(7)) + " end." for i in range(12))
    j = dict(zip([f.split()[0] for f in quality.SCHEMA.split(", ")], quality.judge(good + "\nHome | News | Login\n\nmenu", quality.QualityParams())))
    assert j["kept"] and j["n_bad_lines"] == 2 and j["clean_text"] == good + "\n"
    j = dict(zip([f.split()[0] for f in quality.SCHEMA.split(", ")], quality.judge(good + "\n" + "\n".join("junk line without an end" for _ in range(30)), quality.QualityParams())))
    assert not j["kept"]


def test_quality_odd(odd_docs, no_docs):
    out = quality.quality_rules(odd_docs.withColumn("quality", F.lit("x")).withColumn("n_words", F.lit("y"))).collect()
    assert len(out) == 10 and all(r["n_words"] == "y" for r in out)
    assert all(r["quality"]["n_words"] == 0 and not r["quality"]["kept"] for r in out if not r["text"])
    assert quality.quality_rules(no_docs).count() == 0


@pytest.mark.parametrize("keep", ["largest", "smallest"])
def test_exact(docs, rows, keep):
    got = {r["doc_id"]: r for r in exact.exact_dedup(docs, keep=keep).collect()}
    by = defaultdict(list)
    for i, t, *_ in rows:
        by[t or ""].append(i)
    assert len(got) == len(rows)
    for t, ids in by.items():
        stays = max(ids) if keep == "largest" else min(ids)
        for i in ids:
            r = got[i]
            assert (r["keep_id"], r["group_size"], r["kept"], r["text_sha256"]) == (stays, len(ids), i == stays, plain.sha(t))


def test_exact_hot_text_is_cut(spark):
    rows = [(i, "the same long text") for i in range(400)] + [(1000 + i, f"other {i % 90}") for i in range(120)] + [(None, "the same long text")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert exact._copies_cut(df, F.col("text"), 8)
    got = exact.exact_dedup(df, partitions=8).collect()
    same = [r for r in got if r["text"] == "the same long text"]
    assert {(r["keep_id"], r["group_size"]) for r in same} == {(399, 401)}
    assert [r["doc_id"] for r in same if r["kept"]] == [399]
    assert sum(r["kept"] for r in got) == 91


def test_exact_single_shuffle_of_the_texts(docs):
    plan = exact.exact_dedup(docs.select("doc_id", "text"))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("rangepartitioning") == 1 and "hashpartitioning" not in plan


def test_exact_odd(odd_docs, no_docs):
    out = exact.exact_dedup(odd_docs.withColumn("kept", F.lit("x")).withColumn("__HASH2", F.lit(1))).collect()
    assert len(out) == 10
    long = [r for r in out if r["text"] and r["text"].endswith("w59.")]
    assert len(long) == 4 and {r["keep_id"] for r in long} == {2} and sum(r["kept"] for r in long) == 1
    empty = [r for r in out if not r["text"]]
    assert {r["keep_id"] for r in empty} == {4} and {r["group_size"] for r in empty} == {3} and sum(r["kept"] for r in empty) == 1
    assert exact.exact_dedup(no_docs).count() == 0


def _targets(sizes):
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    w = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    left, open_, out = 1.5 * sum(sizes.values()), set(order), {}
    while open_:
        level = left / sum(w[s] for s in open_)
        over = {s for s in open_ if w[s] * level >= 2 * sizes[s]}
        if not over:
            return out | {s: w[s] * level for s in open_}
        for s in over:
            out[s] = 2.0 * sizes[s]
            left -= out[s]
        open_ -= over
    return out


def test_mixing(docs, rows):
    size = {i: len(plain.words(t)) for i, t, *_ in rows}
    per = defaultdict(int)
    for i, _, _, s, _ in rows:
        per[s] += size[i]
    want = _targets(per)
    got = mixing.mix_sources(docs, emit=False).collect()
    for r in got:
        assert r["size"] == size[r["doc_id"]] and r["source_size"] == per[r["source"]]
        assert r["target"] == pytest.approx(want[r["source"]])
        rate = r["target"] / r["source_size"]
        assert int(rate) <= r["copies"] <= int(rate) + 1 and r["copies"] <= 2
    emitted = Counter(r["doc_id"] for r in mixing.mix_sources(docs).collect())
    assert emitted == Counter({r["doc_id"]: r["copies"] for r in got if r["copies"]})
    again = mixing.mix_sources(docs.repartition(5), emit=False).collect()
    assert {(r["doc_id"], r["copies"]) for r in again} == {(r["doc_id"], r["copies"]) for r in got}


def test_mixing_comes_near_its_targets(spark):
    df = spark.range(6000).select(F.col("id").alias("doc_id"), F.concat(F.lit("s"), (F.col("id") % 7).cast("string")).alias("source"),
                                  F.repeat(F.lit("w "), (F.col("id") % 40 + 1).cast("int")).alias("text"))
    out = (mixing.mix_sources(df, emit=False).groupBy("source", "target")
           .agg(F.sum(F.col("copies") * F.col("size")).alias("taken"), F.first("source_size").alias("n")).collect())
    for r in out:
        assert abs(r["taken"] - r["target"]) <= 0.08 * r["n"]


def test_mixing_targets_of_large_sources(spark):
    """A weight times the level's numerator is beyond 32 bits, then beyond 64."""
    for scale in (1, 10**9):
        sizes = {f"s{i}": n * scale for i, n in enumerate([9_000_000, 70_000_000, 80_000_000, 60_000_000, 3_000_000, 50_000_000])}
        sized = spark.createDataFrame(list(sizes.items()), "__source string, size long")
        targets, n = mixing.source_targets(sized, (5, 2, 1))
        want = _targets(sizes)
        assert n == 6 and len(set(want.values())) > 3
        for r in targets.collect():
            assert r["source_size"] == sizes[r["__source"]] and r["target"] == pytest.approx(want[r["__source"]])


def test_mixing_odd(odd_docs, no_docs, spark):
    out = mixing.mix_sources(odd_docs.withColumn("size", F.lit("x")).withColumn("copies", F.lit("x")), emit=False).collect()
    assert len(out) == 10 and all(r["size"] == len(plain.words(r["text"])) for r in out)
    assert mixing.mix_sources(no_docs).count() == 0
    assert mixing.mix_sources(spark.createDataFrame([(1, None, None)], "doc_id long, text string, source string"), emit=False).first()["copies"] == 0


RULES = (urlfilter.Rule("allow", "com", "/"), urlfilter.Rule("block", "example.com", "/en/"),
         urlfilter.Rule("allow", "www.example.com", "/en/"), urlfilter.Rule("block", "net", "/es/"))
CASES = [("http://example.com/en/1", "example.com", "/en/1", "example.com/en/", "block"),
         ("http://WWW.Example.COM/en/1?q#f", "www.example.com", "/en/1", "www.example.com/en/", "allow"),
         ("http://a.www.example.com/en/", "a.www.example.com", "/en/", "www.example.com/en/", "allow"),
         ("http://notexample.com/en/1", "notexample.com", "/en/1", "com/", "allow"),
         ("http://example.com", "example.com", "", None, "allow"), ("http://x.net/es/a#b", "x.net", "/es/a", "net/es/", "block"),
         ("http://x.net/EN/a", "x.net", "/EN/a", None, "allow"), ("https://www.bad.net/a/index.html?u=http://x/", "www.bad.net", "/a/index.html", None, "block"),
         ("http://bad.net/a/", "bad.net", "/a/", None, "block"), ("http://bad.net/b", "bad.net", "/b", None, "allow"),
         ("mailto:x@y", "", "", None, "allow"), (None, "", "", None, "allow"), ("", "", "", None, "allow"), ("://bad.net/a", "bad.net", "/a", None, "block")]


def test_urls(spark):
    pages = spark.createDataFrame([(i, c[0], "x") for i, c in enumerate(CASES)] + [(0, CASES[0][0], "x")], "page_id long, url string, host string")
    listed = spark.createDataFrame([("bad.net/a",), ("bad.net/a",), (None,), ("other.net",)], "canonical string")
    got = urlfilter.url_filter(pages, RULES, listed).collect()
    assert len(got) == len(CASES) + 1
    for r in got:
        assert (r["host"], r["path"], r["rule"], r["verdict"]) == CASES[r["page_id"]][1:]
    none = urlfilter.url_filter(pages, RULES, listed.limit(0)).filter("verdict = 'block'").count()
    assert none == 3 and urlfilter.url_filter(pages.limit(0), RULES, listed).count() == 0


def test_urls_with_a_filter_that_is_too_small(spark):
    pages = spark.range(3000).selectExpr("id AS page_id", "concat('http://h', id % 50, '.org/p', id) AS url")
    listed = spark.range(0, 3000, 3).selectExpr("concat('h', id % 50, '.org/p', id) AS canonical")
    got = urlfilter.url_filter(pages, (), listed, max_filter_bits=512).collect()
    assert all((r["verdict"] == "block") == (r["page_id"] % 3 == 0) for r in got)
