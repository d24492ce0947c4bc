"""Near-duplicates, line, suffix and substring dedup against plain versions."""
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

import plain
from corpusflow.llm import bloom, graph, linededup, minhash, numerics, repeats, store, substring, suffix


def _pairs(rows):
    return [(r[0], r[1]) for r in rows]


def test_word_hashes_over_chunks(monkeypatch):
    import pyarrow as pa

    texts = ["a bb  ccc", "", "bb", " lead", "trail ", "x" * 300, "é ü \x0b z", None, "ccc a", "y" * 100 + " " + "z" * 90]
    buf, off = numerics.utf8(pa.array(texts))
    whole = numerics.word_hashes(buf, off)
    assert whole[1].tolist() == [len(plain.words(t)) for t in texts]
    flat = [w for t in texts for w in plain.words(t)]
    assert len({(w, h) for w, h in zip(flat, whole[0].tolist())}) == len(set(flat)) == len(set(whole[0].tolist()))
    for size in (3, 16, 64):
        monkeypatch.setattr(numerics, "CHUNK", size)
        part = numerics.word_hashes(buf, off)
        assert (part[0] == whole[0]).all() and (part[1] == whole[1]).all()


def test_components(spark):
    rng = random.Random(3)
    edges = [(rng.randrange(60), rng.randrange(60)) for _ in range(45)] + [(100 + i, 101 + i) for i in range(30)]
    got = {r["node"]: r["component"] for r in graph.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    root = {x: x for e in edges for x in e}
    for _ in root:
        for a, b in edges:
            root[a] = root[b] = min(root[a], root[b])
    assert got == {x: r for x, r in root.items() if any(x in e and e[0] != e[1] for e in edges)}


def test_bloom_has_no_false_negatives(spark):
    keys = spark.range(0, 5000, 2).selectExpr("xxhash64(id) AS h")
    for bits in (512, 1 << 20):
        words = bloom.bloom_words(keys, "h", 2500, bits)
        h = np.array([r["h"] for r in keys.collect()])
        assert bloom.contains(h, words).all()
    other = np.array([r["h"] for r in spark.range(1, 5000, 2).selectExpr("xxhash64(id) AS h").collect()])
    assert bloom.contains(other, words).mean() < 0.02


@pytest.mark.parametrize("k", [4, 5])
def test_near_duplicates(docs, rows, k):
    want = plain.near_components(_pairs(rows), k)
    got = minhash.near_duplicate_ids(docs, params=minhash.MinHashParams(words=k)).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == want
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in got)


def test_near_duplicate_chain_in_shared_buckets(spark):
    """A chain of texts, each like its neighbours only, and unlike texts with a
    long common part: later passes have to find the links the first one does not."""
    rng = random.Random(11)
    rows, w = [], [f"c{rng.randrange(10**6)}" for _ in range(120)]
    for i in range(25):
        rows.append((i, " ".join(w)))
        w = w[4:] + [f"c{rng.randrange(10**6)}" for _ in range(4)]
    common = [f"k{j}" for j in range(60)]
    rows += [(50 + i, " ".join(common + [f"u{i}x{j}" for j in range(20)])) for i in range(30)]
    rows += [(90 + i, " ".join(common + [f"u{i}x{j}" for j in range(18)] + ["end", "end"])) for i in range(5)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = minhash.near_duplicate_ids(df).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == plain.near_components(rows)


def test_near_duplicates_of_a_template(spark):
    """Over a hundred variants of one text that are unlike each other, like it, or
    between, and texts around one common passage: large buckets without a link in them."""
    rng = random.Random(5)
    base = [f"b{j}" for j in range(150)]
    rows = []
    for i in range(140):
        w = list(base)
        for j in rng.sample(range(150), i % 9):
            w[j] = f"v{i}x{j}"
        rows.append((1000 - i, " ".join(w + [f"t{i}x{j}" for j in range(rng.randrange(9))])))
    rows += [(2000 + i, " ".join(base[:70] + [f"u{i}x{j}" for j in range(30)])) for i in range(80)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = minhash.near_duplicate_ids(df).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == plain.near_components(rows)


def test_near_duplicate_recall(spark):
    """1,000 pairs of a similarity between 0.80 and 0.85: at most one may be missed."""
    rng = random.Random(17)
    rows = []
    for i in range(1000):
        n = rng.randrange(80, 200)
        extra = int(n * rng.uniform(0.178, 0.25))           # n / (n + extra) is 0.80 to 0.85
        w = [f"p{i}x{j}" for j in range(n + 4 + extra)]
        rows += [(2 * i, " ".join(w[:n + 4])), (2 * i + 1, " ".join(w))]
    got = minhash.near_duplicate_ids(spark.createDataFrame(rows, "doc_id long, text string")).filter("doc_id % 2 = 1")
    assert got.filter("component_id = doc_id - 1").count() >= 999


def test_near_dedup_takes_few_jobs(spark):
    """What the driver keeps grows with the jobs: rows are counted while they are written
    and not by jobs of their own (194 jobs before, 148 now)."""
    base = [f"b{j}" for j in range(60)]
    rows = [(i, " ".join(base[:i % 5] + ["x"] + base[i % 5:])) for i in range(5)]
    rows += [(100 + i, " ".join(base[:30] + [f"u{i}x{j}" for j in range(30)])) for i in range(40)]
    spark.sparkContext.setJobGroup("few jobs", "")
    try:
        got = minhash.near_duplicate_ids(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == plain.near_components(rows)
    assert len(spark.sparkContext.statusTracker().getJobIdsForGroup("few jobs")) < 165


def test_near_dedup_takes_few_passes(spark, tmp_path, monkeypatch):
    """Every pass over a small table costs a file for each task of it: two sweeps over the
    bands and no more (there were five sweeps before)."""
    base = [f"b{j}" for j in range(60)]
    rows = [(i, " ".join(base[:i % 5] + ["x"] + base[i % 5:])) for i in range(5)]
    rows += [(100 + i, " ".join(base[:30] + [f"u{i}x{j}" for j in range(30)])) for i in range(40)]
    written = []
    for name in ("stored", "summed"):
        kept = getattr(minhash, name)
        monkeypatch.setattr(minhash, name, lambda df, at, *more, kept=kept: (written.append(at), kept(df, at, *more))[1])
    got = minhash.near_duplicate_ids(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == plain.near_components(rows)
    assert written.count("buckets") <= 2 and written.count("open") <= 1 and len(written) < 20


@pytest.mark.parametrize("small", [0, 1 << 17])
def test_near_duplicates_pass_by_pass(spark, docs, rows, monkeypatch, small):
    """Tables too large to go to every task are shuffled, and buckets of more pivots than go
    at once take several passes: the same components."""
    for module in (store, bloom, minhash):
        monkeypatch.setattr(module, "SMALL", small)
    monkeypatch.setattr(minhash, "PIVOTS", 1)
    monkeypatch.setattr(minhash, "SPLIT", 6)
    rng, base = random.Random(23), [f"b{j}" for j in range(90)]
    more = []
    for i in range(40):
        w = list(base)
        for j in rng.sample(range(90), i % 7):
            w[j] = f"v{i}x{j}"
        more.append((1000 - i, " ".join(w + [f"t{i}x{j}" for j in range(rng.randrange(12))])))
    got = minhash.near_duplicate_ids(spark.createDataFrame(more, "doc_id long, text string")).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == plain.near_components(more)
    want = {i for i, (_, c) in plain.near_components(_pairs(rows)).items() if i == c}
    unnamed = docs.limit(1).withColumn("doc_id", F.lit(None).cast("long"))
    left = [r["doc_id"] for r in minhash.drop_near_duplicates(docs.union(unnamed)).collect()]
    assert set(left) == want | {None} and len(left) == len(want) + 1


def test_rows_counted_while_written(spark):
    table, (n, low) = store.summed(spark.range(5).filter("id <> 3"), "some", F.min("id"))
    assert (n, low) == (4, 0) and table.count() == 4
    gone = spark.range(5).join(spark.range(9), "id", "left_anti").distinct()
    assert store.summed(gone, "none", F.sum("id"))[1] == (0, None)
    grown = store.Grown(spark, "id long", "grown")
    assert grown.rows().count() == 0
    for k in range(3):
        part, n = grown.add(spark.range(10 * k, 10 * k + 5).join(grown.rows(), "id", "left_anti"))
        assert n == 5 and sorted(r["id"] for r in part.collect()) == list(range(10 * k, 10 * k + 5))
    assert grown.add(gone)[1] == 0 and grown.rows().count() == 15


def test_drop_near_duplicates(docs, rows):
    want = {i for i, (_, c) in plain.near_components(_pairs(rows)).items() if i == c}
    left = minhash.drop_near_duplicates(docs.withColumn("n", F.lit(1)).withColumn("kept", F.lit("x")))
    assert left.columns == [*docs.columns, "n", "kept"] and {r["doc_id"] for r in left.collect()} == want


def test_near_duplicates_odd(odd_docs, no_docs):
    got = minhash.near_duplicate_ids(odd_docs.withColumn("id", F.lit("x")).withColumn("keys", F.lit("x"))).collect()
    assert len(got) == 10
    assert all(r["component_id"] is None and r["kept"] for r in got if r["doc_id"] is None)
    assert {r["component_id"] for r in got if r["doc_id"] == 2} == {1}
    assert {(r["doc_id"], r["component_id"]) for r in got if r["n_shingles"] == 0 and r["doc_id"]} == {(3, 3), (4, 4)}
    assert minhash.near_duplicate_ids(no_docs).count() == 0 and minhash.drop_near_duplicates(no_docs).count() == 0


def _line_runs_or_long(rows, size, long):
    """plain.line_runs, where a repeated line of ``long`` words or more goes alone too."""
    seen, gone, out = [set(), set()], {}, {}
    seqs = {i: [(p, x) for p, x in enumerate((t or "").split("\n")) if plain.words(x)] for i, t in rows}
    for i in sorted(seqs):
        x, gone[i] = [x for _, x in seqs[i]], set()
        for q in range(len(x)):
            for n, known in zip((size, 1), seen):
                run = tuple(x[q:q + n])
                if len(run) == n and (n > 1 or len(plain.words(x[q])) >= long):
                    gone[i].update(range(q, q + n) if run in known else ())
                    known.add(run)
    for i, t in rows:
        drop, s = set(), seqs[i]
        for q in gone[i]:
            drop.update(range(s[q][0], s[q + 1][0] + 1) if q + 1 in gone[i] else [s[q][0]])
        out[i] = (len(gone[i]), "\n".join(x for p, x in enumerate((t or "").split("\n")) if p not in drop))
    return out


@pytest.mark.parametrize("size", [1, 2, 3, 4])
def test_line_dedup(docs, rows, size):
    want = plain.line_runs(_pairs(rows), size)
    for r in linededup.line_dedup(docs, min_lines=size).collect():
        n, left = want[r["doc_id"]]
        assert r["n_removed_lines"] == n == sum(x["lines"] for x in r["removed_runs"])
        assert (r["clean_text"] or "") == left
        assert r["n_lines"] == sum(bool(plain.words(x)) for x in (r["text"] or "").split("\n"))


def test_line_dedup_odd(spark, odd_docs, no_docs):
    out = linededup.line_dedup(odd_docs.withColumn("runs", F.lit("x")).withColumn("d", F.lit(1)).withColumn("clean_text", F.lit(1))).collect()
    assert len(out) == 10 and all(r["runs"] == "x" for r in out)
    # the row without identifier holds the one long line first
    assert sorted((r["doc_id"], r["clean_text"]) for r in out if r["n_removed_lines"]) == [(1, ""), (1, ""), (2, "")]
    assert all(r["clean_text"] == r["text"] for r in out if not r["n_removed_lines"])
    assert linededup.line_dedup(no_docs).count() == 0
    rows = [(1, "a\nb\nc"), (1, "a\nb\nc"), (2, "x\n\na\n\nb"), (None, "b\nc")]
    got = {r["doc_id"]: r["clean_text"] for r in linededup.line_dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {None: "b\nc", 1: "a", 2: "x\n"}


@pytest.mark.parametrize("size", [2, 3])
@pytest.mark.parametrize("long", [1, 12, 30])
def test_line_dedup_long_lines(docs, rows, size, long):
    want = _line_runs_or_long(_pairs(rows), size, long)
    assert want != plain.line_runs(_pairs(rows), size, 0)
    for r in linededup.line_dedup(docs, min_lines=size, long_words=long).collect():
        n, left = want[r["doc_id"]]
        assert r["n_removed_lines"] == n == sum(x["lines"] for x in r["removed_runs"])
        assert (r["clean_text"] or "") == left


def test_line_dedup_long_line_between_others(spark):
    long = " ".join(f"w{i}" for i in range(50))
    rows = [(1, f"a\n{long}\nb"), (2, f"c\n\n{long}\n\nd"), (3, long), (4, long + " x"), (5, f"e\na\n{long}\n{long}\nf"), (6, "a"), (7, "a")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: (r["clean_text"], [tuple(x) for x in r["removed_runs"]]) for r in linededup.line_dedup(df, long_words=50).collect()}
    assert got == {1: (rows[0][1], []), 2: ("c\n\n\nd", [(2, 2, 1)]), 3: ("", [(0, 0, 1)]), 4: (rows[3][1], []),
                   5: ("e\nf", [(1, 3, 3)]), 6: ("a", []), 7: ("a", [])}
    kept = {r["doc_id"] for r in linededup.line_dedup(df, long_words=51).filter("n_removed_lines = 0").collect()}
    assert kept == {1, 2, 3, 4, 6, 7}


def test_line_dedup_runs_are_unions(spark):
    df = spark.createDataFrame([(1, "a\nb"), (2, "c\nd"), (3, "a\nb\nc\nd")], "doc_id long, text string")
    assert {r["doc_id"]: [tuple(x) for x in r["removed_runs"]] for r in linededup.line_dedup(df).collect()} == {1: [], 2: [], 3: [(0, 3, 4)]}


def test_line_dedup_is_native(docs):
    plan = linededup.line_dedup(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


@pytest.mark.parametrize("hot", [0, 1, 256])
@pytest.mark.parametrize("size", [40, 100])
def test_suffix_dedup(docs, rows, size, hot, monkeypatch):
    make = repeats.RepeatParams
    monkeypatch.setattr(suffix, "RepeatParams", lambda *a, **k: make(*a, **k, hot_segments=hot))
    want = plain.byte_repeats(_pairs(rows), size)
    for r in suffix.suffix_dedup(docs, min_bytes=size).collect():
        assert (r["n_units"], r["n_removed"], len(r["removed_spans"]), plain.sha(bytes(r["clean"]))) == want[r["doc_id"]]


@pytest.mark.parametrize("hot", [0, 256])
@pytest.mark.parametrize("size", [6, 13])
def test_substring_dedup(docs, rows, size, hot, monkeypatch):
    make = repeats.RepeatParams
    monkeypatch.setattr(substring, "RepeatParams", lambda *a, **k: make(*a, **k, hot_segments=hot))
    want = plain.word_repeats(_pairs(rows), size)
    for r in substring.substring_dedup(docs, min_words=size).collect():
        assert (r["n_units"], r["n_removed"], plain.sha(bytes(r["clean"]))) == want[r["doc_id"]]


@pytest.mark.parametrize("module, run, size", [(suffix, suffix.suffix_dedup, 100), (substring, substring.substring_dedup, 13)])
def test_hot_anchors_are_split_by_content(spark, module, run, size, monkeypatch):
    """A passage that all documents share between texts of their own: rows made for its
    hot anchors stay a few for each distinct segment, not one for each window."""
    rng = random.Random(5)
    passage = " ".join(f"p{rng.randrange(10**5)}" for _ in range(60))
    rows = [(i, " ".join([f"u{rng.randrange(10**6)}" for _ in range(20)] + [passage] + [f"v{rng.randrange(10**6)}" for _ in range(20)])) for i in range(60)]
    make, store, made = repeats.RepeatParams, repeats.stored, {}
    assert make("bytes", 100, 24, True).hot_segments == 256
    monkeypatch.setattr(module, "RepeatParams", lambda *a, **k: make(*a, **k, hot_segments=8))

    def counted(df, name):
        made.setdefault(name, []).append(store(df, name))
        return made[name][-1]

    monkeypatch.setattr(repeats, "stored", counted)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    want = (plain.byte_repeats if size == 100 else plain.word_repeats)(rows, size)
    for r in run(df).collect():
        assert (r["n_units"], r["n_removed"], plain.sha(bytes(r["clean"]))) == (want[r["doc_id"]][0], want[r["doc_id"]][1], want[r["doc_id"]][-1])
    found = made["segments"][0]
    hot = found.join(found.groupBy("h").count().filter("count > 8"), "h")
    levels = (size - (suffix.GRAM if size == 100 else substring.GRAM)).bit_length()
    spread = sum(x.count() for x in made["halves"])
    assert "windows" not in made and 0 < spread <= 2 * levels * hot.count()


def test_segments_over_stretches(monkeypatch):
    """A text longer than a stretch is cut into windows without loss."""
    rng = np.random.default_rng(5)
    values = rng.integers(0, 40, 900).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    counts = np.array([700, 0, 30, 170])
    p = repeats.RepeatParams("bytes", 20, 6, True)
    for size in (1 << 20, 64):
        monkeypatch.setattr(numerics, "CHUNK", size)
        seen = [(d, i) for doc, first, n, *_ in repeats.segments(values, counts, p)
                for d, f, k in zip(doc.tolist(), first.tolist(), n.tolist()) for i in range(f, f + k)]
        assert sorted(seen) == [(d, i) for d, c in enumerate(counts.tolist()) for i in range(c - 19)]


def test_repeats_odd(odd_docs, no_docs):
    odd = odd_docs.withColumn("d", F.lit("x")).withColumn("clean", F.lit("x")).withColumn("spans", F.lit(1))
    for op, kind in ((suffix.suffix_dedup, bytes), (substring.substring_dedup, bytes)):
        out = op(odd).collect()
        assert len(out) == 10
        by = {(r["doc_id"], r["text"]): r for r in out}
        first = by[(None, next(t for i, t in by if i is None and t))]
        assert first["n_removed"] == 0                       # a null identifier comes first
        assert all(r["n_removed"] == r["n_units"] for r in out if r["doc_id"] in (1, 2))
        assert all(r["n_units"] == 0 and r["clean"] == b"" for r in out if not r["text"])
        assert op(no_docs).count() == 0


def test_long_windows_and_their_bound(spark):
    w = [f"w{i}" for i in range(6000)]
    d = spark.createDataFrame([(1, " ".join(w)), (2, "new " + " ".join(w))], "doc_id long, text string")
    got = {r["doc_id"]: r["n_removed"] for r in substring.substring_dedup(d, min_words=5000).collect()}
    assert got == {1: 0, 2: 6000}
    with pytest.raises(ValueError):
        substring.substring_dedup(d, min_words=1 << 15)


def test_kernel_in_slices(spark, docs, rows, monkeypatch):
    from corpusflow.llm import repeats

    monkeypatch.setattr(repeats, "SLICE", 3)
    pdf = pd.DataFrame({"h": [5, 1, 5, 1, 2, 2, 9], "dg": range(7)})
    seen = []
    monkeypatch.setattr(repeats, "_slice_runs", lambda part, p, kernel: seen.append(list(part["h"])) or part)
    assert len(repeats._runs_of(pdf, None, None)) == 7
    assert seen == [[1, 1, 2, 2], [5, 5, 9]] or all(len(set(a) & set(b)) == 0 for a, b in zip(seen, seen[1:]))


def test_substring_dedup_in_small_batches(spark, docs, rows, monkeypatch):
    """The rows that go to a Python worker are bounded, and the packs of anchors are neither
    a list for each batch nor one for each task."""
    keys = ("spark.sql.execution.arrow.maxRecordsPerBatch", "spark.sql.execution.arrow.maxBytesPerBatch")
    before = [spark.conf.get(k) for k in keys]
    try:
        spark.conf.set(keys[0], "10000")
        want = sorted((r["doc_id"], r["n_removed"], bytes(r["clean"])) for r in substring.substring_dedup(docs).collect())
        assert int(spark.conf.get(keys[0])) <= 1000 and spark.conf.get(keys[1]).rstrip("b") == str(4 << 20)
        monkeypatch.setattr(repeats, "PACKED", 50)
        spark.conf.set(keys[0], "3")
        got = sorted((r["doc_id"], r["n_removed"], bytes(r["clean"])) for r in substring.substring_dedup(docs).collect())
        assert got == want and any(n for _, n, _ in got)
    finally:
        for k, v in zip(keys, before):
            spark.conf.set(k, v)
