"""Operators on small frames: reference test cases as data, brute-force
oracles for folds and ordered scans, partition-count invariance."""
import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from corpusflow.operators import filters as FL
from corpusflow.operators import folds as W
from corpusflow.operators import joins as J
from corpusflow.operators import shards as SH
from corpusflow.operators.scan import with_global_index, with_prefix_sum, with_previous
from corpusflow.sources.manifest import SEQ


def asr(spark, rows):
    return spark.createDataFrame(rows, ["text", "pred_text"])


def test_thresholds_inclusive(spark):
    df = spark.createDataFrame([("0123456789", 1.0)], ["text", "duration"])
    assert FL.drop_high_low_charrate(df, 9.9, 0).count() == 0
    assert FL.drop_high_low_charrate(df, 20, 10.1).count() == 0
    assert FL.drop_high_low_charrate(df, 10.0, 10.0).count() == 1


def test_cer_wer_filters(spark):
    df = asr(spark, [("0123456789", "012345678")])
    assert FL.drop_high_cer(df, 9.9).count() == 0 and FL.drop_high_cer(df, 10.1).count() == 1
    df = asr(spark, [("11 22", "11 22 33")])
    assert FL.drop_high_wer(df, 49.9).count() == 0 and FL.drop_high_wer(df, 50.1).count() == 1


def test_drop_on_attribute_and_ne(spark):
    df = spark.createDataFrame([(1, True), (2, False), (3, None)], "id int, f boolean")
    assert [r.id for r in FL.drop_on_attribute(df, "f").collect()] == [2]
    assert sorted(r.id for r in FL.preserve_by_value(df, "f", True, "ne").collect()) == [2, 3]


def test_drop_duplicates_keeps_first_under_skew(spark):
    # one key holds most rows; the survivor is the first in file order
    rows = [("hot", i) for i in range(500)] + [("cold", 1000), ("cold", 3)]
    df = spark.createDataFrame(rows, ["text", SEQ]).repartition(7)
    got = {r.text: r[SEQ] for r in FL.drop_duplicates(df, "text").collect()}
    assert got == {"hot": 0, "cold": 3}


def test_inner_join_suffixes(spark):
    l = spark.createDataFrame([(1, "a", 1.0), (2, "b", 2.0)], ["id", "text", "duration"])
    r = spark.createDataFrame([(1, "x", 5.0), (3, "y", 6.0)], ["id", "text", "duration"])
    out = J.inner_join(l, r, "id").collect()
    assert [tuple(x) for x in out] == [(1, "a", 1.0, "x", 5.0)]
    assert J.inner_join(l, r, "id").columns == ["id", "text_x", "duration_x", "text_y", "duration_y"]
    both = spark.createDataFrame([(1, "a", 1.0)], ["id", "text", "duration"])
    assert J.inner_join(l, both, None).count() == 1


def test_first_overlapping_vs_bruteforce(spark):
    rnd = random.Random(5)
    left = [(s, i, rnd.uniform(0, 200), rnd.uniform(0.5, 20)) for s in range(3) for i in range(40)]
    right = [(s, i, rnd.uniform(0, 200), rnd.uniform(0.5, 20), i) for s in range(3) for i in range(40)]
    L = spark.createDataFrame(left, "sess int, id int, st double, du double")
    R = spark.createDataFrame(right, f"sess int, rid int, st double, du double, {SEQ} int")
    got = {(r.sess, r.id): r.r_rid for r in
           J.first_overlapping(L, R, "sess", "st", "du", ["sess", "id"], ["sess", SEQ], bucket_width=7.0, right_order=[SEQ]).collect()}
    for s, i, st, du in left:
        best = None
        for s2, rid, st2, du2, seq in right:
            if s2 != s:
                continue
            ov = min(st + du, st2 + du2) - max(st, st2)
            if ov > 0 and ov / min(du, du2) > 0.5 and (best is None or seq < best[0]):
                best = (seq, rid)
        assert got[(s, i)] == (best[1] if best else None)


@pytest.mark.parametrize("starts,duration,cuts", [
    ([], 15.0, [0]),                                  # everything fits into one piece
    ([0.0, 8.0, 16.0, 24.0], 30.0, [0, 16, 24]),      # 24 is too far: cut at 16 and at 24
    ([0.0], 50.0, [0, 20, 40, 50]),                   # one long stretch: every 20 s from its start
    ([0.0, 10.0], 15.0, [0]),
    ([0.0, 30.0], 35.0, [0, 20, 30]),                 # cut at 0 again, then inside the stretch, then at its end
])
def test_rttm_cut_points_by_hand(spark, starts, duration, cuts):
    df = spark.createDataFrame([(starts, duration)], "s array<double>, d double")
    assert df.select(W.rttm_cut_points(F.col("s"), F.col("d"), 20.0).alias("c")).first().c == cuts


def _captions(spark, fn, rows):
    df = spark.createDataFrame([(rows,)], "s array<struct<start_time:double,end_time:double,text:string>>")
    return df.select(fn(F.col("s")).alias("m")).first().m


def test_caption_merge_by_hand(spark):
    rows = [(0.0, 4.0, "a"), (4.0, 8.0, "b"), (8.0, 13.0, "c"), (13.0, 14.0, "d"), (12.0, 15.0, "e")]
    got = _captions(spark, lambda s: W.aggregate_caption_segments(s, 12.0), rows)
    # c would make it 13 s long, so a new group starts there; e begins before its group's latest caption
    assert [(x.start_time, x.end_time, x.text) for x in got] == [(0.0, 8.0, "ab"), (8.0, 15.0, "cde")]
    one = _captions(spark, lambda s: W.aggregate_caption_segments(s, 12.0), [(1.0, 2.0, "only")])
    assert [(x.start_time, x.end_time, x.text) for x in one] == [(1.0, 2.0, "only")]


@pytest.mark.parametrize("parts", [1, 3, 16])
def test_ordered_scans_partition_invariant(spark, parts):
    rnd = random.Random(parts)
    rows = [(rnd.choice([1, 1, 1, 2, 3]), i, float(rnd.randint(0, 9))) for i in range(300)]
    df = spark.createDataFrame(rows, "s int, o int, v double").repartition(parts)
    pdf = pd.DataFrame(rows, columns=["s", "o", "v"]).sort_values(["s", "o"])
    idx = {(r.s, r.o): r.i for r in with_global_index(df, ["s", "o"], "i", num_partitions=parts).collect()}
    assert [idx[(a, b)] for a, b in zip(pdf.s, pdf.o)] == list(range(len(pdf)))
    cum = {(r.s, r.o): r.c for r in with_prefix_sum(df, ["s", "o"], "v", "c", segment=["s"],
                                                    num_partitions=parts).collect()}
    exp = pdf.groupby("s")["v"].cumsum()
    assert [cum[(a, b)] for a, b in zip(pdf.s, pdf.o)] == list(exp)
    prev = {(r.s, r.o): r.p for r in with_previous(df, ["s", "o"], "v", "p", segment=["s"],
                                                   num_partitions=parts).collect()}
    expp = pdf.groupby("s")["v"].shift(1)
    assert [prev[(a, b)] for a, b in zip(pdf.s, pdf.o)] == [None if pd.isna(x) else x for x in expp]


def test_speaker_runs(spark):
    rows = [(1, 0, "a"), (1, 1, "a"), (1, 2, "b"), (1, 3, "a"), (2, 0, "b"), (2, 1, None), (2, 2, None)]
    df = spark.createDataFrame(rows, "s int, t int, spk string")
    got = sorted((r.s, r.t, r.run_id) for r in W.speaker_runs(df, "s", ["t"], "spk").collect())
    assert [g[2] for g in got] == [1, 1, 2, 3, 1, 2, 2]


def test_shard_contiguous_and_buckets(spark):
    df = spark.createDataFrame([(i,) for i in range(103)], "k int").withColumn(SEQ, F.col("k"))
    out = SH.shard_contiguous(df, 10, shuffle=True).collect()
    assert len(out) == 100
    sizes = pd.Series([r.shard_id for r in out]).value_counts()
    assert set(sizes) == {10}
    b = spark.createDataFrame([(1.0,), (50.0,), (49.9,), (0.5,), (50.1,)], "d double") \
        .select(SH.duration_bucket(F.col("d"), 1.0, 50.0, 4).alias("b")).collect()
    assert [r.b for r in b] == [0, 3, 3, None, None]


def test_bootstrap_interval_covers_mean(spark):
    from corpusflow.operators.aggs import bootstrap_ci
    rnd = random.Random(4)
    rows = [(i, rnd.gauss(10, 2), rnd.gauss(11, 2)) for i in range(2000)]
    df = spark.createDataFrame(rows, f"{SEQ} int, a double, b double")
    res = {(r.system, r.versus): r for r in bootstrap_ci(df, ["a", "b"], num_bootstraps=300).collect()}
    ma = sum(x[1] for x in rows) / len(rows)
    a = res[("a", None)]
    assert a.ci_lower < ma < a.ci_upper
    d = res[("a", "b")]
    assert d.ci_upper < 0 and d.poi < 0.05


def test_sample_fraction_exact_size(spark):
    df = spark.createDataFrame([(i,) for i in range(1000)], "k int").withColumn(SEQ, F.col("k"))
    s1 = {r.k for r in SH.sample_fraction(df.repartition(3), 0.1).collect()}
    s2 = {r.k for r in SH.sample_fraction(df.repartition(11), 0.1).collect()}
    assert len(s1) == 100 and s1 == s2


def test_list_to_entries(spark):
    from corpusflow.operators.arrays import list_to_entries
    df = spark.createDataFrame([("a.wav", 5.0, [(0.0, 1.0, "x"), (1.0, 2.0, "y")])],
                               "audio_filepath string, duration double, "
                               "segments array<struct<start:double,end:double,text:string>>")
    out = list_to_entries(df, "segments").collect()
    assert [(r.audio_filepath, r.text) for r in out] == [("a.wav", "x"), ("a.wav", "y")]
    df2 = spark.createDataFrame([("a", ["p", "q"])], "audio_filepath string, text_chunks array<string>")
    assert [r.text for r in list_to_entries(df2, "text_chunks", "text").collect()] == ["p", "q"]


def test_vtt_sentences_by_hand(spark):
    rows = [(0.5, 2.0, "one"), (2.0, 3.0, "two."), (3.0, 9.0, "three"), (9.0, 14.0, "four"), (14.0, 15.0, "five")]
    got = _captions(spark, lambda s: W.sentences_from_captions(s, 10.0, 16000), rows)
    # a full stop ends the first; 3 s to 14 s is over ten seconds; the rest is emitted at the end
    assert [(x.text, x.start, x.end) for x in got] == [("one two.", 8000, 48000), ("three four", 48000, 224000), ("five", 224000, 240000)]
    assert _captions(spark, lambda s: W.sentences_from_captions(s, 10.0, 16000), []) == []


def test_bleeding_match_rule(spark):
    """The overlap is a share of the microphone's duration, and the first segment
    by offset counts: the short one at 1 s covers only a fifth."""
    left = spark.createDataFrame([("s", 1, 0.0, 10.0)], "sess string, id int, st double, du double")
    right = spark.createDataFrame([("s", 0, 1.0, 2.0), ("s", 1, 0.0, 9.0), ("s", 2, 0.5, 9.0)], "sess string, rid int, st double, du double")
    got = J.first_overlapping(left, right, "sess", "st", "du", ["id"], ["rid"], tolerance=0.5, share_of="left", right_order=["st"])
    assert got.first().r_rid == 1


def test_lookup_and_reuse_with_duplicate_keys(spark):
    df = spark.createDataFrame([(1,), (2,), (3,)], "k int")
    meta = spark.createDataFrame([(1, 1, "a"), (1, 3, "c"), (1, 2, "b"), (2, 1, "x")], "k int, o int, v string").repartition(4)
    got = {r.k: r.v2 for r in J.metadata_lookup(df, meta, ["k"], "v", "v2", F.lit("none"), order=["o"]).collect()}
    assert got == {1: "c", 2: "x", 3: "none"}
    cache = meta.withColumn("ok", F.col("o") < 3)
    reused, todo = J.split_reuse(df, cache, ["k"], ["v"], order=["o"])
    assert {(r.k, r.v) for r in reused.collect()} == {(1, "b"), (2, "x")} and [r.k for r in todo.collect()] == [3]


def test_sentence_ends_by_hand(spark):
    text = "stop! then go. Approx. Main ave. Street 1,000. He 12.5. Next x? lower etc. and end".split()
    df = spark.createDataFrame([(1, i, w, float(i), float(i) + 0.5) for i, w in enumerate(text)], "r int, o int, w string, s double, e double")
    got = [r.text.split()[-1] for r in W.sentence_segments(df, "r", "o", "w", "s", "e").orderBy("sentence_id").collect()]
    assert got == ["stop!", "go.", "Approx.", "1,000.", "x?", "end"]


def test_sample_names(spark):
    df = spark.createDataFrame([(0, "/a/b.c/x.flac", 1), (0, "/a/b.c/x.flac", 2), (1, "/a/b.c/x.flac", 3), (0, "d/noext", 4)], f"shard_id int, audio_filepath string, {SEQ} int")
    got = {r[SEQ]: r.audio_filepath for r in SH.sample_names(df).collect()}
    assert got == {1: "_a_b_c_x.flac", 2: "_a_b_c_x-sub1.flac", 3: "_a_b_c_x.flac", 4: "d_noext"}
    cut = spark.createDataFrame([("/a/b.c/x.flac", 12.5, 3.0), ("y.wav", 7.0, 0.25)], "audio_filepath string, offset double, duration double").withColumn("shard_id", F.lit(0))
    rows = SH.sample_names(cut).collect()
    assert {r.audio_filepath for r in rows} == {"_a_b_c_x_12_5_3_0.flac", "y_7_0_0_25.wav"} and {r.source_audio_offset for r in rows} == {12.5, 7.0}
    whole = spark.createDataFrame([("y.wav", 7, 3)], "audio_filepath string, offset int, duration int").withColumn("shard_id", F.lit(0))
    assert SH.sample_names(whole).first().audio_filepath == "y_7_0_3_0.wav"


def test_topk_labels(spark):
    df = spark.createDataFrame([([("en", 0.2), ("de", 0.7), ("fr", 0.1)],)], "s array<struct<label:string,prob:double>>")
    one = SH.topk_labels(F.col("s"))
    assert df.select(*[c.alias(n) for n, c in one.items()]).first().asDict() == {"label": "de", "label_prob": 0.7}
    every = SH.topk_labels(F.col("s"), k=-1, n_labels=3)
    row = df.select(*[c.alias(n) for n, c in every.items()]).first().asDict()
    assert row == {"label_1": "de", "label_prob_1": 0.7, "label_2": "en", "label_prob_2": 0.2, "label_3": "fr", "label_prob_3": 0.1}


def test_limits_take_the_first_rows(spark):
    df = spark.createDataFrame([(i,) for i in range(50)], "k int").withColumn(SEQ, F.col("k")).repartition(5)
    assert sorted(r.k for r in SH.limit_entries(df, 7).collect()) == list(range(7))
    assert SH.limit_entries(df, 0).count() == 50 and SH.percent_limit(df, 1).count() == 1
    plan = SH.shard_equal_chunks(df, 4, shuffle=False)._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan.split("Scan ExistingRDD")[0] or "hashpartitioning(_pid" not in plan


def test_trigram_lid_against_plain_counts(spark, monkeypatch):
    """Repeated and missing keys, missing texts and labels, characters beyond the first plane, texts in pieces;
    the counted trigrams of the texts meet the profile without being dealt by trigram."""
    from collections import Counter
    from math import sqrt

    from corpusflow.operators import scoring as S
    rows = [(1, "The cat sat", "en"), (1, "on the mat the", "en"), (2, "die Katze saß 𝒳𝒴𝒵 auf", "de"), (3, None, "en"), (4, "", "de"),
            (5, "le chat", None), (None, "the dog", "en"), (6, None, "en"), (6, "le chat était là", "fr"), (7, "猫猫猫猫", "zh")] + [(8, "abab" * 50, "en")]
    df = spark.createDataFrame(rows, "k long, text string, lang string").repartition(3)

    def grams(t):
        return Counter([None] if t is None else [("  " + t.lower() + "  ")[i:i + 3] for i in range(len(t) + 2)])

    profile, texts = {}, {}
    for k, t, g in rows:
        if g is not None:
            profile.setdefault(g, Counter()).update(grams(t))
        if k is not None:
            texts.setdefault(k, Counter()).update(grams(t))
    norm = {g: sqrt(sum(n * n for n in c.values())) for g, c in profile.items()}
    want = {}
    for k, c in texts.items():
        size = sqrt(sum(n * n for n in c.values()))
        dots = {g: sum(n * p[x] for x, n in c.items() if x is not None) / norm[g] / size for g, p in profile.items()}
        best = max((d, g) for g, d in dots.items())
        want[k] = (best[1], round(best[0], 9)) if best[0] else (None, None)
    for bound, piece in ((S.BROADCAST_ROWS, S.PIECE), (0, 7)):
        monkeypatch.setattr(S, "BROADCAST_ROWS", bound)
        monkeypatch.setattr(S, "PIECE", piece)
        out = S.score_trigram_lid(df, S.train_trigram_lid(df), "k")
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert ("hashpartitioning(tri" in plan) == (bound == 0)
        got = [(r.k, r.label, r.label_prob and round(r.label_prob, 9)) for r in out.collect()]
        assert len(got) == len(rows) and all((a, b) == want.get(k, (None, None)) for k, a, b in got)
    sent = S._count_by_label(df.unionByName(df).coalesce(1), "text", "lang")
    assert {(r.lang, r.n) for r in sent.filter("tri IS NULL").collect()} == {("en", 4)}


def test_sentences_of_large_and_small_recordings(spark, monkeypatch):
    """Words reach their sentence in one pass over whole recordings; a large recording is cut into ranges, with
    the same sentences; words without a recording are left out, a null order comes first."""
    r = random.Random(5)
    words = ["one", "Two", "three.", "Four!", "etc.", "12.", None, "six?"]
    rows = [(k, None if i == 0 else i, r.choice(words), i * 0.5, i * 0.5 + 0.375) for k, n in ((1, 60), (2, 9), (3, 1), (None, 5)) for i in range(n)]
    r.shuffle(rows)
    df = spark.createDataFrame(rows, "r int, o int, w string, s double, e double").repartition(5)
    want = {}
    for k in (1, 2, 3):
        mine, sent = sorted((x for x in rows if x[0] == k), key=lambda x: x[3]), 0
        for x, y in zip(mine, mine[1:] + [None]):
            want.setdefault((k, sent), []).append(x)
            w, nxt = x[2], y and y[2]
            sent += bool(w) and (w[-1] in "!?" or w == "three." and (not nxt or nxt[0].isupper()))
    want = {(k, n): (" ".join(x[2] for x in xs if x[2] is not None), xs[0][3], xs[-1][4]) for (k, n), xs in want.items()}
    for large in (1 << 20, 20, 1):
        monkeypatch.setattr(W, "LARGE", large)
        monkeypatch.setattr(W, "TASK", 16)
        out = W.sentence_segments(df, "r", "o", "w", "s", "e")
        if large == 1 << 20:
            plan = out._jdf.queryExecution().executedPlan().toString()
            assert plan.count("Exchange") == 1 and "Join" not in plan
        assert {(x.r, x.sentence_id): (x.text, x.start, x.end) for x in out.collect()} == want
