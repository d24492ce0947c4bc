"""Greedy passes by pointers: filling shards by size, utterances for synthesis."""
import random

import pytest
from pyspark.sql import functions as F

from corpusflow.operators import greedy, tts


def plain_fill(sizes, limit):
    out, shard, held, used = [], 0, 0, 0
    for s in sizes:
        if used and held + s > limit:
            shard, held, used = shard + 1, 0, 0
        held, used = held + s, used + 1
        out.append(shard)
    return out


@pytest.mark.parametrize("limit,top", [(100, 30), (100, 250), (7, 3), (10**6, 50), (0, 2)])
def test_fill_by_size(spark, limit, top):
    rng = random.Random(limit + top)
    sizes = [rng.choice([0, rng.randint(0, top), rng.randint(0, top) / 4]) for _ in range(400)]
    df = spark.createDataFrame([(i, float(s), "x") for i, s in enumerate(sizes)], "k long, size double, shard_id string").repartition(5)
    got = {r["k"]: r["shard_id"] for r in greedy.shard_by_size(df, limit, "size", ["k"]).collect()}
    assert [got[i] for i in range(len(sizes))] == plain_fill(sizes, limit)


def test_fill_null_negative_empty(spark):
    df = spark.createDataFrame([(1, None), (2, 5.0), (3, None), (4, 6.0)], "k long, size double")
    assert sorted((r["k"], r["shard_id"]) for r in greedy.shard_by_size(df, 10, "size", ["k"]).collect()) == [(1, 0), (2, 0), (3, 0), (4, 1)]
    assert greedy.shard_by_size(df.limit(0), 10, "size", ["k"]).count() == 0
    with pytest.raises(Exception, match="negative size"):
        greedy.shard_by_size(df.withColumn("size", -F.col("size")), 10, "size", ["k"]).collect()


def test_reached(spark):
    step = {i: i + 1 + i % 7 for i in range(300)}
    pairs = spark.createDataFrame([(i, j) for i, j in step.items() if j < 300], "i long, j long")
    want, at = [], 3
    while at < 300:
        want.append(at)
        at = step[at]
    assert sorted(r["i"] for r in greedy.reached(pairs, spark.createDataFrame([(3,)], "i long")).collect()) == want


# --- W9 ----------------------------------------------------------------------

SCHEMA = ("id long, segments array<struct<speaker:string,text:string,words:array<struct<word:string,start:double,end:double>>,"
          "metrics:struct<pesq_squim:double,stoi_squim:double,sisdr_squim:double,bandwidth:long>>>")


def segment(speaker, words, bandwidth=None, text=None):
    return {"speaker": speaker, "text": " ".join(w for w, *_ in words) if text is None else text,
            "words": [{"word": w, "start": float(s), "end": float(e)} for w, s, e in words],
            "metrics": {"pesq_squim": 1.0, "stoi_squim": 2.0, "sisdr_squim": 3.0, "bandwidth": bandwidth}}


def texts(spark, segments, **kw):
    df = spark.createDataFrame([(1, segments)], SCHEMA)
    return [(u["speaker"], u["text"]) for u in tts.tts_segments(df, **kw).first()["segments"]]


def run(words, step=1.0):
    return [(w, i * step, i * step + step) for i, w in enumerate(words.split())]


def test_short_sentences_join_and_speakers_part(spark):
    got = texts(spark, [segment("A", run("a b. c d. e f.")), segment("no-speaker", run("noise.")), segment("A", [("g.", 30, 31)]),
                        segment("B", [("h", 32, 33), ("i.", 33, 34)]), segment("B", run("dropped"), text=" ")], min_duration=3, max_duration=6)
    assert got == [("A", "a b. c d. e f."), ("A", "g."), ("B", "h i.")]


def test_next_sentence_too_far_keeps_both(spark):
    words = [("a.", 0, 1), ("b.", 30, 31), ("c.", 32, 33)]
    assert texts(spark, [segment("A", words)]) == [("A", "a."), ("A", "b."), ("A", "c.")]


def test_by_duration_pause_bandwidth(spark):
    assert texts(spark, [segment("A", run("a b c d e f g"))], min_duration=1, max_duration=3) == [("A", "a b c"), ("A", "d e f"), ("A", "g")]
    words = [("a", 0, 4), ("b", 4, 6), ("c", 9, 10), ("d", 10, 11)]
    assert texts(spark, [segment("A", words)]) == [("A", "a b"), ("A", "c d")]
    assert texts(spark, [segment("A", words)], min_duration=8) == [("A", "a b c d")]
    two = [segment("A", run("a b c d e f"), 8000), segment("A", [("g", 6, 7)], 16000)]
    assert texts(spark, two) == [("A", "a b c d e f"), ("A", "g")]
    assert texts(spark, two, punctuation_split_only=True) == []


def test_long_word_and_null(spark):
    assert texts(spark, [segment("A", [("looong", 0, 25), ("a", 25, 26)])]) == [("A", "a")]
    df = spark.createDataFrame([(1, None), (2, [])], SCHEMA)
    assert [r["segments"] for r in tts.tts_segments(df).orderBy("id").collect()] == [None, []]
    u = tts.tts_segments(spark.createDataFrame([(1, [segment("A", run("a b."), 8)])], SCHEMA)).first()["segments"][0]
    assert (u["start"], u["end"], u["bandwidth"], u["words"][1]["word"], u["pesq_squim"]) == (0.0, 2.0, [8, 8], "b.", [1.0, 1.0])
    with pytest.raises(ValueError):
        tts.tts_segments(df, min_duration=30)


def test_recordings_of_documents(spark, tmp_path):
    """Words are numbered on over the lines, also of rows with one identifier; texts without words are left out;
    the utterances are made once, not a second time to see whether there are any."""
    from corpusflow.plans import queries_restore as Q
    rows = [(1, "a bb.\n \nccc d!"), (1, "x\ny"), (2, None), (3, " \n\t"), (None, "q"), (4, "\n" * 9 + "late word")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: [(g.speaker, g.text, [(w.word, w.start) for w in g.words], g.metrics.bandwidth) for g in r.segments]
           for r in Q._recordings(spark, str(tmp_path)).collect()}
    assert got == {
        1: [("S0", "a bb.", [("a", 0.0), ("bb.", 0.5)], 16000), ("S0", "x", [("x", 1.0)], 16000),
            ("S0", "y", [("y", 4.5)], 16000), ("S1", "ccc d!", [("ccc", 8.0), ("d!", 8.5)], 16000)],
        None: [("S0", "q", [("q", 0.0)], 16000)],
        4: [("S0", "late word", [("late", 27.0), ("word", 27.5)], 8000)]}
    out = Q.q_tts_segments(spark, str(tmp_path))
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert not [line for line in plan.split("\n") if "Filter" in line and "transform(" in line]
    assert "aggregate(slice(" not in plan                # no line counts all words before it
    assert sorted((r.doc_id or 0, r.text) for r in out.collect()) == [(0, "q"), (1, "a bb."), (1, "ccc d!"), (1, "x y"), (4, "late word")]


# --- D6 ----------------------------------------------------------------------

def test_append_shards(spark):
    from corpusflow.operators import shards

    base = spark.createDataFrame([(i, i // 4) for i in range(8)], "k long, shard_id int")
    new = spark.createDataFrame([(100 + i,) for i in range(10)], "k long")
    got = shards.append_shards(base, new, 2, shuffle=False, key="k").orderBy("k").collect()
    assert [(r["k"], r["shard_id"]) for r in got if r["k"] >= 100] == [(100 + i, 2 + i // 4) for i in range(8)]
    with pytest.raises(ValueError, match="no full shard"):
        shards.append_shards(base.limit(0), new, 2, key="k")
    assert shards.append_shards(base.limit(0), new.limit(0), 2, key="k").count() == 0
