"""Sources, sinks and the streaming path on small files written to a fresh
temporary folder."""
import io
import json
import os
import tempfile
import wave

from pyspark.sql import functions as F

from corpusflow.sinks import writers
from corpusflow.sources import formats as S
from corpusflow.sources.manifest import combine_manifests, read_manifest, read_text_lines
from corpusflow.streaming.manifests import read_manifest_stream, run_stateless
from corpusflow.operators import filters as FL


def _dir():
    return tempfile.mkdtemp(prefix="corpusflow-io-")


def _write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as f:
        f.write(text)


def test_manifest_roundtrip_and_missing(spark):
    d = _dir()
    _write(f"{d}/m.json", "\n".join(json.dumps({"audio_filepath": f"a{i}.wav", "duration": i * 1.0, "text": t})
                                      for i, t in enumerate(["x", "y", "x"])) + "\n")
    m = read_manifest(spark, f"{d}/m.json", "audio_filepath string, duration double, text string")
    assert [r.audio_filepath for r in FL.drop_duplicates(m, "text").orderBy("_seq").collect()] == ["a0.wav", "a1.wav"]
    assert read_manifest(spark, f"{d}/none.json", "a string").count() == 0
    res = writers.write_manifest(m, f"{d}/out")
    assert res["num_entries"] == 3 and abs(res["total_hours"] - 3 / 3600) < 1e-12
    both = combine_manifests([m, m.drop("text")])
    assert both.count() == 6 and both.filter(F.col("text").isNull()).count() == 3


def test_text_lines_and_tsv(spark):
    d = _dir()
    _write(f"{d}/a.txt", "one\n\n  two  \n")
    _write(f"{d}/t.tsv", "path\tsentence\nfirst.mp3\thello\nsecond.mp3\tworld\n")
    m = spark.createDataFrame([(f"{d}/a.txt", 1)], "src string, _seq int")
    assert sorted(r.text for r in read_text_lines(spark, m, "src", "text").collect()) == ["one", "two"]
    t = S.read_tsv(spark, f"{d}/t.tsv", "path string, sentence string")
    assert [r.path for r in t.orderBy("_seq").collect()] == ["first.mp3", "second.mp3"]
    t2 = S.read_tsv(spark, f"{d}/t.tsv", "path string, sentence string", skip_first=True)
    assert [r.path for r in t2.collect()] == ["second.mp3"]


def test_ctm_vtt_trans(spark):
    d = _dir()
    _write(f"{d}/x.ctm", "utt1 1 0.10 0.25 hello\nutt1 1 0.40 0.2 world\nbad line\n")
    _write(f"{d}/c.vtt", "WEBVTT\n\n1\n00:00:01.000 --> 00:00:02.500\nhello\nthere\n\n2\n"
                         "25:00:00.000 --> 25:00:01.000\nlate\n")
    _write(f"{d}/tree/1/2/1-2.trans.txt", "1-2-0001 HELLO WORLD\n1-2-0002 AGAIN\n")
    ctm = S.read_ctm(spark, f"{d}/x.ctm").orderBy("_seq").collect()
    assert [(r.word, r.start, r.end) for r in ctm] == [("hello", 0.1, 0.35), ("world", 0.4, 0.6)]
    segs = S.read_vtt(spark, f"{d}/c.vtt").first().segments
    assert [(s.segment_id, s.start_time, s.end_time, s.text) for s in segs] == \
        [(0, 1.0, 2.5, "hello there"), (1, 90000.0, 90001.0, "late")]
    tr = S.read_trans_tree(spark, f"{d}/tree").orderBy("_seq").collect()
    assert [(r.utt_id, r.text) for r in tr] == [("1-2-0001", "HELLO WORLD"), ("1-2-0002", "AGAIN")]


def test_wav_probe(spark):
    d = _dir()
    os.makedirs(f"{d}/wav")
    for name, frames in [("a", 16000), ("b", 8000)]:
        with wave.open(f"{d}/wav/{name}.wav", "wb") as w:
            w.setnchannels(1)
            w.setsampwidth(2)
            w.setframerate(16000)
            w.writeframes(b"\x00\x00" * frames)
    _write(f"{d}/wav/broken.wav", "not a wav")
    got = {os.path.basename(r.audio_filepath): r.duration for r in S.audio_durations(spark, f"{d}/wav").collect()}
    assert got == {"a.wav": 1.0, "b.wav": 0.5, "broken.wav": -1.0}


def test_streaming_stateless(spark):
    d = _dir()
    _write(f"{d}/in/part1.json", "\n".join(json.dumps({"text": t, "duration": 1.0})
                                          for t in ["ok text", "has 123 digits", "fine"]) + "\n")
    stream = read_manifest_stream(spark, f"{d}/in", "text string, duration double")
    q = run_stateless(stream, [lambda df: FL.drop_if_regex_match(df, [r"[0-9]"])], f"{d}/out", f"{d}/ckpt")
    q.awaitTermination(120)
    out = spark.read.json(f"{d}/out")
    assert sorted(r.text for r in out.collect()) == ["fine", "ok text"]


def test_text_lines_by_folder(spark):
    d = _dir()
    _write(f"{d}/t/a.txt", "one\n\n two \n")
    _write(f"{d}/t/b.txt", "three\n")
    m = spark.createDataFrame([(f"{d}/t/a.txt", 1)], "source_file string, n int")
    got = read_text_lines(spark, m, "source_file", "text", root=f"{d}/t", glob="*.txt").collect()
    assert sorted((r.text, r.n) for r in got) == [("one", 1), ("two", 1)]
