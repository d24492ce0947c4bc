"""Path, cut and transcript sources, and the folds over segments, on hand-made cases."""
import gzip
import json
import os

import pytest
from pyspark.sql import functions as F

from corpusflow.functions.arabic import clean_arabic
from corpusflow.operators import folds as W
from corpusflow.sources import cuts, paths


def _files(spark, names):
    return spark.createDataFrame([(n,) for n in names], "audio_filepath string").repartition(3)


def test_nine_part_paths(spark):
    f = _files(spark, ["/d/ej/au/dev2/2024/1/02/03/s1/mic.wav", "/d/ej/au/dev1/2024/01/02/03/s2/spk.wav", "/d/ej/au/dev1/2024/01/02/03/s2/mic.wav",
                       "/d/ej/au/dev1/2024/01/02/s2/mic.wav", "/d/ej/au/dev1/2024/01/02/03/s2/other.wav", "/x/ej/au/dev1/2024/01/02/03/s2/mic.wav"])
    got = [(r.device_id, r.channel, r.timestamp, r.session_id, r.relative_path) for r in paths.nine_part_manifest(f, "/d/", preserve_structure=True).collect()]
    assert got == [("dev1", "mic", "2024-01-02T03:00:00", "s2", "ej/au/dev1/2024/01/02/03/s2/mic.wav"),
                   ("dev1", "spk", "2024-01-02T03:00:00", "s2", "ej/au/dev1/2024/01/02/03/s2/spk.wav"),
                   ("dev2", "mic", "2024-1-02T03:00:00", "s1", "ej/au/dev2/2024/1/02/03/s1/mic.wav")]
    assert paths.nine_part_manifest(f, "/d", "spk").count() == 1
    assert paths.nine_part_manifest(f, "/d", preserve_structure=True).first().hierarchy == "ej/au/dev1/2024/01/02/03/s2"


def test_country_folder_paths(spark):
    f = _files(spark, ["/d/b/au/dev/2024/1/2/3/s9/mic.wav", "/d/b/au/dev/2024/1/2/3/s9/spk.wav", "/d/b/au/dev/2024/1/2/3/mic.wav", "/d/c/au/dev/2024/1/2/3/s/mic.wav",
                       "/d/b/au/adev/2024/1/2/3/s8/deeper/mic.wav"])
    got = [(r.device_id, r.session_id, r.timestamp, r.audio_type, r.dataset_tag) for r in paths.country_folder_manifest(f, "b", "au", "Brand", "Land", raw_data_dir="/d").collect()]
    assert got == [("adev", "s8", "2024-1-2T3:00:00", "customer", "Brand Land"), ("dev", "s9", "2024-1-2T3:00:00", "customer", "Brand Land")]
    assert paths.country_folder_manifest(f, "b", "au", "B", "L", "spk", "/d").first().audio_type == "employee"
    with pytest.raises(ValueError):
        paths.country_folder_manifest(f, "b", "au", "B", "L", "both")


def test_anchored_paths(spark):
    f = _files(spark, ["/r/my-box-1/dev/2024/1/2/3/a.b.wav", "/r/my-box-1/dev/2024/11/12/13/z.wav", "/r/my-box-1/dev/2024/1/2/a.wav", "/r/none/dev/2024/1/2/3/a.wav", "/r/my-box-1/dev/2024/1/2/3/a.txt"])
    got = [(r.device_id, r.session_id, r.timestamp) for r in paths.anchored_manifest(f, "box", "B", "L").collect()]
    assert got == [("dev", "z", "2024-11-12T13:00:00"), ("dev", "a.b", "2024-01-02T03:00:00")] or \
        got == [("dev", "a.b", "2024-01-02T03:00:00"), ("dev", "z", "2024-11-12T13:00:00")]


def _cut(i, **change):
    c = {"id": f"c{i}", "duration": 1.0, "type": "MonoCut",
         "recording": {"sources": [{"type": "file", "source": f"/a/{i}.wav", "channels": [0]}]},
         "supervisions": [{"text": f"t{i}", "speaker": "s", "custom": {"emotion": "calm"}}]}
    return c | change


def test_cut_manifest(spark, tmp_path):
    with gzip.open(f"{tmp_path}/cuts.jsonl.gz", "wt") as f:
        for c in (_cut(1), _cut(2, supervisions=[{"text": "x", "language": "de", "custom": {"text": "override"}}])):
            f.write(json.dumps(c) + "\n")
    rows = {r.cut_id: r for r in cuts.read_cuts(spark, f"{tmp_path}/cuts.jsonl.gz", "emotion: string, text: string").collect()}
    assert (rows["c1"].audio_filepath, rows["c1"].text, rows["c1"].speaker, rows["c1"].emotion, rows["c1"].duration) == ("/a/1.wav", "t1", "s", "calm", 1.0)
    assert (rows["c2"].text, rows["c2"].language, rows["c2"].gender, rows["c2"].emotion) == ("override", "de", None, None)
    assert "emotion" not in cuts.read_cuts(spark, f"{tmp_path}/cuts.jsonl.gz").columns


@pytest.mark.parametrize("change", [{"type": "MultiCut"}, {"recording": None}, {"supervisions": []},
                                    {"recording": {"sources": [{"type": "url", "source": "u", "channels": [0]}]}},
                                    {"recording": {"sources": [{"type": "file", "source": "u", "channels": [0, 1]}]}}])
def test_cut_manifest_checks(spark, tmp_path, change):
    with open(f"{tmp_path}/cuts.jsonl", "w") as f:
        f.write(json.dumps(_cut(1)) + "\n" + json.dumps(_cut(2, **change)) + "\n")
    with pytest.raises(Exception, match="only|no recording"):
        cuts.read_cuts(spark, f"{tmp_path}/cuts.jsonl").collect()


def test_transcripts_with_speakers(spark, tmp_path):
    os.makedirs(f"{tmp_path}/t")
    lines = [(1, "DC1_a", 0.0, "hello", 4.0), (2, "DC1_a", 4.0, "(pause 1.5)", 5.0), (3, "DC1_a", 5.0, "again", 9.0), (4, "int", 9.0, "and you", 12.0), (5, "DC1_a", 12.0, "fine", 13.0)]
    with open(f"{tmp_path}/t/DC1_a_1.txt", "w") as f:
        f.write("Line\tSpkr\tStTime\tContent\tEnTime\n" + "".join("\t".join(map(str, x)) + "\n" for x in lines))
    with open(f"{tmp_path}/meta.txt", "w") as f:
        f.write("CORAAL.Spkr\tGender\tAge\tEducation\tOccupation\tTar\n" + "DC1_a\tF\t30\tBA\tx\t1\n" + "DC1_a\tF\t30\tBA\tx\t2\n")
    got = sorted((r.offset, r.duration, r.text, r.speaker, r.is_interviewee, r.gender) for r in cuts.read_transcripts_with_speakers(spark, f"{tmp_path}/t", f"{tmp_path}/meta.txt").collect())
    assert got == [(0.0, 9.0, "hello again", "DC1_a", True, "F"), (9.0, 3.0, "and you", "int", False, None), (12.0, 1.0, "fine", "DC1_a", True, "F")]
    assert cuts.read_transcripts_with_speakers(spark, f"{tmp_path}/t", f"{tmp_path}/meta.txt", False, 0).count() == 5


SEGS = "array<struct<start:double,end:double>>"


def test_split_long(spark):
    df = spark.createDataFrame([("/a/x.wav", 25.0, [(0.0, 4.0), (5.0, 9.0), (10.0, 14.0), (15.0, 24.0)]), ("/a/s.wav", 5.0, [(0.0, 5.0)])],
                               f"audio_filepath string, duration double, segments {SEGS}")
    out = {r.audio_filepath: r for r in W.split_long(df, max_len=10.0, min_len=1.0, sample_rate=100).collect()}
    # 14 is over ten seconds from 0: cut at 9; 24 is over ten seconds from 9: cut at 14; the rest is 14 to 25
    assert out["/a/x.wav"].split_filepaths == ["/a/x.1_of_3.wav", "/a/x.2_of_3.wav", "/a/x.3_of_3.wav"]
    assert out["/a/x.wav"].split_offsets == [0.0, 9.0, 14.0]
    assert [(out[f"/a/x.{k}_of_3.wav"].offset, out[f"/a/x.{k}_of_3.wav"].duration) for k in (1, 2, 3)] == [(0.0, 9.0), (9.0, 5.0), (14.0, 10.99)]
    assert out["/a/s.wav"].split_filepaths is None and len(out) == 5


def test_split_long_short_parts(spark):
    df = spark.createDataFrame([("x.wav", 40.0, [(0.0, 0.5), (1.0, 12.0), (13.0, 39.5)])], f"audio_filepath string, duration double, segments {SEGS}")
    out = W.split_long(df, max_len=10.0, min_len=1.0, sample_rate=100).collect()
    # the cut at 0.5 is too short and joins the next part; what is left after 12 s is over the limit
    assert [(r.audio_filepath, r.offset, r.duration) for r in out if r.offset is not None] == [("x.2_of_3.wav", 0.0, 12.0)]


def test_words_into_segments(spark):
    words = [("a", 0.0, 1.0), ("b", 1.5, 2.4), ("c", 1.9, 3.2), ("d", 4.1, 4.4), ("e", 4.8, 5.6), ("f", 9.0, 9.5)]
    df = spark.createDataFrame([(words, [(0.0, 2.0), (2.0, 4.0), (5.0, 6.0)]), ([], [(0.0, 1.0)])], f"al array<struct<word:string,start:double,end:double>>, segs {SEGS}")
    one, none = [r.s for r in df.select(W.words_into_segments(F.col("al"), F.col("segs")).alias("s")).collect()]
    # b: half a second in the first segment, 0.4 in the next; c fits better into the second; d is between; e sticks out to the left of the third
    assert [x.text for x in one] == ["a b", "c", "e"] and [w.word for w in one[0].words] == ["a", "b"]
    assert none[0].text is None and none[0].words is None


def test_arabic(spark):
    def one(text, **kw):
        return spark.createDataFrame([(text,)], "t string").select(clean_arabic(F.col("t"), **kw).alias("x")).first().x

    assert one("a   b\n\n\nc\n") == "a b\nc" and one("\n a", remove_extra_spaces=False) == " a"
    assert one("كِتَابٌ؟", remove_diacritics=True, remove_punctuation=True) == "كتاب"
    assert one("كـــتاب", remove_tatweel=True) == "كتاب" and one("ﻻ", normalize_ligature=True) == "لا"
    assert one("أإآةﻷ", normalize=True) == "اااهلا" and one("ﻛﺘﺎﺏ", apply_nfkc=True) == "كتاب"


def test_video_manifest(spark):
    from corpusflow.sources import corpora as C

    videos = spark.createDataFrame([("a", "x"), ("b", "y"), ("c", "z")], "video_id string, category string")
    wavs = _files(spark, ["/w/a.wav", "/w/b.wav"])
    vtts = _files(spark, ["/v/a.ar.vtt", "/v/c.ar.vtt"])
    got = C.video_manifest(videos, wavs, vtts, "/w/", "/v", "ar").collect()
    assert [(r.sample_id, r.category, r.audio_filepath, r.vtt_filepath) for r in got] == [("a", "x", "/w/a.wav", "/v/a.ar.vtt")]
    assert C.split_name("dev") == "clean_dev" and C.split_name("noisy_test") == "noisy_test"
    with pytest.raises(ValueError):
        C.split_name("other")


def test_paired_captions(spark, tmp_path):
    from corpusflow.sources import corpora as C

    os.makedirs(f"{tmp_path}/wav")
    for n in ("t1.flac", "t2.x.flac"):
        with open(f"{tmp_path}/wav/{n}", "w") as f:
            f.write("x")
    got = sorted((r.audio_filepath, r.vtt_filepath) for r in C.paired_captions(spark, str(tmp_path), "es", "flac").collect())
    assert got == [(f"{tmp_path}/wav/t1.flac", f"{tmp_path}/vtt/t1.es.vtt"), (f"{tmp_path}/wav/t2.x.flac", f"{tmp_path}/vtt/t2.es.vtt")]


def test_chapters(spark):
    from corpusflow.sources import corpora as C

    df = spark.createDataFrame([("u1", [("a", 1.0), ("b", 2.0)], None), ("u2", [("c", 3.0)], "404")],
                               "url string, utterances array<struct<audio_filepath:string,duration:double>>, error string")
    ok, failed = C.chapter_utterances(df)
    assert sorted((r.url, r.audio_filepath, r.duration) for r in ok.collect()) == [("u1", "a", 1.0), ("u1", "b", 2.0)]
    assert [r.url for r in failed.collect()] == ["u2"]


def test_tdf(spark, tmp_path):
    from corpusflow.sources import corpora as C

    def line(start, end, text, *more):
        return "\t".join(["f1.sph", "1", start, end, "sp", "native", "d", text, "2", "3", "4", *more])

    with open(f"{tmp_path}/f1.tdf", "w") as f:
        f.write("\n".join(["head", ";;", ";;", line("0.0", "1.5", "hola"), line("1.5", "1.6", "no"), line("2", "3", ""), line("3", "4", "si", "x", "y")]) + "\n")
    got = [(r.audio_filepath, r.text, r.duration, r.other_info) for r in C.read_tdf(spark, str(tmp_path), "/out").orderBy("start").collect()]
    assert got == [("/out/f1_line0_channel1_2_3_4.wav", "hola", 1.5, ""), ("/out/f1_line3_channel1_2_3_4.wav", "si", 1.0, "x,y")]


def test_extension_points(spark):
    from corpusflow.operators import extend as X
    from corpusflow.operators import filters as FL

    df = spark.createDataFrame([("a b",), ("",), ("c",)], "text string")
    out = X.map_rows(df, lambda r: ({"word": w, "n": len(r["text"])} for w in r["text"].split()), "word string, n long")
    assert sorted((r.word, r.n) for r in out.collect()) == [("a", 3), ("b", 3), ("c", 1)]

    def op(d):
        return FL.drop_if_regex_match(d, [r"\d"])

    X.check_cases(op, [{"input": {"text": "ok"}, "output": {"text": "ok"}}, {"input": {"text": "no 1"}, "output": None}], spark, "text string")
    with pytest.raises(AssertionError, match="case 0"):
        X.check_cases(op, [{"input": {"text": "1"}, "output": {"text": "1"}}], spark, "text string")
    caps = spark.createDataFrame([([(0.0, "a  1"), (1.0, "b")],)], "s array<struct<start:double,text:string>>")
    got = caps.select(X.sub_caption_texts(F.col("s"), [{"pattern": r"\d", "repl": "x"}]).alias("s")).first().s
    assert [(r.start, r.text.strip()) for r in got] == [(0.0, "a x"), (1.0, "b")]


def test_words_into_many_segments(spark):
    """The cursor goes through the words once, not once for every segment."""
    import time

    n = 300
    words = F.transform(F.sequence(F.lit(0), F.lit(2 * n - 1)), lambda k: F.struct(F.concat(F.lit("w"), k).alias("word"), (k * 1.0).alias("start"), (k * 1.0 + 0.9).alias("end")))
    segs = F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda g: F.struct((g * 2.0).alias("start"), (g * 2.0 + F.when(g % 10 == 3, 0.5).otherwise(1.95)).alias("end")))
    began = time.monotonic()
    got = spark.range(1).select(words.alias("al"), segs.alias("sg")).select(W.words_into_segments(F.col("al"), F.col("sg")).alias("s")).first()["s"]
    assert [s["text"] for s in got] == [f"w{2 * g}" if g % 10 == 3 else f"w{2 * g} w{2 * g + 1}" for g in range(n)]
    assert time.monotonic() - began < 60
