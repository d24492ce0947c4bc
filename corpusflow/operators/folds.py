"""Window functions and sequence folds.

Row-level sequences (speaker turns of a session, words of a transcript) use
the distributed ordered scans of :mod:`corpusflow.operators.scan`, so a
session that holds a third of all rows is still spread over many tasks.
Folds over the array inside one row (caption segments of one recording) are
``aggregate`` higher-order functions and stay JVM-side.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusflow.functions.text import once
from corpusflow.operators.scan import PID, POS, blocked_cumsum, blocked_previous, ordered_blocks
from corpusflow.session import cut_lineage
from corpusflow.sources.manifest import SEQ

TASK = 1 << 19      # words that a task gets
LARGE = 1 << 20     # words of a recording; a larger one is not worked on by one task


def speaker_runs(df: DataFrame, session: str, order: Sequence[str], speaker: str,
                 out: str = "run_id") -> DataFrame:
    """Islands of consecutive rows with the same speaker inside a
    session; ``out`` numbers them from 1 in order (first row starts a run,
    NULL speakers compare equal)."""
    blocks = ordered_blocks(df, [session, *order])
    # one scan gives both the previous speaker and whether a previous row exists
    prev = blocked_previous(blocks, F.struct(F.col(speaker).alias("s")), "_prev", [session])
    new_run = (F.col("_prev").isNull() | ~F.col(speaker).eqNullSafe(F.col("_prev.s"))).cast("long")
    runs = blocked_cumsum(prev.withColumn("_new", new_run), "_new", out, [session])
    return runs.drop("_prev", "_new", PID, POS)


def merge_runs_by_duration(df: DataFrame, session: str, order: Sequence[str], speaker: str,
                           start: str, end: str, text: str, threshold: float = 20.0) -> DataFrame:
    """W1 runs, cut again wherever the running duration inside the run
    passes a multiple of ``threshold``; each group becomes one row with the
    earliest start, latest end, the texts joined by spaces in order and its
    speaker."""
    blocks = ordered_blocks(df.withColumn("_dur", F.col(end) - F.col(start)), [session, *order])
    b = blocked_previous(blocks, F.struct(F.col(speaker).alias("s")), "_prev", [session])
    spk_change = F.col("_prev").isNull() | ~F.col(speaker).eqNullSafe(F.col("_prev.s"))
    b = blocked_cumsum(b.withColumn("_new", spk_change.cast("long")), "_new", "_run", [session])
    b = blocked_cumsum(b, "_dur", "_cum", [session, "_run"])
    b = b.withColumn("_mult", F.floor(F.col("_cum") / threshold))
    b = blocked_previous(b, "_mult", "_prev_mult", [session])
    change = spk_change | ~F.col("_mult").eqNullSafe(F.col("_prev_mult"))
    b = blocked_cumsum(b.withColumn("_chg", change.cast("long")), "_chg", "_grp", [session])
    key = F.struct(F.col(PID), F.col(POS))
    # a group spans at most `threshold` seconds of one speaker: bounded
    return (b.groupBy(session, "_grp").agg(
        F.min(start).alias(start), F.max(end).alias(end),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(key.alias("k"), F.col(text).alias("t")))),
                                 lambda x: x["t"]), " ").alias(text),
        F.min_by(F.col(speaker), key).alias(speaker))
        .withColumnRenamed("_grp", "group_id"))


def aggregate_caption_segments(segments: Column, max_duration: float = 20.0,
                               audio_duration: Column | None = None) -> Column:
    """Greedy merge of caption segments while the merged span stays
    below ``max_duration``.  Rule quirks kept: appended text is glued
    without a space, the merged start goes to ``start`` (``start_time``
    keeps the first segment's), segments ending after the audio are skipped,
    and the final group is added unless equal to an emitted one."""
    first = F.element_at(segments, 1)
    init = F.struct(F.array().cast("array<struct<start_time:double,end_time:double,"
                                   "start:double,text:string>>").alias("done"),
                    F.struct(first["start_time"].cast("double").alias("start_time"),
                             first["end_time"].cast("double").alias("end_time"),
                             F.lit(None).cast("double").alias("start"),
                             first["text"].alias("text")).alias("cur"))

    def step(acc, s):
        cur = acc["cur"]
        st = F.least(s["start_time"], cur["start_time"])
        en = F.greatest(s["end_time"], cur["end_time"])
        skip = F.lit(False) if audio_duration is None else \
            ((s["end_time"] > audio_duration) | (s["start_time"] > audio_duration))
        emit = (en - st) >= max_duration
        new_seg = F.struct(s["start_time"].cast("double").alias("start_time"),
                           s["end_time"].cast("double").alias("end_time"),
                           F.lit(None).cast("double").alias("start"), s["text"].alias("text"))
        merged_text = F.when(cur["start_time"] < s["start_time"], F.concat(cur["text"], F.trim(s["text"]))) \
            .otherwise(F.concat(s["text"], F.lit(" "), cur["text"]))
        merged = F.struct(cur["start_time"].alias("start_time"), en.alias("end_time"), st.alias("start"),
                          merged_text.alias("text"))
        return F.when(skip, acc).when(
            emit, F.struct(F.concat(acc["done"], F.array(cur)).alias("done"), new_seg.alias("cur"))
        ).otherwise(F.struct(acc["done"].alias("done"), merged.alias("cur")))

    folded = F.aggregate(F.slice(segments, 2, F.greatest(F.size(segments) - 1, F.lit(0))), init, step)
    done = folded["done"]
    cur = folded["cur"]
    return F.when(F.size(segments) > 0,
                  F.when(F.array_contains(done, cur), done).otherwise(F.concat(done, F.array(cur))))


def rttm_cut_points(starts: Column, file_duration: Column, threshold: float = 20.0) -> Column:
    """Cut list from diarisation segment starts (the file duration is
    appended as a last start); long stretches are cut every ``threshold``
    seconds; sorted distinct."""
    all_starts = F.concat(starts.cast("array<double>"), F.array(file_duration.cast("double")))
    init = F.struct(F.array(F.lit(0.0)).alias("sl"), F.lit(0.0).alias("ls"), F.lit(0.0).alias("lst"),
                    F.lit(0.0).alias("ld"))

    def long_cuts(last: Column, dur: Column) -> Column:
        k = F.greatest(F.ceil(dur / threshold).cast("int") - 1, F.lit(0))
        mult = F.transform(F.sequence(F.lit(1), F.greatest(k, F.lit(1))), lambda i: last + i * F.lit(threshold))
        return F.concat(F.when(k > 0, mult).otherwise(F.array().cast("array<double>")), F.array(last + dur))

    def step(acc, start):
        d = start - acc["ls"]
        short = d <= threshold
        branch2 = (d > threshold) & (acc["ld"] < threshold)
        # branch 2: cut at the previous start, then re-measure
        d2 = start - acc["lst"]
        b2_short = F.struct(F.concat(acc["sl"], F.array(acc["lst"], start)).alias("sl"), start.alias("ls"),
                            start.alias("lst"), d2.alias("ld"))
        b2_long = F.struct(F.concat(acc["sl"], F.array(acc["lst"]), long_cuts(acc["lst"], d2)).alias("sl"),
                           (acc["lst"] + d2).alias("ls"), start.alias("lst"), d2.alias("ld"))
        b3 = F.struct(F.concat(acc["sl"], F.array(start)).alias("sl"), start.alias("ls"), start.alias("lst"),
                      d.alias("ld"))
        same = F.struct(acc["sl"].alias("sl"), acc["ls"].alias("ls"), start.alias("lst"), d.alias("ld"))
        return F.when(short, same).when(branch2, F.when(d2 <= threshold, b2_short).otherwise(b2_long)) \
            .otherwise(b3)

    return F.array_sort(F.array_distinct(F.aggregate(all_starts, init, step)["sl"]))


def gap_segments(df: DataFrame, recording: str, start: str, end: str, audio_duration: str,
                 max_length: float, speaker: str = "speaker") -> DataFrame:
    """Silent gaps between ordered segments (previous end -> start,
    and the tail up to the audio duration), labelled ``no-speaker`` and cut
    into pieces of at most ``max_length``; returned with the speaker
    segments, ordered by start."""
    blocks = ordered_blocks(df, [recording, start, SEQ] if SEQ in df.columns else [recording, start])
    b = blocked_previous(blocks, end, "_prev_end", [recording])
    gaps = b.select(recording, F.coalesce("_prev_end", F.lit(0.0)).alias("_gs"), F.col(start).alias("_ge")) \
            .filter(F.col("_ge") > F.col("_gs"))
    last = df.groupBy(recording).agg(F.max_by(end, F.struct(start, end)).alias("_gs"),
                                     F.first(audio_duration).alias("_ge"))
    gaps = gaps.unionByName(last.filter(F.col("_ge") > F.col("_gs")).select(recording, "_gs", "_ge"))
    n = F.ceil((F.col("_ge") - F.col("_gs")) / max_length).cast("int")
    pieces = gaps.withColumn("_k", F.explode(F.sequence(F.lit(0), n - 1))) \
        .select(recording,
                F.lit("no-speaker").alias(speaker),
                (F.col("_gs") + F.col("_k") * F.lit(max_length)).alias(start),
                F.least(F.col("_gs") + (F.col("_k") + 1) * F.lit(max_length), F.col("_ge")).alias(end))
    segs = df.select(recording, speaker, start, end)
    return segs.unionByName(pieces)


# Abbreviations after which a period does not end a sentence (any case).
SENTENCE_ABBREVIATIONS = (
    "mr mrs ms dr prof sr jr vs etc inc corp ltd co st ave blvd rd ln ct pl sq ft in cm mm kg lb oz pt qt gal mph "
    "rpm vol no pg pp ch sec min hr hrs am pm est pst cst mst utc gmt jan feb mar apr may jun jul aug sep oct nov dec "
    "mon tue wed thu fri sat sun dept div mgr dir pres vp ceo cfo cto coo evp svp avp").split()
# What Python's float() accepts.
_NUMBER = r"(?i)^[+-]?(inf|infinity|nan|([0-9](_?[0-9])*\.?([0-9](_?[0-9])*)?|\.[0-9](_?[0-9])*)(e[+-]?[0-9](_?[0-9])*)?)$"


def sentence_end(word: Column, next_word: Column) -> Column:
    """W10 rule: ``!`` or ``?`` always ends a sentence; a period does unless the word
    is a number or an abbreviation, and then only before an upper-case letter or at
    the end."""
    stem = F.regexp_replace(word, r"\.$", "")
    period = word.endswith(".") & ~stem.rlike(_NUMBER) & ~F.lower(stem).isin(SENTENCE_ABBREVIATIONS)
    upper = F.when(next_word.isNull() | (next_word == ""), F.lit(True)).otherwise(next_word.rlike(r"^\p{IsUppercase}"))
    return word.endswith("!") | word.endswith("?") | (period & upper)


def sentence_segments(df: DataFrame, recording: str, order: str, word: str, start: str, end: str) -> DataFrame:
    """Words as rows -> sentences by :func:`sentence_end`.  Output: text,
    start, end, duration (3 places).  Words without a recording are left out.

    The words of each recording are counted first: recordings are dealt whole over as
    many tasks as keep ``TASK`` words each, and only one of more than ``LARGE`` words is cut
    into ranges of its words."""
    rows = df.select(recording, order, word, start, end).filter(F.col(recording).isNotNull())
    counts = cut_lineage(rows.groupBy(recording).agg(F.count(F.lit(1)).alias("_n")))
    is_large = F.col("_n") > LARGE
    some = counts.agg(F.sum(F.when(~is_large, F.col("_n"))), F.sum(F.when(is_large, F.col("_n")))).first()
    n_whole, n_ranged = (-(-(x or 0) // TASK) for x in some)
    if not n_ranged:
        return _sentences_whole(rows.repartition(max(n_whole, 1), recording), recording, order, word, start, end)
    large = F.broadcast(counts.filter(is_large).select(recording))     # one row for each LARGE words at most
    whole = rows.join(large, recording, "left_anti").repartition(max(n_whole, 1), recording)
    blocks = ordered_blocks(rows.join(large, recording, "left_semi"), [recording, order, word, start, end], n_ranged)
    return _sentences_whole(whole, recording, order, word, start, end).unionByName(
        _sentences_ranged(blocks, recording, word, start, end))


def _sentences_whole(rows: DataFrame, recording: str, order: str, word: str, start: str, end: str) -> DataFrame:
    w = Window.partitionBy(recording).orderBy(order, word, start, end)
    nb = rows.withColumn("_next", F.lead(word).over(w)).withColumn("_at", F.row_number().over(w))
    nb = nb.withColumn("_bnd", sentence_end(F.col(word), F.col("_next")).cast("long"))
    nb = nb.withColumn("_sent", F.coalesce(F.sum("_bnd").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0).cast("long")))
    return _sentences(nb, recording, word, start, end, F.col("_at"))


def _sentences_ranged(blocks: DataFrame, recording: str, word: str, start: str, end: str) -> DataFrame:
    nxt = _next_value(blocks, recording, word)
    boundary = sentence_end(F.col(word), F.col("_next"))
    nb = nxt.withColumn("_bnd", boundary.cast("long"))
    nb = blocked_cumsum(nb, "_bnd", "_sent", [recording], inclusive=False)
    return _sentences(nb, recording, word, start, end, F.struct(F.col(PID), F.col(POS)))


def _sentences(numbered: DataFrame, recording: str, word: str, start: str, end: str, key: Column) -> DataFrame:
    """One row for each recording and ``_sent``; ``key`` is the order of the words."""
    grouped = numbered.groupBy(recording, "_sent").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(key.alias("k"), F.col(word).alias("w")))),
                                 lambda x: x["w"]), " ").alias("text"),
        F.min_by(F.col(start), key).alias("start"), F.max_by(F.col(end), key).alias("end"))
    return grouped.withColumn("start", F.bround("start", 3)).withColumn("end", F.bround("end", 3)) \
                  .withColumn("duration", F.bround(F.col("end") - F.col("start"), 3)) \
                  .withColumnRenamed("_sent", "sentence_id")


def _next_value(blocks: DataFrame, segment: str, value: str) -> DataFrame:
    """Next row's value inside the segment on a blocked frame (mirror of
    the previous-row scan)."""
    keys = [PID, segment]
    w = Window.partitionBy(*keys).orderBy(POS)
    firsts = blocks.groupBy(*keys).agg(F.min_by(value, POS).alias("_f"))
    carry = firsts.select(*keys, F.lead("_f").over(Window.partitionBy(segment).orderBy(PID)).alias("_carry"))
    t = blocks.withColumn("_lead", F.lead(value).over(w)) \
              .withColumn("_last", F.row_number().over(w.orderBy(F.col(POS).desc())) == 1)
    j = t.join(carry, keys)
    return j.withColumn("_next", F.when(F.col("_last"), F.col("_carry")).otherwise(F.col("_lead"))) \
            .drop("_lead", "_last", "_carry")


def speaker_turns(df: DataFrame, session: str, order: str, speaker: str, text: str) -> DataFrame:
    """Speaker turns from ordered tokens/utterances: W1 runs, text
    joined in order, turns with blank text dropped, then numbered from 0
    inside the session."""
    runs = speaker_runs(df, session, [order], speaker)
    turns = runs.groupBy(session, "run_id").agg(
        F.min_by(F.col(speaker), F.col(order)).alias(speaker),
        F.min(order).alias("first_" + order),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"),
                                                                      F.col(text).alias("t")))),
                                 lambda x: x["t"]), " ").alias(text))
    turns = turns.filter(F.trim(F.col(text)) != "")
    blocks = ordered_blocks(turns, [session, "run_id"])
    return blocked_cumsum(blocks, F.lit(1), "segment_index", [session], inclusive=False) \
        .drop(PID, POS)


def take_by_quota(df: DataFrame, order: Sequence, duration_key: str, quotas: Sequence[tuple[str, float]],
                  rest_label: str = "train", out: str = "split") -> DataFrame:
    """Walk the rows in ``order`` (a seeded hash order) accumulating
    duration; a split takes rows while its running total before the row is
    within the quota (the crossing row included), then the next split
    starts from zero; the rest is ``rest_label``.

    The running total is the distributed prefix sum; where each split
    starts is one scalar aggregate per split."""
    from corpusflow.operators.scan import with_prefix_sum
    cum = with_prefix_sum(df, order, duration_key, "_cum", inclusive=False)
    start = 0.0
    expr = None
    for name, quota in quotas:
        c = (F.col("_cum") >= start) & (F.col("_cum") - F.lit(start) <= quota)
        expr = F.when(c, F.lit(name)) if expr is None else expr.when(c, F.lit(name))
        nxt = cum.filter(F.col("_cum") - F.lit(start) > quota).agg(F.min("_cum")).first()[0]
        if nxt is None:
            break
        start = nxt
    label = expr.otherwise(F.lit(rest_label)) if expr is not None else F.lit(rest_label)
    return cum.withColumn(out, label).drop("_cum")


def sentences_from_captions(segments: Column, duration_threshold: float = 10.0,
                            sample_rate: int = 16000) -> Column:
    """Accumulate caption texts (each prefixed by a space) until the
    span passes ``duration_threshold`` or the text ends with ``.``/``?``,
    then emit (stripped text, start, end in samples, duration in seconds).
    Times are integer sample positions.  Rule quirks kept: a caption that
    starts at sample 0 does not fix the start (the next one does), and a
    trailing group is emitted only when its start is not 0."""
    sr = float(sample_rate)
    out_t = "array<struct<text:string,start:long,end:long,duration:double>>"
    init = F.struct(F.array().cast(out_t).alias("out"), F.lit("").alias("t"),
                    F.lit(0).cast("long").alias("s"), F.lit(0).cast("long").alias("e"))

    def step(acc, seg):
        st = F.floor(seg["start_time"] * sr).cast("long")
        en = F.floor(seg["end_time"] * sr).cast("long")
        t = F.concat(acc["t"], F.lit(" "), seg["text"])
        s = F.when(acc["s"] == 0, st).otherwise(acc["s"])
        emit = (F.length(t) > 0) & (((en - s) > F.lit(duration_threshold * sr)) | t.endswith(".") | t.endswith("?"))
        piece = F.struct(F.trim(t).alias("text"), s.alias("start"), en.alias("end"),
                         ((en - s) / F.lit(sr)).alias("duration"))
        return F.when(emit, F.struct(F.concat(acc["out"], F.array(piece)).alias("out"), F.lit("").alias("t"),
                                     F.lit(0).cast("long").alias("s"), F.lit(0).cast("long").alias("e"))) \
            .otherwise(F.struct(acc["out"].alias("out"), t.alias("t"), s.alias("s"), en.alias("e")))

    def finish(acc):
        tail = F.struct(F.trim(acc["t"]).alias("text"), acc["s"].alias("start"), acc["e"].alias("end"),
                        ((acc["e"] - acc["s"]) / F.lit(sr)).alias("duration"))
        return F.when((F.length(acc["t"]) > 0) & (acc["s"] != 0), F.concat(acc["out"], F.array(tail))) \
            .otherwise(acc["out"])

    return F.aggregate(segments, init, step, finish)


def split_long(df: DataFrame, max_len: float = 3600.0, min_len: float = 1.0, sample_rate: int = 16000, path: str = "audio_filepath",
               duration: str = "duration", segments: str = "segments", n_frames: str | None = None) -> DataFrame:
    """Recordings of ``max_len`` seconds or more are cut at the end of the segment
    before the one that would pass the limit.  A part no longer than ``min_len`` joins
    the next one; a last part that short, or over the limit by a second, is left out.
    Output: short recordings as they are, the parts with their own path, offset and
    duration, and for each cut recording a parent row with ``split_filepaths`` and
    ``split_offsets``.  ``n_frames``: column with the number of samples (else duration
    times rate)."""
    sr = F.lit(float(sample_rate))
    cut = F.aggregate(segments, F.struct(F.lit(0.0).alias("from"), F.lit(0.0).alias("prev"), F.array().cast("array<double>").alias("at")),
                      lambda acc, s: F.when(s["end"] - acc["from"] > max_len,
                                            F.struct(acc["prev"].alias("from"), s["end"].cast("double").alias("prev"),
                                                     F.concat(acc["at"], F.array(acc["prev"])).alias("at")))
                                      .otherwise(F.struct(acc["from"].alias("from"), s["end"].cast("double").alias("prev"), acc["at"].alias("at"))))["at"]
    frames = F.col(n_frames) if n_frames else F.round(F.col(duration) * sr)
    stem = F.substring(F.col(path), F.lit(1), F.length(path) - 4)

    def part(k: Column, start: Column, length: Column) -> Column:
        name = F.concat(stem, F.lit("."), k.cast("string"), F.lit("_of_"), (F.size("_at") + 1).cast("string"), F.lit(".wav"))
        return F.struct(name.alias("path"), (start / sr).alias("offset"), (length / sr).alias("duration"))

    kind = "array<struct<path:string,offset:double,duration:double>>"

    def step(acc: Column, x: Column) -> Column:
        stop = F.ceil(x["at"] * sr).cast("double")
        return F.when(stop - acc["from"] > min_len * sr,
                      F.struct(stop.alias("from"), F.concat(acc["parts"], F.array(part(x["k"], acc["from"], stop - acc["from"]))).alias("parts"))) \
            .otherwise(acc)

    def finish(acc: Column) -> Column:
        rest = frames.cast("double") - 1 - acc["from"]
        return F.when((rest > min_len * sr) & (rest < (max_len + 1) * sr),
                      F.concat(acc["parts"], F.array(part(F.size("_at") + 1, acc["from"], rest)))).otherwise(acc["parts"])

    numbered = F.transform("_at", lambda x, i: F.struct((i + 1).alias("k"), x.alias("at")))
    parts = F.aggregate(numbered, F.struct(F.lit(0.0).alias("from"), F.array().cast(kind).alias("parts")), step, finish)
    long = F.col(duration) >= max_len
    tagged = df.withColumn("_at", F.when(long, cut)).withColumn("_parts", F.when(long, parts))
    parent = tagged.withColumn("split_filepaths", F.transform("_parts", lambda x: x["path"])) \
                   .withColumn("split_offsets", F.transform("_parts", lambda x: x["offset"])).withColumn("offset", F.lit(None).cast("double"))
    pieces = tagged.filter(long).withColumn("_x", F.explode("_parts")).withColumn(path, F.col("_x.path")) \
                   .withColumn("offset", F.col("_x.offset")).withColumn(duration, F.col("_x.duration")) \
                   .withColumn("split_filepaths", F.lit(None).cast("array<string>")).withColumn("split_offsets", F.lit(None).cast("array<double>"))
    return parent.drop("_at", "_parts").unionByName(pieces.drop("_at", "_parts", "_x"))


def words_into_segments(alignment: Column, segments: Column) -> Column:
    """The segments with their ``words`` and joined ``text``.  A cursor goes
    through the words and the segments: a word inside a segment belongs to it; one that
    sticks out belongs to it unless the next segment overlaps it more; one that
    overlaps neither is skipped; a word that starts at or after a segment's end moves
    the cursor on.  Without words or segments the segments get null fields."""
    return once(F.struct(alignment.alias("words"), segments.alias("segments")), lambda r: _into_segments(r["words"], r["segments"]))


def _into_segments(alignment: Column, segments: Column) -> Column:
    def overlap(w: Column, s: Column) -> Column:
        shared = F.least(w["end"], s["end"]) - F.greatest(w["start"], s["start"])    # these skip nulls
        return F.when(s.isNull(), F.lit(0.0)).otherwise(F.greatest(F.lit(0.0), shared))

    def stays(w: Column, i: Column) -> Column:
        s, nxt = F.get(segments, i), F.get(segments, i + 1)
        inside = (w["start"] >= s["start"]) & (w["end"] <= s["end"])
        return (i < F.size(segments)) & ~((w["start"] >= s["end"]) | (~inside & (overlap(w, nxt) > overlap(w, s))))

    def belongs(w: Column, i: Column) -> Column:
        s = F.get(segments, i)
        return ((w["start"] >= s["start"]) & (w["end"] <= s["end"])) | (overlap(w, s) > 0)

    def further(w: Column, i: Column) -> Column:
        """The first segment from ``i`` on that keeps the word."""
        rest = F.when(i < F.size(segments), F.sequence(i, F.size(segments) - 1))
        return F.coalesce(F.get(F.filter(rest, lambda k: stays(w, k)), F.lit(0)), F.size(segments))

    def step(acc: Column, w: Column) -> Column:
        # the cursor moves by one at most, as a rule
        i = acc["i"]
        at = F.when(stays(w, i), i).when(stays(w, i + 1), i + 1).otherwise(further(w, i + 2))
        return once(at, lambda k: F.struct(k.alias("i"), F.concat(acc["of"], F.array(F.when(belongs(w, k), k).otherwise(F.lit(-1)))).alias("of")))

    of = F.aggregate(alignment, F.struct(F.lit(0).alias("i"), F.array().cast("array<int>").alias("of")), step)["of"]
    paired = F.zip_with(alignment, of, lambda w, i: F.struct(w.alias("w"), i.alias("i")))

    def fill(pairs: Column, s: Column, k: Column) -> Column:
        mine = F.transform(F.filter(pairs, lambda p: p["i"] == k), lambda p: p["w"])
        return once(F.when(F.size(alignment) > 0, mine),
                    lambda m: s.withField("words", m).withField("text", F.array_join(F.transform(m, lambda w: w["word"]), " ")))

    return once(paired, lambda pairs: F.transform(segments, lambda s, k: fill(pairs, s, k)))
