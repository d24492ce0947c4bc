"""Finding repeated windows over whole corpora: the part that suffix-array dedup
(bytes) and substring dedup (words) share.

A window is ``window`` consecutive symbols of one document.  Winnowing gives each
window one anchor, the smallest hash among its ``gram``-symbol grams, the leftmost
where equal; equal windows have equal anchors.  Neighbouring windows with one
anchor make a segment (shorter than two windows), and all work is on segments:

0. copies: of documents with one text the first stands for all, and the others lose
   every window;
1. anchors that occur twice or more, from packed lists of hashes, a list for each
   pack of a task's hashes and bucket (a pack names an anchor twice at most);
2. segments of those anchors, as digests with document and place.  A Bloom filter
   of bounded size keeps most others out; what it lets through is harmless;
3. for each distinct segment its first place and number (partial aggregates, so
   a passage in a third of all documents is one row a task);
4. anchors with several distinct segments are contested: windows of different
   segments may be equal.  Their texts are fetched once each, aligned at the
   anchor, and the operator's own kernel finds the first place of every window.
   An anchor with very many distinct segments is first split by the symbols next
   to it, level by level, with equal parts made one at each;
5. every place of a segment is held against the first places of its windows;
   later ones are marked.

Documents are keyed by identifier and text hash, so repeated rows count once.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusflow.llm import numerics as N
from corpusflow.llm.bloom import bloom_words, contains, may_contain
from corpusflow.llm.store import shuffle_partitions, stored, without
from corpusflow.session import small_batches

OUT = ("n_units", "n_removed", "removed_spans", "clean")
NO_ID = -(1 << 63)        # a null identifier sorts first
_POS_BITS = N.U((1 << 21) - 1)
_SHAPE = 1 << 15           # windows of a segment and symbols before its anchor, in one number
PART = 1 << 18             # bytes of text, or symbols, worked on at once
SLICE = 1 << 13            # segments that a kernel takes at once, or those of one anchor
PACKED = 1 << 18           # anchor hashes that a task gathers before it packs them into lists
WHOLE = (1 << 31) - 1      # end of a span over the whole text
RUNS = "h long, dg long, o1 int, o2 int, ed long, et long, ep int"


@dataclass(frozen=True)
class RepeatParams:
    unit: str                  # "bytes" or "words"
    window: int
    gram: int
    within_document: bool      # does an earlier place in the same document count?
    hot_segments: int = 256   # distinct segments of an anchor that one task takes

    def __post_init__(self):
        if not 0 < self.gram <= self.window < _SHAPE:
            raise ValueError(f"windows of 1 to {_SHAPE - 1} symbols, with grams no longer than them")


def symbols(buf: np.ndarray, off: np.ndarray, unit: str) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit value for each symbol, and the number of symbols of each text."""
    if unit == "bytes":
        return N.BYTE_KEYS[buf], np.diff(off)
    return N.word_hashes(buf, off)


def _sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    span = 1
    while 2 * span <= width:
        x = np.minimum(x[:-span], x[span:])
        span *= 2
    return np.minimum(x[:span - width], x[width - span:]) if span < width else x


def segments(values: np.ndarray, counts: np.ndarray, p: RepeatParams):
    """(document, first window, windows, anchor's place in the segment, anchor
    hash, digest) of all segments, as arrays, a stretch of symbols at a time."""
    start, step = N.starts_of(counts), N.CHUNK
    for a in range(0, max(1, len(values) - p.window + 1), step):
        v = values[a:a + step + p.window - 1]
        n = len(v) - p.window + 1
        if n < 1:
            return
        d = np.arange(max(0, np.searchsorted(start, a, "right") - 1), np.searchsorted(start, a + n, "left"))
        low = np.maximum(start[d] - a, 0)
        high = np.minimum(start[d + 1] - p.window - a, n - 1)
        d, low, high = d[high >= low], low[high >= low], high[high >= low]
        if not len(d):
            continue
        up, down = N.powers(len(v) + 1)
        c = np.zeros(len(v) + 1, N.U)
        np.cumsum(v * up[:-1], out=c[1:])
        g = N.mix((c[p.gram:] - c[:-p.gram]) * down[:len(v) - p.gram + 1])
        at = (_sliding_min((g & ~_POS_BITS) | np.arange(len(g), dtype=N.U), p.window - p.gram + 1) & _POS_BITS).astype(np.int64)
        new = np.zeros(n + 1, bool)
        new[1:n] = at[1:] != at[:-1]
        new[low] = True
        new[high + 1] = True
        s = np.flatnonzero(new[:n])
        e = np.append(s[1:], n)
        j = np.searchsorted(low, s, "right") - 1
        ok = (j >= 0) & (s <= high[j])
        s, e, j = s[ok], e[ok], j[ok]
        digest = N.mix((c[e - 1 + p.window] - c[s]) * down[s] + (e - s).astype(N.U) * N.U(0xD6E8FEB86659FD93))
        yield d[j], s + a - start[d[j]], e - s, at[s] - s, g[at[s]], digest


def _batches(batches, column: int, p: RepeatParams):
    """(batch, first row, arrays of segments()) over Arrow batches."""
    for batch in batches:
        buf, off = N.utf8(batch.column(column))
        for i, j in N.groups(off, PART):
            for found in segments(*symbols(buf[off[i]:off[j]], off[i:j + 1] - off[i], p.unit), p):
                yield batch, i, found


def _copies(docs: DataFrame) -> DataFrame:
    """d, t of the documents whose text a document with a smaller identifier has too."""
    slim = docs.select("d", "t", F.xxhash64(F.lit(1), "text").alias("u"), F.octet_length("text").alias("n"))
    first = slim.groupBy("t", "u", "n").agg(F.min("d").alias("first"), F.max("d").alias("last")).filter("first < last")
    return stored(slim.join(first, ["t", "u", "n"]).filter("d > first").select("d", "t").distinct(), "copies")


def _without(docs: DataFrame, gone: DataFrame) -> DataFrame:
    """``docs`` without those in ``gone`` (d, t); only possible hits are shuffled."""
    key = F.xxhash64("d", "t")
    may = may_contain(docs.sparkSession, bloom_words(gone.select(key.alias("k")), "k", gone.count()))
    flagged = docs.withColumn("may", may(key))
    rest = flagged.filter("may").join(gone, ["d", "t"], "left_anti")
    return flagged.filter("NOT may").unionByName(rest).drop("may")


def _repeated_anchors(docs: DataFrame, p: RepeatParams) -> DataFrame:
    """Anchor hashes ``h`` that occur twice or more, once each."""
    buckets = 4 * shuffle_partitions(docs.sparkSession)

    def lists(found):
        h, n = np.unique(np.concatenate(found), return_counts=True)
        h = np.concatenate([h, h[n > 1]])
        b = (h % N.U(buckets)).astype(np.int64)
        order, size = np.argsort(b, kind="stable"), np.bincount(b, minlength=buckets)
        have = np.flatnonzero(size)
        return pa.RecordBatch.from_arrays([pa.array(have, pa.int32()), N.list_array(h[order].view(np.int64), size[have], pa.int64())],
                                          names=["bucket", "hs"])

    def pack(batches):
        found, held = [], 0
        for _, _, x in _batches(batches, 0, p):      # packs do not depend on the size of the batches
            found.append(x[4])
            held += len(x[4])
            if held >= PACKED:
                yield lists(found)
                found, held = [], 0
        if found:
            yield lists(found)

    def twice(pdf: pd.DataFrame) -> pd.DataFrame:
        h = np.sort(np.concatenate(pdf["hs"].tolist()))
        N.release()
        return pd.DataFrame({"h": np.unique(h[1:][h[1:] == h[:-1]])})

    packed = docs.select("text").mapInArrow(pack, "bucket int, hs array<long>")
    return stored(packed.groupBy("bucket").applyInPandas(twice, "h long"), "anchors")


def _places(docs: DataFrame, anchors: DataFrame, p: RepeatParams) -> DataFrame:
    """Segments of repeated anchors: h, dg, d, t, i0, shape."""
    shared = docs.sparkSession.sparkContext.broadcast(bloom_words(anchors, "h", anchors.count()))

    def run(batches):
        words = shared.value
        for batch, row, (doc, first, n, at, h, dg) in _batches(batches, 2, p):
            ok = contains(h, words)
            ids = pa.array(doc[ok] + row)
            yield pa.RecordBatch.from_arrays(
                [pa.array(h[ok].view(np.int64)), pa.array(dg[ok].view(np.int64)), batch.column(0).take(ids), batch.column(1).take(ids),
                 pa.array(first[ok], pa.int32()), pa.array(n[ok] * _SHAPE + at[ok], pa.int32())],
                names=["h", "dg", "d", "t", "i0", "shape"])

    return stored(docs.select("d", "t", "text").mapInArrow(run, "h long, dg long, d long, t long, i0 int, shape int"), "places")


def _contents(docs: DataFrame, contested: DataFrame, p: RepeatParams) -> DataFrame:
    """Contested segments with their symbols, ``v``: bytes, or the words' values."""
    asked = stored(contested.groupBy("d", "t").agg(F.collect_list(F.struct("h", "dg", "i0", "shape", "hot")).alias("asks")), "asked")
    may = may_contain(docs.sparkSession, bloom_words(asked, "d", asked.count()))
    joined = docs.select("d", "t", "text").filter(may(F.col("d"))).dropDuplicates(["d", "t"]).join(asked, ["d", "t"])

    def run(batches):
        for batch in batches:
            buf, off = N.utf8(batch.column(2))
            asks = batch.column(3)
            for i, j in N.groups(off, PART):
                part, places = buf[off[i]:off[j]], off[i:j + 1] - off[i]
                v, counts = (part, np.diff(places)) if p.unit == "bytes" else symbols(part, places, p.unit)
                lists = asks.slice(i, j - i)
                rows = lists.flatten()
                n = np.diff(lists.offsets.to_numpy())
                doc = np.repeat(np.arange(j - i), n)
                first, shape = (rows.field(k).to_numpy().astype(np.int64) for k in ("i0", "shape"))
                size = shape // _SHAPE + p.window - 1
                flat = v[N.ragged_index(N.starts_of(counts)[doc] + first, size)]
                ids = pa.array(doc + i)
                yield pa.RecordBatch.from_arrays(
                    [rows.field("h"), rows.field("dg"), batch.column(0).take(ids), batch.column(1).take(ids), rows.field("i0"),
                     rows.field("shape"), rows.field("hot"), _binary(flat, size)],
                    names=["h", "dg", "d", "t", "i0", "shape", "hot", "v"])

    return stored(joined.mapInArrow(run, "h long, dg long, d long, t long, i0 int, shape int, hot boolean, v binary"), "contents")


def _binary(flat: np.ndarray, size: np.ndarray) -> pa.Array:
    """One binary value for each ``size`` items of ``flat``."""
    off = (N.starts_of(size) * flat.itemsize).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(size), [None, pa.py_buffer(off), pa.py_buffer(np.ascontiguousarray(flat))])


def _symbol_type(p: RepeatParams):
    return np.uint8 if p.unit == "bytes" else N.U


@dataclass
class Aligned:
    """Segments of some anchors: ``v[at[j]]`` is the first symbol of segment j's
    anchor; ``left`` and ``right`` count the symbols before and from there."""
    group: np.ndarray          # number of the anchor
    v: np.ndarray
    at: np.ndarray
    left: np.ndarray
    right: np.ndarray
    windows: np.ndarray
    age: np.ndarray            # rank by (document, place): smaller is earlier


Kernel = Callable[[Aligned, RepeatParams], np.ndarray]


def _runs_of(pdf: pd.DataFrame, p: RepeatParams, kernel: Kernel) -> pd.DataFrame:
    """First places of all windows of the segments, as runs of windows; a bounded
    number of segments at a time, all of an anchor together."""
    pdf = pdf.sort_values("h", kind="stable", ignore_index=True)
    h = pdf["h"].to_numpy()
    edges = np.append(np.flatnonzero(np.append(True, h[1:] != h[:-1])), len(h))
    cuts = np.unique(np.append(edges[np.searchsorted(edges, np.arange(0, len(h), SLICE))], len(h)))
    runs = pd.concat([_slice_runs(pdf.iloc[i:j], p, kernel) for i, j in zip(cuts[:-1], cuts[1:])])
    N.release()
    return runs


def _slice_runs(pdf: pd.DataFrame, p: RepeatParams, kernel: Kernel) -> pd.DataFrame:
    pdf = pdf.sort_values(["d", "t", "i0"], kind="stable").reset_index(drop=True)
    shape = pdf["shape"].to_numpy(np.int64)
    n, left = shape // _SHAPE, shape % _SHAPE
    size = n + p.window - 1
    v = np.frombuffer(b"".join(pdf["v"]), _symbol_type(p))
    d, t = pdf["d"].to_numpy(np.int64), pdf["t"].to_numpy(np.int64)
    anchor = pdf["i0"].to_numpy(np.int64) + left
    order = np.lexsort((anchor, t, d))
    age = np.empty(len(pdf), np.int64)
    age[order] = np.arange(len(pdf))
    al = Aligned(np.unique(pdf["h"].to_numpy(np.int64), return_inverse=True)[1], v, N.starts_of(size)[:-1] + left,
                 left, size - left, n, age)
    oldest = order[kernel(al, p)]      # flat over windows: the segment with the first place
    seg = np.repeat(np.arange(len(pdf)), n)
    o = np.arange(len(seg)) - N.starts_of(n)[seg]
    new = np.ones(len(seg), bool)
    new[1:] = (seg[1:] != seg[:-1]) | (oldest[1:] != oldest[:-1])
    s = np.flatnonzero(new)
    e = np.append(s[1:], len(seg))
    who, src = seg[s], oldest[s]
    return pd.DataFrame({"h": pdf["h"].to_numpy()[who], "dg": pdf["dg"].to_numpy()[who], "o1": o[s].astype(np.int32),
                         "o2": o[e - 1].astype(np.int32), "ed": d[src], "et": t[src],
                         "ep": (anchor[src] - left[who] + o[s]).astype(np.int32)})


def _halves(units: DataFrame, p: RepeatParams) -> DataFrame:
    """Units (segments of one group ``g``, or parts of them, with digest ``c``), cut in two by
    the anchor's place in the window: the windows with ``k1`` to ``k2`` symbols before the anchor
    become those with k1 to m and those with m + 1 to k2.  All windows of such a part hold
    the same stretch around the anchor, and the next group is the old one with its symbols."""
    def halved(batch):
        g, c, d, t, i0, shape, k1, k2 = (batch.column(k).to_numpy() for k in range(8))
        v = np.frombuffer(b"".join(batch.column(8).to_pylist()), _symbol_type(p))
        n, left = shape.astype(np.int64) // _SHAPE, shape.astype(np.int64) % _SHAPE
        start = N.starts_of(n + p.window - 1)[:-1]
        up, down = N.powers(len(v) + 1)
        total = np.zeros(len(v) + 1, N.U)
        np.cumsum((N.BYTE_KEYS[v] if p.unit == "bytes" else v) * up[:len(v)], out=total[1:])
        middle = (k1 + k2) // 2
        for a, b in ((k1, middle), (middle + 1, k2)):
            lo, hi = np.maximum(left - b, 0), np.minimum(left - a, n - 1)
            ok = np.flatnonzero(lo <= hi)
            lo, hi, a, b, at = lo[ok], hi[ok], a[ok], b[ok], start[ok] + left[ok]
            first, size = start[ok] + lo, hi - lo + p.window
            form = (hi - lo + 1) * _SHAPE + left[ok] - lo
            core = (total[at - b + p.window] - total[at - a]) * down[at - a]
            part = (total[first + size] - total[first]) * down[first]
            group = N.mix(core + N.mix(g[ok].view(N.U) + (a * _SHAPE + b).astype(N.U)))
            digest = N.mix(part + form.astype(N.U) * N.U(0xD6E8FEB86659FD93))
            yield pa.RecordBatch.from_arrays(
                [pa.array(x) for x in (g[ok], c[ok], lo.astype(np.int32), group.view(np.int64), digest.view(np.int64), d[ok], t[ok],
                                       (i0[ok] + lo).astype(np.int32), form.astype(np.int32), a.astype(np.int32), b.astype(np.int32))]
                + [_binary(v[N.ragged_index(first, size)], size)],
                names=["g", "c", "o", "g2", "c2", "d", "t", "i0", "shape", "k1", "k2", "v"])

    def run(batches):
        for batch in batches:
            size = pc.binary_length(batch.column(8)).to_numpy() // np.dtype(_symbol_type(p)).itemsize
            for i, j in N.groups(N.starts_of(size), PART):       # a bounded number of symbols at a time
                yield from halved(batch.slice(i, j - i))

    return units.select("g", "c", "d", "t", "i0", "shape", "k1", "k2", "v").mapInArrow(
        run, "g long, c long, o int, g2 long, c2 long, d long, t long, i0 int, shape int, k1 int, k2 int, v binary")


def _hot_runs(contents: DataFrame, p: RepeatParams, kernel: Kernel) -> DataFrame:
    """The same for anchors with very many distinct segments, split by the symbols next to
    the anchor until a group has few distinct units or one; equal units are one from
    there on, so a passage common to all costs a unit for each half, not a row for each window."""
    units = contents.filter("hot").select(F.col("h").alias("g"), F.col("dg").alias("c"), "d", "t", "i0", "shape",
                                          F.lit(0).alias("k1"), F.lit(p.window - p.gram).alias("k2"), "v")
    members = contents.filter("hot").select("h", "dg", F.lit(0).alias("o"), F.col("h").alias("g"), F.col("dg").alias("c"))
    runs = []
    while True:
        sizes = units.groupBy("g").agg(F.count(F.lit(1)).alias("k"))
        sized = stored(units.join(sizes, "g").withColumn("split", (F.col("k") > max(p.hot_segments, 1)) & (F.col("k1") < F.col("k2"))), "units")
        small = (sized.filter("NOT split AND k > 1").select(F.col("g").alias("h"), F.col("c").alias("dg"), "d", "t", "i0", "shape", "v"))
        found = _kernel_runs(small, p, kernel).unionByName(
            sized.filter("NOT split AND k = 1").select(
                F.col("g").alias("h"), F.col("c").alias("dg"), F.lit(0).alias("o1"),
                (F.floor(F.col("shape") / _SHAPE) - 1).cast("int").alias("o2"),
                F.col("d").alias("ed"), F.col("t").alias("et"), F.col("i0").alias("ep")))
        found = found.withColumnRenamed("h", "g").withColumnRenamed("dg", "c")
        runs.append(members.join(found, ["g", "c"]).select(
            "h", "dg", (F.col("o") + F.col("o1")).alias("o1"), (F.col("o") + F.col("o2")).alias("o2"), "ed", "et", "ep"))
        rest = sized.filter("split")
        if rest.isEmpty():
            return reduce(DataFrame.unionByName, runs)
        parts = stored(_halves(rest, p), "halves")
        edges = parts.select("g", "c", F.col("o").alias("by"), "g2", "c2")
        members = stored(members.join(edges, ["g", "c"]).select("h", "dg", (F.col("o") + F.col("by")).alias("o"),
                                                                 F.col("g2").alias("g"), F.col("c2").alias("c")), "members")
        first = F.min_by(F.struct("d", "t", "i0", "shape", "k1", "k2", "v"), F.struct("d", "t", "i0"))
        units = parts.groupBy(F.col("g2").alias("g"), F.col("c2").alias("c")).agg(first.alias("f")).select("g", "c", "f.*")


def _kernel_runs(contents: DataFrame, p: RepeatParams, kernel: Kernel) -> DataFrame:
    """Runs of the segments (h, dg, d, t, i0, shape, v), all of an anchor in one task."""
    buckets = 4 * shuffle_partitions(contents.sparkSession)
    return (contents.groupBy(F.pmod("h", F.lit(buckets)).alias("bucket"))
                    .applyInPandas(lambda pdf: _runs_of(pdf, p, kernel), RUNS))


def repeated_spans(docs: DataFrame, p: RepeatParams, kernel: Kernel) -> DataFrame:
    """``docs`` has d, t, text.  Per document with something to remove: ``spans``,
    a list of (a, b), overlapping, in symbols; (0, WHOLE) for a copy."""
    copies = _copies(docs)
    singles = _without(docs, copies)
    places = _places(singles, _repeated_anchors(singles, p), p)
    distinct = stored(places.groupBy("h", "dg").agg(F.count(F.lit(1)).cast("int").alias("n"), F.max("shape").alias("shape"),
                                                    F.min(F.struct("d", "t", "i0")).alias("f")), "segments")
    several = stored(distinct.groupBy("h").agg(F.count(F.lit(1)).alias("k")).filter("k > 1"), "contested")
    may = may_contain(docs.sparkSession, bloom_words(several, "h", several.count()))
    contested = distinct.filter(may(F.col("h"))).join(several, "h").select(
        "h", "dg", "f.d", "f.t", "f.i0", "shape", (F.col("k") > p.hot_segments).alias("hot"))
    contents = _contents(docs, contested, p)
    cold = _kernel_runs(contents.filter("NOT hot"), p, kernel)
    # a repeated segment is later than its own first place, whatever else its windows equal
    alone = distinct.filter("n > 1").select(
        "h", "dg", F.lit(0).alias("o1"), (F.floor(F.col("shape") / _SHAPE) - 1).cast("int").alias("o2"),
        F.col("f.d").alias("ed"), F.col("f.t").alias("et"), F.col("f.i0").alias("ep"))
    runs = stored(cold.unionByName(_hot_runs(contents, p, kernel)).unionByName(alone), "runs")
    start = F.col("i0") + F.col("o1")
    later = (F.struct("ed", "et", "ep") < F.struct(F.col("d"), F.col("t"), start)) if p.within_document else F.col("ed") < F.col("d")
    found = places.join(runs, ["h", "dg"]).filter(later).select(
        "d", "t", F.struct(start.alias("a"), (F.col("i0") + F.col("o2") + p.window).alias("b")).alias("s"))
    whole = copies.select("d", "t", F.struct(F.lit(0).alias("a"), F.lit(WHOLE).alias("b")).alias("s"))
    return found.unionByName(whole).groupBy("d", "t").agg(F.collect_list("s").alias("spans"))


def _cut(n: int, begins: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Which of ``n`` symbols go, and the maximal runs of them."""
    step = np.zeros(n + 1, np.int32)
    np.add.at(step, begins, 1)
    np.add.at(step, ends, -1)
    gone = np.cumsum(step[:-1]) > 0
    edge = np.diff(np.concatenate([[0], gone.view(np.int8), [0]]))
    return gone, np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def _finished(texts: pa.Array, spans: pa.Array, p: RepeatParams) -> list[pa.Array]:
    """Columns of OUT for some texts and their lists of spans (null: none)."""
    buf, off = N.utf8(texts)
    edge = spans.offsets.to_numpy()
    flat = spans.values
    begins, ends = flat.field("a").to_numpy(), flat.field("b").to_numpy()
    some = np.diff(edge) > 0
    units, removed, clean, a_of, b_of, runs = [], [], [], [], [], []
    for i in range(len(texts)):
        data = buf[off[i]:off[i + 1]]
        words = data.tobytes().split() if p.unit == "words" else None      # on ASCII blanks
        n = len(data) if words is None else len(words)
        units.append(n)
        if not some[i]:
            removed.append(0)
            runs.append(0)
            clean.append(data.tobytes() if words is None else b" ".join(words))
            continue
        first, last = begins[edge[i]:edge[i + 1]], ends[edge[i]:edge[i + 1]]
        if (last == WHOLE).any():
            first, last = (np.array([0]), np.array([n])) if n >= p.window else (first[:0], last[:0])
        gone, a, b = _cut(n, first, last)
        removed.append(int(gone.sum()))
        runs.append(len(a))
        a_of.append(a)
        b_of.append(b)
        clean.append(data[~gone].tobytes() if words is None else b" ".join([w for w, g in zip(words, gone.tolist()) if not g]))
    pair = pa.StructArray.from_arrays([pa.array(np.concatenate(x) if x else np.zeros(0), pa.int32()) for x in (a_of, b_of)], names=["a", "b"])
    lists = pa.ListArray.from_arrays(pa.array(N.starts_of(np.array(runs, np.int64)).astype(np.int32)), pair)
    return [pa.array(units, pa.int64()), pa.array(removed, pa.int64()), lists, pa.array(clean, pa.binary())]


def remove_repeats(docs: DataFrame, id_col: str, text_col: str, p: RepeatParams, kernel: Kernel) -> DataFrame:
    """``docs`` with ``n_units`` (symbols), ``n_removed``, ``removed_spans``
    (maximal, from a to before b) and ``clean`` (the rest, UTF-8 bytes; words
    are joined by one space)."""
    small_batches(docs.sparkSession)
    docs = without(docs, *OUT)
    text = F.coalesce(F.col(text_col), F.lit(""))
    keyed = (docs.withColumn("__d", F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)))
                 .withColumn("__t", F.xxhash64(text)))
    spans = stored(repeated_spans(keyed.select(F.col("__d").alias("d"), F.col("__t").alias("t"), text.alias("text")), p, kernel)
                   .toDF("__id", "__hash", "__spans"), "spans")
    may = may_contain(docs.sparkSession, bloom_words(spans, "__id", spans.count()))
    flagged = keyed.withColumn("__may", may(F.col("__d")))
    hit = flagged.filter("__may").join(spans, (F.col("__d") == F.col("__id")) & (F.col("__t") == F.col("__hash")), "left").drop("__id", "__hash")
    rest = flagged.filter("NOT __may").withColumn("__spans", F.lit(None).cast(spans.schema["__spans"].dataType))
    both = hit.unionByName(rest)
    kind = "n_units long, n_removed long, removed_spans array<struct<a:int,b:int>>, clean binary"
    names = docs.columns
    at = names.index(text_col)

    def finish(batches):
        for batch in batches:
            off = N.utf8(batch.column(at))[1]
            for i, j in N.groups(off, PART):                 # a bounded part of the batch at a time
                part = batch.slice(i, j - i)
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], *_finished(part.column(at), part.column(len(names)), p)],
                                                 names=[*names, *OUT])

    slim = both.select(*names, "__spans")
    schema = T.StructType([*docs.schema.fields, *T._parse_datatype_string(kind).fields])
    return slim.mapInArrow(finish, schema)
