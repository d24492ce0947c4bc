"""MinHash near-duplicates with min-max signatures.

Every permutation of the shingle hashes gives two signature values, its
minimum and its maximum: ``2 * perms`` values for ``perms`` hash evaluations.
Bands of ``rows`` values propose candidates, and every candidate is confirmed on
the full shingle sets.

Documents with equal sets form a class first, and only classes take part in
banding, so a group of copies is one node.  Bands are swept a few at a time.  In
a bucket, one class of each component known so far is held against that of the
first component (a star, not all pairs), and the confirmed links merge components
before the next sweep, so a group of near copies soon is one row in each bucket.
In buckets whose classes still lie in several components, the classes outside the
largest one there are then pivots that meet all others: at once if they are no more
than ``PIVOTS``, else pass by pass, eight times as many in each, until no bucket holds
an untested pair of classes of different components.  Before that a bucket of more than ``SPLIT`` classes
is split without loss: two sets as similar as asked for share one of their rarest
shingles (of ``n`` shingles, in one order for all sets, the first
``n - ceil(n * percent / 100) + 1``; the smaller set of the two has it among its first
``n - ceil(2 * n * percent / (100 + percent)) + 1``, its core), so its classes are dealt by
these into buckets of their own, in which only core rows are pivots.  Documents that
share no more than a common passage, or a template but too little of it, so never meet.
Pairs inside one component need no test, and pairs that set sizes or the places of the
shared shingle rule out are never made.

At a similarity of 0.8, a band of 6 values agrees with probability 0.26; 55 bands
all miss a pair with probability 6e-8.

Defined results: a text without words (null, empty) has no shingles and is
linked with nothing; a text with fewer words than a shingle has one shingle, its
whole sequence; rows repeated with one identifier and text are one class, and classes
whose smallest identifier is the same are one node; a null identifier is linked
with nothing, its component is null and it is kept; an empty table gives an
empty result; a very long text is one row with one set, hashed in pieces; identifiers
are taken as longs; no other column of the input is read, whatever its name.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusflow.llm import numerics as N
from corpusflow.llm.bloom import rows_with_ids, rows_without_ids
from corpusflow.llm.graph import stars
from corpusflow.llm.store import SMALL, Grown, looked_up, stored, summed
from corpusflow.session import small_batches

PART = 1 << 18           # bytes of text worked on at once
FIRST_SWEEP = 3          # bands worked on at first
SWEEP = 52               # bands worked on together after that: every sweep has passes of its own, however small
SPLIT = 32               # classes of a bucket; a larger one is split by rare shingles
PIVOTS = 256             # of a bucket in the first later pass, then eight times as many in each
ORDER_BITS = 18          # shingles are counted in 2 ** ORDER_BITS cells, to put rare ones first


@dataclass(frozen=True)
class MinHashParams:
    words: int = 5            # of a shingle
    percent: int = 80         # linked when 100 * intersection >= percent * union
    perms: int = 165
    rows: int = 6             # signature values of a band

    @property
    def bands(self) -> int:
        return 2 * self.perms // self.rows


def shingle_sets(buf: np.ndarray, off: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each document, sorted, and their number."""
    h, words = N.word_hashes(buf, off, lower=True)
    at = N.starts_of(words)[:-1]
    full = np.where(words >= k, words - k + 1, 0)
    g = N.windows(h, k)[N.ragged_index(at, full)]
    doc = np.repeat(np.arange(len(words)), full)
    few = np.flatnonzero((words > 0) & (words < k))
    if len(few):
        g = np.concatenate([g, *[N.windows(h[at[i]:at[i] + words[i]], int(words[i])) for i in few]])
        doc = np.concatenate([doc, few])
    order = np.lexsort((g, doc))
    g, doc = g[order], doc[order]
    new = np.ones(len(g), bool)
    new[1:] = (g[1:] != g[:-1]) | (doc[1:] != doc[:-1])
    return g[new], np.bincount(doc[new], minlength=len(words))


def _band_keys(g: np.ndarray, counts: np.ndarray, p: MinHashParams) -> np.ndarray:
    """Band keys of the documents with shingles, one row each."""
    first = N.starts_of(counts)[:-1]
    rng = np.random.default_rng(p.perms)
    mult = rng.integers(1, 1 << 62, p.perms, dtype=np.uint64) * N.U(2) + N.U(1)
    add = rng.integers(0, 1 << 63, p.perms, dtype=np.uint64)
    low, high = (np.empty((len(counts), p.perms), N.U) for _ in range(2))
    for j in range(p.perms):
        x = g * mult[j] + add[j]
        low[:, j] = np.minimum.reduceat(x, first)
        high[:, j] = np.maximum.reduceat(x, first)
    sign = np.concatenate([low, high], axis=1)
    bands = sign.shape[1] // p.rows
    keys = np.zeros((len(counts), bands), N.U)
    for r in range(p.rows):
        keys += N.mix(sign[:, r:bands * p.rows:p.rows]) * N._MULT[r]
    return N.mix(keys + np.arange(bands, dtype=N.U) * N.U(0x9E3779B97F4A7C15))


def _signatures(docs: DataFrame, p: MinHashParams) -> DataFrame:
    """id, n, d1, d2 (128-bit digest of the set), keys of the bands."""
    def run(batches):
        for batch in batches:
            buf, off = N.utf8(batch.column(1))
            for i, j in N.groups(off, PART):
                g, counts = shingle_sets(buf[off[i]:off[j]], off[i:j + 1] - off[i], p.words)
                have = np.flatnonzero(counts)
                digest = np.zeros((2, j - i), N.U)
                size = np.zeros(j - i, np.int64)
                flat = np.zeros(0, N.U)
                if len(have):
                    first = N.starts_of(counts[have])[:-1]
                    for s in range(2):
                        digest[s, have] = np.add.reduceat(N.mix(g + N.U(0xC2B2AE3D27D4EB4F * (s + 1) % (1 << 64))), first)
                    keys = _band_keys(g, counts[have], p)
                    size[have] = keys.shape[1]
                    flat = keys.ravel()
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(i, j - i), pa.array(counts, pa.int64()),
                     pa.array(digest[0].view(np.int64)), pa.array(digest[1].view(np.int64)),
                     N.list_array(flat.view(np.int64), size, pa.int64())], names=["id", "n", "d1", "d2", "keys"])

    return docs.mapInArrow(run, "id long, n long, d1 long, d2 long, keys array<long>")


def _sets(docs: DataFrame, p: MinHashParams) -> DataFrame:
    def run(batches):
        for batch in batches:
            buf, off = N.utf8(batch.column(1))
            for i, j in N.groups(off, PART):
                g, counts = shingle_sets(buf[off[i]:off[j]], off[i:j + 1] - off[i], p.words)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(i, j - i), N.list_array(g.view(np.int64), counts, pa.int64())],
                    names=["id", "shingles"])

    return docs.mapInArrow(run, "id long, shingles array<long>")


def _order(sets: DataFrame) -> np.ndarray:
    """How often the shingles of each cell occur: 2 ** ORDER_BITS numbers at any size."""
    cell = F.col("g").bitwiseAND(F.lit((1 << ORDER_BITS) - 1))
    rows = sets.select(F.explode("shingles").alias("g")).groupBy(cell.alias("cell")).count().toPandas()
    counts = np.zeros(1 << ORDER_BITS, np.int64)
    counts[rows["cell"].to_numpy(np.int64)] = rows["count"].to_numpy(np.int64)
    return counts


def _rare_shingles(sets: DataFrame, p: MinHashParams) -> DataFrame:
    """key, id, n, at (the place in the order), core: the shingles of which similar
    sets share one, rare ones first."""
    spark = sets.sparkSession
    shared = spark.sparkContext.broadcast(_order(sets))

    def run(batches):
        counts = shared.value
        for batch in batches:
            lists = batch.column(1)
            off = np.asarray(lists.offsets, np.int64)
            flat = lists.values.to_numpy(zero_copy_only=False)
            for i, j in N.groups(off, PART):
                g, n = flat[off[i]:off[j]], np.diff(off[i:j + 1])
                doc = np.repeat(np.arange(j - i), n)
                g = g[np.lexsort((g, counts[g & (len(counts) - 1)], doc))]
                take = np.where(n > 0, n - (n * p.percent + 99) // 100 + 1, 0)
                of = np.repeat(np.arange(j - i), take)
                ids = batch.column(0).slice(i, j - i).take(pa.array(of))
                place = N.ragged_index(np.zeros(len(n), np.int64), take)
                core = n - (2 * n * p.percent + 99 + p.percent) // (100 + p.percent) + 1
                yield pa.RecordBatch.from_arrays(
                    [pa.array(g[N.ragged_index(N.starts_of(n)[:-1], take)]), ids, pa.array(n[of]), pa.array(place),
                     pa.array(place < core[of])], names=["key", "id", "n", "at", "core"])

    return sets.select("id", "shingles").mapInArrow(run, "key long, id long, n long, at long, core boolean")


class _Links:
    """Candidate pairs tested so far and the components of the links among them.
    The full set of a document is made when a pair first asks for it."""

    def __init__(self, docs: DataFrame, p: MinHashParams):
        spark = docs.sparkSession
        self.docs, self.p = docs, p
        self.sets = Grown(spark, "id long, shingles array<long>", "sets")
        self.tested = Grown(spark, "a long, b long", "tested")
        self.comp, self.n_comp = spark.sql("SELECT 0L AS node, 0L AS component WHERE false"), 0

    def with_component(self, rows: DataFrame) -> DataFrame:
        return (rows.join(looked_up(self.comp, self.n_comp), rows["id"] == self.comp["node"], "left")
                    .select(*rows.columns, F.coalesce("component", "id").alias("c")))

    def sets_of(self, ids: DataFrame) -> DataFrame:
        """The sets made so far, those of ``ids`` among them."""
        if self.sets.parts:
            ids = ids.join(looked_up(self.sets.rows().select("id"), self.sets.n), "id", "left_anti")
        new, (n,) = summed(ids, "ids")
        if n:
            self.sets.add(_sets(rows_with_ids(self.docs, "id", new, n).select("id", "text"), self.p))
        return self.sets.rows()

    def test(self, pairs: DataFrame) -> None:
        """Test the pairs (a, b) that are new and merge the components of links."""
        pairs = pairs.distinct()
        if self.tested.parts:
            pairs = pairs.join(looked_up(self.tested.rows(), self.tested.n), ["a", "b"], "left_anti")
        todo, n = self.tested.add(pairs)
        if not n:
            return
        sets = self.sets_of(todo.select(F.explode(F.array("a", "b")).alias("id")).distinct())
        ends = {x: sets.select(F.col("id").alias(x), F.col("shingles").alias(f"s{x}")) for x in "ab"}
        # b is the pivot of many pairs: few enough go to its set, and then each to the set of its a
        first, then = ("b", "a") if n <= SMALL else ("a", "b")
        both = ends[first].join(looked_up(todo, n), first).join(ends[then], then)
        shared = F.size(F.array_intersect("sa", "sb")).cast("long")
        more, (n,) = summed(both.withColumn("m", shared)
                                .filter(100 * F.col("m") >= self.p.percent * (F.size("sa") + F.size("sb") - F.col("m")))
                                .select("a", "b"), "links")
        if n:
            so_far = self.comp.select(F.col("node").alias("a"), F.col("component").alias("b"))
            self.comp, self.n_comp = stars(so_far.union(more), self.n_comp + n)


def _several(tagged: DataFrame, size: Column) -> tuple[DataFrame, int]:
    """Keys that hold several components, with the first one and ``size``; stored, with
    their number."""
    keys = tagged.groupBy("key").agg(F.min("c").alias("lo"), F.max("c").alias("hi"), size.alias("size"))
    found, (n,) = summed(keys.filter("lo < hi").select("key", "lo", "size"), "several")
    return found, n


def _star(reps: DataFrame, n_keys: int, p: MinHashParams) -> DataFrame:
    """In each bucket the class of every component against that of the first one."""
    first = reps.filter("c = lo").select("key", F.struct("id", "n").alias("pivot"))
    return _pairs(reps.filter("c <> lo").join(looked_up(first, n_keys), "key"), p)


def _pairs(against: DataFrame, p: MinHashParams) -> DataFrame:
    fits = 100 * F.least("n", "pivot.n") >= p.percent * F.greatest("n", "pivot.n")     # else the sizes rule it out
    return against.filter(fits).select(F.greatest("id", "pivot.id").alias("a"), F.least("id", "pivot.id").alias("b"))


def near_duplicate_links(docs: DataFrame, classes: DataFrame, p: MinHashParams) -> tuple[DataFrame, int]:
    """Components of ``classes`` (id, n, keys): ``node``, ``component`` for
    the ids that are linked with a smaller one, and their number."""
    found = _Links(docs, p)
    swept, at = [], 0
    while at < p.bands:
        size = FIRST_SWEEP if at == 0 else SWEEP      # the first one has nothing to contract yet
        bands = found.with_component(classes.select("id", "n", F.slice("keys", at + 1, size).alias("keys")))
        bands = bands.select("id", "n", "c", F.explode("keys").alias("key"))
        keys, n = _several(bands, F.count(F.lit(1)))
        at += size
        if n:
            # one class (id, n) of each component in each bucket, however many classes it has there
            reps = (bands.join(looked_up(keys.select("key", "lo"), n), "key").groupBy("key", "lo", "c")
                         .agg(F.min(F.struct("id", "n")).alias("r"), F.count(F.lit(1)).alias("m")))
            reps = stored(reps.select("key", "lo", "c", "r.id", "r.n", "m"), "buckets")
            found.test(_star(reps, n, p))
            swept.append(reps.select("key", "id", "m"))
    if not swept:
        return found.comp, found.n_comp
    # buckets that still hold several components
    sizes, n = _several(found.with_component(reduce(DataFrame.union, swept)), F.sum("m"))
    if not n:
        return found.comp, found.n_comp
    rows = classes.select("id", "n", F.explode("keys").alias("key")).join(looked_up(sizes.select("key", "size"), n), "key")
    rows = stored(rows, "rows")
    hot, (n,) = summed(rows.filter(F.col("size") > SPLIT).select("id").distinct(), "hot")
    rows = rows.filter(F.col("size") <= SPLIT).select("key", "id", "n", F.lit(0).cast("long").alias("at"), F.lit(True).alias("core"))
    if n:
        sets = found.sets_of(hot).join(looked_up(hot, n), "id", "left_semi")
        rows = rows.union(stored(_rare_shingles(sets, p), "rare"))
    pivots_now = PIVOTS
    while True:
        tagged = found.with_component(rows)
        parts = tagged.groupBy("key", "c").agg(F.count(F.lit(1)).alias("k"), F.max("core").alias("core"))
        still = (parts.groupBy("key").agg(F.max(F.struct("k", "c")).alias("most"), F.sum("k").alias("all"), F.max("core").alias("any"))
                      .select("key", F.col("most.c").alias("main"), (F.col("all") - F.col("most.k")).alias("others"), "any")
                      .filter("others > 0 AND any").drop("any"))
        many = F.col("others") > pivots_now
        tagged, (n, left) = summed(tagged.join(still, "key"), "open", F.count_if(many))
        if not n:
            return found.comp, found.n_comp
        # a pair of different components has one outside the main one; a shared shingle is core in one of the two
        slot = F.when(many, F.pmod(F.xxhash64("id"), F.lit(pivots_now))).otherwise(F.col("id"))
        pivots = (tagged.filter("c <> main").groupBy("key", slot.alias("slot")).agg(F.max(F.struct("c", "id", "n", "at", "core")).alias("pivot"))
                        .select("key", "pivot"))
        near = ((100 + p.percent) * F.least(F.col("n") - F.col("at"), F.col("pivot.n") - F.col("pivot.at"))
                >= p.percent * (F.col("n") + F.col("pivot.n")))      # else too few shingles are left from here on
        meet = (F.col("c") != F.col("pivot.c")) & (F.col("core") | F.col("pivot.core")) & near
        found.test(_pairs(tagged.join(pivots, "key").filter(meet), p))
        if not left:
            return found.comp, found.n_comp
        used = pivots.select("key", F.col("pivot.id").alias("id"))
        rows = tagged.filter(many).select(*rows.columns).join(used, ["key", "id"], "left_anti")
        pivots_now *= 8


def near_duplicate_ids(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                       params: MinHashParams = MinHashParams()) -> DataFrame:
    """One row for each row of ``docs``: its identifier, ``n_shingles`` (size of
    its set), ``component_id`` (the smallest identifier that links reach) and
    ``kept`` (that identifier is its own)."""
    small_batches(docs.sparkSession)
    slim = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    sig = stored(_signatures(slim, params), "signatures")
    named = sig.filter("n > 0 AND id IS NOT NULL")
    digest = ["d1", "d2", "n"]
    first = named.groupBy(*digest).agg(F.min(F.struct("id", "keys")).alias("first"))      # equal sets have equal keys
    classes = stored(first.select(*digest, "first.id", "first.keys"), "classes")
    comp, n = near_duplicate_links(slim, classes.select("id", "n", "keys"), params)
    by_class = (classes.join(looked_up(comp, n), classes["id"] == comp["node"], "left")
                       .select(*digest, F.coalesce("component", "id").alias("c")))
    return (sig.select("id", *digest).join(by_class, digest, "left")
               .select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"),
                       F.when(F.col("id").isNotNull(), F.coalesce("c", "id")).alias("component_id"))
               .withColumn("kept", F.coalesce(F.col(id_col) == F.col("component_id"), F.lit(True))))


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                         params: MinHashParams = MinHashParams()) -> DataFrame:
    """``docs`` without the documents of a group other than its smallest
    identifier; columns and texts are unchanged."""
    found = near_duplicate_ids(docs, id_col, text_col, params)
    gone, (n,) = summed(found.filter(~F.col("kept")).select(F.col(id_col).alias("__gone")).distinct(), "dropped")
    return rows_without_ids(docs, id_col, gone, n)
