"""Cross-tokenizer alignment by merge-path partitioning.

Every text is encoded twice, by a byte-level BPE file (A) and by a piece file (B).
Both token rows cover the same bytes, so aligning them is merging two sorted lists
of token ends: an end that only one side has links two tokens, an end of both
sides links two tokens and closes a group.

Neither tokenizer joins what a single blank between two other characters parts, so
texts are encoded segment by segment there, and a worker keeps the ids of the
segments it has seen, ``KEPT_SEGMENTS`` at most.  (A file for which this does not
hold is given whole texts.)

The documents of a bounded run lie behind each other, hence one merge for all of
them.  Its path is cut at every ``PIECE``-th diagonal: a binary search, for all
diagonals at once, finds how many A and B ends lie before each cut.  The pieces
have equal work and need nothing of each other; they are merged in lockstep, one
vectorised step for the k-th element of every piece.  A common end whose two sides
fall into neighbouring pieces is stitched afterwards: the second one makes no link
and the group ends there.

An id pair's count is the number of documents (rows) that hold it linked.  Tasks
emit the distinct pairs of each document with their number of links; the counts
are a grouped sum, and come back to the documents by a join that is a broadcast
only while the table of pairs is below ``BROADCAST_PAIRS``; beyond it Spark
shuffles the pairs.

Defined results: a text that is null, empty, or not given back byte by byte by both
tokenizers (behind one leading blank) has no tokens, hence zeros, and its digest is
the empty string; strings that look like special tokens are ordinary text; very long
texts make a run of their own, with memory in proportion to the text; rows
repeated are documents of their own, one result each, null identifiers too; an
empty table gives an empty result; no column but the identifier and the text is
read, whatever its name.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusflow.llm import numerics as N
from corpusflow.llm.pieces import load_pieces
from corpusflow.llm.store import stored

PIECE = 256                   # merged ends of one piece
KEPT_SEGMENTS = 1 << 19       # whose ids a worker remembers
BROADCAST_PAIRS = 2_000_000   # rows of the pair table up to which it is broadcast
TIE_COLUMNS = "n_a long, n_b long, n_groups long, n_links long, groups_sha256 string"


# --- token bytes -------------------------------------------------------------

@lru_cache(maxsize=1)
def byte_letters() -> dict[str, int]:
    """The letter by which a byte-level vocabulary writes each byte: printable
    Latin-1 stands for itself, the others follow from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(0x100 + i): b for i, b in enumerate(rest)}


class ByteLevel:
    """Tokenizer A: ids of blank + text, and the bytes of every id."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"        # Spark has the cores
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        self.tok.encode_special_tokens = True
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab, before = spec["model"]["vocab"], spec["pre_tokenizer"] or {}
        self.separable = (spec["normalizer"] is None and before.get("type") == "ByteLevel" and before.get("use_regex", True)
                          and not before.get("add_prefix_space") and all(t["special"] for t in spec["added_tokens"]))
        letters = byte_letters()
        self.surface = [b""] * self.tok.get_vocab_size()
        for entry, i in vocab.items():
            self.surface[i] = bytes(letters[c] for c in entry) if all(c in letters for c in entry) else b""

    def ids(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tok.encode_batch_fast([" " + t for t in texts], add_special_tokens=False)]


class Pieces:
    """Tokenizer B: ids of the text, which gets its leading blank from the file."""

    def __init__(self, path: str):
        import sentencepiece

        self.sp = sentencepiece.SentencePieceProcessor(model_file=path)
        self.surface = [self._bytes(i) for i in range(self.sp.get_piece_size())]
        try:
            table = load_pieces(path)
            self.separable = table.dummy_prefix and not table.crossing
        except ValueError:                # a normaliser that may look over blanks
            self.separable = False

    def _bytes(self, i: int) -> bytes:
        piece = self.sp.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if self.sp.is_byte(i) else piece.replace("▁", " ").encode()

    def ids(self, texts: list[str]) -> list[list[int]]:
        return self.sp.encode(texts, num_threads=1) if texts else []


# --- merge path --------------------------------------------------------------

def diagonal_cuts(a: np.ndarray, b: np.ndarray, piece: int) -> tuple[np.ndarray, np.ndarray]:
    """How many elements of ``a`` and ``b`` lie before each ``piece``-th step of
    their merge (equal elements: ``a`` first), all diagonals searched together."""
    steps = np.minimum(np.arange(0, len(a) + len(b) + piece, piece), len(a) + len(b))
    low, high = np.maximum(0, steps - len(b)), np.minimum(steps, len(a))
    while True:
        open_ = low < high
        if not open_.any():
            return low, steps - low
        mid = (low + high) // 2
        j = steps - mid - 1                               # is a[mid] among the first `steps`?
        inside = open_.copy()
        inside[open_] = a[mid[open_]] <= b[j[open_]]
        low = np.where(inside, mid + 1, low)
        high = np.where(open_ & ~inside, mid, high)


def merge_path(a: np.ndarray, b: np.ndarray, piece: int = PIECE) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Merge of two strictly rising lists: for each step the ``a`` and ``b`` index
    it stands at, its value, and whether it repeats the value of the step before."""
    ca, cb = diagonal_cuts(a, b, piece)
    i, j, stop_a, stop_b = ca[:-1].copy(), cb[:-1].copy(), ca[1:], cb[1:]
    pieces = len(i)
    at_a, at_b, end = (np.zeros((pieces, piece), np.int64) for _ in range(3))
    top = np.int64(np.iinfo(np.int64).max)
    a_, b_ = np.append(a, top), np.append(b, top)
    for k in range(piece):
        x = np.where(i < stop_a, a_[i], top)
        y = np.where(j < stop_b, b_[j], top)
        at_a[:, k], at_b[:, k], end[:, k] = i, j, np.minimum(x, y)
        first = x <= y
        i += first & (i < stop_a)
        j += ~first & (j < stop_b)
    again = np.zeros((pieces, piece), bool)
    again[:, 1:] = end[:, 1:] == end[:, :-1]
    again[1:, 0] = end[1:, 0] == end[:-1, -1]            # a common end over the edge of two pieces
    total = len(a) + len(b)                              # only the last piece may be short
    return at_a.ravel()[:total], at_b.ravel()[:total], end.ravel()[:total], again.ravel()[:total]


# --- one run of documents ----------------------------------------------------

_CUT = re.compile(r"(?<=\S) (?=\S)")


def segments_of(text: str) -> list[str]:
    """The text cut at every single blank between two other characters."""
    return _CUT.split(text)


class Encoded:
    """Ids of segments under both tokenizers, and whether both give them back."""

    def __init__(self, a: ByteLevel, b: Pieces):
        self.a, self.b = a, b
        self.separable = a.separable and b.separable
        self._forget()

    def _forget(self):
        self.place: dict[str, int] = {}
        self.good = np.zeros(0, bool)
        self.count, self.flat = [np.zeros(0, np.int64)] * 2, [np.zeros(0, np.int32)] * 2

    def cut(self, texts: list[str]) -> list[list[str]]:
        if not self.separable:
            return [[t] for t in texts]
        plain = [t.split(" ") for t in texts]       # right unless blanks meet other white space
        loose = {s for s in set(chain.from_iterable(plain)) if not s or s[-1].isspace()}
        return plain if not loose else [p if loose.isdisjoint(p) else segments_of(t) for t, p in zip(texts, plain)]

    def learn(self, segments: set[str]):
        new = list(segments - self.place.keys())
        if len(self.place) + len(new) > KEPT_SEGMENTS:
            self._forget()
            new = list(segments)
        for i in range(0, len(new), KEPT_SEGMENTS // 8):
            part = new[i:i + KEPT_SEGMENTS // 8]
            ids = self.a.ids(part), self.b.ids(part)
            wanted = [b" " + s.encode() for s in part]
            good = [b"".join(map(self.a.surface.__getitem__, x)) == w and b"".join(map(self.b.surface.__getitem__, y)) == w
                    for w, x, y in zip(wanted, *ids)]
            self.place.update(zip(part, range(len(self.place), len(self.place) + len(part))))
            self.good = np.append(self.good, good)
            for k in range(2):
                self.count[k] = np.append(self.count[k], np.array([len(x) for x in ids[k]], np.int64))
                self.flat[k] = np.append(self.flat[k], np.fromiter(chain.from_iterable(ids[k]), np.int32))
        self.start = [N.starts_of(c) for c in self.count]

    def encode(self, texts: list[str]):
        """Places of the texts that both tokenizers give back; for A and for B
        their ids behind each other and their number in each text."""
        have = np.array([k for k, t in enumerate(texts) if t], np.int64)
        cut = self.cut([texts[k] for k in have])
        self.learn(set(chain.from_iterable(cut)))
        sizes = np.array([len(c) for c in cut], np.int64)
        at = np.fromiter(map(self.place.__getitem__, chain.from_iterable(cut)), np.int64, int(sizes.sum()))
        if not len(have):
            return have, [], []
        fine = np.logical_and.reduceat(self.good[at], N.starts_of(sizes)[:-1])
        at, sizes = at[np.repeat(fine, sizes)], sizes[fine]
        edge = N.starts_of(sizes)
        ids, counts = [], []
        for k in range(2):
            n = self.count[k][at]
            ids.append(self.flat[k][N.ragged_index(self.start[k][at], n)].astype(np.int64))
            counts.append(np.diff(N.starts_of(n)[edge]))
        return have[fine], ids, counts


class Aligner:
    def __init__(self, path_a: str, path_b: str):
        a, b = ByteLevel(path_a), Pieces(path_b)
        self.encoded = Encoded(a, b)
        self.size_a, self.size_b = (np.array([len(s) for s in t.surface], np.int64) for t in (a, b))
        names = [str(i).encode() + b"," for i in range(max(len(self.size_a), len(self.size_b)))]
        self.name = np.frombuffer(b"".join(names), np.uint8)
        self.name_size = np.array([len(x) for x in names], np.int64)
        self.name_at = N.starts_of(self.name_size)[:-1]

    def align(self, texts: list[str]) -> dict:
        """Columns of TIE_COLUMNS, ``pairs`` and ``links`` for the texts."""
        at, ids, counts = self.encoded.encode(texts)
        n = len(texts)
        out = {c: np.zeros(n, np.int64) for c in ("n_a", "n_b", "n_groups", "n_links")} | {"groups_sha256": [""] * n}
        pair_counts = np.zeros(n, np.int64)
        if not len(at):
            return out | {"pairs": np.zeros(0, np.int64), "links": np.zeros(0, np.int64), "pair_counts": pair_counts}
        (a, b), (counts_a, counts_b) = ids, counts
        step_a, step_b, _, again = merge_path(np.cumsum(self.size_a[a]), np.cumsum(self.size_b[b]))
        link = np.flatnonzero(~again)
        la, lb = step_a[link], step_b[link]
        tie = np.flatnonzero(again) - 1                  # the A side of every common end
        group_a, group_b = step_a[tie] + 1, step_b[tie] + 1      # tokens up to the end of each group
        doc_a, doc_b = N.starts_of(counts_a), N.starts_of(counts_b)
        doc = np.searchsorted(doc_a, la, "right") - 1
        groups_upto = np.searchsorted(group_a, doc_a[1:], "right")
        out["n_a"][at], out["n_b"][at] = counts_a, counts_b
        out["n_groups"][at] = np.diff(groups_upto, prepend=0)
        out["n_links"][at] = np.bincount(doc, minlength=len(at))
        for k, digest in zip(at, self._digests(a, b, group_a, group_b, doc_a + doc_b)):
            out["groups_sha256"][k] = digest
        shift = (len(self.size_a) * len(self.size_b)).bit_length()
        if shift + len(at).bit_length() > 63:
            raise ValueError("vocabularies too large for one key")
        key, links = np.unique((doc << shift) + a[la] * len(self.size_b) + b[lb], return_counts=True)
        pair_counts[at] = np.bincount(key >> shift, minlength=len(at))
        return out | {"pairs": key & ((1 << shift) - 1), "links": links, "pair_counts": pair_counts}

    def _digests(self, a, b, group_a, group_b, doc_tokens):
        """SHA-256 of each document's groups, written as ``a1,a2|b1;a3|b2,b3``."""
        begin_b = np.concatenate([[0], group_b[:-1]])
        n_a = np.diff(group_a, prepend=0)
        n_b = np.diff(group_b, prepend=0)
        order = np.empty(len(a) + len(b), np.int64)
        order[np.arange(len(a)) + np.repeat(begin_b, n_a)] = a
        order[np.arange(len(b)) + np.repeat(group_a, n_b)] = b
        mark = np.full(len(order), ord(","), np.uint8)
        mark[group_a + begin_b - 1] = ord("|")
        mark[group_a + group_b - 1] = ord(";")
        for k, end in zip(doc_tokens[:-1], doc_tokens[1:]):
            sha = hashlib.sha256()
            for i in range(k, end, N.CHUNK // 8):
                j = min(i + N.CHUNK // 8, end)
                size = self.name_size[order[i:j]]
                text = self.name[N.ragged_index(self.name_at[order[i:j]], size)]
                text[np.cumsum(size) - 1] = mark[i:j]
                sha.update((text[:-1] if j == end else text).tobytes())
            yield sha.hexdigest()


_ALIGNERS: dict[tuple[str, str], Aligner] = {}          # of this Python worker


def _aligner(path_a: str, path_b: str) -> Aligner:
    if (path_a, path_b) not in _ALIGNERS:
        _ALIGNERS.clear()
        _ALIGNERS[path_a, path_b] = Aligner(path_a, path_b)
    return _ALIGNERS[path_a, path_b]


# --- Spark -------------------------------------------------------------------

def aligned(docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: identifier, counts, digest of the groups, and the distinct linked
    id pairs (``a * vocabulary of B + b``) with their number of links."""
    slim = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))

    def run(batches):
        work = _aligner(path_a, path_b)
        for batch in batches:
            off = N.utf8(batch.column(1))[1]
            for i, j in N.groups(off):
                texts = [t or "" for t in batch.column(1).slice(i, j - i).to_pylist()]
                got = work.align(texts)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(i, j - i), *[pa.array(got[c]) for c in ("n_a", "n_b", "n_groups", "n_links")],
                     pa.array(got["groups_sha256"], pa.string()),
                     N.list_array(got["pairs"], got["pair_counts"], pa.int64()),
                     N.list_array(got["links"].astype(np.int32), got["pair_counts"], pa.int32())],
                    names=["id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pairs", "links"])

    kind = slim.schema["id"].dataType.simpleString()
    return slim.mapInArrow(run, f"id {kind}, {TIE_COLUMNS}, pairs array<long>, links array<int>")


def pair_table(pairs: DataFrame, base: int) -> DataFrame:
    """``pair``, ``docs`` (number of rows of ``pairs`` with it) and ``best``
    (that number is the highest of its A id, ties included)."""
    counts = stored(pairs.groupBy("pair").agg(F.count(F.lit(1)).alias("docs")), "pair-counts")
    a_id = F.expr(f"pair div {base}L")
    top = counts.groupBy(a_id.alias("a")).agg(F.max("docs").alias("top"))
    return stored(counts.withColumn("a", a_id).join(top, "a")
                        .select("pair", "docs", (F.col("docs") == F.col("top")).alias("best")), "pairs")


def cross_alignment(docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text",
                    broadcast_pairs: int = BROADCAST_PAIRS) -> DataFrame:
    """One row for each row of ``docs``: identifier, ``n_a``, ``n_b``,
    ``n_groups``, ``n_links``, ``n_best`` (links whose pair has the highest count
    of its A id), ``count_sum`` (of the counts of all links), ``groups_sha256``."""
    base = len(Pieces(path_b).surface)
    rows = stored(aligned(docs, path_a, path_b, id_col, text_col).withColumn("row", F.monotonically_increasing_id()), "aligned")
    linked = rows.select("row", F.explode(F.arrays_zip("pairs", "links")).alias("z")).select(
        "row", F.col("z.pairs").alias("pair"), F.col("z.links").alias("links"))
    table = pair_table(linked.select("pair"), base)
    if table.count() <= broadcast_pairs:
        table = F.broadcast(table)
    sums = (linked.join(table, "pair").groupBy("row")
                  .agg(F.sum(F.when(F.col("best"), F.col("links")).otherwise(0)).alias("n_best"),
                       F.sum(F.col("links") * F.col("docs")).alias("count_sum")))
    none = F.lit(0).cast("long")
    return (rows.drop("pairs", "links").join(sums, "row", "left")
                .select(F.col("id").alias(id_col), "n_a", "n_b", "n_groups", "n_links",
                        F.coalesce("n_best", none).alias("n_best"), F.coalesce("count_sum", none).alias("count_sum"),
                        "groups_sha256"))


def default_files() -> tuple[str, str]:
    """Paths of the public byte-level and piece files, where their package is installed."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
