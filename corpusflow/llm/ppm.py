"""Language-model scoring by prediction by partial matching (PPM).

A text is its words, lower-cased in A-Z, and one end: the words' bytes, a blank after
each, and an end symbol.  Contexts are the last ``ORDER`` bytes, over word ends too,
back to the start of the text.

The trie is a table of (context, symbol) counts over all training texts.  A node
with n symbols seen, d of them distinct, gives a symbol seen c times
(c - 1/2) / n and escapes with d / 2n (method D) to the next shorter context, from
which the node's own symbols are excluded: their share is taken out and the
rest scaled up, so a node's probabilities add up to one.  Below the empty
context all symbols are equally likely.  Nodes whose last two bytes agree are
worked on together; the two shortest orders, 65,536 counts at most, are broadcast.

Documents are read once, a cell (a bounded run of rows) at a time, and become lists
of word numbers.  A cell asks for each of its words and contexts once: the
questions go to buckets by content, packed in arrays, the counts of all cells are
added there, and the answers go back in the order of the question.

Defined results: a null text counts as empty, that is one end; a null identifier
counts as the empty text for the training split; repeated rows are scored alike;
without any training text all symbols are equally likely; an empty table gives an
empty result; only the identifier and the text are read, whatever other columns
there are.
"""

from __future__ import annotations

import zlib
from collections import defaultdict

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusflow.llm import numerics as N
from corpusflow.llm.store import shuffle_partitions, stored

ORDER = 5
CELL_BYTES = 24 << 20
SLOT_BITS = 22
START, WORD_END, TEXT_END = b"\n", b" ", b"\r"     # blanks never occur inside a word
SYMBOLS = 256 - 6 + 2
_TO_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
_FIELDS = [("cell", pa.int64()), ("bucket", pa.int32()), ("doc_id", pa.string()), ("held_out", pa.bool_()), ("ids", pa.list_(pa.int32())),
           ("words", pa.list_(pa.binary())), ("keys", pa.list_(pa.int64())), ("counts", pa.list_(pa.int64()))]
CELLS = "cell long, bucket int, doc_id string, held_out boolean, ids array<int>, words array<binary>, keys array<long>, counts array<long>"
ANSWER = "cell long, bucket int, of_words boolean, answer array<double>"


def _stream(words: list[bytes]) -> bytes:
    return START * ORDER + (WORD_END.join(words) + WORD_END if words else b"") + TEXT_END


def _keys(data: np.ndarray) -> np.ndarray:
    """Key of (context, symbol) at each byte from the ORDER-th on, the symbol lowest."""
    n = len(data) - ORDER
    key = np.zeros(n, np.int64)
    for j in range(ORDER + 1):
        key <<= 8
        key |= data[j:j + n]
    return key


def _slots(key: np.ndarray) -> np.ndarray:
    return ((key.view(N.U) * N.U(0x9E3779B97F4A7C15)) >> N.U(64 - SLOT_BITS)).astype(np.int64)


def _chunks(texts: list[bytes]):
    """(first text, keys, text of each key) of texts of about a megabyte together.
    The windows over a text's beginning, whose symbol is a start mark, are left out."""
    i = 0
    while i < len(texts):
        j, size = i, 0
        while j < len(texts) and (size < N.CHUNK or j == i):
            size += len(texts[j])
            j += 1
        data = np.frombuffer(b"".join(texts[i:j]), np.uint8)
        text = np.repeat(np.arange(j - i), [len(t) for t in texts[i:j]])
        for a in range(0, len(data) - ORDER, 4 * N.CHUNK):      # more than one stretch only for a very long text
            key = _keys(data[a:a + 4 * N.CHUNK + ORDER])
            real = (key & 255) != START[0]
            yield i, key[real], text[a + ORDER:a + ORDER + len(key)][real]
        i = j


class KeyCounter:
    """Distinct keys with their number of training occurrences. A key owns the
    slot of a table that it meets empty; the few others are sorted."""

    def __init__(self):
        self.owner = np.full(1 << SLOT_BITS, -1, np.int64)
        self.count = np.zeros(1 << SLOT_BITS, np.int64)
        self.others: list[tuple[np.ndarray, np.ndarray]] = []

    def add(self, key: np.ndarray, train: np.ndarray) -> None:
        slot = _slots(key)
        empty = self.owner[slot] < 0
        self.owner[slot[empty]] = key[empty]
        mine = self.owner[slot] == key
        self.count += np.bincount(slot[mine & train], minlength=len(self.count))
        if not mine.all():
            uniq, at = np.unique(key[~mine], return_inverse=True)
            self.others.append((uniq, np.bincount(at, train[~mine], len(uniq)).astype(np.int64)))

    def result(self) -> tuple[np.ndarray, np.ndarray]:
        at = np.flatnonzero(self.owner >= 0)
        key = np.concatenate([self.owner[at], *[k for k, _ in self.others]])
        uniq, of = np.unique(key, return_inverse=True)
        n = np.concatenate([self.count[at], *[c for _, c in self.others]])
        return uniq, np.bincount(of, n, len(uniq)).astype(np.int64)      # exact below 2 ** 53


class KeyValues:
    """Values of keys, by the same table."""

    def __init__(self, key: np.ndarray, value: np.ndarray):
        order = np.argsort(key)
        self.key, self.value = key[order], value[order]
        slot = _slots(self.key)
        self.owner, self.held = np.full(1 << SLOT_BITS, -1, np.int64), np.zeros(1 << SLOT_BITS)
        self.owner[slot], self.held[slot] = self.key, self.value

    def get(self, key: np.ndarray) -> np.ndarray:
        slot = _slots(key)
        out = self.held[slot]
        other = np.flatnonzero(self.owner[slot] != key)
        out[other] = self.value[np.searchsorted(self.key, key[other])]
        return out


def _key_bucket(key: np.ndarray, buckets: int) -> np.ndarray:
    return ((N.mix(key.view(N.U)) >> N.U(20)) % N.U(buckets)).astype(np.int64)


def _batch(rows: dict) -> pa.RecordBatch:
    n = len(rows["cell"])
    return pa.RecordBatch.from_arrays([pa.array(rows.get(k, [None] * n), t) for k, t in _FIELDS], names=[k for k, _ in _FIELDS])


def _close_cell(cell: int, buckets: int, vocab: dict, names: list, helds: list, doc_ids: list):
    """Rows of a cell: documents (numbers of their words), words and contexts by bucket."""
    words = list(vocab)
    seen = np.zeros(len(words), np.int64)
    for ids, held in zip(doc_ids, helds):
        if not held and len(ids):
            seen += np.bincount(ids, minlength=len(words))
    bucket = np.fromiter((zlib.crc32(w) % buckets for w in words), np.int64, len(words))
    order = np.argsort(bucket, kind="stable")              # a word's number: its place in the buckets' lists
    number = np.empty(len(words), np.int32)
    number[order] = np.arange(len(words), dtype=np.int32)
    sizes = np.bincount(bucket, minlength=buckets)
    edge = N.starts_of(sizes)
    counter = KeyCounter()
    held_of = np.array(helds, bool)
    texts = [_stream([words[i] for i in ids.tolist()]) for ids in doc_ids]
    for i, key, text in _chunks(texts):
        counter.add(key, ~held_of[i + text])
    yield _batch({"cell": [cell] * len(names), "doc_id": names, "held_out": helds, "ids": [number[ids] for ids in doc_ids]})
    have = np.flatnonzero(sizes).tolist()
    yield _batch({"cell": [cell] * len(have), "bucket": have,
                  "words": [[words[i] for i in order[edge[b]:edge[b + 1]].tolist()] for b in have],
                  "counts": [seen[order[edge[b]:edge[b + 1]]] for b in have]})
    key, n = counter.result()
    bucket = _key_bucket(key, buckets)
    order = np.argsort(bucket, kind="stable")
    edge = N.starts_of(np.bincount(bucket, minlength=buckets))
    have = np.flatnonzero(np.diff(edge)).tolist()
    yield _batch({"cell": [cell] * len(have), "bucket": have, "keys": [key[order[edge[b]:edge[b + 1]]] for b in have],
                  "counts": [n[order[edge[b]:edge[b + 1]]] for b in have]})


def _cells(docs: DataFrame, buckets: int) -> DataFrame:
    def run(batches):
        part, serial = TaskContext.get().partitionId(), 0

        def fresh():
            v = defaultdict()
            v.default_factory = v.__len__
            return v, [], [], [], 0

        vocab, names, helds, doc_ids, size = fresh()
        for batch in batches:
            for name, held, text in zip(*(batch.column(i).to_pylist() for i in range(3))):
                data = (text or "").encode().translate(_TO_LOWER)
                words = data.split()                                     # on ASCII blanks
                names.append(name)
                helds.append(held)
                doc_ids.append(np.fromiter(map(vocab.__getitem__, words), np.int32, len(words)))
                size += len(data) + 64
                if size >= CELL_BYTES:
                    yield from _close_cell((part << 32) | serial, buckets, vocab, names, helds, doc_ids)
                    serial += 1
                    vocab, names, helds, doc_ids, size = fresh()
        if names:
            yield from _close_cell((part << 32) | serial, buckets, vocab, names, helds, doc_ids)

    return docs.mapInArrow(run, CELLS)


def _first_orders(pairs: pd.DataFrame) -> np.ndarray:
    """Probabilities of order 1, by (byte, symbol)."""
    n1 = np.zeros((256, 256))
    n1[pairs["pair"].to_numpy() >> 8, pairs["pair"].to_numpy() & 255] = pairs["n"].to_numpy()
    n0 = n1.sum(axis=0)
    d0, all0 = (n0 > 0).sum(), n0.sum()
    p0 = np.full(256, 1 / SYMBOLS) if not all0 else np.where(n0 > 0, n0 - 0.5, 0.5 * d0 / max(1, SYMBOLS - d0)) / all0
    all1, d1 = n1.sum(axis=1, keepdims=True), (n1 > 0).sum(axis=1, keepdims=True)
    free = np.maximum(1 - np.where(n1 > 0, p0, 0).sum(axis=1, keepdims=True), 1e-300)
    with np.errstate(divide="ignore", invalid="ignore"):
        p1 = np.where(n1 > 0, (n1 - 0.5) / all1, 0.5 * d1 / all1 * np.minimum(p0 / free, 1))
    return np.where(all1 > 0, p1, p0)


def _walk_trie(key: np.ndarray, n: np.ndarray, p1: np.ndarray) -> np.ndarray:
    """Probability of each distinct (context, symbol) key of nodes whose last two
    bytes are here complete; ``n``: training counts."""
    below, below_of = p1[(key >> 8) & 255, key & 255], np.arange(len(key))
    for order in range(2, ORDER + 1):
        entry, first, of = np.unique(key & ((1 << 8 * (order + 1)) - 1), return_index=True, return_inverse=True)
        count = np.bincount(of, n, len(entry))
        lower = below[below_of[first]]
        node, at = np.unique(entry >> 8, return_inverse=True)
        seen = count > 0
        total = np.bincount(at, count, len(node))[at]
        kinds = np.bincount(at, seen, len(node))[at]
        free = 1 - np.bincount(at, np.where(seen, lower, 0), len(node))[at]
        with np.errstate(divide="ignore", invalid="ignore"):
            escaped = 0.5 * kinds / total * np.minimum(lower / np.maximum(free, 1e-300), 1)
            below = np.where(seen, (count - 0.5) / total, np.where(total > 0, escaped, lower))
        below_of = of
    return below[below_of]


def _context_answers(asked: DataFrame, buckets: int) -> DataFrame:
    """log10 probabilities in the order of the asked lists of keys."""
    spark = asked.sparkSession

    def add(pdf: pd.DataFrame) -> pd.DataFrame:
        key, of = np.unique(np.concatenate(pdf["keys"].tolist()), return_inverse=True)
        return pd.DataFrame({"key": key, "n": np.bincount(of, np.concatenate(pdf["counts"].tolist()), len(key)).astype(np.int64)})

    trie = stored(asked.select("bucket", "keys", "counts").groupBy("bucket").applyInPandas(add, "key long, n long"), "trie")
    pairs = (trie.filter("n > 0").groupBy(F.col("key").bitwiseAND(0xFFFF).alias("pair")).agg(F.sum("n").alias("n"))
                 .toPandas())                           # 65,536 rows at most
    shared = spark.sparkContext.broadcast(_first_orders(pairs.astype({"pair": np.int64, "n": float})))

    def walk(pdf: pd.DataFrame) -> pd.DataFrame:
        key = pdf["key"].to_numpy(np.int64)
        lp = np.log10(_walk_trie(key, pdf["n"].to_numpy(float), shared.value))
        return pd.DataFrame({"bucket": _key_bucket(key, buckets).astype(np.int32), "key": key, "lp": lp})

    node = F.shiftright("key", 8).bitwiseAND(0xFFFF)
    scored = stored(trie.groupBy(F.pmod(F.xxhash64(node), F.lit(buckets)).alias("part"))
                        .applyInPandas(walk, "bucket int, key long, lp double"), "scored")

    def answer(lists: pd.DataFrame, known: pd.DataFrame) -> pd.DataFrame:
        known = known.sort_values("key")
        key, lp = known["key"].to_numpy(), known["lp"].to_numpy()
        return pd.DataFrame({"cell": lists["cell"], "bucket": lists["bucket"], "of_words": False,
                             "answer": [lp[np.searchsorted(key, k)] for k in lists["keys"]]})

    return (asked.select("cell", "bucket", "keys").groupBy("bucket").cogroup(scored.groupBy("bucket"))
                 .applyInPandas(answer, ANSWER))


def _word_answers(asked: DataFrame) -> DataFrame:
    """Training counts in the order of the asked lists of words; and a row of
    cell -1 for each bucket with its number of tokens and of distinct words."""
    def count(pdf: pd.DataFrame) -> pd.DataFrame:
        total: dict[bytes, int] = defaultdict(int)
        for words, n in zip(pdf["words"], pdf["counts"]):
            for w, k in zip(words, n.tolist()):
                total[w] += k
        rows = [(c, b, True, [float(total[w]) for w in words]) for c, b, words in zip(pdf["cell"], pdf["bucket"], pdf["words"])]
        rows.append((-1, int(pdf["bucket"].iloc[0]), True, [float(sum(total.values())), float(sum(v > 0 for v in total.values()))]))
        return pd.DataFrame(rows, columns=["cell", "bucket", "of_words", "answer"])

    return asked.select("cell", "bucket", "words", "counts").groupBy("bucket").applyInPandas(count, ANSWER)


def ppm_scores(docs: DataFrame, held_out: Column, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each row of ``docs``: identifier, ``held_out``, ``n_tokens``,
    ``n_known`` (tokens seen in training), ``train_tokens``, ``base_score``
    (add-half unigram) and ``score`` (PPM), in log10 over the whole text."""
    buckets = 2 * shuffle_partitions(docs.sparkSession)
    slim = docs.select(F.col(id_col).cast("string").alias("doc_id"), F.coalesce(held_out, F.lit(False)).alias("held_out"), text_col)
    cells = stored(_cells(slim, buckets), "cells")
    of_words = stored(_word_answers(cells.filter("words IS NOT NULL")), "word_counts")
    tokens, kinds = of_words.filter("cell < 0").agg(F.coalesce(F.sum(F.col("answer")[0]), F.lit(0.0)),
                                                    F.coalesce(F.sum(F.col("answer")[1]), F.lit(0.0))).first()
    n_docs = cells.filter("ids IS NOT NULL AND NOT held_out").count()
    total, kinds = int(tokens) + n_docs, int(kinds) + (n_docs > 0)
    answers = of_words.filter("cell >= 0").unionByName(_context_answers(cells.filter("keys IS NOT NULL"), buckets))
    base_of = float(total) + 0.5 * (kinds + 1)

    def finish(own: pd.DataFrame, got: pd.DataFrame) -> pd.DataFrame:
        own, got = own.sort_values("bucket", kind="stable"), got.sort_values("bucket", kind="stable")

        def flat(lists) -> np.ndarray:
            return np.concatenate([np.asarray(x) for x in lists]) if len(lists) else np.zeros(0)

        words = [w for x in own["words"][own["words"].notna()] for w in x]
        count = flat(got["answer"][got["of_words"]])
        lps = KeyValues(flat(own["keys"][own["keys"].notna()]), flat(got["answer"][~got["of_words"]]))
        base = np.log10((count + 0.5) / base_of)
        end_base = np.log10((n_docs + 0.5) / base_of)
        mine = own[own["ids"].notna()].reset_index(drop=True)
        ids_of = mine["ids"].tolist()
        score = np.zeros(len(mine))
        texts = [_stream([words[i] for i in ids.tolist()]) for ids in ids_of]
        for i, key, text in _chunks(texts):
            part = np.bincount(text, lps.get(key))
            score[i:i + len(part)] += part
        return pd.DataFrame({
            "doc_id": mine["doc_id"], "held_out": mine["held_out"].to_numpy(bool),
            "n_tokens": [len(ids) + 1 for ids in ids_of], "n_known": [int((count[ids] > 0).sum()) + (n_docs > 0) for ids in ids_of],
            "train_tokens": total, "base_score": [float(base[ids].sum() + end_base) for ids in ids_of], "score": score})

    done = (cells.select("cell", "bucket", "doc_id", "held_out", "ids", "words", "keys").groupBy("cell").cogroup(answers.groupBy("cell"))
                 .applyInPandas(finish, "doc_id string, held_out boolean, n_tokens long, n_known long, train_tokens long, "
                                        "base_score double, score double"))
    return done.select(F.col("doc_id").cast("long").alias(id_col), *done.columns[1:])


def held_out_fifth(id_col: str = "doc_id") -> Column:
    """Rows whose crc32 of the identifier as text leaves 1 modulo 5."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % 5 == 1
