"""SentencePiece encoding and decoding: batched numpy Viterbi.

Texts are cut where no piece can reach over (before a blank), distinct cuts of
equal length advance together, one character a step: the hashes of all
substrings that end there probe the sorted piece keys, and vectorised maxima
store the best candidate and a backpointer.  What makes a candidate best is
the file's own model type:

* unigram: the highest total score; the longer last piece wins a tie;
* merges (BPE): the one piece that may follow the last piece of the
  encoding that ends where it starts.  A sequence is the merge encoding exactly
  when no neighbours would have merged otherwise, so each position has a single
  valid last piece, and the maximum is taken over validity.  Two pieces are held
  against each other by undoing their merges from the latest on.

A character without a piece costs ten below the lowest score and is written as
its UTF-8 byte pieces, or as the unknown piece where the file has none.

The file is a parameter; it is read once by the driver, and its table (bounded
by the vocabulary) is broadcast. Decoding joins the pieces' bytes.

Defined results: a null text encodes to a null list, an empty one to an empty
list; a text of any length is cut into pieces of work; repeated rows give equal
lists; an empty table gives an empty result; columns named like an output
column are replaced, others pass unchanged.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusflow.llm import numerics as N
from corpusflow.llm.store import without

BLANK = "▁"
UNKNOWN_PENALTY = 10.0
CACHE_CUTS = 400_000      # encoded cuts that a Python worker keeps
GROUP_CHARS = 1 << 20     # characters encoded together
LONG_CUT = 512            # from here a cut advances alone
NEAR_BITS = 20
PAIR_BITS = 21
_CUT = re.compile(f"{BLANK}*[^{BLANK}]+|{BLANK}+$")


@dataclass
class PieceTable:
    keys: np.ndarray          # sorted substring hashes of the pieces
    ids: np.ndarray
    scores: np.ndarray
    longest: int
    unknown_score: float
    unknown_id: int
    byte_ids: list[int] | None
    surface: list[bytes]      # what a piece stands for when decoded
    dummy_prefix: bool
    crossing: bool            # some piece reaches over a blank
    near: np.ndarray          # by the top bits of a hash: may it be a key?
    merges: "Merges | None"   # of a file of type BPE


@dataclass
class Merges:
    """By piece id: merge order (0: a single character), the two parts of the
    last merge, hash and length; and the lengths of the pieces of blanks only,
    which merge after all others."""
    order: np.ndarray
    left: np.ndarray
    right: np.ndarray
    hash: np.ndarray
    size: np.ndarray
    blanks: dict[int, int]
    pairs: np.ndarray         # pairs that were judged before, by slot, and what came out
    valid: np.ndarray


def _fields(data: bytes):
    """(number, value) of the fields of a protobuf message."""
    i = 0

    def varint():
        nonlocal i
        n = shift = 0
        while True:
            c = data[i]
            i += 1
            n |= (c & 127) << shift
            shift += 7
            if c < 128:
                return n

    while i < len(data):
        tag = varint()
        kind = tag & 7
        if kind == 0:
            yield tag >> 3, varint()
        else:
            size = varint() if kind == 2 else (8 if kind == 1 else 4)
            yield tag >> 3, data[i:i + size]
            i += size


def load_pieces(path: str) -> PieceTable:
    """Read a ``.model`` file. Only the identity normaliser without white-space
    squeezing is supported; another one raises ValueError."""
    with open(path, "rb") as f:
        model = list(_fields(f.read()))
    # fixed values of the file format: 1 piece (1 text, 2 score, 3 type), 3 normaliser (2 table, 3 dummy prefix, 4 squeeze)
    normal, unknown, byte = 1, 2, 6
    pieces = []
    for number, value in model:
        if number == 1:
            d = dict(_fields(value))
            pieces.append((d[1].decode(), float(np.frombuffer(d.get(2, bytes(4)), "<f4")[0]), d.get(3, normal)))
    norm = dict(_fields(next((v for n, v in model if n == 3), b"")))
    if norm.get(2) or norm.get(4, 1):
        raise ValueError("only the identity normaliser is supported")
    kind_of = dict(_fields(next((v for n, v in model if n == 2), b""))).get(3, 1)   # trainer: 3 model type
    if kind_of not in (1, 2):
        raise ValueError("only unigram and BPE files are supported")
    usable = [(t, s, i) for i, (t, s, k) in enumerate(pieces) if k == normal]
    blanks = {len(t): i for t, _, i in usable if not t.strip(BLANK)}
    crossing = any(re.search(f"[^{BLANK}]{BLANK}", t) or t.startswith(BLANK * 2) and t.strip(BLANK) for t, _, _ in usable)
    if kind_of == 2:
        if crossing:
            raise ValueError("merged pieces that reach over a blank are not supported")
        usable = [(t, s, i) for t, s, i in usable if t == BLANK or t.strip(BLANK)]
    by_size: dict[int, list[str]] = {}
    for t, _, _ in usable:
        by_size.setdefault(len(t), []).append(t)
    hashes = {t: h for size, same in by_size.items() for t, h in zip(same, _prefix(_codes(same, size))[:, -1].tolist())}
    merges = _merges(usable, hashes, blanks, len(pieces)) if kind_of == 2 else None
    keys = np.array([hashes[t] for t, _, _ in usable], N.U)
    order = np.argsort(keys)
    if len(np.unique(keys)) != len(keys):
        raise ValueError("two pieces share a hash")
    near = np.zeros(1 << NEAR_BITS, bool)
    near[keys >> N.U(64 - NEAR_BITS)] = True
    bytes_at = {t: i for i, (t, _, k) in enumerate(pieces) if k == byte}
    byte_ids = [bytes_at[f"<0x{b:02X}>"] for b in range(256)] if len(bytes_at) == 256 else None
    surface = []
    for t, _, k in pieces:
        surface.append(bytes([int(t[3:5], 16)]) if k == byte else t.replace(BLANK, " ").encode() if k == normal else
                       " ⁇ ".encode() if k == unknown else b"")
    return PieceTable(keys[order], np.array([i for _, _, i in usable], np.int32)[order],
                      np.array([s for _, s, _ in usable])[order], max(len(t) for t, _, _ in usable),
                      min(s for _, s, _ in usable) - UNKNOWN_PENALTY,
                      next(i for i, (_, _, k) in enumerate(pieces) if k == unknown), byte_ids, surface,
                      bool(norm.get(3, 1)), crossing, near, merges)


def _merges(usable: list[tuple[str, float, int]], hashes: dict[str, int], blanks: dict[int, int], n: int) -> Merges:
    score = {t: (-s, i) for t, s, i in usable}
    ids = {t: i for t, _, i in usable}
    m = Merges(np.zeros(n, np.int64), np.arange(n), np.arange(n), np.zeros(n, N.U), np.zeros(n, np.int64),
               blanks, np.full(1 << PAIR_BITS, -1, np.int64), np.zeros(1 << PAIR_BITS, bool))
    for rank, t in enumerate(sorted(score, key=score.get), 1):
        i = ids[t]
        m.hash[i], m.size[i] = N.U(hashes[t]), len(t)
        if len(t) > 1:
            m.order[i] = rank
            parts = list(t)
            while len(parts) > 2:
                found = [(score[x + y], at) for at, (x, y) in enumerate(zip(parts, parts[1:])) if x + y in score]
                if not found:
                    break
                at = min(found)[1]
                parts[at:at + 2] = [parts[at] + parts[at + 1]]
            if len(parts) == 2 and parts[0] in ids and parts[1] in ids:
                m.left[i], m.right[i] = ids[parts[0]], ids[parts[1]]
            else:
                m.order[i] = -1           # no merge leads to this piece
    return m


_MUL = N.U(0x9E3779B97F4A7C15 | 1)


def _prefix(codes: np.ndarray) -> np.ndarray:
    """[n, L] code points -> [n, L + 1] prefix hashes."""
    h = np.zeros((codes.shape[0], codes.shape[1] + 1), N.U)
    keyed = N.mix(codes.astype(N.U) + N.U(1))
    for j in range(codes.shape[1]):
        h[:, j + 1] = h[:, j] * _MUL + keyed[:, j]
    return h


def _codes(texts: list[str], length: int) -> np.ndarray:
    return np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32).reshape(len(texts), length)


def _pows(n: int) -> np.ndarray:
    p = np.full(n + 1, _MUL, N.U)
    p[0] = 1
    return np.cumprod(p, dtype=N.U)


def _hits(sub: np.ndarray, table: PieceTable) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, column and place in the table of the hashes that are pieces, by
    row. A row whose last column (its single character) is none has place -1 there."""
    row, col = np.nonzero(table.near[sub >> N.U(64 - NEAR_BITS)])
    val = sub[row, col]
    at = np.minimum(np.searchsorted(table.keys, val), len(table.keys) - 1)
    ok = table.keys[at] == val
    row, col, at = row[ok], col[ok], at[ok]
    known = np.zeros(len(sub), bool)
    known[row[col == sub.shape[1] - 1]] = True
    if not known.all():
        none = np.flatnonzero(~known)
        row, col = np.concatenate([row, none]), np.concatenate([col, np.full(len(none), sub.shape[1] - 1)])
        at = np.concatenate([at, np.full(len(none), -1)])
        order = np.argsort(row, kind="stable")
        row, col, at = row[order], col[order], at[order]
    return row, col, at


def _judge_pairs(a: np.ndarray, b: np.ndarray, table: PieceTable) -> np.ndarray:
    """Would pieces a and b stand side by side in a merge encoding of their text?"""
    m = table.merges
    pw = _pows(2 * table.longest)
    out = (m.order[a] >= 0) & (m.order[b] >= 0)
    limit = np.full(len(a), np.iinfo(np.int64).max)
    live = np.flatnonzero(out)
    a, b = a.copy(), b.copy()
    while len(live):
        x, y = a[live], b[live]
        joint = m.hash[x] * pw[m.size[y]] + m.hash[y]
        at = np.minimum(np.searchsorted(table.keys, joint), len(table.keys) - 1)
        rank = np.where(table.keys[at] == joint, m.order[table.ids[at]], np.iinfo(np.int64).max)
        rank[rank < 0] = np.iinfo(np.int64).max
        clash = rank < limit[live]
        out[live[clash]] = False
        first = m.order[x] > m.order[y]
        done = clash | (~first & (m.left[y] == y))
        limit[live] = np.where(first, m.order[x], m.order[y] + 1)
        a[live] = np.where(first, m.right[x], x)
        b[live] = np.where(first, y, m.left[y])
        live = live[~done]
    return out


def _valid_pairs(a: np.ndarray, b: np.ndarray, table: PieceTable) -> np.ndarray:
    """_judge_pairs through a table of judged pairs; pairs below 0 (no piece) are valid."""
    m = table.merges
    pair = a.astype(np.int64) << 32 | b.astype(np.int64)
    slot = ((pair.view(N.U) * _MUL) >> N.U(64 - PAIR_BITS)).astype(np.int64)
    out = m.valid[slot]
    free = (a < 0) | (b < 0)
    out[free] = True
    ask = np.flatnonzero((m.pairs[slot] != pair) & ~free)
    if len(ask):
        new, first, inv = np.unique(pair[ask], return_index=True, return_inverse=True)
        got = _judge_pairs(new >> 32, new & 0xFFFFFFFF, table)
        at = slot[ask[first]]
        m.pairs[at], m.valid[at] = new, got
        # two new pairs may share a slot: the later one holds it, both get their own result
        m.valid[at] = got[np.searchsorted(new, m.pairs[at])]
        out[ask] = got[inv]
    return out


def _best(row: np.ndarray, value: np.ndarray, n: int) -> np.ndarray:
    """Index of the first maximum of each of the ``n`` rows."""
    first = np.searchsorted(row, np.arange(n))
    top = np.maximum.reduceat(value, first)
    at = np.flatnonzero(value == top[row])
    return at[np.searchsorted(row[at], np.arange(n))]


def _viterbi_equal(texts: list[str], length: int, table: PieceTable) -> tuple[np.ndarray, np.ndarray]:
    codes = _codes(texts, length)
    n = len(texts)
    h, pw = _prefix(codes), _pows(table.longest)
    best = np.zeros((length + 1, n))
    back = np.zeros((length + 1, n), np.int32)      # length of the last piece
    piece = np.full((length + 1, n), -1, np.int32)  # its id, -1: no piece
    for e in range(1, length + 1):
        sizes = np.arange(min(e, table.longest), 0, -1)    # the longer piece first: it wins a tie
        row, col, at = _hits(h[:, e, None] - h[:, e - sizes] * pw[sizes], table)
        size = sizes[col]
        this = np.where(at < 0, -1, table.ids[at])
        if table.merges:
            value = _valid_pairs(piece[e - size, row], this, table).astype(float)
        else:
            value = best[e - size, row] + np.where(at < 0, table.unknown_score, table.scores[at])
        pick = _best(row, value, n)
        best[e], back[e], piece[e] = value[pick], size[pick], this[pick]
    return _trace(codes, back, piece, table)


def _viterbi_long(text: str, table: PieceTable) -> np.ndarray:
    """One long cut: the substrings of a stretch are probed at once, then the
    maxima go along the text."""
    length, most = len(text), table.longest
    best = np.zeros(length + 1)
    back, piece = np.zeros((length + 1, 1), np.int32), np.full((length + 1, 1), -1, np.int32)
    pw, sizes = _pows(most), np.arange(most, 0, -1)
    for a in range(0, length, 1 << 14):
        lo, hi = max(0, a - most), min(length, a + (1 << 14))
        h = _prefix(_codes([text[lo:hi]], hi - lo))[0]
        ends = np.arange(a + 1, hi + 1)
        first = np.maximum(ends[:, None] - sizes, lo)
        sub = h[ends - lo][:, None] - h[first - lo] * pw[sizes]
        row, col, at = _hits(sub, table)
        fits = sizes[col] <= ends[row]
        row, size, at = row[fits], sizes[col[fits]], at[fits]
        edge = np.searchsorted(row, np.arange(len(ends) + 1)).tolist()
        this = np.where(at < 0, -1, table.ids[at])
        for r, e in enumerate(ends.tolist()):
            i, j = edge[r], edge[r + 1]
            if table.merges:
                value = _valid_pairs(piece[e - size[i:j], 0], this[i:j], table).astype(float)
            else:
                value = best[e - size[i:j]] + np.where(at[i:j] < 0, table.unknown_score, table.scores[at[i:j]])
            k = int(value.argmax())
            best[e], back[e, 0], piece[e, 0] = value[k], size[i + k], this[i + k]
    return _trace(_codes([text], length), back, piece, table)[0]


def _blank_run(n: int, table: PieceTable) -> list[int]:
    """Merge encoding of ``n`` blanks: these merges tie, the leftmost goes first."""
    sizes, i, parts = table.merges.blanks, 0, [1] * n
    out: list[int] = []
    while parts:                       # a stretch at a time: pieces are short
        head, parts = parts[:64], parts[64:]
        work = out[-1:] + head
        del out[-1:]
        i = 0
        while i + 1 < len(work):
            if work[i] + work[i + 1] in sizes:
                work[i:i + 2] = [work[i] + work[i + 1]]
                i = max(0, i - 1)
            else:
                i += 1
        out += work
    return [sizes[k] for k in out]


def _trace(codes: np.ndarray, back: np.ndarray, piece: np.ndarray, table: PieceTable) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts behind each other, and their number in each: the
    backpointers of all texts are followed together."""
    n, length = codes.shape
    end = np.full(n, length)
    rows, steps = np.arange(n), []
    while len(rows):
        e = end[rows]
        p = piece[e, rows].astype(np.int64)
        steps.append((rows, np.where(p < 0, -1 - codes[rows, e - 1].astype(np.int64), p)))   # below 0: a character
        end[rows] = e - back[e, rows]
        rows = rows[end[rows] > 0]
    count = np.zeros(n, np.int64)
    for r, _ in steps:
        count[r] += 1
    last = np.cumsum(count) - 1
    flat = np.zeros(int(count.sum()), np.int64)
    for k, (r, p) in enumerate(steps):
        flat[last[r] - k] = p
    return _spell_unknown(flat, count, table) if (flat < 0).any() else (flat, count)


def _spell_unknown(flat: np.ndarray, count: np.ndarray, table: PieceTable) -> tuple[np.ndarray, np.ndarray]:
    """Characters without a piece become their byte pieces, or one unknown piece for
    each run of them."""
    size = np.ones(len(flat), np.int64)
    text = np.repeat(np.arange(len(count)), count)
    spelt = {}
    if table.byte_ids:
        for p in np.unique(flat[flat < 0]).tolist():
            spelt[p] = [table.byte_ids[c] for c in chr(-1 - p).encode("utf-8", "surrogatepass")]
            size[flat == p] = len(spelt[p])
    else:
        again = np.zeros(len(flat), bool)
        again[1:] = (flat[1:] < 0) & (flat[:-1] < 0) & (text[1:] == text[:-1])
        size[again] = 0
        flat = np.where(flat < 0, table.unknown_id, flat)
    start = np.cumsum(size) - size
    out = np.zeros(int(size.sum()), np.int64)
    one = (flat >= 0) & (size > 0)
    out[start[one]] = flat[one]
    for p, ids in spelt.items():
        out[start[flat == p][:, None] + np.arange(len(ids))] = ids
    return out, np.bincount(text, size, len(count)).astype(np.int64)


def encode_cuts(cuts: list[str], table: PieceTable) -> tuple[list[str], np.ndarray, np.ndarray]:
    """The distinct cuts in the order of work, their ids behind each other, and
    the number of ids of each. Equal lengths advance together."""
    order, flats, counts = [], [], []

    def add(texts: list[str], flat, count) -> None:
        order.extend(texts)
        flats.append(np.asarray(flat, np.int64))
        counts.append(np.asarray(count, np.int64))

    if table.merges and any(c[:2] == BLANK * 2 or c == BLANK for c in cuts):
        # blanks merge with each other last: only the one before a word can join it
        runs = {c: len(c) - len(c.lstrip(BLANK)) for c in cuts if c[:2] == BLANK * 2 or c == BLANK}
        words = list({c[n - 1:] for c, n in runs.items() if n < len(c)} | {c for c in cuts if c not in runs})
        add(*encode_cuts(words, table))
        at = dict(zip(order, np.split(flats[0], np.cumsum(counts[0])[:-1]))) if words else {}
        blank = table.merges.blanks[1]
        wanted = set(cuts)
        for c, n in runs.items():
            word = at[c[n - 1:]].tolist() if n < len(c) else [blank]
            alone = word[0] == blank
            ids = _blank_run(n if alone else n - 1, table) + (word[1:] if alone else word)
            if c in at and c in wanted:
                raise AssertionError("a cut with blanks was encoded twice")
            add([c], ids, [len(ids)])
        return order, np.concatenate(flats), np.concatenate(counts)
    by_length: dict[int, list[str]] = {}
    for c in cuts:
        by_length.setdefault(len(c), []).append(c)
    for length, same in by_length.items():
        if length >= LONG_CUT:
            for c in same:
                ids = _viterbi_long(c, table)
                add([c], ids, [len(ids)])
            continue
        step = max(1, (1 << 17) // length)
        for i in range(0, len(same), step):
            add(same[i:i + step], *_viterbi_equal(same[i:i + step], length, table))
    empty = np.zeros(0, np.int64)
    return order, np.concatenate(flats or [empty]), np.concatenate(counts or [empty])


def _normal(text: str, table: PieceTable) -> str:
    t = text.replace(" ", BLANK)
    return BLANK + t if t and table.dummy_prefix else t


def _stretches(text: str, table: PieceTable):
    """Cuts of a text, a bounded list at a time."""
    a = 0
    while a < len(text):
        b = len(text)
        if not table.crossing and b - a > GROUP_CHARS:
            b = text.find(BLANK, a + GROUP_CHARS)
            while 0 < b and text[b - 1] == BLANK:
                b = text.find(BLANK, b + 1)
            b = b if b > 0 else len(text)
        yield [text[a:b]] if table.crossing else _CUT.findall(text[a:b])
        a = b


class Encoder:
    """Encodes texts and keeps the cuts it has encoded, up to ``kept_cuts`` of them."""

    def __init__(self, table: PieceTable, kept_cuts: int | None = None):
        self.table, self.kept_cuts = table, kept_cuts or CACHE_CUTS
        self.clear()

    def clear(self) -> None:
        self.place: dict[str, int] = {}
        self.start, self.count, self.flat = (np.zeros(0, np.int64) for _ in range(3))

    def _learn(self, cuts: set[str]) -> None:
        new = [c for c in cuts if c not in self.place]
        if len(self.place) + len(new) > self.kept_cuts:
            self.clear()
            new = list(cuts)
        if new:
            order, flat, count = encode_cuts(new, self.table)
            self.place.update(zip(order, range(len(self.count), len(self.count) + len(order))))
            self.start = np.concatenate([self.start, len(self.flat) + np.cumsum(count) - count])
            self.count = np.concatenate([self.count, count])
            self.flat = np.concatenate([self.flat, flat])

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts behind each other, and their number in each."""
        flats, counts = [], np.zeros(len(texts), np.int64)
        for i, j in _runs(texts):
            for k, stretches in self._rounds(texts[i:j]):
                self._learn(set().union(*stretches))
                at = np.fromiter(map(self.place.__getitem__, chain.from_iterable(stretches)), np.int64, sum(map(len, stretches)))
                n = self.count[at]
                flats.append(self.flat[N.ragged_index(self.start[at], n)].astype(np.int32))
                ends = np.concatenate([[0], np.cumsum(n)])[np.cumsum([0, *map(len, stretches)])]
                counts[i + k:i + k + len(stretches)] += np.diff(ends)
        return np.concatenate(flats or [np.zeros(0, np.int32)]), counts

    def _rounds(self, texts: list[str]):
        """(first text, cuts of each text): all texts at once, or one text a
        stretch at a time where it is alone."""
        if len(texts) == 1:
            for cuts in _stretches(_normal(texts[0], self.table), self.table):
                yield 0, [cuts]
        else:
            yield 0, [list(chain.from_iterable(_stretches(_normal(t, self.table), self.table))) for t in texts]

    def lists(self, texts: list[str]) -> list[list[int]]:
        flat, counts = self.encode(texts)
        return [x.tolist() for x in np.split(flat, np.cumsum(counts)[:-1])] if texts else []


def decode_ids(ids, table: PieceTable) -> str:
    s = table.surface
    text = b"".join([s[i] for i in ids]).decode("utf-8", "replace")
    return text[1:] if table.dummy_prefix and text[:1] == " " else text


class Surfaces:
    """The bytes of all pieces behind each other, to check many texts at once."""

    def __init__(self, table: PieceTable):
        self.size = np.array([len(x) for x in table.surface])
        self.start = np.cumsum(self.size) - self.size
        self.data = np.frombuffer(b"".join(table.surface), np.uint8)
        self.prefix = int(table.dummy_prefix)

    def round_trip(self, texts: list[str], flat: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Do the ids stand for the texts?"""
        out = np.zeros(len(texts), bool)
        edge = N.starts_of(counts)
        for i, j in _runs(texts):
            ids = flat[edge[i]:edge[j]]
            size = self.size[ids]
            got = self.data[N.ragged_index(self.start[ids], size)].tobytes()
            ends = np.concatenate([[0], np.cumsum(size)])[edge[i:j + 1] - edge[i]].tolist()
            for k in range(i, j):
                one = got[ends[k - i]:ends[k - i + 1]]
                out[k] = one[self.prefix if texts[k] else 0:] == texts[k].encode("utf-8", "surrogatepass")
        return out


def _runs(texts: list[str]):
    i = 0
    while i < len(texts):
        j, size = i, 0
        while j < len(texts) and (size + len(texts[j]) <= GROUP_CHARS or j == i):
            size += len(texts[j])
            j += 1
        yield i, j
        i = j


_ENCODERS: dict[str, tuple[Encoder, Surfaces]] = {}     # of this Python worker: it serves many tasks


def _worker_encoder(path: str, shared: Broadcast, kept_cuts: int) -> tuple[Encoder, Surfaces]:
    """The worker's encoder of the file; the broadcast table is only read for a new
    one, so that a worker never holds two tables."""
    if path not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[path] = Encoder(shared.value, kept_cuts), Surfaces(shared.value)
    return _ENCODERS[path]


def encode(docs: DataFrame, model_path: str, text_col: str = "text", out: str = "ids",
           check_col: str | None = None, keep_text: bool = True, part_bytes: int = N.CHUNK,
           kept_cuts: int = CACHE_CUTS) -> DataFrame:
    """``docs`` with the list of piece ids ``out`` of ``text_col``. With
    ``check_col`` also whether decoding gives the text back.  Texts are worked on
    ``part_bytes`` bytes at a time; a worker keeps ``kept_cuts`` encoded cuts."""
    docs = without(docs, out, *([check_col] if check_col else []))
    shared = docs.sparkSession.sparkContext.broadcast(load_pieces(model_path))
    at = docs.columns.index(text_col)
    through = [i for i in range(len(docs.columns)) if keep_text or i != at]
    names = [docs.columns[i] for i in through] + [out] + ([check_col] if check_col else [])

    def run(batches):
        encoder, surfaces = _worker_encoder(model_path, shared, kept_cuts)
        for batch in batches:
            off = N.utf8(batch.column(at))[1]
            for i, j in N.groups(off, part_bytes):     # a bounded part of the batch at a time
                part = batch.slice(i, j - i)
                given = part.column(at).to_pylist()
                texts = [t or "" for t in given]
                flat, counts = encoder.encode(texts)
                null = pa.array([t is None for t in given], pa.bool_())
                ids = pa.ListArray.from_arrays(pa.array(N.starts_of(counts).astype(np.int32)), pa.array(flat, pa.int32()))
                cols = [part.column(k) for k in through] + [pc.if_else(null, pa.scalar(None, ids.type), ids)]
                if check_col:
                    cols.append(pc.if_else(null, pa.scalar(None, pa.bool_()), pa.array(surfaces.round_trip(texts, flat, counts))))
                yield pa.RecordBatch.from_arrays(cols, names=names)

    schema = docs.select(*[docs.columns[i] for i in through], F.lit(None).cast("array<int>").alias(out),
                         *([F.lit(None).cast("boolean").alias(check_col)] if check_col else [])).schema
    return docs.mapInArrow(run, schema)


def decode(encoded: DataFrame, model_path: str, ids_col: str = "ids", out: str = "decoded") -> DataFrame:
    """``encoded`` with the text of its piece ids (null list: null)."""
    shared = encoded.sparkSession.sparkContext.broadcast(load_pieces(model_path))

    @F.pandas_udf("string")
    def run(lists: pd.Series) -> pd.Series:
        return pd.Series([None if x is None else decode_ids(x, shared.value) for x in lists], dtype=object)

    return without(encoded, out).withColumn(out, run(F.col(ids_col)))


def default_model() -> str:
    """Path of the public 32k piece file, where its package is installed."""
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")
