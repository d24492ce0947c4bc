"""Plain versions of the training-data operators, for small inputs."""
import hashlib
import re
from collections import defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text, lower=False):
    return WORD.findall((text or "").translate(LOWER) if lower else text or "")


def sha(data):
    return hashlib.sha256(data.encode() if isinstance(data, str) else data).hexdigest()


def shingles(text, k):
    w = words(text, lower=True)
    return {tuple(w[i:i + k]) for i in range(max(1, len(w) - k + 1))} if w else set()


def near_components(rows, k=5, percent=80):
    """doc_id -> (set size, component)"""
    sets = {i: shingles(t, k) for i, t in rows}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[n + 1:]:
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                lo, hi = sorted((find(a), find(b)))
                root[hi] = lo
    return {i: (len(s), find(i)) for i, s in sets.items()}


def line_runs(rows, size=2, long=20):
    """doc_id -> (removed lines, text that is left)"""
    seqs = {i: [(p, x) for p, x in enumerate((t or "").split("\n")) if WORD.search(x)] for i, t in rows}
    seen, gone = set(), defaultdict(set)
    for i in sorted(seqs):
        s = seqs[i]
        for q, (_, x) in enumerate(s):
            if long and len(words(x)) >= long:
                if x in seen:
                    gone[i].add(q)
                seen.add(x)
        for q in range(len(s) - size + 1):
            run = tuple(x for _, x in s[q:q + size])
            if run in seen:
                gone[i].update(range(q, q + size))
            seen.add(run)
    out = {}
    for i, t in rows:
        drop, s = set(), seqs[i]
        for q in gone[i]:
            drop.add(s[q][0])
            if q + 1 in gone[i]:
                # blank lines between two lines of one run go too
                drop.update(range(s[q][0], s[q + 1][0] + 1))
        out[i] = (len(gone[i]), "\n".join(x for p, x in enumerate((t or "").split("\n")) if p not in drop))
    return out


def byte_repeats(rows, size=100):
    """doc_id -> (bytes, removed, spans, digest of the rest)"""
    seen, out = set(), {}
    for i, t in sorted(rows):
        data = (t or "").encode()
        gone = [False] * len(data)
        for p in range(len(data) - size + 1):
            s = data[p:p + size]
            if s in seen:
                gone[p:p + size] = [True] * size
            seen.add(s)
        spans = sum(g and (p == 0 or not gone[p - 1]) for p, g in enumerate(gone))
        out[i] = (len(data), sum(gone), spans, sha(bytes(b for b, g in zip(data, gone) if not g)))
    return out


def word_repeats(rows, size=13):
    """doc_id -> (words, removed, digest of the rest)"""
    first = {}
    for i, t in sorted(rows):
        w = words(t)
        for p in range(len(w) - size + 1):
            first.setdefault(tuple(w[p:p + size]), i)
    out = {}
    for i, t in rows:
        w = words(t)
        gone = set()
        for p in range(len(w) - size + 1):
            if first[tuple(w[p:p + size])] < i:
                gone.update(range(p, p + size))
        out[i] = (len(w), len(gone), sha(" ".join(x for p, x in enumerate(w) if p not in gone)))
    return out
