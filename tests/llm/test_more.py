"""Benchmark decontamination, importance resampling, cross-tokenizer alignment."""
import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import plain
from corpusflow.llm import align, decontam, resample

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def normal(text):
    return WORD.findall((text or "").translate(plain.LOWER))


# --- decontamination ---------------------------------------------------------

def plain_hits(docs, items, n=10):
    """doc_id -> (words, hit word numbers, item ids)"""
    wins = defaultdict(set)
    for item, text in items:
        w = normal(text)
        size = min(n, len(w))
        for i in range(len(w) - size + 1 if w else 0):
            wins[tuple(w[i:i + size])].add(item)
    out = {}
    for d, text in docs:
        w, hit, ids = normal(text), set(), set()
        for size in {len(x) for x in wins}:
            for i in range(len(w) - size + 1):
                if tuple(w[i:i + size]) in wins:
                    hit.update(range(i, i + size))
                    ids |= wins[tuple(w[i:i + size])]
        out[d] = (len(w), hit, sorted(str(x) for x in ids if x is not None))
    return out


@pytest.fixture(scope="module")
def items(spark, rows):
    w = [plain.words(rows[i][1]) for i in (0, 3, 60)]
    texts = [(0, " ".join(w[0][:25])), (10, " ".join(w[1][5:16]).upper()), (2, "-".join(w[2][100:140])), (3, "a b c"), (4, "word"),
             (5, ""), (6, None), (7, "Never seen, this line of words stands in no text at all, really."), (0, " ".join(w[2][-30:])),
             (None, " ".join(w[0][30:45])), (11, " ".join(w[0][:25])), (12, "é " * 11)]
    return texts, spark.createDataFrame(texts, "item_id long, text string")


@pytest.mark.parametrize("small_broadcast", [False, True])
def test_hits(docs, rows, items, small_broadcast):
    texts, frame = items
    want = plain_hits([(r[0], r[1]) for r in rows], texts)
    assert sum(bool(h) for _, h, _ in want.values()) > 5
    p = decontam.DecontamParams(broadcast_bytes=2000 if small_broadcast else 1 << 20)
    for r in decontam.contamination(docs, frame, params=p).collect() + decontam.contamination_report(docs, frame, params=p).collect():
        n, hit, ids = want[r["doc_id"]]
        assert (r["n_words"], r["n_hit"], r["item_ids"], r["contaminated"]) == (n, len(hit), ids, bool(hit))
        assert {i for a, b in r["hit_spans"] for i in range(a, b)} == hit
        assert all(b < c for (_, b), (c, _) in zip(r["hit_spans"], r["hit_spans"][1:]))


def test_spans_and_documents_removed(docs, rows, items):
    texts, frame = items
    want = plain_hits([(r[0], r[1]) for r in rows], texts)
    text = {r[0]: r[1] for r in rows}
    for r in decontam.decontaminate(docs, frame).collect():
        _, hit, _ = want[r["doc_id"]]
        left = [w for i, w in enumerate(normal(text[r["doc_id"]])) if i not in hit]
        assert normal(r["clean_text"]) == left
        if not hit:
            assert r["clean_text"] == text[r["doc_id"]]
    kept = {r["doc_id"] for r in decontam.decontaminate(docs, frame, "documents").collect()}
    assert kept == {d for d, (_, hit, _) in want.items() if not hit}
    with pytest.raises(ValueError):
        decontam.decontaminate(docs, frame, "words")


def test_no_python_in_the_plan(docs, items):
    plan = decontam.contamination(docs, items[1])._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_decontamination_odd(spark, odd_docs, no_docs, items):
    frame = spark.createDataFrame([(1, "w3 w4 w5 w6 w7 w8 w9 w10 w11 w12", "x")], "item_id long, text string, n_hit string")
    odd = odd_docs.withColumn("n_hit", F.lit("old")).withColumn("win", F.lit("x"))
    got = decontam.contamination(odd, frame).collect()
    assert len(got) == 10 and all(r["win"] == "x" for r in got)
    assert sorted(r["n_hit"] for r in got) == [0] * 5 + [10] * 5
    again = decontam.contamination_report(odd, frame).collect()
    assert Counter((r["doc_id"], r["n_words"], r["n_hit"]) for r in again) == Counter((r["doc_id"], r["n_words"], r["n_hit"]) for r in got)
    assert decontam.contamination(no_docs, frame).count() == decontam.contamination_report(no_docs, frame).count() == 0
    none = decontam.decontaminate(odd_docs, items[1].limit(0)).collect()
    assert len(none) == 10 and not any(r["contaminated"] or r["item_ids"] for r in none)


def test_very_long_text(spark):
    words = [f"w{i % 977}" for i in range(300_000)]
    item = [f"q{i}" for i in range(30)]
    text = " ".join(words[:200_000] + item + words[200_000:])
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    r = decontam.decontaminate(docs, spark.createDataFrame([(5, " ".join(item))], "item_id long, text string")).first()
    assert (r["n_hit"], r["clean_text"]) == (30, " ".join(words))


# --- importance resampling ---------------------------------------------------

def plain_resample(docs, target, p):
    def features(text):
        w = normal(text)
        return [" ".join(w[i:i + k]) for k in range(1, p.order + 1) for i in range(len(w) - k + 1)]

    def bucket(f):
        return zlib.crc32(f.encode()) % p.buckets

    s = Counter(bucket(f) for _, t in docs for f in features(t))
    t = Counter(bucket(f) for x in target for f in features(x))
    s_all, t_all = sum(s.values()), sum(t.values())
    gain = {b: math.floor(1000 * math.log((t[b] + 1) * (s_all + p.buckets) / ((s[b] + 1) * (t_all + p.buckets)))) for b in s}
    out = {}
    for d, x in docs:
        f = features(x)
        h = int(hashlib.sha256(f"{p.seed}:{'null' if d is None else d}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[bucket(g)] for g in f)
        out[d] = [len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, len(normal(x))]
    able = sorted((d for d in out if out[d][4] >= p.min_words), key=lambda d: (-out[d][2], d))
    for i, d in enumerate(able[:len(able) * p.percent // 100]):
        out[d][3] = i + 1
    return {d: tuple(v[:4]) for d, v in out.items()}


@pytest.mark.parametrize("order", [1, 2, 3])
def test_resample(docs, rows, items, order):
    p = resample.ResampleParams(order=order, buckets=500, percent=30)
    want = plain_resample([(r[0], r[1]) for r in rows], [t for _, t in items[0]], p)
    got = {r["doc_id"]: tuple(r)[1:] for r in resample.importance_resample(docs, items[1], params=p).collect()}
    assert got == want and sum(v[3] is not None for v in want.values()) > 5
    drawn = {r["doc_id"] for r in resample.resampled(docs, items[1], params=p).collect()}
    assert drawn == {d for d, v in want.items() if v[3] is not None}


def test_hot_line(spark):
    rows = [(i, "one very common line\n" * (1 + i % 3) + f"words {i} of its own") for i in range(120)]
    p = resample.ResampleParams(min_words=1, percent=50)
    got = {r["doc_id"]: tuple(r)[1:] for r in resample.importance_resample(
        spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame([("a common word",)], "text string"), params=p).collect()}
    assert got == plain_resample(rows, ["a common word"], p)


def test_resample_odd(spark, odd_docs, no_docs):
    target = spark.createDataFrame([("w1 w2 w3",), (None,), ("",)], "text string")
    p = resample.ResampleParams(percent=100)
    got = resample.importance_resample(odd_docs.withColumn("weight", F.lit("x")).withColumn("row", F.lit(1)), target, params=p).collect()
    assert len(got) == 10 and sorted(r["rank"] for r in got if r["rank"]) == [1, 2, 3, 4, 5]
    assert all((r["n_features"], r["weight"], r["rank"]) == (0, 0, None) for r in got if r["n_features"] < 2)
    assert len({r["score"] for r in got if r["doc_id"] == 1}) == 1
    assert resample.importance_resample(no_docs, target).count() == 0
    assert resample.importance_resample(odd_docs, target.limit(0)).count() == 10


# --- alignment ---------------------------------------------------------------

@pytest.mark.parametrize("piece", [1, 2, 3, 7, 256])
def test_merge_path(piece):
    rng = np.random.default_rng(piece)
    for n, m in ((0, 5), (5, 0), (1, 1), (40, 3), (300, 280)):
        a, b = (np.sort(rng.choice(600, k, replace=False)).astype(np.int64) for k in (n, m))
        ca, cb = align.diagonal_cuts(a, b, piece)
        assert ((np.diff(ca) + np.diff(cb))[:-1] == piece).all() and ca[-1] == n and cb[-1] == m
        i, j, end, again = align.merge_path(a, b, piece)
        both = sorted([(x, 0) for x in a] + [(x, 1) for x in b])
        assert list(end) == [x for x, _ in both]
        assert list(again) == [k > 0 and both[k][0] == both[k - 1][0] for k in range(n + m)]
        assert list(i) == [sum(s == 0 for _, s in both[:k]) for k in range(n + m)] and list(i + j) == list(range(n + m))


def plain_align(rows):
    """Per document what the contract says, straight from the two libraries."""
    import sentencepiece
    from tokenizers import Tokenizer

    path_a, path_b = align.default_files()
    tok, sp = Tokenizer.from_file(path_a), sentencepiece.SentencePieceProcessor(model_file=path_b)
    tok.encode_special_tokens = True
    letters = align.byte_letters()
    docs, holds = [], Counter()
    for d, text in rows:
        a, b = (tok.encode(" " + text, add_special_tokens=False).ids, sp.encode(text)) if text else ([], [])
        sa = [bytes(letters[c] for c in tok.id_to_token(i)) for i in a]
        sb = [bytes([int(p[3:5], 16)]) if sp.is_byte(i) else p.replace("▁", " ").encode() for i in b for p in [sp.id_to_piece(i)]]
        want = (" " + (text or "")).encode()
        if not text or b"".join(sa) != want or b"".join(sb) != want:
            docs.append((d, 0, 0, [], ""))
            continue
        ends_a, ends_b = np.cumsum([len(x) for x in sa]), np.cumsum([len(x) for x in sb])
        links = [(x, y) for x, ea, la in zip(a, ends_a, map(len, sa)) for y, eb, lb in zip(b, ends_b, map(len, sb))
                 if max(ea - la, eb - lb) < min(ea, eb)]
        groups, pa, pb = [], 0, 0
        for e in sorted(set(ends_a) & set(ends_b)):
            qa, qb = int(np.searchsorted(ends_a, e, "right")), int(np.searchsorted(ends_b, e, "right"))
            groups.append(",".join(map(str, a[pa:qa])) + "|" + ",".join(map(str, b[pb:qb])))
            pa, pb = qa, qb
        holds.update(set(links))
        docs.append((d, len(a), len(b), links, ";".join(groups)))
    top = defaultdict(int)
    for (x, _), n in holds.items():
        top[x] = max(top[x], n)
    return [(d, na, nb, g.count(";") + 1 if g else 0, len(links), sum(holds[x] == top[x[0]] for x in links),
             sum(holds[x] for x in links), plain.sha(g) if g else "") for d, na, nb, links, g in docs]


ODD_TEXTS = ["trailing blank ", " leading", "tab\t blank", "line\n  indented   more \n\n x", "no\u00a0 break \u2003 em", "a  b c", "un\u2581der", "x \x1c y\x1d z", "", None, "a", " ", "  two  blanks \n\n tabs\t\t", "<|endoftext|> <s> </s> <unk>", "▁piece mark", "ñandú 中文 😀 \u0000 \x7f",
             "x" * 700, "ﬁ ligature é", "\r\n", "日本語のテキスト", "<0x41> literal"]


@pytest.mark.parametrize("limit", [align.BROADCAST_PAIRS, 0])
def test_alignment(spark, rows, limit):
    texts = [(r[0], (r[1] or "")[:600]) for r in rows] + [(1000 + i, t) for i, t in enumerate(ODD_TEXTS)]
    want = plain_align(texts)
    got = align.cross_alignment(spark.createDataFrame(texts, "doc_id long, text string").repartition(4), *align.default_files(), broadcast_pairs=limit)
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert sorted(map(tuple, got.collect())) == sorted(want)
    assert any(w[1] == 0 for w in want) and sum(w[3] > 1 for w in want) > 20


def test_alignment_odd(spark, odd_docs, no_docs):
    got = align.cross_alignment(odd_docs.withColumn("pair", F.lit(1)).withColumn("n_a", F.lit("x")), *align.default_files()).collect()
    assert len(got) == 10 and all((r["n_links"] == r["n_a"] + r["n_b"] - r["n_groups"]) for r in got)
    assert sorted(r["n_a"] > 0 for r in got) == [False] * 3 + [True] * 7
    assert align.cross_alignment(no_docs, *align.default_files()).count() == 0
