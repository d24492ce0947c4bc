"""SentencePiece and PPM."""
import math
import random
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

import plain
from corpusflow.llm import pieces, ppm

sentencepiece = pytest.importorskip("sentencepiece")


@pytest.fixture(scope="module")
def table():
    return pieces.load_pieces(pieces.default_model())


def _odd_texts():
    rng = random.Random(2)
    out = ["", " ", "   ", "a", "  Hello  world\n x ", "日本語 ᚠ text", "🙂 ok", "x" * 700, " " * 40, "a" + " " * 37 + "b", "▁ in ▁▁ text", "\t\n\r"]
    return out + ["".join(rng.choice("abcdehilnorst  ▁.,éü日0159\n") for _ in range(rng.randint(1, 70))) for _ in range(400)]


def test_merge_file_equals_the_library(table, rows):
    lib = sentencepiece.SentencePieceProcessor(model_file=pieces.default_model())
    texts = _odd_texts() + [t or "" for _, t, *_ in rows]
    assert pieces.Encoder(table).lists(texts) == lib.encode(texts)
    long = " ".join(t for t in texts)
    assert pieces.Encoder(table).lists([long]) == [lib.encode(long)]


def test_groups_and_forgetting_do_not_matter(table, monkeypatch):
    texts = _odd_texts()
    want = pieces.Encoder(table).lists(texts)
    monkeypatch.setattr(pieces, "GROUP_CHARS", 40)
    monkeypatch.setattr(pieces, "CACHE_CUTS", 25)
    monkeypatch.setattr(pieces, "PAIR_BITS", 21)
    e = pieces.Encoder(table)
    assert e.lists(texts) == want and e.lists(texts[::-1]) == want[::-1] and e.lists([]) == []


def test_few_pair_slots(monkeypatch):
    monkeypatch.setattr(pieces, "PAIR_BITS", 3)
    t = pieces.load_pieces(pieces.default_model())
    lib = sentencepiece.SentencePieceProcessor(model_file=pieces.default_model())
    texts = _odd_texts()
    assert pieces.Encoder(t).lists(texts) == lib.encode(texts)


def test_long_cut_equals_short_path(table, monkeypatch):
    texts = _odd_texts()
    want = pieces.Encoder(table).lists(texts)
    monkeypatch.setattr(pieces, "LONG_CUT", 1)
    assert pieces.Encoder(table).lists(texts) == want


def test_round_trip(table):
    texts = [t for t in _odd_texts() if "▁" not in t]
    assert [pieces.decode_ids(i, table) for i in pieces.Encoder(table).lists(texts)] == texts
    flat, counts = pieces.Encoder(table).encode(texts)
    assert pieces.Surfaces(table).round_trip(texts, flat, counts).all()
    wrong = pieces.Surfaces(table).round_trip(texts[:-1] + ["other"], flat, counts)
    assert wrong[:-1].all() and not wrong[-1]


def _unigram_file(path, entries):
    def field(number, kind, payload):
        tag = bytes([number << 3 | kind])
        return tag + (bytes([len(payload)]) + payload if kind == 2 else payload)
    import struct
    out = b""
    for text, score, kind in entries:
        out += field(1, 2, field(1, 2, text.encode()) + field(2, 5, struct.pack("<f", score)) + field(3, 0, bytes([kind])))
    out += field(2, 2, field(3, 0, b"\x01")) + field(3, 2, field(1, 2, b"identity") + field(3, 0, b"\x01") + field(4, 0, b"\x00"))
    path.write_bytes(out)


@pytest.mark.parametrize("long_cut", [1, 512])
def test_unigram_file_takes_the_best_sum(tmp_path, monkeypatch, long_cut):
    rng = random.Random(4)
    letters = ["▁", "a", "b", "c", "d"]
    known = {x: -rng.uniform(4, 9) for x in letters} | {"".join(rng.choice(letters[1:]) for _ in range(rng.randint(2, 5))): -rng.uniform(1, 9) for _ in range(60)}
    known |= {"▁" + x: -rng.uniform(1, 9) for x in list(known)[5:30]}
    _unigram_file(tmp_path / "u.model", [("<unk>", 0.0, 2)] + [(t, s, 1) for t, s in known.items()])
    t = pieces.load_pieces(str(tmp_path / "u.model"))
    ids = {x: i + 1 for i, x in enumerate(known)}
    low = min(known.values()) - 10
    monkeypatch.setattr(pieces, "LONG_CUT", long_cut)

    def best(text):
        s = "▁" + text.replace(" ", "▁")
        top = [0.0] + [-math.inf] * len(s)
        for e in range(1, len(s) + 1):
            for a in range(max(0, e - 7), e):
                score = known.get(s[a:e], low if e - a == 1 else -math.inf)
                top[e] = max(top[e], top[a] + score)
        return top[-1]

    names = {i: x for x, i in ids.items()}
    for _ in range(150):
        text = "".join(rng.choice("abcd abz") for _ in range(rng.randint(1, 30)))
        got = pieces.Encoder(t).lists([text])[0]
        if "z" in text:
            continue
        assert "".join(names[i] for i in got) == "▁" + text.replace(" ", "▁")
        assert sum(known[names[i]] for i in got) == pytest.approx(best(text), abs=1e-4)


def test_encode_and_decode_frames(docs, rows, odd_docs, no_docs):
    path = pieces.default_model()
    out = pieces.encode(docs, path, check_col="ok")
    back = pieces.decode(out, path).collect()
    assert len(back) == len(rows) and all(r["decoded"] == r["text"] for r in back)
    assert all(r["ok"] for r in back if r["text"] is not None)
    odd = pieces.encode(odd_docs.withColumn("ids", F.lit("x")).withColumn("ok", F.lit("x")), path, check_col="ok").collect()
    assert len(odd) == 10 and all((r["ids"] is None) == (r["text"] is None) for r in odd)
    assert pieces.encode(no_docs, path).count() == 0


def _plain_ppm(rows):
    """The model written out with dictionaries."""
    held = lambda i: zlib.crc32(("" if i is None else str(i)).encode()) % 5 == 1
    k = ppm.ORDER

    def stream(t):
        w = plain.words(t, lower=True)
        return b"\n" * k + ((" ".join(w) + " ").encode() if w else b"") + b"\r"

    count = defaultdict(Counter)
    for i, t in rows:
        if not held(i):
            s = stream(t)
            for p in range(k, len(s)):
                for o in range(k + 1):
                    count[s[p - o:p]][s[p]] += 1

    def prob(ctx, sym, o):
        if o < 0:
            return 1 / ppm.SYMBOLS
        node = count.get(ctx[len(ctx) - o:])
        if not node:
            return prob(ctx, sym, o - 1)
        n, d = sum(node.values()), len(node)
        if sym in node:
            return (node[sym] - 0.5) / n
        if o == 0:
            return 0.5 * d / n / (ppm.SYMBOLS - d)
        free = 1 - sum(prob(ctx, x, o - 1) for x in node)
        return 0.5 * d / n * prob(ctx, sym, o - 1) / free

    tokens = Counter()
    for i, t in rows:
        if not held(i):
            tokens.update(plain.words(t, lower=True) + [None])
    n, v = sum(tokens.values()), len(tokens)
    out = []
    for i, t in rows:
        s, mine = stream(t), plain.words(t, lower=True) + [None]
        out.append((i, held(i), len(mine), sum(tokens[w] > 0 for w in mine), n,
                    round(sum(math.log10((tokens[w] + 0.5) / (n + 0.5 * (v + 1))) for w in mine), 5),
                    round(sum(math.log10(prob(s[p - k:p], s[p], k)) for p in range(k, len(s))), 5)))
    return sorted(out, key=repr)


def _scores(df):
    return sorted(((r[0], r[1], r[2], r[3], r[4], round(r[5], 5), round(r[6], 5)) for r in ppm.ppm_scores(df, ppm.held_out_fifth()).collect()), key=repr)


def test_ppm_equals_plain_model(docs, rows):
    assert _scores(docs) == _plain_ppm([(r[0], r[1]) for r in rows])


def test_ppm_cells_and_slots_do_not_matter(docs, monkeypatch):
    want = _scores(docs)
    monkeypatch.setattr(ppm, "CELL_BYTES", 2000)
    assert _scores(docs.repartition(2)) == want


def test_ppm_slot_table_with_collisions(monkeypatch):
    import numpy as np

    monkeypatch.setattr(ppm, "SLOT_BITS", 4)
    key = np.random.default_rng(1).integers(1, 300, 5000)
    train = np.random.default_rng(2).random(5000) < 0.6
    c = ppm.KeyCounter()
    for a in range(0, 5000, 700):
        c.add(key[a:a + 700], train[a:a + 700])
    uniq, n = c.result()
    want = Counter(key[train].tolist())
    assert dict(zip(uniq.tolist(), n.tolist())) == {k: want[k] for k in set(key.tolist())}
    assert (ppm.KeyValues(uniq, uniq * 2.0).get(key) == key * 2.0).all()


def test_ppm_odd(odd_docs, no_docs, spark):
    odd = odd_docs.withColumn("cell", F.lit("x")).withColumn("held_out", F.lit("x"))
    assert _scores(odd) == _plain_ppm([(r["doc_id"], r["text"]) for r in odd_docs.collect()])
    assert ppm.ppm_scores(no_docs, ppm.held_out_fifth()).count() == 0
    big = spark.createDataFrame([(2 ** 62 + 1, "a b"), (None, "a")], "doc_id long, text string")
    assert {r["doc_id"] for r in ppm.ppm_scores(big, F.lit(False)).collect()} == {2 ** 62 + 1, None}


def test_ppm_likes_held_out_prose_better_than_noise(spark):
    rng = random.Random(9)
    words = ["the", "river", "runs", "under", "an", "old", "bridge", "near", "town"]
    rows = [(i, " ".join(rng.choice(words) for _ in range(60))) for i in range(200)]
    rows += [(1000 + i, " ".join("".join(rng.choice("qxzjkvw") for _ in range(5)) for _ in range(60))) for i in range(20)]
    got = ppm.ppm_scores(spark.createDataFrame(rows, "doc_id long, text string"), F.col("doc_id") % 5 == 1).collect()
    per = {r["doc_id"]: r["score"] / r["n_tokens"] for r in got if r["held_out"]}
    assert max(v for i, v in per.items() if i >= 1000) < min(v for i, v in per.items() if i < 1000)
