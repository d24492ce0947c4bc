"""Scalar functions: cases from the reference's unit tests, re-expressed as
small DataFrames, plus brute-force checks of the helper algorithms."""
import random

import pytest
from pyspark.sql import functions as F

from corpusflow.functions import metrics as M
from corpusflow.functions import text as TX
from corpusflow.functions.regex import to_java_pattern, to_java_replacement


def one(spark, col, **cols):
    df = spark.createDataFrame([tuple(cols.values())], list(cols))
    return df.select(col.alias("x")).first()["x"]


def test_regex_translation():
    assert to_java_pattern(r"(?P<w>\w+) (?P=w)") == r"(?U)(?<w>\w+) \k<w>"
    assert to_java_pattern(r" ?{[^}]+}") == r"(?U) ?\{[^}]+\}"
    assert to_java_pattern(r"a{2,3}") == r"(?U)a{2,3}"
    assert to_java_replacement(r"\2\1") == "$2$1"
    assert to_java_replacement(r"\g<1>x$") == "$1x\\$"


def test_sub_regex_backrefs_and_count(spark):
    params = [{"pattern": r"(\w+) (\w+)", "repl": r"\2 \1", "count": 1},
              {"pattern": r"\s<.*>\s", "repl": " "}]
    got = one(spark, TX.sub_regex(F.col("t"), params), t="hello <cough> world again")
    import re
    exp = " hello <cough> world again "
    exp = re.sub(r"(\w+) (\w+)", r"\2 \1", exp, count=1)
    exp = re.sub(r"\s<.*>\s", " ", exp)
    assert got == " ".join(exp.split())


def test_words_and_spaces(spark):
    t = "  11  22\t33 \n"
    assert one(spark, TX.words(F.col("t")), t=t) == t.split()
    assert one(spark, TX.remove_extra_spaces(F.col("t")), t=t) == " ".join(t.split())


@pytest.mark.parametrize("text,pred,cer", [("0123456789", "012345678", 10.0), ("abc", "abc", 0.0)])
def test_cer(spark, text, pred, cer):
    assert one(spark, M.cer("t", "p"), t=text, p=pred) == cer


@pytest.mark.parametrize("text,pred,wer", [("11 22", "11 22 33", 50.0), ("11  22", "11 22", 0.0),
                                           ("a b c d", "a x c", 50.0)])
def test_wer(spark, text, pred, wer):
    assert one(spark, M.wer("t", "p"), t=text, p=pred) == wer


def test_rates(spark):
    assert one(spark, M.charrate("t", "d"), t="0123456789", d=1.0) == 10.0
    assert one(spark, M.wordrate("t", "d"), t="a b c", d=2.0) == 1.5


def test_wmr(spark):
    assert one(spark, M.wmr("t", "p"), t="hello world i'm new", p="hello world") == 50.0


def test_bitparallel_matches_dp():
    rnd = random.Random(7)
    for _ in range(2000):
        a = "".join(rnd.choice("abcé") for _ in range(rnd.randint(0, 90)))
        b = "".join(rnd.choice("abcd") for _ in range(rnd.randint(0, 90)))
        assert M.bitparallel_distance(a, b) == M.edit_distance(a, b)


def test_similarity():
    assert M.similarity_py("abc", "abc") == 100.0
    assert M.similarity_py("", "") == 100.0
    assert round(M.similarity_py("kitten", "sitting"), 4) == round(200 * 4 / 13, 4)


def test_text_transforms(spark):
    assert one(spark, TX.lower("t"), t="Hello Привет 123") == "hello привет 123"
    assert one(spark, TX.latin_to_cyrillic("t"), t="Aa") == "Аа"
    assert one(spark, TX.make_sentence(F.col("t")), t="hello") == "Hello:"
    assert one(spark, TX.make_sentence(F.col("t")), t="hello.") == "Hello."
    assert one(spark, TX.count_words("t"), t=" a  b c ") == 3
    assert one(spark, TX.split_line_by_sentence(F.col("t"), r"[.?]"), t="One. Two? rest") == ["One.", "Two?"]
    assert one(spark, TX.split_line_by_sentence(F.col("t"), r"[.?]"), t=" none ") == ["none"]
    assert one(spark, TX.extract_from_brackets(F.col("t"), ["()"]), t="a (b (c) d) e (g)") == ["b (c) d", "g"]
    assert one(spark, TX.extract_from_brackets(F.col("t"), ["[]", "()"]), t=") (a) [b] () [c (d)] (e") == ["b", "c (d)"]
    assert one(spark, TX.uppercase_after_period(F.col("t")), t="a. b! c") == "a. B! C"
    assert one(spark, TX.uppercase_after_period(F.col("t")), t=". . x é. é\n") == ". . x é. É\n"


def test_hallucination_flags(spark):
    df = spark.createDataFrame([("yes yes yes yes yes",), ("short mid " + "x" * 30,), ("a normal sentence",)], ["t"])
    flags = TX.hallucination_flags(F.col("t"))
    rows = df.select(flags["hall_repeated_ngrams"].alias("r"), flags["hall_long_word"].alias("l")).collect()
    assert [(r.r, r.l) for r in rows] == [(True, False), (False, True), (False, False)]


def test_generation_cleanup(spark):
    df = spark.createDataFrame([("<|im_start|>x<|im_start|>Output: hello world<|im_end|>junk", "hello world"),
                                ("HELLO WORLD", "hello world"), ("totally different", "hello world")], ["g", "t"])
    got = [(r.x.text, r.x.replaced) for r in df.select(TX.generation_fallback(F.col("g"), F.col("t")).alias("x")).collect()]
    assert got == [("hello world", 0), ("hello world", 1), ("hello world", 1)]


def test_expressions(spark):
    from corpusflow.functions.exprs import lambda_expression
    df = spark.createDataFrame([(2.0, 3, "ab")], ["duration", "n", "text"])
    df = lambda_expression(df, "d2", "entry.duration * 2")
    df = lambda_expression(df, "t", "'long' if entry.duration > 1 else 'short'")
    df = lambda_expression(df, "l", "len(entry.text)")
    df = lambda_expression(df, "m", "max(entry.n, entry.duration * 2)")
    df = lambda_expression(df, "mod", "-7 % entry.n")
    df = lambda_expression(df, "both", "entry.n == 3 and entry.duration < 5")
    r = df.first()
    assert (r.d2, r.t, r.l, r.m, r.mod, r.both) == (4.0, "long", 2, 4.0, 2, True)
    kept = lambda_expression(df, "keep", "entry.n > 5", filter=True)
    assert kept.count() == 0


@pytest.mark.parametrize("expression", [
    "entry.t[::-1]", "entry.t[1:7:2]", "entry.t[::3]", "entry.t[7:1:-2]", "entry.t[-2::-3]", "entry.t[:2:-1]", "entry.t[5:2]", "entry.t[9:0:-4]",
    "entry.big // 3", "-entry.big // 7", "entry.big % 10", "-entry.big % 10", "entry.n // -2", "entry.n % -3", "entry.n ** 3", "entry.x // 2", "entry.n ** -1",
    "entry.n and entry.big", "entry.z and entry.big", "entry.z or entry.n", "entry.e or entry.t", "not entry.e", "not entry.n", "'yes' if entry.e else 'no'",
    "'yes' if entry.t else 'no'", "entry.n > 3 and entry.x > 1", "abs(entry.n - 9)", "sum(entry.l)", "sorted(entry.l)", "min(entry.l)", "entry.l[::-1]", "entry.l[1::2]", "entry.l[-1]"])
def test_expressions_equal_python(spark, expression):
    from types import SimpleNamespace

    from corpusflow.functions.exprs import lambda_expression
    row = {"t": "abcdefgh", "big": 2 ** 60 + 7, "n": 5, "z": 0, "x": 7.5, "e": "", "l": [3, 1, 2]}
    df = spark.createDataFrame([tuple(row.values())], "t string, big long, n long, z long, x double, e string, l array<long>")
    want = eval(expression, {"entry": SimpleNamespace(**row), "abs": abs, "sum": sum, "sorted": sorted, "min": min})  # noqa: S307
    assert lambda_expression(df, "out", expression).first().out == want


def test_chained_comparison_uses_the_first(spark):
    from corpusflow.functions.exprs import lambda_expression
    df = spark.createDataFrame([(5,)], "n long")
    assert lambda_expression(df, "out", "1 < entry.n < 3").first().out is True


def test_distance_of_similar_long_texts():
    """A distance of a few edits takes a narrow band, however long the texts are."""
    import random
    import time

    rng = random.Random(5)
    a = "".join(rng.choice("abcdefgh ") for _ in range(250_000))
    b = list(a)
    for at in range(1000, 250_000, 25_000):
        b[at] = "#"
    began = time.process_time()
    assert M.bitparallel_distance(a, "".join(b[:120_000] + b[120_003:])) == 13
    assert M.bitparallel_distance(a, a) == 0
    assert time.process_time() - began < 8


def test_distance_in_bands():
    import random

    rng = random.Random(6)
    for n in (0, 1, 40, 600, 1500):
        for rate in (0.01, 0.2, 0.9):
            a = [rng.choice("abcdefghijklm") for _ in range(n)]
            b = [y for x in a for y in ([x] if rng.random() > rate else rng.choice([[], ["z"], [x, "a"]]))]
            for x, y in ((a, b), (b, a), (a, b[n // 3:] + b[:n // 3])):
                assert M.bitparallel_distance("".join(x), "".join(y)) == M.edit_distance(x, y)
