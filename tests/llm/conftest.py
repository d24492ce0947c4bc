import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def _sentence(rng, n):
    return " ".join("".join(rng.choice(["th", "er", "on", "an", "re", "he", "in", "ed"]) for _ in range(rng.randint(1, 4))) for _ in range(n)) + "."


def make_rows(seed=7, n=60):
    """Prose with exact and near copies, shared passages, repeated lines, a group
    of many near copies, empty, null, short and long texts."""
    rng = random.Random(seed)
    passage = _sentence(rng, 40)
    base = [_sentence(rng, 70) for _ in range(3)]
    rows = []
    for i in range(n):
        kind = i % 10
        lines = [_sentence(rng, rng.randint(4, 30)) for _ in range(rng.randint(3, 9))]
        if kind == 1 and rows:
            text = rows[rng.randrange(len(rows))][1]
        elif kind == 2:
            w = base[i % 3].split()
            w[rng.randrange(len(w))] = "changed"
            text = " ".join(w)
        elif kind == 3:
            text = "\n".join(lines[:2] + [passage] + lines[2:])
        elif kind == 4:
            text = "\n".join(lines[:1] + ["One common line.", "", "Another common line."] + lines[1:])
        elif kind == 5:
            text = "\n".join(x.replace(" ", "### ") for x in lines)
        elif kind == 6:
            text = "\n".join(lines) + "\n" + "\n".join(lines[:3])
        elif kind == 7:
            text = ["", None, "word", "a b c", " \t\n", "é " * 30, "x" * 260][i // 10 % 7]
        else:
            text = "\n".join(lines)
        rows.append((i, text, "en", None if i % 9 == 8 else f"s{i % 4}", len(text or "")))
    rows.append((n, " ".join(_sentence(rng, 30) for _ in range(40)) + " " + passage, "en", "s0", 0))
    rows.append((n + 1, "tail " * 700, "en", "s1", 0))
    return rows


@pytest.fixture(scope="session")
def rows():
    return make_rows()


@pytest.fixture(scope="session")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in every column, a repeated row, ties, and an identifier with two texts."""
    long = " ".join(f"w{i}" for i in range(60)) + "."
    return spark.createDataFrame([
        (1, long, "en", "s0", 1), (1, long, "en", "s0", 1), (2, long, None, None, None), (None, long, None, None, None),
        (None, None, None, None, None), (3, None, "en", "s1", 0), (4, "", "en", "s1", 0), (5, "a b", "en", "s1", 3),
        (5, long + " more", "en", "s0", 3), (-7, "a b", "en", None, 3)], SCHEMA)
