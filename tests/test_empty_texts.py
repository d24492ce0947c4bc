"""Queries over a table that holds texts without characters or words: the other rows
come out, and such a text gives what the registered SQL says."""
import pytest
from pyspark.sql import functions as F

from corpusflow.functions import metrics as M
from corpusflow.functions import text as TX
from corpusflow.plans import queries as Q

TEXTS = [(1, ""), (2, "the long text of the house and the tree"), (3, "   "), (4, "\n "), (5, ".?!"), (6, "yes yes yes yes yes"),
         (7, "hello"), (8, ""), (9, None), (10, "say.")]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("empty")
    docs = [(i, t, "en", "s", len(t or "")) for i, t in TEXTS]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{path}/documents.parquet")
    turns = [(1, 0, "system", "say!"), (1, 1, "system", "..."), (1, 2, "user", "hello")]
    spark.createDataFrame(turns, "conv_id long, turn int, role string, text string").write.parquet(f"{path}/conversations.parquet")
    return str(path)


def found(spark, folder, name):
    return {r["doc_id"]: tuple(r)[1:] for r in Q.QUERIES[name](spark, folder).collect()}


def by_sql(folder, name):
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for t in ("documents", "conversations"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet/*.parquet'")
    return {r[0]: r[1:] for r in con.sql(Q.ORACLES[name]).fetchall()}


def test_hallucination_flags(spark, folder):
    got, want = found(spark, folder, "hallucination_flags"), by_sql(folder, "hallucination_flags")
    assert got.pop(9)[:2] == want.pop(9)[:2] == (None, False)
    assert got == want and len(got) == 9
    assert got[1] == got[3] == got[4] == (False, False, True) and got[7] == (False, False, False) and got[6] == (True, False, False)


def test_hallucination_gate(spark, folder):
    got = found(spark, folder, "hallucination_gate")
    assert got == by_sql(folder, "hallucination_gate") and set(got) == {2, 7}


def test_hallucination_gate_keeps_a_text_without_words_that_is_no_phrase(spark, folder, tmp_path):
    for t in ("documents", "conversations"):
        spark.read.parquet(f"{folder}/{t}.parquet").filter("text IS NULL OR text <> '...'").write.parquet(f"{tmp_path}/{t}.parquet")
    got = found(spark, tmp_path, "hallucination_gate")
    assert got == by_sql(tmp_path, "hallucination_gate") and set(got) == {1, 2, 3, 4, 5, 7, 8}


def test_make_sentence(spark, folder):
    got = found(spark, folder, "make_sentence")
    assert got == by_sql(folder, "make_sentence")
    assert got[1] == got[8] == ("",) and got[3] == ("   ",) and got[7] == ("Hello:",) and got[9] == (None,) and len(got) == 10
    with pytest.raises(Exception, match="empty text"):
        spark.range(1).select(TX.make_sentence(F.lit(""))).collect()


def test_cer_filter(spark, folder):
    got, want = found(spark, folder, "cer_filter"), by_sql(folder, "cer_filter")
    assert got == want and {3, 4, 5} <= set(got) and not {1, 8, 9} & set(got)
    with pytest.raises(Exception, match="division by zero"):
        spark.range(1).select(M.cer(F.lit(""), F.lit("a"))).collect()


def test_wmr_filter(spark, folder):
    """A text without words has no rate, so it does not reach the threshold."""
    got = found(spark, folder, "wmr_filter")
    assert got == {5: (100.0,), 6: (100.0,), 7: (100.0,), 10: (100.0,)}
    with pytest.raises(Exception, match="division by zero"):
        spark.range(1).select(M.wmr(F.lit(" "), F.lit("a"))).collect()


def test_wer_column(spark, folder):
    """Every row comes out; a text without words has no rate."""
    got = found(spark, folder, "wer_column")
    assert set(got) == {i for i, _ in TEXTS}
    assert got[1] == got[3] == got[8] == got[9] == (None,)
    assert got[7] == got[6] == (100.0,) and got[10] == got[5] == (0.0,) and got[4] == (0.0,) and got[2] == (66.67,)
    with pytest.raises(Exception, match="division by zero"):
        spark.range(1).select(M.wer(F.lit(" "), F.lit("a"))).collect()
