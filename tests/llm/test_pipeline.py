"""The pipeline against plain versions of its stages, and the registered queries."""
from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as P
import plain
from corpusflow.llm import mixing, pieces, quality, queries
from corpusflow.llm.store import code_point_words


@pytest.fixture(scope="module")
def folder(tmp_path_factory, docs):
    path = tmp_path_factory.mktemp("tables")
    docs.withColumn("n_chars", F.char_length("text").cast("long")).write.parquet(f"{path}/documents.parquet")
    return str(path)


def test_stages(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    rows = {r["doc_id"]: r for r in docs.collect()}
    names = [f.split()[0] for f in quality.SCHEMA.split(", ")]
    judged = {i: dict(zip(names, quality.judge(r["text"], quality.QualityParams()))) for i, r in rows.items()}
    want = {i: j["clean_text"] for i, j in judged.items() if j["kept"]}
    assert want and len(want) < len(rows)
    got = P.STAGES[0][1](spark, docs, folder)
    assert got.columns == docs.columns and {r["doc_id"]: r["text"] for r in got.collect()} == want
    assert all(r["n_chars"] == len(r["text"]) for r in got.collect())

    cut = plain.line_runs(sorted(want.items()))
    want = {i: t for i, (n, t) in cut.items() if plain.words(t) or n == 0}
    got = P.STAGES[1][1](spark, got, folder)
    assert got.columns == docs.columns and {r["doc_id"]: r["text"] for r in got.collect()} == want

    want = {i: want[i] for i, (_, c) in plain.near_components(sorted(want.items())).items() if i == c}
    got = P.STAGES[2][1](spark, got, folder)
    assert got.columns == docs.columns and {r["doc_id"]: r["text"] for r in got.collect()} == want

    copies = {r["doc_id"]: r["copies"] for r in mixing.mix_sources(got, emit=False).collect()}
    got = P.STAGES[3][1](spark, got, folder)
    mixed = Counter(r["doc_id"] for r in got.collect())
    assert got.columns == docs.columns and mixed == Counter({i: c for i, c in copies.items() if c})

    table = pieces.load_pieces(pieces.default_model())
    last = P.run(spark, folder).collect()
    assert Counter(r["doc_id"] for r in last) == mixed
    for r in last:
        assert r["round_trip"] and pieces.decode_ids(r["ids"], table) == want[r["doc_id"]] and r["n_tokens"] == len(r["ids"])


def test_mixing_stage_of_a_large_corpus(spark, folder, monkeypatch):
    """Each word is counted so often that there are 400 million: the level's numerator still
    fits into 32 bits, five times of it does not."""
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    few = Counter(r["doc_id"] for r in P.mix(spark, docs, folder).collect())
    times = 400_000_000 // sum(len(plain.words(r["text"])) for r in docs.collect())
    monkeypatch.setattr(mixing, "code_point_words", lambda text: code_point_words(text) * times)
    many = Counter(r["doc_id"] for r in P.mix(spark, docs, folder).collect())
    assert few and many == few


def test_quality_stage_runs_the_rules_once(spark, folder):
    plan = P.quality_rules(spark, spark.read.parquet(f"{folder}/documents.parquet"), folder)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 1 and "ArrowEvalPython" not in plan


def test_stages_odd(spark, odd_docs):
    d = odd_docs.withColumn("kept", F.lit("x")).withColumn("__q", F.lit(1))
    left = P.quality_rules(spark, d, "")
    assert left.columns == d.columns and all(len(r["text"].split()) >= 50 for r in left.collect())
    for stage in (P.line_dedup, P.near_dedup, P.mix):
        got = stage(spark, d, "")
        assert got.columns == d.columns
        got.collect()
    assert P.tokenise(spark, d, "").count() == 10


def test_empty_documents(spark, tmp_path, no_docs):
    no_docs.write.parquet(f"{tmp_path}/documents.parquet")
    assert P.run(spark, str(tmp_path)).count() == 0


def test_registered():
    import __spark_entry__ as E

    have = E.queries()
    assert all(any(n.startswith(f"op{k}_") for n in have) for k in range(1, 11)) and "pipeline" in have
    assert set(queries.ORACLES) <= set(queries.QUERIES)
