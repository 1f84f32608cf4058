"""Registered corpus queries: SQL twins, and the pipeline against its plain version."""

import pytest

import corpus_pipeline
from pedalpath.llm.queries import QUERIES
from pedalpath.llm.sql import SQL
from . import brute
from ..compare import connect, difference
from ..conftest import DATA


def test_names():
    assert sorted(QUERIES, key=lambda n: int(n[2:].split("_")[0])) and len(QUERIES) == 13 and set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(SQL))
def test_twin(spark, name):
    assert difference(spark, connect(DATA), DATA, QUERIES[name], SQL[name]) is None


def test_pipeline(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{DATA}/benchmark.parquet").collect()]
    rows = [r.asDict() for r in docs.collect()]
    rows = brute.near_stage(brute.line_stage(brute.quality_stage(rows), min_words=1, line_words=3))
    rows = [r for r in rows if not brute.leaked(r["text"], items)]
    wanted = sorted((r["doc_id"], k, r["text"], r["n_chars"]) for r, (*_, times) in zip(rows, brute.mixture(rows)) for k in range(1, times + 1))
    found = corpus_pipeline.run(spark, DATA)
    assert found.columns == [*docs.columns, "repetition"]
    assert sorted((r.doc_id, r.repetition, r.text, r.n_chars) for r in found.collect()) == wanted
