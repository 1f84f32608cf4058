"""Equal rows at a cut-off, short items, labels that differ, and columns named like the operators' own."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from pedalpath.config import PathConfig
from pedalpath.llm import decontaminate, line_dedup, mixing, ngram_join, span_dedup, toxicity
from . import brute
from ..conftest import DATA

NAMES = ["cut_doc", "cut_sig", "cut_ranges", "cut_lines", "all_lines", "text_left", "leak_doc", "leak_sig", "gone", "again", "repetition",
         "mix_place", "mix_size", "mix_times", "plan_source", "plan_whole", "plan_below", "plan_rest", "cut_key", "cut_upto", "n", "of", "pos",
         "doc", "sig", "node", "words", "h", "__doc", "__sig", "__cut", "__take", "__of", "__gone", "__lines"]


def _docs(spark):
    line = "a passage of many words that stands in several documents and has more than twenty words in all to be sure of it"
    rows = [(i, f"{line}\n{line} again\nown words of number {i} " + " ".join(f"w{i}x{k}" for k in range(60)), "en", f"s{i % 3}") for i in range(12)]
    rows += [(12, rows[0][1], "en", "s0"), (None, "no number here " * 20, None, None), (13, None, "en", "s1"), (14, "", "en", "s1")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string").withColumn("n_chars", F.length("text").cast("bigint"))
    return df.select("*", *[F.lit(i).alias(n) for i, n in enumerate(NAMES)])


@pytest.mark.parametrize("stage", [
    lambda d, i: span_dedup.without_repeats(d), lambda d, i: decontaminate.without_leaks(d, i), lambda d, i: line_dedup.drop_repeated_lines(d, line_dedup.WHOLE),
    lambda d, i: mixing.mix_documents(d), lambda d, i: ngram_join.one_per_component(d)], ids=["spans", "leaks", "lines", "mix", "near"])
def test_columns_named_like_helpers_pass_through(spark, stage):
    docs = _docs(spark)
    items = spark.createDataFrame([(1, "own words of number 3 w3x0 w3x1 w3x2 w3x3 w3x4 w3x5")], "item_id bigint, text string")
    bare = stage(docs.drop(*NAMES), items)
    found = stage(docs, items)
    assert set(found.columns) >= set(docs.columns)
    rows = found.collect()
    assert rows and all([r[n] for n in NAMES] == list(range(len(NAMES))) for r in rows)
    key = lambda r: (r["doc_id"] is None, r["doc_id"] or 0, r["text"] or "", r["n_chars"] or 0)
    assert sorted(map(key, rows)) == sorted(map(key, bare.collect()))


def test_every_stage_with_such_columns(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet").select("*", *[F.lit(i).alias(n) for i, n in enumerate(NAMES)])
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, DATA)
        assert set(NAMES) <= set(docs.columns)
    rows = docs.collect()
    assert rows and all([r[n] for n in NAMES] == list(range(len(NAMES))) for r in rows)


@pytest.mark.parametrize("limit", [PathConfig(), PathConfig(max_group_rows=7)], ids=["whole", "pieces"])
def test_copies_at_the_cut_off_are_taken_as_far_as_they_fit(spark, limit):
    """Three sources of one row a hundred times: every source comes near its target."""
    rows = [(s, " ".join(["w"] * (150, 100, 50)[s]), f"s{s}") for s in range(3) for _ in range(100)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    mix = mixing.Mix(limit=limit)
    report = mixing.mix_report(docs, mix).collect()
    per = {}
    for r in report:
        per.setdefault(r["doc_id"], [0, r["target"], r["size"]])[0] += r["taken"]
    assert len(report) == 300 and all(abs(taken - target) <= size for taken, target, size in per.values())
    assert mixing.mix_documents(docs, mix).count() == sum(r["repetitions"] for r in report)
    dicts = [{"doc_id": d, "text": t, "source": s} for d, t, s in rows]
    assert sorted((r["doc_id"], r["repetitions"]) for r in report) == sorted((d["doc_id"], m[3]) for d, m in zip(dicts, brute.mixture(dicts)))


def test_short_items_are_whole_lines(spark):
    docs = spark.createDataFrame([(1, "The cat sat."), (2, "a\nThe\nb"), (3, "The"), (4, "Tell me the\nthe end"), (5, "x\nfour by four\ny"), (6, "x four by four y")],
                                 "doc_id bigint, text string")
    items = spark.createDataFrame([(1, "The"), (2, "four by four")], "item_id bigint, text string")
    found = {(r["doc_id"], r["item_id"], r["first_word"]) for r in decontaminate.leaks(docs, items).collect()}
    assert found == {(2, 1, 1), (3, 1, 0), (5, 2, 1)}
    assert sorted(r["doc_id"] for r in decontaminate.without_leaks(docs, items).collect()) == [1, 4, 6]


def test_labels_that_differ_give_one_model_in_any_order(spark):
    rows = [(i, f"you are a vile idiot number {i} go away" if i % 2 else f"a kind and quiet sentence number {i}") for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    labels = [(i, i % 2) for i in range(300)] + [(i, 1 - i % 2) for i in range(0, 300, 10)]
    scores = []
    for some in (labels, labels[::-1]):
        table = spark.createDataFrame(some, "doc_id bigint, toxic int")
        found = toxicity.score_documents(docs, toxicity.train(docs, table))
        scores.append(sorted((r["doc_id"], round(r["score"], 9)) for r in found.collect()))
    assert scores[0] == scores[1]
