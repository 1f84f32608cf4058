"""Repeats and threats that earlier versions of the operators let through."""

import random

from pedalpath.llm import decontaminate, line_dedup, span_dedup, toxicity
from pedalpath.llm.queries import QUERIES
from .test_operators import VOCABULARY, prose


def test_single_repeated_lines(spark, tmp_path):
    """A line between different neighbours, a passage of over 50 words in one line, and a short run of two lines."""
    rng = random.Random(2)
    fresh = lambda: prose(rng, 12)
    line, passage = "a single line of eight words that repeats", prose(rng, 60).replace("\n", " ")
    rows = [(i, "\n".join([fresh(), line, fresh(), "Contents", fresh(), passage, fresh(), "see also", "the notes", fresh()])) for i in range(4)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    found = QUERIES["op6_line_dedup"](spark, str(tmp_path)).collect()
    assert {(r.doc_id, r.first_line, r.last_line, r.first_doc_id) for r in found} == {
        (i, a, b, 0) for i in range(1, 4) for a, b in ((1, 1), (5, 5), (7, 8))}
    left = {r.doc_id: r.text.split("\n") for r in line_dedup.drop_repeated_lines(docs, line_dedup.WHOLE).collect()}
    for i, text in rows:
        assert left[i] == [x for k, x in enumerate(text.split("\n")) if i == 0 or k not in (1, 5, 7, 8)]


def test_target_after_threat():
    grammar = toxicity.Grammar({"=moron": 2.0})
    for text in (b"I will kill you", b"We could hurt them", b"I want to destroy all of you"):
        assert grammar.features(text)[1] > 0
    assert grammar.features(b"What a moron you are")[1] > 0
    # a target in the next clause, or out of reach
    assert not any(grammar.features(b"We beat eggs. You eat them"))
    assert not any(grammar.features(b"We beat eggs with a large fork before they melt"))


def test_learned_weight_of_threat():
    plain, learned = (toxicity.Grammar(w).features(b"I kill time") for w in ({}, {"=kill": 2.0}))
    assert not any(plain) and learned[0] > 0
    assert toxicity.Grammar({"=kill": 2.0}).features(b"I kill you")[1] > toxicity.Grammar({}).features(b"I kill you")[1]


def test_passage_at_any_offset(spark):
    """A passage within text without full stops, at offsets that differ, and between full stops of another script."""
    rng = random.Random(4)
    words = lambda n: [rng.choice(VOCABULARY) + rng.choice(VOCABULARY) for _ in range(n)]
    passage = words(50)
    rows = [(i, " ".join(words(11 + 7 * i) + passage + words(30))) for i in range(6)]
    other = "。".join(" ".join(words(13)) for _ in range(4))
    rows += [(i, " ".join(words(10 + i)) + "。" + other + "。" + " ".join(words(14))) for i in (6, 7)]
    found = {r.doc_id: r for r in span_dedup.dedup_report(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert set(found) == {1, 2, 3, 4, 5, 7}
    assert all(r.n_words >= 36 and r.first_doc_ids == [0 if r.doc_id < 6 else 6] for r in found.values())
    assert all(len(w) <= 24 for w in span_dedup.sentences(("word " * 3000).encode())[1])


def leaked(spark, items, texts):
    rows = [spark.createDataFrame(list(enumerate(t)), f"{n} long, text string") for n, t in (("item_id", items), ("doc_id", texts))]
    return {(r.doc_id, r.item_id) for r in decontaminate.leaks(rows[1], rows[0]).collect()}


def test_leaks_without_plain_words(spark):
    """Items of numbers, units and names, and of few tokens, word for word."""
    items = ["Compute 3 + 4 * 5 - 2", "Paris 12 kg, Rome 15 kg, Berlin 20 kg, Madrid 31 kg, Oslo 7 kg", "short item", None]
    texts = [f"They were told: {t} and so on." for t in items[:3]] + ["Compute 3 + 4 * 5 - 7", "Paris 13 kg, Rome 16 kg, Berlin 21 kg, Madrid 32 kg", "item short"]
    assert leaked(spark, items, texts) == {(0, 0), (1, 1), (2, 2)}


def test_leaks_names_at_sentence_start(spark):
    """Another name at the start of a sentence, a short item quoted in mid-sentence, and one of two equal numbers edited."""
    two = "the first box of the red ones here holds 12 marbles while every other box that stands behind the tall door of the long hall holds 12 of them"
    items = ["Alice has 5 apples. Alice buys 3 more pears at the market.", "Find the sum of all odd digits", two]
    texts = ["Bob has 8 apples. Bob buys 9 more pears at the market.", "As it says: Find the sum of all odd digits", two.replace("12", "40", 1)]
    assert leaked(spark, items, texts) == {(0, 0), (1, 1), (2, 2)}
