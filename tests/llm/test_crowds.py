"""Many near copies of a text that is not there, most of them just too different to link."""

import random

from pedalpath.llm import common, ngram_join
from . import brute


def edited(rng, words, edits, pool):
    words = list(words)
    for _ in range(edits):
        at = rng.randrange(len(words))
        kind = rng.random()
        if kind < 0.4:
            words[at] = rng.choice(pool) if rng.random() < 0.3 else f"new{rng.randrange(10**9)}"
        elif kind < 0.8:
            del words[at]
        else:
            del words[at:at + rng.randrange(12)]
    return " ".join(words)


def test_crowd_of_near_copies(spark, monkeypatch):
    """Components as by brute force, and few pairs compared; sizes lie on both sides of a ring's edge."""
    rng = random.Random(11)
    pool = [f"typo{i}" for i in range(4)]
    rows = []
    for size, copies in ((136, 170), (70, 60)):
        words = [f"w{size}x{i}" for i in range(size)]
        rows += [edited(rng, words, rng.randint(1, size // 20), pool) for _ in range(copies)]
    rows = [{"doc_id": i, "text": t} for i, t in enumerate(rng.sample(rows, len(rows)))]
    compared, put = [], common.Scratch.put

    def counting(self, df, label):
        table = put(self, df, label)
        if label == "pairs":
            compared.append(table.count())
        return table

    monkeypatch.setattr(common.Scratch, "put", counting)
    found = ngram_join.similar_sets(spark.createDataFrame([(r["doc_id"], r["text"]) for r in rows], "doc_id long, text string"))
    wanted = brute.components(rows)
    assert {r.doc_id: r.component_id for r in found.collect()} == wanted
    assert 20 < len(set(wanted.values())) < len(rows) - 20
    assert sum(compared) <= 4 * len(rows)
