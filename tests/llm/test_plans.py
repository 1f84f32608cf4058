"""Plans that loops and joins hand to the driver stay small, and what they give is the same."""

import random

import numpy as np

from pedalpath.llm import common, ngram_join


def test_plans_of_the_join_are_small(spark, monkeypatch):
    """No stored table of the join has a plan of more than 40 operators: the driver keeps plans, and their generated code."""
    sizes, put = {}, common.Scratch.put

    def measuring(self, df, label):
        sizes[label] = max(sizes.get(label, 0), len(df._jdf.queryExecution().optimizedPlan().toString().strip().splitlines()))
        return put(self, df, label)

    monkeypatch.setattr(common.Scratch, "put", measuring)
    rng = random.Random(5)
    base = [f"w{i}" for i in range(60)]
    rows = [(i, " ".join(w if rng.random() > 0.02 else f"x{rng.randrange(99)}" for w in base)) for i in range(60)]
    ngram_join.similar_sets(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert max(sizes.values()) <= 40, sizes


def test_components_of_random_graphs(spark):
    rng = random.Random(3)
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, 100 + i) for i in range(1, 60)] + [(7, 7)]
    edges += [(rng.randrange(200, 400), rng.randrange(200, 400)) for _ in range(120)]
    edges = [e if rng.random() < 0.5 else e[::-1] for e in edges + edges[:20]]
    least = {x: x for e in edges for x in e if e[0] != e[1]}
    for _ in range(len(least)):
        for a, b in edges:
            if a != b:
                least[a] = least[b] = min(least[a], least[b])
    with common.Scratch(spark, "components-test") as scratch:
        found = [tuple(r) for r in common.components(spark.createDataFrame(edges, "a long, b long"), scratch).collect()]
    assert len(found) == len(set(found)) and dict(found) == least


def test_bitmap_has_every_bit(spark):
    """Also the highest bit of a word, which is the sign of an int."""
    hashes = np.array([0, 31, 32, 63, 1023, -1, 5 - (1 << 62)], dtype=np.int64)
    found = common.bitmap_of(spark.createDataFrame([(int(h),) for h in hashes], "h long"), "h", 10)
    assert found.dtype == np.uint32 and common.in_bitmap(found, hashes.view(np.uint64)).all()
    assert int(np.unpackbits(found.view(np.uint8)).sum()) == len({int(h) & 1023 for h in hashes})
