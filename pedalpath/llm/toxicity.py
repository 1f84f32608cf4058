"""Toxicity by a weighted finite-state grammar over clauses.

Words are mapped to classes: insult (with a learned weight), threat, target, negation, reporting, other. Four small transducers
read a clause's classes, and their product is one machine that emits, at each insult or threat, the contexts it
stands in: aimed at a target, negated, reported. A match that no target stands before waits for one among the next
``ahead`` words of its clause. A threat has its fixed weight where it is aimed, and at least the weight learned for its stem. A clause scores by its matches; a text by the sums over its clauses in
each context, its strongest clause, and the share of its words that match. A logistic function of these is the score.

Learning. Insults are word stems (first three to six letters, or whole words) that labelled toxic texts hold far
oftener than others; counts are made by Spark. The logistic weights are fitted on other labelled texts than the stems. Both
use at most ``max_rows`` labelled rows each, chosen by hash, whatever the size of the corpus; no row of the held-out third is
among them. Scoring reads every text whole and uses nothing but its words.

Defined results for odd input: null and empty texts have no clause and get the score of no match; repeated rows are scored
each; rows without a number are held in, as crc32 of a null is null; without labels of both kinds only the fixed
word classes count, with fixed weights; texts of any length are read whole; an empty table gives an empty one; other
columns are not read.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from .common import map_batches, texts

#: Closed word classes, in English, German, French and Spanish.
TARGETS = frozenset("you your yours yourself u ur they them he she du dich dir dein deine ihr euch tu te toi ton ta vous votre "
                    "tú ti usted ustedes vosotros su".split())
NEGATIONS = frozenset("not never nobody isn aren wasn don doesn didn nicht kein keine niemals nie pas jamais aucun aucune "
                      "nunca jamás ningún ninguna".split())
REPORTS = frozenset("said says say quoted called wrote writes claimed claims reported according sagte sagt schrieb berichtet dit "
                    "déclaré écrit selon dijo dice escribió según".split())
THREATS = frozenset("kill murder hurt destroy shoot stab beat hang burn töten umbringen verletzen schlagen tuer frapper détruire "
                    "matar golpear destruir".split())
OTHER, INSULT, THREAT, TARGET, NEGATION, REPORT = range(6)
_TOKEN = re.compile(r"[^\W\d_]+|[.!?;\n]+")
_BREAK = frozenset(".!?;\n")


@dataclass(frozen=True)
class ToxicityRules:
    max_rows: int = 10_000
    #: a stem is an insult from this log ratio on, in at least this many toxic texts and this share of them
    least_weight: float = 1.2
    least_texts: int = 3
    least_share: float = 0.01
    #: a text counts a stem so many times at most
    most_in_text: int = 3
    stems: tuple[int, ...] = (3, 4, 5, 6)
    max_stems: int = 5_000
    #: how far a negation reaches, in words
    reach: int = 2
    #: how far after a match a target may stand, in words
    ahead: int = 4
    threshold: float = 0.7


DEFAULT = ToxicityRules()


@dataclass(frozen=True)
class Model:
    weights: dict[str, float] = field(default_factory=dict)
    mean: tuple[float, ...] = ()
    scale: tuple[float, ...] = ()
    coefficients: tuple[float, ...] = ()
    bias: float = -3.0


# --- transducers

def _machines(reach: int) -> list[dict]:
    """Each is (states, step); a step takes (state, class) to (state, whether a match now stands in its context)."""
    seen = {s: {c: (1 if s or c == REPORT else 0, bool(s)) for c in range(6)} for s in (0, 1)}
    aimed = {s: {c: (1 if s or c == TARGET else 0, bool(s)) for c in range(6)} for s in (0, 1)}
    negated = {s: {c: (reach if c == NEGATION else max(0, s - 1), s > 0) for c in range(6)} for s in range(reach + 1)}
    matched = {0: {c: (0, c in (INSULT, THREAT)) for c in range(6)}}
    return [matched, aimed, negated, seen]


def compose(machines: list[dict]) -> tuple[dict, tuple]:
    """The product machine over the reachable states: (state, class) -> (state, outputs)."""
    start = tuple(0 for _ in machines)
    table, todo = {}, [start]
    while todo:
        state = todo.pop()
        if (state, OTHER) in table:
            continue
        for c in range(6):
            moves = [m[s][c] for m, s in zip(machines, state)]
            after = tuple(s for s, _ in moves)
            table[state, c] = after, tuple(o for _, o in moves)
            todo.append(after)
    return table, start


class Grammar:
    """Runs the machine over texts. Classes of words are worked out once and kept for at most ``room`` words."""

    N_FEATURES = 8

    def __init__(self, weights: dict[str, float], rules: ToxicityRules = DEFAULT, room: int = 400_000):
        self.weights, self.rules, self.room = weights, rules, room
        self.table, self.start = compose(_machines(rules.reach))
        self.known: dict[str, tuple[int, float] | None] = {}

    def _class(self, token: str) -> tuple[int, float] | None:
        """(class, learned weight); None for a word that means nothing here."""
        if token[0] in _BREAK:
            return -1, 0.0
        word = token.lower()
        weight = max([self.weights.get("=" + word, 0.0), *(self.weights.get(word[:n], 0.0) for n in self.rules.stems if len(word) >= n)])
        if word in THREATS:
            return THREAT, weight
        if weight > 0:
            return INSULT, weight
        for c, words in ((TARGET, TARGETS), (NEGATION, NEGATIONS), (REPORT, REPORTS)):
            if word in words:
                return c, 0.0
        return None

    def _targets_ahead(self, classes: list[tuple[int, float] | None]) -> list[bool]:
        """Whether a target stands at most ``ahead`` words after each word, in its clause; read from the end."""
        found, left = [False] * len(classes), 0
        for i in range(len(classes) - 1, -1, -1):
            found[i] = left > 0
            kind = (classes[i] or (OTHER, 0.0))[0]
            left = 0 if kind < 0 else self.rules.ahead if kind == TARGET else max(0, left - 1)
        return found

    def features(self, text: bytes) -> list[float]:
        tokens = _TOKEN.findall(text.decode("utf-8", "replace"))
        known = self.known
        if len(known) > self.room:
            known.clear()
        for token in set(tokens):
            if token not in known:
                known[token] = self._class(token)
        classes = [known[t] for t in tokens]
        sums, best, n_words, n_matches = [0.0] * 4, 0.0, 0, 0
        if any(c is not None and c[0] in (INSULT, THREAT) for c in classes):
            after = self._targets_ahead(classes)
            state, clause = self.start, 0.0
            for i, c in enumerate(classes):
                kind, weight = c or (OTHER, 0.0)
                if kind < 0:
                    state, clause = self.start, 0.0
                    continue
                state, (match, aimed, negated, reported) = self.table[state, kind]
                if not match:
                    continue
                aimed = aimed or after[i]
                if kind == THREAT and aimed:
                    # the fixed weight needs somebody the threat is aimed at
                    weight = max(weight, 1.0)
                n_matches += weight > 0
                sums[3 if reported else 2 if negated else 1 if aimed else 0] += weight
                clause += weight * (0.3 if reported or negated else 1.5 if aimed else 1.0)
                best = max(best, clause)
        n_words = max(1, sum(c is None or c[0] >= 0 for c in classes))
        whole = sum(sums)
        return [*(math.log1p(x) for x in sums), math.log1p(best), math.log1p(100 * whole / n_words), math.log1p(n_matches),
                math.log1p(whole)]


# --- learning

def _third(number: Column) -> Column:
    return F.pmod(F.crc32(number.cast("string").cast("binary")), F.lit(3))


def _sample(docs: DataFrame, labels: DataFrame, third: int, rules: ToxicityRules) -> DataFrame:
    """(text, toxic) of at most about ``max_rows`` labelled rows of one third. Where labels of a number differ, toxic counts."""
    chosen = labels.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("toxic").cast("int").alias("toxic")) \
        .where(F.col("toxic").isNotNull() & (_third(F.col("doc_id")) == third)).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    chosen = chosen.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rules.max_rows)
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text")).join(chosen, "doc_id")


def learn_stems(sample: DataFrame, rules: ToxicityRules) -> dict[str, float]:
    """Weight of each insult stem: the smoothed log ratio of its mean counts in toxic and in other texts."""
    def make():
        def step(batch):
            for start in range(0, batch.num_rows, 200):
                part = batch.slice(start, 200)
                counts: dict[str, list[int]] = {}
                for toxic, text in zip(part["toxic"].to_pylist(), texts(part["text"])):
                    found: Counter[str] = Counter()
                    for word, n in Counter(re.findall(r"[^\W\d_]+", text.decode("utf-8", "replace").lower())).items():
                        found["=" + word] += n
                        for k in rules.stems:
                            if len(word) >= k:
                                found[word[:k]] += n
                    for stem, n in found.items():
                        row = counts.setdefault(stem, [0, 0, 0])
                        row[toxic] += min(n, rules.most_in_text)
                        row[2] += toxic
                for stem, (no, yes, held) in counts.items():
                    yield {"stem": stem, "no": no, "yes": yes, "held": held}
        return step

    totals = {r["toxic"]: r["count"] for r in sample.groupBy("toxic").count().collect()}
    yes, no = totals.get(1, 0), totals.get(0, 0)
    if not yes or not no:
        return {}
    weight = F.log((F.col("yes") + 0.5) / (yes + 1)) - F.log((F.col("no") + 0.5) / (no + 1))
    least = max(rules.least_texts, math.ceil(rules.least_share * yes))
    counted = map_batches(sample.select("toxic", "text"), make, "stem string, no bigint, yes bigint, held bigint", rows=20_000) \
        .groupBy("stem").agg(F.sum("no").alias("no"), F.sum("yes").alias("yes"), F.sum("held").alias("held")).where(F.col("held") >= least)
    rows = counted.select("stem", weight.alias("weight"), "yes").where(F.col("weight") >= rules.least_weight) \
        .orderBy(F.desc(F.col("weight") * F.sqrt("yes")), "stem").limit(rules.max_stems).collect()
    # of a stem and a longer one that has nearly all of its counts, the longer one says more
    longer: dict[str, int] = {}
    for r in rows:
        word = r["stem"].removeprefix("=")
        for n in range(1, len(word) + (word != r["stem"])):
            longer[word[:n]] = max(longer.get(word[:n], 0), r["yes"])
    return {r["stem"]: r["weight"] for r in rows if r["stem"][0] == "=" or longer.get(r["stem"], 0) < 0.9 * r["yes"]}


def _fit(x: np.ndarray, y: np.ndarray, rounds: int = 60, ridge: float = 0.5) -> tuple[np.ndarray, float]:
    """Logistic regression by Newton steps."""
    a = np.column_stack([x, np.ones(len(x))])
    w = np.zeros(a.shape[1])
    penalty = np.full(a.shape[1], ridge)
    penalty[-1] = 1e-6
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        gradient = a.T @ (p - y) + penalty * w
        curve = (a * (p * (1 - p) + 1e-9)[:, None]).T @ a + np.diag(penalty)
        move = np.linalg.solve(curve, gradient)
        w -= move
        if np.abs(move).max() < 1e-8:
            break
    return w[:-1], float(w[-1])


def train(docs: DataFrame, labels: DataFrame, rules: ToxicityRules = DEFAULT) -> Model:
    """Stems from one third of the numbers, the logistic function from another; the last third is never read."""
    stems = learn_stems(_sample(docs, labels, 0, rules), rules)

    def make():
        grammar = Grammar(stems, rules)

        def step(batch):
            for toxic, text in zip(batch["toxic"].to_pylist(), texts(batch["text"])):
                yield {"toxic": toxic, "x": grammar.features(text)}
        return step

    # bounded by max_rows
    table = map_batches(_sample(docs, labels, 2, rules).select("toxic", "text"), make, "toxic int, x array<double>").toArrow()
    y = table["toxic"].to_numpy().astype(float) if table.num_rows else np.empty(0)
    if not stems or not len(y) or y.min() == y.max():
        return Model(stems, coefficients=(1.0,) * Grammar.N_FEATURES, mean=(0.0,) * Grammar.N_FEATURES, scale=(1.0,) * Grammar.N_FEATURES)
    x = np.array(table["x"].to_pylist())
    mean, scale = x.mean(axis=0), x.std(axis=0) + 1e-6
    w, bias = _fit((x - mean) / scale, y)
    return Model(stems, tuple(mean), tuple(scale), tuple(w), bias)


def score_documents(docs: DataFrame, model: Model, rules: ToxicityRules = DEFAULT) -> DataFrame:
    """doc_id, held_out, score and predicted of every row."""
    def make():
        grammar = Grammar(model.weights, rules)
        mean, scale, w = (np.array(v) for v in (model.mean, model.scale, model.coefficients))

        def step(batch):
            for number, text in zip(batch["doc_id"].to_pylist(), texts(batch["text"])):
                z = float((np.array(grammar.features(text)) - mean) / scale @ w + model.bias)
                yield {"doc_id": number, "score": 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))}
        return step

    scored = map_batches(docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string")), make, "doc_id bigint, score double", rows=10_000)
    return scored.select("doc_id", F.coalesce(_third(F.col("doc_id")) == 1, F.lit(False)).alias("held_out"), "score",
                         (F.col("score") >= rules.threshold).cast("int").alias("predicted"))
