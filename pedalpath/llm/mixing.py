"""Mix sources to target weights: capped water-filling, then seeded whole and fractional repetitions.

Targets. Source s with weight w gets ``w * level`` words, at most ``epochs`` times its size; the level is raised in
rounds, each of which clamps the sources above their cap and shares the rest by weight, until none is above.

Repetitions. A source whose target is q times its size is taken floor(q) times whole; for the rest its documents stand
in a seeded order, by a hash of number and text, and those before a cut-off are taken once more. The cut-off is found
by digits: sizes are summed by the next digits of the hash, before the shuffle, and only the part that holds the
cut-off is split further. So a source of any size costs sums of bounded tables, and the choice is a rule on a row
itself: reruns agree, and no row is sorted or numbered.

Defined results for odd input: a null source is a source of its own, ordered last; a null text has size 0; a document
of size 0 is taken floor(q) times; of equal rows, which share a hash, as many are taken as come nearest to the cut-off, and
which of them is all one; an empty table gives an empty one; with all sizes 0 every target is 0; other columns pass
through, whatever their names.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..config import PathConfig
from ..operators.ordered import by_key, find_hot_keys, running
from .common import stored, with_free_name, word_count

DIGITS, LEVELS = 3, 4


@dataclass(frozen=True)
class Mix:
    weights: tuple[int, ...] = (5, 2, 1)
    epochs: int = 3
    seed: str = "mix-1"
    #: copies of the row at a cut-off beyond so many are numbered in pieces
    limit: PathConfig = PathConfig()


DEFAULT = Mix()


def _hash(mix: Mix) -> Column:
    number = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    whole = F.concat(F.lit(f"{mix.seed}|"), number, F.lit("|"), F.coalesce(F.col("text"), F.lit("")))
    return F.substring(F.md5(whole.cast("binary")), 1, DIGITS * LEVELS)


def sizes(docs: DataFrame, mix: Mix = DEFAULT) -> DataFrame:
    """(doc_id, source, size, place): what the mix needs of a document, without its text."""
    return docs.select("doc_id", F.col("source").cast("string").alias("source"), word_count(F.col("text")).alias("size"),
                       _hash(mix).alias("place"))


def targets(sized: DataFrame, mix: Mix = DEFAULT) -> DataFrame:
    """(source, source_size, target), one row per source.

    One row a round comes to the driver: the words and the weight that are still free. Ordering the sources takes one
    task, with a row per source.
    """
    per = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    order = Window.orderBy(F.col("source").asc_nulls_last())
    turn = F.pmod(F.row_number().over(order) - 1, F.lit(len(mix.weights)))
    weight = F.element_at(F.array(*map(F.lit, mix.weights)), (turn + 1).cast("int"))
    per, _ = stored(per.select("source", "source_size", weight.cast("double").alias("weight"),
                               (F.col("source_size") * mix.epochs).alias("cap")), "mix-sources")
    total = per.agg(F.sum("source_size")).first()[0] or 0
    capped: Column = F.lit(False)
    last = -1
    while True:
        now = per.agg(F.count_if(capped).alias("n"), F.coalesce(F.sum(F.when(capped, F.col("cap"))), F.lit(0)).alias("held"),
                      F.coalesce(F.sum(F.when(~capped, F.col("weight"))), F.lit(0.0)).alias("open")).first()
        free, open_weight = float(total - now["held"]), float(now["open"])
        share = F.col("weight") * F.lit(free) / F.lit(open_weight) if open_weight else F.lit(0.0)
        if now["n"] == last or not open_weight:
            break
        last = now["n"]
        capped = capped | (share > F.col("cap"))
    target = F.when(capped, F.col("cap").cast("double")).otherwise(share)
    return per.select("source", "source_size", target.alias("target"))


def cut_offs(sized: DataFrame, wanted: DataFrame) -> DataFrame:
    """(source, source_size, target, whole, below, rest): take ``whole`` times, and once more where the place is before
    ``below``; of the rows at that place, one after the other, those that bring the sum nearer to ``rest`` words.

    At each level the sums of a source's open part have at most 16 ** DIGITS rows.
    """
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0))
    state = wanted.withColumn("whole", whole.cast("bigint")).withColumn(
        "rest", F.col("target") - F.col("whole") * F.col("source_size")).withColumn("cut", F.lit(""))
    state, _ = stored(state, "mix-state")
    for level in range(1, LEVELS + 1):
        rows = sized.select("source", "size", "place").alias("r")
        s = state.alias("s")
        part = F.substring("r.place", 1, DIGITS * level)
        sums = (rows.join(s.select("source", "cut", "rest").where("rest > 0"),
                          F.col("r.source").eqNullSafe(F.col("s.source"))
                          & F.col("r.place").startswith(F.col("s.cut")))
                .groupBy(F.col("r.source").alias("source"), part.alias("part"), F.col("s.rest").alias("rest"))
                .agg(F.sum("size").alias("words")))
        upto = F.sum("words").over(Window.partitionBy("source").orderBy("part"))
        at = (sums.withColumn("before", upto - F.col("words"))
              .where("before <= rest and before + words > rest")
              .select(F.col("source").alias("at_source"), "part", "before"))
        state, _ = stored(
            state.join(at, F.col("source").eqNullSafe(F.col("at_source")), "left").select(
                "source", "source_size", "target", "whole",
                # with no part to cut, rounding has put the cut-off behind the last row
                F.when(F.col("part").isNull(), F.lit(0.0)).otherwise(F.col("rest") - F.col("before")).alias("rest"),
                F.coalesce("part", "cut").alias("cut")), "mix-state")
    return state.select("source", "source_size", "target", "whole", F.col("cut").alias("below"), "rest")


def _with_times(rows: DataFrame, plan: DataFrame, source: str, place: str, size: str, times: str, limit: PathConfig) -> DataFrame:
    """``rows`` with how often each is taken in ``times``. Rows at a source's cut-off place are numbered; copies of one row
    may be very many, so they are scanned in pieces."""
    own = {c: with_free_name(rows, f"plan_{c}") for c in ("source", "whole", "below", "rest")}
    key, upto = with_free_name(rows, "cut_key"), with_free_name(rows, "cut_upto")
    named = plan.select(*[F.col(c).alias(n) for c, n in own.items()])
    joined = rows.join(named, F.col(f"`{source}`").cast("string").eqNullSafe(F.col(own["source"])))
    extra = [*own.values(), key, upto]
    at_cut = F.col(place) == F.col(own["below"])
    before = joined.where(~at_cut).withColumn(times, F.col(own["whole"]) + (F.col(place) < F.col(own["below"])).cast("bigint"))
    # a source has one cut-off place, so its name is the key; null is a source too
    there = joined.where(at_cut).withColumn(key, F.concat(F.lit("="), F.coalesce(F.col(own["source"]), F.lit("")), F.col(own["source"]).isNull().cast("string")))
    hot = find_hot_keys(there, key, limit)
    there = by_key(there, key, [size, "doc_id"], hot, lambda o: running(o, exclusive=True, **{upto: ("sum", F.col(size))}).rows(), limit)
    nearer = (F.col(size) > 0) & (2 * (F.col(own["rest"]) - F.col(upto)) >= F.col(size))
    there = there.withColumn(times, F.col(own["whole"]) + nearer.cast("bigint"))
    return before.drop(*extra).unionByName(there.drop(*extra))


def mix_report(docs: DataFrame, mix: Mix = DEFAULT) -> DataFrame:
    """doc_id, size, source_size, target, repetitions, taken of every document."""
    sized, _ = stored(sizes(docs, mix), "mix-sizes")
    plan = cut_offs(sized, targets(sized, mix))
    rows = _with_times(sized, plan, "source", "place", "size", "repetitions", mix.limit)
    of = plan.select(F.col("source").alias("of"), "source_size", "target")
    return rows.join(of, F.col("source").eqNullSafe(F.col("of"))).select(
        "doc_id", "size", "source_size", "target", "repetitions", (F.col("repetitions") * F.col("size")).alias("taken"))


def mix_documents(docs: DataFrame, mix: Mix = DEFAULT) -> DataFrame:
    """The mixed corpus: every document as often as it is taken, numbered from 1 in ``repetition``.

    The texts are read twice and meet only the table of sources, by an equality join that Spark sizes itself.
    """
    sized, _ = stored(sizes(docs, mix), "mix-sizes")
    plan, _ = stored(cut_offs(sized, targets(sized, mix)), "mix-plan")
    number, place, size, times = (with_free_name(docs, n) for n in ("repetition", "mix_place", "mix_size", "mix_times"))
    rows = docs.withColumns({place: _hash(mix), size: word_count(F.col("text"))})
    rows = _with_times(rows, plan, "source", place, size, times, mix.limit).where(F.col(times) > 0)
    return rows.withColumn(number, F.explode(F.sequence(F.lit(1), F.col(times).cast("int")))).drop(place, size, times)
