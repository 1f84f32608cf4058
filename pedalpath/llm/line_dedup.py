"""Repeated runs of lines, by a suffix array over line numbers that is built by distributed prefix doubling.

A text is the sequence of its lines that are not blank; a line's number is a 64-bit hash. The suffixes of all
sequences are sorted by (number of the first line, rank under that number):

* **Doubling.** With the ranks by the first 2**k lines known, a suffix is ranked by (its rank, the rank of the suffix
  2**k lines on). Only buckets that still hold several suffixes are ranked anew. Equal entries are counted first, so a
  bucket's window has a row per different entry, and a line so common that its entries are too many
  is spread over range partitions. Documents without an open bucket leave. Rounds: the logarithm of the longest repeated run.
* **LCP.** The common length of neighbours in the array comes from the classes of each round, largest first:
  where both continue in one class of 2**k lines, they agree in 2**k lines more.
* **Intervals.** Where the common length stays at ``min_lines`` or more, the suffixes between begin with one repeated
  run. The first in the order (doc_id, line) stays; a line that any later one covers is deleted.
* **One line.** With ``line_words`` set, a line of so many words that repeats between other neighbours is a run too; its class is
  that of the first round.

All of it is DataFrame operations. Only documents with a repeated line take part, and only texts that lose lines are
built anew.

Defined results for odd input: a null or empty text has no lines and comes back as it is; blank lines are never compared,
and go with the deleted line before them; texts of any length are read whole; rows equal in number and text are one
document, cut alike (rows with equal number and other text are two); a null doc_id comes last in the order; an empty
table gives an empty one; other columns pass through, whatever their names.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..config import DEFAULT as SIZES
from ..operators.ordered import Ordered, find_hot_keys, in_pieces, neighbour, running
from .common import SPACES, Scratch, with_free_name


@dataclass(frozen=True)
class LineRules:
    #: shortest run that counts as repeated, in lines that are not blank; a power of two
    min_lines: int = 2
    #: a run of fewer words than this in all stays (furniture is a matter of the line rules)
    min_words: int = 20
    #: fewest words of a line that counts as a run alone; None: no line does
    line_words: int | None = None


DEFAULT = LineRules()
#: Every repeat goes, however short the run; a line alone has at least a few words, so that no heading or bracket goes.
WHOLE = LineRules(min_words=1, line_words=3)
ROW = ["doc", "sig"]


def _same_row(a: str, b: str) -> Column:
    return F.col(f"{a}.doc").eqNullSafe(F.col(f"{b}.doc")) & (F.col(f"{a}.sig") == F.col(f"{b}.sig"))


def _row_key(docs: DataFrame) -> list[Column]:
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return [F.col("doc_id").cast("bigint").alias("doc"), F.xxhash64(text).alias("sig")]


def line_numbers(docs: DataFrame) -> DataFrame:
    """(doc, sig, pos, len, line, h, words): the ``len`` lines that are not blank; ``pos`` counts them, ``line`` all, from 0."""
    lines = F.split(F.coalesce(F.col("text").cast("string"), F.lit("")), "\n")
    solid = F.filter(F.transform(lines, lambda x, i: F.struct(i.alias("line"), F.btrim(x, F.lit(SPACES)).alias("text"))),
                     lambda x: x["text"] != "")
    rows = docs.select(*_row_key(docs), solid.alias("solid")).select("doc", "sig", F.size("solid").alias("len"),
                                                                     F.posexplode("solid").alias("pos", "x"))
    spaces = F.size(F.split("x.text", "[\\x20\\x09-\\x0D]+"))
    return rows.select("doc", "sig", F.col("pos").cast("bigint"), F.col("len").cast("bigint"), F.col("x.line").cast("bigint").alias("line"),
                       F.xxhash64("x.text").alias("h"), spaces.cast("bigint").alias("words"))


def _spread(df: DataFrame, key: tuple[str, ...], order: tuple[str, ...], compute):
    """``compute`` over windows of ``key``; first lines with very many rows go in pieces, see ``operators.ordered``."""
    hot = find_hot_keys(df, "h")
    if hot.table is None:
        return compute(Ordered(df, key, order)).rows()
    usual = compute(Ordered(df.join(hot.table, "h", "left_anti"), key, order)).rows()
    return usual.unionByName(compute(in_pieces(df.join(hot.table, "h", "left_semi"), key, order, hot.rows)).rows())


def _ahead(step: int, *names: str) -> Column:
    """A struct of the row ``step`` lines on in the same document; null behind its end."""
    window = Window.partitionBy(*ROW).orderBy("pos").rangeBetween(step, step)
    return F.max(F.struct(*names)).over(window)


def suffix_array(lines: DataFrame, scratch: Scratch, rules: LineRules = DEFAULT) -> tuple[DataFrame, list[DataFrame]]:
    """The suffixes that share their first ``min_lines`` lines with another, (doc, sig, pos, h, sub, class), sorted by
    (h, sub); and per round k the classes (doc, sig, pos, name) of the first 2**k lines that occur more than once."""
    often = lines.groupBy("h").agg(F.count("*").alias("n")).where("n > 1").select("h")
    often = scratch.put(often.withColumn("many", F.lit(True)), "often")
    state = lines.select("doc", "sig", "pos", "len", "h").join(often, "h", "left").select(
        "doc", "sig", "pos", "len", "h", F.lit(0).cast("bigint").alias("sub"), F.coalesce("many", F.lit(False)).alias("many"))
    state = state.withColumn("open", F.max("many").over(Window.partitionBy(*ROW))).where("open").drop("open")
    # equal rows are one document
    state = scratch.put(state.dropDuplicates(["doc", "sig", "pos"]), "state")
    scratch.drop(often)
    levels, sorted_parts = [], []
    step, first = 1, rules.min_lines.bit_length() - 1
    while True:
        name = F.struct("h", "sub").alias("name")
        levels.append(state.where("many").select(*ROW, "pos", name))
        ahead = state.withColumn("next", _ahead(step, "h", "sub")).where("many")
        more = F.col("next").isNotNull()
        todo = ahead.select(*ROW, "pos", "len", "h", "sub", more.alias("more"),
                            F.coalesce("next.h", F.lit(0)).alias("h2"), F.coalesce("next.sub", F.lit(0)).alias("sub2"))
        todo = scratch.put(todo, "todo")
        groups = todo.groupBy("h", "sub", "more", "h2", "sub2").agg(F.count("*").alias("n"))
        groups = scratch.put(groups, "groups")
        ranked = _spread(groups, ("h", "sub"), ("more", "h2", "sub2"),
                         lambda o: running(o, exclusive=True, before=("sum", F.col("n"))))
        entry = ["h", "sub", "more", "h2", "sub2"]
        fresh = todo.join(ranked.select(*entry, F.col("sub").alias("old"), "n", "before"), entry).select(
            *ROW, "pos", "len", "h", (F.col("sub") + F.col("before")).alias("sub"),
            # equal entries end alike: all of them have 2 * step lines, or none
            ((F.col("n") > 1) & (F.col("pos") + 2 * step <= F.col("len"))).alias("many"))
        fresh = scratch.put(fresh, "fresh")
        scratch.drop(todo, groups)
        if len(levels) > first:
            # what shares at least min_lines lines and is ranked for good
            sorted_parts.append(fresh.where("not many").select(*ROW, "pos", "h", "sub"))
        rest = state.where("not many").select(*fresh.columns).unionByName(fresh)
        rest = rest.withColumn("open", F.max("many").over(Window.partitionBy(*ROW))).where("open").drop("open")
        state = scratch.put(rest, "state")
        if not state.take(1):
            break
        step *= 2
    if not sorted_parts:
        sorted_parts = [fresh.where("false").select(*ROW, "pos", "h", "sub")]
    array = reduce(DataFrame.unionByName, sorted_parts).alias("s")
    if first < len(levels):
        names = levels[first].select(*[F.col(c).alias(f"n_{c}") for c in (*ROW, "pos")], F.col("name").alias("class"))
        array = array.join(names, F.col("s.doc").eqNullSafe(F.col("n_doc")) & (F.col("s.sig") == F.col("n_sig"))
                           & (F.col("s.pos") == F.col("n_pos"))).select("s.*", "class")
    else:
        array = array.withColumn("class", F.struct("h", "sub")).where("false")
    return scratch.put(array, "array"), levels


def common_lengths(array: DataFrame, levels: list[DataFrame], scratch: Scratch, rules: LineRules = DEFAULT) -> DataFrame:
    """The array with ``lcp``: lines in common with the suffix before it in the array, 0 where the class changes."""
    placed = array.withColumn("at", F.struct("doc", "sig", "pos"))
    rows = _spread(placed, ("h",), ("sub", "doc", "sig", "pos"), lambda o: neighbour(o, "before", ["at", "class"]))
    pairs = rows.select(*ROW, "pos", "h", "sub", "class", F.when(F.col("before.class") == F.col("class"), F.col("before.at")).alias("b"))
    pairs = scratch.put(pairs, "pairs")
    scratch.drop(array)
    alone = pairs.where("b is null").select(*ROW, "pos", "class", F.lit(0).cast("bigint").alias("lcp"))
    found = pairs.where("b is not null").withColumn("lcp", F.lit(0).cast("bigint"))
    last = None
    for k in range(len(levels) - 1, -1, -1):
        side = [levels[k].select(F.col("doc").alias(f"{s}_doc"), F.col("sig").alias(f"{s}_sig"),
                                 F.col("pos").alias(f"{s}_pos"), F.col("name").alias(f"{s}_name")) for s in "xy"]
        found = found.join(side[0], F.col("doc").eqNullSafe(F.col("x_doc")) & (F.col("sig") == F.col("x_sig"))
                           & (F.col("pos") + F.col("lcp") == F.col("x_pos")), "left")
        found = found.join(side[1], F.col("b.doc").eqNullSafe(F.col("y_doc")) & (F.col("b.sig") == F.col("y_sig"))
                           & (F.col("b.pos") + F.col("lcp") == F.col("y_pos")), "left")
        longer = F.when(F.col("x_name") == F.col("y_name"), F.lit(1 << k)).otherwise(F.lit(0))
        found = scratch.put(found.withColumn("lcp", F.col("lcp") + longer).select(*ROW, "pos", "class", "b", "lcp"), "lcp")
        if last is not None:
            scratch.drop(last)
        last = found
    return found.select(*ROW, "pos", "class", "lcp").unionByName(alone)


def repeated_runs(docs: DataFrame, rules: LineRules = DEFAULT) -> DataFrame:
    """(doc, sig, start, end, first_doc, lcp, lines): maximal deleted stretches ``start`` to ``end`` (counted among all
    lines, inclusive), the line indexes, a document that keeps the run, and the longest common length met in it."""
    with Scratch(docs.sparkSession, "lines") as scratch:
        return scratch.keep(scratch.put(_runs(scratch.put(line_numbers(docs), "lines"), scratch, rules), "runs"))


def _runs(lines: DataFrame, scratch: Scratch, rules: LineRules) -> DataFrame:
    array, levels = suffix_array(lines, scratch, rules)
    array = common_lengths(array, levels, scratch, rules)
    # an LCP interval of min_lines is a class; its first suffix in document order stays
    order = F.struct(F.col("doc").isNull().alias("last"), F.col("doc"), F.col("sig"), F.col("pos"))
    classes = array.groupBy("class").agg(F.min(order).alias("first"), F.max("lcp").alias("longest"))
    later = array.join(classes, "class").where(order != F.col("first")).select(*ROW, "pos", "lcp", "first")
    covered = later.select(*ROW, F.explode(F.sequence("pos", F.col("pos") + (rules.min_lines - 1))).alias("pos"),
                           "lcp", F.col("first.doc").alias("first_doc"), F.lit(False).alias("alone"))
    if rules.line_words is not None:
        ones = levels[0].select(*ROW, "pos", F.col("name.h").alias("h"))
        firsts = ones.groupBy("h").agg(F.min(order).alias("first"))
        covered = covered.unionByName(ones.join(firsts, "h").where(order != F.col("first")).select(
            *ROW, "pos", F.lit(1).cast("bigint").alias("lcp"), F.col("first.doc").alias("first_doc"), F.lit(True).alias("alone")))
    covered = covered.groupBy(*ROW, "pos").agg(F.max("lcp").alias("lcp"), F.min("first_doc").alias("first_doc"),
                                               F.bool_and("alone").alias("alone")).alias("c")
    full = lines.dropDuplicates(["doc", "sig", "pos"]).alias("l")
    hit = full.join(covered, _same_row("l", "c") & (F.col("l.pos") == F.col("c.pos"))) \
        .where(~F.col("c.alone") | (F.col("l.words") >= (rules.line_words or 0))) \
        .select("l.doc", "l.sig", "l.pos", "l.line", "l.words", "c.lcp", "c.first_doc")
    # stretches: neighbours in the count of lines that are not blank
    near = Window.partitionBy(*ROW).orderBy("pos")
    runs = hit.withColumn("run", F.col("pos") - F.row_number().over(near)).groupBy(*ROW, "run").agg(
        F.min("line").alias("start"), F.max("line").alias("end"), F.sum("words").alias("words"), F.max("lcp").alias("lcp"),
        F.min("first_doc").alias("first_doc"), F.array_sort(F.collect_list("line")).alias("lines"))
    return runs.where(F.col("words") >= rules.min_words).drop("run")


def dedup_report(docs: DataFrame, rules: LineRules = DEFAULT) -> DataFrame:
    """doc_id, start, end, n_lines, words, longest, first_doc_id of every deleted stretch."""
    return repeated_runs(docs, rules).select(
        F.col("doc").alias("doc_id"), F.col("start").alias("first_line"), F.col("end").alias("last_line"),
        F.size("lines").cast("bigint").alias("n_lines"), "words", F.col("lcp").alias("longest"),
        F.col("first_doc").alias("first_doc_id"))


def drop_repeated_lines(docs: DataFrame, rules: LineRules = DEFAULT) -> DataFrame:
    """``docs`` without the later copies of repeated runs of lines; documents with nothing left go.

    Columns as in ``docs``; ``n_chars`` follows the text where there is such a column.
    """
    runs = repeated_runs(docs, rules)
    doc, sig, gone, split = (with_free_name(docs, n) for n in ("cut_doc", "cut_sig", "cut_lines", "all_lines"))
    cut = runs.groupBy(*ROW).agg(F.flatten(F.collect_list(F.sequence("start", "end"))).alias(gone)).select(
        F.col("doc").alias(doc), F.col("sig").alias(sig), gone)
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.join(cut, docs["doc_id"].cast("bigint").eqNullSafe(F.col(doc)) & (F.xxhash64(text) == F.col(sig)), "left")
    name = with_free_name(docs, "text_left")
    left = F.array_except(F.sequence(F.lit(0).cast("bigint"), (F.size(split) - 1).cast("bigint")), gone)
    rows = rows.withColumn(split, F.when(F.col(gone).isNotNull(), F.split(text, "\n")))
    rows = rows.withColumn(name, F.when(F.col(gone).isNull(), F.col("text")).otherwise(
        F.array_join(F.transform(left, lambda i: F.get(F.col(split), i.cast("int"))), "\n")))
    rows = rows.where(F.col(gone).isNull() | (F.btrim(F.col(name), F.lit(SPACES)) != ""))
    columns = []
    for c in docs.columns:
        if c == "text":
            columns.append(F.col(name).alias("text"))
        elif c == "n_chars":
            columns.append(F.when(F.col(gone).isNull(), F.col(c)).otherwise(F.length(name).cast(docs.schema[c].dataType)).alias(c))
        else:
            columns.append(F.col(f"`{c}`"))
    return rows.select(*columns)
