"""Prefix trie of conversations, its subtree totals by parallel tree contraction.

Rebuilding. Conversation c takes the first h turns of conversation c - c % 5, with h = crc32(c) % 9, then its own turns
after its first h. So related conversations share prefixes and a trie over them branches.

Nodes. A turn is the 128-bit digest of its role and text. A prefix of d turns is named by d and the sums of four 30-bit
parts of the digests of its (place, turn) pairs. Sums run along a conversation in one ordered scan, and a conversation with
very many turns is scanned in pieces (``operators.ordered``), so no conversation is gathered. Conversations with the same
name are the members of a node; they are counted before the shuffle.

Contraction. Rounds of two steps, each of them joins over stored tables:

* **Compress.** A node with one child left hands its sum on. Every such node points to its child, and pointers are
  doubled until each points to the end of its unary chain; a step touches only the pointers not yet at an end. The chain goes,
  its end moves up to the parent of the chain's head and carries the chain's sum as the weight of its edge.
* **Rake.** Leaves add their sums to their parents; contributions are combined before the shuffle, so a parent of millions
  of leaves is one row a task.

A tree without unary nodes has more leaves than inner nodes, so a round at least halves it. Then the rounds are taken
back, the last one first: an end's total is known, and each node of its chain adds its own sum.

Members that end at a node are hashed in rising order: their numbers are joined to strings within ranges of 4,096 numbers,
and a node with several ranges has its strings hashed one after the other in a stream; nothing holds a node's members.

Defined results for odd input: rows without a number belong to no conversation and are left out; a null turn comes first;
turns of one number are ordered by the MD5 of their role and text, and repeated rows are turns each; a null role or text is
empty; texts of any length are read whole; a conversation whose rebuilt form has no turn ends at the root; an empty table
gives an empty one, without a root. Columns other than ``conv_id``, ``turn``, ``role`` and ``text`` are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ..config import PathConfig
from ..operators.ordered import HotKeys, by_key, find_hot_keys, running
from ..session import ship_package
from .common import Scratch


@dataclass(frozen=True)
class TrieRules:
    #: conversations c - c % family .. share their first turns
    family: int = 5
    #: a conversation takes fewer than so many turns of another
    heads: int = 9
    #: a conversation of more turns is scanned in pieces
    max_turns: int = 200_000
    #: ending members are joined to strings by ranges of 2 ** span numbers
    span: int = 12


DEFAULT = TrieRules()
NAME = ["depth", "s0", "s1", "s2", "s3"]
NODE = ["conv_id", "depth"]
NOTHING = hashlib.sha256(b"").hexdigest()
EMPTY = ("conv_id bigint, depth bigint, parent_conv_id bigint, n_convs bigint, n_children bigint, n_leaves bigint, "
         "saved_tokens bigint, ends_sha256 string")


def _heads(conv: Column, rules: TrieRules) -> Column:
    return F.crc32(conv.cast("string").cast("binary")) % rules.heads


def _turns(rows: DataFrame, rules: TrieRules) -> tuple[DataFrame, HotKeys]:
    """(conv_id, pos, sig, size) of every turn, ``pos`` from 1, and the conversations scanned in pieces."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    sig = F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text).cast("binary"))
    turns = rows.where("conv_id is not null").select(
        F.col("conv_id").cast("bigint"), F.col("turn"), sig.alias("sig"), F.octet_length(text).cast("bigint").alias("size"))
    limit = PathConfig(max_group_rows=rules.max_turns)
    hot = find_hot_keys(turns, "conv_id", limit)
    placed = by_key(turns, "conv_id", ["turn", "sig"], hot,
                    lambda o: running(o, pos=("sum", F.lit(1).cast("bigint"))).rows(), limit)
    return placed.select("conv_id", "pos", "sig", "size"), hot


def rebuilt(turns: DataFrame, rules: TrieRules = DEFAULT) -> tuple[DataFrame, DataFrame]:
    """(conv_id, pos, sig, size) of every rebuilt turn, and (conv_id, length) of every conversation. ``turns`` is stored."""
    conv, base = F.col("conv_id"), F.col("conv_id") - F.col("conv_id") % rules.family
    first = turns.where((conv % rules.family == 0) & (F.col("pos") < rules.heads)).select(
        conv.alias("base"), F.col("pos").alias("at"), "sig", "size")
    given = first.groupBy("base").agg(F.count("*").alias("given"))
    convs = turns.groupBy("conv_id").agg(F.count("*").alias("own")).select(
        "conv_id", "own", base.alias("base"), _heads(conv, rules).alias("h"))
    convs = convs.join(given, "base", "left").withColumn("taken", F.least("h", F.coalesce("given", F.lit(0))))
    convs = convs.withColumn("length", F.col("taken") + F.greatest(F.col("own") - F.col("h"), F.lit(0)))
    taken = convs.join(first, "base").where("at <= h").select("conv_id", F.col("at").alias("pos"), "sig", "size")
    kept = turns.where(F.col("pos") > _heads(conv, rules)).join(convs.select("conv_id", "h", "taken"), "conv_id").select(
        "conv_id", (F.col("pos") - F.col("h") + F.col("taken")).alias("pos"), "sig", "size")
    return taken.unionByName(kept), convs.select("conv_id", "length")


def _prefixes(turns: DataFrame, hot: HotKeys, rules: TrieRules) -> DataFrame:
    """(conv_id, depth, s0.., p0.., size): every prefix of every conversation, its name and that of the prefix before it."""
    pair = F.md5(F.concat(F.col("pos").cast("string"), F.lit(":"), F.col("sig")).cast("binary"))
    part = {f"x{i}": F.shiftright(F.conv(F.substring(pair, 8 * i + 1, 8), 16, 10).cast("bigint"), 2) for i in range(4)}
    limit = PathConfig(max_group_rows=rules.max_turns)
    summed = by_key(turns.withColumns(part), "conv_id", ["pos"], hot, lambda o: running(
        o, **{f"s{i}": ("sum", F.col(f"x{i}")) for i in range(4)}).rows(), limit)
    return summed.select("conv_id", F.col("pos").alias("depth"), *[f"s{i}" for i in range(4)],
                         *[(F.col(f"s{i}") - F.col(f"x{i}")).alias(f"p{i}") for i in range(4)], "size")


def _nodes(prefixes: DataFrame, convs: DataFrame, tables: Scratch) -> tuple[DataFrame, int]:
    """(conv_id, depth, parent, n_convs, saved, s0..) of every node but the root, and the root's conv_id."""
    root, n = convs.agg(F.min("conv_id"), F.count("*")).first()
    found = tables.put(prefixes.groupBy(*NAME).agg(
        F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"), F.max("size").alias("size"),
        *[F.max(f"p{i}").alias(f"p{i}") for i in range(4)]), "found")
    above = found.select(F.col("conv_id").alias("parent"), F.col("depth").alias("d"),
                         *[F.col(f"s{i}").alias(f"a{i}") for i in range(4)])
    same = reduce(lambda a, b: a & b, [F.col(f"p{i}") == F.col(f"a{i}") for i in range(4)])
    columns = ["conv_id", "depth", "parent", "n_convs", ((F.col("n_convs") - 1) * F.col("size")).alias("saved"), *NAME[1:]]
    deeper = found.where("depth > 1").join(above, (F.col("depth") - 1 == F.col("d")) & same)
    top = found.where("depth = 1").withColumn("parent", F.lit(root).cast("bigint"))
    nodes = tables.put(deeper.select(*columns).unionByName(top.select(*columns)), "nodes")
    tables.drop(found)
    return nodes, root, n


def contract(edges: DataFrame, put, drop) -> DataFrame:
    """(conv_id, depth, leaves, total): sums over the subtree of every node of a tree.

    ``edges`` has a row per node, (conv_id, depth, parent, up, leaf, saved): the node, its parent (parent, up; null for the
    root), and the two values to be summed. ``put(df, label)`` stores a table, ``drop(table)`` deletes one.
    """
    live = put(edges.join(edges.where("up is not null").groupBy(F.col("parent").alias("conv_id"), F.col("up").alias("depth"))
                          .agg(F.count("*").alias("kids")), NODE, "left").select(
        *NODE, "parent", "up", F.coalesce("kids", F.lit(0)).alias("kids"), F.col("leaf").alias("leaves"),
        F.col("saved").alias("total"), F.lit(0).cast("bigint").alias("w_leaves"), F.lit(0).cast("bigint").alias("w_total")), "live")
    chains, raked = [], []
    while True:
        chain = (F.col("kids") == 1) & F.col("up").isNotNull()
        live, moved = _compress(live, chain, put, drop)
        if moved is not None:
            chains.append((len(raked), moved))
        leaf = (F.col("kids") == 0) & F.col("up").isNotNull()
        # the root alone is left, or nothing in an empty tree
        if live.where(leaf).isEmpty():
            break
        gone = put(live.where(leaf).select(*NODE, "parent", "up", "leaves", "total", "w_leaves", "w_total"), "raked")
        raked.append(gone.select(*NODE, "leaves", "total"))
        given = gone.groupBy(F.col("parent").alias("conv_id"), F.col("up").alias("depth")).agg(
            F.count("*").alias("n"), F.sum(F.col("leaves") + F.col("w_leaves")).alias("g_leaves"),
            F.sum(F.col("total") + F.col("w_total")).alias("g_total"))
        zero = F.lit(0).cast("bigint")
        after = put(live.where(~leaf).join(given, NODE, "left").select(
            *NODE, "parent", "up", (F.col("kids") - F.coalesce("n", zero)).alias("kids"),
            (F.col("leaves") + F.coalesce("g_leaves", zero)).alias("leaves"),
            (F.col("total") + F.coalesce("g_total", zero)).alias("total"), "w_leaves", "w_total"), "live")
        drop(live)
        live = after
    known = [live.select(*NODE, "leaves", "total")]
    # taken back: an end was raked or moved in a later step than the chain above it went
    later = len(raked)
    for rounds, moved in reversed(chains):
        known += raked[rounds:later]
        later = rounds
        totals = reduce(DataFrame.unionByName, known).select(
            F.col("conv_id").alias("end_conv"), F.col("depth").alias("end_depth"), F.col("leaves").alias("e_leaves"),
            F.col("total").alias("e_total"))
        opened = put(moved.join(totals, ["end_conv", "end_depth"]).select(
            *NODE, (F.col("leaves") + F.col("e_leaves")).alias("leaves"), (F.col("total") + F.col("e_total")).alias("total")), "opened")
        known.append(opened)
        drop(moved)
    return reduce(DataFrame.unionByName, known + raked[:later])


def _compress(live: DataFrame, chain: Column, put, drop) -> tuple[DataFrame, DataFrame | None]:
    """``live`` without its unary chains, and (conv_id, depth, end_conv, end_depth, leaves, total) of the nodes that went:
    a node's total is its end's total and what stands here."""
    links = live.where(chain).select(*NODE, F.col("parent").alias("h_parent"), F.col("up").alias("h_up"),
                                     F.col("leaves").alias("c_leaves"), F.col("total").alias("c_total"),
                                     F.col("w_leaves").alias("h_leaves"), F.col("w_total").alias("h_total"))
    if links.isEmpty():
        return live, None
    child = live.where("up is not null").select(
        F.col("parent").alias("conv_id"), F.col("up").alias("depth"), F.col("conv_id").alias("end_conv"),
        F.col("depth").alias("end_depth"), chain.alias("open"), F.col("w_leaves").alias("e_leaves"), F.col("w_total").alias("e_total"))
    # a unary node has one child, so the join is one to one
    first = put(links.join(child, NODE).select(
        *NODE, "end_conv", "end_depth", "open", (F.col("c_leaves") + F.col("e_leaves")).alias("leaves"),
        (F.col("c_total") + F.col("e_total")).alias("total")), "pointers")
    inner = first.where("open").select(F.col("end_conv").alias("conv_id"), F.col("end_depth").alias("depth"))
    heads = put(links.join(inner, NODE, "left_anti").select(*NODE, "h_parent", "h_up", "h_leaves", "h_total"), "heads")
    done, now, spent = [first.where("not open")], first.where("open"), [first]
    while not now.isEmpty():
        step = reduce(DataFrame.unionByName, [*done, now]).select(
            F.col("conv_id").alias("end_conv"), F.col("depth").alias("end_depth"), F.col("end_conv").alias("to_conv"),
            F.col("end_depth").alias("to_depth"), F.col("open").alias("to_open"), F.col("leaves").alias("to_leaves"),
            F.col("total").alias("to_total"))
        doubled = put(now.drop("open").join(step, ["end_conv", "end_depth"]).select(
            *NODE, F.col("to_conv").alias("end_conv"), F.col("to_depth").alias("end_depth"), F.col("to_open").alias("open"),
            (F.col("leaves") + F.col("to_leaves")).alias("leaves"), (F.col("total") + F.col("to_total")).alias("total")), "pointers")
        done.append(doubled.where("not open"))
        now = doubled.where("open")
        spent.append(doubled)
    moved = put(reduce(DataFrame.unionByName, done).drop("open"), "moved")
    drop(*spent)
    ends = heads.join(moved, NODE).select(
        F.col("end_conv").alias("conv_id"), F.col("end_depth").alias("depth"), "h_parent", "h_up",
        (F.col("h_leaves") + F.col("leaves")).alias("m_leaves"), (F.col("h_total") + F.col("total")).alias("m_total"))
    hit = F.col("h_up").isNotNull()
    # the end's own edge weight is part of the chain's sum already
    after = put(live.where(~chain).join(ends, NODE, "left").select(
        *NODE, F.when(hit, F.col("h_parent")).otherwise(F.col("parent")).alias("parent"),
        F.when(hit, F.col("h_up")).otherwise(F.col("up")).alias("up"), "kids", "leaves", "total",
        F.when(hit, F.col("m_leaves")).otherwise(F.col("w_leaves")).alias("w_leaves"),
        F.when(hit, F.col("m_total")).otherwise(F.col("w_total")).alias("w_total")), "live")
    drop(live, heads)
    return after, moved


def _hash_stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of each node's strings, joined by commas; the rows of a node follow each other, over any number of batches."""
    def table(rows):
        ids, depths, hashes = zip(*rows)
        return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(depths, pa.int64()), pa.array(hashes, pa.string())],
                                          names=["conv_id", "depth", "ends_sha256"])

    node, state, out = None, None, []
    for batch in batches:
        for conv, depth, text in zip(*(batch[c].to_pylist() for c in ("conv_id", "depth", "ids"))):
            if (conv, depth) != node:
                if node is not None:
                    out.append((*node, state.hexdigest()))
                node, state = (conv, depth), hashlib.sha256(text.encode())
            else:
                state.update(b"," + text.encode())
        if out:
            yield table(out)
            out = []
    if node is not None:
        yield table([(*node, state.hexdigest())])


def ending_hashes(ends: DataFrame, rules: TrieRules = DEFAULT) -> DataFrame:
    """(conv_id, depth, ends_sha256) from (conv_id, depth, member): members rising, comma-joined, hashed."""
    ship_package(ends.sparkSession)
    strings = ends.groupBy(*NODE, F.shiftright("member", rules.span).alias("at")).agg(F.array_join(
        F.transform(F.array_sort(F.collect_list("member")), lambda x: x.cast("string")), ",").alias("ids"))
    per = strings.groupBy(*NODE).agg(F.count("*").alias("n"))
    strings = strings.join(per, NODE)
    short = strings.where("n = 1").select(*NODE, F.sha2("ids", 256).alias("ends_sha256"))
    long = strings.where("n > 1").select(*NODE, "at", "ids").repartition(*NODE).sortWithinPartitions(*NODE, "at") \
        .select(*NODE, "ids").mapInArrow(_hash_stream, "conv_id bigint, depth bigint, ends_sha256 string")
    return short.unionByName(long)


def conversation_trie(rows: DataFrame, rules: TrieRules = DEFAULT) -> DataFrame:
    """A row per node of the trie over the rebuilt conversations, see the module's first lines."""
    spark = rows.sparkSession
    with Scratch(spark, "trie") as tables:
        placed, hot = _turns(rows, rules)
        turns = tables.put(placed, "turns")
        whole, lengths = rebuilt(turns, rules)
        prefixes, convs = tables.put(_prefixes(whole, hot, rules), "prefixes"), tables.put(lengths, "convs")
        tables.drop(turns)
        if convs.isEmpty():
            return spark.createDataFrame([], EMPTY)
        nodes, root, n_convs = _nodes(prefixes, convs, tables)
        top = spark.range(1).select(F.lit(root).cast("bigint").alias("conv_id"), F.lit(0).cast("bigint").alias("depth"),
                                    F.lit(None).cast("bigint").alias("parent"), F.lit(n_convs).cast("bigint").alias("n_convs"),
                                    F.lit(0).cast("bigint").alias("saved"))
        every = nodes.select("conv_id", "depth", "parent", "n_convs", "saved").unionByName(top)
        children = nodes.groupBy(F.col("parent").alias("conv_id"), (F.col("depth") - 1).alias("depth")) \
            .agg(F.count("*").alias("n_children"))
        every = tables.put(every.join(children, NODE, "left").withColumn("n_children", F.coalesce("n_children", F.lit(0))), "every")
        up = F.when(F.col("depth") > 0, F.col("depth") - 1)
        totals = contract(every.select(*NODE, "parent", up.alias("up"), (F.col("n_children") == 0).cast("bigint").alias("leaf"),
                                       "saved"), tables.put, tables.drop)
        last = prefixes.join(convs.withColumnRenamed("length", "depth"), NODE).select(F.col("conv_id").alias("member"), *NAME)
        ends = last.join(nodes.select("conv_id", *NAME), NAME).select(*NODE, "member")
        ends = ends.unionByName(convs.where("length = 0").select(
            F.lit(root).cast("bigint").alias("conv_id"), F.lit(0).cast("bigint").alias("depth"), F.col("conv_id").alias("member")))
        out = every.join(totals, NODE).join(ending_hashes(ends, rules), NODE, "left").select(
            *NODE, F.col("parent").alias("parent_conv_id"), "n_convs", "n_children", F.col("leaves").alias("n_leaves"),
            F.col("total").alias("saved_tokens"), F.coalesce("ends_sha256", F.lit(NOTHING)).alias("ends_sha256"))
        return tables.keep(tables.put(out, "out"))
