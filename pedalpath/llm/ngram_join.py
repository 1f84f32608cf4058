"""Similarity join of documents on word shingles by a token-group matrix, exact, without listing pairs of copies.

Two documents link when the Jaccard similarity of their sets of distinct 5-word shingles is at least 0.8. The result is
the connected components; every link between different sets is either checked or lies inside one component already.

1. **Order.** Any fixed order of the shingles makes a prefix filter exact: two sets that link share a shingle among the
   first ``n - ceil(0.8 n) + 1`` of both. The order used is "seldom ones first, then by hash". Shingles with hashes in the
   lower part are counted, and those of a few, many and very many documents kept as bitmaps of fixed size. Shingles
   that were not counted stand between the many and the very many. The bitmaps decide cost, not results.
2. **Sets.** Texts become sets; equal sets are one node. A shingle that occurs once in all prefixes can link nothing; such
   shingles, the great majority, drop out by a count of bare hashes, which each task sorts and packs by ranges.
   Those left whose smallest and largest node differ are shared by different sets.
   So does an entry of a set behind which too few shingles follow for a link.
3. **Groups.** Nodes are partitioned into groups of similar ones: those with the same minimum hash, under several hash
   functions, or with a shared shingle, are compared with one leader, and linked ones form a group. A group of a million near copies costs a
   million comparisons, and is one entry from here on.
4. **Matrix.** A row per group: the union of its members' shingles, as bits of a fixed number of columns. A node of one
   group that shares a prefix shingle with another group is a query. The number of its shingles whose bit is set
   in that row is an upper bound of the overlap with any member. Groups that reach the overlap a link needs are opened:
   the query is compared with a base of the members of about its size, and with those members that it may link to,
   found by a prefix filter over what either does not share with the base (``_by_base``). Nodes of a shingle in very
   many groups, which would all ask each other, meet in the same way.

Shingles are 64-bit hashes of words, sets 64-bit hashes of shingles.

Defined results for odd input: a null or empty text is an empty set, in no link, its own component; a document with
fewer than five words is one shingle, of all its words; rows without a number keep a null component; rows with the same
number are one node, linked through either text; a text of any length is read whole; an empty table gives an empty one.
Columns other than ``doc_id`` and ``text`` are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import ship_package
from .common import LOWER, Scratch, bitmap_of, components, drop_written, in_bitmap, stored, texts, with_free_name


@dataclass(frozen=True)
class JoinRules:
    words: int = 5
    #: link from this similarity on, in percent
    percent: int = 80
    #: size of the bitmaps, as a power of two: of the frequent shingles, of the others
    frequent_bits: int = 26
    #: shingles are counted whose hash lies in this share of all hashes: twice a prefix, as leaving some out lengthens it
    counted: float = 0.4
    #: levels of frequency, each with a bitmap an eighth as large as the one before
    levels: tuple[int, ...] = (2, 16, 256)
    bits: int = 24
    #: columns of the matrix
    columns: int = 8192
    #: hash functions for groups
    functions: int = 4
    #: a shingle that stands in the prefixes of more groups leads its nodes to one leader instead of to each other
    crowd: int = 32


DEFAULT = JoinRules()
_STEP, _MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)


def _scatter(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * _MIX
    x = (x ^ (x >> np.uint64(32))) * _MIX
    return x ^ (x >> np.uint64(32))


def shingles(text: bytes, size: int = 5) -> np.ndarray:
    """Distinct shingle hashes of a text in rising order."""
    words = text.translate(LOWER).split()
    if not words:
        return np.empty(0, dtype=np.uint64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), dtype=np.uint64, count=len(words))
    size = min(size, len(words))
    total = np.full(len(h) - size + 1, size, dtype=np.uint64)
    for j in range(size):
        total = total * _STEP + h[j:len(h) - size + 1 + j]
    return np.unique(_scatter(total))


def _prefix_length(n: int, percent: int) -> int:
    return n - (percent * n + 99) // 100 + 1


def _node(found: np.ndarray) -> int:
    return xxhash.xxh3_64_intdigest(found.tobytes()) - (1 << 63)


def _lists(parts: list[np.ndarray]) -> pa.ListArray:
    ends = np.cumsum([0, *map(len, parts)], dtype=np.int32)
    values = np.concatenate(parts).view(np.int64) if parts else np.empty(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(values))


def _chunks(batch: pa.RecordBatch, rules: JoinRules, most: int = 300_000):
    """(number, shingles) of a batch's documents, in lists of about ``most`` shingles."""
    held, size = [], 0
    for doc, text in zip(batch["doc_id"].to_pylist(), texts(batch["text"])):
        found = shingles(text, rules.words)
        held.append((doc, found))
        size += len(found)
        if size >= most:
            yield held
            held, size = [], 0
    yield held


def _ranges(docs: DataFrame) -> int:
    """Ranges of hash values, as a power of two that follows the number of input tasks, so that neither the tokens of a
    range nor the rows of a task grow with the input."""
    return max(7, (2 * docs.rdd.getNumPartitions() - 1).bit_length())


def _by_range(parts: Iterator[np.ndarray], power: int, room: int = 1_500_000) -> Iterator[pa.RecordBatch]:
    """Counts of a task's tokens as rows (range, once, often, n): those met once, those met oftener and how often."""
    def table(held):
        token, n = np.unique(np.concatenate(held), return_counts=True)
        edges = np.searchsorted(token >> np.uint64(64 - power), np.arange((1 << power) + 1, dtype=np.uint64))
        single = n == 1
        singles = np.concatenate([[0], np.cumsum(single)])[edges]
        lists = [pa.ListArray.from_arrays(pa.array(e.astype(np.int32)), pa.array(v)) for e, v in (
            (singles, token[single].view(np.int64)), (edges - singles, token[~single].view(np.int64)), (edges - singles, n[~single].astype(np.int64)))]
        whole = pa.RecordBatch.from_arrays([pa.array(np.arange(1 << power, dtype=np.int32)), *lists], names=["range", "once", "often", "n"])
        return whole.filter(pa.array(np.diff(edges) > 0))

    held, size = [], 0
    for part in parts:
        held.append(part)
        size += len(part)
        if size >= room:
            yield table(held)
            held, size = [], 0
    if size:
        yield table(held)


_RANGES = "`range` int, once array<bigint>, often array<bigint>, n array<bigint>"


def _repeated(by_range: DataFrame) -> DataFrame:
    """(token, n) of the tokens that occur more than once in all tasks together."""
    def merge(rows: pa.Table) -> pa.Table:
        flat = lambda c: pc.list_flatten(rows[c]).to_numpy()
        once, often = flat("once"), flat("often")
        tokens, n = np.concatenate([once, often]), np.concatenate([np.ones(len(once), dtype=np.int64), flat("n")])
        order = np.argsort(tokens, kind="stable")
        tokens = tokens[order]
        start = np.flatnonzero(np.concatenate([[True], np.diff(tokens) != 0])) if len(tokens) else np.empty(0, np.int64)
        total = np.add.reduceat(n[order], start) if len(start) else np.empty(0, np.int64)
        return pa.table({"token": tokens[start][total > 1], "n": total[total > 1]})

    return by_range.groupBy("range").applyInArrow(merge, "token bigint, n bigint")


def _edge(rules: JoinRules) -> np.uint64:
    return np.uint64(int(rules.counted * (1 << 64)))


def _frequent(docs: DataFrame, rules: JoinRules) -> list[np.ndarray]:
    """A bitmap per level of the shingles that occur so often, among those that are counted. On an input with too many of
    them for a bitmap to stay sparse, its level starts higher."""
    power, edge = _ranges(docs), _edge(rules)

    def run(batches):
        def parts():
            for batch in batches:
                for held in _chunks(batch, rules):
                    for s in {_node(s): s for _, s in held if len(s)}.values():
                        # a copy, so that the rest of the set can go
                        yield s[:np.searchsorted(s, edge)].copy()
        yield from _by_range(parts(), power)

    counts, path = stored(_repeated(docs.mapInArrow(run, _RANGES)), "ngram-counts")
    step = F.floor(F.log2("n")).cast("int")
    table = {r[0]: r[1] for r in counts.groupBy(step.alias("step")).count().collect()}
    bitmaps = []
    for i, level in enumerate(rules.levels):
        bits, least = rules.frequent_bits - 3 * i, int(np.log2(level))
        while sum(n for k, n in table.items() if k >= least) > (1 << bits) // 8:
            least += 1
        bitmaps.append(bitmap_of(counts.where(F.col("n") >= F.lit(float(2 ** least))), "token", bits))
    drop_written(docs, path)
    return bitmaps


def _classes(s: np.ndarray, frequent: list[np.ndarray], rules: JoinRules) -> np.ndarray:
    """The place of shingles in the order before their hash counts; a matter of the shingle alone."""
    few, many, most = (in_bitmap(b, s) for b in frequent)
    return np.select([most, many, s >= _edge(rules), few], [4, 2, 3, 1], 0).astype(np.int8)


def _sets(docs: DataFrame, frequent: list[np.ndarray], rules: JoinRules) -> DataFrame:
    """(doc_id, n, node, prefix) of every document; prefix in the order seldom first, then by hash."""
    def run(batches):
        for batch in batches:
            for held in _chunks(batch, rules):
                prefixes = []
                for _, s in held:
                    need = _prefix_length(len(s), rules.percent) if len(s) else 0
                    prefixes.append(s[np.argsort(_classes(s, frequent, rules), kind="stable")[:need]])
                yield pa.RecordBatch.from_arrays([
                    pa.array([d for d, _ in held], pa.int64()), pa.array([len(s) for _, s in held], pa.int64()),
                    pa.array([_node(s) if len(s) else None for _, s in held], pa.int64()), _lists(prefixes)],
                    names=["doc_id", "n", "node", "prefix"])

    return docs.mapInArrow(run, "doc_id bigint, n bigint, node bigint, prefix array<bigint>")


def _postings(sets: DataFrame, scratch: Scratch, rules: JoinRules) -> DataFrame:
    """(token, node, n, place): prefix shingles that different sets share, and where they stand. ``sets`` has been written."""
    nodes = sets.where("n > 0").select("node", "n", "prefix")
    power = _ranges(sets)

    def count(batches):
        yield from _by_range((batch["prefix"].flatten().to_numpy().view(np.uint64) for batch in batches), power)

    # copies of one set meet here too; the exact join below tells them apart
    twice = scratch.put(_repeated(nodes.select("prefix").mapInArrow(count, _RANGES)).select("token"), "twice")
    bitmap = bitmap_of(twice, "token", rules.bits)
    scratch.drop(twice)

    def run(batches):
        for batch in batches:
            lists = batch["prefix"]
            tokens = lists.flatten().to_numpy(zero_copy_only=False)
            lengths = np.diff(lists.offsets.to_numpy())
            row = np.repeat(np.arange(len(lists)), lengths)
            place = np.arange(len(row)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
            hit = in_bitmap(bitmap, tokens.view(np.uint64))
            if hit.any():
                rows = pa.array(row[hit])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(tokens[hit]), batch["node"].take(rows), batch["n"].take(rows), pa.array(place[hit])],
                    names=["token", "node", "n", "place"])

    rows = scratch.put(nodes.mapInArrow(run, "token bigint, node bigint, n bigint, place bigint").distinct(), "rows")
    # The first shingle that two sets share leaves an overlap of at most what follows it in either; entries behind which
    # too little follows for a link with the smallest set at hand are the first one of no link.
    least = rows.groupBy("token").agg(F.min("n").alias("least"))
    needed = F.greatest("least", F.ceil(F.col("n") * rules.percent / 100))
    kept = scratch.put(rows.join(least, "token").where(
        (100 + rules.percent) * (F.col("n") - F.col("place")) >= rules.percent * (F.col("n") + needed)).drop("least"), "kept")
    scratch.drop(rows)
    shared = kept.groupBy("token").agg(F.min("node").alias("low"), F.max("node").alias("high")).where("low <> high").select("token")
    found = scratch.put(kept.join(shared, "token", "left_semi"), "postings")
    scratch.drop(kept)
    return found


def _active(docs: DataFrame, sets: DataFrame, postings: DataFrame, scratch: Scratch, rules: JoinRules) -> DataFrame:
    """(node, n, tokens, bits, keys) of the nodes in ``postings``, from one document of each."""
    wanted = sets.where("n > 0 and doc_id is not null").groupBy("node").agg(F.min("doc_id").alias("doc_id")) \
        .join(postings.select("node").distinct(), "node", "left_semi").withColumn("place", F.xxhash64("doc_id"))
    wanted = scratch.put(wanted, "wanted")
    bitmap = bitmap_of(wanted, "place", rules.bits)
    seeds = [np.uint64((2 * k + 1) * 0xA24BAED4963EE407 & (1 << 64) - 1) for k in range(rules.functions)]

    def run(batches):
        for batch in batches:
            chosen = batch.filter(pa.array(in_bitmap(bitmap, batch["place"].to_numpy().view(np.uint64))))
            for held in _chunks(chosen, rules, 200_000):
                bits = []
                for _, s in held:
                    row = np.zeros(rules.columns, dtype=np.uint8)
                    row[(s >> np.uint64(20)) % np.uint64(rules.columns)] = 1
                    bits.append(np.packbits(row, bitorder="little").view(np.int64))
                keys = [np.array([_scatter(s * m).min() if len(s) else 0 for m in seeds], dtype=np.uint64) for _, s in held]
                yield pa.RecordBatch.from_arrays([
                    pa.array([d for d, _ in held], pa.int64()),
                    pa.array([_node(s) if len(s) else None for _, s in held], pa.int64()),
                    pa.array([len(s) for _, s in held], pa.int64()), _lists([s for _, s in held]), _lists(bits), _lists(keys)],
                    names=["doc_id", "node", "n", "tokens", "bits", "keys"])

    found = docs.where("doc_id is not null").withColumn("place", F.xxhash64("doc_id")).mapInArrow(
        run, "doc_id bigint, node bigint, n bigint, tokens array<bigint>, bits array<bigint>, keys array<bigint>")
    chosen = wanted.select("node", F.col("doc_id").alias("chosen"))
    table = scratch.put(found.join(chosen, "node").where("doc_id = chosen").drop("chosen", "doc_id").dropDuplicates(["node"]), "active")
    scratch.drop(wanted)
    return table


def _verified(pairs: DataFrame, active: DataFrame, rules: JoinRules) -> DataFrame:
    """Those pairs (a, b) of nodes that link."""
    one = active.select(F.col("node").alias("a"), F.col("tokens").alias("x"))
    two = active.select(F.col("node").alias("b"), F.col("tokens").alias("y"))
    both = F.size(F.array_intersect("x", "y"))
    joined = pairs.join(one, "a").join(two, "b").select("a", "b", both.alias("both"), (F.size("x") + F.size("y")).alias("sum"))
    return joined.where(100 * F.col("both") >= rules.percent * (F.col("sum") - F.col("both"))).select("a", "b")


def _sizes_allow(n: Column, low: Column, high: Column, rules: JoinRules) -> Column:
    return (100 * high >= rules.percent * n) & (rules.percent * low <= 100 * n)


def _group_links(active: DataFrame, postings: DataFrame, scratch: Scratch, rules: JoinRules) -> DataFrame:
    """Links between nodes and the leaders of those with the same minimum hash, or with a common entry in the postings.

    A leader is the one with the fewest seldom shingles: of copies changed here and there, the one most like the others.
    """
    central = postings.groupBy("node").agg(F.min("place").alias("place"), F.max("n").alias("n"))
    keyed = active.select("node", F.posexplode("keys").alias("f", "key")).join(central, "node") \
        .unionByName(postings.select("node", F.lit(-1).alias("f"), F.col("token").alias("key")).join(central, "node"))
    keyed = scratch.put(keyed, "keyed")
    leaders = keyed.groupBy("f", "key").agg(F.min(F.struct("place", "n", "node")).alias("l"), F.max("node").alias("high"),
                                            F.min("node").alias("low")).where("low <> high").select("f", "key", "l")
    pairs = keyed.join(leaders, ["f", "key"]) \
        .where((F.col("node") != F.col("l.node")) & _sizes_allow(F.col("n"), F.col("l.n"), F.col("l.n"), rules))
    pairs = scratch.put(pairs.select(F.greatest("node", "l.node").alias("a"), F.least("node", "l.node").alias("b")).distinct(), "led")
    scratch.drop(keyed)
    links = scratch.put(_verified(pairs, active, rules), "inside")
    scratch.drop(pairs)
    return links


def _matrix(members: DataFrame, active: DataFrame) -> DataFrame:
    """(group, low, high, bits): sizes and the union of the shingles, a fixed number of bits per group."""
    rows = members.join(active.select("node", "n", "bits"), "node")
    sizes = rows.groupBy("group").agg(F.min("n").alias("low"), F.max("n").alias("high"), F.count("*").alias("members"))
    union = rows.select("group", F.posexplode("bits").alias("at", "word")).groupBy("group", "at") \
        .agg(F.bit_or("word").alias("word")).groupBy("group") \
        .agg(F.transform(F.array_sort(F.collect_list(F.struct("at", "word"))), lambda x: x["word"]).alias("bits"))
    return sizes.join(union, "group")


def _qualifying(queries: DataFrame, active: DataFrame, matrix: DataFrame, rules: JoinRules) -> DataFrame:
    """Those (node, group) whose overlap bound reaches what a link with some member needs."""
    def run(batches):
        for batch in batches:
            n, low = batch["n"].to_numpy(), batch["low"].to_numpy()
            keep = []
            for tokens, bits, size, least in zip(batch["tokens"], batch["bits"], n, low):
                row = np.unpackbits(bits.values.to_numpy().view(np.uint8), bitorder="little")
                own = tokens.values.to_numpy().view(np.uint64)
                bound = int(row[(own >> np.uint64(20)) % np.uint64(rules.columns)].sum())
                # overlap a link needs with the smallest member the sizes allow
                least = max(int(least), -(-rules.percent * int(size) // 100))
                keep.append((100 + rules.percent) * bound >= rules.percent * (int(size) + least))
            yield pa.RecordBatch.from_arrays([batch[c] for c in ("node", "n", "group", "part")], names=["node", "n", "group", "part"]) \
                .filter(pa.array(keep, pa.bool_()))

    joined = queries.join(matrix.select("group", "low", "bits"), "group") \
        .join(active.select("node", "tokens"), "node").select("node", "n", "group", "part", "low", "tokens", "bits")
    return joined.mapInArrow(run, "node bigint, n bigint, `group` bigint, part bigint")


def _ring(n: Column) -> Column:
    """Sizes in steps of two."""
    return F.floor(F.log2(n.cast("double")))


def _bases(members: DataFrame, active: DataFrame, scratch: Scratch, sample: int = 15) -> DataFrame:
    """(group, ring, base, n_base): the shingles that most of a few members of a group have. They decide cost, not results."""
    key = ["group", "ring"]
    few = members.select(*key, "node", F.row_number().over(Window.partitionBy(*key).orderBy(F.xxhash64("node"), "node")).alias("no")) \
        .where(F.col("no") <= sample).join(active.select("node", "tokens"), "node")
    few = scratch.put(few.select(*key, "tokens"), "few")
    most = few.select(*key, F.explode("tokens").alias("token")).groupBy(*key, "token").agg(F.count("*").alias("n")) \
        .join(few.groupBy(*key).agg(F.count("*").alias("of")), key).where("2 * n > of")
    bases = most.groupBy(*key).agg(F.collect_list("token").alias("base"))
    bases = scratch.put(members.select(*key).distinct().join(bases, key, "left").select(
        *key, F.coalesce("base", F.array().cast("array<bigint>")).alias("base")).withColumn("n_base", F.size("base").cast("bigint")), "bases")
    scratch.drop(few)
    return bases


def _by_base(members: DataFrame, asking: DataFrame | None, active: DataFrame, scratch: Scratch, rules: JoinRules) -> DataFrame:
    """Links (a, b) of those who ask with members of the rings of groups they ask, enough of them to join what any link joins.

    ``members`` and ``asking`` are (group, ring, node, part); without ``asking``, the members ask each other. All members of
    a ring of sizes are compared with a base B of it. Let S be what a set and B do not share. Then |q & m| = |q & B| + |m & B|
    - |B| + |Sq & Sm|. If the rest suffices with Sq & Sm empty, q and m link, and both so with the member that has most in
    common with B: one link each joins all of these. Any other pair needs a number of elements in Sq & Sm, one at
    least. In any order of the elements, one of the first ones of Sq is then one of the first ones of Sm, with enough elements
    behind it in both. The order is by the pairs an element would make, so what many differ in from B comes last. Nodes of
    one part are joined already, and do not meet.
    """
    total, own, key = 100 + rules.percent, rules.percent, ["group", "ring"]
    bases = _bases(members, active, scratch)
    sets = active.select("node", "n", F.col("tokens").alias("set"))

    def against(rows: DataFrame) -> DataFrame:
        """With ``sure``: two nodes whose values sum up to ``total * n_base`` link whatever is in both S."""
        more, less = F.array_except("set", "base"), F.array_except("base", "set")
        seen = rows.join(bases, key).join(sets, "node").select(*key, "node", "part", "n", "n_base", more.alias("more"), less.alias("less"))
        both = (F.col("n") - F.size("more")).cast("bigint")
        return seen.select(*key, "node", "part", "n", "n_base", (total * both - own * F.col("n")).alias("sure"), F.concat("more", "less").alias("differs"))

    held = scratch.put(against(members), "held")
    met = held if asking is None else scratch.put(against(asking), "met")
    best = held.groupBy(*key).agg(F.max_by("node", F.struct("sure", "node")).alias("best"), F.max("sure").alias("most"))
    best = scratch.put(best, "best")
    judged = met.join(best, key)
    joined = F.col("sure") + F.col("most") >= total * F.col("n_base")
    direct = judged.where(joined & (F.col("node") != F.col("best"))).select(F.col("node").alias("a"), F.col("best").alias("b"))
    asked_by = judged.where(~joined).groupBy(*key).agg(F.max("sure").alias("asked_by"))

    def needs(most: str) -> Column:
        """The least number of elements in both S of a link with any node whose ``sure`` is up to ``most``; null if there is none."""
        least = F.greatest(F.lit(1).cast("bigint"), F.ceil((total * F.col("n_base") - F.col("sure") - F.col(most)) / total))
        return F.when(F.col(most).isNotNull() & (least <= F.size("differs")), least)

    if asking is None:
        roles = judged.join(asked_by, key).withColumns({"asks": F.when(~joined, needs("most")), "knows": needs("asked_by")})
    else:
        roles = judged.where(~joined).withColumns({"asks": needs("most"), "knows": F.lit(None).cast("bigint")}).drop("best", "most").unionByName(
            held.join(asked_by, key).withColumns({"asks": F.lit(None).cast("bigint"), "knows": needs("asked_by")}).drop("asked_by"))
    roles = scratch.put(roles.where("asks is not null or knows is not null").select(
        *key, "node", "part", "n", "n_base", "sure", "asks", "knows", "differs"), "roles")
    elements = roles.select(*key, "node", "part", "n", "n_base", "sure", "asks", "knows", F.explode("differs").alias("token"))
    weights = elements.groupBy(*key, "token").agg((F.count("asks") * F.count("knows")).alias("weight")).where("weight > 0")
    # elements that one side lacks come before all others; ``left`` is how many there are from each on
    of = Window.partitionBy(*key, "node").orderBy(F.desc("weight"), F.desc("token"))
    first = elements.join(weights, [*key, "token"]).withColumn("left", F.row_number().over(of).cast("bigint")).where("left >= least(asks, knows)")
    first = scratch.put(first.drop("weight"), "first")
    scratch.drop(roles)
    known = first.where("left >= knows").select(*key, "token", *[F.col(c).alias(f"m_{c}") for c in ("node", "part", "n", "sure", "left")])
    need = total * F.col("n_base") - F.col("sure") - F.col("m_sure")
    pairs = first.where("left >= asks").join(known, [*key, "token"]).where(
        (F.col("part") != F.col("m_part")) & (total * F.least("left", "m_left") >= need) & _sizes_allow(F.col("n"), F.col("m_n"), F.col("m_n"), rules))
    pairs = scratch.put(pairs.select(F.greatest("node", "m_node").alias("a"), F.least("node", "m_node").alias("b")).distinct(), "pairs")
    links = scratch.put(direct.unionByName(_verified(pairs, active, rules)), "links")
    scratch.drop(bases, held, best, first, pairs, *([] if asking is None else [met]))
    return links


def _matrix_links(postings: DataFrame, groups: DataFrame, inside: DataFrame, active: DataFrame, scratch: Scratch, rules: JoinRules) -> DataFrame:
    """Links between nodes of different groups, enough of them to join the groups that any link joins."""
    rows = postings.join(groups, "node").select("token", "node", "n", "group")
    mixed = rows.groupBy("token").agg(F.min("group").alias("low"), F.max("group").alias("high")).where("low <> high").select("token")
    shared = scratch.put(rows.join(mixed, "token", "left_semi"), "shared")
    # the leader of a shingle is the node with most links inside its group
    ends = inside.select(F.col("a").alias("node")).unionByName(inside.select(F.col("b").alias("node"))).groupBy("node").agg(F.count("*").alias("links"))
    central = F.struct(F.coalesce("links", F.lit(0)).alias("links"), "node")
    wide = shared.groupBy("token").agg(F.approx_count_distinct("group").alias("groups")).where(F.col("groups") > rules.crowd).select("token")
    crowd = shared.join(wide, "token", "left_semi").join(ends, "node", "left")
    # a node is also in the ring of the largest set it may link to, so those that may link are in one ring together
    rings = F.array_distinct(F.array(_ring(F.col("n")), _ring(100 * F.col("n") / rules.percent)))
    ringed = scratch.put(crowd.withColumn("ring", F.explode(rings)), "ringed")
    crowd = ringed.join(ringed.groupBy("token", "ring").agg(F.max_by("node", central).alias("leader")), ["token", "ring"])
    near = scratch.put(crowd.select(F.col("leader").alias("group"), "ring", "node", F.col("group").alias("part")).distinct(), "near")
    scratch.drop(ringed)
    parts = near.groupBy("group", "ring").agg(F.min("part").alias("low"), F.max("part").alias("high")).where("low <> high")
    crowded = _by_base(near.join(parts.select("group", "ring"), ["group", "ring"], "left_semi"), None, active, scratch, rules)
    rows = scratch.put(shared.join(wide, "token", "left_anti"), "open")
    scratch.drop(near)
    union = rows.groupBy("token", "group").agg(F.min("n").alias("low"), F.max("n").alias("high"))
    # each two groups meet once: the nodes of the one with the larger number ask the other
    queries = rows.alias("q").join(union.alias("u"), "token") \
        .where((F.col("q.group") > F.col("u.group")) & _sizes_allow(F.col("q.n"), F.col("u.low"), F.col("u.high"), rules)) \
        .select("q.node", "q.n", F.col("q.group").alias("part"), F.col("u.group").alias("group")).distinct()
    queries = scratch.put(queries, "queries")
    scratch.drop(rows)
    asked = groups.join(queries.select("group").distinct(), "group", "left_semi")
    matrix = scratch.put(_matrix(asked, active), "matrix")
    opened = scratch.put(_qualifying(queries, active, matrix, rules), "opened")
    scratch.drop(matrix)
    members = scratch.put(asked.join(opened.select("group").distinct(), "group", "left_semi").join(active.select("node", _ring(F.col("n")).alias("ring")), "node")
                          .select("group", "ring", "node", F.col("group").alias("part")), "members")
    rings = F.sequence(_ring(rules.percent * F.col("n") / 100), _ring(100 * F.col("n") / rules.percent))
    asking = opened.withColumn("ring", F.explode(rings)).select("group", "ring", "node", "part")
    scratch.drop(queries)
    links = _by_base(members, asking, active, scratch, rules)
    scratch.drop(opened, members, shared)
    return links.unionByName(crowded)


def similar_sets(docs: DataFrame, rules: JoinRules = DEFAULT) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row; component_id is the smallest number reachable by links."""
    spark = docs.sparkSession
    ship_package(spark)
    docs = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))
    with Scratch(spark, "ngram") as scratch:
        sets = scratch.put(_sets(docs, _frequent(docs, rules), rules), "sets")
        postings = _postings(sets, scratch, rules)
        # the prefixes are read; what follows needs a set's name and size
        bare = scratch.put(sets.drop("prefix"), "bare")
        scratch.drop(sets)
        active = _active(docs, bare, postings, scratch, rules)
        inside = _group_links(active, postings, scratch, rules)
        grouped = components(inside, scratch)
        groups = scratch.put(active.select("node").join(grouped, "node", "left").select(
            "node", F.coalesce("component", "node").alias("group")), "groups")
        across = _matrix_links(postings, groups, inside, active, scratch, rules)
        scratch.drop(postings, active)
        # rows of one number are one document, even with two texts
        twice = bare.where("n > 0 and doc_id is not null").groupBy("doc_id") \
            .agg(F.min("node").alias("b"), F.max("node").alias("a")).where("a <> b").select("a", "b")
        found = components(inside.unionByName(across).unionByName(twice), scratch)
        of_node = scratch.put(bare.where("n > 0 and doc_id is not null").groupBy("node").agg(F.min("doc_id").alias("first"))
                              .join(found, "node", "left").select("node", "first", F.coalesce("component", "node").alias("component")), "nodes")
        smallest = of_node.groupBy("component").agg(F.min("first").alias("component_id"))
        named = of_node.join(smallest, "component").select("node", "component_id")
        return scratch.keep(scratch.put(bare.select("doc_id", F.col("n").alias("n_shingles"), "node").join(named, "node", "left").select(
            "doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")).alias("component_id")), "result"))


def one_per_component(docs: DataFrame, rules: JoinRules = DEFAULT) -> DataFrame:
    """The rows of ``docs`` whose number is the smallest of their component, in the columns of ``docs``.

    Of several rows with that number one stays. Rows without a number stay.
    """
    found = similar_sets(docs, rules)
    gone, again, number = with_free_name(docs, "gone"), with_free_name(docs, "again"), F.col("doc_id").cast("bigint")
    dropped = found.where("component_id <> doc_id").select(F.col("doc_id").alias(gone)).distinct()
    kept = docs.join(dropped, number == F.col(gone), "left_anti")
    repeated = found.where("component_id = doc_id").groupBy("doc_id").count().where("count > 1")
    if not repeated.take(1):
        return kept
    twice = repeated.select(F.col("doc_id").alias(again))
    some = kept.join(twice, number == F.col(again), "left_semi").dropDuplicates(["doc_id"])
    return kept.join(twice, number == F.col(again), "left_anti").unionByName(some)
