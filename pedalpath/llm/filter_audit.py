"""Filter interaction audit: what each of five filters removes, in each of the 120 orders they may be applied in.

The filters. A: fewer than 50 words. B: under 65 % of the words are distinct. C: over 5 % of the characters are A-Z. D: a
character of ``#$%&*|``. E: the whole text is that of a smaller doc_id. The first four look at one text; E is found by

**Radix tries over ranges of texts.**

* *Ranges.* Bytes are summed by the first character of the texts; a prefix that holds more than a range may is taken one
  character on, then two, four and so on, until its parts are small or it is one text. Running sums over the prefixes of
  one parent give the bounds, about one a range; only these come to the driver.
* *Chunks.* Each task puts its texts into a compressed trie, a few megabytes at a time, and sends each different text once, with
  the smallest number it met. So a text with a third of all documents travels once a chunk.
* *Tries.* A task per range inserts its texts whole into a compressed trie; a terminal holds the smallest number. The
  terminals, walked in the end, are the documents that E lets pass.

**Masks.** A document is then the set of filters it fails. Sets are counted by source, at most 32 of them a source, and every
figure of every order is a sum over these counts.

Defined results for odd input: a null text is empty; an empty text fails A only, and E; a null source is the empty string; a
row without a number never fails E, makes no other row fail it and has no labels; rows of equal number and text do not
fail E for each other; a document is good (toxic) if any of its rows in ``labels`` says 1; texts of any length are read
whole; an empty table gives an empty one. Columns but ``doc_id``, ``text``, ``source`` (``quality``, ``toxic``) are not read.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import permutations

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window, functions as F

from ..session import ship_package
from .common import drop_written, stored, texts


@dataclass(frozen=True)
class AuditRules:
    min_words: int = 50
    #: least share of distinct words, largest share of capitals, in percent
    distinct: int = 65
    capitals: int = 5
    symbols: bytes = b"#$%&*|"
    #: bytes of texts in a range: as many ranges as shuffle partitions, within these bounds
    least_range: int = 8 << 20
    most_range: int = 64 << 20
    #: bytes of texts that a task combines before it sends them
    chunk: int = 16 << 20


DEFAULT = AuditRules()
FILTERS = "ABCDE"
ORDERS = ["".join(p) for p in permutations(FILTERS)]
_CAPITALS, _INNER = bytes(range(65, 91)), bytes(range(0x80, 0xC0))
KEY = ["doc_id", "k1", "k2"]


def own_failures(text: bytes, rules: AuditRules = DEFAULT) -> str:
    """Those of A to D that a text fails."""
    words = text.split()
    points = len(text.translate(None, _INNER))
    return "".join(name for name, fails in (
        ("A", len(words) < rules.min_words),
        ("B", 100 * len(set(words)) < rules.distinct * len(words)),
        ("C", 100 * (len(text) - len(text.translate(None, _CAPITALS))) > rules.capitals * points),
        ("D", len(text.translate(None, rules.symbols)) < len(text))) if fails)


def _key(text: bytes) -> tuple[int, int]:
    """128 bits that tell apart two texts of one number; whether texts are equal is decided in the tries."""
    whole = xxhash.xxh3_128_intdigest(text)
    return (whole >> 64) - (1 << 63), (whole & (1 << 64) - 1) - (1 << 63)


class RadixTrie:
    """Byte strings, each with the smallest tag it was inserted with. Edges hold whole runs of bytes."""

    __slots__ = ("root",)

    def __init__(self):
        self.root = [b"", {}, None]

    def insert(self, text: bytes, tag) -> None:
        node, at = self.root, 0
        while at < len(text):
            child = node[1].get(text[at])
            if child is None:
                child = node[1][text[at]] = [text[at:], {}, None]
                node, at = child, len(text)
            elif text.startswith(child[0], at):
                node, at = child, at + len(child[0])
            else:
                same = _common(child[0], text, at)
                upper = [child[0][:same], {child[0][same]: child}, None]
                child[0] = child[0][same:]
                node[1][text[at]] = upper
                node, at = upper, at + same
        if node[2] is None or tag < node[2]:
            node[2] = tag

    def tags(self) -> Iterator:
        todo = [self.root]
        while todo:
            _, children, tag = todo.pop()
            if tag is not None:
                yield tag
            todo.extend(children.values())

    def items(self) -> Iterator:
        """(text, tag) of every terminal."""
        todo = [(b"", self.root)]
        while todo:
            before, (label, children, tag) = todo.pop()
            whole = before + label
            if tag is not None:
                yield whole, tag
            todo.extend((whole, child) for child in children.values())


def _common(label: bytes, text: bytes, at: int) -> int:
    """How many bytes of ``label`` stand in ``text`` from ``at`` on; it does not stand there whole."""
    low, high = 1, min(len(label), len(text) - at)
    while low < high:
        middle = (low + high + 1) // 2
        if text.startswith(label[low:middle], at + low):
            low = middle
        else:
            high = middle - 1
    return low


def range_bounds(docs: DataFrame, rules: AuditRules = DEFAULT) -> list[bytes]:
    """Rising text prefixes; a range of texts reaches from one to the next and has a bounded number of bytes, copies of one
    text apart. There are about as many as ranges."""
    spark = docs.sparkSession
    all_texts = docs.select(F.coalesce("text", F.lit("")).alias("text"))
    size = F.octet_length("text").cast("bigint")
    total = all_texts.agg(F.sum(size)).first()[0] or 0
    most = min(max(total // int(spark.conf.get("spark.sql.shuffle.partitions")), rules.least_range), rules.most_range)
    found, length, rows, last = [], 1, all_texts.withColumn("parent", F.lit("")), None
    while True:
        summed = rows.groupBy("parent", F.substring("text", 1, length).alias("prefix")).agg(
            F.sum(size).alias("bytes"), F.min(F.xxhash64("text")).alias("low"), F.max(F.xxhash64("text")).alias("high"))
        upto = F.sum("bytes").over(Window.partitionBy("parent").orderBy("prefix"))
        part = F.floor((upto - F.col("bytes")) / most)
        summed = summed.withColumn("part", part)
        fresh = F.coalesce(F.lag("part").over(Window.partitionBy("parent").orderBy("prefix")), F.lit(-1)) != F.col("part")
        heavy = (F.col("bytes") > most) & (F.col("low") != F.col("high"))
        bounds, path = stored(summed.select("prefix", fresh.alias("fresh"), heavy.alias("heavy")).where("fresh or heavy"), "audit-bounds")
        found += [r[0].encode() for r in bounds.where("fresh").select("prefix").toLocalIterator()]
        # a text that ends before the prefix does is whole already
        parents = bounds.where("heavy").select(F.col("prefix").alias("parent"))
        done = parents.isEmpty()
        if last:
            drop_written(spark, last)
        last = path
        if done:
            drop_written(spark, path)
            return sorted(set(found) - {b""})
        rows = all_texts.join(parents, F.substring("text", 1, length) == F.col("parent"))
        length *= 2


def distinct_texts(docs: DataFrame, bounds: list[bytes], rules: AuditRules = DEFAULT) -> DataFrame:
    """(range, text, doc_id, k1, k2): the different texts of each chunk of a task, with the smallest number there."""
    schema = pa.schema([("range", pa.int32()), ("text", pa.large_binary()), ("doc_id", pa.int64()), ("k1", pa.int64()), ("k2", pa.int64())])

    def run(batches):
        trie, held = RadixTrie(), 0
        for batch in batches:
            for doc, text in zip(batch["doc_id"].to_pylist(), texts(batch["text"])):
                trie.insert(text, doc)
                held += len(text) + 100
                if held >= rules.chunk:
                    yield from flushed(trie)
                    trie, held = RadixTrie(), 0
        yield from flushed(trie)

    def flushed(trie):
        rows, size = [], 0
        for text, doc in trie.items():
            rows.append((bisect_right(bounds, text), text, doc, *_key(text)))
            size += len(text)
            if size >= rules.chunk // 4 or len(rows) >= 5_000:
                yield table(rows)
                rows, size = [], 0
        if rows:
            yield table(rows)

    def table(rows):
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    return docs.where("doc_id is not null").select("doc_id", "text").mapInArrow(
        run, "`range` int, text binary, doc_id bigint, k1 bigint, k2 bigint")


def first_holders(docs: DataFrame, rules: AuditRules = DEFAULT) -> DataFrame:
    """(doc_id, k1, k2): of every different text, the smallest number that holds it."""
    ship_package(docs.sparkSession)
    bounds = range_bounds(docs, rules)

    def run(batches):
        trie = RadixTrie()
        for batch in batches:
            tags = zip(*(batch[c].to_pylist() for c in KEY))
            for text, tag in zip(texts(batch["text"]), tags):
                trie.insert(text, tag)
        rows = []
        for tag in trie.tags():
            rows.append(tag)
            if len(rows) >= 50_000:
                yield table(rows)
                rows = []
        if rows:
            yield table(rows)

    def table(rows):
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], names=KEY)

    dealt = distinct_texts(docs, bounds, rules).repartitionById(len(bounds) + 1, F.col("range"))
    return dealt.select("text", *KEY).mapInArrow(run, "doc_id bigint, k1 bigint, k2 bigint")


def _own_marks(docs: DataFrame, rules: AuditRules) -> DataFrame:
    """(doc_id, k1, k2, part, fails) of every row, for the filters that need one text."""
    def run(batches):
        for batch in batches:
            rows = [(*_key(text), own_failures(text, rules)) for text in texts(batch["text"])]
            k1, k2, fails = zip(*rows) if rows else ((), (), ())
            yield pa.RecordBatch.from_arrays([
                batch["doc_id"], pa.array(k1, pa.int64()), pa.array(k2, pa.int64()), batch["part"], pa.array(fails, pa.string())],
                names=[*KEY, "part", "fails"])

    return docs.select("doc_id", "text", F.coalesce(F.col("source"), F.lit("")).alias("part")).mapInArrow(
        run, "doc_id bigint, k1 bigint, k2 bigint, part string, fails string")


def failure_sets(docs: DataFrame, labels: DataFrame, rules: AuditRules = DEFAULT) -> DataFrame:
    """(part, fails, n, good, toxic): documents by source and the set of filters they fail, as its letters in order."""
    ship_package(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"), F.col("source").cast("string"))
    marks = _own_marks(docs, rules)
    # equal rows, and rows without a number, are counted before they are joined
    counted, path = stored(marks.groupBy(*KEY, "part", "fails").agg(F.count("*").alias("n")), "audit-marks")
    firsts, firsts_path = stored(first_holders(docs, rules), "audit-firsts")
    named = counted.where("doc_id is not null").join(firsts.withColumn("first", F.lit(True)), KEY, "left").select(
        "doc_id", "part", F.concat("fails", F.when(F.col("first"), F.lit("")).otherwise(F.lit("E"))).alias("fails"), "n")
    marked = labels.where("doc_id is not null").groupBy(F.col("doc_id").cast("bigint").alias("doc_id")).agg(
        F.coalesce(F.max(F.col("quality") == 1), F.lit(False)).alias("good"),
        F.coalesce(F.max(F.col("toxic") == 1), F.lit(False)).alias("toxic"))
    named = named.join(marked, "doc_id", "left").drop("doc_id")
    nameless = counted.where("doc_id is null").select("part", "fails", "n", F.lit(None).cast("boolean").alias("good"),
                                                      F.lit(None).cast("boolean").alias("toxic"))
    zero = F.lit(0).cast("bigint")
    sets, _ = stored(named.unionByName(nameless).groupBy("part", "fails").agg(
        F.sum("n").alias("n"), F.sum(F.when(F.col("good"), F.col("n")).otherwise(zero)).alias("good"),
        F.sum(F.when(F.col("toxic"), F.col("n")).otherwise(zero)).alias("toxic")), "audit-sets")
    drop_written(docs, path, firsts_path)
    return sets


def audit(docs: DataFrame, labels: DataFrame, rules: AuditRules = DEFAULT) -> DataFrame:
    """A row per source, order of the filters and step, see the module's first lines. Sources without documents have none."""
    rows = failure_sets(docs, labels, rules)
    rows = rows.withColumn("filter_order", F.explode(F.array(*map(F.lit, ORDERS))))
    rows = rows.withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(len(FILTERS)))))
    letter = F.substr("filter_order", F.col("step"), F.lit(1))
    before = F.substr("filter_order", F.lit(1), F.col("step") - 1)

    # letters of the set that come earlier; "0" stands for none in an empty set
    met = F.regexp_replace(before, F.concat(F.lit("[^0"), F.col("fails"), F.lit("]")), F.lit(""))
    now, earlier = F.contains(F.col("fails"), letter), F.length(met) > 0
    cases = {"kept": (~now & ~earlier, "n"), "removed": (now & ~earlier, "n"), "redundant": (now & earlier, "n"),
             "unique_fails": (F.col("fails") == letter, "n"), "good_lost": (now & ~earlier, "good"),
             "toxic_lost": (now & ~earlier, "toxic")}
    per = rows.groupBy("part", "filter_order", "step", letter.alias("letter")).agg(*[
        F.sum(F.when(case, F.col(what)).otherwise(F.lit(0).cast("bigint"))).alias(name) for name, (case, what) in cases.items()])
    over_orders = F.sum("removed").over(Window.partitionBy("part", "letter"))
    return per.withColumn("shapley", over_orders).drop("letter")
