"""Substring dedup by sliding runs of sentences.

A text is a row of sentences; one of more than ``piece_words`` words is cut into pieces, so that a long one does not hide a
repeat. The cuts follow the words alone: a word is cut before if the hash of it and the next is the least among
``near`` places in a row. So equal passages get equal pieces wherever they stand, but for the words before their first and after
their last common cut, and no piece is longer than ``near`` words and one. From every sentence on, and back from every sentence, the shortest run of at least ``sentences``
sentences and ``words`` words is hashed (64 bits, of lower-cased words without punctuation between). Runs are joined over all
documents. A run that is not the first of its hash, in the order (doc_id, place), is removed with all its
sentences; longer repeats are covered by the runs they hold.

Hashes are counted before the shuffle. Runs whose hash may occur twice are found with a bitmap of fixed size; only they
are joined, exactly, with the first places. A passage that a third of all documents hold is one counted key, and its
rows meet one row in a join that Spark can split.

Defined results for odd input: null and empty texts have no sentences; texts of any length are read whole; rows equal in
number and text are one document and cut alike (so that they do not repeat each other); a null doc_id comes
last in the order; an empty table finds nothing; other columns are not read, and pass through ``without_repeats``.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from ..session import ship_package
from .common import bitmap_of, drop_written, in_bitmap, map_batches, stored, texts, with_free_name


@dataclass(frozen=True)
class SpanRules:
    sentences: int = 2
    words: int = 24
    piece_words: int = 24
    #: of so many places in a row, one is cut at
    near: int = 6
    bits: int = 25


DEFAULT = SpanRules()
_SENTENCE = re.compile(rb"[^.!?\n]*(?:[.!?]+(?=[\s\"')\]]|$)[\"')\]]*|[.!?]+|\n|$)[ \t\r\f\v]*")
_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
#: Full stops of other scripts, as an ASCII one and blanks of the same length.
_STOPS = {c.encode(): b"." + b" " * (len(c.encode()) - 1) for c in "。｡．！？؟۔।॥።፧။។"}
_STOP = re.compile(b"|".join(map(re.escape, _STOPS)))
_STEP, _MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)
_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def cuts(words: list[bytes], near: int) -> list[int]:
    """Places of the least hash among ``near`` places in a row, the last of equal ones; 0 is always one.

    Among equal hashes the place chosen before stays while it is in reach, so that a repeated word is not cut at each place.
    """
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), dtype=np.uint64, count=len(words))
    h = (h[:-1] * _STEP + h[1:]) * _MIX
    h = (h ^ (h >> np.uint64(31))).tolist()
    found, at = [0], -1
    for end in range(near, len(h) + 1):
        # of places end - near + 1 to end, the hash of place p is h[p]; place 0 is the start
        first = end - near + 1
        if at < first:
            last = min(end, len(h) - 1)
            at = min(range(last, first - 1, -1), key=h.__getitem__)
        elif end < len(h) and h[end] < h[at]:
            at = end
        if found[-1] != at:
            found.append(at)
    return found


def sentences(text: bytes, rules: SpanRules = DEFAULT) -> tuple[list[tuple[int, int]], list[list[bytes]]]:
    """Byte ranges that cover the text's sentences (blank ones are left out), and their words."""
    if not text.isascii():
        text = _STOP.sub(lambda m: _STOPS[m.group()], text)
    spans, words = [], []
    for match in _SENTENCE.finditer(text):
        begin, end = match.span()
        found = _WORD.findall(text[begin:end].translate(_LOWER))
        if not found:
            if spans and end > begin:
                # what has no word goes with the sentence before
                spans[-1] = spans[-1][0], end
            continue
        if len(found) <= rules.piece_words:
            spans.append((begin, end))
            words.append(found)
            continue
        places = [m.start() + begin for m in _WORD.finditer(text[begin:end].translate(_LOWER))]
        at = cuts(found, rules.near)
        for k, after in zip(at, [*at[1:], len(found)]):
            spans.append((begin if k == 0 else places[k], end if after == len(found) else places[after]))
            words.append(found[k:after])
    return spans, words


def runs(words: list[list[bytes]], rules: SpanRules = DEFAULT) -> list[tuple[int, int]]:
    """First and last sentence of the shortest runs from, and back from, every sentence; each once, in rising order."""
    total = np.concatenate([[0], np.cumsum([len(w) for w in words], dtype=np.int64)])
    n = len(words)
    if n < rules.sentences or total[-1] < rules.words:
        return []
    at = np.arange(n)
    last = np.maximum(np.searchsorted(total, total[:-1] + rules.words, side="left") - 1, at + rules.sentences - 1)
    first = np.minimum(np.searchsorted(total, total[1:] - rules.words, side="right") - 1, at - rules.sentences + 1)
    found = {(a, b) for a, b in zip(at.tolist(), last.tolist()) if b < n}
    found.update((a, b) for a, b in zip(first.tolist(), at.tolist()) if a >= 0)
    return sorted(found)


def _hashed(text: bytes, rules: SpanRules) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    _, words = sentences(text, rules)
    found = runs(words, rules)
    joined = [b" ".join(w) for w in words]
    h = [xxhash.xxh3_64_intdigest(b" ".join(joined[a:b + 1])) for a, b in found]
    place = np.array(found, dtype=np.int64).reshape(-1, 2)
    return np.array(h, dtype=np.uint64), place[:, 0], place[:, 1]


def _narrow(docs: DataFrame) -> DataFrame:
    rows = docs.select(F.col("doc_id").cast("bigint"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    return rows.withColumn("sig", F.xxhash64("text"))


def run_table(docs: DataFrame, rules: SpanRules = DEFAULT) -> DataFrame:
    """(doc_id, sig, first, last, h): every run of every text."""
    ship_package(docs.sparkSession)

    def run(batches):
        for batch in batches:
            held, size = [], 0
            for number, sig, text in zip(batch["doc_id"].to_pylist(), batch["sig"].to_pylist(), texts(batch["text"])):
                found = _hashed(text, rules)
                if not len(found[0]):
                    continue
                held.append((number, sig, found))
                size += len(found[0])
                if size >= 200_000:
                    yield table(held)
                    held, size = [], 0
            if held:
                yield table(held)

    def table(held):
        n = [len(f[0]) for _, _, f in held]
        number = pa.array([d for d, _, _ in held], pa.int64()).take(pa.array(np.repeat(np.arange(len(n)), n)))
        return pa.RecordBatch.from_arrays(
            [number, pa.array(np.repeat([s for _, s, _ in held], n)), pa.array(np.concatenate([f[1] for _, _, f in held])),
             pa.array(np.concatenate([f[2] for _, _, f in held])), pa.array(np.concatenate([f[0] for _, _, f in held]).view(np.int64))],
            names=["doc_id", "sig", "first", "last", "h"])

    return _narrow(docs).mapInArrow(run, "doc_id bigint, sig bigint, first bigint, last bigint, h bigint")


def _survivors(runs_: DataFrame, bitmap: np.ndarray) -> DataFrame:
    def run(batches):
        for batch in batches:
            yield batch.filter(pa.array(in_bitmap(bitmap, batch["h"].to_numpy().view(np.uint64))))
    return runs_.mapInArrow(run, runs_.schema)


def repeats(docs: DataFrame, rules: SpanRules = DEFAULT) -> DataFrame:
    """(doc_id, sig, first, last, first_doc_id): runs of sentences that are not the first of their hash."""
    rows, path = stored(run_table(docs, rules), "span-runs")
    twice, twice_path = stored(rows.groupBy("h").agg(F.count("*").alias("n")).where("n > 1").select("h"), "span-twice")
    bitmap = bitmap_of(twice, "h", rules.bits)
    some, some_path = stored(_survivors(rows, bitmap), "span-some")
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "sig", "first")
    firsts = some.groupBy("h").agg(F.min(order).alias("origin"), F.max(order).alias("other")).where("origin <> other").select("h", "origin")
    later = some.join(firsts, "h").where(order != F.col("origin")) \
        .select("doc_id", "sig", "first", "last", F.col("origin.doc_id").alias("first_doc_id"))
    found, _ = stored(later, "span-repeats")
    drop_written(docs, path, twice_path, some_path)
    return found


def stretches(found: DataFrame) -> DataFrame:
    """(doc_id, sig, cut, origins): per document the sentences to remove, as ranges in rising order without overlap, and
    the documents that keep them."""
    def make():
        def step(batch):
            for number, sig, ranges, origins in zip(*(batch[c].to_pylist() for c in ("doc_id", "sig", "ranges", "origins"))):
                merged: list[list[int]] = []
                for r in sorted(ranges, key=lambda r: (r["first"], r["last"])):
                    if merged and r["first"] <= merged[-1][1] + 1:
                        merged[-1][1] = max(merged[-1][1], r["last"])
                    else:
                        merged.append([r["first"], r["last"]])
                yield {"doc_id": number, "sig": sig, "cut": [x for m in merged for x in m], "origins": origins}
        return step
    # a document's own runs, in number below twice its sentences
    per = found.groupBy("doc_id", "sig").agg(F.collect_set(F.struct("first", "last")).alias("ranges"),
                                             F.array_sort(F.collect_set("first_doc_id")).alias("origins"))
    return map_batches(per, make, "doc_id bigint, sig bigint, cut array<bigint>, origins array<bigint>")


def cut_text(text: bytes, cut: list[int], rules: SpanRules = DEFAULT) -> tuple[bytes, int, int, int]:
    """The text left, and how many sentences, words and passages went."""
    spans, words = sentences(text, rules)
    left, at, n_words, n_sentences = [], 0, 0, 0
    for a, b in zip(cut[::2], cut[1::2]):
        left.append(text[at:spans[a][0]])
        at = spans[b][1]
        n_sentences += b - a + 1
        n_words += sum(map(len, words[a:b + 1]))
    left.append(text[at:])
    return b"".join(left), n_sentences, n_words, len(cut) // 2


def dedup_report(docs: DataFrame, rules: SpanRules = DEFAULT) -> DataFrame:
    """doc_id, n_passages, n_sentences, n_words removed, first_doc_ids that keep them, and the text left, of every document
    that loses something."""
    cuts, _ = stored(stretches(repeats(docs, rules)), "span-cuts")
    rows = _narrow(docs).alias("d").join(
        cuts.alias("c"), F.col("d.doc_id").eqNullSafe(F.col("c.doc_id")) & (F.col("d.sig") == F.col("c.sig"))) \
        .select("d.doc_id", "d.text", "c.cut", "c.origins")

    def make():
        def step(batch):
            for number, text, cut, origins in zip(batch["doc_id"].to_pylist(), texts(batch["text"]), batch["cut"].to_pylist(), batch["origins"].to_pylist()):
                left, n_sentences, n_words, n_passages = cut_text(text, cut, rules)
                yield {"doc_id": number, "n_passages": n_passages, "n_sentences": n_sentences, "n_words": n_words,
                       "first_doc_ids": origins, "text_left": left.decode("utf-8", "replace")}
        return step

    return map_batches(rows, make, "doc_id bigint, n_passages bigint, n_sentences bigint, n_words bigint, first_doc_ids array<bigint>, "
                                   "text_left string", rows=200)


def without_repeats(docs: DataFrame, rules: SpanRules = DEFAULT) -> DataFrame:
    """``docs`` with the repeats taken out of ``text``, in the columns of ``docs``; documents with nothing left go.

    ``n_chars`` follows the text where there is such a column.
    """
    ship_package(docs.sparkSession)
    doc, sig, cut_name = (with_free_name(docs, n) for n in ("cut_doc", "cut_sig", "cut_ranges"))
    cuts, _ = stored(stretches(repeats(docs, rules)).select(F.col("doc_id").alias(doc), F.col("sig").alias(sig),
                                                            F.col("cut").alias(cut_name)), "span-cuts")
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.withColumn("text", F.col("text").cast("string")).join(
        cuts, F.col("doc_id").cast("bigint").eqNullSafe(F.col(doc)) & (F.xxhash64(text) == F.col(sig)), "left").drop(doc, sig)
    schema = rows.schema
    at, size = rows.columns.index("text"), rows.columns.index("n_chars") if "n_chars" in rows.columns else None

    def run(batches):
        for batch in batches:
            keep, arrays = [], list(batch.columns)
            left, lengths = arrays[at].to_pylist(), arrays[size].to_pylist() if size is not None else None
            for k, cut in enumerate(batch[cut_name].to_pylist()):
                if cut:
                    left[k] = cut_text((left[k] or "").encode(), cut, rules)[0].decode("utf-8", "replace")
                    if lengths is not None:
                        lengths[k] = len(left[k])
                keep.append(not cut or bool(left[k].strip()))
            arrays[at] = pa.array(left, batch.schema.field(at).type)
            if lengths is not None:
                arrays[size] = pa.array(lengths, batch.schema.field(size).type)
            yield pa.RecordBatch.from_arrays(arrays, schema=batch.schema).filter(pa.array(keep, pa.bool_()))

    return rows.mapInArrow(run, schema).drop(cut_name)
