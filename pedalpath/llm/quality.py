"""Line-first quality rules: lines that fail a rule go, then documents that lost too much text go.

Defined results for odd input: a null text counts as empty; an empty text has no words and is rejected; a text of
any length is read whole, one document at a time; repeated rows are judged each for itself; an empty table gives an
empty table; other columns pass through, whatever their names.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ..session import ship_package
from .common import map_batches, texts, with_free_name

#: Phrases of page furniture.
BOILERPLATE = (
    "accept all cookies", "all comments are closed", "click here to", "cookie policy", "enable javascript",
    "follow us on", "lorem ipsum", "privacy policy", "read more", "share this", "sign in", "sign up", "skip to content",
    "subscribe to our newsletter", "terms of service", "terms of use",
)
SYMBOLS = b"#*$%&|<>"
SEPARATORS = frozenset((b"|", b">", b"/", b"-", "»".encode(), "·".encode(), "•".encode()))


@dataclass(frozen=True)
class QualityRules:
    min_words: int = 50
    max_repeat_percent: int = 50
    #: a line fails with more symbols than this share of its characters
    max_line_symbols: float = 0.10
    #: ... with at least this many separators between words, and this share of its words
    min_separators: int = 3
    separator_share: float = 0.2
    #: ... with this share of words equal to the word before
    max_line_repeats: float = 0.4
    #: ... with this share of capital letters, or of words that end in two exclamation marks
    max_capitals: float = 0.7
    #: ... with more words than this and no punctuation at all
    max_unpunctuated: int = 100
    #: furniture phrases count only in lines of at most so many words
    boilerplate_words: int = 25
    #: a document goes with less than this share of its words left
    min_words_left: float = 0.5


DEFAULT = QualityRules()
_PHRASE = re.compile("|".join(map(re.escape, BOILERPLATE)).encode())
_PUNCTUATION = re.compile(rb"[.,;:?!]|\xe3\x80\x82|\xe3\x80\x81|\xd8\x9f|\xe0\xa5\xa4")
_CAPITALS = bytes(range(65, 91))
_SMALL = bytes(range(97, 123))


def line_fails(line: bytes, words: list[bytes], rules: QualityRules = DEFAULT) -> str | None:
    """The rule by which a line with words fails, or None."""
    solid = sum(map(len, words))
    symbols = len(line) - len(line.translate(None, SYMBOLS))
    if symbols:
        separators = sum(w in SEPARATORS for w in words)
        if separators >= rules.min_separators and separators >= rules.separator_share * len(words):
            return "navigation"
        if symbols > rules.max_line_symbols * solid:
            return "symbols"
    if len(words) <= rules.boilerplate_words and _PHRASE.search(line.lower()):
        return "boilerplate"
    if len(words) >= 6 and sum(a == b for a, b in zip(words, words[1:])) > rules.max_line_repeats * len(words):
        return "repeats"
    capitals = len(line) - len(line.translate(None, _CAPITALS))
    if capitals >= 20:
        small = len(line) - len(line.translate(None, _SMALL))
        if capitals > rules.max_capitals * (capitals + small):
            return "capitals"
    if len(words) >= 4 and line.count(b"!!") >= 0.5 * len(words):
        return "exclamations"
    if len(words) > rules.max_unpunctuated and not _PUNCTUATION.search(line):
        return "punctuation"
    return None


def repeat_words(words: list[bytes]) -> int:
    """Words that stand in a three-word window found twice or more."""
    if len(words) < 4:
        return 0
    number = {w: i for i, w in enumerate(dict.fromkeys(words))}
    ids = np.fromiter(map(number.__getitem__, words), dtype=np.int64, count=len(words))
    pair = ids[:-1] * len(number) + ids[1:]
    if len(number) > 2_000_000:  # three numbers no longer fit 63 bits
        pair = np.unique(pair, return_inverse=True)[1]
    code = pair[:-1] * len(number) + ids[2:]
    order = np.argsort(code, kind="stable")
    same = np.diff(code[order]) == 0
    if not same.any():
        return 0
    twice = np.zeros(len(code), dtype=bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    covered = np.zeros(len(ids), dtype=bool)
    for k in range(3):
        covered[k:len(ids) - 2 + k] |= twice
    return int(covered.sum())


def judge(text: bytes, rules: QualityRules = DEFAULT) -> dict:
    """Figures, failed lines and verdict of one text."""
    words = text.split()
    solid = sum(map(len, words))
    repeated = repeat_words(words)
    base_failed = len(words) < rules.min_words or 100 * repeated > rules.max_repeat_percent * len(words)
    seen: set[bytes] = set()
    left, lost, duplicates = [], {}, 0
    words_left = 0
    for line in text.split(b"\n"):
        parts = line.split()
        if not parts:
            left.append(line)
            continue
        again = line in seen
        duplicates += again
        seen.add(line)
        why = "duplicate" if again else line_fails(line, parts, rules)
        if why:
            lost[why] = lost.get(why, 0) + 1
        else:
            left.append(line)
            words_left += len(parts)
    # code points: all bytes but those that continue a character
    points = len(text.decode("utf-8", "replace")) - (len(text) - solid)
    return {
        "n_words": len(words), "word_chars": points,
        "n_symbols": len(text) - len(text.translate(None, SYMBOLS)),
        "n_dup_lines": duplicates, "n_repeat_words": repeated, "base_failed": base_failed,
        "kept": not base_failed and words_left >= rules.min_words_left * len(words),
        "words_left": words_left, "lines_lost": sum(lost.values()),
        "reasons": ",".join(f"{k}={v}" for k, v in sorted(lost.items())) or None,
        "cleaned": b"\n".join(left) if lost else text,
    }


REPORT = ("n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, "
          "base_failed boolean, kept boolean, words_left bigint, lines_lost bigint, reasons string")


def quality_report(docs: DataFrame, rules: QualityRules = DEFAULT) -> DataFrame:
    """One row per document: doc_id, the figures, the verdict and what was lost, without the text."""
    def make():
        def step(batch: pa.RecordBatch):
            for doc, text in zip(batch["doc_id"].to_pylist(), texts(batch["text"])):
                found = judge(text, rules)
                del found["cleaned"]
                yield {"doc_id": doc, **found}
        return step
    return map_batches(docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string")), make,
                       f"doc_id bigint, {REPORT}")


def clean_documents(docs: DataFrame, rules: QualityRules = DEFAULT) -> DataFrame:
    """The documents that stay, with their failed lines taken out of ``text``, in the columns of ``docs``.

    ``n_chars`` follows the text where there is such a column. Rows pass in Arrow batches; nothing is shuffled.
    """
    ship_package(docs.sparkSession)
    gone = with_free_name(docs, "quality_kept")
    schema = docs.withColumn("text", F.col("text").cast("string")).withColumn(gone, F.lit(True)).schema
    at, size = docs.columns.index("text"), docs.columns.index("n_chars") if "n_chars" in docs.columns else None

    def run(batches):
        for batch in batches:
            found = [judge(t, rules) for t in texts(batch.column(at))]
            kept = pa.array([x["kept"] for x in found], pa.bool_())
            arrays = list(batch.columns)
            arrays[at] = pa.array([x["cleaned"] for x in found], pa.binary()).cast(batch.schema.field(at).type)
            if size is not None:
                changed = [n if not x["lines_lost"] else len(x["cleaned"].decode("utf-8", "replace"))
                           for n, x in zip(batch.column(size).to_pylist(), found)]
                arrays[size] = pa.array(changed, batch.schema.field(size).type)
            yield pa.RecordBatch.from_arrays([*arrays, kept], names=[*batch.schema.names, gone]).filter(kept)

    return docs.mapInArrow(run, schema).drop(gone)
