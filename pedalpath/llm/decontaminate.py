"""Benchmark decontamination by templates, which also finds re-parameterised questions.

A text becomes a sequence of tokens in which numbers, units and names are typed placeholders; the words themselves are
kept as slot values. Windows of eight tokens are hashed on both sides and joined. Windows that match on one diagonal
(place in the document less place in the item) must be consistent: each slot value of the item stands for one
value in the document; a window that holds a value which stands for two does not count. An item counts as leaked if enough
of its windows match.

A capital at the start of a sentence may be a word or a name. Windows with one are indexed in both readings, on both sides.
Windows with too few plain words for a template are indexed by their literal tokens, and so are items too short for one, whole.

Only windows whose bit is set in a bitmap of the benchmark's windows leave a document; the bitmap has a fixed size, and the
join that follows is exact. So the cost of the join follows the matches, however large the benchmark.

Defined results for odd input: null and empty texts match nothing; texts of any length are read whole; rows equal in
number and text are judged once, and removed alike; items with fewer than ``shortest`` tokens are found where
they are a whole line, word for word; where an item has too few plain words, it is found word for word only; an empty table, on either side, finds nothing; other
columns are not read, and pass through ``without_leaks``.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import lru_cache
from unicodedata import category

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from .common import bitmap_of, in_bitmap, map_batches, stored, texts, with_free_name

#: Words that count as units.
UNITS = frozenset("""
% $ £ ¥ ° € celsius cent cents centimeter centimeters cm day days dollar dollars euro euros fahrenheit feet foot ft g gallon
gallons gb gram grams h hour hours hz inch inches kb kelvin kg kilogram kilograms kilometer kilometers km kmh kph lb lbs
liter liters litre litres mb meter meters metre metres mg mile miles milligram milliliter millimeter minute minutes ml mm month
months mph ounce ounces oz pence percent pound pounds sec second seconds ton tonne tonnes tons volt volts watt watts week
weeks yard yards year years
""".split())
_TOKEN = re.compile(r"[^\W\d_]+|\d+(?:[.,:/]\d+)*|[.!?\n]+|(?<=\d)[%$£¥°€]|[$£¥€](?=\d)")
WORD, CAPITAL, NUMBER, UNIT, BREAK = range(5)
_STEP, _MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)
#: Keeps hashes of literal windows apart from those of templates.
_LITERAL = np.uint64(0xA5A5A5A5A5A5A5A5)

#: Hash of a token: the sum of a value a character of it, lower-cased, times powers of an odd base, then mixed.
_BASE = 0xF1357AEA2E62A9C5
_M64 = (1 << 64) - 1
#: Classes of characters: letters, digits, sentence breaks, signs that are units beside a digit.
_LETTER, _DIGIT, _STOP, _SIGN = range(1, 5)
#: Kinds of tokens by the class of their first character.
_KIND = np.array([0, WORD, NUMBER, BREAK, UNIT], dtype=np.uint64)
_SIGNS, _BEFORE, _JOINS = "%$£¥°€", "$£¥€", ".,:/"
#: Characters whose lower case is two, or hangs on their neighbours: texts with them are read by the pattern.
_ODD = ("\u0130", "\u03a3")


def _mixed(x):
    x = (x ^ (x >> np.uint64(32))) * _MIX
    return (x ^ (x >> np.uint64(29))) & ~np.uint64(7)


@lru_cache(1)
def _tables() -> tuple[np.ndarray, ...]:
    """By code point: its class, the value of its lower case, and whether it is an upper, a lower or title, and a digit to Python
    but not to the pattern. Made once a worker."""
    every = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
    kind, value = np.zeros(0x110000, dtype=np.uint8), np.arange(1, 0x110001, dtype=np.uint64)
    value = _mixed(value * _STEP) | np.uint64(1)
    upper, low, figure = (np.zeros(0x110000, dtype=bool) for _ in range(3))
    for found, c in ((re.findall(r"[^\W\d_]", every), _LETTER), (re.findall(r"\d", every), _DIGIT), (".!?\n", _STOP), (_SIGNS, _SIGN)):
        kind[list(map(ord, found))] = c
        if c == _LETTER:
            at = np.array(list(map(ord, found)))
            upper[at], low[at] = [x.isupper() for x in found], [x.islower() or category(x) == "Lt" for x in found]
            figure[at] = [x.isdigit() for x in found]
            turned = [x.lower() for x in found]
            value[at] = value[[ord(y) if len(y) == 1 else ord(x) for x, y in zip(found, turned)]]
    return kind, value, upper, low, figure


def token_hash(token: str) -> int:
    """The same as ``_Codes`` has for it; the lowest three bits are the kind's and zero here."""
    total, power, value = 0, 1, _tables()[1]
    for c in token.lower():
        total, power = total + int(value[ord(c)]) * power, power * _BASE & _M64
    return int(_mixed(np.array([total & _M64], dtype=np.uint64))[0])


@dataclass(frozen=True)
class LeakRules:
    window: int = 8
    shortest: int = 4
    #: share of a window that must be plain words
    plain: float = 0.5
    #: an item is leaked with so many matching windows, or this share of its windows
    enough: int = 6
    share: float = 0.5
    bits: int = 20


DEFAULT = LeakRules()


class _Known(dict):
    def __missing__(self, token: str) -> int:
        first = token[0]
        if first in ".!?\n":
            kind = BREAK
        elif first.isdigit():
            kind = NUMBER
        elif token.lower() in UNITS:
            kind = UNIT
        else:
            # words all in capitals are set so, and no names
            kind = CAPITAL if first.isupper() and not token.isupper() else WORD
        self[token] = figure = token_hash(token) | kind
        return figure


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``n`` powers of the base, and of its inverse."""
    bases = np.empty((n, 2), dtype=np.uint64)
    bases[0], bases[1:] = 1, (_BASE, pow(_BASE, -1, 1 << 64))
    up, down = np.multiply.accumulate(bases, axis=0).T
    return np.ascontiguousarray(up), np.ascontiguousarray(down)


class _Codes:
    """Tokens of texts, as ``_TOKEN`` finds them, from arrays of their characters: a text has no object a token."""

    def __init__(self):
        self.up, self.down = _powers(1 << 14)
        self.units = np.array(sorted(map(token_hash, UNITS)), dtype=np.uint64)
        #: says of a hash's highest bits whether a unit has them
        self.may_be = np.zeros(1 << 16, dtype=bool)
        self.may_be[self.units >> np.uint64(48)] = True

    def of(self, raw: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(hash with the kind in the lowest three bits, start, end) of the tokens of a text, which comes as its code points."""
        classes, values, upper, low, figure = _tables()
        raw = raw.astype(np.intp)
        if len(raw) > len(self.up):
            self.up, self.down = _powers(1 << len(raw).bit_length())
        # a place without a class on either side
        kind = np.zeros(len(raw) + 2, dtype=np.uint8)
        own = kind[1:-1]
        own[:] = classes.take(raw)
        digit = kind == _DIGIT
        sign = np.flatnonzero(own == _SIGN)
        if len(sign):
            own[sign[~(digit[sign] | digit[sign + 2] & np.isin(raw[sign], list(map(ord, _BEFORE))))]] = 0
        between = np.flatnonzero(digit[:-2] & digit[2:])
        own[between[np.isin(raw[between], list(map(ord, _JOINS)))]] = _DIGIT
        # a sign is a token of its own
        signs = kind == _SIGN
        changed = kind[1:] != kind[:-1]
        start = np.flatnonzero((changed[:-1] | signs[1:-1]) & (own > 0))
        end = np.flatnonzero((changed[1:] | signs[1:-1]) & (own > 0)) + 1
        if not len(start):
            return np.empty(0, dtype=np.uint64), start, end
        total = _mixed(np.add.reduceat(values.take(raw) * self.up[:len(raw)] * (own > 0), start) * self.down[start])
        head, first = own[start], raw[start]
        kinds = _KIND[head]
        capital = np.flatnonzero(upper[first])
        if len(capital):  # words all in capitals are set so, and no names
            lows = np.concatenate([[0], np.cumsum(low.take(raw))])
            kinds[capital[lows[end[capital]] > lows[start[capital]]]] = CAPITAL
        kinds[figure[first]] = NUMBER
        unit = np.flatnonzero(self.may_be[total >> np.uint64(48)])
        kinds[unit[(head[unit] == _LETTER) & np.isin(total[unit], self.units)]] = UNIT
        return total | kinds, start, end


class Templates:
    """Token sequences of texts; figures of a token are worked out once and kept for at most ``room`` tokens."""

    def __init__(self, room: int = 400_000):
        self.room = room
        #: token -> its hash, with the kind in the lowest three bits
        self.known = _Known()
        self.codes = _Codes()

    def of(self, text: bytes) -> tuple[np.ndarray, np.ndarray, "Tokens | Cuts"]:
        """Hashes, kinds (WORD, or the placeholder's) and tokens, without the sentence breaks."""
        plain, _, _, tokens = self.readings(text)
        return *plain, tokens

    def readings(self, text: bytes):
        """(hashes, kinds) with capitals at the start of a sentence as words, (hashes, kinds) with them as names, or None if
        there are none, hashes of the literal tokens, and the tokens."""
        written = text if text.isascii() else text.decode("utf-8", "replace")
        if written is text:
            code, first, last = self.codes.of(np.frombuffer(text, dtype=np.uint8))
        elif not any(c in written for c in _ODD):
            code, first, last = self.codes.of(np.frombuffer(written.encode("utf-32-le"), dtype=np.uint32))
        else:
            first = _TOKEN.findall(written)
            known = self.known
            if len(known) > self.room:
                known.clear()
            code = np.fromiter(map(known.__getitem__, first), dtype=np.uint64, count=len(first))
        kind = (code & np.uint64(7)).astype(np.int8)
        start = np.ones(len(code), dtype=bool)
        start[1:] = kind[:-1] == BREAK
        places = np.flatnonzero(kind != BREAK)
        literal, named = code[places] >> np.uint64(3), kind[places]
        # a capital at the start of a sentence says nothing
        either = (named == CAPITAL) & start[places]
        kind = np.where(either, np.int8(WORD), named)
        plain, other = ((np.where(k == WORD, literal, k.astype(np.uint64)), k) for k in (kind, named))
        tokens = Tokens(first, places) if isinstance(first, list) else Cuts(written, first, last, places)
        return plain, other if either.any() else None, literal ^ _LITERAL, tokens


@dataclass(frozen=True)
class Tokens:
    """Those of ``tokens`` at ``places``; few of them are ever looked at."""

    tokens: list[str]
    places: np.ndarray

    def __getitem__(self, i: int) -> str:
        return self.tokens[self.places[i]]


@dataclass(frozen=True)
class Cuts:
    """The same, as places in the text."""

    text: str | bytes
    start: np.ndarray
    end: np.ndarray
    places: np.ndarray

    def __getitem__(self, i: int) -> str:
        at = self.places[i]
        token = self.text[self.start[at]:self.end[at]]
        return token if isinstance(token, str) else token.decode()


def windows(h: np.ndarray, kind: np.ndarray, size: int, plain: float) -> np.ndarray:
    """Hash of every window, 0 where it has too few plain words."""
    if len(h) < size:
        return np.empty(0, dtype=np.uint64)
    total = np.full(len(h) - size + 1, size, dtype=np.uint64)
    for j in range(size):
        total = total * _STEP + h[j:len(h) - size + 1 + j]
    total = (total ^ (total >> np.uint64(32))) * _MIX
    total = total ^ (total >> np.uint64(29))
    words = np.concatenate([[0], np.cumsum(kind == WORD)])
    return np.where(words[size:] - words[:-size] > plain * size, total, np.uint64(0))


def _literal_windows(literal: np.ndarray, size: int) -> np.ndarray:
    return windows(literal, np.zeros(len(literal), dtype=np.int8), size, 0.0)


def _slots(kind: np.ndarray, tokens: Tokens | Cuts, at: int, size: int) -> list[str]:
    return [f"{kind[i]}{tokens[i].lower()}" for i in range(at, at + size) if kind[i] != WORD]


def short_lines(templates: Templates, text: bytes, sizes: set[int]):
    """(size, place, hash) of the lines that have no more tokens than a short item: those items are whole lines or nothing."""
    _, _, literal, tokens = templates.readings(text)
    if isinstance(tokens, Cuts):  # no token but a break reaches over a line's end
        written = tokens.text if isinstance(tokens.text, bytes) else tokens.text.encode("utf-32-le")
        ends = np.flatnonzero(np.frombuffer(written, dtype=np.uint8 if written is tokens.text else np.uint32) == ord("\n"))
        places = np.concatenate([[0], np.searchsorted(tokens.start[tokens.places], ends), [len(literal)]])
        for i in np.flatnonzero(np.isin(np.diff(places), list(sizes))):
            at, size = int(places[i]), int(places[i + 1] - places[i])
            yield size, at, _literal_windows(literal[at:at + size], size)[0]
        return
    at = 0
    for line in text.split(b"\n"):
        literal = templates.readings(line)[2]
        if len(literal) in sizes:
            yield len(literal), at, _literal_windows(literal, len(literal))[0]
        at += len(literal)


_WINDOW = "size int, hash bigint, pos bigint, slots array<string>"


def _item_windows(items: DataFrame, rules: LeakRules) -> DataFrame:
    def make():
        templates = Templates()

        def step(batch):
            for number, text in zip(batch["item_id"].to_pylist(), texts(batch["text"])):
                plain, named, literal, tokens = templates.readings(text)
                size = min(rules.window, len(literal))
                if not size:
                    continue
                exact = _literal_windows(literal, size)
                found = windows(*plain, size, rules.plain) if size >= rules.shortest else np.zeros_like(exact)
                other = windows(*named, size, rules.plain) if named and size >= rules.shortest else found
                row = {"item_id": number, "item_sig": xxhash.xxh3_64_intdigest(text) - (1 << 63), "total": int((found != 0).sum()),
                       "whole": len(exact), "size": size}
                for hashes, kind, places in ((found, plain[1], found != 0), (other, named[1] if named else None, (other != found) & (other != 0)),
                                             (exact, None, (found == 0) | (other == 0))):
                    for at in np.flatnonzero(places):
                        yield {**row, "plain": bool(found[at]), "literal": hashes is exact, "hash": int(hashes[at].view(np.int64)),
                               "pos": int(at), "slots": [] if hashes is exact else _slots(kind, tokens, at, size)}
        return step
    return map_batches(items.select(F.col("item_id").cast("bigint"), F.col("text").cast("string")), make,
                       "item_id bigint, item_sig bigint, total bigint, whole bigint, plain boolean, literal boolean, " + _WINDOW)


def _doc_windows(docs: DataFrame, bitmap: np.ndarray, lengths: list[tuple[int, bool]], rules: LeakRules) -> DataFrame:
    def make():
        templates = Templates()

        def step(batch):
            for number, sig, text in zip(batch["doc_id"].to_pylist(), batch["sig"].to_pylist(), texts(batch["text"])):
                plain, named, exact, tokens = templates.readings(text)
                for size, literal in lengths:
                    if size < rules.shortest:
                        continue
                    if literal:
                        found = _literal_windows(exact, size)
                        read = [(found, None, True)]
                    else:
                        found = windows(*plain, size, rules.plain)
                        read = [(found, plain[1], found != 0)]
                        if named:
                            other = windows(*named, size, rules.plain)
                            read.append((other, named[1], (other != found) & (other != 0)))
                    for hashes, kind, places in read:
                        for at in np.flatnonzero(in_bitmap(bitmap, hashes) & places):
                            yield {"doc_id": number, "sig": sig, "size": size, "hash": int(hashes[at].view(np.int64)),
                                   "pos": int(at), "slots": [] if literal else _slots(kind, tokens, at, size)}
                for size, at, value in short_lines(templates, text, short) if short else ():
                    if in_bitmap(bitmap, np.array([value])).any():
                        yield {"doc_id": number, "sig": sig, "size": size, "hash": int(value.view(np.int64)), "pos": at, "slots": []}
        return step
    short = {size for size, _ in lengths if size < rules.shortest}
    rows = docs.select(F.col("doc_id").cast("bigint"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    return map_batches(rows.withColumn("sig", F.xxhash64("text")), make, "doc_id bigint, sig bigint, " + _WINDOW)


def leaks(docs: DataFrame, items: DataFrame, rules: LeakRules = DEFAULT) -> DataFrame:
    """(doc_id, sig, item_id, matched, total, share, first_word, last_word, changed) of every leaked item in a document.

    ``first_word`` and ``last_word`` are places among the document's tokens; ``changed`` tells that some slot value
    differs from the item's, in a consistent way.
    """
    index, _ = stored(_item_windows(items, rules).distinct(), "leak-index")
    lengths = sorted(tuple(r) for r in index.select("size", "literal").distinct().collect())  # at most 2 * window values
    bitmap = bitmap_of(index, "hash", rules.bits)
    found = _doc_windows(docs, bitmap, lengths, rules).alias("d").join(index.alias("i"), ["size", "hash"]).select(
        "doc_id", "sig", "size", "item_id", "item_sig", "total", "whole", "plain", (F.col("d.pos") - F.col("i.pos")).alias("diagonal"),
        F.col("d.pos").alias("pos"), F.col("i.pos").alias("item_pos"),
        F.zip_with("i.slots", "d.slots", lambda i, d: F.struct(i.alias("item"), d.alias("doc"))).alias("slots"))
    found, _ = stored(found, "leak-windows")
    pair = ["doc_id", "sig", "item_id", "item_sig", "diagonal"]
    values = found.select(*pair, F.explode("slots").alias("s")).groupBy(*pair, F.col("s.item").alias("item")) \
        .agg(F.min("s.doc").alias("low"), F.max("s.doc").alias("high"))
    one = F.col("low") == F.col("high")
    slots = values.groupBy(*pair).agg(F.collect_set(F.when(~one, F.col("item"))).alias("broken"),
                                      F.bool_or(one & (F.col("low") != F.col("item"))).alias("changed"))
    slots = slots.select(*[F.col(c).alias(f"s_{c}") for c in pair], "broken", "changed")
    # a null number is a number of its own
    same = [F.col(c).eqNullSafe(F.col(f"s_{c}")) for c in pair]
    holds = F.arrays_overlap(F.transform("slots", lambda s: s["item"]), "broken")
    matched = found.join(slots, same, "left").where(F.col("broken").isNull() | ~holds)

    def enough(n: str, of: str) -> Column:
        return (F.col(of) > 0) & (F.col(n) >= F.least(F.lit(rules.enough), F.ceil(F.col(of) * rules.share)))

    # enough of the windows with a template, or enough of all
    by_template = enough("with_plain", "total")
    return matched.groupBy(*pair[:4], "total", "whole").agg(
        F.count_distinct("item_pos").alias("matched"), F.count_distinct(F.when(F.col("plain"), F.col("item_pos"))).alias("with_plain"),
        F.min("pos").alias("first_word"),
        F.max(F.col("pos") + F.col("size") - 1).alias("last_word"),
        F.bool_or(F.coalesce("changed", F.lit(False))).alias("changed")) \
        .where(by_template | enough("matched", "whole")) \
        .withColumns({"matched": F.when(by_template, F.col("with_plain")).otherwise(F.col("matched")),
                      "total": F.when(by_template, F.col("total")).otherwise(F.col("whole"))}) \
        .select("doc_id", "sig", "item_id", "matched", "total", (F.col("matched") / F.col("total")).alias("share"),
                "first_word", "last_word", "changed").distinct()


def without_leaks(docs: DataFrame, items: DataFrame, rules: LeakRules = DEFAULT) -> DataFrame:
    """``docs`` without the documents that hold a leaked item, in the columns of ``docs``."""
    doc, sig = with_free_name(docs, "leak_doc"), with_free_name(docs, "leak_sig")
    gone = leaks(docs, items, rules).select(F.col("doc_id").alias(doc), F.col("sig").alias(sig)).distinct()
    gone, _ = stored(gone, "leak-documents")
    text = F.xxhash64(F.coalesce(docs["text"].cast("string"), F.lit("")))
    return docs.join(gone, docs["doc_id"].cast("bigint").eqNullSafe(F.col(doc)) & (text == F.col(sig)), "left_anti")
