"""Secret scan: fixed patterns, and a linear-chain conditional random field that tags what they miss.

Tokens are runs of letters, digits, ``+/_-`` and characters beyond ASCII; a token is tagged B (a secret begins), I (it goes on)
or O. The score of a tag is a sum of weights of features of the token and its place:

* shape: length and kinds of characters, share of digits, changes between kinds, its first four bytes;
* neighbours: the words before and after, their shapes, and what stands in the gaps (quotes, ``=``, a line's end);
* the file: shares of tokens with digits, of gaps with ``=`` or ``:`` and of long tokens.

To this come the weights of a tag after another. The best sequence of tags of a whole text is found by Viterbi, exactly:
tokens are cut into tiles, each tile's best scores from any tag to any tag are computed for all tiles at once, the tiles
are chained, and the tags read back. A run of B I I ... is a span. Spans that meet one of the patterns are not repeated.

Training. ``max_docs`` documents, those with the smallest hashes, and at most ``max_bytes`` of each, give the sample. The patterns'
matches are its labels. As they know few forms, seeded made-up secrets of other forms are put between its words, with
decoys (addresses, paths, numbers, dates) that are labelled O. Weights maximise the conditional likelihood by forward-backward
and Adagrad, in windows of tokens. Rerun on the same table, it learns the same weights.

Every text is read whole. Working memory follows ``block`` tokens, and about 100 bytes a token of the text at hand.

Defined results for odd input: a null or empty text has no span; a run of over 4,096 token bytes is several tokens; places
count code points; repeated rows are scanned each, and a row without a number like any other; an empty table gives an
empty one; a corpus without a match still trains on the made-up secrets. Columns but ``doc_id`` and ``text`` are not read.
"""

from __future__ import annotations

import hashlib
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ..session import ship_package
from .common import LOWER, texts

KINDS = ("assign", "access", "hex", "crf")
# Base patterns (fixed values). The first one runs over the text with A-Z lower-cased.
ASSIGN = re.compile(rb"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([a-z0-9+/_.=-]+)""")
ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
HEX = re.compile(rb"[0-9a-f]{16,}")
LEAST_VALUE, LEAST_ACCESS = 12, 18


@dataclass(frozen=True)
class ScanRules:
    #: bounds of the sample that the weights are learned from
    max_docs: int = 2_000
    max_bytes: int = 8_000
    seed: int = 7
    epochs: int = 6
    #: tokens of a training window, and of a tile of Viterbi
    window: int = 32
    tile: int = 64
    #: tokens whose bytes are looked at at once; texts shorter than that are scanned together
    block: int = 200_000


DEFAULT = ScanRules()


# --- patterns

def base_spans(text: bytes) -> list[tuple[int, int, int, int]]:
    """(start, kind, end, start of the value) of every pattern's matches, in bytes, by start and kind."""
    found = [(m.start(), 0, m.end(), m.start(2)) for m in ASSIGN.finditer(text.translate(LOWER))
             if m.end(2) - m.start(2) >= LEAST_VALUE]
    found += [(m.start(), 1, m.end(), m.start()) for m in ACCESS.finditer(text) if m.end() - m.start() >= LEAST_ACCESS]
    found += [(m.start(), 2, m.end(), m.start()) for m in HEX.finditer(text)]
    return sorted(found)


# --- tokens and features

LOWERS, UPPERS, DIGITS, SIGNS, WIDE = 1, 2, 4, 8, 16
LINE, GIVES, QUOTE, DOT, BLANK, OTHER = 1, 2, 4, 8, 16, 32
LONGEST = 4096


def _bits() -> tuple[np.ndarray, np.ndarray]:
    """Per byte: whether it belongs to a token, and its kind."""
    kind, inside = np.full(256, OTHER, dtype=np.uint8), np.zeros(256, dtype=bool)
    for signs, bit in ((b"\n\r", LINE), (b"=:", GIVES), (b"\"'`", QUOTE), (b".", DOT), (b" \t", BLANK)):
        kind[list(signs)] = bit
    for signs, bit in ((range(97, 123), LOWERS), (range(65, 91), UPPERS), (range(48, 58), DIGITS), (b"+/_-", SIGNS),
                       (range(128, 255), WIDE)):
        kind[list(signs)], inside[list(signs)] = bit, True
    return inside, kind


INSIDE, KIND = _bits()
LENGTHS = np.array([4, 8, 12, 16, 20, 32, 40, 64])
SHAPES = 9 * 32
#: sizes of the feature tables, in the order of ``features``
TABLES = (SHAPES, SHAPES, SHAPES, 60, 128, 128, 1 << 14, 1 << 14, 1 << 13, 1 << 13, 128)
OFFSETS = np.concatenate([[0], np.cumsum(TABLES)])
BETWEEN = b"\xff\n"  # between texts; the byte occurs in no UTF-8 text
_STEP = np.uint64(0x9E3779B97F4A7C15)


def tokens(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the tokens."""
    inside = INSIDE[data]
    edges = np.flatnonzero(np.diff(inside, prepend=False, append=False))
    starts, ends = edges[::2], edges[1::2]
    if len(starts) and (ends - starts).max() > LONGEST:
        cuts = [np.arange(s, e, LONGEST) for s, e in zip(starts, ends)]
        starts = np.concatenate(cuts)
        ends = np.minimum(starts + LONGEST, np.repeat(ends, [len(c) for c in cuts]))
    return starts, ends


def _head(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, n: int) -> np.ndarray:
    """The first ``n`` (at most 8) bytes of each token as a number."""
    out = np.zeros(len(starts), dtype=np.uint64)
    for k in range(n):
        at = starts + k
        out |= np.where(at < ends, data[np.minimum(at, len(data) - 1)], 0).astype(np.uint64) << np.uint64(8 * k)
    return out


def _bucket(value: np.ndarray, bits: int) -> np.ndarray:
    return ((value * _STEP) >> np.uint64(64 - bits)).astype(np.int64)


def _shifted(values: np.ndarray, step: int, first: np.ndarray) -> np.ndarray:
    """The value of the token ``step`` before (after, if negative) in the same text, else 0. ``first``: the text's number."""
    out = np.zeros_like(values)
    if step > 0:
        same = first[step:] == first[:-step]
        out[step:] = np.where(same, values[:-step], 0)
    else:
        same = first[:step] == first[-step:]
        out[:step] = np.where(same, values[-step:], 0)
    return out


def features(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, text: np.ndarray, block: int) -> np.ndarray:
    """(tokens, templates): rows of the weight table. ``text`` numbers each token's text, from 0 on."""
    n = len(starts)
    kinds, after, digits, turns = (np.empty(n, dtype=np.int32) for _ in range(4))
    word, start4 = np.empty(n, dtype=np.uint64), np.empty(n, dtype=np.uint64)
    folded = np.frombuffer(LOWER, dtype=np.uint8)
    for low in range(0, n, block):
        high = min(low + block, n)
        s, e = starts[low:high], ends[low:high]
        begin, end = s[0], (starts[high] if high < n else len(data))
        part = data[begin:end]
        kind = KIND[part]
        # token, gap, token, gap ...; a gap of no bytes stands between the parts of a cut token
        edges = np.empty(2 * len(s), dtype=np.int64)
        edges[::2], edges[1::2] = s - begin, e - begin
        whole = np.append(kind, 0).astype(np.uint8)
        either = np.bitwise_or.reduceat(whole, edges)
        gap = np.where(edges[1::2] < np.append(edges[2::2], len(kind)), either[1::2], 0)
        kinds[low:high], after[low:high] = either[::2], gap & 63
        digits[low:high] = np.add.reduceat((whole == DIGITS).astype(np.int32), edges)[::2]
        change = np.empty(len(whole), dtype=np.int32)
        change[0], change[1:] = 0, whole[1:] != whole[:-1]
        turns[low:high] = np.add.reduceat(change, edges)[::2] - change[edges[::2]]
        word[low:high] = _head(folded[part], s - begin, e - begin, 8)
        start4[low:high] = _head(part, s - begin, e - begin, 4)
    length = ends - starts
    size = np.searchsorted(LENGTHS, length, side="right")
    kinds &= 31
    shape = size * 32 + kinds
    share = np.where(digits == 0, 0, np.where(digits == length, 5, 1 + np.minimum(3, 4 * digits // length)))
    turned = np.searchsorted([1, 2, 4, 8], turns, side="right")
    long, some = (length >= 12).astype(np.int64), (length >= 8).astype(np.uint64)
    word = word + length.astype(np.uint64) * np.uint64(0x100000001B3)
    before = _shifted(after, 1, text)
    # the file: three shares, in quarters of what is usual at most
    count = np.maximum(np.bincount(text, minlength=1), 1)
    level = lambda hits, most: np.minimum(3, (4 * np.bincount(text, weights=hits) / (count * most)).astype(np.int64))
    file = level((kinds & DIGITS) > 0, 0.2) * 16 + level((after & GIVES) > 0, 0.2) * 4 + level(long, 0.1)
    columns = (
        shape, _shifted(shape, 1, text), _shifted(shape, -1, text), (share * 5 + turned) * 2 + long, before * 2 + long, after * 2 + long,
        _bucket(_shifted(word, 1, text) * np.uint64(2) + some, 14), _bucket(_shifted(word, 2, text) * np.uint64(2) + some, 14),
        _bucket(_shifted(word, -1, text) * np.uint64(2) + some, 13), _bucket(start4 * np.uint64(2) + long.astype(np.uint64), 13),
        file[text] * 2 + ((kinds & DIGITS) > 0) * long)
    return np.stack([c.astype(np.int32) + o for c, o in zip(columns, OFFSETS)], axis=1).astype(np.int32)


# --- the model

@dataclass(frozen=True)
class Field:
    """Weights of a tag (B, I, O) by feature, of a tag after another, and of a text's first tag."""

    weights: np.ndarray
    after: np.ndarray
    first: np.ndarray

    def scores(self, rows: np.ndarray) -> np.ndarray:
        out = np.zeros((len(rows), 3), dtype=np.float32)
        for k in range(rows.shape[1]):
            out += self.weights[rows[:, k]]
        return out


B, I, O = 0, 1, 2


def viterbi(scores: np.ndarray, opens: np.ndarray, field: Field, tile: int = 64) -> np.ndarray:
    """The best tags of a row of texts; ``opens`` marks each text's first token, where the tag before does not count."""
    n = len(scores)
    if not n:
        return np.empty(0, dtype=np.int8)
    tiles = -(-n // tile)
    score = np.zeros((tiles * tile, 3), dtype=np.float32)
    score[:n] = scores
    fresh = np.ones(tiles * tile, dtype=bool)  # what fills the last tile is a text of its own
    fresh[:n] = opens
    fresh[0] = True
    # tiles stand last, so that every step is a few additions of long rows
    score = np.ascontiguousarray(score.reshape(tiles, tile, 3).transpose(1, 2, 0))
    fresh = np.ascontiguousarray(fresh.reshape(tiles, tile).T)
    step = lambda w: np.where(fresh[w], field.first[None, :, None], field.after[:, :, None])
    # from any tag before a tile to any tag at its end
    through = step(0) + score[0][None]
    for w in range(1, tile):
        on = step(w)
        through = np.maximum(np.maximum(through[:, 0, None] + on[0], through[:, 1, None] + on[1]), through[:, 2, None] + on[2]) + score[w]
    before, now = np.empty((3, tiles), dtype=np.float32), [0.0, 0.0, 0.0]
    by_tile = through.transpose(2, 0, 1).tolist()
    for t, (b, i, o) in enumerate(by_tile):
        before[:, t] = now
        now = [max(now[0] + b[y], now[1] + i[y], now[2] + o[y]) for y in range(3)]
        top = max(now)
        now = [x - top for x in now]
    back = np.empty((tile, 3, tiles), dtype=np.int8)
    best = before
    for w in range(tile):
        on = step(w)
        option = best[0] + on[0], best[1] + on[1], best[2] + on[2]
        better = np.maximum(option[0], option[1])
        back[w] = np.where(option[2] > better, 2, option[1] > option[0])
        best = np.maximum(better, option[2]) + score[w]
    # the tags that lead to each last tag of a tile
    tags, at = np.empty((tile, 3, tiles), dtype=np.int8), np.repeat(np.arange(3, dtype=np.int8)[:, None], tiles, axis=1)
    for w in range(tile - 1, -1, -1):
        tags[w] = at
        at = np.where(at == 0, back[w, 0], np.where(at == 1, back[w, 1], back[w, 2]))
    last, entry = np.empty(tiles, dtype=np.int64), at.T.tolist()
    last[-1] = tag = int(best[:, -1].argmax())
    for t in range(tiles - 1, 0, -1):
        last[t - 1] = tag = entry[t][tag]
    return np.take_along_axis(tags, last[None, None, :], 1)[:, 0].T.reshape(-1)[:n]


def _log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis, keepdims=True)
    return np.log(np.exp(x - top).sum(axis)) + top.squeeze(axis)


def fit(rows: np.ndarray, tags: np.ndarray, mask: np.ndarray, rules: ScanRules = DEFAULT) -> Field:
    """Weights from windows: features (windows, tokens, templates), tags and mask (windows, tokens)."""
    weights = np.zeros((OFFSETS[-1], 3))
    after, first = np.zeros((3, 3)), np.zeros(3)
    sums = [np.full(x.shape, 1e-2) for x in (weights, after, first)]
    draw = np.random.default_rng(rules.seed)
    n, size, _ = rows.shape
    hot = np.eye(3)[tags] * mask[:, :, None]
    for _ in range(rules.epochs):
        for chosen in np.array_split(draw.permutation(n), max(1, n // 128)):
            r, m, y = rows[chosen], mask[chosen], hot[chosen]
            e = weights[r].sum(2)
            alpha, beta = np.empty(e.shape), np.zeros(e.shape)
            alpha[:, 0] = first + e[:, 0]
            for t in range(1, size):
                on = _log_sum(alpha[:, t - 1, :, None] + after, 1) + e[:, t]
                alpha[:, t] = np.where(m[:, t, None], on, alpha[:, t - 1])
            for t in range(size - 2, -1, -1):
                on = _log_sum(after + (e[:, t + 1] + beta[:, t + 1])[:, None, :], 2)
                beta[:, t] = np.where(m[:, t + 1, None], on, 0.0)
            total = _log_sum(alpha[:, -1], 1)
            single = np.exp(alpha + beta - total[:, None, None]) * m[:, :, None]
            pair = np.exp(alpha[:, :-1, :, None] + after + (e + beta)[:, 1:, None, :] - total[:, None, None, None]) * m[:, 1:, None, None]
            gap = (y - single) / len(chosen)
            steps = (np.einsum("nti,ntj->ij", y[:, :-1], y[:, 1:]) - pair.sum((0, 1))) / len(chosen)
            grow = np.zeros_like(weights)
            flat = r.reshape(-1)
            for tag in range(3):
                grow[:, tag] = np.bincount(flat, weights=np.repeat(gap[:, :, tag].reshape(-1), r.shape[2]), minlength=len(weights))
            for value, slope, seen in zip((weights, after, first), (grow - 1e-5 * weights, steps, gap[:, 0].sum(0)), sums):
                seen += slope * slope
                value += 0.2 * slope / np.sqrt(seen)
    return Field(weights.astype(np.float32), after.astype(np.float32), first.astype(np.float32))


# --- the training sample

_ALNUM = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
# Words before a value and heads of values (fixed values, in use with public services).
_NAMES = ("pwd", "pass", "passphrase", "auth", "bearer", "access_key", "client_secret", "private_key", "credential", "key", "token", "password")
_STARTS = ("", "", "", "ghp_", "sk_live_", "xoxb-", "AIza", "glpat-", "eyJ")


def made_up(draw: np.random.Generator) -> tuple[bytes, int]:
    """A secret in some form, or a decoy, and where its value starts (-1: a decoy)."""
    pick = lambda options: options[int(draw.integers(len(options)))]
    run = lambda signs, n: "".join(pick(signs) for _ in range(n))
    kind = int(draw.integers(10))
    if kind < 5:
        value = pick(_STARTS) + run(pick((_ALNUM, _ALNUM + "+/", _ALNUM[26:], "0123456789abcdef", _ALNUM[:26] + _ALNUM[52:])), int(draw.integers(16, 48)))
        lead = pick(("", pick(_NAMES) + pick(("=", ": ", " = ", "=\"", "='", ": \"", " ")))) if kind else ""
        return (lead + value).encode(), len(lead)
    number = lambda n: run("0123456789", n)
    word = lambda: run("aeioubdlmnrst", int(draw.integers(3, 11)))
    decoy = (f"{word()}.{number(2)}@{word()}{number(1)}.example.com", f"https://{word()}.org/{word()}/{word()}-{word()}?{word()}={number(3)}",
             f"20{number(2)}-0{number(1)}-1{number(1)}T0{number(1)}:1{number(1)}", f"+{number(2)} {number(3)}-{number(7)}",
             f"{word()}_{word()}_{word()}", f"{number(3)}.{number(2)}.{number(2)}.{number(1)}", f"/{word()}/{word()}/{word()}.txt",
             f"{word().title()}{word().title()}{word().title()}", f"{word()}={number(4)}", f"{word()}: {word()}{word()}{word()}")
    return pick(decoy).encode(), -1


def _sampled(docs: DataFrame, rules: ScanRules) -> list[bytes]:
    """The sample, in an order that depends on its rows only."""
    place = F.xxhash64(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(rules.seed))
    placed = docs.where("text <> ''").select(place.alias("place"), "text")
    last = placed.select("place").orderBy("place").limit(rules.max_docs).agg(F.max("place")).first()[0]
    if last is None:
        return []
    rows = placed.where(F.col("place") <= F.lit(last)).select("place", F.substring("text", 1, rules.max_bytes).alias("text"))
    # equal numbers share a place: a bound on rows even so
    return [r["text"].encode() for r in rows.orderBy("place", "text").limit(rules.max_docs).collect()]


def _training(sample: list[bytes], rules: ScanRules) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    draw = np.random.default_rng(rules.seed)
    parts, spans, at = [], [], 0
    # without texts, words of the decoys' kind stand around the made-up secrets
    for text in sample or [b"the quick brown fox jumps over the lazy dog. " * 8] * 200:
        text = text[:rules.max_bytes]
        cuts = [0, *sorted(int(x) for x in draw.integers(0, len(text) + 1, int(draw.integers(0, 4)))), len(text)]
        whole, planted = b"", []
        for low, high in zip(cuts, cuts[1:]):
            whole += text[low:high]
            if high < len(text):
                more, start = made_up(draw)
                whole += b" "
                if start >= 0:
                    planted.append((len(whole) + start, len(whole) + len(more)))
                whole += more + b" "
        spans += [(at + s, at + e) for s, e in [(v, e) for _, _, e, v in base_spans(whole)] + planted]
        parts.append(whole)
        at += len(whole) + len(BETWEEN)
    data = np.frombuffer(BETWEEN.join(parts), dtype=np.uint8)
    ends_of = np.cumsum([len(p) + len(BETWEEN) for p in parts])
    starts, ends = tokens(data)
    text = np.searchsorted(ends_of, starts, side="right")
    rows = features(data, starts, ends, text, rules.block)
    tags = np.full(len(starts), O, dtype=np.int64)
    for low, high in sorted(spans):
        hit = np.arange(np.searchsorted(ends, low, side="right"), np.searchsorted(starts, high, side="left"))
        # a token counts if most of it lies in the span
        hit = hit[2 * (np.minimum(ends[hit], high) - np.maximum(starts[hit], low)) >= ends[hit] - starts[hit]]
        tags[hit] = I
        tags[hit[:1]] = B
    # windows do not cross texts; of those without a long or digit-bearing token, one in eight is enough
    order, size = np.flatnonzero(np.diff(text, prepend=-1)), rules.window
    begins = np.concatenate([np.arange(a, b, size) for a, b in zip(order, [*order[1:], len(text)])]) if len(order) else np.empty(0, int)
    stops = np.minimum(begins + size, np.append(order[1:], len(text))[np.searchsorted(order, begins, side="right") - 1]) if len(order) else begins
    odd = np.concatenate([[0], np.cumsum((ends - starts >= 12) | (tags != O) | (rows[:, 3] - OFFSETS[3] >= 10))])
    keep = (odd[stops] > odd[begins]) | (np.arange(len(begins)) % 8 == 0)
    begins, stops = begins[keep], stops[keep]
    index = np.minimum(begins[:, None] + np.arange(size), len(starts) - 1)
    return rows[index], tags[index], begins[:, None] + np.arange(size) < stops[:, None]


def train(docs: DataFrame, rules: ScanRules = DEFAULT) -> Field:
    return fit(*_training(_sampled(docs, rules), rules), rules)


# --- the scan

_INNER = bytes(range(0x80, 0xC0))


def _points(text: bytes, places: list[int]) -> dict[int, int]:
    """Code points before each of the byte places."""
    out, at, n = {}, 0, 0
    for place in sorted(set(places)):
        part = text[at:place]
        n += len(part.translate(None, _INNER))
        out[place], at = n, place
    return out


def tagged_spans(held: list[bytes], field: Field, rules: ScanRules = DEFAULT) -> list[list[tuple[int, int]]]:
    """(start, end) in bytes of every B I* run, for each text."""
    data = np.frombuffer(BETWEEN.join(held), dtype=np.uint8)
    sizes = np.cumsum([len(t) + len(BETWEEN) for t in held])
    starts, ends = tokens(data)
    out: list[list[tuple[int, int]]] = [[] for _ in held]
    if not len(starts):
        return out
    text = np.searchsorted(sizes, starts, side="right")
    scores = np.empty((len(starts), 3), dtype=np.float32)
    rows = features(data, starts, ends, text, rules.block)
    for low in range(0, len(starts), rules.block):
        scores[low:low + rules.block] = field.scores(rows[low:low + rules.block])
    opens = np.diff(text, prepend=-1) > 0
    tags = viterbi(scores, opens, field, rules.tile)
    inside = tags != O
    begin = inside & ((tags == B) | opens | ~np.concatenate([[False], inside[:-1]]))
    at = np.flatnonzero(begin)
    for i, k in enumerate(at):
        last = k
        while last + 1 < len(tags) and inside[last + 1] and not begin[last + 1]:
            last += 1
        base = sizes[text[k]] - len(held[text[k]]) - len(BETWEEN)
        out[text[k]].append((int(starts[k] - base), int(ends[last] - base)))
    return out


def _row(text: bytes, found: list[tuple[int, int]]) -> tuple:
    base = [(s, kind, e) for s, kind, e, _ in base_spans(text)]
    more = [(s, 3, e) for s, e in found if not any(s < y and x < e for x, _, y in base)]
    place = _points(text, [p for s, _, e in base + more for p in (s, e)]) if base or more else {}
    joined = lambda spans: ",".join(f"{KINDS[k]}:{place[s]}:{place[e]}" for s, k, e in sorted(spans))
    counts = [sum(k == kind for _, k, _ in base) for kind in range(3)]
    return (*counts, hashlib.sha256(joined(base).encode()).hexdigest(), joined(base + more), len(more))


def scan(docs: DataFrame, field: Field, rules: ScanRules = DEFAULT) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_crf of every row."""
    ship_package(docs.sparkSession)
    names = ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_crf"]
    kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.int64()]

    def run(batches):
        for batch in batches:
            ids, held, numbers, size = batch["doc_id"].to_pylist(), [], [], 0
            for doc, text in zip(ids, texts(batch["text"])):
                held.append(text)
                numbers.append(doc)
                size += len(text)
                if size >= 5 * rules.block:
                    yield table(numbers, held)
                    held, numbers, size = [], [], 0
            if held:
                yield table(numbers, held)

    def table(numbers, held):
        rows = [_row(t, f) for t, f in zip(held, tagged_spans(held, field, rules))]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip([numbers, *zip(*rows)], kinds)], names=names)

    return docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string")).mapInArrow(
        run, "doc_id bigint, n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string, spans string, n_crf bigint")
