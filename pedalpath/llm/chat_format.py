"""Chat formatting with loss masks that follow character offsets.

A conversation is rendered as a whole, encoded once with offsets, and the sorted spans of the turns meet the sorted
spans of the tokens by binary search: a token trains if it lies within an assistant's text.

Template: ``<|im_start|>role<|im_sep|>text<|im_end|>`` for each turn, with nothing between. The three marks are tokens of their
own, so no token reaches over the edge of a text. Inside roles and texts, ``<`` + backslashes + ``|`` gets one more
backslash, so that no mark and no special token of the vocabulary can be written there; reading back takes it away.

Rows are dealt out by conversation and read in order of their turns, as a stream: one rendered part is held at a time. A part
is a conversation, or so many whole turns of it as have ``part_chars`` characters.

Defined results for odd input: null texts and roles are empty; a null turn comes first; rows with the same turn stand in
the order of role and text, repeated rows count each; a conversation without assistant has no loss; a null conv_id is a
conversation; texts of any length are encoded whole; an empty table gives an empty one; other columns are not read.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ..session import ship_package

START, SEP, END = "<|im_start|>", "<|im_sep|>", "<|im_end|>"
_PLAIN, _ESCAPED = re.compile(r"<(\\*)\|"), re.compile(r"<\\(\\*)\|")


@dataclass(frozen=True)
class ChatFormat:
    tokenizer: str = "/opt/tokenizers/byte_bpe_50k.json"
    trained: str = "assistant"
    part_chars: int = 400_000
    #: rows of one output batch
    batch: int = 200


DEFAULT = ChatFormat()


def escape(text: str) -> str:
    return _PLAIN.sub(r"<\\\1|", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"<\1|", text)


def load(fmt: ChatFormat):
    """The vocabulary with the three marks behind its last id."""
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import AddedToken, Tokenizer
    tokenizer = Tokenizer.from_file(fmt.tokenizer)
    tokenizer.add_special_tokens([AddedToken(x, normalized=False, special=True) for x in (START, SEP, END)])
    return tokenizer


def render(turns: list[tuple[str, str]], fmt: ChatFormat) -> tuple[str, list[tuple[int, int]]]:
    """The text of a part, and the spans in it that train."""
    pieces, spans, at = [], [], 0
    for role, text in turns:
        head, body = f"{START}{escape(role)}{SEP}", escape(text)
        begin = at + len(head)
        if role == fmt.trained and body:
            spans.append((begin, begin + len(body)))
        pieces += [head, body, END]
        at = begin + len(body) + len(END)
    return "".join(pieces), spans


def loss_mask(offsets: np.ndarray, spans: list[tuple[int, int]]) -> np.ndarray:
    """Which tokens lie in a span; ``spans`` and the starts in ``offsets`` rise."""
    if not spans or not len(offsets):
        return np.zeros(len(offsets), dtype=bool)
    bounds = np.array(spans, dtype=np.int64)
    near = np.searchsorted(bounds[:, 0], offsets[:, 0], side="right") - 1
    return (near >= 0) & (offsets[:, 1] <= bounds[np.maximum(near, 0), 1])


FORMATTED = "conv_id bigint, part int, n_turns int, n_chars bigint, input_ids array<int>, loss_mask array<boolean>"


def _conversations(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[bool, int | None, str, str]]:
    """(whether a conversation begins, its number, role, text) of rows in order."""
    last: object = _conversations
    for batch in batches:
        for conv, role, text in zip(batch["conv_id"].to_pylist(), batch["role"].to_pylist(), batch["text"].to_pylist()):
            yield conv != last, conv, role or "", text or ""
            last = conv


def format_conversations(rows: DataFrame, fmt: ChatFormat = DEFAULT) -> DataFrame:
    """Parts of conversations, in order within their partition: ids, and the mask of the tokens that train."""
    ship_package(rows.sparkSession)
    rows = rows.select(F.col("conv_id").cast("bigint"), F.col("turn").cast("bigint"), F.col("role").cast("string"), F.col("text").cast("string"))
    ordered = rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")

    def run(batches):
        tokenizer = load(fmt)

        def encode(conv, part, turns):
            text, spans = render(turns, fmt)
            found = tokenizer.encode(text, add_special_tokens=False)
            offsets = np.array(found.offsets, dtype=np.int64).reshape(-1, 2)
            return conv, part, len(turns), len(text), np.array(found.ids, dtype=np.int32), loss_mask(offsets, spans)

        def parts():
            turns, size, part, now = [], 0, 0, None
            for fresh, conv, role, text in _conversations(batches):
                if turns and (fresh or size >= fmt.part_chars):
                    yield encode(now, part, turns)
                    turns, size, part = [], 0, 0 if fresh else part + 1
                now = conv
                turns.append((role, text))
                size += len(text)
            if turns:
                yield encode(now, part, turns)

        held, size = [], 0
        for row in parts():
            held.append(row)
            size += len(row[4])
            if len(held) >= fmt.batch or size > 1_000_000:
                yield _batch(held)
                held, size = [], 0
        if held:
            yield _batch(held)

    return ordered.mapInArrow(run, FORMATTED)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    conv, part, turns, chars, ids, masks = zip(*rows)
    ends = pa.array(np.cumsum([0, *map(len, ids)], dtype=np.int32))
    return pa.RecordBatch.from_arrays(
        [pa.array(conv, pa.int64()), pa.array(part, pa.int32()), pa.array(turns, pa.int32()), pa.array(chars, pa.int64()),
         pa.ListArray.from_arrays(ends, pa.array(np.concatenate(ids))), pa.ListArray.from_arrays(ends, pa.array(np.concatenate(masks)))],
        names=["conv_id", "part", "n_turns", "n_chars", "input_ids", "loss_mask"])


def read_back(ids: np.ndarray, mask: np.ndarray, tokenizer) -> tuple[list[tuple[str, str]], list[str]]:
    """Turns, and the texts under the mask, from a part's tokens alone."""
    start, sep, end = (tokenizer.token_to_id(x) for x in (START, SEP, END))
    text = lambda a, b: unescape(tokenizer.decode(ids[a:b].tolist(), skip_special_tokens=False)) if b > a else ""
    turns = [(text(a + 1, b), text(b + 1, c)) for a, b, c in zip(np.flatnonzero(ids == start), np.flatnonzero(ids == sep), np.flatnonzero(ids == end))]
    edges = np.flatnonzero(np.diff(np.concatenate([[0], mask.astype(np.int8), [0]])))
    return turns, [text(a, b) for a, b in zip(edges[::2], edges[1::2])]


DIGEST = "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint, n_tokens bigint, n_loss_tokens bigint"


def digests(formatted: DataFrame, fmt: ChatFormat = DEFAULT) -> DataFrame:
    """One row per conversation, read back from the tokens of ``format_conversations``."""
    ordered = formatted.repartition("conv_id").sortWithinPartitions("conv_id", "part")

    def run(batches):
        tokenizer = load(fmt)

        def rows():
            state = None
            for batch in batches:
                for conv, chars, ids, mask in zip(batch["conv_id"].to_pylist(), batch["n_chars"].to_pylist(), batch["input_ids"], batch["loss_mask"]):
                    if state is None or state["conv_id"] != conv:
                        if state:
                            yield state
                        state = {"conv_id": conv, "n_turns": 0, "loss_chars": 0, "formatted_chars": 0, "n_tokens": 0, "n_loss_tokens": 0,
                                 "turns": hashlib.sha256(), "loss": hashlib.sha256()}
                    ids, mask = ids.values.to_numpy(), mask.values.to_numpy(zero_copy_only=False)
                    turns, loss = read_back(ids, mask, tokenizer)
                    for role, text in turns:
                        state["turns"].update(f"{role}\n{text}\n".encode())
                    for text in loss:
                        state["loss"].update(text.encode())
                        state["loss_chars"] += len(text)
                    state["n_turns"] += len(turns)
                    state["formatted_chars"] += chars
                    state["n_tokens"] += len(ids)
                    state["n_loss_tokens"] += int(mask.sum())
            if state:
                yield state

        names = [x.split()[0] for x in DIGEST.split(", ")]
        schema = pa.schema([(n, pa.string() if "sha" in n else pa.int64()) for n in names])
        held = []
        for state in rows():
            state["turns_sha256"], state["loss_sha256"] = state.pop("turns").hexdigest(), state.pop("loss").hexdigest()
            held.append({k: state[k] for k in names})
            if len(held) >= 5_000:
                yield pa.RecordBatch.from_pylist(held, schema)
                held = []
        if held:
            yield pa.RecordBatch.from_pylist(held, schema)

    return ordered.mapInArrow(run, DIGEST)
