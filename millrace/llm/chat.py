"""Chat formatting by token-level assembly.

Each turn becomes ``<|turn|>role<|says|>text<|end|>``. Role and text are encoded
apart, and the ids of the three control strings, which lie beyond the vocabulary, are
spliced in between; so no content can give a control id. In the formatted string
control strings inside a role or text are escaped: each one gets one backslash more
behind its first character, and reading back takes one away, which also holds for
texts that already contain escaped ones. The loss mask has +1 where the text of an
assistant turn begins and -1 where it ends; its prefix sums are the mask.

The turns of a conversation stay rows, each with the number of tokens and characters
before it, so a conversation of any length streams through a task.

Defined results: null role or text counts as empty; turns with the same number are
ordered by role and text and all stay; a null turn number comes first; a null conv_id
is a conversation of its own; an empty table gives an empty table; other columns are
left out.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bpe import VOCABULARY, codec, slices
from .common import text_or_empty

TURN, SAYS, END = "<|turn|>", "<|says|>", "<|end|>"
TRAINED_ROLES = ("assistant",)
#: Pre-tokens that a worker remembers; turns are few beside documents.
CACHE_LIMIT = 40_000

# Control strings of this and other templates, behind the first character.
_HEAD = r"([<\[])"
_TAIL = r"(\|(?:turn|says|end|endoftext|startoftext|im_start|im_end)\|>|/?s>|/?INST\])"
ESCAPE_PATTERN = rf"{_HEAD}(\\*){_TAIL}"
_ESCAPED = re.compile(rf"{_HEAD}\\(\\*){_TAIL}")

FORMATTED = "conv_id long, turn long, role string, formatted string, ids binary, loss_mask binary, token_start long, char_start long"
READ_BACK = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, n_tokens long"


def escape(text):
    """The column with every control string escaped."""
    return F.regexp_replace(text, ESCAPE_PATTERN, r"$1$2\\$3")


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1\2\3", text)


def reserved_ids(path: str = VOCABULARY) -> tuple[int, int, int]:
    """Ids of turn, says and end: the first three behind the vocabulary."""
    size = len(codec(path, CACHE_LIMIT).token_bytes)
    return size, size + 1, size + 2


def format_turns(conversations: DataFrame, path: str = VOCABULARY) -> DataFrame:
    """One row per turn, ordered within each conversation; see ``FORMATTED``.

    ``ids`` are packed little-endian unsigned 32-bit integers, ``loss_mask`` has a
    byte (0 or 1) for each id.
    """
    ordered = (
        conversations.select(
            F.col("conv_id").cast("long").alias("conv_id"),
            F.col("turn").cast("long").alias("turn"),
            text_or_empty("role").alias("role"),
            text_or_empty("text").alias("text"),
        )
        .repartition("conv_id")
        .sortWithinPartitions("conv_id", "turn", "role", "text")
        .select("conv_id", "turn", "role", escape(F.col("role")).alias("safe_role"), escape(F.col("text")).alias("safe_text"))
    )

    def run(batches):
        bpe = codec(path, CACHE_LIMIT)
        turn_id, says_id, end_id = reserved_ids(path)
        conv, tokens, chars = object(), 0, 0
        for whole in batches:
            for batch in slices(whole):
                convs, roles = batch.column("conv_id").to_pylist(), batch.column("role").to_pylist()
                safe_roles, safe_texts = batch.column("safe_role").to_pylist(), batch.column("safe_text").to_pylist()
                role_ids = bpe.encode_batch(safe_roles, specials=False)
                text_ids = bpe.encode_batch(safe_texts, specials=False)
                turn_b, says_b, end_b = (np.array([i], "<u4").tobytes() for i in (turn_id, says_id, end_id))
                packed = [turn_b + r + says_b + t + end_b for r, t in zip(role_ids, text_ids)]
                lengths = np.array([len(p) // 4 for p in packed], np.int64)
                ends = np.cumsum(lengths)
                # +1 at the first id of a trained text, -1 at its end mark; the sums are the mask
                steps = np.zeros(int(ends[-1]) if len(ends) else 0, np.int64)
                for k, (role, t) in enumerate(zip(roles, text_ids)):
                    if role in TRAINED_ROLES:
                        steps[ends[k] - 1 - len(t) // 4] += 1
                        steps[ends[k] - 1] -= 1
                mask = np.cumsum(steps).astype(np.uint8).tobytes()
                formatted = [f"{TURN}{r}{SAYS}{t}{END}" for r, t in zip(safe_roles, safe_texts)]
                token_start, char_start = [], []
                for c, n, f in zip(convs, lengths.tolist(), formatted):
                    if c != conv:
                        conv, tokens, chars = c, 0, 0
                    token_start.append(tokens)
                    char_start.append(chars)
                    tokens += n
                    chars += len(f)
                starts = (ends - lengths).tolist()
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("conv_id"),
                        batch.column("turn"),
                        batch.column("role"),
                        pa.array(formatted, pa.string()),
                        pa.array(packed, pa.binary()),
                        pa.array([mask[s:e] for s, e in zip(starts, ends.tolist())], pa.binary()),
                        pa.array(token_start, pa.int64()),
                        pa.array(char_start, pa.int64()),
                    ],
                    names=["conv_id", "turn", "role", "formatted", "ids", "loss_mask", "token_start", "char_start"],
                )

    return ordered.mapInArrow(run, FORMATTED)


def read_back(formatted: DataFrame, path: str = VOCABULARY, ordered: bool = True) -> DataFrame:
    """What the ids and masks of formatted turns say, one row per conversation.

    Roles and texts are decoded from the ids between the control ids; the loss text
    from the ids that the mask marks. ``ordered=False`` first brings the turns of a
    conversation together, for turns that were stored meanwhile.
    """
    if not ordered:
        formatted = formatted.repartition("conv_id").sortWithinPartitions("conv_id", "token_start")

    def run(batches):
        bpe = codec(path, CACHE_LIMIT)
        turn_id, says_id, end_id = reserved_ids(path)
        out: list[tuple] = []
        conv, state = object(), None

        def flush():
            if state is not None:
                out.append((conv, state["turns"], state["all"].hexdigest(), state["chars"], state["loss"].hexdigest(), state["formatted"], state["tokens"]))

        def batch_of(rows):
            cols = list(zip(*rows)) if rows else [[] for _ in range(7)]
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64()]
            names = [x.split()[0] for x in READ_BACK.split(", ")]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names=names)

        for whole in batches:
            for batch in slices(whole):
                for c, packed, mask, text in zip(*(batch.column(n).to_pylist() for n in ("conv_id", "ids", "loss_mask", "formatted"))):
                    if state is None or c != conv:
                        flush()
                        conv, state = c, {"turns": 0, "all": hashlib.sha256(), "chars": 0, "loss": hashlib.sha256(), "formatted": 0, "tokens": 0}
                    ids = np.frombuffer(packed, "<u4")
                    begin = np.flatnonzero(ids == turn_id)
                    says = np.flatnonzero(ids == says_id)
                    end = np.flatnonzero(ids == end_id)
                    for b, s, e in zip(begin, says, end):
                        role = unescape(bpe.decode(ids[b + 1 : s].tobytes()))
                        said = unescape(bpe.decode(ids[s + 1 : e].tobytes()))
                        state["turns"] += 1
                        state["all"].update(f"{role}\n{said}\n".encode())
                        marked = np.frombuffer(mask, np.uint8)[s + 1 : e] == 1
                        if marked.any():
                            trained = unescape(bpe.decode(ids[s + 1 : e][marked].tobytes()))
                            state["chars"] += len(trained)
                            state["loss"].update(trained.encode())
                    state["formatted"] += len(text)
                    state["tokens"] += len(ids)
                if out:
                    yield batch_of(out)
                    out.clear()
        flush()
        yield batch_of(out)

    return formatted.mapInArrow(run, READ_BACK)
