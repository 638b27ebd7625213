"""Conversations as token ids with a loss mask.

Every role and text is escaped and encoded as a segment of its own; reserved ids, which no encoding of text gives, are
spliced in between. A turn reads ``### role: text </turn>`` and a newline. The loss mask covers the texts of assistants:
+1 where such a segment starts and -1 where it ends, summed up along the conversation.

Texts may contain the control strings. A backslash goes before every backslash and every control string in them, so that
control strings are only found where the template put them, and dropping one level of backslashes gives the text back.
"""

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cardsentry.llm.common import batches, lists

RANKS = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# one id after the 50,256 ranks and the end-of-text id
RESERVED = {50257: "### ", 50258: ": ", 50259: " </turn>\n"}
START, MIDDLE, END = RESERVED  # in this order in every turn
CONTROL = re.compile(r"\\|###|</turn>|: ")
ESCAPED = re.compile(r"\\(\\|###|</turn>|: )")
PIECE = 50_000


def escape(text: str) -> str:
    return CONTROL.sub(lambda m: "\\" + m[0], text)


def unescape(text: str) -> str:
    return ESCAPED.sub(lambda m: m[1], text)


class Codec:
    """The encoding whose rank file was read on the driver."""

    def __init__(self, ranks: bytes):
        import base64

        import tiktoken
        from public_tokenizers import PATTERN

        table = {base64.b64decode(a): int(b) for a, b in (line.split() for line in ranks.splitlines() if line)}
        self.encoding = tiktoken.Encoding("text", pat_str=PATTERN, mergeable_ranks=table, special_tokens={})

    def encode(self, text: str) -> list[int]:
        """Long texts are encoded piece by piece: what decodes is the same, and time stays in proportion."""
        if len(text) <= PIECE:
            return self.encoding.encode_ordinary(text)
        pieces = (text[i : i + PIECE] for i in range(0, len(text), PIECE))
        return [t for p in pieces for t in self.encoding.encode_ordinary(p)]

    def bytes_of(self, ids: list[int]) -> bytes:
        return self.encoding.decode_bytes(ids)


def ranks_of(path: str = RANKS) -> bytes:
    with open(path, "rb") as f:
        return f.read()


def encode_turns(turns: DataFrame, ranks: bytes) -> DataFrame:
    """(conv_id, turn, nth, ids, loss_from, loss_to, offset): the ids of every turn, the part of them under the loss
    mask, and where the turn starts in its conversation. Rows of a conversation are taken by turn (nulls first), then by
    role and text; ``nth`` counts them."""
    shared = turns.sparkSession.sparkContext.broadcast(ranks)

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(shared.value)
        for part in batches(parts):
            ids, sizes, first, last = [], [], [], []
            for role, text in zip(part["role"].to_pylist(), part["text"].to_pylist(), strict=True):
                head = [START, *codec.encode(escape(role or "")), MIDDLE]
                body = codec.encode(escape(text or ""))
                ids += head
                ids += body
                ids.append(END)
                sizes.append(len(head) + len(body) + 1)
                first.append(len(head))
                last.append(len(head) + (len(body) if role == "assistant" else 0))
            yield pa.record_batch(
                [
                    part["conv_id"],
                    part["turn"],
                    part["place"],
                    lists(np.array(ids, np.int32), np.array(sizes), pa.int32()),
                    pa.array(first, pa.int32()),
                    pa.array(last, pa.int32()),
                ],
                ["conv_id", "turn", "place", "ids", "loss_from", "loss_to"],
            )

    # the order of equal turns, as a number that needs no text in the sort
    place = F.xxhash64(F.coalesce("role", F.lit("")), F.coalesce("text", F.lit("")))
    plain = turns.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", "text", place.alias("place"))
    encoded = plain.mapInArrow(
        run, "conv_id long, turn long, place long, ids array<int>, loss_from int, loss_to int"
    )
    along = Window.partitionBy("conv_id").orderBy("turn", "place")
    before = F.sum(F.size("ids")).over(along.rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.size("ids")
    return encoded.select(
        "conv_id", "turn", F.row_number().over(along).alias("nth"), "ids", "loss_from", "loss_to", before.alias("offset")
    )


def read_back(encoded: DataFrame, ranks: bytes) -> DataFrame:
    """One row per conversation, read from the ids alone: conv_id, n_turns, turns_sha256 (role, newline, text, newline
    per turn), loss_chars, loss_sha256 (text under the loss mask, unescaped), formatted_chars, n_tokens, loss_tokens.

    The rows of a conversation pass one by one in order, so a conversation of any length needs the memory of one turn.
    """
    shared = encoded.sparkSession.sparkContext.broadcast(ranks)
    schema = (
        "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, "
        "n_tokens long, loss_tokens long"
    )

    names = [c.split()[0] for c in schema.split(", ")]

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(shared.value)
        key, state = None, None  # no state: no conversation yet

        def ended() -> tuple:
            n, turns, loss_chars, loss, chars, tokens, loss_tokens = state
            return key, n, turns.hexdigest(), loss_chars, loss.hexdigest(), chars, tokens, loss_tokens

        def batch(rows: list[tuple]) -> pa.RecordBatch:
            kinds = [pa.string() if "sha256" in c else pa.int64() for c in names]
            columns = zip(*rows, strict=True)
            return pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

        for part in batches(parts):
            done = []
            for conv, ids, first, last, offset in zip(*(c.to_pylist() for c in part.columns), strict=True):
                if state is None or conv != key:
                    if state is not None:
                        done.append(ended())
                    key, state = conv, [0, hashlib.sha256(), 0, hashlib.sha256(), 0, 0, 0]
                # the mask of this turn: prefix sums of +1 at the start and -1 at the end of what is learned
                steps = np.zeros(len(ids) + 1, np.int8)
                steps[first] += 1
                steps[last] -= 1
                mask = np.cumsum(steps)[:-1].astype(bool)
                if offset != state[5]:
                    raise ValueError(f"conversation {key}: a turn starts at {offset}, not at {state[5]}")
                at = [ids.index(x) for x in RESERVED]
                role, text = (codec.bytes_of(ids[x + 1 : y]).decode() for x, y in zip(at, at[1:], strict=False))
                learned = unescape(codec.bytes_of([t for t, m in zip(ids, mask, strict=True) if m]).decode())
                state[0] += 1
                state[1].update(f"{unescape(role)}\n{unescape(text)}\n".encode())
                state[2] += len(learned)
                state[3].update(learned.encode())
                state[4] += len(role) + len(text) + sum(map(len, RESERVED.values()))
                state[5] += len(ids)
                state[6] += int(mask.sum())
            if done:
                yield batch(done)
        if state is not None:
            yield batch([ended()])

    in_order = encoded.repartition("conv_id").sortWithinPartitions("conv_id", "nth")
    return in_order.select("conv_id", "ids", "loss_from", "loss_to", "offset").mapInArrow(run, schema)


def format_conversations(turns: DataFrame, path: str = RANKS) -> tuple[DataFrame, DataFrame]:
    """(encoded turns, what they read back as) of ``turns(conv_id, turn, role, text)``.

    Null texts and roles count as empty, null conv_ids as one conversation, repeated rows as turns of their own. Only the
    role ``assistant`` is learned. An empty table gives empty ones; other columns are ignored.
    """
    ranks = ranks_of(path)
    encoded = encode_turns(turns, ranks)
    return encoded, read_back(encoded, ranks)
