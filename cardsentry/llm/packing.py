"""Documents packed into sequences of a fixed length by the sum-of-squares rule.

Let N(g) be the number of open sequences with a gap of g tokens. A piece of s tokens goes where the sum of N(g)^2 over all
gaps becomes smallest: from a gap g >= s to the gap g - s that changes it by 2 (N(g - s) - N(g)) + 2, or into a new
sequence. Full sequences and unopened ones don't count. Gaps of all sizes stay rare that way, so that later pieces fill
them; long pieces are placed first.

1. Texts are encoded once. Every document becomes pieces, only documents longer than a sequence more than one; the pieces
   are stored with a number of their own.
2. The rule needs nothing but numbers and lengths. These are dealt at random to shards of a bounded number of pieces, and
   each shard is packed by one task. A piece as long as a sequence is one without any packing. The rule keeps gaps of all
   sizes open for pieces to come; at the end of a shard there are none, and what lies in sequences with a gap is placed
   once more by best fit.
3. What lies in sequences that a shard left with a gap is dealt again to fewer shards, until one shard holds all of it or a
   round saves nothing. So the loss at the ends of shards doesn't add up with the number of shards.
"""

import bisect
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardsentry.llm.byte_level import ByteLevel
from cardsentry.llm.common import batches, lists, written

VOCABULARY = "byte_bpe_50k.json"
CAPACITY = 2048
SEPARATOR = 0
SHARD_PIECES = 1 << 15
YIELD_TOKENS = 1 << 20


def vocabulary_file(path: str | None = None) -> bytes:
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path(VOCABULARY)
    with open(path, "rb") as f:
        return f.read()


def cuts(n: int, capacity: int) -> list[int]:
    """Starts of the pieces of n tokens: full ones, but for the first, which holds what is left over."""
    first = n % capacity or capacity
    return [0, *range(first, n, capacity)]


def pieces_of(docs: DataFrame, capacity: int, spec: bytes, separator: int) -> DataFrame:
    """(doc_id, key, piece, start, length, ids) per piece of ``docs(doc_id, text)``; ``key`` is another for each piece.
    The keys depend on how rows are dealt to tasks, so the table has to be stored before it is read twice."""
    shared = docs.sparkSession.sparkContext.broadcast(spec)
    names = ["doc_id", "key", "piece", "start", "length", "ids"]

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = ByteLevel(shared.value, specials=True)
        key = TaskContext.get().partitionId() << 40
        for part in batches(parts):
            rows, ids, size = [], [], 0

            def batch(rows=rows, ids=ids) -> pa.RecordBatch:
                doc, keys, piece, start, length = zip(*rows, strict=True)
                flat = lists(np.concatenate(ids).astype(np.int32), np.array(length), pa.int32())
                numbers = (pa.array(c, pa.int64()) for c in (doc, keys))
                return pa.record_batch(
                    [*numbers, pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()), flat],
                    names,
                )

            for doc, text in zip(part["doc_id"].to_pylist(), part["text"].to_pylist(), strict=True):
                own = np.append(codec.encode(text) if text else np.zeros(0, np.int64), separator)
                starts = cuts(len(own), capacity)
                for i, (low, high) in enumerate(zip(starts, [*starts[1:], len(own)], strict=True)):
                    rows.append((doc, key, i, low, high - low))
                    ids.append(own[low:high])
                    key += 1
                    size += high - low
                    if size >= YIELD_TOKENS:
                        yield batch()
                        rows.clear()
                        ids.clear()
                        size = 0
            if rows:
                yield batch()

    schema = "doc_id long, key long, piece int, start long, length long, ids array<int>"
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, schema)


def sum_of_squares(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(sequence, offset, gap of the sequence at the end) of pieces placed in the given order; sequences count from 0."""
    open_at: list[list[int]] = [[] for _ in range(capacity + 1)]
    count = np.zeros(capacity + 1, np.float64)
    free = np.full(capacity + 1, np.inf)  # 0 where a sequence of this gap is open
    room: list[int] = []
    sequence, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    for i, s in enumerate(lengths.tolist()):
        # half the change of the sum, less one: N(g - s) - N(g); a gap that closes adds no square
        change = count[: capacity - s] - count[s:capacity] + free[s:capacity]
        if len(change):
            change[0] -= 0.5
        to = int(change.argmin()) if len(change) else -1
        if to >= 0 and change[to] <= (count[capacity - s] - 0.5 if s < capacity else -1.0):
            gap = s + to
            at = open_at[gap].pop()
            count[gap] -= 1
            if not open_at[gap]:
                free[gap] = np.inf
        else:
            gap, at = capacity, len(room)
            room.append(capacity)
        sequence[i], offset[i] = at, capacity - gap
        room[at] = left = gap - s
        if left:
            open_at[left].append(at)
            count[left] += 1
            free[left] = 0.0
    return sequence, offset, np.array(room, np.int64)[sequence] if len(room) else sequence


def best_fit(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """(sequence, offset) of pieces placed in the given order, each into the smallest gap that it fits in."""
    gaps: list[tuple[int, int]] = []  # (gap, sequence), sorted
    sequence, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    n = 0
    for i, s in enumerate(lengths.tolist()):
        k = bisect.bisect_left(gaps, (s, -1))
        if k < len(gaps):
            gap, at = gaps.pop(k)
        else:
            gap, at, n = capacity, n, n + 1
        sequence[i], offset[i] = at, capacity - gap
        if gap > s:
            bisect.insort(gaps, (gap - s, at))
    return sequence, offset


def closed(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``sum_of_squares``, and at the end, where no later piece is to be waited for, what lies in sequences with a gap is
    placed again by best fit, if that takes fewer of them."""
    sequence, offset, gap = sum_of_squares(lengths, capacity)
    loose = np.flatnonzero(gap)
    if len(loose):
        again, place = best_fit(lengths[loose], capacity)
        if again.max() + 1 < len(np.unique(sequence[loose])):
            room = capacity - np.bincount(again, weights=lengths[loose]).astype(np.int64)
            sequence[loose], offset[loose], gap[loose] = again + sequence.max() + 1, place, room[again]
            sequence = np.unique(sequence, return_inverse=True)[1]
    return sequence, offset, gap


def packed_shards(pieces: DataFrame, shards: int, capacity: int, salt: int) -> DataFrame:
    """(key, length, sequence_id, offset, gap) of ``pieces(key, length)``, each shard packed by itself, the longest pieces
    first. A sequence is named by the key of its first piece."""

    def run(table: pa.Table) -> pa.Table:
        key, length = table["key"].to_numpy(), table["length"].to_numpy()
        order = np.lexsort((key, -length))
        key, length = key[order], length[order]
        sequence, offset, gap = closed(length, capacity)
        first = np.zeros(int(sequence.max()) + 1, np.int64)
        first[sequence[offset == 0]] = key[offset == 0]
        names = ["key", "length", "sequence_id", "offset", "gap"]
        return pa.table([key, length, first[sequence], offset, gap], names)

    dealt = pieces.select("key", "length", F.pmod(F.xxhash64("key", F.lit(salt)), F.lit(shards)).alias("shard"))
    schema = "key long, length long, sequence_id long, offset long, gap long"
    return dealt.groupBy("shard").applyInArrow(run, schema)


def placements(pieces: DataFrame, capacity: int = CAPACITY, shard_pieces: int = SHARD_PIECES) -> DataFrame:
    """(key, sequence_id, offset) of stored ``pieces(key, length)``, each from 1 to ``capacity`` long."""
    columns = ["key", "sequence_id", "offset"]
    done = [pieces.where(F.col("length") == capacity).select("key", F.col("key").alias("sequence_id"), F.lit(0).cast("long").alias("offset"))]
    left, n, used, salt = pieces.where(F.col("length") < capacity).select("key", "length"), None, None, 0
    loose = None  # the sequences that the round before left with a gap
    while True:
        n = left.count()
        shards = max(1, math.ceil(n / shard_pieces))
        packed = written(packed_shards(left, shards, capacity, salt), "packed")
        opened = packed.where("offset = 0").count()
        if loose is not None and opened >= used:
            done.append(loose.select(*columns))
            break
        if shards == 1:
            done.append(packed.select(*columns))
            break
        done.append(packed.where("gap = 0").select(*columns))
        loose = packed.where("gap > 0")
        used = loose.where("offset = 0").count()
        left, salt = loose.select("key", "length"), salt + 1
    out = done[0]
    for d in done[1:]:
        out = out.unionByName(d)
    return out


def pack(docs: DataFrame, capacity: int = CAPACITY, path: str | None = None, separator: int = SEPARATOR, shard_pieces: int = SHARD_PIECES) -> DataFrame:
    """Per piece of ``docs(doc_id, text)``: doc_id, piece (from 0), start (tokens of its document before it), length, ids,
    sequence_id and offset (its place there, gapless from 0).

    A document's tokens are its text's, in which strings of special tokens are those tokens, and ``separator``. Null and
    empty texts are the separator alone. Documents of more than ``capacity`` tokens are cut, none other; all but the first
    of their pieces are full. Repeated rows, and rows without an id, are documents of their own. An empty table gives an
    empty one; other columns are ignored.
    """
    pieces = written(pieces_of(docs, capacity, vocabulary_file(path), separator), "pieces")
    return with_places(pieces, placements(pieces, capacity, shard_pieces))


def with_places(pieces: DataFrame, places: DataFrame) -> DataFrame:
    return pieces.join(places, "key").drop("key")


def sequences(packed: DataFrame) -> DataFrame:
    """(sequence_id, ids, doc_ids, offsets): the tokens of every sequence of ``pack``, and where its documents start. A
    sequence has at most as many pieces as tokens, so a row is bounded."""
    inside = F.sort_array(F.collect_list(F.struct("offset", "doc_id", "ids")))
    rows = packed.groupBy("sequence_id").agg(inside.alias("p"))
    return rows.select(
        "sequence_id", F.flatten("p.ids").alias("ids"), F.col("p.doc_id").alias("doc_ids"), F.col("p.offset").alias("offsets")
    )


def digests(pieces: DataFrame) -> DataFrame:
    """``pieces`` with ids_crc32, the checksum of the ids as little-endian unsigned 32-bit numbers, in place of the ids."""
    import zlib

    plain = [c for c in pieces.columns if c != "ids"]

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches(parts):
            ids = part["ids"]
            flat, ends = ids.values.to_numpy().astype("<u4"), ids.offsets.to_numpy()
            sums = [zlib.crc32(flat[a:b].tobytes()) for a, b in zip(ends, ends[1:], strict=False)]
            yield pa.record_batch([*(part[c] for c in plain), pa.array(sums, pa.int64())], [*plain, "ids_crc32"])

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in pieces.schema if f.name != "ids")
    return pieces.mapInArrow(run, f"{kinds}, ids_crc32 long")


def packed_digests(docs: DataFrame, capacity: int = CAPACITY, path: str | None = None) -> DataFrame:
    """``pack`` with checksums in place of the ids, which are not moved."""
    pieces = written(pieces_of(docs, capacity, vocabulary_file(path), SEPARATOR), "pieces")
    out = with_places(digests(pieces), placements(pieces, capacity))
    return out.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
