"""Two tokenizers aligned by the bytes that their tokens cover, with corpus-wide counts of the id pairs that meet.

A text has a token of A and a token of B over every byte. The ends of A's and B's tokens together cut the bytes into
stretches, each inside one A token and one B token, so stretches are the links (overlapping token occurrences) one to one.
The ends that both have in common cut the tokens into groups.

Counting the documents of each id pair needs memory for neither pairs nor documents:

1. Runs. A task gathers the links of whole documents until it has ``RUN_LINKS`` of them, sorts them by pair and document,
   and appends them to a run: one file in the shared folder, cut by the low bits of A's id (the radix) into parts, each of
   two zstd frames. The head has the pairs of the part with the number of documents of each, the body those documents with
   the number of their links. Only runs that a finished task names are ever read.
2. Merge. One task a radix part (and group of runs) reads the heads, block by block, and merges them through a heap by the
   last pair of their blocks; equal pairs add up. Groups of ``FAN_IN`` runs give new runs of heads alone, until one group
   is left.
3. Maxima. The last merge meets the pairs side-major: all partners of an A id in a row, at most as many as B has ids. So it
   knows the highest count of an A id before the next begins, and streams out every pair's count with a mark of those
   that reach it.
4. Back. Each run reads those counts in its own order and adds up, per document, what its links contribute.
"""

import hashlib
import heapq
import math
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardsentry.llm.byte_level import ByteLevel
from cardsentry.llm.common import batches, scratch_path, written
from cardsentry.llm.warc import Ranges, opened

SIDE_A, SIDE_B = "byte_bpe_50k.json", "piece_bpe_32k.model"
RADIX_BITS = 6
RUN_LINKS = 3_000_000
FAN_IN = 128
BLOCK_PAIRS = 1 << 16
MOST_TASKS = 10_000  # of one merge; beyond it a task has several groups
PAIR_BITS = 20  # an id of B takes so many bits of a pair, a document of a run those below
LEVEL = 1

DOC = "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string"
SPOT = "part int, file string, low long, high long, at long, size long, pairs long"


class Sides:
    """Both encoders, whose files were read on the driver, and the bytes of their tokens."""

    def __init__(self, a: bytes, b: bytes):
        import sentencepiece

        self.a = ByteLevel(a, specials=False)
        self.b = sentencepiece.SentencePieceProcessor(model_proto=b)
        n = self.b.get_piece_size()
        if n >= 1 << PAIR_BITS:
            raise ValueError("side B has too many ids")
        name = [self.b.id_to_piece(i) for i in range(n)]
        self.b_bytes = [
            bytes([int(p[3:-1], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(name)
        ]
        self.b_lengths = np.array([len(p) for p in self.b_bytes], np.int64)
        # digits of every id with what follows it: A "," or "|", B "," or ";"
        digits = [[str(i) + end for i in range(k) for end in ends] for k, ends in ((len(self.a.bytes_of), ",|"), (n, ",;"))]
        self.words = np.array([w.encode() for side in digits for w in side])
        self.b_words = len(digits[0])

    def encode(self, texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """The ids on both sides; none if the bytes of either side are not a space and the text."""
        found = self.b.encode(texts, num_threads=1) if texts else []
        for text, own in zip(texts, found, strict=True):
            raw = b" " + text.encode()
            a, b = self.a.encode(" " + text), np.array(own, np.int64)
            same = b"".join([self.a.bytes_of[i] for i in a.tolist()]) == raw == b"".join([self.b_bytes[i] for i in own])
            yield (a, b) if text and same else (a[:0], b[:0])

    def aligned(self, a: np.ndarray, b: np.ndarray) -> tuple[int, np.ndarray, bytes]:
        """(number of groups, links as pairs of ids, the groups as text)."""
        ends_a, ends_b = np.cumsum(self.a.lengths[a]), np.cumsum(self.b_lengths[b])
        ends = np.union1d(ends_a, ends_b)
        links = (a[np.searchsorted(ends_a, ends)] << PAIR_BITS) | b[np.searchsorted(ends_b, ends)]
        last_a = ends_b[np.minimum(np.searchsorted(ends_b, ends_a), len(ends_b) - 1)] == ends_a
        last_b = ends_a[np.minimum(np.searchsorted(ends_a, ends_b), len(ends_a) - 1)] == ends_b
        # a group's A tokens, then its B tokens: a token's place is behind all of its own side before it and those groups'
        # tokens of the other side
        group_a, group_b = np.cumsum(last_a) - last_a, np.cumsum(last_b) - last_b
        until_a, until_b = np.flatnonzero(last_a) + 1, np.concatenate([[0], np.flatnonzero(last_b) + 1])
        words = np.empty(len(a) + len(b), np.int64)
        words[np.arange(len(a)) + until_b[group_a]] = 2 * a + last_a
        words[np.arange(len(b)) + until_a[group_b]] = self.b_words + 2 * b + last_b
        text = self.words[words].tobytes().translate(None, b"\0")
        return len(until_a), links, text[:-1]


def frame(compress: Callable[[bytes], bytes], *columns: np.ndarray) -> bytes:
    return compress(b"".join(c.tobytes() for c in columns))


def unframe(raw: bytes, *kinds: tuple[type, int]) -> list[np.ndarray]:
    """The columns of a frame, given their types and lengths."""
    import zstandard

    data, at, out = zstandard.ZstdDecompressor().decompress(raw), 0, []
    for kind, n in kinds:
        out.append(np.frombuffer(data, kind, n, at))
        at += out[-1].nbytes
    return out


def head(raw: bytes, pairs: int) -> tuple[np.ndarray, np.ndarray]:
    step, n = unframe(raw, (np.int64, pairs), (np.int64, pairs))
    return np.cumsum(step), n


def write_run(fs: pafs.FileSystem, root: str, name: str, links: np.ndarray, parts: int) -> list[tuple]:
    """Append one run; ``links`` are ``pair << 20 | document``. Returns a row (part, file, low, high, at, size, pairs, body,
    body_size, records) per radix part that has pairs."""
    import zstandard

    compress = zstandard.ZstdCompressor(level=LEVEL).compress
    links.sort()
    first = np.flatnonzero(np.concatenate([[True], links[1:] != links[:-1]]))
    times = np.diff(np.append(first, len(links)))
    record = links[first]
    pair, doc = record >> 20, record & 0xFFFFF
    radix = (pair >> PAIR_BITS) & (parts - 1)
    order = np.argsort(radix.astype(np.uint16), kind="stable")  # within a part still by pair, then document
    pair, doc, times, radix = pair[order], doc[order], times[order], radix[order]
    bounds = np.searchsorted(radix, np.arange(parts + 1))
    rows, at = [], 0
    with fs.open_output_stream(f"{root}/{name}", compression=None) as out:
        for p, (low, high) in enumerate(zip(bounds, bounds[1:], strict=False)):
            if low == high:
                continue
            own = pair[low:high]
            start = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]]))
            keys, n = own[start], np.diff(np.append(start, high - low))
            heads = frame(compress, np.diff(keys, prepend=0), n)
            body = frame(compress, doc[low:high].astype(np.int32), times[low:high].astype(np.int32))
            out.write(heads)
            out.write(body)
            rows.append((p, name, int(keys[0]), int(keys[-1]), at, len(heads), len(keys), at + len(heads), len(body), int(high - low)))
            at += len(heads) + len(body)
    return rows


def write_runs(docs: DataFrame, folder: str, a: bytes, b: bytes, parts: int, run_links: int) -> DataFrame:
    """Rows of two kinds: documents (a row each, with the run that has its links and its number there), and the parts of
    runs (doc is null)."""
    shared = docs.sparkSession.sparkContext.broadcast((a, b))
    schema = f"{DOC}, run string, doc int, {SPOT}, body long, body_size long, records long"
    names = [c.split()[0] for c in schema.split(", ")]
    kinds = {"long": pa.int64(), "int": pa.int32(), "string": pa.string()}
    types = [kinds[c.split()[1]] for c in schema.split(", ")]

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        return pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), types, strict=True)], names)

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sides = Sides(*shared.value)
        fs, root = opened(folder)
        name, gathered, size, n_docs = f"{uuid.uuid4().hex}.run", [], 0, 0

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal name, gathered, size, n_docs
            if size:
                spots = write_run(fs, root, name, np.concatenate(gathered), parts)
                yield batch([(*[None] * 6, name, None, *s) for s in spots])
            name, gathered, size, n_docs = f"{uuid.uuid4().hex}.run", [], 0, 0

        for part in batches(rows):
            found = []
            texts = [t or "" for t in part["text"].to_pylist()]
            for doc_id, (x, y) in zip(part["doc_id"].to_pylist(), sides.encode(texts), strict=True):
                if not len(x):
                    found.append((doc_id, 0, 0, 0, 0, "", None, 0, *[None] * 10))
                    continue
                groups, links, text = sides.aligned(x, y)
                sha = hashlib.sha256(text).hexdigest()
                found.append((doc_id, len(x), len(y), groups, len(links), sha, name, n_docs, *[None] * 10))
                gathered.append((links << 20) | n_docs)
                size += len(links)
                n_docs += 1
                if size >= run_links or n_docs == 1 << 20:
                    yield from flush()
            yield batch(found)
        yield from flush()

    fs, root = opened(folder)
    fs.create_dir(root, recursive=True)
    return written(docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, schema), "aligned")


def merged(runs: list[Iterator[tuple[np.ndarray, np.ndarray]]]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(pairs, counts) of sorted runs of blocks, in order. A heap has the last pair of every run's block in hand: up to the
    smallest of them no run can bring anything new."""
    hand: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    heap: list[tuple[int, int]] = []

    def take(i: int) -> None:
        block = next(runs[i], None)
        if block is not None:
            hand[i] = block
            heapq.heappush(heap, (int(block[0][-1]), i))

    for i in range(len(runs)):
        take(i)
    while heap:
        upto = heap[0][0]
        pairs, counts = [], []
        for i, (p, n) in hand.items():
            k = int(np.searchsorted(p, upto, side="right"))
            if k:
                pairs.append(p[:k])
                counts.append(n[:k])
                hand[i] = p[k:], n[k:]
        while heap and heap[0][0] == upto:
            _, i = heapq.heappop(heap)
            del hand[i]
            take(i)
        p, n = np.concatenate(pairs), np.concatenate(counts)
        order = np.argsort(p, kind="stable")
        p, n = p[order], n[order]
        first = np.flatnonzero(np.concatenate([[True], p[1:] != p[:-1]]))
        yield p[first], np.add.reduceat(n, first)


def sized(blocks: Iterator[tuple[np.ndarray, ...]], size: int = BLOCK_PAIRS) -> Iterator[tuple[np.ndarray, ...]]:
    """The same rows in blocks of ``size``."""
    held: list[tuple[np.ndarray, ...]] = []
    n = 0
    for block in blocks:
        held.append(block)
        n += len(block[0])
        while n >= size:
            whole = [np.concatenate(c) for c in zip(*held, strict=True)]
            yield tuple(c[:size] for c in whole)
            held, n = [tuple(c[size:] for c in whole)], n - size
    if n:
        yield tuple(np.concatenate(c) for c in zip(*held, strict=True))


def with_maxima(blocks: Iterator[tuple[np.ndarray, np.ndarray]]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Pairs in side-major order with their counts and whether a count is the highest of its A id. An id that the next block
    may go on with is held back; it has no more partners than B has ids."""
    held = (np.zeros(0, np.int64), np.zeros(0, np.int64))

    def marked(pairs: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        side = pairs >> PAIR_BITS
        first = np.flatnonzero(np.concatenate([[True], side[1:] != side[:-1]]))
        top = np.repeat(np.maximum.reduceat(counts, first), np.diff(np.append(first, len(pairs))))
        return pairs, counts, (counts == top).astype(np.int64)

    for pairs, counts in blocks:
        pairs, counts = np.concatenate([held[0], pairs]), np.concatenate([held[1], counts])
        k = int(np.searchsorted(pairs, (pairs[-1] >> PAIR_BITS) << PAIR_BITS))
        held = pairs[k:], counts[k:]
        if k:
            yield marked(pairs[:k], counts[:k])
    if len(held[0]):
        yield marked(*held)


def merge_runs(spots: DataFrame, folder: str, parts: int, groups: int, last: bool) -> DataFrame:
    """Merge the heads of each radix part of each group of runs into a new file; rows of SPOT, one a block. Blocks of the
    last merge hold the marks of the highest counts too."""
    names = [c.split()[0] for c in SPOT.split(", ")]

    def run(table: pa.Table) -> pa.Table:
        import zstandard

        compress = zstandard.ZstdCompressor(level=LEVEL).compress
        fs, root = opened(folder)
        ranges = Ranges(fs, root)
        blocks: dict[str, list[tuple]] = {}
        for row in sorted(zip(*(table[c].to_pylist() for c in ("file", "at", "size", "pairs")), strict=True)):
            blocks.setdefault(row[0], []).append(row)

        def heads(own: list[tuple]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
            for file, at, size, pairs in own:
                yield head(ranges.read(file, at, size), pairs)

        stream = merged([heads(own) for own in blocks.values()])
        name, at, rows = f"{uuid.uuid4().hex}.{'counts' if last else 'merged'}", 0, []
        with fs.open_output_stream(f"{root}/{name}", compression=None) as out:
            for pairs, *columns in sized(with_maxima(stream) if last else stream):
                packed = frame(compress, np.diff(pairs, prepend=0), *columns)
                out.write(packed)
                rows.append((table["part"][0].as_py(), name, int(pairs[0]), int(pairs[-1]), at, len(packed), len(pairs)))
                at += len(packed)
        ranges.close()
        kinds = (pa.int32(), pa.string(), *[pa.int64()] * 5)
        return pa.table([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)

    dealt = spots.withColumn("part_group", F.pmod(F.xxhash64("run"), F.lit(groups)))
    # the number of tasks is given, as a row here is small but stands for a frame that is read
    dealt = dealt.repartition(min(parts * groups, MOST_TASKS), "part", "part_group")
    merged_rows = dealt.groupBy("part", "part_group").applyInArrow(run, SPOT)
    return written(merged_rows, "merged")


def contributions(spots: DataFrame, counts: DataFrame, folder: str, tasks: int) -> DataFrame:
    """(run, doc, n_best, count_sum): what the counts of its links add up to, per document of every run."""

    def run(table: pa.Table) -> pa.Table:
        fs, root = opened(folder)
        ranges = Ranges(fs, root)
        best, total = np.zeros(0, np.int64), np.zeros(0, np.int64)
        name = table["run"][0].as_py()
        own = table.filter(pc.is_valid(table["body"]))
        blocks: dict[int, list[tuple]] = {}
        for row in zip(*(table[c].to_pylist() for c in ("part", "low", "high", "file", "at", "size", "pairs", "body")), strict=True):
            if row[-1] is None:
                blocks.setdefault(row[0], []).append(row[1:-1])
        spot = ("part", "at", "size", "pairs", "body", "body_size", "records")
        for part, at, size, pairs, body, body_size, records in zip(*(own[c].to_pylist() for c in spot), strict=True):
            keys, n = head(ranges.read(name, at, size), pairs)
            found, top = np.zeros(pairs, np.int64), np.zeros(pairs, np.int64)
            for low, high, file, place, length, k in sorted(blocks[part]):
                i, j = np.searchsorted(keys, [low, high + 1])
                if i == j:
                    continue
                step, count, mark = unframe(ranges.read(file, place, length), *[(np.int64, k)] * 3)
                known = np.cumsum(step)
                where = np.minimum(np.searchsorted(known, keys[i:j]), k - 1)
                hit = known[where] == keys[i:j]
                found[i:j][hit], top[i:j][hit] = count[where[hit]], mark[where[hit]]
            if not found.all():
                raise ValueError(f"run {name} has a pair that was not counted")
            doc, times = unframe(ranges.read(name, body, body_size), (np.int32, records), (np.int32, records))
            high = int(doc.max()) + 1
            if high > len(best):
                best, total = (np.concatenate([x, np.zeros(high - len(x), np.int64)]) for x in (best, total))
            np.add.at(total, doc, np.repeat(found, n) * times)
            np.add.at(best, doc, np.repeat(top, n) * times)
        ranges.close()
        return pa.table(
            [pa.array([name] * len(best)), pa.array(np.arange(len(best)), pa.int32()), best, total], ["run", "doc", "n_best", "count_sum"]
        )

    body = ("body", "body_size", "records")
    # the counts go to every run; a run reads those blocks that its pairs lie in
    theirs = counts.select(*[c.split()[0] for c in SPOT.split(", ")], *(F.lit(None).cast("long").alias(c) for c in body))
    needed = spots.select("run", F.col("part").alias("p"), F.col("low").alias("from"), F.col("high").alias("to"))
    inside = (F.col("part") == F.col("p")) & (F.col("low") <= F.col("to")) & (F.col("high") >= F.col("from"))
    asked = needed.join(theirs, inside).select("run", *theirs.columns)
    rows = spots.select("run", *theirs.columns).unionByName(asked)
    return rows.repartition(tasks, "run").groupBy("run").applyInArrow(run, "run string, doc int, n_best long, count_sum long")


def file_of(name: str) -> bytes:
    import public_tokenizers

    with open(name if "/" in name else public_tokenizers.path(name), "rb") as f:
        return f.read()


def align(
    docs: DataFrame,
    side_a: str = SIDE_A,
    side_b: str = SIDE_B,
    radix_bits: int = RADIX_BITS,
    run_links: int = RUN_LINKS,
    fan_in: int = FAN_IN,
) -> tuple[DataFrame, DataFrame, str]:
    """(documents, counts, folder) of ``docs(doc_id, text)``.

    Documents: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256, one per row. Counts: where the counted
    pairs lie in ``folder``, see ``pair_counts``.

    Texts that are null or empty, or whose tokens don't spell a space and the text byte for byte on both sides, have no
    tokens: zeros, and an empty digest. Strings of special tokens are plain text. Repeated rows, and rows without an id, are
    documents of their own. An empty table gives an empty one; other columns are ignored.
    """
    folder = scratch_path(docs.sparkSession, "pairs")
    rows = write_runs(docs, folder, file_of(side_a), file_of(side_b), 1 << radix_bits, run_links)
    spots = rows.where("doc IS NULL")
    level = spots.select("run", *[c.split()[0] for c in SPOT.split(", ")])
    parts = 1 << radix_bits
    runs = spots.select("run").distinct().count()
    groups = math.ceil(runs / fan_in)
    while groups > 1:
        level = merge_runs(level, folder, parts, groups, last=False).withColumn("run", F.col("file"))
        # a group has a file a part; the same number of groups stands for all parts
        groups = math.ceil(groups / fan_in)
    counts = merge_runs(level, folder, parts, 1, last=True)
    back = contributions(spots, counts, folder, max(1, min(runs, MOST_TASKS)))
    own = rows.where("doc IS NOT NULL").select(*[c.split()[0] for c in DOC.split(", ")], "run", "doc")
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("long").alias(c)
    out = own.join(back, ["run", "doc"], "left")
    return (
        out.select("doc_id", "n_a", "n_b", "n_groups", "n_links", zero("n_best"), zero("count_sum"), "groups_sha256"),
        counts,
        folder,
    )


def pair_counts(counts: DataFrame, folder: str) -> DataFrame:
    """(a, b, n_docs, best) of every linked id pair, read from where ``align`` left the counts."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranges = Ranges(*opened(folder))
        for part in batches(parts):
            for file, at, size, n in zip(*(part[c].to_pylist() for c in ("file", "at", "size", "pairs")), strict=True):
                step, count, mark = unframe(ranges.read(file, at, size), *[(np.int64, n)] * 3)
                pairs = np.cumsum(step)
                a, b = pairs >> PAIR_BITS, pairs & ((1 << PAIR_BITS) - 1)
                yield pa.record_batch([a, b, count, pa.array(mark.astype(bool))], ["a", "b", "n_docs", "best"])
        ranges.close()

    return counts.mapInArrow(run, "a long, b long, n_docs long, best boolean")
