"""Near-duplicate documents by circulant MinHash, banding and exact Jaccard similarity of word shingles.

1. Every text becomes the set of its five-word shingles, as 64-bit numbers. One permutation scatters the numbers, a
   second one, shifted circularly by k, gives coordinate k of the signature: two permutations make all coordinates.
2. Documents with equal sets are one class. Only its smallest id goes on.
3. Classes that share a band meet in a bucket. Each is tied to the bucket's smallest member; the components of these
   ties are families, inside which all links have to lie.
4. Families are cut into blocks; each pair of blocks is one task that counts all intersections by a matrix product over
   the shingles that occur twice, and returns a spanning forest of the links, never the pairs.
5. Components of those links name the groups.

With bands of 4 and a similarity of 0.85, a pair is missed with probability (1 - 0.85^4)^14 = 3e-5, less where a family
ties its two ends in another way.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardsentry.llm.common import batches, frozen, join_parts, let_go, lists, mix64, sent_if_small, texts_of, written
from cardsentry.llm.components import components, reached

WORDS = 5
BANDS, ROWS = 14, 4
BLOCK = 256
KNOWN_WORDS = 300_000
CHUNK = 1024


class WordNumbers(dict):
    """Numbers of words from their bytes; forgets all when it holds ``KNOWN_WORDS``, so memory is bounded."""

    def __missing__(self, word: bytes) -> int:
        import xxhash

        if len(self) >= KNOWN_WORDS:
            self.clear()
        n = self[word] = xxhash.xxh64_intdigest(word) - (1 << 63)
        return n


def shingles(text: bytes, numbers: WordNumbers, size: int) -> np.ndarray:
    """Sorted distinct shingle numbers of a text. Bytes are lower-cased and split on exactly the ASCII rules."""
    words = text.lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    x = np.fromiter(map(numbers.__getitem__, words), np.int64, len(words)).view(np.uint64)
    width = min(size, len(words))
    n = len(x) - width + 1
    total = np.full(n, np.uint64(width))
    for i in range(width):  # the place of a word counts
        total = mix64(total + x[i : i + n] * np.uint64(2 * i + 3))
    return np.unique(total)


def signature(items: np.ndarray, coordinates: int) -> np.ndarray:
    """Circulant MinHash: scatter once, then the same permutation of the numbers shifted by 0, 1, 2, ..."""
    low = np.full(coordinates, np.uint64(0xFFFFFFFFFFFFFFFF))
    shift = np.arange(coordinates, dtype=np.uint64)[:, None]
    spread = mix64(items + np.uint64(0x632BE59BD9B4E019))
    for i in range(0, len(spread), CHUNK):
        y = spread[i : i + CHUNK] + shift
        y *= np.uint64(0xD6E8FEB86659FD93)
        y ^= y >> np.uint64(32)
        y *= np.uint64(0xA0761D6478BD642F)
        np.minimum(low, y.min(axis=1), out=low)
    return low


def profiles(docs: DataFrame, size: int, bands: int, rows: int) -> DataFrame:
    """(doc_id, node, n_shingles, d1, d2, bands): set size, a 128-bit digest of the set, and a number per band."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers = WordNumbers()
        place = np.arange(bands * rows, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        for part in batches(parts):
            n, d1, d2, keys = [], [], [], []
            for text in texts_of(part["text"]):
                s = shingles(text, numbers, size)
                n.append(len(s))
                for column, digest in zip((d1, d2), digests(s), strict=True):
                    column.append(digest)
                folded = mix64(signature(s, bands * rows) + place).reshape(bands, rows).sum(axis=1, dtype=np.uint64)
                keys.append(folded if len(s) else folded[:0])
            flat = np.concatenate(keys).view(np.int64)
            yield pa.record_batch(
                [
                    part["doc_id"].cast(pa.int64()),
                    part["node"],
                    pa.array(n, pa.int64()),
                    pa.array(np.array(d1, np.uint64).view(np.int64)),
                    pa.array(np.array(d2, np.uint64).view(np.int64)),
                    lists(flat, np.array([len(k) for k in keys]), pa.int64()),
                ],
                ["doc_id", "node", "n_shingles", "d1", "d2", "bands"],
            )
        numbers.clear()
        let_go()

    schema = "doc_id long, node long, n_shingles long, d1 long, d2 long, bands array<long>"
    return docs.select("doc_id", "node", "text").mapInArrow(run, schema)


def digests(s: np.ndarray) -> tuple[np.uint64, np.uint64]:
    return mix64(s).sum(dtype=np.uint64), mix64(s ^ np.uint64(0xC2B2AE3D27D4EB4F)).sum(dtype=np.uint64)


def blocked(members: DataFrame, block: int, size: int) -> DataFrame:
    """(family, i, j, node, block, items): the rows of each pair (i, j) of blocks of a family.

    ``members(node, family, n_family, text)``, where n_family counts the distinct sets of the nodes of a family, without
    empty ones. Only these are rows here, however often a node and its set are repeated. A family of n has ceil(n / block)
    blocks; each pair of blocks is a group of about two blocks of rows at most. Sets travel as numbers, not as text.
    """

    def sets(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers = WordNumbers()
        for p in batches(parts):
            found = [shingles(t, numbers, size) for t in texts_of(p["text"])]
            flat = np.concatenate(found).view(np.int64)
            own = lists(flat, np.array([len(s) for s in found]), pa.int64())
            d1, d2 = (pa.array(np.array(d, np.uint64).view(np.int64)) for d in zip(*map(digests, found), strict=True))
            yield pa.record_batch(
                [p["node"], p["family"], p["n_family"], d1, d2, own], ["node", "family", "n_family", "d1", "d2", "items"]
            )
        numbers.clear()
        let_go()

    n = F.ceil(F.col("n_family") / block).cast("int")
    return (
        members.mapInArrow(sets, "node long, family long, n_family long, d1 long, d2 long, items array<long>")
        .where(F.size("items") > 0)
        .groupBy("node", "family", "n_family", "d1", "d2")
        .agg(F.first("items").alias("items"))
        .withColumn("n_blocks", n)
        .withColumn("block", F.pmod(F.xxhash64("node", "d1", "d2"), F.col("n_blocks")).cast("int"))
        # the pairs (i, j), i <= j, of blocks that this row's block is part of
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("n_blocks") - 1)))
        .select(
            "family",
            F.least("block", "other").alias("i"),
            F.greatest("block", "other").alias("j"),
            "node",
            "block",
            "items",
        )
    )


def links_in_blocks(members: DataFrame, similar: tuple[int, int], block: int, size: int) -> DataFrame:
    """A spanning forest (a, b) of the links among the rows of each family; see ``blocked``."""
    part, whole = similar

    def link(table: pa.Table) -> pa.Table:
        nodes = table["node"].to_numpy()
        items = table["items"].combine_chunks()
        ends = items.offsets.to_numpy()
        values = items.values.to_numpy()
        sizes = np.diff(ends)
        row = np.repeat(np.arange(len(nodes)), sizes)
        _, place, count = np.unique(values[ends[0] : ends[-1]], return_inverse=True, return_counts=True)
        twice = count > 1
        column = np.cumsum(twice) - 1
        keep = twice[place]
        row, place = row[keep], column[place[keep]]
        common = np.zeros((len(nodes), len(nodes)), np.float32)
        order = np.argsort(place, kind="stable")
        row, place = row[order], place[order]
        n_columns = int(twice.sum())
        width = min(n_columns, 1 << 14)  # columns of one product, so memory is bounded
        for low in range(0, n_columns, width or 1):
            a, b = np.searchsorted(place, [low, low + width])
            m = np.zeros((len(nodes), width), np.float32)
            m[row[a:b], place[a:b] - low] = 1
            common += m @ m.T
        inside = common.astype(np.int64)
        union = sizes[:, None] + sizes[None, :] - inside
        where_a, where_b = np.nonzero(np.triu(whole * inside >= part * union, 1))
        a, b = join_parts(where_a, where_b, np.arange(len(nodes)))
        return pa.table({"a": pa.array(nodes[a], pa.int64()), "b": pa.array(nodes[b], pa.int64())})

    return blocked(members, block, size).groupBy("family", "i", "j").applyInArrow(link, "a long, b long")


def near_duplicates(
    docs: DataFrame,
    similar: tuple[int, int] = (85, 100),
    size: int = WORDS,
    bands: int = BANDS,
    rows: int = ROWS,
    block: int = BLOCK,
) -> DataFrame:
    """Per row of ``docs(doc_id, text)``: doc_id, n_shingles, component_id (smallest reachable doc_id), kept.

    Two rows are linked if ``whole * |A and B| >= part * |A or B|`` for ``similar = (part, whole)``. Null, empty and
    blank texts have no shingles and are linked with nothing. Repeated rows are copies of each other. Rows without a
    doc_id take part in links; where no id is reachable their component is null and they are kept. Rows that share an id
    are one node. An empty table gives an empty one; other columns are ignored.
    """
    # rows without an id are told apart by their text
    own = F.coalesce(F.col("doc_id").cast("long"), -F.abs(F.xxhash64("text")) - 1)
    docs = docs.select("doc_id", own.alias("node"), "text")
    rows_of = written(profiles(docs, size, bands, rows), "minhash")
    key = ["n_shingles", "d1", "d2"]
    classes = rows_of.where("n_shingles > 0").groupBy(*key)
    classes = classes.agg(F.min("doc_id").alias("least"), F.min("node").alias("any"), F.min("bands").alias("bands"))
    classes = frozen(classes.select(*key, "least", F.coalesce("least", "any").alias("node"), "bands"))
    keyed = classes.select("node", F.posexplode("bands").alias("band", "key"))
    buckets = keyed.groupBy("band", "key").agg(F.min("node").alias("first"), F.count(F.lit(1)).alias("n"))
    ties = keyed.join(buckets.where("n > 1"), ["band", "key"]).where("node != first")
    family = components(ties.select(F.col("first").alias("a"), F.col("node").alias("b")))
    family = frozen(family.withColumnRenamed("component", "family"))
    held = rows_of.where("n_shingles > 0").select("node", *key).distinct().join(family, "node")
    sizes = held.groupBy("family").agg(F.count(F.lit(1)).alias("n_family"))
    # few documents have a family: stored, and sent to the texts if they are few enough, so that no other text is moved
    sized = frozen(family.join(sizes, "family"))
    members = docs.select("node", "text").join(sent_if_small(sized), "node")
    links = links_in_blocks(members.select("node", "family", "n_family", "text"), similar, block, size)
    reach = frozen(components(links))
    known = classes.select(*key, "node", "least").join(reach, "node", "left")
    label = reached(known).select(*key, F.col("reached").alias("component_id"))
    out = rows_of.join(frozen(label), key, "left")
    # texts without shingles have no label; what reaches no id has none either
    component = F.when(F.col("n_shingles") == 0, F.col("doc_id")).otherwise(F.col("component_id"))
    return out.select(
        "doc_id", "n_shingles", component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept")
    )


def drop_near_duplicates(docs: DataFrame, **options) -> DataFrame:
    """``docs`` with one document of each group of near-duplicates: that with the smallest doc_id. Rows that share an
    id count as one document, of which one row stays; rows without an id stay."""
    groups = written(near_duplicates(docs, **options), "groups").where("doc_id IS NOT NULL")
    ids = groups.groupBy("doc_id").agg(F.max("kept").alias("kept"), F.count(F.lit(1)).alias("n"))
    # only ids with something to do are stored: those that go, and those that repeat
    ids = frozen(ids.where("NOT kept OR n > 1"))
    left = docs.join(sent_if_small(ids.where("NOT kept").select("doc_id")), "doc_id", "left_anti").select(*docs.columns)
    again = ids.where("kept").select("doc_id")
    if again.isEmpty():
        return left
    once = left.join(again, "doc_id", "left_semi").dropDuplicates(["doc_id"]).select(*docs.columns)
    return left.join(again, "doc_id", "left_anti").select(*docs.columns).union(once)
