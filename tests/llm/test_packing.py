"""Packing: every token once, gapless, ids of the tokenizer library, few sequences."""

import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from cardsentry.llm import catalog, packing
from cardsentry.llm.common import read, written

DOCS = "doc_id long, text string"


def plain_pieces(rows, capacity=packing.CAPACITY):
    codec = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    out = []
    for doc_id, text in rows:
        ids = [*codec.encode(text or "", add_special_tokens=False).ids, 0]
        first = len(ids) % capacity or capacity
        starts = [0, *range(first, len(ids), capacity)]
        for i, (a, b) in enumerate(zip(starts, [*starts[1:], len(ids)], strict=True)):
            out.append((doc_id, i, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())))
    return sorted(out, key=str)


def check_places(rows, capacity=packing.CAPACITY):
    """Gapless sequences; returns their number."""
    inside = defaultdict(list)
    for r in rows:
        inside[r.sequence_id].append((r.offset, r.length))
    for own in inside.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= capacity
    return len(inside)


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_query(spark, sf):
    sf_dir = f"/root/testdata/{sf}"
    got = catalog.QUERIES["op13_packing"](spark, sf_dir).collect()
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    want = plain_pieces([tuple(r) for r in docs])
    assert sorted(((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got), key=str) == want
    used, tokens = check_places(got), sum(p[3] for p in want)
    assert used <= 1.01 * tokens / packing.CAPACITY + 1


def test_odd_rows(spark):
    rows = [(1, None), (2, ""), (3, " "), (4, "<|endoftext|>"), (5, "a<|endoftext|> b"), (6, "word " * 9000), (7, "x" * 30_000)]
    rows += [(8, "é𝄞\x00\r\n\t"), (None, "no id"), (None, "no id"), (9, "same"), (9, "same"), (9, "other")]
    rows += [(100 + i, "copy of a text") for i in range(500)]
    df = spark.createDataFrame(rows, DOCS).withColumn("key", F.lit("k")).withColumn("length", F.lit(1)).repartition(4)
    packed = written(packing.pack(df, capacity=64, shard_pieces=100), "packed")
    got = packed.collect()
    crc = lambda ids: zlib.crc32(np.array(ids, "<u4").tobytes())
    mine = sorted(((r.doc_id, r.piece, r.start, r.length, crc(r.ids)) for r in got), key=str)
    want = plain_pieces(rows, 64)
    assert mine == want
    used, tokens = check_places(got, 64), sum(p[3] for p in want)
    assert used <= 1.04 * tokens / 64 + 1
    whole = packing.sequences(packed).collect()
    assert len(whole) == used
    assert sum(len(r.ids) for r in whole) == tokens
    assert all(len(r.doc_ids) == len(r.offsets) and r.offsets[0] == 0 for r in whole)
    assert packing.pack(df.limit(0)).collect() == []


def test_rule():
    """Each piece goes where the sum of squares becomes smallest, recomputed from nothing but the open gaps."""
    rng = np.random.default_rng(4)
    lengths = rng.integers(1, 51, 400)
    sequence, offset, gap = packing.sum_of_squares(lengths, 50)
    gaps = {}
    square = lambda g: sum(n * n for n in np.bincount([x for x in g if 0 < x < 50], minlength=1).tolist())
    for s, at, place in zip(lengths.tolist(), sequence.tolist(), offset.tolist(), strict=True):
        before = gaps.get(at, 50)
        assert place == 50 - before and before >= s
        options = {k: square([*(x for j, x in gaps.items() if j != k), g - s]) for k, g in gaps.items() if g >= s}
        options["new"] = square([*gaps.values(), 50 - s])
        gaps[at] = before - s
        assert square(gaps.values()) == min(options.values())
    assert gap.tolist() == [gaps[k] for k in sequence.tolist()]
    last, place, room = packing.closed(lengths, 50)
    used = defaultdict(list)
    for row in zip(place.tolist(), lengths.tolist(), last.tolist(), room.tolist(), strict=True):
        used[row[2]].append(row)
    assert sorted(used) == list(range(len(used))) and len(used) <= sequence.max() + 1
    for own in used.values():
        at = 0
        for offset, s, _, left in sorted(own):
            assert offset == at
            at += s
        assert left == 50 - at >= 0


def test_shards_lose_little(spark):
    """Leftovers of shards are packed again: many small shards end near one large one."""
    rng = np.random.default_rng(7)
    lengths = np.minimum(2048, rng.lognormal(5.5, 1.2, 20_000).astype(int) + 1)
    pieces = spark.createDataFrame([(i, int(n)) for i, n in enumerate(lengths)], "key long, length long")
    pieces = written(pieces, "pieces")
    least = lengths.sum() / 2048
    for shard in (1_000, 50_000):
        places = packing.placements(pieces, shard_pieces=shard)
        rows = places.join(pieces, "key").collect()
        assert len(rows) == len(lengths)
        assert check_places(rows) <= 1.002 * least + 1


def test_pieces_that_fit_nowhere_end(spark):
    pieces = written(spark.range(3000).select(F.col("id").alias("key"), F.lit(1100).cast("long").alias("length")), "pieces")
    assert packing.placements(pieces, shard_pieces=100).select("sequence_id").distinct().count() == 3000


def test_read_batches_are_bounded(spark):
    docs = read(spark, "/root/testdata/sf0.001", "documents")
    pieces = packing.pieces_of(docs, 2048, packing.vocabulary_file(), 0)
    assert pieces.select("key").distinct().count() == pieces.count()
