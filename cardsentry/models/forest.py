"""Isolation forest, grown level by level over all tasks and scored in Arrow batches.

A tree is drawn from a share of the normal rows or from a given number of them, whatever that comes to. Neither a tree nor
a node has to fit into one task: nodes of more than ``local_rows`` rows are cut by an aggregate over all of them
(``groupBy(tree, node)``: the extremes of the features), one level after the other; a task finds the nodes of its rows by
walking them through what is known of the trees. What has become small enough goes on in one task, with the whole subtree
below it ("block"); its rows are sent there packed, once for every tree that they join, a few trees at a time: what was sent
is let go of before the next ones are sent, so that disk does not grow with the number of trees.

Blocks are kept packed, one row each. A forest that is too large for a broadcast is not brought to the driver: a task takes
up to ``CHUNK_ROWS`` rows and then reads all blocks, one after the other.

A cut depends on nothing but the seed, the tree, the number of the node and the extremes of its rows. So it is the same
whichever way a node was cut, and however rows are dealt to tasks. Nodes are numbered like a heap: 0 at the root, 2i + 1
and 2i + 2 below i.

Scores do not depend on a contamination rate: it would shift all raw scores by a constant, which the scaling by the
training extremes removes.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from datetime import datetime, timezone

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cardsentry.operators.preprocess import minmax
from cardsentry.operators.scoring import marked
from cardsentry.schema import LABEL, ROW_ID
from cardsentry.session import discard, let_go, materialise, scratch_path, small_table
from cardsentry.sources.state import load_scalars, save_scalars, save_table

# Number of trees, shares of rows and columns per tree, seed.
TREES, MAX_SAMPLES, MAX_FEATURES, SEED = 200, 0.8, 0.8, 42
LOCAL_ROWS = 524_288
BUNCH_ROWS = 65_536
PACKED = "zstd"
PASS_BYTES = 2_500_000_000  # values sent to blocks at once, before they are packed
SEEN_ROWS = 64  # that mostly tell which columns of a large node vary
CHUNK_ROWS, FILE_ROWS = 131_072, 32_768
BROADCAST_NODES = 8_000_000  # at some 9 bytes each
ZIPPED = "spark.sql.unionOutputPartitioning"  # would make one task of all chunks
EULER = 0.5772156649015329
# block: the node at which a task took over, -1 for what was cut by aggregates. feature is -1 for leaves.
NODES = "tree int, node long, block long, feature int, threshold double, path double"
# the nodes of a block; n: how many
PACKS = "tree int, block long, n long, data binary"


def mean_path(n: np.ndarray | float) -> np.ndarray:
    """Mean depth of an unsuccessful search among n rows."""
    n = np.asarray(n, dtype=float)
    m = np.maximum(n, 3.0)
    return np.where(n <= 1, 0.0, np.where(n == 2, 1.0, 2.0 * (np.log(m - 1.0) + EULER) - 2.0 * (m - 1.0) / m))


def _mixed(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def tree_columns(tree: int, features: int, share: float, seed: int) -> np.ndarray:
    """The columns that a tree may cut."""
    return np.sort(np.random.default_rng([seed, tree]).choice(features, max(1, int(share * features)), replace=False))


def choose(seed: int, tree: np.ndarray, node: np.ndarray, low: np.ndarray, high: np.ndarray, allowed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(feature, threshold) per node from the extremes of its rows, one column a feature: any allowed feature that is not
    constant, cut anywhere between its extremes; -1 where there is none."""
    open_ = (high > low) & allowed
    n = open_.sum(axis=1)
    with np.errstate(over="ignore"):
        start = np.uint64(seed % (1 << 64)) * np.uint64(0x9E3779B97F4A7C15) + tree.astype(np.uint64)
        key = _mixed(_mixed(start) + node.astype(np.uint64) * np.uint64(0xD1342543DE82EF95))
        pick, place = _mixed(key + np.uint64(1)), _mixed(key + np.uint64(2))
    nth = (pick % np.maximum(n, 1).astype(np.uint64)).astype(np.int64)
    feature = np.argmax(np.cumsum(open_, axis=1) == nth[:, None] + 1, axis=1)
    rows = np.arange(len(node))
    lo, hi = low[rows, feature], high[rows, feature]
    cut = lo + (place >> np.uint64(11)).astype(float) * 2.0**-53 * (hi - lo)
    cut = np.where(cut < hi, cut, lo)  # rounding must not leave the right side empty
    return np.where(n > 0, feature, -1), np.where(n > 0, cut, 0.0)


def depth_of(node: np.ndarray) -> np.ndarray:
    return np.floor(np.log2(node.astype(float) + 1.0)).astype(np.int64)


def _varying(part: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Which columns are not constant, per run of rows that begins at ``starts``."""
    width = part.shape[1]
    if np.isnan(part).any():  # comes out of any extreme, and is not above another
        return np.maximum.reduceat(part, starts) > np.minimum.reduceat(part, starts)
    other = np.empty(part.shape, bool)
    np.not_equal(part[1:], part[:-1], out=other[1:])
    other[starts] = False
    bits = np.zeros((len(part), 8 * -(-width // 64)), np.uint8)
    bits[:, : -(-width // 8)] = np.packbits(other, axis=1)
    found = np.bitwise_or.reduceat(bits.view(np.uint64), starts)
    return np.unpackbits(found.view(np.uint8), axis=1, count=width).astype(bool)


def grow(x: np.ndarray, seed: int, tree: int, root: int, columns: np.ndarray, max_depth: int) -> tuple[np.ndarray, ...]:
    """(node, feature, threshold, path) below ``root``, whose rows are ``x``; all nodes of a level at a time. The rows of a
    node lie together. Of a node's columns it only matters which ones vary, and the extremes of the one that is cut."""
    allowed = np.zeros(x.shape[1], bool)
    allowed[columns] = True
    node = np.array([root], np.int64)
    starts, part, depth = np.array([0]), np.ascontiguousarray(x), int(depth_of(np.array([root]))[0])
    out: list[tuple] = []
    while len(node):
        count = np.diff(np.append(starts, len(part)))
        varying = _varying(part, starts).astype(float)
        feature, place = choose(seed, np.full(len(node), tree), node, np.zeros_like(varying), varying, allowed)
        inner = (feature >= 0) & (count > 1) & (depth < max_depth)
        feature = np.where(inner, feature, -1)
        out.append((node, feature, np.zeros(len(node)), np.where(inner, 0.0, depth + mean_path(count))))
        inside = np.flatnonzero(inner)
        if not len(inside):
            break
        stay, size = np.flatnonzero(np.repeat(inner, count)), count[inside]
        begin = np.cumsum(size) - size
        value = part.ravel().take(stay * part.shape[1] + np.repeat(feature[inside], size))
        low, high = np.minimum.reduceat(value, begin), np.maximum.reduceat(value, begin)
        cut = low + place[inside] * (high - low)
        cut = np.where(cut < high, cut, low)  # as in choose
        out[-1][2][inside] = cut
        right = value > np.repeat(cut, size)
        rights = np.cumsum(right) - right  # rows before this one that go right, in the node once those before it are off
        rights -= np.repeat(rights[begin], size)
        middle = begin + size - np.add.reduceat(right, begin, dtype=np.int64)
        to = np.where(right, np.repeat(middle, size) + rights, np.arange(len(stay)) - rights)
        rows = np.empty(len(stay), np.int64)
        rows[to] = stay
        part = part.take(rows, axis=0)
        node = np.column_stack([2 * node[inside] + 1, 2 * node[inside] + 2]).ravel()
        starts = np.column_stack([begin, middle]).ravel()
        depth += 1
    return tuple(np.concatenate(c) for c in zip(*out, strict=True))


def _drawn_rows(normal: DataFrame, n: int, sample: int, trees: int, row_id: str, seed: int, features: list[str]) -> DataFrame:
    """(features, _k, _s): every row joins trees * sample / n trees on average, each at most once: the run of ``_k`` trees
    from ``_s`` on. The place is given by the hash of its id, the length by another hash."""
    rate = trees * sample / n
    draw = F.pmod(F.xxhash64(row_id, F.lit(seed)), F.lit(1 << 30)) / F.lit(float(1 << 30))
    copies = F.lit(int(rate)) + (draw < F.lit(rate - int(rate))).cast("int")
    start = F.pmod(F.xxhash64(row_id, F.lit(seed + 1)), F.lit(trees))
    return normal.select(*[F.col(c).cast("double").alias(c) for c in features], copies.alias("_k"), start.alias("_s")).where("_k > 0")


def draws(normal: DataFrame, n: int, sample: int, trees: int, row_id: str, seed: int, features: list[str]) -> DataFrame:
    """(tree, node 0, features): the drawn rows, once for every tree that they join."""
    return (
        _drawn_rows(normal, n, sample, trees, row_id, seed, features)
        .withColumn("_copy", F.explode(F.sequence(F.lit(0), F.col("_k") - 1)))
        .select(((F.col("_s") + F.col("_copy")) % trees).cast("int").alias("tree"), F.lit(0).cast("long").alias("node"), *features)
    )


def _matrix(batch: pa.RecordBatch | pa.Table, features: list[str]) -> np.ndarray:
    return np.column_stack([batch[c].to_numpy(zero_copy_only=False) if isinstance(batch, pa.RecordBatch) else batch[c].to_numpy() for c in features])


def _packed(columns: np.ndarray) -> bytes:
    """Columns of doubles, one after the other, compressed: the bytes of equal rank lie together."""
    width, rows = columns.shape
    ranked = np.ascontiguousarray(columns).view(np.uint8).reshape(width, rows, 8).transpose(0, 2, 1)
    return pa.compress(np.ascontiguousarray(ranked), codec=PACKED, asbytes=True)


def _unpacked(data: bytes, rows: int, width: int) -> np.ndarray:
    raw = np.frombuffer(pa.decompress(data, decompressed_size=rows * width * 8, codec=PACKED), np.uint8)
    return np.ascontiguousarray(raw.reshape(width, 8, rows).transpose(0, 2, 1)).view(float).reshape(width, rows)


# a reader takes a row group at a time
PACKED_FILES = {"compression": "uncompressed", "parquet.block.size": 8 << 20, "parquet.block.size.row.check.min": 1, "parquet.block.size.row.check.max": 4}


def _stored_rows(drawn: DataFrame, features: list[str], folder: str) -> DataFrame:
    """(n, data): the rows of ``_drawn_rows`` in bunches of columns, stored once. They are read many times."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        for last, b in marked(batches):
            held.append(_matrix(b, [*features, "_k", "_s"]))
            if last or sum(map(len, held)) >= BUNCH_ROWS:
                x = np.concatenate(held)
                held = []
                yield pa.record_batch([pa.array([len(x)]), pa.array([_packed(x.T)], pa.binary())], ["n", "data"])

    schema = "n long, data binary"
    drawn.mapInArrow(pack, schema).write.options(**PACKED_FILES).parquet(folder)
    return drawn.sparkSession.read.schema(schema).parquet(folder)


def _bunches(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(columns, _k, _s) of a bunch of drawn rows at a time."""
    for b in batches:
        for n, data in zip(b["n"].to_pylist(), b["data"], strict=True):
            x = _unpacked(data.as_py(), n, width + 2)
            yield x[:width], x[width].astype(np.int64), x[width + 1].astype(np.int64)


Cuts = dict[int, tuple[int, float]]


def _above(nodes: Iterator[int]) -> set[int]:
    """The nodes and those on the way to them."""
    out: set[int] = set()
    for node in nodes:
        while node not in out:
            out.add(node)
            node = max(0, (node - 1) // 2)
    return out


def reach(columns: np.ndarray, rows: np.ndarray, cuts: Cuts, way: set[int]) -> Iterator[tuple[int, np.ndarray]]:
    """(node, those of ``rows`` that come to it) for the nodes of ``way`` that are not cut."""
    todo = [(0, rows)] if 0 in way else []
    while todo:
        node, own = todo.pop()
        if node not in cuts:
            yield node, own
            continue
        feature, threshold = cuts[node]
        above = columns[feature].take(own) > threshold
        todo.extend((child, own[side]) for child, side in ((2 * node + 2, above), (2 * node + 1, ~above)) if child in way)


def walk(values: np.ndarray, base: np.ndarray, feature: np.ndarray, threshold: np.ndarray, left: np.ndarray) -> np.ndarray:
    """The position of the leaf of each row, whose features begin at ``base`` in ``values``."""
    at = np.zeros(len(base), np.int64)
    if feature[0] < 0 or not len(base):
        return at
    leaf = feature < 0  # a row that has come to a leaf stays there
    column, place = np.where(leaf, 0, feature).astype(np.int64), np.where(leaf, np.inf, threshold)
    child = np.where(leaf, np.arange(len(left)), left)
    rows, here, steps = np.arange(len(base)), at, 0
    while True:
        here = child.take(here) + (values.take(base + column.take(here)) > place.take(here))
        steps += 1
        if steps % 2:
            continue
        go = feature.take(here) >= 0
        n = np.count_nonzero(go)
        if n < 0.8 * len(go) or not n:
            at[rows[~go]] = here[~go]
            if not n:
                return at
            rows, here, base = rows[go], here[go], base[go]


def _ends(columns: np.ndarray, rows: np.ndarray, feature: int, known: np.ndarray, unsure: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(low, high) of some rows by column; low is below high for every column that varies. They are the extremes of the
    column ``feature``, and of those that may not vary; where the first few rows differ, theirs will do. Columns ``known`` to
    be constant are left out; of ``unsure`` ones, which have NaN, all rows count."""
    few = columns[:, rows[:SEEN_ROWS]]
    low, high = few.min(axis=1), few.max(axis=1)
    if len(rows) > SEEN_ROWS:
        whole = unsure | ~(low < high)
        if feature >= 0:
            whole[feature] = True
        for c in np.flatnonzero(whole & ~known):
            own = columns[c].take(rows)
            low[c], high[c] = own.min(), own.max()
    return np.where(known, np.inf, low), np.where(known, -np.inf, high)


def _cut_top(rows: DataFrame, varying: np.ndarray, trees: int, width: int, share: float, seed: int, max_depth: int, local_rows: int) -> tuple[list[tuple], dict[int, list[int]]]:
    """(nodes of more than ``local_rows`` rows as in ``NODES``, the numbers of the others that come next, by tree).

    A pass over the rows finds the extremes of the one column that a node will be cut by if the same columns vary in it as
    in its parent, and which ones do. Where others vary than was thought, the node is looked at again by the next pass."""
    spark = rows.sparkSession
    allowed = {t: np.isin(np.arange(width), tree_columns(t, width, share, seed)) for t in range(trees)}
    tops: dict[int, Cuts] = {t: {} for t in range(trees)}
    # nodes whose rows have not been counted: which columns vary, as far as known, and which ones are known to be constant
    open_: dict[int, dict[int, tuple[np.ndarray, np.ndarray]]] = {t: {0: (varying, ~varying)} for t in range(trees)}
    cuts: list[tuple] = []
    blocks: dict[int, list[int]] = {}
    stats = [f"{e}{i}" for i in range(width) for e in ("lo", "hi")]
    kinds = "tree int, node long, n long, " + ", ".join(f"{c} double" for c in stats)
    merged = [(F.min if c.startswith("lo") else F.max)(c).alias(c) for c in stats]

    def chosen(tree: int, node: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        feature, threshold = choose(seed, np.full(len(node), tree), node, low, high, np.tile(allowed[tree], (len(node), 1)))
        return np.where(depth_of(node) < max_depth, feature, -1), threshold

    while open_:
        plan = {}
        for t, own in open_.items():
            node = np.array(sorted(own), np.int64)
            vary, same = (np.array([own[i][k] for i in node.tolist()]) for k in (0, 1))
            guess = chosen(t, node, np.zeros(vary.shape), vary.astype(float))[0]
            plan[t] = tops[t], _above(own), {i: (k, int(f), s) for k, (i, f, s) in enumerate(zip(node.tolist(), guess, same, strict=True))}
        known = spark.sparkContext.broadcast(plan)

        def extremes(batches: Iterator[pa.RecordBatch], known=known) -> Iterator[pa.RecordBatch]:
            found = {t: (np.zeros(len(f), np.int64), np.full((len(f), width), np.inf), np.full((len(f), width), -np.inf)) for t, (_, _, f) in known.value.items()}
            for columns, k, s in _bunches(batches, width):
                unsure = np.isnan(columns).any(axis=1)
                for t, (top, way, own) in known.value.items():
                    n, low, high = found[t]
                    for node, part in reach(columns, np.flatnonzero((t - s) % trees < k), top, way):
                        if len(part):
                            i, feature, same = own[node]
                            lo, hi = _ends(columns, part, feature, same, unsure)
                            n[i] += len(part)
                            low[i], high[i] = np.minimum(low[i], lo), np.maximum(high[i], hi)
            for t, (n, low, high) in found.items():
                have = np.flatnonzero(n)
                ends = [e[have, i] for i in range(width) for e in (low, high)]
                own = [np.full(len(have), t, np.int32), np.array(list(known.value[t][2]), np.int64)[have], n[have], *ends]
                yield pa.record_batch([pa.array(c) for c in own], ["tree", "node", "n", *stats])

        # a node for every ``local_rows`` drawn rows, or some
        each = rows.mapInArrow(extremes, kinds).groupBy("tree", "node").agg(F.sum("n").alias("n"), *merged).toArrow()
        known.destroy()
        open_ = {}
        tree_of, node_of, n_of = (each[c].to_numpy() for c in ("tree", "node", "n"))
        low, high = (np.column_stack([each[f"{e}{i}"].to_numpy() for i in range(width)]) for e in ("lo", "hi"))
        for t in np.unique(tree_of).tolist():
            own = np.flatnonzero(tree_of == t)
            feature, threshold = chosen(t, node_of[own], low[own], high[own])
            for i, f, place in zip(own.tolist(), feature.tolist(), threshold.tolist(), strict=True):
                node, n = int(node_of[i]), int(n_of[i])
                vary, same = low[i] < high[i], ~np.isnan(high[i]) & ~(low[i] < high[i])
                if n <= local_rows:
                    blocks.setdefault(t, []).append(node)
                elif f < 0:
                    cuts.append((t, node, -1, -1, 0.0, float(depth_of(np.array(node)) + mean_path(n))))
                elif f != plan[t][2][node][1]:
                    open_.setdefault(t, {})[node] = vary, same
                else:
                    cuts.append((t, node, -1, f, place, 0.0))
                    tops[t][node] = f, place
                    open_.setdefault(t, {}).update({2 * node + 1: (vary, same), 2 * node + 2: (vary, same)})
    return cuts, blocks


def _tops(cuts: list[tuple]) -> dict[int, Cuts]:
    """(feature, threshold) of the nodes that are cut, by tree."""
    tops: dict[int, Cuts] = {}
    for t, node, _, feature, threshold, _ in cuts:
        if feature >= 0:
            tops.setdefault(t, {})[node] = feature, threshold
    return tops


def grow_trees(
    rows: DataFrame, varying: np.ndarray, trees: int, sample: int, width: int, share: float, seed: int, max_depth: int, local_rows: int, pass_bytes: int
) -> tuple[DataFrame, DataFrame]:
    """(nodes cut by aggregates, packed blocks) of all trees. ``rows`` are those of ``_stored_rows``; they are read once a
    level and once for every ``pass_bytes`` of values drawn. ``varying`` tells the columns that are not constant. No row is
    stored per tree; packed rows are sent to the blocks, a few trees at a time."""
    spark = rows.sparkSession
    cuts, blocks = _cut_top(rows, varying, trees, width, share, seed, max_depth, local_rows)
    tops = _tops(cuts)
    per_tree = sample * len(tree_columns(0, width, share, seed)) * 8
    at_once, own, folder = max(1, pass_bytes // per_tree), sorted(blocks), scratch_path(spark, "blocks")

    def grown(group: list[int]) -> DataFrame:
        places = spark.sparkContext.broadcast({t: (tops.get(t, {}), _above(blocks[t]), tree_columns(t, width, share, seed)) for t in group})

        def to_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for values, k, s in _bunches(batches, width):
                for t, (top, way, columns) in places.value.items():
                    for node, part in reach(values, np.flatnonzero((t - s) % trees < k), top, way):
                        if len(part):
                            data = pa.array([_packed(values[columns[:, None], part])], pa.binary())
                            yield pa.record_batch([pa.array([t], pa.int32()), pa.array([node]), pa.array([len(part)]), data], ["tree", "node", "n", "data"])

        def block(table: pa.Table) -> pa.Table:
            tree, root = table["tree"][0].as_py(), table["node"][0].as_py()
            columns = tree_columns(tree, width, share, seed)
            x = np.empty((sum(table["n"].to_pylist()), len(columns)))
            end = 0
            for d, n in zip(table["data"], table["n"].to_pylist(), strict=True):
                x[end : end + n] = _unpacked(d.as_py(), n, len(columns)).T
                end += n
            node, feature, threshold, path = grow(x, seed, tree, root, np.arange(len(columns)), max_depth)
            data = pack_nodes(np.where(feature >= 0, columns[feature], -1), threshold, path)
            return pa.table([pa.array([tree], pa.int32()), pa.array([root]), pa.array([len(node)]), pa.array([data], pa.binary())], PACKED_NAMES)

        packs = rows.mapInArrow(to_blocks, "tree int, node long, n long, data binary")
        return packs.groupBy("tree", "node").applyInArrow(block, PACKS)

    for i in range(0, max(1, len(own)), at_once):
        # the blocks of a tree lie together
        ordered = grown(own[i : i + at_once]).repartition("tree").sortWithinPartitions("tree", "block")
        ordered.write.mode("append").options(**PACKED_FILES).parquet(folder)
        if i + at_once < len(own):
            let_go(spark)
    return small_table(spark, sorted(cuts), NODES), spark.read.schema(PACKS).parquet(folder)


PACKED_NAMES = [c.split()[0] for c in PACKS.split(", ")]


def pack_nodes(feature: np.ndarray, threshold: np.ndarray, path: np.ndarray) -> bytes:
    """The nodes of a block, level by level, compressed: what they are cut by, thresholds, and paths of leaves."""
    inner = feature >= 0
    values = np.concatenate([threshold[inner], path[~inner]]).view(np.uint8).reshape(-1, 8)
    return pa.compress(feature.astype(np.int16).tobytes() + np.ascontiguousarray(values.T).tobytes(), codec=PACKED, asbytes=True)


def _pack_block(nodes: pa.Table) -> pa.Table:
    nodes = nodes.sort_by("node")
    data = pack_nodes(*(nodes[c].to_numpy() for c in ("feature", "threshold", "path")))
    return pa.table([nodes["tree"][:1], nodes["block"][:1], pa.array([nodes.num_rows]), pa.array([data], pa.binary())], PACKED_NAMES)


def unpack_nodes(data: bytes, n: int) -> tuple[np.ndarray, ...]:
    """(feature, threshold, position of the left child, path). The right child comes next to the left one, and the children
    of a node next to those of the node before it."""
    raw = np.frombuffer(pa.decompress(data, decompressed_size=10 * n, codec=PACKED), np.uint8)
    feature = raw[: 2 * n].view(np.int16)
    values = np.ascontiguousarray(raw[2 * n :].reshape(8, n).T).view(float).ravel()
    inner = feature >= 0
    threshold, left, path = np.zeros(n), np.zeros(n, np.int32), np.zeros(n)
    cut = np.count_nonzero(inner)
    threshold[inner], left[inner], path[~inner] = values[:cut], 1 + 2 * np.arange(cut), values[cut:]
    return feature, threshold, left, path


def numbers(root: int, feature: np.ndarray, left: np.ndarray) -> np.ndarray:
    """The numbers of the nodes of a block."""
    out, low, high = np.full(len(feature), root, np.int64), 0, 1
    while low < high:
        inner = low + np.flatnonzero(feature[low:high] >= 0)
        out[left[inner]], out[left[inner] + 1] = 2 * out[inner] + 1, 2 * out[inner] + 2
        low, high = high, high + 2 * len(inner)
    return out


def _unpacked_nodes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [c.split()[0] for c in NODES.split(", ")]
    for b in batches:
        for tree, root, n, data in zip(*(b[c] for c in PACKED_NAMES), strict=True):
            feature, threshold, left, path = unpack_nodes(data.as_py(), n.as_py())
            own = [np.full(len(feature), tree.as_py(), np.int32), numbers(root.as_py(), feature, left), np.full(len(feature), root.as_py())]
            out = pa.record_batch([pa.array(c) for c in (*own, feature.astype(np.int32), threshold, path)], names)
            yield from (out.slice(i, BUNCH_ROWS) for i in range(0, len(feature), BUNCH_ROWS))


class Paths:
    """The sums of the paths of some rows, to which one block after the other is added."""

    def __init__(self, x: np.ndarray, cuts: list[tuple]):
        self.x, self.width, self.tops = np.ascontiguousarray(x), x.shape[1], _tops(cuts)
        self.leaves: dict[int, dict[int, float]] = {}  # that were told by aggregates
        for tree, node, _, feature, _, path in cuts:
            if feature < 0:
                self.leaves.setdefault(tree, {})[node] = path
        self.values, self.columns, self.total = self.x.ravel(), np.ascontiguousarray(x.T) if self.tops else x.T, np.zeros(len(x))
        self.tree, self.parts = -1, {}

    def rows_of(self, tree: int, node: int) -> np.ndarray:
        """The rows that come to a node, by the cuts above it. The blocks of a tree mostly come one after the other."""
        if tree != self.tree:
            top = self.tops.get(tree, {})
            ends = {2 * n + side for n in top for side in (1, 2)} | {0}
            self.tree, self.parts = tree, dict(reach(self.columns, np.arange(len(self.x)), top, ends | set(top)))
        return self.parts[node]

    def add(self, tree: int, root: int, feature: np.ndarray, threshold: np.ndarray, left: np.ndarray, path: np.ndarray) -> None:
        rows = self.rows_of(tree, root)
        self.total[rows] += path.astype(np.float32)[walk(self.values, rows * self.width, feature, threshold, left)]

    def add_leaves(self) -> None:
        for tree, own in self.leaves.items():
            for node, path in own.items():
                self.total[self.rows_of(tree, node)] += np.float32(path)


@dataclass
class IsolationForest:
    """``top`` holds the nodes that were cut by aggregates, ``packs`` the blocks below them."""

    top: DataFrame
    packs: DataFrame
    features: list[str]
    sample: int
    trees: int = TREES
    low: float = 0.0
    high: float = 1.0
    metadata: dict = field(default_factory=dict)

    @staticmethod
    def fit(
        df: DataFrame,
        features: list[str],
        *,
        label: str = LABEL,
        row_id: str = ROW_ID,
        trees: int = TREES,
        max_samples: float | int = MAX_SAMPLES,
        max_features: float = MAX_FEATURES,
        local_rows: int = LOCAL_ROWS,
        pass_bytes: int = PASS_BYTES,
        seed: int = SEED,
    ) -> IsolationForest:
        """``max_samples`` is a share of the normal rows as a float, or a number of rows as an int; a tree has that many rows
        on average, never more than there are. A share makes trees that grow with the table, a number does not."""
        normal = df.where(F.col(label) == 0)
        as_double = [F.when(F.col(label) == 0, F.col(c).cast("double")) for c in features]
        vary = [(F.min(c) < F.max(c)).alias(f"_v{i}") for i, c in enumerate(as_double)]
        counts = df.agg(F.count(F.lit(1)).alias("all"), F.count_if(F.col(label) == 0).alias("normal"), *vary).first()
        n = counts["normal"]
        if n == 0:
            raise ValueError("no normal rows to fit on")
        sample = max(1, min(n, int(max_samples if isinstance(max_samples, int) else max_samples * n)))
        depth = int(np.ceil(np.log2(max(sample, 2))))
        drawn = _drawn_rows(normal, n, sample, trees, row_id, seed, features)
        varying = np.array([bool(counts[f"_v{i}"]) for i in range(len(features))])
        folder = scratch_path(df.sparkSession, "drawn")
        try:
            stored = _stored_rows(drawn, features, folder)
            top, packs = grow_trees(stored, varying, trees, sample, len(features), max_features, seed, depth, local_rows, pass_bytes)
        finally:
            discard(df.sparkSession, folder)
        own = packs.select("tree").unionByName(top.select("tree")).distinct().count()
        model = IsolationForest(top, packs, features, sample, own)
        ends = model._with_path(normal.select(*features), "raw", lambda raw: raw.agg(F.min("raw").alias("lo"), F.max("raw").alias("hi")).first())
        let_go(df.sparkSession)
        model.low, model.high = ends["lo"], ends["hi"]
        model.metadata = {
            "training_date": datetime.now(timezone.utc).isoformat(),
            "n_samples": n,
            "n_total": counts["all"],
            "feature_names": features,
            "hyperparams": {"trees": trees, "rows_per_tree": sample, "max_samples": max_samples, "max_features": max_features, "seed": seed},
        }
        return model

    @property
    def nodes(self) -> DataFrame:
        """One row per node, as in ``NODES``."""
        return self.packs.mapInArrow(_unpacked_nodes, NODES).unionByName(self.top)

    def is_small(self, nodes: int = BROADCAST_NODES) -> bool:
        """Whether the forest is sent to every task; a stream needs that."""
        return (self.packs.agg(F.sum("n")).first()[0] or 0) <= nodes

    def with_raw(self, df: DataFrame, name: str, broadcast_nodes: int = BROADCAST_NODES) -> DataFrame:
        """Add 2 ** (-mean path / expected path): higher is more unusual.

        A forest of up to ``broadcast_nodes`` nodes is sent to every task. For a larger one, a task takes some rows and reads
        the blocks, and the result is stored; a stream needs the former, whatever the size. Both ways agree to rounding
        (1e-6)."""
        return self._with_path(df, name, materialise, broadcast_nodes)

    def _with_path(self, df: DataFrame, name: str, use: Callable, broadcast_nodes: int = BROADCAST_NODES):
        scale = float(mean_path(self.sample)) or 1.0
        score = lambda total: F.exp(total * F.lit(-np.log(2.0) / self.trees / scale))
        if df.isStreaming or self.is_small(broadcast_nodes):
            found = df.withColumn(name, score(self._path_by_broadcast(df)))
            return found if use is materialise else use(found)
        spark = df.sparkSession
        folder, zipped = scratch_path(spark, "rows"), spark.conf.get(ZIPPED)
        try:
            spark.conf.set(ZIPPED, "false")
            return use(self._path_by_chunks(df, name, folder).withColumn(name, score(F.col(name))))
        finally:
            spark.conf.set(ZIPPED, zipped)
            discard(spark, folder)

    def _cuts(self) -> list[tuple]:
        return [tuple(r) for r in self.top.collect()]

    def _path_by_broadcast(self, df: DataFrame) -> Column:
        packs = self.packs.toArrow()
        shared = df.sparkSession.sparkContext.broadcast((self._cuts(), [packs[c].to_pylist() for c in PACKED_NAMES]))

        @F.pandas_udf("double")
        def path(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
            cuts, packed = shared.value
            blocks = [(tree, root, *unpack_nodes(data, n)) for tree, root, n, data in sorted(zip(*packed, strict=True))]
            for columns in batches:
                paths = Paths(np.column_stack([c.to_numpy(dtype=float) for c in columns]), cuts)
                for own in blocks:
                    paths.add(*own)
                paths.add_leaves()
                yield pd.Series(paths.total)

        return path(*[F.col(c).cast("double") for c in self.features])

    def _path_by_chunks(self, df: DataFrame, name: str, folder: str) -> DataFrame:
        """A task reads a chunk of the rows, which are stored for that, and then all blocks. Nothing is sent between tasks."""
        spark, features = df.sparkSession, self.features
        void = [c for c, kind in df.dtypes if kind == "void"]
        plain = df.drop(*void, name)
        kinds = dict(plain.dtypes)
        xs = [c if kinds[c] == "double" else f"_x{i}" for i, c in enumerate(features)]
        inputs = plain.withColumns({x: F.col(c).cast("double") for x, c in zip(xs, features, strict=True) if x != c})
        inputs.write.options(compression="zstd", maxRecordsPerFile=FILE_ROWS).parquet(folder)
        files = spark.read.schema(inputs.schema).parquet(folder).groupBy(F.col("_metadata.file_path").alias("f")).count().collect()
        most = min(CHUNK_ROWS, -(-sum(r["count"] for r in files) // spark.sparkContext.defaultParallelism))
        chunks: list[tuple[int, list[str]]] = []
        for f, n in sorted((r["f"], r["count"]) for r in files):
            if not chunks or chunks[-1][0] + n > most:
                chunks.append((0, []))
            chunks[-1] = chunks[-1][0] + n, [*chunks[-1][1], f]
        shared = spark.sparkContext.broadcast(self._cuts())
        names, inputs_names = plain.columns, inputs.columns
        packs = self.packs.select(*[F.col(c).alias(f"_{c}") for c in PACKED_NAMES])
        out = None
        for n, files in chunks:
            both = spark.read.schema(inputs.schema).parquet(*files).unionByName(packs, allowMissingColumns=True).coalesce(1)

            def add(batches: Iterator[pa.RecordBatch], n=n) -> Iterator[pa.RecordBatch]:
                """Rows and blocks in any order; as a rule rows come first."""
                early, held, paths = [], [], None
                for b in batches:
                    block = b["_tree"].is_valid().to_numpy(zero_copy_only=False)
                    if not block.all():
                        held.append(b.filter(pa.array(~block)).select(inputs_names))
                    if paths is None and sum(h.num_rows for h in held) == n:
                        paths = Paths(np.concatenate([_matrix(h, xs) for h in held]), shared.value)
                        held = [h.select(names) for h in held]
                    if block.any():
                        early.extend(zip(*(b.filter(pa.array(block))[f"_{c}"].to_pylist() for c in PACKED_NAMES), strict=True))
                    if paths is not None:
                        for tree, root, size, data in early:
                            paths.add(tree, root, *unpack_nodes(data, size))
                        early = []
                paths.add_leaves()
                end = 0
                for h in held:
                    total = pa.array(paths.total[end : end + h.num_rows])
                    end += h.num_rows
                    yield pa.record_batch([*h.columns, total], [*names, name])

            schema = plain.withColumn(name, F.lit(0.0)).schema
            own = both.mapInArrow(add, schema)
            out = own if out is None else out.unionByName(own)
        if out is None:
            out = plain.withColumn(name, F.lit(0.0))
        kept = [F.lit(None).alias(c) if c in void else F.col(c) for c in df.columns if c != name]
        return out.select(*kept, name)

    def score(self, df: DataFrame, name: str = "iso_score") -> DataFrame:
        """Add the anomaly score in [0, 1]; higher is more likely fraud."""
        raw = self.with_raw(df, "_raw")
        return raw.withColumn(name, minmax(F.col("_raw"), self.low, self.high, clip=True)).drop("_raw")

    def save(self, spark: SparkSession, path: str) -> None:
        save_table(self.top, f"{path}/top")
        save_table(self.packs, f"{path}/blocks")
        names = ("features", "sample", "trees", "low", "high", "metadata")
        save_scalars(spark, {c: getattr(self, c) for c in names}, f"{path}/scalars")

    @staticmethod
    def load(spark: SparkSession, path: str) -> IsolationForest:
        try:
            top, packs = (spark.read.parquet(f"{path}/{c}") for c in ("top", "blocks"))
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            nodes = spark.read.parquet(f"{path}/nodes")  # as forests were saved before they were packed
            top, packs = nodes.where("block < 0"), nodes.where("block >= 0").groupBy("tree", "block").applyInArrow(_pack_block, PACKS)
        return IsolationForest(top, packs, **load_scalars(spark, f"{path}/scalars"))
