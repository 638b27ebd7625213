"""Hard negatives: per anchor and positive, the best rows of other labels whose score lies in a window below the positive's.

Scores are integer inner products, so the search is one for the largest inner products. Every candidate x of a tree gets one
more component, sqrt(M^2 - |x|^2) with M the largest norm in its tree, which puts all of them on one sphere; an anchor gets 0
there. The inner product is then |anchor| M cos(angle), and angles obey the triangle inequality: if all rows below a node
lie within the angle r of its centre, an anchor at the angle t of the centre has inner products from
|anchor| M cos(t + r) to |anchor| M cos(t - r) with them.

Cover tree: a row is a node once. Its children come level by level; those of a level lie farther apart than the radius of
the level, and each takes the rows within that radius of it along. Every level of a node has its own covering radius,
which holds for the children of that level and of all levels below.

Search: best-first by the largest inner product that a level may have inside the window, skipping levels that lie outside of
it or can't reach the worst of the rows found so far. Children are scored exactly.

Trees have a bounded number of rows of one label each, so that a label may have any share of all rows. Anchors come in
blocks; a task searches one tree for one block. The first search finds the positives, in the trees of the anchor's label;
the second one the negatives, in all others.
"""

import heapq
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cardsentry.llm.common import written

TREE_ROWS = 4096
ANCHOR_BLOCK = 2048
LEAF = 16
MOST_TASKS = 10_000  # of one search; beyond it a task has several trees
SLACK = 1e-6  # of an angle; far more than rounding makes of it
EXACT = 2.0**53
POSITIVES, NEGATIVES = 5, 5
WINDOW = (80, 100)
SCALE = 256.0


class Tree:
    """A cover tree as arrays. Rows are in the order of their sets: the children of one node at one level."""

    def __init__(self, x: np.ndarray, centre: np.ndarray, start: np.ndarray, reach: np.ndarray):
        """Of set s: ``centre[s]`` is its node's place (-1 for the root's own set), ``start[s]`` its first row, ``reach[s]``
        its covering radius. Sets of a node come in the order of their levels, the highest first."""
        self.x, self.start, self.end, self.centre, self.reach = x, start, np.append(start[1:], len(x)), centre, reach
        self.first = np.full(len(x), -1, np.int64)
        self.next = np.full(len(centre), -1, np.int64)
        before: dict[int, int] = {}
        for s, c in enumerate(centre.tolist()):
            if c >= 0:
                if c in before:
                    self.next[before[c]] = s
                else:
                    self.first[c] = s
                before[c] = s
        self.square = (x * x).sum(axis=1)
        self.m = math.sqrt(float(self.square.max())) or 1.0
        self.most = float(np.abs(x).max(initial=0.0))

    def scores(self, q: np.ndarray, low: int, high: int) -> np.ndarray:
        """Exact inner products, as numbers that hold every integer below 2^53, or as Python's integers beyond."""
        if self.most * float(np.abs(q).max(initial=0.0)) * max(1, len(q)) < EXACT:
            return self.x[low:high] @ q
        own = [int(v) for v in q.tolist()]
        return np.array([sum(int(v) * w for v, w in zip(r, own, strict=True)) for r in self.x[low:high].tolist()], object)

    def best(self, q: np.ndarray, rank: np.ndarray, k: int, low: float, high: float, barred: int = -1) -> list[tuple]:
        """The first k of (score, place) with low <= score <= high, by falling score, then by ``rank``; the row at the place
        ``barred`` is left out."""
        size = math.sqrt(sum(v * v for v in q.tolist()))
        whole = size * self.m
        found: list[tuple] = []  # a heap: the worst first, as (score, -rank, place)

        def angles(scores: np.ndarray) -> np.ndarray:
            if not whole:
                return np.zeros(len(scores))
            return np.arccos(np.clip(scores.astype(np.float64) / whole, -1.0, 1.0))

        def offer(s: int) -> tuple[np.ndarray, np.ndarray]:
            at = int(self.start[s])
            scores = self.scores(q, at, int(self.end[s]))
            inside = (scores >= low) & (scores <= high)
            if len(found) == k:
                inside &= scores >= found[0][0]
            for i in np.flatnonzero(inside).tolist():
                entry = (scores[i], -int(rank[at + i]), at + i)
                if at + i == barred:
                    continue
                if len(found) < k:
                    heapq.heappush(found, entry)
                elif entry > found[0]:
                    heapq.heapreplace(found, entry)
            return scores, angles(scores)

        queue: list[tuple] = []
        # what rounding may make of a bound
        slip = 1e-9 * whole + 1e-6

        def push(s: int, theta: float) -> None:
            r = float(self.reach[s]) + SLACK
            most = whole * math.cos(max(0.0, theta - r)) + slip
            least = whole * math.cos(min(math.pi, theta + r)) - slip
            if most < low or least > high or (len(found) == k and most < found[0][0]):
                return
            heapq.heappush(queue, (-min(most, high), s, theta))

        _, theta = offer(0)
        if self.first[0] >= 0:
            push(int(self.first[0]), float(theta[0]))
        while queue:
            bound, s, theta = heapq.heappop(queue)
            if len(found) == k and -bound < found[0][0]:
                break
            _, turned = offer(s)
            at = int(self.start[s])
            own = self.first[at : int(self.end[s])]
            for i in np.flatnonzero(own >= 0).tolist():
                push(int(own[i]), float(turned[i]))
            if self.next[s] >= 0:
                push(int(self.next[s]), theta)
        return [(score, place) for score, _, place in sorted(found, reverse=True)]


def cover_tree(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(order, centre, start, reach) of the rows of ``x``, see ``Tree``; centres are places in the new order."""
    square = (x * x).sum(axis=1)
    m2 = float(square.max()) or 1.0
    on_sphere = np.column_stack([x, np.sqrt(np.maximum(m2 - square, 0.0))]) / math.sqrt(m2)
    if not square.any():
        on_sphere[:, -1] = 1.0

    def far(c: int, rows: np.ndarray) -> np.ndarray:
        return np.arccos(np.clip(on_sphere[rows] @ on_sphere[c], -1.0, 1.0))

    order, centre, start, reach = [0], [-1], [0], [0.0]
    rest = np.arange(1, len(x))
    todo = [(0, 0, rest, far(0, rest))]  # (row, its place, rows below it, their angles)
    while todo:
        row, place, rows, angle = todo.pop()
        while len(rows):
            widest = float(angle.max())
            start.append(len(order))
            centre.append(place)
            reach.append(widest)
            if len(rows) <= LEAF or widest <= SLACK:
                order.extend(rows.tolist())
                break
            # the level whose radius is the next power of two below the widest angle
            radius = 2.0 ** math.floor(math.log2(widest))
            radius = radius / 2 if radius >= widest else radius
            outside = angle > radius
            left, rows, angle = rows[outside], rows[~outside], angle[~outside]
            while len(left):
                child, left = int(left[0]), left[1:]
                d = far(child, left)
                near = d <= radius
                if near.any():
                    todo.append((child, len(order), left[near], d[near]))
                order.append(child)
                left = left[~near]
    return np.array(order), np.array(centre), np.array(start), np.array(reach)


TREE = "tree long, label long, width int, place int, node long, vec_id long, x array<double>, centre int, reach double, set int"


def build_trees(rows: DataFrame, tree_rows: int) -> DataFrame:
    """(tree, label, width, place, node, vec_id, x, centre, reach, set) of ``rows(node, vec_id, label, x)``: the rows of a label and
    width are dealt to as many trees as it takes."""
    names = [c.split()[0] for c in TREE.split(", ")]

    def run(table: pa.Table) -> pa.Table:
        width = table["width"][0].as_py()
        x = table["x"].combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(len(table), width)
        order, centre, start, reach = cover_tree(x)
        which = np.searchsorted(start, np.arange(len(x)), side="right") - 1
        moved = table.take(pa.array(order))
        columns = {
            "place": pa.array(np.arange(len(x)), pa.int32()),
            "centre": pa.array(centre[which], pa.int32()),
            "reach": pa.array(reach[which]),
            "set": pa.array(which, pa.int32()),
        }
        return pa.table([columns[c] if c in columns else moved[c] for c in names], names)

    sized = rows.withColumn("width", F.size("x"))
    trees = F.ceil(F.count(F.lit(1)) / tree_rows).cast("int")
    share = sized.groupBy("label", "width").agg(trees.alias("trees"))
    dealt = sized.join(share, ["label", "width"]).withColumn("nth", F.pmod(F.xxhash64("node"), F.col("trees")).cast("int"))
    named = dealt.withColumn("tree", F.xxhash64("label", "width", "nth"))
    return named.groupBy("label", "width", "nth").applyInArrow(run, TREE)


def tree_of(table: pa.Table) -> tuple[Tree, pa.Table, np.ndarray]:
    """The tree, its rows in order, and their rank by vec_id among rows of equal scores (rows without one come last)."""
    table = table.sort_by("place")
    which = table["set"].to_numpy()
    start = np.flatnonzero(np.concatenate([[True], which[1:] != which[:-1]]))
    width = table["width"][0].as_py()
    x = table["x"].combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(len(table), width)
    tree = Tree(x, table["centre"].to_numpy()[start], start, table["reach"].to_numpy()[start])
    ids = [2**63 if v is None else v for v in table["vec_id"].to_pylist()]
    nodes = table["node"].to_pylist()
    rank = np.empty(len(ids), np.int64)
    rank[sorted(range(len(ids)), key=lambda i: (ids[i], nodes[i]))] = np.arange(len(ids))
    return tree, table, rank


FOUND = "anchor long, positive long, node long, vec_id long, score long"


def found_rows(rows: list[tuple]) -> pa.Table:
    names = [c.split()[0] for c in FOUND.split(", ")]
    columns = zip(*rows, strict=True) if rows else [()] * len(names)
    return pa.table([pa.array(c, pa.int64()) for c in columns], names)


def searched(trees: DataFrame, asked: DataFrame, k: int, windows: bool) -> DataFrame:
    """FOUND rows: per anchor (and window) and tree the best k rows. ``asked(tree, block, anchor, q)`` and, with windows,
    ``windows``, an array of (positive, low, high)."""

    def run(rows: pa.Table, anchors: pa.Table) -> pa.Table:
        if not len(rows) or not len(anchors):
            return found_rows([])
        tree, table, rank = tree_of(rows)
        node, vec_id = table["node"].to_pylist(), table["vec_id"].to_pylist()
        own = {n: i for i, n in enumerate(node)}
        out = []
        spans = anchors["windows"].to_pylist() if windows else [None] * len(anchors)
        for anchor, q, span in zip(anchors["anchor"].to_pylist(), anchors["q"], spans, strict=True):
            q = q.values.to_numpy(zero_copy_only=False)
            if not windows:
                for score, i in tree.best(q, rank, k, -math.inf, math.inf, own.get(anchor, -1)):
                    out.append((anchor, None, node[i], vec_id[i], int(score)))
                continue
            known: dict[tuple, list] = {}  # positives of one score have one window
            for w in span:
                bounds = w["low"], w["high"]
                if bounds not in known:
                    known[bounds] = tree.best(q, rank, k, *bounds)
                out.extend((anchor, w["positive"], node[i], vec_id[i], int(score)) for score, i in known[bounds])
        return found_rows(out)

    blocks = written(asked.select("tree", "block").distinct(), "blocks")  # a row for each task to come
    keys = ["tree", "block"]
    # the number is given, as a tree and a block are small but stand for many inner products
    n = max(1, min(blocks.count(), MOST_TASKS))
    copies, asked = trees.join(blocks, "tree").repartition(n, *keys), asked.repartition(n, *keys)
    return copies.groupBy(*keys).cogroup(asked.groupBy(*keys)).applyInArrow(run, FOUND)


def first_of(found: DataFrame, k: int, *by: str) -> DataFrame:
    """The first k per group by falling score, then vec_id, with their rank. A group has at most k rows a tree."""
    along = Window.partitionBy(*by).orderBy(F.desc("score"), F.asc_nulls_last("vec_id"), "node")
    return found.withColumn("rank", F.row_number().over(along)).where(F.col("rank") <= k)


def prepared(vectors: DataFrame, is_anchor: Column, scale: float) -> DataFrame:
    """(node, vec_id, label, x, anchor) of the rows that take part, stored; node is another for each."""
    known = lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf")))
    whole = F.transform("embedding", lambda v: F.floor(F.lit(scale) * v.cast("double")).cast("double"))
    # floor gives a long; numbers beyond it have no fraction anyway
    large = F.transform("embedding", lambda v: F.lit(scale) * v.cast("double"))
    fits = F.forall("embedding", lambda v: F.abs(F.lit(scale) * v.cast("double")) < F.lit(2.0**62))
    rows = vectors.where(F.col("label").isNotNull() & F.col("embedding").isNotNull() & F.forall("embedding", known))
    x = F.when(fits, whole).otherwise(large)
    anchor = F.coalesce(is_anchor, F.lit(False)).alias("anchor")
    rows = rows.select(F.col("vec_id").cast("long"), F.col("label").cast("long"), x.alias("x"), anchor)
    return written(rows.withColumn("node", F.monotonically_increasing_id()), "candidates")


def hard_negatives(
    vectors: DataFrame,
    is_anchor: Column,
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    window: tuple[int, int] = WINDOW,
    scale: float = SCALE,
    tree_rows: int = TREE_ROWS,
    anchor_block: int = ANCHOR_BLOCK,
) -> DataFrame:
    """Per anchor and positive of ``vectors(vec_id, label, embedding)``, the negatives in falling order: anchor_id,
    positive_id, rank (from 1), negative_id, positive_score, negative_score.

    Components become floor(scale * x); a score is the integer inner product with the anchor, and higher scores come first,
    ties by vec_id (null last). The positives of an anchor are its first ``positives`` other rows of its label; negatives
    are rows of other labels with window[0] * positive <= 100 * negative <= window[1] * positive.

    Rows with a null label, a null vector or a null or non-finite component take no part. Vectors of different widths have
    no score with each other. Repeated rows are rows of their own, repeated anchors are answered each. A row without a
    vec_id is a candidate like others. Scores that are no 64-bit integers raise. An empty table gives an empty one; other
    columns are ignored.
    """
    rows = prepared(vectors, is_anchor, scale)
    trees = written(build_trees(rows.select("node", "vec_id", "label", "x"), tree_rows), "trees")
    heads = written(trees.where("place = 0").select("tree", F.col("label").alias("of"), "width"), "heads")
    anchors = rows.where("anchor").withColumn("width", F.size("x"))
    blocks = max(1, math.ceil(anchors.count() / anchor_block))
    block = F.pmod(F.xxhash64("node"), F.lit(blocks)).cast("int").alias("block")
    anchors = anchors.select(F.col("node").alias("anchor"), F.col("vec_id").alias("anchor_id"), "label", "width", F.col("x").alias("q"), block)
    anchors = written(anchors, "anchors")

    own = anchors.join(heads, (anchors["label"] == heads["of"]) & (anchors["width"] == heads["width"]))
    near = searched(trees, own.select("tree", "block", "anchor", "q"), positives, windows=False)
    best = first_of(near, positives, "anchor").select(
        "anchor", F.col("node").alias("positive"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score")
    )
    best = written(best, "positives")

    # whole numbers inside the window: low <= negative <= high
    score = F.col("positive_score").cast("decimal(38,0)")
    low, high = F.ceil(score * window[0] / 100), F.floor(score * window[1] / 100)
    spans = best.select("anchor", F.struct("positive", low.cast("long").alias("low"), high.cast("long").alias("high")).alias("w"))
    spans = spans.where("w.low <= w.high").groupBy("anchor").agg(F.collect_list("w").alias("windows"))  # ``positives`` at most
    # the list of trees goes to every block, so that no key holds more than a block's anchors
    lists_of = heads.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    others = anchors.join(spans, "anchor").join(lists_of, ["width", "block"]).where("label <> of")
    far = searched(trees, others.select("tree", "block", "anchor", "q", "windows"), negatives, windows=True)
    out = first_of(far, negatives, "anchor", "positive").join(best, ["anchor", "positive"])
    out = out.join(anchors.select("anchor", "anchor_id"), "anchor")
    return out.select(
        "anchor_id",
        "positive_id",
        F.col("rank").cast("int").alias("rank"),
        F.col("vec_id").alias("negative_id"),
        "positive_score",
        F.col("score").alias("negative_score"),
    )


def negatives_sql(positives: int = POSITIVES, negatives: int = NEGATIVES, window: tuple[int, int] = WINDOW) -> str:
    """The query of the catalog in SQL: anchors are ids divisible by 100, labels of ids divisible by 7 are moved by one."""
    low, high = window
    return f"""
WITH v AS (
  SELECT vec_id::BIGINT AS vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS x
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
scored AS (
  SELECT a.vec_id AS anchor, b.vec_id AS other, a.label = b.label AS same,
    list_sum(list_transform(range(1, len(a.x) + 1), lambda i: a.x[i] * b.x[i]))::BIGINT AS score
  FROM v a JOIN v b ON a.vec_id <> b.vec_id
  WHERE a.vec_id % 100 = 0),
positive AS (
  SELECT anchor, other AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor ORDER BY score DESC, other) <= {positives})
SELECT p.anchor AS anchor_id, p.positive_id,
  row_number() OVER (PARTITION BY p.anchor, p.positive_id ORDER BY n.score DESC, n.other)::INTEGER AS rank,
  n.other AS negative_id, p.positive_score, n.score AS negative_score
FROM positive p JOIN scored n ON p.anchor = n.anchor AND NOT n.same
WHERE {low} * p.positive_score <= 100 * n.score AND 100 * n.score <= {high} * p.positive_score
QUALIFY row_number() OVER (PARTITION BY p.anchor, p.positive_id ORDER BY n.score DESC, n.other) <= {negatives}"""
