"""Near-duplicate vectors by random-hyperplane signs in several tables, exact cosine, and connected components.

Vectors whose signs agree on all ``bits`` hyperplanes of a table meet in a bucket. Two vectors at the threshold agree on
one sign with probability p = 1 - arccos(t) / pi, so they meet in none of the tables with (1 - p^bits)^tables: the number
of tables follows from the wanted recall, and the number of bits from the number of vectors, so that a bucket of
unrelated vectors stays small at any size. Equal vectors are one class and travel once.

A bucket is cut into blocks; a pair of blocks is a task of its own, whatever the bucket's size, which multiplies the
blocks and returns counts per vector and a spanning forest, never the pairs. A pair that meets in several tables counts
in the first one only, which its two rows of signs tell.

What travels to the tables is a byte per component and the length of the rest that rounding leaves. The two lengths bound
how far the product of the rounded vectors is from the cosine: most pairs are decided by them. The few that are not are
returned and decided by the whole vectors; a pair of blocks with many of those is done again with whole vectors.
"""

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardsentry.llm.common import batches, frozen, join_parts, lists, sent_if_small, written
from cardsentry.llm.components import components, reached

BLOCK = 2048
BUCKET = 512
MISSED = 1e-5
STRIPE = 256
DOUBTS = 4  # undecided pairs per vector above which a pair of blocks is done again
COUNT, LINK, DOUBT, AGAIN = range(4)
PLACE = ["width", "t", "key", "i", "j"]
FOUND = "kind int, a long, b long, n long, width int, t int, key int"


def tables_and_bits(rows: int, threshold: float, bucket: int = BUCKET, missed: float = MISSED) -> tuple[int, int]:
    """(tables, bits): about ``bucket`` unrelated vectors in a bucket, at most ``missed`` of the pairs at the threshold
    unseen."""
    bits = min(30, max(4, math.ceil(math.log2(max(rows, 1) / bucket))))
    same = 1 - math.acos(threshold) / math.pi
    return math.ceil(math.log(missed) / math.log1p(-(same**bits))), bits


def unit_vectors(vectors: DataFrame, tables: int, bits: int, seed: int) -> DataFrame:
    """(vec, n_copies, width, x, signs, packed, small, scale, rest): the vector at length one, its bucket number in each
    table, the same as bytes, and the vector rounded to ``scale * small`` with the length of the rest."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planes: dict[int, np.ndarray] = {}
        weights = 1 << np.arange(bits, dtype=np.int64)
        for part in batches(parts):
            own, signs, small, scale, rest = [], [], [], [], []
            for v in part["embedding"]:
                x = v.values.to_numpy(zero_copy_only=False).astype(np.float64)
                x = x / np.abs(x).max()  # the length of very large or small numbers can be told too
                x /= np.linalg.norm(x)
                if len(x) not in planes:  # vectors of another width have planes of their own
                    planes[len(x)] = np.random.default_rng([seed, len(x)]).standard_normal((len(x), tables * bits))
                own.append(x)
                signs.append(((x @ planes[len(x)]).reshape(tables, bits) > 0) @ weights)
                scale.append(np.abs(x).max() / 127)
                rounded = np.rint(x / scale[-1])
                small.append(rounded.astype(np.int8).tobytes())
                rest.append(np.linalg.norm(x - rounded * scale[-1]))
            whole = np.array(signs, "<i4")
            packed = whole.view(np.uint8).reshape(*whole.shape, 4)[:, :, : bytes_a_sign(bits)]
            widths = np.array([len(x) for x in own], np.int32)
            yield pa.record_batch(
                [
                    part["vec"],
                    part["n_copies"],
                    pa.array(widths),
                    lists(np.concatenate(own), widths, pa.float64()),
                    lists(whole.ravel(), np.full(len(signs), tables), pa.int32()),
                    pa.array([row.tobytes() for row in packed], pa.binary()),
                    pa.array(small, pa.binary()),
                    pa.array(scale, pa.float64()),
                    pa.array(rest, pa.float64()),
                ],
                ["vec", "n_copies", "width", "x", "signs", "packed", "small", "scale", "rest"],
            )

    return vectors.select("vec", "n_copies", "embedding").mapInArrow(
        run,
        "vec long, n_copies long, width int, x array<double>, signs array<int>, packed binary, small binary, "
        "scale double, rest double",
    )


def bytes_a_sign(bits: int) -> int:
    return (bits + 7) // 8


def compared(table: pa.Table, threshold: float, most: int) -> pa.Table:
    """What a pair of blocks says (``FOUND``), told by whole vectors if it has them and else by rounded ones."""
    place = [table[c][0].as_py() for c in ("width", "t", "key")]
    width, t, _ = place
    i, j = (table[c][0].as_py() for c in ("i", "j"))
    vec, copies, block_of = (table[c].to_numpy() for c in ("vec", "n_copies", "block"))
    exact = "x" in table.column_names
    if exact:
        x = table["x"].combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(len(vec), width)
    else:
        scale, rest = (table[c].to_numpy() for c in ("scale", "rest"))
        # sums of products of bytes are whole numbers: single precision holds them up to this width
        real = np.float32 if width <= 1000 else np.float64
        x = np.frombuffer(b"".join(table["small"].to_pylist()), np.int8).reshape(len(vec), width).astype(real)
        widest = 2 * rest.max() + rest.max() ** 2 + 1e-9
    earlier = np.frombuffer(b"".join(table["packed"].to_pylist()), np.uint8).reshape(len(vec), t, -1) if t else None
    left, right = np.flatnonzero(block_of == i), np.flatnonzero(block_of == j)
    more = np.zeros(len(vec), np.int64)
    label = np.arange(len(vec))
    rows: dict[int, list] = {LINK: [], DOUBT: []}
    undecided = 0
    for s in range(0, len(left), STRIPE):
        ours = left[s : s + STRIPE]
        product = x[ours] @ x[right].T
        if not exact:
            product = product * scale[ours][:, None] * scale[right]
        p, q = np.nonzero(product >= threshold - (0 if exact else widest))
        cosine = product[p, q]
        p, q = ours[p], right[q]
        keep = p < q if i == j else np.ones(len(p), bool)
        if t:  # pairs that an earlier table has seen count there
            keep[keep] = ~(earlier[p[keep]] == earlier[q[keep]]).all(axis=2).any(axis=1)
        p, q, cosine = p[keep], q[keep], cosine[keep]
        if not exact:
            off = rest[p] + rest[q] + rest[p] * rest[q] + 1e-9
            open_ = np.abs(cosine - threshold) < off
            undecided += int(open_.sum())
            if undecided > most * len(vec):
                return answer(AGAIN, [i], [j], [0], place)
            rows[DOUBT].append((vec[p[open_]], vec[q[open_]]))
            sure = ~open_ & (cosine >= threshold)
            p, q = p[sure], q[sure]
        np.add.at(more, p, copies[q])
        np.add.at(more, q, copies[p])
        p, q = join_parts(p, q, label)
        rows[LINK].append((vec[p], vec[q]))
    linked = np.flatnonzero(more)
    out = [answer(COUNT, vec[linked], vec[linked], more[linked], place)]
    for kind, pairs in rows.items():
        if pairs:
            a, b = (np.concatenate(c) for c in zip(*pairs, strict=True))
            out.append(answer(kind, a, b, np.zeros(len(a), np.int64), place))
    return pa.concat_tables(out)


def answer(kind: int, a, b, n, place: list[int]) -> pa.Table:
    ids = [pa.array(c, pa.int64()) for c in (a, b, n)]
    fixed = [pa.array(np.full(len(ids[0]), v, np.int32)) for v in (kind, *place)]
    return pa.table([fixed[0], *ids, *fixed[1:]], ["kind", "a", "b", "n", "width", "t", "key"])


def verified(units: DataFrame, threshold: float, block: int, bits: int, doubts: int) -> DataFrame:
    """(a, b, n): for b null, that vector a has n more links; else a link of the spanning forest."""
    keyed = units.select("width", F.posexplode("signs").alias("t", "key"))
    blocks = F.ceil(F.count(F.lit(1)) / block).cast("int")
    large = frozen(keyed.groupBy("width", "t", "key").agg(blocks.alias("blocks")).where("blocks > 1"))

    def placed(*payload: str) -> DataFrame:
        rows = units.select("vec", "n_copies", "width", "packed", *payload, F.posexplode("signs").alias("t", "key"))
        rows = rows.withColumn("packed", F.substring("packed", F.lit(1), F.col("t") * bytes_a_sign(bits)))
        rows = rows.join(sent_if_small(large), ["width", "t", "key"], "left").na.fill(1, ["blocks"])
        rows = rows.withColumn("block", F.pmod(F.xxhash64("vec"), F.col("blocks")).cast("int"))
        rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        ends = {"i": F.least("block", "other"), "j": F.greatest("block", "other")}
        return rows.withColumns(ends).select(*PLACE, "block", "vec", "n_copies", "packed", *payload)

    def run(rows: DataFrame) -> DataFrame:
        # by all of the key, so that the pairs of blocks of one bucket are many tasks
        return rows.repartition(*PLACE).groupBy(*PLACE).applyInArrow(lambda t: compared(t, threshold, doubts), FOUND)

    found = written(run(placed("small", "scale", "rest")), "found")
    again = found.where(F.col("kind") == AGAIN).select("width", "t", "key", F.col("a").cast("int").alias("i"), F.col("b").cast("int").alias("j"))
    if not again.isEmpty():
        again = sent_if_small(frozen(again))
        found = found.union(written(run(placed("x").join(again, PLACE, "left_semi")), "found"))
    # undecided pairs are few: their vectors alone are joined
    unsure = frozen(found.where(F.col("kind") == DOUBT).select("a", "b"))
    needed = sent_if_small(frozen(unsure.select(F.explode(F.array("a", "b")).alias("vec")).distinct()))
    vectors = units.select("vec", "n_copies", "x").join(needed, "vec", "left_semi")
    one = vectors.select(F.col("vec").alias("a"), F.col("x").alias("u"), F.col("n_copies").alias("na"))
    two = vectors.select(F.col("vec").alias("b"), F.col("x").alias("v"), F.col("n_copies").alias("nb"))
    cosine = F.aggregate(F.zip_with("u", "v", lambda x, y: x * y), F.lit(0.0), lambda total, x: total + x)
    pairs = frozen(unsure.join(one, "a").join(two, "b").where(cosine >= threshold).select("a", "b", "na", "nb"))
    none = F.lit(None).cast("long").alias("b")
    links = found.where(F.col("kind") == LINK).select("a", "b").union(pairs.select("a", "b"))
    counts = found.where(F.col("kind") == COUNT).select("a", none, "n")
    counts = counts.union(pairs.select("a", none, F.col("nb").alias("n")))
    counts = counts.union(pairs.select(F.col("b").alias("a"), none, F.col("na").alias("n")))
    return counts.union(links.withColumn("n", F.lit(0).cast("long")))


def near_duplicate_vectors(
    vectors: DataFrame,
    threshold: float = 0.95,
    bucket: int = BUCKET,
    missed: float = MISSED,
    block: int = BLOCK,
    doubts: int = DOUBTS,
    seed: int = 11,
) -> DataFrame:
    """Per row of ``vectors(vec_id, embedding)``: vec_id, n_links, component_id, kept.

    n_links counts the other rows with a cosine of at least ``threshold``, component_id is the smallest vec_id that links
    reach. Vectors that are null, empty, zero, or hold a null or non-finite component link with nothing; so do vectors of
    different widths with each other. Repeated rows link as copies do. Rows without a vec_id are linked too; where no id
    is reachable the component is null and the row is kept. An empty table gives an empty one.
    """
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    good = F.forall("embedding", finite) & F.exists("embedding", lambda x: x != 0)
    double = F.col("embedding").cast("array<double>").alias("embedding")
    rows = vectors.select(F.col("vec_id").cast("long"), double)
    rows = rows.withColumn("good", F.coalesce(good, F.lit(False)))
    # a class of equal vectors is known by two hashes and the width
    digest = [F.xxhash64("embedding").alias("h1"), F.hash("embedding", F.lit(7)).alias("h2"), F.size("embedding").alias("w")]
    keyed = written(rows.select("vec_id", "good", *digest, "embedding"), "vectors")
    key = ["h1", "h2", "w"]
    classes = (
        keyed.where("good")
        .groupBy(*key)
        .agg(F.min("vec_id").alias("least"), F.count(F.lit(1)).alias("n_copies"), F.first("embedding").alias("embedding"))
        .withColumn("vec", F.coalesce("least", -F.abs(F.col("h1")) - 1))
    )
    classes = written(classes, "classes")
    tables, bits = tables_and_bits(classes.count(), threshold, bucket, missed)
    units = written(unit_vectors(classes, tables, bits, seed), "units")
    found = verified(units, threshold, block, bits, doubts)
    counts = found.where("b IS NULL").groupBy(F.col("a").alias("vec")).agg(F.sum("n").alias("n"))
    reach = frozen(components(found.where("b IS NOT NULL").select("a", "b")))
    known = classes.select(*key, "vec", "least", "n_copies").join(reach, classes["vec"] == reach["node"], "left")
    label = (
        reached(known)
        .join(counts, "vec", "left")
        .select(
            *key,
            "reached",
            (F.coalesce("n", F.lit(0)) + F.col("n_copies") - 1).alias("n_links"),
        )
    )
    out = keyed.drop("embedding").join(frozen(label), key, "left")
    component = F.when(F.col("good"), F.col("reached")).otherwise(F.col("vec_id"))
    return out.select(
        "vec_id",
        F.when(F.col("good"), F.col("n_links")).otherwise(F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.col("vec_id").eqNullSafe(component).alias("kept"),
    )
