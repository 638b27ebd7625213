import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from cardsentry.models.boosted import BoostedTrees, drawn, first_best
from cardsentry.models.forest import IsolationForest, choose, draws, grow, mean_path, tree_columns
from cardsentry.models.reconstruction import LinearReconstruction, NetworkReconstruction
from cardsentry.plans.training import Scorer, train
from cardsentry.sources.tables import transactions

FEATURES = ["a", "b", "c"]


@pytest.fixture(scope="module")
def points(spark):
    """Normal rows near a line; frauds far from it."""
    rng = np.random.default_rng(7)
    t = rng.normal(0, 1, 600)
    normal = np.column_stack([t, 2 * t, -t]) + rng.normal(0, 0.05, (600, 3))
    fraud = rng.uniform(-4, 4, (30, 3)) + np.array([3, -6, 3])
    rows = [(f"n{i}", 0, *map(float, r)) for i, r in enumerate(normal)] + [(f"f{i}", 1, *map(float, r)) for i, r in enumerate(fraud)]
    return spark.createDataFrame(rows, "trans_num string, is_fraud int, a double, b double, c double").persist()


def separation(scored, name):
    r = {x["is_fraud"]: x for x in scored.groupBy("is_fraud").agg(F.avg(name).alias("m"), F.min(name).alias("lo"), F.max(name).alias("hi")).collect()}
    assert all(0 <= x["lo"] <= x["hi"] <= 1 for x in r.values())
    return r[1]["m"] - r[0]["m"]


def test_isolation_forest(spark, points, tmp_path):
    model = IsolationForest.fit(points, FEATURES, trees=40, max_features=1.0)
    assert separation(model.score(points), "iso_score") > 0.2
    assert model.metadata["n_samples"] == 600 and model.metadata["n_total"] == 630
    assert model.nodes.select("tree").distinct().count() == 40
    model.save(spark, str(tmp_path / "f"))
    again = IsolationForest.load(spark, str(tmp_path / "f"))
    assert again.score(points).exceptAll(model.score(points)).count() == 0


def test_no_rows_are_stored_per_tree(points, monkeypatch):
    """Disk must not grow with rows times trees, whether nodes are cut by aggregates or in blocks."""
    from cardsentry.models import forest

    stored, real = [], forest.materialise

    def counted(df):
        out = real(df)
        stored.append((out.count(), out.columns))
        return out

    monkeypatch.setattr(forest, "materialise", counted)
    model = IsolationForest.fit(points, FEATURES, trees=10, max_features=1.0, local_rows=100)
    assert all(names == model.nodes.columns for _, names in stored)  # nothing but nodes
    stored.clear()
    model.with_raw(points, "raw", broadcast_nodes=0).count()
    assert [n for n, _ in stored] == [630]


def test_trees_are_sent_to_blocks_a_few_at_a_time(spark, points, monkeypatch, tmp_path):
    """What one pass sends is let go of before the next one, nothing but the blocks stays, and the forest is the same."""
    from pathlib import Path

    from cardsentry.models import forest
    from cardsentry.session import shared_dir

    calls = []
    monkeypatch.setattr(forest, "let_go", lambda spark: calls.append(spark))
    kept = lambda: sorted(p.name for p in Path(shared_dir(spark).removeprefix("file:")).glob("*-*") if p.name.startswith(("drawn-", "rows-")))
    before = kept()
    at_once, one_by_one = (IsolationForest.fit(points, FEATURES, trees=6, local_rows=100, pass_bytes=n) for n in (10**9, 1))
    assert len(calls) == 1 + 6  # one when a fit ends, and one between two passes
    assert at_once.nodes.exceptAll(one_by_one.nodes).count() == 0 and at_once.nodes.count() == one_by_one.nodes.count()
    want, got = (at_once.with_raw(points, "raw", broadcast_nodes=n).select("trans_num", F.round("raw", 9)) for n in (10**9, 0))
    assert want.exceptAll(got).count() == 0 and got.count() == 630
    assert kept() == before
    # a forest that was saved node by node
    at_once.save(spark, str(tmp_path / "packed"))
    at_once.nodes.write.parquet(str(tmp_path / "plain/nodes"))
    spark.read.parquet(str(tmp_path / "packed/scalars")).write.parquet(str(tmp_path / "plain/scalars"))
    again = IsolationForest.load(spark, str(tmp_path / "plain"))
    assert again.score(points).exceptAll(at_once.score(points)).count() == 0


def test_chunks_are_tasks_of_their_own(spark, points):
    model = IsolationForest.fit(points, FEATURES, trees=3)
    tasks = []
    model._with_path(points, "raw", lambda df: tasks.append(df.rdd.getNumPartitions()), broadcast_nodes=0)
    assert tasks[0] > 1


def test_nodes_with_unknown_values_are_cut_elsewhere():
    x = np.column_stack([np.arange(64.0), np.where(np.arange(64) == 5, np.nan, 1.0), np.zeros(64)])
    node, feature, _, path = grow(x, 3, 0, 0, np.array([0, 1, 2]), max_depth=20)
    assert set(feature.tolist()) <= {0, -1} and (feature < 0).sum() == 64


def test_forest_needs_normal_rows(points):
    with pytest.raises(ValueError, match="normal"):
        IsolationForest.fit(points.where("is_fraud = 1"), FEATURES)


def test_tree_separates_every_row_it_can():
    x = np.arange(16.0).reshape(-1, 1)
    node, feature, cut, path = grow(x, 3, 0, 0, np.array([0]), max_depth=16)
    assert (feature < 0).sum() == 16 and len(node) == 31 and len(set(node.tolist())) == 31
    assert (path[feature < 0] == np.floor(np.log2(node[feature < 0] + 1.0))).all()


def brute_forest(x, trees_of, trees, share, seed, depth):
    """The mean path of every row of ``x``, tree by tree and row set by row set."""
    total = np.zeros(len(x))
    for tree in range(trees):
        columns = tree_columns(tree, x.shape[1], share, seed)
        allowed = np.zeros((1, x.shape[1]), bool)
        allowed[0, columns] = True

        def down(node, drawn, rows, depth_now, tree=tree, allowed=allowed):
            own = x[drawn]
            ends = own.min(axis=0)[None], own.max(axis=0)[None]
            feature, cut = choose(seed, np.array([tree]), np.array([node]), *ends, allowed)
            if len(drawn) <= 1 or depth_now >= depth or feature[0] < 0:
                total[rows] += depth_now + mean_path(len(drawn))
                return
            low = lambda r: r[x[r, feature[0]] <= cut[0]]
            high = lambda r: r[x[r, feature[0]] > cut[0]]
            down(2 * node + 1, low(drawn), low(rows), depth_now + 1)
            down(2 * node + 2, high(drawn), high(rows), depth_now + 1)

        down(0, np.flatnonzero(trees_of[tree]), np.arange(len(x)), 0)
    return total / trees


@pytest.mark.parametrize("max_samples, local_rows", [(0.8, 4_000), (0.8, 200_000), (256, 65_536)])
def test_forest_of_many_rows_equals_brute_force(spark, max_samples, local_rows):
    """100,000 rows, cut by aggregates level by level and in blocks, or whole trees in one task each."""
    n, trees, seed = 100_000, 3, 42
    rng = np.random.default_rng(5)
    x = np.column_stack([rng.normal(size=n), rng.exponential(size=n), rng.integers(0, 4, n).astype(float), np.ones(n)])
    rows = pa.table({"trans_num": [str(i) for i in range(n)], "is_fraud": np.zeros(n, np.int64), **dict(zip("abcd", x.T, strict=True))})
    df = spark.createDataFrame(rows)
    names = list("abcd")
    model = IsolationForest.fit(df, names, trees=trees, max_samples=max_samples, local_rows=local_rows)
    blocks = model.nodes.where("block = node").count()
    assert blocks == trees if local_rows > 65_000 else blocks > 50
    share = model.sample / n
    assert model.sample == (80_000 if isinstance(max_samples, float) else 256)
    drawn = draws(df.withColumn("a", F.col("trans_num").cast("double")), n, model.sample, trees, "trans_num", seed, ["a"])
    trees_of = np.zeros((trees, n), bool)
    for r in drawn.toArrow().to_pylist():
        trees_of[r["tree"], int(r["a"])] = True
    assert np.abs(trees_of.mean(axis=1) / share - 1).max() < 0.3
    want = brute_forest(x, trees_of, trees, 0.8, seed, int(np.ceil(np.log2(model.sample))))
    want = np.exp2(-want / mean_path(model.sample))
    for limit in (0, 10**9):  # rows go to the blocks, or the forest to the rows
        got = model.with_raw(df.select("trans_num", *names), "raw", broadcast_nodes=limit).select("trans_num", "raw").toArrow()
        found = np.zeros(n)
        found[np.array(got["trans_num"].to_pylist(), int)] = got["raw"].to_numpy()
        assert np.abs(found - want).max() < 1e-6


def test_linear_reconstruction(spark, points, tmp_path):
    model = LinearReconstruction.fit(points, FEATURES, k=1)
    assert separation(model.score(points), "ae_score") > 0.5
    # the residual identity against an explicit reconstruction
    row = points.select(*FEATURES, model.error().alias("e")).first()
    x = np.array([(row[c] - lo) / (hi - lo) for c, (lo, hi) in model.inputs.items()]) - np.array(model.mean)
    axes = np.array(model.axes)
    assert row["e"] == pytest.approx(float(((x - axes.T @ (axes @ x)) ** 2).mean()), abs=1e-12)
    model.save(spark, str(tmp_path / "l"))
    assert LinearReconstruction.load(spark, str(tmp_path / "l")) == model


def test_network_learns(spark, points, tmp_path):
    model = NetworkReconstruction.fit(points, FEATURES, hidden=[16, 2, 16], epochs=12, batch=32, rate=0.01, dropout=0.0)
    assert model.history[-1] < model.history[0]
    assert separation(model.score(points), "ae_score") > 0.2
    model.save(spark, str(tmp_path / "n"))
    again = NetworkReconstruction.load(spark, str(tmp_path / "n"))
    assert again.score(points).exceptAll(model.score(points)).count() == 0


def test_network_goes_on_after_it_was_stopped(spark, points, tmp_path):
    """Six epochs in one go, and three, then a new run that goes on from what the first has left."""
    options = {"hidden": [8, 2, 8], "batch": 32, "rate": 0.01}
    whole = NetworkReconstruction.fit(points, FEATURES, epochs=6, folder=str(tmp_path / "whole"), **options)
    NetworkReconstruction.fit(points, FEATURES, epochs=3, folder=str(tmp_path / "cut"), **options)
    (tmp_path / "cut" / "epoch=3").mkdir()  # an epoch whose writing was broken off
    (tmp_path / "cut" / "epoch=3" / "_temporary").mkdir()
    again = NetworkReconstruction.fit(points, FEATURES, epochs=6, folder=str(tmp_path / "cut"), **options)
    assert again.history == whole.history and len(whole.history) == 6
    assert again.state == whole.state and (again.low, again.high) == (whole.low, whole.high)
    # a run that had ended is not run again
    assert NetworkReconstruction.fit(points, FEATURES, epochs=6, folder=str(tmp_path / "cut"), **options) == again


def test_boosted_trees(spark, points, tmp_path):
    model = BoostedTrees.fit(points, FEATURES, points, rounds=8, step=0.3)
    assert model.weight == 20.0 and 1 <= model.rounds <= 8
    assert separation(model.score(points), "xgb_score") > 0.2
    assert model.prefix_precision(points) == pytest.approx(model.history)
    top = model.feature_importance(spark).collect()
    assert [r["importance"] for r in top] == sorted((r["importance"] for r in top), reverse=True)
    assert sum(r["importance"] for r in top) == pytest.approx(1.0)
    model.save(spark, str(tmp_path / "b"))
    again = BoostedTrees.load(spark, str(tmp_path / "b"))
    assert again.score(points).exceptAll(model.score(points)).count() == 0


def plain_boosting(rows, bins, y, keys, weight, rounds, step, depth, seed):
    """Margins of all rows: every cut tried row by row of the drawn rows."""
    margin = np.zeros(len(y))
    w = np.where(y == 1, weight, 1.0)
    for number in range(rounds):
        columns = np.random.default_rng([seed, number]).choice(bins.shape[1], max(1, int(0.8 * bins.shape[1])), replace=False)
        seen = drawn(keys, number, seed)
        p = 1 / (1 + np.exp(-margin))
        g, h = w * (y - p), w * p * (1 - p)

        def grow(own, level, g=g, h=h, seen=seen, columns=columns):
            used = own & seen
            best = (1e-12, None)
            if level < depth:
                whole = g[used].sum() ** 2 / (h[used].sum() + 1)
                for f in sorted(columns):
                    for cut in range(64):
                        left = used & (bins[:, f] <= cut)
                        right = used & ~(bins[:, f] <= cut)
                        if h[left].sum() < 1 or h[right].sum() < 1:
                            continue
                        gain = g[left].sum() ** 2 / (h[left].sum() + 1) + g[right].sum() ** 2 / (h[right].sum() + 1) - whole
                        if gain > best[0] + 1e-9:
                            best = (gain, (f, cut))
            if best[1] is None:
                value = step * g[used].sum() / (h[used].sum() + 1) if level else 0.0
                return np.where(own, value, 0.0)
            f, cut = best[1]
            low = bins[:, f] <= cut
            return grow(own & low, level + 1) + grow(own & ~low, level + 1)

        margin = margin + grow(np.ones(len(y), bool), 0)
    return margin


def test_boosting_equals_a_loop_over_rows(spark, points):
    df = points.coalesce(1).persist()
    model = BoostedTrees.fit(df, FEATURES, rounds=7, step=0.3, depth=3)  # margins are carried on after the fifth
    assert model.rounds == 7
    rows = df.collect()
    x = np.array([[r[c] for c in FEATURES] for r in rows])
    edges = [np.unique(q) for q in df.approxQuantile(FEATURES, [i / 64 for i in range(1, 64)], 0.001)]
    bins = np.column_stack([np.searchsorted(e, x[:, i], side="left") for i, e in enumerate(edges)])
    want = plain_boosting(rows, bins, np.array([r["is_fraud"] for r in rows]), np.arange(len(rows)), 20.0, 7, 0.3, 3, 42)
    got = {r["trans_num"]: r["m"] for r in df.select("trans_num", model.margin(df).alias("m")).collect()}
    assert [got[r["trans_num"]] for r in rows] == pytest.approx(want.tolist(), abs=1e-9)


def test_boosting_stops_when_nothing_is_gained(spark, points):
    """Validation rows that the first tree ranks perfectly: no tree beyond the patience is grown."""
    easy = points.where("is_fraud = 1").limit(5).unionByName(points.where("is_fraud = 0 AND abs(a) < 0.3"))
    model = BoostedTrees.fit(points, FEATURES, easy, rounds=60, step=0.3, patience=4)
    assert len(model.trees) < 60 and model.rounds <= len(model.trees) - 4
    assert len(model.history) == len(model.trees)
    best = first_best(model.history, 4)
    assert model.rounds == best + 1 and len(model.trees) <= best + 4 + 5


def test_boosting_needs_positive_rows(points):
    with pytest.raises(ValueError, match="positive"):
        BoostedTrees.fit(points.where("is_fraud = 0"), FEATURES)


def test_stopping_rule():
    assert first_best([0.1, 0.3, 0.2, 0.2, 0.9], patience=2) == 1
    assert first_best([0.1, 0.3, 0.2, 0.4], patience=3) == 3


def test_training_plan_and_saved_scorer(spark, sf_dir, tmp_path):
    df = transactions(spark, sf_dir)
    scorer, evaluation = train(df, forest_options={"trees": 20}, boosted_options={"rounds": 3}, network=False)
    rows = {(r["section"], r["model"], r["metric"]): r["value"] for r in evaluation.collect()}
    assert rows["sizes", "train", "rows"] == 700 and rows["sizes", "validation", "rows"] == 150
    assert all(0 <= rows["metrics", m, "pr_auc"] <= 1 for m in ("Isolation Forest", "Autoencoder", "XGBoost", "Ensemble"))
    # the blend is at least as good as each of its parts: those are corners of the grid
    assert rows["metrics", "Ensemble", "pr_auc"] >= max(rows["metrics", m, "pr_auc"] for m in ("Isolation Forest", "Autoencoder", "XGBoost")) - 1e-9
    scorer.save(spark, str(tmp_path / "scorer"))
    again = Scorer.load(spark, str(tmp_path / "scorer"), LinearReconstruction)
    assert again.score(df).exceptAll(scorer.score(df)).count() == 0


def test_training_query_saves_what_it_trained(spark, sf_dir, monkeypatch):
    """As the method says: load, split, features, models, blend, evaluation, and everything saved."""
    from cardsentry.plans import catalog_models

    saved = []
    small = {"forest_options": {"trees": 5}, "boosted_options": {"rounds": 2}, "network": False}
    monkeypatch.setattr(catalog_models, "train", lambda df, **given: train(df, **small, **given))
    real = Scorer.save
    monkeypatch.setattr(Scorer, "save", lambda self, spark, path: (real(self, spark, path), saved.append((self, path))))
    rows = {(r["section"], r["model"], r["metric"]): r["value"] for r in catalog_models._train(spark, sf_dir).collect()}
    (scorer, path), = saved
    df = transactions(spark, sf_dir)
    assert Scorer.load(spark, path, LinearReconstruction).score(df).exceptAll(scorer.score(df)).count() == 0
    parts = [rows["sizes", part, "rows"] for part in ("train", "validation", "test")]
    assert rows["sizes", "all", "rows"] == sum(parts) == df.count()
    assert spark.read.parquet(f"{path}/evaluation").count() == len(rows)


def test_a_network_step_leaves_nothing_for_the_next_one():
    """Arrays are used again by the next batch, also by a shorter one, without changing it."""
    from cardsentry.models.reconstruction import Network

    x = np.random.default_rng(1).random((700, 3))
    kept, fresh = Network([3, 8, 4, 3], 7), Network([3, 8, 4, 3], 7)
    rngs = np.random.default_rng(5), np.random.default_rng(5)
    for t, (a, b) in enumerate([(0, 256), (256, 300), (300, 556), (556, 700)], 1):
        fresh._held = None
        losses = [net.step(x[a:b], rng, 1e-3, t, 0.2) for net, rng in zip((kept, fresh), rngs, strict=True)]
        assert losses[0] == losses[1]
    assert (kept.state() == fresh.state()).all()
    assert kept._room(100)[0][0].base is kept._held[0][0]


def test_boosted_rows_are_stored_in_blocks(spark, monkeypatch):
    """Not row by row: every level of every tree reads them."""
    from cardsentry.models import boosted

    stored, real = [], boosted.materialise
    monkeypatch.setattr(boosted, "materialise", lambda df: stored.append(real(df)) or stored[-1])
    df = spark.range(5_000).select(F.col("id").cast("double").alias("a"), F.pmod("id", F.lit(7)).cast("double").alias("b"), (F.col("id") > 4_000).cast("int").alias("is_fraud"))
    model = BoostedTrees.fit(df.coalesce(2), ["a", "b"], rounds=7)
    assert len(model.trees) == 7 and stored and all(s.count() <= 4 for s in stored)


def test_margins_that_were_carried_on_leave_nothing_behind(spark, points, monkeypatch):
    from pathlib import Path

    from cardsentry.models import boosted

    real, folders = boosted.materialise, []

    def seen(df):
        out = real(df)
        folders.append(Path(out._jdf.queryExecution().analyzed().rdd().getCheckpointFile().get().removeprefix("file:")))
        assert folders[-1].exists()
        return out

    monkeypatch.setattr(boosted, "materialise", seen)
    model = BoostedTrees.fit(points, FEATURES, points, rounds=12, step=0.3)  # carried on twice
    assert len(model.trees) == 12 and len(folders) == 6
    assert not any(f.exists() for f in folders)
