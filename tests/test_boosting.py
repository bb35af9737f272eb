"""The histogram booster against a plain one, its folds, tables and determinism."""
import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from matchmart.ml import boosting as B

FEATURES = [f"x{i}" for i in range(5)]


@pytest.fixture(scope="module")
def frame():
    rng = np.random.default_rng(8)
    x = rng.normal(size=(500, 5)).round(2)
    z = x[:, 0] * 1.5 - x[:, 1] + 0.8 * x[:, 2] * x[:, 3] + rng.normal(size=500) * 0.5
    f = pd.DataFrame(x, columns=FEATURES)
    f["label"] = np.digitize(z, [-0.7, 0.7]).astype(float)
    f["fixture_id"] = np.arange(500) + 10_000
    f["fold"] = np.arange(500) % 5
    return f


@pytest.fixture(scope="module")
def table(spark, frame):
    return spark.createDataFrame(frame).repartition(7, "fixture_id").cache()


def keys(table):
    rows = table.select("fixture_id", F.xxhash64("fixture_id").alias("k")).collect()
    return {r.fixture_id: r.k for r in rows}


def plain_booster(f, key, edges, s, left_out=None):
    """Trees grown row by row from the definition: softmax gradients, all cuts of all allowed columns."""
    x, y = f[FEATURES].to_numpy(), f["label"].to_numpy(int)
    use = np.ones(len(f), bool) if left_out is None else (f["fold"] != left_out).to_numpy()
    score = np.full((len(f), 3), 0.5)

    def shrunk(v):
        return np.sign(v) * max(abs(v) - s.alpha, 0.0)

    for round_ in range(s.n_trees):
        p = np.exp(score) / np.exp(score).sum(1, keepdims=True)
        columns = B.tree_columns(len(FEATURES), 3, round_, s)
        step = np.zeros_like(score)
        for c in range(3):
            g, h = p[:, c] - (y == c), 2 * p[:, c] * (1 - p[:, c])
            seen = use & B._drawn(key, s.seed, round_ * 3 + c, s.subsample)

            def grow(inside, depth):
                mine = inside & seen
                total_g, total_h = g[mine].sum(), h[mine].sum()
                best = (max(s.gamma, 1e-6) - 1e-9, None, None)
                for j in columns[c] if depth < s.max_depth else ():
                    for edge in edges[j]:
                        left = mine & (x[:, j] <= edge)
                        lg, lh = g[left].sum(), h[left].sum()
                        rg, rh = total_g - lg, total_h - lh
                        if lh < s.min_child_weight or rh < s.min_child_weight:
                            continue
                        gain = (shrunk(lg) ** 2 / (lh + s.reg_lambda) + shrunk(rg) ** 2 / (rh + s.reg_lambda)
                                - shrunk(total_g) ** 2 / (total_h + s.reg_lambda))
                        if gain > best[0] + 1e-7:
                            best = (gain, j, edge)
                if best[1] is None:
                    step[inside, c] = -shrunk(total_g) / (total_h + s.reg_lambda) * s.learning_rate
                    return
                left = x[:, best[1]] <= best[2]
                grow(inside & left, depth + 1)
                grow(inside & ~left, depth + 1)

            grow(np.ones(len(f), bool), 0)
        score += step
    return np.exp(score) / np.exp(score).sum(1, keepdims=True)


def test_equals_a_plain_booster(spark, frame, table):
    s = B.Settings(n_trees=12, max_depth=4, learning_rate=0.3, max_bins=16)
    model = B.fit_booster(table, FEATURES, s)
    key = frame["fixture_id"].map(keys(table)).to_numpy()
    expected = plain_booster(frame, key, B.bin_edges(table, FEATURES, 16), s)
    got = B.Scorer(model).probabilities(frame[FEATURES].to_numpy())
    assert np.abs(got - expected).max() < 1e-6
    by_spark = B.predict_booster(model, table).toPandas().set_index("fixture_id").loc[frame["fixture_id"]]
    assert np.abs(by_spark[[f"gb_{x}_prob" for x in B.SIDES]].to_numpy() - expected).max() < 1e-6


def test_folds_advance_together(spark, frame, table):
    s = B.Settings(n_trees=6, max_depth=3, learning_rate=0.4, max_bins=16)
    got = {r.fold: (r.n, r.accuracy) for r in B.fold_accuracy(table, 5, FEATURES, s).collect()}
    key = frame["fixture_id"].map(keys(table)).to_numpy()
    edges = B.bin_edges(table, FEATURES, 16)
    for fold in range(5):
        p = plain_booster(frame, key, edges, s, fold)
        mine = (frame["fold"] == fold).to_numpy()
        assert got[fold] == (100, (p[mine].argmax(1) == frame["label"][mine]).mean())


def test_same_rows_give_the_same_trees(spark, table):
    s = B.Settings(n_trees=25, max_depth=4)  # more rounds than lie between two checkpoints
    one = B.fit_booster(table, FEATURES, s).nodes
    two = B.fit_booster(table.repartition(3).sortWithinPartitions("x1"), FEATURES, s).nodes
    key = ["round", "class", "node"]
    pd.testing.assert_frame_equal(one.sort_values(key, ignore_index=True), two.sort_values(key, ignore_index=True))


def test_booster_learns(spark, frame, table):
    model = B.fit_booster(table.where("fixture_id % 5 <> 0"), FEATURES, B.Settings(n_trees=60))
    assert model.nodes["round"].max() == 59 and model.nodes["node"].max() < 127
    rest = frame[frame["fixture_id"] % 5 == 0]
    p = B.Scorer(model).probabilities(rest[FEATURES].to_numpy())
    most_common = rest["label"].value_counts(normalize=True).max()
    assert (p.argmax(1) == rest["label"]).mean() > most_common + 0.15
    importance = {r.feature: r.importance for r in B.feature_importance(model, spark).collect()}
    assert abs(sum(importance.values()) - 1) < 1e-9 and min(importance, key=importance.get) == "x4"


def test_calibration_is_the_isotonic_fit(spark, frame, table):
    from pyspark.sql import functions as F
    s = B.Settings(n_trees=10, max_depth=3, learning_rate=0.3)
    model = B.calibrate(B.fit_booster(table.where("fold < 3"), FEATURES, s), table.where("fold >= 3"))
    raw = B.Scorer(model).probabilities(frame[FEATURES].to_numpy())
    part = (frame["fold"] >= 3).to_numpy()
    for c in range(3):
        # pool adjacent violators over equal scores
        pools = [[v, k, n] for v, (k, n) in sorted(
            pd.DataFrame({"v": raw[part, c], "y": frame["label"][part] == c}).groupby("v")["y"].agg(["sum", "count"])
            .apply(tuple, axis=1).items())]
        merged = []
        for v, k, n in pools:
            merged.append([k, n, v, v])
            while len(merged) > 1 and merged[-2][0] / merged[-2][1] >= merged[-1][0] / merged[-1][1]:
                k2, n2, _, hi = merged.pop()
                merged[-1] = [merged[-1][0] + k2, merged[-1][1] + n2, merged[-1][2], hi]
        own = model.steps[model.steps["class"] == c]
        got = np.interp([m[2] for m in merged], own["boundary"], own["probability"])
        assert np.abs(got - [m[0] / m[1] for m in merged]).max() < 1e-9
    out = B.predict_booster(model, table).select([F.expr("gb_home_prob + gb_draw_prob + gb_away_prob").alias("s")])
    assert all(abs(r.s - 1) < 1e-9 for r in out.collect())


def test_tasks_fill_whole_waves_of_the_cores(spark):
    """Thousands of jobs follow, so a level is not dealt to more tasks than cores, unless the rows need more waves."""
    assert [B._parts(n, 6) for n in (0, 5_000, 20_000, 48_000, 278_000, 600_000, 600_001)] == [1, 1, 3, 6, 6, 6, 12]
    rows = spark.range(40_000).selectExpr("id as fixture_id", "double(id % 97) as x0", "double(id % 3) as label")
    nodes, state = B.fit_boosters(rows, ["x0"], settings=B.Settings(n_trees=1, max_depth=1))
    assert state.getNumPartitions() == spark.sparkContext.defaultParallelism == 4
    assert state.map(lambda b: len(b.label)).sum() == 40_000 and len(nodes) >= 3


def test_level_sums_equal_a_plain_count():
    rng = np.random.default_rng(5)
    n, features, bins, depth = 700, 4, 8, 2
    s = B.Settings(max_depth=3, subsample=0.7)
    block = B._Block(rng.integers(0, bins, (features, n)).astype(np.uint8), rng.integers(0, 3, n).astype(np.int8),
                     (np.arange(n) % 2).astype(np.int16), rng.integers(0, 2**62, n), rng.normal(size=(n, 2, 3)))
    splits = np.full((6, 15, 2), -1, np.int64)
    splits[:, :3] = [(0, 3), (1, 2), (2, 5)]
    splits[4, 1] = -1  # a leaf above the level
    slots = np.full((6, 15), -1, np.int64)
    slots[:, [3, 6]] = (0, 1)
    slots[5] = -1  # a tree that is done
    columns = np.array([[0, 2, 3]] * 3 + [[1, 2, 3]] * 3)
    got = B._histograms(block, splits, slots, columns, 4, depth, bins, 2, s)
    want = np.zeros(got.shape, np.int64)
    assert want.shape == (6, 2, 3, bins, 2)
    for t in range(5):
        m, c = divmod(t, 3)
        seen = B._drawn(block.key, s.seed, 4 * 3 + c, s.subsample)
        for r in np.flatnonzero(seen & (block.fold != m)):
            node = 0
            for _ in range(depth):
                f, cut = splits[t, node]
                node = node if f < 0 else 2 * node + 1 + int(block.bins[f, r] > cut)
            if slots[t, node] < 0:
                continue
            e = np.exp(block.scores[r, m] - block.scores[r, m].max())
            p = (e / (e[0] + e[1] + e[2]))[c]
            for j, f in enumerate(columns[t]):
                want[t, slots[t, node], j, block.bins[f, r]] += (
                    round((p - (block.label[r] == c)) * B.UNIT), round(2 * p * (1 - p) * B.UNIT))
    assert np.abs(got - want).max() <= 2 and np.abs(want).max() > B.UNIT


def test_stored_model_scores_the_same_in_another_session(spark):
    from matchmart.ml import train as MT
    from matchmart.operators.sinks import TableStore
    from matchmart.plans.context import Context
    from matchmart.session import scratch_dir
    c = Context(spark, "/root/testdata/sf0.001")
    result = MT.train(c.fct_match_features, B.Settings(n_trees=8, max_depth=3))
    root = scratch_dir(spark, "models")
    MT.save_model(TableStore(spark, root), result)
    other = spark.newSession()
    found = MT.load_model(TableStore(other, root))
    assert found.model_version == result.model_version == MT.version_of(found.booster, found.poisson)
    columns = ["fixture_id", "home_team_id", "away_team_id", *result.booster.features]
    rows = result.test_scored.select(*columns)
    probs = [f"{m}_{s}_prob" for m in ("poisson", "gb", "hybrid") for s in B.SIDES]
    before = {r.fixture_id: [r[p] for p in probs] for r in MT.score(rows, result.poisson, result.booster).collect()}
    fresh = other.createDataFrame(rows.toPandas())
    after = {r.fixture_id: [r[p] for p in probs] for r in MT.score(fresh, found.poisson, found.booster).collect()}
    assert before.keys() == after.keys() and len(before) > 50
    assert max(abs(x - y) for k in before for x, y in zip(before[k], after[k])) < 1e-12
    assert MT.load_model(TableStore(other, root), "absent") is None


def test_stored_nodes_get_the_order_of_their_fit_back(spark, table):
    nodes = B.fit_booster(table, FEATURES, B.Settings(n_trees=3, max_depth=3)).nodes
    for seed in range(3):
        pd.testing.assert_frame_equal(B.as_grown(nodes.sample(frac=1, random_state=seed)), nodes)


def test_registered_queries_fit_the_whole_booster(spark, monkeypatch):
    """Every registered model has the reference's settings; the fit itself is tested above."""
    from matchmart.plans import queries as Q

    seen = []

    class Stop(Exception):
        pass

    def fit(train, features=None, fold=None, models=1, row_key="fixture_id", settings=B.Settings()):
        seen.append((settings.n_trees, settings.max_depth, models))
        raise Stop

    monkeypatch.setattr(B, "fit_boosters", fit)
    monkeypatch.setattr(Q, "_inputs_digest", lambda c: "never")
    for name in ("boosted_classifier", "kfold_accuracy"):
        with pytest.raises(Stop):
            Q.registry()[name](spark, "/root/testdata/sf0.001").collect()
    assert seen == [(300, 6, 1), (300, 6, 5)]


def test_places_follow_the_splits_row_by_row():
    rng = np.random.default_rng(9)
    bins = rng.integers(0, 8, (3, 200)).astype(np.uint8)
    for depth in (0, 1, 3, 9):
        split = np.full((2 ** (depth + 1) - 1, 2), -1, np.int64)
        split[:2 ** depth - 1] = np.stack([rng.integers(-1, 3, 2 ** depth - 1), rng.integers(0, 7, 2 ** depth - 1)], 1)
        for n in range(1, len(split)):  # there is no node below a leaf
            if split[(n - 1) // 2, 0] < 0:
                split[n] = -1
        weights = rng.normal(size=len(split))
        place, reached = B._places(bins, split, depth), B._reached(split, depth)
        at_leaf = B._leaf_weights(split, weights, depth)
        for r in range(200):
            node = 0
            for _ in range(depth):
                f, cut = split[node]
                node = 2 * node + 1 + int(bins[f, r] > cut) if f >= 0 else node
            last = node >= 2 ** depth - 1
            assert reached[place[r]] == last and at_leaf[place[r]] == weights[node]
            assert not last or place[r] == node - (2 ** depth - 1)


@pytest.mark.parametrize("rounds", [1, 3])
def test_trees_do_not_depend_on_when_scores_are_cached(spark, table, monkeypatch, rounds):
    """A level job adds the trees that are not in the cached scores yet, so not every round writes its scores."""
    s = B.Settings(n_trees=7, max_depth=3, learning_rate=0.3)
    usual = B.fit_booster(table, FEATURES, s).nodes
    usual_folds = B.fold_accuracy(table, 5, FEATURES, s).collect()
    monkeypatch.setattr(B, "SCORE_ROUNDS", rounds)
    pd.testing.assert_frame_equal(B.fit_booster(table, FEATURES, s).nodes, usual)
    assert B.fold_accuracy(table, 5, FEATURES, s).collect() == usual_folds


def test_columns_send_their_own_bins_only(table):
    """A column with few values sends few sums to the driver, beside one with many."""
    sent = []

    class State:
        def getNumPartitions(self):
            return 1

        def mapPartitions(self, run):
            n = 50
            block = B._Block(np.zeros((2, n), np.uint8), np.zeros(n, np.int8), np.full(n, -1, np.int16),
                             np.arange(n), np.full((n, 1, 3), 0.5))
            sent.extend(run([block]))
            return self

        def collect(self):
            return sent

    slots = np.zeros((3, 1), np.int64)
    task = (np.full((3, 1, 2), -1), slots, np.array([[0, 1]] * 3), 0, 0, np.array([2, 64]), 1, B.Settings(subsample=1.0), ())
    got = B._summed(State(), task)
    assert got.shape == (3, 1, 2, 64, 2) and sent[0].size == 3 * (2 + 64) * 2
    assert (got[:, 0, :, 0, 1] > 0).all() and not got[:, 0, :, 1:].any()


def test_training_reads_features_that_are_written_once(spark, monkeypatch):
    """The features are joined, cut and counted several times; their build is not in those plans."""
    from matchmart.ml import train as MT
    from matchmart.plans.context import Context

    class Stop(Exception):
        pass

    def split(df, *a):
        raise Stop(df._jdf.queryExecution().optimizedPlan().toString())

    monkeypatch.setattr(MT.FE, "temporal_split", split)
    with pytest.raises(Stop) as found:
        MT.train(Context(spark, "/root/testdata/sf0.001").fct_match_features)
    assert "parquet" not in str(found.value) and "LogicalRDD" in str(found.value)
