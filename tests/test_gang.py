"""The boosted trees of one stage whose tasks meet in the shared folder, against those of the level jobs."""
import gc
import json
import os
import shutil
import threading

import numpy as np
import pandas as pd
import pytest

from matchmart.ml import boosting as B
from matchmart.ml import gang as G

FEATURES = [f"x{i}" for i in range(5)]


@pytest.fixture(scope="module")
def table(spark):
    rng = np.random.default_rng(8)
    x = rng.normal(size=(40_000, 5)).round(1)
    f = pd.DataFrame(x, columns=FEATURES)
    f["label"] = np.digitize(x[:, 0] - x[:, 1] * x[:, 2] + rng.normal(size=len(x)), [-0.7, 0.7]).astype(float)
    f["fixture_id"], f["fold"] = np.arange(len(x)), np.arange(len(x)) % 5
    return spark.createDataFrame(f).repartition(7, "fixture_id").cache()


def fitted(table, fold, models, s):
    nodes, state = B.fit_boosters(table, FEATURES, fold, models, settings=s)
    blocks = state.map(lambda b: (b.key, b.label, b.fold, b.scores)).collect()
    parts = [np.concatenate([b[i] for b in blocks]) for i in range(4)]
    order = np.argsort(parts[0])
    return nodes, [p[order] for p in parts]


@pytest.mark.parametrize("fold, models", [(None, 1), ("fold", 5)])
def test_same_trees_and_scores_as_the_level_jobs(table, monkeypatch, fold, models):
    s = B.Settings(n_trees=5, max_depth=4, learning_rate=0.3)
    nodes, rows = fitted(table, fold, models, s)
    monkeypatch.setattr(G, "folder", lambda *a: None)
    expected, whole = fitted(table, fold, models, s)
    pd.testing.assert_frame_equal(nodes, expected)
    assert all(np.array_equal(a, b) for a, b in zip(rows, whole)) and len(rows[0]) == 40_000


def test_a_fit_is_a_few_jobs(spark, table):
    """300 rounds of six levels were 1,800 jobs, one after the other."""
    sc = spark.sparkContext
    sc.setJobGroup("fit", "fit")
    try:
        nodes = B.fit_booster(table, FEATURES, B.Settings(n_trees=8, max_depth=6)).nodes
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    assert nodes["round"].nunique() == 8 and len(sc.statusTracker().getJobIdsForGroup("fit")) <= 10


def test_where_the_folder_is_no_path_the_level_jobs_take_over(spark, monkeypatch):
    cores = spark.sparkContext.defaultParallelism
    found = G.folder(spark, cores)
    assert os.path.isdir(found) and G.folder(spark, cores + 1) is None
    os.rmdir(found)
    monkeypatch.setattr(G, "ensure_checkpoint_dir", lambda _: "hdfs://name/checkpoints")
    assert G.folder(spark, cores) is None


def test_files_go(spark, table, monkeypatch):
    roots, folder = [], G.folder

    def seen(*a):
        roots.append(folder(*a))
        return roots[-1]

    monkeypatch.setattr(G, "folder", seen)
    nodes, state = B.fit_boosters(table, FEATURES, settings=B.Settings(n_trees=3, max_depth=3))
    left = [x for d, _, names in os.walk(roots[0]) for x in names if not x.startswith("s")]
    assert len(left) <= 3 and state.map(lambda b: len(b.label)).sum() == 40_000  # three trees say they are done
    del state
    gc.collect()
    assert not os.path.exists(roots[0])


BINS = np.array([9, 64, 3, 30])


def tasks_rows(tasks: int, models: int) -> list[B._Block]:
    rng = np.random.default_rng(3)
    n = 3_000
    bins = np.stack([rng.integers(0, b, n) for b in BINS]).astype(np.uint8)
    label = ((bins[0] > 4).astype(int) + (bins[1] + rng.integers(0, 30, n) > 40)).astype(np.int8)
    fold = rng.integers(0, models, n).astype(np.int16) if models > 1 else np.full(n, -1, np.int16)
    key, at = rng.integers(0, 2**62, n), rng.integers(0, max(tasks - 1, 1), n)  # the last of several has no rows
    return [B._Block(bins[:, at == t], label[at == t], fold[at == t], key[at == t], None) for t in range(tasks)]


def stage(root, tasks: int, models: int, s) -> dict[str, bytes]:
    """All tasks side by side in threads; the trees as they were written."""
    said, barrier, failed = [None] * tasks, threading.Barrier(tasks), []

    def run(me, block):
        def meet(text):
            said[me] = text
            barrier.wait(60)
            return list(said)

        try:
            G.run_task([block] if len(block.label) else [], me, tasks, str(root), len(BINS), BINS, models, s, meet)
        except BaseException as x:
            failed.append(x)
            raise

    threads = [threading.Thread(target=run, args=(t, b), daemon=True) for t, b in enumerate(tasks_rows(tasks, models))]
    for t in threads:
        t.start()
    for t in threads:
        t.join(120)
    assert not failed and not any(t.is_alive() for t in threads)
    return {x: (root / x).read_bytes() for x in sorted(os.listdir(root)) if x.startswith("t") and not x.startswith("try")}


def trees(logs: dict[str, bytes], tasks: int, models: int, s) -> list:
    """By round, the arrays of all trees, whoever their owners were."""
    size, out = 2 ** (s.max_depth + 1) - 1, []
    for r in range(s.n_trees):
        by_tree = {}
        for o, own in enumerate(G._owners(tasks, models * 3)):
            for t, *arrays in zip(own, *G._tree_arrays(logs[f"t{r}_{o}"], len(own), size)):
                by_tree[t] = arrays
        out.append([np.stack([by_tree[t][i] for t in sorted(by_tree)]) for i in range(4)])
    return out


@pytest.mark.parametrize("models", [1, 3])
def test_trees_do_not_depend_on_tasks_memory_or_cells(tmp_path, monkeypatch, models):
    s = B.Settings(n_trees=4, max_depth=5, learning_rate=0.3)
    one = None
    for tasks, memory, cells in ((1, 1 << 20, 1_024), (5, 1 << 20, 100_000), (4, 0, 64)):
        monkeypatch.setattr(G, "MEMORY_BYTES", memory)
        monkeypatch.setattr(G, "CELLS", cells)
        root = tmp_path / f"{tasks}"
        root.mkdir()
        got = trees(stage(root, tasks, models, s), tasks, models, s)
        one = one or got
        assert all(np.array_equal(a, b) for x, y in zip(one, got) for a, b in zip(x, y))
    assert (one[0][0][:, 0, 0] >= 0).any()


def test_a_new_attempt_goes_on_from_the_rounds_that_are_complete(tmp_path, monkeypatch):
    s = B.Settings(n_trees=5, max_depth=4, learning_rate=0.3)
    first, again = tmp_path / "first", tmp_path / "again"
    first.mkdir()
    again.mkdir()
    whole = stage(first, 3, 2, s)
    for name in whole:
        if name[1] in "012" or name == "t3_1":  # round 3 is not complete
            shutil.copy(first / name, again / name)
    begun, begin = [], G.Rows.begin
    monkeypatch.setattr(G.Rows, "begin", lambda self, r: (begun.append(r), begin(self, r)))
    assert stage(again, 3, 2, s) == whole and sorted(set(begun)) == [3, 4]


def test_tasks_agree_on_the_round_they_go_on_from(tmp_path, monkeypatch):
    """A task of the attempt before may complete a round while those of the next one look."""
    s = B.Settings(n_trees=3, max_depth=3)
    first, again = tmp_path / "first", tmp_path / "again"
    first.mkdir()
    again.mkdir()
    whole = stage(first, 2, 1, s)
    for name in whole:
        if name[1] == "0":
            shutil.copy(first / name, again / name)
    loads = json.loads

    def behind(text):
        name, done = loads(text)
        return [name, 0 if done else done]

    monkeypatch.setattr(G.json, "loads", behind)
    assert stage(again, 2, 1, s) == whole


def test_columns_counted_together_hold_few_cells():
    bins = np.array([14, 22, 18, 7, 26, 64, 64, 256])
    for rows in (100, 10_000, 10**6):
        groups = G.column_groups(bins, rows)
        assert sorted(c for g in groups for c in g) == list(range(8))
        assert all(np.prod(bins[g]) <= G.CELLS for g in groups if len(g) > 1)
    assert len(G.column_groups(bins, 10**6)) < 6


def test_scores_walk_the_trees_row_by_row():
    rng = np.random.default_rng(4)
    rows = []
    for tree in range(9):
        stack = [0]
        while stack:
            n = stack.pop()
            if n < 15 and rng.random() < 0.8:
                rows.append((0, tree // 3, tree % 3, n, FEATURES[rng.integers(0, 4)], float(rng.integers(-3, 4)) / 2, 0.0, 1.0, 1.0))
                stack += [2 * n + 1, 2 * n + 2]
            else:
                rows.append((0, tree // 3, tree % 3, n, None, None, rng.normal(), 0.0, 1.0))
    nodes = pd.DataFrame(rows, columns=[x.split()[0] for x in B.NODE_SCHEMA.split(", ")])
    x = rng.integers(-4, 5, (300, 5)) / 2
    x[rng.random(x.shape) < 0.05] = np.nan
    x[0], x[1] = np.inf, -np.inf
    scorer = B.Scorer(B.Booster(nodes, FEATURES))
    want = np.full((300, 3), 0.5)
    for (tree, c), own in nodes.groupby(["round", "class"], sort=True):
        at = own.set_index("node")
        for r in range(300):
            n = 0
            while isinstance(at.at[n, "feature"], str):
                n = 2 * n + 1 + int(x[r, FEATURES.index(at.at[n, "feature"])] > at.at[n, "threshold"])
            want[r, c] += at.at[n, "weight"]
    assert np.array_equal(scorer.scores(x), want)
    assert scorer.scores(x[:0]).shape == (0, 3) and all(len(c) <= 7 for c in scorer.cuts)
