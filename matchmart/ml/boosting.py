"""Three-class boosted trees on gradient histograms, calibration, importances.

One softmax model: every round grows one tree per class from the gradients of
all three classes, and several models (the folds of a cross-validation) advance
together.  ``gang`` grows them in one stage; where that cannot run, a tree level of
all models and classes is one Spark job:

* the features are cut into at most ``MAX_BINS`` bins once, at quantiles, and a
  row keeps its bin numbers, label, fold and scores;
* each task adds up the gradients and hessians of its rows by (tree, node,
  feature, bin); the sums are combined in a reduction tree over the executors,
  and one array, whose size depends on trees, nodes, features and bins but not
  on the rows, reaches the driver, which chooses the splits;
* of two siblings only the lighter one (hessian, so about its rows) is counted, the other is the
  parent minus it; the last level needs no pass, its leaves follow from the sums.

Scores are cached once in ``SCORE_ROUNDS`` rounds; a level job adds the trees since
then on the fly.  Every ``CHECKPOINT_ROUNDS`` rounds they are written to the shared
checkpoint folder, so a lost executor costs the rounds since then.  Gradients are added as integers (``1 / UNIT``), so sums do
not depend on the order or number of tasks: the same rows give the same trees.

A fitted model is two small tables (:class:`Booster`), tree nodes and calibration
steps, so it can be stored, read in another session and scored there.  They hold at most trees x 2 ** (depth + 1) rows, which is what scoring ships.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field, replace
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ship_package
from ..sources.scan import FEATURE_COLUMNS
from . import gang

# The reference's booster settings (trees, depth, rate, row sample,
# column sample, least hessian per child, least gain, L1, L2, seed).
N_TREES = 300
MAX_DEPTH = 6
LEARNING_RATE = 0.05
SUBSAMPLE = 0.8
COLSAMPLE = 0.8
MIN_CHILD_WEIGHT = 3.0
GAMMA = 0.1
ALPHA = 0.1
LAMBDA = 1.0
SEED = 42
CLASSES = 3
SIDES = ("home", "draw", "away")

MAX_BINS = 64
EDGE_ROWS = 100_000
CHUNK_ROWS = 50_000
PART_ROWS = 8_000
TASK_ROWS = 100_000
SCORE_ROUNDS = 2
CHECKPOINT_ROUNDS = 20
UNIT = 1 << 30
_COMPARED_LEVELS = 3
_LEAST_GAIN = 1e-6

_CHUNK = "n int, bins binary, label binary, fold binary, row_key binary"
NODE_SCHEMA = ("model int, round int, class int, node int, feature string, threshold double, weight double, "
               "gain double, cover double")
STEP_SCHEMA = "class int, boundary double, probability double"


@dataclass(frozen=True)
class Settings:
    n_trees: int = N_TREES
    max_depth: int = MAX_DEPTH
    learning_rate: float = LEARNING_RATE
    subsample: float = SUBSAMPLE
    colsample: float = COLSAMPLE
    min_child_weight: float = MIN_CHILD_WEIGHT
    gamma: float = GAMMA
    alpha: float = ALPHA
    reg_lambda: float = LAMBDA
    max_bins: int = MAX_BINS
    seed: int = SEED


@dataclass
class Booster:
    """A fitted model: node rows (``NODE_SCHEMA``; leaves have no feature) and calibration steps."""
    nodes: pd.DataFrame
    features: list = field(default_factory=lambda: list(FEATURE_COLUMNS))
    steps: pd.DataFrame | None = None

    def raw(self) -> Booster:
        return replace(self, steps=None)


# --- binning ------------------------------------------------------------------------------------

def bin_edges(rows: DataFrame, features: list[str], max_bins: int = MAX_BINS, row_key: str = "fixture_id",
              edge_rows: int = EDGE_ROWS) -> list[np.ndarray]:
    """Rising cut values per feature (at most ``max_bins - 1``); a value's bin is the number of edges below it.

    They are quantiles of about ``edge_rows`` rows, drawn by a hash of their key, or of all rows
    where there are no more; so they do not depend on how the rows are dealt."""
    share = min(1.0, edge_rows / max(rows.count(), 1))
    drawn = rows.where(F.pmod(F.xxhash64(row_key, F.lit("edges")), F.lit(1 << 30)) < int(share * (1 << 30)))
    sample = drawn.select(*[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in features]).toPandas()
    shares = np.arange(1, max_bins) / max_bins
    return [np.unique(np.quantile(sample[c], shares, method="inverted_cdf")) if len(sample) else np.zeros(0)
            for c in features]


def _parts(rows: int, cores: int) -> int:
    """Thousands of short jobs follow: no more tasks than the rows are worth, and whole waves of the
    cores (a part has ``TASK_ROWS`` rows at most, about 30 bytes a row and 24 for each model)."""
    waves = max(1, -(-rows // (cores * TASK_ROWS)))
    return max(1, min(-(-rows // PART_ROWS), cores * waves))


def _chunks(rows: DataFrame, features: list[str], edges: list[np.ndarray], row_key: str, fold: str | None, parts: int) -> DataFrame:
    """Rows as blocks of bins, labels, folds and row keys, ``CHUNK_ROWS`` at most in one."""
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for whole in frames:
            for a in range(0, len(whole), CHUNK_ROWS):
                f = whole.iloc[a:a + CHUNK_ROWS]
                bins = np.stack([np.searchsorted(e, f[c].to_numpy(float), "left") for c, e in zip(features, edges)], 1)
                yield pd.DataFrame({"n": [len(f)], "bins": [bins.T.astype(np.uint8, "C").tobytes()],
                                    "label": [f["label"].to_numpy(np.int8).tobytes()],
                                    "fold": [f["fold"].to_numpy(np.int16).tobytes()],
                                    "row_key": [f["row_key"].to_numpy(np.int64).tobytes()]})
    return rows.select(
        *[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in features],
        F.col("label").cast("int").alias("label"), (F.col(fold) if fold else F.lit(-1)).cast("int").alias("fold"),
        F.xxhash64(row_key).alias("row_key")).repartition(parts, "row_key").mapInPandas(run, _CHUNK)


# --- rows inside a task -----------------------------------------------------------------------

class _Block:
    """A block of rows: bins [features, n], label, fold, key, scores [n, models, classes]."""

    def __init__(self, bins, label, fold, key, scores):
        self.bins, self.label, self.fold, self.key, self.scores = bins, label, fold, key, scores

    @classmethod
    def of(cls, row, n_features: int, models: int) -> _Block:
        return cls(np.frombuffer(row.bins, np.uint8).reshape(n_features, row.n), np.frombuffer(row.label, np.int8),
                   np.frombuffer(row.fold, np.int16), np.frombuffer(row.row_key, np.int64),
                   np.full((row.n, models, CLASSES), 0.5))


def _places(bins: np.ndarray, split: np.ndarray, depth: int) -> np.ndarray:
    """The place of each row among the ``2 ** depth`` nodes of a level; ``split`` [nodes, 2] holds feature (-1: none)
    and bin by heap node.  A row that ended in a leaf above takes the left way below it, where no node is."""
    at = np.zeros(bins.shape[1], np.uint8 if depth <= 8 else np.int64)
    for level in range(depth):
        right = np.zeros(bins.shape[1], bool)
        for place, (feature, cut) in enumerate(split[2 ** level - 1:2 ** (level + 1) - 1].tolist()):
            if feature >= 0:  # comparing whole columns of bytes is quicker than looking up each row's node
                own = bins[feature] > cut
                own &= at == place
                right |= own
        at += at
        at += right
    return at


def _reached(split: np.ndarray, depth: int) -> np.ndarray:
    """Which places of a level have a node: those below no leaf."""
    at = np.ones(1, bool)
    for level in range(depth):
        at = np.repeat(at & (split[2 ** level - 1:2 ** (level + 1) - 1, 0] >= 0), 2)
    return at


def _leaf_weights(split: np.ndarray, weights: np.ndarray, depth: int) -> np.ndarray:
    """The weight by place at ``depth``; a leaf above hands its weight down."""
    own = weights.copy()
    for n in range(2 ** depth - 1):
        if split[n, 0] < 0:
            own[2 * n + 1] = own[2 * n + 2] = own[n]
    return own[2 ** depth - 1:2 ** (depth + 1) - 1]


def _drawn(key: np.ndarray, seed: int, tree: int, share: float) -> np.ndarray:
    """Which rows a tree sees: by their key, the same on every attempt."""
    if share >= 1.0:
        return np.ones(len(key), bool)
    x = key.astype(np.uint64) ^ np.uint64((seed * 0x9E3779B97F4A7C15 + tree * 0xD1B54A32D192ED03) % 2**64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return (x ^ (x >> np.uint64(31))) < np.uint64(int(share * 2**64))


def probabilities(scores: np.ndarray) -> np.ndarray:
    """The softmax of the scores [rows, classes], as [classes, rows]."""
    z = np.ascontiguousarray(scores.T)
    e = np.exp(z - z.max(0))
    return e / (e[0] + e[1] + e[2])


def gradients(p: np.ndarray, own: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Gradients and hessians of a class from its probabilities and its rows (``own``), as whole numbers of 1 / UNIT."""
    return np.rint((p - own) * UNIT), np.rint(np.maximum(2 * p * (1 - p), 1e-16) * UNIT)


def _histograms(block: _Block, splits: np.ndarray, slots: np.ndarray, columns: np.ndarray, round_: int, depth: int,
                bins: int, width: int, s: Settings) -> np.ndarray:
    """[trees, width, columns, bins, 2] sums (gradient, hessian) of one block.

    ``slots`` [trees, nodes] gives the place of each node that is counted, -1 for others; ``columns``
    [trees, columns] the features a tree may use.
    """
    trees, used = columns.shape
    out = np.zeros((trees, width, used, bins, 2), np.int64)
    drawn = [_drawn(block.key, s.seed, round_ * CLASSES + c, s.subsample) for c in range(CLASSES)]
    for m in range(trees // CLASSES):
        if slots[m * CLASSES:(m + 1) * CLASSES].max() < 0:
            continue
        p = probabilities(block.scores[:, m])
        mine = block.fold != m
        for c in range(CLASSES):
            t = m * CLASSES + c
            if slots[t].max() < 0:
                continue
            level = np.where(_reached(splits[t], depth), slots[t][2 ** depth - 1:2 ** (depth + 1) - 1], -1)
            place = _places(block.bins, splits[t], depth).astype(np.int64)  # a byte is slow to look up by
            rows = np.flatnonzero((level >= 0).take(place) & drawn[c] & mine)
            first = (level * bins).take(place.take(rows))
            weights = gradients(p[c].take(rows), block.label.take(rows) == c)
            for j, column in enumerate(columns[t]):
                cell = first + block.bins[column].take(rows)
                for k, weight in enumerate(weights):
                    # Sums of integers below 2**53 are exact in the doubles that bincount adds.
                    out[t, :, j, :, k] = np.bincount(cell, weight, width * bins).reshape(width, bins)
    return out


def _renewed(block: _Block, rounds, depth: int) -> _Block:
    """The block with the scores after some more ``rounds`` (splits and weights of each)."""
    if not rounds:
        return block
    scores = block.scores.copy()
    for splits, weights in rounds:
        for t in range(len(splits)):
            step = _leaf_weights(splits[t], weights[t], depth)
            scores[:, t // CLASSES, t % CLASSES] += step.take(_places(block.bins, splits[t], depth).astype(np.int64))
    return _Block(block.bins, block.label, block.fold, block.key, scores)


# --- splits on the driver ---------------------------------------------------------------------

def _shrunk(g: np.ndarray, alpha: float) -> np.ndarray:
    return np.sign(g) * np.maximum(np.abs(g) - alpha, 0.0)


def best_splits(hist: np.ndarray, columns: np.ndarray, s: Settings):
    """Per node of ``hist`` [nodes, columns, bins, 2]: gain, feature, bin (first best in column, bin order), weight
    and hessian; a gain under the least allowed is -inf.  ``columns`` are those of all nodes, or a row for each."""
    g, h = hist[..., 0] / UNIT, hist[..., 1] / UNIT
    total_g, total_h = g[:, 0].sum(-1), h[:, 0].sum(-1)
    left_g, left_h = np.cumsum(g, -1)[..., :-1], np.cumsum(h, -1)[..., :-1]
    right_g, right_h = total_g[:, None, None] - left_g, total_h[:, None, None] - left_h

    def part(x, y):
        return _shrunk(x, s.alpha) ** 2 / (y + s.reg_lambda)

    gain = part(left_g, left_h) + part(right_g, right_h) - part(total_g, total_h)[:, None, None]
    gain[(left_h < s.min_child_weight) | (right_h < s.min_child_weight)] = -np.inf
    gain[gain < max(s.gamma, _LEAST_GAIN)] = -np.inf
    flat = gain.reshape(len(hist), -1)
    at = flat.argmax(1)
    best = flat[np.arange(len(hist)), at]
    column, cut = np.divmod(at, gain.shape[-1])
    weight = -_shrunk(total_g, s.alpha) / (total_h + s.reg_lambda) * s.learning_rate
    return best, columns[column] if columns.ndim == 1 else columns[np.arange(len(hist)), column], cut, weight, total_h


def tree_columns(n_features: int, trees: int, round_: int, s: Settings) -> np.ndarray:
    """The features each tree of a round may use: the same share of them for every tree, by the seed."""
    k = max(1, int(s.colsample * n_features))
    draws = [np.random.default_rng([s.seed, round_, t % CLASSES]).permutation(n_features)[:k] for t in range(trees)]
    return np.sort(np.array(draws), 1)


def growth(trees: int, columns: np.ndarray, s: Settings):
    """Grows trees side by side: a generator that asks for the sums of a level (splits and slots by tree and heap
    node, depth, most nodes counted in a tree), is sent them as [trees, nodes, columns, bins, 2], and returns
    splits, leaf weights, gains and hessians by heap node.  ``columns``: those of each tree."""
    size = 2 ** (s.max_depth + 1) - 1
    splits = np.full((trees, size, 2), -1, np.int64)
    weights, gains, covers = np.zeros((trees, size)), np.zeros((trees, size)), np.zeros((trees, size))
    # What is counted (tree, node), and for its sibling the sums of their parent.
    tree, node, parents = np.arange(trees), np.zeros(trees, np.int64), None
    for depth in range(s.max_depth):
        if not len(tree):
            break
        held = np.bincount(tree, minlength=trees)
        slot = np.arange(len(tree)) - (np.cumsum(held) - held)[tree]  # they are in the order of the trees
        slots = np.full((trees, size), -1, np.int64)
        slots[tree, node] = slot
        hist = (yield splits, slots, depth, int(held.max()))[tree, slot]
        if parents is not None:
            hist = np.concatenate([hist, parents - hist])
            tree, node = np.tile(tree, 2), np.concatenate([node, ((node - 1) ^ 1) + 1])
        gain, feature, cut, weight, cover = best_splits(hist, columns[tree], s)
        weights[tree, node], covers[tree, node] = weight, cover
        found = np.flatnonzero(np.isfinite(gain))
        found = found[np.lexsort((node[found], tree[found]))]
        tree, node, feature, cut, hist = tree[found], node[found], feature[found], cut[found], hist[found]
        splits[tree, node, 0], splits[tree, node, 1], gains[tree, node] = feature, cut, gain[found]
        at = np.arange(len(found))
        cells = np.cumsum(hist[at, (columns[tree] == feature[:, None]).argmax(1)], 1)
        left = cells[at, cut]
        right = cells[:, -1] - left
        for child, part in ((2 * node + 1, left), (2 * node + 2, right)):
            weights[tree, child] = (-_shrunk(part[:, 0] / UNIT, s.alpha) / (part[:, 1] / UNIT + s.reg_lambda)
                                    * s.learning_rate)
            covers[tree, child] = part[:, 1] / UNIT
        node, parents = np.where(left[:, 1] <= right[:, 1], 2 * node + 1, 2 * node + 2), hist
    return splits, weights, gains, covers


def _grow(state, n_features: int, bins: np.ndarray, models: int, round_: int, s: Settings, rounds=()):
    """One tree per model and class; returns splits, leaf weights, gains and hessians by heap node.

    ``bins``: of each feature; ``rounds``: the trees whose weights are not in the scores of ``state`` yet."""
    columns = tree_columns(n_features, models * CLASSES, round_, s)
    grower = growth(models * CLASSES, columns, s)
    try:
        asked = next(grower)
        while True:
            splits, slots, depth, width = asked
            asked = grower.send(_summed(state, (splits, slots, columns, round_, depth, bins, width, s, rounds)))
    except StopIteration as end:
        return end.value


def _summed(state, task) -> np.ndarray:
    splits, slots, columns, round_, depth, bins, width, s, rounds = task
    most = int(bins.max())
    used = np.arange(most) < bins[columns][..., None]  # a column with fewer bins sends no more

    def run(blocks):
        total = None
        for block in blocks:
            own = _histograms(_renewed(block, rounds, s.max_depth), splits, slots, columns, round_, depth, most, width, s)
            total = own if total is None else total + own
        if total is not None:
            yield total.swapaxes(1, 2).swapaxes(2, 3)[used]

    # Few partitions are added on the driver at once, many in a tree over the executors.
    sums, parts = state.mapPartitions(run), state.getNumPartitions()
    sent = reduce(np.add, sums.collect()) if parts <= 32 else sums.treeReduce(np.add, 2 if parts <= 1024 else 3)
    total = np.zeros((*used.shape, width, 2), np.int64)
    total[used] = sent
    return total.transpose(0, 3, 1, 2, 4)


# --- fitting ------------------------------------------------------------------------------------

def fit_boosters(train: DataFrame, features: list[str] | None = None, fold: str | None = None, models: int = 1,
                 row_key: str = "fixture_id", settings: Settings = Settings()):
    """``models`` boosters on ``label`` (0, 1, 2), advanced together; with ``fold`` (0 to models - 1),
    model m is fitted without the rows of fold m.  Returns the node table and the last scores (an RDD of blocks)."""
    feats, s = features or list(FEATURE_COLUMNS), settings
    if not 2 <= s.max_bins <= 256:
        raise ValueError("max_bins must be 2 to 256")
    ship_package(train.sparkSession)
    edges = bin_edges(train, feats, s.max_bins, row_key)
    bins = np.array([len(e) + 1 for e in edges])
    n_features, n, cores = len(feats), train.count(), train.sparkSession.sparkContext.defaultParallelism
    if not n:
        raise ValueError("no rows to train on")
    parts = _parts(n, cores)
    root = gang.folder(train.sparkSession, min(parts, cores)) if n <= cores * gang.TASK_ROWS else None
    if root:
        # A session may deal to more parts than asked for; a stage whose tasks meet needs a core for each.
        chunks = _chunks(train, feats, edges, row_key, fold, min(parts, cores)).coalesce(cores).checkpoint()
        trees, state = gang.fit(chunks, n_features, bins, models, s, root)
        return _node_frame([_node_rows(*t, round_, feats, edges) for round_, t in enumerate(trees)]), state
    chunks = _chunks(train, feats, edges, row_key, fold, parts).checkpoint()
    state = chunks.rdd.map(lambda row: _Block.of(row, n_features, models))
    state, older, rows, rounds, depth = state.persist(), [], [], [], s.max_depth
    for round_ in range(s.n_trees):
        splits, weights, gains, covers = _grow(state, n_features, bins, models, round_, s, rounds)
        rows.append(_node_rows(splits, weights, gains, covers, round_, feats, edges))
        rounds = [*rounds, (splits, weights)]
        if len(rounds) < SCORE_ROUNDS and round_ < s.n_trees - 1:
            continue
        older.append(state)
        state, rounds = state.map(lambda b, r=tuple(rounds): _renewed(b, r, depth)).persist(), []
        if round_ % CHECKPOINT_ROUNDS == CHECKPOINT_ROUNDS - 1:
            state.checkpoint()
            state.count()
        # The round before is still the parent of a state that no job has read yet.
        while len(older) > 1:
            older.pop(0).unpersist()
    return _node_frame(rows), state


def _node_frame(rounds: list[list[tuple]]) -> pd.DataFrame:
    return pd.DataFrame([row for rows in rounds for row in rows], columns=[x.split()[0] for x in NODE_SCHEMA.split(", ")])


def _node_rows(splits, weights, gains, covers, round_, feats, edges) -> list[tuple]:
    out = []
    for t in range(len(splits)):
        stack, split, weight, gain, cover = [0], *[x[t].tolist() for x in (splits, weights, gains, covers)]
        while stack:
            n = stack.pop()
            f, cut = split[n]
            model, cls = divmod(t, CLASSES)
            if f >= 0:
                out.append((model, round_, cls, n, feats[f], float(edges[f][cut]), 0.0, gain[n], cover[n]))
                stack += [2 * n + 1, 2 * n + 2]
            else:
                out.append((model, round_, cls, n, None, None, weight[n], 0.0, cover[n]))
    return out


def as_grown(nodes: pd.DataFrame) -> pd.DataFrame:
    """A node table in the order of its fit, which a stored table does not keep: by round, model and class,
    a node before its children, the right one first."""
    path = nodes["node"].map(lambda n: bin(int(n) + 1)[3:].translate({48: "b", 49: "a"}))
    return nodes.assign(_path=path).sort_values(["round", "model", "class", "_path"], ignore_index=True).drop(columns="_path")


def fit_booster(train: DataFrame, features: list[str] | None = None, settings: Settings = Settings()) -> Booster:
    """One booster on all rows of ``train``."""
    nodes, state = fit_boosters(train, features, settings=settings)
    state.unpersist()
    return Booster(nodes, features or list(FEATURE_COLUMNS))


def fold_accuracy(folded: DataFrame, n_splits: int = 5, features: list[str] | None = None,
                  settings: Settings = Settings()) -> DataFrame:
    """The accuracy on each fold of the model fitted without it (``fold``, ``n``, ``accuracy``)."""
    _, state = fit_boosters(folded, features, "fold", n_splits, settings=settings)

    def run(blocks):
        total = np.zeros((n_splits, 2), np.int64)
        for b in blocks:
            hit = b.scores[np.arange(len(b.fold)), b.fold].argmax(1) == b.label
            total[:, 0] += np.bincount(b.fold, minlength=n_splits)
            total[:, 1] += np.bincount(b.fold, hit, n_splits).astype(np.int64)
        yield total

    total = state.mapPartitions(run).treeReduce(np.add)
    state.unpersist()
    return folded.sparkSession.createDataFrame(
        [(i, int(n), float(hits) / float(n) if n else None) for i, (n, hits) in enumerate(total.tolist())],
        "fold int, n long, accuracy double")


# --- scoring ------------------------------------------------------------------------------------

class Scorer:
    """Scores raw feature values by the node table of one model.

    A feature's thresholds in the model cut its values into bins once; a tree then compares whole columns of bins."""

    def __init__(self, model: Booster, depth: int = MAX_DEPTH):
        nodes = model.nodes
        tree = nodes["round"].to_numpy(np.int64) * CLASSES + nodes["class"].to_numpy(np.int64)
        heap = nodes["node"].to_numpy(np.int64)
        depth = max(depth, int(np.log2(heap.max(initial=0) + 1)))
        trees, size = int(tree.max(initial=-1)) + 1, 2 ** (depth + 1) - 1
        place = {name: i for i, name in enumerate(model.features)}
        feature = nodes["feature"].map(place).fillna(-1).to_numpy(np.int64)
        threshold = nodes["threshold"].to_numpy(float)
        self.depth = depth
        self.cuts = [np.unique(threshold[feature == f]) for f in range(len(model.features))]
        cut = np.zeros(len(nodes), np.int64)
        for f, cuts in enumerate(self.cuts):
            cut[feature == f] = np.searchsorted(cuts, threshold[feature == f])
        self.splits, weight = np.full((trees, size, 2), -1, np.int64), np.zeros((trees, size))
        self.splits[tree, heap, 0], self.splits[tree, heap, 1] = feature, cut
        weight[tree, heap] = nodes["weight"].to_numpy(float)
        self.weight = np.array([_leaf_weights(t, w, depth) for t, w in zip(self.splits, weight)]).reshape(trees, 2 ** depth)

    def scores(self, x: np.ndarray) -> np.ndarray:
        out = np.full((CLASSES, len(x)), 0.5)
        kind = np.min_scalar_type(max(map(len, self.cuts), default=0))
        # A value that is no number is above no threshold.
        bins = np.array([np.where(np.isnan(column), 0, np.searchsorted(cuts, column, "left"))
                         for cuts, column in zip(self.cuts, x.T)], kind).reshape(len(self.cuts), len(x))
        rows, flat = np.arange(len(x)), bins.ravel()
        for t, (split, weight) in enumerate(zip(self.splits, self.weight)):
            out[t % CLASSES] += weight.take(self._leaves(bins, flat, rows, split))
        return out.T

    def _leaves(self, bins: np.ndarray, flat: np.ndarray, rows: np.ndarray, split: np.ndarray) -> np.ndarray:
        """The place of each row below the last level.  Of the upper levels whole columns are compared; further down,
        where a batch has few rows for each node, each row looks its node up."""
        upper = min(self.depth, _COMPARED_LEVELS)
        at = _places(bins, split, upper).astype(np.int64)
        for level in range(upper, self.depth):
            feature, cut = split[2 ** level - 1:2 ** (level + 1) - 1].T
            start, cut = np.maximum(feature, 0) * len(rows), np.where(feature >= 0, cut, np.iinfo(np.int64).max)
            right = flat.take(start.take(at) + rows) > cut.take(at)
            at += at
            at += right
        return at

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        z = self.scores(x)
        e = np.exp(z - z.max(1, keepdims=True))
        return e / e.sum(1, keepdims=True)


def predict_booster(model: Booster, df: DataFrame, prefix: str = "gb") -> DataFrame:
    """Class probabilities ``{prefix}_{home,draw,away}_prob``; missing features count as 0.

    Calibrated models replace each probability by its isotonic step function and
    divide by the sum (1/3 each when that is 0)."""
    ship_package(df.sparkSession)
    # A few tables of trees x nodes, whatever the data.
    shipped = df.sparkSession.sparkContext.broadcast(Scorer(model))

    @F.pandas_udf("array<double>")
    def score(*columns: pd.Series) -> pd.Series:
        x = np.stack([c.fillna(0.0).to_numpy(float) for c in columns], 1)
        return pd.Series(list(shipped.value.probabilities(x)))

    out = df.withColumn("_mm_p", score(*[F.col(c).cast("double") for c in model.features]))
    p = [F.col("_mm_p")[c] for c in range(CLASSES)]
    if model.steps is not None:
        p = [_step_column(model.steps[model.steps["class"] == c], p[c]) for c in range(CLASSES)]
        out = out.withColumns({f"_mm_{c}": p[c] for c in range(CLASSES)})
        p = [F.col(f"_mm_{c}") for c in range(CLASSES)]
    total = p[0] + p[1] + p[2]
    return out.withColumns({f"{prefix}_{s}_prob": F.when(total > 0, p[c] / total).otherwise(F.lit(1.0 / 3.0))
                            for c, s in enumerate(SIDES)}).drop("_mm_p", *[f"_mm_{c}" for c in range(CLASSES)])


def _step_column(steps: pd.DataFrame, score):
    """Linear between the boundaries, constant beyond them."""
    x, y = steps["boundary"].to_numpy(float), steps["probability"].to_numpy(float)

    @F.pandas_udf("double")
    def calibrated(s: pd.Series) -> pd.Series:
        return pd.Series(np.interp(s.to_numpy(float), x, y))

    return calibrated(score)


def calibrate(model: Booster, holdout: DataFrame) -> Booster:
    """Per-class isotonic regression of the probabilities on a held-out
    slice (the last part of the training period, not the test set)."""
    from pyspark.ml.regression import IsotonicRegression
    scored = predict_booster(model.raw(), holdout, "raw").select("label", *[f"raw_{x}_prob" for x in SIDES]).checkpoint()
    parts = []
    for c, side in enumerate(SIDES):
        fit = IsotonicRegression(featuresCol=f"raw_{side}_prob", labelCol="y", isotonic=True).fit(
            scored.withColumn("y", (F.col("label") == c).cast("double")))
        parts.append(pd.DataFrame({"class": c, "boundary": list(fit.boundaries), "probability": list(fit.predictions)}))
    return replace(model, steps=pd.concat(parts, ignore_index=True))


def node_table(spark: SparkSession, model: Booster) -> DataFrame:
    rows = model.nodes.astype(object).where(model.nodes.notna(), None).values.tolist()
    return spark.createDataFrame(rows, NODE_SCHEMA)


def feature_importance(model: Booster, spark: SparkSession) -> DataFrame:
    """Mean gain of a feature's splits over all trees, as a share of all features' sum, ranked."""
    names = spark.createDataFrame([(f,) for f in model.features], "feature string")
    gain = node_table(spark, model).where("feature is not null").groupBy("feature").agg(F.avg("gain").alias("gain"))
    total = gain.agg(F.sum("gain")).first()[0] or 1.0
    return names.join(gain, "feature", "left").select(
        "feature", F.coalesce(F.col("gain") / F.lit(total), F.lit(0.0)).alias("importance")).orderBy(
        F.col("importance").desc(), F.col("feature"))
