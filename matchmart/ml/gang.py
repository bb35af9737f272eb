"""Boosted trees grown in one Spark job, whose tasks keep their rows and meet in the shared folder.

A level of a tree needs the sums of all tasks, and the next level needs the splits.
With a job for each level (``boosting.fit_boosters`` without this module) that is
1,800 jobs in a row and the rows go to the Python workers in every one of them.  Here
the tasks of one barrier stage hold their rows and exchange these arrays as files of
the shared checkpoint folder, so a level costs the sums and two short waits:

* each tree of a round has an owner among the tasks; it grows the tree (``boosting.growth``)
  and publishes which nodes are to be counted, and in the end the tree;
* every task counts its rows for all trees and writes one file, of which each owner
  reads the part of its trees; its size follows from trees, nodes, features and bins.

A file goes when all have read it.  The finished trees stay until the fit is over: when
a task is lost, Spark starts the stage anew, and its tasks take the rounds that are
complete from there.  Sums are whole numbers, so the trees are those of the level jobs.

It needs a checkpoint folder that is a path on every machine (``file:``) and a core
for each task at once; :func:`folder` says None where that is not so, and the level
jobs take over.
"""

from __future__ import annotations

import json
import os
import pickle
import shutil
import tempfile
import time
import weakref
from collections.abc import Iterator
from urllib.parse import unquote, urlparse

import numpy as np
from pyspark import BarrierTaskContext
from pyspark.sql import SparkSession

from ..session import ensure_checkpoint_dir
from . import boosting as B

TASK_ROWS = 8_000_000  # more do not go into a task: sums stay below 2 ** 53
MEMORY_BYTES = 256 << 20  # of the growing part of a task's state; beyond it is in a file of the task's own
# What lies in a core's cache: rows counted at once, rows whose gradients are taken at once, cells counted in.
COUNT_ROWS = 1 << 16
GRADIENT_ROWS = 1 << 13
CELLS = 1_024
_PAUSE, _LONGEST_PAUSE = 0.0003, 0.005


# --- where it can run ---------------------------------------------------------------------------

def folder(spark: SparkSession, tasks: int) -> str | None:
    """A fresh folder that the driver and the tasks see, or None."""
    sc = spark.sparkContext
    where = urlparse(ensure_checkpoint_dir(spark))
    if where.scheme not in ("", "file") or tasks > sc.defaultParallelism \
            or sc.getConf().get("spark.dynamicAllocation.enabled", "false").lower() == "true":
        return None
    path = os.path.join(unquote(where.path), f"booster-{os.urandom(6).hex()}")
    try:
        os.makedirs(path)
    except OSError:
        return None
    if all(sc.parallelize(range(tasks), tasks).map(lambda _: os.access(path, os.W_OK)).collect()):
        return path
    os.rmdir(path)
    return None


# --- files --------------------------------------------------------------------------------------

def _put(path: str, parts: list[bytes]) -> None:
    with open(f"{path}~", "wb") as f:
        f.writelines(parts)
    os.rename(f"{path}~", path)


def _wait(path: str, parent: int):
    """The open file, as soon as it is there.  Spark ends this process when another task fails."""
    pause = _PAUSE
    while True:
        try:
            return open(path, "rb")
        except FileNotFoundError:
            if os.getppid() != parent:
                raise RuntimeError("the executor is gone") from None
            time.sleep(pause)
            pause = min(pause * 1.2, _LONGEST_PAUSE)


def _room(shape: tuple, kind, limit: int) -> np.ndarray:
    """Zeros in memory, or in a file without a name where they are large."""
    size = int(np.prod(shape)) * np.dtype(kind).itemsize
    if size <= limit:
        return np.zeros(shape, kind)
    with tempfile.TemporaryFile() as f:
        return np.memmap(f, kind, "w+", shape=shape)


# --- the rows of a task ---------------------------------------------------------------------------

def column_groups(bins: np.ndarray, rows: int) -> list[list[int]]:
    """Columns that are counted together: the product of their bins is ``CELLS`` at most, less for few rows."""
    most, groups = min(CELLS, max(rows // 64, 64)), []
    for c in np.argsort(-bins, kind="stable").tolist():
        fits = [g for g in groups if np.prod(bins[g]) * bins[c] <= most]
        if fits:
            max(fits, key=lambda g: np.prod(bins[g])).append(c)
        else:
            groups.append([c])
    return groups


class Rows:
    """The rows of one task: bins, labels, folds, keys, scores [models, classes, n], and of the trees that
    grow the whole-number gradients [trees, n, 2] and places [trees, n]."""

    def __init__(self, blocks: list, bins: np.ndarray, models: int, s, limit: int):
        whole = [np.concatenate([getattr(b, x) for b in blocks], -1) if blocks else empty for x, empty in (
            ("bins", np.zeros((len(bins), 0), np.uint8)), ("label", np.zeros(0, np.int8)),
            ("fold", np.zeros(0, np.int16)), ("key", np.zeros(0, np.int64)))]
        # By fold, so that a model passes over the rows left out of it.
        order = np.argsort(whole[2], kind="stable")
        self.bins, self.label, self.fold, self.key = [np.ascontiguousarray(x[..., order]) for x in whole]
        del whole
        self.span = [np.searchsorted(self.fold, [m, m + 1]).tolist() for m in range(models)]
        self.n, self.models, self.trees, self.s = len(self.label), models, models * B.CLASSES, s
        self.widths = bins
        each = limit // (self.trees * 2)
        self.scores = _room((models, B.CLASSES, self.n), np.float64, each * self.trees)
        self.scores[:] = 0.5
        self.pairs = _room((self.trees, self.n, 2), np.int32, each * self.trees)
        self.place = np.zeros((self.trees, self.n), np.uint8 if s.max_depth <= 8 else np.int64)
        self.drawn = np.zeros((B.CLASSES, self.n), bool)
        self.groups = column_groups(bins, self.n)
        self.cells = [int(np.prod(bins[g])) for g in self.groups]
        self.joint = np.zeros((len(self.groups), self.n), np.uint16)
        for group, joint in zip(self.groups, self.joint):
            for c in group:
                joint *= np.uint16(bins[c])
                joint += self.bins[c]

    def slices(self, rows: int = COUNT_ROWS, without: int | None = None, only: int | None = None) -> Iterator[slice]:
        """All rows, those without a fold or those of one."""
        if without is not None:
            ranges = [(0, self.span[without][0]), (self.span[without][1], self.n)]
        else:
            ranges = [(0, self.n) if only is None else self.span[only]]
        return (slice(x, min(x + rows, z)) for a, z in ranges for x in range(a, z, rows))

    def begin(self, round_: int) -> None:
        """The gradients of a round, from its scores."""
        s, classes = self.s, np.arange(B.CLASSES)[:, None]
        self.place[:] = 0
        for at in self.slices():
            for c in range(B.CLASSES):
                self.drawn[c, at] = B._drawn(self.key[at], s.seed, round_ * B.CLASSES + c, s.subsample)
        for m in range(self.models):
            for at in self.slices(GRADIENT_ROWS, without=m):
                pairs = self.pairs[m * B.CLASSES:(m + 1) * B.CLASSES, at]
                pairs[..., 0], pairs[..., 1] = B.gradients(B.probabilities(self.scores[m, :, at].T), self.label[at] == classes)

    def move(self, tree: int, split: np.ndarray, depth: int, at: slice, counted: np.ndarray | None = None):
        """Moves the rows' places to ``depth``, from those one level above.  Which rows are in one of the nodes of
        ``counted`` [places at depth], of two siblings one at most."""
        place = self.place[tree, at]
        right, wanted = np.zeros(len(place), bool), np.zeros(len(place), bool)
        for p, (feature, cut) in enumerate(split[2 ** (depth - 1) - 1:2 ** depth - 1].tolist()):
            if feature >= 0:  # comparing whole columns of bytes is quicker than looking up each row's node
                here = place == p
                own = self.bins[feature, at] > cut
                own &= here
                right |= own
                if counted is not None and counted[2 * p + 1]:
                    wanted |= own
                elif counted is not None and counted[2 * p]:
                    here ^= own
                    wanted |= here
        place += place
        place += right
        return wanted

    def count(self, tree: int, split: np.ndarray, slots: np.ndarray, columns: np.ndarray, depth: int) -> np.ndarray:
        """[nodes counted, bins of the tree's columns, 2] sums of the rows, after moving them to ``depth``.

        A column's bins are the margins of its group's cells; complex numbers hold both sums, and doubles are exact."""
        level = slots[2 ** depth - 1:2 ** (depth + 1) - 1].astype(np.int64)
        width, used = int(level.max()) + 1, set(columns.tolist())
        groups = [g for g, own in enumerate(self.groups) if used & set(own)]
        stride = max(self.cells[g] for g in groups)
        sums = {g: np.zeros(width * stride, np.complex128) for g in groups}
        (m, c), base = divmod(tree, B.CLASSES), level * stride
        for at in self.slices(without=m):
            own = self.drawn[c, at]
            if depth:
                own = own & self.move(tree, split, depth, at, level >= 0)
            rows = np.flatnonzero(own)
            pair = self.pairs[tree, at].view(np.int64)[:, 0].take(rows).view(np.int32)
            weight = pair.astype(np.float64).view(np.complex128)
            first = base.take(self.place[tree, at].take(rows).astype(np.int64)) if width > 1 else None
            for g in groups:
                cell = self.joint[g, at].take(rows).astype(np.int64)
                if first is not None:
                    cell += first
                np.add.at(sums[g], cell, weight)
        of = {}
        for g in groups:
            shape = [int(self.widths[x]) for x in self.groups[g]]
            cells = sums[g].reshape(width, stride)[:, :self.cells[g]].reshape(width, *shape)
            for i, column in enumerate(self.groups[g]):
                if column in used:
                    of[column] = cells.sum(tuple(j + 1 for j in range(len(shape)) if j != i))
        out = np.concatenate([of[x] for x in columns.tolist()], 1)
        return np.ascontiguousarray(out).view(np.float64).reshape(*out.shape, 2).astype(np.int64)

    def add(self, tree: int, split: np.ndarray, weights: np.ndarray, moved: int) -> None:
        """Adds a tree to the scores; the rows it is grown from were moved to the level ``moved``."""
        depth, (m, c) = self.s.max_depth, divmod(tree, B.CLASSES)
        step = B._leaf_weights(split, weights, depth)
        for start, some in ((moved, self.slices(without=m)), (0, self.slices(only=m))):
            for at in some:
                for level in range(start + 1, depth + 1):
                    self.move(tree, split, level, at)
                self.scores[m, c, at] += step.take(self.place[tree, at].astype(np.int64))

    def blocks(self) -> Iterator:
        for a in range(0, self.n, B.CHUNK_ROWS):
            at = slice(a, min(a + B.CHUNK_ROWS, self.n))
            yield B._Block(self.bins[:, at].copy(), self.label[at], self.fold[at], self.key[at],
                           np.ascontiguousarray(self.scores[:, :, at].transpose(2, 0, 1)))


# --- the stage ------------------------------------------------------------------------------------

_LOG = "t{}_{}"


def _owners(tasks: int, trees: int) -> list[list[int]]:
    n = min(tasks, trees)
    return [list(range(o, trees, n)) for o in range(n)]


def _tree_bytes(split, weights, gains, covers) -> list[bytes]:
    return [split.astype(np.int64).tobytes(), *[x.astype(np.float64).tobytes() for x in (weights, gains, covers)]]


def _tree_arrays(data: bytes, trees: int, size: int):
    cut = trees * size * 16
    return (np.frombuffer(data[:cut], np.int64).reshape(trees, size, 2),
            *np.frombuffer(data[cut:], np.float64).reshape(3, trees, size))


def _expand(flat: np.ndarray, widths: np.ndarray) -> np.ndarray:
    """[nodes, columns, bins, 2] from sums without padding."""
    out = np.zeros((len(flat), len(widths), int(widths.max()), 2), np.int64)
    at = 0
    for j, w in enumerate(widths.tolist()):
        out[:, j, :w] = flat[:, at:at + w]
        at += w
    return out


def _next(grower, hist):
    """What a generator asks for next, or what it returns."""
    try:
        return grower.send(hist), None
    except StopIteration as end:
        return None, end.value


def run_task(blocks: list, me: int, tasks: int, root: str, n_features: int, bins: np.ndarray, models: int, s, meet) -> int:
    """One task of the stage; ``meet`` hands a text to all tasks and returns the texts of all.  Writes the rows
    with their last scores and returns in how many files."""
    parent, size, most = os.getppid(), 2 ** (s.max_depth + 1) - 1, int(bins.max())
    rows = Rows(blocks, bins, models, s, MEMORY_BYTES)
    blocks.clear()
    trees, owners = models * B.CLASSES, _owners(tasks, models * B.CLASSES)
    done = 0
    while done < s.n_trees and all(os.path.exists(os.path.join(root, _LOG.format(done, o))) for o in range(len(owners))):
        done += 1
    # The tasks of an earlier attempt may still write: all go on from the same round, under a name of their own.
    all_said = [json.loads(x) for x in meet(json.dumps([os.urandom(6).hex(), done]))]
    done = min(d for _, d in all_said)
    here = os.path.join(root, f"try-{all_said[0][0]}")
    os.makedirs(here, exist_ok=True)
    step, behind = 0, []  # what this task wrote, with the step at which all have read it

    def finished(round_: int, owner: int):
        with open(os.path.join(root, _LOG.format(round_, owner)), "rb") as f:
            return _tree_arrays(f.read(), len(owners[owner]), size)

    for round_ in range(s.n_trees):
        if round_ < done:
            rows.place[:] = 0
            for o, own in enumerate(owners):
                splits, weights, *_ = finished(round_, o)
                for t, split, weight in zip(own, splits, weights):
                    rows.add(t, split, weight, 0)
            continue
        columns = B.tree_columns(n_features, trees, round_, s)
        mine = owners[me] if me < len(owners) else []
        grower, open_ = B.growth(len(mine), columns[mine], s), set(range(len(owners)))
        asked, grown = _next(grower, None) if mine else (None, None)
        splits, moved = np.full((trees, size, 2), -1, np.int64), np.zeros(trees, np.int64)
        rows.begin(round_)
        while open_:
            if me in open_:
                query = os.path.join(here, f"q{step}_{me}")
                if grown is None:
                    own_splits, own_slots, depth, width = asked
                    _put(query, [bytes([1 + depth]), own_splits.astype(np.int16).tobytes(), own_slots.astype(np.int16).tobytes()])
                else:
                    _put(os.path.join(root, _LOG.format(round_, me)), _tree_bytes(*grown))
                    _put(query, [b"\0"])
                    # A round begins with sums of all tasks, so by the step after it all have read this.
                    behind.append((step + 2, query))
            wanted, closed = [], []
            for o in sorted(open_):
                with _wait(os.path.join(here, f"q{step}_{o}"), parent) as f:
                    data = f.read()
                if not data[0]:
                    closed.append(o)
                    for t, split, weight in zip(owners[o], *finished(round_, o)[:2]):
                        rows.add(t, split, weight, int(moved[t]))
                    continue
                own, half = owners[o], 1 + len(owners[o]) * size * 4
                splits[own] = np.frombuffer(data[1:half], np.int16).reshape(len(own), size, 2)
                wanted.append((o, data[0] - 1, np.frombuffer(data[half:], np.int16).reshape(len(own), size)))
            for _, path in (x for x in behind if x[0] <= step):
                os.remove(path)
            behind = [x for x in behind if x[0] > step]
            open_ -= set(closed)
            if wanted:
                head, parts = np.zeros(len(owners) + 1, np.int64), []
                for o, depth_, slots in wanted:
                    for t, slot in zip(owners[o], slots):
                        if slot.max() >= 0:
                            parts.append(rows.count(t, splits[t], slot, columns[t], depth_).tobytes())
                            head[o + 1] += len(parts[-1])
                            moved[t] = depth_
                sums = os.path.join(here, f"h{step}_{me}")
                _put(sums, [np.cumsum(head).tobytes(), *parts])
                behind.append((step + 1, sums))  # the owners go on when they have read it
            if me in open_:
                total = None
                for task in range(tasks):
                    with _wait(os.path.join(here, f"h{step}_{task}"), parent) as f:
                        a, b = np.frombuffer(f.read(8 * (len(owners) + 1)), np.int64)[me:me + 2]
                        f.seek(8 * (len(owners) + 1) + int(a))
                        part = np.frombuffer(f.read(int(b - a)), np.int64)
                    total = part.copy() if total is None else np.add(total, part, out=total)
                os.remove(query)  # no task sends sums before it has read this
                hist, at = np.zeros((len(mine), width, columns.shape[1], most, 2), np.int64), 0
                for i, t in enumerate(mine):
                    nodes, cells = int(own_slots[i].max()) + 1, int(bins[columns[t]].sum())
                    flat = total[at:at + nodes * cells * 2].reshape(nodes, cells, 2)
                    full = _expand(flat, bins[columns[t]])
                    hist[i, :nodes, :, :full.shape[2]] = full
                    at += nodes * cells * 2
                asked, grown = _next(grower, hist)
            step += 1
    count = 0
    for count, block in enumerate(rows.blocks(), 1):
        _put(os.path.join(root, f"s{me}_{count - 1}"), [pickle.dumps(block, 5)])
    return count


def _stored(root: str, task: int, files: int) -> Iterator:
    for i in range(files):
        with open(os.path.join(root, f"s{task}_{i}"), "rb") as f:
            yield pickle.load(f)


def fit(chunks, n_features: int, bins: np.ndarray, models: int, s, root: str):
    """The trees by round (splits, weights, gains, hessians of all) and the last scores, an RDD of blocks that
    reads them from the shared folder; they go when it goes."""
    found, spark = chunks.rdd, chunks.sparkSession
    tasks = found.getNumPartitions()

    def run(task: int, part: Iterator) -> Iterator:
        yield task, run_task([B._Block.of(r, n_features, 0) for r in part], task, tasks, root, n_features, bins, models, s,
                             BarrierTaskContext.get().allGather)

    try:
        files = dict(found.barrier().mapPartitionsWithIndex(run).collect())
    except Exception:
        shutil.rmtree(root, True)
        raise
    trees, size, rounds = models * B.CLASSES, 2 ** (s.max_depth + 1) - 1, []
    for round_ in range(s.n_trees):
        whole = np.zeros((trees, size, 2), np.int64), *[np.zeros((trees, size)) for _ in range(3)]
        for o, own in enumerate(_owners(tasks, trees)):
            path = os.path.join(root, _LOG.format(round_, o))
            with open(path, "rb") as f:
                for to, part in zip(whole, _tree_arrays(f.read(), len(own), size)):
                    to[own] = part
            os.remove(path)
        rounds.append(whole)
    state = spark.sparkContext.parallelize(range(tasks), tasks).flatMap(lambda t: _stored(root, t, files[t]))
    weakref.finalize(state, shutil.rmtree, root, True)
    return rounds, state
