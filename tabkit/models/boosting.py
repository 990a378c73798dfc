"""Boosted regression trees for many settings and folds at once.

A search over a grid boosts one sequence of trees for every setting and fold. All sequences read the same rows,
so they grow together: the features are binned once, a block of rows keeps the running prediction of every
sequence, and one aggregate a level sums residuals per (sequence, node, feature, bin). The job count is trees times
levels, whatever the size of the grid. A setting that differs only in its number of trees is a look at a
longer sequence half way. Up to a bounded number of rows, every task gets a copy of them by a shuffle, and the sequences are dealt
to the tasks instead: a level's aggregate is then complete in its task, and the search is one job. There only the smaller
child of a node is summed, its sibling being the rest, and features are joined into codes that are summed together. The trees
are the same.

The trees are those of Spark's ``GBTRegressor``: the first is fitted to the label, the others to twice the residual
and added with the step size; a split has the largest drop in variance over the thresholds between bins. Rows
are sampled by a hash of their key and the tree's number, and residuals are summed as whole multiples of a small
power of two, which is exact in any order. So the same rows give the same trees in any partitioning.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ..session import written

# Bins of a feature, and the rows at most, about, whose values place them.
BINS = 32
SAMPLE_ROWS = 10_000
BLOCK_ROWS = 2_048
# Nodes whose splits are chosen together: their histograms must fit a task.
NODES_A_PART = 256
# Up to so many rows, each a byte a feature and 20 more, are copied to every task.
SENT_ROWS = 4_000_000
# Codes at most of features that are summed together.
CODES = 512
# Trees after which the running predictions are written, so that a lost executor replays no more than these.
WRITTEN_EVERY = 10
# Histogram entries that a task holds before equal ones are added up.
_HELD_ENTRIES = 1_000_000

_STATE = "bins binary, y binary, fold binary, mark binary, f binary"
_ENTRIES = "part long, at binary, rows binary, total binary"
_SPLITS = "node array<long>, feature array<long>, bin array<long>, rows array<long>, total array<double>, left_rows array<long>, left_total array<double>"

# Settings that are left out of a grid.
DEFAULTS = {"maxDepth": 5, "maxIter": 20, "stepSize": 0.1, "subsamplingRate": 1.0, "minInstancesPerNode": 1}


def thresholds(values: np.ndarray, bins: int = BINS) -> np.ndarray:
    """Where a feature is cut: between all its values if they fit, else near equal shares of the rows."""
    distinct, counts = np.unique(values, return_counts=True)
    between = (distinct[:-1] + distinct[1:]) / 2
    if len(between) < bins:
        return between
    seen, stride, chosen = np.cumsum(counts), len(values) / bins, []
    for i in range(len(between)):
        target = stride * (len(chosen) + 1)
        if abs(seen[i] - target) < abs(seen[i + 1] - target):
            chosen.append(between[i])
    return np.array(chosen)


@dataclass
class Trees:
    """One tree of every sequence, as heaps: the children of node ``i`` are ``2 i + 1`` and ``2 i + 2``."""

    feature: np.ndarray  # -1 where a node has no split
    bin: np.ndarray  # the last bin that goes left
    value: np.ndarray
    open: np.ndarray  # the number of a node to be split, -1 for others

    @classmethod
    def empty(cls, sequences: int, depth: int) -> Trees:
        shape = (sequences, (1 << (depth + 1)) - 1)
        return cls(np.full(shape, -1, np.int16), np.zeros(shape, np.int16), np.zeros(shape), np.full(shape, -1, np.int32))

    def nodes(self, bins: np.ndarray, levels: int, which: np.ndarray) -> np.ndarray:
        """For the sequences ``which`` and each row of ``bins`` (feature, row), the node it is in after ``levels`` splits."""
        row = np.arange(bins.shape[1])[None, :]
        node = np.zeros((len(which), bins.shape[1]), np.int32)
        for _ in range(levels):
            feature = self.feature[which[:, None], node]
            right = bins[feature, row] > self.bin[which[:, None], node]
            node = np.where(feature >= 0, 2 * node + 1 + right, node)
        return node


@dataclass(frozen=True)
class Sequence_:
    depth: int
    step: float
    share: float
    least: int
    fold: int  # the rows left out, -1 for none


def _unpacked(batch: pa.RecordBatch, features: int, sequences: int) -> Iterator[tuple]:
    for i in range(batch.num_rows):
        y = np.frombuffer(batch["y"][i].as_buffer(), np.float64)
        n = len(y)
        yield (
            np.frombuffer(batch["bins"][i].as_buffer(), np.uint8).reshape(features, n), y,
            np.frombuffer(batch["fold"][i].as_buffer(), np.int32), np.frombuffer(batch["mark"][i].as_buffer(), np.uint64),
            np.frombuffer(batch["f"][i].as_buffer(), np.float64).reshape(sequences, n),
        )


def _packed(cuts: list[np.ndarray], sequences: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK_ROWS):
                part = batch.slice(at, BLOCK_ROWS)
                bins = [np.searchsorted(c, part[f"x{k}"].to_numpy(zero_copy_only=False), "left") for k, c in enumerate(cuts)]
                columns = {
                    "bins": np.array(bins, np.uint8).reshape(len(cuts), part.num_rows),
                    "y": part["y"].to_numpy(zero_copy_only=False),
                    "fold": part["fold"].to_numpy(zero_copy_only=False),
                    "mark": part["mark"].to_numpy(zero_copy_only=False),
                    "f": np.zeros((sequences, part.num_rows)),
                }
                yield pa.RecordBatch.from_pydict({k: pa.array([v.tobytes()], pa.binary()) for k, v in columns.items()})

    return run


def _sampled(mark: np.ndarray, tree: int, seed: int, share: float) -> np.ndarray:
    """Which rows a tree is fitted to: the top bits of a mix of the row's mark with the tree's number."""
    x = mark ^ np.uint64((seed * 1_000_003 + tree + 1) * 0x9E3779B97F4A7C15 & (1 << 64) - 1)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return ((x ^ (x >> np.uint64(31))) >> np.uint64(11)).astype(np.float64) < share * 2.0**53


def _added(at: np.ndarray, rows: np.ndarray, total: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Entries of the same place added up."""
    out, which = np.unique(at, return_inverse=True)
    return out, np.bincount(which, rows, len(out)).astype(np.int64), np.bincount(which, total, len(out))


@dataclass(frozen=True)
class Growth:
    """What is the same for every tree of a search."""

    sequences: list[Sequence_]
    features: int
    seed: int
    scale: float  # of residuals, so that their sums are whole numbers

    def drawn(self, mark: np.ndarray, tree: int, which: np.ndarray) -> np.ndarray:
        """Which rows each of the sequences ``which`` fits the tree to."""
        by_share = {share: _sampled(mark, tree, self.seed, share) if share < 1 else np.ones(len(mark), bool) for share in {self.sequences[s].share for s in which}}
        return np.stack([by_share[self.sequences[s].share] for s in which])

    def entries(self, trees: Trees, level: int, tree: int, block: tuple) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of the open nodes, per place ((node * features + feature) * bins + bin): rows, and the sum of their scaled residuals."""
        bins, y, own_fold, mark, f = block
        which = np.flatnonzero((trees.open >= 0).any(axis=1))
        fold = np.array([self.sequences[s].fold for s in which])[:, None]
        node = trees.open[which[:, None], trees.nodes(bins, level, which)]
        s, row = np.nonzero((node >= 0) & (fold != own_fold[None, :]) & self.drawn(mark, tree, which))
        residual = y[row] if tree == 0 else 2 * (y[row] - f[which[s], row])
        residual = np.rint(residual * self.scale)
        return self.listed(node[s, row], int(trees.open.max()) + 1, bins, row, residual)

    def dense(self, nodes: int, rows: int) -> bool:
        """Whether the places of so many nodes are few enough, by the rows in them, to be held all."""
        return nodes * BINS <= 4 * rows

    def listed(self, node: np.ndarray, nodes: int, bins: np.ndarray, row: np.ndarray, residual: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The same for the rows ``row`` of ``bins``, each in an open node."""
        first = node.astype(np.int64) * (self.features * BINS)
        size, found = nodes * self.features * BINS, []
        if self.dense(nodes, len(row)):
            rows, total = np.zeros(size), np.zeros(size)
            for k in range(self.features):
                at = first + k * BINS + bins[k, row]
                rows += np.bincount(at, minlength=size)
                total += np.bincount(at, residual, size)
            at = np.flatnonzero(rows)
            return at, rows[at], total[at]
        for k in range(self.features):
            found.append(_added(first + k * BINS + bins[k, row], np.ones(len(row)), residual))
        at, rows, total = map(np.concatenate, zip(*found))
        order = np.argsort(at, kind="stable")
        return at[order], rows[order], total[order]

    def best(self, at: np.ndarray, rows: np.ndarray, total: np.ndarray, least: np.ndarray) -> dict[str, np.ndarray]:
        """The best split of each node that has entries (sorted by place); feature -1 where none lowers the variance."""
        list_, node = at // BINS, at // (BINS * self.features)

        def before(x: np.ndarray, first: np.ndarray, which: np.ndarray) -> np.ndarray:
            """The sum up to each entry, from the first one of its list."""
            run = np.cumsum(x)
            return run - (run - x)[first][which]

        list_first = np.flatnonzero(np.concatenate(([True], list_[1:] != list_[:-1])))
        own_list = np.cumsum(np.concatenate(([0], list_[1:] != list_[:-1])))
        node_first = np.flatnonzero(np.concatenate(([True], node[1:] != node[:-1])))
        own_node = np.cumsum(np.concatenate(([0], node[1:] != node[:-1])))
        left_rows, left_total = before(rows, list_first, own_list), before(total, list_first, own_list)
        # The first feature's list of a node holds all its rows.
        last = np.append(list_first[1:], len(at))[own_list[node_first]] - 1
        all_rows, all_total = left_rows[last], left_total[last]
        n, t = all_rows[own_node], all_total[own_node]
        with np.errstate(divide="ignore", invalid="ignore"):
            gain = left_total**2 / left_rows + (t - left_total) ** 2 / (n - left_rows) - t**2 / n
        few = least[node]
        allowed = (left_rows >= few) & (n - left_rows >= few) & (gain > t**2 / n * 1e-12)  # less is rounding
        gain = np.where(allowed, gain, -1.0)
        first = np.flatnonzero(gain == np.maximum.reduceat(gain, node_first)[own_node])
        best = first[np.unique(own_node[first], return_index=True)[1]]
        return {
            "node": node[node_first],
            "feature": np.where(gain[best] > 0, list_[best] % self.features, -1),
            "bin": at[best] % BINS,
            "rows": all_rows.astype(np.int64),
            "total": all_total,
            "left_rows": left_rows[best].astype(np.int64),
            "left_total": left_total[best],
        }

    def split(self, trees: Trees, level: int, owner: np.ndarray, place: np.ndarray, found: dict[str, np.ndarray]) -> None:
        """Give the open nodes, of sequence ``owner`` at ``place``, their splits, and open those children that can be split."""
        trees.open[owner, place] = -1
        s, i = owner[found["node"]], place[found["node"]]
        trees.value[s, i] = found["total"] / found["rows"] / self.scale
        cut = found["feature"] >= 0
        s, i = s[cut], i[cut]
        rows, total, left_rows, left_total = (found[name][cut] for name in ("rows", "total", "left_rows", "left_total"))
        trees.feature[s, i], trees.bin[s, i] = found["feature"][cut], found["bin"][cut]
        trees.value[s, 2 * i + 1] = left_total / left_rows / self.scale
        trees.value[s, 2 * i + 2] = (total - left_total) / (rows - left_rows) / self.scale
        depth = np.array([q.depth for q in self.sequences])[s]
        least = np.maximum(2, 2 * np.array([q.least for q in self.sequences])[s])
        child = np.concatenate((2 * i + 1, 2 * i + 2))
        may = np.concatenate((left_rows >= least, rows - left_rows >= least)) & np.tile(level + 1 < depth, 2)
        trees.open[np.tile(s, 2)[may], child[may]] = np.arange(may.sum())

    def opened(self, trees: Trees) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Sequence, place and least rows of the open nodes, by their numbers."""
        owner, place = np.nonzero(trees.open >= 0)
        order = np.argsort(trees.open[owner, place])
        owner, place = owner[order], place[order]
        return owner, place, np.array([q.least for q in self.sequences])[owner]

    def started(self) -> Trees:
        trees = Trees.empty(len(self.sequences), max(q.depth for q in self.sequences))
        trees.open[:, 0] = np.arange(len(self.sequences))
        return trees

    def moved(self, trees: Trees, tree: int, bins: np.ndarray, before: np.ndarray) -> np.ndarray:
        """The running predictions with the tree added."""
        every = np.arange(len(self.sequences))
        weight = np.array([1.0 if tree == 0 else q.step for q in self.sequences])[:, None]
        depth = max(q.depth for q in self.sequences)
        return before + weight * trees.value[every[:, None], trees.nodes(bins, depth, every)]

    def errors(self, block: tuple) -> tuple[np.ndarray, np.ndarray]:
        """Per sequence, rows of the fold left out and the sum of their squared errors."""
        _, y, own_fold, _, f = block
        held = np.array([q.fold for q in self.sequences])[:, None] == own_fold[None, :]
        return held.sum(axis=1), np.where(held, (f - y[None, :]) ** 2, 0.0).sum(axis=1)


def _histograms(sent, growth: Growth, level: int, tree: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, count = [], 0
        for batch in batches:
            for block in _unpacked(batch, growth.features, len(growth.sequences)):
                held.append(growth.entries(sent.value, level, tree, block))
                count += len(held[-1][0])
                if count > _HELD_ENTRIES:
                    held = [_added(*map(np.concatenate, zip(*held)))]
                    count = len(held[0][0])
        if not count:
            return
        at, rows, total = _added(*map(np.concatenate, zip(*held))) if len(held) > 1 else held[0]
        size = NODES_A_PART * growth.features * BINS
        edge = np.searchsorted(at, np.arange(at[-1] // size + 2) * size)
        for part in np.flatnonzero(np.diff(edge)):
            cut = slice(edge[part], edge[part + 1])
            columns = {"at": at[cut].astype(np.int64), "rows": rows[cut].astype(np.float64), "total": total[cut]}
            yield pa.RecordBatch.from_pydict({"part": [int(part)]} | {k: pa.array([v.tobytes()], pa.binary()) for k, v in columns.items()})

    return run


def _chosen(growth: Growth, least: np.ndarray):
    def run(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, count = [], 0
        for batch in batches:
            for i in range(batch.num_rows):
                held.append([np.frombuffer(batch[name][i].as_buffer(), kind) for name, kind in (("at", np.int64), ("rows", np.float64), ("total", np.float64))])
                count += len(held[-1][0])
                if count > _HELD_ENTRIES:
                    held = [_added(*map(np.concatenate, zip(*held)))]
                    count = len(held[0][0])
        found = growth.best(*_added(*map(np.concatenate, zip(*held))), least)
        yield pa.RecordBatch.from_pydict({name: pa.array([values.tolist()]) for name, values in found.items()})

    return run


def _moved(sent, growth: Growth, tree: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            f = [growth.moved(sent.value, tree, block[0], block[4]).tobytes() for block in _unpacked(batch, growth.features, len(growth.sequences))]
            columns = {name: batch[name] for name in ("bins", "y", "fold", "mark")}
            yield pa.RecordBatch.from_pydict(columns | {"f": pa.array(f, pa.binary())})

    return run


def _errors(growth: Growth):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in _unpacked(batch, growth.features, len(growth.sequences)):
                rows, total = growth.errors(block)
                yield pa.RecordBatch.from_pydict({"sequence": np.arange(len(rows)), "rows": rows, "total": total})

    return run


class Bundles:
    """Features joined, in their order, into codes of the combinations that occur, so that one sum serves several."""

    def __init__(self, bins: np.ndarray):
        self.bins, self.held = bins, []
        code, size, own = np.zeros(bins.shape[1], np.int64), 1, []
        for k in range(len(bins)):
            together = code * BINS + bins[k]
            seen = np.flatnonzero(np.bincount(together, minlength=size * BINS))
            if own and len(seen) > CODES:
                self._hold(own, code, size)
                together, own = bins[k].astype(np.int64), []
                seen = np.flatnonzero(np.bincount(together, minlength=BINS))
            number = np.zeros(int(seen[-1]) + 1, np.int64)
            number[seen] = np.arange(len(seen))
            code, size, own = number[together], len(seen), [*own, k]
        self._hold(own, code, size)

    def _hold(self, features: list[int], code: np.ndarray, size: int) -> None:
        spread = np.zeros((size, len(features), BINS))
        for i, k in enumerate(features):
            spread[code, i, self.bins[k]] = 1.0
        self.held.append((features, code.astype(np.uint16), size, spread.reshape(size, -1)))

    def sums(self, node: np.ndarray, nodes: int, row: np.ndarray, residual: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows and summed residuals by node, feature and bin. All are whole numbers, so that any order gives the same."""
        rows, total = np.zeros((nodes, len(self.bins), BINS)), np.zeros((nodes, len(self.bins), BINS))
        for features, code, size, spread in self.held:
            if len(features) > 1 and nodes * size <= 4 * len(row):
                at = node * size + code[row]
                for out, weight in ((rows, None), (total, residual)):
                    out[:, features] = (np.bincount(at, weight, nodes * size).reshape(nodes, size) @ spread).reshape(nodes, -1, BINS)
                continue
            for k in features:
                at = node * BINS + self.bins[k, row]
                for out, weight in ((rows, None), (total, residual)):
                    out[:, k] = np.bincount(at, weight, nodes * BINS).reshape(nodes, BINS)
        return rows, total


def _tree(own: Growth, bundles: Bundles, row: np.ndarray, residual: np.ndarray) -> np.ndarray:
    """A tree of the only sequence of ``own``, fitted to the scaled residuals of the rows ``row``: its value for each row of the table.

    The sums of a node's smaller child are taken from the rows, those of the other one are the node's less these.
    """
    bins, trees, above = bundles.bins, own.started(), None
    node, every = np.zeros(bins.shape[1], np.int64), np.arange(bins.shape[1])
    values = bins.reshape(-1)
    for level in range(own.sequences[0].depth):
        owner, place, least = own.opened(trees)
        if not len(place) or not len(row):
            break
        here, number = node[row], np.full(trees.open.shape[1], -1)
        if own.dense(len(place), len(row)):
            parent = (place - 1) // 2
            parents, which = np.unique(parent, return_inverse=True)
            if above is None:
                wanted = place
            else:
                held = np.bincount(here, minlength=len(number))
                wanted = 2 * parents + 1 + (held[2 * parents + 1] > held[2 * parents + 2])
            number[wanted] = np.arange(len(wanted))
            at = number[here]
            inside = np.flatnonzero(at >= 0)
            sums = bundles.sums(at[inside], len(wanted), row[inside], residual[inside])
            if above is not None:
                before, whole = above
                first = np.searchsorted(before, parents)
                smaller = (number[place] >= 0)[:, None, None]
                sums = tuple(np.where(smaller, x[which], (w[first] - x)[which]) for x, w in zip(sums, whole))
            order = np.argsort(place)
            above = place[order], tuple(x[order] for x in sums)
            rows, total = (x.ravel() for x in sums)
            at = np.flatnonzero(rows)
            entries = at, rows[at], total[at]
        else:
            number[place] = np.arange(len(place))
            inside = np.flatnonzero(number[here] >= 0)
            above, entries = None, own.listed(number[here[inside]], len(place), bins, row[inside], residual[inside])
        own.split(trees, level, owner, place, own.best(*entries, least))
        feature, place = trees.feature[0].astype(np.int64), np.arange(len(number))
        split = feature >= 0
        first, last, child = np.where(split, feature, 0) * len(every), np.where(split, trees.bin[0], BINS), np.where(split, 2 * place + 1, place)
        node = child.take(node) + (values.take(first.take(node) + every) > last.take(node))
    return trees.value[0, node]


def _whole(growth: Growth, dealt: list[list[int]], looks: Sequence[int]):
    """Grow the sequences dealt to a task over all rows, and give their errors at each look."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, blocks = None, []
        for batch in batches:
            for i in range(batch.num_rows):
                task = batch["task"][i].as_py()
                blocks.append([np.frombuffer(batch[name][i].as_buffer(), kind) for name, kind in (("bins", np.uint8), ("y", np.float64), ("fold", np.int32), ("mark", np.uint64))])
        if task is None:
            return
        bins = np.concatenate([b[0].reshape(growth.features, -1) for b in blocks], axis=1)
        y, fold, mark = (np.concatenate([b[k] for b in blocks]) for k in (1, 2, 3))
        blocks.clear()
        order = np.argsort(mark.view(np.int64), kind="stable")
        y, fold, mark = y[order], fold[order], mark[order]
        bundles = Bundles(bins[:, order])
        own = [(s, Growth([growth.sequences[s]], growth.features, growth.seed, growth.scale), np.zeros(len(y))) for s in dealt[task]]
        for tree in range(looks[-1]):
            for s, one, f in own:
                row = np.flatnonzero((fold != one.sequences[0].fold) & one.drawn(mark, tree, [0])[0])
                residual = y[row] if tree == 0 else 2 * (y[row] - f[row])
                value = _tree(one, bundles, row, np.rint(residual * one.scale))
                f += (1.0 if tree == 0 else one.sequences[0].step) * value
            if tree + 1 in looks:
                for s, one, f in own:
                    rows, total = one.errors((None, y, fold, mark, f[None, :]))
                    yield pa.RecordBatch.from_pydict({"look": [tree + 1], "sequence": [s], "rows": rows, "total": total})

    return run


def _rmse(found: dict[int, tuple[int, float]], sequences: int) -> list[float]:
    return [float(np.sqrt(found[s][1] / found[s][0])) if s in found and found[s][0] else float("nan") for s in range(sequences)]


class Binned:
    """Rows of ``df`` with numeric ``features``, ``label``, ``fold`` and a mark to sample by, and where features are cut.

    Rows with a missing feature or label are left out.
    """

    def __init__(self, df: DataFrame, features: Sequence[str], label: str, fold: str, key: Sequence[str]):
        columns = [F.col(c).cast("double").alias(f"x{k}") for k, c in enumerate(features)]
        rows = df.select(*columns, F.col(label).cast("double").alias("y"), F.col(fold).cast("int").alias("fold"), F.xxhash64(*key).alias("mark"))
        self.rows = written(rows.dropna().filter(" and ".join(f"not isnan({c})" for c in rows.columns[:-2])))
        self.count, low, high = self.rows.agg(F.count("*"), F.min("y"), F.max("y")).first()
        if not self.count:
            raise ValueError("no rows without a missing value")
        some = self.rows
        if self.count > SAMPLE_ROWS:
            some = some.filter(F.pmod(F.xxhash64("mark"), F.lit(self.count)) < SAMPLE_ROWS)
        sample = some.select(*[f"x{k}" for k in range(len(features))]).toArrow()
        self.cuts = [thresholds(sample[f"x{k}"].to_numpy()) for k in range(len(features))]
        # Sums of scaled residuals stay below 2 ** 52, so that they are exact.
        self.scale = 2.0 ** np.floor(52 - np.log2(self.count * 4 * max(1e-300, high - low, abs(low), abs(high))))


class Boosting:
    """All sequences over rows that are spread over the tasks, a tree at a time."""

    def __init__(self, data: Binned, sequences: list[Sequence_], seed: int):
        self.growth = Growth(sequences, len(data.cuts), seed, data.scale)
        self.context = data.rows.sparkSession.sparkContext
        parts = max(1, min(self.context.defaultParallelism, -(-data.count // BLOCK_ROWS)))
        self.state = data.rows.repartition(parts, "mark").mapInArrow(_packed(data.cuts, len(sequences)), _STATE).persist()
        self.trees = 0
        self.sent, self.kept = [], [self.state]

    def _send(self, value):
        self.sent.append(self.context.broadcast(value))
        return self.sent[-1]

    def grow(self) -> Trees:
        """Add a tree to every sequence."""
        trees = self.growth.started()
        for level in range(max(q.depth for q in self.growth.sequences)):
            owner, place, least = self.growth.opened(trees)
            if not len(owner):
                break
            entries = self.state.mapInArrow(_histograms(self._send(trees), self.growth, level, self.trees), _ENTRIES)
            parts = entries.groupBy("part").applyInArrow(_chosen(self.growth, least), _SPLITS).toArrow()
            if not parts.num_rows:
                break
            found = {name: np.concatenate([x.as_py() for x in parts[name]]) for name in parts.column_names}
            self.growth.split(trees, level, owner, place, found)
            if level == 0:
                for old in self.kept[:-1]:  # its rows have been read into the newer ones
                    old.unpersist()
                self.kept = self.kept[-1:]
        moved = self.state.mapInArrow(_moved(self._send(trees), self.growth, self.trees), _STATE)
        self.trees += 1
        if self.trees % WRITTEN_EVERY == 0:
            moved = written(moved)
            for value in self.sent:
                value.destroy()
            self.sent = []
        self.state = moved.persist()
        self.kept.append(self.state)
        return trees

    def errors(self) -> list[float]:
        """Root mean squared error of each sequence on the fold it leaves out, nan without rows."""
        sums = self.state.mapInArrow(_errors(self.growth), "sequence long, rows long, total double")
        sums = sums.groupBy("sequence").agg(F.sum("rows").alias("rows"), F.sum("total").alias("total"))
        return _rmse({r.sequence: (r.rows, r.total) for r in sums.collect()}, len(self.growth.sequences))

    def close(self) -> None:
        for old in self.kept:
            old.unpersist()
        for value in self.sent:
            value.destroy()


def _looked(data: Binned, sequences: list[Sequence_], looks: list[int], seed: int, sent_rows: int) -> dict[int, list[float]]:
    """Errors of all sequences after each number of trees in ``looks``."""
    if data.count > sent_rows:
        state, found = Boosting(data, sequences, seed), {}
        try:
            while state.trees < looks[-1]:
                state.grow()
                if state.trees in looks:
                    found[state.trees] = state.errors()
        finally:
            state.close()
        return found
    spark = data.rows.sparkSession
    growth = Growth(sequences, len(data.cuts), seed, data.scale)
    # Deep trees take longest, so they are dealt first.
    tasks = max(1, min(len(sequences), spark.sparkContext.defaultParallelism))
    order = sorted(range(len(sequences)), key=lambda s: -sequences[s].depth)
    blocks = data.rows.mapInArrow(_packed(data.cuts, 0), _STATE).drop("f")
    copies = blocks.withColumn("task", F.explode(F.sequence(F.lit(0), F.lit(tasks - 1)))).repartitionById(tasks, "task")
    grown = copies.mapInArrow(_whole(growth, [order[k::tasks] for k in range(tasks)], looks), "look long, sequence long, rows long, total double")
    held = grown.collect()  # a row for each sequence and look
    return {look: _rmse({r.sequence: (r.rows, r.total) for r in held if r.look == look}, len(sequences)) for look in looks}


def search(
    df: DataFrame,
    features: Sequence[str],
    label: str,
    key: Sequence[str],
    grid: Mapping[str, Sequence[float]],
    k: int = 3,
    fold: str = "fold",
    seed: int = 42,
    sent_rows: int = SENT_ROWS,
) -> list[tuple[dict[str, float], float]]:
    """``(setting, rmse)`` for every setting of ``grid``: the mean over ``k`` folds of the error on the fold left out."""
    settings = [dict(zip(grid, values)) for values in product(*grid.values())]
    full = [DEFAULTS | s for s in settings]
    same = [(s["maxDepth"], s["stepSize"], s["subsamplingRate"], s["minInstancesPerNode"]) for s in full]
    distinct = list(dict.fromkeys(same))
    sequences = [Sequence_(*d, fold=f) for d in distinct for f in range(k)]
    data = Binned(df, features, label, fold, key)
    found = _looked(data, sequences, sorted({s["maxIter"] for s in full}), seed, sent_rows)
    mean = {look: np.nanmean(np.array(errors).reshape(len(distinct), k), axis=1) for look, errors in found.items()}
    return [(setting, float(mean[s["maxIter"]][distinct.index(own)])) for setting, own, s in zip(settings, same, full)]
