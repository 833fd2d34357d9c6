"""Fitted tree ensembles as flat tables: margins of single trees, partial scores, contributions.

MLlib fits the trees and writes their nodes; here the nodes are laid out as arrays, which are sent to the tasks (a few
dozen bytes a node). A batch of rows walks down all trees of its fold at once, so one pass over the rows gives, for each
row and tree, the leaf it reaches. From the leaves follow the margins of every tree, scores in which only the trees of one
feature are walked again, and the contribution of each feature to the margin.
"""

from __future__ import annotations

import sys
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from featurelab.operators.folds import FOLD

BATCH = 4096  # rows that walk together

# workers need not have this package: what they run of this module travels with the task
cloudpickle.register_pickle_by_value(sys.modules[__name__])


@dataclass(frozen=True)
class Forest:
    """Nodes of all trees in one numbering; a leaf is its own child.

    `codes` holds, for splits of categories, which codes go left (a row of it for each such node).
    """

    roots: np.ndarray  # node of each tree
    weights: np.ndarray  # of each tree
    feature: np.ndarray
    cut: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    leaf: np.ndarray
    gain: np.ndarray  # gain times rows, 0 in leaves
    by_code: np.ndarray  # row in `codes`, -1 for splits by value
    codes: np.ndarray
    depth: int

    @property
    def trees(self) -> int:
        return len(self.roots)

    def leaves(self, x: np.ndarray, trees: np.ndarray | None = None) -> np.ndarray:
        """rows x trees: the leaf of each tree that each row reaches."""
        roots = self.roots if trees is None else self.roots[trees]
        node = np.tile(roots, (len(x), 1))
        rows = np.arange(len(x))[:, None]
        for _ in range(self.depth):
            value = x[rows, self.feature[node]]
            down = value <= self.cut[node]
            if len(self.codes):
                at = self.by_code[node]
                code = np.clip(np.nan_to_num(value), 0, self.codes.shape[1] - 1).astype(np.int64)
                down = np.where(at >= 0, self.codes[at, code], down)
            node = np.where(down, self.left[node], self.right[node])
        return node

    def margins(self, x: np.ndarray, trees: np.ndarray | None = None) -> np.ndarray:
        """rows x trees: weighted output of each tree."""
        weights = self.weights if trees is None else self.weights[trees]
        return self.value[self.leaves(x, trees)] * weights

    def users(self) -> dict[int, np.ndarray]:
        """The trees that split on each feature that is used at all."""
        tree_of = np.searchsorted(self.roots, np.arange(len(self.feature)), side="right") - 1
        inner = ~self.leaf
        return {int(f): np.unique(tree_of[inner & (self.feature == f)]) for f in np.unique(self.feature[inner])}

    def paths(self, features: int) -> np.ndarray:
        """nodes x features: the change of the output on the way to each node, credited to the features split on."""
        credit = np.zeros((len(self.feature), features))
        for node in range(len(self.feature)):  # parents come before their children
            if not self.leaf[node]:
                for child in (self.left[node], self.right[node]):
                    credit[child] = credit[node]
                    credit[child, self.feature[node]] += self.value[child] - self.value[node]
        return credit


def forest_of(nodes: Sequence, weights: Sequence[float]) -> Forest:
    """From rows of (treeID, nodeData) as MLlib saves them, sorted by tree and node."""
    size = len(nodes)
    first: dict[int, int] = {}
    place = {}
    for i, row in enumerate(nodes):
        first.setdefault(row["treeID"], i)
        place[row["treeID"], row["nodeData"]["id"]] = i
    own = np.arange(size)
    feature, left, right = np.zeros(size, np.int64), own.copy(), own.copy()
    cut, by_code = np.full(size, np.inf), np.full(size, -1)
    value, gain, sets, depth = np.zeros(size), np.zeros(size), [], np.zeros(size, np.int64)
    for i, row in enumerate(nodes):
        data = row["nodeData"]
        value[i] = data["prediction"]
        if data["leftChild"] < 0:
            continue
        split = data["split"]
        left[i], right[i] = place[row["treeID"], data["leftChild"]], place[row["treeID"], data["rightChild"]]
        depth[[left[i], right[i]]] = depth[i] + 1
        feature[i], gain[i] = split["featureIndex"], data["gain"] * data["impurityStats"][0]
        if split["numCategories"] >= 0:
            by_code[i] = len(sets)
            sets.append((split["numCategories"], split["leftCategoriesOrThreshold"]))
        else:
            cut[i] = split["leftCategoriesOrThreshold"][0]
    codes = np.zeros((len(sets), max([n for n, _ in sets], default=0)), bool)
    for i, (_, those) in enumerate(sets):
        codes[i, np.asarray(those, int)] = True
    roots = np.array([first[t] for t in sorted(first)])
    return Forest(
        roots, np.asarray(weights, float), feature, cut, left, right, value, left == own, gain, by_code, codes,
        int(depth.max(initial=0)),
    )


def _batches(batches, forests: Mapping[int, Forest], columns: int):
    """(fold, forest, rows of one fold: values of the first `columns` numbers, the batch itself)."""
    for batch in batches:
        folds = batch.column(0).to_numpy(zero_copy_only=False)
        for fold in np.unique(folds):
            mine = batch.filter(pa.array(folds == fold))
            for at in range(0, mine.num_rows, BATCH):
                part = mine.slice(at, BATCH)
                yield int(fold), forests[int(fold)], part


def _matrix(batch: pa.RecordBatch, start: int, count: int) -> np.ndarray:
    """rows x columns; without a value a row goes right, as with MLlib."""
    if not count:
        return np.zeros((batch.num_rows, 0))
    return np.stack(
        [batch.column(i).to_numpy(zero_copy_only=False).astype(float) for i in range(start, start + count)], axis=1
    )


def running_margins(df: DataFrame, forests: Mapping[int, Forest], values: Sequence[Column], label: str) -> DataFrame:
    """(fold_id, label, margins): the score of each row by the first tree, the first two, and so on."""
    count = len(values)

    def walk(batches):
        for fold, forest, part in _batches(batches, forests, count):
            sums = np.cumsum(forest.margins(_matrix(part, 2, count)), axis=1)
            columns = [part.column(0), part.column(1), pa.array(list(sums), pa.list_(pa.float64()))]
            yield pa.RecordBatch.from_arrays(columns, [FOLD, "label", "margins"])

    narrow = df.select(FOLD, F.col(label).alias("label"), *[v.alias(f"x{i}") for i, v in enumerate(values)])
    return narrow.mapInArrow(walk, f"{FOLD} int, label double, margins array<double>")


def exchanged_scores(
    df: DataFrame,
    forests: Mapping[int, Forest],
    values: Sequence[Column],
    exchanged: Sequence[Sequence[Column]],
    label: str,
) -> DataFrame:
    """(fold_id, feature int, repeat int, label, score, rows): scores with one feature's values exchanged.

    Each row is read once and carries the exchanged values of all features, `exchanged` having a list of them for each
    repeat. Only the trees that split on a feature walk again; the margins of the others are kept. Features that no tree
    of the fold uses give no rows. Feature -1 is the score without exchange. Equal rows of a batch are counted.
    """
    count, repeats = len(values), len(exchanged)

    def walk(batches):
        users = {fold: forest.users() for fold, forest in forests.items()}
        for fold, forest, part in _batches(batches, forests, count):
            y = part.column(1).to_numpy(zero_copy_only=False).astype(float)
            x = _matrix(part, 2, count)
            margins = forest.margins(x)
            scores = [(-1, 0, margins.sum(axis=1))]
            for feature, trees in users[fold].items() if repeats else ():
                kept = margins.copy()
                kept[:, trees] = 0.0
                kept = kept.sum(axis=1)
                for repeat in range(repeats):
                    other = x.copy()
                    other[:, feature] = _matrix(part, 2 + count * (repeat + 1) + feature, 1)[:, 0]
                    scores.append((feature, repeat, kept + forest.margins(other, trees).sum(axis=1)))
            for feature, repeat, score in scores:
                pairs = np.empty(len(y), complex)  # as one number, label and score sort much faster
                pairs.real, pairs.imag = y, score + 0.0
                points, times = np.unique(pairs, return_counts=True)
                n = len(points)
                columns = [np.full(n, fold), np.full(n, feature), np.full(n, repeat), points.real, points.imag, times]
                kinds = [pa.int32(), pa.int32(), pa.int32(), pa.float64(), pa.float64(), pa.int64()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(columns, kinds)], [FOLD, "feature", "repeat", "label", "score", "rows"]
                )

    every = [*values, *[v for one in exchanged for v in one]]
    narrow = df.select(FOLD, label, *[v.alias(f"x{i}") for i, v in enumerate(every)])
    return narrow.mapInArrow(walk, f"{FOLD} int, feature int, repeat int, label double, score double, rows bigint")


def path_contributions(
    df: DataFrame, forests: Mapping[int, Forest], values: Sequence[Column], names: Sequence[str]
) -> DataFrame:
    """(fold_id, feature_name, importance): mean absolute contribution of each feature to the margin.

    On a row's way down a tree each change of the node's value is credited to the feature split on; a row's contribution is
    the sum over all trees. Sums are taken in the tasks, so a task passes on one row for each fold and feature.
    """
    count = len(values)

    def walk(batches):
        credit = {fold: forest.paths(count) for fold, forest in forests.items()}
        sums = {fold: [np.zeros(count), 0] for fold in forests}
        for fold, forest, part in _batches(batches, forests, count):
            leaves = forest.leaves(_matrix(part, 1, count))
            total = np.zeros((len(leaves), count))
            for tree, weight in enumerate(forest.weights):
                total += weight * credit[fold][leaves[:, tree]]
            sums[fold][0] += np.abs(total).sum(axis=0)
            sums[fold][1] += len(leaves)
        for fold, (total, rows) in sums.items():
            columns = [np.full(count, fold), np.arange(count), total, np.full(count, rows)]
            kinds = [pa.int32(), pa.int32(), pa.float64(), pa.int64()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)], [FOLD, "feature", "total", "rows"]
            )

    narrow = df.select(FOLD, *[v.alias(f"x{i}") for i, v in enumerate(values)])
    parts = narrow.mapInArrow(walk, f"{FOLD} int, feature int, total double, rows bigint")
    name = F.get(F.array(*map(F.lit, names)), F.col("feature")).alias("feature_name")
    sums = parts.groupBy(FOLD, name).agg(F.sum("total").alias("total"), F.sum("rows").alias("rows"))
    return sums.select(FOLD, "feature_name", F.coalesce(F.try_divide("total", "rows"), F.lit(0.0)).alias("importance"))
