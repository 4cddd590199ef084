"""Gradient boosting of regression trees on histograms, many models in lockstep.

Features are binned once to bytes and stored in chunks of rows. From then on a level of all models costs one job: a task
keeps, for each model and open node, counts and sums of the residuals by feature and bin; these add up, so partial sums of all
tasks meet by (model, node), where the best cut is found, and only cuts reach the driver. Models differ in their target and
in the rows that train them, so folds, targets and the runs that find the number of trees share every pass. A model ends
where a further tree improves the error of its held-out rows by less than a tolerance; models that follow it end with it.

Predictions are kept with the chunks' numbers and written anew every few trees; in between a task adds the latest trees itself.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricelake.session import bound_batches, cut, drop_stored

BINS = 32
CHUNK_ROWS = 1 << 16
STORE_EVERY = 5         # trees between two writes of the predictions
LEAST_ROWS = 5          # of a leaf
SKETCH_ERROR = 0.002


@dataclass(frozen=True)
class Model:
    """What one model learns: a target column, a boolean column of training rows, and either a boolean column of rows that
    decide when it ends or the name of the model that decides for it (or neither)."""

    name: str
    target: str
    train: str
    held: str | None = None
    follows: str | None = None


@dataclass
class Trees:
    """The grown trees of one model. Node 1 is a root, the children of node i are 2i and 2i + 1; a leaf has feature -1."""

    feature: list[np.ndarray] = field(default_factory=list)
    bin: list[np.ndarray] = field(default_factory=list)
    value: list[np.ndarray] = field(default_factory=list)
    gain: list[np.ndarray] = field(default_factory=list)
    rows: list[np.ndarray] = field(default_factory=list)

    def __len__(self) -> int:
        return len(self.feature)

    def plant(self, nodes: int) -> None:
        self.feature.append(np.full(nodes, -1, np.int16))
        self.bin.append(np.zeros(nodes, np.uint8))
        for each in (self.value, self.gain, self.rows):
            each.append(np.zeros(nodes))

    def since(self, first: int) -> Trees:
        """What a task needs of the trees from number `first` on."""
        return Trees(self.feature[first:], self.bin[first:], self.value[first:])

    def cut_to(self, count: int) -> None:
        for each in (self.feature, self.bin, self.value, self.gain, self.rows):
            del each[count:]


def edges_of(table: DataFrame, features: list[str], bins: int = BINS) -> list[np.ndarray]:
    """For each feature at most bins - 1 rising cuts, from one sketch of all features; a value up to the first cut has bin 0."""
    probes = [i / bins for i in range(1, bins)]
    found = table.approxQuantile(features, probes, SKETCH_ERROR)
    return [np.unique(np.array(cuts, np.float64)) for cuts in found]


def coded(columns: list[np.ndarray], edges: list[np.ndarray]) -> np.ndarray:
    """Bins as bytes, a row for each feature. NaN has bin 0."""
    codes = np.empty((len(columns), len(columns[0]) if columns else 0), np.uint8)
    for i, (values, cuts) in enumerate(zip(columns, edges, strict=True)):
        codes[i] = np.where(np.isnan(values), 0, np.searchsorted(cuts, values, "left"))
    return codes


def _numbers(column: pa.Array) -> np.ndarray:
    return column.to_numpy(zero_copy_only=False).astype(np.float64)


def chunked(table: DataFrame, features: list[str], models: list[Model], edges: list[np.ndarray],
            keep: list[str]) -> DataFrame:
    """The table in chunks: codes, targets and masks as packed bytes, and the columns `keep` as lists. Null targets and null
    masks count as 0 and false."""
    targets, masks = _targets(models), _masks(models)
    schema = "chunk string, n int, codes binary, targets binary, masks binary"
    kinds = {name: table.schema[name].dataType.simpleString() for name in keep}
    schema += "".join(f", `{name}` array<{kind}>" for name, kind in kinds.items())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, number = TaskContext.get().partitionId(), 0
        held: list[pa.RecordBatch] = []

        def closed() -> pa.RecordBatch:
            nonlocal number
            rows = pa.Table.from_batches(held).combine_chunks()
            column = {name: rows[name].chunk(0) for name in rows.column_names}
            codes = coded([_numbers(column[f]) for f in features], edges)
            y = np.vstack([np.nan_to_num(_numbers(column[t])) for t in targets])
            on = np.vstack([column[m].fill_null(False).to_numpy(zero_copy_only=False) for m in masks]).astype(np.uint8)
            number += 1
            places = pa.array([0, len(rows)], pa.int32())
            return pa.RecordBatch.from_pydict({
                "chunk": pa.array([f"{part}-{number}"]), "n": pa.array([len(rows)], pa.int32()),
                "codes": pa.array([codes.tobytes()], pa.binary()), "targets": pa.array([y.tobytes()], pa.binary()),
                "masks": pa.array([on.tobytes()], pa.binary()),
                **{name: pa.ListArray.from_arrays(places, column[name]) for name in keep}})

        for batch in batches:
            held.append(batch)
            if sum(b.num_rows for b in held) >= CHUNK_ROWS:
                yield closed()
                held = []
        if any(b.num_rows for b in held):
            yield closed()

    needed = list(dict.fromkeys([*features, *targets, *masks, *keep]))
    return table.select(*needed).mapInArrow(run, schema)


def _targets(models: list[Model]) -> list[str]:
    return list(dict.fromkeys(m.target for m in models))


def _masks(models: list[Model]) -> list[str]:
    return list(dict.fromkeys(name for m in models for name in (m.train, m.held) if name))


def routed(codes: np.ndarray, feature: np.ndarray, bins: np.ndarray, levels: int) -> np.ndarray:
    """The node of each row after so many levels."""
    rows = np.arange(codes.shape[1])
    node = np.ones(codes.shape[1], np.int64)
    flat, feature = codes.ravel(), feature.astype(np.int64)
    for _ in range(levels):
        chosen = feature[node]
        right = flat[np.maximum(chosen, 0) * codes.shape[1] + rows] > bins[node]
        node = np.where(chosen >= 0, 2 * node + right, node)
    return node


def predicted(codes: np.ndarray, trees: Trees, start: int, step: float, depth: int) -> np.ndarray:
    """What the trees add, of which the first is number `start` of its model. Number 0 counts whole, later ones by `step`."""
    total = np.zeros(codes.shape[1])
    for feature, bins, value in zip(trees.feature, trees.bin, trees.value, strict=True):
        total += value[routed(codes, feature, bins, depth)] * (step if start else 1.0)
        start += 1
    return total


class Chunk:
    """One stored chunk in a task."""

    def __init__(self, batch: pa.RecordBatch, row: int, features: int, targets: int, masks: int, models: int):
        n = batch["n"][row].as_py()
        read = lambda name, kind, rows: np.frombuffer(batch[name][row].as_buffer(), kind).reshape(rows, n)
        self.n, self.name = n, batch["chunk"][row].as_py()
        self.codes, self.targets = read("codes", np.uint8, features), read("targets", np.float64, targets)
        self.masks = read("masks", np.uint8, masks).astype(bool)
        stored = batch["kept"][row].as_buffer() if "kept" in batch.schema.names else None
        self.kept = np.frombuffer(stored, np.float64).reshape(models, n) if stored is not None else np.zeros((models, n))


HISTOGRAM = "model int, node int, sums binary"
SPLIT = "model int, node int, feature int, bin int, gain double, rows double, value double, left_rows double, left_value double, right_value double"
JUDGED = 0      # the node number under which a model's held-out error travels


def _best(least: int, features: int, bins: int):
    """Adds up the partial histograms of one model and node and finds its best cut."""

    def run(parts: pa.Table) -> pa.Table:
        total = np.zeros(0)
        for part in parts["sums"]:
            own = np.frombuffer(part.as_buffer(), np.float64)
            total = total + own if len(total) else own.copy()
        model, node = parts["model"][0].as_py(), parts["node"][0].as_py()
        if node == JUDGED:
            found = (-1, 0, 0.0, total[1], total[0], 0.0, 0.0, 0.0)
        else:
            found = best_cut(total[:features * bins].reshape(features, bins), total[features * bins:].reshape(features, bins), least)
        columns = [pa.array([v], kind) for v, kind in zip(
            (model, node, *found), [pa.int32()] * 4 + [pa.float64()] * 6, strict=True)]
        return pa.Table.from_arrays(columns, names=[c.split()[0] for c in SPLIT.split(", ")])

    return run


def best_cut(counts: np.ndarray, sums: np.ndarray, least: int) -> tuple:
    """feature, bin, gain, rows, value, left rows, left and right value of the cut with the largest gain, the first of equal
    ones; feature -1 if no cut leaves enough rows on both sides or gains anything."""
    n, g = counts[0].sum(), sums[0].sum()
    left_n, left_g = np.cumsum(counts, 1)[:, :-1], np.cumsum(sums, 1)[:, :-1]
    right_n, right_g = n - left_n, g - left_g
    fits = (left_n >= max(least, 1)) & (right_n >= max(least, 1))
    with np.errstate(divide="ignore", invalid="ignore"):
        apart = left_g / left_n - right_g / right_n
        gain = np.where(fits, left_n * right_n / max(n, 1) * apart ** 2, -np.inf)
    if not gain.size or not gain.max() > 1e-18 * g * g:
        return (-1, 0, 0.0, n, g / max(n, 1), 0.0, 0.0, 0.0)
    at = np.unravel_index(gain.argmax(), gain.shape)
    return (int(at[0]), int(at[1]), float(gain[at]), n, g / n, left_n[at], left_g[at] / left_n[at], right_g[at] / right_n[at])


@dataclass
class Forest:
    """Grown models with what is needed to apply them."""

    features: list[str]
    edges: list[np.ndarray]
    models: dict[str, Trees]
    step: float
    depth: int
    held_error: dict[str, list[float]]

    def predict(self, name: str, columns: list[np.ndarray]) -> np.ndarray:
        """Predictions of one model for feature columns in the order of `features`."""
        return predicted(coded(columns, self.edges), self.models[name], 0, self.step, self.depth)

    def nodes(self, spark: SparkSession) -> DataFrame:
        """The models as a relation: model, tree, node, feature (null in a leaf), cut (values up to it go to node * 2), gain,
        rows, value. It is bounded by the parameters."""
        made = []
        for name, trees in self.models.items():
            for t in range(len(trees)):
                there = np.zeros(len(trees.feature[t]), bool)
                there[1] = True
                for node in range(1, len(there)):
                    if there[node]:
                        f = int(trees.feature[t][node])
                        if f >= 0:
                            there[2 * node] = there[2 * node + 1] = True
                        made.append((name, t, node, self.features[f] if f >= 0 else None,
                                     float(self.edges[f][trees.bin[t][node]]) if f >= 0 else None,
                                     *(float(each[t][node]) for each in (trees.gain, trees.rows, trees.value))))
        return spark.createDataFrame(
            made, "model string, tree int, node int, feature string, cut double, gain double, rows double, value double")


def importances(nodes: DataFrame, top: int = 5) -> DataFrame:
    """For each model of a node table the features with the largest share of all gains: model, feature, share."""
    from pyspark.sql import Window

    gains = nodes.filter(F.col("feature").isNotNull()).groupBy("model", "feature").agg(F.sum("gain").alias("gain"))
    share = F.col("gain") / F.sum("gain").over(Window.partitionBy("model"))
    place = F.row_number().over(Window.partitionBy("model").orderBy(F.desc("share"), "feature"))
    return gains.select("model", "feature", share.alias("share")).withColumn("_place", place).filter(
        F.col("_place") <= top).drop("_place")


def grow(table: DataFrame, features: list[str], models: list[Model], rounds: int, step: float, depth: int,
         tolerance: float = 0.001, bins: int = BINS, least: int = LEAST_ROWS, edges: list[np.ndarray] | None = None,
         keep: list[str] | None = None) -> tuple[Forest, DataFrame]:
    """Grow all models; also give, for every row, the columns `keep` and `predictions`, a map from model to its last value.

    `table` is read twice (sketch and chunks) and should be stored. Rows that train nothing get predictions too. A model
    without training rows predicts 0. Rerunning gives the same trees up to the order of sums.
    """
    bound_batches(table.sparkSession)       # a chunk is a row of some megabytes
    keep = keep or []
    edges = edges if edges is not None else edges_of(table, features, bins)
    bins = max([len(e) for e in edges], default=0) + 1
    targets, masks = _targets(models), _masks(models)
    chunks = cut(chunked(table, features, models, edges, keep), "boosting-chunks")
    grown = {m.name: Trees() for m in models}
    errors: dict[str, list[float]] = {m.name: [] for m in models if m.held}
    open_ = {m.name for m in models}
    sizes = (len(features), len(targets), len(masks), len(models))
    state, stored, kept_trees = chunks, None, 0

    def task(level: int, first: int, growing: list[int]):
        """Histograms of one level; at level 0 also the held-out errors before this tree."""
        trees = [grown[m.name].since(first) for m in models]

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            sums: dict[tuple[int, int], np.ndarray] = {}

            def add(key: tuple[int, int], values: np.ndarray) -> None:
                sums[key] = sums[key] + values if key in sums else values

            for batch in batches:
                for row in range(batch.num_rows):
                    chunk = Chunk(batch, row, *sizes)
                    for m in growing:
                        model, own = models[m], trees[m]
                        done = Trees(own.feature[:-1], own.bin[:-1], own.value[:-1])
                        residual = chunk.targets[targets.index(model.target)] - chunk.kept[m] - predicted(
                            chunk.codes, done, first, step, depth)
                        if level == 0 and model.held:
                            held = residual[chunk.masks[masks.index(model.held)]]
                            add((m, JUDGED), np.array([(held ** 2).sum(), len(held)]))
                        node = routed(chunk.codes, own.feature[-1], own.bin[-1], level) - (1 << level)
                        at = np.flatnonzero(chunk.masks[masks.index(model.train)] & (node >= 0))
                        node, residual = node[at], residual[at]
                        made = np.empty((2, 1 << level, len(features), bins))
                        for f in range(len(features)):
                            key = node * bins + chunk.codes[f][at]
                            made[0, :, f] = np.bincount(key, minlength=bins << level).reshape(-1, bins)
                            made[1, :, f] = np.bincount(key, residual, bins << level).reshape(-1, bins)
                        for i in np.flatnonzero(made[0, :, 0].sum(1)).tolist():
                            add((m, i + (1 << level)), made[:, i].ravel())
            if sums:
                yield pa.RecordBatch.from_pydict({
                    "model": pa.array([k[0] for k in sums], pa.int32()), "node": pa.array([k[1] for k in sums], pa.int32()),
                    "sums": pa.array([v.tobytes() for v in sums.values()], pa.binary())})

        return run

    def written(first: int) -> DataFrame:
        """The predictions of all chunks, stored."""
        trees = [grown[m.name].since(first) for m in models]

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                made = []
                for row in range(batch.num_rows):
                    chunk = Chunk(batch, row, *sizes)
                    made.append((chunk.kept + np.vstack([predicted(chunk.codes, t, first, step, depth) for t in trees])).tobytes())
                others = [n for n in batch.schema.names if n != "kept"]
                yield pa.RecordBatch.from_pydict({**{n: batch[n] for n in others}, "kept": pa.array(made, pa.binary())})

        names = chunks.columns
        schema = ", ".join(f"`{n}` {chunks.schema[n].dataType.simpleString()}" for n in names) + ", kept binary"
        source = state if "kept" in state.columns else state.select(*names)
        return cut(source.mapInArrow(run, schema), "boosting-state")

    for t in range(rounds + 1):
        growing = [i for i, m in enumerate(models) if m.name in open_]
        if not growing or t == rounds and not any(models[i].held for i in growing):
            break
        for i in growing:
            grown[models[i].name].plant(1 << depth + 1)
        for level in range(depth):
            narrow = state.drop(*keep)
            found = narrow.mapInArrow(task(level, kept_trees, growing), HISTOGRAM).groupBy("model", "node").applyInArrow(
                _best(least, len(features), bins), SPLIT).collect()
            if level == 0:
                _judge(found, models, errors, open_, grown, t, tolerance)
                growing = [i for i in growing if models[i].name in open_]
                if t == rounds:     # the last trees have been judged; this one is not grown
                    for i in growing:
                        grown[models[i].name].cut_to(rounds)
                    open_.clear()
                    growing = []
            splits = [r for r in found if r.node != JUDGED and models[r.model].name in open_]
            for r in splits:
                _put(grown[models[r.model].name], r)
            if not any(r.feature >= 0 for r in splits):
                break
        if open_ and (t + 1) % STORE_EVERY == 0:
            before, state = stored, written(kept_trees)
            stored, kept_trees = state, t + 1
            if before is not None:
                drop_stored(before)
    if stored is not None:
        drop_stored(stored)
    forest = Forest(features, edges, grown, step, depth, errors)
    return forest, _all_predictions(chunks, forest, models, sizes, keep)


def _put(trees: Trees, split) -> None:
    trees.value[-1][split.node], trees.rows[-1][split.node] = split.value, split.rows
    if split.feature >= 0:
        trees.feature[-1][split.node], trees.bin[-1][split.node] = split.feature, split.bin
        trees.gain[-1][split.node] = split.gain
        left, right = 2 * split.node, 2 * split.node + 1
        trees.value[-1][left], trees.value[-1][right] = split.left_value, split.right_value
        trees.rows[-1][left], trees.rows[-1][right] = split.left_rows, split.rows - split.left_rows


def _judge(found: list, models: list[Model], errors: dict, open_: set, grown: dict[str, Trees], t: int, tolerance: float) -> None:
    """Close the models whose last tree did not improve the held-out error enough, and those that follow them."""
    judged = {models[r.model].name: r.value / r.rows for r in found if r.node == JUDGED and r.rows}
    for name, error in judged.items():
        errors[name].append(error)
        # the error before any tree is not compared: the first tree always stays
        if t >= 2 and errors[name][-2] - error < tolerance * max(error, 0.01):
            for model in models:
                if name in (model.name, model.follows):
                    grown[model.name].cut_to(t - 1)
                    open_.discard(model.name)


def _all_predictions(chunks: DataFrame, forest: Forest, models: list[Model], sizes: tuple, keep: list[str]) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                chunk = Chunk(batch, row, *sizes)
                values = np.vstack([predicted(chunk.codes, forest.models[m.name], 0, forest.step, forest.depth) for m in models])
                names = pa.array([m.name for m in models] * chunk.n)
                places = pa.array(np.arange(chunk.n + 1, dtype=np.int32) * len(models))
                yield pa.RecordBatch.from_pydict({
                    **{n: batch[n].slice(row, 1).flatten() for n in keep},
                    "predictions": pa.MapArray.from_arrays(places, names, pa.array(values.T.ravel()))})

    schema = "".join(f"`{n}` {chunks.schema[n].dataType.elementType.simpleString()}, " for n in keep)
    return chunks.mapInArrow(run, schema + "predictions map<string,double>")
