"""A decision tree whose cuts are tried between all values of its predictors.

A tree of squared error (for a label of 0 and 1 its cuts are those of the Gini impurity, and a leaf's mean is
the share of ones). Rows with equal predictors go together through any cut: they are one *point*, with their
number and the moments of their labels, before anything else happens. Points are written once. The tree grows a
level at a time, all nodes of more than ``LOCAL_ROWS`` points at once; a pass over the points finds their nodes anew
and moves sums only: first those of each node, then those of ranges of each predictor's values (*cells*). The sums
of a cell bound the gain of every cut inside it. Only cells whose bound reaches the best cut between cells are opened:
their values with the label's sums, in value order, give the gain of every cut inside as one projection over
running totals. A node of at most ``LOCAL_ROWS`` points is finished in one task, its whole subtree, by the same rule.
Neither a task nor the driver holds more than such a node, ``CELLS`` sums and the cuts of the larger nodes.

Nodes are split until their labels are equal or their rows cannot be told apart (or ``depth`` is reached).
The cut lies midway between two neighbouring values. Of cuts whose gains agree to ``DIGITS`` digits of the
node's variation, the first predictor's smallest counts, so a recomputed sum cannot choose another one.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimlens.operators.running import running_totals
from claimlens.session import stage, with_package

LOCAL_ROWS = 20_000  # points of a node that one task finishes
DIGITS = 9
PASSENGERS = 100_000  # rows that meet a subtree in one task
CELLS = 1 << 18  # of all nodes that one pass looks at
NODE_CELLS = 16, 1024  # of a node and predictor, at least and at most
SAMPLE = 50_000  # points that the borders of cells are drawn from; any borders give the same tree
SLACK = 1e-9  # of a gain: what rounding may take from a bound

# Nodes breadth first: the predictor that cuts a node and where, or -1 and the mean of a leaf.
_SUBTREE = "feature array<smallint>, number array<double>"


@dataclass
class Top:
    """The nodes that were reached over all executors, in the order in which they were: ``child`` is the place of
    a node's left child (its right child is the next), 0 where the tree goes on in a subtree."""

    feature: np.ndarray = field(default_factory=lambda: np.full(1, -1))
    threshold: np.ndarray = field(default_factory=lambda: np.zeros(1))
    child: np.ndarray = field(default_factory=lambda: np.zeros(1, np.int64))
    level: np.ndarray = field(default_factory=lambda: np.zeros(1, np.int64))

    def split(self, nodes: np.ndarray, feature: np.ndarray, threshold: np.ndarray) -> np.ndarray:
        """Cut ``nodes``; gives their children."""
        n, added = len(self.child), 2 * len(nodes)
        self.feature[nodes], self.threshold[nodes], self.child[nodes] = feature, threshold, n + 2 * np.arange(len(nodes))
        self.feature = np.append(self.feature, np.full(added, -1))
        self.threshold = np.append(self.threshold, np.zeros(added))
        self.child = np.append(self.child, np.zeros(added, np.int64))
        self.level = np.append(self.level, np.repeat(self.level[nodes] + 1, 2))
        return n + np.arange(added)


def _fallen(at: np.ndarray, x: np.ndarray, feature: np.ndarray, threshold: np.ndarray, child: np.ndarray) -> np.ndarray:
    """Where rows come to rest that start at ``at``."""
    at = at.copy()
    moving = np.flatnonzero(child[at] > 0)
    while len(moving):
        node = at[moving]
        at[moving] = child[node] + (x[moving, feature[node]] > threshold[node])
        moving = moving[child[at[moving]] > 0]
    return at


def _columns(batch: pa.RecordBatch, names: list[str]) -> np.ndarray:
    return np.stack([batch.column(n).to_numpy(zero_copy_only=False) for n in names], 1)


@dataclass
class ExactTree:
    """``top``: the nodes that were split over all executors; ``cuts``: how many of them each level has.
    ``subtrees``: a row per node of ``top`` that was not."""

    predictors: list[str]
    top: Top
    cuts: list[int]
    subtrees: DataFrame

    def predict(self, rows: DataFrame, name: str = "prediction") -> DataFrame:
        """``rows`` with the mean label of each row's leaf. Predictors must not be null."""
        with_package(rows.sparkSession)
        placed = stage(_placed(rows, self.predictors, self.top), "tree-rows")
        # A subtree that many rows share goes to several tasks, and they are dealt to them.
        counts = stage(placed.groupBy(F.col("__path").alias("path")).agg(F.count(F.lit(1)).alias("n")), "tree-paths")
        parts = F.ceil(F.col("n") / PASSENGERS).cast("int")
        trees = self.subtrees.join(counts.withColumn("parts", parts), "path")
        trees = trees.withColumn("part", F.explode(F.expr("sequence(0, parts - 1)"))).drop("n", "parts")
        dealt = placed.withColumn("__part", F.monotonically_increasing_id())
        dealt = dealt.join(counts.select(F.col("path").alias("__path"), parts.alias("__parts")), "__path").select(
            "__path", F.pmod("__part", "__parts").cast("int").alias("__part"),
            F.struct(*(F.col(f"`{c}`") for c in rows.columns)).alias("__row"),
            F.array(*(F.col(p).cast("double") for p in self.predictors)).alias("__x"),
        )
        width = len(self.predictors)

        def answer(rows: pa.Table, tree: pa.Table) -> pa.Table:
            values = []
            if rows.num_rows:
                feature, number = (tree.column(c)[0].values.to_numpy() for c in ("feature", "number"))
                # Children follow in the order of the nodes that are cut.
                child = np.where(feature >= 0, 2 * np.cumsum(feature >= 0) - 1, 0)
                for chunk in rows.column("__x").chunks:
                    x = chunk.flatten().to_numpy().reshape(-1, width)
                    values.append(number[_fallen(np.zeros(len(x), np.int64), x, feature, number, child)])
            return pa.table({"__row": rows.column("__row"), "__prediction": pa.chunked_array(values, pa.float64())})

        schema = T.StructType([dealt.schema["__row"], T.StructField("__prediction", T.DoubleType())])
        found = dealt.groupBy("__path", "__part").cogroup(trees.groupBy("path", "part")).applyInArrow(answer, schema)
        return found.select("__row.*", F.col("__prediction").alias(name))


def _placed(rows: DataFrame, predictors: list[str], top: Top) -> DataFrame:
    """``rows`` with the node of ``top`` where each comes to rest, __path."""
    schema = T.StructType([*rows.schema.fields, T.StructField("__path", T.LongType())])
    if not top.child[0]:
        return rows.withColumn("__path", F.lit(0).cast("bigint"))
    own = [f"__x{j}" for j in range(len(predictors))]
    shared = rows.sparkSession.sparkContext.broadcast((top.feature, top.threshold, top.child))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = _fallen(np.zeros(batch.num_rows, np.int64), _columns(batch, own), *shared.value)
            kept = batch.columns[: -len(own)]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(at)], names=schema.names)

    values = (F.col(p).cast("double").alias(x) for p, x in zip(predictors, own, strict=True))
    return rows.select("*", *values).mapInArrow(place, schema)


@dataclass
class Points:
    """Per point: its predictors, number of rows, the labels' mean, sum of squares around it, and extremes."""

    x: np.ndarray
    n: np.ndarray
    mean: np.ndarray
    square: np.ndarray
    low: np.ndarray
    high: np.ndarray


def grown(x: np.ndarray, y: np.ndarray, depth: int | None = None) -> tuple[np.ndarray, ...]:
    """The whole tree of rows held in memory: (feature, threshold, child, value) of its nodes, breadth first."""
    return grown_from(Points(x, np.ones(len(y)), y, np.zeros(len(y)), y, y), depth)


def grown_from(points: Points, depth: int | None = None) -> tuple[np.ndarray, ...]:
    """The whole tree of points held in memory."""
    x = points.x
    n_points, n_features = x.shape
    order = [np.argsort(x[:, j], kind="stable") for j in range(n_features)]
    feature, threshold, child, value = [], [], [], []
    node = np.zeros(n_points, np.int64)  # of this level; -1 where the point has reached a leaf
    width, level = 1, 0
    while width:
        inside = np.flatnonzero(node >= 0)
        at = node[inside]
        n = np.bincount(at, points.n[inside], minlength=width)
        mean = np.bincount(at, points.n[inside] * points.mean[inside], minlength=width) / n
        low, high = np.full(width, np.inf), np.full(width, -np.inf)
        np.minimum.at(low, at, points.low[inside])
        np.maximum.at(high, at, points.high[inside])
        around = points.mean[inside] - mean[at]
        spread = np.bincount(at, points.square[inside] + points.n[inside] * around**2, minlength=width)
        best, cut_feature, cut_at = np.full(width, -np.inf), np.full(width, -1), np.zeros(width)
        if depth is None or level < depth:
            for j in range(n_features):
                by = order[j][node[order[j]] >= 0]
                by = by[np.argsort(node[by], kind="stable")]
                of, v = node[by], x[by, j]
                # Labels around their node's mean: the running sums of a node stay small.
                starts = np.searchsorted(of, np.arange(width))
                count = _running(points.n[by], starts, of)
                sums = _running(points.n[by] * (points.mean[by] - mean[of]), starts, of)
                last = np.flatnonzero((of[:-1] == of[1:]) & (v[:-1] < v[1:]))
                last = last[low[of[last]] < high[of[last]]]
                gain = _gain(count[last], sums[last], n[of[last]], spread[of[last]])
                ranked = np.lexsort((last, -gain, of[last]))
                heads = ranked[np.r_[True, of[last][ranked][1:] != of[last][ranked][:-1]]] if len(ranked) else ranked
                for k in heads:
                    i, g = of[last[k]], gain[k]
                    if g > best[i]:
                        best[i], cut_feature[i], cut_at[i] = g, j, _middle(v[last[k]], v[last[k] + 1])
        split = cut_feature >= 0
        first = len(feature) + width
        place = np.cumsum(split) - 1
        feature += cut_feature.tolist()
        threshold += cut_at.tolist()
        value += mean.tolist()
        child += np.where(split, first + 2 * place, 0).tolist()
        rows = inside[split[at]]
        at = node[rows]
        node = np.full(n_points, -1)
        node[rows] = 2 * place[at] + (x[rows, cut_feature[at]] > cut_at[at])
        width, level = 2 * int(split.sum()), level + 1
    return np.array(feature, np.int32), np.array(threshold), np.array(child, np.int32), np.array(value)


def _running(values: np.ndarray, starts: np.ndarray, of: np.ndarray) -> np.ndarray:
    """Sums from the start of each value's node up to it."""
    sums = np.cumsum(values)
    return sums - np.r_[0.0, sums][starts][of]


def _gain(count: np.ndarray, sums: np.ndarray, n: np.ndarray, spread: np.ndarray) -> np.ndarray:
    """Share of a node's variation that a cut explains; ``sums`` of the left side, around the node's mean."""
    return np.round(sums**2 * n / (count * (n - count)) / spread, DIGITS)


def _middle(a: float, b: float) -> float:
    """Midway, but never the upper value itself, which lies on the other side."""
    middle = a + (b - a) / 2
    return middle if middle < b else a


def fit(training: DataFrame, label: str, predictors: list[str], depth: int | None = None) -> ExactTree:
    """The tree of rows whose label and predictors are numbers and not null. No rows: no tree to grow."""
    with_package(training.sparkSession)
    y = F.col(label).cast("double")
    points = training.groupBy(*(F.col(p).cast("double").alias(p) for p in predictors)).agg(
        F.count(F.lit(1)).cast("double").alias("__n"), F.avg(y).alias("__mean"), F.var_pop(y).alias("__square"),
        F.min(y).alias("__low"), F.max(y).alias("__high"),
    )
    points = stage(points.withColumn("__square", F.col("__square") * F.col("__n")), "tree-points")
    total = points.count()
    top, cuts = Top(), []
    nodes = np.arange(1 if total else 0)
    ends, means = np.zeros(len(nodes), bool), np.zeros(len(nodes))
    borders = _borders(points, predictors, total) if total > LOCAL_ROWS else [np.zeros(0)] * len(predictors)
    rows, held = points.withColumn("__node", F.lit(0).cast("bigint")), total
    while len(nodes):
        found = _node_sums(rows, predictors, top, nodes, borders)
        ends = np.append(ends[: nodes[0]], (found.low == found.high) | (found.points == 1))
        means = np.append(means[: nodes[0]], found.mean)
        large = (found.points > LOCAL_ROWS) & (found.low < found.high)
        if (depth is not None and len(cuts) >= depth) or not large.any():
            break
        # Points of nodes that are done stay behind once they are half of what is read.
        left = int(found.points[large].sum())
        if 2 * left <= held:
            rows, held = stage(_of_nodes(rows, predictors, top, nodes[large]), f"tree-level-{len(cuts)}"), left
        found = found.at(np.flatnonzero(large))
        most = max(1, CELLS // (NODE_CELLS[0] * len(predictors)))
        some = [np.arange(i, min(i + most, len(found.node))) for i in range(0, len(found.node), most)]
        best = [_best_cuts(rows, predictors, top, found.at(places), borders) for places in some]
        feature, threshold = (np.concatenate(c) for c in zip(*best, strict=True))
        split = feature >= 0
        cuts.append(int(split.sum()))
        nodes = top.split(found.node[split], feature[split], threshold[split])
    return ExactTree(list(predictors), top, cuts, stage(_subtrees(points, predictors, top, ends, means, depth), "tree-subtrees"))


@dataclass
class Nodes:
    """Of each node: its place in the tree, points, rows, mean, least and greatest label, and where the
    values of each predictor lie among the borders, from ``start`` to ``end``."""

    node: np.ndarray
    points: np.ndarray
    n: np.ndarray
    mean: np.ndarray
    low: np.ndarray
    high: np.ndarray
    start: np.ndarray
    end: np.ndarray

    def at(self, places: np.ndarray) -> Nodes:
        return Nodes(*(getattr(self, name)[places] for name in self.__dataclass_fields__))


def _borders(points: DataFrame, predictors: list[str], total: int) -> list[np.ndarray]:
    """Values of each predictor that divide a bounded sample of the points evenly."""
    sample = points.select(*predictors).sample(min(1.0, SAMPLE / total), seed=16).toPandas()
    steps = np.linspace(0, 1, NODE_CELLS[1] + 1)
    return [np.unique(np.quantile(sample[p], steps, method="lower")) if len(sample) else np.zeros(0) for p in predictors]


def _scale(x: np.ndarray, borders: np.ndarray) -> np.ndarray:
    """Where values lie among the borders and between two of them; never less for a greater value."""
    above = np.searchsorted(borders, x, side="right")
    between = (above > 0) & (above < len(borders))
    inside = np.zeros(len(x))
    low, high = borders[above[between] - 1], borders[above[between]]
    with np.errstate(all="ignore"):
        inside[between] = np.nan_to_num(np.clip((x[between] - low) / (high - low), 0, 0.999))
    return above + inside


def _pass(rows: DataFrame, predictors: list[str], top: Top, nodes: np.ndarray, state, work: Callable, schema: str) -> DataFrame:
    """What ``work`` makes of the points of ``nodes``: called with the state and an iterator over batches (the places
    of their nodes among ``nodes``, predictors, and a function that gives other columns)."""
    slots = np.full(len(top.child), -1)
    slots[nodes] = np.arange(len(nodes))
    shared = rows.sparkSession.sparkContext.broadcast((top.feature, top.threshold, top.child, slots, state))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        *cuts, slots, state = shared.value

        def found():
            for batch in batches:
                x = _columns(batch, predictors)
                slot = slots[_fallen(_columns(batch, ["__node"])[:, 0], x, *cuts)]
                here = np.flatnonzero(slot >= 0)
                if len(here):
                    yield slot[here], x[here], lambda *names, b=batch, h=here: _columns(b, names)[h].T

        yield from work(state, found())

    return rows.mapInArrow(run, schema)


def _of_nodes(rows: DataFrame, predictors: list[str], top: Top, nodes: np.ndarray) -> DataFrame:
    """The points of ``nodes``, with their node."""
    values = [c for c in rows.columns if c != "__node"]

    def keep(state, batches):
        for slot, _, column in batches:
            columns = [pa.array(c) for c in column(*values)]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(state[slot])], names=[*values, "__node"])

    return _pass(rows.select(*values, "__node"), predictors, top, nodes, nodes, keep, ", ".join(f"`{c}` double" for c in values) + ", __node bigint")


def _batch(**columns: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns.values()], names=list(columns))


def _node_sums(rows: DataFrame, predictors: list[str], top: Top, nodes: np.ndarray, borders: list[np.ndarray]) -> Nodes:
    width = len(predictors)
    starts, ends = [f"s{j}" for j in range(width)], [f"e{j}" for j in range(width)]

    def add(state, batches):
        size = len(state[0])
        points, n, total = np.zeros(size), np.zeros(size), np.zeros(size)
        low, high = np.full(size, np.inf), np.full(size, -np.inf)
        start, end = np.full((width, size), np.inf), np.full((width, size), -np.inf)
        for slot, x, column in batches:
            own, mean, least, most = column("__n", "__mean", "__low", "__high")
            np.add.at(points, slot, 1.0)
            np.add.at(n, slot, own)
            np.add.at(total, slot, own * mean)
            np.minimum.at(low, slot, least)
            np.maximum.at(high, slot, most)
            for j in range(width):
                scale = _scale(x[:, j], state[1][j])
                np.minimum.at(start[j], slot, scale)
                np.maximum.at(end[j], slot, scale)
        k = np.flatnonzero(points)
        reach = dict(zip([*starts, *ends], [*start[:, k], *end[:, k]], strict=True))
        yield _batch(slot=k, points=points[k], n=n[k], total=total[k], low=low[k], high=high[k], **reach)

    least, most = ["low", *starts], ["high", *ends]
    names = ["points", "n", "total", "low", "high", *starts, *ends]
    sums = _pass(rows, predictors, top, nodes, (nodes, borders), add, "slot bigint, " + ", ".join(f"{c} double" for c in names))
    how = {**dict.fromkeys(["points", "n", "total"], F.sum), **dict.fromkeys(least, F.min), **dict.fromkeys(most, F.max)}
    found = sums.groupBy("slot").agg(*(how[c](c).alias(c) for c in names)).toPandas().sort_values("slot")
    value = {c: found[c].to_numpy(float) for c in names}
    return Nodes(
        nodes[found["slot"].to_numpy(int)], value["points"], value["n"], value["total"] / value["n"], value["low"], value["high"],
        np.stack([value[c] for c in starts], 1), np.stack([value[c] for c in ends], 1),
    )


def _cells(slot: np.ndarray, x: np.ndarray, nodes: Nodes, borders: list[np.ndarray], size: int) -> Iterator[np.ndarray]:
    """For each predictor the cell of each point."""
    for j, own in enumerate(borders):
        start, reach = nodes.start[slot, j], nodes.end[slot, j] - nodes.start[slot, j]
        share = (_scale(x[:, j], own) - start) / np.where(reach > 0, reach, 1.0)
        yield (slot * len(borders) + j) * size + np.minimum((share * size).astype(np.int64), size - 1)


def _best_cuts(rows: DataFrame, predictors: list[str], top: Top, nodes: Nodes, borders: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(feature, threshold) of the best cut of each of ``nodes``; -1 where none divides it."""
    width, m = len(predictors), len(nodes.node)
    size = max(NODE_CELLS[0], min(NODE_CELLS[1], CELLS // (width * m)))
    shape = (m, width, size)
    sums = ["k", "d", "q", "up"]

    def add(state, batches):
        total = {c: np.zeros(m * width * size) for c in sums}
        first, last = np.full(m * width * size, np.inf), np.full(m * width * size, -np.inf)
        for slot, x, column in batches:
            n, mean, square = column("__n", "__mean", "__square")
            around = mean - state[0].mean[slot]
            d = n * around
            values = {"k": n, "d": d, "q": square + d * around, "up": np.maximum(d, 0.0)}
            for j, cell in enumerate(_cells(slot, x, *state, size)):
                for c in sums:
                    np.add.at(total[c], cell, values[c])
                np.minimum.at(first, cell, x[:, j])
                np.maximum.at(last, cell, x[:, j])
        used = np.flatnonzero(total["k"])
        for some in np.array_split(used, max(1, -(-len(used) // 10_000))):
            yield _batch(cell=some, **{c: total[c][some] for c in sums}, first=first[some], last=last[some])

    schema = "cell bigint, " + ", ".join(f"{c} double" for c in [*sums, "first", "last"])
    found = _pass(rows, predictors, top, nodes.node, (nodes, borders), add, schema).groupBy("cell")
    found = found.agg(*(F.sum(c).alias(c) for c in sums), F.min("first").alias("first"), F.max("last").alias("last")).toPandas()
    cell = found["cell"].to_numpy(int)

    def dense(name: str, empty: float = 0.0) -> np.ndarray:
        values = np.full(m * width * size, empty)
        values[cell] = found[name]
        return values.reshape(shape)

    k, d, q, up = (dense(c) for c in sums)
    first, last = dense("first", np.inf), dense("last", -np.inf)
    after = np.full(shape, np.inf)  # the least value behind the cell
    after[:, :, :-1] = np.minimum.accumulate(first[:, :, ::-1], 2)[:, :, ::-1][:, :, 1:]
    n, spread = nodes.n[:, None, None], q[:, :1].sum(2, keepdims=True)
    count, total = np.cumsum(k, 2), np.cumsum(d, 2)
    count_before, total_before = count - k, total - d
    with np.errstate(all="ignore"):
        gain = np.where((k > 0) & (after < np.inf), _gain(count, total, n, spread), -np.inf)
        # A cut inside a cell explains no more than the two sides without it and all that varies in it, ...
        outside = np.where(count_before > 0, total_before**2 / count_before, 0.0) + np.where(n > count, total**2 / (n - count), 0.0)
        # ... and its left sum lies between those without the cell's labels above and below the mean.
        furthest = np.maximum(np.abs(total_before + up), np.abs(total_before + d - up))
        inner, outer = np.maximum(count_before, 1.0), np.minimum(count, n - 1)
        bound = np.minimum(outside + q, furthest**2 * n / np.minimum(inner * (n - inner), outer * (n - outer))) / spread
    best = gain.max((1, 2))
    place = np.argmax(gain.reshape(m, -1), 1)  # the first predictor's lowest of equal ones
    feature = np.where(best > -np.inf, place // size, -1)
    at = (np.arange(m), place // size, place % size)
    threshold = _middles(last[at], after[at])
    opened = (first < last) & ~(bound < best[:, None, None] * (1 - SLACK) - 2 * SLACK)
    if opened.any():
        flat = (a.ravel() for a in (opened, count_before, total_before, spread))
        inside = _inside(rows, predictors, top, nodes, borders, size, *flat)
        for slot, loss, j, x in inside:
            if (loss, j, x) < (-best[slot], feature[slot], threshold[slot]) or feature[slot] < 0:
                best[slot], feature[slot], threshold[slot] = -loss, j, x
    return feature, threshold


def _middles(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    with np.errstate(all="ignore"):
        middle = a + (b - a) / 2
        return np.where(middle < b, middle, a)


def _inside(rows, predictors, top, nodes, borders, size, opened, count_before, total_before, spread) -> list[tuple]:
    """(place among ``nodes``, negative gain, feature, threshold) of each node's best cut inside an opened cell."""
    width = len(predictors)

    def values(state, batches):
        nodes, borders, opened = state
        for slot, x, column in batches:
            n, mean = column("__n", "__mean")
            d = n * (mean - nodes.mean[slot])
            for j, cell in enumerate(_cells(slot, x, nodes, borders, size)):
                here = opened[cell]
                if here.any():
                    yield _batch(cell=cell[here], x=x[here, j], k=n[here], d=d[here])

    each = _pass(rows, predictors, top, nodes.node, (nodes, borders, opened), values, "cell bigint, x double, k double, d double")
    counts = stage(each.groupBy("cell", "x").agg(F.sum("k").alias("k"), F.sum("d").alias("d")), "tree-values")
    run = running_totals(counts, ["cell"], "x", ["k", "d"], following="after").where(F.col("after").isNotNull())
    shared = rows.sparkSession.sparkContext.broadcast((nodes.n, count_before, total_before, spread))

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, count_before, total_before, spread = shared.value
        for batch in batches:
            x, k, d, k_before, d_before, after = _columns(batch, ["x", "k", "d", "k_before", "d_before", "after"]).T
            cell = batch.column("cell").to_numpy()
            slot = cell // (width * size)
            left, total = count_before[cell] + k_before + k, total_before[cell] + d_before + d
            loss, feature, threshold = -_gain(left, total, n[slot], spread[slot]), cell // size % width, _middles(x, after)
            order = np.lexsort((threshold, feature, loss, slot))
            order = order[np.flatnonzero(np.diff(slot[order], prepend=-1))]
            yield _batch(slot=slot[order], loss=loss[order], feature=feature[order], threshold=threshold[order])

    found = run.mapInArrow(best, "slot bigint, loss double, feature bigint, threshold double")
    least = found.groupBy("slot").agg(F.min(F.struct("loss", "feature", "threshold")).alias("cut"))
    return [tuple(r) for r in least.select("slot", "cut.*").collect()]


def _subtrees(points: DataFrame, predictors: list[str], top: Top, ends: np.ndarray, means: np.ndarray, depth: int | None) -> DataFrame:
    """(path, subtree) of the nodes of ``top`` that were not split: grown from the points of a small one; where labels
    are equal, points are not to be told apart or ``depth`` is reached, a leaf by its mean alone."""
    spark = points.sparkSession
    bottom = top.child[: len(means)] == 0
    if depth is not None:
        ends = ends | (top.level[: len(means)] >= depth)
    leaf = np.flatnonzero(bottom & ends)
    single = pa.ListArray.from_arrays(np.arange(len(leaf) + 1, dtype=np.int32), pa.array(np.full(len(leaf), -1, np.int16)))
    number = pa.ListArray.from_arrays(single.offsets, pa.array(means[leaf]))
    # From Arrow, which starts no Python worker on the executors.
    leaves = spark.createDataFrame(pa.table({"path": leaf, "feature": single, "number": number}), f"path bigint, {_SUBTREE}")
    small = np.flatnonzero(bottom & ~ends)
    if not len(small):
        return leaves
    levels = top.level

    def grow(part: pa.Table) -> pa.Table:
        # In a fixed order: sums do not depend on how the points arrived.
        x = np.stack([part.column(p).to_numpy() for p in predictors], 1)
        order = np.lexsort(x.T[::-1])
        columns = [part.column(c).to_numpy()[order] for c in ("__n", "__mean", "__square", "__low", "__high")]
        path = part.column("__node")[0].as_py()
        left = None if depth is None else depth - int(levels[path])
        feature, threshold, _, value = grown_from(Points(x[order], *columns), left)
        number = np.where(feature >= 0, threshold, value)
        types = {"path": pa.int64(), "feature": pa.list_(pa.int16()), "number": pa.list_(pa.float64())}
        return pa.table({c: pa.array([v], types[c]) for c, v in (("path", path), ("feature", feature), ("number", number))})

    inside = _of_nodes(points.withColumn("__node", F.lit(0).cast("bigint")), predictors, top, small)
    return leaves.union(inside.groupBy("__node").applyInArrow(grow, f"path bigint, {_SUBTREE}"))
