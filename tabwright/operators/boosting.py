"""Boosted trees for all folds at once: shared passes, absolute loss, stored state.

Every fold has its own model. A pass over the rows serves the models of all folds: one pass
per level of their trees, and one for the values of their leaves. Rows are read as bin
numbers, one byte per feature, together with the score that each model has given them
so far, in blocks of some thousand rows. That state is stored, so rounds go on from where the
last ones ended, and no tree is fitted twice.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, field, replace

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import DenseVector, Vectors
from pyspark.ml.param.shared import HasPredictionCol
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabwright.session import configured, discard, distribute, materialize_at, scratch_path

# Flags the held-out rows of a single fit.
VALIDATION = "_held_out"
# Greatest number of rounds, and rounds without gain after which a model is done. The first
# is a bound on work that patience normally keeps well below; reaching it is reported.
ROUNDS = 2000
PATIENCE = 10
# Rounds between two evaluations; the state is stored with each.
STAGE = 10
BINS = 64
# Fewer rows than these are not worth a task of their own: every pass starts all tasks anew.
TASK_ROWS = 20_000
# More rows than these are too many for a task: the residuals of all its models are in its memory.
MOST_TASK_ROWS = 500_000
# Rows whose values the bins' edges come from, drawn by a hash. The trees see all rows.
EDGE_ROWS = 20_000
# Order statistics that a task keeps of a leaf's residuals, unless the settings say otherwise. A
# median's rank is off by at most 1 / (2 x this) of the leaf's rows, and exact if no task holds more.
MEDIAN_POINTS = 512

Metric = Callable[[Column, Column], Column]
# A row of the state is a block of rows: their number and a matrix or vector per column.
STATE = "n int, code binary, fold binary, h binary, label binary, score binary"
# The state of a round also has what every model's tree makes of every row, as ``aimed`` finds it.
AIMED = f"{STATE}, aim binary"
# Blocks are large, so they are stored, read and sent one at a time.
ONE_BLOCK = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1",
    "spark.sql.inMemoryColumnarStorage.batchSize": "1",
    "spark.sql.parquet.columnarReaderBatchSize": "1",
}
# Most bytes of sums that reach the driver in a whole fit. Beyond it splits are found on the executors.
DRIVER_BYTES = 256 << 20
# Most bytes of all tasks' sums of a pass that are added up on the driver; more are on the executors.
PASS_BYTES = 8 << 20
# Rows whose counts and summed signs fit into one double together (see ``counted``).
PACKED_ROWS = 1 << 25


def mean_absolute(label: Column, prediction: Column) -> Column:
    return F.avg(F.abs(label - prediction))


@dataclass(frozen=True)
class Settings:
    """What a booster is told. ``loss`` is "absolute" (leaves take medians) or "squared" (means)."""

    features: str = "features"
    label: str = "label"
    depth: int = 5
    rounds: int = ROUNDS
    step: float = 0.1
    rows_share: float = 0.8
    feature_share: float = 0.8
    min_rows: int = 20
    seed: int = 11
    patience: int = PATIENCE
    loss: str = "absolute"
    metric: Metric = mean_absolute
    median_points: int = MEDIAN_POINTS

    def __post_init__(self):
        if self.loss not in ("absolute", "squared"):
            raise ValueError(f"unknown loss {self.loss!r}")
        if not 1 <= self.depth <= 12:
            raise ValueError("depth must be from 1 to 12")


@dataclass
class Tree:
    """A binary tree in heap order: children of node i are 2 i + 1 (at most the split) and 2 i + 2."""

    feature: np.ndarray
    split: np.ndarray
    value: np.ndarray
    gain: np.ndarray

    @classmethod
    def empty(cls, depth: int) -> "Tree":
        size = 2 ** (depth + 1) - 1
        return cls(np.full(size, -1, np.int32), np.zeros(size), np.zeros(size), np.zeros(size))

    def route(self, x: np.ndarray) -> np.ndarray:
        """The node in which every row of a matrix ends."""
        node, rows = np.zeros(len(x), np.int64), np.arange(len(x))
        for _ in range(len(self.feature).bit_length() - 1):
            f = self.feature[node]
            if (f < 0).all():
                break
            child = 2 * node + np.where(x[rows, np.maximum(f, 0)] <= self.split[node], 1, 2)
            node = np.where(f >= 0, child, node)
        return node


# What runs in tasks. Batches become matrices without a look at single rows.


def resting(tree: Tree) -> np.ndarray:
    """The node in which a row ends that is on its way to a node: the first one without a split."""
    at = np.arange(len(tree.feature))
    for i in range(1, len(at)):
        parent = (i - 1) // 2
        if tree.feature[parent] < 0 or at[parent] != parent:
            at[i] = at[parent]
    return at


def placed(tree: Tree, code: np.ndarray, levels: int, rows: np.ndarray | None = None) -> np.ndarray:
    """``Tree.route`` for bin numbers (a matrix stored by columns, of which ``rows`` count), ``levels`` deep."""
    n = len(code)
    flat = code.T.reshape(-1)
    rows = np.arange(n) if rows is None else rows
    start = np.maximum(tree.feature, 0).astype(np.int64) * n
    split = np.where(tree.feature >= 0, tree.split, 255).astype(np.uint8)
    node = np.zeros(len(rows), np.int64)
    for _ in range(levels):
        right = flat.take(start.take(node) + rows) > split.take(node)
        node += node + 1
        node += right
    return resting(tree).take(node)


def depth_of(tree: Tree) -> int:
    return len(tree.feature).bit_length() - 1


@dataclass
class Block:
    """Some thousand rows; the bytes of ``code`` go feature by feature."""

    code: np.ndarray
    fold: np.ndarray
    h: np.ndarray
    label: np.ndarray
    score: np.ndarray
    # One row per model (``aimed``); empty outside a round.
    aim: np.ndarray | bytes = b""

    @classmethod
    def of(cls, values: dict) -> "Block":
        """Columns that a pass has not asked for are None."""
        n = values["n"]
        read = lambda c, kind: np.frombuffer(values[c], kind) if values.get(c) is not None else None
        code, score, aim = read("code", np.uint8), read("score", np.float64), read("aim", np.int8)
        return cls(
            code.reshape(-1, n).T, read("fold", np.int16), read("h", np.int64), read("label", np.float64),
            None if score is None else score.reshape(n, -1), b"" if aim is None else aim.reshape(-1, n),
        )

    def batch(self) -> pa.RecordBatch:
        values = [self.code.T, self.fold, self.h, self.label, self.score, *([self.aim] if len(self.aim) else [])]
        names = [part.split(" ")[0] for part in AIMED.split(", ")][: len(values) + 1]
        packed = [pa.array([v.tobytes()], pa.binary()) for v in values]
        return pa.RecordBatch.from_arrays([pa.array([len(self.fold)], pa.int32()), *packed], names)


def blocks_of(batches: Iterator[pa.RecordBatch]) -> Iterator[Block]:
    for b in batches:
        for i in range(b.num_rows):
            yield Block.of(b.slice(i, 1).to_pylist()[0])


def packed(batches, edges: list[np.ndarray], k: int) -> Iterator[pa.RecordBatch]:
    """Rows (x, fold, h, label) as blocks of the state, features as bin numbers."""
    for b in batches:
        n = b.num_rows
        if n:
            x = b.column("x").flatten().to_numpy(zero_copy_only=False).reshape(n, -1)
            code = np.stack([np.searchsorted(e, x[:, j]) for j, e in enumerate(edges)], 1).astype(np.uint8)
            plain = {c: b.column(c).to_numpy(zero_copy_only=False) for c in ("fold", "h", "label")}
            yield Block(code, plain["fold"].astype(np.int16), plain["h"], plain["label"], np.zeros((n, k))).batch()


def drawn(h: np.ndarray, seed: int, draw: int, model: int, share: float) -> np.ndarray:
    """Which rows a round's tree sees: a hash of the row's own hash, so a repeated task draws the same."""
    if share >= 1:
        return np.ones(len(h), bool)
    mixed = (seed * 0x9E3779B97F4A7C15 + draw * 0xBF58476D1CE4E5B9 + model * 0x94D049BB133111EB) & (2**64 - 1)
    z = h.astype(np.uint64) ^ np.uint64(mixed)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        z = (z ^ (z >> np.uint64(shift))) * np.uint64(factor)
    z ^= z >> np.uint64(31)
    return (z >> np.uint64(11)).astype(np.float64) / 2.0**53 < share


def counted(cell: np.ndarray, target: np.ndarray, size: int, signs: bool) -> np.ndarray:
    """Rows and summed targets per cell. Of signs both are in one double: the rows plus 2 x ``PACKED_ROWS`` times the sum."""
    if signs:
        return np.bincount(cell, target, size)[None]
    return np.stack([np.bincount(cell, minlength=size), np.bincount(cell, target, size)])


def unpacked(cells: np.ndarray, signs: bool) -> np.ndarray:
    if not signs:
        return np.stack([cells[:, 0], cells[:, 1]], -1)
    total = np.floor(cells[:, 0] / (2 * PACKED_ROWS))
    return np.stack([cells[:, 0] - 2 * PACKED_ROWS * total, total], -1)


def aimed(b: Block, models: Sequence[int], draw: int, s: Settings) -> np.ndarray:
    """Per model and row: 0 if a round's tree doesn't learn from the row, else 2 plus the sign of its residual."""
    out = np.zeros((b.score.shape[1], len(b.fold)), np.int8)
    for m in models:
        use = (b.fold != m) & drawn(b.h, s.seed, draw, m, s.rows_share)
        out[m] = np.where(use, 2 + np.sign(b.label - b.score[:, m]).astype(np.int8), 0)
    return out


def histograms(
    batches, trees: dict[int, Tree], level: int, s: Settings, allowed: dict[int, np.ndarray], wanted: dict[int, np.ndarray]
) -> Iterator[pa.RecordBatch]:
    """Per (model, wanted node): rows and summed pseudo-residuals by allowed feature and bin, over this task's rows."""
    first, size, signs = 2**level - 1, 2**level * BINS, s.loss == "absolute"
    sums: dict[int, np.ndarray] = {}
    held: dict[int, np.ndarray] = {}
    rows = 0

    def settle() -> None:
        for m, cells in held.items():
            sums[m] = sums.get(m, 0.0) + unpacked(cells, signs)
        held.clear()

    for b in blocks_of(batches):
        n = len(b.code)
        rows += n
        if rows > PACKED_ROWS:
            settle()
            rows = n
        columns = b.code.T
        for m, tree in trees.items():
            use = np.flatnonzero(b.aim[m])
            node = placed(tree, b.code, level, use) - first
            if level:
                # The others have stopped at a leaf, or their sums are known without being counted.
                counts = (node >= 0) & wanted[m].take(np.maximum(node, 0))
                use, node = use[counts], node[counts]
            if not len(use):
                continue
            target = 2.0 * PACKED_ROWS * (b.aim[m].take(use) - 2.0) + 1.0 if signs else b.label[use] - b.score[use, m]
            node *= BINS
            features = np.flatnonzero(allowed[m])
            if m not in held:
                held[m] = np.zeros((len(features), 1 if signs else 2, size))
            codes = (columns if len(features) == len(columns) else columns[features]).take(use, axis=1)
            for j, code in enumerate(codes):
                held[m][j] += counted(node + code, target, size, signs)
    settle()
    task, found = TaskContext.get().partitionId(), []
    for m, total in sums.items():
        nodes = total.reshape(len(total), -1, BINS, 2).transpose(1, 0, 2, 3).astype(cell_kind(s.loss))
        found += [(task, m, i, cells.tobytes()) for i, cells in enumerate(nodes) if cells[0, :, 0].any()]
    yield as_batch(found, [("task", pa.int32()), ("model", pa.int32()), ("node", pa.int32()), ("cells", pa.binary())])


def cell_kind(loss: str) -> type:
    """Counts and summed signs of a task's rows are whole numbers."""
    return np.int32 if loss == "absolute" else np.float64


def as_batch(rows: list[tuple], schema) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [()] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, (_, t) in zip(columns, schema)], [n for n, _ in schema])


def whole_cells(cells: list[bytes], kind: type) -> np.ndarray:
    """Tasks' histograms of a node in the order of the tasks, so that sums don't depend on who comes first."""
    return sum(np.frombuffer(c, kind).reshape(-1, BINS, 2).astype(float) for c in cells)


def best_split(cells: np.ndarray, allowed: np.ndarray, min_rows: int) -> tuple[int, int, float, bool] | None:
    """(feature, bin, gain, whether less than half goes left) of the split of a node that lowers the squared error of the pseudo-residuals most.

    ``cells`` is the node's histogram of the allowed features. Ties go to the first feature and bin.
    """
    features = np.flatnonzero(allowed)
    left = np.cumsum(cells, axis=1)
    whole = left[:, -1:, :]
    right = whole - left
    n_left, n_right = left[..., 0], right[..., 0]
    fits = (n_left >= max(1, min_rows)) & (n_right >= max(1, min_rows))
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = left[..., 1] ** 2 / n_left + right[..., 1] ** 2 / n_right - whole[..., 1] ** 2 / whole[..., 0]
    gain = np.where(fits, gain, 0.0)
    at = int(gain.argmax())
    if not gain.flat[at] > 1e-9:
        return None
    return int(features[at // BINS]), at % BINS, float(gain.flat[at]), bool(n_left.flat[at] < n_right.flat[at])


def leaf_residuals(batches, trees: dict[int, Tree], s: Settings) -> Iterator[pa.RecordBatch]:
    """Per (model, leaf): at most ``median_points`` order statistics of this task's residuals and their weights, or sum and count."""
    found: dict[tuple[int, int], list[np.ndarray]] = {}
    for b in blocks_of(batches):
        for m, tree in trees.items():
            use = np.flatnonzero(b.fold != m)
            rest, leaf = b.label[use] - b.score[use, m], placed(tree, b.code, depth_of(tree), use)
            # A stable sort of 16-bit numbers takes time by their number alone.
            order = np.argsort(leaf.astype(np.uint16), kind="stable")
            sizes = np.bincount(leaf)
            leaves = np.flatnonzero(sizes)
            for i, part in zip(leaves, np.split(rest[order], np.cumsum(sizes[leaves])[:-1])):
                found.setdefault((m, int(i)), []).append(part)
    task, rows = TaskContext.get().partitionId(), []
    for (m, i), parts in found.items():
        values = np.sort(np.concatenate(parts))
        n = len(values)
        if s.loss == "squared":
            points, weights = np.array([values.sum()]), np.array([float(n)])
        elif n <= s.median_points:
            points, weights = values, np.ones(n)
        else:
            # The middle of each of so many equal stretches stands for the stretch.
            edges = np.arange(s.median_points + 1) * n // s.median_points
            points, weights = values[(edges[:-1] + edges[1:]) // 2], np.diff(edges).astype(float)
        rows.append((task, m, i, points.tobytes(), weights.tobytes()))
    yield as_batch(rows, [("task", pa.int32()), ("model", pa.int32()), ("leaf", pa.int32()), ("points", pa.binary()), ("weights", pa.binary())])


def leaf_value(points: list[bytes], weights: list[bytes], loss: str) -> float:
    """Mean of the tasks' sums, or median of their weighted order statistics."""
    p = np.concatenate([np.frombuffer(x) for x in points])
    w = np.concatenate([np.frombuffer(x) for x in weights])
    if loss == "squared":
        return float(p.sum() / w.sum())
    order = np.argsort(p, kind="stable")
    p, reach = p[order], np.cumsum(w[order])
    low = p[np.searchsorted(reach, reach[-1] / 2)]
    high = p[min(np.searchsorted(reach, reach[-1] / 2, side="right"), len(p) - 1)]
    return float((low + high) / 2)


def stepped(batches, trees: dict[int, Tree], step: float, aim: Callable[[Block], np.ndarray] | None = None) -> Iterator[pa.RecordBatch]:
    """Blocks with the scores after a round, and with what the next round's trees aim at."""
    for b in blocks_of(batches):
        score = b.score.copy()
        for m, tree in trees.items():
            score[:, m] += step * tree.value[placed(tree, b.code, depth_of(tree))]
        out = Block(b.code, b.fold, b.h, b.label, score)
        yield (out if aim is None else replace(out, aim=aim(out))).batch()


def noted(batches, rounds: list[dict[int, Tree]], step: float) -> Iterator[pa.RecordBatch]:
    """(fold, place, label, prediction) of the held-out rows after each of some rounds, from the state before them."""
    for b in blocks_of(batches):
        for m in rounds[0]:
            own = np.flatnonzero(b.fold == m)
            score = b.score[own, m]
            for place, trees in enumerate(rounds):
                score = score + step * trees[m].value[placed(trees[m], b.code, depth_of(trees[m]), own)]
                columns = [np.full(len(own), m, np.int32), np.full(len(own), place, np.int32), b.label[own], score]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["fold", "place", "label", "prediction"])


# The driver's side.


def tasks_for(df: DataFrame, n: int) -> int:
    """How many tasks ``n`` rows are dealt to: two per core, none with few rows or with very many.

    Files alone would decide otherwise, and a table in one file would be read by one core.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    # As many for every core, so that none waits for another's last task.
    most = -(-(n // MOST_TASK_ROWS + 1) // cores) * cores
    return min(n // TASK_ROWS + 1, max(2 * cores, most))


def bin_edges(rows: DataFrame, share: float) -> list[np.ndarray]:
    """At most ``BINS`` - 1 upper edges per feature, from the distinct values or their quantiles."""
    sample = rows.filter(F.pmod(F.col("h"), F.lit(1 << 32)) < F.lit(int(share * 2**32))).select("x").toArrow().column("x")
    x = sample.combine_chunks().flatten().to_numpy().reshape(len(sample), -1) if len(sample) else np.zeros((0, 0))
    out = []
    for column in x.T:
        values = np.unique(column)
        if len(values) > BINS:
            values = np.unique(np.quantile(column, np.arange(1, BINS + 1) / BINS, method="inverted_cdf"))
        out.append(values[:-1])
    return out


@dataclass
class Progress:
    """Trees of one fold's model, its metric after each round, and whether it has stopped."""

    trees: list[Tree] = field(default_factory=list)
    scores: list[float] = field(default_factory=list)
    done: bool = False

    def best(self) -> int:
        return int(np.argmin(self.scores)) + 1 if self.scores else len(self.trees)


class FoldBoosting:
    """Boosting of k models over k folds, continued as often as wanted.

    Model i learns from the labelled rows outside fold i and is judged on those inside. Rows
    of a negative fold are learned from by every model and judge none. ``advance`` adds rounds to the
    stored state (score of every row under every model); ``models`` cuts each ensemble to its best prefix.
    """

    def __init__(self, df: DataFrame, k: int, fold: str, settings: Settings):
        self.s, self.k = settings, k
        distribute(df.sparkSession)
        x = vector_to_array(settings.features)
        rows = df.filter(F.col(fold).isNotNull() & F.col(settings.label).isNotNull()).select(
            x.alias("x"), F.col(fold).cast("int").alias("fold"), F.xxhash64(x, settings.label, fold).alias("h"), F.col(settings.label).cast("double").alias("label")
        )
        self.spark = df.sparkSession
        stored_rows = scratch_path(self.spark, "boosting-rows")
        rows = materialize_at(rows, stored_rows)
        n, *found = rows.agg(F.count(F.lit(1)), *[F.max(F.col("fold") == i) for i in range(k)]).first()
        if not n:
            raise ValueError("no labelled rows to fit on")
        self.judged = [bool(f) for f in found]
        # The share of rows is raised so that even few rows give edges; it depends on the count alone.
        self.edges = bin_edges(rows, min(1.0, EDGE_ROWS / n) if n > EDGE_ROWS else 1.0)
        if not self.edges:
            raise ValueError("no rows were drawn for the edges of the bins")
        edges = self.edges
        # Sums over all rows are whole numbers that fit into this.
        self.kind = cell_kind(settings.loss) if n < 2**31 else np.float64
        self.most_tasks = tasks_for(df, n)
        dealt = rows.repartition(self.most_tasks) if self.most_tasks > 1 else rows
        self.path, self.state = None, None
        self._store(dealt.mapInArrow(lambda batches: packed(batches, edges, k), STATE))
        discard(self.spark, stored_rows)
        self.partitions = self.state.rdd.getNumPartitions()
        self.progress = [Progress() for _ in range(k)]
        self.base = [0.0] * k
        # Bytes of sums that may have gone to the driver so far.
        self.sent = 0
        roots = {m: Tree.empty(1) for m in range(k)}
        with configured(self.spark, ONE_BLOCK):
            self._fill_leaves(self.state, roots)
        self.base = [float(roots[m].value[0]) for m in range(k)]
        # The step that the stored scores still lack.
        self.pending: tuple[dict[int, Tree], float] = (roots, 1.0)
        self.rounds = 0

    def _store(self, state: DataFrame) -> None:
        """Store the state anew. What it was made of is not read any more."""
        old, self.path = self.path, scratch_path(self.spark, "boosting-state")
        self.state = materialize_at(state, self.path).coalesce(self.most_tasks)
        if old:
            discard(self.spark, old)

    def _step(self, state: DataFrame, aim: Callable[[Block], np.ndarray] | None = None) -> DataFrame:
        trees, step = self.pending
        return state.mapInArrow(lambda batches: stepped(batches, trees, step, aim), STATE if aim is None else AIMED)

    def _fill_leaves(self, state: DataFrame, trees: dict[int, Tree]) -> None:
        s = self.s
        parts = state.select("n", "code", "fold", "label", "score").mapInArrow(
            lambda batches: leaf_residuals(batches, trees, s), "task int, model int, leaf int, points binary, weights binary"
        )
        size = 16 * s.median_points * max(len(t.value) // 2 + 1 for t in trees.values()) * len(trees)
        value = lambda m, p, w: (leaf_value(p, w, s.loss),)
        for m, leaf, found in self._grouped(parts, "leaf", ["points", "weights"], value, "value double", size):
            trees[m].value[leaf] = found

    def _grouped(self, parts: DataFrame, key: str, sums: list[str], each, schema: str, size: int, sent: int = 0) -> list[tuple]:
        """(model, key, ...) of what ``each`` makes of the tasks' sums of a key, in the order of the tasks.

        Few bytes (``size`` bounds those of one task) are put together on the driver, others on the executors,
        as are all once the fit has sent ``DRIVER_BYTES``: what rounds send adds up. ``sent`` bounds the
        bytes that ``each`` makes.
        """

        def one(group: pd.DataFrame) -> pd.DataFrame:
            group = group.sort_values("task")
            m, at = int(group["model"].iloc[0]), int(group[key].iloc[0])
            found = each(m, *(list(group[c]) for c in sums))
            names = ["model", key, *(part.split(" ")[0] for part in schema.split(", "))]
            return pd.DataFrame([(m, at, *found)] if found else [], columns=names)

        if size * self.partitions > max(PASS_BYTES, sent) or self.sent + size * self.partitions > DRIVER_BYTES:
            self.sent += sent
            found = parts.groupBy("model", key).applyInPandas(one, f"model int, {key} int, {schema}")
            return [tuple(r) for r in found.collect()]
        self.sent += size * self.partitions
        rows = parts.toArrow().to_pydict()
        groups: dict[tuple[int, int], list[tuple]] = {}
        for row in sorted(zip(*(rows[c] for c in ("task", "model", key, *sums))), key=lambda r: r[:3]):
            groups.setdefault(row[1:3], []).append(row[3:])
        made = {at: each(at[0], *map(list, zip(*group))) for at, group in groups.items()}
        return [(*at, *found) for at, found in made.items() if found]

    def _grow(self, state: DataFrame, models: Sequence[int]) -> dict[int, Tree]:
        """One tree per model: a pass per level, and one for the leaves."""
        s, d, draw = self.s, len(self.edges), self.rounds
        signs = s.loss == "absolute"
        columns = ["n", "code", "aim"] if signs else ["n", "code", "label", "score", "aim"]
        trees = {m: Tree.empty(s.depth) for m in models}
        take = max(1, round(s.feature_share * d))
        allowed = {}
        for m in models:
            allowed[m] = np.zeros(d, bool)
            allowed[m][np.random.default_rng([s.seed, draw, m]).permutation(d)[:take]] = True
        # The whole histograms of the level above, as long as the driver knows them, and the smaller halves of its nodes.
        above: dict[tuple[int, int], np.ndarray] = {}
        smaller: dict[tuple[int, int], bool] = {}
        for level in range(s.depth):
            first = 2**level - 1
            open_ = {m: t for m, t in trees.items() if level == 0 or (t.feature[(first - 1) // 2 : first] >= 0).any()}
            if not open_:
                break
            wanted = {m: np.ones(2**level, bool) for m in open_}
            # Counts and signs are whole numbers, so a node less its smaller half is exactly the other half.
            for (m, parent) in above:
                wanted[m][2 * parent + (1 if smaller[m, parent] else 0)] = False
            parts = state.select(*columns).mapInArrow(
                lambda batches, t=open_, lv=level, w=wanted: histograms(batches, t, lv, s, allowed, w), "task int, model int, node int, cells binary"
            )
            cell = 2 * BINS * take
            # Nodes that have rows, and half of those whose other half is known.
            nodes = len(above) if above else 2**level * len(open_)
            size, back = np.dtype(cell_kind(s.loss)).itemsize * cell * nodes, np.dtype(self.kind).itemsize * cell * nodes
            split = lambda m, cells: best_split(cells, allowed[m], s.min_rows)
            known: dict[tuple[int, int], np.ndarray] = {}
            if signs and (level == 0 or above) and self.sent + back <= DRIVER_BYTES:
                kind, own = self.kind, cell_kind(s.loss)
                add = lambda m, cells: (whole_cells(cells, own).astype(kind).tobytes(),)
                known = {(m, node): whole_cells([c], kind) for m, node, c in self._grouped(parts, "node", ["cells"], add, "cells binary", size, back)}
                for (m, parent), cells in above.items():
                    low, high = (2 * parent, 2 * parent + 1) if smaller[m, parent] else (2 * parent + 1, 2 * parent)
                    known[m, high] = cells - known[m, low]
                found = [(m, node, *best) for (m, node), cells in known.items() if (best := split(m, cells))]
            else:
                kind = cell_kind(s.loss)
                each = lambda m, cells: split(m, whole_cells(cells, kind))
                if above:
                    # The budget is used up: this level is counted without what is known of the one above.
                    every = {m: np.ones(2**level, bool) for m in open_}
                    parts = state.select(*columns).mapInArrow(
                        lambda batches, t=open_, lv=level: histograms(batches, t, lv, s, allowed, every), "task int, model int, node int, cells binary"
                    )
                found = self._grouped(parts, "node", ["cells"], each, "feature int, bin int, gain double, smaller boolean", 2 * size if above else size)
            above, smaller = {}, {}
            for m, node, f, at, gain, left in found:
                tree, i = trees[m], first + node
                tree.feature[i], tree.split[i], tree.gain[i] = f, at, gain
                if known:
                    above[m, node], smaller[m, node] = known[m, node], left
        self._fill_leaves(state, trees)
        return trees

    def advance(self, rounds: int) -> "FoldBoosting":
        """Add up to ``rounds`` rounds to the models that have not stopped, then score those rounds in one pass."""
        models = [m for m in range(self.k) if not self.progress[m].done]
        n = min(rounds, self.s.rounds - self.rounds) if models else 0
        if n <= 0:
            return self
        with configured(self.spark, ONE_BLOCK):
            self._advance(models, n)
        return self

    def _advance(self, models: Sequence[int], n: int) -> None:
        state, before, grown = self.state, self.pending, []
        for _ in range(n):
            s, draw = self.s, self.rounds
            last, state = state, self._step(state, lambda b, d=draw: aimed(b, models, d, s)).persist()
            # A job of its own, so that no task needs two Python workers at a time.
            state.count()
            if grown:
                last.unpersist()
            trees = self._grow(state, models)
            for m, tree in trees.items():
                self.progress[m].trees.append(tree)
            self.rounds += 1
            self.pending = trees, self.s.step
            grown.append(trees)
        self._judge(models, before, grown)
        self._store(self._step(state))
        self.pending = {}, 0.0
        state.unpersist()

    def _judge(self, models: Sequence[int], before: tuple[dict[int, Tree], float], grown: list[dict[int, Tree]]) -> None:
        """Metric of every model after each of the last rounds, on the rows that it never sees."""
        (trees, first), step, judged = before, self.s.step, [m for m in models if self.judged[m]]
        rounds = [{m: t[m] for m in judged} for t in grown]
        by_fold = {}
        if judged:
            start = lambda batches: stepped(batches, {m: t for m, t in trees.items() if m in judged}, first)
            held = self.state.mapInArrow(lambda batches: noted(start(batches), rounds, step), "fold int, place int, label double, prediction double")
            scored = held.groupBy("fold", "place").agg(self.s.metric(F.col("label"), F.col("prediction")).alias("score")).collect()
            by_fold = {(r["fold"], r["place"]): r["score"] for r in scored}
        for m in models:
            p = self.progress[m]
            if self.judged[m]:
                p.scores += [float(by_fold[m, i]) for i in range(len(grown))]
                p.done = p.best() + self.s.patience <= self.rounds
            p.done = p.done or self.rounds >= self.s.rounds

    def run(self) -> "FoldBoosting":
        """Go on until patience or the greatest number of rounds stops every model."""
        while not all(p.done for p in self.progress):
            self.advance(STAGE)
        if self.path:
            discard(self.spark, self.path)
            self.path = None
        return self

    def models(self) -> list["BoostedTrees"]:
        """The models as they are, each cut to the rounds up to its least metric."""
        out = []
        for m, p in enumerate(self.progress):
            best = p.best()
            trees = [self._with_thresholds(t) for t in p.trees[:best]]
            model = BoostedTrees(self.s.features, len(self.edges), self.base[m], self.s.step, trees)
            model.best_round, model.scores = best, list(p.scores)
            model.held_out_mae = p.scores[best - 1] if p.scores else None
            model.hit_limit = not p.scores or best + self.s.patience > len(p.trees)
            out.append(model)
        return out

    def _with_thresholds(self, tree: Tree) -> Tree:
        at = np.flatnonzero(tree.feature >= 0)
        split = tree.split.copy()
        split[at] = [self.edges[tree.feature[i]][int(tree.split[i])] for i in at]
        return Tree(tree.feature, split, tree.value, tree.gain)


class BoostedTrees(Model, HasPredictionCol):
    """A fitted ensemble: ``base`` and ``step`` times the leaf values of its trees."""

    def __init__(self, features: str, size: int, base: float, step: float, trees: Sequence[Tree]):
        super().__init__()
        self.features, self.size, self.base, self.step, self.trees = features, size, base, step, list(trees)
        self.best_round, self.held_out_mae, self.hit_limit, self.scores = len(self.trees), None, False, []

    @property
    def getNumTrees(self) -> int:
        return len(self.trees)

    @property
    def featureImportances(self) -> DenseVector:
        """Gains by feature, every tree's adding up to 1 before they are averaged."""
        total = np.zeros(self.size)
        for tree in self.trees:
            used = tree.feature >= 0
            gains = np.bincount(tree.feature[used], tree.gain[used], self.size)
            total += gains / gains.sum() if gains.sum() else 0.0
        return Vectors.dense(total / total.sum() if total.sum() else total)

    def coded(self) -> tuple[list[np.ndarray], list[Tree]] | None:
        """Every feature's thresholds, and the trees with their places; None if there are too many for a byte."""
        if "_coded" not in self.__dict__:
            used = np.concatenate([np.stack([t.feature, t.split], 1)[t.feature >= 0] for t in self.trees] or [np.zeros((0, 2))])
            edges = [np.unique(used[used[:, 0] == f, 1]) for f in range(self.size)]
            if max(map(len, edges), default=0) < 255:
                place = lambda t: [np.searchsorted(edges[f], v) if f >= 0 else 0 for f, v in zip(t.feature, t.split)]
                self._coded = edges, [Tree(t.feature, np.array(place(t), float), t.value, t.gain) for t in self.trees]
            else:
                self._coded = None
        return self._coded

    def predict_matrix(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.base)
        coded = self.coded()
        if coded is None:
            for tree in self.trees:
                out += self.step * tree.value[tree.route(x)]
            return out
        edges, trees = coded
        # Some thousand rows at a time, whose numbers stay in the processor's cache.
        for i in range(0, len(x), 10_000):
            part = x[i : i + 10_000]
            code = np.stack([np.searchsorted(e, part[:, j]) for j, e in enumerate(edges)]).astype(np.uint8).T if edges else np.zeros((len(part), 0), np.uint8)
            for tree in trees:
                out[i : i + len(part)] += self.step * tree.value[placed(tree, code, depth_of(tree))]
        return out

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return dataset.withColumn(self.getPredictionCol(), predict_by_fold([self], self.features, None))


def predict_by_fold(models: Sequence[BoostedTrees], features: str, fold: Column | None) -> Column:
    """Prediction of the model of a row's fold; rows without one get the mean over all models.

    A row runs through the models that count for it only.
    """
    models = list(models)

    @F.pandas_udf("double")
    def predict(x: pd.Series, own: pd.Series) -> pd.Series:
        if not len(x):
            return pd.Series([], dtype=float)
        rows, fold_ = np.stack(x.to_numpy()), own.fillna(-1).to_numpy().astype(int)
        out = np.zeros(len(rows))
        for i, model in enumerate(models):
            use = fold_ == i
            out[use] = model.predict_matrix(rows[use])
        free = fold_ < 0
        if free.any():
            out[free] = np.mean([m.predict_matrix(rows[free]) for m in models], axis=0)
        return pd.Series(out)

    return predict(vector_to_array(features), (F.lit(None) if fold is None else fold).cast("int"))


class PatientBoosting(Estimator):
    """Boosting that keeps the round with the least held-out metric.

    Rows flagged by ``VALIDATION`` are held out; without such a column, or without flagged
    rows, all rounds are kept. ``cross_fit`` fits the models of all folds in shared passes.
    """

    def __init__(self, settings: Settings):
        super().__init__()
        self.settings = settings

    def _fit(self, df: DataFrame) -> BoostedTrees:
        held = F.when(F.col(VALIDATION), 0).otherwise(-1) if VALIDATION in df.columns else F.lit(-1)
        rows = df.select(self.settings.features, self.settings.label, held.cast("int").alias("_fold"))
        return FoldBoosting(rows, 1, "_fold", self.settings).run().models()[0]

    def fit_folds(self, df: DataFrame, k: int, fold: str) -> list[BoostedTrees]:
        distribute(df.sparkSession)
        return FoldBoosting(df, k, fold, self.settings).run().models()
