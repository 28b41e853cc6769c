"""One boosted-tree regressor per target zone over the lags of all zones.

Every column is cut once into at most 256 bins at its quantiles and kept as a block of one byte per hour: a zone's lags
are its block, the calendar goes with the first zone's. A task fits a bounded group of zones on all blocks, so
fits run side by side in Spark tasks and a lost one is repeated alone. Trees grow level by level from histograms of
gradients per node and bin; of two siblings only the one with fewer rows is summed up, the other is what is left of
their parent. Trees and gains come back as rows; the driver sees neither blocks nor trees, only the checked list of zones.

Squared error, an L2 penalty of 1 on leaf values, at least one row in a leaf. Rows and columns are drawn anew for each tree, the
same for every zone. A value below a threshold goes left. The first value of a model is the mean of its labels.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from zonecast.config import BoostingConfig
from zonecast.operators.lags import calendar_hours, calendar_names, feature_name_rows, lag_matrix
from zonecast.schemas import ZONE
from zonecast.session import stored
from zonecast.sources.files import load_json, save_json

TREES = "target_zone int, tree int, node int, feature int, threshold double, value double, gain double"
"""A node per row: node k has the children 2k + 1 and 2k + 2; leaves have feature -1. Tree -1 is the model's first value."""

BLOCK = ("position int, zone int, hours binary, codes binary, cuts array<array<double>>, labels binary, "
         "calendar binary, calendar_cuts array<array<double>>")
BINS = 256
PENALTY = 1.0
SCORED_HOURS = 512
"""Hours a scoring task takes at once."""


# --- bins and trees of one zone ----------------------------------------------------------

def quantile_cuts(values: np.ndarray, bins: int = BINS) -> np.ndarray:
    """Thresholds between at most ``bins`` bins: all distinct values but the smallest, or quantiles if they are more."""
    distinct = np.unique(values)
    if len(distinct) > bins:
        ordered = np.sort(values)
        distinct = np.unique(ordered[np.arange(bins) * len(ordered) // bins])
    return distinct[1:]


def binned(values: np.ndarray, cuts: np.ndarray) -> np.ndarray:
    return np.searchsorted(cuts, values, side="right").astype(np.uint8)


class Histograms:
    """Sums of gradients and numbers of rows per node, column and bin."""

    def __init__(self, codes: np.ndarray):
        self.columns, self.bins = codes.shape[1], int(codes.max(initial=0)) + 1
        self.cells = codes.astype(np.int64) + np.arange(self.columns) * self.bins

    def of(self, rows: np.ndarray, slots: np.ndarray, nodes: int, gradient: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        width, shape = self.columns * self.bins, (nodes, self.columns, self.bins)
        at = (self.cells[rows] + (slots * width)[:, None]).ravel()
        sums = np.bincount(at, np.repeat(gradient[rows], self.columns), nodes * width)
        return sums.reshape(shape), np.bincount(at, minlength=nodes * width).reshape(shape)


def best_splits(sums: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per node the gain, column and first right bin of its best split; of equal ones the first column and bin."""
    best, at, width = np.full(len(sums), -np.inf), np.zeros(len(sums), np.int64), sums.shape[2] - 1
    if not sums.shape[1] * width:
        return best, at, at
    for node in range(len(sums)):  # one at a time and in place, so that the arrays stay in the processor's cache
        left, n = sums[node].cumsum(axis=1)[:, :-1], counts[node].cumsum(axis=1)[:, :-1]
        total, rows = sums[node, 0].sum(), counts[node, 0].sum()
        right, others = total - left, rows - n
        gain, right = np.square(left, out=left), np.square(right, out=right)
        gain /= n + PENALTY
        right /= others + PENALTY
        gain += right
        gain -= total ** 2 / (rows + PENALTY)
        gain[(n == 0) | (others == 0)] = -np.inf
        at[node] = gain.argmax()
        best[node] = gain.flat[at[node]]
    return best, at // width, at % width + 1


def grow(codes: np.ndarray, histograms: Histograms, rows: np.ndarray, gradient: np.ndarray, depth: int, rate: float) -> tuple[np.ndarray, dict[str, np.ndarray]]:
    """One tree on ``rows``; the leaf value of every row of ``codes`` and the nodes (node, column, bin, value, gain)."""
    size = (1 << (depth + 1)) - 1
    column, bins, gain, value = np.full(size, -1), np.zeros(size, np.int64), np.zeros(size), np.zeros(size)
    exists = np.zeros(size, bool)
    exists[0] = True
    at = np.zeros(len(codes), np.int64)  # node of every row, of those left out too
    level, sums, counts = np.array([0]), *histograms.of(rows, np.zeros(len(rows), np.int64), 1, gradient)
    for d in range(depth + 1):
        totals, numbers = sums[:, 0].sum(axis=1), counts[:, 0].sum(axis=1)
        value[level] = -rate * totals / (numbers + PENALTY)
        if d == depth:
            break
        best, chosen, first = best_splits(sums, counts)
        split = np.flatnonzero(best > 1e-6)
        if not len(split):
            break
        parents = level[split]
        column[parents], bins[parents], gain[parents] = chosen[split], first[split], best[split]
        moves = np.flatnonzero(column[at] >= 0)
        moves = moves[exists[at[moves]] & (2 * at[moves] + 1 < size) & np.isin(at[moves], parents)]
        here = at[moves]
        at[moves] = 2 * here + 1 + (codes[moves, column[here]] >= bins[here])
        exists[2 * parents + 1] = exists[2 * parents + 2] = True
        if d + 1 == depth:  # leaves need their totals only
            own, n = np.bincount(at[rows], gradient[rows], size), np.bincount(at[rows], minlength=size)
            level = np.sort(np.concatenate([2 * parents + 1, 2 * parents + 2]))
            sums, counts = own[level].reshape(-1, 1, 1), n[level].reshape(-1, 1, 1)
            continue
        n = np.bincount(at[rows], minlength=size)
        small = np.where(n[2 * parents + 1] <= n[2 * parents + 2], 2 * parents + 1, 2 * parents + 2)
        slot = np.full(size, -1)
        slot[small] = np.arange(len(small))
        mine = rows[slot[at[rows]] >= 0]
        few, few_n = histograms.of(mine, slot[at[mine]], len(small), gradient)
        place = 2 * np.arange(len(small)) + (small == 2 * parents + 2)
        both, both_n = np.empty((2 * len(small), *few.shape[1:])), np.empty((2 * len(small), *few.shape[1:]), np.int64)
        both[place], both_n[place] = few, few_n
        both[place ^ 1], both_n[place ^ 1] = sums[split] - few, counts[split] - few_n
        level = np.stack([2 * parents + 1, 2 * parents + 2], axis=1).ravel()
        sums, counts = both, both_n
    nodes = np.flatnonzero(exists)
    return value[at], {"node": nodes, "column": column[nodes], "bin": bins[nodes], "value": np.where(column[nodes] < 0, value[nodes], 0.0), "gain": gain[nodes]}


def draws(tree: int, rows: int, columns: int, config: BoostingConfig) -> tuple[np.ndarray, np.ndarray]:
    """The rows and columns a tree sees."""
    draw = np.random.default_rng([config.seed, tree])
    seen = np.flatnonzero(draw.random(rows) < config.subsample)
    kept = np.sort(draw.permutation(columns)[:max(1, int(config.colsample * columns))])
    return seen, kept


def fit_zone(zone: int, codes: np.ndarray, cuts: list, labels: np.ndarray, config: BoostingConfig) -> Iterator[pa.RecordBatch]:
    """The trees of one zone as rows of ``TREES``."""
    first = float(labels.mean()) if len(labels) else 0.0
    predicted, out = np.full(len(labels), first), [{
        "tree": np.array([-1]), "node": np.array([0]), "feature": np.array([-1]), "threshold": np.array([0.0]), "value": np.array([first]), "gain": np.array([0.0])}]
    for tree in range(config.n_estimators):
        rows, kept = draws(tree, *codes.shape, config)
        own = codes[:, kept]
        step, nodes = grow(own, Histograms(own), rows, predicted - labels, config.max_depth, config.learning_rate)
        predicted += step
        inner = nodes["column"] >= 0
        feature = np.where(inner, kept[nodes["column"]], -1)
        threshold = np.array([cuts[f][b - 1] if f >= 0 else 0.0 for f, b in zip(feature.tolist(), nodes["bin"].tolist(), strict=True)])
        out.append({"tree": np.full(len(feature), tree), "node": nodes["node"], "feature": feature, "threshold": threshold, "value": nodes["value"], "gain": nodes["gain"]})
    columns = {name: np.concatenate([part[name] for part in out]) for name in out[0]}
    yield pa.RecordBatch.from_arrays(
        [pa.array(np.full(len(columns["tree"]), zone, np.int32)), *[pa.array(columns[n].astype(np.int32)) for n in ("tree", "node", "feature")],
         *[pa.array(columns[n].astype(float)) for n in ("threshold", "value", "gain")]], names=[f.split()[0] for f in TREES.split(", ")])


def scored(nodes: pa.Table, features: np.ndarray) -> np.ndarray:
    """Values of the rows of ``features`` by the trees of one zone, all trees at once."""
    tree, node = nodes.column("tree").to_numpy() + 1, nodes.column("node").to_numpy()
    shape = int(tree.max()) + 1, int(node.max()) + 1
    feature, threshold, value = np.full(shape, -1), np.zeros(shape), np.zeros(shape)
    for name, out in (("feature", feature), ("threshold", threshold), ("value", value)):
        out[tree, node] = nodes.column(name).to_numpy()
    at, trees, rows = np.zeros((shape[0], len(features)), np.int64), np.arange(shape[0])[:, None], np.arange(len(features))
    while True:
        own = feature[trees, at]
        if (own < 0).all():
            return value[trees, at].sum(axis=0)
        at = np.where(own < 0, at, 2 * at + 1 + (features[rows, np.maximum(own, 0)] >= threshold[trees, at]))


# --- Spark jobs --------------------------------------------------------------------------

@dataclass(frozen=True)
class ZoneModels:
    zones: tuple[int, ...]
    lags: tuple[int, ...]
    calendar: tuple[int, ...]
    trees: DataFrame
    zones_per_task: int = BoostingConfig.zones_per_task

    @property
    def tasks(self) -> int:
        return -(-len(self.zones) // self.zones_per_task)

    def predict(self, samples: DataFrame) -> DataFrame:
        """Predicted value per target hour and zone, on the scale of the samples.

        A task scores some hours by the trees of a group of zones.
        """
        keys = [c for c in ("forecast_run_timestamp", "target_timestamp") if c in samples.columns]
        matrix = stored(lag_matrix(samples, self.zones, self.lags, self.calendar, labels=False).select(*keys, "features"), "lag-rows")
        chunks = max(1, -(-matrix.count() // SCORED_HOURS))
        hours = matrix.select(*keys, "features", F.pmod(F.xxhash64("target_timestamp"), F.lit(chunks)).cast("int").alias("chunk"), _each(self.tasks).alias("task"))
        listed = self.trees.sparkSession.createDataFrame(
            [(zone, place // self.zones_per_task) for place, zone in enumerate(self.zones)], "target_zone int, task int")
        trees = (self.trees.join(F.broadcast(listed), "target_zone")  # a row per zone, MAX_WIDE_ZONES at most
                 .select("target_zone", "tree", "node", "feature", "threshold", "value", "task", _each(chunks).alias("chunk")))

        def score(rows: pa.Table, nodes: pa.Table) -> pa.Table:
            schema = pa.schema([*[rows.schema.field(k) for k in keys], pa.field(ZONE, pa.int32()), pa.field("predicted", pa.float64())])
            features = rows.column("features").combine_chunks()
            if not rows.num_rows or not nodes.num_rows:
                return schema.empty_table()
            width = len(features[0])
            values = features.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
            zone, out = nodes.column("target_zone").to_numpy(), []
            for one in np.unique(zone).tolist():
                predicted = scored(nodes.filter(pa.array(zone == one)), values)
                out.append(pa.Table.from_arrays([*[rows.column(k) for k in keys], pa.array(np.full(len(predicted), one, np.int32)), pa.array(predicted)], schema=schema))
            return pa.concat_tables(out)

        fields = ", ".join([*[f"{k} {samples.schema[k].dataType.simpleString()}" for k in keys], f"{ZONE} int, predicted double"])
        return hours.groupBy("task", "chunk").cogroup(trees.groupBy("task", "chunk")).applyInArrow(score, fields)

    def importance(self, spark: SparkSession) -> DataFrame:
        """Rows (target zone, feature, importance): the mean gain of the splits by a feature, as a share of its zone's sum."""
        zones = spark.createDataFrame([(z,) for z in self.zones], f"{ZONE} int")
        number = len(self.zones) * len(self.lags) + len(calendar_names(self.calendar))
        gains = self.trees.filter("feature >= 0").groupBy("target_zone", F.col("feature").alias("position")).agg(F.avg("gain").alias("gain"))
        total = gains.groupBy("target_zone").agg(F.sum("gain").alias("total"))
        cells = zones.select(F.col(ZONE).alias("target_zone"), _each(number).alias("position"))
        return (cells.join(gains, ["target_zone", "position"], "left").join(total, "target_zone", "left")
                .join(feature_name_rows(zones, self.lags, self.calendar), "position")
                .select("target_zone", "feature", F.coalesce(F.col("gain") / F.nullif("total", F.lit(0.0)), F.lit(0.0)).alias("importance")))

    def save(self, spark: SparkSession, path: str) -> None:
        self.trees.write.mode("overwrite").parquet(f"{path}/trees")
        save_json(spark, {"zones": self.zones, "lags": self.lags, "calendar": self.calendar}, f"{path}/layout")


def _each(number: int):
    """0, 1, ... ``number`` - 1, a row each."""
    return F.explode(F.sequence(F.lit(0), F.lit(number - 1)))


def load_models(spark: SparkSession, path: str) -> ZoneModels:
    layout = load_json(spark, f"{path}/layout")
    return ZoneModels(tuple(layout["zones"]), tuple(layout["lags"]), tuple(layout["calendar"]), spark.read.schema(TREES).parquet(f"{path}/trees"))


def column_blocks(samples: DataFrame, zones: Sequence[int], lags: Sequence[int], calendar: Sequence[int]) -> DataFrame:
    """A row per zone: its hours, its lags in bins, its labels, and with the first zone the calendar in bins."""
    place, names = {int(z): p for p, z in enumerate(zones)}, calendar_names(calendar)

    def bins(table: pa.Table, names: Sequence[str]) -> tuple[bytes, list]:
        values = [table.column(n).to_numpy().astype(float) for n in names]
        cuts = [quantile_cuts(v) for v in values]
        return b"".join(binned(v, c).tobytes() for v, c in zip(values, cuts, strict=True)), [c.tolist() for c in cuts]

    def block(key: tuple, table: pa.Table) -> pa.Table:
        zone = key[0].as_py()
        own = table.sort_by("target_timestamp")
        codes, cuts = bins(own, [f"lag_{lag}" for lag in lags])
        told = bins(own, names) if names and place.get(zone) == 0 else (None, None)
        rows = [] if zone not in place else [{
            "position": place[zone], "zone": zone, "hours": own.column("target_timestamp").cast(pa.int64()).to_numpy().tobytes(), "codes": codes, "cuts": cuts,
            "labels": own.column("target").to_numpy().astype(float).tobytes(), "calendar": told[0], "calendar_cuts": told[1]}]
        lists = pa.list_(pa.list_(pa.float64()))
        return pa.Table.from_pylist(rows, pa.schema([
            ("position", pa.int32()), ("zone", pa.int32()), ("hours", pa.binary()), ("codes", pa.binary()), ("cuts", lists), ("labels", pa.binary()),
            ("calendar", pa.binary()), ("calendar_cuts", lists)]))

    wanted = ["target_timestamp", ZONE, "target", *[f"lag_{lag}" for lag in lags], *names]
    return samples.select(*wanted).groupBy(ZONE).applyInArrow(block, BLOCK)


def fit_zone_models(samples: DataFrame, zones: Sequence[int], config: BoostingConfig) -> ZoneModels:
    """``samples`` are the scaled lag rows of the training hours. Zones that do not all have the same hours fail the job."""
    lags, calendar, per = config.used_lags, calendar_hours(config.used_calendar), config.zones_per_task
    tasks = -(-len(zones) // per)
    number = len(zones)

    def fit(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = sorted((row for batch in batches for row in batch.to_pylist()), key=lambda r: r["position"])
        if len(rows) != number or len({row["hours"] for row in rows}) > 1:
            raise ValueError("not every zone has every training hour once")
        n = len(rows[0]["hours"]) // 8
        codes = [np.frombuffer(row["codes"], np.uint8).reshape(len(lags), n) for row in rows]
        # Lag by lag, zones in order, as the names of the features go.
        parts = [np.stack([block[k] for block in codes], axis=1) for k in range(len(lags))]
        cuts = [row["cuts"][k] for k in range(len(lags)) for row in rows]
        if calendar:
            parts.append(np.frombuffer(rows[0]["calendar"], np.uint8).reshape(-1, n).T)
            cuts += rows[0]["calendar_cuts"]
        whole = np.concatenate(parts, axis=1)
        for row in rows:
            if row["labels"] is not None:
                yield from fit_zone(row["zone"], whole, cuts, np.frombuffer(row["labels"], float), config)

    blocks = stored(column_blocks(samples, zones, lags, calendar), "column-blocks")
    dealt = blocks.withColumn("task", _each(tasks)).withColumn("labels", F.when(F.floor(F.col("position") / per) == F.col("task"), F.col("labels")))
    trees = dealt.repartitionByRange(tasks, "task").groupBy("task").applyInArrow(fit, TREES)
    return ZoneModels(tuple(int(z) for z in zones), tuple(lags), calendar, stored(trees, "trees"), per)
