"""Histogram trees against a plain implementation, and the jobs around them."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from zonecast.config import BoostingConfig
from zonecast.operators import boosting
from zonecast.operators.lags import lag_features
from zonecast.operators.panel import full_panel
from zonecast.schemas import ZONE


def plain_tree(values, gradient, rows, columns, depth):
    """Node by node, every column and every value as threshold."""
    total, n = gradient[rows].sum(), len(rows)
    best = (1e-6, None, None)
    if depth:
        for f in columns:
            for threshold in np.unique(values[:, f])[1:]:
                left = values[rows, f] < threshold
                a, b = rows[left], rows[~left]
                if len(a) and len(b):
                    gain = gradient[a].sum() ** 2 / (len(a) + 1) + gradient[b].sum() ** 2 / (len(b) + 1) - total ** 2 / (n + 1)
                    if gain > best[0] + 1e-9:
                        best = (gain, f, threshold)
    if best[1] is None:
        return -total / (n + 1)
    left = values[rows, best[1]] < best[2]
    return best[1], best[2], plain_tree(values, gradient, rows[left], columns, depth - 1), plain_tree(values, gradient, rows[~left], columns, depth - 1)


def leaf(tree, row):
    while isinstance(tree, tuple):
        tree = tree[2] if row[tree[0]] < tree[1] else tree[3]
    return tree


@pytest.mark.parametrize("share", [1.0, 0.7])
def test_trees_equal_the_plain_ones(share):
    draw = np.random.default_rng(1)
    values = draw.integers(0, 12, (90, 5)).astype(float)
    labels = values[:, 0] * 0.7 + (values[:, 1] > 5) * 3 + draw.normal(size=90)
    config = BoostingConfig(n_estimators=12, max_depth=3, subsample=share, colsample=share)
    cuts = [boosting.quantile_cuts(v) for v in values.T]
    codes = np.stack([boosting.binned(v, c) for v, c in zip(values.T, cuts)], axis=1)
    import pyarrow as pa
    rows = pa.Table.from_batches(list(boosting.fit_zone(7, codes, cuts, labels, config)))
    expected = np.full(90, labels.mean())
    for tree in range(config.n_estimators):
        seen, kept = boosting.draws(tree, 90, 5, config)
        grown = plain_tree(values, expected - labels, seen, kept, config.max_depth)
        expected = expected + config.learning_rate * np.array([leaf(grown, row) for row in values])
    assert boosting.scored(rows, values) == pytest.approx(expected, abs=1e-9)
    assert np.square(expected - labels).mean() < np.square(labels - labels.mean()).mean() / 2


def test_more_values_than_bins():
    values = np.random.default_rng(2).normal(size=5000)
    cuts = boosting.quantile_cuts(values)
    codes = boosting.binned(values, cuts)
    assert len(cuts) == 255 and np.bincount(codes, minlength=256).min() >= 19
    assert ((values < cuts[99]) == (codes < 100)).all()
    assert len(boosting.quantile_cuts(np.full(10, 3.0))) == 0


@pytest.fixture(scope="module")
def samples(demand):
    rows = [(h, z, (h * z) % 7 + (h % 24 == 8) * 5 + z) for h in range(240) for z in (1, 2, 3, 4, 5)]
    return lag_features(full_panel(demand(rows)), (1, 24))


def test_models_of_groups_equal_models_of_one_task(spark, samples):
    config = BoostingConfig(n_estimators=8, max_depth=3, lags=(1, 24), zones_per_task=2)
    some = boosting.fit_zone_models(samples, [1, 2, 3, 4, 5], config)
    one = boosting.fit_zone_models(samples, [1, 2, 3, 4, 5], BoostingConfig(n_estimators=8, max_depth=3, lags=(1, 24), zones_per_task=9))
    assert sorted(some.trees.collect()) == sorted(one.trees.collect())
    got = some.predict(samples).join(samples, ["target_timestamp", ZONE])
    error = got.agg(F.avg(F.abs(F.col("predicted") - F.col("target")))).first()[0]
    assert got.count() == samples.count() and error < samples.agg(F.stddev("target")).first()[0]
    shares = some.importance(spark)
    assert shares.count() == 5 * (2 * 5 + 8)
    assert all(r.s == pytest.approx(1.0) for r in shares.groupBy("target_zone").agg(F.sum("importance").alias("s")).collect())


def test_zone_without_all_hours_fails(samples):
    gap = samples.filter((F.col(ZONE) != 3) | (F.hour("target_timestamp") != 5))
    with pytest.raises(Exception, match="every training hour once"):
        boosting.fit_zone_models(gap, [1, 2, 3, 4, 5], BoostingConfig(n_estimators=1, lags=(1, 24)))


def test_fit_plan_has_no_driver_loop(samples):
    """All fits of a run are rows of one plan."""
    models = boosting.fit_zone_models(samples, [1, 2, 3, 4, 5], BoostingConfig(n_estimators=1, lags=(1, 24), zones_per_task=1))
    assert models.tasks == 5 and models.trees.select("target_zone").distinct().count() == 5


def test_the_full_window_has_every_hour_and_its_calendar(spark, demand, tmp_path):
    from zonecast.operators.lags import calendar_names, feature_names, lag_matrix
    rows = [(h, z, (h * z) % 7 + (h % 24 == 8) * 5 + z) for h in range(120) for z in (1, 2, 3)]
    config = BoostingConfig(n_estimators=4, max_depth=2, mode="full", input_len=5)
    assert config.used_lags == config.used_calendar == (1, 2, 3, 4, 5)
    panel = full_panel(demand(rows))
    samples = lag_features(panel, config.used_lags, calendar=config.used_calendar)
    names = feature_names(config.used_lags, [1, 2, 3], config.used_calendar)
    first = lag_matrix(samples, [1, 2, 3], config.used_lags, config.used_calendar).orderBy("target_timestamp").first()
    got = dict(zip(names, first.features, strict=True))
    assert len(got) == 5 * (3 + 8)
    plain = {(h, z): d for h, z, d in rows}
    for lag in config.used_lags:
        assert [got[f"lag_{lag}_zone_{z}"] for z in (1, 2, 3)] == [plain[5 - lag, z] for z in (1, 2, 3)]
        assert got[f"hour_sin_{lag}h_before"] == pytest.approx(np.sin(2 * np.pi * (5 - lag) / 24))
    models = boosting.fit_zone_models(samples, [1, 2, 3], config)
    models.save(spark, f"{tmp_path}/models")
    again = boosting.load_models(spark, f"{tmp_path}/models")
    keys = ["target_timestamp", ZONE]
    assert sorted(again.predict(samples).collect()) == sorted(models.predict(samples).collect())
    # The trees by the plain rule: every zone's values at the features of its splits.
    assert models.predict(samples).select(*keys).distinct().count() == samples.count() == 3 * 115
    shares = {r.feature for r in models.importance(spark).select("feature").distinct().collect()}
    assert shares == set(names) and set(calendar_names(config.used_calendar)) < shares
    with pytest.raises(ValueError, match="mode"):
        BoostingConfig(mode="all")


def test_splits_are_sought_node_by_node():
    """The plain formula's splits, in memory for the arrays of one node."""
    import tracemalloc

    draw = np.random.default_rng(7)
    counts = draw.integers(0, 3, (8, 50, 256))
    counts[:, 1:, 0] += counts[:, :1].sum(axis=2) - counts[:, 1:].sum(axis=2) + 500  # as many rows in every column
    counts[:, 0, 0] += 500
    sums = draw.normal(size=counts.shape) * counts
    tracemalloc.start()
    best, column, first = boosting.best_splits(sums, counts)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 10 * sums[0].nbytes
    for node in range(8):
        left, n = sums[node].cumsum(axis=1)[:, :-1], counts[node].cumsum(axis=1)[:, :-1]
        total, rows = sums[node, 0].sum(), counts[node, 0].sum()
        gain = left ** 2 / (n + 1.0) + (total - left) ** 2 / (rows - n + 1.0) - total ** 2 / (rows + 1.0)
        gain[(n == 0) | (rows == n)] = -np.inf
        assert best[node] == gain.max() and (column[node], first[node] - 1) == np.unravel_index(gain.argmax(), gain.shape)
