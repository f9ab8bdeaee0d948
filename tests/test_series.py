"""Series functions against plain recursions, on light and on cut (heavy) keys."""

import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from shelfmark.functions import series, skew

START = dt.datetime(2024, 1, 1)
LONG = 4000


def make_points():
    """One long series with bursts, ties and a long flat stretch; short and constant ones."""
    rng = np.random.default_rng(7)
    rows, event = [], 0
    steps = rng.integers(0, 3, LONG)
    steps[1500:1560] = 0  # sixty samples of one instant
    t = np.cumsum(steps * 7)
    x = np.round(100 + np.cumsum(rng.normal(0, 1, LONG)), 2)
    x[2000:3400] = x[1999]  # flat for longer than any look-back
    for i in range(LONG):
        rows.append((1, "long", float(x[i]), int(i % 40), START + dt.timedelta(seconds=int(t[i])), event))
        event += 1
    for item, values in ((2, [5.0] * 30), (3, range(1, 31)), (4, range(30, 0, -1)), (5, [1.0, 2.0]), (6, [9.0])):
        for i, v in enumerate(values):
            rows.append((item, f"n{item}", float(v), 3, START + dt.timedelta(minutes=i), event))
            event += 1
    return pd.DataFrame(rows, columns=["item_id", "name", "price", "quantity", "timestamp", "event_id"])


@pytest.fixture(scope="module")
def points_pd():
    return make_points()


@pytest.fixture(scope="module")
def points(spark, points_pd):
    schema = "item_id bigint, name string, price double, quantity int, timestamp timestamp, event_id bigint"
    return spark.createDataFrame(points_pd, schema).repartition(7)


def expect(pdf):
    out = []
    for _, g in pdf.groupby("item_id"):
        g = g.sort_values(["timestamp", "event_id"]).copy()
        x = g.price.to_numpy()
        e = np.empty(len(x))
        e[0] = x[0]
        for i in range(1, len(x)):
            e[i] = e[i - 1] + 2 / 15 * (x[i] - e[i - 1])
        d = np.diff(x, prepend=x[0])
        up, down = np.maximum(d, 0), np.maximum(-d, 0)

        def level(u, v):
            return 50.0 if u == 0 and v == 0 else 100.0 if v == 0 else 100 - 100 / (1 + u / v)

        wilder, cutler = [None] * len(x), [None] * len(x)
        for i in range(14, len(x)):
            u, v = (up[1:15].mean(), down[1:15].mean()) if i == 14 else ((u * 13 + up[i]) / 14, (v * 13 + down[i]) / 14)
            wilder[i] = level(u, v)
            cutler[i] = level(up[i - 13:i + 1].mean(), down[i - 13:i + 1].mean())
        g["sma"] = g.price.rolling(7, min_periods=1).mean()
        g["ema"], g["wilder"], g["cutler"] = e, wilder, cutler
        g["changes"] = np.cumsum(d != 0)
        out.append(g)
    return pd.concat(out).sort_values("event_id").reset_index(drop=True)


@pytest.mark.parametrize("max_rows", [1_000_000, 50])
def test_indicators(points, points_pd, max_rows):
    want = expect(points_pd)
    got = series.indicators(
        points, {"sma": "sma", "ema": "ema", "rsi": "wilder", "changes": "changes"}, max_rows=max_rows)
    got = got.toPandas().sort_values("event_id").reset_index(drop=True)
    assert len(got) == len(want)
    for c in ("sma", "ema", "wilder"):
        np.testing.assert_allclose(got[c].to_numpy(float), want[c].to_numpy(float), rtol=1e-9, err_msg=c)
    assert got.changes.tolist() == want.changes.tolist()
    cut = series.rsi(points, method="cutler", alias="cutler", max_rows=max_rows)
    cut = cut.toPandas().sort_values("event_id")
    np.testing.assert_allclose(cut.cutler.to_numpy(float), want.cutler.to_numpy(float), rtol=1e-9, atol=1e-6)


@pytest.mark.parametrize("max_rows", [1_000_000, 50])
def test_single_functions_agree(points, points_pd, max_rows):
    want = expect(points_pd)
    for fn, c in ((series.sma, "sma_7"), (series.ema, "ema_14"), (series.price_changes, "price_changes")):
        got = fn(points, max_rows=max_rows).toPandas().sort_values("event_id")
        np.testing.assert_allclose(got[c].to_numpy(float),
                                   want[{"sma_7": "sma", "ema_14": "ema"}.get(c, "changes")], rtol=1e-9)


@pytest.mark.parametrize("max_rows", [1_000_000, 50])
def test_range_windows(points, max_rows):
    one = series.latest_by(points, ["item_id", "timestamp"], ["event_id"])
    got = series.in_window(one, "2 minutes", ["changes", "rate", "pct_change"], max_rows=max_rows).toPandas()
    base = one.toPandas()
    assert len(got) == len(base)
    got = got.set_index(["item_id", "timestamp"])
    for item, g in base.groupby("item_id"):
        g = g.sort_values("timestamp")
        t, x = g.timestamp.to_numpy(), g.price.to_numpy()
        for i in range(len(g)):
            j = np.searchsorted(t, t[i] - np.timedelta64(120, "s"), side="right")
            w = x[j:i + 1]
            row = got.loc[(item, g.timestamp.iloc[i])]
            assert row["changes"] == int((np.diff(w) != 0).sum())
            assert row["pct_change"] == pytest.approx((w[-1] - w[0]) / w[0] * 100)
            rise = sum(b if b < a else b - a for a, b in zip(w, w[1:]))
            span = (t[i] - t[j]) / np.timedelta64(1, "s")
            if span:
                assert row["rate"] == pytest.approx(rise / span, abs=1e-9)
            else:
                assert pd.isna(row["rate"])


@pytest.mark.parametrize("max_rows", [1_000_000, 50])
def test_hold_time(points, points_pd, max_rows):
    got = series.held_for(points, F.col("quantity") < 30, "3 minutes", max_rows=max_rows)
    got = got.toPandas().set_index("event_id").held
    for _, g in points_pd.groupby("item_id"):
        since = None
        for r in g.sort_values(["timestamp", "event_id"]).itertuples():
            since = (since or r.timestamp) if r.quantity < 30 else None
            assert got[r.event_id] == (since is not None and r.timestamp - since >= pd.Timedelta("3min"))


@pytest.mark.parametrize("max_rows", [1_000_000, 50])
def test_day_average(points, points_pd, max_rows):
    got = series.sma_days(points, days=1, alias="m", max_rows=max_rows).toPandas().set_index("event_id").m
    g = points_pd[points_pd.item_id == 3].sort_values("timestamp")
    assert got[g.event_id].tolist() == pytest.approx(g.price.expanding().mean().tolist())


def test_heavy_branch_is_cut(points):
    from shelfmark.functions.skew import numbered
    heavy = points.filter("item_id = 1")
    out = numbered(heavy, ["item_id"], ["timestamp", "event_id"], 50).orderBy("timestamp", "event_id")
    assert [r["_pos"] for r in out.collect()] == list(range(LONG))


def test_cutting_goes_on_until_no_cell_is_heavy(spark):
    """Gaps that shrink by a thousand each time need a round each; equal rows end the cutting."""
    rows = [(1, float(1000.0 ** k + i * 1000.0 ** (k - 3)), 0) for k in range(6) for i in range(8)] + [(2, 1.0, 0)] * 50
    df = spark.createDataFrame(rows, "k int, t double, tie int")
    cut, cells = skew.cut_ordered(df, ["k"], ["t", "tie"], 4)
    assert len(cells) > 3
    assert cut.filter("k = 1").groupBy(*cells).count().agg({"count": "max"}).first()[0] <= 4
    got = skew.numbered(df, ["k"], ["t", "tie"], 4).orderBy("k", "_pos").collect()
    assert [r["_pos"] for r in got] == [*range(48), *range(50)]
    assert [r.t for r in got[:48]] == sorted(t for k, t, _ in rows if k == 1)


def test_hot_window_is_cut(spark, monkeypatch):
    """10,000 samples of one key inside one window, in pieces of 100 rows."""
    rng = np.random.default_rng(4)
    start = pd.Timestamp("2024-03-01")
    times = np.sort(rng.choice(3_600_000_000, 10_000, replace=False))
    rows = pd.DataFrame({"item_id": 1, "event_id": range(10_000), "price": np.round(rng.normal(100, 3, 10_000).cumsum() * 0 + rng.choice([99.5, 100.0, 101.25], 10_000), 2),
                         "timestamp": start + pd.to_timedelta(times, unit="us")})
    points = spark.createDataFrame(rows)
    largest = []
    real = skew.blocks

    def watched(df, keys, before, max_rows, heavy):
        out, part = real(df, keys, before, max_rows, heavy)
        if heavy:
            largest.append(out.groupBy(*part).count().agg({"count": "max"}).first()[0])
        return out, part

    monkeypatch.setattr(skew, "blocks", watched)
    monkeypatch.setattr(series, "blocks", watched)
    measures = ["changes", "rate", "pct_change"]
    for window in ("40 minutes", "3 seconds"):
        plain = series.in_window(points, window, measures).toPandas().set_index("event_id").sort_index()
        hot = series.in_window(points, window, measures, max_rows=100).toPandas().set_index("event_id").sort_index()
        assert (plain.changes == hot.changes).all()
        for c in ("rate", "pct_change"):
            assert np.allclose(plain[c].astype(float), hot[c].astype(float), equal_nan=True)
        assert list(plain.columns) == list(hot.columns)
    plain = series.sma_days(points, days=1, alias="m").toPandas().set_index("event_id").m.sort_index()
    hot = series.sma_days(points, days=1, alias="m", max_rows=100).toPandas().set_index("event_id").m.sort_index()
    assert np.allclose(plain, hot)
    assert len(largest) >= 6 and max(largest) <= 101
