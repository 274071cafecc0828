"""Rolling medians against plain loops: ties, nulls, repeated and broken rows, and hours that are cut into slices."""

import datetime
import random
import re
import statistics

import pytest

from orrery.llm import medians

SCHEMA = "click_id long, ts timestamp_ntz, arrived_at timestamp_ntz, client_id long, kind string, value double, props string, series string, hour long, slice int, part int, role int, count long, since long"
START = datetime.datetime(2024, 1, 31, 22, 0)
HOUR = datetime.timedelta(hours=1)


def clicks_of(spark, rows):
    return spark.createDataFrame([(i, ts, ts, 1, kind, value, "{}", "s", 1, 1, 1, 1, 1, 1) for i, ts, kind, value in rows], SCHEMA)


def plain(rows):
    """Every window by a loop over all clicks."""
    once = {}
    for i, ts, kind, value in rows:
        if ts is not None:
            cents = None if value is None or not abs(value) < 2**53 / 100 else int((100 * value + 0.5) // 1)
            key = (ts, kind is not None, kind or "", cents is not None, cents or 0)
            once[i] = min(once.get(i, (key, cents)), (key, cents), key=lambda x: x[0])
    out = {}
    for i, ((ts, _, _, _, _), own) in once.items():
        kind = once[i][0][2] if once[i][0][1] else None
        window = sorted(c for k, c in once.values() if c is not None and (k[2] if k[1] else None) == kind and ts - HOUR <= k[0] <= ts)
        if len(window) < 2:
            out[i] = (kind, len(window), None, None, None)
            continue
        twice = lambda x: x[(len(x) - 1) // 2] + x[len(x) // 2]
        m = twice(window)
        mad = twice(sorted(abs(2 * c - m) for c in window))
        out[i] = (kind, len(window), m, mad, None if own is None else 2 * abs(2 * own - m) > 3 * mad)
    return out


def found(df):
    rows = df.collect()
    assert len({r.click_id for r in rows}) == len(rows)
    return {r.click_id: (r.kind, r.n, r.median2, r.mad4, r.far) for r in rows}


def random_rows(seed, n, hours=4.0, kinds=("a", "b", "", None), spread=50):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        ts = START + datetime.timedelta(microseconds=rng.choice([rng.randrange(int(hours * 3.6e9)), rng.randrange(int(hours * 60)) * 60_000_000]))
        value = rng.choice([None, float("nan"), 1e300, -0.005, 0.005, 48_000_000.0, *[rng.randrange(spread) / 4 for _ in range(12)]])
        rows.append((i, None if rng.random() < 0.02 else ts, rng.choice(kinds), value))
    return rows + rng.sample(rows, n // 10)


@pytest.mark.parametrize("most", [4, 30, medians.MOST])
def test_equals_plain_loops(spark, most):
    rows = random_rows(most, 500)
    assert found(medians.rolling(clicks_of(spark, rows).repartition(3), most)) == plain(rows)


def test_dense_hour_of_one_series(spark):
    rows = random_rows(1, 600, 1.7, ("a",), 400)
    # A third of the clicks at one time: more windows than a task may have are dealt to several.
    rows += [(10_000 + i, START + datetime.timedelta(minutes=30), "a", (i % 7) / 10) for i in range(300)]
    df = clicks_of(spark, rows)
    assert found(medians.rolling(df, 40)) == plain(rows)
    crowded = medians.crowded_hours(medians.clicks_once(df).withColumn("hour", medians.F.expr(f"(at - pmod(at, {medians.HOUR})) div {medians.HOUR}")), 40)
    assert crowded.count() >= 2


def test_edges_of_windows(spark):
    second, tick = datetime.timedelta(seconds=1), datetime.timedelta(microseconds=1)
    rows = [(0, START, "a", 1.0), (1, START + HOUR, "a", 2.0), (2, START + HOUR + tick, "a", 4.0), (3, START + 2 * HOUR + 2 * tick, "a", 8.0), (4, START + HOUR, None, 1.0), (5, START - second, "a", None)]
    for most in (1, 2, 100):
        got = found(medians.rolling(clicks_of(spark, rows), most))
        assert got == plain(rows)
    assert got[1][1] == 2 and got[2][1] == 2 and got[3] == ("a", 1, None, None, None) and got[5] == ("a", 0, None, None, None)


def test_clock_without_zone(spark):
    """An hour that a zone's summer time leaves out or repeats is an hour like any other."""
    rows = [(i, datetime.datetime(2024, 3, 31, 1, 0) + i * datetime.timedelta(minutes=20), "a", float(i)) for i in range(8)]
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Europe/Berlin")
    try:
        assert found(medians.rolling(clicks_of(spark, rows))) == plain(rows)
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_repeated_ids_that_differ(spark):
    rows = [(1, START + HOUR, "b", 3.0), (1, START, "a", 2.0), (1, None, "a", 1.0), (2, START, "a", 2.0), (None, START, "a", 5.0), (None, START, "a", 5.0)]
    got = found(medians.rolling(clicks_of(spark, rows)))
    assert got[1] == ("a", 3, 400, 0, False) and set(got) == {1, 2, None} and got[None] == ("a", 3, 400, 0, True)


def test_no_rows(spark):
    for rows in ([], [(1, None, "a", 1.0)]):
        out = medians.rolling(clicks_of(spark, rows))
        assert out.collect() == [] and out.columns == ["click_id", "kind", "n", "median2", "mad4", "far"]


def test_ranks_choose_and_count():
    np = medians.np
    rng = np.random.default_rng(3)
    for counted in (False, True):
        values = rng.integers(-40, 40, 300) * 10
        counts = rng.integers(1, 5, 300) if counted else np.ones(300, np.int64)
        more = np.unique(rng.integers(-40, 40, 30)) if counted else np.zeros(0, np.int64)
        more_counts = np.arange(1, len(more) + 1)
        ranks = medians.Ranks(values, counts, more, more_counts)
        a, b = (np.array(x) for x in zip(*[sorted(rng.integers(0, 301, 2).tolist()) for _ in range(200)], strict=True))
        whole = [sorted([*np.repeat(values[i:j], counts[i:j]).tolist(), *np.repeat(more, more_counts).tolist()]) for i, j in zip(a, b, strict=True)]
        n = np.array(list(map(len, whole)))
        some = n >= 2
        k = (rng.random(200) * n).astype(int)
        assert ranks.choose(a[some], b[some], k[some]).tolist() == [w[i] for w, i, s in zip(whole, k, some, strict=True) if s]
        median2, mad4 = ranks.medians(a[some], b[some], n[some])
        for w, m, d in zip([w for w in whole if len(w) >= 2], median2.tolist(), mad4.tolist(), strict=True):
            assert m == 2 * statistics.median(w) and d == 2 * statistics.median([abs(2 * x - m) for x in w])


def test_no_single_task_and_no_broadcast_of_clicks(spark):
    plan = medians.rolling(clicks_of(spark, random_rows(2, 50)))._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan and "Broadcast" not in plan and re.search(r"hashpartitioning\(series", plan)
