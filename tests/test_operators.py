"""Scalable forms against plain ones on small random data, skewed on purpose."""

from __future__ import annotations

import random
import re
from datetime import datetime, timedelta
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from sunloom.operators import inserts
from sunloom.operators.grids import hourly_targets, months, time_grid
from sunloom.operators.resample import tumbling_stats
from sunloom.operators.timejoin import covered, nearest_matches, nearest_record
from sunloom.operators.windows import Frame, moving_frames, moving_window, with_row_index, with_running_totals
from sunloom.functions.times import ntz
from sunloom.plans import samples
from sunloom.plans.sw30 import build_sw30
from sunloom.tables import TableSpec
from sunloom.sinks.tables import new_rows

T0 = datetime(2024, 1, 1)


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _records(rng, n):
    """A third of the records at one time, a third in one minute, the rest over a day."""
    out = []
    for i in range(n):
        spread = rng.choice([0, rng.randrange(60), rng.randrange(86400)])
        out.append((rng.choice("ab"), T0 + timedelta(hours=5, seconds=spread, microseconds=rng.randrange(3)), f"f{i:04d}"))
    return out


@pytest.mark.parametrize("slots", [1, 3, 16, 1024])
def test_nearest_matches_like_brute_force(spark, slots):
    rng = random.Random(slots)
    records = _records(rng, 400)
    targets = [(i, rng.choice("abc"), T0 + timedelta(hours=5, seconds=rng.randrange(-900, 90000))) for i in range(150)]
    targets += [(1000 + i, "a", T0 + timedelta(hours=5)) for i in range(60)]
    tolerance = timedelta(minutes=7)
    expected = {}
    for i, dim, at in targets:
        near = [(abs(t - at), t, f) for d, t, f in records if d == dim and abs(t - at) <= tolerance]
        expected[i] = min(near)[1:] if near else (None, None)
    found = nearest_matches(
        spark.createDataFrame(targets, "id int, dim string, target_time timestamp_ntz"),
        spark.createDataFrame(records, "dim string, datetime timestamp_ntz, file_path string"),
        ("dim",), tolerance, ("file_path",), slots=slots, how="left",
    )
    assert {r["id"]: (r["datetime"], r["file_path"]) for r in found.collect()} == expected
    plan = _plan(found)
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_nearest_matches_fetch_the_record_afterwards(spark):
    rng = random.Random(2)
    rows = [
        (rng.choice("ab"), T0 + timedelta(minutes=rng.randrange(50)), rng.choice([None, "f1", "f2"]), rng.choice([None, 1, 2, 3]), "x" * 9)
        for _ in range(200)
    ]
    records = spark.createDataFrame(rows, "dim string, datetime timestamp_ntz, file_path string, quality int, note string")
    targets = spark.createDataFrame([(i, "a", T0 + timedelta(minutes=2 * i)) for i in range(40)], "id int, dim string, target_time timestamp_ntz")
    least = lambda *v: tuple((x is not None, x) for x in v)  # noqa: E731 - a missing value sorts first
    expected = {}
    for i in range(40):
        at = T0 + timedelta(minutes=2 * i)
        near = [(abs(t - at), t, least(f), least(q, n)) for d, t, f, q, n in rows if d == "a" and abs(t - at) <= timedelta(minutes=3)]
        expected[i] = min(near, key=lambda r: r) if near else None
    found = nearest_matches(targets, records, ("dim",), timedelta(minutes=3), ("file_path",))
    got = {r["id"]: (r["datetime"], least(r["file_path"]), least(r["quality"], r["note"])) for r in found.collect()}
    assert got == {i: e[1:] for i, e in expected.items() if e}
    # No window carries the other columns.
    windows = [line for line in _plan(found).splitlines() if re.search(r"Window \[", line)]
    assert windows and not any("note" in line for line in windows)


def test_nearest_tie_and_duplicates(spark):
    records = spark.createDataFrame(
        [("a", T0 + timedelta(minutes=m), f"f{m}") for m in (-2, 2, 31)], "dim string, datetime timestamp_ntz, file_path string"
    )
    targets = spark.createDataFrame([("a", T0)] * 3, "dim string, target_time timestamp_ntz")
    rows = nearest_matches(targets, records, ("dim",), timedelta(minutes=30), ("file_path",)).collect()
    assert [r["file_path"] for r in rows] == ["f-2"] * 3
    assert nearest_record(records, ntz(T0), timedelta(minutes=30), ("file_path",)).first()["file_path"] == "f-2"


def test_covered(spark):
    records = spark.createDataFrame([("a", T0)], "dim string, datetime timestamp_ntz")
    targets = spark.createDataFrame(
        [("a", T0 + timedelta(minutes=6)), ("a", T0 + timedelta(minutes=6, microseconds=1)), ("b", T0)],
        "dim string, target_time timestamp_ntz",
    )
    assert covered(targets, records, ("dim",), timedelta(minutes=6)).count() == 1
    assert covered(targets, records, ("dim",), timedelta(minutes=6), inverted=True).count() == 2


def test_row_index_is_dense_and_ordered(spark):
    rng = random.Random(1)
    values = [(rng.randrange(50), i) for i in range(3000)]
    rows = with_row_index(spark.createDataFrame(values, "k int, i int").repartition(7), "k", "i").collect()
    assert [(r["k"], r["i"]) for r in sorted(rows, key=lambda r: r["row_index"])] == sorted(values)
    assert sorted(r["row_index"] for r in rows) == list(range(3000))


@pytest.mark.parametrize("before, after, block", [(3, 2, 5), (3, 2, 64), (0, 2, 7), (10, 10, 20)])
def test_moving_window_like_one_global_window(spark, before, after, block):
    rng = random.Random(before)
    bad = [int(rng.random() < 0.1) for _ in range(200)]
    df = spark.createDataFrame(list(enumerate(bad)), "row_index bigint, bad int")
    found = moving_window(df, before, after, {"n": (F.sum("bad"), -before, after - 1)}, block=block)
    got = {r["row_index"]: r["n"] for r in found.collect()}
    assert got == {i: sum(bad[max(i - before, 0) : i + after]) for i in range(200)}


def _plain_frame(values, i, frame):
    held = [v for k, v in values.items() if i + frame.first <= k <= i + frame.last and v is not None]
    if frame.kind == "value":
        return values.get(i + frame.first)
    return {"sum": sum, "max": max, "min": min}[frame.kind](held) if held else None


@pytest.mark.parametrize("block", [None, 40])
@pytest.mark.parametrize("begin, n", [(0, 1), (0, 137), (13, 90)])
def test_moving_frames_like_plain_ones(spark, begin, n, block):
    rng = random.Random(n)
    values = {begin + i: rng.choice([None, *range(-9, 9)]) for i in range(n)}
    spans = [(-3, 4), (0, 6), (-11, -2), (2, 9), (1, 1), (0, 0), (-20, 19)]
    frames = {f"{k}{j}": Frame(k, "v", lo, hi) for j, (lo, hi) in enumerate(spans) for k in ("sum", "max", "min")}
    frames["next"] = Frame("value", "v", 1, 1)
    found = moving_frames(spark.createDataFrame(list(values.items()), "row_index bigint, v int"), frames, block=block).collect()
    assert sorted(r["row_index"] for r in found) == sorted(values)
    for r in found:
        assert {k: r[k] for k in frames} == {k: _plain_frame(values, r["row_index"], f) for k, f in frames.items()}


def test_moving_frames_form_no_sliding_window(spark):
    df = spark.range(10).selectExpr("id AS row_index", "id AS v")
    plan = _plan(moving_frames(df, {"a": Frame("max", "v", -5, 5), "b": Frame("sum", "v", -5, 5)}))
    frames = set(re.findall(r"specifiedwindowframe\(RowFrame, ([^)]*)\(?\)?", plan))
    # Only running frames and single rows at a fixed distance.
    assert frames == {"unboundedpreceding$(", "-5, -5", "-6, -6", "5, 5"}
    assert plan.count("Exchange hashpartitioning") == 1


def test_window_fixture(spark):
    rows = [(T0 + timedelta(minutes=30 * i), None if i == 5 else 1.0, 40.0 if i == 3 else 10.0) for i in range(10)]
    table = spark.createDataFrame(rows, "datetime timestamp_ntz, v double, ap30 double")
    judged = samples.classify_candidates(table, before=2, after=2).orderBy("datetime").collect()
    steps = [(r["datetime"] - T0) // timedelta(minutes=30) for r in judged]
    assert steps == [2, 3, 4, 5, 6, 7]
    assert [s for s, r in zip(steps, judged) if r["status"] == "valid"] == [2, 3]
    assert [r["label"] for r in judged[:2]] == [1, 1]
    counts = {r["status"]: r["n"] for r in samples.skip_counts(table, before=2, after=2).collect()}
    assert counts == {"valid": 2, "missing_values": 4, "missing": 0}


def test_last_of_repeated_times_stands(spark):
    rows = [(T0 + timedelta(minutes=30 * i), 1.0) for i in (0, 1, 1, 1, 2, 3)]
    table = spark.createDataFrame(rows, "datetime timestamp_ntz, ap30 double")
    judged = samples.classify_candidates(table, before=1, after=1).collect()
    assert sorted((r["datetime"] - T0) // timedelta(minutes=30) for r in judged) == [1, 2]


def _sequential(rows):
    keys, values, kept = set(), set(), []
    for ordinal, key, value in sorted(rows):
        if key not in keys and value not in values:
            keys.add(key)
            values.add(value)
            kept.append(ordinal)
    return kept


def test_accept_like_sequential_inserts(spark):
    rng = random.Random(7)
    rows = [(i, rng.choice([None, "hot", *map(str, range(40))]), f"p{rng.randrange(60)}") for i in range(300)]
    rows += [(300, "k1", "q1"), (301, "k2", "q1"), (302, "k2", "q3")]
    df = spark.createDataFrame(rows, "n bigint, k string, p string")
    got = sorted(r["n"] for r in inserts.accept_in_order(df, ("k",), "p", "n").collect())
    assert got == _sequential(rows)
    assert 300 in got and 301 not in got and 302 in got


def test_first_per_key_with_null_parts(spark):
    df = spark.createDataFrame([(2, "a", None), (1, "a", None), (3, "a", "x")], "n int, k string, c string")
    assert sorted(r["n"] for r in inserts.first_per_key(df, ("k", "c"), ("n",)).collect()) == [1, 3]
    spec = TableSpec("t", df.schema, ("k", "c"))
    stored = spark.createDataFrame([("a", None)], "k string, c string")
    fresh = new_rows(df, stored, spec, ("n",))
    assert [r["n"] for r in fresh.collect()] == [3]
    assert "NestedLoop" not in _plan(fresh)


def test_tumbling_skips_missing_and_rejects_odd_bins(spark):
    df = spark.createDataFrame(
        [(T0, 1.0), (T0 + timedelta(minutes=29), None), (T0 + timedelta(minutes=30), None)], "datetime timestamp_ntz, x double"
    )
    rows = tumbling_stats(df, {"x": F.col("x")}, timedelta(minutes=30)).orderBy("datetime").collect()
    assert [(r["x_avg"], r["x_min"]) for r in rows] == [(1.0, 1.0), (None, None)]
    with pytest.raises(ValueError):
        tumbling_stats(df, {"x": F.col("x")}, timedelta(minutes=7))


def test_means_do_not_depend_on_order_or_size(spark):
    rng = random.Random(4)
    values = [1e17, 1.0, -1e17, 0.1, 0.2, 3e-8, float("nan"), None, 12.34, 1e25, -1e25, -7.5e-12, 2.5e19]
    values += [round(rng.uniform(-1e6, 1e6), 3) for _ in range(200)]
    rows = [(T0, v) for v in values]
    exact = [Fraction(repr(v)) for v in values if v is not None and v == v]
    means = set()
    for seed in range(4):
        rng.shuffle(rows)
        df = spark.createDataFrame(rows, "datetime timestamp_ntz, x double").repartition(seed + 1)
        found = tumbling_stats(df, {"x": F.col("x")}, timedelta(minutes=30)).first()
        means.add(found["x_avg"])
        assert found["x_max"] == 1e25
    (mean,) = means
    assert abs(Fraction(mean) - sum(exact) / len(exact)) <= abs(Fraction(mean)) * Fraction(2, 2**52)
    tiny = spark.createDataFrame([(T0, 1.5e-8), (T0, 2.5e-8), (T0, float("nan"))], "datetime timestamp_ntz, x double")
    row = tumbling_stats(tiny, {"x": F.col("x")}, timedelta(minutes=30)).first()
    assert (row["x_avg"], row["x_min"], row["x_max"]) == (2e-8, 1.5e-8, 2.5e-8)
    whole = spark.createDataFrame([(T0, 1), (T0, 2), (T0, None)], "datetime timestamp_ntz, x int")
    assert tumbling_stats(whole, {"x": F.col("x")}, timedelta(minutes=30)).first()["x_avg"] == 1.5


def test_sw30_needs_a_grid_start(spark):
    empty = spark.createDataFrame([], "datetime timestamp_ntz, ap30 double, hp30 double")
    with pytest.raises(ValueError):
        build_sw30(empty, empty, datetime(2024, 1, 1, 0, 10), datetime(2024, 1, 2))


def test_grids(spark):
    assert time_grid(spark, T0, T0 + timedelta(hours=1), timedelta(minutes=30)).count() == 3
    assert time_grid(spark, T0, T0 - timedelta(hours=1), timedelta(minutes=30)).count() == 0
    spans = spark.createDataFrame(
        [(T0 + timedelta(minutes=30), T0 + timedelta(hours=3, minutes=29))], "lo timestamp_ntz, hi timestamp_ntz"
    )
    assert [r["target_time"].hour for r in hourly_targets(spans, "lo", "hi").collect()] == [1, 2, 3]
    spans = spark.createDataFrame([(datetime(2023, 11, 30), datetime(2024, 2, 1))], "lo timestamp_ntz, hi timestamp_ntz")
    assert [(r["year"], r["month"]) for r in months(spans, "lo", "hi").collect()] == [(2023, 11), (2023, 12), (2024, 1), (2024, 2)]


def test_event_windows_complete_or_not(spark):
    rows = [(T0 + timedelta(minutes=30 * i), 1.0) for i in range(200) if i != 100]
    table = spark.createDataFrame(rows, "datetime timestamp_ntz, v double")
    day = timedelta(days=1)
    loose = samples.event_windows(table, T0 + day, T0 + 3 * day, timedelta(hours=6), day, day)
    strict = samples.event_windows(table, T0 + day, T0 + 3 * day, timedelta(hours=6), day, day, require_complete=True)
    assert loose.select("reference_time").distinct().count() == 9
    gap = T0 + timedelta(minutes=3000)
    kept = [T0 + day + timedelta(hours=6 * i) for i in range(9)]
    kept = [t for t in kept if not t - day <= gap < t + day]
    assert sorted(r[0] for r in strict.select("reference_time").distinct().collect()) == kept


@pytest.mark.parametrize("cadence, before, after", [(30, 10, 6), (60, 48, 1), (45, 5, 5), (360, 3, 2)])
def test_clean_references_like_plain_ones(spark, cadence, before, after):
    rng = random.Random(cadence)
    half = timedelta(minutes=30)
    times = [T0 + half * k for k in range(150) if rng.random() > 0.1] + [T0 + timedelta(minutes=7)] + [T0 + half * 20] * 3
    rows = [(t, None if rng.random() < 0.08 else 1.0) for t in times] + [(None, 1.0)]
    table = spark.createDataFrame(rows, "datetime timestamp_ntz, v double")
    start, end, tick = T0 - half * 5, T0 + half * 160, timedelta(minutes=cadence)
    for complete in (False, True):
        expected = {}
        for k in range((end - start) // tick + 1):
            ref = start + tick * k
            held = [(t, v) for t, v in rows if t is not None and ref - half * before <= t <= ref + half * (after - 1)]
            full = len({t for t, _ in held}) == before + after
            if held and all(v is not None for _, v in held) and (full or not complete):
                expected[ref] = sorted(t for t, _ in held)
        found: dict = {}
        for r in samples.event_windows(table, start, end, tick, half * before, half * after, complete).collect():
            found.setdefault(r["reference_time"], []).append(r["datetime"])
        assert {k: sorted(v) for k, v in found.items()} == expected


def test_running_totals(spark):
    rng = random.Random(8)
    rows = [(k, rng.choice([None, 0, 1, 5])) for k in rng.sample(range(5000), 2000)]
    found = with_running_totals(spark.createDataFrame(rows, "k int, v bigint").repartition(6), ("k",), {"so_far": "v"})
    total, expected = 0, {}
    for k, v in sorted(rows):
        total += v or 0
        expected[k] = total
    assert {r["k"]: r["so_far"] for r in found.collect()} == expected


def test_plans_push_down_and_prune(spark):
    path = "/root/testdata/sf0.001/events.parquet"
    events = spark.read.parquet(path).withColumnRenamed("ts", "datetime")
    held = events.where(F.col("datetime") >= ntz(T0))
    plan = _plan(tumbling_stats(held, {"value": F.col("value")}, timedelta(hours=1)))
    assert "GreaterThanOrEqual(ts" in plan
    assert "ReadSchema: struct<ts:timestamp_ntz,value:double>" in plan
