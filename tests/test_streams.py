from __future__ import annotations

from pathlib import Path

import pytest

from sunloom.plans import images
from sunloom.session import materialise, shared_folder
from sunloom.streaming.flows import stream_images
from sunloom.tables import TABLES, read_table
from tests.test_sources import _card, _header


def test_arriving_images_are_registered_once(spark, tmp_path):
    landing, root, state = tmp_path / "in", str(tmp_path / "db"), str(tmp_path / "state")
    refused = str(tmp_path / "refused")
    landing.mkdir()

    def arrive(name, day):
        head = _header(_card("SIMPLE", "T"), _card("DATE-OBS", f"'2024/01/{day:02d}'"), _card("DETECTOR", "'C2'"))
        (landing / name).write_bytes(head)

    def run():
        def store(units):
            images.register_lasco(materialise(images.lasco_records(units), "arrived"), root, refused)

        stream_images(spark, str(landing), "*.fts", store, state, once=True).awaitTermination()
        return read_table(spark, root, TABLES["lasco"]).orderBy("datetime").collect()

    def scratch():
        return set(Path(shared_folder(spark)).glob("sunloom/*/*"))

    before = scratch()
    arrive("a.fts", 1)
    arrive("b.fts", 1)
    assert [r["file_path"].rsplit("/", 1)[-1] for r in run()] == ["a.fts"]
    arrive("c.fts", 2)
    assert [r["file_path"].rsplit("/", 1)[-1] for r in run()] == ["a.fts", "c.fts"]
    (landing / "d.fts").write_bytes(b"no image")
    assert len(run()) == 2
    assert [r.error for r in spark.read.parquet(refused).collect()] == ["invalid_file"]
    # Each batch took away what it had set down on the way.
    assert scratch() <= before


def test_a_batch_of_images_done_again_has_the_same_files(spark, tmp_path):
    landing, state = tmp_path / "in", str(tmp_path / "state")
    (landing / "day").mkdir(parents=True)
    taken, fails = [], [True]

    def store(units):
        taken.append(sorted(r["path"].rsplit("/", 1)[-1] for r in units.collect()))
        if fails and fails.pop():
            raise RuntimeError("cut short")

    def run():
        stream_images(spark, str(landing), "*.fts", store, state, once=True).awaitTermination()

    (landing / "a.fts").write_bytes(b"no image")
    (landing / "day" / "b.fts").write_bytes(b"no image")
    with pytest.raises(Exception, match="cut short"):
        run()
    (landing / "c.fts").write_bytes(b"no image")
    run()
    # What arrived in between is the next batch; then nothing is left, and no batch is handed on.
    run()
    run()
    assert taken[:2] == [["a.fts", "b.fts"]] * 2 and taken[2:] == [["c.fts"]]
    # Files of batches are kept in the store, not in the log of a source on the driver.
    assert len(list((tmp_path / "state" / "arrived").glob("batch-*"))) == 2
    assert not list((tmp_path / "state").glob("sources/0/0"))


def test_partial_bins_merge_to_the_batch(spark, tmp_path):
    from datetime import datetime, timedelta

    from pyspark.sql import functions as F

    from sunloom import versions
    from sunloom.operators.resample import tumbling_stats
    from sunloom.streaming.bins import add_batch, bin_stats, compact_bins

    out, half, hour = str(tmp_path / "bins"), timedelta(minutes=30), timedelta(hours=1)
    kinds = "datetime timestamp_ntz, v double"
    at = datetime(2024, 1, 1)
    batches = [
        [(at, 0.1), (at + 4 * hour, 1e17), (at + 4 * hour, float("nan")), (None, 5.0)],
        [],
        [(at + timedelta(minutes=5), 0.2), (at + 3 * hour, 1.0), (at + 4 * hour, 1.0), (at + hour, None)],
        [(at + timedelta(minutes=7), 1e-9), (at + 5 * hour, 2.0)],
    ]
    frames = [spark.createDataFrame(b, kinds) for b in batches]
    variables = {"v": F.col("v")}
    for number, frame in enumerate(frames):
        assert add_batch(frame, number, variables, half, hour, out)
    # A batch tried again, before and after folding, is there once.
    assert not add_batch(frames[2], 2, variables, half, hour, out)
    before = sorted(map(str, bin_stats(spark, out, ["v"]).collect()))
    assert compact_bins(spark, out, ["v"]) == 3 and compact_bins(spark, out, ["v"]) == 0
    assert len(versions.latest(spark, out).parts) == 1
    assert not add_batch(frames[2], 2, variables, half, hour, out)
    rows = bin_stats(spark, out, ["v"])
    assert sorted(map(str, rows.collect())) == before
    whole = tumbling_stats(spark.createDataFrame([r for b in batches for r in b], kinds), variables, half)
    assert sorted(map(str, rows.drop("rows", "late_rows").collect())) == sorted(map(str, whole.collect()))
    # Bins that ended at least an hour before the last time of earlier batches were closed.
    late = {r["datetime"]: (r["rows"], r["late_rows"]) for r in rows.collect()}
    assert late[at] == (3, 2) and late[at + hour] == (1, 1) and late[at + 3 * hour] == (1, 0)
