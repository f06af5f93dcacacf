from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from sunloom import versions
from sunloom.plans import images
from sunloom.plans.ingest import ingest_nowcast
from sunloom.sinks import exports, tables
from sunloom.sinks.paths import known_values
from sunloom.sinks.tables import append_rows, compact, delete_orphans, insert_ignore, replace_years
from sunloom.sources.fixed_width import read_lines
from sunloom.sources.hpo import HP30
from sunloom.tables import SW30_COLUMNS, TABLES, conform, ensure_tables, read_table, table_path

T0 = datetime(2024, 1, 1)
MAG = TABLES["goes_mag"]


def _mag(spark, rows):
    return spark.createDataFrame(rows, "satellite int, datetime timestamp_ntz, bx_nt double, n bigint")


def test_table_shapes():
    assert {name: len(spec.columns) for name, spec in TABLES.items()} == {
        "omni_low_resolution": 56, "omni_high_resolution": 47, "omni_high_resolution_5min": 50, "hpo_hp30": 7,
        "hpo_hp60": 7, "goes_xrs": 11, "goes_mag": 8, "goes_proton": 10, "sw_30min": 24, "lasco": 5, "sdo": 7, "secchi": 9,
    }


def test_conform(spark):
    df = spark.createDataFrame([(16, T0, float("nan"), 3)], "Satellite int, DATETIME timestamp_ntz, bx_NT double, n bigint")
    row = conform(df.withColumn("mag_flag", F.lit(2.5)), MAG).first()
    assert (row["bx_nt"], row["mag_flag"], row["coord_frame"]) == (None, 2, None)


def test_insert_ignore_counts_and_repeats(spark, tmp_path):
    root = str(tmp_path)
    batch = _mag(spark, [(16, T0, 1.0, 2), (16, T0, 2.0, 1), (17, T0, 3.0, 3), (16, None, 4.0, 4)])
    first = insert_ignore(batch, MAG, root, ("n",))
    assert (first.offered, first.inserted, first.ignored, first.refused) == (3, 2, 1, 1)
    assert [r["error"] for r in first.refused_rows.collect()] == ["missing_key"]
    later = _mag(spark, [(16, T0, 9.0, 1), (16, T0 + timedelta(days=400), 5.0, 2)])
    assert insert_ignore(later, MAG, root, ("n",)).inserted == 1
    assert insert_ignore(later, MAG, root, ("n",)).inserted == 0
    rows = {(r["satellite"], r["datetime"]): r["bx_nt"] for r in read_table(spark, root, MAG).collect()}
    assert rows == {(16, T0): 2.0, (17, T0): 3.0, (16, T0 + timedelta(days=400)): 5.0}


@pytest.mark.parametrize("repeats, staged", [(1, ["batch"]), (20, ["batch", "fresh"])])
def test_first_insert_moves_rows_once(spark, tmp_path, monkeypatch, repeats, staged):
    made, plans = [], []
    stage, write = tables.materialise, versions.write_parts
    monkeypatch.setattr(tables, "materialise", lambda df, name: made.append(name) or stage(df, name))
    monkeypatch.setattr(
        versions, "write_parts", lambda df, *to: plans.append(df._jdf.queryExecution().executedPlan().toString()) or write(df, *to)
    )
    # Of 100 keys one, at the end of the year, comes several times; a row of another one lacks a time.
    last = datetime(2024, 12, 31, 23, 59)
    rows = [(16 + k % 2, T0 + timedelta(hours=k), float(k), k) for k in range(99)]
    rows += [(16, last, 1000.0 - k, 999 - k) for k in range(repeats + 1)] + [(17, None, 0.0, 5)]
    counts = insert_ignore(_mag(spark, rows).repartition(7), MAG, str(tmp_path), ("n",))
    assert (counts.offered, counts.inserted, counts.refused) == (100 + repeats, 100, 1)
    held = {(r["satellite"], r["datetime"]): r["bx_nt"] for r in read_table(spark, str(tmp_path), MAG).collect()}
    assert held == {(s, t): x for s, t, x, _ in rows[:99]} | {(16, last): 1000.0 - repeats}
    assert made == staged and [p.count("Exchange") for p in plans] == [1]


def test_first_insert_with_a_stored_year_beside_the_key(spark, tmp_path):
    spec = TABLES["hpo_hp30"]
    schema = "datetime timestamp_ntz, year int, month int, day int, hh_start double, hp30 double, n int"
    rows = [(T0 + timedelta(hours=k), 2024, 1, 1, 0.0, float(k), k) for k in range(50)]
    # The key is the time alone, whatever year is stored.
    rows.append((T0, 2023, 1, 1, 0.0, 99.0, 99))
    assert insert_ignore(spark.createDataFrame(rows, schema), spec, str(tmp_path), ("n",)).inserted == 50
    held = read_table(spark, str(tmp_path), spec).where(F.col("datetime") == T0).collect()
    assert [(r["year"], r["hp30"]) for r in held] == [(2024, 0.0)]


def test_replace_keeps_other_years_and_repeats(spark, tmp_path):
    root = str(tmp_path)
    replace_years(_mag(spark, [(16, T0, 1.0, 1), (16, datetime(2023, 5, 1), 2.0, 2)]), MAG, root)
    for _ in range(2):
        refused = replace_years(_mag(spark, [(16, T0 + timedelta(hours=1), 3.0, 1), (16, None, 4.0, 2)]), MAG, root)
        assert [r["error"] for r in refused.collect()] == ["missing_key"]
    assert sorted(r["bx_nt"] for r in read_table(spark, root, MAG).collect()) == [2.0, 3.0]


def test_year_filter_prunes_partitions(spark, tmp_path):
    root = str(tmp_path)
    append_rows(_mag(spark, [(16, datetime(y, 1, 1), 1.0, y) for y in (2022, 2023, 2024)]), MAG, root)
    plan = read_table(spark, root, MAG).where("datetime_year = 2023")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(datetime_year" in plan


def test_ensure_tables(spark, tmp_path):
    root = str(tmp_path)
    assert ensure_tables(spark, root, [MAG]) == ["goes_mag"]
    assert read_table(spark, root, MAG).count() == 0
    append_rows(_mag(spark, [(16, T0, 1.0, 1)]), MAG, root)
    assert ensure_tables(spark, root, [MAG]) == []
    assert ensure_tables(spark, root, [MAG], drop=True) == ["goes_mag"]
    assert read_table(spark, root, MAG).count() == 0


def _lasco(spark, numbers, hour=0, folder="/a"):
    rows = [("c2", T0 + timedelta(hours=i + hour, days=400 * (i % 2)), f"{folder}/{i}") for i in numbers]
    return spark.createDataFrame(rows, "camera string, datetime timestamp_ntz, file_path string")


def test_delete_orphans_in_place(spark, tmp_path):
    spec, root = TABLES["lasco"], str(tmp_path)
    append_rows(_lasco(spark, range(4)), spec, root)
    before = read_table(spark, root, spec)
    listing = spark.createDataFrame([("/a/0",), ("/a/1",), ("/a/3",), ("/a/9",)], "path string")
    assert delete_orphans(spark, spec, root, listing) == 1
    assert sorted(r["file_path"] for r in read_table(spark, root, spec).collect()) == ["/a/0", "/a/1", "/a/3"]
    # The year without orphans was not written again, and the old version still reads.
    old, new = (versions.load(spark, table_path(root, "lasco"), n) for n in (1, 2))
    assert len(set(old.parts) & set(new.parts)) == 1 and len(old.parts) == len(new.parts) == 2
    assert before.count() == read_table(spark, root, spec, 1).count() == 4
    assert delete_orphans(spark, spec, root, listing) == 0
    # The path of a deleted row is free again, those of the others are not.
    found = insert_ignore(_lasco(spark, range(4), hour=50).withColumn("n", F.col("file_path")), spec, root, ("n",))
    assert found.inserted == 1


def test_two_writers_store_no_key_twice(spark, tmp_path):
    spec, root = TABLES["lasco"], str(tmp_path)
    ensure_tables(spark, root, [spec])

    def add(k):
        rows = _lasco(spark, range(5 * k, 5 * k + 20)).withColumn("n", F.col("file_path"))
        return insert_ignore(rows, spec, root, ("n",)).inserted

    with ThreadPoolExecutor(4) as pool:
        inserted = list(pool.map(add, range(4)))
    stored = [r["file_path"] for r in read_table(spark, root, spec).collect()]
    assert sum(inserted) == len(stored) == len(set(stored)) == 35
    # What lost a race is gone from the disk.
    held = {c for c, _ in versions.latest(spark, table_path(root, "lasco")).parts}
    assert {f.name.removeprefix("commit=") for f in (tmp_path / "lasco").glob("commit=*")} == held


def test_a_version_is_published_once(spark, tmp_path):
    table = str(tmp_path / "t")
    base = versions.publish(spark, table, versions.Version(), [("c1", "y=1"), ("c1", "y=2")])
    done = versions.publish(spark, table, base, [("c2", "y=1")], [("c1", "y=1")])
    with pytest.raises(versions.Conflict):
        versions.publish(spark, table, base, [("c3", "y=1")])
    assert versions.latest(spark, table) == done
    assert (done.number, done.parts, done.dropped) == (2, (("c1", "y=2"), ("c2", "y=1")), (("c1", "y=1"),))


def test_readers_see_no_unpublished_rows(spark, tmp_path):
    root = str(tmp_path)
    append_rows(_mag(spark, [(16, T0, 1.0, 1)]), MAG, root)
    rows = _mag(spark, [(17, T0, 2.0, 2)]).select("satellite", "datetime", "bx_nt", F.lit(2024).alias("datetime_year"))
    versions.write_parts(rows, table_path(root, MAG.name), "datetime_year")
    assert read_table(spark, root, MAG).count() == 1
    assert versions.vacuum(spark, table_path(root, MAG.name)) == 0
    assert versions.vacuum(spark, table_path(root, MAG.name), older_than=-60) == 1
    assert read_table(spark, root, MAG).count() == 1


def test_an_insert_reads_its_own_buckets(spark, tmp_path):
    spec, few, many = TABLES["lasco"], str(tmp_path / "few"), str(tmp_path / "many")
    batch = _lasco(spark, range(5), hour=9000, folder="/d/3").withColumn("n", F.col("file_path"))
    read = []
    for root, folders in ((few, 10), (many, 100)):
        rows = [("c2", T0 + timedelta(minutes=k), f"/d/{k % folders}/{k // folders}") for k in range(folders * 7)]
        append_rows(spark.createDataFrame(rows, "camera string, datetime timestamp_ntz, file_path string"), spec, root)
        path = table_path(root, "lasco")
        found = known_values(spark, path, versions.latest(spark, path), batch, "file_path")
        read.append(sorted(r[0] for r in found.where("file_path LIKE '/d/3/%'").collect()))
        # All that is read lies in one of 4,096 buckets, and between the batch's paths.
        assert found.count() == len(read[-1])
        assert insert_ignore(batch, spec, root, ("n",)).inserted == 0
    assert read[0] == read[1] == [f"/d/3/{k}" for k in range(5)]


def test_compact_keeps_rows_and_paths(spark, tmp_path):
    spec, root = TABLES["lasco"], str(tmp_path)
    for k in range(3):
        append_rows(_lasco(spark, range(2 * k, 2 * k + 2)), spec, root)
    assert len(versions.latest(spark, table_path(root, "lasco")).parts) == 6
    assert compact(spark, spec, root, most=2) == 2
    assert len(versions.latest(spark, table_path(root, "lasco")).parts) == 2
    assert sorted(r["file_path"] for r in read_table(spark, root, spec).collect()) == [f"/a/{k}" for k in range(6)]
    again = _lasco(spark, range(7), hour=99).withColumn("n", F.col("file_path"))
    assert insert_ignore(again, spec, root, ("n",)).inserted == 1
    assert compact(spark, spec, root, most=2) == 0


def test_nowcast_first_line_wins(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.txt").write_text("2024 01 01 0.0 0 0 0 1.000 1 1\n2024 01 01 0.0 0 0 0 2.000 2 1\n")
    lines = read_lines(spark, str(tmp_path / "in"))
    root = str(tmp_path / "db")
    assert ingest_nowcast(lines, HP30, root).inserted == 1
    assert ingest_nowcast(lines, HP30, root).inserted == 0
    assert read_table(spark, root, TABLES["hpo_hp30"]).first()["hp30"] == 1.0


def test_register_sdo(spark, tmp_path):
    schema = "path string, error string, telescope string, channel string, datetime timestamp_ntz, quality int, wavelength int, content string"
    rows = [
        ("/in/a.fits", None, "hmi", "m_45s", T0 + timedelta(seconds=37), 0, None, None),
        ("/in/b.fits", None, "hmi", "m_45s", T0 + timedelta(seconds=37), 0, None, None),
        ("/in/sub/a.fits", None, "hmi", "ic_45s", T0 + timedelta(seconds=37), 0, None, None),
        ("/in/c.fits", "invalid_header", None, None, None, None, None, None),
    ]
    root, bad = str(tmp_path / "db"), str(tmp_path / "bad")
    done = images.register_sdo(spark.createDataFrame(rows, schema), root, bad, archive="/arc")
    # b repeats a's key; sub/a would land on a's path.
    assert (done.inserted.offered, done.inserted.inserted, done.refused) == (3, 1, 1)
    stored = read_table(spark, root, TABLES["sdo"]).first()
    assert (stored["datetime"], stored["file_path"]) == (T0, "/arc/hmi/2024/20240101/a.fits")
    assert spark.read.parquet(bad).first()["error"] == "invalid_header"


def test_export_is_ordered(spark, tmp_path):
    grid = spark.range(2000).select((F.lit(T0) + F.make_dt_interval(mins=F.col("id").cast("int") * 30)).cast("timestamp_ntz").alias("datetime"))
    table = grid.select("datetime", *[F.lit(1.0).alias(c) for c in SW30_COLUMNS[1:]]).repartition(5)
    exports.export_parquet(table, str(tmp_path / "p"), date(2024, 1, 2), date(2024, 1, 3))
    back = spark.read.parquet(str(tmp_path / "p"))
    assert back.columns == SW30_COLUMNS
    assert back.count() == 96
    exports.export_csv(table.select("datetime", F.lit(None).cast("double").alias("x"), F.lit(True).alias("b")), str(tmp_path / "c"), ["datetime"])
    text = spark.read.text(str(tmp_path / "c")).where("value LIKE '2024-01-01 00:00:00%'").first()["value"]
    assert text == "2024-01-01 00:00:00,,t"


def test_one_failed_table_does_not_stop_the_rest(spark, tmp_path):
    root = str(tmp_path / "db")
    append_rows(_mag(spark, [(16, T0, 1.0, 1)]), MAG, root)
    outcome = exports.export_tables(spark, root, str(tmp_path / "out"), ["goes_xrs", "goes_mag", "omni_1min"])
    assert outcome["goes_mag"] is None and outcome["goes_xrs"] and outcome["omni_1min"]


def test_manifest_documents(spark, tmp_path):
    from sunloom.sources.files import read_manifest

    rows = [("a", "193", f"u{i}", f"f{i}") for i in range(95)] + [("a", "211", None, None), ("b", "193", None, None)]
    files = spark.createDataFrame(rows, "telescope string, channel string, url string, filename string")
    files = files.select(F.lit("2024-01-01T00:00:00").alias("query_time"), F.lit("2024-01-01T00:00:00").alias("target_time"),
                         F.lit(6).alias("time_range"), *files.columns)
    documents = exports.manifest_documents(files)
    assert documents.where("telescope = 'b'").count() == 0
    assert sorted(next(iter(r['channels'])) for r in documents.collect()) == ['193', '211']
    exports.write_manifests(documents, str(tmp_path / "m"))
    back = read_manifest(spark, str(tmp_path / "m"), one_per_file=False)
    assert sorted(r["filename"] for r in back.collect()) == sorted(r[3] for r in rows if r[3])


def test_duplicate_keys_are_refused(spark, tmp_path):
    root = str(tmp_path)
    twice = _mag(spark, [(16, T0, 1.0, 2), (16, T0, 2.0, 1), (17, T0, 3.0, 3)])
    refused = replace_years(twice, MAG, root, order=("n",))
    assert [(r["bx_nt"], r["error"]) for r in refused.collect()] == [(1.0, "duplicate_key")]
    refused = append_rows(_mag(spark, [(16, T0, 9.0, 1), (18, T0, 4.0, 2)]), MAG, root)
    assert [(r["bx_nt"], r["error"]) for r in refused.collect()] == [(9.0, "duplicate_key")]
    assert sorted(r["bx_nt"] for r in read_table(spark, root, MAG).collect()) == [2.0, 3.0, 4.0]


def test_a_chain_of_barred_rows(spark):
    from sunloom.operators.inserts import accept_in_order

    # Each row shares the key or the path of the one before: every second one gets in.
    rows = [(f"k{(n + 1) // 2}", f"p{n // 2}", n, datetime(2999, 1, 1)) for n in range(12)]
    batch = spark.createDataFrame(rows, "k string, file_path string, n long, t timestamp_ntz")
    taken = accept_in_order(batch, ("k", "t"), "file_path", "n")
    assert sorted(r["n"] for r in taken.collect()) == [0, 2, 4, 6, 8, 10]


def test_a_long_chain_takes_few_steps(spark, monkeypatch):
    from sunloom.operators import inserts

    made = []
    monkeypatch.setattr(inserts, "materialise", lambda df, name, _of=inserts.materialise: made.append(name) or _of(df, name))
    batch = spark.range(10_000).selectExpr("(id + 1) div 2 AS k", "id div 2 AS file_path", "id AS n")
    taken = inserts.accept_in_order(batch, ("k",), "file_path", "n")
    assert {r["n"] for r in taken.collect()} == set(range(0, 10_000, 2)) and len(made) < 15


@pytest.mark.parametrize("seed", range(4))
def test_any_batch_is_taken_row_by_row(spark, seed):
    import random

    from sunloom.operators.inserts import accept_in_order

    rng = random.Random(seed)
    spread = (3, 12, 30, 80)[seed]
    rows = [(rng.choice([None, *range(spread)]), rng.randrange(spread), n) for n in rng.sample(range(1000), 60)]
    keys, paths, expected = set(), set(), []
    for k, path, n in sorted(rows, key=lambda r: r[2]):
        if k not in keys and path not in paths:
            keys.add(k), paths.add(path), expected.append(n)
    batch = spark.createDataFrame(rows, "k int, file_path int, n long")
    assert sorted(r["n"] for r in accept_in_order(batch, ("k",), "file_path", "n").collect()) == expected


def test_quarantine_may_be_replayed(spark, tmp_path):
    from sunloom.sinks.tables import quarantine

    rows = spark.createDataFrame([("a", "invalid_file"), ("b", None), ("c", "invalid_time")], "path string, error string")
    for _ in range(2):
        quarantine(rows.unionByName(rows), str(tmp_path / "bad"))
    assert sorted(r["path"] for r in spark.read.parquet(str(tmp_path / "bad")).collect()) == ["a", "c"]


def test_ledger_of_file_fates(spark, tmp_path):
    from datetime import datetime

    from sunloom.plans.images import register_logged
    from sunloom.sinks.ledger import fate_counts, file_fates, fold_runs, next_run, quarantined
    from sunloom.tables import TABLES, read_table

    kinds = "path string, error string, camera string, datetime timestamp_ntz, file_path string, exposure_time double, filter string"
    one, two = datetime(2024, 1, 1), datetime(2024, 1, 2)
    root, ledger = str(tmp_path / "db"), str(tmp_path / "ledger")
    held = spark.createDataFrame([("/kept/taken",)], "path string")

    def run(*rows, number=None):
        found = spark.createDataFrame([(*r, None, None) for r in rows], kinds)
        return register_logged(found, found.where("error IS NULL"), TABLES["lasco"], root, ledger, held, number)

    def fates():
        return {r["path"]: (r["state"], r["error"]) for r in file_fates(spark, ledger).collect()}

    assert next_run(spark, ledger) == 0 and fates() == {}
    first = [
        ("a", None, "c2", one, "/kept/a"), ("b", None, "c2", one, "/kept/b"), ("c", "invalid_time", None, None, None),
        ("d", None, None, one, "/kept/d"), ("e", None, "c3", one, "/kept/taken"), ("a", None, "c2", one, "/kept/a"),
    ]
    told = {"a": ("registered", None), "b": ("known_key", None), "c": ("refused", "invalid_time"),
            "d": ("refused", "missing_key"), "e": ("held", None)}
    assert run(*first) == 0 and fates() == told
    # Told again, as after a run cut short, it is the same run with the same fates.
    assert run(*first, number=0) == 0 and fates() == told
    assert sum(r["n"] for r in fate_counts(spark, ledger, 0).collect()) == 5
    # c turns valid; another file for the place of a does not take it over.
    assert run(("c", None, "c2", two, "/kept/c"), ("0a", None, "c2", one, "/kept/a"), ("a", None, "c2", one, "/kept/a")) == 1
    now = {**told, "c": ("registered", None), "0a": ("known_key", None)}
    assert fates() == now and [r["path"] for r in quarantined(spark, ledger).collect()] == ["d"]
    assert fold_runs(spark, ledger) == 2 and fold_runs(spark, ledger) == 0 and fates() == now
    with pytest.raises(ValueError):
        run(*first, number=1)
    assert next_run(spark, ledger) == 2
    assert run() == 2 and fates() == now
    assert read_table(spark, root, TABLES["lasco"]).count() == 2


def test_a_long_chain_moves_few_rows(spark, monkeypatch):
    from sunloom.operators import inserts

    moved, kept = [], inserts.materialise

    def counted(df, name):
        made = kept(df, name)
        moved.extend([made.count()] if name == "chains" else [])
        return made

    monkeypatch.setattr(inserts, "materialise", counted)
    monkeypatch.setattr(inserts, "DOUBLED_ROWS", 100, raising=False)
    # One chain of 4,000 rows and many of up to 7, in ids without their order.
    rows = spark.range(4000).selectExpr("id", "concat('k', (id + 1) div 2) AS k", "concat('p', id div 2) AS p")
    short = spark.range(4000).selectExpr(
        "id + 4000 AS id",
        "concat('s', id div 7, 'k', (id % 7 + 1) div 2) AS k",
        "concat('s', id div 7, 'p', id % 7 div 2) AS p",
    )
    taken = inserts.accept_in_order(rows.unionByName(short), ("k",), "p", "id")
    expected = set(range(0, 4000, 2)) | {4000 + i for i in range(4000) if i % 7 % 2 == 0}
    assert {r.id for r in taken.select("id").collect()} == expected
    assert sum(moved) < 5 * 8000
