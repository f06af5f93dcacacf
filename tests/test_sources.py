from __future__ import annotations

import json
import math
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from sunloom.functions.nested import integral_flux
from sunloom.functions.numbers import to_number
from sunloom.plans import images
from sunloom.sources.fixed_width import LINE_ORDER, parse_fixed_width, read_lines
from sunloom.sources.files import list_files, read_manifest
from sunloom.sources.goes import DECODED_FILE, normaliser
from sunloom.sources.headers import cut_units, fetch_headers, header_units
from sunloom.sources.hpo import HP30, merge_index_documents, parse_index_text, read_index_json
from sunloom.sources.layouts import FIVE_MINUTE, HOURLY, MINUTE


def test_layout_shapes():
    assert [(len(x.fields), x.length) for x in (HOURLY, MINUTE, FIVE_MINUTE)] == [(55, 327), (46, 299), (49, 326)]
    fills = {f.name: f.fill for f in HOURLY.fields}
    assert fills["Flag"] is None and fills["Hour"] is None
    assert fills["Proton_Temperature_K"] == 9999999.0 and fills["Na_Np_Ratio"] == 9.999
    minute = {f.name: f.fill for f in MINUTE.fields}
    assert minute["Flow_Speed_km_s"] == 99999.9 and minute["RMS_Timeshift"] == 999999


def _minute_line(**given):
    parts = []
    for f in MINUTE.fields:
        default = {"Year": "2024", "Day": "60", "Hour": "1", "Minute": "30"}.get(f.name, "1")
        parts.append(str(given.get(f.name, default)).rjust(f.width))
    return "".join(parts)


def test_fixed_width_fields(spark):
    lines = [
        _minute_line(Flow_Speed_km_s="99999.9", Bx_GSE_nT="12.5f", By_GSE_nT="*****", Bz_GSE_nT="NaN"),
        _minute_line(Flow_Speed_km_s="9999.99", Bx_GSE_nT="-1.", By_GSE_nT=".5", Bz_GSE_nT="1e2"),
        _minute_line()[: MINUTE.fields[10].start],
        "   ",
    ]
    rows = parse_fixed_width(spark.createDataFrame([(x,) for x in lines], "value string"), MINUTE).collect()
    assert len(rows) == 3
    assert rows[0]["datetime"] == datetime(2024, 2, 29, 1, 30)
    assert rows[0]["Flow_Speed_km_s"] is None and rows[1]["Flow_Speed_km_s"] == 9999.99
    assert [rows[0][c] for c in ("Bx_GSE_nT", "By_GSE_nT", "Bz_GSE_nT")] == [None, None, None]
    assert [rows[1][c] for c in ("Bx_GSE_nT", "By_GSE_nT", "Bz_GSE_nT")] == [-1.0, 0.5, 100.0]
    assert rows[2]["Percent_Interp"] == 1.0 and rows[2]["RMS_Timeshift"] is None


@pytest.mark.parametrize("text, value", [("0x1p3", None), ("1_0", None), ("+1", 1.0), ("-", None), ("5.e-1", 0.5), ("", None)])
def test_to_number(spark, text, value):
    assert spark.range(1).select(to_number(F.lit(text)).alias("x")).first()["x"] == value


def test_filter_does_not_repeat_the_parse(spark):
    lines = spark.createDataFrame([("x",)], "value string")
    kept = parse_fixed_width(lines, MINUTE).where("datetime IS NOT NULL AND Bx_GSE_nT > 0")
    plan = kept._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_replace") == 1


def test_index_text(spark, tmp_path):
    path = tmp_path / "nowcast.txt"
    path.write_text(
        "# header\n2024 01 01 23.5 23.75 1 1  2.333  9 1 # trailing\n\n 2024 01 02 00.0 0.25 1 1 -1.000 -1 1\n2024 01 03 0\n"
    )
    lines = read_lines(spark, str(path))
    rows = parse_index_text(lines, HP30, keep=LINE_ORDER).orderBy(*LINE_ORDER).collect()
    assert [r["datetime"] for r in rows] == [datetime(2024, 1, 1, 23, 30), datetime(2024, 1, 2), datetime(2024, 1, 3)]
    assert (rows[0]["Hp30"], rows[0]["ap30"]) == (2.333, 9.0)
    assert [rows[i][c] for i in (1, 2) for c in ("Hp30", "ap30")] == [None] * 4


def test_index_json_outer(spark, tmp_path):
    (tmp_path / "hp.json").write_text(
        json.dumps({"meta": 1, "datetime": ["2024-01-01T00:00:00Z", "2024-01-01T00:30:00Z"], "Hp30": [1.333, -1]}, indent=1)
    )
    (tmp_path / "ap.json").write_text(
        json.dumps({"datetime": ["2024-01-01T00:30:00Z", "2024-01-01T01:00:00Z"], "ap30": [5, 6]}, indent=1)
    )
    merged = merge_index_documents(
        read_index_json(spark, str(tmp_path / "hp.json"), "Hp30"), read_index_json(spark, str(tmp_path / "ap.json"), "ap30"), HP30
    )
    rows = merged.orderBy("datetime").collect()
    assert [(r["hh_start"], r["Hp30"], r["ap30"]) for r in rows] == [(0.0, 1.333, None), (0.5, None, 5.0), (1.0, None, 6.0)]


def test_manifest_defaults(spark, tmp_path):
    files = [{"url": "http://a/1", "filename": "1"}]
    (tmp_path / "m.json").write_text(
        json.dumps(
            {
                "query_time": "2024-01-01T10:00:00.123456",
                "target_time": "2024-01-01T00:00:00",
                "channels": {"193": {"files": files}, "211": {"files": []}},
            },
            indent=2,
        )
    )
    (row,) = read_manifest(spark, str(tmp_path)).collect()
    assert (row["time_range"], row["telescope"], row["channel"], row["filename"]) == (6, "aia", "193", "1")
    assert read_manifest(spark, str(tmp_path), channels=["211"]).count() == 0


def _card(key, value):
    return f"{key:<8}= {value}".ljust(80)


def _header(*cards):
    text = "".join(cards) + "END".ljust(80)
    return text.ljust(-(-len(text) // 2880) * 2880).encode("ascii")


def _image(t_rec="'2024.01.01_00:00:37_TAI'"):
    first = _header(_card("SIMPLE", "T"), _card("BITPIX", "16"), _card("NAXIS", "2"), _card("NAXIS1", "100"), _card("NAXIS2", "30"))
    pixels = b"\x01" * 6000
    pixels += b"\0" * (-len(pixels) % 2880)
    second = _header(
        _card("XTENSION", "'BINTABLE'"),
        "COMMENT = not a value".ljust(80),
        _card("T_REC", t_rec + " / record"),
        _card("QUALITY", "0 / none"),
        _card("TELESCOP", "'SDO/HMI '"),
        _card("CONTENT", "'It''s a / MAGNETOGRAM'"),
        _card("QUALITY", "7"),
        *[_card(f"K{i}", str(i)) for i in range(60)],
    )
    return first + pixels + second + b"\x02" * 5000


def test_headers_of_files(spark, tmp_path):
    (tmp_path / "sub").mkdir()
    (tmp_path / "sub" / "a.fits").write_bytes(_image())
    (tmp_path / "b.fits").write_bytes(b"nothing")
    (tmp_path / "c_Spike.fits").write_bytes(_image())
    (tmp_path / "d.txt").write_text("x")
    listing = list_files(spark, str(tmp_path), "*.fits")
    assert sorted(r["name"] for r in listing.collect()) == ["a.fits", "b.fits", "c_Spike.fits"]
    by_range = images.classify_sdo(header_units(fetch_headers(listing)))
    contents = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.fits")
    whole = images.classify_sdo(header_units(cut_units(contents.load(str(tmp_path)).select("path", "content"))))
    for found in (by_range, whole):
        rows = {r["path"].rsplit("/", 1)[-1]: r for r in found.collect()}
        assert rows["b.fits"]["error"] == "invalid_file"
        good = rows["a.fits"]
        assert (good["error"], good["telescope"], good["channel"], good["quality"]) == (None, "hmi", "m_45s", 0)
        assert good["content"] == "It's a / MAGNETOGRAM" and good["datetime"] == datetime(2024, 1, 1, 0, 0, 37)


def _camera_row(spark, *cards, path="x/22000146.fts"):
    raw = spark.createDataFrame([(path, bytearray(_header(_card("SIMPLE", "T"), *cards)))], "path string, content binary")
    return header_units(cut_units(raw))


def test_camera_header_rules(spark):
    units = _camera_row(
        spark, _card("DATE-OBS", "'08/12/95'"), _card("TIME-OBS", "'01:02:03'"), _card("EXPTIME", "0.0"), _card("WAVELNTH", "0"),
        _card("DETECTOR", "'EUVI'"), _card("FILTER", "''"), _card("FILTER1", "'S2'"),
    )
    row = images.secchi_records(units, F.lit("science"), F.lit("ahead"), instrument="cor2").first()
    assert (row["datetime"], row["exposure_time"], row["wavelength"], row["channel"]) == (datetime(1995, 12, 8, 1, 2, 3), None, None, None)
    assert (row["instrument"], row["filter"]) == ("cor2", "S2")
    assert images.lasco_records(units, camera="c3").first()["camera"] == "c3"


def test_observation_time_from_name(spark):
    units = _camera_row(spark, path="hmi.m_45s.20100901_000000_TAI.2.magnetogram.fits")
    assert images.lasco_records(units).first()["datetime"] == datetime(2010, 9, 1)
    nameless = images.lasco_records(_camera_row(spark)).first()
    assert (nameless["datetime"], nameless["error"]) == (None, "invalid_time")


@pytest.mark.parametrize(
    "flux, mev, expected",
    [([1.0, 1.0], 3, 7000.0), ([1.0, 1.0], 10, None), ([None, 2.0], 3, 10000.0), ([None, None], 3, None)],
)
def test_integral_flux(spark, flux, mev, expected):
    row = spark.createDataFrame([(flux, [1000.0, 5000.0], [5000.0, 10000.0])], "f array<double>, l array<double>, u array<double>")
    assert row.select(integral_flux(F.col("f"), F.col("l"), F.col("u"), mev).alias("x")).first()["x"] == expected


def test_integral_flux_with_missing_bound(spark):
    row = spark.createDataFrame([([1.0, 1.0], [1000.0, None], [1500.0, 10000.0])], "f array<double>, l array<double>, u array<double>")
    assert row.select(integral_flux(F.col("f"), F.col("l"), F.col("u"), 3).alias("x")).first()["x"] == 0.0


def test_nan_is_missing_and_unknown_instrument(spark):
    times = {"time": [datetime(2024, 1, 1), datetime(2024, 1, 1, 0, 1)]}
    files = spark.createDataFrame(
        [("a", 16, times, {"xrsa_flux": ([2], [math.nan, 1.0]), "b_flux": ([], [3.0])}, {})], DECODED_FILE
    )
    rows = normaliser("xrs")(files).orderBy("step").collect()
    assert [(r["xrs_a_flux_w_m2"], r["xrs_b_flux_w_m2"], r["is_goes_r"]) for r in rows] == [(None, None, True), (1.0, None, True)]
    with pytest.raises(ValueError):
        normaliser("euv")


def test_header_fetching_faults(spark, tmp_path):
    import time

    import pytest

    (tmp_path / "big.fits").write_bytes(b"x" * (64 << 20))
    (tmp_path / "text.fits").write_bytes((b"SIMPLE  =" + b" " * 71) * 400 + b"\xff" * (8 << 20))
    head = _header(_card("SIMPLE", "T"), _card("NAXIS", "0"))
    (tmp_path / "cut.fits").write_bytes(head[:200])
    paths = [f"file:{tmp_path}/{n}.fits" for n in ("big", "text", "cut", "gone")]
    began = time.perf_counter()
    found = header_units(fetch_headers(spark.createDataFrame([(p,) for p in paths], "path string"))).collect()
    assert [r["unit0"] for r in found] == [None] * 4 and time.perf_counter() - began < 15
    odd = spark.createDataFrame([("nosuchstore://bucket/a.fits",)], "path string")
    with pytest.raises(Exception, match="nosuchstore"):
        fetch_headers(odd).collect()


def _source_folder(tmp_path):
    (tmp_path / "sub dir%").mkdir()
    (tmp_path / "sub dir%" / "a.fits").write_bytes(_image())
    (tmp_path / "b.fits").write_bytes(b"nothing")
    (tmp_path / "empty.fits").write_bytes(b"")
    (tmp_path / "note.txt").write_bytes(_image())
    return str(tmp_path)


def test_image_source_equals_plain_fetch(spark, tmp_path):
    from sunloom.sources.image_source import folder_headers, listed_headers

    root = _source_folder(tmp_path)
    listing = list_files(spark, root, "*.fits")
    plain = header_units(fetch_headers(listing))

    def classes(units):
        return sorted((r["path"].rsplit("/", 1)[-1], *r[1:]) for r in images.classify_sdo(units).collect())

    expected = classes(plain)
    # Spark's own listing leaves out files without a byte.
    assert [r[:2] for r in expected] == [("a.fits", None), ("b.fits", "invalid_file")]
    assert classes(listed_headers(listing)) == expected
    assert classes(listed_headers(listing, images.SDO_KEYWORDS, per_task=1)) == expected
    below = classes(folder_headers(spark, f"file:{root}", "*.fits", images.SDO_KEYWORDS))
    assert below[:2] == expected and [r[:2] for r in below[2:]] == [("empty.fits", "invalid_file")]
    assert listed_headers(listing.where("false")).count() == 0


def test_image_source_prunes(spark, tmp_path):
    from sunloom.sources.image_source import ImageHeaders, header_reader, pruned_cards

    root = _source_folder(tmp_path)
    first = header_reader(spark, second=False).option("pathGlobFilter", "a.fits").load(root)
    assert first.columns == ["path", "head0"] and first.first()["head0"][:9] == b"SIMPLE  ="
    kept = header_reader(spark, ["NAXIS1"]).option("pathGlobFilter", "a.fits").load(root).first()
    assert [bytes(kept["head0"][i : i + 8]).rstrip() for i in range(0, len(kept["head0"]), 80)] == [b"SIMPLE", b"NAXIS1", b"END"]
    assert pruned_cards(None, frozenset([b"A"])) is None
    # One task for each share of files, by folder and by listing.
    listing = tmp_path / "listing"
    list_files(spark, root, "*.fits").select("path").coalesce(1).write.option("maxRecordsPerFile", 1).parquet(str(listing))
    from pyspark.sql.types import StructType, StringType

    reader = ImageHeaders({"listing": str(listing)}).reader(StructType().add("path", StringType()))
    assert len(reader.partitions()) == 2
    reader = ImageHeaders({"path": root, "pathGlobFilter": "*.fits", "filesPerTask": "2"}).reader(StructType().add("path", StringType()))
    assert [len(p.paths) for p in reader.partitions()] == [2, 1]
    with pytest.raises(ValueError):
        ImageHeaders({"path": root}).reader(StructType().add("pixels", StringType()))


def test_a_crowded_listing_takes_few_parts(spark, tmp_path):
    from sunloom.session import scratch_path
    from sunloom.sources import image_source

    made = []

    def noted(session, name):
        made.append(scratch_path(session, name))
        return made[-1]

    root = _source_folder(tmp_path)
    listing = list_files(spark, root, "*.fits").repartition(200)
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(image_source, "scratch_path", noted)
        assert image_source.listed_headers(listing).count() == 2
    from sunloom.versions import _names

    parts = [n for n in _names(spark, made[0]) if n.startswith("part-")]
    assert len(parts) <= 8 * spark.sparkContext.defaultParallelism


def test_files_go_through_the_store_some_at_a_time(spark):
    from sunloom.queries import registered

    files = spark.range(25).selectExpr("concat('/in/', id, '.fits') AS path", "CAST('nothing' AS binary) AS content")
    seen = []

    def records(folder):
        listing = list_files(spark, folder, "*.fits").select("name", "length")
        seen.append((folder, listing.count()))
        return listing

    found = registered._through_store(spark, files.coalesce(1), records, "found", at_once=10, per_part=5)
    assert sorted(r["name"] for r in found.collect()) == sorted(f"{i}.fits" for i in range(25))
    assert [n for _, n in seen] == [10, 10, 5] and found.where("length <> 7").isEmpty()
    # What was read is gone, and no files at all are no records.
    from sunloom.tables import table_exists

    assert not any(table_exists(spark, folder) for folder, _ in seen)
    assert registered._through_store(spark, files.where("false"), records, "found").isEmpty()


def test_costly_rows_are_shared_by_number(spark):
    from sunloom.queries.inputs import ROWS_PER_TASK, spread

    # All rows in one of many splits, as with one large row group.
    clumped = spark.range(0, 10 * ROWS_PER_TASK, 1, 1).union(spark.range(0, 0, 1, 15))
    sizes = spread(clumped).rdd.glom().map(len).collect()
    assert sum(sizes) == 10 * ROWS_PER_TASK and max(sizes) <= 1.2 * ROWS_PER_TASK


def test_cut_units_leave_what_follows_the_header(spark):
    cards = ["SIMPLE  =                    T", "NAXIS   =                    1", "NAXIS1  =                    5", "BITPIX  =   16", "END"]
    whole = "".join(c.ljust(80) for c in cards).ljust(2880).encode() + bytes(2880) + b"XTENSION= 'IMAGE   '".ljust(80)
    bare = "".join(c.ljust(80) for c in (cards[0], cards[-1])).ljust(2880).encode()
    raw = spark.createDataFrame([("a", whole), ("b", bare), ("c", b"no image"), ("d", None)], "path string, content binary")
    cut = {r.path: (r.head0, r.head1) for r in cut_units(raw).collect()}
    assert cut["a"] == (whole[:400], whole[5760:]) and cut["b"] == (bare[:160], None)
    assert cut["c"] == cut["d"] == (None, None)


def test_index_documents_are_read_once(spark, tmp_path):
    hp, ap = ([{"datetime": [t, "odd", None], name: [1.0, 2.0, 3.0]}] for t, name in (("2024-01-01T00:00:00Z", "Hp30"), ("2024-01-01T00:30:00Z", "ap30")))
    for name, documents in (("hp", hp), ("ap", ap)):
        (tmp_path / f"{name}.json").write_text(json.dumps(documents))
    merged = merge_index_documents(
        read_index_json(spark, str(tmp_path / "hp.json"), "Hp30"), read_index_json(spark, str(tmp_path / "ap.json"), "ap30"), HP30
    )
    rows = sorted((r.datetime is None, r.Hp30 or 0, r.ap30 or 0) for r in merged.collect())
    assert rows == [(False, 0, 1), (False, 1, 0), (True, 0, 2), (True, 0, 3), (True, 2, 0), (True, 3, 0)]
    assert merged._jdf.queryExecution().optimizedPlan().toString().count("json") == 2


def test_plain_lines_are_cast_without_checks(spark):
    lines = [_minute_line(), _minute_line(Flow_Speed_km_s="-1.5", By_GSE_nT="1 2", Bz_GSE_nT="", Bx_GSE_nT="3-"), _minute_line(Bx_GSE_nT="12.5f")]
    frame = spark.createDataFrame([(x,) for x in lines], "value string")
    parsed = parse_fixed_width(frame, MINUTE)
    rows = parsed.select("Flow_Speed_km_s", "Bx_GSE_nT", "By_GSE_nT", "Bz_GSE_nT").collect()
    assert [tuple(r) for r in rows] == [(1, 1, 1, 1), (-1.5, None, None, None), (1, None, 1, 1)]
    assert "_plain" in parsed._jdf.queryExecution().analyzed().toString()


def test_a_share_of_a_shuffle_is_bounded(spark):
    from sunloom.session import apply_settings

    session = spark.newSession()
    session.conf.set("spark.sql.shuffle.partitions", "2")
    apply_settings(session)
    rows = session.range(1_000_000).selectExpr("id", "uuid() AS name").repartition("id")
    assert rows.rdd.getNumPartitions() > 2


def test_tasks_list_as_spark_does(spark, tmp_path):
    for name in ("a.fits", "b.fts", "sub dir%/c.fits", "sub dir%/deep/d.fits", "sub dir%/[e].fits", "empty.fits",
                 ".hidden.fits", "_hidden.fits", "_x=1/f.fits", "_gone/g.fits", ".gone/h.fits", "i.fits._COPYING_"):
        path = tmp_path / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_bytes(b"" if "empty" in name else name.encode())
    for root in (str(tmp_path), f"file:{tmp_path}/", f"{tmp_path}//sub dir%"):
        for pattern in ("*", "*.fits", "{a,c}.f?ts", "[a-c].*", "*.none"):
            reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
            told = reader.option("pathGlobFilter", pattern).load(root).select("path", "length", "modificationTime")
            found = list_files(spark, root, pattern)
            assert sorted(r[:3] for r in found.collect()) == sorted(map(tuple, told.collect())), (root, pattern)
    # The driver sees folders only: no file scan with its list of files.
    assert "binaryFile" not in found._jdf.queryExecution().toString()
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        list_files(spark, str(tmp_path / "nowhere"))


def test_images_take_the_places_of_those_before(spark, tmp_path):
    from sunloom.queries import registered

    def put(ids, tasks):
        files = ids.selectExpr("concat('/in/', id, '.fits') AS path", "CAST(repeat(id, CAST(id % 3 AS int) * 4000 + 1) AS binary) AS content")
        return registered.write_images(files.repartition(tasks), str(tmp_path))

    def held():
        return {p.name: p.read_bytes() for p in tmp_path.rglob("*.fits")}

    def expected(ids):
        return {f"{i}.fits": str(i).encode() * (i % 3 * 4000 + 1) for i in ids}

    def places():
        return {p.stat().st_ino for p in tmp_path.rglob("*.fits")}

    assert put(spark.range(100, 160), 3) == 60 and held() == expected(range(100, 160))
    # Writers do not share a folder.
    assert len({p.parent for p in tmp_path.rglob("*.fits")}) == 3
    before = places()
    assert put(spark.range(200, 260), 3) == 60 and held() == expected(range(200, 260))
    assert len(before & places()) == 60
    # Names that were there, fewer files and fewer tasks leave nothing behind.
    assert put(spark.range(250, 270), 2) == 20 and held() == expected(range(250, 270))
    registered.remove_folders(spark, str(tmp_path))
    assert not list(tmp_path.iterdir())


def test_paths_of_records_do_not_tell_when_files_lay_in_the_store(spark):
    from sunloom.queries import registered

    files = spark.range(40).selectExpr("concat('/in/', id + 100, '.fits') AS path", "CAST('nothing' AS binary) AS content")

    def records(folder):
        return registered._listed(spark, folder, "*.fits", images.SDO_KEYWORDS)

    found = registered._through_store(spark, files.repartition(2), records, "found", at_once=10, per_part=5, lanes=2)
    assert sorted(r["path"] for r in found.collect()) == [f"/in/{i + 100}.fits" for i in range(40)]
