"""Windows, stacks, warps, masks, cubes and writers on small cases."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from lumenspan.operators import catalog, geometry, radiometry, raster, spectral
from lumenspan.plans import further
from lumenspan.sources import cube, documents, envi


@pytest.mark.parametrize("interleave", ["bip", "bil", "bsq"])
def test_envi_round_trip(spark, tmp_path, interleave):
    cells = np.random.default_rng(2).random((5, 4, 3)).round(3)
    df = spark.createDataFrame([(r, c, cells[r, c].tolist()) for r in range(5) for c in range(4) if (r, c) != (2, 1)], "row int, col int, spectrum array<double>")
    envi.write_envi(df, str(tmp_path / "x.img"), height=6, width=4, interleave=interleave)
    spark.dataSource.register(envi.EnviSource)
    got = {(r.row, r.col): r.spectrum for r in spark.read.format("envi").load(str(tmp_path / "x.img")).collect()}
    assert len(got) == 24 and got[2, 1] == got[5, 3] == [-9999.0] * 3
    assert all(np.allclose(got[r, c], cells[r, c], atol=1e-6) for r in range(5) for c in range(4) if (r, c) != (2, 1))
    with pytest.raises(ValueError):
        envi.write_envi(df, str(tmp_path / "y.img"), height=6, width=4, interleave="bqs")


@pytest.mark.parametrize("interleave", ["bip", "bil", "bsq"])
def test_envi_mask(spark, tmp_path, interleave):
    """Pixels that only fill the raster are told from pixels without data."""
    rows = [(0, 1, [1.0, 2.0]), (2, 0, [-9999.0, -9999.0]), (2, 1, [0.0, 0.0])]
    path = str(tmp_path / "x.img")
    envi.write_envi(spark.createDataFrame(rows, "row int, col int, spectrum array<double>"), path, height=4, width=3, interleave=interleave, mask=True)
    spark.dataSource.register(envi.EnviSource)
    assert sorted(map(tuple, spark.read.format("envi").option("mask", True).load(path).collect())) == rows
    assert spark.read.format("envi").load(path).count() == 12


def test_scan_envi_of_a_part_of_a_line(spark, tmp_path):
    """A table whose last line ends early."""
    spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet").where("vec_id < 56").write.parquet(str(tmp_path / "embeddings.parquet"))
    got = further.scan_envi(spark, str(tmp_path)).groupBy("row", "col").count().collect()
    assert sorted((r.row, r.col, r["count"]) for r in got) == [(i // 25, i % 25, 64) for i in range(56)]


def test_warp_against_a_plain_one(spark):
    rng = np.random.default_rng(3)
    src = rng.random((40, 50))
    src[10:13, 20:24] = -9999
    west, d, north = -117.05, 0.0007, 36.02
    df = spark.createDataFrame([(r, c, float(src[r, c])) for r in range(40) for c in range(50)], "row int, col int, v double")
    x0, y0 = geometry.to_utm(np.array([west + 0.004]), np.array([north - 0.004]), 11)
    extent = (float(x0[0]), float(y0[0]) - 1500, float(x0[0]) + 2400, float(y0[0]))
    got = {(r.row, r.col): r.v for r in raster.warp(df, transform=(west, d, north, d), zone=11, south=False, extent=extent, size=(25, 40)).collect()}
    kernel = np.vectorize(raster._cubic)
    assert len(got) == 1000
    for (r, c), v in got.items():
        lon, lat = geometry.from_utm(extent[0] + (c + 0.5) * 60, extent[3] - (r + 0.5) * 60, 11)
        x, y = (lon - west) / d - 0.5, (north - lat) / d - 0.5
        rows, cols = int(np.floor(y)) + np.arange(-1, 3), int(np.floor(x)) + np.arange(-1, 3)
        w = kernel(np.abs(y - rows))[:, None] * kernel(np.abs(x - cols))[None]
        ok = (rows[:, None] >= 0) & (rows[:, None] < 40) & (cols >= 0) & (cols < 50)
        part = src[np.clip(rows, 0, 39)][:, np.clip(cols, 0, 49)]
        w = np.where(ok & (part != -9999), w, 0)
        want = (w * part).sum() / w.sum() if w.sum() >= 0.5 else -9999.0
        assert abs(v - want) < 1e-6


def test_summary_in_degrees(spark):
    r = geometry.wgs84_summary(spark.createDataFrame([(32611, 480000.0, 3980000.0, 540000.0, 4030000.0), (32733, 480000.0, 6000000.0, 481000.0, 6001000.0)], "epsg int, l double, b double, r double, t double")).collect()
    lon, lat = geometry.from_utm(np.array([480000.0, 500000.0, 540000.0]), np.array([3980000.0, 4030000.0, 4030000.0]), 11)
    assert abs(r[0].west - min(lon)) < 1e-2 and r[0].south <= lat[0] and abs(r[0].north - max(lat)) < 1e-4 and abs(r[0].lon - (r[0].west + r[0].east) / 2) < 1e-9
    assert r[1].north < 0 and 14 < r[1].lon < 16


def test_stacks_need_their_bands(spark):
    sizes = {b: 10.0 if b in raster.TEN_METRES else 20.0 for b in raster.STACK}
    assert len(raster.stack_order(sizes)) == 10
    assert "B8A" not in raster.stack_order(sizes | {"B8A": 10.0}) and len(raster.stack_order({k: v for k, v in sizes.items() if k != "B8A"})) == 9
    with pytest.raises(ValueError, match="B11"):
        raster.stack_order({k: v for k, v in sizes.items() if k != "B11"})
    assert raster.whole_ratio(60.3, 10) == 6
    with pytest.raises(ValueError):
        raster.whole_ratio(25, 10)


def test_clip_rings_must_be_convex(spark):
    ring = lambda pts: [{"lon": float(x), "lat": float(y)} for x, y in pts]
    box, notch = ring([(0, 0), (2, 0), (2, 2), (0, 2), (0, 0)]), ring([(0, 0), (2, 0), (1, 0.5), (0, 2), (0, 0)])
    kind = "a array<struct<lon:double,lat:double>>, b array<struct<lon:double,lat:double>>"
    ok = spark.createDataFrame([(notch, box), (box, box[:2]), (None, box)], kind)
    shares = [r.overlap for r in geometry.polygon_overlap(ok, "a", "b").collect()]
    assert abs(shares[0] - 1) < 1e-6 and shares[1:] == [0.0, 0.0]
    with pytest.raises(Exception, match="convex"):
        geometry.polygon_overlap(spark.createDataFrame([(box, notch)], kind), "a", "b").collect()


def test_scenes_without_data_count_as_cloudy(spark):
    kind = "item long, code int, assets map<string,string>"
    scl = spark.createDataFrame([(1, 0, {"SCL": "x"}), (1, 0, {"SCL": "x"}), (2, 11, {"scl": "x"}), (2, 4, {"scl": "x"}), (3, 4, {"scl-jp2": "x"}), (4, 4, {"visual": "x"})], kind)
    assert {r.item: r.cloud_fraction for r in catalog.scene_clouds(scl).collect()} == {1: 1.0, 2: 0.5}
    kind = "id long, ts timestamp_ntz, lon double, lat double, cloud double"
    import datetime

    at = datetime.datetime(2024, 1, 1, 12)
    granules = spark.createDataFrame([(9, at, 179.5, 0.0, 1.0)], kind)
    items = spark.createDataFrame([(1, at, 179.5, 0.0, 0.0), (2, at, 179.5, 0.0, 0.0), (5, at, -179.9, 0.4, 0.0), (6, at, 0.0, 0.0, 0.0)], kind)
    r = catalog.best_pair(granules, items, catalog.scene_clouds(scl), near=1.0).first()
    assert (r.item_id, r.cloud_fraction, r.reason) == (2, 0.5, "ok")
    pairs = {r.b.id for r in catalog.in_day_window(granules, items, 1, 1.0).collect()}
    assert pairs == {1, 2, 5}  # across the date line, and not half the globe away


def test_missing_variables_are_errors(spark):
    df = spark.createDataFrame([([1.0, -9999.0],)], "RFL array<double>")
    assert cube.open_reflectance(df).first().spectrum == [1.0, None]
    with pytest.raises(KeyError, match="radiance"):
        cube.open_reflectance(df.withColumnRenamed("RFL", "x"))
    with pytest.raises(KeyError):
        cube.assemble(df, (("a", "b"),))
    with pytest.raises(KeyError):
        spectral.load_srf(df, "SR_WL", {"B2": "x"})
    assert spectral.pick_sheet(["a", "Spectral Responses (S2A)"], "S2A") == "Spectral Responses (S2A)"
    with pytest.raises(ValueError):
        spectral.pick_sheet(["a"], "S2A")


def test_wavelength_tags_keep_empty_slots(spark):
    df = spark.createDataFrame([("r", {"Band_1": "381.0 nm", "Band_4": "x 400", "Band_3": "none", "other": "7"}), ("s", {"other": "1"})], "raster_id string, tags map<string,string>")
    got = {(r.raster_id, r.band): r.wl for r in spectral.wavelengths_from_tags(df).collect()}
    assert got == {("r", 1): 381.0, ("r", 2): None, ("r", 3): None, ("r", 4): 400.0}


def test_percentiles_by_ranks(spark):
    rng = np.random.default_rng(4)
    values = {"a": rng.normal(size=500).round(1), "b": np.full(30, 2.5), "c": rng.random(7), "d": np.array([1e9, *rng.random(300)])}
    df = spark.createDataFrame([(k, float(x)) for k, v in values.items() for x in v] + [("a", None), ("a", float("nan")), ("e", None)], "channel string, v double").repartition(3)
    shares = {"p0": 0.0, "p2": 0.02, "p37": 0.37, "p98": 0.98, "p100": 1.0}
    for buffered in (0, 10**6):
        got = {r.channel: [r[k] for k in shares] for r in radiometry.percentiles(df, ["channel"], shares, buffered=buffered).collect()}
        for k, v in values.items():
            assert np.allclose(got[k], np.percentile(v, [100 * p for p in shares.values()]), rtol=1e-12), (k, buffered)
        whole = radiometry.percentiles(df, [], {"m": 0.5}, buffered=buffered).first().m
        assert abs(whole - np.median(np.concatenate(list(values.values())))) < 1e-12
    ranks = {(r.channel, r.v): (r.n, r.before) for r in radiometry.ranked(df, ["channel"]).collect()}
    assert all(ranks[k, x] == ((v == x).sum(), (v < x).sum()) for k, v in values.items() for x in v.tolist())


def test_report(tmp_path):
    p = tmp_path / "r.md"
    documents.report(str(p), "T", [("A", ["x", None, "y"])])
    documents.report(str(p), "T", [("B", [None])], append=True)
    assert p.read_text() == "# T\n\n## A\n- x\n- y\n\n## B\n"


def test_masks(spark):
    nan = float("nan")
    df = spark.createDataFrame([([-9999.05, -9999.0],), ([1e-7, 0.0],), ([0.0, nan],), ([0.2, 0.1],), ([None, -9999.0],)], "s array<double>")
    s = F.col("s")
    got = [tuple(r) for r in df.select(raster.is_invalid(s), raster.valid_rgb(s), raster.valid_rgb(s, every=False)).collect()]
    assert [bool(x[0]) for x in got] == [True, True, False, False, False]
    assert [bool(x[1]) for x in got] == [False, True, False, True, False]
    assert [bool(x[2]) for x in got] == [False, True, False, True, False]
