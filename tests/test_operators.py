"""Hand-computed cases and guards of the imagery operators."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from lumenspan.functions import columns as fc
from lumenspan.operators import catalog, fit, geometry, radiometry, raster, spectral
from lumenspan.sources import envi


def value(spark, c):
    return spark.range(1).select(c.alias("x")).first().x


def test_scalars(spark):
    lit = F.lit
    assert value(spark, fc.circular_hours(lit(23.5), lit(0.5))) == 1.0
    ts = lit("2024-01-01 03:30:15").cast("timestamp_ntz")
    assert value(spark, fc.solar_time(ts, lit(-120.0))) == pytest.approx(19.504166, abs=1e-6)
    assert [value(spark, x) for x in fc.snap_inward(lit(10.0), lit(130.0), 0, 60)] == [60, 120]
    assert [value(spark, x) for x in fc.snap_outward(lit(10.0), lit(130.0), 0, 60)] == [0, 180]
    assert value(spark, fc.snap_half_up(lit(25.0), 0, 10)) == 30
    assert value(spark, fc.close_to(lit(-9999.10), -9999.0)) is True
    assert value(spark, fc.close_to(lit(-9999.102), -9999.0)) is False
    assert value(spark, fc.close_to(lit(None).cast("double"), 0.0)) is False
    got = [value(spark, fc.quantize_u16(lit(x).cast("float"))) for x in (0.12345, -0.5, 7.0, None, math.nan)]
    assert got == [1234, 0, 65534, 65535, 65535]
    assert value(spark, fc.horner(lit(5.0), [2, 3, 4])) == 69
    assert value(spark, fc.clip(lit(None).cast("double"), 0, 1)) is None
    assert value(spark, fc.href_suffix(lit("http://x/y/a.JP2?z=.b"))) == ".jp2"


def test_bits_bands_and_trapezoid(spark):
    assert value(spark, raster.unpack_bits(F.array(F.lit(178)), 8)) == [1, 0, 1, 1, 0, 0, 1, 0]
    assert np.dot(spectral.trapezoid_weights([0, 1, 3]), [0, 1, 0]) == 1.5
    own = fc.even_bands(285, 32)
    assert len(own) == 32 and own[0] == 0 and own[-1] == 284
    with pytest.raises(ValueError):
        fc.even_bands(3, 4)
    with pytest.raises(ValueError):
        raster.quality_mask(F.array(F.lit(1)), [5])
    with pytest.raises(ValueError):
        spectral.response_weights([1, 2], [True], {"a": np.ones(2)})
    assert spectral.box_weights([1, 2, 3], [True, False, True], 1, 2) is None
    assert spectral.response_weights([1.0, 2.0], [True, True], {"a": np.zeros(2)}) == {"a": None}


def test_empty_and_guards(spark):
    grid = spark.createDataFrame([], "row int, col int, v double")
    assert raster.downsample_average(grid, 2).count() == 0
    assert raster.upsample_bilinear(grid, 2).count() == 0
    assert raster.robust_minmax(grid).first()[:] == (0.0, 1.0)
    assert raster.sliding_tiles(grid, height=10, width=10, size=5, overlap=0.5).count() == 0
    with pytest.raises(ValueError):
        raster.crop(grid, (3, 3), (0, 1))
    with pytest.raises(ValueError):
        raster.pixel_centers(grid, (0, 1, 0.1, 0, 0, 1))


def test_black_mask_nulls(spark):
    rows = [([-9999.1, -9999.0], True), ([0.0, 1e-7], True), ([math.nan, 0.0], False), ([None, 0.0], False), ([0.1], False), ([-0.01], True)]
    df = spark.createDataFrame([(s,) for s, _ in rows], "s array<double>").select(raster.is_black(F.col("s")).alias("b"))
    assert [r.b for r in df.collect()] == [b for _, b in rows]


def test_ties_and_adjacency(spark):
    items = spark.createDataFrame([(2, "2024-01-01 01:00:00", 5.0), (1, "2024-01-01 09:00:00", 5.0), (3, "2024-01-02 01:00:00", None), (4, "2024-01-03 00:00:00", 51.0)], "id long, ts string, cloud double").withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    assert [r.id for r in catalog.best_per_date(items).collect()] == [1]
    s = spark.createDataFrame([("a", i, n) for i, n in enumerate((12, 13, 14))] + [("b", 0, 12), ("b", 1, 14), ("c", 0, 12)], "k string, pos int, scene int")
    assert {r.k: r.adjacent for r in catalog.adjacent(s, by="k").collect()} == {"a": True, "b": False, "c": True}
    assert value(spark, catalog.scene_number(F.lit("x.scene_012.nc"))) == 12


def test_asof_against_brute_force(spark):
    rng = np.random.default_rng(0)
    stamp = lambda n: [f"2024-01-01 00:{m:02d}:{s:02d}" for m, s in zip(rng.integers(0, 3, n), rng.integers(0, 60, n), strict=True)]
    make = lambda n: spark.createDataFrame([(int(i), t, int(k)) for i, (t, k) in enumerate(zip(stamp(n), rng.integers(0, 4, n), strict=True))], "id long, ts string, k long").withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    a, b = make(80).cache(), make(60).cache()
    got = {r.id: (r.other_id, r.delta_us) for r in catalog.asof_nearest(a, b, key="k").collect()}
    for x in a.collect():
        own = sorted((abs((x.ts - y.ts).total_seconds()) * 1e6, y.id) for y in b.collect() if y.k == x.k)
        assert got[x.id] == ((own[0][1], int(own[0][0])) if own else (None, None))


def test_histogram_match_against_numpy(spark):
    rng = np.random.default_rng(1)
    src, ref = rng.integers(0, 40, 300) / 40, rng.integers(5, 60, 200) / 60
    frame = lambda v: spark.createDataFrame([("c", float(x)) for x in v], "channel string, v double")
    got = {round(r.v, 9): r.s for r in radiometry.histogram_match(frame(src), frame(ref)).collect()}
    u, n = np.unique(src, return_counts=True)
    w, m = np.unique(ref, return_counts=True)
    want = np.interp(np.cumsum(n) / len(src), np.cumsum(m) / len(ref), w)
    assert np.allclose([got[round(x, 9)] for x in u], want)
    one = radiometry.histogram_match(frame(src), frame([0.5] * 4)).select("s").distinct().collect()
    assert [r.s for r in one] == [0.5]


def test_projection_round_trip():
    lon, lat = np.array([3.0, 0.5, 5.9]), np.array([45.0, -30.0, 70.0])
    x, y = geometry.to_utm(lon, lat, 31)
    assert x[0] == pytest.approx(500000) and y[0] == pytest.approx(4982950.4, abs=0.5)
    back = geometry.from_utm(x, y, 31)
    assert np.allclose(back[0], lon, atol=1e-9) and np.allclose(back[1], lat, atol=1e-9)


def test_polygon_clip_and_buffer(spark):
    square = [(0, 0), (2, 0), (2, 2), (0, 2)]
    assert geometry.shoelace(geometry.clip_convex(square, [(1, 1), (3, 1), (3, 3), (1, 3)])) == pytest.approx(1)
    p = spark.createDataFrame([(0.0, 0.0)], "lon double, lat double")
    ring = geometry.point_buffer(p, 1000.0).first().ring
    assert ring[1].lon == pytest.approx(math.degrees(1000 / geometry.A), rel=1e-5)
    assert len(ring) == 5


def test_ridge_and_linear(spark):
    rng = np.random.default_rng(2)
    x = rng.random((200, 2))
    y = 1 / (1 + np.exp(-(x @ [[1.0], [-2.0]] + 0.3)))
    df = spark.createDataFrame([(a.tolist(), b.tolist()) for a, b in zip(x, y, strict=True)] , "x array<double>, y array<double>")
    m = fit.SpectralRidge(degree=1, alpha=1e-9).fit(df)
    got = m.predict(df.unionByName(spark.createDataFrame([(None, [0.5])], df.schema))).collect()
    assert got[-1].y_hat is None or any(r.x is None and r.y_hat is None for r in got)
    assert max(abs(r.y_hat[0] - r.y[0]) for r in got if r.x is not None) < 1e-6
    few = spark.createDataFrame([(1, 1.0, 2.0), (1, 2.0, 4.0)], "band int, x double, y double")
    assert fit.linear_calibration(few).first()[:] == (1, 1.0, 0.0, 2)


def test_envi_round_trip(spark, tmp_path):
    px = spark.createDataFrame([(r, c, [float(r), float(c), r * 10.0 + c]) for r in range(4) for c in range(3)], "row int, col int, spectrum array<double>")
    path = str(tmp_path / "x.img")
    envi.write_envi(px, path, height=4, width=3, wavelengths=[400, 500, 600])
    spark.dataSource.register(envi.EnviSource)
    got = spark.read.format("envi").option("path", path).option("lines", 2).load()
    assert got.rdd.getNumPartitions() == 2
    assert sorted(map(tuple, ((r.row, r.col, tuple(r.spectrum)) for r in got.collect()))) == sorted((r.row, r.col, tuple(r.spectrum)) for r in px.collect())
    with pytest.raises(FileNotFoundError):
        envi.header_of(str(tmp_path / "none.img"))


def test_fitted_shifts_and_deshift(spark):
    rows = [(r, c, 2 if (r, c) != (1, 1) else -4, -1, 90.0 if (r, c) != (0, 1) else 10.0) for r in range(3) for c in range(3)]
    ties = spark.createDataFrame(rows, "tile_row int, tile_col int, d_row int, d_col int, reliability double")
    assert np.allclose(raster.fit_shifts(ties), [[2, 0, 0], [-1, 0, 0]])
    assert raster.fit_shifts(ties.limit(0)) is None
    assert np.allclose(raster.fit_shifts(ties.where("tile_row = 0")), [[2, 0, 0], [-1, 0, 0]])
    plane = spark.range(64).select(F.floor(F.col("id") / 8).cast("int").alias("row"), (F.col("id") % 8).cast("int").alias("col")).withColumn("v", F.col("row") * 10.0 + F.col("col"))
    # A stretch along columns: the pixel at p belongs at 1.25 p + 0.5, so the cell at q reads (q - 0.5) / 1.25.
    got = {(r.row, r.col): r.v for r in raster.deshift(plane, [[0, 0, 0], [0.5, 0, 0.25]]).collect()}
    assert got[3, 3] == pytest.approx(30 + 2.0) and got[0, 6] == pytest.approx(4.4) and len(got) == 64
    holes = plane.withColumn("v", F.when(F.col("col") == 4, -9999.0).otherwise(F.col("v")))
    kept = {(r.row, r.col): r.v for r in raster.deshift(holes, [[0, 0, 0], [0, 0, 0]]).collect()}
    assert len(kept) == 56 and kept[1, 1] == 11
