"""GeoTIFF files and metadata documents."""

import struct
import xml.etree.ElementTree as ET
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from lumenspan.plans import queries
from lumenspan.sources import documents, geotiff


@pytest.mark.parametrize("dtype", ["u1", "u2", "i2", "f4", "f8"])
def test_geotiff_round_trip(dtype):
    raster = np.random.default_rng(1).integers(0, 200, (70, 33, 3)).astype(dtype)
    content = geotiff.encode(raster, transform=(500000.0, 60.0, 4000000.0, -60.0), epsg=32611, nodata=65535, strip_rows=16)
    assert np.array_equal(geotiff.decode(content), raster)
    _, t = geotiff.tags(content)
    assert geotiff.transform_of(t) == (500000.0, 60.0, 4000000.0, -60.0)
    assert geotiff.epsg_of(t) == 32611 and geotiff.nodata_of(t) == 65535


def tiled(raster, tile, order, predictor):
    """A planar, tiled file, written plainly by the format's rules."""
    h, w, bands = raster.shape
    dtype = raster.dtype.newbyteorder(order)
    parts = []
    for b in range(bands):
        for r in range(0, h, tile):
            for c in range(0, w, tile):
                block = np.zeros((tile, tile), dtype)
                own = raster[r : r + tile, c : c + tile, b]
                block[: own.shape[0], : own.shape[1]] = own
                if predictor == 2:
                    block[:, 1:] = block[:, 1:] - block[:, :-1]
                parts.append(zlib.compress(block.tobytes()))
    n, at = len(parts), 8 + sum(map(len, parts))
    starts = [8 + sum(map(len, parts[:i])) for i in range(n)]
    one = [(256, w), (257, h), (258, 16), (259, 8), (277, bands), (284, 2), (317, predictor), (322, tile), (323, tile), (339, 1)]
    beyond = at + 2 + 12 * (len(one) + 2) + 4
    rows = [(t, struct.pack(order + "HHIHH", t, 3, 1, v, 0)) for t, v in one]
    rows += [(324, struct.pack(order + "HHII", 324, 4, n, beyond)), (325, struct.pack(order + "HHII", 325, 4, n, beyond + 4 * n))]
    head = (b"II" if order == "<" else b"MM") + struct.pack(order + "HI", 42, at)
    return head + b"".join(parts) + struct.pack(order + "H", len(rows)) + b"".join(x for _, x in sorted(rows)) + struct.pack(order + "I", 0) + struct.pack(f"{order}{2 * n}I", *starts, *map(len, parts))


@pytest.mark.parametrize("order", ["<", ">"])
@pytest.mark.parametrize("predictor", [1, 2])
def test_geotiff_tiles(order, predictor):
    raster = np.random.default_rng(2).integers(0, 65535, (37, 50, 2)).astype("u2")
    assert np.array_equal(geotiff.decode(tiled(raster, 16, order, predictor)), raster)


def test_geotiff_refuses(spark):
    with pytest.raises(ValueError):
        geotiff.tags(b"GIF89a..")
    content = geotiff.encode(np.zeros((4, 4, 1), "u2"))
    with pytest.raises(ValueError):
        geotiff.decode(content[: len(content) - 60])
    pixels = spark.createDataFrame([("a", 5, 0, [1.0])], "k string, row int, col int, spectrum array<double>")
    with pytest.raises(Exception, match="outside its tile"):
        geotiff.encoded(pixels, key="k", height=4, width=4).collect()


def test_geotiff_mask(spark):
    """Pixels that only fill a tile are told from pixels without data."""
    rows = [("a", 0, 1, [5.0, 65535.0]), ("a", 1, 1, [65535.0, 65535.0]), ("b", 1, 0, [0.0, 7.0])]
    pixels = spark.createDataFrame(rows, "path string, row int, col int, spectrum array<double>")
    got = geotiff.decoded(geotiff.encoded(pixels, key="path", height=2, width=3, mask=True), mask=True)
    assert sorted(map(tuple, got.collect())) == rows


def test_scan_geotiff_of_a_part_of_a_tile(spark, tmp_path):
    """A table whose last line ends early."""
    spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet").where("vec_id < 56").write.parquet(str(tmp_path / "embeddings.parquet"))
    got = queries.scan_geotiff(spark, str(tmp_path))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, queries.quantize_u16(spark, str(tmp_path)).collect()))


def test_geotiff_tables(spark, tmp_path):
    raster = np.arange(24, dtype="u2").reshape(3, 4, 2)
    (tmp_path / "a.tif").write_bytes(geotiff.encode(raster, transform=(0.0, 1.0, 3.0, -1.0), epsg=4326))
    got = {(r.row, r.col): r.spectrum for r in geotiff.read_geotiff(spark, str(tmp_path / "*.tif")).collect()}
    assert len(got) == 12 and got[2, 1] == [18.0, 19.0]
    d = geotiff.describe(spark.read.format("binaryFile").load(str(tmp_path))).first()
    assert (d.height, d.width, d.bands, d.x0, d.dy, d.epsg, d.nodata) == (3, 4, 2, 0.0, -1.0, 4326, None)
    empty = spark.createDataFrame([("x", None)], "path string, content binary")
    assert geotiff.decoded(empty).count() == 0 and geotiff.describe(empty).count() == 0
    pixels = spark.createDataFrame([(7, 0, 1, [5.0, None])], "k int, row int, col int, spectrum array<double>")
    made = geotiff.encoded(pixels, key="k", height=2, width=2).first()
    assert made.k == 7 and geotiff.decode(bytes(made.content))[:, :, 0].tolist() == [[65535, 5], [65535, 65535]]
    assert geotiff.decode(bytes(made.content))[0, 1, 1] == 65535


def test_documents(spark, tmp_path):
    ids = spark.createDataFrame([("/x/SENSOR_L2_001_SENSOR_L2_.nc",), ("other.nc",), (None,), (".hidden",)], "p string")
    assert [r.x for r in ids.select(documents.run_id(F.col("p"), "SENSOR_L2_").alias("x")).collect()] == ["001_SENSOR_L2_", "other", None, ".hidden"]
    row = spark.sql("select 'r' raster_id, 'reflectance' product, 32611 epsg, timestamp_ntz'2024-01-02 03:04:05' start, cast(null as timestamp_ntz) stop, 60d dx, -60d dy, 1d l, 2d b, 3d r, 4d t, 5 height, 6 width, 2 bands, array(400d, 500d) wavelengths")
    root = ET.fromstring(documents.sidecar(row).first().xml)
    assert root.findtext("AcquisitionTime/StartUTC") == "2024-01-02T03:04:05Z" and root.find("AcquisitionTime/EndUTC") is None
    assert [float(x.text) for x in root.iter("Wavelength")] == [400, 500] and root.find("Spectral/Wavelengths").get("units") == "nanometers"
    assert root.findtext("Geometry/EPSG") == "EPSG:32611" and float(root.findtext("BoundingBoxLonLat/Corner3/Lon")) == 3
    for _ in range(2):
        documents.write_manifest(spark.sql("select 1 idx, array(1, 2) bands"), str(tmp_path / "m"))
    assert [tuple(r) for r in spark.read.csv(str(tmp_path / "m"), header=True, escape='"').collect()] == [("1", "[1,2]")]
