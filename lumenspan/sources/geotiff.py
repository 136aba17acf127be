"""GeoTIFF files: decoded from ``binaryFile`` rows, encoded as binary rows.

Both ways run one file a row in Arrow batches, so any store that Spark reaches
will do, and tiles are spread over the cluster by file.  A worker holds one
file at a time: the format suits tiles; keep whole scenes as pixel tables.

Decoded are classic TIFF files in strips or tiles, chunky or planar, plain or
deflated, with or without horizontal differencing, of integers or floats.
Other files raise ValueError, and so does a truncated one.  A null content
gives no pixel.

A raster has every pixel of its extent.  With ``mask`` a further, last band tells
the pixels of the table (1) from those that only fill the raster (0).
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

#: TIFF tags, field types and compressions (fixed values).
WIDTH, HEIGHT, BITS, COMPRESSION, PHOTOMETRIC, STRIPS, SAMPLES, STRIP_ROWS, STRIP_SIZES, PLANAR = 256, 257, 258, 259, 262, 273, 277, 278, 279, 284
PREDICTOR, TILE_WIDTH, TILE_HEIGHT, TILES, TILE_SIZES, FORMAT = 317, 322, 323, 324, 325, 339
PIXEL_SCALE, TIE_POINT, GEO_KEYS, NODATA = 33550, 33922, 34735, 42113
FIELDS = {1: "u1", 2: "u1", 3: "u2", 4: "u4", 6: "i1", 8: "i2", 9: "i4", 11: "f4", 12: "f8"}
DEFLATE = (8, 32946)
SCHEMA = "path string, row int, col int, spectrum array<double>"
ROWS_A_BATCH = 4096


def tags(content: bytes) -> tuple[str, dict[int, np.ndarray]]:
    """Byte order and the first directory's tags."""
    order = {b"II": "<", b"MM": ">"}.get(content[:2])
    if order is None or len(content) < 8 or struct.unpack_from(order + "H", content, 2)[0] != 42:
        raise ValueError("not a classic TIFF file")
    at = struct.unpack_from(order + "I", content, 4)[0]
    found = {}
    try:
        for i in range(struct.unpack_from(order + "H", content, at)[0]):
            tag, kind, n = struct.unpack_from(order + "HHI", content, at + 2 + 12 * i)
            if kind not in FIELDS:
                continue
            dtype = np.dtype(FIELDS[kind]).newbyteorder(order)
            own = at + 10 + 12 * i
            if n * dtype.itemsize > 4:
                own = struct.unpack_from(order + "I", content, own)[0]
            found[tag] = np.frombuffer(content, dtype, n, own)
    except struct.error as e:
        raise ValueError("truncated TIFF file") from e
    return order, found


def transform_of(found: dict[int, np.ndarray]) -> tuple[float, float, float, float] | None:
    """(x0, dx, y0, dy) of the outer corner of the first pixel."""
    if PIXEL_SCALE not in found or TIE_POINT not in found:
        return None
    (sx, sy), (i, j, _, x, y, _) = found[PIXEL_SCALE][:2], found[TIE_POINT][:6]
    return float(x - i * sx), float(sx), float(y + j * sy), float(-sy)


def epsg_of(found: dict[int, np.ndarray]) -> int | None:
    """The code of the projected or else geographic reference system."""
    keys = {int(k[0]): int(k[3]) for k in found.get(GEO_KEYS, np.zeros(0, int))[4:].reshape(-1, 4)}
    return keys.get(3072) or keys.get(2048)


def nodata_of(found: dict[int, np.ndarray]) -> float | None:
    return float(found[NODATA].tobytes().split(b"\0")[0]) if NODATA in found else None


def decode(content: bytes) -> np.ndarray:
    """The raster as (height, width, bands) in its own type."""
    order, t = tags(content)
    one = lambda tag, default: int(t[tag][0]) if tag in t else default
    height, width, bands = one(HEIGHT, 0), one(WIDTH, 0), one(SAMPLES, 1)
    kind, bits = {1: "u", 2: "i", 3: "f"}.get(one(FORMAT, 1)), one(BITS, 1)
    compression, predictor, planar = one(COMPRESSION, 1), one(PREDICTOR, 1), one(PLANAR, 1) == 2
    if kind is None or bits not in (8, 16, 32, 64) or compression not in (1, *DEFLATE) or predictor not in (1, 2):
        raise ValueError(f"unsupported TIFF: format {kind}, {bits} bits, compression {compression}, predictor {predictor}")
    dtype = np.dtype(f"{kind}{bits // 8}").newbyteorder(order)
    tiled = TILES in t
    h, w = (one(TILE_HEIGHT, 0), one(TILE_WIDTH, 0)) if tiled else (min(one(STRIP_ROWS, height), height), width)
    starts, sizes = (t[TILES], t[TILE_SIZES]) if tiled else (t[STRIPS], t[STRIP_SIZES])
    across, depth = -(-width // w), 1 if planar else bands
    plane = across * -(-height // h)
    out = np.zeros((height, width, bands), dtype)
    for k, (start, size) in enumerate(zip(starts.tolist(), sizes.tolist(), strict=True)):
        band, block = divmod(k, plane)
        r, c = block // across * h, block % across * w
        data = content[start : start + size]
        data = zlib.decompress(data) if compression in DEFLATE else data
        rows = h if tiled else min(h, height - r)
        if len(data) < rows * w * depth * dtype.itemsize:
            raise ValueError("truncated TIFF file")
        part = np.frombuffer(data, dtype, rows * w * depth).reshape(rows, w, depth)
        if predictor == 2:
            part = np.cumsum(part, axis=1, dtype=dtype.newbyteorder("="))
        part = part[: height - r, : width - c]
        out[r : r + part.shape[0], c : c + part.shape[1], band if planar else slice(None)] = part[:, :, 0] if planar else part
    return out


def encode(raster: np.ndarray, *, transform: Sequence[float] | None = None, epsg: int | None = None, nodata: float | None = None, strip_rows: int = 64) -> bytes:
    """A (height, width, bands) raster as a deflated GeoTIFF in strips."""
    height, width, bands = raster.shape
    raster = np.ascontiguousarray(raster, raster.dtype.newbyteorder("<"))
    strips = [zlib.compress(raster[r : r + strip_rows].tobytes(), 6) for r in range(0, height, strip_rows)]
    sizes = [len(s) for s in strips]
    starts = (8 + np.concatenate(([0], np.cumsum(sizes)[:-1]))).astype(int).tolist()
    each = lambda value: ("H", [value] * bands)
    fields = {
        WIDTH: ("I", [width]), HEIGHT: ("I", [height]), BITS: each(raster.dtype.itemsize * 8), COMPRESSION: ("H", [8]), PHOTOMETRIC: ("H", [1]), STRIPS: ("I", starts), SAMPLES: ("H", [bands]),
        STRIP_ROWS: ("I", [strip_rows]), STRIP_SIZES: ("I", sizes), PLANAR: ("H", [1]), FORMAT: each({"u": 1, "i": 2, "f": 3}[raster.dtype.kind]),
    }
    if transform is not None:
        x0, dx, y0, dy = transform
        fields |= {PIXEL_SCALE: ("d", [dx, -dy, 0.0]), TIE_POINT: ("d", [0.0, 0.0, 0.0, x0, y0, 0.0])}
    if epsg is not None:
        geographic = 4000 <= epsg < 5000
        fields[GEO_KEYS] = ("H", [1, 1, 0, 3, 1024, 0, 1, 2 if geographic else 1, 1025, 0, 1, 1, 2048 if geographic else 3072, 0, 1, epsg])
    if nodata is not None:
        fields[NODATA] = ("s", f"{nodata:.10g}\0".encode())
    at = 8 + sum(sizes)
    at += at % 2
    directory, more = [struct.pack("<H", len(fields))], b""
    beyond = at + 2 + 12 * len(fields) + 4
    for tag, (kind, values) in sorted(fields.items()):
        data = values if kind == "s" else struct.pack(f"<{len(values)}{kind}", *values)
        place = data.ljust(4, b"\0")
        if len(data) > 4:
            place = struct.pack("<I", beyond + len(more))
            more += data + b"\0" * (len(data) % 2)
        directory.append(struct.pack("<HHI", tag, {"s": 2, "H": 3, "I": 4, "d": 12}[kind], len(values)) + place)
    body = b"".join(strips)
    return b"II" + struct.pack("<HI", 42, at) + body + b"\0" * (len(body) % 2) + b"".join(directory) + struct.pack("<I", 0) + more


def _pixels(path: str | None, raster: np.ndarray, mask: bool) -> Iterator[pa.RecordBatch]:
    height, width, bands = raster.shape
    flat = raster.reshape(-1, bands)
    there = np.flatnonzero(flat[:, -1]) if mask else np.arange(len(flat))
    bands -= mask
    for at in range(0, len(there), ROWS_A_BATCH):
        i = there[at : at + ROWS_A_BATCH]
        part = flat[i, :bands].astype("f8")
        spectra = pa.ListArray.from_arrays(pa.array(np.arange(0, part.size + 1, bands), pa.int32()), pa.array(part.ravel()))
        yield pa.RecordBatch.from_arrays([pa.array([path] * len(part), pa.string()), pa.array(i // width, pa.int32()), pa.array(i % width, pa.int32()), spectra], ["path", "row", "col", "spectrum"])


def decoded(files: DataFrame, *, mask: bool = False) -> DataFrame:
    """(path, row, col, spectrum) of every pixel of (path, content) rows; with ``mask`` of those that the last band marks, without it."""

    def run(batches):
        for batch in batches:
            for path, content in zip(batch.column("path"), batch.column("content"), strict=True):
                if content.is_valid:
                    yield from _pixels(path.as_py(), decode(content.as_py()), mask)

    return files.select("path", "content").mapInArrow(run, SCHEMA)


def read_geotiff(spark: SparkSession, path: str) -> DataFrame:
    """Pixels of the GeoTIFF files under ``path`` (a glob will do)."""
    return decoded(spark.read.format("binaryFile").load(path))


def describe(files: DataFrame) -> DataFrame:
    """(path, height, width, bands, x0, dx, y0, dy, epsg, nodata) of (path, content) rows, without their pixels."""
    schema = StructType.fromDDL("path string, height int, width int, bands int, x0 double, dx double, y0 double, dy double, epsg int, nodata double")

    def run(batches):
        for batch in batches:
            rows = []
            for path, content in zip(batch.column("path"), batch.column("content"), strict=True):
                if content.is_valid:
                    _, t = tags(content.as_py())
                    rows.append((path.as_py(), int(t[HEIGHT][0]), int(t[WIDTH][0]), int(t[SAMPLES][0]) if SAMPLES in t else 1, *(transform_of(t) or (None,) * 4), epsg_of(t), nodata_of(t)))
            kinds = [pa.string(), *[pa.int32()] * 3, *[pa.float64()] * 4, pa.int32(), pa.float64()]
            columns = list(zip(*rows, strict=True)) or [()] * len(kinds)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], schema.names)

    return files.select("path", "content").mapInArrow(run, schema)


def encoded(pixels: DataFrame, *, key: str, height: int, width: int, dtype: str = "u2", transform: Sequence[float] | None = None, epsg: int | None = None, nodata: float = 65535, mask: bool = False) -> DataFrame:
    """(``key``, content): one GeoTIFF for each key of (key, row, col, spectrum); missing pixels get ``nodata``, and 0 in the band of the ``mask``.

    Rows and columns count within the tile, whose fixed size bounds each group.
    Values outside the type's range and pixels outside the tile are errors.
    """
    name = pixels.schema[key].dataType.simpleString()

    def run(frame):
        import pandas as pd

        rows, cols = frame["row"].to_numpy(), frame["col"].to_numpy()
        if rows.min() < 0 or cols.min() < 0 or rows.max() >= height or cols.max() >= width:
            raise ValueError("a pixel lies outside its tile")
        values = np.stack(frame["spectrum"].to_list()).astype("f8")
        if dtype[0] != "f":
            limits = np.iinfo(dtype)
            values = np.where(np.isnan(values), nodata, values)
            if values.min() < limits.min or values.max() > limits.max:
                raise ValueError(f"a value lies outside {dtype}")
        raster = np.full((height, width, values.shape[1]), nodata, dtype)
        raster[rows, cols] = values
        if mask:
            there = np.zeros((height, width, 1), dtype)
            there[rows, cols] = 1
            raster = np.concatenate([raster, there], axis=2)
        return pd.DataFrame({key: [frame[key].iloc[0]], "content": [encode(raster, transform=transform, epsg=epsg, nodata=nodata)]})

    return pixels.select(key, "row", "col", F.col("spectrum").cast("array<double>").alias("spectrum")).groupBy(key).applyInPandas(run, f"`{key}` {name}, content binary")
