"""Orthorectification, mosaics, resampling, cropping, masks and tiles.

Rasters are tables (row, col, v) or (row, col, spectrum); neighbourhood
operators are equi-joins or groupings on integer grid keys.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.columns import MASKED, NODATA, close_to, finite
from .radiometry import percentiles


def pixel_centers(grid: DataFrame, transform: Sequence[float]) -> DataFrame:
    """``grid`` with x, y of the pixel centres; rotated transforms are refused."""
    x0, dx, rx, y0, ry, dy = transform
    if rx or ry:
        raise ValueError("rotated geotransforms are not supported")
    return grid.withColumns({"x": F.lit(x0 + dx / 2) + F.col("col") * F.lit(float(dx)), "y": F.lit(y0 + dy / 2) + F.col("row") * F.lit(float(dy))})


def raster_bounds(rasters: DataFrame) -> DataFrame:
    """(raster_id, l, b, r, t) of (raster_id, x0, dx, y0, dy, height, width)."""
    return rasters.select("raster_id", F.col("x0").alias("l"), (F.col("y0") + F.col("height") * F.col("dy")).alias("b"), (F.col("x0") + F.col("width") * F.col("dx")).alias("r"), F.col("y0").alias("t"))


def grid_template(spark, height: int, width: int) -> DataFrame:
    """(row, col, v = 0) of a whole grid, made from one range."""
    i = F.col("id")
    return spark.range(height * width).select(F.floor(i / width).cast("int").alias("row"), (i % width).cast("int").alias("col"), F.lit(0.0).alias("v"))


def orthorectify(glt: DataFrame, raw: DataFrame, values: Sequence[str], fill: float | None = NODATA) -> DataFrame:
    """(out_row, out_col, values): raw pixels through a 1-based lookup table; 0 and out-of-bounds entries get ``fill``.

    Entries without a raw pixel, often half of the grid, stay out of the join.
    """
    used = F.coalesce((F.col("raw_row") > 0) & (F.col("raw_col") > 0), F.lit(False))
    there = glt.where(used).select("out_row", "out_col", (F.col("raw_row") - 1).alias("row"), (F.col("raw_col") - 1).alias("col"))
    met = there.join(raw.select("row", "col", *values), ["row", "col"], "left").select("out_row", "out_col", *values)
    kinds = {f.name: f.dataType for f in raw.schema.fields}
    rest = glt.where(~used).select("out_row", "out_col", *[F.lit(None).cast(kinds[v]).alias(v) for v in values])
    return met.unionByName(rest).select("out_row", "out_col", *[(F.coalesce(v, F.lit(fill)) if fill is not None else F.col(v)).alias(v) for v in values])


def dropped_entries(glt: DataFrame, raw: DataFrame) -> DataFrame:
    """(n): entries that point outside the raw grid."""
    used = glt.where("raw_row > 0 and raw_col > 0").select((F.col("raw_row") - 1).alias("row"), (F.col("raw_col") - 1).alias("col"))
    return used.join(raw.select("row", "col"), ["row", "col"], "left_anti").agg(F.count("*").alias("n"))


def subset_glt(glt: DataFrame, *, rows: tuple[int, int], cols: tuple[int, int]) -> DataFrame:
    """The lookup table in a window, re-based to the raw box that it uses (0 stays 0)."""
    own = glt.where(F.col("out_row").between(*rows) & F.col("out_col").between(*cols))
    used = F.when((F.col("raw_row") > 0) & (F.col("raw_col") > 0), F.lit(True))
    low = own.agg(F.min(F.when(used, F.col("raw_row"))).alias("r0"), F.min(F.when(used, F.col("raw_col"))).alias("c0"))
    base = lambda c, m: F.greatest(F.col(c) - (F.col(m) - 1), F.lit(0)).cast("int")
    return own.crossJoin(F.broadcast(low)).select("out_row", "out_col", base("raw_row", "r0").alias("raw_row"), base("raw_col", "c0").alias("raw_col"))


def mosaic(parts: Sequence[DataFrame], nodata: float = NODATA) -> DataFrame:
    """(row, col, v): of overlapping rasters the first with data; nodata where none has."""
    all_parts = None
    for i, p in enumerate(parts):
        own = p.select("row", "col", "v", F.lit(i).alias("pos"))
        all_parts = own if all_parts is None else all_parts.unionByName(own)
    valid = F.col("v").isNotNull() & (F.col("v") != nodata)
    return all_parts.groupBy("row", "col").agg(F.coalesce(F.min(F.when(valid, F.struct("pos", "v"))).getField("v"), F.lit(nodata)).alias("v"))


def downsample_average(grid: DataFrame, ratio: int, scale: float = 1.0) -> DataFrame:
    """(row, col, v): means of full ``ratio`` x ``ratio`` blocks of valid cells."""
    g = grid.groupBy(F.floor(F.col("row") / ratio).cast("int").alias("row"), F.floor(F.col("col") / ratio).cast("int").alias("col"))
    return g.agg(F.count("*").alias("_n"), F.avg("v").alias("v")).where(F.col("_n") == ratio * ratio).select("row", "col", (F.col("v") * scale).alias("v"))


def upsample_nearest(grid: DataFrame, ratio: int) -> DataFrame:
    k = F.sequence(F.lit(0), F.lit(ratio - 1))
    a = grid.withColumn("_i", F.explode(k)).withColumn("_j", F.explode(k))
    return a.select((F.col("row") * ratio + F.col("_i")).alias("row"), (F.col("col") * ratio + F.col("_j")).alias("col"), "v")


def _taps(ratio: int, kernel, reach: range):
    """Per phase the (offset, weight) pairs of a separable kernel at source position (phase + 0.5) / ratio - 0.5."""
    import math

    out = []
    for phase in range(ratio):
        at = (phase + 0.5) / ratio - 0.5
        base = math.floor(at)
        out.append([(base + k, kernel(at - base - k)) for k in reach])
    return out


def _resample(grid: DataFrame, ratio: int, kernel, reach: range, nodata: float) -> DataFrame:
    """Each valid source cell is dealt to the destination cells that it weighs in; one grouping sums them."""
    back = [(p, -o, w) for p, taps in enumerate(_taps(ratio, kernel, reach)) for o, w in taps if w]
    table = F.array(*[F.struct(F.lit(p).alias("p"), F.lit(o).alias("o"), F.lit(float(w)).alias("w")) for p, o, w in back])
    size = grid.agg((F.max("row") + 1).alias("_h"), (F.max("col") + 1).alias("_w"))
    valid = grid.where(finite(F.col("v")) & (F.col("v") != nodata)).crossJoin(F.broadcast(size))
    a = valid.select("col", "v", "_h", "_w", F.explode(F.transform(table, lambda t: F.struct(((F.col("row") + t.o) * ratio + t.p).alias("row"), t.w.alias("w")))).alias("y"))
    b = a.select("v", "_h", "_w", "y", F.explode(F.transform(table, lambda t: F.struct(((F.col("col") + t.o) * ratio + t.p).alias("col"), t.w.alias("w")))).alias("x"))
    inside = (F.col("y.row") >= 0) & (F.col("y.row") < F.col("_h") * ratio) & (F.col("x.col") >= 0) & (F.col("x.col") < F.col("_w") * ratio)
    w = F.col("y.w") * F.col("x.w")
    sums = b.where(inside).groupBy(F.col("y.row").alias("row"), F.col("x.col").alias("col")).agg(F.sum(w * F.col("v")).alias("s"), F.sum(w).alias("w"))
    return sums.where(F.abs(F.col("w")) > 1e-12).select("row", "col", (F.col("s") / F.col("w")).alias("v"))


def upsample_bilinear(grid: DataFrame, ratio: int, nodata: float = NODATA) -> DataFrame:
    """Weighted over the valid neighbours; cells without any are left out."""
    return _resample(grid, ratio, lambda d: max(0.0, 1 - abs(d)), range(2), nodata)


def _cubic(d: float, a: float = -0.5) -> float:
    d = abs(d)
    return (a + 2) * d**3 - (a + 3) * d**2 + 1 if d <= 1 else a * d**3 - 5 * a * d**2 + 8 * a * d - 4 * a if d < 2 else 0.0


def upsample_cubic(grid: DataFrame, ratio: int, nodata: float = NODATA) -> DataFrame:
    return _resample(grid, ratio, _cubic, range(-1, 3), nodata)


def crop(grid: DataFrame, rows: tuple[int, int], cols: tuple[int, int]) -> DataFrame:
    """The cells in [start, stop) windows, re-based; plain comparisons that reach the scan."""
    if rows[0] >= rows[1] or cols[0] >= cols[1]:
        raise ValueError("the window is empty")
    inside = grid.where((F.col("row") >= rows[0]) & (F.col("row") < rows[1]) & (F.col("col") >= cols[0]) & (F.col("col") < cols[1]))
    return inside.withColumns({"row": F.col("row") - rows[0], "col": F.col("col") - cols[0]})


def stack_bands(grids: Sequence[DataFrame]) -> DataFrame:
    """(row, col, spectrum): cells that all grids have, one band from each."""
    out = None
    for i, g in enumerate(grids):
        own = g.select("row", "col", F.col("v").alias(f"v{i}"))
        out = own if out is None else out.join(own, ["row", "col"])
    return out.select("row", "col", F.array(*[f"v{i}" for i in range(len(grids))]).alias("spectrum"))


def quality_mask(flags: Column, chosen: Sequence[int]) -> Column:
    """1 if one of the chosen flags is set; 5 and 6 hold data and can't be chosen."""
    if {5, 6} & set(chosen):
        raise ValueError("flags 5 and 6 hold data")
    return F.least(F.aggregate(F.array(*[F.get(flags, F.lit(i)) for i in chosen]), F.lit(0), lambda a, x: a + x), F.lit(1))


def unpack_bits(packed: Column, n: int = 285) -> Column:
    """The first ``n`` bits of an array of bytes, most significant first."""
    return F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda k: F.shiftright(F.get(packed, F.floor(k / 8).cast("int")), 0).bitwiseAND(F.pow(F.lit(2), F.lit(7) - k % 8).cast("int")).cast("boolean").cast("int"))


def is_black(spectrum: Column, nodata: float = NODATA) -> Column:
    """All bands close to nodata, or all to the masked value, or all to zero; NULL and NaN are not black."""
    every = lambda f: F.coalesce(F.forall(spectrum, f), F.lit(False))
    return every(lambda v: close_to(v, nodata)) | every(lambda v: close_to(v, MASKED)) | every(lambda v: F.coalesce(~F.isnan(v) & (F.abs(v) < 1e-6), F.lit(False)))


def flatten_pixels(x: DataFrame, y: DataFrame, nodata: float = NODATA) -> DataFrame:
    """(row, col, x, y) of the pixels whose bands are all finite and not nodata on both sides."""
    bad = lambda s: F.exists(s, lambda v: ~finite(v) | close_to(v, nodata))
    ok = lambda df: df.where(F.col("spectrum").isNotNull() & ~bad(F.col("spectrum")))
    return ok(x).select("row", "col", F.col("spectrum").alias("x")).join(ok(y).select("row", "col", F.col("spectrum").alias("y")), ["row", "col"])


def robust_minmax(grid: DataFrame, step: int = 64, nodata: float = NODATA) -> DataFrame:
    """(lo, hi): percentiles 1 and 99 of every ``step``-th valid cell; (0, 1) without any, hi + 1 if equal."""
    ok = grid.where((F.col("row") % step == 0) & (F.col("col") % step == 0) & finite(F.col("v")) & (F.col("v") != nodata))
    p = percentiles(ok, [], {"lo": 0.01, "hi": 0.99}).select(F.coalesce("lo", F.lit(0.0)).alias("lo"), F.coalesce("hi", F.lit(1.0)).alias("hi"))
    return p.select("lo", F.when(F.col("hi") > F.col("lo"), F.col("hi")).otherwise(F.col("lo") + 1).alias("hi"))


def scale_reflectance(grid: DataFrame, nodata: float = NODATA) -> DataFrame:
    """Values of a raster whose maximum exceeds 1.5 are in ten-thousandths."""
    top = grid.where(F.col("v") != nodata).agg(F.max("v").alias("_top"))
    return grid.crossJoin(F.broadcast(top)).withColumn("v", F.when((F.col("_top") > 1.5) & (F.col("v") != nodata), F.col("v") / 1e4).otherwise(F.col("v"))).drop("_top")


def _black_share(grid: DataFrame, size: int, prefix: str) -> DataFrame:
    black = F.when(is_black(F.array("v")), 1.0).otherwise(0.0)
    g = grid.groupBy(F.floor(F.col("row") / size).cast("int").alias("tile_row"), F.floor(F.col("col") / size).cast("int").alias("tile_col"))
    return g.agg(F.count("*").alias("_n"), F.avg(black).alias(f"{prefix}_black")).where(F.col("_n") == size * size).drop("_n")


def paired_tiles(coarse: DataFrame, fine: DataFrame, *, size: int, scale: int, max_black: float = 0.0, max_tiles: int | None = None) -> DataFrame:
    """(idx, tile_row, tile_col, coarse_black, fine_black): full tiles that both rasters have and that are clear enough.

    ``idx`` numbers the kept tiles row by row; tiles are few, so that number is
    the only global order.
    """
    kept = _black_share(coarse, size, "coarse").join(_black_share(fine, size * scale, "fine"), ["tile_row", "tile_col"]).where((F.col("coarse_black") <= max_black) & (F.col("fine_black") <= max_black))
    out = kept.withColumn("idx", F.row_number().over(Window.orderBy("tile_row", "tile_col")) - 1)
    return out.where(F.col("idx") < max_tiles) if max_tiles is not None else out


def sliding_tiles(grid: DataFrame, *, height: int, width: int, size: int, overlap: float) -> DataFrame:
    """(tile_id, tile_row, tile_col, black): overlapping tiles; each cell is dealt to the tiles that cover it."""
    stride = max(1, int(size * (1 - overlap)))
    n_rows, n_cols = (height - size) // stride + 1, (width - size) // stride + 1

    def covering(c: str, n: int) -> Column:
        lo = F.greatest(F.lit(0), F.ceil((F.col(c) - (size - 1)) / F.lit(stride)).cast("int"))
        hi = F.least(F.lit(n - 1), F.floor(F.col(c) / F.lit(stride)).cast("int"))
        return F.when(lo <= hi, F.sequence(lo, hi)).otherwise(F.array().cast("array<int>"))

    black = F.when(is_black(F.array("v")), 1.0).otherwise(0.0)
    dealt = grid.select(black.alias("b"), F.explode(covering("row", n_rows)).alias("tile_row"), "col").select("b", "tile_row", F.explode(covering("col", n_cols)).alias("tile_col"))
    return dealt.groupBy("tile_row", "tile_col").agg(F.avg("b").alias("black")).select((F.col("tile_row") * n_cols + F.col("tile_col")).alias("tile_id"), "tile_row", "tile_col", "black")


def coregister(reference: DataFrame, target: DataFrame, *, window: int = 32, max_shift: int = 5) -> DataFrame:
    """(tile_row, tile_col, d_row, d_col, reliability): shifts by phase correlation, a window in each task group."""

    def shift(key, frame):
        import numpy as np
        import pandas as pd

        a, b = np.zeros((window, window)), np.zeros((window, window))
        a[frame["row"] % window, frame["col"] % window] = frame["a"]
        b[frame["row"] % window, frame["col"] % window] = frame["b"]
        f = np.fft.fft2(a - a.mean()) * np.conj(np.fft.fft2(b - b.mean()))
        c = np.real(np.fft.ifft2(f / np.maximum(np.abs(f), 1e-12)))
        r, k = np.unravel_index(int(c.argmax()), c.shape)
        d = [int(x - window if x > window // 2 else x) for x in (r, k)]
        good = 100 * float((c.max() - c.mean()) / (c.max() + 1e-12)) if max(map(abs, d)) <= max_shift else 0.0
        return pd.DataFrame([[key[0], key[1], d[0], d[1], good]], columns=["tile_row", "tile_col", "d_row", "d_col", "reliability"])

    both = reference.select("row", "col", F.col("v").alias("a")).join(target.select("row", "col", F.col("v").alias("b")), ["row", "col"])
    tiled = both.withColumns({"tile_row": F.floor(F.col("row") / window).cast("int"), "tile_col": F.floor(F.col("col") / window).cast("int")})
    return tiled.groupBy("tile_row", "tile_col").applyInPandas(shift, "tile_row int, tile_col int, d_row int, d_col int, reliability double")


def fit_shifts(shifts: DataFrame, *, window: int = 32, min_reliability: float = 60.0, max_deviation: float = 3.0) -> list[list[float]] | None:
    """Coefficients (constant, per row, per column) of d_row and d_col, by least squares over the tie points.

    Left out are unreliable points and those further than ``max_deviation``
    from the median shift.  Fewer than three points, or points on one line,
    give the mean shift; none give None.  Only moments reach the driver.
    """
    import numpy as np

    good = shifts.where(F.col("reliability") >= min_reliability)
    middle = good.agg(F.median("d_row").alias("_r"), F.median("d_col").alias("_c"))
    kept = good.crossJoin(F.broadcast(middle)).where((F.abs(F.col("d_row") - F.col("_r")) <= max_deviation) & (F.abs(F.col("d_col") - F.col("_c")) <= max_deviation))
    center = lambda c: (F.col(c) + 0.5) * window - 0.5
    x = [F.lit(1.0), center("tile_row"), center("tile_col")]
    y = [F.col("d_row"), F.col("d_col")]
    m = kept.agg(F.count("*"), *[F.sum(a * b) for a in x for b in x], *[F.sum(a * b) for a in x for b in y]).first()
    if not m[0]:
        return None
    xx, xy = np.array(m[1:10], float).reshape(3, 3), np.array(m[10:], float).reshape(3, 2)
    if m[0] < 3 or np.linalg.cond(xx) > 1e12:
        return [[float(v) / m[0], 0.0, 0.0] for v in xy[0]]
    return np.linalg.solve(xx, xy).T.tolist()


def deshift(target: DataFrame, coefficients: list[list[float]], nodata: float = NODATA) -> DataFrame:
    """(row, col, v): ``target`` moved by the fitted shifts, bilinear on its own grid.

    A target pixel at p belongs at p + d(p); each cell of the grid therefore
    asks for the four neighbours of the inverse position, weighted over those
    with data.  Cells without any are left out.
    """
    import numpy as np

    shift = np.array(coefficients, float)
    back = np.linalg.inv(np.eye(2) + shift[:, 1:])
    start = -back @ shift[:, 0]
    at = [F.lit(float(start[k])) + F.col("row") * F.lit(float(back[k, 0])) + F.col("col") * F.lit(float(back[k, 1])) for k in range(2)]
    placed = target.select(F.col("row").alias("_row"), F.col("col").alias("_col"), at[0].alias("_y"), at[1].alias("_x"))
    near = F.array(*[F.struct((F.floor("_y") + a).cast("int").alias("row"), (F.floor("_x") + b).cast("int").alias("col")) for a in (0, 1) for b in (0, 1)])
    asked = placed.select("_row", "_col", "_y", "_x", F.explode(near).alias("n")).select("_row", "_col", "n.row", "n.col", ((1 - F.abs(F.col("_y") - F.col("n.row"))) * (1 - F.abs(F.col("_x") - F.col("n.col")))).alias("w"))
    valid = target.where(finite(F.col("v")) & (F.col("v") != nodata)).select("row", "col", "v")
    sums = asked.where("w > 0").join(valid, ["row", "col"]).groupBy("_row", "_col").agg(F.sum(F.col("w") * F.col("v")).alias("s"), F.sum("w").alias("w"))
    return sums.where("w > 1e-6").select(F.col("_row").alias("row"), F.col("_col").alias("col"), (F.col("s") / F.col("w")).alias("v"))


def apply_mask(spectrum: Column, mask: Column, nodata: float = NODATA) -> Column:
    """All bands of a pixel as nodata where its ``mask`` is 1."""
    return F.when(mask == 1, F.transform(spectrum, lambda _: F.lit(nodata))).otherwise(spectrum)


def apply_band_mask(spectrum: Column, bits: Column, nodata: float = NODATA) -> Column:
    """The bands whose bit is 1 as nodata; bands without a bit stay."""
    return F.transform(spectrum, lambda v, i: F.when(F.get(bits, i) == 1, F.lit(nodata)).otherwise(v))


def is_black_exact(spectrum: Column, nodata: float | None) -> Column:
    """All bands equal to nodata, or to 0 where the raster has none; NULL is not black."""
    return F.coalesce(F.forall(spectrum, lambda v: v == F.lit(0.0 if nodata is None else nodata)), F.lit(False))


def is_invalid(spectrum: Column, nodata: float | None = NODATA, zero: float = 1e-6) -> Column:
    """All bands close to nodata, or all closer to 0 than ``zero``."""
    near = F.lit(False) if nodata is None else F.forall(spectrum, lambda v: close_to(v, nodata, zero))
    return near | F.forall(spectrum, lambda v: F.coalesce(~F.isnan(v) & (F.abs(v) < zero), F.lit(False)))


def valid_rgb(spectrum: Column, *, every: bool = True) -> Column:
    """All bands finite and the first above 0; with ``every`` false, any band above 0."""
    if every:
        return F.forall(spectrum, finite) & (F.get(spectrum, F.lit(0)) > 0)
    return F.exists(spectrum, lambda v: finite(v) & (v > 0))


def rgb_u8(spectrum: Column, bands: Sequence[int] = (1, 2, 3)) -> Column:
    """The chosen 1-based bands of an 8-bit raster."""
    return F.array(*[F.get(spectrum, F.lit(b - 1)).cast("short") for b in bands])


def block_size(width: Column, height: Column) -> Column:
    """Edge of a tiled file's blocks: 256, 64 or 16, as the smaller side allows."""
    side = F.least(width, height)
    return F.when(side >= 256, 256).when(side >= 64, 64).otherwise(16)


def fits_grid(dx: Column, dy: Column, step: float = 60.0, tolerance: float = 1e-9) -> Column:
    """Whether ``step`` is a whole multiple of both pixel sizes."""
    whole = lambda d: F.abs(F.lit(step) / F.abs(d) - F.rint(F.lit(step) / F.abs(d))) <= tolerance
    return (dx != 0) & (dy != 0) & whole(dx) & whole(dy)


def pick_grid(candidates: DataFrame, height: int, width: int) -> DataFrame:
    """(path): of (pos, path, height, width) the first raster of this shape; no row if none has it."""
    return candidates.where((F.col("height") == height) & (F.col("width") == width)).orderBy("pos").limit(1).select("path")


def whole_ratio(coarse: float, fine: float, tolerance: float = 0.1) -> int:
    """The rounded ratio of two pixel sizes, refused if it is further than ``tolerance`` from a whole number."""
    ratio = abs(coarse) / abs(fine)
    if round(ratio) <= 0 or abs(ratio - round(ratio)) > tolerance:
        raise ValueError(f"the pixel sizes have no whole ratio: {ratio:.3f}")
    return round(ratio)


def _shares(grid: DataFrame, size: int, stride: int, n_rows: int, n_cols: int, name: str) -> DataFrame:
    """(tile_row, tile_col, name): the share of invalid cells of full tiles, each cell dealt to the tiles that cover it."""

    def covering(c: str, n: int) -> Column:
        lo = F.greatest(F.lit(0), F.ceil((F.col(c) - (size - 1)) / F.lit(stride)).cast("int"))
        hi = F.least(F.lit(n - 1), F.floor(F.col(c) / F.lit(stride)).cast("int"))
        return F.when(lo <= hi, F.sequence(lo, hi)).otherwise(F.array().cast("array<int>"))

    bad = F.when(is_invalid(F.array("v")), 1.0).otherwise(0.0)
    dealt = grid.select(bad.alias("b"), F.explode(covering("row", n_rows)).alias("tile_row"), "col").select("b", "tile_row", F.explode(covering("col", n_cols)).alias("tile_col"))
    return dealt.groupBy("tile_row", "tile_col").agg(F.avg("b").alias(name), F.count("*").alias("_n")).where(F.col("_n") == size * size).drop("_n")


def overlapping_pairs(coarse: DataFrame, fine: DataFrame, *, shape: tuple[int, int], fine_shape: tuple[int, int], size: int, scale: int, overlap: float, max_invalid: float) -> DataFrame:
    """(tile_id, tile_row, tile_col, coarse_invalid, fine_invalid) of overlapping tile pairs that are clear enough.

    ``tile_id`` counts all positions of the coarse raster row by row, also
    those that are dropped; tiles that leave the fine raster are dropped.
    """
    stride = max(1, int(size * (1 - overlap)))
    n_rows, n_cols = (max(0, (n - size) // stride + 1) for n in shape)
    inside = ((F.col("tile_row") * stride + size) * scale <= fine_shape[0]) & ((F.col("tile_col") * stride + size) * scale <= fine_shape[1])
    both = _shares(coarse, size, stride, n_rows, n_cols, "coarse_invalid").where(inside).join(_shares(fine, size * scale, stride * scale, n_rows, n_cols, "fine_invalid"), ["tile_row", "tile_col"])
    kept = both.where((F.col("coarse_invalid") <= max_invalid) & (F.col("fine_invalid") <= max_invalid))
    return kept.select((F.col("tile_row") * n_cols + F.col("tile_col")).alias("tile_id"), "tile_row", "tile_col", "coarse_invalid", "fine_invalid")


#: Bands of a spectral stack in order, and those that keep their 10 m cells (fixed values).
STACK = ("B02", "B03", "B04", "B08", "B05", "B06", "B07", "B8A", "B11", "B12")
TEN_METRES = frozenset(STACK[:4])


def stack_order(resolutions: dict[str, float]) -> list[str]:
    """The bands of a stack from the pixel sizes of the bands there are: B8A only if it differs from B08; the other nine are required."""
    lacking = [b for b in STACK if b != "B8A" and b not in resolutions]
    if lacking:
        raise ValueError(f"bands lack: {', '.join(lacking)}")
    return [b for b in STACK if b != "B8A" or ("B8A" in resolutions and resolutions["B8A"] != resolutions["B08"])]


def spectral_stack(grids: dict[str, DataFrame], resolutions: dict[str, float]) -> DataFrame:
    """(row, col, spectrum) on the 10 m grid: 10 m bands as they are, the others bilinear."""
    fine = resolutions["B02"] if "B02" in resolutions else 10.0
    made = []
    for band in stack_order(resolutions):
        ratio = whole_ratio(resolutions[band], fine)
        made.append(grids[band] if ratio == 1 else (upsample_nearest if band in TEN_METRES else upsample_bilinear)(grids[band], ratio))
    return stack_bands(made)


def te_window(raster: dict[str, Column], te: dict[str, Column], *, snap: bool = False, cover: bool = True, eps: float = 1e-9) -> Column:
    """struct(row0, row1, col0, col1) of a target extent (l, b, r, t) in a raster (x0, dx, y0, dy, height, width).

    ``snap`` first moves the edges half up to the raster's grid; ``cover`` takes
    all cells that the extent touches, else offsets and sizes are rounded half to
    even.  Cut to the raster; NULL where nothing is left.
    """
    x0, dx, y0, dy = (raster[k] for k in ("x0", "dx", "y0", "dy"))
    l, b, r, t = (te[k] for k in "lbrt")
    dy = F.abs(dy)
    if snap:
        sx, sy = (lambda x: F.floor((x - x0) / dx + 0.5) * dx + x0), (lambda y: y0 - F.floor((y0 - y) / dy + 0.5) * dy)
        l, b, r, t = sx(l), sy(b), sx(r), sy(t)
    c, k, w, h = (l - x0) / dx, (y0 - t) / dy, (r - l) / dx, (t - b) / dy
    if cover:
        c0, r0, c1, r1 = F.floor(c + eps), F.floor(k + eps), F.ceil(c + w - eps), F.ceil(k + h - eps)
    else:
        c0, r0 = F.rint(c), F.rint(k)
        c1, r1 = c0 + F.rint(w), r0 + F.rint(h)
    zero = F.lit(0)
    low, left = F.greatest(r0.cast("int"), zero), F.greatest(c0.cast("int"), zero)
    high, right = F.least(r1.cast("int"), raster["height"]), F.least(c1.cast("int"), raster["width"])
    return F.when((r > l) & (t > b) & (high > low) & (right > left), F.struct(low.alias("row0"), high.alias("row1"), left.alias("col0"), right.alias("col1")))


def overlap_windows(a: dict[str, Column], b: dict[str, Column]) -> Column:
    """struct(a, b): the windows of two rasters of one EPSG code over their common area; NULL without one or across codes."""

    def edges(x):
        return x["x0"], x["y0"] - x["height"] * F.abs(x["dy"]), x["x0"] + x["width"] * x["dx"], x["y0"]

    (al, ab, ar, at), (bl, bb, br, bt) = edges(a), edges(b)
    te = {"l": F.greatest(al, bl), "b": F.greatest(ab, bb), "r": F.least(ar, br), "t": F.least(at, bt)}
    own, other = te_window(a, te, cover=False), te_window(b, te, cover=False)
    return F.when((a["epsg"] == b["epsg"]) & own.isNotNull() & other.isNotNull(), F.struct(own.alias("a"), other.alias("b")))


def warp(source: DataFrame, *, transform: Sequence[float], zone: int, south: bool, extent: Sequence[float], size: tuple[int, int], nodata: float = NODATA) -> DataFrame:
    """(row, col, v) of a longitude and latitude grid warped, cubic, onto a UTM grid of exact extent and size.

    ``transform`` is (west, degrees a column, north, degrees a row, positive
    downwards); ``extent`` is (l, b, r, t) in metres and ``size`` (height, width).
    Every target cell looks up its centre by the inverse projection, asks for
    its 16 neighbours in one equi-join, and is weighted over those with data;
    the weights of a cell with less than half of them are not trusted: nodata.
    """
    from .geometry import from_utm_columns

    (l, b, r, t), (height, width) = extent, size
    west, dlon, north, dlat = transform
    cells = grid_template(source.sparkSession, height, width).select("row", "col")
    x, y = F.lit(l) + (F.col("col") + 0.5) * F.lit((r - l) / width), F.lit(t) - (F.col("row") + 0.5) * F.lit((t - b) / height)
    lon, lat = from_utm_columns(x, y, zone, south)
    placed = cells.withColumns({"_x": (lon - west) / dlon - 0.5, "_y": (F.lit(north) - lat) / dlat - 0.5})

    def weight(d: Column, a: float = -0.5) -> Column:
        near = ((a + 2) * d - (a + 3)) * d * d + 1
        far = ((a * d - 5 * a) * d + 8 * a) * d - 4 * a
        return F.when(d <= 1, near).when(d < 2, far).otherwise(0.0)

    steps = [(i, j) for i in range(-1, 3) for j in range(-1, 3)]
    asked = placed.select("row", "col", "_x", "_y", F.explode(F.array(*[F.struct((F.floor("_y") + i).cast("int").alias("r"), (F.floor("_x") + j).cast("int").alias("c")) for i, j in steps])).alias("n"))
    asked = asked.select("row", "col", F.col("n.r").alias("_r"), F.col("n.c").alias("_c"), (weight(F.abs(F.col("_y") - F.col("n.r"))) * weight(F.abs(F.col("_x") - F.col("n.c")))).alias("w"))
    valid = source.where(finite(F.col("v")) & (F.col("v") != nodata)).select(F.col("row").alias("_r"), F.col("col").alias("_c"), "v")
    sums = asked.where("w <> 0").join(valid, ["_r", "_c"]).groupBy("row", "col").agg(F.sum(F.col("w") * F.col("v")).alias("s"), F.sum("w").alias("w"))
    met = cells.join(sums, ["row", "col"], "left")
    return met.select("row", "col", F.when(F.col("w") >= 0.5, F.col("s") / F.col("w")).otherwise(F.lit(nodata)).alias("v"))
