"""Band synthesis and band statistics over ``pixel(row, col, spectrum)`` tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.columns import finite

#: Nominal multispectral bands (fixed values): name, centre and width in nm.
NOMINAL_BANDS = (
    ("B01", 443.0, 20.0), ("B02", 490.0, 65.0), ("B03", 560.0, 35.0), ("B04", 665.0, 30.0), ("B05", 705.0, 15.0), ("B06", 740.0, 15.0),
    ("B07", 783.0, 20.0), ("B08", 842.0, 115.0), ("B8A", 865.0, 20.0), ("B09", 945.0, 20.0), ("B11", 1610.0, 90.0), ("B12", 2190.0, 180.0),
)


def trapezoid_weights(x: Sequence[float]) -> np.ndarray:
    """w with sum(w * y) equal to the trapezoid integral of y over x."""
    x = np.asarray(x, float)
    w = np.zeros(len(x))
    if len(x) > 1:
        d = np.diff(x) / 2
        w[:-1] += d
        w[1:] += d
    return w


def triangular(wavelengths: Sequence[float], center: float, half_width: float) -> np.ndarray:
    return np.maximum(0.0, 1 - np.abs(np.asarray(wavelengths) - center) / half_width)


def sampled(wavelengths: Sequence[float], at: Sequence[float], response: Sequence[float]) -> np.ndarray:
    """A sampled response on the sensor's wavelengths: linear between samples, 0 outside."""
    return np.interp(wavelengths, at, response, left=0.0, right=0.0)


def response_weights(wavelengths: Sequence[float], good: Sequence[bool], responses: Mapping[str, np.ndarray]) -> dict[str, list[float] | None]:
    """Per band the weights whose dot product with a spectrum is the normalised response integral; None if nothing responds."""
    if any(len(r) != len(wavelengths) for r in responses.values()) or len(good) != len(wavelengths):
        raise ValueError("responses, good and wavelengths differ in length")
    t = trapezoid_weights(wavelengths)
    out: dict[str, list[float] | None] = {}
    for name, r in responses.items():
        own = r * np.asarray(good, float)
        out[name] = (own * t / ((own * t).sum() + 1e-32)).tolist() if own.any() else None
    return out


def dot(spectrum: Column, weights: Sequence[float]) -> Column:
    """Sum of products over the bands that count; a pixel's spectrum stays one array."""
    used = [i for i, w in enumerate(weights) if w]
    if not used:
        return F.lit(0.0)
    first, last = used[0], used[-1]
    part = F.slice(spectrum, first + 1, last - first + 1)
    return F.aggregate(F.zip_with(part, F.array(*[F.lit(float(w)) for w in weights[first : last + 1]]), lambda v, w: v * w), F.lit(0.0), lambda a, x: a + x)


def synthesise(pixels: DataFrame, weights: Mapping[str, list[float] | None]) -> DataFrame:
    """(row, col, band, value): every band's response integral, NULL for bands without response.  No shuffle."""
    values = F.array(*[F.struct(F.lit(n).alias("band"), (F.lit(None).cast("double") if w is None else dot(F.col("spectrum"), w)).alias("value")) for n, w in weights.items()])
    return pixels.select("row", "col", F.explode(values).alias("_b")).select("row", "col", "_b.band", "_b.value")


def synthesise_arrow(pixels: DataFrame, weights: Mapping[str, list[float] | None]) -> DataFrame:
    """The same as (row, col, values) by one matrix product for each Arrow batch, for large rasters."""
    matrix = np.array([w if w is not None else [np.nan] * len(next(x for x in weights.values() if x)) for w in weights.values()]).T

    def run(batches):
        for frame in batches:
            made = np.stack(frame["spectrum"].to_numpy()) @ matrix if len(frame) else np.zeros((0, matrix.shape[1]))
            yield frame[["row", "col"]].assign(values=list(made))

    return pixels.select("row", "col", "spectrum").mapInPandas(run, "row int, col int, values array<double>")


def box_weights(wavelengths: Sequence[float], good: Sequence[bool], start: float, stop: float) -> list[float] | None:
    """Weights of the mean over [start, stop] by trapezoids through the good bands; None for fewer than two."""
    used = [i for i, (w, g) in enumerate(zip(wavelengths, good, strict=True)) if g and start <= w <= stop]
    if len(used) < 2:
        return None
    out = np.zeros(len(wavelengths))
    x = [wavelengths[i] for i in used]
    out[used] = trapezoid_weights(x) / (x[-1] - x[0])
    return out.tolist()


def rgb(pixels: DataFrame, red: int, green: int, blue: int, top: float = 0.3) -> DataFrame:
    """(row, col, r, g, b): three bands scaled by ``top`` and clipped to [0, 1]."""
    from ..functions.columns import clip

    band = lambda i: clip(F.get("spectrum", F.lit(i)) / top, 0.0, 1.0)
    return pixels.select("row", "col", band(red).alias("r"), band(green).alias("g"), band(blue).alias("b"))


def nearest_band(bands: DataFrame, targets: DataFrame) -> DataFrame:
    """(target, band_idx, center_nm): the nearest band of every target, the first of equals.  Both sides are small dimensions."""
    order = Window.partitionBy("target").orderBy(F.abs(F.col("center_nm") - F.col("target")), "band_idx")
    met = targets.join(F.broadcast(bands.where("center_nm is not null and not isnan(center_nm)")))
    return met.select("target", "band_idx", "center_nm", F.row_number().over(order).alias("_k")).where("_k = 1").drop("_k")


def wavelength_intervals(bands: DataFrame) -> DataFrame:
    """(subset, n, min_nm, max_nm, mean_step, min_step, max_step) of all and of the good bands."""
    both = bands.select(F.lit("all").alias("subset"), "center_nm").unionByName(bands.where("good").select(F.lit("good").alias("subset"), "center_nm"))
    step = F.lead("center_nm").over(Window.partitionBy("subset").orderBy("center_nm")) - F.col("center_nm")
    return both.withColumn("step", step).groupBy("subset").agg(
        F.count("*").alias("n"), F.min("center_nm").alias("min_nm"), F.max("center_nm").alias("max_nm"), F.avg("step").alias("mean_step"), F.min("step").alias("min_step"), F.max("step").alias("max_step")
    )


def to_nm(bands: DataFrame, column: str = "center_nm") -> DataFrame:
    """Wavelengths of at most 10 are micrometres, for the whole table."""
    top = bands.agg(F.max(column).alias("_top"))
    return bands.crossJoin(F.broadcast(top)).withColumn(column, F.when(F.col("_top") <= 10, F.col(column) * 1000).otherwise(F.col(column))).drop("_top")


def band_statistics(pixels: DataFrame) -> DataFrame:
    """(band_idx, mean, variance): population variance of every band; partial aggregation before the shuffle."""
    return pixels.select(F.posexplode("spectrum").alias("band_idx", "v")).groupBy("band_idx").agg(F.avg("v").alias("mean"), F.var_pop("v").alias("variance"))


def max_variance_band(pixels: DataFrame) -> DataFrame:
    """The band of the largest variance, the first of equals."""
    return band_statistics(pixels).orderBy(F.desc("variance"), "band_idx").limit(1).select("band_idx", "variance")


def select_bands(pixels: DataFrame, indices: Sequence[int]) -> DataFrame:
    return pixels.withColumn("spectrum", F.array(*[F.get("spectrum", F.lit(int(i))) for i in indices]))


def find_band(descriptions: DataFrame, keyword_sets: Sequence[Sequence[str]]) -> DataFrame:
    """(band_idx): the first description that holds all words of the first keyword set that any description satisfies."""
    low = F.lower("description")

    def first(words):
        ok = F.lit(True)
        for w in words:
            ok &= F.contains(low, F.lit(w.lower()))
        return F.min(F.when(ok, F.col("band_idx")))

    return descriptions.agg(F.coalesce(*[first(w) for w in keyword_sets]).alias("band_idx"))


def units_to_nm(wavelength: Column, units: Column) -> Column:
    """Wavelengths in nanometres by their unit's name; an unknown unit leaves them as they are."""
    micro = F.lower(F.coalesce(units, F.lit(""))).isin("micrometers", "um", "µm")
    return F.when(micro, wavelength * 1000).otherwise(wavelength)


def band_dimension(sensor: DataFrame) -> DataFrame:
    """(band_idx, center_nm, good) of one row with arrays ``wavelengths`` and, possibly NULL, ``good``."""
    rows = sensor.select("good", F.posexplode("wavelengths").alias("band_idx", "center_nm"))
    return rows.select("band_idx", F.col("center_nm").cast("float").alias("center_nm"), F.coalesce(F.get("good", F.col("band_idx")).cast("boolean"), F.lit(True)).alias("good"))


def wavelengths_from_tags(tags: DataFrame) -> DataFrame:
    """(raster_id, band, wl) from (raster_id, tags): the first number of every ``Band_<n>`` tag; bands without one are NULL, rasters without any have no row."""
    found = tags.select("raster_id", F.explode("tags").alias("k", "v")).where(F.rlike("k", F.lit(r"^Band_\d+$")))
    found = found.select("raster_id", F.regexp_extract("k", r"(\d+)", 1).cast("int").alias("band"), F.regexp_extract("v", r"(\d+(\.\d+)?)", 1).try_cast("double").alias("wl"))
    slots = found.groupBy("raster_id").agg(F.max("band").alias("n")).select("raster_id", F.explode(F.sequence(F.lit(1), F.col("n"))).alias("band"))
    return slots.join(found.groupBy("raster_id", "band").agg(F.min("wl").alias("wl")), ["raster_id", "band"], "left")


def wavelengths_from_descriptions(bands: DataFrame, targets: Sequence[float], least: int = 10) -> DataFrame:
    """(raster_id, target, band): 1-based bands nearest to ``targets`` by the wavelengths in (raster_id, band_idx, description).

    The first number of a description counts, below 10 as micrometres; with
    fewer than ``least`` numbers bands at 85, 55 and 25 % are taken in turn.
    """
    number = F.regexp_extract(F.coalesce("description", F.lit("")), r"(\d+(\.\d+)?)", 1).try_cast("double")
    wl = F.when(number < 10, number * 1000).otherwise(number)
    at = lambda t: F.min(F.when(wl.isNotNull(), F.struct(F.abs(wl - t), (F.col("band_idx") + 1).alias("band"))))["band"]
    n = F.count("*") - 1
    fixed = [(F.rint(F.lit(share) * n) + 1).cast("int") for share in (0.85, 0.55, 0.25)]
    chosen = [F.when(F.count(wl) >= least, at(t)).otherwise(fixed[i % 3]) for i, t in enumerate(targets)]
    rows = F.array(*[F.struct(F.lit(float(t)).alias("target"), c.alias("band")) for t, c in zip(targets, chosen, strict=True)])
    return bands.groupBy("raster_id").agg(rows.alias("x")).select("raster_id", F.explode("x").alias("x")).select("raster_id", "x.target", "x.band")


def band_map(descriptions: DataFrame) -> DataFrame:
    """(raster_id, code, band) of (raster_id, band_idx, description): the upper-case token before ``_``, the last 1-based band of each."""
    named = descriptions.where("description is not null and description <> ''")
    return named.groupBy("raster_id", F.upper(F.element_at(F.split("description", "_"), 1)).alias("code")).agg((F.max("band_idx") + 1).alias("band"))


def load_srf(sheet: DataFrame, wavelength: str, bands: dict[str, str]) -> DataFrame:
    """(band, nm, response) of a wide sheet of texts: numbers only, responses above 0; a missing column is a KeyError."""
    lacking = [c for c in (wavelength, *bands.values()) if c not in sheet.columns]
    if lacking:
        raise KeyError(", ".join(lacking))
    wide = sheet.select(F.col(wavelength).try_cast("double").alias("nm"), *[F.col(c).try_cast("double").alias(b) for b, c in bands.items()])
    return wide.unpivot("nm", list(bands), "band", "response").where(finite(F.col("nm")) & finite(F.col("response")) & (F.col("response") > 0)).select("band", "nm", "response")


def pick_sheet(names: Sequence[str], platform: str) -> str:
    """The first sheet that names spectral responses and the platform."""
    for name in names:
        if "Spectral Responses" in name and platform in name:
            return name
    raise ValueError(f"no sheet of {platform}")
