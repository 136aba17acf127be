"""Granule cubes from tables of variables: alias lookup, masks, and joins with location and bands."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import NODATA
from ..operators import raster

#: First bytes of an HDF5 file (fixed value).
HDF5_MAGIC = b"\x89HDF\r\n\x1a\n"


def is_hdf5(content: Column) -> Column:
    """Whether binary content begins as an HDF5 file does."""
    return F.coalesce(F.substring(content, 1, 8) == F.lit(HDF5_MAGIC), F.lit(False))


def first_variable(df: DataFrame, names: Sequence[str]) -> str:
    """The first of ``names`` that is a column; a KeyError names what lacks."""
    found = next((n for n in names if n in df.columns), None)
    if found is None:
        raise KeyError(f"none of {', '.join(names)}")
    return found


def open_reflectance(df: DataFrame, names: Sequence[str] = ("reflectance", "RFL", "radiance"), fill: float = NODATA) -> DataFrame:
    """``df`` with spectrum, the first of the named arrays with its fill values as NULL."""
    own = first_variable(df, names)
    return df.withColumn("spectrum", F.transform(own, lambda v: F.nullif(v.cast("double"), F.lit(fill))))


def assemble(df: DataFrame, aliases: Sequence[Sequence[str]]) -> Column:
    """An array of one variable for each list of aliases, in order; a list without any column is a KeyError."""
    return F.array(*[F.col(first_variable(df, names)).cast("double") for names in aliases])


def granule_cube(pixels: DataFrame, location: DataFrame | None = None, *, quality: Column | None = None, bits: Column | None = None, glt: DataFrame | None = None, nodata: float = NODATA) -> DataFrame:
    """Pixels (row, col, spectrum) with masks applied, the columns of ``location`` (row, col, ...) beside them, and orthorectified by ``glt``.

    ``quality`` is a pixel's mask (1 hides all bands), ``bits`` one of its bands.
    """
    out = pixels
    if quality is not None:
        out = out.withColumn("spectrum", raster.apply_mask(F.col("spectrum"), quality, nodata))
    if bits is not None:
        out = out.withColumn("spectrum", raster.apply_band_mask(F.col("spectrum"), bits, nodata))
    values = ["spectrum"]
    if location is not None:
        more = [c for c in location.columns if c not in ("row", "col")]
        out, values = out.join(location, ["row", "col"], "left"), [*values, *more]
    out = out.select("row", "col", *values)
    return out if glt is None else raster.orthorectify(glt, out, values, None)
