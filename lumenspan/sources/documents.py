"""Metadata documents: XML sidecars, tile documents, run names and the manifest file."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, MapType, StructType

#: The sidecar's corners: upper left, upper right, lower right, lower left.
CORNERS = (("l", "t"), ("r", "t"), ("r", "b"), ("l", "b"))


def _utc(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'")


def sidecar(rasters: DataFrame) -> DataFrame:
    """(raster_id, xml) of rows with raster_id, product, epsg, start, stop, dx, dy, l, b, r, t, height, width, bands, wavelengths.

    Missing (null) elements are left out, as are wavelengths where there are none.
    """
    corner = lambda x, y: F.struct(F.col(x).alias("Lon"), F.col(y).alias("Lat"))
    doc = F.struct(
        F.col("product").alias("ProductType"),
        F.struct(_utc(F.col("start")).alias("StartUTC"), _utc(F.col("stop")).alias("EndUTC")).alias("AcquisitionTime"),
        F.struct(F.concat(F.lit("EPSG:"), F.col("epsg").cast("string")).alias("EPSG"), F.struct(F.col("dx").alias("X"), F.col("dy").alias("Y")).alias("PixelSize")).alias("Geometry"),
        F.struct(*[corner(x, y).alias(f"Corner{i}") for i, (x, y) in enumerate(CORNERS, 1)]).alias("BoundingBoxLonLat"),
        F.struct(F.col("height").alias("Lines"), F.col("width").alias("Samples"), F.col("bands").alias("Bands")).alias("RasterShape"),
        F.when(F.size("wavelengths") > 0, F.struct(F.struct(F.lit("nanometers").alias("_units"), F.col("wavelengths").alias("Wavelength")).alias("Wavelengths"))).alias("Spectral"),
    )
    return rasters.select("raster_id", F.to_xml(doc, {"rowTag": "Product"}).alias("xml"))


def tile_document(tiles: DataFrame) -> DataFrame:
    """(idx, name, document): a JSON document for each row of the paired tiles, with windows, quality and files."""
    file = lambda s: F.format_string(f"tile_%03d_{s}.tif", F.col("idx"))
    doc = F.struct(
        F.col("idx").alias("tile_id"),
        F.struct(F.col("tile_row").alias("row"), F.col("tile_col").alias("col")).alias("window"),
        F.struct(F.col("coarse_black"), F.col("fine_black")).alias("quality"),
        F.struct(file("a").alias("coarse"), file("b").alias("fine")).alias("files"),
    )
    return tiles.select("idx", F.format_string("tile_%03d.json", F.col("idx")).alias("name"), F.to_json(doc).alias("document"))


def run_id(path: Column, prefix: str) -> Column:
    """A file's stem without the first occurrence of the product prefix."""
    stem = F.regexp_replace(F.element_at(F.split(path, "/"), -1), r"(?<=.)\.[^.]*$", "")
    at = F.locate(prefix, stem)
    return F.when((at == 0) | F.lit(not prefix), stem).otherwise(F.concat(F.substr(stem, F.lit(1), at - 1), F.substr(stem, at + F.lit(len(prefix)))))


def flat(rows: DataFrame) -> DataFrame:
    """``rows`` with nested columns as JSON text, as a CSV file needs them."""
    nested = (ArrayType, MapType, StructType)
    return rows.select(*[F.to_json(f.name).alias(f.name) if isinstance(f.dataType, nested) else F.col(f.name) for f in rows.schema.fields])


def write_manifest(rows: DataFrame, path: str) -> None:
    """One CSV file with a header under ``path``; existing output stays.  A manifest has a row a tile, so one file will do."""
    flat(rows).coalesce(1).write.mode("ignore").csv(path, header=True)


def wavelengths_document(bands: DataFrame) -> DataFrame:
    """(document): one JSON document with the wavelengths of (band_idx, center_nm) in band order."""
    listed = F.transform(F.array_sort(F.collect_list(F.struct("band_idx", "center_nm"))), lambda x: x.center_nm)
    return bands.agg(F.to_json(F.struct(F.lit("nm").alias("wavelength_units"), listed.alias("wavelengths_nm"))).alias("document"))


def pair_documents(pairs: DataFrame) -> DataFrame:
    """(date, document): a JSON entry for each pair (date, id, item_id, cloud, cloud_fraction, paths); missing values are null."""
    keys = ("id", "path", "cloud", "item_id", "cloud_fraction", "visual", "folder", "binary", "figure")
    named = F.struct(F.col("date").cast("string").alias("date"), *[F.col(k) for k in keys if k in pairs.columns])
    return pairs.select("date", F.to_json(named, {"ignoreNullFields": "false"}).alias("document"))


#: Properties that an item's summary groups, and the prefix that is cut from their names (fixed values).
ITEM_GROUPS = {
    "mgrs": ("grid:code", "mgrs:utm_zone", "mgrs:latitude_band", "mgrs:grid_square"),
    "clouds": ("eo:cloud_cover", "s2:cloud_shadow_percentage", "s2:medium_proba_clouds_percentage", "s2:high_proba_clouds_percentage", "s2:thin_cirrus_percentage"),
    "scene_percentages": (
        "s2:nodata_pixel_percentage", "s2:dark_features_percentage", "s2:vegetation_percentage", "s2:not_vegetated_percentage", "s2:water_percentage", "s2:unclassified_percentage",
        "s2:snow_ice_percentage",
    ),
    "sun": ("view:sun_azimuth", "view:sun_elevation"),
    "processing": ("s2:processing_baseline", "s2:generation_time"),
}


def item_summary(items: DataFrame) -> DataFrame:
    """(id, datetime, platform, and a map for each group of ``ITEM_GROUPS``, bounds, center) of (id, properties map, bbox array)."""
    from ..operators.catalog import box, box_center

    p = lambda k: F.try_element_at("properties", F.lit(k))
    groups = [F.create_map(*[x for k in names for x in (F.lit(k), p(k))]).alias(group) for group, names in ITEM_GROUPS.items()]
    bounds = box(F.col("bbox"))
    return items.select("id", p("datetime").alias("datetime"), p("platform").alias("platform"), p("proj:code").alias("projection"), *groups, bounds.alias("bounds"), box_center(bounds).alias("center"))


def granule_summary(granules: DataFrame) -> DataFrame:
    """(id, granule, date, cloud, begin_time) of (id, umm): the fixed summary of nested granule metadata."""
    at = F.col("umm.BeginningDateTime")
    return granules.select("id", F.col("umm.GranuleUR").alias("granule"), F.to_date(at).alias("date"), F.col("umm.CloudCover").alias("cloud"), _utc(at).alias("begin_time"))


def report(path: str, title: str, sections: list[tuple[str, list[str | None]]], *, append: bool = False) -> None:
    """A markdown report of titled sections; ``None`` lines are left out; ``append`` keeps what the file holds."""
    parts = [] if append else [f"# {title}\n"]
    for name, lines in sections:
        parts.append(f"\n## {name}\n" + "".join(f"- {line}\n" for line in lines if line is not None))
    with open(path, "a" if append else "w", encoding="utf-8") as f:
        f.write("".join(parts))
