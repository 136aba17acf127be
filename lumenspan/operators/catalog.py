"""Catalogue search, temporal and spatial matching, ranking of acquisition pairs.

Acquisitions are (id, ts, lon, lat, cloud, ...).  Interval joins carry a bucket
key, so they are planned as hash joins instead of nested loops.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.columns import circular_hours, solar_time
from .geometry import inside_ring, point_buffer, ring_bounds

CLOUD_CODES = (8, 9, 10)
#: Scene classes (fixed values).
SCL_CLASSES = (
    "no_data", "saturated_or_defective", "dark_area", "cloud_shadow", "vegetation", "not_vegetated",
    "water", "unclassified", "cloud_medium_probability", "cloud_high_probability", "thin_cirrus", "snow",
)


def search(items: DataFrame, *, start: str, stop: str, bbox: Sequence[float], cloud: tuple[float, float] = (0, 100)) -> DataFrame:
    """Items in a time range, a box and a cloud range; plain comparisons, which reach the scan."""
    west, south, east, north = bbox
    return items.where(
        (F.col("ts") >= F.lit(start).cast("timestamp_ntz")) & (F.col("ts") <= F.lit(stop).cast("timestamp_ntz"))
        & F.col("lon").between(west, east) & F.col("lat").between(south, north) & F.col("cloud").between(*cloud)
    )


def links_with(urls: DataFrame, tokens: Sequence[str], column: str = "url") -> DataFrame:
    """URLs whose last path segment contains one of ``tokens``."""
    name = F.element_at(F.split(column, "/"), -1)
    keep = F.lit(False)
    for t in tokens:
        keep |= F.contains(name, F.lit(t))
    return urls.where(keep)


def asset_key(assets: Column, base: str) -> Column:
    """The map key equal to ``base``, else to ``base-jp2``, whatever its case; NULL if neither is there."""
    found = lambda name: F.get(F.filter(F.map_keys(assets), lambda k: F.lower(k) == name.lower()), F.lit(0))
    return F.coalesce(found(base), found(f"{base}-jp2"))


def minimal_assets(assets: Column, keys: Sequence[str]) -> Column:
    return F.map_filter(assets, lambda k, _: k.isin(*keys))


def related_urls(urls: Column, types: Sequence[str]) -> Column:
    return F.filter(urls, lambda u: u["type"].isin(*types))


def item_date(provider: Column, *others: Column) -> Column:
    """The UTC date of the first of these times (ISO texts) that is there."""
    return F.to_date(utc(F.coalesce(provider, *others)))


def utc(text: Column) -> Column:
    """An ISO time as UTC timestamp_ntz: ``Z`` and offsets are applied, a time without either is UTC."""
    zoned = F.rlike(text, F.lit(r"(Z|[+-]\d{2}:?\d{2})$"))
    offset = F.regexp_extract(text, r"([+-])(\d{2}):?(\d{2})$", 0)
    minutes = F.when(offset == "", 0).otherwise(
        F.when(F.startswith(offset, F.lit("-")), -1).otherwise(1) * (F.try_to_number(F.substring(offset, 2, 2), F.lit("99")).cast("int") * 60 + F.try_to_number(F.substring(offset, -2, 2), F.lit("99")).cast("int"))
    )
    plain = F.when(zoned, F.regexp_replace(text, r"(Z|[+-]\d{2}:?\d{2})$", "")).otherwise(text).try_cast("timestamp_ntz")
    return plain - F.make_dt_interval(F.lit(0), F.lit(0), minutes, F.lit(0))


def box(values: Column) -> Column:
    """struct(l, b, r, t) of an array of four numbers, NULL for any other length."""
    at = lambda i: F.get(values, F.lit(i)).cast("double")
    return F.when(F.size(values) == 4, F.struct(at(0).alias("l"), at(1).alias("b"), at(2).alias("r"), at(3).alias("t")))


def box_center(bounds: Column) -> Column:
    return F.when(bounds.isNotNull(), F.struct(((bounds.l + bounds.r) / 2).alias("lon"), ((bounds.b + bounds.t) / 2).alias("lat")))


def stac_search(items: DataFrame, *, start: str, stop: str, bbox: Sequence[float] | None = None, intersects: Column | None = None, max_cloud: float | None = None, limit: int | None = None) -> DataFrame:
    """Items (id, ts, lon, lat, cloud) in a closed time range, a box or a ring, and below a cloud share; the first ``limit`` by id."""
    out = items.where((F.col("ts") >= F.lit(start).cast("timestamp_ntz")) & (F.col("ts") <= F.lit(stop).cast("timestamp_ntz")))
    if bbox is not None:
        out = out.where(F.col("lon").between(bbox[0], bbox[2]) & F.col("lat").between(bbox[1], bbox[3]))
    if intersects is not None:
        out = out.where(inside_ring(F.col("lon"), F.col("lat"), intersects))
    if max_cloud is not None:
        out = out.where(F.col("cloud") < max_cloud)
    return out if limit is None else out.orderBy("id").limit(limit)


def find_candidates(items: DataFrame, *, lon: float, lat: float, radius: float, start: str, stop: str, cloud: tuple[float, float] = (0, 100)) -> DataFrame:
    """:func:`search` in the box around a point that is ``radius`` metres wide to each side."""
    point = items.sparkSession.createDataFrame([(float(lon), float(lat))], "lon double, lat double")
    at = point_buffer(point, radius).select(ring_bounds(F.col("ring")).alias("x")).first().x
    return search(items, start=start, stop=stop, bbox=(at.l, at.b, at.r, at.t), cloud=cloud)


def file_records(records: Column) -> Column:
    """(name, size_bytes, format, checksum) of archive records; missing fields are NULL."""
    return F.transform(records, lambda x: F.struct(x["Name"].alias("name"), x["SizeInBytes"].alias("size_bytes"), x["Format"].alias("format"), x["Checksum"].alias("checksum")))


def band_aliases(assets: Column, aliases: dict[str, Sequence[str]]) -> Column:
    """A struct with the asset key of every band, the first alias that is there."""
    return F.struct(*[F.coalesce(*[asset_key(assets, a) for a in names]).alias(band) for band, names in aliases.items()])


def true_colour_assets(assets: Column) -> Column:
    """The keys to read for a true-colour image: ``visual``, else B04, B03 and B02 together; NULL if one lacks."""
    bands = [asset_key(assets, b) for b in ("B04", "B03", "B02")]
    whole = bands[0].isNotNull() & bands[1].isNotNull() & bands[2].isNotNull()
    return F.when(asset_key(assets, "visual").isNotNull(), F.array(asset_key(assets, "visual"))).when(whole, F.array(*bands))


def product_level(variables: Column) -> Column:
    """``L2A`` where a reflectance variable is among the names, ``L1B`` for radiance, NULL for neither."""
    return F.when(F.array_contains(variables, "radiance"), "L1B").when(F.array_contains(variables, "reflectance"), "L2A")


def cloud_or_infinity(cloud: Column) -> Column:
    return F.coalesce(cloud.try_cast("double"), F.lit(float("inf")))


def best_per_date(items: DataFrame, *, max_cloud: float = 50.0) -> DataFrame:
    """The least cloudy item of each UTC date, the first of equals, if it is clear enough."""
    d = items.withColumn("date", F.to_date("ts"))
    order = Window.partitionBy("date").orderBy(cloud_or_infinity(F.col("cloud")), "id")
    return d.withColumn("_k", F.row_number().over(order)).where("_k = 1").where(cloud_or_infinity(F.col("cloud")) <= max_cloud).drop("_k")


def nearest_in_time(items: DataFrame, target: str) -> DataFrame:
    delta = F.abs(F.unix_micros(F.col("ts").cast("timestamp")) - F.unix_micros(F.lit(target).cast("timestamp")))
    return items.withColumn("delta_us", delta).orderBy("delta_us", "id").limit(1)


def asof_nearest(left: DataFrame, right: DataFrame, *, key: str) -> DataFrame:
    """(id, other_id, delta_us): for each left row the nearest right row of the same key, the smaller id of equals.

    One window over the union of both sides finds the neighbours before and
    after, so a hot key costs a sort, not a product.
    """
    us = F.unix_micros(F.col("ts").cast("timestamp"))
    none = F.lit(None).cast("struct<t:bigint,i:bigint>")
    a = left.select(F.col(key).alias("k"), us.alias("t"), F.col("id"), F.lit(1).alias("kind"), none.alias("p"))
    firsts = right.groupBy(F.col(key).alias("k"), us.alias("t")).agg(F.min("id").alias("i"))
    b = firsts.select("k", "t", F.lit(None).cast("bigint").alias("id"), F.lit(0).alias("kind"), F.struct("t", "i").alias("p"))
    back = Window.partitionBy("k").orderBy("t", "kind").rowsBetween(Window.unboundedPreceding, 0)
    ahead = Window.partitionBy("k").orderBy(F.col("t").desc(), "kind").rowsBetween(Window.unboundedPreceding, 0)
    met = a.unionByName(b).select("k", "id", "t", "kind", F.last("p", ignorenulls=True).over(back).alias("x"), F.last("p", ignorenulls=True).over(ahead).alias("y")).where("kind = 1")
    dx, dy = F.col("t") - F.col("x.t"), F.col("y.t") - F.col("t")
    take_x = F.col("y").isNull() | (dx < dy) | ((dx == dy) & (F.col("x.i") <= F.col("y.i")))
    return met.select("id", F.when(take_x & F.col("x").isNotNull(), F.col("x.i")).otherwise(F.col("y.i")).alias("other_id"), F.when(take_x & F.col("x").isNotNull(), dx).otherwise(dy).alias("delta_us"))


def in_day_window(left: DataFrame, right: DataFrame, days: int, near: float | None = None) -> DataFrame:
    """Pairs (a, b structs) within ``days`` days, and with ``near`` within so many degrees of longitude and latitude.

    Right rows are dealt to the days that they can meet, left rows to the
    cells around their own, so the join has a key of day and cell.
    """
    reach = F.sequence(F.date_sub(F.to_date("ts"), days), F.date_add(F.to_date("ts"), days))
    apart = F.abs(F.unix_micros(F.col("a.ts").cast("timestamp")) - F.unix_micros(F.col("b.ts").cast("timestamp"))) <= days * 86_400_000_000
    if near is None:
        cells, own = F.array(F.lit(0)), F.lit(0)
    else:
        # Cells are at least as wide as the reach and wrap around in longitude.
        across = max(1, int(360 // near))
        x, y = F.floor((F.col("lon") + 180) * (across / 360)), F.floor((F.col("lat") + 90) / near)
        cell = lambda i, j: F.pmod(x + i, F.lit(across)) * 100_000 + y + j
        cells, own = F.array_distinct(F.array(*[cell(i, j) for i in (-1, 0, 1) for j in (-1, 0, 1)])), cell(0, 0)
        dx = F.abs(F.col("a.lon") - F.col("b.lon"))
        apart &= (F.abs(F.col("a.lat") - F.col("b.lat")) <= near) & (F.least(dx, 360 - dx) <= near)
    a = left.select(F.struct(*left.columns).alias("a"), F.to_date("ts").alias("_day"), F.explode(cells).alias("_cell"))
    b = right.select(F.struct(*right.columns).alias("b"), F.explode(reach).alias("_day"), own.alias("_cell"))
    return a.join(b, ["_day", "_cell"]).where(apart).drop("_day", "_cell")


def best_pair(
    granules: DataFrame, items: DataFrame, scenes: DataFrame, *, days: int = 3, max_hours: float = 1.5, min_overlap: float = 0.6, top: int = 20, overlap: Column | None = None,
    near: float | None = None,
) -> DataFrame:
    """(id, item_id, cloud_fraction, reason): the best item for each granule, and why there is none.

    Candidates within ``days`` and ``max_hours`` of solar time that overlap
    enough are ranked by (solar time difference, overlap, cloud); the best
    ``top`` meet their scene statistics (item, cloud_fraction) of
    :func:`scene_clouds`, and the best of those by (difference, overlap, scene
    cloud) is taken; a scene without valid pixels counts as wholly cloudy.
    ``near`` bounds the distance of the centres in degrees and keys the join.
    """
    lon = F.col("a.lon")
    tod = circular_hours(solar_time(F.col("a.ts"), lon), solar_time(F.col("b.ts"), lon))
    share = overlap if overlap is not None else F.lit(1.0)
    pairs = in_day_window(granules, items, days, near).select(F.col("a.id").alias("id"), F.col("b.id").alias("item_id"), tod.alias("tod"), share.alias("overlap"), F.coalesce("b.cloud", F.lit(999.0)).alias("meta"))
    timed = pairs.where(F.col("tod") <= max_hours)
    fitting = timed.where(F.col("overlap") >= min_overlap)
    order = Window.partitionBy("id").orderBy("tod", F.desc("overlap"), "meta", "item_id")
    ranked = fitting.withColumn("k", F.row_number().over(order)).where(F.col("k") <= top)
    seen = ranked.join(scenes, ranked.item_id == scenes.item).select("id", "item_id", "tod", "overlap", "k", F.coalesce("cloud_fraction", F.lit(1.0)).alias("cloud_fraction"))
    last = Window.partitionBy("id").orderBy("tod", F.desc("overlap"), "cloud_fraction", "k")
    best = seen.withColumn("_r", F.row_number().over(last)).where("_r = 1").select("id", "item_id", "cloud_fraction")
    counts = pairs.groupBy("id").agg(
        F.count("*").alias("n"), F.count(F.when(F.col("tod") <= max_hours, 1)).alias("n_timed"), F.count(F.when((F.col("tod") <= max_hours) & (F.col("overlap") >= min_overlap), 1)).alias("n_fit")
    )
    reason = (
        F.when(F.col("item_id").isNotNull(), "ok").when(F.coalesce("n", F.lit(0)) == 0, "no_candidates").when(F.col("n_timed") == 0, "no_time_match").when(F.col("n_fit") == 0, "no_overlap").otherwise("no_scene")
    )
    return granules.select("id").join(counts, "id", "left").join(best, "id", "left").select("id", "item_id", "cloud_fraction", reason.alias("reason"))


def same_day_pair(granules: DataFrame, items: DataFrame, scenes: DataFrame) -> DataFrame:
    """(id, item_id, cloud_fraction): the item of the same UTC date with the least scene cloud."""
    a = granules.select("id", F.to_date("ts").alias("d"))
    b = items.select(F.col("id").alias("item_id"), F.to_date("ts").alias("d")).join(scenes, F.col("item_id") == scenes.item).select("item_id", "d", F.coalesce("cloud_fraction", F.lit(1.0)).alias("cloud_fraction"))
    order = Window.partitionBy("d").orderBy("cloud_fraction", "item_id")
    best = b.withColumn("k", F.row_number().over(order)).where("k = 1")
    return a.join(best, "d").select("id", "item_id", "cloud_fraction")


def scl_metrics(scl: DataFrame, *, codes: Sequence[int] = CLOUD_CODES) -> DataFrame:
    """(item, clouds, valid, total, cloud_fraction) from (item, code) pixels; NULL share without valid pixels."""
    g = scl.groupBy("item").agg(F.count(F.when(F.col("code").isin(*codes), 1)).alias("clouds"), F.count(F.when(F.col("code") != 0, 1)).alias("valid"), F.count("*").alias("total"))
    return g.select("*", F.when(F.col("valid") > 0, F.col("clouds") / F.col("valid")).alias("cloud_fraction"))


def class_counts(scl: DataFrame) -> DataFrame:
    """(item, class, n) with a row of class ``total`` for each item."""
    names = F.array(*map(F.lit, SCL_CLASSES))
    r = scl.select("item", F.get(names, F.col("code")).alias("class")).rollup("item", "class").agg(F.count("*").alias("n"), F.grouping("class").alias("g"), F.grouping("item").alias("h"))
    return r.where("h = 0").select("item", F.when(F.col("g") == 1, "total").otherwise(F.col("class")).alias("class"), "n")


def cloud_count(scl: DataFrame) -> DataFrame:
    """(item, clouds, total): snow counts as cloud, and only pixels with data count."""
    v = F.col("code") != 0
    return scl.groupBy("item").agg(F.count(F.when(v & F.col("code").isin(8, 9, 10, 11), 1)).alias("clouds"), F.count(F.when(v, 1)).alias("total"))


def scene_clouds(scl: DataFrame) -> DataFrame:
    """(item, cloud_fraction) of (item, code, assets): the share of cloud or snow, 1 without valid pixels.

    Items whose class asset lacks or is a JP2 are left out, as the pairing can't read them.
    """
    key = F.lower(asset_key(F.col("assets"), "scl"))
    usable = scl.where(key.isNotNull() & (key != "scl-jp2"))
    return cloud_count(usable).select("item", F.when(F.col("total") > 0, F.col("clouds") / F.col("total")).otherwise(1.0).alias("cloud_fraction"))


def clean_items(scl: DataFrame) -> DataFrame:
    return cloud_count(scl).where("clouds = 0").select("item")


def adjacent(scenes: DataFrame, *, by: str) -> DataFrame:
    """(by, adjacent): whether the scene numbers of a group follow each other; true for a single scene."""
    d = F.col("scene") - F.lag("scene").over(Window.partitionBy(by).orderBy("pos"))
    return scenes.withColumn("d", d).groupBy(by).agg(F.coalesce(F.bool_and(F.when(F.col("d").isNotNull(), F.col("d") == 1)), F.lit(True)).alias("adjacent"))


def scene_number(name: Column) -> Column:
    """The number after the last ``_`` of the second last part of a dotted name."""
    return F.element_at(F.split(F.element_at(F.split(name, r"\."), -2), "_"), -1).cast("int")
