"""The test tables as pixel, band and acquisition tables (FIXTURES.md part B)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BANDS = 64


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spectra(spark, sf_dir) -> DataFrame:
    """(raster_id, row, col, spectrum, label) of 64 bands."""
    e = table(spark, sf_dir, "embeddings")
    values = F.transform("embedding", lambda v: v.cast("double") + 0.5)
    return e.select(F.lit("s").alias("raster_id"), F.floor(F.col("vec_id") / 25).cast("int").alias("row"), (F.col("vec_id") % 25).cast("int").alias("col"), values.alias("spectrum"), "label")


def bands(spark) -> DataFrame:
    b = F.col("id").cast("int")
    return spark.range(BANDS).select(b.alias("band_idx"), (F.lit(380.0) + b * F.lit(2100.0) / F.lit(63.0)).alias("center_nm"), ((b % 11) != 5).alias("good"))


def grid_fine(spark, sf_dir) -> DataFrame:
    """(row, col, v) with nodata and black cells."""
    e = table(spark, sf_dir, "events")
    v = F.when((F.col("event_type") == "error") & (F.col("value") > 40), F.lit(-9999.0)).when((F.col("event_type") == "signup") & (F.col("value") > 60), F.lit(0.0)).otherwise(F.col("value") / 500)
    return e.select(F.floor(F.col("event_id") / 100).cast("int").alias("row"), (F.col("event_id") % 100).cast("int").alias("col"), v.alias("v"))


def grid_coarse(spark, sf_dir) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    v = F.when((F.col("o_orderstatus") == "F") & (F.col("o_orderkey") % 7 == 0), F.lit(-9999.0)).otherwise(F.col("o_totalprice") / 1e6)
    return o.select(F.floor(F.col("o_orderkey") / 50).cast("int").alias("row"), (F.col("o_orderkey") % 50).cast("int").alias("col"), v.alias("v"))


def glt(spark, sf_dir) -> DataFrame:
    """(out_row, out_col, raw_row, raw_col), 1-based, 0 for no data."""
    o = table(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    return o.select(
        F.floor(k / 50).cast("int").alias("out_row"), (k % 50).cast("int").alias("out_col"), (F.col("o_custkey") % 25).cast("int").alias("raw_row"), ((k * 7) % 27).cast("int").alias("raw_col")
    )


def acquisitions_a(spark, sf_dir) -> DataFrame:
    """Hyperspectral granules: (id, ts, lon, lat, cloud, user_id)."""
    e = table(spark, sf_dir, "events").where("event_type = 'view'")
    return e.select(F.col("event_id").alias("id"), "ts", (F.col("user_id") * 2.4 - 180).alias("lon"), (F.col("user_id") % 60 - 30).cast("double").alias("lat"), F.col("value").alias("cloud"), "user_id")


def acquisitions_b(spark, sf_dir) -> DataFrame:
    """Multispectral items: (id, ts, lon, lat, cloud, user_id); cloud from JSON properties."""
    e = table(spark, sf_dir, "events").where("event_type = 'click'")
    cloud = F.get_json_object("props", "$.k").cast("double")
    return e.select(F.col("event_id").alias("id"), "ts", (F.col("user_id") * 2.4 - 180).alias("lon"), (F.col("user_id") % 60 - 30).cast("double").alias("lat"), cloud.alias("cloud"), "user_id")


def scl(spark, sf_dir) -> DataFrame:
    """(item, code): scene classes; ten pixels make an item."""
    return table(spark, sf_dir, "embeddings").select(F.floor(F.col("vec_id") / 10).cast("bigint").alias("item"), F.col("label").cast("int").alias("code"))
