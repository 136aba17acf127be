"""Stretches, white balance and histogram matching over long tables (channel, v)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.columns import clip, finite


#: Ranges of values that ranks are counted in, and the values up to which Spark's own percentile buffers a group.
BINS, BUFFERED = 4096, 20_000_000


def _ranges(df: DataFrame, by: list[str], column: str) -> DataFrame:
    """``df`` with _bin, the range of ``column`` between its least and greatest in the group; groups are few."""
    ends = df.groupBy(*by).agg(F.min(column).alias("_lo"), F.max(column).alias("_hi"))
    met = df.join(F.broadcast(ends), by) if by else df.crossJoin(F.broadcast(ends))
    at = F.floor((F.col(column) - F.col("_lo")) / (F.col("_hi") - F.col("_lo")) * BINS)
    return met.withColumn("_bin", F.when(F.col("_hi") > F.col("_lo"), F.least(at, F.lit(BINS - 1))).otherwise(0).cast("int")).drop("_lo", "_hi")


def _before(rows: DataFrame, by: list[str], value: Column) -> DataFrame:
    """(by, _bin, _off): the sum of ``value`` in the ranges before; at most ``BINS`` rows a group meet in its window."""
    per = rows.groupBy(*by, "_bin").agg(F.sum(value).alias("_c"))
    order = Window.partitionBy(*by).orderBy("_bin").rowsBetween(Window.unboundedPreceding, -1)
    return per.select(*by, "_bin", F.coalesce(F.sum("_c").over(order), F.lit(0)).alias("_off"))


def ranked(df: DataFrame, by: list[str], valid: Column | None = None) -> DataFrame:
    """(by, v, n, before, _bin): the distinct finite values of a group, how often they occur and how many are smaller.

    Values are counted first; a window holds one range of a group's values.
    """
    ok = finite(F.col("v")) if valid is None else finite(F.col("v")) & valid
    rows = _ranges(df.where(ok).groupBy(*by, "v").agg(F.count("*").alias("n")), by, "v")
    order = Window.partitionBy(*by, "_bin").orderBy("v").rowsBetween(Window.unboundedPreceding, -1)
    within = F.coalesce(F.sum("n").over(order), F.lit(0))
    return rows.join(F.broadcast(_before(rows, by, F.col("n"))), [*by, "_bin"]).select(*by, "v", "n", (F.col("_off") + within).alias("before"), "_bin")


def percentiles(df: DataFrame, by: list[str], shares: dict[str, float], valid: Column | None = None, *, buffered: int = BUFFERED) -> DataFrame:
    """(by, one column for each share): exact percentiles of the finite v, linear between values.

    Up to ``buffered`` rows Spark's percentile holds a group's distinct values;
    beyond, ranks are counted over ranges, with the same result.
    """
    if df.count() <= buffered:
        ok = finite(F.col("v")) if valid is None else finite(F.col("v")) & valid
        return df.groupBy(*by).agg(*[F.percentile(F.when(ok, F.col("v")), F.lit(p)).alias(name) for name, p in shares.items()])
    rows = ranked(df, by, valid)
    total = rows.groupBy(*by).agg(F.sum("n").alias("_t"))
    met = rows.join(F.broadcast(total), by) if by else rows.crossJoin(F.broadcast(total))
    place = {name: F.lit(p) * (F.col("_t") - 1) for name, p in shares.items()}
    at = lambda r: F.max(F.when((F.col("before") <= r) & (r < F.col("before") + F.col("n")), F.col("v")))
    found = met.groupBy(*by, "_t").agg(*[at(f(x)).alias(f"_{k}_{name}") for name, x in place.items() for k, f in (("a", F.floor), ("b", F.ceil))])
    share = {name: x - F.floor(x) for name, x in place.items()}
    return found.select(*by, *[(F.col(f"_a_{name}") * (1 - w) + F.col(f"_b_{name}") * w).alias(name) for name, w in share.items()])


def _limits(df: DataFrame, by: list[str], low: float, high: float, valid: Column | None) -> DataFrame:
    return percentiles(df, by, {"lo": low / 100, "hi": high / 100}, valid)


def stretch(df: DataFrame, *, by: list[str] | None = None, low: float = 2, high: float = 98, eps: float = 1e-12, valid: Column | None = None, gamma: float | None = None) -> DataFrame:
    """``df`` with s, v stretched between two percentiles of its group.

    Statistics use finite (and ``valid``) values; the stretch applies to all.
    With ``eps`` 0 a constant group becomes 0.  Limits are a row for each
    group (channels or images: a bounded dimension), so they are broadcast.
    """
    by = by or []
    limits = _limits(df, by, low, high, valid)
    met = df.join(F.broadcast(limits), by) if by else df.crossJoin(F.broadcast(limits))
    span = F.col("hi") - F.col("lo")
    s = clip((F.col("v") - F.col("lo")) / (span + eps), 0.0, 1.0) if eps else F.when(span > 0, clip((F.col("v") - F.col("lo")) / span, 0.0, 1.0)).otherwise(F.when(F.col("v").isNotNull(), 0.0))
    return met.withColumn("s", F.pow(s, F.lit(1 / gamma)) if gamma else s).drop("lo", "hi")


def white_balance(df: DataFrame, gamma: float | None = 2.2) -> DataFrame:
    """``df`` with s: channels scaled to the mean of their means, clipped, then gamma."""
    means = df.groupBy("channel").agg(F.avg("v").alias("m"))
    scales = means.select("channel", (F.avg("m").over(Window.partitionBy(F.lit(1))) / F.greatest("m", F.lit(1e-6))).alias("k"))
    s = clip(F.col("v") * F.col("k"), 0.0, 1.0)
    return df.join(F.broadcast(scales), "channel").withColumn("s", F.pow(s, F.lit(1 / gamma)) if gamma else s).drop("k")


def histogram_match(source: DataFrame, reference: DataFrame, *, clip01: bool = False) -> DataFrame:
    """``source`` (channel, v) with s, its values under the reference's distribution of the same channel.

    A source value's inclusive cumulative share is interpolated in the
    reference's.  Only distinct values with counts are sorted, and windows hold
    one range of a channel's values, or of its shares.
    """
    by = ["channel"]

    def cdf(df: DataFrame, name: str) -> DataFrame:
        rows = ranked(df, by)
        total = F.broadcast(rows.groupBy(*by).agg(F.sum("n").alias("_t")))
        return rows.join(total, by).select("channel", "_bin", F.col("v").alias(name), ((F.col("before") + F.col("n")) / F.col("_t")).alias("q"))

    ref = cdf(reference, "r")
    # The value after the last of a range is the first of the next range.
    firsts = ref.groupBy("channel", "_bin").agg(F.min(F.struct("q", "r")).alias("first"))
    over = Window.partitionBy("channel").orderBy("_bin")
    firsts = firsts.select("channel", "_bin", F.lead("first").over(over).alias("after"), F.min("first").over(Window.partitionBy("channel")).getField("r").alias("lowest"))
    order = Window.partitionBy("channel", "_bin").orderBy("q")
    ref = ref.join(F.broadcast(firsts), ["channel", "_bin"]).withColumn("next", F.coalesce(F.lead(F.struct("q", "r")).over(order), "after"))
    point = F.struct("q", "r", F.col("next.q").alias("q2"), F.col("next.r").alias("r2"))
    share = F.least(F.floor(F.col("q") * BINS), F.lit(BINS - 1)).cast("int").alias("s_bin")
    points = ref.select("channel", share, "q", point.alias("p"), "lowest")
    lowest = F.broadcast(points.groupBy("channel").agg(F.first("lowest").alias("lowest")))
    both = cdf(source, "v").select("channel", share, "q", F.lit(1).alias("kind"), "v", F.lit(None).cast(points.schema["p"].dataType).alias("p")).unionByName(
        points.select("channel", "s_bin", "q", F.lit(0).alias("kind"), F.lit(None).cast("double").alias("v"), "p")
    )
    # The last point of the ranges before serves where a range has none yet.
    last = both.groupBy("channel", "s_bin").agg(F.max("p").alias("p"))
    earlier = Window.partitionBy("channel").orderBy("s_bin").rowsBetween(Window.unboundedPreceding, -1)
    last = last.select("channel", "s_bin", F.last("p", ignorenulls=True).over(earlier).alias("carried"))
    so_far = Window.partitionBy("channel", "s_bin").orderBy("q", "kind").rowsBetween(Window.unboundedPreceding, 0)
    met = both.select("channel", "s_bin", "kind", "q", "v", F.last("p", ignorenulls=True).over(so_far).alias("p")).where("kind = 1")
    met = met.join(F.broadcast(last), ["channel", "s_bin"]).withColumn("p", F.coalesce("p", "carried")).join(lowest, "channel")
    s = F.when(F.col("p").isNull(), F.col("lowest")).when(F.col("p.q2").isNull(), F.col("p.r")).otherwise(
        F.col("p.r") + (F.col("q") - F.col("p.q")) / (F.col("p.q2") - F.col("p.q")) * (F.col("p.r2") - F.col("p.r"))
    )
    mapped = met.select("channel", "v", (clip(s, 0.0, 1.0) if clip01 else s).alias("s"))
    return source.join(mapped, ["channel", "v"], "left")
