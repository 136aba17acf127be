"""Queries of metadata, masks, grids, windows and cubes, and their DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import columns as fc
from ..operators import catalog, geometry, raster, spectral
from ..sources import cube, fixtures as fx
from ..sources import documents as docs_out
from .queries import ACQ_A, ACQ_B, BANDS, COARSE, FINE, GLT, SPECTRA, r6
from .queries import SQL as IMAGERY

QUERIES: dict = {}
SQL: dict = {}


def query(name: str, sql: str | None):
    def add(f):
        QUERIES[name] = f
        if sql is not None:
            SQL[name] = sql
        return f

    return add


# --- catalogue ---------------------------------------------------------------

_ISO = "strftime(ts,'%Y-%m-%dT%H:%M:%S')"


@query("item_date", f"WITH {ACQ_A} SELECT id, CASE WHEN id%3=1 THEN (ts + INTERVAL 7 HOUR)::DATE ELSE ts::DATE END AS date FROM a")
def item_date(spark, d):
    iso = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss")
    a = fx.acquisitions_a(spark, d).select("id", F.when(F.col("id") % 3 == 0, F.concat(iso, F.lit("Z"))).alias("provider"), F.when(F.col("id") % 3 == 1, F.concat(iso, F.lit("-07:00"))).alias("datetime"), iso.alias("start_time"))
    return a.select("id", catalog.item_date(F.col("provider"), F.col("datetime"), F.col("start_time")).alias("date"))


@query("to_utc", f"WITH {ACQ_A} SELECT id, strftime(date_trunc('second', ts) - to_minutes(CASE id%4 WHEN 2 THEN 330 WHEN 3 THEN -210 ELSE 0 END), '%Y-%m-%d %H:%M:%S') AS utc FROM a")
def to_utc(spark, d):
    end = F.element_at(F.array(*map(F.lit, ("", "Z", "+05:30", "-0330"))), (F.col("id") % 4 + 1).cast("int"))
    a = fx.acquisitions_a(spark, d).select("id", F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"), end).alias("t"))
    return a.select("id", F.date_format(catalog.utc(F.col("t")), "yyyy-MM-dd HH:mm:ss").alias("utc"))


@query("bbox_guard", f"WITH {ACQ_B} SELECT id, CASE WHEN id%3<>0 THEN round(lon,6) END AS l, CASE WHEN id%3<>0 THEN round(lon+1,6) END AS cx, CASE WHEN id%3<>0 THEN round(lat+0.5,6) END AS cy FROM b")
def bbox_guard(spark, d):
    values = F.array(F.col("lon"), F.col("lat"), F.col("lon") + 2, F.col("lat") + 1)
    b = fx.acquisitions_b(spark, d).select("id", catalog.box(F.when(F.col("id") % 3 == 0, F.slice(values, 1, 3)).otherwise(values)).alias("x"))
    return b.select("id", r6("x.l").alias("l"), r6(catalog.box_center(F.col("x")).lon).alias("cx"), r6(catalog.box_center(F.col("x")).lat).alias("cy"))


@query("closed_rings", f"WITH {ACQ_A} SELECT id, 1 + (id%2=0)::INT AS n_rings, 4 + CASE WHEN id%2=0 THEN 5 ELSE 0 END AS n_points FROM a")
def closed_rings(spark, d):
    p = lambda x, y: F.struct((F.col("lon") + x).alias("lon"), (F.col("lat") + y).alias("lat"))
    box = geometry.box_ring(F.col("lon"), F.col("lat"), F.col("lon") + 1, F.col("lat") + 1)
    open_, line = F.array(p(0, 0), p(1, 0), p(1, 1)), F.array(p(0, 0), p(1, 0))
    rings = F.when(F.col("id") % 2 == 0, F.array(box, line, open_)).otherwise(F.array(open_, line))
    a = fx.acquisitions_a(spark, d).select("id", geometry.closed_rings(rings).alias("x"))
    return a.select("id", F.size("x").alias("n_rings"), F.aggregate("x", F.lit(0), lambda s, r: s + F.size(r)).alias("n_points"))


@query("stac_intersects", f"WITH {ACQ_B} SELECT id FROM b WHERE lon > -40.3 AND lon < 55.7 AND lat > -12.5 AND lat < 20.5 AND ts BETWEEN TIMESTAMP '2024-01-05' AND TIMESTAMP '2024-01-25'")
def stac_intersects(spark, d):
    ring = geometry.box_ring(*map(F.lit, (-40.3, -12.5, 55.7, 20.5)))
    return catalog.stac_search(fx.acquisitions_b(spark, d), start="2024-01-05", stop="2024-01-25", intersects=ring).select("id")


# The edges of the box of 300 km around the point lie far from any granule's centre.
@query("find_candidates", f"WITH {ACQ_A} SELECT id FROM a WHERE abs(lon-0.1) < 3.5 AND abs(lat+14.9) < 2.5 AND ts BETWEEN TIMESTAMP '2024-01-01' AND TIMESTAMP '2024-12-31' AND cloud BETWEEN 0 AND 100")
def find_candidates(spark, d):
    return catalog.find_candidates(fx.acquisitions_a(spark, d), lon=0.1, lat=-14.9, radius=300_000.0, start="2024-01-01", stop="2024-12-31").select("id")


@query("band_aliases", f"WITH {ACQ_B} SELECT id, CASE id%3 WHEN 0 THEN 'B08' WHEN 1 THEN 'nir' ELSE 'NIR08' END AS b08, CASE id%3 WHEN 0 THEN 'red-JP2' END AS b04 FROM b")
def band_aliases(spark, d):
    m = lambda *k: F.create_map(*[F.lit(x) for n in k for x in (n, "h")])
    i = F.col("id") % 3
    assets = F.when(i == 0, m("B08", "nir", "red-JP2")).when(i == 1, m("nir", "nir08")).otherwise(m("NIR08", "thumb"))
    found = catalog.band_aliases(assets, {"b08": ("B08", "nir", "nir08"), "b04": ("B04", "red")})
    return fx.acquisitions_b(spark, d).select("id", found.alias("x")).select("id", "x.*")


@query("true_colour_assets", f"WITH {ACQ_B} SELECT id, CASE id%3 WHEN 0 THEN 'visual' WHEN 1 THEN 'b04,B03,B02' END AS keys FROM b")
def true_colour_assets(spark, d):
    m = lambda *k: F.create_map(*[F.lit(x) for n in k for x in (n, "h")])
    i = F.col("id") % 3
    assets = F.when(i == 0, m("visual", "B04")).when(i == 1, m("b04", "B03", "B02")).otherwise(m("B04", "B02"))
    return fx.acquisitions_b(spark, d).select("id", F.array_join(catalog.true_colour_assets(assets), ",").alias("keys"))


@query("product_level", f"WITH {ACQ_A} SELECT id, CASE id%3 WHEN 0 THEN 'L1B' WHEN 1 THEN 'L2A' END AS level FROM a")
def product_level(spark, d):
    i = F.col("id") % 3
    names = F.when(i == 0, F.array(F.lit("radiance"), F.lit("obs"))).when(i == 1, F.array(F.lit("reflectance"))).otherwise(F.array(F.lit("mask")))
    return fx.acquisitions_a(spark, d).select("id", catalog.product_level(names).alias("level"))


# --- documents -----------------------------------------------------------------

@query("item_summary", f"WITH {ACQ_B} SELECT id, {_ISO} || 'Z' AS datetime, 's' || id%2 AS platform, cloud, CASE WHEN id%5=0 THEN id%360::INT END AS sun_azimuth, round(lon+1,6) AS cx FROM b")
def item_summary(spark, d):
    i = F.col("id")
    pairs = F.array(
        F.struct(F.lit("datetime").alias("k"), F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"), F.lit("Z")).alias("v")), F.struct(F.lit("platform").alias("k"), F.concat(F.lit("s"), (i % 2).cast("string")).alias("v")),
        F.struct(F.lit("eo:cloud_cover").alias("k"), F.col("cloud").cast("string").alias("v")), F.struct(F.lit("view:sun_azimuth").alias("k"), F.when(i % 5 == 0, (i % 360).cast("string")).alias("v")),
    )
    raw = fx.acquisitions_b(spark, d).select("id", F.map_from_entries(pairs).alias("properties"), F.array("lon", "lat", F.col("lon") + 2, F.col("lat") + 1).alias("bbox"))
    s = docs_out.item_summary(raw)
    return s.select("id", "datetime", "platform", F.try_element_at("clouds", F.lit("eo:cloud_cover")).cast("double").alias("cloud"), F.try_element_at("sun", F.lit("view:sun_azimuth")).cast("bigint").alias("sun_azimuth"), r6("center.lon").alias("cx"))


@query("pair_documents", f"WITH {ACQ_A} SELECT ts::DATE AS date, id, CASE WHEN id%2=0 THEN 'i' || id END AS item_id FROM a")
def pair_documents(spark, d):
    a = fx.acquisitions_a(spark, d).select(F.to_date("ts").alias("date"), "id", F.when(F.col("id") % 2 == 0, F.concat(F.lit("i"), F.col("id"))).alias("item_id"))
    doc = F.from_json("document", "date string, id bigint, item_id string")
    return docs_out.pair_documents(a).select("date", doc.alias("x")).select("date", "x.id", "x.item_id")


@query("wavelengths_json", f"WITH {BANDS} SELECT 'nm' AS units, (band_idx)::INT AS pos, round(center_nm,6) AS wl FROM bands")
def wavelengths_json(spark, d):
    doc = docs_out.wavelengths_document(fx.bands(spark)).select(F.from_json("document", "wavelength_units string, wavelengths_nm array<double>").alias("x"))
    return doc.select(F.col("x.wavelength_units").alias("units"), F.posexplode("x.wavelengths_nm").alias("pos", "wl")).withColumn("wl", r6(F.col("wl")))


@query("is_hdf5", "SELECT page_id, page_id%3=0 AS hdf5 FROM pages")
def is_hdf5(spark, d):
    p = fx.table(spark, d, "pages")
    content = F.when(F.col("page_id") % 3 == 0, F.concat(F.lit(cube.HDF5_MAGIC), F.col("html").cast("binary"))).when(F.col("page_id") % 3 == 1, F.col("html").cast("binary"))
    return p.select("page_id", cube.is_hdf5(content).alias("hdf5"))


# --- spectral --------------------------------------------------------------------

@query("wl_by_units", f"WITH {BANDS} SELECT band_idx, round(CASE WHEN band_idx%4 IN (1,2) THEN center_nm*1000 ELSE center_nm END,6) AS wl FROM bands")
def wl_by_units(spark, d):
    units = F.element_at(F.array(*map(F.lit, ("nm", "Micrometers", "um", "furlongs"))), (F.col("band_idx") % 4 + 1).cast("int"))
    return fx.bands(spark).select("band_idx", r6(spectral.units_to_nm(F.col("center_nm"), units)).alias("wl"))


@query("band_dimension", f"WITH {BANDS} SELECT band_idx, round(center_nm::FLOAT::DOUBLE,3) AS center_nm, good FROM bands")
def band_dimension(spark, d):
    b = F.array_sort(F.collect_list(F.struct("band_idx", "center_nm", "good")))
    one = fx.bands(spark).agg(F.transform(b, lambda x: x.center_nm).alias("wavelengths"), F.transform(b, lambda x: x.good.cast("int")).alias("good"))
    return spectral.band_dimension(one).select("band_idx", r6(F.col("center_nm").cast("double"), 3).alias("center_nm"), "good")


_NEAR = "(SELECT min(band_idx)+1 FROM bands WHERE abs(round(center_nm,2)-{0}) = (SELECT min(abs(round(center_nm,2)-{0})) FROM bands))::INT"


@query("wl_descriptions", f"WITH {BANDS} SELECT 'a' AS raster_id, 665.0::DOUBLE AS target, {_NEAR.format('665.0')} AS band UNION ALL SELECT 'a', 560.0, {_NEAR.format('560.0')} UNION ALL SELECT 'b', 665.0, 55 UNION ALL SELECT 'b', 560.0, 36")
def wl_descriptions(spark, d):
    b = fx.bands(spark)
    a = b.select(F.lit("a").alias("raster_id"), "band_idx", F.concat(F.lit("band "), F.when(F.col("band_idx") % 2 == 0, F.format_string("%.2f", "center_nm")).otherwise(F.format_string("%.5f um", F.round("center_nm", 2) / 1000))).alias("description"))
    return spectral.wavelengths_from_descriptions(a.unionByName(b.select(F.lit("b").alias("raster_id"), "band_idx", F.when(F.col("band_idx") < 9, F.lit("700 nm")).alias("description"))), (665.0, 560.0))


@query("band_map", "SELECT DISTINCT 'r' || s_nationkey AS raster_id, 'B' || s_suppkey%12 AS code, max(s_suppkey+1) OVER (PARTITION BY s_nationkey, s_suppkey%12) AS band FROM supplier")
def band_map(spark, d):
    s = fx.table(spark, d, "supplier")
    rows = s.select(F.concat(F.lit("r"), F.col("s_nationkey")).alias("raster_id"), F.col("s_suppkey").alias("band_idx"), F.concat(F.lit("b"), (F.col("s_suppkey") % 12).cast("string"), F.lit("_red_x")).alias("description"))
    return spectral.band_map(rows)


# --- masks and tiles -----------------------------------------------------------

@query("mask_apply", f"WITH {SPECTRA} SELECT row, col, round(CASE WHEN label=3 THEN -9999 ELSE s[5] END,6) AS v FROM spectra")
def mask_apply(spark, d):
    s = fx.spectra(spark, d)
    return s.select("row", "col", r6(F.get(raster.apply_mask(F.col("spectrum"), (F.col("label") == 3).cast("int")), F.lit(4))).alias("v"))


@query("band_mask_apply", f"WITH {SPECTRA} SELECT row, col, b::INT AS b, round(CASE WHEN (row+b)%5=0 THEN -9999 ELSE s[b+1] END,6) AS v FROM spectra, range(64) t(b)")
def band_mask_apply(spark, d):
    bits = F.transform(F.sequence(F.lit(0), F.lit(63)), lambda b: ((F.col("row") + b) % 5 == 0).cast("int"))
    return fx.spectra(spark, d).select("row", "col", F.posexplode(raster.apply_band_mask(F.col("spectrum"), bits)).alias("b", "v")).withColumn("v", r6(F.col("v")))


@query("black_exact", f"WITH {FINE} SELECT row, col, v=-9999 AS black, v=0 AS black_without FROM fine")
def black_exact(spark, d):
    v = F.array("v", "v")
    return fx.grid_fine(spark, d).select("row", "col", raster.is_black_exact(v, fc.NODATA).alias("black"), raster.is_black_exact(v, None).alias("black_without"))


@query("invalid_mask", f"WITH {FINE} SELECT row, col, (abs(v+9999)<=1e-6+1e-5*9999 OR abs(v)<1e-6) AS invalid FROM fine")
def invalid_mask(spark, d):
    return fx.grid_fine(spark, d).select("row", "col", raster.is_invalid(F.array("v", "v")).alias("invalid"))


@query("rgb_validity", f"WITH {FINE}, {COARSE} SELECT row, col, fine.v>0 AS every, fine.v>0 OR coarse.v>0 AS some FROM fine JOIN coarse USING (row,col)")
def rgb_validity(spark, d):
    both = raster.stack_bands([fx.grid_fine(spark, d), fx.grid_coarse(spark, d)])
    return both.select("row", "col", raster.valid_rgb(F.col("spectrum")).alias("every"), raster.valid_rgb(F.col("spectrum"), every=False).alias("some"))


@query("rgb_u8", f"WITH {SPECTRA} SELECT row, col, floor(s[3]*100)::SMALLINT AS r, floor(s[2]*100)::SMALLINT AS g, floor(s[1]*100)::SMALLINT AS b FROM spectra")
def rgb_u8(spark, d):
    raw = F.transform("spectrum", lambda v: F.floor(v * 100).cast("int"))
    x = fx.spectra(spark, d).select("row", "col", raster.rgb_u8(raw, (3, 2, 1)).alias("x"))
    return x.select("row", "col", *[F.get("x", F.lit(i)).alias(n) for i, n in enumerate("rgb")])


@query("block_size", "SELECT o_orderkey, CASE WHEN least(o_orderkey%600, o_custkey)>=256 THEN 256 WHEN least(o_orderkey%600, o_custkey)>=64 THEN 64 ELSE 16 END AS edge FROM orders")
def block_size(spark, d):
    return fx.table(spark, d, "orders").select("o_orderkey", raster.block_size(F.col("o_orderkey") % 600, F.col("o_custkey")).alias("edge"))


@query("grid_ratio", "SELECT o_orderkey, 60%(o_orderkey%20+1)=0 AND 60%(o_custkey%15+1)=0 AS fits FROM orders")
def grid_ratio(spark, d):
    o = fx.table(spark, d, "orders")
    return o.select("o_orderkey", raster.fits_grid((F.col("o_orderkey") % 20 + 1).cast("double"), -(F.col("o_custkey") % 15 + 1).cast("double")).alias("fits"))


@query("pick_grid", "SELECT 'g' || o_orderkey AS path FROM orders WHERE o_orderkey%10=7 AND o_custkey%4=2 ORDER BY o_orderkey LIMIT 1")
def pick_grid(spark, d):
    o = fx.table(spark, d, "orders").select(F.col("o_orderkey").alias("pos"), F.concat(F.lit("g"), F.col("o_orderkey")).alias("path"), (F.col("o_orderkey") % 10).alias("height"), (F.col("o_custkey") % 4).alias("width"))
    return raster.pick_grid(o, 7, 2)


_BAD = "(abs(v+9999)<=1e-6+1e-5*9999 OR abs(v)<1e-6)::INT::DOUBLE"


@query("overlapping_pairs", f"""WITH {FINE}, {COARSE}, t AS (SELECT r::INT AS tile_row, c::INT AS tile_col FROM (SELECT unnest(range((max(row)+1-10)//8+1)) AS r FROM coarse) a, range((50-10)//8+1) b(c)),
c AS (SELECT tile_row, tile_col, avg({_BAD}) AS ci FROM t JOIN coarse ON row BETWEEN tile_row*8 AND tile_row*8+9 AND col BETWEEN tile_col*8 AND tile_col*8+9 GROUP BY ALL HAVING count(*)=100),
f AS (SELECT tile_row, tile_col, avg({_BAD}) AS fi FROM t JOIN fine ON row BETWEEN tile_row*16 AND tile_row*16+19 AND col BETWEEN tile_col*16 AND tile_col*16+19 GROUP BY ALL HAVING count(*)=400)
SELECT tile_row*6+tile_col AS tile_id, tile_row, tile_col, round(ci,6) AS coarse_invalid, round(fi,6) AS fine_invalid FROM c JOIN f USING (tile_row, tile_col) WHERE ci<=0.16 AND fi<=0.16""")
def overlapping_pairs(spark, d):
    c, f = fx.grid_coarse(spark, d), fx.grid_fine(spark, d)
    shape = lambda g: tuple(g.agg(F.coalesce(F.max("row") + 1, F.lit(0)), F.coalesce(F.max("col") + 1, F.lit(0))).first())
    out = raster.overlapping_pairs(c, f, shape=shape(c), fine_shape=shape(f), size=10, scale=raster.whole_ratio(60.0, 30.0), overlap=0.2, max_invalid=0.16)
    return out.select("tile_id", "tile_row", "tile_col", r6("coarse_invalid"), r6("fine_invalid"))


@query("spectral_stack", f"WITH n AS ({IMAGERY['resample_nearest']}), u AS ({IMAGERY['upsample_bilinear']}) SELECT row, col, 10 AS bands, n.v AS b02, u.v AS b12 FROM n JOIN u USING (row,col)")
def spectral_stack(spark, d):
    coarse = fx.grid_coarse(spark, d)
    fine = raster.upsample_nearest(coarse, 2)
    sizes = {b: 10.0 if b in raster.TEN_METRES else 20.0 for b in raster.STACK}
    out = raster.spectral_stack({b: fine if sizes[b] == 10.0 else coarse for b in raster.STACK}, sizes)
    return out.select("row", "col", F.size("spectrum").alias("bands"), r6(F.get("spectrum", F.lit(0))).alias("b02"), r6(F.get("spectrum", F.lit(9)), 12).alias("b12"))


# --- windows, cubes and warps -------------------------------------------------

_TE = f"{ACQ_B}, e AS (SELECT id, id%977*3.7::DOUBLE-200.017 AS l, 4000000-(id%811*2.9::DOUBLE-100.013) AS t, 40.011+id%353*1.3::DOUBLE AS w, 30.007+id%211*2.1::DOUBLE AS h FROM b), s AS (SELECT id, floor(l/10+0.5)*10 AS sl, floor((l+w)/10+0.5)*10 AS sr, floor((4000000-t)/10+0.5) AS st, floor((4000000-t+h)/10+0.5) AS sb, l/10 AS c, (4000000-t)/10 AS k, w/10 AS w, h/10 AS h FROM e)"


def _windows(spark, d, **modes):
    i = F.col("id")
    e = fx.acquisitions_b(spark, d).select("id", (i % 977 * 3.7 - 200.017).alias("l"), (4000000 - (i % 811 * 2.9 - 100.013)).alias("t"), (40.011 + i % 353 * 1.3).alias("w"), (30.007 + i % 211 * 2.1).alias("h"))
    te = {"l": F.col("l"), "b": F.col("t") - F.col("h"), "r": F.col("l") + F.col("w"), "t": F.col("t")}
    own = {"x0": F.lit(0.0), "dx": F.lit(10.0), "y0": F.lit(4000000.0), "dy": F.lit(-10.0), "height": F.lit(150), "width": F.lit(200)}
    return e.select("id", raster.te_window(own, te, **modes).alias("x")).select("id", "x.*")


_CUT = "CASE WHEN least(r1,150)>greatest(r0,0) AND least(c1,200)>greatest(c0,0) THEN {0} END::INT"
_CUTS = ", ".join(f"{_CUT.format(v)} AS {n}" for v, n in (("greatest(r0,0)", "row0"), ("least(r1,150)", "row1"), ("greatest(c0,0)", "col0"), ("least(c1,200)", "col1")))


@query("te_window_cover", f"WITH {_TE}, q AS (SELECT id, floor(k+1e-9) AS r0, ceil(k+h-1e-9) AS r1, floor(c+1e-9) AS c0, ceil(c+w-1e-9) AS c1 FROM s) SELECT id, {_CUTS} FROM q")
def te_window_cover(spark, d):
    return _windows(spark, d)


@query("te_window_snap", f"WITH {_TE}, q AS (SELECT id, st AS r0, sb AS r1, sl/10 AS c0, sr/10 AS c1 FROM s) SELECT id, {_CUTS} FROM q")
def te_window_snap(spark, d):
    return _windows(spark, d, snap=True)


@query("te_window_round", f"WITH {_TE}, q AS (SELECT id, round_even(k,0) AS r0, round_even(k,0)+round_even(h,0) AS r1, round_even(c,0) AS c0, round_even(c,0)+round_even(w,0) AS c1 FROM s) SELECT id, {_CUTS} FROM q")
def te_window_round(spark, d):
    return _windows(spark, d, cover=False)


@query("overlap_windows", f"WITH {ACQ_B}, q AS (SELECT id, (id%30-10)::INT AS sx, (id%23-11)::INT AS sy FROM b) SELECT id, CASE WHEN id%4<>0 THEN greatest(sy,0) END AS a_row0, CASE WHEN id%4<>0 THEN least(40, 40+sy) END AS a_row1, CASE WHEN id%4<>0 THEN greatest(sx,0) END AS a_col0, CASE WHEN id%4<>0 THEN greatest(-sy,0) END AS b_row0, CASE WHEN id%4<>0 THEN greatest(-sx,0) END AS b_col0 FROM q")
def overlap_windows(spark, d):
    i = F.col("id")
    raster_at = lambda x, y, epsg: {"x0": x, "dx": F.lit(60.0), "y0": y, "dy": F.lit(-60.0), "height": F.lit(40), "width": F.lit(50), "epsg": epsg}
    own = raster_at(F.lit(500000.0), F.lit(4000000.0), F.lit(32611))
    other = raster_at(500000.0 + (i % 30 - 10) * 60.0, 4000000.0 - (i % 23 - 11) * 60.0, F.when(i % 4 == 0, 32612).otherwise(32611))
    x = fx.acquisitions_b(spark, d).select("id", raster.overlap_windows(own, other).alias("x"))
    return x.select("id", *[F.col(f"x.{s}.{c}").alias(f"{s}_{c}") for s, c in (("a", "row0"), ("a", "row1"), ("a", "col0"), ("b", "row0"), ("b", "col0"))])


@query("granule_cube", f"WITH {SPECTRA}, {GLT}, q AS (SELECT row, col, label, CASE WHEN label=2 OR (row+5)%7=0 THEN -9999 ELSE s[6] END AS v, row*0.5::DOUBLE AS lat FROM spectra) SELECT out_row, out_col, round(v,6) AS v, lat FROM glt LEFT JOIN q ON row=raw_row-1 AND col=raw_col-1 AND raw_row>0 AND raw_col>0")
def granule_cube(spark, d):
    s = fx.spectra(spark, d)
    bits = F.transform(F.sequence(F.lit(0), F.lit(63)), lambda b: ((F.col("row") + b) % 7 == 0).cast("int"))
    where = s.select("row", "col", (F.col("row") * 0.5).alias("lat"))
    out = cube.granule_cube(s, where, quality=(F.col("label") == 2).cast("int"), bits=bits, glt=fx.glt(spark, d))
    return out.select("out_row", "out_col", r6(F.get("spectrum", F.lit(5))).alias("v"), "lat")


@query("open_reflectance", f"WITH {FINE} SELECT row, col, round(nullif(v,-9999.0),6) AS v FROM fine")
def open_reflectance(spark, d):
    g = fx.grid_fine(spark, d).select("row", "col", F.array("v").alias("radiance"))
    return cube.open_reflectance(g).select("row", "col", r6(F.get("spectrum", F.lit(0))).alias("v"))


@query("scan_envi", f"WITH {SPECTRA} SELECT row, col, b::INT AS b, round((s[b+1])::FLOAT::DOUBLE,4) AS v FROM spectra, range(64) t(b)")
def scan_envi(spark, d):
    """A scene written as an ENVI file and read through the data source."""
    import os
    import tempfile
    from urllib.parse import urlparse

    from ..sources import envi

    spark.dataSource.register(envi.EnviSource)
    s = fx.spectra(spark, d)
    shape = s.agg(F.max("row") + 1, F.max("col") + 1).first()
    # In the folder that all executors share, if there is one: they read the file.
    shared = urlparse(spark.conf.get("spark.checkpoint.dir", "") or "")
    if shared.scheme not in ("", "file"):
        raise ValueError("an ENVI file needs a folder that all executors have mounted")
    if shared.path:
        os.makedirs(shared.path, exist_ok=True)
    folder = tempfile.mkdtemp(prefix="envi-", dir=shared.path or None)
    envi.write_envi(s, f"{folder}/scene.img", height=shape[0], width=shape[1], interleave="bsq", mask=True)
    out = spark.read.format("envi").option("mask", True).load(f"{folder}/scene.img")
    return out.select("row", "col", F.posexplode("spectrum").alias("b", "v")).withColumn("v", r6(F.col("v"), 4))


@query("wgs84_summary", None)
def wgs84_summary(spark, d):
    i = F.col("c_custkey")
    c = fx.table(spark, d, "customer").select("c_custkey", (32601 + i % 60 + 100 * (i % 2)).cast("int").alias("epsg"), (F.lit(400000.0) + i % 97 * 1000).alias("l"), (F.lit(4000000.0) + i % 89 * 1000).alias("b"))
    c = c.withColumns({"r": F.col("l") + 60000.0, "t": F.col("b") + 45000.0})
    return geometry.wgs84_summary(c).select("c_custkey", *[r6(F.col(n), 5).alias(n) for n in ("west", "south", "east", "north", "lon", "lat")])


@query("warp_utm", None)
def warp_utm(spark, d):
    grid = fx.grid_fine(spark, d).where("col < 100")
    out = raster.warp(grid, transform=(-117.2, 0.0006, 36.1, 0.0006), zone=11, south=False, extent=(482100.0, 3991500.0, 487500.0, 3994980.0), size=(58, 90))
    return out.withColumn("v", r6(F.col("v")))
