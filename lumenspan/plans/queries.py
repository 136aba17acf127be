"""Queries over the test tables, one for each operator, and their DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import columns as fc
from ..operators import catalog, fit, geometry, radiometry, raster, spectral
from ..sources import cube
from ..sources import documents as docs_out
from ..sources import fixtures as fx
from ..sources import geotiff

QUERIES: dict = {}
SQL: dict = {}

# Shared parts of the SQL.
SPECTRA = "spectra AS (SELECT (vec_id//25)::INT AS row, (vec_id%25)::INT AS col, [x::DOUBLE + 0.5 for x in embedding] AS s, label FROM embeddings)"
LONG = SPECTRA + ", long AS (SELECT row, col, unnest(range(64))::INT AS b, unnest(s) AS v FROM spectra)"
BANDS = "bands AS (SELECT b::INT AS band_idx, 380.0::DOUBLE + b*2100.0::DOUBLE/63.0::DOUBLE AS center_nm, (b%11 <> 5) AS good FROM range(64) t(b))"
FINE = "fine AS (SELECT (event_id//100)::INT AS row, (event_id%100)::INT AS col, CASE WHEN event_type='error' AND value>40 THEN -9999.0::DOUBLE WHEN event_type='signup' AND value>60 THEN 0.0::DOUBLE ELSE value/500 END AS v FROM events)"
COARSE = "coarse AS (SELECT (o_orderkey//50)::INT AS row, (o_orderkey%50)::INT AS col, CASE WHEN o_orderstatus='F' AND o_orderkey%7=0 THEN -9999.0::DOUBLE ELSE o_totalprice/1e6 END AS v FROM orders)"
GLT = "glt AS (SELECT (o_orderkey//50)::INT AS out_row, (o_orderkey%50)::INT AS out_col, (o_custkey%25)::INT AS raw_row, ((o_orderkey*7)%27)::INT AS raw_col FROM orders)"
ACQ_A = "a AS (SELECT event_id AS id, ts, user_id*2.4::DOUBLE-180 AS lon, (user_id%60-30)::DOUBLE AS lat, value AS cloud, user_id FROM events WHERE event_type='view')"
ACQ_B = "b AS (SELECT event_id AS id, ts, user_id*2.4::DOUBLE-180 AS lon, (user_id%60-30)::DOUBLE AS lat, json_extract_string(props,'$.k')::DOUBLE AS cloud, user_id FROM events WHERE event_type='click')"
SCL = "scl AS (SELECT vec_id//10 AS item, label::INT AS code FROM embeddings)"
RADIO = "radio AS (SELECT event_type AS channel, value AS v FROM events)"
BEST = "best AS (SELECT id, ts, lon, lat, cloud, user_id FROM (SELECT *, row_number() OVER (PARTITION BY ts::DATE ORDER BY cloud, id) AS k FROM a) WHERE k=1 AND cloud<=50)"

#: Parts of each user's granules that box pairs join separately.
PAIR_SALTS = 8


def r6(c, digits: int = 6):
    return (F.round(c, digits) + 0.0) if not isinstance(c, str) else (F.round(F.col(c), digits) + 0.0).alias(c)


def query(name: str, sql: str | None):
    def add(f):
        QUERIES[name] = f
        if sql is not None:
            SQL[name] = sql
        return f

    return add


def _wavelengths():
    return [380 + b * 2100 / 63 for b in range(64)], [b % 11 != 5 for b in range(64)]


def _weights():
    w, good = _wavelengths()
    return spectral.response_weights(w, good, {n: spectral.triangular(w, c, h) for n, c, h in (("B4", 665, 30), ("B8", 842, 115), ("B12", 2190, 180))})


# --- spectral ---------------------------------------------------------------

_TRAPEZOID = """, n AS (SELECT *, lag(p) OVER w AS p0, lag(wt) OVER w AS w0, lag(center_nm) OVER w AS x0 FROM m WINDOW w AS (PARTITION BY row, col, band ORDER BY center_nm))
SELECT row, col, band, round(sum((center_nm-x0)*(p+p0)/2)/(sum((center_nm-x0)*(wt+w0)/2)+1e-32), 6) AS value FROM n GROUP BY ALL"""


@query("srf_integral", f"WITH {LONG}, {BANDS}, t(band,c,h) AS (VALUES ('B4',665.0,30.0),('B8',842.0,115.0),('B12',2190.0,180.0)), m AS (SELECT row, col, band, center_nm, greatest(0.0, 1-abs(center_nm-c)/h)*good::INT AS wt, v*greatest(0.0, 1-abs(center_nm-c)/h)*good::INT AS p FROM long JOIN bands ON b=band_idx CROSS JOIN t)" + _TRAPEZOID)
def srf_integral(spark, d):
    return spectral.synthesise(fx.spectra(spark, d), _weights()).select("row", "col", "band", r6("value"))


@query("srf_integral_arrow", SQL["srf_integral"])
def srf_integral_arrow(spark, d):
    made = spectral.synthesise_arrow(fx.spectra(spark, d), _weights())
    names = F.array(*map(F.lit, _weights()))
    return made.select("row", "col", F.explode(F.arrays_zip(names.alias("band"), F.col("values").alias("value"))).alias("x")).select("row", "col", "x.band", r6("x.value").alias("value"))


@query("box_integral", f"WITH {LONG}, {BANDS}, t(band,lo,hi) AS (VALUES ('B02',457.5,522.5),('B04',650.0,680.0),('B08',784.5,899.5),('B11',1565.0,1655.0),('B12',2100.0,2280.0)), m AS (SELECT row, col, band, center_nm, v FROM long JOIN bands ON b=band_idx JOIN t ON center_nm BETWEEN lo AND hi WHERE good), n AS (SELECT *, lag(v) OVER w AS v0, lag(center_nm) OVER w AS x0 FROM m WINDOW w AS (PARTITION BY row, col, band ORDER BY center_nm)), q AS (SELECT row, col, band, CASE WHEN count(*)>1 THEN round(sum((center_nm-x0)*(v+v0)/2)/(max(center_nm)-min(center_nm)), 6) END AS value FROM n GROUP BY ALL) SELECT s.row, s.col, t.band, value FROM spectra s CROSS JOIN t LEFT JOIN q USING (row, col, band)")
def box_integral(spark, d):
    w, good = _wavelengths()
    bands = {n: (c - h / 2, c + h / 2) for n, c, h in spectral.NOMINAL_BANDS if n in ("B02", "B04", "B08", "B11", "B12")}
    return spectral.synthesise(fx.spectra(spark, d), {n: spectral.box_weights(w, good, *x) for n, x in bands.items()}).select("row", "col", "band", r6("value"))


@query("rgb_stack", f"WITH {SPECTRA} SELECT row, col, round(least(greatest(s[10]/0.3,0),1),6) AS r, round(least(greatest(s[6]/0.3,0),1),6) AS g, round(least(greatest(s[4]/0.3,0),1),6) AS b FROM spectra")
def rgb_stack(spark, d):
    return spectral.rgb(fx.spectra(spark, d), 9, 5, 3).select("row", "col", r6("r"), r6("g"), r6("b"))


@query("nearest_band", f"WITH {BANDS}, t(target) AS (VALUES (665.0::DOUBLE),(842.0),(560.0),(396.66666666666663),(9000.0)), n AS (SELECT target, band_idx, center_nm, row_number() OVER (PARTITION BY target ORDER BY abs(center_nm-target), band_idx) AS k FROM bands, t) SELECT target, band_idx, round(center_nm,6) AS center_nm FROM n WHERE k=1")
def nearest_band(spark, d):
    targets = spark.createDataFrame([(665.0,), (842.0,), (560.0,), (396.66666666666663,), (9000.0,)], "target double")
    return spectral.nearest_band(fx.bands(spark), targets).select("target", "band_idx", r6("center_nm"))


@query("wl_intervals", f"WITH {BANDS}, x AS (SELECT 'all' AS subset, center_nm FROM bands UNION ALL SELECT 'good', center_nm FROM bands WHERE good), y AS (SELECT *, lead(center_nm) OVER (PARTITION BY subset ORDER BY center_nm)-center_nm AS st FROM x) SELECT subset, count(*) AS n, round(min(center_nm),6) AS min_nm, round(max(center_nm),6) AS max_nm, round(avg(st),6) AS mean_step, round(min(st),6) AS min_step, round(max(st),6) AS max_step FROM y GROUP BY subset")
def wl_intervals(spark, d):
    return spectral.wavelength_intervals(fx.bands(spark)).select("subset", "n", *map(r6, ("min_nm", "max_nm", "mean_step", "min_step", "max_step")))


@query("wl_units", f"WITH {BANDS} SELECT band_idx, round(center_nm, 6) AS center_nm FROM bands")
def wl_units(spark, d):
    return spectral.to_nm(fx.bands(spark).withColumn("center_nm", F.col("center_nm") / 1000)).select("band_idx", r6("center_nm"))


@query("wl_from_tags", f"WITH {BANDS} SELECT band_idx+1 AS band, round(center_nm,2) AS wl FROM bands")
def wl_from_tags(spark, d):
    tags = fx.bands(spark).select(F.concat(F.lit("Band_"), F.col("band_idx") + 1).alias("tag"), F.concat(F.format_string("%.2f", "center_nm"), F.lit(" Nanometers")).alias("value"))
    one = tags.agg(F.lit("r").alias("raster_id"), F.map_from_entries(F.collect_list(F.struct("tag", "value"))).alias("tags"))
    return spectral.wavelengths_from_tags(one).select("band", "wl")


@query("envi_list_parse", f"WITH {BANDS} SELECT band_idx AS pos, round(round(center_nm,2),2) AS wl FROM bands")
def envi_list_parse(spark, d):
    text = fx.bands(spark).agg(F.concat(F.lit("{"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("band_idx", F.format_string("%.2f", "center_nm").alias("s")))), lambda x: x.s), ", "), F.lit("}")).alias("t"))
    return text.select(F.posexplode(fc.envi_list(F.col("t"))).alias("pos", "wl"))


@query("find_band", "SELECT 3 AS band_idx, 'nir' AS kind UNION ALL SELECT 2, 'red' UNION ALL SELECT NULL, 'thermal'")
def find_band(spark, d):
    desc = spark.createDataFrame([(0, "B02 blue"), (1, "B03 green"), (2, "Red edge none, red B04"), (3, "B08 NIR"), (4, "b08a narrow nir")], "band_idx int, description string")
    kinds = {"nir": [["b08"], ["nir"]], "red": [["b04"], ["red"]], "thermal": [["b10"], ["thermal"]]}
    out = None
    for k, words in kinds.items():
        one = spectral.find_band(desc, words).withColumn("kind", F.lit(k))
        out = one if out is None else out.unionByName(one)
    return out


@query("max_variance_band", f"WITH {LONG} SELECT b AS band_idx, round(var_pop(v),6) AS variance FROM long GROUP BY b ORDER BY var_pop(v) DESC, b LIMIT 1")
def max_variance_band(spark, d):
    return spectral.max_variance_band(fx.spectra(spark, d)).select("band_idx", r6("variance"))


@query("band_subsample", f"WITH {SPECTRA}, i AS (SELECT k, round_even(k*63/15.0, 0)::INT AS b FROM range(16) t(k)) SELECT row, col, k::INT AS pos, round(s[b+1],6) AS v FROM spectra, i")
def band_subsample(spark, d):
    return spectral.select_bands(fx.spectra(spark, d), fc.even_bands(64, 16)).select("row", "col", F.posexplode("spectrum").alias("pos", "v")).withColumn("v", r6(F.col("v")))


@query("srf_load", "SELECT * FROM (VALUES ('B2',440.0::DOUBLE,0.1::DOUBLE),('B2',441.0,0.5),('B3',442.0,0.9)) t(band,nm,response)")
def srf_load(spark, d):
    sheet = spark.createDataFrame([("440", "0.1", None), ("441", "0.5", "0"), ("442", "x", "0.9"), (None, "0.3", "NaN")], "SR_WL string, S_SR_AV_B2 string, S_SR_AV_B3 string")
    return spectral.load_srf(sheet, "SR_WL", {"B2": "S_SR_AV_B2", "B3": "S_SR_AV_B3"})


@query("band_stack", f"WITH {FINE}, {COARSE} SELECT row, col, round(fine.v,6) AS b0, round(coarse.v,6) AS b1 FROM fine JOIN coarse USING (row, col)")
def band_stack(spark, d):
    s = raster.stack_bands([fx.grid_fine(spark, d), fx.grid_coarse(spark, d)])
    return s.select("row", "col", r6(F.get("spectrum", F.lit(0))).alias("b0"), r6(F.get("spectrum", F.lit(1))).alias("b1"))


@query("fill_to_null", f"WITH {FINE} SELECT row, col, round(nullif(v,-9999.0),6) AS v FROM fine")
def fill_to_null(spark, d):
    return fx.grid_fine(spark, d).select("row", "col", r6(F.nullif("v", F.lit(fc.NODATA))).alias("v"))


# --- catalogue ---------------------------------------------------------------

@query("catalog_search", f"WITH {ACQ_A} SELECT id, round(lon,6) AS lon, cloud FROM a WHERE ts BETWEEN TIMESTAMP '2024-01-05' AND TIMESTAMP '2024-01-20' AND lon BETWEEN -120 AND 40 AND lat BETWEEN -20 AND 20 AND cloud BETWEEN 0 AND 100")
def catalog_search(spark, d):
    return catalog.search(fx.acquisitions_a(spark, d), start="2024-01-05", stop="2024-01-20", bbox=(-120, -20, 40, 20)).select("id", r6("lon"), "cloud")


@query("stac_search_cloud_lt", f"WITH {ACQ_B} SELECT id, cloud FROM b WHERE cloud < 50 AND ts >= TIMESTAMP '2024-01-10' ORDER BY id LIMIT 20")
def stac_search_cloud_lt(spark, d):
    return catalog.stac_search(fx.acquisitions_b(spark, d), start="2024-01-10", stop="2100-01-01", max_cloud=50, limit=20).select("id", "cloud")


@query("asset_link_filter", "SELECT page_id FROM pages WHERE contains(string_split(url,'/')[-1],'page=') OR contains(string_split(url,'/')[-1],'#top')")
def asset_link_filter(spark, d):
    return catalog.links_with(fx.table(spark, d, "pages").select("page_id", "url"), ["page=", "#top"]).select("page_id")


@query("href_suffix", r"SELECT page_id, CASE WHEN e='' THEN '.tif' ELSE lower(e) END AS suffix FROM (SELECT page_id, regexp_extract(string_split(string_split(url,'?')[1],'/')[-1], '(\.[^.]+)$', 1) AS e FROM pages)")
def href_suffix(spark, d):
    return fx.table(spark, d, "pages").select("page_id", fc.href_suffix(F.col("url")).alias("suffix"))


def _assets(spark, d):
    b = fx.acquisitions_b(spark, d)
    lit = F.create_map(F.lit("B04"), F.lit("r"), F.lit("b08-JP2"), F.lit("n"), F.lit("SCL"), F.lit("s"), F.lit("thumb"), F.lit("t"))
    return b.select("id", F.when(F.col("id") % 2 == 0, lit).otherwise(F.create_map(F.lit("scl-jp2"), F.lit("s2"), F.lit("nir"), F.lit("n2"))).alias("assets"))


@query("best_asset_key", f"WITH {ACQ_B} SELECT id, CASE WHEN id%2=0 THEN 'SCL' ELSE 'scl-jp2' END AS scl_key, CASE WHEN id%2=0 THEN 'b08-JP2' ELSE 'nir' END AS nir_key FROM b")
def best_asset_key(spark, d):
    a = F.col("assets")
    return _assets(spark, d).select("id", catalog.asset_key(a, "scl").alias("scl_key"), F.coalesce(catalog.asset_key(a, "B08"), catalog.asset_key(a, "nir"), catalog.asset_key(a, "nir08")).alias("nir_key"))


@query("assets_minimal", f"WITH {ACQ_B} SELECT id, unnest(CASE WHEN id%2=0 THEN ['B04','SCL'] ELSE ['nir'] END) AS k FROM b")
def assets_minimal(spark, d):
    return _assets(spark, d).select("id", F.explode(F.map_keys(catalog.minimal_assets(F.col("assets"), ["B04", "SCL", "nir", "visual"]))).alias("k"))


@query("related_urls", f"WITH {ACQ_B} SELECT id, 'GET DATA' AS type, 'https://x/' || id AS url FROM b UNION ALL SELECT id, 'VIEW', 'https://y/' || id FROM b")
def related_urls(spark, d):
    u = lambda t, p: F.struct(F.lit(t).alias("type"), F.concat(F.lit(p), F.col("id")).alias("url"))
    urls = F.array(u("GET DATA", "https://x/"), u("OTHER", "https://z/"), u("VIEW", "https://y/"))
    return fx.acquisitions_b(spark, d).select("id", F.explode(catalog.related_urls(urls, ["GET DATA", "VIEW"])).alias("u")).select("id", "u.type", "u.url")


@query("file_records", f"WITH {ACQ_B} SELECT id, 'f' || id AS name, id*10 AS size_bytes, 'nc' AS format, CASE WHEN id%2=0 THEN upper(printf('%x', id)) END AS checksum FROM b")
def file_records(spark, d):
    rec = F.array(F.struct(F.concat(F.lit("f"), F.col("id")).alias("Name"), (F.col("id") * 10).alias("SizeInBytes"), F.lit("nc").alias("Format"), F.when(F.col("id") % 2 == 0, F.hex("id")).alias("Checksum")))
    return fx.acquisitions_b(spark, d).select("id", F.explode(catalog.file_records(rec)).alias("x")).select("id", "x.*")


@query("best_per_date", f"WITH {ACQ_A}, {BEST} SELECT id, ts::DATE AS date, cloud FROM best")
def best_per_date(spark, d):
    return catalog.best_per_date(fx.acquisitions_a(spark, d)).select("id", "date", "cloud")


@query("nearest_in_time", f"WITH {ACQ_A} SELECT id, abs(epoch_us(ts)-epoch_us(TIMESTAMP '2024-01-12 10:00:00')) AS delta_us FROM a ORDER BY 2, 1 LIMIT 1")
def nearest_in_time(spark, d):
    return catalog.nearest_in_time(fx.acquisitions_a(spark, d), "2024-01-12 10:00:00").select("id", "delta_us")


@query("asof_nearest", f"WITH {ACQ_A}, {ACQ_B}, n AS (SELECT a.id, b.id AS other_id, abs(epoch_us(a.ts)-epoch_us(b.ts)) AS delta_us FROM a JOIN b USING (user_id)), k AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY delta_us, other_id) AS r FROM n) SELECT a.id, other_id, delta_us FROM a LEFT JOIN (SELECT * FROM k WHERE r=1) x ON a.id = x.id")
def asof_nearest(spark, d):
    return catalog.asof_nearest(fx.acquisitions_a(spark, d), fx.acquisitions_b(spark, d), key="user_id")


@query("solar_time", f"WITH {ACQ_A}, t AS (SELECT id, hour(ts)+minute(ts)/60.0::DOUBLE+(second(ts)::INT)/3600.0::DOUBLE+lon/15.0::DOUBLE AS h FROM a) SELECT id, round(((h%24)+24)%24,6) AS h FROM t")
def solar_time(spark, d):
    return fx.acquisitions_a(spark, d).select("id", r6(fc.solar_time(F.col("ts"), F.col("lon"))).alias("h"))


@query("circ_diff", f"WITH {ACQ_A} SELECT id, round(least(m, 24-m),6) AS h FROM (SELECT id, abs(hour(ts)+minute(ts)/60.0::DOUBLE-23.5)%24 AS m FROM a)")
def circ_diff(spark, d):
    return fx.acquisitions_a(spark, d).select("id", r6(fc.circular_hours(F.hour("ts") + F.minute("ts") / F.lit(60.0), F.lit(23.5))).alias("h"))


#: Scenes with whole no-data ones, clear ones and ones whose class asset is a JP2 or lacks.
SCL2 = "scl2 AS (SELECT vec_id//10 AS item, CASE WHEN vec_id//10%7=0 THEN 0 WHEN vec_id//10%5=1 THEN 4 ELSE label END::INT AS code FROM embeddings)"
_SCENE = "scene AS (SELECT item, CASE WHEN count(*) FILTER (code<>0)=0 THEN 1.0 ELSE count(*) FILTER (code IN (8,9,10,11))/count(*) FILTER (code<>0)::DOUBLE END AS cf FROM scl2 WHERE item%11 NOT IN (3,4) GROUP BY item)"


def _scl2(spark, d):
    i = F.col("item")
    return fx.scl(spark, d).withColumn("code", F.when(i % 7 == 0, 0).when(i % 5 == 1, 4).otherwise(F.col("code")))


def _scenes(spark, d):
    i = F.col("item")
    assets = F.when(i % 11 == 3, F.create_map(F.lit("SCL-JP2"), F.lit("x"))).when(i % 11 == 4, F.create_map(F.lit("visual"), F.lit("x"))).otherwise(F.create_map(F.lit("scl"), F.lit("x")))
    return catalog.scene_clouds(_scl2(spark, d).withColumn("assets", assets)).select((i * 7).alias("item"), "cloud_fraction")


@query("best_pair", f"""WITH {ACQ_A}, {ACQ_B}, {BEST}, {SCL2}, {_SCENE},
p AS (SELECT a.id, b.id AS item_id, coalesce(b.cloud,999) AS meta, 1-abs(a.user_id-b.user_id)/150.0::DOUBLE AS ov,
 ((hour(a.ts)+minute(a.ts)/60.0::DOUBLE+(second(a.ts)::INT)/3600.0::DOUBLE+a.lon/15.0::DOUBLE)%24+24)%24 AS h1, ((hour(b.ts)+minute(b.ts)/60.0::DOUBLE+(second(b.ts)::INT)/3600.0::DOUBLE+a.lon/15.0::DOUBLE)%24+24)%24 AS h2
 FROM best a JOIN b ON abs(epoch_us(a.ts)-epoch_us(b.ts)) <= 3*86400000000 AND abs(a.lat-b.lat)<=70 AND least(abs(a.lon-b.lon), 360-abs(a.lon-b.lon))<=70),
q AS (SELECT id, item_id, meta, ov, least(abs(h1-h2)%24, 24-abs(h1-h2)%24) AS tod FROM p),
r AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY tod, ov DESC, meta, item_id) AS k FROM q WHERE tod<=1.5 AND ov>=0.6),
s AS (SELECT r.id, item_id, cf, row_number() OVER (PARTITION BY r.id ORDER BY tod, ov DESC, cf, k) AS z FROM r JOIN scene ON item_id = item*7 WHERE k<=20),
c AS (SELECT id, count(*) AS n, count(*) FILTER (tod<=1.5) AS nt, count(*) FILTER (tod<=1.5 AND ov>=0.6) AS nf FROM q GROUP BY id)
SELECT best.id, item_id, round(cf,6) AS cloud_fraction, CASE WHEN item_id IS NOT NULL THEN 'ok' WHEN coalesce(n,0)=0 THEN 'no_candidates' WHEN nt=0 THEN 'no_time_match' WHEN nf=0 THEN 'no_overlap' ELSE 'no_scene' END AS reason
FROM best LEFT JOIN c ON c.id=best.id LEFT JOIN (SELECT * FROM s WHERE z=1) s ON s.id=best.id""")
def best_pair(spark, d):
    granules = catalog.best_per_date(fx.acquisitions_a(spark, d)).drop("date")
    overlap = 1 - F.abs(F.col("a.user_id") - F.col("b.user_id")) / F.lit(150.0)
    return catalog.best_pair(granules, fx.acquisitions_b(spark, d), _scenes(spark, d), overlap=overlap, near=70.0).select("id", "item_id", r6("cloud_fraction"), "reason")


@query("same_day_pair", f"WITH {ACQ_A}, {ACQ_B}, {BEST}, {SCL2}, {_SCENE}, x AS (SELECT b.id AS item_id, ts::DATE AS d, cf, row_number() OVER (PARTITION BY ts::DATE ORDER BY cf, b.id) AS k FROM b JOIN scene ON b.id=item*7) SELECT best.id, item_id, round(cf,6) AS cloud_fraction FROM best JOIN x ON best.ts::DATE=d AND k=1")
def same_day_pair(spark, d):
    granules = catalog.best_per_date(fx.acquisitions_a(spark, d)).drop("date")
    return catalog.same_day_pair(granules, fx.acquisitions_b(spark, d), _scenes(spark, d)).select("id", "item_id", r6("cloud_fraction"))


@query("pair_filter", f"WITH {ACQ_A}, {ACQ_B}, {BEST}, {SCL2}, {_SCENE}, x AS (SELECT b.id AS item_id, ts::DATE AS d, cf, row_number() OVER (PARTITION BY ts::DATE ORDER BY cf, b.id) AS k FROM b JOIN scene ON b.id=item*7) SELECT best.id, item_id FROM best JOIN x ON best.ts::DATE=d AND k=1 WHERE cf<=0.3")
def pair_filter(spark, d):
    return same_day_pair(spark, d).where("item_id is not null and cloud_fraction <= 0.3").select("id", "item_id")


@query("adjacent_scenes", "WITH s AS (SELECT o_custkey AS k, o_orderkey AS pos, o_orderkey%3 AS scene FROM orders), t AS (SELECT k, scene-lag(scene) OVER (PARTITION BY k ORDER BY pos) AS d FROM s) SELECT k, coalesce(bool_and(d=1) FILTER (d IS NOT NULL), true) AS adjacent FROM t GROUP BY k")
def adjacent_scenes(spark, d):
    o = fx.table(spark, d, "orders")
    name = F.concat(F.lit("a.x_"), (F.col("o_orderkey") % 3).cast("string"), F.lit(".nc"))
    return catalog.adjacent(o.select(F.col("o_custkey").alias("k"), F.col("o_orderkey").alias("pos"), catalog.scene_number(name).alias("scene")), by="k")


@query("cloud_count", f"WITH {SCL} SELECT item, count(*) FILTER (code IN (8,9,10,11)) AS clouds, count(*) FILTER (code<>0) AS total FROM scl GROUP BY item")
def cloud_count(spark, d):
    return catalog.cloud_count(fx.scl(spark, d))


@query("clean_items", f"WITH {SCL2} SELECT item FROM scl2 GROUP BY item HAVING count(*) FILTER (code IN (8,9,10,11))=0")
def clean_items(spark, d):
    return catalog.clean_items(_scl2(spark, d))


@query("scl_metrics", f"WITH {SCL} SELECT item, count(*) FILTER (code IN (8,9,10)) AS clouds, count(*) FILTER (code<>0) AS valid, count(*) AS total, round(count(*) FILTER (code IN (8,9,10))/nullif(count(*) FILTER (code<>0),0)::DOUBLE,6) AS cloud_fraction FROM scl GROUP BY item")
def scl_metrics(spark, d):
    return catalog.scl_metrics(fx.scl(spark, d)).withColumn("cloud_fraction", r6(F.col("cloud_fraction")))


_NAMES = "[" + ",".join(f"'{n}'" for n in catalog.SCL_CLASSES) + "]"


@query("scl_classes", f"WITH {SCL} SELECT item, {_NAMES}[code+1] AS class, count(*) AS n FROM scl GROUP BY ALL UNION ALL SELECT item, 'total', count(*) FROM scl GROUP BY item")
def scl_classes(spark, d):
    return catalog.class_counts(fx.scl(spark, d))


@query("granule_summary", f"WITH {ACQ_A} SELECT id, 'G' || id AS granule, ts::DATE AS date, cloud, strftime(ts,'%Y-%m-%dT%H:%M:%SZ') AS begin_time FROM a")
def granule_summary(spark, d):
    g = fx.acquisitions_a(spark, d).select("id", F.struct(F.concat(F.lit("G"), F.col("id")).alias("GranuleUR"), F.col("cloud").alias("CloudCover"), F.col("ts").alias("BeginningDateTime")).alias("umm"))
    return docs_out.granule_summary(g)


# --- geometry ---------------------------------------------------------------

def _boxes(df):
    return df.select("id", "user_id", (F.col("lon") - 1).alias("l"), (F.col("lat") - 1).alias("b"), (F.col("lon") + 1.5).alias("r"), (F.col("lat") + 0.5).alias("t"))


_BOX = "l AS (SELECT id, user_id, lon-1 AS l, lat-1 AS b, lon+1.5 AS r, lat+0.5 AS t FROM {0})"


@query("footprint_bounds", f"WITH {ACQ_A}, x AS (SELECT id, lon-1 AS l, lat-1 AS b, lon+1.5 AS r, lat+0.5 AS t FROM a) SELECT id, round(l,6) AS l, round(b,6) AS b, round(r,6) AS r, round(t,6) AS t, round((l+r)/2,6) AS cx, round((b+t)/2,6) AS cy FROM x")
def footprint_bounds(spark, d):
    ring = geometry.box_ring(*[F.col(c) for c in "lbrt"])
    return _boxes(fx.acquisitions_a(spark, d)).select("id", geometry.ring_bounds(ring).alias("x")).select("id", *[r6(f"x.{c}").alias(c) for c in ("l", "b", "r", "t", "cx", "cy")])


@query("ring_area", f"WITH {ACQ_A}, x AS (SELECT id, lon-1 AS l, lat-1 AS b, lon+1.5 AS r, lat+0.5 AS t FROM a), k AS (SELECT {geometry.E2!r}::DOUBLE AS e2, {geometry._k0()!r}::DOUBLE AS k0, 6378137.0::DOUBLE AS ra), q AS (SELECT id, radians(r-l)*ra*k0 AS w, ra/(2*k0)*(1-e2)*(sin(radians(t))/(1-e2*sin(radians(t))**2)-ln((1-sqrt(e2)*sin(radians(t)))/(1+sqrt(e2)*sin(radians(t))))/(2*sqrt(e2))) AS y1, ra/(2*k0)*(1-e2)*(sin(radians(b))/(1-e2*sin(radians(b))**2)-ln((1-sqrt(e2)*sin(radians(b)))/(1+sqrt(e2)*sin(radians(b))))/(2*sqrt(e2))) AS y0 FROM x, k) SELECT id, round(w*(y1-y0)/1e6, 3) AS km2 FROM q")
def ring_area(spark, d):
    ring = geometry.box_ring(*[F.col(c) for c in "lbrt"])
    return _boxes(fx.acquisitions_a(spark, d)).select("id", r6(geometry.ring_area(ring) / 1e6, 3).alias("km2"))


def _box_pairs(spark, d):
    a, b = _boxes(fx.acquisitions_a(spark, d)), _boxes(fx.acquisitions_b(spark, d))
    o = b.select("user_id", F.struct("id", "l", "b", "r", "t").alias("o"))
    near = o.withColumn("user_id", F.explode(F.array(F.col("user_id"), F.col("user_id") + 1)))
    # A user of many granules is dealt over the salts.
    dealt = near.withColumn("salt", F.explode(F.array(*map(F.lit, range(PAIR_SALTS)))))
    return a.withColumn("salt", F.pmod(F.xxhash64("id"), F.lit(PAIR_SALTS)).cast("int")).join(dealt, ["user_id", "salt"]).drop("salt")


_PAIRS = f"{ACQ_A}, {ACQ_B}, o AS (SELECT user_id, id AS oid FROM b), bx AS (SELECT o.user_id, b.id AS oid, lon-1 AS l2, lat-1 AS b2, lon+1.5 AS r2, lat+0.5 AS t2 FROM o JOIN b ON b.id=oid), ax AS (SELECT id, user_id, lon-1 AS l1, lat-1 AS b1, lon+1.5 AS r1, lat+0.5 AS t1 FROM a), p AS (SELECT id, oid, greatest(l1,l2) AS l, greatest(b1,b2) AS b, least(r1,r2) AS r, least(t1,t2) AS t, b1, t1 FROM ax JOIN bx ON ax.user_id IN (bx.user_id, bx.user_id+1))"


_Q = f"(sin(radians({{0}}))/(1-{geometry.E2!r}*sin(radians({{0}}))**2)-ln((1-sqrt({geometry.E2!r})*sin(radians({{0}})))/(1+sqrt({geometry.E2!r})*sin(radians({{0}}))))/(2*sqrt({geometry.E2!r})))"


@query("overlap_frac", f"WITH {_PAIRS} SELECT id, oid, round(CASE WHEN r<=l OR t<=b THEN 0 ELSE (r-l)*({_Q.format('t')}-{_Q.format('b')})/(2.5*({_Q.format('t1')}-{_Q.format('b1')})) END,6) AS share FROM p")
def overlap_frac(spark, d):
    f = F.col
    share = geometry.box_overlap(tuple(f(c) for c in "lbrt"), tuple(f(f"o.{c}") for c in "lbrt"))
    return _box_pairs(spark, d).select("id", f("o.id").alias("oid"), r6(share).alias("share"))


@query("bounds_intersect", f"WITH {_PAIRS} SELECT id, oid, round(CASE WHEN r>l AND t>b THEN l END,6) AS l, round(CASE WHEN r>l AND t>b THEN b END,6) AS b, round(CASE WHEN r>l AND t>b THEN r END,6) AS r, round(CASE WHEN r>l AND t>b THEN t END,6) AS t FROM p")
def bounds_intersect(spark, d):
    f = F.col
    l, b, r, t, empty = geometry.intersect(tuple(f(c) for c in "lbrt"), tuple(f(f"o.{c}") for c in "lbrt"))
    return _box_pairs(spark, d).select("id", f("o.id").alias("oid"), *[r6(F.when(~empty, v)).alias(n) for n, v in zip("lbrt", (l, b, r, t), strict=True)])


@query("polygon_overlap", SQL["overlap_frac"].replace("AS share", "AS overlap"))
def polygon_overlap(spark, d):
    ring = lambda p: geometry.box_ring(*[F.col(f"{p}{c}") for c in "lbrt"])
    pairs = _box_pairs(spark, d).select("id", F.col("o.id").alias("oid"), ring("").alias("ra"), ring("o.").alias("rb"))
    return geometry.polygon_overlap(pairs, "ra", "rb").select("id", "oid", r6("overlap"))


@query("point_buffer", None)
def point_buffer(spark, d):
    c = fx.table(spark, d, "customer").select("c_custkey", (F.col("c_custkey") % 360 - 180).cast("double").alias("lon"), (F.col("c_custkey") % 120 - 60).cast("double").alias("lat"))
    return geometry.point_buffer(c, 5000.0).select("c_custkey", geometry.ring_bounds(F.col("ring")).alias("x")).select("c_custkey", *[r6(f"x.{k}").alias(k) for k in "lbrt"])


@query("utm_bounds", None)
def utm_bounds(spark, d):
    return geometry.bounds_in_utm(_boxes(fx.acquisitions_a(spark, d))).select("id", "epsg", *[r6(c, 3) for c in ("x0", "y0", "x1", "y1")])


@query("snap_inward", f"WITH {ACQ_A} SELECT id, ceil((lon*1000)/60-1e-9)*60 AS lo, floor((lon*1000+130)/60+1e-9)*60 AS hi FROM a")
def snap_inward(spark, d):
    lo, hi = fc.snap_inward(F.col("lon") * 1000, F.col("lon") * 1000 + 130, 0.0, 60.0)
    return fx.acquisitions_a(spark, d).select("id", lo.cast("double").alias("lo"), hi.cast("double").alias("hi"))


@query("snap_outward", f"WITH {ACQ_A} SELECT id, floor((lon*1000)/60+1e-9)*60 AS lo, ceil((lon*1000+130)/60-1e-9)*60 AS hi FROM a")
def snap_outward(spark, d):
    lo, hi = fc.snap_outward(F.col("lon") * 1000, F.col("lon") * 1000 + 130, 0.0, 60.0)
    return fx.acquisitions_a(spark, d).select("id", lo.cast("double").alias("lo"), hi.cast("double").alias("hi"))


@query("roi_mask", f"WITH {ACQ_A} SELECT id, abs(lon)/60+abs(lat)/25 < 1 AS inside FROM a WHERE abs(abs(lon)/60+abs(lat)/25-1) > 1e-9")
def roi_mask(spark, d):
    p = lambda x, y: F.struct(F.lit(float(x)).alias("lon"), F.lit(float(y)).alias("lat"))
    ring = F.array(p(60, 0), p(0, 25), p(-60, 0), p(0, -25), p(60, 0))
    a = fx.acquisitions_a(spark, d).where(F.abs(F.abs("lon") / 60 + F.abs("lat") / 25 - 1) > 1e-9)
    return a.select("id", geometry.inside_ring(F.col("lon"), F.col("lat"), ring).alias("inside"))


# --- rasters ----------------------------------------------------------------

@query("pixel_centers", f"WITH {COARSE} SELECT row, col, 500000+30+col*60.0::DOUBLE AS x, 4000000-30+row*-60.0::DOUBLE AS y FROM coarse")
def pixel_centers(spark, d):
    return raster.pixel_centers(fx.grid_coarse(spark, d), (500000.0, 60.0, 0.0, 4000000.0, 0.0, -60.0)).select("row", "col", "x", "y")


@query("raster_bounds", f"WITH {COARSE} SELECT 'c' AS raster_id, 500000.0::DOUBLE AS l, 4000000-60.0::DOUBLE*(max(row)+1) AS b, 500000+60.0::DOUBLE*(max(col)+1) AS r, 4000000.0::DOUBLE AS t FROM coarse")
def raster_bounds(spark, d):
    dim = fx.grid_coarse(spark, d).agg((F.max("row") + 1).alias("height"), (F.max("col") + 1).alias("width")).select(F.lit("c").alias("raster_id"), F.lit(500000.0).alias("x0"), F.lit(60.0).alias("dx"), F.lit(4000000.0).alias("y0"), F.lit(-60.0).alias("dy"), "height", "width")
    return raster.raster_bounds(dim)


@query("grid_template", "SELECT (i//50)::INT AS row, (i%50)::INT AS col, 0.0::DOUBLE AS v FROM range(15000) t(i)")
def grid_template(spark, d):
    return raster.grid_template(spark, 300, 50)


@query("glt_ortho", f"WITH {SPECTRA}, {GLT} SELECT out_row, out_col, round(coalesce(s[1],-9999.0),6) AS v FROM glt LEFT JOIN spectra ON row=raw_row-1 AND col=raw_col-1 AND raw_row>0 AND raw_col>0")
def glt_ortho(spark, d):
    raw = fx.spectra(spark, d).select("row", "col", F.get("spectrum", F.lit(0)).alias("v"))
    return raster.orthorectify(fx.glt(spark, d), raw, ["v"]).withColumn("v", r6(F.col("v")))


@query("glt_ortho_cube", f"WITH {SPECTRA}, {GLT} SELECT out_row, out_col, label, round(s[64],6) AS last FROM glt LEFT JOIN spectra ON row=raw_row-1 AND col=raw_col-1 AND raw_row>0 AND raw_col>0")
def glt_ortho_cube(spark, d):
    return raster.orthorectify(fx.glt(spark, d), fx.spectra(spark, d), ["spectrum", "label"], None).select("out_row", "out_col", "label", r6(F.get("spectrum", F.lit(63))).alias("last"))


@query("ortho_browse", f"WITH {SPECTRA}, {GLT} SELECT out_row, out_col, coalesce(label::DOUBLE,255.0) AS label FROM glt LEFT JOIN spectra ON row=raw_row-1 AND col=raw_col-1 AND raw_row>0 AND raw_col>0")
def ortho_browse(spark, d):
    return raster.orthorectify(fx.glt(spark, d), fx.spectra(spark, d).withColumn("label", F.col("label").cast("double")), ["label"], 255.0)


@query("glt_dropped", f"WITH {SPECTRA}, {GLT} SELECT count(*) AS n FROM glt WHERE raw_row>0 AND raw_col>0 AND NOT EXISTS (SELECT 1 FROM spectra WHERE row=raw_row-1 AND col=raw_col-1)")
def glt_dropped(spark, d):
    return raster.dropped_entries(fx.glt(spark, d), fx.spectra(spark, d))


@query("glt_subset", f"WITH {GLT}, o AS (SELECT * FROM glt WHERE out_row BETWEEN 20 AND 60 AND out_col BETWEEN 5 AND 30), m AS (SELECT min(raw_row) FILTER (raw_row>0 AND raw_col>0) AS r0, min(raw_col) FILTER (raw_row>0 AND raw_col>0) AS c0 FROM o) SELECT out_row, out_col, greatest(raw_row-(r0-1),0)::INT AS raw_row, greatest(raw_col-(c0-1),0)::INT AS raw_col FROM o, m")
def glt_subset(spark, d):
    return raster.subset_glt(fx.glt(spark, d), rows=(20, 60), cols=(5, 30))


@query("mosaic_first", f"WITH {FINE}, u AS (SELECT row, col, v, 0 AS p FROM fine UNION ALL SELECT row+20, col, v, 1 FROM fine) SELECT row, col, round(coalesce(arg_min(v,p) FILTER (v<>-9999),-9999.0),6) AS v FROM u GROUP BY row, col")
def mosaic_first(spark, d):
    g = fx.grid_fine(spark, d)
    return raster.mosaic([g, g.withColumn("row", F.col("row") + 20)]).withColumn("v", r6(F.col("v")))


@query("downsample_avg", f"WITH {FINE} SELECT (row//6)::INT AS row, (col//6)::INT AS col, round(avg(v)*0.5,6) AS v FROM fine GROUP BY ALL HAVING count(*)=36")
def downsample_avg(spark, d):
    return raster.downsample_average(fx.grid_fine(spark, d), 6, 0.5).withColumn("v", r6(F.col("v")))


@query("upsample_bilinear", f"WITH {COARSE}, dst AS (SELECT r::INT AS row, c::INT AS col, (r+0.5::DOUBLE)/2-0.5 AS y, (c+0.5::DOUBLE)/2-0.5 AS x FROM (SELECT unnest(range(2*(max(row)+1))) AS r FROM coarse) t, range(100) u(c)), n AS (SELECT row, col, floor(y)::INT+i AS sr, floor(x)::INT+j AS sc, (1-abs(y-floor(y)-i))*(1-abs(x-floor(x)-j)) AS w FROM dst, range(2) a(i), range(2) b(j)) SELECT n.row, n.col, round(sum(w*v)/sum(w),12) AS v FROM n JOIN coarse k ON k.row=sr AND k.col=sc WHERE v<>-9999 AND w>0 GROUP BY ALL")
def upsample_bilinear(spark, d):
    return raster.upsample_bilinear(fx.grid_coarse(spark, d), 2).withColumn("v", r6(F.col("v"), 12))


@query("resample_nearest", f"WITH {COARSE} SELECT (row*2+i)::INT AS row, (col*2+j)::INT AS col, round(v,6) AS v FROM coarse, range(2) a(i), range(2) b(j)")
def resample_nearest(spark, d):
    return raster.upsample_nearest(fx.grid_coarse(spark, d), 2).select("row", "col", r6("v"))


@query("warp_cubic", f"WITH {COARSE}, dst AS (SELECT r::INT AS row, c::INT AS col, (r+0.5::DOUBLE)/2-0.5 AS y, (c+0.5::DOUBLE)/2-0.5 AS x FROM (SELECT unnest(range(2*(max(row)+1))) AS r FROM coarse) t, range(100) u(c)), n AS (SELECT row, col, floor(y)::INT+i-1 AS sr, floor(x)::INT+j-1 AS sc, abs(y-floor(y)-i+1) AS dy, abs(x-floor(x)-j+1) AS dx FROM dst, range(4) a(i), range(4) b(j)), m AS (SELECT row, col, sr, sc, (CASE WHEN dy<=1 THEN (1.5*dy-2.5)*dy*dy+1 WHEN dy<2 THEN ((-0.5*dy+2.5)*dy-4)*dy+2 ELSE 0 END)*(CASE WHEN dx<=1 THEN (1.5*dx-2.5)*dx*dx+1 WHEN dx<2 THEN ((-0.5*dx+2.5)*dx-4)*dx+2 ELSE 0 END) AS w FROM n) SELECT m.row, m.col, round(sum(w*v)/sum(w),6)+0.0 AS v FROM m JOIN coarse k ON k.row=sr AND k.col=sc WHERE v<>-9999 GROUP BY ALL HAVING abs(sum(w))>1e-12")
def warp_cubic(spark, d):
    return raster.upsample_cubic(fx.grid_coarse(spark, d), 2).withColumn("v", r6(F.col("v")))


@query("crop_overlap", f"WITH {FINE}, {COARSE}, m AS (SELECT least((SELECT max(row) FROM fine), (SELECT max(row) FROM coarse)) AS r, least((SELECT max(col) FROM fine), (SELECT max(col) FROM coarse)) AS c) SELECT row-5 AS row, col-3 AS col, round(v,6) AS v FROM fine, m WHERE row BETWEEN 5 AND r AND col BETWEEN 3 AND c")
def crop_overlap(spark, d):
    f, c = fx.grid_fine(spark, d), fx.grid_coarse(spark, d)
    m = [x.agg(F.max("row").alias("r"), F.max("col").alias("c")).first() for x in (f, c)]
    return raster.crop(f, (5, min(m[0].r, m[1].r) + 1), (3, min(m[0].c, m[1].c) + 1)).withColumn("v", r6(F.col("v")))


@query("crop_te", f"WITH {FINE} SELECT row-10 AS row, col-20 AS col, round(v,6) AS v FROM fine WHERE row>=10 AND row<40 AND col>=20 AND col<60")
def crop_te(spark, d):
    return raster.crop(fx.grid_fine(spark, d), (10, 40), (20, 60)).withColumn("v", r6(F.col("v")))


@query("quality_mask", "SELECT vec_id, least((vec_id%2)+((vec_id//4)%2),1)::INT AS m FROM embeddings")
def quality_mask(spark, d):
    flags = F.transform(F.sequence(F.lit(0), F.lit(7)), lambda i: (F.floor(F.col("vec_id") / F.pow(F.lit(2), i)) % 2).cast("int"))
    return fx.table(spark, d, "embeddings").select("vec_id", raster.quality_mask(flags, [0, 2]).alias("m"))


@query("band_mask_unpack", "SELECT v.vec_id, k::INT AS k, ((((vec_id*37+k//8*101)%256)::INT >> (7-k%8)::INT) & 1)::INT AS bit FROM embeddings v, range(285) t(k)")
def band_mask_unpack(spark, d):
    packed = F.transform(F.sequence(F.lit(0), F.lit(35)), lambda i: ((F.col("vec_id") * 37 + i * 101) % 256).cast("int"))
    return fx.table(spark, d, "embeddings").select("vec_id", F.posexplode(raster.unpack_bits(packed)).alias("k", "bit"))


@query("black_mask", f"WITH {FINE} SELECT row, col, (abs(v+9999)<=0.10099 OR abs(v)<1e-6 OR abs(v+0.01)<=1e-3+1e-7) AS black FROM fine")
def black_mask(spark, d):
    return fx.grid_fine(spark, d).select("row", "col", raster.is_black(F.array("v")).alias("black"))


@query("flatten_pixels", f"WITH {FINE}, {COARSE} SELECT row, col, round(fine.v,6) AS x, round(coarse.v,6) AS y FROM fine JOIN coarse USING (row,col) WHERE abs(fine.v+9999)>0.2 AND abs(coarse.v+9999)>0.2")
def flatten_pixels(spark, d):
    one = lambda g: g.select("row", "col", F.array("v").alias("spectrum"))
    p = raster.flatten_pixels(one(fx.grid_fine(spark, d)), one(fx.grid_coarse(spark, d)))
    return p.select("row", "col", r6(F.get("x", F.lit(0))).alias("x"), r6(F.get("y", F.lit(0))).alias("y"))


@query("quantize_u16", f"WITH {LONG} SELECT row, col, b, greatest(least(round_even((v::FLOAT*10000::FLOAT)::DOUBLE,0),65534),0)::INT AS q FROM long")
def quantize_u16(spark, d):
    return fx.spectra(spark, d).select("row", "col", F.posexplode("spectrum").alias("b", "v")).select("row", "col", "b", fc.quantize_u16(F.col("v")).alias("q"))


@query("decode_u16", f"WITH {LONG} SELECT row, col, b, round(greatest(least(round_even((v::FLOAT*10000::FLOAT)::DOUBLE,0),65534),0)*(1/10000.0::DOUBLE),6) AS v FROM long")
def decode_u16(spark, d):
    return quantize_u16(spark, d).select("row", "col", "b", r6(fc.decode_u16(F.col("q"))).alias("v"))


@query("quantize_range", f"WITH {FINE}, m AS (SELECT min(v) FILTER (v<>-9999) AS lo, max(v) FILTER (v<>-9999) AS hi FROM fine) SELECT row, col, CASE WHEN v=-9999 THEN 0 ELSE round_even(least(greatest((v-lo)/(hi-lo),0),1)*65535,0)::INT END AS q FROM fine, m")
def quantize_range(spark, d):
    g = fx.grid_fine(spark, d).withColumn("v", F.nullif("v", F.lit(-9999.0)))
    m = g.agg(F.min("v").alias("lo"), F.max("v").alias("hi"))
    return g.crossJoin(F.broadcast(m)).select("row", "col", fc.quantize_range(F.col("v"), F.col("lo"), F.col("hi")).alias("q"))


@query("robust_minmax", f"WITH {FINE}, q AS (SELECT v FROM fine WHERE row%4=0 AND col%4=0 AND v<>-9999) SELECT round(quantile_cont(v,0.01),6) AS lo, round(quantile_cont(v,0.99),6) AS hi FROM q")
def robust_minmax(spark, d):
    return raster.robust_minmax(fx.grid_fine(spark, d), 4).select(r6("lo"), r6("hi"))


@query("scale_heuristic", f"WITH {FINE} SELECT row, col, round(CASE WHEN v=-9999 THEN v ELSE v*30 END / CASE WHEN v<>-9999 AND (SELECT max(v*30) FROM fine WHERE v<>-9999)>1.5 THEN 1e4 ELSE 1 END,8) AS v FROM fine")
def scale_heuristic(spark, d):
    g = fx.grid_fine(spark, d).withColumn("v", F.when(F.col("v") == -9999.0, F.col("v")).otherwise(F.col("v") * 30))
    return raster.scale_reflectance(g).select("row", "col", r6(F.col("v"), 8).alias("v"))


_BLACK = "(abs(v+9999)<=0.10099 OR abs(v)<1e-6 OR abs(v+0.01)<=1e-3+1e-7)::INT::DOUBLE"


@query("paired_tiles", f"WITH {FINE}, {COARSE}, c AS (SELECT row//5 AS tr, col//5 AS tc, avg({_BLACK}) AS cb FROM coarse GROUP BY ALL HAVING count(*)=25), f AS (SELECT row//10 AS tr, col//10 AS tc, avg({_BLACK}) AS fb FROM fine GROUP BY ALL HAVING count(*)=100), k AS (SELECT * FROM c JOIN f USING (tr,tc) WHERE cb<=0.15 AND fb<=0.15) SELECT (row_number() OVER (ORDER BY tr,tc)-1)::INT AS idx, tr::INT AS tile_row, tc::INT AS tile_col, round(cb,6) AS coarse_black, round(fb,6) AS fine_black FROM k")
def paired_tiles(spark, d):
    return raster.paired_tiles(fx.grid_coarse(spark, d), fx.grid_fine(spark, d), size=5, scale=2, max_black=0.15).select("idx", "tile_row", "tile_col", r6("coarse_black"), r6("fine_black"))


@query("sliding_tiles", f"WITH {FINE}, t AS (SELECT r::INT AS tile_row, c::INT AS tile_col FROM (SELECT unnest(range((max(row)+1-10)//9+1)) AS r FROM fine) a, range(11) b(c)) SELECT tile_row*11+tile_col AS tile_id, tile_row, tile_col, round(avg({_BLACK}),6) AS black FROM t JOIN fine ON row BETWEEN tile_row*9 AND tile_row*9+9 AND col BETWEEN tile_col*9 AND tile_col*9+9 GROUP BY ALL")
def sliding_tiles(spark, d):
    g = fx.grid_fine(spark, d)
    m = g.agg(F.coalesce(F.max("row") + 1, F.lit(0)).alias("height"), F.coalesce(F.max("col") + 1, F.lit(0)).alias("width")).first()
    return raster.sliding_tiles(g, height=m.height, width=m.width, size=10, overlap=0.1).withColumn("black", r6(F.col("black")))


@query("manifest", SQL["paired_tiles"].replace("SELECT (row_number() OVER (ORDER BY tr,tc)-1)::INT AS idx, tr::INT AS tile_row, tc::INT AS tile_col, round(cb,6) AS coarse_black, round(fb,6) AS fine_black FROM k", "SELECT (row_number() OVER (ORDER BY tr,tc)-1)::INT AS idx, format('tile_{:03d}_a.tif', row_number() OVER (ORDER BY tr,tc)-1) AS coarse_file, format('tile_{:03d}_b.tif', row_number() OVER (ORDER BY tr,tc)-1) AS fine_file FROM k"))
def manifest(spark, d):
    name = lambda s: F.format_string(f"tile_%03d_{s}.tif", F.col("idx"))
    return paired_tiles(spark, d).select("idx", name("a").alias("coarse_file"), name("b").alias("fine_file"))


@query("tile_documents", f"WITH p AS ({SQL['paired_tiles']}) SELECT idx, format('tile_{{:03d}}.json', idx) AS name, format('tile_{{:03d}}_b.tif', idx) AS fine_file, tile_row, coarse_black FROM p")
def tile_documents(spark, d):
    doc = F.col("document")
    return docs_out.tile_document(paired_tiles(spark, d)).select(
        "idx", "name", F.get_json_object(doc, "$.files.fine").alias("fine_file"), F.get_json_object(doc, "$.window.row").cast("int").alias("tile_row"),
        F.get_json_object(doc, "$.quality.coarse_black").cast("double").alias("coarse_black"),
    )


@query("xml_sidecar", None)
def xml_sidecar(spark, d):
    w, _ = _wavelengths()
    a = fx.acquisitions_a(spark, d)
    return docs_out.sidecar(a.select(
        F.col("id").cast("string").alias("raster_id"), F.lit("reflectance").alias("product"), F.lit(4326).alias("epsg"), F.col("ts").alias("start"), F.col("ts").alias("stop"), F.lit(0.01).alias("dx"), F.lit(-0.01).alias("dy"),
        (F.col("lon") - 1).alias("l"), (F.col("lat") - 1).alias("b"), (F.col("lon") + 1).alias("r"), (F.col("lat") + 1).alias("t"), F.lit(200).alias("height"), F.lit(200).alias("width"), F.lit(64).alias("bands"),
        F.array(*[F.lit(float(x)) for x in w]).alias("wavelengths"),
    ))


@query("run_ids", "SELECT page_id, CASE WHEN contains(stem,'page') THEN stem[1:position('page' IN stem)-1] || stem[position('page' IN stem)+4:] ELSE stem END AS run FROM (SELECT page_id, regexp_replace(split_part(url,'/',-1), '^(.+)\\.[^.]*$', '\\1') AS stem FROM pages)")
def run_ids(spark, d):
    return fx.table(spark, d, "pages").select("page_id", docs_out.run_id(F.col("url"), "page").alias("run"))


@query("scan_geotiff", SQL["quantize_u16"])
def scan_geotiff(spark, d):
    size = 5
    q = fx.spectra(spark, d).select("row", "col", F.transform("spectrum", lambda v: fc.quantize_u16(v)).alias("spectrum"))
    at = lambda c: F.floor(F.col(c) / size).cast("int")
    tiles = q.select(F.concat_ws("_", at("row"), at("col")).alias("path"), (F.col("row") % size).alias("row"), (F.col("col") % size).alias("col"), "spectrum")
    back = geotiff.decoded(geotiff.encoded(tiles, key="path", height=size, width=size, mask=True), mask=True)
    place = lambda k, c: (F.element_at(F.split("path", "_"), k).cast("int") * size + F.col(c)).alias(c)
    return back.select(place(1, "row"), place(2, "col"), F.posexplode("spectrum").alias("b", "q")).select("row", "col", "b", F.col("q").cast("int").alias("q"))


@query("coreg", None)
def coreg(spark, d):
    g = fx.grid_fine(spark, d).withColumn("v", F.greatest("v", F.lit(0.0)))
    return raster.coregister(g, g.withColumn("row", F.col("row") + 2)).withColumn("reliability", r6(F.col("reliability"), 2))


@query("coreg_deshift", f"WITH {FINE} SELECT row, col, round(greatest(v,0),6) AS v FROM fine WHERE row >= 2")
def coreg_deshift(spark, d):
    g = fx.grid_fine(spark, d).withColumn("v", F.greatest("v", F.lit(0.0)))
    moved = g.withColumn("row", F.col("row") + 2)
    return raster.deshift(moved, raster.fit_shifts(raster.coregister(g, moved))).select("row", "col", r6("v"))


# --- radiometry and fits ------------------------------------------------------

def _radio(spark, d):
    return fx.table(spark, d, "events").select("event_id", F.col("event_type").alias("channel"), F.col("value").alias("v"))


@query("stretch_robust", "WITH m AS (SELECT quantile_cont(value,0.02) AS lo, quantile_cont(value,0.98) AS hi FROM events) SELECT event_id, round(least(greatest((value-lo)/(hi-lo+1e-12),0),1),6) AS s FROM events, m")
def stretch_robust(spark, d):
    return radiometry.stretch(_radio(spark, d)).select("event_id", r6("s"))


@query("stretch_channel", "WITH m AS (SELECT event_type, quantile_cont(value,0.02) AS lo, quantile_cont(value,0.98) AS hi FROM events WHERE value>5 GROUP BY 1) SELECT event_id, round(least(greatest((value-lo)/(hi-lo),0),1),6) AS s FROM events JOIN m USING (event_type)")
def stretch_channel(spark, d):
    return radiometry.stretch(_radio(spark, d), by=["channel"], eps=0, valid=F.col("v") > 5).select("event_id", r6("s"))


@query("stretch_pooled", "WITH m AS (SELECT quantile_cont(value,0.02) AS lo, quantile_cont(value,0.98) AS hi FROM events WHERE event_type IN ('view','click','error')) SELECT event_id, round(least(greatest((value-lo)/(hi-lo+1e-6),0),1),6) AS s FROM events, m WHERE event_type IN ('view','click','error')")
def stretch_pooled(spark, d):
    return radiometry.stretch(_radio(spark, d).where("channel in ('view','click','error')"), eps=1e-6).select("event_id", r6("s"))


@query("stretch_multi", "WITH u AS (SELECT event_id, event_type, value AS v FROM events UNION ALL SELECT event_id+1000000, event_type, value*1.1 FROM events), m AS (SELECT event_type, quantile_cont(v,0.02) AS lo, quantile_cont(v,0.98) AS hi FROM u GROUP BY 1) SELECT event_id, round(pow(least(greatest((v-lo)/(hi-lo+1e-6),0),1),1/1.1::DOUBLE),6) AS s FROM u JOIN m USING (event_type)")
def stretch_multi(spark, d):
    a = _radio(spark, d)
    b = a.withColumns({"event_id": F.col("event_id") + 1000000, "v": F.col("v") * 1.1})
    return radiometry.stretch(a.unionByName(b), by=["channel"], eps=1e-6, gamma=1.1).select("event_id", r6("s"))


@query("white_balance", "WITH m AS (SELECT event_type, avg(value/200) AS m FROM events GROUP BY 1), k AS (SELECT event_type, (SELECT avg(m) FROM m)/greatest(m,1e-6) AS k FROM m) SELECT event_id, round(pow(least(greatest(value/200*k,0),1),1/2.2::DOUBLE),6) AS s FROM events JOIN k USING (event_type)")
def white_balance(spark, d):
    return radiometry.white_balance(_radio(spark, d).withColumn("v", F.col("v") / 200)).select("event_id", r6("s"))


@query("hist_match", """WITH s AS (SELECT event_id, value AS v, cume_dist() OVER (ORDER BY value) AS q FROM events WHERE event_type='view'),
r0 AS (SELECT DISTINCT value AS r, cume_dist() OVER (ORDER BY value) AS q FROM events WHERE event_type='click'),
r AS (SELECT r, q, lead(r) OVER (ORDER BY q) AS r2, lead(q) OVER (ORDER BY q) AS q2 FROM r0)
SELECT event_id, round(CASE WHEN s.q < (SELECT min(q) FROM r) THEN (SELECT min(r) FROM r) WHEN r.q2 IS NULL THEN r.r ELSE r.r+(s.q-r.q)/(r.q2-r.q)*(r.r2-r.r) END,6) AS s FROM s ASOF LEFT JOIN r ON s.q >= r.q""")
def hist_match(spark, d):
    e = _radio(spark, d)
    src = e.where("channel = 'view'").withColumn("channel", F.lit("c"))
    ref = e.where("channel = 'click'").select(F.lit("c").alias("channel"), "v")
    return radiometry.histogram_match(src, ref).select("event_id", r6("s"))


def _calibration(spark, d):
    return fx.table(spark, d, "lineitem").select(F.col("l_linenumber").alias("band"), F.col("l_quantity").alias("x"), F.col("l_extendedprice").alias("y"))


@query("linear_calib", "SELECT l_linenumber AS band, round(regr_slope(l_extendedprice,l_quantity),4) AS a, round(regr_intercept(l_extendedprice,l_quantity),4) AS b, count(*) AS n FROM lineitem WHERE l_quantity>0 AND l_extendedprice>0 GROUP BY 1")
def linear_calib(spark, d):
    return fit.linear_calibration(_calibration(spark, d)).select("band", r6(F.col("a"), 4).alias("a"), r6(F.col("b"), 4).alias("b"), "n")


def _rgb(spark, d, a=9, b=5, c=3):
    g = lambda i: F.get("spectrum", F.lit(i))
    return fx.spectra(spark, d).select("row", "col", g(a).alias("r"), g(b).alias("g"), g(c).alias("b"))


_RGB = SPECTRA + ", rgb AS (SELECT row, col, s[10] AS r, s[6] AS g, s[4] AS b FROM spectra)"


@query("affine_apply", f"WITH {_RGB} SELECT row, col, round(least(greatest(r*0.9+g*0.1+0.02,0),1),6) AS x, round(least(greatest(g*1.1-0.01,0),1),6) AS y, round(least(greatest(r*0.05+b*0.8,0),1),6) AS z FROM rgb")
def affine_apply(spark, d):
    out = fit.affine([F.col(c) for c in "rgb"], [[0.9, 0, 0.05], [0.1, 1.1, 0], [0, 0, 0.8]], [0.02, -0.01, 0.0])
    return _rgb(spark, d).select("row", "col", *[r6(v).alias(n) for n, v in zip("xyz", out, strict=True)])


@query("poly_apply", f"WITH {_RGB} SELECT row, col, round(least(greatest((0.5*r+0.2)*r+0.1,0),1),6) AS x, round(least(greatest((0.0*g+1.0)*g,0),1),6) AS y, round(least(greatest((-1.0*b+1.5)*b+0.05,0),1),6) AS z FROM rgb")
def poly_apply(spark, d):
    out = fit.polynomial([F.col(c) for c in "rgb"], [[0.5, 0.2, 0.1], [0, 1, 0], [-1, 1.5, 0.05]])
    return _rgb(spark, d).select("row", "col", *[r6(v).alias(n) for n, v in zip("xyz", out, strict=True)])


@query("logit_sigmoid", f"WITH {_RGB}, p AS (SELECT row, col, least(greatest(r,1e-4),1-1e-4) AS p FROM rgb) SELECT row, col, round(ln(p/(1-p)),6) AS l, round(1/(1+exp(-least(greatest(ln(p/(1-p)),-50),50))),6) AS s FROM p")
def logit_sigmoid(spark, d):
    x = fc.logit(F.col("r"))
    return _rgb(spark, d).select("row", "col", r6(x).alias("l"), r6(fc.sigmoid(x)).alias("s"))


@query("ot_affine_fit", None)
def ot_affine_fit(spark, d):
    a, t = fit.fit_ot_affine(_rgb(spark, d), _rgb(spark, d, 20, 15, 10))
    return spark.createDataFrame([(j, *[round(float(v), 6) for v in a[:, j]], round(float(t[j]), 6)) for j in range(3)], "channel int, a0 double, a1 double, a2 double, t double")


@query("ot_poly_fit", None)
def ot_poly_fit(spark, d):
    c = fit.fit_ot_polynomial(_rgb(spark, d), _rgb(spark, d, 20, 15, 10), degree=3)
    return spark.createDataFrame([(j, k, round(float(v), 6)) for j, row in enumerate(c) for k, v in enumerate(row)], "channel int, power int, c double")


@query("spectral_ridge", None)
def spectral_ridge(spark, d):
    pick = lambda idx: F.array(*[F.get("spectrum", F.lit(i)) for i in idx])
    df = fx.spectra(spark, d).select("row", "col", pick(range(0, 60, 6)).alias("x"), pick(fc.even_bands(64, 32)).alias("y"))
    out = fit.SpectralRidge().fit(df).predict(df)
    long = out.select(F.explode(F.arrays_zip(F.sequence(F.lit(0), F.lit(31)).alias("band"), F.col("y"), F.col("y_hat"))).alias("z")).select("z.band", "z.y", "z.y_hat")
    return fit.accuracy(long).select("band", r6("r2"), r6("rmse"))


@query("r2_rmse", f"WITH {LONG}, p AS (SELECT b, v AS y, lead(v) OVER (PARTITION BY row, col ORDER BY b) AS h FROM long), q AS (SELECT * FROM p WHERE h IS NOT NULL) SELECT b AS band, round(1-sum((y-h)**2)/(count(*)*var_pop(y)+1e-8),6) AS r2, round(sqrt(avg((y-h)**2)),6) AS rmse FROM q GROUP BY b")
def r2_rmse(spark, d):
    long = fx.spectra(spark, d).select(F.posexplode(F.zip_with(F.slice("spectrum", 1, 63), F.slice("spectrum", 2, 63), lambda a, b: F.struct(a.alias("y"), b.alias("y_hat")))).alias("band", "z"))
    return fit.accuracy(long.select("band", "z.y", "z.y_hat")).select("band", r6("r2"), r6("rmse"))


@query("obs_assemble", "SELECT l_orderkey, l_linenumber, k::INT AS k, [l_quantity,l_extendedprice,l_discount+0.0,l_tax+0.0][k+1] AS v FROM lineitem, range(4) t(k)")
def obs_assemble(spark, d):
    li = fx.table(spark, d, "lineitem")
    values = cube.assemble(li, (("path_length", "l_quantity"), ("l_extendedprice",), ("zenith", "l_discount"), ("l_tax", "slope")))
    return li.select("l_orderkey", "l_linenumber", F.posexplode(values).alias("k", "v"))


@query("envi_header_path", "SELECT path, CASE WHEN kind=0 THEN stem || '.hdr' WHEN kind=1 THEN stem || '.img.hdr' WHEN kind=2 THEN stem || '.bin.hdr' ELSE stem || '.hdr' END AS header FROM (SELECT page_id%4 AS kind, 'd/p' || page_id AS stem, 'd/p' || page_id || CASE page_id%4 WHEN 0 THEN '.dat' WHEN 1 THEN '.img' WHEN 2 THEN '.bin' ELSE '.hdr' END AS path FROM pages)")
def envi_header_path(spark, d):
    stem = F.concat(F.lit("d/p"), F.col("page_id"))
    kind = F.col("page_id") % 4
    path = F.concat(stem, F.element_at(F.array(*map(F.lit, (".dat", ".img", ".bin", ".hdr"))), (kind + 1).cast("int")))
    there = F.when(kind == 1, F.array(F.concat(path, F.lit(".hdr")))).otherwise(F.array(F.concat(stem, F.lit(".hdr"))))
    return fx.table(spark, d, "pages").select(path.alias("path"), fc.envi_header(path, there).alias("header"))
