"""Queries over file names, manifests, documents and checksums."""

from __future__ import annotations

from pyspark.sql import functions as F

from surveyspark import rules
from surveyspark.functions import names as N
from surveyspark.functions import xmlout
from surveyspark.operators import manifest as M

from .derive import V_FILE, table, v_file

IDS = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")


def name_area(spark, sf_dir):
    return v_file(spark, sf_dir).select("gds", "name", N.area(F.col("name"), F.col("gds")).alias("area"), N.area(F.col("name"), F.col("gds"), any_case=False).alias("area_exact"))


def name_tilekey(spark, sf_dir):
    f = v_file(spark, sf_dir).select("name", N.parts(F.col("name")).alias("parts"), N.las_origin(F.col("name")).alias("o"))
    d = f.select("name", "o", N.tile_key_of(F.col("parts")).alias("tile_key")).withColumn("k", N.tile_numbers(F.col("tile_key")))
    o = F.col("o")
    return d.select("name", "tile_key", F.col("k.e").alias("e"), F.col("k.n").alias("n"), o["e_km"].alias("e_km"), o["n_km"].alias("n_km"), o["problem"].alias("problem"))


def name_parts(spark, sf_dir):
    return v_file(spark, sf_dir).select(
        "name", N.extension(F.col("name")).alias("ext"), N.is_hillshade(F.col("name")).alias("hillshade"), N.line_token(F.col("name")).alias("line_token"),
        N.year_of(F.col("name")).alias("year"), N.common_prefix(F.col("name")).alias("prefix"), N.dsm_folder(F.col("name")).alias("folder"),
        N.sanitized(F.concat(F.lit(" "), F.col("name"), F.lit("?x "))).alias("sanitized"),
    )


def name_format_check(spark, sf_dir):
    f = v_file(spark, sf_dir)
    camera = F.when(F.pmod("l_partkey", F.lit(2)) == 0, rules.ADS80).otherwise(rules.ADS100)
    out = M.check_names(f, rules.name_rules(spark), camera)
    return out.groupBy("gds", camera.alias("camera")).agg(F.count("*").alias("files"), F.count_if("fits").alias("fitting"))


def nodata_value(spark, sf_dir):
    v = N.nodata_source(F.col("name"), F.col("gds"), F.col("nodata"))
    return v_file(spark, sf_dir).select("gds", "name", "nodata", v.alias("source_value"))


def nodata_normalize(spark, sf_dir):
    d = v_file(spark, sf_dir).withColumn("src", N.nodata_source(F.col("name"), F.col("gds"), F.col("nodata")))
    return d.select("name", N.nodata_output(F.col("gds"), F.col("src")).alias("output"), F.array_join(N.nodata_bands(F.col("src"), F.col("bands")), ",").alias("per_band"))


def cleanup_whitelist(spark, sf_dir):
    return M.cleanup(v_file(spark, sf_dir).select("gds", "name"), rules.kept_extensions(spark)).groupBy("gds", "keep").agg(F.count("*").alias("files"))


def reorganize_by_line(spark, sf_dir):
    f = v_file(spark, sf_dir)
    there = f.filter(F.pmod("l_partkey", F.lit(4)) == 0).select(N.line_token(F.col("name")).alias("line"), "name").filter("line IS NOT NULL")
    return M.reorganise(f.select("name"), there).groupBy("line", "status").agg(F.count("*").alias("files"))


def files_csv(spark, sf_dir):
    f = v_file(spark, sf_dir).withColumns({"md5": F.md5(F.encode("name", "utf-8")), "footprint": F.lit("POLYGON")})
    ord_ = F.concat_ws("-", *IDS)
    return M.csv_rows(f.select(ord_.alias("ord"), "gds", "name", "md5", "footprint"))


def manifest_merge(spark, sf_dir):
    """Two runs' trees by name: the newer file stays where both have it."""
    f = v_file(spark, sf_dir).groupBy("name").agg(F.min("length").alias("low"), F.max("length").alias("high"), F.min("l_partkey").alias("k"))
    old = f.filter(F.pmod("k", F.lit(3)) != 0).select("name", F.col("low").alias("length"), F.lit("old").alias("run"))
    new = f.filter(F.pmod("k", F.lit(3)) != 1).select("name", F.col("high").alias("length"), F.lit("new").alias("run"))
    return M.merge_trees(old, new, "name")


def manifest_append(spark, sf_dir):
    """The manifest of a second run behind that of the first."""
    rows = files_csv(spark, sf_dir)
    first = rows.filter("part = 0").select(F.lit(0).alias("run"), "ord", "part", "line")
    return M.append(first, rows.filter("part = 1")).groupBy("run").agg(F.count("*").alias("rows"), F.min("line").alias("first_line"))


def md5_manifest(spark, sf_dir):
    """Checksums of page contents with the size check of a copy in which every tenth page is cut."""
    from surveyspark.sources.files import compare_copies

    p = table(spark, sf_dir, "pages").select(
        F.col("page_id").cast("string").alias("name"), F.encode(F.coalesce("html", F.lit("")), "utf-8").alias("content"), "page_id"
    )
    source = p.select("name", F.octet_length("content").cast("long").alias("length"), F.md5("content").alias("md5"))
    cut = F.when(F.pmod("page_id", F.lit(10)) == 0, F.expr("substring(content, 1, octet_length(content) - 1)")).otherwise(F.col("content"))
    target = p.filter(F.pmod("page_id", F.lit(17)) != 0).withColumn("content", cut)
    target = target.select("name", F.octet_length("content").cast("long").alias("length"), F.md5("content").alias("md5"))
    return source.join(compare_copies(source, target), "name").select("name", "length", "md5", "ok", "problem")


def sidecar_join(spark, sf_dir):
    f = v_file(spark, sf_dir).select(F.pmod("l_suppkey", F.lit(50)).cast("string").alias("folder"), "name").distinct()
    return M.with_sidecars(f).select("folder", "name", F.array_join("sidecars", ",").alias("sidecars"))


def first_file(spark, sf_dir):
    """Alphabetically first file per supplier (example of a delivery)."""
    f = v_file(spark, sf_dir).select("l_suppkey", "name").distinct()
    return M.first_of_each(f, "l_suppkey", "name")


def mixed_variants(spark, sf_dir):
    name = F.when(F.pmod("l_partkey", F.lit(50)) == 0, F.concat(N.stem(F.col("name")), F.lit(".XYZ"))).otherwise(F.col("name"))
    return M.mixed_variants(v_file(spark, sf_dir).select(F.col("l_suppkey").alias("delivery"), name.alias("name")))


def catalog_paths(spark, sf_dir):
    """Catalog, environment and product read from target paths."""
    f = v_file(spark, sf_dir)
    bucket = F.when(F.pmod("l_partkey", F.lit(3)) == 0, "BUCKET_INT").otherwise("BUCKET")
    path = F.concat_ws("\\", F.lit("X:"), bucket, F.col("gds"), F.concat(F.lit("P"), F.col("l_suppkey").cast("string")))
    return f.select("name", path.alias("path")).withColumns(
        {
            "catalog": N.catalog_name(N.product_of_path(F.col("path")), F.col("name").startswith("2026")),
            "is_int": N.is_int_path(F.col("path")),
            "product": N.product_of_path(F.col("path")),
        }
    )


def xml_document(spark, sf_dir):
    """The document of each file, with a delivery's fields made of its keys."""
    f = v_file(spark, sf_dir)
    day = F.concat(F.lit("2024"), F.lpad((1 + F.pmod("l_partkey", F.lit(12))).cast("string"), 2, "0"), F.lit("15"))
    line = F.concat(day, F.lit("_0921_"), F.lpad(F.pmod("l_suppkey", F.lit(100000)).cast("string"), 5, "0"))
    iso = F.concat(F.substring(day, 1, 4), F.lit("-"), F.substring(day, 5, 2), F.lit("-15T09:21:00.00"))
    empty = F.lit(None).cast("string")
    values = {
        "order_type": F.lit("kry"), "area": N.area(F.col("name"), F.col("gds")), "terrain_model": F.lit(rules.TERRAIN_MODEL), "camera": F.lit("A&B <x>"),
        "crs": empty, "source_crs": F.lit(rules.SOURCE_REF_SYS), "commentary": empty, "custom_attribute": F.col("gds"),
        "nodata": N.nodata_output(F.col("gds"), N.nodata_source(F.col("name"), F.col("gds"), F.col("nodata"))), "line_ids": line, "times": iso, "first": iso,
        "stac": F.concat(F.substring(iso, 1, 10), F.lit("t09210000")), "band_id": F.when(F.pmod("l_partkey", F.lit(2)) == 0, "0921").otherwise(""),
        "cell_size": F.lit("0.1"), "block_size": F.lit("512"), "width": F.lit("10000"), "height": F.lit("10000"), "year": F.substring(line, 1, 4),
    }
    return f.select(*IDS, xmlout.tile_document(F.col("gds"), F.col("name"), values).alias("xml"))


QUERIES = {
    f.__name__: f
    for f in (
        name_area, name_tilekey, name_parts, name_format_check, nodata_value, nodata_normalize, cleanup_whitelist, reorganize_by_line,
        files_csv, manifest_merge, manifest_append, md5_manifest, sidecar_join, first_file, mixed_variants, catalog_paths, xml_document,
    )
}

_STEM = r"regexp_replace(name, '\.[^.]*$', '')"
_EXT = r"lower(regexp_extract(name, '[^.](\.[^.]*)$', 1))"
_PARTS = f"string_split({_STEM}, '_')"
_KEY = f"""CASE WHEN list_position({_PARTS}, 'LV95') >= 3
  THEN {_PARTS}[list_position({_PARTS}, 'LV95') - 2] || '_' || {_PARTS}[list_position({_PARTS}, 'LV95') - 1] ELSE 'UNKNOWN' END"""
_SHADE = f"(list_contains(string_split(lower({_STEM}), '_'), 'hillshade') OR string_split(lower({_STEM}), '_')[-1] = 'hs')"
_SRC = f"""CASE WHEN gds = 'SB_DSM' AND (lower(name) LIKE '%hillshade%' OR {_SHADE}) THEN '255'
  WHEN gds = 'SB_DSM' AND lower(name) LIKE '%\\_dsm\\_%' ESCAPE '\\' THEN '-3.4028235e+38' ELSE nodata END"""
_LINE = "nullif(regexp_extract(name, '([0-9]{4})NRGB', 1, 'i'), '')"


def _area(flag: str, shade: str) -> str:
    one = lambda token: f"regexp_extract(name, '20[0-9]{{2}}_(.+?)_{token}', 1{flag})"
    return f"""coalesce(nullif(CASE WHEN gds IN ('SB_DOP', 'SB_DOP_16') THEN {one('DOP')}
      WHEN gds = 'SB_DSM' AND {shade} THEN {one('hillshade')} WHEN gds = 'SB_DSM' THEN {one('DSM')}
      WHEN gds = 'SB_DSM_PUNKTWOLKE' THEN {one('TIN')} ELSE '' END, ''), 'UNKNOWN')"""


_OUT = r"CASE WHEN gds IN ('SB_DSM', 'SB_DSM_PUNKTWOLKE') THEN src ELSE regexp_replace(src, '[^ ]+', '0', 'g') END"
_FIT = " OR ".join(
    f"(gds = '{g}'{extra} AND regexp_matches(name, '{p[4:]}', 'i'))"
    for t, extra in ((rules.NAME_PATTERNS, ""), (rules.NAME_PATTERNS_ADS80, " AND l_partkey % 2 = 0"))
    for g, ps in t.items()
    for p in ps
)
_CSV = f"""{V_FILE},
  c AS (SELECT concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS ord, gds, name, md5(name) AS m, {_KEY} AS key, {_EXT} AS ext,
      {_SHADE} AS shade, {_PARTS}[-2] || '_' || {_PARTS}[-1] AS last FROM v_file),
  csv AS (
    SELECT ord, 0 AS part, CASE
        WHEN gds = 'SB_DSM' THEN 'NV\\' || CASE WHEN shade THEN 'HILLSHADE' ELSE 'DSM' END || '\\' || name || ';' || m || ';1000;add;POLYGON'
        WHEN gds = 'SB_DSM_PUNKTWOLKE' AND ext = '.laz' THEN 'NV\\' || gds || '\\' || name || ';' || m || ';' || key || ';add;'
        WHEN gds LIKE 'SB_DOP%' THEN 'NV\\' || name || ';' || m || ';' || key || ';add;'
        ELSE 'NV\\' || name || ';' || m || ';' || last || ';add;' END AS line
    FROM c WHERE gds NOT LIKE 'SB_DOP%' OR ext = '.tif'
    UNION ALL
    SELECT ord, 1, 'PreCalculatedFormats\\' || gds || '\\SB_DSM_PUNKTWOLKE_LAZ_CHLV95_LN02_' || key || '.laz;' || m || ';' || key || ';add;'
    FROM c WHERE gds = 'SB_DSM_PUNKTWOLKE' AND ext = '.laz')"""


def _xml() -> str:
    el = lambda tag, v: f"CASE WHEN {v} IS NULL THEN '' WHEN {v} = '' THEN chr(10) || '    <{tag}/>' ELSE chr(10) || '    <{tag}>' || {v} || '</{tag}>' END"
    raster = lambda v: f"CASE WHEN regexp_matches(lower(name), '\\.tiff?$') THEN '{v}' END"
    rows = [
        ("Auftragstyp", "'kry'"), ("Area", "area"), ("TerrainModel", f"'{rules.TERRAIN_MODEL}'"), ("CameraSystem", "'A&amp;B &lt;x&gt;'"),
        ("CoordinateReferenceSystem", f"'{rules.SOURCE_REF_SYS}'"), ("Commentary", "gds"), ("NoData", f"CASE WHEN gds <> 'SB_DSM_PUNKTWOLKE' THEN {_OUT} END"),
        ("LineID", "line"), ("AcquisitionTimes", "iso"), ("FirstAcquisitionTime", "iso"), ("StacItemIdDatetime", "substr(iso, 1, 10) || 't09210000'"),
        ("BandID", "CASE WHEN l_partkey % 2 = 0 THEN '0921' END"), ("CellSize", raster("0.1")), ("BlockSize", raster("512")), ("Width", raster("10000")),
        ("Height", raster("10000")), ("Year", "CASE WHEN lower(name) LIKE '%.laz' THEN '2024' END"),
    ]
    body = " || ".join(el(t, f"({v})") for t, v in rows)
    return f"""WITH {V_FILE},
      s AS (SELECT *, {_SRC} AS src, {_area(", 'i'", "lower(name) LIKE '%hillshade%'")} AS area,
          '2024' || lpad(CAST(1 + l_partkey % 12 AS VARCHAR), 2, '0') || '15_0921_' || lpad(CAST(l_suppkey % 100000 AS VARCHAR), 5, '0') AS line,
          '2024-' || lpad(CAST(1 + l_partkey % 12 AS VARCHAR), 2, '0') || '-15T09:21:00.00' AS iso FROM v_file)
      SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, '<?xml version="1.0" ?>' || chr(10)
        || '<MetaObject xmlns:xsi="http://www.w3.org/2001/XMLSchema-instance">' || {body} || chr(10) || '</MetaObject>' AS xml FROM s"""


ORACLE = {
    "name_area": f"""WITH {V_FILE} SELECT gds, name, {_area(", 'i'", "lower(name) LIKE '%hillshade%'")} AS area,
      {_area("", "name LIKE '%hillshade%'")} AS area_exact FROM v_file""",
    "name_tilekey": f"""WITH {V_FILE}, k AS (SELECT name, {_KEY} AS tile_key, regexp_extract(name, '([0-9]{{4}})_[0-9]{{4}}_LV95_LN02\\.laz$', 1) AS a,
        regexp_extract(name, '[0-9]{{4}}_([0-9]{{4}})_LV95_LN02\\.laz$', 1) AS b FROM v_file)
      SELECT name, tile_key, CASE WHEN regexp_matches(tile_key, '^[+-]?[0-9]+_[+-]?[0-9]+$') THEN CAST(split_part(tile_key, '_', 1) AS INTEGER) END AS e,
        CASE WHEN regexp_matches(tile_key, '^[+-]?[0-9]+_[+-]?[0-9]+$') THEN CAST(split_part(tile_key, '_', 2) AS INTEGER) END AS n,
        TRY_CAST(a AS INTEGER) AS e_km, TRY_CAST(b AS INTEGER) AS n_km,
        CASE WHEN a = '' THEN 'no tile in name' WHEN NOT CAST(a AS INTEGER) BETWEEN 2480 AND 2840 THEN 'easting out of range'
          WHEN NOT CAST(b AS INTEGER) BETWEEN 1070 AND 1300 THEN 'northing out of range' END AS problem FROM k""",
    "name_parts": f"""WITH {V_FILE} SELECT name, {_EXT} AS ext, {_SHADE} AS hillshade, {_LINE} AS line_token,
        TRY_CAST(regexp_extract(name, '(20[0-9]{{2}})', 1) AS INTEGER) AS year,
        CASE WHEN strpos(upper({_STEM}), '_LV95') > 0 THEN substr(name, 1, strpos(upper({_STEM}), '_LV95') - 1) END AS prefix,
        CASE WHEN {_SHADE} THEN 'HILLSHADE' ELSE 'DSM' END AS folder, name || '_x' AS sanitized FROM v_file""",
    "name_format_check": f"""WITH {V_FILE} SELECT gds, CASE WHEN l_partkey % 2 = 0 THEN '{rules.ADS80}' ELSE '{rules.ADS100}' END AS camera,
        count(*) AS files, count(*) FILTER (WHERE {_FIT}) AS fitting FROM v_file GROUP BY ALL""",
    "nodata_value": f"WITH {V_FILE} SELECT gds, name, nodata, {_SRC} AS source_value FROM v_file",
    "nodata_normalize": f"""WITH {V_FILE}, s AS (SELECT *, {_SRC} AS src, [x FOR x IN string_split({_SRC}, ' ') IF x <> ''] AS t FROM v_file)
      SELECT name, {_OUT} AS output, CASE WHEN len(t) = 1 THEN array_to_string([t[1] FOR i IN range(bands)], ',')
        WHEN len(t) = bands THEN array_to_string(t, ',') END AS per_band FROM s""",
    "cleanup_whitelist": f"""WITH {V_FILE} SELECT gds, CASE WHEN gds = 'SB_DSM_PUNKTWOLKE' THEN {_EXT} IN ('.laz', '.ascii')
        ELSE {_EXT} IN ('.tif', '.tiff', '.tfw') END AS keep, count(*) AS files FROM v_file GROUP BY ALL""",
    "reorganize_by_line": f"""WITH {V_FILE}, f AS (SELECT name, {_LINE} AS line, l_partkey FROM v_file),
      t AS (SELECT DISTINCT line, name FROM f WHERE line IS NOT NULL AND l_partkey % 4 = 0)
      SELECT f.line, CASE WHEN f.line IS NULL THEN 'unknown' WHEN t.name IS NOT NULL THEN 'skipped' ELSE 'moved' END AS status, count(*) AS files
      FROM f LEFT JOIN t ON t.line = f.line AND t.name = f.name GROUP BY ALL""",
    "files_csv": f"WITH {_CSV} SELECT * FROM csv",
    "manifest_merge": f"""WITH {V_FILE}, f AS (SELECT name, min(length) AS low, max(length) AS high, min(l_partkey) AS k FROM v_file GROUP BY name)
      SELECT name, CASE WHEN k % 3 <> 1 THEN high ELSE low END AS length, CASE WHEN k % 3 <> 1 THEN 'new' ELSE 'old' END AS run FROM f""",
    "manifest_append": f"WITH {_CSV} SELECT part AS run, count(*) AS rows, min(line) AS first_line FROM csv GROUP BY part",
    "md5_manifest": """WITH p AS (SELECT CAST(page_id AS VARCHAR) AS name, strlen(coalesce(html, '')) AS length, md5(coalesce(html, '')) AS md5, page_id FROM pages)
      SELECT name, length, md5, page_id % 17 <> 0 AND page_id % 10 <> 0 AS ok,
        CASE WHEN page_id % 17 = 0 THEN 'missing' WHEN page_id % 10 = 0 THEN 'size' END AS problem FROM p""",
    "sidecar_join": f"""WITH {V_FILE}, f AS (SELECT DISTINCT CAST(l_suppkey % 50 AS VARCHAR) AS folder, name, {_STEM} AS stem, {_EXT} AS ext FROM v_file),
      s AS (SELECT folder, stem, string_agg(name, ',' ORDER BY name) AS sidecars FROM f WHERE ext IN ('.xml', '.tfw') GROUP BY ALL)
      SELECT f.folder, f.name, coalesce(sidecars, '') AS sidecars FROM f LEFT JOIN s USING (folder, stem) WHERE ext IN ('.tif', '.laz')""",
    "first_file": f"WITH {V_FILE} SELECT l_suppkey, min(name) AS name FROM v_file GROUP BY l_suppkey",
    "mixed_variants": f"""WITH {V_FILE} SELECT l_suppkey AS delivery, bool_or(l_partkey % 50 = 0) AS has_ascii,
        bool_or(l_partkey % 50 <> 0 AND {_EXT} = '.laz') AS has_laz, bool_or(l_partkey % 50 = 0) AND bool_or(l_partkey % 50 <> 0 AND {_EXT} = '.laz') AS mixed
      FROM v_file GROUP BY l_suppkey""",
    "catalog_paths": f"""WITH {V_FILE} SELECT name, 'X:\\' || CASE WHEN l_partkey % 3 = 0 THEN 'BUCKET_INT' ELSE 'BUCKET' END || '\\' || gds || '\\P' || l_suppkey AS path,
        CASE WHEN gds = 'SB_DOP' AND name LIKE '2026%' THEN 'SB_DOP_DMC' ELSE gds END AS catalog, l_partkey % 3 = 0 AS is_int, gds AS product FROM v_file""",
    "xml_document": _xml(),
}
