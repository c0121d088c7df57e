"""Queries over tiles, grid cells and points."""

from __future__ import annotations

import struct

from pyspark.sql import functions as F

from surveyspark.functions import geo
from surveyspark.operators import points as P
from surveyspark.operators import tiles as T
from surveyspark.sources import las

from .derive import V_POINT, V_TILE, table, v_point, v_tile

CELL = 1_000_000  # centimetres


def _cells(spark, sf_dir):
    """Grid cells in centimetres that the tile view has."""
    return v_tile(spark, sf_dir).select((F.col("e") + F.lit(0)).alias("ix"), F.col("n").alias("iy"), F.col("tile").alias("name"))


def _coarse(spark, sf_dir):
    """Points moved onto the tile view's ground: cells of 10 km become cells of 1 km."""
    p = v_point(spark, sf_dir)
    x = 260_000_000 + F.pmod(F.col("x") * 7, F.lit(4_000_000))
    y = 110_000_000 + F.pmod(F.col("y") * 3, F.lit(4_000_000))
    return p.withColumns({"x": x, "y": y})


def neighbor_missing(spark, sf_dir):
    odd = F.pmod(F.col("e") + F.col("n"), F.lit(37)) == 0
    t = v_tile(spark, sf_dir).select("tile", F.when(~odd, F.col("e")).alias("e"), F.when(~odd, F.col("n")).alias("n"))
    return T.missing_neighbours(t).select("tile", F.array_join("missing", ",").alias("missing"))


def bbox_overlap(spark, sf_dir):
    return T.overlapping_pairs(v_tile(spark, sf_dir).withColumnRenamed("tile", "id"), 1000.0)


def bbox_overlap_rasters(spark, sf_dir):
    return T.overlapping_pairs(v_tile(spark, sf_dir).withColumnRenamed("tile", "id"), 1000.0, kind="extent", limit=0.05)


def cell_tile_overlap(spark, sf_dir):
    t = v_tile(spark, sf_dir)
    cells = t.select(F.col("e").cast("long").alias("ix"), F.col("n").cast("long").alias("iy"), F.col("tile").alias("name"))
    return T.cells_by_box(cells, t.withColumnRenamed("tile", "id"), 1000.0)


def grid_check(spark, sf_dir):
    """Cells with planted faults: shifted, renamed, doubled and in another system."""
    t = v_tile(spark, sf_dir)
    odd = F.pmod(F.col("e") * 3 + F.col("n"), F.lit(17))
    name = F.when(odd == 1, F.concat(F.lit("x"), F.col("tile"))).when(odd == 2, F.lit("2600_1100")).otherwise(F.col("tile"))
    cells = t.select(
        F.col("tile").alias("id"), name.alias("name"), (F.col("minx") + F.when(odd == 3, 10.0).otherwise(0.0)).alias("minx"), "miny",
        (F.col("maxx") + F.when(odd == 3, 10.0).otherwise(0.0)).alias("maxx"), "maxy", F.when(odd == 4, 21781).otherwise(2056).alias("epsg"),
    )
    return T.check_cells(cells).select("id", "ix", "iy", F.array_join("problems", ",").alias("problems"))


def snapped_bbox(spark, sf_dir):
    return T.snapped_bbox(v_tile(spark, sf_dir), 1000.0)


def tile_uniformity(spark, sf_dir):
    t = v_tile(spark, sf_dir)
    return T.uniformity(t.select("tile", F.lit(4).alias("bands"), F.lit("Byte").alias("dtype"), F.round(0.1 + F.pmod("e", F.lit(2)) * 0.15, 2).alias("gsd"), F.lit("2025_X").alias("prefix")))


def point_tiling(spark, sf_dir):
    tiled = P.to_cells(_coarse(spark, sf_dir), _cells(spark, sf_dir).select(F.expr("ix - 2600 + 2600").cast("int").alias("ix"), "iy", "name"), 100_000)
    return tiled.groupBy("ix", "iy", "name").agg(F.count("*").alias("points"), F.sum("z").alias("sum_z"))


def point_balance(spark, sf_dir):
    return P.balance(P.to_cells(_coarse(spark, sf_dir), _cells(spark, sf_dir), 100_000))


def tile_header(spark, sf_dir):
    return P.tile_headers(P.to_cells(_coarse(spark, sf_dir), _cells(spark, sf_dir), 100_000))


def dimension_ranges(spark, sf_dir):
    return P.ranges(v_point(spark, sf_dir), "file")


def range_validation(spark, sf_dir):
    """Ranges of a copy in which some files' heights, classes or rows differ."""
    p = v_point(spark, sf_dir)
    copy = p.filter(F.pmod("file", F.lit(29)) != 0).withColumns(
        {
            "z": F.col("z") + F.when(F.pmod("file", F.lit(7)) == 0, 5).when(F.pmod("file", F.lit(7)) == 1, 1).otherwise(0),
            "cls": F.when(F.pmod("file", F.lit(11)) == 0, F.col("cls") - 1).otherwise(F.col("cls")),
        }
    )
    return P.compare_ranges(P.ranges(p, "file"), P.ranges(copy, "file"), "file", 1.0)


def source_bbox(spark, sf_dir):
    """Bounding box, points and height plausibility of each file, with its system by range."""
    b = v_point(spark, sf_dir).groupBy("file").agg(
        F.count("*").alias("points"), *[f(c).alias(f"{n}{c}") for c in ("x", "y", "z") for n, f in (("min", F.min), ("max", F.max))]
    )
    m = lambda c: F.col(c) / 100
    return b.select(
        "file", "points", "minx", "maxx", "miny", "maxy", geo.classify_bbox(m("minx"), m("maxx"), m("miny"), m("maxy")).alias("crs"),
        geo.z_plausible(m("minz"), m("maxz")).alias("z_ok"),
    )


def frame_gaps(spark, sf_dir):
    h = P.tile_headers(P.to_cells(_coarse(spark, sf_dir), _cells(spark, sf_dir), 100_000))
    h = h.select("name", *[(F.col(c) / 100).alias(c) for c in ("minx", "maxx", "miny", "maxy")], F.split("name", "_")[0].cast("int").alias("e_km"), F.split("name", "_")[1].cast("int").alias("n_km"))
    out = P.frame_report(h, limit=1.0)
    return out.select("name", "violation", F.size("gaps").alias("n_gaps"), F.array_join(F.transform("gaps", lambda g: F.concat_ws(":", g["side"], F.format_string("%.2f", g["gap"]))), ",").alias("gaps"))


def requantise(spark, sf_dir):
    """Heights put onto a scale of 0.25, every second one a tie; shifted: the height was off the scale."""
    v = F.round(F.col("l_extendedprice") * 100).cast("long") / 8.0
    z = geo.requantised(v, F.lit(0.0), 0.25)
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", z.alias("z"), (z != v).alias("shifted"))


def _text(spark, sf_dir):
    """Point text of each order priority and status: header lines, separators and malformed rows vary."""
    o = table(spark, sf_dir, "orders")
    file = F.concat_ws("-", F.substring("o_orderpriority", 1, 1), "o_orderstatus")
    sep = F.when(F.col("o_orderstatus") == "F", ";").when(F.col("o_orderstatus") == "O", " ").otherwise(",")
    x, y, z = F.col("o_orderkey").cast("string"), F.col("o_custkey").cast("string"), F.floor("o_totalprice").cast("string")
    two = F.concat(x, sep, y)
    kind = F.pmod("o_orderkey", F.lit(50))
    row = F.when(kind == 9, two).when(kind == 11, F.concat(two, sep, F.lit("n.a."))).otherwise(F.concat(two, sep, z))
    return o.select(file.alias("file"), F.col("o_orderkey").alias("line_no"), row.alias("value"))


def ascii_sniff(spark, sf_dir):
    """Kind, separator and columns of each text, below a header line."""
    t = _text(spark, sf_dir)
    heads = t.select("file").distinct().select("file", F.lit(-1).cast("long").alias("line_no"), F.lit("x y h").alias("value"))
    return P.sniff(t.unionByName(heads)).drop("first_line")


def xyz_text(spark, sf_dir):
    t = _text(spark, sf_dir)
    p = P.xyz_points(t, P.sniff(t))
    return p.groupBy("file").agg(F.count_if(~F.col("ignored")).alias("points"), F.count_if("ignored").alias("ignored"), F.sum(F.when(~F.col("ignored"), F.col("z"))).alias("sum_z"))


def esri_grid_points(spark, sf_dir):
    """Grids of embeddings: a file per 50 vectors, 8 values a line, every 13th value without data."""
    v = table(spark, sf_dir, "embeddings").select(F.expr("vec_id div 50").alias("file"), "vec_id", F.posexplode("embedding").alias("i", "e"))
    n = F.pmod("vec_id", F.lit(50)) * 64 + F.col("i")
    z = F.when(F.pmod(n, F.lit(13)) == 0, "-9999").otherwise(F.floor((F.col("e").cast("double") + 1) * 1000).cast("int").cast("string"))
    body = v.select("file", F.floor(n / 8).alias("k"), n.alias("n"), z.alias("z")).groupBy("file", "k").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("n", "z"))), lambda x: x["z"]), " ").alias("value")
    )
    files = v.select("file").distinct()
    head = F.array(*[F.lit(x) for x in ("ncols 64", "nrows 50", "xllcorner 2600000", "yllcorner 1100000", "cellsize 2", "NODATA_value -9999")])
    rows = body.select("file", (F.col("k") + 6).alias("line_no"), "value").unionByName(files.select("file", F.posexplode(head).alias("line_no", "value")))
    return P.grid_points(rows).groupBy("file").agg(
        F.count("*").alias("points"), F.sum("z").alias("sum_z"), F.min("x").alias("minx"), F.max("x").alias("maxx"), F.min("y").alias("miny"), F.max("y").alias("maxy"),
        F.sum(F.col("x") * F.col("z")).alias("moment_x"), F.sum(F.col("y") * F.col("z")).alias("moment_y"),
    )


def las_header(spark, sf_dir):
    """Headers written from orders and read back; every tenth file is cut short."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")

    def write(batches):
        import pyarrow as pa

        for b in batches:
            names, heads = [], []
            for k, c, p in zip(*(b.column(i).to_pylist() for i in range(3)), strict=True):
                raw = bytearray(375)
                raw[:4], raw[24], raw[25], raw[104] = b"LASF", 1, 4 if k % 2 else 2, 0x80 | (6 + k % 2)
                struct.pack_into("<H", raw, 6, 17)
                struct.pack_into("<H", raw, 94, 375)
                struct.pack_into("<HI", raw, 105, 30, c)
                struct.pack_into("<6d", raw, 131, 0.01, 0.01, 0.01, 0.0, 0.0, 0.0)
                struct.pack_into("<6d", raw, 179, p + 1, p, 2.0, 1.0, 4.0, 3.0)
                struct.pack_into("<Q", raw, 247, c + (1 << 33))
                names.append(str(k))
                heads.append(bytes(raw[:100] if k % 10 == 0 else raw))
            yield pa.RecordBatch.from_pydict({"name": pa.array(names), "content": pa.array(heads, pa.binary())})

    return las.headers(o.mapInArrow(write, "name string, content binary")).drop("scale", "offset")


def las_format_choice(spark, sf_dir):
    """Target format and migration state by channels and camera."""
    p = v_point(spark, sf_dir).groupBy("file").agg(F.max("red").alias("red"), F.count("*").alias("n"))
    red = F.when(F.pmod("file", F.lit(3)) == 0, F.lit(None)).when(F.pmod("file", F.lit(3)) == 1, 0).otherwise(F.col("red"))
    rgb = geo.has_rgb(red, red, red)
    fmt = geo.point_format(rgb, F.pmod("file", F.lit(2)) == 0)
    done = geo.already_migrated(F.lit(4), F.lit(6), F.lit(17), F.lit("2056"), F.when(F.pmod("file", F.lit(5)) == 0, "5729").otherwise("5728"), fmt)
    return p.select("file", rgb.alias("has_rgb"), fmt.alias("format"), done.alias("migrated"), geo.encoding_warning(F.col("n").cast("int")).alias("encoding_warning"))


def las_validation(spark, sf_dir):
    p = v_point(spark, sf_dir).groupBy(F.col("file").cast("string").alias("name")).agg(F.count("*").alias("points"), F.first("file").alias("k"))
    at = lambda n, good, bad: F.when(F.pmod("k", F.lit(n)) == 0, bad).otherwise(good)
    t = p.filter(F.pmod("k", F.lit(31)) != 0).select(
        "name", (F.col("points") + at(7, F.lit(0), F.lit(1))).alias("points"), at(11, F.lit(4), F.lit(2)).alias("minor_version"),
        at(2, F.lit(6), F.lit(7)).alias("format"), at(2, F.lit(30), F.lit(36)).alias("point_length"), at(13, F.lit(375), F.lit(227)).alias("header_size"),
        at(17, F.lit(17), F.lit(0)).alias("encoding"), F.lit("2056").alias("horizontal"), at(19, F.lit("5728"), F.lit("5729")).alias("vertical"),
    )
    return P.header_checks(p.select("name", "points"), t).select("name", F.array_join("problems", ",").alias("problems"))


QUERIES = {
    f.__name__: f
    for f in (
        neighbor_missing, bbox_overlap, bbox_overlap_rasters, cell_tile_overlap, grid_check, snapped_bbox, tile_uniformity, point_tiling,
        point_balance, tile_header, dimension_ranges, range_validation, source_bbox, frame_gaps, requantise, ascii_sniff, xyz_text,
        esri_grid_points, las_header, las_format_choice, las_validation,
    )
}

_COARSE = f"""{V_TILE}, {V_POINT},
  p AS (SELECT 260000000 + x * 7 % 4000000 AS x, 110000000 + y * 3 % 4000000 AS y, z FROM v_point),
  tiled AS (SELECT p.*, CAST(x // 100000 AS INTEGER) AS ix, CAST(y // 100000 AS INTEGER) AS iy, t.tile AS name
    FROM p LEFT JOIN v_tile t ON t.e = x // 100000 AND t.n = y // 100000),
  heads AS (SELECT name, count(*) AS points, min(x) AS minx, max(x) AS maxx, min(y) AS miny, max(y) AS maxy, min(z) AS minz, max(z) AS maxz
    FROM tiled WHERE name IS NOT NULL GROUP BY name)"""
_RANGES = """SELECT file, unnest(['x', 'y', 'z', 'cls']) AS dim, unnest([min(x), min(y), min(z), min(cls)])::DOUBLE AS low,
      unnest([max(x), max(y), max(z), max(cls)])::DOUBLE AS high FROM {t} GROUP BY file"""
_PAIRS = """SELECT a.tile AS a, b.tile AS b, least(a.maxx, b.maxx) - greatest(a.minx, b.minx) AS w, least(a.maxy, b.maxy) - greatest(a.miny, b.miny) AS h
      FROM v_tile a JOIN v_tile b ON a.tile < b.tile AND a.minx < b.maxx AND b.minx < a.maxx AND a.miny < b.maxy AND b.miny < a.maxy"""

_SNIFF = """
  s AS (SELECT substr(o_orderpriority, 1, 1) || '-' || o_orderstatus AS file, o_orderkey % 50 AS kind, floor(o_totalprice) AS z,
      row_number() OVER (PARTITION BY substr(o_orderpriority, 1, 1), o_orderstatus ORDER BY o_orderkey) AS rn FROM orders),
  f AS (SELECT file, min(rn) FILTER (WHERE kind <> 11) AS first, arg_min(CASE WHEN kind = 9 THEN 2 ELSE 3 END, rn) FILTER (WHERE kind <> 11) AS columns FROM s GROUP BY file)"""

ORACLE = {
    "neighbor_missing": f"""WITH {V_TILE}, t AS (SELECT tile, CASE WHEN (e + n) % 37 <> 0 THEN e END AS e, CASE WHEN (e + n) % 37 <> 0 THEN n END AS n FROM v_tile),
      d(i, d, x, y) AS (VALUES (1, 'N', 0, 1), (2, 'NE', 1, 1), (3, 'E', 1, 0), (4, 'SE', 1, -1), (5, 'S', 0, -1), (6, 'SW', -1, -1), (7, 'W', -1, 0), (8, 'NW', -1, 1)),
      m AS (SELECT t.tile, i, d.d FROM t, d WHERE NOT EXISTS (SELECT 1 FROM t u WHERE u.e = t.e + x AND u.n = t.n + y))
      SELECT t.tile, coalesce(string_agg(m.d, ',' ORDER BY i), '') AS missing FROM t LEFT JOIN m USING (tile) GROUP BY t.tile""",
    "bbox_overlap": f"""WITH {V_TILE}, p AS ({_PAIRS}), s AS (SELECT tile, (maxx - minx) * (maxy - miny) AS area FROM v_tile)
      SELECT p.* FROM p JOIN s sa ON sa.tile = a JOIN s sb ON sb.tile = b WHERE w * h > 0.01 * least(sa.area, sb.area)""",
    "bbox_overlap_rasters": f"WITH {V_TILE}, p AS ({_PAIRS}) SELECT * FROM p WHERE w > 0.05 AND h > 0.05",
    "cell_tile_overlap": f"""WITH {V_TILE} SELECT c.tile AS name, t.tile AS id FROM v_tile c JOIN v_tile t
      ON t.maxx > c.e * 1000 AND t.minx < (c.e + 1) * 1000 AND t.maxy > c.n * 1000 AND t.miny < (c.n + 1) * 1000""",
    "grid_check": f"""WITH {V_TILE}, c AS (SELECT *, (e * 3 + n) % 17 AS odd FROM v_tile),
      d AS (SELECT *, CASE odd WHEN 1 THEN 'x' || tile WHEN 2 THEN '2600_1100' ELSE tile END AS name FROM c),
      k AS (SELECT name, count(*) AS k FROM d GROUP BY name)
      SELECT tile AS id, e AS ix, n AS iy, concat_ws(',', CASE WHEN odd = 4 THEN 'crs' END, CASE WHEN maxx - minx > 1000.001 THEN 'size' END,
        CASE WHEN odd = 3 THEN 'origin' END, CASE WHEN NOT regexp_matches(name, '^[0-9]{{4}}_[0-9]{{4}}$') THEN 'name' END, CASE WHEN k > 1 THEN 'duplicate' END) AS problems
      FROM d JOIN k USING (name)""",
    "snapped_bbox": f"""WITH {V_TILE} SELECT floor(min(minx) / 1000) * 1000 AS minx, floor(min(miny) / 1000) * 1000 AS miny,
      ceil(max(maxx) / 1000) * 1000 AS maxx, ceil(max(maxy) / 1000) * 1000 AS maxy FROM v_tile""",
    "tile_uniformity": f"""WITH {V_TILE} SELECT 1 AS n_bands, 1 AS n_dtype, count(DISTINCT e % 2) AS n_gsd, 1 AS n_prefix, count(*) AS tiles,
      count(DISTINCT e % 2) <= 1 AS uniform FROM v_tile""",
    "point_tiling": f"WITH {_COARSE} SELECT ix, iy, name, count(*) AS points, CAST(sum(z) AS BIGINT) AS sum_z FROM tiled GROUP BY ALL",
    "point_balance": f"""WITH {_COARSE} SELECT count(*) AS n_in, count(name) AS n_cells, count(*) - count(name) AS n_outside, true AS balanced FROM tiled""",
    "tile_header": f"WITH {_COARSE} SELECT * FROM heads",
    "dimension_ranges": f"WITH {V_POINT} {_RANGES.format(t='v_point')}",
    "range_validation": f"""WITH {V_POINT}, q AS (SELECT * REPLACE (z + CASE file % 7 WHEN 0 THEN 5 WHEN 1 THEN 1 ELSE 0 END AS z,
          CASE WHEN file % 11 = 0 THEN cls - 1 ELSE cls END AS cls) FROM v_point WHERE file % 29 <> 0),
      s AS ({_RANGES.format(t='v_point')}), t AS ({_RANGES.format(t='q')})
      SELECT s.file, s.dim, CASE WHEN t.low IS NULL THEN 'missing' WHEN abs(s.low - t.low) > CASE WHEN s.dim = 'cls' THEN 0 ELSE 1 END THEN 'low'
        WHEN abs(s.high - t.high) > CASE WHEN s.dim = 'cls' THEN 0 ELSE 1 END THEN 'high' END AS problem
      FROM s LEFT JOIN t ON t.file = s.file AND t.dim = s.dim""",
    "source_bbox": f"""WITH {V_POINT}, b AS (SELECT file, count(*) AS points, min(x) AS minx, max(x) AS maxx, min(y) AS miny, max(y) AS maxy, min(z) AS minz, max(z) AS maxz
        FROM v_point GROUP BY file)
      SELECT file, points, minx, maxx, miny, maxy, CASE
        WHEN minx >= 240000000 AND maxx <= 290000000 AND miny >= 100000000 AND maxy <= 140000000 THEN 'LV95'
        WHEN minx >= 40000000 AND maxx <= 90000000 AND miny >= 0 AND maxy <= 40000000 THEN 'LV03' ELSE 'unknown' END AS crs,
        minz >= 15000 AND maxz <= 490000 AS z_ok FROM b""",
    "frame_gaps": f"""WITH {_COARSE}, g AS (SELECT name, minx / 100.0 AS minx, maxx / 100.0 AS maxx, miny / 100.0 AS miny, maxy / 100.0 AS maxy,
          CAST(split_part(name, '_', 1) AS INTEGER) * 1000 AS x, CAST(split_part(name, '_', 2) AS INTEGER) * 1000 AS y FROM heads),
      s AS (SELECT name, minx < x - 0.02 OR maxx > x + 1000.01 OR miny < y - 0.02 OR maxy > y + 1000.01 AS violation,
          [x FOR x IN [('west', round(minx - x, 2)), ('south', round(miny - y, 2)), ('east', round(x + 999.99 - maxx, 2)), ('north', round(y + 999.99 - maxy, 2))] IF x[2] > 1] AS gaps FROM g)
      SELECT name, violation, len(gaps) AS n_gaps, array_to_string([x[1] || ':' || printf('%.2f', x[2]) FOR x IN gaps], ',') AS gaps FROM s""",
    "requantise": """WITH v AS (SELECT l_orderkey, l_linenumber, CAST(round(l_extendedprice * 100) AS BIGINT) AS c FROM lineitem)
      SELECT l_orderkey, l_linenumber, round_even(c / 2.0::DOUBLE, 0) * 0.25::DOUBLE AS z, c % 2 <> 0 AS shifted FROM v""",
    "xyz_text": f"""WITH {_SNIFF} SELECT s.file, count(*) FILTER (WHERE kind NOT IN (9, 11)) AS points, count(*) FILTER (WHERE kind IN (9, 11)) AS ignored,
        sum(z) FILTER (WHERE kind NOT IN (9, 11)) AS sum_z FROM s JOIN f ON f.file = s.file AND columns = 3 AND rn >= first GROUP BY s.file""",
    "esri_grid_points": """WITH v AS (SELECT vec_id // 50 AS file, (vec_id % 50) * 64 + generate_subscripts(embedding, 1) - 1 AS n, unnest(embedding) AS e FROM embeddings),
      p AS (SELECT file, floor((CAST(e AS DOUBLE) + 1) * 1000) AS z, 2600000 + (n % 64 + 0.5::DOUBLE) * 2 AS x, 1100000 + (50 - n // 64 - 0.5::DOUBLE) * 2 AS y FROM v WHERE n % 13 <> 0)
      SELECT file, count(*) AS points, sum(z) AS sum_z, min(x) AS minx, max(x) AS maxx, min(y) AS miny, max(y) AS maxy, sum(x * z) AS moment_x, sum(y * z) AS moment_y FROM p GROUP BY file""",
    "las_header": """SELECT CAST(o_orderkey AS VARCHAR) AS name, CASE WHEN g THEN CAST(CASE WHEN o_orderkey % 2 = 1 THEN 4 ELSE 2 END AS INTEGER) END AS minor_version,
        CASE WHEN g THEN CAST(6 + o_orderkey % 2 AS INTEGER) END AS format, CASE WHEN g THEN o_custkey + CASE WHEN o_orderkey % 2 = 1 THEN 8589934592 ELSE 0 END END AS points,
        CASE WHEN g THEN 375 END AS header_size, CASE WHEN g THEN 30 END AS point_length, CASE WHEN g THEN 17 END AS encoding,
        CASE WHEN g THEN o_totalprice END AS minx, CASE WHEN g THEN o_totalprice + 1 END AS maxx, CASE WHEN g THEN 1.0::DOUBLE END AS miny, CASE WHEN g THEN 2.0::DOUBLE END AS maxy,
        CASE WHEN g THEN 3.0::DOUBLE END AS minz, CASE WHEN g THEN 4.0::DOUBLE END AS maxz, CASE WHEN NOT g THEN 'no LAS header' END AS problem
      FROM (SELECT *, o_orderkey % 10 <> 0 AS g FROM orders)""",
    "las_format_choice": f"""WITH {V_POINT}, p AS (SELECT file, max(red) AS red, count(*) AS n FROM v_point GROUP BY file),
      q AS (SELECT *, file % 3 = 2 AND red > 0 AS rgb, file % 2 = 0 AS keep FROM p),
      f AS (SELECT *, CASE WHEN rgb AND keep THEN 7 WHEN NOT rgb AND NOT keep THEN 6 END AS fmt FROM q)
      SELECT file, rgb AS has_rgb, fmt AS format, CASE WHEN file % 5 = 0 THEN false ELSE fmt = 6 END AS migrated, n % 2 = 0 AS encoding_warning FROM f""",
    "las_validation": f"""WITH {V_POINT}, k AS (SELECT DISTINCT file FROM v_point)
      SELECT CAST(file AS VARCHAR) AS name, CASE WHEN file % 31 = 0 THEN 'missing' ELSE concat_ws(',', CASE WHEN file % 7 = 0 THEN 'points' END,
        CASE WHEN file % 11 = 0 THEN 'version' END, CASE WHEN file % 13 = 0 THEN 'header size' END, CASE WHEN file % 17 = 0 THEN 'encoding' END,
        CASE WHEN file % 19 = 0 THEN 'crs' END) END AS problems FROM k""",
    "ascii_sniff": f"""WITH {_SNIFF} SELECT f.file, 'xyz' AS kind, CASE split_part(f.file, '-', 2) WHEN 'F' THEN ';' WHEN 'O' THEN ' ' ELSE ',' END AS sep,
        first AS skip, columns, CASE WHEN columns < 3 THEN 'columns' END AS problem FROM f""",
}
