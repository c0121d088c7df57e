"""Queries over scanlines and NoData areas."""

from __future__ import annotations

from pyspark.sql import functions as F

from surveyspark.functions import geo, pixels
from surveyspark.operators import components as C
from surveyspark.operators import raster as R
from surveyspark.operators import tiles as T

from .derive import V_SCAN, v_scan

SIZE, CONTACT = 100, 20


def _hit():
    return F.transform("band", lambda v: v == 255)


def _rgb(spark, sf_dir):
    """Three bands: NoData in all of them, else close to each other; dark pixels are made near black."""
    s = v_scan(spark, sf_dir)
    px = lambda k: F.transform("band", lambda v: F.when(v == 255, 255).when(v < 90, F.pmod(v + k, F.lit(8))).otherwise(F.least(F.lit(254), v + k)))
    return s.select("tile", "e", "n", "row", "band", px(0).alias("r"), px(1).alias("g"), px(2).alias("b"))


def _tiles(spark, sf_dir):
    t = v_scan(spark, sf_dir).groupBy("tile", "e", "n").agg(F.max(F.size("band")).alias("width"), (F.max("row") + 1).alias("height"))
    gone = T.missing_neighbours(t.select("tile", "e", "n"))
    return t.join(gone, "tile")


def _labelled(spark, sf_dir, diagonal=True):
    return R.labelled_nodata(v_scan(spark, sf_dir), _hit(), diagonal)


def mask_validity(spark, sf_dir):
    s = _rgb(spark, sf_dir).withColumn("mask", pixels.nodata_mask(F.array("r", "g", "b"), F.array(F.lit(255), F.lit(255), F.lit(255))))
    s = s.withColumns({c: pixels.zeroed(F.col(c), F.col("mask")) for c in ("r", "g", "b")})
    total = lambda c: F.sum(F.aggregate(c, F.lit(0).cast("long"), lambda a, x: a + x))
    wrong = pixels.nodata_mask(F.array("r", "g", "b"), F.array(F.lit(255))).isNull()
    return s.groupBy("tile").agg(
        F.sum(F.size(F.filter("mask", lambda x: ~x))).alias("masked"), total("r").alias("sum_r"), total("g").alias("sum_g"), total("b").alias("sum_b"),
        F.bool_and(wrong).alias("mismatch_skipped"),
    )


def hillshade_rescale(spark, sf_dir):
    once = R.rescale_hillshade(v_scan(spark, sf_dir), safe_max=160)
    return once.select("tile", "row", F.array_join("band", ",").alias("band"))


def dsm_fix(spark, sf_dir):
    band = F.transform("band", lambda v: F.when(v == 255, F.lit(-9999.0)).otherwise(v).cast("float"))
    s = v_scan(spark, sf_dir).select("tile", "row", band.alias("band"))
    fixed = s.withColumns({"n": pixels.n_false_nodata(F.col("band")), "band": pixels.fixed_dsm(F.col("band"))})
    low = F.lit(pixels.FLOAT_MIN).cast("float")
    return fixed.groupBy("tile").agg(F.sum("n").alias("fixed"), F.sum(F.size(F.filter("band", lambda v: v == low))).alias("lowest"), F.count_if(F.col("n") > 0).alias("rows"))


def empty_tiles(spark, sf_dir):
    s = v_scan(spark, sf_dir).withColumn("band", F.when(F.pmod("tile", F.lit(4)) == 1, F.transform("band", lambda _: F.lit(255))).otherwise(F.col("band")))
    return R.empty_tiles(s, _hit())


def shadow_lift(spark, sf_dir):
    s = _rgb(spark, sf_dir).withColumn("lift", pixels.shadow_lifts(F.col("r"), F.col("g"), F.col("b")))
    return s.select("tile", "row", F.array_join("lift", ",").alias("lift"), F.array_join(pixels.shifted(F.col("g"), F.col("lift")), ",").alias("g"))


def nodata_runs(spark, sf_dir):
    return C.scan_runs(v_scan(spark, sf_dir), _hit())


def components(spark, sf_dir):
    return _labelled(spark, sf_dir)


def components_4(spark, sf_dir):
    return _labelled(spark, sf_dir, diagonal=False)


def group_metrics(spark, sf_dir):
    return C.group_sizes(_labelled(spark, sf_dir), _tiles(spark, sf_dir))


def shape_metrics(spark, sf_dir):
    """Holes and roughness of every component of at least ten pixels."""
    lab = _labelled(spark, sf_dir)
    key = ["tile", "root_row", "root_c"]
    large = lab.groupBy(key).agg(F.sum(F.col("c1") - F.col("c0") + 1).alias("n")).filter("n >= 10").select(key)
    return C.shapes(lab.join(large, key, "left_semi"))


def classify_groups(spark, sf_dir):
    return C.classify(_labelled(spark, sf_dir), _tiles(spark, sf_dir), SIZE, CONTACT)


def nodata_diagnosis(spark, sf_dir):
    return C.diagnosis(classify_groups(spark, sf_dir), 0.25, SIZE)


def false_nodata_fix(spark, sf_dir):
    scan, lab = _rgb(spark, sf_dir), _labelled(spark, sf_dir)
    groups = C.classify(lab, _tiles(spark, sf_dir), SIZE, CONTACT)
    fixed = R.correct(scan.select("tile", "row", "r", "g", "b"), lab, groups, 255)
    return fixed.select("tile", "row", *[F.array_join(c, ",").alias(c) for c in ("r", "g", "b")], "false_px", "shadow_px", F.size(F.filter("mask", lambda x: ~x)).alias("real_px"))


def retile(spark, sf_dir):
    """Tiles of 64 x 50 pixels, placed edge to edge, cut into cells of 40 x 40."""
    s = v_scan(spark, sf_dir)
    t = s.select("tile", "e", "n").distinct().select("tile", ((F.col("e") - 2600) * 64).alias("x0"), ((F.col("n") - 1100) * 50).alias("y0"))
    cut = R.with_background(R.retile(s.select("tile", "row", "band"), t, 40, 255), 40, 255)
    return cut.select("cx", "cy", "row", F.array_join("band", ",").alias("band"))


def downsample(spark, sf_dir):
    return R.preview(v_scan(spark, sf_dir), 4)


def percentile_stretch(spark, sf_dir):
    return R.stretch(R.preview(v_scan(spark, sf_dir), 4))


def footprint_wkt(spark, sf_dir):
    """Footprint, extent test, thresholds and orientation of headers with pixel sizes of 0.1 and 0.25 m, some turned."""
    t = v_scan(spark, sf_dir).select("tile", "e", "n").distinct()
    gsd = F.when(F.pmod("tile", F.lit(2)) == 0, 0.1).otherwise(0.25)
    shift = F.when(F.pmod("tile", F.lit(5)) == 0, 2_000_000.0).otherwise(0.0)
    gt = F.array(F.col("e") * 1000.0 - shift, gsd, F.when(F.pmod("tile", F.lit(7)) == 0, 0.01).otherwise(0.0), F.col("n") * 1000.0 + 1000, F.lit(0.0), -gsd)
    t = t.select("tile", gt.alias("gt"), (F.lit(1000) / gsd).cast("int").alias("px"))
    g, px = F.col("gt"), F.col("px")
    th = geo.thresholds(g[1], g[5])
    return t.select(
        "tile", geo.footprint(g, px, px).alias("wkt"), geo.in_lv95(g, px, px).alias("in_lv95"), geo.north_up(g).alias("north_up"),
        th["area_px"].alias("area_px"), th["contact_px"].alias("contact_px"), geo.off_grid(g[0], g[1]).alias("off_grid"),
    )


QUERIES = {
    f.__name__: f
    for f in (
        mask_validity, hillshade_rescale, dsm_fix, empty_tiles, shadow_lift, nodata_runs, components, components_4, group_metrics, shape_metrics,
        classify_groups, nodata_diagnosis, false_nodata_fix, retile, downsample, percentile_stretch, footprint_wkt,
    )
}

_RUNS = f"""{V_SCAN},
  runs AS (SELECT tile, row, min(col) AS c0, max(col) AS c1 FROM
    (SELECT tile, row, col, col - row_number() OVER (PARTITION BY tile, row ORDER BY col) AS g FROM v_pix WHERE val = 255) GROUP BY tile, row, g)"""


def _lab(reach: int) -> str:
    return f"""{_RUNS},
  ids AS (SELECT *, row * 100000 + c0 AS id FROM runs),
  edges AS (SELECT a.tile, a.id AS x, b.id AS y FROM ids a JOIN ids b ON a.tile = b.tile AND b.row = a.row + 1 AND b.c0 <= a.c1 + {reach} AND a.c0 <= b.c1 + {reach}),
  sym AS (SELECT tile, x, y FROM edges UNION ALL SELECT tile, y, x FROM edges),
  reach(tile, id, root) AS (SELECT tile, id, id FROM ids UNION SELECT r.tile, s.y, r.root FROM reach r JOIN sym s ON s.tile = r.tile AND s.x = r.id WHERE s.y > r.root),
  lab AS (SELECT i.tile, i.row, i.c0, i.c1, CAST(m.root // 100000 AS INTEGER) AS root_row, CAST(m.root % 100000 AS INTEGER) AS root_c
    FROM ids i JOIN (SELECT tile, id, min(root) AS root FROM reach GROUP BY ALL) m ON m.tile = i.tile AND m.id = i.id)"""


_TILE = """
  tl AS (SELECT tile, e, n, max(row) AS row9, max(col) AS col9 FROM v_pix GROUP BY tile, e, n),
  dirs(d, x, y) AS (VALUES ('N', 0, 1), ('NE', 1, 1), ('E', 1, 0), ('SE', 1, -1), ('S', 0, -1), ('SW', -1, -1), ('W', -1, 0), ('NW', -1, 1)),
  gone AS (SELECT tile, list(d) AS missing FROM tl, dirs WHERE NOT EXISTS (SELECT 1 FROM tl u WHERE u.e = tl.e + x AND u.n = tl.n + y) GROUP BY tile),
  px AS (SELECT p.tile, p.row, p.col, l.root_row, l.root_c FROM v_pix p JOIN lab l ON l.tile = p.tile AND l.row = p.row AND p.col BETWEEN l.c0 AND l.c1),
  bpx AS (SELECT px.*, row IN (0, row9) OR col IN (0, col9) AS border,
      CASE WHEN NOT (row IN (0, row9) OR col IN (0, col9)) THEN false ELSE list_has_any(coalesce(missing, []),
        CASE WHEN row = 0 AND col = 0 THEN ['N', 'NW', 'W'] WHEN row = 0 AND col = col9 THEN ['N', 'NE', 'E'] WHEN row = row9 AND col = 0 THEN ['S', 'SW', 'W']
          WHEN row = row9 AND col = col9 THEN ['S', 'SE', 'E'] WHEN row = 0 AND row = row9 THEN ['N', 'S'] WHEN row = 0 THEN ['N'] WHEN row = row9 THEN ['S']
          WHEN col = 0 THEN ['W'] ELSE ['E'] END) END AS opened
    FROM px JOIN tl ON tl.tile = px.tile LEFT JOIN gone ON gone.tile = px.tile),
  sizes AS (SELECT tile, root_row, root_c, count(*) AS size_px, count(*) FILTER (WHERE border) AS border_px, count(*) FILTER (WHERE opened) AS open_px,
      min(row) AS row0, max(row) AS row1, min(col) AS col0, max(col) AS col1 FROM bpx GROUP BY tile, root_row, root_c)"""
# holes pixel by pixel: the background of a group's box is walked from the box's edge
_SHAPE = """
  cand AS (SELECT * FROM sizes WHERE {which}),
  cells AS (SELECT c.tile, c.root_row, c.root_c, r.r AS row, k.k AS col, p.tile IS NOT NULL AS own,
      r.r IN (row0, row1) OR k.k IN (col0, col1) AS edge
    FROM cand c, range(0, 50) r(r), range(0, 64) k(k)
    LEFT JOIN px p ON p.tile = c.tile AND p.root_row = c.root_row AND p.root_c = c.root_c AND p.row = r.r AND p.col = k.k
    WHERE r.r BETWEEN row0 AND row1 AND k.k BETWEEN col0 AND col1),
  walk(tile, root_row, root_c, row, col) AS (
    SELECT tile, root_row, root_c, row, col FROM cells WHERE edge AND NOT own
    UNION
    SELECT c.tile, c.root_row, c.root_c, c.row, c.col FROM walk w JOIN cells c ON c.tile = w.tile AND c.root_row = w.root_row AND c.root_c = w.root_c
      AND NOT c.own AND ((c.row = w.row AND abs(c.col - w.col) = 1) OR (c.col = w.col AND abs(c.row - w.row) = 1))),
  filled AS (SELECT c.*, w.tile IS NULL AS inn FROM cells c LEFT JOIN walk w ON w.tile = c.tile AND w.root_row = c.root_row AND w.root_c = c.root_c AND w.row = c.row AND w.col = c.col),
  outline AS (SELECT f.tile, f.root_row, f.root_c, count(*) FILTER (WHERE f.inn AND NOT f.own) AS hole_px,
      sum(CASE WHEN f.inn THEN 4 - coalesce(g.k, 0) ELSE 0 END) AS contour
    FROM filled f LEFT JOIN (SELECT a.tile, a.root_row, a.root_c, a.row, a.col, count(*) AS k FROM filled a JOIN filled b ON b.tile = a.tile AND b.root_row = a.root_row AND b.root_c = a.root_c
        AND b.inn AND ((b.row = a.row AND abs(b.col - a.col) = 1) OR (b.col = a.col AND abs(b.row - a.row) = 1)) WHERE a.inn GROUP BY ALL) g
      ON g.tile = f.tile AND g.root_row = f.root_row AND g.root_c = f.root_c AND g.row = f.row AND g.col = f.col GROUP BY ALL),
  shape AS (SELECT c.tile, c.root_row, c.root_c, hole_px, contour / (2.0::DOUBLE * (row1 - row0 + col1 - col0 + 2)) AS roughness FROM cand c JOIN outline o
    ON o.tile = c.tile AND o.root_row = c.root_row AND o.root_c = c.root_c)"""
_CLASS = f"""{_lab(1)}, {_TILE}, {_SHAPE.format(which=f'size_px >= {SIZE} AND border_px >= {CONTACT}')},
  cls AS (SELECT s.tile, s.root_row, s.root_c, size_px, CASE WHEN size_px >= {SIZE} THEN border_px > 0 END AS touches_border,
      CASE WHEN size_px >= {SIZE} THEN border_px END AS border_contact_px, hole_px / CAST(size_px AS DOUBLE) AS hole_ratio, roughness,
      CASE WHEN size_px >= {SIZE} AND missing IS NOT NULL THEN open_px END AS open_contact_px,
      CASE WHEN roughness IS NOT NULL THEN hole_px / CAST(size_px AS DOUBLE) >= 0.01 AND roughness >= 1.5 AND open_px > 0 END AS edge_override,
      CASE WHEN roughness IS NULL THEN 'false_nodata' WHEN hole_px / CAST(size_px AS DOUBLE) >= 0.01 AND roughness >= 1.5 AND open_px = 0 THEN 'false_nodata' ELSE 'real_nodata' END AS decision
    FROM sizes s LEFT JOIN shape h ON h.tile = s.tile AND h.root_row = s.root_row AND h.root_c = s.root_c LEFT JOIN gone ON gone.tile = s.tile)"""
_RGB = f"""{V_SCAN}, rgb AS (SELECT *, CASE WHEN val = 255 THEN 255 WHEN val < 90 THEN val % 8 ELSE least(254, val) END AS r,
    CASE WHEN val = 255 THEN 255 WHEN val < 90 THEN (val + 1) % 8 ELSE least(254, val + 1) END AS g,
    CASE WHEN val = 255 THEN 255 WHEN val < 90 THEN (val + 2) % 8 ELSE least(254, val + 2) END AS b FROM v_pix)"""
_LIFT = "CASE WHEN greatest(r, g, b) <= 5 THEN [5, 4, 3, 2, 1, 1][least(r, g, b) + 1] ELSE 0 END"



def percentiles(table: str, value: str) -> str:
    """The 2nd and 98th percentile of each tile as low and high: between two values by their shares of the way, as written here."""
    low, high = (lambda a: f"v[CAST(floor({a}) AS BIGINT) + 1]"), (lambda a: f"v[CAST(ceil({a}) AS BIGINT) + 1]")
    at = lambda a: f"CASE WHEN {low(a)} = {high(a)} THEN {low(a)} ELSE (ceil({a}) - {a}) * {low(a)} + ({a} - floor({a})) * {high(a)} END"
    return f"""SELECT tile, {at("a")} AS low, {at("b")} AS high FROM
        (SELECT tile, list_sort(list({value})) AS v, (count(*) - 1) * 0.02::DOUBLE AS a, (count(*) - 1) * 0.98::DOUBLE AS b FROM {table} GROUP BY tile)"""


ORACLE = {
    "mask_validity": f"""WITH {_RGB} SELECT tile, count(*) FILTER (WHERE val = 255) AS masked, CAST(sum(CASE WHEN val = 255 THEN 0 ELSE r END) AS BIGINT) AS sum_r,
      CAST(sum(CASE WHEN val = 255 THEN 0 ELSE g END) AS BIGINT) AS sum_g, CAST(sum(CASE WHEN val = 255 THEN 0 ELSE b END) AS BIGINT) AS sum_b, true AS mismatch_skipped FROM rgb GROUP BY tile""",
    "hillshade_rescale": f"""WITH {V_SCAN}, t AS (SELECT tile, max(val) FILTER (WHERE val <> 255) > 160 AS todo FROM v_pix GROUP BY tile)
      SELECT tile, row, string_agg(CASE WHEN todo AND val <> 255 THEN CAST(round_even(val * 160 / 254.0, 0) AS INTEGER) ELSE val END, ',' ORDER BY col) AS band
      FROM v_pix JOIN t USING (tile) GROUP BY tile, row""",
    "dsm_fix": f"""WITH {V_SCAN} SELECT tile, count(*) FILTER (WHERE val = 255) AS fixed, count(*) FILTER (WHERE val = 255) AS lowest,
      count(DISTINCT row) FILTER (WHERE val = 255) AS rows FROM v_pix GROUP BY tile""",
    "empty_tiles": f"WITH {V_SCAN} SELECT tile, bool_and(val = 255 OR tile % 4 = 1) AS empty FROM v_pix GROUP BY tile",
    "shadow_lift": f"""WITH {_RGB} SELECT tile, row, string_agg({_LIFT}, ',' ORDER BY col) AS lift, string_agg(least(255, g + {_LIFT}), ',' ORDER BY col) AS g FROM rgb GROUP BY tile, row""",
    "nodata_runs": f"WITH {_RUNS} SELECT * FROM runs",
    "components": f"WITH RECURSIVE {_lab(1)} SELECT * FROM lab",
    "components_4": f"WITH RECURSIVE {_lab(0)} SELECT * FROM lab",
    "group_metrics": f"""WITH RECURSIVE {_lab(1)}, {_TILE} SELECT sizes.*, r.runs FROM sizes JOIN
      (SELECT tile, root_row, root_c, count(*) AS runs FROM lab GROUP BY ALL) r USING (tile, root_row, root_c)""",
    "shape_metrics": f"WITH RECURSIVE {_lab(1)}, {_TILE}, {_SHAPE.format(which='size_px >= 10')} SELECT * FROM shape",
    "classify_groups": f"WITH RECURSIVE {_CLASS} SELECT * FROM cls",
    "nodata_diagnosis": f"""WITH RECURSIVE {_CLASS} SELECT tile, root_row, root_c, CAST(round_even(size_px * 0.0625, 1) AS DOUBLE) AS area_m2, CAST(round_even(border_contact_px * 0.25, 1) AS DOUBLE) AS contact_m,
      round_even(hole_ratio, 4) AS hole_ratio, round_even(roughness, 3) AS roughness, decision FROM cls WHERE size_px >= {SIZE}""",
    "false_nodata_fix": f"""WITH RECURSIVE {_CLASS},
      rgb AS (SELECT p.tile, p.row, p.col, p.val, c.decision, CASE WHEN val = 255 THEN 255 WHEN val < 90 THEN val % 8 ELSE least(254, val) END AS r,
          CASE WHEN val = 255 THEN 255 WHEN val < 90 THEN (val + 1) % 8 ELSE least(254, val + 1) END AS g,
          CASE WHEN val = 255 THEN 255 WHEN val < 90 THEN (val + 2) % 8 ELSE least(254, val + 2) END AS b
        FROM v_pix p LEFT JOIN px ON px.tile = p.tile AND px.row = p.row AND px.col = p.col LEFT JOIN cls c ON c.tile = px.tile AND c.root_row = px.root_row AND c.root_c = px.root_c),
      s AS (SELECT *, CASE WHEN decision = 'false_nodata' THEN -1 ELSE {_LIFT} END AS shift, decision IS NOT NULL AND decision = 'real_nodata' AS real FROM rgb)
      SELECT tile, row, string_agg(CASE WHEN real THEN 0 ELSE r + shift END, ',' ORDER BY col) AS r, string_agg(CASE WHEN real THEN 0 ELSE g + shift END, ',' ORDER BY col) AS g,
        string_agg(CASE WHEN real THEN 0 ELSE b + shift END, ',' ORDER BY col) AS b, count(*) FILTER (WHERE decision = 'false_nodata') AS false_px,
        count(*) FILTER (WHERE {_LIFT} <> 0) AS shadow_px, count(*) FILTER (WHERE real) AS real_px FROM s GROUP BY tile, row""",
    "retile": f"""WITH {V_SCAN}, p AS (SELECT (e - 2600) * 64 + col AS x, (n - 1100) * 50 + row AS y, val FROM v_pix),
      c AS (SELECT DISTINCT x // 40 AS cx, y // 40 AS cy FROM p WHERE val <> 255),
      g AS (SELECT cx, cy, r.r AS row, k.k AS col FROM c, range(0, 40) r(r), range(0, 40) k(k))
      SELECT CAST(cx AS BIGINT) AS cx, CAST(cy AS BIGINT) AS cy, CAST(row AS INTEGER) AS row, string_agg(coalesce(val, 255), ',' ORDER BY col) AS band
      FROM g LEFT JOIN p ON p.x = cx * 40 + col AND p.y = cy * 40 + row GROUP BY cx, cy, row""",
    "downsample": f"WITH {V_SCAN} SELECT tile, CAST(row // 4 AS INTEGER) AS r, CAST(col // 4 AS INTEGER) AS c, avg(val) AS value FROM v_pix GROUP BY ALL",
    "percentile_stretch": f"""WITH {V_SCAN}, d AS (SELECT tile, CAST(row // 4 AS INTEGER) AS r, CAST(col // 4 AS INTEGER) AS c, avg(val) AS value FROM v_pix GROUP BY ALL),
      p AS ({percentiles('d', 'value')})
      SELECT d.tile, r, c, CAST(floor(CASE WHEN high > low THEN greatest(0.0, least(255.0, (value - low) / (high - low) * 255)) ELSE 0 END) AS INTEGER) AS grey FROM d JOIN p USING (tile)""",
    "footprint_wkt": f"""WITH {V_SCAN}, t AS (SELECT DISTINCT tile, e * 1000.0::DOUBLE - CASE WHEN tile % 5 = 0 THEN 2000000 ELSE 0 END AS x, n * 1000.0::DOUBLE + 1000 AS y,
          CASE WHEN tile % 2 = 0 THEN 0.1::DOUBLE ELSE 0.25::DOUBLE END AS gsd, CASE WHEN tile % 7 = 0 THEN 0.01::DOUBLE ELSE 0.0::DOUBLE END AS rot FROM v_pix),
      c AS (SELECT *, CASE WHEN gsd = 0.1::DOUBLE THEN 10000 ELSE 4000 END AS px FROM t),
      k AS (SELECT *, x + px * rot AS llx, y - px * gsd AS lly, x + px * gsd + px * rot AS lrx, x + px * gsd AS urx FROM c)
      SELECT tile, printf('POLYGON ((%.3f %.3f, %.3f %.3f, %.3f %.3f, %.3f %.3f, %.3f %.3f))', llx, lly, lrx, lly, urx, y, x, y, llx, lly) AS wkt,
        tile % 5 <> 0 AND lrx <= 2900000 AND y <= 1350000 AS in_lv95, rot = 0 AS north_up, CASE WHEN gsd = 0.1::DOUBLE THEN 90000 ELSE 14400 END AS area_px,
        CASE WHEN gsd = 0.1::DOUBLE THEN 800 ELSE 320 END AS contact_px, false AS off_grid FROM k""",
}
