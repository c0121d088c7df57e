"""Points: text sources to points, cells, balance, ranges and their comparison."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from surveyspark.functions import geo
from surveyspark.sources.shared import saved

DIMENSIONS = ("x", "y", "z", "cls")
#: Lines of a text grid that are numbered together.
BLOCK = 4096


def _keyed(points: DataFrame, size: int) -> DataFrame:
    return points.withColumns({"ix": F.floor(F.col("x") / size).cast("int"), "iy": F.floor(F.col("y") / size).cast("int")})


def cells_in_use(points: DataFrame, cells: DataFrame, size: int) -> DataFrame:
    """ix, iy, name of the cells that hold points (read twice, then): what points need of a grid that may be far larger. Points are
    counted out by their cells in tasks, so no point is sent."""
    used = saved(_keyed(points, size).select("ix", "iy").distinct(), "cells-in-use")
    return cells.select("ix", "iy", "name").join(used, ["ix", "iy"], "left_semi")


def to_cells(points: DataFrame, cells: DataFrame, size: int) -> DataFrame:
    """points (x, y, ..) with ix, iy and the cell's name, null outside."""
    keyed = _keyed(points, size)
    return keyed.join(cells.select("ix", "iy", "name"), ["ix", "iy"], "left")


def balance(tiled: DataFrame, expected: int | None = None) -> DataFrame:
    """One row: points in, in cells and outside, and whether they add up."""
    out = tiled.agg(F.count("*").alias("n_in"), F.count("name").alias("n_cells"), F.count_if(F.col("name").isNull()).alias("n_outside"))
    total = F.col("n_in") if expected is None else F.lit(expected)
    return out.withColumn("balanced", total == F.col("n_cells") + F.col("n_outside"))


def tile_headers(tiled: DataFrame) -> DataFrame:
    """Per cell: points and bounding box."""
    return tiled.filter("name IS NOT NULL").groupBy("name").agg(
        F.count("*").alias("points"), *[f(c).alias(f"{n}{c}") for c in ("x", "y", "z") for n, f in (("min", F.min), ("max", F.max))]
    )


def ranges(points: DataFrame, by: str, dims: tuple[str, ...] = DIMENSIONS) -> DataFrame:
    """by, dim, low, high: one row for each file and dimension."""
    return range_rows(points.groupBy(by).agg(*ends(dims)), by, dims)


def ends(dims: tuple[str, ...]) -> list[Column]:
    """Aggregates low_x, high_x, .. of the dimensions."""
    return [f(c).cast("double").alias(f"{n}_{c}") for c in dims for n, f in (("low", F.min), ("high", F.max))]


def range_rows(wide: DataFrame, by: str, dims: tuple[str, ...]) -> DataFrame:
    """by and ``ends`` -> by, dim, low, high."""
    pairs = F.array(*[F.struct(F.lit(c).alias("dim"), F.col(f"low_{c}").alias("low"), F.col(f"high_{c}").alias("high")) for c in dims])
    return wide.select(by, F.inline(pairs))


def compare_ranges(source: DataFrame, target: DataFrame, by: str, tolerance: float, exact: tuple[str, ...] = ("cls",)) -> DataFrame:
    """by, dim, problem: missing, or the side that differs by more than the tolerance (exact dimensions: at all)."""
    t = target.select(by, "dim", F.col("low").alias("t_low"), F.col("high").alias("t_high"))
    joined = source.join(t, [by, "dim"], "left")
    limit = F.when(F.col("dim").isin(*exact), 0.0).otherwise(tolerance)
    problem = (
        F.when(F.col("t_low").isNull() | F.col("t_high").isNull(), "missing")
        .when(F.abs(F.col("low") - F.col("t_low")) > limit + 1e-9, "low")
        .when(F.abs(F.col("high") - F.col("t_high")) > limit + 1e-9, "high")
    )
    return joined.select(by, "dim", problem.alias("problem"))


def header_checks(source: DataFrame, target: DataFrame) -> DataFrame:
    """LAS headers (name, points, minor_version, format, point_length, header_size, encoding, horizontal, vertical) before and
    after conversion -> name, problems."""
    t = target.select("name", *[F.col(c).alias(f"t_{c}") for c in target.columns if c != "name"])
    j = source.select("name", F.col("points").alias("s_points")).join(t, "name", "left")
    sizes = F.when(F.col("t_format") == 7, 36).otherwise(30)
    checks = [
        (F.col("t_points").isNull(), "missing"),
        (F.col("t_points") != F.col("s_points"), "points"),
        (F.col("t_minor_version") != 4, "version"),
        (~F.col("t_format").isin(6, 7), "format"),
        (F.col("t_point_length") != sizes, "point length"),
        (F.col("t_header_size") != 375, "header size"),
        (F.col("t_encoding") != 17, "encoding"),
        ((F.col("t_horizontal") != "2056") | (F.col("t_vertical") != "5728"), "crs"),
    ]
    return j.select("name", F.filter(F.array(*[F.when(c, m) for c, m in checks]), lambda x: x.isNotNull()).alias("problems"))


def vlr_checks(headers: DataFrame) -> DataFrame:
    """headers (name, vlrs array of user_id, record_id, data; wkt) of converted files -> name, problems: records of the coordinate
    system that are missing, a text that doesn't end on a null byte (the last such record counts), heights in LHN95."""
    record = lambda n: F.filter("vlrs", lambda v: (v["record_id"] == n) & (v["user_id"] == "LASF_Projection"))
    text = F.try_element_at(record(2112), F.lit(-1))["data"]
    lacks = lambda n: F.coalesce(F.size(record(n)) <= 0, F.lit(True))
    checks = [
        (lacks(34735), "no key directory"),
        (lacks(2112), "no WKT"),
        (~lacks(2112) & ~F.coalesce(F.hex(text).endswith("00"), F.lit(False)), "WKT without null byte"),
        (F.coalesce(F.col("wkt"), F.lit("")).rlike("5729|LHN95"), "LHN95"),
    ]
    return headers.select("name", F.filter(F.array(*[F.when(c, m) for c, m in checks]), lambda x: x.isNotNull()).alias("problems"))


def box_deviations(headers: DataFrame, points: DataFrame, by: str, tolerance: float = 0.01) -> DataFrame:
    """headers (by, minx .. maxz) against ``ranges`` of the points: by, deviations: the fields of the header that differ by more
    than the tolerance (``minx``) or that one side lacks (``minx missing``)."""
    side = lambda d, end: F.max(F.when(F.col("dim") == d, F.col(end)))
    fields = [(f"{n}{d}", side(d, end)) for d in ("x", "y", "z") for n, end in (("min", "low"), ("max", "high"))]
    wide = points.groupBy(by).agg(*[v.alias(f"p_{f}") for f, v in fields])
    j = headers.select(by, *[F.col(f).cast("double").alias(f) for f, _ in fields]).join(wide, by, "left")
    found = [
        F.when(F.col(f).isNull() | F.col(f"p_{f}").isNull(), f"{f} missing").when(F.abs(F.col(f) - F.col(f"p_{f}")) > tolerance + 1e-9, f)
        for f, _ in fields
    ]
    return j.select(by, F.filter(F.array(*found), lambda x: x.isNotNull()).alias("deviations"))


def frame_report(headers: DataFrame, limit: float = geo.EPS) -> DataFrame:
    """headers (name, e_km, n_km, minx, maxx, miny, maxy in m) with violation and gaps."""
    args = [F.col(c) for c in ("minx", "maxx", "miny", "maxy", "e_km", "n_km")]
    return headers.withColumns({"violation": geo.frame_violation(*args), "gaps": geo.frame_gaps(*args, limit=limit)})


# Names of columns in text point clouds.
KNOWN_COLUMNS = {"x": "X", "y": "Y", "z": "Z", "h": "Z", "intensity": "Intensity", "classification": "Classification", "class": "Classification"}
NUMBER = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"


def _fields(line, sep):
    blank = F.split(F.trim(F.regexp_replace(line, r"\s+", " ")), " ")
    return F.when(sep == " ", blank).otherwise(F.transform(F.split(line, sep), lambda x: F.trim(x)))


def _not_blank(lines: DataFrame) -> DataFrame:
    """file, line_no, value of the lines with any text. A filter would be pushed below what makes the lines and make them twice; a
    generator keeps its place."""
    text = F.explode(F.array(F.when(F.trim("value") != "", F.col("value")))).alias("value")
    return lines.select("file", "line_no", text).filter("value IS NOT NULL")


def sniff(lines: DataFrame, sample: int = 50) -> DataFrame:
    """lines (file, line_no, value) -> per file: kind, sep, skip (header lines), first_line (line_no below them), columns, problem;
    from its first lines."""
    text = _not_blank(lines)
    rank = F.row_number().over(Window.partitionBy("file").orderBy("line_no"))
    head = text.withColumn("k", rank).filter(F.col("k") <= sample)
    key = F.lower(F.regexp_extract("value", r"^\s*([A-Za-z_]+)\s", 1))
    head = head.withColumn("is_key", key.isin("ncols", "nrows", "xllcorner", "xllcenter", "yllcorner", "yllcenter", "cellsize", "nodata_value"))
    sep = F.when(F.col("value").contains("\t"), "\t").when(F.col("value").contains(";"), ";").when(F.col("value").contains(","), ",").otherwise(" ")
    head = head.withColumn("sep", sep).withColumn("parts", _fields(F.col("value"), F.col("sep")))
    head = head.withColumn("numeric", F.forall("parts", lambda x: x.rlike(NUMBER)))
    files = head.groupBy("file").agg(
        F.max_by("is_key", -F.col("k")).alias("grid"),
        F.min(F.when(F.col("numeric"), F.col("k"))).alias("first"),
        F.min(F.when(F.col("numeric"), F.col("line_no"))).alias("first_line"),
        F.min_by("sep", F.when(F.col("numeric"), F.col("k"))).alias("sep"),
        F.min_by(F.size("parts"), F.when(F.col("numeric"), F.col("k"))).alias("columns"),
    )
    kind = F.when(F.col("grid"), "grid").otherwise("xyz")
    problem = F.when(kind == "grid", F.lit(None)).when(F.col("first").isNull(), "no numbers").when(F.col("columns") < 3, "columns")
    return files.select("file", kind.alias("kind"), "sep", (F.col("first") - 1).alias("skip"), "first_line", "columns", problem.alias("problem"))


def text_columns(lines: DataFrame, sniffed: DataFrame, sample: int = 50) -> DataFrame:
    """file, names (of its columns: from the last header line if it has as many fields, else X Y Z Col4 ..), crs (by the range of
    the sampled points) of text point clouds without a problem."""
    s = sniffed.filter("kind = 'xyz' AND problem IS NULL").select("file", "sep", "skip", "columns")
    rank = F.row_number().over(Window.partitionBy("file").orderBy("line_no"))
    head = lines.filter(F.trim("value") != "").withColumn("k", rank).filter(F.col("k") <= sample).join(s, "file")
    head = head.withColumn("parts", _fields(F.col("value"), F.col("sep")))
    num = lambda i: F.try_element_at("parts", F.lit(i)).try_cast("double")
    point = (F.col("k") > F.col("skip")) & (F.size("parts") >= 3) & num(1).isNotNull() & num(2).isNotNull()
    ends = [f(F.when(point, num(i))).alias(f"{n}{c}") for i, c in ((1, "x"), (2, "y")) for n, f in (("min", F.min), ("max", F.max))]
    files = head.groupBy("file", "columns").agg(F.max(F.when(F.col("k") == F.col("skip"), F.col("parts"))).alias("title"), *ends)
    known = F.create_map(*[F.lit(x) for kv in KNOWN_COLUMNS.items() for x in kv])
    plain = F.transform(F.sequence(F.lit(1), F.col("columns")), lambda i: F.when(i <= 3, F.substr(F.lit("XYZ"), i, F.lit(1))).otherwise(F.concat(F.lit("Col"), i.cast("string"))))
    named = F.zip_with(F.transform("title", lambda t: F.try_element_at(known, F.lower(F.btrim(t, F.lit('"'))))), plain, lambda a, b: F.coalesce(a, b))
    names = F.when(F.size("title") == F.col("columns"), named).otherwise(plain)
    return files.select("file", names.alias("names"), geo.classify_bbox(*[F.col(c) for c in ("minx", "maxx", "miny", "maxy")]).alias("crs"))


def xyz_points(lines: DataFrame, sniffed: DataFrame) -> DataFrame:
    """lines and their files' sniffs -> file, line_no, x, y, z, ignored (rows with another number of columns or no numbers)."""
    s = sniffed.filter("kind = 'xyz' AND problem IS NULL").select("file", "sep", "first_line", "columns")
    parts = _not_blank(lines).join(s, "file").filter(F.col("line_no") >= F.col("first_line")).withColumn("parts", _fields(F.col("value"), F.col("sep")))
    num = lambda i: F.try_element_at("parts", F.lit(i)).try_cast("double")
    ok = (F.size("parts") == F.col("columns")) & num(1).isNotNull() & num(2).isNotNull() & num(3).isNotNull()
    return parts.select("file", "line_no", num(1).alias("x"), num(2).alias("y"), num(3).alias("z"), (~ok).alias("ignored"))


def grid_points(lines: DataFrame) -> DataFrame:
    """ESRI ASCII grids (file, line_no, value) -> file, x, y, z at the cells' centres, NODATA cells left out.

    Values may break lines anywhere; their place follows from the running number of values in the file: lines are counted in
    blocks of ``BLOCK``, so a file of any length is dealt to many tasks.
    """
    key = F.lower(F.regexp_extract("value", r"^\s*([A-Za-z_]+)\s+\S", 1))
    tagged = lines.withColumn("key", key)
    h = tagged.filter("key <> ''").select("file", "key", F.regexp_extract("value", r"^\s*[A-Za-z_]+\s+(\S+)", 1).cast("double").alias("v"))
    pick = lambda *ks: F.max(F.when(F.col("key").isin(*ks), F.col("v")))
    header = h.groupBy("file").agg(
        pick("ncols").cast("long").alias("ncols"), pick("nrows").cast("long").alias("nrows"), pick("cellsize").alias("cs"),
        F.coalesce(pick("xllcorner"), pick("xllcenter") - pick("cellsize") / 2).alias("x0"),
        F.coalesce(pick("yllcorner"), pick("yllcenter") - pick("cellsize") / 2).alias("y0"), pick("nodata_value").alias("nd"),
    )
    body = tagged.filter("key = '' AND trim(value) <> ''").withColumn("vals", F.split(F.trim("value"), r"\s+"))
    body = body.withColumn("block", F.floor(F.col("line_no") / BLOCK))
    running = lambda value, *by: F.coalesce(F.sum(value).over(Window.partitionBy(*by[:-1]).orderBy(by[-1]).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    blocks = body.groupBy("file", "block").agg(F.sum(F.size("vals")).alias("n"))
    blocks = blocks.select("file", "block", running("n", "file", "block").alias("start"))
    body = body.withColumn("off", running(F.size("vals"), "file", "block", "line_no")).join(blocks, ["file", "block"])
    cells = body.select("file", (F.col("start") + F.col("off")).alias("off"), F.posexplode("vals").alias("i", "v")).join(header, "file")
    at = F.col("off") + F.col("i")
    col, row, z = at % F.col("ncols"), F.floor(at / F.col("ncols")), F.col("v").cast("double")
    tol = F.greatest(F.abs("nd") * 1e-6, F.lit(1e-6))
    kept = cells.select(
        "file", (F.col("x0") + (col + 0.5) * F.col("cs")).alias("x"), (F.col("y0") + (F.col("nrows") - row - 0.5) * F.col("cs")).alias("y"),
        z.alias("z"), F.coalesce(z.between(F.col("nd") - tol, F.col("nd") + tol), F.lit(False)).alias("none"),
    )
    return kept.filter("NOT none").drop("none")
