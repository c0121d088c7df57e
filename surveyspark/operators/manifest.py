"""File manifests: rules on names, rows of files.csv, sidecars, merging, reorganising by line."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from surveyspark.functions import names as N
from surveyspark.rules import ADS80


def check_names(files: DataFrame, rules: DataFrame, camera: Column) -> DataFrame:
    """files (gds, name, ..) with ``fits``: whether any pattern of the product (and camera) matches. rules: a few rows."""
    by_gds = rules.groupBy("gds").agg(F.collect_list(F.struct("camera", "pattern")).alias("patterns"))
    joined = files.withColumn("_camera", camera).join(F.broadcast(by_gds), "gds", "left")
    hit = F.exists("patterns", lambda p: (p["camera"].isNull() | (p["camera"] == F.col("_camera"))) & F.rlike(F.col("name"), p["pattern"]))
    return joined.withColumn("fits", F.coalesce(hit, F.lit(False))).drop("patterns", "_camera")


def cleanup(files: DataFrame, kept: DataFrame) -> DataFrame:
    """files (gds, name, ..) with ``keep``: extension allowed; files of unknown products stay."""
    by_gds = F.broadcast(kept.groupBy("gds").agg(F.collect_set("ext").alias("exts")))
    joined = files.join(by_gds, "gds", "left")
    return joined.withColumn("keep", F.coalesce(F.array_contains("exts", N.extension(F.col("name"))), F.lit(True))).drop("exts")


# What goes before files are sorted into line folders.
UNWANTED = (".pyr", ".xml", ".rdx")


def unwanted(files: DataFrame) -> DataFrame:
    """files (name, ..) that go before the others are sorted into line folders."""
    return files.filter(N.extension(F.col("name")).isin(*UNWANTED))


def precalc_folders(entries: DataFrame) -> DataFrame:
    """entries (package, name, is_dir) -> package, folder (its spelling of the folder of precalculated formats), problem (missing,
    or several spellings)."""
    hit = F.col("is_dir") & (F.lower("name") == "precalculatedformats")
    found = entries.groupBy("package").agg(F.array_sort(F.collect_set(F.when(hit, F.col("name")))).alias("names"))
    problem = F.when(F.size("names") == 0, "missing").when(F.size("names") > 1, F.concat(F.lit("several: "), F.array_join("names", ", ")))
    return found.select("package", F.when(problem.isNull(), F.get("names", F.lit(0))).alias("folder"), problem.alias("problem"))


def reorganise(files: DataFrame, existing: DataFrame) -> DataFrame:
    """files (name) with line and status: moved, skipped (there already) or unknown. existing: line, name."""
    lines = files.withColumn("line", N.line_token(F.col("name")))
    there = existing.select("line", "name").distinct().withColumn("there", F.lit(True))
    joined = lines.join(there, ["line", "name"], "left")
    status = F.when(F.col("line").isNull(), "unknown").when(F.col("there"), "skipped").otherwise("moved")
    return joined.withColumn("status", status).drop("there")


def csv_rows(files: DataFrame, precalc: str = "PreCalculatedFormats") -> DataFrame:
    """files (ord, gds, name, md5, footprint) -> ord, part, line: the rows of files.csv. Point clouds have two."""
    name, gds, md5, key, last, ext, part = (F.col(c) for c in ("name", "gds", "md5", "key", "last", "ext", "part"))
    row = lambda *parts: F.concat_ws(";", *[F.coalesce(p, F.lit("")) for p in parts])
    path = lambda *parts: F.concat_ws("\\", *parts)
    add, none, nv = F.lit("add"), F.lit(""), F.lit("NV")
    one, points = F.array(F.lit(0)), (gds == "SB_DSM_PUNKTWOLKE") & (ext == ".laz")
    # rows are numbered before their texts are made: a reader of some parts or none of the texts doesn't pay for the others
    numbers = F.when(gds == "SB_DSM", one).when(points, F.array(F.lit(0), F.lit(1))).when(gds.isin("SB_DOP", "SB_DOP_16"), F.when(ext == ".tif", one)).otherwise(one)
    numbered = files.select("ord", "gds", "name", "md5", "footprint", N.extension(name).alias("ext")).select("*", F.explode(numbers).alias("part"))
    # what is used more than once is a column by then
    parted = numbered.withColumn("parts", N.parts(name))
    ends = F.concat_ws("_", F.try_element_at("parts", F.lit(-2)), F.try_element_at("parts", F.lit(-1)))
    keyed = parted.withColumns({"key": N.tile_key_of(F.col("parts")), "last": ends})
    line = (
        F.when(part == 1, row(path(F.lit(precalc), gds, N.precalc_laz(key)), md5, key, add, none))
        .when(gds == "SB_DSM", row(path(nv, N.dsm_folder(name), name), md5, F.lit("1000"), add, F.col("footprint")))
        .when(points, row(path(nv, gds, name), md5, key, add, none))
        .when(gds.isin("SB_DOP", "SB_DOP_16"), row(path(nv, name), md5, key, add, none))
        .otherwise(row(path(nv, name), md5, last, add, none))
    )
    return keyed.select("ord", "part", line.alias("line"))


def append(existing: DataFrame, new: DataFrame) -> DataFrame:
    """existing (run, ord, part, line) and new rows (ord, part, line) as the next run, blank lines left out."""
    last = existing.agg(F.coalesce(F.max("run"), F.lit(-1)).alias("last"))
    fresh = new.join(F.broadcast(last)).select((F.col("last") + 1).cast("int").alias("run"), "ord", "part", "line")
    # a filter would be pushed below what makes the lines and make them twice; a generator keeps its place
    text = F.explode(F.array(F.when(F.trim("line") != "", F.col("line")))).alias("line")
    both = existing.select("run", "ord", "part", text).unionByName(fresh.select("run", "ord", "part", text))
    return both.filter("line IS NOT NULL")


def merge_trees(existing: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """Same key: the new row; other rows of either stay."""
    return existing.join(new.select(key), key, "left_anti").unionByName(new)


def with_sidecars(files: DataFrame, main: tuple[str, ...] = (".tif", ".laz"), side: tuple[str, ...] = (".xml", ".tfw")) -> DataFrame:
    """folder, name of main files with the sorted names of their sidecars (same folder and stem)."""
    f = files.select("folder", "name", N.stem(F.col("name")).alias("stem"), N.extension(F.col("name")).alias("ext"))
    m = f.filter(F.col("ext").isin(*main)).select("folder", "stem", "name")
    s = f.filter(F.col("ext").isin(*side)).select("folder", "stem", F.col("name").alias("side"))
    sides = s.groupBy("folder", "stem").agg(F.array_sort(F.collect_set("side")).alias("sidecars"))
    return m.join(sides, ["folder", "stem"], "left").select("folder", "name", F.coalesce("sidecars", F.expr("CAST(array() AS array<string>)")).alias("sidecars"))


def first_of_each(files: DataFrame, key: str, *order: str) -> DataFrame:
    """The first row of each key."""
    rank = F.row_number().over(Window.partitionBy(key).orderBy(*order))
    return files.withColumn("_rank", rank).filter("_rank = 1").drop("_rank")


def first_names(files: DataFrame, key: str, n: int, name: str = "name", parts: int = 64) -> DataFrame:
    """key, total, first: the number of rows and the first ``n`` names in order, for messages that list a few. Names are ranked in
    parts of a key first, so a key with most of the rows isn't sorted in one task."""
    part = F.pmod(F.xxhash64(name), F.lit(parts))
    inside = F.row_number().over(Window.partitionBy(key, "_part").orderBy(name))
    few = files.select(key, name, part.alias("_part")).withColumn("_k", inside).filter(F.col("_k") <= n)
    rank = F.row_number().over(Window.partitionBy(key).orderBy(name))
    lists = few.withColumn("_k", rank).filter(F.col("_k") <= n).groupBy(key).agg(F.array_sort(F.collect_list(name)).alias("first"))
    return files.groupBy(key).agg(F.count("*").alias("total")).join(lists, key, "left")


def mixed_variants(files: DataFrame) -> DataFrame:
    """delivery, has_ascii, has_laz, mixed."""
    ext = N.extension(F.col("name"))
    out = files.groupBy("delivery").agg(F.bool_or(ext.isin(".asc", ".ascii", ".xyz")).alias("has_ascii"), F.bool_or(ext == ".laz").alias("has_laz"))
    return out.withColumn("mixed", F.col("has_ascii") & F.col("has_laz"))


CAMERA_WITH_EXTRA_NAMES = ADS80
