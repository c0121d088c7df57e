"""Raster headers: cell sizes and the header that documents take, the data-type gate, tags and masks, files of a line."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from surveyspark.functions import geo
from surveyspark.functions import names as N


def cell_size(px: Column, py: Column) -> Column:
    """Mean of both pixel sizes with 10 significant digits, without trailing zeros (for sizes from 0.001 to 1000)."""
    size = (F.abs(px) + F.abs(py)) / 2
    power = F.pow(F.lit(10.0), 9 - F.floor(F.log10(size)))
    text = F.format_string("%.12f", F.rint(size * power) / power)
    return F.when(size > 0, F.regexp_replace(text, r"\.?0+$", ""))


def document_headers(rasters: DataFrame) -> DataFrame:
    """rasters (delivery, gds, ord, name, px, py, block, width, height) with the header values of their documents: SB_DSM files
    have their own, the others of a delivery those of its first file."""
    return with_document_headers(rasters, F.lit(True)).select("delivery", "gds", "ord", "name", "cell_size", "block", "width", "height")


def with_document_headers(files: DataFrame, raster: Column) -> DataFrame:
    """files (as above, with any further columns) with these header values instead of their own, null where ``raster`` is false.
    Files meet the first ones of their deliveries only, never each other."""
    sizes = ("px", "py", "block", "width", "height")
    own = F.struct(cell_size(F.col("px"), F.col("py")).alias("cell_size"), "block", "width", "height")
    kept = [c for c in files.columns if c not in sizes]
    rows = files.select(*kept, F.when(raster, own).alias("own"))
    first = rows.filter("gds <> 'SB_DSM' AND own IS NOT NULL").groupBy("delivery", "gds").agg(F.min(F.struct("ord", "name", "own"))["own"].alias("first"))
    j = rows.join(first, ["delivery", "gds"], "left").select(*kept, F.when(F.col("own").isNotNull(), F.coalesce("first", "own")).alias("h"))
    return j.select(*kept, "h.cell_size", "h.block", "h.width", "h.height")


def dtype_deviations(rasters: DataFrame) -> DataFrame:
    """Surface models (SB_DSM, hillshades aside) whose data type isn't Float32. rasters: gds, name, dtype."""
    tif = N.extension(F.col("name")).isin(".tif", ".tiff")
    return rasters.filter((F.col("gds") == "SB_DSM") & tif & ~N.is_hillshade(F.col("name")) & ~F.col("dtype").eqNullSafe(F.lit("Float32")))


def tags(gds: Column, nodata: Column, bands: Column, has_mask: Column, corrected: Column, rewrite: Column) -> list[Column]:
    """nodata_tag (a value per band, blank-separated; null if the number of values doesn't fit) and mask_action (none, make)."""
    fits = N.nodata_bands(F.coalesce(nodata, F.lit("")), bands)
    make = ~gds.isin("SB_DSM", "SB_DSM_PUNKTWOLKE") & ~corrected & fits.isNotNull() & (rewrite | ~has_mask)
    return [F.array_join(fits, " ").alias("nodata_tag"), F.when(make, "make").otherwise("none").alias("mask_action")]


def files_of_lines(files: DataFrame, lines: DataFrame) -> DataFrame:
    """files (name) of the chosen flight lines (hhmm): their names have the line's time before NRGB."""
    return files.withColumn("hhmm", N.line_token(F.col("name"))).filter("hhmm IS NOT NULL").join(lines.select("hhmm").distinct(), "hhmm", "left_semi")


def package_counts(documents: DataFrame) -> DataFrame:
    """documents (catalog, package, xml_path, unreadable) -> per package: number of documents and the unreadable ones."""
    bad = F.array_sort(F.collect_list(F.when(F.col("unreadable"), F.col("xml_path"))))
    return documents.groupBy("catalog", "package").agg(F.count("*").alias("n_xml"), F.count_if("unreadable").alias("n_unreadable"), F.array_join(bad, ",").alias("unreadable"))


#: Pixels by which an origin may lie off the raster.
OFF = 1e-6


def grid_problems(rasters: DataFrame, cell: float = 1000.0) -> DataFrame:
    """rasters (delivery, name, gt, nx, ny, bands, dtype) -> delivery, name, on_grid (already a cell, by name and extent), problems
    of the others against their delivery's first raster by name."""
    gt, named = F.col("gt"), F.col("name").rlike(r"_\d{4}_\d{4}_LV95\.tif$")
    first = rasters.groupBy("delivery").agg(F.min_by(F.struct("gt", "bands", "dtype"), "name").alias("first"))
    j = rasters.join(first, "delivery").withColumns(
        {"gsd": F.col("first.gt")[1], "minx": gt[0], "maxy": gt[3], "maxx": gt[0] + F.col("nx") * gt[1], "miny": gt[3] + F.col("ny") * gt[5]}
    )
    whole = lambda v, tol: F.abs(v - F.round(v)) <= tol
    span = lambda a, b: F.abs(F.col(b) - F.col(a) - cell) < OFF
    on_grid = named & span("minx", "maxx") & span("miny", "maxy") & whole(F.col("minx") / cell, 1e-9) & whole(F.col("miny") / cell, 1e-9)
    gsd = F.col("gsd")
    checks = [
        ((gt[2] != 0) | (gt[4] != 0), "rotated"),
        ((F.abs(gt[1] - gsd) > 1e-9) | (F.abs(gt[5] + gsd) > 1e-9), "pixel size"),
        ((F.col("bands") != F.col("first.bands")) | (F.col("dtype") != F.col("first.dtype")), "bands"),
        (~((F.col("minx") >= geo.LV95_E[0]) & (F.col("maxx") <= geo.LV95_E[1]) & (F.col("miny") >= geo.POINT_N[0]) & (F.col("maxy") <= geo.POINT_N[1])), "not LV95"),
        (~whole(gt[0] / gsd, OFF), "x off raster"),
        (~whole(gt[3] / gsd, OFF), "y off raster"),
        (~whole(cell / gsd, OFF), "cell size"),
    ]
    found = F.filter(F.array(*[F.when(c, m) for c, m in checks]), lambda x: x.isNotNull())
    return j.select("delivery", "name", on_grid.alias("on_grid"), found.alias("problems"))
