"""Whole deliveries: the operators composed per product. Each returns lazy tables; gates are columns, not exceptions."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from surveyspark import rules
from surveyspark.functions import geo, xmlout
from surveyspark.functions import names as N
from surveyspark.operators import catalog, components, headers, manifest, points, raster
from surveyspark.operators import deliveries as D
from surveyspark.sources.shared import saved


def raster_delivery(
    files: DataFrame, meta: DataFrame, kept: DataFrame, products: DataFrame, corrected: bool = False, rewrite: bool = False, images: Images | None = None
) -> dict[str, DataFrame]:
    """SB_DOP, SB_DOP_16 and SB_DSM together: clean-up -> coordinate-system gate -> documents, tags, pixels -> manifest.

    files (delivery, ord, gds, name, md5, footprint, nodata, info, px, py, block, width, height, bands, has_mask), ord once in a
    delivery; meta (delivery, camera, line_ids, times, first, stac, band_id, year, order_type). Files of a stopped delivery get no
    document or row.
    """
    return _gated(manifest.cleanup(files, kept).filter("keep").drop("keep"), meta, products, corrected, rewrite, images)


def line_delivery(
    files: DataFrame, meta: DataFrame, products: DataFrame, lines: DataFrame, existing: DataFrame, images: Images | None = None
) -> dict[str, DataFrame]:
    """SB_DOP_16, one flight line: sort files into line folders, take those of the chosen lines (delivery, line), all their
    extensions, then gate, documents, tags and manifest. moved: each file with its line and what became of it."""
    moved = manifest.reorganise(files, existing)
    chosen = moved.join(lines.select("delivery", "line").distinct(), ["delivery", "line"], "left_semi").drop("line", "status")
    return _gated(chosen, meta, products, images=images) | {"moved": moved}


def surface_delivery(files: DataFrame, meta: DataFrame, kept: DataFrame, products: DataFrame, scan: DataFrame | None = None) -> dict[str, DataFrame]:
    """SB_DSM: a raster (hillshades aside) that isn't Float32 blocks its delivery; then as ``raster_delivery``. files: with dtype.

    scan: scanlines (delivery, name, row, band); those of the files that pass come back as ``pixels``, hillshades rescaled and heights
    repaired.
    """
    surface = files.filter("gds = 'SB_DSM'")
    deviations = headers.dtype_deviations(surface)
    passed = surface.join(deviations.select("delivery").distinct(), "delivery", "left_anti")
    out = raster_delivery(passed, meta, kept, products) | {"deviations": deviations}
    if scan is not None:
        lines = scan.join(out["going"].select("delivery", "name"), ["delivery", "name"], "left_semi")
        lines = lines.withColumn("tile", F.concat_ws("|", "delivery", "name"))
        out["pixels"] = raster.surface_values(lines, N.is_hillshade(F.col("name"))).drop("tile")
    return out


@dataclass
class Images:
    """Pixels of a delivery's rasters: scan (delivery, name, row, bands), tiles (delivery, name, x0, y0: places in pixels), the grid's
    cells in pixels and the NoData value of each band.

    repair: the least size and border contact of real NoData, in pixels; then false NoData is corrected before the cells are masked
    (three bands with one value).
    """

    scan: DataFrame
    tiles: DataFrame
    size: int
    nodata: list[int]
    repair: tuple[int, int] | None = None

    def of(self, going: DataFrame) -> DataFrame:
        """delivery, cx, cy, row, bands, mask of the files that pass: retiled, empty cells left out, masked pixels 0."""
        key = ["delivery", "name"]
        lines = self.scan.join(going.select(*key), key, "left_semi").select("delivery", F.col("name").alias("tile"), "row", "bands")
        tiles = self.tiles.select("delivery", F.col("name").alias("tile"), "x0", "y0")
        if self.repair:
            lines = self.repaired(lines, tiles)
        return raster.cut_and_masked(lines, tiles, self.size, self.nodata, ("delivery",))

    def repaired(self, lines: DataFrame, tiles: DataFrame) -> DataFrame:
        """Tiles before they are cut, as false NoData is told from real one by whole tiles and their neighbours."""
        at = lines.select("delivery", "tile", F.size(F.col("bands")[0]).alias("width"), "row").groupBy("delivery", "tile").agg(F.max("width").alias("width"), (F.max("row") + 1).alias("height"))
        unit = F.concat_ws("|", "delivery", "tile").alias("tile")
        grid = tiles.join(at, ["delivery", "tile"]).select(unit, F.floor(F.col("x0") / F.col("width")).cast("int").alias("e"), (-F.floor(F.col("y0") / F.col("height"))).cast("int").alias("n"), "height", "width")
        three = [F.col("bands")[k].alias(c) for k, c in enumerate("rgb")]
        out = nodata_delivery(lines.select(unit, "row", *three), grid, self.nodata[0], *self.repair)["pixels"]
        # what was corrected is masked; its zeros are made NoData again, so that cutting treats them as background
        back = [F.zip_with(c, "mask", lambda v, m: F.when(m, v).otherwise(F.lit(self.nodata[0]))) for c in "rgb"]
        return out.select(F.substring_index("tile", "|", 1).alias("delivery"), F.expr("substring(tile, instr(tile, '|') + 1)").alias("tile"), "row", F.array(*back).alias("bands"))


def _gated(
    files: DataFrame, meta: DataFrame, products: DataFrame, corrected: bool = False, rewrite: bool = False, images: Images | None = None
) -> dict[str, DataFrame]:
    actions = catalog.crs_actions(files.select("gds", F.concat_ws("|", "delivery", "name").alias("name"), "info"))
    by = actions.withColumn("delivery", F.substring_index("name", "|", 1))
    gates = catalog.crs_summary(by, "delivery")
    going = files.join(gates.filter("stop").select("delivery"), "delivery", "left_anti")
    rows = manifest.csv_rows(going.select(F.concat_ws("|", "delivery", "ord").alias("ord"), "gds", "name", "md5", "footprint"))
    rasters = going.filter(N.extension(F.col("name")).isin(".tif", ".tiff"))
    tags = headers.tags(F.col("gds"), F.col("nodata"), F.col("bands"), F.col("has_mask"), F.lit(corrected), F.lit(rewrite))
    out = {"gates": gates, "documents": with_documents(going, meta, products), "tags": rasters.select("delivery", "ord", *tags), "rows": rows, "going": going}
    return out | ({"pixels": images.of(going)} if images else {})


def with_documents(files: DataFrame, meta: DataFrame, products: DataFrame) -> DataFrame:
    """delivery, ord, name, xml of main files (rasters and LAZ), with the rasters' headers and the product's text."""
    main = files.filter(N.extension(F.col("name")).isin(".tif", ".tiff", ".laz"))
    j = headers.with_document_headers(main, N.extension(F.col("name")) != ".laz").join(meta, "delivery")
    j = D.with_product_texts(j, products)
    col, none = F.col, F.lit(None).cast("string")
    values = {
        "order_type": col("order_type"), "area": N.area(col("name"), col("gds")), "terrain_model": F.lit(rules.TERRAIN_MODEL), "camera": col("camera"),
        "crs": none, "source_crs": F.lit(rules.SOURCE_REF_SYS), "commentary": none, "custom_attribute": col("custom_attribute"),
        "nodata": N.nodata_output(col("gds"), N.nodata_source(col("name"), col("gds"), col("nodata"))), "line_ids": col("line_ids"),
        "times": col("acquisition_times"), "first": col("first_acquisition"), "stac": col("stac_time"), "band_id": col("band_id"),
        "cell_size": col("cell_size"), "block_size": col("block").cast("string"), "width": col("width").cast("string"),
        "height": col("height").cast("string"), "year": col("year"),
    }
    return j.select("delivery", "ord", "name", xmlout.tile_document(col("gds"), col("name"), values).alias("xml"))


def preview(files: DataFrame, meta: DataFrame, products: DataFrame) -> DataFrame:
    """delivery, name, xml: the document of each delivery's first main file by name, built of this one file only."""
    main = files.filter(N.extension(F.col("name")).isin(".tif", ".tiff", ".laz"))
    first = main.groupBy("delivery").agg(F.min(F.struct("name", "ord"))["ord"].alias("ord"))
    return D.preview(with_documents(main.join(first, ["delivery", "ord"], "left_semi"), meta, products))


def nodata_delivery(scan: DataFrame, tiles: DataFrame, nodata: int, min_size: int, min_contact: int) -> dict[str, DataFrame]:
    """Correction of false NoData of a tile set: empty tiles go first, as they are no neighbours; then labels, groups, pixels.

    scan: tile, row, r, g, b. tiles: tile, e, n, height, width.
    """
    from surveyspark.operators.tiles import missing_neighbours

    blank = lambda c: F.transform(c, lambda v: v == nodata)
    hit = F.zip_with(F.zip_with(blank("r"), blank("g"), lambda a, b: a & b), blank("b"), lambda a, b: a & b)
    # tables of a row a tile, which all steps take, are made once of all scanlines
    empty = saved(raster.empty_tiles(scan, hit), "empty-tiles")
    full = empty.filter("NOT empty").select("tile")
    kept, grid = scan.join(full, "tile", "left_semi"), tiles.join(full, "tile", "left_semi")
    grid = saved(grid, "tile-grid")
    grid = saved(grid.join(missing_neighbours(grid.select("tile", "e", "n")), "tile"), "tile-neighbours")
    labelled = raster.labelled_nodata(kept, hit)
    groups = components.classify(labelled, grid, min_size, min_contact)
    fixed = raster.correct(kept, labelled, groups, nodata)
    summary = fixed.groupBy("tile").agg(F.sum("false_px").alias("false_px"), F.sum("shadow_px").alias("shadow_px"))
    return {"empty": empty, "grid": grid, "groups": groups, "pixels": fixed, "summary": summary}


def correction_summary(delivery: dict[str, DataFrame]) -> DataFrame:
    """One row on a ``nodata_delivery``: files, their corrected and lifted pixels, empty tiles left out, tiles at the edge."""
    pixels = delivery["summary"].agg(F.count("*").alias("files"), F.sum("false_px").alias("false_px"), F.sum("shadow_px").alias("shadow_px"))
    tiles = delivery["empty"].agg(F.count_if("empty").alias("empty_tiles"))
    edge = delivery["grid"].agg(F.count_if(F.size("missing") > 0).alias("edge_tiles"))
    rows = pixels.unionByName(tiles, allowMissingColumns=True).unionByName(edge, allowMissingColumns=True)
    return rows.agg(*[F.max(c).alias(c) for c in rows.columns])


def point_delivery(pts: DataFrame, cells: DataFrame, size: int, scale: float = 0.01) -> dict[str, DataFrame]:
    """Points (file, x, y, z, cls) onto the grid: cells, balance, requantised heights, headers and their frames."""
    tiled = points.to_cells(pts, cells, size)
    inside = tiled.filter("name IS NOT NULL").withColumn("zq", geo.requantised(F.col("z").cast("double"), F.lit(0.0), scale))
    return {"tiles": inside, "balance": points.balance(tiled), "headers": points.tile_headers(tiled), "ranges": points.ranges(inside, "name")}


def point_conversion(
    files: DataFrame, meta: DataFrame, products: DataFrame, source: DataFrame, target: DataFrame, source_ranges: DataFrame, target_ranges: DataFrame, tolerance: float = 0.01
) -> dict[str, DataFrame]:
    """SB_DSM_PUNKTWOLKE after conversion: gates of the sources -> validation of the converted files -> documents and two manifest
    rows of each file that passes.

    files (delivery, ord, gds, name, md5, nodata); source (name, points, horizontal, vertical, wkt, rgb, keep_rgb); target: headers as
    ``header_checks``, ``vlr_checks`` and ``box_deviations`` take them; ranges by name. report: name, refused (why the source may not
    be converted), problems, status (ok, failed).
    """
    colour = geo.point_format_problem(F.col("rgb"), F.col("keep_rgb"))
    gates = source.select("name", F.coalesce(geo.point_crs_problem(F.col("horizontal"), F.col("vertical"), F.col("wkt")), colour).alias("refused"))
    listed = lambda df, kind, column: df.select("name", F.explode(F.transform(column, lambda x: F.concat(F.lit(f"{kind}: "), x))).alias("problem"))
    moved = points.compare_ranges(source_ranges, target_ranges, "name", tolerance).filter("problem IS NOT NULL")
    found = (
        listed(points.header_checks(source, target.drop("vlrs", "wkt")), "header", "problems")
        .unionByName(listed(points.vlr_checks(target), "record", "problems"))
        .unionByName(listed(points.box_deviations(target, target_ranges, "name", tolerance), "box", "deviations"))
        .unionByName(moved.select("name", F.concat(F.lit("range: "), F.col("dim"), F.lit(" "), F.col("problem")).alias("problem")))
    )
    by_file = found.groupBy("name").agg(F.array_sort(F.collect_set("problem")).alias("problems"))
    status = F.when(F.col("refused").isNotNull() | F.col("problems").isNotNull(), "failed").otherwise("ok")
    report = gates.join(by_file, "name", "left").withColumn("status", status)
    passed = files.join(report.filter("status = 'ok'").select("name"), "name", "left_semi")
    flat = passed.withColumns({c: F.lit(None).cast(t) for c, t in (("px", "double"), ("py", "double"), ("block", "int"), ("width", "int"), ("height", "int"))})
    rows = manifest.csv_rows(passed.select(F.concat_ws("|", "delivery", "ord").alias("ord"), "gds", "name", "md5", F.lit("").alias("footprint")))
    return {"report": report, "documents": with_documents(flat, meta, products), "rows": rows}


def text_reading(lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """lines (file, line_no, value) -> what each text is, written as all its lines meet it, and the points as read."""
    sniffed = saved(points.sniff(lines), "text-sniffs")
    return sniffed, points.xyz_points(lines, sniffed)


def text_sources(sniffed: DataFrame, read: DataFrame) -> DataFrame:
    """What each text is and its points and lines that are left out."""
    ignored = read.groupBy("file").agg(F.count_if("ignored").alias("ignored"), F.count_if(~F.col("ignored")).alias("points"))
    return sniffed.join(ignored, "file", "left")


def text_conversion(
    lines: DataFrame, cells: DataFrame, meta: DataFrame, products: DataFrame, delivery: str, year: int, area: str, size: int = 1000, scale: float = 0.01, sums: DataFrame | None = None
) -> dict[str, DataFrame]:
    """SB_DSM_PUNKTWOLKE from text to manifest in one chain: sniff -> points -> cells -> requantised tiles -> frame gate and validation
    against the points as read -> documents and two manifest rows of each tile that passes.

    lines (file, line_no, value) in metres; cells (ix, iy, name: its key); sums (name, md5) of the written tiles, if there are any yet.
    sources: what each text is and its lines that are left out; tiles: requantised points by the tile's file name; balance: points in
    cells and outside; report: name, points, problems, status.
    """
    dims, quantised = ("x", "y", "z"), ("qx", "qy", "qz")
    sniffed, read = text_reading(lines)
    # texts are read once: the tables below are made of the points written here, with the few cells that hold any
    read = saved(read.select("file", *dims, "ignored"), "text-points")
    pts = read.filter("NOT ignored").drop("ignored")
    grid = points.cells_in_use(pts, cells, size).withColumn("name", F.when(F.col("name").isNotNull(), N.point_tile_name(F.lit(year), F.lit(area), F.col("name"))))
    tiled = points.to_cells(pts, saved(grid, "text-cells"), size)
    named = tiled.filter("name IS NOT NULL")
    moved = {c: geo.requantised(F.col(c), F.lit(0.0), scale) for c in dims}
    tiles = named.withColumns(moved)
    both = named.select("name", *dims, *[moved[c].alias(q) for c, q in zip(dims, quantised, strict=True)])
    spans = saved(both.groupBy("name").agg(F.count("*").alias("points"), *points.ends((*dims, *quantised))), "text-tiles")
    as_tiles = spans.select("name", "points", *[F.col(f"{end}_{q}").alias(f"{end}_{c}") for c, q in zip(dims, quantised, strict=True) for end in ("low", "high")])
    kept = points.compare_ranges(points.range_rows(spans, "name", dims), points.range_rows(as_tiles, "name", dims), "name", scale, ()).filter("problem IS NOT NULL")
    heads = as_tiles.select("name", "points", *[F.col(f"{end}_{c}").alias(f"{n}{c}") for c in dims for n, end in (("min", "low"), ("max", "high"))])
    heads = heads.withColumn("at", N.las_origin(F.col("name")))
    off = geo.frame_violation(*[F.col(c) for c in ("minx", "maxx", "miny", "maxy", "at.e_km", "at.n_km")])
    heights = ~geo.z_plausible(F.col("minz"), F.col("maxz"))
    frame = heads.select("name", F.explode(F.filter(F.array(F.col("at.problem"), F.when(off, "outside its cell")), lambda x: x.isNotNull())).alias("problem"))
    found = frame.unionByName(kept.select("name", F.concat(F.lit("range: "), F.col("dim"), F.lit(" "), F.col("problem")).alias("problem")))
    by_tile = found.groupBy("name").agg(F.array_sort(F.collect_set("problem")).alias("problems"))
    status = F.when(F.col("problems").isNotNull(), "failed").otherwise("ok")
    report = heads.select("name", "points", heights.alias("heights_unlikely")).join(by_tile, "name", "left").withColumn("status", status)
    report = saved(report, "text-report")
    none = {c: F.lit(None).cast(t) for c, t in (("px", "double"), ("py", "double"), ("block", "int"), ("width", "int"), ("height", "int"))}
    files = report.filter("status = 'ok'").select(F.lit(delivery).alias("delivery"), F.col("name").alias("ord"), F.lit("SB_DSM_PUNKTWOLKE").alias("gds"), "name", F.lit("").alias("nodata")).withColumns(none)
    files = files.join(sums.select("name", "md5"), "name", "left") if sums is not None else files.withColumn("md5", F.lit(None).cast("string"))
    rows = manifest.csv_rows(files.select("ord", "gds", "name", "md5", F.lit("").alias("footprint")))
    return {
        "sources": text_sources(sniffed, read), "tiles": tiles, "balance": points.balance(tiled), "report": report,
        "documents": with_documents(files, meta, products), "rows": rows,
    }


def preflight(deliveries: DataFrame, products: DataFrame, items: DataFrame, packages: DataFrame) -> DataFrame:
    """One row per delivery: ok, warn (the catalog or the queue has it already) or blocked (invalid)."""
    valid = D.validate(deliveries, products).select("delivery", "errors", "is_dmc", "gds", "item", "catalog", "package")
    assets = catalog.asset_conflicts(valid.select("delivery", "item", "gds", "is_dmc"), items, products).select("delivery", F.col("status").alias("asset"))
    queue = catalog.queue_conflicts(valid.select("delivery", "item", "catalog", "package"), packages).select("delivery", F.col("status").alias("queue"))
    j = valid.join(assets, "delivery", "left").join(queue, "delivery", "left")
    gate = F.when(F.size("errors") > 0, "blocked").when((F.col("asset") != "new") & (F.col("asset") != "free") | (F.col("queue") == "conflict"), "warn").otherwise("ok")
    return j.select("delivery", F.size("errors").alias("n_errors"), "asset", "queue", gate.alias("gate"))
