"""Raster operators on scanlines (tile, row, bands): empty tiles, correction of false NoData, retiling, previews."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from surveyspark.functions import pixels

from . import components as C


def empty_tiles(scan: DataFrame, blank: Column) -> DataFrame:
    """tile, empty: whether ``blank`` (array of booleans) holds for every pixel."""
    return scan.groupBy("tile").agg(F.bool_and(F.forall(blank, lambda x: x)).alias("empty"))


def rescale_hillshade(scan: DataFrame, band: str = "band", safe_max: int = 225) -> DataFrame:
    """Scanlines rescaled in tiles that still have values above safe_max (255 aside); others stay."""
    peak = F.coalesce(F.array_max(F.filter(band, lambda v: v != 255)), F.lit(0))
    todo = scan.groupBy("tile").agg((F.max(peak) > safe_max).alias("todo"))
    return scan.join(todo, "tile").withColumn(band, F.when(F.col("todo"), pixels.rescaled(F.col(band), safe_max)).otherwise(F.col(band))).drop("todo")


def correct(scan: DataFrame, labelled: DataFrame, groups: DataFrame, nodata: int) -> DataFrame:
    """scan (tile, row, r, g, b, ..) with corrected bands, mask (real NoData is false) and the counts of changed pixels. Further
    columns (bands beyond the third) stay as they are.

    255: pixels of false groups become 254, then near-black pixels are lifted, then real NoData becomes 0.
    0: near-black pixels are lifted, except real NoData.
    """
    key = ["tile", "root_row", "root_c"]
    kinds = labelled.join(groups.select(*key, "decision"), key)
    span = F.struct("c0", "c1")
    rows = kinds.groupBy("tile", "row").agg(
        F.collect_list(F.when(F.col("decision") == "false_nodata", span)).alias("false_runs"),
        F.collect_list(F.when(F.col("decision") == "real_nodata", span)).alias("real_runs"),
    )
    width = F.size("r")
    out = scan.join(rows, ["tile", "row"], "left")
    out = out.withColumns({"wrong": pixels.mask_of(F.col("false_runs"), width), "real": pixels.mask_of(F.col("real_runs"), width)})
    lifts = pixels.shadow_lifts(F.col("r"), F.col("g"), F.col("b"))
    if nodata == 255:
        shift = F.zip_with("wrong", "_lift", lambda w, s: F.when(w, -1).otherwise(s))
    else:
        shift = F.zip_with("real", "_lift", lambda r, s: F.when(r, 0).otherwise(s))
    out = out.withColumn("_lift", lifts).withColumn("_shift", shift)
    mask = F.transform("real", lambda x: ~x)
    changed = {c: pixels.shifted(F.col(c), F.col("_shift")) for c in ("r", "g", "b")}
    out = out.withColumns({"mask": mask, **changed})
    out = out.withColumns({c: pixels.zeroed(F.col(c), F.col("mask")) for c in ("r", "g", "b")})
    count = lambda c: F.size(F.filter(c, lambda x: x != 0))
    more = [c for c in scan.columns if c not in ("tile", "row", "r", "g", "b")]
    return out.select(
        "tile", "row", "r", "g", "b", *more, "mask", F.size(F.filter("wrong", lambda x: x)).alias("false_px"), count("_lift").alias("shadow_px")
    )


def stacked(bands: Column) -> Column:
    """Bands (an array of arrays of one width) as an array of pixels, each with its values of all bands."""
    return F.transform(F.sequence(F.lit(0), F.size(bands[0]) - 1), lambda i: F.transform(bands, lambda b: F.get(b, i)))


def unstacked(pixels_of: Column, n: int) -> Column:
    """The reverse, for n bands."""
    band = lambda k: F.transform(pixels_of, lambda p: F.get(p, F.lit(k)))
    return F.array(*map(band, range(n)))


def retile(scan: DataFrame, tiles: DataFrame, size: int, fill: int | Column, by: tuple[str, ...] = ()) -> DataFrame:
    """Scanlines (tile, row, band) of tiles at (x0, y0) in pixels, y growing downwards, cut to cells of ``size`` pixels.

    Returns cx, cy, row, band: background is ``fill``; rows without any tile are absent until ``with_background``. Where tiles
    overlap, the later one (by name) shows. Values may be numbers or whole pixels (``stacked``). by: columns of both tables whose
    values have grids of their own.
    """
    background = fill if isinstance(fill, Column) else F.lit(fill)
    placed = scan.join(tiles.select(*by, "tile", "x0", "y0"), [*by, "tile"]).withColumn("y", F.col("row") + F.col("y0"))
    last = F.col("x0") + F.size("band") - 1
    cells = placed.withColumn("cx", F.explode(F.sequence(F.floor(F.col("x0") / size), F.floor(last / size)))).withColumns(
        {"cy": F.floor(F.col("y") / size), "at": F.greatest(F.col("x0"), F.col("cx") * size)}
    )
    width = F.least(last + 1, (F.col("cx") + 1) * size) - F.col("at")
    piece = F.slice("band", (F.col("at") - F.col("x0") + 1).cast("int"), width.cast("int"))
    parts = cells.select(*by, "cx", "cy", (F.col("y") - F.col("cy") * size).cast("int").alias("row"), (F.col("at") - F.col("cx") * size).cast("int").alias("c"), "tile", piece.alias("p"))
    lists = parts.groupBy(*by, "cx", "cy", "row").agg(F.array_sort(F.collect_list(F.struct("tile", "c", "p"))).alias("ps"))
    drawn = F.aggregate(
        "ps", F.array_repeat(background, size),
        lambda line, x: F.concat(F.slice(line, F.lit(1), x["c"]), x["p"], F.slice(line, x["c"] + F.size(x["p"]) + 1, F.lit(size))),
    )
    return lists.select(*by, "cx", "cy", "row", drawn.alias("band"))


def with_background(cut: DataFrame, size: int, fill: int | Column, by: tuple[str, ...] = ()) -> DataFrame:
    """All rows of the cells that have any pixel besides ``fill``."""
    background, cell = fill if isinstance(fill, Column) else F.lit(fill), [*by, "cx", "cy"]
    cells = cut.groupBy(*cell).agg(F.bool_or(F.exists("band", lambda v: v != background)).alias("some")).filter("some").select(*cell)
    rows = cells.withColumn("row", F.explode(F.sequence(F.lit(0), F.lit(size - 1))))
    return rows.join(cut, [*cell, "row"], "left").select(*cell, "row", F.coalesce("band", F.array_repeat(background, size)).alias("band"))


def cut_and_masked(scan: DataFrame, tiles: DataFrame, size: int, nodata: list[int], by: tuple[str, ...] = ()) -> DataFrame:
    """Scanlines (tile, row, bands) of any number of bands, onto the grid: cx, cy, row, bands, mask.

    Cells whose pixels are NoData in all bands are left out. Pixels that have the NoData values of all bands, background too, are
    false in the mask and 0 in the bands.
    """
    fill = F.array(*map(F.lit, nodata))
    cut = with_background(retile(scan.select(*by, "tile", "row", stacked(F.col("bands")).alias("band")), tiles, size, fill, by), size, fill, by)
    found = cut.withColumn("bands", unstacked(F.col("band"), len(nodata))).withColumn("mask", pixels.nodata_mask(F.col("bands"), fill))
    zeroed = F.transform("bands", lambda b: pixels.zeroed(b, F.col("mask")))
    return found.select(*by, "cx", "cy", "row", zeroed.alias("bands"), "mask")


def surface_values(scan: DataFrame, shade: Column, safe_max: int = 225) -> DataFrame:
    """Scanlines (tile, row, band of floats) of surface models: hillshades (where ``shade``) are rescaled, in tiles that need it; in
    height models -9999 becomes the least float."""
    marked = scan.withColumn("_shade", shade)
    heights = marked.filter("NOT _shade").withColumn("band", pixels.fixed_dsm(F.col("band").cast("array<float>")))
    shades = marked.filter("_shade").withColumn("band", F.col("band").cast("array<int>"))
    shades = rescale_hillshade(shades, "band", safe_max).withColumn("band", F.col("band").cast("array<float>"))
    return heights.unionByName(shades).drop("_shade")


def _sums(line: Column, n: Column, start) -> Column:
    """Sums of the n stretches of a line that begin at ``start(c)`` and end before ``start(c + 1)``."""
    part = lambda c: F.slice(line, (start(c) + 1).cast("int"), (start(c + 1) - start(c)).cast("int"))
    return F.transform(F.sequence(F.lit(0), n - 1), lambda c: F.aggregate(part(c), F.lit(0.0), lambda x, v: x + v))


def _added(lists: Column) -> Column:
    """Arrays of one length added up place by place."""
    return F.aggregate(F.slice(lists, 2, F.size(lists)), lists[0], lambda x, y: F.zip_with(x, y, lambda p, q: p + q))


def pyramid(scan: DataFrame, levels: int, band: str = "band") -> DataFrame:
    """tile, level, r, values: scanlines of averages at half the size for each level from 1 on, each made of the level before.

    Lines carry sums and numbers of pixels, so averages are exact where sizes are odd. A line of pixels stays one row.
    """
    line = F.transform(F.col(band), lambda v: v.cast("double"))
    now = scan.select("tile", F.col("row").alias("r"), line.alias("sums"), F.transform(line, lambda _: F.lit(1.0)).alias("counts"))
    out = []
    for level in range(1, levels + 1):
        half = lambda c: _sums(F.col(c), F.ceil(F.size(c) / 2).cast("int"), lambda k: 2 * k)
        pairs = now.select("tile", F.floor(F.col("r") / 2).cast("int").alias("r"), half("sums").alias("sums"), half("counts").alias("counts"))
        now = pairs.groupBy("tile", "r").agg(_added(F.collect_list("sums")).alias("sums"), _added(F.collect_list("counts")).alias("counts"))
        out.append(now.select("tile", F.lit(level).alias("level"), "r", F.zip_with("sums", "counts", lambda x, n: x / n).alias("values")))
    all_levels = out[0]
    for more in out[1:]:
        all_levels = all_levels.unionByName(more)
    return all_levels


def preview(scan: DataFrame, factor: int, band: str = "band") -> DataFrame:
    """tile, r, c, value: block averages. Lines are summed up before they meet, ``factor`` of them in a group."""
    n = F.ceil(F.size(band) / factor).cast("int")
    sums = scan.select("tile", F.floor(F.col("row") / factor).cast("int").alias("r"), _sums(F.col(band), n, lambda c: c * factor).alias("s"), F.size(band).alias("w"))
    blocks = sums.groupBy("tile", "r").agg(_added(F.collect_list("s")).alias("s"), F.count("*").alias("n"), F.max("w").alias("w"))
    values = blocks.select("tile", "r", "n", "w", F.posexplode("s").alias("c", "s"))
    return values.select("tile", "r", "c", (F.col("s") / (F.col("n") * (F.least("w", (F.col("c") + 1) * factor) - F.col("c") * factor))).alias("value"))


def overview(scan: DataFrame, size: DataFrame, max_dim: int) -> DataFrame:
    """Previews of at most ``max_dim`` pixels a side. scan: tile, row, bands (arrays, the first three show; a single one is grey);
    size: tile, width, height, byte (8-bit values). Block averages; values of more bits are stretched between the 2nd and 98th
    percentile of all bands of the tile (from counts of its values, merged over tasks). Returns tile, r, c, rgb."""
    scale = F.least(F.lit(1.0), max_dim / F.greatest("width", "height"))
    out = lambda c: F.greatest(F.lit(1), F.bround(F.col(c) * scale).cast("int"))
    s = size.select("tile", "byte", "width", "height", out("width").alias("ow"), out("height").alias("oh"))
    rows = scan.select("tile", "row", F.posexplode(F.slice("bands", 1, 3)).alias("band", "line")).join(s, "tile")
    begin = lambda c: F.floor((c * F.col("width") + F.col("ow") - 1) / F.col("ow"))
    lines = rows.select("tile", "byte", "band", F.floor(F.col("row") * F.col("oh") / F.col("height")).cast("int").alias("r"), "width", "ow", _sums(F.col("line"), F.col("ow"), begin).alias("s"))
    blocks = lines.groupBy("tile", "byte", "band", "r", "width", "ow").agg(_added(F.collect_list("s")).alias("s"), F.count("*").alias("n"))
    mean = blocks.select("tile", "byte", "band", "r", "n", "width", "ow", F.posexplode("s").alias("c", "s"))
    mean = mean.select("tile", "byte", "band", "r", "c", (F.col("s") / (F.col("n") * (begin(F.col("c") + 1) - begin(F.col("c"))))).alias("v"))
    ends = mean.filter("NOT byte").groupBy("tile").agg(F.percentile("v", F.array(F.lit(0.02), F.lit(0.98))).alias("p"))
    low, high = F.col("p")[0], F.col("p")[1]
    grey = F.when(F.col("byte"), F.col("v")).otherwise((F.col("v") - low) * (255.0 / F.when(high > low, high - low).otherwise(1.0)))
    shown = mean.join(ends, "tile", "left").select("tile", "r", "c", "band", F.floor(F.greatest(F.lit(0.0), F.least(F.lit(255.0), grey))).cast("int").alias("g"))
    bands = shown.groupBy("tile", "r", "c").agg(F.transform(F.array_sort(F.collect_list(F.struct("band", "g"))), lambda x: x["g"]).alias("g"))
    return bands.select("tile", "r", "c", F.when(F.size("g") == 1, F.array_repeat(F.col("g")[0], 3)).otherwise(F.col("g")).alias("rgb"))


def stretch(cells: DataFrame) -> DataFrame:
    """Preview values between the tile's 2nd and 98th percentile onto 0 to 255."""
    p = cells.groupBy("tile").agg(F.percentile("value", F.array(F.lit(0.02), F.lit(0.98))).alias("p"))
    j = cells.join(p, "tile")
    low, high = F.col("p")[0], F.col("p")[1]
    grey = F.when(high > low, (F.col("value") - low) / (high - low) * 255).otherwise(0.0)
    return j.select("tile", "r", "c", F.floor(F.greatest(F.lit(0.0), F.least(F.lit(255.0), grey))).cast("int").alias("grey"))


def labelled_nodata(scan: DataFrame, hit: Column, diagonal: bool = True) -> DataFrame:
    return C.label(C.scan_runs(scan, hit), diagonal)
