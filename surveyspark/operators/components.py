"""Connected NoData areas of tiles: labelling on runs, sizes, border contact, shape, decision.

Runs (row, c0, c1) stand for pixels, so the work grows with the outline of areas and not with their pixels. Tiles are
independent, large ones are dealt to tasks in strips; all joins have an equi key of tile and row.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from surveyspark.functions import pixels
from surveyspark.sources.shared import saved

# Shares from which a group counts as ragged and perforated.
MIN_HOLE_RATIO, MIN_ROUGHNESS = 0.01, 1.5
#: Runs of a strip, which one task labels, and more than any number of columns.
STRIP_RUNS, WIDTH = 500_000, 1 << 31


def scan_runs(scan: DataFrame, hit) -> DataFrame:
    """Scanlines (tile, row, ..) to runs (tile, row, c0, c1) of the columns where ``hit`` (array of booleans) is true."""
    # as a column: runs look at its values one by one, and what is an expression would be made for each of them
    return scan.select("tile", "row", hit.alias("hit")).select("tile", "row", F.inline(pixels.runs(F.col("hit"))))


def touching(row: np.ndarray, c0: np.ndarray, c1: np.ndarray, reach: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (upper, lower) of indices of runs that touch. Runs are sorted by (row, c0); what a run touches in the row above lies
    side by side."""
    key = row.astype(np.int64) * (1 << 32)
    first = np.searchsorted(key + c1, key - (1 << 32) + c0 - reach, "left")
    size = np.maximum(np.searchsorted(key + c0, key - (1 << 32) + c1 + reach, "right") - first, 0)
    lower = np.repeat(np.arange(len(row)), size)
    return np.arange(len(lower)) - np.repeat(np.cumsum(size) - size, size) + np.repeat(first, size), lower


def roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Least index of each of n nodes' component under the links a, b: in arrays, roots hook onto lesser ones and paths halve."""
    root = np.arange(n)
    while True:
        x, y = root[a], root[b]
        open_ = x != y
        if not open_.any():
            return root
        a, b, x, y = a[open_], b[open_], x[open_], y[open_]
        np.minimum.at(root, np.maximum(x, y), np.minimum(x, y))
        while not np.array_equal(up := root[root], root):
            root = up


def _labels(reach: int):
    """Runs sorted by tile, strip, row and c0, with the label of their component in the strip. The strips of a batch are labelled
    together; its last one may go on in the next batch and waits for it."""

    def labelled(t: pa.Table, new: np.ndarray) -> Iterator[pa.RecordBatch]:
        row, c0, c1 = (t[c].to_numpy().astype(np.int64) for c in ("row", "c0", "c1"))
        # rows numbered on over the strips: those that touch stay side by side, all others get apart
        step = np.where(new[1:] | (np.diff(row) > 1), 2, np.diff(row))
        r = roots(len(row), *touching(np.cumsum(np.r_[0, step]), c0, c1, reach))
        yield from t.append_column("label", pa.array(row[r] * WIDTH + c0[r])).combine_chunks().to_batches()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for b in batches:
            if not b.num_rows:
                continue
            before = held[-1].slice(held[-1].num_rows - 1) if held else b.slice(0, 1)
            t = pa.Table.from_batches([before, b])
            new = np.zeros(b.num_rows, bool)
            for c in ("tile", "strip"):
                new |= pc.not_equal(t[c].slice(1), t[c].slice(0, b.num_rows)).to_numpy()
            if new.any():
                last = int(np.flatnonzero(new)[-1])
                first = np.zeros(sum(h.num_rows for h in held), bool)
                if ready := [*held, *([b.slice(0, last)] if last else [])]:
                    yield from labelled(pa.Table.from_batches(ready), np.r_[first, new[:last]])
                held, b = [], b.slice(last)
            held.append(b)
        if held:
            yield from labelled(pa.Table.from_batches(held), np.zeros(sum(h.num_rows for h in held), bool))

    return run


def label(runs: DataFrame, diagonal: bool = True, strip_runs: int = STRIP_RUNS) -> DataFrame:
    """runs (tile, row, c0, c1) with the first run's (row, c0) of their component as root_row, root_c.

    A tile is cut into strips of whole rows with about ``strip_runs`` runs each. Strips are labelled in tasks of their own; then the
    runs on both sides of each border are compared, and the labels that meet there are united, in a task a tile that sees such
    labels only. The least label is the first run's, as labels are in the order of rows and columns.
    """
    reach = 1 if diagonal else 0
    runs = saved(runs.select("tile", "row", "c0", "c1"), "tile-runs")
    upto = F.sum("count").over(Window.partitionBy("tile").orderBy("row"))
    strips = runs.groupBy("tile", "row").count().withColumn("upto", upto)
    strips = saved(strips.select("tile", "row", F.expr(f"(upto - 1) div {strip_runs}").alias("strip")), "tile-strips")
    kinds = {f.name: f for f in runs.schema.fields}
    code, integer = T.LongType(), T.IntegerType()
    field = lambda name, kind: T.StructField(name, kind)

    dealt = runs.join(strips, ["tile", "row"]).select(*runs.columns, "strip").repartition("tile", "strip").sortWithinPartitions("tile", "strip", "row", "c0")
    labelled = dealt.mapInArrow(_labels(reach), T.StructType([*runs.schema.fields, field("strip", code), field("label", code)]))
    labelled = saved(labelled, "strip-labels")
    final = F.col("label")
    if not strips.filter("strip > 0").isEmpty():
        ends = strips.groupBy("tile", "strip").agg(F.min("row").alias("first"), F.max("row").alias("last"))
        edge = labelled.join(ends, ["tile", "strip"])
        above = edge.filter("row = last").select("tile", (F.col("row") + 1).alias("at"), "row", "c0", "c1", "label")
        below = edge.filter("row = first AND strip > 0").select("tile", F.col("row").alias("at"), "row", "c0", "c1", "label")

        def border(pdf: pd.DataFrame) -> pd.DataFrame:
            pdf = pdf.sort_values(["row", "c0"], ignore_index=True)
            a, b = touching(*(pdf[c].to_numpy() for c in ("row", "c0", "c1")), reach)
            found = pd.DataFrame({"a": pdf.label.to_numpy()[a], "b": pdf.label.to_numpy()[b]}).drop_duplicates()
            return found.assign(tile=pdf.tile.iloc[0])[["tile", "a", "b"]]

        def unite(pdf: pd.DataFrame) -> pd.DataFrame:
            labels, at = np.unique(np.concatenate([pdf.a.to_numpy(), pdf.b.to_numpy()]), return_inverse=True)
            r = roots(len(labels), at[: len(pdf)], at[len(pdf) :])
            return pd.DataFrame({"tile": pdf.tile.iloc[0], "label": labels, "least": labels[r]})

        met = above.unionByName(below).groupBy("tile", "at").applyInPandas(border, T.StructType([kinds["tile"], field("a", code), field("b", code)]))
        united = met.groupBy("tile").applyInPandas(unite, T.StructType([kinds["tile"], field("label", code), field("least", code)]))
        labelled, final = labelled.join(united, ["tile", "label"], "left"), F.coalesce("least", "label")
    return labelled.select(
        "tile", "row", "c0", "c1", F.floor(final / WIDTH).cast(integer).alias("root_row"), F.pmod(final, F.lit(WIDTH)).cast(integer).alias("root_c")
    )


def group_sizes(labelled: DataFrame, tiles: DataFrame) -> DataFrame:
    """Per component: size, border contact and open contact in pixels, and bounding box.

    tiles: tile, height, width, missing (array of directions without a neighbour). A corner pixel counts once; it is open
    if any of its three neighbours is missing.
    """
    t = tiles.select("tile", "height", "width", "missing")
    r = labelled.join(t, "tile")
    top, bottom = F.col("row") == 0, F.col("row") == F.col("height") - 1
    left, right = F.col("c0") == 0, F.col("c1") == F.col("width") - 1
    n = F.col("c1") - F.col("c0") + 1
    single = (F.col("c0") == 0) & (F.col("c1") == 0) & (F.col("width") == 1)
    sides = F.when(single, 1).otherwise(left.cast("int") + right.cast("int"))
    border = F.when(top | bottom, n).otherwise(sides)
    gone = lambda *ds: F.arrays_overlap("missing", F.array(*[F.lit(d) for d in ds]))
    # the run's ends on the tile's edge, and the pixels between them
    west = F.when(top, gone("W", "NW", "N")).when(bottom, gone("W", "SW", "S")).otherwise(gone("W"))
    east = F.when(top, gone("E", "NE", "N")).when(bottom, gone("E", "SE", "S")).otherwise(gone("E"))
    inner = n - left.cast("int") - F.when(single, 0).otherwise(right.cast("int"))
    along = F.when(top & bottom, gone("N", "S")).when(top, gone("N")).when(bottom, gone("S")).otherwise(F.lit(False))
    ends = F.when(single, (west | east).cast("int")).otherwise((left & west).cast("int") + (right & east).cast("int"))
    open_px = ends + F.when(along, inner).otherwise(0)
    return r.groupBy("tile", "root_row", "root_c").agg(
        F.sum(n).alias("size_px"), F.sum(border).alias("border_px"), F.sum(open_px).alias("open_px"), F.count("*").alias("runs"),
        F.min("row").alias("row0"), F.max("row").alias("row1"), F.min("c0").alias("col0"), F.max("c1").alias("col1"),
    )


def shapes(labelled: DataFrame) -> DataFrame:
    """Per component: hole_px and roughness.

    Holes are the gaps between its runs that are closed in by it (4-connected, within its bounding box). Roughness is the
    outline of the filled area by the box's circumference.
    """
    key = ["tile", "root_row", "root_c"]
    group = saved(labelled.withColumn("g", F.concat_ws("/", *[F.col(c).cast("string") for c in key])), "shape-runs")
    box = group.groupBy("g").agg(F.min("row").alias("row0"), F.max("row").alias("row1"), F.min("c0").alias("col0"), F.max("c1").alias("col1"))
    order = Window.partitionBy("g", "row").orderBy("c0")
    nxt = F.lead("c0").over(order)
    runs = group.select("g", "row", "c0", "c1", nxt.alias("next"), F.row_number().over(order).alias("k")).join(box, "g")
    # a run's gaps: before the first one of a row, after the last one, up to the next one; rows are sorted once for all three
    edge = (F.col("row") == F.col("row0")) | (F.col("row") == F.col("row1"))
    gap = lambda when, c0, c1, out: F.when(when, F.struct(c0.alias("c0"), c1.alias("c1"), out.alias("out")))
    c0, c1, following = F.col("c0"), F.col("c1"), F.col("next")
    found = F.array(
        gap((F.col("k") == 1) & (c0 > F.col("col0")), F.col("col0"), c0 - 1, F.lit(True)),
        gap(following.isNull() & (c1 < F.col("col1")), c1 + 1, F.col("col1"), F.lit(True)),
        gap(following > c1 + 1, c1 + 1, following - 1, edge),
    )
    gaps = saved(runs.select("g", "row", F.explode(found).alias("gap")).filter("gap IS NOT NULL").select("g", "row", "gap.*"), "gaps")
    areas = label(gaps.select(F.col("g").alias("tile"), "row", "c0", "c1"), diagonal=False).withColumnRenamed("tile", "g")
    areas = areas.join(gaps, ["g", "row", "c0", "c1"])
    closed = areas.groupBy("g", "root_row", "root_c").agg(F.bool_or("out").alias("out")).filter("NOT out").select("g", "root_row", "root_c")
    holes = areas.join(closed, ["g", "root_row", "root_c"]).select("g", "row", "c0", "c1")
    hole_px = holes.groupBy("g").agg(F.sum(F.col("c1") - F.col("c0") + 1).alias("hole_px"))
    parts = group.select("g", "row", "c0", "c1").unionByName(holes)
    # neighbouring parts of a row become one run of the filled area
    ordered = Window.partitionBy("g", "row").orderBy("c0")
    start = F.coalesce(F.lag("c1").over(ordered) + 1 < F.col("c0"), F.lit(True))
    islands = parts.withColumn("start", start).withColumn("i", F.sum(F.col("start").cast("int")).over(ordered))
    filled = saved(islands.groupBy("g", "row", "i").agg(F.min("c0").alias("c0"), F.max("c1").alias("c1")).drop("i"), "filled")
    area = filled.groupBy("g").agg(F.count("*").alias("n_runs"), F.sum(F.col("c1") - F.col("c0") + 1).alias("area"))
    lower = filled.select("g", (F.col("row") - 1).alias("row"), F.col("c0").alias("d0"), F.col("c1").alias("d1"))
    shared = filled.join(lower, ["g", "row"]).select("g", (F.least("c1", "d1") - F.greatest("c0", "d0") + 1).alias("n")).filter("n > 0")
    shared = shared.groupBy("g").agg(F.sum("n").alias("shared"))
    out = box.join(area, "g").join(shared, "g", "left").join(hole_px, "g", "left")
    contour = 2 * F.col("n_runs") + 2 * F.col("area") - 2 * F.coalesce("shared", F.lit(0))
    girth = 2.0 * ((F.col("row1") - F.col("row0") + 1) + (F.col("col1") - F.col("col0") + 1))
    named = group.select("g", *key).distinct()
    return named.join(out, "g").select(*key, F.coalesce("hole_px", F.lit(0)).alias("hole_px"), (contour / girth).alias("roughness"))


def classify(labelled: DataFrame, tiles: DataFrame, min_size: int, min_contact: int, shape_check: bool = True) -> DataFrame:
    """One row per component with its measures (null where a stage wasn't reached) and decision.

    Real NoData is large (A), touches the tile's border (B) long enough (C) and isn't ragged and perforated (D), unless its
    border pixels lie open to a missing neighbour. Shapes are measured for groups that passed A to C only.
    """
    sized = saved(group_sizes(labelled, tiles), "groups")
    key = ["tile", "root_row", "root_c"]
    passed = sized.filter((F.col("size_px") >= min_size) & (F.col("border_px") > 0) & (F.col("border_px") >= min_contact)).select(key)
    if shape_check:
        measured = shapes(labelled.join(passed, key, "left_semi"))
    else:
        measured = passed.select(*key, F.lit(None).cast("long").alias("hole_px"), F.lit(None).cast("double").alias("roughness"))
    j = sized.join(passed.withColumn("passed", F.lit(True)), key, "left").join(measured, key, "left").join(
        tiles.select("tile", (F.size("missing") > 0).alias("edge_tile")), "tile"
    )
    large, hole = F.col("size_px") >= min_size, F.col("hole_px") / F.col("size_px")
    ragged = (hole >= MIN_HOLE_RATIO) & (F.col("roughness") >= MIN_ROUGHNESS)
    opened = F.when(F.col("edge_tile"), F.col("open_px") > 0).otherwise(False)
    real = F.col("passed") & (~F.coalesce(ragged, F.lit(False)) | opened)
    return j.select(
        *key, "size_px", F.when(large, F.col("border_px") > 0).alias("touches_border"), F.when(large, F.col("border_px")).alias("border_contact_px"),
        hole.alias("hole_ratio"), "roughness", F.when(large & F.col("edge_tile"), F.col("open_px")).alias("open_contact_px"),
        F.when(F.col("roughness").isNotNull(), ragged & opened).alias("edge_override"),
        F.when(F.coalesce(real, F.lit(False)), "real_nodata").otherwise("false_nodata").alias("decision"),
    )


def diagnosis(groups: DataFrame, pixel_size: float, min_size: int) -> DataFrame:
    """Report of groups of stage A and beyond, in metres."""
    return groups.filter(F.col("size_px") >= min_size).select(
        "tile", "root_row", "root_c", F.bround(F.col("size_px") * pixel_size**2, 1).alias("area_m2"),
        F.bround(F.col("border_contact_px") * pixel_size, 1).alias("contact_m"), F.bround("hole_ratio", 4).alias("hole_ratio"),
        F.bround("roughness", 3).alias("roughness"), "decision",
    )
