"""Tiles and grid cells: neighbours, overlaps, alignment, cell checks. Range joins get an equi key from covered cells."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from surveyspark.sources.shared import saved

# The eight directions, clockwise from north.
DIRECTIONS = (("N", 0, 1), ("NE", 1, 1), ("E", 1, 0), ("SE", 1, -1), ("S", 0, -1), ("SW", -1, -1), ("W", -1, 0), ("NW", -1, 1))


def key_step(tiles: DataFrame, axis: str) -> DataFrame:
    """One row: the least distance of two different keys on an axis, 1 if there is none."""
    keys = tiles.filter(F.col(axis).isNotNull()).select(axis).distinct()
    keys = keys.withColumn("block", F.floor(F.col(axis) / 1024))
    inside = keys.select((F.col(axis) - F.lag(axis).over(Window.partitionBy("block").orderBy(axis))).alias("gap"))
    # between the blocks, one row for 1024 possible keys is left to sort in one partition
    ends = keys.groupBy("block").agg(F.min(axis).alias("low"), F.max(axis).alias("high"))
    between = ends.select((F.col("low") - F.lag("high").over(Window.orderBy("block"))).alias("gap"))
    return inside.unionByName(between).agg(F.coalesce(F.min("gap"), F.lit(1)).cast("int").alias(f"step_{axis}"))


#: Steps of the keys along a side of a block in which neighbours are looked up.
BLOCK = 64


def _gaps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Tiles sorted by block -> tile, gone: the bit of each direction without a tile. Tiles around a block came with it."""

    def found(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
        t = pa.Table.from_batches(parts)
        x, y, e, n, se, sn = (t[c].to_numpy() for c in ("bx", "by", "e", "n", "step_e", "step_n"))
        block = np.cumsum(np.r_[True, (x[1:] != x[:-1]) | (y[1:] != y[:-1])])
        es, ns = np.unique(e), np.unique(n)

        def code(key, keys):
            at = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
            return at, keys[at] == key

        there = np.unique((block * len(es) + code(e, es)[0]) * len(ns) + code(n, ns)[0])
        own = t["own"].to_numpy()
        block, e, n, se, sn = (v[own] for v in (block, e, n, se, sn))
        gone = np.zeros(len(e), np.int32)
        for k, (_, dx, dy) in enumerate(DIRECTIONS):
            (i, some), (j, other) = code(e + dx * se, es), code(n + dy * sn, ns)
            gone |= (~(some & other & code((block * len(es) + i) * len(ns) + j, there)[1])).astype(np.int32) << k
        return pa.RecordBatch.from_arrays([t["tile"].filter(t["own"]).combine_chunks(), pa.array(gone)], names=["tile", "gone"])

    held: list[pa.RecordBatch] = []
    for b in batches:
        if not b.num_rows:
            continue
        x, y = b["bx"].to_numpy(), b["by"].to_numpy()
        last = (x == x[-1]) & (y == y[-1])
        cut = int(np.argmax(last))  # where the last block begins; it may go on in the next batch
        before = held[-1] if held else None
        if cut or (before is not None and (before["bx"][before.num_rows - 1].as_py(), before["by"][before.num_rows - 1].as_py()) != (x[0], y[0])):
            if ready := [*held, *([b.slice(0, cut)] if cut else [])]:
                yield found(ready)
            held = []
        held.append(b.slice(cut))
    if held:
        yield found(held)


def missing_neighbours(tiles: DataFrame) -> DataFrame:
    """tiles (tile, e, n; null keys allowed) -> tile, missing: directions without a tile, all for unreadable keys.

    Tiles are dealt to blocks of the ground, those near a border to the next ones too, so a tile is sent little more than once.
    """
    order = F.array(*[F.lit(d[0]) for d in DIRECTIONS])
    tiles = saved(tiles.select("tile", "e", "n"), "tiles")
    steps = F.broadcast(key_step(tiles, "e").join(key_step(tiles, "n")))
    keyed = tiles.filter("e IS NOT NULL AND n IS NOT NULL").join(steps).select("tile", *[F.col(c).cast("long").alias(c) for c in ("e", "n", "step_e", "step_n")])
    at = lambda c, k: F.floor((F.col(c) + k * F.col(f"step_{c}")) / (BLOCK * F.col(f"step_{c}")))
    around = lambda c: F.explode(F.array_distinct(F.array(*[at(c, k) for k in (-1, 0, 1)])))
    dealt = keyed.withColumn("bx", around("e")).withColumn("by", around("n")).withColumn("own", (F.col("bx") == at("e", 0)) & (F.col("by") == at("n", 0)))
    dealt = dealt.withColumn("tile", F.when(F.col("own"), F.col("tile")))
    n_parts, kind = int(tiles.sparkSession.conf.get("spark.sql.shuffle.partitions")), tiles.schema["tile"].dataType.simpleString()
    gaps = dealt.repartition(n_parts, "bx", "by").sortWithinPartitions("bx", "by").mapInArrow(_gaps, f"tile {kind}, gone int")
    bits = [F.when(F.col("gone").bitwiseAND(1 << k) != 0, d[0]) for k, d in enumerate(DIRECTIONS)]
    known = gaps.select("tile", F.filter(F.array(*bits), lambda d: d.isNotNull()).alias("missing"))
    return known.unionByName(tiles.filter("e IS NULL OR n IS NULL").select("tile", order.alias("missing")))


def covered_cells(boxes: DataFrame, size: float) -> DataFrame:
    """boxes (minx, miny, maxx, maxy, ..) with a row for each cell (ix, iy) that they touch."""
    last = lambda c: F.ceil(F.col(c) / size) - 1
    xs = F.sequence(F.floor(F.col("minx") / size), F.greatest(F.floor(F.col("minx") / size), last("maxx")))
    ys = F.sequence(F.floor(F.col("miny") / size), F.greatest(F.floor(F.col("miny") / size), last("maxy")))
    return boxes.withColumn("ix", F.explode(xs)).withColumn("iy", F.explode(ys))


def touched(low: str, high: str, size: Column) -> tuple[Column, Column]:
    """First and last cell of a side."""
    first = F.floor(F.col(low) / size)
    return first, F.greatest(first, F.ceil(F.col(high) / size) - 1)


def quad_cells(boxes: DataFrame, size: float, most: int) -> DataFrame:
    """boxes (id, minx, miny, maxx, maxy) with a row for each leaf (level, ix, iy) of a quad-tree that they touch, and ``blocks``.

    Cells of ``size`` with more than ``most`` boxes are split in four, and so on, while their boxes touch at most two of the four
    parts on average: else they lie over each other and splitting only copies them. Such a leaf gets several blocks, to be
    joined in pairs. Cells are counted before any box is sent to them.
    """
    rows, leaves, level = covered_cells(boxes, size).withColumn("level", F.lit(0)), [], 0
    cell = ["ix", "iy"]
    while True:
        half = F.lit(size / 2 ** (level + 1))
        (x0, x1), (y0, y1) = touched("minx", "maxx", half), touched("miny", "maxy", half)
        low = {"x0": F.greatest(x0, 2 * F.col("ix")), "x1": F.least(x1, 2 * F.col("ix") + 1), "y0": F.greatest(y0, 2 * F.col("iy")), "y1": F.least(y1, 2 * F.col("iy") + 1)}
        rows = rows.withColumns(low)
        parts = (F.col("x1") - F.col("x0") + 1) * (F.col("y1") - F.col("y0") + 1)
        counted = rows.groupBy(*cell).agg(F.count("*").alias("n"), F.sum(parts).alias("parts")).filter(F.col("n") > most)
        hot = saved(counted.select(*cell, "n", (F.col("parts") <= 2 * F.col("n")).alias("split")), f"quad-cells-{level}")
        told = rows.join(hot, cell, "left").withColumn("blocks", F.when(F.col("split"), 0).otherwise(F.ceil(F.coalesce("n", F.lit(1)) / most)).cast("int"))
        leaves.append(told.filter("blocks > 0").drop("x0", "x1", "y0", "y1", "n", "split"))
        if hot.filter("split").isEmpty():
            break
        finer = told.filter("blocks = 0").select("id", "minx", "miny", "maxx", "maxy", F.explode(F.sequence("x0", "x1")).alias("ix"), "y0", "y1")
        finer = finer.select("id", "minx", "miny", "maxx", "maxy", "ix", F.explode(F.sequence("y0", "y1")).alias("iy"))
        level += 1
        rows = saved(finer, f"quad-boxes-{level}").withColumn("level", F.lit(level))
    out = leaves[0]
    for more in leaves[1:]:
        out = out.unionByName(more)
    return out


#: Boxes of a cell or block that one task sweeps, and pairs that it looks at together.
CELL_BOXES, SWEEP = 2000, 1 << 20


GROUP = ["level", "ix", "iy", "p", "q"]


def _sweep(size: float, kind: str, limit: float):
    """The pairs of groups of boxes, whose rows are sorted by group and low side: each box is compared with those of its group that
    begin before it ends. Many small groups are swept together; the last one of a batch waits for the next."""

    def pairs(t: pa.Table, group: np.ndarray) -> Iterator[pa.RecordBatch]:
        ids, col = t["id"].to_numpy(), lambda c: t[c].to_numpy()
        x0, y0, x1, y1, block, ix, iy = map(col, ("minx", "miny", "maxx", "maxy", "block", "ix", "iy"))
        cell, cross, area = size / 2.0 ** col("level"), col("p") != col("q"), (x1 - x0) * (y1 - y0)
        starts = np.unique(x0)
        rank = lambda x: group * (len(starts) + 1) + np.searchsorted(starts, x)
        count = np.maximum(np.searchsorted(rank(x0), rank(x1), "left") - np.arange(len(x0)) - 1, 0)
        ends, lo = np.cumsum(count), 0
        while lo < len(x0):
            hi = max(lo + 1, int(np.searchsorted(ends, (ends[lo - 1] if lo else 0) + SWEEP, "right")))
            n = count[lo:hi]
            i = np.repeat(np.arange(lo, hi), n)
            j = i + 1 + np.arange(len(i)) - np.repeat(np.cumsum(n) - n, n)
            low_y = np.maximum(y0[i], y0[j])
            w, h = np.minimum(x1[i], x1[j]) - x0[j], np.minimum(y1[i], y1[j]) - low_y
            ok = (w > 0) & (h > 0) & (ids[i] != ids[j]) & (np.floor(x0[j] / cell[j]) == ix[j]) & (np.floor(low_y / cell[j]) == iy[j])
            ok &= ~cross[i] | (block[i] != block[j])
            ok &= w * h > limit * np.minimum(area[i], area[j]) if kind == "share" else (w > limit) & (h > limit)
            i, j = i[ok], j[ok]
            first = np.asarray(ids[i] < ids[j], bool)
            a, b = (t["id"].take(pa.array(np.where(first, u, v))).combine_chunks() for u, v in ((i, j), (j, i)))
            yield pa.RecordBatch.from_arrays([a, b, pa.array(w[ok]), pa.array(h[ok])], names=["a", "b", "w", "h"])
            lo = hi

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            t = pa.Table.from_batches([batch])
            held = t if held is None else pa.concat_tables([held, t]).combine_chunks()
            if not held.num_rows:
                continue
            new = np.zeros(held.num_rows, bool)
            for c in GROUP:
                v = held[c].to_numpy()
                new[1:] |= v[1:] != v[:-1]
            group = np.cumsum(new)
            cut = int(np.searchsorted(group, group[-1]))
            if cut:
                yield from pairs(held.slice(0, cut), group[:cut])
                held = held.slice(cut)
        if held is not None and held.num_rows:
            yield from pairs(held, np.zeros(held.num_rows, np.int64))

    return run


def overlapping_pairs(boxes: DataFrame, size: float, kind: str = "share", limit: float = 0.01, most: int = CELL_BOXES) -> DataFrame:
    """boxes (id, minx, miny, maxx, maxy) -> a, b, w, h of pairs a < b that overlap.

    share: the overlap is over ``limit`` of the smaller box; extent: both sides are over ``limit``. Pairs meet in the leaves of a
    quad-tree that they touch, where a plane sweep finds them; the leaf of the overlap's lower corner reports them, so each pair
    comes once. Leaves whose boxes lie over each other are dealt to blocks, whose pairs are groups of their own, so no task gets
    more than twice ``most`` boxes.
    """
    sides = [F.col(c).cast("double").alias(c) for c in ("minx", "miny", "maxx", "maxy")]
    kept = boxes.select("id", *sides).dropna()
    leaf = quad_cells(kept, size, most).withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
    met = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda k: F.struct(F.least("block", k).alias("p"), F.greatest("block", k).alias("q")))
    dealt = leaf.select("id", "minx", "miny", "maxx", "maxy", "level", "ix", "iy", "block", F.inline(met))
    kind_of = boxes.schema["id"].dataType.simpleString()
    n_parts = int(boxes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return dealt.repartition(n_parts, *GROUP).sortWithinPartitions(*GROUP, "minx").mapInArrow(_sweep(size, kind, limit), f"a {kind_of}, b {kind_of}, w double, h double")


def cells_by_box(cells: DataFrame, boxes: DataFrame, size: float) -> DataFrame:
    """cells (ix, iy, name) and boxes (id, ..) -> name, id where their interiors meet."""
    covered = covered_cells(boxes.select("id", "minx", "miny", "maxx", "maxy"), size).filter(
        (F.col("maxx") > F.col("ix") * size) & (F.col("minx") < (F.col("ix") + 1) * size)
        & (F.col("maxy") > F.col("iy") * size) & (F.col("miny") < (F.col("iy") + 1) * size)
    )
    return cells.join(covered.select("ix", "iy", "id"), ["ix", "iy"]).select("name", "id")


def check_cells(cells: DataFrame, size: float = 1000.0) -> DataFrame:
    """cells (name, minx, miny, maxx, maxy, epsg) with ix, iy and problems."""
    names = Window.partitionBy("name")
    ix, iy = F.round(F.col("minx") / size), F.round(F.col("miny") / size)
    far = lambda a, b: F.abs(a - b) > 0.001
    checks = [
        (F.col("epsg") != 2056, "crs"),
        (far(F.col("maxx") - F.col("minx"), F.lit(size)) | far(F.col("maxy") - F.col("miny"), F.lit(size)), "size"),
        (far(F.col("minx"), ix * size) | far(F.col("miny"), iy * size), "origin"),
        (~F.coalesce(F.col("name").rlike("^[0-9]{4}_[0-9]{4}$"), F.lit(False)), "name"),
        (F.count("*").over(names) > 1, "duplicate"),
    ]
    problems = F.filter(F.array(*[F.when(c, m) for c, m in checks]), lambda x: x.isNotNull())
    return cells.withColumns({"ix": ix.cast("int"), "iy": iy.cast("int"), "problems": problems})


def snapped_bbox(boxes: DataFrame, size: float) -> DataFrame:
    """One row: the overall box, widened to whole cells."""
    return boxes.agg(
        (F.floor(F.min("minx") / size) * size).alias("minx"), (F.floor(F.min("miny") / size) * size).alias("miny"),
        (F.ceil(F.max("maxx") / size) * size).alias("maxx"), (F.ceil(F.max("maxy") / size) * size).alias("maxy"),
    )


def uniformity(headers: DataFrame) -> DataFrame:
    """headers (name, bands, dtype, gsd, prefix) -> one row of distinct counts and whether all are alike."""
    out = headers.agg(*[F.count_distinct(c).alias(f"n_{c}") for c in ("bands", "dtype", "gsd", "prefix")], F.count("*").alias("tiles"))
    return out.withColumn("uniform", (F.col("n_bands") <= 1) & (F.col("n_dtype") <= 1) & (F.col("n_gsd") <= 1) & (F.col("n_prefix") <= 1))
