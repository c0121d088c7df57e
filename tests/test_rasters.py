"""NoData areas: decisions of known masks, and labels and shapes against a pixel flood fill."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from surveyspark.functions import pixels
from surveyspark.operators import components as C
from surveyspark.operators import raster as R

ALL = ["N", "NE", "E", "SE", "S", "SW", "W", "NW"]


def scan_of(spark, masks: dict[str, list[list[int]]]):
    rows = [(t, i, [bool(v) for v in line]) for t, m in masks.items() for i, line in enumerate(m)]
    return spark.createDataFrame(rows, "tile string, row int, hit array<boolean>")


def tiles_of(spark, masks, missing=None):
    rows = [(t, len(m), len(m[0]), (missing or {}).get(t, [])) for t, m in masks.items()]
    return spark.createDataFrame(rows, "tile string, height int, width int, missing array<string>")


def box(h, w, *areas):
    m = [[0] * w for _ in range(h)]
    for r0, r1, c0, c1 in areas:
        for r in range(r0, r1):
            for c in range(c0, c1):
                m[r][c] = 1
    return m


def flood(cells: set, steps) -> list[set]:
    left, out = set(cells), []
    while left:
        todo, part = [left.pop()], set()
        while todo:
            p = todo.pop()
            part.add(p)
            for a, b in steps:
                q = (p[0] + a, p[1] + b)
                if q in left:
                    left.remove(q)
                    todo.append(q)
        out.append(part)
    return out


FOUR = [(0, 1), (1, 0), (0, -1), (-1, 0)]
EIGHT = [*FOUR, (1, 1), (1, -1), (-1, 1), (-1, -1)]


def brute_shape(part: set) -> tuple[int, float]:
    r0, r1 = min(p[0] for p in part), max(p[0] for p in part)
    c0, c1 = min(p[1] for p in part), max(p[1] for p in part)
    back = {(r, c) for r in range(r0 - 1, r1 + 2) for c in range(c0 - 1, c1 + 2)} - part
    holes = set().union(*[a for a in flood(back, FOUR) if (r0 - 1, c0 - 1) not in a] or [set()])
    full = part | holes
    contour = sum((r + a, c + b) not in full for r, c in full for a, b in FOUR)
    return len(holes), contour / (2 * (r1 - r0 + 1 + c1 - c0 + 1))


@pytest.mark.parametrize("diagonal", [True, False])
@pytest.mark.parametrize("strip_runs", [None, 1, 20])
def test_labels_and_shapes_by_flood_fill(spark, diagonal, strip_runs):
    rng = random.Random(5)
    masks = {f"t{k}": [[int(rng.random() < 0.55) for _ in range(11)] for _ in range(9)] for k in range(12)}
    runs = C.scan_runs(scan_of(spark, masks), F.col("hit"))
    lab = C.label(runs, diagonal, strip_runs) if strip_runs else C.label(runs, diagonal)
    got: dict = {}
    for r in lab.collect():
        got.setdefault((r.tile, r.root_row, r.root_c), set()).update((r.row, c) for c in range(r.c0, r.c1 + 1))
    want = {}
    for t, m in masks.items():
        for part in flood({(r, c) for r, line in enumerate(m) for c, v in enumerate(line) if v}, EIGHT if diagonal else FOUR):
            want[(t, *min(part))] = part
    assert got == want
    if strip_runs is None:
        shapes = {(r.tile, r.root_row, r.root_c): (r.hole_px, round(r.roughness, 9)) for r in C.shapes(lab).collect()}
        assert shapes == {k: (h, round(x, 9)) for k, p in want.items() for h, x in [brute_shape(p)]}


def test_decisions(spark):
    wedge = box(300, 300)
    for r in range(220, 300):
        for c in range(100, 100 + (r - 219)):
            wedge[r][c] = 1
    triangle = box(300, 300)
    for r in range(60):
        for c in range(60 - r):
            triangle[r][c] = 1
    cases = {
        "corner": (box(50, 50, (0, 5, 0, 5)), 1000, 100, ["false_nodata"]), "row100": (box(300, 300, (0, 1, 0, 100)), 100, 100, ["real_nodata"]),
        "row99": (box(300, 300, (0, 1, 0, 99)), 99, 100, ["false_nodata"]), "centre": (box(100, 100, (40, 60, 40, 60)), 100, 10, ["false_nodata"]),
        "wedge": (wedge, 1000, 100, ["false_nodata"]), "bottom": (box(300, 300, (280, 300, 0, 250)), 1000, 100, ["real_nodata"]),
        "triangle": (triangle, 1000, 50, ["real_nodata"]), "half": (box(300, 300, (0, 300, 0, 150)), 1000, 100, ["real_nodata"]),
        "full": (box(50, 50, (0, 50, 0, 50)), 100, 10, ["real_nodata"]), "empty": (box(20, 20), 10, 10, []),
    }
    for name, (mask, size, contact, decisions) in cases.items():
        m = {name: mask}
        groups = C.classify(C.label(C.scan_runs(scan_of(spark, m), F.col("hit"))), tiles_of(spark, m), size, contact)
        assert [r.decision for r in groups.collect()] == decisions, name


def test_ragged_group_and_open_edge(spark):
    m = box(30, 60, (0, 30, 0, 60))
    for r in range(1, 30, 2):
        for c in range(1, 59, 3):
            m[r][c] = 0
    for r in range(12, 30):
        for c in range(0, 60, 2):
            m[r][c] = 0
    masks = {"inner": m, "edge": m}
    groups = C.classify(C.label(C.scan_runs(scan_of(spark, masks), F.col("hit"))), tiles_of(spark, masks, {"edge": ["N"]}), 100, 20)
    big = {r.tile: r for r in groups.filter("size_px >= 100").collect()}
    assert big["inner"].hole_ratio >= 0.01 and big["inner"].roughness >= 1.5
    assert (big["inner"].decision, big["edge"].decision, big["edge"].edge_override) == ("false_nodata", "real_nodata", True)


def test_open_contact_pixel_by_pixel(spark):
    m = box(6, 7, (0, 6, 0, 7))
    sets = {"none": [], "n": ["N"], "ne": ["NE"], "all": ALL, "ws": ["W", "S"]}
    masks = dict.fromkeys(sets, m)
    sizes = {r.tile: (r.border_px, r.open_px) for r in C.group_sizes(C.label(C.scan_runs(scan_of(spark, masks), F.col("hit"))), tiles_of(spark, masks, sets)).collect()}
    assert sizes == {"none": (22, 0), "n": (22, 7), "ne": (22, 1), "all": (22, 22), "ws": (22, 12)}


def test_masks(spark):
    df = spark.createDataFrame([([[0, 40, 0], [0, 90, 5], [0, 0, 0]], ["0"])], "bands array<array<int>>, x array<string>")
    mask = lambda *v: df.select(pixels.nodata_mask(F.col("bands"), F.array(*[F.lit(x) for x in v]))).first()[0]
    assert mask(0, 0, 0) == [False, True, True] and mask(0) is None
    f = spark.createDataFrame([([-3.4028234663852886e38, 1.0, -9999.0],)], "b array<float>")
    low = f.select(pixels.fixed_dsm(F.col("b")).alias("b"), pixels.n_false_nodata(F.col("b")).alias("n")).first()
    assert low.n == 1 and low.b[2] == low.b[0]


def test_rescale_twice(spark):
    s = spark.createDataFrame([("a", 0, [0, 1, 127, 128]), ("a", 1, [240, 241, 254, 255])], "tile string, row int, band array<int>")
    once = R.rescale_hillshade(s, safe_max=240)
    values = [v for r in once.orderBy("row").collect() for v in r.band]
    assert values == [0, 1, 120, 121, 227, 228, 240, 255]
    twice = R.rescale_hillshade(once, safe_max=240)
    assert [v for r in twice.orderBy("row").collect() for v in r.band] == values
    table = spark.range(1).select(pixels.rescale_table(225)).first()[0]
    assert table[127] == 112 and table[255] == 255 and table == sorted(table)


def test_shadow_lift_keeps_real_nodata(spark):
    s = spark.createDataFrame([("a", 0, [0, 0, 1, 9], [0, 0, 2, 9], [0, 0, 2, 9])], "tile string, row int, r array<int>, g array<int>, b array<int>")
    lab = spark.createDataFrame([("a", 0, 0, 0, 0, 0), ("a", 0, 1, 1, 0, 1)], "tile string, row int, c0 int, c1 int, root_row int, root_c int")
    groups = spark.createDataFrame([("a", 0, 0, "real_nodata"), ("a", 0, 1, "false_nodata")], "tile string, root_row int, root_c int, decision string")
    out = R.correct(s, lab, groups, 0).first()
    assert out.r == [0, 5, 5, 9] and out.g == [0, 5, 6, 9] and out.mask == [False, True, True, True]


def test_a_spiral_over_many_strips_is_one_component(spark):
    size = 61
    mask = [[0] * size for _ in range(size)]
    r, c, dr, dc = 0, 0, 0, 1
    while True:
        mask[r][c] = 1
        ahead = lambda k: (r + k * dr, c + k * dc)  # noqa: B023, E731
        free = lambda k: (lambda p: not (0 <= p[0] < size and 0 <= p[1] < size) or not mask[p[0]][p[1]])(ahead(k))  # noqa: B023, E731
        inside = lambda p: 0 <= p[0] < size and 0 <= p[1] < size
        if not (inside(ahead(1)) and free(1) and free(2)):
            dr, dc = dc, -dr
            if not (inside(ahead(1)) and free(1) and free(2)):
                break
        r, c = ahead(1)
    lab = C.label(C.scan_runs(scan_of(spark, {"s": mask}), F.col("hit")), False, strip_runs=10)
    assert {(x.root_row, x.root_c) for x in lab.collect()} == {(0, 0)}
    assert lab.count() > 500


def test_further_bands_stay(spark):
    scan = spark.createDataFrame([("t", 0, [255, 9], [255, 9], [255, 9], [7, 8], [1, 2])], "tile string, row int, r array<int>, g array<int>, b array<int>, nir array<int>, swir array<int>")
    lab = C.label(C.scan_runs(scan, F.transform("r", lambda v: v == 255)))
    groups = C.classify(lab, tiles_of(spark, {"t": [[1, 0]]}), 1000, 1)
    out = R.correct(scan, lab, groups, 255).first()
    assert (out.r, out.nir, out.swir) == ([254, 9], [7, 8], [1, 2])


def test_any_number_of_bands_is_cut_and_masked(spark):
    rng = random.Random(3)
    bands = {t: [[[rng.choice([9, 9, k + 1]) for _ in range(5)] for k in range(4)] for _ in range(3)] for t in ("a", "b")}
    bands["c"] = [[[9] * 5 for _ in range(4)] for _ in range(3)]
    scan = spark.createDataFrame([(t, r, b) for t, rows in bands.items() for r, b in enumerate(rows)], "tile string, row int, bands array<array<int>>")
    at = {"a": (0, 0), "b": (5, 0), "c": (100, 100)}
    got = {(r.cx, r.cy, r.row): r for r in R.cut_and_masked(scan, spark.createDataFrame([(t, *xy) for t, xy in at.items()], "tile string, x0 long, y0 long"), 4, [9, 9, 9, 9]).collect()}
    assert {k[:2] for k in got} == {(0, 0), (1, 0), (2, 0)} and len(got) == 12  # the cells of c are empty
    for (cx, cy, row), r in got.items():
        for i in range(4):
            x, y = 4 * cx + i, 4 * cy + row
            t = next((t for t, (x0, y0) in at.items() if x0 <= x < x0 + 5 and y0 <= y < y0 + 3), None)
            values = [bands[t][y][k][x - at[t][0]] for k in range(4)] if t else [9] * 4
            assert r["mask"][i] == (values != [9] * 4)
            assert [r.bands[k][i] for k in range(4)] == (values if r["mask"][i] else [0] * 4)


def test_a_delivery_repairs_before_it_cuts(spark):
    """The delivery's pixels are those of the correction, cut afterwards; files of other names are left out."""
    from surveyspark.plans import pipelines

    rows = [[255 if 2 <= r < 4 and 2 <= c < 4 else 100 for c in range(6)] for r in range(6)]
    scan = spark.createDataFrame([("d", n, r, [line, line, line]) for n in ("x", "y") for r, line in enumerate(rows)], "delivery string, name string, row int, bands array<array<int>>")
    tiles = spark.createDataFrame([("d", "x", 0, 0), ("d", "y", 6, 0)], "delivery string, name string, x0 long, y0 long")
    going = spark.createDataFrame([("d", "x")], "delivery string, name string")
    plain = pipelines.Images(scan, tiles, 6, [255, 255, 255]).of(going).collect()
    fixed = pipelines.Images(scan, tiles, 6, [255, 255, 255], repair=(100, 10)).of(going).collect()
    assert {(r.cx, r.cy) for r in plain} == {(r.cx, r.cy) for r in fixed} == {(0, 0)}
    assert {r.row: r.bands[0] for r in plain}[2] == [100, 100, 0, 0, 100, 100]
    assert {r.row: r.bands[0] for r in fixed}[2] == [100, 100, 254, 254, 100, 100]  # small and inside: no NoData


@pytest.mark.parametrize("tile", ["string", "int"])
def test_labels_of_strips_that_go_on_over_batches(spark, tile):
    """Strips are labelled as they come in batches of rows: where a batch ends changes nothing, for any type of key."""
    rng = random.Random(8)
    masks = {k: [[int(rng.random() < 0.6) for _ in range(7)] for _ in range(rng.randint(1, 8))] for k in range(9)}
    rows = [(str(k) if tile == "string" else k, 5 * k + i, [bool(v) for v in line]) for k, m in masks.items() for i, line in enumerate(m)]
    runs = C.scan_runs(spark.createDataFrame(rows, f"tile {tile}, row int, hit array<boolean>"), F.col("hit"))
    want = {(k, 5 * k + r, c): (5 * k + min(part)[0], min(part)[1]) for k, m in masks.items() for part in flood({(r, c) for r, line in enumerate(m) for c, v in enumerate(line) if v}, EIGHT) for r, c in part}
    size = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(size)
    for n in (1, 2, 5, 1000):
        spark.conf.set(size, n)
        try:
            for strips in (3, 500):
                got = {(int(r.tile), r.row, c): (r.root_row, r.root_c) for r in C.label(runs, strip_runs=strips).collect() for c in range(r.c0, r.c1 + 1)}
                assert got == want
        finally:
            spark.conf.set(size, before)
