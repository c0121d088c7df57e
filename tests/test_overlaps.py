"""Overlaps of boxes by a quad-tree against all pairs."""

from __future__ import annotations

import random

import pytest

from surveyspark.operators import tiles as T

SCHEMA = "id string, minx double, miny double, maxx double, maxy double"


def every_pair(boxes, kind, limit):
    out = set()
    for i, a in enumerate(boxes):
        for b in boxes[i + 1 :]:
            w, h = min(a[3], b[3]) - max(a[1], b[1]), min(a[4], b[4]) - max(a[2], b[2])
            if w <= 0 or h <= 0:
                continue
            least = min((x[3] - x[1]) * (x[4] - x[2]) for x in (a, b))
            if w * h > limit * least if kind == "share" else w > limit and h > limit:
                out.add((min(a[0], b[0]), max(a[0], b[0]), w, h))
    return out


def boxes_with_a_hot_cell(n, over_each_other):
    rng = random.Random(n)
    out = []
    for k in range(n):
        if k % 2:  # half of all lie in one cell
            x, y = (rng.uniform(0, 3), rng.uniform(0, 3)) if over_each_other else (rng.uniform(0, 900), rng.uniform(0, 900))
            w, h = (900, 900) if over_each_other else (rng.uniform(1, 30), rng.uniform(1, 30))
        else:
            x, y, w, h = rng.uniform(-5000, 5000), rng.uniform(-5000, 5000), rng.uniform(1, 2500), rng.uniform(1, 2500)
        out.append((f"b{k:04d}", x, y, x + w, y + h))
    # on cell borders, equal boxes, without extent
    out += [("e1", 0.0, 0.0, 1000.0, 1000.0), ("e2", 1000.0, 0.0, 2000.0, 1000.0), ("e3", 0.0, 0.0, 1000.0, 1000.0), ("e4", 500.0, 500.0, 500.0, 500.0)]
    return out


@pytest.mark.parametrize("kind", ["share", "extent"])
@pytest.mark.parametrize("over_each_other", [False, True])
def test_pairs_equal_all_pairs_in_a_hot_cell(spark, kind, over_each_other):
    boxes = boxes_with_a_hot_cell(300, over_each_other)
    got = T.overlapping_pairs(spark.createDataFrame([*boxes, ("n", None, 0.0, 1.0, 1.0)], SCHEMA), 1000.0, kind, 0.05, most=20).collect()
    assert len(got) == len({(r.a, r.b) for r in got})
    assert {tuple(r) for r in got} == every_pair(boxes, kind, 0.05)


@pytest.mark.parametrize("over_each_other", [False, True])
def test_no_group_has_a_hot_cell_whole(spark, over_each_other):
    boxes = boxes_with_a_hot_cell(600, over_each_other)
    leaves = T.quad_cells(spark.createDataFrame(boxes, SCHEMA), 1000.0, 20)
    rows = leaves.groupBy("level", "ix", "iy", "blocks").count().collect()
    assert max(r["count"] / r.blocks for r in rows) <= 20
    assert (max(r.level for r in rows) > 1) != over_each_other or max(r.blocks for r in rows) > 5
    assert sum(r["count"] for r in rows) < 12 * len(boxes)


def test_empty_table(spark):
    assert T.overlapping_pairs(spark.createDataFrame([], SCHEMA), 1000.0).collect() == []
