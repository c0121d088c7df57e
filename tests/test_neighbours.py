"""Missing neighbours of tiles."""

from __future__ import annotations

import random

from surveyspark.operators import tiles as T


def test_blocks_against_all_pairs(spark):
    draw = random.Random(5)
    for step, shift in ((1, -70), (3, 2_147_000_000)):
        keys = {(shift + step * draw.randrange(150), -100 + 2 * draw.randrange(150)) for _ in range(9000)} | {(shift, -100), (shift + step, -98)}
        rows = [(f"t{k}", e, n) for k, (e, n) in enumerate(sorted(keys))]
        rows += [("double", *rows[7][1:]), ("no e", None, -100), ("no n", shift, None)]
        out = {r.tile: r.missing for r in T.missing_neighbours(spark.createDataFrame(rows, "tile string, e int, n int").repartition(5)).collect()}
        want = {t: [d for d, x, y in T.DIRECTIONS if e is None or n is None or (e + x * step, n + y * 2) not in keys] for t, e, n in rows}
        assert out == want


def test_a_tile_is_sent_little_more_than_once(spark):
    # eight rows a tile were shuffled before
    grid = spark.range(40_000).selectExpr("CAST(id AS STRING) AS tile", "CAST(id % 200 AS INT) AS e", "CAST(id div 200 AS INT) AS n")
    seen = spark.sparkContext.accumulator(0)
    look = T._gaps

    def counted(batches):
        def through():
            for b in batches:
                seen.add(b.num_rows)
                yield b

        return look(through())

    T._gaps = counted
    try:
        assert T.missing_neighbours(grid).filter("size(missing) = 0").count() == 198 * 198
    finally:
        T._gaps = look
    assert 40_000 < seen.value < 44_000
