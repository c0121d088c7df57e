"""Pixel rules on scanlines: a band is an array with one value per column. All are Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

FLOAT_MIN = -3.4028235e38
# Lift of near-black pixels by their darkest channel, and the brightest channel that still counts.
SHADOW_LIFT, SHADOW_MAX = (5, 4, 3, 2, 1, 1), 5


def nodata_mask(bands: Column, nodata: Column) -> Column:
    """False where all bands have their NoData value; null if the number of values doesn't fit."""
    width = F.size(bands[0])
    mask = F.transform(
        F.sequence(F.lit(0), width - 1),
        lambda c: ~F.forall(F.zip_with(bands, nodata, lambda b, v: F.get(b, c) == v), lambda same: same),
    )
    return F.when(F.size(bands) == F.size(nodata), F.when(width > 0, mask).otherwise(F.array().cast("array<boolean>")))


def zeroed(band: Column, mask: Column) -> Column:
    """0 where the mask is false."""
    return F.zip_with(band, mask, lambda v, m: F.when(m, v).otherwise(0))


def fixed_dsm(band: Column) -> Column:
    """-9999 becomes the least float."""
    low = F.lit(FLOAT_MIN).cast("float")
    return F.transform(band, lambda v: F.when(v == F.lit(-9999).cast("float"), low).otherwise(v))


def n_false_nodata(band: Column) -> Column:
    return F.size(F.filter(band, lambda v: v == F.lit(-9999).cast("float")))


def rescale_table(safe_max: int) -> Column:
    """Grey values 0 to 254 onto 0 to safe_max, half-even; 255 stays."""
    values = F.transform(F.sequence(F.lit(0), F.lit(254)), lambda i: F.bround(i * safe_max / 254.0).cast("int"))
    return F.concat(values, F.array(F.lit(255)))


def rescaled(band: Column, safe_max: int = 225) -> Column:
    return F.transform(band, lambda v: F.when(v == 255, 255).otherwise(F.bround(v * safe_max / 254.0).cast("int")))


def lift(red: Column, green: Column, blue: Column) -> Column:
    """Lift of one pixel from its three values; 0 if it isn't near black."""
    table = F.array(*[F.lit(x) for x in SHADOW_LIFT])
    dark = F.least(red, green, blue)
    return F.when(F.greatest(red, green, blue) <= SHADOW_MAX, F.get(table, dark)).otherwise(0)


def shadow_lifts(red: Column, green: Column, blue: Column) -> Column:
    two = F.zip_with(red, green, lambda r, g: F.struct(r.alias("r"), g.alias("g")))
    return F.zip_with(two, blue, lambda p, b: lift(p["r"], p["g"], b))


def shifted(band: Column, shift: Column) -> Column:
    """Sum, kept within 0 and 255."""
    return F.zip_with(band, shift, lambda v, s: F.greatest(F.lit(0), F.least(F.lit(255), v + s)))


def runs(hit: Column) -> Column:
    """Maximal runs of true columns as (c0, c1), both inclusive: starts and ends of the true stretches side by side."""
    at = F.sequence(F.lit(0), F.size(hit) - 1)
    starts = F.filter(at, lambda c: F.get(hit, c) & ~F.coalesce(F.get(hit, c - 1), F.lit(False)))
    ends = F.filter(at, lambda c: F.get(hit, c) & ~F.coalesce(F.get(hit, c + 1), F.lit(False)))
    pairs = F.zip_with(starts, ends, lambda a, b: F.struct(a.alias("c0"), b.alias("c1")))
    return F.when(F.size(hit) > 0, pairs).otherwise(F.array().cast("array<struct<c0:int,c1:int>>"))


def mask_of(run_list: Column, width: Column) -> Column:
    """True inside any of the runs (null: none)."""
    hit = F.transform(F.sequence(F.lit(0), width - 1), lambda c: F.exists(run_list, lambda r: c.between(r["c0"], r["c1"])))
    return F.when(run_list.isNull(), F.array_repeat(F.lit(False), width)).otherwise(hit)
