"""Geometry and coordinate-system rules. All are Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .names import is_hillshade

LV95_E, LV95_N = (2_400_000, 2_900_000), (1_000_000, 1_350_000)
#: Text point clouds are classified with a wider north range.
POINT_N = (1_000_000, 1_400_000)
LV95, LV95_LN02 = "EPSG:2056", "EPSG:2056+5728"
DOP = ("SB_DOP", "SB_DOP_16")
FRAME, EPS = 999.99, 0.02


def corner(gt: Column, col: Column, row: Column) -> tuple[Column, Column]:
    return gt[0] + col * gt[1] + row * gt[2], gt[3] + col * gt[4] + row * gt[5]


def _corners(gt: Column, cols: Column, rows: Column) -> list[tuple[Column, Column]]:
    zero = F.lit(0)
    return [corner(gt, c, r) for c, r in ((zero, rows), (cols, rows), (cols, zero), (zero, zero))]


def footprint(gt: Column, cols: Column, rows: Column) -> Column:
    """WKT polygon LL, LR, UR, UL, LL with three decimals."""
    ring = _corners(gt, cols, rows)
    points = [F.format_string("%.3f %.3f", x, y) for x, y in [*ring, ring[0]]]
    return F.concat(F.lit("POLYGON (("), F.concat_ws(", ", *points), F.lit("))"))


def full_float(value: Column) -> Column:
    """Shortest decimal text that gives the number back, with at least one decimal and no exponent (below 10^16)."""
    text = value.cast("decimal(38,21)").cast("string")
    return F.when(value == 0, "0.0").otherwise(F.regexp_replace(text, r"(\.\d+?)0+$", "$1"))


def full_footprint(gt: Column, cols: Column, rows: Column, name: Column) -> Column:
    """WKT polygon LL, LR, UR, UL, LL with all digits; empty for files that are no TIFF."""
    ring = _corners(gt, cols, rows)
    points = [F.concat_ws(" ", full_float(x), full_float(y)) for x, y in [*ring, ring[0]]]
    wkt = F.concat(F.lit("POLYGON (("), F.concat_ws(", ", *points), F.lit("))"))
    return F.when(F.lower(name).rlike(r"\.tiff?$"), wkt).otherwise("")


def in_lv95(gt: Column, cols: Column, rows: Column) -> Column:
    ring = _corners(gt, cols, rows)
    xs, ys = [p[0] for p in ring], [p[1] for p in ring]
    return (
        (F.least(*xs) >= LV95_E[0]) & (F.greatest(*xs) <= LV95_E[1])
        & (F.least(*ys) >= LV95_N[0]) & (F.greatest(*ys) <= LV95_N[1])
    )


def classify_bbox(minx: Column, maxx: Column, miny: Column, maxy: Column) -> Column:
    lv95 = (minx >= LV95_E[0]) & (maxx <= LV95_E[1]) & (miny >= POINT_N[0]) & (maxy <= POINT_N[1])
    lv03 = (minx >= LV95_E[0] - 2_000_000) & (maxx <= LV95_E[1] - 2_000_000) & (miny >= POINT_N[0] - 1_000_000) & (maxy <= POINT_N[1] - 1_000_000)
    return F.when(lv95, "LV95").when(lv03, "LV03").otherwise("unknown")


def crs_target(gds: Column, name: Column) -> Column:
    return (
        F.when(gds == "SB_DSM", F.when(is_hillshade(name), LV95).otherwise(LV95_LN02))
        .when(gds.isin(*DOP), LV95)
    )


def crs_decision(info: Column, target: Column, accept_local: Column) -> Column:
    """Struct of action (ok, set, error) and message from the flags of a raster's CRS."""
    act = lambda a, m=None: F.struct(F.lit(a).alias("action"), (F.lit(None).cast("string") if m is None else m).alias("message"))
    with_height = target == LV95_LN02
    local = F.coalesce(info["local_only"], F.lit(False))
    recode = F.coalesce(info["lv95_equivalent"], F.lit(False))
    missing = ~info["has_crs"] | (accept_local & local)
    outside = F.concat(F.when(local, F.concat(F.lit("only local CRS "), info["name"])).otherwise("no CRS"), F.lit(", outside LV95"))
    return (
        F.when(missing & info["in_lv95_extent"], act("set"))
        .when(missing, act("error", outside))
        .when(~info["horizontal_is_lv95"], act("error", F.concat(F.lit("not LV95: "), info["name"])))
        .when(~info["is_compound"], F.when(with_height | recode, act("set")).otherwise(act("ok")))
        .when(~with_height, act("set"))
        .when(F.coalesce(info["vertical_epsg"] == "5728", F.lit(False)), F.when(recode, act("set")).otherwise(act("ok")))
        .otherwise(act("error", F.concat(F.lit("height is not LN02: "), info["name"])))
    )


def vertical_warning(gds: Column, info: Column) -> Column:
    return gds.isin(*DOP) & info["is_compound"] & ~F.coalesce(info["vertical_epsg"] == "5728", F.lit(False))


def retag_allowed(gds: Column, info: Column) -> Column:
    return gds.isin(*DOP) & info["has_crs"] & ~info["horizontal_is_lv95"] & info["in_lv95_extent"]


def crs_file_action(gds: Column, info: Column, target: Column) -> Column:
    """Struct of action (ok, set, warn, retag, error; null without a target) and note (recoded, local)."""
    decided = crs_decision(info, target, ~gds.isin(*DOP))
    error = decided["action"] == "error"
    action = (
        F.when(target.isNull(), F.lit(None).cast("string"))
        .when(error & retag_allowed(gds, info), "retag")
        .when(error, "error")
        .when(vertical_warning(gds, info), "warn")
        .otherwise(decided["action"])
    )
    note = F.when(
        action == "set",
        F.when(F.coalesce(info["lv95_equivalent"], F.lit(False)), "recoded").when(
            ~gds.isin(*DOP) & F.coalesce(info["local_only"], F.lit(False)), "local"
        ),
    )
    return F.struct(action.alias("action"), note.alias("note"))


def point_crs_problem(horizontal: Column, vertical: Column, wkt: Column) -> Column:
    """Why a point cloud's CRS is refused; null if it isn't. Missing codes are accepted."""
    return (
        F.when((vertical == "5729") | F.coalesce(wkt, F.lit("")).rlike("(?i)LHN95"), "LHN95 heights")
        .when(F.coalesce(vertical != "5728", F.lit(False)), "height is not LN02")
        .when(F.coalesce(horizontal != "2056", F.lit(False)), "not LV95")
    )


def epsg_of(components: Column, kind: str) -> Column:
    """Code of the last component of a type."""
    return F.try_element_at(F.filter(components, lambda c: c["type"] == kind), F.lit(-1))["code"]


# The component types that give a horizontal code.
HORIZONTAL = ("ProjectedCRS", "GeographicCRS", "GeodeticCRS")


def resolved_epsg(srs: Column) -> Column:
    """Struct of horizontal and vertical codes of a system as JSON: the last component of each kind, and without components the
    system's own code. Only codes of the EPSG authority count."""
    ident = "id struct<authority:string,code:int>"
    j = F.from_json(srs, f"type string, {ident}, components array<struct<type:string,{ident.replace(' ', ':', 1)}>>")
    code = lambda c: F.when(c["id"]["authority"] == "EPSG", c["id"]["code"])
    last = lambda test: code(F.try_element_at(F.filter(j["components"], test), F.lit(-1)))
    alone = F.coalesce(F.size(j["components"]) <= 0, F.lit(True))
    return F.struct(
        F.when(alone, code(j)).otherwise(last(lambda c: c["type"].isin(*HORIZONTAL))).alias("horizontal"),
        F.when(~alone, last(lambda c: c["type"] == "VerticalCRS")).alias("vertical"),
    )


def frame_violation(minx: Column, maxx: Column, miny: Column, maxy: Column, e_km: Column, n_km: Column) -> Column:
    x, y = e_km * 1000, n_km * 1000
    return (minx < x - EPS) | (maxx > x + FRAME + EPS) | (miny < y - EPS) | (maxy > y + FRAME + EPS)


def frame_gaps(minx: Column, maxx: Column, miny: Column, maxy: Column, e_km: Column, n_km: Column, limit: float = EPS) -> Column:
    """Array of (side, gap) wider than the limit."""
    x, y = e_km * 1000, n_km * 1000
    gaps = (("west", minx - x), ("south", miny - y), ("east", x + FRAME - maxx), ("north", y + FRAME - maxy))
    sides = F.array(*[F.struct(F.lit(s).alias("side"), F.bround(g, 2).alias("gap")) for s, g in gaps])
    return F.filter(sides, lambda s: s["gap"] > limit)


def has_rgb(red: Column, green: Column, blue: Column) -> Column:
    """From the channels' maxima; null where the format has none."""
    return F.coalesce(F.greatest(red, green, blue) > 0, F.lit(False))


def point_format(rgb: Column, keep_rgb: Column) -> Column:
    """7 with colour, 6 without, null where colour and camera disagree."""
    return F.when(rgb & keep_rgb, 7).when(~rgb & ~keep_rgb, 6)


def point_format_problem(rgb: Column, keep_rgb: Column) -> Column:
    """Why ``point_format`` is null."""
    return F.when(keep_rgb & ~rgb, "no colour, but a colour camera").when(~keep_rgb & rgb, "colour, but a camera without")


def already_migrated(minor: Column, fmt: Column, encoding: Column, horizontal: Column, vertical: Column, target: Column) -> Column:
    return (minor == 4) & (fmt == target) & (encoding == 17) & (horizontal == "2056") & (vertical == "5728")


def requantised(value: Column, offset: Column, scale: float = 0.01) -> Column:
    return F.bround((value - offset) / scale) * scale + offset


def thresholds(px_x: Column, px_y: Column) -> Column:
    """Struct of area and contact thresholds in pixels for 900 square metres and 80 metres."""
    size = F.abs(px_x * px_y)
    return F.struct(
        F.greatest(F.lit(1), F.bround(900 / size).cast("int")).alias("area_px"),
        F.greatest(F.lit(1), F.bround(80 / F.sqrt(size)).cast("int")).alias("contact_px"),
    )


def north_up(gt: Column) -> Column:
    return (gt[2] == 0) & (gt[4] == 0) & (gt[1] > 0) & (gt[5] < 0)


def z_plausible(minz: Column, maxz: Column) -> Column:
    return (minz >= 150) & (maxz <= 4900)


def encoding_warning(encoding: Column) -> Column:
    return encoding.bitwiseAND(1) == 0


def off_grid(origin: Column, gsd: Column) -> Column:
    """True unless an origin is a multiple of the pixel size within a millionth of a pixel."""
    k = origin / gsd
    return F.abs(k - F.round(k)) > 1e-6
