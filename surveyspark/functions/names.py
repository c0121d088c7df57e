"""File names: areas, tile keys, products, NoData values, layout. All are Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

UNKNOWN = "UNKNOWN"
DSM_NODATA = "-3.4028235e+38"


def extension(name: Column) -> Column:
    """With its dot, lower-cased; empty if there is none."""
    return F.lower(F.regexp_extract(name, r"[^.](\.[^.]*)$", 1))


def stem(name: Column) -> Column:
    return F.regexp_replace(name, r"\.[^.]*$", "")


def is_hillshade(name: Column) -> Column:
    parts = F.split(F.lower(stem(name)), "_")
    return F.array_contains(parts, "hillshade") | (F.element_at(parts, -1) == "hs")


def area(name: Column, gds: Column, any_case: bool = True) -> Column:
    """Text between year and product token; UNKNOWN if the name doesn't fit."""
    flag = "(?i)" if any_case else ""
    found = lambda token: F.regexp_extract(name, f"{flag}20[0-9]{{2}}_(.+?)_{token}", 1)
    shade = F.lower(name).contains("hillshade") if any_case else name.contains("hillshade")
    text = (
        F.when(gds.isin("SB_DOP", "SB_DOP_16"), found("DOP"))
        .when(gds == "SB_DSM", F.when(shade, found("hillshade")).otherwise(found("DSM")))
        .when(gds == "SB_DSM_PUNKTWOLKE", found("TIN"))
        .otherwise("")
    )
    return F.when(text == "", UNKNOWN).otherwise(text)


def parts(name: Column) -> Column:
    """What underscores part in the stem. As a column of its own where several values are made of it, so that it is made once."""
    return F.split(stem(name), "_")


def tile_key(name: Column) -> Column:
    """The two parts before the first exact ``LV95``."""
    return tile_key_of(parts(name))


def tile_key_of(parts: Column) -> Column:
    at = F.array_position(parts, "LV95").cast("int")
    return F.when(at >= 3, F.concat_ws("_", F.try_element_at(parts, at - 2), F.try_element_at(parts, at - 1))).otherwise(UNKNOWN)


def tile_numbers(key: Column) -> Column:
    """Struct of e and n; null unless both are whole numbers."""
    parts = F.split(key, "_")
    ok = key.rlike(r"^[+-]?[0-9]+_[+-]?[0-9]+$")
    return F.when(ok, F.struct(parts[0].try_cast("int").alias("e"), parts[1].try_cast("int").alias("n")))


def las_origin(name: Column) -> Column:
    """Struct of e_km, n_km and problem for a LAZ tile's name."""
    pattern = r"([0-9]{4})_([0-9]{4})_LV95_LN02\.laz$"
    # a failed try_cast costs an exception a row, so what isn't there is null before it
    e, n = (F.nullif(F.regexp_extract(name, pattern, i), F.lit("")).try_cast("int") for i in (1, 2))
    problem = (
        F.when(~name.rlike(pattern), "no tile in name")
        .when(~e.between(2480, 2840), "easting out of range")
        .when(~n.between(1070, 1300), "northing out of range")
    )
    return F.struct(e.alias("e_km"), n.alias("n_km"), problem.alias("problem"))


def nodata_source(name: Column, gds: Column, value: Column) -> Column:
    dsm = (
        F.when(F.lower(name).contains("hillshade") | is_hillshade(name), "255")
        .when(F.lower(name).contains("_dsm_"), DSM_NODATA)
        .otherwise(F.coalesce(value, F.lit("")))
    )
    return F.when(gds == "SB_DSM", dsm).otherwise(F.coalesce(value, F.lit("")))


def nodata_output(gds: Column, value: Column) -> Column:
    """DOP: every token becomes 0; surface models and points stay."""
    tokens = F.filter(F.split(F.trim(value), r"\s+"), lambda x: x != "")
    zero = F.array_join(F.transform(tokens, lambda _: F.lit("0")), " ")
    return F.when(gds.isin("SB_DSM", "SB_DSM_PUNKTWOLKE"), value).otherwise(zero)


def nodata_bands(value: Column, bands: Column) -> Column:
    """Values per band; one value holds for all; null if the number doesn't fit."""
    tokens = F.filter(F.split(F.trim(value), r"\s+"), lambda x: x != "")
    return F.when(F.size(tokens) == 1, F.array_repeat(tokens[0], bands)).when(F.size(tokens) == bands, tokens)


def line_token(name: Column) -> Column:
    """HHMM before NRGB; null if there is none."""
    return F.nullif(F.regexp_extract(name, r"(?i)([0-9]{4})NRGB", 1), F.lit(""))


def year_of(name: Column) -> Column:
    return F.nullif(F.regexp_extract(name, r"(20[0-9]{2})", 1), F.lit("")).try_cast("int")


def catalog_name(gds: Column, dmc: Column) -> Column:
    return F.when(dmc & (gds == "SB_DOP"), "SB_DOP_DMC").otherwise(gds)


def is_int_path(path: Column) -> Column:
    return F.array_contains(F.split(F.regexp_replace(path, "/", "\\\\"), r"\\"), "BUCKET_INT")


def product_of_path(path: Column) -> Column:
    """Second-last part of a path."""
    return F.try_element_at(F.filter(F.split(path, r"[/\\]"), lambda x: x != ""), F.lit(-2))


def sanitized(text: Column) -> Column:
    clean = F.regexp_replace(F.trim(text), r"[^A-Za-z0-9_.-]", "_")
    clean = F.regexp_replace(clean, r"^[_.\-]+|[_.\-]+$", "")
    return F.when(clean == "", UNKNOWN).otherwise(F.coalesce(clean, F.lit(UNKNOWN)))


def common_prefix(name: Column) -> Column:
    """Before ``_LV95`` in any case; null without it."""
    at = F.instr(F.upper(stem(name)), "_LV95")
    return F.when(at > 0, F.substring(name, F.lit(1), at - 1))


def dsm_folder(name: Column) -> Column:
    return F.when(is_hillshade(name), "HILLSHADE").otherwise("DSM")


def precalc_laz(key: Column) -> Column:
    return F.concat(F.lit("SB_DSM_PUNKTWOLKE_LAZ_CHLV95_LN02_"), key, F.lit(".laz"))


def year_of_path(path: Column) -> Column:
    """The right-most folder that is a year from 2000 on; null without one."""
    years = F.filter(F.split(path, r"[/\\]"), lambda x: x.rlike("^20[0-9]{2}$"))
    return F.try_element_at(years, F.lit(-1)).cast("int")


def area_of_target(path: Column) -> Column:
    """Between year and product token of a target folder's name; else what follows the year, else the name."""
    base = F.regexp_extract(F.regexp_replace(path, r"[/\\]+$", ""), r"([^/\\]*)$", 1)
    rest = lambda pattern: F.nullif(F.regexp_extract(base, pattern, 1), F.lit(""))
    return F.coalesce(rest(r"(?i)20\d{2}_(.+?)_(?:DOP|DSM|TIN|hillshade)"), rest(r"^20\d{2}_(.+)"), F.nullif(base, F.lit("")), F.lit(UNKNOWN))


def point_tile_name(year: Column, area_name: Column, key: Column) -> Column:
    return F.concat(F.concat_ws("_", year.cast("string"), area_name, F.lit("TIN"), key), F.lit("_LV95_LN02.laz"))


def raster_tile_name(prefix: Column, key: Column) -> Column:
    return F.concat(prefix, F.lit("_"), key, F.lit("_LV95.tif"))


def catalog_link(catalog: Column, path: Column, host: str, host_int: str) -> Column:
    """Where a package is imported; empty for products without a catalog. host_int: for paths of the integration bucket."""
    known = catalog.isin("SB_DOP", "SB_DOP_16", "SB_DSM", "SB_DSM_PUNKTWOLKE", "SB_DOP_DMC")
    link = F.concat(F.lit("https://"), F.when(is_int_path(path), host_int).otherwise(host), F.lit("/catalog-ng/catalog/"), catalog, F.lit("/import"))
    return F.when(known, link).otherwise("")
