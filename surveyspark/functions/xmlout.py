"""The XML document of a tile, as a Column."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

INDENT = "    "


def escaped(text: Column) -> Column:
    out = text
    for a, b in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        out = F.replace(out, F.lit(a), F.lit(b))
    return out


def element(tag: str, value: Column) -> Column:
    """Indented element; an empty value closes itself; null leaves it out."""
    full = F.concat(F.lit(f"{INDENT}<{tag}>"), escaped(value), F.lit(f"</{tag}>"))
    return F.when(value == "", F.lit(f"{INDENT}<{tag}/>")).otherwise(full)


def document(values: list[tuple[str, Column]]) -> Column:
    """Elements in the order given, under a MetaObject root."""
    head = F.lit('<?xml version="1.0" ?>\n<MetaObject xmlns:xsi="http://www.w3.org/2001/XMLSchema-instance">')
    return F.concat_ws("\n", head, *[element(t, v) for t, v in values], F.lit("</MetaObject>"))


def tile_document(gds: Column, name: Column, d: dict[str, Column]) -> Column:
    """d: order_type, area, terrain_model, camera, crs, source_crs, commentary, custom_attribute, nodata, line_ids, times, first,
    stac, band_id, year and raster attributes (cell_size, block_size, width, height), all strings; band_id may be empty."""
    skip = lambda cond, value: F.when(cond, value)
    raster = F.lower(name).rlike(r"\.tiff?$")
    return document(
        [
            ("Auftragstyp", F.coalesce(d["order_type"], F.lit(""))),
            ("Area", d["area"]),
            ("TerrainModel", F.coalesce(d["terrain_model"], F.lit(""))),
            ("CameraSystem", F.coalesce(d["camera"], F.lit(""))),
            ("CoordinateReferenceSystem", F.coalesce(d["crs"], d["source_crs"], F.lit(""))),
            ("Commentary", F.coalesce(d["commentary"], d["custom_attribute"], F.lit(""))),
            ("NoData", skip(gds != "SB_DSM_PUNKTWOLKE", F.coalesce(d["nodata"], F.lit("")))),
            ("LineID", d["line_ids"]),
            ("AcquisitionTimes", d["times"]),
            ("FirstAcquisitionTime", d["first"]),
            ("StacItemIdDatetime", d["stac"]),
            ("BandID", skip(d["band_id"] != "", d["band_id"])),
            ("CellSize", skip(raster, d["cell_size"])),
            ("BlockSize", skip(raster, d["block_size"])),
            ("Width", skip(raster, d["width"])),
            ("Height", skip(raster, d["height"])),
            ("Year", skip(F.lower(name).endswith(".laz"), d["year"])),
        ]
    )
