"""Fixed lookup rules of the survey products, as literal tables. All are a few rows and broadcast."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

DMC = "Leica DMC-4"
ADS80 = "Leica ADS80"
ADS100 = "Leica ADS100"

# Product codes and their metadata texts.
PRODUCTS = ("SB_DOP", "SB_DOP_16", "SB_DSM", "SB_DSM_PUNKTWOLKE")
CUSTOM_ATTRIBUTE = {
    "SB_DOP": "Digital OrthoPhoto - Mosaic RGB 8BIT",
    "SB_DOP_16": "Digital OrthoPhoto - (ADS Line) NRGB 16BIT",
    "SB_DSM": "Digital Surface Model  - Raster Mosaic (DSM photogrammetric autocorrelation)",
    "SB_DSM_PUNKTWOLKE": "Digital Surface Model - PointCloud LAZ (DSM photogrammetric autocorrelation)",
}
CUSTOM_ATTRIBUTE_DMC = {
    "SB_DOP": "Digital OrthoPhoto - Mosaic RGBN 8BIT",
    "SB_DSM_PUNKTWOLKE": "Digital Surface Model - PointCloud LAZ RGB (DSM photogrammetric autocorrelation)",
}
ORDER_TYPES = ("kry", "ram", "bim", "mom", "wam")
TERRAIN_MODEL = "Digital Surface Model (DSM photogrammetric autocorrelation)"
SOURCE_REF_SYS = "(EPSG:2056) CH1903+ / LV95_LN02"
CAMERA_YEARS = ((2008, 2016, ADS80), (2017, 2025, ADS100), (2026, 9999, DMC))
NODATA = {
    "SB_DOP": ("0 0 0", "255 255 255"),
    "SB_DOP_16": ("0 0 0 0", "65535 65535 65535 65535"),
}
NODATA_DMC = {"SB_DOP": ("0 0 0 0",)}
ASSET_SUFFIXES = {
    "SB_DOP": ("rgb-mosaic.tif",),
    "SB_DOP_16": ("nrgb-16bit.tif",),
    "SB_DSM": ("dsm-raster.tif", "dsm-hillshade.tif"),
    "SB_DSM_PUNKTWOLKE": ("pointcloud.copc.laz",),
}
ASSET_SUFFIXES_DMC = {"SB_DOP": ("rgbn-mosaic.tif",)}
KEPT_EXTENSIONS = {
    "SB_DOP": (".tif", ".tiff", ".tfw"),
    "SB_DOP_16": (".tif", ".tiff", ".tfw"),
    "SB_DSM": (".tif", ".tiff", ".tfw"),
    "SB_DSM_PUNKTWOLKE": (".laz", ".ascii"),
}
# File-name grammars per product; for the ADS80 camera those of the second table come on top.
NAME_PATTERNS = {
    "SB_DOP": (r"(?i)^20[0-9]{2}_.+_DOP_.*[0-9]{4}_[0-9]{4}_LV95\.(tif|tiff|tfw)$",),
    "SB_DOP_16": (r"(?i)^20[0-9]{2}_.+_DOP_.*[0-9]{4}_[0-9]{4}_LV95\.(tif|tiff|tfw)$",),
    "SB_DSM": (
        r"(?i)^20[0-9]{2}_.+_DSM_.*_LV95_LN02\.(tif|tiff|tfw)$",
        r"(?i)^20[0-9]{2}_.+_hillshade_.*_LV95_LN02\.(tif|tiff)$",
    ),
    "SB_DSM_PUNKTWOLKE": (r"(?i)^20[0-9]{2}_.+_TIN_.*[0-9]{4}_[0-9]{4}_LV95_LN02\.laz$",),
}
NAME_PATTERNS_ADS80 = {
    "SB_DOP": (r"(?i)^20[0-9]{2}_.+_DOP_.*_LV95_.+\.(tif|tiff|tfw)$",),
    "SB_DOP_16": (r"(?i)^20[0-9]{2}_.+_DOP_.*_LV95_.+\.(tif|tiff|tfw)$",),
    "SB_DSM": (r"(?i)^20[0-9]{2}_.+_DSM_.*_LV95_LN02_.+\.(tif|tiff|tfw)$",),
    "SB_DSM_PUNKTWOLKE": (r"(?i)^20[0-9]{2}_.+?_(DSM|TIN)_.*\.(asc|ascii|xyz)$",),
}


def camera_years(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(CAMERA_YEARS), "first_year int, last_year int, camera string")


def name_rules(spark: SparkSession) -> DataFrame:
    """gds, camera (null: any), pattern."""
    rows = [(g, None, p) for g, ps in NAME_PATTERNS.items() for p in ps]
    rows += [(g, ADS80, p) for g, ps in NAME_PATTERNS_ADS80.items() for p in ps]
    return spark.createDataFrame(rows, "gds string, camera string, pattern string")


def products(spark: SparkSession) -> DataFrame:
    """gds, is_dmc, custom_attribute, asset_suffixes, nodata_options (null where the product has none)."""
    rows = []
    for g in PRODUCTS:
        for dmc in (False, True):
            over = {"a": CUSTOM_ATTRIBUTE_DMC, "s": ASSET_SUFFIXES_DMC, "n": NODATA_DMC} if dmc else {"a": {}, "s": {}, "n": {}}
            nodata = over["n"].get(g) or NODATA.get(g)
            rows.append(
                (g, dmc, over["a"].get(g, CUSTOM_ATTRIBUTE[g]), list(over["s"].get(g, ASSET_SUFFIXES[g])), list(nodata) if nodata else None)
            )
    return spark.createDataFrame(
        rows, "gds string, is_dmc boolean, custom_attribute string, asset_suffixes array<string>, nodata_options array<string>"
    )


def kept_extensions(spark: SparkSession) -> DataFrame:
    rows = [(g, e) for g, es in KEPT_EXTENSIONS.items() for e in es]
    return spark.createDataFrame(rows, "gds string, ext string")
