"""Deliveries: lines of a delivery in order, their fields, and what is wrong with them."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from surveyspark.functions import lines as L
from surveyspark.rules import ADS80


def normalize(lines: DataFrame) -> DataFrame:
    """delivery, camera, ord, line_id -> distinct valid ids in chronological order with their rank.

    The first of equal ids stays. Lines of a DMC delivery that belong to another group than its first line are left out;
    ``foreign_lines`` lists them.
    """
    valid = lines.filter(L.is_valid(F.col("line_id"), F.col("camera")))
    once = valid.groupBy("delivery", "camera", "line_id").agg(F.min("ord").alias("ord"))
    keyed = once.withColumns({"area_key": L.area_key(F.col("line_id"), F.col("camera")), "k": L.sort_key(F.col("line_id"), F.col("camera"))})
    first = F.first("area_key").over(Window.partitionBy("delivery").orderBy("ord"))
    kept = keyed.withColumn("expected", first).filter(F.col("area_key").eqNullSafe(F.col("expected")))
    rank = F.row_number().over(Window.partitionBy("delivery").orderBy("k"))
    return kept.select("delivery", "camera", "line_id", "area_key", rank.alias("pos"))


def foreign_lines(lines: DataFrame) -> DataFrame:
    """delivery, expected, n_foreign, foreign: DMC lines of another group than the first one's, in input order."""
    dmc = lines.filter(L.is_dmc(F.col("camera")) & L.is_valid(F.col("line_id"), F.col("camera")))
    keyed = dmc.withColumn("area_key", L.area_key(F.col("line_id"), F.col("camera")))
    expected = F.first("area_key").over(Window.partitionBy("delivery").orderBy("ord"))
    odd = keyed.withColumn("expected", expected).filter("area_key <> expected")
    return odd.groupBy("delivery", "expected").agg(
        F.count("*").alias("n_foreign"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("ord", "line_id"))), lambda x: x["line_id"]), ",").alias("foreign"),
    )


def delivery_fields(lines: DataFrame) -> DataFrame:
    """One row per delivery: line_ids, acquisition_times, first_acquisition, stac_time, band_id, year.

    DMC lines are normalised; ADS lines stay as they were entered, in input order.
    """
    dmc = normalize(lines.filter(L.is_dmc(F.col("camera")))).select("delivery", "camera", "line_id", F.col("pos").alias("ord"))
    ads = lines.filter(~L.is_dmc(F.col("camera"))).select("delivery", "camera", "line_id", F.col("ord"))
    each = ads.unionByName(dmc).withColumn("t", L.acquisition(F.col("line_id"), F.col("camera")))
    each = each.withColumns(
        {"iso": L.iso8601(F.col("t")), "stac": L.stac_time(F.col("t")), "band": L.band_id(F.col("line_id"), F.col("camera"))}
    )
    sorted_rows = F.array_sort(F.collect_list(F.struct("ord", "line_id", "iso", "stac", "band")))
    rows = each.groupBy("delivery", "camera").agg(sorted_rows.alias("r"))
    part = lambda f: F.array_join(F.transform("r", lambda x: x[f]), ",")
    return rows.select(
        "delivery", "camera", part("line_id").alias("line_ids"), part("iso").alias("acquisition_times"),
        F.col("r")[0]["iso"].alias("first_acquisition"), F.col("r")[0]["stac"].alias("stac_time"),
        F.col("r")[0]["band"].alias("band_id"), F.substring(F.col("r")[0]["line_id"], 1, 4).alias("year"),
    )


def validate(deliveries: DataFrame, products: DataFrame) -> DataFrame:
    """delivery rows (delivery, gds, camera, line_ids, nodata, area, year, has_ascii, has_laz, has_grid) with ``errors``.

    products: the lookup rules (a handful of rows, broadcast).
    """
    rules = F.broadcast(products.select("gds", "is_dmc", "nodata_options"))
    d = deliveries.withColumn("is_dmc", L.is_dmc(F.col("camera"))).join(rules, ["gds", "is_dmc"], "left")
    bad = F.size(F.filter("line_ids", lambda x: ~L.is_valid(x, F.col("camera"))))
    checks = [
        ((F.col("gds") == "SB_DOP_16") & F.col("is_dmc"), "camera has no single lines"),
        (F.coalesce(F.size("line_ids"), F.lit(0)) <= 0, "no line id"),
        (bad > 0, "line id format"),
        (F.col("has_ascii") & F.col("has_laz"), "text and LAZ mixed"),
        ((F.col("camera") == ADS80) & (F.col("gds") != "SB_DSM") & ~F.col("has_grid"), "grid missing"),
        (F.col("nodata_options").isNotNull() & ~F.coalesce(F.array_contains("nodata_options", F.col("nodata")), F.lit(False)), "nodata value"),
        (~F.coalesce(F.col("area").rlike("^[A-Za-z0-9_.-]+$"), F.lit(False)), "area characters"),
        (~F.coalesce(F.col("year").rlike("^[0-9]{4}$"), F.lit(False)), "year"),
    ]
    errors = F.filter(F.array(*[F.when(c, m) for c, m in checks]), lambda x: x.isNotNull())
    return d.withColumn("errors", errors).drop("nodata_options")


def year_of_delivery(files: DataFrame) -> DataFrame:
    """files (delivery, path, name) -> delivery, year: of the first name that has one, else the right-most such folder."""
    from surveyspark.functions.names import year_of

    folders = F.filter(F.reverse(F.split("path", r"[/\\]")), lambda x: x.rlike("^20[0-9]{2}$"))
    f = files.select("delivery", "name", year_of(F.col("name")).alias("y"), F.get(folders, F.lit(0)).cast("int").alias("f"))
    return f.groupBy("delivery").agg(F.coalesce(F.min_by("y", F.when(F.col("y").isNotNull(), F.col("name"))), F.max("f")).alias("year"))


def with_product_texts(deliveries: DataFrame, products: DataFrame) -> DataFrame:
    """deliveries (gds, camera, ..) with the product's custom attribute for that camera."""
    rules = F.broadcast(products.select("gds", "is_dmc", "custom_attribute"))
    return deliveries.withColumn("is_dmc", L.is_dmc(F.col("camera"))).join(rules, ["gds", "is_dmc"], "left").drop("is_dmc")


def preview(documents: DataFrame) -> DataFrame:
    """documents (delivery, name, xml) -> the document of each delivery's first file."""
    return documents.groupBy("delivery").agg(F.min("name").alias("name"), F.min_by("xml", "name").alias("xml"))
