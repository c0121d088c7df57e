"""Conflicts of deliveries with the catalog and the waiting queue, and coordinate-system summaries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from surveyspark.functions import geo
from surveyspark.functions import lines as L


def asset_conflicts(deliveries: DataFrame, items: DataFrame, products: DataFrame) -> DataFrame:
    """deliveries (delivery, item, gds, is_dmc), items (item, assets map, updated), product rules (few, broadcast) ->
    delivery, item, status (new, free, exists, failed), conflict (sorted asset keys), updated."""
    rules = F.broadcast(products.select("gds", "is_dmc", "asset_suffixes"))
    wanted = F.transform("asset_suffixes", lambda s: F.concat_ws("-", F.col("item"), s))
    d = deliveries.join(rules, ["gds", "is_dmc"]).withColumn("wanted", wanted)
    known = items.select("item", F.map_keys("assets").alias("keys"), "updated", F.lit(True).alias("known"))
    j = d.join(known, "item", "left")
    valid = L.item_id_valid(F.col("item"))
    none = F.expr("CAST(array() AS array<string>)")
    conflict = F.when(valid & F.col("known"), F.array_sort(F.array_intersect("keys", "wanted"))).otherwise(none)
    status = F.when(~valid, "failed").when(F.col("known").isNull(), "new").when(F.size(conflict) > 0, "exists").otherwise("free")
    return j.select("delivery", "item", status.alias("status"), conflict.alias("conflict"), F.when(valid, F.col("updated")).alias("updated"))


def queue_conflicts(deliveries: DataFrame, packages: DataFrame) -> DataFrame:
    """deliveries (delivery, item, catalog, package), waiting packages (catalog, package, item, area, unreadable) ->
    delivery, status (ok, conflict), hits, areas. A delivery's own package and unreadable ones don't count; only a package of
    the same catalog conflicts."""
    p = packages.filter("NOT unreadable AND item IS NOT NULL AND package IS NOT NULL").select("item", "catalog", "package", "area")
    # packages are counted before they meet deliveries, so the work doesn't grow with the pairs of an item
    counted = p.groupBy("item", "catalog", "package", "area").agg(F.count("*").alias("n"))
    n = F.sum("n")
    own = counted.groupBy("item", "catalog", "package").agg(F.collect_list(F.struct("area", "n")).alias("own"), n.alias("own_n"))
    by_area = counted.groupBy("item", "area").agg(n.alias("n")).groupBy("item").agg(F.collect_list(F.struct("area", "n")).alias("areas"), n.alias("all_n"))
    by_catalog = counted.groupBy("item", "catalog").agg(n.alias("n")).groupBy("item").agg(F.collect_list(F.struct("catalog", "n")).alias("catalogs"))
    waiting = by_area.join(by_catalog, "item")
    j = deliveries.select("delivery", "item", "catalog", "package").join(own, ["item", "catalog", "package"], "left").join(waiting, "item", "left")
    own_n, none = F.coalesce("own_n", F.lit(0)), F.expr("CAST(array() AS array<string>)")
    # areas of the delivery's own package only
    gone = F.transform(F.filter("own", lambda x: F.array_contains("areas", x)), lambda x: x["area"])
    left = j.select(
        "delivery", (F.coalesce("all_n", F.lit(0)) - own_n).alias("hits"),
        F.exists(F.coalesce("catalogs", F.expr("CAST(array() AS array<struct<catalog: string, n: bigint>>)")), lambda x: F.coalesce((x["catalog"] == F.col("catalog")) & (x["n"] > own_n), F.lit(False))).alias("conflict"),
        F.array_except(F.transform("areas", lambda x: x["area"]), F.coalesce(gone, none)).alias("areas"),
    )
    out = left.groupBy("delivery").agg(
        F.bool_or("conflict").alias("conflict"), F.sum("hits").alias("hits"), F.array_join(F.array_sort(F.array_distinct(F.flatten(F.collect_list("areas")))), ",").alias("areas")
    )
    return out.select("delivery", F.when(F.col("conflict"), "conflict").otherwise("ok").alias("status"), "hits", "areas")


def queue_status(deliveries: DataFrame, packages: DataFrame, folders: DataFrame) -> DataFrame:
    """``queue_conflicts`` where some catalog folder exists in the delivery's bucket; failed elsewhere. deliveries: with bucket;
    folders (bucket, catalog)."""
    there = folders.select("bucket").distinct().withColumn("there", F.lit(True))
    j = queue_conflicts(deliveries, packages).join(deliveries.select("delivery", "bucket"), "delivery").join(there, "bucket", "left")
    return j.select("delivery", F.when(F.col("there"), F.col("status")).otherwise("failed").alias("status"), F.when(F.col("there"), F.col("hits")).otherwise(0).alias("hits"))


def crs_actions(files: DataFrame) -> DataFrame:
    """files (gds, name, info struct) of rasters -> gds, name, target, action, note; files without a target are left out."""
    target = geo.crs_target(F.col("gds"), F.col("name"))
    rasters = files.filter(F.lower("name").rlike(r"\.tiff?$")).withColumn("target", target).filter("target IS NOT NULL")
    a = geo.crs_file_action(F.col("gds"), F.col("info"), F.col("target"))
    return rasters.withColumn("a", a).select("gds", "name", "target", F.col("a.action").alias("action"), F.col("a.note").alias("note"))


def crs_summary(actions: DataFrame, by: str, force_lv95: bool = False) -> DataFrame:
    """Per delivery: counts by action and whether it must stop (any error, or a retag without consent)."""
    out = actions.groupBy(by).agg(*[F.count_if(F.col("action") == a).alias(a) for a in ("ok", "set", "warn", "retag", "error")])
    stop = (F.col("error") > 0) | ((F.col("retag") > 0) & F.lit(not force_lv95))
    return out.withColumn("stop", stop)


def status_summary(results: DataFrame, *by: str) -> DataFrame:
    """results (name, status) -> total, ok, warning, skipped, failed, and pf7 (with colour) where results have a ``format``.
    ``failures`` lists the failed files."""
    colour = [F.count_if((F.col("format") == 7) & (F.col("status") != "failed")).alias("pf7")] if "format" in results.columns else []
    one = lambda s: F.count_if(F.col("status") == s).alias(s)
    return results.groupBy(*by).agg(F.count("*").alias("total"), one("ok"), one("warning"), one("skipped"), one("failed"), *colour)


def failures(results: DataFrame, *by: str) -> DataFrame:
    """The failed files: a row each, as a long list has no place in a summary."""
    return results.filter("status = 'failed'").select(*by, "name")
