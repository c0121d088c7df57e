"""File sources: manifests with and without checksums, package XML."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import ranged


def manifest(spark: SparkSession, path: str, extensions: tuple[str, ...], recursive: bool = False) -> DataFrame:
    """path, name, length, modified of files with these extensions, by name. Contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", recursive).load(path)
    name = F.element_at(F.split("path", "/"), -1)
    ext = F.lower(F.regexp_extract(name, r"(\.[^.]*)$", 1))
    kept = files.filter(ext.isin(*extensions)).select("path", name.alias("name"), "length", F.col("modificationTime").alias("modified"))
    return kept.orderBy("name", "path")


def checksums(spark: SparkSession, path: str, recursive: bool = False, **options) -> DataFrame:
    """path, name, length, md5 of files of any size, which are read in chunks. options: those of ``ranged``."""
    return ranged.scan(spark, path, checksum=True, recursive=recursive, **options).select("path", "name", "length", "md5")


def compare_copies(source: DataFrame, target: DataFrame) -> DataFrame:
    """name, ok, problem of manifests (name, length, md5) before and after a copy."""
    t = target.select("name", F.col("length").alias("t_length"), F.col("md5").alias("t_md5"))
    joined = source.select("name", "length", "md5").join(t, "name", "left")
    problem = (
        F.when(F.col("t_length").isNull(), "missing")
        .when(F.col("t_length") != F.col("length"), "size")
        .when(F.col("t_md5") != F.col("md5"), "checksum")
    )
    return joined.select("name", problem.isNull().alias("ok"), problem.alias("problem"))


def package_documents(files: DataFrame) -> DataFrame:
    """Of files (catalog, package, path, ..) the XML in NV or one folder deeper, with its depth (1 or 2)."""
    depth = F.size(F.split(F.regexp_extract("path", r"(?i)/NV/(.*)$", 1), "/"))
    return files.filter(F.lower(F.col("path")).endswith(".xml") & F.col("path").rlike("(?i)/NV/")).withColumn("depth", depth).filter("depth <= 2")


def package_xml(files: DataFrame) -> DataFrame:
    """Of files (catalog, package, path, xml): per package the first XML in NV or one folder deeper, with its values.

    Folders are walked by name; files of NV itself come before its folders. XML without a root gives unreadable.
    """
    rank = F.row_number().over(Window.partitionBy("catalog", "package").orderBy("depth", "path"))
    first = package_documents(files).withColumn("_rank", rank).filter("_rank = 1").drop("_rank", "depth")
    value = lambda tag: F.trim(F.regexp_extract("xml", f"<{tag}>([^<]*)</{tag}>", 1))
    return first.select(
        "catalog", "package", "path", (~F.col("xml").rlike(r"</MetaObject>\s*$")).alias("unreadable"),
        F.concat_ws("-", value("Auftragstyp"), value("StacItemIdDatetime")).alias("item"), value("Area").alias("area"),
    )


def catalog_items(spark: SparkSession, path: str) -> DataFrame:
    """item, assets (map), updated from a snapshot of catalog items in JSON."""
    schema = "id string, assets map<string, struct<href: string>>, properties struct<updated: string>"
    raw = spark.read.schema(schema).json(path, multiLine=True)
    return raw.select(F.col("id").alias("item"), F.transform_values("assets", lambda _, v: v["href"]).alias("assets"), F.col("properties.updated").alias("updated"))
