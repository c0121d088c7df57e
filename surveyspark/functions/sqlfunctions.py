"""The scalar rules as temporary SQL functions, from the same definitions that DataFrame code uses.

    register(spark)
    spark.sql("SELECT survey_tile_key(name) FROM files")

Each function of ``lines``, ``names``, ``geo`` and ``pixels`` whose parameters are columns becomes ``survey_<name>``: its column over
the parameters' names is written out as SQL and made the body of ``CREATE TEMPORARY FUNCTION``. The optimizer inlines these, so plans
hold built-in expressions only.
"""

from __future__ import annotations

import inspect
import re
from collections.abc import Callable
from types import ModuleType

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from . import geo, lines, names, pixels

MODULES = (lines, names, geo, pixels)
PREFIX = "survey_"
TIME = "STRUCT<year: INT, month: INT, day: INT, hh: INT, mm: INT, ss: INT, hundredths: INT>"
CRS = "STRUCT<has_crs: BOOLEAN, in_lv95_extent: BOOLEAN, name: STRING, is_compound: BOOLEAN, horizontal_is_lv95: BOOLEAN, lv95_equivalent: BOOLEAN, local_only: BOOLEAN, vertical_epsg: STRING>"
BAND, HITS = "ARRAY<INT>", "ARRAY<BOOLEAN>"
#: Types of parameters by name; what isn't here is a string.
TYPES = {
    **dict.fromkeys(("any_case", "dmc", "accept_local", "rgb", "keep_rgb"), "BOOLEAN"),
    **dict.fromkeys(("bands", "cols", "rows", "year", "width", "e_km", "n_km", "red", "green", "blue", "minor", "fmt", "encoding", "target_format"), "INT"),
    **dict.fromkeys(("minx", "maxx", "miny", "maxy", "minz", "maxz", "px_x", "px_y", "origin", "gsd", "offset"), "DOUBLE"),
    "t": TIME, "info": CRS, "gt": "ARRAY<DOUBLE>", "band": BAND, "mask": HITS, "hit": HITS, "shift": BAND, "line_ids": "ARRAY<STRING>", "parts": "ARRAY<STRING>",
    "run_list": "ARRAY<STRUCT<c0: INT, c1: INT>>", "components": "ARRAY<STRUCT<type: STRING, authority: STRING, code: STRING>>",
}
#: Where a name stands for another type in one function.
OWN = {
    ("full_float", "value"): "DOUBLE", ("requantised", "value"): "DOUBLE", ("already_migrated", "target"): "INT", ("nodata_mask", "bands"): "ARRAY<ARRAY<DOUBLE>>",
    ("nodata_mask", "nodata"): "ARRAY<DOUBLE>", ("fixed_dsm", "band"): "ARRAY<FLOAT>", ("n_false_nodata", "band"): "ARRAY<FLOAT>",
    **{("shadow_lifts", c): BAND for c in ("red", "green", "blue")},
}
#: Python parameters without a default that a function needs to become one of columns only.
FIXED = {"epsg_of": [{"kind": "VerticalCRS"}, {"kind": "ProjectedCRS"}], "rescale_table": [{"safe_max": 225}], "catalog_link": [{"host": "localhost", "host_int": "localhost"}]}
SUFFIX = {"epsg_of": ["vertical_epsg_of", "horizontal_epsg_of"]}


def sql_of(column: Column) -> str:
    """A column as SQL that can be parsed: operators are called by their quoted names, and decimals are doubles."""
    text = re.fullmatch(r"Column<'(.*)'>", str(column), re.S)[1]
    parts = re.split(r"('(?:[^'\\]|\\.|'')*')", text)  # string literals stay
    for i in range(0, len(parts), 2):
        part = re.sub(r"(?<![\w`])(<=>|[<>!=]=|[-+*/%<>=!&|^~]|and|or|not|in)\(", r"`\1`(", parts[i])
        parts[i] = re.sub(r"(?<![\w.])(\d+\.\d+(?:E[+-]?\d+)?)(?![\w.])", r"\1D", part)
    return "".join(parts)


def scalars() -> dict[str, tuple[Callable, dict]]:
    """SQL name -> function and its fixed arguments."""
    out = {}
    for module in MODULES:
        for name, f in inspect.getmembers(module, inspect.isfunction):
            if f.__module__ != module.__name__ or name.startswith("_") or inspect.signature(f).return_annotation != "Column":
                continue
            for k, fixed in enumerate(FIXED.get(name, [{}])):
                out[PREFIX + SUFFIX.get(name, [name])[k]] = (f, fixed)
    return out


def definition(name: str, f: Callable, fixed: dict) -> str:
    taken = [p.name for p in inspect.signature(f).parameters.values() if p.annotation == "Column"]
    given = ", ".join(f"`{p}` {OWN.get((f.__name__, p), TYPES.get(p, 'STRING'))}" for p in taken)
    return f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({given}) RETURN {sql_of(f(*[F.col(p) for p in taken], **fixed))}"


def register(spark: SparkSession, hosts: tuple[str, str] = ("localhost", "localhost")) -> list[str]:
    """Make all scalars SQL functions of this session. hosts: those of catalog links (usual, integration). Returns their names."""
    for name, (f, fixed) in scalars().items():
        own: ModuleType | dict = {"host": hosts[0], "host_int": hosts[1]} if f is names.catalog_link else fixed
        spark.sql(definition(name, f, own))
    return sorted(scalars())
