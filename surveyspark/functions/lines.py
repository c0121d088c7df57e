"""Flight-line ids: parsing, times, keys and bands. All are Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from surveyspark.rules import DMC

ADS_PATTERN = r"^[0-9]{8}_[0-9]{4}_[0-9]{5}$"
DMC_PATTERN = r"^([0-9]{8})_([0-9]{4})_([0-9]{5})_([0-9]{3})_([0-9]{6})$"
TIME_FIELDS = ("year", "month", "day", "hh", "mm", "ss", "hundredths")


def is_dmc(camera: Column) -> Column:
    return F.coalesce(camera == DMC, F.lit(False))


def is_valid(line_id: Column, camera: Column) -> Column:
    ok = F.when(is_dmc(camera), line_id.rlike(DMC_PATTERN)).otherwise(line_id.rlike(ADS_PATTERN))
    return F.coalesce(ok, F.lit(False))


def parse_line_id(line_id: Column) -> Column:
    """Struct of year .. hundredths; null if date or time is no number. Milliseconds round half-even and stay below 100."""
    date, time = F.try_element_at(F.split(line_id, "_"), F.lit(1)), F.try_element_at(F.split(line_id, "_"), F.lit(2))
    part = lambda c, at, n: F.substring(c, at, n).try_cast("int")
    rest = F.length(time) - 4
    ss = F.when(rest >= 2, part(time, 5, 2)).otherwise(0)
    hundredths = (
        F.when(rest == 4, part(time, 7, 2))
        .when(rest == 5, F.least(F.bround(part(time, 7, 3) / 10).cast("int"), F.lit(99)))
        .otherwise(0)
    )
    fields = F.struct(
        part(date, 1, 4).alias("year"), part(date, 5, 2).alias("month"), part(date, 7, 2).alias("day"),
        part(time, 1, 2).alias("hh"), part(time, 3, 2).alias("mm"), ss.alias("ss"), hundredths.alias("hundredths"),
    )
    numbers = date.rlike("^[0-9]{7,}$") & time.rlike("^[0-9]{3,}$")
    return F.when(numbers, fields)


def dmc_fields(line_id: Column) -> Column:
    names = ("date", "group", "serial", "line_no", "hhmmss")
    return F.when(
        line_id.rlike(DMC_PATTERN),
        F.struct(*[F.regexp_extract(line_id, DMC_PATTERN, i).alias(n) for i, n in enumerate(names, 1)]),
    )


def dmc_acquisition(line_id: Column) -> Column:
    p = dmc_fields(line_id)
    cut = lambda c, at, n: F.substring(c, at, n).cast("int")
    return F.when(
        p.isNotNull(),
        F.struct(
            cut(p["date"], 1, 4).alias("year"), cut(p["date"], 5, 2).alias("month"), cut(p["date"], 7, 2).alias("day"),
            cut(p["hhmmss"], 1, 2).alias("hh"), cut(p["hhmmss"], 3, 2).alias("mm"), cut(p["hhmmss"], 5, 2).alias("ss"),
            F.lit(0).alias("hundredths"),
        ),
    )


def iso8601(t: Column) -> Column:
    """YYYY-MM-DDTHH:MM:SS.ss, UNKNOWN for null."""
    text = F.format_string("%04d-%02d-%02dT%02d:%02d:%02d.%02d", *[t[f] for f in TIME_FIELDS])
    return F.when(t.isNull(), "UNKNOWN").otherwise(text)


def stac_time(t: Column) -> Column:
    """YYYY-MM-DDtHHMMSSss, UNKNOWN for null."""
    text = F.format_string("%04d-%02d-%02dt%02d%02d%02d%02d", *[t[f] for f in TIME_FIELDS])
    return F.when(t.isNull(), "UNKNOWN").otherwise(text)


def acquisition(line_id: Column, camera: Column) -> Column:
    return F.when(is_dmc(camera), dmc_acquisition(line_id)).otherwise(parse_line_id(line_id))


def area_key(line_id: Column, camera: Column) -> Column:
    p = dmc_fields(line_id)
    return F.when(is_dmc(camera), F.concat_ws("_", p["date"], p["group"], p["serial"]))


def sort_key(line_id: Column, camera: Column) -> Column:
    """Chronological order: date, start, then line number or id."""
    p = dmc_fields(line_id)
    return F.when(is_dmc(camera), F.struct(p["date"].alias("d"), p["hhmmss"].alias("t"), p["line_no"].alias("n"))).otherwise(
        F.struct(F.substring(line_id, 1, 8).alias("d"), F.substring(line_id, 10, 4).alias("t"), line_id.alias("n"))
    )


def band_id(line_id: Column, camera: Column) -> Column:
    """HHMM of the line's start; empty for short ADS ids."""
    ads = F.when(F.length(line_id) >= 13, F.substring(line_id, 10, 4)).otherwise("")
    return F.when(is_dmc(camera), F.substring(dmc_fields(line_id)["hhmmss"], 1, 4)).otherwise(ads)


def delivery_stac_time(line_ids: Column, camera: Column) -> Column:
    """Of a delivery's first line: ADS the first as given, by the minute; DMC the earliest. A dash if it is invalid."""
    first = F.try_element_at(line_ids, F.lit(1))
    ads = F.concat_ws(
        "", F.substring(first, 1, 4), F.lit("-"), F.substring(first, 5, 2), F.lit("-"), F.substring(first, 7, 2), F.lit("t"),
        F.substring(first, 10, 4), F.lit("0000"),
    )
    groups = F.array_distinct(F.transform(line_ids, lambda x: area_key(x, F.lit(DMC))))
    ok = F.forall(line_ids, lambda x: x.rlike(DMC_PATTERN)) & (F.size(groups) == 1)
    earliest = F.element_at(F.array_sort(F.transform(line_ids, lambda x: F.struct(sort_key(x, F.lit(DMC)).alias("k"), x.alias("id")))), 1)["id"]
    dmc = F.when(ok, stac_time(dmc_acquisition(earliest)))
    out = F.when(is_dmc(camera), dmc).otherwise(F.when(F.length(first) >= 13, ads))
    return F.coalesce(out, F.lit("—"))


def item_id(order_type: Column, stac: Column) -> Column:
    return F.concat_ws("-", order_type, stac)


def item_id_valid(item: Column) -> Column:
    return F.coalesce(item.rlike(r"^[a-z]{3}-[0-9]{4}-[0-9]{2}-[0-9]{2}t[0-9]{8}$"), F.lit(False))


def order_code(label: Column) -> Column:
    return F.substring_index(label, " - ", 1)
