"""File names, keys and loose numbers as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


#: A device is named by letters and digits; the callers below take another pattern.
DEVICE = r"[A-Za-z]+\d+"


def pair_key(name: Column, prefix: str, device: str = DEVICE) -> Column:
    """DEVICE_rest of `PREFIX_DEVICE_rest.txt`; null where it doesn't match or the name says realtime."""
    pattern = rf"(?i)^{prefix}_({device}?)_(.+)\.txt$"
    key = F.concat_ws("_", F.regexp_extract(name, pattern, 1), F.regexp_extract(name, pattern, 2))
    return F.when((F.regexp_extract(name, pattern, 0) != "") & ~F.lower(name).contains("realtime"), key)


def file_key(name: Column, device: str = DEVICE) -> Column:
    got = F.regexp_extract(name, rf"({device}_\d{{8}})", 1)
    return F.when(got != "", got)


def base_name(stem: Column) -> Column:
    """Without its `_segN`."""
    return F.regexp_replace(stem, r"_seg\d+$", "")


def device_of(name: Column) -> Column:
    """Last two of the three digits behind a device's letters."""
    got = F.regexp_extract(name, r"[A-Za-z]\d(\d{2})(?:\D|$)", 1)
    return F.when(got != "", got)


def normalize_device(raw: Column, letters: str) -> Column:
    """23, or any name that ends with it -> LETTERS023."""
    digits = F.regexp_extract(F.trim(raw), r"(\d+)$", 1)
    return F.when(digits != "", F.concat(F.lit(letters), F.lpad(digits, 3, "0")))


def loose_double(raw: Column) -> Column:
    """Numbers with a decimal comma or point; null where it is none."""
    return F.replace(F.trim(raw), F.lit(","), F.lit(".")).try_cast("double")


def clean_double(raw: Column) -> Column:
    """try_cast to double, NaN as null."""
    value = raw.try_cast("double")
    return F.when(~F.isnan(value), value)


def tile_of(name: Column) -> tuple[Column, Column]:
    pattern = r"_(\d+)-(\d+)(?:_|\.la[sz]$)"
    x, y = F.regexp_extract(name, pattern, 1), F.regexp_extract(name, pattern, 2)
    return F.when(x != "", x.try_cast("int")), F.when(y != "", y.try_cast("int"))


def normalize_tile_name(raw: Column) -> Column:
    """Upper case, hyphens for underscores, ending in .LAZ."""
    return F.concat(F.regexp_replace(F.upper(F.replace(F.trim(raw), F.lit("_"), F.lit("-"))), r"\.LA[SZ]$", ""), F.lit(".LAZ"))


def tile_variants(raw: Column) -> Column:
    """Sorted names under which a tile may lie on disk: as given, and with .LAZ in either case and either separator; empty for none."""
    name = F.trim(raw)
    full = F.concat(F.regexp_replace(F.upper(name), r"\.LA[SZ]$", ""), F.lit(".LAZ"))
    low, high = F.replace(full, F.lit("-"), F.lit("_")), F.replace(full, F.lit("_"), F.lit("-"))
    return F.when(name != "", F.array_sort(F.array_distinct(F.array(name, *[f for v in (full, low, high) for f in (v, F.lower(v))])))).otherwise(F.array().cast("array<string>"))


def disposition_file(header: Column) -> Column:
    """File name of a Content-Disposition header, the extended form first; null where it names none."""
    wide, plain = F.regexp_extract(header, r"(?i)filename\*=UTF-8''([^;]+)", 1), F.regexp_extract(header, r"(?i)filename=([^;]+)", 1)
    return F.nullif(F.regexp_replace(F.trim(F.when(wide != "", wide).otherwise(plain)), r'^"+|"+$', ""), F.lit(""))


def linestring(wkt: Column) -> Column:
    """array<struct<lon, lat>> of a LINESTRING; null for anything else."""
    inner = F.regexp_extract(wkt, r"(?i)LINESTRING\s*\(([^)]*)\)", 1)
    points = F.transform(F.split(inner, ","), lambda p: F.split(F.trim(p), r"\s+"))
    coords = F.transform(points, lambda p: F.struct(F.get(p, F.lit(0)).try_cast("double").alias("lon"), F.get(p, F.lit(1)).try_cast("double").alias("lat")))
    return F.when(inner != "", coords)
