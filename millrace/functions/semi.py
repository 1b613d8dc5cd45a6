"""Semi-structured values: JSON text, variants, maps and parallel arrays."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Without these, JSON text keeps only milliseconds.
JSON_TIMES = {
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}

# The shape of a city document.
HOURLY_DOCUMENT = (
    "map<string, struct<hourly: struct<"
    "time: array<string>, temperature_2m: array<double>, precipitation: array<double>, "
    "windspeed_10m: array<double>, relativehumidity_2m: array<double>>>>"
)


def parse(text: Column, tolerant: bool = False) -> Column:
    """JSON text as a variant; broken text raises, or becomes null when tolerant."""
    return F.try_parse_json(text) if tolerant else F.parse_json(text)


def at(value: Column, path: str, kind: str, tolerant: bool = False) -> Column:
    """Value at a path such as ``$.base``, cast to the given type."""
    return F.try_variant_get(value, path, kind) if tolerant else F.variant_get(value, path, kind)


def flatten_object(df: DataFrame, text: str, path: str, value_type: str, key: str = "key", value: str = "value") -> DataFrame:
    """One row per member of the JSON object at ``path``; rows without that object disappear."""
    members = F.from_json(F.get_json_object(F.col(text), path), f"map<string,{value_type}>")
    keep = [F.col(c) for c in df.columns]
    return df.select(*keep, F.explode(members).alias(key, value))


def flatten_variant(df: DataFrame, variant: str, path: str, value_type: str, key: str = "key", value: str = "value") -> DataFrame:
    """As ``flatten_object`` for a variant column."""
    members = F.variant_get(F.col(variant), path, f"map<string,{value_type}>")
    keep = [F.col(c) for c in df.columns]
    return df.select(*keep, F.explode(members).alias(key, value))


def flatten_members(df: DataFrame, variant: str, path: str = "$", outer: bool = False) -> DataFrame:
    """The frame's columns with ``pos``, ``key`` and ``value``, a row per member of the object (or element of the array, whose
    key is null) at ``path``.

    Values stay variants, so members may be of any types, nested ones too; a member that is JSON null is a row whose value is
    the variant null. Rows without members, where the place is missing, null, empty or a plain value, disappear, or stay once
    with nulls if ``outer``.
    """
    tables, value = df.sparkSession.tvf, F.try_variant_get(F.col(variant).outer(), path, "variant")
    return df.lateralJoin(tables.variant_explode_outer(value) if outer else tables.variant_explode(value))


def _read(text: str, schema: str, tolerant: bool) -> Column:
    """Typed JSON text; unreadable text raises, or becomes null when tolerant."""
    return F.from_json(F.col(text), schema, {"mode": "PERMISSIVE" if tolerant else "FAILFAST"})


def items(df: DataFrame, text: str, schema: str, tolerant: bool = False) -> DataFrame:
    """One row per record of JSON text that holds either one object or an array of them; none for null text.

    ``from_json`` reads a lone object as an array of one when asked for an array. Unreadable text raises; when tolerant it
    comes back as one row of nulls beside its text.
    """
    keep = [F.col(c) for c in df.columns]
    records = _read(text, f"array<struct<{schema}>>", tolerant)
    if tolerant:
        lost = F.array(F.from_json(F.lit("{}"), f"struct<{schema}>"))
        records = F.when(F.col(text).isNotNull(), F.coalesce(records, lost))
    return df.select(*keep, F.inline(records))


def hourly_rows(df: DataFrame, text: str) -> DataFrame:
    """City documents with parallel hourly arrays, as one row per city and hour; an unreadable document raises."""
    cities = df.select(F.explode(_read(text, HOURLY_DOCUMENT, False)).alias("city", "payload"))
    hourly = F.col("payload.hourly")
    zipped = F.arrays_zip(
        hourly["time"].alias("time"),
        hourly["temperature_2m"].alias("temperature"),
        hourly["precipitation"].alias("precipitation"),
        hourly["windspeed_10m"].alias("windspeed"),
        hourly["relativehumidity_2m"].alias("humidity"),
    )
    rows = cities.select("city", F.inline(zipped))
    return rows.select(
        "city", F.col("time").cast("timestamp_ntz").alias("datetime"), "temperature", "precipitation", "windspeed", "humidity"
    )


def row_json(*columns: Column | str) -> Column:
    """The columns as one JSON text, times with microseconds."""
    return F.to_json(F.struct(*columns), JSON_TIMES)


def as_json(df: DataFrame, name: str = "value") -> DataFrame:
    """Each row as one JSON text column."""
    return df.select(row_json(*df.columns).alias(name))
