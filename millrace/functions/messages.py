"""JSON messages as columns.

``json_object`` decodes a message once into ``map<string,variant>``; the other
functions read from that map. A map can tell a missing key from a null value,
which a struct cannot.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from millrace.functions.columns import as_col

# Producers send bare field names and single quotes; both are accepted.
JSON_OPTIONS = {"allowUnquotedFieldNames": "true", "allowSingleQuotes": "true"}

_CORRUPT = "_corrupt_record"
_LONG_MIN, _LONG_MAX = -(2**63), 2**63 - 1


def json_object(message: str | Column, strict: bool = False) -> Column:
    """The whole object, every value kept as it came; of a field given twice the last
    counts. Unparsable text gives null, or fails the job when ``strict``."""
    options = {**JSON_OPTIONS, "mode": "FAILFAST"} if strict else JSON_OPTIONS
    decoded = F.from_json(as_col(message), "map<string,variant>", options)
    # the lambda's variable stands for the message decoded once
    return F.get(F.transform(F.array(decoded), _last_values), 0)


def _last_values(fields: Column) -> Column:
    names = F.map_keys(fields)
    entries = F.map_entries(fields)

    def is_last(entry: Column, index: Column) -> Column:
        return ~F.array_contains(F.slice(names, index + 2, F.size(names)), entry["key"])

    last = F.map_from_entries(F.filter(entries, is_last))
    return F.when(fields.isNull() | (F.size(F.array_distinct(names)) == F.size(names)), fields).otherwise(last)


def decode_once(df: DataFrame, decoded: Column, name: str, *keep: str) -> DataFrame:
    """``df`` with the decoded message as column ``name``.

    It is passed through a one-element ``explode``, which Spark does not push
    filters past. A plain projection would be decoded again in every filter on it.
    """
    return df.select(*keep, F.explode(F.array(decoded)).alias(name))


def json_field(message: str | Column, name: str, dtype: str = "string") -> Column:
    """One field by name; only that field is decoded."""
    schema = T.StructType([T.StructField(name, T.StringType())])
    return F.from_json(as_col(message), schema, JSON_OPTIONS)[name].cast(dtype)


def has_key(fields: Column, name: str) -> Column:
    """Key presence, true for a key whose value is null."""
    return F.map_contains_key(fields, name)


def put_field(fields: Column, name: str, value: Column) -> Column:
    """``fields`` with ``name`` set; an existing value is replaced."""
    others = F.map_filter(fields, lambda key, _: key != name)
    return F.map_concat(others, F.create_map(F.lit(name), value.cast("variant")))


def json_text(fields: Column) -> Column:
    """The object as JSON text, leaving out its null fields. Values within a field are
    kept as they came, nulls included."""
    return F.to_json(
        F.map_filter(fields, lambda _, v: v.isNotNull() & ~F.is_variant_null(v))
    )


def as_long(value: Column) -> Column:
    """A 64-bit value with lenient coercion.

    Numbers are truncated and numeric text is parsed; other values give 0. A
    missing field stays null.
    """
    real = value.try_cast("double")
    wide = (
        F.when(real >= float(_LONG_MAX), F.lit(_LONG_MAX))
        .when(real <= float(_LONG_MIN), F.lit(_LONG_MIN))
        .otherwise(real.try_cast("bigint"))
    )
    return F.when(
        value.isNotNull(), F.coalesce(value.try_cast("bigint"), wide, F.lit(0).cast("bigint"))
    )


def raw_text(value: Column) -> Column:
    """The value as JSON text: a string keeps its quotes, null reads ``null``."""
    return F.to_json(value)


def typed_rows(
    df: DataFrame, message: str, schema: str | T.StructType, *keep: str, lenient: bool = False
) -> DataFrame:
    """Decode ``message`` into the columns of ``schema``.

    Missing fields are null and numeric text fits numeric fields. Arrays, structs and
    maps are decoded with their own types. Bad input fails the job, unless ``lenient``:
    then unparsable records are left out and a field of the wrong type is null (a nested
    one: its record is left out).
    """
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    nested = (T.ArrayType, T.StructType, T.MapType, T.VariantType)
    as_text = T.StructType([
        T.StructField(f.name, f.dataType if isinstance(f.dataType, nested) else T.StringType()) for f in schema
    ])
    options = dict(JSON_OPTIONS)
    if lenient:
        as_text = as_text.add(_CORRUPT, T.StringType())
        options["columnNameOfCorruptRecord"] = _CORRUPT
    else:
        options["mode"] = "FAILFAST"
    decoded = decode_once(df, F.from_json(message, as_text, options), "_m", *keep)
    if lenient:
        decoded = decoded.where(F.col("_m").isNotNull() & F.col(f"_m.{_CORRUPT}").isNull())

    def field(f: T.StructField) -> Column:
        text = F.col("_m")[f.name]
        if isinstance(f.dataType, nested):
            return text.alias(f.name)
        cast = text.try_cast(f.dataType) if lenient else text.cast(f.dataType)
        return cast.alias(f.name)

    return decoded.select(*keep, *[field(f) for f in schema])
