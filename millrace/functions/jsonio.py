"""Rows to JSON text, JSON text to typed parts, and key handling inside nested records."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.spec import SourceSpec

_BROKEN = "_broken_text"
_SEP = "\x01"
DATES = (T.TimestampType, T.TimestampNTZType, T.DateType)


def json_key(value: Column | str, key: str = "pcn") -> Column:
    """The key field of a JSON message; null when the text is not JSON or has no such field."""
    return F.get_json_object(value, f"$.{key}")


def rows_to_json(
    df: DataFrame,
    fields: Sequence[str],
    key: Column | None = None,
    key_name: str = "pcn",
    out: str = "value",
    keep: Sequence[str] = (),
) -> DataFrame:
    """One flat JSON object per row, every value as text, the key first, fields in the given order.

    Nulls are written as empty text, the form a delimited file gives them.
    """
    members = [F.coalesce(F.col(f"`{f}`").cast("string"), F.lit("")).alias(f) for f in fields]
    if key is not None:
        members.insert(0, key.cast("string").alias(key_name))
    return df.select(*keep, F.to_json(F.struct(*members)).alias(out))


def _whole_number(text: Column, dtype: T.DataType) -> Column:
    """Whole numbers, also when written with a zero fraction ("67.0")."""
    plain = F.regexp_replace(text, r"^([^.eE]*)\.0*$", "$1")
    # Numbers with an exponent are rare and go through a decimal, which is exact as well.
    number = F.when(text.rlike("[eE]"), text.try_cast("decimal(38,10)"))
    whole = F.coalesce(plain.try_cast(dtype), F.when(number == F.floor(number), number.try_cast(dtype)))
    # Most numbers have neither; looking for three characters is cheaper than the expressions above.
    odd = reduce(or_, [F.contains(text, F.lit(c)) for c in ".eE"])
    return F.when(odd, whole).otherwise(text.try_cast(dtype))


def typed_value(text: Column, dtype: T.DataType, date_format: str) -> Column:
    if isinstance(dtype, T.StringType):
        return text
    if isinstance(dtype, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return _whole_number(text, dtype)
    if isinstance(dtype, T.TimestampType):
        return F.try_to_timestamp(text, F.lit(date_format))
    if isinstance(dtype, (T.TimestampNTZType, T.DateType)):
        return F.try_to_timestamp(text, F.lit(date_format)).cast(dtype)
    return text.try_cast(dtype)


def parse_typed(
    df: DataFrame,
    spec: SourceSpec,
    value: str = "value",
    out: str = "part",
    errors: str = "_errors",
    strict: bool = False,
) -> DataFrame:
    """Bind JSON text to the typed schema of its source.

    A field that cannot be read becomes null and its name goes to ``errors``. With ``strict`` one
    bad field makes the whole part null. Text that is not JSON gives a null part and ``["<json>"]``.
    """
    names = [f.name for f in spec.schema.fields]
    wire = spec.wire_schema.add(_BROKEN, T.StringType())
    raw, typed = F.col("_raw"), F.col("_typed")
    cells = [typed_value(raw[f.name], f.dataType, spec.date_format).alias(f.name) for f in spec.schema.fields]
    unread = F.concat_ws(
        _SEP, *[F.when(raw[n].isNotNull() & typed[n].isNull(), F.lit(n)) for n in names]
    )
    broken = F.col(value).isNotNull() & (raw.isNull() | raw[_BROKEN].isNotNull())
    bad = (
        F.when(broken, F.array(F.lit("<json>")))
        .when(F.col("_unread") == "", F.array().cast("array<string>"))
        .otherwise(F.split("_unread", _SEP))
    )
    usable = F.col(value).isNotNull() & ~broken
    if strict:
        usable = usable & (F.col("_unread") == "")
    # Each step is used more than once by the next, so Spark keeps them apart: one parse, one cast.
    return (
        df.withColumn("_raw", F.from_json(value, wire, {"columnNameOfCorruptRecord": _BROKEN}))
        .withColumn("_typed", F.struct(*cells))
        .withColumn("_unread", unread)
        .withColumns({errors: bad, out: F.when(usable, typed)})
        .drop("_raw", "_typed", "_unread")
    )


def _without_key(column: Column, dtype: T.DataType, key: str) -> Column:
    if isinstance(dtype, T.StructType):
        kept = [f for f in dtype.fields if f.name.lower() != key.lower()]
        if not kept:
            return F.lit(None).cast(T.StructType([]))
        rebuilt = F.struct(*[_without_key(column[f.name], f.dataType, key).alias(f.name) for f in kept])
        return F.when(column.isNotNull(), rebuilt)
    if isinstance(dtype, T.ArrayType):
        return F.transform(column, lambda item: _without_key(item, dtype.elementType, key))
    return column


def drop_nested_key(df: DataFrame, key: str = "pcn") -> DataFrame:
    """Remove the key (any case) from every nested part; the top-level key stays, once."""
    return df.select(
        *[
            _without_key(F.col(f.name), f.dataType, key).alias(f.name)
            if isinstance(f.dataType, (T.StructType, T.ArrayType))
            else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def dated_text(part: Column, spec: SourceSpec) -> Column:
    """The part with its dates written in the format of the source."""
    fields = [
        (F.date_format(part[f.name], spec.date_format) if isinstance(f.dataType, DATES) else part[f.name]).alias(f.name)
        for f in spec.schema.fields
    ]
    return F.when(part.isNotNull(), F.struct(*fields))


def part_json(df: DataFrame, columns: Sequence[str] | None = None, options: dict | None = None) -> Column:
    """The record as JSON text; null members are left out."""
    return F.to_json(F.struct(*(columns or df.columns)), options or {})
