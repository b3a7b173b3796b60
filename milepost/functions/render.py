"""Rendering of values for flat exports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from milepost.functions.jsontext import to_json_text


def render_list(c: Column, element: T.DataType) -> Column:
    """Scalars joined by ``;`` (a null item is empty), lists of nested values as compact JSON."""
    if isinstance(element, (T.StructType, T.ArrayType, T.MapType)):
        text = to_json_text(c)
        return F.when(F.size(c) == 0, F.lit("")).otherwise(text)
    return F.array_join(c.cast(T.ArrayType(T.StringType())), ";", "")


def render_json_list(c: Column) -> Column:
    """The same for a JSON array held as text; text that is no array is passed through."""
    items = F.from_json(c, "array<string>")
    is_list = F.ltrim(c).startswith("[")
    nested = F.exists(items, lambda x: x.startswith("{") | x.startswith("["))
    joined = F.array_join(items, ";", "")
    return (
        F.when(c.isNull(), F.lit(""))
        .when(~is_list, c)
        .when(nested, F.to_json(F.try_parse_json(c)))
        .otherwise(joined)
    )


def flatten_columns(schema: T.StructType, prefix: tuple[str, ...] = (), sep: str = ".") -> list:
    """Select list that turns nested structs into columns named by their path."""
    out = []
    for field in schema.fields:
        path = prefix + (field.name,)
        if isinstance(field.dataType, T.StructType):
            out += flatten_columns(field.dataType, path, sep)
            continue
        c = F.col(".".join(f"`{p}`" for p in path))
        if isinstance(field.dataType, T.ArrayType):
            c = render_list(c, field.dataType.elementType)
        out.append(c.alias(sep.join(path)))
    return out


def flatten_struct(df: DataFrame, sep: str = ".") -> DataFrame:
    return df.select(*flatten_columns(df.schema, (), sep))


def csv_cell(c: Column, data_type: T.DataType) -> Column:
    """Text of one CSV cell: NULL is empty, nested values are JSON, times are ISO."""
    if isinstance(data_type, T.ArrayType):
        text = render_list(c, data_type.elementType)
    elif isinstance(data_type, (T.StructType, T.MapType)):
        text = to_json_text(c)
    elif isinstance(data_type, T.BooleanType):
        text = F.when(c, "True").when(~c, "False")
    elif isinstance(data_type, (T.TimestampType, T.TimestampNTZType)):
        micros = F.date_format(c, "SSSSSS") != "000000"
        text = F.when(micros, F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")).otherwise(
            F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss")
        )
    else:
        text = c.cast("string")
    return F.coalesce(text, F.lit(""))


def csv_cells(df: DataFrame) -> DataFrame:
    return df.select(
        *[csv_cell(F.col(f"`{f.name}`"), f.dataType).alias(f.name) for f in df.schema.fields]
    )
