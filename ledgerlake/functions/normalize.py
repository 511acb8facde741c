"""Landed records to flat typed rows: names, nesting, temporal text, type inference and widening."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Words that are not column names by themselves.
RESERVED = (
    "key", "order", "group", "table", "index", "select", "where", "from",
    "join", "primary", "foreign", "default", "check", "values", "delete",
    "update", "insert", "create", "drop", "alter", "rank", "row",
)
MAX_NAME = 63
DATE, INSTANT = r"^\d{4}-\d{2}-\d{2}$", r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}"
DECIMAL, WIDE = T.DecimalType(18, 4), T.DecimalType(38, 10)


def column_name(name: str, lower: bool = False) -> str:
    """Other characters than letters, digits and underscores become one underscore a run; empty, digit-leading and reserved names are made safe; at most
    63 characters."""
    out = re.sub(r"[^0-9A-Za-z_]+", "_", name).strip("_") or "field"
    if out[0].isdigit():
        out = f"f_{out}"
    if out.lower() in RESERVED:
        out += "_field"
    return (out.lower() if lower else out)[:MAX_NAME]


def safe_name(value: Column) -> Column:
    """column_name for names that are data (keys of maps, entries of a dictionary table); null is taken for an empty name."""
    bare = F.btrim(F.regexp_replace(F.coalesce(value, F.lit("")), "[^0-9A-Za-z_]+", "_"), F.lit("_"))
    named = F.when(bare == "", "field").when(bare.rlike("^[0-9]"), F.concat(F.lit("f_"), bare)).otherwise(bare)
    return F.substring(F.when(F.lower(named).isin(*RESERVED), F.concat(named, F.lit("_field"))).otherwise(named), 1, MAX_NAME)


def table_name(feed: str, prefix: str = "t_") -> str:
    """Lower case, single underscores, without a trailing spreadsheet mark."""
    return prefix + re.sub(r"_excel$", "", re.sub(r"_+", "_", re.sub(r"[^0-9a-z]+", "_", feed.lower())).strip("_"))


def safe_table(feed: Column, prefix: str = "t_") -> Column:
    """table_name for names that are data."""
    bare = F.btrim(F.regexp_replace(F.lower(F.coalesce(feed, F.lit(""))), "[^0-9a-z]+", "_"), F.lit("_"))
    return F.concat(F.lit(prefix), F.btrim(F.regexp_replace(bare, "_excel$", ""), F.lit("_")))


def _leaves(schema: T.StructType, at: tuple[str, ...] = ()):
    for f in schema.fields:
        if f.name.startswith("@odata"):  # metadata, at every depth
            continue
        if isinstance(f.dataType, T.StructType):
            yield from _leaves(f.dataType, (*at, f.name))
        else:
            yield (*at, f.name), f.dataType


def flatten(df: DataFrame, lower: bool = False) -> DataFrame:
    """Structs to columns joined by `_`, arrays and maps to JSON text, metadata dropped. Of names that become alike the last wins."""
    out: dict[str, Column] = {}
    for path, kind in _leaves(df.schema):
        value = F.col(".".join(f"`{p}`" for p in path))
        name = column_name("_".join(path), lower)
        out.pop(name, None)
        out[name] = F.to_json(value) if isinstance(kind, (T.ArrayType, T.MapType)) else value
    return df.select(*[v.alias(k) for k, v in out.items()])


def temporal(value: Column) -> Column:
    """struct<day, instant, text> of a text: an ISO date or instant as what it says, anything else, days and times that don't exist among it, as the
    text it was. At most one of the three is set, and nothing is lost."""
    said = F.trim(value)
    day = F.when(said.rlike(DATE), said.try_cast("date"))
    instant = F.when(said.rlike(INSTANT), said.try_cast("timestamp"))
    return F.struct(day.alias("day"), instant.alias("instant"), F.when(day.isNull() & instant.isNull(), value).alias("text"))


def infer_types(df: DataFrame) -> DataFrame:
    """One row per column with the type that its values need: one pass of flags over all rows.

    A column's own type counts: only text is looked into, and only for dates and instants, so that codes of digits stay text with their zeros. Widest
    first: json (arrays, maps, structs), string, timestamp, date, decimal, bigint, boolean; string without any value."""
    seen = []
    for f in df.schema.fields:
        v = F.col(f"`{f.name}`")
        some = v.isNotNull()
        flags = dict.fromkeys(("json", "text", "time", "date", "num", "int", "bool"), F.lit(False))
        if isinstance(f.dataType, T.StringType):
            said = F.trim(v)
            is_time, is_date = said.rlike(INSTANT), said.rlike(DATE)
            flags |= {"time": is_time, "date": is_date, "text": ~(is_time | is_date)}
        else:
            kind = f.dataType
            nested, whole = isinstance(kind, (T.ArrayType, T.MapType, T.StructType)), isinstance(kind, T.IntegralType)
            name = "json" if nested else "bool" if isinstance(kind, T.BooleanType) else "int" if whole else "num" if isinstance(kind, T.NumericType) else "time" if isinstance(kind, T.TimestampType) else "date" if isinstance(kind, T.DateType) else "text"
            flags[name] = some
        seen.append(F.struct(F.lit(f.name).alias("column_name"), *[F.coalesce(F.bool_or(x), F.lit(False)).alias(k) for k, x in flags.items()]))
    rows = df.agg(F.array(*seen).alias("all")).select(F.explode("all").alias("f")).select("f.*")
    widest = {"json": "json", "text": "string", "time": "timestamp", "date": "date", "num": "decimal(18,4)", "int": "bigint", "bool": "boolean"}
    kind = F.coalesce(*[F.when(F.col(k), t) for k, t in widest.items()], F.lit("string"))
    return rows.select("column_name", kind.alias("type_name"))


def typed(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """df with its text columns cast to inferred temporal types; a text that doesn't fit stays behind as null there and whole in `rejects`."""
    cast = {c: t for c, t in types.items() if t in ("date", "timestamp") and isinstance(df.schema[c].dataType, T.StringType)}
    return df.withColumns({c: F.trim(F.col(f"`{c}`")).try_cast(t) for c, t in cast.items()}) if cast else df


BOOKKEEPING = ("_synced_at", "_raw_json")


def widen(stored: T.StructType, incoming: T.StructType, keys: tuple[str, ...] = ()) -> T.StructType:
    """The schema that holds both: new columns at the end, integers widen to decimals, anything else that differs to text; keys and bookkeeping stay."""
    have, out = {f.name: f.dataType for f in stored.fields}, []
    come = {f.name: f.dataType for f in incoming.fields}
    for name in dict.fromkeys([*have, *come]):
        a, b = have.get(name), come.get(name)
        if a is None or b is None or a == b or name in keys or name in BOOKKEEPING:
            kind = a or b
        elif {type(a), type(b)} <= {T.LongType, T.IntegerType}:
            kind = T.LongType()
        elif all(isinstance(x, (T.LongType, T.IntegerType, T.DecimalType)) for x in (a, b)):
            kind = WIDE
        else:
            kind = T.StringType()
        out.append(T.StructField(name, kind))
    return T.StructType(out)


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """df with the columns of schema: absent ones null, values that don't fit null (see rejects)."""
    return df.select(*[(F.col(f.name).try_cast(f.dataType) if f.name in df.columns else F.lit(None).cast(f.dataType)).alias(f.name) for f in schema.fields])


def rejects(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Rows with a value that its column's type can't hold, for the failed-batch sink."""
    bad = [F.col(f.name).isNotNull() & F.col(f.name).try_cast(f.dataType).isNull() for f in schema.fields if f.name in df.columns]
    out = F.lit(False)
    for b in bad:
        out = out | b
    return df.where(out)


def raw_copy(df: DataFrame, name: str = "_raw_json") -> DataFrame:
    return df.withColumn(name, F.to_json(F.struct("*")))


def blank_to_null(value: Column) -> Column:
    return F.nullif(F.trim(value), F.lit(""))
