"""Conform a DataFrame to the warehouse's column types (one ``select``).

Mapping: boolean → boolean; short, int, long → bigint; byte → one-byte
binary; double → double; float → error (or double with ``widen_float``);
decimal with scale ≤ 9 → unchanged (``decimal(38,9)`` with ``unify``);
wider decimal → tagged text; string, varchar, char → string; timestamp,
timestamp_ntz, date, binary → unchanged; struct → struct, field by field;
map<k,v> → array<struct<Key: k, value: v>>; array of a supported type →
array. Array of array, array of map, interval, null and user types raise.
Every field becomes nullable.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import quote_ident
from .decimals import (UnsupportedTypeError, ansi_enabled, comment_of, contains_wide_decimal,
                       decimal_text, is_wide_decimal, tag_comment, with_comment)

# Field names the warehouse gives the entries of a converted map (fixed values).
MAP_KEY_FIELD = "Key"
MAP_VALUE_FIELD = "value"

_INTEGRAL = (T.ShortType, T.IntegerType, T.LongType)
_PASS = (T.BooleanType, T.DoubleType, T.TimestampType, T.TimestampNTZType, T.DateType,
         T.BinaryType)


def _holds(dt: T.DataType, kinds: tuple) -> bool:
    """``dt`` is, or contains, a type of ``kinds`` (these need per-element rules)."""
    if isinstance(dt, kinds):
        return True
    if isinstance(dt, T.StructType):
        return any(_holds(f.dataType, kinds) for f in dt.fields)
    if isinstance(dt, T.ArrayType):
        return _holds(dt.elementType, kinds)
    if isinstance(dt, T.MapType):
        return _holds(dt.keyType, kinds) or _holds(dt.valueType, kinds)
    return False


def _conform(c: Column, dt: T.DataType, name: str, widen_float: bool, unify: bool,
             in_array: bool = False) -> tuple[Column, T.DataType, bool]:
    """Return (expression, new type, wide?) for one value of type ``dt``."""
    if isinstance(dt, _PASS):
        return c, dt, False
    if isinstance(dt, _INTEGRAL):
        return c.cast("bigint"), T.LongType(), False
    if isinstance(dt, T.ByteType):
        # two's complement byte as one byte of binary
        return F.unhex(F.lpad(F.hex(c.cast("int").bitwiseAND(255)), 2, "0")), T.BinaryType(), False
    if isinstance(dt, T.FloatType):
        if not widen_float:
            raise UnsupportedTypeError(f"column {name!r}: float is not supported "
                                       "(pass widen_float=True to store it as double)")
        return c.cast("double"), T.DoubleType(), False
    if isinstance(dt, T.DecimalType):
        if is_wide_decimal(dt):
            return decimal_text(c, dt.scale), T.StringType(), True
        if unify:
            to = T.DecimalType(38, 9)
            if dt.precision - dt.scale <= 29:
                return c.cast(to), to, False
            # without ANSI mode a cast would turn a value that does not fit into null
            fitted = c.try_cast(to)
            lost = F.raise_error(F.lit(f"a value of {name} does not fit decimal(38,9)"))
            return F.when(c.isNull() | fitted.isNotNull(), fitted).otherwise(lost), to, False
        return c, dt, False
    if isinstance(dt, (T.StringType, T.VarcharType, T.CharType)):
        return c.cast("string"), T.StringType(), False
    if isinstance(dt, T.StructType):
        parts, fields = [], []
        for f in dt.fields:
            e, t, wide = _conform(c.getField(f.name), f.dataType, f"{name}.{f.name}",
                                  widen_float, unify)
            meta = with_comment(f, tag_comment(comment_of(f)) if wide else comment_of(f))
            parts.append(e.alias(f.name, metadata=meta))
            fields.append(T.StructField(f.name, t, True, meta))
        return F.when(c.isNotNull(), F.struct(*parts)), T.StructType(fields), False
    if isinstance(dt, T.ArrayType):
        et = dt.elementType
        if isinstance(et, T.ArrayType):
            raise UnsupportedTypeError(f"column {name!r}: array of array is not supported")
        if isinstance(et, T.MapType):
            raise UnsupportedTypeError(f"column {name!r}: array of map is not supported")
        probe = {}

        def fn(e: Column) -> Column:
            ex, t, wide = _conform(e, et, name, widen_float, unify, in_array=True)
            probe["t"], probe["wide"] = t, wide
            return ex
        ex = F.transform(c, fn)
        target = T.ArrayType(probe["t"], True)
        if not _holds(et, (T.ByteType, T.MapType)) and not (unify and _holds(et, (T.DecimalType,))) and (ansi_enabled()
                                                          or not contains_wide_decimal(et)):
            # every element rule is a cast: one codegen'd cast, no lambda
            return c.cast(target), target, probe["wide"]
        return ex, target, probe["wide"]
    if isinstance(dt, T.MapType):
        if in_array:
            raise UnsupportedTypeError(f"column {name!r}: array of map is not supported")
        kf = T.StructField(MAP_KEY_FIELD, dt.keyType)
        vf = T.StructField(MAP_VALUE_FIELD, dt.valueType, True)
        entries = T.StructType([kf, vf])
        return _conform(F.map_entries(c).cast(T.ArrayType(entries, True)),
                        T.ArrayType(entries, True), name, widen_float, unify)
    raise UnsupportedTypeError(f"column {name!r}: type {dt.simpleString()} is not supported")


def conform_types(df: DataFrame, *, widen_float: bool = False, unify: bool = False) -> DataFrame:
    """Rewrite every column to a warehouse type; order and comments kept."""
    exprs = []
    for f in df.schema.fields:
        e, _, wide = _conform(df[quote_ident(f.name)], f.dataType, f.name, widen_float, unify)
        comment = tag_comment(comment_of(f)) if wide else comment_of(f)
        exprs.append(e.alias(f.name, metadata=with_comment(f, comment)))
    return df.select(*exprs)


def conformed_schema(schema: T.StructType, *, widen_float: bool = False,
                     unify: bool = False) -> T.StructType:
    """Target schema of ``conform_types`` (all fields nullable)."""
    out = []
    for f in schema.fields:
        _, t, wide = _conform(F.lit(None), f.dataType, f.name, widen_float, unify)
        comment = tag_comment(comment_of(f)) if wide else comment_of(f)
        out.append(T.StructField(f.name, t, True, with_comment(f, comment)))
    return T.StructType(out)
