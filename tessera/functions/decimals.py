"""Lossless wide-decimal codec as Spark column expressions.

A warehouse numeric type holds at most 38 digits with 9 after the point.
Wider decimals travel as text, and the column comment carries a tag so a
reader can turn the text back into a decimal. Both directions are single
``select`` projections: no RDD, no Python UDF, so Catalyst keeps column
pruning, filter pushdown and whole-stage codegen through them.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import quote_ident

# Fixed values shared with the warehouse convention: the comment tag, the
# separator between the tag and the rest of a comment, the widest numeric the
# warehouse holds (precision 38, scale 9) and the restored decimal type.
TAG = "BigDecimalType"
SEPARATOR = "|"
MAX_PRECISION = 38
MAX_SCALE = 9
RESTORED_TYPE = T.DecimalType(38, 18)


class UnsupportedTypeError(TypeError):
    """A column type the codec refuses."""


# ---------------------------------------------------------------- comments

def comment_of(field: T.StructField) -> str:
    return (field.metadata or {}).get("comment", "") or ""


def has_tag(comment: str | None) -> bool:
    """True when the tag is one whole ``|``-separated part of the comment."""
    if not comment:
        return False
    return TAG in (part.strip() for part in comment.split(SEPARATOR))


def tag_comment(comment: str | None) -> str:
    """Prefix the tag, keep the old text after ``|``; never tag twice."""
    if has_tag(comment):
        return comment  # type: ignore[return-value]
    return SEPARATOR.join(c for c in (TAG, comment) if c)


def with_comment(field: T.StructField, comment: str) -> dict:
    meta = dict(field.metadata or {})
    if comment:
        meta["comment"] = comment
    else:
        meta.pop("comment", None)
    return meta


# ------------------------------------------------------------ type rules

def is_wide_decimal(dt: T.DataType) -> bool:
    return isinstance(dt, T.DecimalType) and (
        dt.scale > MAX_SCALE or dt.precision > MAX_PRECISION)


def contains_wide_decimal(dt: T.DataType) -> bool:
    """Wide decimal anywhere inside ``dt`` (struct fields, elements, map sides)."""
    if is_wide_decimal(dt):
        return True
    if isinstance(dt, T.StructType):
        return any(contains_wide_decimal(f.dataType) for f in dt.fields)
    if isinstance(dt, T.ArrayType):
        return contains_wide_decimal(dt.elementType)
    if isinstance(dt, T.MapType):
        return contains_wide_decimal(dt.keyType) or contains_wide_decimal(dt.valueType)
    return False


def _check_supported(dt: T.DataType, name: str) -> None:
    if isinstance(dt, T.ArrayType):
        if isinstance(dt.elementType, T.ArrayType):
            raise UnsupportedTypeError(f"column {name!r}: array of array is not supported")
        _check_supported(dt.elementType, name)
    elif isinstance(dt, T.StructType):
        for f in dt.fields:
            _check_supported(f.dataType, f"{name}.{f.name}")
    elif isinstance(dt, T.MapType):
        _check_supported(dt.keyType, name)
        _check_supported(dt.valueType, name)


def contains_tag(field: T.StructField) -> bool:
    """A string (or array of strings) whose comment holds the tag, anywhere inside."""
    return _tagged(field.dataType, comment_of(field))


def _tagged(dt: T.DataType, comment: str) -> bool:
    if isinstance(dt, T.StringType):
        return has_tag(comment)
    if isinstance(dt, T.ArrayType):
        # arrays of strings use the array's comment; structs their fields' own
        return _tagged(dt.elementType, comment)
    if isinstance(dt, T.MapType):
        # map values use the map's comment, as array elements use the array's
        return _tagged(dt.valueType, comment)
    if isinstance(dt, T.StructType):
        return any(_tagged(f.dataType, comment_of(f)) for f in dt.fields)
    return False


def wide_decimal_columns(schema: T.StructType) -> list[str]:
    return [f.name for f in schema.fields if contains_wide_decimal(f.dataType)]


def tagged_columns(schema: T.StructType) -> list[str]:
    return [f.name for f in schema.fields if contains_tag(f)]


def _resolve(schema: T.StructType, columns: Iterable[str | int] | None) -> list[str] | None:
    if columns is None:
        return None
    names = schema.fieldNames()
    out = []
    for c in columns:
        if isinstance(c, int):
            out.append(names[c])
        elif c in names:
            out.append(c)
        else:
            raise KeyError(f"no column {c!r}; columns are {names}")
    return out


# -------------------------------------------------------- encoded schema

def _encoded_type(dt: T.DataType) -> T.DataType:
    """Type after encoding; struct fields inside carry the tag themselves."""
    if is_wide_decimal(dt):
        return T.StringType()
    if isinstance(dt, T.StructType):
        return T.StructType([_encoded_field(f) for f in dt.fields])
    if isinstance(dt, T.ArrayType):
        return T.ArrayType(_encoded_type(dt.elementType), dt.containsNull)
    if isinstance(dt, T.MapType):
        return T.MapType(_encoded_type(dt.keyType), _encoded_type(dt.valueType),
                         dt.valueContainsNull)
    return dt


def _encoded_comment(field: T.StructField) -> str:
    """Decimal, array or map holding wide decimals: tagged. Struct: own comment kept."""
    dt = field.dataType
    if isinstance(dt, T.StructType) or not contains_wide_decimal(dt):
        return comment_of(field)
    return tag_comment(comment_of(field))


def _encoded_field(field: T.StructField) -> T.StructField:
    return T.StructField(field.name, _encoded_type(field.dataType), True,
                         with_comment(field, _encoded_comment(field)))


# ------------------------------------------------------- encode / restore

def ansi_enabled(spark: SparkSession | None = None) -> bool:
    spark = spark or SparkSession.getActiveSession()
    return spark is None or spark.conf.get("spark.sql.ansi.enabled", "true").lower() == "true"


def decimal_text(c: Column, scale: int, ansi: bool | None = None) -> Column:
    """Plain text of a decimal of ``scale``, the same whatever the ANSI setting.

    Under ANSI mode a cast already prints plain digits. Without it Spark prints
    small values in scientific form (``0E-18``), so values below one are built
    from their fraction digits instead: still column expressions, no UDF.
    """
    if ansi is None:
        ansi = ansi_enabled()
    if ansi or not 0 < scale < MAX_PRECISION:
        return c.cast("string")
    a = F.abs(c)
    digits = (a * F.lit(10 ** scale).cast(T.DecimalType(scale + 1, 0))) \
        .cast(T.DecimalType(MAX_PRECISION, 0)).cast("string")
    small = F.concat(F.when(c < 0, F.lit("-")).otherwise(F.lit("")), F.lit("0."),
                     F.lpad(digits, scale, "0"))
    return F.when(a < 1, small).otherwise(c.cast("string"))


def _encode_expr(c: Column, dt: T.DataType, ansi: bool = True) -> Column:
    if is_wide_decimal(dt):
        return decimal_text(c, dt.scale, ansi)
    if isinstance(dt, T.StructType):
        # Rebuild the struct rather than cast it whole: a later projection of
        # one subfield then prunes the others at the scan.
        parts = []
        for f in dt.fields:
            inner = c.getField(f.name)
            if contains_wide_decimal(f.dataType):
                inner = _encode_expr(inner, f.dataType, ansi)
            parts.append(inner.alias(f.name, metadata=with_comment(f, _encoded_comment(f))))
        return F.when(c.isNotNull(), F.struct(*parts))
    if ansi:
        # Arrays and maps: one cast to the target type (metadata included).
        return c.cast(_encoded_type(dt))
    # Without ANSI mode, element by element so every decimal prints plain.
    if isinstance(dt, T.ArrayType):
        return F.transform(c, lambda e: _encode_expr(e, dt.elementType, ansi))
    out = c
    if contains_wide_decimal(dt.keyType):
        out = F.transform_keys(out, lambda k, v: _encode_expr(k, dt.keyType, ansi))
    if contains_wide_decimal(dt.valueType):
        out = F.transform_values(out, lambda k, v: _encode_expr(v, dt.valueType, ansi))
    return out


def encode_wide_decimals(df: DataFrame, columns: Sequence[str | int] | None = None) -> DataFrame:
    """Wide decimals (scale > 9) → text, tagged in the column comment.

    ``columns`` limits the rewrite to the listed names or positions; by default
    every column holding a wide decimal anywhere inside is rewritten. Other
    columns pass untouched and the column order is kept.
    """
    schema = df.schema
    ansi = ansi_enabled(df.sparkSession)
    chosen = _resolve(schema, columns)
    if chosen is None:
        chosen = wide_decimal_columns(schema)
    chosen_set = set(chosen)
    exprs = []
    for f in schema.fields:
        c = df[quote_ident(f.name)]
        if f.name in chosen_set:
            _check_supported(f.dataType, f.name)
            if contains_wide_decimal(f.dataType):
                exprs.append(_encode_expr(c, f.dataType, ansi).alias(
                    f.name, metadata=with_comment(f, _encoded_comment(f))))
                continue
        exprs.append(c)
    return df.select(*exprs)


def _cast(c: Column, target: T.DataType, lenient: bool, ansi: bool = True) -> Column:
    if lenient:
        return c.try_cast(target)
    if ansi:
        return c.cast(target)
    # without ANSI mode a cast returns null for bad text: fail explicitly instead
    t = c.try_cast(target)
    return F.when(c.isNotNull() & t.isNull(),
                  F.raise_error(F.concat(F.lit("not a decimal: "), c))).otherwise(t)


def _restored_type(dt: T.DataType, comment: str, target: T.DataType) -> T.DataType:
    """Type after restoring: tagged strings become ``target``; comments stay."""
    if isinstance(dt, T.StringType):
        return target if has_tag(comment) else dt
    if isinstance(dt, T.StructType):
        return T.StructType([T.StructField(f.name, _restored_type(f.dataType, comment_of(f), target),
                                           f.nullable, f.metadata) for f in dt.fields])
    if isinstance(dt, T.ArrayType):
        return T.ArrayType(_restored_type(dt.elementType, comment, target), dt.containsNull)
    if isinstance(dt, T.MapType):
        return T.MapType(dt.keyType, _restored_type(dt.valueType, comment, target),
                         dt.valueContainsNull)
    return dt


def _restore_expr(c: Column, dt: T.DataType, comment: str, target: T.DataType,
                  lenient: bool, ansi: bool = True) -> Column:
    if isinstance(dt, T.StructType):
        # rebuilt field by field, as in encoding, so subfield pruning still applies
        parts = [_restore_expr(c.getField(f.name), f.dataType, comment_of(f), target, lenient, ansi)
                 .alias(f.name, metadata=dict(f.metadata or {})) for f in dt.fields]
        return F.when(c.isNotNull(), F.struct(*parts))
    new = _restored_type(dt, comment, target)
    if new == dt:
        return c
    if lenient or ansi or isinstance(dt, T.StringType):
        # strings, arrays and maps: one (codegen'd) cast to the restored type
        return _cast(c, new, lenient, ansi)
    # strict without ANSI mode: element by element, so bad text still fails
    if isinstance(dt, T.ArrayType):
        return F.transform(c, lambda e: _restore_expr(e, dt.elementType, comment, target,
                                                       lenient, ansi))
    return F.transform_values(c, lambda k, v: _restore_expr(v, dt.valueType, comment, target,
                                                            lenient, ansi))


def restore_decimals(df: DataFrame, columns: Sequence[str | int] | None = None, *,
                     lenient: bool = False,
                     target: T.DataType | str | Mapping[str, T.DataType | str] | None = None,
                     ) -> DataFrame:
    """Tagged text → ``decimal(38,18)`` (or ``target``), comments kept.

    Only strings whose own comment (the array's, for arrays and maps; each
    inner field's, for structs) holds the tag are cast. ``lenient`` turns
    malformed text into null instead of failing the job. ``target`` is one type
    for all columns or a mapping column → type.
    """
    schema = df.schema
    ansi = ansi_enabled(df.sparkSession)
    chosen = _resolve(schema, columns)
    if chosen is None:
        chosen = tagged_columns(schema)
    chosen_set = set(chosen)
    exprs = []
    for f in schema.fields:
        c = df[quote_ident(f.name)]
        if f.name in chosen_set and contains_tag(f):
            _check_supported(f.dataType, f.name)
            t = target.get(f.name) if isinstance(target, Mapping) else target
            t = t or RESTORED_TYPE
            if isinstance(t, str):
                t = T.DataType.fromDDL(t)
            restored = _restore_expr(c, f.dataType, comment_of(f), t, lenient, ansi)
            exprs.append(restored.alias(f.name, metadata=dict(f.metadata or {})))
        else:
            exprs.append(c)
    return df.select(*exprs)


def encoded_schema(schema: T.StructType, columns: Sequence[str | int] | None = None) -> T.StructType:
    """Schema ``encode_wide_decimals`` produces, without touching data."""
    chosen = set(wide_decimal_columns(schema) if columns is None else _resolve(schema, columns))
    return T.StructType([_encoded_field(f) if f.name in chosen else f for f in schema.fields])
