"""Column types found from every row of text files, by one mergeable aggregate.

Each value votes for the narrowest types that hold it exactly; votes are merged
by ``and``, ``max`` and ``or``, on the map side first, so one row comes back however
large the files are, and a single wide value in the last file counts like any
other. The order of types, from the narrowest:

    boolean
    bigint < decimal(p, s) < double
    date < timestamp_ntz; timestamp where every value has a zone
    string (also for what has no values, or values of several kinds)

Decimals keep every digit; plain numbers of over 38 digits stay text rather than
lose some as doubles. JSON objects and arrays become structs and arrays,
fields merged over all rows (Spark's variant schema aggregate), and texts
inside them are tried as dates and times too.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import quote_ident

WIDEST = 38
_NUMBER = r"^[+-]?(\d+\.?\d*|\.\d+)$"
_FLOAT = r"^[+-]?((\d+\.?\d*|\.\d+)([eE][+-]?\d+)?|NaN|Infinity)$"
_DATE = r"^\d{4}-\d{2}-\d{2}$"
_TIME = r"^\d{4}-\d{2}-\d{2}[ T]\d{2}:\d{2}(:\d{2}(\.\d{1,6})?)?"
_ZONE = r"(Z|[+-]\d{2}:?\d{2})$"


def _formats(options: Mapping[str, str]) -> dict[str, str]:
    return {k.lower(): str(v) for k, v in options.items() if k.lower() in ("dateformat", "timestampformat")}


def _times(s: Column, options: Mapping[str, str]) -> dict[str, Column]:
    """Whether a text is a date, a time of day without a zone, and one with a zone."""
    told = _formats(options)
    plain = F.coalesce(s.rlike(_TIME + "$") & s.try_cast("timestamp_ntz").isNotNull(), F.lit(False))
    day = (F.try_to_date(s, told["dateformat"]).isNotNull() if "dateformat" in told
           else F.coalesce(s.rlike(_DATE) & s.try_cast("date").isNotNull(), F.lit(False)))
    if "timestampformat" in told:
        plain = F.try_to_timestamp(s, F.lit(told["timestampformat"])).isNotNull()
    zoned = F.coalesce(s.rlike(_TIME + _ZONE) & s.try_cast("timestamp").isNotNull(), F.lit(False))
    return {"date": day, "ntz": plain | (day if "timestampformat" not in told else F.lit(False)), "zoned": zoned}


def _time_type(verdict: Mapping[str, bool | None]) -> T.DataType | None:
    if verdict["date"]:
        return T.DateType()
    if verdict["ntz"]:
        return T.TimestampNTZType()
    return T.TimestampType() if verdict["zoned"] else None


# ----------------------------------------------------------------------- CSV

def column_types(text: DataFrame, options: Mapping[str, str] = {}) -> T.StructType:
    """Types of the columns of ``text``, all strings, over all its rows."""
    asked = []
    for i, name in enumerate(text.columns):
        c = text[quote_ident(name)]
        s = F.when(F.trim(c) != "", F.trim(c))
        whole = s.rlike(r"^[+-]?\d+$")
        plain = s.rlike(_NUMBER)
        votes = {
            "n": F.count(s), "bool": F.bool_and(F.lower(s).isin("true", "false")),
            "long": F.bool_and(F.when(s.isNotNull(), whole & s.try_cast("bigint").isNotNull())), "number": F.bool_and(plain),
            "digits": F.max(F.when(plain, F.length(F.regexp_extract(s, r"^[+-]?0*(\d*)", 1)))),
            "scale": F.max(F.when(plain, F.length(F.regexp_extract(s, r"\.(\d*?)0*$", 1)))),
            "float": F.bool_and(s.rlike(_FLOAT)),
            **{k: F.bool_and(F.when(s.isNotNull(), v)) for k, v in _times(s, options).items()},
        }
        asked += [v.alias(f"{i}_{k}") for k, v in votes.items()]
    found = text.agg(*asked).first() if asked else {}
    fields = []
    for i, name in enumerate(text.columns):
        v = {k: found[f"{i}_{k}"] for k in ("n", "bool", "long", "number", "digits", "scale", "float", "date", "ntz", "zoned")}
        fields.append(T.StructField(name, _column_type(v), True))
    return T.StructType(fields)


def _column_type(v: Mapping) -> T.DataType:
    if not v["n"]:
        return T.StringType()
    if v["bool"]:
        return T.BooleanType()
    if v["long"]:
        return T.LongType()
    if v["number"]:
        precision = max(1, v["digits"] + v["scale"])
        return T.DecimalType(precision, v["scale"]) if precision <= WIDEST else T.StringType()
    if v["float"]:
        return T.DoubleType()
    return _time_type(v) or T.StringType()


# ---------------------------------------------------------------------- JSON

def json_types(lines: DataFrame, options: Mapping[str, str] = {}, column: str = "value") -> T.StructType:
    """Schema of newline-delimited JSON objects over all rows; lines that are no JSON are left out."""
    parsed = F.try_parse_json(F.col(column))
    told = lines.agg(F.schema_of_variant_agg(parsed).alias("s")).first()["s"]
    if not told or not told.startswith("OBJECT<"):
        return T.StructType([])
    schema = _settled(T.DataType.fromDDL(told.replace("OBJECT<>", "STRING").replace("OBJECT<", "STRUCT<")))
    leaves = list(_text_leaves(schema))
    if not leaves:
        return schema
    rows = lines.select(F.from_json(column, schema).alias("v"))
    asked = []
    for i, path in enumerate(leaves):
        for kind in ("date", "ntz", "zoned"):
            # null where there is no text at all
            asked.append(F.bool_and(_every(F.col("v"), path, lambda s, k=kind: _times(s, options)[k])).alias(f"{i}_{kind}"))
    found = rows.agg(*asked).first()
    types = {path: _time_type({k: found[f"{i}_{k}"] for k in ("date", "ntz", "zoned")}) for i, path in enumerate(leaves)}
    return _with_types(schema, types)


def _settled(dtp: T.DataType) -> T.DataType:
    """Kinds that do not agree, and values that are all null, become text."""
    if isinstance(dtp, T.StructType):
        return T.StructType([T.StructField(f.name, _settled(f.dataType), True) for f in dtp.fields])
    if isinstance(dtp, T.ArrayType):
        return T.ArrayType(_settled(dtp.elementType), True)
    if isinstance(dtp, (T.VariantType, T.NullType)):
        return T.StringType()
    return dtp


def _text_leaves(dtp: T.DataType, path: tuple = ()):
    """Paths of the texts in a schema: field names, and ``None`` for the elements of an array."""
    if isinstance(dtp, T.StructType):
        for f in dtp.fields:
            yield from _text_leaves(f.dataType, (*path, f.name))
    elif isinstance(dtp, T.ArrayType):
        yield from _text_leaves(dtp.elementType, (*path, None))
    elif isinstance(dtp, T.StringType):
        yield path


def _every(c: Column, path: tuple, test) -> Column:
    """The test over all texts at a path of one row; null where there are none."""
    if not path:
        return F.when(c.isNotNull(), test(c))
    head, rest = path[0], path[1:]
    if head is not None:
        return _every(c.getField(head), rest, test)
    return F.aggregate(c, F.lit(None).cast("boolean"),
                       lambda so_far, x: (lambda t: F.when(so_far.isNull(), t).when(t.isNull(), so_far).otherwise(so_far & t))(
                           _every(x, rest, test)))


def _with_types(dtp: T.DataType, types: Mapping[tuple, T.DataType | None], path: tuple = ()) -> T.DataType:
    if isinstance(dtp, T.StructType):
        return T.StructType([T.StructField(f.name, _with_types(f.dataType, types, (*path, f.name)), True) for f in dtp.fields])
    if isinstance(dtp, T.ArrayType):
        return T.ArrayType(_with_types(dtp.elementType, types, (*path, None)), True)
    return types.get(path) or dtp
