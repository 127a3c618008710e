"""Files that stay where they are, read as a table.

CSV and newline-delimited JSON get the warehouse's load rules: a budget of
bad records, optional tolerance of unknown values, gzip files with and without
their suffix, Hive-style partition folders, types found from all rows, and a
choice of decimal types. Each rule is a
column expression over the scan; the bad-record budget and the decimal-type
choice each add one aggregate job that returns a single row.
"""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from dataclasses import asdict, dataclass, field
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.tables import (PROP_EXTERNAL, ddl_columns, ddl_properties, table_exists,
                                settings_properties)
from ..session import first_file, is_folder, quote_ident, quote_table, sql_string
from .detect import column_types, json_types

CORRUPT = "_corrupt_record"
PROP_EXTERNAL_SPEC = "tessera.external.spec"

# Warehouse source format names → Spark data source names (fixed values).
FORMATS = {"CSV": "csv", "NEWLINE_DELIMITED_JSON": "json", "JSON": "json",
           "PARQUET": "parquet", "ORC": "orc", "AVRO": "avro"}
# Decimal target type names → Spark types, in the warehouse's meaning where Spark can hold it.
DECIMAL_TARGETS = {"NUMERIC": "decimal(38,9)", "BIGNUMERIC": "decimal(38,18)",
                   "STRING": "string"}


class TooManyBadRecords(RuntimeError):
    pass


@dataclass
class HivePartitioning:
    """Partition folders ``key=value`` under ``source_uri_prefix``; mode AUTO or STRINGS."""

    source_uri_prefix: str
    mode: str = "AUTO"


@dataclass
class ExternalData:
    """External files and their load rules (kept as JSON on a registered table).

    ``max_bad_records=None`` skips the budget check (bad rows are still dropped).
    """

    source_uris: list[str]
    format: str
    schema: str | None = None                 # DDL or JSON of a StructType
    autodetect: bool = False
    max_bad_records: int | None = 0
    ignore_unknown_values: bool = False
    compression: str | None = None
    hive_partitioning: HivePartitioning | None = None
    decimal_target_types: list[str] | None = None
    options: dict = field(default_factory=dict)  # e.g. header, delimiter

    def __post_init__(self):
        if not self.source_uris:
            raise ValueError("external data needs source_uris")
        if isinstance(self.source_uris, str):
            self.source_uris = [self.source_uris]
        if self.format.upper() not in FORMATS and self.format.lower() not in FORMATS.values():
            raise ValueError(f"unknown external format {self.format!r}")
        if isinstance(self.hive_partitioning, dict):
            self.hive_partitioning = HivePartitioning(**self.hive_partitioning)
        if isinstance(self.schema, T.StructType):
            self.schema = self.schema.json()

    @property
    def spark_format(self) -> str:
        return FORMATS.get(self.format.upper(), self.format.lower())

    def struct_schema(self) -> T.StructType | None:
        if self.schema is None:
            return None
        s = self.schema.strip()
        if s.startswith("{"):
            return T.StructType.fromJson(json.loads(s))
        return T.DataType.fromDDL(s)

    def to_json(self) -> str:
        return json.dumps(asdict(self))

    @staticmethod
    def from_json(text: str) -> "ExternalData":
        return ExternalData(**json.loads(text))


def _decimal_fields(schema: T.StructType | None, ext: ExternalData) -> list[str]:
    if schema is None or not ext.decimal_target_types:
        return []
    return [f.name for f in schema.fields if isinstance(f.dataType, T.DecimalType)]


def _gzip(ext: ExternalData) -> bool:
    """Whether every file is declared to be gzip, whatever its name says."""
    comp = (ext.compression or "NONE").upper()
    if comp not in ("NONE", "GZIP"):
        raise ValueError(f"compression {ext.compression!r} is not supported")
    if comp == "GZIP" and ext.spark_format not in ("csv", "json"):
        raise ValueError(f"{ext.spark_format} files are not compressed as a whole")
    return comp == "GZIP"


def _reader(spark: SparkSession, ext: ExternalData, format: str | None = None):
    r = spark.read.format(format or ext.spark_format).options(**{k: str(v) for k, v in ext.options.items()})
    if ext.hive_partitioning is not None:
        r = r.option("basePath", ext.hive_partitioning.source_uri_prefix)
    return r


def _text_keys(spark: SparkSession, ext: ExternalData) -> list[str]:
    """Partition keys whose values stay text (``STRINGS`` layout), from a file's path."""
    hive = ext.hive_partitioning
    if hive is None or hive.mode.upper() != "STRINGS":
        return []
    file = first_file(spark, ext.source_uris) or ""
    tail = file.split(hive.source_uri_prefix.split("://")[-1].strip("/"), 1)[-1]
    return [unquote(p.split("=", 1)[0]) for p in tail.split("/")[:-1] if "=" in p]


def _with_keys(schema: T.StructType, keys: Sequence[str]) -> T.StructType:
    """``schema`` with its partition keys as text: given a type, Spark infers none."""
    return T.StructType([f for f in schema.fields if f.name not in keys]
                        + [T.StructField(k, T.StringType(), True) for k in keys])


def _named_gzip() -> Column:
    # Spark applies it to the list of files, so the others are not opened
    return F.col("_metadata.file_name").endswith(".gz")


_BINARY = T.StructType([T.StructField("path", T.StringType()), T.StructField("modificationTime", T.TimestampType()),
                        T.StructField("length", T.LongType()), T.StructField("content", T.BinaryType())])


def _unnamed_lines(spark: SparkSession, ext: ExternalData, header: bool = False) -> DataFrame:
    """``value`` lines, and the partition columns, of gzip files without the suffix that tells Spark so.

    A file is decompressed as it is read, in one task, as Spark does with gzip. A
    file that is not gzip fails the job. ``header`` leaves out each first line.
    """
    r = spark.read.format("binaryFile").options(**{k: str(v) for k, v in ext.options.items() if k.lower() in (
        "pathglobfilter", "recursivefilelookup", "modifiedbefore", "modifiedafter")})
    if ext.hive_partitioning is not None:
        r = r.option("basePath", ext.hive_partitioning.source_uri_prefix)
    keys = _text_keys(spark, ext)
    if keys:
        r = r.schema(_with_keys(_BINARY, keys))
    files = r.load(ext.source_uris).where(~_named_gzip()).drop("modificationTime", "length")
    parts = [f for f in files.schema.fields if f.name not in ("path", "content")]
    encoding = {k.lower(): v for k, v in ext.options.items()}.get("encoding", "utf-8")

    def lines(batches):
        import gzip
        import io

        import pyarrow as pa
        names = [f.name for f in parts]
        for batch in batches:
            for i in range(batch.num_rows):
                of_file = [batch.column(n).slice(i, 1) for n in names]
                raw = gzip.GzipFile(fileobj=io.BytesIO(batch.column("content")[i].as_py()))
                held: list[str] = []

                def told():
                    at = pa.array([0] * len(held), pa.int32())
                    return pa.RecordBatch.from_arrays([pa.array(held, pa.string()), *(c.take(at) for c in of_file)],
                                                      ["value", *names])
                try:
                    for n, line in enumerate(io.TextIOWrapper(raw, encoding=encoding, errors="replace")):
                        if n or not header:
                            held.append(line.rstrip("\n"))
                        if len(held) == 20_000:
                            yield told()
                            held.clear()
                except (gzip.BadGzipFile, EOFError) as e:
                    raise ValueError(f"{batch.column('path')[i].as_py()} is declared GZIP but cannot be read so: {e}") from None
                if held:
                    yield told()

    return files.mapInArrow(lines, T.StructType([T.StructField("value", T.StringType()), *parts]))


def _load(spark: SparkSession, ext: ExternalData, schema: T.StructType | None) -> DataFrame:
    r = _reader(spark, ext)
    keys = _text_keys(spark, ext)
    if schema is None and keys:
        schema = r.load(ext.source_uris).schema
    if schema is not None:
        r = r.schema(_with_keys(schema, keys))
    df = r.load(ext.source_uris)
    if not _gzip(ext):
        return df
    options = {k.lower(): str(v) for k, v in ext.options.items()}
    if options.get("multiline", "false").lower() == "true":
        raise ValueError("gzip files are read line by line; multiLine needs the .gz suffix and no compression")
    return df.where(_named_gzip()).unionByName(_parsed_lines(spark, ext, schema, options))


def _parsed_lines(spark: SparkSession, ext: ExternalData, schema: T.StructType, options: Mapping[str, str]) -> DataFrame:
    """CSV rows of gzip files without the suffix."""
    lines = _unnamed_lines(spark, ext, options.get("header", "false").lower() == "true").where(F.trim("value") != "")
    parts = [c for c in lines.columns if c != "value"]
    own = [f for f in schema.fields if f.name not in parts]
    ddl = ", ".join(f"{quote_ident(f.name)} {f.dataType.simpleString()}" for f in own)
    known = {k: str(v) for k, v in ext.options.items() if k.lower() not in ("header", "columnpruning", "encoding")}
    row = F.from_csv("value", ddl, known)
    return lines.select(*[row.getField(f.name).alias(f.name, metadata=f.metadata) for f in own],
                        *[F.col(quote_ident(c)) for c in parts])


def _lines(spark: SparkSession, ext: ExternalData) -> DataFrame:
    """``value`` lines of all files, and the partition columns."""
    r = _reader(spark, ext, "text")
    keys = _text_keys(spark, ext)
    if keys:
        r = r.schema(_with_keys(T.StructType([T.StructField("value", T.StringType())]), keys))
    text = r.load(ext.source_uris)
    if _gzip(ext):
        text = text.where(_named_gzip()).unionByName(_unnamed_lines(spark, ext))
    return text


def detect_schema(spark: SparkSession, ext: ExternalData) -> T.StructType:
    """The types of CSV or JSON files, from all their rows (without the partition columns)."""
    if ext.spark_format == "json":
        return json_types(_lines(spark, ext).where(F.trim("value") != ""), ext.options)
    names = _csv_names(spark, ext)
    text = T.StructType([T.StructField(n, T.StringType(), True) for n in names])
    rows = _load(spark, ExternalData(**{**asdict(ext), "options": {**ext.options, "mode": "PERMISSIVE"}}), text)
    return column_types(rows.select(*[F.col(quote_ident(n)) for n in names]), ext.options)


def _csv_names(spark: SparkSession, ext: ExternalData) -> list[str]:
    """Column names from the header, or Spark's names for as many columns as the first line has."""
    if not _gzip(ext):
        found = _reader(spark, ext).load(ext.source_uris).schema
        return [n for n in found.names if n not in _partition_keys(ext, found)]
    import csv

    options = {k.lower(): str(v) for k, v in ext.options.items()}
    first = _lines(spark, ext).where(F.trim("value") != "").select("value").first()
    if first is None:
        return []
    cells = next(csv.reader([first["value"]], delimiter=options.get("delimiter", options.get("sep", ",")),
                            quotechar=options.get("quote", '"')))
    return cells if options.get("header", "false").lower() == "true" else [f"_c{i}" for i in range(len(cells))]


BAD = "__bad"


def read_external(spark: SparkSession, ext: ExternalData) -> DataFrame:
    """Read external files as a DataFrame under the load rules of ``ext``.

    Without a budget of bad records the rule costs nothing before the first
    action: the scan itself fails on one. A budget, and the choice of decimal
    types, are answered by one aggregate together.
    """
    fmt = ext.spark_format
    schema = ext.struct_schema()
    _gzip(ext)
    if schema is None and fmt in ("csv", "json"):
        if fmt == "csv" and not ext.autodetect:
            raise ValueError("CSV external data needs a schema or autodetect=True")
        if ext.autodetect or _gzip(ext):
            schema = detect_schema(spark, ext)
    dec_cols = _decimal_fields(schema, ext)
    if dec_cols:  # read decimals as text; the type is chosen from the values below
        schema = T.StructType([T.StructField(f.name, T.StringType(), True, f.metadata)
                               if f.name in dec_cols else f for f in schema.fields])
    if schema is not None and fmt == "csv":
        df = _csv(spark, ext, schema)
    elif schema is not None and fmt == "json":
        df = _json(spark, ext, schema)
    else:
        df = _load(spark, ext, schema)
    types = [T.DataType.fromDDL(DECIMAL_TARGETS.get(t.upper(), t)) for t in ext.decimal_target_types or ()]
    rules = BAD in df.columns
    budget = ext.max_bad_records if rules else None
    asked = []
    if budget:
        asked.append(F.count_if(F.col(BAD)).alias("bad"))
    if dec_cols:
        good = ~F.col(BAD) if rules else F.lit(True)
        asked += _decimal_checks(df, dec_cols, types, good)
    found = df.agg(*asked).first() if asked else None
    if budget and found["bad"] > budget:
        raise TooManyBadRecords(f"{found['bad']} bad records, more than {budget} allowed")
    if rules:
        fail = F.raise_error(F.lit("a bad record, and none is allowed")).cast("boolean")
        df = df.where(F.when(F.col(BAD), fail if budget == 0 else F.lit(False)).otherwise(True)).drop(BAD)
    if dec_cols:
        df = _with_decimal_types(df, dec_cols, types, found, ext.decimal_target_types)
    return df


def _partition_keys(ext: ExternalData, schema: T.StructType) -> list[str]:
    if ext.hive_partitioning is None:
        return []
    text = "/".join(ext.source_uris)
    return [f.name for f in schema.fields if f"{f.name}=" in text] or _layout_keys(ext, schema)


def _layout_keys(ext: ExternalData, schema: T.StructType) -> list[str]:
    # Spark puts the partition columns last
    file = first_file(SparkSession.active(), ext.source_uris) or ""
    keys = [unquote(p.split("=", 1)[0]) for p in file.split("/")[:-1] if "=" in p]
    return [k for k in keys if k in schema.fieldNames()]


def _typed(s: Column, dtype: T.DataType, options: Mapping[str, str]) -> Column:
    """A text as ``dtype``, null if it does not fit; dates and times by the reader's own formats."""
    if isinstance(dtype, T.StringType):
        return s
    one = T.StructType([T.StructField("v", dtype, True)])
    known = {k: str(v) for k, v in options.items()
             if k.lower() in ("dateformat", "timestampformat", "timestampntzformat", "locale", "timezone")}
    if isinstance(dtype, (T.DateType, T.TimestampType, T.TimestampNTZType)) and known:
        return F.from_csv(F.concat(F.lit('"'), F.replace(s, F.lit('"'), F.lit("")), F.lit('"')), one.simpleString()[7:-1].replace(":", " "),
                          {**known, "mode": "PERMISSIVE"}).getField("v")
    return s.try_cast(dtype)


def _csv(spark: SparkSession, ext: ExternalData, schema: T.StructType) -> DataFrame:
    names = schema.fieldNames()
    if ext.ignore_unknown_values:
        # Every column as text: extra tokens fall away, missing ones are null;
        # a row is bad when a non-empty text does not fit its column type.
        text = T.StructType([T.StructField(f.name, T.StringType(), True) for f in schema.fields])
        raw = _load(spark, ext, text)
        cols, bad = [], F.lit(False)
        for f in schema.fields:
            s = raw[quote_ident(f.name)]
            typed = _typed(s, f.dataType, ext.options)
            cols.append(typed.alias(f.name, metadata=f.metadata))
            bad = bad | (s.isNotNull() & typed.isNull())
        extra = [raw[quote_ident(c)] for c in raw.columns if c not in names]
        return raw.select(*cols, *extra, bad.alias(BAD))
    # Malformed rows, wrong types and extra or missing tokens land in the corrupt
    # column. Column pruning off, or the verdict depends on the columns read.
    with_corrupt = T.StructType(schema.fields + [T.StructField(CORRUPT, T.StringType(), True)])
    opts = {**ext.options, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT,
            "columnPruning": "false"}
    raw = _load(spark, ExternalData(**{**asdict(ext), "options": opts}), with_corrupt)
    # Spark refuses a scan of the corrupt column alone (as count() would make
    # it), so the verdict always touches a data column too
    touched = F.hash(raw[quote_ident(names[0])]) >= F.lit(-(2**31)) if names else F.lit(True)
    return raw.withColumn(BAD, F.col(CORRUPT).isNotNull() & touched).drop(CORRUPT)


def _json(spark: SparkSession, ext: ExternalData, schema: T.StructType) -> DataFrame:
    # One text scan: parse with the schema, flag malformed rows and unknown keys.
    text = _lines(spark, ext)
    text = text.where(F.trim("value") != "")
    with_corrupt = T.StructType(schema.fields + [T.StructField(CORRUPT, T.StringType(), True)])
    parse_opts = {**{k: str(v) for k, v in ext.options.items()},
                  "mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    parsed = F.from_json("value", with_corrupt, parse_opts)
    bad = parsed.getField(CORRUPT).isNotNull()
    if not ext.ignore_unknown_values:
        bad = bad | _unknown_keys(F.col("value"), schema)
    parts = [c for c in text.columns if c != "value"]
    return text.select(*[parsed.getField(f.name).alias(f.name, metadata=f.metadata)
                         for f in schema.fields],
                       *[F.col(quote_ident(c)) for c in parts], bad.alias(BAD))


def _unknown_keys(text: Column, schema: T.StructType) -> Column:
    """A JSON object, or an object inside it, has a key that the schema lacks."""
    known = F.array(*[F.lit(n) for n in schema.fieldNames()])
    bad = F.coalesce(F.size(F.array_except(F.json_object_keys(text), known)) > 0, F.lit(True))
    for f in schema.fields:
        inner = F.get_json_object(text, "$['" + f.name + "']")
        if isinstance(f.dataType, T.StructType):
            bad = bad | (inner.isNotNull() & _unknown_keys(inner, f.dataType))
        elif isinstance(f.dataType, T.ArrayType) and isinstance(f.dataType.elementType, T.StructType):
            element = f.dataType.elementType
            items = F.from_json(inner, "array<string>")
            bad = bad | F.coalesce(F.exists(items, lambda x: x.isNotNull() & _unknown_keys(x, element)), F.lit(False))
    return bad


# ------------------------------------------------------------ decimal targets

def _fits(text: Column, dtp: T.DataType) -> Column:
    """Text holds a value type ``dtp`` stores exactly (no rounding, no overflow)."""
    if isinstance(dtp, T.StringType):
        return F.lit(True)
    t = F.trim(text)
    frac = F.length(F.regexp_extract(t, r"\.(\d*?)0*$", 1))
    plain = t.rlike(r"^[+-]?(\d+\.?\d*|\.\d+)$")
    return text.isNull() | (plain & t.try_cast(dtp).isNotNull() & (frac <= dtp.scale))


def _decimal_checks(df: DataFrame, columns: Sequence[str], types: Sequence[T.DataType], good: Column) -> list[Column]:
    """Whether each (column, candidate type) holds all values of the good rows."""
    return [F.bool_and(F.when(good, _fits(df[quote_ident(c)], t))).alias(f"{i}_{j}")
            for i, c in enumerate(columns) for j, t in enumerate(types)]


def _with_decimal_types(df: DataFrame, columns: Sequence[str], types: Sequence[T.DataType], verdict,
                        targets: Sequence[str]) -> DataFrame:
    chosen = {}
    for i, c in enumerate(columns):
        for j, t in enumerate(types):
            if verdict[f"{i}_{j}"] is not False:
                chosen[c] = t
                break
        else:
            raise ValueError(f"no decimal target type in {list(targets)} holds column {c!r}")
    return df.select(*[df[quote_ident(n)].cast(chosen[n]).alias(n) if n in chosen
                       else df[quote_ident(n)] for n in df.columns])


def choose_decimal_types(df: DataFrame, columns: Sequence[str],
                         targets: Sequence[str]) -> DataFrame:
    """Cast each text column to the first of ``targets`` that holds all its values.

    One aggregate job answers every (column, candidate) pair at once.
    """
    types = [T.DataType.fromDDL(DECIMAL_TARGETS.get(t.upper(), t)) for t in targets]
    verdict = df.agg(*_decimal_checks(df, columns, types, F.lit(True))).first()
    return _with_decimal_types(df, columns, types, verdict, targets)


# ---------------------------------------------------------- catalog entries

def define_external_table(spark: SparkSession, name: str, ext: ExternalData, *,
                          description: str | None = None, friendly_name: str | None = None,
                          labels: Mapping[str, str] | None = None) -> bool:
    """Register ``ext`` in the catalog as an external table (files stay in place).

    The table points at the folder of the URIs (or the Hive prefix, whose
    partitions are found at once). Text formats, and URIs in several folders,
    become a table a folder (``name__0``, ...) under a view that leaves
    malformed rows out, so reading the name gives the rows ``read_table``
    gives. (Unknown JSON keys are told apart only by ``read_table``.) The full
    load rules are kept as a property. Writers refuse to load into it.
    """
    if table_exists(spark, name):
        return False
    if _gzip(ext) and not spark.read.format("binaryFile").load(ext.source_uris).where(~_named_gzip()).select("path").isEmpty():
        raise ValueError("a catalog entry cannot read gzip files without the .gz suffix; read_external can")
    if ext.autodetect and ext.schema is None and ext.spark_format in ("csv", "json"):
        # found once: later reads use the registered types
        ext = ExternalData(**{**asdict(ext), "schema": detect_schema(spark, ext).json(), "autodetect": False})
    folders = ([ext.hive_partitioning.source_uri_prefix] if ext.hive_partitioning
               else list(dict.fromkeys(_folder(spark, u) for u in ext.source_uris)))
    df = read_external(spark, ExternalData(**{**asdict(ext), "max_bad_records": None}))
    kept = asdict(ext)
    if ext.decimal_target_types and ext.struct_schema() is not None:
        # the choice is made once: later reads use the registered types
        given = ext.struct_schema().fieldNames()
        kept |= {"schema": T.StructType([f for f in df.schema.fields if f.name in given]).json(),
                 "decimal_target_types": None}
    props = settings_properties(partitioning=None, clustering=None, require_partition_filter=False,
                         friendly_name=friendly_name, labels=labels, location=None,
                         expiration_time=None, extra={PROP_EXTERNAL: "true",
                                                      PROP_EXTERNAL_SPEC: ExternalData(**kept).to_json()})
    opts = {k: str(v) for k, v in ext.options.items()}
    text = ext.spark_format in ("csv", "json") and not (ext.spark_format == "csv" and ext.ignore_unknown_values)
    stored = df.schema
    if text:
        opts |= {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT, "columnPruning": "false"}
        stored = T.StructType([*stored.fields, T.StructField(CORRUPT, T.StringType(), True)])
    part_cols = [c for c in df.columns if ext.struct_schema() is not None
                 and c not in ext.struct_schema().fieldNames()]
    if ext.hive_partitioning is not None and not part_cols:
        part_cols = _layout_keys(ext, df.schema)
    comment = f" COMMENT {sql_string(description)}" if description else ""
    names = [name] if len(folders) == 1 and not text else [f"{name}__{i}" for i in range(len(folders))]
    for table, folder in zip(names, folders):
        sql = [f"CREATE TABLE {quote_table(table)} ({ddl_columns(stored)}) USING {ext.spark_format}"]
        if opts:
            sql.append(f"OPTIONS ({ddl_properties(opts)})")
        if part_cols:
            sql.append("PARTITIONED BY (" + ", ".join(quote_ident(c) for c in part_cols) + ")")
        sql.append(f"LOCATION {sql_string(folder)}{comment} TBLPROPERTIES ({ddl_properties(props)})")
        spark.sql(" ".join(sql))
        if part_cols:
            spark.sql(f"ALTER TABLE {quote_table(table)} RECOVER PARTITIONS")
    if names != [name]:
        columns = ", ".join(quote_ident(c) for c in df.columns)
        # the verdict on a row is Spark's only where every column is read
        read = ", ".join(quote_ident(f.name) for f in df.schema.fields
                         if not isinstance(f.dataType, T.MapType) and f.name not in part_cols)
        good = f" WHERE {quote_ident(CORRUPT)} IS NULL AND hash({read}) >= {-2**31}" if text and read else ""
        union = " UNION ALL ".join(f"SELECT {columns} FROM {quote_table(t)}{good}" for t in names)
        spark.sql(f"CREATE VIEW {quote_table(name)}{comment} TBLPROPERTIES ({ddl_properties(props)}) AS {union}")
    return True


def _folder(spark: SparkSession, uri: str) -> str:
    """The folder a URI names, or the one that holds its files."""
    plain = uri.rstrip("/")
    if not any(c in plain.rsplit("/", 1)[-1] for c in "*?[{") and is_folder(spark, plain):
        return plain
    return plain.rsplit("/", 1)[0]


def read_external_table(spark: SparkSession, name: str) -> DataFrame:
    """Read a registered external table under its stored load rules."""
    from ..operators.tables import table_properties
    spec = table_properties(spark, name).get(PROP_EXTERNAL_SPEC)
    if spec is None:
        raise ValueError(f"{name} is not an external table")
    return read_external(spark, ExternalData.from_json(spec))
