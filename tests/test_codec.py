"""Decimal codec and type conformer on the hand-made fixtures of FIXTURES.md."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.errors import PySparkException

from tessera.functions import (TAG, UnsupportedTypeError, conform_types, conformed_schema,
                               encode_wide_decimals, encoded_schema, has_tag, restore_decimals,
                               tag_comment)
from tessera.plans import python_or_rdd_nodes, pushed_filters, read_schemas


def comment(schema, name):
    return schema[name].metadata.get("comment", "")


def test_tag_rules():
    assert tag_comment("") == TAG
    assert tag_comment(None) == TAG
    assert tag_comment("price") == f"{TAG}|price"
    assert tag_comment(f"{TAG}|price") == f"{TAG}|price"
    assert has_tag(f"x|{TAG}") and not has_tag("NotBigDecimalTypeReally")


FLAT = ("b boolean, s smallint, i int, l bigint, by tinyint, d double, n decimal(20,9), "
        "w decimal(38,18), str string, v string, c string, ts timestamp, dt date, bin binary")


@pytest.fixture()
def flat(spark):
    row = (True, 1, 2, 3, 4, 1.5, Decimal("12.123456789"), Decimal("-1.000000000000000001"),
           "x", "abcde", "abc", dt.datetime(2024, 1, 1, 12), dt.date(2024, 1, 2), b"\x01\x02")
    return spark.createDataFrame([row, tuple([None] * len(row))], FLAT)


def test_flat_only_wide_rewritten(flat):
    enc = encode_wide_decimals(flat)
    assert enc.columns == flat.columns
    assert enc.schema["w"].dataType == T.StringType()
    assert comment(enc.schema, "w") == TAG
    assert enc.schema["n"].dataType == T.DecimalType(20, 9)
    rows = enc.collect()
    assert rows[0]["w"] == "-1.000000000000000001"
    assert rows[1]["w"] is None
    back = restore_decimals(enc)
    assert back.schema["w"].dataType == T.DecimalType(38, 18)
    assert back.collect() == flat.collect()
    assert encoded_schema(flat.schema) == enc.schema


@pytest.fixture()
def edges(spark):
    rows = [(1, Decimal("0"), Decimal("0"), Decimal("0"), Decimal("0")),
            (2, Decimal("1E-18"), Decimal("1E-9"), Decimal("1E-10"), Decimal("1E-20")),
            (3, Decimal("-123.456"), Decimal("-5"), Decimal("-0.5"), Decimal("-1.00000000000000000001")),
            (4, Decimal("12345678901234567890.123456789012345678"), Decimal("1"), Decimal("1"),
             Decimal("1")),
            (5, None, None, None, None)]
    return spark.createDataFrame(
        rows, "id bigint, w decimal(38,18), n decimal(38,9), w10 decimal(20,10), w20 decimal(38,20)")


def test_decimal_edges_text_and_round_trip(edges):
    enc = encode_wide_decimals(edges)
    assert [f.name for f in enc.schema.fields if f.dataType == T.StringType()] == ["w", "w10", "w20"]
    got = {r["id"]: r for r in enc.collect()}
    assert got[1]["w"] == "0.000000000000000000"          # ANSI text form, not 0E-18
    assert got[2]["w"] == "0.000000000000000001"
    assert got[4]["w"] == "12345678901234567890.123456789012345678"
    assert got[5]["w"] is None
    back = restore_decimals(enc, target={"w10": "decimal(20,10)", "w20": "decimal(38,20)"})
    assert back.collect() == edges.collect()
    # default target is decimal(38,18): scale 20 rounds, as the warehouse convention does
    default = {r["id"]: r for r in restore_decimals(enc).collect()}
    assert default[3]["w20"] == Decimal("-1.000000000000000000")


def test_array_wide(spark):
    df = spark.createDataFrame([(1, None), (2, []), (3, [Decimal("1.5"), None])],
                               "id bigint, a array<decimal(38,18)>")
    enc = encode_wide_decimals(df)
    assert enc.schema["a"].dataType == T.ArrayType(T.StringType(), True)
    assert comment(enc.schema, "a") == TAG
    assert [r["a"] for r in enc.orderBy("id").collect()] == [None, [], ["1.500000000000000000", None]]
    assert restore_decimals(enc).orderBy("id").collect() == df.orderBy("id").collect()


STRUCT = ("id bigint, s struct<x: decimal(38,18), y: string, `when`: date, "
          "inner: struct<z: decimal(38,12)>>")


def test_struct_wide(spark):
    rows = [(1, None), (2, (None, "a", None, None)),
            (3, (Decimal("2.25"), "b", dt.date(2024, 1, 1), (Decimal("3.5"),)))]
    df = spark.createDataFrame(rows, STRUCT)
    df = df.select("id", F.col("s").alias("s", metadata={"comment": "outer"}))
    enc = encode_wide_decimals(df)
    st = enc.schema["s"]
    assert comment(enc.schema, "s") == "outer"           # struct keeps its own comment
    assert st.dataType["x"].metadata["comment"] == TAG
    assert st.dataType["x"].dataType == T.StringType()
    assert st.dataType["inner"].dataType["z"].metadata["comment"] == TAG
    assert st.dataType["y"].metadata == {}
    r = {x["id"]: x for x in enc.collect()}
    assert r[1]["s"] is None and r[2]["s"]["x"] is None and r[2]["s"]["inner"] is None
    assert r[3]["s"]["inner"]["z"] == "3.500000000000"
    back = restore_decimals(enc, target="decimal(38,12)")
    assert back.schema["s"].dataType["x"].dataType == T.DecimalType(38, 12)
    back = restore_decimals(enc)
    assert {x["id"]: x for x in back.collect()}[3]["s"]["x"] == Decimal("2.25")


def test_struct_plain_passes(spark):
    df = spark.createDataFrame([(1, (1, "a"))], "id bigint, s struct<x: int, y: string>")
    assert encode_wide_decimals(df).schema == df.schema
    assert restore_decimals(df).schema == df.schema


def test_array_struct_wide(spark):
    df = spark.createDataFrame(
        [(1, None), (2, []), (3, [None, ("a", Decimal("9.99"))])],
        "id bigint, items array<struct<sku: string, price: decimal(38,18)>>")
    enc = encode_wide_decimals(df)
    assert comment(enc.schema, "items") == TAG          # both the array and the field
    assert enc.schema["items"].dataType.elementType["price"].metadata["comment"] == TAG
    assert restore_decimals(enc).orderBy("id").collect() == df.orderBy("id").collect()


def test_map_wide(spark):
    df = spark.createDataFrame([(1, None), (2, {}), (3, {"a": Decimal("1.25"), "b": None})],
                               "id bigint, m map<string, decimal(38,18)>")
    enc = encode_wide_decimals(df)
    assert enc.schema["m"].dataType == T.MapType(T.StringType(), T.StringType(), True)
    assert restore_decimals(enc).orderBy("id").collect() == df.orderBy("id").collect()


def test_tagged_strict_and_lenient(spark):
    tagged = {"comment": TAG}
    df = spark.createDataFrame([(1, None), (2, "12.5"), (3, "0E-18"), (4, "1.12345678901234567890"),
                                (5, "abc")], "id bigint, p string")
    df = df.select("id", F.col("p").alias("p", metadata=tagged), F.col("p").alias("plain"))
    got = {r["id"]: r for r in restore_decimals(df, lenient=True).collect()}
    assert got[2]["p"] == Decimal("12.5") and got[3]["p"] == Decimal(0)
    assert got[4]["p"] == Decimal("1.123456789012345679")
    assert got[5]["p"] is None and got[5]["plain"] == "abc"
    with pytest.raises(PySparkException):
        restore_decimals(df).collect()


def test_tagged_nested_listing(spark):
    schema = T.StructType([
        T.StructField("id", T.LongType()),
        T.StructField("a", T.ArrayType(T.StringType()), True, {"comment": TAG}),
        T.StructField("s", T.StructType([T.StructField("x", T.StringType(), True, {"comment": TAG}),
                                         T.StructField("y", T.StringType())]))])
    df = spark.createDataFrame([(1, ["1.5", None], ("2.5", "keep"))], schema)
    back = restore_decimals(df)
    r = back.first()
    assert r["a"] == [Decimal("1.5"), None] and r["s"]["x"] == Decimal("2.5") and r["s"]["y"] == "keep"
    assert back.schema["s"].dataType["x"].metadata["comment"] == TAG   # comment kept
    only_a = restore_decimals(df, columns=["a"])
    assert only_a.schema["s"].dataType["x"].dataType == T.StringType()


def test_commented_no_double_tag(spark):
    df = spark.createDataFrame([(Decimal("1.5"),)], "p decimal(38,18)")
    df = df.select(F.col("p").alias("p", metadata={"comment": "price"}))
    once = encode_wide_decimals(df)
    assert comment(once.schema, "p") == f"{TAG}|price"
    again = encode_wide_decimals(restore_decimals(once))
    assert comment(again.schema, "p") == f"{TAG}|price"


def test_odd_names(spark):
    df = spark.createDataFrame([(1, Decimal("1.5"))], "`a b` int, `a.b` decimal(38,18)")
    enc = encode_wide_decimals(df)
    assert enc.columns == ["a b", "a.b"]
    assert enc.schema["a.b"].dataType == T.StringType()
    assert restore_decimals(enc).collect() == df.collect()


def test_explicit_columns_by_position(spark, edges):
    enc = encode_wide_decimals(edges, columns=[1])
    assert enc.schema["w"].dataType == T.StringType()
    assert enc.schema["w10"].dataType == T.DecimalType(20, 10)


def test_rejected_types(spark):
    aa = spark.createDataFrame([(1, [[1]])], "id int, a array<array<int>>")
    with pytest.raises(UnsupportedTypeError):
        encode_wide_decimals(aa, columns=["a"])
    with pytest.raises(UnsupportedTypeError):
        conform_types(aa)
    fl = spark.createDataFrame([(1.5,)], "f float")
    with pytest.raises(UnsupportedTypeError):
        conform_types(fl)
    assert conform_types(fl, widen_float=True).schema["f"].dataType == T.DoubleType()
    am = spark.createDataFrame([([{"k": 1}],)], "a array<map<string,int>>")
    with pytest.raises(UnsupportedTypeError):
        conform_types(am)
    iv = spark.sql("SELECT INTERVAL '1' DAY AS i")
    with pytest.raises(UnsupportedTypeError):
        conform_types(iv)


def test_conform_mapping(flat, spark):
    c = conform_types(flat)
    types = {f.name: f.dataType for f in c.schema.fields}
    assert types["s"] == T.LongType() and types["i"] == T.LongType() and types["l"] == T.LongType()
    assert types["by"] == T.BinaryType() and types["w"] == T.StringType()
    assert types["v"] == T.StringType() and types["c"] == T.StringType()
    assert types["n"] == T.DecimalType(20, 9)
    assert conform_types(flat, unify=True).schema["n"].dataType == T.DecimalType(38, 9)
    assert c.first()["by"] == bytes([4])
    neg = spark.createDataFrame([(-1,)], "b tinyint")
    assert conform_types(neg).first()["b"] == bytes([255])
    assert all(f.nullable for f in c.schema.fields)
    assert conformed_schema(flat.schema) == c.schema


def test_conform_map_to_entries(spark):
    df = spark.createDataFrame([(None,), ({},), ({"a": Decimal("1.5")},)],
                               "m map<string, decimal(38,18)>")
    c = conform_types(df)
    et = c.schema["m"].dataType.elementType
    assert et.fieldNames() == ["Key", "value"] and et["value"].dataType == T.StringType()
    vals = sorted([r["m"] for r in c.collect()], key=lambda v: -1 if v is None else len(v))
    assert vals[0] is None and vals[1] == [] and vals[2][0]["value"] == "1.500000000000000000"


def test_plan_stays_in_catalyst(spark, scratch, table_name):
    from tessera import read_table, write_table
    df = spark.range(1000).select(
        F.col("id"), (F.col("id") / 7).cast("decimal(38,18)").alias("w"),
        F.struct(F.col("id").alias("a"), F.col("id").cast("decimal(38,18)").alias("b")).alias("s"))
    write_table(df, table_name, encode_decimals=True, path=scratch("plan"))
    q = read_table(spark, table_name).where(F.col("id") == 5).select("id", "s.a")
    assert python_or_rdd_nodes(q) == []
    assert any("EqualTo(id,5)" in p for p in pushed_filters(q))
    schemas = read_schemas(q)
    assert schemas and "w:" not in schemas[0]
    whole = read_table(spark, table_name)
    assert python_or_rdd_nodes(whole) == []
    assert whole.where("id = 7").first()["w"] == Decimal(1)


# ------------------------------------------------------------ round trip property

from hypothesis import HealthCheck, given, settings  # noqa: E402
from hypothesis import strategies as st  # noqa: E402

_dec = st.decimals(min_value=Decimal("-99999999999999999999"),
                   max_value=Decimal("99999999999999999999"), places=18,
                   allow_nan=False, allow_infinity=False)
_shapes = st.sampled_from(["flat", "array", "struct", "array_struct", "map"])


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(shape=_shapes, values=st.lists(st.one_of(st.none(), _dec), min_size=1, max_size=6))
def test_round_trip_property(spark, shape, values):
    """restore(encode(df)) == df for random values in random nested shapes."""
    w = "decimal(38,18)"
    if shape == "flat":
        rows, ddl = [(i, v) for i, v in enumerate(values)], f"id int, x {w}"
    elif shape == "array":
        rows, ddl = [(0, values), (1, None), (2, [])], f"id int, x array<{w}>"
    elif shape == "struct":
        rows = [(i, None if v is None else (v, str(i))) for i, v in enumerate(values)]
        ddl = f"id int, x struct<d: {w}, s: string>"
    elif shape == "array_struct":
        rows = [(0, [(v, "k") for v in values]), (1, None)]
        ddl = f"id int, x array<struct<d: {w}, s: string>>"
    else:
        rows = [(0, {f"k{i}": v for i, v in enumerate(values)}), (1, None)]
        ddl = f"id int, x map<string, {w}>"
    df = spark.createDataFrame(rows, ddl)
    enc = encode_wide_decimals(df)
    assert "decimal" not in enc.schema["x"].dataType.simpleString()
    back = restore_decimals(enc)
    assert back.schema["x"].dataType.simpleString() == df.schema["x"].dataType.simpleString()
    assert back.orderBy("id").collect() == df.orderBy("id").collect()


def test_tag_listing_after_write_and_read(spark, table_name, scratch):
    """Comments of the encoded table and of the restored DataFrame, as rows."""
    from tessera import read_raw, read_table, write_table
    df = spark.createDataFrame([(1, Decimal("1.5"), [Decimal("2")])],
                               "id bigint, p decimal(38,18), a array<decimal(38,18)>")
    df = df.select("id", F.col("p").alias("p", metadata={"comment": "price"}), "a")
    write_table(df, table_name, encode_decimals=True, path=scratch())
    listing = lambda d: [(f.name, f.dataType.simpleString(), comment(d.schema, f.name))
                         for f in d.schema.fields]
    assert listing(read_raw(spark, table_name)) == [
        ("id", "bigint", ""), ("p", "string", f"{TAG}|price"), ("a", "array<string>", TAG)]
    assert listing(read_table(spark, table_name)) == [
        ("id", "bigint", ""), ("p", "decimal(38,18)", f"{TAG}|price"),
        ("a", "array<decimal(38,18)>", TAG)]


def test_conform_on_write_with_varchar_table(spark, table_name, scratch):
    from tessera import create_table, write_table
    spark.sql(f"CREATE TABLE {table_name}_src (v VARCHAR(5), f FLOAT) USING parquet "
              f"LOCATION '{scratch()}'")
    spark.sql(f"INSERT INTO {table_name}_src VALUES ('abc', 1.5)")
    src = spark.table(f"{table_name}_src")
    write_table(src, table_name, conform=True, widen_float=True, path=scratch())
    assert dict(spark.table(table_name).dtypes) == {"v": "string", "f": "double"}


def test_lenient_inside_array_of_struct(spark):
    schema = T.StructType([
        T.StructField("id", T.LongType()),
        T.StructField("items", T.ArrayType(T.StructType([
            T.StructField("sku", T.StringType()),
            T.StructField("price", T.StringType(), True, {"comment": TAG})])), True,
            {"comment": TAG})])
    df = spark.createDataFrame([(1, [("a", "1.5"), ("b", "oops"), None])], schema)
    got = restore_decimals(df, lenient=True).first()["items"]
    assert got[0]["price"] == Decimal("1.5") and got[1]["price"] is None and got[2] is None
    assert got[1]["sku"] == "b"
    with pytest.raises(PySparkException):
        restore_decimals(df).collect()
    from tessera.plans import executed_plan
    assert "lambdafunction" not in executed_plan(restore_decimals(df, lenient=True)).lower()


def test_conform_arrays(spark):
    df = spark.createDataFrame([([1, None], [(1, Decimal("1.5"))], [5])],
                               "a array<int>, s array<struct<i: smallint, w: decimal(38,18)>>, "
                               "b array<tinyint>")
    c = conform_types(df)
    assert c.schema["a"].dataType == T.ArrayType(T.LongType(), True)
    st = c.schema["s"].dataType.elementType
    assert st["i"].dataType == T.LongType() and st["w"].dataType == T.StringType()
    assert st["w"].metadata["comment"] == TAG
    assert c.schema["b"].dataType == T.ArrayType(T.BinaryType(), True)
    r = c.first()
    assert r["a"] == [1, None] and r["s"][0]["w"] == "1.500000000000000000" and r["b"] == [bytes([5])]


def test_path_read_restores_from_footer_schema(spark, scratch):
    from tessera import read_table
    path = scratch("path_read")
    df = spark.createDataFrame([(1, Decimal("7.125"))], "k bigint, p decimal(38,18)")
    encode_wide_decimals(df).write.parquet(path)
    back = read_table(spark, path=path)
    assert back.schema["p"].dataType == T.DecimalType(38, 18)
    assert back.first()["p"] == Decimal("7.125")


@pytest.fixture()
def ansi_off(spark):
    old = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", "false")
    yield
    spark.conf.set("spark.sql.ansi.enabled", old)


def test_text_form_does_not_depend_on_ansi(spark, ansi_off):
    vals = [Decimal("0"), Decimal("1E-18"), Decimal("-0.5"), Decimal("-1E-7"),
            Decimal("12345678901234567890.123456789012345678"), None]
    df = spark.createDataFrame([(i, v, [v], {"k": v}, (v,)) for i, v in enumerate(vals)],
                               "i int, d decimal(38,18), a array<decimal(38,18)>, "
                               "m map<string, decimal(38,18)>, s struct<x: decimal(38,18)>")
    enc = {r["i"]: r for r in encode_wide_decimals(df).collect()}
    want = ["0.000000000000000000", "0.000000000000000001", "-0.500000000000000000",
            "-0.000000100000000000", "12345678901234567890.123456789012345678", None]
    assert [enc[i]["d"] for i in range(6)] == want
    assert [enc[i]["a"][0] for i in range(6)] == want
    assert [enc[i]["m"]["k"] for i in range(6)] == want
    assert [enc[i]["s"]["x"] for i in range(6)] == want
    assert conform_types(df.select("d", "a")).collect()[1]["a"] == ["0.000000000000000001"]
    back = restore_decimals(encode_wide_decimals(df))
    assert back.orderBy("i").collect() == df.orderBy("i").collect()


def test_strict_restore_fails_without_ansi(spark, ansi_off):
    tagged = {"comment": TAG}
    df = spark.createDataFrame([("1.5", ["2.5"]), ("abc", ["x"])], "p string, a array<string>")
    df = df.select(F.col("p").alias("p", metadata=tagged), F.col("a").alias("a", metadata=tagged))
    with pytest.raises(PySparkException):
        restore_decimals(df, columns=["p"]).collect()
    with pytest.raises(PySparkException):
        restore_decimals(df, columns=["a"]).collect()
    lenient = restore_decimals(df, lenient=True).collect()
    assert lenient[1]["p"] is None and lenient[1]["a"] == [None]


def test_names_with_quotes(spark):
    """A backtick or a dot in a name is part of the name."""
    df = spark.sql("SELECT cast(1.5 as decimal(38,18)) AS `a``b`, cast(2 as decimal(38,18)) AS `c.d`")
    enc = encode_wide_decimals(df)
    assert enc.columns == ["a`b", "c.d"] and [f.dataType.simpleString() for f in enc.schema.fields] == ["string", "string"]
    back = restore_decimals(enc)
    assert back.collect() == df.collect() and back.schema["a`b"].dataType == T.DecimalType(38, 18)
    assert conform_types(df).columns == ["a`b", "c.d"]
