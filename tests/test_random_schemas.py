"""restore(encode(df)) == df for random nested schemas and random rows."""

import random
from decimal import Decimal

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import types as T

from tessera.functions import encode_wide_decimals, restore_decimals

LEAVES = [T.DecimalType(38, 18), T.DecimalType(20, 10), T.DecimalType(10, 2),
          T.IntegerType(), T.StringType()]


def random_type(rng: random.Random, depth: int) -> T.DataType:
    kind = rng.choice(["leaf", "leaf", "struct", "array", "map"] if depth < 3 else ["leaf"])
    if kind == "leaf":
        return rng.choice(LEAVES)
    if kind == "struct":
        return T.StructType([T.StructField(f"f{i}", random_type(rng, depth + 1))
                             for i in range(rng.randint(1, 3))])
    if kind == "array":
        inner = random_type(rng, depth + 1)
        while isinstance(inner, T.ArrayType):       # array of array is rejected
            inner = random_type(rng, depth + 1)
        return T.ArrayType(inner)
    return T.MapType(T.StringType(), random_type(rng, depth + 1))


def random_value(rng: random.Random, dt: T.DataType):
    if rng.random() < 0.15:
        return None
    if isinstance(dt, T.DecimalType):
        digits = dt.precision - dt.scale
        unscaled = rng.randint(-(10 ** (digits + dt.scale) - 1), 10 ** (digits + dt.scale) - 1)
        return Decimal(unscaled).scaleb(-dt.scale)
    if isinstance(dt, T.IntegerType):
        return rng.randint(-1000, 1000)
    if isinstance(dt, T.StringType):
        return rng.choice(["", "a", "12.5", "x y"])
    if isinstance(dt, T.StructType):
        return tuple(random_value(rng, f.dataType) for f in dt.fields)
    if isinstance(dt, T.ArrayType):
        return [random_value(rng, dt.elementType) for _ in range(rng.randint(0, 3))]
    return {f"k{i}": random_value(rng, dt.valueType) for i in range(rng.randint(0, 3))}


@settings(max_examples=25, deadline=None, suppress_health_check=list(HealthCheck))
@given(seed=st.integers(0, 10 ** 9))
def test_round_trip_random_schema(spark, seed):
    rng = random.Random(seed)
    schema = T.StructType([T.StructField("id", T.IntegerType())] +
                          [T.StructField(f"c{i}", random_type(rng, 1))
                           for i in range(rng.randint(1, 3))])
    rows = [(i,) + tuple(random_value(rng, f.dataType) for f in schema.fields[1:])
            for i in range(6)]
    df = spark.createDataFrame(rows, schema)
    enc = encode_wide_decimals(df)
    assert "decimal(38,18)" not in enc.schema.simpleString()
    assert "decimal(20,10)" not in enc.schema.simpleString()
    back = restore_decimals(enc)
    # wide decimals come back as decimal(38,18); everything else as it was
    want = df.schema.simpleString().replace("decimal(20,10)", "decimal(38,18)")
    assert back.schema.simpleString() == want
    got = {r["id"]: r for r in back.collect()}
    for r in df.collect():
        assert _same(got[r["id"]], r, schema)


def _same(a, b, dt) -> bool:
    """Equal after restoring, where every wide decimal comes back as (38,18)."""
    if a is None or b is None:
        return a is None and b is None
    if isinstance(dt, T.DecimalType):
        return Decimal(a) == Decimal(b)
    if isinstance(dt, T.StructType):
        return all(_same(a[i], b[i], f.dataType) for i, f in enumerate(dt.fields))
    if isinstance(dt, T.ArrayType):
        return len(a) == len(b) and all(_same(x, y, dt.elementType) for x, y in zip(a, b))
    if isinstance(dt, T.MapType):
        return a.keys() == b.keys() and all(_same(a[k], b[k], dt.valueType) for k in a)
    return a == b


def _has_array_of_map(dt: T.DataType) -> bool:
    if isinstance(dt, T.ArrayType):
        return isinstance(dt.elementType, T.MapType) or _has_array_of_map(dt.elementType)
    if isinstance(dt, T.StructType):
        return any(_has_array_of_map(f.dataType) for f in dt.fields)
    if isinstance(dt, T.MapType):
        return _has_array_of_map(dt.valueType)
    return False


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(seed=st.integers(0, 10 ** 9))
def test_conform_random_schema(spark, seed):
    """Conforming either rejects an array of maps or keeps every row, all nullable."""
    import pytest
    from tessera.functions import UnsupportedTypeError, conform_types
    rng = random.Random(seed)
    schema = T.StructType([T.StructField("id", T.IntegerType())] +
                          [T.StructField(f"c{i}", random_type(rng, 1))
                           for i in range(rng.randint(1, 3))])
    rows = [(i,) + tuple(random_value(rng, f.dataType) for f in schema.fields[1:])
            for i in range(5)]
    df = spark.createDataFrame(rows, schema)
    if any(_has_array_of_map(f.dataType) for f in schema.fields):
        with pytest.raises(UnsupportedTypeError):
            conform_types(df)
        return
    out = conform_types(df)
    text = out.schema.simpleString()
    assert "map<" not in text and "decimal(38,18)" not in text and ":int" not in text
    assert sorted(r["id"] for r in out.collect()) == list(range(5))
