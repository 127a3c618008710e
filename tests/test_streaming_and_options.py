"""Writer options reach the files; the codec works unchanged on a stream."""

from decimal import Decimal

from pyspark.sql import functions as F

import tessera as ts
from tessera.session import unique_name


def test_table_options_reach_files(spark, table_name, scratch):
    df = spark.createDataFrame([(1, "a")], "k bigint, v string")
    ts.write_table(df, table_name, path=scratch(), options={"compression": "gzip"})
    ts.write_table(df, table_name, mode="append")
    files = [r[0] for r in spark.table(table_name).select(F.input_file_name()).collect()]
    assert files and all(f.endswith(".gz.parquet") for f in files)


def test_codec_on_structured_stream(spark, scratch):
    src = scratch("stream_src")
    spark.createDataFrame([(1, Decimal("1.25")), (2, Decimal("2.5"))],
                          "id bigint, p decimal(38,18)").write.parquet(src)
    stream = spark.readStream.schema("id bigint, p decimal(38,18)").parquet(src)
    encoded = ts.encode_wide_decimals(stream)
    assert encoded.isStreaming and dict(encoded.dtypes)["p"] == "string"
    name = unique_name("streamed")
    path = scratch("stream_table")
    q = (encoded.writeStream
         .foreachBatch(lambda batch, _: ts.write_table(batch, name, mode="append", path=path))
         .option("checkpointLocation", scratch("stream_ckpt"))
         .trigger(availableNow=True).start())
    q.awaitTermination(120)
    back = ts.read_table(spark, name)
    assert sorted((r["id"], r["p"]) for r in back.collect()) == [
        (1, Decimal("1.25")), (2, Decimal("2.5"))]
