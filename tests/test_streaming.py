"""CSV feeds: schema inference, rescued values, exactly-once ingestion."""

import json
import os
import tempfile

from pyspark.sql import types as T

from govlake.streaming import bronze as streaming


def _write(path, name, text):
    os.makedirs(path, exist_ok=True)
    with open(os.path.join(path, name), "w") as f:
        f.write(text)


def test_infer_schema_and_rescue(spark):
    root = tempfile.mkdtemp(prefix="govlake-feed-", dir="/tmp")
    feed = f"{root}/feed"
    _write(feed, "a.csv", "order_id,amount,order_date\n1,10.50,2024-01-01 10:00:00\n2,3.25,2024-01-02 11:00:00\n")
    schema = streaming.infer_feed_schema(spark, feed)
    kinds = {f.name: type(f.dataType) for f in schema.fields}
    assert kinds["order_id"] is T.IntegerType and kinds["amount"] is T.DoubleType
    assert T.StructType.fromJson(json.loads(schema.json())) == schema  # kept as JSON with the feed

    typed = T.StructType([T.StructField("order_id", T.LongType()), T.StructField("amount", T.DecimalType(18, 2)),
                          T.StructField("note", T.StringType())])
    text = spark.createDataFrame([("1", "10.50", "x"), ("2", "USD 3", None), ("x", "", "z")],
                                 "order_id string, amount string, note string")
    rows = {r["note"]: r for r in streaming.with_rescued(text, typed).collect()}
    assert rows["x"]["_rescued_data"] is None and float(rows["x"]["amount"]) == 10.5
    assert rows[None]["amount"] is None and json.loads(rows[None]["_rescued_data"]) == {"amount": "USD 3"}
    # an empty field is NULL, not a failure; a bad id is rescued
    assert json.loads(rows["z"]["_rescued_data"]) == {"order_id": "x"} and rows["z"]["amount"] is None


def test_each_file_read_once(spark):
    root = tempfile.mkdtemp(prefix="govlake-feed-", dir="/tmp")
    feed, table, ckpt = f"{root}/feed", f"{root}/bronze", f"{root}/ckpt"
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("v", T.DoubleType())])
    _write(feed, "1.csv", "id,v\n1,1.0\n2,2.0\n")
    streaming.ingest(streaming.bronze_stream(spark, feed), schema, table, ckpt)
    streaming.ingest(streaming.bronze_stream(spark, feed), schema, table, ckpt)  # nothing new
    _write(feed, "2.csv", "id,v\n3,3.0\n")
    streaming.ingest(streaming.bronze_stream(spark, feed), schema, table, ckpt)
    ids = sorted(r["id"] for r in spark.read.parquet(table).collect())
    assert ids == [1, 2, 3]


def test_columns_go_by_header_name(spark):
    root = tempfile.mkdtemp(prefix="govlake-feed-", dir="/tmp")
    feed, table, ckpt = f"{root}/feed", f"{root}/bronze", f"{root}/ckpt"
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("amt", T.DoubleType()), T.StructField("note", T.StringType())])
    _write(feed, "1.csv", "id,amt,note\n1,10,x\n")
    _write(feed, "2.csv", 'amt,id,note,channel\n20,2,"y, z",web\nbad,3,,\n')
    _write(feed, "3.csv", "note,id\nw,4\n")
    streaming.ingest(streaming.bronze_stream(spark, feed), schema, table, ckpt)
    rows = {r["id"]: r for r in spark.read.parquet(table).collect()}
    assert (rows[1]["amt"], rows[1]["note"], rows[1]["_rescued_data"]) == (10.0, "x", None)
    assert (rows[2]["amt"], rows[2]["note"]) == (20.0, "y, z") and json.loads(rows[2]["_rescued_data"]) == {"channel": "web"}
    assert rows[3]["amt"] is None and json.loads(rows[3]["_rescued_data"]) == {"amt": "bad"}
    assert (rows[4]["amt"], rows[4]["note"], rows[4]["_rescued_data"]) == (None, "w", None)
