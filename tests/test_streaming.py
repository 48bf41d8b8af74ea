"""Streams over folders give what a batch gives."""

from pyspark.sql import functions as F

from loamworks.streaming import shards


def test_counts_equal_batch(spark, tmp_path):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "source", "text")
    src = str(tmp_path / "in")
    docs.repartition(3).write.parquet(src)
    stream = shards.counted(shards.documents(spark, src, "doc_id long, source string, text string"))
    q = stream.writeStream.format("memory").queryName("counted").outputMode("complete").option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
    q.awaitTermination(120)
    want = {tuple(r) for r in docs.groupBy("source").agg(F.count("*"), F.sum(F.length("text"))).collect()}
    assert {tuple(r) for r in spark.sql("select * from counted").collect()} == want


def test_packing_loses_nothing(spark, tmp_path):
    src, out = str(tmp_path / "in"), str(tmp_path / "out")
    rows = [(i % 2, [i] * (1 + i % 9)) for i in range(200)]
    spark.createDataFrame(rows, "rank long, ids array<int>").repartition(4).write.parquet(src)
    stream = shards.packed(shards.documents(spark, src, "rank long, ids array<int>"), 16, 0, pad=-1)
    q = stream.writeStream.foreachBatch(shards.once_a_batch(out)).option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
    q.awaitTermination(120)
    got = sorted(x for r in spark.read.parquet(out).collect() for x in r.ids if x >= 0)
    assert got == sorted(x for _, ids in rows for x in ids)
