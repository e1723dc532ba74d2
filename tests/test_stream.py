from fixtures import workbooks as wb
from gridloom import read_workbooks, stream_workbooks


def test_stream_equals_batch(spark, save, tmp_path):
    for i in range(3):
        save(f"in/book{i}.xlsx", wb.varying_types())
    schema, options = "item string, a double, b double, good boolean, ok boolean", {"schemaMatchColumnName": "ok"}
    stream = stream_workbooks(spark, str(tmp_path / "in"), schema, **options)
    assert stream.isStreaming

    def run():
        query = (
            stream.writeStream.format("parquet").option("path", str(tmp_path / "out"))
            .option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start()
        )
        query.awaitTermination()
        return spark.read.schema(stream.schema).parquet(str(tmp_path / "out"))

    batch = read_workbooks(spark, str(tmp_path / "in"), schema, **options)
    assert run().exceptAll(batch).count() == 0
    save("in/late.xlsx", wb.varying_types())
    got = run()
    assert got.count() == 40 and batch.exceptAll(got).count() == 0
