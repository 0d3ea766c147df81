from conftest import tuples

from callspark.functions import redaction as R
from callspark.functions import text as X


def test_column_functions_on_a_stream(spark, tmp_path):
    rows = [("call 212-555-0187 now",), ("one two three",)]
    spark.createDataFrame(rows, "text string").write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema("text string").parquet(f"{tmp_path}/in")
    result = stream.select(R.redact_text("text").alias("text"), X.token_count("text").alias("n"))
    query = result.writeStream.format("memory").queryName("redacted_stream").outputMode("append").option(
        "checkpointLocation", f"{tmp_path}/state"
    ).start()
    query.processAllAvailable()
    query.stop()
    assert tuples(spark.table("redacted_stream")) == [("[REDACTED]", 3), ("call <***> now", 3)]
