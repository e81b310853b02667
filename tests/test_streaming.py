"""The query-log stream equals the batch job, and replaying a batch changes nothing."""

from pyspark.sql import functions as F

from sqlweave.operators.lineage import lineage
from sqlweave.session import scratch_path
from sqlweave.streaming.query_log import STATE_STORE, read_lineage, start_lineage_stream, write_query_log


def test_stream_equals_batch_and_replay_is_idempotent(spark, sf_small):
    base = scratch_path(spark, "t-stream")
    log = write_query_log(spark, sf_small, f"{base}/log", n_files=3)
    q = start_lineage_stream(spark, log, f"{base}/sink", f"{base}/ckpt", bytes_per_trigger=1 << 14)
    q.awaitTermination()
    got = read_lineage(spark, f"{base}/sink")
    want = lineage(spark.read.parquet(log).select("stmt_id", "sql"))
    cols = ["stmt_id", "kind", "inputs", "outputs", "ctes", "parse_ok"]
    rows = lambda df: sorted(tuple(map(str, r)) for r in df.select(cols).collect())
    assert rows(got) == rows(want)
    # duplicate delivery: the same rows arrive again in a new file -> same result
    spark.read.parquet(log).limit(50).write.mode("append").parquet(log)
    q = start_lineage_stream(spark, log, f"{base}/sink", f"{base}/ckpt")
    q.awaitTermination()
    again = read_lineage(spark, f"{base}/sink")
    assert again.count() == want.count()
    # the sink itself holds no copies of later batches: one run is read without a distinct
    assert spark.read.parquet(f"{base}/sink").count() == want.count()
    assert "Aggregate" not in again._jdf.queryExecution().toString()
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass") != STATE_STORE
    assert again.where(F.col("stmt_id").isNull()).count() == 0
    # a new checkpoint over the same sink adds to it, and another text under a used id is kept
    more = f"{base}/more"
    spark.sql("SELECT 1L stmt_id, timestamp '2024-01-01' ts, 'select * from new.t' sql").write.parquet(more)
    q = start_lineage_stream(spark, more, f"{base}/sink", f"{base}/ckpt2")
    q.awaitTermination()
    assert read_lineage(spark, f"{base}/sink").count() == want.count() + 1
    # the whole log once more, in a third run: every record still comes once
    q = start_lineage_stream(spark, log, f"{base}/sink", f"{base}/ckpt3")
    q.awaitTermination()
    assert spark.read.parquet(f"{base}/sink").count() > want.count() + 1
    assert read_lineage(spark, f"{base}/sink").count() == want.count() + 1


def test_processing_time_trigger(spark, sf_small):
    """The continuous form (processing-time trigger) gives the same records."""
    base = scratch_path(spark, "t-stream-cont")
    log = write_query_log(spark, sf_small, f"{base}/log", n_files=2)
    q = start_lineage_stream(spark, log, f"{base}/sink", f"{base}/ckpt", available_now=False)
    q.processAllAvailable()
    q.stop()
    assert read_lineage(spark, f"{base}/sink").count() == spark.read.parquet(log).count()
