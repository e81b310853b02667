"""Lineage of a query log that keeps growing, as a Structured Streaming job.

The reference emits lineage from a post-execution hook, one query at a time, and never
lets a failure break the query. Here the log (files of (stmt_id, ts, sql) rows) is read
with ``readStream``; each micro-batch runs the batch lineage job inside ``foreachBatch``
(the token windows are not time windows, so they belong inside the batch).

Delivery is idempotent within a run and across runs. The stream keeps a state of the keys it has seen, (id, two hashes of
the text), 24 bytes each: a copy that comes in a later batch gives no second record. Each batch writes to its own
``run=ID/batch_id=N`` folder with overwrite, so a replayed batch replaces its own output (the ID is the
checkpoint's, so a new checkpoint over an old sink adds to it). So the records of one run are distinct as they lie in the sink, and a
reader scans them as they are; only where a sink holds several runs does it drop the copies between them.

The state grows with the number of different statements, not with the log's length; it is kept for good, as a time limit would have to
drop late rows or let copies of old ones in. Batches are bounded by bytes.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sqlweave.operators.lineage import lineage
from sqlweave.session import scratch_path
from sqlweave.sources.corpus import sample_statements

#: the state lies in RocksDB's files, not on the heap
STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
LOG_SCHEMA = "stmt_id long, ts timestamp, sql string"


def start_lineage_stream(spark: SparkSession, log_path: str, sink_path: str, checkpoint: str,
                         bytes_per_trigger: int = 1 << 30, available_now: bool = True):
    """Start the stream; returns the StreamingQuery."""
    src = (spark.readStream.schema(LOG_SCHEMA).option("maxBytesPerTrigger", bytes_per_trigger)
           .parquet(log_path))
    # copies of a row go here, whichever batch they come in; another text under a used id is a row of its own
    src = (src.withColumns({"_h1": F.xxhash64("sql"), "_h2": F.xxhash64(F.lit("k2"), "sql")})
           .dropDuplicates(["stmt_id", "_h1", "_h2"]).select("stmt_id", "sql"))
    run: list[str] = []

    def per_batch(batch: DataFrame, batch_id: int) -> None:
        rec = lineage(batch.repartition("stmt_id"), partitioned=True)
        if not run:  # a fixed file of the checkpoint holds the id of the stream
            run.append(json.loads(spark.read.text(f"{checkpoint}/metadata").first()[0])["id"])
        rec.write.mode("overwrite").parquet(f"{sink_path}/run={run[0]}/batch_id={batch_id}")

    w = src.writeStream.foreachBatch(per_batch).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="10 seconds")
    setting = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(setting, None)
    spark.conf.set(setting, STATE_STORE)  # a query keeps the settings it was started with
    try:
        return w.start()
    finally:
        spark.conf.unset(setting) if before is None else spark.conf.set(setting, before)


def runs_of(spark: SparkSession, sink_path: str) -> list[str]:
    """The folders of the runs below a sink, by listing it."""
    path = spark._jvm.org.apache.hadoop.fs.Path(sink_path)
    found = path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).listStatus(path)
    return sorted(str(f.getPath()) for f in found if f.getPath().getName().startswith("run="))


def read_lineage(spark: SparkSession, sink_path: str) -> DataFrame:
    """The records of a sink, each once. One run's records are distinct already; a record of several runs (a log read again under a
    new checkpoint) comes once, as it is a pure function of the statement."""
    rec = spark.read.parquet(sink_path).drop("run", "batch_id")
    return rec if len(runs_of(spark, sink_path)) == 1 else rec.distinct()


def write_query_log(spark: SparkSession, sf_dir: str, path: str, n_files: int | None = None) -> str:
    """The sample statements as a query log of several Parquet files (as many as the data
    has partitions, or exactly ``n_files``, which costs a shuffle)."""
    log = sample_statements(spark, sf_dir).select(
        "stmt_id", F.timestamp_seconds(F.abs(F.col("stmt_id")) * 60).alias("ts"), "sql")
    if n_files:
        log = log.repartition(n_files, "stmt_id")
    log.write.mode("overwrite").parquet(path)
    return path


def stream_lineage(spark, sf):
    base = scratch_path(spark, "stream")
    log = write_query_log(spark, sf, f"{base}/log")
    q = start_lineage_stream(spark, log, f"{base}/sink", f"{base}/checkpoint")
    q.awaitTermination()
    rec = read_lineage(spark, f"{base}/sink")
    csv = [F.array_join(c, ",").alias(c) for c in ("inputs", "outputs", "ctes")]
    return rec.select("stmt_id", "kind", *csv, "parse_ok")


QUERIES = {"stream_lineage": stream_lineage}
