"""Land API pages continuously as they arrive in an inbox folder (K4, streaming).

The batch loader lands one response per run. When a fetcher drops page files
into an inbox instead, ``stream_pages_to_landing`` picks them up with a file
stream (declared schema, no inference), flattens them with the endpoint's
flattener and lands every micro-batch as its own run of the landing table.

Exactly-once on restart: the attempt that claims a batch's run is named by the stream and the batch id. The
batch id comes from the stream's checkpoint, and the stream's name and day are kept beside it from the first
start on, so a batch replayed after a lost executor or driver finds its claim and rewrites its own run
instead of appending a copy, while runs of loaders and other streams are never touched. A stream lands
under the day of its first start; a new checkpoint folder begins a new day. Downstream dedupe treats runs
as usual.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.operators.flatten import flatten
from tidemark.session import create_new, read_text
from tidemark.sinks import landing as L
from tidemark.sources.pages import explode_pages, parse_pages


def _identity(spark: SparkSession, day_id: int, checkpoint_dir: str) -> tuple[int, str]:
    """(day, name) of the stream, as its first start wrote them beside the checkpoint."""
    kept = f"{checkpoint_dir.rstrip('/')}_stream"
    create_new(spark, kept, f"{int(day_id)} {L.new_attempt()}")
    day, name = read_text(spark, kept).split()
    return int(day), name


def stream_pages_to_landing(spark: SparkSession, inbox: str, endpoint: str, lt: L.LandingTable,
                            day_id: int, checkpoint_dir: str, max_files_per_trigger: int | None = None,
                            available_now: bool = True) -> StreamingQuery:
    """Start the stream; with ``available_now`` it stops when the inbox is drained."""
    day_id, name = _identity(spark, day_id, checkpoint_dir)
    reader = spark.readStream
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    pages = reader.text(inbox)

    def land_batch(batch: DataFrame, batch_id: int) -> None:
        if batch.isEmpty():
            return
        attempt = f"{name}/{int(batch_id)}"
        run = L.claim_run(spark, lt, day_id, attempt)
        # A file may be one task's; its pages are spread over the tasks that parse and write, not its records.
        spread = batch.withColumn("place", F.xxhash64("value")).hint("rebalance", "place")
        records = flatten(explode_pages(parse_pages(spread.select("value"), endpoint, "value")), endpoint)
        if L.append_run(records, lt, day_id, run, attempt, spread=False):
            L.register_run(spark, lt, day_id, run)  # the caller's session, whose listing is refreshed
        else:
            L.release_run(spark, lt, day_id, run, attempt)

    writer = pages.writeStream.foreachBatch(land_batch).option("checkpointLocation", checkpoint_dir)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()
