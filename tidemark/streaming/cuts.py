"""Process cuts as their manifest rows arrive.

A deletion is the absence of a row, so one step must see one whole cut. The stream
therefore carries manifest rows, each written after its cut is complete, and not the
cut's own files: those arrive in file order and possibly in pieces. A step handles its
cuts in date order.

A stream that breaks off hands its last batch over again. Every run record names the stream
and the batch that brought the cut, so the cuts of a batch that were published or refused
before the break are known before anything is read or judged. A cut that comes too late is
refused: it is left in ``store.failures()`` and does not stop the stream.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.model import REFUSED, Cut
from tidemark.plans.pipeline import process_cut
from tidemark.sources.cuts import OutOfOrderError
from tidemark.sources.store import Store

MANIFEST_SCHEMA = "cut_label string, file string, cut_date date"


def manifest_stream(spark: SparkSession, folder: str) -> DataFrame:
    return spark.readStream.schema(MANIFEST_SCHEMA).json(folder)


def unfinished(store: Store, rows: DataFrame, stream: str, batch: int) -> DataFrame:
    """Manifest rows of a batch without those it had published or refused before."""
    refused = store.failures().filter(F.col("status") == REFUSED)
    seen = ["cut_label", "cut_date", "stream", "batch"]
    done = store.records().select(*seen).unionByName(refused.select(*seen)).filter(
        (F.col("stream") == stream) & (F.col("batch") == batch))
    return rows.join(done, ["cut_label", "cut_date"], "left_anti")


def process_manifest(spark: SparkSession, store: Store, rows: DataFrame,
                     stream: str | None = None, batch: int | None = None, **options) -> None:
    """Processes the cuts named by a small batch of manifest rows, oldest first. With the name
    of its stream and its number, a batch may be handed over any number of times."""
    todo = rows if stream is None else unfinished(store, rows, stream, batch)
    for r in todo.orderBy(F.col("cut_date"), F.col("cut_label")).collect():
        try:
            process_cut(spark, store, Cut(r["cut_label"], r["file"], r["cut_date"]),
                        stream=stream, batch=batch, **options)
        except OutOfOrderError:
            pass  # recorded as refused


# The local property in which Spark names the running stream; its checkpoint keeps the name.
_STREAM = "sql.streaming.queryId"


def stream_cuts(spark: SparkSession, store: Store, manifest_folder: str,
                checkpoint: str, **options) -> StreamingQuery:
    """Starts a run over every manifest row not seen yet; it ends when none is left."""
    def step(rows: DataFrame, batch: int) -> None:
        stream = spark.sparkContext.getLocalProperty(_STREAM) or checkpoint
        process_manifest(spark, store, rows, stream, batch, **options)

    return (manifest_stream(spark, manifest_folder).writeStream
            .foreachBatch(step).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())
