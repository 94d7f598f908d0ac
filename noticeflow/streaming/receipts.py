"""Receipts as a stream: each micro-batch goes through the same checks as a batch of receipts, into the same tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from .. import schemas
from ..operators import state
from ..sinks.store import Store

REFUSED = schemas.RECEIPT + ", errors array<string>"


def receipt_stream(spark, path: str) -> DataFrame:
    return spark.readStream.schema(schemas.RECEIPT).json(path)


def to_ledger(receipts: DataFrame, store: Store, mode: str, checkpoint: str) -> StreamingQuery:
    """Appends the rows of new receipts to the store's ledger, and what is wrong to `refused`, with its errors: receipts that don't
    fit the store's payloads or the mode, and those of another payload than the ledger has.

    Both tables move together, with the batch's number, so that a batch that runs again does nothing. Only new rows are written.
    """

    def add(batch: DataFrame, number: int) -> None:
        with store.begin() as commit:
            if int(commit.base.notes.get(checkpoint, -1)) >= number:
                return
            ledger = commit.read("ledger", schemas.LEDGER)
            checked = state.check_receipts(batch, commit.read("payloads"), mode).persist()
            good = checked.where("size(errors) = 0")
            acted = state.replay(good, ledger)
            clash = good.join(acted.where("action = 'conflict'"), ["flow", "candidate_id", "payload_sha256"], "left_semi")
            twice = good.join(acted.select("flow", "candidate_id", F.col("payload_sha256").alias("taken")), ["flow", "candidate_id"]).where("payload_sha256 <> taken").drop("taken")
            other = clash.unionByName(twice).withColumn("errors", F.array(F.lit("another payload was sent")))
            commit.append("ledger", acted.where("action = 'append'"), schemas.LEDGER)
            commit.append("refused", checked.where("size(errors) > 0").unionByName(other), REFUSED)
            commit.note(checkpoint, str(number))
            checked.unpersist()

    return receipts.writeStream.foreachBatch(add).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
