"""Linking a stream of query-side records with a static pool: micro-batches through the same plans."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from pairloom.operators import blocking
from pairloom.operators.normalize import normalize


def link_batch(batch: DataFrame, pool: DataFrame) -> DataFrame:
    """Candidates of the batch's records (src 1) in a normalised pool. Key frequencies are the pool's, so batches don't change scores."""
    records = normalize(batch).select(*pool.columns).unionByName(pool)
    return blocking.generate_candidates(records).drop("from_extra")


def link_stream(stream: DataFrame, pool: DataFrame, sink: Callable[[DataFrame, int], None], checkpoint: str) -> StreamingQuery:
    """Candidates of each micro-batch of raw records go to `sink` (candidates, batch number); restarts go on from the checkpoint."""
    return stream.writeStream.foreachBatch(lambda batch, number: sink(link_batch(batch, pool), number)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
