"""Token counts from flat token files: a separator scan.

A token file is nothing but ids, with an end-of-document id after each document; it is stored as blocks of BLOCK_IDS ids that are cut
without regard to documents, so a document may reach over any number of blocks. The scan compares a whole block with the
identifier at once. What lies between two separators of a block is counted there; what reaches over a boundary is stitched by
prefix scans over one row per block (its counts of ids and of separators, and its last separator): a document's start is the end of the
last separator before it, whichever block that is in, and its number in the shard is the count of separators before it. Which
doc_id has which number is in files of their own; the token files hold no index of documents.

Scale. Writing shuffles nothing: a shard is what a task reads. Scanning holds one block in memory. The prefix scans run over the blocks
of a shard, so they are spread by shard, and the documents join their block's numbers.

Defined results. Null and empty texts have no ids, so they count 0. Repeated rows count each. A block without a separator only passes on what it
holds. Ids after the last separator of a shard are a document that has no end: scan_counts() returns it with terminated false. An
empty table gives an empty table. Columns other than doc_id and text are ignored. Strings of special tokens in a text are
ordinary text, so the end id never occurs inside a document. Ids take two bytes, or four where the vocabulary has more than 65,536.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pairloom.llm.common import stash, utf8
from pairloom.llm.encoding import encoder
from pairloom.llm.tokens import tokenizer_path

END_OF_DOCUMENT = 50256
BLOCK_IDS = 1 << 20
#: Rows of the two kinds of files: blocks of ids, and the doc_ids of a run of documents, the first of which has number `block` in its shard.
TOKENS, NAMES = "tokens", "names"
_ROW = "kind string, shard int, block long, content binary, doc_ids array<long>"
_NAMES_EACH = 65_536


def write_flat(docs: DataFrame, path: str, end_id: int = END_OF_DOCUMENT, block_ids: int = BLOCK_IDS) -> tuple[DataFrame, DataFrame]:
    """(blocks, names): flat files (shard, block, content), and in files of their own the doc_ids (shard, number, doc_id) in order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, shard, number = encoder(path, False), TaskContext.get().partitionId(), 0
        end, size = np.array([end_id], encode.dtype).tobytes(), block_ids * encode.width
        flat = bytearray()
        ids: list[int | None] = []
        before = 0

        def row(kind: str, k: int, content: bytes | None, doc_ids: list | None) -> pa.RecordBatch:
            arrays = [pa.array([kind]), pa.array([shard], pa.int32()), pa.array([k], pa.int64()), pa.array([content], pa.binary()), pa.array([doc_ids], pa.list_(pa.int64()))]
            return pa.RecordBatch.from_arrays(arrays, names=["kind", "shard", "block", "content", "doc_ids"])

        for batch in batches:
            for key, text in zip(batch.column(0).to_pylist(), utf8(batch.column(1))):
                flat += encode(text) + end
                at = 0
                while len(flat) - at > size:
                    yield row(TOKENS, number, bytes(flat[at : at + size]), None)
                    at, number = at + size, number + 1
                if at:
                    del flat[:at]
                ids.append(key)
                if len(ids) == _NAMES_EACH:
                    yield row(NAMES, before, None, ids)
                    before, ids = before + len(ids), []
        if flat:
            yield row(TOKENS, number, bytes(flat), None)
        if ids:
            yield row(NAMES, before, None, ids)

    written = stash(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, _ROW), "flat-tokens", "kind")
    names = written.filter(F.col("kind") == NAMES).select("shard", "block", F.posexplode("doc_ids").alias("place", "doc_id"))
    blocks = written.filter(F.col("kind") == TOKENS).select("shard", F.col("block").cast("int").alias("block"), "content")
    return blocks, names.select("shard", (F.col("block") + F.col("place")).alias("number"), "doc_id")


def scan_counts(blocks: DataFrame, end_id: int = END_OF_DOCUMENT, width: int = 2) -> DataFrame:
    """(shard, number, start, n_tokens, terminated) of every document of flat blocks (shard, block, content) of ids of `width` bytes.

    number counts the separators of a shard from 0 (null: no separator); n_tokens leaves the separator out; start is the position in the shard.
    """

    def separators(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard, number, content in zip(*(batch.column(k) for k in range(3))):
                ids = np.frombuffer(content.as_buffer(), f"<u{width}")
                ends = np.flatnonzero(ids == end_id)
                before = np.concatenate(([-1], ends))[: len(ends)]
                # The last row, with place -1, is the block's own: its count of ids and its last separator.
                place = np.concatenate((np.arange(len(ends)), [-1]))
                arrays = [np.full(len(place), shard.as_py(), np.int32), np.full(len(place), number.as_py(), np.int32), place.astype(np.int32), np.concatenate((ends, [len(ids)])), np.concatenate((before, [ends[-1] if len(ends) else -1])), np.full(len(place), len(ends))]
                yield pa.RecordBatch.from_arrays(list(map(pa.array, arrays)), names=["shard", "block", "place", "end", "before", "n"])

    found = stash(blocks.select("shard", "block", "content").mapInArrow(separators, "shard int, block int, place int, end long, before long, n long"), "separators")
    earlier = Window.partitionBy("shard").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    last = Window.partitionBy("shard")
    sizes = found.filter("place = -1").select("shard", "block", F.col("end").alias("_n"), "before", "n")
    sizes = sizes.withColumns({"_base": F.coalesce(F.sum("_n").over(earlier), F.lit(0)), "_first": F.coalesce(F.sum("n").over(earlier), F.lit(0))})
    sizes = sizes.withColumn("_last", F.when(F.col("before") >= 0, F.col("_base") + F.col("before")))
    sizes = sizes.withColumns({"_carry": F.coalesce(F.max("_last").over(earlier), F.lit(-1)), "_ids": F.sum("_n").over(last), "_final": F.coalesce(F.max("_last").over(last), F.lit(-1)), "_number": F.max("block").over(last)})
    joined = found.filter("place >= 0").drop("n").join(sizes.select("shard", "block", "_base", "_first", "_carry"), ["shard", "block"])
    start = F.when(F.col("before") >= 0, F.col("_base") + F.col("before")).otherwise(F.col("_carry")) + 1
    documents = joined.select("shard", (F.col("_first") + F.col("place")).alias("number"), start.alias("start"), (F.col("_base") + F.col("end") - start).alias("n_tokens"), F.lit(True).alias("terminated"))
    rest = sizes.filter("block = _number AND _final + 1 < _ids").select("shard", F.lit(None).cast("long").alias("number"), (F.col("_final") + 1).alias("start"), (F.col("_ids") - F.col("_final") - 1).alias("n_tokens"), F.lit(False).alias("terminated"))
    return documents.unionByName(rest)


def count_tokens(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, n_tokens) of every row of `docs`, from flat files that are written and scanned."""
    blocks, names = write_flat(docs, path)
    return scan_counts(blocks, width=encoder(path, False).width).join(names, ["shard", "number"]).select("doc_id", "n_tokens")


def query(spark, sf_dir: str) -> DataFrame:
    """op10: the count of ids of every document."""
    return count_tokens(spark.read.parquet(f"{sf_dir}/documents.parquet"), tokenizer_path())
