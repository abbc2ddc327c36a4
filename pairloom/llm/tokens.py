"""Token-ID output: blocks of concatenated ids whose document boundaries are Elias-Fano coded.

A file holds blocks; a block holds whole documents, in ascending order of doc_id, and is made of
  header   magic, version, width of an id in bytes, numbers of documents, of documents with a null doc_id, and of ids
  bounds   Elias-Fano code of the documents' ends (counts of ids), with a select structure
  doc_ids  the least doc_id and an Elias-Fano code of the differences to it
  ids      all ids, little-endian, 2 or 4 bytes each

Elias-Fano keeps n ascending numbers below u in about n * (2 + log2(u / n)) bits: the low bits of each, packed, and the high parts
in unary in one bit vector. The end of document i is select1(i) - i for its high part; the position of every 256th one bit is kept,
and from there the search counts the ones of a few bytes. There is no table of 64-bit offsets: whatever reads a document asks the
select structure for its two bounds.

Scale. Documents are dealt by ranges of doc_id (one shuffle) and sorted inside tasks; a task streams its documents and closes a block
at BLOCK_IDS ids, so memory is bounded by a block and the longest document. Files are Parquet tables that hold a block a row,
written by Spark's writer, so that they may lie in any store and a lost task is written anew. Only the blocks' counts, one row per
block, meet in one window.

Defined results. Null and empty texts have only the end id. Null doc_ids come first. Repeated doc_ids are ordered by text, and each row
is written. An empty table writes an empty table. Columns other than doc_id and text are ignored.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pairloom.llm.common import stash, utf8
from pairloom.llm.encoding import encoder

END_ID = 2
BLOCK_IDS = 2_000_000
BLOCK_DOCS = 65_536
MAGIC = b"PLTK"
_HEADER = struct.Struct("<4sBBxxIIQ")
_EF = struct.Struct("<QQBxxxIII")
_STEP = 256
BLOCKS = "shard int, block int, n_docs long, n_ids long, content binary"


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    """Where the installed vocabulary files lie."""
    import public_tokenizers

    return public_tokenizers.path(name)


class EliasFano:
    """Ascending numbers that are not negative; select(i) gives the i-th, decode() gives all."""

    def __init__(self, n: int, low_bits: int, low: bytes, high: bytes, samples: np.ndarray):
        self.n, self.low_bits, self.low, self.high, self.samples = n, low_bits, low, high, samples

    @classmethod
    def encode(cls, values: np.ndarray) -> EliasFano:
        values = np.asarray(values, np.uint64)
        n = len(values)
        top = int(values[-1]) if n else 0
        bits = max(0, (top // n).bit_length() - 1) if n else 0
        low = (values[:, None] >> np.arange(bits, dtype=np.uint64)) & np.uint64(1) if bits else np.zeros((n, 0), np.uint64)
        ones = (values >> np.uint64(bits)).astype(np.int64) + np.arange(n)
        high = np.zeros(int(ones[-1]) + 1 if n else 0, np.uint8)
        high[ones] = 1
        return cls(n, bits, np.packbits(low.astype(np.uint8).ravel(), bitorder="little").tobytes(), np.packbits(high, bitorder="little").tobytes(), ones[::_STEP].astype("<u4"))

    def to_bytes(self) -> bytes:
        return _EF.pack(self.n, 0, self.low_bits, len(self.low), len(self.high), len(self.samples)) + self.low + self.high + self.samples.tobytes()

    @classmethod
    def from_bytes(cls, data: bytes, at: int = 0) -> tuple[EliasFano, int]:
        n, _, bits, a, b, c = _EF.unpack_from(data, at)
        at += _EF.size
        return cls(n, bits, data[at : at + a], data[at + a : at + a + b], np.frombuffer(data, "<u4", c, at + a + b)), at + a + b + 4 * c

    def _low(self, i: int) -> int:
        first, last = i * self.low_bits, (i + 1) * self.low_bits
        return int.from_bytes(self.low[first // 8 : (last + 7) // 8], "little") >> first % 8 & (1 << self.low_bits) - 1

    def select(self, i: int) -> int:
        """The i-th number, by way of the nearest sampled one bit before it, eight bytes at a time."""
        at = int(self.samples[i // _STEP])
        left = i % _STEP
        byte = at // 8
        value = int.from_bytes(self.high[byte : byte + 8], "little") >> at % 8 << at % 8
        while (ones := value.bit_count()) <= left:
            left -= ones
            byte += 8
            value = int.from_bytes(self.high[byte : byte + 8], "little")
        for _ in range(left):
            value &= value - 1
        return (8 * byte + (value & -value).bit_length() - 1 - i << self.low_bits) | self._low(i)

    def decode(self) -> np.ndarray:
        ones = np.flatnonzero(np.unpackbits(np.frombuffer(self.high, np.uint8), bitorder="little"))[: self.n]
        high = (ones - np.arange(self.n)).astype(np.uint64) << np.uint64(self.low_bits)
        if not self.low_bits:
            return high
        bits = np.unpackbits(np.frombuffer(self.low, np.uint8), bitorder="little", count=self.n * self.low_bits).reshape(self.n, self.low_bits)
        return high | (bits.astype(np.uint64) << np.arange(self.low_bits, dtype=np.uint64)).sum(axis=1, dtype=np.uint64)


class Block:
    """A block that was read: documents by position."""

    def __init__(self, content: bytes):
        magic, version, self.width, self.n_docs, self.n_null, self.n_ids = _HEADER.unpack_from(content, 0)
        if magic != MAGIC or version != 1:
            raise ValueError("not a token block")
        self.bounds, at = EliasFano.from_bytes(content, _HEADER.size)
        self.least = struct.unpack_from("<q", content, at)[0]
        self.keys, at = EliasFano.from_bytes(content, at + 8)
        self.ids = np.frombuffer(content, "<u2" if self.width == 2 else "<u4", self.n_ids, at)

    def doc_ids(self) -> list[int | None]:
        return [None] * self.n_null + [self.least + int(x) for x in self.keys.decode()]

    def span(self, i: int) -> tuple[int, int]:
        """Where the ids of document i begin and end: two select operations, no scan."""
        return self.bounds.select(i - 1) if i else 0, self.bounds.select(i)

    def document(self, i: int) -> np.ndarray:
        """The ids of document i."""
        begin, end = self.span(i)
        return self.ids[begin:end]


def write_block(doc_ids: list[int | None], encoded: list[bytes], width: int) -> bytes:
    """The bytes of a block; doc_ids ascending, nulls first."""
    ends = np.cumsum(np.fromiter(map(len, encoded), np.int64, len(encoded))) // width
    known = [x for x in doc_ids if x is not None]
    least = known[0] if known else 0
    header = _HEADER.pack(MAGIC, 1, width, len(doc_ids), len(doc_ids) - len(known), int(ends[-1]) if len(ends) else 0)
    keys = EliasFano.encode(np.array([x - least for x in known], np.uint64))
    return b"".join([header, EliasFano.encode(ends).to_bytes(), struct.pack("<q", least), keys.to_bytes(), *encoded])


def encode_documents(docs: DataFrame, path: str, end_id: int = END_ID, special: bool = True) -> DataFrame:
    """The blocks of all documents: shard and block number them in the order of doc_id."""
    ordered = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, shard, number = encoder(path, special), TaskContext.get().partitionId(), 0
        end = np.array([end_id], encode.dtype).tobytes()
        keys: list[int | None] = []
        parts: list[bytes] = []
        size = 0

        def block() -> pa.RecordBatch:
            content = write_block(keys, parts, encode.width)
            return pa.RecordBatch.from_arrays(
                [pa.array([shard], pa.int32()), pa.array([number], pa.int32()), pa.array([len(keys)], pa.int64()), pa.array([size // encode.width], pa.int64()), pa.array([content], pa.binary())],
                names=["shard", "block", "n_docs", "n_ids", "content"],
            )

        for batch in batches:
            for key, text in zip(batch.column(0).to_pylist(), utf8(batch.column(1))):
                ids = encode(text) + end
                if keys and (size + len(ids) > BLOCK_IDS * encode.width or len(keys) == BLOCK_DOCS):
                    yield block()
                    keys, parts, size, number = [], [], 0, number + 1
                keys.append(key)
                parts.append(ids)
                size += len(ids)
        if keys:
            yield block()

    return ordered.mapInArrow(run, BLOCKS)


def read_documents(blocks: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of each document, all from the blocks; bounds come from the select structure."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard, number, content in zip(*(batch.column(k).to_pylist() for k in range(3))):
                block = Block(content)
                n = block.n_docs
                spans = np.array([block.span(i) for i in range(n)], np.int64).reshape(n, 2)
                crc = [zlib.crc32(block.ids[a:b].astype("<u4").tobytes()) for a, b in spans.tolist()]
                starts = spans[:, 0].copy()
                arrays = [pa.array(np.full(n, shard, np.int32)), pa.array(np.full(n, number, np.int32)), pa.array(block.doc_ids(), pa.int64()), pa.array(starts), pa.array(spans[:, 1] - starts), pa.array(crc, pa.int64())]
                yield pa.RecordBatch.from_arrays(arrays, names=["shard", "block", "doc_id", "_start", "n_tokens", "ids_crc32"])

    found = blocks.select("shard", "block", "content").mapInArrow(run, "shard int, block int, doc_id long, _start long, n_tokens long, ids_crc32 long")
    before = Window.orderBy("shard", "block").rowsBetween(Window.unboundedPreceding, -1)
    base = blocks.select("shard", "block", F.coalesce(F.sum("n_ids").over(before), F.lit(0)).alias("_base"))
    return found.join(base, ["shard", "block"]).select("doc_id", (F.col("_base") + F.col("_start")).alias("start"), "n_tokens", "ids_crc32")


def write_and_read(docs: DataFrame, path: str) -> DataFrame:
    """op6's result for `docs`, read back from the files it writes."""
    return read_documents(stash(encode_documents(docs, path), "token-blocks"))


def query(spark, sf_dir: str) -> DataFrame:
    """op6: the ids of all documents, written and read back."""
    return write_and_read(spark.read.parquet(f"{sf_dir}/documents.parquet"), tokenizer_path())
