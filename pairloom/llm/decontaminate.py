"""Benchmark decontamination as a prefix-filtered set join with exact containment.

An item's windows are its runs of WINDOW words; an item of fewer words is one window. Words are ordered by rarity: by how
often all documents hold them. Exact containment needs every word of a window, so the prefix of one word, the rarest, is
enough to find each document that holds the window: the positions of an item that are the rarest of some window are its
anchors. A document word equal to an anchor's word fixes by its position where the item would lie; the match is extended word by
word to both sides, as far as a window reaches (the length and positional bounds), and counts if it is as long as a
window. All words of such a match are hit.

Scale: documents are never shuffled nor exploded. Two narrow Arrow passes read them, one that counts the words of the
benchmark (partial sums per task, one row per word after the shuffle) and one that matches. The benchmark goes to the tasks in
blocks of at most BLOCK_WORDS words, which bounds what is broadcast; a larger benchmark makes more passes, and the
spans of the passes are merged per document.

Defined results. Null or empty texts have no words, so nothing is hit, and an item without words is in no document.
Repeated items and repeated item_ids count once; an item with a null id marks words as hit, but is not among the ids. Repeated
documents are each judged on their own. An empty benchmark contaminates nothing. Input columns named as an added column are
replaced.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pairloom.llm.common import utf8, with_columns

WINDOW = 10
BLOCK_WORDS = 2_000_000
ADDED = T.StructType(
    [
        T.StructField("n_words", T.LongType()),
        T.StructField("n_hit", T.LongType()),
        T.StructField("hit_items", T.ArrayType(T.StringType())),
        T.StructField("hit_spans", T.ArrayType(T.LongType())),
    ]
)
#: Bytes of words are digits, lower-case letters and all of non-ASCII characters; A-Z become lower-case.
_KEEP = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def words_of(text: bytes | None) -> list[bytes]:
    """Lower-cased runs of [^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]."""
    return text.translate(_KEEP).split() if text else []


def word_counts(docs: DataFrame, vocabulary: list[bytes]) -> dict[bytes, int]:
    """How often all of `docs` hold each word of the vocabulary, which a block of the benchmark bounds."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(frozenset(vocabulary))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter = Counter()
        for batch in batches:
            for text in utf8(batch.column(0)):
                found.update(filter(shared.value.__contains__, words_of(text)))
        yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.binary()), pa.array(list(found.values()), pa.int64())], names=["word", "n"])

    rows = docs.select("text").mapInArrow(count, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return {bytes(r.word): r.n for r in rows.collect()}


def anchors_of(items: list[list[bytes]], counts: dict[bytes, int], window: int) -> dict[bytes, list[tuple[int, int]]]:
    """word -> (item, position) wherever the word is the rarest of a window; ties go to the smaller word, then to the left."""
    found: dict[bytes, list[tuple[int, int]]] = {}
    for k, words in enumerate(items):
        keys = [(counts.get(w, 0), w, i) for i, w in enumerate(words)]
        size = min(window, len(words))
        for position in sorted({min(keys[s : s + size])[2] for s in range(len(words) - size + 1)}) if words else []:
            found.setdefault(words[position], []).append((k, position))
    return found


def spans_of(words: list[bytes], items: list[list[bytes]], anchors: dict[bytes, list[tuple[int, int]]], window: int) -> tuple[list[tuple[int, int]], set[int]]:
    """Merged half-open spans of the words inside any occurrence of a window, and the items that occur."""
    found, hit, n = [], set(), len(words)
    for i, word in enumerate(words):
        for k, p in anchors.get(word, ()):
            item = items[k]
            need = min(window, len(item))
            # Positional bound: the words that document and item have on both sides of the anchor.
            most_left, most_right = min(i, p, need - 1), min(n - i, len(item) - p, need) - 1
            if most_left + most_right + 1 < need:
                continue
            left = right = 0
            while left < most_left and words[i - left - 1] == item[p - left - 1]:
                left += 1
            while right < most_right and words[i + right + 1] == item[p + right + 1]:
                right += 1
            if left + right + 1 >= need:
                found.append((i - left, i + right + 1))
                hit.add(k)
    return merge(found), hit


def merge(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Spans without overlaps, in order."""
    merged: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if merged and a <= merged[-1][1]:
            merged[-1] = (merged[-1][0], max(b, merged[-1][1]))
        else:
            merged.append((a, b))
    return merged


def blocks_of(benchmark: DataFrame, most: int) -> Iterator[list[tuple[str | None, list[bytes]]]]:
    """The items (id, words), streamed to the driver, in blocks of at most `most` words (a longer item is a block)."""
    block, size = [], 0
    for row in benchmark.select(F.col("item_id").cast("string").alias("id"), "text").distinct().toLocalIterator():
        words = words_of(row.text.encode() if row.text else None)
        if words:
            if block and size + len(words) > most:
                yield block
                block, size = [], 0
            block.append((row.id, words))
            size += len(words)
    if block:
        yield block


def match_block(docs: DataFrame, counted: DataFrame, block: list, window: int, again: bool) -> DataFrame:
    """`docs` with what this block of the benchmark hits; again: and with what blocks before it have hit.

    counted: the documents whose words give the rarity.
    """
    spark = docs.sparkSession
    ids, items = [i for i, _ in block], [w for _, w in block]
    counts = word_counts(counted, sorted({w for words in items for w in words}))
    shared = spark.sparkContext.broadcast((ids, items, anchors_of(items, counts, window)))
    names = [f.name for f in ADDED]
    schema = T.StructType([f for f in docs.schema if f.name not in names] + list(ADDED))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, items, anchors = shared.value
        for batch in batches:
            at = batch.schema.names.index
            n_words, n_hit, hit_ids, spans = [], [], [], []
            before = zip(batch.column(at("hit_items")).to_pylist(), batch.column(at("hit_spans")).to_pylist()) if again else None
            for text in utf8(batch.column(at("text"))):
                words = words_of(text)
                found, hit = spans_of(words, items, anchors, window)
                named = {ids[k] for k in hit} - {None}
                if before is not None:
                    old_items, old = next(before)
                    named |= set(old_items)
                    found = merge([*found, *zip(old[::2], old[1::2])])
                n_words.append(len(words))
                n_hit.append(sum(b - a for a, b in found))
                hit_ids.append(sorted(named))
                spans.append([x for span in found for x in span])
            if n_words:
                yield with_columns(batch, names, [pa.array(n_words, pa.int64()), pa.array(n_hit, pa.int64()), pa.array(hit_ids, pa.list_(pa.string())), pa.array(spans, pa.list_(pa.int64()))])

    return docs.mapInArrow(run, schema)


def find_contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_words: int = BLOCK_WORDS) -> DataFrame:
    """`docs` (text and any other columns) with n_words, n_hit, hit_items (sorted ids) and hit_spans (flat, word positions)."""
    found = None
    for block in blocks_of(benchmark, block_words):
        found = match_block(docs if found is None else found, docs, block, window, found is not None)
    return match_block(docs, docs.limit(0), [], window, False) if found is None else found


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """The documents in which no window of the benchmark occurs; columns of `docs`, whatever their names."""
    packed = docs.select("text", F.struct(*docs.columns).alias("_row"))
    return find_contamination(packed, benchmark, window).filter("n_hit = 0").select("_row.*")


def query(spark, sf_dir: str) -> DataFrame:
    """op4: the contamination of every document."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    found = find_contamination(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("hit_items").cast("long").alias("n_items"),
        F.sha2(F.array_join("hit_items", ",").cast("binary"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


ORACLE = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT DISTINCT CAST(item_id AS VARCHAR) AS item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
bw AS (SELECT item_id, w, least({WINDOW}, len(w)) AS size, unnest(range(1, len(w) - least({WINDOW}, len(w)) + 2)) AS s FROM b WHERE len(w) > 0),
win AS (SELECT DISTINCT item_id, size, array_to_string(list_slice(w, s, s + size - 1), ' ') AS t FROM bw),
sizes AS (SELECT DISTINCT size FROM win),
occ AS (SELECT r, s, size, array_to_string(list_slice(w, s, s + size - 1), ' ') AS t
        FROM (SELECT d.r, d.w, size, unnest(range(1, len(d.w) - size + 2)) AS s FROM d, sizes WHERE len(d.w) >= size)),
hit AS (SELECT DISTINCT o.r, o.s, o.size, win.item_id FROM occ o JOIN win ON o.t = win.t AND o.size = win.size),
words AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(s, s + size)) AS p FROM hit) GROUP BY r),
items AS (SELECT r, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT item_id, ',' ORDER BY item_id) AS ids FROM hit GROUP BY r)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, coalesce(words.n_hit, 0) AS n_hit, coalesce(items.n_items, 0) AS n_items,
       sha256(coalesce(items.ids, '')) AS items_sha256, coalesce(words.n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words ON d.r = words.r LEFT JOIN items ON d.r = items.r
"""
