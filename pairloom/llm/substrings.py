"""Exact removal of repeated 100-byte strings by prefix-free parsing and suffix arrays.

A byte goes if a string of LENGTH bytes that covers it also starts earlier in the corpus: in a document of smaller
doc_id, or earlier in the same one.

Parse and dictionary. The trigger of a LENGTH-byte string is the one of its GRAM-byte strings with the least rolling hash (the
first of equal ones), so it depends on the string's bytes alone. Neighbouring starts that share a trigger make a phrase: the bytes their strings
cover. A document is parsed to its phrases; each overlaps the next one by LENGTH - 1 bytes, so every string lies in one phrase, and equal
strings lie in phrases of the same trigger. The dictionary holds the distinct phrases, and of each one its first place in the
corpus. A run of one phrase over and over (texts with a short period) is one entry of the parse, with its length.
  1. A phrase whose trigger occurs in no other entry of the parse holds no repeated string, and leaves at once.
  2. All strings of a phrase's later occurrences are repeats.
  3. For the first occurrences, suffixes of the dictionary are sorted: each to its first LENGTH bytes, which is where order and
     equality matter. The order is found by doubling (8, 16, 32, 64, LENGTH bytes) over all phrases of a shard; shards are made by trigger, so suffixes
     that are equal to LENGTH bytes meet. Neighbours in the suffix array that agree in LENGTH bytes form a class. The parse,
     sorted by phrase and place, gives each dictionary phrase its rank in corpus order; a class's first member by that rank stays, the
     others are repeats. As phrases overlap by LENGTH - 1, one phrase of the parse is all that has to be compared.

Scale. Hashes are numpy over blocks of bytes, linear in the text. What is shuffled is in proportion to the triggers (one per some 35
bytes), and after rule 1 to the repeated part of the corpus; whole texts are shuffled twice, in pieces of PIECE bytes to cut dictionary
phrases and once for the result. Counts and first places are made before shuffles, and joins back to occurrences are plain
joins, whose skewed keys AQE splits. A trigger with more than SHARD different phrases is dealt to several shards; of
those, only the first of each class goes on, to an aggregation over all shards by 128 bits of hash of the string. So no task holds a group. What
is removed of a phrase is one span, as its strings overlap; spans of a document are merged by a sort before they are put beside its text.

Defined results. Null and empty texts have no bytes. Texts shorter than LENGTH lose nothing. Documents of equal doc_id (or null doc_id, which
come first) are ordered by their text's hash; of wholly equal rows one counts as the first, and all of them get the result of the one:
repeated rows are told apart from other documents, not from each other. An empty table gives an empty table. Columns other than
doc_id and text are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pairloom.llm.common import discard, stash, utf8

LENGTH = 100
GRAM = 32
#: Phrases of a shard, about.
SHARD = 8192
#: Bytes of the pieces that documents are dealt in where phrases are cut out of them.
PIECE = 1 << 16
_BLOCK = 1 << 18
_PART = 1 << 22
#: Places inside a block take these bits, whatever its length; hashes are compared by the others.
_PLACE = np.uint64((1 << 24) - 1)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xBF58476D1CE4E5B9)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(29))) * _MIX
    return h ^ (h >> np.uint64(32))


def _power(base: np.uint64, n: int) -> np.uint64:
    return np.uint64(pow(int(base), n, 1 << 64))


def gram_hashes(x: np.ndarray, size: int) -> np.ndarray:
    """Rolling hashes of all strings of `size` bytes (a power of two), by doubling."""
    h, n = _mixed(x.astype(np.uint64) + np.uint64(1)), 1
    while n < size:
        h = h[: len(h) - n] * _power(_BASE, n) + h[n:]
        n *= 2
    return _mixed(h)


def phrases(x: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The runs of starts that share a trigger: first start, number of starts, place of the trigger, its hash.

    x: bytes of documents put together; ends: where each ends. Strings that reach over an end are no strings.
    """
    grams = gram_hashes(x, GRAM)
    h = (grams & ~_PLACE) | np.arange(len(grams), dtype=np.uint64)
    # Least value in each window of LENGTH - GRAM + 1 grams, by doubling; its low bits are the place.
    window, size = LENGTH - GRAM + 1, 1
    while 2 * size <= window:
        h = np.minimum(h[: len(h) - size], h[size:])
        size *= 2
    if size < window:
        h = np.minimum(h[: len(h) - (window - size)], h[window - size :])
    inside = np.ones(len(h), bool)
    for end in ends[:-1].tolist():
        inside[max(0, end - LENGTH + 1) : end] = False
    starts = np.flatnonzero(inside)
    t = (h[starts] & _PLACE).astype(np.int64)
    new = np.flatnonzero(np.concatenate(([True], (t[1:] != t[:-1]) | (starts[1:] != starts[:-1] + 1))))
    return starts[new], np.diff(np.concatenate((new, [len(starts)]))), t[new], grams[t[new]].view(np.int64)


def run_again(x: np.ndarray, start: np.ndarray, n: np.ndarray, trigger: np.ndarray, key: np.ndarray) -> np.ndarray:
    """Which phrases are the same as the phrase right before them: all but the first of a run."""
    again = np.zeros(len(start), bool)
    again[1:] = (key[1:] == key[:-1]) & (n[1:] == n[:-1]) & (trigger[1:] - start[1:] == trigger[:-1] - start[:-1]) & (start[1:] == start[:-1] + n[:-1])
    found = np.flatnonzero(again)
    for size in np.unique(n[found]).tolist():
        whole = np.lib.stride_tricks.sliding_window_view(x, size + LENGTH - 1)
        own = found[n[found] == size]
        for k in range(0, len(own), 4096):
            some = own[k : k + 4096]
            again[some] = (whole[start[some]] == whole[start[some - 1]]).all(axis=1)
    return again


def blocks_of(texts: list[bytes | None]) -> Iterator[tuple[bytes, np.ndarray, np.ndarray, np.ndarray]]:
    """Blocks of texts: bytes, where texts end, their rows, their offsets. A long text comes in parts that share LENGTH - 1 bytes."""
    rows: list[int] = []
    parts: list[bytes] = []
    offsets: list[int] = []
    size = 0

    def block():
        return b"".join(parts), np.cumsum([len(p) for p in parts]), np.array(rows), np.array(offsets)

    for row, text in enumerate(texts):
        for at in range(0, len(text) - LENGTH + 1, _PART) if text else ():
            part = text[at : at + _PART + LENGTH - 1]
            if size and size + len(part) > _BLOCK:
                yield block()
                rows, parts, offsets, size = [], [], [], 0
            rows.append(row)
            parts.append(part)
            offsets.append(at)
            size += len(part)
    if parts:
        yield block()


def _hash(data: bytes) -> bytes:
    return xxhash.xxh3_64_digest(data)


def _longs(digests: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(digests), np.int64)


#: An entry of the parse: trigger's hash, phrase's hash (null: a run that repeats the phrase before it), first start and number of starts.
_ENTRY = "key long, full long, doc_id long, copy long, start long, n long"
_ENTRY_COLUMNS = ["key", "full", "doc_id", "copy", "start", "n"]
_SPAN = ("doc_id", "copy", "start", "stop")


def triggers(docs: DataFrame) -> DataFrame:
    """(key): the hash of the trigger of each entry of the parse, but for runs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for data, ends, _, _ in blocks_of(utf8(batch.column(0))):
                x = np.frombuffer(data, np.uint8)
                start, n, trigger, key = phrases(x, ends)
                yield pa.RecordBatch.from_arrays([pa.array(key[~run_again(x, start, n, trigger, key)])], names=["key"])

    return docs.select("text").mapInArrow(run, "key long")


def parse(docs: DataFrame) -> DataFrame:
    """The entries of the parse of all documents (doc_id, copy, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for data, ends, rows, offsets in blocks_of(utf8(batch.column(2))):
                x = np.frombuffer(data, np.uint8)
                start, n, trigger, key = phrases(x, ends)
                again = run_again(x, start, n, trigger, key)
                # An entry is a phrase, or all phrases of a run but its first one.
                entry = np.flatnonzero(~again | ~np.concatenate(([False], again[:-1])))
                stop = start + n
                last = stop[np.concatenate((entry[1:], [len(start)])) - 1]
                first = start[entry]
                phrase = ~again[entry]
                full = np.zeros(len(entry), np.int64)
                full[phrase] = _longs([_hash(data[a:b]) for a, b in zip(first[phrase].tolist(), (last[phrase] + LENGTH - 1).tolist())])
                part = np.searchsorted(ends, first, side="right")
                shift = offsets[part] - np.concatenate(([0], ends))[part]
                row = pa.array(rows[part])
                arrays = [pa.array(key[entry] ^ np.where(phrase, 0, first)), pa.array(full, mask=~phrase), batch.column(0).take(row), batch.column(1).take(row), pa.array(first + shift), pa.array(last - first)]
                yield pa.RecordBatch.from_arrays(arrays, names=_ENTRY_COLUMNS)

    return docs.select("doc_id", "copy", "text").mapInArrow(run, _ENTRY)


def _span(start="start", n="n") -> list:
    """The bytes that strings from `start` on cover."""
    return ["doc_id", "copy", F.col(start).alias("start"), (F.col(start) + F.col(n) + (LENGTH - 1)).alias("stop")]


def _place():
    """Where a string starts; structs compare field by field, null doc_ids first."""
    return F.struct("doc_id", "copy", "start")


def parsed(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(spans, rest): spans of later occurrences and of runs; first occurrences of phrases that share their trigger with others.

    rest: key, full, p (how many phrases have the trigger), doc_id, copy, start, n.
    """
    # Tables of their own before joins: a join with them shuffles both sides anew, so AQE can split a key that very many rows have.
    several = stash(triggers(docs).groupBy(F.col("key").alias("_k")).agg(F.count("*").alias("_n")).filter("_n > 1").select("_k"), "keys")
    shared = parse(docs).join(several, F.col("key") == F.col("_k"), "left").filter("_k IS NOT NULL OR full IS NULL").drop("_k")
    shared = stash(shared, "parse")
    discard(several)
    occurrences = shared.filter("full IS NOT NULL")
    first = occurrences.groupBy(F.col("key").alias("_k"), F.col("full").alias("_f")).agg(F.min(F.struct("doc_id", "copy", "start", "n")).alias("first"), F.count("*").alias("_n"))
    dictionary = stash(first, "dictionary")
    # Phrases that occur once are first occurrences: only the others are looked up.
    again = dictionary.filter("_n > 1").select("_k", "_f", "first")
    later = occurrences.join(again, (F.col("key") == F.col("_k")) & (F.col("full") == F.col("_f")))
    later = later.filter(~_place().eqNullSafe(F.struct("first.doc_id", "first.copy", "first.start"))).select(*_span())
    spans = stash(later.unionByName(shared.filter("full IS NULL").select(*_span())), "spans")
    many = stash(dictionary.groupBy(F.col("_k").alias("key")).agg(F.count("*").alias("p")).filter("p > 1"), "keys")
    rest = stash(dictionary.join(many, F.col("_k") == F.col("key")).select("key", F.col("_f").alias("full"), "p", "first.*"), "rest")
    discard(shared, dictionary, many)
    return spans, rest


def cut(docs: DataFrame, rest: DataFrame) -> DataFrame:
    """`rest` with the bytes of each phrase. Documents are dealt in pieces, so a row holds the phrases of a piece at most."""
    reach = 2 * LENGTH  # a phrase has fewer bytes than that
    size = F.octet_length("text")
    n_pieces = F.greatest(F.lit(0), F.floor((size - LENGTH) / PIECE)).cast("int")
    long = F.transform(F.sequence(F.lit(0), n_pieces), lambda i: F.struct(i.cast("long").alias("piece"), F.substring(F.col("text").cast("binary"), i * PIECE + 1, F.lit(PIECE + reach)).alias("data")))
    pieces = docs.filter(size >= LENGTH).select("doc_id", "copy", F.explode(long).alias("p")).select("doc_id", "copy", "p.piece", "p.data")
    own = rest.groupBy(F.col("doc_id").alias("_d"), F.col("copy").alias("_c"), F.expr(f"start div {PIECE}").alias("_p")).agg(F.collect_list(F.struct("key", "full", "p", "start", "n")).alias("own"))
    joined = pieces.join(own, F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("copy") == F.col("_c")) & (F.col("piece") == F.col("_p")))
    names = ["doc_id", "copy", "key", "full", "p", "start", "n", "phrase"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = batch.column(4)
            row = np.repeat(np.arange(len(own)), np.asarray(own.value_lengths()))
            entries = own.flatten()
            start, n = np.asarray(entries.field("start")), np.asarray(entries.field("n"))
            data, at = batch.column(3).to_pylist(), (start % PIECE).tolist()
            found = [data[r][a:b] for r, a, b in zip(row.tolist(), at, (start % PIECE + n + LENGTH - 1).tolist())]
            row = pa.array(row)
            yield pa.RecordBatch.from_arrays([batch.column(0).take(row), batch.column(1).take(row), *(entries.field(c) for c in ("key", "full", "p", "start", "n")), pa.array(found, pa.binary())], names=names)

    return joined.select("doc_id", "copy", "piece", "data", "own").mapInArrow(run, "doc_id long, copy long, key long, full long, p long, start long, n long, phrase binary")


def suffix_array(data: np.ndarray, starts: np.ndarray, length: int = LENGTH) -> tuple[np.ndarray, np.ndarray]:
    """Indices of `starts` in the order of the `length` bytes (64 to 128) from each on, and where in that order a class of equal ones begins."""
    padded = np.concatenate([data, np.zeros(length + 8, np.uint8)])
    rank = np.lib.stride_tricks.sliding_window_view(padded, 8)[: len(data)].copy().view(">u8").ravel().astype(np.uint64)
    size = 8
    rank = np.unique(rank, return_inverse=True)[1].astype(np.uint64)
    wide = np.uint64(len(data) + 1)
    while 2 * size < length:
        after = np.concatenate([rank[size:], np.zeros(min(size, len(rank)), np.uint64)])
        rank = np.unique(rank * wide + after, return_inverse=True)[1].astype(np.uint64)
        size *= 2
    last = rank[starts] * wide + rank[np.minimum(starts + (length - size), len(rank) - 1)]
    order = np.argsort(last, kind="stable")
    return order, np.flatnonzero(np.concatenate(([True], last[order][1:] != last[order][:-1])))


def search_shard(table: pa.Table, most: int = SHARD) -> pa.Table:
    """Spans of repeats among the dictionary phrases of a shard; of shards that split a trigger also the first of each class, with its hash."""
    column = {name: table.column(name).combine_chunks() for name in table.column_names}
    texts = column["phrase"].to_pylist()
    data = b"".join(texts)
    ends = np.cumsum([len(t) for t in texts])
    n, begin = column["n"].to_numpy(), column["start"].to_numpy()
    offsets = ends - n - (LENGTH - 1)
    phrase = np.repeat(np.arange(len(n)), n)
    inner = np.arange(len(phrase)) - np.repeat(np.cumsum(n) - n, n)
    starts = offsets[phrase] + inner
    order, heads = suffix_array(np.frombuffer(data, np.uint8), starts)
    # Corpus order of the phrases: the parse by document and place, null doc_ids first.
    known = column["doc_id"].is_valid().to_numpy(zero_copy_only=False)
    corpus = np.lexsort((begin, column["copy"].to_numpy(), column["doc_id"].fill_null(0).to_numpy(), known))
    rank = np.empty(len(n), np.int64)
    rank[corpus] = np.arange(len(n))
    when = (rank[phrase] * 256 + inner)[order]
    least = np.minimum.reduceat(when, heads)
    sizes = np.diff(np.concatenate((heads, [len(order)])))
    first = when == np.repeat(least, sizes)
    # What repeats of a phrase is one span: its strings lie closer than their length.
    low, high = np.full(len(n), 1 << 30), np.full(len(n), -1)
    again = order[~first]
    np.minimum.at(low, phrase[again], inner[again])
    np.maximum.at(high, phrase[again], inner[again])
    rows = np.flatnonzero(high >= 0)
    take = pa.array(rows)
    split = column["p"][0].as_py() > most
    kept = order[first] if split else order[:0]
    own = [xxhash.xxh3_128_digest(data[a : a + LENGTH]) for a in starts[kept].tolist()]
    classes = np.frombuffer(b"".join(own), np.int64).reshape(-1, 2)
    more = pa.array(phrase[kept])
    none = pa.nulls(len(rows), pa.int64())
    spans = [column["doc_id"].take(take), column["copy"].take(take), pa.array(begin[rows] + low[rows]), pa.array(begin[rows] + high[rows] + LENGTH), none, none]
    firsts = [column["doc_id"].take(more), column["copy"].take(more), pa.array((begin[phrase] + inner)[kept]), pa.array((begin[phrase] + inner)[kept] + LENGTH), pa.array(classes[:, 0].copy()), pa.array(classes[:, 1].copy())]
    return pa.table([pa.chunked_array([a, b]) for a, b in zip(spans, firsts)], names=[*_SPAN, "c1", "c2"])


def search(rest: DataFrame, texts: DataFrame, most: int = SHARD) -> DataFrame:
    """Spans of repeats among first occurrences. texts: `rest` with the phrases' bytes."""
    n_shards = max(1, -(-rest.count() // most))
    salt = F.pmod(F.col("full"), F.ceil(F.col("p") / most))
    # Triggers with more phrases than a shard holds get shards of their own.
    shard = F.when(F.col("p") > most, n_shards + F.pmod(F.xxhash64("key", salt), F.lit(1 << 62))).otherwise(F.pmod(F.xxhash64("key"), F.lit(n_shards)))
    found = texts.withColumn("shard", shard).groupBy("shard").applyInArrow(lambda table: search_shard(table, most), "doc_id long, copy long, start long, stop long, c1 long, c2 long")
    found = stash(found, "found")
    spans = found.filter("c1 IS NULL").select(*_SPAN)
    split = found.filter("c1 IS NOT NULL")
    if split.isEmpty():
        return spans
    least = stash(split.groupBy(F.col("c1").alias("_1"), F.col("c2").alias("_2")).agg(F.min(_place()).alias("first"), F.count("*").alias("_n")).filter("_n > 1"), "classes")
    later = split.join(least, (F.col("c1") == F.col("_1")) & (F.col("c2") == F.col("_2"))).filter(~_place().eqNullSafe(F.col("first")))
    return spans.unionByName(later.select(*_SPAN))


def repeated(docs: DataFrame, shard: int = SHARD) -> DataFrame:
    """(doc_id, copy, spans): maximal removed runs of bytes (start, stop) in order, of documents that have some; docs as identified() gives them."""
    spans, rest = parsed(docs)
    texts = stash(cut(docs, rest), "phrases")
    spans = spans.unionByName(search(rest, texts, shard))
    own = Window.partitionBy("doc_id", "copy").orderBy("start", "stop")
    reach = F.max("stop").over(own.rowsBetween(Window.unboundedPreceding, -1))
    marked = spans.withColumn("_new", F.when(F.col("start") <= reach, 0).otherwise(1))
    runs = marked.withColumn("_run", F.sum("_new").over(own.rowsBetween(Window.unboundedPreceding, 0)))
    merged = runs.groupBy("doc_id", "copy", "_run").agg(F.min("start").alias("start"), F.max("stop").alias("stop"))
    # A list of maximal runs: 16 bytes for each LENGTH bytes of a document at most.
    found = stash(merged.groupBy("doc_id", "copy").agg(F.sort_array(F.collect_list(F.struct("start", "stop"))).alias("spans")), "removed")
    discard(rest, texts)
    return found


def identified(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows, known), both (doc_id, copy, text): all rows, and each pair of doc_id and copy once. copy is 0 where doc_ids are unique, else the text's hash."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    if rows.groupBy("doc_id").agg(F.count("*").alias("n")).filter("n > 1").isEmpty():
        rows = rows.withColumn("copy", F.lit(0).cast("long"))
        return rows, rows
    rows = rows.withColumn("copy", F.xxhash64("text"))
    return rows, stash(rows.groupBy("doc_id", "copy").agg(F.first("text").alias("text")), "documents")


def _finish(docs: DataFrame, schema: str, make: Callable[[bytes, list[tuple[int, int]], list[bytes]], tuple], shard: int = SHARD) -> DataFrame:
    rows, known = identified(docs)
    names = [c.split()[0] for c in schema.split(", ")]
    spans = repeated(known, shard).select(F.col("doc_id").alias("_d"), F.col("copy").alias("_c"), "spans")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for text, own in zip(utf8(batch.column(1)), batch.column(2).to_pylist()):
                text, cuts = text or b"", [(s["start"], s["stop"]) for s in own or ()]
                kept = [text[a:b] for a, b in zip([0, *(b for _, b in cuts)], [*(a for a, _ in cuts), len(text)])]
                found.append(make(text, cuts, kept))
            if found:
                yield pa.RecordBatch.from_arrays([batch.column(0), *map(pa.array, zip(*found))], names=names)

    joined = rows.join(spans, F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("copy") == F.col("_c")), "left")
    return joined.select("doc_id", "text", "spans").mapInArrow(run, schema)


def remove_repeats(docs: DataFrame, shard: int = SHARD) -> DataFrame:
    """(doc_id, kept): what is left of every document, as bytes (a cut may fall into a character)."""
    return _finish(docs, "doc_id long, kept binary", lambda text, cuts, kept: (b"".join(kept),), shard)


def query(spark, sf_dir: str) -> DataFrame:
    """op8: removed bytes of every document."""
    return _finish(
        spark.read.parquet(f"{sf_dir}/documents.parquet"),
        "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string",
        lambda text, cuts, kept: (len(text), sum(b - a for a, b in cuts), len(cuts), hashlib.sha256(b"".join(kept)).hexdigest()),
    )


#: For tables whose doc_ids are unique and not null.
ORACLE = f"""
WITH d AS (SELECT doc_id, encode(coalesce(text, '')) AS b FROM documents),
s AS (SELECT doc_id, b, unnest(range(1, octet_length(b) - {LENGTH} + 2)) AS p FROM d WHERE octet_length(b) >= {LENGTH}),
m AS (SELECT doc_id, p, md5_number(array_slice(b, p, p + {LENGTH - 1})) AS h FROM s),
r AS (SELECT m.doc_id, m.p, CASE WHEN (m.doc_id, m.p) > first THEN 2 ELSE 1 END AS k FROM m JOIN (SELECT h, min((doc_id, p)) AS first FROM m GROUP BY h HAVING count(*) > 1) g ON m.h = g.h),
i AS (SELECT doc_id, p, CASE WHEN p <= lag(p) OVER (PARTITION BY doc_id ORDER BY p) + {LENGTH} THEN 0 ELSE 1 END AS fresh FROM r WHERE k > 1),
g AS (SELECT doc_id, p, sum(fresh) OVER (PARTITION BY doc_id ORDER BY p) AS run FROM i),
x AS (SELECT doc_id, min(p) AS a, max(p) + {LENGTH} AS e FROM g GROUP BY doc_id, run),
k AS (SELECT d.doc_id, d.b, coalesce(lag(x.e) OVER (PARTITION BY d.doc_id ORDER BY x.a), 1) AS a, x.a AS e FROM d JOIN x ON d.doc_id = x.doc_id
      UNION ALL SELECT d.doc_id, d.b, coalesce(m.e, 1), octet_length(d.b) + 1 FROM d LEFT JOIN (SELECT doc_id, max(e) AS e FROM x GROUP BY doc_id) m ON d.doc_id = m.doc_id),
t AS (SELECT doc_id, string_agg(CASE WHEN e > a THEN hex(array_slice(b, a, e - 1)) ELSE '' END, '' ORDER BY a) AS kept FROM k GROUP BY doc_id),
n AS (SELECT doc_id, sum(e - a) AS n_removed, count(*) AS n_spans FROM x GROUP BY doc_id)
SELECT d.doc_id, CAST(octet_length(d.b) AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, coalesce(n_spans, 0) AS n_spans, sha256(unhex(kept)) AS kept_sha256
FROM d JOIN t ON d.doc_id = t.doc_id LEFT JOIN n ON d.doc_id = n.doc_id
"""
