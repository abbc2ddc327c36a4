"""SimHash near-duplicates: vantage-point trees over the fingerprints.

Words are runs of non-white characters after A-Z became lower-case; a fingerprint bit is 1 if over half of the XXH64
hashes (seed 42) of all 3-word shingles, repeats included, have it. Fingerprints at 3 or fewer differing bits link; the
component_id of a document is the least doc_id that links reach.

Which pairs are compared. Whole 64-bit distances of unrelated texts crowd around 32, where a triangle bound of 3 prunes next to
nothing. Of two fingerprints within r bits, though, one 32-bit half differs in at most r // 2 bits. So there is a vantage-point
tree for each half, whose metric is the Hamming distance of that half with radius r // 2. A node has a vantage point v and
a cutoff c: halves x with d(x, v) <= c go inside, the others outside, and those whose ball reaches over the boundary
(c < d(x, v) <= c + radius) go inside too. By the triangle inequality two halves within the radius meet in a leaf, so a leaf is a shard that needs
no other. Where very many fingerprints share a half, no vantage point separates them; there the tree goes on over the other half, by its
four bytes, one of which differs in at most r // 4 bits. The trees are built on the driver from a sample of at most SAMPLE distinct fingerprints, and
broadcast (their size is bounded by the sample); every distinct fingerprint is routed. Shards are searched exactly, with the whole 64 bits.

Scale. Copies fall together before anything else: only distinct fingerprints (aggregated before the shuffle) enter the trees. A
shard returns a spanning forest of its links, never its pairs, so the rows stay in proportion to the fingerprints; a search drops
fingerprints as soon as they are reached, which is what keeps dense groups cheap. A shard that is too large for one pass
splits further by the same trees inside the task. Links of shards become components by rounds of large-star and small-star
joins (tables in the shared folder after each round; nothing is collected).

Defined results. Null, empty and blank texts have no words: fingerprint zero, linked like any other. Repeated rows get a result
each. Rows with a null doc_id get one as well, but a null never is a component_id unless all rows of the component have it.
An empty table gives an empty table. near_duplicates() keeps no other column; drop_near_duplicates() keeps all, whatever their names, and of each
component the row of the least doc_id (null last), fingerprint and text hash, once if the row is repeated.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pairloom.llm.common import discard, stash, utf8
from pairloom.llm.graph import connected_components

SHINGLE = 3
RADIUS = 3
SEED = 42
#: Distinct fingerprints that the trees are built from, at most, and how many a shard should hold.
SAMPLE = 1 << 17
LEAF = 2048


def fingerprint(text: bytes | None, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """The SimHash of one text, as an unsigned 64-bit number."""
    words = text.lower().split() if text else []
    if not words:
        return 0
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(b" ".join(words), seed)
    flat = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = (ends[:-shingle] + 1).tolist()
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(flat[a:b], seed) for a, b in zip([0, *starts], ends[shingle - 1 :].tolist())), np.uint64, len(words) - shingle + 1)
    counts = np.zeros(64, np.int64)
    for k in range(0, len(hashes), 65536):
        counts += np.unpackbits(hashes[k : k + 65536].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > len(hashes), bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, hashed: bool = False) -> DataFrame:
    """(doc_id, fp) of every row; fp holds the 64 bits as a signed long. hashed: with text_hash, Spark's hash of the text."""
    docs = docs.select("doc_id", "text", *([F.xxhash64("text").alias("text_hash")] if hashed else []))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.fromiter((fingerprint(t, shingle) for t in utf8(batch.column(1))), np.uint64, batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found.view(np.int64)), *batch.columns[2:]], names=["doc_id", "fp", *batch.schema.names[2:]])

    return docs.mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, fp long" + (", text_hash long" if hashed else ""))


# -- vantage-point trees ------------------------------------------------------------------------------------------------------


def part_of(fps: np.ndarray, shift: int, bits: int) -> np.ndarray:
    """`bits` bits of each fingerprint, from bit `shift` on."""
    return (fps >> np.uint64(shift)) & np.uint64((1 << bits) - 1)


def build_tree(fps: np.ndarray, leaf: int, radius: int, shift: int, bits: int, seed: int = 1) -> tuple | None:
    """A tree over a part of distinct fingerprints: None for a leaf, ("cut", part, vantage, cutoff, reach, inside, outside), or ("all", trees) to search.

    radius: how many bits of the part may differ. Deterministic.
    """
    n = len(fps)
    if n <= leaf:
        return None
    own = part_of(fps, shift, bits)
    rng = np.random.default_rng(seed)
    best = None
    for vantage in own[rng.integers(0, n, 8)]:
        distance = np.bitwise_count(own ^ vantage)
        upto = np.cumsum(np.bincount(distance, minlength=bits + radius + 2))
        # Inside are d <= c + radius, outside are d > c. The split with the least rows to compare, if it spares any.
        inside, outside = upto[radius : radius + bits + 1].astype(float), n - upto[: bits + 1].astype(float)
        work = np.where(inside**2 + outside**2 < 0.95 * n**2, inside**1.5 + outside**1.5, np.inf)
        c = int(work.argmin())
        if np.isfinite(work[c]) and (best is None or work[c] < best[0]):
            best = (work[c], vantage, c, distance)
    if best is not None:
        _, vantage, c, distance = best
        sides = [build_tree(fps[distance <= c + radius], leaf, radius, shift, bits, seed * 2 + 1), build_tree(fps[distance > c], leaf, radius, shift, bits, seed * 2 + 2)]
        return ("cut", (shift, bits), vantage, c, radius, *sides)
    if bits == 32:
        return ("all", [build_tree(fps, leaf, (2 * radius + 1) // 4, (32 - shift) + 8 * k, 8, seed + k) for k in range(4)])
    return None


def build_trees(fps: np.ndarray, leaf: int, radius: int) -> tuple:
    """A tree for each half, both to be searched."""
    return ("all", [build_tree(fps, leaf, radius // 2, shift, 32) for shift in (32, 0)])


def route(tree: tuple | None, fps: np.ndarray, rows: np.ndarray, name: list[int], out: list[tuple[int, np.ndarray]]) -> None:
    """Append (leaf number, rows) for each leaf that rows reach; name[0] counts the leaves, so numbers are the same everywhere."""
    if tree is None:
        out.append((name[0], rows))
        name[0] += 1
    elif tree[0] == "all":
        for one in tree[1]:
            route(one, fps, rows, name, out)
    else:
        _, part, vantage, c, radius, inside, outside = tree
        distance = np.bitwise_count(part_of(fps[rows], *part) ^ vantage)
        route(inside, fps, rows[distance <= c + radius], name, out)
        route(outside, fps, rows[distance > c], name, out)


def forest(fps: np.ndarray, radius: int = RADIUS) -> list[tuple[np.ndarray, int]]:
    """The components of distinct fingerprints under exact links: (members, least member) of each that has two or more."""
    left, found = np.sort(fps), []
    while len(left) > 1:
        seed, left = left[0], left[1:]
        frontier, members = [seed], [seed]
        while frontier and len(left):
            near = np.bitwise_count(left ^ frontier.pop()) <= radius
            if near.any():
                reached = left[near]
                frontier.extend(reached)
                members.extend(reached)
                left = left[~near]
        if len(members) > 1:
            found.append((np.array(members, np.uint64), min(members)))
    return found


def shard_links(fps: np.ndarray, leaf: int, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links (fingerprint, least of its group) inside a shard; a large shard is split by trees of its own first."""
    parts: list[tuple[int, np.ndarray]] = []
    route(build_trees(fps, leaf, radius) if len(fps) > 2 * leaf else None, fps, np.arange(len(fps)), [0], parts)
    a, b = [], []
    for _, rows in parts:
        for members, least in forest(fps[rows], radius):
            members = members[members != least]
            a.append(members)
            b.append(np.full(len(members), least, np.uint64))
    empty = np.zeros(0, np.uint64)
    return np.concatenate([empty, *a]), np.concatenate([empty, *b])


def links(distinct: DataFrame, radius: int = RADIUS, sample: int = SAMPLE, leaf: int = LEAF) -> DataFrame:
    """(u, v): links that span the components of the distinct fingerprints (fp)."""
    spark = distinct.sparkSession
    n = distinct.count()
    # A sample by hash, bounded by `sample` rows; each of its rows stands for n / sample fingerprints.
    rows = distinct if n <= sample else distinct.filter(F.pmod(F.xxhash64("fp"), F.lit(1 << 30)) < int((1 << 30) * sample / n)).limit(2 * sample)
    taken = np.sort(np.array(rows.toPandas()["fp"], np.int64)).view(np.uint64)
    leaf_rows = max(16, int(leaf * min(1.0, len(taken) / max(n, 1))))
    trees = spark.sparkContext.broadcast(build_trees(taken, leaf_rows, radius))

    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.asarray(batch.column(0)).view(np.uint64)
            parts: list[tuple[int, np.ndarray]] = []
            route(trees.value, fps, np.arange(len(fps)), [0], parts)
            shard = np.concatenate([np.full(len(r), k, np.int64) for k, r in parts])
            yield pa.RecordBatch.from_arrays([pa.array(shard), pa.array(fps[np.concatenate([r for _, r in parts])].view(np.int64))], names=["shard", "fp"])

    def search(rows: pd.DataFrame) -> pd.DataFrame:
        u, v = shard_links(rows["fp"].to_numpy().view(np.uint64), leaf, radius)
        return pd.DataFrame({"u": u.view(np.int64), "v": v.view(np.int64)})

    return distinct.mapInArrow(shards, "shard long, fp long").groupBy("shard").applyInPandas(search, "u long, v long")


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """(doc_id, fp, component_id) of every row of `docs` (doc_id, text)."""
    return _components(stash(fingerprints(docs, shingle), "fingerprints"), radius).select("doc_id", "fp", "component_id")


def _components(fps: DataFrame, radius: int) -> DataFrame:
    """`fps` (doc_id, fp and others) with root, the least fingerprint of the component, and component_id."""
    distinct = fps.groupBy("fp").agg(F.min("doc_id").alias("first"))
    members = connected_components(links(distinct.select("fp"), radius))
    roots = distinct.join(members.select(F.col("node").alias("fp"), "root"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    least = roots.groupBy("root").agg(F.min("first").alias("component_id"))
    classes = roots.select("fp", "root").join(least, "root").select(F.col("fp").alias("_fp"), "root", "component_id")
    return fps.join(classes, F.col("fp") == F.col("_fp")).drop("_fp")


def drop_near_duplicates(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """One row of each component, the one of the least doc_id (null last), fingerprint and text hash; columns of `docs`.

    Rows are told apart by doc_id and text hash. Rows that agree in both have equal texts, and one of them stays.
    """
    fps = stash(fingerprints(docs, shingle, True), "fingerprints")
    # Rows of a doc_id and text, first counted where they are: a repeated row is one row from here on.
    rows = stash(fps.groupBy("doc_id", "text_hash", "fp").agg(F.count("*").alias("n")), "rows")
    discard(fps)
    order = F.struct(F.col("doc_id").isNull().alias("unknown"), "doc_id", "fp", "text_hash")
    chosen = _components(rows, radius).groupBy("root").agg(F.min_by(F.struct("doc_id", "text_hash", "n"), order).alias("first"))
    keep = stash(chosen.select(F.col("first.doc_id").alias("_keep"), F.col("first.text_hash").alias("_keep_hash"), F.col("first.n").alias("_n")), "kept")
    discard(rows)
    packed = docs.select(F.col("doc_id").alias("_id"), F.xxhash64("text").alias("_hash"), F.struct(*docs.columns).alias("_row"))

    def joined(wanted: DataFrame) -> DataFrame:
        # Merge joins at every size: the kept ids grow with the corpus, and are broadcast only where they happen to be few.
        return packed.join(wanted.hint("merge"), F.col("_id").eqNullSafe(F.col("_keep")) & (F.col("_hash") == F.col("_keep_hash")))

    if keep.filter("_n > 1").isEmpty():
        return joined(keep).select("_row.*")
    once = joined(keep.filter("_n = 1")).select("_row.*")
    return once.unionByName(joined(keep.filter("_n > 1")).dropDuplicates(["_id", "_hash"]).select("_row.*"))


def query(spark, sf_dir: str) -> DataFrame:
    """op3: fingerprint and component of every document."""
    found = near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def _xxh64(text: str, seed: int = SEED) -> str:
    """DuckDB SQL of XXH64 of a string column's bytes, as UHUGEINT below 2^64. The five primes and the rotations are the function's fixed values."""
    p1, p2, p3, p4, p5 = (f"{p}::UHUGEINT" for p in (11400714785074694791, 14029467366897019727, 1609587929392839161, 9650029242287828579, 2870177450012600261))
    m = f"{1 << 64}::UHUGEINT"
    mul = lambda a, b: f"(({a}) * {b} % {m})"
    add = lambda a, b: f"((({a}) + {b}) % {m})"

    def rotl(x: str, r: int) -> str:
        return f"(({x}) * {1 << r}::UHUGEINT % {m} + ({x}) // {1 << 64 - r}::UHUGEINT)"

    def number(at: str, size: int) -> str:
        """`size` bytes of the hex string x from byte `at` on, little-endian."""
        return "('0x' || " + " || ".join(f"substr(x, 2 * ({at} + {k}) + 1, 2)" for k in reversed(range(size))) + ")::UBIGINT::UHUGEINT"

    whole = "(n - n % 32)"  # bytes in stripes of 32
    turn = lambda acc, lane: f"list_reduce({lane}, lambda a, l: {{}}, {acc})".format(
        mul(rotl(add("a", mul("l", p2)), 31), p1)
    )
    starts = (seed + 11400714785074694791 + 14029467366897019727, seed + 14029467366897019727, seed, seed - 11400714785074694791)
    stripes = [turn(f"{s % (1 << 64)}::UHUGEINT", f"list_transform(range(0, {whole}, 32), lambda i: {number(f'i + {8 * k}', 8)})") for k, s in enumerate(starts)]
    merged = add(add(rotl("v1", 1), rotl("v2", 7)), add(rotl("v3", 12), rotl("v4", 18)))
    for k in (1, 2, 3, 4):
        merged = add(mul(f"xor({merged}, {mul(rotl(mul(f'v{k}', p2), 31), p1)})", p1), p4)
    eights = f"list_transform(range({whole}, n - n % 8, 8), lambda i: {mul(rotl(mul(number('i', 8), p2), 31), p1)})"
    after8 = f"list_reduce({eights}, lambda a, l: {add(mul(rotl('xor(a, l)', 27), p1), p4)}, h1)"
    four = f"CASE WHEN n % 8 >= 4 THEN {add(mul(rotl(f'xor(h2, {mul(number(chr(40) + "n - n % 8" + chr(41), 4), p1)})', 23), p2), p3)} ELSE h2 END"
    ones = f"list_transform(range(n - n % 4, n), lambda i: {mul(number('i', 1), p5)})"
    after1 = f"list_reduce({ones}, lambda a, l: {mul(rotl('xor(a, l)', 11), p1)}, h3)"
    shift = lambda x, r: f"xor({x}, {x} // {1 << r}::UHUGEINT)"
    return f"""
  SELECT t, {shift('h6', 32)} AS h FROM (SELECT t, {mul(shift('h5', 29), p3)} AS h6 FROM (SELECT t, {mul(shift('h4', 33), p2)} AS h5 FROM (
  SELECT t, {after1} AS h4 FROM (SELECT *, {four} AS h3 FROM (SELECT *, {after8} AS h2 FROM (
  SELECT *, {add(f"CASE WHEN n >= 32 THEN {merged} ELSE {add(f'{seed}::UHUGEINT', p5)} END", "n::UHUGEINT")} AS h1 FROM (
  SELECT *, {', '.join(f'{v} AS v{k}' for k, v in enumerate(stripes, 1))} FROM (
  SELECT t, hex(encode(t)) AS x, octet_length(encode(t)) AS n FROM {text}))))))))"""


ORACLE = rf"""
WITH RECURSIVE w AS (SELECT doc_id, row_number() OVER () AS r, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT r, array_to_string(list_slice(w, i, i + {SHINGLE - 1}), ' ') AS t FROM (SELECT r, w, unnest(range(1, greatest(1, len(w) - {SHINGLE - 1}) + 1)) AS i FROM w WHERE len(w) > 0)),
x AS ({_xxh64("(SELECT DISTINCT t FROM s)")}),
b AS (SELECT r, {' + '.join(f"CASE WHEN 2 * count_if(h & {1 << k}::UBIGINT <> 0) > count(*) THEN {1 << k}::UHUGEINT ELSE 0::UHUGEINT END" for k in range(64))} AS f FROM s JOIN (SELECT t, h::UBIGINT AS h FROM x) x ON s.t = x.t GROUP BY r),
p AS (SELECT w.doc_id, coalesce(b.f, 0::UHUGEINT)::UBIGINT AS f FROM w LEFT JOIN b ON w.r = b.r),
d AS (SELECT f, min(doc_id) AS first FROM p GROUP BY f),
e AS (SELECT a.f AS a, c.f AS b FROM d a JOIN d c ON a.f <> c.f AND bit_count(xor(a.f, c.f)) <= {RADIUS}),
z(f, g) AS (SELECT f, f FROM d UNION SELECT z.f, e.b FROM z JOIN e ON z.g = e.a),
c AS (SELECT z.f, min(d.first) AS component_id FROM z JOIN d ON z.g = d.f GROUP BY z.f)
SELECT p.doc_id, lower(lpad(hex(p.f), 16, '0')) AS fingerprint, c.component_id FROM p JOIN c ON p.f = c.f
"""
