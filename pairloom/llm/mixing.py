"""Mixing sources to target weights, by capped water-filling. DataFrame functions only.

Sources, ordered by code point with null last, weigh 1, 2, 3, repeating, unless weights are given. They share as many words as
all documents have. A source gives at most `max_epochs` times its words: what it can't give goes to the others by their
weights, until none is above its cap. That fixed point is found in closed form: sources are put in the order of cap / weight,
and the first k of that order are capped, where k is the least for which the next one keeps below its cap.

A source with target t and size s gives floor(t / s) whole repetitions of each of its documents. The fraction left is taken
from documents in the order of a seeded hash, until its words are used up; the document at the end gives a part of its words.

For scale, a source's documents are dealt to BUCKETS buckets by hash. Sizes are summed by (source, bucket) before any shuffle
carries them. A prefix sum over those sums gives each source its edge: buckets before it are taken whole for the fraction, buckets after it
not at all. So one row per source says what nearly all documents need; only the documents of the edge buckets (a source's rows
divided by BUCKETS) are shuffled, to be put in order. The documents themselves stay where they are. Texts are split into
words twice, once for the sums and once for the result, and once where sizes are given.

Defined results. Null text has no words: size 0, taken 0. A null source is a source of its own, the last one. A null doc_id is
hashed as the text 'null'. Equal rows are taken each on its own. An empty table gives an empty table. Input columns named as one of
the added columns are replaced; all other columns are kept.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pairloom.llm.common import SPACES, discard, stash

#: Buckets by hash inside a source: the rows of a bucket are ordered in one task, the buckets of a source in another one.
HEX_DIGITS = 3
BUCKETS = 16**HEX_DIGITS
MAX_EPOCHS = 3
SEED = 7
ADDED = ["size", "source_size", "weight", "target", "taken"]


def n_words(text: Column) -> Column:
    """Words of a text that ASCII white space separates; null has none."""
    return F.coalesce(F.size(F.filter(F.split(text, SPACES), lambda w: w != "")), F.lit(0)).cast("long")


def water_fill(sources: DataFrame, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """`sources` (source, source_size, weight) with `target`: the size in total, dealt by weight, none above its cap.

    The rows are sources, not documents: one row each, whatever the corpus holds.
    """
    cap = F.col("source_size") * max_epochs
    by_ratio = Window.orderBy((cap / F.col("weight")).asc(), F.col("rank").asc())
    upto, before = by_ratio.rowsBetween(Window.unboundedPreceding, 0), by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    level = sources.select(
        "*",
        F.sum("source_size").over(everything).alias("_all"),
        (F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0))).alias("_weights"),
        F.coalesce(F.sum(cap).over(before), F.lit(0)).alias("_caps"),
        F.row_number().over(by_ratio).alias("_k"),
    )
    # The first source that stays below its cap if all before it are capped, and the level it sets for all after it.
    fits = (F.col("_all") - F.col("_caps")) * F.col("weight") <= cap * F.col("_weights")
    return (
        level.withColumn("_first", F.min(F.when(fits, F.col("_k"))).over(everything))
        .withColumn("_left", F.max(F.when(F.col("_k") == F.col("_first"), F.col("_all") - F.col("_caps"))).over(everything))
        .withColumn("_share", F.max(F.when(F.col("_k") == F.col("_first"), F.col("_weights"))).over(everything))
        .withColumn(
            "target",
            F.when(F.col("_k") < F.col("_first"), cap.cast("double"))
            .otherwise((F.col("weight") * F.col("_left")).cast("double") / F.col("_share"))
        )
        .drop("_all", "_weights", "_caps", "_k", "_first", "_left", "_share")
    )


def mix_sources(docs: DataFrame, max_epochs: int = MAX_EPOCHS, seed: int = SEED, weights: DataFrame | None = None, sizes: str | None = None) -> DataFrame:
    """All rows of `docs` (doc_id, text, source and any other columns) with size, source_size, weight, target and taken.

    weights: (source, weight) with positive whole weights; sources that it misses get 1. By default 1, 2, 3, repeating.
    sizes: a column of `docs` that holds the sizes; the text is not needed then.
    """
    size = n_words(F.col("_row.text")) if sizes is None else F.col(f"_row.{sizes}")
    kept = [c for c in docs.columns if c not in ADDED]
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))))
    # _src stands for source and is never null.
    stand_in = F.coalesce(F.concat(F.lit("="), F.col("source").cast("string")), F.lit("null"))
    rows = docs.select(F.struct(*kept).alias("_row"), digest.alias("_hash"), stand_in.alias("_src")).withColumn("_bucket", F.substring("_hash", 1, HEX_DIGITS))

    sums = stash(rows.groupBy("_src", "_bucket").agg(F.sum(size).alias("_words"), F.first("_row.source").alias("source")), "sums")
    sources = sums.groupBy("_src").agg(F.sum("_words").alias("source_size"), F.first("source").alias("source"))
    order = Window.orderBy(F.col("source").asc_nulls_last())
    sources = sources.withColumn("rank", F.row_number().over(order))
    if weights is None:
        sources = sources.withColumn("weight", ((F.col("rank") - 1) % 3 + 1).cast("long"))
    else:
        given = weights.select(F.col("source").alias("_s"), F.col("weight").cast("long").alias("weight"))
        sources = sources.join(given, F.col("source").eqNullSafe(F.col("_s")), "left").drop("_s").withColumn("weight", F.coalesce("weight", F.lit(1)))
    targets = water_fill(sources, max_epochs).withColumn("_whole", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long"))
    targets = targets.withColumn("_part", F.round("target").cast("long") - F.col("_whole") * F.col("source_size")).drop("rank", "source")

    earlier = Window.partitionBy("_src").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    left = F.col("_part") - F.coalesce(F.sum("_words").over(earlier), F.lit(0))
    buckets = sums.select("_src", "_bucket", "_words").join(targets.select("_src", "_part"), "_src").withColumn("_left", left)
    edges = buckets.groupBy("_src").agg(F.min(F.when(F.col("_left") < F.col("_words"), F.struct("_bucket", "_left"))).alias("_edge"))
    # One row per source, a table of its own: its size is known when the join below is planned.
    plan = stash(targets.drop("_part").join(edges, "_src"), "plan")
    discard(sums)
    # Texts are split after the joins, so that those of the second one are only the edge buckets'.
    joined = rows.join(plan, "_src")
    before = F.col("_edge").isNull() | (F.col("_bucket") < F.col("_edge._bucket"))
    plain = joined.filter(F.col("_edge").isNull() | (F.col("_bucket") != F.col("_edge._bucket"))).withColumn("size", size)
    plain = plain.withColumn("_part", F.when(before, F.col("size")).otherwise(0))
    inside = Window.partitionBy("_src").orderBy("_hash", "_row.doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    rest = F.col("_edge._left") - F.coalesce(F.sum("size").over(inside), F.lit(0))
    edge = joined.filter(F.col("_bucket") == F.col("_edge._bucket")).withColumn("size", size).withColumn("_part", F.greatest(F.lit(0), F.least(rest, F.col("size"))))
    both = plain.unionByName(edge).withColumn("taken", (F.col("_whole") * F.col("size") + F.col("_part")).cast("long"))
    return both.select("_row.*", *ADDED)


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: each row of `docs` as often as it is taken, to the nearest whole number of repetitions; columns of `docs`.

    A row that the mix takes less than half of is not in it. Rows without words are never taken.
    """
    packed = docs.select("doc_id", "source", "text", F.struct(*docs.columns).alias("_row"))
    taken = mix_sources(packed, **options)
    copies = F.round(F.col("taken") / F.greatest("size", F.lit(1))).cast("int")
    # explode_outer: below a plain explode the optimizer puts a filter, which would split every text once more
    each = F.explode_outer(F.when(copies > 0, F.sequence(F.lit(1), copies)))
    return taken.select("_row", each.alias("_copy")).filter("_copy IS NOT NULL").select("_row.*")


def query(spark, sf_dir: str) -> DataFrame:
    """op1: the mix of all documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    sized = stash(docs.select("doc_id", "source", n_words(F.col("text")).alias("n")), "sizes")
    return mix_sources(sized, sizes="n").select("doc_id", "size", "source_size", "target", "taken")


ORACLE = f"""
WITH d AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS BIGINT) AS size,
         md5('{SEED}:' || coalesce(CAST(doc_id AS VARCHAR), 'null')) AS h FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
r AS (SELECT *, (row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3 + 1 AS weight,
             row_number() OVER (ORDER BY source ASC NULLS LAST) AS rank FROM s),
k AS (SELECT *, CAST(sum(source_size) OVER () AS BIGINT) AS total,
        CAST(sum(weight) OVER () AS BIGINT) - coalesce(CAST(sum(weight) OVER w AS BIGINT), 0) AS weights,
        coalesce(CAST(sum({MAX_EPOCHS} * source_size) OVER w AS BIGINT), 0) AS caps,
        row_number() OVER (ORDER BY ({MAX_EPOCHS} * source_size)::DOUBLE / weight, rank) AS k FROM r
      WINDOW w AS (ORDER BY ({MAX_EPOCHS} * source_size)::DOUBLE / weight, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
f AS (SELECT min(k) AS first FROM k WHERE (total - caps) * weight <= {MAX_EPOCHS} * source_size * weights),
l AS (SELECT first, total - caps AS remaining, weights AS share FROM k, f WHERE k = first),
t AS (SELECT source, source_size, CASE WHEN k < first THEN ({MAX_EPOCHS} * source_size)::DOUBLE
        ELSE (weight * remaining)::DOUBLE / share END AS target FROM k, l),
e AS (SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS whole FROM t),
o AS (SELECT d.doc_id, d.size, e.source_size, e.target, e.whole, CAST(round(e.target) AS BIGINT) - e.whole * e.source_size
        - coalesce(CAST(sum(d.size) OVER (PARTITION BY d.source ORDER BY h, d.doc_id, d.size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS BIGINT), 0) AS remaining
      FROM d JOIN e ON d.source IS NOT DISTINCT FROM e.source)
SELECT doc_id, size, source_size, target, CAST(whole * size + greatest(0, least(remaining, size)) AS BIGINT) AS taken FROM o
"""
