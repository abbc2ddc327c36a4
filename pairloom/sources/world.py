"""Linkage tables derived from the driver's documents and line items.

A document is a record: its first line is the name, its other lines are the components of the address, lang is the country, and source
numbers divisible by 4 are source 1, odd ones source 2, the rest source 3. Whole texts are used. Records of the same country with equal text
are true pairs, attached to the least source-1 record.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pairloom.sources import tables

NOISE = ["drop", "repeat", "reverse", "accent", "leet", "legal", "noaddr", "digit"]


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """idx, entity_id, src, country, business_name, business_address of every document."""
    docs = tables.spread(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang", "source"))
    number = F.regexp_extract("source", r"(\d+)", 1).cast("int")
    src = F.when(number % 4 == 0, 1).when(number % 2 == 1, 2).otherwise(3).cast("tinyint")
    lines = F.split("text", "\n")
    return docs.select(
        F.col("doc_id").alias("idx"),
        F.concat(F.lit("S"), src.cast("string"), F.lit("-"), F.col("doc_id").cast("string")).alias("entity_id"),
        src.alias("src"),
        F.col("lang").alias("country"),
        F.get(lines, F.lit(0)).alias("business_name"),
        F.array_join(F.slice(lines, 2, F.greatest(F.size(lines), F.lit(1))), ", ").alias("business_address"),
    )


def truth(found: DataFrame) -> DataFrame:
    """(s1_idx, cand_idx) of records with equal name, address and country. SHA-256 digests are dealt, not texts."""
    name = F.col("business_name")
    text = F.sha2(F.concat(F.length(name).cast("string"), F.lit(":"), name, F.col("business_address")), 256)
    slim = found.select("idx", "src", "country", text.alias("text"))
    first = slim.filter("src = 1").groupBy("country", "text").agg(F.min("idx").alias("s1_idx"))
    return slim.filter("src <> 1").join(first, ["country", "text"]).select("s1_idx", F.col("idx").alias("cand_idx"))


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scored pairs from line items: (s1_idx, cand_idx, p, label), p and label by arithmetic on the keys."""
    pairs = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select(F.col("l_orderkey").alias("s1_idx"), F.col("l_partkey").alias("cand_idx")).distinct()
    mixed = (F.col("s1_idx") * 104729 + F.col("cand_idx") * 7919) % 1000003
    return pairs.select("s1_idx", "cand_idx", (mixed / 1000003.0).alias("p"), (mixed % 1000 >= 600).cast("int").alias("label"))


def scored_meta(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(s1_idx, n_true) of every order; orders without a true pair are singletons."""
    true = scored(spark, sf_dir).filter("label = 1").groupBy("s1_idx").agg(F.count("*").alias("n_true"))
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet").select(F.col("o_orderkey").alias("s1_idx"))
    return orders.join(true, "s1_idx", "left").select("s1_idx", F.coalesce("n_true", F.lit(0)).alias("n_true"))


def short_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """records() cut to eight words of the name, and a made-up number and six words of the address: for tests only."""
    base = records(spark, sf_dir).withColumn("business_name", F.array_join(F.slice(F.split("business_name", " "), 1, 8), " "))
    return base.withColumn("business_address", F.concat((F.col("idx") % 977 + 10).cast("string"), F.lit(" "), F.array_join(F.slice(F.split(F.col("business_address"), " "), 1, 6), " ")))


def noisy_world(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """with_noisy_copies() of short records, a fixture that tests can train on in seconds; queries take whole_noisy_world()."""
    return with_noisy_copies(short_records(spark, sf_dir))


def whole_noisy_world(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """with_noisy_copies() of the records as they are."""
    return with_noisy_copies(records(spark, sf_dir))


def with_noisy_copies(base: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(records, truth) with 0 to 4 noisy copies of each source-1 record in sources 2 and 3; all other records are distractors.

    The noise of copy i of a record is chosen by md5(idx || i).
    """
    draw = lambda salt: F.conv(F.substring(F.md5(F.concat(F.col("idx").cast("string"), F.lit(salt), F.col("i").cast("string"))), 1, 6), 16, 10).cast("long")
    copies = base.filter("src = 1").withColumn("i", F.explode(F.sequence(F.lit(1), F.lit(4)))).filter(draw("n") % 5 >= F.col("i"))
    words = F.split("business_name", " ")
    kind = draw("k") % len(NOISE)
    noisy = {
        0: F.array_join(F.slice(words, 2, F.greatest(F.size(words), F.lit(1))), " "),
        1: F.concat_ws(" ", "business_name", F.get(words, F.lit(0))),
        2: F.array_join(F.reverse(words), " "),
        3: F.translate("business_name", "eao", "éàô"),
        4: F.regexp_replace("business_name", "o", "0"),
        5: F.concat_ws(" ", "business_name", F.lit("Ltd")),
    }
    name = F.col("business_name")
    for k, change in noisy.items():
        name = F.when(kind == k, change).otherwise(name)
    address = F.when(kind == 6, "").when(kind == 7, F.expr("substring(business_address, 2)")).otherwise(F.col("business_address"))
    src = (F.lit(2) + draw("s") % 2).cast("tinyint")
    made = copies.select((F.col("idx") * 10 + F.col("i") + 10_000_000_000).alias("idx"), F.concat(F.lit("S"), src.cast("string"), F.lit("-x"), F.col("idx").cast("string"), F.lit("-"), F.col("i").cast("string")).alias("entity_id"), src.alias("src"), "country", name.alias("business_name"), address.alias("business_address"), F.col("idx").alias("s1_idx"))
    pairs = made.select("s1_idx", F.col("idx").alias("cand_idx"))
    return base.unionByName(made.drop("s1_idx")), pairs


#: Letters of another script that stand for Latin ones, and what their Unicode names say; for tables of names in two scripts.
CYRILLIC = {"a": ("а", "a"), "e": ("е", "ie"), "i": ("и", "i"), "o": ("о", "o"), "s": ("с", "es"), "t": ("т", "te"), "n": ("н", "en"), "r": ("р", "er")}


def cyrillic(names):
    """A column with the letters of CYRILLIC put for theirs."""
    return F.translate(names, "".join(CYRILLIC), "".join(c for c, _ in CYRILLIC.values()))


def two_scripts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """records() whose names in source 3 are in Cyrillic letters, as far as there are some, and their plain names as latin."""
    base = records(spark, sf_dir).withColumn("latin", F.lower("business_name"))
    return base.withColumn("business_name", F.when(F.col("src") == 3, cyrillic(F.col("latin"))).otherwise(F.col("latin")))
