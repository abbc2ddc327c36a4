"""Learning a dictionary of words in other scripts from labelled pairs."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pairloom.functions.text import NON_LATIN


def _words(column: str):
    return F.filter(F.split(F.regexp_replace(F.lower(column), r"(?U)[^\w\s]", " "), r"\s+"), lambda t: t != "")


def aligned_words(pairs: DataFrame, script: str = NON_LATIN) -> DataFrame:
    """(word, latin) of names with equal numbers of words, place by place, where the word is of another script."""
    both = pairs.filter(F.col("n2").rlike(script)).select(_words("n1").alias("t1"), _words("n2").alias("t2")).filter(F.size("t1") == F.size("t2"))
    pair = F.explode(F.arrays_zip(F.col("t2").alias("word"), F.col("t1").alias("latin")))
    return both.select(pair.alias("p")).select("p.word", "p.latin").filter(F.col("word").rlike(script))


def learn_dictionary(pairs: DataFrame, min_count: int = 2, min_share: float = 0.5, script: str = NON_LATIN) -> DataFrame:
    """(word, latin): the most frequent partner of each word, if frequent enough; ties go to the smaller partner. pairs: n1, n2.

    Give it pairs of the fit fold only, or the evaluation sees its own labels.
    """
    counts = aligned_words(pairs, script).groupBy("word", "latin").agg(F.count("*").alias("n"))
    own = Window.partitionBy("word")
    ranked = counts.withColumns({"total": F.sum("n").over(own), "k": F.row_number().over(own.orderBy(F.desc("n"), "latin"))})
    return ranked.filter((F.col("k") == 1) & (F.col("n") >= min_count) & (F.col("n") / F.col("total") >= min_share)).select("word", "latin", "n", "total")


#: A dictionary of up to so many words goes to the tasks as one; a larger one is joined.
MOST_WORDS = 200_000


def lookup(dictionary: DataFrame) -> Callable[[Column], Column]:
    """Names (a column; null stays null) with the words replaced that the dictionary has: a hash table in Arrow batches. At most MOST_WORDS words."""
    rows = dictionary.select("word", "latin").limit(MOST_WORDS + 1).collect()
    if len(rows) > MOST_WORDS:
        raise ValueError(f"a dictionary of more than {MOST_WORDS} words: use transliterated(), which joins it")
    shared = dictionary.sparkSession.sparkContext.broadcast({r.word: r.latin for r in rows})

    @F.pandas_udf("string")
    def replace(names: pd.Series) -> pd.Series:
        get = shared.value.get
        return names.map(lambda name: " ".join(get(w, w) for w in name.split()), na_action="ignore")

    return replace


def joined(records: DataFrame, dictionary: DataFrame, script: str = NON_LATIN) -> DataFrame:
    """`records` (idx unique) with `latin_name`: lower-case names, of those in other scripts the words replaced that the dictionary has. Any size of dictionary."""
    lowered = F.lower(F.coalesce("business_name", F.lit("")))
    words = F.split(F.regexp_replace(F.trim(lowered), r"\s+", " "), " ")
    exploded = records.filter(F.col("business_name").rlike(script)).select(F.col("idx").alias("_i"), F.posexplode(words).alias("_p", "_w"))
    known = dictionary.select(F.col("word").alias("_k"), "latin")
    replaced = exploded.join(known, F.col("_w") == F.col("_k"), "left").select("_i", F.struct("_p", F.coalesce("latin", "_w").alias("w")).alias("x"))
    names = replaced.groupBy("_i").agg(F.array_join(F.transform(F.array_sort(F.collect_list("x")), lambda x: x["w"]), " ").alias("latin_name"))
    return records.join(names, F.col("idx") == F.col("_i"), "left").withColumn("latin_name", F.coalesce("latin_name", lowered)).drop("_i")


def transliterated(records: DataFrame, dictionary: DataFrame, script: str = NON_LATIN) -> DataFrame:
    """`records` with `latin_name`, by lookup() where the dictionary is small enough, else by joined()."""
    if dictionary.count() > MOST_WORDS:
        return joined(records, dictionary, script)
    lowered = F.lower(F.coalesce("business_name", F.lit("")))
    other = F.col("business_name").rlike(script)
    return records.withColumn("latin_name", F.coalesce(lookup(dictionary)(F.when(other, lowered)), lowered))
