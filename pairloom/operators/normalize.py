"""Normalised columns of records: one narrow projection."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairloom.functions import text as X
from pairloom.functions.romanize import romanize


def normalize(records: DataFrame, romanized: bool = False) -> DataFrame:
    """`records` (business_name, business_address and any others) with the 17 normalised columns.

    A column latin_name (see pairloom.operators.translit) stands for the name where there is one, and goes. romanized: other scripts become
    ASCII too, by an Arrow function; else their letters are separators.
    """
    name, address = F.col("business_name"), F.col("business_address")
    out = records.withColumns({"name_nonlatin": X.nonlatin(name), "name_website": X.website(name)})
    base = F.coalesce(F.col("latin_name") if "latin_name" in records.columns else F.lower(name), F.lit(""))
    out = out.withColumns({"_name": romanize(base) if romanized else base, "_addr": romanize(address) if romanized else address})
    out = out.withColumn("_words", X.words_of_name(X.name_base(F.col("_name"))))
    out = out.withColumns({"name_norm": F.array_join("_words", " "), "legal_form": X.legal_form(F.col("_words")), "name_tokens": X.name_tokens(F.col("_words"))})
    core, compact = F.array_join("name_tokens", " "), F.array_join("name_tokens", "")
    out = out.withColumns(
        {
            "name_core": F.when(core == "", F.col("name_norm")).otherwise(core),
            "name_compact": F.when(compact == "", F.replace("name_norm", F.lit(" "), F.lit(""))).otherwise(compact),
            "name_skel": F.transform("name_tokens", X.skeleton),
            "_base": X.address_base(F.col("_addr")),
        }
    )
    out = out.withColumn("addr_norm", X.address_norm(F.col("_base")))
    out = out.withColumns({"addr_empty": F.col("addr_norm") == "", "addr_tokens": X.address_tokens(F.col("addr_norm")), "addr_ids": X.address_ids(F.col("_base")), "_part": X.street_component(F.col("addr_norm"))})
    out = out.withColumns({"addr_numbers": X.address_numbers(F.col("addr_tokens")), "house_no": X.house_no(F.col("_part")), "_street": X.street_word(F.col("_part"))})
    key = F.when((F.col("house_no") != "") & (F.col("_street") != ""), F.concat_ws("_", "house_no", "_street")).otherwise("")
    return out.withColumn("street_key", key).drop("latin_name", "_name", "_addr", "_words", "_base", "_part", "_street")
