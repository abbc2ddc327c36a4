"""Readers and writers of the record, truth and id-list tables."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pairloom.sources.scratch import stash

SOURCE_COLUMNS = ["entity_id", "business_name", "business_address", "country"]
_STRINGS = lambda names: T.StructType([T.StructField(n, T.StringType()) for n in names])


def _tsv(spark: SparkSession, path: str, names: list[str]) -> DataFrame:
    """A TSV with a header, read as strings without quoting; what is missing is empty."""
    rows = spark.read.csv(path, sep="\t", header=True, quote="", schema=_STRINGS(names), enforceSchema=True)
    return rows.select(*(F.coalesce(n, F.lit("")).alias(n) for n in names))


def spread(table: DataFrame) -> DataFrame:
    """A table with fewer input splits than cores is dealt to all of them; a table with more is left as it is, without a shuffle."""
    cores = table.sparkSession.sparkContext.defaultParallelism
    return table.repartition(cores) if table.rdd.getNumPartitions() < cores else table


def source_paths(directory: str, prefix: str) -> list[str]:
    return [f"{directory.rstrip('/')}/{prefix}_source{k}.tsv" for k in (1, 2, 3)]


def read_sources(spark: SparkSession, directory: str, prefix: str) -> DataFrame:
    """The three source files as one table, with src (1 to 3) and a dense integer idx in the order (src, entity_id)."""
    tables = [_tsv(spark, path, SOURCE_COLUMNS).withColumn("src", F.lit(k).cast("tinyint")) for k, path in enumerate(source_paths(directory, prefix), 1)]
    records = tables[0].unionByName(tables[1]).unionByName(tables[2])
    return with_dense_idx(records, ["src", "entity_id"])


def with_dense_idx(records: DataFrame, order: list[str]) -> DataFrame:
    """`records` with idx 0, 1, 2, ... in the given order, without any task that sorts all rows.

    Rows are dealt to ranges and sorted inside them; that table is written once, so that numbers, sizes and offsets of the ranges
    are those of the same rows. Repeated rows get a number each. An empty table gives an empty table.
    """
    ranged = records.repartitionByRange(*order).sortWithinPartitions(*order)
    # the range in the upper bits, the row's place in the lower 33 ones
    written = stash(ranged.withColumn("_place", F.monotonically_increasing_id()), "ranges")
    part = F.shiftright("_place", 33)
    sizes = written.groupBy(part.alias("_part")).agg(F.count("*").alias("_n"))
    before = F.coalesce(F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    # broadcast: one row for each shuffle partition
    offsets = sizes.select("_part", before.alias("_base"))
    numbered = written.join(F.broadcast(offsets), part == F.col("_part"))
    return numbered.withColumn("idx", F.col("_base") + F.col("_place").bitwiseAND((1 << 33) - 1)).drop("_part", "_place", "_base")


def explode_ids(lists: DataFrame, key: str, ids: str, out: tuple[str, str]) -> DataFrame:
    """One row for each id of a comma list; empty ids go."""
    found = lists.select(F.col(key).alias(out[0]), F.explode(F.split(F.coalesce(ids, F.lit("")), ",")).alias(out[1]))
    return found.withColumn(out[1], F.trim(out[1])).filter(F.col(out[1]) != "")


def read_truth(spark: SparkSession, path: str) -> DataFrame:
    """(s1_id, cand_id) pairs of a ground-truth file."""
    return explode_ids(_tsv(spark, path, ["source1_entity_id", "matched_entity_ids"]), "source1_entity_id", "matched_entity_ids", ("s1_id", "cand_id"))


def id_lists(ids: DataFrame, groups: DataFrame, key: str, value: str, order: str, out: str) -> DataFrame:
    """One row for each key of `ids`: its distinct values of `groups` in the order of column `order`, joined by commas."""
    ranked = groups.groupBy(key, value).agg(F.min(order).alias("_o"))
    joined = ranked.groupBy(key).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_o", value))), lambda s: s[value]), ",").alias(out))
    return ids.select(key).join(joined, key, "left").select(key, F.coalesce(out, F.lit("")).alias(out))


def write_tsv(table: DataFrame, path: str) -> None:
    """A folder of unquoted TSV files with headers, which read_id_lists() and the validator read."""
    table.write.mode("overwrite").csv(path, sep="\t", header=True, quote="", emptyValue="", nullValue="")


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """(value, place): the lines of a text file or folder, without the header of each file. place orders them as they are written."""
    rows = spark.read.csv(path, sep="\u0001", header=True, quote="", schema="value string", enforceSchema=True)
    # within a split lines are numbered in order; splits are ordered by file and offset
    return rows.select("value", F.struct("_metadata.file_path", "_metadata.file_block_start", F.monotonically_increasing_id().alias("line")).alias("place"))


def split_line() -> tuple[Column, Column]:
    """What is before the first tab of `value`, and what is after it (null without a tab)."""
    cut = F.instr("value", "\t")
    rest = F.when(cut > 0, F.expr("substring(value, instr(value, '\t') + 1)"))
    return F.when(cut > 0, F.expr("substring(value, 1, instr(value, '\t') - 1)")).otherwise(F.col("value")), rest


def read_id_lists(spark: SparkSession, path: str) -> DataFrame:
    """(id, ids) of an id-list file or folder; of the rows of an id the last one counts; rows without a tab have no ids."""
    key, rest = split_line()
    rows = read_lines(spark, path).select(F.trim(key).alias("id"), F.coalesce(rest, F.lit("")).alias("list"), "place").filter("id <> ''")
    last = rows.groupBy("id").agg(F.max_by("list", "place").alias("list"))
    return last.select("id", F.array_distinct(F.filter(F.transform(F.split("list", ","), lambda x: F.trim(x)), lambda x: x != "")).alias("ids"))


def _path(spark: SparkSession, path: str):
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    where, files = _path(spark, path)
    return files.exists(where)


def first_lines(spark: SparkSession, path: str) -> list[str | None]:
    """The first line of a file, or of each data file of a folder, on any file system; None for an empty file."""
    where, files = _path(spark, path)
    found = []
    for status in sorted(files.listStatus(where), key=lambda s: s.getPath().toString()):
        if status.isFile() and not status.getPath().getName().startswith(("_", ".")):
            jvm = spark.sparkContext._jvm
            reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(files.open(status.getPath()), "UTF-8"))
            found.append(reader.readLine())
            reader.close()
    return found


def save_json(spark: SparkSession, value, path: str) -> None:
    """A small JSON file on any file system that Spark reaches."""
    where, files = _path(spark, path)
    out = files.create(where, True)
    out.write(bytearray(json.dumps(value, ensure_ascii=False, indent=1).encode()))
    out.close()


def load_json(spark: SparkSession, path: str):
    return json.loads(spark.read.text(path, wholetext=True).first().value)
