"""Candidate generation: rare shared keys, weighted, with a top-k for each channel.

One pass explodes the keys of all families into a table that is written once: records are read and normalised once, however often keys are
used. Document frequencies count the pool only, per country; keys above the cap are dropped, which bounds what a key can join. The
cap is a fraction of the pool, and can be bounded in numbers as well (max_df), as pairs grow with its square. generate_candidates() works in
rounds, so that the disk in use grows neither with all pairs nor with all keys' shuffle; a record's pairs are added up and ranked as columns of
numbers, and no pair is a row before it is a candidate. Everything
is keyed by country, so countries need no loop. Scores are rounded before they are ranked, and ties go to the smaller candidate, so
that no order of summation shows.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pairloom.sources.scratch import discard, stash

MAX_DF_FRACTION = 0.002
LEAST_CAP = 20
K = {"name": 30, "addr": 30, "both": 40}
MAX_CANDIDATES = 100
DIGITS = 6
#: More keys than these are dealt in KEY_ROUNDS rounds; pairs are made in rounds of some PAIRS rows.
KEYS = 4_000_000
KEY_ROUNDS = 4
PAIRS = 64_000_000


def bigrams(tokens: Column) -> Column:
    """Neighbouring tokens joined by _, but for pairs with a side of digits only."""
    digit = lambda t: (t >= "0") & (t < "a")
    pairs = F.zip_with(tokens, F.slice(tokens, 2, F.greatest(F.size(tokens), F.lit(1))), lambda a, b: F.when(~((digit(a) & a.rlike(r"^\d+$")) | (digit(b) & b.rlike(r"^\d+$"))), F.concat(a, F.lit("_"), b)))
    return F.filter(pairs, lambda b: b.isNotNull())


#: Extension point: key families as (channel, prefix of two characters, least length, SQL of an array of strings; None: bigrams).
FAMILIES: list[tuple[str, str, int, str | None]] = [
    ("name", "t:", 2, "name_tokens"),
    ("name", "k:", 2, "name_skel"),
    ("name", "c:", 4, "array(name_compact)"),
    ("name", "p:", 6, "array(substring(name_compact, 1, 6))"),
    ("addr", "s:", 3, "array(street_key)"),
    ("addr", "i:", 2, "addr_ids"),
    ("addr", "n:", 3, "addr_numbers"),
    ("addr", "b:", 5, None),
]


#: The columns of records that the keys are made of.
KEY_COLUMNS = ["name_tokens", "name_skel", "name_compact", "street_key", "addr_ids", "addr_numbers", "addr_tokens"]


def _family(prefix: str, least: int, expression: str | None) -> Column:
    """The keys of one family, with its prefix."""
    source = bigrams(F.col("addr_tokens")) if expression is None else F.expr(expression)
    return F.transform(F.filter(source, lambda t: F.length(t) >= least), lambda t: F.concat(F.lit(prefix), t))


def record_keys(records: DataFrame, families=None) -> DataFrame:
    """(country, idx, src, channel, key), distinct, of all families in one pass."""
    families = families or FAMILIES
    # Repeats go while keys are strings, which array_distinct hashes; structs it would compare pair by pair.
    keys = F.array_distinct(F.concat(*(_family(prefix, least, expression) for _, prefix, least, expression in families)))
    # explode_outer: the optimizer puts a filter below a plain explode, which would make all keys twice
    channels = F.create_map(*(F.lit(x) for channel, prefix, _, _ in families for x in (prefix, channel)))
    found = records.select("country", "idx", "src", F.explode_outer(keys).alias("key")).filter("key IS NOT NULL")
    return found.select("country", "idx", "src", F.try_element_at(channels, F.substring("key", 1, 2)).alias("channel"), "key")


def _cap(max_df_fraction: float, max_df: int | None) -> Column:
    """The most pool records that a key may have."""
    cap = F.greatest(F.lit(LEAST_CAP), F.floor(F.lit(max_df_fraction) * F.col("n_pool")))
    return cap if max_df is None else F.least(cap, F.lit(max_df))


def _weight() -> Column:
    return 1 + F.log(F.col("n_pool") / F.col("df"))


def key_weights(keys: DataFrame, records: DataFrame, max_df_fraction: float = MAX_DF_FRACTION, max_df: int | None = None) -> DataFrame:
    """(country, channel, key, df, w) of pool keys up to the cap, which max_df bounds in any pool: w = 1 + ln(pool / df)."""
    pool = records.filter("src <> 1").groupBy("country").agg(F.count("*").alias("n_pool"))
    df = keys.filter("src <> 1").groupBy("country", "channel", "key").agg(F.count("*").alias("df")).join(pool, "country")
    return df.filter(F.col("df") <= _cap(max_df_fraction, max_df)).select("country", "channel", "key", "df", _weight().alias("w"))


def pair_scores(keys: DataFrame, weights: DataFrame, s1: DataFrame | None = None) -> DataFrame:
    """(country, s1_idx, cand_idx, blk_name, blk_addr) of all pairs with a shared key. s1: (idx) to keep, for samples of the query side."""
    on = ["country", "channel", "key"]
    asked = keys.filter("src = 1").select("country", "idx", "channel", "key")
    if s1 is not None:
        asked = asked.join(s1.select("idx"), "idx", "left_semi")
    query = asked.join(weights, on).withColumn("share", F.col("w") / F.sum("w").over(Window.partitionBy("idx", "channel")))
    pool = keys.filter("src <> 1").select("country", "channel", "key", F.col("idx").alias("cand_idx"))
    # A pair's keys lie in different partitions of the join, so sums made there save nothing: deal the rows by s1_idx at once.
    joined = query.select(*on, F.col("idx").alias("s1_idx"), "share").join(pool, on).select("country", "s1_idx", "cand_idx", "channel", "share").repartition("s1_idx")
    score = lambda c: F.round(F.sum(F.when(F.col("channel") == c, F.col("share")).otherwise(0.0)), DIGITS).alias(f"blk_{c}")
    return joined.groupBy("country", "s1_idx", "cand_idx").agg(score("name"), score("addr"))


#: The score that each channel ranks by.
CHANNELS = {"name": "blk_name", "addr": "blk_addr", "both": "blk_score"}


def with_total(scores: DataFrame) -> DataFrame:
    return scores.withColumn("blk_score", F.round(F.col("blk_name") + F.col("blk_addr"), DIGITS))


def top_k(scores: DataFrame, channel: str, k: int) -> DataFrame:
    """Pairs in the top k of one channel, with their rank in it: rows past k leave before they are ranked."""
    column = CHANNELS[channel]
    rank = F.row_number().over(Window.partitionBy("s1_idx").orderBy(F.desc(column), "cand_idx"))
    return with_total(scores).filter(F.col(column) > 1e-6).withColumn(f"blk_rank_{channel}", rank).filter(F.col(f"blk_rank_{channel}") <= k)


def ranked_candidates(scores: DataFrame, k: dict[str, int] = K, most: int = MAX_CANDIDATES) -> DataFrame:
    """Candidates: pairs in the top k of a channel, with their rank in each channel (k + 1 where they are not in it), and extra pairs, ranked.

    scores: (s1_idx, cand_idx, blk_name, blk_addr, from_extra). The cap on ranks leaves extra pairs in. All pairs are sorted once, by their
    total. A pair without a name score has its total as its address score, so that those of them before it are before it in the address
    channel as well: past k of them it can't be in there, and only the pairs that are left are sorted for the other channels.
    """
    own = Window.partitionBy("s1_idx")
    ordered = lambda c: own.orderBy(F.desc(c), "cand_idx")
    nameless = F.col("blk_name") == 0
    found = with_total(scores).withColumns(
        {"_both": F.row_number().over(ordered("blk_score")), "_before": F.sum(nameless.cast("int")).over(ordered("blk_score").rowsBetween(Window.unboundedPreceding, Window.currentRow))}
    )
    found = found.filter((F.col("_both") <= k["both"]) | ~nameless | (F.col("_before") <= k["addr"]) | F.col("from_extra"))
    found = found.withColumns({f"_{c}": F.row_number().over(ordered(CHANNELS[c])) for c in ("addr", "name")})
    ranks = {c: F.when((F.col(column) > 1e-6) & (F.col(f"_{c}") <= k[c]), F.col(f"_{c}")) for c, column in CHANNELS.items()}
    hit = F.coalesce(*ranks.values()).isNotNull()
    # An extra pair that no channel has found is in none of them.
    found = found.filter(hit | F.col("from_extra")).withColumns({f"blk_rank_{c}": F.coalesce(rank, F.lit(k[c] + 1)) for c, rank in ranks.items()})
    ranked = found.withColumn("blk_rank", F.row_number().over(ordered("blk_score"))).drop("_both", "_before", "_addr", "_name")
    return ranked.filter((F.col("blk_rank") <= most) | F.col("from_extra")) if most > 0 else ranked


#: Lists of candidates by what they came from, as numbers; the rest are extra pairs.
_KINDS = {"name": 0, "addr": 1}


def _rounded(x: np.ndarray) -> np.ndarray:
    return np.floor(x * 10.0**DIGITS + 0.5) / 10.0**DIGITS


def rank_lists(kind: np.ndarray, w: np.ndarray, sizes: np.ndarray, cands: np.ndarray, k: dict[str, int], most: int) -> tuple[np.ndarray, ...]:
    """What ranked_candidates() gives for one source-1 record, by its lists: their kinds, weights and sizes, and the candidates of all in turn."""
    order = np.argsort(cands)
    ids = cands[order]
    first = np.concatenate(([0], np.flatnonzero(ids[1:] != ids[:-1]) + 1))
    ids = ids[first]
    score = {}
    for channel, number in _KINDS.items():
        own = np.where(kind == number, w, 0.0)
        total = own.sum()
        score[channel] = _rounded(np.add.reduceat(np.repeat(own / total, sizes)[order], first)) if total > 0 else np.zeros(len(ids))
    score["both"] = _rounded(score["name"] + score["addr"])
    extra = np.maximum.reduceat(np.repeat(kind == 2, sizes)[order], first) if (kind == 2).any() else np.zeros(len(ids), bool)
    kept, ranks = extra.copy(), {}
    for channel, n in k.items():
        value = score[channel]
        best = np.flatnonzero((value > 1e-6) & (value >= (np.partition(value, len(value) - n)[len(value) - n] if 0 < n < len(value) else 0.0)))
        best = best[np.argsort(-value[best], kind="stable")][:n]
        ranks[channel] = np.full(len(ids), n + 1, np.int32)
        ranks[channel][best] = np.arange(1, len(best) + 1)
        kept[best] = True
    rows = np.flatnonzero(kept)
    rows = rows[np.argsort(-score["both"][rows], kind="stable")]
    rank = np.arange(1, len(rows) + 1, dtype=np.int32)
    if most > 0:
        some = (rank <= most) | extra[rows]
        rows, rank = rows[some], rank[some]
    return ids[rows], score["name"][rows], score["addr"][rows], extra[rows], score["both"][rows], *(ranks[c][rows] for c in CHANNELS), rank


_CANDIDATES = ("s1_idx long, cand_idx long, blk_name double, blk_addr double, from_extra boolean, blk_score double, blk_rank_name int, blk_rank_addr int, blk_rank_both int, blk_rank int")


def _ranked(k: dict[str, int], most: int):
    """An Arrow function from lists (s1_idx, kind, w, cands), a record's in a run, to candidates."""

    def made(found: list[tuple]) -> pa.RecordBatch:
        s1 = np.repeat([x for x, _ in found], [len(columns[0]) for _, columns in found])
        columns = [s1, *(np.concatenate(c) for c in zip(*(columns for _, columns in found)))]
        return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["s1_idx", "cand_idx", "blk_name", "blk_addr", "from_extra", "blk_score", *(f"blk_rank_{c}" for c in CHANNELS), "blk_rank"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        record, pieces = None, []  # the last record may go on in the next batch
        finish = lambda: (record, rank_lists(*(np.concatenate(c) for c in zip(*pieces)), k, most))
        for batch in batches:
            if not batch.num_rows:
                continue
            s1, kind, w = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(3))
            lists = batch.column(3)
            cands, ends = lists.flatten().to_numpy(zero_copy_only=False), lists.offsets.to_numpy()
            ends = ends - ends[0]
            bounds = [0, *(np.flatnonzero(s1[1:] != s1[:-1]) + 1).tolist(), len(s1)]
            found = []
            for i, j in zip(bounds, bounds[1:]):
                if pieces and s1[i] != record:
                    found.append(finish())
                    pieces = []
                record = s1[i]
                pieces.append((kind[i:j], w[i:j], np.diff(ends[i : j + 1]), cands[ends[i] : ends[j]]))
            if found:
                yield made(found)
        if pieces:
            yield made([finish()])

    return run


def channel_overlap(scores: DataFrame, k: dict[str, int] = K) -> DataFrame:
    """(in_name, in_addr, n_pairs, n_s1): pairs that the name and address channels find, alone or both, and of how many source-1 records."""
    scores = stash(scores, "scores")
    name, addr = (top_k(scores, c, k[c]).select("s1_idx", "cand_idx", F.lit(True).alias(f"in_{c}")) for c in ("name", "addr"))
    both = name.join(addr, ["s1_idx", "cand_idx"], "full_outer").withColumns({c: F.coalesce(c, F.lit(False)) for c in ("in_name", "in_addr")})
    return both.groupBy("in_name", "in_addr").agg(F.count("*").alias("n_pairs"), F.count_distinct("s1_idx").alias("n_s1"))


def within_country(extra: DataFrame, records: DataFrame) -> DataFrame:
    """Extra pairs of a source-1 and a pool record of the same country."""
    left = records.filter("src = 1").select(F.col("idx").alias("s1_idx"), "country")
    right = records.filter("src <> 1").select(F.col("idx").alias("cand_idx"), F.col("country").alias("_c"))
    return extra.select("s1_idx", "cand_idx").join(left, "s1_idx").join(right, "cand_idx").filter("country = _c").select("s1_idx", "cand_idx")


def _rounds(n: int, size: int) -> int:
    return max(1, -(-n // size))


def postings(keys: DataFrame, records: DataFrame, max_df_fraction: float = MAX_DF_FRACTION, max_df: int | None = None) -> tuple[DataFrame, list[DataFrame]]:
    """(channel, w, s1, cands) of each key of both sides up to the cap, as key_weights() has it: the ids of either side as arrays; and its tables.

    Keys are dealt once, in rounds of a part of them each, and a round's shuffle files go at its end.
    """
    pool = records.filter("src <> 1").groupBy("country").agg(F.count("*").alias("n_pool"))
    # Rows are sorted by a number first, which compares in one step.
    own = ["_h", "country", "channel", "key"]
    same = Window.partitionBy(*own)
    made = []
    rounds = KEY_ROUNDS if keys.count() > KEYS else 1
    for i in range(rounds):
        part = keys.filter("country IS NOT NULL")
        if rounds > 1:
            part = part.filter(F.pmod(F.xxhash64("key"), F.lit(rounds)) == i)
        is_s1 = F.col("src") == 1
        part = part.select("country", "channel", "key", F.when(is_s1, F.col("idx")).alias("s1"), F.when(~is_s1, F.col("idx")).alias("cand"))
        part = part.repartition("country", "channel", "key").withColumn("_h", F.xxhash64("country", "key"))
        part = part.withColumns({"n_s1": F.count("s1").over(same), "df": F.count("cand").over(same)}).filter("n_s1 > 0 AND df > 0")
        part = part.join(F.broadcast(pool), "country").filter(F.col("df") <= _cap(max_df_fraction, max_df))
        lists = part.groupBy(*own, "n_pool", "df").agg(F.collect_list("s1").alias("s1"), F.collect_list("cand").alias("cands"))
        made.append(stash(lists.select("channel", _weight().alias("w"), "s1", "cands"), "postings"))
    return reduce(DataFrame.unionByName, made), made


def generate_candidates(records: DataFrame, extra: DataFrame | None = None, s1: DataFrame | None = None, k: dict[str, int] = K, most: int = MAX_CANDIDATES, max_df_fraction: float = MAX_DF_FRACTION, max_df: int | None = None) -> DataFrame:
    """s1_idx, cand_idx, blk_name, blk_addr, blk_score, blk_rank, the channels' ranks and from_extra, as a table.

    Source-1 records go in rounds of some PAIRS rows (pair and shared key) each: what is on disk at a time does not grow with all pairs.
    """
    idx = records.schema["idx"].dataType
    keys = stash(record_keys(records), "keys")
    lists, parts = postings(keys, records, max_df_fraction, max_df)
    discard(keys)
    rounds = _rounds(lists.agg(F.sum(F.size("s1").cast("long") * F.size("cands"))).first()[0] or 0, PAIRS)
    more = None
    if extra is not None:
        pairs = stash(within_country(extra, records).distinct(), "extra")
        parts.append(pairs)
        more = pairs.select("s1_idx", F.lit(None).cast("string").alias("channel"), F.lit(0.0).alias("w"), F.array("cand_idx").alias("cands"))
    made = []
    for i in range(rounds):
        of_round = lambda c: F.pmod(F.xxhash64(c), F.lit(rounds)) == i
        asked = lists if rounds == 1 else lists.withColumn("s1", F.filter("s1", of_round))
        asked = asked.select(F.explode("s1").alias("s1_idx"), "channel", "w", "cands")
        if s1 is not None:
            asked = asked.join(s1.select(F.col("idx").alias("s1_idx")), "s1_idx", "left_semi")
        if more is not None:
            asked = asked.unionByName(more if rounds == 1 else more.filter(of_round(F.col("s1_idx"))))
        # A key's candidates travel as one array, and a record's arrays are added up and ranked where they are all there.
        number = F.coalesce(*(F.when(F.col("channel") == c, F.lit(n)) for c, n in _KINDS.items()), F.lit(2)).cast("tinyint")
        rows = asked.select(F.col("s1_idx").cast("long"), number.alias("kind"), "w", F.col("cands").cast("array<long>").alias("cands")).repartition("s1_idx").sortWithinPartitions("s1_idx")
        found = rows.mapInArrow(_ranked(k, most), _CANDIDATES)
        made.append(stash(found.withColumns({"s1_idx": F.col("s1_idx").cast(idx), "cand_idx": F.col("cand_idx").cast(idx)}), "candidates"))
    discard(*parts)
    return reduce(DataFrame.unionByName, made)


def blocking_report(candidates: DataFrame, truth: DataFrame, meta: DataFrame) -> DataFrame:
    """One row: pair recall, the F0.5 ceiling, candidates per source-1 record, pairs, and recall at ranks 5, 10, 20, 40."""
    found = truth.join(candidates.select("s1_idx", "cand_idx", "blk_rank"), ["s1_idx", "cand_idx"], "left")
    recall = found.agg(
        F.round(F.avg(F.col("blk_rank").isNotNull().cast("double")), 4).alias("pair_recall"),
        *(F.round(F.avg(F.coalesce((F.col("blk_rank") <= n).cast("double"), F.lit(0.0))), 4).alias(f"pair_recall_at_{n}") for n in (5, 10, 20, 40)),
    )
    hits = found.filter("blk_rank IS NOT NULL").groupBy("s1_idx").agg(F.count("*").alias("hit"))
    r = F.col("hit") / F.col("n_true")
    best = F.when(F.col("n_true") == 0, 1.0).when(F.col("hit").isNull(), 0.0).otherwise(1.25 * r / (0.25 + r))
    ceiling = meta.join(hits, "s1_idx", "left").agg(F.round(F.avg(best), 4).alias("f05_ceiling"), F.count("*").alias("_s1"))
    pairs = candidates.agg(F.count("*").alias("n_pairs"))
    joined = recall.crossJoin(ceiling).crossJoin(pairs)  # three tables of one row
    return joined.withColumn("avg_cands_per_s1", F.round(F.col("n_pairs") / F.col("_s1"), 1)).drop("_s1")
