"""The linkage queries: one for each operator, as Spark plans, with their DuckDB twins."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pairloom.functions import text as X
from pairloom.functions.romanize import romanize
from pairloom.functions.similarity import COMPARATORS, comparator
from pairloom.operators import blocking as B
from pairloom.operators import decide as D
from pairloom.operators import features as P
from pairloom.operators import matcher, sampling, translit, vectors
from pairloom.operators.normalize import normalize
from pairloom.plans import evaluate as E
from pairloom.plans import oracles as O
from pairloom.sources import tables, world
from pairloom.plans.pipeline import Work
from pairloom.plans.pipeline import fit_pairs as only_fit_pairs
from pairloom.sources.scratch import shared_dir, stash

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a function under its name, with its SQL."""

    def add(function: Query) -> Query:
        QUERIES[function.__name__] = function
        if sql is not None:
            ORACLE_SQL[function.__name__] = sql
        return function

    return add


def _r(c, digits: int = 6):
    return F.round(c, digits)


def _norm(spark: SparkSession, sf: str) -> DataFrame:
    return normalize(world.records(spark, sf))


def _scores(spark: SparkSession, sf: str) -> DataFrame:
    records = _norm(spark, sf)
    keys = stash(B.record_keys(records), "keys")
    return B.pair_scores(keys, B.key_weights(keys, records))


def _candidates(spark: SparkSession, sf: str) -> DataFrame:
    return B.generate_candidates(_norm(spark, sf))


def _pairs(spark: SparkSession, sf: str) -> DataFrame:
    """Candidates with both sides' columns; records are normalised once, into a table."""
    records = stash(_norm(spark, sf).select("idx", "country", *P.RECORD_COLUMNS), "records")
    return P.pair_table(B.generate_candidates(records).select("s1_idx", "cand_idx"), records)


def _overlaps(spark: SparkSession, sf: str, sets: dict[str, str], *more: str) -> DataFrame:
    """Candidates with the sizes and intersections of the sets of both sides and the columns `more`, in a table of numbers."""
    columns = dict.fromkeys(["idx", "src", "country", *B.KEY_COLUMNS, *sets.values(), *more])
    records = stash(_norm(spark, sf).select(*columns), "records")
    candidates = B.generate_candidates(records).select("s1_idx", "cand_idx")
    return P.overlap_table(candidates, records, sets, more)


def _long_ranks(found: DataFrame) -> DataFrame:
    return found.withColumns({c: F.col(c).cast("long") for c in found.columns if "rank" in c})


def _joined(column: str):
    return F.array_join(column, " ").alias(column)


# -- sources ------------------------------------------------------------------------------------------------------------------------------------


@query(f"WITH {O.RECORDS} SELECT s1_idx, cand_idx FROM truth")
def truth_pairs(spark, sf):
    return world.truth(world.records(spark, sf))


@query("SELECT o_orderkey AS id, row_number() OVER (ORDER BY o_orderkey) - 1 AS idx, md5(repeat('w' || o_orderkey, 20)) AS wide FROM orders")
def dense_idx(spark, sf):
    orders = spark.read.parquet(f"{sf}/orders.parquet").select(F.col("o_orderkey").alias("id"), F.repeat(F.concat(F.lit("w"), F.col("o_orderkey").cast("string")), 20).alias("wide"))
    return tables.with_dense_idx(orders.repartition(16), ["id"]).select("id", "idx", F.md5("wide").alias("wide"))


@query("SELECT id, unnest(string_split(ids, ',')) AS item FROM (SELECT l_orderkey AS id, string_agg(CAST(l_partkey AS VARCHAR), ',') AS ids FROM lineitem GROUP BY 1)")
def explode_id_lists(spark, sf):
    lists = spark.read.parquet(f"{sf}/lineitem.parquet").groupBy("l_orderkey").agg(F.array_join(F.collect_list(F.col("l_partkey").cast("string")), ",").alias("ids"))
    return tables.explode_ids(lists, "l_orderkey", "ids", ("id", "item"))


@query(f"""WITH {O.SCORED} SELECT o_orderkey AS s1_idx, coalesce(ids, '') AS matched FROM orders LEFT JOIN
  (SELECT s1_idx, string_agg(CAST(cand_idx AS VARCHAR), ',' ORDER BY p DESC, CAST(cand_idx AS VARCHAR)) AS ids FROM owned WHERE p >= 0.5 GROUP BY s1_idx) o ON s1_idx = o_orderkey""")
def id_lists(spark, sf):
    kept = D.select_threshold(D.one_to_one(world.scored(spark, sf)), 0.5).select("s1_idx", F.col("cand_idx").cast("string").alias("cand"), (-F.col("p")).alias("o"))
    orders = spark.read.parquet(f"{sf}/orders.parquet").select(F.col("o_orderkey").alias("s1_idx"))
    return tables.id_lists(orders, kept, "s1_idx", "cand", "o", "matched")


@query("""SELECT row_number() OVER (ORDER BY src, entity_id) - 1 AS idx, entity_id, src, business_name, business_address, country FROM (
  SELECT 1 AS src, 'S1-' || c_custkey AS entity_id, c_name AS business_name, c_mktsegment AS business_address, 'n' || c_nationkey AS country FROM customer
  UNION ALL SELECT 2, 'S2-' || s_suppkey, s_name, '', 'n' || s_nationkey FROM supplier UNION ALL SELECT 3, 'S3-' || p_partkey, p_name, p_type, 'n' || p_size FROM part)""")
def read_sources(spark, sf):
    """Three tables written as TSV and read as sources."""
    folder = f"{shared_dir(spark)}/pairloom/sources-{uuid.uuid4().hex}"
    shapes = {"customer": ("c_custkey", "c_name", "c_mktsegment", "c_nationkey"), "supplier": ("s_suppkey", "s_name", None, "s_nationkey"), "part": ("p_partkey", "p_name", "p_type", "p_size")}
    for k, ((table, (key, name, address, country)), path) in enumerate(zip(shapes.items(), tables.source_paths(folder, "t")), 1):
        rows = spark.read.parquet(f"{sf}/{table}.parquet").select(
            F.concat(F.lit(f"S{k}-"), F.col(key).cast("string")).alias("entity_id"), F.col(name).alias("business_name"),
            (F.col(address) if address else F.lit("")).alias("business_address"), F.concat(F.lit("n"), F.col(country).cast("string")).alias("country"),
        )
        tables.write_tsv(rows, path)
    return tables.read_sources(spark, folder, "t").withColumn("src", F.col("src").cast("int"))


@query(f"""WITH {O.SCORED}, g AS (SELECT s1_idx, string_agg(CAST(cand_idx AS VARCHAR), ',' ORDER BY p DESC, CAST(cand_idx AS VARCHAR)) AS ids FROM owned WHERE p >= 0.5 GROUP BY s1_idx)
SELECT CAST(o_orderkey AS VARCHAR) AS id, coalesce(ids, '') AS ids FROM orders LEFT JOIN g ON s1_idx = o_orderkey""")
def write_and_read_lists(spark, sf):
    path = f"{shared_dir(spark)}/pairloom/lists-{uuid.uuid4().hex}"
    tables.write_tsv(id_lists(spark, sf), path)
    return tables.read_id_lists(spark, path).select("id", F.array_join("ids", ",").alias("ids"))


@query(f"WITH {O.NORM} SELECT idx, name_norm FROM n WHERE country = 'en'")
def work_table_of_a_country(spark, sf):
    """A table partitioned by country: one folder and two columns are read."""
    work = Work(spark, f"{shared_dir(spark)}/pairloom/work-{uuid.uuid4().hex}")
    return work.table("records", lambda: _norm(spark, sf), "country").filter("country = 'en'").select("idx", "name_norm")


# -- normalisation --------------------------------------------------------------------------------------------------------------------------------


@query(f"WITH {O.NORM} SELECT idx, base FROM n")
def norm_name_regex_chain(spark, sf):
    return world.records(spark, sf).select("idx", X.name_base(F.col("business_name")).alias("base"))


@query(f"WITH {O.NORM} SELECT idx, legal_form, name_norm FROM n")
def norm_legal_form(spark, sf):
    return _norm(spark, sf).select("idx", "legal_form", "name_norm")


@query(f"WITH {O.NORM} SELECT idx, array_to_string(name_tokens, ' ') AS name_tokens FROM n")
def norm_tokens_distinct(spark, sf):
    return _norm(spark, sf).select("idx", _joined("name_tokens"))


@query(f"WITH {O.NORM} SELECT idx, name_core, name_compact FROM n")
def norm_compact(spark, sf):
    return _norm(spark, sf).select("idx", "name_core", "name_compact")


@query(f"SELECT c_custkey AS id, {O.DELEET} AS word FROM (SELECT c_custkey, lower(c_mktsegment) || CAST(c_custkey % 10 AS VARCHAR) || 'x' AS t FROM customer)")
def norm_deleet(spark, sf):
    word = F.concat(F.lower("c_mktsegment"), (F.col("c_custkey") % 10).cast("string"), F.lit("x"))
    return spark.read.parquet(f"{sf}/customer.parquet").select(F.col("c_custkey").alias("id"), X.deleet(word).alias("word"))


@query(f"WITH {O.NORM} SELECT idx, array_to_string(name_skel, ' ') AS name_skel FROM n")
def norm_skeleton(spark, sf):
    return _norm(spark, sf).select("idx", _joined("name_skel"))


@query(f"WITH {O.NORM} SELECT idx, addr_norm, addr_empty, array_to_string(addr_tokens, ' ') AS addr_tokens FROM n")
def norm_addr_tokens(spark, sf):
    return _norm(spark, sf).select("idx", "addr_norm", "addr_empty", _joined("addr_tokens"))


@query(f"WITH {O.NORM} SELECT idx, array_to_string(addr_numbers, ' ') AS addr_numbers FROM n")
def norm_addr_numbers(spark, sf):
    return _norm(spark, sf).select("idx", _joined("addr_numbers"))


@query(f"WITH {O.NORM} SELECT idx, array_to_string(addr_ids, ' ') AS addr_ids FROM n")
def norm_addr_ids(spark, sf):
    return _norm(spark, sf).select("idx", _joined("addr_ids"))


@query(f"WITH {O.NORM} SELECT idx, house_no FROM n")
def norm_house_no(spark, sf):
    return _norm(spark, sf).select("idx", "house_no")


@query(f"WITH {O.NORM} SELECT idx, street_key FROM n")
def norm_street_key(spark, sf):
    return _norm(spark, sf).select("idx", "street_key")


@query(f"SELECT doc_id, md5({O.FOLD.format('text')}) AS folded FROM documents")
def fold_accents(spark, sf):
    return spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", F.md5(X.fold(F.col("text"))).alias("folded"))


@query(r"SELECT page_id, regexp_matches(url, '(?i)(www\.|\.(com|net|org|co\.in|in|fr)\b)') AS is_site FROM pages")
def flag_website(spark, sf):
    return spark.read.parquet(f"{sf}/pages.parquet").select("page_id", X.website(F.col("url")).alias("is_site"))


@query(r"SELECT doc_id, regexp_matches(text, '[^\x00-\x7F]') AS nonascii, regexp_matches(text, '[\p{Devanagari}\p{Cyrillic}\p{Han}\p{Arabic}\p{Tamil}]') AS nonlatin FROM documents")
def flag_nonascii(spark, sf):
    return spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", F.col("text").rlike(r"[^\x00-\x7F]").alias("nonascii"), X.nonlatin(F.col("text")).alias("nonlatin"))


@query(f"WITH {O.RECORDS}, {O.TWO_SCRIPTS} SELECT idx, regexp_matches(business_name, '{O.SCRIPTS}') AS nonlatin FROM two")
def flag_nonlatin(spark, sf):
    return world.two_scripts(spark, sf).select("idx", X.nonlatin(F.col("business_name")).alias("nonlatin"))


@query(rf"""WITH {O.RECORDS}, {O.TWO_SCRIPTS}, {O.LEARNED}
SELECT idx, CASE WHEN regexp_matches(business_name, '{O.SCRIPTS}') THEN array_to_string(list_transform(string_split_regex(trim(business_name), '\s+'), lambda t: coalesce(m[t], t)), ' ')
  ELSE business_name END AS name FROM two, mapped""")
def transliterate_words(spark, sf):
    records = world.two_scripts(spark, sf)
    pairs = records.filter("src = 3").select(F.col("latin").alias("n1"), F.col("business_name").alias("n2"))
    return translit.transliterated(records, translit.learn_dictionary(pairs)).select("idx", F.col("latin_name").alias("name"))


@query(ORACLE_SQL["transliterate_words"])
def transliterate_joined(spark, sf):
    """The same for dictionaries of any size."""
    records = world.two_scripts(spark, sf)
    pairs = records.filter("src = 3").select(F.col("latin").alias("n1"), F.col("business_name").alias("n2"))
    return translit.joined(records, translit.learn_dictionary(pairs)).select("idx", F.col("latin_name").alias("name"))


@query(f"WITH {O.RECORDS}, {O.TWO_SCRIPTS} SELECT idx, {O.ROMANIZED} AS name FROM two WHERE src = 3")
def romanize_names(spark, sf):
    return world.two_scripts(spark, sf).filter("src = 3").select("idx", romanize(F.col("business_name")).alias("name"))


# Documents have no other script, so words with an accent play the part here.
ACCENT = "[àâäçèéêëíîïñóôöùúûüÿßœ]"


@query(rf"""WITH w AS (SELECT doc_id, regexp_extract_all(lower(text), '[\p{{L}}\p{{N}}_]+') AS t FROM documents),
a AS (SELECT t[i] AS word, translate(t[i], 'éèêçñóíäöüß', 'eeecnoiaous') AS latin FROM (SELECT t, unnest(range(1, len(t) + 1)) AS i FROM w) WHERE regexp_matches(t[i], '{ACCENT}')),
c AS (SELECT word, latin, count(*) AS n FROM a GROUP BY ALL),
r AS (SELECT *, CAST(sum(n) OVER (PARTITION BY word) AS BIGINT) AS total, row_number() OVER (PARTITION BY word ORDER BY n DESC, latin) AS k FROM c)
SELECT word, latin, n, total FROM r WHERE k = 1 AND n >= 2 AND n::DOUBLE / total >= 0.5""")
def dict_learn_topshare(spark, sf):
    text = spark.read.parquet(f"{sf}/documents.parquet").select(F.translate(F.lower("text"), "éèêçñóíäöüß", "eeecnoiaous").alias("n1"), F.lower("text").alias("n2"))
    return translit.learn_dictionary(text, script=ACCENT)


# -- sampling --------------------------------------------------------------------------------------------------------------------------------------


@query(f"SELECT c_custkey AS id, {O.bucket('c_custkey', 13)} AS bucket, CASE WHEN {O.bucket('c_custkey', 13)} < 2000 THEN 'val' ELSE 'fit' END AS fold FROM customer")
def hash_fold_split(spark, sf):
    key = F.col("c_custkey")
    return spark.read.parquet(f"{sf}/customer.parquet").select(key.alias("id"), sampling.hash_bucket(key, 13).alias("bucket"), sampling.fold_of(key).alias("fold"))


@query(f"""WITH {O.RECORDS}, k AS (SELECT idx FROM rec WHERE src = 1 AND {O.bucket('idx', 7)} < 3000)
SELECT idx FROM k UNION ALL SELECT idx FROM rec WHERE src <> 1 AND idx IN (SELECT cand_idx FROM truth WHERE s1_idx IN (SELECT idx FROM k))
UNION ALL SELECT idx FROM rec WHERE src <> 1 AND idx NOT IN (SELECT cand_idx FROM truth) AND {O.bucket('idx', 11)} < 3000""")
def miniworld_sample(spark, sf):
    records = world.records(spark, sf)
    return sampling.mini_world(records, world.truth(records), 0.3).select("idx")


@query(f"WITH {O.SCORED} SELECT s1_idx, cand_idx, label FROM scored WHERE label = 1 OR {O.bucket('cand_idx', 1)} < 2500")
def neg_downsample(spark, sf):
    return sampling.downsample_negatives(world.scored(spark, sf), 0.25).select("s1_idx", "cand_idx", "label")


@query(f"WITH {O.RECORDS} SELECT r.idx AS s1_idx, CASE WHEN {O.bucket(chr(39) + 'S1-' + chr(39) + ' || r.idx', 13)} < 2000 THEN 'val' ELSE 'fit' END AS fold, count(t.cand_idx) AS n_true FROM rec r LEFT JOIN truth t ON t.s1_idx = r.idx WHERE r.src = 1 GROUP BY ALL")
def s1_meta(spark, sf):
    records = world.records(spark, sf)
    return sampling.s1_meta(records, world.truth(records))


@query(f"WITH {O.RECORDS} SELECT s1_idx, cand_idx FROM truth WHERE {O.bucket(chr(39) + 'S1-' + chr(39) + ' || s1_idx', 13)} >= 2000")
def fit_pairs(spark, sf):
    records = world.records(spark, sf)
    truth = world.truth(records)
    return only_fit_pairs(truth, sampling.s1_meta(records, truth)).select("s1_idx", "cand_idx")


@query("SELECT c_custkey, c_name FROM customer ORDER BY md5(CAST(c_custkey AS VARCHAR)), c_custkey LIMIT 20")
def error_sample(spark, sf):
    """A report of fixed size."""
    return sampling.error_sample(spark.read.parquet(f"{sf}/customer.parquet").select("c_custkey", "c_name"), "c_custkey", 20)


# -- blocking --------------------------------------------------------------------------------------------------------------------------------------


@query(f"WITH {O.KEYS} SELECT country, idx, src, channel, key FROM allkeys")
def keys_long(spark, sf):
    return B.record_keys(_norm(spark, sf)).withColumn("src", F.col("src").cast("int"))


@query(f"WITH {O.KEYS} SELECT country, idx, key FROM allkeys WHERE key[1:2] = 'b:'")
def keys_bigrams(spark, sf):
    return B.record_keys(_norm(spark, sf), [f for f in B.FAMILIES if f[1] == "b:"]).select("country", "idx", "key")


@query(f"WITH {O.BLOCK} SELECT country, channel, key, df, round(w, 6) AS w FROM wt")
def df_cap_idf(spark, sf):
    records = _norm(spark, sf)
    return B.key_weights(stash(B.record_keys(records), "keys"), records).withColumn("w", _r("w"))


def _channel(name: str, rank: str, k: int):
    @query(f"WITH {O.BLOCK} SELECT s1_idx, cand_idx, {rank} AS rank, {name} AS score FROM rk WHERE {rank} <= {k}")
    def block(spark, sf):
        channel = {"rn": "name", "ra": "addr", "rb": "both"}[rank]
        return B.top_k(_scores(spark, sf), channel, k).select("s1_idx", "cand_idx", F.col(f"blk_rank_{channel}").cast("long").alias("rank"), F.col(name).alias("score"))

    return block


for _name, _rank, _k in (("blk_name", "rn", 30), ("blk_addr", "ra", 30), ("blk_score", "rb", 40)):
    _registered = _channel(_name, _rank, _k)
    _label = f"block_topk_{ {'rn': 'name', 'ra': 'addr', 'rb': 'both'}[_rank] }"
    QUERIES[_label], ORACLE_SQL[_label] = QUERIES.pop("block"), ORACLE_SQL.pop("block")


@query(f"""WITH {O.BLOCK}, a AS (SELECT s1_idx, cand_idx FROM rk WHERE rn <= 30), b AS (SELECT s1_idx, cand_idx FROM rk WHERE ra <= 30)
SELECT a.s1_idx IS NOT NULL AS in_name, b.s1_idx IS NOT NULL AS in_addr, count(*) AS n_pairs, count(DISTINCT coalesce(a.s1_idx, b.s1_idx)) AS n_s1
FROM a FULL OUTER JOIN b ON a.s1_idx = b.s1_idx AND a.cand_idx = b.cand_idx GROUP BY ALL""")
def channel_overlap(spark, sf):
    return B.channel_overlap(_scores(spark, sf))


@query(f"WITH {O.BLOCK} SELECT * FROM cand")
def block_union_channels(spark, sf):
    return _long_ranks(_candidates(spark, sf).drop("from_extra"))


_EXTRA = "SELECT a.idx AS s1_idx, b.idx AS cand_idx FROM rec a JOIN rec b ON b.idx = a.idx + 1 AND a.country = b.country WHERE a.src = 1 AND b.src <> 1"


@query(f"""WITH {O.BLOCK}, x AS ({_EXTRA}),
u AS (SELECT h.*, x.s1_idx IS NOT NULL AS from_extra FROM hits h LEFT JOIN x USING (s1_idx, cand_idx)
      UNION ALL SELECT x.s1_idx, x.cand_idx, coalesce(s.blk_name, 0), coalesce(s.blk_addr, 0), round(coalesce(s.blk_name, 0) + coalesce(s.blk_addr, 0), 6), 31, 31, 41, true
      FROM x LEFT JOIN sc s USING (s1_idx, cand_idx) WHERE NOT EXISTS (SELECT 1 FROM hits h WHERE h.s1_idx = x.s1_idx AND h.cand_idx = x.cand_idx))
SELECT s1_idx, cand_idx, blk_score, from_extra, blk_rank FROM (SELECT *, row_number() OVER (PARTITION BY s1_idx ORDER BY blk_score DESC, cand_idx) AS blk_rank FROM u) WHERE blk_rank <= 100 OR from_extra""")
def block_extra_union(spark, sf):
    records = _norm(spark, sf)
    extra = records.filter("src = 1").select(F.col("idx").alias("s1_idx"), (F.col("idx") + 1).alias("cand_idx"))
    return _long_ranks(B.generate_candidates(records, extra).select("s1_idx", "cand_idx", "blk_score", "from_extra", "blk_rank"))


@query(f"""WITH {O.BLOCK}, f AS (SELECT t.*, c.blk_rank FROM truth t LEFT JOIN cand c USING (s1_idx, cand_idx)),
h AS (SELECT s1_idx, count(*) AS hit FROM f WHERE blk_rank IS NOT NULL GROUP BY s1_idx),
m AS (SELECT CASE WHEN n_true = 0 THEN 1 WHEN hit IS NULL THEN 0 ELSE 1.25 * (hit::DOUBLE / n_true) / (0.25 + hit::DOUBLE / n_true) END AS best FROM meta LEFT JOIN h USING (s1_idx)),
p AS (SELECT count(*) AS n_pairs FROM cand)
SELECT (SELECT round(avg((blk_rank IS NOT NULL)::INTEGER), 4) FROM f) AS pair_recall,
  {", ".join(f"(SELECT round(avg(coalesce((blk_rank <= {k})::INTEGER, 0)), 4) FROM f) AS pair_recall_at_{k}" for k in (5, 10, 20, 40))},
  (SELECT round(avg(best), 4) FROM m) AS f05_ceiling, n_pairs, round(n_pairs::DOUBLE / (SELECT count(*) FROM m), 1) AS avg_cands_per_s1 FROM p""")
def block_report(spark, sf):
    records = _norm(spark, sf)
    truth = stash(world.truth(records), "truth")
    return B.blocking_report(B.generate_candidates(records), truth, sampling.s1_meta(records, truth))


@query(f"WITH {O.BLOCK} SELECT * FROM cand WHERE {O.bucket('s1_idx', 5)} < 2000")
def block_s1_sample(spark, sf):
    records = _norm(spark, sf)
    asked = records.filter("src = 1").filter(sampling.sampled(F.col("idx"), 0.2, 5)).select("idx")
    return _long_ranks(B.generate_candidates(records, s1=asked).drop("from_extra"))


# -- vectors ------------------------------------------------------------------------------------------------------------------------------------------

_DOT = "list_inner_product(a.embedding::DOUBLE[], b.embedding::DOUBLE[])"


def _vectors(spark, sf):
    return spark.read.parquet(f"{sf}/embeddings.parquet").select(F.col("vec_id").alias("idx"), F.col("label").cast("string").alias("country"), "embedding")


@query(f"SELECT a.vec_id AS s1_idx, b.vec_id AS cand_idx, round({_DOT}, 6) AS emb_cos FROM embeddings a JOIN embeddings b ON b.vec_id = a.vec_id + 1")
def pair_cosine(spark, sf):
    v = _vectors(spark, sf)
    pairs = v.select(F.col("idx").alias("s1_idx"), (F.col("idx") + 1).alias("cand_idx")).join(v.select(F.col("idx").alias("cand_idx")), "cand_idx", "left_semi")
    return vectors.pair_cosine(pairs, v).select("s1_idx", "cand_idx", "emb_cos")


@query(f"""SELECT * FROM (SELECT a.vec_id AS s1_idx, b.vec_id AS cand_idx, row_number() OVER (PARTITION BY a.vec_id ORDER BY round({_DOT}, 6) DESC, b.vec_id) AS rank
  FROM embeddings a JOIN embeddings b ON a.label = b.label WHERE a.vec_id % 100 = 0) WHERE rank <= 10""")
def knn_topk(spark, sf):
    v = _vectors(spark, sf)
    return vectors.knn(v.filter("idx % 100 = 0"), v, 10).select("s1_idx", "cand_idx", F.col("rank").cast("long").alias("rank"))


@query(ORACLE_SQL["knn_topk"])
def knn_blocked(spark, sf):
    """The same in several blocks of queries."""
    v = _vectors(spark, sf)
    return vectors.knn(v.filter("idx % 100 = 0"), v, 10, 4096).select("s1_idx", "cand_idx", F.col("rank").cast("long").alias("rank"))


@query(f"WITH {O.RECORDS} SELECT idx, md5('query: ' || business_name || ' | ' || business_address) AS text_md5 FROM rec")
def record_texts(spark, sf):
    return vectors.record_texts(world.records(spark, sf)).select("idx", F.md5("text").alias("text_md5"))


# -- comparators --------------------------------------------------------------------------------------------------------------------------------------

_NAMES = "SELECT DISTINCT a.p_name AS a, b.p_name AS b FROM part a JOIN part b ON a.p_brand = b.p_brand AND a.p_size = b.p_size WHERE a.p_partkey < b.p_partkey"


def _names(spark, sf):
    part = spark.read.parquet(f"{sf}/part.parquet")
    a = part.select("p_brand", "p_size", F.col("p_name").alias("a"), F.col("p_partkey").alias("ka"))
    b = part.select("p_brand", "p_size", F.col("p_name").alias("b"), F.col("p_partkey").alias("kb"))
    return a.join(b, ["p_brand", "p_size"]).filter("ka < kb").select("a", "b").distinct()


@query(f"SELECT a, b, CAST(levenshtein(a, b) AS INTEGER) AS distance FROM ({_NAMES})")
def sim_levenshtein(spark, sf):
    return _names(spark, sf).withColumn("distance", F.levenshtein("a", "b"))


def _similarity(label: str, kind: str, sql: str | None):
    def compare(spark, sf):
        return _names(spark, sf).withColumn("score", _r(comparator(COMPARATORS[kind])(F.col("a"), F.col("b"))))

    compare.__name__ = f"sim_{label}"
    query(sql)(compare)


_similarity("jaro_winkler", "jaro_winkler", f"SELECT a, b, round(jaro_winkler_similarity(a, b), 6) AS score FROM ({_NAMES})")
for _label, _kind in (("indel_ratio", "ratio"), ("token_sort", "token_sort"), ("token_set", "token_set"), ("partial", "partial"), ("weighted", "weighted")):
    _similarity(_label, _kind, O.similarity(_kind, _NAMES))


# -- features --------------------------------------------------------------------------------------------------------------------------------------


@query(f"WITH {O.PAIRS} SELECT s1_idx, cand_idx, {', '.join(O.overlap(p, c) for p, c in P.SETS.items())}, CAST(len(list_intersect(a.addr_ids, b.addr_ids)) AS INTEGER) AS aid_inter FROM pt")
def set_overlap(spark, sf):
    pairs = _overlaps(spark, sf, P.SETS | {"aid": "addr_ids"})
    made = {n: _r(c) if n.rsplit("_", 1)[1] in ("jac", "cont1", "cont2") else c for p in P.SETS for n, c in P.overlap_shares(p).items()}
    return pairs.select("s1_idx", "cand_idx", *(c.alias(n) for n, c in made.items()), "aid_inter")


_BOTH = "a.house_no <> '' AND b.house_no <> ''"


@query(f"""WITH {O.PAIRS} SELECT s1_idx, cand_idx, CASE WHEN {_BOTH} THEN (a.house_no = b.house_no)::INTEGER::DOUBLE END AS house_eq,
  CASE WHEN {_BOTH} THEN levenshtein(a.house_no, b.house_no)::DOUBLE END AS house_lev,
  CASE WHEN {_BOTH} THEN (suffix(a.house_no, b.house_no) OR suffix(b.house_no, a.house_no))::INTEGER::DOUBLE END AS house_suffix,
  CASE WHEN {_BOTH} THEN (prefix(a.house_no, b.house_no) OR prefix(b.house_no, a.house_no))::INTEGER::DOUBLE END AS house_prefix,
  CASE WHEN {_BOTH} THEN round(ln(1 + abs(TRY_CAST(substr(a.house_no, 1, 9) AS DOUBLE) - TRY_CAST(substr(b.house_no, 1, 9) AS DOUBLE))), 6) END AS house_absdiff FROM pt""")
def house_features(spark, sf):
    made = P.house_features()
    made["house_absdiff"] = _r(made["house_absdiff"])
    return _pairs(spark, sf).select("s1_idx", "cand_idx", *(c.cast("double").alias(n) for n, c in made.items()))


@query(f"""WITH {O.PAIRS} SELECT s1_idx, cand_idx, (a.name_compact = b.name_compact)::INTEGER AS nc_exact, (a.name_tokens[1] = b.name_tokens[1])::INTEGER::DOUBLE AS ntok_first_eq,
  (contains(a.name_compact, b.name_compact) OR contains(b.name_compact, a.name_compact))::INTEGER AS nc_contains,
  CASE WHEN a.street_key <> '' AND b.street_key <> '' THEN (a.street_key = b.street_key)::INTEGER::DOUBLE END AS street_eq,
  CASE WHEN a.legal_form <> '' AND b.legal_form <> '' THEN (a.legal_form = b.legal_form)::INTEGER::DOUBLE END AS legal_eq FROM pt""")
def equality_features(spark, sf):
    return _pairs(spark, sf).select("s1_idx", "cand_idx", *((c if n.startswith("nc_") else c.cast("double")).alias(n) for n, c in P.equality_features().items()))


@query(f"""WITH {O.PAIRS} SELECT s1_idx, cand_idx, CAST(len(a.name_tokens) AS INTEGER) AS ntok_len1, CAST(len(b.name_tokens) AS INTEGER) AS ntok_len2, CAST(length(a.name_compact) AS INTEGER) AS nc_len1,
  CAST(length(b.name_compact) AS INTEGER) AS nc_len2, CAST(len(b.addr_tokens) AS INTEGER) AS atok_len2, regexp_matches(b.business_name, '{O.SCRIPTS}')::INTEGER AS cand_nonlatin, regexp_matches(b.business_name, '(?i)(www\\.|\\.(com|net|org|co\\.in|in|fr)\\b)')::INTEGER AS cand_website,
  a.addr_empty::INTEGER AS s1_addr_empty, b.addr_empty::INTEGER AS cand_addr_empty, (b.src = 3)::INTEGER AS cand_is_s3 FROM pt""")
def size_and_flag_features(spark, sf):
    return _pairs(spark, sf).select("s1_idx", "cand_idx", *(c.alias(n) for n, c in P.size_and_flag_features().items()))


@query(f"""WITH {O.PAIRS}, o AS (SELECT s1_idx, cand_idx, a.addr_empty AS s1e, b.addr_empty AS ce, {O.overlap('atok', 'addr_tokens')} FROM pt)
SELECT s1_idx, cand_idx, atok_inter, CASE WHEN NOT (s1e OR ce) THEN atok_jac END AS atok_jac, CASE WHEN NOT (s1e OR ce) THEN atok_cont1 END AS atok_cont1,
  CASE WHEN NOT (s1e OR ce) THEN atok_cont2 END AS atok_cont2 FROM o""")
def missing_mask(spark, sf):
    pairs = _overlaps(spark, sf, {"atok": "addr_tokens"}, "addr_empty")
    made = P.overlap_shares("atok") | {n: F.col(c).cast("int") for n, c in (("s1_addr_empty", "addr_empty_1"), ("cand_addr_empty", "addr_empty_2"))}
    found = P.mask_missing_address(pairs.withColumns(made))
    return found.select("s1_idx", "cand_idx", "atok_inter", *(_r(c).alias(c) for c in ("atok_jac", "atok_cont1", "atok_cont2")))


_STAND_IN = """SELECT l_orderkey AS s1_idx, l_partkey AS cand_idx, floor(max(l_extendedprice))::DOUBLE AS blk_score, round(max(l_quantity) * 2, 0) AS nm_tset,
  CASE WHEN max(l_linenumber) % 3 <> 0 THEN round(max(l_discount) * 1000, 0) END AS ad_tset, max(l_suppkey) % 101 AS nc_ratio FROM lineitem GROUP BY 1, 2"""


def _stand_in(spark, sf):
    lines = spark.read.parquet(f"{sf}/lineitem.parquet").groupBy(F.col("l_orderkey").alias("s1_idx"), F.col("l_partkey").alias("cand_idx"))
    return lines.agg(F.floor(F.max("l_extendedprice")).cast("double").alias("blk_score"), _r(F.max("l_quantity") * 2, 0).alias("nm_tset"), F.when(F.max("l_linenumber") % 3 != 0, _r(F.max("l_discount") * 1000, 0)).alias("ad_tset"), (F.max("l_suppkey") % 101).alias("nc_ratio"))


@query(f"""WITH c AS ({_STAND_IN}) SELECT s1_idx, cand_idx, count(*) OVER (PARTITION BY cand_idx) AS cx_cand_n_s1, CAST(row_number() OVER (PARTITION BY cand_idx ORDER BY blk_score DESC, s1_idx) AS INTEGER) AS cx_cand_rank,
  round(blk_score - max(blk_score) OVER (PARTITION BY cand_idx), 6) AS cx_cand_gap, count(*) OVER (PARTITION BY s1_idx) AS cx_s1_n_cands FROM c""")
def ctx_candidate(spark, sf):
    found = P.candidate_context(_stand_in(spark, sf))
    return found.select("s1_idx", "cand_idx", "cx_cand_n_s1", "cx_cand_rank", _r("cx_cand_gap").alias("cx_cand_gap"), "cx_s1_n_cands")


def _gap(c: str) -> str:
    return f"round({c} - max({c}) OVER (PARTITION BY s1_idx), 6) AS cx_{c}_gap, CASE WHEN {c} IS NOT NULL THEN CAST(rank() OVER (PARTITION BY s1_idx ORDER BY {c} DESC NULLS LAST) AS DOUBLE) END AS cx_{c}_rank"


@query(f"""WITH c AS ({_STAND_IN}) SELECT s1_idx, cand_idx, {_gap('blk_score')}, {_gap('nm_tset')}, {_gap('nc_ratio')}, {_gap('ad_tset')},
  CAST(sum((nm_tset >= 90)::INTEGER) OVER (PARTITION BY s1_idx) AS BIGINT) AS cx_s1_n_strong_name,
  CAST(sum((nm_tset >= 90 AND coalesce(ad_tset, 0) >= 80)::INTEGER) OVER (PARTITION BY s1_idx) AS BIGINT) AS cx_s1_n_strong_both FROM c""")
def ctx_s1(spark, sf):
    found = P.s1_context(_stand_in(spark, sf))
    return found.select("s1_idx", "cand_idx", *((_r(c) if c.endswith("_gap") else F.col(c).cast("double") if c.endswith("_rank") else F.col(c)).alias(c) for c in found.columns if c.startswith("cx_")))


# -- decisions --------------------------------------------------------------------------------------------------------------------------------------


@query(f"""WITH {O.RECORDS}, {O.TWO_SCRIPTS} SELECT a.idx AS s1_idx, b.idx AS cand_idx, regexp_matches(b.business_name, '{O.SCRIPTS}')::INTEGER AS cand_nonlatin
  FROM two a JOIN two b ON b.idx = a.idx + 1""")
def flag_cand_nonlatin(spark, sf):
    records = normalize(world.two_scripts(spark, sf))
    pairs = records.select(F.col("idx").alias("s1_idx"), (F.col("idx") + 1).alias("cand_idx"))
    found = P.pair_table(pairs, records).filter("name_nonlatin_2 IS NOT NULL")
    return found.select("s1_idx", "cand_idx", P.size_and_flag_features()["cand_nonlatin"].alias("cand_nonlatin"))


@query("""SELECT l_orderkey AS s1_idx, l_linenumber AS cand_idx, """ + ", ".join(f"CASE WHEN l_linenumber % 3 <> 0 AND l_partkey % 4 <> 0 THEN {v} END AS {c}" for c, v in (("ad_ratio", "l_quantity::DOUBLE"), ("ad_tset", "l_tax::DOUBLE"), ("ad_partial", "l_discount::DOUBLE"), ("ad_tsort", "l_suppkey::DOUBLE"))) + """, l_partkey AS other FROM lineitem""")
def missing_mask_strings(spark, sf):
    rows = spark.read.parquet(f"{sf}/lineitem.parquet").select(
        F.col("l_orderkey").alias("s1_idx"), F.col("l_linenumber").alias("cand_idx"), *(F.col(v).cast("double").alias(c) for c, v in (("ad_ratio", "l_quantity"), ("ad_tset", "l_tax"), ("ad_partial", "l_discount"), ("ad_tsort", "l_suppkey"))),
        F.col("l_partkey").alias("other"), (F.col("l_linenumber") % 3 == 0).cast("int").alias("s1_addr_empty"), (F.col("l_partkey") % 4 == 0).cast("int").alias("cand_addr_empty"),
    )
    return P.mask_missing_address(rows).drop("s1_addr_empty", "cand_addr_empty")


@query(f"""WITH c AS ({_STAND_IN}), w AS (SELECT s1_idx, cand_idx, count(*) OVER (PARTITION BY cand_idx) AS cx_cand_n_s1, round(blk_score - max(blk_score) OVER (PARTITION BY cand_idx), 6) AS cx_cand_gap FROM c)
SELECT * FROM w WHERE {O.bucket('s1_idx', 3)} < 3000""")
def ctx_kept_subset(spark, sf):
    pairs = _stand_in(spark, sf)
    keep = pairs.select("s1_idx").distinct().filter(sampling.sampled(F.col("s1_idx"), 0.3, 3))
    return P.kept_context(pairs, keep).select("s1_idx", "cand_idx", "cx_cand_n_s1", _r("cx_cand_gap").alias("cx_cand_gap"))


@query(f"""WITH {O.SCORED}, c AS ({_STAND_IN}) SELECT c.s1_idx, c.cand_idx, CASE WHEN t.s1_idx IS NULL THEN 0 ELSE 1 END AS label, CASE WHEN {O.bucket('c.s1_idx', 13)} < 2000 THEN 'val' ELSE 'fit' END AS fold
  FROM c LEFT JOIN (SELECT DISTINCT s1_idx, cand_idx FROM scored WHERE label = 1 AND cand_idx % 3 <> 0) t ON c.s1_idx = t.s1_idx AND c.cand_idx = t.cand_idx""")
def label_fold_attach(spark, sf):
    truth = world.scored(spark, sf).filter("label = 1 AND cand_idx % 3 <> 0")
    meta = spark.read.parquet(f"{sf}/orders.parquet").select(F.col("o_orderkey").alias("s1_idx"), sampling.fold_of(F.col("o_orderkey")).alias("fold"))
    return P.with_labels(_stand_in(spark, sf).select("s1_idx", "cand_idx"), truth.unionByName(truth), meta)


@query(f"WITH c AS ({_STAND_IN}) SELECT s1_idx, cand_idx, nm_tset AS v_nm_tset, coalesce(ad_tset, -1) AS v_ad_tset, 0.0::DOUBLE AS m_nm_tset, (ad_tset IS NULL)::INTEGER::DOUBLE AS m_ad_tset FROM c")
def matrix_columns(spark, sf):
    rows, inputs = matcher.with_vector_inputs(_stand_in(spark, sf), ["nm_tset", "ad_tset"])
    return rows.select("s1_idx", "cand_idx", *(F.col(c).cast("double").alias(c) for c in inputs))


@query(f"WITH {O.SCORED} SELECT s1_idx, cand_idx, round((p / greatest(1 - p, 1e-9) * 0.25) / (1 + p / greatest(1 - p, 1e-9) * 0.25), 6) AS p FROM scored")
def calibrate_probs(spark, sf):
    return world.scored(spark, sf).select("s1_idx", "cand_idx", _r(matcher.correct_probability(F.col("p"), 0.25)).alias("p"))


@query(f"WITH {O.SCORED} SELECT s1_idx, cand_idx, label FROM owned")
def one_to_one(spark, sf):
    return D.one_to_one(world.scored(spark, sf)).select("s1_idx", "cand_idx", "label")


@query(f"WITH {O.SCORED} SELECT s1_idx, cand_idx, label FROM owned WHERE lead >= 0.15")
def one_to_one_abstain(spark, sf):
    return D.one_to_one(world.scored(spark, sf), 0.15).select("s1_idx", "cand_idx", "label")


@query(f"WITH {O.SCORED} SELECT s1_idx, cand_idx, label FROM scored WHERE p >= 0.7")
def select_threshold(spark, sf):
    return D.select_threshold(world.scored(spark, sf), 0.7).select("s1_idx", "cand_idx", "label")


@query(f"WITH {O.SCORED} SELECT s1_idx, cand_idx, label FROM {O.expected('scored', '0.3')}")
def select_expected_f(spark, sf):
    return D.select_expected_f(world.scored(spark, sf), 0.3).select("s1_idx", "cand_idx", "label")


@query(f"WITH {O.SCORED} SELECT round(avg({O.F05}), 6) AS macro_f05 FROM {O.entities('(SELECT * FROM owned WHERE p >= 0.7)')}")
def macro_f05(spark, sf):
    rule = {"rule": "threshold", "t": 0.7, "amb": 0.0}
    return D.macro_f05(D.apply_rule(world.scored(spark, sf), rule), world.scored_meta(spark, sf)).select(_r("macro_f05").alias("macro_f05"))


@query(f"WITH {O.SCORED} SELECT {O.BREAKDOWN} FROM {O.entities('(SELECT * FROM owned WHERE p >= 0.7)')}")
def breakdown(spark, sf):
    return D.breakdown(D.apply_rule(world.scored(spark, sf), {"rule": "threshold", "t": 0.7, "amb": 0.0}), world.scored_meta(spark, sf))


_GRID = ", ".join(f"({i}, '{r}', {v}::DOUBLE, {a}::DOUBLE)" for i, (r, v, a) in enumerate([("threshold", t, a) for t in D.THRESHOLDS for a in D.AMBIGUITY] + [("expected_f", m, a) for m in D.MIN_P for a in D.AMBIGUITY]))


@query(f"""WITH {O.SCORED}, g AS (SELECT * FROM (VALUES {_GRID}) t(grid, rule, value, amb)),
met AS (SELECT * FROM owned, g WHERE amb = 0 OR lead >= amb), ex AS (SELECT * FROM met WHERE rule = 'expected_f'),
pred AS (SELECT grid, s1_idx, label FROM met WHERE rule = 'threshold' AND p >= value UNION ALL SELECT grid, s1_idx, label FROM {O.expected('ex', 'value', 'grid, s1_idx')}),
c AS (SELECT grid, s1_idx, count(*) AS n_pred, sum(label) AS tp FROM pred GROUP BY ALL),
e AS (SELECT g.grid, g.rule, g.value, g.amb, m.n_true, coalesce(c.n_pred, 0) AS n_pred, coalesce(c.tp, 0) AS tp FROM g CROSS JOIN smeta m LEFT JOIN c ON c.grid = g.grid AND c.s1_idx = m.s1_idx)
SELECT grid, rule, value, amb, round(avg({O.F05}), 6) AS macro_f05 FROM e GROUP BY ALL""")
def tune_grid(spark, sf):
    return D.tune(world.scored(spark, sf), world.scored_meta(spark, sf))


_BY = "(SELECT m.*, o_orderpriority AS priority FROM smeta m JOIN orders ON s1_idx = o_orderkey)"


@query(f"WITH {O.SCORED} SELECT priority, count(*) AS n, round(avg({O.F05}), 6) AS macro_f05, {O.BREAKDOWN} FROM {O.entities('(SELECT * FROM owned WHERE p >= 0.7)', _BY)} GROUP BY priority")
def metrics_by_country(spark, sf):
    orders = spark.read.parquet(f"{sf}/orders.parquet").select(F.col("o_orderkey").alias("s1_idx"), F.col("o_orderpriority").alias("priority"))
    predicted = D.apply_rule(world.scored(spark, sf), {"rule": "threshold", "t": 0.7, "amb": 0.0})
    return D.metrics_by(predicted, world.scored_meta(spark, sf).join(orders, "s1_idx"), "priority")


# -- evaluation --------------------------------------------------------------------------------------------------------------------------------------


def _lists(spark, sf):
    pairs = world.scored(spark, sf).select(F.col("s1_idx").cast("string").alias("id"), F.col("cand_idx").cast("string").alias("c"), "p", "label")
    ids = spark.read.parquet(f"{sf}/orders.parquet").select(F.col("o_orderkey").cast("string").alias("id"))
    empty = F.array().cast("array<string>")
    of = lambda rows: ids.join(rows.groupBy("id").agg(F.collect_set("c").alias("ids")), "id", "left").select("id", F.coalesce("ids", empty).alias("ids"))
    return of(pairs.filter("p >= 0.7")), of(pairs.filter("label = 1"))


@query(f"""WITH {O.SCORED}, e AS {O.entities('(SELECT * FROM scored WHERE p >= 0.7)')}
SELECT round(avg({O.F05}), 6) AS macro_f05, count(*) AS n, CAST(sum((n_true = 0)::INTEGER) AS BIGINT) AS n_singletons, CAST(sum((n_true = 0 AND n_pred = 0)::INTEGER) AS BIGINT) AS n_singletons_right FROM e""")
def score_lists(spark, sf):
    predicted, truth = _lists(spark, sf)
    return E.score_lists(predicted, truth)


@query("""WITH l AS (SELECT CAST(e.user_id AS VARCHAR) AS id, e.event_id AS r, 'S' || (e.event_id % 5) || '-' || (e.event_id % 7) || ',S2-' || (e.event_id % 3) AS list FROM events e),
i AS (SELECT id, r, unnest(string_split(list, ',')) AS item FROM l), q AS (SELECT CAST(c_custkey AS VARCHAR) AS id FROM customer),
v AS (SELECT 'duplicate_row' AS rule, id FROM l GROUP BY id HAVING count(*) > 1
  UNION SELECT 'repeated_id', id FROM (SELECT id, r FROM i GROUP BY id, r HAVING count(*) > count(DISTINCT item))
  UNION SELECT 'self_match', item FROM i WHERE item LIKE 'S1-%'
  UNION SELECT 'wrong_prefix', item FROM i WHERE NOT regexp_matches(item, '^S[123]-')
  UNION SELECT 'missing_row', id FROM q WHERE id NOT IN (SELECT id FROM l)
  UNION SELECT 'extra_row', id FROM l WHERE id NOT IN (SELECT id FROM q)
  UNION SELECT 'unknown_id', item FROM i WHERE regexp_matches(item, '^S[23]-') AND item NOT IN (SELECT 'S2-' || s_suppkey FROM supplier))
SELECT rule, count(*) AS n, array_to_string(list_slice(list_sort(list(id)), 1, 5), ',') AS examples FROM v GROUP BY rule""")
def validate_lists(spark, sf):
    k = F.col("event_id")
    part = lambda p, n: F.concat(F.lit(p), (k % n).cast("string"))
    lists = spark.read.parquet(f"{sf}/events.parquet").select(F.col("user_id").cast("string").alias("id"), F.concat(part("S", 5), part("-", 7), part(",S2-", 3)).alias("list"))
    required = spark.read.parquet(f"{sf}/customer.parquet").select(F.col("c_custkey").cast("string").alias("id"))
    valid = spark.read.parquet(f"{sf}/supplier.parquet").select(F.concat(F.lit("S2-"), F.col("s_suppkey").cast("string")).alias("id"))
    return E.violations(lists, required, valid).select("rule", "n", F.array_join("examples", ",").alias("examples"))


@query(f"""WITH {O.SCORED}, m AS (SELECT s1_idx, cand_idx FROM scored WHERE p >= 0.7), c AS (SELECT s1_idx, cand_idx FROM scored WHERE label = 1)
SELECT CAST(s1_idx AS VARCHAR) AS id, string_agg(CAST(cand_idx AS VARCHAR), ',' ORDER BY CAST(cand_idx AS VARCHAR)) AS ids FROM m
WHERE NOT EXISTS (SELECT 1 FROM c WHERE c.s1_idx = m.s1_idx AND c.cand_idx = m.cand_idx) GROUP BY s1_idx""")
def matches_outside_candidates(spark, sf):
    matches, candidates = _lists(spark, sf)
    return E.not_candidates(matches, candidates).select("id", F.array_join(F.array_sort("ids"), ",").alias("ids"))


@query(f"""WITH {O.SCORED} SELECT s1_idx, cand_idx, round(p, 6) AS p, a.c_name AS name_1, b.c_name AS name_2 FROM (SELECT * FROM owned WHERE p >= 0.7 AND label = 0 ORDER BY p DESC, s1_idx, cand_idx LIMIT 50)
LEFT JOIN customer a ON a.c_custkey = s1_idx LEFT JOIN customer b ON b.c_custkey = cand_idx""")
def errors_fp(spark, sf):
    predicted = D.apply_rule(world.scored(spark, sf), {"rule": "threshold", "t": 0.7, "amb": 0.0})
    records = spark.read.parquet(f"{sf}/customer.parquet").select(F.col("c_custkey").alias("idx"), F.col("c_name").alias("business_name"), F.col("c_mktsegment").alias("business_address"))
    return E.false_positives(predicted, records).select("s1_idx", "cand_idx", _r("p").alias("p"), "name_1", "name_2")


@query(f"""WITH {O.SCORED} SELECT t.s1_idx, t.cand_idx, round(k.p, 6) AS p FROM (SELECT * FROM scored WHERE label = 1) t
LEFT JOIN (SELECT * FROM scored WHERE p >= 0.05) k USING (s1_idx, cand_idx) WHERE NOT EXISTS (SELECT 1 FROM owned o WHERE o.p >= 0.7 AND o.s1_idx = t.s1_idx AND o.cand_idx = t.cand_idx)""")
def errors_fn(spark, sf):
    scored = world.scored(spark, sf)
    predicted = D.apply_rule(scored, {"rule": "threshold", "t": 0.7, "amb": 0.0})
    return E.false_negatives(scored.filter("label = 1"), predicted, scored.filter("p >= 0.05")).withColumn("p", _r("p"))


@query()
def gbt_predict(spark, sf):
    """Train on the fit fold of the noisy world of whole records, and score all of its candidates."""
    records, truth = world.whole_noisy_world(spark, sf)
    found = stash(normalize(records), "records")
    meta = sampling.s1_meta(found, truth)
    pairs = stash(P.build_features(B.generate_candidates(found).drop("from_extra"), found, truth, meta), "features")
    model = matcher.train(pairs, P.feature_columns(pairs))
    return matcher.predict(model, pairs)
