"""The batch flows: train (prepare, block, features, fit, tune) and predict (block, features, score, decide, export)."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field, replace
from pathlib import Path

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pairloom.functions.text import NON_LATIN
from pairloom.operators import blocking, decide, features, matcher, sampling, translit, vectors
from pairloom.operators.normalize import normalize
from pairloom.plans import evaluate
from pairloom.sources import tables


#: Rows of a sampled report.
ERRORS = 50


@dataclass
class Settings:
    """Options of both flows."""

    val_fraction: float = 0.2
    sample_fraction: float = 1.0
    feature_s1_fraction: float = 1.0
    k: dict[str, int] = field(default_factory=lambda: dict(blocking.K))
    max_candidates: int = blocking.MAX_CANDIDATES
    max_df_fraction: float = blocking.MAX_DF_FRACTION
    negative_fraction: float = 1.0
    max_df: int | None = None
    rounds: int = 3000
    early_stop: int = 100
    learning_rate: float = 0.05
    model: dict = field(default_factory=dict)
    model_dir: str | None = None
    #: Neighbours by embedding that each source-1 record gets as candidates; 0: no embedding channel.
    embed_k: int = 0
    encoder: Callable[[], Callable] = field(default=lambda: vectors.hashed_ngrams)
    skip_existing: bool = False


class Work:
    """Tables of a run, as Parquet in one folder; with skip_existing a table that is there is not made again."""

    def __init__(self, spark: SparkSession, folder: str, skip_existing: bool = False):
        self.spark, self.folder, self.skip_existing = spark, folder.rstrip("/"), skip_existing

    def path(self, name: str) -> str:
        return f"{self.folder}/{name}"

    def model_path(self, settings: Settings) -> str:
        return settings.model_dir or self.path("model")

    def exists(self, name: str) -> bool:
        return tables.exists(self.spark, self.path(f"{name}/_SUCCESS"))

    def table(self, name: str, make: Callable[[], DataFrame], partition_by: str | None = None) -> DataFrame:
        if not (self.skip_existing and self.exists(name)):
            writer = make().write.mode("overwrite")
            (writer.partitionBy(partition_by) if partition_by else writer).parquet(self.path(name))
        return self.spark.read.parquet(self.path(name))


def with_ids(truth: DataFrame, records: DataFrame) -> DataFrame:
    """(s1_id, cand_id) to (s1_idx, cand_idx)."""
    left = records.filter("src = 1").select(F.col("entity_id").alias("s1_id"), F.col("idx").alias("s1_idx"))
    right = records.filter("src <> 1").select(F.col("entity_id").alias("cand_id"), F.col("idx").alias("cand_idx"))
    return truth.join(left, "s1_id").join(right, "cand_id").select("s1_idx", "cand_idx").distinct()


def fit_pairs(truth: DataFrame, meta: DataFrame) -> DataFrame:
    """True pairs of the fit fold: nothing that is learned may see the others."""
    return truth.join(meta.filter("fold = 'fit'").select("s1_idx"), "s1_idx", "left_semi")


def name_pairs(truth: DataFrame, meta: DataFrame, records: DataFrame, script: str = NON_LATIN) -> DataFrame:
    """(n1, n2) names of true pairs of the fit fold, for the dictionary."""
    names = records.select("idx", "business_name")
    fit = fit_pairs(truth, meta).join(names.toDF("s1_idx", "n1"), "s1_idx").join(names.toDF("cand_idx", "n2"), "cand_idx")
    return fit.filter(F.col("n2").rlike(script)).select("n1", "n2")


def prepare(work: Work, raw: DataFrame, truth: DataFrame, settings: Settings) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(records, truth, meta) of a training world, and the learned dictionary, as tables."""
    if settings.sample_fraction < 1:
        raw = sampling.mini_world(raw, truth, settings.sample_fraction)
        truth = truth.join(raw.select(F.col("idx").alias("s1_idx")), "s1_idx", "left_semi")
    truth = work.table("truth", lambda: truth)
    meta = work.table("meta", lambda: sampling.s1_meta(raw, truth, settings.val_fraction))
    dictionary = work.table("translit", lambda: translit.learn_dictionary(name_pairs(truth, meta, raw)))
    records = work.table("records", lambda: normalize(translit.transliterated(raw, dictionary), romanized=True), "country")
    return records, truth, meta


def embed(work: Work, records: DataFrame, settings: Settings, prefix: str = "") -> DataFrame:
    """(idx, country, src, embedding) of all records, as a table."""
    return work.table(f"{prefix}embeddings", lambda: vectors.encode(vectors.record_texts(records), settings.encoder).drop("text"))


def block(work: Work, records: DataFrame, settings: Settings, prefix: str = "") -> tuple[DataFrame, DataFrame | None]:
    """(candidates, embeddings) as tables; with an embedding channel its neighbours are among the candidates."""
    found = embed(work, records, settings, prefix) if settings.embed_k else None
    extra = None
    if found is not None:
        extra = work.table(f"{prefix}neighbours", lambda: vectors.knn(found.filter("src = 1"), found.filter("src <> 1"), settings.embed_k)).select("s1_idx", "cand_idx")
    make = lambda: blocking.generate_candidates(records, extra, k=settings.k, most=settings.max_candidates, max_df_fraction=settings.max_df_fraction, max_df=settings.max_df)
    return work.table(f"{prefix}candidates", make), found


def training_features(work: Work, records: DataFrame, truth: DataFrame, meta: DataFrame, settings: Settings) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(pairs, candidates, meta of the source-1 records that have pairs) as tables."""
    candidates, embeddings = block(work, records, settings)
    keep = meta.filter(sampling.sampled(F.col("s1_idx"), settings.feature_s1_fraction, 3))
    pairs = work.table("features", lambda: features.build_features(candidates.drop("from_extra"), records, truth, meta, keep, embeddings))
    return pairs, candidates, keep


def fit(work: Work, pairs: DataFrame, settings: Settings) -> PipelineModel:
    """The model of a table of labelled pairs, saved with its importance."""
    params = {"stepSize": settings.learning_rate} | settings.model
    model = matcher.train(pairs, features.feature_columns(pairs), settings.negative_fraction, settings.rounds, settings.early_stop, **params)
    folder = work.model_path(settings)
    model.write().overwrite().save(folder)
    matcher.feature_importance(model).coalesce(1).write.mode("overwrite").csv(work.path("importance"), header=True)
    return model


def train(spark: SparkSession, raw: DataFrame, truth: DataFrame, folder: str, settings: Settings = Settings()) -> dict:
    """Fit a model and choose a rule from raw records (idx, entity_id, src, country, business_name, business_address) and true pairs.

    Everything that predict() needs is left in `folder`; returns the validation report.
    """
    work = Work(spark, folder, settings.skip_existing)
    records, truth, meta = prepare(work, raw, truth, settings)
    pairs, candidates, keep = training_features(work, records, truth, meta, settings)
    report = blocking.blocking_report(candidates, truth, meta).first().asDict()
    model = fit(work, pairs, settings)
    scored = work.table("scored", lambda: matcher.predict(model, pairs.filter("fold = 'val'"), settings.negative_fraction))
    held = keep.filter("fold = 'val'")
    best = decide.tune(scored, held).first()
    rule = {"rule": best.rule, "t" if best.rule == "threshold" else "min_p": best.value, "amb": best.amb}
    predicted = decide.apply_rule(scored, rule)
    report |= {"macro_f05": best.macro_f05, "rule": rule} | decide.breakdown(predicted, held).first().asDict()
    tables.save_json(spark, rule | {"negative_fraction": settings.negative_fraction, "embed_k": settings.embed_k}, work.path("decision.json"))
    tables.save_json(spark, report, work.path("report.json"))
    return report


def predict(spark: SparkSession, raw: DataFrame, folder: str, output: str, rule: dict, settings: Settings = Settings()) -> tuple[DataFrame, DataFrame]:
    """(matches, candidates) id lists of every source-1 record, with the model in `folder`; written below `output` as TSV."""
    work = Work(spark, folder, settings.skip_existing)
    settings = replace(settings, embed_k=rule.get("embed_k", settings.embed_k))
    dictionary = spark.read.parquet(work.path("translit"))
    records = work.table("test_records", lambda: normalize(translit.transliterated(raw, dictionary), romanized=True), "country")
    candidates, embeddings = block(work, records, settings, "test_")
    pairs = work.table("test_features", lambda: features.build_features(candidates.drop("from_extra"), records, embeddings=embeddings))
    scored = matcher.predict(PipelineModel.load(work.model_path(settings)), pairs, rule.get("negative_fraction", 1.0))
    chosen = decide.apply_rule(scored, rule)
    ids = records.select("idx", "entity_id")
    named = lambda pairs, order: (
        pairs.select("s1_idx", "cand_idx", order.alias("_order")).join(ids.toDF("s1_idx", "source1_entity_id"), "s1_idx").join(ids.toDF("cand_idx", "cand_id"), "cand_idx")
    )
    asked = records.filter("src = 1").select(F.col("entity_id").alias("source1_entity_id"))
    matches = tables.id_lists(asked, named(chosen, -F.col("p")), "source1_entity_id", "cand_id", "_order", "matched_entity_ids")
    listed = tables.id_lists(asked, named(candidates, F.col("blk_rank")), "source1_entity_id", "cand_id", "_order", "candidate_entity_ids")
    tables.write_tsv(matches, f"{output}/matching_results")
    tables.write_tsv(listed, f"{output}/candidate_pairs")
    return matches, listed


def analyze(spark: SparkSession, folder: str, rule: dict) -> dict[str, DataFrame]:
    """Metrics by country, and the errors of the validation fold, from the tables that train() left."""
    work = Work(spark, folder)
    scored, truth, meta, records = (spark.read.parquet(work.path(n)) for n in ("scored", "truth", "meta", "records"))
    held = meta.filter("fold = 'val'")
    predicted = decide.apply_rule(scored, rule)
    countries = held.join(records.select(F.col("idx").alias("s1_idx"), "country"), "s1_idx")
    asked = truth.join(held.select("s1_idx"), "s1_idx", "left_semi")
    missed = evaluate.false_negatives(asked, predicted, scored)
    return {
        "by_country": decide.metrics_by(predicted, countries, "country"),
        "false_positives": evaluate.false_positives(predicted, records),
        "false_negatives": missed,
        "false_negatives_sample": sampling.error_sample(missed.withColumn("pair", F.concat_ws("-", "s1_idx", "cand_idx")), "pair", ERRORS).drop("pair"),
    }


def package(files: dict[str, str], code: str, out: str, skip: tuple[str, ...] = ("__pycache__", ".git", ".venv", "venv", "work", "models")) -> list[str]:
    """Zip named files and a code folder; every file must be there. Returns the names in the archive."""
    import zipfile

    missing = [p for p in files.values() if not Path(p).exists()]
    if missing:
        raise FileNotFoundError(", ".join(missing))
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as archive:
        for name, path in files.items():
            archive.write(path, name)
        for path in sorted(Path(code).rglob("*")):
            relative = path.relative_to(code)
            if path.is_file() and path.suffix != ".pyc" and not set(relative.parts) & set(skip):
                archive.write(path, f"code/{relative}")
        return sorted(archive.namelist())
