"""Language identification by hierarchical discrimination.

A text is a sparse vector: the shares of its hashed byte n-grams (1 to 3 bytes, A-Z lower-cased, other ASCII characters than letters as
one blank), square-rooted and scaled to length 1. First, one-versus-rest linear support vector machines over families of
languages name the family; then one-versus-one linear support vector machines between the languages of that family vote, and
margins break ties. The families are the branches that FAMILIES lists; a language that it misses is a family of its own.

Scale. Prediction is one narrow Arrow pass over whole texts; the model (one weight vector for each family and for each pair inside a
family) is broadcast, and its size depends on the languages, not on the rows. Learning takes at most SAMPLE rows, the first by a
hash of doc_id in each language; only their hashed vectors reach the driver.

Defined results. Null texts and texts without a letter are 'und' with score 0. Rows without lang teach nothing. With a single language in the
sample, each text with a letter is in it, with score 1; with none, all are 'und'. Ties of votes and margins go to the smaller code. Repeated
rows get equal results. An empty table gives an empty table. Input columns named as an added column are replaced; lang, source
and doc_id are no input of a prediction.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pairloom.llm.common import annotate, crc_bucket, utf8

BITS = 12
DIMENSIONS = 1 << BITS
SAMPLE = 4_000
FOLDS, HELD_OUT = 3, 1
UNKNOWN = "und"
#: Branches of the languages by ISO 639 code. Fixed values.
FAMILIES = {
    "germanic": ("da", "de", "en", "fy", "is", "lb", "nb", "nl", "nn", "no", "sv"),
    "romance": ("ca", "es", "fr", "gl", "it", "la", "oc", "pt", "ro"),
    "slavic": ("be", "bg", "bs", "cs", "hr", "mk", "pl", "ru", "sk", "sl", "sr", "uk"),
    "uralic": ("et", "fi", "hu"),
    "baltic": ("lt", "lv"),
    "turkic": ("az", "kk", "tr", "uz"),
    "indic": ("bn", "gu", "hi", "mr", "ne", "pa", "ur"),
}
ADDED = T.StructType([T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
_FOLD = np.array([c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256)], np.uint32)
_FOLD_BYTES = bytes(_FOLD.astype(np.uint8))
_ASCII_LETTER = re.compile(rb"[A-Za-z]")
_PIECE = 1 << 20


def family_of(lang: str) -> str:
    return next((f for f, members in FAMILIES.items() if lang.split("-")[0].lower() in members), lang)


def has_letter(text: bytes | None) -> bool:
    """Any character of a Unicode letter category."""
    return bool(text) and (_ASCII_LETTER.search(text) is not None or any(map(str.isalpha, text.decode())))


def counts_of(text: bytes) -> np.ndarray:
    """Counts of the hashed n-grams of a text; long texts in pieces, which overlap by the n-grams' length."""
    total = np.zeros(DIMENSIONS, np.int64)
    text = b" ".join((b" " + text.translate(_FOLD_BYTES) + b" ").split(b"  ")) if b"  " in text else b" " + text.translate(_FOLD_BYTES) + b" "
    for start in range(0, len(text), _PIECE):
        x = np.frombuffer(text, np.uint8)[start : start + _PIECE + 2].astype(np.uint32)
        # n-grams of 2 and 3 bytes that begin in this piece
        pair = x[:-1] << np.uint32(8) | x[1:]
        third = pair[:-1] << np.uint32(8) | x[2:]
        for k, grams in enumerate((x[:_PIECE], pair[:_PIECE], third[:_PIECE])):
            total += np.bincount((grams * np.uint32(2654435761) + np.uint32(k * 0x9E3779B1 % (1 << 32))) >> np.uint32(32 - BITS), minlength=DIMENSIONS)
    return total


def vector(text: bytes) -> np.ndarray:
    found = np.sqrt(counts_of(text).astype(np.float32))
    return found / max(float(np.sqrt(found @ found)), 1e-9)


def train_svm(x: np.ndarray, y: np.ndarray, penalty: float = 1e-4, epochs: int = 12) -> np.ndarray:
    """Weights (the bias last) of a linear support vector machine, by averaged Pegasos steps over batches. y is 1 or -1."""
    rng = np.random.default_rng(5)
    w = np.zeros(x.shape[1] + 1, np.float64)
    mean, seen, step = np.zeros_like(w), 0, 0
    share = np.where(y > 0, 0.5 / max((y > 0).mean(), 1e-9), 0.5 / max((y < 0).mean(), 1e-9))
    for epoch in range(epochs):
        for rows in np.array_split(rng.permutation(len(y)), max(1, len(y) // 64)):
            step += 1
            eta = 1 / (penalty * (step + 1 / penalty / 10))
            xb, yb = x[rows], y[rows]
            active = yb * (xb @ w[:-1] + w[-1]) < 1
            pull = (yb * share[rows])[active]
            w[:-1] *= 1 - eta * penalty
            w[:-1] += eta / len(rows) * (pull @ xb[active])
            w[-1] += 0.1 * eta / len(rows) * pull.sum()
            if epoch >= epochs // 2:
                mean += w
                seen += 1
    return (mean / max(seen, 1)).astype(np.float32)


def learn(x: np.ndarray, langs: list[str]) -> dict:
    """The two levels of machines from vectors and their languages."""
    known = sorted(set(langs))
    families = {f: [g for g in known if family_of(g) == f] for f in sorted({family_of(g) for g in known})}
    lang = np.array(langs, object)
    family = np.array([family_of(g) for g in langs], object)
    first = {f: train_svm(x, np.where(family == f, 1.0, -1.0)) for f in families} if len(families) > 1 else {}
    pairs = {}
    for members in families.values():
        for a, b in combinations(members, 2):
            rows = (lang == a) | (lang == b)
            pairs[a, b] = train_svm(x[rows], np.where(lang[rows] == a, 1.0, -1.0))
    return {"families": families, "first": first, "pairs": pairs}


class Model:
    """A learned model, its weights as one matrix."""

    def __init__(self, learned: dict):
        self.families = list(learned["families"].items())
        self.pairs = list(learned["pairs"])
        weights = [*learned["first"].values(), *learned["pairs"].values()]
        self.n_first = len(learned["first"])
        self.weights = np.array(weights, np.float32).reshape(-1, DIMENSIONS + 1)

    def predict(self, text: bytes | None) -> tuple[str, float]:
        if not self.families or not has_letter(text):
            return UNKNOWN, 0.0
        margins = self.weights[:, :-1] @ vector(text) + self.weights[:, -1]
        best, score = 0, 1.0
        if self.n_first:
            best = int(margins[: self.n_first].argmax())
            others = np.delete(margins[: self.n_first], best).max()
            score = 1 / (1 + np.exp(-2.0 * float(margins[best] - others)))
        members = self.families[best][1]
        if len(members) == 1:
            return members[0], float(score)
        votes = {g: [0, 0.0] for g in members}
        for (a, b), m in zip(self.pairs, margins[self.n_first :].tolist()):
            if a in votes:
                votes[a if m >= 0 else b][0] += 1
                votes[a][1] += m
                votes[b][1] -= m
        winner = min(members, key=lambda g: (-votes[g][0], -votes[g][1], g))
        closest = min((abs(m) if (m >= 0) == (a == winner) else -abs(m)) for (a, b), m in zip(self.pairs, margins[self.n_first :].tolist()) if winner in (a, b))
        return winner, float(score / (1 + np.exp(-2.0 * closest)))


def fit(docs: DataFrame, sample: int = SAMPLE) -> Model:
    """A model from at most `sample` rows of `docs` (doc_id, text, lang), none of the held-out fold, as many of each language."""
    spark = docs.sparkSession
    known = docs.select("doc_id", "lang").filter("lang IS NOT NULL AND doc_id IS NOT NULL").filter(crc_bucket(F.col("doc_id"), FOLDS) != HELD_OUT).distinct()
    digest = F.md5(F.col("doc_id").cast("string"))
    n_langs = max(1, known.select("lang").distinct().count())
    # Only hashes below a bound that leaves some times the wanted rows of a language are ranked, so a common one meets in no single task.
    counts = known.groupBy("lang").agg(F.count("*").alias("_n")).withColumnRenamed("lang", "_l")
    each = max(1, sample // n_langs)
    draw = known.join(F.broadcast(counts) if n_langs <= sample else counts, F.col("lang") == F.col("_l")).withColumn("_h", digest)
    draw = draw.filter(F.conv(F.substring("_h", 1, 8), 16, 10).cast("double") / 2**32 <= 4.0 * each / F.col("_n") + 64.0 / F.col("_n"))
    ranked = draw.withColumn("_k", F.row_number().over(Window.partitionBy("lang").orderBy("_h", "doc_id"))).filter(F.col("_k") <= each)
    chosen = ranked.select(F.col("doc_id").alias("_id"), F.col("lang").alias("_lang"), "_h").orderBy("_h", "_id", "_lang").limit(sample)
    # broadcast: `sample` bounds the rows
    rows = docs.select("doc_id", "text", "lang").join(F.broadcast(chosen), (F.col("doc_id") == F.col("_id")) & (F.col("lang") == F.col("_lang"))).select("text", "_lang", "_h")

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = utf8(batch.column(0))
            kept = [i for i, t in enumerate(texts) if has_letter(t)]
            found = [counts_of(texts[i]) for i in kept]
            where = [np.flatnonzero(c) for c in found]
            arrays = [pa.array([w.astype(np.int32) for w in where], pa.list_(pa.int32())), pa.array([c[w].astype(np.int32) for c, w in zip(found, where)], pa.list_(pa.int32()))]
            yield pa.RecordBatch.from_arrays([batch.column(1).take(pa.array(kept, pa.int64())), batch.column(2).take(pa.array(kept, pa.int64())), *arrays], names=["lang", "h", "at", "n"])

    counted = rows.mapInArrow(vectors, "lang string, h string, at array<int>, n array<int>")
    # Of the rows of a doc_id and language the one with the least counts teaches, so `sample` bounds the rows.
    least = counted.groupBy("lang", "h").agg(F.min(F.struct("at", "n")).alias("v")).select("lang", "h", "v.at", "v.n")
    table = least.toArrow().sort_by([("h", "ascending"), ("lang", "ascending")])
    x = np.zeros((table.num_rows, DIMENSIONS), np.float32)
    for i, (at, n) in enumerate(zip(table.column("at").combine_chunks(), table.column("n").combine_chunks())):
        x[i, at.values.to_numpy()] = np.sqrt(n.values.to_numpy())
    x /= np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9)
    return Model(learn(x, table.column("lang").to_pylist()))


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """`docs` with lang_pred and score."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(texts: list[bytes | None]) -> list[pa.Array]:
        found = [shared.value.predict(t) for t in texts]
        return [pa.array([g for g, _ in found], pa.string()), pa.array([s for _, s in found], pa.float64())]

    return annotate(docs, run, ADDED)


def query(spark, sf_dir: str) -> DataFrame:
    """op9: the language of every document."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang")
    found = identify(docs.select("doc_id", "text"), fit(docs))
    return found.select("doc_id", (crc_bucket(F.col("doc_id"), FOLDS) == HELD_OUT).alias("held_out"), "lang_pred", "score")
