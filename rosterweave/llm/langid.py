"""Language identification in two steps: the family, then the language within it.

A text is described by the relative counts of its hashed byte n-grams (1 to 3 bytes, lower case, everything but letters as one
space). Linear support vector machines, one for each family against the rest, give the family; within it, one for each pair of
languages votes, and margins break ties. All are fitted on the driver by dual coordinate descent on a bounded sample of labelled
documents; the rest of the work is one pass over whole texts.

A document teaches only if its label is not null and crc32(doc_id as text) mod 3 is not 1; a null doc_id counts as the empty text.
A text teaches a language once, however often it occurs. SAMPLE texts at most teach in all, SAMPLE_PER_LANGUAGE of a language, chosen
by a hash of the text; with more languages than SAMPLE, those with the most rows are learned (by code, where these are equal).

A null text, or one without a letter, is `und` with score 0. Without anything to learn from, every text is `und`. Of families with equal
margins the first by name wins, of a pair the first, of languages with equal votes and margins the first by code. Repeated rows are
predicted each time; very long texts are read whole; other columns of the input are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rosterweave.llm.common import smallest
from rosterweave.shipping import ship

#: Labelled texts that the machines are fitted on: of a language, and in all; the bound of the sample.
SAMPLE_PER_LANGUAGE, SAMPLE = 400, 3200
UNDETERMINED = "und"

#: Language codes of a family. A code that is in none is a family of its own.
FAMILIES = {
    "germanic": "en de nl sv da no nb nn is fo af lb yi fy".split(),
    "romance": "fr es it pt ro ca gl oc la".split(),
    "slavic": "ru uk be pl cs sk sl hr sr bs mk bg".split(),
    "uralic": "fi et hu".split(),
    "turkic": "tr az kk uz ky tk".split(),
    "semitic": "ar he mt am".split(),
    "indo-iranian": "hi ur bn fa ps ku mr gu pa ne si".split(),
    "sinitic": "zh yue wuu".split(),
}

BIGRAMS, TRIGRAMS = 2048, 8192
DIMENSIONS = 256 + BIGRAMS + TRIGRAMS
_BLOCK = 1 << 21
_letter = regex.compile(r"\p{L}")
_not_letters = regex.compile(r"[^\p{L}\p{M}]+")


def family_of(lang: str) -> str:
    return next((f for f, codes in FAMILIES.items() if lang.split("-")[0].lower() in codes), lang)


def counts(text: str) -> np.ndarray:
    """Hashed n-gram counts of a whole text, divided by their sum."""
    raw = np.frombuffer((" " + _not_letters.sub(" ", text.lower()).strip() + " ").encode("utf-8", "surrogatepass"), dtype=np.uint8)
    out = np.zeros(DIMENSIONS, dtype=np.int64)
    for at in range(0, len(raw), _BLOCK):
        b = raw[at : at + _BLOCK + 2].astype(np.uint32)
        one, two = b[:_BLOCK], b[:-1][:_BLOCK] * np.uint32(2654435761) + b[1:][:_BLOCK] * np.uint32(2246822519)
        three = two[: len(b) - 2] + b[2:] * np.uint32(3266489917)
        out[:256] += np.bincount(one, minlength=256)
        out[256 : 256 + BIGRAMS] += np.bincount(two >> np.uint32(21), minlength=BIGRAMS)
        out[256 + BIGRAMS :] += np.bincount(three >> np.uint32(19), minlength=TRIGRAMS)
    return (out / max(1, out.sum())).astype(np.float32)


def linear_svm(x: np.ndarray, y: np.ndarray, cost: float = 1.0, epochs: int = 30, seed: int = 0) -> np.ndarray:
    """Weights of the L2-regularised hinge loss by dual coordinate descent; y is +1 or -1, classes weigh alike."""
    rng, w, alpha = np.random.default_rng(seed), np.zeros(x.shape[1], dtype=np.float64), np.zeros(len(y))
    square = np.einsum("ij,ij->i", x, x) + 1e-12
    top = np.where(y > 0, cost * len(y) / (2 * max(1, (y > 0).sum())), cost * len(y) / (2 * max(1, (y < 0).sum())))
    for _ in range(epochs):
        moved = 0.0
        for i in rng.permutation(len(y)):
            new = min(max(alpha[i] - (y[i] * np.einsum("i,i->", x[i], w) - 1) / square[i], 0.0), top[i])  # einsum: no threads for one row
            if new != alpha[i]:
                moved = max(moved, abs(new - alpha[i]) / top[i])
                w += (new - alpha[i]) * y[i] * x[i]
                alpha[i] = new
        if moved < 1e-3:
            break
    return w


@dataclass
class Hierarchy:
    """Families against the rest, then pairs within a family; columns of `weights` in that order."""

    languages: list[str] = field(default_factory=list)
    families: list[str] = field(default_factory=list)
    pairs: list[tuple[str, str]] = field(default_factory=list)
    weights: np.ndarray = field(default_factory=lambda: np.zeros((DIMENSIONS, 0), dtype=np.float32))
    bias: np.ndarray = field(default_factory=lambda: np.zeros(0))

    @classmethod
    def fit(cls, x: np.ndarray, langs: list[str]) -> Hierarchy:
        if not langs:
            return cls()
        mean, scale = x.mean(axis=0), 1 / (x.std(axis=0) + 1e-4)
        z = np.hstack([(x - mean) * scale / np.sqrt(x.shape[1]), np.ones((len(x), 1), dtype=np.float32)]).astype(np.float64)
        lang, fam = np.array(langs), np.array([family_of(v) for v in langs])
        languages, families = sorted(set(langs)), sorted(set(fam))
        columns = [linear_svm(z, np.where(fam == f, 1.0, -1.0)) for f in families] if len(families) > 1 else []
        pairs = [p for f in families for p in itertools.combinations([v for v in languages if family_of(v) == f], 2)]
        for a, b in pairs:
            own = np.isin(lang, (a, b))
            columns.append(linear_svm(z[own], np.where(lang[own] == a, 1.0, -1.0)))
        w = np.array(columns).T if columns else np.zeros((z.shape[1], 0))
        slopes = w[:-1] * (scale / np.sqrt(x.shape[1]))[:, None]
        return cls(languages, families, pairs, slopes.astype(np.float32), w[-1] - mean @ slopes)

    def predict(self, text: str | None) -> tuple[str, float]:
        if not self.languages or not text or not _letter.search(text):
            return UNDETERMINED, 0.0
        margins = counts(text) @ self.weights + self.bias
        sure, family, n = 1.0, self.families[0], 0
        if len(self.families) > 1:
            n = len(self.families)
            order = np.argsort(-margins[:n], kind="stable")
            family = self.families[order[0]]
            sure = _sigmoid(margins[order[0]] - margins[order[1]])
        own = [v for v in self.languages if family_of(v) == family]
        votes = {v: [0, 0.0, 1.0] for v in own}  # votes, margins, least certainty
        for (a, b), m in zip(self.pairs, margins[n:], strict=True):
            if a in votes:
                votes[a if m >= 0 else b][0] += 1
                votes[a][1] += m
                votes[b][1] -= m
                votes[a][2], votes[b][2] = min(votes[a][2], _sigmoid(2 * m)), min(votes[b][2], _sigmoid(-2 * m))
        best = max(own, key=lambda v: (votes[v][0], votes[v][1]))
        return best, float(sure * votes[best][2])


def _sigmoid(m: float) -> float:
    return float(1 / (1 + np.exp(-np.clip(m, -30, 30))))


def is_held_out(id_col: str = "doc_id") -> Column:
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % 3 == 1


def fitted(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", id_col: str = "doc_id", per_language: int = SAMPLE_PER_LANGUAGE, sample: int = SAMPLE) -> Hierarchy:
    """Learns from at most `per_language` whole texts of each language and `sample` in all."""
    ship(docs.sparkSession)
    usable = docs.filter(~is_held_out(id_col)).select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text")).filter("lang IS NOT NULL AND text IS NOT NULL").withColumn("h", F.xxhash64("text"))
    learned = usable.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).orderBy(F.col("n").desc(), "lang").limit(sample)
    languages = [r["lang"] for r in learned.select("lang").collect()]  # `sample` rows at most
    if not languages:
        return Hierarchy()
    own = usable if len(languages) < sample else usable.join(F.broadcast(learned.select("lang")), "lang")
    chosen = smallest(own.select("lang", "h").distinct(), "lang", "h", max(1, min(per_language, sample // len(languages))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(batch.column(0)[i].as_py(), counts(t)) for i in range(batch.num_rows) if _letter.search(t := batch.column(1)[i].as_py())]
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.string()), pa.array([r[1].astype(np.float16).tobytes() for r in rows], pa.binary())], names=["lang", "x"])

    # `chosen` has at most `sample` rows, which bounds the broadcast; of texts with the same hash one teaches
    texts = own.join(F.broadcast(chosen), ["lang", "h"]).groupBy("lang", "h").agg(F.min("text").alias("text"))
    scaled = texts.select("lang", "text").mapInArrow(run, "lang string, x binary").collect()
    scaled.sort(key=lambda r: (r[0], bytes(r[1])))
    if not scaled:
        return Hierarchy()
    return Hierarchy.fit(np.array([np.frombuffer(r[1], dtype=np.float16) for r in scaled]).astype(np.float32), [r[0] for r in scaled])


def identified(docs: DataFrame, model: Hierarchy, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """doc_id, held_out, lang_pred, score for each row."""
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [model.predict(batch.column(2)[i].as_py()) for i in range(batch.num_rows)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())], names=["doc_id", "held_out", "lang_pred", "score"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), is_held_out(id_col).alias("held_out"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, held_out boolean, lang_pred string, score double")


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return identified(docs, fitted(docs))
