"""Quality classifier: ordinal regression with cumulative links on graded ratings.

The rating of a labelled document is 0 (poor), 1 (fair writing, but toxic) or 2 (good). One set of weights over hashed text features
serves all grades, and ordered thresholds t0 < t1 cut the line: P(grade > k) = sigmoid(weights * features - tk). The expected grade
is the sum of these tails; a document is kept when P(grade = 2), the last tail, reaches `least`.

Features are present or absent: each distinct word in lower case, its first four and five letters, and for each kind of word (letters
to a or A, digits to 0, other characters as they are; a word that repeats the one before it is a kind too, ordinary words are none)
whether its share of the words reaches 1/64, 1/32, ... 1. Weights may speak for a text or against it. They are fitted on the driver, on a
bounded sample of labelled documents.

The sample has SAMPLE_PER_GRADE labels of a grade at most, chosen by a hash of doc_id. A document that has the same grade twice
teaches once, one with several grades once for each; of documents that share a doc_id, the one whose text has the least hash teaches.
A row of the sample is sent to the driver as the numbers of its features, or as 2 ** BITS bits where that is shorter (32 kB).

A null or empty text has no features, and its grade follows from the thresholds alone. A very long text is read whole. Labels with a
null quality, or without a document, are ignored; a null toxic counts as 0. A tail probability equal to `least` keeps a document.
Without labels every document is kept, with the top grade. Repeated rows are scored each time; other columns of the input are ignored,
or passed on by `selected`; an empty table gives an empty result.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, StructField, StructType

from rosterweave.llm.common import packed, smallest
from rosterweave.shipping import ship

#: Labels of each grade that the model is fitted on, by hash of doc_id; the bound of the sample.
SAMPLE_PER_GRADE = 3000
GRADES, BITS, LEAST = 3, 18, 0.5
_CACHE, _ROWS = 100_000, 512
_AGAIN = "=="  # the kind of a word that repeats the one before it
_lower, _upper, _digit = regex.compile(r"[\p{Ll}\p{Lo}\p{M}]+"), regex.compile(r"[\p{Lu}\p{Lt}]+"), regex.compile(r"\p{N}+")


def _slot(kind: str, what: str) -> int:
    return zlib.crc32(f"{kind}{what}".encode("utf-8", "surrogatepass")) & ((1 << BITS) - 1)


class Features:
    """Slots of a text's features; what a word gives is kept while the cache is small."""

    def __init__(self) -> None:
        self.words: dict[str, tuple[tuple[int, ...], str]] = {}
        self.shapes: dict[str, list[int]] = {}

    def _word(self, word: str) -> tuple[tuple[int, ...], str]:
        if (known := self.words.get(word)) is None:
            low = word.lower()
            bare = low.strip(".,;:!?\"'()[]|#*$%&<>-_")
            slots = (_slot("w", bare), _slot("4", bare[:4]), _slot("5", bare[:5])) if bare else ()
            plain = low.rstrip(".,;:!?").isalpha() and len(low) - len(bare) < 2 and (word == low or word[1:] == low[1:])
            known = self.words[word] = (slots, "" if plain else _digit.sub("0", _upper.sub("A", _lower.sub("a", word)))[:12])
        return known

    def _shares(self, shape: str) -> list[int]:
        """The slots for a share of at least nothing, 1/64, 1/32, ... 1."""
        if (known := self.shapes.get(shape)) is None:
            known = self.shapes[shape] = [_slot("s", f"{shape}@{k}") for k in range(8)]
        return known

    def slots(self, text: str | None) -> np.ndarray:
        if len(self.words) > _CACHE:
            self.words.clear()
            self.shapes.clear()
        words = (text or "").split()
        times = Counter(words)
        out: set[int] = set()
        shapes: Counter[str] = Counter()
        for word, n in times.items():
            slots, shape = self._word(word)
            out.update(slots)
            if shape:
                shapes[shape] += n
        shapes[_AGAIN] = sum(map(eq, words, words[1:]))
        total = max(1, len(words))
        for shape, n in shapes.items():
            if n:
                out.update(self._shares(shape)[: (64 * n // total).bit_length() + 1])
        return np.fromiter(sorted(out), dtype=np.int32, count=len(out))


@dataclass
class Ordinal:
    weights: np.ndarray
    thresholds: np.ndarray

    def tails(self, slots: np.ndarray) -> np.ndarray:
        """P(grade > k) for each k."""
        return _sigmoid(float(self.weights[slots].sum()) - self.thresholds)

    @classmethod
    def fit(cls, rows: list[np.ndarray], grades: np.ndarray, steps: int = 150, refit_steps: int = 400) -> Ordinal:
        """Maximum likelihood with grades weighing alike: a first fit with an L1 penalty picks features, a second with little of it fits them."""
        rare = max(4, len(rows) // 500)
        df = np.bincount(np.concatenate(rows) if rows else np.empty(0, np.int64), minlength=1 << BITS)
        usable = df >= rare
        weights, _ = _descend(rows, grades, usable, df, penalty=0.4 / np.sqrt(len(rows)), steps=steps)
        weights, cuts = _descend(rows, grades, weights != 0, df, penalty=0.02 / np.sqrt(len(rows)), steps=refit_steps)
        return cls(weights.astype(np.float32), cuts)


def _descend(rows: list[np.ndarray], grades: np.ndarray, usable: np.ndarray, df: np.ndarray, penalty: float, steps: int) -> tuple[np.ndarray, np.ndarray]:
    """Accelerated proximal gradient steps over the usable slots."""
    n = len(rows)
    flat, of = np.concatenate(rows), np.repeat(np.arange(n, dtype=np.int32), [len(r) for r in rows])
    use = usable[flat]
    slots = np.flatnonzero(usable & (df > 0))
    place = np.zeros(1 << BITS, dtype=np.int32)
    place[slots] = np.arange(len(slots))
    flat, of, m = place[flat[use]], of[use], len(slots)
    share = df[slots] / n
    scale = 1 / np.sqrt(share * (1 - share) + 0.02)  # common and rare features move alike
    mean = share * scale
    part = np.bincount(grades, minlength=GRADES) / n
    weigh = np.where(part > 0, 1 / np.maximum(np.count_nonzero(part) * part, 1e-9), 0.0)[grades] / n
    top, low = grades < GRADES - 1, grades > 0
    above, below = np.minimum(grades, GRADES - 2), np.maximum(grades - 1, 0)

    # by blocks of rows, so that what a step needs beside the features stays small
    blocks, lo = [], 0
    for first in range(0, n, _ROWS):
        last = min(n, first + _ROWS)
        hi = int(np.searchsorted(of, last))
        blocks.append((first, last, lo, hi))
        lo = hi

    def score(w: np.ndarray) -> np.ndarray:
        scaled, out = w * scale, np.empty(n)
        for first, last, lo, hi in blocks:
            out[first:last] = np.bincount(of[lo:hi] - first, weights=scaled[flat[lo:hi]], minlength=last - first)
        return out - w @ mean

    def back(g: np.ndarray) -> np.ndarray:
        out = np.zeros(m)
        for _, _, lo, hi in blocks:
            out += np.bincount(flat[lo:hi], weights=g[of[lo:hi]], minlength=m)
        return out * scale - g.sum() * mean

    v = np.random.default_rng(0).normal(size=m)
    bend = 1.0
    for _ in range(15):  # the largest curvature, by power iteration
        v = back(weigh * score(v / (np.linalg.norm(v) + 1e-30)))
        bend = np.linalg.norm(v) + 1e-9
    step = 1 / (0.3 * bend)
    w, cuts = np.zeros(m), np.array([-1.0, 1.0])
    z, at, pace = w, cuts, 1.0
    for _ in range(steps):
        s = score(z)
        # P(grade) is what the line has between two cuts
        upper = np.where(top, _sigmoid(at[above] - s), 1.0)
        lower = np.where(low, _sigmoid(at[below] - s), 0.0)
        p = np.maximum(upper - lower, 1e-12)
        up, down = weigh * upper * (1 - upper) / p, weigh * lower * (1 - lower) / p
        new = z - step * back(up - down)
        new = np.minimum(new + step * penalty, 0.0) + np.maximum(new - step * penalty, 0.0)
        slope = np.array([down[grades == k + 1].sum() - up[grades == k].sum() for k in range(GRADES - 1)])
        moved = at - min(step, 2.0) * slope
        moved[1] = max(moved[1], moved[0] + 1e-3)
        if (z - new) @ (new - w) > 0:
            pace = 1.0
        faster = (1 + np.sqrt(1 + 4 * pace * pace)) / 2
        z, at = new + (pace - 1) / faster * (new - w), moved + (pace - 1) / faster * (moved - cuts)
        w, cuts, pace = new, moved, faster
    weights = np.zeros(1 << BITS)
    weights[slots] = w * scale
    return weights, np.array([cuts[0], max(cuts[1], cuts[0])]) + w @ mean


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def fitted(docs: DataFrame, labels: DataFrame, text_col: str = "text", id_col: str = "doc_id", per_grade: int = SAMPLE_PER_GRADE) -> Ordinal:
    """labels: doc_id, quality, toxic. Learns from at most `per_grade` labels of each grade, whole texts."""
    ship(docs.sparkSession)
    graded = labels.filter(F.col("quality").isNotNull() & F.col("doc_id").isNotNull())
    graded = graded.select(F.col("doc_id").cast("long").alias("_id"), F.when(F.col("quality") == 0, 0).when(F.coalesce("toxic", F.lit(0)) != 0, 1).otherwise(2).alias("grade"))
    # GRADES * per_grade rows at most, which bounds the broadcasts
    chosen = smallest(graded.distinct().withColumn("_h", F.xxhash64("_id")), "grade", "_h", per_grade).drop("_h")
    rows = docs.select(F.col(id_col).cast("long").alias("_id"), F.col(text_col).cast("string").alias("text")).withColumn("_text", F.xxhash64("text"))
    first = rows.join(F.broadcast(chosen), "_id").groupBy("_id", "grade").agg(F.min("_text").alias("_text"))
    sample = rows.join(F.broadcast(first), ["_id", "_text"]).select("_id", "grade", "text").dropDuplicates(["_id", "grade"]).select("grade", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features = Features()
        for batch in batches:
            found = [_packed(features.slots(batch.column(1)[i].as_py())) for i in range(batch.num_rows)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.binary())], names=["grade", "slots"])

    got = sorted(((r[0], bytes(r[1])) for r in sample.mapInArrow(run, "grade int, slots binary").collect()))
    if not got:
        return Ordinal(np.zeros(1 << BITS, dtype=np.float32), np.full(GRADES - 1, -30.0))
    grades, rows = np.array([g for g, _ in got]), [_unpacked(s) for _, s in got]
    del got
    return Ordinal.fit(rows, grades)


def _packed(slots: np.ndarray) -> bytes:
    if 4 * len(slots) < (1 << BITS) // 8:
        return slots.tobytes()
    bits = np.zeros(1 << BITS, dtype=np.uint8)
    bits[slots] = 1
    return np.packbits(bits).tobytes()


def _unpacked(packed: bytes) -> np.ndarray:
    if len(packed) < (1 << BITS) // 8:
        return np.frombuffer(packed, dtype=np.int32)
    return np.flatnonzero(np.unpackbits(np.frombuffer(packed, dtype=np.uint8))).astype(np.int32)


def _scored(rows: DataFrame, model: Ordinal, least: float) -> DataFrame:
    """rows: any columns, then the text. The text gives way to expected_grade, tail_prob, kept."""
    ship(rows.sparkSession)
    # The model's size is fixed by BITS.
    shipped, at = rows.sparkSession.sparkContext.broadcast(model), len(rows.columns) - 1
    names = [*rows.columns[:at], "expected_grade", "tail_prob", "kept"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features, model = Features(), shipped.value
        for batch in batches:
            tails = np.array([model.tails(features.slots(batch.column(at)[i].as_py())) for i in range(batch.num_rows)]).reshape(-1, GRADES - 1)
            made = [pa.array(tails.sum(axis=1)), pa.array(tails[:, -1]), pa.array(tails[:, -1] >= least)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:at], *made], names=names)

    schema = StructType([*rows.schema.fields[:at], StructField("expected_grade", DoubleType()), StructField("tail_prob", DoubleType()), StructField("kept", BooleanType())])
    return rows.mapInArrow(run, schema)


def scored(docs: DataFrame, model: Ordinal, text_col: str = "text", id_col: str = "doc_id", least: float = LEAST) -> DataFrame:
    """doc_id, expected_grade, tail_prob, kept for each row."""
    return _scored(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")), model, least)


def selected(docs: DataFrame, labels: DataFrame, text_col: str = "text", id_col: str = "doc_id", least: float = LEAST) -> DataFrame:
    """The rows of docs that the model keeps, with their columns. The model learns from the labels of these rows."""
    model = fitted(docs, labels, text_col, id_col)
    return _scored(packed(docs, text=docs[text_col].cast("string")), model, least).filter("kept").select("_row.*")


def op9_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return scored(docs, fitted(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))
