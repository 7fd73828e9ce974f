"""Quality rules with a bitmask ledger.

Every rule is evaluated once over a whole text; the ledger holds the measurements and one bit for each rule that fails. Policies are
versioned sets of bits: applying one, or finding what each rule alone decides (ablation), reads the ledger and never a text.

Words stand between the six white-space characters of ASCII; others, such as no-break spaces, are part of a word. A letter is \\p{L},
a capital \\p{Lu}. A word is alphabetic when it is letters alone, punctuation at its ends aside.

A null or empty text has no words and fails `few_words`. A very long text is measured whole and fails `many_words`. Repeated rows are
measured each time; a null doc_id passes through; other columns of the input are ignored. An empty table gives an empty ledger. Ratios
are compared as products of integers, so a tie at a limit is not a failure.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rosterweave.shipping import ship

SYMBOLS = "#*$%&|<>"
SPACES = " \t\n\x0b\x0c\r"
WINDOW = 5
_letters, _capital = regex.compile(r"\p{L}+"), regex.compile(r"\p{Lu}")

MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_letters", "n_alpha_words")


def _windows_repeated(words: list[bytes], size: int = WINDOW) -> int:
    """Words inside windows of `size` words that occur twice or more. Windows get numbers by pairs of numbers, so equal means equal."""
    n = len(words) - size + 1
    if n < 2:
        return 0
    number: dict[bytes, int] = {}
    one = np.fromiter((number.setdefault(w, len(number)) for w in words), dtype=np.int64, count=len(words))
    if len(number) > len(words) - size:  # too few repeated words for a repeated window
        return 0
    pair = lambda a, b: np.unique(a * (int(b.max()) + 1) + b, return_inverse=True)[1]
    two = pair(one[:-1], one[1:])
    four = pair(two[:-2], two[2:])
    five = four[:n] * (int(one.max()) + 1) + one[size - 1 :]
    _, inverse, times = np.unique(five, return_inverse=True, return_counts=True)
    again = times[inverse] > 1
    if not again.any():
        return 0
    edge = np.zeros(len(words) + 1, dtype=np.int64)
    np.add.at(edge, np.flatnonzero(again), 1)
    np.add.at(edge, np.flatnonzero(again) + size, -1)
    return int((np.cumsum(edge)[:-1] > 0).sum())


def measured(text: str | None) -> tuple[int, ...]:
    """The values of MEASURES."""
    text = text or ""
    words = text.encode("utf-8", "surrogatepass").split()
    lines = [line for line in text.split("\n") if line.strip(SPACES)]
    alphabetic = sum(n for w, n in Counter(words).items() if _letters.fullmatch(w.decode("utf-8", "surrogatepass").strip(".,;:!?\"'()")))
    return (
        len(words), len(text) - sum(map(text.count, SPACES)), sum(map(text.count, SYMBOLS)), len(lines) - len(set(lines)), _windows_repeated(words),
        text.count("\n") + 1, len(_capital.findall(text)), sum(map(str.isalpha, text)), alphabetic,
    )


@dataclass(frozen=True)
class Rule:
    bit: int
    name: str
    fails: Column


def rules() -> list[Rule]:
    """Bits never change their meaning; a new rule takes the next bit."""
    c = F.col
    return [
        Rule(0, "few_words", c("n_words") < 10),
        Rule(1, "repeated_words", 100 * c("n_repeat_words") > 20 * c("n_words")),
        Rule(2, "word_length", (c("word_chars") < 2 * c("n_words")) | (c("word_chars") > 15 * c("n_words"))),
        Rule(3, "symbols", 10 * c("n_symbols") > c("n_words")),
        Rule(4, "repeated_lines", 10 * c("n_dup_lines") > 3 * c("n_lines")),
        Rule(5, "shouting", 2 * c("n_upper") > c("n_letters")),
        Rule(6, "few_alphabetic_words", 2 * c("n_alpha_words") < c("n_words")),
        Rule(7, "many_words", c("n_words") > 100_000),
    ]


def mask(names: list[str]) -> int:
    bits = {r.name: r.bit for r in rules()}
    return sum(1 << bits[n] for n in names)


BASE = ("few_words", "repeated_words")
#: Versioned policies: a document is kept when none of these rules failed. A version is never edited, a change is a new one.
POLICIES = {
    "base-1": BASE,
    "web-1": (*BASE, "word_length", "symbols", "repeated_lines", "shouting", "few_alphabetic_words"),
}
CURRENT = "web-1"


def ledger(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """doc_id, the measurements, and `failed`: a bit for each rule that failed."""
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([measured(batch.column(1)[i].as_py()) for i in range(batch.num_rows)], dtype=np.int64).reshape(-1, len(MEASURES))
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(found[:, k]) for k in range(len(MEASURES)))], names=["doc_id", *MEASURES])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    found = rows.mapInArrow(run, "doc_id long, " + ", ".join(f"{m} long" for m in MEASURES))
    failed = F.lit(0).cast("long")
    for r in rules():
        failed = failed.bitwiseOR(F.when(r.fails, F.lit(1 << r.bit)).otherwise(F.lit(0)).cast("long"))
    return found.withColumn("failed", failed)


def apply_policy(book: DataFrame, version: str = CURRENT) -> DataFrame:
    """The ledger with base_failed and kept."""
    hit = lambda names: F.col("failed").bitwiseAND(F.lit(mask(list(names))).cast("long")) != 0
    return book.withColumns({"base_failed": hit(BASE), "kept": ~hit(POLICIES[version])})


def ablations(book: DataFrame, version: str = CURRENT) -> DataFrame:
    """For each rule of a policy: documents it fails, and documents that it alone keeps out (kept if the rule went)."""
    names = POLICIES[version]
    whole = mask(list(names))
    held = F.col("failed").bitwiseAND(F.lit(whole).cast("long"))
    # one row for each combination of failed bits, at most 2 ** rules of them
    combos = book.groupBy(held.alias("held")).agg(F.count(F.lit(1)).alias("n"))
    each = combos.select("held", "n", F.explode(F.array(*[F.struct(F.lit(n).alias("rule"), F.lit(mask([n])).cast("long").alias("bit")) for n in names])).alias("r")).select("held", "n", "r.rule", "r.bit")
    failing, alone = F.col("held").bitwiseAND(F.col("bit")) != 0, F.col("held") == F.col("bit")
    return each.groupBy("rule").agg(F.sum(F.when(failing, F.col("n")).otherwise(0)).alias("failed_docs"), F.sum(F.when(alone, F.col("n")).otherwise(0)).alias("decided_docs"))


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    book = ledger(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return apply_policy(book).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "failed")


_W = "[^\\x20\\x09-\\x0D]"
ORACLE = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '{_W}+') AS w FROM documents),
win AS (SELECT doc_id, i, w[i:i + 4] AS win FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS i FROM d)),
rep AS (SELECT doc_id, i FROM win QUALIFY count(*) OVER (PARTITION BY doc_id, win) > 1),
cov AS (SELECT doc_id, count(DISTINCT i + j) AS n FROM rep, (SELECT unnest(range(5)) AS j) GROUP BY doc_id),
l AS (SELECT doc_id, len(list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '{_W}'))) - len(list_distinct(list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '{_W}')))) AS dup,
  len(string_split(t, chr(10))) AS lines FROM d),
m AS (
  SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::BIGINT AS word_chars, len(regexp_extract_all(t, '[#*$%&|<>]'))::BIGINT AS n_symbols,
    l.dup::BIGINT AS n_dup_lines, coalesce(cov.n, 0)::BIGINT AS n_repeat_words, l.lines AS n_lines, len(regexp_extract_all(t, '\\p{{Lu}}')) AS n_upper, len(regexp_extract_all(t, '\\p{{L}}')) AS n_letters,
    len(list_filter(w, lambda x: regexp_matches(trim(x, '.,;:!?"''()'), '^\\p{{L}}+$'))) AS n_alpha_words
  FROM d JOIN l USING (doc_id) LEFT JOIN cov USING (doc_id)
),
f AS (
  SELECT *, ((n_words < 10)::BIGINT + 2 * (100 * n_repeat_words > 20 * n_words)::BIGINT + 4 * (word_chars < 2 * n_words OR word_chars > 15 * n_words)::BIGINT + 8 * (10 * n_symbols > n_words)::BIGINT
    + 16 * (10 * n_dup_lines > 3 * n_lines)::BIGINT + 32 * (2 * n_upper > n_letters)::BIGINT + 64 * (2 * n_alpha_words < n_words)::BIGINT + 128 * (n_words > 100000)::BIGINT) AS failed FROM m
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, failed & 3 <> 0 AS base_failed, failed & 127 = 0 AS kept, failed FROM f
"""
