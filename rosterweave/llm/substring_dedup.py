"""Substring dedup by sliding spans of sentences.

A text is cut into sentences (up to a run of full stops, exclamation marks, question marks, their like in other scripts, or line ends), each
with the white space after it, so that joining them gives the text again. A word is what stands between white space; in scripts that set
none between words each letter (with its marks) is one: of Han, Hiragana, Katakana, Bopomofo and Yi as much as a word, of Thai, Lao, Khmer and
Myanmar, which spell words with several, a quarter of one. So a passage of 50 Han letters, or of 200 Thai ones, is caught as one of 50 words is. A sentence of over LONG words is cut further, after the word with the least hash
in each window of LONG of its words: cuts do not depend on where the sentence began, and no piece has over LONG words. From every
sentence a span runs over SENTENCES sentences or more, until it has MIN_WORDS words. So two texts that share a passage of
2 LONG + MIN_WORDS + 6 = 50 words share a span, wherever the passage stands in them. Spans are compared everywhere by 96 bits of a hash
over their sentences' words in lower case. Of the spans that are equal, the first (smallest doc_id, then position) stays; every
sentence that any other of them covers is removed.

Two shuffles move spans, so their rows are kept small: a key, a doc_id, two positions. Whether a span repeats one before it in its
own document is settled before the shuffle; so the smallest doc_id of a key, a plain aggregate, decides the rest.

Null and empty texts have no sentences and stay empty; very long texts are cut whole; other columns of the input are ignored. Rows
that repeat both doc_id and text are the same document and get the same result; where rows share a doc_id alone, a hash of the text
ranks them. A null doc_id ranks below all others. An empty table gives an empty result.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rosterweave.llm.common import joined_where_found, possible, salted_join, shared_dir, written
from rosterweave.shipping import ship

SENTENCES, MIN_WORDS, LONG = 3, 20, 12
TEXTS = 1000  # texts whose spans are found at once
_LEAST = -(2**63)
_sentence = regex.compile(r"[^.!?\n]*(?:[.!?\n]+\s*|$)")
_word = regex.compile(r"\s*\S+\s*")
#: Ends of sentences in other scripts (CJK, Arabic, Urdu, Devanagari, Ethiopic, Myanmar, Khmer).
ENDS = "。．｡！？‼⁇⁈⁉؟۔।॥።፧၊။។៕"
#: Letters of scripts that set no space between words; the first count as words, the others as quarters.
WHOLE = "\u3005-\u3007\u3031-\u3035\u303b\u3041-\u3096\u309d-\u309f\u30a1-\u30fa\u30fc-\u30ff\u3105-\u312f\u31a0-\u31bf\u31f0-\u31ff\u3400-\u4dbf\u4e00-\u9fff\ua000-\ua48c\uf900-\ufaff\uff66-\uff9d\U0001b000-\U0001b16f\U00020000-\U0003ffff"
QUARTER = "\u0e01-\u0e3a\u0e40-\u0e4e\u0e80-\u0ece\u0edc-\u0edf\u1000-\u103f\u1050-\u108f\u109a-\u109d\u1780-\u17d3\u17d7\u17dc\ua9e0-\ua9ef\ua9fa-\ua9fe\uaa60-\uaa7f"
_any_sentence = regex.compile(rf"[^.!?\n{ENDS}]*(?:[.!?\n{ENDS}]+\s*|$)")
_unspaced = re.compile(f"[{WHOLE}{QUARTER}]")
_unit = regex.compile(rf"[{WHOLE}{QUARTER}]\p{{M}}*|[^\s{WHOLE}{QUARTER}]+")
_unit_and_space = regex.compile(rf"\s*(?:[{WHOLE}{QUARTER}]\p{{M}}*|[^\s{WHOLE}{QUARTER}]+)\s*")
_quarter = re.compile(f"[{QUARTER}]")


def words_of(part: str) -> list[str]:
    """The words of a text, a letter each in scripts without spaces."""
    return part.split() if part.isascii() or not _unspaced.search(part) else _unit.findall(part)


def _quarters(words: list[str]) -> int:
    """How much words count, in quarters of a word."""
    return 4 * len(words) - 3 * sum(1 for w in words if len(w) <= 4 and not w.isascii() and _quarter.match(w))


def sentences(texts: list[str | None]) -> list[list[str]]:
    """Of each text; joined, they are the text."""
    out, long = [], []
    for text in texts:
        parts: list = []
        text = text or ""
        dense = not text.isascii() and _unspaced.search(text) is not None
        for s in (_sentence if text.isascii() else _any_sentence).findall(text):
            if s:
                if dense and len(s) > LONG:
                    words = _unit_and_space.findall(s)
                else:
                    words = _word.findall(s) if len(s) > 2 * LONG and len(s.split()) > LONG else ()
                if len(words) > LONG:
                    long.append((parts, len(parts), words))
                parts.append(s)
        out.append(parts)
    if long:
        cuts = _cuts([words for _, _, words in long])
        # from the last to the first, so that the places of earlier sentences stay
        for (parts, at, words), ends in zip(reversed(long), reversed(cuts), strict=True):
            parts[at : at + 1] = ["".join(words[a:b]) for a, b in zip([0, *ends], [*ends, len(words)], strict=True)]
    return out


def _cuts(sentences: list[list[str]]) -> list[list[int]]:
    """For each sentence (over LONG words): after the word with the least hash, the first of equals, in each window of LONG words; not after the last word."""
    sizes = [len(words) for words in sentences]
    hashes = np.fromiter((zlib.crc32(w.strip().lower().encode("utf-8", "surrogatepass")) for words in sentences for w in words), dtype=np.int64, count=sum(sizes))
    of, ends, n = np.repeat(np.arange(len(sizes)), sizes), np.cumsum(sizes), len(hashes)
    # hash and place in one number; windows of LONG = 8 + 4 words from those of 1, 2, 4 and 8
    least = (hashes << 31) | np.arange(n)
    two = np.minimum(least[:-1], least[1:])
    four = np.minimum(two[:-2], two[2:])
    eight = np.minimum(four[:-4], four[4:])
    all_of = np.minimum(eight[: n - LONG + 1], four[8:])[of[: n - LONG + 1] == of[LONG - 1 :]]
    at = np.unique(all_of & (2**31 - 1)) + 1
    at = at[~np.isin(at, ends)]
    starts = ends - sizes
    return [(own - start).tolist() for own, start in zip(np.split(at, np.searchsorted(at, ends[:-1])), starts, strict=True)]


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n + 1, base, dtype=np.uint64)
    out[0] = 1
    return np.cumprod(out)  # modulo 2 ** 64


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return x ^ (x >> np.uint64(29))


#: Odd multipliers, and their inverses modulo 2 ** 64.
_BASES = (0xD6E8FEB86659FD93, 0xA0761D6478BD642F)
_INVERSES = tuple(pow(b, -1, 2**64) for b in _BASES)


def spans(texts: list[list[str]]) -> dict[str, np.ndarray]:
    """For texts as lists of sentences: text (its number), first and last sentence, key (64 bits), more (32 bits), again (its text had the span before) of the span from each sentence that has one. Sentences without words are passed over.

    A sentence is hashed once; a span's hash is a polynomial in the hashes of its sentences, which sums over prefixes give for all spans at once."""
    of, at, sizes, hashes = [], [], [], []
    for number, parts in enumerate(texts):
        for i, part in enumerate(parts):
            if words := words_of(part.lower()):
                of.append(number)
                at.append(i)
                sizes.append(4 * len(words) if part.isascii() else _quarters(words))
                hashes.append(xxhash.xxh3_64_intdigest(" ".join(words).encode("utf-8", "surrogatepass")))
    of, at, h = np.array(of, dtype=np.int64), np.array(at, dtype=np.int32), np.array(hashes, dtype=np.uint64)
    n = len(of)
    words = np.concatenate([[0], np.cumsum(np.array(sizes, dtype=np.int64))]).astype(np.int64)
    start = np.arange(n)
    end = np.maximum(start + SENTENCES, np.searchsorted(words, words[:-1] + 4 * MIN_WORDS))
    fits = end <= np.searchsorted(of, of, side="right")
    s, e = start[fits], end[fits]
    found = []
    for base, inverse, x in zip(_BASES, _INVERSES, (h, _mixed(h)), strict=True):
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(x * _powers(base, n)[:n])])
        found.append(_mixed((sums[e] - sums[s]) * _powers(inverse, n)[s]))
    text, key, more = of[s], found[0].view(np.int64), (found[1] >> np.uint64(32)).astype(np.uint32).view(np.int32)
    order = np.lexsort((s, more, key, text))
    same = np.zeros(len(s), dtype=bool)
    same[1:] = (np.diff(text[order]) == 0) & (np.diff(key[order]) == 0) & (np.diff(more[order]) == 0)
    again = np.zeros(len(s), dtype=bool)
    again[order] = same
    return {"text": text, "first": at[s], "last": at[e - 1], "key": key, "more": more, "again": again}


def span_table(docs: DataFrame, folder: str, text_col: str = "text", id_col: str = "doc_id") -> tuple[DataFrame, bool]:
    """doc_id, text_hash, first, last, key, more, again of every span of every document; whether doc_ids are unique (text_hash is 0 then, which costs the shuffles nothing)."""
    ship(docs.sparkSession)
    names = ["first", "last", "key", "more", "again"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, TEXTS):
                part = batch.slice(start, TEXTS)
                found = spans(sentences(part.column(2).to_pylist()))
                of = pa.array(found["text"])
                yield pa.RecordBatch.from_arrays([part.column(0).take(of), part.column(1).take(of), *(pa.array(found[c]) for c in names)], names=["doc_id", "text_hash", *names])

    unique = docs.groupBy(id_col).count().filter("count > 1").limit(1).count() == 0
    rows = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(_LEAST)).alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    rows = rows.select("doc_id", (F.lit(0).cast("long") if unique else F.xxhash64("text")).alias("text_hash"), "text")
    return written(rows.mapInArrow(run, "doc_id long, text_hash long, first int, last int, key long, more int, again boolean"), folder, "spans"), unique


def repeated_spans(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id") -> tuple[DataFrame, bool]:
    """doc_id, text_hash, firsts, lasts: for each document with spans that are not the first of their kind, where these begin and end; whether doc_ids are unique."""
    folder = shared_dir(docs.sparkSession)
    table, unique = span_table(docs, folder, text_col, id_col)
    rank = F.col("doc_id") if unique else F.struct("doc_id", "text_hash")
    first = table.groupBy("key", "more").agg(F.min(rank).alias("first_doc"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    first = written(first, folder, "repeated")
    # most spans occur once; a bitmap of bounded size keeps them out of the shuffle
    likely = possible(table, first.select("key"), "key", first.count())
    found = salted_join(likely, first, ["key", "more"], "n", table.count(), F.xxhash64("doc_id", "first"), how="inner")
    gone = found.filter((F.col("first_doc") != rank) | F.col("again"))
    return gone.groupBy("doc_id", "text_hash").agg(F.sort_array(F.collect_set(F.struct("first", "last"))).alias("spans")).select("doc_id", "text_hash", F.col("spans.first").alias("firsts"), F.col("spans.last").alias("lasts")), unique


def without_repeated_spans(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """doc_id, n_removed, n_words_removed, kept_text for each row."""
    gone, unique = repeated_spans(docs, text_col, id_col)
    gone = written(gone.withColumnsRenamed({"doc_id": "_id", "text_hash": "_hash"}), shared_dir(docs.sparkSession), "gone")
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    rows = rows.withColumns({"_id": F.coalesce("doc_id", F.lit(_LEAST)), "_hash": F.lit(0).cast("long") if unique else F.xxhash64("text")})
    found = joined_where_found(rows, gone, ["_id", "_hash"]).select("doc_id", "text", "firsts", "lasts")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (whole.slice(start, TEXTS) for whole in batches for start in range(0, whole.num_rows, TEXTS)):
            out = [[], [], []]
            texts, some = batch.column(1).to_pylist(), [i for i, firsts in enumerate(batch.column(2)) if firsts.is_valid]
            cut = dict(zip(some, sentences([texts[i] for i in some]), strict=True))
            for i, text in enumerate(texts):
                lost: list[str] = []
                if (parts := cut.get(i)) is not None:
                    edge = np.zeros(len(parts) + 1, dtype=np.int64)
                    np.add.at(edge, batch.column(2)[i].as_py(), 1)
                    np.add.at(edge, np.array(batch.column(3)[i].as_py()) + 1, -1)
                    covered = (np.cumsum(edge)[:-1] > 0).tolist()
                    lost = [p for p, c in zip(parts, covered, strict=True) if c]
                    text = "".join(p for p, c in zip(parts, covered, strict=True) if not c)
                for column, value in zip(out, (len(lost), sum(len(words_of(p)) for p in lost), text), strict=True):
                    column.append(value)
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, t) for c, t in zip(out, (pa.int64(), pa.int64(), pa.string()), strict=True))], names=["doc_id", "n_removed", "n_words_removed", "kept_text"])

    return found.mapInArrow(run, "doc_id long, n_removed long, n_words_removed long, kept_text string")


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = without_repeated_spans(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return found.select("doc_id", "n_removed", "n_words_removed", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))
