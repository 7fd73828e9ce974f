"""LM scoring by masked pseudo-likelihood.

A small window network predicts every word of a document from the two before and the two after it: each neighbour adds a row of its
place's table to a hidden layer, which gives first the log-probability of a group of words and then that of the word in its group.
A document's score is the sum of the log-probabilities of its own words, each hidden in turn.

The network's tokens are fixed in number (LEAVES): the WORDS most frequent words of the whole corpus, and CLASSES of rarer words by a
hash of their last two letters. A rarer word adds log P(word | class), from the counts of all words of the corpus, which stay in a
table: of n occurrences of a class and t distinct words, a word seen c times has c / (n + t + 1), and the rest is for unseen words,
shared out by spelling (each byte, and the end, 1 in 257). So a position gets log P(word), and the probabilities of all words add up to
1 at most. The HELD most frequent of the rarer words go to the tasks; where there are more, the rest are joined. Untrained, the network
gives the shares of the words in the corpus.

Word counts cover every document. For training, documents are dealt by a hash of doc_id and text to parts of a fixed size (so their
number grows with the corpus, and does not depend on the table's partitions) and to ROUNDS rounds. In each round every part of that
round starts from the current weights and trains on each of its positions; the weights are then averaged by the number of positions.
Every position of the corpus is trained on once. The driver holds one set of weights.

Words are split at white space, A-Z in lower case, without ASCII punctuation at the ends; punctuation alone is the empty word, one word
like others. Words of equal counts rank by their letters. A null or empty text has no words and score 0. A very long text is one
document, scored in blocks. Repeated rows count and are scored each time; a null doc_id passes through. Other columns of the input are
ignored. An empty corpus gives untrained weights and an empty result.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import cache
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rosterweave.llm.common import shared_dir, written
from rosterweave.shipping import ship

GROUPS = MEMBERS = 64
LEAVES, CLASSES = GROUPS * MEMBERS, 32
WORDS = LEAVES - CLASSES  # tokens 1 to WORDS are words, then come the classes; 0 stands beyond the ends of a document
NEAR_WORDS = 2048  # words that have a row of their own as neighbours; others share their class's
NEAR = 1 + NEAR_WORDS + CLASSES
REACH, HIDDEN = 2, 16
_OFFSETS = (-2, -1, 1, 2)
ROUNDS, PART, BATCH, RATE = 4, 2_000_000, 8192, 0.2
HELD = 200_000  # words whose counts every task holds; the counts of all others are joined
_PUNCTUATION = b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
_BLOCK, _CACHE, _CHUNK, _SLICE = 16_384, 300_000, 4096, 8_000_000


def raw_words(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


def bare_word(raw: bytes) -> bytes:
    return raw.strip(_PUNCTUATION)


def class_of(bare: bytes) -> int:
    return zlib.crc32(bare[-2:]) % CLASSES


@cache
def _class_tables() -> tuple[int, np.ndarray, np.ndarray]:
    """class_of the empty word, of each byte, and of each two bytes."""
    one = [bytes([a]) for a in range(256)]
    return class_of(b""), np.array([*map(class_of, one)]), np.array([class_of(a + b) for a in one for b in one])


def classes_of(bare: pa.Array) -> np.ndarray:
    """class_of each word of an array of strings."""
    none, one, two = _class_tables()
    ends, letters = _offsets(bare), np.frombuffer(bare.buffers()[2] or b"", np.uint8)
    size, last = np.diff(ends), ends[1:] - 1
    found = np.full(len(bare), none)
    found[size == 1] = one[letters[last[size == 1]]]
    more = last[size > 1]
    found[size > 1] = two[letters[more - 1].astype(np.int64) * 256 + letters[more]]
    return found


def _offsets(texts: pa.Array) -> np.ndarray:
    """Of strings: where each begins in the buffer, and the end."""
    return np.frombuffer(texts.buffers()[1], np.int32, len(texts) + 1, 4 * texts.offset) if len(texts) else np.zeros(1, np.int32)


def slices(batches: Iterator[pa.RecordBatch], text: int) -> Iterator[pa.RecordBatch]:
    """Rows whose texts have about _SLICE bytes together, so that memory does not depend on the size of batches. A longer text is alone."""
    for batch in batches:
        ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy().astype(np.int64))
        start = 0
        while start < len(ends):
            end = max(start + 1, int(np.searchsorted(ends, (ends[start - 1] if start else 0) + _SLICE, side="right")))
            yield batch.slice(start, end - start)
            start = end


def split(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """What raw_words and bare_word give for each text: how many words it has; all words in order, by number; and what the numbers stand for, each word once."""
    texts = pc.ascii_trim_whitespace(pc.ascii_lower(texts.cast(pa.string())))
    lists = pc.ascii_split_whitespace(pc.if_else(pc.equal(texts, ""), pa.scalar(None, pa.string()), texts))
    raw = lists.flatten().dictionary_encode()
    bare = pc.ascii_trim(raw.dictionary, characters=_PUNCTUATION.decode()).dictionary_encode()
    n = pc.fill_null(pc.list_value_length(lists), 0).to_numpy()
    return n, bare.indices.to_numpy().take(raw.indices.to_numpy()), bare.dictionary


@dataclass
class Vocabulary:
    words: list[bytes]
    counts: list[int]  # of the words
    held: dict[bytes, int] = field(default_factory=dict)  # counts of the most frequent rarer words
    totals: np.ndarray = field(default_factory=lambda: np.ones(CLASSES))  # a class's occurrences + distinct words + 1
    distinct: np.ndarray = field(default_factory=lambda: np.zeros(CLASSES))
    whole: bool = True  # held has all of them

    def __post_init__(self) -> None:
        self.known = {w: i + 1 for i, w in enumerate(self.words)}

    def size(self) -> int:
        return int(sum(self.counts) + (self.totals - self.distinct - 1).sum())

    def seen(self, n: int, word: bytes) -> float:
        return math.log(n / self.totals[class_of(word)])

    def unseen(self, word: bytes) -> float:
        c = class_of(word)
        return math.log((self.distinct[c] + 1) / self.totals[c]) - (len(word) + 1) * math.log(257)


class Lookup:
    """What a vocabulary knows of words."""

    def __init__(self, vocab: Vocabulary):
        self.vocab = vocab
        self.words = pa.array([*vocab.words, *vocab.held], pa.binary()).cast(pa.string())
        self.seen = np.array([*vocab.counts, *vocab.held.values()], dtype=np.float64)

    def of(self, bare: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Tokens, and log P(word | class): 0 for a token of its own, NaN where the table has to say."""
        v, at, n_own = self.vocab, pc.fill_null(pc.index_in(bare, self.words), -1).to_numpy(), len(self.vocab.words)
        own, held, c = (at >= 0) & (at < n_own), at >= n_own, classes_of(bare)
        within = np.full(len(bare), np.nan)
        if v.whole:
            within = np.log((v.distinct[c] + 1) / v.totals[c]) - (np.diff(_offsets(bare)) + 1) * math.log(257)
        within[own] = 0.0
        within[held] = np.log(self.seen[at[held]] / v.totals[c[held]])
        return np.where(own, at + 1, 1 + WORDS + c).astype(np.uint16), within

    def tokens(self, texts: list[str | None]) -> list[np.ndarray]:
        n, number, bare = split(pa.array(texts, pa.string()))
        return np.split(self.of(bare)[0].take(number), np.cumsum(n)[:-1])


def _counted(parts: list[tuple[pa.Array, np.ndarray]]) -> tuple[pa.Array, np.ndarray]:
    """Words and their numbers, each word once."""
    words = pa.concat_arrays([w for w, _ in parts]).dictionary_encode()
    n = np.bincount(words.indices.to_numpy(), np.concatenate([n for _, n in parts]), len(words.dictionary))  # sums are whole numbers below 2 ** 53
    return words.dictionary, n.astype(np.int64)


def vocabulary(docs: DataFrame, text_col: str = "text") -> tuple[Vocabulary, DataFrame]:
    """The counts of all words of all documents: those that go to the tasks, and the table (word, n) of the others. A task sends a row for each distinct word, again when it has met _CACHE of them."""
    ship(docs.sparkSession)

    def sent(words: pa.Array, n: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([words, pa.array(classes_of(words), pa.int32()), pa.array(n)], names=["word", "class", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: list[tuple[pa.Array, np.ndarray]] = []
        for batch in slices(batches, 0):
            _, number, bare = split(batch.column(0))
            parts.append((bare, np.bincount(number, minlength=len(bare))))
            if sum(len(w) for w, _ in parts) > 2 * _CACHE:
                parts = [_counted(parts)]
                if len(parts[0][0]) > _CACHE:
                    yield sent(*parts.pop())
        if parts:
            yield sent(*_counted(parts))

    counts = docs.select(F.col(text_col).cast("string")).mapInArrow(run, "word string, class int, n long").groupBy("word", "class").agg(F.sum("n").alias("n"))
    counts = written(counts, shared_dir(docs.sparkSession), "words")
    first = counts.orderBy(F.col("n").desc(), "word").limit(HELD + WORDS + 1).toArrow()  # a top-k of fixed size
    first = [(w.encode("utf-8", "surrogatepass"), n) for w, n in zip(first["word"].to_pylist(), first["n"].to_pylist(), strict=True)]
    top, held = first[:WORDS], first[WORDS:]
    totals, distinct = np.ones(CLASSES), np.zeros(CLASSES)
    for r in counts.groupBy("class").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("t")).collect():  # CLASSES rows at most
        totals[r["class"]] += r["n"] + r["t"]
        distinct[r["class"]] = r["t"]
    for w, n in top:
        totals[class_of(w)] -= n + 1
        distinct[class_of(w)] -= 1
    whole = len(held) == distinct.sum()
    rest = counts.filter("false")
    if not whole:
        word, n = held[-1][0].decode(), held[-1][1]
        rest = counts.filter((F.col("n") < n) | ((F.col("n") == n) & (F.col("word") > word)))
    return Vocabulary([w for w, _ in top], [n for _, n in top], dict(held), totals, distinct, whole), rest.select("word", "n")


@dataclass
class WindowNet:
    tables: np.ndarray  # 2 REACH x NEAR x HIDDEN: what a neighbour adds to the hidden layer
    group: np.ndarray  # HIDDEN x GROUPS
    member: np.ndarray  # GROUPS x HIDDEN x MEMBERS
    group_bias: np.ndarray  # GROUPS
    member_bias: np.ndarray  # GROUPS x MEMBERS
    near: np.ndarray  # 1 + LEAVES: a token's row as a neighbour; fixed

    @classmethod
    def new(cls, vocab: Vocabulary, seed: int = 0) -> WindowNet:
        rng = np.random.default_rng(seed)
        share = np.full(LEAVES, 0.5)
        share[: len(vocab.counts)] += vocab.counts
        share[WORDS:] += np.maximum(vocab.totals - vocab.distinct - 1, 0)
        share = share.reshape(GROUPS, MEMBERS)
        near = np.zeros(1 + LEAVES, dtype=np.int64)
        near[1 : NEAR_WORDS + 1] = np.arange(1, NEAR_WORDS + 1)
        near[NEAR_WORDS + 1 : 1 + WORDS] = 1 + NEAR_WORDS
        for i, w in enumerate(vocab.words[NEAR_WORDS:], NEAR_WORDS + 1):
            near[i] = 1 + NEAR_WORDS + class_of(w)
        near[1 + WORDS :] = 1 + NEAR_WORDS + np.arange(CLASSES)
        tables = (rng.normal(size=(2 * REACH, NEAR, HIDDEN)) * 0.1).astype(np.float32)
        none = np.zeros((HIDDEN, GROUPS), np.float32), np.zeros((GROUPS, HIDDEN, MEMBERS), np.float32)
        return cls(tables, *none, np.log(share.sum(1) / share.sum()).astype(np.float32), np.log(share / share.sum(1, keepdims=True)).astype(np.float32), near)

    def parts(self) -> list[np.ndarray]:
        return [self.tables, self.group, self.member, self.group_bias, self.member_bias]

    def flat(self) -> np.ndarray:
        return np.concatenate([p.ravel() for p in self.parts()])

    def with_flat(self, values: np.ndarray) -> WindowNet:
        ends = np.cumsum([p.size for p in self.parts()])
        return WindowNet(*[v.reshape(p.shape).astype(np.float32) for v, p in zip(np.split(values, ends[:-1]), self.parts(), strict=True)], self.near)

    def _hidden(self, rows: list[np.ndarray]) -> np.ndarray:
        h = self.tables[0].take(rows[0], axis=0)
        for k in range(1, 2 * REACH):
            h += self.tables[k].take(rows[k], axis=0)
        return np.tanh(h, out=h)

    def _wide(self) -> list[int]:
        """Groups whose members' scores have to be shifted."""
        return np.flatnonzero(np.abs(self.member).sum(axis=1).max(axis=1) + np.abs(self.member_bias).max(axis=1) > _SAFE).tolist()

    def _member_scores(self, h: np.ndarray, edges: list[int], wide: list[int], out: np.ndarray) -> None:
        """Into out. Rows of h are in order of their groups, which begin at edges."""
        for g, (a, b) in enumerate(pairwise(edges)):
            if a < b:
                scores = np.matmul(h[a:b], self.member[g], out=out[a:b])
                scores += self.member_bias[g]
        for g in wide:
            out[edges[g] : edges[g + 1]] -= out[edges[g] : edges[g + 1]].max(axis=1, keepdims=True, initial=-np.inf)

    def log_probs(self, padded: np.ndarray) -> np.ndarray:
        """padded: documents with REACH zeros before, between and after them. For each token of theirs, in order, log P(token | its neighbours)."""
        at, rows, wide = np.flatnonzero(padded), self.near[padded], self._wide()
        out = np.empty(len(at), dtype=np.float32)
        for first in range(0, len(at), _BLOCK):
            here = at[first : first + _BLOCK]
            order, of, member, edges = _by_group(padded[here].astype(np.int64) - 1)
            here, i = here[order], np.arange(len(of))
            h = self._hidden([rows[here + o] for o in _OFFSETS])
            scores = _scores(h, self.group, self.group_bias)
            got = scores[i, of] - _log_sums(scores)
            self._member_scores(h, edges, wide, scores)
            got += scores[i, member] - _log_sums(scores)
            out[first + order] = got
        return out

    def train(self, padded: np.ndarray, rng: np.random.Generator) -> int:
        """One pass over every position of padded documents, in mixed order; steps shrink with the squares of the gradients so far. Returns the number of positions."""
        squares = [np.full(p.shape, 0.01, np.float32) for p in self.parts()]
        rows, at = self.near[padded], rng.permutation(np.flatnonzero(padded))
        for first in range(0, len(at), BATCH):
            here = at[first : first + BATCH]
            self.step([rows[here + o] for o in _OFFSETS], padded[here].astype(np.int64) - 1, squares)
        return len(at)

    def step(self, near: list[np.ndarray], own: np.ndarray, squares: list[np.ndarray]) -> None:
        """near: the neighbours' rows by place; own: the tokens, from 0."""
        order, of, member, edges = _by_group(own)
        near, i = [x[order] for x in near], np.arange(len(own))
        h = self._hidden(near)
        p = _scores(h, self.group, self.group_bias)
        _to_slopes(p, i, of, [0, len(own)])
        dh, d_group, d_group_bias = p @ self.group.T, h.T @ p, p.sum(axis=0)
        self._member_scores(h, edges, self._wide(), p)
        _to_slopes(p, i, member, edges)
        back, d_member, d_member_bias = np.empty_like(h), np.zeros_like(self.member), np.zeros_like(self.member_bias)
        for g, (a, b) in enumerate(pairwise(edges)):
            if a < b:
                np.matmul(p[a:b], self.member[g].T, out=back[a:b])
                np.matmul(h[a:b].T, p[a:b], out=d_member[g])
                p[a:b].sum(axis=0, out=d_member_bias[g])
        for weights, own_squares, slope in zip(self.parts()[1:], squares[1:], (d_group, d_member, d_group_bias, d_member_bias), strict=True):
            _move(weights, own_squares, slope)
        dh += back
        dh *= 1 - h * h
        each = dh.ravel().astype(np.float64)
        for k in range(2 * REACH):
            _move(self.tables[k], squares[0][k], np.bincount(_CELLS.take(near[k], axis=0).ravel(), each, NEAR * HIDDEN).reshape(NEAR, HIDDEN).astype(np.float32))


_SAFE = 80  # exp of this and of its opposite are floats
_ONES = np.ones((MEMBERS, 1), np.float32)
_CELLS = np.arange(NEAR * HIDDEN).reshape(NEAR, HIDDEN)


def _by_group(own: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[int]]:
    """Tokens, from 0, by group: their order, then in that order each one's group and number in it, and where groups begin."""
    order = np.argsort((own // MEMBERS).astype(np.uint8), kind="stable")
    of, member = np.divmod(own[order], MEMBERS)
    return order, of, member, np.searchsorted(of, np.arange(GROUPS + 1)).tolist()


def _scores(h: np.ndarray, weights: np.ndarray, bias: np.ndarray) -> np.ndarray:
    """Shifted where exp could overflow; no value of h is beyond 1."""
    scores = h @ weights
    scores += bias
    if np.abs(weights).sum(axis=0).max() + np.abs(bias).max() > _SAFE:
        scores -= scores.max(axis=1, keepdims=True)
    return scores


def _log_sums(scores: np.ndarray) -> np.ndarray:
    """Logarithms of the sums of exp of the scores, whose place is used."""
    return np.log(np.exp(scores, out=scores) @ np.ones(scores.shape[1], np.float32))


def _to_slopes(scores: np.ndarray, i: np.ndarray, own: np.ndarray, edges: list[int]) -> None:
    """Scores to shares, less 1 for the own one. Rows are added up from edge to edge: BLAS rounds by the number of rows, and training carries on what was rounded."""
    np.exp(scores, out=scores)
    sums = np.empty((len(scores), 1), np.float32)
    for a, b in pairwise(edges):
        if a < b:
            np.matmul(scores[a:b], _ONES, out=sums[a:b])
    scores *= 1 / sums
    scores[i, own] -= 1


def _move(weights: np.ndarray, squares: np.ndarray, slope: np.ndarray) -> None:
    squares += slope * slope
    weights -= RATE * slope / np.sqrt(squares)


def padded(documents: list[np.ndarray]) -> np.ndarray:
    ends = np.zeros(REACH, np.uint16)
    return np.concatenate([ends, *(x for d in documents for x in (d, ends))])


def _sums_between(ends: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Sums of the values from each end to the next. They do not depend on the values of others."""
    sums, full = np.zeros(len(ends) - 1), np.diff(ends) > 0
    if full.any():
        sums[full] = np.add.reduceat(values, ends[:-1][full])
    return sums


def _asked_words(ends: np.ndarray, number: np.ndarray, bare: pa.Array, asked: np.ndarray) -> pa.Array:
    """For each document, the words that are asked for, each once, and how often it has them."""
    at = np.flatnonzero(asked.take(number))
    document = np.searchsorted(ends, at, side="right") - 1
    pairs, times = np.unique(document * max(len(bare), 1) + number[at], return_counts=True)
    document, word = np.divmod(pairs, max(len(bare), 1))
    firsts = np.searchsorted(document, np.arange(len(ends)))
    words = pa.StructArray.from_arrays([bare.take(pa.array(word)), pa.array(times, pa.int64())], names=["word", "times"])
    return pa.ListArray.from_arrays(pa.array(firsts, pa.int32()), words)


def tokenized(docs: DataFrame, vocab: Vocabulary, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """A row for each row of docs, in a table of the shared folder: row (its number), doc_id, h (a hash of doc_id and text), n_tokens, within (the sum of log P(word | class)), asked (words whose counts tasks do not hold), tokens (two bytes each)."""
    spark = docs.sparkSession
    ship(spark)
    shipped = spark.sparkContext.broadcast(vocab)  # bounded by HELD

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        look = Lookup(shipped.value)
        for batch in slices(batches, 3):
            n, number, bare = split(batch.column(3))
            token, within = look.of(bare)
            ends = np.concatenate([[0], np.cumsum(n, dtype=np.int64)])
            tokens = pa.Array.from_buffers(pa.binary(), len(n), [None, pa.py_buffer((2 * ends).astype(np.int32)), pa.py_buffer(token.take(number))])
            made = [pa.array(n, pa.int64()), pa.array(_sums_between(ends, np.nan_to_num(within).take(number))), _asked_words(ends, number, bare, np.isnan(within)), tokens]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], *made], names=["row", "doc_id", "h", "n_tokens", "within", "asked", "tokens"])

    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    found = rows.select("row", "doc_id", F.xxhash64("doc_id", "text").alias("h"), "text").mapInArrow(run, "row long, doc_id long, h long, n_tokens long, within double, asked array<struct<word: string, times: long>>, tokens binary")
    return written(found, shared_dir(spark), "tokens")


def parts_table(tokens: DataFrame, n_tokens: int, folder: str) -> DataFrame:
    """round, part, piece, tokens: padded documents. A part has about PART tokens in all its rounds; a piece is closed when it has PART / ROUNDS."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, piece, kept, size = None, 0, [], 0
        row = lambda: pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in ((at[0], pa.int32()), (at[1], pa.int32()), (piece, pa.int32()), (padded(kept).tobytes(), pa.binary()))], names=["round", "part", "piece", "tokens"])
        for batch in batches:
            for r, p, tokens in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(3), strict=True):
                if at != (r, p) or size >= PART // ROUNDS:
                    if kept:
                        yield row()
                    at, piece, kept, size = (r, p), piece + 1 if at == (r, p) else 0, [], 0
                kept.append(np.frombuffer(tokens.as_py(), np.uint16))
                size += len(kept[-1])
        if kept:
            yield row()

    n_parts = max(1, math.ceil(n_tokens / PART))
    rows = tokens.filter("n_tokens > 0").select(F.pmod(F.shiftright("h", 40), F.lit(ROUNDS)).cast("int").alias("round"), F.pmod("h", F.lit(n_parts)).cast("int").alias("part"), "h", "tokens")
    dealt = rows.repartition("round", "part").sortWithinPartitions("round", "part", "h", "tokens")
    return written(dealt.mapInArrow(pack, "round int, part int, piece int, tokens binary"), folder, "parts")


def _added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of the chunks that come by, whatever their number."""
    sums: dict[int, list] = {}
    for batch in batches:
        for chunk, n, values in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
            own = sums.setdefault(chunk, [0, 0.0])
            own[0] += n
            own[1] = own[1] + np.frombuffer(values.as_py(), np.float64)
    yield _chunks(list(sums.items()))


def _chunks(found: list[tuple[int, list]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([c for c, _ in found], pa.int32()), pa.array([n for _, (n, _) in found], pa.int64()), pa.array([v.tobytes() for _, (_, v) in found], pa.binary())], names=["chunk", "n", "v"])


def trained(tokens: DataFrame, vocab: Vocabulary) -> WindowNet:
    """tokens: of `tokenized`."""
    spark = tokens.sparkSession
    table, net = parts_table(tokens, vocab.size(), shared_dir(spark)), WindowNet.new(vocab)
    for r in range(ROUNDS):
        start = spark.sparkContext.broadcast(net)  # its size is fixed

        def run(batches: Iterator[pa.RecordBatch], start=start) -> Iterator[pa.RecordBatch]:
            total, n = 0.0, 0
            for batch in batches:
                for turn, part, piece, tokens in zip(*(batch.column(c) for c in range(4)), strict=True):
                    own = start.value.with_flat(start.value.flat())
                    m = own.train(np.frombuffer(tokens.as_py(), np.uint16), np.random.default_rng([turn.as_py(), part.as_py(), piece.as_py()]))
                    total, n = total + own.flat().astype(np.float64) * m, n + m
            if n:
                yield _chunks([(k, [n, total[k * _CHUNK : (k + 1) * _CHUNK]]) for k in range(math.ceil(len(total) / _CHUNK))])

        sums = table.filter(F.col("round") == r).mapInArrow(run, "chunk int, n long, v binary").repartition("chunk").mapInArrow(_added, "chunk int, n long, v binary").collect()  # one set of weights
        start.unpersist()
        if sums:
            net = net.with_flat(np.concatenate([np.frombuffer(x["v"], np.float64) / x["n"] for x in sorted(sums, key=lambda x: x["chunk"])]))
    return net


def scored(tokens: DataFrame, vocab: Vocabulary, rest: DataFrame, net: WindowNet) -> DataFrame:
    """tokens: of `tokenized`. doc_id, n_tokens, log_prob (the sum), mean_log_prob for each row. rest: the counts that vocab does not hold."""
    shipped = tokens.sparkSession.sparkContext.broadcast(net)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            each = shipped.value.log_probs(padded([np.frombuffer(t.as_py(), np.uint16) for t in batch.column(4)]))
            ends = np.concatenate([[0.0], np.cumsum(each, dtype=np.float64)])[np.cumsum(np.concatenate([[0], batch.column(2).to_numpy()]))]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(np.diff(ends) + batch.column(3).to_numpy())], names=["row", "doc_id", "n_tokens", "log_prob"])

    found = tokens.select("row", "doc_id", "n_tokens", "within", "tokens").mapInArrow(run, "row long, doc_id long, n_tokens long, log_prob double")
    if not vocab.whole:
        found = found.join(_asked(tokens, vocab, rest), "row", "left").withColumn("log_prob", F.col("log_prob") + F.coalesce("more", F.lit(0.0)))
    return found.select("doc_id", "n_tokens", "log_prob", (F.col("log_prob") / F.greatest("n_tokens", F.lit(1))).alias("mean_log_prob"))


def _asked(tokens: DataFrame, vocab: Vocabulary, rest: DataFrame) -> DataFrame:
    """row, more: what the words that tasks do not hold add to a row. None of them is frequent, or it would be held."""
    words = tokens.select("row", F.explode("asked").alias("a")).select("row", "a.word", "a.times").join(rest, "word", "left")
    small = Vocabulary([], [], {}, vocab.totals, vocab.distinct)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            word, n, times = batch.column(1).cast(pa.binary()).to_pylist(), batch.column(2).to_pylist(), batch.column(3).to_numpy()
            each = np.array([small.unseen(w) if c is None else small.seen(c, w) for w, c in zip(word, n, strict=True)], dtype=np.float64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(each * times)], names=["row", "more"])

    return words.select("row", "word", "n", "times").mapInArrow(run, "row long, more double").groupBy("row").agg(F.sum("more").alias("more"))


def op8_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    vocab, rest = vocabulary(docs)
    tokens = tokenized(docs, vocab)
    return scored(tokens, vocab, rest, trained(tokens, vocab))
