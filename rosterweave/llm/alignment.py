"""Alignment of two tokenizers' tokens by byte offsets, and counts of the id pairs that they link.

Both tokenizers spell a space and then the text. A slice of an Arrow batch is laid end to end with its documents' byte offsets; the ends
of A's and of B's tokens are counted in one bincount over its bytes, and where both end there is a cut. What lies between two cuts is a
group: the smallest stretch that both cut out alike. Everything of a document (tokens, groups, links) is then a difference of prefix
sums at its offsets. Each A token is linked with each B token of its group.

A pair's count is the number of rows in which it is linked. A row's pairs are distinct and written with the number of times that each is
linked there, so texts are encoded once: counts come from that table by an aggregate, and meet its rows again through a join. The most
frequent pairs (PAIRS_SENT at most) are broadcast, since a pair may be in every row; the others are joined by a shuffle.

A is a byte-level BPE file (JSON), every token of which is what its own bytes are encoded to (then ranks and merges give the same
tokens; another file is refused); B is a sentencepiece model. Strings of special tokens are plain text. A text that is null or empty, or
whose tokens' bytes of A or B aren't those of a space and the text (such as one with U+2581, which B can't tell from a space), has no
tokens: zeros and an empty digest. A slice holds whole texts only, so a text of over SLICE_BYTES is a slice of its own, whose memory
grows with it. Rows that repeat (null ids too) are rows each and count each. Other columns are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from itertools import accumulate
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rosterweave.llm.bpe import BYTE_LEVEL_PATTERN, TrieBpe
from rosterweave.llm.common import shared_dir, written
from rosterweave.shipping import ship

#: Bytes of text that are laid end to end at once.
SLICE_BYTES = 2_000_000
#: Groups of over so many links are linked by their distinct ids and how often each occurs.
WIDE_LINKS = 4_096
#: Pairs whose counts are sent to every task; the counts of the others are joined.
PAIRS_SENT = 131_072

_ALIGNED = "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pairs array<long>, times array<long>"


class Aligner:
    """Aligns slices of texts. vocabulary: bytes of A's tokens by id; model: B's file."""

    def __init__(self, vocabulary: dict[bytes, int], model: bytes):
        import sentencepiece
        import tiktoken

        self.a = tiktoken.Encoding("a", pat_str=BYTE_LEVEL_PATTERN, mergeable_ranks=vocabulary, special_tokens={})
        self.b = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.ids_a, self.ids_b = 1 + max(vocabulary.values()), self.b.get_piece_size()
        self.bytes_a, self.bytes_b = np.full(self.ids_a, b"", dtype=object), np.full(self.ids_b, b"", dtype=object)
        for spelled, i in vocabulary.items():
            self.bytes_a[i] = spelled
        for i in range(self.ids_b):
            piece = self.b.id_to_piece(i)
            self.bytes_b[i] = bytes([int(piece[3:5], 16)]) if self.b.is_byte(i) else piece.replace("▁", " ").encode()
        self.size_a, self.size_b = (np.array(list(map(len, x)), dtype=np.int64) for x in (self.bytes_a, self.bytes_b))
        # how a token is written down: within its group, and at the end of its side of the group
        self.spelled = [s for i in range(self.ids_a) for s in (b"%d," % i, b"%d|" % i)] + [s for i in range(self.ids_b) for s in (b"%d," % i, b"%d;" % i)]

    def slice(self, texts: list[str]) -> tuple[list[int], dict[str, list], np.ndarray, np.ndarray, np.ndarray]:
        """Of non-empty texts, the places of those with tokens, their figures and written groups, then offsets, pairs and times of their distinct pairs."""
        raw = [b" " + t.encode() for t in texts]
        a = [self.a.encode_to_numpy(" " + t, disallowed_special=()) for t in texts]
        b = [np.array(x, dtype=np.int64) for x in self.b.encode(texts, num_threads=1)]
        ok = list(range(len(texts)))
        all_a, all_b = np.concatenate(a).astype(np.int64), np.concatenate(b)
        if b"".join(self.bytes_b[all_b].tolist()) != (whole := b"".join(raw)) or b"".join(self.bytes_a[all_a].tolist()) != whole:
            ok = [i for i in ok if b"".join(self.bytes_b[b[i]].tolist()) == raw[i] == b"".join(self.bytes_a[a[i]].tolist())]
            if not ok:
                return [], {}, np.zeros(1, np.int64), np.empty(0, np.int64), np.empty(0, np.int64)
            all_a, all_b = np.concatenate([a[i] for i in ok]).astype(np.int64), np.concatenate([b[i] for i in ok])
        a_of, b_of = (np.cumsum([0, *(len(x[i]) for i in ok)]) for x in (a, b))

        ends_a, ends_b = np.cumsum(self.size_a[all_a]), np.cumsum(self.size_b[all_b])
        cut = np.bincount(np.concatenate([ends_a, ends_b])) == 2
        before = np.cumsum(cut)  # cuts up to a byte offset
        of_a, of_b = (before[e] - cut[e] for e in (ends_a, ends_b))  # a token's group
        groups = int(before[-1])
        n_a, n_b = np.bincount(of_a, minlength=groups), np.bincount(of_b, minlength=groups)
        first_a, first_b = np.cumsum(n_a) - n_a, np.cumsum(n_b) - n_b
        links = n_a * n_b
        up_to = np.concatenate([[0], before[np.cumsum([len(raw[i]) for i in ok])]])  # a document's end is a cut
        sums = np.concatenate([[0], np.cumsum(links)])[up_to]
        figures = {"n_a": np.diff(a_of).tolist(), "n_b": np.diff(b_of).tolist(), "n_groups": np.diff(up_to).tolist(), "n_links": np.diff(sums).tolist()}

        # written groups: A's tokens of a group, then B's
        order = np.empty(len(all_a) + len(all_b), dtype=np.int64)
        order[np.arange(len(all_a)) + first_b[of_a]] = 2 * all_a + (np.arange(len(all_a)) == first_a[of_a] + n_a[of_a] - 1)
        order[np.arange(len(all_b)) + first_a[of_b] + n_a[of_b]] = 2 * (self.ids_a + all_b) + (np.arange(len(all_b)) == first_b[of_b] + n_b[of_b] - 1)
        at = (a_of + b_of).tolist()
        figures["written"] = [b"".join(map(self.spelled.__getitem__, order[s:e].tolist()))[:-1] for s, e in zip(at, at[1:], strict=False)]

        # distinct pairs: a document's number and the pair's in one key
        of_group, n_pairs = np.repeat(np.arange(len(ok)), np.diff(up_to)), self.ids_a * self.ids_b
        one = np.flatnonzero(links == 1)
        some = np.flatnonzero((links > 1) & (links <= WIDE_LINKS))
        group = np.repeat(some, links[some])
        k = np.arange(len(group)) - np.repeat(np.cumsum(links[some]) - links[some], links[some])
        left, right = np.concatenate([first_a[one], first_a[group] + k // n_b[group]]), np.concatenate([first_b[one], first_b[group] + k % n_b[group]])
        keys, times = np.unique(of_group[np.concatenate([one, group])] * n_pairs + all_a[left] * self.ids_b + all_b[right], return_counts=True)
        if len(wide := np.flatnonzero(links > WIDE_LINKS)):
            more_keys, more_times = [keys], [times]
            for g in wide:
                x, nx = np.unique(all_a[first_a[g] : first_a[g] + n_a[g]], return_counts=True)
                y, ny = np.unique(all_b[first_b[g] : first_b[g] + n_b[g]], return_counts=True)
                more_keys.append(of_group[g] * n_pairs + (x[:, None] * self.ids_b + y).ravel())
                more_times.append((nx[:, None] * ny).ravel())
            keys, inverse = np.unique(np.concatenate(more_keys), return_inverse=True)
            times = np.zeros(len(keys), dtype=np.int64)
            np.add.at(times, inverse, np.concatenate(more_times))
        return ok, figures, np.searchsorted(keys, np.arange(len(ok) + 1) * n_pairs), keys % n_pairs, times


def byte_vocabulary(file_text: str) -> dict[bytes, int]:
    """Bytes of the file's tokens with their ids, without special tokens. Refuses a file whose ranks and merges could differ."""
    trie, vocab = TrieBpe(file_text), json.loads(file_text)["model"]["vocab"]
    if odd := [t for t, i in vocab.items() if i not in trie.special.values() and not trie.whole(i)]:
        raise ValueError(f"{len(odd)} tokens are not what their own bytes are encoded to, such as {odd[0]!r}")
    return {spelled: i for spelled, i in trie.ids.items() if i not in trie.special.values()}


def default_paths() -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


_loaded: dict[int, Aligner] = {}


def _aligner(key: int, files: tuple[dict[bytes, int], bytes]) -> Aligner:
    """One for each worker process."""
    if key not in _loaded:
        _loaded.clear()
        _loaded[key] = Aligner(*files)
    return _loaded[key]


def alignments(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", paths: tuple[str, str] | None = None, with_groups: bool = False, slice_bytes: int = SLICE_BYTES) -> DataFrame:
    """A row a row of docs: doc_id, n_a, n_b, n_groups, n_links, groups_sha256, and its distinct linked pairs (A's id * B's vocabulary + B's id) with the times that each is linked. with_groups adds the written groups."""
    ship(docs.sparkSession)
    path_a, path_b = paths or default_paths()
    # The driver alone reads the files; their sizes bound the broadcast.
    shipped = docs.sparkSession.sparkContext.broadcast((byte_vocabulary(Path(path_a).read_text(encoding="utf-8")), Path(path_b).read_bytes()))
    key = hash((path_a, path_b))
    types = [pa.int64()] * 5 + [pa.string(), pa.list_(pa.int64()), pa.list_(pa.int64())] + [pa.string()] * with_groups
    names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pairs", "times", "groups"][: len(types)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = _aligner(key, shipped.value)
        for batch in batches:
            ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy().astype(np.int64))
            start = 0
            while start < batch.num_rows:
                end = max(start + 1, int(np.searchsorted(ends, (ends[start - 1] if start else 0) + slice_bytes, side="right")))
                yield _figures(aligner, batch.column(0).slice(start, end - start), batch.column(1).slice(start, end - start).to_pylist())
                start = end

    def _figures(aligner: Aligner, ids: pa.Array, texts: list[str | None]) -> pa.RecordBatch:
        full = [i for i, t in enumerate(texts) if t]
        found, figures, offsets, pairs, times = aligner.slice([texts[i] for i in full]) if full else ([], {}, np.zeros(1, np.int64), np.empty(0, np.int64), np.empty(0, np.int64))
        rows = np.array([full[i] for i in found], dtype=np.int64)
        columns = [ids]
        for name in names[1:5]:
            column = np.zeros(len(texts), dtype=np.int64)
            column[rows] = figures.get(name, [])
            columns.append(pa.array(column))
        digests, groups = [""] * len(texts), [""] * len(texts)
        for i, text in zip(rows.tolist(), figures.get("written", []), strict=True):
            digests[i] = hashlib.sha256(text).hexdigest()
            groups[i] = text.decode() if with_groups else ""
        lengths = np.zeros(len(texts), dtype=np.int64)
        lengths[rows] = np.diff(offsets)
        ends = pa.array(np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32))
        columns += [pa.array(digests, pa.string()), pa.ListArray.from_arrays(ends, pa.array(pairs)), pa.ListArray.from_arrays(ends, pa.array(times))]
        return pa.RecordBatch.from_arrays([*columns, *[pa.array(groups, pa.string())] * with_groups], names=names)

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, _ALIGNED + ", groups string" * with_groups)


def pair_counts(aligned: DataFrame, ids_b: int) -> DataFrame:
    """pair, n (rows that hold it linked), best (whether no pair of the same A id is held by more)."""
    counts = aligned.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count(F.lit(1)).alias("n"))
    counts = counts.withColumn("a", F.expr(f"pair div {ids_b}"))
    most = counts.groupBy("a").agg(F.max("n").alias("most"))  # a row an id of A's vocabulary at most
    return counts.join(F.broadcast(most), "a").select("pair", "n", (F.col("n") == F.col("most")).alias("best"))


def cross_aligned(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", paths: tuple[str, str] | None = None, sent: int = PAIRS_SENT) -> DataFrame:
    """A row a row of docs: doc_id, n_a, n_b, n_groups, n_links, n_best (links of a pair with the most rows of its A id), count_sum (of the counts over its links), groups_sha256."""
    import sentencepiece

    folder, ids_b = shared_dir(docs.sparkSession), sentencepiece.SentencePieceProcessor(model_file=(paths or default_paths())[1]).get_piece_size()
    aligned = written(alignments(docs, text_col, id_col, paths).withColumn("row", F.monotonically_increasing_id()), folder, "aligned")
    counts = written(pair_counts(aligned, ids_b), folder, "counts")
    # pairs by the power of two of their counts: 64 rows at most
    levels = {r["level"]: r["n"] for r in counts.groupBy(F.floor(F.log2("n")).alias("level")).agg(F.count(F.lit(1)).alias("n")).collect()}
    least = next((level + 1 for level, n in zip(sorted(levels, reverse=True), accumulate(levels[x] for x in sorted(levels, reverse=True)), strict=True) if n > sent), 0)
    frequent = F.col("n") >= F.lit(2**least)
    links = aligned.select("row", F.explode(F.arrays_zip("pairs", "times")).alias("link")).select("row", F.col("link.pairs").alias("pair"), F.col("link.times").alias("times"))
    sums = [F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"), F.sum(F.col("n") * F.col("times")).alias("count_sum")]
    near = links.join(F.broadcast(counts.filter(frequent)), "pair").groupBy("row").agg(*sums)
    if least:
        rest = links.join(F.broadcast(counts.filter(frequent).select("pair")), "pair", "left_anti").join(counts.filter(~frequent), "pair").groupBy("row").agg(*sums)
        near = near.unionByName(rest).groupBy("row").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    found = aligned.drop("pairs", "times").join(near, "row", "left")
    zero = [F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("n_best", "count_sum")]
    return found.select("doc_id", "n_a", "n_b", "n_groups", "n_links", *zero, "groups_sha256")


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cross_aligned(spark.read.parquet(f"{sf_dir}/documents.parquet"))
