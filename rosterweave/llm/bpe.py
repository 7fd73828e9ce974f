"""BPE encoding and decoding by a trie of words.

Byte-pair encoding has this property: the encoding of a string is the encoding of a proper prefix and one last token, and given the
last token of each prefix, exactly one token that ends the string fits what stands before it. So one number a prefix, its last
token, holds its whole encoding. The distinct words of a batch are put into a trie, and the last tokens spread depth first: a
prefix that many words share is computed once. A word's encoding is then read backwards from its node.

Trie, encoded words and checked pairs are kept between batches and dropped when they reach MAX_NODES, MAX_WORDS and MAX_PAIRS, which
bounds memory and changes no result.
Tokens marked special in the file are cut out of a text first, as the tokenizers library does. A null text is empty, with no tokens.
Rows that repeat are encoded each time; a null doc_id passes through. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import json
from array import array
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rosterweave.shipping import ship

MAX_NODES, MAX_WORDS, MAX_PAIRS = 500_000, 400_000, 200_000

#: How byte-level files cut texts into words.
BYTE_LEVEL_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in byte-level files: visible Latin-1 characters stand for themselves, the others for the letters from U+0100."""
    own = [b for b in range(256) if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xAC or 0xAE <= b <= 0xFF]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


class TrieBpe:
    """Encodes and decodes with one vocabulary file (the JSON text of a byte-level BPE tokenizer)."""

    def __init__(self, file_text: str, max_nodes: int = MAX_NODES, max_words: int = MAX_WORDS):
        spec = json.loads(file_text)
        model, letters = spec["model"], byte_letters()
        vocab = model["vocab"]
        raw = {t: bytes(letters[c] for c in t) for t in vocab}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        size = 1 + max([*vocab.values(), *self.special.values()])
        self.max_nodes, self.max_words, self.ids = max_nodes, max_words, {b: vocab[t] for t, b in raw.items()}
        self.bytes_of = np.full(size, b"", dtype=object)
        for t, b in raw.items():
            self.bytes_of[vocab[t]] = b
        for t, i in self.special.items():
            self.bytes_of[i] = t.encode()
        self.packed = [int(i).to_bytes(4, "little") for i in range(size)]
        self.sizes = [len(b) for b in self.bytes_of]
        # rank of a merge; bytes have rank -1 and no parts
        self.rank, self.parts, self.merge = [-1] * size, [None] * size, {}
        for rank, m in enumerate(model["merges"]):
            a, b = (vocab[x] for x in (m.split(" ") if isinstance(m, str) else m))
            whole = self.ids[self.bytes_of[a] + self.bytes_of[b]]
            self.merge[a, b] = (rank, whole)
            if self.parts[whole] is None:
                self.rank[whole], self.parts[whole] = rank, (a, b)
        self.longest = max(map(len, self.ids))
        self.words = regex.compile(BYTE_LEVEL_PATTERN)
        self.cut = regex.compile("(" + "|".join(regex.escape(t) for t in sorted(self.special, key=len, reverse=True)) + ")") if self.special else None
        self.fits_memo: dict[tuple[int, int], bool] = {}
        self.whole_memo: dict[int, bool] = {}
        self.known: dict[str, bytes] = {}  # a word's ids as little-endian unsigned 32-bit integers
        self._clear()

    def _clear(self) -> None:
        self.child: dict[int, int] = {}  # node * 256 + byte: node
        self.last = array("i", [-1])  # a node's last token; the root has none

    def fits(self, a: int, b: int) -> bool:
        """Whether a and b stay apart when they stand side by side: undo their merges, latest first; no pair that meets at the border may have a merge that comes before the one just undone."""
        left, right, undone, after = a, b, len(self.merge) + 1, False
        while True:
            found = self.merge.get((left, right))
            # the merge at the border would have come first, or at the same rank further left
            if found is not None and (found[0] < undone or (found[0] == undone and after)):
                ok = False
                break
            l, r = self.rank[left], self.rank[right]
            if l < 0 and r < 0:
                ok = True
                break
            if l > r:
                undone, after, left = l, False, self.parts[left][1]
            else:
                undone, after, right = r, True, self.parts[right][0]
        self.fits_memo[a, b] = ok
        return ok

    def whole(self, token: int) -> bool:
        """Whether the token's own bytes are encoded as this one token."""
        if (known := self.whole_memo.get(token)) is None:
            at = [self.ids[bytes([x])] for x in self.bytes_of[token]]
            while len(at) > 1:
                best = min((self.merge.get(p, (len(self.merge), 0))[0] for p in zip(at, at[1:], strict=False)), default=len(self.merge))
                if best == len(self.merge):
                    break
                out, i = [], 0
                while i < len(at):
                    m = self.merge.get((at[i], at[i + 1])) if i + 1 < len(at) else None
                    out.append(m[1] if m and m[0] == best else at[i])
                    i += 2 if m and m[0] == best else 1
                at = out
            known = self.whole_memo[token] = at == [token]
        return known

    def _learn(self, words: set[str]) -> None:
        """Put words into the trie, spread last tokens to the new nodes, read the encodings.

        Words in sorted order walk the trie depth first: each goes on from the prefix that it shares with the one before it."""
        child, last, known, packed, sizes = self.child, self.last, self.known, self.packed, self.sizes
        nodes, path, before = [0], [-1], b""
        for spelled in sorted(map(str.encode, words)):
            shared, most = 0, min(len(spelled), len(before))
            while shared < most and spelled[shared] == before[shared]:
                shared += 1
            del nodes[shared + 1 :], path[shared + 1 :]
            node = nodes[shared]
            for depth in range(shared + 1, len(spelled) + 1):
                key = node << 8 | spelled[depth - 1]
                node = child.get(key, -1)
                if node < 0:
                    node = child[key] = len(last)
                    last.append(self._last_token(spelled, depth, path))
                nodes.append(node)
                path.append(last[node])
            before, out, depth = spelled, [], len(spelled)
            while depth:
                token = path[depth]
                out.append(packed[token])
                depth -= sizes[token]
            out.reverse()
            known[spelled.decode()] = b"".join(out)

    def _last_token(self, spelled: bytes, depth: int, path: list[int]) -> int:
        """The one token that ends the prefix of `depth` bytes and fits the last token of what stands before it."""
        ids, memo = self.ids, self.fits_memo
        # what the prefix one byte shorter ends with often just grows, so its length and one more comes first
        likely = self.sizes[path[depth - 1]] + 1 if depth > 1 else 1
        for length in (likely, *range(min(depth, self.longest), 0, -1)):
            token = ids.get(spelled[depth - length : depth])
            if token is None or not self.whole(token):
                continue
            if length == depth:
                return token
            pair = (path[depth - length], token)
            fits = memo.get(pair)
            if fits is None:
                fits = self.fits(*pair)
            if fits:
                return token
        raise ValueError("the vocabulary lacks a byte")

    def encode(self, text: str) -> bytes:
        """The ids of a whole text as little-endian unsigned 32-bit integers."""
        if self.cut is None or not any(t in text for t in self.special):
            return self._plain(text)
        return b"".join(np.array([self.special[p]], dtype="<u4").tobytes() if p in self.special else self._plain(p) for p in self.cut.split(text))

    def _plain(self, text: str) -> bytes:
        words = self.words.findall(text)
        if new := set(words).difference(self.known):
            if len(self.last) > self.max_nodes:
                self._clear()
            if len(self.fits_memo) > MAX_PAIRS:
                self.fits_memo.clear()
            if len(self.known) > self.max_words:
                self.known.clear()
                new = set(words)
            self._learn(new)
        return b"".join(map(self.known.__getitem__, words))

    def decode(self, packed: bytes) -> str:
        return b"".join(self.bytes_of[np.frombuffer(packed, dtype="<u4")].tolist()).decode("utf-8", "replace")


_loaded: dict[int, TrieBpe] = {}


def _tokenizer(file_text: str) -> TrieBpe:
    """One for each worker process."""
    key = hash(file_text)
    if key not in _loaded:
        _loaded.clear()
        _loaded[key] = TrieBpe(file_text)
    return _loaded[key]


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def encoded(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", path: str | None = None, with_ids: bool = False) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 for each row; with_ids adds the ids and the decoded text themselves."""
    ship(docs.sparkSession)
    # The driver alone reads the file; its size bounds the broadcast.
    shipped = docs.sparkSession.sparkContext.broadcast(Path(path or default_path()).read_text(encoding="utf-8"))
    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + (", ids array<int>, decoded string" if with_ids else "")
    fields = [("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())]
    fields += [("ids", pa.list_(pa.int32())), ("decoded", pa.string())] if with_ids else []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = _tokenizer(shipped.value)
        for batch in batches:
            out = [[] for _ in fields]
            for i in range(batch.num_rows):
                text = batch.column(1)[i].as_py() or ""
                packed = bpe.encode(text)
                decoded = bpe.decode(packed)
                row = [batch.column(0)[i].as_py(), len(packed) // 4, hashlib.sha256(packed).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest()]
                row += [np.frombuffer(packed, dtype="<i4").tolist(), decoded] if with_ids else []
                for column, value in zip(out, row, strict=True):
                    column.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(out, fields, strict=True)], names=[n for n, _ in fields])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, schema)


def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encoded(spark.read.parquet(f"{sf_dir}/documents.parquet"))
