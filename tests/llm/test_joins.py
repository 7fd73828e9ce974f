"""Operators 11, 12 and 13 against plain versions."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from rosterweave.llm import alignment, hard_negatives, ngram_join
from tests.conftest import SF
from tests.llm.cases import ODD

# ---- 11: alignment


def plain_alignment(rows):
    """By the libraries alone: groups from two walks over the bytes, links as a double loop."""
    import public_tokenizers as P
    import sentencepiece
    from tokenizers import Tokenizer, decoders

    a, b = Tokenizer.from_file(P.path("byte_bpe_50k.json")), sentencepiece.SentencePieceProcessor(model_file=P.path("piece_bpe_32k.model"))
    a.encode_special_tokens = True
    from rosterweave.llm.bpe import byte_letters

    letters = byte_letters()
    assert decoders.ByteLevel().decode(list(a.encode(" x", add_special_tokens=False).tokens)) == " x"
    out, links, held = [], [], Counter()
    for i, text in rows:
        whole, linked, groups = (" " + (text or "")).encode(), Counter(), []
        ids_a, ids_b = a.encode(" " + (text or ""), add_special_tokens=False).ids, b.encode(text or "")
        bytes_a = [bytes(letters[c] for c in a.id_to_token(k)) for k in ids_a]
        bytes_b = [bytes([int(b.id_to_piece(k)[3:5], 16)]) if b.is_byte(k) else b.id_to_piece(k).replace("▁", " ").encode() for k in ids_b]
        if text and b"".join(bytes_a) == whole == b"".join(bytes_b):
            ends = lambda parts: [sum(map(len, parts[: k + 1])) for k in range(len(parts))]
            ends_a, ends_b = ends(bytes_a), ends(bytes_b)
            cuts = [0, *sorted(set(ends_a) & set(ends_b))]
            for s, e in zip(cuts, cuts[1:], strict=False):
                groups.append(([k for k, x in zip(ids_a, ends_a, strict=True) if s < x <= e], [k for k, x in zip(ids_b, ends_b, strict=True) if s < x <= e]))
            for x, y in groups:
                linked.update((p, q) for p in x for q in y)
            out.append((i, len(ids_a), len(ids_b), len(groups), sum(linked.values()), hashlib.sha256(";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups).encode()).hexdigest()))
        else:
            out.append((i, 0, 0, 0, 0, ""))
        links.append(linked)
        held.update(set(linked))
    most = {}
    for (p, _), n in held.items():
        most[p] = max(most.get(p, 0), n)
    return [(*o[:5], sum(n for (p, q), n in x.items() if held[p, q] == most[p]), sum(n * held[pair] for pair, n in x.items()), o[5]) for o, x in zip(out, links, strict=True)]


TEXTS = [
    "plain words, and 12345 numbers", "<s> </s> <unk> <|endoftext|> <0x41>", "x▁y", "   odd  spaces \x85\x0b", "😀👩‍👩‍👧 emoji ﬁ ① é Å", "日本語のテキスト。次の文。", "a\x00b\x01", " ", "  ", "\n\n\n",
    "===========", "aaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaa", "plain words, and plain words", "การทดสอบ ภาษาไทย", "١٢٣ नमस्ते",
]
SHORT_ODD = [(i, t[:900] if t else t) for i, t in ODD]


@pytest.mark.parametrize("sent", [0, 5, 10**6])
def test_alignment(docs, sent):
    rows = SHORT_ODD + [(100 + k, t) for k, t in enumerate(TEXTS)]
    got = alignment.cross_aligned(docs(rows), sent=sent)
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, plain_alignment(rows)))


def test_wide_groups_are_linked_by_distinct_ids(monkeypatch):
    import public_tokenizers as P

    make = lambda: alignment.Aligner(alignment.byte_vocabulary(open(P.path("byte_bpe_50k.json"), encoding="utf-8").read()), open(P.path("piece_bpe_32k.model"), "rb").read())  # noqa: E731, SIM115
    texts = [t for t in TEXTS if "▁" not in t] + ["12345678901234567890" * 30, "x" * 700]
    plain = make().slice(texts)
    monkeypatch.setattr(alignment, "WIDE_LINKS", 1)
    forced = make().slice(texts)
    assert plain[1] == forced[1] and all((x == y).all() for x, y in zip(plain[2:], forced[2:], strict=True))
    rows = plain_alignment(list(enumerate(texts)))
    assert plain[1]["n_links"] == [r[4] for r in rows]


def test_slices_change_nothing(docs):
    rows = docs([(k, t) for k, t in enumerate(TEXTS)] + [(90, None)])
    whole, cut = (sorted(map(repr, alignment.alignments(rows, with_groups=True, slice_bytes=n).collect())) for n in (10**6, 1))
    assert whole == cut


def test_alignment_gives_groups_and_stands_empty_tables(docs):
    rows = alignment.alignments(docs([(1, "ab"), (2, None)]), with_groups=True).orderBy("doc_id").collect()
    assert rows[0]["groups"].count("|") == rows[0]["n_groups"] > 0 and rows[1]["groups"] == "" and rows[1]["pairs"] == []
    assert alignment.cross_aligned(docs([])).collect() == []


def test_a_vocabulary_with_unreachable_tokens_is_refused():
    import json

    from rosterweave.llm.bpe import byte_letters

    vocab = {c: i for i, c in enumerate(byte_letters())} | {"ab": 256, "bc": 257, "abc": 258}
    spec = {"model": {"vocab": vocab, "merges": ["b c", "a b", "ab c"]}, "added_tokens": []}
    with pytest.raises(ValueError, match="own bytes"):
        alignment.byte_vocabulary(json.dumps(spec))
    spec["model"]["merges"] = ["a b", "b c", "ab c"]
    assert len(alignment.byte_vocabulary(json.dumps(spec))) == 259


# ---- 12: hard negatives


def plain_negatives(rows, positives=5, negatives=10, band=(30, 90)):
    def whole(v):
        return [max(-(2**24), min(2**24, int(np.floor(max(-1e12, min(1e12, 256 * float(x))))))) for x in v]

    kept = [(k, i, label, whole(v)) for k, (i, v, label) in enumerate(rows) if v is not None and label is not None and all(x is not None and np.isfinite(x) for x in v)]
    dot = lambda x, y: sum(p * q for p, q in zip(x, y, strict=False))
    out = []
    for k, i, label, v in kept:
        if i is None or i % 100:
            continue
        scored = sorted((-dot(v, w), j is None, j or 0, m, other) for m, j, other, w in kept if m != k)
        own, rest = [x for x in scored if x[4] == label][:positives], [x for x in scored if x[4] != label]
        for s, null, j, _, _ in own:
            found = [x for x in rest if band[0] * -s <= 100 * -x[0] <= band[1] * -s][:negatives]
            out += [(i, None if null else j, rank + 1, None if x[1] else x[2], -s, -x[0]) for rank, x in enumerate(found)]
    return out


VECTORS = "vec_id long, embedding array<float>, label int, q string, `row` int, far double, slots int"


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, label, "q", 1, 0.5, 3) for i, v, label in rows], VECTORS).repartition(3)


def clouds(n, dims=6, seed=0, spread=0.3):
    rnd = np.random.default_rng(seed)
    centres = rnd.normal(size=(12, dims))
    return [(k, [float(x) for x in centres[k % 12] + spread * rnd.normal(size=dims)], int(rnd.integers(4))) for k in range(n)]


#: Nulls, odd components, ties, copies, one id twice, unequal lengths, negative scores.
STRANGE = [
    (0, [1.0, 0.0], 1), (100, [1.0, 0.0], 1), (100, [0.5, 0.5], 1), (None, [0.9, 0.1], 1), (None, [0.6, 0.2], 2), (1, None, 1), (2, [1.0, None], 1), (3, [float("nan"), 1.0], 2), (4, [float("inf"), 1.0], 2), (5, [0.8, 0.1], None),
    (200, [-1.0, 0.0], 2), (201, [0.5], 2), (202, [], 1), (203, [0.5, 0.1, 9.0], 3), (300, [], 3), (301, [3e30, -3e30], 2), *[(400 + k, [0.7, 0.1], 2) for k in range(25)], *[(500 + k, [0.9, 0.1], 1) for k in range(9)],
]


@pytest.mark.parametrize(("rows", "sample", "pivots"), [(STRANGE, 2048, 128), (STRANGE, 1, 1), (clouds(700), 300, 20), (clouds(700), 2, 2), (clouds(700, seed=3, spread=0.01), 100, 12), ([], 10, 3), ([(0, [1.0], 1)], 5, 5), ([(0, None, 1)], 5, 5)])
def test_hard_negatives(spark, rows, sample, pivots):
    got = hard_negatives.hard_negatives(vectors(spark, rows), F.col("vec_id") % 100 == 0, sample=sample, pivots=pivots)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, plain_negatives(rows)))


def test_hard_negatives_in_many_groups_chunks_and_blocks(spark, monkeypatch):
    """Every row an anchor; tiny groups, chunks, matrices and blocks of routes."""
    rows = [(100 * k, v, label) for k, v, label in clouds(260, dims=3, seed=5)]
    monkeypatch.setattr(hard_negatives, "GROUP_MOST", 7)
    monkeypatch.setattr(hard_negatives, "CHUNK", 3)
    monkeypatch.setattr(hard_negatives, "_CELLS", 50)
    monkeypatch.setattr(hard_negatives, "ROUTES_SENT", 40)
    got = hard_negatives.hard_negatives(vectors(spark, rows), F.col("vec_id") % 100 == 0, sample=60, pivots=9, positives=3, negatives=4, band=(50, 95))
    assert sorted(map(tuple, got.collect())) == sorted(plain_negatives(rows, 3, 4, (50, 95)))


def test_bounds_keep_rows_from_groups_that_need_none(spark):
    """On vectors that lie in clouds, a row is copied to few groups."""
    rows = [(100 * k, v, label) for k, v, label in clouds(1200, dims=8, seed=2, spread=0.02)]
    join = hard_negatives.Join(vectors(spark, rows), "vec_id", "embedding", "label", F.col("vec_id") % 100 == 0, 600, 24)
    join.size = 40
    slot = F.struct(F.lit(0).alias("slot"), F.lit(-(2**62)).cast("long").alias("low"), F.lit(2**62).cast("long").alias("high"))
    join.best(join.anchors.withColumn("slots", F.array(slot)), 5, False, "t")
    routes, cells = (spark.read.parquet(f"{join.folder}/{t}") for t in ("t_routes", "cells"))
    served, groups = cells.join(routes, "cell").filter("far >= lo and far <= hi").count(), routes.select("group").distinct().count()
    assert groups > 10 and served < 0.6 * groups * len(rows)


def test_hard_negatives_match_their_sql(spark):
    con = duckdb.connect()
    con.sql(f"CREATE VIEW embeddings AS SELECT * FROM '{SF}/embeddings.parquet'")
    assert sorted(map(tuple, hard_negatives.op12_hard_negatives(spark, SF).collect())) == sorted(con.sql(hard_negatives.ORACLE).fetchall())


# ---- 13: n-gram join


def plain_join(rows, n=3, of=90):
    """All pairs of sets of spelled shingles."""
    def shingles(text):
        words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        return frozenset([tuple(words)] if 0 < len(words) < n else [tuple(words[k : k + n]) for k in range(len(words) - n + 1)])

    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= of * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    least = defaultdict(list)
    for i in range(len(rows)):
        least[find(i)].append(rows[i][0])
    return [(rows[i][0], len(sets[i]), min((x for x in least[find(i)] if x is not None), default=None)) for i in range(len(rows))]


def near_copies(seed, groups=12, sizes=(5, 12, 40, 90)):
    """Groups of texts that differ in some words, many of them near the threshold; chains; short texts; copies."""
    rnd, rows = random.Random(seed), []
    word = lambda: rnd.choice("abcdefghij") + str(rnd.randrange(60))
    for g in range(groups):
        base = [word() for _ in range(rnd.choice(sizes))]
        for _ in range(rnd.randrange(1, 9)):
            new = list(base)
            for _ in range(rnd.randrange(0, 1 + len(base) // 25)):
                new[rnd.randrange(len(new))] = word()
            if rnd.random() < 0.4:
                new = new[: len(new) - rnd.randrange(0, 1 + len(new) // 12)] + [word() for _ in range(rnd.randrange(3))]
            rows.append((len(rows), rnd.choice([" ", "  ", "\n"]).join(new)))
            if rnd.random() < 0.3:
                base = new
    rows += [(rnd.randrange(len(rows)), t.upper()) for _, t in rnd.sample(rows, 5)] + [(None, rows[0][1]), (None, "only two")] + [(len(rows) + 50, "only two"), (len(rows) + 51, "Only  two\n"), (len(rows) + 52, "one")]
    return rows


@pytest.mark.parametrize(("rows", "task_tokens"), [(ODD, 10**6), (near_copies(1), 10**6), (near_copies(1), 40), (near_copies(2, groups=25), 40), ([], 1), ([(None, "a b c d"), (None, "a b c d")], 1)])
def test_ngram_join(docs, rows, task_tokens):
    """task_tokens 40: clusters are searched shard by shard, and shards in tiles."""
    got = ngram_join.similar(docs(rows), task_tokens=task_tokens, picks=1)
    assert got.columns == ["doc_id", "n_shingles", "component_id"]
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, plain_join(rows)))


@pytest.mark.parametrize("of", [60, 75, 90, 97])
def test_links_at_the_threshold_share_a_shard_and_are_found(of):
    rnd = np.random.default_rng(of)
    shards, linked = ngram_join.Shards(of), 0
    for _ in range(1500):
        m = int(rnd.choice([1, 2, 3, 5, 9, 10, 11, 19, 20, 21, 60, 61, 300]))
        both = rnd.integers(0, 2**63, m).astype(np.uint64) * np.uint64(2)
        x = np.unique(np.concatenate([both, rnd.integers(0, 2**63, rnd.integers(0, 2 + m // 10)).astype(np.uint64)]))
        y = np.unique(np.concatenate([both[rnd.integers(0, 2) :], rnd.integers(0, 2**63, rnd.integers(0, 2 + m // 10)).astype(np.uint64)]))
        if not len(y):
            continue
        same = len(np.intersect1d(x, y))
        near = 100 * same >= of * (len(x) + len(y) - same)
        linked += near
        assert bool(ngram_join.spanning([x, y], [0, 1], of)) == near
        if near:
            assert np.intersect1d(shards.names(x), shards.names(y)).size
    assert linked > 100


@pytest.mark.parametrize("seed", range(4))
def test_search_equals_counting(seed):
    rnd = random.Random(seed)
    sets = [np.unique(np.array([rnd.randrange(40) for _ in range(rnd.choice([3, 8, 30, 60]))], dtype=np.uint64)) for _ in range(120)]
    sets.sort(key=len)
    lists, alive = ngram_join.Lists(sets, 70), np.ones(len(sets), dtype=bool)
    for q in range(len(sets)):
        alive[q] = False
        want = [j for j in range(len(sets)) if alive[j] and 100 * (s := len(np.intersect1d(sets[q], sets[j]))) >= 70 * (len(sets[q]) + len(sets[j]) - s)]
        assert sorted(lists.search(q, alive).tolist()) == want
        if q == 50:
            lists.keep(alive)


def test_merging_with_skips_counts_right():
    rnd = random.Random(9)
    for _ in range(300):
        lists = [sorted(rnd.sample(range(30), rnd.randrange(1, 20))) for _ in range(rnd.randrange(1, 9))]
        least, counts = rnd.randrange(1, 6), Counter(x for line in lists for x in line)
        assert dict(zip(*ngram_join._merged(lists, least), strict=True)) == {x: n for x, n in counts.items() if n >= least}


def test_a_large_group_gives_few_links():
    base = np.arange(1, 200, dtype=np.uint64) * np.uint64(7919)
    sets = [np.unique(np.concatenate([base, np.array([10**6 + k], dtype=np.uint64)])) for k in range(400)]
    assert len(ngram_join.spanning(sets, list(range(400)))) == 399
    assert len(ngram_join.spanning(sets, [k % 2 for k in range(400)])) == 1
