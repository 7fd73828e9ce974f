"""Operators 2, 3, 4 and 10 against plain versions."""

import hashlib
import random
import re
import unicodedata
import zlib

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from rosterweave.llm import exact_dedup, line_dedup, simhash, substring_dedup
from rosterweave.llm.components import components
from tests.conftest import SF
from tests.llm.cases import ODD


def sha(t):
    return hashlib.sha256(t.encode()).hexdigest()


def corpus(seed, n=150):
    """Documents with copies, near copies, shared lines and passages."""
    rnd = random.Random(seed)
    words = ["".join(rnd.choice("abcdefghij") for _ in range(rnd.randint(2, 8))) for _ in range(300)]
    sentence = lambda: " ".join(rnd.choice(words) for _ in range(rnd.randint(3, 14))).capitalize() + rnd.choice(".!?")
    passage, line = " ".join(sentence() for _ in range(8)), sentence() + " and a longer common line."
    out = []
    for i in range(n):
        kind = rnd.random()
        if out and kind < 0.15:
            t = rnd.choice(out)[1].replace(" ", "  ", rnd.randint(0, 2))
        elif out and kind < 0.3:
            w = rnd.choice(out)[1].split(" ")
            w[rnd.randrange(len(w))] = rnd.choice(words)
            t = " ".join(w)
        else:
            parts = [sentence() for _ in range(rnd.randint(1, 40))]
            if kind > 0.7:
                parts.insert(rnd.randrange(len(parts)), passage)
            if kind > 0.5:
                parts.insert(rnd.randrange(len(parts)), "\n" + line.upper() + "\n")
            t = " ".join(parts)
        out.append((i, t))
    return out


def plain_exact(rows):
    groups = {}
    for i, t in rows:
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]", "", t or ""), []).append((-len(t or ""), i is None, i))
    out = []
    for i, t in rows:
        norm = re.sub(r"[\x20\x09-\x0D]", "", t or "")
        keep = min(groups[norm])[2]
        out.append((i, keep, len(groups[norm]), i == keep, sha(norm)))
    return out


@pytest.mark.parametrize("rows", [ODD, corpus(1), []])
def test_exact(docs, rows):
    got = exact_dedup.exact_duplicates(docs(rows)).select("doc_id", "keep_id", "group_size", "kept", "text_sha256").collect()
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, plain_exact(rows)))


def test_exact_keeps_one_row_with_its_columns(docs):
    df = docs([(4, "same text"), (4, "same text"), (5, "same  text"), (5, "same  text"), (6, "other")])
    got = exact_dedup.deduplicated(df)
    assert got.columns == df.columns and sorted((r["doc_id"], r["text"], r["key"]) for r in got.collect()) == [(5, "same  text", 1), (6, "other", 1)]


def test_hash_collision_does_not_join(docs, monkeypatch):
    """With a hash of one value all texts are one chain; comparing bytes parts them."""
    real = F.xxhash64
    monkeypatch.setattr(exact_dedup.F, "xxhash64", lambda *c: real(F.lit(1)) if c == ("norm",) else real(*c))
    rows = corpus(2, 40)
    got = exact_dedup.exact_duplicates(docs(rows)).select("doc_id", "keep_id", "group_size", "kept", "text_sha256").collect()
    assert sorted(map(tuple, got)) == sorted(plain_exact(rows))


def test_owners_have_ranges_and_files_of_their_own(spark, docs):
    """Each owner's folder has hashes between those of its neighbours; a directory that leads elsewhere loses what it led to."""
    index = exact_dedup.build(docs(corpus(1)), bucket_rows=10)
    pages = index.pages.groupBy("owner").agg(F.min(F.shiftrightunsigned("h64", 1)).alias("low"), F.max(F.shiftrightunsigned("h64", 1)).alias("high"), F.count_distinct("bucket").alias("buckets")).orderBy("owner").collect()
    assert len(pages) == 2 and pages[0]["high"] < pages[1]["low"] and all(r["buckets"] > 3 for r in pages)
    assert {r["owner"] for r in index.chains.collect()} <= {r["owner"] for r in pages}
    probe = lambda: {r["doc_id"]: r["found"] for r in index.probe(docs([(900, corpus(1)[0][1] + "\n"), (901, "not there"), (None, corpus(1)[7][1])])).collect()}
    assert probe() == {900: True, 901: False, None: True}
    index.directory = index.directory.withColumn("bucket", F.lit(0))
    assert not all(probe().values()) and probe()[900] is False


def test_hot_chains_are_salted(docs, monkeypatch):
    monkeypatch.setattr(exact_dedup, "HOT_SHARE", 20)
    monkeypatch.setattr(exact_dedup, "HOT_SALTS", 4)
    rows = [(i, "hot text" + " " * (i % 5)) for i in range(60)] + corpus(2, 40)[1:]
    got = exact_dedup.exact_duplicates(docs(rows)).select("doc_id", "keep_id", "group_size", "kept", "text_sha256").collect()
    assert sorted(map(tuple, got)) == sorted(plain_exact(rows))


def test_pages_of_a_hot_text_are_dealt_over_tasks(spark, docs, monkeypatch):
    """Half of all rows are blank; no task writes over twice its share of pages, and the long chain leaves the directory small."""
    monkeypatch.setattr(exact_dedup, "HOT_SALTS", 4)
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    try:
        rows = [(i, "" if i % 2 else f"text number {i}") for i in range(4000)]
        index = exact_dedup.build(docs(rows), bucket_rows=300)
        task = F.regexp_extract(F.input_file_name(), r"part-(\d+)", 1)
        shares = [r["count"] for r in index.pages.groupBy(task.alias("task")).count().collect()]
        assert len(shares) == 8 and sum(shares) == 4000 and max(shares) <= 2 * 4000 / 8
        assert index.depth <= 4 and index.pages.groupBy("owner").count().count() >= 4
        got = index.marked().select("doc_id", "keep_id", "group_size", "kept", "text_sha256").collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "2")
    assert sorted(map(tuple, got)) == sorted(plain_exact(rows))


def test_an_owners_task_groups_without_a_shuffle(spark, docs, monkeypatch):
    """Texts are moved once, to their owner."""
    plans, kind = [], type(spark.range(0))
    real = kind.groupBy

    def spy(df, *c):
        out = real(df, *c)
        if any(isinstance(x, str) and x == "norm" for x in c):
            plans.append(out.count()._jdf.queryExecution().executedPlan().toString())
        return out

    monkeypatch.setattr(kind, "groupBy", spy)
    exact_dedup.build(docs(corpus(1)))
    assert len(plans) == 1 and plans[0].count("Exchange hashpartitioning(owner") == 1
    assert plans[0].count("Exchange hashpartitioning") == 2 and plans[0].count("Exchange hashpartitioning(_word") == 1  # the bitmap's


def test_directory_doubles_until_buckets_fit():
    rnd = random.Random(3)
    counts = {rnd.randrange(2**10): rnd.randint(1, 50) for _ in range(300)} | {5: 10_000}
    slots = exact_dedup.directory(counts, bucket_rows=400, max_depth=10)
    assert len(slots) == 2**10 and slots == sorted(slots)
    load = {}
    for slot, n in counts.items():
        load[slots[slot]] = load.get(slots[slot], 0) + n
    over = [b for b, n in load.items() if n > 400]
    assert over == [slots[5]] and exact_dedup.directory({}, 1) == [0] and exact_dedup.directory({0: 3}, 5) == [0]


def signed_hash(text):
    h = xxhash.xxh64_intdigest((text or "").encode(), 42)
    return h - 2**64 if h >= 2**63 else h


def plain_lines(rows):
    key = lambda line: line.strip(" \t\n\x0b\x0c\r").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
    rank = lambda i, t: (-(2**63) if i is None else i, signed_hash(t))
    held = {}
    for i, t in {(i, t or "") for i, t in rows}:
        for line in t.split("\n"):
            held.setdefault(key(line), set()).add(rank(i, t))
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        stay = [x for x in lines if len(key(x)) < 20 or len(held[key(x)]) < 3 or max(held[key(x)]) == rank(i, t)]
        out.append((i, len(lines), len(lines) - len(stay), sha("\n".join(stay))))
    return out


LINES = [(1, "A common line of more than twenty\nown"), (2, " a COMMON line of more than twenty\r\nA common line of more than twenty"), (3, "x\n\na common line of more than twenty\n"), (None, "A common line of more than twenty"), (3, "Écommon line of more than twenty")]
NO_IDS = [(None, f"{w}\nA common line of more than twenty\n{w}") for w in "abcde"] + [(7, "A common line of more than twenty"), (7, "A common line of more than twenty\nx")]


@pytest.mark.parametrize("rows", [ODD, corpus(4), LINES, NO_IDS, NO_IDS[:5], []])
@pytest.mark.parametrize("batches", [1, 4])
def test_lines(docs, rows, batches):
    got = line_dedup.without_repeated_lines(docs(rows), batches=batches).select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("kept_text").cast("binary"), 256))
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, plain_lines(rows)))


def run_batch(spark, *rows):
    return spark.createDataFrame([(bytearray(k), 1, (i, 0)) for k, i in rows], line_dedup._ROW)


def test_runs_are_compacted_kept_and_opened(spark, tmp_path):
    runs = line_dedup.SortedRuns(spark, str(tmp_path))
    for b in range(5):
        runs.add(run_batch(spark, (b"k", 10 - b), (bytes([b]), 10 - b)))
    assert [len(level) for level in runs.levels] == [1, 0, 1]
    held = lambda r: {(bytes(x["key"]), x["n"], x["holder"]["doc_id"]) for x in r.merged(r.tables()).collect()}
    want = {(b"k", 5, 10), *((bytes([b]), 1, 10 - b) for b in range(5))}
    assert held(runs) == want
    runs.save()
    runs.close()
    again = line_dedup.SortedRuns.open(spark, str(tmp_path))
    assert [len(level) for level in again.levels] == [1, 0, 1] and held(again) == want
    again.add(run_batch(spark, (b"k", 99), (b"new", 98)))
    assert held(again) == {(b"k", 6, 10), (b"new", 1, 98), *list(want - {(b"k", 5, 10)})}
    again.close()


def test_merging_with_a_run_moves_none_of_its_rows(spark, tmp_path):
    """One shuffle, of the batch; and without the anti-join, holders would be wrong."""
    runs = line_dedup.SortedRuns(spark, str(tmp_path))
    runs.add(run_batch(spark, (b"k", 10)))
    held = runs.tables()[0].select("key", F.lit(True).alias("held"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = run_batch(spark, (b"k", 9)).groupBy("key").agg(F.sum("n")).join(held, "key", "left")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("Exchange hashpartitioning") == 1 and "SortMergeJoin" in plan
    runs._write(run_batch(spark, (b"k", 9)), 0)  # a run that was not merged against the first
    assert runs.merged(runs.tables()).first()["holder"]["doc_id"] == 9
    runs.close()


def test_a_second_call_adds_to_kept_runs(spark, docs, tmp_path):
    line = "A common line of more than twenty"
    runs = line_dedup.SortedRuns(spark, str(tmp_path))
    first = line_dedup.without_repeated_lines(docs([(1, line), (2, line)]), runs=runs)
    assert all(r["n_dropped"] == 0 for r in first.collect())
    runs.close()
    second = line_dedup.without_repeated_lines(docs([(8, line + "\nown"), (9, "else")]), runs=line_dedup.SortedRuns.open(spark, str(tmp_path)))
    assert {(r["doc_id"], r["kept_text"]) for r in second.collect()} == {(8, "own"), (9, "else")}


def plain_fingerprint(text):
    w = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower())
    if not w:
        return 0
    hs = [xxhash.xxh64_intdigest(b" ".join(w[i : i + 4]), 42) for i in range(max(1, len(w) - 3))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def plain_components(fps, ids, bits=4):
    u = sorted(set(fps))
    parent = list(range(len(u)))

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for i in range(len(u)):
        for j in range(i):
            if (u[i] ^ u[j]).bit_count() <= bits:
                parent[find(i)] = find(j)
    least = {}
    for f, i in zip(fps, ids, strict=True):
        r = find(u.index(f))
        least[r] = min(least.get(r, 1 << 62), 1 << 62 if i is None else i)
    return [least[find(u.index(f))] for f in fps]


@pytest.mark.parametrize("rows", [ODD, corpus(5), []])
def test_simhash(docs, rows):
    got = sorted((tuple(r) for r in simhash.near_duplicates(docs(rows)).collect()), key=repr)
    fps = [plain_fingerprint(t) for _, t in rows]
    named = [None if c == 1 << 62 else c for c in plain_components(fps, [i for i, _ in rows])]
    want = [(i, f - 2**64 if f >= 2**63 else f, c) for (i, _), f, c in zip(rows, fps, named, strict=True)]
    assert got == sorted(want, key=repr)


@pytest.mark.parametrize(("small", "wide", "tile"), [(64, 4_096, 50_000), (2, 4_096, 50_000), (64, 1, 50_000), (2, 4, 50_000), (2, 4, 20)])
def test_links_join_all_that_hang_together(spark, tmp_path, monkeypatch, small, wide, tile):
    """Dense clusters, chains and strangers; with small groups, spanning groups, groups that fall apart by blocks, and tiled groups."""
    monkeypatch.setattr(simhash, "SMALL", small)
    monkeypatch.setattr(simhash, "WIDE", wide)
    monkeypatch.setattr(simhash, "TILE", tile)
    rnd = random.Random(6)
    fps = {rnd.getrandbits(64) for _ in range(200)}
    for centre in list(fps)[:3]:
        for _ in range(60):
            x = centre
            for b in rnd.sample(range(64), rnd.randint(1, 5)):
                x ^= 1 << b
            fps.add(x)
    fps = sorted(fps)
    df = spark.createDataFrame([(f - 2**64 if f >= 2**63 else f,) for f in fps], "fp long")
    links = simhash.links(df, str(tmp_path)).collect()
    assert all(((a ^ b) & (2**64 - 1)).bit_count() <= 4 for a, b in links)
    roots = {r["node"]: r["root"] for r in components(spark.createDataFrame(links, "a long, b long"), str(tmp_path), "c").collect()}
    signed = [f - 2**64 if f >= 2**63 else f for f in fps]
    mine = [roots.get(s, s) for s in signed]
    want = plain_components(fps, list(range(len(fps))))
    pairs = {}
    for a, b in zip(mine, want, strict=True):
        assert pairs.setdefault(a, b) == b
    assert len(pairs) == len(set(want))


def test_blocks_keep_every_link_of_a_variant(spark):
    """Two entries that link and share a variant agree in a block; the blocks of an entry are all its bits outside the segment."""
    rnd = random.Random(8)
    rows, want = [], []
    for n in range(600):
        fp = rnd.getrandbits(64)
        first, bits = simhash.SEGMENTS[n % 3]
        outside = [b for b in range(64) if not first <= b < first + bits]
        other = fp
        for b in rnd.sample(outside, 4):
            other ^= 1 << b
        for f in (fp, other):
            rows.append((n, f - 2**64 if f >= 2**63 else f, (first + rnd.randrange(bits)) << 22))
        turned = sum((fp >> ((first + bits + i) % 64) & 1) << i for i in range(64 - bits))
        want.append(turned)
    found = spark.createDataFrame(rows, "n int, fp long, key int").select("n", "fp", simhash._blocks(5).alias("b")).collect()
    by = {}
    for r in found:
        by.setdefault(r["n"], []).append(set(r["b"]))
    assert all(len(x) == 5 and len(y) == 5 and x & y for x, y in by.values())
    first_of = {r["n"]: r["b"] for r in reversed(found)}
    for n, turned in enumerate(want):
        width = 64 - simhash.SEGMENTS[n % 3][1]
        cuts = [width * k // 5 for k in range(6)]
        assert first_of[n] == [(k + 1 << 44) + (turned >> a & (1 << b - a) - 1) for k, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False))]


def test_segments_cover_all_bits_and_find_any_four():
    assert sorted(b for first, bits in simhash.SEGMENTS for b in range(first, first + bits)) == list(range(64))
    rnd = random.Random(7)
    x = np.array([sum(1 << b for b in rnd.sample(range(64), rnd.randint(0, 4))) for _ in range(5000)], dtype=np.uint64)
    assert (simhash._first_shared(x) < 64).all()


def test_simhash_keeps_one_of_each(docs):
    df = docs([(3, "a b c d e f g h"), (2, "A B c d e f g h"), (9, "something else entirely here now"), (9, "something else entirely here now"), (4, None), (5, "")])
    got = simhash.one_of_each(df)
    assert got.columns == df.columns and sorted(r["doc_id"] for r in got.collect()) == [2, 4, 9]


def test_simhash_keeps_one_of_each_where_ids_repeat(docs):
    """Nulls, and one doc_id with two texts: a row of every component stays, and one only."""
    rows = [
        (None, "a b c d e f g h"), (3, "A B c d e f g h"),  # a null id linked with an id
        (None, "clean text of its own without any id"), (None, "another clean text that has no id"), (None, "another clean text that has no id"),
        (9, "the least of its component has two texts"), (12, "The Least of its component has two texts"), (9, "a B C d e f g h"),
        (20, "one id two cases of a text"), (20, "ONE ID two cases of a text"), (30, None), (30, ""),
    ]
    got = simhash.one_of_each(docs(rows))
    found = sorted(((r["doc_id"] or 0), (r["text"] or "").lower()) for r in got.collect())
    want = [(0, "another clean text that has no id"), (0, "clean text of its own without any id"), (3, "a b c d e f g h"), (9, "the least of its component has two texts"), (20, "one id two cases of a text"), (30, "")]
    assert found == want and simhash.one_of_each(docs([])).count() == 0


def test_components_of_a_long_chain_and_a_star(spark, tmp_path):
    edges = [(i, i + 1) for i in range(100)] + [(1000, 2000 + i) for i in range(300)] + [(5, 5)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "a long, b long").repartition(4), str(tmp_path)).collect()}
    assert all(got[i] == 0 for i in range(1, 101)) and all(got[2000 + i] == 1000 for i in range(300))
    assert components(spark.createDataFrame([], "a long, b long"), str(tmp_path), "none").count() == 0


WHOLE, QUARTER = ("CJK UNIFIED", "HIRAGANA LETTER", "KATAKANA LETTER", "KATAKANA-HIRAGANA"), ("THAI CHARACTER", "LAO ", "KHMER ", "MYANMAR ")


def plain_words(text):
    """Words with their places; letters of scripts without spaces are words of their own, by the names of the letters."""
    out = []
    for i, c in enumerate(text):
        name, mark = unicodedata.name(c, ""), unicodedata.category(c)[0] == "M"
        own = name.startswith(WHOLE + QUARTER) and unicodedata.category(c)[0] in "LM"
        if c.isspace():
            continue
        begins = not out or out[-1][1] != i or (own and not mark) or (out[-1][2] and not mark)
        if begins:
            out.append([i, i + 1, own])
        else:
            out[-1][1] = i + 1
    return [(text[a:b], a) for a, b, _ in out]


def plain_weight(words):
    return sum(0.25 if unicodedata.name(w[0], "").startswith(QUARTER) else 1 for w in words)


def plain_sentences(text):
    """By the docstring, letter by letter."""
    ends = ".!?\n" + "。．｡！？‼⁇⁈⁉؟۔।॥።፧၊။។៕"
    text, out, i = text or "", [], 0
    while i < len(text):
        j = i
        while j < len(text) and text[j] not in ends:
            j += 1
        if j < len(text):
            while j < len(text) and text[j] in ends:
                j += 1
            while j < len(text) and text[j].isspace():
                j += 1
        out.append(text[i:j])
        i = j
    cut = []
    for s in out:
        words = [w for w, _ in plain_words(s)]
        if len(words) <= 12:
            cut.append(s)
            continue
        hashes = [zlib.crc32(w.lower().encode()) for w in words]
        after = {min(range(k, k + 12), key=lambda x: (hashes[x], x)) for k in range(len(words) - 11)}
        places, start = [i for _, i in plain_words(s)], 0
        for k in range(len(words)):
            if k in after and k + 1 < len(words):
                end = places[k + 1]
                cut.append(s[start:end])
                start = end
        cut.append(s[start:])
    return cut


def plain_spans(parts):
    words = [[w for w, _ in plain_words(p.lower())] for p in parts]
    used = [i for i, w in enumerate(words) if w]
    out = []
    for s in range(len(used)):
        e = s
        while e < len(used) and (e - s < 3 or sum(plain_weight(words[i]) for i in used[s:e]) < 20):
            e += 1
        if e - s >= 3 and sum(plain_weight(words[i]) for i in used[s:e]) >= 20:
            out.append((used[s], used[e - 1], tuple(tuple(words[i]) for i in used[s:e])))
    return out


def plain_substrings(rows):
    at = lambda i, t: (-(2**63) if i is None else i, signed_hash(t))
    first = {}
    for i, t in rows:
        for a, _, k in plain_spans(plain_sentences(t)):
            first[k] = min(first.get(k, ((1 << 63, 0), 0)), (at(i, t), a))
    out = []
    for i, t in rows:
        parts, gone = plain_sentences(t), set()
        for a, b, k in plain_spans(parts):
            if first[k] != (at(i, t), a):
                gone.update(range(a, b + 1))
        out.append((i, len(gone), "".join(p for j, p in enumerate(parts) if j not in gone)))
    return out


NO_ID_COPIES = [(i, t + extra) for i, extra in ((None, ""), (None, " One more."), (None, " Two more, too."), (5, " three"), (5, " four")) for t in ["A first sentence of some words here. " + "Then a second one of as many words. " + "The third one ends the passage, at last, with more words than it needs."]]


def unspaced(seed):
    """Texts of scripts that set no spaces, with copies, shared passages, and other scripts among them."""
    rnd = random.Random(seed)
    letters = {"han": "的一是不了人我在有他這為之大來以個中上們", "kana": "あいうえおかきくけこサシスセソタチツテトー", "thai": "กขคงจฉชซดตถทนบปผพฟมยรลวสห", "lao": "ກຂຄງຈສຊຍດຕຖທນບປຜຝພຟມ"}
    rows = []
    for kind, alphabet in letters.items():
        say = lambda n, a=alphabet, k=kind: "".join(rnd.choice(a) + (rnd.choice(["", "่", "ี"]) if k == "thai" else "") + rnd.choice([""] * 25 + ["。", "！", "\n", " "]) for _ in range(n))
        passage, whole = say(260), say(600)
        rows += [(len(rows), whole), (len(rows) + 1, whole), (len(rows) + 2, say(90) + passage + say(80)), (len(rows) + 3, say(70) + " mixed words, and more. " + passage + say(60)), (len(rows) + 4, say(300))]
    return rows


@pytest.mark.parametrize("rows", [ODD, corpus(8), NO_ID_COPIES, unspaced(1), []])
def test_substrings(docs, rows):
    got = substring_dedup.without_repeated_spans(docs(rows)).select("doc_id", "n_removed", "kept_text").collect()
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, plain_substrings(rows)))


def test_long_passages_are_caught_wherever_they_stand(docs):
    rnd = random.Random(9)
    word = lambda: "".join(rnd.choice("abcdefghijklmnop") for _ in range(6))
    for passage in (" ".join(word() for _ in range(60)), ". ".join(" ".join(word() for _ in range(20)) for _ in range(3)) + ".", " ".join(word() + "." for _ in range(55))):
        rows = [(i, " ".join(word() for _ in range(rnd.randint(5, 30))) + rnd.choice([" ", "\n", ". "]) + passage + rnd.choice([" ", "\n"]) + " ".join(word() for _ in range(20))) for i in range(4)]
        got = {r["doc_id"]: r for r in substring_dedup.without_repeated_spans(docs(rows)).collect()}
        assert got[0]["n_removed"] == 0 and got[0]["kept_text"] == rows[0][1]
        assert all(got[i]["n_words_removed"] >= 25 for i in (1, 2, 3)), passage[:40]


def test_copies_and_passages_without_spaces_are_caught(docs):
    rows = unspaced(2)
    got = {r["doc_id"]: r for r in substring_dedup.without_repeated_spans(docs(rows)).collect()}
    for k in range(0, len(rows), 5):
        assert got[k]["n_removed"] == got[k + 2]["n_removed"] == got[k + 4]["n_removed"] == 0
        assert len(got[k + 1]["kept_text"]) < 0.05 * len(rows[k + 1][1])  # a copy of the text before
        assert got[k + 3]["n_words_removed"] > 200 and "mixed words" in got[k + 3]["kept_text"]
    short = [(1, "短い文。次の文。三つ目。"), (2, "短い文。次の文。三つ目。")]  # under 20 words, as with spaces
    assert all(r["n_removed"] == 0 for r in substring_dedup.without_repeated_spans(docs(short)).collect())


def test_no_passage_of_51_words_is_missed(docs):
    """400 passages, with and without full stops, at the start of a sentence and inside one, each in two documents."""
    rnd = random.Random(11)
    word = lambda: "".join(rnd.choice("abcdefghijklmnop") for _ in range(rnd.randint(2, 8)))
    rows, share = [], []
    for k in range(400):
        stops = rnd.choice([0, 0.08, 0.2])
        passage = " ".join(word() + ("." if rnd.random() < stops else "") for _ in range(51))
        for half in range(2):
            around = [" ".join(word() for _ in range(rnd.randint(0, 30))) for _ in range(2)]
            rows.append((2 * k + half, around[0] + rnd.choice([" ", ". ", "\n"]) + passage + rnd.choice([" ", "\n"]) + around[1]))
    got = {r["doc_id"]: r["n_words_removed"] for r in substring_dedup.without_repeated_spans(docs(rows)).collect()}
    share = [got[2 * k + 1] for k in range(400)]
    assert min(share) >= 20 and sum(share) / 400 > 0.8 * 51 and all(got[2 * k] == 0 for k in range(400))


def test_sentences_by_definition():
    texts = [t for _, t in corpus(12, 60) + unspaced(3)] + [" ".join(random.Random(k).choice("abcdefg") * 2 for _ in range(40 * k)) + ("." if k % 2 else "") for k in range(12)] + [None, "", " ", "a. " * 50]
    assert substring_dedup.sentences(texts) == [plain_sentences(t) for t in texts]


def test_full_bitmap_changes_nothing(docs, monkeypatch):
    from rosterweave.llm import common

    rows = corpus(8)
    want = sorted(map(tuple, substring_dedup.without_repeated_spans(docs(rows)).collect()))
    monkeypatch.setattr(common, "BITMAP_BITS", 6)
    assert sorted(map(tuple, substring_dedup.without_repeated_spans(docs(rows)).collect())) == want


def test_sentences_lose_nothing():
    rnd = random.Random(10)
    for _ in range(300):
        t = "".join(rnd.choice("ab .!?\n\t\x0bÉ　x") for _ in range(rnd.randint(0, 200)))
        assert "".join(substring_dedup.sentences([t])[0]) == t


def test_queries_on_the_small_tables(spark):
    from rosterweave.llm import registry

    for name in ("op2_exact_dedup", "op3_line_dedup", "op4_simhash", "op10_substring_dedup"):
        df = registry.queries()[name](spark, SF)
        assert df.count() == 200 and df.columns[0] == "doc_id"
