"""Operators 1, 5, 6, 7, 8 and 9: against plain versions, exact round trips, held-out accuracy."""

import hashlib
import random
import re
import time
import zlib

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from rosterweave.llm import bpe, langid, lm_scoring, quality_classifier, quality_rules, registry, source_mix
from tests.conftest import SF
from tests.llm.cases import ODD

MIDDLE = "/root/testdata/sf0.01"


# --- SQL ---


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{SF}/documents.parquet')")
    df, sql = registry.queries()[name](spark, SF), con.sql(registry.oracle_sql()[name])
    order = sorted(df.columns)
    assert order == sorted(sql.columns)
    mine = sorted(repr(tuple(round(r[c], 9) if isinstance(r[c], float) else r[c] for c in order)) for r in df.collect())
    theirs = sorted(repr(tuple(round(v, 9) if isinstance(v, float) else v for v in r)) for r in sql.select(*order).fetchall())
    assert mine == theirs


# --- 1 ---


def test_languages_on_held_out_documents(spark):
    docs = spark.read.parquet(f"{MIDDLE}/documents.parquet")
    got = langid.identified(docs, langid.fitted(docs)).join(docs.select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in got if r["held_out"]]
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in got)
    assert sum(r["lang_pred"] == r["lang"] for r in held) / len(held) > 0.97 and all(0 <= r["score"] <= 1 for r in got)


def test_language_of_odd_texts(docs):
    df = docs([*ODD, (20, "1234 -- 5678"), (21, "½ ² Ⅷ")])
    got = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in langid.identified(df, langid.fitted(df)).collect()}
    assert got[1] == got[2] == got[3] == got[9] == got[20] == got[21] == ("und", 0.0) and got[7][0] == "en" and len(got) == len({i for i, _ in ODD}) + 2
    empty = docs([])
    assert langid.identified(empty, langid.fitted(empty)).count() == 0 and {r["lang_pred"] for r in langid.identified(df, langid.fitted(empty)).collect()} == {"und"}


def test_sample_of_languages_is_bounded(spark, docs, monkeypatch):
    """By texts, not by ids: many rows without an id, and more languages than the sample holds."""
    seen = []
    monkeypatch.setattr(langid.Hierarchy, "fit", classmethod(lambda cls, x, langs: seen.append(list(langs)) or cls()))
    rows = spark.range(3000).select(F.lit(None).cast("long").alias("doc_id"), F.concat(F.lit("text number "), F.col("id").cast("string"), F.lit(" of many")).alias("text"), F.lit("en").alias("lang"))
    langid.fitted(rows.unionByName(rows), per_language=10)
    langid.fitted(rows.withColumn("lang", F.concat(F.lit("l"), F.expr("substring(text, 13, 3)"))), sample=500)
    assert seen[0] == ["en"] * 10 and 400 < len(set(seen[1])) <= len(seen[1]) <= 500


def test_a_thousand_languages(docs, spark):
    rows = spark.range(3000).select("id", F.concat(F.lit("word "), F.col("id").cast("string")).alias("text"), F.concat(F.lit("l"), (F.col("id") % 1000).cast("string")).alias("lang")).withColumnRenamed("id", "doc_id")
    model = langid.fitted(rows, sample=60)
    assert len(model.languages) == 60 == len(model.families)


def test_ties_of_languages():
    """Nothing tells the languages apart: the first family, then the first language."""
    flat = langid.Hierarchy(["de", "en", "fr"], ["germanic", "romance"], [("de", "en")], np.zeros((langid.DIMENSIONS, 3), np.float32), np.zeros(3))
    assert flat.predict("any text")[0] == "de"


def test_family_comes_first_and_pairs_follow():
    rnd = random.Random(1)
    letters = {"en": "abcde", "de": "abcdf", "fr": "uvwxy", "es": "uvwxz", "xx": "mnopq"}
    text = lambda lang: " ".join("".join(rnd.choice(letters[lang]) for _ in range(5)) for _ in range(30))
    data = [(lang, text(lang)) for lang in letters for _ in range(40)]
    model = langid.Hierarchy.fit(np.array([langid.counts(t) for _, t in data]), [lang for lang, _ in data])
    assert model.families == ["germanic", "romance", "xx"] and model.pairs == [("de", "en"), ("es", "fr")]
    assert all(model.predict(text(lang))[0] == lang for lang in letters for _ in range(20))


def test_whole_texts_count():
    """The end of a long text weighs as much as its start."""
    assert not np.array_equal(langid.counts("a " * 3_000_000 + "b" * 3_000_000), langid.counts("a " * 3_000_000))


# --- 5 ---


def plain_targets(sizes, weights=(1, 2, 3), most=3):
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    total, full = sum(sizes.values()), set()
    while True:
        rest = sum(w[s] for s in order if s not in full)
        level = (total - sum(most * sizes[s] for s in full)) / rest if rest else 0
        new = {s for s in order if s not in full and most * sizes[s] <= level * w[s]}
        if not new:
            return {s: float(most * sizes[s]) if s in full else level * w[s] for s in order}
        full |= new


@pytest.mark.parametrize("seed", range(4))
def test_targets(docs, seed):
    rnd = random.Random(seed)
    names = [None, "", "é", "z", "A", "a", "😀", "﷽", *(f"s{i}" for i in range(rnd.randint(0, 20)))]
    rows = [(i, "w " * int(10 ** rnd.uniform(0, 3)) if rnd.random() > 0.1 else None, rnd.choice(names)) for i in range(200)]
    got = source_mix.mixed(docs(rows)).collect()
    sizes = {}
    for _, t, s in rows:
        sizes[s] = sizes.get(s, 0) + len((t or "").split())
    want, by_id = plain_targets(sizes), {i: (t, s) for i, t, s in rows}
    for r in got:
        t, s = by_id[r["doc_id"]]
        assert r["size"] == len((t or "").split()) and r["source_size"] == sizes[s] and r["target"] == pytest.approx(want[s]) and 0 <= r["copies"] <= 3
    digits = lambda what: int(hashlib.md5(f"mix:{what}".encode()).hexdigest()[:13], 16)
    for s, size in sizes.items():
        own = sorted((r for r in got if by_id[r["doc_id"]][1] == s), key=lambda r: digits(r["doc_id"]))
        rate, at, taken = want[s] / size if size else 0, 0, 0
        begin = int(digits("" if s is None else f"source {s}") / 2**52 * size)
        wide = round((rate - int(rate)) * size)
        for r in own:
            inside = rate > int(rate) and (2 * at + r["size"] - 2 * begin) % (2 * size) < 2 * wide
            if r["size"]:
                assert r["copies"] == int(rate) + inside
            at, taken = at + r["size"], taken + r["size"] * r["copies"]
        assert abs(taken - want[s]) <= max([r["size"] for r in own]) + 1
    assert sorted(map(tuple, got)) == sorted(map(tuple, source_mix.mixed(docs(rows, parts=7)).collect()))


def test_mix_of_odd_tables(docs, monkeypatch):
    df = docs(ODD)
    got = source_mix.emitted(df)
    assert got.columns == df.columns and got.count() > 0 and set(got.select("size").distinct().collect()[0]) == {"x"}
    assert source_mix.mixed(docs([])).count() == 0 and source_mix.mixed(docs([(1, None), (2, "")])).filter("copies > 0").count() == 0
    before = sorted(map(repr, map(tuple, source_mix.mixed(df).collect())))
    monkeypatch.setattr(source_mix, "SOURCES_BROADCAST", 0)  # the way for very many sources
    assert sorted(map(repr, map(tuple, source_mix.mixed(df).collect()))) == before


@pytest.mark.parametrize("folder", [MIDDLE, "/root/testdata/sf0.1"])
def test_mix_comes_near_its_targets(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    got = source_mix.mixed(docs).join(docs.select("doc_id", "source"), "doc_id").groupBy("source").agg(F.sum(F.col("size") * F.col("copies")).alias("taken"), F.first("target").alias("target"), F.max("size").alias("longest"))
    for r in got.collect():
        assert abs(r["taken"] - r["target"]) <= r["longest"] + 1 and 0.9 < r["taken"] / r["target"] < 1.1


def test_each_documents_chance_is_the_fraction():
    """By the rule that test_targets holds the operator to: over many seeds a document of a third of its source's words is taken as often as others."""
    sizes, times = [50] + [5] * 20, [0] * 21
    total, wide = sum(sizes), round(0.4 * sum(sizes))
    for seed in range(2000):
        digits = lambda what: int(hashlib.md5(f"{seed}:{what}".encode()).hexdigest()[:13], 16)  # noqa: B023, E731
        at, begin = 0, int(digits("source s") / 2**52 * total)
        for i in sorted(range(21), key=digits):
            times[i] += (2 * at + sizes[i] - 2 * begin) % (2 * total) < 2 * wide
            at += sizes[i]
    assert all(abs(t / 2000 - 0.4) < 0.05 for t in times)


# --- 6 ---


def plain_measures(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = {}
    for i in range(len(words) - 4):
        windows.setdefault(tuple(words[i : i + 5]), []).append(i)
    covered = {j for at in windows.values() if len(at) > 1 for i in at for j in range(i, i + 5)}
    lines, dup, seen = text.split("\n"), 0, set()
    for line in lines:
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered)


def test_measures(docs):
    rnd = random.Random(2)
    rows = ODD + [(100 + i, "".join(rnd.choice(["a ", "b ", "c d ", "\n", "#x ", "a b c d e ", "\x0b", "é "]) for _ in range(rnd.randint(0, 80)))) for i in range(150)]
    got = quality_rules.apply_policy(quality_rules.ledger(docs(rows))).collect()
    want = sorted(((i, *plain_measures(t)) for i, t in rows), key=repr)
    assert sorted(((r["doc_id"], r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) for r in got), key=repr) == want
    for r in got:
        assert r["base_failed"] == (r["n_words"] < 10 or 100 * r["n_repeat_words"] > 20 * r["n_words"]) and not (r["base_failed"] and r["kept"])
    assert quality_rules.ledger(docs([])).count() == 0


def test_measures_agree_with_sql_on_any_letters(spark, docs):
    """No-break spaces, title case, Roman numerals, marks, and very long texts."""
    rnd = random.Random(7)
    letters = ["a", "B ", "\u00a0", "\u2003", "\u01c5", "\u2167", "\u24b6", "e\u0301", "\u4e00", " ", "\n", "x. ", "(Q)", "\U0001d400", "\u00aa ", "7 ", "\x1c", "\x85", "\u0130 "]
    rows = [r for r in ODD if r[0] is not None and r[0] != 4] + [(100 + i, "".join(rnd.choice(letters) for _ in range(rnd.randint(0, 200)))) for i in range(200)] + [(400, "Word and WORD\u00a0too " * 20_000)]
    got = quality_rules.apply_policy(quality_rules.ledger(docs(rows))).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "failed")
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", rows)
    want = con.sql(quality_rules.ORACLE).select(*got.columns).fetchall()
    assert sorted(map(tuple, got.collect())) == sorted(want)


def test_ledger_ablations_agree_with_the_rules(spark):
    book = quality_rules.ledger(spark.read.parquet(f"{MIDDLE}/documents.parquet")).cache()
    found = {r["rule"]: (r["failed_docs"], r["decided_docs"]) for r in quality_rules.ablations(book).collect()}
    bits = {r.name: r.bit for r in quality_rules.rules()}
    whole = quality_rules.mask(list(quality_rules.POLICIES["web-1"]))
    failed = [r["failed"] & whole for r in book.select("failed").collect()]
    for name, (n, alone) in found.items():
        assert n == sum(f >> bits[name] & 1 for f in failed) and alone == sum(f == 1 << bits[name] for f in failed)
    labels = spark.read.parquet(f"{MIDDLE}/labels.parquet")
    kept = quality_rules.apply_policy(book).join(labels, "doc_id").groupBy("quality").agg(F.avg(F.col("kept").cast("int")).alias("share"))
    assert {r["quality"]: r["share"] for r in kept.collect()}[0] < 0.05 < 0.95 < {r["quality"]: r["share"] for r in kept.collect()}[1]


# --- 7 ---


@pytest.fixture(scope="module")
def library():
    tokenizers, public = pytest.importorskip("tokenizers"), pytest.importorskip("public_tokenizers")
    return tokenizers.Tokenizer.from_file(public.path("byte_bpe_50k.json"))


def test_bpe_agrees_with_the_library(docs, library):
    rnd = random.Random(3)
    letters = ["ab cde\n tionsh'ßé漢.!0", "etaoin shrdlu", "".join(map(chr, range(1, 300)))]
    rows = [*ODD, (20, "<|endoftext|>a<|endoftext|> <|endoftex"), (21, "'s 'S it's   \n\n x"), (22, "🎉" * 50)]
    rows += [(100 + i, "".join(rnd.choice(rnd.choice(letters)) for _ in range(rnd.randint(1, 80)))) for i in range(300)]
    got = bpe.encoded(docs(rows), with_ids=True).collect()
    want = []
    for i, t in rows:
        ids = library.encode(t or "", add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        want.append((i, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest(), ids, decoded))
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want))
    assert bpe.encoded(docs([])).count() == 0


def test_bpe_forgets_and_still_agrees(library):
    from pathlib import Path

    own = bpe.TrieBpe(Path(bpe.default_path()).read_text(encoding="utf-8"), max_nodes=50, max_words=20)
    texts = [f"some words number {i} and interesting things {i * 7919}" for i in range(200)]
    assert all(np.frombuffer(own.encode(t), "<u4").tolist() == library.encode(t, add_special_tokens=False).ids and own.decode(own.encode(t)) == t for t in texts)


# --- 8 ---


def lm_vocabulary(*words):
    return lm_scoring.Vocabulary([w.encode() for w in words], [9 - i for i in range(len(words))])


def lm_odd_net(vocab, seed=4):
    net = lm_scoring.WindowNet.new(vocab, seed)
    rng = np.random.default_rng(seed)
    for p in net.parts():
        p += rng.normal(size=p.shape).astype(np.float32) * 0.3
    return net


def lm_chance(net, near, own):
    """P(group) * P(word in its group), written out in double precision."""
    h = np.tanh(sum(net.tables[k, net.near[x]].astype(np.float64) for k, x in enumerate(near)))
    share = lambda s: np.exp(s - s.max()) / np.exp(s - s.max()).sum()
    g, m = divmod(own - 1, lm_scoring.MEMBERS)
    return share(h @ net.group + net.group_bias)[g] * share(h @ net.member[g] + net.member_bias[g])[m]


def test_lm_beats_word_shares_on_held_out_documents(spark):
    """Held-out documents, the same vocabulary: over half a nat a word better than the untrained network, which gives each word's share."""
    docs = spark.read.parquet(f"{MIDDLE}/documents.parquet")
    held = F.crc32(F.col("text").cast("binary")) % 4 == 1
    vocab, rest = lm_scoring.vocabulary(docs.filter(~held))
    assert vocab.size() > 250_000 and len(vocab.words) == lm_scoring.WORDS
    test, train = lm_scoring.tokenized(docs.filter(held), vocab), lm_scoring.tokenized(docs.filter(~held), vocab)
    mean = lambda net: (lambda r: r[0] / r[1])(lm_scoring.scored(test, vocab, rest, net).agg(F.sum("log_prob"), F.sum("n_tokens")).first())
    assert mean(lm_scoring.trained(train, vocab)) > mean(lm_scoring.WindowNet.new(vocab)) + 0.5


def test_lm_untrained_gives_shares():
    vocab = lm_vocabulary("a", "b", "c")
    net = lm_scoring.WindowNet.new(vocab)
    got = np.exp(net.log_probs(lm_scoring.padded([np.array([1, 2, 3], np.uint16)])))
    want = np.array([9.5, 8.5, 7.5]) / (24 + lm_scoring.LEAVES * 0.5)
    assert got == pytest.approx(want, rel=1e-4)


def test_lm_scores_by_definition():
    vocab = lm_vocabulary("a", "b")
    net = lm_odd_net(vocab)
    documents = lm_scoring.Lookup(vocab).tokens(["a b, C a zz b " * 3, "", "b"])
    want = []
    for t in documents:
        at = [0, 0, *map(int, t), 0, 0]
        want += [np.log(lm_chance(net, [at[i - 2], at[i - 1], at[i + 1], at[i + 2]], at[i])) for i in range(2, len(at) - 2)]
    assert net.log_probs(lm_scoring.padded(documents)) == pytest.approx(want, rel=1e-3)
    assert sum(lm_chance(net, [0, 1, 2, 0], x) for x in range(1, lm_scoring.LEAVES + 1)) == pytest.approx(1)


def test_lm_steps_by_definition():
    """A step of training against slopes by differences."""
    net, rng = lm_odd_net(lm_vocabulary("a", "b")), np.random.default_rng(1)
    near, own = [rng.integers(0, 40, 30) for _ in range(4)], rng.integers(0, lm_scoring.LEAVES, 30)
    loss = lambda: -sum(np.log(lm_chance(net, [x[i] for x in near], own[i] + 1)) for i in range(30))
    g, m = divmod(int(own[0]), lm_scoring.MEMBERS)
    places = [(0, (1, net.near[near[1][0]], 3)), (1, (5, g)), (2, (g, 7, m)), (3, (g,)), (4, (g, m))]
    slopes, was = [], net.flat()
    for part, at in places:
        p = net.parts()[part]
        old = p[at]
        p[at] = old + 1e-2
        up = loss()
        p[at] = old - 1e-2
        slopes.append((up - loss()) / (float(np.float32(old + 1e-2)) - float(np.float32(old - 1e-2))))
        p[at] = old
    assert np.array_equal(was, net.flat())
    before = [net.parts()[part][at] for part, at in places]
    net.step([net.near[x] for x in near], own, [np.full(p.shape, 0.01, np.float32) for p in net.parts()])
    for (part, at), old, d in zip(places, before, slopes, strict=True):
        assert net.parts()[part][at] == pytest.approx(old - lm_scoring.RATE * d / np.sqrt(0.01 + d * d), abs=2e-3)


def test_lm_of_odd_tables(docs):
    df = docs(ODD)
    vocab, rest = lm_scoring.vocabulary(df)
    tokens = lm_scoring.tokenized(df, vocab)
    got = {r["doc_id"]: r for r in lm_scoring.scored(tokens, vocab, rest, lm_scoring.trained(tokens, vocab)).collect()}
    assert got[1]["log_prob"] == got[2]["log_prob"] == 0.0 and got[7]["n_tokens"] == 60_000 and got[7]["log_prob"] < 0
    empty = docs([])
    v, none = lm_scoring.vocabulary(empty)
    tokens = lm_scoring.tokenized(empty, v)
    assert v.words == [] and lm_scoring.scored(tokens, v, none, lm_scoring.trained(tokens, v)).count() == 0


@pytest.mark.parametrize("held", [200_000, 3])
def test_lm_tells_rare_words_apart(docs, monkeypatch, held):
    """Each position gets log P(class) and log P(word | class), whether tasks hold the word's count or a table is joined."""
    monkeypatch.setattr(lm_scoring, "HELD", held)
    top = " ".join(["the", "on", *(f"top{i}" for i in range(lm_scoring.WORDS - 2))])
    rows = [(0, " ".join([top] * 9)), (1, "the cat sat, the rat sat on the mat -- a bat"), (2, "the the sat sat nation station station ration"), (None, "on a mat at a mat"), (None, "on a mat at a mat"), (4, None)]
    df = docs(rows)
    vocab, rest = lm_scoring.vocabulary(df)
    net = lm_scoring.WindowNet.new(vocab)
    assert vocab.whole == (held != 3) and {w.decode() for w in vocab.words} == set(top.split())
    n = {}
    for _, t in rows:
        for w in map(lm_scoring.bare_word, lm_scoring.raw_words(t)):
            n[w] = n.get(w, 0) + 1
    assert vocab.size() == sum(n.values())
    for w in vocab.words:
        n.pop(w)
    class_of = lambda w: zlib.crc32(w[-2:]) % lm_scoring.CLASSES

    def within(w):
        if w in vocab.known:
            return 0.0
        own = {k: v for k, v in n.items() if class_of(k) == class_of(w)}
        all_of = sum(own.values()) + len(own) + 1
        return np.log(own[w] / all_of) if w in own else np.log((len(own) + 1) / all_of) - (len(w) + 1) * np.log(257)

    more = [(10, "the cat station"), (11, "the cat qqqqtion"), (12, "the cat zzzzzzzzzzztion")]
    got = lm_scoring.scored(lm_scoring.tokenized(docs(rows + more), vocab), vocab, rest, net).collect()
    look = lm_scoring.Lookup(vocab)
    score = lambda t: float(net.log_probs(lm_scoring.padded(look.tokens([t]))).sum(dtype=float)) if t else 0.0
    want = sorted(((i, score(t) + sum(within(lm_scoring.bare_word(w)) for w in lm_scoring.raw_words(t))) for i, t in rows + more), key=repr)
    found = sorted(((r["doc_id"], r["log_prob"]) for r in got), key=repr)
    assert [i for i, _ in found] == [i for i, _ in want] and [s for _, s in found] == pytest.approx([s for _, s in want], rel=1e-5)
    at = {r["doc_id"]: r["log_prob"] for r in got}
    assert at[10] > at[11] > at[12]
    for c in range(lm_scoring.CLASSES):
        assert sum(np.exp(within(w)) for w in n if class_of(w) == c) < 1


def test_lm_words_in_bulk_are_those_of_single_texts():
    """Also at every ASCII control character, empty texts, punctuation alone, and cut in slices."""
    rnd = random.Random(8)
    letters = "".join(map(chr, range(128))) * 2 + " " * 60 + "\x85\xa0é漢🎉İß\u3000"
    texts = ["", None, " \t\n", "-- ... a", "a A. ..a", "é", *("".join(rnd.choices(letters, k=rnd.randint(0, 90))) for _ in range(400))]
    want = [[lm_scoring.bare_word(w) for w in lm_scoring.raw_words(t)] for t in texts]
    n, number, bare = lm_scoring.split(pa.array(texts, pa.string()))
    words = [w.encode() for w in bare.to_pylist()]
    assert n.tolist() == list(map(len, want)) and [words[i] for i in number] == [w for t in want for w in t] and len(set(words)) == len(words)
    assert lm_scoring.classes_of(bare).tolist() == list(map(lm_scoring.class_of, words))
    assert lm_scoring.classes_of(bare[3:]).tolist() == list(map(lm_scoring.class_of, words[3:]))


def test_lm_batches_are_sliced_by_bytes(monkeypatch):
    monkeypatch.setattr(lm_scoring, "_SLICE", 10)
    batches = [pa.RecordBatch.from_arrays([pa.array(t, pa.string())], names=["t"]) for t in (["a" * 4, None, "b" * 6, "c", "d" * 30, ""], [], ["e"])]
    assert [b.column(0).to_pylist() for b in lm_scoring.slices(iter(batches), 0)] == [["aaaa", None, "bbbbbb"], ["c"], ["d" * 30], [""], ["e"]]


def test_lm_words_cost_no_python_step_each():
    """A million words to tokens in less than two thirds of the time that splitting them and looking each up in a dict takes."""
    rnd = random.Random(9)
    words = [f"w{i}" for i in range(150_000)]
    texts = [" ".join(rnd.choices(words, k=500)) for _ in range(2000)]
    vocab = lm_vocabulary(*words[: lm_scoring.WORDS])

    def plain():
        numbers = {}
        for t in texts:
            for w in lm_scoring.raw_words(t):
                numbers.setdefault(w, len(numbers))

    def seconds(f):
        start = time.process_time()
        f()
        return time.process_time() - start

    ours, theirs = (min(seconds(f) for _ in range(3)) for f in (lambda: lm_scoring.Lookup(vocab).tokens(texts), plain))
    assert ours < theirs * 2 / 3


@pytest.mark.parametrize("part", [2_000_000, 40])
def test_lm_trains_on_every_position(docs, monkeypatch, part):
    """Each position of each document once, also of short ones and of those without an id; parts do not depend on partitions."""
    monkeypatch.setattr(lm_scoring, "PART", part)
    rows = [(None, "a"), (None, "b c"), (1, "a b"), (2, "c " * 100), (3, ""), (4, None), *((10 + i, "a b c d") for i in range(50))]
    df = docs(rows)
    vocab, _ = lm_scoring.vocabulary(df)
    tables = [sorted(tuple(map(bytes, (repr(r[:3]).encode(), r["tokens"]))) for r in lm_scoring.parts_table(lm_scoring.tokenized(docs(rows, n), vocab), vocab.size(), lm_scoring.shared_dir(df.sparkSession)).collect()) for n in (3, 7)]
    assert tables[0] == tables[1] and (len(tables[0]) > 8) == (part == 40)
    got = []
    for _, tokens in tables[0]:
        flat = np.frombuffer(tokens, np.uint16)
        got += [tuple(int(flat[i + o]) for o in (-2, -1, 0, 1, 2)) for i in np.flatnonzero(flat)]
    want = []
    for _, t in rows:
        at = [0, 0, *map(int, lm_scoring.Lookup(vocab).tokens([t])[0]), 0, 0]
        want += [tuple(at[i - 2 : i + 3]) for i in range(2, len(at) - 2)]
    assert sorted(got) == sorted(want) and len(got) == 305


def test_lm_scores_do_not_depend_on_partitions(docs, monkeypatch):
    monkeypatch.setattr(lm_scoring, "PART", 2000)
    rnd = random.Random(5)
    rows = [(i, " ".join(rnd.choice("abcdefgh") * rnd.randint(1, 2) for _ in range(rnd.randint(0, 60)))) for i in range(300)]
    found = []
    for parts in (2, 9):
        df = docs(rows, parts)
        vocab, rest = lm_scoring.vocabulary(df)
        tokens = lm_scoring.tokenized(df, vocab)
        found.append([r["log_prob"] for r in lm_scoring.scored(tokens, vocab, rest, lm_scoring.trained(tokens, vocab)).orderBy("doc_id").collect()])
    assert found[0] == pytest.approx(found[1], rel=1e-4)


# --- 9 ---


def test_grades_on_held_out_labels(spark):
    docs, labels = spark.read.parquet("/root/testdata/sf0.1/documents.parquet"), spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 1
    model = quality_classifier.fitted(docs, labels.filter(~held))
    got = quality_classifier.scored(docs, model).join(labels.filter(held), "doc_id").collect()
    share = lambda rows: sum(r["kept"] for r in rows) / max(1, len(rows))
    assert share([r for r in got if r["quality"] == 1 and not r["toxic"]]) > 0.95
    assert share([r for r in got if r["quality"] == 0]) < 0.05 and share([r for r in got if r["quality"] == 1 and r["toxic"]]) < 0.1
    assert all(0 <= r["expected_grade"] <= 2 and 0 <= r["tail_prob"] <= 1 for r in got) and model.thresholds[0] < model.thresholds[1] and model.weights.min() < 0 < model.weights.max()


def test_sample_of_labels_is_bounded(spark, monkeypatch):
    """Many labels of one id, and many documents of it: one teaches. Many ids: `per_grade` teach."""
    seen = []
    monkeypatch.setattr(quality_classifier.Ordinal, "fit", classmethod(lambda cls, rows, grades: seen.append(sorted(grades.tolist())) or cls(np.zeros(1 << quality_classifier.BITS), np.zeros(2))))
    text = F.concat(F.lit("text "), F.col("id").cast("string")).alias("text")
    docs = spark.range(2000).select(F.lit(5).cast("long").alias("doc_id"), text).unionByName(spark.range(10, 2000).select(F.col("id").alias("doc_id"), text))
    labels = spark.range(1000).select(F.lit(5).cast("long").alias("doc_id"), F.lit(1).alias("quality"), F.lit(0).alias("toxic"))
    quality_classifier.fitted(docs, labels, per_grade=100)
    quality_classifier.fitted(docs, labels.unionByName(spark.range(10, 2000).select(F.col("id").alias("doc_id"), F.lit(0).alias("quality"), F.lit(0).alias("toxic"))), per_grade=100)
    assert seen == [[2], [0] * 100 + [2]]


def test_fit_is_the_likeliest(spark):
    """Against a plain search over two features, without penalties that matter."""
    rnd = np.random.default_rng(3)
    rows, grades = [], []
    for _ in range(3000):
        a, b = rnd.random() < 0.5, rnd.random() < 0.5
        latent = 2.0 * a - 1.5 * b + rnd.logistic()
        rows.append(np.array([k for k, on in ((11, a), (22, b)) if on], dtype=np.int32))
        grades.append(int(latent > -1) + int(latent > 1))
    model = quality_classifier.Ordinal.fit(rows, np.array(grades))
    assert model.weights[11] == pytest.approx(2.0, abs=0.4) and model.weights[22] == pytest.approx(-1.5, abs=0.4)
    assert (model.thresholds - np.array([-1, 1])).tolist() == pytest.approx([0, 0], abs=0.6)


def test_ties_keep_a_document():
    model = quality_classifier.Ordinal(np.zeros(1 << quality_classifier.BITS), np.zeros(2))
    assert model.tails(np.array([], dtype=np.int32)).tolist() == [0.5, 0.5]


def test_features_survive_packing():
    few, many = np.array([0, 7, 2**18 - 1], dtype=np.int32), np.arange(0, 2**18, 3, dtype=np.int32)
    assert all(np.array_equal(quality_classifier._unpacked(quality_classifier._packed(x)), x) for x in (few, many, few[:0])) and len(quality_classifier._packed(many)) == 2**15


def test_grades_of_odd_tables(spark, docs):
    df = docs(ODD)
    labels = spark.createDataFrame([(1, None, 0), (4, 1, None), (99, 0, 0), (7, 0, 1), (7, 1, 1)], "doc_id long, quality int, toxic int")
    assert quality_classifier.scored(df, quality_classifier.fitted(df, labels)).count() == len(ODD)
    none = labels.filter("false")
    assert quality_classifier.scored(df, quality_classifier.fitted(df, none)).filter("not kept").count() == 0
    kept = quality_classifier.selected(df, none)
    assert kept.columns == df.columns and sorted(map(repr, map(tuple, kept.collect()))) == sorted(map(repr, map(tuple, df.collect())))
    assert quality_classifier.selected(docs([]), labels).count() == 0
