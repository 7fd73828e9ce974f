"""The pipeline: each stage against its operator in a plain form, then the whole."""

import hashlib
import re
import shutil

import pytest

import corpus_pipeline
from tests.conftest import SF
from tests.llm.cases import ODD
from tests.llm.test_dedup import plain_exact, plain_fingerprint, plain_components


@pytest.fixture
def folder(tmp_path):
    shutil.copy(f"{SF}/labels.parquet", tmp_path / "labels.parquet")
    shutil.copy(f"{SF}/documents.parquet", tmp_path / "documents.parquet")
    return str(tmp_path)


def test_stages(spark, folder, tmp_path):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    kept, stages = docs, dict(corpus_pipeline.STAGES)
    for n, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = kept
        stage(spark, kept, folder).write.parquet(str(tmp_path / f"out{n}"))
        kept = spark.read.parquet(str(tmp_path / f"out{n}"))
        rows = [(r["doc_id"], r["text"]) for r in before.select("doc_id", "text").collect()]
        ids = sorted(r["doc_id"] for r in kept.collect())
        if name != "bpe":
            assert kept.columns == docs.columns
        if name == "quality classifier":
            bad = {r["doc_id"] for r in spark.read.parquet(f"{folder}/labels.parquet").filter("quality = 0").collect()}
            assert set(ids) < {i for i, _ in rows} and len(bad & set(ids)) <= 1 and len(ids) > 0.5 * len(rows)
        elif name == "exact dedup":
            assert ids == sorted(i for i, keep, *_ in plain_exact(rows) if i == keep)
        elif name == "simhash near-dedup":
            fps = [plain_fingerprint(t) for _, t in rows]
            assert ids == sorted(set(plain_components(fps, [i for i, _ in rows])))
        elif name == "source mix":
            assert set(ids) <= {i for i, _ in rows} and max(map(ids.count, ids)) <= 3
        else:
            assert ids == sorted(i for i, _ in rows) and kept.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    assert len(stages) == 5
    whole = corpus_pipeline.run(spark, folder)
    assert sorted(map(tuple, whole.collect())) == sorted(map(tuple, kept.collect()))


@pytest.mark.parametrize("rows", [ODD, []])
def test_stages_stand_odd_tables(spark, docs, folder, rows):
    df = docs(rows)
    for name, stage in corpus_pipeline.STAGES:
        got = stage(spark, df, folder)
        assert name == "bpe" or got.columns == df.columns
        assert rows or got.count() == 0
        got.count()


MIXED_IDS = [
    (None, "one clean text that has no id at all"), (None, "another clean text that has no id either"), (None, "another clean text that has no id either"), (None, None), (None, ""),
    (4, "four has two texts and this is one"), (4, "Four has  two texts, here is another"), (4, "shared by many rows of the table"), (1, "shared by many rows  of the table"), (7, "SHARED by many rows of the table"),
    (9, "a very long text " * 3000), (9, "a very long text " * 3000), (2, "tie of length ab"), (3, "tie of length ab"),
]


def plain_stage(name, rows):
    """The rows that stay, of (doc_id, text)."""
    if name == "exact dedup":
        groups = {}
        for i, t in rows:
            groups.setdefault(re.sub(r"[\x20\x09-\x0D]", "", t or ""), []).append((-len(t or ""), i is None, i or 0, i, t))
        return [min(g, key=lambda r: r[:3])[3:] for g in groups.values()]
    fps = [plain_fingerprint(t) for _, t in rows]
    of = dict(zip(fps, plain_components(fps, list(range(len(rows)))), strict=True))
    groups = {}
    for (i, t), f in zip(rows, fps, strict=True):
        groups.setdefault(of[f], []).append((i is None, i or 0, hashlib.sha256((t or "").encode()).hexdigest(), i, t))
    return [min(g, key=lambda r: r[:3])[3:] for g in groups.values()]


def test_rows_that_stay_where_ids_are_null_or_repeat(spark, docs, folder, tmp_path):
    """Stage by stage, each on all that its predecessor kept; texts are compared, null as empty."""
    spark.read.parquet(f"{folder}/labels.parquet").filter("false").write.mode("overwrite").parquet(f"{folder}/labels.parquet")
    rows, df = MIXED_IDS, docs(MIXED_IDS)
    show = lambda found: sorted((repr(i), t or "") for i, t in found)
    for n, (name, stage) in enumerate(corpus_pipeline.STAGES[:4]):
        stage(spark, df, folder).write.parquet(str(tmp_path / f"odd{n}"))
        df = spark.read.parquet(str(tmp_path / f"odd{n}"))
        found = [(r["doc_id"], r["text"]) for r in df.collect()]
        if n == 0:
            assert show(found) == show(rows)
        elif n < 3:
            assert show(found) == show(plain_stage(name, rows)), name
        else:
            assert set(show(found)) <= set(show(rows))
        rows = found


def test_entry_works_without_the_subpackage(tmp_path):
    """With both llm folders and the pipeline gone, the entry imports and the other queries are there."""
    import subprocess
    import sys
    from pathlib import Path

    root = Path(corpus_pipeline.__file__).parent
    shutil.copytree(root / "rosterweave", tmp_path / "rosterweave", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(root / "__spark_entry__.py", tmp_path)
    code = "import __spark_entry__ as e; q = e.queries(); assert 'best_row_per_key' in q and 'pipeline' not in q and not any(n.startswith('op1') for n in q); assert set(e.oracle_sql()) <= set(q)"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True)
