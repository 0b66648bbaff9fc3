"""The pipeline, and the library without this part of it."""

import os
import re
import shutil
import subprocess
import sys
from pathlib import Path

import pytest

from pyspark.sql import functions as F
from test_near_copies import plain_groups

import corpus_pipeline
from framewright.llm import mixing, pii, toxicity
from framewright.sources.tables import written

SF = "/root/testdata/sf0.001"
ROOT = Path(__file__).resolve().parents[2]
WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
def test_stages_equal_plain_python(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    plain = {r["doc_id"]: r for r in docs.collect()}
    model = toxicity.train(docs, labels)
    words = toxicity.WordScores(model[0])
    ids = sorted(plain)
    scores = toxicity.probability(toxicity.log_odds([plain[i]["text"] or "" for i in ids], words, model[1]))
    ids = [i for i, s in zip(ids, scores) if s < toxicity.THRESHOLD]
    group = plain_groups([plain[i]["text"] for i in ids])
    ids = [i for k, i in enumerate(ids) if group[k] == k]
    texts = [plain[i]["text"] or "" for i in ids]
    clean = {i: pii.redacted(t, b + a) for i, t, (b, a) in zip(ids, texts, pii.spans_of(texts, pii.trained()))}

    step, out = docs, {}
    for name, f in corpus_pipeline.STAGES:
        step = out[name] = written(f(spark, step, SF), "test")
        assert name == "packing" or step.columns == docs.columns
    assert {r["doc_id"]: r["text"] for r in out["pii"].collect()} == clean
    taken = {r["doc_id"]: r["taken"] for r in mixing.plan(out["pii"]).collect()}
    mixed = {}
    for r in out["mixing"].collect():
        mixed[r["doc_id"]] = mixed.get(r["doc_id"], 0) + len(WORD.findall(r["text"]))
    assert mixed == {k: v for k, v in taken.items() if v}
    assert sorted(rebuilt(out["packing"])) == sorted((r["doc_id"], tuple(WORD.findall(r["text"]))) for r in out["mixing"].collect())
    ran = corpus_pipeline.run(spark, SF)
    assert sorted(rebuilt(ran)) == sorted(rebuilt(out["packing"]))


def rebuilt(packed):
    """(doc_id, words) of every packed row, put together from its pieces; bins are checked on the way."""
    rows, bins = {}, {}
    for r in packed.collect():
        own = WORD.findall(r["text"] or "")
        assert len(own) == r["length"]
        rows.setdefault((r["doc_id"], r["row"]), []).append((r["first"], own))
        if r["bin_id"]:
            bins.setdefault((r["bin_id"], r["capacity"]), []).append((r["bin_offset"], r["length"]))
    for (_, capacity), held in bins.items():
        end = 0
        for at, n in sorted(held):
            assert at == end
            end += n
        assert end <= capacity
    return [(i, tuple(w for _, part in sorted(parts) for w in part)) for (i, _), parts in rows.items()]


def test_pipeline_edges(spark, tmp_path):
    """Nulls in any column, repeated ids and rows, texts without words, a clashing column, no rows at all."""
    base = "the quiet river runs on and on and the boat goes with it slowly past the old mill and the town"
    rows = [
        (1, base, "en", "a", 10), (1, base, "en", "a", 10), (None, base + " now", "en", "a", 10), (2, None, "en", "a", None), (3, "", None, None, 0),
        (4, " \n", "en", "b", 2), (4, "call +1 (743) 555-3824 or mail a@b.org", "en", "b", 30), (5, "words " * 9000, "de", None, 54000), (None, None, None, None, None),
    ]
    kind = "doc_id long, text string, lang string, source string, n_chars long"
    labels = "doc_id long, quality int, toxic int"
    for name, df, marks in (("some", spark.createDataFrame(rows, kind), [(1, 1, 0), (None, None, 1), (4, 0, None)]), ("none", spark.createDataFrame([], kind), [])):
        sf = str(tmp_path / name)
        df.withColumn("row", F.lit("clash")).withColumn("size", F.lit(7)).write.parquet(f"{sf}/documents.parquet")
        spark.createDataFrame(marks, labels).write.parquet(f"{sf}/labels.parquet")
        got = rebuilt(corpus_pipeline.run(spark, sf))
        assert bool(got) == (name == "some")
        if got:
            # one of the three copies stays, and one of the texts without words, of which mixing takes nothing
            assert {i for i, _ in got} == {1, 4, 5}
            assert any("[PHONE]" in w for w in got for w in w[1]) and any("[EMAIL]" in w for w in got for w in w[1])


def test_run_leaves_one_table(spark):
    from framewright.sources.tables import shared_dir

    folder = shared_dir(spark).removeprefix("file:")
    before = set(os.listdir(folder))
    corpus_pipeline.run(spark, SF)
    assert [x.split("-")[:2] for x in set(os.listdir(folder)) - before] == [["stage", "packing"]]


def test_the_rest_stands_alone(tmp_path):
    top = tmp_path / "repo"
    shutil.copytree(ROOT, top, ignore=shutil.ignore_patterns(".git", "llm", "corpus_pipeline.py", "__pycache__", ".pytest_cache", ".hypothesis"))
    code = "import __spark_entry__ as e; q = e.queries(); assert 'temporal_match' in q and not any(k.startswith('op') and k[2].isdigit() for k in q) and 'pipeline' not in q"
    run = subprocess.run([sys.executable, "-c", code], cwd=top, env={**os.environ, "PYTHONPATH": ""}, capture_output=True, text=True)
    assert run.returncode == 0, run.stderr
    for p in top.rglob("*.py"):
        if p.name != "__spark_entry__.py":
            assert "llm" not in p.read_text(), p
