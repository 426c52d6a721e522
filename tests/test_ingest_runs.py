"""Incremental ingest: new and changed files only, runs that died, empty folders."""

import gzip
import json
import os

from quarry.plans.ingest import ingest_landed, ingested, manifest

DOC = "a docstring of enough words"


def shard(path, *codes):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with gzip.open(path, "wt") as f:
        for c in codes:
            f.write(json.dumps({"code": c, "docstring": DOC, "file": "clash"}) + "\n")


def codes(df):
    return sorted(r.code for r in df.collect())


def test_runs_read_new_and_changed_files_only(spark, tmp_path):
    raw, files, out = f"{tmp_path}/raw", f"{tmp_path}/whole", f"{tmp_path}/out"
    go = lambda: ingest_landed(spark, out, raw, files, language="python")
    none = go()
    assert none.run == 0 and none.pairs.count() == 0 and none.gate.first().all_valid is False
    shard(f"{raw}/train_[1]+a b.jsonl.gz", "a", "b")
    shard(f"{raw}/test_1.jsonl.gz", "not read")
    rows = [("/** x */", "p"), ("nothing", "q")]
    spark.createDataFrame(rows, "content string, path string").coalesce(1).write.parquet(f"{files}/java.parquet")
    first = go()
    assert first.run == 1 and codes(first.pairs) == ["a", "b"] and [tuple(r) for r in first.files.collect()] == [("/** x */", "java", "p")]
    assert sorted((r.kind, r.language, r.n) for r in first.stats.collect() if r.language) == [("files", "java", 1), ("pairs", "python", 2)]
    assert first.gate.first().all_valid is True
    again = go()
    assert again.run == 0 and again.read.count() == 0 and codes(again.pairs) == ["a", "b"]
    shard(f"{raw}/train_2.jsonl.gz", "c")
    second = go()
    assert second.run == 2 and [r.file for r in second.read.collect()] == ["train_2.jsonl.gz"] and codes(second.pairs) == ["a", "b", "c"]
    shard(f"{raw}/train_[1]+a b.jsonl.gz", "a", "changed", "more")
    third = go()
    assert third.run == 3 and codes(third.pairs) == ["a", "c", "changed", "more"]


def test_a_run_that_died_is_not_read_and_done_again(spark, tmp_path):
    raw, out = f"{tmp_path}/raw", f"{tmp_path}/out"
    shard(f"{raw}/train_1.jsonl.gz", "a")
    assert ingest_landed(spark, out, raw, f"{tmp_path}/none", language="go").run == 1
    # rows of run 2 without its manifest
    spark.createDataFrame([("x", DOC, "go", "", "", "f")], "code string, docstring string, language string, repo string, path string, file string").write.partitionBy("language").parquet(f"{out}/pairs/run=2")
    assert codes(ingested(spark, out, "pairs")) == ["a"]
    shard(f"{raw}/train_2.jsonl.gz", "b")
    done = ingest_landed(spark, out, raw, f"{tmp_path}/none", language="go")
    assert done.run == 2 and codes(done.pairs) == ["a", "b"] and manifest(spark, out).count() == 2
