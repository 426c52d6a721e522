"""Sources: exact line numbers across file blocks, lenient base64, landed files and payloads."""

import base64
import gzip
import json
import os
import tempfile
import uuid

from pyspark.sql import functions as F

from quarry.operators.repos import decode_base64_text
from quarry.sources.jsonl import scan_jsonl_pairs, scan_lines


def test_line_numbers_across_blocks(spark):
    d = tempfile.mkdtemp(prefix="quarry-lines-")
    expected = {}
    for f in range(3):
        lines = [("" if i % 17 == 0 else f"line {f}-{i} " + "x" * (i % 50)) for i in range(4000)]
        with open(os.path.join(d, f"part{f}.jsonl"), "w") as fh:
            fh.write("\n".join(lines) + "\n")
        expected[f"part{f}.jsonl"] = lines
    prev = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16384")
    try:
        df = scan_lines(spark, d, glob="*.jsonl")
        assert df.rdd.getNumPartitions() >= 1
        rows = df.select(F.regexp_extract("file", r"([^/]+)$", 1).alias("f"), "line_no", "line").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", prev)
    got = {}
    for r in rows:
        got.setdefault(r.f, {})[r.line_no] = r.line
    for f, lines in expected.items():
        assert got[f] == {i + 1: x for i, x in enumerate(lines)}


def test_folder_of_parts_is_one_file_read_once(spark, tmp_path):
    """Parts of a folder are numbered through; the second reader finds the first one's table."""
    from quarry.plans.validate import validate_dir

    root, expected = tmp_path / "shards", {}
    for shard, rows in (("a", 5000), ("b", 7), ("c", 0)):
        (root / f"shard={shard}").mkdir(parents=True)
        lines = [f"{shard} {i} " + "y" * (i % 40) for i in range(rows)]
        cuts = [0, rows // 5, rows // 5, rows // 2, rows]  # the second part is empty
        for part, (lo, hi) in enumerate(zip(cuts, cuts[1:])):
            (root / f"shard={shard}" / f"part-{part:05d}.txt").write_text("".join(x + "\n" for x in lines[lo:hi]))
        expected[shard] = lines
    prev = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8192")
    try:
        read = lambda: scan_lines(spark, str(root), glob="*.txt", recursive=True, by_folder=True)
        df = read()
        rows = df.select(F.regexp_extract("file", r"shard=(.)$", 1).alias("s"), "line_no", "line").collect()
        rep = validate_dir(spark, str(root), glob="*.txt", recursive=True, by_folder=True)
        numbered = {(r.file[-1], r.line_no) for r in rep.lines.collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", prev)
    assert {(r.s, r.line_no, r.line) for r in rows} == {(s, i + 1, x) for s, xs in expected.items() for i, x in enumerate(xs)}
    assert len(rows) == 5007 and numbered == {(r.s, r.line_no) for r in rows}
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "FileScan text" not in plan and "FileScan parquet" in plan
    assert sorted(read().inputFiles()) == sorted(df.inputFiles())
    (root / "shard=b" / "part-00004.txt").write_text("more\n")
    assert read().count() == 5008


def test_landed_shards_are_several_files(spark):
    """A shard is spread over files by ranges of ids, and its numbers hold across them."""
    from small_inputs import SMALL_SF
    from quarry import landing

    prev = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # the table is small
    version, landing.LANDING_VERSION = landing.LANDING_VERSION, uuid.uuid4().hex
    try:
        root = landing.land_lines(spark, SMALL_SF)
    finally:
        landing.LANDING_VERSION = version
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", prev)
    files = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", "*.txt").text(root).inputFiles()
    assert len(files) > 3
    got = scan_lines(spark, root, glob="*.txt", recursive=True, by_folder=True)
    landed = {(r.file.rsplit("=")[-1], r.line_no): r.line for r in got.collect()}
    from quarry import fixtures as X

    want = {}
    for r in sorted(X.fixture(spark, SMALL_SF, "fx_lines").collect(), key=lambda r: r.doc_id):
        want.setdefault(r.shard, []).append(r.line)
    assert landed == {(s, i + 1): x for s, xs in want.items() for i, x in enumerate(xs)}


def _py_lenient(s):
    try:
        return base64.b64decode(s).decode("utf-8")
    except Exception:
        return None


def test_base64_matches_python(spark):
    cases = ["QUJD", "QUJDA", "QQ==", "QQ==A", "QQ==QUJD", "!QUJD", "QU JD", "QUJ", "QQ=", "QQ", "Q===",
             "QUJD====", "QQ==\n", "//79", base64.b64encode("héllo wörld".encode()).decode(), "", "aGk=\n"]
    df = spark.createDataFrame([(c,) for c in cases], "c string")
    got = {r.c: r.t for r in df.select("c", decode_base64_text("c").alias("t")).collect()}
    for c in cases:
        assert got[c] == _py_lenient(c), c


def test_entries_of_differing_schemas_and_names(spark, tmp_path):
    from quarry.session import write_file
    from quarry.sources.files import file_inventory, scan_instructions, scan_whole_files, skipped_entries

    root = f"{tmp_path}/raw/x/raw"
    write = lambda rows, schema, path: spark.createDataFrame(rows, schema).write.parquet(f"{root}/{path}.parquet")
    write([("i", "o")], "instruction string, output string", "mixed/a")
    write([("p", "r")], "prompt string, response string", "mixed/b")
    rows = {(r.instruction, r.input, r.output) for r in scan_instructions(spark, f"{root}/mixed").collect()}
    assert rows == {("i", "", "o"), ("p", "", "r")}
    for name in ("c#", "c++", "objective c"):
        write([("text", "f")], "content string, path string", f"files/{name}")
    write([(1,)], "content int", "files/number")
    write_file(spark, f"{root}/files/bad.parquet", b"no parquet")
    got = {(r.language, r.content) for r in scan_whole_files(spark, f"{root}/files").collect()}
    assert got == {("c#", "text"), ("c++", "text"), ("objective c", "text"), ("number", "1")}
    assert [r.entry for r in skipped_entries(spark, f"{root}/files").collect()] == ["bad"]
    counts = {r.dataset: (r.n_files, r.n_rows) for r in file_inventory(spark, root, ["mixed", "files", "none"]).collect()}
    assert counts == {"mixed": (2, 2), "files": (5, 4), "none": (0, 0)}
    assert scan_whole_files(spark, f"{root}/absent").count() == 0


def test_search_pages_and_single_hits(spark, tmp_path):
    from quarry.operators.repos import select_repos, top_repos
    from quarry.sources.repos import read_hits

    hit = lambda i, lang, at: {"owner": {"login": "o"}, "name": f"n{i}", "stargazers_count": 9000 + i, "language": lang, "pushed_at": at}
    page = {"total_count": 2, "items": [hit(1, "Python", "2025-11-26T19:06:43Z"), hit(2, "python", "2025-12-01T00:00:00Z")]}
    lines = [page, hit(3, "PYTHON", "2025-12-02T01:02:03")]
    (tmp_path / "hits.json").write_text("\n".join(json.dumps(x) for x in lines))
    hits = read_hits(spark, str(tmp_path))
    assert {(r.name, str(r.pushed_at)) for r in hits.collect()} == {
        ("n1", "2025-11-26 19:06:43"), ("n2", "2025-12-01 00:00:00"), ("n3", "2025-12-02 01:02:03")}
    chosen = select_repos(hits, min_stars=1, languages=["python"])
    assert [r.name for r in top_repos(chosen, 2, ["python"]).orderBy("name").collect()] == ["n2", "n3"]
    assert top_repos(chosen, None).count() == 3


def test_split_is_tested_below_the_root(spark, tmp_path):
    root = tmp_path / "training-data"
    for split in ("train", "test"):
        (root / f"split={split}").mkdir(parents=True)
        with gzip.open(root / f"split={split}" / "a.jsonl.gz", "wt") as f:
            f.write(json.dumps({"code": split, "docstring": None}) + "\n")
    rows = scan_jsonl_pairs(spark, str(root), language="x").collect()
    assert [(r.code, r.docstring, r.repo) for r in rows] == [("train", None, "")]  # a null is kept, an absent key is ''


def test_no_local_scratch_off_a_local_master(monkeypatch, spark):
    import pytest

    from quarry import session

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Conf:
        def get(self, *a):
            return None

    class Remote:
        sparkContext, conf = Context(), Conf()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.scratch_dir(Remote())


def test_landed_search_pages_are_bounded(spark):
    from quarry import landing

    sizes = {}
    for sf in ("/root/testdata/sf0.001", "/root/testdata/sf0.01"):
        hits = spark.read.json(f"{landing.land_payloads(spark, sf)}/hits").filter("items is not null")
        sizes[sf] = [r.n for r in hits.select(F.size("items").alias("n")).collect()]
    small, large = sizes.values()
    assert max(small + large) <= landing.PAGE_IDS and len(large) > len(small)


def test_many_files_of_two_schemas_are_two_scans(spark, tmp_path):
    import pyarrow as pa
    import pyarrow.parquet as pq

    from quarry.sources.files import scan_instructions, scan_whole_files

    folder = tmp_path / "many.parquet"
    folder.mkdir()
    for i in range(1000):
        pq.write_table(pa.table({"instruction": [f"i{i}"], "output": ["o"]}), folder / f"a{i}.parquet")
        pq.write_table(pa.table({"prompt": [f"p{i}"], "input": ["x"], "response": ["r"]}), folder / f"b{i}.parquet")
    df = scan_instructions(spark, str(folder), verify=False)
    assert df._jdf.queryExecution().optimizedPlan().toString().count("Relation [") == 2
    rows = {(r.instruction, r.input, r.output) for r in df.collect()}
    assert rows == {(f"i{i}", "", "o") for i in range(1000)} | {(f"p{i}", "x", "r") for i in range(1000)}
    names = {r.language for r in scan_whole_files(spark, str(folder), verify=False).collect()}
    assert names == {f"{k}{i}" for k in "ab" for i in range(1000)}


def test_file_with_damaged_pages_is_left_out_whole(spark, tmp_path):
    import pyarrow as pa
    import pyarrow.parquet as pq

    from quarry.sources.files import scan_whole_files, skipped_entries

    for name in ("good", "torn"):
        table = pa.table({"content": [f"{name} {i}" for i in range(4000)], "path": ["p"] * 4000})
        pq.write_table(table, tmp_path / f"{name}.parquet", row_group_size=1000, use_dictionary=False, compression="none")
    at = pq.read_metadata(tmp_path / "torn.parquet").row_group(2).column(0).data_page_offset
    with open(tmp_path / "torn.parquet", "r+b") as f:
        f.seek(at)
        f.write(b"\xff" * 64)
    (tmp_path / "parts.parquet").mkdir()
    pq.write_table(pa.table({"content": ["part"], "path": ["p"]}), tmp_path / "parts.parquet" / "parts.parquet")
    (tmp_path / "parts.parquet" / "part-1.parquet").write_bytes(b"PAR1 cut")
    counts = {r.language: r["count"] for r in scan_whole_files(spark, str(tmp_path)).groupBy("language").count().collect()}
    assert counts == {"good": 4000, "parts": 1}
    assert {tuple(r) for r in skipped_entries(spark, str(tmp_path)).collect()} == {
        ("torn", "torn.parquet", "pages"), ("parts", "parts.parquet/part-1.parquet", "footer")}
    loose = {r.language: r["count"] for r in scan_whole_files(spark, str(tmp_path), verify=False).filter("content <> ''").groupBy("language").count().collect()}
    assert 0 < loose["torn"] < 4000


def test_payloads_and_lines_are_joined_and_kept_narrow(spark):
    """Contents do not enter the join of payloads, validated lines are no copy of the text,
    and landed tables are compressed well."""
    from small_inputs import SMALL_SF
    from quarry import catalog, landing

    plan = catalog.QUERIES["scan_repo_payloads"](spark, SMALL_SF)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Join") < plan.index("isnotnull(content")
    checked = catalog.QUERIES["validate_entries"](spark, SMALL_SF)
    assert checked.count() > 0 and not [f for f in checked.inputFiles() if "/quarry-lines/" in f]
    names = lambda folder: [f.rsplit("/", 1)[1] for f in folder.inputFiles()]
    raw, payloads = landing.land_raw(spark, SMALL_SF), landing.land_payloads(spark, SMALL_SF)
    assert all(".zstd." in n for n in names(spark.read.parquet(f"{raw}/code_docstring_corpus/train.parquet")))
    assert all(n.endswith(".gz") for n in names(spark.read.text(f"{payloads}/readmes")))
