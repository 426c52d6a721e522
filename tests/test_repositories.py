"""Key-file contents of repository prompts and links of curated lists, on small rows."""

import base64

from pyspark.sql import functions as F

from quarry.functions.quality import skeleton, skeleton_headings
from quarry.operators.filters import authored_readmes, generated_readmes
from quarry.operators.joins import curated_repositories, repository_of
from quarry.operators.repos import key_file_contents, repo_context_prompt, with_key_files

TREE = "array<struct<path:string,type:string,size:bigint>>"


def b64(text):
    return base64.b64encode(text.encode()).decode()


def records(spark):
    tree = lambda *paths: [(p, "blob", 1) for p in paths]
    rows = [
        ("o/a", tree("src/main.py", "package.json", "go.mod", "readme.md", "package.json")),
        ("o/b", tree("x.txt")), ("o/c", None), ("o/d", []),
        ("o/e", tree(*[f"p{i:03}/setup.py" for i in range(120)])),
    ]
    return spark.createDataFrame(rows, f"repo_name string, file_tree {TREE}")


def contents(spark):
    rows = [
        ("o", "a", "package.json", b64("é" * 10)), ("o", "a", "package.json", None), ("o", "a", "src/main.py", b64("x" * 9000)),
        ("o", "a", "go.mod", "//79"), ("o", "a", "readme.md", b64("no key file")), ("o", "b", "package.json", b64("not in the tree")),
    ] + [("o", "e", f"p{i:03}/setup.py", b64(f"file {i}")) for i in range(120)]
    return spark.createDataFrame(rows, "owner string, name string, path string, content string")


def test_key_files_with_contents(spark):
    got = {r.repo_name: [tuple(x) for x in r.key_files] for r in key_file_contents(records(spark), contents(spark), 2000, 50).collect()}
    assert got["o/a"] == [("go.mod", None), ("package.json", "é" * 10), ("src/main.py", "x" * 2000)]
    assert got["o/e"] == [(f"p{i:03}/setup.py", f"file {i}") for i in range(50)]
    assert set(got) == {"o/a", "o/e"}


def test_repository_prompt(spark):
    full = with_key_files(records(spark), contents(spark))
    got = {r.repo_name: r.p for r in full.select("repo_name", repo_context_prompt("repo_name", "file_tree", "key_files").alias("p")).collect()}
    assert got["o/a"].endswith("Key Files:\ngo.mod\n\npackage.json:\n```json\n" + "é" * 10 + "\n```,\n\nsrc/main.py:\n```python\n" + "x" * 2000 + "\n```,")
    assert got["o/c"] == got["o/d"].replace("o/d", "o/c") == "Project: o/c\n\nStructure:\n\n\nKey Files:\n"
    empty = with_key_files(records(spark), contents(spark).limit(0))
    assert "package.json\n\nsrc/main.py" in empty.filter("repo_name = 'o/a'").select(repo_context_prompt("repo_name", "file_tree", "key_files")).first()[0]


def test_a_large_repository_is_joined_by_file(spark):
    plan = key_file_contents(records(spark), contents(spark))._jdf.queryExecution().optimizedPlan().toString()
    join = next(line for line in plan.splitlines() if "Join" in line)
    assert "path" in join and "repo_name" in join


def test_repository_of_urls(spark):
    urls = {
        "https://Example.org/Owner/Name": ("example.org", "owner", "name"), "http://www.example.org:8080/o/n.git": ("example.org", "o", "n"),
        "//example.org/o/n/": ("example.org", "o", "n"), "https://example.org/o/n#readme": ("example.org", "o", "n"),
        " https://example.org/o/n?tab=x ": ("example.org", "o", "n"), "https://example.org/o/n/tree/main/x": ("example.org", "o", "n"),
        "https://example.org/o": None, "/o/n": None, "#top": None, "": None, None: None, "https://example.org/o/.git": None,
        "mailto:a@b.c": None, "https://example.org/o/n.github.io": ("example.org", "o", "n.github.io"),
    }
    table = spark.createDataFrame([(u,) for u in urls], "u string").select("u", repository_of("u").alias("r"))
    assert {r.u: tuple(r.r) if r.r else None for r in table.collect()} == urls


def test_curated_repositories(spark):
    repos = spark.createDataFrame([(1, "https://h/o/n", "x"), (2, "https://h/o/other", "y"), (3, None, "z"), (4, "https://h/P/Q", None), (1, "https://h/o/n", "x")], "id int, url string, host string")
    pages = spark.createDataFrame([("<a href='https://h/o/n.git'>", ), (None,), ("- [q](https://www.h/p/q#s) text (https://h/o/other)",)], "html string")
    assert sorted(r.id for r in curated_repositories(repos, pages, "url").collect()) == [1, 1, 4]
    assert curated_repositories(repos, pages.limit(0), "url").count() == 0
    assert curated_repositories(repos, pages, "url").columns == ["id", "url", "host"]
    assert curated_repositories(repos.filter(F.lit(False)), pages, "url").count() == 0


def test_skeleton_of_a_readme(spark):
    text = "# Tool v12.3 \n\none\ntwo\r\n- a\n* b\n3) c\n```py\nx = 1\n```\n## API.\n| a |\n|--|\n\tend.\n"
    form, n = spark.createDataFrame([(text,)], "t string").select(skeleton("t").alias("f")).select("f", skeleton_headings("f")).first()
    assert form == "# tool v0.0\n.\n-\n`\n.\n`\n## api.\n|\n.\n" and n == 2
    none, empty = (r[0] for r in spark.createDataFrame([(None,), ("",)], "t string").select(skeleton("t")).collect())
    assert none is None and empty == "\n"


def test_generated_readmes(spark):
    made = [(i, f"# Client {i}\n\ntext {i}\n{'more' * i}\n## Models\n- m{i}\n## Methods\n") for i in range(5)]
    own = [(10 + i, f"# {w}\ntext\n## why {w}\n## how\n") for i, w in enumerate("abcdef")]
    short = [(20 + i, f"# Notes\n{i}") for i in range(9)]
    rows = made + own + short + [own[0]] * 6 + [(30, None), (None, made[0][1]), (31, "")]
    table = spark.createDataFrame(rows, "id int, t string").selectExpr("id", "t", "1 AS n", "'x' AS generated")
    got = {r.id: r.generated for r in generated_readmes(table, "id", "t").collect()}
    assert {i for i, g in got.items() if g} == set(range(5)) and set(got) == {i for i, _ in rows}
    assert not any(r.generated for r in generated_readmes(table.filter("id > 0 or id is null"), "id", "t").collect())
    assert generated_readmes(table.limit(0), "id", "t").count() == 0
    body = "the text and the use of it is in the file " * 20 + "\n```\nx\n```\n"
    full = spark.createDataFrame([(i, t + body) for i, t in made + own], "id int, t string")
    assert {r.id for r in authored_readmes(full, "id", "t", min_sections=2).collect()} == {i for i, _ in own}
