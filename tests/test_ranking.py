"""Exact slicing: equal to a brute-force sort, with hot duplicates and chunked expansion."""

import hashlib

from pyspark.sql import functions as F

from quarry.operators.ranking import cap_per_group, exact_split, top_k_per_group


def _rows():
    rows = []
    for i in range(3000):
        # one value holds a third of the rows
        v = "hot" if i % 3 == 0 else f"v{i % 1200}"
        g = "a" if i % 2 else "b"
        rows.append((g, v))
    return rows


def _key(v):
    return hashlib.md5(f"k:{v}".encode()).hexdigest()


def _brute_split(vals, tr=0.8, vr=0.1):
    vals = sorted(vals, key=_key)
    n = len(vals)
    t = int(n * tr)
    v = t + int(n * vr)
    out = {}
    for i, x in enumerate(vals):
        s = "train" if i < t else "val" if i < v else "test"
        out[(x, s)] = out.get((x, s), 0) + 1
    return out


def _counts(df, cols):
    return {tuple(r[c] for c in cols): r["n"] for r in df.groupBy(*cols).agg(F.count("*").alias("n")).collect()}


def test_split_matches_sort_with_hot_value_and_chunks(spark):
    df = spark.createDataFrame(_rows(), "g string, v string").withColumn("k", F.md5(F.concat(F.lit("k:"), "v")))
    for digits in (1, 4):
        from quarry.operators import ranking

        out = ranking.ordered_slices(df.select("v", "k"), "k", ranking.split_bounds(0.8, 0.1),
                                     slice_col="s", digits=digits)
        out = out.withColumn("split", F.element_at(F.array(*[F.lit(x) for x in ranking.SPLIT_NAMES]),
                                                   F.col("s") + 1))
        got = _counts(out, ["v", "split"])
        assert got == _brute_split([r[1] for r in _rows()])
    assert exact_split(df.select("v", "k"), "k", 0.8, 0.1).count() == 3000


def test_cap_per_group_is_exact(spark):
    df = spark.createDataFrame(_rows(), "g string, v string").withColumn("k", F.md5(F.concat(F.lit("k:"), "v")))
    capped = cap_per_group(df, "k", 700, ["g"])
    per_g = _counts(capped, ["g"])
    assert per_g == {("a",): 700, ("b",): 700}
    for g in ("a", "b"):
        vals = sorted([v for gg, v in _rows() if gg == g], key=_key)[:700]
        want = {}
        for x in vals:
            want[(x,)] = want.get((x,), 0) + 1
        got = _counts(capped.filter(F.col("g") == g), ["v"])
        assert got == want


def test_top_k_per_group(spark):
    df = spark.createDataFrame([(g, i) for g in "xyz" for i in range(50)], "g string, i int")
    out = top_k_per_group(df, 3, ["g"], [F.col("i").desc()])
    assert sorted((r.g, r.i) for r in out.collect()) == [(g, i) for g in "xyz" for i in (47, 48, 49)]


def test_slices_shuffle_no_content(spark):
    rows = [(f"text {i % 997}", i % 3) for i in range(5000)]
    df = spark.createDataFrame(rows, "v string, g int").withColumn("k", F.md5("v"))
    out = exact_split(df, "k", 0.8, 0.1, ["g"])
    for g in (0, 1, 2):
        got = _counts(out.filter(F.col("g") == g), ["split"])
        n = len([1 for _, x in rows if x == g])
        assert got[("train",)] == int(n * 0.8) and got[("val",)] == int(n * 0.1)
    # one pass over the written rows: nothing above its scan moves or groups them
    rows = out._jdf.queryExecution().optimizedPlan().children().apply(0)
    while rows.nodeName() != "Join":
        rows = rows.children().apply(0)
    content = rows.children().apply(0).toString()
    assert "numbered" in content or "Relation" in content
    assert not any(x in content for x in ("Repartition", "Window", "Aggregate", "Union", "Join"))


def test_input_is_computed_once_for_a_cap_and_a_split(spark):
    """Slices of a numbered table read the table, not its lineage."""
    from quarry.operators.ranking import numbered

    calls = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            calls.add(b.num_rows)
            yield b

    rows = spark.createDataFrame([(f"v{i}", i % 3) for i in range(900)], "v string, g int").mapInArrow(count, "v string, g int")
    table = numbered(rows.withColumn("k", F.md5("v")))
    out = exact_split(cap_per_group(table, "k", 200, ["g"]), "k", 0.8, 0.1)
    assert _counts(out, ["split"]) == {("train",): 480, ("val",): 60, ("test",): 60}
    assert calls.value == 900


def test_cut_inside_equal_rows_over_many_parts(spark):
    df = spark.range(1000).select(F.lit("same").alias("v"), F.md5(F.lit("x")).alias("k")).repartition(7)
    assert _counts(exact_split(df, "k", 0.8, 0.1), ["split"]) == {("train",): 800, ("val",): 100, ("test",): 100}
    nulls = spark.range(10).select(F.lit(None).cast("string").alias("k"))
    assert cap_per_group(nulls, "k", 4).count() == 4


def test_groups_beyond_the_local_limit_are_joined(spark, monkeypatch):
    from quarry.operators import ranking

    monkeypatch.setattr(ranking, "LOCAL_CUTS", 2)
    df = spark.createDataFrame([(f"v{i}", i % 7 or None) for i in range(700)], "v string, g int").withColumn("k", F.md5("v"))
    got = _counts(cap_per_group(df, "k", 30, ["g"]), ["g"])
    assert got == {(g,): 30 for g in (None, 1, 2, 3, 4, 5, 6)}


def test_row_numbers_by_ranges(spark):
    from quarry.operators.windows import row_numbers

    rows = [("a" if i % 3 else None, (i * 7919) % 5000 - 2500) for i in range(2000)] + [("b", None), ("b", 5), ("a", None)]
    got = row_numbers(spark.createDataFrame(rows, "g string, k int"), "g", "k", width=100).collect()
    assert len(got) == len(rows)
    for g in ("a", "b", None):
        want = sorted((k for h, k in rows if h == g), key=lambda k: (k is not None, k or 0))
        assert [r.k for r in sorted((r for r in got if r.g == g), key=lambda r: r.line_no)] == want
        assert sorted(r.line_no for r in got if r.g == g) == list(range(1, len(want) + 1))
    assert row_numbers(spark.createDataFrame([], "g string, k int"), "g", "k").count() == 0
