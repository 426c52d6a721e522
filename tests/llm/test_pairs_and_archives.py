"""Near duplicates, search, archives, the secret ledger and the pipeline."""

import base64
import hashlib
import math
import re

import numpy as np
import pytest
from llm_cases import SCHEMA, cases, prose, row

import corpus_pipeline
from quarry.llm import covertree, neardup, secrets, warc
from quarry.llm.lexicon import Lexicon, compile_words
from quarry.operators.components import components, join_components


def brute_components(rows):
    sets = {}
    for r in rows:
        words = (r[1] or "").encode().lower().split()
        n = max(1, len(words) - 4)
        sets[r[0]] = {tuple(words[i : i + 5]) for i in range(n)} if words else set()
    parent = {i: i for i in sets}

    def top(i):
        while parent[i] != i:
            i = parent[i]
        return i

    ids = sorted(i for i in sets if i is not None)
    for a in ids:
        for b in ids:
            if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                x, y = top(a), top(b)
                parent[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), top(i)) for i in ids}


def test_near_duplicates_match_brute_force(spark, docs, no_docs):
    rows = cases()
    # a chain of edits: neighbours are similar, the ends are not
    words = prose(77, 120).split()
    for i in range(12):
        words[10 * i : 10 * i + 4] = [f"edit{i}{k}" for k in range(4)]
        rows.append(row(500 + i, " ".join(words)))
    want = brute_components(rows)
    got = neardup.near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(got) == len(rows)
    for r in got:
        if r.doc_id is None:
            assert r.component_id is None and r.kept
        else:
            assert (r.n_shingles, r.component_id) == want[r.doc_id] and r.kept == (r.doc_id == r.component_id)
    assert neardup.near_duplicates(no_docs).count() == 0


def test_texts_that_resemble_without_a_link_are_not_listed_pair_by_pair(spark, monkeypatch):
    """Each text is another edit of one text; no two are similar enough, nearly all share a bucket."""
    rng, base, rows = np.random.default_rng(91), prose(91, 176).split(), []
    for i in range(60):
        words = list(base)
        for k in range(3):
            words[5 + 58 * k + rng.integers(50)] = f"edit{i}x{k}"
        rows.append(row(1000 + i, " ".join(words)))
    sets = [neardup.shingles(r[1].encode(), neardup._Hashes()) for r in rows]
    alike = [len(np.intersect1d(a, b)) / len(np.union1d(a, b)) for i, a in enumerate(sets) for b in sets[:i]]
    assert sum(0.65 < x < 0.75 for x in alike) > 900
    compared, confirm = [], neardup.confirm

    def counted(pairs, full):
        compared.append(pairs.distinct().count())
        return confirm(pairs, full)

    monkeypatch.setattr(neardup, "confirm", counted)
    want = brute_components(rows)
    got = neardup.near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == want
    assert sum(compared) < 300


def test_parities_lose_no_link():
    rng = np.random.default_rng(7)
    for n, d in ((40, 3), (500, 70), (3000, 900), (20_000, 4000)):
        a = rng.integers(0, 2**63, n).astype(np.uint64)
        b = np.concatenate([a[d:], rng.integers(0, 2**63, d).astype(np.uint64)])
        flips = sum(int(x).bit_count() for x in (neardup.parity(a) ^ neardup.parity(b)).view(np.uint64))
        assert flips <= len(np.setxor1d(a, b)) and flips % 2 == len(np.setxor1d(a, b)) % 2


def test_components_joined_by_further_links(spark):
    table = lambda *links: spark.createDataFrame(list(links), "a long, b long")
    found = components(table((5, 6), (6, 7), (20, 21), (30, 31)))
    got = {r.id: r.component for r in join_components(found, table((7, 21), (40, 31), (50, 51), (52, 51), (6, 5))).collect()}
    assert got == {5: 5, 6: 5, 7: 5, 20: 5, 21: 5, 30: 30, 31: 30, 40: 30, 50: 50, 51: 50, 52: 50}
    assert join_components(found, table((1, 2)).limit(0)).count() == found.count()


def test_keep_one_of_repeated_rows_and_rows_without_id(spark):
    base, other, third = prose(31, 60), prose(32, 60), prose(33, 60)
    near = base.rsplit(" ", 1)[0] + " other"
    rows = [row(4, base), row(4, base), row(5, near), row(None, base), row(None, other), row(None, other)]
    rows += [row(6, third), row(6, prose(34, 60)), row(7, None), row(7, None), row(8, ""), row(9, "")]
    got = neardup.keep_one(spark.createDataFrame(rows, SCHEMA).repartition(4))
    want = [(4, base), (None, other), (6, third), (6, prose(34, 60)), (7, None), (8, ""), (9, "")]
    assert sorted(((r.doc_id, r.text) for r in got.collect()), key=str) == sorted(want, key=str)


def test_signature_estimates_similarity():
    rng = np.random.default_rng(5)
    a = rng.integers(0, 2**63, 400).astype(np.uint64)
    b = np.concatenate([a[:340], rng.integers(0, 2**63, 60).astype(np.uint64)])
    sig = neardup.signatures([np.sort(a), np.sort(b)])
    assert abs((sig[0] == sig[1]).mean() - 340 / 460) < 0.1


def test_components_of_a_long_chain(spark):
    chain = spark.createDataFrame([(i, i + 1) for i in range(1, 200)] + [(900, 901), (901, 900)], "a long, b long")
    got = {r.id: r.component for r in components(chain).collect()}
    assert all(got[i] == 1 for i in range(1, 201)) and got[900] == got[901] == 900


def test_top_k_matches_brute_force(spark):
    rng = np.random.default_rng(3)
    rows = [(int(i), [float(x) for x in np.round(rng.normal(size=8), 1)]) for i in range(600)]
    rows += [rows[50], (700, rows[100][1]), (750, None), (751, [1.0, None] + [0.0] * 6), (752, [float("nan")] * 8), (800, [1.0, 2.0]), (801, [2.0, 1.0]), (None, rows[1][1])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>").selectExpr("vec_id", "embedding", "1 AS score", "2 AS rank")
    held = {}
    for i, v in rows:
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            held[i] = np.floor(256 * np.array(v, np.float32).astype(float)).astype(int)
    want = set()
    for q in (i for i in held if i % 50 == 0):
        near = sorted((-int(held[q] @ v), i) for i, v in held.items() if i != q and len(v) == len(held[q]))[:5]
        want |= {(q, n + 1, i, -s) for n, (s, i) in enumerate(near)}
    assert {tuple(r) for r in covertree.top_k(table).collect()} == want
    assert covertree.top_k(table.limit(0)).count() == 0


def test_tree_covers_and_prunes():
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(20, 6)) * 3000
    points = (centres[rng.integers(0, 20, 3000)] + rng.normal(size=(3000, 6)) * 5).astype(np.int64)
    tree = covertree.CoverTree(np.arange(3000), points)
    assert len(tree.levels) > 3 and sorted(tree.ids.tolist()) == list(range(3000))
    above = None
    for level in tree.levels:
        for n, centre in enumerate(level.centre):
            inside = slice(level.lo[n], level.lo[n + 1])
            assert (np.sqrt(((tree.real[inside] - tree.real[centre]) ** 2).sum(axis=1)) <= level.radius[n] * (1 + 1e-6) + 1e-6).all()
            if above is not None:
                p = level.parent[n]
                assert above.lo[p] <= level.lo[n] and level.lo[n + 1] <= above.lo[p + 1]
        above = level
    queries = covertree.CoverTree(np.arange(0, 3000, 50), points[::50])
    best = covertree.search(queries, tree, 5, np.full(60, covertree.NO_SCORE))
    seeded = covertree.search(queries, tree, 5, best.worst)
    whole = len(queries.ids) * len(tree.ids)
    assert seeded.bounded + seeded.scored < 0.4 * whole and seeded.scored < 0.1 * whole
    for found in (best, seeded):
        for n, q in enumerate(queries.ids):
            score = points @ points[q]
            want = sorted((-int(score[i]), i) for i in range(3000) if i != q)[:5]
            assert list(zip((-found.score[n]).tolist(), found.ids[n].tolist())) == want


def test_tree_of_copies_wide_values_and_one_point():
    rng = np.random.default_rng(6)
    for points in (np.ones((50, 3), np.int64), rng.integers(-(2**30), 2**30, (200, 4)), np.zeros((1, 2), np.int64), np.empty((4, 0), np.int64)):
        ids = np.arange(len(points))
        tree, queries = covertree.CoverTree(ids, points), covertree.CoverTree(ids, points)
        again = covertree.CoverTree(tree.ids, tree.whole, [covertree.Level.unpack(x.pack()) for x in tree.levels])
        best = covertree.search(queries, again, 3, np.full(len(ids), covertree.NO_SCORE))
        for n, q in enumerate(queries.ids):
            score = points @ points[q]
            want = sorted((-int(score[i]), i) for i in ids.tolist() if i != q)[:3]
            got = [(-s, i) for s, i in zip(best.score[n].tolist(), best.ids[n].tolist()) if i != covertree.NO_ID]
            assert got == want


def test_archives_round_trip(spark):
    rows = [(1, "http://a", "<p>é</p>"), (2, None, "<p>é</p>"), (3, "u\r\nx: y", None), (4, "v", ""), (5, "w", "y" * 700_000), (5, "w", "y" * 700_000), (None, "n", "<p>é</p>"), (None, "m", "alone")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "'x' AS payload", "1 AS size", "'z' AS sha")
    got = sorted((tuple(r) for r in warc.roundtrip(pages).collect()), key=str)
    sha = lambda s: base64.b32encode(hashlib.sha1((s or "").encode()).digest()).decode()
    first = {}
    for i, _, h in rows:
        if i is not None:
            first[h or ""] = min(i, first.get(h or "", i))
    want = []
    for i, _, h in rows:
        f = first.get(h or "")
        own = f is None or i == f
        want.append((i, len((h or "").encode()), sha(h), "response" if own else "revisit", None if own else f))
    assert got == sorted(want, key=str)
    assert warc.roundtrip(pages.limit(0)).count() == 0


def test_one_record_from_its_frame(spark, tmp_path):
    pages = spark.createDataFrame([(i, f"http://x/{i}", "z" * i) for i in range(300)], "page_id long, url string, html string")
    index = warc.write(pages, f"{tmp_path}/archive")
    got = {r.page_id: bytes(r.payload) for r in warc.fetch(index.filter("page_id in (0, 7, 299)")).collect()}
    assert got == {0: b"", 7: b"z" * 7, 299: b"z" * 299}
    bundle = index.first().bundle
    assert sum(s for _, s in warc.seek_table(bundle)) > 0


def brute_spans(text):
    out = []
    for m in re.finditer(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text, re.I | re.A):
        if len(m[2]) >= 6:
            out.append((m.start(), 0, m.end(), "assign"))
    for rank, (kind, pattern, least) in enumerate((("access", "AKIA[A-Z0-9]+", 20), ("hex", "[0-9a-f]+", 24)), 1):
        out += [(m.start(), rank, m.end(), kind) for m in re.finditer(pattern, text) if len(m[0]) >= least]
    return sorted(out)


def test_secrets_match_brute_force(spark, docs, no_docs):
    extra = [row(300, "TOKEN=password: abcdefgh é api-key=zzzzzzz apikey = 'short' Api_Key: longenough secret=a token=" + "9" * 30), row(301, "🙂 AKIAAKIA" + "B" * 15 + " passwd='" + "f" * 24)]
    rows = cases() + extra
    table = spark.createDataFrame(rows, SCHEMA)
    got = {(r.doc_id, r.n_assign, r.n_access, r.n_hex, r.base_sha256) for r in secrets.scan(table).collect()}
    want = set()
    for r in rows:
        spans = brute_spans(r[1] or "")
        kinds = [s[3] for s in spans]
        digest = hashlib.sha256(",".join(f"{k}:{a}:{b}" for a, _, b, k in spans).encode()).hexdigest()
        want.add((r[0], kinds.count("assign"), kinds.count("access"), kinds.count("hex"), digest))
    assert got == want
    assert secrets.scan(no_docs).count() == 0
    clean = secrets.redact(table)
    assert clean.columns == table.columns and clean.count() == len(rows)
    assert all(not brute_spans(r.text or "") and r.n_chars == (None if r.text is None else len(r.text)) for r in clean.filter("doc_id >= 300").collect())


def test_ledger_scans_only_unseen_pairs(spark):
    ledger = secrets.new_ledger(spark)
    hexes = (secrets.Rule("hex", 1, "[0-9a-f]{24,}"),)
    table = spark.createDataFrame([(1, "ab" * 12), (2, "ab" * 12), (3, "none")], "doc_id long, text string")
    one = secrets.scan(table, ledger, hexes)
    assert sorted((r.doc_id, r.spans) for r in one.collect()) == [(1, "hex:0:24"), (2, "hex:0:24"), (3, "")]
    read = lambda: spark.read.schema(secrets.LEDGER).parquet(ledger)
    assert read().count() == 2
    secrets.scan(table, ledger, hexes)
    assert read().count() == 2  # nothing new
    newer = (*hexes, secrets.Rule("word", 1, "none"))
    more = table.unionByName(spark.createDataFrame([(4, "none at all")], table.schema))
    got = secrets.scan(more, ledger, newer)
    assert sorted((r.doc_id, r.spans) for r in got.collect())[2:] == [(3, "word:0:4"), (4, "word:0:4")]
    assert sorted(tuple(sorted(r.scanned)) for r in read().collect()) == [("hex@1",), ("hex@1",), ("hex@1", "word@1"), ("word@1",), ("word@1",)]


def test_transducer_is_minimal_and_exact(tmp_path):
    words = {b"walking": (1, 2), b"talking": (3,), b"king": (4, 5, 6), b"walked": (7,), b"\xff\x00": (8,), b"k": (9,)}
    path = tmp_path / "lexicon"
    path.write_bytes(compile_words(list(words.items())))
    lexicon = Lexicon(str(path))
    asked = [*words, b"", b"walk", b"kings", b"zzz", b"walkingx"]
    assert [None if o is None else tuple(o.tolist()) for o in lexicon.outputs(asked)] == [*words.values(), *[None] * 5]
    assert len(lexicon.finals) < sum(map(len, words))  # suffixes are shared
    path.write_bytes(compile_words([]))
    assert Lexicon(str(path)).outputs([b"a"]) == [None]


@pytest.fixture
def corpus(spark, docs, tmp_path):
    bad = [row(1000 + i, prose(i, 50) + (" vilefool scumbagger nastything vilefool" if i % 3 == 0 else "")) for i in range(90)]
    table = spark.createDataFrame(bad, SCHEMA).unionByName(docs).select("doc_id", "text", "lang", "source", "n_chars")
    table.write.parquet(f"{tmp_path}/documents.parquet")
    labels = [(1000 + i, int(i % 2), int(i % 3 == 0)) for i in range(90)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    return str(tmp_path)


def test_pipeline_stages(spark, corpus):
    table = spark.read.parquet(f"{corpus}/documents.parquet")
    names, seen, out = [n for n, _ in corpus_pipeline.STAGES], {}, table
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, out, corpus)
        out.write.parquet(f"{corpus}/{name}")
        out = seen[name] = spark.read.parquet(f"{corpus}/{name}")
        if name != names[-1]:
            assert out.dtypes == table.dtypes
    ids = {n: [r.doc_id for r in f.select("doc_id").collect()] for n, f in seen.items()}
    toxic = {1000 + i for i in range(0, 90, 3)}
    assert len(toxic & set(ids["toxicity"])) <= 3 and len({1000 + i for i in range(90)} - toxic - set(ids["toxicity"])) <= 2
    want = brute_components([(r.doc_id, r.text) for r in seen["toxicity"].collect()])
    assert sorted(i for i in ids["near_duplicates"] if i is not None) == sorted(i for i, (_, c) in want.items() if i == c)
    assert all(not brute_spans(r.text or "") for r in seen["secrets"].collect())
    assert set(ids["mixing"]) == set(ids["secrets"]) and sorted(ids["encoding"], key=str) == sorted(ids["mixing"], key=str)
    text = {r.doc_id: r.text or "" for r in seen["mixing"].collect()}
    assert all(r.decoded_sha256 == hashlib.sha256(text[r.doc_id].encode()).hexdigest() for r in seen["encoding"].collect())


def test_pipeline_of_an_empty_table(spark, corpus, tmp_path):
    out = spark.read.parquet(f"{corpus}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        out = stage(spark, out, corpus)
    assert out.count() == 0


def test_near_duplicates_equal_their_sql(spark):
    import duckdb

    once = {r[0]: r for r in cases() if r[0] is not None}
    chain = [prose(50, 200).split()]
    for i in range(1, 6):  # each text differs from the next by a few words, the ends by more
        chain.append([*chain[-1][:-3], *chain[0][: 3 * i]][-200:] if i % 2 else [f"new{i}", *chain[-1][5:]])
    rows = [*once.values(), *[row(5000 - i, " ".join(words)) for i, words in enumerate(chain)]]
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", [(r[0], r[1]) for r in rows])
    want = set(con.execute(neardup.ORACLE_SQL).fetchall())
    got = neardup.near_duplicates(spark.createDataFrame(rows, SCHEMA)).select("doc_id", "n_shingles", "component_id", "kept").collect()
    assert set(map(tuple, got)) == want and len(got) == len(rows)
    assert len({r.component_id for r in got if r.doc_id >= 4995}) < 6
