"""Merkle manifest, exact search and whitening against brute-force versions."""

import zlib
from hashlib import sha256

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from weekgrid.llm import merkle, order, registry, topk, whitening
from weekgrid.llm.common import table

SMALL = "/root/testdata/sf0.001"
rng = np.random.default_rng(8)


def digest(text):
    return sha256(text.encode()).hexdigest()


def reduced(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        x = levels[-1]
        levels.append([digest("".join(x[i : i + 2])) for i in range(0, len(x), 2)])
    return levels


def way(levels, i):
    out = []
    for nodes in levels[:-1]:
        out.append((i % 2, nodes[i ^ 1] if i ^ 1 < len(nodes) else ""))
        i //= 2
    return out


def manifest(rows):
    """(doc_id, leaf, subroot, root, proof, folded root) of (doc_id, source, lang, n_chars, text)."""

    def leaf(row):
        return digest("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))

    groups = {}
    for row in rows:
        groups.setdefault(row[2], []).append((row[0] is not None, row[0] or 0, leaf(row), row))
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {g: reduced([x[2] for x in sorted(groups[g], key=lambda x: x[:3])]) for g in names}
    top = reduced([trees[g][-1][0] for g in names])
    out = []
    for g in names:
        for i, (_, _, name, row) in enumerate(sorted(groups[g], key=lambda x: x[:3])):
            path = way(trees[g], i) + way(top, names.index(g))
            node = name
            if row[0] is not None and row[3] is not None and zlib.crc32(str(row[0]).encode()) % 7 == 0:
                node = leaf((*row[:3], row[3] + 1, row[4]))
            for right, other in path:
                node = digest(other + node if right else node + other)
            out.append((row[0], name, trees[g][-1][0], top[-1][0], digest("".join(s for _, s in path)), node, node == top[-1][0]))
    return sorted(out, key=repr)


DOCS = "doc_id long, source string, lang string, n_chars long, text string"
ODD = [(i, f"s{i % 3}", ["en", "de", None, "é"][min(i % 7, 3)], i, f"tëxt {i}") for i in range(60)]
ODD += [(5, "s", "en", 1, "x"), (5, "s", "en", 1, "x"), (None, "s", "en", 4, "y"), (None, None, None, None, None), (None, None, None, None, None)]
ODD += [(70, "a", "", 3, ""), (71, None, "lone", None, "long " * 20_000), (7 * 11, "a", "zz", None, "x"), (-3, "a", "zz", 9, "x")]


@pytest.mark.parametrize("levels", [1, 3, 10])
def test_manifest(spark, levels):
    docs = spark.createDataFrame(ODD, DOCS).repartition(4).withColumns({c: F.lit(1) for c in ("rank", "size", "b", "row", "root")})
    got = merkle.manifest(merkle.document_leaves(docs), levels).collect()
    assert sorted((tuple(r) for r in got), key=repr) == manifest(ODD)
    assert {r["verified"] for r in got} == {True, False}


@pytest.mark.parametrize("rows", [ODD[:1], [(i, "s", f"l{i}", 1, "x") for i in range(5)], []])
def test_manifest_of_few(spark, rows):
    got = merkle.manifest(merkle.document_leaves(spark.createDataFrame(rows, DOCS)), 2).collect()
    assert sorted((tuple(r) for r in got), key=repr) == manifest(rows) if rows else got == []


def test_ranks(spark):
    rows = [(None, i % 5, i) for i in range(300)] + [("a", 0, 300 + i) for i in range(20)]
    got = order.ranked(spark.createDataFrame(rows, "g string, x int, row long"), ["g"], ["x", "row"], "t").collect()
    for g, size in ((None, 300), ("a", 20)):
        mine = sorted((r for r in got if r["g"] == g), key=lambda r: r["rank"])
        assert [r["rank"] for r in mine] == list(range(size)) and {r["size"] for r in mine} == {size}
        assert [(r["x"], r["row"]) for r in mine] == sorted((x, row) for h, x, row in rows if h == g)


VECTORS = "vec_id long, embedding array<float>, score int, rank int"


def nearest(rows, k, every):
    """Brute force over (vec_id, vector) rows; shorter vectors are followed by zeros."""
    sound = [(i, v) for i, v in rows if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    width = max((len(v) for _, v in sound), default=0)
    x = np.array([[int(np.floor(64 * float(np.float32(c)))) for c in v] + [0] * (width - len(v)) for _, v in sound], np.int64).reshape(len(sound), width)
    out = []
    for a, (i, _) in enumerate(sound):
        if i % every == 0:
            best = sorted((-int(x[a] @ x[b]), j) for b, (j, _) in enumerate(sound) if a != b)[:k]
            out += [(i, r + 1, j, -s) for r, (s, j) in enumerate(best)]
    return sorted(out)


def vector_rows(n, d):
    centres = rng.standard_normal((4, d)) * 3
    rows = [(i, (centres[i % 4] + 0.2 * rng.standard_normal(d)).astype(np.float32).tolist()) for i in range(n)]
    copies = [(1000 + i, rows[3][1]) for i in range(60)] + [(20, rows[20][1]), (20, rows[20][1]), (None, rows[1][1])]
    return rows + copies + [(2000, None), (2001, [float("nan")] * d), (2002, [None] * d), (2020, []), (2040, [1.0]), (2060, [0.0] * d), (2080, [float("inf")] * d)]


@pytest.mark.parametrize("options", [{}, {"block": 16, "tile": 4, "pivots": 6, "sample": 50, "growth": 2}, {"k": 3, "pivots": 1, "block": 40}])
def test_search(spark, options):
    rows = vector_rows(300, 8)
    frame = spark.createDataFrame([(i, v, 1, 2) for i, v in rows], VECTORS).repartition(3)
    got = topk.search(frame, F.col("vec_id") % 10 == 0, **options).collect()
    assert sorted(tuple(r) for r in got) == nearest(rows, options.get("k", 20), 10)


def test_search_of_few(spark):
    empty = spark.createDataFrame([], VECTORS)
    assert topk.search(empty, F.col("vec_id") % 10 == 0).count() == 0
    assert topk.search(spark.createDataFrame([(0, [1.0], 1, 1)], VECTORS), F.col("vec_id") % 10 == 0).count() == 0
    rows = [(0, [1.0, -2.0]), (10, [3.0, 0.015]), (5, [-0.001, 100.0])]
    got = topk.search(spark.createDataFrame([(i, v, 1, 1) for i, v in rows], VECTORS), F.col("vec_id") % 10 == 0).collect()
    assert sorted(tuple(r) for r in got) == nearest(rows, 20, 10)


def test_search_stops_early(spark, monkeypatch):
    """Far clusters are never compared."""
    met = []
    plain = topk.meet
    monkeypatch.setattr(topk, "meet", lambda pairs, space, k: met.append(pairs.count()) or plain(pairs, space, k))
    rows = [(i, (np.array([[60, 0], [0, 60], [-60, 0], [0, -60]][i % 4]) + 0.1 * rng.standard_normal(2)).tolist()) for i in range(800)]
    got = topk.search(spark.createDataFrame([(i, v, 1, 1) for i, v in rows], VECTORS), F.col("vec_id") % 20 == 0, k=5, block=20, pivots=8).collect()
    assert sorted(tuple(r) for r in got) == nearest(rows, 5, 20)
    assert sum(met) < 4 * 40


def whitened(x):
    """n, S and the covariance of whole vectors, with numpy's own eigenvectors."""
    n = len(x)
    sums = x.sum(0)
    centred = x - sums / n
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    return n, sums, values[::-1], vectors[:, ::-1]


def check_whitening(got, rows, components=8):
    sound = [(i, v) for i, v in rows if v is not None and all(c is not None and np.isfinite(c) for c in v)]
    width = max(len(v) for _, v in sound)
    x = np.array([[int(np.floor(1024 * float(np.float32(c)))) for c in v] + [0] * (width - len(v)) for _, v in sound], np.int64) + 100_000
    n, sums, values, vectors = whitened(x)
    want = {}
    for (i, _), v in zip(sound, x):
        deviation = sum((n * int(a) - int(s)) ** 2 for a, s in zip(v, sums))
        want.setdefault(i, []).append((deviation, (v - sums / n) @ vectors[:, :components] / np.sqrt(values[:components])))
    assert len(got) == len(sound) * components
    by = {}
    for r in got:
        by.setdefault((r["vec_id"], int(r["deviation"])), {}).setdefault(r["component"], set()).add(r["whitened"])
        assert r["n"] == n and abs(r["explained"] / (values[r["component"] - 1] / values.sum()) - 1) < 1e-9
        assert r["identity_error"] < 1e-10
    signs = None
    for i, mine in want.items():
        for deviation, white in mine:
            have = np.array([next(iter(by[i, deviation][c + 1])) for c in range(components)])
            signs = np.sign(have * white) if signs is None else signs
            assert np.allclose(have * signs, white, atol=1e-8)


def test_whitening(spark):
    d = 11
    mixed = rng.standard_normal((400, d)) @ rng.standard_normal((d, d)) * 0.2
    rows = [(i, v.astype(np.float32).tolist()) for i, v in enumerate(mixed)] + [(7, mixed[7].astype(np.float32).tolist())]
    rows += [(None, [0.5] * d), (900, [0.25, -1.5]), (901, []), (902, None), (903, [None] * d), (904, [float("inf")] * d)]
    frame = spark.createDataFrame([(i, v, 1, 2) for i, v in rows], VECTORS).repartition(3).withColumnRenamed("score", "component")
    check_whitening(whitening.whiten(frame).collect(), rows)
    check_whitening(whitening.whiten(frame, components=3).collect(), rows, 3)


def test_whitening_of_low_rank(spark):
    line = [(i, [float(i), 2.0 * i, 0.0]) for i in range(20)]
    got = whitening.whiten(spark.createDataFrame([(i, v, 1, 2) for i, v in line], VECTORS)).collect()
    assert {r["component"] for r in got} == {1} and abs(got[0]["explained"] - 1) < 1e-12
    for rows in ([], line[:1], [line[3]] * 5, [(1, [])]):
        assert whitening.whiten(spark.createDataFrame([(i, v, 1, 2) for i, v in rows], VECTORS)).count() == 0


def test_large_deviations_are_exact(spark):
    rows = [(i, [float(2.0**20 * (i % 3)), float(i)]) for i in range(9)]
    got = whitening.whiten(spark.createDataFrame([(i, v, 1, 2) for i, v in rows], VECTORS)).collect()
    x = [[int(1024 * c) + 100_000 for c in v] for _, v in rows]
    sums = [sum(c) for c in zip(*x)]
    want = {i: sum((9 * a - s) ** 2 for a, s in zip(v, sums)) for i, v in enumerate(x)}
    assert {r["vec_id"]: int(r["deviation"]) for r in got} == want


def test_factors():
    for n, rank in ((1, 1), (6, 6), (9, 4), (16, 16)):
        b = rng.standard_normal((n, rank))
        a = b @ b.T
        at, factor = whitening.pivoted_cholesky(a)
        assert factor.shape == (n, rank) and np.allclose(factor @ factor.T, a[np.ix_(at, at)]) and np.allclose(factor, np.tril(factor))
        x = whitening.orthogonal_columns(factor)
        product = x.T @ x
        assert np.allclose(x @ x.T, factor @ factor.T) and np.allclose(product, np.diag(product.diagonal()), atol=1e-12 * n * product.max())


def views(*names):
    con = duckdb.connect()
    for name in names:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{SMALL}/{name}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(registry.sql()))
def test_query_equals_sql(spark, name):
    cursor = views("documents", "embeddings", "conversations").execute(registry.sql()[name])
    columns = [d[0] for d in cursor.description]
    got = registry.queries()[name](spark, SMALL).select(columns).collect()
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, cursor.fetchall())) and got


def test_op13_query(spark):
    rows = [(r["vec_id"], r["embedding"]) for r in table(spark, SMALL, "embeddings").collect()]
    got = registry.queries()["op13_whitening"](spark, SMALL)
    assert dict(got.dtypes)["deviation"] == "bigint"
    check_whitening(got.collect(), rows)
