"""Embedding near-dedup against cosines of all pairs."""

from collections import Counter

import numpy as np
import pytest
from pyspark.sql import types as T

from eventide.llm import subspace_join as S

SCHEMA = T.StructType([
    T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())), T.StructField("label", T.IntegerType()),
    # Extra columns whose names clash with what the operator makes.
    T.StructField("node", T.StringType()), T.StructField("size", T.StringType()), T.StructField("vec", T.IntegerType()),
    T.StructField("n_links", T.StringType())])


def brute(rows, threshold=0.93):
    """Counter of (vec_id, n_links, component_id, kept) by plain loops."""
    ok = [i for i, (vec_id, e, label) in enumerate(rows)
          if vec_id is not None and label is not None and e and all(x is not None and np.isfinite(x) for x in e) and any(e)]
    links = {i: set() for i in ok}
    for i in ok:
        for j in ok:
            if i < j and rows[i][2] == rows[j][2] and len(rows[i][1]) == len(rows[j][1]):
                a, b = (np.array(rows[k][1], np.float32).astype(float) for k in (i, j))
                if a @ b / np.sqrt((a @ a) * (b @ b)) >= threshold:
                    links[i].add(j)
                    links[j].add(i)
    out, of = [], {}
    for i in ok:
        if i not in of:
            group, todo = {i}, [i]
            while todo:
                fresh = links[todo.pop()] - group
                group |= fresh
                todo += fresh
            for j in group:
                of[j] = min(rows[k][0] for k in group)
    for i, (vec_id, _, _) in enumerate(rows):
        component = of.get(i, vec_id)
        out.append((vec_id, len(links.get(i, ())), component, vec_id is not None and vec_id == component))
    return Counter(out)


def frame(spark, rows):
    return spark.createDataFrame([(v, e if e is None else [x if x is None else float(x) for x in e], label, "x", "y", 1, None)
                                  for v, e, label in rows], SCHEMA).repartition(3)


def result(df):
    return Counter(map(tuple, df.collect()))


def planted(rng, n=260, size=24, labels=3):
    """Random directions, groups of near copies about the threshold, chains."""
    rows, base = [], rng.standard_normal((n // 10, size))
    for i in range(n):
        v = base[rng.integers(len(base))] if i % 2 else rng.standard_normal(size)
        v = v + rng.choice([0.0, 0.1, 0.25, 0.38]) * rng.standard_normal(size)
        rows.append([i * 3 - 40, (v * rng.choice([0.01, 1, 500])).astype(np.float32).tolist(), int(rng.integers(labels))])
    return rows


@pytest.mark.parametrize(("block_dims", "cell_rows"), [(8, 4096), (4, 8), (3, 20), (24, 16)])
def test_planted_copies(spark, block_dims, cell_rows):
    rows = planted(np.random.default_rng(block_dims))
    got = result(S.near_copies(frame(spark, rows), block_dims=block_dims, cell_rows=cell_rows))
    want = brute(rows)
    assert got == want
    assert sum(n > 0 for _, n, _, _ in want) > 50


@pytest.mark.parametrize("threshold", [0.5, 0.999])
def test_other_thresholds(spark, threshold):
    rows = planted(np.random.default_rng(9), n=120)
    assert result(S.near_copies(frame(spark, rows), threshold=threshold, block_dims=6, cell_rows=10)) == brute(rows, threshold)


def test_awkward_rows(spark):
    v = [1.0, 0.2, -0.3, 0.0, 0.5, 0.25, 0.75, -1.0]
    near = [x + 0.01 for x in v]
    rows = [(1, v, 1), (2, v, 1), (2, v, 1), (3, near, 1), (4, near, 2), (5, v, 2), (6, v, None), (7, None, 1), (8, [0.0] * 8, 1),
            (9, [float("nan"), *v[1:]], 1), (10, [float("inf"), *v[1:]], 1), (11, [None, *v[1:]], 1), (12, [], 1), (None, v, 1),
            (None, None, None), (13, v[:4], 1), (14, [2 * x for x in v[:4]], 1), (-15, [-x for x in v], 1), (16, [1e-30 * x for x in v], 1),
            (17, [1e30 * x for x in v], 1), (18, [-0.0 if x == 0 else x for x in v], 1), (19, [-x for x in v], 3)]
    got = result(S.near_copies(frame(spark, rows)))
    # A row without an id takes no part.
    assert got == brute(rows)


def test_a_large_group_of_near_copies(spark):
    """Every pair of the group is a link, counted and never emitted."""
    rng = np.random.default_rng(2)
    base = rng.standard_normal(16)
    rows = [(i, (base + 0.02 * rng.standard_normal(16)).astype(np.float32).tolist(), 4) for i in range(700)]
    rows += [(1000 + i, rows[0][1], 4) for i in range(300)]
    got = S.near_copies(frame(spark, rows), cell_rows=64).collect()
    assert {(r["n_links"], r["component_id"]) for r in got} == {(999, 0)}
    assert [r["vec_id"] for r in got if r["kept"]] == [0]


def test_pigeonhole_and_cells():
    """Two points within the radius meet in exactly one cell, whatever the grid."""
    rng = np.random.default_rng(5)
    points = rng.uniform(-1, 1, (400, 3))
    radius = 0.2
    members = {}
    for rows, cells, guest in S._cells(points, radius):
        for i, c in zip(rows.tolist(), map(tuple, cells.tolist()), strict=True):
            members.setdefault(c, []).append((i, guest))
    met = Counter()
    for held in members.values():
        for k, (i, g) in enumerate(held):
            for j, h in held[k + 1:]:
                if not (g and h):
                    met[frozenset((i, j))] += 1
    for i in range(400):
        for j in range(i):
            if ((points[i] - points[j]) ** 2).sum() <= radius ** 2:
                assert met[frozenset((i, j))] == 1
    assert abs(sum(S.budgets(50, 0.93, 8)) - 0.14 - S.ROUNDING) < 1e-9
    assert max(met.values()) == 1


def test_empty_tables(spark):
    assert S.near_copies(frame(spark, [])).collect() == []
    assert result(S.near_copies(frame(spark, [(1, None, 1), (2, [0.0], 2)]))) == brute([(1, None, 1), (2, [0.0], 2)])


def test_doubles(spark):
    rows = [(1, [1e200, 1e200], 1), (2, [1e-200, 1.01e-200], 1), (3, [1e200, -1e200], 1)]
    schema = "vec_id long, embedding array<double>, label string"
    got = S.near_copies(spark.createDataFrame([(v, e, "a") for v, e, _ in rows], schema)).collect()
    assert {(r["vec_id"], r["n_links"], r["component_id"]) for r in got} == {(1, 1, 1), (2, 1, 1), (3, 0, 3)}
