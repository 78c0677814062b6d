"""Sorted projection passes against brute force over all pairs."""

import numpy as np
import pytest

from twinline.llm import vector_dedup as vd

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, threshold=0.98):
    """{row number: (links, component id)} from all pairs of one label."""
    ok = [k for k, (_, v, lab) in enumerate(rows)
          if lab is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    near = {k: set() for k in range(len(rows))}
    for lab, dim in {(rows[k][2], len(rows[k][1])) for k in ok}:
        at = [k for k in ok if rows[k][2] == lab and len(rows[k][1]) == dim]
        m = np.array([np.float32(rows[k][1]) for k in at], np.float64)
        m /= np.linalg.norm(m, axis=1, keepdims=True)
        for i, j in zip(*np.nonzero(m @ m.T >= threshold)):
            if i != j:
                near[at[i]].add(at[j])
    comp = {}
    for k in near:
        if k not in comp:
            group, todo = {k}, [k]
            while todo:
                new = near[todo.pop()] - group
                group |= new
                todo += new
            ids = [rows[x][0] for x in group if rows[x][0] is not None]
            comp.update(dict.fromkeys(group, min(ids, default=None)))
    return {k: (len(near[k]), comp[k]) for k in near}


def planted(n=600, seed=3):
    """Random vectors, a tight group, pairs near the threshold, a chain, copies."""
    rnd = np.random.default_rng(seed)
    base = rnd.standard_normal((n, 16))
    base /= np.linalg.norm(base, axis=1, keepdims=True)
    extra = [base[0] + 0.01 * rnd.standard_normal(16) for _ in range(150)]
    extra += [base[k] + 0.03 * rnd.standard_normal(16) for k in range(1, 60)]
    a, b = base[60], base[61] - (base[61] @ base[60]) * base[60]
    extra += [np.cos(t) * a + np.sin(t) * b / np.linalg.norm(b) for t in np.arange(0, 1.5, 0.15)]
    extra += [base[62]] * 40
    vecs = np.concatenate([base, extra])
    labels = rnd.integers(0, 3, len(vecs))
    labels[n:n + 150] = labels[0]
    labels[n + 150:n + 209] = labels[1:60]
    labels[n + 209:] = 1
    order = rnd.permutation(len(vecs))
    return [(int(k), [float(np.float32(x)) for x in vecs[o]], int(labels[o])) for k, o in enumerate(order)]


@pytest.mark.parametrize("window,parts,block", [(512, 1, 2048), (32, 7, 24)])
def test_against_all_pairs(spark, window, parts, block):
    rows = planted()
    want = brute(rows)
    df = spark.createDataFrame(rows, SCHEMA).repartition(parts)
    got = {r["vec_id"]: r for r in vd.near_dedup(df, window=window, block=block, passes=8).collect()}
    assert len(got) == len(rows)
    links = sum(n for n, _ in want.values())
    assert 0.98 * links <= sum(r["n_links"] for r in got.values()) <= links
    assert all(got[k]["n_links"] <= want[k][0] for k in got)
    assert np.mean([got[k]["component_id"] == want[k][1] for k in got]) >= 0.98
    assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in got.values())


def test_windows_cross_partitions(spark):
    """With one pass and two rows a window, copies in other directions apart,
    every pair of neighbours in the order is met, wherever partitions end."""
    rows = [(k, [1.0, 0.001 * k], 0) for k in range(200)]  # a chain along the key's order
    got = vd.near_dedup(spark.createDataFrame(rows, SCHEMA).repartition(5), window=2, passes=8, block=16).collect()
    assert {r["component_id"] for r in got} == {0}
    assert {r["vec_id"]: r["n_links"] for r in got} == {k: n for k, (n, _) in brute(rows).items()}


def test_window_borders(spark):
    """A partition's last chunk meets the next one's first."""
    rnd = np.random.default_rng(0)
    rows = [(k, rnd.standard_normal(3).tolist(), 0) for k in range(300)]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("vec_id as _c", "embedding as _vec", "label as _label", "3 as _dim")
    hashed = vd.with_keys(df, 1, 5).cache()
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        found = {tuple(sorted((r["a"], r["b"]))) for r in vd.window_pass(hashed, 0, -1.0, 8).collect()}  # every pair met is a link
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    nodes = {k: k for k in range(300)}

    def root(k):
        while nodes[k] != k:
            k = nodes[k]
        return k

    for a, b in found:
        nodes[root(a)] = root(b)
    assert len({root(k) for k in nodes}) == 1


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 0.0], 0), (2, [2.0, 0.0], 0), (3, [1.0, 0.0], 1), (4, [1.0, 0.0], None), (5, None, 0), (6, [], 0),
            (7, [0.0, 0.0], 0), (8, [nan, 1.0], 0), (9, [inf, 1.0], 0), (10, [None, 1.0], 0), (None, [1.0, 0.0], 0),
            (12, [1.0, 0.0, 0.0], 0), (13, [1.0, 0.0], 0), (13, [1.0, 0.0], 0), (None, [0.0, 1.0], 5), (15, [-1.0, 0.0], 0),
            (16, [1e-30, 0.0], 0), (17, [3e38, 0.0], 0)]
    clash = "_id long, _c long, _vec long, _label long, _n long, _comp long, n_links long, kept boolean, _first long, _keys long"
    df = spark.createDataFrame([(*r, 1, 2, 3, 4, 5, 6, 7, True, 8, 9) for r in rows], f"{SCHEMA}, {clash}").repartition(3)
    got = sorted([(r["vec_id"], r["n_links"], r["component_id"], r["kept"]) for r in vd.near_dedup(df).collect()], key=repr)
    want = brute([(i, v, lab) for i, v, lab in rows])
    assert got == sorted([(rows[k][0], n, c, rows[k][0] == c) for k, (n, c) in want.items()], key=repr)


def test_empty(spark):
    assert vd.near_dedup(spark.createDataFrame([], SCHEMA)).collect() == []
    assert vd.near_dedup(spark.createDataFrame([(1, None, None)], SCHEMA)).collect()[0]["component_id"] == 1


def test_passes_grow_slowly():
    few, many = vd.passes_for(5_000), vd.passes_for(10_000_000)
    assert few <= many <= 24
    flip = np.arccos(0.98) / np.pi
    signs = np.log2(10_000_000 / vd.WINDOW)
    assert (1 - (1 - flip) ** signs) ** many <= 1 - vd.RECALL
