import itertools
import math

import numpy as np
import pytest

from gatewatch.llm import lattice as l8
from gatewatch.llm.common import table


def test_decoder_finds_the_nearest_point():
    rng = np.random.default_rng(0)
    around = np.concatenate([np.zeros((1, 8)), l8.shortest_vectors()])
    assert len(around) == 241
    x = rng.uniform(-3, 3, (500, 8))
    got = l8.decode_e8(x)
    assert all(len({float(v) % 1 for v in p}) == 1 and p.sum() % 2 == 0 for p in got)
    best = ((x[:, None, :] - (got[:, None, :] + around[None])) ** 2).sum(2)
    assert (best.argmin(1) == 0).all()


def brute(rows, threshold):
    fine = [(i, np.array(v, float)) for i, v in rows if i is not None and v and None not in v and np.isfinite(v).all() and np.any(v)]
    links = {k: set() for k in range(len(fine))}
    for (a, (_, x)), (b, (_, y)) in itertools.combinations(enumerate(fine), 2):
        if len(x) == len(y) and x @ y / np.linalg.norm(x) / np.linalg.norm(y) >= threshold:
            links[a].add(b)
            links[b].add(a)
    return fine, links


def roots(fine, links):
    low = [i for i, _ in fine]
    for _ in fine:
        low = [min([low[a], *(low[b] for b in links[a])]) for a in range(len(low))]
    return low


def planted(n, threshold_near, seed=0, dim=64):
    rng = np.random.default_rng(seed)
    x = rng.standard_normal((n, dim))
    x /= np.linalg.norm(x, axis=1)[:, None]
    z = rng.standard_normal((n, dim))
    z -= (z * x).sum(1)[:, None] * x
    z /= np.linalg.norm(z, axis=1)[:, None]
    return np.concatenate([x, threshold_near * x + math.sqrt(1 - threshold_near**2) * z]).astype(np.float32)


def test_recall_at_the_threshold(spark):
    v = planted(1500, 0.905)
    unit = v / np.linalg.norm(v, axis=1)[:, None]
    want = int((np.triu(unit.astype(float) @ unit.T.astype(float), 1) >= 0.9).sum())
    df = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)], "vec_id long, embedding array<float>")
    got = sum(r.n_links for r in l8.embedding_groups(df).collect()) / 2
    assert want >= 1500 and 0.95 * want <= got <= want


@pytest.mark.parametrize("max_cell", [7, 4096])
def test_dense_groups_count_each_link_once(spark, max_cell):
    rng = np.random.default_rng(3)
    rows = []
    for c in range(4):
        centre = rng.standard_normal(16)
        rows += [(len(rows) + k, (centre + 0.12 * rng.standard_normal(16)).tolist()) for k in range(30)]
    rows += [(900 + k, rows[0][1]) for k in range(25)]  # copies
    rows += [(800, [2 * x for x in rows[40][1]])]  # a multiple is no copy but links
    rows += [(700, None), (701, [0.0] * 16), (702, [math.nan] * 16), (703, [1.0, None] + [0.0] * 14), (704, []), (None, rows[0][1]),
             (705, [math.inf] + [0.0] * 15), (706, rows[0][1][:8])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").selectExpr("*", "1 as component", "2 as n_links")
    got = {r.id: (r.n_links, r.component) for r in l8.embedding_groups(df, recall=0.9999, max_cell=max_cell).collect()}
    fine, links = brute(rows, 0.9)
    low = roots(fine, links)
    want = {i: (0, i) for i, _ in rows} | {i: (len(links[a]), low[a]) for a, (i, _) in enumerate(fine)}
    assert got == want


def test_query_equals_brute_force(spark, sf_small):
    rows = [(r.vec_id, r.embedding) for r in table(spark, sf_small, "embeddings").collect()]
    got = {r.vec_id: r for r in l8.op4_embedding_near_dedup(spark, sf_small).collect()}
    v = np.array([x for _, x in rows], float)
    v /= np.linalg.norm(v, axis=1)[:, None]
    near = v @ v.T >= 0.9
    want = near.sum(1) - 1
    assert len(got) == len(rows)
    have = np.array([got[i].n_links for i, _ in rows])
    assert (have <= want).all() and have.sum() >= 0.95 * want.sum()
    assert all(r.kept == (r.vec_id == r.component_id) for r in got.values())


def test_empty_table(spark):
    df = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert l8.embedding_groups(df).count() == 0


def test_recall_holds_for_any_number_of_vectors():
    v = planted(4000, 0.9, seed=8).astype(float)
    x, y = v[:4000], v[4000:]
    for n in (50_000, 10**9, 10**10):
        scale, tables = l8.parameters(n, 0.9, 4, 0.99)
        planes = l8.projections(64, 12, seed=101)
        found = l8.meet(l8.cell_keys(x, planes, scale, 4), l8.cell_keys(y, planes, scale, 4)).mean()
        assert tables < 1000 and 1 - (1 - found) ** tables > 0.97, n
