import math

import numpy as np

from furrow.llm import lattice
from tests.conftest import rows

SCHEMA = "vec_id bigint, embedding array<float>, label int, m double"


def brute(data, cosine=0.98):
    """n_links and component of each row, every pair compared."""
    ok = [k for k, r in enumerate(data) if r[1] is not None and r[2] is not None and len(r[1]) and all(x is not None and math.isfinite(x) for x in r[1]) and any(r[1])]
    x = {k: np.array(data[k][1], dtype=np.float32).astype(float) for k in ok}
    x = {k: v / np.abs(v).max() for k, v in x.items()}
    parent, n = list(range(len(data))), [0] * len(data)

    def top(k):
        while parent[k] != k:
            k = parent[k]
        return k

    for p, i in enumerate(ok):
        for j in ok[p + 1 :]:
            if data[i][2] == data[j][2] and len(x[i]) == len(x[j]) and x[i] @ x[j] / np.linalg.norm(x[i]) / np.linalg.norm(x[j]) >= cosine:
                n[i], n[j] = n[i] + 1, n[j] + 1
                parent[top(i)] = top(j)
    ids = {}
    for k, r in enumerate(data):
        ids.setdefault(top(k), []).append(r[0])
    least = {t: min((v for v in own if v is not None), default=None) for t, own in ids.items()}
    return sorted(((r[0], n[k], least[top(k)] if k in x else r[0], r[0] == (least[top(k)] if k in x else r[0])) for k, r in enumerate(data)), key=repr)


def around(rng, v, angle):
    """A unit vector at the angle from the unit vector v."""
    w = rng.normal(size=len(v))
    w -= (w @ v) * v
    return math.cos(angle) * v + math.sin(angle) * w / np.linalg.norm(w)


def unit(rng, dim=24):
    v = rng.normal(size=dim)
    return v / np.linalg.norm(v)


def test_nearest_lattice_point():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(300, 8)) * 2
    got = lattice.nearest_e8(x)
    doubled = np.rint(2 * got)
    assert np.allclose(2 * got, doubled) and all(len(set(r % 2)) == 1 for r in doubled) and (got.sum(axis=1) % 2 == 0).all()
    assert (np.linalg.norm(x - got, axis=1) <= 1 + 1e-9).all()  # the covering radius
    for v in lattice._SHORTEST:
        assert (np.linalg.norm(x - got, axis=1) <= np.linalg.norm(x - got - v, axis=1) + 1e-9).all()
    assert len(np.unique(lattice._SHORTEST, axis=0)) == 240 and np.allclose((lattice._SHORTEST**2).sum(axis=1), 2)


def test_cells_do_not_depend_on_the_batch():
    rng = np.random.default_rng(2)
    x = np.array([unit(rng) for _ in range(200)])
    own, near = lattice.all_cells(x)
    one = [lattice.all_cells(x[k : k + 1]) for k in range(len(x))]
    assert (own == np.concatenate([o for o, _ in one])).all() and (near == np.concatenate([p for _, p in one])).all()


def test_as_brute_force(spark):
    rng = np.random.default_rng(3)
    data, k = [], 0
    for label in (0, 1):
        for _ in range(40):
            data.append([k, unit(rng).tolist(), label, 1.0])
            k += 1
        lead = unit(rng)
        for a in np.linspace(0.01, 0.12, 40):  # near copies around one vector, some pairs above and some below the angle
            data.append([k, (3 * around(rng, lead, a)).tolist(), label, 1.0])
            k += 1
        for _ in range(30):
            data.append([k, lead.tolist(), label, 1.0])
            k += 1
    copy = data[0][1]
    data += [[k, copy, 1, 1.0], [k + 1, None, 0, 1.0], [k + 2, [], 0, 1.0], [k + 3, [0.0] * 24, 0, 1.0], [k + 4, [None, *copy[1:]], 0, 1.0],
             [k + 5, [float("nan"), *copy[1:]], 0, 1.0], [k + 6, [float("inf"), *copy[1:]], 0, 1.0], [k + 7, copy, None, 1.0], [None, copy, 0, 1.0],
             [None, copy, 0, 1.0], [5, data[5][1], 0, 1.0], [k + 8, [2.0, 1.0], 0, 1.0], [k + 9, [4.0, 2.0], 0, 1.0], [k + 10, [1e30, 0.0], 7, 1.0],
             [k + 11, [1e-30, 0.0], 7, 1.0]]
    got = rows(lattice.links(spark.createDataFrame([tuple(r) for r in data], SCHEMA)), "vec_id", "n_links", "component_id", "kept")
    want = brute(data)
    missed = sum(w[1] for w in want) - sum(g[1] for g in got)
    assert 0 <= missed <= 0.02 * sum(w[1] for w in want)
    assert [g[0::2] for g in got] == [w[0::2] for w in want] and all(g[1] <= w[1] for g, w in zip(got, want, strict=True))


def test_recall_at_the_threshold(spark):
    rng = np.random.default_rng(4)
    data = []
    for k in range(400):
        v = unit(rng, 64)
        data += [(2 * k, v.tolist(), 0, 1.0), (2 * k + 1, around(rng, v, math.acos(0.9805)).tolist(), 0, 1.0)]
    got = rows(lattice.links(spark.createDataFrame(data, SCHEMA)), "vec_id", "n_links")
    assert sum(n for _, n in got) >= 0.93 * 800 and max(n for _, n in got) == 1


def test_crowded_cells_are_tiled(spark, monkeypatch):
    monkeypatch.setattr(lattice, "TILE", 8)
    monkeypatch.setattr(lattice, "BALL_ROUNDS", 1)
    rng = np.random.default_rng(5)
    lead = unit(rng)
    data = [[k, around(rng, lead, 0.03 if k < 80 else 0.15).tolist(), 0, 1.0] for k in range(120)]
    got = rows(lattice.links(spark.createDataFrame([tuple(r) for r in data], SCHEMA)), "vec_id", "n_links", "component_id", "kept")
    want = brute(data)
    assert [g[0::2] for g in got] == [w[0::2] for w in want]
    assert sum(g[1] for g in got) >= 0.98 * sum(w[1] for w in want) and all(g[1] <= w[1] for g, w in zip(got, want, strict=True))


def test_empty(spark):
    assert rows(lattice.links(spark.createDataFrame([], SCHEMA))) == []
