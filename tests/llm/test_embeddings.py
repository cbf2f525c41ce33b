import numpy as np
import pytest

from tilelake.llm import embeddings as e


def brute(rows, threshold=0.98):
    n = len(rows)
    ok = [lab is not None and v is not None and len(v) > 0 and all(x is not None and np.isfinite(x) for x in v) and any(v) for _, v, lab in rows]
    root, links = list(range(n)), [0] * n

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(n):
        for j in range(i):
            if ok[i] and ok[j] and rows[i][2] == rows[j][2] and len(rows[i][1]) == len(rows[j][1]):
                a, b = np.array(rows[i][1], float), np.array(rows[j][1], float)
                if a @ b / (np.sqrt(a @ a) * np.sqrt(b @ b)) >= threshold:
                    links[i] += 1
                    links[j] += 1
                    root[find(i)] = find(j)
    low = {}
    for i, r in enumerate(rows):
        low[find(i)] = min(low.get(find(i), r[0]), r[0])
    return sorted((r[0], links[i], low[find(i)], r[0] == low[find(i)]) for i, r in enumerate(rows))


@pytest.mark.parametrize("tile,kind", [(7, "float"), (512, "float"), (7, "double")])
def test_against_brute_force(spark, tile, kind):
    rng = np.random.default_rng(tile)
    rows = []
    for label in (0, 1, None):
        for _ in range(12):
            base = rng.normal(size=20)
            for k in range(rng.integers(1, 9)):
                v = base + rng.normal(size=20) * rng.choice([0, 0.02, 0.15, 0.2])
                rows.append((len(rows), v.astype(np.float32).tolist(), label))
    rows += [(1000, None, 0), (1001, [], 0), (1002, [0.0] * 20, 0), (1003, [1.0, None] + [0.0] * 18, 0), (1004, [float("nan")] * 20, 0), (1005, [float("inf")] * 20, 0)]
    rows += [(1006, [1.0, 0.0, 0.0], 0), (1007, [2.0, 0.0, 0.0], 0), (1008, [-1.0, 0.0, 0.0], 0), (1009, [1e-30, 1e-30, 0.0], 1), (1010, [3.0, 3.0, 0.0], 1)]
    rows.append((2000, rows[0][1], rows[0][2]))
    df = spark.createDataFrame([(*r, 9) for r in rows], f"vec_id long, embedding array<{kind}>, label int, cid int")
    got = sorted(tuple(r) for r in e.near_duplicates(df, tile=tile).collect())
    exact = [(i, None if v is None else [None if x is None else float(np.float32(x)) if kind == "float" else x for x in v], lab) for i, v, lab in rows]
    assert got == brute(exact)


def test_empty(spark):
    assert e.near_duplicates(spark.createDataFrame([], "vec_id long, embedding array<float>, label int")).count() == 0


def test_bounds_never_lose_a_pair():
    rng = np.random.default_rng(3)
    x = e.unit(np.repeat(rng.normal(size=(30, 64)), 8, axis=0) + 0.12 * rng.normal(size=(240, 64)))
    turn = np.linalg.eigh(x.T @ x)[1][:, ::-1]
    i, j = e.linked(x @ turn, x @ turn, x, x, 0.98)
    c = (x @ x.T) >= 0.98
    assert set(zip(i.tolist(), j.tolist())) == set(zip(*(v.tolist() for v in np.nonzero(c)))) and 240 < len(i) < 57600


@pytest.mark.parametrize("threshold", [0.5, 0.9, 0.98, 1.0])
def test_tiles_meet_once_and_as_all_pairs_say(spark, threshold):
    rng = np.random.default_rng(5)
    at = np.round(rng.uniform(-1, 1, (60, e.BOX)), 2)
    wide = rng.choice([0, 0.01, 0.1, 0.6], (60, e.BOX))
    rows = [(k << 32, k % 2, 20, at[k].tolist(), np.minimum(1, at[k] + wide[k]).tolist()) for k in range(60)]
    got = sorted(tuple(r) for r in e.meeting(spark.createDataFrame(rows, "tile long, label int, dim int, lo array<double>, hi array<double>"), threshold).collect())
    gap = lambda a, b: sum(max(0, p - s, r - q) ** 2 for p, q, r, s in zip(a[3], a[4], b[3], b[4]))
    assert got == sorted((a[0], b[0]) for a in rows for b in rows if a[0] <= b[0] and a[1] == b[1] and gap(a, b) <= 2 - 2 * threshold + 1e-6)
