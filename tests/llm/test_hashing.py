import numpy as np

from veritwin.llm import hashing as H


def brute(rows):
    """rows: (id, vector, label)."""
    good = [r for r in rows if r[0] is not None and r[2] is not None and r[1] and all(c is not None and np.isfinite(c) for c in r[1]) and any(r[1])]
    links = {r[0]: 0 for r in rows}
    root = {r[0]: r[0] for r in rows}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for label, dims in {(r[2], len(r[1])) for r in good}:
        own = [r for r in good if (r[2], len(r[1])) == (label, dims)]
        x = H.unit(np.array([r[1] for r in own], np.float64))
        for p, q in zip(*np.nonzero(np.triu(x @ x.T >= H.COSINE, 1))):
            a, b = own[p][0], own[q][0]
            links[a] += 1
            links[b] += 1
            a, b = sorted((find(a), find(b)))
            root[b] = a
    return {i: (n, find(i)) for i, n in links.items()}


def near(rng, centre, spread, n):
    return centre + spread * rng.normal(size=(n, len(centre))) / np.sqrt(len(centre)) * np.linalg.norm(centre)


def check(spark, rows, **options):
    df = spark.createDataFrame([(i, v, lab, "x", 1) for i, v, lab in rows], "vec_id long, embedding array<float>, label int, rep string, key int")
    exact = [(r.vec_id, r.embedding, r.label) for r in df.collect()]
    return brute(exact), {r.vec_id: (r.n_links, r.component_id, r.kept) for r in H.near_vectors(df, **options).collect()}


def test_groups_copies_and_odd_rows(spark):
    rng = np.random.default_rng(4)
    rows, n = [], 0
    for k in range(12):
        centre = rng.normal(size=64)
        for v in near(rng, centre, 0.12, 25):
            rows.append((n, v.tolist(), k % 3))
            n += 1
    rows += [(n + k, rows[7][1], 0) for k in range(60)]  # copies
    rows += [(n + 100 + k, near(rng, np.array(rows[7][1]), 0.1, 1)[0].tolist(), 0) for k in range(40)]
    rows += [(n + 200 + k, rng.normal(size=8).tolist(), 0) for k in range(20)] + [(n + 300, rows[-1][1][:1] * 8, 0)]
    odd = [(9000, None, 0), (9001, [], 0), (9002, [0.0] * 64, 0), (9003, [float("nan")] * 64, 0), (9004, [float("inf")] * 64, 0),
           (9005, rows[0][1], None), (9006, [None] + rows[0][1][1:], 0), (9007, [1e-30 * x for x in rows[7][1]], 0), (9008, [1e30 * x for x in rows[7][1]], 0)]
    rows += odd
    for block in (512, 16):
        want, got = check(spark, rows, block=block)
        assert set(got) == set(want)
        assert all(got[i][0] == 0 and got[i][1] == i and got[i][2] for i in range(9000, 9007))
        found, real = sum(n for n, _, _ in got.values()), sum(n for n, _ in want.values())
        assert all(got[i][0] <= want[i][0] for i in want)
        assert found / real > 0.97
        assert sum(got[i][1] == want[i][1] for i in want) / len(want) > 0.97


def test_recall_on_given_vectors(spark):
    rows = [(r.vec_id, r.embedding, r.label) for r in spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").collect()]
    rng = np.random.default_rng(1)
    rows += [(100_000 + k, near(rng, np.array(rows[k][1]), s, 1)[0].tolist(), rows[k][2]) for k, s in zip(range(600), np.linspace(0.05, 0.38, 600))]
    want, got = check(spark, rows)
    found, real = sum(n for n, _, _ in got.values()), sum(n for n, _ in want.values())
    assert real > 500 and all(got[i][0] <= want[i][0] for i in want)
    assert found / real >= 0.95


def test_rotation_balances_and_keeps_neighbours():
    rng = np.random.default_rng(2)
    x = H.unit(rng.normal(size=(3000, 64)) * np.linspace(3, 0.2, 64))
    codes = np.unpackbits(H.encode(x, H.learn_rotation(x)), axis=1)
    assert codes.shape == (3000, 64) and abs(codes.mean(0) - 0.5).max() < 0.1
    y = H.unit(near(rng, x[0], 0.1, 50))
    assert (np.unpackbits(H.encode(y, H.learn_rotation(x)), axis=1) != codes[0]).sum(1).mean() < 8


def test_repeated_rows_null_ids_and_empty_table(spark):
    v = [1.0, 2.0, 3.0]
    df = spark.createDataFrame([(1, v, 0), (1, v, 0), (2, v, 0), (None, v, 0), (3, v, 1)], "vec_id long, embedding array<double>, label int")
    got = sorted(map(tuple, H.near_vectors(df).collect()), key=str)
    assert got == [(1, 2, 1, True), (1, 2, 1, True), (2, 2, 1, False), (3, 0, 3, True), (None, 0, None, True)]
    assert H.near_vectors(df.limit(0)).count() == 0
