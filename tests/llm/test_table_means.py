import hashlib
import math
import random

from veritwin.llm import table_means as T


def brute(rows, clusters=8, rounds=10, dims=64):
    kept = []
    for i, v in rows:
        if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) and abs(1024 * x) < T.LIMIT for x in v):
            kept.append((i, [math.floor(1024 * x) for x in v]))
    first = sorted(kept, key=lambda r: (hashlib.sha256(f"3:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))
    centres = [v for _, v in first[:clusters]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), k) for k, c in enumerate(centres))

    for _ in range(rounds):
        found = [nearest(v)[1] for _, v in kept]
        for k in set(found):
            own = [v for (_, v), f in zip(kept, found) if f == k]
            centres[k] = [sum(x) // len(own) for x in zip(*own)]
    found = [(i, *nearest(v)) for i, v in kept]
    whole, out = sum(d for _, d, _ in found), []
    for i, d, k in found:
        out.append((i, k, d, sum(e for _, e, c in found if c == k), whole, hashlib.sha256(",".join(map(str, centres[k])).encode()).hexdigest()))
    return out


def check(spark, rows, dims=64, **options):
    df = spark.createDataFrame([(i, v, "x", 1) for i, v in rows], "vec_id long, embedding array<double>, cluster string, v int").repartition(3)
    got = [tuple(r) for r in T.cluster(df, dimensions=dims, **options).collect()]
    want = brute(rows, options.get("clusters", 8), options.get("rounds", 10), dims)
    assert sorted(got, key=str) == sorted(want, key=str)
    return got


def test_equals_plain_version(spark):
    rng = random.Random(5)
    rows = [(k, [rng.gauss(k % 5, 0.3) for _ in range(64)]) for k in range(300)]
    rows += [(k, rows[3][1]) for k in range(1000, 1100)]  # copies
    odd = [(2000, None), (2001, []), (2002, [1.0] * 63), (2003, [1.0] * 65), (2004, [None] + [1.0] * 63), (2005, [float("nan")] * 64), (2006, [float("-inf")] + [0.0] * 63),
           (2007, [1e30] * 64), (2008, [0.0] * 64), (2009, [-0.0004] * 64), (None, [0.5] * 64), (None, [0.5] * 64), (7, rows[9][1])]
    got = check(spark, rows + odd, block=37)
    assert len(got) == 405 and {r[0] for r in got} >= {2008, 2009, None}


def test_ties_empty_clusters_and_large_values(spark):
    # Copies of one vector are centroids 0 and 1 or so: the smaller number takes all, the other stays empty.
    check(spark, [(k, [1.0, 2.0]) for k in range(20)] + [(k, [60000.0, -60000.0]) for k in range(20, 30)], dims=2, clusters=4, rounds=3)
    check(spark, [(1, [0.0, 0.0]), (2, [0.0, 0.1])], dims=2)


def test_empty_tables(spark):
    for rows in ([], [(1, None), (2, [1.0])]):
        df = spark.createDataFrame(rows, "vec_id string, embedding array<float>")
        out = T.cluster(df)
        assert out.count() == 0 and out.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
