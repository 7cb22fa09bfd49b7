import random

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from veritwin.operators import matching as m
from veritwin.operators import ordered
from veritwin.operators.ordered import fill_forward, keep_one, number_within
from veritwin.session import cut

ROWS = "pair_id string, id int, ord int, name string, code string"


def side(spark, rows):
    return spark.createDataFrame([("p", i, i, n, c) for i, n, c in rows], ROWS)


def brute_ladder(s, t, keys):
    """The rule itself: unique on both sides among what is left, pass by pass."""
    s, t, out = list(s), list(t), []
    for basis, key in keys:
        def index(rows):
            found = {}
            for r in rows:
                if key(r):
                    found.setdefault(key(r), []).append(r)
            return {k: v[0] for k, v in found.items() if len(v) == 1}

        a, b = index(s), index(t)
        hits = [(a[k], b[k]) for k in a if k in b]
        out += [(x[0], y[0], basis) for x, y in hits]
        s = [r for r in s if r not in [h[0] for h in hits]]
        t = [r for r in t if r not in [h[1] for h in hits]]
    return out, s, t


def test_ladder_equals_the_rule(spark):
    rnd = random.Random(7)
    words = ["Order", "order", "ORDERS", "item", "Items", "", "Line No", "line_no"]
    s = [(i, rnd.choice(words), rnd.choice(["A", "B", "C", "D", "E", "F", ""]) + str(rnd.randrange(3))) for i in range(40)]
    t = [(i, rnd.choice(words), rnd.choice(["A", "B", "C", "D", "E", "G", ""]) + str(rnd.randrange(3))) for i in range(40)]

    def norm(x):
        x = "".join(c for c in x if c.isalnum()).upper()
        return x[:-1] if len(x) > 3 and x.endswith("S") else x

    keys = [("code", lambda r: r[2].upper()), ("name", lambda r: r[1].upper()), ("normalized name", lambda r: norm(r[1])),
            ("normalized code", lambda r: norm(r[2])), ("name↔code", lambda r: norm(r[2] or r[1]))]
    want, s_rest, t_rest = brute_ladder(s, t, keys)
    got = m.match_ladder(side(spark, s), side(spark, t), ["pair_id"], m.name_code_keys())
    assert sorted((r.s_id, r.t_id, r.basis) for r in got.pairs.collect()) == sorted(want)
    assert sorted(r.s_id for r in got.s_only.collect()) == sorted(r[0] for r in s_rest)
    assert sorted(r.t_id for r in got.t_only.collect()) == sorted(r[0] for r in t_rest)


def test_ladder_does_not_depend_on_partitions(spark):
    rows = [(i, f"name {i % 30}", f"c{i}") for i in range(100)]
    other = [(i, f"NAME_{i % 30}", f"c{i}" if i % 3 else f"x{i}") for i in range(100)]
    results = []
    for n in ("1", "8"):
        spark.conf.set("spark.sql.shuffle.partitions", n)
        got = m.match_ladder(side(spark, rows), side(spark, other), ["pair_id"], m.name_code_keys())
        results.append(sorted(tuple(r) for r in got.pairs.collect()))
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert results[0] == results[1]


def test_ladder_over_sort_merge_joins_on_the_scope(spark, tmp_path):
    """The sides come from joins on the scope that are planned as sort-merge joins and run as broadcast joins or not."""
    rows = spark.range(3000).selectExpr("concat('B', id % 25) AS pair_id", "concat('e', id) AS id", "concat('P', id) AS code", "concat('N', id) AS name", "repeat(sha2(string(id), 256), 4) AS more")
    rows.write.parquet(str(tmp_path / "rows"))
    good = cut(spark.range(25).selectExpr("concat('B', id) AS pair_id"))
    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        for threshold in ("-1", kept):
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
            s, t = (spark.read.parquet(str(tmp_path / "rows")).join(good, ["pair_id"], "left_semi") for _ in "st")
            got = m.match_ladder(s, t, ["pair_id"], m.name_code_keys())
            assert (got.pairs.where("s_id = t_id and basis = 'code'").count(), got.s_only.count(), got.t_only.count()) == (3000, 0, 0)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)


def test_blocks_number_like_a_window(spark, monkeypatch):
    rows = spark.range(5000).select((F.col("id") % 3 % 2).alias("g"), (F.col("id") * 7919 % 5003).alias("o"))
    plain = rows.withColumn("rn", F.row_number().over(W.partitionBy("g").orderBy("o")))
    for size in (ordered.BLOCK_ROWS, 300):
        monkeypatch.setattr(ordered, "BLOCK_ROWS", size)
        assert sorted(plain.collect()) == sorted(number_within(rows, ["g"], ["o"]).collect())


def test_blocks_fill_forward_like_a_window(spark, monkeypatch):
    rows = spark.range(4000).select(
        (F.col("id") % 7 == 0).cast("int").alias("g"), (F.col("id") * 7919 % 4001).alias("o"),
        F.when(F.col("id") % 97 == 0, F.col("id")).alias("v"))
    plain = rows.withColumn("w", F.last("v", ignorenulls=True).over(W.partitionBy("g").orderBy("o")))
    key = lambda r: (r.g, r.o)
    for size in (ordered.BLOCK_ROWS, 300):
        monkeypatch.setattr(ordered, "BLOCK_ROWS", size)
        assert sorted(plain.collect(), key=key) == sorted(fill_forward(rows, ["g"], ["o"], "v", "w").collect(), key=key)


def test_keep_one_drops_rows_before_the_shuffle(spark):
    rows = spark.range(1000).select((F.col("id") % 2).alias("g"), F.col("id").alias("o"))
    df = keep_one(rows, ["g"], [F.desc("o")])
    assert "WindowGroupLimit" in df._jdf.queryExecution().executedPlan().toString()
    assert sorted((r.g, r.o) for r in df.collect()) == [(0, 998), (1, 999)]


def test_match_multiset_counts_objects(spark):
    s = spark.createDataFrame([("a", 1), ("a", 2), ("a", 3), ("b", 1)], "sig string, ord int")
    t = spark.createDataFrame([("a", 9), ("c", 1)], "sig string, ord int")
    rows = m.match_multiset(s, t, ["sig"], ["ord"], ["ord"]).groupBy("sig", "status").count().collect()
    assert sorted(map(tuple, rows)) == [("a", "MATCHED", 1), ("a", "MISSING", 2), ("b", "MISSING", 1), ("c", "EXTRA", 1)]


def test_claim_first_pairs_twins_one_to_one(spark):
    s = side(spark, [(1, "UNIT_OF_MEASURE", "UNIT OF MEASURES"), (2, "Unit Of Measure", "UNIT_OF_MEASURE"), (3, "Alone", "A")])
    t = side(spark, [(7, "unit of measure", "X"), (8, "Units of Measures", "unit_of_measure"), (9, "A", "b")])
    got = {(r.s_id, r.t_id) for r in m.claim_first(s, t, ["pair_id"]).collect()}
    assert got == {(1, 7), (2, 8), (3, 9)}


def test_explain_extra_by_prefix_prefers_the_full_token(spark):
    extra = spark.createDataFrame(
        [("p", "DISTRIBUTOR", 1, "Customer Master ID", "CUSTOMER_MASTER_ID"), ("p", "DISTRIBUTOR", 2, "Customer Grp", "CUSTOMER_X"),
         ("p", "DISTRIBUTOR", 3, "Weight", "WEIGHT")], "pair_id string, owner string, id int, name string, code string")
    partners = spark.createDataFrame([("p", "DISTRIBUTOR", "Customer Group"), ("p", "DISTRIBUTOR", "Customer Master")], "pair_id string, owner string, partner string")
    got = {r.id: (r.reason, r.partner) for r in m.explain_extra_by_prefix(extra, partners, ["pair_id"]).collect()}
    assert got == {1: ("FK_PROPAGATED", "Customer Master"), 2: ("POSSIBLY_FK", "Customer Master"), 3: ("UNEXPLAINED", None)}


def test_tiered_claims_are_exclusive(spark):
    s = side(spark, [(1, "A", "X"), (2, "B", "X"), (3, "c ", "Q")])
    t = side(spark, [(7, "Z", "X"), (8, "C", "R")])
    got = {r.s_id: (r.tier, r.t_id) for r in m.match_tiered(s, t, ["pair_id"]).collect()}
    assert got == {1: (2, 7), 2: (None, None), 3: (3, 8)}


def test_large_groups_do_not_travel_to_one_task(spark, monkeypatch):
    monkeypatch.setattr(ordered, "BLOCK_ROWS", 20)
    rows = spark.createDataFrame([("a" if i % 3 else "b", i) for i in range(300)], "g string, i int")
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = number_within(rows, ["g"], ["i"])
        plan = out._jdf.queryExecution().executedPlan().toString()
        got = {(r.g, r.i): r.rn for r in out.collect()}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    assert "SortMergeJoin" not in plan and "ShuffledHashJoin" not in plan
    for g in "ab":
        assert [rn for (x, _), rn in sorted(got.items()) if x == g] == list(range(1, 1 + sum(x == g for x, _ in got)))


def test_later_keys_are_not_computed_for_rows_of_the_first_pass(spark):
    s, t = (side(spark, [(1, "x", "A"), (2, n, "")]) for n in ("y", "Y"))
    first, then = F.col("code"), F.when(F.col("code") == "A", F.raise_error(F.lit("matched before"))).otherwise(F.upper("name"))
    found = m.match_ladder(s, t, ["pair_id"], [("code", first, first), ("name", then, then)])
    assert {(r.s_id, r.t_id, r.basis) for r in found.pairs.collect()} == {(1, 1, "code"), (2, 2, "name")}
    assert found.s_only.isEmpty() and found.t_only.isEmpty()
