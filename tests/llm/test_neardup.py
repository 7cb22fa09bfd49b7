import itertools
import random
import re

import numpy as np
import pytest

from veritwin.llm import neardup as N
from veritwin.llm.components import components

SF = "/root/testdata/sf0.001"


def brute(rows):
    sets = {}
    for i, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        sets[i] = {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set()
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in itertools.combinations(sorted(sets), 2):
        common = len(sets[a] & sets[b])
        if common and 100 * common >= 75 * (len(sets[a]) + len(sets[b]) - common):
            x, y = sorted((find(a), find(b)))
            root[y] = x
    return sorted((i, len(s), find(i), find(i) == i) for i, s in sets.items())


def test_superminhash_estimates_jaccard():
    r = np.random.default_rng(1)
    errors = []
    for _ in range(60):
        pool = r.integers(0, 2**63, 400, dtype=np.uint64)
        a, b = np.unique(pool[:300]), np.unique(pool[100:])
        s = N.superminhash([a, b], 240)
        errors.append((s[0] == s[1]).mean() - len(np.intersect1d(a, b)) / len(np.union1d(a, b)))
    assert abs(np.mean(errors)) < 0.015 and np.std(errors) < np.sqrt(0.25 / 240)


def test_every_slot_once_per_element_and_blocks_agree(monkeypatch):
    one = N.superminhash([np.array([7], np.uint64)], 60)[0]
    assert sorted(one.astype(int)) == list(range(60))
    sets = [np.unique(np.random.default_rng(k).integers(0, 2**63, n, dtype=np.uint64)) for k, n in enumerate((1, 5, 900, 3, 50))]
    whole = N.superminhash(sets, 60)
    monkeypatch.setattr(N, "ELEMENTS", 40)
    assert (N.superminhash(sets, 60) == whole).all()


def test_components(spark):
    r = random.Random(3)
    edges = [(r.randrange(300), r.randrange(300)) for _ in range(220)] + [(1000, k) for k in range(1001, 1400)] + [(k, k + 1) for k in range(2000, 2100)]
    root = {x: x for e in edges for x in e}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        x, y = sorted((find(a), find(b)))
        root[y] = x
    got = {tuple(x) for x in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {(x, find(x)) for e in edges if e[0] != e[1] for x in e}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def chains(seed):
    """Copies, chains of edits, texts that share a passage, short and empty texts."""
    r = random.Random(seed)
    word = lambda: "w%d" % r.randrange(4000)
    rows, passage = [], [word() for _ in range(30)]
    for _ in range(40):
        text = [word() for _ in range(r.choice([3, 5, 8, 40, 120]))]
        for _ in range(r.choice([1, 1, 2, 6, 12])):
            rows.append(" ".join(text).upper() if r.random() < 0.2 else "\n".join(text))
            text = list(text)
            for _ in range(r.choice([0, 1, 2])):
                text[r.randrange(len(text))] = word()
    rows += [" ".join([word() for _ in range(r.randrange(10, 40))] + passage) for _ in range(60)]
    r.shuffle(rows)
    return [(k * 3 + 1, t) for k, t in enumerate(rows)] + [(900, None), (901, ""), (902, " \n "), (903, "a"), (904, "A"), (905, "a b c d e"), (906, "x " * 300_000)]


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_brute_force(spark, seed):
    rows = chains(seed)
    df = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id long, text string, rep string, key int")
    assert sorted(map(tuple, N.near_duplicates(df).collect())) == brute(rows)


def test_given_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert sorted(map(tuple, N.near_duplicates(docs).collect())) == brute([(r.doc_id, r.text) for r in docs.collect()])


def test_repeated_rows_null_ids_and_empty_table(spark):
    rows = [(5, "a b c d e f"), (5, "a b c d e f"), (7, "A b c d e f"), (None, "a b c d e f"), (9, "q")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(map(tuple, N.near_duplicates(df).collect()), key=str)
    assert got == [(5, 2, 5, True), (5, 2, 5, True), (7, 2, 5, False), (9, 1, 9, True), (None, 2, None, True)]
    assert N.near_duplicates(df.limit(0)).count() == 0
