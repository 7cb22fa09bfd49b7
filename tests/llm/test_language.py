import itertools
import random
import zlib

import numpy as np

from veritwin.llm import language as L

SF = "/root/testdata/sf0.01"


def brute_posteriors(emissions, transitions):
    n, k = emissions.shape
    out = np.zeros((n, k))
    for path in itertools.product(range(k), repeat=n):
        score = sum(emissions[t, s] for t, s in enumerate(path)) + sum(transitions[a, b] for a, b in zip(path, path[1:]))
        weight = np.exp(score) * np.exp(transitions[:, path[0]]).sum()
        for t, s in enumerate(path):
            out[t, s] += weight
    return out / out.sum(1, keepdims=True)


def test_forward_backward_equals_all_paths(monkeypatch):
    rng = np.random.default_rng(2)
    lengths = np.array([1, 7, 3, 8, 2])
    emissions = rng.normal(size=(lengths.sum(), 3)).astype(np.float32) * 2
    transitions = rng.normal(size=(3, 3)).astype(np.float32)
    for block in (2, 3, 128):
        monkeypatch.setattr(L, "BLOCK", block)
        got, _ = L.posteriors(emissions, lengths, transitions)
        at = 0
        for n in lengths:
            assert np.allclose(got[at : at + n], brute_posteriors(emissions[at : at + n], transitions), atol=2e-4)
            at += n


def test_code_switched_text():
    r = random.Random(1)
    make = lambda parts: " ".join("".join(r.choice(parts) for _ in range(r.randrange(1, 4))) for _ in range(200))
    a, b = ["ka", "ro", "mi"], ["ung", "sch", "keit"]
    model = L.train([("aa", make(a)) for _ in range(20)] + [("bb", make(b)) for _ in range(20)], steps=60)
    tagger = L.Tagger(model)
    first, second = L.words_of(make(a))[:30], L.words_of(make(b))[:30]
    labels = tagger.word_posteriors([first + second]).argmax(1)
    assert (labels == [0] * 30 + [1] * 30).mean() > 0.95
    assert tagger.classify(["karo romi", None, "", "12 !!", "schung keit"])[1:4] == [("und", 0.0)] * 3
    long = tagger.classify([" ".join(first * 3000 + second * 1000)])[0]
    assert long[0] == "aa" and abs(long[1] - 0.75) < 0.02


def test_held_out_accuracy_and_rows(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").withColumnRenamed("n_chars", "score")
    rows = {r.doc_id: r for r in docs.collect()}
    train = docs.where("crc32(cast(doc_id as string)) % 4 <> 2")
    model = L.learn(train)
    got = L.identify(docs, model).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)
    held = [r for r in got if zlib.crc32(str(r.doc_id).encode()) % 4 == 2]
    assert sum(r.lang_pred == rows[r.doc_id].lang for r in held) / len(held) > 0.97
    odd = spark.createDataFrame([(None, None, "x"), (1, "", "en"), (1, "", "en"), (2, "7 8", None)], "doc_id long, text string, lang string")
    assert sorted((str(r.doc_id), r.lang_pred) for r in L.identify(odd, model).collect()) == [("1", "und"), ("1", "und"), ("2", "und"), ("None", "und")]
    assert L.identify(odd.limit(0), model).count() == 0
    assert {r.lang_pred for r in L.identify(docs, L.learn(odd.limit(0))).collect()} == {"und"}


def test_only_letters_are_words():
    assert L.words_of("½ ² 3 Ⅷ ٣ _") == [] and L.words_of("Straße2x ½é") == ["straße", "x", "é"]
    model = L.train([("aa", "karo miro " * 20), ("bb", "schung keit " * 20)], steps=20)
    assert L.Tagger(model).classify(["½ ² 3"]) == [("und", 0.0)]
