import random

import pytest

import corpus_pipeline as C
from tests.llm import test_decontaminate, test_neardup, test_pii
from tests.llm.test_pieces import viterbi
from veritwin.llm import language as L
from veritwin.llm import pieces as P
from veritwin.llm import pii
from veritwin.llm.common import shared_table

SF = "/root/testdata/sf0.001"
EXTRA = "doc_id long, text string, lang string, source string, n_chars long, row string, spans array<int>, score double"


def mask(text, spans):
    out, end = "", 0
    for kind, a, b in spans:
        if a >= end:
            out += text[end:a] + f"[{kind.upper()}]"
        end = max(end, b)
    return out + text[end:]


def plain(spark, docs, items):
    """The stages on lists of (doc_id, text), but for the learned parts, which are the operators' own."""
    df = spark.createDataFrame(docs, "doc_id long, text string, lang string")
    model = L.learn(df.where("crc32(cast(doc_id as string)) % 4 <> 2"))
    labels = dict(zip([d[0] for d in docs], L.Tagger(model).classify([d[1] for d in docs])))
    docs = [(i, t) for i, t, _ in docs if labels[i][0] != "und" and labels[i][1] >= C.LEAST_SHARE]
    kept = {i for i, _, _, k in test_neardup.brute(docs) if k}
    docs = [(i, t) for i, t in docs if i in kept]
    clean = {r[0] for r in test_decontaminate.brute(docs, items) if not r[5]}
    docs = [(i, t) for i, t in docs if i in clean]
    spans = {r.doc_id: [tuple(s)[:3] for s in r.spans] for r in pii.find_pii(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    for i, t in docs:
        assert set(test_pii.brute(t)) <= set(spans[i])
    docs = [(i, mask(t, spans[i])) for i, t in docs]
    table, split = P.load(), P.Splitter(False)
    return {i: [k for w in split(t) for k in viterbi(w, table)] for i, t in docs}


def test_run_equals_the_plain_version(spark):
    docs = [(r.doc_id, r.text, r.lang) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    got = C.run(spark, SF).collect()
    assert {r.doc_id: r.ids for r in got} == plain(spark, docs, items)
    assert all(r.round_trip for r in got) and 0.5 * len(docs) < len(got) < len(docs)


def test_language_stage_keeps_texts_in_several_languages(spark):
    r = random.Random(5)
    words = {"de": ["und", "der", "nicht", "haus", "wasser"], "en": ["the", "and", "house", "with", "water"], "es": ["el", "los", "casa", "agua", "pero"],
             "fr": ["les", "maison", "dans", "avec", "oui"], "pl": ["jest", "nie", "dom", "woda", "przez"]}
    text = lambda lang, n: " ".join(r.choice(words[lang]) for _ in range(n))
    rows = [(n, text(lang, 40), lang) for n, lang in enumerate(sorted(words) * 30)]
    rows += [(1000 + n, " ".join(text(lang, 40) for lang in sorted(words)), None) for n in range(5)]
    rows += [(2000, "qqq", None), (2001, "12 34", None), (2002, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = sorted(d.doc_id for d in C.language_id(spark, docs, SF).collect())
    assert got == [k for k, _, _ in rows if k not in (2001, 2002)]


def test_stages_take_odd_rows_and_keep_columns(spark):
    r = random.Random(3)
    prose = [" ".join(r.choice(["the", "house", "of", "green", "water", "moves", "slowly", "under", "stone", "bridges"]) for _ in range(60)) for _ in range(30)]
    rows = [(k, t, "en", "s", len(t), "x", [1], None) for k, t in enumerate(prose)]
    rows += [(None, None, None, None, None, None, None, None), (100, "", "en", None, 0, None, None, 1.0), (101, "12 34", None, None, 5, None, None, 1.0)]
    rows += [(200, "mail a.b@c.org or 4111111111111111 now", "en", "s", 38, "x", [2], 0.5), (None, prose[0], "en", "s", 1, "x", [], 0.0), rows[3], rows[3]]
    docs = spark.createDataFrame(rows, EXTRA)
    for _, stage in C.STAGES[:-1]:
        docs = shared_table(stage(spark, docs, SF), "test")
        assert docs.columns == [c.split(" ")[0] for c in EXTRA.split(", ")]
    left = {(d.doc_id, d.text): d for d in docs.collect()}
    assert docs.count() == 32 and (None, prose[0]) in left
    text = "mail [EMAIL] or [CARD] now"
    assert left[200, text].n_chars == len(text) and left[200, text].spans == [2]
    assert C.STAGES[-1][1](spark, docs, SF).count() == 32


@pytest.mark.parametrize("n", range(len(C.STAGES)))
def test_stages_take_an_empty_table(spark, n):
    docs = spark.createDataFrame([], EXTRA)
    assert C.STAGES[n][1](spark, docs, SF).count() == 0
