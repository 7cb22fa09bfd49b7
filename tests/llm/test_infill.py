import hashlib
import re

import pytest

import __spark_entry__ as entry
from veritwin.llm import infill as I

TEXTS = [
    None, "", "\n", "\n\n", "one", "one\n", "one\ntwo", "a\n\nb\r\nc\n", "<\n<P\n>S>\nx", "holds <M> itself\nand more", "ünï\ncödé 😀\n\U0001f600", "<<\nS\nM>\n<\n",
    "x" * 300_000, "long\n" * 20_000, "same\ntext\n", "same\ntext\n",
]


def brute(doc_id, text, seed=7, rate=100, first=50):
    text = text or ""
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    line = f"{seed}:{'' if doc_id is None else doc_id}"
    h = [int(hashlib.sha256(line.encode()).hexdigest()[8 * k : 8 * k + 8], 16) for k in range(4)]
    n = len(units)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = ("".join(x) for x in (units[:a], units[a:b], units[b:]))
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h[2] % 100 >= rate:
        return n, "plain", None, None, text
    if h[3] % 100 < first:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


@pytest.mark.parametrize("options", [{}, {"rate": 40}, {"suffix_first": 0, "seed": 3}, {"suffix_first": 100}])
def test_equals_plain_version_and_comes_back(spark, options):
    rows = [(k, t, "n", "x") for k, t in enumerate(TEXTS * 4)] + [(None, "a\nb\nc", None, None), (1, "a\nb\nc\nd", "n", "x"), (1, "a\nb\nc\nd", "n", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n string, form string")
    got = I.restore(I.transform(docs, **options)).collect()
    names = {"rate": "rate", "suffix_first": "first", "seed": "seed"}
    want = [(i, *brute(i, t, **{names[k]: v for k, v in options.items()}), t or "") for i, t, *_ in rows]
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))
    assert {r.form for r in got} >= ({"plain", "spm", "psm"} if not options else {"plain"})


def test_empty_table_and_other_names(spark):
    docs = spark.createDataFrame([], "`a.b` string, text string, output string")
    out = I.restore(I.transform(docs, doc_id="a.b"))
    assert out.columns == ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output", "restored"] and out.count() == 0


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = entry.queries()["op11_fill_in_middle"](spark, sf).collect()
    assert len(rows) == len(texts)
    for r in rows:
        n, form, p, m, out = brute(r.doc_id, texts[r.doc_id])
        sha = [hashlib.sha256(x.encode()).hexdigest() for x in (out, texts[r.doc_id] or "")]
        assert (r.n, r.form, r.prefix_chars, r.middle_chars, r.output_sha256, r.restored_sha256) == (n, form, p, m, *sha)
