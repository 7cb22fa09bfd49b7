import glob
import tracemalloc
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import __spark_entry__ as entry
from veritwin.llm import orc_ids as O

PATH = public_tokenizers.path("byte_bpe_50k.json")
MODEL = Tokenizer.from_file(PATH)
ENCODER = O.Encoder(PATH)


def plain(text):
    return [*MODEL.encode(text or "", add_special_tokens=False).ids, 0]


TEXTS = [
    None, "", " ", "  ", "\n", "a", " a", "a ", "a  b", "a \n b", "it's  we'll 've", "x\x1c y\x85 z\xa0 w　 v", "tab\t word", "ünï cödé 😀 \U0001f600x", "<|endoftext|> and <|endoftext|>",
    "a <|endoftext|>\n b", "12 34 5.6, ---", "word " * 3000, "y" * 5000, "line one\nline two\n\n  indented  twice\n", "same", "same", "​     x",
]


def test_ids_of_odd_texts():
    assert [i.tolist() for part in O.encoded(ENCODER, TEXTS) for i in part] == [plain(t) for t in TEXTS]
    assert [i.tolist() for part in O.encoded(ENCODER, TEXTS, size=7) for i in part] == [plain(t) for t in TEXTS]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(alphabet=st.one_of(st.sampled_from(" \n\t\x1c\x85\xa0 ab'sé1,<|>"), st.characters(exclude_categories=["Cs"])), max_size=40), max_size=4))
def test_ids_of_any_texts(texts):
    assert [i.tolist() for part in O.encoded(ENCODER, texts, size=11) for i in part] == [plain(t) for t in texts]


def test_words_are_forgotten():
    encoder = O.Encoder(PATH)
    for k in range(3):
        encoder.held = O.HELD_BYTES + 1
        assert [i.tolist() for i in encoder.encode([f"new words {k} and old words"])] == [plain(f"new words {k} and old words")[:-1]]
        assert encoder.held < 10_000 and len(encoder.inner) == 4


def test_words_are_columns_that_tasks_of_a_worker_share():
    words = [f"{k * 7919 % 100_003}x{k}" for k in range(20_000)]
    held = {}
    encoder = O.encoder_of(PATH, held)
    assert encoder is O.encoder_of(PATH, held)
    tracemalloc.start()
    encoder.encode([" ".join(words[k : k + 100]) for k in range(0, len(words), 100)])
    size = tracemalloc.get_traced_memory()[0]
    tracemalloc.stop()
    assert len(encoder.inner) + len(encoder.outer) == 20_000 and size < 100 * 20_000
    text = " ".join(words[:300]) + "  " + words[5] + "\u2003" + words[7]
    assert [i.tolist() for i in encoder.encode([text])] == [plain(text)[:-1]]
    encoder.held = O.HELD_BYTES + 1
    assert [i.tolist() for i in encoder.encode([text, "some " + text, "", " x "])] == [plain(t)[:-1] for t in (text, "some " + text, "", " x ")]
    assert 200 < len(encoder.inner) < 400 and encoder.again.sum() > 200


def test_other_vocabularies_are_an_error():
    with pytest.raises(ValueError):
        O.Encoder(public_tokenizers.path("word_bpe_49k.json")).encode(["Some Words of a text"])


def check(rows, got):
    by = {}
    for i, t in rows:
        by.setdefault(i, []).append(plain(t))
    at, seen = 0, sorted(map(tuple, got), key=lambda r: r[1])
    assert [r[0] for r in seen] == sorted((i for i, _ in rows), key=lambda i: (i is not None, i))
    for i, start, n, crc in seen:
        ids = next(x for x in by[i] if (len(x), zlib.crc32(np.array(x, "<u4").tobytes())) == (n, crc))
        by[i].remove(ids)
        assert start == at
        at += n


@pytest.mark.parametrize("row_ids", [O.ROW_IDS, 7])
def test_files(spark, tmp_path, row_ids):
    rows = [((k * 37) % 1000, f"document {k} " + "text " * (k % 50)) for k in range(1000)] + [(5, t) for t in TEXTS] + [(None, "no id"), (None, None)] + [(7, "copy")] * 300
    docs = spark.createDataFrame([(i, t, 1, "x") for i, t in rows], "doc_id long, text string, part int, ids string").repartition(5)
    path = str(tmp_path / "ids")
    O.write(docs, path, rows_per_index=1000, row_ids=row_ids)
    check(rows, O.positions(O.read(spark, path)).collect())
    files = [f for f in glob.glob(path + "/*.orc") if O.stripes(spark, f)]
    assert files and all(s.index_bytes and s.rows for f in files for s in O.stripes(spark, f))
    assert O.read(spark, path).agg({"rows": "max"}).first()[0] == -(-max(len(plain(t)) for _, t in rows) // row_ids)
    found = O.find(spark, path, [13, 999])
    assert sorted((r.doc_id, list(r.ids)) for r in found.collect()) == sorted((i, plain(t)) for i, t in rows if i in (13, 999))
    assert "In(doc_id, [13,999])" in found._jdf.queryExecution().toString()


def test_large_files_have_stripes_and_reads_skip_them(spark, tmp_path):
    rng = np.random.default_rng(1)
    rows = [(k * 10, " ".join(map(str, rng.integers(0, 1 << 30, 60)))) for k in range(6000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    path = str(tmp_path / "ids")
    O.write(docs, path, stripe_bytes=1 << 16, rows_per_index=1000)
    assert max(len(O.stripes(spark, f)) for f in glob.glob(path + "/*.orc")) > 1

    def rows_read(ids):
        assert O.find(spark, path, ids).count() == sum(i % 10 == 0 and i < 60_000 for i in ids)
        node = O.read(spark, path).where(F.col("doc_id").isin(ids))._jdf.queryExecution().executedPlan()
        node.execute().count()
        while "FileSourceScan" not in node.getClass().getSimpleName():
            node = node.children().apply(0)
        return node.metrics().apply("numOutputRows").value()

    assert rows_read([30_000]) <= 2000  # by bounds
    assert rows_read([30_001]) <= 1000  # within the bounds, but in no Bloom filter
    assert O.read(spark, path).count() == 6000


def test_empty_table(spark, tmp_path):
    docs = spark.createDataFrame([], "doc_id string, text string")
    O.write(docs, str(tmp_path / "ids"))
    assert O.positions(O.read(spark, str(tmp_path / "ids"))).count() == 0


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    check(rows, entry.queries()["op12_orc_ids"](spark, sf).select("doc_id", "start", "n_tokens", "ids_crc32").collect())
