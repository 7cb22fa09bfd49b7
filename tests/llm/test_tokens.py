import public_tokenizers
from tokenizers import Tokenizer

from veritwin.llm import tokens as T

SF = "/root/testdata/sf0.001"


def brute(lengths):
    out = []
    for limit in sorted(set(lengths)):
        longer = [n for n in lengths if n > limit]
        out.append((
            limit, lengths.count(limit), len(longer), sum(n for n in lengths if n <= limit), sum(min(n, limit) for n in lengths),
            sum(n - limit for n in longer), (len(lengths) - len(longer)) / len(lengths)))
    return out


def totals(df):
    return sorted(map(tuple, T.context_totals(T.length_histogram(df)).collect()))


def test_totals_equal_brute_force(spark):
    lengths = [0, 0, 1, 5, 5, 5, 1023, 1024, 1025, 3000, 70_000, 70_000, 2047, 2048] + list(range(0, 5000, 7))
    assert totals(spark.createDataFrame([(n,) for n in lengths], "length long")) == brute(lengths)
    assert totals(spark.createDataFrame([], "length long")) == []


def test_whole_query_equals_the_other_library(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    other = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    other.encode_special_tokens = True
    texts = [r.text for r in docs.select("text").collect()]
    lengths = [len(e.ids) for e in other.encode_batch(texts, add_special_tokens=False)]
    assert totals(T.encoded_lengths(docs)) == brute(lengths)


def test_odd_rows(spark):
    rows = [(None, 1), ("", 2), ("<|endoftext|>", 3), ("a", 4), ("a", 4), ("word " * 200_000, 5)]
    df = spark.createDataFrame(rows, "text string, length int")
    got = sorted(r.length for r in T.encoded_lengths(df).collect())
    assert got[:4] == [0, 0, 1, 1] and got[4] > 1 and got[5] >= 200_000
    assert T.encoded_lengths(df.limit(0)).count() == 0
