import functools
import random

import pytest

from veritwin.llm import pieces as P

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def table():
    return P.load()


@functools.cache
def scored():
    pieces, best = P.load(), {}
    for k, (t, s, u) in enumerate(zip(pieces.texts, pieces.scores, pieces.usable)):
        if u and (t not in best or s > best[t][0]):
            best[t] = (s, k)
    return best, min(pieces.scores) - 10.0, max(map(len, best))


def viterbi(word, pieces):
    """Plain dynamic programme over a word."""
    best, unknown, longest = scored()
    paths = [(0.0, [])]
    for end in range(1, len(word) + 1):
        top = None
        for start in range(max(0, end - longest), end):
            piece = word[start:end]
            if piece in best:
                step = best[piece][0], [best[piece][1]]
            elif end - start == 1:
                step = unknown, [pieces.bytes_[b] for b in piece.encode()]
            else:
                continue
            score = paths[start][0] + step[0]
            if top is None or score > top[0]:
                top = score, paths[start][1] + step[1]
        paths.append(top)
    return paths[-1][1]


def brute(text, pieces, longest=P.LONGEST):
    return [i for w in P.Splitter(pieces.mixed, longest)(text) for i in viterbi(w, pieces)]


def test_splitter_keeps_everything_and_cuts_where_no_piece_reaches(table):
    assert not table.mixed
    text = "  Über 12 Katzen,\n\tso  (x_y) 3.5% ▁ ende  "
    words = P.Splitter(False)(text)
    assert "".join(words) == " " + text and " Katzen" in words
    r = random.Random(1)
    for _ in range(300):
        line = "".join(r.choice(["a", " ", "-", "é", "9", "\n", "the", "_", "界"]) for _ in range(r.randrange(1, 30)))
        assert "".join(P.Splitter(False)(line)) == "".join(P.Splitter(True)(line)) == " " + line
        assert viterbi(" " + line, table) == [i for w in P.Splitter(False)(line) for i in viterbi(w, table)]


ROWS = ["", None, "a", "The quick brown fox", "été 界面 🙂 ▁x\x00y", "aaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaa", "=" * 70, "  two  blanks\n\n", "hello hello hello",
        "z" * 1000, "representation responsibility includegraphics", "hello hello hello"]


@pytest.mark.parametrize("head_words", [P.HEAD, 3])
def test_equals_plain_viterbi(spark, table, head_words):
    df = spark.createDataFrame([(k if k else None, t, "x", 1) for k, t in enumerate(ROWS)], "doc_id long, text string, word string, ids int")
    got = {r.doc_id: r for r in P.encode(df, table, head_words=head_words).collect()}
    assert len(got) == len(ROWS)
    for k, t in enumerate(ROWS):
        row = got[k if k else None]
        assert row.ids == brute(t, table), t
        assert row.round_trip and row.n_pieces == len(row.ids) and row.n_words == len(P.Splitter(False)(t))
    back = {r.doc_id: r.text for r in P.decode(P.encode(df, table), table).collect()}
    assert all(back[k if k else None] == (t or "") for k, t in enumerate(ROWS))


def test_long_words_equal_viterbi_on_the_uncut_word(spark, table):
    r = random.Random(4)
    letters = "".join(r.choice(["the", "ing", "re", "a", "x", "Q", "tion", "é", "界"]) for _ in range(700))
    words = ["=" * 1003, "-" * 1021, letters, "z" * 1500, " " * 1100 + "b", "\n" * 999]
    df = spark.createDataFrame([(k, w) for k, w in enumerate([*words, "see " + words[0] + " and " + letters])], "doc_id long, text string")
    got = {d.doc_id: d for d in P.encode(df, table, head_words=1).collect()}
    for k, w in enumerate(words):
        assert got[k].ids == viterbi(" " + w, table), w[:9]
        assert got[k].round_trip and got[k].n_pieces == len(got[k].ids)
    mixed = [" see", " " + words[0], " and", " " + letters]
    assert got[len(words)].ids == [i for w in mixed for i in viterbi(w, table)] and got[len(words)].n_words == 4


def test_given_documents(spark, table):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    cache = {}
    for r in P.encode(docs, table).collect():
        want = [i for w in P.Splitter(False)(texts[r.doc_id]) for i in cache.setdefault(w, viterbi(w, table) if w not in cache else None)]
        assert r.round_trip and r.ids == want


def test_long_text_and_empty_table(spark, table):
    df = spark.createDataFrame([(1, "word " * 300_000), (2, "x" * 300_000)], "doc_id long, text string")
    got = {r.doc_id: r for r in P.encode(df, table).collect()}
    assert got[1].round_trip and got[2].round_trip and got[1].n_words == 300_001
    assert P.encode(df.limit(0), table).count() == 0
    assert P.decode(P.encode(df.limit(0), table), table).count() == 0
