import hashlib
import random
import re

from veritwin.llm import decontaminate as D

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def brute(docs, items):
    """Every window against every place."""
    windows = {}
    for i, t in items:
        w = WORD.findall(lower(t))
        for k in range(max(1, len(w) - 12)) if w else []:
            windows.setdefault(tuple(w[k : k + 13]), set()).add(str(i))
    out = []
    for i, t in docs:
        w = WORD.findall(lower(t))
        hit, own = set(), set()
        for size in {len(x) for x in windows}:
            for k in range(len(w) - size + 1):
                if (found := windows.get(tuple(w[k : k + size]))) is not None:
                    hit.update(range(k, k + size))
                    own |= found
        digest = hashlib.sha256(",".join(sorted(own)).encode()).hexdigest()
        out.append((i, len(w), len(hit), len(own), digest, len(hit) > 0 and 20 * len(hit) >= len(w)))
    return sorted(out, key=str)


def made(seed):
    r = random.Random(seed)
    vocabulary = ["a", "b", "ab", "É", "é", "Ab", "7", "the"]

    def text(n):
        return "".join(r.choice(vocabulary) + r.choice([" ", ", ", "\n", "--"]) for _ in range(n))

    items = [(k, text(r.choice([0, 1, 3, 12, 13, 14, 30, 60]))) for k in range(12)]
    items += [(100, items[3][1]), (101, None), (102, "!!")]
    docs = [(k, text(r.choice([0, 5, 40, 300]))) for k in range(20)]
    for k in range(20, 60):
        cut = items[r.randrange(12)][1].split(" ")
        a = r.randrange(len(cut))
        docs.append((k, text(r.randrange(20)) + " ".join(cut[a : a + r.randrange(25)]) + " " + text(r.randrange(20))))
    return docs + [(0, docs[0][1]), (61, None), (62, ""), (63, "x" * 3_000_000), (64, (items[8][1] + " ") * 2000)], items


def frames(spark, docs, items):
    d = spark.createDataFrame([(i, t, "x", 1, [1]) for i, t in docs], "doc_id long, text string, item_id string, hits int, items array<int>")
    return d, spark.createDataFrame([(i, t, "y") for i, t in items], "item_id long, text string, doc_id string")


def test_equals_brute_force_and_shards_agree(spark):
    docs, items = made(1)
    items = [x for x in items if len(WORD.findall(lower(x[1]))) not in (1,)]
    want = brute(docs, items)
    for size in (1 << 20, 40):
        got = D.contamination(*frames(spark, docs, items), shard_bytes=size).collect()
        assert sorted(map(tuple, got), key=str) == want


def test_text_longer_than_a_piece(spark):
    item = " ".join(f"q{k}" for k in range(20))
    docs = [(1, "x" * (D.PIECE - 20) + " " + item + " tail"), (2, ("w " * 700_000) + item)]
    got = {r.doc_id: r for r in D.contamination(*frames(spark, docs, [(5, item)]), offsets=True).collect()}
    assert (got[1].n_hit, got[1].n_words, got[2].n_hit) == (20, 22, 20)
    assert docs[0][1][got[1].spans[0].start : got[1].spans[0].end] == item
    assert docs[1][1][got[2].spans[0].start : got[2].spans[0].end] == item


def test_offsets_count_code_points(spark):
    item = "Frage eins über zwei drei vier fünf sechs sieben acht neun zehn elf zwölf"
    doc = "äöü😀! Vor " + item.replace(" ", " -- ") + " nach"
    row = D.contamination(*frames(spark, [(1, doc)], [(9, item)]), offsets=True).first()
    assert [doc[s.start : s.end] for s in row.spans] == [item.replace(" ", " -- ")]


def test_empty_tables(spark):
    docs, items = frames(spark, [(1, "a b")], [(1, "a b")])
    assert D.contamination(docs.limit(0), items).count() == 0
    assert D.contamination(docs, items.limit(0)).first().n_words == 2
    assert D.contamination(docs, items).first().contaminated
