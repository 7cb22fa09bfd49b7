import random
import re
import time

from veritwin.llm import pii as P

BASE = {
    "email": re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    "ip": re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    "card": re.compile(r"[0-9]([\x20-]?[0-9])+"),
    "phone": re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
}


def passes(kind, value):
    number = re.sub("[^0-9]", "", value)
    if kind == "ip":
        return all(int(p) <= 255 for p in value.split("."))
    if kind == "card":
        total = sum(d if i % 2 == 0 else d * 2 - 9 * (d > 4) for i, d in enumerate(map(int, reversed(number))))
        return 12 <= len(number) <= 19 and total % 10 == 0
    return kind == "email" or 9 <= len(number) <= 15


def brute(text):
    out = [(k, *m.span()) for k, p in BASE.items() for m in p.finditer(text or "") if passes(k, m[0])]
    return sorted(out, key=lambda s: (s[1], P.KINDS.index(s[0])))


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "x", [1]) for i, t in rows], "doc_id long, text string, kind string, spans array<int>")


def found(df):
    return {r.doc_id: ([tuple(s)[:3] for s in r.base], [tuple(s)[:3] for s in r.spans]) for r in P.find_pii(df).collect()}


def test_base_equals_plain_patterns(spark):
    r = random.Random(4)
    parts = ["a.b", "@", "x-y", ".com", ".", "_", " ", "1", "25", "255", "256.", "0", "-", "+", "+1 (386) 555-3733", "4111111111111111", "4111 1111-1111 1112",
             "192.168.0.1", "0000255.1.2.3", "é", "😀", "@a.b_c@d.e", "99999999999999999999", "(", ")", "1.2.3.4.5.6.7.8", "\n", "mail"]
    rows = [(k, "".join(r.choice(parts) for _ in range(r.randrange(1, 30)))) for k in range(1500)]
    got = found(frame(spark, rows))
    for k, text in rows:
        assert got[k][0] == brute(text), text


def test_method_adds_spans_and_keeps_base(spark):
    text = "Social security number 219-09-9999, call (415) 555-2671 or mail jane [at] site [dot] org; IBAN DE89 3704 0044 0532 0130 00."
    rows = [(k, text) for k in range(40)] + [(100, "tel +1 (386) 555-3733 now"), (101, "version 000-00-0000")]
    got = found(frame(spark, rows))
    base, every = got[0]
    assert base == [] or set(base) <= set(every)
    assert {"ssn", "local_phone", "mail_words", "iban"} <= {k for k, _, _ in every}
    assert [text[a:b] for k, a, b in every if k == "ssn"] == ["219-09-9999"]
    assert got[100][1] == got[100][0] == [("phone", 4, 21)]
    assert got[101][1] == []


def test_em_finds_the_bad_labeler():
    r = random.Random(1)
    counts = {}
    for _ in range(4000):
        truth = r.random() < 0.5
        votes = [(1 if truth else -1) if r.random() < 0.9 else (-1 if truth else 1) for _ in range(3)] + [r.choice((-1, 1))] + [0, 0]
        key = (0, tuple(votes), 0)
        counts[key] = counts.get(key, 0) + 1
    model = P.fit([(k, list(v), s, n) for (k, v, s), n in counts.items()])
    good, bad = P.LABELERS[0], P.LABELERS[3]
    assert model.rates[good][1][1] > 0.85 > 0.15 > model.rates[good][1][0]
    assert abs(model.rates[bad][1][1] - model.rates[bad][1][0]) < 0.1
    assert model.votes[good] > 5 * abs(model.votes[bad])


def test_rows_and_long_texts(spark):
    def long(n):
        return "a." * n + " " + "x" * n + "@" + "b." * n + "c " + "1" * n + " +" + "1 " * n

    many, huge = "a@b.c " * 20_000, long(100_000)
    rows = [(1, "ip 1.2.3.4"), (1, "ip 1.2.3.4"), (None, None), (2, ""), (3, long(1000)), (4, many), (5, huge), (None, "a@b.cd")]
    df = P.find_pii(frame(spark, rows))
    assert df.columns == ["doc_id", "base", "spans"]
    start = time.time()
    got = df.collect()
    assert time.time() - start < 60
    assert len(got) == 8
    by = {r.doc_id: [tuple(s)[:3] for s in r.base] for r in got}
    assert by[1] == [("ip", 3, 10)] and by[2] == []
    assert by[3] == brute(long(1000))
    assert by[4] == brute(many)
    assert [k for k, _, _ in by[5]] == [k for k, _, _ in by[3]]
    assert P.find_pii(frame(spark, rows).limit(0)).count() == 0
