import random
import re

from veritwin.llm import licenses as L

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
MIT = next(t for t in L.TEMPLATES["mit"] if "free of charge" in t)


def lower(t):
    return re.sub("[A-Z]", lambda m: m[0].lower(), t)


def brute(text):
    words = WORD.findall(lower(text or ""))
    found = [(k, label) for phrase, label in L.PHRASES for k in range(len(words)) if words[k : k + len(phrase.split())] == phrase.split()]
    starts = [k for k, _ in found]
    return len(words), len(starts), min(starts, default=None), max(starts, default=None), ",".join(sorted({x for _, x in found}))


def test_base_equals_brute_force():
    r = random.Random(2)
    vocabulary = ["CC", "by", "General", "PUBLIC", "license", "all", "rights", "reserved", "é", "x1"]
    for _ in range(500):
        text = "".join(r.choice(vocabulary) + r.choice([" ", "-", ". "]) for _ in range(r.randrange(40)))
        assert L.scan_text(text)[:5] == brute(text)


def filled(template, optional, filler):
    text = re.sub(r"<<optional>>(.*?)<<end>>", r"\1" if optional else " ", template, flags=re.S)
    return re.sub(r"<<any (\d+)>>", lambda m: " ".join(["holder"] * filler(int(m[1]))), text)


def test_every_template_accepts_its_own_text():
    for label, templates in L.TEMPLATES.items():
        for t in templates:
            for optional in (True, False):
                for filler in (lambda n: 0, lambda n: n):
                    got = L.scan_text("Über uns. " + filled(t, optional, filler).upper().replace("É", "é") + " the end")
                    assert label in got[6 - 1].split(",") and got[6] == 1.0, (label, optional)


def test_mandatory_wording_must_match():
    text = filled(MIT, False, lambda n: 3)
    assert "mit" in L.scan_text(text)[5].split(",")
    assert "mit" not in L.scan_text(text.replace("without restriction", "with restriction"))[5].split(",")
    assert 0 < L.scan_text(text.replace("OTHERWISE", "ELSE"))[6] < 1
    assert "mit" not in L.scan_text(filled(MIT, False, lambda n: n + 1))[5].split(",")
    assert "mit" in L.scan_text(text.replace("sublicense", "sublicence"))[5].split(",")


def test_rows(spark):
    rows = [(1, "Released under the MIT License."), (1, "Released under the MIT License."), (None, None), (2, "!"), (3, "Licensed under CC BY-NC 4.0. " * 20000),
            (4, "This work is licensed under the GNU General Public License, version 3."), (5, "Licensed under the Apache License, Version 2.0.")]
    df = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, labels string")
    got = [(r.doc_id, r.n_words, r.base_labels, r.labels, r.score) for r in L.find_licenses(df).collect()]
    assert got[:4] == [(1, 5, "", "mit", 1.0), (1, 5, "", "mit", 1.0), (None, 0, "", "", 0.0), (2, 0, "", "", 0.0)]
    assert got[4:] == [(3, 140000, "cc-by", "cc-by,cc-by-nc-4.0", 1.0), (4, 12, "gpl", "gpl,gpl-3.0", 1.0), (5, 8, "", "apache-2.0", 1.0)]
    assert L.find_licenses(df.limit(0)).count() == 0
