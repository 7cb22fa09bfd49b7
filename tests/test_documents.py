"""One pass over a document: its fragments, scopes and faults."""

import tracemalloc
from itertools import chain

import pytest

from veritwin.operators.shaping import mark_primary
from veritwin.sources import documents, models

KINDS = {"o:Entity": ("entity", "Id"), "o:Link": ("link", "Id"), "o:Package": ("package", "Id"), "c:List": ("list", "")}


def scan(content, **options):
    given = dict(scopes={"package": ("a:Name",), "list": None}, once=("entity",))
    rows = [r for some in documents.Fragments(content, KINDS, **{**given, **options}).rows() for r in some]
    assert rows[-1][0] == "document"
    return {(kind, number): (scope, text) for kind, number, scope, text in rows[:-1]}, rows[-1][3]


def test_pointers_nesting_and_scopes():
    text = ('<m><o:Entity Id="e1" n="a>b"/><o:Entity Ref="e1"/><o:Package Id="p"><c:Es><o:Entity Id="e2"><o:Link Id="l"/></o:Entity></c:Es>'
            '<a:Name>A &amp; B</a:Name><o:Package Id="q"><a:Name/><o:Entity Id="e3">x</o:Entity></o:Package></o:Package>'
            '<o:Entity Id="e1"><a:Name>again</a:Name></o:Entity><c:List>y<o:Link Id="z"/></c:List></m>').encode()
    got, fault = scan(text)
    assert fault is None
    assert got == {
        ("entity", 1): (None, '<o:Entity Id="e1" n="a>b"/>'),
        ("package", 2): (None, '<o:Package Id="p"><a:Name>A &amp; B</a:Name></o:Package>'),
        ("entity", 3): (2, '<o:Entity Id="e2"><o:Link Id="l"/></o:Entity>'), ("link", 4): (2, '<o:Link Id="l"/>'),
        ("package", 5): (2, '<o:Package Id="q"><a:Name/></o:Package>'), ("entity", 6): (5, '<o:Entity Id="e3">x</o:Entity>'),
        ("list", 7): (None, '<c:List>y<o:Link Id="z"/></c:List>'), ("link", 8): (7, '<o:Link Id="z"/>')}
    assert len(scan(text, once=())[0]) == 9  # the second definition of e1 as well


@pytest.mark.parametrize("encoding", ["utf-8", "utf-16", "iso-8859-1", "utf-8-sig"])
def test_encodings_and_control_characters(encoding):
    named = encoding.removesuffix("-sig")
    text = f'<?xml version="1.0" encoding="{named}"?>\n<m><o:Entity Id="é">ü\x01</o:Entity></m>'
    assert scan(text.encode(encoding)) == ({("entity", 1): (None, '<o:Entity Id="é">ü</o:Entity>')}, None)


@pytest.mark.parametrize("content, elements", [
    (b"", 0), (b"<m>", 0), (b'<m><o:Entity Id="1"/><o:Entity Id="2">', 1), (b"\xff\xfe<", 0), (b'<?xml version="1.0" encoding="none"?><m/>', 0),
    (b'<!DOCTYPE m [<!ENTITY x "y">]><m><o:Entity Id="1">&x;</o:Entity></m>', 0), (b"<m>\xc3</m>", 0)])
def test_faults(content, elements):
    """Elements before the fault stay; a document that declares entities is not read."""
    got, fault = scan(content)
    assert fault and len(got) == elements


def test_long_documents_leave_in_steps(monkeypatch):
    monkeypatch.setattr(documents, "STEP", 7)
    text = "<m>" + "".join(f'<o:Entity Id="{n}">é{n}</o:Entity>' for n in range(50)) + "</m>"
    steps = list(documents.Fragments(text.encode(), KINDS, {}).rows())
    assert len(steps) > 20 and [r[3] for some in steps for r in some][:-1] == [f'<o:Entity Id="{n}">é{n}</o:Entity>' for n in range(50)]


def test_documents_are_scanned_once(spark, tmp_path):
    """What is read after the scan is its copy, one kind at a time."""
    (tmp_path / "a.xml").write_text('<m><Entity id="1" name="A"/><Domain id="2" name="D"/></m>')
    found = models.target_elements(spark, f"{tmp_path}/*.xml")
    plan = models.read_definitions(found, models.TARGET["domain"][1], "domain")._jdf.queryExecution().toString()
    assert str(tmp_path) not in plan and "binaryFile" not in plan and "EqualTo(kind,domain)" in plan
    assert {r.kind for r in found.collect()} == {"entity", "domain", "document"}


def test_primary_by_flags_needs_exactly_the_flagged_members(spark):
    keys = spark.createDataFrame(
        [("e", "i1", 0, ["A", "b", "b"]), ("e", "i2", 1, ["A"]), ("f", "j1", 0, ["A"]), ("f", "j2", 1, []), ("g", "k1", 0, [])],
        "entity string, oid string, ord int, members array<string>")
    attributes = spark.createDataFrame([("e", "a", True), ("e", "B", True), ("e", "c", False), ("f", "a", True)], "entity string, code string, is_primary boolean")
    pointers = spark.createDataFrame([("e", "lost"), ("f", "j2"), ("g", None)], "entity string, primary_oid string")
    got = {r.oid: r.evidence for r in mark_primary(keys, attributes, pointers, ["entity"]).where("is_primary").collect()}
    assert got == {"i1": "FLAGS", "j2": "POINTER"}


def test_memory_of_a_step_and_not_of_the_document(monkeypatch):
    monkeypatch.setattr(documents, "STEP", 1 << 12)
    content = b"<m>" + b'<o:Entity><a:Name>some text</a:Name></o:Entity>' * 80_000 + b'<o:Entity Id="e"><a:Name>last</a:Name></o:Entity></m>'
    tracemalloc.start()
    found, fault = scan(memoryview(content))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert found == {("entity", 1): (None, '<o:Entity Id="e"><a:Name>last</a:Name></o:Entity>')} and fault is None
    assert peak < len(content) / 10


@pytest.mark.parametrize("step", [1, 5, 1 << 20])
def test_steps_of_any_size_and_other_encodings(monkeypatch, step):
    monkeypatch.setattr(documents, "STEP", step)
    body = ('<m><o:Package Id="p"><a:Name>ä&amp;</a:Name><o:Package Id="q"><a:Name/></o:Package><o:Entity Id="e1" n="a>b"/></o:Package>'
            '<c:List><o:Entity Id="e2">é\x01</o:Entity></c:List></m>')
    wanted = scan(body.encode())
    assert wanted[0][("entity", 3)] == (1, '<o:Entity Id="e1" n="a>b"/>') and wanted[1] is None
    for content in (body.encode("utf-16"), ('<?xml version="1.0" encoding="ISO-8859-1"?>' + body).encode("latin-1")):
        assert scan(content) == wanted


def test_documents_are_read_in_pieces(spark, tmp_path, monkeypatch):
    """Files cut into many parts, whatever their encoding, their last byte or their name."""
    body = '<m><o:Package Id="p"><a:Name>ä&amp;</a:Name>' + "".join(f'<o:Entity Id="e{n}" n="a>b">é\x01{n}</o:Entity>' for n in range(300)) + "</o:Package></m>"
    contents = {
        "a é%41+.xml": body.encode(), "b.xml": b"\xef\xbb\xbf" + body.encode() + b"\r\n", "c.xml": body.encode("utf-16"), "d.xml": body.encode()[:-1], "e.xml": b"\xef\xbb\xbf" + body.encode()[:-1],
        "f.xml": b"\xef\xbb\xbf", "g.xml": b">", "h.xml": body.encode().replace(b"\xc3\xa9", b"\xc3") + b">", "i.xml.gz": body.encode(), "j.xml": b"\xef\xbb\xbf<m", "k.xml": b"text\n",
        "l.xml": ('<?xml version="1.0" encoding="ISO-8859-1"?>' + body).encode("latin-1"), "m.xml": b'<?xml version="1.0" encoding="windows-1252"?><m>\x81</m>'}
    for k, x in contents.items():
        (tmp_path / "x=1 2").mkdir(exist_ok=True)
        (tmp_path / "x=1 2" / k).write_bytes(x)
    monkeypatch.setattr(documents, "STEP", 1 << 10)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1000")
    try:
        got = documents.elements(spark, str(tmp_path), KINDS, {"package": ("a:Name",), "list": None}, ("entity",)).collect()
        assert spark.read.text(str(tmp_path)).rdd.getNumPartitions() > 50
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert {r.source_file for r in got} == {f"file:{tmp_path}/x=1 2/{k}" for k in contents}
    for k, x in contents.items():
        want, fault = scan(x)
        mine = [r for r in got if r.source_file.endswith(f"/{k}")]
        assert {(r.kind, r.ord): (r.scope, r.fragment) for r in mine if r.kind != "document"} == want, k
        assert [r.fragment for r in mine if r.kind == "document"] == [fault], k
        assert len(mine) == len(want) + 1


def test_no_task_holds_a_document(monkeypatch):
    """What the worker gets and gives is bounded by a step; a second pass over another encoding goes through a file."""
    monkeypatch.setattr(documents, "STEP", 1 << 14)
    for head, encoding in ((b"", "utf-8"), (b'<?xml version="1.0" encoding="ISO-8859-1"?>', "latin-1")):
        tracemalloc.start()
        parts = ('<o:Entity Id="%d"><a:Name>é some text</a:Name></o:Entity>' % n for n in range(60_000))
        content = (x.encode(encoding) for p in ("<m>", parts, "</m>") for x in ([p] if isinstance(p, str) else p))
        n = size = 0
        for some in documents.Fragments(chain([head], content), KINDS, {}).rows():
            n, size = n + len(some), size + sum(len(r[3] or "") for r in some)
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert n == 60_001 and peak < size / 4


def test_documents_of_the_queries_are_lines(spark, tmp_path, monkeypatch):
    """No document is one value: its texts are lines, in the order of the layout and of the keys, whatever repeats or is null."""
    from proofs import ingest
    from proofs.base import Tables

    rows = [(3, "n3", "Brand#15"), (1, "n1", "Brand#15"), (1, "n0", "Brand#15"), (2, None, "Brand#15"), (5, "n5", "Brand#1"), (None, "n", "Brand#1"), (4, "n4", None)]
    spark.createDataFrame(rows, "p_partkey long, p_name string, p_brand string").selectExpr("*", "'t' p_type").write.parquet(f"{tmp_path}/part.parquet")
    monkeypatch.setattr(ingest, "scratch", lambda T: f"{tmp_path}/out")
    path = ingest.composed(Tables(spark, str(tmp_path)), {"a": "concat('<a>', name, '</a>')", "b": "CASE WHEN k <> first THEN concat('<b>', k, '{{}}</b>') END"}, ["<m>", "a", "<s/>", "b", "</m><end/>"])
    got = {}
    for file in sorted((tmp_path / "out").glob("doc=*/*.txt")):
        assert file.parent.name not in got
        got[file.parent.name] = file.read_text().splitlines()
    assert path == f"{tmp_path}/out" and got == {
        "doc=B15": ["<m>", "<a>n0</a>", "<a>n1</a>", "<a>n3</a>", "<s/>", "<b>2{}</b>", "<b>3{}</b>", "</m><"],
        "doc=B1": ["<m>", "<a>n</a>", "<a>n5</a>", "<s/>", "</m><end/>"],
        "doc=__HIVE_DEFAULT_PARTITION__": ["<m>", "<a>n4</a>", "<s/>", "</m><end/>"]}
