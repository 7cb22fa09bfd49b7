import pytest
from pyspark.sql import functions as F

from veritwin.functions import cardinality as card
from veritwin.functions import records, richtext
from veritwin.functions import text as tx
from veritwin.functions import types as ty
from veritwin.functions.similarity import text_similarity


def one(spark, values, expr):
    rows = spark.createDataFrame([(i, *(v if isinstance(v, tuple) else (v,))) for i, v in enumerate(values)],
                                 "i int, a string" + (", b string" if isinstance(values[0], tuple) else ""))
    return [r[0] for r in rows.orderBy("i").select(expr).collect()]


NAMES = {
    "Customer Order": "CUSTOMERORDER", "CUSTOMER_ORDER": "CUSTOMERORDER", "customerOrders": "CUSTOMERORDER", "Categories": "CATEGORY",
    "Boxes": "BOX", "Glass": "GLASS", "Buses": "BUS", "IES": "IES", "bus": "BUS", "Ties": "TY", "": "", None: "", "GLASSES": "GLASS", "data-sets 2s": "DATASETS2",
}


def test_normalize_name(spark):
    assert one(spark, list(NAMES), tx.normalize_name("a")) == list(NAMES.values())


def test_normalize_name_matches_the_rule_letter_by_letter(spark):
    words = [x + y for x in ("A", "AB", "ABC", "BUS", "X") for y in ("", "S", "SS", "ES", "SES", "XES", "ZES", "IES", "IESS", "Y")]

    def rule(t):
        if len(t) > 3:
            if t.endswith("IES"):
                return t[:-3] + "Y"
            if t[-3:] in ("SES", "XES", "ZES"):
                return t[:-2]
            if t.endswith("S") and not t.endswith("SS"):
                return t[:-1]
        return t

    assert one(spark, words, tx.normalize_name("a")) == [rule(w) for w in words]


@pytest.mark.parametrize("raw,base,length,precision", [
    ("VARCHAR(20)", "varchar", "20", ""), ("DC18,2", "dc", "18", "2"), ("Number", "number", "", ""), (" decimal ( 10 , 2 ) ", "decimal", "10", "2"),
    ("x(,2)", "x", "2", ""), ("", "", "", ""), ("double precision", "double precision", "", ""), ("t()", "t", "", ""),
])
def test_split_type(spark, raw, base, length, precision):
    assert one(spark, [raw], ty.split_type("a"))[0].asDict() == {"base": base, "length": length, "precision": precision}


def test_canonical_and_family(spark):
    raw = ["VA", "Varchar(20)", "Number", "<none>", "odd thing", "BIT"]
    assert one(spark, raw, ty.canonical_type("a")) == ["VARCHAR", "VARCHAR", "NUMBER", "", "ODD_THING", "BOOLEAN"]
    assert one(spark, raw, ty.type_family("a")) == ["TEXT", "TEXT", "NUMBER", "", "OTHER", "BOOLEAN"]


def test_types_match_matrix_beats_family(spark):
    rows = spark.createDataFrame(
        [("CHAR(5)", "VARCHAR(5)"), ("VBIN64000", "BINARY(64000)"), ("F", "REAL"), ("", "DATE"), ("TEXT", "CLOB"), ("MN", "INT")], "a string, b string")
    df = ty.with_type_parts(ty.with_type_parts(rows, "a", "_s_"), "b", "_t_")
    got = [tuple(r) for r in df.select(ty.types_match("_s_", "_t_"), ty.types_match("_s_", "_t_", "family", False), ty.describe_type("_s_")).collect()]
    assert [g[0] for g in got] == [False, False, True, True, True, True]
    assert [g[1] for g in got] == [True, True, True, True, True, True]
    assert got[1][2] == "VBIN64000 → BINARY(64000) / BINARY"


CARDS = {
    "Zero, One or More": "0,n", "Zero,One or More": "0,n", "One or More (P)": "1,n", "Zero or One (Z)": "0,1", "-3": "", "0-n": "0,n", "(0,n)": "0,n",
    "exactly 1": "1,1", "exactly 4": "1,n", "0 , 1": "0,1", "at most one": "0,1", "": "", "?": "", "1..*": "1,n", "3,m": "1,n",
}


def test_normalize_cardinality(spark):
    assert one(spark, list(CARDS), card.normalize_cardinality("a")) == list(CARDS.values())


def test_cardinality_from_flags(spark):
    rows = spark.createDataFrame([(True, None), (None, True), (False, False), (None, None)], "m boolean, n boolean")
    got = [r[0] for r in rows.select(card.normalize_cardinality(F.lit("?"), F.col("m"), F.col("n"))).collect()]
    assert got == ["1,1", "0,n", "0,1", ""]


def test_object_label(spark):
    pairs = [("Customer Master(KNA1)", "KNA1"), ("Customer", "CUSTOMERS"), ("Employee 2", "EMPLOYEE"), ("", "C"), ("N", ""), ("Thing ( kna1 ) ", "KNA1")]
    assert one(spark, pairs, tx.object_label("a", "b")) == ["KNA1", "CUSTOMERS", "Employee 2 (EMPLOYEE)", "C", "N", "KNA1"]


def test_truncate_and_blanks(spark):
    assert one(spark, ["a" * 130], tx.truncate("a"))[0] == "a" * 119 + "…"
    assert one(spark, ["  x "], tx.trim_ws("a")) == ["x"]


def test_packed_text_survives(spark):
    texts = ["plain", "a\r\nb\tc", "literal \\#x41 stays", "ctl \x01\x7f", ""]
    record = records.encode_packed_record("a", F.lit(1), F.lit("me"), F.lit("now"), F.lit("{id}"), F.lit("0"))
    back = one(spark, texts, records.decode_packed_record(record))
    assert back == [t.replace("\r\n", "\n") for t in texts]
    assert one(spark, ["too short"], records.decode_packed_record("a")) == [""]


def test_explode_kv_text(spark):
    blob = "{A1-B},box,3={C2},size,4=10\nnoise\n{D3},colour,6=red=blue\n{A9},lid,3={C3},open,4=true"
    rows = records.explode_kv_text(spark.createDataFrame([(1, blob)], "id int, t string"), ["id"], "t").orderBy("pos").collect()
    assert [(r.path, r.value) for r in rows] == [("box.size", "10"), ("box.colour", "red=blue"), ("lid.open", "true")]


RICH = {
    r"{\rtf1\ansi{\fonttbl{\f0 Arial;}}\pard Hello\par World}": "Hello\nWorld",
    r"{\rtf1 caf\'e9 \u233? {\*\hidden {x}}end}": "café é end",
    r"{\rtf1\ansi{\fonttbl{\f0 Arial;}}}": "",
    r"{\rtf1 open {group": r"{\rtf1 open {group",
    r"{\rtf1 a \{brace\} \\ b}": r"a {brace} \ b",
    "no envelope {at all}": "no envelope {at all}",
    r"{\rtf1 x\parSecond}": "x\nSecond",
}


def test_rich_text(spark):
    df = spark.createDataFrame([(i, k) for i, k in enumerate(RICH)], "i int, t string")
    got = [r.t for r in richtext.rich_text_to_plain(df, "t").orderBy("i").collect()]
    assert got == list(RICH.values())


def test_similarity_short_cuts(spark):
    pairs = [("", ""), ("a", ""), ("A  b", "a B"), ("kitten", "sitting")]
    for method in ("levenshtein", "ratcliff"):
        got = one(spark, pairs, text_similarity("a", "b", method))
        assert got[:3] == [1.0, 0.0, 1.0]
    assert one(spark, pairs, text_similarity("a", "b"))[3] == pytest.approx(1 - 3 / 7)
