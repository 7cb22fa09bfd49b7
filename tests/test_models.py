"""XML documents in, findings out: a clean pair, and one finding per mutation."""

import pytest
from pyspark.sql import functions as F

from veritwin.config import CONCEPTUAL, LOGICAL, PHYSICAL
from veritwin.plans import flow, scoring
from veritwin.plans.findings import apply_severity
from veritwin.plans.models import compare_models, compare_physical_models
from veritwin.plans.semantic import drop_ignored_migrated
from veritwin.sources import files, models

SOURCE = """<?xml version="1.0"?>
<Model xmlns:a="attribute" xmlns:c="collection" xmlns:o="object"><o:RootObject Id="o1"><c:Children><o:Model Id="o2"><a:Name>Shop</a:Name>
<c:Entities>
 <o:Entity Id="e1"><a:Name>Customer</a:Name><a:Code>CUSTOMER</a:Code><a:Comment>{\\rtf1\\ansi Who buys}</a:Comment>
  <c:Attributes>
   <o:EntityAttribute Id="a1"><a:Name>Customer Id</a:Name><a:Code>CUST_ID</a:Code><a:DataType>I</a:DataType><a:LogicalAttribute.Mandatory>1</a:LogicalAttribute.Mandatory></o:EntityAttribute>
   <o:EntityAttribute Id="a2"><a:Name>Name</a:Name><a:Code>NAME</a:Code><a:DataType>VA20</a:DataType><a:Length>20</a:Length><c:Domain><o:Domain Ref="d1"/></c:Domain></o:EntityAttribute>
  </c:Attributes>
  <c:Identifiers><o:Identifier Id="i1"><a:Name>PK</a:Name><c:Identifier.Attributes><o:EntityAttribute Ref="a1"/></c:Identifier.Attributes></o:Identifier></c:Identifiers>
  <c:PrimaryIdentifier><o:Identifier Ref="i1"/></c:PrimaryIdentifier></o:Entity>
 <o:Entity Id="e2"><a:Name>Order</a:Name><a:Code>ORDER</a:Code>
  <c:Attributes><o:EntityAttribute Id="a3"><a:Name>Order Id</a:Name><a:Code>ORDER_ID</a:Code><a:DataType>I</a:DataType></o:EntityAttribute></c:Attributes>
  <c:Identifiers><o:Identifier Id="i2"><a:Name>PK</a:Name><c:Identifier.Attributes><o:EntityAttribute Ref="a3"/></c:Identifier.Attributes></o:Identifier></c:Identifiers>
  <c:PrimaryIdentifier><o:Identifier Ref="i2"/></c:PrimaryIdentifier></o:Entity>
</c:Entities>
<c:Relationships><o:Relationship Id="r1"><a:Name>places</a:Name><a:Entity2ToEntity1Role>places</a:Entity2ToEntity1Role>
 <a:Entity1ToEntity2RoleCardinality>1,1</a:Entity1ToEntity2RoleCardinality><a:Entity2ToEntity1RoleCardinality>0,n</a:Entity2ToEntity1RoleCardinality>
 <a:Entity2ToEntity1RoleDependent>1</a:Entity2ToEntity1RoleDependent><c:ParentIdentifier><o:Identifier Ref="i1"/></c:ParentIdentifier>
 <c:Object1><o:Entity Ref="e1"/></c:Object1><c:Object2><o:Entity Ref="e2"/></c:Object2></o:Relationship></c:Relationships>
<c:Domains><o:Domain Id="d1"><a:Name>Label</a:Name><a:Code>LABEL</a:Code><a:DataType>VA20</a:DataType></o:Domain></c:Domains>
<c:Diagrams><o:Sym><c:Object><o:Entity Ref="e1"/></c:Object></o:Sym></c:Diagrams>
</o:Model></c:Children></o:RootObject></Model>"""

TARGET = """<?xml version="1.0"?>
<Export><Model id="m1" name="Shop"><Entity_Groups>
<Entity id="{{E1}}" name="Customer"><EntityProps><Physical_Name>CUSTOMER</Physical_Name><Definition>Who buys</Definition>
 <Note_List_Array><Note_List>1\\#x1F\\#x1F\\#x1F\\#x1F\\#x1F\\#x1Fline one\\#x0Aline two\\#x1F0\\#x1F\\#x1F\\#x1F\\#x1F</Note_List></Note_List_Array></EntityProps>
 <Attribute_Groups>
  <Attribute id="{{A1}}" name="Customer Id"><AttributeProps><Physical_Name>CUST_ID</Physical_Name><Logical_Data_Type>{type1}</Logical_Data_Type><Null_Option_Type>{null1}</Null_Option_Type></AttributeProps></Attribute>
  <Attribute id="{{A2}}" name="Name"><AttributeProps><Physical_Name>NAME</Physical_Name><Physical_Data_Type>VARCHAR(20)</Physical_Data_Type><Parent_Domain_Ref>{{D1}}</Parent_Domain_Ref></AttributeProps></Attribute>
  {extra}
 </Attribute_Groups>
 <Key_Group_Groups><Key_Group id="{{K1}}" name="XPK"><Key_GroupProps><Key_Group_Type>PK</Key_Group_Type></Key_GroupProps>
  <Key_Group_Member_Groups><Key_Group_Member id="{{M1}}"><Key_Group_MemberProps><Attribute_Ref>{{A1}}</Attribute_Ref><Key_Group_Member_Order>1</Key_Group_Member_Order></Key_Group_MemberProps></Key_Group_Member></Key_Group_Member_Groups></Key_Group></Key_Group_Groups></Entity>
{order}
</Entity_Groups>
<Relationship_Groups><Relationship id="{{R1}}" name="places"><RelationshipProps><Parent_Entity_Ref>{{E1}}</Parent_Entity_Ref><Child_Entity_Ref>{{E2}}</Child_Entity_Ref>
 <Type>{reltype}</Type><Cardinality>-3</Cardinality><Null_Option_Type>101</Null_Option_Type><Parent_To_Child_Verb_Phrase>places</Parent_To_Child_Verb_Phrase></RelationshipProps></Relationship></Relationship_Groups>
<Domain_Groups><Domain id="{{D1}}" name="Label"><DomainProps><Physical_Name>LABEL</Physical_Name><Logical_Data_Type>VARCHAR(20)</Logical_Data_Type><Built_In_Id>0</Built_In_Id></DomainProps></Domain>
<Domain id="{{D0}}" name="Blob"><DomainProps><Built_In_Id>7</Built_In_Id></DomainProps></Domain></Domain_Groups></Model></Export>"""
ORDER = """<Entity id="{E2}" name="Order"><EntityProps><Physical_Name>ORDER</Physical_Name></EntityProps><Attribute_Groups>
<Attribute id="{A3}" name="Order Id"><AttributeProps><Physical_Name>ORDER_ID</Physical_Name><Logical_Data_Type>INTEGER</Logical_Data_Type></AttributeProps></Attribute></Attribute_Groups>
<Key_Group_Groups><Key_Group id="{K2}" name="XPK"><Key_GroupProps><Key_Group_Type>PK</Key_Group_Type></Key_GroupProps><Key_Group_Member_Groups><Key_Group_Member id="{M2}"><Key_Group_MemberProps>
<Attribute_Ref>{A3}</Attribute_Ref><Key_Group_Member_Order>1</Key_Group_Member_Order></Key_Group_MemberProps></Key_Group_Member></Key_Group_Member_Groups></Key_Group></Key_Group_Groups></Entity>"""
CLEAN = dict(type1="INTEGER", null1="1", extra="", order=ORDER, reltype="7")


_NEW = '<Attribute id="{{A9}}" name="New"><AttributeProps><Physical_Name>NEW</Physical_Name>{more}</AttributeProps></Attribute>'
MIGRATED = _NEW.format(more="<Parent_Attribute_Ref>{{A3}}</Parent_Attribute_Ref>").replace("{{", "{").replace("}}", "}")
PLAIN = _NEW.format(more="").replace("{{", "{").replace("}}", "}")
HIDDEN = PLAIN.replace("</AttributeProps>", "<Hide_In_Logical>true</Hide_In_Logical></AttributeProps>")

# Case -> what was changed in the target, and the findings that must follow.
CASES = {
    "CLEAN": ({}, []),
    "FLAG": (dict(null1="0"), [("MANDATORY", "WARNING")]),
    "TYPE": (dict(type1="BLOB"), [("DATA_TYPE", "WARNING")]),
    "DEPENDENCY": (dict(reltype="2"), [("DEPENDENCY", "WARNING")]),
    "KEY": (dict(order=ORDER.replace("PK</Key_Group_Type>", "AK</Key_Group_Type>")), [("ALTERNATE_IDENTIFIER", "WARNING"), ("PRIMARY_IDENTIFIER", "CRITICAL")]),
    "EXTRA": (dict(extra=PLAIN), [("ATTRIBUTE_EXTRA", "WARNING")]),
    "MIGRATED": (dict(extra=MIGRATED), []),
    "HIDDEN": (dict(extra=HIDDEN), []),
    "DELETED": (dict(order=""), [("ENTITY_MISSING", "CRITICAL")]),
    "EMPTY": (None, [("PARSE_ERROR", "CRITICAL")]),
    "CUT": ("cut", [("PARSE_ERROR", "CRITICAL")]),
}


@pytest.fixture(scope="module")
def fleet(spark, tmp_path_factory):
    """All cases as one fleet of pairs, compared in one job."""
    folder = tmp_path_factory.mktemp("fleet")
    for name, (changes, _) in CASES.items():
        (folder / f"{name}.ldm").write_text(SOURCE)
        if changes == "cut":  # a file that ends in the middle
            whole = TARGET.format(**CLEAN)
            body = whole[: whole.index("<Relationship_Groups>") + 40]
        else:
            body = '<Export><Model id="m1" name="Shop"></Model></Export>' if changes is None else TARGET.format(**{**CLEAN, **changes})
        (folder / f"{name}.xml").write_text(body.replace("{{", "{").replace("}}", "}"))
    s = models.comparable(models.shred_semantic(spark, f"{folder}/*.ldm"))
    t = models.comparable(models.shred_target(spark, f"{folder}/*.xml"))
    result = compare_models(s, t, LOGICAL)
    findings = {n: [] for n in CASES}
    for r in result["findings"].collect():
        findings[r.pair_id].append((r.category, r.severity, r.member))
    return s, t, findings, {r.pair_id: r for r in result["results"].collect()}


def test_pointers_are_not_objects(fleet):
    s, t = (({k: v.where("pair_id = 'CLEAN'") for k, v in side.items()}) for side in fleet[:2])
    assert s["entities"].count() == 2 and s["attributes"].count() == 3 and s["identifiers"].count() == 2
    key = s["identifiers"].where("id = 'i1'").first()
    assert key.members == ["CUST_ID"] and key.is_primary
    assert t["entities"].where("code = 'CUSTOMER'").first().note == "line one\nline two"
    assert t["domains"].count() == 1
    rel = t["relationships"].first()
    assert (rel.end1.entity, rel.end1.cardinality, rel.end2.entity, rel.end2.cardinality) == ("CUSTOMER", "1,1", "ORDER", "0,n")
    # The Dependent flag is ignored: the child's key shares no member with the parent's.
    own = s["relationships"].first()
    assert (own.end1.cardinality, own.end2.cardinality, own.end1.dependent, own.end2.dependent) == ("1,1", "0,n", False, False)


@pytest.mark.parametrize("case", list(CASES))
def test_each_mutation_is_found(fleet, case):
    found = sorted((c, s) for c, s, _ in fleet[2][case] if s in ("CRITICAL", "WARNING"))
    wanted = CASES[case][1]
    assert [f for f in found if f[0] != "RELATIONSHIP_MISSING"] == wanted


def test_status_and_score(fleet):
    rows = fleet[3]
    assert (rows["CLEAN"].status, rows["CLEAN"].fidelity_score, rows["CLEAN"].promote) == ("PASS", 100.0, True)
    assert rows["FLAG"].status == "WARN" and rows["DELETED"].status == "FAIL" and not rows["DELETED"].promote
    assert (rows["EMPTY"].status, rows["EMPTY"].fidelity_score, rows["EMPTY"].needs_review) == ("ERROR", 0.0, True)
    assert len(fleet[2]["EMPTY"]) == 1
    assert rows["CUT"].status == "ERROR" and not rows["CUT"].promote and len(fleet[2]["CUT"]) == 1
    # The lost entity and its attribute count in the denominator.
    assert rows["DELETED"].attributes_all_s == 3


def test_conceptual_leaves_migrated_keys_out(fleet):
    kept = drop_ignored_migrated(fleet[1]["attributes"].where("pair_id = 'MIGRATED'"), CONCEPTUAL)
    assert kept.where("code = 'NEW'").count() == 0


def test_ingest_round_trip(spark, fleet, tmp_path):
    models.ingest({"entities": fleet[0]["entities"]}, str(tmp_path / "bronze"))
    assert models.load(spark, str(tmp_path / "bronze"), ["entities"])["entities"].count() == 2 * len(CASES)


PHYSICAL_DOC = """<Model xmlns:a="attribute" xmlns:c="collection" xmlns:o="object"><o:Model Id="m"><c:Tables>
<o:Table Id="t1"><a:Name>Orders</a:Name><a:Code>ORDERS</a:Code><c:Columns><o:Column Id="c1"><a:Code>ID</a:Code><a:DataType>int</a:DataType><a:Column.Mandatory>1</a:Column.Mandatory></o:Column>
<o:Column Id="c2"><a:Code>NOTE</a:Code><a:DataType>varchar2</a:DataType><a:Length>5</a:Length></o:Column></c:Columns>
<c:Keys><o:Key Id="k1"><a:Name>PK</a:Name><c:Key.Columns><o:Column Ref="c1"/></c:Key.Columns></o:Key></c:Keys><c:PrimaryKey><o:Key Ref="k1"/></c:PrimaryKey>
<c:Indexes><o:Index Id="x1"><a:Name>IX</a:Name><a:Unique>1</a:Unique><c:IndexColumns><o:IndexColumn Id="y1"><c:Column><o:Column Ref="c1"/></c:Column></o:IndexColumn></c:IndexColumns><c:LinkedObject><o:Key Ref="k1"/></c:LinkedObject></o:Index></c:Indexes></o:Table>
</c:Tables><c:References><o:Reference Id="f1"><a:Name>FK</a:Name><c:ParentTable><o:Table Ref="t1"/></c:ParentTable><c:ChildTable><o:Table Ref="t1"/></c:ChildTable>
<c:Joins><o:ReferenceJoin Id="j1"><c:Object1><o:Column Ref="c1"/></c:Object1><c:Object2><o:Column Ref="c2"/></c:Object2></o:ReferenceJoin></c:Joins></o:Reference></c:References></o:Model></Model>"""


PHYSICAL_TARGET = """<Export><Model id="m"><Entity id="T1" name="Orders"><EntityProps><Physical_Name>ORDERS</Physical_Name></EntityProps><Attribute_Groups>
<Attribute id="C1" name="Id"><AttributeProps><Physical_Name>ID</Physical_Name><Physical_Data_Type>INTEGER</Physical_Data_Type><Null_Option_Type>1</Null_Option_Type></AttributeProps></Attribute>
{note}</Attribute_Groups><Key_Group_Groups><Key_Group id="K1" name="XPK"><Key_GroupProps><Key_Group_Type>PK</Key_Group_Type></Key_GroupProps><Key_Group_Member_Groups>
<Key_Group_Member id="M1"><Key_Group_MemberProps><Attribute_Ref>C1</Attribute_Ref><Key_Group_Member_Order>1</Key_Group_Member_Order></Key_Group_MemberProps></Key_Group_Member>
<Key_Group_Member id="M0"><Key_Group_MemberProps><Attribute_Ref>C1</Attribute_Ref><Key_Group_Member_Order>2</Key_Group_Member_Order></Key_Group_MemberProps></Key_Group_Member></Key_Group_Member_Groups></Key_Group></Key_Group_Groups></Entity>
<Relationship id="F1" name="FK"><RelationshipProps><Parent_Entity_Ref>T1</Parent_Entity_Ref><Child_Entity_Ref>T1</Child_Entity_Ref></RelationshipProps></Relationship></Model></Export>"""
NOTE = """<Attribute id="C2" name="Note"><AttributeProps><Physical_Name>NOTE</Physical_Name><Physical_Data_Type>VARCHAR(5)</Physical_Data_Type><Null_Option_Type>0</Null_Option_Type>
<Parent_Relationship_Ref>F1</Parent_Relationship_Ref><Parent_Attribute_Ref>C1</Parent_Attribute_Ref></AttributeProps></Attribute>
<Attribute id="C9" name="Pad"><AttributeProps><Physical_Name>ID</Physical_Name><Physical_Data_Type>INTEGER</Physical_Data_Type><Null_Option_Type>1</Null_Option_Type></AttributeProps></Attribute>"""


def test_physical_pairs(spark, tmp_path):
    note = NOTE[: NOTE.index('<Attribute id="C9"')]
    for name, body in {"CLEAN": note, "LOST": "", "TWICE": NOTE}.items():
        (tmp_path / f"{name}.pdm").write_text(PHYSICAL_DOC)
        (tmp_path / f"{name}.xml").write_text(PHYSICAL_TARGET.format(note=body))
    raw = models.shred_physical(spark, f"{tmp_path}/CLEAN.pdm")
    assert {k: v.count() for k, v in raw.items()} == {"tables": 1, "columns": 2, "keys": 1, "indexes": 1, "references": 1, "joins": 1}
    assert [(c.code, c.data_type, c.not_null) for c in raw["columns"].orderBy("ord").collect()] == [("ID", "int", True), ("NOTE", "varchar2(5)", False)]
    s = models.comparable_physical(models.shred_physical(spark, f"{tmp_path}/*.pdm"))
    t = models.comparable_physical(models.shred_target_physical(spark, f"{tmp_path}/*.xml"))
    out = compare_physical_models(s, t, PHYSICAL)
    got = {}
    for r in out["findings"].where("severity <> 'VERIFIED'").collect():
        got.setdefault(r.pair_id, []).append(r.category)
    assert sorted(got["LOST"]) == ["COLUMN_MISSING", "FOREIGN_KEY_EXTRA", "FOREIGN_KEY_MISSING"]
    assert got["TWICE"] == ["COLUMN_DUPLICATE"] and "CLEAN" not in got
    rows = {r.pair_id: r for r in out["results"].collect()}
    assert (rows["CLEAN"].status, rows["CLEAN"].fidelity_score_raw, rows["CLEAN"].promote) == ("PASS", 100.0, True)
    assert rows["LOST"].blockers == ["CRITICAL_FINDINGS", "WARNINGS_UNSIGNED", "BELOW_TARGET"] and rows["TWICE"].columns_duplicate_t == 1
    assert all(r.broken == [] for r in rows.values())


def test_severity_policy(spark):
    rows = spark.createDataFrame([("DATA_TYPE", None), ("DATA_TYPE", "INFO"), ("ODD", None), ("DOMAIN", "CRITICAL")], "category string, severity string")
    tier = LOGICAL.with_(overrides={"DOMAIN": "IGNORE"})
    assert sorted(tuple(r) for r in apply_severity(rows, tier).collect()) == [("DATA_TYPE", "INFO"), ("DATA_TYPE", "WARNING"), ("ODD", "WARNING")]
    assert PHYSICAL.severity("ODD") == "INFO" and CONCEPTUAL.severity("LENGTH_PRECISION") == "INFO" and LOGICAL.severity("LENGTH_PRECISION") == "WARNING"


def test_gate_reads_the_raw_score(spark):
    rows = spark.createDataFrame([("a", 0, 0, 1, 20000), ("b", 0, 0, 0, 5), ("c", 9, 0, 0, 3)], "pair_id string, critical long, warning long, info long, n long")
    got = {r.pair_id: r for r in scoring.gate(scoring.fidelity_score(rows, PHYSICAL, F.col("n"))).collect()}
    assert got["a"].fidelity_score == 100.0 and not got["a"].promote and got["a"].blockers == ["BELOW_TARGET"]
    assert got["b"].promote and got["c"].fidelity_score == 0.0 and got["c"].status == "FAIL"


def test_config_snapshot_and_files(spark, tmp_path):
    rows = {r.setting: r.value for r in flow.config_snapshot(spark, LOGICAL).collect()}
    assert rows["type_mode"] == "family" and rows["name"] == "logical"
    (tmp_path / "One.ldm").write_text("x")
    listed = files.list_files(spark, str(tmp_path), "*.ldm").collect()
    assert len(listed) == 1 and listed[0].bytes == 1


def test_findings_export(spark, tmp_path):
    rows = spark.createDataFrame([("p", "A", "INFO", 'say "hi", there')], "pair_id string, category string, severity string, message string")
    for fmt in ("csv", "json"):
        files.write_findings(rows, str(tmp_path / fmt), fmt)
    back = spark.read.option("header", "true").option("escape", '"').csv(str(tmp_path / "csv"))
    assert back.first().message == 'say "hi", there' and spark.read.json(str(tmp_path / "json")).count() == 1


KEYED = SOURCE.replace('<c:Identifier.Attributes><o:EntityAttribute Ref="a3"/></c:Identifier.Attributes>',
                       '<c:Identifier.Attributes><o:EntityAttribute Ref="a4"/><o:EntityAttribute Ref="a3"/></c:Identifier.Attributes>').replace(
    '<a:DataType>I</a:DataType></o:EntityAttribute></c:Attributes>', """<a:DataType>I</a:DataType></o:EntityAttribute>
    <o:EntityAttribute Id="a4"><c:DataItem><o:DataItem Ref="x1"/></c:DataItem></o:EntityAttribute></c:Attributes>""").replace(
    "<c:Diagrams>", """<c:DataItems><o:DataItem Id="x1"><a:Name>Customer Id</a:Name><a:Code>CUST_ID</a:Code><a:DataType>VA9</a:DataType><a:Length>9</a:Length></o:DataItem></c:DataItems>
<c:ExternalObjects><o:Shortcut Id="s1"><a:Name>Term</a:Name><a:Code>TERM</a:Code><a:TargetClassID>EBE946CF-7218-4FAC-B85E-4AB922930494</a:TargetClassID></o:Shortcut></c:ExternalObjects>
<c:TermObjects><o:Shortcut Id="s2"><a:Name>Link</a:Name></o:Shortcut></c:TermObjects>
<c:TargetModels><o:TargetModel Id="t1"><a:Name>Words</a:Name><a:TargetModelURL>x.glm</a:TargetModelURL></o:TargetModel>
<o:TargetModel Id="t2"><a:Name>Ext</a:Name><a:TargetModelURL>y.xem</a:TargetModelURL></o:TargetModel></c:TargetModels><c:Diagrams>""")


def test_entities_and_areas_are_read_from_written_rows(fleet):
    """What every step of the comparison reads is neither parsed nor joined again."""
    for side in fleet[:2]:
        for name in ("entities", "areas", "identifiers") if side is fleet[1] else ("entities", "identifiers"):
            plan = side[name]._jdf.queryExecution().optimizedPlan().toString().lower()
            assert "relation" in plan and not any(x in plan for x in ("join", "from_xml", "xmltostructs", "_plain"))


def test_identifying_ends_items_and_references(spark, tmp_path):
    """The child's key takes its parent's member from a data item; only the list of external objects counts."""
    (tmp_path / "k.ldm").write_text(KEYED)
    got = models.comparable(models.shred_semantic(spark, str(tmp_path / "k.ldm")))
    rel = got["relationships"].first()
    assert (rel.end1.dependent, rel.end2.dependent) == (False, True)
    item = got["attributes"].where("id = 'a4'").first()
    assert (item.name, item.code, item.data_type, item.length) == ("Customer Id", "CUST_ID", "VA9", "9")
    assert [(x.name, x.type, x.target_model) for x in got["shortcuts"].collect()] == [("Term", "Term", "Words")]
    assert got["entities"].where("code = 'CUSTOMER'").first().definition == "Who buys"


@pytest.mark.parametrize("code, many", [("", "0,n"), ("-3", "0,n"), ("-1", "0,1"), ("1", "1,1"), ("5", "1,n"), ("one or more", "1,n")])
def test_children_per_parent(spark, code, many):
    from veritwin.functions.cardinality import children_per_parent

    assert spark.createDataFrame([(code,)], "c string").select(children_per_parent("c").alias("v")).first().v == many
