"""Documents written from the given tables and read back by the real readers."""

from pyspark.sql import functions as F

from veritwin.config import LOGICAL
from veritwin.plans.models import compare_models
from veritwin.sources import models as docs

from .base import plain, query
from .flows import scratch

# One model per brand: its parts are the entities, all but the first related to the first.
_PARTS = """SELECT concat('B', substr(p_brand, 7)) AS doc, p_partkey AS k, p_name AS name, p_type AS mfgr,
  min(p_partkey) OVER (PARTITION BY p_brand) AS first FROM {part}"""

_SOURCE = """concat('<o:Entity Id="e', k, '"><a:Name>', name, '</a:Name><a:Code>P', k, '</a:Code><a:Comment>', CASE WHEN k % 3 = 0 THEN concat('{{\\\\rtf1\\\\ansi Made by ', mfgr, '}}') ELSE concat('Made by ', mfgr) END,
'</a:Comment><c:Attributes><o:EntityAttribute Id="a', k, '"><a:Name>Key</a:Name><a:Code>K', k % 3, '</a:Code><a:DataType>I</a:DataType></o:EntityAttribute><o:EntityAttribute Id="b', k, '"><c:DataItem><o:DataItem Ref="x', k % 5,
'"/></c:DataItem></o:EntityAttribute></c:Attributes><c:Identifiers><o:Identifier Id="i', k, '"><a:Name>PK</a:Name><a:Code>PK</a:Code><c:Identifier.Attributes><o:EntityAttribute Ref="a', k,
'"/></c:Identifier.Attributes></o:Identifier></c:Identifiers><c:PrimaryIdentifier><o:Identifier Ref="i', k, '"/></c:PrimaryIdentifier></o:Entity>')"""
_SOURCE_RELATION = """concat('<o:Relationship Id="r', k, '"><a:Name>uses</a:Name><a:Code>R', k, '</a:Code>', CASE WHEN k % 2 = 0 THEN '<a:Entity2ToEntity1RoleCardinality>1,n</a:Entity2ToEntity1RoleCardinality>' ELSE '' END,
'<a:Entity1ToEntity2RoleMandatory>', k % 2, '</a:Entity1ToEntity2RoleMandatory><a:Entity2ToEntity1RoleDependent>1</a:Entity2ToEntity1RoleDependent><c:ParentIdentifier><o:Identifier Ref="i', first,
'"/></c:ParentIdentifier><c:Object1><o:Entity Ref="e', first, '"/></c:Object1><c:Object2><o:Entity Ref="e', k, '"/></c:Object2></o:Relationship>')"""
_ITEMS = "".join(
    f'<o:DataItem Id="x{n}"><a:Name>Item {n}</a:Name><a:Code>ITEM{n}</a:Code><a:DataType>VA{n + 5}</a:DataType></o:DataItem>' for n in range(5))
_TARGET = """concat('<Entity id="e', k, '" name="', name, '"><EntityProps><Physical_Name>P', k, '</Physical_Name></EntityProps><Attribute_Groups><Attribute id="a', k,
'" name="Key"><AttributeProps><Physical_Name>K', k % 3, '</Physical_Name><Logical_Data_Type>INTEGER</Logical_Data_Type></AttributeProps></Attribute></Attribute_Groups></Entity>')"""
_TARGET_RELATION = """concat('<Relationship id="r', k, '" name="uses"><RelationshipProps><Parent_Entity_Ref>e', first, '</Parent_Entity_Ref><Child_Entity_Ref>e', k, '</Child_Entity_Ref><Type>', CASE WHEN k % 3 = 0 THEN '2' ELSE '7' END,
'</Type><Cardinality>', CASE k % 4 WHEN 0 THEN '-3' WHEN 1 THEN '' WHEN 2 THEN '1' ELSE '5' END, '</Cardinality><Null_Option_Type>', CASE WHEN k % 2 = 1 THEN '101' ELSE '100' END,
'</Null_Option_Type><Parent_To_Child_Verb_Phrase>has</Parent_To_Child_Verb_Phrase><Child_To_Parent_Verb_Phrase>of</Child_To_Parent_Verb_Phrase></RelationshipProps></Relationship>')"""


def composed(T, parts: dict[str, str], layout: list[str]) -> str:
    """A folder with one document per brand; those of brands that end in 5 lack their last characters.

    ``parts``: name -> text of one row, or NULL; ``layout``: names of parts, and constant texts between them. Every text is
    a line of the document, so none is put together in memory.
    """
    path = scratch(T)
    rows = T.sql(_PARTS)
    order = {x: n for n, x in enumerate(layout)}
    texts = rows.select("doc", F.explode(F.array(*[
        F.struct(F.lit(order[n]).alias("n"), "k", F.expr(x.replace("{{", "{").replace("}}", "}")).alias("value")) for n, x in parts.items()])).alias("x"))
    fixed = [F.struct(F.lit(n).alias("n"), F.lit(None).cast("long").alias("k"), (
        F.when(F.col("doc").endswith("5"), x[:-5]).otherwise(x) if n == len(layout) - 1 else F.lit(x)).alias("value")) for n, x in enumerate(layout) if x not in parts]
    between = rows.select("doc").distinct().select("doc", F.explode(F.array(*fixed)).alias("x"))
    lines = texts.union(between).select("doc", "x.*").where("value is not null")
    lines.repartition("doc").sortWithinPartitions("doc", "n", "k", "value").select("doc", "value").write.partitionBy("doc").text(path)
    return path


def written(T, entity: str, relation: str, head: str, between: str, tail: str) -> str:
    """Documents of entities and of the relations of all but the first."""
    return composed(T, {"e": entity, "r": f"CASE WHEN k <> first THEN {relation} END"}, [head, "e", between, "r", tail])


def facts(side) -> object:
    """kind, code and three values of every entity, attribute, relationship and document."""
    pair = F.col("pair_id")
    entities = side["entities"].select(pair, F.lit("ENTITY").alias("kind"), "code", F.col("name").alias("x"), F.coalesce("definition", F.lit("")).alias("y"), F.lit("").alias("z"))
    attributes = side["attributes"].select(pair, F.lit("ATTRIBUTE").alias("kind"), "code", F.col("entity").alias("x"), F.col("name").alias("y"), F.col("data_type").alias("z"))
    ends = [F.concat_ws(" ", f"{e}.entity", f"{e}.cardinality", f"{e}.role", F.when(F.col(f"{e}.dependent"), "dependent")) for e in ("end1", "end2")]
    relations = side["relationships"].select(pair, F.lit("RELATIONSHIP").alias("kind"), "id", ends[0].alias("x"), ends[1].alias("y"), F.lit("").alias("z"))
    status = side["documents"].select(
        pair, F.lit("DOCUMENT").alias("kind"), F.lit("").alias("code"), F.when(F.col("parse_error").isNull(), "").otherwise("broken").alias("x"), F.lit("").alias("y"), F.lit("").alias("z"))
    return entities.union(attributes).union(relations).union(status)




def pair():
    return F.regexp_extract("source_file", "doc=([^/]+)", 1)


_STATUS = "SELECT DISTINCT doc, 'DOCUMENT', '', CASE WHEN doc LIKE '%5' THEN 'broken' ELSE '' END, '', '' FROM p"


@query("ingest_semantic", f"""WITH p AS ({plain(_PARTS)}) SELECT doc AS pair_id, 'ENTITY' AS kind, 'P' || k AS code, name AS x, 'Made by ' || mfgr AS y, '' AS z FROM p
UNION ALL SELECT doc, 'ATTRIBUTE', 'K' || k % 3, 'e' || k, 'Key', 'I' FROM p UNION ALL SELECT doc, 'ATTRIBUTE', 'ITEM' || k % 5, 'e' || k, 'Item ' || k % 5, 'VA' || (k % 5 + 5) FROM p
UNION ALL SELECT doc, 'RELATIONSHIP', 'r' || k, 'P' || first || ' ' || k % 2 || ',n ', concat('P', k, CASE WHEN k % 2 = 0 THEN ' 1,n ' ELSE ' 0,1 ' END, CASE WHEN k % 3 = first % 3 THEN ' dependent' ELSE '' END), '' FROM p WHERE k <> first
UNION ALL {_STATUS}""")
def _ingest_semantic(T):
    """Rich text, data items, blank cardinalities, dependence by keys, broken files."""
    head = '<Model xmlns:a="attribute" xmlns:c="collection" xmlns:o="object"><o:RootObject Id="r"><c:Children><o:Model Id="m"><c:Entities>'
    path = written(T, _SOURCE, _SOURCE_RELATION, head, "</c:Entities><c:Relationships>", f"</c:Relationships><c:DataItems>{_ITEMS}</c:DataItems></o:Model></c:Children></o:RootObject></Model>")
    return facts(docs.comparable(docs.shred_semantic(T.spark, path, pair())))


@query("ingest_target", f"""WITH p AS ({plain(_PARTS)}) SELECT doc AS pair_id, 'ENTITY' AS kind, 'P' || k AS code, name AS x, '' AS y, '' AS z FROM p
UNION ALL SELECT doc, 'ATTRIBUTE', 'K' || k % 3, 'e' || k, 'Key', 'INTEGER' FROM p
UNION ALL SELECT doc, 'RELATIONSHIP', 'r' || k, concat('P', first, CASE WHEN k % 3 = 0 OR k % 2 = 1 THEN ' 1,1 of' ELSE ' 0,1 of' END),
  concat('P', k, CASE k % 4 WHEN 2 THEN ' 1,1 has' WHEN 3 THEN ' 1,n has' ELSE ' 0,n has' END, CASE WHEN k % 3 = 0 THEN ' dependent' ELSE '' END), '' FROM p WHERE k <> first
UNION ALL {_STATUS}""")
def _ingest_target(T):
    """Ends, cardinality codes, null options, identifying types, broken files."""
    path = written(T, _TARGET, _TARGET_RELATION, '<Export><Model id="m"><Entity_Groups>', "</Entity_Groups><Relationship_Groups>", "</Relationship_Groups></Model></Export>")
    return facts(docs.comparable(docs.shred_target(T.spark, path, pair())))


# Entities by k % 3: in the model, in a package, in a package inside that package. Every fourth part is linked to an association.
_PLACED = """CASE WHEN k % 3 = {n} THEN concat('<o:Entity Id="e', k, '"><a:Name>P', k, '</a:Name><a:Code>P', k, '</a:Code><c:Attributes><o:EntityAttribute Id="a', k,
'"><a:Code>K</a:Code><a:DataType>I</a:DataType><a:PrimaryIdentifier>', k % 2, '</a:PrimaryIdentifier></o:EntityAttribute></c:Attributes><c:Identifiers><o:Identifier Id="i', k,
'"><a:Name>PK</a:Name><c:Identifier.Attributes><o:EntityAttribute Ref="a', k, '"/></c:Identifier.Attributes></o:Identifier></c:Identifiers></o:Entity>') END"""
_ASSOCIATION = """CASE WHEN k % 4 = 0 THEN concat('<o:Association Id="s', k, '"><a:Name>Bridge ', k, '</a:Name><a:Code>S', k, '</a:Code></o:Association>') END"""
_ENDS = "'<c:Object{one}><o:Entity Ref=\"e', k, '\"/></c:Object{one}><c:Object{two}><o:Association Ref=\"s', k, '\"/></c:Object{two}>'"
_ASSOCIATION_LINK = f"""CASE WHEN k % 4 = 0 THEN concat('<o:AssociationLink Id="l', k, '"><a:Role>part</a:Role>', CASE WHEN k % 12 = 0 THEN '' ELSE '<a:Cardinality>1,n</a:Cardinality>' END,
'<a:Dependent>', CASE WHEN k % 16 = 0 THEN '1' ELSE '0' END, '</a:Dependent>', CASE WHEN k % 8 = 0 THEN concat({_ENDS.format(one=1, two=2)}) ELSE concat({_ENDS.format(one=2, two=1)}) END, '</o:AssociationLink>') END"""
_PACKAGED = {**{f"e{n}": _PLACED.replace("{n}", str(n)) for n in range(3)}, "a": _ASSOCIATION, "l": _ASSOCIATION_LINK}
_PACKAGED_LAYOUT = [
    '<?xml version="1.0" encoding="UTF-8"?><Model xmlns:a="attribute" xmlns:c="collection" xmlns:o="object"><o:RootObject Id="r"><c:Children><o:Model Id="m"><c:Entities>', "e0",
    "</c:Entities><c:Associations>", "a", "</c:Associations><c:AssociationLinks>", "l", '</c:AssociationLinks><c:Packages><o:Package Id="p1"><a:Name>Outer</a:Name><c:Entities>', "e1",
    '</c:Entities><c:Packages><o:Package Id="p2"><a:Name> </a:Name><a:Code>Inner &amp; deep</a:Code><c:Entities>', "e2",
    "</c:Entities></o:Package></c:Packages></o:Package></c:Packages></o:Model></c:Children></o:RootObject></Model>"]
_AREA = "CASE k % 3 WHEN 0 THEN '' WHEN 1 THEN 'Outer' ELSE 'Inner & deep' END"


@query("ingest_conceptual", f"""WITH p AS ({plain(_PARTS)})
SELECT doc AS pair_id, 'ENTITY' AS kind, 'P' || k AS code, {_AREA} AS x, '' AS y, CASE WHEN k % 2 = 1 THEN 'keyed' ELSE '' END AS z FROM p
UNION ALL SELECT doc, 'ENTITY', 'S' || k, '', 'associative', '' FROM p WHERE k % 4 = 0
UNION ALL SELECT doc, 'ASSOCIATION', 'l' || k, concat('P', k, CASE WHEN k % 12 = 0 THEN ' 0,n' ELSE ' 1,n' END, ' part', CASE WHEN k % 16 = 0 THEN ' dependent' ELSE '' END), 'S' || k || ' 1,1 ', '' FROM p WHERE k % 4 = 0
UNION ALL {_STATUS}""")
def _ingest_conceptual(T):
    """Packages inside packages, associations and their links with either end first, primary keys known by their attributes."""
    side = docs.comparable(docs.shred_semantic(T.spark, composed(T, _PACKAGED, _PACKAGED_LAYOUT), pair()))
    primary = side["identifiers"].where("is_primary").select("pair_id", F.col("entity").alias("id"), F.lit("keyed").alias("z"))
    blank = F.lit("")
    entities = side["entities"].join(primary, ["pair_id", "id"], "left").select(
        "pair_id", F.lit("ENTITY").alias("kind"), "code", F.col("subject_area").alias("x"), F.when(F.col("is_associative"), "associative").otherwise("").alias("y"), F.coalesce("z", blank).alias("z"))
    ends = [F.concat_ws(" ", f"{e}.entity", f"{e}.cardinality", f"{e}.role", F.when(F.col(f"{e}.dependent"), "dependent")) for e in ("end1", "end2")]
    links = side["relationships"].select("pair_id", "kind", "id", ends[0].alias("x"), ends[1].alias("y"), blank.alias("z"))
    status = side["documents"].select(
        "pair_id", F.lit("DOCUMENT").alias("kind"), blank.alias("code"), F.when(F.col("parse_error").isNull(), "").otherwise("broken").alias("x"), blank.alias("y"), blank.alias("z"))
    return entities.union(links).union(status)


# Areas of the target: every seventh part of the inner one is in the outer one, every fifth of the outer one in both.
_MEMBER = """concat('<Subject_Area_Member id="m', k, '"><Subject_Area_MemberProps><Entity_Ref>e', k, '</Entity_Ref></Subject_Area_MemberProps></Subject_Area_Member>')"""
_OUTER, _INNER = "(k % 3 = 1 OR k % 3 = 2 AND k % 7 = 0)", "(k % 3 = 2 AND k % 7 <> 0 OR k % 3 = 1 AND k % 5 = 0)"
_AREAS = {
    "e": """concat('<Entity id="e', k, '" name="P', k, '"><EntityProps><Physical_Name>P', k, '</Physical_Name></EntityProps></Entity>')""",
    "o": f"CASE WHEN {_OUTER} THEN {_MEMBER} END", "i": f"CASE WHEN {_INNER} THEN {_MEMBER} END"}
_AREAS_LAYOUT = [
    '<Export><Model id="m"><Entity_Groups>', "e", '</Entity_Groups><Subject_Area id="u1" name="Outer"><Members>', "o",
    "</Members></Subject_Area><Subject_Area id=\"u2\"><Subject_AreaProps><Name>Inner &amp; deep</Name></Subject_AreaProps><Members>", "i", "</Members></Subject_Area></Model></Export>"]


@query("subject_areas", f"""SELECT doc AS pair_id, 'P' || k AS object_name, 'Inner & deep' AS s_value, 'Outer' AS t_value FROM ({plain(_PARTS)}) p
WHERE k % 3 = 2 AND k % 7 = 0 AND doc NOT LIKE '%5'""")
def _subject_areas(T):
    """Areas that differ between packages and subject areas, found by the whole job over documents."""
    s = docs.comparable(docs.shred_semantic(T.spark, composed(T, {**_PACKAGED, "a": "''", "l": "''"}, _PACKAGED_LAYOUT), pair()))
    t = docs.comparable(docs.shred_target(T.spark, composed(T, _AREAS, _AREAS_LAYOUT), pair()))
    names = ("entities", "areas", "documents")
    tier = LOGICAL.with_(attributes=False)
    found = compare_models({n: s[n] for n in names}, {n: t[n] for n in names}, tier)["findings"]
    return found.where("category = 'SUBJECT_AREA'").select("pair_id", "object_name", "s_value", "t_value")


# Tables, and a reference from every part to the first. The target states the columns of every fourth one, which are not the migrated ones.
_TABLE = """concat('<o:Table Id="t', k, '"><a:Name>T', k, '</a:Name><a:Code>t', k, '</a:Code><c:Columns><o:Column Id="c', k, '"><a:Code>Id</a:Code><a:DataType>numeric</a:DataType><a:Length>', 5 + k % 4,
'</a:Length><a:Column.Mandatory>1</a:Column.Mandatory></o:Column><o:Column Id="d', k, '"><a:Code>Fk</a:Code><a:DataType>int</a:DataType></o:Column></c:Columns></o:Table>')"""
_REFERENCE = """CASE WHEN k <> first THEN concat('<o:Reference Id="f', k, '"><a:Name>F', k, '</a:Name><c:ParentTable><o:Table Ref="t', first, '"/></c:ParentTable><c:ChildTable><o:Table Ref="t', k,
'"/></c:ChildTable><c:Joins><o:ReferenceJoin Id="j', k, '"><c:Object1><o:Column Ref="c', first, '"/></c:Object1><c:Object2><o:Column Ref="d', k, '"/></c:Object2></o:ReferenceJoin></c:Joins></o:Reference>') END"""
_T_TABLE = """concat('<Entity id="t', k, '" name="t', k, '"><Attribute_Groups><Attribute id="c', k, '" name="Id"><AttributeProps><Physical_Data_Type>NUMERIC</Physical_Data_Type></AttributeProps></Attribute>', CASE WHEN k = first THEN '' ELSE
concat('<Attribute id="d', k, '" name="Fk"><AttributeProps><Physical_Data_Type>INT</Physical_Data_Type><Parent_Relationship_Ref>f', k, '</Parent_Relationship_Ref><Parent_Attribute_Ref>c', first, '</Parent_Attribute_Ref></AttributeProps></Attribute>') END, '</Attribute_Groups></Entity>')"""
_T_REFERENCE = """CASE WHEN k <> first THEN concat('<Relationship id="f', k, '" name="F', k, '"><RelationshipProps><Parent_Entity_Ref>t', first, '</Parent_Entity_Ref><Child_Entity_Ref>t', k, '</Child_Entity_Ref></RelationshipProps>', CASE WHEN k % 4 = 0 THEN
concat('<RI_Constraints><RI_Constraint Parent_Attribute_Ref="c', first, '"><RI_ConstraintProps><Child_Attribute_Ref>c', k, '</Child_Attribute_Ref></RI_ConstraintProps></RI_Constraint></RI_Constraints>') ELSE '' END, '</Relationship>') END"""


def physical_facts(side, label: str):
    columns = side["columns"].select("pair_id", F.lit(label).alias("side"), F.col("table").alias("x"), F.col("column").alias("y"), F.col("data_type").alias("z"))
    joins = F.array_join(F.transform("joins", lambda j: F.concat(j["parent_col"], F.lit("="), j["child_col"])), ", ")
    return columns.union(side["references"].select("pair_id", F.lit(label), "child_table", F.concat(F.lit("-> "), "parent_table"), joins))


@query("ingest_physical", f"""WITH p AS ({plain(_PARTS)}), r AS (SELECT * FROM p WHERE k <> first)
SELECT doc AS pair_id, 'S' AS side, 'T' || k AS x, 'ID' AS y, concat('numeric(', 5 + k % 4, ')') AS z FROM p UNION ALL SELECT doc, 'S', 'T' || k, 'FK', 'int' FROM p
UNION ALL SELECT doc, 'S', 'T' || k, '-> T' || first, 'ID=FK' FROM r UNION ALL SELECT doc, 'T', 'T' || k, 'ID', 'NUMERIC' FROM p UNION ALL SELECT doc, 'T', 'T' || k, 'FK', 'INT' FROM r
UNION ALL SELECT doc, 'T', 'T' || k, '-> T' || first, CASE WHEN k % 4 = 0 THEN 'ID=ID' ELSE 'ID=FK' END FROM r""")
def _ingest_physical(T):
    """Tables and references of both sides; stated join columns win over migrated ones."""
    head = '<Model xmlns:a="attribute" xmlns:c="collection" xmlns:o="object"><o:Model Id="m"><c:Tables>'
    s = composed(T, {"t": _TABLE, "f": _REFERENCE}, [head, "t", "</c:Tables><c:References>", "f", "</c:References></o:Model></Model>"])
    t = composed(T, {"t": _T_TABLE, "f": _T_REFERENCE}, ['<Export><Model id="m">', "t", "<Relationship_Groups>", "f", "</Relationship_Groups></Model></Export>"])
    own = docs.comparable_physical(docs.shred_physical(T.spark, s, pair()))
    return physical_facts(own, "S").union(physical_facts(docs.comparable_physical(docs.shred_target_physical(T.spark, t, pair())), "T"))
