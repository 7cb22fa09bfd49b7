"""Model documents (XML) -> the relations the comparison reads.

One scan of the documents yields the elements of all kinds (:func:`.documents.elements`); each kind is parsed by the
built-in ``from_xml`` with an explicit schema. An element with ``Id`` defines an object, one with ``Ref`` only points at
it; pointers are dropped. Reading XML is an ingest step: write the relations to Parquet once (:func:`ingest`), compare
from there.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import cardinality as card
from ..functions import types as ty
from ..functions.records import join_notes
from ..functions.richtext import plain
from ..functions.text import first_nonblank, text, trim_ws
from ..operators.shaping import derive_identifying, drop_hidden_duplicates, inherit_scalar, is_migrated_key, mark_primary, physical_fk_joins, resolve_refs, subtype_trees
from ..plans.semantic import resolve_owner_model
from ..session import stored
from .documents import document_status, elements

# Element names of the source document.
_REF = "struct<`_Ref`: string>"
_DOC = "`a:Name` string, `a:Code` string, `a:Comment` string, `a:Description` string, `a:Annotation` string"
_DOC_IN = _DOC.replace("` string", "`: string")
_TYPE_IN = "`a:DataType`: string, `a:Length`: string, `a:Precision`: string"
_ATTRIBUTE = (
    f"struct<`_Id`: string, {_DOC_IN}, {_TYPE_IN}, `a:LogicalAttribute.Mandatory`: string, `a:Mandatory`: string, "
    f"`a:PrimaryIdentifier`: string, `c:Domain`: struct<`o:Domain`: {_REF}>, `c:DataItem`: struct<`o:DataItem`: {_REF}>>")
_IDENTIFIER = (
    f"struct<`_Id`: string, {_DOC_IN}, `c:Identifier.Attributes`: struct<`o:EntityAttribute`: array<{_REF}>>>")
_ENTITY = (
    f"`_Id` string, {_DOC}, `c:Attributes` struct<`o:EntityAttribute`: array<{_ATTRIBUTE}>>, "
    f"`c:Identifiers` struct<`o:Identifier`: array<{_IDENTIFIER}>>, `c:PrimaryIdentifier` struct<`o:Identifier`: {_REF}>")
_LINKED = f"struct<`o:Entity`: {_REF}, `o:Association`: {_REF}>"
SOURCE = {
    "entity": ("o:Entity", _ENTITY),
    "association": ("o:Association", _ENTITY),
    "association_link": (
        "o:AssociationLink",
        f"`_Id` string, `_Ref` string, {_DOC}, `a:Cardinality` string, `a:RoleCardinality` string, `a:Role` string, `a:Mandatory` string, "
        f"`a:Dependent` string, `c:Object1` {_LINKED}, `c:Object2` {_LINKED}"),
    "package": ("o:Package", "`_Id` string, `a:Name` string, `a:Code` string"),
    "relationship": (
        "o:Relationship",
        f"`_Id` string, {_DOC}, `c:Object1` struct<`o:Entity`: {_REF}>, `c:Object2` struct<`o:Entity`: {_REF}>, "
        f"`c:ParentIdentifier` struct<`o:Identifier`: {_REF}>, "
        + ", ".join(f"`a:{a}{f}` string" for a in ("Entity1ToEntity2Role", "Entity2ToEntity1Role") for f in ("", "Cardinality", "Mandatory", "Dependent"))),
    "inheritance": ("o:Inheritance", f"`_Id` string, {_DOC}, `a:Complete` string, `a:MutuallyExclusive` string, `c:ParentEntity` struct<`o:Entity`: {_REF}>"),
    "link": ("o:InheritanceLink", f"`_Id` string, `c:Object1` struct<`o:Inheritance`: {_REF}>, `c:Object2` struct<`o:Entity`: {_REF}>"),
    "domain": ("o:Domain", f"`_Id` string, {_DOC}, `a:DataType` string, `a:Length` string, `a:Precision` string"),
    "rule": ("o:BusinessRule", f"`_Id` string, {_DOC}, `a:BusinessRule.Type` string, `a:ServerExpression` string, `a:ClientExpression` string"),
    "shortcut": (
        "c:ExternalObjects",
        f"`o:Shortcut` array<struct<`_Id`: string, `_Ref`: string, {_DOC_IN}, `a:TargetStereotype`: string, `a:TargetPackagePath`: string, `a:TargetClassID`: string>>"),
    "attached": ("o:TargetModel", f"`_Id` string, `a:Name` string, `a:Code` string, `a:TargetModelURL` string, `c:SessionShortcuts` struct<`o:Shortcut`: array<{_REF}>>"),
    "item": ("o:DataItem", f"`_Id` string, {_DOC}, `a:DataType` string, `a:Length` string, `a:Precision` string"),
    "table": (
        "o:Table",
        f"`_Id` string, {_DOC}, `c:Columns` struct<`o:Column`: array<struct<`_Id`: string, {_DOC_IN}, {_TYPE_IN}, `a:Column.Mandatory`: string, `a:Mandatory`: string, `a:DefaultValue`: string>>>, "
        f"`c:Keys` struct<`o:Key`: array<struct<`_Id`: string, {_DOC_IN}, `c:Key.Columns`: struct<`o:Column`: array<{_REF}>>>>>, `c:PrimaryKey` struct<`o:Key`: {_REF}>, "
        f"`c:Indexes` struct<`o:Index`: array<struct<`_Id`: string, {_DOC_IN}, `a:Unique`: string, `c:IndexColumns`: struct<`o:IndexColumn`: array<struct<`c:Column`: struct<`o:Column`: {_REF}>>>>, `c:LinkedObject`: struct<`o:Key`: {_REF}, `o:Reference`: {_REF}>>>>"),
    "reference": (
        "o:Reference",
        f"`_Id` string, {_DOC}, `c:ParentTable` struct<`o:Table`: {_REF}>, `c:ChildTable` struct<`o:Table`: {_REF}>, "
        f"`c:Joins` struct<`o:ReferenceJoin`: array<struct<`c:Object1`: struct<`o:Column`: {_REF}>, `c:Object2`: struct<`o:Column`: {_REF}>>>>"),
}

# Classes that an external reference can point at; others are objects.
REFERENCE_CLASSES = {
    "186C8AC3-D3DC-11D3-881C-00508B03C75C": "Model",
    "CD2F5C71-2CA9-4B74-9BBA-50786D1D88EF": "Category",
    "EBE946CF-7218-4FAC-B85E-4AB922930494": "Term",
}

# Element names of the target document. A value may sit in an
# attribute, a child, or a child of the Props element.
_ATTR_PROPS = (
    "Name", "Physical_Name", "Definition", "Comment", "Logical_Data_Type", "Physical_Data_Type", "Null_Option_Type",
    "Parent_Attribute_Ref", "Parent_Relationship_Ref", "Parent_Domain_Ref", "Hide_In_Logical", "Logical_Lead_Attribute_Ref", "Type",
    "Default_Value")


def _props(names) -> str:
    return "struct<" + ", ".join(f"`{n}`: string" for n in names) + ">"


_T_ATTRIBUTE = f"struct<`_id`: string, `_name`: string, `AttributeProps`: {_props(_ATTR_PROPS)}, `Name`: string, `Physical_Name`: string>"
_T_MEMBER = f"struct<`_id`: string, `Key_Group_MemberProps`: {_props(('Attribute_Ref', 'Key_Group_Member_Order'))}>"
_T_KEY = (
    f"struct<`_id`: string, `_name`: string, `Key_GroupProps`: {_props(('Name', 'Key_Group_Type', 'Physical_Name', 'Is_Unique', 'Relationship_Ref'))}, "
    f"`Key_Group_Member_Groups`: struct<`Key_Group_Member`: array<{_T_MEMBER}>>>")
TARGET = {
    "entity": (
        "Entity",
        "`_id` string, `_name` string, `Name` string, `Physical_Name` string, `Definition` string, `Is_Associative` string, `Associative_Entity` string, "
        "`EntityProps` struct<`Name`: string, `Physical_Name`: string, `Definition`: string, `Comment`: string, `Type`: string, "
        "`Is_Associative`: string, `Associative_Entity`: string, "
        "`Note_List_Array`: struct<`Note_List`: array<string>>>, "
        f"`Attribute_Groups` struct<`Attribute`: array<{_T_ATTRIBUTE}>>, `Key_Group_Groups` struct<`Key_Group`: array<{_T_KEY}>>"),
    "relationship": (
        "Relationship",
        "`_id` string, `_name` string, `RelationshipProps` "
        + _props(("Name", "Parent_Entity_Ref", "Child_Entity_Ref", "Type", "Cardinality", "Null_Option_Type", "Parent_To_Child_Verb_Phrase", "Child_To_Parent_Verb_Phrase", "Definition"))),
    "domain": ("Domain", "`_id` string, `_name` string, `DomainProps` " + _props(("Name", "Physical_Name", "Logical_Data_Type", "Physical_Data_Type", "Definition", "Built_In_Id"))),
    "rule": ("Validation_Rule", "`_id` string, `_name` string, `Validation_RuleProps` " + _props(("Name", "Definition", "Server_Value", "Expression"))),
    "constraint": (
        "RI_Constraint",
        ", ".join(f"`{p}{e}_Attribute_Ref` string, `{p}{e}_Attribute` string" for p in ("_", "") for e in ("Parent", "Child"))
        + ", `RI_ConstraintProps` " + _props(("Parent_Attribute_Ref", "Parent_Attribute", "Child_Attribute_Ref", "Child_Attribute"))),
    "area": ("Subject_Area", "`_name` string, `Name` string, `Subject_AreaProps` " + _props(("Name",))),
}
_MEMBER = (
    "`_Entity_Ref` string, `_Object_Ref` string, `_id` string, `_Ref` string, `Entity_Ref` string, `Object_Ref` string, "
    + ", ".join(f"`{m}Props` {_props(('Entity_Ref', 'Object_Ref'))}" for m in ("Subject_Area_Member", "Subject_Area_Entity", "Member")))
AREA_MEMBERS = ("Subject_Area_Member", "Entity_Ref", "Member", "Subject_Area_Entity")


def source_elements(spark: SparkSession, paths) -> DataFrame:
    """All elements of source documents that this module reads; packages are scopes."""
    kinds = {tag: (kind, "" if kind in ("shortcut", "association_link") else "Id") for kind, (tag, _) in SOURCE.items()}
    return elements(spark, paths, kinds, scopes={"package": ("a:Name", "a:Code")}, once=("entity", "association"))


def target_elements(spark: SparkSession, paths) -> DataFrame:
    """All elements of target documents that this module reads; subject areas and relationships are scopes."""
    kinds = {tag: (kind, "" if kind in ("area", "constraint") else "id") for kind, (tag, _) in TARGET.items()}
    kinds.update({tag: ("area_member", "") for tag in AREA_MEMBERS})
    return elements(spark, paths, kinds, scopes={"area": ("Name", "Subject_AreaProps"), "relationship": None})


def read_definitions(found: DataFrame, schema: str, *kinds: str) -> DataFrame:
    """Elements of some kinds as columns, with the file they came from, their order in it and their scope.

    Rows of the other kinds are skipped in the copy; no document is read again.
    """
    parsed = found.where(F.col("kind").isin(*kinds)).select(
        "source_file", "kind", "ord", "scope", F.from_xml("fragment", schema, {"mode": "PERMISSIVE"}).alias("_x"))
    return parsed.select("source_file", "kind", "ord", "scope", "_x.*")


def _c(path: str) -> Column:
    return F.col(".".join(f"`{p}`" for p in path.split("|")))


def _doc(prefix: str = "") -> list[Column]:
    def of(tag):
        return _c(f"{prefix}{tag}")

    code = F.coalesce(F.nullif(trim_ws(of("a:Code")), F.lit("")), trim_ws(of("a:Name")))
    comment, description, annotation = (plain(of(f"a:{t}")) for t in ("Comment", "Description", "Annotation"))
    return [
        trim_ws(of("a:Name")).alias("name"), code.alias("code"), text(first_nonblank(comment, description, annotation)).alias("definition"),
        comment.alias("comment"), description.alias("description"), annotation.alias("annotation")]


def _flag(c: Column) -> Column:
    return F.lower(trim_ws(c)).isin("1", "true")


def shred_semantic(spark: SparkSession, paths, pair_id: Column | None = None) -> dict[str, DataFrame]:
    """Relations of source documents; ``pair_id`` defaults to the file's base name."""
    from .files import base_name

    pair = (base_name("source_file") if pair_id is None else pair_id).alias("pair_id")

    found = source_elements(spark, paths)

    def read(kind):
        return read_definitions(found, SOURCE[kind][1], kind)

    # An association is an entity that resolves a many-to-many relationship. An entity's area is the package around it.
    # Entities feed several relations, so they are parsed once.
    ent = stored(read_definitions(found, _ENTITY, "entity", "association").select(pair, "*"), "entities")
    packages = read("package").select("source_file", pair, F.col("ord").alias("scope"), text(first_nonblank(_c("a:Name"), _c("a:Code"))).alias("subject_area"))
    entities = ent.select(
        "pair_id", "source_file", "scope", F.col("_Id").alias("id"), "ord", *_doc(), (F.col("kind") == "association").alias("is_associative"),
        F.greatest(F.size(_c("c:Attributes|o:EntityAttribute")), F.lit(0)).alias("n_attributes"),
        F.greatest(F.size(_c("c:Identifiers|o:Identifier")), F.lit(0)).alias("n_identifiers"))
    # Every step of the comparison reads them again, so their texts are cleaned and their areas looked up once.
    entities = stored(entities.join(packages.drop("pair_id"), ["source_file", "scope"], "left").drop("source_file", "scope").withColumn(
        "subject_area", text("subject_area")), "placed-entities")
    own = ent.select("pair_id", F.col("_Id").alias("entity"), F.posexplode(_c("c:Attributes|o:EntityAttribute")).alias("ord", "a"))
    own = own.where(F.col("a._Id").isNotNull())
    attributes = own.select(
        "pair_id", "entity", "ord", F.col("a._Id").alias("id"), *_doc("a|"), text(_c("a|a:DataType")).alias("data_type"),
        text(_c("a|a:Length")).alias("length"), text(_c("a|a:Precision")).alias("precision"),
        _flag(F.coalesce(_c("a|a:LogicalAttribute.Mandatory"), _c("a|a:Mandatory"))).alias("mandatory"),
        _flag(_c("a|a:PrimaryIdentifier")).alias("is_primary"), text(_c("a|c:Domain|o:Domain|_Ref")).alias("domain_ref"), text(_c("a|c:DataItem|o:DataItem|_Ref")).alias("item_ref"),
        F.lit(False).alias("is_migrated"))
    keys = ent.select("pair_id", F.col("_Id").alias("entity"), _c("c:PrimaryIdentifier|o:Identifier|_Ref").alias("primary_oid"),
                      F.posexplode(_c("c:Identifiers|o:Identifier")).alias("ord", "k")).where(F.col("k._Id").isNotNull())
    identifiers = keys.select(
        "pair_id", "entity", "ord", F.col("k._Id").alias("id"), *_doc("k|"), F.transform(_c("k|c:Identifier.Attributes|o:EntityAttribute"), lambda x: x["_Ref"]).alias("member_refs"))
    rel = read("relationship").select(pair, "*")

    def end(ref, role, many):
        a = f"a:{role}"
        stated, mandatory = trim_ws(_c(f"{a}Cardinality")), _flag(_c(f"{a}Mandatory"))
        derived = F.concat(F.when(mandatory, "1").otherwise("0"), F.lit(",n" if many else ",1"))
        return F.struct(
            text(_c(f"{ref}|o:Entity|_Ref")).alias("entity"), text(_c(a)).alias("role"),
            F.when(stated == "", derived).otherwise(stated).alias("cardinality"), mandatory.alias("mandatory"), F.lit(False).alias("dependent"))

    # Which end depends is not stated: it follows from the keys, see comparable().
    stated = rel.select(
        "pair_id", F.col("_Id").alias("id"), "ord", *_doc(), end("c:Object1", "Entity1ToEntity2Role", True).alias("end1"),
        end("c:Object2", "Entity2ToEntity1Role", False).alias("end2"), F.lit("RELATIONSHIP").alias("kind"),
        trim_ws(_c("c:ParentIdentifier|o:Identifier|_Ref")).alias("parent_key"))
    relationships = card.canonical_ends(stated.unionByName(_association_links(read("association_link").where("`_Ref` is null").select(pair, "*"))))
    inh = read("inheritance").select(pair, "*").select(
        "pair_id", F.col("_Id").alias("id"), *_doc(), _flag(_c("a:Complete")).alias("complete"),
        _flag(_c("a:MutuallyExclusive")).alias("mutually_exclusive"), text(_c("c:ParentEntity|o:Entity|_Ref")).alias("parent_ref"))
    links = read("link").select(pair, "*").select(
        "pair_id", _c("c:Object1|o:Inheritance|_Ref").alias("id"), _c("c:Object2|o:Entity|_Ref").alias("child_ref"))

    def typed(kind):
        return read(kind).select(pair, "*").select(
            "pair_id", F.col("_Id").alias("id"), *_doc(), *[text(_c(f"a:{t}")).alias(n) for t, n in (("DataType", "data_type"), ("Length", "length"), ("Precision", "precision"))])

    rules = read("rule").select(pair, "*").select(
        "pair_id", F.col("_Id").alias("id"), *_doc(), text(first_nonblank(_c("a:ServerExpression"), _c("a:ClientExpression"))).alias("expression"))
    listed = read("shortcut").select(pair, F.explode("`o:Shortcut`").alias("x"))
    kind = ty.lookup(REFERENCE_CLASSES, F.upper(trim_ws(_c("x|a:TargetClassID"))))
    shortcuts = listed.where(F.col("x._Id").isNotNull() & F.col("x._Ref").isNull()).select(
        "pair_id", F.col("x._Id").alias("id"), *_doc("x|"), F.coalesce(kind, F.lit("Object")).alias("type"),
        text(_c("x|a:TargetPackagePath")).alias("target_package"), text(_c("x|a:TargetStereotype")).alias("target_stereotype"))
    models = read("attached").select(pair, "*").withColumn("model", text(first_nonblank(_c("a:Name"), _c("a:Code"))))
    attached = models.select("pair_id", "model", F.lower(trim_ws(_c("a:TargetModelURL"))).endswith(".xem").alias("is_extension"))
    claims = models.select("pair_id", "model", F.explode(_c("c:SessionShortcuts|o:Shortcut")).alias("x")).groupBy(
        "pair_id", F.col("x._Ref").alias("id")).agg(F.max("model").alias("target_model"))
    return {
        "entities": entities, "attributes": attributes, "identifiers": identifiers, "relationships": relationships, "inheritances": inh,
        "inheritance_links": links, "domains": typed("domain"), "business_rules": rules, "shortcuts": shortcuts, "attached": attached, "claims": claims,
        "data_items": typed("item"), "documents": document_status(found, pair),
        "areas": packages.where("subject_area <> ''").select("pair_id", "subject_area").distinct(),
        "pointers": ent.select("pair_id", F.col("_Id").alias("entity"), _c("c:PrimaryIdentifier|o:Identifier|_Ref").alias("primary_oid"))}


def _association_links(links: DataFrame) -> DataFrame:
    """A link between an entity and an association as a relationship; either may stand first."""

    def ref(tag, first, second):
        return text(first_nonblank(_c(f"c:{first}|o:{tag}|_Ref"), _c(f"c:{second}|o:{tag}|_Ref")))

    many = text(first_nonblank(_c("a:Cardinality"), _c("a:RoleCardinality")))
    entity = F.struct(
        ref("Entity", "Object1", "Object2").alias("entity"), text(_c("a:Role")).alias("role"), F.when(many == "", "0,n").otherwise(many).alias("cardinality"),
        _flag(_c("a:Mandatory")).alias("mandatory"), _flag(_c("a:Dependent")).alias("dependent"))
    association = F.struct(
        ref("Association", "Object2", "Object1").alias("entity"), F.lit("").alias("role"), F.lit("1,1").alias("cardinality"),
        F.lit(False).alias("mandatory"), F.lit(False).alias("dependent"))
    return links.select(
        "pair_id", F.col("_Id").alias("id"), "ord", *_doc(), entity.alias("end1"), association.alias("end2"), F.lit("ASSOCIATION").alias("kind"),
        F.lit("").alias("parent_key"))


def shred_target(spark: SparkSession, paths, pair_id: Column | None = None) -> dict[str, DataFrame]:
    """Relations of target documents, in the columns of :func:`shred_semantic`."""
    from .files import base_name

    pair = (base_name("source_file") if pair_id is None else pair_id).alias("pair_id")

    found = target_elements(spark, paths)

    def read(kind):
        return read_definitions(found, TARGET[kind][1], kind).select(pair, "*")

    ent = stored(read("entity"), "entities")  # they feed several relations, so they are parsed once
    named = read("area").select("source_file", F.col("ord").alias("scope"), text(first_nonblank("_name", "Name", "Subject_AreaProps.Name")).alias("subject_area"))
    props = [f"{m}Props.{r}" for m in ("Subject_Area_Member", "Subject_Area_Entity", "Member") for r in ("Entity_Ref", "Object_Ref")]
    ref = text(first_nonblank("_Entity_Ref", "_Object_Ref", "Entity_Ref", "Object_Ref", *props, "_id", "_Ref"))
    members = read_definitions(found, _MEMBER, "area_member").where("scope is not null").select(pair, "source_file", "scope", ref.alias("id"))
    # An entity of several areas counts for the first that names it.
    placed = stored(members.join(named.where("subject_area <> ''"), ["source_file", "scope"]).groupBy("pair_id", "source_file", "id").agg(
        F.min_by("subject_area", "scope").alias("subject_area")), "members")
    name = first_nonblank("_name", "Name", "EntityProps.Name")
    entities = ent.select(
        "pair_id", "source_file", F.col("_id").alias("id"), "ord", text(name).alias("name"),
        text(first_nonblank("Physical_Name", "EntityProps.Physical_Name", name)).alias("code"),
        text(first_nonblank("Definition", "EntityProps.Definition", "EntityProps.Comment")).alias("definition"),
        join_notes(_c("EntityProps|Note_List_Array|Note_List")).alias("note"),
        _flag(first_nonblank("Is_Associative", "Associative_Entity", "EntityProps.Is_Associative", "EntityProps.Associative_Entity")).alias("is_associative"),
        F.greatest(F.size(_c("Attribute_Groups|Attribute")), F.lit(0)).alias("n_attributes"),
        F.greatest(F.size(_c("Key_Group_Groups|Key_Group")), F.lit(0)).alias("n_identifiers"))
    entities = stored(
        entities.join(placed.drop("pair_id"), ["source_file", "id"], "left").drop("source_file").withColumn("subject_area", text("subject_area")), "placed-entities")
    own = ent.select("pair_id", F.col("_id").alias("entity"), F.posexplode(_c("Attribute_Groups|Attribute")).alias("ord", "a"))
    props = "a.AttributeProps"
    a_name = first_nonblank("a._name", "a.Name", f"{props}.Name")
    rows = own.where(F.col("a._id").isNotNull()).select(
        "pair_id", "entity", "ord", F.col("a._id").alias("id"), F.col("a._id").alias("oid"), text(a_name).alias("name"),
        text(first_nonblank("a.Physical_Name", f"{props}.Physical_Name", a_name)).alias("code"),
        text(first_nonblank(f"{props}.Definition", f"{props}.Comment")).alias("definition"),
        text(first_nonblank(f"{props}.Logical_Data_Type", f"{props}.Physical_Data_Type")).alias("data_type"), F.lit("").alias("length"), F.lit("").alias("precision"),
        F.coalesce(
            ty.lookup(card.ATTRIBUTE_NULLS, trim_ws(f"{props}.Null_Option_Type")) == "false",
            F.lower(trim_ws(f"{props}.Null_Option_Type")).isin(*card.NOT_NULL_TOKENS)).alias("mandatory"),
        text(f"{props}.Parent_Domain_Ref").alias("domain_ref"), _flag(F.col(f"{props}.Hide_In_Logical")).alias("hidden"),
        text(f"{props}.Logical_Lead_Attribute_Ref").alias("lead_ref"),
        is_migrated_key([], f"{props}.Type", f"{props}.Parent_Attribute_Ref").alias("is_migrated"))
    keys = ent.select("pair_id", F.col("_id").alias("entity"), F.posexplode(_c("Key_Group_Groups|Key_Group")).alias("ord", "k"))
    group = trim_ws("k.Key_GroupProps.Key_Group_Type")
    order = F.col("k.Key_Group_Member_Groups.Key_Group_Member")
    members = F.transform(
        F.array_sort(F.transform(order, lambda x: F.struct(
            x["Key_Group_MemberProps"]["Key_Group_Member_Order"].cast("int").alias("n"), x["Key_Group_MemberProps"]["Attribute_Ref"].alias("ref")))),
        lambda x: x["ref"])
    identifiers = keys.where(F.col("k._id").isNotNull()).select(
        "pair_id", "entity", "ord", F.col("k._id").alias("id"), text(first_nonblank("k._name", "k.Key_GroupProps.Name")).alias("name"),
        text("k.Key_GroupProps.Physical_Name").alias("code"), (F.upper(group) == "PK").alias("is_primary"), group.alias("key_group"), members.alias("member_refs"))
    r = "RelationshipProps"
    rel = read("relationship")
    nulls_ok = ty.lookup(card.RELATIONSHIP_NULLS, trim_ws(f"{r}.Null_Option_Type"))
    kind = card.resolve_enum(f"{r}.Type", card.RELATIONSHIP_TYPES)["value"]
    identifying, many = kind == "IDENTIFYING", kind == "MANY_TO_MANY"
    # An end's cardinality counts its own entity as seen from the other end.
    required = identifying | F.coalesce(nulls_ok == "false", F.lit(False))
    parents = F.concat(F.when(required, "1").otherwise("0"), F.when(many, ",n").otherwise(",1"))
    children = card.children_per_parent(f"{r}.Cardinality")
    parent_end = F.struct(
        text(f"{r}.Parent_Entity_Ref").alias("entity"), text(f"{r}.Child_To_Parent_Verb_Phrase").alias("role"), parents.alias("cardinality"),
        required.alias("mandatory"), F.lit(False).alias("dependent"))
    child_end = F.struct(
        text(f"{r}.Child_Entity_Ref").alias("entity"), text(f"{r}.Parent_To_Child_Verb_Phrase").alias("role"), children.alias("cardinality"),
        children.startswith("1").alias("mandatory"), identifying.alias("dependent"))
    relationships = rel.select(
        "pair_id", F.col("_id").alias("id"), "ord", text(first_nonblank("_name", f"{r}.Name")).alias("name"), F.lit("").alias("code"),
        text(f"{r}.Definition").alias("definition"), parent_end.alias("end1"), child_end.alias("end2"), F.lit("RELATIONSHIP").alias("kind"), kind.alias("type"))
    d = "DomainProps"
    domains = read("domain").where(trim_ws(f"{d}.Built_In_Id").isin("", "0")).select(
        "pair_id", F.col("_id").alias("id"), text(first_nonblank("_name", f"{d}.Name")).alias("name"), text(first_nonblank(f"{d}.Physical_Name", "_name")).alias("code"),
        text(f"{d}.Definition").alias("definition"), text(first_nonblank(f"{d}.Logical_Data_Type", f"{d}.Physical_Data_Type")).alias("data_type"),
        F.lit("").alias("length"), F.lit("").alias("precision"))
    v = "Validation_RuleProps"
    rules = read("rule").select(
        "pair_id", F.col("_id").alias("id"), text(first_nonblank("_name", f"{v}.Name")).alias("name"), F.lit("").alias("code"),
        text(f"{v}.Definition").alias("definition"), text(first_nonblank(f"{v}.Expression", f"{v}.Server_Value")).alias("expression"))
    return {
        "entities": entities, "attributes": rows, "identifiers": identifiers, "relationships": card.canonical_ends(relationships),
        "domains": domains, "business_rules": rules, "documents": document_status(found, pair),
        "areas": placed.select("pair_id", "subject_area").distinct()}


def shred_physical(spark: SparkSession, paths, pair_id: Column | None = None) -> dict[str, DataFrame]:
    """Tables, columns, keys, indexes and references of source documents."""
    from .files import base_name

    pair = (base_name("source_file") if pair_id is None else pair_id).alias("pair_id")
    found = source_elements(spark, paths)
    tab = stored(read_definitions(found, SOURCE["table"][1], "table").select(pair, "*"), "tables")
    head = ["pair_id", F.col("_Id").alias("table_id")]
    tables = tab.select(*head, "ord", *_doc(), F.greatest(F.size(_c("c:Columns|o:Column")), F.lit(0)).alias("n_columns"))
    cols = tab.select(*head, F.posexplode(_c("c:Columns|o:Column")).alias("ord", "a")).where(F.col("a._Id").isNotNull())
    length, precision = text(_c("a|a:Length")), text(_c("a|a:Precision"))
    columns = cols.select(
        "pair_id", "table_id", "ord", F.col("a._Id").alias("id"), *_doc("a|"), _sized(text(_c("a|a:DataType")), length, precision).alias("data_type"), _flag(F.coalesce(_c("a|a:Column.Mandatory"), _c("a|a:Mandatory"))).alias("not_null"), text(_c("a|a:DefaultValue")).alias("default_value"))
    keys = tab.select(*head, _c("c:PrimaryKey|o:Key|_Ref").alias("primary_oid"), F.posexplode(_c("c:Keys|o:Key")).alias("ord", "k")).where(
        F.col("k._Id").isNotNull()).select(
        "pair_id", "table_id", "ord", F.col("k._Id").alias("id"), *_doc("k|"), F.coalesce(F.col("k._Id") == F.col("primary_oid"), F.lit(False)).alias("is_pk"),
        F.transform(_c("k|c:Key.Columns|o:Column"), lambda x: x["_Ref"]).alias("member_refs"))
    indexes = tab.select(*head, F.posexplode(_c("c:Indexes|o:Index")).alias("ord", "x")).where(F.col("x._Id").isNotNull()).select(
        "pair_id", "table_id", "ord", F.col("x._Id").alias("id"), *_doc("x|"), _flag(_c("x|a:Unique")).alias("is_unique"),
        _c("x|c:LinkedObject").isNotNull().alias("mirror"),
        F.transform(_c("x|c:IndexColumns|o:IndexColumn"), lambda i: i["c:Column"]["o:Column"]["_Ref"]).alias("member_refs"))
    ref = read_definitions(found, SOURCE["reference"][1], "reference").select(pair, "*")
    references = ref.select(
        "pair_id", F.col("_Id").alias("id"), "ord", *_doc(), _c("c:ParentTable|o:Table|_Ref").alias("parent_ref"), _c("c:ChildTable|o:Table|_Ref").alias("child_ref"))
    joins = ref.select("pair_id", F.col("_Id").alias("id"), F.posexplode(_c("c:Joins|o:ReferenceJoin")).alias("n", "j")).select(
        "pair_id", "id", "n", F.col("j.`c:Object1`.`o:Column`._Ref").alias("parent_col"), F.col("j.`c:Object2`.`o:Column`._Ref").alias("child_col"))
    return {"tables": tables, "columns": columns, "keys": keys, "indexes": indexes, "references": references, "joins": joins}


def _sized(dtype: Column, length: Column, precision: Column) -> Column:
    """A type with its separate length and precision written into it."""
    dims = F.when(precision != "", F.concat(length, F.lit(","), precision)).otherwise(length)
    glue = (dtype != "") & (length != "") & ~F.contains(dtype, F.lit("("))
    return F.when(glue, F.concat(dtype, F.lit("("), dims, F.lit(")"))).otherwise(dtype)


def shred_target_physical(spark: SparkSession, paths, pair_id: Column | None = None) -> dict[str, DataFrame]:
    """Tables, columns, keys, indexes, references and join columns of target documents.

    Join columns are the constraints that the relationship lists; where it lists none, the child's migrated attributes
    that point back at it. Indexes the tool made for a relationship are left out.
    """
    from .files import base_name

    pair = (base_name("source_file") if pair_id is None else pair_id).alias("pair_id")
    found = target_elements(spark, paths)
    ent = stored(read_definitions(found, TARGET["entity"][1], "entity").select(pair, "*"), "entities")
    name = first_nonblank("_name", "Name", "EntityProps.Name")
    head = ["pair_id", F.col("_id").alias("table_id")]
    tables = ent.select(
        *head, "ord", text(name).alias("name"), text(first_nonblank("Physical_Name", "EntityProps.Physical_Name", name)).alias("code"),
        F.greatest(F.size(_c("Attribute_Groups|Attribute")), F.lit(0)).alias("n_columns"))
    own = ent.select(*head, F.posexplode(_c("Attribute_Groups|Attribute")).alias("ord", "a")).where(F.col("a._id").isNotNull())
    props = "a.AttributeProps"
    code = first_nonblank("a.Physical_Name", f"{props}.Physical_Name", "a._name", "a.Name", f"{props}.Name")
    columns = own.select(
        "pair_id", "table_id", "ord", F.col("a._id").alias("id"), text(code).alias("code"),
        text(first_nonblank(f"{props}.Physical_Data_Type", f"{props}.Logical_Data_Type")).alias("data_type"),
        F.coalesce(ty.lookup(card.PHYSICAL_NOT_NULL, trim_ws(f"{props}.Null_Option_Type")) == "true", F.lit(False)).alias("not_null"),
        text(f"{props}.Default_Value").alias("default_value"), trim_ws(f"{props}.Parent_Relationship_Ref").alias("rel_ref"),
        trim_ws(f"{props}.Parent_Attribute_Ref").alias("parent_col"))
    groups = ent.select(*head, F.posexplode(_c("Key_Group_Groups|Key_Group")).alias("ord", "k")).where(F.col("k._id").isNotNull())
    kind = F.upper(trim_ws("k.Key_GroupProps.Key_Group_Type"))
    primary, alternate = kind.isin("PK", "PRIMARY KEY", "PRIMARY"), kind.isin("AK", "ALTERNATE KEY", "ALTERNATE")
    members = F.transform(
        F.array_sort(F.transform("k.Key_Group_Member_Groups.Key_Group_Member", lambda x: F.struct(
            x["Key_Group_MemberProps"]["Key_Group_Member_Order"].cast("int").alias("n"), x["Key_Group_MemberProps"]["Attribute_Ref"].alias("ref")))),
        lambda x: x["ref"])
    every = groups.select(
        "pair_id", "table_id", "ord", F.col("k._id").alias("id"), text(first_nonblank("k._name", "k.Key_GroupProps.Name")).alias("name"),
        primary.alias("is_pk"), (primary | alternate | F.lower(trim_ws("k.Key_GroupProps.Is_Unique")).isin("1", "true", "yes", "y")).alias("is_unique"),
        (primary | alternate).alias("_key"), (trim_ws("k.Key_GroupProps.Relationship_Ref") != "").alias("_made"), F.lit(False).alias("mirror"), members.alias("member_refs"))
    rel = read_definitions(found, TARGET["relationship"][1], "relationship").select(pair, "*")
    r = "RelationshipProps"
    references = rel.select(
        "pair_id", F.col("_id").alias("id"), "ord", text(first_nonblank("_name", f"{r}.Name")).alias("name"), F.lit("").alias("code"),
        text(f"{r}.Parent_Entity_Ref").alias("parent_ref"), text(f"{r}.Child_Entity_Ref").alias("child_ref"))
    migrated = columns.where("rel_ref <> ''").select(
        "pair_id", F.col("rel_ref").alias("id"), F.col("ord").alias("n"), "parent_col", F.col("id").alias("child_col"))

    def stated(end):
        places = [f"{p}{end}_Attribute{r}" for p in ("_", "", "RI_ConstraintProps.") for r in ("_Ref", "")]
        return text(first_nonblank(*places))

    owners = rel.select("pair_id", "source_file", F.col("ord").alias("scope"), F.col("_id").alias("id"))
    explicit = read_definitions(found, TARGET["constraint"][1], "constraint").join(owners, ["source_file", "scope"]).select(
        "pair_id", "id", F.col("ord").alias("n"), stated("Parent").alias("parent_col"), stated("Child").alias("child_col"))
    joins = physical_fk_joins(explicit, migrated, ["pair_id", "id"])
    return {
        "tables": tables, "columns": columns, "keys": every.where("_key").drop("_key", "_made"),
        "indexes": every.where("not _key and not _made").drop("_key", "_made"), "references": references, "joins": joins}


def comparable_physical(side: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Shredded physical relations with ids resolved to upper-case codes."""
    tables = side["tables"].withColumn("table", F.upper(trim_ws("code")))
    ids = tables.select("pair_id", "table_id", "table")
    on = ["pair_id", "table_id"]
    columns = side["columns"].withColumn("column", F.upper(trim_ws("code")))

    def grouped(kind):
        return resolve_members(side[kind], columns, on).join(ids, on)

    dim = ids.select("pair_id", F.col("table_id").alias("oid"), F.col("table").alias("code"))
    refs = resolve_refs(side["references"], ["pair_id"], "parent_ref", dim, "parent_table")
    refs = resolve_refs(refs, ["pair_id"], "child_ref", dim, "child_table")
    names = columns.select("pair_id", F.col("id").alias("oid"), F.col("column").alias("code"))
    joins = side["joins"]
    for end in ("parent_col", "child_col"):
        joins = resolve_refs(joins, ["pair_id"], end, names, end, "")
    # The join columns of one reference: as many as its key has members.
    listed = joins.groupBy("pair_id", "id").agg(F.array_sort(F.collect_list(F.struct("parent_col", "child_col"))).alias("joins"))
    empty = F.array().cast("array<struct<parent_col:string,child_col:string>>")
    refs = refs.join(listed, ["pair_id", "id"], "left").withColumn("joins", F.coalesce("joins", empty))
    return {
        "tables": tables.select("pair_id", "table", "ord", "n_columns"),
        "columns": columns.join(ids, on).select("pair_id", "table", "column", "ord", "data_type", "not_null", "default_value"),
        "keys": grouped("keys").select("pair_id", "table", "ord", "name", "is_pk", F.lit(True).alias("is_unique"), F.lit(False).alias("mirror"), "members"),
        "indexes": grouped("indexes").select("pair_id", "table", "ord", "name", F.lit(False).alias("is_pk"), "is_unique", "mirror", "members"),
        "references": refs.select("pair_id", "ord", "name", "parent_table", "child_table", "joins")}


def resolve_members(df: DataFrame, attributes: DataFrame, scope: list[str]) -> DataFrame:
    """``member_refs`` -> ``members`` (codes, in order; an unresolved id stays)."""
    one = df.select(*scope, F.col("id").alias("_owner"), F.posexplode("member_refs").alias("_n", "_ref"))
    dim = attributes.select("pair_id", F.col("id").alias("_ref"), "code")
    named = one.join(dim, ["pair_id", "_ref"], "left").select(*scope, "_owner", "_n", F.coalesce("code", "_ref").alias("code"))
    listed = named.groupBy(*scope, "_owner").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("_n", "code"))), lambda x: x["code"]).alias("members"))
    joined = df.join(listed.withColumnRenamed("_owner", "id"), [*scope, "id"], "left")
    return joined.withColumn("members", F.coalesce("members", F.array().cast("array<string>"))).drop("member_refs")


def resolve_endpoints(relationships: DataFrame, entities: DataFrame) -> DataFrame:
    """Ends that name entities by id -> by code."""
    dim = entities.select("pair_id", F.col("id").alias("oid"), "code")
    for end in ("end1", "end2"):
        named = relationships.withColumn("_at", F.col(f"{end}.entity"))
        named = resolve_refs(named, ["pair_id"], "_at", dim, "_to")
        relationships = named.withColumn(end, F.col(end).withField("entity", F.col("_to"))).drop("_at", "_to")
    return relationships


def from_items(attributes: DataFrame, domains: DataFrame, items: DataFrame) -> DataFrame:
    """Attributes with what they leave blank from their data item (name, code, type) and their domain (type)."""
    linked = items.select("pair_id", F.col("id").alias("item_ref"), F.col("name").alias("_name"), F.col("code").alias("_code"))
    named = attributes.join(linked, ["pair_id", "item_ref"], "left")
    for c in ("name", "code"):
        named = named.withColumn(c, F.when(text(c) == "", text(f"_{c}")).otherwise(F.col(c)))
    return inherit_scalar(
        named.drop("_name", "_code"), domains.withColumnRenamed("id", "oid"), ["pair_id"], "domain_ref", items.withColumnRenamed("id", "oid"), "item_ref")


def with_dependent_end(rel: DataFrame, identifiers: DataFrame) -> DataFrame:
    """The child's end depends when the child's primary key shares a member with the parent's.

    The parent owns the identifier that the relationship names; ends still name entities by id. A link of an
    association keeps what it states.
    """
    owners = identifiers.select("pair_id", F.col("id").alias("parent_key"), F.col("entity").alias("parent")).where("parent_key <> ''")
    keys = identifiers.where("is_primary").groupBy("pair_id", "entity").agg(F.min_by("members", "ord").alias("members"))
    one, two = F.col("end1.entity"), F.col("end2.entity")
    child = F.when(F.col("parent") == one, two).when(F.col("parent") == two, one)
    known = derive_identifying(rel.join(owners, ["pair_id", "parent_key"], "left").withColumn("child", child), keys, ["pair_id"])
    first = F.col("identifying") & (F.col("child") == one) & (F.col("parent") == two)
    second = F.col("identifying") & (F.col("child") == two) & ~first
    link = F.col("kind") == "ASSOCIATION"
    return known.withColumns({
        "end1": F.col("end1").withField("dependent", F.when(link, F.col("end1.dependent")).otherwise(F.coalesce(first, F.lit(False)))),
        "end2": F.col("end2").withField("dependent", F.when(link, F.col("end2.dependent")).otherwise(F.coalesce(second, F.lit(False))))}).drop("parent", "child", "identifying", "parent_key")


def comparable(side: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Shredded relations with their references resolved, ready for the comparison."""
    dim = side["domains"].select("pair_id", F.col("id").alias("oid"), F.col("name").alias("code"))
    attributes = side["attributes"]
    if "data_items" in side:
        attributes = from_items(attributes, side["domains"], side["data_items"])
    attributes = resolve_refs(attributes, ["pair_id"], "domain_ref", dim, "domain", "")
    if "hidden" in attributes.columns:
        attributes = drop_hidden_duplicates(attributes)
    identifiers = resolve_members(side["identifiers"], attributes, ["pair_id", "entity"])
    if "pointers" in side:
        identifiers = stored(identifiers, "members")  # read several times, with the joins that resolve them
        identifiers = mark_primary(identifiers.withColumnRenamed("id", "oid"), attributes, side["pointers"], ["pair_id", "entity"]).withColumnRenamed("oid", "id")
    identifiers = stored(identifiers, "identifiers")  # read by the relationships as well
    rel = side["relationships"]
    if "type" in rel.columns:
        # A target relationship whose child resolves a many-to-many one is an association.
        bridge = side["entities"].where("is_associative").select("pair_id", F.col("id").alias("_child"), F.lit(True).alias("_bridge"))
        rel = rel.withColumn("_child", F.col("end2.entity")).join(bridge, ["pair_id", "_child"], "left").withColumn(
            "kind", F.when(F.col("_bridge"), "ASSOCIATION").otherwise(F.col("kind"))).drop("_child", "_bridge")
    if "parent_key" in rel.columns:
        rel = with_dependent_end(rel, identifiers)
    rel = resolve_endpoints(rel, side["entities"])
    codes = side["entities"].select("pair_id", F.col("id").alias("oid"), "code")
    if "inheritances" in side:
        trees = resolve_refs(side["inheritances"], ["pair_id"], "parent_ref", codes, "parent")
        children = resolve_refs(side["inheritance_links"], ["pair_id"], "child_ref", codes, "child")
    else:
        # The target writes a hierarchy as SUBTYPE relationships.
        flat = rel.select("pair_id", "ord", "type", F.col("end1.entity").alias("parent"), F.col("end2.entity").alias("child"))
        heads, children = subtype_trees(flat, ["pair_id"])
        trees = heads.select(
            "pair_id", F.col("parent").alias("id"), "parent", F.lit("").alias("name"), F.lit("").alias("code"),
            F.lit(False).alias("complete"), F.lit(True).alias("mutually_exclusive"))
        children = children.select("pair_id", F.col("parent").alias("id"), "child")
        rel = rel.where("type <> 'SUBTYPE'")
    out = {
        **side, "attributes": attributes, "relationships": rel, "inheritances": trees, "children": children,
        "identifiers": identifiers}
    if "shortcuts" in side:
        owned = resolve_owner_model(side["shortcuts"], side["claims"], side["attached"])
        out["shortcuts"] = owned.withColumn("target_model", text("target_model"))
    return out


def ingest(relations: dict[str, DataFrame], path: str) -> None:
    """Write the relations once; every comparison reads the Parquet copy."""
    for name, df in relations.items():
        df.write.mode("overwrite").parquet(f"{path}/{name}")


def load(spark: SparkSession, path: str, names: list[str]) -> dict[str, DataFrame]:
    return {n: spark.read.parquet(f"{path}/{n}") for n in names}
