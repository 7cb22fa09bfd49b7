"""Rules of a run: tiers, switches, severities, weights."""

from __future__ import annotations

from dataclasses import asdict, dataclass, field, replace
from decimal import Decimal

# Category -> severity, semantic tiers.
SEMANTIC_SEVERITIES = {
    "ENTITY_MISSING": "CRITICAL", "ENTITY_EXTRA": "WARNING",
    "ATTRIBUTE_MISSING": "CRITICAL", "ATTRIBUTE_EXTRA": "WARNING",
    "PRIMARY_IDENTIFIER": "CRITICAL", "ALTERNATE_IDENTIFIER": "WARNING",
    "IDENTIFIER_VERIFIED": "VERIFIED", "DOMAIN_VERIFIED": "VERIFIED",
    "INHERITANCE_VERIFIED": "VERIFIED", "SHORTCUT": "VERIFIED", "INHERITED_IDENTITY": "INFO",
    "IDENTIFYING_KEY_MIGRATION": "WARNING", "IDENTIFIER_UNDERSPECIFIED": "WARNING",
    "INVERSION_ENTRY": "INFO",
    "RELATIONSHIP_MISSING": "CRITICAL", "RELATIONSHIP_EXTRA": "WARNING",
    "CARDINALITY": "CRITICAL", "OPTIONALITY": "WARNING", "DEPENDENCY": "WARNING",
    "ROLE_NAME": "INFO", "INHERITANCE_MISSING": "CRITICAL", "INHERITANCE_EXTRA": "WARNING",
    "INHERITANCE_STRUCTURE": "CRITICAL", "INHERITANCE_CONSTRAINT": "WARNING",
    "ASSOCIATION": "WARNING", "MANDATORY": "WARNING",
    "BUSINESS_NAME": "WARNING", "DEFINITION": "INFO", "DEFINITION_LOSS": "WARNING",
    "DOMAIN": "WARNING", "DATA_ITEM": "INFO", "DATA_ITEM_VERIFIED": "VERIFIED",
    "DATA_TYPE": "WARNING", "LENGTH_PRECISION": "INFO", "ATTRIBUTE_ORDER": "INFO",
    "FALLBACK_MATCH": "INFO", "BUSINESS_RULE": "WARNING", "SUBJECT_AREA": "INFO",
    "MODEL_QUALITY": "WARNING", "MODEL_METADATA": "INFO",
    "PARSE_ERROR": "CRITICAL", "PARSE_WARNING": "WARNING", "EXCEPTION": "CRITICAL",
}

# Category -> severity, physical tier.
PHYSICAL_SEVERITIES = {
    "TABLE_MISSING": "CRITICAL", "TABLE_EXTRA": "WARNING", "TABLE_DUPLICATE": "CRITICAL",
    "TABLE_VERIFIED": "VERIFIED", "COLUMN_MISSING": "CRITICAL", "COLUMN_EXTRA": "WARNING",
    "COLUMN_DUPLICATE": "WARNING", "COLUMN_VERIFIED": "VERIFIED", "DATA_TYPE": "CRITICAL",
    "DATA_TYPE_LENGTH": "WARNING", "DATA_TYPE_ABSTRACT": "INFO", "NULLABILITY": "INFO",
    "DEFAULT": "INFO", "PRIMARY_KEY": "CRITICAL", "PRIMARY_KEY_T_ONLY": "INFO",
    "KEY_VERIFIED": "VERIFIED", "FOREIGN_KEY_MISSING": "WARNING", "FOREIGN_KEY_EXTRA": "INFO",
    "FOREIGN_KEY_DUPLICATE": "INFO", "REFERENCE_VERIFIED": "VERIFIED", "INDEX_MISSING": "INFO",
    "INDEX_EXTRA": "INFO", "INDEX_VERIFIED": "VERIFIED", "INDEX_MIRROR": "VERIFIED",
    "PARSE_ERROR": "CRITICAL", "EXCEPTION": "CRITICAL",
}

SEVERITY_RANK = {"CRITICAL": 0, "WARNING": 1, "INFO": 2}


@dataclass(frozen=True)
class Tier:
    """One tier of rules. Derive variants with :meth:`with_`."""

    name: str
    review_threshold: float
    severities: dict[str, str] = field(default_factory=dict)
    default_severity: str = "WARNING"
    overrides: dict[str, str] = field(default_factory=dict)
    # scoring
    weights: dict[str, Decimal] = field(
        default_factory=lambda: {
            "CRITICAL": Decimal("1.0"), "WARNING": Decimal("0.35"), "INFO": Decimal("0.05"),
        }
    )
    max_penalty_per_object: Decimal = Decimal("1.0")
    promotion_target: float = 100.0
    # matching
    match_key: str = "auto"
    case_insensitive: bool = True
    plurals: bool = True
    report_fallback: bool = True
    exclude_entities: tuple[str, ...] = ()
    exclude_attributes: tuple[str, ...] = ()
    # semantic switches
    entities: bool = True
    attributes: bool = True
    primary_identifiers: bool = True
    alternate_identifiers: bool = True
    attribute_order: bool = False
    relationships: bool = True
    cardinality: bool = True
    optionality: bool = True
    dependency: bool = True
    role_names: bool = True
    inheritance: bool = True
    associations: bool = True
    mandatory: bool = True
    business_names: bool = True
    definitions: bool = True
    definition_loss: bool = True
    domains: bool = True
    business_rules: bool = True
    subject_areas: bool = True
    model_quality: bool = True
    shortcuts: bool = True
    data_types: bool = True
    length_precision: bool = True
    length_only_if_type_agrees: bool = True
    approved_matrix: bool = True
    type_mode: str = "family"
    similarity_method: str = "levenshtein"
    similarity_threshold: float = 0.90
    migrated_keys: str = "relationship"
    recognise_key_migration: bool = False
    inversion_entries: bool = False
    # physical switches
    tables: bool = True
    columns: bool = True
    nullability: bool = True
    defaults: bool = True
    primary_keys: bool = True
    foreign_keys: bool = True
    indexes: bool = True
    skip_mirror_indexes: bool = True
    abstract_types: tuple[str, ...] = ("ENUM",)

    def with_(self, **changes) -> "Tier":
        return replace(self, **changes)

    def severity(self, category: str) -> str:
        return self.overrides.get(category, self.severities.get(category, self.default_severity))

    def as_rows(self) -> list[tuple[str, str]]:
        return sorted((k, str(v)) for k, v in asdict(self).items())


LOGICAL = Tier(
    name="logical", review_threshold=95.0, severities=SEMANTIC_SEVERITIES,
    overrides={"LENGTH_PRECISION": "WARNING"},
)
CONCEPTUAL = Tier(
    name="conceptual", review_threshold=95.0, severities=SEMANTIC_SEVERITIES,
    migrated_keys="ignore", recognise_key_migration=True, inversion_entries=True,
    shortcuts=False, approved_matrix=False, length_only_if_type_agrees=False,
)
PHYSICAL = Tier(
    name="physical", review_threshold=90.0, severities=PHYSICAL_SEVERITIES,
    default_severity="INFO",
)
TIERS = {t.name: t for t in (LOGICAL, CONCEPTUAL, PHYSICAL)}
