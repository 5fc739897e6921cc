"""Substance registrations and medicinal chemistry records."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from refloom.functions.arrays import distinct_ordered, names, pack, synonyms, where
from refloom.functions.text import safe_text
from refloom.schemas import ACTIVITY_COLUMNS


def registrations(raw: DataFrame) -> DataFrame:
    """Flat substance rows: registry numbers and other names packed, in order, each once."""
    cas = where("codes", lambda c: c["codeSystem"] == "CAS", "code")
    other = synonyms(F.transform("names", lambda n: n["name"]), safe_text("_name"), sort=False)
    return raw.select(
        safe_text("uuid").alias("uuid"), safe_text("approvalID").alias("unii"), safe_text("_name").alias("preferred_name"),
        safe_text("substanceClass").alias("substance_class"), safe_text("status").alias("status"),
        safe_text("definitionType").alias("definition_type"), safe_text("definitionLevel").alias("definition_level"),
        F.coalesce("deprecated", F.lit(False)).alias("deprecated"),
        pack(distinct_ordered(cas), "|").alias("cas_number"), pack(other, "|").alias("synonyms"),
    )


def _sorted_names(array: str, field: str):
    return pack(F.array_sort(F.array_distinct(names(array, field))), "|")


def molecules(raw: DataFrame) -> DataFrame:
    """Compounds with properties, structures and sorted distinct synonyms."""
    return raw.select(
        F.coalesce("molecule_chembl_id", "chembl_id").alias("chembl_id"), "pref_name", "molecule_type", "max_phase",
        *[F.col(f"molecule_properties.{c}") for c in ("mw_freebase", "alogp", "hba", "hbd")],
        *[F.col(f"molecule_structures.{c}") for c in ("canonical_smiles", "standard_inchi_key")],
        _sorted_names("molecule_synonyms", "molecule_synonym").alias("synonyms"), "similarity",
    )


def targets(raw: DataFrame) -> DataFrame:
    return raw.select(
        "target_chembl_id", "pref_name", "target_type", "organism",
        _sorted_names("target_components", "accession").alias("accessions"),
    )


def activities(raw: DataFrame) -> DataFrame:
    """The declared activity columns; those a record lacks are NULL."""
    return raw.select(*[(F.col(c) if c in raw.columns else F.lit(None).cast("string").alias(c)) for c in ACTIVITY_COLUMNS])


def activity_pages(payloads: DataFrame, payload: str = "payload", molecule: str | None = None, target: str | None = None, kind: str | None = None, relation: str | None = None) -> DataFrame:
    """Activities out of the ``activities`` lists of reply pages, optionally of one molecule, target, type (in any case) or relation."""
    fields = ", ".join(f"{c}: string" for c in ACTIVITY_COLUMNS)
    parsed = F.from_json(payload, f"activities array<struct<{fields}>>")
    rows = payloads.select(F.inline(parsed["activities"]))
    wanted = {"molecule_chembl_id": molecule, "target_chembl_id": target, "relation": relation}
    for column, value in wanted.items():
        rows = rows.filter(F.col(column) == value) if value is not None else rows
    return rows.filter(F.lower("type") == kind.lower()) if kind is not None else rows
