"""Subject heading files: descriptors, qualifiers, pharmacological actions, supplemental concepts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from refloom.functions.arrays import names, pack, synonyms
from refloom.functions.codes import record_kind
from refloom.functions.text import safe_text
from refloom.operators.select import require_key

_NAMED = "struct<String: string>"
_CONCEPTS = f"""struct<Concept: array<struct<
    _PreferredConceptYN: string, ScopeNote: string,
    RegistryNumberList: struct<RegistryNumber: array<string>>,
    TermList: struct<Term: array<struct<String: string, Abbreviation: string>>>>>>"""
_REFERRED = f"struct<DescriptorUI: string, DescriptorName: {_NAMED}>"

DESCRIPTOR = f"""
    DescriptorUI string, DescriptorName {_NAMED}, ConceptList {_CONCEPTS},
    TreeNumberList struct<TreeNumber: array<string>>,
    PharmacologicalActionList struct<PharmacologicalAction: array<struct<DescriptorReferredTo: {_REFERRED}>>>
"""
QUALIFIER = f"""
    QualifierUI string, QualifierName {_NAMED}, ConceptList {_CONCEPTS},
    TreeNumberList struct<TreeNumber: array<string>>
"""
ACTION = f"""
    DescriptorReferredTo {_REFERRED},
    PharmacologicalActionSubstanceList struct<Substance: array<struct<RecordUI: string, RecordName: {_NAMED}>>>
"""
SUPPLEMENTAL = f"""
    SupplementalRecordUI string, SupplementalRecordName {_NAMED}, ConceptList {_CONCEPTS},
    HeadingMappedToList struct<HeadingMappedTo: array<struct<DescriptorReferredTo: {_REFERRED}>>>
"""

CONCEPTS = "ConceptList.Concept"


def _last(array: Column) -> Column:
    """Last non-empty text, ``''`` if none."""
    return F.coalesce(F.get(F.reverse(F.filter(array, lambda x: safe_text(x) != "")), F.lit(0)), F.lit(""))


def _preferred() -> Column:
    return F.filter(CONCEPTS, lambda c: c["_PreferredConceptYN"] == "Y")


def _scope_note() -> Column:
    return safe_text(_last(F.transform(_preferred(), lambda c: c["ScopeNote"])))


def _registry_number() -> Column:
    numbers = F.transform(_preferred(), lambda c: F.get(c["RegistryNumberList"]["RegistryNumber"], F.lit(0)))
    return safe_text(_last(numbers))


def _terms(preferred: Column) -> Column:
    terms = F.flatten(F.transform(
        CONCEPTS, lambda c: F.coalesce(names(c["TermList"]["Term"], "String"), F.array().cast("array<string>"))
    ))
    return pack(synonyms(terms, preferred), ";")


def _tree_numbers() -> Column:
    return pack(F.transform("TreeNumberList.TreeNumber", lambda x: F.trim(x)), ";")


def descriptors(raw: DataFrame) -> DataFrame:
    """Headings with note, tree numbers, registry number, sorted synonyms and sorted actions."""
    rows = require_key(raw, "DescriptorUI", "DescriptorName.String")
    name = safe_text("DescriptorName.String")
    actions = F.transform(
        "PharmacologicalActionList.PharmacologicalAction", lambda a: F.trim(a["DescriptorReferredTo"]["DescriptorName"]["String"])
    )
    return rows.select(
        F.col("DescriptorUI").alias("descriptor_ui"), name.alias("name"), _scope_note().alias("scope_note"),
        _tree_numbers().alias("tree_numbers"), _registry_number().alias("registry_number"), _terms(name).alias("synonyms"),
        pack(F.array_sort(actions), ";").alias("pharmacological_actions"),
    )


def qualifiers(raw: DataFrame) -> DataFrame:
    """Qualifiers with note, tree numbers and the abbreviation of the last concept that has one."""
    rows = require_key(raw, "QualifierUI", "QualifierName.String")
    short = F.transform(CONCEPTS, lambda c: F.get(names(c["TermList"]["Term"], "Abbreviation"), F.lit(0)))
    return rows.select(
        F.col("QualifierUI").alias("qualifier_ui"), safe_text("QualifierName.String").alias("name"),
        safe_text(_last(short)).alias("abbreviation"), _scope_note().alias("scope_note"), _tree_numbers().alias("tree_numbers"),
    )


def actions(raw: DataFrame) -> DataFrame:
    """One row per action and substance."""
    rows = require_key(raw, "DescriptorReferredTo.DescriptorUI", "DescriptorReferredTo.DescriptorName.String")
    rows = rows.select(
        F.col("DescriptorReferredTo.DescriptorUI").alias("action_descriptor_ui"),
        safe_text("DescriptorReferredTo.DescriptorName.String").alias("action_name"),
        F.explode("PharmacologicalActionSubstanceList.Substance").alias("s"),
    )
    rows = rows.select(
        "action_descriptor_ui", "action_name", F.col("s.RecordUI").alias("substance_record_ui"),
        safe_text("s.RecordName.String").alias("substance_name"),
    )
    return require_key(rows, "substance_record_ui", "substance_name").withColumn(
        "substance_type", record_kind("substance_record_ui")
    )


def supplementals(raw: DataFrame) -> DataFrame:
    """Supplemental concepts with the headings they map to."""
    rows = require_key(raw, "SupplementalRecordUI", "SupplementalRecordName.String")
    name = safe_text("SupplementalRecordName.String")
    mapped = F.transform("HeadingMappedToList.HeadingMappedTo", lambda h: h["DescriptorReferredTo"])
    return rows.select(
        F.col("SupplementalRecordUI").alias("supplemental_ui"), name.alias("name"), _registry_number().alias("registry_number"),
        pack(F.transform(mapped, lambda d: F.trim(d["DescriptorUI"])), ";").alias("heading_mapped_to_uis"),
        pack(F.transform(mapped, lambda d: F.trim(d["DescriptorName"]["String"])), ";").alias("heading_mapped_to_names"),
        _terms(name).alias("synonyms"),
    )
