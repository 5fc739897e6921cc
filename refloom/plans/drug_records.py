"""Drug encyclopedia XML: drugs, targets, synonyms and external identifiers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from refloom.functions.arrays import first_where, lookup, pack
from refloom.functions.text import safe_text

_PROPERTIES = "struct<property: array<struct<kind: string, value: string>>>"
_IDENTIFIERS = "struct<`external-identifier`: array<struct<resource: string, identifier: string>>>"
DRUG = f"""
    _type string, `drugbank-id` array<struct<_VALUE: string, _primary: string>>, name string,
    description string, indication string, pharmacodynamics string, `mechanism-of-action` string,
    `cas-number` string, `calculated-properties` {_PROPERTIES}, `experimental-properties` {_PROPERTIES},
    synonyms struct<synonym: array<struct<_VALUE: string, _language: string, _coder: string>>>,
    `external-identifiers` {_IDENTIFIERS},
    targets struct<target: array<struct<
        id: string, name: string, organism: string, actions: struct<action: array<string>>,
        polypeptide: array<struct<`gene-name`: string, `external-identifiers`: {_IDENTIFIERS}>>>>>
"""


def _primary() -> Column:
    return first_where("drugbank-id", lambda x: x["_primary"] == "true", "_VALUE")


def keyed(raw: DataFrame) -> DataFrame:
    """Records with a primary id; drug elements nested in other parts have none."""
    return raw.withColumn("drugbank_id", _primary()).filter(safe_text("drugbank_id") != "")


def drugs(raw: DataFrame) -> DataFrame:
    """Drug rows; structure fields from the calculated properties, else the experimental ones."""
    calculated, measured = F.col("calculated-properties.property"), F.col("experimental-properties.property")
    return keyed(raw).select(
        "drugbank_id", "name", F.coalesce("_type", F.lit("")).alias("type"),
        *[safe_text(f"`{c}`").alias(c.replace("-", "_")) for c in ("description", "indication", "pharmacodynamics", "mechanism-of-action")],
        F.coalesce(F.col("cas-number"), F.lit("")).alias("cas_number"),
        lookup([calculated, measured], "SMILES").alias("smiles"), lookup([calculated], "InChI").alias("inchi"),
        lookup([calculated], "InChIKey").alias("inchikey"), lookup([calculated, measured], "Molecular Formula").alias("formula"),
    )


def synonyms(raw: DataFrame) -> DataFrame:
    rows = keyed(raw).select("drugbank_id", F.explode("synonyms.synonym").alias("s"))
    return rows.select(
        "drugbank_id", F.col("s._VALUE").alias("synonym"), F.coalesce("s._language", F.lit("")).alias("language"),
        F.coalesce("s._coder", F.lit("")).alias("coder"),
    )


def external_ids(raw: DataFrame) -> DataFrame:
    rows = keyed(raw).select("drugbank_id", F.explode(F.col("external-identifiers")["external-identifier"]).alias("x"))
    return rows.select("drugbank_id", "x.resource", "x.identifier")


def targets(raw: DataFrame) -> DataFrame:
    """One row per drug and target, with packed actions, gene name and protein id."""
    rows = keyed(raw).select("drugbank_id", F.explode("targets.target").alias("t"))
    protein = F.get("t.polypeptide", F.lit(0))
    ids = protein["external-identifiers"]["external-identifier"]
    return rows.select(
        "drugbank_id", F.col("t.id").alias("target_id"), F.col("t.name").alias("target_name"), "t.organism",
        pack("t.actions.action", "|").alias("actions"),
        F.coalesce(first_where(ids, lambda x: x["resource"] == "UniProtKB", "identifier"), F.lit("")).alias("uniprot_id"),
        F.coalesce(protein["gene-name"], F.lit("")).alias("gene_name"),
    )
