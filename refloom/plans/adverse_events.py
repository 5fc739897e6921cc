"""Safety reports: reports, drugs and reactions, and case search."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from refloom.functions.arrays import pack, text_list
from refloom.functions.text import safe_text
from refloom.operators.dedup import dedup_last
from refloom.operators.joins import case_bundle
from refloom.operators.nested import normalize
from refloom.operators.select import contains_any
from refloom.schemas import REACTION_COLUMNS, REPORT_COLUMNS, REPORT_DRUG_COLUMNS

# Where the report columns that are not top level come from.
NESTED_REPORT = {
    "reportercountry": "primarysource.reportercountry",
    "senderorganization": "sender.senderorganization",
    "patient_age": "patient.patientonsetage",
    "patient_age_unit": "patient.patientonsetageunit",
    "patient_sex": "patient.patientsex",
    "patient_death_date": "patient.patientdeath.patientdeathdate",
}


def tables(raw: DataFrame) -> dict[str, DataFrame]:
    """Nested safety reports to ``reports``, ``drugs`` and ``reactions``; unnamed reactions are dropped."""
    drug = []
    for name in REPORT_DRUG_COLUMNS[1:]:
        if name.startswith("openfda_"):
            value = pack(text_list(F.col(f"_c.openfda.{name[8:]}")), " | ")
        else:
            value = safe_text(F.col(f"_c.{name}"))
        drug.append(value.alias(name))
    report = [safe_text(NESTED_REPORT.get(c, c)).alias(c) for c in REPORT_COLUMNS]
    keyed = raw.withColumn("safetyreportid", safe_text("safetyreportid"))
    out = normalize(
        keyed,
        report,
        {
            "drugs": (F.col("patient.drug"), drug),
            "reactions": (F.col("patient.reaction"), [safe_text(F.col("_c.reactionmeddrapt")).alias("reactionmeddrapt")]),
        },
        "safetyreportid",
    )
    reactions = out["reactions"].filter("reactionmeddrapt <> ''").select(*REACTION_COLUMNS)
    return {"reports": out["parent"], "drugs": out["drugs"], "reactions": reactions}


def latest_versions(reports: DataFrame) -> DataFrame:
    """One row per report id: the version received last."""
    return dedup_last(reports, ["safetyreportid"], ["receiptdate", "receivedate", "transmissiondate"])


def search(found: dict[str, DataFrame], term: str, k: int = 5) -> DataFrame:
    """The first ``k`` cases with the term in an id, company, sender, product or reaction."""
    reports, drugs, reactions = found["reports"], found["drugs"], found["reactions"]
    matches = [
        reports.filter(contains_any(term, ["safetyreportid", "companynumb", "senderorganization"])),
        drugs.filter(contains_any(term, [
            "medicinalproduct", "openfda_brand_name", "openfda_generic_name", "openfda_substance_name"
        ])),
        reactions.filter(contains_any(term, ["reactionmeddrapt"])),
    ]
    # Children are ordered by their first field that all child tables have besides the id.
    kids = {
        "drugs": drugs.withColumn("_at", F.concat_ws("|", "medicinalproduct", "drugcharacterization", "drugindication")),
        "reactions": reactions.withColumn("_at", F.col("reactionmeddrapt")),
    }
    return case_bundle(reports, kids, "safetyreportid", matches, ["_at"], k)
