"""Medicine dossiers: document extractions merged per medicine, with the trials they name."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from refloom.operators.aggregate import first_non_null, union_lists
from refloom.operators.dedup import dedup_either
from refloom.operators.nested import explode_json
from refloom.operators.skew import join_keys
from refloom.schemas import DOSSIER_MASTER_COLUMNS, DOSSIER_TEXT_COLUMNS, DOSSIER_TRIAL_COLUMNS, DOSSIER_TRIALS

KEYS = ["medicine_name", "ema_product_number"]


def pending_documents(downloads: DataFrame, documents: DataFrame, medicines: DataFrame, extracted: DataFrame) -> DataFrame:
    """Completed downloads with their document and medicine that have no extraction yet."""
    ready = downloads.filter("status = 'completed'").join(documents, "document_url").join(medicines, "ema_product_number")
    return ready.join(extracted.select("document_url"), "document_url", "left_anti")


def extraction_base(extractions: DataFrame, medicines: DataFrame) -> DataFrame:
    """Completed extractions with the master columns of their medicine."""
    master = medicines.select("ema_product_number", *DOSSIER_MASTER_COLUMNS)
    return extractions.filter("extraction_status = 'completed'").join(master, "ema_product_number", "left")


def profiles(base: DataFrame, order: str = "document_url") -> DataFrame:
    """One row per medicine: first known value of each field, union of the trial numbers."""
    base = base.filter("medicine_name is not null and ema_product_number is not null")
    facts = first_non_null(base, KEYS, [*DOSSIER_MASTER_COLUMNS, *DOSSIER_TEXT_COLUMNS], [order])
    numbers = union_lists(base.filter("nct_numbers is not null"), KEYS, "nct_numbers", ",")
    joined = join_keys(facts, numbers, KEYS, "left")
    return joined.withColumns({
        "nct_numbers": F.coalesce("nct_numbers", F.lit("")), "part": F.coalesce("part", F.lit(0).cast("long"))
    })


def trials(base: DataFrame, order: str = "document_url") -> DataFrame:
    """One row per trial named in any document of a medicine; bad lists are skipped."""
    return explode_json(base, "clinical_trials_json", DOSSIER_TRIALS, [*KEYS, order, "document_type"])


def dossier(base: DataFrame, order: str = "document_url") -> DataFrame:
    """Medicine profiles by trials: trials that share number or title count once, medicines without any stay.

    Facts and trials are joined to the first part of a medicine; further parts only go on with its list of trial numbers.
    """
    named = trials(base, order)
    once = dedup_either(named, KEYS, "nct_id", "brief_title", [order, "item_pos"])
    named = once.select(*KEYS, *DOSSIER_TRIAL_COLUMNS).withColumn("part", F.lit(0).cast("long"))
    return join_keys(profiles(base, order), named, [*KEYS, "part"], "left")
