"""Approved products with their patents and exclusivities; biologics with their reference product."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from refloom.functions.text import exclusivity_detail, patent_detail
from refloom.operators.joins import cogroup_details, enrich_codes, resolve_reference
from refloom.operators.select import contains_any, pick

KEYS = ["Appl_Type", "Appl_No", "Product_No"]
# Product columns of the unified table, by source header.
PRODUCT_COLUMNS = {
    "Ingredient": "Ingredient", "Trade_Name": "Trade_Name", "Dosage_Form_Route": "DF;Route", "Strength": "Strength",
    "Applicant": "Applicant", "Applicant_Full_Name": "Applicant_Full_Name", "Appl_Type": "Appl_Type", "Appl_No": "Appl_No",
    "Product_No": "Product_No", "TE_Code": "TE_Code", "Approval_Date": "Approval_Date", "Type": "Type", "RLD": "RLD", "RS": "RS",
}


def with_definitions(rows: DataFrame, codes: DataFrame, code: str, text: str) -> DataFrame:
    """Add the definition of a code; ``codes`` has ``code`` and ``definition``."""
    return enrich_codes(rows, codes.select(F.col("code").alias(code), F.col("definition").alias(text)), [code], text)


def unify(products: DataFrame, patents: DataFrame, exclusivities: DataFrame, order: Sequence[str] = ()) -> DataFrame:
    """One row per product with counts and packed details of its patents and exclusivities.

    ``order`` names columns of both lists that give the place of a row in its file; without it details are sorted.
    """
    base = products.select(*[
        (F.coalesce(F.col(f"`{src}`"), F.lit("")) if src in products.columns else F.lit("")).alias(out)
        for out, src in PRODUCT_COLUMNS.items()
    ])
    patent = patent_detail(
        F.col("Patent_No"), F.col("Patent_Expire_Date_Text"), F.col("Patent_Use_Code"), F.col("Patent_Use_Definition")
    )
    exclusive = exclusivity_detail(F.col("Exclusivity_Code"), F.col("Exclusivity_Date"), F.col("Exclusivity_Definition"))
    lists = [("Active_Patents", patents, patent), ("Active_Exclusivities", exclusivities, exclusive)]
    unified = cogroup_details(base, KEYS, lists, order=order)
    names = [f"{n}_{part}" for n in ("Active_Patents", "Active_Exclusivities") for part in ("Count", "List")]
    return unified.select(*PRODUCT_COLUMNS, "part", *[F.col(n.lower()).alias(n) for n in names])


def search(unified: DataFrame, term: str, field: str = "Ingredient", k: int = 20) -> DataFrame:
    return unified.filter(contains_any(term, [field])).orderBy(*KEYS).limit(k)


# Columns of a biologic product: candidate headers and the value when there is none.
BIOLOGIC_COLUMNS = {
    "bla_number": (["BLA Number"], ""),
    "proprietary_name": (["Proprietary Name"], ""),
    "proper_name": (["Proper Name"], ""),
    "license_type": (["License Type", "BLA Type"], ""),
    "applicant": (["Applicant"], ""),
    "licensure": (["Licensure"], "Licensed"),
    "approval_date": (["Approval Date", "Original Approval Date"], ""),
    "marketing_status": (["Marketing Status"], "Rx"),
    "dosage_form": (["Dosage Form"], ""),
    "route_of_administration": (["Route of Administration"], ""),
    "strength": (["Strength"], ""),
    "product_presentation": (["Product Presentation"], ""),
    "product_number": (["Product Number"], ""),
    "center": (["Center"], ""),
    "date_of_first_licensure": (["Date of First Licensure"], ""),
    "exclusivity_expiration_date": (["Exclusivity Expiration Date"], ""),
    "first_interchangeable_exclusivity_exp_date": (
        ["First Interchangeable Exclusivity Exp. Date", "First Interchangeable Exclusivity Expiration Date"], ""),
    "ref_product_exclusivity_exp_date": (
        ["Ref. Product Exclusivity Exp. Date", "Reference Product Exclusivity Expiration Date"], ""),
    "orphan_exclusivity_exp_date": (["Orphan Exclusivity Exp. Date", "Orphan Exclusivity Expiration Date"], ""),
    "patent_list_provided": (["Patent List Provided"], "No"),
    "reference_proprietary_name": (["Ref. Product Proprietary Name", "Reference Product Proprietary Name"], "N/A"),
    "reference_proper_name": (["Ref. Product Proper Name", "Reference Product Proper Name"], "N/A"),
}
# Fixed value: address of a product label.
LABEL_URL = "https://www.accessdata.fda.gov/scripts/cder/daf/index.cfm?event=overview.process&ApplNo="


def biologics(products: DataFrame, patents: DataFrame, order: str, listed_order: Sequence[str] = ("patent_number", "expires")) -> DataFrame:
    """Biologic products under any header spelling, with resolved reference number and its patents.

    ``order`` is the place of a row in the product list: for a repeated brand the last one counts. ``listed_order`` names columns of the patent list
    that give the order of a product's patents, such as the place in the file.
    """
    flat = products.select(order, *[pick(products, heads, default).alias(c) for c, (heads, default) in BIOLOGIC_COLUMNS.items()])
    listed = patents.select(
        pick(patents, ["Reference Product BLA Number", "BLA Number"]).alias("number"),
        pick(patents, ["Patent Number"]).alias("patent_number"),
        pick(patents, ["Patent Expiration Date"]).alias("expires"),
        *[c for c in listed_order if c in patents.columns],
    )
    roles = flat.withColumns({
        "number": F.col("bla_number"), "name": F.col("proprietary_name"), "licence": F.col("license_type"),
        "reference_name": F.col("reference_proprietary_name"),
    })
    linked = resolve_reference(roles, listed, [order], listed=listed_order).withColumnRenamed("resolved_reference_number", "resolved_reference_bla")
    linked = linked.withColumns({
        "proprietary_name": F.coalesce(F.nullif("proprietary_name", F.lit("")), F.lit("N/A")),
        "product_label_url": F.concat(F.lit(LABEL_URL), "bla_number"),
    })
    return linked.drop("number", "name", "licence", "reference_name", order)
