"""Drug product extract: master table, nested documents and search."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from refloom.operators.aggregate import Child, nested_master, ordered_text, text_master
from refloom.operators.joins import search_joined
from refloom.operators.skew import join_keys
from refloom.schemas import DRUG_PRODUCT_FILES
from refloom.sources.delimited import read_positional

KEY = "drug_code"


def load(spark: SparkSession, folders: dict[str, str], encoding: str = "UTF-8") -> dict[str, DataFrame]:
    """All tables of the extract; every one carries the status of its folder."""
    return {
        key: read_positional(spark, folders, key, DRUG_PRODUCT_FILES, "status_category", encoding)
        for key in DRUG_PRODUCT_FILES
    }


def _ingredient():
    return F.concat(F.col("ingredient_name"), F.lit(" ("), F.col("strength"), F.lit(" "), F.col("strength_unit"), F.lit(")"))


def master(tables: dict[str, DataFrame], by_status: bool = False) -> DataFrame:
    """One row per product with packed child texts. ``by_status`` joins children of the same status only."""
    keys = [KEY, "status_category"] if by_status else [KEY]
    company = F.concat(F.col("company_name"), F.lit(" ("), F.col("company_type"), F.lit(")"))
    children = [
        Child("active_ingredients", tables["ingred"], _ingredient()),
        Child("companies", tables["comp"], company),
        Child("routes", tables["route"], F.col("route_of_administration_en")),
        Child("forms", tables["form"], F.col("pharmaceutical_form_en")),
        Child("schedules", tables["schedule"], F.col("schedule_en")),
        Child("veterinary_species", tables["vet"], F.col("veterinary_species_en")),
        Child("pharmaceutical_standards", tables["pharm"], F.col("pharmaceutical_std")),
    ]
    products = tables["drug"].select(
        KEY, F.col("drug_identification_number").alias("din"), "brand_name", "product_categorization", "status_category"
    )
    return text_master(products, keys, children)


def documents(tables: dict[str, DataFrame]) -> DataFrame:
    """One nested record per product; child lists are empty where there are no rows."""
    def rows(key, names):
        table = tables[key].select(KEY, *[F.col(src).alias(out) for out, src in names.items()])
        return table, F.struct(*names), list(names)

    layout = {
        "active_ingredients": ("ingred", {
            "ingredient_name_en": "ingredient_name", "ingredient_name_fr": "ingredient_name_fr",
            "ingredient_flag": "ingredient_flag", "strength": "strength", "strength_unit_en": "strength_unit",
            "strength_unit_fr": "strength_unit_fr", "dosage_value": "dosage_value",
            "dosage_unit_en": "dosage_unit", "dosage_unit_fr": "dosage_unit_fr"}),
        "companies": ("comp", {
            "company_name": "company_name", "company_type": "company_type", "city": "city_name",
            "province": "province_name", "country": "country_name", "postal_code": "postal_code"}),
        "routes": ("route", {"route_en": "route_of_administration_en", "route_fr": "route_of_administration_fr"}),
        "forms": ("form", {"form_en": "pharmaceutical_form_en", "form_fr": "pharmaceutical_form_fr"}),
        "packaging": ("package", {
            "upc": "upc", "package_size": "package_size", "package_size_unit_en": "package_size_unit_en",
            "package_size_unit_fr": "package_size_unit_fr", "product_information_en": "product_information_en",
            "product_information_fr": "product_information_fr"}),
    }
    children = []
    for name, (key, names) in layout.items():
        table, value, order = rows(key, names)
        children.append(Child(name, table, value, order))
    products = tables["drug"].select(
        KEY, F.col("drug_identification_number").alias("din"), "brand_name",
        F.col("product_categorization").alias("product_categorization_en"), "product_categorization_fr",
        "status_category", "last_update_date",
    )
    return nested_master(products, [KEY], children)


def search(tables: dict[str, DataFrame], term: str, k: int = 20) -> DataFrame:
    """The first ``k`` products with the term in brand, number or an ingredient."""
    hits = search_joined(
        tables["drug"], tables["ingred"], KEY, term, ["brand_name", "drug_identification_number"], ["ingredient_name"]
    )
    top = hits.select(
        KEY, F.col("drug_identification_number").alias("din"), "brand_name", "product_categorization", "status_category"
    ).distinct().orderBy(KEY, "status_category").limit(k)
    lines = tables["ingred"].join(top.select(KEY).distinct(), KEY, "left_semi")
    return join_keys(top, ordered_text(lines, [KEY], _ingredient(), out="active_ingredients"), [KEY], "left")
