"""Drug applications: one flat row per product."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from refloom.functions.arrays import text_list
from refloom.functions.codes import iso_date
from refloom.functions.text import fill, safe_text, with_detail
from refloom.operators.select import search_nested
from refloom.schemas import APPLICATION_LISTS, APPLICATION_PRODUCT


def flatten(raw: DataFrame) -> DataFrame:
    """Product rows with packed submissions, documents, ingredients and 13 identifier lists.

    An application without products keeps one row with empty product columns.
    """
    def submission(s):
        return fill(
            "%s(%s) - %s (%s)", safe_text(s["submission_type"]), safe_text(s["submission_number"]),
            safe_text(s["submission_status"]), iso_date(safe_text(s["submission_status_date"])),
        )

    def document(d):
        return fill("%s (%s): %s", safe_text(d["type"]), iso_date(safe_text(d["date"])), safe_text(d["url"]))

    documents = F.flatten(F.transform("submissions", lambda s: F.coalesce(
        F.transform(F.filter(s["application_docs"], lambda d: safe_text(d["url"]) != ""), document),
        F.array().cast("array<string>"),
    )))
    shared = raw.select(
        safe_text("application_number").alias("application_number"),
        safe_text("sponsor_name").alias("sponsor_name"),
        *[F.coalesce(F.array_join(text_list(f"openfda.{src}"), " | "), F.lit("")).alias(out) for out, src in APPLICATION_LISTS.items()],
        F.coalesce(F.array_join(F.transform("submissions", submission), " | "), F.lit("")).alias("submissions"),
        F.coalesce(F.array_join(documents, " | "), F.lit("")).alias("application_docs"),
        "products",
    )
    # Packed once per application, before the rows multiply.
    shared = shared.select("*", F.explode_outer("products").alias("_p")).drop("products")
    ingredients = F.transform(
        "_p.active_ingredients", lambda i: with_detail(safe_text(i["name"]), safe_text(i["strength"]))
    )
    return shared.select(
        "application_number", "sponsor_name",
        *[safe_text(f"_p.{c}").alias(c) for c in APPLICATION_PRODUCT],
        F.coalesce(F.array_join(ingredients, " | "), F.lit("")).alias("active_ingredients"),
        *APPLICATION_LISTS, "submissions", "application_docs",
    )


def search(raw: DataFrame, term: str, k: int = 5) -> DataFrame:
    """The first ``k`` applications with the term in number, sponsor, a brand or an ingredient."""
    found = search_nested(
        raw, term, ["application_number", "sponsor_name"], {"products": ["brand_name", "active_ingredients.name"]}
    )
    return found.orderBy("application_number").limit(k)
