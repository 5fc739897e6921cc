"""Scholarly works: flat rows and the relational tables around them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from refloom.functions.arrays import distinct_ordered, first_of_first, heading_terms, names, pack, rebuild_text
from refloom.operators.nested import dimension


def _text(path: str) -> Column:
    return F.coalesce(F.col(path), F.lit(""))


def _institutions() -> Column:
    return F.flatten(F.transform("authorships", lambda a: F.coalesce(a["institutions"], F.array())))


def _issn() -> Column:
    return F.coalesce(F.get("primary_location.source.issn", F.lit(0)), F.col("primary_location.source.issn_l"), F.lit(""))


def flat(works: DataFrame) -> DataFrame:
    """One row per work with packed authors, institutions, countries, headings, funders and the abstract."""
    return works.select(
        _text("id").alias("work_id"), _text("doi").alias("doi"), _text("title").alias("title"), "publication_year",
        _text("publication_date").alias("publication_date"), _text("type").alias("type"), _text("language").alias("language"),
        _text("primary_location.source.display_name").alias("journal_name"),
        _text("primary_location.source.host_organization_name").alias("publisher"),
        _issn().alias("issn"),
        F.coalesce("open_access.is_oa", F.lit(False)).alias("is_oa"),
        _text("open_access.oa_status").alias("oa_status"), _text("open_access.oa_url").alias("oa_url"),
        pack(names(F.transform("authorships", lambda a: a["author"])), "; ").alias("authors"),
        first_of_first("authorships").alias("first_author_institution"),
        pack(distinct_ordered(names(_institutions())), "; ").alias("institutions"),
        pack(distinct_ordered(names(_institutions(), "country_code")), "; ").alias("countries"),
        F.coalesce("cited_by_count", F.lit(0)).alias("cited_by_count"),
        _text("primary_topic.display_name").alias("primary_topic"),
        _text("primary_topic.field.display_name").alias("primary_topic_field"),
        _text("primary_topic.domain.display_name").alias("primary_topic_domain"),
        pack(heading_terms("mesh"), "; ").alias("mesh_terms"),
        pack(heading_terms("mesh", major_only=True), "; ").alias("major_mesh_terms"),
        pack(distinct_ordered(names("funders")), "; ").alias("funders"),
        rebuild_text("abstract_inverted_index").alias("abstract"),
        _text("updated_date").alias("updated_date"),
    )


def relations(works: DataFrame) -> dict[str, DataFrame]:
    """Authors, institutions, sources and affiliations, each id once (first seen by work id and place)."""
    rows = works.select(F.col("id").alias("work_id"), F.posexplode("authorships").alias("author_at", "a"))
    people = rows.select(
        "work_id", "author_at", F.col("a.author.id").alias("author_id"), _text("a.author.display_name").alias("display_name"),
        _text("a.author.orcid").alias("orcid"),
    )
    places = rows.select(
        "work_id", "author_at", F.col("a.author.id").alias("author_id"), _text("a.author_position").alias("author_position"),
        F.posexplode("a.institutions").alias("place_at", "i"),
    )
    places = places.select(
        "work_id", "author_at", "place_at", "author_id", "author_position", F.col("i.id").alias("institution_id"),
        _text("i.display_name").alias("display_name"), _text("i.ror").alias("ror"),
        _text("i.country_code").alias("country_code"), _text("i.type").alias("type"),
    )
    sources = works.select(
        F.col("id").alias("work_id"), F.col("primary_location.source.id").alias("source_id"),
        _text("primary_location.source.display_name").alias("display_name"),
        _text("primary_location.source.host_organization_name").alias("publisher"), _issn().alias("issn"),
    )
    return {
        "authors": dimension(people, ["author_id"], ["display_name", "orcid"], ["work_id", "author_at"]),
        "institutions": dimension(
            places, ["institution_id"], ["display_name", "ror", "country_code", "type"], ["work_id", "author_at", "place_at"]
        ),
        "sources": dimension(sources, ["source_id"], ["display_name", "publisher", "issn"], ["work_id"]),
        "affiliations": dimension(
            places, ["work_id", "author_id", "institution_id"], ["author_position"], ["author_at", "place_at"]
        ),
    }
