"""Literature articles: metadata rows and the queue for text extraction."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from refloom.functions.arrays import names, pack
from refloom.functions.text import fill, grant_detail, safe_text
from refloom.operators.select import eligible


def _text(path: str) -> Column:
    return F.coalesce(F.col(path), F.lit(""))


def _publication_types(raw: Column) -> Column:
    """Types as one text, a list of texts, or a list of objects."""
    plain = F.from_json(raw, "array<string>")
    items = F.transform(plain, lambda x: F.when(x.startswith("{"), F.get_json_object(x, "$.pubType")).otherwise(x))
    return F.when(raw.startswith("["), pack(items, "; ")).otherwise(F.coalesce(raw, F.lit("")))


def metadata(articles: DataFrame, extended: bool = False) -> DataFrame:
    """One row per article. ``extended`` adds headings, chemicals and grants."""
    people = F.coalesce(F.col("authorList.author"), F.array())
    listed = F.size(people) > 0
    full = pack(F.transform(people, lambda a: F.coalesce(a["fullName"], a["lastName"])), "; ")
    orcids = pack(F.transform(F.filter(people, lambda a: a["authorId"]["type"] == "ORCID"), lambda a: a["authorId"]["value"]), "; ")
    homes = F.flatten(F.transform(
        people, lambda a: F.coalesce(names(a["authorAffiliationDetailsList"]["authorAffiliation"], "affiliation"), F.array().cast("array<string>"))
    ))
    links = F.transform(
        F.filter("fullTextUrlList.fullTextUrl", lambda u: safe_text(u["url"]) != ""),
        lambda u: fill("[%s %s] %s", F.coalesce(u["site"], F.lit("External")), F.coalesce(u["documentStyle"], F.lit("link")), u["url"]),
    )
    headings = F.col("meshHeadingList.meshHeading")
    chemicals = F.filter("chemicalList.chemical", lambda c: F.coalesce(c["registryNumber"], F.lit("0")).isin("", "0") == F.lit(False))
    numbered = F.transform(chemicals, lambda c: fill("%s (%s)", F.coalesce(c["name"], F.lit("None")), c["registryNumber"]))
    grants = F.transform("grantsList.grant", lambda g: grant_detail(g["agency"], g["grantId"], g["acronym"]))
    more = [
        pack(names(headings, "descriptorName"), "; ").alias("mesh_descriptors"),
        pack(names(F.filter(headings, lambda m: m["majorTopic_YN"] == "Y"), "descriptorName"), "; ").alias("mesh_major_topics"),
        pack(names("chemicalList.chemical", "name"), "; ").alias("chemicals"),
        pack(numbered, "; ").alias("chemical_registry_numbers"),
        pack(grants, "; ").alias("grants"),
    ]
    return articles.filter(safe_text("id") != "").select(
        "id", _text("source").alias("source"), _text("pmid").alias("pmid"), _text("pmcid").alias("pmcid"),
        _text("doi").alias("doi"), _text("title").alias("title"), _text("abstractText").alias("abstract"),
        F.when(listed, full).otherwise(_text("authorString")).alias("authors"),
        pack(F.array_sort(F.array_distinct(homes)), "; ").alias("author_affiliations"),
        orcids.alias("author_orcids"),
        F.coalesce("journalInfo.journal.title", "journalTitle", F.lit("")).alias("journal_title"),
        _text("journalInfo.journal.issn").alias("journal_issn"), _text("journalInfo.volume").alias("journal_volume"),
        _text("journalInfo.issue").alias("journal_issue"), _text("pubYear").alias("pub_year"),
        _publication_types(F.col("pubTypeList.pubType")).alias("pub_type"),
        _text("isOpenAccess").alias("is_open_access"), _text("hasPDF").alias("has_pdf"),
        F.coalesce("citedByCount", F.lit(0)).alias("cited_by_count"), _text("dateOfCreation").alias("date_of_creation"),
        _text("firstPublicationDate").alias("first_publication_date"), pack(links, "; ").alias("full_text_urls"),
        *(more if extended else []),
    )


def extraction_queue(articles: DataFrame, done: DataFrame) -> DataFrame:
    """Ids of articles whose full text may be read and that are not done yet."""
    open_flags = [F.col(c) == "Y" for c in ("isOpenAccess", "inEPMC", "inPMC")]
    return articles.filter(eligible("pmcid", open_flags)).select("id").distinct().join(done.select("id"), "id", "left_anti")
