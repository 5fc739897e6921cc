"""The corpus pipeline: toxic documents go, one of each group of near copies stays, benchmark items and secrets go, the rest is packed.

Every stage but the last gives back the columns it was given, extra ones and whatever their names included. NULL and empty texts, and NULLs in any other column, go through all
of them: such a text is not toxic, no copy of anything, matches no benchmark item and holds no secret; it is packed as one end token. Repeated rows are
copies of one another: one of them stays, unless they have no words. Of copies, the one with the least id stays (a NULL id last); ids that tie are told apart by the hash of
their text. An empty table gives an empty table at every stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from refloom.llm import decontaminate, neardup, packing, secrets, toxicity
from refloom.llm.queries import VOCABULARY
from refloom.session import Tables, materialize, ship_package


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the network, trained on the labelled ones, does not hold for toxic. Without labels of both kinds none is; repeated rows share their fate."""
    ship_package(spark)
    return toxicity.clean(docs, Tables(spark, sf_dir).labels)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by a similarity of 0.8 or more on five-word shingles, the one with the least id; texts without words all stay."""
    ship_package(spark)
    return neardup.deduplicated(docs, words=5, percent=80)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark; NULL, empty and wordless texts have none."""
    ship_package(spark)
    return decontaminate.clean(docs, Tables(spark, sf_dir).benchmark)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, credentials masked in their texts; ``n_chars`` follows a text that changes, and NULL texts stay NULL."""
    ship_package(spark)
    return secrets.redacted(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row per piece of the documents, with its sequence and place; NULL and empty texts are a piece of one token, repeated rows are packed each."""
    ship_package(spark)
    return packing.pack(docs, VOCABULARY)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_dedup", drop_copies),
    ("decontamination", drop_leaks),
    ("secrets", mask_secrets),
    ("packing", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each one's result is a table that the next one reads."""
    docs = Tables(spark, sf_dir).documents
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return docs


#: A trained network and tokenizers are no matter for SQL.
ORACLE_SQL = None
QUERIES = {"pipeline": run}
ORACLE: dict[str, str] = {}
