"""From documents to packed sequences: language, near-duplicates, contamination, packing.

Each stage takes (spark, docs, sf_dir) and works on all that the one before has kept; all but the last return the
columns of ``documents``. ``run`` writes each stage's rows to the shared folder and reads them again for the next.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tilelake.llm import ctw, decontaminate, langid, packing, simhash
from tilelake.llm.common import stored, table

#: A document goes if it has no letters, or if its language is no likelier than so far from chance to certainty.
LEAST_LANGUAGE = 0.1


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the documents whose language the field recognises; it learns from rows of crc32(doc_id) mod 3 other than 1."""
    return langid.accepted(docs, langid.fit(docs, ~ctw.held_out("doc_id", 3, 1)), least=LEAST_LANGUAGE)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document of least id of each group of near copies: SimHash of five-word shingles, and what its index
    cannot reach of a similarity of 0.8 or more."""
    return simhash.deduplicated(docs)


def contamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the documents in which no benchmark window occurs."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs all documents that are left; one row per piece."""
    return packing.packed(docs)


STAGES = [("language", language), ("near_duplicates", near_duplicates), ("contamination", contamination), ("packing", pack)]

#: SQL can express neither the field, nor fingerprints, nor the tokeniser; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = stored(docs, name)
    return docs
