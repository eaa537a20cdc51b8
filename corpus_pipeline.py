"""A training corpus from raw documents: five stages, each written before the next one reads it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pitchlake.llm import decontaminate, mixing, neardup, secrets, toxicity
from pitchlake.llm.common import crc_mod, materialise, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model scores below 1/2; it learns as op3 does.

    NULL, empty and wordless texts are scored like any other; repeated rows stay or go together.
    Without any label all scores are 1/4, and all documents stay.
    """
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"), crc_mod(F.col("doc_id"), 5) != 0)
    return toxicity.score(docs, model).where("__toxicity < 0.5").select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, the one with the smallest id.

    Near duplicates are those of op2's contract, which binds this stage too: two-word shingles.
    Documents without words have none; of rows with equal id and text one stays. A group without
    any id keeps one of its rows.
    """
    return neardup.deduplicate(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with less than a twentieth of their words in windows of benchmark items.

    Documents without words and NULL texts stay, and all stay if there are no items. Each row is
    judged by itself, so repeated rows stay or go together.
    """
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets in their texts replaced by a mark; ``n_chars`` follows the text.

    NULL and empty texts, and texts without secrets, stay as they are with their ``n_chars``.
    """
    out = secrets.redact(docs)
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        out = out.withColumn("n_chars", F.when(
            F.col("text").contains(secrets.MARK), F.length("text").cast(kind)
        ).otherwise(F.col("n_chars")))
    return out


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents with their place in a mix of the sources by the square root of their sizes.

    Every row gets a place, repeated rows one each; a NULL source is a source. No rows give no rows.
    """
    return mixing.mix(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_dedup", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("secrets", redact_secrets),
    ("mixing", mix_sources),
]

#: The toxicity stage learns a model, which SQL can't express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
