"""Reading, materialising and dealing out documents for the operators of this package."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pitchlake.llm import tokens
from pitchlake.session import work_path

#: Characters of text that one chunk holds on average; a chunk is what one task keeps in memory.
CHUNK_CHARS = 12_000_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` below the cluster's shared folder and read it back; its lineage ends there."""
    path = work_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def crc_mod(doc_id: Column, n: int) -> Column:
    """crc32 of the id as text, modulo ``n``; NULL for a NULL id."""
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(n))


def chunk_count(docs: DataFrame, text: str = "text", chars: int = CHUNK_CHARS) -> int:
    """Chunks for the text of ``docs``: in proportion to its total length, at least one."""
    total = docs.agg(F.sum(F.length(text))).first()[0] or 0
    return int(total // chars) + 1


def in_chunks(docs: DataFrame, n: int) -> DataFrame:
    """(chunk, doc_id, text): every row in one of ``n`` chunks, dealt by a hash of id and text."""
    return docs.select(
        F.pmod(F.xxhash64("doc_id", "text"), F.lit(n)).cast("int").alias("chunk"),
        F.col("doc_id").cast("long").alias("doc_id"), "text",
    )


def sampled_labels(
    docs: DataFrame, labels: DataFrame, label: str, allowed: Column, bound: int
) -> DataFrame:
    """(doc_id, text, label): at most ``bound`` labelled rows, those with the least md5 of the id.

    Ids and labels that are NULL take no part; of several labels of an id the largest counts.
    """
    picked = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).alias("label"))
        .where("doc_id is not null and label is not null").where(allowed)
        .groupBy("doc_id").agg(F.max("label").alias("label"))
        .orderBy(F.md5(F.col("doc_id").cast("string").cast("binary")), "doc_id").limit(bound)
    )
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")
    ).join(F.broadcast(picked), "doc_id")  # ``bound`` rows of two numbers


#: Pieces in which a task hands over its table, so that no reducer adds up a whole one.
SLICES = 16


def added_tables(
    texts: DataFrame, cells: int, count: Callable[..., np.ndarray], piece: int = 8_000_000
) -> np.ndarray:
    """The sum over all rows of tables of ``cells`` integers; ``count(*columns)`` gives a piece's.

    ``cells`` must not depend on the data: the driver receives one table.
    """
    edges = np.linspace(0, cells, SLICES + 1).astype(np.int64)

    def table(batches):
        total = np.zeros(cells, np.int64)
        for batch in tokens.pieces(batches, piece):
            total += count(*batch.columns).astype(np.int64)
        yield pa.RecordBatch.from_arrays([
            pa.array(range(SLICES), pa.int32()),
            pa.array([total[a:b].tobytes() for a, b in zip(edges, edges[1:], strict=False)],
                     pa.binary()),
        ], ["slice", "data"])

    def add(
        key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]
    ) -> Iterator[pa.RecordBatch]:
        total = 0
        for batch in batches:  # a batch at a time, however many tasks there were
            for x in batch.column(1):
                total = total + np.frombuffer(x.as_buffer(), np.int64)
        yield pa.RecordBatch.from_arrays(
            [pa.array([key[0].as_py()], pa.int32()), pa.array([total.tobytes()], pa.binary())],
            ["slice", "data"])

    rows = (
        texts.mapInArrow(table, "slice int, data binary")
        .groupBy("slice").applyInArrow(add, "slice int, data binary").collect()
    )
    out = np.zeros(cells, np.int64)
    for i, data in rows:
        out[edges[i] : edges[i + 1]] = np.frombuffer(data, np.int64)
    return out
