"""How far sources of one language are apart in their use of words, by a three-dimensional cube.

Term counts of (language, source) groups are cut along two axes, groups into blocks and terms into
blocks. A task owns one cell (group block, group block, term block): it gets the two slices of
counts that meet there, each slice repeated for the cells of the other axis, and computes the
part of every pair's divergence that its terms add. Parts are summed along the term axis.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pitchlake.llm import tokens
from pitchlake.llm.common import materialise

LEAST_DOCUMENTS = 30
TERM_RANKS = 50
#: Groups and terms of a cell's slice, on average; a cell's matrices hold 2 x 16 x 2048 longs.
GROUP_BLOCK, TERM_BLOCK = 16, 2048
SCALE, PRIOR = 1_000_000_000, 5

#: Separators of ``[^\x00-\x40\x5B-\x60\x7B-\x7F]+`` once A-Z are lower-cased.
NOT_LETTER = np.zeros(256, bool)
NOT_LETTER[:128] = True
NOT_LETTER[97:123] = False


def term_strings(words: tokens.Words) -> pa.Array:
    """The words as one Arrow array of binary values, without a Python object for each."""
    lengths = words.end - words.start
    offsets = np.zeros(len(lengths) + 1, np.int64)
    np.cumsum(lengths, out=offsets[1:])
    at = np.repeat(words.start - offsets[:-1], lengths) + np.arange(offsets[-1])
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(lengths), [
        None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(words.bytes[at].tobytes())])


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, source, term, n, docs) of each piece of the text; term '' names the group itself."""
    for batch in tokens.pieces(batches, 8_000_000):
        lang, source = (batch.column(i).dictionary_encode() for i in (0, 1))
        groups = (
            lang.indices.to_numpy().astype(np.int64) * len(source.dictionary)
            + source.indices.to_numpy())
        words = tokens.split(batch.column(2), NOT_LETTER, tokens.LOWER)
        terms = term_strings(words).dictionary_encode()
        width = len(terms.dictionary) + 1  # the last is the group's own row
        rows = words.rows()
        codes = terms.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        once, times = np.unique(rows * width + codes, return_counts=True)  # a row and its term
        keys, where = np.unique(groups[once // width] * width + once % width, return_inverse=True)
        own = np.unique(groups) * width + width - 1
        n = np.bincount(where, weights=times, minlength=len(keys)).astype(np.int64)
        docs = np.bincount(where, minlength=len(keys)).astype(np.int64)
        keys = np.concatenate((keys, own))
        names = pa.concat_arrays([
            terms.dictionary.cast(pa.binary()), pa.array([b""], pa.binary())]).cast(pa.string())
        group = keys // width
        zeros = np.zeros(len(own), np.int64)
        yield pa.RecordBatch.from_arrays([
            lang.dictionary.take(pa.array(group // len(source.dictionary))),
            source.dictionary.take(pa.array(group % len(source.dictionary))),
            names.take(pa.array(keys % width)), pa.array(np.concatenate((n, zeros))),
            pa.array(np.concatenate((docs, zeros)))], ["lang", "source", "term", "n", "docs"])


def share(n: Column, total: Column, terms: Column) -> Column:
    """1 + floor(SCALE * (n + PRIOR) / (total + PRIOR * terms)), exact for any long counts."""
    return F.when(terms > 0, F.lit(1) + F.call_function(
        "div",
        (n + PRIOR).cast("decimal(20,0)") * F.lit(SCALE).cast("decimal(10,0)"),
        (total + PRIOR * terms).cast("decimal(20,0)"))).otherwise(0).cast("long")


def term_table(docs: DataFrame, least_documents: int) -> tuple[DataFrame, DataFrame]:
    """(terms, groups): the kept terms with their counts, and every group with its totals.

    ``terms`` holds (lang, source, term, n, lang_n) for counts above zero, ``groups`` (lang,
    source, v, total, lang_total, n_groups): kept terms of the language, occurrences of them in the
    group and in the language, groups of the language.
    """
    text = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c)
            for c in ("lang", "source", "text")]
    # Words of a piece are counted before they leave a task, and a task's counts are added up
    # before the shuffle.
    counts = materialise(
        docs.select(*text)
        .mapInArrow(_count, "lang string, source string, term string, n long, docs long")
        .groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs")),
        "term-counts")
    kept = (
        counts.where("term <> ''").groupBy("lang", "term")
        .agg(F.sum("n").alias("lang_n"), F.sum("docs").alias("docs"))
        .where(F.col("docs") >= least_documents).select("lang", "term", "lang_n"))
    terms = materialise(
        counts.where("term <> ''").join(kept, ["lang", "term"])
        .select("lang", "source", "term", "n", "lang_n"), "terms")
    totals = terms.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    langs = terms.groupBy("lang", "term").agg(F.first("lang_n").alias("n")).groupBy("lang").agg(
        F.count("*").alias("v"), F.sum("n").alias("lang_total"))
    known = counts.where("term = ''").select("lang", "source")
    sizes = known.groupBy("lang").agg(F.count("*").alias("n_groups"))
    groups = (
        known.join(totals, ["lang", "source"], "left").join(sizes, "lang")
        .join(langs, "lang", "left").select(
            "lang", "source", F.coalesce("v", F.lit(0)).alias("v"),
            F.coalesce("total", F.lit(0)).alias("total"),
            F.coalesce("lang_total", F.lit(0)).alias("lang_total"), "n_groups"))
    return terms, materialise(groups, "groups")


def _block(name: str, blocks: Column) -> Column:
    return F.pmod(F.xxhash64(name), blocks).cast("int")


def _cell(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
    """The part of each pair's divergence from one cell's terms.

    A row without a term is a group with its share of an absent term. A pair's sum starts from
    all terms being absent, which the cells of term block 0 add, and each cell corrects it for the
    terms that occur in it.
    """
    p, q, k = (x.as_py() for x in key[1:])
    source = table.column("source").combine_chunks().dictionary_encode()
    term = table.column("term").combine_chunks().dictionary_encode()
    group = source.indices.to_numpy()
    at = term.indices.fill_null(-1).to_numpy()
    own, value, v = (table.column(c).to_numpy() for c in ("own", "p", "v"))
    names, width = source.dictionary, len(term.dictionary)
    absent, block = np.zeros(len(names), np.int64), np.zeros(len(names), np.int64)
    meta = at < 0
    absent[group[meta]], block[group[meta]] = value[meta], own[meta]
    shares = np.repeat(absent[:, None], width, axis=1)
    shares[group[~meta], at[~meta]] = value[~meta]
    left, right = np.flatnonzero(block == p), np.flatnonzero(block == q)
    all_terms = int(v[0]) if k == 0 else 0
    a, b, part = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for n, i in enumerate(left):
        js = right[n + 1 :] if p == q else right
        a.append(np.full(len(js), i))
        b.append(js)
        part.append(np.abs(shares[js] - shares[i]).sum(axis=1)
                    + (all_terms - width) * np.abs(absent[js] - absent[i]))
    a, b = np.concatenate(a), np.concatenate(b)
    return pa.table({
        "lang": pa.array([key[0].as_py()] * len(a), pa.string()), "a": names.take(pa.array(a)),
        "b": names.take(pa.array(b)), "part": np.concatenate(part)})


def pair_divergences(
    terms: DataFrame, groups: DataFrame, group_block: int = GROUP_BLOCK,
    term_block: int = TERM_BLOCK,
) -> DataFrame:
    """(lang, a, b, value) for each two sources of a language, in one order only."""
    blocks = F.ceil(F.col("n_groups") / group_block).cast("int")
    slices = F.greatest(F.ceil(F.col("v") / term_block), F.lit(1)).cast("int")
    cut = groups.select(
        "lang", "source", "v", "total", blocks.alias("blocks"), slices.alias("slices"),
        _block("source", blocks).alias("own"))
    present = (
        terms.select("lang", "source", "term", "n").join(cut, ["lang", "source"])
        .withColumn("k", _block("term", F.col("slices"))))
    absent = cut.select(
        "*", F.lit(None).cast("string").alias("term"), F.lit(0).cast("long").alias("n"),
        F.explode(F.sequence(F.lit(0), F.col("slices") - 1)).alias("k"))
    rows = present.unionByName(absent).select(
        "lang", "source", "term", share(F.col("n"), F.col("total"), F.col("v")).alias("p"), "v",
        "own", "k", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    parts = rows.select(
        "lang", F.least("own", "other").alias("x"), F.greatest("own", "other").alias("y"), "k",
        "source", "term", "p", "v", "own",
    ).groupBy("lang", "x", "y", "k").applyInArrow(
        _cell, "lang string, a string, b string, part long")
    # Within a block, which of two groups comes first depends on the cell.
    return parts.groupBy("lang", F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).agg(
        F.sum("part").alias("value"))


def audit(
    docs: DataFrame, least_documents: int = LEAST_DOCUMENTS, term_ranks: int = TERM_RANKS,
    group_block: int = GROUP_BLOCK, term_block: int = TERM_BLOCK,
) -> DataFrame:
    """(lang, source, part, item, value, rank) for the groups (lang, source) of ``docs``.

    Terms are runs of letters, A-Z in lower case and all beyond ASCII as they are. A language keeps
    the terms of at least ``least_documents`` of its rows. A group's or a language's share of a kept
    term is 1 + floor(10^9 (count + 5) / (N + 5 V)), N being its occurrences of all V kept terms.
    Part ``pair`` ranks the other sources of the language by the sum of absolute differences of
    shares; part ``term`` ranks up to ``term_ranks`` terms of the group by how far its share lies
    above the language's. Ties go to the item that is smaller in UTF-8.

    NULL lang, source and text count as ''; a group without text or terms is in part ``pair`` all
    the same, with value 0 if its language keeps no terms. Repeated rows are documents of their own.
    No rows give no rows. Other columns are not read.
    """
    terms, groups = term_table(docs, least_documents)
    one_way = pair_divergences(terms, groups, group_block, term_block)
    both = F.explode(F.array(
        F.struct(F.col("a").alias("source"), F.col("b").alias("item")),
        F.struct(F.col("b").alias("source"), F.col("a").alias("item"))))
    pairs = one_way.select("lang", both.alias("x"), "value").select(
        "lang", "x.source", F.lit("pair").alias("part"), "x.item", "value")
    own = share(F.col("n"), F.col("total"), F.col("v"))
    of_lang = share(F.col("lang_n"), F.col("lang_total"), F.col("v"))
    over = (
        terms.join(groups, ["lang", "source"])
        .select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"),
                (own - of_lang).alias("value"))
        .where("value > 0"))
    best = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    ranked = F.row_number().over(best).alias("rank")
    return pairs.select("*", ranked).union(
        over.select("*", ranked).where(F.col("rank") <= term_ranks))
