"""Token counts from an exact length histogram.

Documents are counted by encoded length; running sums from the long end of the
histogram then answer, for any context limit, how many documents exceed it, how
many tokens there are and how many remain after truncation, and which length a
quantile has. The texts are read once; everything after is as small as the set
of distinct lengths, and its running sums are taken in blocks of lengths (in
parallel) plus block totals, never in one pass over all lengths.

Cases: null or empty text has length 0; repeated rows count each; texts are
encoded whole; an empty table gives an empty histogram; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.tables import saved
from strata.llm.tokens import RANKS, encoded, sliced

BLOCK = 1024  # lengths whose running sums one task takes


def _lengths(ranks: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, texts in sliced(batch.column(0)):
                counts = np.bincount(np.fromiter((len(x) for x in encoded(texts, ranks)), dtype=np.int64, count=len(texts)))
                used = np.flatnonzero(counts)
                yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(counts[used])], names=["length", "n_docs"])

    return run


def length_histogram(docs: DataFrame, text_col: str = "text", ranks: str = RANKS) -> DataFrame:
    """(length, n_docs): documents by encoded length, counted before the shuffle."""
    rows = docs.select(F.col(f"`{text_col}`").cast("string").alias("text"))
    counts = rows.mapInArrow(_lengths(ranks), "length long, n_docs long")
    return counts.groupBy("length").agg(F.sum("n_docs").alias("n_docs"))


def with_sums(histogram: DataFrame) -> DataFrame:
    """The histogram with sums over it, taking each length as the context limit:

    docs_longer, tokens_longer: documents and tokens above the limit;
    truncated_tokens: tokens left when every document is cut at the limit;
    docs_total, tokens_total: of the whole corpus;
    quantile: part of the documents that are no longer than the limit.
    """
    hist = saved(histogram.withColumn("block", F.floor(F.col("length") / BLOCK)), "lengths")
    tokens = F.col("length") * F.col("n_docs")
    blocks = hist.groupBy("block").agg(F.sum("n_docs").alias("docs"), F.sum(tokens).alias("tokens"))
    after = Window.orderBy(F.desc("block")).rowsBetween(Window.unboundedPreceding, -1)  # one row a block
    zero = F.lit(0).cast("long")
    blocks = blocks.select(
        "block",
        F.coalesce(F.sum("docs").over(after), zero).alias("docs_after"),
        F.coalesce(F.sum("tokens").over(after), zero).alias("tokens_after"),
        F.sum("docs").over(Window.partitionBy()).alias("docs_total"),
        F.sum("tokens").over(Window.partitionBy()).alias("tokens_total"),
    )
    own = Window.partitionBy("block").orderBy(F.desc("length")).rowsBetween(Window.unboundedPreceding, -1)
    return (
        hist.join(blocks, "block")
        .withColumn("docs_longer", F.col("docs_after") + F.coalesce(F.sum("n_docs").over(own), zero))
        .withColumn("tokens_longer", F.col("tokens_after") + F.coalesce(F.sum(tokens).over(own), zero))
        .select(
            "length", "n_docs", "docs_longer", "tokens_longer",
            (F.col("tokens_total") - F.col("tokens_longer") + F.col("length") * F.col("docs_longer")).alias("truncated_tokens"),
            "docs_total", "tokens_total",
            ((F.col("docs_total") - F.col("docs_longer")) / F.col("docs_total")).alias("quantile"),
        )
    )


def at_limits(sums: DataFrame, limits: list[int]) -> DataFrame:
    """(context_limit, docs_longer, truncated_tokens) for any limits: each is
    answered by the longest length that does not exceed it, plus what longer
    documents hold between the two."""
    below = lambda c: F.max(F.when(F.col("length") <= c, F.struct("length", "docs_longer", "truncated_tokens")))
    found = sums.agg(F.max("docs_total").alias("docs"), *[below(c).alias(f"at{i}") for i, c in enumerate(limits)])
    zero = F.lit(0).cast("long")
    rows = []
    for i, c in enumerate(limits):
        longer = F.coalesce(F.col(f"at{i}.docs_longer"), "docs", zero)
        beyond = longer * (F.lit(c).cast("long") - F.coalesce(F.col(f"at{i}.length"), zero))
        rows.append(
            F.struct(
                F.lit(c).cast("long").alias("context_limit"),
                longer.alias("docs_longer"),
                (F.coalesce(F.col(f"at{i}.truncated_tokens"), zero) + beyond).alias("truncated_tokens"),
            )
        )
    return found.select(F.inline(F.array(*rows)))


def length_at(sums: DataFrame, quantile: float) -> int | None:
    """Smallest length that covers the given part of all documents."""
    return sums.where(F.col("quantile") >= quantile).agg(F.min("length")).first()[0]
