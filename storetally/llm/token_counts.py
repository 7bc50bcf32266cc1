"""Token counts of a corpus by an exact length histogram.

Texts are encoded once; all that is kept of them is how many have each encoded
length. Running sums over the histogram answer every context limit: how many
texts fit, how many tokens there are in all, how many stay if each text is cut at
the limit, and which limit a given share of texts or tokens needs.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from storetally.llm.texts import shared_checkpoint, table

RANKS = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# The pattern that belongs to the vocabulary. Fixed value.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
# Lengths that share one bucket of the two-level running sums.
BUCKET = 256

_ENCODINGS: dict[int, tiktoken.Encoding] = {}


def load_ranks(path: str = RANKS) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def encoding(ranks: dict[bytes, int]) -> tiktoken.Encoding:
    """One encoder per Python worker and vocabulary."""
    key = hash(frozenset(ranks.items()))
    if key not in _ENCODINGS:
        _ENCODINGS.clear()
        _ENCODINGS[key] = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    return _ENCODINGS[key]


def length_histogram(docs: DataFrame, ranks: dict[bytes, int], text: str = "text") -> DataFrame:
    """(n_tokens, n_docs): how many rows of `docs` have each encoded length.

    NULL and empty texts have length 0. Repeated rows count as often as they are
    there; an empty table gives no rows; other columns are ignored.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoding(ranks).encode_ordinary
        for batch in batches:
            lengths = [len(encode(one)) if one else 0 for one in batch.column(0).to_pylist()]
            values, counts = np.unique(np.array(lengths, dtype=np.int64), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(values), pa.array(counts.astype(np.int64))], ["n_tokens", "n"])

    counted = docs.select(F.col(text).cast("string").alias("text")).mapInArrow(run, "n_tokens bigint, n bigint")
    return counted.groupBy("n_tokens").agg(F.sum("n").alias("n_docs"))


def limits(histogram: DataFrame) -> DataFrame:
    """For every length of the histogram, taken as a context limit:

    n_tokens (the limit), n_docs (of that length), docs_within and tokens_within
    (texts no longer), docs_longer, tokens_longer, truncated_tokens (all texts,
    each cut at the limit), docs_share and tokens_share (within, of all).
    Between two lengths of the histogram, truncated_tokens is linear and the
    others are those of the lesser length.
    """
    histogram = shared_checkpoint(histogram)
    bucket = F.floor(F.col("n_tokens") / BUCKET)
    rows = histogram.withColumn("bucket", bucket).withColumn("tokens", F.col("n_tokens") * F.col("n_docs"))
    # One row per bucket passes through a single window, one row per length through those of its bucket.
    sums = rows.groupBy("bucket").agg(F.sum("n_docs").alias("docs"), F.sum("tokens").alias("tokens"))
    earlier = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy()
    sums = sums.select(
        "bucket",
        F.coalesce(F.sum("docs").over(earlier), F.lit(0)).alias("docs_before"),
        F.coalesce(F.sum("tokens").over(earlier), F.lit(0)).alias("tokens_before"),
        F.sum("docs").over(every).alias("docs_all"),
        F.sum("tokens").over(every).alias("tokens_all"),
    )
    inside = Window.partitionBy("bucket").orderBy("n_tokens")
    found = rows.join(sums, "bucket").select(
        "n_tokens",
        "n_docs",
        (F.col("docs_before") + F.sum("n_docs").over(inside)).alias("docs_within"),
        (F.col("tokens_before") + F.sum("tokens").over(inside)).alias("tokens_within"),
        "docs_all",
        "tokens_all",
    )
    longer = F.col("docs_all") - F.col("docs_within")
    return found.select(
        "n_tokens",
        "n_docs",
        "docs_within",
        "tokens_within",
        longer.alias("docs_longer"),
        (F.col("tokens_all") - F.col("tokens_within")).alias("tokens_longer"),
        (F.col("tokens_within") + longer * F.col("n_tokens")).alias("truncated_tokens"),
        (F.col("docs_within") / F.col("docs_all")).alias("docs_share"),
        F.when(F.col("tokens_all") > 0, F.col("tokens_within") / F.col("tokens_all")).otherwise(1.0).alias("tokens_share"),
    )


def quantiles(histogram: DataFrame, shares: list[float]) -> DataFrame:
    """(share, n_tokens): the least length such that this share of the texts is no longer."""
    wanted = F.explode(F.array(*map(F.lit, map(float, shares)))).alias("share")
    return (
        limits(histogram)
        .select("n_tokens", "docs_share", wanted)
        .filter("docs_share >= share")
        .groupBy("share")
        .agg(F.min("n_tokens").alias("n_tokens"))
    )


def truncated_total(histogram: DataFrame, limit: int) -> DataFrame:
    """One row: docs, tokens and truncated_tokens of all texts cut at any `limit`."""
    cut = F.least(F.col("n_tokens"), F.lit(limit)) * F.col("n_docs")
    return histogram.agg(
        F.coalesce(F.sum("n_docs"), F.lit(0)).alias("docs"),
        F.coalesce(F.sum(F.col("n_tokens") * F.col("n_docs")), F.lit(0)).alias("tokens"),
        F.coalesce(F.sum(cut), F.lit(0)).alias("truncated_tokens"),
    )


def op3_token_counts(spark, sf_dir: str) -> DataFrame:
    """Every context limit at which the counts of `documents` change."""
    return limits(length_histogram(table(spark, sf_dir, "documents"), load_ranks()))
