"""Token counts: the exact histogram of encoded lengths, and what it answers for every context limit."""

from __future__ import annotations

import base64
import importlib.util
from collections.abc import Callable
from pathlib import Path

import tiktoken
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import scan

#: Lengths of one bucket of the suffix sums.
BUCKET = 1024


def vocabulary_path(name: str) -> str:
    """Place of a public vocabulary file."""
    spec = importlib.util.find_spec("public_tokenizers")
    return str(Path(spec.origin).parent / name)


def byte_pair_encoding(path: str, pattern: str) -> tiktoken.Encoding:
    lines = Path(path).read_bytes().splitlines()
    ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return tiktoken.Encoding("file", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def byte_bpe_50k(path: str | None = None) -> Callable[[str], int]:
    """Number of tokens of a text under the 50k byte-level vocabulary; special tokens' strings are ordinary text."""
    import public_tokenizers

    encoding = byte_pair_encoding(path or vocabulary_path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    return lambda text: len(encoding.encode_ordinary(text))


def encoded_lengths(docs: DataFrame, text: str = "text", counter: Callable[[], Callable[[str], int]] = byte_bpe_50k) -> DataFrame:
    """``length`` of each text in tokens; null and empty texts have length 0. ``counter`` is built once per task."""

    def fn(batches):
        count = counter()
        for (texts,) in batches:
            yield ([count(t) if t else 0 for t in texts],)

    return scan(docs, {"text": text}, fn, "length long")


def length_histogram(lengths: DataFrame) -> DataFrame:
    """length, n_docs: one row per distinct length; equal lengths meet as sums of each task."""
    return lengths.groupBy("length").agg(F.count("*").alias("n_docs"))


def context_totals(histogram: DataFrame) -> DataFrame:
    """For every length that occurs, taken as a context limit, exact answers from suffix sums.

    length, n_docs, n_longer (documents above the limit), n_tokens (in documents up to the limit), truncated_total
    (tokens if every document is cut at the limit), lost_total (tokens cut off), quantile (share of documents
    up to the limit). An empty histogram gives an empty result.

    The sums run within buckets of lengths; the totals of later buckets, one row per bucket, are added. So the
    ordered work is never in one task, except over the bucket totals.
    """
    keyed = histogram.withColumns({"bucket": F.floor(F.col("length") / BUCKET), "tokens": F.col("length") * F.col("n_docs")})
    sums = keyed.groupBy("bucket").agg(F.sum("n_docs").alias("d"), F.sum("tokens").alias("t"))
    after = Window.orderBy(F.desc("bucket")).rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    later = sums.select(
        "bucket", F.coalesce(F.sum("d").over(after), F.lit(0)).alias("later_d"), F.coalesce(F.sum("t").over(after), F.lit(0)).alias("later_t"),
        F.sum("d").over(whole).alias("all_d"), F.sum("t").over(whole).alias("all_t"),
    )
    longer = Window.partitionBy("bucket").orderBy(F.desc("length")).rowsBetween(Window.unboundedPreceding, -1)
    out = keyed.join(later, "bucket").withColumns({
        "n_longer": F.coalesce(F.sum("n_docs").over(longer), F.lit(0)) + F.col("later_d"),
        "above": F.coalesce(F.sum("tokens").over(longer), F.lit(0)) + F.col("later_t"),
    })
    return out.select(
        "length", "n_docs", "n_longer", (F.col("all_t") - F.col("above")).alias("n_tokens"),
        (F.col("all_t") - F.col("above") + F.col("length") * F.col("n_longer")).alias("truncated_total"),
        (F.col("above") - F.col("length") * F.col("n_longer")).alias("lost_total"),
        ((F.col("all_d") - F.col("n_longer")) / F.col("all_d")).alias("quantile"),
    )

