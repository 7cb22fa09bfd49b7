"""Counts of words over a corpus, and the bounded part of a vocabulary that may be broadcast."""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import scan

#: Distinct words a task counts before it passes them on.
HELD = 1 << 20
#: Words of a broadcast head of a vocabulary at most.
HEAD = 1 << 18


def word_counts(docs: DataFrame, text: str, split: Callable[[str | None], list], parts: Callable[[str], list[str]] | None = None, limit: int = HELD, raw: bool = False, partitions: int | None = None) -> DataFrame:
    """word, n over all texts. Each task adds up first, so a frequent word is one row per task in the shuffle.

    With ``parts``, what ``split`` gives is counted first and each distinct unit is then cut into words once. With ``raw``,
    ``split`` gets UTF-8 and gives words in UTF-8. ``partitions`` is for work that makes many rows of each word in its place.
    """

    def fn(batches):
        held: Counter = Counter()

        def flush():
            if parts is None:
                out = held
            else:
                out = Counter()
                for unit, n in held.items():
                    for w in parts(unit):
                        out[w] += n
            return list(out), list(out.values())

        for (texts,) in batches:
            for t in texts:
                held.update(split(t))
            if len(held) >= limit:
                yield flush()
                held.clear()
        yield flush()

    parts_ = scan(docs, {"text": F.col(f"`{text}`").cast("binary") if raw else text}, fn, "word string, n long")
    return (parts_ if partitions is None else parts_.repartition(partitions, "word")).groupBy("word").agg(F.sum("n").alias("n"))


def head(counts: DataFrame, size: int = HEAD) -> tuple[DataFrame, DataFrame]:
    """The most frequent words, at most ``size``, and the others: cut at the lowest class of counts that still fits.

    Classes are eighths of powers of two, so what is collected to choose one has at most 8 x 63 rows.
    """
    level = F.floor(F.log2("n") * 8).cast("int")
    classes = counts.groupBy(level.alias("level")).count().collect()
    least, total = 1 << 20, 0
    for row in sorted(classes, key=lambda r: -r["level"]):
        total += row["count"]
        if total > size:
            break
        least = row["level"]
    return counts.where(level >= least), counts.where(level < least)
