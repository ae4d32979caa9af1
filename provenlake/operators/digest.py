"""Digests that identify a table by the multiset of its canonical rows."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.canonical import canonical_json

# A SHA-256 is cut into words of 32 bits; their sums over all rows are kept exactly.
WORDS, HEX_DIGITS = 8, 8
SUM_TYPE = "decimal(30,0)"


def multiset_digest(df: DataFrame, columns: Sequence[str] | None = None, row_json: Column | None = None, frame: str = "") -> DataFrame:
    """One row (row_count, digest) identifying the multiset of canonical rows.

    Every row is hashed on its own; the words of the hashes are summed, and the
    digest is the SHA-256 of ``frame``, the number of rows and the sums.  Sums combine in any
    order and in every task, so one row per task is shuffled at any size, no key is
    hot, and the result depends neither on order nor on partitioning or retries.
    """
    text = row_json if row_json is not None else canonical_json(df, columns)
    hashed = df.select(F.sha2(text, 256).alias("h"))
    words = [F.conv(F.substring("h", 1 + i * HEX_DIGITS, HEX_DIGITS), 16, 10).cast("bigint") for i in range(WORDS)]
    # Halves of 16 bits: a sum of integers stays exact up to 2^47 rows.
    halves = [h for i in range(WORDS) for h in (
        F.sum(F.shiftright(F.col(f"w{i}"), 16)).alias(f"high{i}"), F.sum(F.col(f"w{i}").bitwiseAND(F.lit(0xFFFF))).alias(f"low{i}"),
    )]
    sums = hashed.select(*[w.alias(f"w{i}") for i, w in enumerate(words)]).agg(F.count(F.lit(1)).alias("row_count"), *halves)
    none = F.lit(0).cast(SUM_TYPE)
    parts = [
        (F.coalesce(F.col(f"high{i}").cast(SUM_TYPE), none) * 65536 + F.coalesce(F.col(f"low{i}").cast(SUM_TYPE), none)).cast(SUM_TYPE).cast("string")
        for i in range(WORDS)
    ]
    return sums.select(
        "row_count", F.sha2(F.concat_ws(":", F.lit(frame), F.col("row_count").cast("string"), *parts), 256).alias("digest")
    )


def published_sha256(lines: DataFrame, order: Sequence[Column], head: str = "", between: str = "", tail: str = "") -> str:
    """SHA-256 of ``head`` + the ordered ``line`` values joined by ``between`` + ``tail``.

    Only for the two published identities of an evaluation, which are defined as one
    hash over one document with an entry per inventory puzzle.  Such a hash cannot be merged: one task streams the
    sorted lines in constant memory.  Tables are identified by ``multiset_digest``.
    """

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest, first = hashlib.sha256(head.encode("utf-8")), True
        for batch in batches:
            for line in batch.column(0):
                digest.update(("" if first else between).encode("utf-8") + line.as_py().encode("utf-8"))
                first = False
        digest.update(tail.encode("utf-8"))
        yield pa.RecordBatch.from_pydict({"digest": [digest.hexdigest()]})

    keyed = lines.select("line", *[c.alias(f"_o{i}") for i, c in enumerate(order)])
    ordered = keyed.repartition(1).sortWithinPartitions(*[f"_o{i}" for i in range(len(order))])
    found = ordered.select("line").mapInArrow(fold, "digest string").collect()
    return found[0][0] if found else hashlib.sha256((head + tail).encode("utf-8")).hexdigest()
