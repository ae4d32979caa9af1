"""Token counts by a map-side two-tier lookup.

Tier one is a compact table of the lengths of frequent pre-tokens, broadcast
once; tier two is a memo in each Python worker, filled by encoding what the table
misses.  Pre-tokens never leave the task that reads their text: the only thing
that moves is the table, whose size is a parameter.

The table only saves time: a pre-token that it lacks is encoded by the library's model.
It is counted over all documents without a shuffle of their pre-tokens.  Every task keeps
a summary of bounded size: counts of what it has seen, of which the rare half goes
whenever there are ``SEEN`` different ones (lossy counting, so a frequent pre-token is
never lost).  It gives back its ``TABLE_SIZE`` most frequent ones, and Spark sums these.

Characters outside a tested repertoire (``SAFE``), and special strings, go to the library
with the chunk that holds them: a text is cut at single spaces between other signs, where
no pre-token ends or begins otherwise, and only the chunks concerned leave the two tiers.
Their counts are remembered too.

Defined cases: null or empty text: 0 bytes, 0 tokens.  Special strings inside a
text count as the library's default does (one token).  Repeated rows and repeated
or null ids: one result row each.  Other columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .staging import map_texts, small_batches
from .tokens import UNSAFE, stand_in, tokenizer

#: Longest table that is broadcast (pre-tokens); at about 12 characters each it stays below 1 MB.
TABLE_SIZE = 32_768
#: Different pre-tokens that a task's summary holds at most.
SEEN = 262_144
#: Pre-tokens that one worker remembers, and chunks for the library of at most ``LONGEST`` characters.
MEMO_SIZE, LONGEST = 500_000, 64

#: Fixed value: the pre-token pattern of byte-level BPE, for texts of safe characters.
PRE_TOKEN = r"'s|'t|'re|'ve|'m|'ll|'d| ?[^\W\d_]+| ?\d+| ?(?:[^\s\w]|_)+|\s+(?!\S)|\s+"
#: A single space between two other signs: both sides are pre-tokens of their own, the space belongs to the second.
_CUT = re.compile(r"(?<=\S) (?=\S)")


def special_strings(path: str) -> list[str]:
    return sorted(t.content for t in tokenizer(path).get_added_tokens_decoder().values())


def _frequent(texts: Iterable[str | None], size: int, seen: int) -> Counter:
    """The most frequent pre-tokens of the texts' safe chunks, from a summary of at most ``seen`` counts."""
    cut, counts = re.compile(PRE_TOKEN).findall, Counter()
    for text in texts:
        if text:
            counts.update(cut(text if not UNSAFE.search(text) else "".join(_chunks(text)[0])))
            if len(counts) > seen:
                counts = Counter(dict(counts.most_common(seen // 2)))
    return Counter(dict(counts.most_common(size)))


def frequent_lengths(docs: DataFrame, path: str, size: int = TABLE_SIZE, seen: int = SEEN) -> dict[str, int]:
    """Lengths of the most frequent pre-tokens of all documents (``text``); at most ``size`` rows a task are shuffled or reach the driver."""
    small_batches(docs.sparkSession)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = _frequent((t for b in batches for t in b.column("text").to_pylist()), size, seen)
        yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.string()), pa.array(list(found.values()), pa.int64())], ["piece", "n"])

    common = docs.select("text").mapInArrow(run, "piece string, n long").groupBy("piece").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "piece").limit(size)
    model = tokenizer(path).model
    return {piece: len(model.tokenize(stand_in(piece))) for piece in common.select("piece").toArrow().column("piece").to_pylist()}


def _chunks(text: str, specials: tuple[str, ...] = ()) -> tuple[list[str], list[str]]:
    """(safe chunks, chunks for the library) of a text; every chunk but the first begins with its space."""
    parts = _CUT.split(text)
    safe, hard = [], []
    for chunk in [parts[0], *[" " + p for p in parts[1:]]]:
        (hard if UNSAFE.search(chunk) or any(s in chunk for s in specials) else safe).append(chunk)
    return safe, hard


def counter(path: str, table: dict[str, int]) -> Callable[[str], int]:
    """The function that counts one text, with its own memo above ``table``."""
    library = tokenizer(path)
    model, specials = library.model, tuple(special_strings(path))
    chunk_lengths: dict[str, int] = {}
    cut = re.compile(PRE_TOKEN).findall

    class Lengths(dict):
        def __missing__(self, piece: str) -> int:
            if len(self) >= MEMO_SIZE:
                self.clear()
                self.update(table)
            n = self[piece] = len(model.tokenize(stand_in(piece)))
            return n

    length = Lengths(table).__getitem__

    def count(text: str | None) -> int:
        if not text:
            return 0
        if not UNSAFE.search(text) and not any(s in text for s in specials):
            return sum(map(length, cut(text)))
        safe, hard = _chunks(text, specials)
        # Chunks end where pre-tokens do, so those that are safe are one text again.
        total = sum(map(length, cut("".join(safe))))
        new = list(dict.fromkeys(c for c in hard if c not in chunk_lengths))
        own = {c: len(e.ids) for c, e in zip(new, library.encode_batch(new, add_special_tokens=False), strict=True)}
        count.sent += sum(map(len, new))
        total += sum(own[c] if c in own else chunk_lengths[c] for c in hard)
        if len(chunk_lengths) + len(own) > MEMO_SIZE:
            chunk_lengths.clear()
        chunk_lengths.update((c, n) for c, n in own.items() if len(c) <= LONGEST)
        return total

    #: Characters that went to the library whole.
    count.sent = 0
    return count


def token_counts(docs: DataFrame, path: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(id, n_bytes, n_tokens) of every row of ``docs``."""
    rows = docs.select(F.col(id_column).alias("_id"), F.col(text_column).cast("string").alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast(frequent_lengths(rows, path))

    def make() -> Callable[[pa.RecordBatch], pa.RecordBatch]:
        count = counter(path, shared.value)

        def apply(batch: pa.RecordBatch) -> pa.RecordBatch:
            texts = batch.column("text")
            sizes = pa.compute.fill_null(pa.compute.binary_length(texts), 0).cast(pa.int64())
            tokens = pa.array([count(t) for t in texts.to_pylist()], pa.int64())
            return pa.RecordBatch.from_arrays([batch.column("_id"), sizes, tokens], ["_id", "n_bytes", "n_tokens"])

        return apply

    kind = rows.schema["_id"].dataType.simpleString()
    return map_texts(rows, make, f"_id {kind}, n_bytes long, n_tokens long").withColumnRenamed("_id", id_column)
