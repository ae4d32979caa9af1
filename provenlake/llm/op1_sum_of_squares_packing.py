"""Sum-of-squares packing of documents into fixed-length sequences.

A document becomes its token ids and an end id; documents longer than a sequence
are cut into full pieces and a rest.  A piece goes where the sum of the squared
counts of open sequences per residual gap becomes smallest: into an open sequence
of some gap, or into a new one.

Spark deals the pieces by hash into groups of about ``GROUP_ROWS`` and each group
is packed in its own task, longest first.  What a group leaves poorly filled is
dissolved and packed again across groups, so the loss does not add up.  Only
lengths and ids move; texts are tokenized where they are read, and the small table
of pieces is written once to the shared folder, so a lost executor never
tokenizes twice.

Defined cases: a null or empty text is the single end id.  Rows with equal or null
ids are packed each by itself (a null id stays null).  Equal lengths are taken by
id, piece and checksum, so the result does not depend on partitioning.  An empty
table gives no row.  Other columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .staging import free_name, map_texts, staged
from .tokens import UNSAFE, Worker, stand_in, tokenizer

CAPACITY = 4096
END_ID = 1
#: Pieces per packing group; a group is the unit of work of a task.
GROUP_ROWS = 50_000
#: Sequences with a larger gap than this share are dissolved for the second round.
LOOSE = 1 / 64
#: Entries that a worker remembers: white-space separated chunks, and lower-case words.
CHUNKS, WORDS = 400_000, 600_000

#: Fixed value: the pre-token pattern of the tokenizer, for chunks of safe lower-case characters.
PRE_TOKEN = r"'s|'t|'re|'ve|'m|'ll|'d|[^\W\d_]+|\d|(?:[^\s\w]|_)+"
_CONTROL = "\x1c\x1d\x1e\x1f"


def encoder(path: str, end_id: int = END_ID) -> Callable[[str | None], bytes]:
    """text -> its ids and the end id as unsigned 32-bit little-endian bytes.

    No pre-token crosses white space, so a text is the concatenation of its
    chunks; chunks and words are remembered, new words go to the library's model.
    """
    library = tokenizer(path)
    model, cut = library.model, re.compile(PRE_TOKEN).findall
    words, end = Worker(WORDS), np.array([end_id], "<u4").tobytes()

    def raw(text: str) -> bytes:
        return np.array(library.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def word(piece: str) -> bytes:
        found = words.known.get(piece)
        if found is None:
            found = words.put(piece, np.array([t.id for t in model.tokenize(stand_in(piece))], "<u4").tobytes())
        return found

    class Chunks(dict):
        def __missing__(self, chunk: str) -> bytes:
            if len(self) >= CHUNKS:
                self.clear()
            if "<|" in chunk or UNSAFE.search(chunk):
                ids = raw(chunk)
            else:
                ids = b"".join(map(word, cut(chunk.lower())))
            self[chunk] = ids
            return ids

    ids_of = Chunks().__getitem__

    def encode(text: str | None) -> bytes:
        if not text:
            return end
        if any(c in text for c in _CONTROL):  # white space for Python only
            return raw(text) + end
        return b"".join(map(ids_of, text.split())) + end

    return encode


def pieces(
    docs: DataFrame, path: str, id_column: str = "doc_id", text_column: str = "text", capacity: int = CAPACITY, end_id: int = END_ID
) -> DataFrame:
    """(id, piece, start, length, ids_crc32) of the pieces of every document."""
    rows = docs.select(F.col(id_column).alias("_id"), F.col(text_column).cast("string").alias("text"))
    kind = rows.schema["_id"].dataType.simpleString()

    def make() -> Callable[[pa.RecordBatch], pa.RecordBatch]:
        encode, step = encoder(path, end_id), 4 * capacity

        def apply(batch: pa.RecordBatch) -> pa.RecordBatch:
            owner, number, start, length, crc = [], [], [], [], []
            for i, text in enumerate(batch.column("text").to_pylist()):
                ids = encode(text)
                for k, at in enumerate(range(0, len(ids), step)):
                    part = ids[at : at + step]
                    owner.append(i)
                    number.append(k)
                    start.append(at // 4)
                    length.append(len(part) // 4)
                    crc.append(zlib.crc32(part))
            return pa.RecordBatch.from_arrays(
                [
                    batch.column("_id").take(pa.array(owner, pa.int64())), pa.array(number, pa.int32()),
                    pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64()),
                ],
                ["_id", "piece", "start", "length", "ids_crc32"],
            )

        return apply

    made = map_texts(rows, make, f"_id {kind}, piece int, start long, length long, ids_crc32 long")
    return made.withColumnRenamed("_id", id_column)


def sum_of_squares(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """(bin, offset) of each item, taken in the given order.

    ``count[g]`` open bins have gap g.  An item of length s moves one bin from gap g
    to g - s, which changes the sum of squares by 2 (count[g-s] - count[g]) + 2; full
    bins do not count; a new bin adds 2 count[capacity-s] + 1.  An exact gap is always taken: it
    closes a bin, whatever the sums elsewhere.
    """
    count = np.zeros(capacity + 1, np.int64)
    open_bins: list[list[int]] = [[] for _ in range(capacity + 1)]
    bins, offsets = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    made = 0
    for i, s in enumerate(lengths.tolist()):
        best_gap, best = 0, 2 * int(count[capacity - s]) + 1 if s < capacity else 0
        gaps = np.flatnonzero(count[s:capacity]) + s if s < capacity else ()
        if len(gaps):
            change = 2 * (count[gaps - s] - count[gaps]) + 2
            if gaps[0] == s:
                change[0] = 1 - 2 * count[s]
            # Of equal changes the smallest gap wins; an open bin wins over a new one.
            k = int(change.argmin())
            if change[k] <= best or gaps[0] == s:
                best_gap = int(gaps[0] if gaps[0] == s else gaps[k])
        if best_gap:
            where = open_bins[best_gap].pop()
            count[best_gap] -= 1
        else:
            where, best_gap, made = made, capacity, made + 1
        bins[i], offsets[i] = where, capacity - best_gap
        if best_gap > s:
            open_bins[best_gap - s].append(where)
            count[best_gap - s] += 1
    return bins, offsets


def _pack_groups(rows: DataFrame, capacity: int, n_groups: int, order: list[str], number: int) -> DataFrame:
    """``rows`` with ``sequence_id``, ``offset`` and ``_filled`` (tokens in the sequence), packed group by group."""
    dealt = rows.withColumn("_group", F.pmod(F.xxhash64(*order), F.lit(n_groups)).cast("long"))
    placed = dealt.repartition(min(n_groups, 10_000), "_group").sortWithinPartitions(
        "_group", F.desc("length"), *[F.col(c) for c in order]
    )
    names = dealt.columns

    def pack(table: pa.Table) -> pa.Table:
        lengths = table.column("length").to_numpy()
        bins, offsets = sum_of_squares(lengths, capacity)
        filled = np.bincount(bins, weights=lengths).astype(np.int64)[bins]
        group = table.column("_group")[0].as_py()
        # Unique over rounds and groups: round in bits 62.., group from bit 24, bin below.
        ids = (number << 61) + (group << 24) + bins
        for name, values in (("sequence_id", ids), ("offset", offsets), ("_filled", filled)):
            table = table.append_column(name, pa.array(values, pa.int64()))
        return table

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            groups = batch.column("_group").to_numpy()
            cuts = [0, *(np.flatnonzero(np.diff(groups)) + 1).tolist(), len(groups)]
            for a, b in zip(cuts, cuts[1:]):
                if b > a:
                    if held and held[-1].column("_group")[0].as_py() != groups[a]:
                        yield from pack(pa.Table.from_batches(held)).to_batches()
                        held = []
                    held.append(batch.slice(a, b - a))
        if held:
            yield from pack(pa.Table.from_batches(held)).to_batches()

    types = ", ".join(f"`{n}` {dealt.schema[n].dataType.simpleString()}" for n in names)
    return placed.mapInArrow(run, f"{types}, sequence_id long, offset long, _filled long").drop("_group")


def packed(parts: DataFrame, capacity: int = CAPACITY, group_rows: int = GROUP_ROWS) -> DataFrame:
    """``parts`` (a written table with ``length`` and a tie order of the other columns) with ``sequence_id`` and ``offset``.

    Full pieces are sequences of their own and take no part in the search.  The row's place in the
    written table is part of what it is dealt by, so equal rows spread over all groups.
    """
    salt = free_name(parts, "_row")
    order = [*[c for c in parts.columns if c != "length"], salt]
    small = parts.where(F.col("length") < capacity).withColumn(salt, F.monotonically_increasing_id())
    groups = max(1, -(-small.count() // group_rows))
    first = staged(_pack_groups(small, capacity, groups, order, 0), "packed")
    loose = F.col("_filled") < capacity * (1 - LOOSE)
    again = first.where(loose).select(*parts.columns, salt)
    groups = max(1, -(-first.where(loose).count() // group_rows))
    second = _pack_groups(again, capacity, groups, order, 1)
    # Full pieces read a written table, whose splits are the same when a task is repeated; negative numbers are theirs.
    full = parts.where(F.col("length") == capacity).select(
        *parts.columns, (F.lit(-1) - F.monotonically_increasing_id()).alias("sequence_id"), F.lit(0).cast("long").alias("offset")
    )
    names = [*parts.columns, "sequence_id", "offset"]
    return first.where(~loose).select(*names).unionByName(second.select(*names)).unionByName(full.select(*names))


def pack_documents(
    docs: DataFrame, path: str, id_column: str = "doc_id", text_column: str = "text",
    capacity: int = CAPACITY, end_id: int = END_ID, group_rows: int = GROUP_ROWS,
) -> DataFrame:
    """Every piece of every document with its sequence and its place there."""
    parts = staged(pieces(docs, path, id_column, text_column, capacity, end_id), "pieces")
    return packed(parts, capacity, group_rows)
