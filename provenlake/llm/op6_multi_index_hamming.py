"""Near duplicates by min-hash signatures and a multi-index Hamming join.

A text's set of five-word shingles becomes a signature of ``SYMBOLS`` b-bit
min-hash symbols.  Signatures are cut into ``CHUNKS`` chunks; if two signatures
differ in at most ``CHUNKS * (ERRORS + 1) - 1`` symbols then, by pigeonhole, some
chunk has at most ``ERRORS`` wrong symbols.  The allowed errors are enumerated as
masks: every chunk is indexed once per choice of the symbols left out.  So all
pairs within that distance share a key.

Keys only say who may be linked.  Rows of a key are tied to its smallest member
(one row each, never all pairs), ties make families, and inside a family full
shingle sets decide.  Equal sets are one class from the start.  A large family is
cut into blocks by rows and bytes, every pair of blocks is its own task, and a block pair
gives back at most one link per member: pairs already connected are not compared,
and no pair is emitted only to be thrown away.

Bounds: a family with n rows costs (n / BLOCK_ROWS)^2 / 2 block pairs; nothing is
capped.  The expected loss is that of the signature: a pair at exactly the threshold
shares no key with probability below ``LOST``; thresholds at which it could are refused.

Defined cases: a null or wordless text has an empty set and is linked with nothing;
fewer than five words make one shingle; rows with a null id cannot be fetched again
and stand alone (component null, kept).  Of rows with equal ids each has the
component of its own text; their common id is one vertex where it represents a text.
Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .components import components
from .shingles import shingle_sets
from .staging import free_name, map_texts, staged

#: The signature: 15 chunks of 6 symbols of 16 bits.
CHUNKS, CHUNK, ERRORS = 15, 6, 1
SYMBOLS = CHUNKS * CHUNK
PERCENT = 85
#: Shares of pairs at exactly the threshold that the index may lose, and that may lie farther apart than ``far``.
LOST, TOO_FAR = 1e-5, 1e-15
#: A block of a family: rows, and bytes of shingle sets.
BLOCK_ROWS, BLOCK_BYTES = 1_500, 24 << 20
#: Bits of the broadcast filter of family members (16 MB); with more members it only lets more texts pass.
FILTER_BITS = 1 << 27
#: Bytes of text that are turned into shingles at once.
SLICE_BYTES = 1 << 20

_MIX = np.uint64(0x9E3779B97F4A7C15)


def lost_share(percent: int) -> float:
    """Probability that a pair at a similarity of exactly ``percent`` shares no key: every chunk has too many wrong symbols."""
    p = 1 - percent / 100
    return (1 - sum(comb(CHUNK, i) * p**i * (1 - p) ** (CHUNK - i) for i in range(ERRORS + 1))) ** CHUNKS


def far(percent: int) -> int:
    """Pairs whose signatures differ in more symbols are no links: at ``percent`` fewer than ``TOO_FAR`` of all are."""
    p, tail = 1 - percent / 100, 0.0
    for n in range(SYMBOLS, 0, -1):
        tail += comb(SYMBOLS, n) * p**n * (1 - p) ** (SYMBOLS - n)
        if tail >= TOO_FAR:
            return n
    return 0


def _multipliers(n: int) -> np.ndarray:
    return np.random.default_rng(20_240).integers(1, 1 << 63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def signatures(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """16-bit min-hash symbols (rows x SYMBOLS) of the non-empty sets that begin at ``starts``."""
    out = np.empty((len(starts), SYMBOLS), np.uint16)
    mixed = np.empty_like(values)
    for k, m in enumerate(_multipliers(SYMBOLS)):
        np.multiply(values, m, out=mixed)
        low = np.minimum.reduceat(mixed, starts)
        low ^= low >> np.uint64(31)
        out[:, k] = ((low * _MIX) >> np.uint64(48)).astype(np.uint16)
    return out


def _masked_keys(sig: np.ndarray) -> np.ndarray:
    """One 64-bit key per chunk and symbol left out (rows x SYMBOLS)."""
    keys = np.empty(sig.shape, np.uint64)
    wide = sig.astype(np.uint64) + np.uint64(1)
    for chunk in range(CHUNKS):
        for out in range(CHUNK):
            k = np.full(len(sig), chunk * CHUNK + out + 1, np.uint64) * _MIX
            for i in range(CHUNK):
                if i != out:
                    k = (k ^ (k >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) + wide[:, chunk * CHUNK + i]
            keys[:, chunk * CHUNK + out] = (k ^ (k >> np.uint64(32))) * _MIX
    return keys


def digests(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """128 bits that identify each set (rows x 2): order-free sums of its mixed members."""
    out = np.empty((len(starts), 2), np.int64)
    for k, m in enumerate(_multipliers(SYMBOLS + 2)[-2:]):
        h = values * m
        h ^= h >> np.uint64(32)
        out[:, k] = np.add.reduceat(h * _MIX, starts).view(np.int64)
    return out


def fingerprints(docs: DataFrame, id_column: str, text_column: str, row_mark: Column | None = None) -> DataFrame:
    """(_id, row_mark, n_shingles, set_a, set_b, sig): set size, 128-bit digest of the set, signature (null when empty)."""
    rows = docs.select(F.col(id_column).alias("_id"), F.col(text_column).cast("string").alias("text")).withColumn(
        "row_mark", F.lit(0).cast("long") if row_mark is None else row_mark
    )
    kind = rows.schema["_id"].dataType.simpleString()

    def make() -> Callable[[pa.RecordBatch], pa.RecordBatch]:
        def apply(batch: pa.RecordBatch) -> pa.RecordBatch:
            values, counts = shingle_sets(batch.column("text"))
            has = counts > 0
            starts = (np.cumsum(counts) - counts)[has]
            sig: list[bytes | None] = [None] * len(counts)
            ids = np.zeros((len(counts), 2), np.int64)
            if len(starts):
                ids[has] = digests(values, starts)
                for i, row in zip(np.flatnonzero(has), signatures(values, starts), strict=True):
                    sig[i] = row.tobytes()
            return pa.RecordBatch.from_arrays(
                [batch.column("_id"), batch.column("row_mark"), pa.array(counts, pa.int64()), pa.array(ids[:, 0]), pa.array(ids[:, 1]), pa.array(sig, pa.binary())],
                ["_id", "row_mark", "n_shingles", "set_a", "set_b", "sig"],
            )

        return apply

    return map_texts(rows, make, f"_id {kind}, row_mark long, n_shingles long, set_a long, set_b long, sig binary", limit=SLICE_BYTES)


def chunk_keys(classes: DataFrame) -> DataFrame:
    """(key, rep): every class under each of its masked chunk keys."""
    kind = classes.schema["rep"].dataType.simpleString()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 1024):
                part = batch.slice(start, 1024)
                sig = np.frombuffer(b"".join(part.column("sig").to_pylist()), np.uint16).reshape(-1, SYMBOLS)
                keys = _masked_keys(sig).view(np.int64).ravel()
                rep = part.column("rep").take(pa.array(np.repeat(np.arange(len(sig)), SYMBOLS)))
                yield pa.RecordBatch.from_arrays([pa.array(keys), rep], ["key", "rep"])

    return classes.select("rep", "sig").mapInArrow(run, f"key long, rep {kind}")


def ties(keys: DataFrame) -> DataFrame:
    """(a, b): each member of a shared key with the smallest member of that key.

    Keys are shuffled once and sorted; the rows of a key pass through the task one
    batch at a time, however many there are.
    """
    kind = keys.schema["rep"].dataType.simpleString()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last_key = last_rep = None
        for batch in batches:
            key = batch.column("key").to_numpy()
            if not len(key):
                continue
            opens = np.concatenate([[last_key is None or key[0] != last_key], key[1:] != key[:-1]])
            run_of = np.cumsum(opens) - 1
            first = np.flatnonzero(opens)
            reps = batch.column("rep").to_pylist()
            pairs = set()
            for i in np.flatnonzero(~opens).tolist():
                smallest = reps[first[run_of[i]]] if run_of[i] >= 0 else last_rep
                if smallest != reps[i]:
                    pairs.add((smallest, reps[i]))
            if run_of[-1] >= 0:
                last_rep = reps[first[-1]]
            last_key = key[-1]
            if pairs:
                a, b = zip(*pairs, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(x, batch.schema.field("rep").type) for x in (a, b)], ["a", "b"])

    return keys.repartition("key").sortWithinPartitions("key", "rep").mapInArrow(run, f"a {kind}, b {kind}")


def _families(classes: DataFrame) -> DataFrame:
    """(rep, family) of the classes that share a key with another one, directly or through others."""
    found = components(ties(chunk_keys(classes)))
    return found.select(F.col("vertex").alias("rep"), F.col("component").alias("family"))


def _blocked(members: DataFrame) -> DataFrame:
    """(rep, set_a, n_shingles, family, block, low, high): each member in every pair of blocks that holds its own.

    A small family is one block and one task's group.
    """
    size = F.col("n_shingles") * 8
    sizes = members.groupBy("family").agg(F.count(F.lit(1)).alias("_n"), F.sum(size).alias("_bytes"))
    blocks = sizes.select(
        "family", F.greatest(F.ceil(F.col("_n") / BLOCK_ROWS), F.ceil(F.col("_bytes") / BLOCK_BYTES), F.lit(1)).cast("int").alias("_blocks")
    )
    placed = members.join(blocks, "family").withColumn("block", F.pmod(F.xxhash64("rep", "set_a"), F.col("_blocks")).cast("int"))
    return placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1))).withColumns({
        "low": F.least("block", "other"), "high": F.greatest("block", "other"),
    }).drop("_blocks", "other")


class _Forest:
    """Union-find of one block pair."""

    def __init__(self, n: int) -> None:
        self.up = list(range(n))

    def root(self, i: int) -> int:
        up = self.up
        while up[i] != i:
            up[i] = up[up[i]]
            i = up[i]
        return i

    def join(self, i: int, j: int) -> bool:
        a, b = self.root(i), self.root(j)
        self.up[max(a, b)] = min(a, b)
        return a != b


def linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """100 * |a n b| >= percent * |a u b| for sorted distinct arrays."""
    if 100 * min(len(a), len(b)) < percent * max(len(a), len(b)):
        return False
    both = np.concatenate([a, b])
    both.sort()
    common = int((both[1:] == both[:-1]).sum())
    return 100 * common >= percent * (len(both) - common)


def forest(sig: np.ndarray, sets: list[np.ndarray], side: np.ndarray, percent: int) -> list[tuple[int, int]]:
    """Links that connect the rows as all links would; rows of one side (-1: all) are compared with the other side only."""
    n = len(sets)
    tree, out = _Forest(n), []
    sizes = np.array([len(s) for s in sets])
    most = far(percent)
    for i in range(n - 1):
        near = (sig[i + 1 :] != sig[i]).sum(1) <= most
        near &= 100 * np.minimum(sizes[i], sizes[i + 1 :]) >= percent * np.maximum(sizes[i], sizes[i + 1 :])
        if side[i] >= 0:
            near &= side[i + 1 :] != side[i]
        for j in (np.flatnonzero(near) + i + 1).tolist():
            if tree.root(i) != tree.root(j) and linked(sets[i], sets[j], percent):
                tree.join(i, j)
                out.append((i, j))
    return out


def groups(batches: Iterable[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Tables of the rows with equal keys, from batches sorted by them."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        rows = list(zip(*[batch.column(k).to_pylist() for k in keys], strict=True))
        start = 0
        for i in range(1, len(rows) + 1):
            if i == len(rows) or rows[i] != rows[start]:
                if held and rows[start] != last:
                    yield pa.Table.from_batches(held)
                    held = []
                held.append(batch.slice(start, i - start))
                last, start = rows[start], i
    if held:
        yield pa.Table.from_batches(held)


def _verified(members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(a, b): links between class representatives, confirmed on full sets; a spanning forest per block pair."""
    kind = members.schema["rep"].dataType.simpleString()
    dealt = _blocked(members).join(sets, ["rep", "set_a", "n_shingles"])
    placed = dealt.repartition("family", "low", "high").sortWithinPartitions("family", "low", "high", "rep")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in groups(batches, ["family", "low", "high"]):
            sig = np.frombuffer(b"".join(table.column("sig").to_pylist()), np.uint16).reshape(-1, SYMBOLS)
            sets = [np.frombuffer(b, np.uint64) for b in table.column("set").to_pylist()]
            crossing = table.column("low")[0].as_py() != table.column("high")[0].as_py()
            side = table.column("block").to_numpy() if crossing else np.full(len(sets), -1)
            links = forest(sig, sets, side, percent)
            if links:
                rep = table.column("rep").combine_chunks()
                yield pa.RecordBatch.from_arrays([rep.take(pa.array(x)) for x in zip(*links, strict=True)], ["a", "b"])

    return placed.mapInArrow(run, f"a {kind}, b {kind}")


def _bits(members: DataFrame) -> np.ndarray:
    """One bit per hash of a member's id, in ``FILTER_BITS`` bits whatever the number of members."""
    bit = F.pmod(F.xxhash64("rep"), F.lit(FILTER_BITS))
    words = members.groupBy(F.shiftright(bit, 6).alias("word")).agg(
        F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), bit.bitwiseAND(F.lit(63)).cast("int"))).alias("bits")
    ).toArrow()
    out = np.zeros(FILTER_BITS >> 6, np.uint64)
    out[words.column("word").to_numpy()] = words.column("bits").to_numpy().view(np.uint64)
    return out


def _sets_of(docs: DataFrame, members: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """(rep, set_a, n_shingles, sig, set) of the texts whose ids may be members', computed where they are read.

    A filter of fixed size is broadcast, so texts are not shuffled; the join with
    the members decides, and the filter only spares work.
    """
    hit = F.pmod(F.xxhash64(F.col(id_column)), F.lit(FILTER_BITS))
    rows = docs.where(F.col(id_column).isNotNull() & F.col(text_column).isNotNull()).select(
        F.col(id_column).alias("rep"), F.col(text_column).cast("string").alias("text"), hit.alias("bit")
    )
    shared = docs.sparkSession.sparkContext.broadcast(_bits(members))
    kind = rows.schema["rep"].dataType.simpleString()

    def make() -> Callable[[pa.RecordBatch], pa.RecordBatch]:
        bits = shared.value

        def apply(batch: pa.RecordBatch) -> pa.RecordBatch:
            bit = batch.column("bit").to_numpy()
            chosen = np.flatnonzero((bits[bit >> 6] >> (bit & 63).astype(np.uint64)) & np.uint64(1))
            own = batch.take(pa.array(chosen))
            values, counts = shingle_sets(own.column("text"))
            has = np.flatnonzero(counts > 0)
            starts = (np.cumsum(counts) - counts)[has]
            sets = [values[a : a + n].tobytes() for a, n in zip(starts, counts[has], strict=True)]
            sig = [row.tobytes() for row in signatures(values, starts)] if len(has) else []
            digest = digests(values, starts)[:, 0] if len(has) else np.zeros(0, np.int64)
            return pa.RecordBatch.from_arrays(
                [own.column("rep").take(pa.array(has)), pa.array(digest), pa.array(counts[has], pa.int64()), pa.array(sig, pa.binary()), pa.array(sets, pa.binary())],
                ["rep", "set_a", "n_shingles", "sig", "set"],
            )

        return apply

    return map_texts(rows, make, f"rep {kind}, set_a long, n_shingles long, sig binary, set binary", limit=SLICE_BYTES)


def deduplicated(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", percent: int = PERCENT) -> DataFrame:
    """``docs`` with one document of each group: the one of the smallest id; all columns stay.

    Rows that repeat an id with its text are one document.  Rows without an id all stay.
    """
    names = docs.columns
    text_hash = F.xxhash64(F.col(text_column).cast("string"))
    marks = near_duplicates(docs.select(id_column, text_column), id_column, text_column, percent, F.xxhash64("text"))
    kept = staged(
        marks.where(F.col("kept") & F.col(id_column).isNotNull()).groupBy(F.col(id_column).alias("_id"), F.col("row_mark").alias("_mark"))
        .agg(F.count(F.lit(1)).alias("_copies")), "kept",
    )
    mark = free_name(docs, "_mark")
    marked = docs.withColumn(mark, text_hash)
    on = (F.col(f"_docs.{id_column}") == F.col("_kept._id")) & F.col(f"_docs.{mark}").eqNullSafe(F.col("_kept._mark"))
    once = marked.alias("_docs").join(kept.where("_copies = 1").alias("_kept"), on, "left_semi")
    parts = [once.select(*names), docs.where(F.col(id_column).isNull())]
    repeated = kept.where("_copies > 1")
    if not repeated.isEmpty():
        again = marked.alias("_docs").join(repeated.alias("_kept"), on, "left_semi")
        parts.append(again.dropDuplicates([id_column, mark]).select(*names))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def near_duplicates(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", percent: int = PERCENT,
    row_mark: Column | None = None,
) -> DataFrame:
    """(id, n_shingles, component_id, kept) of every row of ``docs``, and ``row_mark`` (of ``text``) when one is given."""
    if lost_share(percent) > LOST:
        raise ValueError(f"the index would lose more than {LOST:g} of the pairs at {percent} %")
    marks = staged(fingerprints(docs, id_column, text_column, row_mark), "fingerprints")
    usable = marks.where("n_shingles > 0 AND _id IS NOT NULL")
    classes = staged(
        usable.groupBy("set_a", "set_b", "n_shingles").agg(F.min("_id").alias("rep"), F.min("sig").alias("sig")), "classes"
    )
    families = _families(classes)
    members = staged(classes.join(families, "rep").select("rep", "family", "set_a", "n_shingles"), "members")
    links = _verified(members, _sets_of(docs, members, id_column, text_column), percent)
    labels = components(links)
    of_class = classes.join(labels, F.col("vertex") == F.col("rep"), "left").select(
        "set_a", "set_b", "n_shingles", F.coalesce("component", "rep").alias("component_id")
    )
    joined = marks.join(of_class, ["set_a", "set_b", "n_shingles"], "left")
    component = F.when(F.col("_id").isNull(), F.lit(None)).otherwise(F.coalesce("component_id", "_id"))
    return joined.select(
        F.col("_id").alias(id_column), "n_shingles", component.alias("component_id"), component.eqNullSafe(F.col("_id")).alias("kept"),
        *(["row_mark"] if row_mark is not None else []),
    )
