"""Phrases that belong together, from count streams in prefix and in suffix order.

Counting.  Phrases of one to four words are counted one length at a time, per language,
in exact integer codes of the words of about ``GATHERED`` bytes of text; tasks give back
distinct phrases, which Spark sums.  A phrase is counted only where both its parts of one
word less may be frequent: a bit set of fixed size (``FILTER_BITS``) of the frequent ones
is broadcast.  A bit may be set by chance, never be missing: the sums decide.

Streams.  The frequent phrases of all lengths are one table, sorted by their words (the
prefix stream) and by their words from the last one (the suffix stream).  Every part of a
frequent phrase is frequent, so in the prefix stream the first k words of a phrase are the
latest row of k words at or before it, and the phrases that follow a row before the next
one of its length or less extend it to the right.  So one pass finds left counts and the
largest right extension, and one pass of the suffix stream right counts and the largest
left extension, with neither hash table nor lookup.  Streams are range-partitioned; what a
partition needs of those before and after it are six numbers each.  The two streams are
then merge-joined on the phrase.

A candidate is dropped for a longer one of at least ``COVER`` percent of its count.  One of
these has one word more: any longer phrase around it contains such a phrase, which is
at least as frequent.  So the two extension counts decide.

Scores are exact: products are decimals of 38 digits.  No group is held by a task: a
language or a first word may have any share of the rows.

Defined cases: a null text is empty; a null language is ``und``, together with one of that
name.  Repeated rows and rows without an id count like all others.  Equal scores: the larger
count, then the smaller phrase in bytes.  Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shingles import _bytes_of
from .staging import small_batches, staged

LONGEST, LEAST, COVER, TOP = 4, 30, 80, 2_000
UNKNOWN = "und"
#: Bytes of text whose phrases are summed together.
GATHERED = 2 << 20
#: Bits of the broadcast filter of frequent phrases (16 MB); with more phrases it only lets more pass.
FILTER_BITS = 1 << 27
#: Rows of a stream that one task holds.
STREAM_ROWS = 500_000

#: Stands between the words of a phrase; no word holds it.
_TAB = "\t"
_KIND = np.zeros(256, np.uint8)
_KIND[[9, 32]] = 1
_KIND[[*b".,;:!?", *range(10, 14)]] = 2
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD1342543DE82EF95)


def words_of(texts: pa.Array) -> tuple[pa.DictionaryArray, np.ndarray, np.ndarray]:
    """(words in order, piece of each, row of each) of the texts; a piece ends at a mark, a line's end or the text's."""
    raw, ends = _bytes_of(texts)
    data = np.insert(raw, ends, 10) if len(ends) else raw
    ends = ends + np.arange(1, len(ends) + 1)
    kind = _KIND[data]
    inside = kind == 0
    edge = np.diff(inside.astype(np.int8), prepend=0)
    start, stop = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    offsets = np.concatenate([[0], np.cumsum(stop - start)]).astype(np.int64)
    buffers = [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(_LOWER[data[inside]]))]
    words = pa.Array.from_buffers(pa.large_string(), len(start), buffers).dictionary_encode()
    return words, np.cumsum(kind == 2, dtype=np.int32)[start], np.searchsorted(ends, start, side="right")


def _hashes(values: pa.Array) -> np.ndarray:
    """A hash of each string of a dictionary."""
    return np.array([xxhash.xxh64_intdigest(v) for v in values.to_pylist()], np.uint64)


def _phrase_hashes(words: np.ndarray, lang: np.ndarray, length: int) -> np.ndarray:
    """A hash of the phrase of ``length`` words that begins at each place, given hashes of words and languages."""
    n = max(len(words) - length + 1, 0)
    h = lang[:n] * _A
    for k in range(length):
        h = (h ^ words[k : n + k]) * _B
        h ^= h >> np.uint64(29)
    return h * _A


def _codes(columns: list[tuple[np.ndarray, int]]) -> np.ndarray:
    """One integer for each row of the columns (values and their number), equal for equal rows alone."""
    code, size = columns[0][0].astype(np.int64), columns[0][1]
    for values, n in columns[1:]:
        if size * n >= 1 << 62:
            known, code = np.unique(code, return_inverse=True)
            size = len(known)
        code, size = code * n + values, size * n
    return code


def _summed(langs: pa.Array, texts: pa.Array, length: int, bits: np.ndarray | None) -> pa.RecordBatch:
    """(lang, phrase, n) of the phrases of a length in some texts, as far as the filter lets them pass."""
    words, piece, row = words_of(texts)
    lang = langs.dictionary_encode()
    word, own = words.indices.to_numpy(), lang.indices.to_numpy()[row]
    n = max(len(word) - length + 1, 0)
    at = np.arange(n)
    if length > 1:
        at = at[piece[:n] == piece[length - 1 :][:n]]
        h = _phrase_hashes(_hashes(words.dictionary)[word], _hashes(lang.dictionary)[own], length - 1)
        passes = _has(bits, h)
        at = at[passes[at] & passes[at + 1]]
    code = _codes([(own[at], len(lang.dictionary)), *((word[at + k], len(words.dictionary)) for k in range(length))])
    _, first, count = np.unique(code, return_index=True, return_counts=True)
    first = at[first]
    parts = [words.dictionary.take(pa.array(word[first + k])) for k in range(length)]
    phrase = pc.binary_join_element_wise(*parts, pa.scalar(_TAB, pa.large_string())) if length > 1 else parts[0]
    return pa.RecordBatch.from_arrays([lang.dictionary.take(pa.array(own[first])).cast(pa.string()), phrase.cast(pa.string()), pa.array(count)], ["lang", "phrase", "n"])


def _has(bits: np.ndarray, h: np.ndarray) -> np.ndarray:
    bit = h & np.uint64(FILTER_BITS - 1)
    return (bits[(bit >> np.uint64(6)).astype(np.int64)] >> (bit & np.uint64(63)) & np.uint64(1)).astype(bool)


def _bits(phrases: DataFrame, length: int) -> np.ndarray:
    """The filter of some phrases of one length: a bit for each hash, ``FILTER_BITS`` whatever their number."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = pc.split_pattern(batch.column("phrase"), _TAB).flatten().dictionary_encode()
            lang = batch.column("lang").dictionary_encode()
            h = _phrase_hashes(_hashes(words.dictionary)[words.indices.to_numpy()], np.repeat(_hashes(lang.dictionary)[lang.indices.to_numpy()], length), length)[::length]
            yield pa.RecordBatch.from_arrays([pa.array((h & np.uint64(FILTER_BITS - 1)).astype(np.int64))], ["bit"])

    bit = phrases.select("lang", "phrase").mapInArrow(run, "bit long")
    found = bit.groupBy(F.shiftright("bit", 6).alias("word")).agg(
        F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), F.col("bit").bitwiseAND(F.lit(63)).cast("int"))).alias("bits")
    ).toArrow()
    out = np.zeros(FILTER_BITS >> 6, np.uint64)
    out[found.column("word").to_numpy()] = found.column("bits").to_numpy().view(np.uint64)
    return out


def _counted(texts: DataFrame, length: int, bits: np.ndarray | None) -> DataFrame:
    """(lang, phrase, n): phrases of ``length`` words with all their occurrences, words joined by a tab."""
    shared = texts.sparkSession.sparkContext.broadcast(bits)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size = 0
        for batch in batches:
            held.append(batch)
            size += batch.nbytes
            if size >= GATHERED:
                yield from once(held)
                held, size = [], 0
        if held:
            yield from once(held)

    def once(held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(held)
        texts = pa.concat_arrays([c.cast(pa.large_string()) for c in table.column("text").chunks])
        out = _summed(table.column("lang").combine_chunks(), texts, length, shared.value)
        for start in range(0, out.num_rows, 1 << 16):
            yield out.slice(start, 1 << 16)

    return texts.mapInArrow(run, "lang string, phrase string, n long").groupBy("lang", "phrase").agg(F.sum("n").alias("n"))


def frequent_phrases(docs: DataFrame, text_column: str = "text", lang_column: str = "lang", least: int = LEAST, longest: int = LONGEST) -> tuple[DataFrame, DataFrame]:
    """((lang, phrase, words, n) of all phrases that occur ``least`` times, (lang, n) of all word occurrences)."""
    small_batches(docs.sparkSession)
    texts = docs.select(
        F.coalesce(F.col(lang_column).cast("string"), F.lit(UNKNOWN)).alias("lang"), F.col(text_column).cast("string").alias("text")
    ).where("text IS NOT NULL")
    every = staged(_counted(texts, 1, None), "words")
    totals = every.groupBy("lang").agg(F.sum("n").alias("n"))
    last = every.where(F.col("n") >= least)
    out = last.withColumn("words", F.lit(1))
    for length in range(2, longest + 1):
        last = staged(_counted(texts, length, _bits(last, length - 1)).where(F.col("n") >= least), f"phrases{length}")
        out = out.unionByName(last.withColumn("words", F.lit(length)))
    return out, totals


def _scanned(stream: DataFrame, longest: int) -> DataFrame:
    """Rows of a sorted stream with what their partition tells: ``part0..`` counts of shorter parts, ``more`` the largest extension, ``closing``."""
    parts = ", ".join(f"part{k} long" for k in range(1, longest))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = list(batches)
        rows = sum(b.num_rows for b in held)
        if not rows:
            return
        table = pa.Table.from_batches(held)
        words, n = table.column("words").to_numpy(), table.column("n").to_numpy()
        at = np.arange(rows)
        more, closing = np.zeros(rows, np.int64), np.zeros(rows, bool)
        columns = []
        for k in range(1, longest):
            last = np.maximum.accumulate(np.where(words == k, at, -1))
            columns.append(pa.array(n[np.maximum(last, 0)], mask=(last < 0) | (words <= k)))
            longer = np.flatnonzero((words == k + 1) & (last >= 0))
            np.maximum.at(more, last[longer], n[longer])
            if last[-1] >= 0:
                closing[last[-1]] = True
        context = TaskContext.get()
        part = pa.array(np.full(rows, context.partitionId() if context else 0, np.int32))
        out = pa.table(
            [*(table.column(c) for c in ("lang", "phrase", "words", "n")), part, *columns, pa.array(more), pa.array(closing)],
            ["lang", "phrase", "words", "n", "piece", *(f"part{k}" for k in range(1, longest)), "more", "closing"],
        )
        yield from out.combine_chunks().to_batches(max_chunksize=1 << 15)

    return stream.mapInArrow(run, f"lang string, phrase string, words int, n long, piece int, {parts}, more long, closing boolean")


def _carried(rows: DataFrame, longest: int) -> DataFrame:
    """(piece, before1.., after1..): for each partition the last count of each length before it, and the largest extension after it of its closing rows."""
    of_length = lambda k: F.col("words") == k
    found = rows.groupBy("piece").agg(*[
        e for k in range(1, longest) for e in (
            F.max(F.when(F.col("closing") & of_length(k), F.col("n"))).alias(f"last{k}"),
            F.max(F.when(of_length(k + 1) & F.col(f"part{k}").isNull(), F.col("n"))).alias(f"open{k}"),
        )
    ]).collect()  # one row per partition
    found.sort(key=lambda r: r["piece"])
    out = {r["piece"]: [r["piece"]] for r in found}
    for k in range(1, longest):
        last = None
        for r in found:
            out[r["piece"]].append(last)
            last = r[f"last{k}"] if r[f"last{k}"] is not None else last
    for k in range(1, longest):
        after = None
        for r in reversed(found):
            out[r["piece"]].append(after)
            own = r[f"open{k}"]
            after = own if r[f"last{k}"] is not None else max((x for x in (after, own) if x is not None), default=None)
    names = [f"{side}{k} long" for side in ("before", "after") for k in range(1, longest)]
    return rows.sparkSession.createDataFrame([tuple(v) for v in out.values()], f"piece int, {', '.join(names)}")


def stream(phrases: DataFrame, rows: int, reverse: bool, longest: int = LONGEST) -> DataFrame:
    """(lang, phrase, words, n, part1.., more): counts of the first (``reverse``: last) words of every phrase, and its largest extension at the other end."""
    spark = phrases.sparkSession
    key = F.split("phrase", _TAB)
    key = F.reverse(key) if reverse else key
    pieces = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows // STREAM_ROWS))
    ordered = phrases.withColumn("_key", key).repartitionByRange(pieces, "lang", "_key").sortWithinPartitions("lang", "_key")
    scanned = staged(_scanned(ordered.select("lang", "phrase", "words", "n"), longest), "suffix_stream" if reverse else "prefix_stream")
    carried = scanned.join(F.broadcast(_carried(scanned, longest)), "piece")
    after = F.coalesce(*[F.when(F.col("closing") & (F.col("words") == k), F.col(f"after{k}")) for k in range(1, longest)])
    return carried.select(
        "lang", "phrase", "words", "n",
        *(F.when(F.col("words") > k, F.coalesce(f"part{k}", f"before{k}")).alias(f"part{k}") for k in range(1, longest)),
        F.greatest("more", F.coalesce(after, F.lit(0))).alias("more"),
    )


def _score(a: Column, left: Column, right: Column) -> Column:
    """floor(2000000 * a / (left + right)), exact."""
    wide = lambda c: c.cast("decimal(20,0)")
    product = (F.lit(2_000_000).cast("decimal(7,0)") * wide(a)).cast("decimal(38,0)")
    return F.call_function("div", product, (wide(left) + wide(right)).cast("decimal(38,0)"))


def collocations(
    docs: DataFrame, text_column: str = "text", lang_column: str = "lang", least: int = LEAST, longest: int = LONGEST, top: int = TOP,
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the ``top`` phrases of each language by their weakest cut."""
    phrases, totals = frequent_phrases(docs, text_column, lang_column, least, longest)
    rows = phrases.count()
    several = F.col("words") > 1
    ahead = stream(phrases, rows, False, longest).where(several)
    behind = stream(phrases, rows, True, longest).where(several).select(
        "lang", "phrase", F.col("more").alias("_left_more"), F.array(*(f"part{k}" for k in range(1, longest))).alias("_right")
    )
    both = ahead.join(behind.hint("merge"), ["lang", "phrase"])
    cuts = []
    for k in range(1, longest):
        right = F.element_at("_right", F.greatest(F.col("words") - k, F.lit(1)))
        cuts.append(F.when(F.col("words") > k, F.struct(
            _score(F.col("n"), F.col(f"part{k}"), right).alias("score"), F.lit(k).alias("k"), F.col(f"part{k}").alias("l"), right.alias("r"),
        )))
    wide = F.greatest("more", "_left_more").cast("decimal(20,0)")
    alone = both.where(wide * 100 < F.col("n").cast("decimal(20,0)") * COVER)
    scored = alone.withColumn("_cut", F.array_min(F.filter(F.array(*cuts), lambda c: c.isNotNull()))).select(
        "lang", F.translate("phrase", _TAB, " ").alias("phrase"), F.col("n").alias("a"), "_cut.l", "_cut.r", "_cut.score"
    )
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    best = scored.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return best.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
