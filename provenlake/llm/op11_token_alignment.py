"""Alignment of the tokens of two tokenizers over the same bytes.

A byte-level tokenizer (A, tokenizers library) and a SentencePiece model (B) encode
one text, which both see with a space before it.  The spans that the libraries report
are the coarse cuts: character offsets of A, byte spans of the pieces of B (the
sentencepiece version at hand calls its immutable protos ``proto``).  Where a span
does not tell a token's bytes (A cuts inside a character, B falls back to bytes) the
decoded bytes of the token place its end.  Ends common to both cut a text into groups;
a link is a pair of tokens whose byte ranges overlap.

Neither tokenizer joins across a single space between two other signs, so a text is
the concatenation of its chunks: workers align the chunks that they do not know yet all
at once, in arrays, and remember them; a document adds up its chunks.  This is checked
for the model (``splits``); a model with pieces across such a space is aligned text by
text.

Texts are read and aligned once.  That pass writes each document's numbers and the ids
of its links, and how often the task linked each id pair; Spark sums these.  The
``TABLE`` most frequent pairs become a broadcast table of fixed size, which rates the
written links.  Links of rarer pairs, if there are any, leave the documents as (row,
pair, number) and are joined with all counts; as no such pair is more frequent than those
of the table, none is a hot key.

Defined cases: null and empty texts, and texts whose bytes a tokenizer changes (such as
a literal U+2581), have no tokens: zeros, and '' in place of a hash.  Special strings in
a text are plain text.  Repeated rows and rows with null or equal ids count once each.
Ties for the highest count are all best.  Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from .staging import slices, small_batches, staged
from .tokens import byte_alphabet

#: Pairs of the broadcast table (17 bytes each), chunks that one worker remembers, and characters of the longest one.
TABLE = 1 << 19
CHUNKS, LONGEST = 400_000, 64
#: Bytes of text that are aligned at once, and links that one worker remembers.
SLICE_BYTES, LINKS = 2 << 20, 8_000_000
#: New chunks that are encoded as one text.
JOINED = 512

_MARK = "▁"
_CUT = re.compile(r"(?<=\S) (?=\S)")
_RUN = re.compile(r"\s\s|^\s|\s$")
_ALONE = re.compile(rf"^\s|\s$|[{_MARK}\x00-\x08\x0e-\x1f]")
_BYTE_PIECE = re.compile("<0x([0-9A-Fa-f]{2})>")


class Vocabulary:
    """The bytes of the tokens of a vocabulary, one after the other."""

    def __init__(self, tokens: list[bytes]) -> None:
        self.length = np.array([len(t) for t in tokens], np.int64)
        self.start = np.cumsum(self.length) - self.length
        self.data = np.frombuffer(b"".join(tokens), np.uint8)

    def joined(self, ids: np.ndarray) -> np.ndarray:
        """The bytes of tokens in a row."""
        return self.data[ranges(self.start[ids], self.length[ids])]


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The integers of all ranges, one range after the other."""
    return np.repeat(starts - (np.cumsum(lengths) - lengths), lengths) + np.arange(lengths.sum())


@lru_cache(2)
def _libraries(a_path: str, b_path: str) -> tuple:
    """(tokenizer A, bytes of its ids, model B, bytes of its ids, whether texts may be cut at spaces)."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(a_path)
    a.encode_special_tokens = True
    code = {c: b for b, c in byte_alphabet().items()}
    a_bytes = {i: bytes(code[c] for c in t) if all(c in code for c in t) else t.encode() for t, i in a.get_vocab().items()}
    b = sentencepiece.SentencePieceProcessor(model_file=b_path)
    pieces = [b.id_to_piece(i) for i in range(b.get_piece_size())]
    b_bytes = [bytes([int(m[1], 16)]) if (m := _BYTE_PIECE.fullmatch(p)) else p.replace(_MARK, " ").encode() for p in pieces]
    splits = not any(re.search(f"[^{_MARK}]{_MARK}", p) for p in pieces) and b.encode("a b") == [*b.encode("a"), *b.encode("b")]
    return a, Vocabulary([a_bytes.get(i, b"") for i in range(max(a_bytes) + 1)]), b, Vocabulary(b_bytes), splits


def ends(spans: np.ndarray, lengths: np.ndarray, first: np.ndarray, base: np.ndarray) -> np.ndarray:
    """Byte end of each token.

    A token whose span (``spans``, two columns) has as many bytes as the token ends with
    it; after the last such token of the text, or the text's first byte (``base``, for each
    token; ``first`` is the text's first token), decoded bytes are counted.
    """
    at = np.arange(len(lengths))
    told = np.maximum.accumulate(np.where(spans[:, 1] - spans[:, 0] == lengths, at, -1)) if len(at) else at
    so_far = np.cumsum(lengths)
    inside = told >= first
    told = np.where(inside, told, 0)
    before = so_far[first] - lengths[first] if len(at) else so_far
    return np.where(inside, spans[told, 1] + so_far - so_far[told], base + so_far - before)


def _lists(values: pa.Array, counts: np.ndarray, separator: str) -> pa.Array:
    """Strings of a column joined in runs of ``counts``."""
    offsets = pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32))
    return pc.binary_join(pa.ListArray.from_arrays(offsets, values.cast(pa.string())), separator)


class _Column:
    """An array that grows."""

    def __init__(self, kind: type) -> None:
        self.values, self.size = np.zeros(1024, kind), 0

    def extend(self, more: np.ndarray) -> None:
        need = self.size + len(more)
        if need > len(self.values):
            self.values = np.concatenate([self.values[: self.size], np.zeros(max(need, 2 * self.size) - self.size, self.values.dtype)])
        self.values[self.size : need] = more
        self.size = need


class Aligner:
    """What a worker knows about chunks, by place: tokens, groups and links, the groups as text, the linked ids."""

    def __init__(self, a_path: str, b_path: str) -> None:
        self.a, self.a_tokens, self.b, self.b_tokens, self.splits = _libraries(a_path, b_path)
        #: The type of ids in written links.
        self.kind = "<u2" if max(len(self.a_tokens.length), len(self.b_tokens.length)) <= 1 << 16 else "<u4"
        self.forget()

    def forget(self) -> None:
        self.places: dict[str, int] = {}
        #: Numbers of A's and B's tokens and groups, whether the bytes agree, number and first of the links.
        self.n_a, self.n_b, self.n_groups, self.n_links, self.first = (_Column(np.int64) for _ in range(5))
        self.right = _Column(bool)
        self.link_a, self.link_b = _Column(np.int64), _Column(np.int64)
        self.texts: list[str] = []

    def full(self) -> bool:
        return len(self.texts) >= CHUNKS or self.link_a.size >= LINKS

    def chunks(self, text: str) -> list[str]:
        """Chunks without the space before each; the first one's is the space before the text."""
        if not self.splits:
            return [text]
        return _CUT.split(text) if _RUN.search(text) else text.split(" ")

    def learn(self, new: list[str]) -> dict[str, int]:
        """Places of new chunks, aligned all in one; those that begin and end with a sign are joined to longer texts before."""
        plain, units = [], []
        for c in new:
            if self.splits and c and not _ALONE.search(c):
                plain.append(c)
            else:
                units.append([c])
        units += [plain[i : i + JOINED] for i in range(0, len(plain), JOINED)]
        own: dict[str, int] = {}
        again = self._learn(units, own)
        if again:
            self._learn([[c] for c in again], own)
        self.places.update((c, p) for c, p in own.items() if len(c) <= LONGEST)
        return own

    def _learn(self, units: list[list[str]], own: dict[str, int]) -> list[str]:
        """Align the chunks of texts; the chunks of joined texts whose bytes a tokenizer changed are given back."""
        chunks = list(chain.from_iterable(units))
        in_unit = np.array([len(u) for u in units])
        plain = [" ".join(u) for u in units]
        spaced = [" " + t for t in plain]
        data = np.frombuffer("".join(spaced).encode(), np.uint8)
        chars = np.append(np.flatnonzero((data & 0xC0) != 0x80), len(data))
        n_chars = np.array([len(t) for t in spaced])
        first_char = np.cumsum(n_chars) - n_chars
        start = chars[first_char]
        size = np.append(start[1:], len(data)) - start

        encodings = self.a.encode_batch(spaced, add_special_tokens=False)
        a_ids = np.fromiter(chain.from_iterable([e.ids for e in encodings]), np.int64)
        n_a = np.array([len(e) for e in encodings])
        a_spans = np.array(list(chain.from_iterable([e.offsets for e in encodings])), np.int64).reshape(-1, 2)
        a_spans = chars[np.repeat(first_char, n_a)[:, None] + a_spans]

        protos = [p.pieces for p in self.b.encode(plain, return_type="proto", num_threads=1)]
        n_b = np.array([len(p) for p in protos])
        found = np.array([(p.id, p.begin, p.end) for pieces in protos for p in pieces], np.int64).reshape(-1, 3)
        b_ids = found[:, 0]
        # The model counts from the text's first byte, and the first piece also holds the space before it.
        opening = np.zeros(len(b_ids), bool)
        opening[(np.cumsum(n_b) - n_b)[n_b > 0]] = True
        b_spans = np.repeat(start, n_b)[:, None] + np.stack([found[:, 1] + ~opening, found[:, 2] + 1], 1)

        right = np.ones(len(units), bool)
        sides = []
        for tokens, ids, n, spans in ((self.a_tokens, a_ids, n_a, a_spans), (self.b_tokens, b_ids, n_b, b_spans)):
            owner = np.repeat(np.arange(len(units)), n)
            lengths = tokens.length[ids]
            whole = np.bincount(owner, lengths, len(units)).astype(np.int64)
            right &= whole == size
            # Bytes of texts of another length are compared with some other bytes; they are wrong already.
            place = np.minimum(ranges(start, whole), len(data) - 1)
            wrong = np.repeat(owner, lengths)[tokens.joined(ids) != data[place]]
            right[wrong] = False
            first = np.repeat(np.cumsum(n) - n, n)
            sides.append((ids, owner, ends(spans, lengths, first, start[owner])))
        again = [c for u, ok in zip(units, right.tolist(), strict=True) if not ok and len(u) > 1 for c in u]
        kept = np.repeat(right | (in_unit == 1), in_unit)
        right_chunk = np.repeat(right, in_unit)[kept]
        # Ends of all chunks; of a token's end, the chunk that it lies in.
        stops = np.cumsum(np.array([len(c.encode()) + 1 for c in chunks]))[kept]
        chunks = [c for c, k in zip(chunks, kept.tolist(), strict=True) if k]
        (a_ids, a_end), (b_ids, b_end) = [(i[right[o]], e[right[o]]) for i, o, e in sides]
        common = np.intersect1d(a_end, b_end, assume_unique=True)
        groups = [
            _lists(pa.array(ids), np.bincount(np.searchsorted(common, end), minlength=len(common)), ",") for ids, end in ((a_ids, a_end), (b_ids, b_end))
        ]
        # Between two neighbouring ends lies one token of each side: a link.
        cuts = np.union1d(a_end, b_end)
        link_a, link_b = np.searchsorted(a_end, cuts), np.searchsorted(b_end, cuts)
        n_a, n_b, n_groups, n_links = (np.bincount(np.searchsorted(stops, end), minlength=len(stops)) for end in (a_end, b_end, common, cuts))
        texts = _lists(pc.binary_join_element_wise(*groups, "|"), n_groups, ";")

        own.update(zip(chunks, range(len(self.texts), len(self.texts) + len(chunks)), strict=True))
        self.first.extend(self.link_a.size + np.cumsum(n_links) - n_links)
        for column, values in (
            (self.n_a, n_a), (self.n_b, n_b), (self.n_groups, n_groups), (self.n_links, n_links), (self.right, right_chunk), (self.link_a, a_ids[link_a]), (self.link_b, b_ids[link_b]),
        ):
            column.extend(values)
        self.texts.extend(texts.to_pylist())
        return again

    def place(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """(places of the chunks of all texts, number of chunks of each); long chunks get a place, but are not found again."""
        parts = [self.chunks(t) if t else [] for t in texts]
        get = self.places.get
        found = [get(c, -1) for c in chain.from_iterable(parts)]
        missing = [i for i, p in enumerate(found) if p < 0]
        if missing:
            flat = list(chain.from_iterable(parts))
            own = self.learn(list(dict.fromkeys([flat[i] for i in missing])))
            for i in missing:
                found[i] = own[flat[i]]
        return np.array(found, np.int64), np.array([len(p) for p in parts], np.int64)

    def links(self, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of A, ids of B) of the links of chunks in a row."""
        at = ranges(self.first.values[places], self.n_links.values[places])
        return self.link_a.values[at], self.link_b.values[at]


@lru_cache(1)
def _known(a_path: str, b_path: str) -> Aligner:
    """The aligner of a worker, which outlives its tasks."""
    return Aligner(a_path, b_path)


_NUMBERS = ["n_a", "n_b", "n_groups", "n_links"]
_WRITTEN = ["_row", "_id", *_NUMBERS, "groups_sha256", "links", "pair", "n"]


def _summed(pairs: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(pairs, kind="stable")
    pairs, n = pairs[order], n[order]
    first = np.flatnonzero(np.concatenate([[True], pairs[1:] != pairs[:-1]])) if len(pairs) else np.empty(0, np.int64)
    return pairs[first], np.add.reduceat(n, first) if len(first) else np.empty(0, np.int64)


def _aligned(aligner: Aligner, batches: Iterable[pa.RecordBatch], kind: pa.DataType) -> Iterator[pa.RecordBatch]:
    """A row for each text, and rows (pair, n) of the id pairs that the task linked."""
    context = TaskContext.get()
    row = (context.partitionId() if context else 0) << 40
    uses = _Column(np.int64)

    def record(rows: int, *columns: pa.Array | None) -> pa.RecordBatch:
        kinds = [pa.int64(), kind, *[pa.int64()] * 4, pa.string(), pa.binary(), pa.int64(), pa.int64()]
        return pa.RecordBatch.from_arrays([pa.nulls(rows, k) if c is None else c for c, k in zip(columns, kinds, strict=True)], _WRITTEN)

    def pairs() -> Iterator[pa.RecordBatch]:
        used = np.flatnonzero(uses.values[: uses.size])
        a, b = aligner.links(used)
        pair, n = _summed((a << 32) | b, np.repeat(uses.values[used], aligner.n_links.values[used]))
        for start in range(0, len(pair), 1 << 16):
            part = [pa.array(x[start : start + (1 << 16)]) for x in (pair, n)]
            yield record(len(part[0]), *[None] * 8, *part)

    for batch in batches:
        for part in slices(batch, "text", SLICE_BYTES):
            if aligner.full():
                yield from pairs()
                aligner.forget()
                uses = _Column(np.int64)
            texts = part.column("text").to_pylist()
            places, n = aligner.place(texts)
            uses.extend(np.zeros(len(aligner.texts) - uses.size, np.int64))
            owner = np.repeat(np.arange(len(texts)), n)
            good = np.ones(len(texts), bool)
            good[owner[~aligner.right.values[places]]] = False
            good &= n > 0
            kept = good[owner]
            places, owner, n = places[kept], owner[kept], np.where(good, n, 0)
            np.add.at(uses.values, places, 1)
            totals = [pa.array(np.bincount(owner, c.values[places], len(texts)).astype(np.int64)) for c in (aligner.n_a, aligner.n_b, aligner.n_groups, aligner.n_links)]
            held, hashes = aligner.texts, []
            for stop, size in zip(np.cumsum(n).tolist(), n.tolist(), strict=True):
                # A chunk's end is an end of both sides.
                own = ";".join([held[p] for p in places[stop - size : stop].tolist()])
                hashes.append(hashlib.sha256(own.encode()).hexdigest() if size else "")
            ids = np.stack(aligner.links(places), 1).astype(aligner.kind)
            offsets = np.concatenate([[0], np.cumsum(totals[3].to_numpy())]) * (2 * ids.itemsize)
            links = pa.Array.from_buffers(pa.large_binary(), len(texts), [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(ids.tobytes())]).cast(pa.binary())
            yield record(len(texts), pa.array(np.arange(row, row + len(texts))), part.column("_id"), *totals, pa.array(hashes, pa.string()), links, None, None)
            row += len(texts)
    yield from pairs()


def _rated(batches: Iterable[pa.RecordBatch], kind: str, pairs: np.ndarray, counts: np.ndarray, best: np.ndarray) -> Iterator[pa.RecordBatch]:
    """(_row, n_best, count_sum, rare) of written links: sums over the table, and the pairs that it lacks."""
    for batch in batches:
        for part in slices(batch, "links"):
            column = part.column("links")
            n = pc.binary_length(column).to_numpy() // (2 * np.dtype(kind).itemsize)
            ids = np.frombuffer(b"".join(column.to_pylist()), kind).reshape(-1, 2).astype(np.int64)
            pair, owner = (ids[:, 0] << 32) | ids[:, 1], np.repeat(np.arange(len(n)), n)
            at = np.minimum(np.searchsorted(pairs, pair), max(len(pairs) - 1, 0))
            known = pairs[at] == pair if len(pairs) else np.zeros(len(pair), bool)
            sums = [np.zeros(len(n), np.int64), np.zeros(len(n), np.int64)]
            for total, values in zip(sums, (best, counts), strict=True):
                np.add.at(total, owner[known], values[at[known]].astype(np.int64))
            rare: list[list[dict] | None] = [None] * len(n)
            lacking = pair[~known]
            if len(lacking):
                who = owner[~known]
                first = np.flatnonzero(np.diff(who, prepend=-1))
                for i, own in zip(who[first].tolist(), np.split(lacking, first[1:]), strict=True):
                    own, times = np.unique(own, return_counts=True)
                    rare[i] = [{"pair": p, "times": c} for p, c in zip(own.tolist(), times.tolist(), strict=True)]
            kind_rare = pa.list_(pa.struct([("pair", pa.int64()), ("times", pa.int64())]))
            yield pa.RecordBatch.from_arrays(
                [*(part.column(c) for c in ("_row", "_id", *_NUMBERS)), *map(pa.array, sums), part.column("groups_sha256"), pa.array(rare, kind_rare)],
                ["_row", "_id", *_NUMBERS, "n_best", "count_sum", "groups_sha256", "rare"],
            )


def written(docs: DataFrame, a_path: str, b_path: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The table of the one pass over the texts: a row for each document with its links, and rows (pair, n)."""
    small_batches(docs.sparkSession)
    rows = docs.select(F.col(id_column).alias("_id"), F.col(text_column).cast("string").alias("text"))
    numbers = ", ".join(f"{c} long" for c in _NUMBERS)
    schema = f"_row long, _id {rows.schema['_id'].dataType.simpleString()}, {numbers}, groups_sha256 string, links binary, pair long, n long"
    kind = to_arrow_type(rows.schema["_id"].dataType)
    return staged(rows.mapInArrow(lambda batches: _aligned(_known(a_path, b_path), batches, kind), schema), "aligned")


def pair_counts(written: DataFrame) -> DataFrame:
    """(pair, n, best) of every linked id pair: ``pair`` is A's id times 2^32 plus B's, ``best`` whether n is its B id's highest."""
    counts = staged(written.where("pair IS NOT NULL").groupBy("pair").agg(F.sum("n").alias("n")), "pairs")
    b = F.col("pair").bitwiseAND(F.lit((1 << 32) - 1))
    # At most one row per id of B's vocabulary.
    highest = counts.groupBy(b.alias("b")).agg(F.max("n").alias("most"))
    return counts.join(F.broadcast(highest), b == F.col("b")).select("pair", "n", (F.col("n") == F.col("most")).alias("best"))


def alignments(docs: DataFrame, a_path: str, b_path: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) of every row of ``docs``."""
    spark = docs.sparkSession
    rows = written(docs, a_path, b_path, id_column, text_column)
    counts = staged(pair_counts(rows), "pair_counts")
    table = counts.orderBy(F.desc("n"), "pair").limit(TABLE).toArrow().sort_by("pair")
    shared = spark.sparkContext.broadcast(tuple(table.column(c).to_numpy() for c in ("pair", "n", "best")))
    link_kind = _known(a_path, b_path).kind
    numbers = ", ".join(f"{c} long" for c in _NUMBERS)
    schema = f"_row long, _id {rows.schema['_id'].dataType.simpleString()}, {numbers}, n_best long, count_sum long, groups_sha256 string, rare array<struct<pair: long, times: long>>"
    rated = rows.where("_row IS NOT NULL").select("_row", "_id", *_NUMBERS, "groups_sha256", "links").mapInArrow(lambda batches: _rated(batches, link_kind, *shared.value), schema)
    if table.num_rows < TABLE:
        # The table holds every pair.
        return rated.select(F.col("_id").alias(id_column), *_NUMBERS, "n_best", "count_sum", "groups_sha256")
    rated = staged(rated, "rated")
    lacking = rated.select("_row", F.explode("rare").alias("r")).select("_row", "r.pair", "r.times")
    sums = lacking.join(counts, "pair").groupBy("_row").agg(
        F.sum(F.col("times") * F.col("best").cast("long")).alias("_best"), F.sum(F.col("times") * F.col("n")).alias("_sum")
    )
    return rated.join(sums, "_row", "left").select(
        F.col("_id").alias(id_column), *_NUMBERS, (F.col("n_best") + F.coalesce("_best", F.lit(0))).alias("n_best"),
        (F.col("count_sum") + F.coalesce("_sum", F.lit(0))).alias("count_sum"), "groups_sha256",
    )
