"""SentencePiece encoding and decoding with the tokenizers library.

The model file is parsed here (its protobuf wire format), and a tokenizer is rebuilt
from it: normaliser, white-space marker, dummy prefix, BPE merges ranked by piece
score or unigram scores, and byte fallback.  Batches are encoded multithreaded.

Where no piece crosses from text into a marker, a text is the concatenation of its
space-led chunks, so workers remember chunks; new ones are encoded in one batch.
The ids are those of the rebuilt tokenizer.  Each new chunk is also encoded by the
sentencepiece library and decoded again: parity and the round trip are checked for
everything that occurs, and chunks for which the two libraries differ are counted.

Defined cases: a null text has null ids (``encoded``) and counts as empty in
``measured``; an empty text has no ids.  Characters outside the vocabulary become
bytes.  Repeated rows and null or equal ids give one row each.  Other columns are
ignored.  Models of unused or user-defined pieces are refused.
"""

from __future__ import annotations

import os
import re
import struct
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .staging import map_texts

MARK = "▁"
#: Chunks that one worker remembers, and threads that encode a batch of new ones.
CHUNKS, THREADS = 400_000, 2

#: Fixed values of the file format: piece types and model types.
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
UNIGRAM, BPE = 1, 2


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(number, value) of a protobuf message: integers of varints, raw bytes of everything else."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(data):
        key = varint()
        kind = key & 7
        if kind == 0:
            yield key >> 3, varint()
        elif kind in (1, 2, 5):
            size = 8 if kind == 1 else 4 if kind == 5 else varint()
            yield key >> 3, data[at : at + size]
            at += size
        else:
            raise ValueError(f"wire type {kind}")


@dataclass
class Spec:
    """What a model file says."""

    pieces: list[tuple[str, float, int]] = field(default_factory=list)
    model_type: int = UNIGRAM
    byte_fallback: bool = False
    charsmap: bytes = b""
    dummy_prefix: bool = True
    remove_spaces: bool = True
    escape_spaces: bool = True
    suffix_marks: bool = False


def parsed(data: bytes) -> Spec:
    spec = Spec()
    for number, value in _fields(data):
        if number == 1:
            piece, score, kind = "", 0.0, NORMAL
            for n, v in _fields(value):
                if n == 1:
                    piece = v.decode()
                elif n == 2:
                    (score,) = struct.unpack("<f", v)
                elif n == 3:
                    kind = v
            spec.pieces.append((piece, score, kind))
        elif number == 2:
            own = dict(_fields(value))
            spec.model_type = own.get(3, UNIGRAM)
            spec.byte_fallback, spec.suffix_marks = bool(own.get(35, 0)), bool(own.get(24, 0))
        elif number == 3:
            own = dict(_fields(value))
            spec.charsmap = own.get(2, b"")
            spec.dummy_prefix, spec.remove_spaces, spec.escape_spaces = (bool(own.get(n, 1)) for n in (3, 4, 5))
    return spec


def rebuilt(spec: Spec):
    """A tokenizer of the tokenizers library with the same ids."""
    from tokenizers import Regex, Tokenizer, decoders, models, normalizers

    kinds = {kind for _, _, kind in spec.pieces}
    if kinds & {USER_DEFINED, UNUSED} or spec.suffix_marks or not spec.escape_spaces:
        raise ValueError("models with user-defined or unused pieces, suffix marks or plain spaces are not supported")
    unknown = next((i for i, p in enumerate(spec.pieces) if p[2] == UNKNOWN), None)
    if spec.model_type == BPE:
        vocab = {piece: i for i, (piece, _, _) in enumerate(spec.pieces)}
        plain = {piece: (score, i) for i, (piece, score, kind) in enumerate(spec.pieces) if kind == NORMAL}
        # Every way to make a piece from two others, best scores first.
        merges = [
            (-score, i, len(piece[:cut]), piece[:cut], piece[cut:])
            for piece, (score, i) in plain.items() for cut in range(1, len(piece)) if piece[:cut] in plain and piece[cut:] in plain
        ]
        model = models.BPE(
            vocab, [(a, b) for _, _, _, a, b in sorted(merges)], unk_token=spec.pieces[unknown][0], fuse_unk=True, byte_fallback=spec.byte_fallback
        )
    elif spec.model_type == UNIGRAM:
        model = models.Unigram([(p, s) for p, s, _ in spec.pieces], unknown, spec.byte_fallback)
    else:
        raise ValueError(f"model type {spec.model_type}")
    tokenizer = Tokenizer(model)
    steps = [normalizers.Precompiled(spec.charsmap)] if spec.charsmap else []
    if spec.remove_spaces:
        steps += [normalizers.Strip(), normalizers.Replace(Regex(" {2,}"), " ")]
    steps += [normalizers.Prepend(MARK)] * spec.dummy_prefix + [normalizers.Replace(" ", MARK)]
    tokenizer.normalizer = normalizers.Sequence(steps)
    ends = [decoders.Strip(" ", 1, 0)] if spec.dummy_prefix else []
    tokenizer.decoder = decoders.Sequence([decoders.Replace(MARK, " "), decoders.ByteFallback(), decoders.Fuse(), *ends])
    return tokenizer


def splits_at_spaces(spec: Spec) -> bool:
    """Whether texts are the concatenation of their space-led chunks."""
    crossing = any(re.search(f"[^{MARK}]{MARK}", piece) for piece, _, kind in spec.pieces if kind == NORMAL)
    return spec.dummy_prefix and not spec.remove_spaces and not spec.charsmap and not crossing


@lru_cache(2)
def _worker(data: bytes, threads: int) -> tuple:
    os.environ["TOKENIZERS_PARALLELISM"] = "true" if threads > 1 else "false"
    os.environ.setdefault("RAYON_NUM_THREADS", str(threads))
    import sentencepiece

    spec = parsed(data)
    return spec, rebuilt(spec), sentencepiece.SentencePieceProcessor(model_proto=data)


class Encoder:
    """Encodes texts of one worker; ``differing`` and ``lossy`` are the chunks that broke parity or the round trip."""

    def __init__(self, data: bytes, threads: int = THREADS) -> None:
        self.spec, self.tokenizer, self.library = _worker(data, threads)
        self.chunked = splits_at_spaces(self.spec)
        self.known: dict[str, bytes] = {}
        self.differing: set[str] = set()
        self.lossy: set[str] = set()

    def chunks(self, text: str) -> list[str]:
        """Chunks without the first space of each, which the dummy prefix stands for."""
        if not text:
            return []
        if not self.chunked or MARK in text:
            return [text]
        parts = text.split(" ")
        if "" not in parts:
            return parts
        # Closing spaces stay with the last chunk: an empty chunk could not be encoded by itself.
        return [c[1:] for c in re.findall(" +[^ ]+(?: +$)?| +$", " " + text)]

    def learn(self, new: list[str]) -> None:
        """Encode chunks that are not known yet in one batch, and check them."""
        if len(self.known) + len(new) > CHUNKS:
            self.known.clear()
            self.differing.clear()
            self.lossy.clear()
        ours = [e.ids for e in self.tokenizer.encode_batch(new, add_special_tokens=False)]
        theirs = self.library.encode(new, num_threads=1)
        back = self.tokenizer.decode_batch(ours, skip_special_tokens=False)
        for chunk, a, b, text in zip(new, ours, theirs, back, strict=True):
            if a != b:
                self.differing.add(chunk)
            if text != chunk:
                self.lossy.add(chunk)
            self.known[chunk] = np.array(a, "<u4").tobytes()

    def encode(self, texts: list[str | None]) -> list[tuple[bytes, int, bool]]:
        """(ids, chunks that differ between the libraries, whether decoding gives the text back) of each text."""
        cut = [self.chunks(t or "") for t in texts]
        out = []
        for start in range(0, len(cut), 64):
            part = cut[start : start + 64]
            # A chunk that is not kept would be encoded again; pieces of the batch are small enough for the memo.
            new = list(dict.fromkeys(c for chunks in part for c in chunks if c not in self.known))
            if len(self.known) + len(new) > CHUNKS:
                new = list(dict.fromkeys(c for chunks in part for c in chunks))
            if new:
                self.learn(new)
            ids = self.known.__getitem__
            for chunks in part:
                wrong = sum(c in self.differing for c in chunks) if self.differing else 0
                lossy = bool(self.lossy) and any(c in self.lossy for c in chunks)
                out.append((b"".join(map(ids, chunks)), wrong, not lossy))
        return out


def _rows(docs: DataFrame, id_column: str, text_column: str) -> tuple[DataFrame, str]:
    rows = docs.select(F.col(id_column).alias("_id"), F.col(text_column).cast("string").alias("text"))
    return rows, rows.schema["_id"].dataType.simpleString()


def _shared(docs: DataFrame, model_path: str):
    """The model file, broadcast: its size is that of a vocabulary."""
    with open(model_path, "rb") as f:
        return docs.sparkSession.sparkContext.broadcast(f.read())


def encoded(docs: DataFrame, model_path: str, id_column: str = "doc_id", text_column: str = "text", threads: int = THREADS) -> DataFrame:
    """(id, ids array<int>) of every row."""
    rows, kind = _rows(docs, id_column, text_column)
    shared = _shared(docs, model_path)

    def make() -> Callable[[pa.RecordBatch], pa.RecordBatch]:
        encoder = Encoder(shared.value, threads)

        def apply(batch: pa.RecordBatch) -> pa.RecordBatch:
            texts = batch.column("text").to_pylist()
            ids = [None if t is None else np.frombuffer(b, "<u4") for t, (b, _, _) in zip(texts, encoder.encode(texts), strict=True)]
            return pa.RecordBatch.from_arrays([batch.column("_id"), pa.array(ids, pa.list_(pa.int32()))], ["_id", "ids"])

        return apply

    return map_texts(rows, make, f"_id {kind}, ids array<int>").withColumnRenamed("_id", id_column)


def decoded(tokens: DataFrame, model_path: str, id_column: str = "doc_id", ids_column: str = "ids", threads: int = THREADS) -> DataFrame:
    """(id, text) of every row of ids; null ids give a null text."""
    rows = tokens.select(F.col(id_column).alias("_id"), F.col(ids_column).cast("array<int>").alias("ids"))
    shared = _shared(tokens, model_path)
    kind = rows.schema["_id"].dataType.simpleString()

    def run(batches):
        _, tokenizer, _ = _worker(shared.value, threads)
        for batch in batches:
            ids = batch.column("ids").to_pylist()
            texts = tokenizer.decode_batch([x or [] for x in ids], skip_special_tokens=False)
            texts = [None if x is None else t for x, t in zip(ids, texts, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("_id"), pa.array(texts, pa.string())], ["_id", "text"])

    return rows.mapInArrow(run, f"_id {kind}, text string").withColumnRenamed("_id", id_column)


def measured(docs: DataFrame, model_path: str, id_column: str = "doc_id", text_column: str = "text", threads: int = THREADS) -> DataFrame:
    """(id, n_ids, ids_crc32, n_differing, round_trip) of every row: checksum of the little-endian 32-bit ids, parity and round trip."""
    rows, kind = _rows(docs, id_column, text_column)
    shared = _shared(docs, model_path)

    def make() -> Callable[[pa.RecordBatch], pa.RecordBatch]:
        encoder = Encoder(shared.value, threads)

        def apply(batch: pa.RecordBatch) -> pa.RecordBatch:
            found = encoder.encode(batch.column("text").to_pylist())
            return pa.RecordBatch.from_arrays(
                [
                    batch.column("_id"), pa.array([len(b) // 4 for b, _, _ in found], pa.int64()), pa.array([zlib.crc32(b) for b, _, _ in found], pa.int64()),
                    pa.array([w for _, w, _ in found], pa.int64()), pa.array([ok for _, _, ok in found]),
                ],
                ["_id", "n_ids", "ids_crc32", "n_differing", "round_trip"],
            )

        return apply

    return map_texts(rows, make, f"_id {kind}, n_ids long, ids_crc32 long, n_differing long, round_trip boolean").withColumnRenamed("_id", id_column)
