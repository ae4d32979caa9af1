"""Personal data by fixed patterns and a linear-chain conditional random field.

The base patterns find e-mail addresses, IPv4 addresses, payment cards and
international phone numbers.  The field adds what they miss (spelled-out
addresses, national phone numbers, dotted card numbers): white-space separated words
carry shape features, the field is trained from a small labelled table, and Viterbi
decodes all lines of a batch in numpy.  A decoded span counts when it
holds the digits or marks of its kind and touches no base span; base spans always stay.

Texts stay in the task that reads them; nothing is shuffled.

Defined cases: a null or empty text has no spans (an empty string, and the digest of
the empty string).  Offsets are code points, ends exclusive.  Repeated rows and null or
equal ids give one row each.  Other columns are kept by ``redacted`` and ignored by
``find``.
"""

from __future__ import annotations

import hashlib
import random
import re
from bisect import bisect_left
from collections.abc import Callable
from functools import lru_cache
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import crf
from .shingles import _bytes_of
from .staging import map_texts

#: Fixed values of the contract: kinds in order, and the base patterns.
KINDS = ("email", "ip", "card", "phone")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A failing digit run fails from each of its digits, so runs are tried from their start only.
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile("[0-9]")

Span = tuple[int, int, int]  # start, kind, end


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def _emails(text: str) -> list[tuple[int, int]]:
    """Leftmost non-overlapping matches, found from each at sign: the local part is the run before it."""
    out, free, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            out.append((start, m.end()))
            free = m.end()
        at = text.find("@", max(at + 1, free))
    return out


def base_spans(text: str) -> list[Span]:
    found: list[Span] = [(a, 0, b) for a, b in _emails(text)] if "@" in text else []
    if _DIGIT.search(text):
        if "." in text:
            found += [(m.start(), 1, m.end()) for m in _IP.finditer(text) if all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in m[0].split("."))]
        for m in _CARD.finditer(text):
            if m.end() - m.start() >= 12:
                digits = _digits(m[0])
                if 12 <= len(digits) <= 19 and luhn(digits):
                    found.append((m.start(), 2, m.end()))
        if "+" in text:
            found += [(m.start(), 3, m.end()) for m in _PHONE.finditer(text) if 9 <= len(_digits(m[0])) <= 15]
    return sorted(found)


# ---- the labelled table ----------------------------------------------------------------------------------------

#: Labelled sentences: a slot in braces stands for a value of that kind, everything else is no personal data.
TEMPLATES = (
    "you can write to {email} for more", "mail {email} or call {phone} today", "his address is {email}.", "contact: {email}",
    "call me at {phone} after five", "phone {phone}, ask for the manager", "tel {phone} or fax {phone}", "my number is {phone}.",
    "paid with card {card} last week", "the card number is {card}, valid until {date}", "charge {card} please", "visa {card} was declined",
    "the server {ip} answered", "login from {ip} at {time}", "host {ip} is down.", "ping {ip} first",
    "it happened in {year} and again in {year}", "on {date} at {time} the door was closed", "the price is {price} or {price}",
    "version {version} replaced version {version}", "order {number} was shipped on {date}", "page {small} of {small}",
    "password={hex} and nothing else", 'token = "{hex}" was found', "chapter {small}, section {version}", "about {number} people came",
    "a plain sentence with no numbers at all", "another one, with commas, dots and words.", "THE END OF ALL WORDS!!", "word one | word two | word three",
    "look at me and look at them", "meet at noon or at the dot of one", "the serial is {long} on the back", "isbn {isbn} in print",
)
FILLER = "the of and to in un le der die que con para est les und mit thing reall enton oreth ubleh stion".split()
#: Rows of the table that are made from the templates.
TABLE_ROWS = 900


def _value(kind: str, rng: random.Random) -> str:
    def d(n: int) -> str:
        return "".join(rng.choice("0123456789") for _ in range(n))

    name = "".join(rng.choice("abcdefghiklmnoprstuvw") for _ in range(rng.randint(3, 9)))
    host = rng.choice(["mail", "example", "post", "inbox", name]) + rng.choice(["", "2", "-x"])
    end = rng.choice(["com", "org", "net", "de", "co.uk"])
    if kind == "email":
        at, dot = rng.choice([(" at ", " dot "), (" [at] ", " [dot] "), ("(at)", "(dot)"), (" AT ", " DOT "), ("@", ".")])
        return f"{name}{rng.choice(['', '.' + name[:3], d(2)])}{at}{host}{end.replace('co.uk', 'org').join([dot, ''])}"
    if kind == "phone":
        form = rng.choice(["({}) {}-{}", "{}-{}-{}", "{}.{}.{}", "{} {} {}", "+1 ({}) {}-{}"])
        return form.format(d(3), d(3), d(4))
    if kind == "card":
        return rng.choice([".", "/", "_", " ", "-"]).join(d(4) for _ in range(4))
    if kind == "ip":
        return rng.choice([".", " . ", "[.]"]).join(str(rng.randint(1, 255)) for _ in range(4))
    return {
        "year": str(rng.randint(1900, 2030)), "date": rng.choice([f"20{d(2)}-0{rng.randint(1, 9)}-1{d(1)}", f"1{d(1)}/0{rng.randint(1, 9)}/20{d(2)}"]),
        "time": f"1{d(1)}:{rng.randint(10, 59)}", "price": rng.choice([f"${d(2)}.{d(2)}", f"{d(3)},{d(2)}", f"{d(1)}.{d(3)}.{d(3)}"]),
        "version": f"{d(1)}.{d(1)}.{d(1)}", "number": d(rng.randint(3, 9)), "small": d(2), "long": d(rng.randint(10, 22)),
        "isbn": f"978-{d(1)}-{d(4)}-{d(4)}-{d(1)}", "hex": "".join(rng.choice("0123456789abcdef") for _ in range(rng.choice([18, 32, 40]))),
    }[kind]


@lru_cache(1)
def labelled_table() -> list[tuple[str, list[Span]]]:
    """(sentence, spans): the templates filled with made-up values, always the same."""
    rng, rows = random.Random(11), []
    for i in range(TABLE_ROWS):
        text, spans = " ".join(rng.choice(FILLER) for _ in range(rng.randint(0, 6))), []
        for part in re.split(r"(\{\w+\})", TEMPLATES[i % len(TEMPLATES)]):
            if part.startswith("{"):
                value = _value(part[1:-1], rng)
                if part[1:-1] in KINDS:
                    spans.append((len(text) + (not text or text[-1] not in ' ="'), KINDS.index(part[1:-1]), 0))
                lead = "" if text and text[-1] in ' ="' else " "
                text += lead + value
                if part[1:-1] in KINDS:
                    spans[-1] = (len(text) - len(value), spans[-1][1], len(text))
            else:
                text += (" " if text and not text.endswith(" ") and not part.startswith((" ", ".", ",")) and not spans else "") + part
        rows.append((text, spans))
    return rows


# ---- features --------------------------------------------------------------------------------------------------

#: Weights: hashed shapes, cue words, and combinations of both with the neighbours'.
BUCKETS = 1 << 12
CUES = (
    "at", "[at]", "dot", "[dot]", "call", "phone", "tel", "fax", "mail", "card", "visa", "number", "host", "server", "from", "ip", "contact:", "address",
)
N_FEATURES = 7
_M = np.uint64(0x9E3779B97F4A7C15)


def _hash_runs(codes: np.ndarray, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each run of codes."""
    base = np.uint64(0x5851F42D4C957F2D)
    inverse = np.uint64(pow(0x5851F42D4C957F2D, -1, 1 << 64))
    n = len(codes)
    powers, back = np.full(n + 1, base, np.uint64), np.full(n + 1, inverse, np.uint64)
    powers[0] = back[0] = 1
    np.multiply.accumulate(powers, out=powers)
    np.multiply.accumulate(back, out=back)
    sums = np.concatenate([[np.uint64(0)], np.cumsum((codes.astype(np.uint64) + np.uint64(1)) * powers[:n])])
    h = (sums[stop] - sums[start]) * back[start]
    h = (h ^ (h >> np.uint64(31))) * _M
    return h ^ (h >> np.uint64(29))


def _classes() -> np.ndarray:
    """Shape class of each byte: upper X, lower x, digit d, other letters u, every mark itself."""
    table = np.arange(256, dtype=np.uint8)
    table[65:91], table[97:123], table[48:58], table[128:] = 88, 120, 100, 117
    return table


_CLASS = _classes()


@lru_cache(1)
def _cue_hashes() -> np.ndarray:
    return np.concatenate([words(pa.array([c]))[3] for c in CUES])


def words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(start, stop, chain lengths, word hash, shape hash): byte places of all words; a chain is a line.

    A word's shape is its classes with runs shortened to three, so that lengths up to
    there and the marks between them tell words apart.
    """
    raw, ends = _bytes_of(texts)
    data = np.insert(raw, ends, 10) if len(ends) else raw
    space = (data == 32) | ((data >= 9) & (data <= 13))
    edge = np.diff((~space).astype(np.int8), prepend=0)
    start, stop = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    lines = np.flatnonzero(data == 10)
    per_line = np.diff(np.searchsorted(start, lines), prepend=0)
    lower = data + (((data >= 65) & (data <= 90)) * np.uint8(32)).astype(np.uint8)
    shape = _CLASS[data]
    # The fourth and later of equal classes in a word are left out.
    same = np.zeros(len(shape), bool)
    if len(shape) > 3:
        same[3:] = (shape[3:] == shape[2:-1]) & (shape[2:-1] == shape[1:-2]) & (shape[1:-2] == shape[:-3])
    kept = np.cumsum(~same)
    kept = np.concatenate([[0], kept])
    return start, stop, per_line, _hash_runs(lower, start, stop), _hash_runs(shape[~same], kept[start], kept[stop])


def features(word_hash: np.ndarray, shape_hash: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Feature numbers (rows x N_FEATURES) of words: own shape, cue, and both neighbours'."""
    shape = (shape_hash % np.uint64(BUCKETS - 1)).astype(np.int64) + 1
    cue = np.zeros(len(word_hash), np.int64)
    for i, h in enumerate(_cue_hashes()):
        cue[word_hash == h] = i + 1
    starts = (np.cumsum(lengths) - lengths)[lengths > 0]
    last = (np.cumsum(lengths) - 1)[lengths > 0]
    before, after, cue_before, cue_after = np.roll(shape, 1), np.roll(shape, -1), np.roll(cue, 1), np.roll(cue, -1)
    before[starts], cue_before[starts], after[last], cue_after[last] = 0, 0, 0, 0
    out = np.empty((len(shape), N_FEATURES), np.int64)
    for i, f in enumerate((shape, cue, before, after, cue_before, cue_after, (shape * 31 + before * 17 + after) % BUCKETS)):
        out[:, i] = f + i * BUCKETS
    return out


@lru_cache(1)
def model() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(weights, transitions, starts), trained from the labelled table; label 0 is no personal data."""
    table = labelled_table()
    start, stop, lengths, word_hash, shape_hash = words(pa.array([t for t, _ in table]))
    labels = np.zeros(len(start), np.int64)
    row = np.repeat(np.arange(len(lengths)), lengths)
    offset = np.cumsum([0, *[len(t.encode()) + 1 for t, _ in table]])
    for i, (_, spans) in enumerate(table):
        for a, kind, b in spans:
            inside = (row == i) & (start < offset[i] + b) & (stop > offset[i] + a)
            labels[inside] = kind + 1
    f = features(word_hash, shape_hash, lengths)
    k, n = len(KINDS) + 1, N_FEATURES * BUCKETS

    def emissions(w: np.ndarray) -> np.ndarray:
        return w.reshape(n, k)[f].sum(1)

    def gradient(d: np.ndarray) -> np.ndarray:
        return np.stack([np.bincount(f.ravel(), np.repeat(d[:, j], N_FEATURES), minlength=n) for j in range(k)], 1).ravel()

    w, trans, first = crf.train(emissions, gradient, n * k, lengths, labels, k, rounds=50)
    return w.reshape(n, k), trans, first


# ---- decoding --------------------------------------------------------------------------------------------------

_TRIM = "\"'“”‘’<>[](){},;:!?*#$%&|="
# A spelled-out address: words at and dot, bare or in brackets, between names.
_SPELLED = re.compile(
    r"[\w.%+-]+\s*(?:@|\sat\s|\[at\]|\(at\))\s*[\w-]+(?:\s*(?:\sdot\s|\[dot\]|\(dot\))\s*[\w-]+)+", re.IGNORECASE
)


def _plausible(kind: int, text: str) -> bool:
    """Whether a decoded span holds what its kind must have."""
    n = len(_digits(text))
    if kind == 0:
        return _SPELLED.fullmatch(text) is not None
    letters = sum(c.isalpha() for c in text)
    if kind == 1:
        parts = re.split(r"[^0-9]+", text.strip())
        return letters == 0 and len(parts) == 4 and all(p and len(p) <= 3 and int(p) <= 255 for p in parts)
    if kind == 2:
        return letters == 0 and 12 <= n <= 19 and luhn(_digits(text))
    return letters == 0 and 9 <= n <= 15 and re.search(r"[0-9][\x20().-]+[0-9]", text) is not None


def added_spans(text: str, runs: list[tuple[int, int, int]], base: list[Span]) -> list[Span]:
    """Spans of decoded runs (byte start, kind, byte stop) that hold their kind and touch no base span."""
    out, raw = [], text.encode()
    starts = sorted((s, e) for s, _, e in base)
    # Farthest end of the base spans up to each one, so that one search answers whether any is touched.
    reach = list(accumulate((e for _, e in starts), max))
    starts = [s for s, _ in starts]
    at = before = 0
    for a, kind, b in sorted(runs):
        before += len(raw[at:a].decode())
        at, start = a, before
        piece = raw[a:b].decode()
        left = len(piece) - len(piece.lstrip(_TRIM.replace("(", "") if kind == 3 else _TRIM))
        piece = piece[left:].rstrip(_TRIM + ".")
        start, end = start + left, start + left + len(piece)
        met = bisect_left(starts, end)
        if piece and not (met and reach[met - 1] > start) and _plausible(kind, piece):
            out.append((start, kind, end))
    return out


def spans_of(texts: pa.Array) -> list[tuple[list[Span], list[Span]]]:
    """(base spans, added spans) of each text, the latter decoded for all lines at once."""
    weights, trans, first = model()
    start, stop, lengths, word_hash, shape_hash = words(texts)
    f = features(word_hash, shape_hash, lengths)
    emit = weights[f[:, 0]]
    for i in range(1, N_FEATURES):
        emit = emit + weights[f[:, i]]
    labels = crf.viterbi(emit, lengths, trans, first)
    hit = np.flatnonzero(labels)
    runs: dict[int, list[tuple[int, int, int]]] = {}
    plain = texts.to_pylist()
    if len(hit):
        chain = np.repeat(np.arange(len(lengths)), lengths)
        sizes = np.array([len((t or "").encode()) + 1 for t in plain])
        ends = np.cumsum(sizes)
        opens = np.concatenate([[True], (np.diff(hit) > 1) | (np.diff(labels[hit]) != 0) | (np.diff(chain[hit]) != 0)])
        heads = np.flatnonzero(opens)
        tails = np.concatenate([heads[1:], [len(hit)]]) - 1
        owner = np.searchsorted(ends, start[hit[heads]], side="right")
        for o, a, b in zip(owner.tolist(), hit[heads].tolist(), hit[tails].tolist(), strict=True):
            at = int(ends[o] - sizes[o])
            runs.setdefault(o, []).append((int(start[a]) - at, int(labels[a]) - 1, int(stop[b]) - at))
    out = []
    for i, text in enumerate(plain):
        base = base_spans(text) if text else []
        out.append((base, added_spans(text, runs[i], base) if i in runs else []))
    return out


def told(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in sorted(spans))


#: Bytes of text that are decoded at once.
SLICE_BYTES = 2 << 20


def find(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_added) of every row; the counts are of base spans."""
    rows = docs.select(F.col(id_column).alias("_id"), F.col(text_column).cast("string").alias("text"))
    kind = rows.schema["_id"].dataType.simpleString()
    counts = [f"n_{k}" for k in KINDS]

    def make() -> Callable[[pa.RecordBatch], pa.RecordBatch]:
        def apply(batch: pa.RecordBatch) -> pa.RecordBatch:
            found = spans_of(batch.column("text"))
            columns = [pa.array([sum(k == i for _, k, _ in base) for base, _ in found], pa.int64()) for i in range(len(KINDS))]
            digests = [hashlib.sha256(told(base).encode()).hexdigest() for base, _ in found]
            return pa.RecordBatch.from_arrays(
                [
                    batch.column("_id"), *columns, pa.array(digests, pa.string()),
                    pa.array([told([*base, *more]) for base, more in found], pa.string()), pa.array([len(more) for _, more in found], pa.int64()),
                ],
                ["_id", *counts, "base_sha256", "spans", "n_added"],
            )

        return apply

    schema = f"_id {kind}, {', '.join(f'{c} long' for c in counts)}, base_sha256 string, spans string, n_added long"
    return map_texts(rows, make, schema, limit=SLICE_BYTES).withColumnRenamed("_id", id_column)


def redact(text: str, spans: list[Span]) -> str:
    """``text`` with every span replaced by its kind in brackets; of overlapping spans the first covers."""
    out, at = [], 0
    for a, kind, b in sorted(spans):
        if a >= at:
            out += [text[at:a], f"[{KINDS[kind].upper()}]"]
        at = max(at, b)
    return "".join([*out, text[at:]])


def redacted(docs: DataFrame, text_column: str = "text", length_column: str = "n_chars") -> DataFrame:
    """``docs`` with personal data replaced in the text; all columns stay."""
    names = docs.columns
    at = names.index(text_column)

    def make() -> Callable[[pa.RecordBatch], pa.RecordBatch]:
        def apply(batch: pa.RecordBatch) -> pa.RecordBatch:
            column = batch.column(at)
            found = spans_of(column)
            texts = [redact(t, [*b, *m]) if b or m else t for t, (b, m) in zip(column.to_pylist(), found, strict=True)]
            return batch.set_column(at, batch.schema.field(at), pa.array(texts, column.type))

        return apply

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    out = map_texts(docs, make, schema, text_column, SLICE_BYTES)
    if length_column in names:
        out = out.withColumn(length_column, F.length(text_column).cast(docs.schema[length_column].dataType))
    return out
