"""Language identification with a linear-chain conditional random field over words.

Every word carries hashed byte n-grams that begin, end or lie in it (affixes and
n-grams), and a lexicon class: the language in whose training texts the word is
typical.  Transitions between languages are learned too, so words of code-switched
texts are labelled by forward-backward over whole lines.  A document's language is
the one with the largest share of its words' posteriors; the score is that share.

Training uses a bounded sample: at most ``SAMPLE_ROWS`` labelled documents per language,
``SAMPLE_WORDS`` words each, fitted on the driver.  Code switching is taught by joining
lines of different languages.  Every text is labelled whole.

Defined cases: a null text or one without a letter is ``und`` with score 0, also
when there is nothing to learn from.  Repeated rows and null or equal ids give one
row each.  Other columns are not looked at.
"""

from __future__ import annotations

import random
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import crf
from .shingles import _bytes_of
from .staging import free_name, map_texts

UNKNOWN = "und"
#: Bounds of the training sample.
SAMPLE_ROWS, SAMPLE_WORDS = 250, 160
#: Languages that are learned: the most frequent values of the label column.
MAX_LANGUAGES = 128
#: Chains made by joining lines of two languages.
SWITCHED = 600
ROUNDS = 30
#: Buckets of each n-gram length; the lexicon holds at most this many words of each language.
BUCKETS = 1 << 16
LEXICON_WORDS = 4_000
#: Bytes of text labelled at once.
SLICE_BYTES = 1 << 20
#: A document with a smaller share of its best language is rejected by ``recognized``.
MIN_SCORE = 0.4

_SEPARATOR = np.uint8(1)
_M = np.uint32(0x9E3779B1)


@dataclass
class Model:
    """Weights of n-grams by length and of lexicon classes, transitions, starts, lexicon; a few megabytes at most."""

    languages: list[str]
    weights: np.ndarray
    lexicon_weights: np.ndarray
    trans: np.ndarray
    start: np.ndarray
    lexicon_hashes: np.ndarray
    lexicon_class: np.ndarray


def letters(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(bytes, word starts, word stops, words per line, lines per text) of lower-case texts.

    Words are runs of ASCII letters and of bytes of other scripts; everything else,
    and each end of a text, is one separator byte.
    """
    raw, ends = _bytes_of(pc.utf8_lower(pc.fill_null(texts, "")))
    data = np.insert(raw, ends, 10) if len(ends) else raw
    ends = ends + np.arange(1, len(ends) + 1)
    line = data == 10
    word = ((data >= 97) & (data <= 122)) | (data >= 128)
    data = np.where(word, data, _SEPARATOR)
    edge = np.diff(word.astype(np.int8), prepend=0)
    start, stop = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    breaks = np.flatnonzero(line)
    per_line = np.diff(np.searchsorted(start, breaks), prepend=0)
    per_text = np.diff(np.searchsorted(breaks, ends), prepend=0)
    return data, start, stop, per_line, per_text


def ngrams(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bucket of the 2-, 3- and 4-gram that ends at each byte; separators count, so affixes are n-grams of their own."""
    d = data.astype(np.uint32)
    b1 = np.concatenate([[np.uint32(1)], d[:-1]])
    # Nothing is taken from beyond the separator before a word.
    b2 = np.where(b1 == 1, b1, np.concatenate([[np.uint32(1)], b1[:-1]]))
    b3 = np.where(b2 == 1, b2, np.concatenate([[np.uint32(1)] * 2, b1[:-2]])[: len(d)])
    two = (b1 << np.uint32(8)) | d
    three = ((two | (b2 << np.uint32(16))) * _M) >> np.uint32(16)
    four = ((two | (b2 << np.uint32(16)) | (b3 << np.uint32(24))) * np.uint32(0x85EBCA6B)) >> np.uint32(16)
    return two, three + np.uint32(BUCKETS), four + np.uint32(2 * BUCKETS)


def word_hashes(data: np.ndarray, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """A hash of each word, from its length and its first and last eight bytes and their sum."""
    n = len(data)
    h = (stop - start).astype(np.uint64)
    for i in range(8):
        inside = start + i < stop
        h = (h ^ np.where(inside, data[np.minimum(start + i, n - 1)], 0).astype(np.uint64)) * np.uint64(0x100000001B3)
        h ^= h >> np.uint64(27)
        h = (h ^ np.where(inside, data[np.maximum(stop - 1 - i, 0)], 0).astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
    return h ^ (h >> np.uint64(31))


def lexicon_classes(model: Model, hashes: np.ndarray) -> np.ndarray:
    """1 + the language in which the word is typical, 0 for other words."""
    if not len(model.lexicon_hashes):
        return np.zeros(len(hashes), np.int64)
    at = np.minimum(np.searchsorted(model.lexicon_hashes, hashes), len(model.lexicon_hashes) - 1)
    return np.where(model.lexicon_hashes[at] == hashes, model.lexicon_class[at] + 1, 0)


def emissions(model: Model, data: np.ndarray, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """Log potentials (words x languages): the mean n-gram weight of the word's bytes and the closing separator, and its lexicon class."""
    if not len(start):
        return np.zeros((0, len(model.languages)), np.float32)
    two, three, four = ngrams(data)
    per_byte = model.weights[two]
    per_byte += model.weights[three]
    per_byte += model.weights[four]
    # Words and the separators after them are consecutive; what lies between is summed apart.
    cuts = np.stack([start, stop + 1], 1).ravel()
    cuts[-1] = min(cuts[-1], len(data))
    sums = np.add.reduceat(np.concatenate([per_byte, np.zeros((1, per_byte.shape[1]), per_byte.dtype)]), cuts)[::2]
    sums /= (stop - start + 1).astype(np.float32)[:, None]
    return sums + model.lexicon_weights[lexicon_classes(model, word_hashes(data, start, stop))]


def _sample_text(text: str) -> list[str]:
    """Lines of a sampled text up to the bound on words."""
    out, n = [], 0
    for line in text.split("\n"):
        words = line.split()
        if words and n < SAMPLE_WORDS:
            out.append(" ".join(words[: SAMPLE_WORDS - n]))
            n += len(words)
    return out


def fit(samples: list[tuple[str, str]]) -> Model:
    """A field trained on (language, text) rows."""
    languages = sorted({lang for lang, _ in samples})
    k = len(languages)
    rng = random.Random(7)
    lines: dict[int, list[str]] = {i: [] for i in range(k)}
    for lang, text in samples:
        lines[languages.index(lang)] += _sample_text(text)
    chains: list[list[tuple[int, str]]] = [[(i, x)] for i in lines for x in lines[i]]
    full = [i for i in lines if lines[i]]
    if len(full) > 1:
        for _ in range(SWITCHED):
            a, b = rng.sample(full, 2)
            chains.append([(a, rng.choice(lines[a])), (b, rng.choice(lines[b])), (a, rng.choice(lines[a]))])
    data, start, stop, lengths, _ = letters(pa.array([" ".join(x for _, x in c) for c in chains], pa.string()))
    labels = np.concatenate([
        np.concatenate([np.full(int(n), i) for (i, _), n in zip(c, letters(pa.array([x for _, x in c]))[3], strict=True)]) for c in chains
    ]).astype(np.int64) if chains else np.zeros(0, np.int64)
    hashes = word_hashes(data, start, stop)

    # The lexicon: frequent words of which most occurrences are in one language.
    distinct, inverse = np.unique(hashes, return_inverse=True)
    counts = np.zeros((len(distinct), k))
    np.add.at(counts, (inverse, labels), 1)
    total, best = counts.sum(1), counts.argmax(1) if k else np.zeros(0, int)
    typical = (total >= 3) & (counts.max(1, initial=0) > 0.8 * total)
    chosen = np.concatenate([
        (c := np.flatnonzero(typical & (best == i)))[np.argsort(-total[c], kind="stable")[:LEXICON_WORDS]] for i in range(k)
    ]) if k else np.zeros(0, int)
    chosen = np.sort(chosen).astype(int)
    model = Model(
        languages, np.zeros((3 * BUCKETS, k), np.float32), np.zeros((k + 1, k), np.float32), np.zeros((k, k)), np.zeros(k), distinct[chosen], best[chosen]
    )
    if k < 2:
        return model

    classes = lexicon_classes(model, hashes)
    two, three, four = ngrams(data)
    size = stop - start + 1
    owner = np.repeat(np.arange(len(start)), size)
    at = np.repeat(start - (np.cumsum(size) - size), size) + np.arange(len(owner))
    features = np.stack([two[at], three[at], four[at]], 1).astype(np.int64)
    weight = (1 / size)[owner].astype(np.float32)
    n_grams, n = 3 * BUCKETS, 3 * BUCKETS + k + 1
    first = np.cumsum(size) - size

    def emit(w: np.ndarray) -> np.ndarray:
        w = w.reshape(n, k)
        return np.add.reduceat(w[features].sum(1) * weight[:, None], first) + w[n_grams + classes]

    flat = features.ravel()

    def gradient(d: np.ndarray) -> np.ndarray:
        out = np.empty((n, k), np.float32)
        for j in range(k):
            out[:n_grams, j] = np.bincount(flat, np.repeat(d[owner, j] * weight, 3), minlength=n_grams)
            out[n_grams:, j] = np.bincount(classes, d[:, j], minlength=k + 1)
        return out.ravel()

    w, model.trans, model.start = crf.train(emit, gradient, n * k, lengths, labels, k, rounds=ROUNDS)
    w = w.reshape(n, k)
    model.weights, model.lexicon_weights = w[:n_grams].copy(), w[n_grams:].copy()
    return model


def label(model: Model, texts: pa.Array) -> tuple[list[str], np.ndarray]:
    """(language, score) of each text."""
    n, k = len(texts), len(model.languages)
    data, start, stop, per_line, per_text = letters(texts)
    if not k or not len(start):
        return [UNKNOWN] * n, np.zeros(n)
    emit = emissions(model, data, start, stop)
    post, _, _, _ = crf.marginals(emit, per_line, model.trans.astype(np.float32), model.start.astype(np.float32))
    words = np.add.reduceat(np.append(per_line, 0), np.cumsum(per_text) - per_text)
    shares = np.zeros((n, k))
    has = words > 0
    shares[has] = np.add.reduceat(post, (np.cumsum(words) - words)[has], dtype=np.float64) / words[has][:, None]
    best, score = shares.argmax(1), np.minimum(shares.max(1), 1.0)
    names = [model.languages[i] for i in best.tolist()]
    # A text without an ASCII letter may have word bytes (signs of other scripts, emoji, dashes) and still no letter.
    plain = pa.compute.fill_null(pa.compute.match_substring_regex(texts, "[A-Za-z]"), False).to_numpy(zero_copy_only=False)
    for i in np.flatnonzero(~has | ~plain).tolist():
        if not has[i] or not any(map(str.isalpha, texts[i].as_py())):
            names[i], score[i] = UNKNOWN, 0.0
    return names, score


def learned(docs: DataFrame, allowed: Column, text_column: str = "text", lang_column: str = "lang", id_column: str = "doc_id") -> Model:
    """The model learned from a bounded sample of the allowed rows with text and language.

    Counts per language come first (at most ``MAX_LANGUAGES`` rows reach the driver:
    the most frequent values of the column are the languages); the sample then takes
    about ``SAMPLE_ROWS`` rows of each by a hash of id and text, and never more than
    twice that.
    """
    rows = docs.where(allowed & F.col(lang_column).isNotNull() & F.col(text_column).isNotNull()).select(
        F.col(lang_column).cast("string").alias("lang"), F.col(text_column).cast("string").alias("text"), F.col(id_column).alias("_id")
    )
    counted = rows.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(MAX_LANGUAGES)
    sizes = {r["lang"]: r["count"] for r in counted.collect()}
    if not sizes:
        return fit([])
    chance = F.lit(0.0)
    for lang, n in sizes.items():
        chance = F.when(F.col("lang") == lang, F.lit(min(1.0, SAMPLE_ROWS / n))).otherwise(chance)
    picked = rows.where(F.pmod(F.xxhash64("_id", "text", F.lit(3)), F.lit(1 << 20)) < chance * (1 << 20)).select("lang", "text")
    sample = picked.limit(2 * SAMPLE_ROWS * len(sizes)).collect()
    return fit(sorted((r["lang"], r["text"]) for r in sample))


def languages(
    docs: DataFrame, model: Model, keep: list[str], text_column: str = "text", names: tuple[str, str] = ("lang_pred", "score")
) -> DataFrame:
    """The columns ``keep`` of every row, with the predicted language and its score under ``names``."""
    own_text = free_name(docs, "_text")
    rows = docs.select(*keep, F.col(text_column).cast("string").alias(own_text))
    shared = docs.sparkSession.sparkContext.broadcast(model)
    schema = ", ".join(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in keep)

    def make() -> Callable[[pa.RecordBatch], pa.RecordBatch]:
        own = shared.value

        def apply(batch: pa.RecordBatch) -> pa.RecordBatch:
            found, score = label(own, batch.column(own_text))
            columns = [batch.column(i) for i in range(len(keep))]
            return pa.RecordBatch.from_arrays([*columns, pa.array(found, pa.string()), pa.array(score)], [*keep, *names])

        return apply

    return map_texts(rows, make, f"{schema}, `{names[0]}` string, `{names[1]}` double", own_text, SLICE_BYTES)


def held_out(id_column: str = "doc_id") -> Column:
    """Rows that training never sees: crc32 of the id as text leaves 2 when divided by 4."""
    return F.coalesce(F.crc32(F.col(id_column).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def identified(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", lang_column: str = "lang") -> DataFrame:
    """(id, held_out, lang_pred, score) of every row; learned from the rows that are not held out."""
    model = learned(docs, ~held_out(id_column), text_column, lang_column, id_column)
    rows = languages(docs.select(F.col(id_column), F.col(text_column)), model, [id_column], text_column)
    return rows.select(id_column, held_out(id_column).alias("held_out"), "lang_pred", "score")


def recognized(docs: DataFrame, text_column: str = "text", lang_column: str = "lang", id_column: str = "doc_id") -> DataFrame:
    """The rows whose text is in a learned language; those without letters or without a clear language go.

    A missing language is filled with the predicted one.  When no row is labelled
    nothing can be learned, and all rows stay.
    """
    model = learned(docs, ~held_out(id_column), text_column, lang_column, id_column)
    if not model.languages:
        return docs
    names = docs.columns
    language, score = free_name(docs, "lang_pred"), free_name(docs, "score")
    rows = languages(docs, model, names, text_column, (language, score))
    clear = rows.where((F.col(language) != UNKNOWN) & (F.col(score) >= MIN_SCORE))
    return clear.withColumn(lang_column, F.coalesce(lang_column, language)).select(*names)
