"""Line-first cleaning and document rules, in DataFrame functions only.

Every line is judged by itself.  It fails by punctuation (a long line without any,
or one that shouts), by navigation (its words are mostly symbols or separators)
or as boilerplate (known phrases that fill a share of it, or a copy of an earlier
line).  Failures are removed; a document that loses too large a share of its words, or that breaks a
base rule, is rejected.

A text stays in its row: words, windows and lines are arrays of that row, so
nothing is shuffled and a long document costs its own task only.

Defined cases: a null or empty text has zero counts, is base-failed (fewer than
ten words) and not kept.  Repeated rows and null or repeated ids give one row each.
Lines without a word are neither judged nor counted; they are dropped from the
cleaned text only when they follow a removed line.  Other columns are carried by
``clean_documents`` and ignored by ``quality``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .staging import free_name

#: Fixed values of the contract.
SPACE = r"\x20\x09-\x0D"
SYMBOLS = "[#*$%&|<>]"
WINDOW = 5
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20

#: Parameters of the line rules.
#: A line fails when more than this share of its words ends or begins with a symbol.
MAX_SYMBOL_WORDS = 0.3
#: A line of at least ``MIN_SHOUT`` words fails when its words in "!!" exceed this share.
MAX_SHOUT_WORDS = 0.5
MIN_SHOUT = 3
#: A line of at least so many words without a mark of ``SENTENCE_MARKS`` fails.
MIN_UNPUNCTUATED = 20
SENTENCE_MARKS = "[.,;:!?…。、，！？।]"
BOILERPLATE = (
    "cookie policy", "privacy policy", "terms of use", "terms of service", "use of cookies", "uses cookies",
    "enable javascript", "javascript is disabled", "lorem ipsum", "click here to", "sign up for our newsletter",
    "skip to content", "skip to main content", "back to top",
)
#: A line fails when the words of the known phrases in it are at least this share of its words; a
#: phrase inside a long line of running text does not matter.
MIN_PHRASE_WORDS = 0.25
#: A document is rejected when its removed lines hold more than this share of its words.
MAX_LOST_WORDS = 0.5


def let(value: Column, then: Callable[[Column], Column]) -> Column:
    """``then(value)`` with ``value`` computed once per row, however often it is used."""
    return F.element_at(F.transform(F.array(value), then), 1)


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(text, f"[{SPACE}]+"), "")


def windows(words: Column) -> Column:
    """Hash of each window of five words, by its place; none in shorter texts."""
    return let(
        words,
        lambda w: F.when(
            F.size(w) >= WINDOW,
            F.transform(
                F.sequence(F.lit(0), F.size(w) - WINDOW), lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(WINDOW)])
            ),
        ).otherwise(F.array().cast("array<bigint>")),
    )


def repeated_words(hashes: Column) -> Column:
    """How many words lie in windows that occur at least twice, the first occurrence included."""

    def places(h: Column) -> Column:
        pairs = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        return let(
            pairs,
            lambda p: F.sort_array(
                F.transform(
                    F.filter(
                        p,
                        lambda x, j: ((j > 0) & (F.get(p, j - 1)["h"] == x["h"]))
                        | ((j < F.size(p) - 1) & (F.get(p, j + 1)["h"] == x["h"])),
                    ),
                    lambda x: x["i"],
                )
            ),
        )

    def covered(at: Column) -> Column:
        # A repeated window adds the words up to the next repeated one, at most its own five.
        return F.aggregate(
            F.transform(at, lambda x, j: F.least(F.lit(WINDOW), F.coalesce(F.get(at, j + 1) - x, F.lit(WINDOW)))),
            F.lit(0), lambda total, n: total + n,
        )

    return let(
        hashes,
        lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(let(places(h), covered)),
    )


def line_fails(line: Column, earlier: Column, phrases: Column, symbols: Column, shouts: Column) -> Column:
    """The verdict on one line that has a word.

    ``earlier`` says that an equal line came before.  The last three say whether
    the whole text holds a phrase, a symbol or a shout at all; a rule that cannot
    apply is then not evaluated line by line.
    """

    def by_words(n: Column) -> Column:
        marked = F.size(F.regexp_extract_all(line, F.lit(rf"(?:^|[{SPACE}]){SYMBOLS}|{SYMBOLS}(?:$|[{SPACE}])"), F.lit(0)))
        shouted = F.size(F.split(line, rf"!!(?=$|[{SPACE}])")) - 1
        return (
            (symbols & (marked > n * MAX_SYMBOL_WORDS))
            | (shouts & (n >= MIN_SHOUT) & (shouted > n * MAX_SHOUT_WORDS))
            | ((n >= MIN_UNPUNCTUATED) & ~line.rlike(SENTENCE_MARKS))
        )

    return (
        earlier
        | (phrases & has_phrase(line) & (phrase_words(line) >= F.size(words_of(line)) * MIN_PHRASE_WORDS))
        | ((symbols | shouts | ~line.rlike(SENTENCE_MARKS)) & let(F.size(words_of(line)), by_words))
    )


def has_phrase(text: Column) -> Column:
    found = F.lit(False)
    for phrase in BOILERPLATE:
        found = found | F.contains(F.lower(text), F.lit(phrase))
    return found


def phrase_words(line: Column) -> Column:
    """Words of the known phrases that the line holds, each phrase once."""
    total = F.lit(0)
    for phrase in BOILERPLATE:
        total = total + F.when(F.contains(F.lower(line), F.lit(phrase)), len(phrase.split())).otherwise(0)
    return total


def copies(lines: Column) -> Column:
    """Of each line, by its place, whether an equal one comes before it: two sorts, whatever repeats."""
    by_text = F.sort_array(F.transform(lines, lambda line, i: F.struct(line.alias("line"), i.alias("i"))))
    return let(
        by_text,
        lambda p: F.transform(
            F.sort_array(
                F.transform(p, lambda x, j: F.struct(x["i"].alias("i"), ((j > 0) & (F.get(p, j - 1)["line"] == x["line"])).alias("copy")))
            ),
            lambda x: x["copy"],
        ),
    )


def measured(text: Column, with_text: bool = True) -> Column:
    """One struct with the base counts, the line verdicts and, if wanted, the cleaned text."""

    def with_flags(t: Column, x: Column, distinct: Column) -> Column:
        words, lines, n_symbols = x["words"], x["lines"], x["symbols"]

        def judged(copy: Column) -> Column:
            return F.transform(
                lines,
                lambda line, i: F.struct(
                    line.alias("line"),
                    line_fails(line, F.coalesce(F.get(copy, i), F.lit(False)), x["phrases"], n_symbols > 0, x["shouts"]).alias("fails"),
                ),
            )

        def texts(verdicts: Column, failed: bool) -> Column:
            some = F.filter(verdicts, lambda v: v["fails"] if failed else ~v["fails"])
            return F.transform(some, lambda v: v["line"])

        # Copies are only looked for where some line repeats.
        some_copies = F.when(distinct < F.size(lines), copies(lines))
        verdicts = let(some_copies, judged)
        both = let(verdicts, lambda v: F.struct(texts(v, True).alias("bad"), *([texts(v, False).alias("good")] if with_text else [])))
        return let(
            both,
            lambda b: let(b["bad"], lambda bad: F.struct(
                F.size(words).cast("long").alias("n_words"),
                F.length(F.array_join(words, "")).cast("long").alias("word_chars"),
                n_symbols.cast("long").alias("n_symbols"),
                (F.size(lines) - distinct).cast("long").alias("n_dup_lines"),
                repeated_words(windows(words)).cast("long").alias("n_repeat_words"),
                F.size(bad).cast("long").alias("n_bad_lines"),
                F.when(F.size(bad) > 0, F.size(words_of(F.array_join(bad, "\n")))).otherwise(F.lit(0)).cast("long").alias("n_lost_words"),
                *([F.when(F.size(bad) > 0, F.array_join(b["good"], "\n")).otherwise(t).alias("clean_text")] if with_text else []),
            )),
        )

    return let(
        F.coalesce(text.cast("string"), F.lit("")),
        lambda t: let(
            F.struct(
                words_of(t).alias("words"),
                F.filter(F.split(t, "\n"), lambda line: line.rlike(f"[^{SPACE}]")).alias("lines"),
                (F.length(t) - F.length(F.regexp_replace(t, f"{SYMBOLS}+", ""))).alias("symbols"),
                has_phrase(t).alias("phrases"),
                F.contains(t, F.lit("!!")).alias("shouts"),
            ),
            lambda x: let(F.size(F.array_distinct(x["lines"])), lambda distinct: with_flags(t, x, distinct)),
        ),
    )


VERDICTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_bad_lines", "n_lost_words"]


def base_failed(m: Column) -> Column:
    """Whether the measures break a base rule."""
    return (m["n_words"] < MIN_WORDS) | (100 * m["n_repeat_words"] > MAX_REPEAT_PERCENT * m["n_words"])


def kept(m: Column) -> Column:
    """The verdict on a document with these measures."""
    return ~base_failed(m) & (m["n_lost_words"] <= MAX_LOST_WORDS * m["n_words"])


def quality(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Counts and verdict of every document, without its text."""
    rows = docs.select(F.col(id_column), measured(F.col(text_column), with_text=False).alias("_measured"))
    m = F.col("_measured")
    return rows.select(
        F.col(id_column), *[m[c].alias(c) for c in VERDICTS], base_failed(m).alias("base_failed"), kept(m).alias("kept")
    )


def clean_documents(docs: DataFrame, text_column: str = "text", length_column: str = "n_chars") -> DataFrame:
    """The kept documents with the failed lines removed; the columns stay those of ``docs``."""
    # A generator evaluates its list once; a filter on a computed column would compute it again.
    good = F.filter(F.array(measured(F.col(text_column))), kept)
    name = free_name(docs, "_measured")
    rows = docs.select("*", F.explode(good).alias(name)).withColumn(text_column, F.col(name)["clean_text"])
    if length_column in docs.columns:
        rows = rows.withColumn(length_column, F.length(text_column).cast(docs.schema[length_column].dataType))
    return rows.select(*docs.columns)
