import re
from collections import Counter

import duckdb
from cases import documents, empty
from oracle import compare, connect

from provenlake.llm import op10_quality_rules as op
from provenlake.llm import registry

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def base(text):
    text = text or ""
    words = WORD.findall(text)
    grams = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    often = Counter(grams)
    inside = {j for i, g in enumerate(grams) if often[g] > 1 for j in range(i, i + 5)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    failed = len(words) < 10 or 100 * len(inside) > 20 * len(words)
    return (
        len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(inside), failed,
    )


NAMES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]


def check(spark, docs):
    texts = Counter((r.doc_id, *base(r.text)) for r in docs.select("doc_id", "text").collect())
    rows = op.quality(docs).collect()
    assert Counter((r.doc_id, *[r[c] for c in NAMES]) for r in rows) == texts
    assert not any(r.base_failed and r.kept for r in rows)
    return rows


def test_base_counts_of_awkward_texts(spark):
    check(spark, documents(spark))
    texts = ["a b c d e " * 9, "a a a a a a a", "x\n\nx\n x\nx", " \x0b lead", "a b c d e f a b c d e", "###\n***\n###"]
    check(spark, documents(spark, [*["pad it out"] * 6, *texts]))
    check(spark, empty(spark))


def test_base_counts_of_a_whole_table(spark):
    rows = check(spark, spark.read.parquet("/root/testdata/sf0.01/documents.parquet"))
    kept = {r.doc_id for r in rows if r.kept}
    labels = duckdb.sql("SELECT doc_id, quality FROM '/root/testdata/sf0.01/labels.parquet'").fetchall()
    good = [d for d, q in labels if q == 1]
    assert sum(d in kept for d in good) > 0.98 * len(good)


def test_lines_are_removed_and_documents_rejected(spark):
    good = "This is a proper sentence, with words that say something useful."
    texts = [
        f"{good}\nHome | About | Contact | Login\nSecond, a wholly different remark follows!\nWe use cookies; see our cookie policy here.\n{good.upper()}",
        f"Home | About | Contact | News | Sports | Weather | Login\nMenu | Top | Next | Last | More\n{good}",
        "Nothing but clean words here.\n\nAnd one more line of them, to be sure, with words.",
    ]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").selectExpr("*", "length(text) AS n_chars")
    rows = {r.doc_id: r for r in op.clean_documents(docs).collect()}
    assert rows[0].text == f"{good}\nSecond, a wholly different remark follows!\n{good.upper()}" and rows[0].n_chars == len(rows[0].text)
    assert 1 not in rows and rows[2].text == texts[2]


def test_query_equals_its_sql(spark):
    name = "op10_quality_rules_line_first"
    rows, problems = compare(spark, connect("0.01"), name, registry.QUERIES[name], registry.ORACLES[name], "0.01")
    assert rows == 1000 and problems == []


def test_main_path_has_no_python(spark):
    plan = op.quality(documents(spark))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Exchange" not in plan


def test_phrases_fail_only_lines_that_they_fill(spark):
    text = "The new privacy policy of the town was read aloud in the square, and everyone who heard it had an opinion."
    short = "Privacy policy | Terms of use"
    (row,) = op.clean_documents(spark.createDataFrame([(1, f"{text}\n{short}")], "doc_id long, text string")).collect()
    assert row.text == text


def test_many_lines_with_copies(spark):
    lines = [f"This is sentence number {i}, and it says so." for i in range(100_000)]
    lines[70_000:70_003] = lines[:3]
    (row,) = op.quality(spark.createDataFrame([(1, "\n".join(lines))], "doc_id long, text string")).collect()
    assert row.n_dup_lines == row.n_bad_lines == 3 and row.n_lost_words == 27
