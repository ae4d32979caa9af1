import zlib

import pyarrow as pa
import pytest
from cases import TEXTS, documents, empty

from provenlake.llm import op2_language_crf as op


@pytest.fixture(scope="module")
def table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    return {r.doc_id: r for r in docs.collect()}, op.identified(docs).collect()


def test_held_out_accuracy(table):
    docs, rows = table
    assert len(rows) == len(docs)
    right = n = 0
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1
        if r.held_out:
            n, right = n + 1, right + (r.lang_pred == docs[r.doc_id].lang)
    assert n > 200 and right / n > 0.98


def test_a_switched_text_is_labelled_word_by_word(spark, table):
    docs = table[0]
    by_lang = {}
    for r in docs.values():
        by_lang.setdefault(r.lang, []).append((r.lang, r.text))
    model = op.fit([x for rows in by_lang.values() for x in rows[:60]])
    en, fr = (max((t for _, t in by_lang[x][60:]), key=len).split() for x in ("en", "fr"))
    text = " ".join([*en[:60], *fr[:40]])
    (name,), score = op.label(model, pa.array([text]))
    assert name == "en" and 0.45 < score[0] < 0.75


def test_prediction_depends_on_the_text_alone(spark, table):
    docs, rows = table
    model = op.fit([(r.lang, r.text) for r in list(docs.values())[:200]])
    texts = [r.text for r in list(docs.values())[200:260]]
    names, score = op.label(model, pa.array(texts))
    for i in (0, 7, 59):
        one, s = op.label(model, pa.array([texts[i]]))
        assert one[0] == names[i] and abs(s[0] - score[i]) < 1e-6


def test_awkward_rows(spark):
    rows = op.identified(documents(spark)).collect()
    assert len(rows) == len(TEXTS) + 2
    by_id = {r.doc_id: r for r in rows}
    assert all((by_id[i].lang_pred, by_id[i].score) == ("und", 0.0) for i in range(4))
    assert all(r.lang_pred in ("en", "fr", "und") for r in rows)
    assert op.identified(empty(spark)).count() == 0
    unlabelled = documents(spark).drop("lang").selectExpr("*", "CAST(NULL AS string) AS lang")
    assert {r.lang_pred for r in op.identified(unlabelled).collect()} == {"und"}
    assert op.label(op.fit([("en", "only one language here")]), pa.array(["some words", "１２３ — …", "123"]))[0] == ["en", "und", "und"]


def test_recognized_keeps_clear_documents(spark, table):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").union(
        spark.createDataFrame([(5000, "12 34", None, None, 5), (5001, None, "en", None, None)], "doc_id long, text string, lang string, source string, n_chars long")
    )
    kept = {r.doc_id for r in op.recognized(docs).collect()}
    assert not kept & {5000, 5001} and len(kept) > 0.99 * len(table[0])


def test_signs_of_any_number_are_no_language():
    model = op.fit([("en", "the cat sat on the mat"), ("fr", "le chat sur la table")])
    texts = [mark * n if n < 66 else " ".join([mark] * n) for mark in ("😀", "—", "１") for n in (1, 64, 65, 1_000, 100_000)]
    names, score = op.label(model, pa.array(texts))
    assert set(names) == {"und"} and not score.any()
    # One letter far behind makes a text.
    assert op.label(model, pa.array(["— " * 1_000 + "é", "😀 " * 70 + "the"]))[0] != ["und", "und"]


def test_sample_of_rows_without_ids_and_with_many_labels(spark, monkeypatch):
    monkeypatch.setattr(op, "SAMPLE_ROWS", 20)
    monkeypatch.setattr(op, "MAX_LANGUAGES", 2)
    rows = [(None, f"the cat number {i} sat on the mat", "en") for i in range(300)] + [(0, f"le chat {i} est sur la table", "fr") for i in range(300)]
    rows += [(i, f"rare {i}", f"x{i}") for i in range(50)]
    model = op.learned(spark.createDataFrame(rows, "doc_id long, text string, lang string"), ~op.held_out())
    assert sorted(model.languages) == ["en", "fr"]
