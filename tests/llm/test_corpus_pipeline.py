import re
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
from cases import documents, empty
from test_op3 import base as base_spans
from test_op6 import brute as brute_components
from test_op10 import WORD
from test_op10 import base as base_counts
from tokenizers import Tokenizer

import corpus_pipeline as pipeline
from provenlake.llm import op2_language_crf, op3_pii_crf, op10_quality_rules

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def brute_clean(text):
    """The text without failed lines, or None when the document is rejected."""
    text = text or ""
    lines = [x for x in text.split("\n") if WORD.search(x)]
    good, seen, lost = [], set(), 0
    for line in lines:
        words = WORD.findall(line)
        marked = len(re.findall(r"(?:^|[\x20\x09-\x0D])[#*$%&|<>]|[#*$%&|<>](?:$|[\x20\x09-\x0D])", line))
        shouted = len(re.findall(r"!!(?=$|[\x20\x09-\x0D])", line))
        bad = (
            line in seen or any(p in line.lower() for p in op10_quality_rules.BOILERPLATE) or marked > 0.3 * len(words)
            or (len(words) >= 3 and shouted > 0.5 * len(words)) or (len(words) >= 20 and not re.search("[.,;:!?…。、，！？।]", line))
        )
        seen.add(line)
        lost += len(words) * bad
        if not bad:
            good.append(line)
    n, *_, failed = base_counts(text)
    return None if failed or lost > 0.5 * n else text if len(good) == len(lines) else "\n".join(good)


def test_stages_by_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = {r.doc_id: r.asDict() for r in docs.collect()}

    cleaned = pipeline.quality_rules(spark, docs, "")
    assert cleaned.columns == COLUMNS
    got = {r.doc_id: (r.text, r.n_chars) for r in cleaned.collect()}
    want = {i: t for i, r in rows.items() if (t := brute_clean(r["text"])) is not None}
    assert got == {i: (t, len(t)) for i, t in want.items()}

    spoken = pipeline.language_id(spark, cleaned, "")
    assert spoken.columns == COLUMNS
    model = op2_language_crf.learned(cleaned, ~op2_language_crf.held_out())
    ids = sorted(want)
    names, scores = op2_language_crf.label(model, pa.array([want[i] for i in ids]))
    want = {i: want[i] for i, n, s in zip(ids, names, scores) if n != "und" and s >= op2_language_crf.MIN_SCORE}
    assert {r.doc_id: r.text for r in spoken.collect()} == want

    single = pipeline.near_dedup(spark, spoken, "")
    assert single.columns == COLUMNS
    labels = brute_components(list(want.items()))
    want = {i: t for i, t in want.items() if labels[i][1] == i}
    assert {r.doc_id: r.text for r in single.collect()} == want

    private = pipeline.pii(spark, single, "")
    assert private.columns == COLUMNS
    found = dict(zip(want, op3_pii_crf.spans_of(pa.array(list(want.values())))))
    assert all(found[i][0] == base_spans(t) for i, t in want.items())
    want = {i: op3_pii_crf.redact(t, [*found[i][0], *found[i][1]]) for i, t in want.items()}
    assert {r.doc_id: (r.text, r.n_chars) for r in private.collect()} == {i: (t, len(t)) for i, t in want.items()}

    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    pieces = {}
    for i, t in want.items():
        all_ids = [*library.encode(t, add_special_tokens=False).ids, 1]
        for k, at in enumerate(range(0, len(all_ids), 4096)):
            pieces[i, k] = (at, len(all_ids[at : at + 4096]), zlib.crc32(np.array(all_ids[at : at + 4096], "<u4").tobytes()))
    packed = pipeline.packing(spark, private, "").collect()
    assert {(r.doc_id, r.piece): (r.start, r.length, r.ids_crc32) for r in packed} == pieces

    whole = pipeline.run(spark, "/root/testdata/sf0.01").collect()
    assert {(r.doc_id, r.piece): (r.start, r.length, r.ids_crc32) for r in whole} == pieces
    filled = defaultdict(int)
    for r in whole:
        filled[r.sequence_id] += r.length
    assert max(filled.values()) <= 4096


def test_stages_settle_awkward_rows(spark):
    good = "A proper sentence of more than ten words, which every stage should simply keep."
    docs = documents(spark, [None, "", good, good, good.replace("simply", "just"), "1 2 3 4 5 6 7 8 9 10 11 12.", good + " Mail a@b.co!"]).select(
        "*").drop("_id", "piece", "count")
    docs = docs.union(docs.where("doc_id = 2"))
    for table in (docs, empty(spark)):
        at = table
        for name, stage in pipeline.STAGES:
            at = stage(spark, at, "")
            if name != "packing":
                assert at.columns == COLUMNS
        kept = {r.doc_id for r in at.collect()}
    assert kept == set()
    kept = pipeline.near_dedup(spark, docs, "").collect()
    assert sorted(r.doc_id for r in kept if r.doc_id in (2, 3)) == [2]


def test_clashing_columns_pass_through_the_stages(spark):
    good = "A proper sentence of more than ten words, which every stage should simply keep."
    rows = [(i, f"{good} It is number {i}, and mail a{i}@b.co is in it, as in text {i * 7} of the set {i * 13}.", "en", "s", 0, *["own"] * 8) for i in range(3)]
    clash = ["_measured", "_mark", "_text", "lang_pred", "score", "_id", "text_hash", "kept"]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{c} string" for c in clash))
    at = docs
    for _, stage in pipeline.STAGES[:-1]:
        at = stage(spark, at, "")
        assert at.columns == docs.columns
    kept = at.collect()
    assert kept and all(r[c] == "own" for r in kept for c in clash) and all("[EMAIL]" in r.text for r in kept)
    assert {r.doc_id for r in pipeline.packing(spark, at, "").collect()} == {r.doc_id for r in kept}
