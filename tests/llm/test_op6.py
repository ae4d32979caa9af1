import random
import re

import numpy as np
import pyarrow as pa
import pytest
from cases import TEXTS, documents, empty

from provenlake.llm import op6_multi_index_hamming as op
from provenlake.llm.components import components
from provenlake.llm.shingles import shingle_sets

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def brute(rows):
    """Component per id over all pairs."""
    sets = {i: shingles(t) for i, t in rows}
    up = {i: i for i in sets}

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    ids = sorted(sets)
    for x in ids:
        for y in ids:
            if x < y and sets[x] and sets[y] and 100 * min(len(sets[x]), len(sets[y])) >= 85 * max(len(sets[x]), len(sets[y])):
                both = len(sets[x] & sets[y])
                if 100 * both >= 85 * (len(sets[x]) + len(sets[y]) - both):
                    a, b = root(x), root(y)
                    up[max(a, b)] = min(a, b)
    return {i: (len(sets[i]), root(i)) for i in ids}


def check(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in op.near_duplicates(docs).collect()}
    assert got == brute(rows)
    return got


def copies(rng, n, words, edits):
    base = [f"w{rng.randrange(10**6)}" for _ in range(words)]
    out = [" ".join(base)]
    for _ in range(n):
        w = base.copy()
        for _ in range(rng.randint(0, edits)):
            w[rng.randrange(len(w))] = f"e{rng.randrange(10**6)}"
        out.append(" ".join(w))
    return out


def test_shingle_sets_by_brute_force():
    values, counts = shingle_sets(pa.array(TEXTS))
    assert counts.tolist() == [len(shingles(t)) for t in TEXTS]
    again, _ = shingle_sets(pa.array(["x", *[t and t.upper().lower() if t and t.isascii() else t for t in TEXTS]])[1:])
    assert (values == again).all()


def test_whole_table(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").collect()]
    check(spark, rows)


@pytest.mark.parametrize("block", [1_500, 20])
def test_families_of_every_degree(spark, monkeypatch, block):
    monkeypatch.setattr(op, "BLOCK_ROWS", block)
    rng = random.Random(5)
    texts = [*copies(rng, 60, 200, 12), *copies(rng, 40, 60, 3), *copies(rng, 9, 7, 1), *["same text of six words here"] * 30, *TEXTS]
    got = check(spark, list(enumerate(texts)))
    assert len({c for _, c in got.values()}) < len(texts)


def test_every_pair_within_the_distance_shares_a_key():
    rng = np.random.default_rng(1)
    for wrong in (0, 1, 15, op.CHUNKS * (op.ERRORS + 1) - 1):
        for _ in range(50):
            a = rng.integers(0, 1 << 16, (1, op.SYMBOLS), dtype=np.uint16)
            b = a.copy()
            at = rng.choice(op.SYMBOLS, wrong, replace=False)
            b[0, at] += 1
            assert (op._masked_keys(a) == op._masked_keys(b)).any()


def test_components_of_a_long_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(200)] + [(500, 400), (3, 3)], "a long, b long")
    got = dict(components(edges).collect())
    assert got == {i: 0 for i in range(201)} | {400: 400, 500: 400}


def test_awkward_rows(spark):
    rows = op.near_duplicates(documents(spark)).collect()
    assert len(rows) == len(TEXTS) + 2
    alone = [r for r in rows if r.doc_id is None]
    assert alone[0].component_id is None and alone[0].kept and alone[0].n_shingles == 3
    assert {(r.n_shingles, r.component_id, r.kept) for r in rows if r.doc_id in (0, 1, 2)} == {(0, i, True) for i in range(3)}
    assert all(r.component_id == 5 for r in rows if r.doc_id in (5, 6))
    assert op.near_duplicates(empty(spark)).count() == 0


def linked_at(percent, rows):
    """Component per id over all pairs at ``percent``."""
    sets = {i: shingles(t) for i, t in rows}
    label = {i: i for i in sets}
    changed = True
    near = [(x, y) for x in sets for y in sets if x < y and 100 * len(sets[x] & sets[y]) >= percent * len(sets[x] | sets[y])]
    while changed:
        changed = False
        for x, y in near:
            least = min(label[x], label[y])
            changed |= label[x] != label[y]
            label[x] = label[y] = least
    return label


def test_lower_threshold_by_brute_force(spark):
    rng = random.Random(8)
    rows = list(enumerate(t for _ in range(12) for t in copies(rng, 6, 250, 9)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in op.near_duplicates(docs, percent=80).collect()}
    assert got == linked_at(80, rows) != linked_at(85, rows)
    assert {r.doc_id for r in op.deduplicated(docs, percent=80).collect()} == {i for i, c in got.items() if i == c}


def test_distances_follow_the_threshold():
    assert op.far(90) < op.far(85) < op.far(80) and op.far(85) >= 45 and op.far(100) == 0
    a, b = np.arange(90, dtype=np.uint64), np.arange(10, 100, dtype=np.uint64)
    sig = np.zeros((2, op.SYMBOLS), np.uint16)
    sig[1, : op.far(80)] = 1
    assert op.forest(sig, [a, b], np.full(2, -1), 80) == [(0, 1)]
    assert op.lost_share(80) < op.LOST < op.lost_share(60)


def test_thresholds_that_the_index_cannot_hold_are_refused(spark):
    docs = spark.createDataFrame([(1, "a b c")], "doc_id long, text string")
    with pytest.raises(ValueError, match="60"):
        op.near_duplicates(docs, percent=60)
