import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from cases import TEXTS, documents, empty
from tokenizers import Tokenizer

from provenlake.llm import op1_sum_of_squares_packing as op
from provenlake.llm.tokens import SAFE

PATH = public_tokenizers.path("word_bpe_49k.json")


def ids(library, text):
    return [*library.encode(text or "", add_special_tokens=False).ids, 1]


def check_layout(rows, capacity):
    by_sequence = defaultdict(list)
    for r in rows:
        by_sequence[r.sequence_id].append((r.offset, r.length))
    for places in by_sequence.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by_sequence)


@pytest.mark.parametrize("capacity", [op.CAPACITY, 16])
def test_pieces_hold_the_documents(spark, capacity):
    library = Tokenizer.from_file(PATH)
    rows = op.pack_documents(documents(spark), PATH, capacity=capacity, group_rows=100).collect()
    want = []
    for i, t in [*enumerate(TEXTS), (5, TEXTS[5]), (None, "text of a row without an id")]:
        all_ids = ids(library, t)
        for k, at in enumerate(range(0, len(all_ids), capacity)):
            part = all_ids[at : at + capacity]
            want.append((i, k, at, len(part), zlib.crc32(np.array(part, "<u4").tobytes())))
    key = lambda x: tuple(-1 if v is None else v for v in x)
    assert sorted(((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows), key=key) == sorted(want, key=key)
    check_layout(rows, capacity)


def test_every_safe_character_encodes_as_in_the_library():
    import re

    library, encode = Tokenizer.from_file(PATH), op.encoder(PATH)
    for c in re.findall(f"[{SAFE}]", "".join(map(chr, range(0x3000)))):
        for text in (c, f"a{c}b", f" {c} {c}{c}\n1{c}2", f"X{c}s '{c}S"):
            assert encode(text) == np.array(ids(library, text), "<u4").tobytes(), (hex(ord(c)), text)


def brute(lengths, capacity):
    """Every placement tried, the sum of squares computed anew each time."""
    bins = []

    def squares(levels):
        count = defaultdict(int)
        for x in levels:
            if 0 < x < capacity:
                count[x] += 1
        return sum(n * n for n in count.values())

    for s in lengths:
        exact = [i for i, x in enumerate(bins) if x + s == capacity]
        options = exact[:1] or [i for i, x in enumerate(bins) if x + s <= capacity] + [len(bins)]
        trial = [(squares([x + s * (j == i) for j, x in enumerate([*bins, 0])]), i == len(bins), capacity - ([*bins, 0][i]), i) for i in options]
        best = min(trial)[3]
        bins += [0] * (best == len(bins))
        bins[best] += s
    return sorted(bins)


def test_placement_equals_brute_force():
    rng = random.Random(3)
    for _ in range(40):
        lengths = sorted((rng.randint(1, 19) for _ in range(60)), reverse=True)
        where, _ = op.sum_of_squares(np.array(lengths), 20)
        assert sorted(np.bincount(where, weights=lengths).astype(int).tolist()) == brute(lengths, 20)


def test_near_the_fewest_sequences(spark):
    rows = op.pack_documents(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"), PATH, group_rows=300).collect()
    used = check_layout(rows, op.CAPACITY)
    assert used <= 1.02 * -(-sum(r.length for r in rows) // op.CAPACITY) + 1


def test_empty_table(spark):
    assert op.pack_documents(empty(spark), PATH).count() == 0


def test_equal_rows_spread_over_groups(spark):
    rows = spark.range(100_000).selectExpr("CAST(NULL AS BIGINT) AS doc_id", "'one text for all of them' AS text")
    placed = op.pack_documents(rows, PATH, group_rows=2_000).selectExpr("length", "offset", "sequence_id", "(sequence_id & (1L << 61) - 1) >> 24 AS part").collect()
    assert len(placed) == 100_000
    # Groups of 2,000 such rows hold 3.4 sequences each; what is left of them is packed once more.
    assert check_layout(placed, op.CAPACITY) <= 1.05 * -(-sum(r.length for r in placed) // op.CAPACITY)
    sizes = defaultdict(int)
    for r in placed:
        sizes[r.part] += 1
    assert max(sizes.values()) < 2 * 2_000
