import hashlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from cases import TEXTS, documents, empty
from tokenizers import Tokenizer

from provenlake.llm import op11_token_alignment as op
from provenlake.llm.tokens import byte_alphabet

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
MORE = [
    "a▁b", "  two  spaces   and    more ", "   ", "tab\t x\nnew line\r\n y", "<s> </s> <unk> <0x0A> 's it 's", "naïve 日本 語 😀 😀😀 ẍ̈", "\x00 \x01 a\x1c b\x85 c  d",
    "é è", "x " * 500, "a  b c", "don't  'll 12 3.5", "  a b", "𝒜𝒷 ﬁn 한국어 텍스트 ก็",
]


def brute(texts):
    """Columns of each text, from whole texts and cumulated bytes alone."""
    a, b = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
    a.encode_special_tokens = True
    code = {c: x for x, c in byte_alphabet().items()}
    found = []
    for text in texts:
        if not text:
            found.append(None)
            continue
        x = [(i, bytes(code[c] for c in a.id_to_token(i))) for i in a.encode(" " + text, add_special_tokens=False).ids]
        y = []
        for i in b.encode(text):
            p = b.id_to_piece(i)
            y.append((i, bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode()))
        whole = (" " + text).encode()
        if b"".join(r for _, r in x) != whole or b"".join(r for _, r in y) != whole:
            found.append(None)
            continue
        owners = []
        for seq in (x, y):
            owners.append([k for k, (_, r) in enumerate(seq) for _ in r])
        links = sorted(set(zip(*owners)))
        cuts, at = [], [0, 0]
        ends = [{0}, {0}]
        for s, seq in enumerate((x, y)):
            n = 0
            for _, r in seq:
                n += len(r)
                ends[s].add(n)
        groups, n, place = [], 0, 0
        bounds = sorted(ends[0] & ends[1])
        for lo, hi in zip(bounds, bounds[1:]):
            groups.append(tuple(sorted(set(o[lo:hi])) for o in owners))
        text_groups = ";".join("|".join(",".join(str(seq[k][0]) for k in ks) for ks, seq in zip(g, (x, y))) for g in groups)
        found.append((len(x), len(y), len(groups), [(x[i][0], y[j][0]) for i, j in links], text_groups))
    counts = Counter(p for f in found if f for p in f[3])
    best = {}
    for (_, j), n in counts.items():
        best[j] = max(best.get(j, 0), n)
    return [
        (0, 0, 0, 0, 0, 0, "") if f is None else
        (f[0], f[1], f[2], len(f[3]), sum(counts[p] == best[p[1]] for p in f[3]), sum(counts[p] for p in f[3]), hashlib.sha256(f[4].encode()).hexdigest())
        for f in found
    ]


def columns(r):
    return r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups_sha256


@pytest.mark.parametrize("table, chunks, longest", [(1 << 19, 200_000, 64), (40, 30, 4), (0, 200_000, 64)])
def test_awkward_texts_by_brute_force(spark, monkeypatch, table, chunks, longest):
    monkeypatch.setattr(op, "TABLE", table)
    monkeypatch.setattr(op, "CHUNKS", chunks)
    monkeypatch.setattr(op, "LONGEST", longest)
    texts = [*TEXTS, *MORE]
    docs = documents(spark, texts).repartition(3)
    rows = docs.collect()
    want = sorted(zip([r.doc_id if r.doc_id is not None else -1 for r in rows], brute([r.text for r in rows])))
    got = op.alignments(docs, A, B).collect()
    assert sorted((r.doc_id if r.doc_id is not None else -1, columns(r)) for r in got) == want
    assert sum(w[1][0] == 0 for w in want) < 8


def test_whole_table_by_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = docs.collect()
    want = dict(zip([r.doc_id for r in rows], brute([r.text for r in rows])))
    assert {r.doc_id: columns(r) for r in op.alignments(docs, A, B).collect()} == want
    assert all(w[0] for w in want.values())


def test_ends_inside_characters():
    # A character of four bytes in three tokens: the spans only tell that they share it.
    spans = np.array([(0, 1), (1, 5), (1, 5), (1, 5), (5, 6), (6, 9), (6, 9)])
    lengths = np.array([1, 2, 1, 1, 1, 1, 2])
    first, base = np.array([0, 0, 0, 0, 0, 5, 5]), np.array([0, 0, 0, 0, 0, 6, 6])
    assert op.ends(spans, lengths, first, base).tolist() == [1, 3, 4, 5, 6, 7, 9]


def test_empty_table(spark):
    assert op.alignments(empty(spark), A, B).count() == 0


def test_a_full_memo_starts_anew(monkeypatch):
    monkeypatch.setattr(op, "CHUNKS", 40)
    monkeypatch.setattr(op, "LONGEST", 6)
    texts = [t for t in [*TEXTS, *MORE] if t is None or len(t) < 10_000] * 2
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts)], ["_id", "text"])
    monkeypatch.setattr(op, "SLICE_BYTES", 100)
    aligner = op.Aligner(A, B)
    rows, counts, flushes, before = [], Counter(), 0, False
    for part in op._aligned(aligner, [batch], pa.int64()):
        pairs = part.column("_row").null_count > 0
        flushes, before = flushes + (pairs and not before), pairs
        if pairs:
            for pair, n in zip(part.column("pair").to_pylist(), part.column("n").to_pylist()):
                counts[pair] += n
        else:
            rows.append(part)
    keys = np.array(sorted(counts))
    n = np.array([counts[k] for k in keys.tolist()])
    best = {}
    for k, c in counts.items():
        best[k & 0xFFFFFFFF] = max(best.get(k & 0xFFFFFFFF, 0), c)
    rated = op._rated(rows, aligner.kind, keys, n, np.array([counts[k] == best[k & 0xFFFFFFFF] for k in keys.tolist()]))
    names = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert [tuple(r[c] for c in names) for p in rated for r in p.to_pylist()] == brute(texts) and flushes > 2
