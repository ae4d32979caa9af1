import hashlib
import itertools
import re
from collections import Counter

import numpy as np
import pyarrow as pa
from cases import TEXTS, documents, empty

from provenlake.llm import crf
from provenlake.llm import op3_pii_crf as op


def luhn(s):
    return sum(sum(map(int, str(int(c) * (1 + i % 2)))) for i, c in enumerate(reversed(s))) % 10 == 0


def base(text):
    """The contract's patterns, word for word."""
    digits = lambda m: re.sub("[^0-9]", "", m)
    rules = (
        (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
        (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(p) <= 255 for p in m.split("."))),
        (r"[0-9]([\x20-]?[0-9])+", lambda m: 12 <= len(digits(m)) <= 19 and luhn(digits(m))),
        (r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 9 <= len(digits(m)) <= 15),
    )
    return sorted((m.start(), k, m.end()) for k, (p, ok) in enumerate(rules) for m in re.finditer(p, text or "") if ok(m[0]))


CASES = [
    "a@b@c.de.f x@y.z@w.q @no.com a@b a.@-.- é@x.y x@é.com", "1.2.3.4.5.6.7.8 256.1.1.1 1.1.1.256 0001.2.3.4 1.2.3 9.9.9.9é",
    "4111 1111 1111 1111 and 4111-1111-1111-1111 4111111111111111111 4111  1111 0 00", "+1 (988) 555-2485 +12 +1 2 3 4 5 6 7 8 9 ++49 30 123456.",
    "tel +49 (0)30 1234-5678 (99) mail é.a@b.c, ip 10.0.0.1", "+1 (826) 555-4081 10.20.30.40 4337166598464399",
]


def test_base_spans_by_the_patterns():
    for text in [*CASES, *TEXTS]:
        assert op.base_spans(text or "") == base(text), text and text[:60]
    alphabet = "a1 .@+-(2"
    for n in range(1, 6):
        for letters in itertools.islice(itertools.product(alphabet, repeat=n), 0, None, 7):
            assert op.base_spans("".join(letters)) == base("".join(letters))


def test_a_whole_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").union(spark.createDataFrame(
        [(10_000 + i, t, "en", "s", 0) for i, t in enumerate(CASES)], "doc_id long, text string, lang string, source string, n_chars long"))
    texts = {r.doc_id: r.text for r in docs.collect()}
    rows = op.find(docs).collect()
    assert len(rows) == len(texts)
    added = 0
    for r in rows:
        want = base(texts[r.doc_id])
        named = ",".join(f"{op.KINDS[k]}:{a}:{b}" for a, k, b in want)
        assert r.base_sha256 == hashlib.sha256(named.encode()).hexdigest()
        kinds = Counter(k for _, k, _ in want)
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(kinds[k] for k in range(4))
        assert set(filter(None, named.split(","))) <= set(r.spans.split(","))
        added += r.n_added
    assert added < 0.01 * len(texts)


def test_the_field_adds_what_patterns_miss():
    texts = ["Please call (555) 123-4567 or write to john at mail dot com now.", "her card 4111.1111.1111.1111 was used",
             "Nothing here in 2020 but 123456 people, version 1.2.3."]
    found = [[(t[a:b], op.KINDS[k]) for a, k, b in more] for t, (_, more) in zip(texts, op.spans_of(pa.array(texts)))]
    assert ("(555) 123-4567", "phone") in found[0] and ("john at mail dot com", "email") in found[0]
    assert found[1] == [("4111.1111.1111.1111", "card")] and found[2] == []


def test_rows_of_the_labelled_table():
    hits = wrong = missed = 0
    op.random.seed(0)
    table = op.labelled_table()
    texts = pa.array([t for t, _ in table])
    for (t, spans), (base_found, more) in zip(table, op.spans_of(texts)):
        for a, k, b in spans:
            if k == 3:
                ok = any(k2 == 3 and a2 < b and a < b2 for a2, k2, b2 in [*base_found, *more])
                hits, missed = hits + ok, missed + (not ok)
        wrong += sum(not any(a2 < b and a < b2 for a, _, b in spans) for a2, _, b2 in more)
    assert hits > 0.9 * (hits + missed) and wrong < 0.02 * len(table)


def test_chains_by_brute_force():
    rng = np.random.default_rng(0)
    lengths, k = np.array([3, 0, 1, 4, 2]), 3
    emit, trans, start = rng.normal(size=(10, k)), rng.normal(size=(k, k)), rng.normal(size=k)
    best, post = [], np.zeros((10, k))
    at, total = 0, 0.0
    for n in lengths:
        if n:
            paths = list(itertools.product(range(k), repeat=n))
            score = np.array([start[p[0]] + sum(emit[at + i, y] for i, y in enumerate(p)) + sum(trans[a, b] for a, b in zip(p, p[1:])) for p in paths])
            best += paths[score.argmax()]
            weight = np.exp(score - np.log(np.exp(score).sum()))
            total += np.log(np.exp(score).sum())
            for w, p in zip(weight, paths):
                for i, y in enumerate(p):
                    post[at + i, y] += w
            at += n
    assert crf.viterbi(emit, lengths, trans, start).tolist() == best
    got, z, _, _ = crf.marginals(emit, lengths, trans, start)
    assert np.allclose(got, post) and np.isclose(z, total)


def test_awkward_rows_and_redaction(spark):
    assert len(op.find(documents(spark)).collect()) == len(TEXTS) + 2
    assert op.find(empty(spark)).count() == 0
    docs = spark.createDataFrame([(1, "to a@b.co or 10.0.0.1, é", 3), (2, None, None), (3, "clean", 5)], "doc_id long, text string, n_chars long")
    got = {r.doc_id: (r.text, r.n_chars) for r in op.redacted(docs).collect()}
    assert got == {1: ("to [EMAIL] or [IP], é", 21), 2: (None, None), 3: ("clean", 5)}


def test_added_spans_touch_no_base_span():
    """Against a comparison with every base span, in a text of 100,000 lines."""
    line = "é call (555) 123-4567 or +1 (555) 123-4567 or mail a@b.co now\n"
    n = 100_000
    text, size = line * n, len(line.encode())
    at = {word: len(line[: line.index(word)].encode()) for word in ("(555)", "+1")}
    runs = [(i * size + at["(555)"], 3, i * size + at["(555)"] + 14) for i in range(n)]
    runs += [(i * size + at["+1"], 3, i * size + at["+1"] + 17) for i in range(n)]
    base = op.base_spans(line)
    many = [(a + i * len(line), k, b + i * len(line)) for i in range(n) for a, k, b in base]
    start = line.index("(555)")
    found = op.added_spans(text, runs, many)
    assert found == [(start + i * len(line), 3, start + 14 + i * len(line)) for i in range(n)]
    assert any(k == 3 for _, k, _ in base)
