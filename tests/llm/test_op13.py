import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from cases import TEXTS, documents, empty

from provenlake.llm import op13_collocations as op


def lowered(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def brute(rows, least=30, top=2000, longest=4):
    """The result by counting every phrase of whole texts."""
    f, n = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = lang or "und"
        for piece in re.split("[.,;:!?\n-\r]", lowered(text)):
            words = re.findall("[^ \t]+", piece)
            n[lang] += len(words)
            for m in range(1, longest + 1):
                f[lang].update(tuple(words[i : i + m]) for i in range(len(words) - m + 1))
    out = []
    for lang, counts in f.items():
        candidates = {p: a for p, a in counts.items() if len(p) > 1 and a >= least}
        gone = set()
        for p, a in candidates.items():
            for m in range(2, len(p)):
                gone |= {q for i in range(len(p) - m + 1) if 100 * a >= 80 * counts[q := p[i : i + m]]}
        found = []
        for p, a in candidates.items():
            if p not in gone:
                score, _, left, right = min((2_000_000 * a // (counts[p[:k]] + counts[p[k:]]), k, counts[p[:k]], counts[p[k:]]) for k in range(1, len(p)))
                found.append((-score, -a, " ".join(p).encode(), left, right))
        for rank, (score, a, p, left, right) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, p.decode(), -a, left, right, n[lang], -score))
    return sorted(out)


def rows_of(df):
    assert df.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    return sorted(map(tuple, df.collect()))


def corpus(n=400, seed=7):
    """Texts of few words, so that phrases repeat, with marks, controls below the space and a common first word."""
    rng = np.random.default_rng(seed)
    words = ["The", "the", "of", "a\x01", "a", "é", "New", "york", "new\x02", "stock", "日本", "x"]
    fixed = ["New York stock exchange", "the the the the the", "a b c d e", "of the"]
    out = []
    for i in range(n):
        parts = [" ".join(rng.choice(words, rng.integers(1, 9), p=[0.4, *[0.6 / 11] * 11])) if rng.random() < 0.6 else fixed[rng.integers(0, 4)] for _ in range(8)]
        out.append((["en", "de", None, "und"][i % 4], rng.choice([". ", ", ", "\n", "  ", "\t", " \r "]).join(parts)))
    return out


@pytest.mark.parametrize("partitions, gathered, stream_rows", [(3, 1 << 20, 500_000), (4, 300, 17), (2, 2_000, 40)])
def test_made_texts_by_brute_force(spark, monkeypatch, partitions, gathered, stream_rows):
    monkeypatch.setattr(op, "STREAM_ROWS", stream_rows)
    rows = corpus() + [("en", None), ("en", ""), (None, " . , ")]
    docs = spark.createDataFrame([(i, t, g, 5) for i, (g, t) in enumerate(rows)], "doc_id long, text string, lang string, n long").repartition(partitions)
    want = brute(rows, 10, 50)
    assert rows_of(op.collocations(docs, least=10, top=50)) == want and len(want) > 100
    # Gathering fewer bytes changes nothing.
    whole = [op._summed(pa.array([g or "und" for g, _ in rows]), pa.array([t for _, t in rows], pa.large_string()), 1, None)]
    assert sum(b.column("n").to_numpy().sum() for b in whole) == sum(len(re.findall("[^ \t.,;:!?\n-\r]+", t or "")) for _, t in rows)


def test_awkward_texts(spark):
    docs = documents(spark, TEXTS)
    rows = [(r.lang, r.text) for r in docs.collect()]
    assert rows_of(op.collocations(docs, least=2)) == brute(rows, 2)
    assert op.collocations(empty(spark)).count() == 0


def test_whole_table_by_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    want = brute([(r.lang, r.text) for r in docs.collect()])
    assert rows_of(op.collocations(docs)) == want and want


def test_scores_are_exact(spark):
    from pyspark.sql import functions as F

    cases = [(3, 4, 5), (2**62, 2**62, 2**62 + 1), (9_007_199_254_740_993, 9_007_199_254_740_993, 9_007_199_254_740_995), (30, 30, 30)]
    df = spark.createDataFrame(cases, "a long, l long, r long").select(op._score(F.col("a"), F.col("l"), F.col("r")).alias("s"))
    assert [r.s for r in df.collect()] == [2_000_000 * a // (x + y) for a, x, y in cases]


def test_long_codes_stay_exact():
    rng = np.random.default_rng(1)
    columns = [(rng.integers(0, 1 << 20, 500) // (1 << 18), 1 << 20) for _ in range(5)]
    codes = op._codes(columns)
    rows = list(zip(*[c.tolist() for c, _ in columns]))
    assert len(set(rows)) == len(set(codes.tolist())) == len(set(zip(rows, codes.tolist())))
