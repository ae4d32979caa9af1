import re
from collections import Counter

import public_tokenizers
from cases import TEXTS, documents, empty
from tokenizers import Tokenizer

from provenlake.llm import op9_token_counts as op
from provenlake.llm.tokens import SAFE

PATH = public_tokenizers.path("byte_bpe_50k.json")


def test_counts_equal_the_library(spark):
    library = Tokenizer.from_file(PATH)
    got = op.token_counts(documents(spark), PATH).collect()
    assert len(got) == len(TEXTS) + 2
    for row in got:
        text = "text of a row without an id" if row.doc_id is None else TEXTS[row.doc_id] or ""
        assert row.n_bytes == len(text.encode())
        assert row.n_tokens == len(library.encode(text, add_special_tokens=False).ids), text[:50]


def test_every_safe_character_counts_as_in_the_library():
    library, count = Tokenizer.from_file(PATH), op.counter(PATH, {})
    import re

    for c in re.findall(f"[{SAFE}]", "".join(map(chr, range(0x3000)))):
        for text in (c, f"a{c}b", f" {c} {c}{c} 1{c}2", f"x {c}s\n{c}", f"'{c}s  {c}"):
            assert count(text) == len(library.encode(text, add_special_tokens=False).ids), (hex(ord(c)), text)


def test_table_does_not_change_counts():
    text = "the cat sat on the mat, isn't it?  Yes\n"
    assert op.counter(PATH, {" the": 1, " cat": 1})(text) == op.counter(PATH, {})(text)


def test_empty_table(spark):
    assert op.token_counts(empty(spark), PATH).count() == 0


def test_only_chunks_of_other_scripts_go_to_the_library(spark):
    library = Tokenizer.from_file(PATH)
    rows = [r.text for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").limit(200).collect()]
    marks = ["10 €", "Brand™", "Москва", "東京", "日本 語", "😀", "a<|endoftext|>b", "  —  x", "\u3000y", "naïve ²", "ﬁ's"]
    texts = []
    for i, t in enumerate(rows):
        words = t.split(" ")
        for k in range(i % 40, len(words), 40):
            words.insert(k, marks[(i + k) % len(marks)])
        texts.append(" ".join(words))
    count = op.counter(PATH, {})
    assert [count(t) for t in texts] == [len(library.encode(t, add_special_tokens=False).ids) for t in texts]
    share = count.sent / sum(map(len, texts))
    print(f"{share:.4f} of the characters went to the library")
    assert 0 < share < 0.05


def test_table_counts_all_documents(spark, monkeypatch):
    texts = ["alpha beta beta", "beta gamma Москва beta", None, ""] * 50 + [f"rare{i} word{i}" for i in range(300)] + ["delta " * 400]
    docs = spark.createDataFrame([(t,) for t in texts], "text string").repartition(3)
    want = Counter(x for t in texts if t for x in re.findall(op.PRE_TOKEN, t.replace(" Москва", "")))
    table = op.frequent_lengths(docs, PATH, size=5)
    assert set(table) == {p for p, _ in want.most_common(5)} or len(table) == 5
    assert {" beta", " delta", "alpha"} <= set(table)
    # A summary that is cut many times still holds what is frequent.
    assert {" beta", " delta"} <= set(op.frequent_lengths(docs, PATH, size=4, seen=40))
    library = Tokenizer.from_file(PATH)
    assert all(n == len(library.encode(p, add_special_tokens=False).ids) for p, n in table.items())
