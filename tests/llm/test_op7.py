import zlib
from collections import defaultdict

from cases import TEXTS, documents, empty

from provenlake.llm import op7_kd_shards as op


def check(rows, texts, n_shards):
    want = sorted((len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for t in texts)
    assert sorted((r.size, r.text_crc32) for r in rows) == want
    slots = defaultdict(list)
    for r in rows:
        assert 0 <= r.shard < n_shards
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    sizes = [0] * n_shards
    for r in rows:
        sizes[r.shard] += r.size
    return sizes


def test_whole_table_near_equal_bytes(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    texts = [r.text for r in docs.select("text").collect()]
    for n in (16, 5):
        sizes = check(op.kd_shards(docs, n_shards=n).collect(), texts, n)
        largest = max(len(t.encode()) for t in texts)
        assert max(sizes) - min(sizes) < 0.01 * sum(sizes) / n + 2 * largest, sizes


def test_target_bytes_and_slots_in_parts(spark, monkeypatch):
    monkeypatch.setattr(op, "SLOT_ROWS", 7)
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    texts = [r.text for r in docs.select("text").collect()]
    sizes = check(op.kd_shards(docs, target_bytes=300_000).collect(), texts, 9)
    assert max(sizes) < 400_000


def test_a_third_of_all_rows_alike(spark):
    rows = [(1, "same text here", "en", "s", 14)] * 300 + [(i, f"text number {i}", "fr", "t", 14) for i in range(600)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    sizes = check(op.kd_shards(docs, n_shards=16).collect(), [r[1] for r in rows], 16)
    assert max(sizes) - min(sizes) < 40


def test_awkward_rows(spark):
    check(op.kd_shards(documents(spark), n_shards=4).collect(), [*TEXTS, TEXTS[5], "text of a row without an id"], 4)
    assert op.kd_shards(empty(spark), n_shards=4).count() == 0
    assert op.kd_shards(empty(spark), target_bytes=10).count() == 0


def test_no_python(spark):
    plan = op.kd_shards(documents(spark), n_shards=4)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
