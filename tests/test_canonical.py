"""Canonical JSON, ids and strict base64 against the Python definitions."""

import base64
import binascii
import hashlib
import json

from pyspark.sql import functions as F

from provenlake.functions import canonical as c
from provenlake.functions import fixed_values as fixed


def py_json(value):
    return json.dumps(value, sort_keys=True, separators=(",", ":"), ensure_ascii=False)


def test_canonical_json_matches_python(spark):
    texts = [
        "plain", 'quote " and \\ and /', "Émile ☃ 🙂", "tab\tnew\nline\r\x08\x0c", "ctl \x0b\x0e\x0f\x1a\x1f\x01",
        "\\u001F literal", "\\\x1f", "\x1f\x1f", "\u0085  \x7f", "", None,
    ]
    rows = [(i, t, {"b": 1, "a": i}, [(i, t)]) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "zeta int, alpha string, m map<string,int>, nested array<struct<y:int,x:string>>")
    got = {r.zeta: r.j for r in df.select("zeta", c.canonical_json(df).alias("j")).collect()}
    for i, t in enumerate(texts):
        assert got[i] == py_json({"zeta": i, "alpha": t, "m": {"a": i, "b": 1}, "nested": [{"y": i, "x": t}]})


def test_json_scalar_and_composition(spark):
    df = spark.createDataFrame([("a\"b", 3, None, True)], "s string, n bigint, z string, b boolean")
    row = df.select(
        c.json_object({k: c.json_scalar(F.col(k)) for k in ("s", "n", "z", "b")}).alias("j"),
        c.json_array(F.array(F.lit("1"), F.lit("2"))).alias("a"),
    ).first()
    assert row.j == py_json({"s": 'a"b', "n": 3, "z": None, "b": True})
    assert row.a == "[1,2]"


def test_ids_match_their_definitions(spark):
    digest = "a" * 64
    row = spark.range(1).select(
        c.artifact_id(F.lit("puzzle"), F.lit(digest)).alias("p"),
        c.artifact_id(F.lit("solution"), F.lit(digest)).alias("s"),
        c.artifact_id(F.lit("movie"), F.lit(digest)).alias("x"),
        c.object_key(F.lit(digest)).alias("k"),
        c.verification_id(*[F.lit(v) for v in ("pa", "so", "im", "re")], F.lit(None).cast("string"), F.lit("pr")).alias("v"),
        c.normalized_id(F.lit("so"), F.lit("pu"), F.lit("v1")).alias("n"),
        c.receipt_file_name(F.lit("s"), F.lit("r"), F.lit("p/q")).alias("f"),
        c.name_key(F.lit(" Van Berlo's Wheel (II) ")).alias("nk"),
        c.collection_split(F.lit("base-game-1")).alias("split"),
    ).first()
    assert row.p == fixed.PUZZLE_ARTIFACT_PREFIX + digest and row.s == fixed.SOLUTION_PREFIX + digest
    assert row.x is None
    assert row.k == "objects/sha256/aa/" + "a" * 62
    body = {
        "puzzle_artifact_id": "pa", "solution_id": "so", "verifier_implementation": "im",
        "verifier_revision": "re", "verifier_sha256": None, "validation_profile": "pr",
    }
    assert row.v == fixed.VERIFICATION_PREFIX + hashlib.sha256(py_json(body).encode()).hexdigest()
    body = {"solution_id": "so", "puzzle_id": "pu", "normalizer_version": "v1"}
    assert row.n == fixed.NORMALIZED_PREFIX + hashlib.sha256(py_json(body).encode()).hexdigest()
    assert row.f == hashlib.sha256(b"s\0r\0p/q").hexdigest() + ".json"
    assert row.nk == "VAN_BERLO_S_WHEEL_II" and row.split == "base_game_1"


def python_base64_code(text):
    try:
        raw = text.encode("ascii")
    except UnicodeEncodeError:
        return "invalid_base64"
    try:
        payload = base64.b64decode(raw, validate=True)
    except (binascii.Error, ValueError):
        try:
            loose = base64.b64decode(raw)
        except (binascii.Error, ValueError):
            return "invalid_base64"
        return "noncanonical_base64" if loose and base64.b64encode(loose) != raw else "invalid_base64"
    if base64.b64encode(payload) != raw:
        return "noncanonical_base64"
    return None if payload else "empty_candidate"


def test_strict_base64_agrees_with_python(spark):
    texts = [
        "", "YQ==", "YR==", "YQ", "YQ=", "Y", "YWI=", "YWJj", "YW Jj", "YWJj\n", "YQ==extra", "Y=Q==", "YQ=x=",
        "====", " ", "é", "YWJjZA==", "YWJj!ZA==", "=YQ==", "YQ===", "YWJjYQ", "-_8=", "YWI", "YWI==", "Y!Q==", "!!!!",
        "YQ==YQ==", "YWJ=", "A=", "A===", "AA=A", "AAA=A", "AA==A",
    ]
    df = spark.createDataFrame([(t,) for t in texts], "t string").withColumn("b", c.strict_base64(F.col("t")))
    for r in df.collect():
        assert r.b.code == python_base64_code(r.t), repr(r.t)
        if r.b.code is None:
            assert bytes(r.b.payload) == base64.b64decode(r.t)
