"""Canonical nested content, typed claims and code tables against plain Python."""

import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from provenlake.functions import fixed_values as fixed
from provenlake.functions import nested


def py_json(value):
    return json.dumps(value, sort_keys=True, separators=(",", ":"), ensure_ascii=False)


def molecule(reverse=False, kind="air"):
    atoms = [{"atom_type": "salt", "q": 10, "r": 0}, {"atom_type": kind, "q": 2, "r": 0}, {"atom_type": kind, "q": -1, "r": 0}]
    bond = {"a_q": 10, "a_r": 0, "b_q": 2, "b_r": 0, "bond_types": ["triplex-red", "normal", "normal"]}
    other = {"a_q": 2, "a_r": 0, "b_q": -1, "b_r": 0, "bond_types": ["normal"]}
    bonds = [bond, other]
    if reverse:
        atoms.reverse()
        bonds = [{**other, "a_q": -1, "b_q": 2}, {**bond, "a_q": 2, "b_q": 10}]
    return {"atoms": atoms, "bonds": bonds}


def canonical(molecules):
    out = []
    for m in molecules:
        atoms = sorted(m["atoms"], key=py_json)
        bonds = []
        for b in m["bonds"]:
            first, second = sorted([(b["a_q"], b["a_r"]), (b["b_q"], b["b_r"])])
            bonds.append(
                {"a_q": first[0], "a_r": first[1], "b_q": second[0], "b_r": second[1], "bond_types": sorted(set(b["bond_types"]))}
            )
        out.append({"atoms": atoms, "bonds": sorted(bonds, key=py_json)})
    return sorted(out, key=py_json)


def claims(spark, rows):
    df = spark.createDataFrame([(i, f, v) for i, (f, v) in enumerate(rows)], "i int, field string, value_json string")
    got = nested.canonical_claims(df).orderBy("i").collect()
    return [(r.value_json, r.error) for r in got]


def test_molecules_are_canonical_whatever_their_order(spark):
    first = [molecule(), molecule(kind="fire"), molecule()]
    second = [molecule(True, "fire"), molecule(True), molecule(True)]
    got = claims(spark, [("reagents", json.dumps(first)), ("products", json.dumps(second))])
    assert got[0] == (py_json(canonical(first)), None)
    assert got[1] == (py_json(canonical(second)), None)
    assert got[0] == got[1]


def test_claims_by_field(spark):
    constraints = {
        "shrink_left": True, "shrink_right": False, "isolate_inputs_from_outputs": False,
        "cabinets": [{"q": 10, "r": 1, "cabinet_type": "b"}, {"q": 2, "r": 1, "cabinet_type": "b"}],
        "conduits": [{"a_q": 1, "a_r": 2, "b_q": 3, "b_r": 4, "hexes": [{"q": 3, "r": 1}, {"q": 11, "r": 1}]}],
        "vials": [{"q": 0, "r": 0, "style": 2, "count": 3}, {"q": 0, "r": 0, "style": 1, "count": 3}],
    }
    expected = {**constraints}
    expected["cabinets"] = sorted(constraints["cabinets"], key=py_json)
    expected["conduits"] = [{**constraints["conduits"][0], "hexes": sorted(constraints["conduits"][0]["hexes"], key=py_json)}]
    expected["vials"] = sorted(constraints["vials"], key=py_json)
    got = claims(
        spark,
        [
            ("allowed_parts", '["b","a","b"]'),
            ("output_scale", "3"),
            ("production", "true"),
            ("production_constraints", "null"),
            ("production_constraints", json.dumps(constraints)),
        ],
    )
    assert got == [('["a","b"]', None), ("3", None), ("true", None), ("null", None), (py_json(expected), None)]


@pytest.mark.parametrize(
    "field,value,error",
    [
        ("color", '"red"', "unknown_field"),
        ("output_scale", "true", "wrong_shape"),
        ("output_scale", "1.5", "wrong_shape"),
        ("output_scale", "0", "below_minimum"),
        ("production", "1", "wrong_shape"),
        ("allowed_parts", '["a",""]', "empty_string"),
        ("allowed_parts", '"a"', "wrong_shape"),
        ("reagents", "[]", "empty"),
        ("reagents", '[{"atoms":[],"bonds":[]}]', "empty_atoms"),
        ("reagents", '[{"atoms":[{"atom_type":"salt","q":0,"r":0,"z":1}],"bonds":[]}]', "wrong_shape"),
        ("reagents", '[{"atoms":[{"atom_type":"salt","q":0,"r":0},{"atom_type":"air","q":1}],"bonds":[]}]', "missing_fields"),
        ("reagents", '[{"atoms":[{"atom_type":"salt","q":0,"r":true}],"bonds":[]}]', "wrong_shape"),
        ("reagents", '[{"atoms":[{"atom_type":"a","q":0,"r":0}],"bonds":[{"a_q":0,"a_r":0,"b_q":1,"b_r":0,"bond_types":["normal"]}]}]', "dangling_bond"),
        ("reagents", '[{"atoms":[{"atom_type":"a","q":0,"r":0}],"bonds":[{"a_q":0,"a_r":0,"b_q":0,"b_r":0,"bond_types":[]}]}]', "empty_bond_types"),
        ("production_constraints", '{"shrink_left":true}', "wrong_shape"),
    ],
)
def test_bad_claims(spark, field, value, error):
    assert claims(spark, [(field, value)]) == [(None, error)]


def difference(left, right, path):
    if isinstance(left, dict):
        for key in sorted(left):
            if left[key] != right[key]:
                return difference(left[key], right[key], f"{path}.{key}")
    elif isinstance(left, list):
        for i, (a, b) in enumerate(zip(left, right)):
            if a != b:
                return difference(a, b, f"{path}[{i}]")
    return path


def test_first_difference(spark):
    base = canonical([molecule()])
    changed = json.loads(json.dumps(base))
    changed[0]["bonds"][1]["bond_types"] = ["normal"]
    longer = base + base
    atom = json.loads(json.dumps(base))
    atom[0]["atoms"][0]["q"] = 99
    dtype = T.StructType.fromDDL(f"v {nested.MOLECULES}")["v"].dataType
    df = spark.createDataFrame(
        [(i, json.dumps(base), json.dumps(v)) for i, v in enumerate([base, changed, longer, atom])], "i int, l string, r string"
    )
    got = df.select(
        nested.first_difference(F.from_json("l", nested.MOLECULES), F.from_json("r", nested.MOLECULES), dtype, F.lit("reagents")).alias("d"), "i"
    ).orderBy("i").collect()
    assert [r.d for r in got] == [None] + [difference(base, v, "reagents") for v in (changed, longer, atom)]


def test_bits_and_names(spark):
    masks = [0, 1, 2, 1 << 18, (1 << 30) - 1, 1 << 40, (1 << 4) | 1, -(1 << 63)]
    df = spark.createDataFrame([(m,) for m in masks], "m bigint")
    known = 0
    for b in [*fixed.PART_BITS.values(), *fixed.INSTRUCTION_BITS.values()]:
        known |= 0 if b is None else 1 << b
    for r in df.select("m", nested.allowed_parts(F.col("m")).alias("p"), nested.allowed_instructions(F.col("m")).alias("i"), nested.unknown_bits(F.col("m")).alias("u")).collect():
        unsigned = r.m % (1 << 64)
        need = lambda b: 0 if b is None else 1 << b
        assert r.p == sorted(n for n, b in fixed.PART_BITS.items() if unsigned & need(b) == need(b))
        assert r.i == sorted(n for n, b in fixed.INSTRUCTION_BITS.items() if unsigned & need(b) == need(b))
        assert r.u == [b for b in range(64) if unsigned & ~known & (1 << b)]


def test_small_lookups(spark):
    row = spark.range(1).select(
        nested.opcode_name(F.lit(ord("R"))).alias("r"), nested.opcode_name(F.lit(78)).alias("n"), nested.opcode_name(F.lit(7)).alias("s"),
        nested.bond_types(F.lit(5)).alias("b"), nested.textual_bond_types(F.lit("Normal")).alias("t1"),
        nested.textual_bond_types(F.lit("Triplex { red: true, black: false, yellow: true }")).alias("t2"),
        nested.textual_bond_types(F.lit("Triplex { red: false, black: false, yellow: false }")).alias("t3"),
        nested.ordinal_name("part", F.lit(7)).alias("o"),
    ).first()
    assert (row.r, row.n, row.s) == ("rotate_cw", "unknown:0x4e", "unknown:0x07")
    assert row.b == ["normal", "triplex-black"] and row.t1 == ["normal"]
    assert row.t2 == ["triplex-red", "triplex-yellow"] and row.t3 is None and row.o == "part-0007"


def test_line_separators_are_escaped(spark):
    df = spark.createDataFrame([("a\u0085b c d",)], "s string")
    text = df.select(nested.line_text("H", [("s", F.to_json(F.array("s")))])).first()[0]
    assert text == 'H\ns=["a\\u0085b\\u2028c\\u2029d"]\n'
