"""Decoders, normalization and puzzle claims."""

import struct

import pytest
from pyspark.sql import functions as F

from provenlake.functions import binary
from provenlake.operators import normalize, semantics
from provenlake.sources.files import dumped_puzzle_name


def varint(n):
    out = b""
    while n > 127:
        out += bytes([n & 127 | 128])
        n >>= 7
    return out + bytes([n])


def text(s):
    raw = s if isinstance(s, bytes) else s.encode()
    return varint(len(raw)) + raw


def molecule(atoms, bonds=()):
    return (
        struct.pack("<I", len(atoms)) + b"".join(struct.pack("<Bbb", *a) for a in atoms)
        + struct.pack("<I", len(bonds)) + b"".join(struct.pack("<Bbbbb", *b) for b in bonds)
    )


def puzzle(name="Gold", mask=0x7F0F, inputs=(((1, 0, 0),),), outputs=(((7, -1, 2), (2, 0, 0)),), scale=2, production=None, bonds=()):
    body = struct.pack("<I", 3) + text(name) + struct.pack("<QQ", 2**64 - 1, mask)
    body += struct.pack("<I", len(inputs)) + b"".join(molecule(m) for m in inputs)
    body += struct.pack("<I", len(outputs)) + b"".join(molecule(m, bonds) for m in outputs)
    body += struct.pack("<I", scale)
    return body + (b"\0" if production is None else b"\1" + production)


def part(name, x=0, y=0, rotation=0, steps=(), track=(), arm=0, conduit=None, marker=1):
    body = text(name) + bytes([marker]) + struct.pack("<iiIiI", x, y, 1, rotation, 0)
    body += struct.pack("<I", len(steps)) + b"".join(struct.pack("<iB", c, ord(o)) for c, o in steps)
    if name == "track":
        body += struct.pack("<I", len(track)) + b"".join(struct.pack("<ii", *t) for t in track)
    body += struct.pack("<I", arm)
    if name == "pipe":
        body += struct.pack("<I", conduit[0]) + struct.pack("<I", len(conduit[1])) + b"".join(struct.pack("<ii", *t) for t in conduit[1])
    return body


def solution(parts=(), name="P007", solved=None, version=7):
    body = struct.pack("<I", version) + text(name) + text("mine")
    body += struct.pack("<I", 0) if solved is None else struct.pack("<I", 1) + b"".join(struct.pack("<II", t, v) for t, v in enumerate(solved))
    return body + struct.pack("<I", len(parts)) + b"".join(parts)


PRODUCTION = (
    b"\1\0\1" + struct.pack("<I", 1) + struct.pack("<bb", 1, -2) + text("Small") + struct.pack("<I", 1)
    + struct.pack("<bbbb", 0, 1, 2, 3) + struct.pack("<I", 2) + struct.pack("<bbbb", 4, 5, -6, 7)
    + struct.pack("<I", 1) + struct.pack("<bbBI", 1, 1, 200, 4_000_000_000)
)


def run(spark, decode, rows):
    df = spark.createDataFrame(list(rows.items()), "artifact_id string, content binary")
    return {r.artifact_id: r for r in decode(df).collect()}


def test_puzzles(spark):
    long_name = "n" * 300
    good = puzzle()
    got = run(
        spark, binary.decode_puzzles,
        {
            "good": good, "long": puzzle(long_name), "production": puzzle(production=PRODUCTION),
            "trailing": good + b"\0", "truncated": good[:-1], "version": b"\4" + good[1:], "duplicate": puzzle(outputs=(((1, 0, 0), (2, 0, 0)),)),
            "dangling": puzzle(bonds=((1, 0, 0, 5, 5),)), "flag": good[:-1] + b"\2", "empty": b"", "null": None,
            "many": struct.pack("<I", 3) + text("x") + struct.pack("<QQ", 0, 0) + struct.pack("<I", 100_001),
            "overlong_ok": struct.pack("<I", 3) + b"\x81\x00x" + good[4 + len(text("Gold")):],
            "bad_length": struct.pack("<I", 3) + b"\xff\xff\xff\xff\x1f",
            "no_end": struct.pack("<I", 3) + b"\xff\xff\xff\xff\xff",
        },
    )
    p = got["good"].parsed
    assert bytes(p.name) == b"Gold" and p.creator == str(2**64 - 1) and p.parts_available == 0x7F0F and p.output_scale == 2
    assert [(a.atom_type, a.q, a.r) for a in p.outputs[0].atoms] == [(7, -1, 2), (2, 0, 0)]
    assert bytes(got["long"].parsed.name).decode() == long_name
    assert bytes(got["overlong_ok"].parsed.name) == b"x"
    info = got["production"].parsed.production_info
    assert (info.shrink_left, info.shrink_right, info.isolate_inputs_from_outputs) == (True, False, True)
    assert bytes(info.cabinets[0].cabinet_type) == b"Small" and info.cabinets[0].r == -2
    assert [(h.q, h.r) for h in info.conduits[0].hexes] == [(4, 5), (-6, 7)]
    assert (info.vials[0].style, info.vials[0]["count"]) == (200, 4_000_000_000)
    errors = {k: r.error for k, r in got.items() if r.error}
    assert errors == {
        "trailing": "trailing_bytes", "truncated": "truncated", "version": "unsupported_version", "duplicate": "duplicate_atom",
        "dangling": "dangling_bond", "flag": "invalid_flag", "empty": "truncated", "null": "missing_payload",
        "many": "count_exceeds_limit", "bad_length": "invalid_length", "no_end": "invalid_length",
    }
    assert all((r.parsed is None) == (r.error is not None) for r in got.values())


def test_solutions(spark):
    arm = part("arm1", 3, -4, -7, [(5, "G"), (2, "R"), (5, "g"), (2, "N")], arm=9)
    track = part("track", 10, 20, 4, track=[(0, 0), (1, -1)])
    pipe = part("pipe", conduit=(77, [(1, 2)]))
    good = solution([arm, track, pipe], solved=(100, 50, 30, 4))
    got = run(
        spark, binary.decode_solutions,
        {
            "good": good, "unsolved": solution(), "version": solution(version=8), "trailing": good + b"x", "truncated": good[:-2],
            "marker": solution([part("arm1", marker=2)]), "utf8": solution(name=b"\xff"), "many": solution()[:-4] + struct.pack("<I", 10_000),
            "overlong": struct.pack("<I", 7) + b"\x81\x00x", "tag": solution()[:-8] + struct.pack("<I", 1) + struct.pack("<II", 1, 5) + bytes(28),
        },
    )
    p = got["good"].parsed
    assert (p.puzzle_name, p.solution_name, p.solved) == ("P007", "mine", True)
    assert (p.declared_cycles, p.declared_cost, p.declared_area, p.declared_instructions) == (100, 50, 30, 4)
    assert p.parts[2].conduit_id == 77 and [(o.x, o.y) for o in p.parts[2].conduit_offsets] == [(1, 2)]
    assert p.parts[0].arm_number == 9 and got["unsolved"].parsed.declared_cost is None
    assert {k: r.error for k, r in got.items() if r.error} == {
        "version": "unsupported_version", "trailing": "trailing_bytes", "truncated": "truncated", "marker": "invalid_part_marker",
        "utf8": "invalid_utf8", "many": "count_exceeds_limit", "overlong": "invalid_length", "tag": "invalid_metric_tag",
    }
    metrics = spark.createDataFrame([("g", bytearray(good)), ("u", bytearray(solution()))], "artifact_id string, content binary")
    claimed = {r.artifact_id: r.m for r in binary.decode_solutions(metrics).select("artifact_id", normalize.declared_metrics(F.col("parsed")).alias("m")).collect()}
    assert claimed["u"] is None and claimed["g"].asDict() == {"cycles": 100, "cost": 50, "area": 30, "instructions": 4}


def test_normalized_structure(spark):
    arm = part("arm1", 3, -4, -7, [(5, "G"), (2, "R"), (5, "g"), (2, "N")], arm=9)
    rows = {
        "good": solution([arm, part("track", 10, 20, 4, track=[(0, 0), (1, -1)]), part("pipe", conduit=(77, [(1, 2)]))]),
        "empty_track": solution([part("track")]), "negative": solution([part("arm1", steps=[(-1, "G")])]), "unnamed": solution([part("")]),
    }
    df = spark.createDataFrame(list(rows.items()), "artifact_id string, content binary")
    decoded = binary.decode_solutions(df).withColumn("puzzle_id", F.lit("om.puzzle.0001"))
    got = {r.solution_id: r for r in normalize.normalize_solutions(decoded).collect()}
    n = got["good"]
    assert [(p.part_id, p.type, p.rotation) for p in n.parts] == [("part-0000", "arm1", 5), ("part-0001", "track", 0), ("part-0002", "pipe", 0)]
    assert n.parts[0].parameters == '{"arm_number":9,"input_output_index":0,"size":1}'
    assert n.parts[2].parameters == '{"arm_number":0,"conduit_id":77,"conduit_offsets":[{"x":1,"y":2}],"input_output_index":0,"size":1}'
    assert [(t.track_id, [(c.x, c.y) for c in t.coordinates]) for t in n.tracks] == [("track-0001", [(10, 20), (11, 19)])]
    # equal cycles keep their order
    assert [(s.cycle, s.opcode) for s in n.programs[0].instructions] == [(2, "rotate_cw"), (2, "unknown:0x4e"), (5, "grab"), (5, "drop")]
    s = n.summaries
    assert (s.part_count, s.track_count, s.track_hex_count, s.program_count, s.instruction_count) == (3, 1, 2, 1, 4)
    assert s.part_type_histogram == {"arm1": 1, "pipe": 1, "track": 1}
    assert s.opcode_histogram == {"drop": 1, "grab": 1, "rotate_cw": 1, "unknown:0x4e": 1}
    assert {k: r.error for k, r in got.items() if r.error} == {"empty_track": "empty_track", "negative": "negative_cycle", "unnamed": "empty_part_type"}


@pytest.mark.parametrize(
    "payload,error",
    [
        (puzzle(), None), (puzzle(production=PRODUCTION), None), (puzzle(scale=0), "output_scale_below_1"), (puzzle(inputs=()), "no_reagents"),
        (puzzle(outputs=()), "no_products"), (puzzle(mask=1 << 40), "unknown_availability_bits"), (puzzle(inputs=((),)), "empty_molecule"),
        (puzzle(inputs=(((99, 0, 0),),)), "unknown_atom_type"), (puzzle(outputs=(((1, 0, 0),),), bonds=((16, 0, 0, 0, 0),)), "invalid_bond_type"),
    ],
)
def test_puzzle_semantics(spark, payload, error):
    df = spark.createDataFrame([("a", bytearray(payload))], "artifact_id string, content binary")
    row = binary.decode_puzzles(df).select(semantics.puzzle_semantics_error(F.col("parsed")).alias("e"), semantics.decoded_claims(F.col("parsed")).alias("c")).first()
    assert row.e == error
    if error is None:
        values = {c.field: c.value_json for c in row.c}
        assert values["target_output_count"] == "12" and values["reagents"] == '[{"atoms":[{"atom_type":"salt","q":0,"r":0}],"bonds":[]}]'
        assert (values["production"] == "true") == (values["production_constraints"] != "null")


def test_dump_header(spark):
    rows = {
        "ok": (puzzle("Näme")[:30], "Näme", None), "long": (struct.pack("<I", 3) + text("n" * 300), "n" * 300, None), "short": (b"\3\0\0", None, "invalid_header"),
        "format": (b"\4\0\0\0\1a", None, "unsupported_format"), "cut": (b"\3\0\0\0\x05ab", None, "truncated_name"), "empty": (b"\3\0\0\0\0", None, "empty_name"),
        "utf8": (b"\3\0\0\0\1\xff", None, "invalid_utf8"), "len": (b"\3\0\0\0\xff\xff\xff\xff\x1f", None, "invalid_name_length"),
        "cutlen": (b"\3\0\0\0\xff", None, "truncated_name_length"),
    }
    df = spark.createDataFrame([(k, bytearray(v[0])) for k, v in rows.items()], "k string, content binary")
    got = {r.k: (r.h.name, r.h.error) for r in df.select("k", dumped_puzzle_name(F.col("content")).alias("h")).collect()}
    assert got == {k: v[1:] for k, v in rows.items()}
