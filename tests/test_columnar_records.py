"""The columnar decoders against a reader of one record at a time, on whole, cut and altered records."""

import random
import struct

import pyarrow as pa
import pytest
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type
from scalar_records import BadRecord, read_puzzle, read_solution
from test_binary import PRODUCTION, part, puzzle, solution, text

from provenlake.functions import binary


@pytest.fixture(scope="module")
def kinds(spark):
    """Arrow types of parsed puzzles and solutions."""
    return [to_arrow_type(T.StructType.fromDDL(f"p {s}")["p"].dataType) for s in (binary.PARSED_PUZZLE, binary.PARSED_SOLUTION)]


def scalar(records, kind, read):
    parsed, errors = [], []
    for r in records:
        try:
            parsed.append(None if r is None else read(r))
            errors.append("missing_payload" if r is None else None)
        except BadRecord as e:
            parsed.append(None)
            errors.append(str(e))
    return pa.array(parsed, kind).to_pylist(), errors


def made_solution(rng):
    parts = []
    for _ in range(rng.randrange(6)):
        name = rng.choice(["arm1", "track", "pipe", "trück", "", "tracks", "Pipe", "x" * 200])
        parts.append(part(
            name, rng.randrange(-9, 9), rng.randrange(-(2**31), 2**31), rng.randrange(-12, 12), [(rng.randrange(-3, 9), rng.choice("GgRrPp")) for _ in range(rng.randrange(5))],
            track=[(rng.randrange(-9, 9), 3) for _ in range(rng.randrange(4))], arm=rng.randrange(2**32), conduit=(rng.randrange(2**32), [(1, -2)] * rng.randrange(3)),
            marker=1 if rng.random() < 0.97 else 2,
        ))
    return solution(parts, rng.choice(["P1", "é日本", "p" * 300]), None if rng.random() < 0.4 else tuple(rng.randrange(2**32) for _ in range(4)))


def made_puzzle(rng):
    def molecule():
        atoms = [(rng.randrange(1, 17), i, rng.randrange(-3, 3)) for i in range(rng.randrange(5))]
        if rng.random() < 0.05 and atoms:
            atoms.append(atoms[0])
        return tuple(atoms)

    outputs = tuple(molecule() for _ in range(rng.randrange(4)))
    bonds = tuple((1, *rng.choice(outputs[0])[1:], *rng.choice(outputs[0])[1:]) for _ in range(2)) if len(outputs) == 1 and outputs[0] else ()
    made = None
    if rng.random() < 0.5:
        made = bytes(rng.choice([0, 1, 1, 0, 0, 0, 2]) for _ in range(3))
        cabinets = [struct.pack("<bb", i, -i) + text(rng.choice(["Small", "é", ""])) for i in range(rng.randrange(3))]
        made += struct.pack("<I", len(cabinets)) + b"".join(cabinets)
        conduits = [struct.pack("<bbbbI", 0, 1, 2, 3, n) + struct.pack("<bb", 4, -5) * n for n in range(rng.randrange(3))]
        made += struct.pack("<I", len(conduits)) + b"".join(conduits)
        made += struct.pack("<I", 1) + struct.pack("<bbBI", 1, 1, 200, 4_000_000_000)
    return puzzle(rng.choice(["Gold", "n" * 300]), rng.randrange(2**64), tuple(molecule() for _ in range(rng.randrange(3))), outputs, 3, made, bonds)


def altered(record, rng):
    what = rng.randrange(6)
    if what == 0 and record:
        return record[: rng.randrange(len(record))]
    if what == 1:
        return record + bytes([rng.randrange(256)])
    if what < 4 and record:
        at = rng.randrange(len(record))
        return record[:at] + bytes([rng.choice([0, 1, 2, 127, 128, 255, rng.randrange(256)])]) + record[at + 1 :]
    return record


@pytest.mark.parametrize("make, read_one, read_all, which", [
    (made_solution, read_solution, binary.read_solutions, 1), (made_puzzle, read_puzzle, binary.read_puzzles, 0),
])
def test_equal_to_one_record_at_a_time(kinds, make, read_one, read_all, which):
    kind = kinds[which]
    seen = set()
    for seed in range(60):
        rng = random.Random(seed)
        records = [None if rng.random() < 0.03 else altered(make(rng), rng) for _ in range(rng.choice([1, 3, 40, 150]))]
        column = pa.array([b"skipped", *records], pa.binary()).slice(1)
        parsed, errors = binary.parsed_batch(column, kind, read_all)
        want = scalar(records, kind, read_one)
        assert errors.to_pylist() == want[1]
        assert parsed.to_pylist() == want[0] and parsed.type == kind
        seen |= set(want[1])
    assert len(seen) >= 8


def test_batches_without_records_and_of_bad_ones(kinds):
    puzzles, solutions = kinds
    for records in ([], [None], [b"", b"\1"], [None, solution(), None]):
        parsed, errors = binary.parsed_batch(pa.array(records, pa.binary()), solutions, binary.read_solutions)
        assert (parsed.to_pylist(), errors.to_pylist()) == scalar(records, solutions, read_solution)
        parsed, errors = binary.parsed_batch(pa.array(records, pa.binary()), puzzles, binary.read_puzzles)
        assert (parsed.to_pylist(), errors.to_pylist()) == scalar(records, puzzles, read_puzzle)


def test_pieces_are_bounded_by_bytes(monkeypatch):
    monkeypatch.setattr(binary, "BATCH_BYTES", 100)
    batch = pa.RecordBatch.from_arrays([pa.array(range(9)), pa.array([b"x" * n for n in (40, 40, 40, 500, 0, 1, 99, 100, 3)])], ["k", "c"])
    sizes = [[len(x) for x in p.column(1).to_pylist()] for p in binary._pieces(batch)]
    assert sum(sizes, []) == [40, 40, 40, 500, 0, 1, 99, 100, 3] and all(sum(s[:-1]) < 100 for s in sizes)


def test_a_record_with_many_parts(kinds):
    big = solution([part("arm1", i, steps=[(i, "G")]) for i in range(3_000)])
    parsed, errors = binary.parsed_batch(pa.array([solution(), big], pa.binary()), kinds[1], binary.read_solutions)
    assert errors.null_count == 2 and [p["x"] for p in parsed[1].as_py()["parts"]] == list(range(3_000))


def test_production_constraints_stay_with_their_record(kinds):
    records = [puzzle(), puzzle(production=PRODUCTION), puzzle()]
    parsed, _ = binary.parsed_batch(pa.array(records, pa.binary()), kinds[0], binary.read_puzzles)
    assert [p["production_info"] is None for p in parsed.to_pylist()] == [True, False, True]
