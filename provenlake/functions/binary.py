"""Decoding of the two binary record formats inside Spark tasks, all records of a batch at once.

The records of a batch lie in one buffer.  ``Cursors`` holds a place per record and reads
the same field of all records that are still whole in one array step: counts and strings
move the places on, lists of fixed-width items are only marked by start and number, and
are cut out of the buffer once, when all records are read.  Parts and molecules are read
by their number: the third part of every record that has one.  Nested Arrow columns are
built from these starts and numbers, without Python values per record.

The first failure of a record becomes its value in the ``error`` column, so bad records go
to quarantine and never fail a task.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from . import fixed_values as fixed

#: Bytes of records that are read at once.
BATCH_BYTES = 8 << 20

# Reasons, by their number.
REASONS = [
    None, "missing_payload", "truncated", "unsupported_version", "count_exceeds_limit", "invalid_flag", "invalid_length", "string_exceeds_limit",
    "trailing_bytes", "invalid_utf8", "duplicate_atom", "dangling_bond", "invalid_part_marker", "invalid_metric_tag",
]
_CODE = {r: i for i, r in enumerate(REASONS)}

Spans = tuple[np.ndarray, np.ndarray]


def ranges(starts: np.ndarray, counts: np.ndarray, step: int = 1) -> np.ndarray:
    """The places start, start + step, .. of every range, one range after the other."""
    within = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    return np.repeat(starts, counts) + within * step


class Cursors:
    """A place in the buffer for every record.

    Readers take the numbers of the records to read (ascending), mark those that fail,
    and give back the numbers of the others with what was read.
    """

    def __init__(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray, present: np.ndarray) -> None:
        self.data, self.at, self.end = data, starts.copy(), ends
        self.error = np.where(present, 0, _CODE["missing_payload"]).astype(np.int8)
        self._high: np.ndarray | None = None

    def fail(self, who: np.ndarray, reason: str) -> None:
        self.error[who] = _CODE[reason]

    def keep(self, who: np.ndarray, good: np.ndarray, reason: str) -> np.ndarray:
        """The records for which ``good`` holds; the others fail."""
        if good.all():
            return who
        self.fail(who[~good], reason)
        return who[good]

    def skip(self, who: np.ndarray, size: np.ndarray | int) -> Spans:
        """(records, starts) of ``size`` bytes that are passed over."""
        start = self.at[who]
        stop = start + size
        good = stop <= self.end[who]
        if not good.all():
            self.fail(who[~good], "truncated")
            who, start, stop = who[good], start[good], stop[good]
        self.at[who] = stop
        return who, start

    def value(self, start: np.ndarray, size: int, signed: bool = False) -> np.ndarray:
        """Little-endian integers at some places."""
        out = self.data[start].astype(np.int64)
        for k in range(1, size):
            out |= self.data[start + k].astype(np.int64) << (8 * k)
        return out - ((out >> (8 * size - 1)) << (8 * size)) if signed and size < 8 else out

    def number(self, who: np.ndarray, size: int = 4, signed: bool = False) -> Spans:
        who, start = self.skip(who, size)
        return who, self.value(start, size, signed)

    def count(self, who: np.ndarray, limit: int) -> Spans:
        who, n = self.number(who)
        good = n <= limit
        return self.keep(who, good, "count_exceeds_limit"), n[good]

    def flag(self, who: np.ndarray) -> Spans:
        who, value = self.number(who, 1)
        good = value <= 1
        return self.keep(who, good, "invalid_flag"), value[good] == 1

    def items(self, who: np.ndarray, n: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(records, starts, numbers) of lists of ``n`` items of ``size`` bytes."""
        start = self.at[who]
        stop = start + n * size
        # A list without items is whole wherever it stands.
        good = (stop <= self.end[who]) | (n == 0)
        self.fail(who[~good], "truncated")
        who, start, n, stop = who[good], start[good], n[good], stop[good]
        self.at[who] = stop
        return who, start, n

    def text(self, who: np.ndarray, limit: int | None = None, minimal: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(records, starts, lengths) of strings behind a length in 7-bit groups (32 bits at most)."""
        length = np.zeros(len(who), np.int64)
        alive = np.ones(len(who), bool)
        waiting = np.arange(len(who))
        for group in range(5):
            good = self.at[who[waiting]] < self.end[who[waiting]]
            self.fail(who[waiting[~good]], "truncated")
            alive[waiting[~good]] = False
            waiting = waiting[good]
            byte = self.data[self.at[who[waiting]]]
            self.at[who[waiting]] += 1
            length[waiting] += (byte & 127).astype(np.int64) << (7 * group)
            if minimal and group:
                padded = waiting[byte == 0]
                self.fail(who[padded], "invalid_length")
                alive[padded] = False
            waiting = waiting[byte > 127]
            if not len(waiting):
                break
        bad = alive & (length >> 32 > 0)
        bad[waiting] = True
        self.fail(who[bad], "invalid_length")
        alive &= ~bad
        if limit is not None:
            bad = alive & (length > limit)
            self.fail(who[bad], "string_exceeds_limit")
            alive &= ~bad
        who, length = who[alive], length[alive]
        start = self.at[who]
        good = start + length <= self.end[who]
        who = self.keep(who, good, "truncated")
        start, length = start[good], length[good]
        self.at[who] = start + length
        return who, start, length

    def utf8(self, who: np.ndarray, start: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The strings that are UTF-8; only those with high bytes are looked at."""
        if self._high is None:
            self._high = np.concatenate([[0], np.cumsum(self.data >= 128, dtype=np.int32)])
        good = np.ones(len(who), bool)
        for i in np.flatnonzero(self._high[start + length] > self._high[start]).tolist():
            try:
                self.data[start[i] : start[i] + length[i]].tobytes().decode("utf-8")
            except UnicodeDecodeError:
                good[i] = False
        return self.keep(who, good, "invalid_utf8"), start[good], length[good]

    def done(self, who: np.ndarray) -> np.ndarray:
        return self.keep(who, self.at[who] == self.end[who], "trailing_bytes")

    def whole(self) -> np.ndarray:
        """Numbers of the records without an error."""
        return np.flatnonzero(self.error == 0)


class Rows:
    """Fields of parts, molecules or other members, read number by number, put back into the order of their records."""

    def __init__(self) -> None:
        self.read: dict[str, list[tuple[np.ndarray, ...]]] = {}

    def add(self, name: str, who: np.ndarray, *values: np.ndarray) -> None:
        self.read.setdefault(name, []).append((who, *values))

    def columns(self, cursors: Cursors, total: int) -> tuple[np.ndarray, dict[str, list[np.ndarray]]]:
        """(members of each whole record, field values in order); every field has one value for each member of a whole record."""
        out, counts = {}, np.zeros(total, np.int64)
        for name, pieces in self.read.items():
            who, *values = (np.concatenate(x) for x in zip(*pieces, strict=True))
            good = cursors.error[who] == 0
            who = who[good]
            order = np.argsort(who, kind="stable")
            out[name] = [v[good][order] for v in values]
            counts = np.bincount(who, minlength=total)
        return counts[cursors.whole()], out


def _strings(cursors: Cursors, start: np.ndarray, length: np.ndarray, kind: pa.DataType) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum(length)]).astype(np.int32)
    data = cursors.data[ranges(start, length)]
    return pa.Array.from_buffers(kind, len(start), [None, pa.py_buffer(offsets), pa.py_buffer(data)])


def _list(kind: pa.DataType, counts: np.ndarray, values: pa.Array) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)), values, type=kind)


def _struct(kind: pa.DataType, columns: list[pa.Array], missing: np.ndarray | None = None) -> pa.Array:
    mask = pa.array(missing) if missing is not None and missing.any() else None
    return pa.StructArray.from_arrays(columns, fields=[kind.field(i) for i in range(kind.num_fields)], mask=mask)


def _numbers(kind: pa.DataType, values: np.ndarray, missing: np.ndarray | None = None) -> pa.Array:
    return pa.array(values, kind, mask=missing) if missing is not None else pa.array(values).cast(kind)


def _items(cursors: Cursors, kind: pa.DataType, start: np.ndarray, n: np.ndarray, widths: list[tuple[int, bool]]) -> pa.Array:
    """Lists of fixed-width items: ``widths`` are (bytes, signed) of their fields."""
    fields, at = [], ranges(start, n, sum(w for w, _ in widths))
    for i, (width, signed) in enumerate(widths):
        fields.append(_numbers(kind.value_type.field(i).type, cursors.value(at, width, signed)))
        at = at + width
    return _list(kind, n, _struct(kind.value_type, fields))


_BYTE, _SIGNED = (1, False), (1, True)
_HEX, _ATOM, _BOND, _ENDS = [_SIGNED] * 2, [_BYTE, _SIGNED, _SIGNED], [_BYTE, *[_SIGNED] * 4], [_SIGNED] * 4
_VIAL, _OFFSET, _STEP = [_SIGNED, _SIGNED, _BYTE, (4, False)], [(4, True), (4, True)], [(4, True), _BYTE]


def _width(fields: list[tuple[int, bool]]) -> int:
    return sum(w for w, _ in fields)


class _Molecules:
    """The molecules of the records of a batch, one after the other."""

    def __init__(self, cur: Cursors, who: np.ndarray) -> None:
        self.cur, self.rows, limit = cur, Rows(), fixed.PUZZLE_MAX_ITEMS
        who, left = cur.count(who, limit)
        self.who = who
        number = 0
        while len(who):
            more = left > number
            who, left = who[more], left[more]
            if not len(who):
                break
            own, n = cur.count(who, limit)
            own, atoms, n_atoms = cur.items(own, n, _width(_ATOM))
            self.rows.add("atoms", own, atoms, n_atoms)
            at, kept = own, np.arange(len(own))
            own, n = cur.count(own, limit)
            own, bonds, n_bonds = cur.items(own, n, _width(_BOND))
            self.rows.add("bonds", own, bonds, n_bonds)
            kept = kept[np.searchsorted(at, own)]
            self._checked(own, atoms[kept], n_atoms[kept], bonds, n_bonds)
            number += 1
            whole = cur.error[who] == 0
            who, left = who[whole], left[whole]

    def _checked(self, who: np.ndarray, atoms: np.ndarray, n_atoms: np.ndarray, bonds: np.ndarray, n_bonds: np.ndarray) -> None:
        """No two atoms of a molecule in one place, and an atom at each end of a bond."""
        data = self.cur.data

        def places(owner: np.ndarray, at: np.ndarray) -> np.ndarray:
            return (owner << 16) | (data[at].astype(np.int64) << 8) | data[at + 1]

        owner = np.repeat(np.arange(len(who)), n_atoms)
        taken = np.sort(places(owner, ranges(atoms, n_atoms, _width(_ATOM)) + 1))
        twice = np.zeros(len(who), bool)
        twice[taken[1:][taken[1:] == taken[:-1]] >> 16] = True
        owner = np.repeat(np.arange(len(who)), n_bonds)
        at = ranges(bonds, n_bonds, _width(_BOND))
        loose = np.zeros(len(who), bool)
        for end in (1, 3):
            loose[owner[~np.isin(places(owner, at + end), taken)]] = True
        self.cur.fail(who[loose], "dangling_bond")
        self.cur.fail(who[twice], "duplicate_atom")

    def array(self, kind: pa.DataType, total: int) -> pa.Array:
        counts, fields = self.rows.columns(self.cur, total)
        one = kind.value_type
        if not fields:
            return _list(kind, counts, pa.array([], one))
        atoms, bonds = (_items(self.cur, one.field(i).type, *fields[name], widths) for i, (name, widths) in enumerate((("atoms", _ATOM), ("bonds", _BOND))))
        return _list(kind, counts, _struct(one, [atoms, bonds]))


def read_puzzles(cur: Cursors, kind: pa.DataType) -> pa.Array:
    """The parsed column of the whole records of a batch of puzzles."""
    total, limit = len(cur.at), fixed.PUZZLE_MAX_ITEMS
    who, version = cur.number(cur.whole())
    who = cur.keep(who, version == fixed.PUZZLE_FORMAT, "unsupported_version")
    head: dict[str, np.ndarray] = {k: np.zeros(total, np.int64) for k in ("name", "length", "creator", "mask", "scale", "made", "left", "right", "apart", "vials", "n_vials")}

    def put(name: str, who: np.ndarray, values: np.ndarray) -> np.ndarray:
        head[name][who] = values
        return who

    who, start, length = cur.text(who, fixed.PUZZLE_MAX_STRING)
    put("name", who, start), put("length", who, length)
    # The creator is unsigned, the availability mask keeps its bits as a signed long.
    who = put("creator", *cur.number(who, 8))
    who = put("mask", *cur.number(who, 8))
    sides = []
    for _ in range(2):
        sides.append(_Molecules(cur, who))
        who = sides[-1].who[cur.error[sides[-1].who] == 0]
    who = put("scale", *cur.number(who))
    who = put("made", *cur.flag(who))
    plain, who = who[head["made"][who] == 0], who[head["made"][who] == 1]
    for name in ("left", "right", "apart"):
        who = put(name, *cur.flag(who))
    cabinets, conduits = Rows(), Rows()
    who, left = cur.count(who, limit)
    at, number = who, 0
    while len(at := at[left > number] if number else at[left > 0]):
        left = left[left > number]
        own, start = cur.skip(at, _width(_HEX))
        cabinets.add("hex", own, start)
        own, start, length = cur.text(own, fixed.PUZZLE_MAX_STRING)
        cabinets.add("kind", own, start, length)
        whole = cur.error[at] == 0
        at, left, number = at[whole], left[whole], number + 1
    who, left = cur.count(who[cur.error[who] == 0], limit)
    at, number = who, 0
    while len(at := at[left > number]):
        left = left[left > number]
        own, start = cur.skip(at, _width(_ENDS))
        conduits.add("ends", own, start)
        own, n = cur.count(own, limit)
        conduits.add("hexes", *cur.items(own, n, _width(_HEX)))
        whole = cur.error[at] == 0
        at, left, number = at[whole], left[whole], number + 1
    who, n = cur.count(who[cur.error[who] == 0], limit)
    who, start, n = cur.items(who, n, _width(_VIAL))
    put("vials", who, start), put("n_vials", who, n)
    cur.done(np.sort(np.concatenate([plain, who])))

    good = cur.whole()
    of = {k: v[good] for k, v in head.items()}
    made = kind.field("production_info").type
    flags = [pa.array(of[k] == 1) for k in ("left", "right", "apart")]
    columns = [*flags, _cabinets(cur, made.field("cabinets").type, cabinets, total), _conduits(cur, made.field("conduits").type, conduits, total)]
    columns.append(_items(cur, made.field("vials").type, of["vials"], of["n_vials"], _VIAL))
    return _struct(kind, [
        _strings(cur, of["name"], of["length"], pa.binary()), pa.array(of["creator"].view(np.uint64)).cast(pa.string()), pa.array(of["mask"]),
        *(m.array(kind.field(i).type, total) for i, m in zip(("inputs", "outputs"), sides, strict=True)),
        pa.array(of["scale"]), _struct(made, columns, of["made"] == 0),
    ])


def _cabinets(cur: Cursors, kind: pa.DataType, rows: Rows, total: int) -> pa.Array:
    counts, fields = rows.columns(cur, total)
    if not fields:
        return _list(kind, counts, pa.array([], kind.value_type))
    (start,) = fields["hex"]
    place = [_numbers(pa.int32(), cur.value(start + k, 1, True)) for k in range(2)]
    return _list(kind, counts, _struct(kind.value_type, [*place, _strings(cur, *fields["kind"], pa.binary())]))


def _conduits(cur: Cursors, kind: pa.DataType, rows: Rows, total: int) -> pa.Array:
    counts, fields = rows.columns(cur, total)
    if not fields:
        return _list(kind, counts, pa.array([], kind.value_type))
    (start,) = fields["ends"]
    ends = [_numbers(pa.int32(), cur.value(start + k, 1, True)) for k in range(4)]
    return _list(kind, counts, _struct(kind.value_type, [*ends, _items(cur, kind.value_type.field("hexes").type, *fields["hexes"], _HEX)]))


def _is(cur: Cursors, start: np.ndarray, length: np.ndarray, word: bytes) -> np.ndarray:
    """Which strings are ``word``."""
    out = length == len(word)
    at = start[out]
    same = np.ones(len(at), bool)
    for k, byte in enumerate(word):
        same &= cur.data[at + k] == byte
    out[out] = same
    return out


def _some(cur: Cursors, who: np.ndarray, chosen: np.ndarray, read: Callable) -> tuple[np.ndarray, list[np.ndarray]]:
    """What ``read`` gives for the chosen records, zero for the others; (records left, values)."""
    own, *values = read(who[chosen])
    left = who[cur.error[who] == 0]
    out = []
    for v in values:
        full = np.zeros(len(left), np.int64)
        full[np.searchsorted(left, own)] = v
        out.append(full)
    return left, out


def read_solutions(cur: Cursors, kind: pa.DataType) -> pa.Array:
    """The parsed column of the whole records of a batch of solutions."""
    total = len(cur.at)
    who, version = cur.number(cur.whole())
    who = cur.keep(who, version == fixed.SOLUTION_FORMAT, "unsupported_version")
    head: dict[str, np.ndarray] = {k: np.zeros(total, np.int64) for k in ("puzzle", "n_puzzle", "name", "n_name", "solved", "metrics")}
    for start_of, length_of in (("puzzle", "n_puzzle"), ("name", "n_name")):
        who, start, length = cur.utf8(*cur.text(who, minimal=True))
        head[start_of][who], head[length_of][who] = start, length
    who, solved = cur.number(who)
    head["solved"][who] = solved != 0

    def metrics(own: np.ndarray) -> Spans:
        # cycles, cost, area, instructions: each value behind its own tag
        own, start = cur.skip(own, 32)
        right = np.ones(len(own), bool)
        for tag in range(4):
            right &= cur.value(start + 8 * tag, 4) == tag
        return cur.keep(own, right, "invalid_metric_tag"), start[right]

    who, (start,) = _some(cur, who, solved != 0, metrics)
    head["metrics"][who] = start
    who, left = cur.count(who, fixed.SOLUTION_MAX_PARTS)
    every, parts, number = who, Rows(), 0
    while True:
        more = left > number
        who, left = who[more], left[more]
        if not len(who):
            break
        own, name, length = cur.utf8(*cur.text(who, minimal=True))
        parts.add("name", own, name, length)
        titles = np.stack([name, length], 1)
        known = own
        own, body = cur.skip(own, 25)
        right = cur.data[body] == 1
        own, body = cur.keep(own, right, "invalid_part_marker"), body[right]
        n = cur.value(body + 21, 4)
        small = n <= fixed.SOLUTION_MAX_INSTRUCTIONS
        own, body, n = cur.keep(own, small, "count_exceeds_limit"), body[small], n[small]
        parts.add("body", own, body)
        own, start, n = cur.items(own, n, _width(_STEP))
        parts.add("instructions", own, start, n)

        def hexes(who: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
            who, n = cur.count(who, fixed.SOLUTION_MAX_HEXES)
            return cur.items(who, n, _width(_OFFSET))

        def pipe(who: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
            who, conduit = cur.number(who)
            left, start, n = hexes(who)
            return left, conduit[np.searchsorted(who, left)], start, n

        titled = lambda own, word: _is(cur, *titles[np.searchsorted(known, own)].T, word)
        own, (start, n) = _some(cur, own, titled(own, b"track"), hexes)
        parts.add("track_offsets", own, start, n)
        own, arm = cur.number(own)
        parts.add("arm", own, arm)
        piped = titled(own, b"pipe")
        before = own
        own, (conduit, start, n) = _some(cur, own, piped, pipe)
        parts.add("conduit", own, conduit, piped[np.searchsorted(before, own)])
        parts.add("conduit_offsets", own, start, n)
        number += 1
        whole = cur.error[who] == 0
        who, left = who[whole], left[whole]
    cur.done(every[cur.error[every] == 0])

    good = cur.whole()
    of = {k: v[good] for k, v in head.items()}
    unsolved = of["solved"] == 0
    declared = [_numbers(pa.int64(), np.where(unsolved, 0, cur.value(of["metrics"] + 8 * k + 4, 4)), unsolved) for k in range(4)]
    return _struct(kind, [
        _strings(cur, of["puzzle"], of["n_puzzle"], pa.string()), _strings(cur, of["name"], of["n_name"], pa.string()), pa.array(~unsolved),
        *declared, _parts(cur, kind.field("parts").type, parts, total),
    ])


def _parts(cur: Cursors, kind: pa.DataType, rows: Rows, total: int) -> pa.Array:
    counts, fields = rows.columns(cur, total)
    one = kind.value_type
    if not fields:
        return _list(kind, counts, pa.array([], one))
    (body,), (arm,), (conduit, piped) = fields["body"], fields["arm"], fields["conduit"]
    # Behind the marker: x, y, size, rotation, input or output index.
    place = [cur.value(body + 1 + 4 * k, 4, k in (0, 1, 3)) for k in range(5)]
    return _list(kind, counts, _struct(one, [
        _strings(cur, *fields["name"], pa.string()), *(_numbers(one.field(k + 1).type, v) for k, v in enumerate(place)),
        _items(cur, one.field("instructions").type, *fields["instructions"], _STEP),
        _items(cur, one.field("track_offsets").type, *fields["track_offsets"], _OFFSET), pa.array(arm), _numbers(pa.int64(), conduit, ~piped.astype(bool)),
        _items(cur, one.field("conduit_offsets").type, *fields["conduit_offsets"], _OFFSET),
    ]))


PARSED_PUZZLE = (
    "struct<name:binary,creator:string,parts_available:bigint,"
    "inputs:array<struct<atoms:array<struct<atom_type:int,q:int,r:int>>,"
    "bonds:array<struct<bond_type:int,a_q:int,a_r:int,b_q:int,b_r:int>>>>,"
    "outputs:array<struct<atoms:array<struct<atom_type:int,q:int,r:int>>,"
    "bonds:array<struct<bond_type:int,a_q:int,a_r:int,b_q:int,b_r:int>>>>,"
    "output_scale:bigint,"
    "production_info:struct<shrink_left:boolean,shrink_right:boolean,"
    "isolate_inputs_from_outputs:boolean,"
    "cabinets:array<struct<q:int,r:int,cabinet_type:binary>>,"
    "conduits:array<struct<a_q:int,a_r:int,b_q:int,b_r:int,hexes:array<struct<q:int,r:int>>>>,"
    "vials:array<struct<q:int,r:int,style:int,count:bigint>>>>"
)
PARSED_SOLUTION = (
    "struct<puzzle_name:string,solution_name:string,solved:boolean,declared_cycles:bigint,"
    "declared_cost:bigint,declared_area:bigint,declared_instructions:bigint,"
    "parts:array<struct<name:string,x:int,y:int,size:bigint,rotation:int,"
    "input_output_index:bigint,instructions:array<struct<cycle:int,opcode:int>>,"
    "track_offsets:array<struct<x:int,y:int>>,arm_number:bigint,conduit_id:bigint,"
    "conduit_offsets:array<struct<x:int,y:int>>>>>"
)


def parsed_batch(payloads: pa.Array, kind: pa.DataType, read: Callable[[Cursors, pa.DataType], pa.Array]) -> tuple[pa.Array, pa.Array]:
    """(parsed, error) of a binary column."""
    payloads = payloads.cast(pa.large_binary())
    offsets = np.frombuffer(payloads.buffers()[1], np.int64)[payloads.offset : payloads.offset + len(payloads) + 1]
    held = payloads.buffers()[2]
    data = np.frombuffer(held, np.uint8)[offsets[0] : offsets[-1]] if held is not None else np.zeros(0, np.uint8)
    # A closing byte lets places at the very end be looked at.
    cur = Cursors(np.append(data, np.zeros(32, np.uint8)), offsets[:-1] - offsets[0], offsets[1:] - offsets[0], payloads.is_valid().to_numpy(zero_copy_only=False))
    good = read(cur, kind)
    whole = cur.whole()
    if len(whole) < len(payloads):
        place = np.zeros(len(payloads), np.int64)
        place[whole] = np.arange(len(whole))
        good = good.take(pa.array(place, mask=cur.error != 0))
    reasons = pa.DictionaryArray.from_arrays(pa.array(cur.error, mask=cur.error == 0), pa.array([r or "" for r in REASONS]))
    return good, reasons.cast(pa.string())


def _pieces(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Slices of about ``BATCH_BYTES`` bytes of records; a larger record is a slice of its own."""
    sizes = pa.compute.fill_null(pa.compute.binary_length(batch.column(1)), 0).to_numpy()
    before = np.cumsum(sizes) - sizes
    start = 0
    while start < batch.num_rows:
        stop = max(int(np.searchsorted(before, before[start] + BATCH_BYTES)), start + 1)
        yield batch.slice(start, stop - start)
        start = stop


def _decode(df: DataFrame, key: str, content: str, shape: str, read: Callable[[Cursors, pa.DataType], pa.Array]) -> DataFrame:
    key_type = df.schema[key].dataType.simpleString()
    out_schema = f"{key} {key_type}, parsed {shape}, error string"
    arrow_schema = to_arrow_schema(T.StructType.fromDDL(out_schema))

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _pieces(batch):
                parsed, error = parsed_batch(part.column(1), arrow_schema.field(1).type, read)
                yield pa.RecordBatch.from_arrays([part.column(0).cast(arrow_schema.field(0).type), parsed, error], schema=arrow_schema)

    return df.select(F.col(key), F.col(content).cast("binary")).mapInArrow(decode, out_schema)


def decode_puzzles(df: DataFrame, key: str = "artifact_id", content: str = "content") -> DataFrame:
    """(key, parsed, error) for every row of puzzle bytes; exactly one of the two is null."""
    return _decode(df, key, content, PARSED_PUZZLE, read_puzzles)


def decode_solutions(df: DataFrame, key: str = "artifact_id", content: str = "content") -> DataFrame:
    """(key, parsed, error) for every row of solution bytes; exactly one of the two is null."""
    return _decode(df, key, content, PARSED_SOLUTION, read_solutions)


def quarantine(decoded: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Split decoded rows into good ones and rejected ones."""
    return decoded.where("error IS NULL").drop("error"), decoded.where("error IS NOT NULL").drop("parsed")
