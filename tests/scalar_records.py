"""One record at a time: what the columnar decoders are held against."""

import struct
from typing import NamedTuple

from provenlake.functions import fixed_values as fixed


class Layout(NamedTuple):
    """A fixed-width item: its struct format and byte size."""

    form: str
    size: int


def _layout(form: str) -> Layout:
    return Layout(form, struct.calcsize(form))


# Fixed-width items of the two formats.
_HEX = _layout("<bb")  # q, r
_ATOM = _layout("<Bbb")  # type, q, r
_BOND = _layout("<Bbbbb")  # type, both ends
_ENDS = _layout("<bbbb")  # both ends
_VIAL = _layout("<bbBI")  # q, r, style, count
_OFFSET = _layout("<ii")  # x, y
_STEP = _layout("<iB")  # cycle, opcode
_PART = _layout("<BiiIiII")  # marker, x, y, size, rotation, input/output index, instruction count
_METRIC = _layout("<II")  # tag, value
_U32, _U64, _I64 = _layout("<I"), _layout("<Q"), _layout("<q")


class BadRecord(ValueError):
    """The bytes do not satisfy the format."""


def bounded(count: int, limit: int) -> int:
    if count > limit:
        raise BadRecord("count_exceeds_limit")
    return count


class _Cursor:
    __slots__ = ("data", "at")

    def __init__(self, data: bytes):
        self.data, self.at = data, 0

    def items(self, layout: Layout, count: int) -> list[tuple]:
        if not count:
            return []
        start, stop = self.at, self.at + layout.size * count
        if stop > len(self.data):
            raise BadRecord("truncated")
        self.at = stop
        return list(struct.iter_unpack(layout.form, self.data[start:stop]))

    def item(self, layout: Layout) -> tuple:
        try:
            found = struct.unpack_from(layout.form, self.data, self.at)
        except struct.error:
            raise BadRecord("truncated") from None
        self.at += layout.size
        return found

    def number(self, layout: Layout) -> int:
        return self.item(layout)[0]

    def byte(self) -> int:
        at = self.at
        if at >= len(self.data):
            raise BadRecord("truncated")
        self.at = at + 1
        return self.data[at]

    def count(self, limit: int) -> int:
        return bounded(self.number(_U32), limit)

    def flag(self) -> bool:
        value = self.byte()
        if value > 1:
            raise BadRecord("invalid_flag")
        return value == 1

    def text(self, limit: int | None = None, minimal: bool = False) -> bytes:
        """A 7-bit-group length prefix (32 bits at most), then that many bytes."""
        start, length = self.at, 0
        for group in range(5):
            byte = self.byte()
            length += (byte & 127) << (7 * group)
            if byte < 128:
                break
        else:
            raise BadRecord("invalid_length")
        if length >> 32 or (minimal and self.at - start > 1 and byte == 0):
            raise BadRecord("invalid_length")
        if limit is not None and length > limit:
            raise BadRecord("string_exceeds_limit")
        start, self.at = self.at, self.at + length
        if self.at > len(self.data):
            raise BadRecord("truncated")
        return self.data[start : self.at]

    def end(self) -> None:
        if self.at != len(self.data):
            raise BadRecord("trailing_bytes")


def _utf8(raw: bytes) -> str:
    try:
        return raw.decode("utf-8")
    except UnicodeDecodeError:
        raise BadRecord("invalid_utf8") from None


def _molecules(cur: _Cursor) -> list[tuple]:
    limit, found = fixed.PUZZLE_MAX_ITEMS, []
    for _ in range(cur.count(limit)):
        atoms = cur.items(_ATOM, cur.count(limit))
        bonds = cur.items(_BOND, cur.count(limit))
        places = {atom[1:] for atom in atoms}
        if len(places) < len(atoms):
            raise BadRecord("duplicate_atom")
        if not {end for bond in bonds for end in (bond[1:3], bond[3:5])} <= places:
            raise BadRecord("dangling_bond")
        found.append((atoms, bonds))
    return found


def _production(cur: _Cursor) -> tuple:
    limit = fixed.PUZZLE_MAX_ITEMS
    flags = (cur.flag(), cur.flag(), cur.flag())
    cabinets = [(*cur.item(_HEX), cur.text(fixed.PUZZLE_MAX_STRING)) for _ in range(cur.count(limit))]
    conduits = [(*cur.item(_ENDS), cur.items(_HEX, cur.count(limit))) for _ in range(cur.count(limit))]
    return (*flags, cabinets, conduits, cur.items(_VIAL, cur.count(limit)))


def read_puzzle(data: bytes) -> tuple:
    cur = _Cursor(data)
    if cur.number(_U32) != fixed.PUZZLE_FORMAT:
        raise BadRecord("unsupported_version")
    name, creator = cur.text(fixed.PUZZLE_MAX_STRING), str(cur.number(_U64))
    # The availability mask is unsigned; as a signed long it keeps the same bits.
    mask, inputs, outputs, scale = cur.number(_I64), _molecules(cur), _molecules(cur), cur.number(_U32)
    production = _production(cur) if cur.flag() else None
    cur.end()
    return name, creator, mask, inputs, outputs, scale, production


def _part(cur: _Cursor) -> tuple:
    name = _utf8(cur.text(minimal=True))
    marker, *place, steps = cur.item(_PART)
    if marker != 1:
        raise BadRecord("invalid_part_marker")
    steps = cur.items(_STEP, bounded(steps, fixed.SOLUTION_MAX_INSTRUCTIONS))
    track = cur.items(_OFFSET, cur.count(fixed.SOLUTION_MAX_HEXES)) if name == "track" else []
    arm = cur.number(_U32)
    conduit, pipe = None, []
    if name == "pipe":
        conduit = cur.number(_U32)
        pipe = cur.items(_OFFSET, cur.count(fixed.SOLUTION_MAX_HEXES))
    return (name, *place, steps, track, arm, conduit, pipe)


def read_solution(data: bytes) -> tuple:
    cur = _Cursor(data)
    if cur.number(_U32) != fixed.SOLUTION_FORMAT:
        raise BadRecord("unsupported_version")
    puzzle, solution = _utf8(cur.text(minimal=True)), _utf8(cur.text(minimal=True))
    solved = cur.number(_U32) != 0
    # cycles, cost, area, instructions: each value behind its own tag
    metrics = cur.items(_METRIC, 4) if solved else [(tag, None) for tag in range(4)]
    if [tag for tag, _ in metrics] != [0, 1, 2, 3]:
        raise BadRecord("invalid_metric_tag")
    parts = [_part(cur) for _ in range(cur.count(fixed.SOLUTION_MAX_PARTS))]
    cur.end()
    return (puzzle, solution, solved, *(value for _, value in metrics), parts)
