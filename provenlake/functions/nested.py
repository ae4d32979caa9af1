"""Canonical forms of nested puzzle content, as higher-order column expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import fixed_values as fixed
from .canonical import canonical_value, json_of, json_scalar

ATOM = "struct<atom_type:string,q:int,r:int>"
BOND = "struct<a_q:int,a_r:int,b_q:int,b_r:int,bond_types:array<string>>"
MOLECULES = f"array<struct<atoms:array<{ATOM}>,bonds:array<{BOND}>>>"
CONSTRAINTS = (
    "struct<cabinets:array<struct<cabinet_type:string,q:int,r:int>>,"
    "conduits:array<struct<a_q:int,a_r:int,b_q:int,b_r:int,hexes:array<struct<q:int,r:int>>>>,"
    "isolate_inputs_from_outputs:boolean,shrink_left:boolean,shrink_right:boolean,"
    "vials:array<struct<count:bigint,q:int,r:int,style:int>>>"
)


def _any(items: Column, predicate) -> Column:
    return F.coalesce(F.exists(items, predicate), F.lit(False))


def sort_by_json(items: Column) -> Column:
    """Sort an array by the canonical JSON text of its elements (so 10 sorts before 2)."""
    keyed = F.transform(items, lambda x: F.struct(F.to_json(x).alias("k"), x.alias("v")))
    return F.transform(F.array_sort(keyed), lambda e: e["v"])


def sort_scalars_by_json(items: Column) -> Column:
    """``sort_by_json`` for arrays of numbers or strings."""
    keyed = F.transform(items, lambda x: F.struct(json_scalar(x).alias("k"), x.alias("v")))
    return F.transform(F.array_sort(keyed), lambda e: e["v"])


def string_set(items: Column) -> Column:
    return F.array_sort(F.array_distinct(items))


def canonical_bond(bond: Column) -> Column:
    """Lesser endpoint first, bond types as a sorted set."""
    first = F.struct(bond["a_q"].alias("q"), bond["a_r"].alias("r"))
    second = F.struct(bond["b_q"].alias("q"), bond["b_r"].alias("r"))
    low, high = F.least(first, second), F.greatest(first, second)
    return F.struct(
        low["q"].alias("a_q"),
        low["r"].alias("a_r"),
        high["q"].alias("b_q"),
        high["r"].alias("b_r"),
        string_set(bond["bond_types"]).alias("bond_types"),
    )


def canonical_molecule(molecule: Column) -> Column:
    atoms = F.transform(
        molecule["atoms"],
        lambda a: F.struct(a["atom_type"].alias("atom_type"), a["q"].alias("q"), a["r"].alias("r")),
    )
    return F.struct(
        sort_by_json(atoms).alias("atoms"),
        sort_by_json(F.transform(molecule["bonds"], canonical_bond)).alias("bonds"),
    )


def canonical_molecules(molecules: Column) -> Column:
    """Canonical multiset: every molecule canonical, then sorted, copies kept."""
    return sort_by_json(F.transform(molecules, canonical_molecule))


def molecules_error(molecules: Column) -> Column:
    """First reason a list of molecules is not canonicalizable, else null."""

    def dangling(molecule: Column) -> Column:
        positions = F.transform(molecule["atoms"], lambda a: F.struct(a["q"], a["r"]))
        return _any(
            molecule["bonds"],
            lambda b: ~(
                F.array_contains(positions, F.struct(b["a_q"].alias("q"), b["a_r"].alias("r")))
                & F.array_contains(positions, F.struct(b["b_q"].alias("q"), b["b_r"].alias("r")))
            ),
        )

    def incomplete(molecule: Column) -> Column:
        return (
            molecule["atoms"].isNull()
            | molecule["bonds"].isNull()
            | _any(
                molecule["atoms"],
                lambda a: a["atom_type"].isNull() | (a["atom_type"] == "") | a["q"].isNull() | a["r"].isNull(),
            )
            | _any(
                molecule["bonds"],
                lambda b: b["a_q"].isNull() | b["a_r"].isNull() | b["b_q"].isNull() | b["b_r"].isNull()
                | b["bond_types"].isNull() | _any(b["bond_types"], lambda t: t.isNull() | (t == "")),
            )
        )

    return (
        F.when(molecules.isNull(), "not_an_array")
        .when(F.size(molecules) == 0, "empty")
        .when(_any(molecules, incomplete), "missing_fields")
        .when(_any(molecules, lambda m: F.size(m["atoms"]) == 0), "empty_atoms")
        .when(
            _any(molecules, lambda m: _any(m["bonds"], lambda b: F.size(b["bond_types"]) == 0)),
            "empty_bond_types",
        )
        .when(_any(molecules, dangling), "dangling_bond")
    )


def canonical_constraints(value: Column) -> Column:
    """Production constraints with every list in canonical order; null stays null."""
    body = F.struct(
        sort_by_json(value["cabinets"]).alias("cabinets"),
        sort_by_json(
            F.transform(
                value["conduits"],
                lambda c: F.struct(
                    c["a_q"].alias("a_q"),
                    c["a_r"].alias("a_r"),
                    c["b_q"].alias("b_q"),
                    c["b_r"].alias("b_r"),
                    sort_by_json(c["hexes"]).alias("hexes"),
                ),
            )
        ).alias("conduits"),
        value["isolate_inputs_from_outputs"].alias("isolate_inputs_from_outputs"),
        value["shrink_left"].alias("shrink_left"),
        value["shrink_right"].alias("shrink_right"),
        sort_by_json(value["vials"]).alias("vials"),
    )
    return F.when(value.isNotNull(), body)


def constraints_error(value: Column) -> Column:
    """First reason production constraints are not canonicalizable, else null."""

    def missing(item: Column, names: list[str]) -> Column:
        return reduce(lambda a, b: a | b, [item[n].isNull() for n in names])

    return F.when(
        value.isNotNull(),
        F.when(
            missing(
                value,
                ["cabinets", "conduits", "vials", "shrink_left", "shrink_right", "isolate_inputs_from_outputs"],
            )
            | _any(value["cabinets"], lambda c: missing(c, ["q", "r", "cabinet_type"]))
            | _any(
                value["conduits"],
                lambda c: missing(c, ["a_q", "a_r", "b_q", "b_r", "hexes"])
                | _any(c["hexes"], lambda h: missing(h, ["q", "r"])),
            )
            | _any(value["vials"], lambda v: missing(v, ["q", "r", "style", "count"])),
            "missing_fields",
        )
        .when(_any(value["cabinets"], lambda c: c["cabinet_type"] == ""), "empty_cabinet_type")
        .when(_any(value["vials"], lambda v: (v["style"] < 0) | (v["count"] < 0)), "negative_vial"),
    )


# --- typed claims -------------------------------------------------------------------

_INT = "(?:BIGINT|VOID)"
_STR = "(?:STRING|VOID)"


def _object(**fields: str) -> str:
    inner = ", ".join(f"{name}: {fields[name]}" for name in sorted(fields))
    return f"OBJECT<{inner}>"


def _array(element: str) -> str:
    return f"ARRAY<(?:VOID|{element})>"


# Shape of each claim as Spark prints the schema of a parsed JSON value.
_MOLECULE_SHAPE = _array(
    _object(
        atoms=_array(_object(atom_type=_STR, q=_INT, r=_INT)),
        bonds=_array(
            _object(a_q=_INT, a_r=_INT, b_q=_INT, b_r=_INT, bond_types=_array(_STR))
        ),
    )
)
_CLAIM_SHAPES = {
    "allowed_parts": _array(_STR),
    "allowed_instructions": _array(_STR),
    "reagents": _MOLECULE_SHAPE,
    "products": _MOLECULE_SHAPE,
    "output_scale": "BIGINT",
    "target_output_count": "BIGINT",
    "production": "BOOLEAN",
    "production_constraints": "(?:VOID|"
    + _object(
        cabinets=_array(_object(cabinet_type=_STR, q=_INT, r=_INT)),
        conduits=_array(
            _object(a_q=_INT, a_r=_INT, b_q=_INT, b_r=_INT, hexes=_array(_object(q=_INT, r=_INT)))
        ),
        isolate_inputs_from_outputs="BOOLEAN",
        shrink_left="BOOLEAN",
        shrink_right="BOOLEAN",
        vials=_array(_object(count=_INT, q=_INT, r=_INT, style=_INT)),
    )
    + ")",
}


def canonical_claims(df: DataFrame, field: str = "field", value: str = "value_json") -> DataFrame:
    """Replace ``value`` by its canonical text and add ``error`` (one of the two is null).

    The shape test rejects unknown keys and wrong types (a boolean is not an
    integer); the typed parse then finds missing keys, and the value rules run
    on the typed form.  Parses are separate projections, so each is done once.
    """
    f, text = F.col(field), F.col(value)
    parsed = df.withColumns(
        {
            "_shape": F.schema_of_variant(F.try_parse_json(value)),
            "_strings": F.when(f.isin("allowed_parts", "allowed_instructions"), F.from_json(value, "array<string>")),
            "_molecules": F.when(f.isin("reagents", "products"), F.from_json(value, MOLECULES)),
            "_constraints": F.when(f == "production_constraints", F.from_json(value, CONSTRAINTS)),
        }
    )
    fits = F.lit(None).cast("boolean")
    for name, pattern in _CLAIM_SHAPES.items():
        fits = F.when(f == name, F.col("_shape").rlike(f"^{pattern}$")).otherwise(fits)
    is_integer = f.isin("output_scale", "target_output_count")
    is_null = F.trim(text) == "null"
    error = (
        F.when(~F.coalesce(f.isin(fixed.SEMANTIC_FIELDS), F.lit(False)), "unknown_field")
        .when(~F.coalesce(fits, F.lit(False)), "wrong_shape")
        .when(_any(F.col("_strings"), lambda s: s.isNull() | (s == "")), "empty_string")
        .when(f.isin("reagents", "products"), molecules_error(F.col("_molecules")))
        .when(is_integer & (F.coalesce(text.try_cast("bigint"), F.lit(0)) < 1), "below_minimum")
        .when((f == "production_constraints") & ~is_null, constraints_error(F.col("_constraints")))
    )
    canonical = (
        F.when(F.col("_strings").isNotNull(), json_of(string_set(F.col("_strings"))))
        .when(F.col("_molecules").isNotNull(), json_of(canonical_molecules(F.col("_molecules"))))
        .when(is_integer, text.try_cast("bigint").cast("string"))
        .when((f == "production") | is_null, F.trim(text))
        .when(F.col("_constraints").isNotNull(), json_of(canonical_constraints(F.col("_constraints"))))
    )
    judged = parsed.withColumn("error", error)
    return judged.withColumn(value, F.when(F.col("error").isNull(), canonical)).select(*df.columns, "error")


def first_difference(left: Column, right: Column, dtype: T.DataType, path: Column) -> Column:
    """Path of the first difference between two values of one type, else null.

    Struct fields are visited in name order, array elements by position; arrays
    that agree on their common prefix differ at the array itself.  Each level
    binds its two values once, so the expression grows with the type, not with
    its depth.
    """
    pair = F.array(F.struct(left.alias("l"), right.alias("r"), path.alias("p")))
    return F.get(F.transform(pair, lambda b: _difference(b["l"], b["r"], dtype, b["p"])), F.lit(0))


def _difference(left: Column, right: Column, dtype: T.DataType, path: Column) -> Column:
    if isinstance(dtype, T.StructType):
        inner = F.coalesce(
            *[
                first_difference(left[f.name], right[f.name], f.dataType, F.concat(path, F.lit(f".{f.name}")))
                for f in sorted(dtype.fields, key=lambda f: f.name)
            ]
        )
    elif isinstance(dtype, T.ArrayType):
        common = F.least(F.size(left), F.size(right))
        positions = F.when(common > 0, F.sequence(F.lit(0), common - 1)).otherwise(F.array().cast("array<int>"))
        found = F.filter(
            F.transform(
                positions,
                lambda i: first_difference(
                    F.get(left, i), F.get(right, i), dtype.elementType,
                    F.concat(path, F.lit("["), i.cast("string"), F.lit("]")),
                ),
            ),
            lambda p: p.isNotNull(),
        )
        inner = F.coalesce(F.get(found, F.lit(0)), F.when(F.size(left) != F.size(right), path))
    else:
        return F.when(~left.eqNullSafe(right), path)
    return F.when(left.isNull() & right.isNull(), F.lit(None).cast("string")).otherwise(
        F.when(left.isNull() | right.isNull(), path).otherwise(inner)
    )


# --- names from codes ---------------------------------------------------------------


def _names_for_bits(mask: Column, bits: dict[str, int | None]) -> Column:
    table = F.array(
        *[
            F.struct(
                F.lit(name).alias("name"),
                F.lit(0 if bit is None else 1 << bit).cast("bigint").alias("need"),
            )
            for name, bit in sorted(bits.items())
        ]
    )
    granted = F.filter(table, lambda x: mask.bitwiseAND(x["need"]) == x["need"])
    return F.transform(granted, lambda x: x["name"])


def allowed_parts(mask: Column) -> Column:
    return _names_for_bits(mask, fixed.PART_BITS)


def allowed_instructions(mask: Column) -> Column:
    return _names_for_bits(mask, fixed.INSTRUCTION_BITS)


def unknown_bits(mask: Column) -> Column:
    """Bit numbers of a mask that no part or instruction uses."""
    known = 0
    for bit in [*fixed.PART_BITS.values(), *fixed.INSTRUCTION_BITS.values()]:
        known |= 0 if bit is None else 1 << bit
    rest = mask.bitwiseAND(F.lit(~known).cast("bigint"))
    return F.filter(
        F.sequence(F.lit(0), F.lit(63)), lambda b: F.getbit(rest, b) == 1
    )


def bond_types(mask: Column) -> Column:
    """Names of the bond bits of a mask, lowest bit first."""
    table = F.array(
        *[F.struct(F.lit(n).alias("name"), F.lit(b).alias("bit")) for b, n in fixed.BOND_BITS.items()]
    )
    return F.transform(
        F.filter(table, lambda x: mask.cast("int").bitwiseAND(x["bit"]) != 0), lambda x: x["name"]
    )


def textual_bond_types(text: Column) -> Column:
    """Bond names of the catalog's textual form; null when unsupported."""
    pattern = r"^Triplex \{ red: (true|false), black: (true|false), yellow: (true|false) \}$"
    flags = [
        F.when(F.regexp_extract(text, pattern, i) == "true", F.lit(name))
        for i, name in ((1, "triplex-red"), (2, "triplex-black"), (3, "triplex-yellow"))
    ]
    names = F.array_compact(F.array(*flags))
    return F.when(text == "Normal", F.array(F.lit("normal"))).when(
        text.rlike(pattern) & (F.size(names) > 0), names
    )


def opcode_name(opcode: Column) -> Column:
    """Instruction name of an opcode byte."""
    table: list[Column] = []
    for symbol, name in fixed.OPCODE_NAMES.items():
        table += [F.lit(ord(symbol)), F.lit(name)]
    return F.coalesce(
        F.try_element_at(F.create_map(*table), opcode.cast("int")),
        F.format_string("unknown:0x%02x", opcode.cast("int")),
    )


def ordinal_name(prefix: str, index: Column) -> Column:
    digits = index.cast("string")
    return F.concat(F.lit(f"{prefix}-"), F.when(index < 10_000, F.lpad(digits, 4, "0")).otherwise(digits))


# --- text forms ----------------------------------------------------------------------


def escape_line_separators(text: Column) -> Column:
    for symbol, escape in (("\u0085", "\\u0085"), (" ", "\\u2028"), (" ", "\\u2029")):
        text = F.replace(text, F.lit(symbol), F.lit(escape))
    return text


def line_text(header: str, lines: list[tuple[str, Column]]) -> Column:
    """A header line and one ``name=json`` line per field, newline-terminated."""
    body = [F.concat(F.lit(f"{name}="), escape_line_separators(value)) for name, value in lines]
    return F.concat(F.concat_ws("\n", F.lit(header), *body), F.lit("\n"))


def puzzle_text(schema: T.StructType) -> Column:
    """Model-oriented text of a definition row with the given schema."""
    fields = ["puzzle_definition_id", "puzzle_id", *fixed.SEMANTIC_FIELDS]
    lines = []
    for name in fields:
        dtype = schema[name].dataType
        if isinstance(dtype, (T.StructType, T.ArrayType)):
            text = F.coalesce(json_of(canonical_value(F.col(name), dtype)), F.lit("null"))
        else:
            text = json_scalar(F.col(name))
        lines.append((name, text))
    return line_text(fixed.PUZZLE_TEXT_HEADER, lines)
