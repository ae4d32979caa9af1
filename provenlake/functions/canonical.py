"""Canonical JSON and content-derived identities as column expressions.

Canonical JSON is: keys sorted by code point, no spaces, non-ASCII left as is,
nulls kept.  ``to_json`` gives that once struct fields and map entries are
sorted; the one difference is the letter case of ``\\u00XX`` escapes.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import fixed_values as fixed

_KEEP_NULLS = {"ignoreNullFields": "false"}
# Control characters whose escape contains a hex letter.
_LETTERED_ESCAPES = ["0B", "0E", "0F", "1A", "1B", "1C", "1D", "1E", "1F"]


def lower_control_escapes(json: Column) -> Column:
    """Lower-case the hex digits of control-character escapes in JSON text.

    A preceding even run of backslashes is kept, so an escaped backslash
    followed by the letters ``u001F`` stays untouched.
    """
    fixed_text = json
    for code in _LETTERED_ESCAPES:
        fixed_text = F.regexp_replace(
            fixed_text, rf"(?<!\\)((?:\\\\)*+)\\u00{code}", rf"$1\\u00{code.lower()}"
        )
    return F.when(json.rlike(r"\\u00(?:0[BEF]|1[A-F])"), fixed_text).otherwise(json)


def base64_text(column: Column) -> Column:
    """Base64 on one line, whatever the session's line-chunking setting."""
    return F.translate(F.base64(column), "\r\n", "")


def sorted_map(column: Column) -> Column:
    """The same map with its entries in key order."""
    return F.map_from_entries(F.array_sort(F.map_entries(column)))


def canonical_value(column: Column, dtype: T.DataType) -> Column:
    """``column`` with struct fields and map keys in sorted order at every level."""
    if isinstance(dtype, T.StructType):
        ordered = F.struct(
            *[
                canonical_value(column[f.name], f.dataType).alias(f.name)
                for f in sorted(dtype.fields, key=lambda f: f.name)
            ]
        )
        return F.when(column.isNotNull(), ordered)
    if isinstance(dtype, T.ArrayType):
        if isinstance(dtype.elementType, (T.StructType, T.ArrayType, T.MapType)):
            return F.transform(column, lambda x: canonical_value(x, dtype.elementType))
        return column
    if isinstance(dtype, T.MapType):
        return sorted_map(column)
    if isinstance(dtype, T.BinaryType):
        # Spark writes binary as base64 in JSON; make that explicit.
        return base64_text(column)
    return column


def json_of(column: Column) -> Column:
    """Canonical text of an already canonical struct, array or map."""
    return lower_control_escapes(F.to_json(column, _KEEP_NULLS))


def canonical_json(df: DataFrame, columns: Sequence[str] | None = None) -> Column:
    """Canonical JSON of the named columns (all by default) of each row of ``df``."""
    names = sorted(columns if columns is not None else df.columns)
    parts = [canonical_value(F.col(f"`{n}`"), df.schema[n].dataType).alias(n) for n in names]
    return json_of(F.struct(*parts))


def canonical_json_of(fields: Mapping[str, Column]) -> Column:
    """Canonical JSON of an object with scalar or already canonical values."""
    return json_of(F.struct(*[fields[name].alias(name) for name in sorted(fields)]))


def json_scalar(column: Column) -> Column:
    """JSON text of one scalar (quoted string, number, boolean or ``null``)."""
    wrapped = F.to_json(F.array(column), _KEEP_NULLS)
    return lower_control_escapes(F.substring(wrapped, F.lit(2), F.length(wrapped) - 2))


def json_object(pieces: Mapping[str, Column]) -> Column:
    """An object assembled from values that are already JSON text."""
    body: list[Column] = []
    for position, name in enumerate(sorted(pieces)):
        body.append(F.lit(("," if position else "") + f'"{name}":'))
        body.append(pieces[name])
    return F.concat(F.lit("{"), *body, F.lit("}"))


def json_array(items: Column) -> Column:
    """An array assembled from an array of JSON texts."""
    return F.concat(F.lit("["), F.array_join(items, ","), F.lit("]"))


def sha256_hex(column: Column) -> Column:
    return F.sha2(column, 256)


def content_id(prefix: str, fields: Mapping[str, Column]) -> Column:
    """``prefix`` + SHA-256 of the canonical JSON of ``fields``."""
    return F.concat(F.lit(prefix), sha256_hex(canonical_json_of(fields)))


def artifact_id(kind: Column, digest: Column) -> Column:
    """Identity of exact bytes; null for an unsupported kind."""
    return F.when(kind == "puzzle", F.concat(F.lit(fixed.PUZZLE_ARTIFACT_PREFIX), digest)).when(
        kind == "solution", F.concat(F.lit(fixed.SOLUTION_PREFIX), digest)
    )


def object_key(digest: Column) -> Column:
    return F.concat(
        F.lit("objects/sha256/"), F.substring(digest, 1, 2), F.lit("/"), F.substring(digest, 3, 62)
    )


def receipt_file_name(source_id: Column, revision: Column, path: Column) -> Column:
    """Name of the receipt file of one (source, revision, path)."""
    return F.concat(F.sha2(F.concat_ws("\0", source_id, revision, path), 256), F.lit(".json"))


def verification_id(
    puzzle_artifact_id: Column,
    solution_id: Column,
    implementation: Column,
    revision: Column,
    sha256: Column,
    profile: Column,
) -> Column:
    return content_id(
        fixed.VERIFICATION_PREFIX,
        {
            "puzzle_artifact_id": puzzle_artifact_id,
            "solution_id": solution_id,
            "verifier_implementation": implementation,
            "verifier_revision": revision,
            "verifier_sha256": sha256,
            "validation_profile": profile,
        },
    )


def normalized_id(solution_id: Column, puzzle_id: Column, version: Column) -> Column:
    return content_id(
        fixed.NORMALIZED_PREFIX,
        {"solution_id": solution_id, "puzzle_id": puzzle_id, "normalizer_version": version},
    )


def row_id(df: DataFrame, prefix: str, exclude: Sequence[str] = ()) -> Column:
    """Identity of a whole row, leaving out ``exclude`` (usually the id column itself)."""
    names = [c for c in df.columns if c not in set(exclude)]
    return F.concat(F.lit(prefix), sha256_hex(canonical_json(df, names)))


def lookup(column: Column, table: Mapping[object, object]) -> Column:
    """Value of a small fixed table; null when the key is absent."""
    pairs: list[Column] = []
    for key, value in table.items():
        pairs += [F.lit(key), F.lit(value)]
    return F.try_element_at(F.create_map(*pairs), column)


def rights_rank(column: Column) -> Column:
    return lookup(column, fixed.RIGHTS_RANK)


def collection_split(collection_id: Column) -> Column:
    return F.translate(collection_id, "-", "_")


def name_key(name: Column) -> Column:
    """Inventory key of an embedded name: upper case, other runs to ``_``, trimmed."""
    return F.regexp_replace(
        F.regexp_replace(F.upper(name), r"[^A-Z0-9]+", "_"), r"^_+|_+$", ""
    )


def base64_code(text: Column, decoded: Column) -> Column:
    """Why ``text`` is not canonical non-empty base64, else null.

    ``decoded`` is ``try_to_binary(text, 'base64')``.  Codes: invalid_base64,
    noncanonical_base64, empty_candidate.  Text that only decodes once foreign
    characters are dropped is non-canonical, not invalid.
    """
    d = "[A-Za-z0-9+/]"
    strict = text.rlike(rf"^{d}*={{0,2}}$") & (F.length(text) % 4 == 0)
    # A lenient decoder skips foreign characters and stray padding, and stops at
    # the first padding that completes a group.  The group loop is possessive:
    # it runs in constant stack on texts of any length.
    kept = F.regexp_replace(text, r"[^A-Za-z0-9+/=]", "")
    loosely_decodable = kept.rlike(
        rf"^(?:=*+{d}=*+{d}=?+{d}{d})*+(?:=*+$|=*+{d}=*+{d}(?:==|=?{d}=))"
    ) & kept.rlike(d)
    return (
        F.when(F.length(text) == 0, "empty_candidate")
        .when(strict & (base64_text(decoded) == text), F.lit(None).cast("string"))
        .when(~text.rlike(r"^[\x00-\x7F]*$"), "invalid_base64")
        .when(strict | loosely_decodable, "noncanonical_base64")
        .otherwise("invalid_base64")
    )


def strict_base64(text: Column) -> Column:
    """struct(code, payload) of base64 text; exactly one of the two is null."""
    decoded = F.try_to_binary(text, F.lit("base64"))
    code = base64_code(text, decoded)
    return F.struct(code.alias("code"), F.when(code.isNull(), decoded).alias("payload"))
