"""Normalized structure of decoded solutions, in built-in expressions only."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import fixed_values as fixed
from ..functions.canonical import normalized_id
from ..functions.nested import opcode_name, ordinal_name


def declared_metrics(parsed: Column) -> Column:
    """Metrics a solution file claims for itself; null unless it says it is solved."""
    return F.when(
        parsed["solved"],
        F.struct(
            parsed["declared_cycles"].alias("cycles"), parsed["declared_cost"].alias("cost"),
            parsed["declared_area"].alias("area"), parsed["declared_instructions"].alias("instructions"),
        ),
    )


def _parameters(part: Column) -> Column:
    base = {
        "size": part["size"],
        "input_output_index": part["input_output_index"],
        "arm_number": part["arm_number"],
    }
    piped = {**base, "conduit_id": part["conduit_id"], "conduit_offsets": part["conduit_offsets"]}
    # Numbers alone hold no control characters, so their JSON is canonical as it is.
    text = lambda fields: F.to_json(F.struct(*[fields[name].alias(name) for name in sorted(fields)]), {"ignoreNullFields": "false"})
    return F.when(part["conduit_id"].isNotNull(), text(piped)).otherwise(text(base))


def _by_cycle(steps: Column) -> Column:
    """Steps in cycle order; equal cycles keep their place."""
    placed = F.transform(
        steps, lambda s, i: F.struct(s["cycle"].alias("cycle"), i.alias("i"), s["opcode"].alias("opcode"))
    )
    return F.transform(
        F.sort_array(placed),
        lambda s: F.struct(s["cycle"].cast("bigint").alias("cycle"), opcode_name(s["opcode"]).alias("opcode")),
    )


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once, however often the body uses it."""
    return F.transform(F.array(value), body)[0]


def runs(items: Column) -> Column:
    """Entries (key, value) of each distinct item and its count, in key order; null items are not counted.

    One pass over the sorted list marks where runs begin, one over the runs measures them.
    """
    def of_runs(ordered: Column, starts: Column) -> Column:
        stop = lambda k: F.coalesce(F.get(starts, k + 1), F.size(ordered) + 1)
        return F.transform(
            starts, lambda at, k: F.struct(F.element_at(ordered, at).alias("key"), (stop(k) - at).cast("bigint").alias("value"))
        )

    def counted(ordered: Column) -> Column:
        places = F.when(F.size(ordered) > 0, F.sequence(F.lit(1), F.size(ordered))).otherwise(F.array().cast("array<int>"))
        opens = lambda at: (at == 1) | (F.element_at(ordered, at) != F.element_at(ordered, F.greatest(at - 1, F.lit(1))))
        return _let(F.filter(places, opens), lambda starts: of_runs(ordered, starts))

    return _let(F.sort_array(F.filter(items, lambda x: x.isNotNull())), counted)


def histogram(items: Column) -> Column:
    """Map of each distinct item to its count, in key order; null items are not counted."""
    return F.when(items.isNotNull(), F.map_from_entries(runs(items)))


def opcode_histogram(opcodes: Column) -> Column:
    """Map of instruction names to counts: opcodes are counted as numbers, and named once each."""
    first: dict[str, int] = {}
    for symbol, name in fixed.OPCODE_NAMES.items():
        first.setdefault(name, ord(symbol))
    # Symbols of one instruction are counted as its first one.
    one = lambda op: F.coalesce(*[F.when(op == ord(s), F.lit(first[n])) for s, n in fixed.OPCODE_NAMES.items() if ord(s) != first[n]], op)
    named = F.transform(runs(F.transform(opcodes, one)), lambda e: F.struct(opcode_name(e["key"]).alias("key"), e["value"].alias("value")))
    return F.map_from_entries(F.array_sort(named))


def grouped_histogram(rows: DataFrame, group: str, item: str, name: str = "histogram") -> DataFrame:
    """One sorted map per group; counts are aggregated by (group, item) before packing."""
    counts = rows.groupBy(group, item).agg(F.count(F.lit(1)).alias("n"))
    return counts.groupBy(group).agg(
        F.map_from_entries(F.array_sort(F.collect_list(F.struct(F.col(item).alias("key"), F.col("n").alias("value"))))).alias(name)
    )


def normalization_error(parsed: Column) -> Column:
    """First reason decoded structure cannot be normalized, else null."""
    parts = parsed["parts"]
    return (
        F.when(F.exists(parts, lambda p: p["name"] == ""), "empty_part_type")
        .when(
            F.exists(parts, lambda p: (p["name"] == "track") & (F.size(p["track_offsets"]) == 0)), "empty_track"
        )
        .when(
            F.exists(parts, lambda p: F.exists(p["instructions"], lambda s: s["cycle"] < 0)), "negative_cycle"
        )
    )


def normalize_solutions(
    decoded: DataFrame, solution_id: str = "artifact_id", puzzle_id: str = "puzzle_id",
    version: str = fixed.NORMALIZER_VERSION, summaries: Sequence[str] | None = None,
) -> DataFrame:
    """Normalized row of each decoded solution; ``error`` marks rows to quarantine.

    ``summaries`` names the fields of that column to work out (all by default): Spark computes
    a whole struct of which several fields are read.
    """
    rows = decoded.where("parsed IS NOT NULL")
    raw = F.col("parsed.parts")
    is_track = lambda p: p["name"] == "track"
    parts = F.transform(
        raw,
        lambda p, i: F.struct(
            ordinal_name("part", i).alias("part_id"),
            p["name"].alias("type"),
            p["x"].alias("x"),
            p["y"].alias("y"),
            F.when(is_track(p), 0).otherwise(F.pmod(p["rotation"], F.lit(6))).alias("rotation"),
            _parameters(p).alias("parameters"),
        ),
    )
    # Every decoded part is read where it stands: lambdas copy what they give back.
    tracks = F.array_compact(F.transform(raw, lambda p, i: F.when(
        is_track(p),
        F.struct(
            ordinal_name("track", i).alias("track_id"),
            F.transform(
                p["track_offsets"], lambda o: F.struct((p["x"] + o["x"]).alias("x"), (p["y"] + o["y"]).alias("y"))
            ).alias("coordinates"),
        ),
    )))
    programs = F.array_compact(F.transform(raw, lambda p, i: F.when(
        F.size(p["instructions"]) > 0,
        F.struct(ordinal_name("part", i).alias("arm_id"), _by_cycle(p["instructions"]).alias("instructions")),
    )))
    # Counts are taken from the decoded structure, so that no normalized column is worked out twice.
    opcodes = F.flatten(F.transform(raw, lambda p: F.transform(p["instructions"], lambda s: s["opcode"])))
    total = lambda size: F.aggregate(raw, F.lit(0).cast("bigint"), lambda a, p: a + size(p))
    every = {
        "part_count": F.size(raw).cast("bigint"),
        "track_count": F.size(F.filter(raw, is_track)).cast("bigint"),
        "track_hex_count": total(lambda p: F.when(is_track(p), F.size(p["track_offsets"])).otherwise(0)),
        "program_count": F.size(F.filter(raw, lambda p: F.size(p["instructions"]) > 0)).cast("bigint"),
        "instruction_count": total(lambda p: F.size(p["instructions"])),
        "part_type_histogram": histogram(F.transform(raw, lambda p: p["name"])),
        "opcode_histogram": opcode_histogram(opcodes),
    }
    rows = rows.select(
        F.col(solution_id).alias("solution_id"),
        F.col(puzzle_id).alias("puzzle_id"),
        parts.alias("parts"),
        tracks.alias("tracks"),
        programs.alias("programs"),
        F.struct(*[c.alias(name) for name, c in every.items() if summaries is None or name in summaries]).alias("summaries"),
        normalization_error(F.col("parsed")).alias("error"),
    )
    return rows.select(
        normalized_id(F.col("solution_id"), F.col("puzzle_id"), F.lit(version)).alias("normalized_solution_id"),
        "solution_id",
        "puzzle_id",
        F.lit(version).alias("normalizer_version"),
        "parts",
        "tracks",
        "programs",
        "summaries",
        "error",
    )

