"""References of any number of tables settled in one shuffle.

Parents and references are one tagged stream of (space, id, scope).  Per (space, id) a hash
aggregate, combined in the tasks, keeps whether a parent is there and the extremes of two
64-bit hashes of the scopes on both sides.  Ids that are known, and whose scopes all agree,
are settled by that.  Only the other ids, the suspects, are written and meet rows again
(few are broadcast by their measured size): their references are fetched, and where a scope is in question it is compared with the parents' own scopes.
Where suspects are too many to be broadcast, their bits in at most 16 MB are, and rows that
cannot be references of a suspect are left out before the others are shuffled.
So a clean table costs one shuffle of one row per id and task, however often an id is used.

A reference without an id refers to nothing that can be known.  A scope asks that the parent
is there in the same scope (an artifact of the same puzzle); null scopes agree with each other.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import stored
from .checks import VIOLATION, union_all


def _text(column: Column | str | None) -> Column:
    return F.lit(None).cast("string") if column is None else (F.col(column) if isinstance(column, str) else column).cast("string")


def parent(rows: DataFrame, space: str, id_: Column | str, scope: Column | str | None = None) -> DataFrame:
    """Parents of one space: what references may name."""
    return rows.select(F.lit(space).alias("space"), _text(id_).alias("id"), _text(scope).alias("scope"), F.lit(scope is not None).alias("scoped"))


def reference(
    space: str, id_: Column | str, missing: tuple[str, Column | str], scope: Column | str | None = None,
    other: tuple[str, Column | str] | None = None, when: Column | None = None, every: bool = False,
) -> Column:
    """What one row refers to: codes and details for a parent that is missing, and for one in another scope.

    One parent in the scope is enough, or with ``every`` each parent in another scope is a violation.
    """
    text = lambda x: F.lit(x) if isinstance(x, str) else x.cast("string")
    made = F.struct(
        F.lit(space).alias("space"), _text(id_).alias("id"), _text(scope).alias("scope"), F.lit(other is not None).alias("scoped"), F.lit(every).alias("every"),
        F.lit(missing[0]).alias("code"), text(missing[1]).alias("detail"),
        (F.lit(other[0]) if other else _text(None)).alias("other_code"), (text(other[1]) if other else _text(None)).alias("other_detail"),
    )
    return made if when is None else F.when(when, made)


def references(rows: DataFrame, path: str, row_key: Column | str, made: Sequence[Column]) -> DataFrame:
    """All references of a table, from one scan."""
    listed = rows.select(_text(row_key).alias("row_key"), F.explode(F.array_compact(F.array(*made))).alias("r"))
    return listed.select(F.lit(path).alias("path"), "row_key", "r.*")


#: Suspects up to this number meet rows without a filter (Spark broadcasts about twice as many).
FEW = 1_000_000
#: Bitmaps of 4 KB that hold the bits of all suspects, 16 MB in all.
BITMAPS = 4096


def _place() -> Column:
    """Number of the bit of a (space, id)."""
    return F.pmod(F.xxhash64("space", "id"), F.lit(BITMAPS * 32768))


def possible(rows: DataFrame, suspects: DataFrame) -> DataFrame:
    """``rows`` without those that refer to no suspect; some of the others remain, and are left to a join.

    Bits of the suspects are gathered by a combined aggregate; their broadcast has a fixed bound.
    """
    at = _place()
    bits = suspects.groupBy(F.bitmap_bucket_number(at).alias("_bitmap")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(at)).alias("_bits"))
    position = F.bitmap_bit_position(at)
    byte = F.conv(F.hex(F.substring("_bits", (position / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    placed = rows.withColumn("_bitmap", F.bitmap_bucket_number(at))
    held = placed.join(F.broadcast(bits), "_bitmap").where(F.getbit(byte, (position % 8).cast("int")) == 1)
    return held.select(*rows.columns)


def presence_violations(parents: Sequence[DataFrame], children: Sequence[DataFrame]) -> DataFrame:
    """Violations of the references of ``children`` (of ``references``) to ``parents`` (of ``parent``)."""
    known, asked = union_all(list(parents)), union_all(list(children))
    facts = known.select("space", "id", "scope", "scoped", F.lit(True).alias("p")).unionByName(
        asked.select("space", "id", "scope", "scoped", F.lit(False).alias("p"))
    ).where("id IS NOT NULL")
    sums = [F.max("p").alias("known"), F.min("p").alias("parents_only")]
    agree = F.lit(True)
    for salt in (0, 1):
        # Two hashes: scopes that differ in neither are the same.
        h = F.when(F.col("scoped"), F.xxhash64(F.coalesce("scope", F.lit("")), F.col("scope").isNull(), F.lit(salt)))
        ours, theirs = F.when(F.col("p"), h), F.when(~F.col("p"), h)
        names = [f"{side}{end}{salt}" for side in "pc" for end in ("low", "high")]
        sums += [F.min(ours).alias(names[0]), F.max(ours).alias(names[1]), F.min(theirs).alias(names[2]), F.max(theirs).alias(names[3])]
        one = (F.col(names[0]) == F.col(names[1])) & (F.col(names[2]) == F.col(names[3])) & (F.col(names[0]) == F.col(names[2]))
        agree = agree & (F.col(names[2]).isNull() | F.coalesce(one, F.lit(False)))
    settled = facts.groupBy("space", "id").agg(*sums)
    suspects = settled.where(~F.col("parents_only") & ~(F.col("known") & agree)).select("space", "id", "known")
    suspects = stored(suspects, "suspects")
    shown = [f.name for f in VIOLATION.fields]
    nameless = asked.where("id IS NULL").select(*shown)
    if suspects.count() > FEW:
        asked = possible(asked, suspects)
    # Details mostly end in the id, which travels as the key already.
    ends = F.coalesce(F.endswith("detail", "id"), F.lit(False))
    head = F.when(ends, F.left("detail", F.length("detail") - F.length("id"))).otherwise(F.col("detail"))
    unknown = asked.select("space", "id", "code", head.alias("detail"), ends.alias("ends"), "path", "row_key").join(suspects.where("NOT known"), ["space", "id"])
    missing = unknown.withColumn("detail", F.when(F.col("ends"), F.concat("detail", "id")).otherwise(F.col("detail"))).select(*shown)
    met = asked.join(suspects, ["space", "id"])
    owners = known.where("scoped").join(suspects.where("known"), ["space", "id"], "left_semi").select("space", "id", F.col("scope").alias("own"))
    doubtful = met.where("known AND scoped").drop("known").withColumnRenamed("scope", "asked")
    same = F.col("asked").eqNullSafe(F.col("own"))
    on = (F.col("m.space") == F.col("o.space")) & (F.col("m.id") == F.col("o.id"))
    none = doubtful.where("NOT every").alias("m").join(owners.distinct().alias("o"), on & same, "left_anti")
    each = doubtful.where("every").alias("m").join(owners.alias("o"), on & ~same)
    others = [x.select(F.col("m.other_code").alias("code"), F.col("m.other_detail").alias("detail"), "m.path", "m.row_key") for x in (none, each)]
    return union_all([nameless, missing, *others])
