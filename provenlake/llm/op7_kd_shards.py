"""K-d tree shards of near equal bytes, in DataFrame functions only.

A node is a range of shards.  It is split at the weighted median (in bytes) of the
metadata dimension in which its rows lie widest, until every leaf is one shard.
The median of all nodes of a level is found by a radix descent: byte sums per
16-bit digit of the coordinate are combined map-side, a window over at most
65,536 digits per node finds the digit that holds the median, and the next pass
looks only inside it.  The coordinate ends in 32 bits of a row hash, so a value
shared by a third of all rows is split like any other.

Texts are read once, for their size and checksum; the narrow table of coordinates
is written to the shared folder and all passes read that.

Defined cases: a null text has size 1.  Null metadata lie at coordinate 0.  Rows with
equal or null ids are rows of their own; wholly equal rows may be split by the slot
order only.  Fewer rows than shards leave shards empty.  An empty table gives no
row.  Other columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .staging import staged

#: Rows numbered in one window partition of a shard, on average.
SLOT_ROWS = 100_000
#: A median is searched until the bytes that share its digits are below this share of a shard.
TOLERANCE = 1 / 1000
_DIGIT, _DIGITS = 16, 4
_VALUE_BITS, _TIE_BITS = 31, 32


def _scaled(value: Column, low: float, high: float) -> Column:
    """A number's place between ``low`` and ``high`` as an integer of 31 bits."""
    top = (1 << _VALUE_BITS) - 1
    if high <= low:
        return F.lit(0).cast("long")
    return F.coalesce(F.floor((value - F.lit(low)) / F.lit(high - low) * F.lit(top)).cast("long"), F.lit(0).cast("long"))


def _coordinates(rows: DataFrame, numbers: list[str], names: list[str]) -> DataFrame:
    """``rows`` with one 31-bit coordinate ``_d<i>`` per dimension.

    Numbers keep their order; names (sources, languages) are spread by a hash, equal
    names together.
    """
    bounds = rows.agg(
        *[f(F.col(c).cast("double")).alias(f"{c}_{n}") for c in numbers for f, n in ((F.min, "low"), (F.max, "high"))]
    ).first()
    dims = [_scaled(F.col(c).cast("double"), bounds[f"{c}_low"] or 0.0, bounds[f"{c}_high"] or 0.0) for c in numbers]
    dims += [
        F.when(F.col(c).isNull(), 0).otherwise(F.pmod(F.xxhash64(c), F.lit((1 << _VALUE_BITS) - 1)) + 1).cast("long") for c in names
    ]
    return rows.select("*", *[d.alias(f"_d{i}") for i, d in enumerate(dims)])


class Tree:
    """Splits of shard ranges; a row's node is one nested condition of as many tests as there are splits."""

    def __init__(self, n_shards: int) -> None:
        self.n_shards = n_shards
        self.splits: dict[tuple[int, int], tuple[int, int]] = {}

    def leaves(self) -> list[tuple[int, int]]:
        out, todo = [], [(0, self.n_shards)]
        while todo:
            low, high = todo.pop()
            if (low, high) in self.splits:
                todo += [(low, (low + high) // 2), ((low + high) // 2, high)]
            else:
                out.append((low, high))
        return sorted(out)

    def value(self, leaf, span: tuple[int, int] | None = None) -> Column:
        """``leaf(low, high)`` of the node that a row lies in."""
        low, high = span or (0, self.n_shards)
        if (low, high) not in self.splits:
            return leaf(low, high)
        dim, threshold = self.splits[low, high]
        middle = (low + high) // 2
        return F.when(_key(dim) > threshold, self.value(leaf, (middle, high))).otherwise(self.value(leaf, (low, middle)))


def _key(dim: int) -> Column:
    """Coordinate and tie hash as one integer of 63 bits."""
    return F.shiftleft(f"_d{dim}", _TIE_BITS).bitwiseOR(F.col("_tie"))


def _grow(rows: DataFrame, tree: Tree, n_dims: int, tolerance: float) -> bool:
    """Split every node of more than one shard; False when there is none.

    Only sums per node come to the driver, at most one row per shard and pass.
    """
    open_nodes = {low: high for low, high in tree.leaves() if high - low > 1}
    if not open_nodes:
        return False
    low_of = tree.value(lambda low, high: F.lit(low if low in open_nodes else None).cast("int"))
    spans = {
        r["_low"]: r
        for r in rows.select(low_of.alias("_low"), "size", *[f"_d{i}" for i in range(n_dims)])
        .where("_low IS NOT NULL").groupBy("_low").agg(
            F.sum("size").alias("bytes"), *[(F.max(f"_d{i}") - F.min(f"_d{i}")).alias(f"s{i}") for i in range(n_dims)]
        ).collect()
    }
    # Nodes without rows keep all of them on the left.
    top = (1 << (_VALUE_BITS + _TIE_BITS)) - 1
    widest = {low: max(range(n_dims), key=lambda i: (r[f"s{i}"], -i)) for low, r in spans.items()}
    # The left half gets its share of the shards' bytes.
    goal = {low: r["bytes"] * ((low + open_nodes[low]) // 2 - low) / (open_nodes[low] - low) for low, r in spans.items()}
    keyed = rows.select(
        low_of.alias("_low"), "size", tree.value(lambda low, high: _key(widest[low]) if low in widest else F.lit(None).cast("long")).alias("_key"),
    ).where("_key IS NOT NULL")
    prefix, below, exact = dict.fromkeys(spans, 0), dict.fromkeys(spans, 0), set()
    for digit in range(_DIGITS):
        live = [low for low in spans if low not in exact]
        if not live:
            break
        shift = _DIGIT * (_DIGITS - 1 - digit)

        def of_node(values: dict, live=live) -> Column:
            out = F.lit(None)
            for low in live:
                out = F.when(F.col("_low") == low, F.lit(values[low])).otherwise(out)
            return out

        inside = keyed.where(F.shiftright("_key", shift + _DIGIT) == of_node(prefix)) if digit else keyed
        sums = inside.groupBy("_low", F.shiftright("_key", shift).bitwiseAND(F.lit((1 << _DIGIT) - 1)).alias("_digit")).agg(
            F.sum("size").alias("_bytes")
        )
        running = Window.partitionBy("_low").orderBy("_digit")
        found = (
            sums.withColumn("_upto", F.sum("_bytes").over(running))
            .where(F.col("_upto") >= of_node({low: float(goal[low] - below[low]) for low in live}))
            .groupBy("_low").agg(F.min(F.struct("_digit", "_upto", "_bytes")).alias("hit"))
        )
        for r in found.collect():
            low, hit = r["_low"], r["hit"]
            prefix[low] = (prefix[low] << _DIGIT) | hit["_digit"]
            below[low] += hit["_upto"] - hit["_bytes"]
            if hit["_bytes"] <= tolerance or digit == _DIGITS - 1:
                # Whichever side of the digit is nearer.
                near = prefix[low] if below[low] + hit["_bytes"] - goal[low] <= goal[low] - below[low] else prefix[low] - 1
                prefix[low] = ((near + 1) << shift) - 1
                exact.add(low)
    for low, high in open_nodes.items():
        tree.splits[low, high] = (widest.get(low, 0), prefix.get(low, top))
    return True


def kd_shards(
    docs: DataFrame, n_shards: int | None = None, target_bytes: int | None = None,
    id_column: str = "doc_id", text_column: str = "text", numbers: tuple[str, ...] = ("n_chars",), names: tuple[str, ...] = ("source", "lang"),
    tolerance: float = TOLERANCE,
) -> DataFrame:
    """(id, size, text_crc32, shard, slot) of every row.

    Give the number of shards, or the bytes that a shard should reach.  Numbers are
    dimensions besides the id and the logarithm of the size.
    """
    numbers, names = [c for c in numbers if c in docs.columns], [c for c in names if c in docs.columns]
    text = F.col(text_column).cast("string")
    base = docs.select(
        F.col(id_column).alias("_id"),
        (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(F.coalesce(text, F.lit("")).cast("binary")).alias("text_crc32"),
        *[F.log1p(F.greatest(F.col(c), F.lit(0)).cast("double")).alias(f"_n{i}") for i, c in enumerate(numbers)],
        *[F.col(c).alias(f"_s{i}") for i, c in enumerate(names)],
    )
    base = base.withColumns({
        "_place": F.col("_id").cast("double"),
        "_log_size": F.log("size"),
        "_tie": F.pmod(F.xxhash64("_id", "text_crc32", F.monotonically_increasing_id()), F.lit(1 << _TIE_BITS)),
    })
    written = staged(base, "metadata")
    total = written.agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("rows")).first()
    if n_shards is None:
        n_shards = max(1, math.ceil((total["bytes"] or 0) / target_bytes))
    dims = ["_place", "_log_size", *[f"_n{i}" for i in range(len(numbers))]]
    rows = _coordinates(written, dims, [f"_s{i}" for i in range(len(names))])
    tree, n_dims = Tree(n_shards), len(dims) + len(names)
    while _grow(rows, tree, n_dims, tolerance * (total["bytes"] or 0) / n_shards):
        pass
    shard = tree.value(lambda low, high: F.lit(low))
    narrow = rows.select("_id", "size", "text_crc32", "_tie", shard.cast("int").alias("shard"))
    return _slotted(narrow, n_shards, total["rows"]).select(
        F.col("_id").alias(id_column), "size", "text_crc32", "shard", "slot"
    )


def _slotted(rows: DataFrame, n_shards: int, n_rows: int) -> DataFrame:
    """A gapless ``slot`` from 0 in every shard: numbered in parts, each after the rows of the earlier parts."""
    parts = max(1, math.ceil(n_rows / n_shards / SLOT_ROWS))
    dealt = rows.withColumn("_part", F.shiftright(F.col("_tie") * parts, _TIE_BITS).cast("int"))
    sizes = dealt.groupBy("shard", "_part").agg(F.count(F.lit(1)).alias("_n"))
    earlier = Window.partitionBy("shard").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("shard", "_part", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    inside = Window.partitionBy("shard", "_part").orderBy("_tie", "_id", "text_crc32")
    return (
        dealt.join(starts, ["shard", "_part"])
        .withColumn("slot", (F.col("_before") + F.row_number().over(inside) - 1).cast("long"))
    )
