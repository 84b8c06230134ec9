"""Distributed LSD radix sort: ranks of rows by a composite key of whole numbers.

The key columns are laid side by side as one number of as many bits as their ranges need, and sorted digit by
digit from the lowest. A pass is a stable counting sort: rows are counted by digit and block of neighbouring
places; the place of a row after the pass is the number of rows with smaller digits, plus those with its digit
in earlier blocks, plus those before it in its own block. No task holds more than a block of one digit, and only
counts cross blocks. Every pass is written before the next one, so that a lost executor costs tasks, not passes.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from parcelflow.llm.shared import written

DIGIT_BITS = 10
#: Places of a block, as a power of two; a counting task meets at most one block of a digit at a time.
BLOCK_BITS = 13

SIGN = -(2**63)


@dataclass(frozen=True)
class Field:
    """A part of the composite key: not negative when seen as unsigned, ``bits`` wide."""

    value: Column
    bits: int


def fields_of(column: str, ascending: bool, least: int | None, most: int | None, nulls: int) -> list[Field]:
    """The fields of a key column, the more significant first; nulls sort last in either direction."""
    found = [Field(F.col(column).isNull().cast("bigint"), 1)] if nulls else []
    if least is None:
        return found
    value = F.col(column).cast("bigint")
    if most - least < 2**63:
        moved = value - F.lit(least) if ascending else F.lit(most) - value
        bits = (most - least).bit_length()
    else:
        # the difference does not fit: the order of unsigned numbers with the sign turned
        turned = value.bitwiseXOR(F.lit(SIGN))
        moved, bits = turned if ascending else F.bitwise_not(turned), 64
    return [*found, Field(F.coalesce(moved, F.lit(0).cast("bigint")), bits)] if bits else found


def digit(fields: list[Field], low: int, bits: int) -> Column:
    """Bits ``low`` to ``low + bits`` of the composite key; ``fields`` from the least significant."""
    parts, at = [], 0
    for field in fields:
        first, last = max(low, at), min(low + bits, at + field.bits)
        if first < last:
            cut = F.shiftrightunsigned(field.value, first - at).bitwiseAND(F.lit(2 ** (last - first) - 1).cast("bigint"))
            parts.append(F.shiftleft(cut, first - low))
        at += field.bits
    return sum(parts[1:], parts[0])


def counting_pass(rows: DataFrame, by: Column) -> DataFrame:
    """New places in ``_at`` by a digit, stable in the old ones."""
    placed = rows.withColumns({"_digit": by, "_block": F.shiftright("_at", BLOCK_BITS)})
    counts = placed.groupBy("_digit", "_block").agg(F.count(F.lit(1)).alias("_n"))
    earlier = Window.partitionBy("_digit").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    # one row for each value of a digit, at most 2 ** DIGIT_BITS
    smaller = counts.groupBy("_digit").agg(F.sum("_n").alias("_all")).selectExpr(
        "_digit", "coalesce(sum(_all) OVER (ORDER BY _digit ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS _smaller"
    )
    before = (
        counts.withColumn("_earlier", F.coalesce(F.sum("_n").over(earlier), F.lit(0)))
        .join(F.broadcast(smaller), "_digit")
        .select("_digit", "_block", (F.col("_smaller") + F.col("_earlier")).alias("_start"))
    )
    own = F.row_number().over(Window.partitionBy("_digit", "_block").orderBy("_at"))
    return (
        placed.withColumn("_own", own).join(before, ["_digit", "_block"])
        .select(*[c for c in rows.columns if c != "_at"], (F.col("_start") + F.col("_own") - 1).alias("_at"))
    )


def with_ranks(rows: DataFrame, key: list[tuple[str, bool]], rank: str = "rank") -> DataFrame:
    """The rows with their rank (1, 2, 3 ...) by the key: (column, ascending), the most significant first.

    Key columns are whole numbers of up to 64 bits; nulls rank last. Rows with equal keys have neighbouring ranks
    in no certain order: give a key that tells different rows apart. Columns of any type are carried along; none
    may be called _at, _digit, _block or _own. An empty table gives no rows.
    """
    current = written(rows.withColumn("_at", F.monotonically_increasing_id()), "radix-0")
    bounds = current.agg(
        *[f(F.col(c).cast("bigint")).alias(f"{name}_{i}") for i, (c, _) in enumerate(key) for name, f in (("least", F.min), ("most", F.max))],
        *[F.count_if(F.col(c).isNull()).alias(f"nulls_{i}") for i, (c, _) in enumerate(key)],
    ).first()
    fields: list[Field] = []
    for i, (column, ascending) in enumerate(key):
        fields += fields_of(column, ascending, bounds[f"least_{i}"], bounds[f"most_{i}"], bounds[f"nulls_{i}"])
    fields.reverse()
    width = max(1, sum(f.bits for f in fields))
    passes = -(-width // DIGIT_BITS)
    bits = -(-width // passes)
    for n in range(passes):
        by = digit(fields, n * bits, min(bits, width - n * bits)) if fields else F.lit(0).cast("bigint")
        current = written(counting_pass(current, by), f"radix-{n + 1}")
    return current.select(*rows.columns, (F.col("_at") + 1).alias(rank))
