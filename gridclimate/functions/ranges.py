"""Nested blocks: 1, 4, 16, ... neighbouring positions, starting at multiples of their size.

Any range of positions is the union of at most six blocks of each size, so a sum over a range
needs only a few sums per size, once the sums of all blocks are at hand; and there are only a
third more blocks than positions. Positions count from 0. A block is named by one number made of
its index and its level: level 0 has blocks of 1, level 1 of 4, and so on.
"""

from pyspark.sql import Column
from pyspark.sql import functions as F

BITS = 2  # a block holds 2 ** BITS blocks of the level below
LEVELS = 32  # block numbers are whole up to positions of 58 bits


def top_level(last_position: Column) -> Column:
    """A level whose first block alone holds all positions up to the last."""
    return F.ceil(F.length(F.bin(last_position)) / BITS).cast("int")


def block_holding(position: Column, level: Column) -> Column:
    """The block of a level that holds a position."""
    return F.call_function("shiftright", position, level * BITS) * LEVELS + level


def blocks_covering(first: str, last: str) -> Column:
    """The fewest blocks that together hold just ``first`` to ``last``; none if first > last.

    Of the whole blocks inside the range, a level takes those at both ends that belong to no
    whole block of the next level; the others are left to higher levels. ``first`` and ``last``
    name columns.
    """

    def inside(level: str) -> tuple[str, str]:
        """Least and greatest index of the blocks of a level that lie inside the range."""
        return (
            f"(-shiftright(-{first}, ({level}) * {BITS}))",
            f"(shiftright({last} + 1, ({level}) * {BITS}) - 1)",
        )

    def run(least: str, greatest: str) -> str:
        counted = f"sequence({least}, {greatest})"  # it would count down where least > greatest
        return f"IF({least} <= {greatest}, {counted}, CAST(array() AS ARRAY<BIGINT>))"

    least, greatest = inside("level")
    above_least, above_greatest = inside("level + 1")
    goes_on = f"{above_least} <= {above_greatest}"
    left_end = f"IF({goes_on}, {above_least} * {2**BITS} - 1, {greatest})"
    right_end = f"IF({goes_on}, ({above_greatest} + 1) * {2**BITS}, {greatest} + 1)"
    taken = f"concat({run(least, left_end)}, {run(right_end, greatest)})"
    top = f"CAST(ceil(length(bin(greatest({last}, 0))) / {BITS}) AS INT)"
    return F.expr(
        f"flatten(transform(sequence(0, {top}), level ->"
        f" transform({taken}, index -> index * {LEVELS} + level)))"
    )
