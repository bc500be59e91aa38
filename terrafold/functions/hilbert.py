"""Position of a cell on a Hilbert curve over a 65,536 by 65,536 grid."""

from __future__ import annotations

from functools import cache

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ORDER = 16
SIDE = (1 << ORDER) - 1
_BITS = 4


def grid_cell(value: Column, low: Column, high: Column) -> Column:
    """Column or row of the grid: 0 for an extent without width, never null."""
    scaled = F.floor((value - low) / (high - low) * F.lit(float(SIDE)))
    cell = F.when(high > low, F.least(F.lit(SIDE), F.greatest(F.lit(0), scaled)))
    return F.coalesce(cell, F.lit(0)).cast("int")


@cache
def turns() -> tuple[int, ...]:
    """What four levels of the curve do, for every frame and every four bits of x and y.

    The frame says whether x and y are exchanged and whether both are mirrored. Each
    level gives a digit, 3·right XOR upper; the lower half exchanges, its right side
    also mirrors. An entry is the frame left behind, times 256, plus four digits.
    """
    entries = []
    for frame in range(4):
        for x in range(1 << _BITS):
            for y in range(1 << _BITS):
                exchanged, mirrored, digits = frame & 1, frame >> 1, 0
                for level in reversed(range(_BITS)):
                    right = (x >> level & 1) ^ mirrored
                    upper = (y >> level & 1) ^ mirrored
                    if exchanged:
                        right, upper = upper, right
                    digits = digits * 4 + ((3 * right) ^ upper)
                    if not upper:
                        exchanged ^= 1
                        mirrored ^= right
                entries.append((mirrored * 2 + exchanged) * 256 + digits)
    return tuple(entries)


def walk_curve(df: DataFrame, cell_x: str, cell_y: str, key: str) -> DataFrame:
    """Add the curve position of two grid columns, which are consumed.

    Four levels at a time by one lookup in a constant array: the sixteen levels written
    out took many times as long.
    """
    kept = [c for c in df.columns if c not in (cell_x, cell_y)]
    # Folded to one constant when the plan is optimised.
    table = F.split(F.lit(",".join(map(str, turns()))), ",").cast("array<int>")
    mask = F.lit((1 << _BITS) - 1)
    done: list[str] = []
    for shift in range(ORDER - _BITS, -1, -_BITS):
        x = F.shiftright(cell_x, shift).bitwiseAND(mask)
        y = F.shiftright(cell_y, shift).bitwiseAND(mask)
        cell = F.shiftleft(x, _BITS).bitwiseOR(y)
        if done:
            cell = F.col(done[-1]).bitwiseAND(F.lit(0x300)).bitwiseOR(cell)
        name = f"__h{shift}"
        df = df.select("*", F.coalesce(F.get(table, cell), F.lit(0)).alias(name))
        done.append(name)
    position = F.lit(0).cast("bigint")
    for name in done:
        position = F.shiftleft(position, 2 * _BITS).bitwiseOR(
            F.col(name).bitwiseAND(F.lit(0xFF)).cast("bigint")
        )
    return df.select(*kept, position.alias(key))
