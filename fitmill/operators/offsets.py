"""Character offsets of the pieces of a cut text, without a window or a shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLOCK = 32
BASES = "_bases"


def with_bases(df: DataFrame, pieces: str) -> DataFrame:
    """Add the offset at which every block of ``BLOCK`` pieces begins.

    Only one number per block is kept, so the cost stays linear for long texts.
    """
    pc = F.col(pieces)
    blocks = F.sequence(F.lit(0), F.floor((F.size(pc) - 1) / BLOCK).cast("int"))
    bases = F.aggregate(
        blocks, F.array(F.lit(0)),
        lambda acc, b: F.concat(acc, F.array(
            F.element_at(acc, -1)
            + F.char_length(F.array_join(F.slice(pc, b * BLOCK + 1, BLOCK), "")))))
    return df.withColumn(BASES, bases)


def offset_of(pieces: str, pos: Column) -> Column:
    """0-based character offset of the piece at 0-based index ``pos``."""
    block = F.floor(pos / BLOCK).cast("int")
    inside = F.array_join(F.slice(F.col(pieces), block * BLOCK + 1, pos % BLOCK), "")
    return F.get(F.col(BASES), block) + F.char_length(inside)
