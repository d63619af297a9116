"""Geometry of blocks on a page."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def layout_hint(x0: Column, x1: Column, width: Column) -> Column:
    """struct(width_ratio, size_class, alignment); null without a box or a page width. Classes come from unrounded values."""
    ratio = F.greatest(F.lit(0.0), x1 - x0) / width
    shift = ((x0 + x1) / 2 - width / 2) / width
    size = F.when(ratio <= 0.36, "small").when(ratio <= 0.72, "medium").otherwise("large")
    side = F.when(F.abs(shift) <= 0.07, "center").when(shift < 0, "left").otherwise("right")
    return F.when(width > 0, F.struct(F.round(ratio, 4).alias("width_ratio"), size.alias("size_class"), side.alias("alignment")))


def aspect(width: Column, height: Column) -> Column:
    return F.round(width / height, 4)


def is_extreme(ratio: Column) -> Column:
    return (ratio < 0.35) | (ratio > 2.0)


def bbox(numbers: Column) -> Column:
    """struct(x0, y0, x1, y1) of an array of four numbers, else null."""
    four = (F.size(numbers) == 4) & ~F.exists(numbers, lambda x: x.isNull())
    return F.when(four, F.struct(*[F.get(numbers, F.lit(i)).alias(n) for i, n in enumerate(("x0", "y0", "x1", "y1"))]))


def layout_classes(hint: Column) -> Column:
    return F.coalesce(F.concat(F.lit("size-"), hint["size_class"], F.lit(" align-"), hint["alignment"]), F.lit("size-large align-center"))
