"""Wide ids as 32-bit integers, refused where they do not fit, whatever the ANSI setting."""

from pyspark.sql import Column, functions as F

LOWEST, HIGHEST = -(1 << 31), (1 << 31) - 1


def as_int(column: Column, name: str) -> Column:
    message = F.concat(F.lit(f"{name} does not fit 32 bits: "), column.cast("string"))
    fits = column.isNull() | column.between(LOWEST, HIGHEST)
    return F.when(fits, column.cast("int")).otherwise(F.raise_error(message).cast("int"))
