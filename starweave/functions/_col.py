from pyspark.sql import Column, functions as F


def col(c: "Column | str") -> Column:
    return F.col(c) if isinstance(c, str) else c
