"""Other columns travel through a Python kernel as one column, so that their names never clash."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class Carry:
    """Columns ``keep`` of ``df`` beside those that a kernel makes, which replace columns of their name."""

    def __init__(self, df: DataFrame, keep: list[str], made: str):
        names = [x.split()[0] for x in made.split(", ")]
        self.names, self.made, self.results = [c for c in keep if c not in names], made, names
        self.column: Column = F.struct(*(F.col(f"`{c}`") for c in self.names)) if self.names else F.struct(F.lit(0).alias("none"))
        kind = df.select(self.column.alias("row")).schema["row"].dataType.simpleString()
        self.ddl = f"row {kind}, {made}"

    def run(self, inputs: DataFrame, kernel) -> DataFrame:
        """``inputs`` has ``row`` and what the kernel reads; the kernel gives ``row`` and what it makes."""
        out = inputs.mapInArrow(kernel, self.ddl)
        return out.select(*(F.col("row").getField(c).alias(c) for c in self.names), *self.results)
