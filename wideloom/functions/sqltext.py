"""Wide projections written as SQL expression text.

Building a Column object costs several Python<->JVM round trips per function
call; a 137-column projection built that way spends seconds on the driver.
``project`` sends each column as one SQL text (``selectExpr``): one round
trip per column, parsed on the JVM side, and the same plan as a select.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame


def q(name: str) -> str:
    """Quoted identifier."""
    return "`" + name.replace("`", "``") + "`"


def s(text: str) -> str:
    """SQL string literal."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def project(df: DataFrame, pairs: Sequence[tuple[str, str]]) -> DataFrame:
    """Select ``(name, sql_expression)`` pairs, in order."""
    return df.selectExpr(*[f"{e} AS {q(n)}" for n, e in pairs])
