"""Names for intermediate values.

An expression that uses a value twice evaluates it twice, and rules upon rules grow the plan with each use. Bound to a lambda's
variable, a value is evaluated once a row.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    return F.get(F.transform(F.array(value), body), F.lit(0))
