"""Row-wise sums and band recodes for survey columns, as native expressions."""

from __future__ import annotations

import functools
import operator
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from tessera.functions._util import as_col

# Band labels and limits of the time-use recodes.
WORKING, NOT_WORKING = "working", "not working"
MALE, FEMALE = "male", "female"
YOUNG, ACTIVE, ELDER = "young", "active", "elder"
WORKING_RANGE = (1.0, 3.0)      # working when low <= telfs < high
MALE_CODE = 1.0                 # male when tesex == 1, female otherwise
YOUNG_RANGE = (15.0, 22.0)      # young when low <= teage <= high
ELDER_ABOVE = 55.0              # elder when teage > 55, active otherwise


def row_sum(cols: Sequence[Column | str], *, as_double: bool = False) -> Column:
    """Left-to-right sum of columns; double addition is not associative, so order is kept.

    ``as_double=True`` casts each column to double and folds them as one array
    (``aggregate``) from the first column on: the additions, and their rounding,
    are those of a chain, and hundreds of columns neither overflow the stack nor
    outgrow the generated code. Spark interprets that fold row by row; as an
    operator on a table ``operators.survey.with_row_sums`` has it compiled.
    """
    cols = [as_col(c) for c in cols]
    if not cols:
        raise ValueError("row_sum needs at least one column")
    if as_double:
        first, *rest = [c.cast("double") for c in cols]
        return F.aggregate(F.array(*rest).cast("array<double>"), first, lambda acc, v: acc + v)
    return functools.reduce(operator.add, cols)


def minutes_to_hours(c: Column | str) -> Column:
    return as_col(c) / F.lit(60.0)


def working_band(telfs: Column | str, *, low: float = WORKING_RANGE[0],
                 high: float = WORKING_RANGE[1]) -> Column:
    c = as_col(telfs)
    return F.when((c >= low) & (c < high), F.lit(WORKING)).otherwise(F.lit(NOT_WORKING))


def sex_band(tesex: Column | str, *, male_code: float = MALE_CODE) -> Column:
    return F.when(as_col(tesex) == male_code, F.lit(MALE)).otherwise(F.lit(FEMALE))


def age_band(teage: Column | str, *, young: tuple[float, float] = YOUNG_RANGE,
             elder_above: float = ELDER_ABOVE) -> Column:
    """young in [15, 22], elder above 55, active otherwise (ages under 15 too, as coded).

    Spark orders NaN above every number; the guard keeps NaN 'active' like a
    JVM double comparison would.
    """
    c = as_col(teage)
    return (F.when(c.between(young[0], young[1]), F.lit(YOUNG))
            .when((c > elder_above) & ~F.isnan(c), F.lit(ELDER))
            .otherwise(F.lit(ACTIVE)))
