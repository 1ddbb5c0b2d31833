"""Time-use survey: class columns by name prefix, sum rows, recode, average by group.

Three forms of the grouped mean give the same rows: DataFrame
(``average_by_group``), SQL (``average_by_group_sql``) and schema-checked
(``average_by_group_typed``).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions.recode import (
    age_band,
    minutes_to_hours,
    sex_band,
    working_band,
)

# Activity-code prefixes of the three column classes.
PRIMARY_PREFIXES = ("t01", "t03", "t11", "t1801", "t1803")
WORK_PREFIXES = ("t05", "t1805")
OTHER_PREFIXES = ("t02", "t04", "t06", "t07", "t08", "t09", "t10", "t12", "t13", "t14", "t15", "t16", "t18")

GROUP_KEYS = ("working", "sex", "age")
MEASURES = ("primaryNeeds", "work", "other")

# Row contract of the summary (and of the grouped result).
SUMMARY_SCHEMA = T.StructType([
    T.StructField("working", T.StringType()),
    T.StructField("sex", T.StringType()),
    T.StructField("age", T.StringType()),
    T.StructField("primaryNeeds", T.DoubleType()),
    T.StructField("work", T.DoubleType()),
    T.StructField("other", T.DoubleType()),
])


def classify_columns(names: Sequence[str], *, primary: Sequence[str] = PRIMARY_PREFIXES,
                     work: Sequence[str] = WORK_PREFIXES, other: Sequence[str] = OTHER_PREFIXES
                     ) -> tuple[list[str], list[str], list[str]]:
    """Split column names into (primary, work, other) by prefix, keeping input order.

    A name in the first two classes never lands in ``other`` (t1801 is primary
    although it starts with t18); names matching no prefix belong to none.
    This reads metadata only and starts no job.
    """
    names = list(names)
    p = [n for n in names if n.startswith(tuple(primary))]
    w = [n for n in names if n.startswith(tuple(work))]
    taken = set(p) | set(w)
    o = [n for n in names if n not in taken and n.startswith(tuple(other))]
    return p, w, o


#: Columns that one projection adds up.
SUM_STEP = 64


def with_row_sums(df: DataFrame, sums: Mapping[str, Sequence[str]], keep: Sequence[Column | str] = (), *,
                  step: int = SUM_STEP) -> DataFrame:
    """``keep`` and a double column per entry of ``sums``: the left-to-right sum of the columns listed there.

    Additions are compiled chains, in the order and so with the rounding of one
    chain. A chain of hundreds of columns would overflow the optimizer's stack,
    so long sums take several projections of ``step`` columns, each adding on to
    the one before; a projection carries on only the columns still to be added.
    Null and NaN make the sum null or NaN, as in a chain.
    """
    if step < 1 or not all(sums.values()):
        raise ValueError("step must be positive and every sum needs a column")
    place = {c: f"_c{i}" for i, c in enumerate(dict.fromkeys(c for cols in sums.values() for c in cols))}
    left = {f"_s{i}": [place[c] for c in cols] for i, cols in enumerate(sums.values())}
    shown, kept = df.select(*keep).columns, [f"_k{i}" for i in range(len(keep))]
    names = [(c if isinstance(c, Column) else F.col(c)).alias(k) for c, k in zip(keep, kept, strict=True)]
    text = {c: f"`{c.replace('`', '``')}`" if c in df.columns else c for c in place}
    out = df.select("*", *names).selectExpr(*kept, *[f"cast({text[c]} as double) as {p}" for c, p in place.items()])
    started: set[str] = set()
    while any(left.values()):
        now = {s: cols[:step] for s, cols in left.items()}
        left = {s: cols[step:] for s, cols in left.items()}
        carried = dict.fromkeys(c for cols in left.values() for c in cols)
        # Read twice, the sum so far keeps the optimizer from merging the projections into one long chain.
        so_far = {s: ([f"nanvl({s}, {s})"] if cols else [s]) if s in started else [] for s, cols in now.items()}
        out = out.selectExpr(*kept, *carried, *[f"{' + '.join([*so_far[s], *cols])} as {s}" for s, cols in now.items()])
        started |= set(now)
    return out.select(*[F.col(k).alias(n) for k, n in zip(kept, shown, strict=True)],
                      *[F.col(f"_s{i}").alias(n) for i, n in enumerate(sums)])


def summarize_time(df: DataFrame, primary: Sequence[str], work: Sequence[str], other: Sequence[str], *,
                   telfs: str = "telfs", tesex: str = "tesex", teage: str = "teage",
                   exclude_unemployable: bool = False, unemployable_code: float = 5.0, step: int = SUM_STEP,
                   keep: Sequence[str] = ()) -> DataFrame:
    """One row per respondent: working, sex, age bands and hours per class.

    Projections of native, compiled expressions, so the scan reads only the named
    columns; classes of at most ``step`` columns take one (``with_row_sums``).
    ``exclude_unemployable=True`` drops ``telfs == 5`` as the documentation asks;
    the default keeps them, as the code of record does. ``keep`` names columns
    that stay beside the summary.
    """
    for label, cols in (("primary", primary), ("work", work), ("other", other)):
        if not cols:
            raise ValueError(f"no {label} columns to sum")
    src = df.where(~F.col(telfs).eqNullSafe(F.lit(unemployable_code))) if exclude_unemployable else df
    bands = [working_band(telfs).alias("working"), sex_band(tesex).alias("sex"), age_band(teage).alias("age")]
    minutes = with_row_sums(src, dict(zip(MEASURES, (primary, work, other), strict=True)), [*bands, *keep], step=step)
    return minutes.select(*keep, *GROUP_KEYS, *[minutes_to_hours(m).alias(m) for m in MEASURES])


def average_by_group(summed: DataFrame, *, keys: Sequence[str] = GROUP_KEYS,
                     measures: Sequence[str] = MEASURES, scale: int = 1) -> DataFrame:
    """Mean of each measure per group, rounded half-up to ``scale``, sorted by the keys.

    Partial averages are combined map-side, so the shuffle carries one row per
    group and task whatever the group sizes.
    """
    aggs = [F.round(F.avg(m), scale).alias(m) for m in measures]
    return summed.groupBy(*keys).agg(*aggs).orderBy(*keys)


def average_by_group_sql(summed: DataFrame, *, keys: Sequence[str] = GROUP_KEYS,
                         measures: Sequence[str] = MEASURES, scale: int = 1) -> DataFrame:
    """The same grouped mean through Spark SQL; the frame is bound as a parameter, not a global view."""
    def quoted(name: str) -> str:
        return "`" + name.replace("`", "``").replace("{", "{{").replace("}", "}}") + "`"

    by = ", ".join(map(quoted, keys))
    means = ", ".join(f"round(avg({quoted(m)}), {int(scale)}) AS {quoted(m)}" for m in measures)
    return summed.sparkSession.sql(f"SELECT {by}, {means} FROM {{summed}} GROUP BY {by} ORDER BY {by}", summed=summed)


# Types each type may be widened to without losing a value of a typical column.
_WIDER = {
    T.ByteType: (T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType),
    T.ShortType: (T.IntegerType, T.LongType, T.FloatType, T.DoubleType),
    T.IntegerType: (T.LongType, T.DoubleType),
    T.LongType: (T.DoubleType,),
    T.FloatType: (T.DoubleType,),
    T.DateType: (T.TimestampType,),
}


def conform(df: DataFrame, schema: T.StructType = SUMMARY_SCHEMA) -> DataFrame:
    """Match a row contract by name: reorder, fail on a missing column or a narrowing type.

    ``DataFrame.to`` would silently cast double 1.5 to int 1; here only exact
    types or a widening (int to bigint or double, float to double, ...) are
    allowed.
    """
    have = {f.name: f.dataType for f in df.schema.fields}
    for f in schema.fields:
        if f.name not in have:
            raise ValueError(f"column {f.name!r} missing; have {sorted(have)}")
        src = have[f.name]
        if src != f.dataType and not isinstance(f.dataType, _WIDER.get(type(src), ())):
            raise TypeError(f"column {f.name!r}: cannot conform {src.simpleString()} "
                            f"to {f.dataType.simpleString()}")
    return df.to(schema)


def average_by_group_typed(summed: DataFrame, schema: T.StructType = SUMMARY_SCHEMA) -> DataFrame:
    """Grouped mean with the row contract checked on input and output."""
    return conform(average_by_group(conform(summed, schema)), schema)
