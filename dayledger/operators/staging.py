"""Generic staging operators.

Each takes column names as parameters so the same operator runs on any table
with the right shape.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dayledger.functions.jsonfn import json_has_key, json_text
from dayledger.functions.keys import surrogate_key_of

# Blood-glucose unit rule (mmol/L below the threshold -> mg/dL).
GLUCOSE_MMOL_THRESHOLD = 30
GLUCOSE_MGDL_PER_MMOL = "18.0182"


def pick_first(df: DataFrame, partition_by: Sequence[str], order_by: Sequence[Column],
               rank_col: str | None = None) -> DataFrame:
    """WIN-01/02/03: keep the first row of each group in the given order
    (``row_number() over (...) = 1``).

    Spark plans this as a *partial* WindowGroupLimit before the shuffle and a
    final one after it, so each map task forwards at most one row per group:
    a hot group costs no more shuffle than a cold one. Give a total order
    (add a tie-break column) when the result must be deterministic.
    """
    rn = rank_col or "__rn"
    w = Window.partitionBy(*partition_by).orderBy(*order_by)
    out = df.withColumn(rn, F.row_number().over(w)).where(F.col(rn) == 1)
    return out if rank_col else out.drop(rn)


def last_row_wins(df: DataFrame, partition_by: Sequence[str], ts_col: str,
                  tiebreak: Sequence[str] = ()) -> DataFrame:
    """WIN-01: latest row per group by ``ts_col desc`` (NULL first, as PostgreSQL
    sorts a descending key), then tie-break columns descending."""
    order = [F.col(ts_col).desc_nulls_first()] + [F.col(c).desc_nulls_first() for c in tiebreak]
    return pick_first(df, partition_by, order)


def first_occurrence(df: DataFrame, partition_by: Sequence[str], order_by: Sequence[Column]
                     ) -> DataFrame:
    """WIN-02: first occurrence per group, e.g. by date then timestamp NULLS FIRST."""
    return pick_first(df, partition_by, order_by)


def first_row_in_time(df: DataFrame, keys: Sequence[str], date_col: str, time_col: str,
                      code_col: str, codes: Sequence[str]) -> DataFrame:
    """WIN-02 as an aggregate: of each group the row of the first date, then of the
    first time on it (NULL first), then of the first code in the order of ``codes``.
    Rows without a date are left out; a code outside the list is an error.

    Date, time and place of the code form one number, so the minimum is a row and
    never a date of one beside a time of another. The number is a plain hash
    aggregate with a partial step; a window, or a minimum of structs, sorts."""
    kind = df.schema[time_col].dataType
    origin, start = F.lit("1970-01-01").cast("date"), F.lit("1970-01-01 00:00:00").cast(kind)
    day = F.datediff(date_col, origin) + 1_000_000
    # the years 0001 to 9999 lie within 10**18 microseconds; 0 stands for no time
    time = F.coalesce(F.timestamp_diff("MICROSECOND", start, F.col(time_col)) + (10**18 + 1), F.lit(0))
    place = F.array_position(F.array(*map(F.lit, codes)), F.col(code_col))
    place = F.when(place > 0, place).otherwise(F.raise_error(F.concat(F.lit("unknown code: "), F.coalesce(code_col, F.lit("NULL")))))
    number = (day.cast("decimal(8,0)") * F.expr("1000000000000000000000BD")
              + time.cast("decimal(19,0)") * F.expr("100BD") + place.cast("decimal(2,0)"))
    first = (df.where(F.col(date_col).isNotNull()).select(*keys, number.alias("__n"))
             .groupBy(*keys).agg(F.min("__n").alias("__n")))
    first = first.select(*keys, F.expr("__n div 1000000000000000000000BD").alias("__day"),
                         F.expr("(__n % 1000000000000000000000BD) div 100BD").alias("__time"), F.expr("__n % 100BD").cast("int").alias("__place"))
    back = F.timestamp_add("MICROSECOND", F.col("__time") - (10**18 + 1), start)
    return first.select(*keys, F.date_add(origin, (F.col("__day") - 1_000_000).cast("int")).alias(date_col),
                        F.when(F.col("__time") > 0, back).alias(time_col), F.element_at(F.array(*map(F.lit, codes)), F.col("__place")).alias(code_col))


def distinct_on(df: DataFrame, keys: Sequence[str], order_by: Sequence[Column],
                exact_dedupe_first: bool = False) -> DataFrame:
    """WIN-03: ``SELECT DISTINCT ON (keys) ... ORDER BY keys, <order_by>``.

    One row per key, picked by ``order_by`` (e.g. ``desc_nulls_last``). A
    preceding ``select distinct *`` cannot change the picked row (an exact
    duplicate only ties with itself), so it is skipped by default — one full
    shuffle fewer; ``exact_dedupe_first`` keeps it for callers that want it."""
    base = df.distinct() if exact_dedupe_first else df
    return pick_first(base, keys, order_by)


def collapse_duplicates(df: DataFrame, payload: Sequence[str], count_col: str = "source_row_count",
                        key_col: str | None = None) -> DataFrame:
    """AGG-08 / INT-01: one row per distinct payload with its multiplicity.

    NULLs group together. Map-side partial aggregation means a payload repeated
    a billion times ships one partial count per map task. With ``key_col`` a
    surrogate key over the payload is added (FN-18)."""
    out = df.groupBy(*payload).agg(F.count(F.lit(1)).cast("bigint").alias(count_col))
    if key_col:
        out = out.select(surrogate_key_of(out, list(payload)).alias(key_col), *out.columns)
    return out


def translate_key(df: DataFrame, mapper: DataFrame, on: str | Sequence[tuple[str, str]],
                  take: Mapping[str, str], mapper_filter: Column | None = None) -> DataFrame:
    """JON-04 / JON-05: left join to a key mapper with the filter *inside* the
    right side; unmapped rows keep NULL. ``on`` is a shared column name or
    ``[(left_col, right_col), ...]``; ``take`` maps mapper columns to output
    names. The mapper must be unique on its key (assert it with DQ-02)."""
    right = mapper if mapper_filter is None else mapper.where(mapper_filter)
    if isinstance(on, str):
        pairs = [(on, on)]
    else:
        pairs = list(on)
    rcols = {r: f"__r_{i}" for i, (_, r) in enumerate(pairs)}
    right = right.select(*[F.col(r).alias(a) for r, a in rcols.items()],
                         *[F.col(src).alias(dst) for src, dst in take.items()])
    cond = None
    for left, r in pairs:
        c = F.col(left) == F.col(rcols[r])
        cond = c if cond is None else cond & c
    joined = df.join(right, cond, "left")
    return joined.drop(*rcols.values())


def unpivot_readings(df: DataFrame, id_cols: Sequence[str],
                     readings: Sequence[tuple[str, str | Column, str]],
                     code_col: str = "metric_code", value_col: str = "metric_value",
                     unit_col: str = "metric_unit", value_type: str = "double",
                     drop_null: bool = True) -> DataFrame:
    """FN-15 / STG-02: parallel ``unnest`` of (code, value, unit) triples into a
    tall form, one row per reading; NULL readings dropped (PRJ-07).
    ``inline(array(struct...))`` is a Generate inside the same stage, no shuffle."""
    structs = [F.struct(F.lit(code).alias(code_col),
                        (F.col(v) if isinstance(v, str) else v).cast(value_type).alias(value_col),
                        F.lit(unit).alias(unit_col)) for code, v, unit in readings]
    out = df.select(*id_cols, F.inline(F.array(*structs)))
    return out.where(F.col(value_col).isNotNull()) if drop_null else out


def normalise_glucose(value: Column) -> Column:
    """STG-02: readings below the threshold are mmol/L -> mg/dL, rounded to one
    decimal (half away from zero on decimals); others are already mg/dL."""
    v = value.cast("decimal(18,6)")
    return F.when(v < GLUCOSE_MMOL_THRESHOLD,
                  F.round(v * F.expr(f"CAST({GLUCOSE_MGDL_PER_MMOL} AS DECIMAL(10,4))"), 1)
                  ).otherwise(v)


def drop_error_payloads(df: DataFrame, payload_col: str, error_key: str = "error") -> DataFrame:
    """PRJ-06: ``WHERE NOT (payload ? 'error')`` — applied *before* a
    last-row-wins so a good same-day row wins. A NULL payload is dropped too
    (``NOT NULL`` is not true)."""
    return df.where(~json_has_key(payload_col, error_key))


def flatten_json(df: DataFrame, payload_col: str, paths: Mapping[str, Sequence[str]],
                 keep: Sequence[str] = ()) -> DataFrame:
    """STG-22: only allow-listed JSON paths leave the payload; everything else
    stays behind by omission."""
    return df.select(*keep, *[json_text(payload_col, *p).alias(n) for n, p in paths.items()])


def flatten_variant(df: DataFrame, payload_col: str, paths: Mapping[str, str],
                    keep: Sequence[str | Column] = (), kind: str = "string") -> DataFrame:
    """STG-22 by one parse: the payload becomes a VARIANT once a row, and each
    allow-listed JSON path reads from that, however many there are. A path that
    is absent, or of another type, gives NULL."""
    parsed = df.withColumn("__variant", F.try_parse_json(F.col(payload_col)))
    return parsed.select(*keep, *[F.try_variant_get("__variant", p, kind).alias(n) for n, p in paths.items()])


def keep_unless_deleted(flag: str) -> Column:
    """PRJ-04 ``is_deleted IS NOT TRUE``: NULL counts as not deleted."""
    return F.coalesce(~F.col(flag), F.lit(True))


def keep_if_not_deleted(flag: str) -> Column:
    """PRJ-04 ``NOT is_deleted``: NULL is dropped."""
    return ~F.col(flag)


def zero_as_missing(col: str) -> Column:
    """PRJ-03 ``nullif(x, 0)``."""
    return F.nullif(F.col(col), F.lit(0))


def open_interval(allowed_col: str, allowed: Sequence, closed_col: str) -> Column:
    """PRJ-05: allow-list membership and an open interval (``closed IS NULL``)."""
    return F.col(allowed_col).isin(list(allowed)) & F.col(closed_col).isNull()


def count_streams(*cols: str) -> Column:
    """Number of non-NULL columns (e.g. wearable streams active, 0..n)."""
    total = F.lit(0)
    for c in cols:
        total = total + F.col(c).isNotNull().cast("int")
    return total
