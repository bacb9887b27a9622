"""Trip cleaning and unification (projections, filters, unions).

All providers and all monthly files are cleaned in one plan: per-file
statistics (3-sigma bounds) are one grouped aggregation keyed by the file
path instead of one eager job per file, and the union of providers is a
single Union node, so Catalyst pushes every filter into every scan.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from routecov.operators.sizing import broadcast_materialised
from routecov.schemas import PROVIDER_COLUMNS

# Allowed payment types and rate codes of metered trips.
VALID_PAYMENT_TYPES = (1, 2, 3)
VALID_RATE_CODES = (1, 5, 6)
# A yyyy-MM token standing on its own (not inside a longer run of letters or
# digits such as the UUIDs Spark puts into part-file names).
YEAR_MONTH_PATTERN = r"(?<![0-9A-Za-z])(\d{4}-\d{2})(?![0-9A-Za-z])"

YELLOW_COLUMNS = {"pickup": "tpep_pickup_datetime", "dropoff": "tpep_dropoff_datetime",
                  "pu": "PULocationID", "do": "DOLocationID"}
GREEN_COLUMNS = {"pickup": "lpep_pickup_datetime", "dropoff": "lpep_dropoff_datetime",
                 "pu": "PUlocationID", "do": "DOlocationID"}


def union_all(frames: list[DataFrame]) -> DataFrame:
    """Union of N frames by column name."""
    return reduce(lambda a, b: a.unionByName(b), frames)


def not_null(df: DataFrame, cols: list[str]) -> DataFrame:
    """keep rows where every named column is non-null."""
    cond = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in cols])
    return df.where(cond)


def drop_null_rows(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """drop rows with a null in any of ``cols`` (all columns by default)."""
    return df.dropna(how="any", subset=cols)


def to_long(col: str) -> Column:
    """Id to bigint; text that is not a number becomes NULL (Q15)."""
    return F.col(col).try_cast("bigint")


def unify_provider(raw: DataFrame, provider: str,
                   columns: tuple[str, str, str, str] | None = None) -> DataFrame:
    """P1-P4, F1 for one provider: select its four columns, drop rows with a
    null among them, tag the provider, rename to the unified names and cast
    the zone ids to bigint."""
    pu_t, do_t, pu, do = columns or PROVIDER_COLUMNS[provider]
    return (drop_null_rows(raw.select(pu_t, do_t, pu, do))
            .select(F.lit(provider).alias("tlc_type"),
                    F.col(pu_t).alias("pu_datetime"), F.col(do_t).alias("do_datetime"),
                    to_long(pu).alias("pu_location_id"), to_long(do).alias("do_location_id")))


def unify_trips(raw_by_provider: dict[str, list[DataFrame]],
                columns: dict[str, tuple[str, str, str, str]] | None = None) -> DataFrame:
    """Every provider's file groups (e.g. before and after a schema
    change) cleaned separately, then one union of all of them."""
    columns = columns or {}
    frames = [unify_provider(df, p, columns.get(p))
              for p, group in raw_by_provider.items() for df in group]
    return union_all(frames)


def year_month_of_file(path_col: str = "file_path") -> Column:
    """The first yyyy-MM in a file path ('' when absent)."""
    return F.regexp_extract(F.col(path_col), YEAR_MONTH_PATTERN, 1)


def year_month_of(ts_col: str) -> Column:
    """Yyyy-MM of a timestamp."""
    return F.date_format(ts_col, "yyyy-MM")


def in_month(ts_col: str, month: Column | None = None) -> Column:
    """a timestamp lies in ``month`` (yyyy-MM; of the file in ``file_path`` by default).

    Two bounds instead of an equality: where both sides come from a join below,
    an equality becomes its first key, and a sort-merge join then makes both
    texts anew in each of its comparisons, nearly all between rows of one month."""
    month = year_month_of_file() if month is None else month
    return year_month_of(ts_col).between(month, month)


def sigma_bounds(raw: DataFrame, value_col: str, by: str | None = None, k: float = 3.0) -> DataFrame:
    """Mean ± k·sample-stddev of ``value_col`` (per ``by`` group).
    One partial+final aggregation, whatever the number of groups."""
    aggs = [F.avg(value_col).alias("mean"), F.stddev_samp(value_col).alias("stddev")]
    stats = raw.groupBy(by).agg(*aggs) if by else raw.agg(*aggs)
    return (stats.withColumn("lower_bound", F.col("mean") - k * F.col("stddev"))
            .withColumn("upper_bound", F.col("mean") + k * F.col("stddev")))


def within_sigma(df: DataFrame, raw: DataFrame | None, value_col: str, by: str | None = None,
                 k: float = 3.0, bounds: DataFrame | None = None) -> DataFrame:
    """keep rows whose value lies inside the bounds computed on ``raw``
    (inclusive).  Bounds are one row per group, computed once (one read of
    ``raw``) and joined back by broadcast when proven small.  ``bounds`` (by,
    lower_bound, upper_bound), e.g. of ``file_moments``, takes their place."""
    if by and bounds is None:
        bounds = broadcast_materialised(sigma_bounds(raw, value_col, by, k).select(by, "lower_bound", "upper_bound"))
    if by:
        joined = df.join(bounds, by)
    else:
        bounds = sigma_bounds(raw, value_col, by, k).select("lower_bound", "upper_bound")
        lo = bounds.select("lower_bound").scalar()
        hi = bounds.select("upper_bound").scalar()
        joined = df.withColumn("lower_bound", lo).withColumn("upper_bound", hi)
    return (joined.where(F.col(value_col).between(F.col("lower_bound"), F.col("upper_bound")))
            .drop("lower_bound", "upper_bound"))


def clean_metered_trips(raw: DataFrame, columns: dict[str, str] | None = None,
                        file_col: str = "file_path", sigma: float = 3.0,
                        payment_types=VALID_PAYMENT_TYPES, rate_codes=VALID_RATE_CODES,
                        bounds: DataFrame | None = None, month: Column | None = None,
                        keep: list[str] | None = None) -> DataFrame:
    """yellow/green cleaning rule over all files at once (``columns``
    defaults to yellow; pass ``GREEN_COLUMNS`` for green).

    Non-null ids/amounts/codes (F2), passenger_count != 0 and fare != 0 (F8),
    different zones (F3), pick-up month equals the file's month (F10),
    allowed payment type and rate code (F7), total amount inside the
    3-sigma bounds of the *raw* file it came from (F9, Q20; given ``bounds``,
    e.g. kept per file, spare the pass over the raw rows); then ids cast to
    bigint and only (pulocationID, dolocationID) and ``keep`` kept.  ``month``
    (yyyy-MM) takes the place of the month in the file's path."""
    c = columns or YELLOW_COLUMNS
    pickup, pu, do = c["pickup"], c["pu"], c["do"]
    kept = not_null(raw, [pu, do, "total_amount", "fare_amount", "payment_type", "RatecodeID"])
    kept = (kept.where(F.col("passenger_count") != 0)
            .where(F.col(pu) != F.col(do))
            .where(in_month(pickup, year_month_of_file(file_col) if month is None else month))
            .where(F.col("payment_type").isin(*payment_types))
            .where(F.col("RatecodeID").isin(*rate_codes))
            .where(F.col("fare_amount") != 0))
    kept = within_sigma(kept, raw, "total_amount", by=file_col, k=sigma, bounds=bounds)
    return kept.select(to_long(pu).alias("pulocationID"), to_long(do).alias("dolocationID"), *(keep or []))


def clean_fhv_trips(raw: DataFrame, pu: str = "PUlocationID", do: str = "DOlocationID") -> DataFrame:
    """non-null ids, cast to bigint, keep (pulocationID, dolocationID)."""
    return (not_null(raw, [pu, do])
            .select(to_long(pu).alias("pulocationID"), to_long(do).alias("dolocationID")))


def code_list_filter(df: DataFrame, payment_types=VALID_PAYMENT_TYPES,
                     rate_codes=VALID_RATE_CODES) -> DataFrame:
    """F7 (+F8): allowed codes and non-zero passenger count / fare."""
    return (df.where(F.col("payment_type").isin(*payment_types))
            .where(F.col("RatecodeID").isin(*rate_codes))
            .where(F.col("passenger_count") != 0)
            .where(F.col("fare_amount") != 0))
