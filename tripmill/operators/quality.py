"""Data-quality checks as frames: one row per check, or one row per violation."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmill.operators.marts import month_range
from tripmill.sinks.tables import DAY_COLUMN


@dataclass(frozen=True)
class NotNull:
    table: str
    column: str
    name = "not_null"

    def fails(self) -> Column:
        return F.col(self.column).isNull()


@dataclass(frozen=True)
class Accepted:
    """Values outside the list fail; nulls pass, as in SQL's NOT IN."""

    table: str
    column: str
    values: tuple
    name = "accepted_values"

    def fails(self) -> Column:
        return ~F.col(self.column).isin(*self.values)


@dataclass(frozen=True)
class Unique:
    """Values that occur more than once fail; nulls are ignored. Several columns form a grain."""

    table: str
    columns: tuple[str, ...]

    @property
    def name(self) -> str:
        return "unique" if len(self.columns) == 1 else "grain"

    @property
    def column(self) -> str:
        return ",".join(self.columns)


@dataclass(frozen=True)
class Volume:
    table: str
    ts_col: str
    ym: str
    min_rows: int


def _labels(check: NotNull | Accepted | Unique) -> list[Column]:
    return [
        F.lit(check.name).alias("check_name"),
        F.lit(check.table).alias("table_name"),
        F.lit(check.column).alias("column_name"),
    ]


def column_checks(df: DataFrame, checks: Sequence[NotNull | Accepted]) -> DataFrame:
    """All not-null and accepted-value checks of one table in a single pass."""
    counts = df.agg(*[F.count_if(c.fails()).alias(f"c{i}") for i, c in enumerate(checks)])
    rows = [
        F.struct(*_labels(c), F.col(f"c{i}").alias("violations")) for i, c in enumerate(checks)
    ]
    return counts.select(F.inline(F.array(*rows)))


def grain_violations(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Key values that occur more than once, with their count ``c``."""
    return df.groupBy(*columns).agg(F.count("*").alias("c")).where("c > 1")


def unique_violations(df: DataFrame, column: str) -> DataFrame:
    """Repeated non-null values. Counts are summed per task first, so a value that fills a third
    of the table reaches its reducer as one row per task."""
    return grain_violations(df.where(F.col(column).isNotNull()), [column])


def unique_check(df: DataFrame, check: Unique) -> DataFrame:
    if len(check.columns) == 1:
        repeated = unique_violations(df, check.columns[0])
    else:
        repeated = grain_violations(df, check.columns)
    counts = repeated.agg(F.count("*").alias("violations"))
    return counts.select(*_labels(check), "violations")


def key_checks(df: DataFrame, unique: Unique, not_null: NotNull) -> DataFrame:
    """Uniqueness and not-null of one column from the same grouping."""
    key = F.col(unique.column)
    per_key = df.groupBy(key).agg(F.count("*").alias("c"))
    counts = per_key.agg(
        F.count_if(key.isNotNull() & (F.col("c") > 1)).alias("repeated"),
        F.coalesce(F.sum(F.when(key.isNull(), F.col("c"))), F.lit(0)).alias("nulls"),
    )
    rows = [
        F.struct(*_labels(check), F.col(count).alias("violations"))
        for check, count in ((unique, "repeated"), (not_null, "nulls"))
    ]
    return counts.select(F.inline(F.array(*rows)))


def volume_checks(tables: dict[str, DataFrame], checks: Sequence[Volume]) -> DataFrame:
    """Row count of a month against its lower bound."""
    parts = []
    for v in checks:
        month = month_range(tables[v.table], v.ts_col, v.ym)
        if DAY_COLUMN in month.columns:  # opens the files of the month's days only
            first = F.lit(f"{v.ym}-01").cast("date")
            month = month.where((F.col(DAY_COLUMN) >= first) & (F.col(DAY_COLUMN) < F.add_months(first, 1)))
        parts.append(
            month.agg(F.count("*").alias("row_count")).select(
                F.lit(v.table).alias("table_name"),
                F.lit(v.ym).alias("ym"),
                "row_count",
                F.lit(v.min_rows).cast("bigint").alias("min_rows"),
                (F.col("row_count") >= v.min_rows).alias("passed"),
            )
        )
    return reduce(DataFrame.unionByName, parts)


def report(tables: dict[str, DataFrame], checks: Sequence[NotNull | Accepted | Unique]) -> DataFrame:
    """One row per check: name, table, column, violations, passed.

    Each table is read once for all its column checks and once per uniqueness check. Where the
    only column check is not-null on a unique key, as in staging, both come from one reading.
    """
    parts = []
    for table, df in tables.items():
        mine = [c for c in checks if c.table == table]
        per_row = [c for c in mine if not isinstance(c, Unique)]
        unique = [c for c in mine if isinstance(c, Unique)]
        paired = [u for u in unique if per_row == [NotNull(table, u.column)]]
        if paired:
            parts.append(key_checks(df, paired[0], per_row[0]))
            unique.remove(paired[0])
        elif per_row:
            parts.append(column_checks(df, per_row))
        parts.extend(unique_check(df, c) for c in unique)
    joined = reduce(DataFrame.unionByName, parts)
    return joined.withColumn("passed", F.col("violations") == 0)


def model_checks(vendors: tuple = (1, 2), services: tuple = ("Yellow", "Green")) -> list:
    """The 30 column tests and 2 grain tests of the trip models (fixed values)."""
    return [
        NotNull("zone_seed", "locationid"),
        Unique("zone_seed", ("locationid",)),
        NotNull("zone_seed", "borough"),
        Unique("stg_yellow", ("tripid",)),
        NotNull("stg_yellow", "tripid"),
        Unique("stg_green", ("tripid",)),
        NotNull("stg_green", "tripid"),
        NotNull("dim_zones", "locationid"),
        Unique("dim_zones", ("locationid",)),
        NotNull("fact_trips", "tripid"),
        Unique("fact_trips", ("tripid",)),
        NotNull("fact_trips", "vendorid"),
        Accepted("fact_trips", "vendorid", vendors),
        NotNull("fact_trips", "service_type"),
        Accepted("fact_trips", "service_type", services),
        NotNull("monthly_zone_revenue", "revenue_zone"),
        NotNull("monthly_zone_revenue", "revenue_month"),
        NotNull("monthly_zone_revenue", "service_type"),
        Accepted("monthly_zone_revenue", "service_type", services),
        Unique("monthly_zone_revenue", ("revenue_zone", "revenue_month", "service_type")),
        NotNull("service_type_totals", "service_type"),
        Unique("service_type_totals", ("service_type",)),
        Accepted("service_type_totals", "service_type", services),
        NotNull("service_type_totals", "trip_total"),
        NotNull("citywide_monthly", "revenue_month"),
        NotNull("citywide_monthly", "trip_year"),
        NotNull("citywide_monthly", "trip_month"),
        NotNull("citywide_monthly", "service_type"),
        Accepted("citywide_monthly", "service_type", services),
        NotNull("citywide_monthly", "trips"),
        NotNull("citywide_monthly", "revenue_total"),
        Unique("citywide_monthly", ("revenue_month", "service_type")),
    ]
