"""Staging to marts: the model graph, lazily or stored layer by layer."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tripmill.operators import quality
from tripmill.operators.core import dim_zones, fact_trips, union_services
from tripmill.operators.marts import citywide_monthly, monthly_zone_revenue, service_type_totals
from tripmill.operators.staging import stage_trips
from tripmill.sinks.tables import ensure_database, materialize


class ChecksFailed(RuntimeError):
    """A build whose models do not pass their checks."""


def facts(raw: dict[str, DataFrame], seed: DataFrame, ts_suffix: str = "") -> DataFrame:
    """Trip facts of all services as one lazy plan."""
    staged = {service: stage_trips(df, service, ts_suffix) for service, df in raw.items()}
    return fact_trips(union_services(staged), dim_zones(seed))


def build_models(
    spark: SparkSession,
    raw: dict[str, DataFrame],
    seed: DataFrame,
    database: str,
    location: str | None = None,
    ts_suffix: str = "",
    store_staged: bool = False,
) -> dict[str, DataFrame]:
    """Build every model into a database and return frames that read what was stored.

    Facts and marts are stored, so a mart reads the table before it instead of repeating the
    work on the trips. Staging is a view; store it where checks follow, so that trips are
    de-duplicated once for the facts and the checks.
    """
    ensure_database(spark, database, location)
    models: dict[str, DataFrame] = {"zone_seed": seed}
    staged = {}
    for service, df in raw.items():
        name = f"stg_{service.lower()}"
        place, layer = (f"{database}.{name}", "core") if store_staged else (f"{database}_{name}", "staging")
        staged[service] = models[name] = materialize(stage_trips(df, service, ts_suffix), place, layer)

    def store(name: str, layer: str, df: DataFrame) -> DataFrame:
        models[name] = materialize(df, f"{database}.{name}", layer)
        return models[name]

    zones = store("dim_zones", "core", dim_zones(seed))
    trips = store("fact_trips", "core", fact_trips(union_services(staged), zones))
    zone_mart = store("monthly_zone_revenue", "mart", monthly_zone_revenue(trips))
    citywide = store("citywide_monthly", "mart", citywide_monthly(zone_mart))
    store("service_type_totals", "mart", service_type_totals(citywide))
    return models


def build_and_check(
    spark: SparkSession,
    raw: dict[str, DataFrame],
    seed: DataFrame,
    database: str,
    location: str | None = None,
    report_only: bool = False,
) -> tuple[dict[str, DataFrame], DataFrame]:
    """Build every model, run all checks, and fail if one does; (models, report).

    ``report_only`` gives the report of a build that does not pass instead of an error.
    """
    models = build_models(spark, raw, seed, database, location, store_staged=True)
    rows = quality.report(models, quality.model_checks())
    rows.write.mode("overwrite").format("parquet").saveAsTable(f"{database}.check_report")
    report = spark.table(f"{database}.check_report")
    failed = [] if report_only else report.where("not passed").collect()  # one row for each check at most
    if failed:
        names = sorted(f"{r.check_name}({r.table_name}.{r.column_name}): {r.violations}" for r in failed)
        raise ChecksFailed("; ".join(names))
    return models, report
