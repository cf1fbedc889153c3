"""Data-quality gate over raw rows."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from txnlake.functions.rules import invalid_status, nonpositive_amount, null_key


class DataQualityError(ValueError):
    """At least one check found offending rows."""


def checks() -> dict[str, Column]:
    """Check name to the condition of an offending row."""
    return {
        "no_null_keys": null_key(),
        "no_nonpositive_amounts": nonpositive_amount(),
        "valid_status": invalid_status(),
    }


def quality_counts(raw: DataFrame) -> DataFrame:
    """(check_name, offending): all checks in one pass over the rows."""
    counted = raw.agg(*[F.count_if(bad).alias(name) for name, bad in checks().items()])
    pairs = F.array(
        *[
            F.struct(F.lit(name).alias("check_name"), F.col(name).alias("offending"))
            for name in checks()
        ]
    )
    return counted.select(F.inline(pairs))


def check_results(counts: DataFrame, run_ts: datetime) -> DataFrame:
    """Audit rows for one run."""
    return counts.select(
        F.lit(run_ts).alias("run_ts"),
        "check_name",
        (F.col("offending") == 0).alias("passed"),
        F.format_string("%d offending rows", "offending").alias("detail"),
    )


def run_quality_gate(raw: DataFrame) -> list[Row]:
    """Run every check; three rows of (check_name, offending)."""
    return quality_counts(raw).collect()


def counts_frame(spark: SparkSession, results: list[Row]) -> DataFrame:
    """The gate's collected counts as a frame again, without a second scan."""
    pairs = [
        F.struct(F.lit(r.check_name).alias("check_name"), F.lit(r.offending).alias("offending"))
        for r in results
    ]
    return spark.range(0, 1, 1, 1).select(F.inline(F.array(*pairs)))


def require_passed(results: list[Row]) -> None:
    """Raise with every failed check named."""
    failed = [f"{r.check_name} ({r.offending})" for r in results if r.offending]
    if failed:
        raise DataQualityError("raw rows break these checks: " + ", ".join(failed))
