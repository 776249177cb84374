"""Cleaning transforms for dirty inputs: row-wise, so they run unchanged on
batch and streaming DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mercato.functions.dates import parse_dmy
from mercato.functions.numeric import round_ratio
from mercato.functions.text import leading_number, null_text

# Fixed values of the case study: age band by the last character of the
# segment code, demographic by the first one.
AGE_BANDS = {"1": "Young Adults", "2": "Middle Aged", "3": "Retirees", "4": "Retirees"}
DEMOGRAPHICS = {"C": "Couples", "F": "Families"}
UNKNOWN = "unknown"


def _wall_clock(col) -> F.Column:
    """Text to a wall-clock timestamp (timestamp_ntz): no session time zone
    enters, as with the source data. Unparseable text gives NULL."""
    c = F.col(col) if isinstance(col, str) else col
    return c.cast("string").try_cast("timestamp_ntz")


def clean_customer_orders(raw: DataFrame) -> DataFrame:
    """``'null'`` exclusions become ``''``; ``'null'`` or NULL extras become
    ``''``; order_time text becomes a timestamp."""
    return raw.select(
        "order_id", "customer_id", "pizza_id",
        null_text("exclusions", "").alias("exclusions"),
        null_text("extras", "", sql_null_too=True).alias("extras"),
        _wall_clock("order_time").alias("order_time"),
    )


def clean_runner_orders(raw: DataFrame) -> DataFrame:
    """Typed runs: pickup_time timestamp (``'null'`` -> NULL), distance double
    and duration int taken from the leading number of the text, cancellation
    ``'null'``/``''`` -> ``''`` (SQL NULL stays NULL), plus ``is_delivered``.

    A cancelled run has no number in distance, so its distance is NULL, not 0;
    ``is_delivered`` is ``coalesce(distance, 0) <> 0``.
    """
    distance = leading_number("distance")
    return raw.select(
        "order_id", "runner_id",
        _wall_clock(null_text("pickup_time", None)).alias("pickup_time"),
        distance.alias("distance"),
        leading_number("duration", integral=True).cast("int").alias("duration"),
        F.when(F.col("cancellation").isin("null", ""), "").otherwise(F.col("cancellation")).alias("cancellation"),
        (F.coalesce(distance, F.lit(0.0)) != 0).alias("is_delivered"),
    )


def _by_code(code, mapping: dict[str, str], default: str):
    out = F.lit(default)
    for k, v in reversed(list(mapping.items())):
        out = F.when(code == k, v).otherwise(out)
    return out


def clean_weekly_sales(raw: DataFrame) -> DataFrame:
    """The 13 columns of the clean weekly sales table."""
    wd = parse_dmy("week_date")
    seg = F.col("segment")
    return raw.select(
        wd.alias("week_date"),
        F.weekofyear(wd).cast("bigint").alias("week_number"),
        F.month(wd).cast("bigint").alias("month_number"),
        F.year(wd).cast("bigint").alias("calendar_year"),
        "region", "platform", "segment", "customer_type",
        _by_code(F.right(seg, F.lit(1)), AGE_BANDS, UNKNOWN).alias("age_band"),
        _by_code(F.left(seg, F.lit(1)), DEMOGRAPHICS, UNKNOWN).alias("demographic"),
        "transactions", "sales",
        round_ratio("sales", "transactions", 2).alias("avg_transaction"),
    )
