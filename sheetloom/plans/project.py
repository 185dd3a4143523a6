"""Activities of a project plan."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sheetloom.functions import dates as D
from sheetloom.operators import ordering as O
from sheetloom.operators import projection as P


def clean_activities(sheet: DataFrame) -> DataFrame:
    """Activities with a start, each under the work package named last above it."""
    started = sheet.where(F.col("activity").isNotNull() & F.col("start_date").isNotNull())
    filled = O.fill_down(started, [], ["_ord"], ["wp"])
    return P.across(filled, P.columns_where(filled, suffix="date"), lambda c, name: D.to_date(c))


def activity_table(activities: DataFrame) -> DataFrame:
    """Activities for display: short dates, and no missing detail."""
    shown = activities.select("wp", "activity", F.coalesce("detail", F.lit("")).alias("detail"), "start_date", "end_date")
    return P.across(shown, ["start_date", "end_date"], lambda c, name: D.month_year(c))


def spots(sheet: DataFrame) -> DataFrame:
    """Milestones with a date and a type in capitals."""
    return sheet.withColumns({"spot_date": D.to_date(F.col("spot_date")), "spot_type": F.upper("spot_type")})
