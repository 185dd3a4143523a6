"""Grants from scraped pages, code lists and other funds."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sheetloom.functions import text as X
from sheetloom.operators import ordering as O
from sheetloom.operators import projection as P
from sheetloom.operators import sets as U
from sheetloom.operators.joins import coalesce_join, left_join, lookup_join
from sheetloom.operators.reshape import separate
from sheetloom.sources import html as H

# Names of schemes, patterns of listed titles, and the summary that names a focus.
COUNTRYSIDE = "Countryside Stewardship"
SUSTAINABLE = "Sustainable Farming Initiative"
TITLE_WITH_CODE = r"^[A-Z]{2}\d{0,2}:|^[A-Z]{2}\d{0,2}\s"
FOCUS_SUMMARY = X.GRANT_SUMMARY.replace("Grant scheme:", "Grant focus: {grant_focus}\n\nGrant scheme:")


def other_funds(sheet: DataFrame) -> DataFrame:
    """Grants of the sheet of other funding codes."""
    return sheet.select(
        F.col("code").alias("grant_id"),
        X.template("{code}: {fund_name}").alias("grant_name"),
        F.col("link").alias("url"),
        "_ord",
    )


def scraped_actions(pages: DataFrame, url: str, html: str, order: str) -> DataFrame:
    """One grant per headed action of a scheme's pages; headings without an id are no actions."""
    found = H.extract_attr(pages, html, "h3", "id", [url, order], "action_id")
    action = F.col("action_id")
    code = X.slug_code(action)
    return found.select(
        X.scheme_from_url(F.col(url)).alias("grant_scheme"),
        code.alias("grant_id"),
        X.template("{base}#{id}", base=F.col(url), id=action).alias("url"),
        X.template("{code}: {text}", code=code, text=X.slug_description(action)).alias("grant_name"),
        F.col(order).alias("_page"),
        F.col("position").cast("long").alias("_ord"),
    )


def consolidated(actions: DataFrame, funds: DataFrame) -> DataFrame:
    """Actions, then funds, with a summary text and numbered in that order."""
    sources = {"1": actions, "2": funds}
    both = U.union_with_key(sources, "_source")
    summed = both.withColumn("grant_summary", X.template(X.GRANT_SUMMARY))
    return O.add_id(summed, "id", ["_source", "_page", "_ord"]).drop("_source", "_page", "_ord")


def listed_grants(links: DataFrame, domain: str) -> DataFrame:
    """Links whose title opens with a grant code; the code is the first word before a colon."""
    title = X.replace_all(F.col("text"), [(rf"^{X.SPACE}+|{X.SPACE}+$", "")])
    named = links.withColumn("grant_name", title).where(F.col("grant_name").rlike(TITLE_WITH_CODE))
    code = X.extract(X.extract(F.col("grant_name"), "^[^:]+"), r"^\w+")
    return named.withColumns({
        "url": X.with_domain(F.col("url"), domain),
        "grant_id": code,
        "grant_scheme": F.lit(COUNTRYSIDE),
    }).drop("text")


def stub_grants(items: DataFrame, first_line: str, base: str, width: int = 50) -> DataFrame:
    """Grants of a listing whose items open with ``code: summary``."""
    named = items.withColumn("grant_name", F.col(first_line))
    parted = separate(named, "grant_name", ["grant_id", "summary"], ": ", keep=True)
    return parted.withColumns({
        "url": X.url_from_stub(F.col("grant_name"), base),
        "grant_scheme": F.lit("SFI"),
        "summary_wrapped": X.wrap_even(F.col("summary"), width),
    })


def funded_grants(web: DataFrame, funding: DataFrame) -> DataFrame:
    """Grants of the page's tables with what the funding list has for their code; every row of the page stays.

    Columns that only the page's tables use go: the action's name, payment and duration.
    """
    return left_join(web, funding, ["grant_id"]).drop("sfi_action", "annual_payment", "action_s_duration")


def stewardship_grants(codes: DataFrame, url: str) -> DataFrame:
    """Grants of a code list, all described in one handbook."""
    return codes.select(
        F.lit(url).alias("url"),
        X.template("{code}: {sfi_action}").alias("grant_name"),
        F.col("code").alias("grant_id"),
        F.lit(SUSTAINABLE).alias("grant_scheme"),
        "annual_payment",
        X.sentence_case(F.regexp_replace("category", r"(?s)^(.*?)Actions for ", "$1")).alias("category"),
    )


def code_categories(farming_codes: DataFrame, scheme: str = COUNTRYSIDE) -> DataFrame:
    """Category of each code prefix of a scheme."""
    return farming_codes.where(F.col("scheme") == scheme).select(
        F.col("code").alias("code_prefix"), X.sentence_case(F.col("meaning")).alias("category")
    )


def with_focus(grants: DataFrame, categories: DataFrame, order: Sequence[str]) -> DataFrame:
    """Older grants table: category by code prefix where there is none yet, summary text and number."""
    coded = grants.withColumn("code_prefix", X.code_prefix(F.col("grant_id")))
    if "category" in grants.columns:
        joined = coalesce_join(coded, categories, ["code_prefix"], ["category"])
    else:
        joined = lookup_join(coded, categories, ["code_prefix"])
    focused = joined.withColumnRenamed("category", "grant_focus").drop("code_prefix")
    summed = focused.withColumn("grant_summary", X.template(FOCUS_SUMMARY))
    return P.relocate(O.add_id(summed, "id", order), "grant_id", "id", "url", "grant_name", "grant_focus", "grant_scheme")
