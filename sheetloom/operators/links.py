"""Links and media: crawl results, media lists and their target files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sheetloom.functions import text as X
from sheetloom.functions.names import clean_name_column
from sheetloom.operators.joins import equi_join
from sheetloom.session import staged_by

# The status of a missing page, and of a sound one.
MISSING_PAGE = "httr2_http_404"
SOUND = "200"


def is_sound(status: Column, drop_status: Sequence[str] = (MISSING_PAGE,), keep_status: Sequence[str] | None = None) -> Column:
    """Whether a link with this status stays; one without status has none to be dropped for.

    The newer rule drops missing pages only; with ``keep_status`` the older rule keeps the given ones.
    """
    state = F.coalesce(status, F.lit(""))
    return state.isin(*keep_status) if keep_status is not None else ~state.isin(*drop_status)


def with_link_status(df: DataFrame, status: DataFrame, url: str) -> DataFrame:
    """Rows with the ``status`` of their link, by a crawl log with ``url`` and ``status``; a hot link is left to adaptive execution."""
    return equi_join(df, status.select(F.col("url").alias("_url"), "status"), [(url, "_url")], "left")


def apply_link_status(
    df: DataFrame,
    status: DataFrame,
    url: str,
    drop_status: Sequence[str] = (MISSING_PAGE,),
    keep_status: Sequence[str] | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Rows whose link is sound and the rest, by the rules of ``is_sound``; both are written by one job, so all is read once."""
    side = F.when(is_sound(F.col("status"), drop_status, keep_status), "sound").otherwise("rest")
    parts = staged_by(with_link_status(df, status, url).withColumn("_side", side), "_side", ["sound", "rest"], "links")
    return parts["sound"], parts["rest"]


def media_files(media: DataFrame, names: DataFrame, key: str, root: str) -> DataFrame:
    """Still images with an address, joined with names, and the file each is to be stored in."""
    images = media.where((F.col("format") == "image/jpeg") & F.col("identifier").isNotNull())
    named = equi_join(images, names.select(key, "common_name"), [key])
    cleaned = named.withColumns({
        "license_short": clean_name_column(X.licence_short(F.col("license"))),
        "common_name": clean_name_column(F.col("common_name")),
        "rights_holder": clean_name_column(F.col("rights_holder")),
    })
    return cleaned.withColumn("file_path", media_path(root, F.col(key)))


def media_path(root: str, key: Column) -> Column:
    return X.template(
        root + "/{common_name}__{key}/{common_name}__{license_short}__{rights_holder}__.jpg", key=key
    )
