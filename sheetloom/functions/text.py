"""Text functions. White space means tab, newline, form feed, return and every Unicode separator."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

SPACE = r"[\t\n\f\r\p{Z}]"
NOT_SPACE = r"[^\t\n\f\r\p{Z}]"

# Templates of the published tables.
GRANT_SUMMARY = (
    "Grant name: {grant_name}\n\n"
    "Grant scheme: {grant_scheme}\n\n"
    "Link: <a href={url} target=_blank>{url}</a>\n\n"
    "url: {url}"
)
NA_TEXT = "NA"


def literal(text: str) -> str:
    """Regular expression that matches the text itself."""
    return re.sub(r"([\\.^$|?*+()\[\]{}\-])", r"\\\1", text)


def sql_text(text: str) -> str:
    """The text as a SQL string literal."""
    escaped = text.replace("\\", "\\\\").replace("'", "\\'").replace("\n", "\\n").replace("\r", "\\r")
    return f"'{escaped}'"


def clean_text(col: Column) -> Column:
    """Pad bare hyphens with spaces; commas, semicolons and runs of white space become one space."""
    marker = "\u0001"
    marked = F.regexp_replace(col, rf"(?<!{SPACE})-(?!{SPACE})", marker)
    spaced = F.regexp_replace(marked, rf"[,;]|{SPACE}{{2,}}", " ")
    return F.replace(spaced, F.lit(marker), F.lit(" - "))


def replace_all(col: Column, replacements: Mapping[str, str] | Sequence[tuple[str, str]]) -> Column:
    """Apply regular-expression replacements one after the other."""
    pairs = replacements.items() if isinstance(replacements, Mapping) else replacements
    for pattern, new in pairs:
        col = F.regexp_replace(col, pattern, new)
    return col


def remove_all(col: Column, *patterns: str) -> Column:
    return replace_all(col, [(pattern, "") for pattern in patterns])


def extract(col: Column, pattern: str, group: int = 0) -> Column:
    """First match, or null where there is none."""
    return F.when(col.rlike(pattern), F.regexp_extract(col, pattern, group))


def extract_all(col: Column, pattern: str, sep: str = "; ") -> Column:
    """All matches joined; null where there is none."""
    found = F.regexp_extract_all(col, F.lit(pattern), F.lit(0))
    return F.when(F.size(found) > 0, F.array_join(found, sep))


def grant_codes(col: Column, placeholder: str = "PH1", pattern: str = r"\b[A-Z]{2}\d{1,2};?\b") -> Column:
    """Codes inside a free-text cell; text that does not open with a code counts as the placeholder."""
    coded = F.when(col.rlike(r"^\b[A-Z]{2}\d{1,2}\b"), col).when(col.isNotNull(), F.lit(placeholder))
    return extract_all(coded, pattern)


def split_take(col: Column, sep: str, index: int) -> Column:
    """The index-th piece (1 is the first); null beyond the last piece."""
    return F.try_element_at(F.split(col, literal(sep), -1), F.lit(index))


def sentence_case(col: Column) -> Column:
    """Lower case, with a capital at the start and after a full stop, exclamation or question mark."""
    parts = F.regexp_extract_all(F.lower(col), F.lit(r"(?s).+?(?:[.!?]+\s+|$)"), F.lit(0))
    capital = F.transform(parts, lambda part: F.concat(F.upper(F.left(part, F.lit(1))), F.substring(part, 2, 2**31 - 1)))
    return F.array_join(capital, "")


def acronym(col: Column, sep: str = "-") -> Column:
    """Capital initials of the pieces."""
    initials = F.transform(F.split(col, literal(sep), -1), lambda part: F.upper(F.left(part, F.lit(1))))
    return F.array_join(initials, "")


def scheme_from_url(url: Column) -> Column:
    """Initials of the slug that starts after the first ``y/`` before ``count``."""
    slug = F.regexp_replace(F.regexp_extract(url, r"y/count.+$", 0), r"^y/", "")
    return acronym(F.nullif(slug, F.lit("")))


def slug_code(slug: Column, sep: str = "-") -> Column:
    """First piece of a slug in capitals: the grant id."""
    return F.upper(split_take(slug, sep, 1))


def slug_description(slug: Column, sep: str = "-") -> Column:
    """Every piece but the first, as a sentence."""
    pieces = F.split(slug, literal(sep), -1)
    rest = F.array_join(F.slice(pieces, F.lit(2), F.greatest(F.size(pieces) - 1, F.lit(0))), " ")
    return sentence_case(rest)


def template(pattern: str, **values: Column) -> Column:
    """Fill ``{name}`` fields; a null value is written as NA."""
    pieces = []
    for fixed, field in re.findall(r"([^{}]*)(?:\{(\w+)\})?", pattern):
        if fixed:
            pieces.append(F.lit(fixed))
        if field:
            column = values[field] if field in values else F.col(field)
            pieces.append(F.coalesce(column.cast("string"), F.lit(NA_TEXT)))
    return F.concat(*pieces)


def paste(*cols: Column, sep: str = " ") -> Column:
    """Join columns with a separator; a null is written as NA."""
    pieces: list[Column] = []
    for col in cols:
        if pieces:
            pieces.append(F.lit(sep))
        pieces.append(F.coalesce(col.cast("string"), F.lit(NA_TEXT)))
    return F.concat(*pieces)


# Rules that turn a grant title into the last part of its address.
STUB_RULES = ((r":\s|\s", "-"), (r"[(),]", ""))


def url_from_stub(stub: Column, base: str) -> Column:
    """Address of a grant page from its title; the last three rules act on the first hit only."""
    slug = replace_all(stub, STUB_RULES)
    for first, new in (("%", "-percent"), ("\u2013", ""), ("--", "-")):
        slug = F.regexp_replace(slug, rf"(?s)^(.*?){first}", f"$1{new}")
    return F.concat(F.lit(f"{base}/"), F.lower(slug))


def with_domain(path: Column, domain: str) -> Column:
    return F.concat(F.lit(domain), F.coalesce(path, F.lit(NA_TEXT)))


def without_prefix(col: Column, prefix: str) -> Column:
    """Drop the first occurrence of a fixed text."""
    return F.regexp_replace(col, rf"(?s)^(.*?){literal(prefix)}", "$1")


def wrap(col: Column, width: int = 50) -> Column:
    """Break at white space into lines filled as far as they go, at most ``width`` characters each."""
    flat = F.trim(F.regexp_replace(col, rf"{SPACE}+", " "))
    lines = F.regexp_replace(flat, rf"([^\n]{{1,{width}}})( +|$)", "$1\n")
    return F.regexp_replace(lines, r"\n$", "")


def _even_lines(text: str | None, width: int) -> str | None:
    if text is None:
        return None
    words = text.split()
    best, start_of = [0.0] + [float("inf")] * len(words), [0] * (len(words) + 1)
    for end in range(1, len(words) + 1):
        used = -1
        for start in range(end - 1, -1, -1):
            used += len(words[start]) + 1
            if used > width and start < end - 1:
                break
            spare = max(width - used, 0)
            cost = best[start] + (0 if end == len(words) or used > width else spare**2)
            if cost < best[end]:
                best[end], start_of[end] = cost, start
    lines, end = [], len(words)
    while end:
        lines.append(" ".join(words[start_of[end] : end]))
        end = start_of[end]
    return "\n".join(reversed(lines))


def wrap_even(col: Column, width: int = 50) -> Column:
    """Break at white space so that the squared space left over on all lines but the last is least.

    This needs a search over break points for each text, which no built-in function offers; Arrow
    batches carry the texts to a small helper.
    """

    @F.pandas_udf(T.StringType())
    def even(texts: pd.Series) -> pd.Series:
        return texts.map(lambda text: _even_lines(text, width))

    return even(col)


def code_prefix(code: Column) -> Column:
    """Capital letters of a code that opens with two of them, else empty; null stays null."""
    return F.when(code.rlike("^[A-Z]{2}"), F.regexp_replace(code, "[^A-Z]", "")).when(code.isNotNull(), F.lit(""))


def valid_code(code: Column, letters: int) -> Column:
    """The code where it is n capitals followed by digits, else null."""
    return F.when(code.rlike(rf"^[A-Z]{{{letters}}}\d+$"), code)


def blank_as_null(col: Column, *blanks: str) -> Column:
    """Null for the given stand-in texts, such as N/A."""
    return F.when(~col.isin(*blanks), col)


def folder_and_file(path: Column) -> tuple[Column, Column]:
    """Last folder and file name of a path."""
    pieces = F.split(path, "/", -1)
    return F.try_element_at(pieces, F.lit(-2)), F.try_element_at(pieces, F.lit(-1))


def trailing_key(col: Column, width: int = 7) -> Column:
    """Exactly the last ``width`` digits at the end of a folder name, as a number."""
    return extract(col, rf"[0-9]{{{width}}}$").try_cast("bigint")


def licence_short(col: Column) -> Column:
    """Licence path from ``by`` up to the closing slash."""
    return extract(col, r"by.*/$")


# Rules of the image file-name grammar, in the order they apply.
FILE_NAME_MARKS = ((r"_B", "__B"), (r"(?<!_)_by ", "__by__"))
FILE_NAME_FINAL = ((r"^(.*?(BY|BC).*?)(_)", "$1__"), (r"'", "_"))


def file_name_parts(folder: Column, file_name: Column, folder_path: Column, target: str) -> dict[str, Column]:
    """Columns read from an image path whose folder is ``name__key`` and whose file holds licence and credit."""
    common = split_take(folder, "__", 1)
    key = split_take(folder, "__", 2)
    amended = replace_all(file_name, FILE_NAME_MARKS)
    final = replace_all(amended, FILE_NAME_FINAL)
    credit = F.regexp_replace(split_take(final, "__", 3), r"(?s)^(.*?)(?:\.jpg|\.png)", "$1")
    return {
        "common_name": common,
        "usage_key": key,
        "amended_file_name": amended,
        "final_file_name": final,
        "license": split_take(final, "__", 2),
        "attribution": credit,
        "full_file_path": paste(folder_path, file_name, sep="/"),
        "write_path_full": template(target + "/{key}__{file}", key=key, file=final),
        "write_path_thumbnail": template(target + "/{key}__thumbnail__{file}", key=key, file=final),
    }
