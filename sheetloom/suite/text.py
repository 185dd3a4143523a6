"""Text, date and JSON functions."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sheetloom.functions import dates as D
from sheetloom.functions import text as X
from sheetloom.functions.names import clean_name_column
from sheetloom.operators.joins import lookup_join
from sheetloom.plans.images import image_catalogue
from sheetloom.sources.media import plucked
from sheetloom.suite.projections import labelled
from sheetloom.suite.registry import Tables, query

SP = r"[\t\n\f\r\p{Z}]"


@query("s_clean_text", rf"""
WITH d AS (SELECT doc_id, text || ' - ' || source || '-' || lang || ',' || n_chars || '; ' || source || '--' || lang AS v FROM documents),
p AS (SELECT doc_id, regexp_replace(regexp_replace(v, '-({SP})', chr(2) || '\1', 'g'), '({SP})-', '\1' || chr(2), 'g') AS v FROM d),
b AS (SELECT doc_id, replace(replace(v, '-', chr(1)), chr(2), '-') AS v FROM p)
SELECT doc_id, replace(regexp_replace(v, '[,;]|{SP}{{2,}}', ' ', 'g'), chr(1), ' - ') AS clean FROM b""")
def s_clean_text(t: Tables) -> DataFrame:
    text = F.concat(
        "text", F.lit(" - "), "source", F.lit("-"), "lang", F.lit(","), F.col("n_chars").cast("string"), F.lit("; "),
        "source", F.lit("--"), "lang",
    )
    return t.documents.select("doc_id", X.clean_text(text).alias("clean"))


@query("s_replace", r"""
SELECT doc_id, regexp_replace(text, '\r|\n', '', 'g') AS flat,
       regexp_replace(regexp_replace(source, 'src', 'source ', 'g'), '[02468]', 'e', 'g') AS renamed FROM documents""")
def s_replace(t: Tables) -> DataFrame:
    return t.documents.select(
        "doc_id",
        X.remove_all(F.col("text"), r"\r|\n").alias("flat"),
        X.replace_all(F.col("source"), [("src", "source "), ("[02468]", "e")]).alias("renamed"),
    )


@query("s_extract", r"""
SELECT page_id, nullif(regexp_extract(url, '^https?://([^/]+)', 1), '') AS host,
       nullif(regexp_extract(url, 'page=[0-9]+'), '') AS page FROM pages""")
def s_extract(t: Tables) -> DataFrame:
    return t.pages.select(
        "page_id",
        X.extract(F.col("url"), "^https?://([^/]+)", 1).alias("host"),
        X.extract(F.col("url"), "page=[0-9]+").alias("page"),
    )


@query("s_extract_all", r"""
SELECT doc_id, nullif(array_to_string(regexp_extract_all(text, '[A-Z][a-z]{9,}'), '; '), '') AS found FROM documents""")
def s_extract_all(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", X.extract_all(F.col("text"), "[A-Z][a-z]{9,}").alias("found"))


@query("s_grant_codes", r"""
WITH c AS (SELECT p_partkey, upper(p_type[1:2]) || p_size || CASE WHEN p_size > 20 THEN '; ' || upper(p_name[1:2]) || p_size ELSE '' END AS v,
                  p_size FROM part),
v AS (SELECT p_partkey, CASE WHEN p_size > 45 THEN NULL WHEN p_size < 5 THEN 'see text' ELSE v END AS v FROM c)
SELECT p_partkey, nullif(array_to_string(regexp_extract_all(
  CASE WHEN v IS NULL THEN NULL WHEN regexp_matches(v, '^\b[A-Z]{2}\d{1,2}\b') THEN v ELSE 'PH1' END, '\b[A-Z]{2}\d{1,2};?\b'), '; '), '') AS codes
FROM v""")
def s_grant_codes(t: Tables) -> DataFrame:
    size = F.col("p_size").cast("string")
    second = F.when(F.col("p_size") > 20, F.concat(F.lit("; "), F.upper(F.substring("p_name", 1, 2)), size)).otherwise("")
    code = F.concat(F.upper(F.substring("p_type", 1, 2)), size, second)
    cell = F.when(F.col("p_size") < 5, F.lit("see text")).when(F.col("p_size") <= 45, code)
    return t.part.select("p_partkey", X.grant_codes(cell).alias("codes"))


@query("s_split_i", "SELECT c_custkey, string_split(c_name, '#')[1] AS kind, string_split(c_name, '#')[2] AS number FROM customer")
def s_split_i(t: Tables) -> DataFrame:
    name = F.col("c_name")
    return t.customer.select("c_custkey", X.split_take(name, "#", 1).alias("kind"), X.split_take(name, "#", 2).alias("number"))


@query("s_acronym", r"""
WITH s AS (SELECT page_id, regexp_replace(regexp_replace(url, '^https?://', ''), '[^A-Za-z]+', '-', 'g') AS slug FROM pages)
SELECT page_id, array_to_string(list_transform(string_split(slug, '-'), lambda x: upper(x[1:1])), '') AS scheme FROM s""")
def s_acronym(t: Tables) -> DataFrame:
    slug = X.replace_all(F.col("url"), [("^https?://", ""), ("[^A-Za-z]+", "-")])
    return t.pages.select("page_id", X.acronym(slug).alias("scheme"))


@query("s_slug", """
WITH s AS (SELECT p_partkey, lower(p_brand) || '-' || lower(p_type) || '-' || replace(p_name, ' ', '-') AS slug FROM part),
w AS (SELECT p_partkey, string_split(slug, '-') AS w FROM s),
d AS (SELECT p_partkey, upper(w[1]) AS grant_id, array_to_string(w[2:], ' ') AS rest FROM w)
SELECT p_partkey, grant_id, upper(rest[1:1]) || rest[2:] AS description FROM d""")
def s_slug(t: Tables) -> DataFrame:
    slug = F.concat_ws("-", F.lower("p_brand"), F.lower("p_type"), F.replace("p_name", F.lit(" "), F.lit("-")))
    return t.part.select("p_partkey", X.slug_code(slug).alias("grant_id"), X.slug_description(slug).alias("description"))


@query("s_case", r"""
SELECT doc_id, upper(source) AS upper_source, lower(text) AS lower_text, trim('  ' || lang || ' ') AS trimmed,
       array_to_string(list_transform(regexp_extract_all(lower(text), '(?s).+?(?:[.!?]+\s+|$)'),
                       lambda x: upper(x[1:1]) || x[2:]), '') AS sentence FROM documents""")
def s_case(t: Tables) -> DataFrame:
    return t.documents.select(
        "doc_id",
        F.upper("source").alias("upper_source"),
        F.lower("text").alias("lower_text"),
        F.trim(F.concat(F.lit("  "), F.col("lang"), F.lit(" "))).alias("trimmed"),
        X.sentence_case(F.col("text")).alias("sentence"),
    )


@query("s_substr", "SELECT c_custkey, substring(c_name, 1, 8) AS kind, substring(c_name, 10, 9) AS number FROM customer")
def s_substr(t: Tables) -> DataFrame:
    return t.customer.select("c_custkey", F.substring("c_name", 1, 8).alias("kind"), F.substring("c_name", 10, 9).alias("number"))


@query("s_starts", "SELECT p_partkey, p_brand, regexp_matches(p_brand, '^Brand#1') AS first_range FROM part")
def s_starts(t: Tables) -> DataFrame:
    return t.part.select("p_partkey", "p_brand", F.col("p_brand").rlike("^Brand#1").alias("first_range"))


@query("s_template", """
WITH p AS (SELECT p_partkey, p_name AS grant_name, CASE WHEN p_size > 25 THEN p_type END AS grant_scheme,
                  'https://grants.example/' || p_partkey AS url FROM part)
SELECT p_partkey, 'Grant name: ' || grant_name || chr(10) || chr(10) || 'Grant scheme: ' || coalesce(grant_scheme, 'NA') || chr(10) || chr(10)
  || 'Link: <a href=' || url || ' target=_blank>' || url || '</a>' || chr(10) || chr(10) || 'url: ' || url AS grant_summary FROM p""")
def s_template(t: Tables) -> DataFrame:
    summary = X.template(
        X.GRANT_SUMMARY, grant_name=F.col("p_name"), grant_scheme=F.when(F.col("p_size") > 25, F.col("p_type")),
        url=F.concat(F.lit("https://grants.example/"), F.col("p_partkey").cast("string")),
    )
    return t.part.select("p_partkey", summary.alias("grant_summary"))


@query("s_paste", """
SELECT d.doc_id, d.source || '; ' || coalesce(CAST(l.quality AS VARCHAR), 'NA') || '; ' || coalesce(CAST(l.toxic AS VARCHAR), 'NA') AS pasted
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""")
def s_paste(t: Tables) -> DataFrame:
    return labelled(t).select("doc_id", X.paste(F.col("source"), F.col("quality"), F.col("toxic"), sep="; ").alias("pasted"))


@query("s_clean_name", r"""
WITH v AS (SELECT page_id, replace(replace(replace(replace(replace(replace(replace(html, 'ß', 'ss'), 'œ', 'oe'), 'æ', 'ae'), '''', ''), '"', ''), '%', '_percent_'), '#', '_number_') AS v FROM pages),
a AS (SELECT page_id, trim(regexp_replace(strip_accents(v), '[^\p{L}\p{N}]+', '_', 'g'), '_') AS v FROM v),
b AS (SELECT page_id, lower(regexp_replace(regexp_replace(regexp_replace(v, '([a-z])([A-Z])', '\1_\2', 'g'), '([0-9])([A-Z][a-z])', '\1_\2', 'g'),
                    '([A-Z])([A-Z][a-z])', '\1_\2', 'g')) AS v FROM a)
SELECT page_id, CASE WHEN regexp_matches(v, '^[0-9]') THEN 'x' || v ELSE v END AS clean FROM b""")
def s_clean_name(t: Tables) -> DataFrame:
    return t.pages.select("page_id", clean_name_column(F.col("html")).alias("clean"))


@query("s_url_stub", r"""
WITH s AS (SELECT p_partkey, p_brand || ': ' || p_name || ' (' || p_size || '%), ' || p_type || ' – x' AS stub FROM part),
a AS (SELECT p_partkey, regexp_replace(regexp_replace(stub, ':\s|\s', '-', 'g'), '[(),]', '', 'g') AS v FROM s)
SELECT p_partkey, 'https://funds.example/' || lower(regexp_replace(regexp_replace(regexp_replace(v, '%', '-percent'), '–', ''), '--', '-')) AS url FROM a""")
def s_url_stub(t: Tables) -> DataFrame:
    stub = F.concat(
        "p_brand", F.lit(": "), "p_name", F.lit(" ("), F.col("p_size").cast("string"), F.lit("%), "), "p_type", F.lit(" – x")
    )
    return t.part.select("p_partkey", X.url_from_stub(stub, "https://funds.example").alias("url"))


@query("s_domain", r"""
SELECT page_id, regexp_replace(url, 'https://', '') AS without, 'https://site.example' || regexp_replace(url, '^https?://[^/]+', '') AS moved
FROM pages""")
def s_domain(t: Tables) -> DataFrame:
    path = F.regexp_replace("url", "^https?://[^/]+", "")
    return t.pages.select(
        "page_id", X.without_prefix(F.col("url"), "https://").alias("without"), X.with_domain(path, "https://site.example").alias("moved")
    )


@query("s_wrap", rf"""
WITH f AS (SELECT doc_id, trim(regexp_replace(text, '{SP}+', ' ', 'g')) AS v FROM documents)
SELECT doc_id, regexp_replace(regexp_replace(v, '([^\n]{{1,50}})( +|$)', '\1' || chr(10), 'g'), '\n$', '') AS wrapped FROM f""")
def s_wrap(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", X.wrap(F.col("text"), 50).alias("wrapped"))


@query("s_wrap_even", rf"""
SELECT doc_id, trim(regexp_replace(text, '{SP}+', ' ', 'g')) AS words, CASE WHEN text IS NOT NULL THEN true END AS fits FROM documents""")
def s_wrap_even(t: Tables) -> DataFrame:
    """The words that the lines hold, and whether every line of several words fits the width."""
    wrapped = t.documents.select("doc_id", X.wrap_even(F.col("text"), 50).alias("wrapped"))
    fits = F.forall(F.split("wrapped", "\n"), lambda line: (F.length(line) <= 50) | ~F.contains(line, F.lit(" ")))
    return wrapped.select("doc_id", F.replace("wrapped", F.lit("\n"), F.lit(" ")).alias("words"), fits.alias("fits"))


def image_paths(t: Tables) -> DataFrame:
    """Image paths made of part names, with a licence and a credit."""
    licence = F.when(F.col("p_size") > 25, F.lit("_BY-NC_")).otherwise(F.lit("_by "))
    ending = F.when(F.col("p_retailprice") > 1000, F.lit(".png")).otherwise(F.lit(".jpg"))
    key = F.col("p_partkey").cast("string")
    return t.part.select(
        "p_partkey",
        F.concat(
            F.lit("data/images/"), F.replace("p_name", F.lit(" "), F.lit("_")), F.lit("__"), key, F.lit("/"),
            F.replace("p_name", F.lit(" "), F.lit("'")), licence, F.lower("p_type"), ending,
        ).alias("path"),
    )


@query("s_filename", r"""
WITH f AS (SELECT p_partkey, replace(p_name, ' ', '_') || '__' || p_partkey AS folder,
  replace(p_name, ' ', '''') || CASE WHEN p_size > 25 THEN '_BY-NC_' ELSE '_by ' END || lower(p_type)
    || CASE WHEN p_retailprice > 1000 THEN '.png' ELSE '.jpg' END AS file_name FROM part),
a AS (SELECT *, regexp_replace(replace(file_name, '_B', '__B'), '(^|[^_])_by ', '\1__by__', 'g') AS amended_file_name FROM f),
n AS (SELECT *, replace(regexp_replace(amended_file_name, '^(.*?(BY|BC).*?)(_)', '\1__'), '''', '_') AS final_file_name FROM a),
k AS (SELECT *, string_split(folder, '__')[1] AS common_name, string_split(folder, '__')[2] AS usage_key,
  string_split(final_file_name, '__')[2] AS license, regexp_replace(string_split(final_file_name, '__')[3], '\.jpg|\.png', '') AS attribution FROM n)
SELECT p_partkey, 'data/images/' || folder || '/' || file_name AS path, common_name, usage_key, amended_file_name, final_file_name, license, attribution,
  'data/images/' || folder || '/' || file_name AS full_file_path, 'upload/' || usage_key || '__' || final_file_name AS write_path_full,
  'upload/' || usage_key || '__thumbnail__' || final_file_name AS write_path_thumbnail FROM k""")
def s_filename(t: Tables) -> DataFrame:
    return image_catalogue(image_paths(t), "path", "upload")


@query("s_path", """
SELECT page_id, string_split(url, '/')[-2] AS folder, string_split(url, '/')[-1] AS file_name FROM pages""")
def s_path(t: Tables) -> DataFrame:
    folder, name = X.folder_and_file(F.col("url"))
    return t.pages.select("page_id", folder.alias("folder"), name.alias("file_name"))


@query("s_code_prefix", r"""
WITH c AS (SELECT p_partkey, upper(p_type[1:2]) || p_size AS code FROM part),
cat AS (SELECT upper(p_type[1:2]) AS prefix, min(p_type) AS category FROM part GROUP BY ALL)
SELECT p_partkey, code, regexp_replace(code, '[^A-Z]', '', 'g') AS code_prefix, category FROM c
LEFT JOIN cat ON regexp_replace(code, '[^A-Z]', '', 'g') = prefix""")
def s_code_prefix(t: Tables) -> DataFrame:
    start = F.upper(F.substring("p_type", 1, 2))
    codes = t.part.select("p_partkey", F.concat(start, F.col("p_size").cast("string")).alias("code"))
    categories = t.part.groupBy(start.alias("code_prefix")).agg(F.min("p_type").alias("category"))
    return lookup_join(codes.withColumn("code_prefix", X.code_prefix(F.col("code"))), categories, ["code_prefix"])


@query("s_nulls", """
SELECT d.doc_id, coalesce(l.quality, -1) AS quality, nullif(d.lang, 'en') AS lang,
       CASE WHEN l.toxic = 1 THEN 'toxic' WHEN l.toxic IS NOT NULL THEN 'fine' END AS verdict
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""")
def s_nulls(t: Tables) -> DataFrame:
    verdict = F.when(F.col("toxic") == 1, "toxic").when(F.col("toxic").isNotNull(), "fine")
    return labelled(t).select(
        "doc_id", F.coalesce("quality", F.lit(-1)).alias("quality"), X.blank_as_null(F.col("lang"), "en").alias("lang"),
        verdict.alias("verdict"),
    )


@query("d_to_date", "SELECT event_id, CAST(ts AS DATE) AS day FROM events")
def d_to_date(t: Tables) -> DataFrame:
    return t.events.select("event_id", D.to_date(F.col("ts")).alias("day"))


@query("d_format", "SELECT o_orderkey, strftime(o_orderdate, '%b %y') AS month FROM orders")
def d_format(t: Tables) -> DataFrame:
    return t.orders.select("o_orderkey", D.month_year(F.col("o_orderdate")).alias("month"))


@query("d_parts", """
SELECT o_orderkey, CAST(month(o_orderdate) AS INT) AS month, CAST(year(o_orderdate) AS INT) AS year FROM orders
WHERE year(o_orderdate) BETWEEN 1994 AND 1996""")
def d_parts(t: Tables) -> DataFrame:
    rows = t.orders.where(D.in_years(F.col("o_orderdate"), 1994, 1996))
    return rows.select("o_orderkey", F.month("o_orderdate").alias("month"), F.year("o_orderdate").alias("year"))


@query("d_label", "SELECT o_orderkey, strftime(o_orderdate, '%Y%m%d') AS label FROM orders")
def d_label(t: Tables) -> DataFrame:
    return t.orders.select("o_orderkey", D.stamp(F.col("o_orderdate")).alias("label"))


@query("js_parse", "SELECT event_id, CAST(json_extract_string(props, '$.k') AS INT) AS k FROM events")
def js_parse(t: Tables) -> DataFrame:
    return t.events.select("event_id", plucked(F.col("props"), "k int")["k"].alias("k"))
