"""Sources and sinks: files written and read back, pages and responses taken apart."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sheetloom.operators.fuzzy import backbone_match_near
from sheetloom.operators.joins import backbone_match, missing_names
from sheetloom.operators.links import apply_link_status, is_sound, media_files
from sheetloom.plans.grants import funded_grants
from sheetloom.session import scratch_path
from sheetloom.sinks import files as W
from sheetloom.sinks import publish as PUB
from sheetloom.sources import files as R
from sheetloom.sources import html as H
from sheetloom.sources.media import explode_media
from sheetloom.sources.quoted import read_quoted
from sheetloom.suite.projections import labelled
from sheetloom.suite.registry import Tables, query

CUSTOMER = "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"


@query("src_delim", "SELECT * FROM customer")
def src_delim(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "delim")
    W.write_delim(t.customer, path)
    return R.read_delim(t.spark, path, ";", CUSTOMER, decimal_comma=True)


@query("src_csv", "SELECT * FROM customer")
def src_csv(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "csv")
    W.write_csv(t.customer, path)
    return R.read_csv(t.spark, path, CUSTOMER)


@query("src_quoted", "SELECT doc_id, nullif(text, '') AS text, lang, source FROM documents")
def src_quoted(t: Tables) -> DataFrame:
    """Texts with line breaks and quotes, from files of which each is read by as many tasks as it has splits."""
    path = scratch_path(t.spark, "quoted")
    W.write_csv(t.documents.select("doc_id", "text", "lang", "source"), path)
    return read_quoted(t.spark, path, ",", "doc_id bigint, text string, lang string, source string")


@query("src_parquet", "SELECT * FROM customer")
def src_parquet(t: Tables) -> DataFrame:
    return R.read_parquet(t.spark, t.path("customer"))


@query("src_bundle", """
SELECT 'my_customers' AS sheet, count(*) AS n FROM customer UNION ALL SELECT 'my_parts', count(*) FROM part
UNION ALL SELECT 'x3_suppliers', count(*) FROM supplier""")
def src_bundle(t: Tables) -> DataFrame:
    paths = {"My customers": t.path("customer"), "my Parts": t.path("part"), "3 Suppliers": t.path("supplier")}
    bundle = R.read_bundle(t.spark, paths, fmt="parquet")
    counts = [R.pluck(bundle, n).agg(F.lit(n).alias("sheet"), F.count(F.lit(1)).alias("n")) for n in bundle]
    return counts[0].unionByName(counts[1]).unionByName(counts[2])


@query("src_tsv", "SELECT o_orderkey, o_custkey, o_orderpriority FROM orders")
def src_tsv(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "tsv")
    W.write_tsv(t.orders.select("o_orderkey", "o_custkey", "o_orderpriority"), path)
    return R.read_tsv(t.spark, path, "o_orderkey bigint, o_custkey bigint, o_orderpriority string")


LISTED = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


@query("file_listing", "SELECT name || '.parquet' AS file_name, true AS filled FROM (VALUES " + ", ".join(f"('{n}')" for n in LISTED) + ") v(name)")
def file_listing(t: Tables) -> DataFrame:
    return R.list_files(t.spark, t.folder, "*.parquet").select("file_name", (F.col("length") > 0).alias("filled"))


@query("html_links", r"""
WITH a AS (SELECT page_id, unnest(regexp_extract_all(html, '(?is)<a(?:\s[^>]*)?>.*?</a\s*>')) AS a,
           generate_subscripts(regexp_extract_all(html, '(?is)<a(?:\s[^>]*)?>.*?</a\s*>'), 1) - 1 AS position FROM pages)
SELECT page_id, CAST(position AS INT) AS position,
  replace(replace(replace(regexp_replace(a, '<[^>]*>', '', 'g'), '&lt;', '<'), '&gt;', '>'), '&amp;', '&') AS text,
  replace(nullif(regexp_extract(a, '(?is)^<[^>]*?\shref\s*=\s*"([^"]*)"', 1), ''), '&amp;', '&') AS url FROM a""")
def html_links(t: Tables) -> DataFrame:
    return H.extract_links(t.pages, "html", ["page_id"])


@query("html_attr", r"""
WITH a AS (SELECT page_id, 'a' AS tag, unnest(regexp_extract_all(html, '(?is)<a(?:\s[^>]*)?>')) AS o FROM pages),
l AS (SELECT page_id, 'html' AS tag, unnest(regexp_extract_all(html, '(?is)<html(?:\s[^>]*)?>')) AS o FROM pages)
SELECT page_id, tag, value FROM (
  SELECT page_id, tag, nullif(regexp_extract(o, '\shref="([^"]*)"', 1), '') AS value FROM a
  UNION ALL SELECT page_id, tag, nullif(regexp_extract(o, '\slang="([^"]*)"', 1), '') FROM l) WHERE value IS NOT NULL""")
def html_attr(t: Tables) -> DataFrame:
    links = H.extract_attr(t.pages, "html", "a", "href", ["page_id"], "value").withColumn("tag", F.lit("a"))
    langs = H.extract_attr(t.pages, "html", "html", "lang", ["page_id"], "value").withColumn("tag", F.lit("html"))
    return links.unionByName(langs).select("page_id", "tag", "value")


@query("html_text", r"""
WITH e AS (SELECT page_id, 'li' AS tag, unnest(regexp_extract_all(html, '(?is)<li(?:\s[^>]*)?>.*?</li\s*>')) AS e FROM pages
  UNION ALL SELECT page_id, 'div', unnest(list_filter(regexp_extract_all(html, '(?is)<div(?:\s[^>]*)?>.*?</div\s*>'),
    lambda d: regexp_matches(d, '^<div class="ad"'))) FROM pages),
x AS (SELECT page_id, tag, trim(replace(replace(replace(regexp_replace(regexp_replace(e, '(?i)<br\s*/?>', chr(10), 'g'), '(?s)<!--.*?-->|<[^>]*>', '', 'g'),
  '&lt;', '<'), '&gt;', '>'), '&amp;', '&')) AS text FROM e)
SELECT page_id, tag, text, string_split(text, chr(10))[1] AS first_line FROM x""")
def html_text(t: Tables) -> DataFrame:
    items = H.extract_text(t.pages, "html", "li", None, ["page_id"]).withColumn("tag", F.lit("li"))
    ads = H.extract_text(t.pages, "html", "div", "ad", ["page_id"]).withColumn("tag", F.lit("div"))
    return items.unionByName(ads)


@query("html_tables", """
SELECT p_partkey, p_brand AS code, p_name AS sfi_action, p_type || ' & more' AS category, CAST(p_size AS VARCHAR) AS annual_payment FROM part""")
def html_tables(t: Tables) -> DataFrame:
    """Every part as a page with a table of four columns and one of two; only the first kind is kept."""
    def cells(tag: str, *texts) -> list:
        return [piece for text in texts for piece in (F.lit(f"<{tag}>"), text)]

    head = cells("th", F.lit("Code"), F.lit("SFI action"), F.lit("category"), F.lit("annual payment"))
    body = cells("td", F.col("p_brand"), F.col("p_name"), F.concat(F.col("p_type"), F.lit(" &amp; more")), F.col("p_size").cast("string"))
    html = F.concat(
        F.lit("<p>x</p><table><tr>"), *head, F.lit("<tr>"), *body,
        F.lit("</table><table><tr><td>a<td>b<tr><td>c<td>d</table>"),
    )
    pages = t.part.select("p_partkey", html.alias("html"))
    rows = H.extract_tables(pages, "html", "p_partkey", ncol=4)
    return H.table_columns(rows, ["Code", "SFI action", "category", "annual payment"], "p_partkey")


def stacked_pages(t: Tables) -> DataFrame:
    """Every part as a page with two tables whose headers name the same things in another order, and one of other things."""
    def row(tag: str, *texts) -> list:
        return [F.lit("<tr>"), *[piece for text in texts for piece in (F.lit(f"<{tag}>"), text)]]

    head = [F.lit(x) for x in ("Code", "SFI action", "Annual payment", "Action(s) duration")]
    size, price = F.col("p_size").cast("string"), F.col("p_retailprice").cast("string")
    first = [*row("th", *head), *row("td", F.col("p_brand"), F.col("p_name"), size, F.lit("3 years"))]
    second = [*row("th", head[2], F.lit("Notes"), head[0], head[1]), *row("td", price, F.lit("&lbrace;n&rbrace;"), F.upper("p_type"), F.lower("p_type"))]
    html = F.concat(F.lit("<table>"), *first, F.lit("</table><table>"), *second, F.lit("</table><table><tr><td>x</table>"))
    return t.part.select("p_partkey", html.alias("html"))


def stacked(t: Tables) -> DataFrame:
    rows = H.extract_tables(stacked_pages(t), "html", "p_partkey", ncol=4)
    return H.stacked_tables(rows, "p_partkey", ["code", "sfi_action", "annual_payment", "action_s_duration"])


STACKED = """
stacked AS (SELECT p_partkey, 0 AS "table", 1 AS "row", p_brand AS code, p_name AS sfi_action, CAST(p_size AS VARCHAR) AS annual_payment, '3 years' AS action_s_duration FROM part
  UNION ALL SELECT p_partkey, 1, 1, upper(p_type), lower(p_type), CAST(p_retailprice AS VARCHAR), NULL FROM part)"""


@query("html_stacked", f"WITH {STACKED} SELECT * FROM stacked")
def html_stacked(t: Tables) -> DataFrame:
    """The tables of a page under their own headers, one below the other."""
    return stacked(t)


@query("grants_with_funding", f"""
WITH {STACKED}, f AS (SELECT p_brand AS grant_id, max(p_retailprice) AS funding FROM part WHERE p_size > 20 GROUP BY p_brand)
SELECT p_partkey, "table", "row", code AS grant_id, funding FROM stacked LEFT JOIN f ON code = grant_id""")
def grants_with_funding(t: Tables) -> DataFrame:
    """The stacked page tables with the funding list; rows without funding stay."""
    funding = t.part.where("p_size > 20").groupBy(F.col("p_brand").alias("grant_id")).agg(F.max("p_retailprice").alias("funding"))
    return funded_grants(stacked(t).withColumnRenamed("code", "grant_id"), funding)


@query("page_urls", """
SELECT p_partkey, CAST(page AS INT) AS page, 'https://list.example/' || p_partkey || CASE WHEN page > 1 THEN '?page=' || page ELSE '' END AS url
FROM (SELECT p_partkey, unnest(range(1, p_size + 1)) AS page FROM part)""")
def page_urls(t: Tables) -> DataFrame:
    base = F.concat(F.lit("https://list.example/"), F.col("p_partkey").cast("string"))
    return H.page_urls_for(t.part.withColumn("base", base), "base", "p_size", ["p_partkey"])


def responses(t: Tables) -> DataFrame:
    """Service responses: each event as one result with two media."""
    key = F.get_json_object("props", "$.k")
    json = F.concat(
        F.lit('[{"rightsHolder": "user '), F.col("user_id").cast("string"), F.lit('", "media": [{"format": "image/jpeg", "identifier": "https://media.example/'),
        key, F.lit('.jpg", "license": "http://licences.example/by-nc/4.0/"}, {"format": "'), "event_type", F.lit('", "identifier": null}]}]'),
    )
    return t.events.select("event_id", json.alias("json"))


@query("json_media", """
WITH k AS (SELECT event_id, 'user ' || user_id AS rights_holder, event_type, json_extract_string(props, '$.k') AS k FROM events)
SELECT event_id, rights_holder, 'image/jpeg' AS format, 'https://media.example/' || k || '.jpg' AS identifier, 'http://licences.example/by-nc/4.0/' AS license FROM k
UNION ALL SELECT event_id, rights_holder, event_type, NULL, NULL FROM k""")
def json_media(t: Tables) -> DataFrame:
    return explode_media(responses(t), "json", ["event_id"])


@query("media_files", """
WITH k AS (SELECT e.event_id, 'user_' || user_id AS rights_holder, replace(c_name, '#', '_number_') AS common, json_extract_string(props, '$.k') AS k
  FROM events e JOIN customer ON e.event_id = c_custkey)
SELECT event_id, lower(common) AS common_name, 'https://media.example/' || k || '.jpg' AS identifier, 'by_nc_4_0' AS license_short, rights_holder,
  'media/' || lower(common) || '__' || event_id || '/' || lower(common) || '__by_nc_4_0__' || rights_holder || '__.jpg' AS file_path FROM k""")
def files_of_media(t: Tables) -> DataFrame:
    names = t.customer.select(F.col("c_custkey").alias("event_id"), F.col("c_name").alias("common_name"))
    media = explode_media(responses(t), "json", ["event_id"])
    return media_files(media, names, "event_id", "media").select(
        "event_id", "common_name", "identifier", "license_short", "rights_holder", "file_path"
    )


@query("backbone_match", """
WITH names AS (SELECT p_partkey, p_name || CASE WHEN p_size > 40 THEN ' sp.' ELSE '' END AS name FROM part),
b AS (SELECT p_name AS canonical_name, min(p_partkey) AS usage_key, count(*) AS uses FROM part GROUP BY p_name)
SELECT p_partkey, name, usage_key, uses, CASE WHEN usage_key IS NOT NULL THEN 'https://backbone.example/' || usage_key END AS backbone_url
FROM names LEFT JOIN b ON name = canonical_name""")
def backbone(t: Tables) -> DataFrame:
    suffix = F.when(F.col("p_size") > 40, F.lit(" sp.")).otherwise("")
    names = t.part.select("p_partkey", F.concat("p_name", suffix).alias("name"))
    known = t.part.groupBy(F.col("p_name").alias("canonical_name")).agg(F.min("p_partkey").alias("usage_key"), F.count(F.lit(1)).alias("uses"))
    return backbone_match(names, "name", known, "canonical_name", "https://backbone.example/")


@query("backbone_match_near", """
WITH names AS (SELECT p_partkey, CASE WHEN p_size % 3 = 0 THEN upper(p_name) || 'x' WHEN p_size % 3 = 1 THEN p_name[2:] ELSE p_name || ' sp. nov.' END AS name FROM part),
b AS (SELECT p_name AS canonical_name, min(p_partkey) AS usage_key, count(*) AS uses FROM part WHERE p_size < 40 GROUP BY p_name),
n AS (SELECT DISTINCT name FROM names),
near AS (SELECT n.name, canonical_name AS match_name, levenshtein(lower(n.name), lower(canonical_name)) AS d, row_number() OVER (PARTITION BY n.name
  ORDER BY n.name <> canonical_name, levenshtein(lower(n.name), lower(canonical_name)), canonical_name) AS place FROM n JOIN b
  ON n.name = canonical_name OR levenshtein(lower(n.name), lower(canonical_name)) <= 2)
SELECT p_partkey, names.name, match_name, CAST(d AS INT) AS match_distance, usage_key, uses,
  CASE WHEN usage_key IS NOT NULL THEN 'https://backbone.example/' || usage_key END AS backbone_url
FROM names LEFT JOIN near ON names.name = near.name AND place = 1 LEFT JOIN b ON match_name = canonical_name""")
def backbone_near(t: Tables) -> DataFrame:
    """Names in other case, with a letter more or less, or with words more; only the last stay unmatched."""
    size = F.col("p_size") % 3
    name = F.when(size == 0, F.concat(F.upper("p_name"), F.lit("x"))).when(size == 1, F.substring("p_name", 2, 1000)).otherwise(F.concat("p_name", F.lit(" sp. nov.")))
    known = t.part.where("p_size < 40").groupBy(F.col("p_name").alias("canonical_name")).agg(F.min("p_partkey").alias("usage_key"), F.count(F.lit(1)).alias("uses"))
    return backbone_match_near(t.part.select("p_partkey", name.alias("name")), "name", known, "canonical_name", "https://backbone.example/")


@query("backbone_missing", """
SELECT DISTINCT p_name || ' sp.' AS name FROM part WHERE p_size > 40""")
def backbone_missing(t: Tables) -> DataFrame:
    """The names that the backbone lacks."""
    return missing_names(backbone(t), "name")


@query("link_status", """
WITH s AS (SELECT DISTINCT url, CASE WHEN contains(url, '#') THEN 'httr2_http_404' WHEN contains(url, '?') THEN 'httr2_failure' ELSE '200' END AS status
  FROM pages)
SELECT p.page_id, p.url, s.status, s.status <> 'httr2_http_404' AS newer, s.status = '200' AS older FROM pages p JOIN s ON p.url = s.url""")
def link_status(t: Tables) -> DataFrame:
    url = F.col("url")
    status = F.when(url.contains("#"), "httr2_http_404").when(url.contains("?"), "httr2_failure").otherwise("200")
    log = t.pages.select("url", status.alias("status")).distinct()
    both = dict(zip((True, False), apply_link_status(t.pages.select("page_id", "url"), log, "url"), strict=True))
    older = is_sound(F.col("status"), keep_status=["200"]).alias("older")
    marked = [part.select("page_id", "url", "status", F.lit(flag).alias("newer"), older) for flag, part in both.items()]
    return marked[0].unionByName(marked[1])


@query("snk_delim", """
SELECT l_orderkey, l_linenumber, replace(CAST(l_discount AS VARCHAR), '.', ',') AS l_discount FROM lineitem""")
def snk_delim(t: Tables) -> DataFrame:
    folder = scratch_path(t.spark, "bundle")
    W.save_tables({"lines": t.lineitem.select("l_orderkey", "l_linenumber", "l_discount")}, folder)
    return R.read_delim(t.spark, f"{folder}/csv/lines", ";", "l_orderkey bigint, l_linenumber int, l_discount string")


@query("snk_csv", "SELECT p_partkey, p_name, p_brand FROM part WHERE p_size < 5")
def snk_csv(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "filtered")
    W.write_csv(t.part.where("p_size < 5").select("p_partkey", "p_name", "p_brand"), path)
    return R.read_csv(t.spark, path, "p_partkey bigint, p_name string, p_brand string")


@query("snk_nulls", """
SELECT d.doc_id, l.quality, CASE WHEN l.quality = 1 THEN '' || d.source END AS source
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""")
def snk_nulls(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "nulls")
    W.write_delim(labelled(t).select("doc_id", "quality", F.when(F.col("quality") == 1, F.col("source")).alias("source")), path)
    return R.read_delim(t.spark, path, ";", "doc_id bigint, quality int, source string")


@query("snk_excel_csv", "SELECT * FROM customer")
def snk_excel_csv(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "excel")
    W.write_excel_csv(t.customer, path)
    return R.read_csv(t.spark, path, CUSTOMER)


@query("snk_parquet", """
SELECT c_custkey, c_name, n_name FROM customer JOIN nation ON c_nationkey = n_nationkey""")
def snk_parquet(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "parquet")
    joined = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
    W.write_parquet(joined.select("c_custkey", "c_name", "n_name"), path)
    return R.read_parquet(t.spark, path)


@query("snk_json", """
SELECT d.doc_id, d.source, l.quality, 2 AS copies FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""")
def snk_json(t: Tables) -> DataFrame:
    """Written as lines and as arrays; both are read back and must agree."""
    lines, arrays = scratch_path(t.spark, "json-lines"), scratch_path(t.spark, "json-arrays")
    rows = labelled(t).select("doc_id", "source", "quality")
    W.write_json(rows, lines)
    W.write_json_array(rows, arrays)
    schema = "doc_id bigint, source string, quality int"
    both = t.spark.read.schema(schema).json(lines).unionByName(t.spark.read.schema(schema).option("multiLine", True).json(arrays))
    return both.groupBy("doc_id", "source", "quality").agg(F.count(F.lit(1)).cast("int").alias("copies"))


@query("publish_db", """
SELECT 'customer' AS table_name, count(*) AS n FROM customer UNION ALL SELECT 'part', count(*) FROM part""")
def publish_db(t: Tables) -> DataFrame:
    folder = scratch_path(t.spark, "database")
    tag = folder.rsplit("-", 1)[1][:12]
    source, target = f"draft_{tag}", f"live_{tag}"
    t.spark.sql(f"CREATE DATABASE {source} LOCATION '{folder}/draft'")
    for name in ("customer", "part"):
        getattr(t, name).write.format("parquet").saveAsTable(f"{source}.{name}")
    names = PUB.publish_database(t.spark, source, target, f"{folder}/live")
    counts = [t.spark.table(f"{target}.{n}").agg(F.lit(n).alias("table_name"), F.count(F.lit(1)).alias("n")) for n in names]
    return counts[0].unionByName(counts[1])
