"""One query per operator, with production parameters on whole tables."""

from __future__ import annotations

import zlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sheetloom.llm import bpe, ctw, digest_index, line_chunks, mips, mixing, phrases, pieces, simhash, spelling, toxicity, url_rules, warc
from sheetloom.llm.common import partitions
from sheetloom.llm.registry import query, table
from sheetloom.session import scratch_path

# The rules of the URL query.
URL_RULES = [("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow")]


def vocabulary() -> tuple[dict[bytes, int], str]:
    """Ranks and pattern of the public byte-level vocabulary."""
    import public_tokenizers

    return bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken")), public_tokenizers.PATTERN


def piece_model() -> pieces.Model:
    """The public merge-type model."""
    import public_tokenizers

    return pieces.Model(public_tokenizers.path("piece_bpe_32k.model"))


@query("op1_mix_sources")
def op1(spark: SparkSession, folder: str) -> DataFrame:
    """Words taken of each document when all sources are mixed to target weights."""
    return mixing.mix_plan(table(spark, folder, "documents")).select("doc_id", "size", "source_size", "target", "taken", "first_slot")


@query(
    "op2_warc",
    """
    SELECT page_id, octet_length(encode(coalesce(html, '')))::BIGINT AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest,
           CASE WHEN octet_length(encode(coalesce(html, ''))) >= 1000 AND page_id <> max(page_id) OVER (PARTITION BY html) THEN 'revisit' ELSE 'response' END AS record_type,
           CASE WHEN octet_length(encode(coalesce(html, ''))) >= 1000 AND page_id <> max(page_id) OVER (PARTITION BY html) THEN max(page_id) OVER (PARTITION BY html) END AS refers_to
    FROM pages
    """,
)
def op2(spark: SparkSession, folder: str) -> DataFrame:
    """All pages written to WARC archives, equal payloads once, and read back."""
    return warc.archive_pages(table(spark, folder, "pages"), scratch_path(spark, "warc"))


@query("op3_context_tree")
def op3(spark: SparkSession, folder: str) -> DataFrame:
    """Context-tree scores of all documents, beside a word model."""
    return ctw.scores(table(spark, folder, "documents"))


@query(
    "op4_top_inner_products",
    """
    WITH v AS (
      SELECT vec_id, [floor(1024 * x::DOUBLE)::BIGINT FOR x IN embedding] AS v FROM embeddings
      WHERE embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
    ), s AS (
      SELECT q.vec_id AS query_id, c.vec_id, list_sum([p[1] * p[2] FOR p IN list_zip(q.v, c.v)])::BIGINT AS score
      FROM v q JOIN v c ON q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id
    )
    SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank, vec_id, score
    FROM s QUALIFY rank <= 10
    """,
)
def op4(spark: SparkSession, folder: str) -> DataFrame:
    """The ten candidates with the largest inner product for every hundredth vector."""
    rows = table(spark, folder, "embeddings")
    return mips.top_k(rows, rows.where("vec_id % 100 = 0"), 10)


@query(
    "op5_exact_dedup",
    """
    SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size, doc_id = max(doc_id) OVER w AS kept, sha256(coalesce(text, '')) AS text_sha256
    FROM documents WINDOW w AS (PARTITION BY coalesce(text, ''))
    """,
)
def op5(spark: SparkSession, folder: str) -> DataFrame:
    """All documents deduplicated against a new digest index, which keeps their digests."""
    index = digest_index.DigestIndex(spark, scratch_path(spark, "digests"), partitions(spark))
    return index.dedup(table(spark, folder, "documents")).drop("indexed")


@query(
    "op6_url_rules",
    r"""
    WITH rest AS (SELECT page_id, regexp_extract(coalesce(url, ''), '(?s)^.*?://(.*)$', 1) AS r FROM pages),
    parts AS (
      SELECT page_id, translate(regexp_extract(r, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
             regexp_extract(r, '^[^/?#]*([^?#]*)', 1) AS path
      FROM rest
    ), rules(rule, rule_host, rule_path, verdict) AS (
      VALUES ('net/', 'net', '/', 'block'), ('example.net/en/', 'example.net', '/en/', 'allow'), ('example.com/de/', 'example.com', '/de/', 'block'), ('org/fr/', 'org', '/fr/', 'allow')
    ), fits AS (
      SELECT p.page_id, r.rule, r.verdict, row_number() OVER (PARTITION BY p.page_id ORDER BY length(r.rule) DESC) AS n
      FROM parts p JOIN rules r ON (p.host = r.rule_host OR ends_with(p.host, '.' || r.rule_host)) AND starts_with(p.path, r.rule_path)
    )
    SELECT p.page_id, p.host, p.path, f.rule, coalesce(f.verdict, 'allow') AS verdict FROM parts p LEFT JOIN fits f ON p.page_id = f.page_id AND f.n = 1
    """,
)
def op6(spark: SparkSession, folder: str) -> DataFrame:
    """The verdict on the URL of every page."""
    rules = spark.createDataFrame(URL_RULES, "rule string, verdict string")
    return url_rules.judge(table(spark, folder, "pages"), rules)


@query("op7_byte_bpe")
def op7(spark: SparkSession, folder: str) -> DataFrame:
    """Every text encoded and decoded again."""
    ranks, pattern = vocabulary()
    ids = bpe.encode(table(spark, folder, "documents").select("doc_id", "text"), ranks, pattern)
    return bpe.decoded_digest(ids, ranks).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")


@query("op8_simhash")
def op8(spark: SparkSession, folder: str) -> DataFrame:
    """Fingerprint and near-duplicate component of every document."""
    return simhash.near_groups(table(spark, folder, "documents"))


@query("op9_line_chunks")
def op9(spark: SparkSession, folder: str) -> DataFrame:
    """What is left of every document once repeated chunks of lines are out."""
    new = line_chunks.dedup_lines(table(spark, folder, "documents"), counts=True)
    return new.select("doc_id", "n_chars", "n_chunks", "dropped_chunks", "dropped_words", F.sha2(F.col("text").cast("binary"), 256).alias("text_sha256"))


@query("op10_toxicity")
def op10(spark: SparkSession, folder: str) -> DataFrame:
    """Toxicity of every document, learnt from labels outside the held-out fold."""
    docs = table(spark, folder, "documents")
    model = toxicity.Toxicity(docs, table(spark, folder, "labels"))
    return model.score(docs, keep=[F.col("doc_id"), toxicity.is_held_out(F.col("doc_id")).alias("held_out")])


def misspelt(doc_id: str, word: str) -> str:
    """The word, or for one in 97 by the check sum of id and word, the word without one of its characters."""
    h = zlib.crc32(f"{doc_id}:{word}".encode())
    return word if h % 97 else word[: h % len(word)] + word[h % len(word) + 1 :]


@query("op11_spelling_variants")
def op11(spark: SparkSession, folder: str) -> DataFrame:
    """Every frequent word of all documents, with the form and the root that it is a variant of."""
    return spelling.variants(spelling.word_counts(table(spark, folder, "documents"), change=misspelt))


@query(
    "op12_collocations",
    r"""
    WITH docs AS (SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
    pieces AS (SELECT lang, unnest(regexp_split_to_array(t, '[.,;:!?\x0A-\x0D]')) AS p FROM docs),
    words AS (SELECT lang, [x FOR x IN regexp_split_to_array(p, '[\x20\x09]+') IF x <> ''] AS w FROM pieces),
    totals AS (SELECT lang, sum(len(w))::BIGINT AS n FROM words GROUP BY lang),
    grams AS (SELECT lang, unnest(flatten([[array_to_string(w[i:i + k - 1], ' ') FOR i IN range(1, len(w) - k + 2)] FOR k IN range(1, 6)])) AS phrase FROM words),
    f AS (SELECT lang, phrase, count(*)::BIGINT AS f, string_split(phrase, ' ') AS w FROM grams GROUP BY lang, phrase HAVING count(*) >= 100),
    c AS (SELECT lang, phrase, f AS a, w FROM f WHERE len(w) > 1),
    inner_ AS (SELECT lang, a, unnest(flatten([[array_to_string(w[i:i + k - 1], ' ') FOR i IN range(1, len(w) - k + 2)] FOR k IN range(2, len(w))])) AS phrase FROM c WHERE len(w) > 2),
    open_ AS (SELECT c.* FROM c ANTI JOIN inner_ i ON c.lang = i.lang AND c.phrase = i.phrase AND 100 * i.a >= 100 * c.a),
    cuts AS (SELECT *, unnest(range(1, len(w))) AS k FROM open_),
    scored AS (
      SELECT c.lang, c.phrase, c.a, c.k, l.f AS l, r.f AS r, t.n, ((1000::HUGEINT * c.a * t.n) // (l.f::HUGEINT * r.f))::BIGINT AS score
      FROM cuts c JOIN totals t ON c.lang = t.lang
      JOIN f l ON c.lang = l.lang AND array_to_string(c.w[1:c.k], ' ') = l.phrase JOIN f r ON c.lang = r.lang AND array_to_string(c.w[c.k + 1:], ' ') = r.phrase
    ), least AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1)
    SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score FROM least QUALIFY rank <= 2000
    """,
)
def op12(spark: SparkSession, folder: str) -> DataFrame:
    """The phrases of each language whose words stand together most above chance."""
    return phrases.collocations(table(spark, folder, "documents")).withColumnRenamed("name", "lang")


@query("op13_pieces")
def op13(spark: SparkSession, folder: str) -> DataFrame:
    """Every text encoded into pieces and decoded again."""
    model = piece_model()
    coded = pieces.encode(table(spark, folder, "documents").select("doc_id", "text"), model)
    back = pieces.decode(coded, model)
    return back.select("doc_id", "n_tokens", "ids_sha256", F.sha2(F.col("text").cast("binary"), 256).alias("decoded_sha256"))
