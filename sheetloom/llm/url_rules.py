"""Block and allow rules for URLs by a sort-merge range join.

A host is turned around label by label (``www.example.net`` becomes ``net.example.www.``), so that a host and all its
subdomains are one interval of keys. URLs and rules are dealt over ranges of the key, each range gets the rules whose
interval reaches into it, and one sweep over the sorted rows of a range keeps a stack of the nested rule hosts that are
open; the rules of those hosts whose path begins the URL's path fit, and the longest wins.

Defined results: the host is what follows the first ``://`` up to ``/``, ``?``, ``#`` or the end, with A-Z lower-cased,
the path what follows it up to ``?``, ``#`` or the end; both are empty for a null URL or one without ``://``. A rule is
``host/path``, its path starts with the slash. The longest rule is the one with most characters, then the one with the
longer host; of equal rules with different verdicts ``block`` wins. A URL that no rule fits gets ``default``. Repeated
rows give repeated results; rules with a null in a needed column fit nothing; empty tables are fine. Extra columns of
the URL table are ignored.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sheetloom.llm.common import partitions

# Keys sampled for each range; they place the edges of the ranges and change no result.
SAMPLE = 64


def host_and_path(url: Column) -> tuple[Column, Column]:
    rest = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://(.*)$", 1)
    host = F.translate(F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)
    return host, path


def turned(host: Column) -> Column:
    """Reversed labels, each followed by a dot; empty for an empty host."""
    return F.when(host == "", F.lit("")).otherwise(F.concat(F.array_join(F.reverse(F.split(host, r"\.", -1)), "."), F.lit(".")))


def _sweep(batches: Iterator[pa.RecordBatch], schema: pa.Schema, default: str) -> Iterator[pa.RecordBatch]:
    part, stack = None, []  # of the open hosts: (key, {path: (rule, verdict)}, path lengths)
    for batch in batches:
        out: list[tuple] = []
        rows = batch.to_pydict()
        for at, key, is_url, row, host, path, rule, verdict in zip(*(rows[c] for c in ("part", "key", "is_url", "id", "host", "path", "rule", "verdict")), strict=True):
            if at != part:
                part, stack = at, []
            while stack and not key.startswith(stack[-1][0]):
                stack.pop()
            if not is_url:
                if not stack or stack[-1][0] != key:
                    stack.append((key, {}, []))
                _, paths, lengths = stack[-1]
                if path not in paths or verdict == "block":
                    paths[path] = (rule, verdict)
                    if len(path) not in lengths:
                        lengths.append(len(path))
                continue
            best = None
            for depth, (_, paths, lengths) in enumerate(stack):
                for n in lengths:
                    if n <= len(path) and (hit := paths.get(path[:n])):
                        score = (len(hit[0]), depth)
                        if best is None or score > best[0]:
                            best = (score, hit)
            out.append((row, host, path, best[1][0] if best else None, best[1][1] if best else default))
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), schema, strict=True)], schema=schema)


def judge(urls: DataFrame, rules: DataFrame, page_id: str = "page_id", url: str = "url", default: str = "allow") -> DataFrame:
    """page_id, host, path, rule, verdict for each row of ``urls``; ``rules`` has columns ``rule`` and ``verdict``."""
    host, path = host_and_path(F.col(f"`{url}`"))
    parts = partitions(urls.sparkSession)
    rows = urls.select(F.col(f"`{page_id}`").alias("id"), host.alias("host"), path.alias("path"))
    rows = rows.withColumn("key", F.concat(turned(F.col("host")), F.lit("\t"), F.col("path")))
    # The edges of the ranges come from a bounded sample of the keys, as those of any range partitioning do.
    total = urls.count()
    share = min(1.0, 2 * SAMPLE * parts / max(1, total))
    some = [r[0] for r in rows.select("key").sample(share, seed=1).limit(4 * SAMPLE * parts).collect()]
    some.sort(key=lambda k: k.encode())
    edges = [some[i * len(some) // parts].encode() for i in range(1, parts)] if some else []
    kind = dict(rows.dtypes)["id"]

    @F.pandas_udf("int")
    def range_of(key, salt):
        # Equal keys that fill several ranges are spread over them.
        first = [(bisect_left(edges, k.encode()), bisect_right(edges, k.encode())) for k in key]
        return type(salt)([a + s % (b - a + 1) for (a, b), s in zip(first, salt, strict=True)])

    @F.pandas_udf("array<int>")
    def ranges_of(key):
        # The last key of the interval is the first one without the prefix: the closing dot plus one.
        def reach(k):
            low = k.encode()
            high = low[:-1] + bytes([low[-1] + 1]) if low else None
            return list(range(bisect_left(edges, low), (bisect_left(edges, high) if high is not None else len(edges)) + 1))

        return type(key)([reach(k) for k in key])

    salt = F.pmod(F.xxhash64("id", "path"), F.lit(1 << 30)).cast("int")
    dealt = rows.withColumn("part", range_of("key", salt)).select(
        "part", "key", F.lit(True).alias("is_url"), "id", "host", "path", F.lit(None).cast("string").alias("rule"), F.lit(None).cast("string").alias("verdict")
    )
    sound = rules.select(F.col("rule").cast("string"), F.col("verdict").cast("string")).where("rule is not null and verdict is not null and instr(rule, '/') > 0").distinct()
    rule_host = F.translate(F.substring_index("rule", "/", 1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    rule_path = F.expr("substring(rule, instr(rule, '/'))")
    dealt_rules = (
        sound.withColumn("key", turned(rule_host))
        .withColumn("part", F.explode(ranges_of("key")))
        .select("part", "key", F.lit(False).alias("is_url"), F.lit(None).cast(kind).alias("id"), rule_host.alias("host"), rule_path.alias("path"), "rule", "verdict")
    )
    both = dealt.unionByName(dealt_rules).repartitionById(parts, F.col("part")).sortWithinPartitions("part", "key", "is_url", "path", "verdict")
    from pyspark.sql.pandas.types import to_arrow_type
    schema = pa.schema([("page_id", to_arrow_type(both.schema["id"].dataType)), ("host", pa.string()), ("path", pa.string()), ("rule", pa.string()), ("verdict", pa.string())])
    return both.mapInArrow(lambda batches: _sweep(batches, schema, default), f"page_id {kind}, host string, path string, rule string, verdict string")
