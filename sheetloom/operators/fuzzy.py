"""Edit-distance join by blocking on exact pieces (Pass-Join: Li, Deng, Wang and Feng, VLDB 2012).

A text of length l is cut into d + 1 pieces. A text within d edits of it must contain at least one
piece unchanged, at a position that the piece's number and the two lengths allow. Pieces and the
allowed substrings meet in an ordinary equi-join on (length, piece number, piece); only those
candidates are compared. Texts too short to cut meet in a join on their few possible lengths.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sheetloom.operators.joins import backbone_match, equi_join, lookup_join
from sheetloom.session import staged


def _piece_start(length: Column, number: Column, pieces: int) -> Column:
    """Where piece ``number`` (from 1) starts, from 1; the later pieces take the remainder."""
    base = F.floor(length / pieces).cast("int")
    short = pieces - length % pieces
    return (number - 1) * base + F.greatest(number - 1 - short, F.lit(0)) + 1


def _piece_length(length: Column, number: Column, pieces: int) -> Column:
    base = F.floor(length / pieces).cast("int")
    return base + F.when(number > pieces - length % pieces, 1).otherwise(0)


def _pieces(text: Column, pieces: int) -> Column:
    length = F.length(text)

    def cut(number: Column) -> Column:
        return F.struct(
            length.alias("len"),
            number.alias("piece"),
            F.substring(text, _piece_start(length, number, pieces), _piece_length(length, number, pieces)).alias("part"),
        )

    return F.transform(F.sequence(F.lit(1), F.lit(pieces)), cut)


def _substrings(text: Column, d: int) -> Column:
    """Substrings that may equal a piece of a text whose length differs by at most d."""
    pieces = d + 1
    length = F.length(text)

    def for_length(other: Column) -> Column:
        shift = length - other

        def for_piece(number: Column) -> Column:
            start, size = _piece_start(other, number, pieces), _piece_length(other, number, pieces)
            low = F.greatest(F.lit(1), start - (number - 1), start + shift - (pieces - number))
            high = F.least(length - size + 1, start + (number - 1), start + shift + (pieces - number))
            places = F.when(low <= high, F.sequence(low, high)).otherwise(F.array().cast("array<int>"))
            return F.transform(
                places,
                lambda at: F.struct(other.alias("len"), number.alias("piece"), F.substring(text, at, size).alias("part")),
            )

        return F.flatten(F.transform(F.sequence(F.lit(1), F.lit(pieces)), for_piece))

    lengths = F.filter(F.sequence(F.greatest(length - d, F.lit(0)), length + d), lambda other: other >= pieces)
    return F.flatten(F.transform(lengths, for_length))


def fuzzy_pairs(left: DataFrame, right: DataFrame, max_dist: int = 3, ignore_case: bool = True) -> DataFrame:
    """Pairs of distinct texts within ``max_dist`` edits: ``left_text``, ``right_text``, ``distance``.

    Both inputs have one column ``text``.
    """
    pieces = max_dist + 1

    def prepared(df: DataFrame, side: str) -> DataFrame:
        texts = df.where("text is not null").select("text").distinct()
        folded = F.lower("text") if ignore_case else F.col("text")
        return texts.select(F.col("text").alias(f"{side}_text"), folded.alias(f"{side}_key"))

    a, b = prepared(left, "left"), prepared(right, "right")
    if ignore_case:
        # Spellings that differ in case only share one key, so the search runs on keys.
        keys_a, keys_b = a.select("left_key").distinct(), b.select("right_key").distinct()
    else:
        keys_a, keys_b = a.select("left_key"), b.select("right_key")
    probes = keys_a.select("left_key", F.explode(F.array_distinct(_substrings(F.col("left_key"), max_dist))).alias("_s"))
    index = keys_b.where(F.length("right_key") >= pieces).select(
        "right_key", F.explode(_pieces(F.col("right_key"), pieces)).alias("_s")
    )
    long = probes.select("left_key", "_s.*").join(index.select("right_key", "_s.*"), ["len", "piece", "part"])
    # A text shorter than d + 1 cannot be cut; whatever is near it has at most 2d characters.
    tiny = keys_b.where(F.length("right_key") < pieces).select(
        "right_key", F.explode(F.sequence(F.lit(0), F.length("right_key") + max_dist)).alias("len")
    )
    near = keys_a.where(F.length("left_key") < pieces + max_dist).select("left_key", F.length("left_key").alias("len"))
    short = near.join(tiny, "len")
    distance = F.levenshtein("left_key", "right_key", max_dist)
    verified = (
        long.select("left_key", "right_key")
        .unionByName(short.select("left_key", "right_key"))
        .withColumn("distance", distance)
        .where(F.col("distance") >= 0)
        .distinct()
    )
    if not ignore_case:
        return verified.withColumnsRenamed({"left_key": "left_text", "right_key": "right_text"})
    return verified.join(a, "left_key").join(b, "right_key").select("left_text", "right_text", "distance")


def fuzzy_join(
    left: DataFrame, right: DataFrame, left_on: str, right_on: str, max_dist: int = 3, ignore_case: bool = True,
    distance: str = "distance",
) -> DataFrame:
    """Inner join of rows whose texts lie within ``max_dist`` edits.

    The search runs on distinct texts, so copies cost nothing; rows are attached afterwards.
    """
    pairs = fuzzy_pairs(
        left.select(F.col(left_on).alias("text")), right.select(F.col(right_on).alias("text")), max_dist, ignore_case
    ).withColumnRenamed("distance", distance)
    with_left = lookup_join(left, pairs, [(left_on, "left_text")], "inner")
    joined = equi_join(with_left, right.withColumnRenamed(right_on, "_match"), [("right_text", "_match")])
    return joined.withColumnRenamed("right_text", right_on if right_on not in left.columns else f"matched_{right_on}")


def backbone_match_near(names: DataFrame, name: str, backbone: DataFrame, canonical: str, base_url: str, max_dist: int = 2) -> DataFrame:
    """Attach backbone columns by exact canonical name, and by edit distance for the names left over.

    ``match_name`` is the name met and ``match_distance`` its distance: 0 for an equal name, else the least one within
    ``max_dist`` edits, letter case aside; the first name in text order counts among several. Only distinct names
    without an equal one are searched for. Names near none keep null columns.
    """
    known = backbone.select(F.col(canonical).alias("text")).distinct()
    given = staged(names.select(F.col(name).alias("text")).where("text IS NOT NULL").distinct(), "names")
    equal = equi_join(given, known, ["text"], "left_semi").select("text", F.col("text").alias("match_name"), F.lit(0).alias("match_distance"))
    left_over = equi_join(given, known, ["text"], "left_anti")
    pairs = fuzzy_pairs(left_over, known, max_dist)
    best = pairs.groupBy("left_text").agg(F.min(F.struct("distance", "right_text")).alias("b"))
    near = best.select(F.col("left_text").alias("text"), F.col("b.right_text").alias("match_name"), F.col("b.distance").alias("match_distance"))
    matches = staged(equal.unionByName(near), "matches")
    matched = lookup_join(names, matches, [(name, "text")], "left")
    return backbone_match(matched, "match_name", backbone, canonical, base_url)
