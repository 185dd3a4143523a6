"""Mixing sources to target weights by a low-discrepancy schedule.

The mix is a row of slots of equally many words. Slot ``i`` takes the ``i``-th van der Corput point, whose place among
the cumulative shares names its source, so that every stretch of the schedule holds the sources in proportion. The
rank of a slot among those of its source names the block it takes: the documents of a source, in random order, laid
end to end and cut every ``block`` words. A source whose target exceeds its size starts over with its first block.

Defined results: a null text is empty; documents without words get no slot and take nothing; null is a source of its
own, the last one; rows that are equal in all columns are laid out one after the other; an empty table gives an empty
mix. Extra columns of any name are left alone.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sheetloom.llm.common import bits_for, partitions, row_hash, running_total, word_count
from sheetloom.operators.ordering import row_numbers
from sheetloom.session import staged

WEIGHTS = (5, 2, 1)
SHARE = 1.5
REPEAT = 2.0
BLOCK = 1024
SEED = 7
# Rows that meet in the first cells of a running total, as a power of two.
CELL_BITS = 8


def targets(sizes: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE, repeat: float = REPEAT) -> DataFrame:
    """Target words of each source; ``sizes`` has one row per source: ``_src`` (in order of rank) and ``source_size``.

    Sources weigh ``weights`` in turn and share ``share`` times all words. None gets more than ``repeat`` times its
    size; what is over goes to the others by weight, until none is above. Each round is one sum over the sources.
    """
    ranked = row_numbers(sizes, [], ["_src"], "_rank").withColumn("_rank", F.col("_rank") - 1)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("_rank") % len(weights) + 1).cast("int"))
    ranked = staged(ranked.withColumn("_weight", weight).withColumn("_cap", F.lit(float(repeat)) * F.col("source_size")), "sources")
    total, weigh = ranked.agg(F.sum("source_size"), F.sum("_weight")).first()
    wanted = share * (total or 0)
    level, held = (wanted / weigh if weigh else 0.0), -1
    while True:
        full = F.col("_cap") <= F.lit(level) * F.col("_weight")
        n, taken, rest = ranked.agg(
            F.count_if(full), F.sum(F.when(full, F.col("_cap"))), F.sum(F.when(~full, F.col("_weight")))
        ).first()
        if n == held or not rest:
            break
        level, held = (wanted - (taken or 0.0)) / rest, n
    return ranked.withColumn("target", F.least(F.col("_cap"), F.lit(level) * F.col("_weight")))


def _bit_reversed(number: Column, bits: int) -> Column:
    return F.conv(F.reverse(F.lpad(F.bin(number), bits, "0")), 2, 10).cast("long")


def slots(sources: DataFrame, block: int = BLOCK) -> DataFrame:
    """The schedule: ``slot`` (its place), ``_src``, ``_block`` and ``words`` (fewer than a block at an end only).

    The shares are whole numbers of slots, so the points are those of the sequence that fall on one of them, and each
    slot is hit once.
    """
    spark = sources.sparkSession
    wanted = F.least(F.round("target"), F.floor("_cap")).cast("long")
    laid = (
        sources.where("source_size > 0")
        .select("_src", "_rank", "source_size", wanted.alias("_wanted"))
        .withColumn("_rounds", F.expr("_wanted div source_size"))
        .withColumn("_blocks", F.expr(f"(source_size + {block - 1}) div {block}"))
        .withColumn("_rest", F.expr("_wanted - _rounds * source_size"))
        .withColumn("_slots", F.expr(f"_rounds * _blocks + (_rest + {block - 1}) div {block}"))
    )
    count, ranks = laid.agg(F.sum("_slots"), F.max("_rank")).first()
    count, ranks = count or 0, ranks or 0
    laid = running_total(laid, [], "_rank", "_slots", "_from", bits_for(ranks + 1))
    # A stretch of 64 points meets the sources that have a share in it.
    pieces = laid.where("_slots > 0").withColumn("_stretch", F.explode(F.expr("sequence(_from div 64, (_from + _slots - 1) div 64)")))
    points = spark.range(0, count, 1, max(1, min(partitions(spark), count // 4096))).select(F.col("id").alias("_point"))
    points = points.withColumn("_stretch", F.expr("_point div 64"))
    # Spark sizes what an explosion makes as if each row stayed one, so it must not choose to broadcast the pieces.
    met = points.join(pieces.hint("merge"), (points["_stretch"] == pieces["_stretch"]) & F.expr("_point >= _from and _point < _from + _slots"))
    bits = bits_for(count)
    placed = met.select("_src", "source_size", "_rounds", "_blocks", "_rest", _bit_reversed(F.col("_point"), bits).alias("slot"), F.lit(1).alias("_one"))
    ranked = running_total(placed, ["_src"], "slot", "_one", "_nth", bits)
    number = F.expr("if(_nth < _rounds * _blocks, _nth % _blocks, _nth - _rounds * _blocks)")
    length = F.expr(f"least({block}, source_size - _block * {block})")
    words = F.expr(f"if(_nth < _rounds * _blocks, {block}, _rest - _block * {block})")
    return ranked.withColumn("_block", number).select("_src", "slot", "_block", F.least(length, words).alias("words"), length.alias("_full"))


def mix_plan(
    docs: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE, repeat: float = REPEAT, block: int = BLOCK,
    doc_id: str = "doc_id", text: str = "text", source: str = "source",
) -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target, taken, first_slot (null if not taken).

    ``row_key`` and ``copy`` tell equal rows apart: the hash of the whole row, and a number from 0 among equal ones.
    """
    spark = docs.sparkSession
    name = F.col(f"`{source}`")
    src = F.when(name.isNull(), F.lit("1")).otherwise(F.concat(F.lit("0"), name.cast("string")))
    slim = docs.select(
        src.alias("_src"), F.col(f"`{doc_id}`").alias("doc_id"), name.alias("source"),
        word_count(F.col(f"`{text}`")).alias("size"), row_hash(docs).alias("row_key"),
    )
    # Equal rows are counted before the shuffle, and laid out as one.
    units = staged(slim.groupBy("_src", "doc_id", "source", "size", "row_key").agg(F.count(F.lit(1)).alias("_copies")), "mix-units")
    units = units.withColumn("_words", F.col("size") * F.col("_copies"))
    sources = staged(targets(units.groupBy("_src").agg(F.sum("_words").alias("source_size")), weights, share, repeat), "mix-targets")
    bits = max(bits_for(units.count()) - CELL_BITS, 0) + CELL_BITS
    shuffled = units.withColumn("_place", F.shiftrightunsigned(F.xxhash64(F.lit(SEED), "doc_id", "row_key"), 64 - bits))
    laid = running_total(shuffled, ["_src"], "_place", "_words", "_from", bits, ("doc_id", "row_key"))
    each = laid.withColumn("copy", F.explode(F.expr("sequence(0, _copies - 1)"))).withColumn("_start", F.expr("_from + copy * size"))
    # A document lies in one block or, if it is long, in several.
    cut = F.explode_outer(F.expr(f"if(size = 0, null, sequence(_start div {block}, (_start + size - 1) div {block}))"))
    pieces = each.select("_src", "doc_id", "source", "size", "row_key", "copy", "_start", cut.alias("_block"))
    low = F.greatest(F.col("_start"), F.col("_block") * block) - F.col("_block") * block
    high = F.least(F.col("_start") + F.col("size"), (F.col("_block") + 1) * block) - F.col("_block") * block
    pieces = pieces.withColumn("_low", low).withColumn("_high", high)
    short = F.col("words") < F.col("_full")
    uses = slots(sources, block).groupBy("_src", "_block").agg(
        F.count_if(~short).alias("_whole"), F.coalesce(F.max(F.when(short, F.col("words"))), F.lit(0)).alias("_part"), F.min("slot").alias("slot")
    )
    got = F.coalesce(F.expr("_whole * (_high - _low) + greatest(0, least(_high, _part) - _low)"), F.lit(0))
    used = pieces.join(uses, ["_src", "_block"], "left").withColumn("_got", got)
    taken = used.groupBy("_src", "doc_id", "source", "size", "row_key", "copy").agg(
        F.sum("_got").cast("long").alias("taken"), F.min(F.when(F.col("_got") > 0, F.col("slot"))).alias("first_slot")
    )
    return taken.join(sources.select("_src", "source_size", "target"), "_src").drop("_src")


def mixed(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", **options) -> DataFrame:
    """The mix itself: the columns of ``docs``, a document once for each time it is taken, in the order of the schedule.

    At most one document per source is taken in part; its text ends after the last word that is taken, and a column
    ``n_chars`` follows it.
    """
    plan = mix_plan(docs, doc_id=doc_id, text=text, source=source, **options).where("taken > 0")
    unit = plan.groupBy("row_key").agg(
        F.sum(F.expr("taken div size")).alias("_mix_times"), F.max(F.expr("taken % size")).alias("_mix_cut"), F.min("first_slot").alias("_mix_slot")
    ).withColumnRenamed("row_key", "_mix_key")
    names = [F.col(f"`{c}`") for c in docs.columns]
    rows = docs.select(row_hash(docs).alias("_mix_key"), F.struct(*names).alias("_mix_row")).dropDuplicates(["_mix_key"])
    copies = F.expr("concat(array_repeat(0L, cast(_mix_times as int)), if(_mix_cut > 0, array(_mix_cut), cast(array() as array<bigint>)))")
    each = rows.join(unit, "_mix_key").withColumn("_mix_words", F.explode(copies))
    body = F.col("_mix_row")[text]
    start = F.array_join(F.slice(F.regexp_extract_all(body, F.lit(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+"), F.lit(0)), 1, F.col("_mix_words").cast("int")), "")
    new = F.when(F.col("_mix_words") > 0, start).otherwise(body)
    spread = each.withColumn("_mix_text", new).repartitionByRange(partitions(docs.sparkSession), "_mix_slot", "_mix_key").sortWithinPartitions("_mix_slot", "_mix_key")
    out = []
    for c, kind in docs.dtypes:
        value = F.col("_mix_row")[c]
        if c == text:
            value = F.col("_mix_text")
        elif c == "n_chars":
            value = F.when(F.col("_mix_words") > 0, F.length("_mix_text").cast(kind)).otherwise(value)
        out.append(value.alias(c))
    return spread.select(*out)
