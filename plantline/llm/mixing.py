"""Mixing sources to target weights by a low-discrepancy schedule, in DataFrame operations only.

The mix is a row of slots of equally many words. Slot n stands at the golden-ratio
point n * step modulo 2^m (step is 2^m / golden ratio, made odd), times the words of
a slot: with 2^m no less than the number of slots, every place of the sources'
cumulative targets is met once, and any run of slots is spread evenly over them.
The place names the slot's source. Slots are ranked per source, and rank k takes
the k-th block of that source: its documents, shuffled by a hash and repeated, cut
into blocks of the same number of words. A source gives the words of the slots it
has won, at most ``passes`` times its own; these are within a slot of its target. A
source whose target is too small to win any gets one slot, of its target's words.

Targets: each source's share of all words by its weight, at most ``passes``
times its own words; the excess is shared again by weight until none is above.

Defined results: a null text or one without words has size 0 and takes no words;
sources are ordered by code point, a null source is one source and comes last;
rows that are equal in all columns stand in the mix separately; rows that differ in
any column are never taken for each other; a null doc_id is
a document like any other; an empty table gives no rows; other columns pass
through unless they carry a name of the result.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plantline.llm.common import WORD, blocks_of, own_names, row_key, stored
from plantline.operators.ordered import running_totals

#: At least so many slots, as long as they hold a word each, and at most so many (the square of 2^m fits a long).
LEAST_SLOTS, MOST_SLOTS = 1 << 20, 1 << 31
GOLDEN = 0.6180339887498949
RESULT = ("size", "source_size", "target", "taken")


def n_words(text: str = "text"):
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("bigint")


def source_targets(sources: DataFrame, weights: tuple[int, ...], passes: int) -> DataFrame:
    """(skey, words) with weight, target and whole words to take; one small job for each round of sharing."""
    wide = "decimal(38,0)"
    ordered = running_totals(
        sources.withColumn("one", F.lit(1)), [], F.substring("skey", 1, 3), [F.col("skey")], {"place": F.col("one")}
    )
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.pmod(F.col("place") - 1, F.lit(len(weights))) + 1).cast("int"))
    weighed = stored(ordered.select("skey", "words", weight.cast("bigint").alias("weight")), "mix-sources")
    total = weighed.agg(F.coalesce(F.sum("words"), F.lit(0))).first()[0]
    held, over = 0, None
    level = weighed.agg(F.coalesce(F.sum("weight"), F.lit(0))).first()[0]
    while True:
        # A source is full if weight * (total - held) / level is above its limit.
        limit = F.col("words").cast(wide) * passes * level
        full = F.col("weight").cast(wide) * F.lit(Decimal(total - held)).cast(wide) > limit
        new_held, new_level = weighed.agg(
            F.coalesce(F.sum(F.when(full, F.col("words") * passes)), F.lit(0)),
            F.coalesce(F.sum(F.when(~full, F.col("weight"))), F.lit(0)),
        ).first()
        if (new_held, new_level) == over or new_level == 0:
            break
        over = held, level = new_held, new_level
    target = F.when(full, (F.col("words") * passes).cast("double")).otherwise(
        (F.col("weight") * F.lit(total - held)).cast("double") / F.lit(float(max(1, level)))
    )
    return weighed.select(
        "skey", "words", "weight", target.alias("target"),
        F.least(F.floor(target + 0.5).cast("bigint"), F.col("words") * passes).alias("take"),
    )


def golden_step(bits: int) -> int:
    """Odd, next to 2^bits / golden ratio: its multiples modulo 2^bits meet every number once."""
    return int((1 << bits) * GOLDEN) | 1


def slot_words(total: int, block_words: int, least_slots: int = LEAST_SLOTS) -> int:
    return max(1, min(block_words, -(-total // least_slots)), -(-total // MOST_SLOTS))


def schedule(sources: DataFrame, block_words: int, least_slots: int = LEAST_SLOTS, step: int | None = None) -> tuple[DataFrame, int]:
    """Slots of the mix, (n, skey, k) with k counting the slots of each source from 0, and the words of a slot."""
    spark = sources.sparkSession
    blocks = blocks_of(spark)
    total = sources.agg(F.coalesce(F.sum("take"), F.lit(0))).first()[0]
    length = slot_words(total, block_words, least_slots)
    # As many as have their middle within the targets.
    slots = (total + length - 1 - length // 2) // length
    bits = max(1, (slots - 1).bit_length()) if slots else 1
    cell_words = max(1, -(-total // 1024))
    laid = (
        running_totals(sources, [], F.substring("skey", 1, 3), [F.col("skey")], {"upto": F.col("take")})
        .select("skey", (F.col("upto") - F.col("take")).alias("low"), F.col("upto").alias("high"))
        .where("high > low")
        .withColumn("cell", F.explode(F.sequence(F.floor(F.col("low") / cell_words), F.floor((F.col("high") - 1) / cell_words))))
    )
    turn = F.pmod(F.col("id") * F.lit(golden_step(bits) if step is None else step), F.lit(1 << bits))
    points = (
        spark.range(0, (1 << bits) if slots else 0, 1, blocks)
        .select("id", turn.alias("place")).where(F.col("place") < slots)
        .select(F.col("id").alias("n"), (F.col("place") * length + length // 2).alias("point"))
        .withColumn("cell", F.floor(F.col("point") / cell_words))
    )
    named = stored(points.join(laid, "cell").where("point >= low and point < high").select("n", "skey"), "mix-slots")
    # A source too small for any point gets one slot behind the others.
    missed = sources.where("take > 0").join(named.select("skey").distinct(), "skey", "left_anti")
    named = named.unionByName(missed.select(F.lit(1 << bits).cast("bigint").alias("n"), "skey"))
    block = F.floor(F.col("n") * blocks / (1 << bits))
    ranked = running_totals(named, ["skey"], block, [F.col("n")], {"k": F.lit(1)})
    return ranked.select("n", "skey", (F.col("k") - 1).cast("bigint").alias("k")), length


def identity(docs: DataFrame) -> Column:
    """16 bytes that only rows equal in all columns share."""
    others = [F.col(c) for c in docs.columns if c not in ("doc_id", "text")]
    return F.unhex(F.md5(F.concat_ws("\x01", F.hex(row_key()), F.to_json(F.struct(*others))).cast("binary"))) if others else row_key()


def mix(
    docs: DataFrame,
    weights: tuple[int, ...] = (5, 2, 1),
    passes: int = 3,
    block_words: int = 4096,
    least_slots: int = LEAST_SLOTS,
    step: int | None = None,
) -> tuple[DataFrame, DataFrame]:
    """The documents with what the mix takes of each, and the mix itself.

    The mix has a row for each piece of a document in a slot: (n, skey, k, doc_id,
    mix_key, first_word, words), ``first_word`` counting within the document. Another
    ``step`` than the golden ratio's gives another schedule.
    """
    spark = docs.sparkSession
    blocks = blocks_of(spark)
    carried = [c for c in docs.columns if c not in (*RESULT, "text")]
    skey = F.coalesce(F.concat(F.lit("s"), F.col("source")), F.lit("t"))
    dealt = F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    rows = stored(
        docs.select(*carried, n_words().alias("size"), skey.alias("skey"), dealt.alias("dealt"), identity(docs).alias("mix_key")),
        "mix-rows",
    )
    sources = stored(
        source_targets(rows.groupBy("skey").agg(F.sum("size").alias("words")), weights, passes), "mix-targets"
    )
    scheduled, length = schedule(sources, block_words, least_slots, step)
    slots = stored(scheduled, "mix-schedule")
    per_source = slots.groupBy("skey").agg(F.count(F.lit(1)).alias("slots"))
    # A source gives the blocks of its slots; one too small for any point has its target instead of a block.
    won = F.when((F.col("slots") == 1) & (F.col("take") <= length), F.col("take")).otherwise(
        F.least(F.col("slots") * length, F.col("words") * passes)
    )
    facts = stored(
        sources.join(per_source, "skey", "left").select(
            "skey", F.col("words").alias("source_size"), "target", F.coalesce(won, F.lit(0)).cast("bigint").alias("take")
        ),
        "mix-facts",
    )

    # First 16 bits of the hash follow its order and cut each source into even blocks.
    block = F.floor(F.conv(F.substring("dealt", 1, 4), 16, 10).cast("bigint") * blocks / 65536)
    order = [F.col("dealt"), F.col("doc_id"), F.col("size"), F.col("mix_key")]
    laid = stored(
        running_totals(rows, ["skey"], block, order, {"upto": F.col("size"), "place": F.lit(1)}).join(facts, "skey"),
        "mix-laid",
    )
    start = F.col("upto") - F.col("size") + F.col("turn") * F.col("source_size")
    turns = laid.where("size > 0 and take > 0").withColumn(
        "turn", F.explode(F.sequence(F.lit(0), F.floor((F.col("take") - 1) / F.col("source_size"))))
    )
    cut = (
        turns.withColumns({"start": start, "stop": F.least(start + F.col("size"), F.col("take"))})
        .where("start < stop")
        .withColumn(
            "k",
            F.explode(F.sequence(F.floor(F.col("start") / length), F.floor((F.col("stop") - 1) / length))),
        )
    )
    begin = F.greatest(F.col("start"), F.col("k") * length)
    end = F.least(F.col("stop"), (F.col("k") + 1) * length)
    pieces = cut.select(
        "skey", "place", "doc_id", "mix_key", "k", (begin - F.col("start")).alias("first_word"), (end - begin).alias("words")
    ).join(slots, ["skey", "k"])
    return laid, pieces


@own_names("doc_id", "text", "source", result=RESULT)
def mixed_documents(docs: DataFrame, **settings) -> DataFrame:
    """Every row of ``docs``, without its text, with the words that the mix takes of it."""
    laid, pieces = mix(docs, **settings)
    carried = [c for c in laid.columns if c not in ("upto", "take", "dealt", "mix_key")]
    named = ["skey", "place"]
    taken = pieces.groupBy(*named).agg(F.sum("words").alias("taken"))
    return laid.select(*carried).join(taken, named, "left").select(
        *[c for c in carried if c not in named], F.coalesce(F.col("taken"), F.lit(0)).cast("bigint").alias("taken")
    )


@own_names("doc_id", "text", "source")
def mixed_copies(docs: DataFrame, **settings) -> DataFrame:
    """``docs`` as the mix holds them: a row as often as it is taken, counting from half a document.

    A document without words costs the mix nothing and stays once.
    """
    size, taken = F.col("size"), F.col("taken")
    copies = F.when(size == 0, F.lit(1)).otherwise(F.floor((taken * 2 + size) / (size * 2)))
    laid, pieces = mix(docs, **settings)
    words = pieces.groupBy("skey", "place").agg(F.sum("words").alias("taken"))
    counted = (
        laid.select("skey", "place", "mix_key", "size").join(words, ["skey", "place"], "left")
        .withColumn("taken", F.coalesce("taken", F.lit(0)))
        .groupBy("mix_key").agg(F.sum(copies).cast("int").alias("copies")).where("copies > 0")
    )
    return (
        docs.withColumn("mix_key", identity(docs))
        .dropDuplicates(["mix_key"])
        .join(counted, "mix_key")
        .withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies"))))
        .select(*docs.columns)
    )
