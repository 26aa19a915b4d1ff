"""Benchmark decontamination by MinHash containment search, in DataFrame operations only.

Test items are short and documents long, so the similarity of their whole sets
is far below what any signature resolves. Containment is therefore estimated
from the item's side: its MinHash signature is the ``k`` shingles with the least
hash values, each of which lies in a document with the probability of the
item's containment there. Items are partitioned by size, and each partition has
its own ``k`` and its own number of signature shingles that a document must
hold, chosen so that an item contained to ``percent`` is not missed. Documents
that hold so many are verified: the item's exact shingles against the document's.

A document's shingles are cut in pieces of bounded length, whole texts are read,
and only those that stand in a signature are kept.

Defined results: words are lower-case runs of letters and digits; an item with
fewer words than a shingle is one shingle of all its words, looked up among the
documents' runs of as many words; null or wordless items and
documents take no part; items of equal shingle sets are each reported; equal
rows are reported once; rows without an id are found like others; an empty
table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plantline.llm.common import own_names, pieces, row_key, shingle_hashes, stored, words

#: Words of a document in one piece.
PIECE = 4096
#: Items of up to 2^WHOLE shingles are looked up by all of them; of larger ones, in the partition of sizes
#: up to 2^p, a signature of PER_POWER * p is taken.
WHOLE, PER_POWER = 5, 8


def _signature(size: Column, percent: int) -> tuple[Column, Column]:
    """Signature length, and the least number of its shingles in a document, by the partition of ``size``.

    Of a signature of k at containment c, fewer than k * c less five standard deviations are found with a
    probability below 1e-6.
    """
    power = F.ceil(F.log2(F.greatest(size, F.lit(1)).cast("double")))
    length, share = power * PER_POWER, percent / 100.0
    part = F.floor(length * share - F.sqrt(length * share * (1 - share)) * 5)
    small = power <= WHOLE
    return (
        F.when(small, size).otherwise(length).cast("int"),
        F.when(small, F.ceil(size * share)).otherwise(F.greatest(part, F.lit(1))).cast("int"),
    )


def _runs(tokens: Column, size: Column) -> Column:
    """The shingles themselves, as text."""
    starts = F.sequence(F.lit(1), F.greatest(F.size(tokens) - size + 1, F.lit(1)))
    return F.transform(starts, lambda i: F.array_join(F.slice(tokens, i, size), " "))


def item_signatures(items: DataFrame, shingle: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """Per distinct shingle set its signature rows (hash, set_id, needed), and its items (set_id, item_id, tokens, size, shingles).

    ``size`` is the item's shingle length: ``shingle``, or all its words if they are fewer.
    """
    named = items.select("item_id", words(F.col("text")).alias("tokens")).withColumn("size", F.least(F.size("tokens"), F.lit(shingle)))
    own = F.coalesce(*[F.when(F.col("size") == n, shingle_hashes(F.col("tokens"), n)) for n in range(1, shingle + 1)])
    hashed = named.withColumn("shingles", F.array_sort(F.array_distinct(own)))
    sets = stored(
        hashed.where(F.size("shingles") > 0).distinct().withColumn("set_id", F.unhex(F.md5(F.to_json("shingles").cast("binary")))), "leak-items"
    )
    length, needed = _signature(F.size("shingles"), percent)
    # The shingles are hashes: of a sorted array the first ones are the least under that hash.
    signature = sets.select("set_id", "shingles").dropDuplicates(["set_id"]).select(
        "set_id", needed.alias("needed"), F.explode(F.slice("shingles", F.lit(1), length)).alias("hash")
    )
    return stored(signature, "leak-signatures"), sets


def leaks(docs: DataFrame, items: DataFrame, shingle: int = 5, percent: int = 80) -> DataFrame:
    """(row_key, doc_id, item_id, containment) for each item of which a document holds ``percent`` of the shingles."""
    signatures, sets = item_signatures(items, shingle, percent)
    cut = docs.select(row_key().alias("row_key"), F.explode(pieces(words(F.col("text")), PIECE, shingle - 1)).alias("tokens"))
    sizes = sorted(r["size"] for r in sets.select("size").distinct().collect()) or [shingle]  # at most ``shingle`` of them
    runs = F.concat(*[shingle_hashes(F.col("tokens"), n) for n in sizes])
    seen = cut.select("row_key", F.explode(F.array_distinct(runs)).alias("hash"))
    hits = seen.join(signatures, "hash").groupBy("row_key", "set_id", "needed").agg(F.count_distinct("hash").alias("hits"))
    candidates = stored(hits.where("hits >= needed").select("row_key", "set_id"), "leak-candidates")
    wanted = candidates.select("row_key").distinct()
    # Only candidates' words are kept; their exact shingles decide.
    held = stored(
        docs.select("doc_id", row_key().alias("row_key"), "text")
        .join(wanted, "row_key", "left_semi")
        .dropDuplicates(["row_key"])
        .select("doc_id", "row_key", F.explode(pieces(words(F.col("text")), PIECE, shingle - 1)).alias("tokens")),
        "leak-texts",
    )
    wanted_runs = sets.select("set_id", F.col("size").alias("length"), F.array_distinct(_runs(F.col("tokens"), F.col("size"))).alias("runs")).dropDuplicates(["set_id"])
    found = (
        candidates.join(wanted_runs, "set_id")
        .join(held, "row_key")
        .select(
            "row_key", "doc_id", "set_id", F.size("runs").alias("n"),
            F.explode(F.array_intersect("runs", F.array_distinct(_runs(F.col("tokens"), F.col("length"))))).alias("run"),
        )
        .groupBy("row_key", "doc_id", "set_id", "n")
        .agg(F.count_distinct("run").alias("held"))
        .where(F.col("held") * 100 >= F.col("n") * percent)
    )
    named = sets.select("set_id", "item_id").distinct()
    return found.join(named, "set_id").select("row_key", "doc_id", "item_id", (F.col("held") / F.col("n")).alias("containment"))


@own_names("doc_id", "text")
def without_leaks(docs: DataFrame, items: DataFrame, **settings) -> DataFrame:
    """``docs`` without the documents that hold a test item."""
    bad = stored(leaks(docs, items, **settings).select("row_key").distinct(), "leak-rows")
    return docs.withColumn("row_key", row_key()).join(bad, "row_key", "left_anti").select(*docs.columns)
