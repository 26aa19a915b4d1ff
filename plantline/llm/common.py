"""Shared pieces: stored intermediate tables, word columns, row identities."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plantline.session import scratch_path

WORD = r"[^\x20\x09-\x0D]+"
GAP = r"[\x20\x09-\x0D]+"


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once below the shared folder and read back.

    A written table survives lost executors, and Spark knows its size, so that
    it broadcasts the small ones and shuffles the others.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def blocks_of(spark: SparkSession) -> int:
    """Blocks into which a group is cut for numbering: as many as the session has shuffle partitions."""
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def row_key(doc_id: str = "doc_id", text: str = "text") -> Column:
    """16 bytes that only rows of the same id and the same text share; never null."""
    parts = [F.coalesce(F.concat(F.lit("v"), F.col(c).cast("string")), F.lit("n")) for c in (doc_id, text)]
    return F.unhex(F.md5(F.concat_ws("\x01", *parts).cast("binary")))


def own_names(*used: str, result: tuple[str, ...] = ()):
    """For operators on rows: columns other than ``used`` stand under reserved names inside, so that none can clash.

    Columns that carry a name of the ``result`` are dropped before.
    """

    def around(operator):
        @wraps(operator)
        def run(docs: DataFrame, *args, **settings) -> DataFrame:
            held = [c for c in docs.columns if c not in result or c in used]
            names = {f"_own_{k}": c for k, c in enumerate(held) if c not in used}
            inner = {c: k for k, c in names.items()}
            found = operator(docs.select(*[F.col(f"`{c}`").alias(inner.get(c, c)) for c in held]), *args, **settings)
            return found.select(*[F.col(c).alias(names.get(c, c)) for c in found.columns])

        return run

    return around


def scatter(*columns: str) -> Column:
    """Non-negative long that spreads rows evenly."""
    return F.xxhash64(*columns).bitwiseAND(F.lit((1 << 62) - 1))


def words(text: Column) -> Column:
    """Lower-case runs of letters and digits."""
    return F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def bound(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which is computed once however often ``body`` names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def shingle_hashes(tokens: Column, size: int) -> Column:
    """One long per run of ``size`` words, in order; the whole sequence if it is shorter, nothing if it is empty."""

    def runs(hashed: Column) -> Column:
        n = F.size(hashed)
        several = F.transform(
            F.sequence(F.lit(0), n - size), lambda i: F.xxhash64(*[F.get(hashed, i + k) for k in range(size)])
        )
        return F.when(n >= size, several).when(n > 0, F.array(F.xxhash64(hashed))).otherwise(F.array().cast("array<bigint>"))

    return bound(F.transform(tokens, lambda w: F.xxhash64(w)), runs)


def pieces(tokens: Column, size: int, overlap: int) -> Column:
    """The words in pieces of ``size`` that share ``overlap`` words with the next piece.

    Every run of up to ``overlap + 1`` words lies whole in one piece; without words there is none.
    """

    def cut(held: Column) -> Column:
        n = F.size(held)
        starts = F.sequence(F.lit(0), F.greatest(n - overlap - 1, F.lit(0)), F.lit(size))
        return F.when(n > 0, F.transform(starts, lambda at: F.slice(held, at + 1, size + overlap)))

    return bound(tokens, cut)
