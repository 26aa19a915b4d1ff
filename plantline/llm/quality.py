"""Quality classifier: an interpolated modified Kneser-Ney n-gram model of trusted text.

The grams are runs of four units. A unit is a code point as it stands, so that
letters of all scripts are told apart and the model grows with the corpus; or one
of 37 character classes (letters, and classes for capitals, digits, blanks and
kinds of punctuation).

Documents are packed into blocks, which are written once. A block says which
grams it holds and how often its trusted documents hold them. Counts,
continuation counts, context totals and discounts are tables sharded by gram, and
the probability of a gram comes from joins of these tables, one order after the
other. Each block asks once for each of its grams and sums up the answers by
document. Neither driver nor task ever holds the model, only the grams of a block.

A document is kept if its log-perplexity lies between two quantiles of the
trusted documents of its language. Scores are held in thousandths, so quantiles
are exact and need only a histogram. A language without trusted documents takes
the quantiles over all of them.

Defined results: a document that is null or empty has no perplexity and is
rejected; labels are joined by doc_id and count as trusted if every row of the
id says quality 1 and toxic 0 (nulls do not); equal rows are scored alike;
without any trusted text nothing can be judged and all documents with text are
kept; a null language is a language of its own; other columns pass through
unless they carry a name of the result; U+FFFF in a text counts as its edge.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plantline.llm.common import blocks_of, own_names, stored
from plantline.session import scratch_path

ORDER = 4
CAPITAL, LETTER, DIGIT, BLANK, LINE, STOP, COMMA, QUOTE, ASCII_SIGN, OTHER, EDGE = range(26, 37)
CLASSES = EDGE + 1
#: Share of trusted documents of a language that lie below the lower and above the upper bound.
LOWER, UPPER = 0.005, 0.01
#: Characters per step; bounds the memory that a long document takes.
STEP = 1 << 20
#: Characters in a block; a longer document is a block of its own.
BLOCK = 1 << 23
RESULT = ("perplexity", "low", "high", "kept")


def _classes() -> np.ndarray:
    """Class of each code point below 0x3000; beyond, letters and signs are not told apart."""
    table = np.full(0x3001, OTHER, dtype=np.uint8)
    for code in range(0x3000):
        kind = unicodedata.category(chr(code))
        if 97 <= code <= 122:
            table[code] = code - 97
        elif kind in ("Lu", "Lt"):
            table[code] = CAPITAL
        elif kind[0] in "LM":
            table[code] = LETTER
        elif kind[0] == "N":
            table[code] = DIGIT
        elif code in (10, 11, 12, 13, 0x85, 0x2028, 0x2029):
            table[code] = LINE
        elif kind[0] == "Z" or code == 9:
            table[code] = BLANK
        elif chr(code) in ".!?":
            table[code] = STOP
        elif chr(code) in ",;:":
            table[code] = COMMA
        elif kind in ("Pi", "Pf", "Pd") or chr(code) in "'\"":
            table[code] = QUOTE
        elif code < 128:
            table[code] = ASCII_SIGN
    table[0x3000] = LETTER
    return table


_TABLE = _classes()


class Units(NamedTuple):
    """What grams are made of: codes of a text, the code before its start, how many there are (unless the corpus says), code of 0 in a gram."""

    codes: Callable[[str], np.ndarray]
    edge: int
    count: int | None
    zero: int


def _points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.int64)


CLASS_UNITS = Units(lambda text: _TABLE[np.minimum(_points(text), 0x3000)].astype(np.int64), EDGE, CLASSES, ord("A"))
CODE_POINTS = Units(_points, 0xFFFF, None, 0)


def _parts(texts: list[str], units: Units) -> Iterator[tuple[int, np.ndarray]]:
    """(number of the text, codes with the ORDER - 1 before them), of bounded length."""
    for number, text in enumerate(texts):
        before = np.full(ORDER - 1, units.edge, dtype=np.int64)
        for at in range(0, len(text), STEP):
            held = np.concatenate([before, units.codes(text[at : at + STEP])])
            yield number, held
            before = held[held.size - ORDER + 1 :]


def grams(text: str) -> Iterator[np.ndarray]:
    """The gram of classes that ends at each character, as base-CLASSES numbers, in pieces of bounded length."""
    for _, held in _parts([text], CLASS_UNITS):
        size = held.size - ORDER + 1
        value = np.zeros(size, dtype=np.int64)
        for k in range(ORDER):
            value = value * CLASSES + held[k : k + size]
        yield value


def _distinct(parts: list[np.ndarray], zero: int) -> tuple[np.ndarray, list[str]]:
    """For each gram of the parts its number among the distinct ones, and these as strings."""
    codes = np.concatenate(parts)
    # Three codes of 21 bits are one number; two such runs, numbered, are a gram.
    runs = pc.dictionary_encode(pa.array((codes[:-2] << 42) | (codes[1:-1] << 21) | codes[2:]))
    rank, known = runs.indices.to_numpy().astype(np.int64), runs.dictionary.to_numpy()
    whole = np.ones(codes.size - ORDER + 1, dtype=bool)
    seams = np.cumsum([p.size for p in parts])[:-1]
    whole[(seams[:, None] - np.arange(1, ORDER)).ravel()] = False
    found = pc.dictionary_encode(pa.array((rank[: -(ORDER - 3)] * known.size + rank[ORDER - 3 :])[whole]))
    first, last = np.divmod(found.dictionary.to_numpy(), known.size)
    columns = [known[first] >> shift & 0x1FFFFF for shift in (42, 21, 0)]
    columns += [known[last] >> 21 * shift & 0x1FFFFF for shift in reversed(range(ORDER - 3))]
    spelled = (np.stack(columns, axis=1) + zero).astype("<u4").tobytes().decode("utf-32-le", "surrogatepass")
    return found.indices.to_numpy(), [spelled[at : at + ORDER] for at in range(0, len(spelled), ORDER)]


def numbered(texts: list[str], units: Units, index: dict[str, int]) -> Iterator[tuple[list[int], list[int], np.ndarray]]:
    """Steps of the texts: numbers of texts, how many grams each has in the step, and the grams' numbers in ``index``, which grows."""
    held: list[tuple[int, np.ndarray]] = []
    size = 0

    def step() -> tuple[list[int], list[int], np.ndarray]:
        ids, spelled = _distinct([codes for _, codes in held], units.zero)
        places = np.array([index.setdefault(gram, len(index)) for gram in spelled], dtype=np.int32)
        return [number for number, _ in held], [codes.size - ORDER + 1 for _, codes in held], places[ids]

    for part in _parts(texts, units):
        held.append(part)
        size += part[1].size
        if size >= STEP:
            yield step()
            held, size = [], 0
    if held:
        yield step()


def blocks(docs: DataFrame) -> DataFrame:
    """(block, doc_ids, rows): rows as compressed Arrow batches, some BLOCK characters in each, stored in buckets of blocks.

    Joins by block take the buckets as they are, so the texts are written once and not shuffled.
    """

    def packed(held: list[pa.RecordBatch], number: int) -> pa.RecordBatch:
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, held[0].schema, options=pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", 6))) as stream:
            for batch in held:
                stream.write_batch(batch)
        ids = pa.concat_arrays([batch.column("doc_id") for batch in held])
        return pa.RecordBatch.from_arrays(
            [pa.array([number], pa.int64()), pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids), pa.array([sink.getvalue().to_pybytes()], pa.binary())],
            ["block", "doc_ids", "rows"],
        )

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, size = TaskContext.get().partitionId() << 32, 0
        held: list[pa.RecordBatch] = []
        for batch in batches:
            start = 0
            for at, length in enumerate(pc.fill_null(pc.utf8_length(batch.column("text")), 0).to_pylist(), 1):
                size += length
                if size >= BLOCK:
                    yield packed([*held, batch.slice(start, at - start)], number)
                    number, size, held, start = number + 1, 0, [], at
            if start < batch.num_rows:
                held.append(batch.slice(start))
        if held:
            yield packed(held, number)

    spark = docs.sparkSession
    path = scratch_path(spark, "kn-blocks")
    name = path.rsplit("/", 1)[1].replace("-", "_")
    schema = f"block bigint, doc_ids array<{docs.schema['doc_id'].dataType.simpleString()}>, rows binary"
    docs.mapInArrow(pack, schema).write.bucketBy(blocks_of(spark), "block").option("path", path).saveAsTable(name)
    written = spark.table(name)
    spark.sql(f"DROP TABLE {name}")  # only the name: the files are outside the warehouse
    return written


def _unpacked(rows: pa.Scalar) -> pa.Table:
    return pa.ipc.open_stream(rows.as_buffer()).read_all()


def _texts(table: pa.Table) -> list[str]:
    return [text or "" for text in table["text"].to_pylist()]


def gram_counts(held: DataFrame, units: Units) -> DataFrame:
    """(block, pos, gram, n): the grams of each block by their number in it, and how often its trusted documents hold them."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, rows, trusted in zip(*(batch.column(c) for c in ("block", "rows", "trusted")), strict=True):
                index: dict[str, int] = {}
                good = set(trusted.as_py() or ())
                total = np.zeros(0, dtype=np.int64)
                for numbers, sizes, places in numbered(_texts(_unpacked(rows)), units, index):
                    counted = places[np.repeat([number in good for number in numbers], sizes)]
                    more = np.bincount(counted, minlength=len(index))
                    more[: total.size] += total
                    total = more
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(total.size, block.as_py(), dtype=np.int64)), pa.array(np.arange(total.size, dtype=np.int32)), pa.array(list(index), pa.string()), pa.array(total)],
                    ["block", "pos", "gram", "n"],
                )

    return held.select("block", "rows", "trusted").mapInArrow(count, "block bigint, pos int, gram string, n bigint")


def _discounts(counts: DataFrame) -> tuple[float, float, float]:
    """Modified Kneser-Ney discounts for counts of one, two, and three or more."""
    n = counts.where("n <= 4").agg(*[F.coalesce(F.sum(F.when(F.col("n") == k, 1)), F.lit(0)) for k in range(1, 5)]).first()
    if not n[0] or not n[1]:
        return 0.5, 0.5, 0.5
    y = n[0] / (n[0] + 2 * n[1])
    found = [k - (k + 1) * y * n[k] / n[k - 1] if n[k - 1] else y for k in (1, 2, 3)]
    return tuple(min(max(d, 0.01), k - 0.01) for k, d in zip((1, 2, 3), found, strict=True))


def kneser_ney(counted: DataFrame) -> list[tuple[DataFrame, DataFrame]]:
    """For each order from 1 on (gram, own) and (context, back), sharded by gram and context, from counts (gram, n).

    P(last unit | units before) is ``own`` of the gram plus ``back`` of its context times P of the gram without its first unit.
    """
    counts, tables = counted, []
    for order in range(ORDER, 0, -1):
        if order < ORDER:
            # A shorter gram counts in how many ways it is continued to the left.
            counts = stored(counts.groupBy(F.substring("gram", 2, order).alias("gram")).agg(F.count(F.lit(1)).alias("n")), "kn-counts")
        one, two, more = _discounts(counts)
        discount = F.when(F.col("n") == 1, one).when(F.col("n") == 2, two).otherwise(more)
        named = counts.withColumns({"context": F.substring("gram", 1, order - 1), "off": discount})
        totals = stored(named.groupBy("context").agg(F.sum("n").alias("total"), F.sum("off").alias("off")), "kn-contexts")
        own = named.drop("off").join(totals.drop("off"), "context").select("gram", ((F.col("n") - discount) / F.col("total")).alias("own"))
        tables.append((stored(own, "kn-grams"), totals.select("context", (F.col("off") / F.col("total")).alias("back"))))
    return tables[::-1]


def probabilities(asked: DataFrame, tables: list[tuple[DataFrame, DataFrame]], units: Units) -> DataFrame:
    """(gram, p) for the distinct grams ``asked`` for, seen in training or not: one join of sharded tables after the other."""
    wanted = [stored(asked.select("gram").distinct(), "kn-asked")]
    for order in range(ORDER - 1, 0, -1):
        wanted.append(wanted[-1].select(F.substring("gram", 2, order).alias("gram")).distinct())
    # Units of which trusted text has none share one place.
    found, p = None, F.lit(1.0 / (units.count or tables[0][0].count() + 1))
    for order, (grams_asked, (own, back)) in enumerate(zip(reversed(wanted), tables, strict=True), 1):
        named = grams_asked.withColumns({"context": F.substring("gram", 1, order - 1), "rest": F.substring("gram", 2, order)})
        joined = named.join(own, "gram", "left").join(back, "context", "left")
        if found is not None:
            joined, p = joined.join(found.withColumnsRenamed({"gram": "rest", "p": "below"}), "rest"), F.col("below")
        level = F.coalesce("own", F.lit(0.0)) + F.coalesce("back", F.lit(1.0)) * p
        found = stored(joined.select("gram", level.alias("p")), "kn-probabilities")
    return found


def trusted_ids(labels: DataFrame) -> DataFrame:
    good = F.coalesce((F.col("quality") == 1) & (F.col("toxic") == 0), F.lit(False))
    return labels.where("doc_id is not null").groupBy("doc_id").agg(F.min(good.cast("int")).alias("good")).where("good = 1").select("doc_id")


def _marked(packed: DataFrame, labels: DataFrame) -> DataFrame:
    """The blocks with the positions of their trusted documents."""
    ids = packed.select("block", F.posexplode("doc_ids").alias("pos", "doc_id"))
    # Labels grow with the documents: the join is sharded by doc_id at every size.
    good = ids.join(trusted_ids(labels).hint("merge"), "doc_id").groupBy("block").agg(F.collect_list("pos").alias("trusted"))
    return packed.join(stored(good, "kn-trusted"), "block", "left")


def _counted(asked: DataFrame) -> DataFrame:
    return stored(asked.where("n > 0").groupBy("gram").agg(F.sum("n").alias("n")), "kn-counts")


def train(docs: DataFrame, labels: DataFrame) -> np.ndarray:
    """Natural logarithms of P(last class | classes before) for all grams of classes, by number: the model written out, to look at."""
    counted = _counted(gram_counts(_marked(blocks(docs), labels), CLASS_UNITS))
    digits = [F.char(F.floor(F.col("id") / CLASSES**k) % CLASSES + CLASS_UNITS.zero) for k in range(ORDER - 1, -1, -1)]
    every = docs.sparkSession.range(CLASSES**ORDER).select("id", F.concat(*digits).alias("gram"))
    found = every.join(probabilities(every, kneser_ney(counted), CLASS_UNITS), "gram").select("id", "p").toPandas()
    logs = np.empty(CLASSES**ORDER, dtype=np.float32)
    logs[found["id"].to_numpy()] = np.log(found["p"].to_numpy())
    return logs


def score(held: DataFrame, units: Units) -> DataFrame:
    """Per block, from the probabilities of its grams, its documents with ``milli``: thousandths of the mean negative
    log-probability of a character; null without text."""

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, rows, trusted, found in zip(*(batch.column(c) for c in ("block", "rows", "trusted", "found")), strict=True):
                table = _unpacked(rows)
                texts = _texts(table)
                logs = np.zeros(0, dtype=np.float32)
                if found.is_valid:
                    logs = np.empty(len(found.values), dtype=np.float32)
                    logs[found.values.field("pos").to_numpy()] = np.log(found.values.field("p").to_numpy())
                total = [0.0] * len(texts)
                for numbers, sizes, places in numbered(texts, units, {}):
                    own = logs[places]
                    for number, size, end in zip(numbers, sizes, np.cumsum(sizes), strict=True):
                        total[number] += float(own[end - size : end].sum(dtype=np.float64))
                good = np.zeros(len(texts), dtype=bool)
                good[trusted.as_py() or []] = True
                milli = [round(-1000 * t / len(text)) if text else None for t, text in zip(total, texts, strict=True)]
                docs = pa.StructArray.from_arrays(
                    [table["lkey"].combine_chunks(), pa.array(good), pa.array(milli, pa.int64())], ["lkey", "trusted", "milli"]
                )
                yield pa.RecordBatch.from_arrays(
                    [pa.array([block.as_py()], pa.int64()), pa.ListArray.from_arrays(pa.array([0, len(docs)], pa.int32()), docs)], ["block", "docs"]
                )

    return held.select("block", "rows", "trusted", "found").mapInArrow(
        scored, "block bigint, docs array<struct<lkey:string,trusted:boolean,milli:bigint>>"
    )


def _rows(packed: DataFrame, scores: DataFrame, schema: T.StructType) -> DataFrame:
    """The rows of the blocks, each with its ``milli``."""

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, docs in zip(batch.column("rows"), batch.column("docs"), strict=True):
                table = _unpacked(rows)
                yield from table.append_column("milli", docs.values.field("milli")).combine_chunks().to_batches(max_chunksize=1000)

    return packed.join(scores, "block").select("rows", "docs").mapInArrow(unpack, T.StructType([*schema.fields, T.StructField("milli", T.LongType())]))


def bounds(scored: DataFrame, lower: float = LOWER, upper: float = UPPER) -> DataFrame:
    """(lkey, low, high) by language, and one row of null lkey over all, from the scores of trusted documents."""
    bins = scored.where("milli is not null").groupBy("lkey", "milli").agg(F.count(F.lit(1)).alias("n"))
    both = stored(bins.unionByName(bins.groupBy("milli").agg(F.sum("n").alias("n")).withColumn("lkey", F.lit(None).cast("string"))), "kn-bins")
    totals = both.groupBy("lkey").agg(F.sum("n").alias("total"))
    # Distinct scores of a language are at most the thousandths of a logarithm of CLASSES ** ORDER.
    ordered = Window.partitionBy("lkey").orderBy("milli")
    ranked = both.withColumn("upto", F.sum("n").over(ordered)).join(totals.withColumnRenamed("lkey", "lk"), F.col("lkey").eqNullSafe(F.col("lk")))
    return ranked.groupBy("lkey").agg(
        F.min(F.when(F.col("upto") > F.col("total") * lower, F.col("milli"))).alias("low"),
        F.min(F.when(F.col("upto") >= F.col("total") * (1 - upper), F.col("milli"))).alias("high"),
    )


@own_names("doc_id", "text", "lang", result=RESULT)
def classify(docs: DataFrame, labels: DataFrame, lower: float = LOWER, upper: float = UPPER, units: Units = CLASS_UNITS) -> DataFrame:
    """``docs`` with perplexity (per character), the bounds of its language and ``kept``."""
    docs = docs.drop(*[c for c in RESULT if c in docs.columns])
    inner = docs.withColumn("lkey", F.coalesce(F.concat(F.lit("l"), F.col("lang")), F.lit("n")))
    packed = blocks(inner)
    marked = _marked(packed, labels)
    asked = stored(gram_counts(marked, units), "kn-blocks-grams")
    counted = _counted(asked)
    if counted.isEmpty():
        nothing = F.lit(None).cast("double")
        has_text = F.coalesce(F.col("text") != "", F.lit(False))
        return docs.withColumns({"perplexity": nothing, "low": nothing, "high": nothing, "kept": has_text})
    known = probabilities(asked, kneser_ney(counted), units)
    # A block asks once for each of its grams, so a gram that is everywhere has as many rows as there are blocks.
    answers = asked.drop("n").join(known, "gram").groupBy("block").agg(F.collect_list(F.struct("pos", "p")).alias("found"))
    scores = stored(score(marked.join(answers, "block", "left"), units), "kn-scores")
    limits = stored(bounds(scores.select(F.inline("docs")).where("trusted").drop("trusted"), lower, upper), "kn-bounds")
    every = limits.where("lkey is null").first()
    own = limits.where("lkey is not null")
    scored = _rows(packed, scores, inner.schema).join(own, "lkey", "left")
    low, high = F.coalesce("low", F.lit(every.low)), F.coalesce("high", F.lit(every.high))
    power = lambda c: F.exp(c / 1000.0)
    return scored.withColumn("kept", F.coalesce((F.col("milli") >= low) & (F.col("milli") <= high), F.lit(False))).select(
        *docs.columns, power(F.col("milli")).alias("perplexity"), power(low).alias("low"), power(high).alias("high"), "kept"
    )
