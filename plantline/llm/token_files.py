"""Token ids as Parquet list columns.

Documents are dealt by ranges of doc_id and sorted, tokenized, and written with
their metadata: ids as dictionary-encoded lists in row groups and pages of a set
size, with page indexes, so that a reader can take a range of documents, or the
counts without the ids. Reading back gives each document's first position in the
stream of all ids and the checksum of its ids as stored.

Words that the tokenizer is known to treat one by one (Latin letters without
combining marks, digits, punctuation) go to its model directly and are kept in a
bounded store per worker; any other text goes through the whole tokenizer. Both
ways give the same ids.

Defined results: a null text is tokenized as an empty one and has the end id only;
rows of equal doc_id keep separate entries, in any order; a null doc_id comes
first; an empty table gives no rows and no files to read; other columns are not
written.
"""

from __future__ import annotations

import re
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plantline.llm.common import blocks_of, stored
from plantline.operators.ordered import running_totals
from plantline.session import scratch_path

END_ID = 2
#: Bytes of a row group and of a page.
ROW_GROUP, PAGE = 32 << 20, 256 << 10
#: Characters that are tokenized at once, and words that a worker keeps.
STEP, KEPT_WORDS = 1 << 20, 400_000

# Anything that the words' way below does not cover: beyond Latin letters, blanks other than the plain ones, and U+0130,
# which becomes two characters in lower case.
_OTHER = re.compile(r"[^\t\n\x0b\x0c\r\x20-\x7e\xa1-\u012f\u0131-\u024f]")
# The tokenizer's own pattern of words, applied to lower-case text. Fixed values.
_PARTS = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")


def _letters() -> dict[int, str]:
    """How byte-level models write each byte: printable ones as they are, others from U+0100 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + k) for k, b in enumerate(hidden)}


class Encoder:
    """Ids of texts by one tokenizer file."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        self.model = self.whole.model
        self.letters = _letters()
        self.parts: dict[str, bytes] = {}
        self.runs: dict[str, bytes] = {}

    def _part(self, part: str) -> bytes:
        """Ids of one word of the tokenizer's pattern."""
        written = part if part.isascii() and part.isalpha() else "".join(map(self.letters.__getitem__, part.encode()))
        ids = array("i", [t.id for t in self.model.tokenize(written)]).tobytes()
        if len(self.parts) < KEPT_WORDS:
            self.parts[part] = ids
        return ids

    def _run(self, run: str) -> bytes:
        """Ids of a run without blanks."""
        ids = b"".join([self.parts.get(p) or self._part(p) for p in _PARTS.findall(run)])
        if len(self.runs) < KEPT_WORDS:
            self.runs[run] = ids
        return ids

    def ids(self, text: str) -> np.ndarray:
        if "<|" in text or _OTHER.search(text):
            return np.array(self.whole.encode(text, add_special_tokens=False).ids, dtype=np.int32)
        known, run = self.runs, self._run
        return np.frombuffer(b"".join([known.get(r) or run(r) for r in text.lower().split()]), dtype=np.int32)


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def _tokenizing(path: str, end_id: int):
    def tokenize(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, last = encoder(path), np.array([end_id], dtype=np.int32)
        for batch in batches:
            names, values, lengths, held = [], [], [], 0

            def part() -> pa.RecordBatch:
                offsets = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
                ids = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(values), pa.int32()))
                columns = [pa.array(names, pa.int64()), pa.array(lengths, pa.int64()), ids]  # noqa: B023
                return pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_tokens", "ids"])

            for doc_id, text in zip(batch.column("doc_id"), batch.column("text"), strict=True):
                ids = encode.ids(text.as_py() or "")
                names.append(doc_id.as_py())
                values += ids, last
                lengths.append(ids.size + 1)
                held += ids.size + 1
                if held >= STEP:
                    yield part()
                    names, values, lengths, held = [], [], [], 0
            if names:
                yield part()

    return tokenize


def write_tokens(docs: DataFrame, folder: str, tokenizer: str, end_id: int = END_ID, files: int | None = None) -> None:
    """Write (doc_id, n_tokens, ids) below ``folder``, file by file in ascending order of doc_id."""
    spark = docs.sparkSession
    (
        docs.select("doc_id", "text")
        .repartitionByRange(files or blocks_of(spark), "doc_id")
        .sortWithinPartitions("doc_id")
        .mapInArrow(_tokenizing(tokenizer, end_id), "doc_id bigint, n_tokens bigint, ids array<int>")
        .write.option("parquet.block.size", ROW_GROUP)
        .option("parquet.page.size", PAGE)
        .option("parquet.enable.dictionary", "true")
        .option("parquet.page.write-checksum.enabled", "true")
        .option("compression", "zstd")
        .parquet(folder)
    )


def read_tokens(spark: SparkSession, folder: str, low: int | None = None, high: int | None = None) -> DataFrame:
    """The written documents, or those of a range of doc_id; other row groups and pages are skipped."""
    tokens = spark.read.parquet(folder)
    if low is not None:
        tokens = tokens.where(F.col("doc_id") >= low)
    return tokens if high is None else tokens.where(F.col("doc_id") <= high)


def _checksums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids = batch.column("ids")
        offsets = ids.offsets.to_numpy()
        values = ids.values.to_numpy(zero_copy_only=False).astype("<u4")
        raw = memoryview(values).cast("B")
        crcs = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
        counts = pa.array(np.diff(offsets).astype(np.int64))
        columns = [*(batch.column(c) for c in ("file", "row", "doc_id")), counts, pa.array(crcs, pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, names=["file", "row", "doc_id", "n_tokens", "ids_crc32"])


def token_positions(spark: SparkSession, folder: str) -> DataFrame:
    """Per written document its place in the stream of all ids and the checksum of its ids."""
    read = read_tokens(spark, folder).select(
        F.col("_metadata.file_name").alias("file"), F.col("_metadata.row_index").alias("row"), "doc_id", "ids"
    )
    kept = stored(
        read.mapInArrow(_checksums, "file string, row bigint, doc_id bigint, n_tokens bigint, ids_crc32 bigint"), "token-sums"
    )
    ends = running_totals(kept, [], F.col("file"), [F.col("row")], {"stop": F.col("n_tokens")})
    return ends.select("doc_id", (F.col("stop") - F.col("n_tokens")).cast("bigint").alias("start"), "n_tokens", "ids_crc32")


def tokenized(docs: DataFrame, tokenizer: str, end_id: int = END_ID) -> DataFrame:
    """Write the token files of ``docs`` below the shared folder, and what reading them back gives."""
    spark = docs.sparkSession
    folder = scratch_path(spark, "tokens")
    write_tokens(docs, folder, tokenizer, end_id)
    return token_positions(spark, folder)
