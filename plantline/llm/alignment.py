"""Alignment of the tokens of two tokenizers by the byte offsets at which both end one.

Texts are encoded in blocks of bounded size. Within a block everything is done on
Arrow arrays: lists of ids are flattened with the index of their document, byte
lengths are summed up per document, and an Acero hash join on (document, end)
finds the ends that both tokenizers share. The id pairs that end there are
counted per block with ``Table.group_by``; Spark merges these partial counts by
pair and hands each block the corpus-wide counts of the pairs that it holds.

Pairs are rows of their own, and the links of a block's documents are one packed
value, so that no task, reader or writer holds more than a block as objects,
however many blocks a file or a partition has.

Defined results: a text that is null or empty, or whose tokens of either kind
don't spell the text with a leading space byte by byte, has no tokens, counts of
zero and an empty ``groups_sha256``; rows of equal doc_id, or without one, keep
rows of their own; an empty table gives no rows; columns other than doc_id and
text are not read, so their names cannot clash.
"""

from __future__ import annotations

import hashlib
import json
import os
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plantline.llm.common import stored

#: Characters of text in one block; a longer text is a block of its own.
BLOCK = 1 << 20
#: Characters that are handed to a tokenizer at once.
STEP = 1 << 17
#: Bits of a place that hold the byte within the document.
PLACE_BITS = 40

#: A pair of a block (pos, a, b, n); or, without pos, the block's documents and their links (doc, pair, n), packed.
BLOCKS = "block bigint, pos int, a int, b int, n bigint, docs binary, links binary"
RESULT = "doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_best bigint, count_sum bigint, groups_sha256 string"

Encode = Callable[[list[str]], list[list[int]]]


def _letters() -> dict[str, int]:
    """The byte behind each letter of a byte-level vocabulary: printable bytes are themselves, others follow from U+0100 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}


def byte_level(path: str) -> tuple[Encode, pa.Array]:
    """Ids of texts with a leading space, and the bytes of each id."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # one task is one core
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(path)
    whole.encode_special_tokens = True
    letters = _letters()
    added = {t["id"] for t in json.loads(whole.to_str())["added_tokens"]}
    vocabulary = {i: token for token, i in whole.get_vocab(with_added_tokens=True).items()}
    spelled = [
        None if i not in vocabulary else vocabulary[i].encode() if i in added else bytes(letters[c] for c in vocabulary[i])
        for i in range(max(vocabulary) + 1)
    ]
    encode = getattr(whole, "encode_batch_fast", whole.encode_batch)

    def ids(texts: list[str]) -> list[list[int]]:
        return [e.ids for e in encode([" " + t for t in texts], add_special_tokens=False)]

    return ids, pa.array(spelled, pa.binary())


def pieces(path: str) -> tuple[Encode, pa.Array]:
    """Ids of texts by a sentence-piece model, which puts a space before them, and the bytes of each id."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)

    def spelled(i: int) -> bytes:
        piece = model.id_to_piece(i)
        return bytes([int(piece[3:-1], 16)]) if model.is_byte(i) else piece.replace("▁", " ").encode()

    table = pa.array([spelled(i) for i in range(model.get_piece_size())], pa.binary())
    return lambda texts: model.encode(texts, num_threads=1), table


def _flat(lists: list[list[int]]) -> pa.ListArray:
    offsets = np.concatenate([[0], np.cumsum([len(x) for x in lists])]).astype(np.int32)
    held = np.concatenate([np.array(x, dtype=np.int32) for x in lists]) if lists else np.empty(0, np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(held, pa.int32()))


def _ends(ids: pa.ListArray, spelled: pa.Array) -> pa.Table:
    """Per token its place (document and the byte at which it ends there, as one number), its id and its number among all tokens."""
    flat = ids.flatten()
    parents = pc.list_parent_indices(ids).cast(pa.int64())
    lengths = pc.take(pc.binary_length(spelled), flat).cast(pa.int64())
    # Segmented sum: the running sum over all tokens, less what it was before the document's first one.
    total = np.concatenate([[0], pc.cumulative_sum(lengths).to_numpy()])
    before = total[ids.offsets.to_numpy()[:-1]]
    doc = parents.to_numpy()
    place = (doc << PLACE_BITS) | (total[1:] - before[doc])
    return pa.table({"place": pa.array(place), "id": flat, "at": pa.array(np.arange(len(flat), dtype=np.int64))})


def _spells(ids: pa.ListArray, spelled: pa.Array, whole: pa.Array) -> np.ndarray:
    """Whether a document's tokens, joined, are the bytes of ``whole``."""
    tokens = pa.ListArray.from_arrays(ids.offsets, pc.take(spelled, ids.flatten()))
    return pc.fill_null(pc.equal(pc.binary_join(tokens, b""), whole), False).to_numpy(zero_copy_only=False)


def _joined(flat: pa.Array, starts: np.ndarray, separator: str) -> pa.Array:
    """Strings joined between consecutive ``starts``."""
    return pc.binary_join(pa.ListArray.from_arrays(pa.array(starts.astype(np.int32)), flat), separator)


def align(a: pa.ListArray, b: pa.ListArray, spelled_a: pa.Array, spelled_b: pa.Array) -> tuple[pa.Table, list[int], list[str]]:
    """The links (doc, a, b) of documents given as lists of ids, the number of groups and the groups of each, written out."""
    left, right = _ends(a, spelled_a), _ends(b, spelled_b)
    # One number as the key: joins and groups by two columns take about twice as long.
    both = left.rename_columns(["place", "a", "a_at"]).join(
        right.rename_columns(["place", "b", "b_at"]), ["place"], join_type="inner", use_threads=False
    )
    places = both["place"].to_numpy()
    order = np.argsort(places, kind="stable")
    places = places[order]
    # The rows of a place stand together; its last tokens end the group.
    firsts = np.flatnonzero(np.diff(places, prepend=-1))
    docs = places[firsts] >> PLACE_BITS
    sides = []
    for ids, at in ((a, "a_at"), (b, "b_at")):
        lasts = np.maximum.reduceat(both[at].to_numpy()[order], firsts) if firsts.size else firsts
        starts = np.concatenate([[0], lasts + 1])
        sides.append(_joined(ids.flatten().cast(pa.string()), starts, ","))
    groups = pc.binary_join_element_wise(*sides, "|")
    counts = np.bincount(docs, minlength=len(a))
    texts = _joined(groups, np.concatenate([[0], np.cumsum(counts)]), ";")
    linked = pa.array(both["place"].to_numpy() >> PLACE_BITS)
    return pa.table({"doc": linked, "a": both["a"], "b": both["b"]}), counts.tolist(), texts.to_pylist()


_LOADED: dict[tuple[str, str], tuple] = {}


def _loaded(path_a: str, path_b: str) -> tuple:
    if (path_a, path_b) not in _LOADED:
        _LOADED[path_a, path_b] = (*byte_level(path_a), *pieces(path_b))
    return _LOADED[path_a, path_b]


def _batched(texts: list[str]) -> Iterator[list[str]]:
    held: list[str] = []
    size = 0
    for text in texts:
        held.append(text)
        size += len(text)
        if size >= STEP:
            yield held
            held, size = [], 0
    if held:
        yield held


def _packed(table: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as stream:
        stream.write_table(table)
    return sink.getvalue().to_pybytes()


def _unpacked(value: pa.Scalar) -> pa.Table:
    return pa.ipc.open_stream(value.as_buffer()).read_all()


def _block(number: int, doc_ids: list[int | None], texts: list[str], loaded: tuple) -> pa.RecordBatch:
    encode_a, spelled_a, encode_b, spelled_b = loaded
    n = len(texts)
    lists_a = pa.chunked_array([_flat(encode_a(part)) for part in _batched(texts)]).combine_chunks()
    lists_b = pa.chunked_array([_flat(encode_b(part)) for part in _batched(texts)]).combine_chunks()
    whole = pa.array([b" " + t.encode("utf-8", "surrogatepass") for t in texts], pa.binary())
    fits = _spells(lists_a, spelled_a, whole) & _spells(lists_b, spelled_b, whole) & np.array([t != "" for t in texts])
    kept = np.flatnonzero(fits)
    a, b = lists_a.take(pa.array(kept)), lists_b.take(pa.array(kept))

    out = {c: np.zeros(n, dtype=np.int64) for c in ("n_a", "n_b", "n_groups", "n_links")}
    digests = [""] * n
    pairs = pa.table({"a": pa.array([], pa.int32()), "b": pa.array([], pa.int32()), "n": pa.array([], pa.int64())})
    links = pa.table({"doc": pa.array([], pa.int32()), "pair": pa.array([], pa.int32()), "n": pa.array([], pa.int64())})
    if kept.size:
        found, groups, written = align(a, b, spelled_a, spelled_b)
        out["n_a"][kept], out["n_b"][kept] = np.diff(a.offsets.to_numpy()), np.diff(b.offsets.to_numpy())
        out["n_groups"][kept] = groups
        out["n_links"][kept] = np.bincount(found["doc"].to_numpy(), minlength=kept.size)
        for at, text in zip(kept.tolist(), written, strict=True):
            digests[at] = hashlib.sha256(text.encode()).hexdigest()
        # Ids are not negative and below 2^31, so a pair is one number.
        both = (found["a"].to_numpy().astype(np.int64) << 32) | found["b"].to_numpy()
        coded = pc.dictionary_encode(pa.array(both))
        per_doc = pa.table({"link": (found["doc"].to_numpy() << 32) | coded.indices.to_numpy()})
        per_doc = per_doc.group_by(["link"], use_threads=False).aggregate([([], "count_all")])
        link, times = per_doc["link"].to_numpy(), per_doc["count_all"].to_numpy()
        pair, named = (link & 0xFFFFFFFF).astype(np.int32), coded.dictionary.to_numpy()
        total = np.bincount(pair, weights=times, minlength=named.size).astype(np.int64)
        pairs = pa.table({"a": (named >> 32).astype(np.int32), "b": (named & 0xFFFFFFFF).astype(np.int32), "n": total})
        links = pa.table({"doc": kept[link >> 32].astype(np.int32), "pair": pair, "n": times})

    docs = pa.table({"doc_id": pa.array(doc_ids, pa.int64()), **out, "groups_sha256": pa.array(digests)})
    rows = pairs.num_rows
    columns = [pa.array([number] * (rows + 1), pa.int64()), pa.array([*range(rows), None], pa.int32())]
    columns += [pa.concat_arrays([*pairs[c].chunks, pa.nulls(1, pairs[c].type)]) for c in ("a", "b", "n")]
    columns += [pa.concat_arrays([pa.nulls(rows, pa.binary()), pa.array([_packed(table)], pa.binary())]) for table in (docs, links)]
    return pa.RecordBatch.from_arrays(columns, ["block", "pos", "a", "b", "n", "docs", "links"])


def _aligner(path_a: str, path_b: str, block: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        loaded, number = _loaded(path_a, path_b), TaskContext.get().partitionId() << 32
        doc_ids: list[int | None] = []
        texts: list[str] = []
        size = 0
        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True):
                doc_ids.append(doc_id)
                texts.append(text.as_py() or "")
                size += len(texts[-1])
                if size >= block:
                    yield _block(number, doc_ids, texts, loaded)
                    number, doc_ids, texts, size = number + 1, [], [], 0
        if texts:
            yield _block(number, doc_ids, texts, loaded)

    return run


def _sums(rows: pa.Table) -> pa.Table:
    """Rows of a block's documents, from their links and the corpus-wide counts of the block's pairs."""
    whole = rows.select(["docs", "links"]).filter(pc.is_valid(rows["docs"]))
    docs, links = (_unpacked(whole[c][0]) for c in ("docs", "links"))
    found = rows.select(["pos", "count", "best"]).filter(pc.is_valid(rows["pos"]))
    order = np.argsort(found["pos"].to_numpy())
    counts, best = (found[c].to_numpy()[order] for c in ("count", "best"))
    doc, pair, times = (links[c].to_numpy() for c in ("doc", "pair", "n"))
    count_sum, n_best = np.zeros(docs.num_rows, dtype=np.int64), np.zeros(docs.num_rows, dtype=np.int64)
    np.add.at(count_sum, doc, times * counts[pair])
    np.add.at(n_best, doc, times * best[pair])
    held = docs.select(["doc_id", "n_a", "n_b", "n_groups", "n_links"])
    return held.append_column("n_best", pa.array(n_best)).append_column("count_sum", pa.array(count_sum)).append_column("groups_sha256", docs["groups_sha256"])


def aligned_blocks(docs: DataFrame, byte_level_file: str, piece_file: str, block: int = BLOCK) -> DataFrame:
    """Blocks of documents with their groups, their id pairs, one to a row, and the links of each document; written once."""
    return stored(docs.select("doc_id", "text").mapInArrow(_aligner(byte_level_file, piece_file, block), BLOCKS), "align-blocks")


def pair_counts(blocks: DataFrame) -> DataFrame:
    """(a, b, count, best): the links of each id pair over the corpus; ``best`` if no other A id is linked more often with b."""
    counts = stored(
        blocks.where("pos is not null").groupBy("a", "b").agg(F.sum("n").alias("count")), "align-counts"
    )
    most = counts.groupBy("b").agg(F.max("count").alias("most"))
    return counts.join(most, "b").select("a", "b", "count", (F.col("count") == F.col("most")).alias("best"))


def align_tokenizers(docs: DataFrame, byte_level_file: str, piece_file: str, block: int = BLOCK) -> DataFrame:
    """Per document the numbers of tokens, groups and links, its links' corpus-wide counts and the digest of its groups."""
    blocks = aligned_blocks(docs, byte_level_file, piece_file, block)
    counts = stored(pair_counts(blocks), "align-pairs")
    # A block asks once for each of its pairs, so a pair that is everywhere has as many rows as there are blocks.
    found = blocks.where("pos is not null").select("block", "pos", "a", "b").join(counts, ["a", "b"]).select("block", "pos", "count", "best")
    held = blocks.where("docs is not null").select("block", "docs", "links")
    return held.unionByName(found, allowMissingColumns=True).groupBy("block").applyInArrow(_sums, RESULT)
