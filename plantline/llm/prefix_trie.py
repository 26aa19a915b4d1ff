"""Prefix tree of conversations, packed shard by shard into double arrays.

A conversation is a sequence of turns (role, text). Each distinct sequence of
first turns is a node. Conversations of equal sequences are represented by the
one of the smallest id, cut into segments, and dealt to shards by the node at
which a segment starts; a node with more rows than a shard holds has several
shards. Within a shard turns get dense ids, and the segments are packed into the
arrays BASE and CHECK: the child of state s by turn t is ``BASE[s] + t``, and it
exists if ``CHECK`` there is s. Walking the segments gives the states, which are
the nodes; what shards find out about nodes they share is merged by node.

A node's name outside its shard is its depth and 128 bits, the sum of one hash
per turn and place. Sums can be taken in pieces, so no task needs a whole
conversation. What a subtree adds up to comes from suffix sums along segments: a
node's own share counts once, with the representative that is its smallest
member.

Defined results: turns are ordered by turn, null first, and ties by a hash of role
and text; a null role or text is empty; rows without conv_id name no conversation
and take no part; repeated rows are turns of their own; an empty table gives no
nodes, as the root has no members; other columns are not read, so their names
cannot clash. SHA-256 runs over a node's list of ids in order: one task reads
that list as a stream of pieces, never as a whole.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plantline.llm.common import WORD, stored
from plantline.operators.ordered import running_totals

#: Turns of a segment, turns of a shard, and ids in a piece of a list.
SEGMENT, SHARD, PIECE = 4096, 100_000, 1024
#: Free places of the arrays that are tried for the children of a state.
TRIED = 4096
#: Conversations of a family share first turns; heads are at most 3 turns long.
FAMILY, HEADS = 20, 4

NODE = ["depth", "k1", "k2"]


# -- double array -------------------------------------------------------------------------------------


class DoubleArray:
    """A trie over dense ids from 1 on; state 0 is the root."""

    def __init__(self):
        self.base = np.zeros(1024, dtype=np.int64)
        self.check = np.full(1024, -1, dtype=np.int64)
        self.size = 1

    def _grow(self, size: int) -> None:
        if size > self.base.size:
            more = max(size, 2 * self.base.size) - self.base.size
            self.base = np.concatenate([self.base, np.zeros(more, dtype=np.int64)])
            self.check = np.concatenate([self.check, np.full(more, -1, dtype=np.int64)])
        self.size = max(self.size, size)

    def _place(self, parent: int, codes: np.ndarray, free: np.ndarray) -> None:
        """Choose BASE of ``parent`` so that all its children fall on free places."""
        if free.size:
            tried = free[self.check[free] < 0][:TRIED] - codes[0]
            at = tried[:, None] + codes[None, :]
            fits = (at < self.size).all(axis=1)
            fits[fits] = (self.check[at[fits]] < 0).all(axis=1)
            if fits.any():
                base = int(tried[np.argmax(fits)])
                self.base[parent] = base
                self.check[base + codes] = parent
                return
        base = self.size - int(codes[0])
        self._grow(base + int(codes[-1]) + 1)
        self.base[parent] = base
        self.check[base + codes] = parent

    def add_children(self, parents: np.ndarray, codes: np.ndarray) -> None:
        """All children of some states, each state once and for all; pairs sorted by parent, then code."""
        firsts = np.flatnonzero(np.concatenate([[True], parents[1:] != parents[:-1]]))
        counts = np.diff(np.append(firsts, parents.size))
        single = firsts[counts == 1]
        if single.size:
            at = self.size + np.arange(single.size)
            self._grow(self.size + single.size)
            self.base[parents[single]] = at - codes[single]
            self.check[at] = parents[single]
        several = np.flatnonzero(counts > 1)
        if several.size:
            free = np.flatnonzero(self.check[1 : self.size] < 0) + 1
            for k in several.tolist():
                own = slice(firsts[k], firsts[k] + counts[k])
                self._place(int(parents[firsts[k]]), codes[own], free)

    def step(self, states: np.ndarray, codes: np.ndarray) -> np.ndarray:
        """The child of each state by each code, or -1."""
        at = self.base[states] + codes
        inside = (at > 0) & (at < self.size)
        found = np.where(inside, at, 0)
        return np.where(inside & (self.check[found] == states), found, -1)


def packed(tokens: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> tuple[DoubleArray, np.ndarray]:
    """The trie of sequences ``tokens[start : start + length]`` of numbers from 0 on, and the dense id of each token.

    Ids are given by level and parent, so that new turns below one state are neighbours.
    """
    dense = np.zeros(int(tokens.max()) + 1 if tokens.size else 0, dtype=np.int64)
    trie, given = DoubleArray(), 0
    states = np.zeros(starts.size, dtype=np.int64)
    for level in range(int(lengths.max()) if lengths.size else 0):
        alive = np.flatnonzero(lengths > level)
        at = starts[alive] + level
        order = np.lexsort((tokens[at], states[alive]))
        fresh = tokens[at][order]
        fresh = fresh[dense[fresh] == 0]
        firsts = np.unique(fresh, return_index=True)[1]
        fresh = fresh[np.sort(firsts)]
        dense[fresh] = given + 1 + np.arange(fresh.size)
        given += fresh.size
        pairs = np.unique(np.stack([states[alive], dense[tokens[at]]]), axis=1)
        trie.add_children(pairs[0], pairs[1])
        states[alive] = trie.step(states[alive], dense[tokens[at]])
    return trie, dense[tokens]


def walked(trie: DoubleArray, codes: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The state after each token of each sequence."""
    reached = np.zeros(codes.size, dtype=np.int64)
    states = np.zeros(starts.size, dtype=np.int64)
    for level in range(int(lengths.max()) if lengths.size else 0):
        alive = np.flatnonzero(lengths > level)
        at = starts[alive] + level
        states[alive] = trie.step(states[alive], codes[at])
        reached[at] = states[alive]
    return reached


def _states(rows: pa.Table, size: int) -> tuple[pa.Table, np.ndarray, np.ndarray, np.ndarray]:
    """The rows of a shard by segment and place, their states, and the segments' starts and lengths."""
    rows = rows.combine_chunks().sort_by([("conv", "ascending"), ("pos", "ascending")])
    conv, segment = rows["conv"].to_numpy(), (rows["pos"].to_numpy() - 1) // size
    starts = np.flatnonzero(np.concatenate([[True], (conv[1:] != conv[:-1]) | (segment[1:] != segment[:-1])]))
    lengths = np.diff(np.append(starts, conv.size))
    tokens = rows["token"].combine_chunks().dictionary_encode().indices.to_numpy()
    trie, codes = packed(tokens, starts, lengths)
    return rows, walked(trie, codes, starts, lengths), starts, lengths


def _shard_nodes(rows: pa.Table, size: int) -> pa.Table:
    """The nodes of a shard with what its conversations add to them."""
    rows, states, _, _ = _states(rows, size)
    named = rows.append_column("state", pa.array(states))
    nodes = named.group_by("state", use_threads=False).aggregate(
        [("pos", "min"), ("k1", "min"), ("k2", "min"), ("p1", "min"), ("p2", "min"), ("words", "min"), ("weight", "sum"), ("conv", "min")]
    )
    return nodes.select(
        ["pos_min", "k1_min", "k2_min", "p1_min", "p2_min", "words_min", "weight_sum", "conv_min"]
    ).rename_columns(["depth", "k1", "k2", "p1", "p2", "words", "n", "least"])


def _shard_sums(rows: pa.Table, size: int) -> pa.Table:
    """Per node of a shard the sums over the rest of all its conversations."""
    rows, states, starts, lengths = _states(rows, size)
    named = rows.select(["pos", "k1", "k2"]).append_column("state", pa.array(states))
    for name, tail in (("saved", "tail_saved"), ("leaves", "tail_leaves")):
        own = rows[name].to_numpy()
        upto = np.concatenate([[0], np.cumsum(own)])
        ends = np.repeat(starts + lengths, lengths)
        rest = upto[ends] - upto[:-1] + np.repeat(rows[tail].to_numpy()[starts], lengths)
        named = named.append_column(name, pa.array(rest))
    sums = named.group_by("state", use_threads=False).aggregate(
        [("pos", "min"), ("k1", "min"), ("k2", "min"), ("saved", "sum"), ("leaves", "sum")]
    )
    return sums.select(["pos_min", "k1_min", "k2_min", "saved_sum", "leaves_sum"]).rename_columns([*NODE, "saved", "leaves"])


# -- sequences ----------------------------------------------------------------------------------------


def numbered(df: DataFrame, group: str, order: list[Column]) -> DataFrame:
    """``df`` with ``pos``, the place of each row in its group from 1 on; a large group is spread over many tasks."""
    dealt = df.withColumn("dealt", F.monotonically_increasing_id())
    ordered = [F.col(group), *order, F.col("dealt")]
    ranged = stored(
        dealt.repartitionByRange(*ordered).sortWithinPartitions(*ordered)
        .withColumns({"part": F.spark_partition_id(), "row": F.monotonically_increasing_id()}),
        "trie-ordered",
    )
    parts = ranged.groupBy(group, "part").agg(F.count(F.lit(1)).alias("n"), F.min("row").alias("first"))
    before = Window.partitionBy(group).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = parts.select(group, "part", "first", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    return ranged.join(starts, [group, "part"]).select(*df.columns, (F.col("row") - F.col("first") + 1 + F.col("before")).alias("pos"))


def turns_of(conversations: DataFrame) -> DataFrame:
    """(conv, pos, key, words) of all turns, numbered in order."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    key = F.unhex(F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary")))
    turns = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("bigint").alias("conv"), F.col("turn").alias("turn"), key.alias("key"),
        F.regexp_count(text, F.lit(WORD)).cast("bigint").alias("words"),
    )
    return numbered(turns, "conv", [F.asc_nulls_first("turn"), F.col("key")]).select("conv", "pos", "key", "words")


def with_family_heads(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rebuilt turns, and all conversations: first turns are those of the family's first conversation."""
    first = (F.col("conv") - F.col("conv") % FAMILY).alias("family")
    taken = (F.crc32(F.col("conv").cast("string").cast("binary")) % HEADS).alias("taken")
    convs = stored(turns.groupBy("conv").agg(F.count(F.lit(1)).alias("own")).select("conv", first, taken), "trie-convs")
    heads = stored(
        turns.where((F.col("conv") % FAMILY == 0) & (F.col("pos") < HEADS))
        .select(F.col("conv").alias("family"), "pos", "key", "words"),
        "trie-heads",
    )
    known = heads.groupBy("family").agg(F.count(F.lit(1)).alias("known"))
    others = convs.where("conv <> family").join(known, "family", "left").select(
        "conv", "family", "taken", F.least("taken", F.coalesce("known", F.lit(0))).alias("shared")
    )
    borrowed = others.join(heads, "family").where("pos <= taken").select("conv", "pos", "key", "words")
    kept = turns.join(others.select("conv", "taken", "shared"), "conv").where("pos > taken").select(
        "conv", (F.col("pos") - F.col("taken") + F.col("shared")).alias("pos"), "key", "words"
    )
    same = turns.where(F.col("conv") % FAMILY == 0).select("conv", "pos", "key", "words")
    return same.unionByName(kept).unionByName(borrowed), convs.select("conv")


def with_nodes(turns: DataFrame, size: int) -> DataFrame:
    """``turns`` with the name of the node that ends at each, and of the node before it (``p1``, ``p2``)."""
    low = F.lit((1 << 32) - 1)
    sums: dict[str, Column] = {}
    for seed in (1, 2):
        value = F.xxhash64("key", "pos", F.lit(seed))
        sums |= {f"h{seed}": F.shiftrightunsigned(value, 32), f"l{seed}": value.bitwiseAND(low)}
    segment = F.floor((F.col("pos") - 1) / size)
    whole = running_totals(stored(turns, "trie-turns"), ["conv"], segment, [F.col("pos")], sums)

    def name(seed: int, less: bool) -> Column:
        parts = [F.col(c) - (sums[c] if less else F.lit(0)) for c in (f"h{seed}", f"l{seed}")]
        return F.shiftleft(parts[0].bitwiseAND(low), 32).bitwiseOR(parts[1].bitwiseAND(low))

    return whole.select(
        "conv", "pos", "key", "words", name(1, False).alias("k1"), name(2, False).alias("k2"), name(1, True).alias("p1"), name(2, True).alias("p2")
    )


def _dealt(rows: DataFrame, size: int, shard_rows: int) -> DataFrame:
    """``rows`` with ``token`` and ``shard``; a segment is whole in one shard."""
    segment = F.floor((F.col("pos") - 1) / size)
    inside = Window.partitionBy("conv", "segment").orderBy("pos")
    rows = rows.withColumn("segment", segment).withColumn("start", F.first(F.struct("k1", "k2")).over(inside))
    begins = F.unhex(F.md5(F.concat_ws(",", "k1", "k2").cast("binary")))
    rows = stored(
        rows.withColumn("token", F.when((F.col("pos") - 1) % size == 0, begins).otherwise(F.col("key"))).drop("key"), "trie-dealt"
    )
    buckets = max(1, -(-rows.count() // shard_rows))
    large = rows.groupBy("start").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > shard_rows)
    salt = F.pmod(F.xxhash64("conv", F.lit(7)), F.ceil(F.col("n") / shard_rows))
    shard = F.when(F.col("n").isNull(), F.pmod(F.xxhash64("start"), F.lit(buckets))).otherwise(F.xxhash64("start", salt))
    return rows.join(large, "start", "left").withColumn("shard", shard).drop("start", "n")


# -- ids of the conversations that end at a node --------------------------------------------------------


def _written(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """Sorted (node, conv) as pieces of the node's list."""
    names, node, held, number = [*NODE, "part", "piece", "ids"], None, [], 0

    def piece() -> pa.RecordBatch:
        row = [*node, part, number, ",".join(map(str, held))]
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.string()]
        return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row, kinds, strict=True)], names)

    part = 0
    for batch in batches:
        for *own, part_, conv in zip(*(batch.column(c).to_pylist() for c in (*NODE, "part", "conv")), strict=True):
            if held and (own != node or len(held) == size):
                yield piece()
                number, held = number + 1, []
            node, part = own, part_
            held.append(conv)
    if held:
        yield piece()


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted pieces as one digest per node."""
    node, digest = None, None
    for batch in batches:
        done: list[tuple] = []
        for *own, ids in zip(*(batch.column(c).to_pylist() for c in (*NODE, "ids")), strict=True):
            if own != node:
                if digest is not None:
                    done.append((*node, digest.hexdigest()))
                node, digest = own, hashlib.sha256()
            else:
                digest.update(b",")
            digest.update(ids.encode())
        yield _digests(done)
    if digest is not None:
        yield _digests([(*node, digest.hexdigest())])


def _digests(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string()]
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)], [*NODE, "ends_sha256"])


def list_digests(ends: DataFrame, piece: int = PIECE) -> DataFrame:
    """(node, ends_sha256) over the ids, ascending and comma-joined, of the conversations that end at each node."""
    order = [*NODE, "conv"]
    pieces = (
        ends.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("part", F.spark_partition_id())
        .mapInArrow(lambda batches: _written(batches, piece), "depth bigint, k1 bigint, k2 bigint, part int, piece bigint, ids string")
    )
    return (
        pieces.repartition(*NODE).sortWithinPartitions(*NODE, "part", "piece")
        .mapInArrow(_hashed, "depth bigint, k1 bigint, k2 bigint, ends_sha256 string")
    )


# -- the tree -----------------------------------------------------------------------------------------


def tree_of(turns: DataFrame, convs: DataFrame, segment: int = SEGMENT, shard: int = SHARD, piece: int = PIECE) -> DataFrame:
    """The nodes over rebuilt ``turns`` (conv, pos, key, words) of all ``convs``."""
    named = stored(with_nodes(turns, segment), "trie-nodes")
    last = named.groupBy("conv").agg(F.max_by(F.struct(F.col("pos").alias("depth"), "k1", "k2"), "pos").alias("end"))
    none = F.lit(0).cast("bigint")
    ends = stored(
        convs.join(last, "conv", "left")
        .select("conv", *[F.coalesce(f"end.{c}", none).alias(c) for c in NODE]),
        "trie-ends",
    )
    # One conversation stands for all that end at its node.
    reps = ends.where("depth > 0").groupBy(*NODE).agg(F.min("conv").alias("conv"), F.count(F.lit(1)).alias("weight")).select("conv", "weight")
    rows = stored(_dealt(named.join(reps, "conv"), segment, shard), "trie-shards")
    found = rows.groupBy("shard").applyInArrow(
        lambda t: _shard_nodes(t, segment), "depth bigint, k1 bigint, k2 bigint, p1 bigint, p2 bigint, words bigint, n bigint, least bigint"
    )
    nodes = stored(
        found.groupBy(*NODE).agg(
            F.sum("n").alias("n_convs"), F.min("least").alias("conv_id"), F.min("words").alias("words"), F.min("p1").alias("p1"), F.min("p2").alias("p2")
        ),
        "trie-merged",
    )
    parent = [(F.col("depth") - 1).alias("depth"), F.col("p1").alias("k1"), F.col("p2").alias("k2")]
    children = nodes.groupBy(*parent).agg(F.count(F.lit(1)).alias("n_children"))
    nodes = stored(
        nodes.join(children, NODE, "left").withColumn("n_children", F.coalesce("n_children", F.lit(0)))
        .withColumn("saved", (F.col("n_convs") - 1) * F.col("words"))
        .withColumn("leaves", (F.col("n_children") == 0).cast("bigint")),
        "trie-counted",
    )
    # A node's own share belongs to its smallest member; later segments of that one hand theirs to the earlier ones.
    own = nodes.select(F.col("conv_id").alias("conv"), F.col("depth").alias("pos"), "saved", "leaves")
    later = Window.partitionBy("conv").orderBy(F.desc("segment")).rowsBetween(Window.unboundedPreceding, -1)
    tails = (
        own.groupBy("conv", F.floor((F.col("pos") - 1) / segment).alias("segment")).agg(F.sum("saved").alias("s"), F.sum("leaves").alias("l"))
    )
    # Shares reach up to the first segment, also where earlier segments have none of their own.
    spans = rows.groupBy("conv", "segment").agg(F.count(F.lit(1)).alias("rows"))
    tails = spans.join(tails, ["conv", "segment"], "left").select(
        "conv", "segment", F.coalesce(F.sum("s").over(later), F.lit(0)).alias("tail_saved"), F.coalesce(F.sum("l").over(later), F.lit(0)).alias("tail_leaves")
    )
    shared = rows.drop("words", "weight", "p1", "p2").join(own, ["conv", "pos"], "left").join(tails, ["conv", "segment"])
    shared = shared.withColumns({c: F.coalesce(c, F.lit(0)) for c in ("saved", "leaves")})
    sums = (
        shared.groupBy("shard").applyInArrow(lambda t: _shard_sums(t, segment), "depth bigint, k1 bigint, k2 bigint, saved bigint, leaves bigint")
        .groupBy(*NODE).agg(F.sum("leaves").alias("n_leaves"), F.sum("saved").alias("saved_tokens"))
    )
    below = nodes.select(*NODE, "p1", "p2", "conv_id", "n_convs", "n_children").join(sums, NODE)

    # The root, which no shard holds: two rows of sums.
    every = convs.agg(F.min("conv").alias("conv_id"), F.count(F.lit(1)).alias("n_convs")).first()
    total = nodes.agg(
        F.count_if(F.col("depth") == 1).alias("n_children"), F.coalesce(F.sum("leaves"), none).alias("n_leaves"),
        F.coalesce(F.sum("saved"), none).alias("saved_tokens"),
    ).first()
    root = (0, 0, 0, None, every.conv_id, every.n_convs, total.n_children, max(total.n_leaves, 1), total.saved_tokens)
    columns = [*NODE, "parent_conv_id", "conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens"]
    root = convs.sparkSession.createDataFrame([root] if every.n_convs else [], ", ".join(f"{c} bigint" for c in columns))
    top = below.where("depth = 1").withColumn("parent_conv_id", F.lit(every.conv_id))
    above = nodes.select(*[F.col(c).alias(f"u_{c}") for c in NODE], F.col("conv_id").alias("parent_conv_id"))
    deep = below.where("depth > 1").join(
        above, (F.col("u_depth") == F.col("depth") - 1) & (F.col("u_k1") == F.col("p1")) & (F.col("u_k2") == F.col("p2"))
    )
    whole = root.unionByName(top.select(*columns)).unionByName(deep.select(*columns))
    empty = F.lit(hashlib.sha256(b"").hexdigest())
    return whole.join(list_digests(ends, piece), NODE, "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce("ends_sha256", empty).alias("ends_sha256")
    )


def prefix_tree(conversations: DataFrame, segment: int = SEGMENT, shard: int = SHARD, piece: int = PIECE) -> DataFrame:
    """One row per node of the tree over the conversations rebuilt with the first turns of their family."""
    rebuilt, convs = with_family_heads(stored(turns_of(conversations), "trie-numbered"))
    return tree_of(rebuilt, convs, segment, shard, piece)
