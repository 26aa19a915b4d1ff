"""Sharding by best-fit-decreasing bin packing.

Rows of equal text are one indivisible group. Groups are taken by falling size,
and each enters the shard with the least room that still holds it, found in a
balanced search tree of (room, shard).

Large tables are packed in two steps. Groups that hold at least one part in
``shards * fine`` of all bytes or of all rows (so at most ``2 * shards * fine``
of them) are packed first, on the driver. The rest is dealt by hash over many
parts; each part packs its own groups into its share of the room that is left.
What a part leaves uneven is smaller than its smallest groups.

Defined results: a null text counts as an empty one; rows that are equal in all
columns get separate slots; a group larger than a shard's capacity is cut, row
by row, into as few pieces as the capacity allows (nothing else could keep
sizes near equal); an empty table gives no rows; other columns pass through
unless they carry a name of the result.
"""

from __future__ import annotations

import random
from collections.abc import Iterable

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plantline.llm.common import blocks_of, own_names, scatter, stored
from plantline.operators.ordered import running_totals

#: Bytes that each row counts besides its text.
ROW_BYTES = 16
RESULT = ("size", "text_crc32", "law", "shard", "slot", "grown_shard")


class RoomTree:
    """Treap of (room, bin) with insertion, removal and the least entry not below a value."""

    def __init__(self, entries: Iterable[tuple[int, int]] = ()):
        self._random = random.Random(7)
        self._root: list | None = None
        for entry in entries:
            self.add(entry)

    def _split(self, node, entry):
        if node is None:
            return None, None
        if node[0] < entry:
            low, high = self._split(node[3], entry)
            return [node[0], node[1], node[2], low], high
        low, high = self._split(node[2], entry)
        return low, [node[0], node[1], high, node[3]]

    def _merge(self, low, high):
        if low is None or high is None:
            return low or high
        if low[1] > high[1]:
            return [low[0], low[1], low[2], self._merge(low[3], high)]
        return [high[0], high[1], self._merge(low, high[2]), high[3]]

    def add(self, entry: tuple[int, int]) -> None:
        low, high = self._split(self._root, entry)
        self._root = self._merge(self._merge(low, [entry, self._random.random(), None, None]), high)

    def remove(self, entry: tuple[int, int]) -> None:
        low, rest = self._split(self._root, entry)
        _, high = self._split(rest, (entry[0], entry[1] + 1))
        self._root = self._merge(low, high)

    def at_least(self, room: int) -> tuple[int, int] | None:
        node, found = self._root, None
        while node is not None:
            if node[0][0] >= room:
                node, found = node[2], node[0]
            else:
                node = node[3]
        return found

    def most(self) -> tuple[int, int]:
        node = self._root
        while node[3] is not None:
            node = node[3]
        return node[0]


def best_fit(sizes: list[int], rooms: list[int]) -> list[int]:
    """Bin of each size, sizes falling. What fits nowhere goes where most room is left."""
    tree = RoomTree((room, place) for place, room in enumerate(rooms))
    chosen = []
    for size in sizes:
        entry = tree.at_least(size) or tree.most()
        tree.remove(entry)
        tree.add((entry[0] - size, entry[1]))
        chosen.append(entry[1])
    return chosen


def _packer(shards: int, rooms: list[int]):
    total = max(1, sum(rooms))

    def pack(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values(["bytes", "key"], ascending=[False, True])
        own, turn = int(part["bytes"].sum()), int(part["part"].iloc[0]) * 7 % shards
        # Each part starts at another shard, so that no shard is always the first to be filled.
        order = [(s + turn) % shards for s in range(shards)]
        bins = best_fit([int(b) for b in part["bytes"]], [rooms[s] * own // total for s in order])
        return pd.DataFrame({"key": part["key"], "shard": [order[b] for b in bins]})

    return pack


@own_names("doc_id", "text", result=RESULT)
def shard_documents(docs: DataFrame, shards: int = 40, fine: int = 250) -> DataFrame:
    """Every row of ``docs`` with its shard and its gapless slot there; the text itself is left out."""
    spark = docs.sparkSession
    blocks = blocks_of(spark)
    text = F.coalesce(F.col("text"), F.lit(""))
    carried = [c for c in docs.columns if c not in (*RESULT, "text")]
    rows = stored(
        docs.select(
            *carried,
            (F.octet_length(text) + ROW_BYTES).cast("bigint").alias("size"),
            F.crc32(text.cast("binary")).alias("text_crc32"),
            F.unhex(F.md5(text.cast("binary"))).alias("key"),
        ),
        "shard-rows",
    )
    groups = stored(
        rows.groupBy("key").agg(
            F.count(F.lit(1)).alias("rows"), F.sum("size").alias("bytes"), F.min("size").alias("size")
        ),
        "shard-groups",
    )
    all_bytes, all_rows = groups.agg(
        F.coalesce(F.sum("bytes"), F.lit(0)), F.coalesce(F.sum("rows"), F.lit(0))
    ).first()
    capacity = max(1, -(-all_bytes // shards))
    large = F.col("bytes") * shards * fine >= all_bytes
    crowded = F.col("rows") * shards * fine >= all_rows
    # At most shards * fine groups reach either share.
    head = groups.where(large | crowded).collect()

    pieces = []
    for group in head:
        most = group.rows if group.bytes <= capacity else max(1, capacity // group.size)
        for piece, start in enumerate(range(0, group.rows, most)):
            pieces.append((min(most, group.rows - start) * group.size, bytes(group.key), piece, most))
    pieces.sort(key=lambda p: (-p[0], p[1], p[2]))
    rooms = [capacity] * shards
    placed = best_fit([p[0] for p in pieces], rooms)
    for piece, shard in zip(pieces, placed, strict=True):
        rooms[shard] -= piece[0]
    rooms = [max(0, room) for room in rooms]
    head_plan = spark.createDataFrame(
        [(key, piece, most, shard) for (_, key, piece, most), shard in zip(pieces, placed, strict=True)],
        "key binary, piece bigint, most bigint, shard int",
    )
    head_keys = F.broadcast(head_plan.select("key").distinct())
    cut_keys = F.broadcast(head_plan.where("piece > 0").select("key").distinct())

    tail_plan = (
        groups.join(head_keys, "key", "left_anti")
        .select("key", "bytes", F.pmod(F.xxhash64("key"), F.lit(blocks)).cast("int").alias("part"))
        .groupBy("part")
        .applyInPandas(_packer(shards, rooms), "key binary, shard int")
    )
    order = F.pmod(scatter("doc_id"), F.lit(blocks))
    cut = running_totals(
        rows.join(cut_keys, "key", "left_semi"), ["key"], order, [F.col("doc_id")], {"number": F.lit(1)}
    )
    # Numbers come from windows of equal rows, whose order may differ between runs; any order is right.
    cut_pieces = head_plan.join(cut_keys, "key", "left_semi").select(
        "key", "piece", F.col("most").alias("piece_rows"), "shard"
    )
    most = F.broadcast(cut_pieces.groupBy("key").agg(F.max("piece_rows").alias("piece_rows")))
    in_pieces = (
        cut.join(most, "key")
        .withColumn("piece", F.floor((F.col("number") - 1) / F.col("piece_rows")))
        .join(F.broadcast(cut_pieces.drop("piece_rows")), ["key", "piece"])
    )
    whole = rows.join(
        F.broadcast(head_plan.join(cut_keys, "key", "left_anti").select("key", "shard")), "key"
    )
    tail = rows.join(head_keys, "key", "left_anti").join(tail_plan, "key")
    columns = [*carried, "size", "text_crc32", "shard"]
    assigned = stored(
        in_pieces.select(*columns).unionByName(whole.select(*columns)).unionByName(tail.select(*columns)),
        "shard-assigned",
    )
    numbered = running_totals(
        assigned, ["shard"], order, [F.col("doc_id"), F.col("text_crc32")], {"slot": F.lit(1)}
    )
    return numbered.select(
        *carried, "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
        (F.col("slot") - 1).cast("bigint").alias("slot"), F.lit(None).cast("int").alias("grown_shard"),
    )


def shard_totals(assigned: DataFrame) -> DataFrame:
    """Rows and bytes of each shard."""
    return assigned.groupBy("shard").agg(F.count(F.lit(1)).alias("rows"), F.sum("size").alias("bytes"))
