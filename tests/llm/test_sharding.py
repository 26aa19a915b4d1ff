import zlib
from collections import Counter, defaultdict

import pytest

from plantline.llm.queries import op1_sharding
from plantline.llm.sharding import ROW_BYTES, RoomTree, best_fit, shard_documents
from tests.llm.helpers import no_documents, odd_documents

FOLDER = "/root/testdata/sf0.01"


def plain_best_fit(sizes, rooms):
    rooms, chosen = list(rooms), []
    for size in sizes:
        fits = [(r, i) for i, r in enumerate(rooms) if r >= size]
        place = min(fits)[1] if fits else max((r, i) for i, r in enumerate(rooms))[1]
        rooms[place] -= size
        chosen.append(place)
    return chosen


def test_tree_finds_the_tightest_bin():
    sizes = sorted(((7 * i * i + 3 * i) % 101 + 1 for i in range(300)), reverse=True)
    rooms = [400 + (i * 37) % 50 for i in range(40)]
    assert best_fit(sizes, rooms) == plain_best_fit(sizes, rooms)


def test_tree_edges():
    tree = RoomTree([(3, 0), (3, 1), (9, 2)])
    assert tree.at_least(4) == (9, 2) and tree.at_least(10) is None and tree.most() == (9, 2)
    tree.remove((9, 2))
    assert tree.at_least(1) == (3, 0) and tree.most() == (3, 1)


def check(rows, shards, texts):
    assert len(rows) == len(texts)
    slots = defaultdict(list)
    for r in rows:
        slots[r.shard].append(r.slot)
        assert 0 <= r.shard < shards and r.law == "bytes" and r.grown_shard is None
    for held in slots.values():
        assert sorted(held) == list(range(len(held)))


def test_query_packs_all_documents(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    rows = op1_sharding(spark, FOLDER).collect()
    check(rows, 40, texts)
    load, shards_of = Counter(), defaultdict(set)
    for r in rows:
        raw = texts[r.doc_id].encode()
        assert (r.size, r.text_crc32) == (len(raw) + ROW_BYTES, zlib.crc32(raw))
        load[r.shard] += r.size
        shards_of[texts[r.doc_id]].add(r.shard)
    assert max(load.values()) - min(load.values()) < 0.01 * sum(load.values()) / 40
    assert all(len(s) == 1 for s in shards_of.values())


def test_large_group_is_cut_and_small_tails_are_packed(spark):
    rows = [(i, "same text" if i % 3 == 0 else f"text {i} " * (i % 17)) for i in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = shard_documents(docs, shards=5, fine=2).collect()
    check(found, 5, rows)
    load = Counter()
    for r in found:
        load[r.shard] += r.size
    mean = sum(load.values()) / 5
    assert all(abs(v - mean) < 0.02 * mean for v in load.values())
    same = Counter(r.shard for r in found if r.doc_id % 3 == 0)
    assert sum(same.values()) == 1000


@pytest.mark.parametrize("shards", [1, 3])
def test_odd_rows(spark, shards):
    docs = odd_documents(spark)
    found = shard_documents(docs, shards=shards)
    assert {"lang", "source", "n_chars", "kept"} <= set(found.columns) and len(set(found.columns)) == len(found.columns)
    rows = found.collect()
    check(rows, shards, docs.collect())
    assert sorted(r.size for r in rows if r.size == ROW_BYTES) == [ROW_BYTES] * 3


def test_empty_table(spark):
    assert shard_documents(no_documents(spark)).collect() == []


def test_inner_names_come_back_as_they_were(spark):
    names = ["key", "piece", "number", "_block", "most", "part", "bytes", "rows", "piece_rows", "_own_0", "order"]
    docs = spark.createDataFrame(
        [(k, "x" * (k % 5), *[f"{n}{k}" for n in names]) for k in range(60)], "doc_id bigint, text string, " + ", ".join(f"`{n}` string" for n in names)
    )
    found = shard_documents(docs, shards=4)
    assert found.columns == ["doc_id", *names, "size", "text_crc32", "law", "shard", "slot", "grown_shard"]
    assert all(r[n] == f"{n}{r.doc_id}" for r in found.collect() for n in names)
