from collections import Counter, defaultdict

from plantline.llm.mixing import mix, mixed_copies, mixed_documents
from plantline.llm.oracles import ORACLES
from plantline.llm.queries import op2_mixing
from tests.compare import differences, open_duck
from tests.llm.helpers import base_words, no_documents, odd_documents

FOLDER = "/root/testdata/sf0.001"


def test_query_agrees_with_sql_and_reruns(spark):
    expected = open_duck(FOLDER).execute(ORACLES["op2_mixing"]).df()
    for _ in range(2):
        assert differences(op2_mixing(spark, FOLDER).toPandas(), expected) == []


def plain_targets(sizes: dict, weights=(5, 2, 1), passes=3):
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, full = sum(sizes.values()), set()
    while True:
        rest = total - sum(passes * sizes[s] for s in full)
        level = sum(weight[s] for s in names if s not in full)
        over = {s for s in names if s not in full and weight[s] * rest > passes * sizes[s] * level}
        if not over:
            return {s: float(passes * sizes[s]) if s in full else weight[s] * rest / level for s in names}
        full |= over


def test_targets_stop_at_three_passes(spark):
    sizes = {"a": 2, "b": 500, "c": 30, "d": 7, "e": 900, None: 11}
    rows = [(i, s, "w " * n) for i, (s, n) in enumerate(sizes.items())]
    docs = spark.createDataFrame(rows, "doc_id bigint, source string, text string")
    found = {r.source: r for r in mixed_documents(docs).collect()}
    expected = plain_targets(sizes)
    for source, target in expected.items():
        assert abs(found[source].target - target) < 1e-9
        assert abs(found[source].taken - target) <= 0.5 and found[source].taken <= 3 * sizes[source]


def test_slots_are_spread_evenly_and_pieces_fill_them(spark):
    rows = [(i, f"s{i % 4}", "w " * (1 + i * 7 % 40)) for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id bigint, source string, text string")
    laid, pieces = mix(docs, block_words=20, least_slots=100)
    held = pieces.collect()
    of_slot, source_of = Counter(), {}
    for p in held:
        of_slot[p.n] += p.words
        source_of.setdefault(p.n, p.skey)
        assert source_of[p.n] == p.skey
    order = [source_of[n] for n in sorted(source_of)]
    share = {s: order.count(s) / len(order) for s in set(order)}
    for s, part in share.items():
        for upto in range(50, len(order), 50):
            assert abs(order[:upto].count(s) - part * upto) < 6
    largest = defaultdict(int)
    for n, words in of_slot.items():
        largest[source_of[n]] = max(largest[source_of[n]], words)
    assert all(of_slot[n] == largest[s] for n, s in source_of.items() if n < max(of_slot) - 40)


def test_the_schedule_decides_what_is_taken(spark):
    rows = [(i, f"s{i % 4}", "w " * (1 + i * 7 % 40)) for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id bigint, source string, text string")
    for length in (1, 20, 64):
        found = mixed_documents(docs, block_words=length, least_slots=1).groupBy("source").agg({"taken": "sum", "target": "max"}).collect()
        off = [(r["sum(taken)"], r["max(target)"]) for r in found]
        assert all(abs(taken - target) <= length + 0.5 for taken, target in off), (length, off)
    # Steps that meet few places of the targets give the sources other shares.
    for step in (0, 1 << 12):
        found = mixed_documents(docs, step=step).groupBy("source").agg({"taken": "sum", "target": "max"}).collect()
        assert any(abs(r["sum(taken)"] - r["max(target)"]) > r["max(target)"] / 4 for r in found)


def test_rows_of_two_sources_and_inner_names(spark):
    names = ["skey", "dealt", "mix_key", "place", "upto", "length", "take", "copies", "copy", "turn", "start", "stop", "k", "row_key"]
    schema = "doc_id bigint, text string, source string, " + ", ".join(f"{n} string" for n in names)
    held = [(1, "one two three", s, *[f"{n} of {s}" for n in names]) for s in ("a", "a", "b", None)]
    docs = spark.createDataFrame(held, schema)
    found = mixed_documents(docs)
    assert found.columns == ["doc_id", "source", *names, "size", "source_size", "target", "taken"]
    assert sorted(map(tuple, found.select("source", *names).collect()), key=str) == sorted([(r[2], *r[3:]) for r in held], key=str)
    copies = mixed_copies(docs)
    assert copies.columns == docs.columns
    kept = {tuple(r) for r in copies.collect()}
    assert kept <= set(held) and {r[2] for r in kept} == {"a", "b", None}


def test_odd_rows(spark):
    docs = odd_documents(spark)
    found = mixed_documents(docs).collect()
    assert len(found) == docs.count()
    for r in found:
        assert 0 <= r.taken <= 3 * r.size
    words = Counter()
    for r in docs.collect():
        words[r.source] += len(base_words(r.text))
    assert {r.source: r.source_size for r in found} == dict(words)
    copies = mixed_copies(docs)
    assert copies.columns == docs.columns
    assert copies.where("doc_id = 4").count() == 1  # no words, no cost


def test_empty_table(spark):
    assert mixed_documents(no_documents(spark)).collect() == []
    assert mixed_copies(no_documents(spark)).collect() == []
