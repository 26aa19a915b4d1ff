import random

import numpy as np
import pytest

from plantline.llm import neardup
from plantline.llm.queries import op6_near_duplicates
from tests.llm.helpers import components, lower_words, no_documents, odd_documents, shingles

FOLDER = "/root/testdata/sf0.01"


def expected(docs, size):
    sets = [shingles(lower_words(r.text), size) for r in docs]
    groups = components(sets)
    least = {}
    for r, g in zip(docs, groups, strict=True):
        if r.doc_id is not None:
            least[g] = min(least.get(g, r.doc_id), r.doc_id)
    return sorted((str(r.doc_id), len(s), str(least.get(g))) for r, s, g in zip(docs, sets, groups, strict=True))


def found(rows):
    return sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in rows)


def test_query_agrees_with_brute_force(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()
    rows = op6_near_duplicates(spark, FOLDER).collect()
    assert found(rows) == expected(docs, 2)
    assert all(r.kept == (r.doc_id == r.component_id) for r in rows)


def chained(n, seed):
    """Texts of which each differs a little from the one before, so that the first and the last share nothing."""
    draw = random.Random(seed)
    words = [f"w{draw.random()}" for _ in range(120)]
    for _ in range(n):
        yield " ".join(words)
        for _ in range(3):
            words[draw.randrange(len(words))] = f"w{draw.random()}"


@pytest.mark.parametrize("rounds", [0, 3])
def test_chains_and_stars(spark, rounds):
    texts = [*chained(40, 1), *chained(15, 2), *["copy of one text here"] * 30]
    draw = random.Random(3)
    base = [f"b{i}" for i in range(150)]
    for _ in range(60):
        own = list(base)
        for _ in range(draw.randrange(9)):
            own[draw.randrange(150)] = f"x{draw.random()}"
        texts.append(" ".join(own))
    order = list(range(len(texts)))
    draw.shuffle(order)
    docs = spark.createDataFrame([(i, texts[k]) for i, k in enumerate(order)], "doc_id bigint, text string")
    assert found(neardup.near_duplicates(docs, shingle=2, rounds=rounds).collect()) == expected(docs.collect(), 2)


def test_components_of_long_paths(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(1, 200)] + [(500, 400), (600, 600)], "a bigint, b bigint")
    labels = {r.node: r.comp for r in neardup.components(edges).collect()}
    assert labels == {**dict.fromkeys(range(1, 201), 1), 500: 400, 400: 400, 600: 600}


def test_shingle_sets_are_of_the_full_text():
    text = ("Aa\tbB  cc\x0bdd é " * 3).encode()
    assert neardup.shingle_set(text, 2).size == len(shingles(lower_words(text.decode()), 2)) == len(neardup.word_shingles(text, 2))
    assert neardup.shingle_set(b" \n", 2).size == 0 and neardup.shingle_set(b"One", 2).size == 1


def test_odd_rows(spark):
    docs = odd_documents(spark)
    rows = neardup.near_duplicates(docs, shingle=5).collect()
    assert found(rows) == expected(docs.collect(), 5)
    kept = neardup.without_near_duplicates(docs)
    assert kept.columns == docs.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(["1", "3", "4", "5", "6", "8", "None", "None"])


def test_one_row_of_each_group_stays_without_and_with_equal_ids(spark):
    base = [f"b{i}" for i in range(100)]
    near = [" ".join([*base[:k], "other", *base[k + 1 :]]) for k in (95, 97, 99)]
    docs = spark.createDataFrame(
        [(7, near[0]), (7, near[1]), (None, near[2]), (None, "a b c d e f"), (None, "A b c d e f"), (None, "A b c d e f")],
        "doc_id bigint, text string",
    )
    kept = neardup.without_near_duplicates(docs).collect()
    assert sorted(str(r.doc_id) for r in kept) == ["7", "None"]
    assert next(r.text for r in kept if r.doc_id is None).lower() == "a b c d e f"


@pytest.mark.parametrize("rounds", [0, 1])
def test_pairs_far_from_the_largest_component_are_compared(spark, rounds):
    """Groups at 0.6 to each other share buckets; links within each of them must be found."""
    draw = random.Random(9)
    shared = [f"s{i}" for i in range(160)]
    texts = []
    for g in range(5):
        core = [*shared, *[f"g{g}_{i}" for i in range(45)]]
        for _ in range(3 + 4 * g):
            own = list(core)
            own[-1 - draw.randrange(40)] = f"x{draw.random()}"
            texts.append(" ".join(own))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    assert found(neardup.near_duplicates(docs, shingle=2, rounds=rounds).collect()) == expected(docs.collect(), 2)


def test_empty_table(spark):
    assert neardup.near_duplicates(no_documents(spark)).collect() == []
    assert neardup.without_near_duplicates(no_documents(spark)).collect() == []


def test_parities_never_rule_out_a_pair_that_is_similar_enough():
    draw = np.random.default_rng(3)
    for size in (1, 5, 60, 400, 5000):
        for _ in range(60):
            base = draw.integers(0, 2**63, size, dtype=np.uint64)
            other = base.copy()
            changed = draw.integers(0, size // 7 + 2)
            other[draw.integers(0, size, changed)] = draw.integers(0, 2**63, changed, dtype=np.uint64)
            a, b = np.unique(base), np.unique(other)
            both = np.intersect1d(a, b).size
            bits = sum(bin(int(x) & (2**64 - 1)).count("1") for x in neardup.parities(a) ^ neardup.parities(b))
            assert bits <= a.size + b.size - 2 * both
            if 100 * both >= 80 * (a.size + b.size - both):
                assert 180 * bits <= 20 * (a.size + b.size)


def test_a_group_of_copies_that_differ_from_each_other(spark):
    """Copies of one text with many or few changes each: few pairs leave a join, and components are right."""
    draw = random.Random(8)
    base = [f"w{draw.randrange(10**6)}" for _ in range(120)]
    docs = []
    for i in range(400):
        own = list(base)
        for _ in range(draw.randrange(0, 24)):
            own[draw.randrange(len(own))] = f"x{draw.randrange(10**6)}"
        docs.append((i, " ".join(own)))
    found = {r.doc_id: r.component_id for r in neardup.near_duplicates(spark.createDataFrame(docs, "doc_id bigint, text string"), shingle=2).collect()}
    assert [found[i] for i in range(400)] == components([shingles(lower_words(t), 2) for _, t in docs])
