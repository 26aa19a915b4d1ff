import random

import pytest

from plantline.llm import leaks, licenses, neardup
from plantline.llm.queries import op7_leaks, op8_licenses
from tests.llm.helpers import no_documents, odd_documents, plain_words, shingles

FOLDER = "/root/testdata/sf0.01"


def plain_leaks(docs, items, size=5, percent=80):
    found = set()
    sets = {i: shingles(plain_words(t), size) for i, t in items}
    for doc_id, text in docs:
        own = shingles(plain_words(text), size)
        for item, wanted in sets.items():
            if wanted and 100 * len(wanted & own) >= percent * len(wanted):
                found.add((doc_id, item, len(wanted & own) / len(wanted)))
    return found


def rows_of(spark, name, key):
    return [(r[key], r.text) for r in spark.read.parquet(f"{FOLDER}/{name}.parquet").collect()]


def test_leak_query_agrees_with_brute_force(spark):
    expected = plain_leaks(rows_of(spark, "documents", "doc_id"), rows_of(spark, "benchmark", "item_id"))
    assert {tuple(r) for r in op7_leaks(spark, FOLDER).collect()} == expected and expected


@pytest.mark.parametrize("length", [3, 7, 30, 200])
def test_items_of_all_sizes_in_long_documents(spark, length, monkeypatch):
    monkeypatch.setattr(leaks, "PIECE", 64)
    draw = random.Random(length)
    word = lambda: f"w{draw.randrange(10**6)}"
    items = [(i, " ".join(word() for _ in range(length))) for i in range(12)]
    docs = []
    for i, (_, text) in enumerate(items):
        own = text.split()
        if i % 3 == 1 and length > 20:
            own[length // 2] = "changed"
        if i % 3 == 2:
            own = own[: length // 2]
        around = [word() for _ in range(500)] if length > 3 else []
        docs.append((i, " ".join([*around, *own, *around])))
    found = leaks.leaks(
        spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, text string")
    ).select("doc_id", "item_id", "containment")
    assert {tuple(r) for r in found.collect()} == plain_leaks(docs, items)


def test_leaks_of_odd_rows(spark):
    docs = odd_documents(spark)
    items = spark.createDataFrame(
        [(1, "One two, three FOUR five six seven!"), (2, None), (3, ""), (None, "eight nine ten"), (5, "ipsum dolor sit amet lorem")],
        "item_id bigint, text string",
    )
    found = {(r.doc_id, r.item_id) for r in leaks.leaks(docs, items).collect()}
    assert found == {(1, 1), (2, 1), (7, 1), (None, None), (6, 5)}
    kept = leaks.without_leaks(docs, items)
    assert kept.columns == docs.columns and sorted(str(r.doc_id) for r in kept.collect()) == ["3", "4", "5", "8", "None"]
    assert leaks.leaks(no_documents(spark), items).collect() == []
    assert leaks.leaks(docs, items.where("false")).collect() == []
    assert leaks.without_leaks(docs, items.where("false")).count() == docs.count()


def plain_licenses(docs, templates, short=None):
    """Short notices are looked up with shingles of their own word count."""
    found = plain_leaks(docs, templates.items())
    for name, text in (short or {}).items():
        found |= plain_leaks(docs, [(name, text)], size=len(plain_words(text)))
    return {(d, name) for d, name, _ in found}


def test_license_query_finds_what_the_documents_hold(spark):
    docs = rows_of(spark, "documents", "doc_id")
    assert {(r.doc_id, r.license) for r in op8_licenses(spark, FOLDER).collect()} == plain_licenses(docs, licenses.TEMPLATES, licenses.SHORT)


def test_templates_of_all_sizes_at_all_places(spark, monkeypatch):
    monkeypatch.setattr(licenses, "PIECE", 50)
    draw = random.Random(1)
    word = lambda: f"w{draw.randrange(10**5)}"
    templates = {f"t{n}": " ".join(word() for _ in range(n)) for n in (2, 5, 9, 20, 60, 130)}
    docs = []
    for place in range(0, 400, 9):
        for n, (name, text) in enumerate(templates.items()):
            own = text.split()
            if place % 2 and len(own) > 60:
                own[len(own) // 3] = "changed"
            around = place if len(own) > 2 else 0
            docs.append((place * 10 + n, " ".join([*(word() for _ in range(around)), *own, *(word() for _ in range(around // 2))])))
    found = licenses.scan(spark.createDataFrame(docs, "doc_id bigint, text string"), templates).collect()
    assert {(r.doc_id, r.license) for r in found} == plain_licenses(docs, templates)


def test_licenses_of_odd_rows(spark):
    docs = odd_documents(spark)
    templates = {"a": "five six seven", "b": "two three four five six", "c": ""}
    assert {(r.doc_id, r.license) for r in licenses.scan(docs, templates).collect()} == {(1, "b"), (2, "b"), (7, "b")}
    assert licenses.scan(no_documents(spark)).collect() == []
    assert licenses.scan(docs, {}).collect() == []


def test_every_licence_line_of_the_tables_is_found(spark):
    lines = {
        "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
        "All-rights-reserved-line": "All rights reserved.", "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
        "MIT": "Released under the MIT License.", "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    }
    docs = rows_of(spark, "documents", "doc_id")
    found = {(r.doc_id, r.license) for r in op8_licenses(spark, FOLDER).collect()}
    for name, line in lines.items():
        held = {(d, name) for d, text in docs if line in (text or "").split("\n")}
        assert held and held <= found, name


def test_short_notices_are_found_inside_documents(spark, monkeypatch):
    monkeypatch.setattr(licenses, "PIECE", 50)
    filler = [f"w{i}" for i in range(300)]
    docs = [(i, " ".join([*filler[:i], "All rights", "RESERVED.", *filler[i:]])) for i in range(0, 300, 7)]
    docs += [(1001, "all rights are reserved " * 9), (1002, "all rights"), (1003, "All rights reserved")]
    short = {"three": "All rights reserved.", "one": "Reserved", "none": "..."}
    found = licenses.scan(spark.createDataFrame(docs, "doc_id bigint, text string"), {"long": " ".join(filler[:40])}, short=short).collect()
    held = {(d, "three") for d in [*range(0, 300, 7), 1003]} | {(d, "one") for d in [*range(0, 300, 7), 1001, 1003]}
    assert {(r.doc_id, r.license) for r in found if r.license != "long"} == held and all(r.containment == 1 for r in found if r.license != "long")


def test_short_items_are_found_inside_documents(spark, monkeypatch):
    monkeypatch.setattr(leaks, "PIECE", 64)
    filler = [f"w{i}" for i in range(200)]
    docs = [(i, " ".join([*filler[:i], "Name the", "capital!", *filler[i:]])) for i in range(0, 200, 9)] + [(999, "capital the name " * 50)]
    items = [(1, "name the capital"), (2, "name of the capital"), (3, "capital"), (4, " ".join(filler[20:60]))]
    found = leaks.leaks(
        spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, text string")
    )
    pairs = {(r.doc_id, r.item_id) for r in found.collect()}
    inside = {i for i, _ in docs if i < 999}
    assert {p for p in pairs if p[1] < 4} == {(i, 1) for i in inside} | {(i, 3) for i in inside | {999}}


def test_stages_give_back_a_column_named_row_key(spark):
    text = "one two three four five six seven eight nine ten"
    docs = spark.createDataFrame([(1, text, "a"), (2, text, "b"), (3, "some other words that stand alone here", "c")], "doc_id bigint, text string, row_key string")
    items = spark.createDataFrame([(7, "words that stand alone here")], "item_id bigint, text string")
    assert sorted(map(tuple, leaks.without_leaks(docs, items).collect())) == [(1, text, "a"), (2, text, "b")]
    assert sorted((r.doc_id, r.row_key) for r in neardup.without_near_duplicates(docs).collect()) == [(1, "a"), (3, "c")]
