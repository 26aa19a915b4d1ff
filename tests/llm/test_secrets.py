import hashlib
import random
import re

import numpy as np
import pytest

from plantline.llm import secrets
from plantline.llm.queries import op4_secrets
from tests.llm.helpers import no_documents, odd_documents

FOLDER = "/root/testdata/sf0.01"
LETTERS = "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in "password")


def either(word):
    return "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in word)


NAMES = "|".join([*map(either, ("password", "passwd", "secret", "token")), either("api") + "_?" + either("key")])
BASE = [
    ("assign", rf"""(?:{NAMES})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 8),
    ("access", r"(AKIA[A-Z0-9]+)", 16),
    ("hex", r"([0-9a-f]+)", 32),
]


def plain(text):
    found = []
    for rank, (kind, pattern, least) in enumerate(BASE):
        found += [(m.start(), rank, m.end(), kind) for m in re.finditer(pattern, text or "") if len(m.group(1)) >= least]
    return [(kind, a, b) for a, _, b, kind in sorted(found)]


def agrees(row, text):
    base = plain(text)
    assert [row.n_assign, row.n_access, row.n_hex] == [sum(k == n for k, _, _ in base) for n in ("assign", "access", "hex")]
    written = [f"{k}:{a}:{b}" for k, a, b in base]
    assert row.base_sha256 == hashlib.sha256(",".join(written).encode()).hexdigest()
    assert set(written) <= set(row.spans.split(",")) | ({""} if not written else set())


def test_query_agrees_with_plain_patterns(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    rows = op4_secrets(spark, FOLDER).collect()
    assert len(rows) == len(texts)
    for row in rows:
        agrees(row, texts[row.doc_id])


def test_model_finds_held_out_secrets_and_leaves_words_alone(spark):
    draw = random.Random(5)
    key = lambda n: "".join(draw.choice(secrets.ALPHABET[:62]) for _ in range(n))
    word = lambda: "".join(draw.choice(["data", "Base", "load", "er", "ing", "Name", "_id", "count", "un"]) for _ in range(6))
    rows = [(i, f"token = {key(40)} " + " ".join(word() for _ in range(30))) for i in range(200)]
    rows += [(1000 + i, f"see {key(36)}1a here") for i in range(50)]
    rows += [(2000 + i, f"see {word()}{word()}2 and {word()}_3 here") for i in range(50)]
    found = {r.doc_id: r.spans for r in secrets.find_secrets(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert sum("random:4:" in found[1000 + i] for i in range(50)) >= 49
    assert sum("random" in found[2000 + i] for i in range(50)) == 0


def test_patterns_at_their_edges(spark):
    texts = [
        "password: token: abcdefghijk", "API_KEY='12345678'", "apikey = 1234567", "ſecret=12345678", "toKen=12345678",
        "AKIAAKIA1234567", "AKIA123456789012x", "0" * 31, "é" + "0" * 32 + "g" + "a" * 33, "secret=secret=12345678 token=" + "f" * 40,
    ]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    for row in secrets.find_secrets(docs).collect():
        agrees(row, texts[row.doc_id])


def test_untrained_model_is_neutral():
    assert np.allclose(secrets.log_ratio(np.zeros(2 * secrets.CLASSES**2)), 0)


def test_odd_rows_and_empty_table(spark):
    docs = odd_documents(spark)
    found = secrets.find_secrets(docs)
    assert len(set(found.columns)) == len(found.columns) and "text" not in found.columns
    rows = found.collect()
    assert len(rows) == docs.count() and all(r.spans == "" for r in rows)
    assert secrets.find_secrets(no_documents(spark)).collect() == []


KINDS_OF_KEYS = {
    "base62 of 16": (secrets.ALPHABET[:62], 16), "base62 of 20": (secrets.ALPHABET[:62], 20), "letters": (secrets.ALPHABET[:52], 20),
    "base64": (secrets.ALPHABET[:62] + "+/", 40), "upper case": (secrets.ALPHABET[:26] + "0123456789", 20), "hex of 20": ("0123456789abcdef", 20),
}


@pytest.mark.parametrize("copies", [1, 20])
def test_keys_of_all_kinds_are_found_at_two_sizes_of_corpus(spark, copies):
    folder = "/root/testdata/sf0.001"
    draw = random.Random(9)
    key = lambda alphabet, n: "".join(draw.choice(alphabet) for _ in range(n))
    planted = {(kind, i): key(*of) for kind, of in KINDS_OF_KEYS.items() for i in range(50)}
    lines = [f"see {k} and /usr/local/configuration/{k}/documentation here" for k in planted.values()]
    plain = ["/usr/local/configuration/documentation and some_longer_identifier, state-of-the-art-documentation here"] * 50
    docs = [r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()] * copies + plain
    rows = list(enumerate(lines + docs))
    found = [r.spans for r in secrets.find_secrets(spark.createDataFrame(rows, "doc_id bigint, text string")).orderBy("doc_id").collect()]
    for kind in KINDS_OF_KEYS:
        both = 0
        for (k, _), line, spans in zip(planted, lines, found, strict=False):
            value = line.split()[1]
            inside = [tuple(map(int, s.split(":")[1:])) for s in spans.split(",") if s.startswith("random")]
            whole = {line.find(value), line.rfind(value)}
            both += k == kind and all(any(a <= at + 5 and at + len(value) - 5 <= b for a, b in inside) for at in whole)
        assert both >= 45, (kind, both)
    assert not any("random" in s for s in found[-len(plain) :])


def test_a_sample_counts_once():
    text = "token=" + "0123456789abcdef" * 2
    assert secrets.samples_by_kind(text, secrets.base_spans(text)) == {2: ["0123456789abcdef" * 2]}


def test_inner_names_come_back_as_they_were(spark):
    names = ["base", "candidates", "values", "counts"]
    docs = spark.createDataFrame([(1, "password=abcdefgh12", *names), (2, None, *names)], "doc_id bigint, text string, base string, candidates string, values string, counts string")
    found = secrets.find_secrets(docs)
    assert set(names) <= set(found.columns)
    assert sorted((r.doc_id, r.n_assign, *[r[n] for n in names]) for r in found.collect()) == [(1, 1, *names), (2, 0, *names)]
