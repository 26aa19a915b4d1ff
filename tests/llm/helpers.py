"""Small tables and brute-force versions for the tests of the training-data operators."""

from __future__ import annotations

import re

LONG = "lorem ipsum dolor sit amet " * 9000
DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, size bigint, kept string, row_key string"


def odd_documents(spark):
    """Nulls in every column, empty and very long texts, ties, repeated rows, and columns with clashing names."""
    rows = [
        (1, "one two three four five six seven", "en", "b", 3, 1, "x", "k"),
        (2, "one two three four five six seven", "en", "a", 3, 1, "x", "k"),
        (2, "one two three four five six seven", "en", "a", 3, 1, "x", "k"),
        (3, "", "en", None, 0, None, None, None),
        (4, None, None, "a", None, 2, "y", None),
        (None, "eight nine ten", "fr", "c", 1, 3, "z", "k"),
        (None, None, None, None, None, None, None, None),
        (5, " \n\t ", "fr", "c", 1, 3, "z", "k"),
        (6, LONG, "en", "b", 9, 9, "w", "k"),
        (7, "One TWO three four five six seven", "en", "", 3, 1, "x", "k"),
        (8, "Été ÜBER İstanbul é \U0001f600 <|endoftext|> don't", "fr", "é", 3, 1, "x", "k"),
    ]
    return spark.createDataFrame(rows, DOCS)


def no_documents(spark):
    return spark.createDataFrame([], DOCS)


def base_words(text: str | None) -> list[str]:
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def lower_words(text: str | None) -> list[str]:
    return ["".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in w) for w in base_words(text)]


def plain_words(text: str | None) -> list[str]:
    return re.findall(r"[^\W_]+", (text or "").lower())


def shingles(tokens: list[str], size: int) -> set[tuple[str, ...]]:
    if not tokens:
        return set()
    return {tuple(tokens[i : i + size]) for i in range(max(1, len(tokens) - size + 1))}


def components(sets: list[set], percent: int = 80) -> list[int]:
    """Least position that each position is linked with; an empty set is linked with nothing."""
    label = list(range(len(sets)))

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    where: dict = {}
    for i, own in enumerate(sets):
        near = {}
        for s in own:
            for j in where.get(s, ()):
                near[j] = near.get(j, 0) + 1
            where.setdefault(s, []).append(i)
        for j, both in near.items():
            if 100 * both >= percent * (len(own) + len(sets[j]) - both):
                a, b = sorted((root(i), root(j)))
                label[b] = a
    return [root(i) for i in range(len(sets))]
