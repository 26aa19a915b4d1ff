"""The prefix tree of conversations against a plain version."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest

from plantline.llm import prefix_trie
from plantline.llm.queries import op12_prefix_trie

FOLDER = "/root/testdata/sf0.01"
NAMES = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")
ROWS = "conv_id bigint, turn bigint, role string, text string, part string, key bigint, pos string"


def plain(rows):
    """Nodes by dictionaries of whole prefixes. Rows of one conversation must differ in turn, or be equal."""
    given = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            given[conv].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(v)] for c, v in given.items()}
    members, ends, words = defaultdict(list), defaultdict(list), {}
    for c in sorted(own):
        h = zlib.crc32(str(c).encode()) % 4
        path = tuple(own.get(c - c % 20, [])[:h] + own[c][h:])
        for d in range(len(path) + 1):
            members[path[:d]].append(c)
            words[path[:d]] = len(re.findall(r"[^\x20\x09-\x0D]+", path[d - 1][1])) if d else 0
        ends[path].append(c)
    children = defaultdict(int)
    for path in members:
        if path:
            children[path[:-1]] += 1
    leaves, saved = defaultdict(int), defaultdict(int)
    for path, held in members.items():
        for d in range(len(path) + 1):
            leaves[path[:d]] += not children[path]
            saved[path[:d]] += (len(held) - 1) * words[path]
    return sorted(
        (
            (held[0], len(p), members[p[:-1]][0] if p else None, len(held), children[p], leaves[p], saved[p],
             hashlib.sha256(",".join(map(str, ends.get(p, []))).encode()).hexdigest())
            for p, held in members.items()
        ),
        key=repr,
    )


def rows_of(result):
    return sorted((tuple(r[c] for c in NAMES) for r in result.collect()), key=repr)


def test_query_agrees_with_the_plain_version(spark):
    held = spark.read.parquet(f"{FOLDER}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()
    assert rows_of(op12_prefix_trie(spark, FOLDER)) == plain(map(tuple, held))


def odd_conversations(spark):
    rows = [
        (0, None, None, None), (0, 0, "user", "a b"), (0, 1, "bot", "c"), (0, 5, "user", "d"),
        *[(c, t, "user", f"turn {t}") for c in range(1, 45) for t in range(c % 6)],
        (7, 9, "user", "long " * 50_000), (41, 3, None, "x"), (41, 3, None, "x"), (None, 1, "user", "lost"),
        (61, 0, "user", "no family"), (62, 0, "user", "no family"), (63, 0, "", ""), (2**40, 2**50, "user", "far"),
    ]
    return spark.createDataFrame([(*r, "p", 1, "q") for r in rows], ROWS)


@pytest.mark.parametrize("settings", [{}, {"segment": 2}, {"segment": 3, "shard": 5}, {"piece": 2}])
def test_odd_rows_in_any_pieces(spark, settings):
    docs = odd_conversations(spark)
    assert rows_of(prefix_trie.prefix_tree(docs, **settings)) == plain([tuple(r)[:4] for r in docs.collect()])


def test_one_conversation_with_most_rows(spark):
    rows = [(1, t, "user", f"t{t % 97}", "", 0, "") for t in range(30_000)] + [(c, t, "user", f"t{t}", "", 0, "") for c in range(2, 40) for t in range(5)]
    docs = spark.createDataFrame(rows, ROWS)
    tree = {r.depth: r for r in prefix_trie.prefix_tree(docs).where("conv_id = 1").collect()}
    longest = max(tree)
    h = zlib.crc32(b"1") % 4
    assert longest == 30_000 - h and tree[longest].n_leaves == 1 and tree[0].n_convs == 39


def test_no_conversations(spark):
    assert prefix_trie.prefix_tree(spark.createDataFrame([], ROWS)).collect() == []


def test_double_array_holds_exactly_the_given_sequences():
    draw = random.Random(5)
    for alphabet in (2, 10, 5000):
        sequences = [[draw.randrange(alphabet) for _ in range(draw.randrange(1, 9))] for _ in range(400)]
        tokens = np.array([t for s in sequences for t in s])
        lengths = np.array([len(s) for s in sequences])
        starts = np.concatenate([[0], np.cumsum(lengths)[:-1]])
        trie, codes = prefix_trie.packed(tokens, starts, lengths)
        states = prefix_trie.walked(trie, codes, starts, lengths)
        prefixes = {}
        for s, a, n in zip(sequences, starts, lengths, strict=True):
            for k in range(n):
                prefixes.setdefault(tuple(s[: k + 1]), set()).add(int(states[a + k]))
        assert all(len(v) == 1 for v in prefixes.values())
        assert len({next(iter(v)) for v in prefixes.values()}) == len(prefixes) and (states > 0).all()
        known = {t: int(c) for t, c in zip(tokens.tolist(), codes.tolist(), strict=True)}
        for _ in range(300):
            other = [draw.choice(tokens.tolist()) for _ in range(3)]
            state = np.zeros(1, dtype=np.int64)
            for k, t in enumerate(other):
                state = trie.step(state, np.array([known[t]]))
                assert (state[0] >= 0) == (tuple(other[: k + 1]) in prefixes)
                if state[0] < 0:
                    break
