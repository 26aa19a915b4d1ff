"""Alignment of two tokenizers against a plain version."""

import hashlib
from collections import Counter, defaultdict

import public_tokenizers
import pytest

from plantline.llm import alignment
from plantline.llm.queries import op13_alignment
from tests.llm.helpers import no_documents, odd_documents

FOLDER = "/root/testdata/sf0.001"
FILES = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def plain(rows):
    """Offsets, groups and links of each row by loops over tokens."""
    encode_a, spelled_a, encode_b, spelled_b = alignment._loaded(*FILES)
    spelled_a, spelled_b = spelled_a.to_pylist(), spelled_b.to_pylist()
    held, counts = [], Counter()
    for doc_id, text in rows:
        text = text or ""
        a, b = encode_a([text])[0], encode_b([text])[0]
        whole = b" " + text.encode()
        if not text or b"".join(spelled_a[i] for i in a) != whole or b"".join(spelled_b[i] for i in b) != whole:
            held.append((doc_id, 0, 0, 0, [], ""))
            continue

        def ends(ids, spelled):
            at, found = 0, defaultdict(list)
            for k, i in enumerate(ids):
                at += len(spelled[i])
                found[at].append(k)
            return found

        ends_a, ends_b = ends(a, spelled_a), ends(b, spelled_b)
        common = sorted(set(ends_a) & set(ends_b))
        links = [(a[x], b[y]) for e in common for x in ends_a[e] for y in ends_b[e]]
        counts.update(links)
        parts, last_a, last_b = [], 0, 0
        for e in common:
            x, y = ends_a[e][-1] + 1, ends_b[e][-1] + 1
            parts.append(",".join(map(str, a[last_a:x])) + "|" + ",".join(map(str, b[last_b:y])))
            last_a, last_b = x, y
        held.append((doc_id, len(a), len(b), len(common), links, hashlib.sha256(";".join(parts).encode()).hexdigest()))
    best = defaultdict(int)
    for (_, b), n in counts.items():
        best[b] = max(best[b], n)
    return sorted(
        (
            (d, na, nb, ng, len(links), sum(counts[x] == best[x[1]] for x in links), sum(counts[x] for x in links), sha)
            for d, na, nb, ng, links, sha in held
        ),
        key=repr,
    )


def rows_of(result):
    names = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
    return sorted((tuple(r[c] for c in names) for r in result.collect()), key=repr)


def test_query_agrees_with_the_plain_version(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()
    assert rows_of(op13_alignment(spark, FOLDER)) == plain(docs)


@pytest.mark.parametrize("block", [1, 50, 1 << 20])
def test_odd_rows_in_any_blocks(spark, block):
    docs = odd_documents(spark)
    extra = spark.createDataFrame(
        [(20, "a <s> b </s> <unk> <|endoftext|> x"), (21, "two  spaces\tand\nlines "), (22, "▁piece"), (23, "\U0001f469‍\U0001f680 \x00"),
         (24, " lead"), (25, "naïve Ω≈ç 漢字かな")],
        "doc_id bigint, text string",
    )
    every = docs.select("doc_id", "text").unionByName(extra)
    expected = plain([tuple(r) for r in every.collect()])
    assert rows_of(alignment.align_tokenizers(every, *FILES, block=block)) == expected
    assert {r[0]: r[1] for r in expected}[20] > 0


def test_extra_columns_may_have_any_name(spark):
    docs = odd_documents(spark)
    for name in ("block", "docs", "pairs", "links", "found", "n_a", "count"):
        docs = docs.withColumn(name, docs.lang)
    assert rows_of(alignment.align_tokenizers(docs, *FILES)) == rows_of(alignment.align_tokenizers(odd_documents(spark), *FILES))


def test_no_documents(spark):
    assert alignment.align_tokenizers(no_documents(spark), *FILES).collect() == []


def test_places_are_one_number():
    """Document and byte are one key, as joins and groups by two columns take about twice the time."""
    import pyarrow as pa

    spelled = pa.array([b" a", b"bc", b"d"], pa.binary())
    found = alignment._ends(pa.array([[0, 1], [], [2, 0, 1]], pa.list_(pa.int32())), spelled)
    document = 1 << alignment.PLACE_BITS
    assert found.column_names == ["place", "id", "at"]
    assert found["place"].to_pylist() == [2, 4, 2 * document + 1, 2 * document + 3, 2 * document + 5]


def test_no_row_grows_with_its_block(spark):
    """Lists of links and pairs were decoded by the thousand rows, and ran out of memory where a file had many blocks."""
    import pyarrow as pa

    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").coalesce(1)
    blocks = alignment.aligned_blocks(docs, *FILES, block=5000)
    assert not [f.name for f in blocks.schema if f.dataType.typeName() in ("array", "struct", "map")]
    whole = blocks.where("docs is not null").select("block", "pos").collect()
    assert len(whole) > 20 and len({r.block for r in whole}) == len(whole) and not any(r.pos for r in whole)
    # Every pair of a block is a row, numbered from 0 on, and what is packed refers to these numbers.
    some = blocks.where("block = 0").collect()
    held = next(r for r in some if r.docs is not None)
    docs_of, links = (alignment._unpacked(pa.scalar(bytes(x))) for x in (held.docs, held.links))
    assert sorted(r.pos for r in some if r.pos is not None) == list(range(len(some) - 1))
    assert set(links["pair"].to_pylist()) == set(range(len(some) - 1)) and sum(docs_of["n_links"].to_pylist()) == sum(r.n for r in some if r.n)
    plan = alignment.align_tokenizers(docs, *FILES, block=5000)._jdf.queryExecution().executedPlan().toString()
    assert "collect_list" not in plan
