import struct
import zlib

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from plantline.llm import token_files
from plantline.llm.queries import op3_token_files
from plantline.session import scratch_path
from tests.llm.helpers import no_documents, odd_documents

FOLDER = "/root/testdata/sf0.001"
PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def whole():
    return Tokenizer.from_file(PATH)


def expected(whole, docs):
    start = 0
    for doc_id, text in docs:
        ids = [*whole.encode(text or "", add_special_tokens=False).ids, 2]
        yield doc_id, start, len(ids), zlib.crc32(struct.pack(f"<{len(ids)}I", *ids))
        start += len(ids)


def test_query_agrees_with_the_tokenizer(spark, whole):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").orderBy("doc_id").collect()]
    rows = [(r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in op3_token_files(spark, FOLDER).orderBy("doc_id").collect()]
    assert rows == list(expected(whole, docs))


@settings(max_examples=300, deadline=None)
@given(st.text() | st.text(st.characters(max_codepoint=0x24F)) | st.text("aAéÉß'sS.,!? \n\t\x1c\x85\xa0\xadĀŉİſ½²ªǅ1<|>", max_size=30))
def test_words_give_the_same_ids_as_whole_texts(text):
    encode = token_files.encoder(PATH)
    assert encode.ids(text).tolist() == encode.whole.encode(text, add_special_tokens=False).ids


def test_ranges_and_page_indexes(spark):
    import glob

    import pyarrow.parquet as pq

    folder = scratch_path(spark, "tokens-test")
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    token_files.write_tokens(docs, folder, PATH, files=3)
    files = sorted(glob.glob(f"{folder.removeprefix('file:')}/*.parquet"))
    ids = [i for f in files for i in pq.read_table(f, columns=["doc_id"])["doc_id"].to_pylist()]
    assert ids == sorted(ids) and len(files) == 3
    column = pq.ParquetFile(files[0]).metadata.row_group(0).column(2)
    assert column.has_column_index or column.has_offset_index
    assert any("DICTIONARY" in e for e in column.encodings)
    some = token_files.read_tokens(spark, folder, 10, 19)
    assert sorted(r.doc_id for r in some.select("doc_id").collect()) == list(range(10, 20))
    plan = some.select("doc_id", "n_tokens")._jdf.queryExecution().toString()
    assert "GreaterThanOrEqual(doc_id,10)" in plan and "ReadSchema: struct<doc_id:bigint,n_tokens:bigint>" in plan


def test_odd_rows(spark, whole):
    docs = odd_documents(spark)
    rows = [(r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in token_files.tokenized(docs, PATH).collect()]
    known = {d: n for d, _, n, _ in expected(whole, [(r.doc_id, r.text) for r in docs.collect() if r.doc_id is not None])}
    assert len(rows) == docs.count()
    rows.sort(key=lambda r: r[1])
    assert [r[0] for r in rows] == sorted((r[0] for r in rows), key=lambda d: (d is not None, d or 0))
    assert all(known[d] == n for d, _, n, _ in rows if d is not None)
    assert [r[1] for r in rows] == [sum(x[2] for x in rows[:i]) for i in range(len(rows))]


def test_empty_table(spark):
    assert token_files.tokenized(no_documents(spark), PATH).collect() == []
