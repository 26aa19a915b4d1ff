import hashlib
import zlib
from collections import Counter, defaultdict
from functools import cache

import numpy as np

import corpus_pipeline
from plantline.llm import quality
from plantline.llm.sharding import ROW_BYTES
from tests.llm.helpers import base_words, components, lower_words, no_documents, odd_documents, shingles
from tests.llm.test_leaks_and_licenses import plain_leaks
from tests.llm.test_mixing import plain_targets
from tests.llm.test_quality import coded, plain_model
from tests.llm.test_sharding import plain_best_fit

FOLDER = "/root/testdata/sf0.001"


def plain_quality(docs, labels):
    """Documents between the quantiles of the trusted documents of their language."""
    judged = defaultdict(list)
    for r in labels:
        judged[r.doc_id].append(r.quality == 1 and r.toxic == 0)
    trusted = {doc_id for doc_id, good in judged.items() if all(good)}
    probability = plain_model([r.text or "" for r in docs if r.doc_id in trusted])
    log = cache(lambda gram: float(np.float32(np.log(probability(gram)))))

    def milli(text):
        codes = coded(text)
        return round(-1000 * sum(log(tuple(codes[i : i + 4])) for i in range(len(codes) - 3)) / len(text))

    scores = [milli(r.text) if r.text else None for r in docs]

    def limits(held):
        ranked = sorted(held)
        low = next(m for i, m in enumerate(ranked) if sum(x <= m for x in ranked) > len(ranked) * quality.LOWER)
        high = next(m for m in ranked if sum(x <= m for x in ranked) >= len(ranked) * (1 - quality.UPPER))
        return low, high

    by_language = defaultdict(list)
    for r, score in zip(docs, scores, strict=True):
        if r.doc_id in trusted and score is not None:
            by_language[r.lang].append(score)
    every = limits([s for held in by_language.values() for s in held])
    bounds = {language: limits(held) for language, held in by_language.items()}

    def good(r, score):
        low, high = bounds.get(r.lang, every)
        return score is not None and low <= score <= high

    return [r for r, score in zip(docs, scores, strict=True) if good(r, score)]


def plain_near_duplicates(docs):
    groups = components([shingles(lower_words(r.text), 5) for r in docs])
    least = {}
    for r, group in zip(docs, groups, strict=True):
        least[group] = min(least.get(group, r.doc_id), r.doc_id)
    return [r for r, group in zip(docs, groups, strict=True) if r.doc_id == least[group]]


def plain_decontamination(docs, items):
    bad = {doc_id for doc_id, _, _ in plain_leaks([(r.doc_id, r.text) for r in docs], [(i.item_id, i.text) for i in items])}
    return [r for r in docs if r.doc_id not in bad]


def plain_mix(docs):
    words = Counter()
    for r in docs:
        words[r.source] += len(base_words(r.text))
    result = []
    for source, target in plain_targets(words).items():
        held = sorted((r for r in docs if r.source == source), key=lambda r: hashlib.md5(str(r.doc_id).encode()).hexdigest())
        take, before = min(int(target + 0.5), 3 * words[source]), 0
        for r in held:
            size = len(base_words(r.text))
            taken = sum(max(0, min(take, start + size) - start) for start in (before + k * words[source] for k in range(3)))
            result += [r] * ((2 * taken + size) // (2 * size) if size else 1)
            before += size
    return result


def plain_shards(docs, shards=40):
    """(doc_id, size, crc32, shard) as often as it occurs; texts are unique to a document here."""
    raw = {r.doc_id: (r.text or "").encode() for r in docs}
    copies = Counter(r.doc_id for r in docs)
    size = {d: len(t) + ROW_BYTES for d, t in raw.items()}
    capacity = max(1, -(-sum(size[d] * n for d, n in copies.items()) // shards))
    pieces = []
    for d, n in copies.items():
        most = n if n * size[d] <= capacity else max(1, capacity // size[d])
        for piece, start in enumerate(range(0, n, most)):
            rows = min(most, n - start)
            pieces.append((-rows * size[d], hashlib.md5(raw[d]).digest(), piece, d, rows))
    pieces.sort()
    found = Counter()
    for (_, _, _, d, rows), shard in zip(pieces, plain_best_fit([-p[0] for p in pieces], [capacity] * shards), strict=True):
        found[d, size[d], zlib.crc32(raw[d]), shard] += rows
    return found


def test_pipeline_agrees_with_brute_force(spark):
    read = lambda name: spark.read.parquet(f"{FOLDER}/{name}.parquet").collect()
    docs = read("documents")
    good = plain_quality(docs, read("labels"))
    single = plain_near_duplicates(good)
    clean = plain_decontamination(single, read("benchmark"))
    mixed = plain_mix(clean)
    assert len(docs) > len(good) > len(single) > len(clean) > 0
    rows = corpus_pipeline.run(spark, FOLDER).collect()
    assert Counter(r.doc_id for r in rows) == Counter(r.doc_id for r in mixed)
    assert Counter((r.doc_id, r.size, r.text_crc32, r.shard) for r in rows) == plain_shards(mixed)
    slots = defaultdict(list)
    for r in rows:
        slots[r.shard].append(r.slot)
    assert all(sorted(held) == list(range(len(held))) for held in slots.values())


def test_stages_keep_the_columns_and_take_odd_rows(spark):
    for docs in (odd_documents(spark), no_documents(spark)):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            kept = stage(spark, docs, FOLDER)
            assert kept.columns == docs.columns and kept.count() <= 3 * docs.count()
        last = corpus_pipeline.STAGES[-1][1](spark, docs, FOLDER)
        assert last.count() == docs.count() and {"shard", "slot"} <= set(last.columns)
