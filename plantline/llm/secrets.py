"""Secret scans: fixed patterns, and character Markov models of random strings and ordinary identifiers.

Two first-order models are trained from labelled samples: strings that patterns
prove to be secrets, and ordinary identifiers and words. Of a candidate, a run of
characters that keys are made of, the stretches are taken whose logarithm of the
ratio of probabilities under both is largest; one of at least ``threshold`` is
reported with the whole parts, between separators, that it lies in. Separators
count for neither model, so words of a path do not cancel a key beside them.

Each sample counts once. The kinds of secrets weigh the same however often each
occurs, and half of each is even over the kind's alphabet, as samples of one kind
say nothing on the letters of another. Smoothing grows with the counts, so that
the ratio of a pair does not depend on the size of the corpus.

All documents are read once, whole: the pass gives the spans of the patterns, the
candidates, and counts of character pairs in the samples. Counts are summed over
the corpus to at most ``CLASSES ** 2`` numbers for each kind of sample.

Defined results: a null text is an empty one; positions are code points, ends
exclusive; candidates lie outside the spans of patterns; a stretch of fewer than
``LEAST`` characters, without a letter, or of fewer than ``VARIETY`` different
characters is not reported; equal rows are reported separately; an empty table gives no rows; other columns
pass through unless they carry a name of the result.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plantline.llm.common import own_names, stored

# The patterns of the base scan, by kind, in order of rank.
KINDS = ("assign", "access", "hex", "random")
ASSIGN = re.compile(
    r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
# Runs of hex digits are maximal, so asking for 32 at once finds the same as dropping shorter runs.
HEX = re.compile(r"[0-9a-f]{32,}")

#: A candidate is such a run with a letter in it; what is reported of it has as many characters, so many of them different.
LEAST, VARIETY = 16, 6
CANDIDATE = re.compile(rf"[A-Za-z0-9+/_=-]{{{LEAST},}}")
SEPARATORS = "+/_.=-"
#: What keeps a candidate from the ordinary samples.
MAY_BE = re.compile(rf"[0-9]|[A-Za-z]{{{LEAST}}}")
#: Ordinary identifiers and words, for training.
ORDINARY = re.compile(r"[A-Za-z_][A-Za-z0-9_]{7,}")
THRESHOLD = 12.0
#: Weight of a character's own frequency in its probability after another: observations, and a share of those there are.
PRIOR, PRIOR_SHARE = 10.0, 0.05
#: Share of an even distribution in a character's own frequency.
EVEN = 0.05

ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_.=-"
EDGE, CLASSES = len(ALPHABET), len(ALPHABET) + 1
_CLASS = np.full(256, EDGE, dtype=np.int64)
_CLASS[np.frombuffer(ALPHABET.encode(), dtype=np.uint8)] = np.arange(len(ALPHABET))
#: Characters of secrets by kind.
KIND_ALPHABETS = (ALPHABET[:62], ALPHABET[:26] + ALPHABET[52:62], "0123456789abcdef")
RESULT = ("n_assign", "n_access", "n_hex", "base_sha256", "spans", "base", "candidates", "values")


def base_spans(text: str) -> list[tuple[int, int, int, int]]:
    """(start, rank of kind, end, start of the value) of every match of the patterns, in order."""
    found = [(m.start(), 0, m.end(), m.start(2)) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 8]
    found += [(m.start(), 1, m.end(), m.start()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 16]
    found += [(m.start(), 2, m.end(), m.start()) for m in HEX.finditer(text)]
    return sorted(found)


def joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in sorted(spans))


def pair_codes(strings: list[str]) -> np.ndarray:
    """Numbers of the character pairs in the strings; each begins and ends at an edge."""
    raw = ("\x00" + "\x00".join(strings) + "\x00").encode("ascii", "replace")
    held = _CLASS[np.frombuffer(raw, dtype=np.uint8)]
    return held[:-1] * CLASSES + held[1:]


def samples_by_kind(text: str, base: list[tuple[int, int, int, int]]) -> dict[int, list[str]]:
    """The values that patterns found, each once: one that overlaps another counts for the narrower pattern."""
    found: dict[int, list[str]] = {}
    taken: list[tuple[int, int]] = []
    for _, kind, stop, value in sorted(base, key=lambda b: (-b[1], b[0])):
        if not any(s < stop and value < e for s, e in taken):
            taken.append((value, stop))
            found.setdefault(kind, []).append(text[value:stop])
    return found


def _outside(text: str, spans: list[tuple[int, int]]) -> Iterator[str]:
    at = 0
    for start, stop in spans:
        yield text[at:start]
        at = max(at, stop)
    yield text[at:]


def _reader(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per document its spans and candidates; per batch one more row with the counts of its samples."""
    span = pa.list_(pa.struct([("start", pa.int32()), ("kind", pa.int32()), ("stop", pa.int32())]))
    near = pa.list_(pa.struct([("start", pa.int32()), ("value", pa.string())]))
    for batch in batches:
        spans, candidates = [], []
        counts = np.zeros((1 + len(KIND_ALPHABETS)) * CLASSES**2, dtype=np.int64)
        for value in batch.column("text"):
            text = value.as_py() or ""
            base = base_spans(text)
            spans.append([{"start": s, "kind": k, "stop": e} for s, k, e, _ in base])
            own, at = [], 0
            for start, stop in [*((s, e) for s, _, e, _ in base), (len(text), len(text))]:
                for m in CANDIDATE.finditer(text, at, max(at, start)):
                    if any(c.isalpha() for c in m.group()):
                        own.append({"start": m.start(), "value": m.group()})
                at = max(at, stop)
            candidates.append(own)
            for kind, samples in samples_by_kind(text, base).items():
                counts[(1 + kind) * CLASSES**2 : (2 + kind) * CLASSES**2] += np.bincount(pair_codes(samples), minlength=CLASSES**2)
            # What is a secret, or may be one, is no ordinary sample.
            may_be = ((c["start"], c["start"] + len(c["value"])) for c in own if MAY_BE.search(c["value"]))
            own = sorted([*((s, e) for s, _, e, _ in base), *may_be])
            ordinary = ORDINARY.findall(" ".join(_outside(text, own)))
            if ordinary:
                counts[: CLASSES**2] += np.bincount(pair_codes(ordinary), minlength=CLASSES**2)
        n = batch.num_rows
        columns = [*batch.columns[:-1], pa.array(spans, span), pa.array(candidates, near), pa.nulls(n, pa.list_(pa.int64()))]
        names = [*batch.schema.names[:-1], "base", "candidates", "counts"]
        yield pa.RecordBatch.from_arrays(columns, names=names)
        last = [*(pa.nulls(1, c.type) for c in columns[:-3]), pa.nulls(1, span), pa.nulls(1, near), pa.array([counts.tolist()])]
        yield pa.RecordBatch.from_arrays(last, names=names)


def log_ratio(counts: np.ndarray) -> np.ndarray:
    """log P(next | last, random) - log P(next | last, ordinary) from both models' pair counts.

    Each model leans on the frequency of the next character alone, with a weight that grows with the observations.
    """
    logs = []
    for part in counts.reshape(2, CLASSES, CLASSES):
        alone = (1 - EVEN) * (part.sum(axis=0) + 1) / (part.sum() + CLASSES) + EVEN / CLASSES
        last = part.sum(axis=1, keepdims=True)
        weight = PRIOR + PRIOR_SHARE * last
        logs.append(np.log((part + weight * alone) / (last + weight)))
    return (logs[1] - logs[0]).ravel()


def balanced(counts: np.ndarray) -> np.ndarray:
    """Pair counts of ordinary strings and of secrets, from those of ordinary strings and of each kind of secret."""
    ordinary, *kinds = counts.reshape(-1, CLASSES, CLASSES)
    secret = np.zeros((CLASSES, CLASSES))
    for alphabet, seen in zip(KIND_ALPHABETS, kinds, strict=True):
        held = [ALPHABET.index(c) for c in alphabet]
        even = np.zeros((CLASSES, CLASSES))
        even[np.ix_(held, held)] = 1 / len(held) ** 2
        secret += (even + seen / seen.sum()) / 2 if seen.sum() else even
    return np.concatenate([ordinary.ravel(), (secret * max(ordinary.sum(), 1000.0) / len(kinds)).ravel()])


def stretches(value: str, ratio: np.ndarray, threshold: float) -> list[tuple[int, int]]:
    """(start, end) of the parts of a run in which a stretch of largest sum reaches ``threshold``, in order."""
    scores = ratio[pair_codes([value])[1:-1]]
    apart = np.array([c in SEPARATORS for c in value])
    scores[apart[:-1] | apart[1:]] = 0
    found: list[list[int]] = []
    total = best = 0.0
    start = end = 0

    def close() -> None:
        if best >= threshold:
            a, b = start, end
            while a > 0 and value[a - 1] not in SEPARATORS:
                a -= 1
            while b < len(value) and value[b] not in SEPARATORS:
                b += 1
            if found and a < found[-1][1]:
                found[-1][1] = b
            else:
                found.append([a, b])

    for at, score in enumerate(scores.tolist()):
        total += score
        if total > best:
            best, end = total, at + 2
        # Below every sum since the best one, no stretch that ends here is positive.
        if total <= 0 or total <= best - threshold:
            close()
            total = best = 0.0
            start = end = at + 1
    close()
    held = [(value[a:b].strip(SEPARATORS), a, b) for a, b in found]
    return [(a, b) for part, a, b in held if len(part) >= LEAST and len(set(part)) >= VARIETY and any(c.isalpha() for c in part)]


def read_samples(docs: DataFrame) -> tuple[DataFrame, np.ndarray]:
    """The documents without text but with spans and candidates; pair counts of the samples."""
    carried = [c for c in docs.columns if c not in (*RESULT, "text", "counts")]
    schema = T.StructType([
        *[docs.schema[c] for c in carried],
        *T._parse_datatype_string(
            "base array<struct<start:int,kind:int,stop:int>>, candidates array<struct<start:int,value:string>>, counts array<bigint>"
        ).fields,
    ])
    nullable = T.StructType([T.StructField(f.name, f.dataType) for f in schema.fields])
    read = stored(docs.select(*carried, "text").mapInArrow(_reader, nullable), "secret-spans")
    summed = (
        read.where("counts is not null").select(F.posexplode("counts")).where("col > 0").groupBy("pos").agg(F.sum("col").alias("n")).toPandas()
    )
    counts = np.zeros((1 + len(KIND_ALPHABETS)) * CLASSES**2)
    counts[summed["pos"].to_numpy(dtype=np.int64)] = summed["n"]
    return read.where("counts is null").drop("counts"), balanced(counts)


@own_names("doc_id", "text", result=RESULT[:5])
def find_secrets(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Each document, without its text, with counts by pattern, the digest of their spans, and all spans."""
    read, counts = read_samples(docs)
    carried = [c for c in read.columns if c not in ("base", "candidates")]
    ratio = log_ratio(counts)

    def decide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: dict[str, list] = {"n_assign": [], "n_access": [], "n_hex": [], "base_sha256": [], "spans": []}
            for base, near in zip(batch.column("base").to_pylist(), batch.column("candidates").to_pylist(), strict=True):
                spans = [(b["start"], b["kind"], b["stop"]) for b in base]
                for kind, name in enumerate(("n_assign", "n_access", "n_hex")):
                    out[name].append(sum(s[1] == kind for s in spans))
                out["base_sha256"].append(hashlib.sha256(joined(spans).encode()).hexdigest())
                for c in near:
                    spans += [(c["start"] + a, 3, c["start"] + b) for a, b in stretches(c["value"], ratio, threshold)]
                out["spans"].append(joined(spans))
            columns = [batch.column(c) for c in carried]
            yield pa.RecordBatch.from_arrays([*columns, *map(pa.array, out.values())], names=[*carried, *out])

    schema = T.StructType([
        *[read.schema[c] for c in carried],
        *T._parse_datatype_string("n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string, spans string").fields,
    ])
    return read.mapInArrow(decide, schema)
