"""Near-duplicate documents by min-max hashing.

Under each hash function of a family both the least and the greatest value over
a document's shingles are kept; either agrees between two documents with the
probability of their similarity, so half the hash evaluations give the same
signature. Bands of five values find candidates, which are confirmed on the
full shingle sets.

A pair at similarity 0.8 shares none of the 32 bands with a probability of
3e-6. No bucket is expanded into pairs:

1. Documents with equal shingle sets fall into one class first.
2. In each bucket every class is compared with the bucket's first class, and
   confirmed links are joined into components.
3. Only buckets that still hold several components go on. A few times, the
   members outside a bucket's largest component are compared with another
   member of that component; this takes work in proportion to the bucket. Taken
   is the member that was confirmed with the most centres so far: copies differ
   from each other by the changes of both, so those of few changes link nearly
   all of a group, where one taken at random leaves many out.
4. What is left is compared completely: members outside the largest component
   with all members of other components, each pair once.

A pair leaves a join, and is confirmed on the texts, only if its sketches allow
such similarity. One sketch has one bit of each signature value. The other has
the parity of the shingles that fall on each of its bits: two of these differ in
no more bits than the sets differ in shingles, so they rule out for certain, and
of the pairs just below the limit hardly any is left.

Defined results: words are runs without blanks, A-Z lower-cased; a document with
fewer words than a shingle has its whole sequence as the only shingle; one
without words (or with a null text) has an empty set and is linked with
nothing; rows of equal texts share a component, also if they share a doc_id;
rows without a doc_id count last when the smallest id is taken, and a component
of such rows only has a null id; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plantline.llm.common import own_names, row_key, stored

BANDS, ROWS = 32, 5
FUNCTIONS = BANDS * ROWS // 2
#: Longs that hold one bit of each value. Two texts at similarity 0.8 differ in a tenth of the bits, in 16 +- 3.8;
#: a pair that differs in more than ``FAR`` bits is that similar with a probability of 1e-7.
SKETCH, FAR = -(-BANDS * ROWS // 64), 38
#: Longs of parities.
ODD = 16
#: Hashes per step; bounds the memory that a long document takes.
STEP = 1 << 20

_MIX = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))
_BASE = 0x9E3779B97F4A7C15 | 1


def mixed(x: np.ndarray) -> np.ndarray:
    """Spreads 64-bit values; one to one."""
    x = (x ^ (x >> np.uint64(30))) * _MIX[0]
    x = (x ^ (x >> np.uint64(27))) * _MIX[1]
    return x ^ (x >> np.uint64(31))


_FACTORS = mixed(np.arange(1, FUNCTIONS + 1, dtype=np.uint64)) | np.uint64(1)
_BAND_SALTS = mixed(np.arange(1000, 1000 + BANDS, dtype=np.uint64))


def word_hashes(text: bytes) -> np.ndarray:
    """One 64-bit value per word of ``text``, in order."""
    raw = np.frombuffer(text, dtype=np.uint8)
    if raw.size == 0:
        return np.empty(0, dtype=np.uint64)
    raw = np.where((raw >= 65) & (raw <= 90), raw + 32, raw)
    inside = ~((raw == 32) | ((raw >= 9) & (raw <= 13)))
    turns = np.flatnonzero(np.diff(inside.astype(np.int8), prepend=0, append=0))
    starts, stops = turns[::2], turns[1::2]
    if starts.size == 0:
        return np.empty(0, dtype=np.uint64)
    # Polynomial of the bytes modulo 2^64 for all words at once, from running sums.
    place = np.arange(raw.size, dtype=np.uint64)
    powers = _power(_BASE, place)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * powers, dtype=np.uint64)])
    inverse = pow(_BASE, -1, 1 << 64)
    value = (sums[stops] - sums[starts]) * _power(inverse, starts.astype(np.uint64))
    return mixed(value + (stops - starts).astype(np.uint64) * np.uint64(_BASE))


_POWERS: dict[int, np.ndarray] = {}


def _power(base: int, exponents: np.ndarray) -> np.ndarray:
    """base ** exponents modulo 2^64, from two tables of 2^16 powers."""
    if base not in _POWERS:
        low = np.cumprod(np.full(1 << 16, base, np.uint64), dtype=np.uint64)
        step = pow(base, 1 << 16, 1 << 64)
        high = np.cumprod(np.full(1 << 16, step, np.uint64), dtype=np.uint64)
        one = np.ones(1, np.uint64)
        _POWERS[base] = np.stack([np.concatenate([one, low[:-1]]), np.concatenate([one, high[:-1]])])
    low, high = _POWERS[base]
    return low[exponents & np.uint64(0xFFFF)] * high[exponents >> np.uint64(16)]


def shingle_set(text: bytes, size: int) -> np.ndarray:
    """The distinct shingle hashes of a text, sorted."""
    words = word_hashes(text)
    if words.size == 0:
        return words
    if words.size < size:
        size = words.size
    value = np.full(words.size - size + 1, size, dtype=np.uint64)
    for k in range(size):
        value = mixed(value * np.uint64(_BASE) + words[k : words.size - size + 1 + k])
    return np.unique(value)


def parities(shingles: np.ndarray) -> np.ndarray:
    """How many shingles fall on each of 64 * ODD bits, modulo 2."""
    on = (mixed(shingles ^ _MIX[0]) % np.uint64(64 * ODD)).astype(np.int64)
    return np.frombuffer(np.packbits(np.bincount(on, minlength=64 * ODD) & 1).tobytes(), dtype=np.int64)


def band_keys(shingles: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The keys of the bands, half of them over least, half over greatest values, and both sketches."""
    low = np.full(FUNCTIONS, np.iinfo(np.uint64).max, dtype=np.uint64)
    high = np.zeros(FUNCTIONS, dtype=np.uint64)
    step = max(1, STEP // FUNCTIONS)
    for at in range(0, shingles.size, step):
        values = shingles[at : at + step, None] * _FACTORS[None, :]
        low = np.minimum(low, values.min(axis=0))
        high = np.maximum(high, values.max(axis=0))
    values = np.concatenate([low, high])
    bits = np.packbits(mixed(values ^ _MIX[1]) >> np.uint64(63) == 1)
    sketch = np.frombuffer(bits.tobytes().ljust(8 * SKETCH, b"\0"), dtype=np.int64)
    rows = values.reshape(BANDS, ROWS)
    keys = _BAND_SALTS.copy()
    for k in range(ROWS):
        keys = mixed(keys * np.uint64(_BASE) + rows[:, k])
    return keys.view(np.int64), np.concatenate([sketch, parities(shingles)])


def _signer(size: int):
    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, sets, bands, sketches = [], [], [], []
            for text in batch.column("text"):
                shingles = shingle_set((text.as_py() or "").encode("utf-8", "surrogatepass"), size)
                counts.append(shingles.size)
                sets.append(np.array([shingles.sum(dtype=np.uint64), mixed(shingles ^ _MIX[0]).sum(dtype=np.uint64)]).tobytes())
                keys, sketch = band_keys(shingles) if shingles.size else (np.empty(0, np.int64), np.empty(0, np.int64))
                bands.append(keys)
                sketches.append(sketch)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"), batch.column("row_key"), pa.array(counts, pa.int64()), pa.array(sets, pa.binary()),
                    pa.array(bands, pa.list_(pa.int64())), pa.array(sketches, pa.list_(pa.int64())),
                ],
                names=["doc_id", "row_key", "n_shingles", "set_key", "bands", "sketch"],
            )

    return sign


def word_shingles(text: bytes, size: int) -> set[tuple[bytes, ...]]:
    """The full set, of the words themselves."""
    words = text.lower().split()
    return set(zip(*[words[k:] for k in range(size)], strict=False)) if len(words) >= size else {tuple(words)} if words else set()


def _verifier(size: int, percent: int):
    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, full = None, set()
        for batch in batches:
            nodes, centers = [], []
            rows = zip(*(batch.column(c).to_pylist() for c in ("node", "center", "text", "center_text")), strict=True)
            for node, center, text, other in rows:
                if center != last:
                    last, full = center, word_shingles(other.encode("utf-8", "surrogatepass"), size)
                own = word_shingles(text.encode("utf-8", "surrogatepass"), size)
                both = len(own & full)
                if 100 * both >= percent * (len(own) + len(full) - both):
                    nodes.append(node)
                    centers.append(center)
            yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array(centers, pa.int64())], names=["a", "b"])

    return verify


def components(edges: DataFrame) -> DataFrame:
    """(node, comp) for every node of ``edges`` (a, b); comp is the least node that can be reached.

    Each round hooks components to their least neighbour, follows the hooks to
    their end and draws the edges together, so that at most half of the
    components that still have neighbours are left.
    """
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    labels = stored(both.select(F.col("a").alias("node")).distinct().select("node", F.col("node").alias("comp")), "near-labels")
    left = stored(both.where("a <> b").distinct(), "near-edges")
    while not left.isEmpty():
        hook = stored(left.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("to")), "near-hooks")
        while True:
            up = hook.select(F.col("a").alias("to"), F.col("to").alias("next"))
            jumped = stored(
                hook.join(up, "to", "left").select("a", F.coalesce("next", "to").alias("to"), (F.col("next") < F.col("to")).alias("moved")),
                "near-hooks",
            )
            hook = jumped.select("a", "to")
            if jumped.where("moved").isEmpty():
                break
        named = hook.select(F.col("a").alias("comp"), "to")
        labels = stored(labels.join(named, "comp", "left").select("node", F.coalesce("to", "comp").alias("comp")), "near-labels")
        left = stored(
            left.join(hook.select("a", F.col("to").alias("x")), "a")
            .join(hook.select(F.col("a").alias("b"), F.col("to").alias("y")), "b")
            .where("x <> y").select(F.col("x").alias("a"), F.col("y").alias("b")).distinct(),
            "near-edges",
        )
    return labels


def near_duplicates(docs: DataFrame, shingle: int = 5, percent: int = 80, rounds: int = 3) -> DataFrame:
    """One row per row of ``docs``: row_key, doc_id, n_shingles, comp (a number of the component), component_id and kept.

    ``percent`` is the least share of common shingles, 80 or more, as bands and sketches are set for that; ``rounds`` is
    how often step 3 is taken at most.
    """
    if percent < 80:
        raise ValueError("bands and sketches are set for similarities of 0.8 and more")
    signed = stored(
        docs.select("doc_id", "text", row_key().alias("row_key"))
        .mapInArrow(_signer(shingle), "doc_id bigint, row_key binary, n_shingles bigint, set_key binary, bands array<bigint>, sketch array<bigint>")
        .withColumn("row", F.monotonically_increasing_id()),
        "near-signed",
    )
    first = F.struct(F.col("doc_id").isNull(), "doc_id", "row")
    classes = stored(
        signed.where("n_shingles > 0")
        .groupBy("set_key", "n_shingles")
        .agg(F.min(first).alias("least"), F.min_by("bands", first).alias("bands"),
             F.min_by("sketch", first).alias("sketch"), F.min_by("row_key", first).alias("row_key"))
        .select("set_key", "n_shingles", F.col("least.row").alias("node"), F.col("least.doc_id").alias("doc_id"), "row_key", "bands", "sketch"),
        "near-classes",
    )
    spread = classes.select("node", F.explode("bands").alias("bucket"))
    full = spread.groupBy("bucket").agg(F.min("node").alias("center"), F.count(F.lit(1)).alias("n")).where("n > 1")
    members = stored(spread.join(full.select("bucket", "center"), "bucket"), "near-members")
    texts = stored(
        docs.select(row_key().alias("row_key"), "text")
        .join(members.select("node").distinct().join(classes.select("node", "row_key"), "node"), "row_key")
        .select("node", "text")
        .dropDuplicates(["node"]),
        "near-texts",
    )

    sketches = stored(members.select("node").distinct().join(classes.select("node", "sketch", F.col("n_shingles").alias("n")), "node"), "near-sketches")
    theirs = sketches.select(F.col("node").alias("center"), F.col("sketch").alias("other_sketch"), F.col("n").alias("other_n"))

    def apart(start: int, stop: int) -> Column:
        """Bits in which the longs ``start`` to ``stop`` of two sketches differ."""
        return sum(F.bit_count(F.get("sketch", F.lit(i)).bitwiseXOR(F.get("other_sketch", F.lit(i)))) for i in range(start, stop))

    # Sets of similarity s differ in (1 - s) / (1 + s) of the sum of their sizes.
    allowed = (100 - percent) * (F.col("n") + F.col("other_n"))
    near = (apart(0, SKETCH) <= FAR) & ((100 + percent) * apart(SKETCH, SKETCH + ODD) <= allowed)

    def close(pairs: DataFrame) -> DataFrame:
        """The pairs that may be as similar as asked, by their sketches."""
        return pairs.join(sketches, "node").join(theirs, "center").where(near).select("node", "center")

    def confirmed(pairs: DataFrame) -> DataFrame:
        return stored(
            pairs.join(texts, "node")
            .join(texts.select(F.col("node").alias("center"), F.col("text").alias("center_text")), "center")
            .mapInArrow(_verifier(shingle, percent), "a bigint, b bigint"),
            "near-links",
        )

    tried = stored(close(members.where("node <> center").select("node", "center").distinct()), "near-pairs")
    links = confirmed(tried)
    labels = components(links)
    taken = members.select(F.col("center").alias("node")).distinct()
    for turn in range(1, rounds + 2):
        # With how many centres a member was confirmed; those that were centres themselves come last.
        score = (
            links.select(F.col("a").alias("node"), F.lit(1).alias("score"))
            .unionByName(taken.select("node", F.lit(-(1 << 40)).alias("score")))
            .groupBy("node").agg(F.sum("score").alias("score"))
        )
        # Buckets of several components, with the size of each component in them.
        named = stored(
            members.select("bucket", "node").join(labels.join(score, "node", "left"), "node", "left")
            .select("bucket", "node", F.coalesce("comp", "node").alias("comp"), F.coalesce("score", F.lit(0)).alias("score")),
            "near-named",
        )
        sizes = named.groupBy("bucket", "comp").agg(
            F.count(F.lit(1)).alias("n"), F.max(F.struct("score", F.xxhash64("node", F.lit(turn)), "node")).alias("pick")
        )
        several = stored(
            sizes.groupBy("bucket")
            .agg(F.count(F.lit(1)).alias("comps"), F.max(F.struct("n", "comp", F.col("pick.node").alias("pick"))).alias("most"))
            .where("comps > 1")
            .select("bucket", F.col("most.comp").alias("main"), F.col("most.pick").alias("pick")),
            "near-several",
        )
        outside = named.join(several, "bucket").where("comp <> main")
        if turn <= rounds:
            taken = stored(taken.unionByName(several.select(F.col("pick").alias("node"))).distinct(), "near-taken")
            pairs = close(outside.select("node", F.col("pick").alias("center")).distinct())
        else:
            # A pair is met once: in the least bucket that its documents share, seen from outside the largest component.
            alive = stored(named.join(several.select("bucket", "main"), "bucket"), "near-alive")
            lists = alive.groupBy("node").agg(F.sort_array(F.collect_set("bucket")).alias("buckets"))
            held = alive.join(sketches.join(lists, "node"), "node")
            others = held.select(
                "bucket", F.col("node").alias("center"), F.col("comp").alias("other"),
                F.col("sketch").alias("other_sketch"), F.col("n").alias("other_n"), F.col("buckets").alias("other_buckets"),
            )
            once = F.get(F.array_intersect("buckets", "other_buckets"), F.lit(0)) == F.col("bucket")
            one_way = (F.col("other") == F.col("main")) | (F.col("node") > F.col("center"))
            pairs = (
                held.where("comp <> main")
                .join(others, "bucket")
                .where((F.col("comp") != F.col("other")) & one_way & near & once)
                .select("node", "center")
            )
        pairs = pairs.select(F.least("node", "center").alias("center"), F.greatest("node", "center").alias("node")).distinct()
        fresh = stored(pairs.select("node", "center").join(tried, ["node", "center"], "left_anti"), "near-pairs")
        if fresh.isEmpty():
            if turn <= rounds:
                continue
            break
        found = confirmed(fresh)
        tried = tried.unionByName(fresh)
        links = links.unionByName(found)
        labels = components(links)

    # The least doc_id of each component, then of each class, then of each row.
    of_class = classes.select("set_key", "n_shingles", "node", "doc_id").join(labels, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
    of_comp = of_class.groupBy("comp").agg(F.min("doc_id").alias("component_id"))
    named = stored(of_class.join(of_comp, "comp").select("set_key", "n_shingles", "comp", "component_id"), "near-named")
    empty = signed.where("n_shingles = 0").withColumns({"comp": F.col("row"), "component_id": F.col("doc_id")})
    linked = signed.where("n_shingles > 0").join(named, ["set_key", "n_shingles"])
    columns = ["row_key", "doc_id", "n_shingles", "comp", "component_id"]
    return linked.select(*columns).unionByName(empty.select(*columns)).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


@own_names("doc_id", "text")
def without_near_duplicates(docs: DataFrame, **settings) -> DataFrame:
    """``docs`` with one row of each component: of its least doc_id, and among rows of that id the least by checksum.

    Rows without words are linked with nothing and stay; of rows equal in id and text one stays.
    """
    first = F.struct(F.col("doc_id").isNull(), "doc_id", "row_key")
    group = F.when(F.col("n_shingles") == 0, F.col("row_key")).otherwise(F.col("comp").cast("string").cast("binary"))
    kept = (
        near_duplicates(docs, **settings).groupBy(group.alias("comp_key")).agg(F.min(first).alias("least"))
        .select(F.col("least.row_key").alias("row_key"))
    )
    return (
        docs.withColumn("row_key", row_key()).join(kept, "row_key", "left_semi").dropDuplicates(["row_key"]).select(*docs.columns)
    )
