"""Toxicity: gradient-boosted trees over dense features, with isotonic calibration.

The features of a text are densities of a lexicon, how near its hits stand to the
second person, capitals, punctuation, and obfuscation (letters replaced by digits
or signs, spaced out, or drawn out). The lexicon is a short list of common insults
and what the labels teach: words, and beginnings of words, that are much more
frequent in toxic than in other training texts. All terms are found in one pass
by an Aho-Corasick automaton, in the text as it is and in its obfuscated words as
they would be read.

Labels are read from training rows alone (``held_out`` rows are those whose
crc32 of the id, modulo 4, is 2). Of these, remainder 1 calibrates, and the
others teach the lexicon and the trees. At most ``SAMPLE`` labelled rows, those of
the least hashes, are used for that, and each distinct text once. Scoring is one
pass over the documents without a shuffle.

Defined results: a null text counts as empty and is scored like one; a row
without doc_id is not held out and has no label; labels are joined by doc_id, an
id is toxic if any of its rows says 1, and rows without a mark teach nothing;
equal texts are scored alike; if the training rows are not of both kinds, every
score is their share of toxic rows (0 without any); an empty table gives no rows;
other columns pass through, except for those that carry a name of the result.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plantline.llm.common import stored

#: Labelled rows that are learned from, at most, and terms of the lexicon, at most.
SAMPLE, TERMS = 40_000, 5_000
#: Score from which a document counts as toxic.
THRESHOLD = 0.3
TREES, DEPTH, SEED = 30, 3, 11
#: Lengths of the beginnings of words that may be terms; least toxic texts of a term; least bound of its log-odds.
BEGINNINGS, LEAST, ODDS = range(4, 8), 4, 1.0
#: Characters between a hit and a word of the second person that count as near, and characters scanned at once.
NEAR, STEP = 40, 1 << 20
RESULT = ("held_out", "score", "predicted")

# Common insults of four languages, and their words for "you".
INSULTS = (
    "idiot idiots idiotic stupid moron moronic loser losers pathetic worthless disgusting trash scum clown dumb imbecile fool "
    "jerk creep freak filthy vermin bastard bitch asshole shit crap fuck fucking retard whore slut "
    "dumm dumme dummkopf vollidiot arschloch scheisse scheiße abschaum wertlos widerlich trottel "
    "imbécile connard connasse salaud merde ordure stupide minable débile crétin "
    "idiota imbécil estúpido estúpida basura escoria patético inútil mierda cabrón payaso"
).split()
SECOND_PERSON = (
    "you your yours yourself u ur du dich dir dein deine deinen ihr euch euer tu te toi ton ta tes vous votre vos tú ti tuyo usted ustedes vosotros"
).split()

FEATURES = (
    "seed_density", "learned_density", "learned_weight", "learned_most", "log_hits", "near_second_person", "second_person_density",
    "capitals", "capital_words", "exclamations", "questions", "runs_of_signs", "other_signs", "replaced", "spaced_out", "drawn_out",
    "obfuscated_hits", "log_words",
)

_APART = re.compile(r"[\W\d_]+")
_WORD = re.compile(r"[^\W\d_]+")
_CAPITAL_WORD = re.compile(r"\b[A-ZÀ-ÖØ-Þ]{3,}\b")
_SIGN_RUN = re.compile(r"[!?]{2,}|[*#@$%&]{3,}")
_REPLACED = re.compile(r"(?<!\S)(?=\S*[^\W\d_])(?=\S*[0-9@$!*|+])[^\W_](?:[^\W_]|[@$!*|+]){2,24}(?!\S)")
_SPACED = re.compile(r"(?<!\w)(?:[^\W\d_][ .\-*_]){3,24}[^\W\d_](?!\w)")
_DRAWN = re.compile(r"([^\W\d_])\1{2,}")
_MASKS = [ord(c) for c in "!$*+@|"]
_READ_AS = str.maketrans("0134578@$!|+", "oieastbasiit")


def marked(text: str) -> str:
    """Lower-case words between blanks."""
    return f" {_APART.sub(' ', text.lower())} "


def terms_of(text: str) -> set[str]:
    """The words and beginnings of words of a text; a beginning has no blank behind it."""
    found = set()
    for word in set(_WORD.findall(text.lower())):
        found.add(f" {word} ")
        found.update(f" {word[:n]}" for n in BEGINNINGS if len(word) > n)
    return found


class Lexicon:
    """Terms with weights; ``hits`` finds them all in one pass."""

    def __init__(self, learned: dict[str, float]):
        import ahocorasick

        self.automaton = ahocorasick.Automaton()
        kinds: dict[str, tuple[bool, bool, float]] = {f" {w} ": (True, False, 0.0) for w in INSULTS}
        kinds |= {f" {w} ": (False, True, 0.0) for w in SECOND_PERSON}
        for term, weight in learned.items():
            seed, person, _ = kinds.get(term, (False, False, 0.0))
            kinds[term] = (seed, person, weight)
        for term, kind in kinds.items():
            self.automaton.add_word(term, kind)
        self.automaton.make_automaton()

    def hits(self, text: str) -> list[tuple[int, tuple[bool, bool, float]]]:
        return list(self.automaton.iter(text))


def _read(replaced: list[str], spaced: list[str], drawn: list[str]) -> str:
    """Obfuscated words as they would be read; a spaced-out word may have taken a lone letter beside it along."""
    found = [w.translate(_READ_AS) for w in replaced]
    for w in spaced:
        whole = _APART.sub("", w)
        found += whole, whole[1:], whole[:-1]
    return " ".join(found + [_DRAWN.sub(r"\1", w) for w in drawn] + [_DRAWN.sub(r"\1\1", w) for w in drawn])


def features(text: str, lexicon: Lexicon) -> list[float]:
    """The values named in ``FEATURES``."""
    seeds = people = 0
    weights: list[float] = []
    where: list[int] = []
    persons: list[int] = []
    replaced = spaced = drawn = capitals = capital_words = signs_run = letters = signs = hidden = words = 0
    exclamations = questions = 0
    for at in range(0, len(text), STEP):
        # A word at the edge of a piece is seen whole by the piece it ends in.
        start = at
        while start > max(0, at - 64) and start < len(text) and not text[start - 1].isspace():
            start -= 1
        part = text[start : at + STEP]
        plain = marked(part)
        words += len(plain.split())
        for end, (seed, person, weight) in lexicon.hits(plain):
            seeds += seed
            if person:
                people += 1
                persons.append(start + end)
            if seed or weight:
                weights.append(weight)
                where.append(start + end)
        raw = np.bincount(np.frombuffer(part.encode("utf-8", "surrogatepass"), dtype=np.uint8), minlength=256)
        upper, lower = int(raw[65:91].sum()), int(raw[97:123].sum())
        capitals += upper
        letters += upper + lower + int(raw[0xC3:0xE0].sum())
        exclamations += int(raw[33])
        questions += int(raw[63])
        signs += int(raw[33:48].sum() + raw[58:65].sum() + raw[91:97].sum() + raw[123:127].sum())
        capital_words += len(_CAPITAL_WORD.findall(part))
        signs_run += len(_SIGN_RUN.findall(part))
        masked = _REPLACED.findall(part) if raw[48:58].any() or raw[_MASKS].any() else []
        apart, long = _SPACED.findall(part), _DRAWN.findall(part)
        replaced, spaced, drawn = replaced + len(masked), spaced + len(apart), drawn + len(long)
        if masked or apart or long:
            stretched = [w for w in part.split() if _DRAWN.search(w)] if long else []
            found = [w for _, (seed, _, w) in lexicon.hits(marked(_read(masked, apart, stretched))) if seed or w]
            hidden += len(found)
            weights += found
    near = 0
    if where and persons:
        held = np.sort(np.array(persons))
        spots = np.array(where)
        right = np.searchsorted(held, spots)
        gap = np.minimum(
            np.abs(held[np.minimum(right, held.size - 1)] - spots), np.abs(held[np.maximum(right - 1, 0)] - spots)
        )
        near = int((gap <= NEAR).sum())
    n, m = max(words, 1), max(letters, 1)
    learned = [w for w in weights if w]
    return [
        1000 * seeds / n, 1000 * len(learned) / n, 1000 * sum(learned) / n, max(learned, default=0.0), float(np.log1p(len(weights))),
        1000 * near / n, 1000 * people / n, capitals / m, capital_words / n, 1000 * exclamations / n, 1000 * questions / n,
        1000 * signs_run / n, 1000 * signs / n, 1000 * replaced / n, 1000 * spaced / n, 1000 * drawn / n, float(hidden), float(np.log1p(words)),
    ]


# -- labels -------------------------------------------------------------------------------------------


def fold(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % 4


def training_rows(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """(text, toxic, calibrates): at most about ``sample`` labelled rows that are not held out, each text of a part once."""
    marks = (
        labels.where("doc_id is not null and toxic is not null").groupBy("doc_id").agg((F.max("toxic") > 0).cast("int").alias("toxic"))
        .withColumn("fold", fold(F.col("doc_id"))).where("fold <> 2")
    )
    marks = stored(marks, "toxic-marks")
    draw = F.pmod(F.xxhash64("doc_id", F.lit(SEED)), F.lit(1 << 30))
    limit = int((1 << 30) * min(1.0, sample / max(1, marks.count())))
    drawn = marks.where(draw < limit)
    # At most about ``sample`` ids and marks, so they go to the documents.
    rows = docs.where("doc_id is not null").select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(drawn), "doc_id")
    return stored(
        rows.groupBy(F.md5(F.col("text").cast("binary")).alias("t"), (F.col("fold") == 1).alias("calibrates"))
        .agg(F.max("toxic").alias("toxic"), F.min("text").alias("text")).select("text", "toxic", "calibrates"),
        "toxic-rows",
    )


def _terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """In how many texts of a task each term stands."""
    counts: Counter[str] = Counter()
    for batch in batches:
        for text in batch.column("text"):
            counts.update(terms_of(text.as_py()))
            if len(counts) > 1_000_000:
                yield pa.RecordBatch.from_arrays([pa.array(counts.keys()), pa.array(counts.values(), pa.int64())], ["term", "n"])
                counts.clear()
    yield pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], ["term", "n"])


def learned_terms(rows: DataFrame, terms: int = TERMS) -> dict[str, float]:
    """The terms that mark toxic texts, with the lower bound of their log-odds; the ``terms`` highest."""
    teaching = rows.where(~F.col("calibrates"))
    sizes = {r.toxic: r.n for r in teaching.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(sizes) < 2:
        return {}

    def counted(toxic: int) -> DataFrame:
        found = teaching.where(F.col("toxic") == toxic).select("text").mapInArrow(_terms, "term string, n bigint")
        return found.groupBy("term").agg(F.sum("n").alias("n"))

    bad = stored(counted(1).where(F.col("n") >= LEAST), "toxic-terms").withColumnRenamed("n", "bad")
    both = bad.join(counted(0), "term", "left").withColumn("good", F.coalesce("n", F.lit(0)))
    odds = F.log((F.col("bad") + 0.5) / (sizes[1] + 1)) - F.log((F.col("good") + 0.5) / (sizes[0] + 1))
    bound = odds - 2.0 * F.sqrt(1 / (F.col("bad") + 0.5) + 1 / (F.col("good") + 0.5))
    best = both.select("term", F.round(bound, 6).alias("weight")).where(F.col("weight") >= ODDS)
    return {r.term: r.weight for r in best.orderBy(F.desc("weight"), "term").limit(terms).collect()}


# -- model --------------------------------------------------------------------------------------------

_VALUES = T.StructField("values", T.ArrayType(T.DoubleType()))


def with_features(docs: DataFrame, learned: dict[str, float]) -> DataFrame:
    """``docs`` with ``values`` in place of ``text``."""
    carried = [f for f in docs.schema.fields if f.name != "text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon = Lexicon(learned)
        for batch in batches:
            values = [features(t.as_py() or "", lexicon) for t in batch.column("text")]
            columns = [*(batch.column(f.name) for f in carried), pa.array(values, pa.list_(pa.float64()))]
            yield pa.RecordBatch.from_arrays(columns, [*(f.name for f in carried), "values"])

    return docs.mapInArrow(run, T.StructType([*carried, _VALUES]))


def _margin(scored: DataFrame, trees) -> DataFrame:
    """``scored`` with ``margin``, the trees' sum, in thousandths."""
    raw = vector_to_array(F.col("rawPrediction"))
    return trees.transform(scored).withColumn("margin", F.round(F.get(raw, F.lit(1)), 3)).drop("rawPrediction", "probability", "prediction")


def score_toxicity(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` without their text, with held_out, score and predicted."""
    given = F.struct(*[c for c in docs.columns if c != "text" and c not in RESULT])
    rows = training_rows(docs, labels, sample)
    kinds = rows.groupBy("calibrates").agg(F.count(F.lit(1)).alias("n"), F.sum("toxic").alias("bad")).collect()
    n, bad = sum(k.n for k in kinds), sum(k.bad for k in kinds)
    teach = next((k for k in kinds if not k.calibrates), None)
    held_out = F.coalesce(fold(F.col("given.doc_id")) == 2, F.lit(False)).alias("held_out")
    if teach is None or teach.bad in (0, teach.n):
        score = F.lit(bad / n if n else 0.0)
        return docs.select(given.alias("given")).select("given.*", held_out, score.alias("score"), (score >= threshold).cast("int").alias("predicted"))
    learned = learned_terms(rows)
    known = stored(with_features(rows, learned), "toxic-features").withColumn("features", array_to_vector("values"))
    trees = GBTClassifier(
        featuresCol="features", labelCol="toxic", maxIter=TREES, maxDepth=DEPTH, seed=SEED, stepSize=0.2
    ).fit(known.where(~F.col("calibrates")))
    # Calibration on rows that the trees have not seen, if there are any of both kinds.
    calibrating = next((k for k in kinds if k.calibrates), None)
    apart = calibrating is not None and 0 < calibrating.bad < calibrating.n
    bins = (
        _margin(known.where("calibrates") if apart else known, trees)
        .groupBy("margin").agg(F.avg("toxic").alias("share"), F.count(F.lit(1)).cast("double").alias("weight"))
    )
    step = IsotonicRegression(featuresCol="margin", labelCol="share", weightCol="weight", predictionCol="score").fit(bins)
    fresh = docs.select(given.alias("given"), "text")
    scored = _margin(with_features(fresh, learned).withColumn("features", array_to_vector("values")), trees)
    result = step.transform(scored)
    score = F.least(F.greatest(F.col("score"), F.lit(0.0)), F.lit(1.0))
    return result.select("given.*", held_out, score.alias("score"), (score >= threshold).cast("int").alias("predicted"))
