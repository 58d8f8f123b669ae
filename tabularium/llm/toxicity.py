"""Toxicity of texts: boosted trees over dense features, calibrated by isotonic regression.

The features of a text are densities and rates, so its length doesn't matter
by itself:

* weighted and plain density of lexicon entries, and the largest weight met;
* the share of entries within a few words of a second-person pronoun, and the
  density of those pronouns;
* shares of capitals, of words in capitals, of exclamation and other
  punctuation;
* rates of obfuscated words (digits or symbols between letters) and of letters
  repeated three times or more;
* the logarithm of the number of words.

The lexicon is learned from labelled texts: of all words and of all word stems
of four to six letters (after undoing obfuscation), those whose share of toxic
texts is far above the base rate. Its weights are smoothed log ratios of
document frequencies, counted by Spark.

The labelled rows fall into three parts that share no row (``PARTS``): the
lexicon is learned on the first, Spark's gradient-boosted trees are fitted on
the second, and isotonic regression on the third turns their output into
probabilities. All of them together use about ``fit_rows`` labelled rows, a
documented bound; scoring covers all rows and whole texts.

Results defined for odd input: null and empty texts get the features of an
empty text and so a score like any other; rows with a null id or label, or
without a document, don't train; a document labelled twice counts twice; if the
trees' part or the curve's part lacks toxic or clean labels, every score is the
base rate; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabularium.llm.common import Scratch, array_slices, bound_batches, codepoints, sampled, segment_sums, split_words, text_slices, texts_of

FIT_ROWS = 20_000
#: Of five parts of the labelled rows, by a hash of the id: those of the lexicon, of the trees and of the isotonic curve.
PARTS = {"lexicon": (0, 1), "trees": (2, 3), "curve": (4,)}
STEMS = (4, 5, 6)
#: Entries must be in so many toxic texts of the sample, and in toxic texts by so large a factor more often.
LEAST_TEXTS, LEAST_RATIO = 4, 4.0
#: The largest lexicon: entries with the largest weights.
LEXICON_SIZE = 5000
#: Words on both sides within which a pronoun counts as near.
NEAR = 5
#: Second-person pronouns in English, French, German and Spanish.
PRONOUNS = "you your yours yourself yourselves u ur tu te toi ton ta tes vous votre vos du dich dir dein deine ihr euch euer sie tú ti tuyo usted ustedes vosotros vuestro"
#: Characters that stand for letters in obfuscated words.
LEET_FROM, LEET_TO = "013457@$!", "oieastasi"
FEATURES = [
    "weighted_density", "entry_density", "largest_weight", "near_person", "person_density", "capital_share",
    "shouted_words", "exclamations", "punctuation", "obfuscated", "stretched", "log_words",
]


def normal_forms(types: pa.Array) -> tuple[pa.Array, pa.Array]:
    """Of words: lower case without punctuation at the ends, and the same with obfuscation undone."""
    plain = pc.replace_substring_regex(pc.utf8_lower(types), r"^[^\pL\pN]+|[^\pL\pN]+$", "")
    clear = pc.utf8_lower(types)
    for a, b in zip(LEET_FROM, LEET_TO, strict=True):
        clear = pc.replace_substring(clear, a, b)
    # A word without any letter stays what it is: digits alone are numbers.
    clear = pc.replace_substring_regex(clear, r"[^\pL]+", "")
    letters = pc.match_substring_regex(types, r"\pL")
    return plain, pc.if_else(letters, clear, plain)


def entries_of(clear: pa.Array) -> list[pa.Array]:
    """For each word its lexicon keys: the word itself, and its stems ending in ``*`` (null where it is too short)."""
    size = pc.utf8_length(clear)
    whole = pc.if_else(pc.greater(size, 1), clear, pa.scalar(None, pa.string()))
    stems = [
        pc.if_else(pc.greater_equal(size, k), pc.binary_join_element_wise(pc.utf8_slice_codeunits(clear, 0, k), "*", ""), pa.scalar(None, pa.string()))
        for k in STEMS
    ]
    return [whole, *stems]


def keys_per_text(docs: DataFrame) -> DataFrame:
    """``(toxic, key)``: every text's lexicon keys, once each. ``docs`` has text and toxic."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_slices(batches):
            words = split_words(texts_of(part))
            _, clear = normal_forms(words.types)
            for keys in entries_of(clear):
                coded = keys.dictionary_encode()
                code = pc.fill_null(coded.indices, -1).to_numpy(zero_copy_only=False).astype(np.int64)[words.codes]
                both = np.unique(words.text_of_word[code >= 0] * (1 << 32) + code[code >= 0])
                label = part.column("toxic").take(pa.array(both >> 32))
                yield pa.RecordBatch.from_arrays([label.cast("int32"), coded.dictionary.take(pa.array(both & 0xFFFFFFFF))], names=["toxic", "key"])

    return docs.select("text", "toxic").mapInArrow(run, "toxic int, key string")


def learn_lexicon(docs: DataFrame) -> dict[str, float]:
    """Weights of at most ``LEXICON_SIZE`` keys that mark toxic texts."""
    n = docs.agg(F.count_if(F.col("toxic") == 1).alias("t"), F.count_if(F.col("toxic") == 0).alias("c")).first()
    if not n["t"] or not n["c"]:
        return {}
    seen = keys_per_text(docs).groupBy("key").agg(F.count_if(F.col("toxic") == 1).alias("t"), F.count_if(F.col("toxic") == 0).alias("c"))
    ratio = ((F.col("t") + 0.1) / n["t"]) / ((F.col("c") + 0.5) / n["c"])
    top = seen.where((F.col("t") >= LEAST_TEXTS) & (ratio >= LEAST_RATIO)).select("key", F.log(ratio).alias("w"), (F.log(ratio) * F.col("t")).alias("gain"))
    return {r["key"]: r["w"] for r in top.orderBy(F.desc("gain"), "key").limit(LEXICON_SIZE).collect()}


def text_features(texts: pa.Array, lexicon: dict[str, float]) -> np.ndarray:
    """One row of ``FEATURES`` per text."""
    words = split_words(texts)
    types, codes, starts = words.types, words.codes, words.starts
    n = np.maximum(np.diff(starts), 1)
    plain, clear = normal_forms(types)
    names, weights = pa.array(list(lexicon), pa.string()), np.array([*lexicon.values(), 0.0])
    weight = np.zeros(len(types))
    for keys in entries_of(clear):
        at = pc.fill_null(pc.index_in(keys, value_set=names), len(lexicon)) if len(lexicon) else np.zeros(len(types), dtype=int)
        weight = np.maximum(weight, weights[np.asarray(at)])
    person = pc.is_in(plain, value_set=pa.array(PRONOUNS.split())).to_numpy(zero_copy_only=False)
    match = lambda pattern: pc.match_substring_regex(types, pattern).to_numpy(zero_copy_only=False)
    obfuscated = match(r"\pL[0-9@$!*]+\pL")
    shouted = match(r"^\P{Ll}*\p{Lu}\P{Ll}*\p{Lu}\P{Ll}*$")
    lowered = pc.utf8_lower(types)
    stretched = np.zeros(len(types), dtype=bool)
    if len(types):
        points, at = codepoints(lowered)
        if len(points) > 2:
            owner = np.repeat(np.arange(len(types)), np.diff(at))
            triple = (points[2:] == points[1:-1]) & (points[1:-1] == points[:-2]) & (owner[2:] == owner[:-2]) & (points[2:] > 64)
            stretched[owner[2:][triple]] = True
    count = lambda pattern: pc.count_substring_regex(texts, pattern).to_numpy(zero_copy_only=False).astype(np.float64)
    letters, capitals = count(r"\pL"), count(r"\p{Lu}")
    sums = lambda per_type: segment_sums(per_type[codes].astype(np.float64), starts)
    hit = weight > 0
    largest = np.zeros(len(texts))
    owner = words.text_of_word
    np.maximum.at(largest, owner, weight[codes])
    # An entry is near a pronoun if one stands within NEAR words in the same text.
    where = np.flatnonzero(person[codes])
    near = np.zeros(len(texts))
    mine = np.flatnonzero(hit[codes])
    if len(where) and len(mine):
        after = np.minimum(np.searchsorted(where, mine), len(where) - 1)
        before = np.maximum(np.searchsorted(where, mine, side="right") - 1, 0)
        close = [(np.abs(where[side] - mine) <= NEAR) & (owner[where[side]] == owner[mine]) for side in (after, before)]
        near = np.bincount(owner[mine[close[0] | close[1]]], minlength=len(texts))
    return np.stack(
        [
            sums(weight) / n, sums(hit) / n, largest, near / n, sums(person) / n, capitals / np.maximum(letters, 1),
            sums(shouted) / n, count("!") / n, count(r"[^\pL\pN\s]") / n, sums(obfuscated) / n, sums(stretched) / n, np.log1p(np.diff(starts)),
        ],
        axis=1,
    )


def features(docs: DataFrame, lexicon: dict[str, float], keep: list[str], text_col: str = "text") -> DataFrame:
    """``row``, a struct of ``keep``, and one double column per feature, for every row. Only the text goes through Python."""

    @F.arrow_udf(T.StructType([T.StructField(c, T.DoubleType()) for c in FEATURES]))
    def of_texts(texts: pa.Array) -> pa.Array:
        parts = [text_features(part, lexicon) for part in array_slices(texts)]
        x = np.concatenate([np.zeros((0, len(FEATURES))), *parts])
        return pa.StructArray.from_arrays([pa.array(np.ascontiguousarray(x[:, k])) for k in range(len(FEATURES))], names=FEATURES)

    bound_batches(docs.sparkSession)
    made = docs.select(F.struct(*keep).alias("row"), of_texts.asNondeterministic()(F.col(text_col)).alias("features"))
    return made.select("row", "features.*")


def part_of(name: str, id_col: str = "id") -> Column:
    """Whether a labelled row belongs to the part ``name`` of ``PARTS``."""
    return F.pmod(F.xxhash64(F.lit("fold"), id_col), F.lit(5)).isin(*PARTS[name])


@dataclass
class Model:
    lexicon: dict[str, float]
    trees: GBTClassificationModel | None
    #: Rising pairs of raw score and probability, linear in between.
    steps: list[tuple[float, float]]
    base: float


def _raw(rows: DataFrame, trees: GBTClassificationModel) -> DataFrame:
    """``rows`` with ``raw``: the trees' own probability."""
    out = trees.transform(VectorAssembler(inputCols=FEATURES, outputCol="features").transform(rows))
    return out.withColumn("raw", vector_to_array("probability")[1])


def learn(
    spark: SparkSession,
    docs: DataFrame,
    labels: DataFrame,
    train=None,
    id_col: str = "doc_id",
    text_col: str = "text",
    fit_rows: int = FIT_ROWS,
    trees: int = 20,
) -> Model:
    """Fit on about ``fit_rows`` of the labelled rows where ``train`` (a condition on the id) holds."""
    marks = labels.select(F.col(id_col).alias("id"), F.col("toxic").cast("int").alias("toxic")).where(F.col("id").isNotNull() & F.col("toxic").isin(0, 1))
    if train is not None:
        marks = marks.where(train(F.col("id")))
    total = marks.count()
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    scratch = Scratch(spark, "toxicity")
    rows = scratch.write(sampled(texts, "id", fit_rows, total).join(sampled(marks, "id", fit_rows, total), "id").select("id", "text", "toxic"), "rows")
    lexicon = learn_lexicon(rows.where(part_of("lexicon")))
    seen = scratch.write(features(rows.where(~part_of("lexicon")), lexicon, ["id", "toxic"]).select("row.*", *FEATURES), "features")
    sizes = {r["toxic"]: r["count"] for r in rows.groupBy("toxic").count().collect()}
    base = sizes.get(1, 0) / max(1, sum(sizes.values()))
    if seen.select("toxic", part_of("trees")).distinct().count() < 4:
        return Model(lexicon, None, [], base)
    fitted = fit_trees(seen.where(part_of("trees")), trees)
    model = Model(lexicon, fitted, fit_curve(_raw(seen.where(part_of("curve")), fitted)), base)
    scratch.drop("rows", "features")
    return model


def fit_trees(rows: DataFrame, trees: int) -> GBTClassificationModel:
    boosted = GBTClassifier(labelCol="toxic", maxIter=trees, maxDepth=3, stepSize=0.2, seed=1, minInstancesPerNode=5)
    return boosted.fit(VectorAssembler(inputCols=FEATURES, outputCol="features").transform(rows))


def fit_curve(rows: DataFrame) -> list[tuple[float, float]]:
    """The corners of the isotonic curve from ``raw`` to the share of toxic rows."""
    curve = IsotonicRegression(featuresCol="raw", labelCol="label").fit(rows.select("raw", F.col("toxic").cast("double").alias("label")))
    return list(zip(curve.boundaries.toArray().tolist(), curve.predictions.toArray().tolist(), strict=True))


def _calibrated(raw, steps: list[tuple[float, float]]):
    """Linear between the isotonic curve's corners, constant beyond them. A trace of the raw score keeps the order among ties."""
    slopes = [(y1 - y0) / (x1 - x0) if x1 > x0 else 0.0 for (x0, y0), (x1, y1) in zip(steps, steps[1:], strict=False)]
    corners = F.array(*(F.struct(F.lit(x).alias("x"), F.lit(y).alias("y"), F.lit(d).alias("slope")) for (x, y), d in zip(steps, [*slopes, 0.0], strict=True)))
    # A list, not one condition in another for each corner: a curve may have thousands.
    below = F.try_element_at(F.filter(corners, lambda c: c["x"] <= raw), F.lit(-1))
    inner = F.transform(F.array(below), lambda c: c["y"] + (raw - c["x"]) * c["slope"])[0]
    return F.coalesce(inner, F.lit(steps[0][1])) * 0.999 + raw * 0.001


def score(docs: DataFrame, model: Model, keep: tuple[str, ...] = ("doc_id",), text_col: str = "text") -> DataFrame:
    """``(*keep, score, predicted)`` for every row, by its text alone; ``predicted`` is 1 from a score of 0.5."""
    verdict = lambda p: [p.alias("score"), F.when(p >= 0.5, 1).otherwise(0).cast("int").alias("predicted")]
    if model.trees is None:
        return docs.select(*keep, *verdict(F.lit(float(model.base))))
    rows = _raw(features(docs, model.lexicon, list(keep), text_col), model.trees)
    return rows.select("row", _calibrated(F.col("raw"), model.steps).alias("score")).select("row.*", *verdict(F.col("score")))
