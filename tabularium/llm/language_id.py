"""Language identification in two steps: the family first, then the language within it.

Features are counts of hashed character n-grams of lower-cased words, divided
by their total. A softmax over families decides first; within a family with
several languages, linear support vector machines decide between each two of
them, and the language with the most wins (of equal wins, the largest sum of
margins) is predicted. All models are linear in the counts, so a distinct word
is scored once per batch and a text's scores are sums over its words.

Fitting uses about ``per_language`` documents of each language and about
``FIT_ROWS`` in all, documented bounds; how often each language occurs is counted over all rows.

Results defined for odd input: a null text, and one without a letter, is
``und`` with score 0; rows with a null label or id don't train; without any
labelled row everything is ``und``; repeated rows give repeated result rows;
other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabularium.llm.common import char_ngrams, ragged_take, segment_sums, split_words, text_slices, texts_of

ORDERS = range(1, 5)
BUCKETS = 4096
PER_LANGUAGE = 400
#: Rows of all languages together; each row is 16 KB on the driver.
FIT_ROWS = 12_000
#: ISO 639-1 codes by language family. A code that isn't listed is a family of its own.
FAMILIES = {
    "germanic": "en de nl sv da no nb nn is af fy lb yi",
    "romance": "fr es it pt ro ca gl oc la",
    "slavic": "ru uk be pl cs sk sl hr sr bs bg mk",
    "baltic": "lt lv",
    "uralic": "fi et hu",
    "indic": "hi bn ur pa mr ne gu",
    "turkic": "tr az kk uz ky tk",
    "semitic": "ar he mt",
    "celtic": "ga gd cy br",
    "sinitic": "zh",
}
UNDETERMINED = "und"


def family_of(language: str) -> str:
    code = language.lower().split("-")[0].split("_")[0]
    return next((family for family, codes in FAMILIES.items() if code in codes.split()), code)


@dataclass
class Model:
    """Columns of ``weights``: one per family, then one per pair (positive: the first of the pair)."""

    families: list[str]
    members: list[list[int]]
    pairs: list[tuple[int, int]]
    languages: list[str]
    weights: np.ndarray
    bias: np.ndarray


def _buckets(types: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    for _, owner, hashed in char_ngrams(pc.utf8_lower(types), ORDERS):
        yield owner, (hashed % np.uint64(BUCKETS)).astype(np.int64)


def counts(texts: pa.Array) -> np.ndarray:
    """One row of n-gram counts per text, divided by their total."""
    words = split_words(texts)
    out = np.zeros((len(texts), BUCKETS), dtype=np.float32)
    for owner, bucket in _buckets(words.types):
        starts = np.searchsorted(owner, np.arange(len(words.types) + 1))
        for i in range(len(texts)):
            own, _ = ragged_take(bucket, starts, words.codes[words.starts[i] : words.starts[i + 1]])
            out[i] += np.bincount(own, minlength=BUCKETS)
    return out / np.maximum(out.sum(axis=1, keepdims=True), 1)


def _descend(x: np.ndarray, gradient, width: int, ridge: float, steps: int = 200) -> np.ndarray:
    """Accelerated gradient descent of a smooth convex loss over ``x`` (with a constant column) and a ridge."""
    v = np.ones(x.shape[1])
    for _ in range(20):  # the largest curvature, by power iteration
        v = x.T @ (x @ (v / np.linalg.norm(v))) / len(x)
    top = 1.2 * np.linalg.norm(v)
    rate = 1 / (2 * top + ridge)
    w = ahead = np.zeros((x.shape[1], width))
    for k in range(steps):
        new = ahead - rate * (x.T @ gradient(x @ ahead) / len(x) + ridge * ahead)
        ahead = new + k / (k + 3) * (new - w)
        w = new
    return w


def softmax(z: np.ndarray) -> np.ndarray:
    z = np.exp(z - z.max(axis=1, keepdims=True))
    return z / z.sum(axis=1, keepdims=True)


def fit(features: np.ndarray, labels: list[str], ridge: float = 1e-3) -> Model:
    languages = sorted(set(labels))
    y = np.array([languages.index(x) for x in labels])
    families = sorted({family_of(x) for x in languages})
    members = [[i for i, x in enumerate(languages) if family_of(x) == f] for f in families]
    group = np.array([families.index(family_of(x)) for x in languages])
    mean, scale = features.mean(axis=0), features.std(axis=0) + 1e-4
    x = np.concatenate([(features - mean) / scale / np.sqrt(BUCKETS), np.ones((len(features), 1))], axis=1, dtype=np.float32)
    target = np.eye(len(families))[group[y]]
    columns = [_descend(x, lambda z: softmax(z) - target, len(families), ridge)]
    pairs = [p for m in members for p in combinations(m, 2)]
    for a, b in pairs:
        own = (y == a) | (y == b)
        side = np.where(y[own] == a, 1.0, -1.0)[:, None]
        # Squared hinge loss: a support vector machine with a smooth optimum.
        columns.append(_descend(x[own], lambda z, side=side: -2 * side * np.maximum(0, 1 - side * z), 1, ridge))
    w = np.concatenate(columns, axis=1)
    raw = w[:-1] / scale[:, None] / np.sqrt(BUCKETS)
    return Model(families, members, pairs, languages, raw.astype(np.float32), w[-1] - mean @ raw)


def decide(scores: np.ndarray, model: Model) -> tuple[np.ndarray, np.ndarray]:
    """Language number and score of each row of linear scores."""
    sure = softmax(scores[:, : len(model.families)])
    best = sure.argmax(axis=1)
    language, value = np.zeros(len(scores), dtype=np.int64), sure[np.arange(len(scores)), best]
    for f, members in enumerate(model.members):
        rows = np.flatnonzero(best == f)
        wins = np.zeros((len(rows), len(members)))
        margins, chance = np.zeros_like(wins), np.zeros_like(wins)
        for k, (a, b) in enumerate(model.pairs):
            if a not in members:
                continue
            i, j, z = members.index(a), members.index(b), scores[rows, len(model.families) + k]
            wins[:, i] += z >= 0
            wins[:, j] += z < 0
            margins[:, i] += z
            margins[:, j] -= z
            p = 1 / (1 + np.exp(np.clip(-3 * z, -50, 50)))
            chance[:, i] += p
            chance[:, j] += 1 - p
        order = np.lexsort((margins, wins), axis=1) if len(rows) else np.zeros((0, len(members)), dtype=int)
        winner = order[:, -1] if len(rows) else np.zeros(0, dtype=int)
        language[rows] = np.array(members)[winner]
        if len(members) > 1:
            value[rows] *= chance[np.arange(len(rows)), winner] / (len(members) - 1)
    return language, np.clip(value, 0, 1)


def linear_scores(texts: pa.Array, model: Model) -> np.ndarray:
    words = split_words(texts)
    n = len(words.types)
    total, per_type = np.zeros(n), np.zeros((n, model.weights.shape[1]))
    for owner, bucket in _buckets(words.types):
        total += np.bincount(owner, minlength=n)
        for k in range(per_type.shape[1]):
            per_type[:, k] += np.bincount(owner, weights=model.weights[bucket, k], minlength=n)
    sums = segment_sums(per_type[words.codes], words.starts)
    size = segment_sums(total[words.codes], words.starts)
    return sums / np.maximum(size, 1)[:, None] + model.bias


def learn(spark: SparkSession, docs: DataFrame, train, id_col: str = "doc_id", text_col: str = "text", label_col: str = "lang", per_language: int = PER_LANGUAGE) -> Model | None:
    """Fit on about ``per_language`` rows of each label among the rows where ``train`` holds."""
    rows = docs.where(train & F.col(label_col).isNotNull() & F.col(text_col).isNotNull() & F.col(id_col).isNotNull())
    sizes = {r[0]: r[1] for r in rows.groupBy(label_col).count().collect()}  # one row per language
    if not sizes:
        return None
    each = min(per_language, max(1, FIT_ROWS // len(sizes)))
    pairs = (F.lit(x) for name, size in sorted(sizes.items()) for x in (name, int(min(1.0, each / size) * (1 << 30))))
    part = rows.where(F.pmod(F.xxhash64(F.lit("sample"), id_col), F.lit(1 << 30)) < F.create_map(*pairs)[F.col(label_col)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in text_slices(batches):
            rows_ = [np.ascontiguousarray(r).tobytes() for r in counts(texts_of(b))]
            yield pa.RecordBatch.from_arrays([b.column("label"), pa.array(rows_, pa.binary())], names=["label", "x"])

    got: pd.DataFrame = part.select(F.col(label_col).alias("label"), F.col(text_col).alias("text")).mapInArrow(run, "label string, x binary").toPandas()
    if got.empty:
        return None
    return fit(np.stack([np.frombuffer(x, dtype=np.float32) for x in got["x"]]), got["label"].tolist())


def predict(docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id_col, lang_pred, score)`` for every row, by its text alone."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_slices(batches):
            texts = texts_of(part)
            letters = pc.match_substring_regex(texts, r"\p{L}").to_numpy(zero_copy_only=False)
            names, value = np.full(part.num_rows, UNDETERMINED, dtype=object), np.zeros(part.num_rows)
            if model is not None and letters.any():
                language, score = decide(linear_scores(texts.filter(pa.array(letters)), model), model)
                names[letters] = np.array(model.languages, dtype=object)[language]
                value[letters] = score
            yield pa.RecordBatch.from_arrays([part.column("id"), pa.array(names, pa.string()), pa.array(value)], names=[id_col, "lang_pred", "score"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(run, f"{id_col} {kind}, lang_pred string, score double")
