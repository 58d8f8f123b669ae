"""Quality rules: base statistics of a text, and n-gram perplexity bands per language.

The language model is a modified Kneser-Ney model of characters, of order
five, over the whole running text: words are joined by one blank, and n-grams
run across it, so the order of words counts. Spark counts the n-grams of all
rows: a task adds up those of its texts, Spark those of the tasks. Orders below
the highest count in how many different contexts an n-gram occurs, again in
Spark, and each order has its own three discounts from its counts of counts.
Interpolated probabilities of the n-grams seen and the back-off weights of the
contexts seen are written as arrays sorted by a 64-bit hash, range-partitioned
into shards in the shared folder. Scoring looks distinct n-grams up by binary
search. While the whole model fits into ``SHARDS_KEPT`` bytes a task does so for
each slice of its texts; a larger model is read once per task, shard after
shard, for all n-grams of the task's texts, which wait in a temporary file
meanwhile.

Characters are chosen over words because of the corpus-wide count: at word
level nearly every n-gram of long-tailed text is a row of its own, and both
counting and scoring would have to move more bytes than the corpus has.

A text's log perplexity is the mean negative log probability of its
characters and blanks. The bands are learned per language from all texts
that pass the base rules, copies once: quartiles of log perplexity, widened by ``BAND``
times their distance, and widened further for short texts, whose mean varies
more. Texts beyond the lower or the upper end are rejected.

Results defined for odd input: a null text has no words and fails the base
rules; texts of languages with fewer than ``LEAST_TEXTS`` texts, and those
whose language is null, are held to the band of all texts together; repeated
rows count each and give repeated result rows; null ids stay null; without any
text that passes the base rules there is no band; other columns are ignored.
"""

from __future__ import annotations

import tempfile
from collections import OrderedDict
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from tabularium.llm.common import Scratch, Words, array_slices, bound_batches, codepoints, mix64, ragged_take, release, segment_sums, split_words, text_slices, texts_of

ORDER = 5
#: How far beyond the quartiles a band reaches, in distances between them.
BAND = 2.0
#: A text of so many characters has a band twice as far from the median as a very long one.
SHORT_CHARS = 50
LEAST_TEXTS = 50
WINDOW = 8
SYMBOLS = r"[#*$%&|<>]"
#: Entries of a model shard, and the bytes of shards that a Python worker keeps.
SHARD_ENTRIES = 2_000_000
SHARDS_KEPT = 96 << 20


# --- base statistics ---


def _repeated_words(words: Words) -> np.ndarray:
    """For each text, the words that lie in a window of ``WINDOW`` words found twice or more in it."""
    n = len(words.codes) - WINDOW + 1
    texts = len(words.starts) - 1
    if n <= 0:
        return np.zeros(texts, dtype=np.int64)
    owner = words.text_of_word
    mixed = mix64(words.codes.astype(np.uint64) + np.uint64(1))
    key = mix64(owner[:n].astype(np.uint64) + np.uint64(1))
    with np.errstate(over="ignore"):
        for k in range(WINDOW):
            key = key * np.uint64(0x9E3779B97F4A7C15) + mixed[k : k + n]
    inside = np.flatnonzero(owner[:n] == owner[WINDOW - 1 :])
    order = inside[np.argsort(key[inside], kind="stable")]
    same = key[order][1:] == key[order][:-1]
    twice = order[np.concatenate([same, [False]]) | np.concatenate([[False], same])] if len(order) else order
    cover = np.zeros(len(words.codes) + 1, dtype=np.int64)
    np.add.at(cover, twice, 1)
    np.add.at(cover, twice + WINDOW, -1)
    return segment_sums((np.cumsum(cover[:-1]) > 0).astype(np.int64), words.starts).astype(np.int64)


def _repeated_lines(texts: pa.Array) -> np.ndarray:
    """For each text, the lines with a word that equal an earlier line."""
    lines = pc.split_pattern(texts, "\n")
    owner = pc.list_parent_indices(lines).to_numpy(zero_copy_only=False)
    flat = lines.flatten()
    full = pc.match_substring_regex(flat, r"[^\x20\x09-\x0D]").to_numpy(zero_copy_only=False)
    code = flat.dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)
    first = np.unique((owner[full].astype(np.int64) << 32) | code[full]) >> 32
    return np.bincount(owner[full], minlength=len(texts)) - np.bincount(first, minlength=len(texts))


def base_columns(texts: pa.Array, words: Words) -> dict[str, np.ndarray]:
    n_words = np.diff(words.starts)
    width = pc.utf8_length(words.types).to_numpy(zero_copy_only=False).astype(np.int64)
    repeated = _repeated_words(words)
    return {
        "n_words": n_words,
        "word_chars": segment_sums(width[words.codes], words.starts).astype(np.int64),
        "n_symbols": pc.count_substring_regex(texts, SYMBOLS).to_numpy(zero_copy_only=False).astype(np.int64),
        "n_dup_lines": _repeated_lines(texts).astype(np.int64),
        "n_repeat_words": repeated,
        "base_failed": (n_words < 20) | (100 * repeated > 30 * n_words),
    }


# --- the model ---


#: Characters that are worked on at once.
CHARS_AT_ONCE = 1 << 20
#: Different n-grams of a slice that are held before equal ones are put together.
GRAMS_HELD = 600_000


@dataclass
class Windows:
    """N-grams of the highest order of some texts: of each its key, and of the different ones (``code`` numbers them) an example."""

    keys: np.ndarray
    examples: np.ndarray
    code: np.ndarray


def running_text(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all texts one after another, a blank after each word and ``ORDER - 1`` before each text, and where each text starts."""
    blanks = pa.array([" " * (ORDER - 1)], pa.string())
    types = pa.concat_arrays([pc.binary_join_element_wise(words.types, " ", "").cast(pa.string()), blanks])
    points, at = codepoints(types)
    codes = np.insert(words.codes.astype(np.int64), words.starts[:-1], len(words.types))
    flat, lengths = ragged_take(points, at, codes)
    ends = np.concatenate([[0], np.cumsum(lengths)])
    return flat, ends[words.starts + np.arange(len(words.starts))]


def _hash(grams: np.ndarray) -> np.ndarray:
    """A hash of each row of code points."""
    return _mixed(grams[:, 0].astype(np.uint64), [grams[:, k] for k in range(1, grams.shape[1])])


def _mixed(out: np.ndarray, rest: list[np.ndarray]) -> np.ndarray:
    for points in rest:
        out *= np.uint64(0x9E3779B97F4A7C15)
        out += points
    out ^= np.uint64(len(rest) + 1) << np.uint64(60)
    return mix64(out)


def windows(text: np.ndarray) -> Iterator[tuple[int, Windows]]:
    """All windows of ``ORDER`` code points, some at a time, each time with the place of the first one."""
    for a in range(0, len(text) - ORDER + 1, CHARS_AT_ONCE):
        part = text[a : a + CHARS_AT_ONCE + ORDER - 1]
        n = len(part) - ORDER + 1
        coded = pa.array(_mixed(part[:n].astype(np.uint64), [part[k : k + n] for k in range(1, ORDER)])).dictionary_encode()
        code = coded.indices.to_numpy(zero_copy_only=False)
        first = np.zeros(len(coded.dictionary), dtype=np.int64)
        first[code] = np.arange(n)
        yield a, Windows(coded.dictionary.to_numpy(zero_copy_only=False), part[first[:, None] + np.arange(ORDER)], code)


def _inside(starts: np.ndarray, a: int, n: int) -> np.ndarray:
    """Of the ``n`` windows from place ``a`` on, those that lie within one text and predict one of its characters."""
    good = np.ones(n + ORDER, dtype=bool)
    # A window is outside if its last character is one of the blanks before a text.
    for k in range(ORDER - 1):
        at = starts[:-1] + k - (ORDER - 1) - a
        good[at[(at >= 0) & (at < n)]] = False
    return good[:n]


def count_ngrams(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``(gram, n)``: how often each n-gram of the highest order occurs in all rows."""

    def together(held: list[tuple]) -> list[tuple]:
        keys, examples, n = (np.concatenate(x) for x in zip(*held, strict=True))
        keys, first, code = np.unique(keys, return_index=True, return_inverse=True)
        return [(keys, examples[first], np.bincount(code, weights=n, minlength=len(keys)).astype(np.int64))]

    def batch(held: list[tuple]) -> pa.RecordBatch:
        _, examples, n = together(held)[0]
        joined = examples.astype("<u4").tobytes().decode("utf-32-le", "surrogatepass")
        grams = pa.array([joined[i : i + ORDER] for i in range(0, len(joined), ORDER)], pa.string())
        return pa.RecordBatch.from_arrays([grams, pa.array(n)], names=["gram", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        for part in text_slices(batches):
            text, starts = running_text(split_words(texts_of(part)))
            for a, found in windows(text):
                n = np.bincount(found.code[_inside(starts, a, len(found.code))], minlength=len(found.keys))
                held.append((found.keys[n > 0], found.examples[n > 0], n[n > 0]))
            if sum(len(h[0]) for h in held) > GRAMS_HELD:
                held = together(held)
                if len(held[0][0]) > GRAMS_HELD // 2:
                    yield batch(held)
                    held = []
        if held:
            yield batch(held)

    bound_batches(docs.sparkSession)
    return docs.select(F.col(text_col).alias("text")).mapInArrow(run, "gram string, n long").groupBy("gram").agg(F.sum("n").alias("n"))


def _discounts(counts: DataFrame) -> list[float]:
    """The discounts of n-grams seen once, twice and more often, from the counts of counts."""
    r = counts.agg(*(F.count_if(F.col("n") == k).alias(f"n{k}") for k in (1, 2, 3, 4))).first()
    n1, n2, n3, n4 = (max(1, r[f"n{k}"] or 0) for k in (1, 2, 3, 4))
    y = n1 / (n1 + 2 * n2)
    raw = (1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3)
    return [min(max(d, 0.05), k - 0.05) for k, d in zip((1, 2, 3), raw, strict=True)]


@dataclass(frozen=True)
class Model:
    """Where the sorted hash arrays are, and the log probability of a character never seen."""

    path: str
    unseen: float
    entries: int


#: Tells a context's back-off weight from the probability of the n-gram with the same characters.
CONTEXT = np.uint64(0x5851F42D4C957F2D)


def fit(spark: SparkSession, docs: DataFrame, text_col: str = "text") -> Model:
    """Count all rows and write the model to the shared folder."""
    scratch = Scratch(spark, "perplexity")
    counts = {ORDER: scratch.write(count_ngrams(docs, text_col), f"count{ORDER}")}
    for k in range(ORDER - 1, 0, -1):
        # In how many contexts an n-gram occurs: the different longer n-grams that end in it.
        counts[k] = scratch.write(counts[k + 1].groupBy(F.substring("gram", 2, k).alias("gram")).agg(F.count("*").alias("n")), f"count{k}")
    letters = max(1, counts[1].count())
    below, parts, unseen = None, [], 0.0
    for k in range(1, ORDER + 1):
        d1, d2, d3 = _discounts(counts[k])
        n = F.col("n")
        cut = F.when(n == 1, d1).when(n == 2, d2).otherwise(d3)
        rows = counts[k].withColumn("context", F.substring("gram", 1, k - 1))
        heads = rows.groupBy("context").agg((F.sum(cut) / F.sum("n")).alias("rest"), F.sum("n").alias("total"))
        seen = rows.join(heads, "context").select("gram", ((n - cut) / F.col("total")).alias("own"), "rest")
        if below is None:
            p = seen.select("gram", (F.col("own") + F.col("rest") / (letters + 1)).alias("p"))
            rest = heads.first()
            unseen = float(np.log((rest["rest"] if rest else 1.0) / (letters + 1)))
        else:
            lower = below.select(F.col("gram").alias("suffix"), F.col("p").alias("lower"))
            p = seen.withColumn("suffix", F.substring("gram", 2, k - 1)).join(lower, "suffix").select("gram", (F.col("own") + F.col("rest") * F.col("lower")).alias("p"))
            parts.append(heads.select(F.lit(k + 100).alias("tag"), F.col("context").alias("gram"), F.log("rest").alias("value")))
        below = scratch.write(p, f"p{k}")
        parts.append(below.select(F.lit(k).alias("tag"), "gram", F.log("p").alias("value")))
    table = parts[0]
    for part in parts[1:]:
        table = table.unionByName(part)

    def key(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            grams, tags = batch.column("gram"), batch.column("tag").to_numpy(zero_copy_only=False)
            points, starts = codepoints(grams)
            out = np.zeros(batch.num_rows, dtype=np.uint64)
            for order in np.unique(np.diff(starts)).tolist():
                own = np.flatnonzero(np.diff(starts) == order)
                out[own] = _hash(points[starts[own][:, None] + np.arange(order)])
            out[tags >= 100] ^= CONTEXT
            yield pa.RecordBatch.from_arrays([pa.array(out.view(np.int64)), batch.column("value")], names=["key", "value"])

    keyed = scratch.write(table.mapInArrow(key, "key long, value double"), "keyed")
    entries = keyed.count()
    shards = max(1, -(-entries // SHARD_ENTRIES))
    keyed.repartitionByRange(shards, "key").sortWithinPartitions("key").write.parquet(scratch.path("model"))
    scratch.drop("keyed", *(f"count{k}" for k in range(1, ORDER + 1)), *(f"p{k}" for k in range(1, ORDER + 1)))
    return Model(scratch.path("model"), unseen, entries)


class HashArrays:
    """The shards of a model: parallel arrays of keys, sorted, and values. Shards are loaded when needed, the least lately used go."""

    def __init__(self, path: str):
        at = path if "://" in path else path.replace("file:", "file://") if path.startswith("file:") else f"file://{path}"
        self.fs, root = pafs.FileSystem.from_uri(at)
        files = sorted(f.path for f in self.fs.get_file_info(pafs.FileSelector(root)) if f.path.endswith(".parquet"))
        self.shards: list[tuple[int, int, str]] = []
        for name in files:
            meta = pq.read_metadata(name, filesystem=self.fs)
            stats = [meta.row_group(i).column(0).statistics for i in range(meta.num_row_groups)]
            if stats:
                self.shards.append((min(s.min for s in stats), max(s.max for s in stats), name))
        self.kept: OrderedDict[str, tuple[np.ndarray, np.ndarray]] = OrderedDict()

    def _load(self, name: str) -> tuple[np.ndarray, np.ndarray]:
        if name not in self.kept:
            table = pq.read_table(name, filesystem=self.fs)
            self.kept[name] = (table.column("key").to_numpy(), table.column("value").to_numpy().astype(np.float32))
            while len(self.kept) > 1 and sum(a.nbytes + b.nbytes for a, b in self.kept.values()) > SHARDS_KEPT:
                self.kept.popitem(last=False)
        self.kept.move_to_end(name)
        return self.kept[name]

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The value of each key, NaN where there is none."""
        keys = keys.view(np.int64)
        out = np.full(len(keys), np.nan)
        for low, high, name in self.shards:
            own = np.flatnonzero((keys >= low) & (keys <= high))
            if len(own):
                known, values = self._load(name)
                at = np.minimum(np.searchsorted(known, keys[own]), len(known) - 1)
                hit = known[at] == keys[own]
                out[own[hit]] = values[at[hit]]
        return out


_open: dict[str, HashArrays] = {}


def _arrays(path: str) -> HashArrays:
    if path not in _open:
        _open.clear()
        _open[path] = HashArrays(path)
    return _open[path]


def gram_logs(grams: np.ndarray, model: Model) -> np.ndarray:
    """Log probability of each n-gram's last character after the others: the longest one seen, with the back-off weights of longer contexts."""
    arrays = _arrays(model.path)
    out, open_ = np.zeros(len(grams)), np.arange(len(grams))
    for order in range(ORDER, 0, -1):
        own = grams[open_, ORDER - order :]
        value = arrays.find(_hash(own))
        seen = ~np.isnan(value)
        out[open_[seen]] += value[seen]
        open_, own = open_[~seen], own[~seen]
        if not len(open_):
            return out
        if order > 1:
            weight = arrays.find(_hash(own[:, :-1]) ^ CONTEXT)
            out[open_] += np.where(np.isnan(weight), 0.0, weight)
    out[open_] += model.unseen
    return out


def log_perplexity(words: Words, logs_of: Callable[[Windows], np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Mean negative log probability of each text's characters and blanks, and their number. ``logs_of`` gives those of different n-grams."""
    text, starts = running_text(words)
    n = len(starts) - 1
    total, chars = np.zeros(n), np.zeros(n, dtype=np.int64)
    for a, found in windows(text):
        good = np.flatnonzero(_inside(starts, a, len(found.code)))
        owner = np.searchsorted(starts, good + a, side="right") - 1
        total += np.bincount(owner, weights=logs_of(found)[found.code[good]], minlength=n)
        chars += np.bincount(owner, minlength=n)
    return -total / np.maximum(chars, 1), chars


class Waiting:
    """Texts that wait in a temporary file without a name, and their different n-grams, until these are looked up all at once."""

    def __init__(self):
        self.file = tempfile.TemporaryFile()
        self.out = pa.ipc.new_stream(self.file, pa.schema([("text", pa.string())]))
        self.held = [(np.zeros(0, dtype=np.uint64), np.zeros((0, ORDER), dtype=np.uint32))]

    def add(self, texts: pa.Array) -> None:
        self.out.write_batch(pa.RecordBatch.from_arrays([texts.cast(pa.string())], names=["text"]))
        self.held += [(found.keys, found.examples) for _, found in windows(running_text(split_words(texts))[0])]
        if len(self.held) > 16:
            self.held = [self._different()]

    def _different(self) -> tuple[np.ndarray, np.ndarray]:
        keys, first = np.unique(np.concatenate([k for k, _ in self.held]), return_index=True)
        return keys, np.concatenate([e for _, e in self.held])[first]

    def each(self, model: Model) -> Iterator[tuple[pa.Array, Callable[[Windows], np.ndarray]]]:
        self.out.close()
        keys, examples = self._different()
        logs = gram_logs(examples, model)
        self.file.seek(0)
        for batch in pa.ipc.open_stream(self.file):
            yield batch.column(0), lambda found: logs[np.searchsorted(keys, found.keys)]


# --- the verdict ---


STATISTICS = T.StructType(
    [T.StructField(c, T.LongType()) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")]
    + [T.StructField("base_failed", T.BooleanType()), T.StructField("log_perplexity", T.DoubleType()), T.StructField("chars", T.LongType())]
)
NOTHING = pa.array([], to_arrow_type(STATISTICS))


def statistics(docs: DataFrame, model: Model, keep: list[Column], text_col: str = "text") -> DataFrame:
    """``keep``, the base statistics, ``log_perplexity`` and ``chars`` for every row. Only the text goes through Python."""

    def measured(texts: pa.Array, logs_of: Callable[[Windows], np.ndarray]) -> pa.Array:
        words = split_words(texts)
        log, chars = log_perplexity(words, logs_of)
        columns = [*base_columns(texts, words).values(), log, chars]
        release()
        return pa.StructArray.from_arrays([pa.array(c) for c in columns], fields=list(NOTHING.type))

    @F.arrow_udf(STATISTICS)
    def of_texts(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own = lambda found: gram_logs(found.examples, model)
        if model.entries * 12 <= SHARDS_KEPT:
            for texts in batches:
                yield pa.concat_arrays([NOTHING, *(measured(part, own) for part in array_slices(texts))])
            return
        waiting, sizes = Waiting(), []
        for texts in batches:
            sizes.append(len(texts))
            for part in array_slices(texts):
                waiting.add(part)
        ready = waiting.each(model)
        for n in sizes:
            found = [NOTHING]
            while sum(map(len, found)) < n:
                found.append(measured(*next(ready)))
            yield pa.concat_arrays(found)

    bound_batches(docs.sparkSession)
    made = docs.select(*keep, of_texts.asNondeterministic()(F.col(text_col)).alias("statistics"))
    return made.select(*(c for c in made.columns if c != "statistics"), "statistics.*")


def bands(scored: DataFrame, lang_col: str = "lang", band: float = BAND) -> DataFrame:
    """``(lang, middle, lower, upper)``: one row per language and one for all texts (null language) of the texts that pass the base rules."""
    # Copies count once: a text with thousands of them would else draw the quartiles together.
    good = scored.where(~F.col("base_failed")).select(lang_col, "log_perplexity", "chars").distinct()
    q = F.percentile_approx("log_perplexity", [0.25, 0.5, 0.75], 10_000)
    rows = good.groupingSets([[lang_col], []], lang_col).agg(q.alias("q"), F.count("*").alias("n"), F.grouping_id().alias("g"))
    q1, q2, q3 = (F.col("q")[i] for i in range(3))
    reach = band * F.greatest(q3 - q1, F.lit(0.01))
    kept = rows.where((F.col("g") == 1) | (F.col(lang_col).isNotNull() & (F.col("n") >= LEAST_TEXTS)))
    return kept.select(lang_col, q2.alias("middle"), (q1 - reach).alias("lower"), (q3 + reach).alias("upper"))


def apply_rules(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", keep: list[str] | None = None, band: float = BAND) -> DataFrame:
    """``keep`` (or the id), the base statistics, ``log_perplexity``, ``lower``, ``upper`` and ``kept`` for every row."""
    scratch = Scratch(spark, "quality")
    model = fit(spark, docs, text_col)
    row = F.struct(*(keep or [id_col])).alias("row")
    scored = scratch.write(statistics(docs, model, [row, F.col(lang_col).alias("language")], text_col), "scored")
    limits = scratch.write(bands(scored, "language", band), "bands")
    whole = limits.where(F.col("language").isNull()).first()
    # At most one row per language: the languages of a corpus are few, whatever its size.
    out = scored.join(limits.where(F.col("language").isNotNull()), "language", "left")
    middle, lower, upper = (F.coalesce(c, F.lit(whole[c] if whole else None).cast("double")) for c in ("middle", "lower", "upper"))
    wider = 1 + F.sqrt(F.lit(SHORT_CHARS) / F.greatest("chars", F.lit(1)))
    lower, upper = middle - (middle - lower) * wider, middle + (upper - middle) * wider
    good = F.coalesce(F.col("log_perplexity").between(lower, upper), F.lit(False))
    return out.select("row.*", *STATISTICS.fieldNames(), lower.alias("lower"), upper.alias("upper"), (~F.col("base_failed") & good).alias("kept"))
