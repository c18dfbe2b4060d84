"""Language of a text: known words first, shorter and shorter character n-grams for the others.

Per language the model has the log frequency of its commonest words and of the character n-grams of
its words, counted by Spark over a bounded sample of labelled documents. A word that some language
knows is scored by those frequencies; for any other word the longest n-grams that the model knows
are scored, n from 5 down to 1. A text's language has the greatest mean score.
"""

from __future__ import annotations

import math
import uuid

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from threadloom.llm.memory import Memory, keep_only
from threadloom.llm.shared import cut

UNDETERMINED = "und"
# Bounds of the model, per language: documents of the sample (about), words, n-grams of a length.
SAMPLE_DOCS, MAX_WORDS, MAX_GRAMS = 4_000, 20_000, 10_000
MAX_N = 5
FLOOR_COUNT = 0.5  # what a word or n-gram counts in a language that lacks it
# Letters alone, as Spark's \p{L} in training; a run may not hold digits such as those of "H₂O".
LETTERS = regex.compile(r"\p{L}+")
# Words whose scores a worker remembers, twice over, and the longest such word: about 40 MB.
CACHE_WORDS, CACHE_CHARS = 100_000, 32
PREDICTION_SCHEMA = "lang_pred string, score double"


def held_out(doc_id: Column) -> Column:
    """Documents that are never learned from: crc32 of the id as text, modulo 4, is 2."""
    return F.pmod(F.crc32(doc_id.cast("string")), F.lit(4)) == 2


def training_rows(docs: DataFrame, sample_docs: int = SAMPLE_DOCS) -> DataFrame:
    """Labelled rows that are not held out, about `sample_docs` of each language, by hash of id.

    A row without doc_id is never learned from.
    """
    rows = docs.where(F.col("text").isNotNull() & F.col("lang").isNotNull()
                      & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    counts = rows.groupBy("lang").agg(F.count("*").alias("n"))  # a row per language
    part = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) / float(1 << 30)
    return rows.join(F.broadcast(counts), "lang").where(
        part * F.col("n") < sample_docs).select("lang", "text")


def word_counts(rows: DataFrame) -> DataFrame:
    words = F.regexp_extract_all(F.lower("text"), F.lit(r"(\p{L}+)"), 1)
    return rows.select("lang", F.explode(words).alias("word")).groupBy("lang", "word").agg(
        F.count("*").alias("n"))


def gram_counts(words: DataFrame) -> DataFrame:
    """Counts of n-grams of 1 to MAX_N letters, the word's ends marked by a blank."""
    letters = F.filter(F.split("word", ""), lambda c: c != "")
    blank = F.array(F.lit(" "))
    # the array is bound once, so a long word is read once and not for each of its n-grams
    grams = F.flatten(F.get(F.transform(
        F.array(F.concat(blank, letters, blank)), lambda marked: F.transform(
            F.lit(list(range(1, MAX_N + 1))), lambda size: F.transform(
                F.filter(F.sequence(F.lit(1), F.size(marked)),
                         lambda i: i + size <= F.size(marked) + 1),
                lambda i: F.array_join(F.slice(marked, i, size), "")))), F.lit(0)))
    return words.select("lang", "n", F.explode(grams).alias("gram")).where("gram <> ' '").groupBy(
        "lang", F.length("gram").alias("size"), "gram").agg(F.sum("n").alias("n"))


def _commonest(counts: DataFrame, keys: list[str], value: str, most: int) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy(F.desc("n"), value)
    return counts.withColumn("_rank", F.row_number().over(order)).where(
        F.col("_rank") <= most).drop("_rank")


class Model:
    """Log frequencies by language, of words and of n-grams by their length."""

    def __init__(self, words, grams):
        """`words` has (lang, word, n), `grams` has (lang, size, gram, n) rows."""
        self.langs = sorted({r[0] for r in words})
        self.tables = [self._table((lang, w, n) for lang, w, n in words)] + [
            self._table((lang, g, n) for lang, s, g, n in grams if s == size)
            for size in range(1, MAX_N + 1)]

    def _table(self, rows) -> tuple[dict[str, int], np.ndarray]:
        """Row number of each key, and the rows: log frequencies by language, then 1."""
        place = {lang: i for i, lang in enumerate(self.langs)}
        counts: dict[str, np.ndarray] = {}
        for lang, key, n in rows:
            counts.setdefault(key, np.full(len(place), FLOOR_COUNT))[place[lang]] = n
        logs = np.array(list(counts.values())).reshape(len(counts), len(place))
        logs = np.log(logs / logs.sum(axis=0))
        full = np.concatenate([logs, np.ones((len(logs), 1))], axis=1).astype(np.float32)
        return {key: i for i, key in enumerate(counts)}, full

    def word(self, word: str) -> np.ndarray | None:
        """Scores of a word by language, then 1; null if not even a letter of it is known."""
        rows, logs = self.tables[0]
        if word in rows:
            return logs[rows[word]]
        marked = f" {word} "
        for size in range(MAX_N, 0, -1):
            rows, logs = self.tables[size]
            hits = [row for i in range(len(marked) - size + 1)
                    if (row := rows.get(marked[i:i + size])) is not None]
            if hits:
                return np.add.reduce(logs.take(hits, axis=0)) / np.float32(len(hits))
        return None


class Predictor:
    """Predictions by a model; a word is scored once, and remembered."""

    def __init__(self, model: Model):
        self.model = model
        self.known = Memory(self._score, CACHE_WORDS, CACHE_CHARS)

    def _score(self, words: list[str]) -> list[bytes]:
        """Per word: its scores by language, then 1; all 0 for a word of no known letter."""
        nothing = np.zeros(len(self.model.langs) + 1, np.float32).tobytes()
        scores = map(self.model.word, words)
        return [nothing if s is None else s.tobytes() for s in scores]

    def predict(self, text: str | None) -> tuple[str, float]:
        """Language and its share of the likelihoods per word, sharpened by the words' number."""
        found = LETTERS.findall((text or "").lower())
        langs = self.model.langs
        if not langs or not found:
            return UNDETERMINED, 0.0
        known = self.known.of(set(found))
        rows = np.frombuffer(b"".join(map(known.__getitem__, found)), np.float32)
        *total, n = rows.reshape(-1, len(langs) + 1).sum(axis=0, dtype=np.float64)
        if not n:
            return langs[0], 1.0 / len(langs)
        best = int(np.argmax(total))  # ties: the first language in order
        rest = (np.array(total) - total[best]) / math.sqrt(n)
        return langs[best], 1.0 / float(np.exp(rest).sum())


def train(docs: DataFrame, sample_docs: int = SAMPLE_DOCS) -> Model:
    """A model of (doc_id, text, lang) rows; its size is bounded by the constants above."""
    words = cut(word_counts(training_rows(docs, sample_docs)))
    grams = _commonest(gram_counts(words), ["lang", "size"], "gram", MAX_GRAMS)
    top = _commonest(words, ["lang"], "word", MAX_WORDS)
    return Model([tuple(r) for r in top.select("lang", "word", "n").collect()],
                 [tuple(r) for r in grams.select("lang", "size", "gram", "n").collect()])


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """The columns of `docs` but `text`, with lang_pred and score, which come from `text` alone.

    A null text, or one without a letter, is `und` with score 0. A text none of whose letters the
    model knows gets the first language, with an even score. Columns of these two names are
    replaced. Without learned languages every text is `und`.
    """
    kept = [c for c in docs.columns if c not in ("text", "lang_pred", "score")]
    shared = docs.sparkSession.sparkContext.broadcast(model)
    key = uuid.uuid4().hex

    def run(batches):
        for batch in batches:
            predictor = keep_only(key, lambda: Predictor(shared.value))
            rows = [predictor.predict(t.as_py()) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in kept), pa.array([r[0] for r in rows], pa.string()),
                 pa.array([r[1] for r in rows], pa.float64())],
                [*kept, "lang_pred", "score"])

    fields = ", ".join(
        f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields if f.name in kept)
    return docs.select(*kept, "text").mapInArrow(run, f"{fields}, {PREDICTION_SCHEMA}")


def language_of(docs: DataFrame, sample_docs: int = SAMPLE_DOCS) -> DataFrame:
    """Per row of (doc_id, text, lang): doc_id, held_out, lang_pred, score."""
    model = train(docs, sample_docs)
    ids = docs.select("doc_id", "text")
    return predict(ids, model).select(
        "doc_id", F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"),
        "lang_pred", "score")
