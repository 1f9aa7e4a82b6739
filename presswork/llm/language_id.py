"""Language identification: multinomial naive Bayes over hashed character n-grams.

Characters are lower-cased, and everything but letters reads as a blank. N-grams of 1 to 3
characters are hashed into ``BUCKETS`` counters. Training adds up one row per task, language and
bucket in Spark; the model is a languages x buckets matrix of log probabilities, whose size is
bounded by ``MOST_LANGUAGES`` and broadcast. Scoring sums the matrix' columns over the n-grams of
each whole text, a batch of texts at a time.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from presswork.llm.shared import add_columns, arrow_rows, names_of, pieces, sums_by_row, utf8

BUCKETS = 1 << 15
SIZES = (1, 2, 3)
MOST_LANGUAGES = 512
SMOOTHING = 0.5
UNDETERMINED = "und"

_lower: list[np.ndarray] = []


def _letters() -> np.ndarray:
    """For each code point its small letter, or a blank where it is no letter."""
    if not _lower:
        table = np.full(0x110000, 32, dtype=np.uint32)
        for point in range(0x110000):
            if 0xD800 <= point < 0xE000:
                continue
            char = chr(point)
            if char.isalpha():
                small = char.lower()
                table[point] = ord(small) if len(small) == 1 else point
        _lower.append(table)
    return _lower[0]


def characters(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all texts after lower-casing, and each text's bounds in them."""
    flat, bounds = utf8(column)
    points = np.frombuffer(flat.tobytes().decode("utf-8").encode("utf-32-le"), dtype=np.uint32)
    if len(points) != len(flat):
        begun = np.empty(len(flat) + 1, dtype=np.int64)
        begun[0] = 0
        np.cumsum((flat & 0xC0) != 0x80, out=begun[1:])
        bounds = begun[bounds]
    return _letters()[points], bounds


def grams(points: np.ndarray, bounds: np.ndarray):
    """For each n: the bucket of the n-gram that begins at each character, and where none of a text does."""
    code = np.zeros(len(points), dtype=np.uint32)
    ends = bounds[1:]
    for n in range(1, max(SIZES) + 1):
        if n > 1:
            code = code[:-1] if n > 2 else points.astype(np.uint32)[:-1]
            code = (code * np.uint32(0x01000193)) ^ points[n - 1 :].astype(np.uint32)
        else:
            code = points.astype(np.uint32)
        hashed = code * np.uint32(0x9E3779B1) + np.uint32(n)
        hashed = ((hashed ^ (hashed >> np.uint32(15))) * np.uint32(0x85EBCA6B)) >> np.uint32(32 - 15)
        crossing = np.concatenate([ends - k for k in range(1, n)]) if n > 1 else np.empty(0, np.int64)
        crossing = crossing[(crossing >= 0) & (crossing < len(hashed))]
        yield hashed.astype(np.int64), crossing


@dataclass
class LanguageModel:
    languages: list[str]
    log_prob: np.ndarray  # languages x (BUCKETS + 1); the last column is 0, for no n-gram
    prior: np.ndarray

    def score(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Index of the best language, its posterior, and whether there is a letter, for each text."""
        points, bounds = characters(column)
        n, k = len(bounds) - 1, len(self.languages)
        some = sums_by_row(points != 32, bounds) > 0
        total = np.tile(self.prior, (n, 1)) if k else np.zeros((n, 0))
        if not k or not len(points):
            return np.zeros(n, np.int64), np.zeros(n), some
        for hashed, crossing in grams(points, bounds):
            hashed[crossing] = BUCKETS
            inner = np.minimum(bounds, len(hashed))
            for j in range(k):
                total[:, j] += sums_by_row(self.log_prob[j].take(hashed), inner)
        best = total.argmax(axis=1)
        top = total[np.arange(n), best]
        return best, 1.0 / np.exp(total - top[:, None]).sum(axis=1), some


def train(docs: DataFrame, learn: Column, text: str = "text", lang: str = "lang") -> LanguageModel:
    """Count n-grams over all rows where ``learn`` holds and ``lang`` is given.

    More than ``MOST_LANGUAGES`` languages raise ``ValueError``. Without rows to learn from the
    model knows no language.
    """
    names_of(docs, [text, lang])
    rows = docs.where(learn & F.col(lang).isNotNull()).select(
        F.coalesce(F.col(text), F.lit("")).alias("text"), F.col(lang).cast("string").alias("lang")
    )

    def count(batches):
        known: dict[str, int] = {}
        texts: list[int] = []
        counts = np.zeros((0, BUCKETS + 1), dtype=np.int64)
        for batch in batches:
            langs = batch.column("lang").to_pylist()
            for first, part in pieces(batch, "text"):
                points, bounds = characters(part)
                mine = langs[first : first + len(part)]
                for name in mine:
                    if name not in known:
                        known[name] = len(known)
                        texts.append(0)
                        counts = np.vstack([counts, np.zeros((1, BUCKETS + 1), dtype=np.int64)])
                    texts[known[name]] += 1
                if not len(points):
                    continue
                of = np.repeat(np.array([known[x] for x in mine]), np.diff(bounds)) * (BUCKETS + 1)
                for hashed, crossing in grams(points, bounds):
                    hashed[crossing] = BUCKETS
                    counts += np.bincount(of[: len(hashed)] + hashed, minlength=counts.size).reshape(counts.shape)
        for name, j in known.items():
            found = np.flatnonzero(counts[j, :BUCKETS])
            buckets = np.append(found, -1)
            yield {"lang": [name] * len(buckets), "bucket": buckets, "n": np.append(counts[j, found], texts[j])}

    counted = arrow_rows(rows, count, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    languages = sorted(r.lang for r in counted.where("bucket = -1").select("lang").limit(MOST_LANGUAGES + 1).collect())
    if len(languages) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages")
    log_prob = np.zeros((len(languages), BUCKETS + 1), dtype=np.float32)
    if not languages:
        return LanguageModel([], log_prob, np.zeros(0))
    found = counted.toArrow()  # at most MOST_LANGUAGES x BUCKETS numbers
    place = {name: j for j, name in enumerate(languages)}
    of = np.array([place[x] for x in found.column("lang").to_pylist()])
    bucket, n = found.column("bucket").to_numpy(), found.column("n").to_numpy()
    counts = np.zeros((len(languages), BUCKETS))
    counts[of[bucket >= 0], bucket[bucket >= 0]] = n[bucket >= 0]
    texts = np.zeros(len(languages))
    texts[of[bucket < 0]] = n[bucket < 0]
    smooth = counts + SMOOTHING
    log_prob[:, :BUCKETS] = np.log(smooth / smooth.sum(axis=1, keepdims=True))
    return LanguageModel(languages, log_prob, np.log(texts / texts.sum()))


def predict(docs: DataFrame, model: LanguageModel, text: str = "text", names=("lang_pred", "score")) -> DataFrame:
    """``docs`` with two more columns: the predicted language and its posterior probability.

    Null texts, texts without a letter, and all texts where the model knows no language get
    ``und`` with score 0. Ties go to the first language by code point.
    """
    names_of(docs, [text])
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        known = shared.value
        labels = np.array([*known.languages, UNDETERMINED], dtype=object)
        for batch in batches:
            best, score = np.full(len(batch), len(known.languages)), np.zeros(len(batch))
            for first, part in pieces(batch, text):
                which, sure, some = known.score(part)
                if known.languages:
                    rows = slice(first, first + len(part))
                    best[rows] = np.where(some, which, len(known.languages))
                    score[rows] = np.where(some, sure, 0.0)
            yield {names[0]: labels[best], names[1]: score}

    return add_columns(docs, run, f"{names[0]} string, {names[1]} double")
