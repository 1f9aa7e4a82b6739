"""Toxicity: a convolutional text classifier over hashed word embeddings.

A word is embedded as the sum of two hashed vectors, of the whole word and of its first bytes (so
that inflected forms share one). Filters of several widths slide over all words of a text; the
largest response of each is pooled and weighed by a logistic output. Every labelled row teaches, in
Spark jobs: one counts buckets by label and by language; the first embedding dimension starts as the smoothed
log odds of its bucket. Then each epoch is a job: rows are dealt by hash over shards of bounded size, minibatch
Adagrad goes over each shard from the same model, and the driver adds the mean of the shards' changes (of an
embedding: of those that changed it); through max pooling only the winning windows carry gradients. One in
five rows is left out of training, to calibrate a threshold for each language; the language is told from the
same word buckets by naive Bayes, from the text alone. Scores are stretched so that the threshold of the
text's language lies at ``CUT``.

Scoring multiplies embeddings and filters once into a table with a row per bucket, broadcast at a
fixed size; each text then costs one look-up per word.
"""

from __future__ import annotations

import copy
from collections.abc import Iterator
from dataclasses import dataclass, field, replace

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from presswork.llm.shared import BROADCAST_ROWS, add_columns, arrow_rows, names_of, pieces, whole_text
from presswork.llm.words import PUNCTUATED, Words
from presswork.plans.lookup import fits_broadcast
from presswork.plans.ordering import running_sums
from presswork.plans.stage import staged
from presswork.plans.sums import array_sums

CUT = 0.7
BUCKETS = 1 << 16
STORED = "<u2"  # holds a bucket
PREFIX = 4
DIMENSIONS = 12
WIDTHS = (1, 2, 3)
FILTERS = 8
# what a shard holds at least, of either, before there is a second one; a task shuffles so many words at once
SHARD_ROWS = 12_000
SHARD_WORDS = 12_000_000
MOST_LANGUAGES = 64
EPOCHS = 4
# texts that speak for a bucket's share of toxic texts before any is seen
SMOOTHING = 20.0
BATCH = 64
# a minibatch of long texts ends sooner
BATCH_WORDS = 1 << 18
RATE, DECAY = 0.05, 1e-4
# held rows of either label that a language needs for a threshold of its own
LEAST_HELD = 12
SEED = 1


def buckets(column) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bucket of each word, bucket of its beginning, and each text's bounds in the words."""
    words = Words(column, between=PUNCTUATED)
    mask = np.uint64(BUCKETS - 1)
    whole = (words.keys() & mask).astype(np.int32)
    return whole, (words.prefix_keys(PREFIX) & mask).astype(np.int32), words.rows


@dataclass
class Model:
    word: np.ndarray  # BUCKETS x DIMENSIONS
    begin: np.ndarray
    filters: list[np.ndarray]  # for each width: width x DIMENSIONS x FILTERS
    bias: list[np.ndarray]
    out: np.ndarray  # one weight for each filter
    const: float
    languages: list[str] = field(default_factory=list)
    word_given_language: np.ndarray | None = None  # BUCKETS x languages, log probabilities
    prior: np.ndarray | None = None
    thresholds: np.ndarray | None = None  # one for each language
    threshold: float = 0.5  # for texts of no known language

    def table(self) -> "Scorer":
        flat = np.concatenate([k for f in self.filters for k in f], axis=1).astype(self.word.dtype)
        small = replace(self, word=None, begin=None, filters=None)  # what the tables replace
        return Scorer(small, (self.word @ flat).astype(np.float32), (self.begin @ flat).astype(np.float32))


@dataclass
class Scorer:
    model: Model
    by_word: np.ndarray
    by_begin: np.ndarray

    def pooled(self, whole, begin, rows) -> np.ndarray:
        """Largest response of each filter over the windows of each text; 0 where none is above."""
        n = len(rows) - 1
        out = np.zeros((n, FILTERS * len(WIDTHS)), dtype=np.float32)
        some = np.flatnonzero(np.diff(rows))
        if not len(some):
            return out
        parts = self.by_word[whole] + self.by_begin[begin]
        ends, column = rows[1:][some], 0
        for w, width in enumerate(WIDTHS):
            made = parts[:, column : column + FILTERS].copy()
            for j in range(1, width):
                column += FILTERS
                shifted = np.zeros_like(made)
                shifted[:-j] = parts[j:, column : column + FILTERS]
                for k in range(1, j + 1):  # a window ends with its text
                    gone = ends - k
                    shifted[gone[gone >= rows[:-1][some]]] = 0
                made += shifted
            column += FILTERS
            top = np.maximum.reduceat(made, rows[:-1][some], axis=0) + self.model.bias[w]
            out[some, w * FILTERS : (w + 1) * FILTERS] = np.maximum(top, 0)
        return out

    def raw(self, whole, begin, rows) -> np.ndarray:
        return sigmoid(self.pooled(whole, begin, rows) @ self.model.out + self.model.const)

    def language(self, whole, rows) -> np.ndarray:
        """Index of the language of each text, or that after the last for texts without a word."""
        m = self.model
        found = np.full(len(rows) - 1, len(m.languages))
        some = np.flatnonzero(np.diff(rows))
        if m.languages and len(some):
            total = np.add.reduceat(m.word_given_language[whole], rows[:-1][some], axis=0)
            found[some] = (total + m.prior).argmax(axis=1)
        return found

    def score(self, whole, begin, rows) -> tuple[np.ndarray, np.ndarray]:
        raw, language = self.raw(whole, begin, rows), self.language(whole, rows)
        at = np.append(self.model.thresholds if self.model.languages else [], self.model.threshold)[language]
        low = CUT * raw / at
        high = CUT + (1 - CUT) * (raw - at) / (1 - at)
        return np.clip(np.where(raw >= at, np.maximum(high, CUT), np.minimum(low, np.nextafter(CUT, 0))), 0, 1), language


def sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


@dataclass
class Counts:
    """What one pass over the labelled rows counts."""

    languages: list[str]
    seen: np.ndarray  # (word or beginning, label, bucket): texts outside ``hold``
    labels: np.ndarray  # texts of each label outside ``hold``
    by_language: np.ndarray  # language x bucket: words of all texts
    texts: np.ndarray  # texts of each language

    @classmethod
    def none(cls, languages: list[str]) -> "Counts":
        if len(languages) > MOST_LANGUAGES:
            raise ValueError(f"more than {MOST_LANGUAGES} languages among the labelled rows")
        n = len(languages)
        return cls(languages, np.zeros((2, 2, BUCKETS)), np.zeros(2), np.zeros((n, BUCKETS)), np.zeros(n))

    def add(self, texts, labels, langs, hold) -> None:
        labels, hold, place = np.asarray(labels), np.asarray(hold, dtype=bool), {name: i for i, name in enumerate(self.languages)}
        for label in (0, 1):
            some = np.flatnonzero(~hold & (labels == label))
            self.labels[label] += len(some)
            for which in (0, 1) if len(some) else ():
                self.seen[which, label] += np.bincount(np.concatenate([np.unique(texts[i][which]) for i in some]), minlength=BUCKETS)
        told = np.array([place.get(lang, -1) for lang in langs], dtype=np.int64)
        for i in np.unique(told[told >= 0]):
            mine = np.flatnonzero(told == i)
            self.texts[i] += len(mine)
            self.by_language[i] += np.bincount(np.concatenate([texts[t][0] for t in mine]), minlength=BUCKETS)

    def flat(self) -> np.ndarray:
        return np.concatenate([x.ravel() for x in (self.seen, self.labels, self.by_language, self.texts)])

    def filled(self, flat: np.ndarray) -> "Counts":
        old = (self.seen, self.labels, self.by_language, self.texts)
        return Counts(self.languages, *_shaped(flat, old))


def _shaped(flat: np.ndarray, like) -> list[np.ndarray]:
    cuts = np.cumsum([x.size for x in like])[:-1]
    return [part.reshape(x.shape) for part, x in zip(np.split(flat, cuts), like, strict=True)]


@dataclass
class State:
    """A model in training and the sums of squares of its gradients."""

    model: Model
    past: dict

    @classmethod
    def start(cls, counts: Counts, seed: int) -> "State":
        rng = np.random.default_rng(seed)
        share = (counts.labels[1] + 0.5) / (counts.labels.sum() + 2.0)
        word = rng.normal(0, 0.05, (BUCKETS, DIMENSIONS))
        begin = rng.normal(0, 0.05, (BUCKETS, DIMENSIONS))
        for seen, table in zip(counts.seen, (word, begin), strict=True):
            odds = (seen[1] + SMOOTHING * share) / (seen[0] + SMOOTHING * (1 - share)) * (1 - share) / share
            table[:, 0] = 0.5 * np.clip(np.log(odds), -3, 6)
        word, begin = word.astype(np.float32), begin.astype(np.float32)
        filters, bias = [], []
        for width in WIDTHS:
            f = rng.normal(0, 0.1, (width, DIMENSIONS, FILTERS))
            f[:, 0, 0] = 1.0 / width
            filters.append(f)
            bias.append(np.full(FILTERS, -0.1))
        out = rng.normal(0, 0.1, FILTERS * len(WIDTHS))
        out[::FILTERS] = 1.0
        model = Model(word, begin, filters, bias, out, float(np.log(share / (1 - share))))
        past = {"word": np.full(word.shape, 1e-2, np.float32), "begin": np.full(begin.shape, 1e-2, np.float32), "out": np.full(out.shape, 1e-2), "const": 1e-2}
        past |= {"f": [np.full(f.shape, 1e-2) for f in filters], "b": [np.full(f.shape, 1e-2) for f in bias]}
        return cls(model, past)

    def learn(self, texts, y: np.ndarray, rng) -> None:
        """Minibatches over the texts in random order."""
        for batch in _minibatches(rng.permutation(len(texts)), texts):
            _step(self.model, [texts[i] for i in batch], y[batch], self.past, RATE, DECAY)

    def tables(self) -> list[np.ndarray]:
        return [self.model.word, self.past["word"], self.model.begin, self.past["begin"]]

    def dense(self) -> list[np.ndarray]:
        m, past = self.model, self.past
        return [*m.filters, *m.bias, m.out, np.array([m.const]), *past["f"], *past["b"], past["out"], np.array([past["const"]])]

    def changes(self, since: "State") -> np.ndarray:
        """Differences of all numbers, which rows of either table changed, and a one to count shards."""
        out = [(new - old).ravel() for new, old in zip(self.tables(), since.tables(), strict=True)]
        out += [(self.past[name] != since.past[name]).any(axis=1).astype(float) for name in ("word", "begin")]
        out += [(new - old).ravel() for new, old in zip(self.dense(), since.dense(), strict=True)]
        return np.concatenate([*out, [1.0]])

    def moved(self, total: np.ndarray) -> "State":
        """The state after the mean of the changes that ``total`` sums up."""
        tables, dense, width, n = self.tables(), self.dense(), len(WIDTHS), BUCKETS
        like = [*tables, np.empty(n), np.empty(n), *dense, np.empty(1)]
        parts = _shaped(total, like)
        by = [np.maximum(parts[4 + i // 2], 1)[:, None] for i in range(4)]
        word, past_word, begin, past_begin = ((t + p / b).astype(np.float32) for t, p, b in zip(tables, parts[:4], by, strict=True))
        new = [x + p / max(parts[-1][0], 1) for x, p in zip(dense, parts[6:-1], strict=True)]
        half = 2 * width + 2
        model = replace(self.model, word=word, begin=begin, filters=new[:width], bias=new[width : 2 * width], out=new[half - 2], const=float(new[half - 1][0]))
        past = {"word": past_word, "begin": past_begin, "out": new[-2], "const": float(new[-1][0])}
        return State(model, past | {"f": new[half : half + width], "b": new[half + width : half + 2 * width]})


def _minibatches(order: np.ndarray, texts) -> Iterator[np.ndarray]:
    """Up to ``BATCH`` texts, and no second one beyond ``BATCH_WORDS`` words."""
    low, words = 0, 0
    for at, i in enumerate(order):
        if at > low and (at - low == BATCH or words + len(texts[i][0]) > BATCH_WORDS):
            yield order[low:at]
            low, words = at, 0
        words += len(texts[i][0])
    if low < len(order):
        yield order[low:]


def fit(texts: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, langs: list[str | None], hold: np.ndarray, seed: int = SEED) -> Model:
    """What ``train`` does, of one shard at hand: train on the rows outside ``hold`` and calibrate on those inside.

    Without rows of both labels the model scores every text as unlikely or likely alike.
    """
    counts = Counts.none(sorted({x for x in langs if x is not None}))
    counts.add(texts, labels, langs, hold)
    state = State.start(counts, seed)
    learn = np.flatnonzero(~hold)
    some, y = [texts[i] for i in learn], labels[learn].astype(np.float64)
    for epoch in range(EPOCHS if counts.labels.all() else 0):
        state.learn(some, y, np.random.default_rng([seed, epoch, 0]))
    _learn_languages(state.model, counts)
    _calibrate(state.model, texts, labels, hold)
    return state.model


def _step(model: Model, texts, y, past, rate, decay) -> None:
    """One Adagrad step on a minibatch."""
    sizes = np.array([len(t[0]) for t in texts])
    kept = np.flatnonzero(sizes)
    if not len(kept):
        return
    rows = np.concatenate([[0], np.cumsum(sizes[kept])])
    whole = np.concatenate([texts[i][0] for i in kept])
    begin = np.concatenate([texts[i][1] for i in kept])
    y, n = y[kept], len(kept)
    x = model.word[whole] + model.begin[begin]
    of = np.repeat(np.arange(n), np.diff(rows))
    at = np.arange(len(x))
    hidden, where = [], []
    for w, width in enumerate(WIDTHS):
        made = x @ model.filters[w][0]
        for j in range(1, min(width, len(x))):
            inside = at[j:] < rows[1:][of[:-j]]
            made[:-j] += (x[j:] @ model.filters[w][j]) * inside[:, None]
        top = np.maximum.reduceat(made, rows[:-1], axis=0)
        place = np.empty((n, FILTERS), dtype=np.int64)
        for f in range(FILTERS):
            hits = np.flatnonzero(made[:, f] == top[of, f])
            place[of[hits[::-1]], f] = hits[::-1]  # the first of equal ones
        where.append(place)
        hidden.append(np.maximum(top + model.bias[w], 0))
    h = np.concatenate(hidden, axis=1)
    p = sigmoid(h @ model.out + model.const)
    error = (p - y) * np.where(y > 0, 2.0, 1.0) / n
    touched, changes = [], []
    for w, width in enumerate(WIDTHS):
        span = slice(w * FILTERS, (w + 1) * FILTERS)
        back = error[:, None] * model.out[span] * (hidden[w] > 0)
        grad_f = decay * model.filters[w]
        for f in range(FILTERS):
            for j in range(width):
                place = where[w][:, f] + j
                good = place < rows[1:]
                grad_f[j, :, f] += back[good, f] @ x[place[good]]
                touched.append(place[good])
                changes.append(back[good, f][:, None] * model.filters[w][j, :, f])
        past["f"][w] += grad_f**2
        past["b"][w] += back.sum(axis=0) ** 2
        model.filters[w] -= rate * grad_f / np.sqrt(past["f"][w])
        model.bias[w] -= rate * back.sum(axis=0) / np.sqrt(past["b"][w])
    touched, changes = np.concatenate(touched), np.concatenate(changes)
    for name, ids, table in (("word", whole[touched], model.word), ("begin", begin[touched], model.begin)):
        rows_, back = np.unique(ids, return_inverse=True)
        grad = np.zeros((len(rows_), DIMENSIONS))
        np.add.at(grad, back, changes)
        past[name][rows_] += grad**2
        table[rows_] -= rate * grad / np.sqrt(past[name][rows_])
    grad = h.T @ error + decay * model.out
    past["out"] += grad**2
    model.out -= rate * grad / np.sqrt(past["out"])
    past["const"] += error.sum() ** 2
    model.const -= rate * error.sum() / np.sqrt(past["const"])


def _learn_languages(model: Model, counts: Counts) -> None:
    words, texts = counts.by_language.T + 0.1, counts.texts
    model.languages = counts.languages
    model.word_given_language = np.log(words / words.sum(axis=0)).astype(np.float32)
    model.prior = np.log(texts / max(1.0, texts.sum())) if len(texts) else texts
    model.thresholds = np.full(len(texts), model.threshold)


def _best_threshold(raw: np.ndarray, y: np.ndarray) -> float | None:
    """The middle of the gap at which F1 is largest; None without both labels."""
    if not y.any() or y.all():
        return None
    order = np.argsort(-raw, kind="stable")
    hits = np.cumsum(y[order])
    f1 = 2 * hits / (np.arange(1, len(y) + 1) + y.sum())
    ranked = raw[order]
    f1[:-1][ranked[:-1] == ranked[1:]] = -1
    best = int(f1.argmax())
    below = ranked[best + 1] if best + 1 < len(ranked) else 0.0
    return float(np.clip((ranked[best] + below) / 2, 0.02, 0.98))


def _calibrate(model: Model, texts, labels, hold, least: int = LEAST_HELD) -> None:
    """A threshold for each language with at least ``least`` held rows of either label; one for the rest."""
    scorer, held = model.table(), np.flatnonzero(hold)
    if not len(held):
        return
    raw, language, y = np.empty(len(held)), np.empty(len(held), np.int64), labels[held] > 0
    for low in range(0, len(held), BATCH):
        some = held[low : low + BATCH]
        rows = np.concatenate([[0], np.cumsum([len(texts[i][0]) for i in some])])
        whole, begin = (np.concatenate([texts[i][k] for i in some]) for k in (0, 1))
        raw[low : low + BATCH], language[low : low + BATCH] = scorer.raw(whole, begin, rows), scorer.language(whole, rows)
    model.threshold = _best_threshold(raw, y) or model.threshold
    for i in range(len(model.languages)):
        mine = language == i
        enough = min(y[mine].sum(), (~y[mine]).sum()) >= least
        model.thresholds[i] = (_best_threshold(raw[mine], y[mine]) if enough else None) or model.threshold


def _best_thresholds(scored: DataFrame) -> list:
    """(language, hits, cases, at) of a table (language, raw, hit), where -1 is all languages together.

    ``at`` is what ``_best_threshold`` finds, by running sums over the sorted scores.
    """
    each = scored.withColumn("language", F.explode(F.array("language", F.lit(-1))))
    steps = staged(each.groupBy("language", "raw").agg(F.sum("hit").alias("hits"), F.count(F.lit(1)).alias("cases")), "held")
    totals = steps.groupBy("language").agg(F.sum("hits").alias("hits"), F.sum("cases").alias("cases"))
    passed = running_sums(steps, [F.desc("raw")], {"tp": "hits", "seen": "cases"}, by="language").select("language", "raw", "tp", "seen")
    f1 = F.col("tp") * 2 / (F.col("seen") + F.col("hits"))
    passed = passed.join(F.broadcast(totals.where("hits > 0")), "language")
    best = passed.groupBy("language").agg(F.max(F.struct(f1.alias("f1"), "raw")).alias("best"))
    best = totals.join(best.select("language", F.col("best.raw").alias("above")), "language", "left")
    below = steps.join(F.broadcast(best.select("language", "above")), "language").where("raw < above")
    below = below.groupBy("language").agg(F.max("raw").alias("below"))
    middle = (F.col("above") + F.coalesce("below", F.lit(0.0))) / 2
    at = F.when(F.col("above").isNotNull(), F.least(F.greatest(middle, F.lit(0.02)), F.lit(0.98)))
    return best.join(below, "language", "left").select("language", "hits", "cases", at.alias("at")).collect()


def _texts(batch: pa.RecordBatch) -> list[tuple[np.ndarray, np.ndarray]]:
    columns = (batch.column("whole"), batch.column("begin"))
    return [tuple(np.frombuffer(x.as_buffer(), STORED) for x in pair) for pair in zip(*columns, strict=True)]


def _label_values(batch: pa.RecordBatch) -> np.ndarray:
    return (batch.column("label").to_numpy(zero_copy_only=False) > 0).astype(np.int64)


def count_rows(sample: DataFrame) -> Counts:
    languages = sample.where("lang is not null").select("lang").distinct().limit(MOST_LANGUAGES + 1).collect()
    empty = Counts.none(sorted(r.lang for r in languages))

    def work(batches):
        counts = Counts.none(empty.languages)
        for batch in batches:
            if len(batch):
                counts.add(_texts(batch), _label_values(batch), batch.column("lang").to_pylist(), batch.column("hold").to_numpy(zero_copy_only=False))
        yield counts.flat()

    return empty.filled(array_sums(sample, work, empty.flat().size, max(1, sample.select(F.spark_partition_id()).distinct().count())))


def learn_rows(rows: DataFrame, state: State, shards: int, seed: int) -> State:
    """All epochs over rows (label, whole, begin, shard) that lie together by shard."""
    for epoch in range(EPOCHS):
        shared = rows.sparkSession.sparkContext.broadcast(state)

        def work(batches, epoch=epoch, shared=shared):
            since, at, mine, rng = shared.value, None, None, None
            for shard, texts, y in _blocks(batches):
                if shard != at:
                    if mine:
                        yield mine.changes(since)
                    at, mine, rng = shard, copy.deepcopy(since), np.random.default_rng([seed, epoch, shard])
                mine.learn(texts, y, rng)
            if mine:
                yield mine.changes(since)

        size = sum(x.size for x in (*state.tables(), *state.dense())) + 2 * BUCKETS + 1
        state = state.moved(array_sums(rows, work, size, shards, np.float32))
        shared.destroy()
    return state


def _blocks(batches) -> Iterator[tuple[int, list, np.ndarray]]:
    """(shard, texts, labels): neighbouring rows of one shard, up to ``SHARD_WORDS`` words twice over or one text."""
    at, texts, labels, words = None, [], [], 0
    for batch in batches:
        for shard, text, label in zip(batch.column("shard").to_pylist(), _texts(batch), _label_values(batch), strict=True):
            if texts and (shard != at or words + len(text[0]) > 2 * SHARD_WORDS):
                yield at, texts, np.array(labels, dtype=np.float64)
                texts, labels, words = [], [], 0
            at = shard
            texts.append(text)
            labels.append(label)
            words += len(text[0])
    if texts:
        yield at, texts, np.array(labels, dtype=np.float64)


def calibrate_rows(held: DataFrame, model: Model) -> None:
    """``_calibrate`` over a table of held rows."""
    shared = held.sparkSession.sparkContext.broadcast(model.table())

    def work(batches):
        scorer = shared.value
        for batch in batches:
            texts, y = _texts(batch), _label_values(batch)
            for some in _minibatches(np.arange(len(texts)), texts):
                rows = np.concatenate([[0], np.cumsum([len(texts[i][0]) for i in some])])
                whole, begin = (np.concatenate([texts[i][k] for i in some]) for k in (0, 1))
                yield {"language": scorer.language(whole, rows), "raw": scorer.raw(whole, begin, rows), "hit": y[some]}

    scored = staged(arrow_rows(held, work, "language int, raw double, hit long"), "scored")
    found = {r.language: r for r in _best_thresholds(scored)}
    shared.destroy()
    if -1 in found and 0 < found[-1].hits < found[-1].cases:
        model.threshold = found[-1].at
    model.thresholds = np.full(len(model.languages), model.threshold)
    for i in set(found) & set(range(len(model.languages))):
        if min(found[i].hits, found[i].cases - found[i].hits) >= LEAST_HELD:
            model.thresholds[i] = found[i].at


def train(
    docs: DataFrame, labels: DataFrame, learn: Column, key: str = "doc_id", text: str = "text", label: str = "toxic", lang: str = "lang",
    sample_rows: int | None = None, sample_words: int | None = None, seed: int = SEED,
) -> Model:
    """Fit on all labelled rows; with ``sample_rows`` or ``sample_words``, on a sample so bounded by hash of the key.

    ``learn`` is a condition on the key, of any type. Rows whose label or key is null teach nothing;
    a key with several labels counts as toxic if one says so, and with several texts each text counts.
    A text whose words would pass the bound of a sample is passed over, and the next ones still count.
    """
    names_of(docs, [key, text, lang])
    names_of(labels, [key, label])
    known = labels.where(learn & F.col(label).isNotNull() & F.col(key).isNotNull())
    known = known.groupBy(F.col(key).alias("key")).agg(F.max(label).cast("int").alias("label"))
    if sample_rows is not None:
        known = known.orderBy(F.xxhash64("key"), "key").limit(sample_rows)
    known = staged(known, "labelled")
    rows = docs.where(learn & F.col(key).isNotNull())
    rows = rows.select(F.col(key).alias("key"), whole_text(text).alias("text"), F.col(lang).cast("string").alias("lang"))
    rows = rows.join(F.broadcast(known) if fits_broadcast(known, BROADCAST_ROWS) else known, "key")

    def work(batches):
        for batch in batches:
            for first, part in pieces(batch, "text"):
                whole, begin, bounds = buckets(part)
                whole, begin = whole.astype(STORED), begin.astype(STORED)
                spans = [slice(a, b) for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
                same = {name: batch.column(name).slice(first, len(part)) for name in ("key", "label", "lang")}
                yield same | {"n": np.diff(bounds), "whole": [whole[s].tobytes() for s in spans], "begin": [begin[s].tobytes() for s in spans]}

    kind = docs.schema[key].dataType.simpleString()
    schema = f"key {kind}, label int, lang string, n long, whole binary, begin binary"
    rows = arrow_rows(rows, work, schema).withColumn("hold", F.pmod(F.xxhash64("key"), F.lit(5)) == 0)
    sample = staged(rows.withColumn("row", F.monotonically_increasing_id()), "labelled-words")
    if sample_words is not None:
        order = F.struct(F.xxhash64("key"), "key", "n", F.xxhash64("whole"), "row")
        sizes = sample.select("row", "n").orderBy(order).collect()
        some = docs.sparkSession.createDataFrame([(r,) for r in within(sizes, sample_words)], "row long")
        sample = sample.join(F.broadcast(some), "row")
    counts = count_rows(sample)
    state = State.start(counts, seed)
    if counts.labels.all():
        learnt = sample.where("not hold")
        size = learnt.agg(F.count(F.lit(1)).alias("rows"), F.sum("n").alias("words")).first()
        shards = int(max(1, size.rows // SHARD_ROWS, size.words // SHARD_WORDS))
        place = F.xxhash64("key", "n", "whole", "begin")
        dealt = learnt.select("label", "whole", "begin", place.alias("place"), F.pmod(place, F.lit(shards)).cast("int").alias("shard"))
        dealt = dealt.repartitionById(shards, "shard").sortWithinPartitions("shard", "place", "label").drop("place")
        dealt = dealt.persist(StorageLevel.DISK_ONLY)
        try:
            state = learn_rows(dealt, state, shards, seed)
        finally:
            dealt.unpersist()
    _learn_languages(state.model, counts)
    calibrate_rows(sample.where("hold"), state.model)
    return state.model


def within(sizes: list, words: int) -> list[int]:
    """Rows taken in order as long as their words fit; a row that does not fit is passed over."""
    rows, total = [], 0
    for row in sizes:
        if total + row.n <= words:
            rows.append(row.row)
            total += row.n
    return rows


def score(docs: DataFrame, model: Model, text: str = "text", names=("score", "predicted", "told_lang")) -> DataFrame:
    """``docs`` with a score from 0 to 1, whether it reaches ``CUT``, and the language it was read as.

    A null text counts as empty; texts without a word get the score of the output's constant.
    """
    names_of(docs, [text])
    shared = docs.sparkSession.sparkContext.broadcast(model.table())

    def run(batches):
        scorer = shared.value
        labels = np.array([*scorer.model.languages, None], dtype=object)
        for batch in batches:
            values, told = np.zeros(len(batch)), np.zeros(len(batch), np.int64)
            for first, part in pieces(batch, text, 1_000_000):
                rows = slice(first, first + len(part))
                values[rows], told[rows] = scorer.score(*buckets(part))
            yield {names[0]: values, names[1]: (values >= CUT).astype(np.int32), names[2]: labels[told]}

    return add_columns(docs, run, f"{names[0]} double, {names[1]} int, {names[2]} string")
