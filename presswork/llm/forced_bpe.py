"""Byte-pair encoding by forced boundaries, and decoding.

A merge joins two neighbouring symbols into a token of the vocabulary, so a pair of bytes that lies
inside no token of the vocabulary can never be joined: between the two is a certain cut, whatever
stands around them. A text is cut at all such pairs (white space is one: no token holds any), its
fragments are encoded independently, each once for a worker, and their ids are put one after
another. Merges within a fragment go by rank, then from the left, as in the whole text.

The last byte of a word carries the vocabulary's word ending, so a pair is told apart by whether
its second byte ends a word. What a word is, and its normal form, are the vocabulary's own rules.
"""

from __future__ import annotations

import heapq
import json
import os
import re
from array import array
from collections.abc import Iterator
from functools import lru_cache
from operator import add

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from presswork.llm.shared import names_of, slices

KEPT_WORDS = 1_000_000
# longer words are encoded anew each time, so that kept ones need bounded memory
KEPT_LENGTH = 128
# fragments of up to so many symbols are merged by scans, longer ones with a heap
SCANNED = 48
# text bytes of a batch handed back
STEP = 4_000_000

# blanks of ASCII become one blank character, A-Z become small
_BYTES = bytes(0x20 if 0x09 <= b <= 0x0D else b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))
# from here on, normal forms may join characters, so letters keep their case until then
_JOINING = re.compile("[^\x00-˿]")
_BLANKS = re.compile("[\t-\r ]+")
# letters that no normal form changes and that need no rule to tell
_PLAIN_END = "ɐ"


class Encoder(dict):
    """Ids of words (runs without an ASCII blank) as bytes of 32-bit integers; met first, encoded then."""

    def __init__(self, path: str):
        super().__init__()
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as source:
            rules = json.load(source)
        model, self.tokenizer = rules["model"], Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        known = {"type": "BPE", "dropout": None, "continuing_subword_prefix": None, "byte_fallback": False, "ignore_merges": False}
        if any((model.get(k) or None) != (v or None) for k, v in known.items()) or not model.get("end_of_word_suffix"):
            raise ValueError(f"{path} is no byte-pair vocabulary with word endings")
        self.ending, self.vocabulary = model["end_of_word_suffix"], model["vocab"]
        self.shown = _byte_characters()
        letters = set(self.shown.values())
        if not all(c in self.vocabulary and c + self.ending in self.vocabulary for c in letters):
            raise ValueError(f"{path} does not hold every byte")
        self.merges = {}
        for rank, pair in enumerate(model["merges"]):
            left, right = pair.split(" ") if isinstance(pair, str) else pair
            self.merges[self.vocabulary[left], self.vocabulary[right]] = (rank, self.vocabulary[left + right])
        self.inner, self.final = pairs_inside(self.vocabulary, self.ending)
        self.to_character = {b: c for b, c in self.shown.items() if chr(b) != c}
        self.tokens = {i: t for t, i in self.tokenizer.get_vocab(with_added_tokens=True).items()}
        self.joined = self.tokenizer.decoder is None
        added = self.tokenizer.get_added_tokens_decoder()
        if any(t.normalized or t.single_word or t.lstrip or t.rstrip for t in added.values()):
            raise ValueError(f"{path} has added tokens with rules of their own")
        self.added = {t.content: array("i", [i]).tobytes() for i, t in added.items()}
        names = sorted(self.added, key=len, reverse=True)
        self.special = re.compile("(" + "|".join(map(re.escape, names)) + ")") if names else None
        self.marks = [n.lower() for n in names]

    def ids(self, text: str) -> bytes:
        small = text.encode().translate(_BYTES).decode()
        if any(m in small for m in self.marks):
            parts = self.special.split(text)
            return b"".join(self.added[p] if i % 2 else self._words(p) for i, p in enumerate(parts))
        if not small.isascii() and _JOINING.search(small):
            return self._words(text)
        return b"".join(map(self.__getitem__, small.split(" ")))

    def _words(self, text: str) -> bytes:
        return b"".join(map(self.__getitem__, _BLANKS.split(text)))

    def __missing__(self, word: str) -> bytes:
        if len(word) > 1 and word[-1] in ".,;:!?" and self._is_plain(word[:-1]):
            made = self[word[:-1]] + self[word[-1]]  # a letter and such a mark are words apart
        else:
            found = array("i")
            for letters in self._cut_words(word):
                for start, end in self._fragments(letters):
                    found.extend(self._merged(letters[start:end], end == len(letters)))
            made = found.tobytes()
        if len(word) <= KEPT_LENGTH:
            if len(self) >= KEPT_WORDS:
                self.clear()
            self[word] = made
        return made

    @staticmethod
    def _is_plain(word: str) -> bool:
        """Small letters alone, which normal form and splitting rules leave as they are?"""
        return word.isalpha() and word == word.lower() and max(word) < _PLAIN_END

    def _cut_words(self, word: str) -> list[str]:
        """The words of the vocabulary's own rules in normal form, a character for each byte."""
        small = word.lower() if word.isascii() else word
        if self._is_plain(small):
            return [small if small.isascii() else small.encode().decode("latin-1").translate(self.to_character)]
        normal = self.tokenizer.normalizer.normalize_str(word) if self.tokenizer.normalizer else word
        return [piece for piece, _ in self.tokenizer.pre_tokenizer.pre_tokenize_str(normal)]

    def _fragments(self, letters: str) -> Iterator[tuple[int, int]]:
        """Bounds of the fragments: a cut lies wherever a pair is inside no token."""
        start, last = 0, len(letters) - 1
        if last > 0 and letters[-2:] in self.final and self.inner.issuperset(map(add, letters, letters[1:-1])):
            yield 0, last + 1
            return
        for i, pair in enumerate(map(add, letters, letters[1:-1]), 1):
            if pair not in self.inner:
                yield start, i
                start = i
        if last > 0 and letters[-2:] not in self.final:
            yield start, last
            start = last
        if letters:
            yield start, last + 1

    def _merged(self, letters: str, ends: bool) -> list[int]:
        """Ids of a fragment: by the library's merges where it ends a word, as these add the ending, else by the ones below."""
        if ends:
            return [t.id for t in self.model.tokenize(letters)]
        ids = [self.vocabulary[c] for c in letters]
        return merge_scanned(ids, self.merges) if len(ids) <= SCANNED else merge_queued(ids, self.merges)

    def text(self, ids: list[int]) -> str:
        """The library's decoding: without a decoder of its own, the tokens joined by blanks."""
        if self.joined:
            return " ".join([self.tokens[i] for i in ids if i in self.tokens])
        return self.tokenizer.decode(ids, skip_special_tokens=False)


def pairs_inside(vocabulary, ending: str) -> tuple[frozenset[str], frozenset[str]]:
    """Pairs of byte characters that stand inside some token: anywhere, and at a word's end."""
    inner, final = set(), set()
    for token in vocabulary:
        letters = token[: -len(ending)] if token.endswith(ending) and token != ending else token
        pairs = [letters[i : i + 2] for i in range(len(letters) - 1)]
        if letters is not token and pairs:
            final.add(pairs.pop())
        inner.update(pairs)
    return frozenset(inner), frozenset(final)


def merge_scanned(ids: list[int], merges: dict) -> list[int]:
    """Merge the pair of lowest rank, the leftmost of equals, until none is left."""
    while len(ids) > 1:
        best, at = None, -1
        for i, pair in enumerate(zip(ids, ids[1:])):
            found = merges.get(pair)
            if found is not None and (best is None or found < best):
                best, at = found, i
        if best is None:
            break
        ids[at : at + 2] = [best[1]]
    return ids


def merge_queued(ids: list[int], merges: dict) -> list[int]:
    """The same with a queue of pairs and linked neighbours, for long fragments."""
    n = len(ids)
    after, before, ids = list(range(1, n + 1)), list(range(-1, n - 1)), list(ids)
    queue = [(merges[p][0], i, p) for i, p in enumerate(zip(ids, ids[1:])) if p in merges]
    heapq.heapify(queue)
    while queue:
        _, i, pair = heapq.heappop(queue)
        j = after[i] if ids[i] is not None else n
        if j >= n or (ids[i], ids[j]) != pair:
            continue
        ids[i], ids[j], after[i] = merges[pair][1], None, after[j]
        if after[i] < n:
            before[after[i]] = i
        for left, right in ((before[i], i), (i, after[i])):
            if left >= 0 and right < n and (p := (ids[left], ids[right])) in merges:
                heapq.heappush(queue, (merges[p][0], left, p))
    return [i for i in ids if i is not None]


def _byte_characters() -> dict[int, str]:
    """The character that stands for each byte in byte-level vocabularies: itself where it can be
    printed, else the next from U+0100 on."""
    printed = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    hidden = iter(range(0x100, 0x200))
    return {b: chr(b if b in printed else next(hidden)) for b in range(256)}


@lru_cache(maxsize=2)
def encoder_of(path: str) -> Encoder:
    """Kept between the tasks of a worker."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # the cores belong to other tasks
    return Encoder(path)


def _appended(df: DataFrame, column: str, fields: str, work) -> DataFrame:
    """All columns of ``df`` and those that ``work`` makes of ``column``, in batches of about ``STEP`` bytes."""
    names_of(df, [column])
    added = T._parse_datatype_string(fields)
    clash = {f.name.lower() for f in added} & {c.lower() for c in df.columns}
    if clash:
        raise ValueError(f"columns {sorted(clash)} are there already")

    def run(batches):
        for batch in batches:
            at = batch.schema.get_field_index(column)
            values = batch.column(at)
            flat = pa.types.is_list(values.type)
            parts = _list_slices(values) if flat else slices(values, STEP)
            for first, part in parts:
                rows = batch.slice(first, len(part))
                yield pa.RecordBatch.from_arrays([*rows.columns, *work(part)], names=[*batch.schema.names, *added.names])

    return df.mapInArrow(run, T.StructType([*df.schema.fields, *added.fields]))


def _list_slices(column: pa.Array) -> Iterator[tuple[int, pa.Array]]:
    """Slices of a column of lists with about ``STEP`` / 4 entries each."""
    ends = np.cumsum(column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))
    first = 0
    while first < len(column):
        base = int(ends[first - 1]) if first else 0
        last = max(first + 1, int(np.searchsorted(ends, base + STEP // 4, side="right")))
        yield first, column.slice(first, last - first)
        first = last


def _encoded(encoder: Encoder, texts: pa.Array) -> list[bytes]:
    return [encoder.ids(t.as_py() or "") for t in texts]


def _ids_array(made: list[bytes]) -> pa.Array:
    ends = np.zeros(len(made) + 1, np.int32)
    np.cumsum([len(m) // 4 for m in made], out=ends[1:])
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(made), np.int32)))


def encode(docs: DataFrame, tokenizer: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """Adds ``ids`` array<int>: the ids of the whole text, without added ones at its ends.

    Special tokens spelled in a text count as such. A null or empty text has an empty array. All
    other columns stay; a name that is there already raises ``ValueError``. Rows do not depend on
    one another: ties, repeated rows and null keys are as any other, an empty table gives one.
    """

    def work(texts):
        return [_ids_array(_encoded(encoder_of(tokenizer), texts))]

    return _appended(docs, text, f"`{ids}` array<int>", work)


def decode(rows: DataFrame, tokenizer: str, ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """Adds ``decoded`` string: the text of an array of ids, special tokens included.

    Ids outside the vocabulary and null ids give nothing, a null or empty array the empty text.
    """

    def work(lists):
        encoder = encoder_of(tokenizer)
        return [pa.array([encoder.text([i for i in one.as_py() or () if i is not None]) for one in lists], pa.string())]

    return _appended(rows, ids, f"`{decoded}` string", work)


def round_trip(docs: DataFrame, tokenizer: str, text: str = "text") -> DataFrame:
    """``encode`` and ``decode`` in one pass: adds ids array<int> and decoded string."""

    def work(texts):
        encoder = encoder_of(tokenizer)
        made = _encoded(encoder, texts)
        return [_ids_array(made), pa.array([encoder.text(array("i", m).tolist()) for m in made], pa.string())]

    return _appended(docs, text, "ids array<int>, decoded string", work)


def digests(rows: DataFrame, key: str = "doc_id") -> DataFrame:
    """key, n_tokens, ids_sha256 (decimal ids joined by one blank) and decoded_sha256 of encoded and decoded rows."""
    written = F.concat_ws(" ", F.col("ids").cast("array<string>"))
    return rows.select(
        F.col(key),
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(written.cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )
