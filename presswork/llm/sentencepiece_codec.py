"""SentencePiece encoding by forward filtering and backward sampling, and lossless decoding.

A text becomes a run of units; pieces never reach over a unit's border: a unit is a word with the
blanks before it, and a character that no longer piece contains is a unit of its own. So the lattice
of a text is the chain of its units' lattices, and each unit is sampled on its own. Lattices of new
units of a batch are built and filtered forward together in numpy and kept for later batches; the
kept ones are dropped when they exceed ``KEPT_CHARACTERS``. Backward sampling runs over all units of
a batch at once. Each random number comes from the seed, the row's key and the place in the text, so
a rerun, in whatever batch or task, samples the same pieces.

The vocabulary's scores are merge ranks; a piece of rank r gets the weight (r + 1) ** -``sharpness``.
A character that is no piece, and the blank's stand-in if it occurs in a text, is spelled in bytes.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from presswork.llm.shared import add_columns, mix64, names_of, pieces, unit_interval, utf8
from presswork.llm.words import Sums

BLANK = 0x2581  # the vocabulary's stand-in for a blank
LITERAL = 0x110000  # a stand-in that occurs in a text itself
KEPT_CHARACTERS = 600_000
# bytes of text that are encoded together
TOGETHER = 500_000
SHARPNESS = 1.0
_GOLD = np.uint64(0x9E3779B97F4A7C15)


class Vocabulary:
    """Pieces of a model file, with a hash table of the pieces and of all their beginnings."""

    def __init__(self, path: str, sharpness: float = SHARPNESS):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = model.get_piece_size()
        self.piece_bytes: list[bytes] = []
        self.byte_piece = np.zeros(256, dtype=np.int64)
        strings: dict[str, tuple[int, float]] = {}
        for i in range(n):
            text = model.id_to_piece(i)
            if model.is_byte(i):
                self.byte_piece[int(text[3:5], 16)] = i
                self.piece_bytes.append(bytes([int(text[3:5], 16)]))
            elif model.is_control(i) or model.is_unknown(i):
                self.piece_bytes.append(b"")
            else:
                self.piece_bytes.append(text.replace(chr(BLANK), " ").encode())
                rank = min(max(-model.get_score(i), 0.0), float(n))
                strings[text] = (i, -sharpness * float(np.log(rank + 1.0)))
        self.byte_weight = -sharpness * float(np.log(n + 1.0))
        begins = {text[:k] for text in strings for k in range(1, len(text) + 1)}
        self.longest = max(map(len, strings), default=1)
        self.joined = np.zeros(LITERAL + 1, dtype=bool)  # characters of longer pieces
        for text in strings:
            if len(text) > 1:
                self.joined[[ord(c) for c in text]] = True
        known = sorted(begins)
        flat = np.array([ord(c) for text in known for c in text], dtype=np.uint64)
        ends = np.cumsum([len(text) for text in known]) if known else np.zeros(0, np.int64)
        keys = Sums(flat + np.uint64(1)).keys(ends - np.array([len(text) for text in known], dtype=np.int64), ends)
        if len(np.unique(keys)) != len(keys):
            raise ValueError("two beginnings of pieces share a key")
        self._table(keys, [strings.get(text, (-1, 0.0)) for text in known])

    def _table(self, keys, found):
        self.bits = max(4, int(np.ceil(np.log2(max(1, len(keys)) * 4))))
        self.slots = np.zeros(1 << self.bits, dtype=np.uint64)
        self.ids = np.full(1 << self.bits, -2, dtype=np.int32)
        self.weights = np.zeros(1 << self.bits)
        for key, (i, weight) in zip(keys.tolist(), found, strict=True):
            slot = key & ((1 << self.bits) - 1)
            while self.ids[slot] != -2:
                slot = (slot + 1) & ((1 << self.bits) - 1)
            self.slots[slot], self.ids[slot], self.weights[slot] = key, i, weight

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each key: the piece, or -1 if pieces only begin so, or -2; and its log weight."""
        mask = np.uint64((1 << self.bits) - 1)
        slot = (keys & mask).astype(np.int64)
        ids = self.ids[slot]
        wrong = np.flatnonzero((ids != -2) & (self.slots[slot] != keys))
        while len(wrong):
            slot[wrong] = (slot[wrong] + 1) & int(mask)
            ids[wrong] = self.ids[slot[wrong]]
            wrong = wrong[(ids[wrong] != -2) & (self.slots[slot[wrong]] != keys[wrong])]
        return ids, self.weights[slot]

    def decode(self, ids) -> str:
        """The text of a sequence of pieces, without the blank put before each text."""
        table = self.piece_bytes
        return b"".join([table[i] for i in ids])[1:].decode("utf-8")


class Lattices:
    """Forward-filtered lattices of units, as edges sorted by the node they end in.

    Node = place between two characters of a unit. ``first``: its first edge; ``share``: the edges'
    cumulative probabilities given their end node; ``back``: length of the piece; ``piece``: its
    number, or -1 for a character in bytes.
    """

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self.clear()

    def clear(self):
        self.keys = np.empty(0, np.uint64)
        self.base = np.empty(0, np.int64)
        self.first = np.zeros(1, np.int64)
        self.share, self.back = np.empty(0), np.empty(0, np.int32)
        self.piece = np.empty(0, np.int32)

    def places(self, keys: np.ndarray, points: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """The base node of each unit (unique ``keys``); unknown units are added first."""
        if len(self.first) > KEPT_CHARACTERS:
            self.clear()
        at = np.searchsorted(self.keys, keys)
        new = np.ones(len(keys), dtype=bool) if not len(self.keys) else self.keys[np.minimum(at, len(self.keys) - 1)] != keys
        if new.any():
            base = self._add(points, start[new], end[new])
            merged = np.concatenate([self.keys, keys[new]])
            order = np.argsort(merged, kind="stable")
            self.keys, self.base = merged[order], np.concatenate([self.base, base])[order]
            at = np.searchsorted(self.keys, keys)
        return self.base[at]

    def _add(self, points, start, end):
        """Lattices of the units points[start:end]; node k of a unit ends its k-th character."""
        voc, size = self.vocabulary, end - start
        first = np.concatenate([[0], np.cumsum(size)])
        at = np.arange(first[-1]) + np.repeat(start - first[:-1], size)
        chars = points[at].astype(np.uint64)
        left = np.repeat(first[1:], size) - np.arange(len(chars))  # characters to the unit's end
        sums = Sums(chars + np.uint64(1))
        live = np.arange(len(chars))
        tails, ends, ids, weights = [], [], [], []
        whole = np.zeros(len(chars), dtype=bool)
        for n in range(1, voc.longest + 1):
            live = live[left[live] >= n]
            found, weight = voc.find(sums.keys(live, live + n))
            hit = found >= 0
            tails.append(live[hit])
            ends.append(live[hit] + n - 1)
            ids.append(found[hit])
            weights.append(weight[hit])
            if n == 1:
                whole[live[hit]] = True
            live = live[found >= -1]
        spelled = np.flatnonzero(~whole)
        tail = np.concatenate([*tails, spelled])
        last = np.concatenate([*ends, spelled])
        piece = np.concatenate([*ids, np.full(len(spelled), -1, np.int32)])
        count = 1 + (chars[spelled] >= 0x80) + (chars[spelled] >= 0x800) + (chars[spelled] >= 0x10000)
        count[chars[spelled] == LITERAL] = 3
        weight = np.concatenate([*weights, count * voc.byte_weight])
        # by place in the unit, so that the edges of one place are a slice over all units
        place = np.arange(len(chars)) - np.repeat(first[:-1], size)
        order = np.lexsort((tail, last, place[last]))
        tail, last, piece, weight = tail[order], last[order], piece[order], weight[order]
        reach = np.full(len(chars) + 1, 0.0)  # log weight of all ways to a node; the last entry is any unit's start
        begun = np.where(place[tail] == 0, len(chars), tail - 1)
        share = np.empty(len(tail))
        steps = np.searchsorted(place[last], np.arange(int(size.max(initial=0)) + 1))
        for low, high in zip(steps[:-1], steps[1:], strict=True):
            total = weight[low:high] + reach[begun[low:high]]
            node = last[low:high]
            heads = np.flatnonzero(np.concatenate([[True], node[1:] != node[:-1]]))
            group = np.cumsum(np.concatenate([[0], node[1:] != node[:-1]]))
            top = np.maximum.reduceat(total, heads)
            part = np.exp(total - top[group])
            # summed edge by edge, so that a unit's numbers don't depend on its neighbours
            turn = np.arange(high - low) - heads[group]
            for k in range(1, int(turn.max()) + 1):
                mine = np.flatnonzero(turn == k)
                part[mine] += part[mine - 1]
            ends_ = np.append(heads[1:], high - low) - 1
            sums_ = part[ends_]
            share[low:high] = part / sums_[group]
            share[low:high][ends_] = 2.0  # the last edge takes what rounding leaves
            reach[node[heads]] = top + np.log(sums_)
        order = np.lexsort((tail, last))
        base = first[:-1] + len(self.first) - 1
        edges = np.searchsorted(last[order], np.arange(1, len(chars) + 1)) + len(self.share)
        self.first = np.concatenate([self.first, edges])
        self.share = np.concatenate([self.share, share[order]])
        self.back = np.concatenate([self.back, (last - tail + 1)[order].astype(np.int32)])
        self.piece = np.concatenate([self.piece, piece[order].astype(np.int32)])
        return base

    def sample(self, base, size, end, origin, key) -> tuple[np.ndarray, np.ndarray]:
        """Sample each unit back from its end: (first character, piece) of all pieces, in no order.

        ``end``: end of the unit in the batch; ``origin``: start of its text there; ``key``: of its row.
        """
        starts, found = [], []
        node, left, place = base + size - 1, size.copy(), end.copy()
        while len(node):
            u = unit_interval(mix64(key + (place - origin).astype(np.uint64) * _GOLD))
            edge = self.first[node]
            over = np.flatnonzero(u > self.share[edge])
            while len(over):
                edge[over] += 1
                over = over[u[over] > self.share[edge[over]]]
            back = self.back[edge].astype(np.int64)
            place = place - back
            starts.append(place)
            found.append(self.piece[edge])
            node, left = node - back, left - back
            more = left > 0
            node, left, place, origin, key = node[more], left[more], place[more], origin[more], key[more]
        return (np.concatenate(starts), np.concatenate(found)) if starts else (np.empty(0, np.int64), np.empty(0, np.int32))


@lru_cache(maxsize=4)
def vocabulary_of(path: str, sharpness: float = SHARPNESS) -> Vocabulary:
    return Vocabulary(path, sharpness)


@lru_cache(maxsize=2)
def encoder_of(path: str, sharpness: float, seed: int) -> Encoder:
    """Kept between the tasks of a worker, with the lattices it has built."""
    return Encoder(path, sharpness, seed)


class Encoder:
    def __init__(self, path: str, sharpness: float = SHARPNESS, seed: int = 0):
        self.vocabulary = vocabulary_of(path, sharpness)
        self.lattices = Lattices(self.vocabulary)
        self.seed = np.uint64(seed % (1 << 64))

    def encode(self, column: pa.Array, row_keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sampled pieces of all texts, and each text's bounds in them; an empty text has none."""
        voc = self.vocabulary
        flat, bounds = utf8(column)
        points = np.frombuffer(flat.tobytes().decode("utf-8").encode("utf-32-le"), dtype=np.uint32).astype(np.int64)
        lead = np.empty(len(flat) + 1, dtype=np.int64)
        lead[0] = 0
        np.cumsum((flat & 0xC0) != 0x80, out=lead[1:])
        bounds = lead[bounds]
        # a blank before each text that is not empty
        some = np.diff(bounds) > 0
        origin = bounds[:-1] + np.concatenate([[0], np.cumsum(some)[:-1]])
        chars = np.empty(len(points) + int(some.sum()), dtype=np.int64)
        fresh = np.zeros(len(chars), dtype=bool)
        fresh[origin[some]] = True
        chars[fresh] = BLANK
        points = np.where(points == BLANK, LITERAL, points)
        chars[~fresh] = np.where(points == 0x20, BLANK, points)
        if not len(chars):
            return np.empty(0, np.int64), np.zeros(len(bounds), np.int64)
        blank, apart = chars == BLANK, ~voc.joined[chars]
        begins = fresh.copy()
        begins[1:] |= (blank[1:] & ~blank[:-1]) | apart[1:] | apart[:-1]
        start = np.flatnonzero(begins)
        end = np.append(start[1:], len(chars))
        keys = Sums(chars.astype(np.uint64) + np.uint64(1)).keys(start, end)
        unique, one, which = np.unique(keys, return_index=True, return_inverse=True)
        base = self.lattices.places(unique, chars, start[one], end[one])[which]
        row = np.searchsorted(origin[some], start, side="right") - 1
        seeds = mix64(row_keys.astype(np.uint64) + mix64(np.array([self.seed])))
        at, piece = self.lattices.sample(base, end - start, end, origin[some][row], seeds[some][row])
        placed = np.full(len(chars), -2, dtype=np.int32)
        placed[at] = piece
        begun = np.flatnonzero(placed != -2)
        ids = placed[begun].astype(np.int64)
        spelled = np.flatnonzero(ids == -1)
        if len(spelled):
            values = np.where(chars[begun[spelled]] == LITERAL, BLANK, chars[begun[spelled]])
            many = 1 + (values >= 0x80) + (values >= 0x800) + (values >= 0x10000)
            count = np.ones(len(ids), dtype=np.int64)
            count[spelled] = many
            raw = np.frombuffer("".join(map(chr, values.tolist())).encode("utf-8"), dtype=np.uint8)
            places = np.cumsum(count) - count
            ids = np.repeat(ids, count)
            ids[ids == -1] = voc.byte_piece[raw]
            bounds_ = np.append(places, len(ids))[np.searchsorted(begun, np.append(origin, len(chars)))]
            return ids, bounds_
        return ids, np.searchsorted(begun, np.append(origin, len(chars)))

    def decode(self, ids: np.ndarray) -> str:
        return self.vocabulary.decode(ids.tolist())


def encode(
    docs: DataFrame, path: str, key: str = "doc_id", text: str = "text", seed: int = 0, sharpness: float = SHARPNESS, name: str = "ids"
) -> DataFrame:
    """``docs`` with one more column: the sampled pieces of each text as an array of ints.

    A null or empty text has no pieces. Rows with the same key and text get the same pieces; null
    keys share one seed. ``path`` names the vocabulary on every executor.
    """
    names_of(docs, [key, text])
    row = f"_{name}_row"

    def run(batches):
        for batch in batches:
            parts, ends = [], [np.zeros(1, np.int64)]
            for _, ids, bounds in _encoded(batch, text, row, path, sharpness, seed):
                parts.append(ids.astype(np.int32))
                ends.append(bounds[1:] + ends[-1][-1])
            flat = np.concatenate(parts) if parts else np.empty(0, np.int32)
            yield {name: pa.ListArray.from_arrays(pa.array(np.concatenate(ends).astype(np.int32)), pa.array(flat))}

    return add_columns(_keyed(docs, key, row), run, f"{name} array<int>").drop(row)


def _keyed(docs: DataFrame, key: str, row: str) -> DataFrame:
    return docs.withColumn(row, F.xxhash64(F.col(key)))


def _encoded(batch, text, row, path, sharpness, seed):
    """(rows, ids, bounds) of one slice of a batch after the other."""
    encoder = encoder_of(path, sharpness, seed)
    keys = batch.column(row).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
    for first, part in pieces(batch, text, TOGETHER):
        yield part, *encoder.encode(part, keys[first : first + len(part)])


def decode(encoded: DataFrame, path: str, ids: str = "ids", name: str = "decoded") -> DataFrame:
    """``encoded`` with the texts that its pieces spell; null ids give an empty text."""

    def run(batches):
        vocabulary = vocabulary_of(path)
        for batch in batches:
            yield {name: [vocabulary.decode(one or []) for one in batch.column(ids).to_pylist()]}

    return add_columns(encoded, run, f"{name} string")


def round_trip(
    docs: DataFrame, path: str, key: str = "doc_id", text: str = "text", seed: int = 0, sharpness: float = SHARPNESS
) -> DataFrame:
    """``docs`` with the digest of its sampled pieces, encoded and decoded in one pass:

    n_pieces, pieces_crc32 (of the ids as little-endian unsigned 32-bit integers) and lossless
    (decoding gives the text back; a null text counts as empty).
    """
    names_of(docs, [key, text])
    row = "_digest_row"

    def run(batches):
        import zlib

        vocabulary = vocabulary_of(path, sharpness)
        for batch in batches:
            out: dict[str, list] = {"n_pieces": [], "pieces_crc32": [], "lossless": []}
            for part, ids, bounds in _encoded(batch, text, row, path, sharpness, seed):
                small = ids.astype("<u4")
                for i, one in enumerate(part):
                    mine = small[bounds[i] : bounds[i + 1]]
                    out["n_pieces"].append(len(mine))
                    out["pieces_crc32"].append(zlib.crc32(mine))
                    out["lossless"].append(vocabulary.decode(mine.tolist()) == (one.as_py() or ""))
            yield out

    return add_columns(_keyed(docs, key, row), run, "n_pieces long, pieces_crc32 long, lossless boolean").drop(row)
