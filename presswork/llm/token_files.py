"""Token ids of a corpus as Arrow files of fixed-size-list batches.

Documents are dealt by ranges of their key and sorted, so the files in order hold the ids of all
documents in ascending key order. A task encodes its documents and writes its ids as sequences of
equal length with a bit mask (0 for padding, in the last sequence of a file only), a batch at a time;
an index file beside it has each document's start. Readers map the file and reach any sequence,
or any document's ids, without copying.

Encoding keeps the ids of words that a worker has met: no token reaches over white space, and
the vocabulary's rules look at no neighbour beyond it, so a text's ids are those of its words.
"""

from __future__ import annotations

import re
import zlib
from array import array
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from presswork.llm.files import filesystem, new_file, new_folder, open_out, open_random
from presswork.llm.shared import arrow_rows, names_of, whole_text
from presswork.plans.stage import staged

LENGTH = 2048
KEPT_WORDS = 1_000_000
# sequences of a batch of a file
BATCH = 256
# text of a file, about
PART_BYTES = 64 << 20


class WordEncoder(dict):
    """Ids of words as bytes of ``kind``, the smallest unsigned type that holds the vocabulary.

    A word that is met first is encoded then.

    The whole tokenizer encodes texts that spell a special token, and words with anything but
    small Latin letters. Words of those letters alone pass its normaliser and splitting rule
    unchanged, so they go to its model at once; a full stop or comma after one is a token apart.
    """

    def __init__(self, path: str):
        super().__init__()
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.shown = _byte_characters()
        self.kind = id_type(self.tokenizer.get_vocab_size())

    def ids(self, text: str) -> bytes:
        small = _lower(text)
        if any(s in small for s in self.special):
            return self._whole(text)
        if not small.isascii() and _JOINING.search(small):
            # a normal form may join a capital with what follows it, so such words keep their letters
            return b"".join(self[_lower(w) if w.isascii() else w] for w in _BLANKS.split(text))
        return b"".join(map(self.__getitem__, small.split(" ")))

    def _whole(self, text: str) -> bytes:
        return array(self.kind.char, self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def __missing__(self, word: str) -> bytes:
        if len(self) >= KEPT_WORDS:
            self.clear()
        if _plain(word):
            shown = word if word.isascii() else word.encode().decode("latin-1").translate(self.shown)
            found = array(self.kind.char, [t.id for t in self.model.tokenize(shown)]).tobytes()
        elif len(word) > 1 and word[-1] in ".," and _plain(word[:-1]):
            found = self[word[:-1]] + self[word[-1]]
        else:
            found = self._whole(word)
        self[word] = found
        return found


def id_type(vocabulary: int) -> np.dtype:
    return np.dtype(np.uint16 if vocabulary <= 1 << 16 else np.uint32)


_UPPER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)} | {c: 0x20 for c in range(0x09, 0x0E)}
_BYTES = bytes(_UPPER.get(i, i) for i in range(256))


_JOINING = re.compile("[^\x00-\u02ff]")
_BLANKS = re.compile("[\t-\r ]+")


def _lower(text: str) -> str:
    """Small letters for A-Z, and a blank for each white-space character of ASCII."""
    return text.encode().translate(_BYTES).decode()


def _plain(word: str) -> bool:
    return word.isalpha() and word.islower() and max(word) < "\u0250"


def _byte_characters() -> dict[int, int]:
    """The character that stands for each byte in byte-level vocabularies: itself where it can be
    printed, else the next from U+0100 on."""
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    hidden = [b for b in range(256) if b not in shown]
    return {b: 0x100 + i for i, b in enumerate(hidden)}


@lru_cache(maxsize=2)
def encoder_of(path: str) -> WordEncoder:
    """Kept between the tasks of a worker."""
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # the cores belong to other tasks
    return WordEncoder(path)


INDEX = pa.schema([("place", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64())])


class _Writer:
    """Packs ids into sequences and writes them in batches."""

    def __init__(self, path: str, length: int, kind: np.dtype):
        self.length, self.kind, self.rest, self.total, self.held = length, kind, [], 0, 0
        self.schema = pa.schema([("ids", pa.list_(pa.from_numpy_dtype(kind), length)), ("mask", pa.list_(pa.bool_(), length))])
        self.out = open_out(path)
        self.file = pa.ipc.new_file(self.out, self.schema)

    def add(self, ids: bytes) -> None:
        self.rest.append(ids)
        self.held += len(ids)
        self.total += len(ids) // self.kind.itemsize
        if self.held >= self.kind.itemsize * self.length * BATCH:
            self._flush(self.length * BATCH)

    def _flush(self, step: int) -> None:
        flat = np.frombuffer(b"".join(self.rest), dtype=self.kind)
        whole = len(flat) // step * step
        for at in range(0, whole, step):
            self._write(flat[at : at + step], np.ones(step, bool))
        self.rest, self.held = [flat[whole:].tobytes()], self.kind.itemsize * (len(flat) - whole)

    def _write(self, ids: np.ndarray, mask: np.ndarray) -> None:
        arrays = [pa.FixedSizeListArray.from_arrays(pa.array(x), type=f.type) for x, f in zip((ids, mask), self.schema, strict=True)]
        self.file.write_batch(pa.RecordBatch.from_arrays(arrays, schema=self.schema))

    def close(self) -> None:
        flat = np.frombuffer(b"".join(self.rest), dtype=self.kind)
        padded = -(-len(flat) // self.length) * self.length
        if padded:
            mask = np.zeros(padded, bool)
            mask[: len(flat)] = True
            self._write(np.concatenate([flat, np.zeros(padded - len(flat), self.kind)]), mask)
        self.file.close()
        self.out.close()


def write_token_files(
    docs: DataFrame, tokenizer: str, end: int, key: str = "doc_id", text: str = "text", length: int = LENGTH, folder: str | None = None
) -> DataFrame:
    """Write the ids of all documents in ascending key order; returns the table of files, in order:

    part, tokens (path), index (path), n_docs, n_tokens, start (ids in the files before it).
    ``end`` follows each document. A null text counts as empty, a null key comes first; rows with
    the same key follow each other by the hash of their texts, so that one key may fill many files.
    There is a file for ``PART_BYTES`` of text, and as many as shuffle partitions at least. Empty
    parts write no file. Other columns are not read.
    """
    names_of(docs, [key, text])
    folder = folder or new_folder(docs.sparkSession, "tokens")
    rows = docs.select(F.col(key).alias("place"), whole_text(text).alias("text"))
    size = rows.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    parts = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-size // PART_BYTES), 1)
    order = [F.col("place").asc_nulls_first(), F.col("hash")]
    ordered = rows.withColumn("hash", F.xxhash64("text")).repartitionByRange(parts, *order).sortWithinPartitions(*order).drop("hash")

    def write(batches):
        from pyspark import TaskContext

        encoder = encoder_of(tokenizer)
        last = np.array([end], dtype=encoder.kind).tobytes()
        writer, index, out, n = None, None, None, 0
        for batch in batches:
            if not len(batch):
                continue
            if writer is None:
                tokens, beside = new_file(folder, ".arrow"), new_file(folder, ".index.arrow")
                writer, out = _Writer(tokens, length, encoder.kind), open_out(beside)
                index = pa.ipc.new_file(out, INDEX)
            starts, sizes = [], []
            for text_ in batch.column("text"):
                ids = encoder.ids(text_.as_py()) + last
                starts.append(writer.total)
                sizes.append(len(ids) // encoder.kind.itemsize)
                writer.add(ids)
            index.write_batch(pa.RecordBatch.from_arrays([batch.column("place").cast(pa.int64()), pa.array(starts, pa.int64()), pa.array(sizes, pa.int64())], schema=INDEX))
            n += len(batch)
        if writer is not None:
            writer.close()
            index.close()
            out.close()
            yield {"part": [TaskContext.get().partitionId()], "tokens": [tokens], "index": [beside], "n_docs": [n], "n_tokens": [writer.total]}

    files = staged(arrow_rows(ordered, write, "part int, tokens string, index string, n_docs long, n_tokens long"), "token-files")
    # one row per file
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return files.withColumn("start", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)))


class TokenFile:
    """Random access to the sequences and documents of one file."""

    def __init__(self, path: str):
        self.source = open_random(path)
        self.file = pa.ipc.open_file(self.source)
        self.length = self.file.schema.field("ids").type.list_size
        sizes = [self.file.get_batch(i).num_rows for i in range(self.file.num_record_batches)]
        self.starts = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)

    def sequence(self, i: int) -> tuple[np.ndarray, pa.BooleanArray]:
        """Ids and mask of the i-th sequence, both views of the file; the mask keeps its bits packed."""
        b = int(np.searchsorted(self.starts, i, side="right")) - 1
        batch, at = self.file.get_batch(b), i - int(self.starts[b])
        ids, mask = (batch.column(c).values.slice(at * self.length, self.length) for c in (0, 1))
        return ids.to_numpy(), mask

    def ids(self, start: int, n: int) -> np.ndarray:
        """``n`` ids from the ``start``-th on; a view where they lie in one batch."""
        found = []
        while n > 0:
            b = int(np.searchsorted(self.starts, start // self.length, side="right")) - 1
            flat = self.file.get_batch(b).column(0).values.to_numpy()
            at = start - int(self.starts[b]) * self.length
            part = flat[at : at + n]
            found.append(part)
            start, n = start + len(part), n - len(part)
        return found[0] if len(found) == 1 else np.concatenate(found or [np.empty(0, np.uint16)])

    def close(self) -> None:
        self.source.close()


def read_documents(files: DataFrame, key: str = "doc_id") -> DataFrame:
    """One row per document, from the files: key, start, n_tokens, ids_crc32."""

    def read(batches):
        for batch in batches:
            for row in batch.to_pylist():
                tokens = TokenFile(row["tokens"])
                with open_random(row["index"]) as source:
                    index = pa.ipc.open_file(source)
                    for i in range(index.num_record_batches):
                        part = index.get_batch(i)
                        starts, sizes = part.column("start").to_numpy(), part.column("n_tokens").to_numpy()
                        sums = [zlib.crc32(tokens.ids(int(s), int(n)).astype("<u4")) for s, n in zip(starts, sizes, strict=True)]
                        yield {key: part.column("place"), "start": starts + row["start"], "n_tokens": sizes, "ids_crc32": sums}
                tokens.close()

    spread = files.select("tokens", "index", "start").repartition(max(1, files.count()), "tokens")
    return arrow_rows(spread, read, f"{key} long, start long, n_tokens long, ids_crc32 long")


def remove(files: DataFrame) -> None:
    """Delete the files; what is read from them must have been written elsewhere."""
    for row in files.select("tokens", "index").toLocalIterator():
        for path in row:
            fs, place = filesystem(path)
            fs.delete_file(place)
