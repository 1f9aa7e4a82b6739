"""Sampled segmentations against enumerated lattices, and round trips of any text."""

import collections
import math
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from presswork.llm import sentencepiece_codec as sp

PATH = public_tokenizers.path("piece_bpe_32k.model")
ENCODER = sp.Encoder(PATH, seed=5)


def ways(text):
    """Every segmentation of a text into pieces with its probability, by recursion over the text."""
    model = sentencepiece.SentencePieceProcessor(model_file=PATH)
    weight = {}
    for i in range(model.get_piece_size()):
        if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i)):
            weight[model.id_to_piece(i)] = (i, 1 / (min(-model.get_score(i), 32000.0) + 1))

    def from_(rest):
        if not rest:
            yield (), 1.0
        for k in range(1, min(16, len(rest)) + 1):
            if rest[:k] in weight:
                i, w = weight[rest[:k]]
                for tail, p in from_(rest[k:]):
                    yield (i, *tail), w * p

    found = list(from_("▁" + text.replace(" ", "▁")))
    whole = math.fsum(p for _, p in found)
    return {w: p / whole for w, p in found}


def one(encoder, text, key=0):
    ids, _ = encoder.encode(pa.array([text]), np.array([key]))
    return tuple(ids.tolist())


@pytest.mark.parametrize("text", ["the", "  in it", "other", "ab c"])
def test_frequencies_are_those_of_the_lattice(text):
    n = 40_000
    expected = ways(text)
    ids, bounds = ENCODER.encode(pa.array([text] * n), np.arange(n))
    got = collections.Counter(tuple(ids[a:b].tolist()) for a, b in zip(bounds[:-1], bounds[1:], strict=True))
    assert set(got) <= set(expected)
    for way, p in expected.items():
        assert abs(got[way] / n - p) < 5 * math.sqrt(p * (1 - p) / n) + 1e-4


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(st.characters(exclude_categories=["Cs"]), max_size=30) | st.text("a ▁é\n<>", max_size=20), max_size=6))
def test_any_texts_come_back_and_ignore_their_neighbours(texts):
    keys = np.arange(len(texts)) * 7 + 1
    ids, bounds = ENCODER.encode(pa.array(texts, pa.string()), keys)
    fresh = sp.Encoder(PATH, seed=5)
    for i, text in enumerate(texts):
        mine = ids[bounds[i] : bounds[i + 1]]
        assert ENCODER.decode(mine) == text
        assert tuple(mine.tolist()) == one(fresh, text, keys[i])


def test_dropping_kept_lattices_changes_nothing(monkeypatch):
    texts = pa.array([f"wordle{i} thing other{i}" for i in range(50)])
    keys = np.arange(50)
    whole = ENCODER.encode(texts, keys)[0]
    monkeypatch.setattr(sp, "KEPT_CHARACTERS", 10)
    fresh = sp.Encoder(PATH, seed=5)
    parts = [fresh.encode(texts.slice(i, 5), keys[i : i + 5])[0] for i in range(0, 50, 5)]
    assert np.array_equal(whole, np.concatenate(parts))


def test_sharper_weights_and_other_seeds_sample_differently():
    text = "information about everything " * 20
    assert one(ENCODER, text) != one(sp.Encoder(PATH, seed=6), text)
    sharp = one(sp.Encoder(PATH, sharpness=20.0), text)
    assert len(sharp) < len(one(sp.Encoder(PATH, sharpness=0.0), text))


def test_documents(spark):
    long_text = "long wörds " * 30_000
    rows = [(1, "Hello there", "a"), (2, None, None), (3, "", "x"), (4, long_text, "x"), (1, "Hello there", "b"), (None, "null key", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_pieces_ string")
    encoded = sp.encode(docs, PATH)
    assert encoded.columns == [*docs.columns, "ids"]
    back = sp.decode(encoded, PATH).collect()
    assert [r.decoded for r in back] == [r.text or "" for r in back]
    assert [r.ids for r in back if r.doc_id in (2, 3)] == [[], []]
    assert len({tuple(r.ids) for r in back if r.doc_id == 1}) == 1
    ids = sorted((len(r.ids), zlib.crc32(np.array(r.ids, "<u4").tobytes())) for r in back)
    got = sp.round_trip(docs, PATH).collect()
    assert all(r.lossless for r in got) and len(got) == len(rows)
    assert sorted((r.n_pieces, r.pieces_crc32) for r in got) == ids
    assert sp.round_trip(docs.where("false"), PATH).count() == 0
    with pytest.raises(ValueError):
        sp.encode(docs.withColumnRenamed("n_pieces_", "IDS"), PATH)
