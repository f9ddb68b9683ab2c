"""The two ways to merge a segment, and runs remembered in parts, without Spark."""

import random

import pytest

from stratacast.llm.pieces import LONG, SPACE, PieceModel, SegmentEncoder
from stratacast.llm.queries import tokenizer_file


@pytest.fixture(scope="module")
def model():
    return PieceModel.read(tokenizer_file("piece_bpe_32k.model"))


def test_short_merges_equal_merges_by_edges(model):
    draw = random.Random(3)
    pieces = sorted(model.pieces)
    made = ["".join(draw.choices(pieces, k=draw.randint(1, 4))) for _ in range(3000)]
    made += ["".join(draw.choices("aeinrst.,!*ßéЖ漢\U0001f600", k=draw.randint(1, LONG))) for _ in range(2000)]
    made += [SPACE * n for n in range(1, LONG + 1)] + sorted(model.odd) + ["a" * LONG, "a" * (LONG + 1)]
    for segment in made:
        assert model._merged(segment) == model._merged_by_edges(segment), segment


def test_runs_in_parts_equal_whole_segments(model):
    draw = random.Random(5)
    ends = ["", ".", ",", "...", "***", "'s", "!)", ".\n", "\n,", "$$$."]
    words = ["the", "erte", "Haus", "ñado", "x", "", "(", "漢字", "don't", "\t"]
    texts = ["", ".", "...", "a", " ."] + [
        " ".join(draw.choice(words) + draw.choice(ends) for _ in range(draw.randint(1, 12))) for _ in range(800)
    ]
    ids, counts = SegmentEncoder(model, {}).encode(texts)
    at = 0
    for text, n in zip(texts, counts.tolist(), strict=True):
        assert ids[at : at + n].tolist() == [i for s in model.segments(text) for i in model.fold(s)], text
        at += n
