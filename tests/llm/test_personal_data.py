"""The random field: no text stops it, and its segmentation is the best of all."""

from __future__ import annotations

import random
import zlib

import pytest

from driftlake.llm import pii


class Weights(dict):
    """A fixed weight for every feature, so that all candidates compete."""

    def get(self, name, default=0.0):
        return zlib.crc32(name.encode()) % 1000 / 300 - 1.3


def made_texts(n, letters, seed, most=26):
    rng = random.Random(seed)
    return ["".join(rng.choice(letters) for _ in range(rng.randint(0, most))) for _ in range(n)]


def test_no_text_stops_the_field():
    for text in made_texts(60_000, "0123456789.-+()@ ", 3):
        base, every = pii.all_spans(text, Weights())
        assert set(base) <= set(every) and all(text[a:b] == text[a:b].strip() for _, a, b in every)


@pytest.mark.parametrize("text", ["192.168.1.1-5", "10.0.0.1-9", "sections 3.1.2-3.4", "1.2+3.4.5", "1.2.3.4.5.6.7", "²1.1.1.1", "9" * 5000, "1 " * 5000])
def test_number_lists(spark, text):
    base, every = pii.all_spans(text, Weights())
    assert set(base) <= set(every)
    docs = spark.createDataFrame([(1, text, "c"), (2, None, None), (None, "", "d")], "doc_id long, text string, spans string")
    assert pii.find(docs, {}).count() == 3 and pii.mask(docs, {}).columns == docs.columns
    assert isinstance(pii.train(docs), dict)


def every_segmentation(region, j):
    """Each way to cut the first ``j`` atoms: its score by the weights and its spans."""
    if j == 0:
        yield 0.0, ()
        return
    for score, spans in every_segmentation(region, j - 1):
        yield score, spans
    for i, kind, names in region.ending_at(j):
        gain = sum(Weights().get(x) for x in names)
        for score, spans in every_segmentation(region, i):
            yield score + gain, (*spans, (kind, region.cuts[i], region.cuts[j]))


def test_best_of_all_segmentations():
    tried = 0
    for text in made_texts(4000, "12345.-+ @ab", 8, 18) + ["1.2.3.4 5.6.7.8", "+1 (437) 555-0689", "a@b.c d@e.f"]:
        for a, b in pii.regions(text):
            region = pii.Region(text, a, b)
            ways = list(every_segmentation(region, len(region.cuts) - 1))
            found = tuple(region.best(Weights()))
            assert found in {spans for _, spans in ways}
            assert max(s for s, _ in ways) == pytest.approx(next(s for s, spans in ways if spans == found))
            tried += len(ways) > 1
    assert tried > 50
