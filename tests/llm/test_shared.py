"""Components against a walk over the graph; the helpers for words against regular expressions."""

import random
import re

import numpy as np
import pyarrow as pa
import pytest

from zonewatch.llm import arrays, shared


def by_walk(edges):
    near = {}
    for a, b in edges:
        near.setdefault(a, set()).add(b)
        near.setdefault(b, set()).add(a)
    out = {}
    for start in sorted(near):
        stack = [] if start in out else [start]
        while stack:
            x = stack.pop()
            if x not in out:
                out[x] = start
                stack += near[x]
    return out


@pytest.mark.parametrize("kind", ["chain", "star", "random", "loops", "empty"])
def test_components(spark, kind):
    rng = random.Random(7)
    edges = {
        "chain": [(i, i + 1) for i in range(60)] + [(200 - i, 199 - i) for i in range(40)],
        "star": [(0, i) for i in range(1, 50)] + [(1000, i) for i in range(900, 950)],
        "random": [(rng.randrange(-99, 99), rng.randrange(-99, 99)) for _ in range(90)],
        "loops": [(3, 3), (4, 5), (5, 4), (4, 5)],
        "empty": [],
    }[kind]
    found = shared.components(spark.createDataFrame(edges, "a long, b long"))
    assert {r.node: r.component for r in found.collect()} == by_walk(edges)


TEXTS = ["", None, "a", " A  b\tc\x0b d ", "Äé x9-Y", "one two", "x" * 9, "\n", "a b", "Ab1 c", "über ÜBER", "z"]


def test_words_are_those_of_the_pattern():
    words = arrays.as_texts(pa.array(TEXTS)).words()
    found = [[words.text(i).decode() for i in range(a, b)] for a, b in zip(words.bounds[:-1], words.bounds[1:], strict=True)]
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    assert found == [re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(lower)) for t in TEXTS]
    spaced = arrays.as_texts(pa.array(TEXTS)).words(arrays.SPACED)
    assert spaced.counts().tolist() == [len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for t in TEXTS]


def test_equal_words_and_windows_hash_alike():
    words = arrays.as_texts(pa.array(["a b c a b c", "b c", "abc"])).words()
    assert words.hash[0] == words.hash[3] != words.hash[1]
    at, h = words.windows(2)
    assert at.tolist() == [0, 1, 2, 3, 4, 6]
    assert h[0] == h[3] and h[1] == h[4] == h[5] and len(set(h.tolist())) == 3


def test_blocks_cover_all_rows():
    batch = arrays.batch(text=pa.array(TEXTS), n=pa.array(range(len(TEXTS))))
    for size in (1, 10, 1000):
        parts = list(arrays.blocks([batch.slice(1)], "text", size))
        assert [n for p, _ in parts for n in p["n"].to_pylist()] == list(range(1, len(TEXTS)))
        assert all(len(t) == len(p) for p, t in parts)
    assert np.array_equal(arrays.as_texts(batch["text"].slice(2, 3)).bounds, [0, 1, 12, 21])
