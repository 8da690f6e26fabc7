"""Wavelet shards, archives, vectors and piece sampling against plain Python on small tables."""

import base64
import gzip
import hashlib
import itertools
import math
import os
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

from zonewatch.llm import arrays, pca_tiles, piece_sampling, warc, wavelet
from zonewatch.llm.shared import opened

public_tokenizers = pytest.importorskip("public_tokenizers")
WORDS = "word_bpe_49k.json"
PIECES = "piece_bpe_32k.model"


def place(name):
    def path():
        import public_tokenizers

        return public_tokenizers.path(name)

    return path


# -- wavelet matrices -----------------------------------------------------------------------------


@pytest.mark.parametrize("size,top", [(0, 5), (1, 1), (700, 2), (5000, 300), (2000, 70_000)])
def test_wavelet_matrix(size, top):
    rng = np.random.default_rng(size)
    ids = (rng.integers(0, top, size) ** 2 // max(1, top)).astype(np.uint32 if top > 65535 else np.uint16)
    levels = max(1, (top - 1).bit_length())
    made = b"".join(wavelet.WaveletMatrix.of(ids, levels).tobytes())
    matrix = wavelet.WaveletMatrix.frombytes(np.frombuffer(made, np.uint8))
    assert matrix.unpack().tolist() == ids.tolist()
    for i in range(0, size, max(1, size // 50)):
        assert matrix.access(i) == ids[i]
    for token in {0, 1, top - 1, 1 << levels, *ids[:5].tolist()}:
        where = np.flatnonzero(ids == token)
        assert matrix.count(token) == len(where) and matrix.count(token, size // 3) == (where < size // 3).sum()
        assert [matrix.select(token, k) for k in range(0, len(where), max(1, len(where) // 9))] == where[:: max(1, len(where) // 9)].tolist()
        with pytest.raises(IndexError):
            matrix.select(token, len(where))
    if size <= 700:
        assert matrix.occurrences(1) == np.flatnonzero(ids == 1).tolist()


TEXTS = [
    (7, "Hello, WORLD! it's 12 o'clock\tnow\x0bhere"),
    (3, None),
    (5, ""),
    (-2, "ÄÉ é  x y <|endoftext|> a<|endoftext|>b \x00 ☃梦 ﬁ ΟΔΟΣ ΟΔΟΣ."),
    (None, "no id"),
    (7, "again seven"),
    (11, "repeat " * 3000 + "x" * 5000),
    (12, " \n\t "),
    (12, " \n\t "),
]


@pytest.mark.parametrize("shard_tokens,cache,whole", [(1, 5, False), (1 << 20, 1 << 20, False), (50, 100, True)])
def test_token_files(spark, shard_tokens, cache, whole):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(place(WORDS)())
    docs = spark.createDataFrame([(*t, 1, "p", 2) for t in TEXTS], "doc_id long, text string, tie int, path string, start int")
    table = wavelet.write(docs, place(WORDS), shard_tokens=shard_tokens, cache_words=cache, whole=whole)
    found = sorted(map(tuple, wavelet.read(table).collect()), key=lambda r: r[1])
    ids = {t: [*tokenizer.encode(t or "", add_special_tokens=False).ids, 2] for _, t in TEXTS}
    want = sorted((i is not None, i or 0, len(ids[t]), zlib.crc32(np.array(ids[t], "<u4").tobytes())) for i, t in TEXTS)
    assert sorted((i is not None, i or 0, n, crc) for i, _, n, crc in found) == want
    assert [i is not None and i for i, *_ in found] == sorted((i is not None and i for i, *_ in found), key=lambda i: (i is not False, i))
    assert [start for _, start, _, _ in found] == list(itertools.accumulate([0, *(n for _, _, n, _ in found[:-1])]))
    rows = table.collect()
    assert sum(r.documents for r in rows) == len(TEXTS) and all(os.path.exists(r.path.removeprefix("file://")) for r in rows)
    shard = wavelet.open_shard(open(rows[0].path.removeprefix("file://"), "rb").read())
    assert shard[2].count(2) >= rows[0].documents


def test_each_word_is_encoded_once():
    own = wavelet.Encoder(place(WORDS)(), False, 1 << 20)
    plain, asked = own.tokenizer, []

    class Watched:
        def __getattr__(self, name):
            return lambda words, **how: asked.append(words) or getattr(plain, name)(words, **how)

    own.tokenizer, words = Watched(), [f"word{i}, o'clock" for i in range(2100)]
    ids, sizes = own.words(words)
    want = [plain.encode(w, add_special_tokens=False).ids for w in words]
    assert sizes.tolist() == [len(w) for w in want] and ids.tolist() == [i for w in want for i in w]
    assert asked == words


def test_no_tokens(spark):
    assert wavelet.read(wavelet.write(spark.createDataFrame([], "doc_id long, text string"), place(WORDS))).count() == 0


# -- archives -------------------------------------------------------------------------------------

PAGES = [(1, "http://a/", "<p>one</p>" * 50), (2, None, "<p>one</p>" * 50), (3, "http://c\r\nX: y", None), (4, "u", ""), (5, "é", "é\r\n0\r\n\r\n"), (6, "z", "big " * 60_000), (6, "z", "big " * 60_000), (9, "q", "big " * 60_000), (None, "n", "<p>one</p>" * 50), (None, "m", "alone")]


@pytest.mark.parametrize("least,salted", [(0, False), (10, True)])
def test_archives(spark, monkeypatch, least, salted):
    if salted:
        monkeypatch.setattr(warc, "BROADCAST_DIGESTS", 0)
    pages = spark.createDataFrame([(*p, 1, "x") for p in PAGES], "page_id long, url string, html string, sha int, salt string")
    files = warc.write(pages, least=least, file_bytes=2000, segment=97)
    assert files.count() > 3
    found = warc.read(files).collect()
    want = []
    for i, _, html in PAGES:
        payload = (html or "").encode()
        same = [j for j, _, h in PAGES if (h or "").encode() == payload and j is not None]
        first = min(same, default=None) if len(payload) >= least and sum((h or "").encode() == payload for _, _, h in PAGES) > 1 else None
        again = first is not None and first != i
        want.append((i, len(payload), base64.b32encode(hashlib.sha1(payload).digest()).decode(), "revisit" if again else "response", first if again else None))
    assert sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in found), key=str) == sorted(want, key=str)
    for r in found:
        assert (r.payload is None) == (r.record_type == "revisit")
        if r.payload is not None:
            assert bytes(r.payload) in {(h or "").encode() for i, _, h in PAGES if i == r.page_id}
    assert {r.url for r in found if r.page_id == 3} == {"http://c X: y"}


def test_broken_records_are_named():
    with pytest.raises(ValueError, match="r: a segment is missing"):
        warc.assembled("r", [(1, None, b"a"), (3, 2, b"b")])
    with pytest.raises(ValueError, match="r: the total length"):
        warc.assembled("r", [(2, 3, b"b"), (1, None, b"a")])
    assert warc.assembled("r", [(2, 2, b"b"), (1, None, b"a")]) == b"ab"
    with pytest.raises(ValueError):
        warc.unchunked(b"5\r\nabc\r\n0\r\n\r\n")
    assert warc.unchunked(b"3;x=y\r\nabc\r\n1\r\nd\r\n0\r\nTrailer: z\r\n\r\n") == b"abcd"
    data = warc.member(b"one") + warc.member(b"2" * 100_000) + warc.member(b"")
    assert list(warc.members(data)) == [b"one", b"2" * 100_000, b""]
    with pytest.raises(ValueError, match="cut off"):
        list(warc.members(data[:-3]))


def test_no_pages(spark):
    assert warc.read(warc.write(spark.createDataFrame([], "page_id long, url string, html string"))).count() == 0


# -- vectors --------------------------------------------------------------------------------------


def test_vectors(spark):
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(12, 20))
    rows = []
    for i in range(300):
        v = centres[i % 12] + rng.normal(size=20) * (0.05 if i % 3 else 0.4)
        rows.append((i, [float(np.float32(x)) for x in v * 10.0 ** rng.integers(-3, 4)], int(i % 2) if i % 50 else None))
    rows += [(1000 + i, [float("nan")] + [1.0] * 19, 0) for i in range(2)] + [(1010, None, 0), (1011, [], 0), (1012, [0.0] * 20, 0), (1013, [1.0] * 19 + [None], 0), (1014, [float("inf")] * 20, 0)]
    rows += [(1020 + i, [1.0] * 7, 0) for i in range(3)] + [(1030, [1.0] * 20, 0), (1031, [2.0] * 20, 0), (1032, [2.0] * 20, 1)]
    rows += [(2000 + i, rows[1][1], 1) for i in range(40)] + [(None, rows[1][1], 1), (1, rows[1][1], 1)]
    docs = spark.createDataFrame([(*r, 1, 2) for r in rows], "vec_id long, embedding array<float>, label int, rep int, n int")
    use = [(k, np.array(v, float), lab) for k, (i, v, lab) in enumerate(rows) if i is not None and lab is not None and v and None not in v and np.isfinite(v).all() and any(v)]
    near = {k: [] for k in range(len(rows))}
    for (a, x, la), (b, y, lb) in itertools.combinations(use, 2):
        if la == lb and len(x) == len(y) and x @ y / math.sqrt((x @ x) * (y @ y)) >= 0.93:
            near[a].append(b)
            near[b].append(a)

    def component(k):
        seen, stack = {k}, [k]
        while stack:
            for other in near[stack.pop()]:
                if other not in seen:
                    seen.add(other)
                    stack.append(other)
        return min((rows[j][0] for j in seen if rows[j][0] is not None), default=None)

    for tile_rows in (16, 4096):
        found = sorted(map(tuple, pca_tiles.near_duplicates(docs, tile_rows=tile_rows).collect()), key=str)
        want = [(i, len(near[k]), component(k), i is not None and component(k) == i) for k, (i, _, _) in enumerate(rows)]
        assert found == sorted(want, key=str)
    assert pca_tiles.near_duplicates(docs.limit(0)).count() == 0


# -- pieces ---------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def pieces():
    return piece_sampling.loaded(place(PIECES)(), 1.0)


def test_the_trie_has_rows_for_inner_nodes_only(pieces):
    assert len(pieces.next) == (pieces.inner + 1) * 256 < len(pieces.piece) * 256
    ends = np.flatnonzero(pieces.piece >= 0)
    assert (pieces.piece[pieces.inner + 1 :] >= 0).all() and len(ends) == len(set(pieces.piece[ends].tolist()))
    for k in ends[:: max(1, len(ends) // 50)].tolist():
        node = 1
        for b in pieces.texts[pieces.piece[k]]:
            assert node <= pieces.inner
            node = int(pieces.next[node * 256 + b])
        assert node == k


def segmentations(pieces, data):
    known = {t: i for i, t in enumerate(pieces.texts) if t and not (i in pieces.byte_id)}

    def rest(at):
        if at == len(data):
            yield []
        for to in range(at + 1, len(data) + 1):
            if data[at:to] in known:
                for more in rest(to):
                    yield [known[data[at:to]], *more]

    return list(rest(0))


def test_draws_follow_the_probabilities(pieces):
    text, n = "the of", 20_000
    every = segmentations(pieces, "▁the▁of".encode())
    p = np.exp([sum(pieces.weight[i] for i in s) for s in every])
    p /= p.sum()
    number = {tuple(s): i for i, s in enumerate(every)}
    drawn = piece_sampling.Draws(pieces, arrays.as_texts(pa.array([text] * n)), np.arange(n), 3, 1)
    counts, weighted = np.zeros((3, len(p))), np.zeros(len(p))
    for row, found in enumerate(drawn.found):
        ids = [number[tuple(drawn.lattice.id[e].tolist())] for e, _, _ in found]
        assert len(set(ids)) == 3 and [f[2] for f in found] == sorted((f[2] for f in found), reverse=True)
        assert [f[1] for f in found] == pytest.approx([math.log(p[i]) for i in ids])
        for k, i in enumerate(ids):
            counts[k, i] += 1
        weighted[ids] += np.exp(-np.array(drawn.inclusion(row)))
    second = np.array([sum(p[a] * p[i] / (1 - p[a]) for a in range(len(p)) if a != i) for i in range(len(p))])
    for got, want in ((counts[0] / n, p), (counts[1] / n, second)):
        assert np.abs(got - want).max() < 5 * math.sqrt(0.25 / n)
    likely = p > 1e-3
    assert weighted[likely] / n == pytest.approx(np.ones(likely.sum()), abs=0.05)


PIECE_TEXTS = [(1, "Hello  world\n\té 梦☃ x"), (2, None), (3, ""), (4, "a"), (None, " lead and trail "), (6, "▁mark"), (1, "Hello  world\n\té 梦☃ x"), (8, "word " * 4000 + "z" * 3000)]


def test_pieces_round_trip(spark, pieces):
    docs = spark.createDataFrame([(*t, 0, "x") for t in PIECE_TEXTS], "doc_id long, text string, n_samples int, ids string")
    found = piece_sampling.sample(docs, place(PIECES), draws=4).collect()
    assert len(found) == len(PIECE_TEXTS)
    texts = {}
    for r in found:
        text = dict(PIECE_TEXTS)[r.doc_id] or ""
        assert r.round_trip and r.n_samples == len(r.ids) == len({tuple(i) for i in r.ids})
        assert {piece_sampling.decode(pieces, i) for i in r.ids} == {text.replace("▁", " ")}
        assert [len(i) for i in r.ids] == r.n_pieces and [zlib.crc32(np.array(i, "<u4").tobytes()) for i in r.ids] == r.ids_crc32
        assert all(p <= 0 for p in r.log_inclusion) and r.perturbed == sorted(r.perturbed, reverse=True)
        texts.setdefault(r.doc_id, []).append(r.ids)
    by_id = {r.doc_id: r for r in found}
    assert by_id[2].n_samples == by_id[3].n_samples == 1 and by_id[3].ids == [[]]
    assert by_id[4].n_samples == 2 and by_id[4].log_inclusion == [0.0, 0.0] and by_id[1].n_samples == 4
    assert texts[1][0] == texts[1][1]


def test_draws_do_not_depend_on_blocks(pieces):
    rng = random.Random(3)
    texts = [" ".join(rng.choice(["the", "overture", "segment", "zq", "é"]) for _ in range(rng.randrange(30))) for _ in range(20)]
    together = piece_sampling.Draws(pieces, arrays.as_texts(pa.array(texts)), np.arange(20), 3, 1)
    for row, text in enumerate(texts):
        alone = piece_sampling.Draws(pieces, arrays.as_texts(pa.array([text])), np.array([row]), 3, 1)
        assert [alone.lattice.id[e].tolist() for e, _, _ in alone.found[0]] == [together.lattice.id[e].tolist() for e, _, _ in together.found[row]]


def test_no_texts(spark):
    assert piece_sampling.sample(spark.createDataFrame([], "doc_id long, text string"), place(PIECES)).count() == 0


def test_archives_are_gzip_members_that_other_readers_open(spark):
    pages = spark.createDataFrame([(1, "u", "x" * 99), (2, "v", None), (3, "w", "x" * 99)], "page_id long, url string, html string")
    for row in warc.write(pages).collect():
        store, inside = opened(row.path)
        with store.open_input_stream(inside, compression=None) as stream:
            raw = stream.read()
        text = gzip.decompress(raw)
        assert text.startswith(b"WARC/1.") and text.count(b"WARC-Record-ID: ") == row.records
        assert len(raw) == row.bytes
