"""The registered queries without SQL on the smallest tables, against plain Python; the pipeline stage by stage."""

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

import __spark_entry__ as entry_points
import corpus_pipeline
from zonewatch.llm import arrays, icws, licenses, piece_sampling, pii, ppm
from zonewatch.llm.queries import public_tokenizer

pytest.importorskip("public_tokenizers")
SF = "/root/testdata/sf0.001"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


@pytest.fixture(scope="module")
def documents(spark):
    return {r.doc_id: r for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}


def result(spark, name):
    rows = entry_points.queries()[name](spark, SF).collect()
    return {r.doc_id: r for r in rows}


def test_op1(spark, documents):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizer("word_bpe_49k.json")())
    found, start = result(spark, "op1_wavelet_tokens"), 0
    for i in sorted(documents):
        ids = [*tokenizer.encode(documents[i].text or "", add_special_tokens=False).ids, 2]
        assert tuple(found[i]) == (i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)
    assert len(found) == len(documents)


PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def good(kind, text):
    digits = re.sub("[^0-9]", "", text)
    if kind == "ip":
        return all(int(p) <= 255 for p in text.split("."))
    if kind == "card":
        doubled = [int(d) * (1 + i % 2) for i, d in enumerate(reversed(digits))]
        return 13 <= len(digits) <= 19 and sum(d - 9 * (d > 9) for d in doubled) % 10 == 0
    return kind == "email" or 9 <= len(digits) <= 15


def test_op2(spark, documents):
    found = result(spark, "op2_pii_tagger")
    for i, r in documents.items():
        base = [(k, *m.span()) for k, p in PATTERNS.items() for m in re.finditer(p, r.text or "") if good(k, m[0])]
        counts = Counter(k for k, *_ in base)
        shown = [f"{k}:{a}:{b}" for k, a, b in base]
        assert [found[i][f"n_{k}"] for k in PATTERNS] == [counts[k] for k in PATTERNS]
        assert found[i].base_sha256 == hashlib.sha256(",".join(shown).encode()).hexdigest()
        assert set(shown) <= set(found[i].spans.split(",")) | {""}


def test_op4(spark, documents):
    found = result(spark, "op4_license_votes")
    for i, r in documents.items():
        words = WORD.findall((r.text or "").translate(LOWER))
        base = [(k, label) for p, label in licenses.PHRASES.items() for k in range(len(words)) if words[k : k + len(p.split())] == p.split()]
        places = [k for k, _ in base]
        want = (len(words), len(base), min(places, default=None), max(places, default=None), ",".join(sorted({x for _, x in base})))
        assert (found[i].n_words, found[i].n_base, found[i].first_word, found[i].last_word, found[i].base_labels) == want


def test_op5(spark, documents):
    found, uni = result(spark, "op5_kneser_ney"), Counter()

    def toks(text):
        return [*re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER)), "\n"]

    for i, r in documents.items():
        if zlib.crc32(str(i).encode()) % 7 != 2:
            uni.update(toks(r.text))
    n, v = sum(uni.values()), len(uni)
    for i, r in documents.items():
        own = toks(r.text)
        assert (found[i].held_out, found[i].n_tokens, found[i].n_known, found[i].train_tokens) == (zlib.crc32(str(i).encode()) % 7 == 2, len(own), sum(uni[w] > 0 for w in own), n)
        assert found[i].base_score == pytest.approx(sum(math.log10((uni[w] + 1) / (n + v + 1)) for w in own))
        assert found[i].score < 0
    held = [r for r in found.values() if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_op6(spark, documents):
    found = result(spark, "op6_language_id")
    held = [i for i, r in documents.items() if found[i].held_out and r.lang is not None and re.search(r"[^\W\d_]", r.text or "")]
    assert sum(found[i].lang_pred == documents[i].lang for i in held) >= 0.97 * len(held) > 20


def test_op9(spark, documents):
    found = result(spark, "op9_weighted_minhash")
    weights = icws.frequencies(spark.read.parquet(f"{SF}/documents.parquet").select("text"), 5)
    ids = sorted(documents)
    sets = []
    for i in ids:
        row, keys, n, _ = icws.shingles(arrays.as_texts(pa.array([documents[i].text], pa.string())), 5)
        sets.append((keys, n * weights.idf(keys)))
    top = {i: i for i in ids}
    for a, x in zip(ids, sets, strict=True):
        for b, y in zip(ids, sets, strict=True):
            if a < b and top[a] != top[b] and len(x[0]) and icws.similarity(x, y) >= 0.8:
                low, high = sorted((top[a], top[b]))
                top = {i: low if t == high else t for i, t in top.items()}
    assert {i: r.class_id for i, r in found.items()} == top
    assert len(set(top.values())) < len(ids)


def test_op10(spark, documents):
    found = result(spark, "op10_piece_sampling")
    assert set(found) == set(documents) and all(r.round_trip for r in found.values())
    assert all(r.n_samples == piece_sampling.DRAWS == len(r.n_pieces) for i, r in found.items() if len(documents[i].text or "") > 20)


def test_op10_returns_the_segmentations(spark, documents):
    found = result(spark, "op10_piece_sampling")
    pieces = piece_sampling.loaded(public_tokenizer("piece_bpe_32k.model")(), piece_sampling.ALPHA)
    for i, r in found.items():
        assert [len(x) for x in r.ids] == r.n_pieces and len({tuple(x) for x in r.ids}) == r.n_samples
        assert [zlib.crc32(np.array(x, "<u4").tobytes()) for x in r.ids] == r.ids_crc32
        assert {piece_sampling.decode(pieces, x) for x in r.ids} == {(documents[i].text or "").replace("▁", " ")}


def test_the_pipeline_keeps_and_changes_what_it_should(spark, documents):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    bench = [WORD.findall(r.text.translate(LOWER)) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    grams = {tuple(w[k : k + 10]) for w in bench for k in range(max(1, len(w) - 9))}
    tables = [docs]
    for _, stage in corpus_pipeline.STAGES:
        tables.append(stage(spark, tables[-1], SF))
        if len(tables) < len(corpus_pipeline.STAGES) + 1:
            assert tables[-1].columns == docs.columns
    ids = [{r.doc_id for r in t.select("doc_id").collect()} for t in tables]
    assert all(re.search(r"[^\W\d_]", documents[i].text or "") is None or i in ids[1] for i in ids[0])
    classes = result(spark, "op9_weighted_minhash")
    assert ids[2] == {i for i in ids[1] if classes[i].class_id == i} or len(ids[1]) < len(ids[0])
    hit = {i for i in ids[2] for w in [WORD.findall(documents[i].text.translate(LOWER))] if any(tuple(w[k : k + 10]) in grams for k in range(len(w)))}
    assert ids[3] == ids[2] - hit and hit
    masked = {r.doc_id: r for r in tables[4].collect()}
    assert set(masked) == ids[3]
    for i, r in masked.items():
        assert not pii.base_spans(r.text) and r.n_chars == len(r.text)
        if not re.search("[0-9@]", documents[i].text):
            assert r.text == documents[i].text
    pieces = piece_sampling.loaded(public_tokenizer("piece_bpe_32k.model")(), 1.0)
    for r in tables[5].collect():
        assert {piece_sampling.decode(pieces, x) for x in r.ids} == {masked[r.doc_id].text.replace("▁", " ")}
    assert ids[5] == ids[4]


def test_no_stage_trips_over_odd_rows(spark):
    rows = [(1, None, None, None, None), (None, None, "en", "s", 3), (2, "", "fr", None, 0), (2, "", "fr", None, 0), (3, "one word", "en", "s", 8), (None, "the end of it", "en", "s", 1)]
    schema = spark.read.parquet(f"{SF}/documents.parquet").schema
    for data in (rows, []):
        docs = spark.createDataFrame(data, schema)
        for _, stage in corpus_pipeline.STAGES:
            docs = stage(spark, docs, SF)
        assert docs.count() <= len(data)
    assert ppm.UNKNOWN == "und"
