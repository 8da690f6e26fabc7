"""Operators on texts against plain Python on small tables: nulls, empty and long texts, ties, repeats, clashing columns."""

import hashlib
import math
import random
import re
import tracemalloc
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from zonewatch.llm import arrays, decontaminate, icws, kneser_ney, licenses, pii, ppm, shards

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
CLASH = ", row string, key string, bucket int, n int, words int, label string, score string, h1 int, text_of_row string, t int"
EXTRA = ("r", "k", 1, 2, 3, "l", "s", 4, "x", 5)
SCHEMA = "doc_id long, text string" + CLASH


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def table(spark, rows):
    return spark.createDataFrame([(*r, *EXTRA) for r in rows], SCHEMA)


def bits(h):
    return int(h) & ((1 << 64) - 1)


# -- decontamination ------------------------------------------------------------------------------

BENCH = [(1, "one two three four five six seven eight nine ten eleven"), (2, "Short item"), (3, None), (4, ""), (10, "short ITEM"), (None, "lost words"), (5, "a a a a a a a a a a a")]
DOCS = [
    (1, "x one TWO three, four five six seven eight nine ten y"),
    (2, "one two three four five six seven eight nine"),
    (3, None),
    (4, ""),
    (None, "a short item, and lost words"),
    (5, "a " * 30 + "end"),
    (5, "a " * 30 + "end"),
    (6, "long " * 5000 + "short item " + "tail " * 5000),
]


def scanned(text):
    own = words(text)
    hit, items = set(), set()
    for item, passage in BENCH:
        w = words(passage)
        k = min(len(w), 10)
        grams = {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if k else set()
        for i in range(len(own) - k + 1 if k else 0):
            if tuple(own[i : i + k]) in grams:
                hit |= set(range(i, i + k))
                items |= {str(item)} if item is not None else set()
    return len(own), len(hit), len(items), hashlib.sha256(",".join(sorted(items)).encode()).hexdigest(), bool(hit)


@pytest.mark.parametrize("part_bytes", [1, 1 << 20])
def test_decontamination(spark, part_bytes):
    bench = spark.createDataFrame(BENCH, "item_id long, text string")
    found = decontaminate.scan(table(spark, DOCS), bench, part_bytes=part_bytes).drop("hit_words", "items")
    assert sorted(map(tuple, found.collect()), key=str) == sorted(((i, *scanned(t)) for i, t in DOCS), key=str)
    kept = decontaminate.clean(table(spark, DOCS), bench, part_bytes=part_bytes)
    assert kept.columns == table(spark, DOCS).columns
    assert sorted(r.doc_id for r in kept.collect()) == [2, 3, 4]


def test_decontamination_of_and_against_nothing(spark):
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.scan(table(spark, []), none).count() == 0
    assert {r.n_hit for r in decontaminate.scan(table(spark, DOCS), none).collect()} == {0}


# -- language -------------------------------------------------------------------------------------


def prose(rng, syllables, n):
    return " ".join("".join(rng.choice(syllables) for _ in range(rng.randrange(1, 4))) for _ in range(n)) + "."


LANGS = {"en": ("th", "ing", "er", "and", "o", "wh"), "fr": ("eau", "oi", "é", "qu", "le", "ç"), "de": ("sch", "ei", "ü", "ung", "z", "ß")}


def test_language_on_held_out_texts(spark):
    rng = random.Random(1)
    rows = [(i, prose(rng, LANGS[code], rng.randrange(3, 60)), code) for i, code in enumerate(sorted(LANGS) * 60)]
    rows += [(900, None, "en"), (901, "", "fr"), (902, "12 - 3", "de"), (903, "Schung " * 40_000, None), (1, "the", None), (None, "le eau", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumn("score", ppm.F.lit("x")).withColumn("held_out", ppm.held_out())
    assert {r.doc_id for r in docs.where("held_out").collect()} == {i for i, *_ in rows if zlib.crc32(str("" if i is None else i).encode()) % 4 == 2}
    model = ppm.learn(docs.where("NOT held_out"))
    found = {(r.doc_id, r.lang_pred): r.score for r in ppm.predict(docs, model).collect()}
    right = sum((i, code) in found for i, _, code in rows[:180])
    assert right >= 178
    assert found[900, "und"] == found[901, "und"] == found[902, "und"] == 0.0
    assert found[903, "de"] > 0.99 and all(0 <= s <= 1 for s in found.values())
    kept = ppm.identified(docs, model)
    assert kept.columns == docs.columns and {900, 901, 902}.isdisjoint(r.doc_id for r in kept.collect())


def test_code_lengths_are_those_of_the_trees(spark):
    """Against a dictionary of counts, escape method C, without exclusion."""
    rng = random.Random(2)
    rows = [(i, prose(rng, LANGS[code], 8), code) for i, code in enumerate(["en", "fr"] * 10)]
    model = ppm.learn(spark.createDataFrame(rows, "doc_id long, text string, lang string"), per_lang=1000)
    counts = {code: [{} for _ in range(ppm.ORDER + 1)] for code in model.langs}
    for _, text, code in rows:
        data = text.translate(LOWER).encode()
        for i in range(len(data)):
            for d in range(min(i, ppm.ORDER) + 1):
                at = counts[code][d].setdefault(data[i - d : i], Counter())
                at[data[i]] += 1
    # the model drops (context, byte) pairs that were seen once, beyond order 0
    for code in counts:
        for d in range(1, ppm.ORDER + 1):
            counts[code][d] = {c: Counter({b: n for b, n in at.items() if n > 1}) for c, at in counts[code][d].items()}
            counts[code][d] = {c: at for c, at in counts[code][d].items() if at}

    def p(code, context, byte):
        for d in range(len(context), -1, -1):
            at = counts[code][d].get(context[len(context) - d :])
            if at:
                total, distinct = sum(at.values()), len(at)
                lower = p(code, context[len(context) - d + 1 :], byte) if d else 1 / 256
                return at.get(byte, 0) / (total + distinct) + distinct / (total + distinct) * lower
        return 1 / 256

    text = prose(rng, LANGS["en"], 12) + " Ω"
    data = text.translate(LOWER).encode()
    for k, code in enumerate(model.langs):
        expected = -sum(math.log2(p(code, data[max(0, i - ppm.ORDER) : i], data[i])) for i in range(len(data)))
        assert model.lengths(arrays.as_texts(pa.array([None, text, ""])))[1, k] == pytest.approx(expected, rel=1e-4)


@pytest.mark.parametrize(("cells", "group"), [(ppm.CELLS, ppm.GROUP), (0, ppm.GROUP), (ppm.CELLS, 1)])
def test_a_rare_language_keeps_its_contexts(spark, cells, group, monkeypatch):
    """All pairs of context and byte count, however many contexts a common language has, by table and by sorted array."""
    monkeypatch.setattr(ppm.Model.__init__, "__defaults__", (group,))
    rng = random.Random(3)
    letters = "".join(map(chr, range(97, 123)))
    noise = ["".join(rng.choice(letters) for _ in range(4000)) for _ in range(25)]
    rows = [*((i, t, "en") for i, t in enumerate(noise)), (100, "xoquz vikyj", "rare"), (101, "xoquz", "rare")]
    model = ppm.learn(spark.createDataFrame(rows, "doc_id long, text string, lang string"), per_lang=1000, cells=cells, least=1)
    trained = {code: [t.encode() for _, t, c in rows if c == code] for code in model.langs}

    def p(code, context, byte):
        value = 1 / 256
        for d in range(len(context) + 1):
            string = context[len(context) - d :]
            after = Counter(t[i + d] for t in trained[code] for i in range(len(t) - d) if t[i : i + d] == string)
            total, distinct = sum(after.values()), len(after)
            value = (after[byte] + distinct * value) / (total + distinct) if total else value
        return value

    texts = ["xoquz vikyj", "", "vikyjé qu", noise[0][:20], "x"]
    found = model.lengths(arrays.as_texts(pa.array(texts)))
    for text, row in zip(texts, found, strict=True):
        data = text.encode()
        for code, bits in zip(model.langs, row, strict=True):
            assert bits == pytest.approx(-sum(math.log2(p(code, data[max(0, i - ppm.ORDER) : i], data[i])) for i in range(len(data))), rel=1e-4, abs=1e-6)


def test_no_language_to_learn(spark):
    docs = spark.createDataFrame([(1, "text", None)], "doc_id long, text string, lang string")
    model = ppm.learn(docs)
    assert [(r.lang_pred, r.score) for r in ppm.predict(docs, model).collect()] == [("und", 0.0)]
    assert ppm.identified(docs, model).count() == 0 and ppm.predict(docs.limit(0), model).count() == 0


# -- licenses -------------------------------------------------------------------------------------

NOTICES = [
    (1, "Text. All rights RESERVED. cc by, x CC-BY 4.0"),
    (2, "This work is licensed under the GNU General Public License, version 3."),
    (3, None),
    (4, " . "),
    (None, "cc by"),
    (5, "Licensed under the very Apache License, Version 2.0 all"),
    (5, "Licensed under the very Apache License, Version 2.0 all"),
    (6, "word " * 30_000 + "general public license " + "word " * 30_000),
    (7, "ALL RIGHTS reserved all rights reserved all rights"),
    (8, "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and its documentation files"),
    (9, "the apache version"),
]


def test_licenses(spark):
    found = licenses.scan(table(spark, NOTICES)).collect()
    for r in found:
        text = next(t for i, t in NOTICES if i == r.doc_id)
        own = words(text)
        base = [(i, label) for phrase, label in licenses.PHRASES.items() for i in range(len(own)) if own[i : i + len(phrase.split())] == phrase.split()]
        places = [i for i, _ in base]
        assert (r.n_words, r.n_base, r.first_word, r.last_word) == (len(own), len(base), min(places, default=None), max(places, default=None))
        assert r.base_labels == ",".join(sorted({label for _, label in base}))
        assert set(filter(None, r.base_labels.split(","))) <= set(filter(None, r.labels.split(","))) and 0 <= r.score <= 1
    labels = {r.doc_id: r.labels for r in found}
    assert labels[2] == "gpl,gpl-3.0" and labels[5] == "apache-2.0" and labels[8] == "mit" and labels[9] == "" and labels[1] == "cc-by,reserved"
    assert len(found) == len(NOTICES)
    assert licenses.scan(table(spark, [])).count() == 0


# -- language model -------------------------------------------------------------------------------


def by_dictionary(train, text):
    def toks(t):
        return [*re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(LOWER)), "</s>"]

    pairs, uni = Counter(), Counter()
    for t in train:
        w = toks(t)
        uni.update(w)
        pairs.update(zip(["<s>", *w], w))
    total, vocabulary = sum(uni.values()), len(uni)
    cont = Counter(w for _, w in pairs)

    def ds(counts):
        n = [sum(c == k for c in counts.values()) for k in (1, 2, 3, 4)]
        y = n[0] / (n[0] + 2 * n[1]) if n[0] + 2 * n[1] else 0.5
        raw = [1 - 2 * y * n[1] / n[0] if n[0] else 0.5, 2 - 3 * y * n[2] / n[1] if n[1] else 1.0, 3 - 4 * y * n[3] / n[2] if n[2] else 1.5]
        return [0.0, *(d if 0 < d <= k else k / 2 for k, d in zip((1, 2, 3), raw))]

    d2, d1 = ds(pairs), ds(cont)
    left1 = sum(d1[min(c, 3)] for c in cont.values()) / len(pairs) if pairs else 1.0

    def p(u, w):
        low = left1 / (vocabulary + 1) + (max(cont[w] - d1[min(cont[w], 3)], 0) / len(pairs) if pairs else 0)
        after = {x: c for (a, x), c in pairs.items() if a == u}
        if not after:
            return low
        c = after.get(w, 0)
        return max(c - d2[min(c, 3)], 0) / sum(after.values()) + sum(d2[min(c, 3)] for c in after.values()) / sum(after.values()) * low

    own = toks(text)
    base = sum(math.log10((uni[w] + 1) / (total + vocabulary + 1)) for w in own)
    return (len(own), sum(uni[w] > 0 for w in own), total, base, sum(math.log10(p(u, w)) for u, w in zip(["<s>", *own], own))), p, [*uni, "unseen"]


TRAIN = ["the cat sat on the mat", "The cat ate", None, "", "a b a b a b a b", "x\ty\nz", "the the the", "über Über"]


def test_kneser_ney(spark):
    rng = random.Random(4)
    train = TRAIN + [" ".join(rng.choice("abcdefghij") for _ in range(rng.randrange(40))) for _ in range(40)]
    docs = table(spark, list(enumerate(train)) + [(None, "the cat"), (0, train[0])])
    model = kneser_ney.learn(docs.where("doc_id IS NOT NULL AND doc_id < 30"))
    learned = [*train[:30], train[0]]
    for r in kneser_ney.score(docs, model).collect():
        (n, known, total, base, score), p, vocabulary = by_dictionary(learned, "the cat" if r.doc_id is None else train[r.doc_id])
        assert (r.n_tokens, r.n_known, r.train_tokens) == (n, known, total)
        assert r.base_score == pytest.approx(base) and r.score == pytest.approx(score)
        assert r.perplexity == pytest.approx(10 ** (-score / n))
    for u in ("<s>", "the", "unseen"):
        assert sum(p(u, w) for w in vocabulary) == pytest.approx(1)


def test_kneser_ney_without_training(spark):
    model = kneser_ney.learn(table(spark, []))
    assert [(r.n_tokens, r.n_known, r.base_score, r.score) for r in kneser_ney.score(table(spark, [(1, "a b")]), model).collect()] == [(3, 0, 0.0, 0.0)]
    assert kneser_ney.score(table(spark, []), model).count() == 0


def test_shards_find_what_was_stored(spark, tmp_path):
    keys = np.sort(np.random.default_rng(1).integers(0, 1 << 63, 5000, dtype=np.uint64) * np.uint64(2))
    n = 7
    cuts = shards.bounds(keys, n)
    files = {}
    for b in range(n):
        part = keys[cuts[b] : cuts[b + 1]]
        (tmp_path / str(b)).write_bytes(part.astype("<u8").tobytes() + np.arange(cuts[b], cuts[b + 1]).astype("<u4").tobytes())
        files[b] = (f"file://{tmp_path}/{b}", len(part))
    found = shards.Shards(n, ("<u4",), files)
    asked = np.concatenate([keys[::3], keys[:50] + np.uint64(1)])
    assert found.find_any(asked)[0].tolist() == [*range(0, 5000, 3), *[0] * 50]
    assert (shards.unsix(shards.six(keys)) == keys & ~np.uint64(0xFFFF)).all()


# -- near duplicates ------------------------------------------------------------------------------


def exact_classes(rows, weights):
    """Classes by the weighted Jaccard similarity of all pairs."""
    sets = []
    for _, text in rows:
        row, keys, n, _ = icws.shingles(arrays.as_texts(pa.array([text], pa.string())), 5)
        sets.append((keys, n * weights.idf(keys)))
    least = list(range(len(rows)))

    def top(i):
        while least[i] != i:
            i = least[i]
        return i

    border = 0
    for i in range(len(rows)):
        for j in range(i):
            s = icws.similarity(sets[i], sets[j])
            border += 0.78 <= s < 0.82
            if s >= 0.8 and len(sets[i][0]):
                least[max(top(i), top(j))] = min(top(i), top(j))
    ids = [min(rows[k][0] for k in range(len(rows)) if top(k) == top(i)) for i in range(len(rows))]
    return ids, border


def edited(rng, text, n):
    w = text.split()
    for _ in range(n):
        w[rng.randrange(len(w))] = f"edit{rng.randrange(10**6)}"
    return " ".join(w)


@pytest.mark.parametrize("rounds", [0, 4])
def test_near_duplicates(spark, rounds):
    rng = random.Random(5)
    vocabulary = [f"w{i}" for i in range(3000)]
    originals = [" ".join(rng.choice(vocabulary) for _ in range(rng.randrange(60, 300))) for _ in range(12)]
    texts = [t for o in originals for t in [o, *(edited(rng, o, n) for n in (1, 1, 2))]] + [originals[0].upper()] * 5 + ["one two", "one two", "one", ""]
    texts += [edited(rng, originals[1], 2) for _ in range(40)] + ["long " * 20_000, "long " * 20_001]
    rng.shuffle(texts)
    rows = list(enumerate(texts))
    docs = table(spark, rows + [(500, None), (501, None)])
    weights = icws.frequencies(docs.select("text"), 5)
    assert weights.documents == sum(bool(words(t)) for t in texts)
    expected, border = exact_classes(rows, weights)
    found = {r.doc_id: r for r in icws.classes(docs, rounds=rounds, tile=16).collect()}
    wrong = sum(found[i].class_id != c for (i, _), c in zip(rows, expected, strict=True))
    assert wrong <= border
    assert found[500].class_id == 500 and found[501].class_id == 501 and len(found) == len(rows) + 2
    kept = icws.one_of_each(docs, rounds=rounds, tile=16)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == {i for i, r in found.items() if r.kept}


def test_near_duplicates_of_odd_tables(spark):
    assert icws.classes(table(spark, [])).count() == 0
    same = "a b c d e f g"
    docs = table(spark, [(3, same), (3, same), (2, same), (None, same), (None, "other words"), (9, "x")])
    found = sorted(map(tuple, icws.classes(docs).select("doc_id", "class_id", "n_copies").collect()), key=str)
    assert found == sorted([(3, 2, 4), (3, 2, 4), (2, 2, 4), (None, 2, 4), (None, None, 1), (9, 9, 1)], key=str)
    assert sorted((r.doc_id for r in icws.one_of_each(docs).collect()), key=str) == sorted([2, None, None, 9], key=str)
    twice = table(spark, [(3, same), (3, same)])
    assert [r.doc_id for r in icws.one_of_each(twice).collect()] == [3]


def test_samples_agree_as_often_as_texts_are_similar():
    rng = np.random.default_rng(6)
    keys = rng.integers(0, 1 << 62, 400, dtype=np.uint64) << np.uint64(1)
    a, b = np.sort(keys[:300]), np.sort(keys[100:])
    wa, wb = rng.uniform(0.75, 3, 300), rng.uniform(0.75, 3, 300)
    drawn = [icws.samples(np.zeros(300, int), k, w, 1, 3000)[0] for k, w in ((a, wa), (b, wb))]
    assert abs((drawn[0] == drawn[1]).mean() - icws.similarity((a, wa), (b, wb))) < 0.03


# -- personal data --------------------------------------------------------------------------------


def test_patterns_are_those_of_the_contract():
    rng = random.Random(7)
    email, ip = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
    for _ in range(3000):
        text = "".join(rng.choice("a1.@-9 2+%é") for _ in range(rng.randrange(30)))
        assert [m.span() for m in email.finditer(text)] == list(pii.emails(text))
        assert [m.span() for m in ip.finditer(text)] == [m.span() for m in pii.IP.finditer(text)]
    text = "é a.b@c.de 256.1.1.1 255.0.0.01 4111 1111 1111 1111 4111111111111112 +1 (555) 555-1234 +1 2"
    assert [(k, text[a:b]) for k, a, b in pii.base_spans(text)] == [("email", "a.b@c.de"), ("ip", "255.0.0.01"), ("phone", "+1 (555) 555-1234")]
    assert [k for k, *_ in pii.base_spans("x 4111-1111 1111-1111 y")] == ["card"]


def test_gradients():
    tagger, rng = pii.Tagger(), np.random.default_rng(0)
    code, tags = rng.integers(0, 129, (3, 6)), rng.integers(0, pii.TAGS, (3, 6))
    _, grad = tagger.loss(code, tags)
    for name, value in tagger.p.items():
        at = (int(code[1, 2]), 3) if name == "embed" else tuple(rng.integers(0, n) for n in value.shape)
        kept, losses = value[at], []
        for step in (1e-5, -1e-5):
            value[at] = kept + step
            losses.append(tagger.loss(code, tags)[0])
        value[at] = kept
        assert (losses[0] - losses[1]) / 2e-5 == pytest.approx(grad[name][at], abs=1e-6)


def test_best_paths_are_the_best():
    tagger, rng = pii.Tagger(), np.random.default_rng(3)
    tagger.p["trans"], tagger.p["start"] = rng.normal(size=(pii.TAGS,) * 2), rng.normal(size=pii.TAGS)
    sizes = [3, 1, 4, 2]
    offset = np.concatenate([[0], np.cumsum(sizes)])
    score = rng.normal(size=(offset[-1], pii.TAGS))
    found = tagger.viterbi(score, offset)
    for a, n in zip(offset, sizes, strict=False):
        paths = np.stack(np.meshgrid(*[np.arange(pii.TAGS)] * n, indexing="ij"), -1).reshape(-1, n)
        value = tagger.p["start"][paths[:, 0]] + score[a + np.arange(n), paths].sum(axis=1) + tagger.p["trans"][paths[:, :-1], paths[:, 1:]].sum(axis=1)
        assert (found[a : a + n] == paths[value.argmax()]).all()


def secret_text(rng, i):
    kinds = [f"u{i}@mail{rng.randrange(9)}.example.com", f"{rng.randrange(256)}.{rng.randrange(256)}.4.{rng.randrange(256)}", f"+1 ({rng.randrange(100, 999)}) 555-{rng.randrange(1000, 9999)}", f'token = "{rng.getrandbits(128):032x}"']
    return " ".join([prose(rng, LANGS["en"], 15), rng.choice(kinds), prose(rng, LANGS["en"], 25), rng.choice(kinds), prose(rng, LANGS["fr"], 9)])


def test_tagger_on_held_out_texts(spark):
    rng = random.Random(8)
    texts = [secret_text(rng, i) for i in range(400)]
    rows = [*enumerate(texts), (900, None), (901, ""), (902, "no digits"), (5, texts[5]), (903, "word " * 40_000 + "me@mail.example.org")]
    docs = table(spark, rows)
    tagger = pii.learn(docs.where("doc_id < 250"), epochs=10)
    found = pii.find(docs, tagger).collect()
    assert len(found) == len(rows)
    spans = {r.doc_id: r.spans for r in found}
    assert spans[900] == spans[901] == spans[902] == "" and spans[903] == "email:200000:200019"
    assert next(r for r in found if r.doc_id == 900).base_sha256 == hashlib.sha256(b"").hexdigest()
    right = total = 0
    for i in range(250, 400):
        want = {f"{k}:{a}:{b}" for k, a, b in pii.labelled(texts[i])}
        base = {f"{k}:{a}:{b}" for k, a, b in pii.base_spans(texts[i])}
        got = set(filter(None, spans[i].split(",")))
        assert base <= got
        right, total = right + len((want - base) & got), total + len(want - base)
    assert right >= 0.8 * total > 0
    clean = pii.redact(docs, tagger)
    assert clean.columns == docs.columns
    texts_now = {r.doc_id: r.text for r in clean.collect()}
    assert texts_now[903].endswith("[EMAIL]") and texts_now[900] is None and "@" not in "".join(filter(None, texts_now.values()))


def test_tagging_keeps_no_more_than_the_scores_of_its_windows():
    tagger = pii.Tagger()
    tagger.p["bias"][0] = 100.0  # nothing but outside
    text = np.random.default_rng(0).integers(32, 127, 1 << 20).astype(np.uint8)
    tracemalloc.start()
    try:
        assert tagger.tagged([text]) == [[]]
        assert tracemalloc.get_traced_memory()[1] < 50 << 20  # 42 MB; 58 MB with the states of all steps
    finally:
        tracemalloc.stop()


@pytest.mark.parametrize("fast_tanh", [False, True])
def test_windows_of_all_widths_are_scored_together(monkeypatch, fast_tanh):
    tagger, rng, runs, scorer = pii.Tagger(seed=4), np.random.default_rng(5), [], pii.Tagger.scorer
    tagger.p["trans"], tagger.p["bias"] = rng.normal(size=(pii.TAGS,) * 2), rng.normal(size=pii.TAGS)
    monkeypatch.setattr(pii, "FAST_TANH", fast_tanh)

    def watched(self):
        run = scorer(self)
        return lambda code, live: runs.append((code, run(code, live))) or runs[-1][1]

    monkeypatch.setattr(pii.Tagger, "scorer", watched)
    sizes = range(250, 10, -30)
    tagger.tagged([rng.integers(32, 127, n).astype(np.uint8) for n in sizes])
    assert len(runs) == 1  # one for each of eight widths before
    code, found = runs[0]
    for k, n in enumerate(sizes):
        width = -(-n // pii.OVERLAP) * pii.OVERLAP
        own = tagger.emissions(code[:width, k].astype(np.int64)[None])[0][0]
        assert np.abs(found[:width, k] - (own[:, 1:] - own[:, :1] + tagger.lead())).max() < 1e-4


def test_powers_end_with_the_task():
    arrays.powers(arrays.BYTE_BASE).upto(1 << 20)
    arrays.released()
    assert arrays.powers(arrays.BYTE_BASE).size == 0


def test_tagger_without_documents(spark):
    tagger = pii.learn(table(spark, [(1, "nothing here")]))
    assert not tagger.trained and pii.find(table(spark, []), tagger).count() == 0
    assert [r.spans for r in pii.find(table(spark, [(1, "a@b.cd")]), tagger).collect()] == ["email:0:6"]


def test_tagger_reads_whole_texts():
    """One path over the emissions of all windows, text by text, also where no digit and no @ stands."""
    rng, draw = random.Random(9), np.random.default_rng(9)
    tagger = pii.Tagger(seed=4)
    tagger.p["trans"] = draw.normal(size=(pii.TAGS,) * 2)
    tagger.p["bias"][0] = 2.0
    texts = [pii.codes(prose(rng, LANGS["en"], n)) for n in (1, 3, 6, 12, 200)] + [pii.codes("x")]
    edge = np.arange(pii.WIDTH)
    edge = np.minimum(np.minimum(edge + 1, pii.WIDTH - edge), pii.OVERLAP + 1)
    some = 0
    for whole, found in zip(texts, tagger.tagged(texts), strict=True):
        score, weight = np.zeros((len(whole), pii.TAGS)), np.zeros(len(whole))
        for w in range(0, max(1, len(whole) - pii.OVERLAP), pii.STEP):
            part = whole[w : w + pii.WIDTH].astype(np.int64)
            to = -(-len(part) // pii.OVERLAP) * pii.OVERLAP
            own, _ = tagger.emissions(np.pad(part, (0, to - len(part)), constant_values=pii.CODES - 1)[None])
            near = edge.copy()
            near[: pii.OVERLAP] = np.where(w > 0, near[: pii.OVERLAP], pii.OVERLAP + 1)
            near[pii.STEP :] = np.where(w + pii.WIDTH < len(whole), near[pii.STEP :], pii.OVERLAP + 1)
            score[w : w + len(part)] += own[0, : len(part)] * near[: len(part), None]
            weight[w : w + len(part)] += near[: len(part)]
        path = tagger.viterbi(score / weight[:, None], np.array([0, len(whole)]))
        assert found == pii.spans_of(path, 0)
        some += 0 < (path > 0).sum() < len(path)
    assert some


def test_secrets_without_a_digit(spark):
    rng = random.Random(10)
    word = lambda: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randrange(12, 24)))
    secrets = [word() for _ in range(400)]
    rows = [(i, f"{prose(rng, LANGS['en'], 12)} password={s} {prose(rng, LANGS['en'], 14)}") for i, s in enumerate(secrets)]
    assert pii.labelled("my password=correcthorsebattery") == [("secret", 12, 31)]
    docs = table(spark, rows)
    tagger = pii.learn(docs.where("doc_id < 250"), epochs=10)
    held = docs.where("doc_id >= 250")
    spans = {r.doc_id: r.spans for r in pii.find(held, tagger).collect()}
    found = sum(f"secret:{t.index(secrets[i])}:{t.index(secrets[i]) + len(secrets[i])}" in spans[i].split(",") for i, t in rows[250:])
    assert found >= 0.8 * 150
    assert sum(secrets[r.doc_id] not in r.text for r in pii.redact(held, tagger).collect()) >= 0.8 * 150


def test_samples_are_bounded_under_repeated_rows(spark):
    """Neither null ids nor copies of one row make the samples of the learners larger."""
    same = [(7, "call 555 me@mail.example.org now")] * 3000
    unnamed = [(None, f"nothing but prose of number {i}") for i in range(3000)]
    found = pii.training_windows(table(spark, same + unnamed), "doc_id", "text", 50, 2).count()
    assert 0 < found <= 100
    rows = spark.createDataFrame([(*r, "en") for r in same + unnamed], "doc_id long, text string, lang string")
    assert 0 < ppm.sample(rows, "doc_id", "text", "lang", 200).count() < 300
