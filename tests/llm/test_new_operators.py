"""Alignment, collocations, suffix groups and repeated passages against plain Python."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

import __spark_entry__ as entry_points
from zonewatch.llm import alignment, collocations, passages, suffix_groups
from zonewatch.llm.queries import public_tokenizer

SF = "/root/testdata/sf0.001"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


# -- suffix groups ------------------------------------------------------------------------------


def by_sorting(text, bounds):
    out = [0]
    for a, b in zip(bounds[:-1], bounds[1:], strict=True):
        letters = [int(text[i]) if text[i] else i - 10**9 for i in range(a, b)]
        out += [a + k for k in sorted(range(b - a), key=lambda k, x=letters: x[k:])]
    return out


def test_suffix_arrays_are_those_of_sorting():
    rng = random.Random(3)
    for _ in range(150):
        text, bounds = [0], [1]
        for _ in range(rng.randrange(1, 6)):
            most = rng.choice([1, 2, 3, 30])
            for _ in range(rng.randrange(0, 5)):
                text += [rng.randint(1, most) for _ in range(rng.randrange(0, 40))] + [0]
            bounds.append(len(text))
        found = suffix_groups.suffix_array(np.array(text, np.uint16), np.array(bounds))
        assert found.tolist() == by_sorting(text, bounds)


# -- repeated passages --------------------------------------------------------------------------


def removed(rows, length):
    """By rows (id, text): bytes, removed bytes, spans, hash of the rest."""
    texts = [(i, (t or "").encode()) for i, t in rows]
    first = {}
    for i, t in texts:
        for k in range(len(t) - length + 1 if i is not None else 0):
            s = t[k : k + length]
            first[s] = min(first.get(s, i), i)
    out = []
    for i, t in texts:
        gone = [False] * len(t)
        for k in range(len(t) - length + 1 if i is not None else 0):
            if first[t[k : k + length]] < i:
                gone[k : k + length] = [True] * length
        spans = sum(g and not (k and gone[k - 1]) for k, g in enumerate(gone))
        out.append((i, len(t), sum(gone), spans, hashlib.sha256(bytes(b for b, g in zip(t, gone, strict=True) if not g)).hexdigest()))
    return out


def order(rows):
    return sorted(map(tuple, rows), key=lambda r: (r[0] is not None, *r) if r[0] is not None else (False, 0, *r[1:]))


def passage_rows():
    rng = random.Random(5)

    def words(n):
        return " ".join("".join(rng.choice("abcdeéß漢") for _ in range(rng.randrange(1, 8))) for _ in range(n))

    shared = [words(12) for _ in range(4)]
    rows = [(i, " ".join(rng.choice([words(9), rng.choice(shared)]) for _ in range(4))) for i in range(40)]
    rows += [(100 + i, rows[i][1]) for i in range(6)] + [(50, "x" * 300), (51, "x" * 120), (52, "ab" * 90), (53, "ab" * 70)]
    rows += [(60, None), (61, ""), (62, "short"), (None, rows[0][1]), (None, None), (3, rows[7][1]), (3, rows[7][1]), (-4, shared[0] * 3)]
    return rows


@pytest.mark.parametrize("hot", [1024, 1])
@pytest.mark.parametrize("length,core", [(50, 24), (20, 20), (30, 7)])
def test_passages_against_all_strings(spark, length, core, hot):
    rows = passage_rows()
    docs = spark.createDataFrame([(i, t, "k", 1) for i, t in rows], "doc_id long, text string, g string, low int").repartition(5)
    repeats = passages.learn(docs, length=length, core=core, hot=hot)
    found = passages.scan(docs, repeats)
    assert order(found.drop("spans").collect()) == order(removed(rows, length))
    for r in found.collect():
        assert len(r.spans) == r.n_spans and sum(b - a for a, b in r.spans) == r.n_removed
    cleaned = passages.clean(docs, repeats)
    assert cleaned.columns == docs.columns and cleaned.count() == len(rows)
    assert {r.text for r in cleaned.where("doc_id >= 100").collect()} == {""}


def test_passages_of_an_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert passages.scan(docs, passages.learn(docs)).count() == 0


def test_only_pieces_with_neighbours_are_sorted(monkeypatch):
    import pyarrow as pa

    rng, sorted_bytes = random.Random(2), []
    monkeypatch.setattr(passages, "suffix_array", lambda text, bounds: sorted_bytes.append(len(text)) or suffix_groups.suffix_array(text, bounds))
    one, two, three, four = ("".join(rng.choice("abcd") for _ in range(60)).encode() for _ in range(4))
    rows = [(1, 4, 9, one), (1, 3, 3, one), (2, 5, 5, two), (3, 7, 7, three), (3, 7, 7, four)]  # group, least and greatest id, piece
    group, low, high, piece = zip(*rows, strict=True)

    def found(kept):
        table = pa.table({"g": pa.array(group, pa.int64()), "low": pa.array(low, pa.int64()), "high": pa.array(high, pa.int64()), "piece": pa.array(piece, pa.binary())})
        return [r[1:] for b in passages.solved(table.take(kept), 50) for r in zip(*(c.to_pylist() for c in b.columns), strict=True)]

    assert found([0, 1, 2, 3, 4]) == [(3, 0, 11)] and not sorted_bytes
    piece = (one, one[5:], *piece[2:])
    assert sorted(found([0, 1, 2, 3, 4])) == [(3, 5, 11), (4, 0, 5)] and sorted_bytes == [1 + 61 + 56]


def test_a_group_of_copies_keeps_its_first(spark):
    text = "one line that a great many documents carry, word for word, from its first letter to its last"
    docs = spark.range(3000).selectExpr("id AS doc_id", f"concat(if(id % 3 = 0, '', cast(id AS string)), '{text}', if(id % 2 = 0, '', cast(id AS string))) AS text")
    found = {r.doc_id: r for r in passages.scan(docs, passages.learn(docs)).collect()}
    assert found[0].n_removed == 0 and all(r.n_removed >= len(text) for i, r in found.items() if i)


# -- collocations -------------------------------------------------------------------------------


def best_phrases(rows, least, longest, top, scale=2_000_000, covered=80):
    f = defaultdict(Counter)
    for lang, text in rows:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            w = re.findall(r"[^\x20\x09]+", piece)
            f[lang or "und"].update(tuple(w[i : i + k]) for k in range(1, longest + 1) for i in range(len(w) - k + 1))
    out = []
    for lang, c in f.items():
        n = sum(v for p, v in c.items() if len(p) == 1)
        some = {p: a for p, a in c.items() if len(p) > 1 and a >= least}
        kept = []
        for p, a in some.items():
            score, k = min((scale * a // (c[p[:k]] + c[p[k:]]), k) for k in range(1, len(p)))
            if not any(len(q) > len(p) and 100 * b >= covered * a and any(q[i : i + len(p)] == p for i in range(len(q))) for q, b in some.items()):
                kept.append((-score, -a, " ".join(p).encode(), c[p[:k]], c[p[k:]]))
        out += [(lang, i, p.decode(), -a, left, right, n, -s) for i, (s, a, p, left, right) in enumerate(sorted(kept)[:top], 1)]
    return sorted(out)


def phrase_rows():
    rng = random.Random(8)
    common, rare = ["the", "of", "Über", "a-b", "x's", "zu"], [f"w{k}" for k in range(60)]

    def text():
        return "".join(rng.choice(common if rng.random() < 0.7 else rare) + rng.choice([" ", " ", "  ", "\t", ". ", ",", "\n", "  "]) for _ in range(rng.randrange(0, 60)))

    rows = [(rng.choice(["en", "en", "fr", None, "und"]), text()) for _ in range(150)]
    return rows + [("de", "new york city hall " * 20), ("de", None), ("fr", ""), (None, "only four words here")] + [("en", "the same again and again")] * 12


@pytest.mark.parametrize("share,least,longest,top", [(0.125, 6, 4, 2000), (0.01, 5, 4, 20), (0.9, 10, 3, 50), (0.3, 4, 2, 10)])
def test_collocations_are_exact_whatever_the_sample(spark, share, least, longest, top):
    rows = phrase_rows()
    docs = spark.createDataFrame([(x, t, 1, 2) for x, t in rows], "lang string, text string, key int, n int").repartition(4)
    found = collocations.mine(docs, least=least, longest=longest, top=top, share=share)
    assert sorted(map(tuple, found.collect())) == best_phrases(rows, least, longest, top)


def test_failures_of_the_border_are_followed_until_it_is_closed(spark):
    """Nothing is proposed at all: each pass can add one length."""
    rows = phrase_rows()
    docs = spark.createDataFrame([(x or "und", t or "") for x, t in rows], "lang string, text string")
    nothing = spark.createDataFrame([(1,)], "key long")
    passes = collocations.closed(docs, nothing, 5, 4)
    assert len(passes) == 4
    whole = collocations.closed(docs, passes[0].select("key").union(passes[1].select("key")).union(passes[2].select("key")).union(passes[3].select("key")), 5, 4)
    assert len(whole) == 1
    assert sorted(map(tuple, whole[0].collect())) == sorted(tuple(r) for p in passes for r in p.collect())


def test_passes_for_failures_read_only_the_pieces_that_hold_them(spark, monkeypatch):
    rows, counted, read = [(x or "und", t or "") for x, t in phrase_rows()], collocations.counted, []
    failing = [("en", "The of zu; a run that Nobody proposed, the of"), ("zz", "Ünd one\tmore\r\n")] * 7
    as_docs = lambda rows: spark.createDataFrame(rows, "lang string, text string").repartition(3)
    proposals = collocations.closed(as_docs(rows), None, 5, 4)
    proposals = proposals[0].select("key").union(proposals[1].select("key")).union(proposals[2].select("key")).union(proposals[3].select("key"))
    docs = as_docs(rows + failing)
    whole = collocations.closed(docs, None, 5, 4)

    def watched(docs, *rest):
        read.append(docs.selectExpr("sum(length(text))").first()[0])
        return counted(docs, *rest)

    monkeypatch.setattr(collocations, "counted", watched)
    passes = collocations.closed(docs, proposals, 5, 4)
    assert sorted(tuple(r) for p in passes for r in p.collect()) == sorted(tuple(r) for p in whole for r in p.collect())
    held = 7 * (len("a run that nobody proposed") + len("ünd one more"))
    assert len(read) == 4 and read[0] > 2 * max(read[1:]) and all(n >= held for n in read[1:])


def test_collocations_of_an_empty_table(spark):
    assert collocations.mine(spark.createDataFrame([], "lang string, text string")).count() == 0


def test_scores_pass_64_bits(spark):
    big = 9 * 10**15
    found = spark.createDataFrame([(1, "en", "a b", big, 5 * big, [big + 1], [3 * big], [])], "key long, lang string, phrase string, a long, n long, lefts array<long>, rights array<long>, inside array<long>")
    row = collocations.ranked(found, 5, 2_000_000, 80).first()
    assert row.score == 2_000_000 * big // (4 * big + 1)


# -- alignment ----------------------------------------------------------------------------------


def plain_tokens(text, pair):
    if not text:
        return None
    part = b" " + text.encode()
    a = pair.a.encode(part.decode(), add_special_tokens=False).ids
    b = pair.b.encode(text)
    same = b"".join(pair.a_bytes[i] for i in a) == part == b"".join(pair.b_bytes[i] for i in b)
    return (a, b) if same else None


def by_ranges(texts, pair):
    """Per text: n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256, n_overlaps."""
    docs = []
    for t in texts:
        tokens = plain_tokens(t, pair)
        if tokens is None:
            docs.append(None)
            continue
        spans = []
        for ids, of in zip(tokens, (pair.a_bytes, pair.b_bytes), strict=True):
            at, own = 0, []
            for i in ids:
                own.append((at, at + len(of[i]), i))
                at += len(of[i])
            spans.append(own)
        ends = sorted({e for _, e, _ in spans[0]} & {e for _, e, _ in spans[1]})
        groups, start = [], 0
        for e in ends:
            groups.append([[i for s, x, i in own if start < x <= e] for own in spans])
            start = e
        overlaps, j = 0, 0
        for s, e, _ in spans[0]:
            while spans[1][j][1] <= s:
                j += 1
            k = j
            while k < len(spans[1]) and spans[1][k][0] < e:
                overlaps += 1
                k += 1
        docs.append((len(tokens[0]), len(tokens[1]), groups, overlaps))
    held = Counter(p for d in docs if d for p in {(x, y) for g in d[2] for x in g[0] for y in g[1]})
    best = defaultdict(int)
    for (x, _), n in held.items():
        best[x] = max(best[x], n)
    out = []
    for d in docs:
        if d is None:
            out.append((0, 0, 0, 0, 0, 0, "", 0))
            continue
        links = [(x, y) for g in d[2] for x in g[0] for y in g[1]]
        text = ";".join("|".join(",".join(map(str, side)) for side in g) for g in d[2])
        out.append((d[0], d[1], len(d[2]), len(links), sum(held[p] == best[p[0]] for p in links), sum(held[p] for p in links), hashlib.sha256(text.encode()).hexdigest(), d[3]))
    return out


ODD = [
    None, "", " ", "  ", "a", " lead", "trail ", "two  blanks   here", "tab\tand\nline\r\n", "no break  wide ", "▁ under ▁▁ a", "ä ö ü éé à é", "漢字 かな 漢 字", "emoji 🎉🎉 x 👩‍👩‍👧 y",
    "<|endoftext|> and <s> </s> <unk> <0x41>", "\x00\x01 \x7f", "Ünï-cödé'll don't I've", "1234567890 12.5,7", "x" * 4000, "word " * 3000, "́ combining ́", "a\u0085b \u0085 c", "ﬁ ﬂ ½ ①", "　　 idéo　", "é " * 5, "日 本 " * 3, "я и ты ", "tail é",
]


def test_alignment_of_odd_texts(spark):
    pytest.importorskip("public_tokenizers")
    where = public_tokenizer("byte_bpe_50k.json"), public_tokenizer("piece_bpe_32k.model")
    pair = alignment.loaded(*(w() for w in where))
    assert pair.may_cut
    rows = [(i if i % 5 else None, t, 1, "z") for i, t in enumerate(ODD + ODD[:9])]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_a int, pairs string").repartition(3)
    found = alignment.align(docs, *where).drop("pairs", "times").collect()
    assert sorted(tuple(r)[1:] for r in found) == sorted(by_ranges(ODD + ODD[:9], pair))
    assert Counter(r.doc_id for r in found) == Counter(r[0] for r in rows)
    assert alignment.align(docs.limit(0), *where).count() == 0


def test_op11(spark):
    pytest.importorskip("public_tokenizers")
    pair = alignment.loaded(public_tokenizer("byte_bpe_50k.json")(), public_tokenizer("piece_bpe_32k.model")())
    rows = spark.read.parquet(f"{SF}/documents.parquet").collect()
    found = {r.doc_id: tuple(r)[1:] for r in entry_points.queries()["op11_token_alignment"](spark, SF).collect()}
    assert found == dict(zip((r.doc_id for r in rows), by_ranges([r.text for r in rows], pair), strict=True))


def test_products_are_those_of_numpy():
    rng = np.random.default_rng(2)
    for n, m, k in ((1, 1, 1), (5, 7, 3), (40, 30, 20), (3, 0, 4)):
        x, y = (rng.random((n, m)) < 0.3).astype(int), (rng.random((m, k)) < 0.3).astype(int)
        rows = alignment.Rows.ones(*np.nonzero(x), n, m).times(alignment.Rows.ones(*np.nonzero(y), m, k))
        dense = np.zeros((n, k), int)
        dense[rows.rows(), rows.column] = rows.value
        assert (dense == x @ y).all() and (np.diff(rows.rows()) >= 0).all()
