"""DuckDB SQL with the same rows, where SQL can say it."""

from __future__ import annotations

WORDS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

OP8 = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {WORDS} AS w FROM documents),
b AS (SELECT item_id, {WORDS} AS w FROM benchmark),
g AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS k, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS gram
  FROM b, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS t(i) WHERE len(w) > 0
),
sizes AS (SELECT DISTINCT k FROM g),
o AS (
  SELECT r, i, s.k, array_to_string(w[i:i + s.k - 1], ' ') AS gram
  FROM d, sizes s, unnest(range(1, len(w) - s.k + 2)) AS t(i) WHERE len(w) >= s.k
),
m AS (SELECT r, i, o.k, item_id FROM o JOIN g ON o.gram = g.gram AND o.k = g.k),
hit AS (SELECT r, count(DISTINCT p) AS n FROM m, unnest(range(i, i + k)) AS t(p) GROUP BY r),
items AS (SELECT r, count(*) AS n, string_agg(id, ',' ORDER BY id) AS ids FROM (SELECT DISTINCT r, item_id::varchar AS id FROM m) GROUP BY r)
SELECT doc_id, len(w)::bigint AS n_words, coalesce(hit.n, 0)::bigint AS n_hit, coalesce(items.n, 0)::bigint AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(hit.n, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (r) LEFT JOIN items USING (r)
"""


OP3 = """
WITH RECURSIVE v AS (
  SELECT row_number() OVER () AS r, vec_id, label, embedding::DOUBLE[] AS e FROM embeddings
  WHERE embedding IS NOT NULL AND label IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0
),
l AS (SELECT a.r AS ra, a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.r <> b.r AND len(a.e) = len(b.e) AND list_cosine_similarity(a.e, b.e) >= 0.93),
reach AS (SELECT a, b FROM l UNION SELECT reach.a, l.b FROM reach JOIN l ON reach.b = l.a)
SELECT vec_id, coalesce(n, 0)::bigint AS n_links, least(vec_id, coalesce(m, vec_id)) AS component_id, vec_id = least(vec_id, coalesce(m, vec_id)) AS kept
FROM embeddings LEFT JOIN (SELECT a, count(*) AS n FROM l GROUP BY a) c ON c.a = vec_id LEFT JOIN (SELECT a, min(b) AS m FROM reach GROUP BY a) g ON g.a = vec_id
"""

OP7 = """
WITH p AS (SELECT row_number() OVER () AS r, page_id, encode(coalesce(html, '')) AS payload FROM pages),
s AS (SELECT r, page_id, octet_length(payload) AS n, sha1(payload) AS sha FROM p),
d AS (SELECT DISTINCT sha, unhex(sha)::BIT::VARCHAR AS bits FROM s),
b AS (
  SELECT sha, string_agg(substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + 16 * substr(bits, 5 * i + 1, 1)::int + 8 * substr(bits, 5 * i + 2, 1)::int
    + 4 * substr(bits, 5 * i + 3, 1)::int + 2 * substr(bits, 5 * i + 4, 1)::int + substr(bits, 5 * i + 5, 1)::int, 1), '' ORDER BY i) AS digest
  FROM d, unnest(range(32)) AS t(i) GROUP BY sha
),
f AS (SELECT sha, min(page_id) AS first FROM s GROUP BY sha)
SELECT page_id, n::bigint AS payload_bytes, digest AS payload_digest, CASE WHEN page_id = first OR first IS NULL THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id = first THEN NULL ELSE first END AS refers_to
FROM s JOIN b USING (sha) JOIN f USING (sha)
"""


OP12 = r"""
WITH p AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents
),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM p),
g AS (SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase FROM w, (VALUES (1), (2), (3), (4)) AS s(k), unnest(range(1, len(w) - k + 2)) AS t(i) WHERE len(w) >= k),
n AS (SELECT lang, sum(len(w))::BIGINT AS n FROM w GROUP BY lang),
f AS (SELECT lang, k, phrase, count(*)::HUGEINT AS a FROM g GROUP BY ALL HAVING count(*) >= 30),
c AS (SELECT *, string_split(phrase, ' ') AS w FROM f WHERE k > 1),
parts AS (SELECT lang, phrase, a, i, array_to_string(w[1:i], ' ') AS lp, array_to_string(w[i + 1:], ' ') AS rp FROM c, (VALUES (1), (2), (3)) AS t(i) WHERE i < k),
cut AS (
  SELECT parts.lang, parts.phrase, i, l.a AS l, r.a AS r, (2000000 * parts.a) // (l.a + r.a) AS score
  FROM parts JOIN f l ON l.lang = parts.lang AND l.phrase = lp JOIN f r ON r.lang = parts.lang AND r.phrase = rp
),
low AS (SELECT lang, phrase, arg_min({'l': l, 'r': r, 'score': score}, score * 10 + i) AS x FROM cut GROUP BY ALL),
inner_ AS (
  SELECT lang, array_to_string(w[i:i + m - 1], ' ') AS phrase, max(a) AS longer
  FROM c, (VALUES (2), (3)) AS s(m), unnest(range(1, k - m + 2)) AS t(i) WHERE m < k GROUP BY ALL
),
left_ AS (SELECT c.lang, c.phrase, c.a, x.l AS l, x.r AS r, x.score AS score FROM c JOIN low USING (lang, phrase) LEFT JOIN inner_ i USING (lang, phrase) WHERE longer IS NULL OR 100 * longer < 80 * c.a)
SELECT lang, rank::BIGINT AS rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n, score::BIGINT AS score
FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM left_) JOIN n USING (lang) WHERE rank <= 2000
"""


OP13 = """
WITH d AS (SELECT row_number() OVER () AS r, doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
s AS (SELECT r, doc_id, i, substr(h, 2 * i + 1, 100) AS x FROM d, unnest(range(0, greatest(len(h) // 2 - 49, 0))) AS t(i)),
o AS (SELECT x, min(doc_id) AS first FROM s GROUP BY x HAVING min(doc_id) < max(doc_id)),
m AS (SELECT r, i FROM s JOIN o USING (x) WHERE first < doc_id),
e AS (SELECT r, i, CASE WHEN lag(i) OVER (PARTITION BY r ORDER BY i) + 50 >= i THEN 0 ELSE 1 END AS opens FROM m),
runs AS (SELECT r, min(i) AS a, max(i) + 50 AS b FROM (SELECT *, sum(opens) OVER (PARTITION BY r ORDER BY i) AS g FROM e) GROUP BY r, g),
cuts AS (SELECT r, b AS a, lead(a) OVER (PARTITION BY r ORDER BY a) AS b FROM (SELECT r, -1 AS a, 0 AS b FROM d UNION ALL SELECT r, a, b FROM runs)),
k AS (SELECT r, string_agg(substr(h, 2 * a + 1, 2 * (coalesce(b, len(h) // 2) - a)), '' ORDER BY a) AS kept FROM d JOIN cuts USING (r) GROUP BY r),
n AS (SELECT r, sum(b - a) AS n_removed, count(*) AS n_spans FROM runs GROUP BY r)
SELECT doc_id, (len(h) // 2)::BIGINT AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0)::BIGINT AS n_spans, sha256(unhex(kept)) AS kept_sha256
FROM d JOIN k USING (r) LEFT JOIN n USING (r)
"""


def build() -> dict[str, str]:
    return {"op3_pca_tiles": OP3, "op7_warc_segments": OP7, "op8_decontaminate": OP8, "op12_collocations": OP12, "op13_repeated_passages": OP13}
