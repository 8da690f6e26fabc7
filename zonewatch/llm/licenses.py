"""License scan by diagonal voting, in DataFrame and SQL functions only.

Words are lower-cased (A-Z) runs of digits, letters and characters beyond ASCII. All runs of three words of
every text are joined by hash (and words) with the positions of the same runs in the license templates,
a fixed table of a few dozen rows. A match at text position p and template position o votes for the diagonal
p - o; votes are added up per text, template and diagonal before any shuffle. Diagonals that lie at most
``GAP`` apart are merged (a word put in or left out moves the diagonal), and a merged span counts if it
holds ``SHARE`` of the template's runs within twice the template's length.

The same pass finds the base phrases word by word. Only one row per text, and one per text, template
and diagonal, leaves a task.

Defined cases: null and empty texts, and texts without words, have 0 words and no label; repeated rows and
null ids give a row each; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# The phrases that always count, with their labels.
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
# License notices, in words, with the labels that the voting adds.
TEMPLATES = (
    ("apache-2.0", "licensed under the apache license version 2 0"),
    ("cc-by-nc-4.0", "licensed under cc by nc 4 0"),
    ("cc-by-sa-4.0", "licensed under cc by sa 4 0"),
    ("gpl-3.0", "licensed under the gnu general public license version 3"),
    ("mit", "released under the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("mpl-2.0", "this source code form is subject to the terms of the mozilla public license v 2 0"),
)
RUN, GAP, SHARE = 3, 2, 0.6

UPPER, LOWERED = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def lowered(text: Column) -> Column:
    """A-Z in lower case, as far as words of ASCII go. ``lower`` is faster than ``translate``; the two
    characters beyond ASCII that it would turn into ASCII letters keep to ``translate``."""
    text = F.coalesce(text, F.lit(""))
    odd = F.contains(text, F.lit("K")) | F.contains(text, F.lit("İ"))
    return F.when(odd, F.translate(text, UPPER, LOWERED)).otherwise(F.lower(text))


def template_runs(spark) -> DataFrame:
    """(key, t0, t1, t2, places): each distinct run of the templates and where it stands."""
    places: dict[tuple, list] = {}
    for t, (_, text) in enumerate(TEMPLATES):
        words = text.split()
        for o in range(len(words) - RUN + 1):
            places.setdefault(tuple(words[o : o + RUN]), []).append((t, o))
    rows = ", ".join(f"('{a}', '{b}', '{c}', array({', '.join(f'named_struct("t", {t}, "o", {o})' for t, o in at)}))" for (a, b, c), at in places.items())
    return spark.sql(f"SELECT xxhash64(t0, t1, t2) AS key, * FROM VALUES {rows} AS v(t0, t1, t2, places)")


def voted(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """(row, doc_id, t, diagonal, ...): per text a row with null t for its words and base phrases, and a row for
    each template and diagonal."""
    words = F.regexp_extract_all(lowered(F.col(text)), F.lit(WORD), F.lit(0))
    base = docs.select(F.monotonically_increasing_id().alias("row"), F.col(doc_id).alias("doc_id"), words.alias("w0"))
    base = base.selectExpr("row", "doc_id", "w0", "slice(w0, 2, greatest(size(w0), 1)) AS w1", "slice(w0, 3, greatest(size(w0), 1)) AS w2")
    runs = base.selectExpr("row", "doc_id", "posexplode_outer(arrays_zip(w0, w1, w2)) AS (pos, run)").selectExpr("row", "doc_id", "pos", "run.w0 AS w0", "run.w1 AS w1", "run.w2 AS w2", "xxhash64(run.w0, run.w1, run.w2) AS key")
    known = F.broadcast(template_runs(docs.sparkSession))  # a fixed table
    met = runs.join(known, [runs.key == known.key, runs.w0 == known.t0, runs.w1 == known.t1, runs.w2 == known.t2], "left").selectExpr("row", "doc_id", "pos", "w0", "w1", "w2", "places")
    met = met.selectExpr("row", "doc_id", "pos", "w0", "w1", "w2", "posexplode_outer(places) AS (nth, place)")
    # a run with several places stands in several rows; its phrase counts in the first
    bits = " + ".join(f"if({phrase_test(p)}, {1 << i}, 0)" for i, p in enumerate(PHRASES))
    met = met.selectExpr("row", "doc_id", "pos", "place.t AS t", "pos - place.o AS diagonal", f"if(coalesce(nth, 0) = 0, coalesce({bits}, 0), 0) AS bits")
    return met.groupBy("row", "doc_id", "t", "diagonal").agg(
        F.expr("coalesce(max(pos) + 1, 0)").alias("n"),
        F.expr("sum(bit_count(bits))").alias("n_base"),
        F.expr("min(if(bits > 0, pos, NULL))").alias("first"),
        F.expr("max(if(bits > 0, pos, NULL))").alias("last"),
        F.expr("bit_or(bits)").alias("bits"),
        F.min("pos").alias("low"),
        F.max("pos").alias("high"),
        F.count("*").alias("votes"),
    )


def phrase_test(phrase: str) -> str:
    return " AND ".join(f"w{i} = '{w}'" for i, w in enumerate(phrase.split()))


def scan(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per text: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score and spans
    (label, first word, end word, share of the template) of the notices found."""
    votes = voted(docs, doc_id, text)
    sizes = "CASE t " + " ".join(f"WHEN {t} THEN {len(x.split())}" for t, (_, x) in enumerate(TEMPLATES)) + " END"
    names = "CASE t " + " ".join(f"WHEN {t} THEN '{label}'" for t, (label, _) in enumerate(TEMPLATES)) + " END"
    # the rows of one text are few: its diagonals. They are brought together once, by text
    line = Window.partitionBy("row", "doc_id", "t").orderBy("diagonal")
    cut = votes.withColumn("cut", (F.col("diagonal") - F.lag("diagonal").over(line) > GAP).cast("int"))
    merged = cut.withColumn("part", F.sum(F.coalesce("cut", F.lit(0))).over(line))
    spans = merged.groupBy("row", "doc_id", "t", "part").agg(
        F.max("n").alias("n"), F.sum("n_base").alias("n_base"), F.min("first").alias("first"), F.max("last").alias("last"), F.expr("bit_or(bits)").alias("bits"),
        F.min("low").alias("low"), F.max("high").alias("high"), F.sum("votes").alias("votes"),
    )
    spans = spans.withColumn("share", F.expr(f"least(1D, votes / cast({sizes} - {RUN - 1} AS double))"))
    spans = spans.withColumn("ok", F.expr(f"t IS NOT NULL AND share >= {SHARE}D AND high - low + {RUN} <= 2 * {sizes}"))
    labels = ", ".join(f"if(bits & {1 << i} > 0, '{label}', NULL)" for i, label in enumerate(PHRASES.values()))
    found = spans.groupBy("row", "doc_id").agg(
        F.max("n").cast("long").alias("n_words"),
        F.sum("n_base").cast("long").alias("n_base"),
        F.min("first").cast("long").alias("first_word"),
        F.max("last").cast("long").alias("last_word"),
        F.expr("bit_or(bits)").alias("bits"),
        F.expr(f"array_sort(collect_list(if(ok, struct({names} AS label, low AS first, high + {RUN} AS end, share), NULL)))").alias("spans"),
    )
    base_labels = f"array_sort(array_compact(array({labels})))"
    return found.selectExpr(
        "doc_id",
        "n_words",
        "n_base",
        "first_word",
        "last_word",
        f"concat_ws(',', {base_labels}) AS base_labels",
        f"concat_ws(',', array_sort(array_distinct(concat(array_compact(array({labels})), spans.label)))) AS labels",
        "coalesce(array_max(spans.share), 0D) AS score",
        "spans",
    )
