"""License scan: a positional index of license notices, asked for each file's rarest license words.

A template is a notice with the phrases that must stand in it. The index lists, for each
word of the templates, where it stands in which. Common words of the language are in it but are never
asked for. Of the other template words that a file holds, the index is asked for those
of highest IDF, per template; IDF comes from how many files of the corpus
hold the word. Answers that agree on where the template would begin (place in the file less place in
the template) are met by counting; where enough of them agree, all words of the template
are looked up at their places. The template is found if all words of its phrases are there.

Everything is a DataFrame expression: a file's words are found and reduced to its license words in
one projection, and only these meet the index in joins. The templates, and so the index and the
table of IDF, are parameters of fixed size, whatever the corpus.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from eventide.llm.common import table, written

#: Digits, letters A-Z in either case, and characters beyond ASCII.
WORDS = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
#: Fixed phrases of the registered query and their labels.
PHRASES = (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))
#: (label, notice, phrases that must stand in it). The wording is that of the public licenses.
TEMPLATES = (
    ("mit", "Released under the MIT License", ("MIT License",)),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
            "documentation files", ("Permission is hereby granted, free of charge", "obtaining a copy of this software")),
    ("apache", "Licensed under the Apache License, Version 2.0", ("Apache License",)),
    ("gpl", "This work is licensed under the GNU General Public License, version 3", ("GNU General Public License",)),
    ("gpl", "either version 3 of the License, or (at your option) any later version", ("at your option", "any later version")),
    ("lgpl", "licensed under the GNU Lesser General Public License", ("Lesser General Public License",)),
    ("agpl", "licensed under the GNU Affero General Public License", ("Affero General Public License",)),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
            "the following conditions are met", ("Redistribution and use in source and binary forms", "conditions are met")),
    ("bsd", "Licensed under the BSD 3-Clause License", ("BSD 3-Clause",)),
    ("bsd", "Licensed under the BSD 2-Clause License", ("BSD 2-Clause",)),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted",
     ("Permission to use, copy, modify", "with or without fee is hereby granted")),
    ("mpl", "subject to the terms of the Mozilla Public License, v. 2.0", ("Mozilla Public License",)),
    ("unlicense", "This is free and unencumbered software released into the public domain", ("unencumbered software", "public domain")),
    ("cc0", "Licensed under CC0 1.0 Universal", ("CC0 1.0",)),
    ("cc-by", "Licensed under CC BY 4.0", ("CC BY 4.0",)),
    ("cc-by-sa", "Licensed under CC BY-SA 4.0", ("CC BY-SA",)),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0", ("CC BY-NC",)),
    ("cc-by-nd", "Licensed under CC BY-ND 4.0", ("CC BY-ND",)),
    ("cc-by", "Creative Commons Attribution 4.0 International License", ("Creative Commons Attribution 4.0",)),
    ("cc-by-sa", "Creative Commons Attribution-ShareAlike 4.0 International License", ("Creative Commons Attribution-ShareAlike",)),
    ("cc-by-nc", "Creative Commons Attribution-NonCommercial 4.0 International License", ("Creative Commons Attribution-NonCommercial",)),
    ("epl", "made available under the terms of the Eclipse Public License 2.0", ("Eclipse Public License",)),
    ("boost", "Distributed under the Boost Software License, Version 1.0", ("Boost Software License",)),
)
#: Words that stand in most texts of a language; the index is never asked for them.
COMMON = frozenset("a and any are at by for in into is it of or that the this to under use with without your 0 1 2 3 4".split())
ASKED = 4          # words of a file that are asked for, per template
AGREE = 2          # answers that must agree on a place (one, if the template has only one word to ask for)
PHRASE_SCORE = 0.5  # score of a file with a phrase but without a template


def words_of(text: str) -> list[str]:
    return [w.translate({c: c + 32 for c in range(65, 91)}) for w in re.findall(WORDS, text)]


def _stands(words: list[str], phrase: list[str]) -> list[int]:
    return [i for i in range(len(words) - len(phrase) + 1) if words[i:i + len(phrase)] == phrase]


def index_rows(templates=TEMPLATES) -> list[tuple]:
    """``(word, template, at, asked, must, label, size, musts, answers)``, one per word of a template:
    ``asked`` if the index is asked for it, ``must`` if it is in a phrase that must stand;
    ``size``, ``musts`` and ``answers`` are the template's words, words that must stand and answers that must agree."""
    out = []
    for n, (label, notice, phrases) in enumerate(templates):
        words, must = words_of(notice), set()
        for phrase in map(words_of, phrases):
            if not phrase or not _stands(words, phrase):
                raise ValueError(f"the phrase {' '.join(phrase)!r} does not stand in template {n}")
            must.update(range(_stands(words, phrase)[0], _stands(words, phrase)[0] + len(phrase)))
        asked = [w not in COMMON for w in words]
        if not must or not any(asked):
            raise ValueError(f"template {n} has no phrase or only common words")
        out += [(w, n, at, asked[at], at in must, label, len(words), len(must), min(AGREE, sum(asked))) for at, w in enumerate(words)]
    return out


INDEX = "word string, template int, at int, asked boolean, must boolean, label string, size int, musts int, answers int"


def _table(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    names = [c.split()[0] for c in schema.split(", ")]
    made = F.array(*[F.struct(*[F.lit(v).alias(n) for n, v in zip(names, r)]) for r in rows])
    return spark.range(1).select(F.inline(made)).to(spark.range(0).select(*[F.lit(None).cast(c.split()[1]).alias(c.split()[0]) for c in schema.split(", ")]).schema)


def _is_one_of(word: Column, names: list[str]) -> Column:
    """``word``, with A-Z in lower case, is one of ``names`` (ASCII). Other characters that have
    an ASCII letter as their lower case are longer than it."""
    return F.lower(word).isin(*names) & (F.octet_length(word) == F.octet_length(F.lower(word)))


def _places(found: Column, phrase: list[str], label: str) -> Column:
    """Where the words of ``phrase`` stand one after another, from a file's license words in order."""
    def at(h, i):
        ok = h["word"] == phrase[0]
        for j, w in enumerate(phrase[1:], 1):
            nth = F.get(found, i + F.lit(j))
            ok = ok & (nth["word"] == w) & (nth["pos"] == h["pos"] + F.lit(j))
        return F.when(ok, F.struct(h["pos"].alias("pos"), F.lit(label).alias("label")))
    return F.filter(F.transform(found, at), lambda p: p.isNotNull())


def license_words(docs: DataFrame, phrases=PHRASES, templates=TEMPLATES) -> DataFrame:
    """``(file, doc_id, n_words, found, base)``, one row per row of ``docs``: ``found`` the words of
    phrases and templates with their places, in order (none in a file without one that is not
    common), ``base`` the places of phrases with their labels. ``file`` numbers the rows; stored, so it stays."""
    base = [(words_of(p), label) for p, label in phrases]
    all_words = {r[0] for r in index_rows(templates)} | {w for p, _ in base for w in p}
    if not all(w.isascii() for w in all_words) or not all(p for p, _ in base):
        raise ValueError("phrases and templates must be made of ASCII words")
    rare = sorted({r[0] for r in index_rows(templates) if r[3]} | {w for p, _ in base for w in p})
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.monotonically_increasing_id().alias("file"), "doc_id", F.regexp_extract_all(text, F.lit(WORDS), F.lit(0)).alias("words"))
    marked = F.filter(F.transform("words", lambda w, i: F.when(
        _is_one_of(w, sorted(all_words)), F.struct(i.alias("pos"), F.lower(w).alias("word")))), lambda h: h.isNotNull())
    none = F.array().cast("array<struct<pos:int,word:string>>")
    rows = rows.select("file", "doc_id", F.size("words").cast("long").alias("n_words"),
                       F.when(F.exists("words", lambda w: _is_one_of(w, rare)), marked).otherwise(none).alias("found"))
    places = F.concat(F.array().cast("array<struct<pos:int,label:string>>"), *[_places(F.col("found"), p, label) for p, label in base])
    return written(rows.withColumn("base", places), "license-words")


def notices(files: DataFrame, templates=TEMPLATES, asked: int = ASKED) -> DataFrame:
    """``(file, template, label, begins, share)``: every place where a template is found, from the rows of
    ``license_words``; ``begins`` is the place of the template's first word (negative if
    the text begins within it), ``share`` how much of its words stand there."""
    spark = files.sparkSession
    index = F.broadcast(_table(spark, index_rows(templates), INDEX))       # as long as the templates
    found = files.select("file", F.inline("found"))
    held = (files.select(F.explode(F.array_distinct(F.transform("found", lambda h: h["word"]))).alias("word"))
            .groupBy("word").agg(F.count(F.lit(1)).alias("files")))        # highest IDF: in the fewest files
    answers = (found.join(index.filter("asked").select("word", "template", "at", "answers"), "word")
               .join(F.broadcast(held), "word"))                           # at most a row per word of the templates
    rank = F.dense_rank().over(Window.partitionBy("file", "template").orderBy("files", "word"))
    places = (answers.withColumn("rank", rank).filter(F.col("rank") <= asked)
              .groupBy("file", "template", (F.col("pos") - F.col("at")).alias("begins"), "answers").agg(F.count(F.lit(1)).alias("agree"))
              .filter("agree >= answers").select("file", "template", "begins"))
    wanted = places.join(index.select("template", "label", "at", "word", "must", "size", "musts"), "template")
    wanted = wanted.withColumn("pos", F.col("begins") + F.col("at"))
    there = wanted.join(found, ["file", "pos", "word"])
    return (there.groupBy("file", "template", "label", "begins", "size", "musts")
            .agg(F.count(F.lit(1)).alias("stand"), F.count_if("must").alias("must_stand"))
            .filter("must_stand = musts")
            .select("file", "template", "label", "begins", (F.col("stand") / F.col("size")).alias("share")))


def scan(docs: DataFrame, phrases=PHRASES, templates=TEMPLATES, asked: int = ASKED) -> DataFrame:
    """One row per row of ``docs``: ``(doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score)``.

    ``n_base`` counts the places of the phrases, ``first_word`` and ``last_word`` are the smallest and the
    largest (null without any), ``base_labels`` their labels; ``labels`` adds those of the
    templates found. Both lists are distinct, sorted and joined by commas. ``score`` is the largest share of
    a found template's words that stands in its place, at least ``PHRASE_SCORE`` with a phrase, else 0.

    Null and empty texts have no words and no labels. Repeated rows and rows of equal or null id are files of their
    own. Words of equal IDF are asked for in the order of the alphabet. A very long text is one
    row, and its license words are rows of the joins. No rows give none; other columns are not read.
    """
    files = license_words(docs, phrases, templates)
    more = notices(files, templates, asked).groupBy("file").agg(F.collect_set("label").alias("more"), F.max("share").alias("share"))
    pos = F.transform("base", lambda p: p["pos"])
    own = F.transform("base", lambda p: p["label"])
    rows = files.select("file", "doc_id", "n_words", F.size("base").cast("long").alias("n_base"), F.array_min(pos).cast("long").alias("first_word"),
                        F.array_max(pos).cast("long").alias("last_word"), F.array_sort(F.array_distinct(own)).alias("own"))
    rows = rows.join(more, "file", "left")
    labels = F.array_sort(F.array_union("own", F.coalesce("more", F.array().cast("array<string>"))))
    score = F.greatest(F.coalesce("share", F.lit(0.0)), F.when(F.col("n_base") > 0, F.lit(PHRASE_SCORE)).otherwise(F.lit(0.0)))
    return rows.select("doc_id", "n_words", "n_base", "first_word", "last_word", F.array_join("own", ",").alias("base_labels"),
                       F.array_join(labels, ",").alias("labels"), score.alias("score"))


def op13_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(table(spark, sf_dir, "documents"))


def _values(rows: list[tuple]) -> str:
    return ", ".join("(" + ", ".join(repr(v) if isinstance(v, str) else str(v).lower() for v in r) + ")" for r in rows)


OP13_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS file, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM documents),
i(word, template, place, asked, must, label, size, musts, answers) AS (VALUES """ + _values(index_rows()) + r"""),
b(w1, w2, w3, label) AS (VALUES """ + _values([(*(p.split() + [""])[:3], label) for p, label in PHRASES]) + r"""),
w AS (SELECT file, unnest(words) AS word, generate_subscripts(words, 1) - 1 AS pos, words FROM d),
places AS (
  SELECT file, pos, label FROM w JOIN b ON w.word = b.w1 AND words[pos + 2] = b.w2 AND (b.w3 = '' OR words[pos + 3] = b.w3)),
base AS (
  SELECT file, count(*) AS n_base, min(pos) AS first_word, max(pos) AS last_word, list(DISTINCT label) AS own FROM places GROUP BY file),
held AS (SELECT word, count(DISTINCT file) AS files FROM w WHERE word IN (SELECT word FROM i) GROUP BY word),
ranked AS (
  SELECT w.file, i.template, i.place, w.pos, i.answers, dense_rank() OVER (PARTITION BY w.file, i.template ORDER BY held.files, w.word) AS r
  FROM w JOIN i ON i.word = w.word AND i.asked JOIN held ON held.word = w.word),
begun AS (
  SELECT file, template, pos - place AS begins FROM ranked WHERE r <= """ + str(ASKED) + r"""
  GROUP BY file, template, pos - place, answers HAVING count(*) >= answers),
seen AS (
  SELECT g.file, g.template, g.begins, i.label, count(*) / i.size AS share
  FROM begun g JOIN i ON i.template = g.template JOIN w ON w.file = g.file AND w.pos = g.begins + i.place AND w.word = i.word
  GROUP BY g.file, g.template, g.begins, i.label, i.size, i.musts HAVING count(*) FILTER (WHERE i.must) = i.musts),
more AS (SELECT file, list(DISTINCT label) AS labels, max(share) AS share FROM seen GROUP BY file)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(n_base, 0) AS n_base, CAST(first_word AS BIGINT) AS first_word,
  CAST(last_word AS BIGINT) AS last_word, coalesce(array_to_string(list_sort(own), ','), '') AS base_labels,
  coalesce(array_to_string(list_sort(list_distinct(list_concat(coalesce(own, []), coalesce(labels, [])))), ','), '') AS labels,
  greatest(coalesce(share, 0.0), CASE WHEN n_base > 0 THEN 0.5 ELSE 0.0 END)::DOUBLE AS score
FROM d LEFT JOIN base USING (file) LEFT JOIN more USING (file)
"""
