"""License scans with a positional index of rare licence words.

Each text becomes an array of licence-word numbers (0: another word), so all
later steps work on positions. Document frequencies of the licence words give
their IDF. Per text and template, the template's words that occur in the text
are looked up in IDF order; the ``ANCHORS`` rarest give candidate starts
(place in the text minus place in the template) from the template postings.
Candidates are scored by the share of template words in place; a label needs
``MIN_SHARE`` and every mandatory phrase in place. Base phrases are counted at
every place where their words stand consecutively.

One pass over the texts; no shuffle but the count per licence word.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .base import cut

# Words are cut before lower-casing; A-Z are word characters here and lower-cased later.
WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
BASE = (("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved"))
ANCHORS = 3
MIN_SHARE = 0.8

# label, template words, mandatory phrases (each must be in place)
TEMPLATES = (
    ("apache", "licensed under the apache license version 2 0", ("apache license",)),
    ("mit", "released under the mit license", ("mit license",)),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy",
     ("hereby granted", "free of charge")),
    ("gpl", "licensed under the gnu general public license version 3", ("general public license",)),
    ("cc-by-nc", "licensed under cc by nc 4 0", ("cc by nc",)),
    ("cc-by-sa", "licensed under cc by sa 4 0", ("cc by sa",)),
    ("cc-by", "licensed under cc by 4 0", ("cc by",)),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted",
     ("source and binary forms",)),
    ("mpl", "subject to the terms of the mozilla public license v 2 0", ("mozilla public license",)),
    ("unlicense", "this is free and unencumbered software released into the public domain",
     ("unencumbered software", "public domain")),
    ("reserved", "copyright all rights reserved", ("all rights reserved",)),
)


def _vocabulary(templates) -> dict[str, int]:
    words = " ".join([b for b, _ in BASE] + [t for _, t, _ in templates]).split()
    return {w: i for i, w in enumerate(dict.fromkeys(words), 1)}


def _phrase_test(phrase: list[int], offset: int = 0):
    """Tells whether the numbered words of a phrase stand in ``ids`` from a start plus ``offset`` on."""
    def test(start: Column) -> Column:
        same = [F.get("ids", start + (k + offset)) == w for k, w in enumerate(phrase)]
        return F.coalesce(reduce(lambda a, b: a & b, same), F.lit(False))
    return test


def _offset(template: list[int], phrase: list[int]) -> int:
    return next(i for i in range(len(template)) if template[i:i + len(phrase)] == phrase)


def _best_share(template: list[int], phrases: list[list[int]], df: dict[int, int]) -> Column:
    """Best share of template words in place over all verified candidate starts; 0 without one."""
    order = sorted(set(template), key=lambda w: (df.get(w, 0), w))              # highest IDF first
    anchors = F.slice(F.filter(F.array(*[F.lit(w) for w in order]), lambda w: F.array_contains("have", w)), 1, ANCHORS)
    posting = F.array(*[F.struct(F.lit(w).alias("w"), F.lit(i).alias("i")) for i, w in enumerate(template)])

    def starts_from(place: Column) -> Column:
        return F.transform(F.filter(posting, lambda q: q.w == F.get("ids", place)), lambda q: place - q.i)

    places = F.filter("at", lambda p: F.array_contains(anchors, F.get("ids", p)))
    starts = F.array_distinct(F.flatten(F.transform(places, starts_from)))
    tests = [_phrase_test(p, _offset(template, p)) for p in phrases]
    verified = F.filter(starts, lambda s: reduce(lambda a, b: a & b, [t(s) for t in tests]))

    def share(start: Column) -> Column:
        hits = [F.coalesce((F.get("ids", start + i) == w).cast("int"), F.lit(0)) for i, w in enumerate(template)]
        return reduce(lambda a, b: a + b, hits) / len(template)

    present = [F.array_contains("have", w) for w in sorted({w for p in phrases for w in p})]
    return F.coalesce(F.when(reduce(lambda a, b: a & b, present), F.array_max(F.transform(verified, share))), F.lit(0.0))


def scan(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", templates=TEMPLATES) -> DataFrame:
    """Per row: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score.

    ``first_word`` and ``last_word`` are the smallest and largest start of a
    base phrase (null without one). ``score`` is 1 with a base phrase, else the
    best share of a verified template, else 0. Null and empty texts have no
    words. Repeated rows and null ids keep their rows; an empty table gives
    none. Other columns are not read.
    """
    number = _vocabulary(templates)
    lookup = F.create_map(*[F.lit(v) for kv in number.items() for v in kv])
    vocab = list(number)

    def word_id(x: Column) -> Column:
        low = F.lower(x)
        return F.when(low.isin(vocab) & x.rlike(r"\A[\x00-\x7F]+\z"), F.element_at(lookup, low)).otherwise(F.lit(0))

    words = docs.select(F.col(f"`{doc_id}`").alias("doc_id"),
                        F.regexp_extract_all(F.coalesce(F.col(f"`{text}`"), F.lit("")), F.lit(WORD), F.lit(0)).alias("w"))
    table = cut(words.select("doc_id", F.size("w").cast("long").alias("n_words"),
                             F.transform("w", word_id).alias("ids")), "license-ids")

    # document frequency of the licence words: one row per word, bounded by the templates
    seen = table.select(F.explode(F.array_distinct("ids")).alias("id")).filter("id > 0").groupBy("id").count().collect()
    df = {r["id"]: r["count"] for r in seen}

    rows = table.select("doc_id", "n_words", "ids", F.filter(
        F.transform("ids", lambda x, i: F.when(x > 0, i)), lambda x: x.isNotNull()).alias("at"))
    rows = rows.select("*", F.array_distinct(F.transform("at", lambda p: F.get("ids", p))).alias("have"))
    found = [F.filter("at", _phrase_test([number[w] for w in phrase.split()])).alias(f"b{k}")
             for k, (phrase, _) in enumerate(BASE)]
    for k, (_, words_of, phrases) in enumerate(templates):
        t = [number[w] for w in words_of.split()]
        found.append(_best_share(t, [[number[w] for w in p.split()] for p in phrases], df).alias(f"t{k}"))
    got = rows.select("doc_id", "n_words", *found)
    nb = len(BASE)
    sizes = [F.size(f"b{k}") for k in range(nb)]
    base = F.filter(F.array(*[F.when(F.size(f"b{k}") > 0, F.lit(label)) for k, (_, label) in enumerate(BASE)]),
                    lambda x: x.isNotNull())
    more = F.filter(F.array(*[F.when(F.col(f"t{k}") >= MIN_SHARE, F.lit(label))
                              for k, (label, _, _) in enumerate(templates)]), lambda x: x.isNotNull())
    n_base = reduce(lambda a, b: a + b, sizes).cast("long")
    top = F.greatest(F.lit(0.0), *[F.when(F.col(f"t{k}") >= MIN_SHARE, F.col(f"t{k}")).otherwise(0.0)
                                   for k in range(len(templates))])
    return got.select(
        "doc_id", "n_words", n_base.alias("n_base"),
        F.least(*[F.array_min(f"b{k}") for k in range(nb)]).cast("long").alias("first_word"),
        F.greatest(*[F.array_max(f"b{k}") for k in range(nb)]).cast("long").alias("last_word"),
        F.array_join(F.sort_array(F.array_distinct(base)), ",").alias("base_labels"),
        F.array_join(F.sort_array(F.array_union(base, more)), ",").alias("labels"),
        F.when(n_base > 0, 1.0).otherwise(top).alias("score"))
