"""Licence texts in files, found by a positional index of their rarest words.

Each template lists its words.  Document frequencies over all files tell which of a template's words are
rare; those with the highest IDF are its index, with their places (postings), as many as together weigh more than
what may be missing, so that every text that will do holds one.  A file's index words and their places give
candidates (template, start).  A candidate is accepted if enough of the template's words,
weighed by IDF, stand at the same relative places, and if its key phrase stands there word by word.
DataFrame functions only.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import accumulate

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventlink.llm.common import let, words


@dataclass(frozen=True)
class Template:
    """``text``: lower-case words; ``key``: the phrase of it that must stand there; it may be all of it."""

    label: str
    text: str
    key: str


# The base phrases and their labels.
BASE = [
    Template("cc-by", "cc by", "cc by"),
    Template("gpl", "general public license", "general public license"),
    Template("reserved", "all rights reserved", "all rights reserved"),
]
#: Opening words of well-known licences.
TEMPLATES = [
    Template("apache-2.0", "licensed under the apache license version 2 0", "apache license"),
    Template("gpl-3.0", "licensed under the gnu general public license version 3", "gnu general public license"),
    Template("cc-by-nc-4.0", "licensed under cc by nc 4 0", "cc by nc"),
    Template("cc-by-4.0", "licensed under cc by 4 0", "cc by 4 0"),
    Template(
        "mit",
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files",
        "permission is hereby granted free of charge",
    ),
    Template(
        "bsd",
        "redistribution and use in source and binary forms with or without modification are permitted",
        "redistribution and use in source and binary forms",
    ),
    Template("mpl-2.0", "subject to the terms of the mozilla public license v 2 0", "mozilla public license"),
]
#: The share of a template's weight that must stand at its place.
SHARE = 0.75


def frequencies(w: Column, docs: DataFrame, vocabulary: list[str]) -> tuple[int, dict[str, int]]:
    """Number of files, and of those with each word of ``vocabulary`` (of bounded size)."""
    wanted = F.array(*map(F.lit, vocabulary))
    found = docs.select(F.explode(F.concat(F.array(F.lit("")), F.array_intersect(w, wanted))).alias("word"))
    rows = found.groupBy("word").agg(F.count("*").alias("n")).toLocalIterator()
    n = {r["word"]: r["n"] for r in rows}
    return n.pop("", 0), n


def _array(values, item) -> Column:
    return F.array(*map(item, values))


def scan_licenses(
    docs: DataFrame,
    text: str = "text",
    keep: tuple[str, ...] = ("doc_id",),
    base: list[Template] = BASE,
    templates: list[Template] = TEMPLATES,
) -> DataFrame:
    """Licence phrases of every whole text.

    Columns: ``keep``, n_words, ``places``: array of (label, start, base) of base phrases and accepted
    templates, ``share``: the greatest weight share of an accepted template (1 for a base phrase, 0 if
    nothing is found).  Null and empty texts have no words and no places; repeated rows stay; with an
    empty table nothing is found.
    """
    own = docs.select(*[F.col(c).alias(f"_k{i}") for i, c in enumerate(keep)], words(F.col(text)).alias("w"))
    every = [*base, *templates]
    vocabulary = sorted({x for t in every for x in t.text.split()})
    total, seen = frequencies(F.col("w"), own, vocabulary)
    idf = {x: float(np.log1p((total + 1) / (seen.get(x, 0) + 0.5))) for x in vocabulary}
    cards, postings = [], []
    for k, t in enumerate(every):
        own_words = t.text.split()
        weight = [idf[x] for x in own_words]
        rare = sorted(range(len(own_words)), key=lambda j: (-weight[j], j))
        missing = 0.0 if t in base else (1 - SHARE) * sum(weight)
        n = 1 + next(i for i, w in enumerate(accumulate(weight[j] for j in rare)) if w > missing * (1 + 1e-9))
        postings += [(own_words[j], k, j) for j in rare[:n]]
        cards.append((t, own_words, weight, t.key.split(), t in base))
    index = _array(sorted({p[0] for p in postings}), F.lit)
    posting = _array(
        postings, lambda p: F.struct(F.lit(p[0]).alias("word"), F.lit(p[1]).alias("t"), F.lit(p[2]).alias("j"))
    )
    card = _array(
        cards,
        lambda c: F.struct(
            F.lit(c[0].label).alias("label"),
            _array(c[1], F.lit).alias("words"),
            _array(c[2], F.lit).alias("weight"),
            F.lit(sum(c[2])).alias("all"),
            _array(c[3], F.lit).alias("key"),
            F.lit(c[4]).alias("base"),
        ),
    )

    def candidates(w):
        """(template, start) of which an index word stands at its place."""
        n = F.size(w)
        at = F.filter(F.sequence(F.lit(0), n - 1), lambda i: F.array_contains(index, F.get(w, i)))
        nested = F.transform(
            at,
            lambda i: F.transform(
                F.filter(posting, lambda p: p["word"] == F.get(w, i)),
                lambda p: F.struct(p["t"].alias("t"), (i - p["j"]).alias("start")),
            ),
        )
        return F.array_distinct(F.flatten(nested))

    def judged(w, c):
        """A candidate with the share of weight at its place and whether the key phrase stands within."""
        t = F.get(card, c["t"])
        matched = F.aggregate(
            F.sequence(F.lit(0), F.size(t["words"]) - 1),
            F.lit(0.0),
            lambda acc, j: acc
            + F.when(_word(w, c["start"] + j) == F.get(t["words"], j), F.get(t["weight"], j)).otherwise(F.lit(0.0)),
        )
        k = F.size(t["key"])
        stands = F.exists(
            F.sequence(F.greatest(c["start"], F.lit(0)), F.greatest(c["start"], F.lit(0)) + F.size(t["words"]) - k),
            lambda s: F.slice(w, s + 1, k) == t["key"],
        )
        return F.struct(
            t["label"].alias("label"),
            c["start"].cast("long").alias("start"),
            t["base"].alias("base"),
            F.when(t["base"], F.lit(1.0)).otherwise(F.least(matched / t["all"], F.lit(1.0))).alias("share"),
            stands.alias("key"),
        )

    def found(w):
        some = F.filter(
            F.transform(candidates(w), lambda c: judged(w, c)),
            lambda p: p["key"] & (~p["base"] | (p["start"] >= 0)) & (p["share"] >= F.when(p["base"], F.lit(1.0)).otherwise(F.lit(SHARE))),
        )
        none = F.slice(some, 1, 0)
        places = F.when(F.arrays_overlap(w, index), some).otherwise(none)
        return F.struct(F.size(w).cast("long").alias("n_words"), places.alias("places"))

    out = own.select(*[f"_k{i}" for i in range(len(keep))], let(F.col("w"), found).alias("f"))
    share = F.coalesce(F.array_max("f.places.share"), F.lit(0.0))
    return out.select(
        *[F.col(f"_k{i}").alias(c) for i, c in enumerate(keep)],
        F.col("f.n_words").alias("n_words"),
        F.col("f.places").alias("places"),
        share.alias("share"),
    )


def _word(w: Column, i: Column) -> Column:
    return F.when(i >= 0, F.get(w, i))


def license_report(docs: DataFrame) -> DataFrame:
    """Counts, places and labels of every document; see ``op10_license_scan``."""
    out = scan_licenses(docs)
    base = F.filter("places", lambda p: p["base"])
    starts = F.transform(base, lambda p: p["start"])
    labels = lambda a: F.array_join(F.sort_array(F.array_distinct(F.transform(a, lambda p: p["label"]))), ",")
    return out.select(
        "doc_id",
        "n_words",
        F.size(base).cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"),
        labels(base).alias("base_labels"),
        labels(F.col("places")).alias("labels"),
        F.round("share", 6).alias("score"),
    )
