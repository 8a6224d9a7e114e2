"""Language of a text: known words first, shorter and shorter character n-grams for unseen ones.

A word that the training texts have scores by its log frequency in each language.  An unseen word is looked
at through its character n-grams: each place of the word takes the longest n-gram there that is known, from
``LONGEST`` characters down to one.  The sums over all words of a text give a probability for each language.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventlink.llm.common import crc_mod, map_texts, raw, tokens

#: At most about so many texts of a language are learnt from: those with the smallest hash of their id.
SAMPLE = 1_000
LONGEST = 4
#: A word or n-gram is known from so many occurrences in the sample on.
LEAST = 2
SMOOTH = 0.5
UNKNOWN = "und"
_LETTER = re.compile(r"[^\W\d_]")
GRAMS = T.StructType(
    [
        T.StructField("lang", T.StringType()),
        T.StructField("size", T.IntegerType()),
        T.StructField("gram", T.LongType()),
        T.StructField("n", T.LongType()),
    ]
)


@dataclass
class Languages:
    """``grams[k]``: sorted hashes and log frequencies by language of k-grams; k = 0: of whole words."""

    names: list[str]
    prior: np.ndarray
    grams: list[tuple[np.ndarray, np.ndarray]]

    def look(self, k: int, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which hashes are known, and their rows (of the known ones)."""
        keys, rows = self.grams[k]
        if not len(keys):
            return np.zeros(len(hashes), bool), rows
        at = np.minimum(np.searchsorted(keys, hashes), len(keys) - 1)
        known = keys[at] == hashes
        return known, rows[at[known]]


def word_grams(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray):
    """Character n-grams of words, each word with a space before and after it.

    Returns the word of each place and, for n = 1..LONGEST, the n-grams' hashes and whether there is one.
    """
    listed = [buf[a:b].tobytes() for a, b in zip(starts.tolist(), ends.tolist())]
    text = (b" " + b" ".join(listed) + b" ").decode().lower()
    chars = np.frombuffer(text.encode("utf-32-le"), np.uint32).astype(np.uint64)
    space = chars == 32
    gaps = np.flatnonzero(space)
    owner = np.cumsum(space)[:-1] - 1 if listed else np.empty(0, int)
    chars, space = (chars, space) if listed else (chars[:0], space[:1])
    end = gaps[owner + 1] if listed else np.empty(0, int)
    place = np.arange(len(owner))
    rows, h = [], np.zeros(len(chars), np.uint64)
    for n in range(1, LONGEST + 1):
        h = h[: max(len(chars) - n + 1, 0)] * np.uint64(0x100000001B3) + chars[n - 1 :] + np.uint64(1)
        here = np.zeros(len(owner), np.uint64)
        m = min(len(owner), len(h))
        here[:m] = h[:m]
        rows.append((here, (place + n - 1 <= end) & (~space[:-1] if n == 1 else True)))
    return owner, rows


def _distinct(part: pa.Array):
    """Bytes, documents of the words, which distinct word each is, and the distinct words' places and hashes."""
    buf, offsets = raw(part)
    starts, ends, hashes, doc = tokens(buf, offsets)
    own, first, which = np.unique(hashes, return_index=True, return_inverse=True)
    return buf, doc, which, starts[first], ends[first], own


def word_scores(model: Languages, buf, starts, ends, hashes) -> np.ndarray:
    """Log frequencies by language of each of some distinct words."""
    out = np.zeros((len(hashes), len(model.names)))
    known, rows = model.look(0, hashes)
    out[known] = rows
    unseen = np.flatnonzero(~known)
    if not len(unseen):
        return out
    owner, grams = word_grams(buf, starts[unseen], ends[unseen])
    open_ = np.ones(len(owner), bool)  # places of the unseen words that no n-gram has explained yet
    own = np.zeros((len(unseen), len(model.names)))
    for n in range(LONGEST, 0, -1):
        h, there = grams[n - 1]
        place = np.flatnonzero(there & open_)
        hit, rows = model.look(n, h[place])
        place = place[hit]
        open_[place] = False
        for k in range(len(model.names)):
            own[:, k] += np.bincount(owner[place], rows[:, k], len(unseen))
    used = np.bincount(owner[~open_], minlength=len(unseen))
    out[unseen] = own / np.maximum(used, 1)[:, None]  # a word weighs as much as its mean n-gram
    return out


def _count(part: pa.Array, langs: pa.Array) -> pa.RecordBatch:
    """Occurrences of words (size 0) and n-grams by language."""
    buf, doc, which, starts, ends, own = _distinct(part)
    names = langs.to_pylist()
    lang_of = {name: i for i, name in enumerate(sorted(set(names)))}
    lang = np.array([lang_of[n] for n in names], int)
    table = np.zeros((len(own), len(lang_of)), np.int64)
    np.add.at(table, (which, lang[doc]), 1)
    owner, grams = word_grams(buf, starts, ends)
    cols: dict[str, list] = {"lang": [], "size": [], "gram": [], "n": []}
    for name, k in lang_of.items():
        weight = table[:, k]
        some = np.flatnonzero(weight)
        sets = [(0, own[some], weight[some])]
        for n, (h, there) in enumerate(grams, 1):
            at = np.flatnonzero(there & (weight[owner] > 0))
            u, inverse = np.unique(h[at], return_inverse=True)
            sets.append((n, u, np.bincount(inverse, weight[owner[at]], len(u)).astype(np.int64)))
        for n, h, w in sets:
            cols["lang"] += [name] * len(h)
            cols["size"].append(np.full(len(h), n, np.int32))
            cols["gram"].append(h.view(np.int64))
            cols["n"].append(w)
    arrays = [
        pa.array(cols["lang"], pa.string()),
        *[
            pa.array(np.concatenate(cols[c]) if cols[c] else np.empty(0), kind)
            for c, kind in (("size", pa.int32()), ("gram", pa.int64()), ("n", pa.int64()))
        ],
    ]
    return pa.RecordBatch.from_arrays(arrays, names=GRAMS.names)


def train(docs: DataFrame, sample: int = SAMPLE) -> Languages:
    """Learn from rows with a text and a lang whose id's crc32 modulo 4 is not 2.

    Of each language about ``sample`` texts are used, whole, chosen by a hash of the id.  What is collected
    is bounded by that sample.
    """
    own = docs.select("doc_id", "text", "lang").where(F.col("text").isNotNull() & F.col("lang").isNotNull())
    own = own.where(crc_mod(F.col("doc_id"), 4) != 2)
    sizes = {r["lang"]: r["n"] for r in own.groupBy("lang").agg(F.count("*").alias("n")).toLocalIterator()}
    names = sorted(sizes)
    total = sum(sizes.values())
    prior = np.log(np.array([sizes[n] / total for n in names]))
    span, chosen = 2**31, F.lit(False)
    for name in names:
        most = int(span * min(1, sample / sizes[name]))
        chosen = chosen | ((F.col("lang") == name) & (F.pmod(F.xxhash64("doc_id"), F.lit(span)) < most))

    def count(batches):
        for batch in batches:
            texts = batch.column(0).cast(pa.large_string())
            for i in range(0, len(texts), 200):
                yield _count(texts.slice(i, 200), batch.column(1).slice(i, 200))

    counts = own.where(chosen).select("text", "lang").mapInArrow(count, GRAMS)
    counts = counts.groupBy("lang", "size", "gram").agg(F.sum("n").alias("n")).where(F.col("n") >= LEAST)
    found = counts.toPandas()
    grams = []
    for size in range(LONGEST + 1):
        part = found[found["size"] == size]
        keys, at = np.unique(part["gram"].to_numpy(np.int64).view(np.uint64), return_inverse=True)
        table = np.zeros((len(keys), len(names)))
        column = part["lang"].map({n: i for i, n in enumerate(names)}).to_numpy(int)
        table[at, column] = part["n"].to_numpy(float)
        freq = (table + SMOOTH) / (table.sum(axis=0) + SMOOTH * (len(keys) + 1))
        grams.append((keys, np.log(freq)))
    return Languages(names, prior, grams)


def predict_language(
    docs: DataFrame, model: Languages, text: str = "text", keep: list[str] | None = None
) -> DataFrame:
    """``docs`` with ``lang_pred`` and its probability ``score``, from whole texts.

    A text that is null, empty or without a letter is ``und`` with score 0, as is every text if nothing
    was learnt.  Equal sums go to the first name; repeated rows stay.
    """
    keep = [c for c in (docs.columns if keep is None else keep) if c not in ("lang_pred", "score")]

    def make():
        def work(part: pa.Array) -> list[pa.Array]:
            lettered = np.array([bool(_LETTER.search(t)) for t in part.to_pylist()], bool)
            if not model.names:
                return [pa.array([UNKNOWN] * len(part)), pa.array(np.zeros(len(part)))]
            buf, doc, which, starts, ends, own = _distinct(part)
            table = word_scores(model, buf, starts, ends, own)
            total = np.tile(model.prior, (len(part), 1))
            for k in range(len(model.names)):
                total[:, k] += np.bincount(doc, table[which, k], len(part))
            best = total.argmax(axis=1)
            odds = np.exp(np.maximum(total - total.max(axis=1, keepdims=True), -700))
            score = np.where(lettered, 1 / odds.sum(axis=1), 0.0)
            pred = [model.names[b] if ok else UNKNOWN for b, ok in zip(best.tolist(), lettered.tolist())]
            return [pa.array(pred, pa.string()), pa.array(score, pa.float64())]

        return work

    fields = [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())]
    return map_texts(docs, text, keep, fields, make)


def language_report(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every row of ``docs``."""
    out = predict_language(docs.select("doc_id", "text"), train(docs), keep=["doc_id"])
    return out.select("doc_id", (crc_mod(F.col("doc_id"), 4) == 2).alias("held_out"), "lang_pred", "score")
