"""Phrases whose words belong together, language by language, counted exactly by Toivonen's method.

A sample of the documents proposes: the runs of words that are frequent there, under a lowered limit, are the
proposal.  A run whose two parts, without its first and without its last word, are proposed but which is not proposed
itself is on the negative border.  A pass over all documents counts proposal and border.  A border run that
turns out frequent is a failure of the border: runs that it is a part of were not counted.  Every frequent run that was
not counted holds such a run, at the latest in the shortest of its parts that was not proposed.  So an expansion pass
counts all runs, of any length, that hold a failed one, and with it the frequent runs are closed.

The proposal and the failures reach the tasks as tables of bits of a bounded size.  A crowded table lets more runs be
counted than necessary, never fewer, and no run is counted by both passes.  These passes count hashes; a last one
counts the words themselves of the runs that are left, so the result is exact.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from eventlink.llm.common import TO_LOWER, crc_mod, mix, pieces, raw, saved, texts_of, tokens

LONGEST, LEAST, MOST = 4, 30, 2_000
#: One document of so many is in the sample.
SHARE = 4
#: A longer phrase with so many per cent of a shorter one's occurrences stands for it.
COVER = 80
SCALE = 2_000_000
UNKNOWN = "und"
#: A bit table has so many bits for each run it holds, or up to twice as many, within these bounds (16 MB at most).
BITS_EACH, LEAST_BITS, MOST_BITS = 8, 12, 27
#: Bytes of text that one pass of numpy works on, hashes that a task sums up before it hands them on, and counted phrases:
#: small enough that a task's own arrays stay within some 100 MB.
PIECE, AT_ONCE, PHRASES = 1 << 19, 1 << 20, 1 << 18
#: Parts that a language's phrases are ranked in before the whole.
PARTS = 64
_BREAK = np.isin(np.arange(256), [*b".,;:!?", *range(0x0A, 0x0E)])
_WORD = ~_BREAK & ~np.isin(np.arange(256), [0x20, 0x09])
_ODD = np.uint64(0x9E3779B97F4A7C15)
#: The bits of a hash that tell its run's length.
_TAG = np.uint64(3)


class Sieve:
    """A test whether runs, given by their hashes, may be in a set."""

    def __init__(self, table: np.ndarray):
        self.table, self.mask = table, np.uint64(len(table) * 64 - 1)

    def __call__(self, h: np.ndarray) -> np.ndarray:
        at = h & self.mask
        return (self.table[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63)) & np.uint64(1)).astype(bool)


def sieve_of(runs: DataFrame) -> Sieve:
    """The bits of the hashes ``h`` of a written table; the driver gets one row for each used word of 64 bits."""
    bits = max(LEAST_BITS, min(MOST_BITS, (BITS_EACH * max(runs.count(), 1) - 1).bit_length()))
    place = F.pmod("h", F.lit(1 << bits))
    words = runs.select(F.shiftright(place, 6).alias("k"), F.pmod(place, F.lit(64)).cast("int").alias("b"))
    got = words.groupBy("k").agg(F.expr("bit_or(shiftleft(1L, b))").alias("v")).toArrow()
    table = np.zeros(1 << bits - 6, np.uint64)
    table[got["k"].to_numpy()] = got["v"].to_numpy().view(np.uint64)
    return Sieve(table)


class Runs:
    """The runs of some texts of one language: for each length the hashes of those that lie within a piece.

    A hash tells language and length, too.  It is only used to rule runs out.
    """

    def __init__(self, part: pa.Array, seed: np.uint64):
        self.buf, offsets = raw(part)
        self.starts, self.ends, h, doc = tokens(self.buf, offsets, _WORD)
        self.n, self.one = len(self.starts), mix(h + seed)
        broken = np.cumsum(_BREAK[self.buf])
        self.same = (doc[1:] == doc[:-1]) & (broken[self.starts[1:]] == broken[self.ends[:-1] - 1])

    def of_lengths(self, longest: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(k, hash by first word, whether the words from there on are a run) for k = 1, 2, …"""
        run, last = np.ones(self.n, bool), self.one
        yield 1, _tagged(last, 1), run
        for k in range(2, min(longest, self.n) + 1):
            m = self.n - k + 1
            run, last = run[:m] & self.same[k - 2 :], mix(last[:m] * _ODD + self.one[k - 1 :])
            yield k, _tagged(last, k), run

    def hashes(self, lengths, parts: Sieve | None, missed: Sieve | None = None) -> np.ndarray:
        """Hashes of the occurrences of the runs of ``lengths`` whose two parts are both in ``parts`` (None: of all).

        With ``missed`` it is the others, of which some part is in ``missed``.
        """
        out, before, holds = [np.empty(0, np.uint64)], None, None
        for k, h, run in self.of_lengths(max(lengths)):
            if missed is not None:  # whether the run from a word on holds a missed run
                inner = np.zeros(len(h), bool) if k == 1 else holds[:-1] | holds[1:]
                holds = inner | missed(h)
            if k in lengths:
                found = np.flatnonzero(run if missed is None else run & inner)
                if k > 1 and parts is not None:
                    both = parts(before[found]) & parts(before[found + 1])
                    found = found[both if missed is None else ~both]
                out.append(h[found])
            before = h
        return np.concatenate(out)

    def exact(self, longest: int, wanted: Sieve) -> Iterator[tuple[int, pa.Array, np.ndarray]]:
        """(k, runs, counts) of the runs whose hashes are ``wanted``, counted by their words' content."""
        size = self.ends - self.starts
        own = TO_LOWER[self.buf[_WORD[self.buf]]]
        at = np.concatenate([[0], np.cumsum(size)]).astype(np.int64)
        words = pa.Array.from_buffers(pa.large_string(), self.n, [None, pa.py_buffer(at), pa.py_buffer(own)])
        ids, names = None, None
        for k, h, run in self.of_lengths(longest):
            found = np.flatnonzero(run)
            found = found[wanted(h[found])]
            if not len(found):
                continue
            if ids is None:
                words = words.dictionary_encode()
                ids, names = words.indices.to_numpy().astype(np.int64), words.dictionary
            key = ids[found]
            for j in range(1, k):
                if j > 1:  # smaller numbers for the runs so far, so that the next word fits beside them
                    key = np.unique(key, return_inverse=True)[1].reshape(-1)
                key = key * len(names) + ids[found + j]
            _, first, count = np.unique(key, return_index=True, return_counts=True)
            parts = [names.take(pa.array(ids[found[first] + j])) for j in range(k)]
            yield k, parts[0] if k == 1 else pc.binary_join_element_wise(*parts, pa.scalar(" ", pa.large_string())), count


def _tagged(h: np.ndarray, k: int) -> np.ndarray:
    """The hash with the length less 1 in its lowest bits."""
    return h & ~_TAG | np.uint64(k - 1)


def _length(h: str = "h"):
    return F.col(h).bitwiseAND(F.lit(int(_TAG))) + 1


def _seed(lang: str) -> np.uint64:
    return mix(np.array([zlib.crc32(lang.encode()) + 1], np.uint64))[0]


def _by_language(batches) -> Iterator[tuple[str, Runs]]:
    for batch in batches:
        texts, langs = texts_of(batch.column(0)), batch.column(1)
        for lang in pc.unique(langs).to_pylist():
            for part in pieces(texts.filter(pc.equal(langs, lang)), PIECE):
                runs = Runs(part, _seed(lang))
                if runs.n:
                    yield lang, runs


def hash_counts(docs: DataFrame, lengths, least: int, parts: Sieve | None, missed: Sieve | None = None) -> DataFrame:
    """h and n of the hashes of :meth:`Runs.hashes` that come up ``least`` times in all of ``docs`` (text, lang).

    Two runs of one hash count together, so no frequent run is missed.
    """

    def summed(held):
        h, n = np.unique(np.concatenate(held), return_counts=True)
        return pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(n)], names=["h", "n"])

    def run(batches):
        held, size = [], 0
        for _, runs in _by_language(batches):
            held.append(runs.hashes(lengths, parts, missed))
            size += len(held[-1])
            if size > AT_ONCE:
                yield summed(held)
                held, size = [], 0
        if size:
            yield summed(held)

    rows = docs.select("text", "lang").mapInArrow(run, "h long, n long")
    # dealt out first: hardly any of a task's hashes come up in it again, so summing them there would only cost memory
    return rows.repartition("h").groupBy("h").agg(F.sum("n").alias("n")).where(F.col("n") >= least)


def exact_counts(docs: DataFrame, longest: int, wanted: Sieve) -> DataFrame:
    """lang, k, phrase, n of the runs whose hashes are wanted, by their words; k = 0: all words of the language."""
    names = ["lang", "k", "phrase", "n"]

    def summed(held):
        out = pa.concat_tables(held).group_by(names[:3]).aggregate([("n", "sum")])
        return out.rename_columns(names).combine_chunks().to_batches()

    def run(batches):
        held, size = [], 0
        for lang, runs in _by_language(batches):
            total = (0, pa.array([""], pa.large_string()), np.array([runs.n]))
            for k, phrase, n in (total, *runs.exact(longest, wanted)):
                cols = [pa.array([lang] * len(n)), pa.array(np.full(len(n), k, np.int32)), phrase.cast(pa.string()), pa.array(n)]
                held.append(pa.table(cols, names=names))
                size += len(n)
            if size > PHRASES:
                yield from summed(held)
                held, size = [], 0
        if held:
            yield from summed(held)

    rows = docs.select("text", "lang").mapInArrow(run, "lang string, k int, phrase string, n long")
    return rows.groupBy("lang", "k", "phrase").agg(F.sum("n").alias("n"))


def lowered(least: int, share: int) -> int:
    """The limit in a sample of one in ``share``: one and a half deviations below what is expected there."""
    mean = least / share
    return max(2, math.floor(mean - 1.5 * math.sqrt(mean)))


def propose(docs: DataFrame, least: int, longest: int) -> DataFrame:
    """Hashes of the runs, shorter than ``longest``, that come up ``least`` times in the sample ``docs``."""
    out = saved(hash_counts(docs, range(1, min(3, longest)), least, None), "proposed")
    for k in range(3, longest):
        out = out.unionByName(saved(hash_counts(docs, [k], least, sieve_of(out.where(_length() == k - 1))), "proposed"))
    return out


def frequent_runs(
    docs: DataFrame,
    text: str = "text",
    lang: str = "lang",
    key: str = "doc_id",
    least: int = LEAST,
    longest: int = LONGEST,
    share: int = SHARE,
) -> tuple[DataFrame, DataFrame, int]:
    """(lang, k, phrase, n of every run of up to ``longest`` words that occurs ``least`` times in its language;
    lang, n of all words; how many passes it took until all were counted).  ``longest`` is 2, 3 or 4.

    These passes count 64-bit hashes, which leaves little to shuffle; another one counts the words themselves of the
    runs whose hashes are frequent enough.
    """
    own = docs.select(
        F.col(text).alias("text"), F.coalesce(F.col(lang).cast("string"), F.lit(UNKNOWN)).alias("lang"), F.col(key).alias("key")
    )
    known = propose(own.where(crc_mod(F.col("key"), share) == 0), lowered(least, share), longest)
    parts = sieve_of(known)
    found = saved(hash_counts(own, range(1, longest + 1), least, parts), "counted")
    # what is frequent, may be a part of more, and was not known to be while its wholes were counted
    missed = saved(found.where(_length() < longest).join(known, "h", "left_anti"), "missed")
    failed = missed.limit(1).count() > 0
    if failed:
        found = found.unionByName(saved(hash_counts(own, range(2, longest + 1), least, parts, sieve_of(missed)), "counted"))
    runs = exact_counts(own, longest, sieve_of(found)).where((F.col("n") >= least) | (F.col("k") == 0))
    runs = saved(runs, "runs")
    return runs.where("k > 0"), runs.where("k = 0").select("lang", "n"), 1 + failed


def collocations(
    docs: DataFrame,
    text: str = "text",
    lang: str = "lang",
    key: str = "doc_id",
    least: int = LEAST,
    longest: int = LONGEST,
    most: int = MOST,
    cover: int = COVER,
    share: int = SHARE,
) -> DataFrame:
    """Each language's ``most`` best phrases of 2 to ``longest`` (4 at most) words: lang, rank, phrase, a, l, r, n, score.

    Words end at space and tab, pieces at ``. , ; : ! ?`` and line ends; a phrase lies within a piece and occurs ``least``
    times or more (a), overlaps counted.  Its score is that of its weakest cut into a first part (l) and a rest (r):
    2,000,000 a / (l + r), rounded down, the shortest first part among equals.  A phrase inside a longer one with ``cover``
    per cent of its occurrences is left out.  Ties in rank: more occurrences, then byte order.  A null language is
    ``und`` and one with documents of that name.  Null and empty texts and texts of separators alone have no words.
    Repeated rows count again each.  ``key`` only draws the sample, on which the result does not depend.
    """
    runs, words, _ = frequent_runs(docs, text, lang, key, least, longest, share)
    runs = runs.select("lang", "k", "phrase", F.col("n").alias("a"))
    cand = runs.where("k > 1").withColumn("w", F.split("phrase", " "))
    part = lambda i, n: F.array_join(F.slice("w", i, n), " ")
    cuts = cand.select("lang", "phrase", "a", "k", "w", F.explode(F.sequence(F.lit(1), F.col("k") - 1)).alias("cut"))
    cuts = cuts.select("lang", "phrase", "a", "cut", part(F.lit(1), F.col("cut")).alias("first"),
                       part(F.col("cut") + 1, F.col("k") - F.col("cut")).alias("rest"))
    side = lambda name, n: runs.select("lang", F.col("phrase").alias(name), F.col("a").alias(n))
    cuts = cuts.join(side("first", "l"), ["lang", "first"]).join(side("rest", "r"), ["lang", "rest"])
    score = F.expr(f"cast({SCALE} as decimal(10,0)) * cast(a as decimal(20,0)) div cast(l + r as decimal(20,0))")
    weakest = F.min(F.struct(score.alias("score"), "cut", "l", "r")).alias("s")
    scored = cuts.groupBy("lang", "phrase", "a").agg(weakest).select("lang", "phrase", "a", "s.score", "s.l", "s.r")
    # parts of two words or more of every longer candidate, with the most occurrences of one
    inner = cand.where("k > 2").select("lang", "a", "w", "k", F.explode(F.sequence(F.lit(2), F.col("k") - 1)).alias("m"))
    inner = inner.select("lang", "a", "w", "m", F.explode(F.sequence(F.lit(1), F.col("k") - F.col("m") + 1)).alias("i"))
    inner = inner.groupBy("lang", part(F.col("i"), F.col("m")).alias("phrase")).agg(F.max("a").alias("longer"))
    wide = lambda c: F.col(c).cast("decimal(20,0)")
    covered = F.coalesce(wide("longer") * 100 >= wide("a") * cover, F.lit(False))
    scored = scored.join(inner, ["lang", "phrase"], "left").where(~covered).drop("longer")
    best = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    salt = F.pmod(F.xxhash64("phrase"), F.lit(PARTS))
    for by in (["lang", "_salt"], ["lang"]):
        ranks = F.row_number().over(W.partitionBy(*by).orderBy(*best))
        scored = scored.withColumn("_salt", salt).withColumn("rank", ranks).where(F.col("rank") <= most)
    out = scored.join(words, "lang")
    longs = [F.col(c).cast("long").alias(c) for c in ("a", "l", "r", "n", "score")]
    return out.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", *longs)


#: The same in SQL: all runs counted, then cut, covered and ranked.
ORACLE = r"""
with pieces as (select coalesce(lang, 'und') lang, unnest(regexp_split_to_array(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) p
    from documents),
lists as (select lang, list_filter(regexp_split_to_array(p, '[\x20\x09]+'), lambda w: w <> '') w from pieces),
occurrences as (select lang, k, unnest(list_transform(range(1, greatest(len(w) - k + 2, 1)),
        lambda i: array_to_string(w[i : i + k - 1], ' '))) phrase from lists, (select unnest(range(1, 5)) k)),
counts as (select lang, k, phrase, count(*) a from occurrences group by all),
words as (select lang, sum(a)::bigint n from counts where k = 1 group by lang),
runs as (select * from counts where a >= 30),
cand as (select *, string_split(phrase, ' ') w from runs where k > 1),
cuts as (select c.lang, c.phrase, c.a, cut, l.a l, r.a r, (2000000::hugeint * c.a // (l.a + r.a))::bigint score
    from (select *, unnest(range(1, k)) cut from cand) c
    join runs l on l.lang = c.lang and l.phrase = array_to_string(w[1 : cut], ' ')
    join runs r on r.lang = c.lang and r.phrase = array_to_string(w[cut + 1 :], ' ')),
scored as (select * from (select *, row_number() over (partition by lang, phrase order by score, cut) rn from cuts) where rn = 1),
inside as (select lang, a, unnest(list_concat(list_transform(range(1, k), lambda i: array_to_string(w[i : i + 1], ' ')),
        case when k = 4 then list_transform(range(1, 3), lambda i: array_to_string(w[i : i + 2], ' ')) else [] end)) phrase
    from cand where k > 2),
longer as (select lang, phrase, max(a) m from inside group by all),
kept as (select s.* from scored s left join longer using (lang, phrase)
    where m is null or 100 * m::hugeint < 80 * a::hugeint),
ranked as (select *, row_number() over (partition by lang order by score desc, a desc, phrase) "rank" from kept)
select lang, "rank", phrase, a, l, r, n, score from ranked join words using (lang) where "rank" <= 2000"""
