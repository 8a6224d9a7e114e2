"""WARC archives, collocations and resampling against plain Python, and on awkward rows."""

import gzip
import zlib

import llm_models as M
import numpy as np
import pytest
from pyspark.sql import functions as F

from eventlink.llm import collocations, resample, warc

EXTRA = ["key", "_t", "text_", "_doc", "rank", "score", "weight", "_key", "_row", "n", "_sha", "_first", "k", "h", "phrase"]


def with_extra(df):
    return df.withColumns({c: F.lit("?") for c in EXTRA}).repartition(3)


# --- 11 WARC -------------------------------------------------------------------------------------------------

PAGES = [
    (1, "http://a.example/1", "<p>one</p>"),
    (2, "http://a.example/2", "<p>one</p>"),
    (3, "http://a.example/ä b\r\nX: y", None),
    (4, None, ""),
    (5, "http://a.example/5", "<p>\U0001f600 \r\n\r\nWARC/1.1\r\nWARC-Type: response\r\n\r\n</p>"),
    (6, "http://a.example/6", "x" * 100_000),
    (7, "http://a.example/7", "x" * 100_000),
    (7, "http://a.example/7", "x" * 100_000),
    (None, "http://a.example/8", "<p>one</p>"),
    (0, "http://a.example/9", "\x00\x1f\x00"),
    (9, "", "<p>nobody else</p>"),
    (9, "", "<p>nobody else</p>"),
]


@pytest.fixture(scope="module")
def pages(spark):
    return with_extra(spark.createDataFrame(PAGES, "page_id long, url string, html string"))


def expected(least=0):
    out = []
    for i, _, html in PAGES:
        body = (html or "").encode()
        same = [k for k, _, h in PAGES if (h or "").encode() == body and k is not None]
        again = len(body) >= least and same and i != min(same)
        own = (i, len(body), warc.digest(body), "revisit" if again else "response", min(same) if again else None)
        out.append(own)
    return sorted(out, key=str)


@pytest.mark.parametrize("compress", [True, False])
@pytest.mark.parametrize("least,groups", [(0, 10), (0, 0), (11, 10)])
def test_warc_round_trip(spark, pages, tmp_path, monkeypatch, compress, least, groups):
    """Written and read back, with the payloads' groups broadcast and shuffled, and several files."""
    monkeypatch.setattr(warc, "BROADCAST_GROUPS", groups)
    monkeypatch.setattr(warc, "FILE_BYTES", 50_000)
    path = str(tmp_path / "out")
    warc.write_warc(pages, path, least=least, compress=compress)
    rows = warc.read_warc(spark, path).cache()
    assert warc.gaps(rows).count() == 0
    got = warc.page_report(rows)
    assert got.columns == ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    assert sorted(map(tuple, got.collect()), key=str) == expected(least)
    whole = warc.with_revisited(rows).select("record_id", "payload").collect()
    want = {f"urn:page:{'' if i is None else i}": (h or "").encode() for i, _, h in PAGES}
    assert len(whole) == len(PAGES) and all(bytes(r.payload) == want[r.record_id] for r in whole)
    files = [f.read_bytes() for f in (tmp_path / "out").iterdir() if f.name.startswith("part")]
    assert len(files) > 1
    plain = b"".join(gzip.decompress(f) if compress else f for f in files)
    assert plain.count(b"WARC/1.1\r\nWARC-Type: ") == len(PAGES) + 1  # one is in a payload


def test_warc_of_nothing(spark, pages, tmp_path):
    warc.write_warc(pages.limit(0), str(tmp_path / "out"))
    rows = warc.read_warc(spark, str(tmp_path / "out"))
    assert rows.count() == 0 and warc.gaps(rows).count() == 0 and warc.with_revisited(rows).count() == 0


def records(n=20):
    return [warc.record("response", f"urn:page:{i}", f"http://x/{i}", (f"<p>{i} WARC/1.1\r\n hi</p>" * 30).encode()) for i in range(n)]


def ids(found):
    return [f.fields["warc-record-id"][10:-1] for f in found if f.reason is None]


@pytest.mark.parametrize("pack", [warc.member, bytes])
def test_salvage(pack):
    parts = [pack(r) for r in records()]
    whole = b"".join(parts)
    every = [str(i) for i in range(20)]
    at = [sum(map(len, parts[:i])) for i in range(21)]
    assert ids(warc.salvage(whole)) == every
    assert ids(warc.salvage(b"\r\n".join(parts) + b"\0\0")) == every
    hurt = bytearray(whole)
    hurt[at[6] - 40] ^= 0xFF
    for data, lost in [
        (bytes(hurt), {5}),  # a byte changed
        (whole[: at[4]] + b"noise \x1f\x8b\x08 WARC/1.1\r\n noise" + whole[at[4] :], set()),
        (whole[: at[7] - 25] + whole[at[7] :], {6}),  # the end of a record lost
        (whole[at[1] // 2 :], {0}),  # the start of the file lost
        (whole[: at[20] - 25], {19}),  # the end of the file lost
        (whole[: at[3]] + whole[at[3] + 5 :], {3}),  # a record's start lost
    ]:
        found = list(warc.salvage(data))
        assert ids(found) == [i for i in every if int(i) not in lost]
        quarantined = [f for f in found if f.reason is not None]
        assert len(quarantined) == 1 and quarantined[0].length > 0
        # records and gaps together are the whole file, but for end marks
        covered = np.zeros(len(data), bool)
        for f in found:
            if f.reason is None and pack is warc.member:
                end = warc.inflate(data, f.offset)[1]
            else:
                end = f.offset + f.length + (0 if f.reason else 4)
            assert not covered[f.offset : end].any()
            covered[f.offset : end] = True
        assert set(np.frombuffer(data, np.uint8)[~covered].tolist()) <= {0, 10, 13}


def test_salvage_of_foreign_archives():
    rs = records()
    one = gzip.compress(b"".join(rs))
    assert ids(warc.salvage(one)) == [str(i) for i in range(20)]
    cut = list(warc.salvage(one[: len(one) * 2 // 3]))  # records before the damage, vouched for by their digests
    assert 0 < len(ids(cut)) < 20 and cut[-1].reason == "gzip member: cut short"
    no_digest = b"WARC/1.0\nWARC-Type: resource\nWARC-Record-ID: <urn:page:1>\nContent-Length: 5\n\nhello\r\n\r\n"
    assert [bytes(f.payload) for f in warc.salvage(no_digest * 2)] == [b"hello"] * 2
    assert [f.reason for f in warc.salvage(no_digest[:-4])] == ["no end mark"]
    wrong = rs[0].replace(b"Content-Length: ", b"Content-Length: 9", 2)
    assert ids(warc.salvage(wrong + rs[1])) == ["1"]
    long = b"WARC/1.1\r\n" + b"a: b\r\n" * 200_000
    assert [f.reason for f in warc.salvage(long)] == ["no end of the header"]
    assert list(warc.salvage(b"")) == [] and list(warc.salvage(b"\r\n\0")) == []
    md5 = no_digest.replace(b"Content-L", b"WARC-Block-Digest: md5:5d41402abc4b2a76b9719d911017c592\nContent-L")
    assert ids(warc.salvage(md5)) == ["1"] and ids(warc.salvage(md5.replace(b"hello", b"hallo"))) == []


def test_member_ends_with_zero():
    """Also where the length's last byte isn't zero."""
    long = bytes(16 << 20) + b"x"
    data = warc.member(long)
    assert data.endswith(b"\0") and gzip.decompress(data) == long


def test_damaged_files_are_logged(spark, tmp_path):
    parts = [warc.member(r) for r in records(3)]
    (tmp_path / "a.warc.gz").write_bytes(parts[0] + b"junk" + parts[1])
    (tmp_path / "b.warc").write_bytes(records(3)[2])
    (tmp_path / "c.warc").write_bytes(b"")
    rows = warc.read_warc(spark, str(tmp_path))
    assert sorted(r.record_id for r in rows.where("kind = 'record'").collect()) == [f"urn:page:{i}" for i in range(3)]
    (gap,) = warc.gaps(rows).collect()
    assert (gap.file.endswith("a.warc.gz"), gap.offset, gap.length) == (True, len(parts[0]), 4)


# --- 12 collocations -----------------------------------------------------------------------------------------


def prose(n=120, seed=3):
    """Texts of few words, so that phrases of every length repeat, with copies."""
    r = np.random.default_rng(seed)
    vocabulary = ["Alpha", "beta", "gämma", "delta", "Epsilon", "zeta", "e\x00ta", "theta-x", "日本", "kappa"]
    fixed = ["new york city hall", "per cent", "in front of the", "Alpha beta Alpha beta"]
    out = []
    for i in range(n):
        w = []
        for _ in range(int(r.integers(0, 40))):
            w.append(str(r.choice(fixed)) if r.random() < 0.2 else str(r.choice(vocabulary)))
            w.append(str(r.choice(["", "", "", ".", ",", "\n", "\t", "  ", ";!", "\x0b"])))
        out.append((i, " ".join(w), ["en", "en", None, "und", "de"][i % 5]))
    return out + out[:9] + [(900, None, "en"), (901, "", "fr"), (902, " .,\t\n", "fr"), (None, "x y " * 300, "xx"), (904, "One", "")]


def got_collocations(df, **how):
    out = {}
    for r in sorted(collocations.collocations(df, **how).collect(), key=lambda r: (r.lang, r["rank"])):
        out.setdefault(r.lang, []).append((r.phrase, r.a, r.l, r.r, r.n, r.score))
        assert r["rank"] == len(out[r.lang])
    return out


@pytest.mark.parametrize("least,most,share", [(3, 2000, 4), (30, 2000, 2), (2, 7, 1)])
def test_collocations(spark, least, most, share):
    docs = prose()
    df = with_extra(spark.createDataFrame(docs, "doc_id long, text string, lang string"))
    want = M.collocations([d[1:] for d in docs], least, most=most)
    assert want and got_collocations(df, least=least, most=most, share=share) == want


def test_collocations_need_expansion_passes(spark, monkeypatch):
    """A sample that proposes nothing leaves everything to the passes after it; crowded tables change nothing."""
    docs = [(i, t, lang) for i, t, lang in prose(60) if zlib.crc32(str(i or "").encode()) % 1000 != 0]
    df = spark.createDataFrame(docs, "doc_id long, text string, lang string")
    want = M.collocations([d[1:] for d in docs], 4)
    runs, words, passes = collocations.frequent_runs(df, least=4, share=1000)
    assert passes == 2 and runs.groupBy("lang", "phrase").count().where("count > 1").count() == 0
    assert got_collocations(df, least=4, share=1000) == want
    assert collocations.frequent_runs(df, least=4, share=1)[2] == 1
    monkeypatch.setattr(collocations, "MOST_BITS", 6)
    monkeypatch.setattr(collocations, "LEAST_BITS", 6)
    assert got_collocations(df, least=4, share=2) == want


def test_collocations_of_nothing(spark):
    df = spark.createDataFrame(prose(3), "doc_id long, text string, lang string")
    assert collocations.collocations(df.limit(0)).count() == 0
    assert collocations.collocations(df.where("text is null or text = ''")).count() == 0


def test_scores_beyond_64_bits(spark):
    """2,000,000 a passes 64 bits; the quotient does not."""
    a = 9_000_000_000_000_000
    q = f"cast({collocations.SCALE} as decimal(10,0)) * cast({a}L as decimal(20,0)) div cast({a}L + {a + 7}L as decimal(20,0))"
    assert spark.sql(f"select {q} x").head()[0] == 2_000_000 * a // (2 * a + 7)


# --- 13 resampling -------------------------------------------------------------------------------------------

WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi".split()


def corpus(n=200, seed=5):
    r = np.random.default_rng(seed)
    docs = [(i, " ".join(r.choice(WORDS, int(r.integers(0, 60))))) for i in range(n)]
    docs += docs[:40]  # the same rows again
    docs += [(500, t) for _, t in docs[:60]]  # one id on a fifth of the rows
    docs += [(None, docs[3][1]), (None, None), (601, ""), (602, "...\n"), (603, "Ä" * 30_000 + " 日本 " + "long " * 5000)]
    docs += [(604, "b" * 63 + " " + "c" * 64 + " " + "d" * 65 + " E" * 20)]
    return docs


@pytest.mark.parametrize("least,percent", [(20, 25), (1, 100), (20, 0), (5, 60)])
def test_resample(spark, least, percent):
    docs, target = corpus(), ["alpha beta gamma", None, "", "Alpha BETA pi pi pi", "日本 long long"]
    df = with_extra(spark.createDataFrame(docs, "doc_id long, text string"))
    goal = spark.createDataFrame([(t,) for t in target], "text string")
    out = resample.resample(df, goal, least_words=least, percent=percent)
    assert out.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    assert sorted(map(tuple, out.collect()), key=str) == M.resampled(docs, target, least, percent)


def test_resample_of_nothing(spark):
    df = with_extra(spark.createDataFrame(corpus(10), "doc_id long, text string"))
    goal = spark.createDataFrame([("alpha",)], "text string")
    assert resample.resample(df.limit(0), goal).count() == 0
    bare = sorted(map(tuple, resample.resample(df, goal.limit(0)).collect()), key=str)
    assert bare == M.resampled(corpus(10), [])
    nothing = df.where("doc_id = 601 or text is null")
    assert nothing.count() and resample.resample(nothing, goal).where("rank is not null").count() == 0


def test_draw(spark):
    df = with_extra(spark.createDataFrame(corpus(), "doc_id long, text string"))
    goal = spark.createDataFrame([("alpha beta",)], "text string")
    out = resample.draw(df, goal)
    want = [r for r in M.resampled(corpus(), ["alpha beta"]) if r[4] is not None]
    assert out.columns == [c for c in df.columns if c != "rank"] + ["rank"]
    got = out.collect()
    assert sorted((r.doc_id, r["rank"]) for r in got) == sorted((r[0], r[4]) for r in want)
    texts = {}
    for i, t in corpus():
        texts.setdefault(i, set()).add(t)
    assert all(r.text in texts[r.doc_id] for r in got)


def test_cutoff_takes_just_k(spark):
    """Ties at every level, among them rows that only their number tells apart."""
    r = np.random.default_rng(1)
    rows = [(int(a), int(b), i) for i, (a, b) in enumerate(r.integers(-(1 << 40), 1 << 40, (3, 2))[r.integers(0, 3, 300)])]
    df = spark.createDataFrame(rows, "a long, b long, u long")
    order = [F.col("a"), F.bitwise_not(F.col("b")), F.bitwise_not(F.col("u"))]
    ordered = sorted(rows, key=lambda x: (-x[0], x[1], x[2]))
    for k in (0, 1, 50, 299, 300):
        assert sorted(map(tuple, df.where(resample.cutoff(df, order, k)).collect())) == sorted(ordered[:k])
    ranks = resample.ranked(df, order, "rank").orderBy("rank").collect()
    assert [(x.a, x.b, x.u) for x in ranks] == ordered and [x["rank"] for x in ranks] == list(range(1, 301))
