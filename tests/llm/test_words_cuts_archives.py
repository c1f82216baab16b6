"""Spelling variants, fill-in-the-middle and archives against the plain versions."""

from __future__ import annotations

import base64
import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest
import zstandard
from pyspark.sql import functions as F

import brute
from rankloom.llm import fill_middle, spelling, warc

key = lambda r: tuple(map(repr, r))


# ---- spelling


def misspelt(r, count=120):
    """Documents of few words, many of them one edit from a frequent one; a long word; letters beyond A-Z."""
    base = ["".join(r.choice("abcdeéßÿ") for _ in range(r.randint(6, 9))) for _ in range(12)]
    base += ["anagrams", "naagrams", "x" * 70, "y" * 69 + "é"]
    pool = []
    for word in base:
        pool += [word] * 30
        for _ in range(3):
            i = r.randrange(len(word))
            changed = r.choice([word[:i] + word[i + 1 :], word[:i] + "q" + word[i:], word[:i] + "z" + word[i + 1 :]])
            pool += [changed] * r.choice([4, 5, 6, 7])
            if r.random() < 0.5:
                pool += [changed + "s"] * 2
    r.shuffle(pool)
    rows = [(i, " ".join(pool[i :: count])) for i in range(count)]
    rows += [(count, None), (count + 1, ""), (count + 2, "1234 !? ,"), (None, " ".join(base).upper()), (7, rows[7][1]), (7, rows[7][1])]
    return rows


@pytest.mark.parametrize(("seed", "shard_words", "visitors"), [(1, 32_768, 50_000), (2, 5, 7), (3, 20, 3), (4, 1, 1)])
def test_spelling_forms(spark, seed, shard_words, visitors):
    rows = misspelt(random.Random(seed))
    got = spelling.spelling_forms(brute.frame(spark, rows, ["word", "n", "sig", "shard", "form"]), shard_words=shard_words, visitors=visitors)
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    want = brute.spelling(rows)
    assert sorted((tuple(r) for r in got.collect()), key=key) == sorted(want, key=key)
    assert any(r[1] for r in want)


def test_spelling_whole_table(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    got = [tuple(r) for r in spelling.spelling_forms(docs, shard_words=100, visitors=200).collect()]
    assert sorted(got, key=key) == sorted(brute.spelling(rows), key=key)


def test_spelling_empty(spark):
    assert spelling.spelling_forms(brute.frame(spark, [])).collect() == []
    assert spelling.spelling_forms(brute.frame(spark, [(1, None), (2, "short words")])).collect() == []


def test_spelling_roots_follow_long_chains(spark):
    links = spark.createDataFrame([(f"w{i}", f"w{i + 1}") for i in range(11)] + [("a", "w3")], "word string, form string")
    assert {tuple(r) for r in spelling.roots(links).collect()} == {(f"w{i}", "w11") for i in range(11)} | {("a", "w11")}


def test_spelling_one_edit():
    r = random.Random(5)
    for _ in range(3000):
        a = [r.choice("ab") for _ in range(r.randint(1, 6))]
        b = [r.choice("ab") for _ in range(r.randint(1, 6))]
        x, y = "".join(a), "".join(b)
        want = x != y and any(
            y == e for i in range(len(x) + 1) for c in ("", "a", "b") for e in (x[:i] + c + x[i:], x[:i] + c + x[i + 1 :])
        )
        assert spelling.one_edit(np.array([ord(c) for c in a]), np.array([ord(c) for c in b])) is want


# ---- fill in the middle

CUTS = [
    (1, "one two  three\n four"), (2, None), (3, ""), (4, " \t\n "), (5, " lead and trail \n"), (6, "é ü—x 漢字 𝒳y  "), (7, "a <S> marker"),
    (8, "x" * 100_000 + " y"), (9, ("word " * 30_000).strip()), (10, "a"), (11, " "), (12, "\x0b\x0c\x1c\x85\xa0 z"), (None, "no id here"),
    (None, None), (13, "<P"), (14, "S> x <"), (5, " lead and trail \n"), (15, "12345678"), (16, "1234567 "), (17, "1234567 9abcdef 0"),
]


@pytest.mark.parametrize("percent", [50, 100])
def test_fill_in_middle(spark, percent):
    rows = [*CUTS, *((i, t) for i in range(100, 160) for _, t in CUTS[:7])]
    done = fill_middle.fill_in_middle(brute.frame(spark, rows, ["n", "form", "output"]), percent=percent)
    want = [brute.middle(doc, text, percent) for doc, text in rows]
    assert sorted((tuple(r) for r in done.collect()), key=key) == sorted(want, key=key)
    forms = {r[2] for r in want}
    assert forms == {"plain", "psm", "spm"}
    back = done.select("doc_id", fill_middle.restored(F.col("output"), F.col("form")).alias("text")).collect()
    assert sorted((tuple(r) for r in back), key=key) == sorted(((d, t or "") for d, t in rows), key=key)


def test_fill_in_middle_empty(spark):
    done = fill_middle.digests(fill_middle.fill_in_middle(brute.frame(spark, [])))
    assert done.collect() == []
    assert done.columns == ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256"]


def test_cuts_at_every_unit():
    r = random.Random(3)
    texts = ["".join(r.choice("ab \t\né漢") for _ in range(r.randint(0, 40))) for _ in range(300)]
    marked = fill_middle.Marked(pa.array(texts))
    import re

    for row, text in enumerate(texts):
        units = re.findall(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+", text)
        assert marked.units[row] == len(units)
        at = np.full(len(units) + 1, row)
        ends = marked.cut(at, np.arange(len(units) + 1))
        assert ends.tolist() == [len("".join(units[:k]).encode()) for k in range(len(units) + 1)]
        assert marked.chars(at, ends).tolist() == [len("".join(units[:k])) for k in range(len(units) + 1)]


def test_space_marks_of_every_byte():
    data = np.arange(256, dtype=np.uint8)
    marks = fill_middle.space_marks(data.view("<u8")).view(np.uint8)
    assert np.flatnonzero(marks).tolist() == [9, 10, 11, 12, 13, 32] and set(marks.tolist()) == {0, 0x80}


# ---- archives

PAGES = [
    (1, "http://a/1", "<p>same</p>"), (2, "http://a/2", "<p>same</p>"), (3, None, None), (4, "http://a/4", ""), (5, "http://b/ 5\n", "é\r\n\r\nWARC/1.1\r\n\r\n"),
    (6, "http://a/6", "x" * 900_000), (6, "http://a/6", "other"), (7, "u", "<p>same</p>"), (7, "t", "<p>same</p>"), (7, "t", "<p>same</p>"),
    (None, "n", "<p>same</p>"), (None, "n", "only here"), (None, "n", "only here"), (8, "http://a/8", "y"),
]


def page_frame(spark, rows):
    schema = "page_id long, url string, html string, key string, keep string, payload string, response string"
    return spark.createDataFrame([(*r, "x", "x", "x", "x") for r in rows], schema)


def expected(rows):
    """Multiset of (page_id, bytes, digest, type, refers_to)."""
    groups = {}
    for page, _, html in rows:
        groups.setdefault((html or "").encode(), []).append(page)
    out = []
    for payload, pages in groups.items():
        best = max((p for p in pages if p is not None), default=None)
        label = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        left = list(pages)
        left.remove(best)
        out.append((best, len(payload), label, "response", None))
        out += [(p, len(payload), label, "revisit", best) for p in left]
    return sorted(out, key=key)


@pytest.mark.parametrize(("broadcast", "hot"), [(200_000, 1000), (0, 1000), (0, 3)])
def test_archive_round_trip(spark, monkeypatch, broadcast, hot):
    monkeypatch.setattr(warc, "BROADCAST_ROWS", broadcast)
    monkeypatch.setattr(warc, "HOT", hot)
    got = sorted((tuple(r) for r in warc.archived_pages(page_frame(spark, PAGES)).collect()), key=key)
    assert got == expected(PAGES)


def test_archive_whole_table(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    rows = [(r.page_id, r.url, r.html) for r in pages.collect()]
    assert sorted((tuple(r) for r in warc.archived_pages(pages).collect()), key=key) == expected(rows)


def test_archive_empty(spark):
    assert warc.archived_pages(page_frame(spark, [])).collect() == []


def test_bundles_are_seekable_and_standard(spark, tmp_path):
    rows = [(i, f"http://h/{i}", f"<p>{i}</p>" * (i % 50)) for i in range(400)]
    archive = warc.write_archive(page_frame(spark, rows).repartition(2), folder=f"file:{tmp_path}", frame_bytes=2000, bundle_bytes=1500)
    index = archive.index.collect()
    assert len({r.record_id for r in index}) == len(rows) and len({r.bundle for r in index}) > 2 and max(r.frame for r in index) > 0
    files = sorted((tmp_path / "bundles").glob("*.warc.zst"))
    assert {f.name for f in files} == {r.bundle for r in index}
    for file in files:
        data = file.read_bytes()
        spans = warc.frame_spans(lambda at, n, data=data: data[at : at + n], len(data))
        plain = [zstandard.decompress(data[a:b]) for a, b in spans]
        # any reader of the format sees one stream: the seek table is a frame to skip
        whole = zstandard.ZstdDecompressor().stream_reader(data, read_across_frames=True).read()
        assert whole == b"".join(plain)
        for r in (r for r in index if r.bundle == file.name):
            fields, _, end = warc.parse(plain[r.frame], r.offset)
            assert fields["WARC-Record-ID"] == f"<{r.record_id}>" and end - r.offset == r.length


def test_fetch_reads_single_records(spark):
    archive = warc.write_archive(page_frame(spark, PAGES), frame_bytes=100)
    every = {r.record_id: r for r in warc.read_archive(archive).collect()}
    wanted = sorted(every)[::2]
    ids = spark.createDataFrame([(w,) for w in [*wanted, wanted[0], "urn:uuid:none"]], "record_id string")
    assert {r.record_id: r for r in warc.fetch(archive, ids).collect()} == {w: every[w] for w in wanted}
    for r in every.values():
        if r.record_type == "revisit":
            assert every[r.refers_to_record].page_id == r.refers_to and every[r.refers_to_record].payload_digest == r.payload_digest
        else:
            assert warc.digest_label(r.payload) == r.payload_digest


def test_unnamed_bundles_are_not_read(spark, tmp_path):
    """What a lost attempt leaves is in no index."""
    archive = warc.write_archive(page_frame(spark, PAGES), folder=str(tmp_path))
    (tmp_path / "bundles" / "stray.warc.zst").write_bytes(b"half a bundle")
    assert warc.read_archive(archive).count() == len(PAGES)


def test_damaged_payload_is_an_error(spark, tmp_path):
    fields = [("WARC-Type", "response"), ("WARC-Record-ID", "<urn:uuid:x>"), ("WARC-Payload-Digest", "sha1:" + warc.digest_label(b"good")), ("WARC-Target-URI", "")]
    with pytest.raises(ValueError):
        warc._row(*warc.parse(warc.record(fields, warc.message(4) + b"evil"))[:2])
