"""Deduplication, joins, decontamination and token counts against the plain versions."""

from __future__ import annotations

import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

import brute
from rankloom.llm import decontaminate, exact_dedup, line_dedup, ngram_join, textbatch, token_counts
from rankloom.llm.exchange import gather

ODD = [
    (1, "Same text here, in five words"), (2, "Same  text here,\tin five words\n"), (3, None), (4, ""), (5, " \n\t "),
    (6, "é — ü x"), (7, "word " * 3000), (8, "word " * 3000), (None, "Same text here, in five words"), (None, None),
    (9, "a b c d e f\n\na b c d e f\nA B C D E F\nshort"), (9, "a b c d e f\n\na b c d e f\nA B C D E F\nshort"),
    (10, "x" * 50_000), (11, "\x0b\x0c\x1c"), (12, "a b c d e g"),
]
NAMED = [r for r in ODD if r[0] is not None]


def test_word_hashes_follow_words():
    texts = ["a b  a", None, "", "\tÄ a b a", "a" * 3_000_000 + " a"]
    data, bounds = textbatch.text_buffers(pa.array(texts))
    starts, ends, first = textbatch.word_spans(data, bounds)
    raw = data.tobytes()
    found = [raw[s:e] for s, e in zip(starts, ends)]
    assert found == [w for t in texts for w in (t or "").encode().replace(b"\t", b" ").split(b" ") if w]
    assert np.diff(first).tolist() == [3, 0, 0, 3, 2]
    hashes = textbatch.span_hashes(data, starts, ends)
    by_word = {}
    for word, value in zip(found, hashes.tolist()):
        assert by_word.setdefault(word, value) == value
    assert len(set(by_word.values())) == len(by_word)


def test_grams_of_short_and_long_rows():
    words, first = np.arange(1, 12, dtype=np.uint64), np.array([0, 0, 3, 8, 11])
    grams, rows = textbatch.gram_hashes(words, first, 5)
    assert np.diff(rows).tolist() == [0, 1, 1, 1] and len(set(grams.tolist())) == 3


@pytest.mark.parametrize("rows", [ODD, [], brute.near_copies(random.Random(4))])
def test_exact_duplicates(spark, rows):
    got = [tuple(r) for r in exact_dedup.exact_duplicates(brute.frame(spark, rows)).collect()]
    key = lambda r: tuple(map(repr, r))
    assert sorted(got, key=key) == sorted(brute.exact(rows), key=key)


def test_exact_duplicates_without_heavy_texts(spark, monkeypatch):
    """The split never decides: with one candidate the shuffle finds the other groups."""
    monkeypatch.setattr(exact_dedup, "HEAVY", 1)
    rows = [(i, f"text {i % 7}") for i in range(70)]
    got = sorted(tuple(r) for r in exact_dedup.exact_duplicates(brute.frame(spark, rows)).collect())
    assert got == sorted(brute.exact(rows))


@pytest.mark.parametrize(("seed", "hot"), [(1, 1000), (2, 2)])
def test_jaccard_components(spark, monkeypatch, seed, hot):
    monkeypatch.setattr(ngram_join, "HOT_FLOOR", hot)
    monkeypatch.setattr(ngram_join, "SORTED_ENTRIES", 300)
    rows = brute.near_copies(random.Random(seed), 150)
    got = {r[0]: (r[1], r[2]) for r in ngram_join.jaccard_components(brute.frame(spark, rows)).collect()}
    assert got == brute.linked(rows)


def test_jaccard_odd_rows(spark):
    got = ngram_join.jaccard_components(brute.frame(spark, ODD)).collect()
    assert len(got) == len(ODD)
    want = brute.linked(NAMED)
    assert all((r[1], r[2]) == want[r[0]] for r in got if r[0] is not None)
    assert sorted((r[1], r[2]) for r in got if r[0] is None and r[1]) == [(2, 1)]
    assert ngram_join.jaccard_components(brute.frame(spark, [])).collect() == []


def test_adaptive_prefix_keeps_every_link():
    """Whatever lengths two documents take, a linked pair shares the smaller demand."""
    r = random.Random(8)
    for _ in range(300):
        base = r.sample(range(1000), r.randint(4, 60))
        other = base[:]
        for _ in range(r.randint(0, 6)):
            other[r.randrange(len(other))] = r.randrange(1000, 2000)
        a, b = set(base), set(other)
        if 100 * len(a & b) < 75 * len(a | b):
            continue
        df = {t: r.randint(2, 50) if t in a & b else r.choice((1, 9)) for t in a | b}
        prefix, asked = [], []
        for s in (a, b):
            order = sorted((t for t in s if df[t] > 1), key=lambda t: (df[t], t))
            n, need = len(s), -(-75 * len(s) // 100)
            take = ngram_join.adaptive_matches(n, np.array([df[t] for t in order]), 75)
            prefix.append(set(order[: n - need + take - (n - len(order))]))
            asked.append(take)
        assert len(prefix[0] & prefix[1]) >= min(asked)


@pytest.mark.parametrize("seed", [1])
def test_line_dedup(spark, seed):
    r = random.Random(seed)
    lines = [" ".join(f"v{r.randrange(30)}" for _ in range(r.randint(1, 12))) for _ in range(40)]
    rows = []
    for doc in range(60):
        chosen = []
        for _ in range(r.randint(0, 6)):
            w = r.choice(lines).split(" ")
            edit = r.random()
            if edit < 0.2:
                w[r.randrange(len(w))] = f"V{r.randrange(30)}"
            elif edit < 0.4:
                del w[r.randrange(len(w))]
            elif edit < 0.5:
                w.insert(r.randrange(len(w) + 1), "new")
            chosen.append(r.choice(("", " ")) + r.choice((" ", "  ", "\t")).join(w))
        rows.append((doc, "\n".join(chosen)))
    got = {x["doc_id"]: (x["text"], x["n_lines"], x["n_removed"]) for x in line_dedup.deduplicate_lines(brute.frame(spark, rows)).collect()}
    assert got == brute.line_dedup(rows)


def test_variant_rule_is_the_edit_distance():
    r = random.Random(3)
    for _ in range(2000):
        a = [r.choice("ab") for _ in range(r.randint(1, 6))]
        b = [r.choice("ab") for _ in range(r.randint(1, 6))]
        va = {(tuple(a), -1)} | {(tuple(a[:i] + a[i + 1 :]), i) for i in range(len(a))}
        vb = {(tuple(b), -1)} | {(tuple(b[:i] + b[i + 1 :]), i) for i in range(len(b))}
        by_rule = any(v == w and (i == j or -1 in (i, j)) for v, i in va for w, j in vb)
        assert by_rule == brute.within_one(a, b)


def test_line_dedup_odd_rows(spark):
    docs = brute.frame(spark, ODD, extra=["n_removed"])
    done = line_dedup.deduplicate_lines(docs)
    assert done.columns == [c for c in docs.columns if c not in ("n_lines", "n_removed")] + ["n_lines", "n_removed"]
    got = done.collect()
    want = brute.line_dedup(NAMED[:9] + NAMED[10:])  # the rows of one id are one document
    assert sorted(map(repr, ((x["doc_id"], x["text"]) for x in got if x["doc_id"] is None))) == sorted(map(repr, [r for r in ODD if r[0] is None]))
    assert all((x["text"], x["n_lines"], x["n_removed"]) == want[x["doc_id"]] for x in got if x["doc_id"] is not None)
    assert line_dedup.deduplicate_lines(brute.frame(spark, [])).collect() == []


def test_line_dedup_keeps_lines_that_do_not_repeat(spark):
    rows = [(1, "one line of many words"), (2, "one line of many words\nonly here\n\nunique poem line"), (3, "One line of many words")]
    got = {x["doc_id"]: x["text"] for x in line_dedup.deduplicate_lines(brute.frame(spark, rows)).collect()}
    assert got == {1: "one line of many words", 2: "only here\n\nunique poem line", 3: ""}


def test_line_dedup_of_short_lines(spark):
    rows = [(1, "All rights reserved.\na b c d\n\na b c d e"), (2, "ALL rights  reserved.\na b c x\n\na b c d f"), (3, "無空白\n無空白\na b c d")]
    done = line_dedup.deduplicate_lines(brute.frame(spark, rows))
    got = {x["doc_id"]: (x["text"], x["n_lines"], x["n_removed"]) for x in done.collect()}
    assert got == {1: (rows[0][1], 3, 0), 2: ("a b c x\n", 3, 2), 3: ("無空白", 3, 2)}


def test_line_dedup_buckets_follow_the_text(spark, monkeypatch):
    rows = [(i, f"the line {i % 7} of five words\nand line {i % 11} with five more") for i in range(60)]
    asked, by_bucket = [], line_dedup.by_bucket
    monkeypatch.setattr(line_dedup, "BUCKET_BYTES", 100, raising=False)
    monkeypatch.setattr(line_dedup, "by_bucket", lambda df, n, *rest: (asked.append(n), by_bucket(df, n, *rest))[1])
    got = {x["doc_id"]: (x["text"], x["n_lines"], x["n_removed"]) for x in line_dedup.deduplicate_lines(brute.frame(spark, rows)).collect()}
    assert got == brute.line_dedup(rows)
    assert len(asked) == 3 and min(asked) >= sum(len(t) for _, t in rows) // 100


def _benchmark(spark, items):
    return spark.createDataFrame(items, "item_id long, text string")


@pytest.mark.parametrize("block", [60])
def test_benchmark_overlap(spark, monkeypatch, block):
    monkeypatch.setattr(decontaminate, "BLOCK_WORDS", block)
    r = random.Random(6)
    items = [(i, " ".join(f"t{r.randrange(60)}" for _ in range(r.randint(3, 30)))) for i in range(12)] + [(12, None), (13, ""), (0, "Twice")]
    rows = list(ODD)
    for doc in range(20, 70):
        w = (r.choice(items[:12])[1]).split(" ")
        cuts = sorted(r.sample(range(len(w) + 1), 2))
        parts = [w[: cuts[0]], w[cuts[0] : cuts[1]], w[cuts[1] :]]
        r.shuffle(parts)
        filler = [f"f{r.randrange(99)}" for _ in range(5)]
        rows.append((doc, " ".join([*filler, *parts[0], *filler, *parts[1], *parts[2], *filler]).upper()))
    docs = brute.frame(spark, rows)
    got = sorted(tuple(x) for x in decontaminate.benchmark_overlap(docs, _benchmark(spark, items)).collect())
    assert got == sorted(brute.overlaps(rows, items)) and any(x[2] > 1 for x in got)
    left = decontaminate.decontaminate(docs, _benchmark(spark, items))
    assert left.columns == docs.columns
    flagged = {x[0] for x in got}
    assert sorted(map(repr, (x["doc_id"] for x in left.collect()))) == sorted(repr(d) for d, _ in rows if d not in flagged)


def test_benchmark_overlap_of_empty_tables(spark):
    some, none = brute.frame(spark, ODD), brute.frame(spark, [])
    assert decontaminate.benchmark_overlap(some, _benchmark(spark, [])).collect() == []
    assert decontaminate.benchmark_overlap(none, _benchmark(spark, [(1, "a b c d e f")])).collect() == []
    assert decontaminate.decontaminate(some, _benchmark(spark, [])).count() == len(ODD)


def test_benchmark_overlap_of_text_ids_and_equal_items(spark):
    docs = spark.createDataFrame([("x", "0 a b c d e f g"), ("x", "0 a b c d e f g"), (None, "A B C D E F G"), ("y", None)], "doc_id string, text string")
    items = [("i", "a b c d e f g"), ("j", "a b c d e f g"), (None, "a b c d e f g"), ("k", None), ("l", "")]
    bench = spark.createDataFrame(items, "item_id string, text string")
    got = decontaminate.benchmark_overlap(docs, bench).collect()
    wanted = [(d, i, 1, 7, 7) for d in ("x", "x", None) for i in ("i", "j", None)]
    assert sorted(map(tuple, got), key=repr) == sorted(wanted, key=repr)
    assert [r.doc_id for r in decontaminate.decontaminate(docs, bench).collect()] == ["y"]


def test_tiling_equals_plain_tiling():
    r = random.Random(5)
    for _ in range(300):
        test = [r.randrange(6) for _ in range(r.randint(0, 25))]
        doc = [r.randrange(6) for _ in range(r.randint(0, 40))]
        got = decontaminate.greedy_tiles(np.array(test, np.uint64), np.array(doc, np.uint64), 3)
        assert got == brute.tiles(test, doc, 3)


def test_pairs_to_verify_share_what_their_sizes_ask():
    """Every link is among them; sets of one pool that overlap too little are not."""
    r = random.Random(7)
    pool = [r.getrandbits(63) for _ in range(190)]
    sets = [set(r.sample(pool, r.choice((70, 80, 84)))) for _ in range(60)]
    for base in sets[:20]:
        gone = r.sample(sorted(base), r.randint(1, 12))
        sets.append(base - set(gone) | {r.getrandbits(63) for _ in range(r.randint(0, 6))})
    df = Counter(t for s in sets for t in s)
    rows = []
    for k, s in enumerate(sets):
        runs = sorted((t for t in s if df[t] > 1), key=lambda t: (df[t], t))
        rows.append((k, len(s), np.array(runs, "<u8").tobytes(), np.array([df[t] for t in runs], "<i4").tobytes(), None))
    names = ["class", "n", "runs", "dfs", "component"]
    batch = pa.RecordBatch.from_arrays([pa.array([x[i] for x in rows], pa.int64() if i == 4 else None) for i in range(5)], names=names)
    posted = list(ngram_join._postings(75, 1)(iter([batch])))
    entries = gather(pa.Table.from_batches(posted), {"run": "<u8", "k": "<i8", "label": "<i8", "l": "<i4", "n": "<i4"})
    counted = pa.Table.from_batches(list(ngram_join._crosses(1, 75)(entries)))
    pairs = pa.Table.from_batches(list(ngram_join._matched(gather(counted, {"a": "<i8", "b": "<i8", "count": "<i4", "l": "<i4"}))))
    got = set(zip(pairs["a"].to_pylist(), pairs["b"].to_pylist()))
    shared = {(a, b): len(sets[a] & sets[b]) for a in range(len(sets)) for b in range(a + 1, len(sets))}
    links = {(a, b) for (a, b), n in shared.items() if 100 * n >= 75 * (len(sets[a]) + len(sets[b]) - n)}
    assert len(links) > 15 and links <= got
    assert len(got) < len(shared) // 5, (len(got), len(links), len(shared))


def test_automaton_equals_greedy_match():
    r = random.Random(1)
    for _ in range(200):
        vocabulary = {r.choice("abé▁") + "".join(r.choice("abé") for _ in range(r.randint(0, 4))) for _ in range(r.randint(0, 12))}
        words = ["".join(r.choice("abéc") for _ in range(r.randint(1, 9))) for _ in range(40)] + ["ab" * 200]
        raw = [w.encode() for w in words]
        ends = np.cumsum([len(w) for w in raw])
        starts = ends - [len(w) for w in raw]
        got = token_counts.build(sorted(vocabulary)).pieces(np.frombuffer(b"".join(raw), np.uint8), starts, ends, "▁".encode())
        assert got.tolist() == [brute.pieces_of(w, vocabulary) for w in words]


def test_token_counts(spark):
    vocabulary = ["▁", "▁S", "ame", "▁text", "t", "e", "x", "xx", "▁a", "▁word", "h", "r", "▁é", "b"]
    got = [tuple(r) for r in token_counts.token_counts(brute.frame(spark, ODD), vocabulary).collect()]
    import re

    want = []
    for doc, text in ODD:
        counts = [brute.pieces_of(w, set(vocabulary)) for w in re.findall(r"[^\x20\x09-\x0D]+", text or "")]
        want.append((doc, len(counts), counts.count(0), sum(max(c, 1) for c in counts)))
    assert sorted(got, key=repr) == sorted(want, key=repr)
    assert token_counts.token_counts(brute.frame(spark, []), vocabulary).collect() == []
