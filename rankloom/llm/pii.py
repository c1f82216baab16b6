"""Personal data by a linear-chain conditional random field over word shapes.

Four kinds have a written form that is always reported (``base``): email, ip, card, phone. A chain over
the words of a text adds spans of these kinds that match no form: phones without a plus sign, masked or dotless
emails, addresses of version 6, cards with other signs between the groups. What a form matched and its
check refused (a wrong check digit) stays unreported. The label of a word is none, or the begin or the inside of one of the kinds;
its features are the word's shape (letters, digits and signs), the collapsed shape, those of both
neighbours, the signs between letters and digits, the length and the word before.

It is trained by maximum likelihood on a small labelled table that is written here from a seed: such spans and look-alikes
(dates, prices, versions, ids, references) between invented words. The words that the written forms cover in a bounded sample
join it, the word before them hidden; other words of the sample are not labelled, so they teach nothing. Decoding is Viterbi's.

A word without a digit and without one of ``@([{<-:+`` (but for a closing colon) is never part of a span. Fixing its label cuts a text
into runs of other words that are decoded exactly and all in step, whatever their number in a batch.

Defined results: null counts as empty and has no span; a repeated row is searched each time; without a base
span in the sample the table alone teaches. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankloom.llm.textbatch import Covered, code_points, lowered, passes, prepare, sample, span_hashes, text_buffers, word_spans

KINDS = ("email", "ip", "card", "phone")
#: Rows of the labelled table, and documents with a digit or an at sign that join it at most.
TABLE_ROWS = 6_000
SAMPLE_ROWS = 3_000
#: Longest text of that sample.
SAMPLE_CHARS = 200_000
#: Hashed features and training steps.
SLOTS = 1 << 14
FEATURES = 7
STEPS = 100
PENALTY = 1e-3
#: Distinct runs of words in the training table at most, and words of a training run.
TRAINING_RUNS = 12_000
TRAINING_WORDS = 40

_EMAIL = re.compile(r"[A-Za-z0-9._%+-]++@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
#: A match never begins inside a run of digits, so none is tried there.
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
Span = tuple[str, int, int]


def luhn(digits: str) -> bool:
    total = 0
    for i, digit in enumerate(map(int, reversed(digits))):
        twice = 2 * digit if i % 2 else digit
        total += twice - 9 if twice > 9 else twice
    return total % 10 == 0


def _emails(text: str) -> Iterator[Span]:
    end, at = 0, text.find("@")
    while at >= 0:
        # the longest stretch of the local part's characters that reaches the at sign
        start = at
        while start > end and (text[start - 1].isascii() and (text[start - 1].isalnum() or text[start - 1] in "._%+-")):
            start -= 1
        if start < at and (found := _EMAIL.match(text, start)):
            yield "email", found.start(), found.end()
            end = found.end()
        at = text.find("@", max(at + 1, end))


def base_spans(text: str, rejected: list[Span] | None = None) -> list[Span]:
    """Spans of the written forms, kind by kind, each from left to right without overlap.

    Matches that fail a form's check are collected in ``rejected``.
    """
    spans, dropped = list(_emails(text)), [] if rejected is None else rejected
    for found in _IP.finditer(text):
        fits = all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in found.group().split("."))
        (spans if fits else dropped).append(("ip", found.start(), found.end()))
    for found in _CARD.finditer(text):
        digits = found.group().replace(" ", "").replace("-", "")
        fits = 13 <= len(digits) <= 19 and luhn(digits)
        if fits or len(digits) >= 13:  # fewer digits are a number of any kind
            (spans if fits else dropped).append(("card", found.start(), found.end()))
    for found in _PHONE.finditer(text):
        fits = 9 <= sum(c in "0123456789" for c in found.group()) <= 15
        (spans if fits else dropped).append(("phone", found.start(), found.end()))
    return spans


def joined(spans: list[Span]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end in spans)


def _shape_table() -> np.ndarray:
    table = np.arange(256).astype(np.uint8)
    for members, sign in ((b"abcdefghijklmnopqrstuvwxyz", b"a"), (b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"A"), (b"0123456789", b"0")):
        table[list(members)] = sign[0]
    table[128:] = ord("a")
    return table


_SHAPE = _shape_table()
#: Signs that may close a word of letters.
_CLOSING = np.isin(np.arange(256), list(b".,;:!?\"')"))
#: A word without one of these is plain.
_TELLING = np.isin(np.arange(256), list(b"0123456789@([{<-:+"))
#: Signs that are not part of a span at its end, at its start.
_AFTER, _QUOTES = _CLOSING, np.isin(np.arange(256), list(b"\"'"))


@dataclass
class Runs:
    """Words that are not plain, grouped into runs of neighbours: spans in bytes, document row, features."""

    starts: np.ndarray
    ends: np.ndarray
    row: np.ndarray
    bounds: np.ndarray
    slots: np.ndarray


def _slots(hashes: np.ndarray, salt: int) -> np.ndarray:
    value = (hashes + np.uint64(salt)) * np.uint64(0x9E3779B97F4A7C15)
    return (value >> np.uint64(40)).astype(np.int64) % SLOTS


def word_runs(data: np.ndarray, bounds: np.ndarray) -> Runs:
    starts, ends, first = word_spans(data, bounds)
    shape = _SHAPE[data] if len(data) else data
    odd = np.concatenate(([0], np.cumsum(_TELLING[data]))) if len(data) else np.zeros(1, np.int64)
    last = ends - 1
    signs = odd[ends] - odd[starts]
    closed = _CLOSING[data[last]] & _TELLING[data[last]] if len(starts) else np.zeros(0, bool)
    plain = (signs == 0) | ((signs == 1) & closed)
    at = np.flatnonzero(~plain)
    row = np.searchsorted(first, at, side="right") - 1
    new = np.ones(len(at), bool)
    new[1:] = (at[1:] != at[:-1] + 1) | (row[1:] != row[:-1])
    begins = np.append(np.flatnonzero(new), len(at))
    # shapes of these words and their neighbours in the same text
    before, after = np.maximum(at - 1, 0), np.minimum(at + 1, max(len(starts) - 1, 0))
    wanted = np.unique(np.concatenate((at, before, after))) if len(at) else np.empty(0, np.int64)
    full = span_hashes(shape, starts[wanted], ends[wanted])
    collapsed = _collapsed(shape, starts[wanted], ends[wanted])
    here = np.searchsorted(wanted, at)
    left, right = collapsed[np.searchsorted(wanted, before)], collapsed[np.searchsorted(wanted, after)]
    left = np.where(at > first[row], left, np.uint64(1))
    right = np.where(at + 1 < first[row + 1], right, np.uint64(2))
    size = np.minimum(ends[at] - starts[at], 30).astype(np.uint64)
    blurred = np.where((shape == ord("a")) | (shape == ord("A")), ord("0"), shape).astype(np.uint8) if len(at) else shape
    signs_only = _collapsed(blurred, starts[at], ends[at])
    cue = span_hashes(lowered(data), starts[before], ends[before]) if len(at) else np.empty(0, np.uint64)
    cue = np.where(at > first[row], cue, np.uint64(1))
    slots = np.column_stack([_slots(v, i + 1) for i, v in enumerate((full[here], collapsed[here], left, right, size, signs_only, cue))])
    return Runs(starts[at], ends[at], row, begins, slots.reshape(len(at), FEATURES))


def _collapsed(shape: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of the spans with equal neighbouring signs written once."""
    if not len(starts):
        return np.empty(0, np.uint64)
    size = ends - starts
    begin = np.cumsum(size) - size
    flat = shape[np.repeat(starts - begin, size) + np.arange(size.sum())]
    keep = np.ones(len(flat), bool)
    keep[1:] = flat[1:] != flat[:-1]
    keep[begin] = True
    count = np.concatenate(([0], np.cumsum(keep)))
    return span_hashes(flat[keep], count[begin], count[begin + size])


@dataclass
class Chain:
    """Feature weights (slot x label) and transition weights; label 0 is none."""

    weights: np.ndarray
    moves: np.ndarray

    def decode(self, slots: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """The best labels of every run (Viterbi), all runs in step, the longest first."""
        emit = self.weights[slots].sum(1)
        labels = np.zeros(len(slots), np.int64)
        size = np.diff(bounds)
        order = np.argsort(-size, kind="stable")
        size, begin = size[order], bounds[:-1][order]
        back = np.zeros((len(slots), emit.shape[1]), np.int8)
        score = np.zeros((len(order), emit.shape[1]))
        outside = self.moves[0]
        for t in range(int(size[0]) if len(size) else 0):
            n = int(np.searchsorted(-size, -t, side="left"))
            place = begin[:n] + t
            if t == 0:
                score[:n] = outside + emit[place]
                continue
            through = score[:n, :, None] + self.moves[None]
            best = through.argmax(1)
            back[place] = best
            score[:n] = np.take_along_axis(through, best[:, None], 1)[:, 0] + emit[place]
        state = (score + self.moves[:, 0]).argmax(1) if len(size) else np.empty(0, np.int64)
        for t in range(int(size[0]) - 1 if len(size) else -1, -1, -1):
            n = int(np.searchsorted(-size, -t, side="left"))
            place = begin[:n] + t
            labels[place] = state[:n]
            state[:n] = back[place, state[:n]] if t else state[:n]
        return labels


def _logsum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis, keepdims=True)
    return (top + np.log(np.exp(x - top).sum(axis, keepdims=True))).squeeze(axis)


def _expected(emit: np.ndarray, moves: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Label probabilities (runs x words x labels) and summed transition probabilities of equal-length runs."""
    runs, words, labels = emit.shape
    ahead, behind = np.empty_like(emit), np.empty_like(emit)
    ahead[:, 0] = moves[0] + emit[:, 0]
    for t in range(1, words):
        ahead[:, t] = _logsum(ahead[:, t - 1][:, :, None] + moves[None], 1) + emit[:, t]
    behind[:, -1] = moves[:, 0]
    for t in range(words - 2, -1, -1):
        behind[:, t] = _logsum(moves[None] + (emit[:, t + 1] + behind[:, t + 1])[:, None, :], 2)
    total = _logsum(ahead[:, -1] + moves[:, 0], 1)
    single = np.exp(ahead + behind - total[:, None, None])
    pair = np.zeros((runs, labels, labels))
    for t in range(1, words):
        pair += np.exp(ahead[:, t - 1][:, :, None] + moves[None] + (emit[:, t] + behind[:, t])[:, None, :] - total[:, None, None])
    pair[:, 0, :] += single[:, 0]  # from and to the words outside
    pair[:, :, 0] += single[:, -1]
    return single, pair


def train(runs: list[tuple[np.ndarray, np.ndarray, int]], labels: int = 2 * len(KINDS) + 1) -> Chain:
    """Maximum likelihood with a small penalty; ``runs``: (features, labels, times)."""
    weights, moves = np.zeros((SLOTS, labels)), np.zeros((labels, labels))
    by_size: dict[int, list] = {}
    for run in runs:
        by_size.setdefault(len(run[1]), []).append(run)
    groups = [(np.stack([r[0] for r in g]), np.stack([r[1] for r in g]), np.array([float(r[2]) for r in g])) for g in by_size.values()]
    known = np.zeros_like(weights)
    steps = np.zeros_like(moves)
    for slots, truth, times in groups:
        mass = np.repeat(times, truth.shape[1])
        for k in range(slots.shape[2]):
            np.add.at(known, (slots[:, :, k].ravel(), truth.ravel()), mass)
        path = np.pad(truth, ((0, 0), (1, 1)))
        np.add.at(steps, (path[:, :-1].ravel(), path[:, 1:].ravel()), np.repeat(times, truth.shape[1] + 1))
    count = max(1.0, sum(g[2].sum() for g in groups))
    state = [np.zeros_like(weights), np.zeros_like(weights), np.zeros_like(moves), np.zeros_like(moves)]
    for turn in range(1, STEPS + 1):
        slope, bend = known.copy(), steps.copy()
        for slots, _, times in groups:
            single, pair = _expected(weights[slots].sum(2), moves)
            mass = (single * times[:, None, None]).reshape(-1, labels)
            for k in range(slots.shape[2]):
                np.subtract.at(slope, slots[:, :, k].ravel(), mass)
            bend -= (pair * times[:, None, None]).sum(0)
        for value, grad, m, v in ((weights, slope, state[0], state[1]), (moves, bend, state[2], state[3])):
            grad = grad / count - PENALTY * value
            m += 0.1 * (grad - m)
            v += 0.01 * (grad**2 - v)
            value += 0.3 * (m / (1 - 0.9**turn)) / (np.sqrt(v / (1 - 0.99**turn)) + 1e-6)
    return Chain(weights, moves)


def labelled_table(size: int, seed: int) -> list[tuple[str, list[Span]]]:
    """Lines of invented words with their spans, most of which no form covers, and with look-alikes."""
    random = np.random.default_rng(seed)

    def pick(options):
        return options[int(random.integers(len(options)))]

    def n(low: int, high: int | None = None) -> str:
        return "".join(pick("0123456789") for _ in range(int(random.integers(low, (high or low) + 1))))

    def word() -> str:
        made = "".join(pick("bcdfghlmnprstvwz") + pick("aeiou\u00e9\u00fc") + pick(["", "", "n", "r", "st"]) for _ in range(int(random.integers(1, 4))))
        return pick([made, made, made, made.capitalize(), made.upper()])

    def name() -> str:
        return pick("bcdfgklmnprst") + pick("aeiou") + pick("lmnrst") + pick(["", "a", "er", "son", n(1, 2)])

    def six() -> str:
        return "".join(pick("0123456789abcdef") for _ in range(int(random.integers(1, 5))))

    top = ["com", "org", "net", "de", "fr", "es"]
    spans = (
        ("phone", lambda: f"({n(3)}) {n(3)}-{n(4)}"),
        ("phone", lambda: f"{n(3)}-{n(3)}-{n(4)}"),
        ("phone", lambda: f"{n(3)}.{n(3)}.{n(4)}"),
        ("phone", lambda: f"1-{n(3)}-{n(3)}-{n(4)}"),
        ("phone", lambda: f"0{n(2, 4)} {n(3, 4)} {n(3, 4)}"),
        ("phone", lambda: f"0{n(2, 4)}/{n(6, 8)}"),
        ("phone", lambda: f"00{n(2)} {n(2, 3)} {n(6, 8)}"),
        ("phone", lambda: f"0{n(1)} {n(2)} {n(2)} {n(2)} {n(2)}"),
        ("email", lambda: f"{name()}@{pick(['localhost', 'mail', 'intranet', name()])}"),
        ("email", lambda: f"{name()}{pick(['[at]', '(at)', '{at}', '<at>'])}{name()}.{pick(top)}"),
        ("email", lambda: f"{name()}.{name()}{pick(['[at]', '(at)'])}{name()}{pick(['[dot]', '(dot)'])}{pick(top)}"),
        ("ip", lambda: ":".join(six() for _ in range(8))),
        ("ip", lambda: f"{six()}:{six()}::{six()}:{six()}"),
        ("ip", lambda: f"{six()}:{six()}:{six()}::{six()}"),
        ("ip", lambda: pick(["[.]", "(.)"]).join(str(random.integers(256)) for _ in range(4))),
        ("card", lambda: pick([".", "/", "_"]).join(n(4) for _ in range(4))),
        ("card", lambda: " - ".join(n(4) for _ in range(4))),
        ("email", lambda: f"{name()}{pick(['.', '_', ''])}{n(0, 2)}@{name()}.{pick(top)}"),
        ("ip", lambda: ".".join(str(random.integers(256)) for _ in range(4))),
        ("phone", lambda: f"+{n(1, 2)} ({n(3)}) {n(3)}-{n(4)}"),
    )
    others = (
        lambda: f"{n(4)}-{n(2)}-{n(2)}", lambda: f"{n(1, 2)}/{n(1, 2)}/{n(4)}", lambda: f"{n(1, 2)}.{n(1, 2)}.{n(2, 4)}",
        lambda: f"{n(1, 2)}:{n(2)}", lambda: f"{n(2)}:{n(2)}:{n(2)}", lambda: f"{n(2)}:{n(2)}-{n(2)}:{n(2)}", lambda: f"{n(4)}-{n(4)}",
        lambda: f"{n(1, 3)}-{n(1, 3)}", lambda: pick("$\u20ac\u00a3") + f"{n(1, 4)}.{n(2)}", lambda: f"{n(1, 3)},{n(2)}\u20ac", lambda: f"{n(1, 2)}%",
        lambda: f"{n(1, 3)},{n(3)},{n(3)}", lambda: f"{n(1, 3)}.{n(3)}", lambda: n(1, 7), lambda: f"v{n(1)}.{n(1, 2)}.{n(1, 2)}",
        lambda: f"{n(1)}.{n(1, 2)}.{n(1, 2)}", lambda: f"{n(1)}.{n(1, 2)}.{n(1, 2)}-{pick(['rc', 'beta'])}{n(1)}", lambda: f"({n(1, 4)})", lambda: f"[{n(1, 3)}]",
        lambda: f"{pick(['INV', 'ID', 'PO', 'RFC'])}-{n(4)}-{n(3, 6)}", lambda: f"{pick(['No.', 'p.', 'S.', '#'])}{n(1, 4)}", lambda: f"ISBN-{n(3)}-{n(1)}-{n(5)}",
        lambda: " ".join(f"{word()}{mark}" for mark in [pick(["%%%", "&&&", "!!", "***", ",!!"])] for _ in range(int(random.integers(2, 25)))),
        lambda: " ".join(n(1, 4) for _ in range(int(random.integers(2, 4)))), lambda: "! ".join(word() for _ in range(3)) + "!!",
        lambda: word() + pick(["%%%", "&&&", "$$$", "***", "###", "!!", "...", ",!!", ".&&&", "?!"]), lambda: pick("|=-+/*<>&~\u2014"),
        lambda: f"{word()}-{word()}", lambda: f"{word()}'s", lambda: f"{word()}/{word()}", lambda: f"({word()})", lambda: f"\"{word()}\"", lambda: f"{word()}_{word()}",
        lambda: f"https://{name()}.{pick(top)}/{name()}?{name()}={n(1, 3)}", lambda: f"www.{name()}.{pick(top)}", lambda: f"@{name()}", lambda: f"#{name()}{n(0, 3)}",
        lambda: f"{name()}@", lambda: f"{name()}={n(1, 4)}", lambda: f"{name()}({n(1)})", lambda: f"{name()}[{n(1)}]", lambda: f"{name()}.{pick(['py', 'txt', 'html'])}",
        lambda: f"{n(1, 2)}{pick(['st', 'th', 'km', 'kg', 'x', 'MB'])}", lambda: f"{pick('ABC')}{n(1, 2)}", lambda: f"{n(1, 2)}.{n(4)},{n(1, 2)}.{n(4)}", lambda: f"0x{six()}",
        lambda: "".join(six() for _ in range(10)), lambda: ":".join(pick("0123456789abcdef") + pick("0123456789abcdef") for _ in range(6)),
        lambda: f"{n(5)}-{n(4)}", lambda: f"{n(1, 2)} {n(3)} {n(3)}", lambda: f"{n(4)} {n(4)}", lambda: f"{n(3)}-{n(4)}-{pick('XYZ')}{n(1)}", lambda: f"{n(1)}+{n(1)}={n(1, 2)}",
    )
    cues = {
        "phone": ["call", "phone", "tel", "Tel.:", "fax", "mobile:", "ruf", "llama"], "email": ["mail", "email:", "write", "contact"],
        "ip": ["host", "from", "ip", "address:", "server"], "card": ["card", "visa", "card:", "number"],
    }
    out: list[tuple[str, list[Span]]] = []
    while len(out) < size:
        text, found = "", []
        for _ in range(int(random.integers(1, 6))):
            text += "".join(word() + pick([" ", " ", " ", ", ", ". "]) for _ in range(int(random.integers(1, 5)) if random.random() < 0.5 else 0))
            if random.random() < 0.4:
                kind, make = pick(spans)
                text += pick(cues[kind]) + " " if random.random() < 0.4 else ""
                opening = pick(["", "", "", '"'])
                made = make()
                found.append((kind, len(text) + len(opening), len(text) + len(opening) + len(made)))
                text += opening + made + opening + pick(["", "", ".", ","]) + " "
            else:
                text += pick(others)() + pick(["", "", ".", ","]) + " "
        if set(base_spans(text)) <= set(found):
            out.append((text, found))
    return out


def labelled_runs(rows: list[tuple[str, list[Span]]], *, whole: bool = True) -> list[tuple[np.ndarray, np.ndarray, int]]:
    """The training table: distinct runs of words with the labels of the spans over them.

    ``whole``: all words outside the spans are none. Otherwise only the words of the spans count, the word before hidden.
    """
    table: dict[bytes, list] = {}
    hidden = int(_slots(np.zeros(1, np.uint64), FEATURES)[0])
    for text, spans in rows:
        data, bounds = text_buffers(pa.array([text]))
        runs = word_runs(data, bounds)
        label = np.zeros(len(runs.starts), np.int64)
        for kind, start, end in spans:
            a, b = len(text[:start].encode()), len(text[:end].encode())
            first, last = int(np.searchsorted(runs.ends, a, side="right")), int(np.searchsorted(runs.starts, b))
            label[first:last] = 2 * KINDS.index(kind) + 2
            label[first : min(first + 1, last)] -= 1
        cuts = runs.bounds
        if not whole:
            runs.slots[:, -1] = hidden
            cuts = np.union1d(cuts, np.flatnonzero((label[1:] % 2 == 1) | ((label[1:] == 0) & (label[:-1] > 0))) + 1)
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            if not whole and not label[a]:
                continue
            for c in range(a, b, TRAINING_WORDS):
                slots, truth = runs.slots[c : min(b, c + TRAINING_WORDS)], label[c : min(b, c + TRAINING_WORDS)]
                entry = table.setdefault(slots.tobytes() + truth.tobytes(), [slots, truth, 0])
                entry[2] += 1
    frequent = sorted(table.values(), key=lambda e: (-e[2], e[0].tobytes()))
    return [(slots, truth, min(times, 20)) for slots, truth, times in frequent[:TRAINING_RUNS]]


def fit(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text") -> Chain:
    """The chain, trained on the labelled table and a bounded sample of the texts with the smallest hashes."""
    prepare(docs.sparkSession)
    source = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text")).filter(F.length("text") <= SAMPLE_CHARS)
    marked = source.filter(F.col("text").rlike("[0-9@]"))
    texts = sorted(row.text for row in sample(marked, SAMPLE_ROWS, "id", "text").collect())
    known = labelled_runs([(text, base_spans(text)) for text in texts], whole=False)
    return train(labelled_runs(labelled_table(TABLE_ROWS, seed=17)) + known)


_MARKED = np.isin(np.arange(256), list(b"0123456789@"))


def personal_data(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_added) of every row.

    Counts and digest are of the base spans; ``spans`` has the chain's too, ``n_added`` their number.
    """
    chain = fit(docs, doc_id=doc_id, text=text)
    source = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    nothing = hashlib.sha256(b"").hexdigest()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in passes(batch):
                column = part.column(1)
                data, bounds = text_buffers(column)
                rows = part.num_rows
                found: dict[int, list[Span]] = {}
                closed: dict[int, list[Span]] = {}
                marked = np.concatenate(([0], np.cumsum(_MARKED[data]))) if len(data) else np.zeros(1, np.int64)
                for i in np.flatnonzero(marked[bounds[1:]] > marked[bounds[:-1]]):
                    dropped: list[Span] = []
                    found[int(i)] = base_spans(column[int(i)].as_py(), dropped)
                    closed[int(i)] = found[int(i)] + dropped
                added = chain_spans(chain, data, bounds, closed)
                counts = {kind: [sum(s[0] == kind for s in found.get(i, ())) for i in range(rows)] for kind in KINDS}
                digests = [hashlib.sha256(joined(found[i]).encode()).hexdigest() if found.get(i) else nothing for i in range(rows)]
                spans = [
                    joined(sorted(found.get(i, []) + added.get(i, []), key=lambda s: (KINDS.index(s[0]), s[1])))
                    if i in found or i in added else "" for i in range(rows)
                ]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), *(pa.array(c, pa.int64()) for c in counts.values()), pa.array(digests), pa.array(spans),
                     pa.array([len(added.get(i, ())) for i in range(rows)], pa.int64())],
                    names=["doc_id", *(f"n_{kind}" for kind in KINDS), "base_sha256", "spans", "n_added"],
                )

    out = "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_added long"
    return source.mapInArrow(run, out)


def chain_spans(chain: Chain, data: np.ndarray, bounds: np.ndarray, closed: dict[int, list[Span]]) -> dict[int, list[Span]]:
    """Spans of one kind in a run that touch no closed span, in code points."""
    runs = word_runs(data, bounds)
    if not len(runs.starts):
        return {}
    label = chain.decode(runs.slots, runs.bounds)
    kind = (label + 1) // 2
    new = label % 2 == 1
    new[runs.bounds[:-1]] = True
    new[1:] |= kind[1:] != kind[:-1]
    at = np.flatnonzero(new)
    end = np.append(at[1:], len(label)) - 1
    out: dict[int, list[Span]] = {}
    named = kind[at] > 0
    if not named.any():
        return out
    points, covered = code_points(data), {}
    for a, b in zip(at[named], end[named], strict=True):
        row = int(runs.row[a])
        first, last = int(runs.starts[a]), int(runs.ends[b])
        while last > first and _AFTER[data[last - 1]]:
            last -= 1
        while first < last and _QUOTES[data[first]]:
            first += 1
        start, stop = (int(points[place] - points[bounds[row]]) for place in (first, last))
        if row not in covered:
            covered[row] = Covered(closed.get(row, []))
        if start < stop and not covered[row](start, stop):
            out.setdefault(row, []).append((KINDS[kind[a] - 1], start, stop))
    return out
