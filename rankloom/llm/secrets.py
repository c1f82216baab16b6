"""Secret scanning: written forms, and a character network over every other candidate.

Three kinds have a written form that is always reported (``base``): assign, access, hex. Every other run
of key characters that is long enough and mixes letters and digits is a candidate. A
convolutional network reads all its characters and those around it: embedding (other symbols inside the candidate than
around it), one convolution, the greatest response of each filter over the whole length, one dense unit.

It is trained on labelled findings of two sources. A labelled table is written here from a seed: keys that no form covers
(prefixed, encoded, in addresses, in groups) and look-alikes (names of hosts and files, versions, dates, ids). And
what the written forms find in a bounded sample counts as a secret, its keyword hidden; candidates that no form covers
are not labelled, so they teach nothing. The output is calibrated on held-out findings, and the threshold is the greatest that
still recalls ``RECALL`` of the held-out positives; ``precision`` is what that costs there. Candidates at or over it are
added as kind ``other``.

Defined results: null counts as empty and has no span; a repeated row is scanned each time; without a written
form in the sample the table alone teaches. An empty table gives an empty result.
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

from rankloom.llm.textbatch import Covered, code_points, passes, prepare, sample, spread, text_buffers

KINDS = ("assign", "access", "hex", "other")
#: Documents with a sign that secrets have, from which findings are taken, at most; and their longest text.
SAMPLE_ROWS = 4_000
SAMPLE_CHARS = 200_000
#: Findings of the sample at most, and rows of the labelled table per label.
FINDINGS = 2_000
TABLE_ROWS = 2_000
LEAST_RUN = 12
RECALL = 0.99
EMBED, WIDTH, FILTERS, STEPS, BATCH = 8, 5, 24, 1_200, 64
#: Characters read on either side of a candidate; characters of a tile and between the starts of two.
AROUND, TILE = 24, 72
STRIDE = TILE - WIDTH + 1
#: Tiles that go through the network at once.
TILES = 256

_ASSIGN = re.compile(
    r"(?i:(password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.ASCII
)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{32,}")
Span = tuple[str, int, int]


def base_spans(text: str) -> list[Span]:
    """Spans of the written forms, by start, then kind."""
    spans = [("assign", m.start(), m.end()) for m in _ASSIGN.finditer(text) if len(m.group(2)) >= 8]
    spans += [("access", m.start(), m.end()) for m in _ACCESS.finditer(text) if len(m.group()) >= 16]
    spans += [("hex", m.start(), m.end()) for m in _HEX.finditer(text)]
    return sorted(spans, key=_place)


def _place(span: Span) -> tuple[int, int]:
    return span[1], KINDS.index(span[0])


def joined(spans: list[Span]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end in spans)


def _mask(members: bytes) -> np.ndarray:
    return np.isin(np.arange(256), list(members))


_DIGITS, _HEXES = b"0123456789", b"0123456789abcdef"
_LETTERS = bytes(range(65, 91)) + bytes(range(97, 123))
_KEY = _mask(_DIGITS + _LETTERS + b"+/_.=-")
_IS_DIGIT, _IS_LETTER, _IS_HEX = _mask(_DIGITS), _mask(_LETTERS), _mask(_HEXES)
_SIGN = _mask(b":=")


def _runs(mask: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the stretches of ``mask`` within the rows."""
    cut = np.zeros(len(mask) + 1, bool)
    cut[bounds] = True
    before, after = np.zeros(len(mask), bool), np.zeros(len(mask), bool)
    before[1:], after[:-1] = mask[:-1], mask[1:]
    return np.flatnonzero(mask & (~before | cut[:-1])), np.flatnonzero(mask & (~after | cut[1:])) + 1


def candidates(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, start and end (bytes) of every run of key characters with letters and digits."""
    starts, ends = _runs(_KEY[data], bounds)
    long = ends - starts >= LEAST_RUN
    starts, ends = starts[long], ends[long]
    digits = np.concatenate(([0], np.cumsum(_IS_DIGIT[data])))
    letters = np.concatenate(([0], np.cumsum(_IS_LETTER[data])))
    mixed = (digits[ends] > digits[starts]) & (letters[ends] > letters[starts])
    starts, ends = starts[mixed], ends[mixed]
    return np.searchsorted(bounds, starts, side="right") - 1, starts, ends


def suspects(data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Rows that may hold a written form: an assignment sign, an access prefix or a long hex run."""
    row = spread(bounds)
    hit = np.zeros(len(bounds) - 1, bool)
    hit[row[_SIGN[data]]] = True
    starts, ends = _runs(_IS_HEX[data], bounds)
    hit[row[starts[ends - starts >= 32]]] = True
    found = np.flatnonzero((data[:-3] == 65) & (data[1:-2] == 75) & (data[2:-1] == 73) & (data[3:] == 65)) if len(data) > 3 else []
    hit[row[found]] = True
    return np.flatnonzero(hit)


class Findings:
    """Candidates as tiles that together hold every stretch of ``WIDTH`` characters of them and their surroundings.

    Symbols: 0 outside the row or hidden, 1 to 128 around the candidate, 129 to 256 inside it.
    """

    def __init__(
        self, data: np.ndarray, bounds: np.ndarray, row: np.ndarray, starts: np.ndarray, ends: np.ndarray, hidden: np.ndarray | None = None
    ) -> None:
        self.symbols = np.clip(data, 1, 128)
        if hidden is not None:
            self.symbols = np.where(hidden, 0, self.symbols)
        self.starts, self.ends = starts, ends
        self.low, self.high = np.maximum(bounds[row], starts - AROUND), np.minimum(bounds[row + 1], ends + AROUND)
        count = np.maximum(0, -(-(ends - starts + 2 * AROUND - TILE) // STRIDE)) + 1
        self.first = np.concatenate(([0], np.cumsum(count)))

    def __len__(self) -> int:
        return len(self.starts)

    def tiles(self, of: np.ndarray) -> np.ndarray:
        """The symbols of the tiles with these numbers (n x TILE)."""
        owner = np.searchsorted(self.first, of, side="right") - 1
        at = (self.starts[owner] - AROUND + (of - self.first[owner]) * STRIDE)[:, None] + np.arange(TILE)[None]
        held = (at >= self.low[owner][:, None]) & (at < self.high[owner][:, None])
        symbol = self.symbols[np.clip(at, 0, len(self.symbols) - 1)].astype(np.int64)
        inside = (at >= self.starts[owner][:, None]) & (at < self.ends[owner][:, None])
        return np.where(held, symbol + np.where(inside & (symbol > 0), 128, 0), 0)


@dataclass
class Network:
    """Parameters of the network, scale and shift of the calibration, and the threshold."""

    embed: np.ndarray
    filters: np.ndarray
    bias: np.ndarray
    dense: np.ndarray
    base: float
    scale: float = 1.0
    shift: float = 0.0
    threshold: float = 2.0
    precision: float = 0.0

    def _forward(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Inputs of every place of every tile, the place and the value of each filter's greatest response."""
        seen = self.embed[x]
        spans = np.lib.stride_tricks.sliding_window_view(seen, WIDTH, axis=1)
        flat = spans.transpose(0, 1, 3, 2).reshape(len(x), spans.shape[1], WIDTH * EMBED)
        response = flat @ self.filters + self.bias
        top = response.argmax(1)
        return flat, top, np.take_along_axis(response, top[:, None], 1)[:, 0]

    def raw(self, found: Findings) -> np.ndarray:
        greatest = np.full((len(found), FILTERS), -np.inf)
        for at in range(0, int(found.first[-1]), TILES):
            of = np.arange(at, min(at + TILES, int(found.first[-1])))
            owner = np.searchsorted(found.first, of, side="right") - 1
            np.maximum.at(greatest, owner, self._forward(found.tiles(of))[2])
        return np.maximum(greatest, 0) @ self.dense + self.base

    def probability(self, found: Findings) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.scale * self.raw(found) + self.shift, -500, 500)))


def train(found: Findings, y: np.ndarray, seed: int = 5) -> Network:
    """Fit on two thirds of the findings, calibrate and choose the threshold on the rest."""
    random = np.random.default_rng(seed)
    net = Network(
        random.normal(0, 0.3, (257, EMBED)), random.normal(0, 0.2, (WIDTH * EMBED, FILTERS)), np.zeros(FILTERS),
        random.normal(0, 0.3, FILTERS), 0.0,
    )
    net.embed[129:] = net.embed[1:129] + random.normal(0, 0.05, (128, EMBED))
    kept = np.arange(len(y)) % 3 == 2
    if len(set(y[kept])) < 2 or len(set(y[~kept])) < 2:
        return net
    names = ("embed", "filters", "bias", "dense")
    memory = {name: np.zeros_like(getattr(net, name)) for name in names}
    fit, share = np.flatnonzero(~kept), y[~kept].mean()
    for _ in range(STEPS):
        at = random.choice(fit, BATCH)
        count = found.first[at + 1] - found.first[at]
        begin = np.cumsum(count) - count
        x = found.tiles(np.repeat(found.first[at] - begin, count) + np.arange(count.sum()))
        flat, top, best = net._forward(x)
        greatest = np.maximum.reduceat(best, begin)
        tile = np.where(best == np.repeat(greatest, count, axis=0), np.arange(len(x))[:, None], len(x))
        tile = np.minimum.reduceat(tile, begin)  # finding x filter: the tile of the maximum
        pooled = np.maximum(greatest, 0)
        weight = np.where(y[at] > 0, 0.5 / share, 0.5 / (1 - share))
        error = (1 / (1 + np.exp(-np.clip(pooled @ net.dense + net.base, -30, 30))) - y[at]) * weight / len(at)
        slope = {"dense": pooled.T @ error}
        inner = error[:, None] * net.dense * (pooled > 0)
        place = np.take_along_axis(top, tile, 0)
        slope["filters"] = np.einsum("nf,nfi->if", inner, flat[tile, place])
        slope["bias"] = inner.sum(0)
        back = (inner[:, :, None] * net.filters.T[None]).reshape(len(at), FILTERS, WIDTH, EMBED)
        slope["embed"] = np.zeros_like(net.embed)
        np.add.at(slope["embed"], x[tile[:, :, None], place[:, :, None] + np.arange(WIDTH)], back)
        net.base -= 0.1 * error.sum()
        for name in names:
            memory[name] = 0.95 * memory[name] + 0.05 * slope[name] ** 2
            getattr(net, name)[...] -= 0.01 * slope[name] / (np.sqrt(memory[name]) + 1e-6)
    raw = net.raw(found)
    _calibrate(net, raw[kept], y[kept])
    return net


def _calibrate(net: Network, raw: np.ndarray, y: np.ndarray) -> None:
    """Logistic scale and shift (bounded-curvature steps, which never overshoot), then the threshold."""
    spread_of = raw.std() + 1e-9
    design = np.column_stack((raw / spread_of, np.ones(len(raw))))
    goal = np.where(y == 1, (y.sum() + 1) / (y.sum() + 2), 1 / (len(y) - y.sum() + 2))
    step = np.linalg.inv(design.T @ design / 4 + 1e-6 * np.eye(2)) @ design.T
    w = np.zeros(2)
    for _ in range(300):
        w += step @ (goal - 1 / (1 + np.exp(-design @ w)))
    net.scale, net.shift = float(w[0] / spread_of), float(w[1])
    chance = 1 / (1 + np.exp(-np.clip(net.scale * raw + net.shift, -500, 500)))
    positive = np.sort(chance[y == 1])
    net.threshold = float(positive[int((1 - RECALL) * len(positive))])
    net.precision = float(y[chance >= net.threshold].mean())


def labelled_table(size: int, seed: int) -> list[tuple[str, int, int, int]]:
    """Rows (text, start, end, label) of the labelled table, both labels in turn."""
    random = np.random.default_rng(seed)
    lower, upper, digits = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"

    def pick(options):
        return options[int(random.integers(len(options)))]

    def some(signs: str, low: int, high: int) -> str:
        return "".join(pick(signs) for _ in range(int(random.integers(low, high + 1))))

    def word() -> str:
        made = "".join(pick("bcdfghlmnprstvw") + pick("aeiou") + pick(["", "", "n", "r", "s"]) for _ in range(int(random.integers(1, 4))))
        return made if random.random() < 0.8 else made.capitalize()

    def name() -> str:
        return pick(["-", "_", "."]).join(word() for _ in range(int(random.integers(1, 4))))

    def number(low: int = 1, high: int = 4) -> str:
        return some(digits, low, high)

    mixed = lower + upper + digits
    secrets = (
        lambda: some(mixed, 14, 64),
        lambda: f"{some(lower, 2, 5)}{pick('_-')}{some(mixed, 20, 44)}",
        lambda: f"{some(lower, 2, 4)}_{pick(['live', 'test', 'prod'])}_{some(mixed, 16, 40)}",
        lambda: some(mixed + "+/", 22, 86) + pick(["", "=", "=="]),
        lambda: ".".join(some(mixed + "-_", 14, 50) for _ in range(3)),
        lambda: "-".join(some(upper + digits, 5, 5) for _ in range(5)),
        lambda: some("ABCDEF" + digits, 32, 64),
        lambda: f"{pick(['sig', 'key', 'auth', 'code', 'sid'])}={some(mixed, 18, 48)}",
        lambda: some(lower + digits, 20, 40),
    )
    others = (
        lambda: f"{name()}.{number()}",
        lambda: f"mail{number()}.{pick(['example', word()])}.{pick(['com', 'org', 'net'])}",
        lambda: f"{name()}{number()}.{word()}.{pick(['com', 'org', 'local'])}",
        lambda: "/".join(pick([word, name, number])() for _ in range(int(random.integers(2, 6)))) + pick(["", ".html", ".jpg", ".txt"]),
        lambda: f"{name()}-{number(1, 2)}.{number(1, 2)}.{number(1, 2)}{pick(['', '-rc1', '-beta2', '.tar.gz'])}",
        lambda: f"{number(4, 4)}-{number(2, 2)}-{number(2, 2)}T{number(2, 2)}",
        lambda: f"{number(1, 2)}-{word()}-{number(4, 4)}",
        lambda: f"{some(upper, 2, 5)}-{number(4, 4)}-{number(3, 8)}",
        lambda: "_".join(word() for _ in range(int(random.integers(2, 6)))) + f"_{number()}",
        lambda: f"{pick(['chapter', 'section', 'part', word()])}{number()}-of-{name()}-{number()}",
        lambda: "-".join(some("abcdef" + digits, n, n) for n in (8, 4, 4, 4, 12)),
        lambda: f"{pick('abxyz')}={number()}.{number()}+{pick('abxyz')}/{number()}",
        lambda: f"{pick(['id', 'page', 'size', 'name', 'date'])}={name()}{number(2, 6)}",
        lambda: some(lower + digits, 1, 3) * int(random.integers(4, 9)),
        lambda: word() * 3 + number(),
    )
    cues = ("", "", "", "key ", "Bearer ", "pwd ", "credentials: ", "use ", '"auth": "', "login with ", "signed ", "(", "see ", "file ")
    out: list[tuple[str, int, int, int]] = []
    while len(out) < size:
        label = len(out) % 2
        made = pick(secrets if label else others)()
        before = " ".join(word() for _ in range(int(random.integers(0, 7))))
        after = " ".join(word() for _ in range(int(random.integers(0, 7))))
        opening, closing = (" ", " ") if label or random.random() < 0.8 else pick([("@", " "), (" ", "@"), ("?", " "), ("#", " ")])
        text = f"{before}{opening}{pick(cues) if opening == ' ' else ''}"
        start = len(text)
        text += f"{made}{closing}{after}"
        row, starts, ends = candidates(*text_buffers(pa.array([text])))
        if not base_spans(text) and ((starts == start) & (ends == start + len(made))).any():
            out.append((text, start, start + len(made), label))
    return out


def findings(texts: list[str], table: list[tuple[str, int, int, int]]) -> tuple[Findings, np.ndarray]:
    """The rows of the labelled table and at most ``FINDINGS`` of what the written forms find in the texts, keywords hidden."""
    rows: dict[str, tuple[str, int, int, int, int]] = {}
    for text in texts:
        for pattern in (_ASSIGN, _ACCESS, _HEX):
            for match in pattern.finditer(text):
                value = match.span(2) if pattern is _ASSIGN else match.span()
                made = text[slice(*value)]
                if len(made) >= 16 and len(rows) < FINDINGS and any(c in "0123456789" for c in made) and any(c.isalpha() for c in made):
                    low, high = max(0, match.start() - AROUND), value[1] + AROUND
                    rows.setdefault(made, (text[low:high], value[0] - low, value[1] - low, 1, match.start() - low))
    every = [*(entry + (entry[1],) for entry in table), *rows.values()]
    every = [every[i] for i in np.random.default_rng(3).permutation(len(every))]
    data, bounds = text_buffers(pa.array([entry[0] for entry in every], pa.large_string()))
    hidden = np.zeros(len(data), bool)
    starts, ends = np.zeros(len(every), np.int64), np.zeros(len(every), np.int64)
    for i, (text, start, end, _, cue) in enumerate(every):
        starts[i], ends[i] = (bounds[i] + len(text[:place].encode()) for place in (start, end))
        hidden[bounds[i] + len(text[:cue].encode()) : starts[i]] = True
    return Findings(data, bounds, np.arange(len(every)), starts, ends, hidden), np.array([entry[3] for entry in every])


def fit(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text") -> Network:
    prepare(docs.sparkSession)
    source = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text")).filter(F.length("text") <= SAMPLE_CHARS)
    marked = source.filter(F.col("text").rlike("=|AKIA|[0-9a-f]{32}"))
    texts = sorted(row.text for row in sample(marked, SAMPLE_ROWS, "id", "text").collect())
    return train(*findings(texts, labelled_table(2 * TABLE_ROWS, seed=17)))


def secret_spans(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_added) of every row.

    Counts and digest are of the base spans; ``spans`` has the network's too, ``n_added`` their number.
    """
    net = fit(docs, doc_id=doc_id, text=text)
    source = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    nothing = hashlib.sha256(b"").hexdigest()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in passes(batch):
                column, rows = part.column(1), part.num_rows
                data, bounds = text_buffers(column)
                found = {int(i): base_spans(column[int(i)].as_py()) for i in suspects(data, bounds)}
                every = {i: sorted(found.get(i, []) + more, key=_place) for i, more in _added(net, data, bounds, found).items()}
                counts = [[sum(s[0] == kind for s in found.get(i, ())) for i in range(rows)] for kind in KINDS[:3]]
                digests = [hashlib.sha256(joined(found[i]).encode()).hexdigest() if found.get(i) else nothing for i in range(rows)]
                spans = [joined(every.get(i, found.get(i, []))) for i in range(rows)]
                more = [len(every[i]) - len(found.get(i, ())) if i in every else 0 for i in range(rows)]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), *(pa.array(c, pa.int64()) for c in counts), pa.array(digests), pa.array(spans), pa.array(more, pa.int64())],
                    names=["doc_id", *(f"n_{kind}" for kind in KINDS[:3]), "base_sha256", "spans", "n_added"],
                )

    out = "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_added long"
    return source.mapInArrow(run, out)


def _added(net: Network, data: np.ndarray, bounds: np.ndarray, base: dict[int, list[Span]]) -> dict[int, list[Span]]:
    """Candidates at or over the threshold that touch no base span, in code points."""
    row, starts, ends = candidates(data, bounds)
    out: dict[int, list[Span]] = {}
    if not len(row):
        return out
    hit = np.flatnonzero(net.probability(Findings(data, bounds, row, starts, ends)) >= net.threshold)
    if not len(hit):
        return out
    points = code_points(data)
    for r in np.unique(row[hit]):
        covered = Covered(base.get(int(r), []))
        for i in hit[np.searchsorted(row[hit], r) : np.searchsorted(row[hit], r, side="right")]:
            begin = int(points[starts[i]] - points[bounds[r]])
            end = begin + int(ends[i] - starts[i])
            if not covered(begin, end):
                out.setdefault(int(r), []).append(("other", begin, end))
    return out
