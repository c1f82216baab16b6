"""Word-piece token counts by a linear longest-match automaton.

Greedy longest match splits a word, marked at its start, into the longest pieces of the vocabulary from
left to right; a word that cannot be split is one unknown token. The vocabulary is a trie over bytes.
A node's failure link leads to where the search stands after the pieces that its string must give up
are popped, and the number of these pieces is precomputed; so a word's length in pieces needs one
pass over its bytes and no piece is ever built.

Each pass over a batch runs the automaton once per distinct word, all words in step.

Defined results: null and empty texts have no words and no tokens; a repeated row is counted each
time; rows without id are counted too. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankloom.llm.textbatch import passes, prepare, span_hashes, text_buffers, word_spans

WORD_START = "▁"
#: With fewer words still running, they go on one by one.
FEW_LANES = 16


@dataclass
class Automaton:
    """Edges sorted by node * 256 + byte; failure link (-1: none) and popped pieces of each node."""

    edge: np.ndarray
    target: np.ndarray
    fail: np.ndarray
    popped: np.ndarray

    def step(self, node: np.ndarray, byte: np.ndarray) -> np.ndarray:
        """Children, or -1."""
        key = node * 256 + byte
        at = np.minimum(np.searchsorted(self.edge, key), len(self.edge) - 1)
        return np.where(self.edge[at] == key, self.target[at], -1) if len(self.edge) else np.full(len(node), -1)

    def pieces(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray, mark: bytes) -> np.ndarray:
        """Pieces of each word ``mark + data[start:end]``; 0 where it cannot be split."""
        count = np.zeros(len(starts), np.int64)
        order = np.argsort(starts - ends, kind="stable")  # longest first: the running ones are a prefix
        length = (ends - starts)[order] + len(mark)
        begin = starts[order]
        node, found = np.zeros(len(order), np.int64), np.zeros(len(order), np.int64)
        for t in range(int(length[0]) if len(length) else 0):
            running = int(np.searchsorted(-length, -t, side="left"))
            if running <= FEW_LANES and t >= len(mark):
                for lane in range(running):
                    node[lane], found[lane] = self._alone(node[lane], found[lane], data[begin[lane] + t - len(mark) : begin[lane] + length[lane] - len(mark)])
                break
            byte = np.full(running, mark[t]) if t < len(mark) else data[begin[:running] + t - len(mark)].astype(np.int64)
            self._advance(node, found, byte, running)
        # give up what is left
        while (left := np.flatnonzero(node > 0)).size:
            found[left] += self.popped[node[left]]
            node[left] = self.fail[node[left]]
        count[order] = np.where(node == 0, found, 0)
        return count

    def _advance(self, node: np.ndarray, found: np.ndarray, byte: np.ndarray, running: int) -> None:
        lanes = np.flatnonzero(node[:running] >= 0)
        while lanes.size:
            to = self.step(node[lanes], byte[lanes])
            ok = to >= 0
            node[lanes[ok]] = to[ok]
            lanes = lanes[~ok]
            found[lanes] += self.popped[node[lanes]]
            node[lanes] = self.fail[node[lanes]]
            lanes = lanes[node[lanes] >= 0]

    def _alone(self, node: int, found: int, rest: np.ndarray) -> tuple[int, int]:
        edges = self.__dict__.setdefault("_edges", dict(zip(self.edge.tolist(), self.target.tolist(), strict=True)))
        fail, popped = self.fail, self.popped
        node, found = int(node), int(found)
        for byte in rest.tolist():
            while node >= 0 and (to := edges.get(node * 256 + byte)) is None:
                found += int(popped[node])
                node = int(fail[node])
            if node < 0:
                break
            node = to
        return node, found


def build(pieces: Iterable[str]) -> Automaton:
    """The automaton of a vocabulary; links are found level by level."""
    edges: dict[int, int] = {}
    ends: set[int] = set()
    parent, byte_in = [0], [0]
    for piece in pieces:
        node = 0
        for byte in piece.encode():
            key = node * 256 + byte
            if key not in edges:
                edges[key] = len(parent)
                parent.append(node)
                byte_in.append(byte)
            node = edges[key]
        if node:
            ends.add(node)
    fail, popped = [-1] * len(parent), [0] * len(parent)
    depth = [0] * len(parent)
    for node in range(1, len(parent)):  # a parent is made before its children
        depth[node] = depth[parent[node]] + 1
    for node in sorted(range(1, len(parent)), key=depth.__getitem__):
        if node in ends:
            fail[node], popped[node] = 0, 1
            continue
        stand, pops, byte = fail[parent[node]], popped[parent[node]], byte_in[node]
        while stand >= 0 and stand * 256 + byte not in edges:
            pops += popped[stand]
            stand = fail[stand]
        if stand >= 0:
            fail[node], popped[node] = edges[stand * 256 + byte], pops
    key = np.array(sorted(edges), np.int64)
    return Automaton(key, np.array([edges[k] for k in key.tolist()], np.int64), np.array(fail, np.int64), np.array(popped, np.int64))


def sentencepiece_pieces(model: str) -> list[str]:
    """The ordinary pieces of a model file; control, unknown and single-byte entries are left out."""
    import sentencepiece

    reader = sentencepiece.SentencePieceProcessor(model_proto=Path(model).read_bytes())
    return [
        reader.id_to_piece(i) for i in range(reader.get_piece_size())
        if not (reader.is_control(i) or reader.is_unknown(i) or reader.is_byte(i) or reader.is_unused(i))
    ]


def token_counts(docs: DataFrame, pieces: Iterable[str], *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_words, n_unknown, n_tokens) of every row."""
    prepare(docs.sparkSession)
    automaton, mark = build(pieces), WORD_START.encode()
    source = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in passes(batch):
                data, bounds = text_buffers(part.column(1))
                starts, ends, first = word_spans(data, bounds)
                _, example, inverse = np.unique(span_hashes(data, starts, ends), return_index=True, return_inverse=True)
                found = automaton.pieces(data, starts[example], ends[example], mark)[inverse]
                sums = [np.concatenate(([0], np.cumsum(v)))[first] for v in (found == 0, np.maximum(found, 1))]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(np.diff(first)), *(pa.array(np.diff(s)) for s in sums)],
                    names=["doc_id", "n_words", "n_unknown", "n_tokens"],
                )

    return source.mapInArrow(run, "doc_id long, n_words long, n_unknown long, n_tokens long")
