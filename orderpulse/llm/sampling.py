"""Sampled segmentations of a SentencePiece vocabulary: forward filtering, backward sampling.

A text's lattice has an edge for every vocabulary piece at every place. A segmentation's probability is proportional
to the product of its pieces' weights, 1 / (2 + rank) ** sharpness, where a piece's rank is its place in the
vocabulary's order of merges. The forward pass sums the weights of all ways to each place; the backward pass draws
edges from the end of the text in proportion to them, which is an exact draw from all segmentations. Random numbers are
hashes of (seed, row key, word, step): a row's segmentation does not depend on partitions, order or other rows.

No piece goes on after a space that follows another character, so a text's lattice is a chain of words, each a run of
spaces and what follows. For a run of texts, the forward pass goes through their different words, and the backward pass
through all of their words, in lockstep; lattices are kept for words that come again. Spaces stand for themselves, characters without a piece are spelled in byte pieces, and one
space is put before a text and taken off again, so decoding gives back every text. Null texts are empty and have no
pieces; a null doc_id has the row key of -1.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from orderpulse.llm.common import id_and_text, mix64, pieces, record_batch, text_bytes

SHARPNESS = 1.0
KEPT_EDGES = 3_000_000
PIECE = 1 << 20  # bytes of text that are sampled at a time: lattices of new words take many times their size
_WORD = re.compile(rb" *[^ ]+| +")
_STEP, _PLACE = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


_PRIME = np.uint64(0xD6E8FEB86659FD93)
_ONE = 40  # probabilities are whole numbers of 2**-40, so that sums are exact
_SIEVE = np.uint64(64 - 17)


def _code(eights: list[np.ndarray]) -> np.ndarray:
    """A hash of byte strings that are given by eight bytes at a time."""
    code = eights[0] * _PRIME
    for x in eights[1:]:
        code = (code ^ x) * _PRIME
    return code


class Vocabulary:
    """Pieces as bytes, with spaces for the marker, and their log weights."""

    def __init__(self, path: str, sharpness: float):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.bytes: list[bytes] = []
        self.byte_ids = np.zeros(256, np.int32)
        ranked = []
        for i in range(model.get_piece_size()):
            text = model.id_to_piece(i)
            if model.is_byte(i):
                self.byte_ids[int(text[3:5], 16)] = i
                self.bytes.append(bytes([int(text[3:5], 16)]))
            elif model.is_control(i) or model.is_unknown(i) or model.is_unused(i):
                self.bytes.append(b"")
            else:
                self.bytes.append(text.replace("▁", " ").encode())
                ranked.append((-model.get_score(i), i))
        self.weight: dict[bytes, tuple[int, float]] = {}
        for rank, (_, i) in enumerate(sorted(ranked)):
            piece = self.bytes[i]
            if b" " in piece.lstrip(b" ") or len(piece) > 63:
                raise ValueError(f"a piece is longer than expected or goes on after an inner space: {piece!r}")
            self.weight.setdefault(piece, (i, float(-sharpness * np.log(2 + rank))))
        # For each length: a sieve and the codes of its pieces in order, their bytes by eight, ids and weights.
        self.lengths = {}
        for n in sorted({len(p) for p in self.weight}):
            pieces_n = [p for p in self.weight if len(p) == n]
            eights = [np.array([int.from_bytes(p[k : k + 8], "little") for p in pieces_n], np.uint64) for k in range(0, n, 8)]
            code = _code(eights)
            order = np.argsort(code)
            sieve = np.zeros(1 << 17, bool)
            sieve[code >> _SIEVE] = True
            ids = np.array([self.weight[p][0] for p in pieces_n], np.int32)[order]
            weights = np.array([self.weight[p][1] for p in pieces_n])[order]
            self.lengths[n] = (sieve, code[order], [x[order] for x in eights], ids, weights)

    def decode(self, ids: list[int]) -> str:
        return b"".join([self.bytes[i] for i in ids])[1:].decode()


class Lattice:
    """The forward pass over the lattices of given words. A node stands after each byte, in order of its place in a word.

    until, piece, source: the edges in order of the node they lead into. An edge's `until` is its node and, in the low
    bits, the probability of it and the edges before it, so one search finds a draw; a source of -1 is a word's start."""

    def __init__(self, vocabulary: Vocabulary, words: list[bytes]):
        data = np.frombuffer(b"".join(words), np.uint8)
        sizes = np.array([len(w) for w in words], np.int64)
        first = np.repeat(np.cumsum(sizes) - sizes, sizes)
        depth = np.arange(len(data)) - first
        deepest = int(sizes.max(initial=0))
        name = np.empty(len(data) + 1, np.int64)
        name[np.argsort(depth.astype(np.uint16) if deepest < 1 << 16 else depth, kind="stable")] = np.arange(len(data))
        self.last = name[np.cumsum(sizes) - 1]
        start, end, piece, weight = self._edges(vocabulary, data, first)
        order = np.argsort(name[end] << 6 | (end - start))  # no two edges have the same key
        start, node, piece, weight = start[order], name[end[order]], piece[order], weight[order]
        source = np.where(start == first[start], -1, name[start - 1])
        total, value = np.zeros(len(data) + 1), np.zeros(len(node))  # total[-1] is a word's start
        heads = np.flatnonzero(np.r_[True, node[1:] != node[:-1]]) if len(node) else node
        spread = np.diff(np.r_[heads, len(node)])
        cuts = np.searchsorted(node, np.r_[0, np.cumsum(np.bincount(depth, minlength=deepest))]).tolist()
        head_cuts = np.searchsorted(heads, cuts).tolist()
        for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
            if a == b:
                continue
            own = slice(head_cuts[k], head_cuts[k + 1])
            value[a:b] = total[source[a:b]] + weight[a:b]
            top = np.maximum.reduceat(value[a:b], heads[own] - a)
            summed = np.add.reduceat(np.exp(value[a:b] - np.repeat(top, spread[own])), heads[own] - a)
            total[node[heads[own]]] = top + np.log(summed)
        share = np.cumsum(np.rint(np.exp(value - total[node]) * (1 << _ONE)).astype(np.int64))
        share -= np.repeat(np.r_[0, share][heads], spread)
        share = np.minimum(share, 1 << _ONE)
        share[heads + spread - 1] = 1 << _ONE
        self.until = (node << _ONE) + share
        self.piece, self.source = piece, source

    @staticmethod
    def _edges(vocabulary: Vocabulary, data: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, ...]:
        """Start, node, piece and weight of every edge."""
        padded = np.concatenate([data, np.zeros(80, np.uint8)])
        eight = np.lib.stride_tricks.as_strided(padded[:8].view(np.uint64), (len(data) + 72,), (1,), writeable=False).copy()
        begins = np.flatnonzero((data & 0xC0) != 0x80).astype(np.int32)
        left = np.flatnonzero(np.r_[first[1:] != first[:-1], True])  # last byte of each word
        left = (np.repeat(left, np.diff(np.r_[-1, left]))[begins] - begins + 1).astype(np.int32) if len(data) else begins
        width = 1 + (data[begins] >= 0xC0) + (data[begins] >= 0xE0) + (data[begins] >= 0xF0).astype(np.int64)
        spelled = np.ones(len(data), bool)  # characters without a piece of their own
        alone = np.zeros(len(data), np.int64)
        alone[begins] = width
        found = []
        for n, (sieve, codes, known, ids, weights) in vocabulary.lengths.items():
            begins, left = begins[left >= n], left[left >= n]
            own = [eight[begins + k] & np.uint64((1 << 8 * min(8, n - k)) - 1) for k in range(0, n, 8)]
            code = _code(own)
            hit = np.flatnonzero(sieve[code >> _SIEVE])
            place = np.minimum(np.searchsorted(codes, code[hit]), len(codes) - 1)
            same = codes[place] == code[hit]
            for x, y in zip(known, own):
                same &= x[place] == y[hit]
            at, place = begins[hit[same]], place[same]
            found.append((at, at + np.int32(n - 1), ids[place], weights[place]))
            spelled[at[alone[at] == n]] = False
        for k in range(4):
            at = (np.flatnonzero(spelled & (alone > k)) + k).astype(np.int32)
            found.append((at, at, vocabulary.byte_ids[data[at]], np.zeros(len(at))))
        return tuple(np.concatenate(x) for x in zip(*found))


def appended(held: np.ndarray, n: int, new: np.ndarray) -> np.ndarray:
    """`held`, of which n values are in use, with the new ones after them; it grows by a quarter when it is full."""
    if n + len(new) > len(held):
        larger = np.empty(n + len(new) + len(held) // 4, held.dtype)
        larger[:n] = held[:n]
        held = larger
    held[n : n + len(new)] = new
    return held


class Sampler:
    """Draws segmentations; the lattices of words met before are kept, up to a number of edges."""

    def __init__(self, vocabulary: Vocabulary, kept_edges: int = KEPT_EDGES):
        self.vocabulary, self.kept_edges = vocabulary, kept_edges
        self.forget()

    def forget(self) -> None:
        self.last: dict[bytes, int] = {}  # a word's end node
        self.nodes = self.edges = 0
        self.held = np.zeros(0, np.int64), np.zeros(0, np.int32), np.zeros(0, np.int64)
        self.until, self.piece, self.source = self.held

    def learn(self, words: list[bytes]) -> None:
        new = Lattice(self.vocabulary, words)
        found = new.until + (self.nodes << _ONE), new.piece, np.where(new.source < 0, -1, new.source + self.nodes)
        self.held = tuple(appended(x, self.edges, y) for x, y in zip(self.held, found))
        self.edges += len(new.until)
        self.until, self.piece, self.source = (x[: self.edges] for x in self.held)
        self.last.update(zip(words, (new.last + self.nodes).tolist()))
        self.nodes += sum(map(len, words))

    def sample(self, texts: list[bytes], keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row, and how many each has."""
        if self.edges > self.kept_edges:
            self.forget()
        words = [_WORD.findall(b" " + t) if t else [] for t in texts]
        if new := list(set().union(*words) - self.last.keys()):
            self.learn(new)
        counts = np.array([len(ws) for ws in words], np.int64)
        which = np.fromiter(map(self.last.__getitem__, chain.from_iterable(words)), np.int64, int(counts.sum()))
        text = np.repeat(np.arange(len(texts)), counts)
        nth = np.arange(len(which)) - np.repeat(np.cumsum(counts) - counts, counts)
        base = mix64(keys[text] ^ mix64(nth.astype(np.uint64) * _PLACE + np.uint64(1)))
        live = np.argsort(which)  # equal words together, which makes the searches fast
        node, base, drawn, owners = which[live], base[live], [], []
        while len(live):
            base = base + _STEP
            chance = (mix64(base) >> np.uint64(64 - _ONE)).astype(np.int64)
            edge = np.searchsorted(self.until, (node << _ONE) + chance, side="right")
            drawn.append(self.piece[edge])
            owners.append(live)
            node = self.source[edge]
            on = node >= 0
            live, node, base = live[on], node[on], base[on]
        size = np.zeros(len(which), np.int64)
        for live in owners:
            size[live] += 1
        ends = np.cumsum(size)
        out = np.zeros(int(size.sum()), np.int32)
        for step, (live, ids) in enumerate(zip(owners, drawn)):
            out[ends[live] - 1 - step] = ids  # drawn from the end of a word
        return out, np.bincount(text, weights=size, minlength=len(texts)).astype(np.int64)


@lru_cache(2)
def sampler(path: str, sharpness: float) -> Sampler:
    return Sampler(Vocabulary(path, sharpness))


def row_keys(doc_ids: pa.Array, seed: int) -> np.ndarray:
    ids = np.array([-1 if i is None else i for i in doc_ids.to_pylist()], np.int64).view(np.uint64)
    return mix64(ids * _STEP + mix64(np.array([seed], np.uint64)))


def sample_pieces(docs: DataFrame, path: str, seed: int = 42, sharpness: float = SHARPNESS) -> DataFrame:
    """(doc_id, n_pieces, ids, lossless): a drawn segmentation of each row, and whether it decodes to the text."""
    schema = pa.schema(
        [("doc_id", pa.int64()), ("n_pieces", pa.int64()), ("ids", pa.list_(pa.int32())), ("lossless", pa.bool_())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = sampler(path, sharpness)
        spelled = known.vocabulary.bytes
        for batch in batches:
            for part in pieces(batch, size=PIECE):
                texts = text_bytes(part["text"])
                ids, counts = known.sample(texts, row_keys(part["doc_id"], seed))
                offsets = np.r_[0, np.cumsum(counts)]
                listed = ids.tolist()
                same = [
                    b"".join([spelled[i] for i in listed[a:b]])[1:] == t
                    for t, a, b in zip(texts, offsets.tolist(), offsets[1:].tolist())
                ]
                lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(ids, pa.int32()))
                yield record_batch(schema, [part["doc_id"], counts, lists, same])

    return id_and_text(docs).mapInArrow(run, "doc_id long, n_pieces long, ids array<int>, lossless boolean")


def decoded(rows: DataFrame, path: str, sharpness: float = SHARPNESS) -> DataFrame:
    """(doc_id, text) from doc_id and ids."""
    schema = pa.schema([("doc_id", pa.int64()), ("text", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decode = sampler(path, sharpness).vocabulary.decode
        for batch in batches:
            yield record_batch(schema, [batch["doc_id"], [decode(x or []) for x in batch["ids"].to_pylist()]])

    return rows.select("doc_id", "ids").mapInArrow(run, "doc_id long, text string")
