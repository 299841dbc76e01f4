"""Canonical, length-limited Huffman codes over integer symbols, with bit-offset checkpoints.

A payload is a run of codes, most significant bit first, filled up to a whole byte. Every BLOCK symbols its bits are
counted; these checkpoints let all blocks be decoded independently, here in lockstep through one lookup table.
"""

from __future__ import annotations

import numpy as np

BLOCK = 64
MAX_LENGTH = 18


def code_lengths(counts: np.ndarray, limit: int = MAX_LENGTH) -> np.ndarray:
    """Optimal code lengths of at most `limit` bits (package-merge); zero for symbols that do not occur."""
    lengths = np.zeros(len(counts), np.int64)
    order = np.flatnonzero(counts)
    order = order[np.argsort(counts[order], kind="stable")]
    n = len(order)
    if n <= 1:
        lengths[order] = 1
        return lengths
    if n > 1 << limit:
        raise ValueError(f"{n} symbols do not fit codes of {limit} bits")
    weights = counts[order].astype(np.int64)
    merged, single = weights, np.ones(n, bool)
    levels = [single]
    for _ in range(limit - 1):
        packages = merged[: len(merged) // 2 * 2].reshape(-1, 2).sum(axis=1)
        both = np.concatenate([weights, packages])
        place = np.argsort(both, kind="stable")
        merged, single = both[place], place < n
        levels.append(single)
    taken = 2 * n - 2
    for single in reversed(levels):
        own = int(single[:taken].sum())
        lengths[order[:own]] += 1
        taken = 2 * (taken - own)
    return lengths


def canonical_codes(lengths: np.ndarray) -> np.ndarray:
    """Codes in order of length, then symbol."""
    codes = np.zeros(len(lengths), np.uint64)
    code, last = 0, 0
    order = np.flatnonzero(lengths)
    for symbol in order[np.argsort(lengths[order], kind="stable")].tolist():
        code <<= int(lengths[symbol]) - last
        last = int(lengths[symbol])
        codes[symbol] = code
        code += 1
    return codes


def decoding_table(lengths: np.ndarray, limit: int = MAX_LENGTH) -> np.ndarray:
    """For the next `limit` bits: symbol * 256 + length of its code."""
    table = np.zeros(1 << limit, np.int64)
    codes = canonical_codes(lengths)
    for symbol in np.flatnonzero(lengths).tolist():
        free = limit - int(lengths[symbol])
        first = int(codes[symbol]) << free
        table[first : first + (1 << free)] = symbol * 256 + lengths[symbol]
    return table


def encode(symbols: np.ndarray, counts: np.ndarray, codes: np.ndarray, lengths: np.ndarray) -> tuple[list[bytes], list[bytes]]:
    """Payload and checkpoints (bits of each block, unsigned 16-bit) for consecutive runs of `counts` symbols."""
    used = lengths[symbols]
    ends = np.cumsum(used)
    first = np.r_[0, np.cumsum(counts)]
    sums = np.r_[0, ends]
    before = sums[first]  # bits before each run, without fill
    size = (np.diff(before) + 7) // 8
    base = np.r_[0, np.cumsum(size)] * 8
    at = ends - used + np.repeat(base[:-1] - before[:-1], counts)
    out = np.zeros(int(base[-1]) // 32 + 3, np.uint64)
    if len(symbols):
        word = at >> 5
        wide = codes[symbols] << (64 - used - (at & 31)).astype(np.uint64)
        starts = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
        out[word[starts]] += np.add.reduceat(wide >> np.uint64(32), starts)
        out[word[starts] + 1] += np.add.reduceat(wide & np.uint64(0xFFFFFFFF), starts)
    data = out.astype(">u4").tobytes()
    payloads = [data[a : a + n] for a, n in zip((base[:-1] // 8).tolist(), size.tolist())]
    checks = []
    for k, n in enumerate(counts.tolist()):
        if n == 0:
            checks.append(b"")
            continue
        own = sums[np.r_[np.arange(first[k], first[k + 1], BLOCK), first[k + 1]]]
        checks.append(np.diff(own).astype("<u2").tobytes())
    return payloads, checks


def decode(payloads: list[bytes], checkpoints: list[bytes], counts: np.ndarray, table: np.ndarray) -> np.ndarray:
    """All symbols of the runs; every block starts at its checkpoint, and all blocks go on in lockstep."""
    limit = int(table.size).bit_length() - 1
    data = np.frombuffer(b"".join(payloads) + bytes(8), np.uint8).astype(np.uint32)
    words = data[:-3] << np.uint32(24) | data[1:-2] << np.uint32(16) | data[2:-1] << np.uint32(8) | data[3:]
    base = np.r_[0, np.cumsum([len(p) for p in payloads])] * 8
    blocks = -(-counts // BLOCK)
    bits = np.frombuffer(b"".join(checkpoints), "<u2").astype(np.int64)
    run = np.repeat(np.arange(len(counts)), blocks)
    starts = np.r_[0, np.cumsum(bits)[:-1]] if len(bits) else bits
    first_block = np.r_[0, np.cumsum(blocks)[:-1]] if len(blocks) else blocks
    at = starts - starts[first_block[run]] + base[run] if len(bits) else bits
    nth = np.arange(len(run)) - first_block[run] if len(run) else run
    left = np.minimum(BLOCK, counts[run] - nth * BLOCK)
    place = np.r_[0, np.cumsum(counts)][run] + nth * BLOCK
    out = np.zeros(int(counts.sum()), np.int64)
    order = np.argsort(-left, kind="stable")
    at, left, place = at[order], left[order], place[order]
    mask = np.uint32((1 << limit) - 1)
    for step in range(BLOCK):
        n = int(np.searchsorted(-left, -step))  # blocks with more than `step` symbols
        if n == 0:
            break
        now = at[:n]
        window = words[now >> 3] >> (32 - limit - (now & 7)).astype(np.uint32) & mask
        entry = table[window]
        out[place[:n] + step] = entry >> 8
        at[:n] += entry & 255
    return out
