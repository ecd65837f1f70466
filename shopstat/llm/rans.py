"""Static range asymmetric numeral system over numpy lanes.

A block of ids is dealt over ``LANES`` interleaved coders: id ``i`` belongs to lane ``i % LANES``
of step ``i // LANES``, and every step codes all lanes at once. All blocks share one table of
frequencies that sum to ``2**SCALE_BITS``. A lane's state lies in ``[2**31, 2**63)`` and is
renormalised by 32-bit words; the words of a step stand in lane order and the steps in the
order in which the decoder wants them. A block also holds, every ``CHECKPOINT_STEPS`` steps, the
states and the word position there, so that decoding can begin in its middle, and checksums.
"""
from __future__ import annotations

import struct
import zlib

import numpy as np

SCALE_BITS = 20
LANES = 1024
CHECKPOINT_STEPS = 128

_SLOTS = np.uint64((1 << SCALE_BITS) - 1)
_LOW = np.uint64(1 << 31)
_WORD = np.uint64(0xFFFFFFFF)
_32 = np.uint64(32)
_SCALE = np.uint64(SCALE_BITS)
_ROOM = np.uint64(31 - SCALE_BITS + 32)
_HEAD = struct.Struct("<4sIQIIII")
_MAGIC = b"RAB1"


class Table:
    """Frequencies of ids, their running sums and the id of each slot."""

    def __init__(self, frequencies: np.ndarray) -> None:
        self.frequencies = np.asarray(frequencies, dtype=np.uint32)
        if int(self.frequencies.sum(dtype=np.uint64)) != 1 << SCALE_BITS:
            raise ValueError(f"frequencies must sum to 2**{SCALE_BITS}")
        self.freq = self.frequencies.astype(np.uint64)
        self.cum = np.concatenate([[0], np.cumsum(self.freq)[:-1]]).astype(np.uint64)
        self.symbol = np.repeat(np.arange(len(self.freq), dtype=np.uint32), self.frequencies)

    @staticmethod
    def of_counts(counts: np.ndarray) -> "Table":
        """Counts scaled to the table's sum; every id that occurs keeps at least one slot. The
        rounding error goes to the commonest ids in turn, so the table depends on the counts alone."""
        counts = np.asarray(counts, dtype=np.float64)
        total = 1 << SCALE_BITS
        used = counts > 0
        if not used.any():
            counts, used = np.ones_like(counts), np.ones(len(counts), bool)
        if used.sum() > total:
            raise ValueError("more ids than slots")
        freq = np.where(used, np.maximum(1, np.floor(counts / counts.sum() * total)), 0).astype(np.int64)
        order = np.lexsort((np.arange(len(counts)), -counts))
        order = order[: int(used.sum())]
        error = total - int(freq.sum())
        while error:
            if error > 0:
                freq[order[0]] += error
                error = 0
            else:
                spare = np.maximum(freq[order] - 1, 0)
                take = np.minimum(spare, np.maximum(1, spare // 2))
                upto = np.cumsum(take)
                take = np.where(upto <= -error, take, np.maximum(0, -error - (upto - take)))
                freq[order] -= take
                error += int(take.sum())
        return Table(freq)


def encode_block(ids: np.ndarray, table: Table) -> bytes:
    """One self-contained block."""
    n = len(ids)
    steps = -(-n // LANES)
    last = n - (steps - 1) * LANES if steps else 0
    padded = np.zeros(steps * LANES, dtype=np.int64)
    padded[:n] = ids
    freq = table.freq[padded].reshape(steps, LANES)
    cum = table.cum[padded].reshape(steps, LANES)
    limit = freq << _ROOM
    x = np.full(LANES, _LOW, dtype=np.uint64)
    chunks: list[np.ndarray] = []
    marks: list[tuple[int, int, np.ndarray]] = []
    written = 0
    for t in range(steps - 1, -1, -1):
        k = last if t == steps - 1 else LANES
        state = x[:k]
        full = state >= limit[t, :k]
        words = state[full]
        if len(words):
            chunks.append((words & _WORD).astype("<u4"))
            written += len(words)
            state[full] = words >> _32
        f = freq[t, :k]
        quotient = state // f
        x[:k] = (quotient << _SCALE) + (state - quotient * f) + cum[t, :k]
        if t and t % CHECKPOINT_STEPS == 0:
            marks.append((t, written, x.copy()))
    words = np.concatenate(chunks[::-1]) if chunks else np.zeros(0, "<u4")
    marks.reverse()
    body = [x.astype("<u8").tobytes()]
    body += [struct.pack("<II", t, written - w) + s.astype("<u8").tobytes() for t, w, s in marks]
    body.append(words.tobytes())
    payload = b"".join(body)
    ids_crc = zlib.crc32(np.ascontiguousarray(ids, dtype="<u4").tobytes())
    return _HEAD.pack(_MAGIC, LANES, n, len(marks), len(words), zlib.crc32(payload), ids_crc) + payload


def decode_block(data: bytes, table: Table, first: int = 0, stop: int | None = None) -> np.ndarray:
    """Ids ``first`` to ``stop`` of a block, begun at the nearest checkpoint before ``first``."""
    magic, lanes, n, n_marks, n_words, crc, ids_crc = _HEAD.unpack_from(data)
    if magic != _MAGIC:
        raise ValueError("not a block of this format")
    payload = memoryview(data)[_HEAD.size:]
    if zlib.crc32(payload) != crc:
        raise ValueError("block checksum differs")
    stop = n if stop is None else min(stop, n)
    steps = -(-n // lanes)
    x = np.frombuffer(payload, "<u8", lanes).astype(np.uint64)
    at, step, position = lanes * 8, 0, 0
    for _ in range(n_marks):
        t, w = struct.unpack_from("<II", payload, at)
        if t * lanes <= first:
            step, position = t, w
            x = np.frombuffer(payload, "<u8", lanes, at + 8).astype(np.uint64)
        at += 8 + lanes * 8
    words = np.frombuffer(payload, "<u4", n_words, at).astype(np.uint64)
    begin, end = step, min(steps, -(-stop // lanes))
    out = np.zeros((max(0, end - begin), lanes), dtype=np.uint32)
    for t in range(begin, end):
        k = n - t * lanes if t == steps - 1 else lanes
        state = x[:k]
        slot = state & _SLOTS
        symbol = table.symbol[slot]
        out[t - begin, :k] = symbol
        state = table.freq[symbol] * (state >> _SCALE) + slot - table.cum[symbol]
        low = state < _LOW
        m = int(low.sum())
        if m:
            state[low] = (state[low] << _32) | words[position:position + m]
            position += m
        x[:k] = state
    flat = out.reshape(-1)[max(0, first - begin * lanes):max(0, stop - begin * lanes)]
    if first == 0 and stop == n and zlib.crc32(flat.astype("<u4").tobytes()) != ids_crc:
        raise ValueError("ids checksum differs")
    return flat
