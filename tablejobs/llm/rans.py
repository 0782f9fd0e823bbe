"""Static range asymmetric numeral system over interleaved lanes.

One table of frequencies, with a sum of 2 ** TABLE_BITS, serves all blocks. In a block token t belongs to lane t % lanes;
all lanes take a step together, so a step is a few array operations. Lanes put words of 32 bits into one stream, in the
order in which the decoder asks for them. Checkpoints hold the lanes' states and the place in the stream at every
`every`-th step: a decoder may start at any of them.
"""

from __future__ import annotations

import numpy as np

TABLE_BITS = 20
_LOW = 1 << 31
_SHIFT, _WORD = np.uint64(TABLE_BITS), np.uint64(32)
_RENORM = np.uint64(31 - TABLE_BITS + 32)


def quantised(counts: np.ndarray) -> np.ndarray:
    """Frequencies with a sum of 2 ** TABLE_BITS (0 if nothing was counted); each counted token keeps 1 at least."""
    seen = counts > 0
    spare = (1 << TABLE_BITS) - int(seen.sum())
    if spare < 0:
        raise ValueError("more tokens than the table has room for")
    freq = np.zeros(len(counts), np.int64)
    if seen.any():
        freq[seen] = 1 + np.floor(counts[seen] * (spare / float(counts.sum()))).astype(np.int64)
        freq[np.argmax(counts)] += (1 << TABLE_BITS) - int(freq.sum())
    return freq


class Coder:
    def __init__(self, freq: np.ndarray) -> None:
        self.freq = freq.astype(np.uint64)
        self.start = (np.cumsum(freq) - freq).astype(np.uint64)
        self.token = np.repeat(np.arange(len(freq), dtype=np.uint32), freq)

    def encode(self, ids: np.ndarray, lanes: int, every: int) -> tuple[bytes, bytes, bytes]:
        """(words, states of the checkpoints, places of the checkpoints); the first checkpoint is step 0."""
        freq, start, steps = self.freq[ids], self.start[ids], -(-len(ids) // lanes)
        state = np.full(lanes, _LOW, np.uint64)
        words: list[np.ndarray] = [np.zeros(0, "<u4")] * steps
        marks = []
        for t in range(steps - 1, -1, -1):
            part = slice(t * lanes, min((t + 1) * lanes, len(ids)))
            f, x = freq[part], state[: part.stop - part.start]
            over = np.flatnonzero(x >= f << _RENORM)
            if len(over):
                words[t] = x[over].astype("<u4")
                x[over] >>= _WORD
            times = x // f
            x += (times << _SHIFT) - times * f + start[part]
            if t % every == 0:
                marks.append(state.copy())
        sizes = np.cumsum([0, *map(len, words)])[:-1:every] if steps else np.zeros(1, np.int64)
        states = np.concatenate(marks[::-1]) if marks else state
        return np.concatenate([np.zeros(0, "<u4"), *words]).tobytes(), states.astype("<u8").tobytes(), sizes.astype("<i8").tobytes()

    def decode(
        self, n: int, lanes: int, every: int, words: bytes, states: bytes, places: bytes, first: int = 0, last: int | None = None
    ) -> np.ndarray:
        """Tokens from checkpoint `first` up to checkpoint `last` (to the end without it)."""
        stream, at = np.frombuffer(words, "<u4"), int(np.frombuffer(places, "<i8")[first])
        state = np.frombuffer(states, "<u8").reshape(-1, lanes)[first].astype(np.uint64)
        begin = first * every * lanes
        end = n if last is None else min(n, last * every * lanes)
        out = np.zeros(max(end - begin, 0), np.uint32)
        mask = np.uint64((1 << TABLE_BITS) - 1)
        for low in range(begin, end, lanes):
            high = min(low + lanes, end)
            x = state[: high - low]
            slot = x & mask
            token = self.token[slot]
            out[low - begin : high - begin] = token
            x >>= _SHIFT
            x *= self.freq[token]
            x += slot - self.start[token]
            need = np.flatnonzero(x < _LOW)
            if len(need):
                x[need] = (x[need] << _WORD) | stream[at : at + len(need)].astype(np.uint64)
                at += len(need)
        if last is None and (at != len(stream) or (state != _LOW).any()):
            raise ValueError("the stream does not end where its block ends")
        return out
