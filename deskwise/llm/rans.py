"""Range asymmetric numeral system over integer symbols, in numpy.

One static frequency table serves all blocks of a file. A block is a run of symbols dealt to LANES
interleaved states; symbol t * LANES + k belongs to lane k. Blocks do not depend on each other, so
any of them can be decoded alone from its checkpoint: the lanes' states and the place of its words.

States are 64 bits wide and stay in [2**31, 2**63); frequencies sum to 2**SCALE, so a step moves one
32-bit word at most. All blocks of a batch, and all their lanes, take a step together.
"""

from __future__ import annotations

import numpy as np

LANES = 64
SCALE = 20
LOW = np.uint64(1 << 31)
_SCALE, _WORD, _ROOM = np.uint64(SCALE), np.uint64(32), np.uint64(63 - SCALE)
_SLOTS = np.uint64((1 << SCALE) - 1)


class Table:
    """Frequencies of the symbols that occur, scaled to sum to 2**SCALE with none below one."""

    def __init__(self, symbols: np.ndarray, frequencies: np.ndarray):
        self.symbols = symbols.astype(np.uint32)
        self.frequencies = frequencies.astype(np.uint64)
        self.before = np.cumsum(self.frequencies) - self.frequencies
        self._lookup: np.ndarray | None = None
        # Symbols are numbers of a vocabulary, so this has as many entries as that.
        self.index_of = np.zeros(int(self.symbols.max(initial=0)) + 1, np.int32)
        self.index_of[self.symbols] = np.arange(len(self.symbols))

    @classmethod
    def count(cls, ids: np.ndarray) -> Table:
        every = np.bincount(ids)
        symbols = np.flatnonzero(every)
        n = every[symbols]
        if len(symbols) > 1 << SCALE:
            raise ValueError(f"more than {1 << SCALE} different symbols")
        scaled = np.maximum(1, n * (1 << SCALE) // n.sum())
        spare = (1 << SCALE) - int(scaled.sum())
        for k in np.argsort(-scaled, kind="stable"):
            change = max(spare, 1 - int(scaled[k]))
            scaled[k] += change
            spare -= change
            if not spare:
                break
        return cls(symbols, scaled)

    def lookup(self) -> np.ndarray:
        """The index of the symbol that owns each slot."""
        if self._lookup is None:
            self._lookup = np.repeat(
                np.arange(len(self.symbols), dtype=np.int32), self.frequencies.astype(np.int64)
            )
        return self._lookup


def encode(table: Table, ids: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """Blocks of equal length, shape (blocks, steps * LANES): their final states and their words."""
    blocks = len(ids)
    # By steps, so that what a step reads lies together.
    index = table.index_of[ids].reshape(blocks, -1, LANES).swapaxes(0, 1).copy()
    steps = len(index)
    state = np.full((blocks, LANES), LOW)
    moved = np.empty((blocks, steps, LANES), bool)
    words = np.empty((blocks, steps, LANES), np.uint32)
    for t in range(steps - 1, -1, -1):
        f, before = table.frequencies[index[t]], table.before[index[t]]
        full = state >= f << _ROOM
        moved[:, t], words[:, t] = full, state.astype(np.uint32)
        state = np.where(full, state >> _WORD, state)
        whole, rest = np.divmod(state, f)
        state = (whole << _SCALE) + rest + before
    return state, [words[b][moved[b]] for b in range(blocks)]


def decode(table: Table, states: np.ndarray, words: list[np.ndarray], steps: int) -> np.ndarray:
    """The symbols of blocks of equal length, shape (blocks, steps * LANES)."""
    blocks = len(states)
    lookup = table.lookup()
    stream = np.concatenate([*words, np.zeros(1, np.uint32)]).astype(np.uint64)
    place = np.cumsum([0, *map(len, words)])[:-1]
    state = states.astype(np.uint64)
    out = np.empty((steps, blocks, LANES), np.int32)
    for t in range(steps):
        slot = state & _SLOTS
        index = lookup[slot.astype(np.int64)]
        out[t] = index
        state = table.frequencies[index] * (state >> _SCALE) + slot - table.before[index]
        empty = state < LOW
        nth = np.cumsum(empty, axis=1)
        take = (place[:, None] + nth - 1)[empty]
        state[empty] = state[empty] << _WORD | stream[take]
        place = place + nth[:, -1]
    return table.symbols[out.swapaxes(0, 1).reshape(blocks, -1)]
