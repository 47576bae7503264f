"""A minimal perfect hash of byte strings that also tells strings it does not hold."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import xxhash

#: Places a level has for each string that is left, and levels at most.
ROOM, LEVELS = 1.5, 40
SEED = 42
#: Odd multipliers of the mixing steps.
STIR, SPREAD = 0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93


def hashes(keys: Sequence[bytes]) -> np.ndarray:
    """XXH64 of each string as a signed 64-bit number, as the SQL function gives it."""
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(key, SEED) for key in keys), np.uint64, len(keys)).view(np.int64)


def _places(h: np.ndarray, level: int, size: int) -> np.ndarray:
    """Places of a level; other bits of the hash than those that chose the shard, and than other levels'."""
    x = (h.view(np.uint64) + np.uint64((level + 1) * STIR % (1 << 64))) * np.uint64(SPREAD)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(STIR)
    return ((x >> np.uint64(32)) % np.uint64(size)).astype(np.int64)


class PerfectHash:
    """n strings on the slots 0 to n - 1.

    A level has a bit for each of its places; a string that is alone on its place
    sets the bit and gets the bit's rank as its slot, the others go on to the next
    level.  The strings are kept in order of their slots, so that a string that
    is not among them is found out.  Strings that no level could part, such as
    those whose 64-bit hashes are equal, are kept in a plain table.
    """

    def __init__(self, keys: Sequence[bytes]):
        h = hashes(keys)
        left = np.arange(len(keys))
        self.sizes: list[int] = []
        self.bits: list[np.ndarray] = []
        order: list[np.ndarray] = []
        while len(left) and len(self.sizes) < LEVELS:
            size = int(ROOM * len(left)) + 1
            at = _places(h[left], len(self.sizes), size)
            alone = np.bincount(at, minlength=size) == 1
            placed = alone[at]
            order.append(left[placed][np.argsort(at[placed], kind="stable")])
            self.sizes.append(size)
            self.bits.append(np.packbits(alone))
            left = left[~placed]
        slots = np.concatenate(order) if order else np.zeros(0, np.int64)
        placed_keys = [keys[i] for i in slots.tolist()]
        rest = [keys[i] for i in left.tolist()]
        self.rest = {key: len(placed_keys) + i for i, key in enumerate(rest)}
        self.stored = b"".join(placed_keys)
        self.offsets = np.cumsum([0, *map(len, placed_keys)])
        #: All strings in order of their slots.
        self.keys = placed_keys + rest
        self._rank()

    def _rank(self) -> None:
        """Slot of each place, -1 where no string is."""
        self.slot_of, before = [], 0
        for size, packed in zip(self.sizes, self.bits):
            set_ = np.unpackbits(packed, count=size).astype(bool)
            self.slot_of.append(np.where(set_, np.cumsum(set_) - 1 + before, -1))
            before += int(set_.sum())

    def __len__(self) -> int:
        return len(self.offsets) - 1 + len(self.rest)

    def __getstate__(self) -> dict:
        return {name: value for name, value in self.__dict__.items() if name not in ("keys", "slot_of")}

    def __setstate__(self, state: dict) -> None:
        self.__dict__.update(state)
        self._rank()

    def slots(self, keys: Sequence[bytes], h: np.ndarray) -> np.ndarray:
        """The slot of each string, -1 for those that are not held; h: their hashes."""
        places = np.full(len(keys), -1, np.int64)
        open_ = np.arange(len(keys))
        for level, slot_of in enumerate(self.slot_of):
            if not len(open_):
                break
            slot = slot_of[_places(h[open_], level, len(slot_of))]
            places[open_] = slot
            open_ = open_[slot < 0]
        asked = np.flatnonzero(places >= 0)
        starts, ends = self.offsets[places[asked]].tolist(), self.offsets[places[asked] + 1].tolist()
        stored = self.stored
        same = [stored[s:e] == keys[i] for s, e, i in zip(starts, ends, asked.tolist())]
        places[asked[~np.array(same, bool)]] = -1
        if self.rest:
            for i in np.flatnonzero(places < 0).tolist():
                places[i] = self.rest.get(keys[i], -1)
        return places
