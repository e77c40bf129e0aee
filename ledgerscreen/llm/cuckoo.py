"""A cuckoo filter on numpy arrays: 16-bit fingerprints, four to a bucket.

A key (an unsigned 64-bit hash) may sit in one of two buckets, each found from
the other and the fingerprint.  Keys that find no room after ``KICKS`` moves
stay whole in an exact overflow list, so an insertion never fails and a later
deletion always finds what it deletes."""

from __future__ import annotations

import numpy as np

SLOTS = 4
KICKS = 200


class CuckooFilter:
    def __init__(self, capacity: int):
        buckets = 1
        while buckets * SLOTS * 0.85 < max(capacity, 1):
            buckets *= 2
        self.table = np.zeros((buckets, SLOTS), np.uint16)
        self.overflow = np.empty(0, np.uint64)

    def _place(self, keys: np.ndarray):
        finger = (keys >> np.uint64(48)).astype(np.uint16)
        finger[finger == 0] = 1
        mask = np.uint64(len(self.table) - 1)
        one = (keys & mask).astype(np.int64)
        return finger, one, self._other(finger, one)

    def _other(self, finger, bucket):
        jump = (finger.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(32)
        return bucket ^ (jump & np.uint64(len(self.table) - 1)).astype(np.int64)

    def add(self, keys: np.ndarray) -> None:
        """Insert distinct keys that are not in the filter."""
        keys = np.asarray(keys, np.uint64)
        for choice in (1, 2):
            if not len(keys):
                return
            place = self._place(keys)
            finger, bucket = place[0], place[choice]
            order = np.argsort(bucket, kind="stable")
            b = bucket[order]
            first = np.flatnonzero(np.diff(b, prepend=-1))
            rank = np.arange(len(b)) - np.repeat(first, np.diff(np.append(first, len(b))))
            free = self.table[b] == 0
            fits = rank < free.sum(axis=1)
            slot = np.argmax(np.cumsum(free, axis=1) > rank[:, None], axis=1)
            self.table[b[fits], slot[fits]] = finger[order][fits]
            keys = keys[order[~fits]]
        left = []
        finger, one, _ = self._place(keys)
        for key, f, b in zip(keys, finger, one):
            moved = []
            for kick in range(KICKS):
                row = self.table[b]
                empty = np.flatnonzero(row == 0)
                if len(empty):
                    row[empty[0]] = f
                    break
                s = (int(f) + kick) % SLOTS
                moved.append((b, s, f))
                row[s], f = f, row[s]
                b = int(self._other(np.array([f], np.uint16), np.array([b]))[0])
            else:
                for at, s, was in reversed(moved):   # undo the moves; the key itself overflows
                    self.table[at, s], f = f, was
                left.append(key)
        if left:
            self.overflow = np.append(self.overflow, np.array(left, np.uint64))

    def remove(self, keys: np.ndarray) -> None:
        """Delete distinct keys that are in the filter."""
        keys = np.asarray(keys, np.uint64)
        whole = np.isin(keys, self.overflow)
        self.overflow = self.overflow[~np.isin(self.overflow, keys[whole])]
        keys = keys[~whole]
        while len(keys):
            finger, one, two = self._place(keys)
            in_one = self.table[one] == finger[:, None]
            in_two = self.table[two] == finger[:, None]
            bucket = np.where(in_one.any(axis=1), one, two)
            hit = np.where(in_one.any(axis=1)[:, None], in_one, in_two)
            if not hit.any(axis=1).all():
                raise KeyError("a key to delete is not in the filter")
            slot = bucket * SLOTS + hit.argmax(axis=1)
            _, first = np.unique(slot, return_index=True)
            self.table.reshape(-1)[slot[first]] = 0
            keys = np.delete(keys, first)

    def has(self, keys: np.ndarray) -> np.ndarray:
        """False: certainly absent.  True: present, or rarely absent."""
        keys = np.asarray(keys, np.uint64)
        finger, one, two = self._place(keys)
        f = finger[:, None]
        return (self.table[one] == f).any(axis=1) | (self.table[two] == f).any(axis=1) | np.isin(keys, self.overflow)

    def to_bytes(self) -> bytes:
        return np.int64(len(self.table)).tobytes() + self.table.tobytes() + self.overflow.tobytes()

    @classmethod
    def from_bytes(cls, data: bytes) -> CuckooFilter:
        out = cls(0)
        buckets = int(np.frombuffer(data, np.int64, 1)[0])
        size = buckets * SLOTS
        out.table = np.frombuffer(data, np.uint16, size, 8).reshape(buckets, SLOTS).copy()
        out.overflow = np.frombuffer(data, np.uint64, offset=8 + 2 * size).copy()
        return out
