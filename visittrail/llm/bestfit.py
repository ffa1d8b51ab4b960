"""Best-fit search: the fullest open sequence that still has room."""

from __future__ import annotations


class Capacities:
    """Open bins by room left, with a segment tree over the rooms that occur."""

    def __init__(self, most: int):
        self.size = 1
        while self.size <= most:
            self.size *= 2
        self.filled = [False] * (2 * self.size)
        self.bins: list[list[int]] = [[] for _ in range(most + 1)]

    def add(self, bin_: int, room: int) -> None:
        self.bins[room].append(bin_)
        at = room + self.size
        while at and not self.filled[at]:
            self.filled[at] = True
            at //= 2

    def take(self, need: int) -> tuple[int, int] | None:
        """A bin with the least room of at least `need`, and its room; it leaves the tree."""
        filled, at = self.filled, need + self.size
        if not filled[at]:
            while at & 1 or not filled[at + 1]:  # upwards until something larger lies to the right
                at //= 2
                if at <= 1:
                    return None
            at += 1
            while at < self.size:
                at = 2 * at if filled[2 * at] else 2 * at + 1
        room = at - self.size
        bin_ = self.bins[room].pop()
        if not self.bins[room]:
            filled[at] = False
            at //= 2
            while at:
                filled[at] = filled[2 * at] or filled[2 * at + 1]
                at //= 2
        return bin_, room


class Bins:
    """Bins of one capacity; items get a bin and an offset in it, without gaps."""

    def __init__(self, capacity: int):
        self.capacity, self.open, self.count = capacity, Capacities(capacity), 0

    def new(self) -> int:
        self.count += 1
        return self.count - 1

    def offer(self, bin_: int, room: int) -> None:
        if room:
            self.open.add(bin_, room)

    def best_fit(self, length: int) -> tuple[int, int]:
        """(bin, offset) of an item put where it leaves the least room."""
        found = self.open.take(length)
        bin_, room = found if found else (self.new(), self.capacity)
        self.offer(bin_, room - length)
        return bin_, self.capacity - room
