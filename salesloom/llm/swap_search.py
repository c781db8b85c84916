"""Bins of one shard: best fit, then local search by swaps.

Every step raises the sum of squared fills, so the fuller bins fill up at the cost of the
emptier ones until those are empty and go. A step is, for an underfull bin:

- a move: a piece of another underfull bin comes in;
- one for one: a piece is exchanged for a longer one;
- two for one: two pieces are exchanged for one longer than both together, or one for two
  pieces of one bin that are longer together.

The search ends at a local optimum, or sooner when no packing of these pieces can have
fewer bins (their total divided by the capacity, rounded up).
"""

from __future__ import annotations

from collections.abc import Sequence


class Lengths:
    """Pieces of the underfull bins by length; finds the longest within a range."""

    def __init__(self, capacity: int):
        self.at: list[set[int]] = [set() for _ in range(capacity + 1)]
        self.present = 0  # one bit a length

    def add(self, piece: int, length: int) -> None:
        self.at[length].add(piece)
        self.present |= 1 << length

    def remove(self, piece: int, length: int) -> None:
        self.at[length].discard(piece)
        if not self.at[length]:
            self.present &= ~(1 << length)

    def down_from(self, most: int, least: int):
        """Lengths present from ``most`` down to ``least``."""
        held = self.present & ((1 << (most + 1)) - 1) if most > 0 else 0
        while (length := held.bit_length() - 1) >= least > 0:
            yield length
            held &= ~(1 << length)


class Bins:
    def __init__(self, lengths: Sequence[int], capacity: int):
        self.lengths, self.capacity = lengths, capacity
        self.held: list[list[int]] = []
        self.fill: list[int] = []
        self.place: list[int] = [0] * len(lengths)

    def best_fit(self) -> None:
        """Each piece, as it comes, into the fullest bin that takes it."""
        by_room: list[list[int]] = [[] for _ in range(self.capacity + 1)]
        rooms = 0
        for piece, length in enumerate(self.lengths):
            fitting = rooms >> length
            if fitting:
                room = length + (fitting & -fitting).bit_length() - 1
                home = by_room[room].pop()
                if not by_room[room]:
                    rooms &= ~(1 << room)
            else:
                home = len(self.held)
                self.held.append([])
                self.fill.append(0)
            self.held[home].append(piece)
            self.fill[home] += length
            self.place[piece] = home
            if room := self.capacity - self.fill[home]:
                by_room[room].append(home)
                rooms |= 1 << room

    def least_bins(self) -> int:
        return -(-sum(self.lengths) // self.capacity)

    def improve(self) -> None:
        lengths, fill, held, place, capacity = self.lengths, self.fill, self.held, self.place, self.capacity
        known = Lengths(capacity)
        pairs: dict[int, tuple[int, int]] = {}
        used = sum(f > 0 for f in fill)
        least = self.least_bins()
        for piece, length in enumerate(lengths):
            if fill[place[piece]] < capacity:
                known.add(piece, length)

        def exchange(target: int, out: Sequence[int], source: int, into: Sequence[int]) -> None:
            nonlocal used
            touched = (target, source)
            for home in touched:
                for piece in held[home]:
                    known.remove(piece, lengths[piece])
            gained = sum(lengths[p] for p in into) - sum(lengths[p] for p in out)
            held[target] = [p for p in held[target] if p not in out] + list(into)
            held[source] = [p for p in held[source] if p not in into] + list(out)
            for home in touched:
                for piece in held[home]:
                    place[piece] = home
            fill[target] += gained
            fill[source] -= gained
            used -= fill[source] == 0
            for home in touched:
                if fill[home] < capacity:
                    for piece in held[home]:
                        known.add(piece, lengths[piece])

        def source_of(length: int, target: int, gained: int, most: int) -> int | None:
            """A piece of this length whose bin may lose ``gained`` to the target."""
            for piece in known.at[length]:
                home = place[piece]
                if home != target and fill[target] + gained > fill[home]:
                    return piece
            return None

        def step(target: int) -> bool:
            room = capacity - fill[target]
            best, found = 0, None
            mine = held[target]
            outs = [((), 0)] + [((p,), lengths[p]) for p in mine]
            outs += [((p, q), lengths[p] + lengths[q]) for i, p in enumerate(mine) for q in mine[:i]]
            for out, size in outs:
                for length in known.down_from(min(size + room, capacity), size + best + 1):
                    piece = source_of(length, target, length - size, capacity)
                    if piece is not None:
                        best, found = length - size, (out, place[piece], (piece,))
                        break
                if best == room:
                    break
            if best < room:
                # One of the target's for two of a bin that holds them side by side.
                for piece in mine:
                    size = lengths[piece]
                    for total in range(size + room, size + best, -1):
                        pair = pairs.get(total)
                        if pair and place[pair[0]] == place[pair[1]] != target and fill[target] + total - size > fill[place[pair[0]]]:
                            best, found = total - size, ((piece,), place[pair[0]], pair)
                            break
            if found is None:
                return False
            exchange(target, found[0], found[1], found[2])
            return True

        changed = True
        while changed and used > least:
            changed = False
            pairs.clear()
            open_bins = [home for home, f in enumerate(fill) if 0 < f < capacity]
            for home in open_bins:
                for i, p in enumerate(held[home]):
                    for q in held[home][:i]:
                        pairs.setdefault(lengths[p] + lengths[q], (p, q))
            for target in sorted(open_bins, key=lambda home: -fill[home]):
                while 0 < fill[target] < capacity and used > least and step(target):
                    changed = True

    def packed(self) -> list[list[int]]:
        return [pieces for pieces in self.held if pieces]
