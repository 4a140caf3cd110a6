"""An adaptive radix tree over byte keys, for one task's share of the keys.

Inner nodes hold their children in one of four layouts that grow with their
number: sorted byte arrays of 4 and of 16, a 256-byte index into 48 slots, and a
plain table of 256. Runs of bytes without a branch are one compressed path. A key
may end at any node, so one key may be the prefix of another.

Every node counts the keys that pass through it or end there, and holds their
least number.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator


class Sorted:
    """4 or 16 children: their bytes in order, and the children beside them."""

    __slots__ = ("room", "bytes", "kids")

    def __init__(self, room: int):
        self.room, self.bytes, self.kids = room, bytearray(), []

    def get(self, byte: int):
        at = self.bytes.find(byte)
        return self.kids[at] if at >= 0 else None

    def full(self) -> bool:
        return len(self.kids) == self.room

    def put(self, byte: int, kid) -> None:
        at = bisect_left(self.bytes, byte)
        if at < len(self.bytes) and self.bytes[at] == byte:
            self.kids[at] = kid
        else:
            self.bytes.insert(at, byte)
            self.kids.insert(at, kid)

    def items(self) -> Iterator:
        return zip(self.bytes, self.kids)

    def grown(self):
        return moved(self, Sorted(16) if self.room == 4 else Indexed())


class Indexed:
    """Up to 48 children behind an index of all bytes (0: no child)."""

    __slots__ = ("index", "kids")

    def __init__(self):
        self.index, self.kids = bytearray(256), []

    def get(self, byte: int):
        slot = self.index[byte]
        return self.kids[slot - 1] if slot else None

    def full(self) -> bool:
        return len(self.kids) == 48

    def put(self, byte: int, kid) -> None:
        slot = self.index[byte]
        if slot:
            self.kids[slot - 1] = kid
        else:
            self.kids.append(kid)
            self.index[byte] = len(self.kids)

    def items(self) -> Iterator:
        return ((b, self.kids[slot - 1]) for b, slot in enumerate(self.index) if slot)

    def grown(self):
        return moved(self, Whole())


class Whole:
    """One slot per byte."""

    __slots__ = ("kids",)

    def __init__(self):
        self.kids = [None] * 256

    def get(self, byte: int):
        return self.kids[byte]

    def full(self) -> bool:
        return False

    def put(self, byte: int, kid) -> None:
        self.kids[byte] = kid

    def items(self) -> Iterator:
        return ((b, k) for b, k in enumerate(self.kids) if k is not None)


def moved(old, new):
    for byte, kid in old.items():
        new.put(byte, kid)
    return new


class Node:
    """``path`` are the bytes from the parent down to here, the branching one first."""

    __slots__ = ("path", "depth", "table", "n", "least", "sample")

    def __init__(self, path: bytes, depth: int, n: int, least: int, sample):
        self.path, self.depth, self.n, self.least, self.sample = path, depth, n, least, sample
        self.table = None

    def child(self, byte: int):
        return self.table.get(byte) if self.table else None

    def attach(self, kid: Node) -> None:
        byte = kid.path[0]
        if self.table is None:
            self.table = Sorted(4)
        elif self.table.full() and self.table.get(byte) is None:
            self.table = self.table.grown()
        self.table.put(byte, kid)

    def children(self) -> Iterator[Node]:
        return (kid for _, kid in self.table.items()) if self.table else iter(())


def common(a: bytes, b: bytes, at: int) -> int:
    """Length of the common start of ``a`` and ``b[at:]``."""
    most = min(len(a), len(b) - at)
    if a[:most] == b[at:at + most]:
        return most
    low, high = 0, most
    while low + 1 < high:
        mid = (low + high) // 2
        if a[:mid] == b[at:at + mid]:
            low = mid
        else:
            high = mid
    return low


class RadixTree:
    def __init__(self):
        self.root = Node(b"", 0, 0, 0, None)

    def insert(self, key: bytes, number: int, sample) -> None:
        """Add a key. ``sample`` is kept at the nodes it makes: any key below a
        node serves to tell what its path stands for."""
        node = self.root
        if node.n == 0:
            node.least, node.sample = number, sample
        node.n += 1
        node.least = min(node.least, number)
        at = 0
        while at < len(key):
            kid = node.child(key[at])
            if kid is None:
                node.attach(Node(key[at:], len(key), 1, number, sample))
                return
            shared = common(kid.path, key, at)
            if shared < len(kid.path):
                # The path parts here, or the key ends inside it.
                upper = Node(kid.path[:shared], kid.depth - len(kid.path) + shared, kid.n, kid.least, kid.sample)
                kid.path = kid.path[shared:]
                upper.attach(kid)
                node.attach(upper)
                kid = upper
            kid.n += 1
            kid.least = min(kid.least, number)
            node, at = kid, at + shared

    def walk(self) -> Iterator[tuple[Node, int]]:
        """Nodes, parents before children, each with its parent's place in this order."""
        stack, place = [(self.root, -1)], 0
        while stack:
            node, above = stack.pop()
            yield node, above
            stack.extend((kid, place) for kid in node.children())
            place += 1
