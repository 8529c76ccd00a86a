"""An adaptive radix tree over byte strings: path compression and nodes of four sizes."""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

#: Children that a node of each layout can hold.
SIZES = (4, 16, 48, 256)


class Node:
    """A node below ``path``, the bytes after the parent's branch byte.

    Up to 16 children stand beside their sorted bytes, up to 48 behind an index of 256
    bytes, more in a row of 256. ``end`` belongs to the key that ends here.
    """

    __slots__ = ("path", "end", "size", "bytes", "kids")

    def __init__(self, path: bytes, end: list | None = None) -> None:
        self.path, self.end = path, end
        self.size = SIZES[0]
        self.bytes = bytearray()
        self.kids: list[Node | None] = []

    def child(self, byte: int) -> Node | None:
        if self.size == 256:
            return self.kids[byte]
        if self.size == 48:
            at = self.bytes[byte]
            return self.kids[at - 1] if at else None
        at = bisect_left(self.bytes, byte)
        return self.kids[at] if at < len(self.bytes) and self.bytes[at] == byte else None

    def put(self, byte: int, kid: Node) -> None:
        """Takes a child under a byte that has none yet."""
        if self.size < 256 and len(self.kids) == self.size:
            self._grow()
        if self.size == 256:
            self.kids[byte] = kid
        elif self.size == 48:
            self.kids.append(kid)
            self.bytes[byte] = len(self.kids)
        else:
            at = bisect_left(self.bytes, byte)
            self.bytes.insert(at, byte)
            self.kids.insert(at, kid)

    def _grow(self) -> None:
        pairs = list(self.pairs())
        self.size = SIZES[SIZES.index(self.size) + 1]
        if self.size == 48:
            self.bytes = bytearray(256)
            for n, (byte, _) in enumerate(pairs):
                self.bytes[byte] = n + 1
            self.kids = [kid for _, kid in pairs]
        elif self.size == 256:
            self.bytes = bytearray()
            self.kids = [None] * 256
            for byte, kid in pairs:
                self.kids[byte] = kid

    def pairs(self) -> Iterator[tuple[int, Node]]:
        """Branch bytes and children in the order of the bytes."""
        if self.size == 256:
            yield from ((b, kid) for b, kid in enumerate(self.kids) if kid is not None)
        elif self.size == 48:
            yield from ((b, self.kids[at - 1]) for b, at in enumerate(self.bytes) if at)
        else:
            yield from zip(self.bytes, self.kids)


def _shared(path: bytes, key: bytes, at: int) -> int:
    """How many bytes of the path the key has from ``at`` on."""
    if key.startswith(path, at):
        return len(path)
    most = min(len(path), len(key) - at)
    return next((n for n in range(most) if path[n] != key[at + n]), most)


class Tree:
    """Keys with a value each; ``insert`` gives the value's place, a list to be filled or added to."""

    def __init__(self) -> None:
        self.root: Node | None = None
        self.keys = 0

    def insert(self, key: bytes) -> list:
        if self.root is None:
            self.root = Node(key, [])
            self.keys = 1
            return self.root.end
        above, node, at = None, self.root, 0
        while True:
            same = _shared(node.path, key, at)
            if same < len(node.path):
                upper = Node(node.path[:same])
                byte = node.path[same]
                node.path = node.path[same + 1 :]
                upper.put(byte, node)
                self._replace(above, key, at, upper)
                node = upper
            at += same
            if at == len(key):
                if node.end is None:
                    node.end = []
                    self.keys += 1
                return node.end
            above, down = node, node.child(key[at])
            if down is None:
                leaf = Node(key[at + 1 :], [])
                node.put(key[at], leaf)
                self.keys += 1
                return leaf.end
            node, at = down, at + 1

    def _replace(self, above: Node | None, key: bytes, at: int, kid: Node) -> None:
        if above is None:
            self.root = kid
        elif above.size == 256:
            above.kids[key[at - 1]] = kid
        elif above.size == 48:
            above.kids[above.bytes[key[at - 1]] - 1] = kid
        else:
            above.kids[bisect_left(above.bytes, key[at - 1])] = kid

    def upwards(self) -> Iterator[tuple[Node, int, int]]:
        """All nodes, children first, with the byte depths behind which their edge begins and at which it ends.

        The root's edge begins at 0; a child's has the branch byte and its path.
        """
        open_nodes = [] if self.root is None else [(self.root, 0, len(self.root.path), False)]
        while open_nodes:
            node, low, high, seen = open_nodes.pop()
            if seen:
                yield node, low, high
                continue
            open_nodes.append((node, low, high, True))
            open_nodes += [(kid, high, high + 1 + len(kid.path), False) for _, kid in node.pairs()]
