"""Adaptive radix tree over byte strings, with path compression.

A node has the bytes of its compressed path, maybe the value of a key that ends after them, and children by
next byte in one of four layouts, which grow as children come: up to 4 and up to 16 sorted bytes, a 256-byte
index of up to 48 children, and 256 places.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

NONE = 255


def _shared(a: bytes, b: bytes) -> int:
    """Length of the common beginning."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    gap = int.from_bytes(a[:n], "big") ^ int.from_bytes(b[:n], "big")
    return n - (gap.bit_length() + 7) // 8


class Node:
    __slots__ = ("path", "value", "layout", "index", "children")

    def __init__(self, path: bytes, value=None) -> None:
        self.path, self.value = path, value
        self.layout, self.index, self.children = 4, bytearray(), []

    def child(self, byte: int) -> Node | None:
        if self.layout <= 16:
            at = self.index.find(byte)
            return None if at < 0 else self.children[at]
        if self.layout == 48:
            at = self.index[byte]
            return None if at == NONE else self.children[at]
        return self.children[byte]

    def add(self, byte: int, node: Node) -> None:
        """Place a child under a byte that has none."""
        if self.layout <= 16:
            if len(self.children) < self.layout:
                at = bisect_left(self.index, byte)
                self.index.insert(at, byte)
                self.children.insert(at, node)
                return
            if self.layout == 4:
                self.layout = 16
            else:
                index = bytearray([NONE]) * 256
                for at, b in enumerate(self.index):
                    index[b] = at
                self.layout, self.index = 48, index
            self.add(byte, node)
        elif self.layout == 48:
            if len(self.children) < 48:
                self.index[byte] = len(self.children)
                self.children.append(node)
                return
            places: list[Node | None] = [None] * 256
            for b, at in enumerate(self.index):
                if at != NONE:
                    places[b] = self.children[at]
            self.layout, self.index, self.children = 256, bytearray(), places
            self.add(byte, node)
        else:
            self.children[byte] = node

    def all_children(self) -> Iterator[Node]:
        """Children, by byte in all layouts but that of 48."""
        return (c for c in self.children if c is not None)


class RadixTree:
    def __init__(self) -> None:
        self.root: Node | None = None

    def insert(self, key: bytes, value) -> None:
        """Set the value of a key; the last one counts."""
        if self.root is None:
            self.root = Node(key, value)
            return
        node, at = self.root, 0
        while True:
            path = node.path
            if key.startswith(path, at):
                at += len(path)
                if at == len(key):
                    node.value = value
                    return
                below = node.child(key[at])
                if below is None:
                    node.add(key[at], Node(key[at + 1:], value))
                    return
                node, at = below, at + 1
                continue
            common = _shared(path, key[at:at + len(path)])
            lower = Node(path[common + 1:], node.value)
            lower.layout, lower.index, lower.children = node.layout, node.index, node.children
            node.path, node.value = path[:common], None
            node.layout, node.index, node.children = 4, bytearray(), []
            node.add(path[common], lower)
            at += common
            if at == len(key):
                node.value = value
            else:
                node.add(key[at], Node(key[at + 1:], value))
            return

    def get(self, key: bytes):
        node, at = self.root, 0
        while node is not None and key.startswith(node.path, at):
            at += len(node.path)
            if at == len(key):
                return node.value
            node, at = node.child(key[at]), at + 1
        return None

    def bottom_up(self) -> Iterator[tuple[Node, int, int]]:
        """Every node after its children, with the byte depths that its path begins after and ends at.

        The byte that a child is found by belongs to the child, so that its span begins where its parent's ends.
        """
        stack: list[tuple[Node, int, int, bool]] = []
        if self.root is not None:
            stack.append((self.root, 0, len(self.root.path), False))
        while stack:
            node, begin, end, seen = stack.pop()
            if seen:
                yield node, begin, end
                continue
            stack.append((node, begin, end, True))
            for c in node.all_children():
                stack.append((c, end, end + 1 + len(c.path), False))
