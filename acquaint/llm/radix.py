"""Adaptive radix tree over byte strings.

Inner nodes grow with their number of children through four layouts: up to 4 and up
to 16 children in sorted arrays, up to 48 behind an index of one byte for each
value, and one slot for each of the 256 values. The bytes that all keys below a
node share are held once, as its prefix (path compression), and a lone key keeps
the rest of its bytes in a leaf. Keys may be prefixes of others: such a key's value
is held by the inner node where it ends.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator


class Sorted:
    """Up to ``most`` children; their bytes are kept in order beside them."""

    __slots__ = ("bytes", "children")
    most = 4

    def __init__(self, bytes_: bytearray, children: list) -> None:
        self.bytes, self.children = bytes_, children

    def get(self, byte: int):
        at = self.bytes.find(byte)
        return None if at < 0 else self.children[at]

    def replace(self, byte: int, child) -> None:
        self.children[self.bytes.find(byte)] = child

    def with_child(self, byte: int, child):
        """This layout with one child more, or the next larger one."""
        at = bisect_left(self.bytes, byte)
        self.bytes.insert(at, byte)
        self.children.insert(at, child)
        return self if len(self.children) <= self.most else self.grown()

    def grown(self):
        return Sorted16(self.bytes, self.children)

    def in_order(self) -> Iterator:
        return iter(self.children)


class Sorted16(Sorted):
    __slots__ = ()
    most = 16

    def grown(self):
        index = bytearray(b"\xff" * 256)
        for at, byte in enumerate(self.bytes):
            index[byte] = at
        return Indexed48(index, self.children)


class Indexed48:
    """Up to 48 children in order of arrival, found through 256 one-byte places."""

    __slots__ = ("index", "children")
    most, nothing = 48, 0xFF

    def __init__(self, index: bytearray, children: list) -> None:
        self.index, self.children = index, children

    def get(self, byte: int):
        at = self.index[byte]
        return None if at == self.nothing else self.children[at]

    def replace(self, byte: int, child) -> None:
        self.children[self.index[byte]] = child

    def with_child(self, byte: int, child):
        if len(self.children) == self.most:
            slots = [None if at == self.nothing else self.children[at] for at in self.index]
            slots[byte] = child
            return Direct256(slots)
        self.index[byte] = len(self.children)
        self.children.append(child)
        return self

    def in_order(self) -> Iterator:
        return (self.children[at] for at in self.index if at != self.nothing)


class Direct256:
    """One slot for each byte."""

    __slots__ = ("slots",)

    def __init__(self, slots: list) -> None:
        self.slots = slots

    def get(self, byte: int):
        return self.slots[byte]

    def replace(self, byte: int, child) -> None:
        self.slots[byte] = child

    def with_child(self, byte: int, child):
        self.slots[byte] = child
        return self

    def in_order(self) -> Iterator:
        return (child for child in self.slots if child is not None)


class Leaf:
    """One key: ``prefix`` holds the bytes that follow those of the nodes above."""

    __slots__ = ("prefix", "value")

    def __init__(self, prefix: bytes, value) -> None:
        self.prefix, self.value = prefix, value

    def in_order(self) -> Iterator:
        return iter(())


class Inner:
    """Shared bytes, the value of the key that ends here (if any), and children."""

    __slots__ = ("prefix", "value", "layout")

    def __init__(self, prefix: bytes, value=None) -> None:
        self.prefix, self.value = prefix, value
        self.layout = Sorted(bytearray(), [])

    def in_order(self) -> Iterator:
        return self.layout.in_order()

    def add(self, byte: int, child) -> None:
        self.layout = self.layout.with_child(byte, child)


class RadixTree:
    """Values (not None) by key. A key that is put twice keeps its later value."""

    def __init__(self) -> None:
        self.root = Inner(b"")

    def put(self, key: bytes, value) -> None:
        node, at, above, byte = self.root, 0, None, 0
        while True:
            shared = len(node.prefix)
            if not key.startswith(node.prefix, at):
                shared = common(node.prefix, key[at : at + shared])
            ends, inner = at + shared == len(key), isinstance(node, Inner)
            if shared < len(node.prefix) or (not inner and not ends):
                # The node, or a lone key, parts ways with the new key here.
                split = Inner(node.prefix[:shared])
                if shared < len(node.prefix):
                    split.add(node.prefix[shared], node)
                    node.prefix = node.prefix[shared + 1 :]
                else:
                    split.value = node.value
                above.layout.replace(byte, split)
                node = split
            elif ends:
                node.value = value
                return
            at += shared
            if at == len(key):
                node.value = value
                return
            child = node.layout.get(key[at])
            if child is None:
                node.add(key[at], Leaf(key[at + 1 :], value))
                return
            above, byte = node, key[at]
            node, at = child, at + 1

    def get(self, key: bytes):
        node, at = self.root, 0
        while key.startswith(node.prefix, at):
            at += len(node.prefix)
            if at == len(key):
                return node.value
            node = node.layout.get(key[at]) if isinstance(node, Inner) else None
            if node is None:
                return None
            at += 1
        return None


def common(a: bytes, b: bytes) -> int:
    """Number of leading bytes that both share."""
    n = min(len(a), len(b))
    apart = int.from_bytes(a[:n], "big") ^ int.from_bytes(b[:n], "big")
    return n - (apart.bit_length() + 7) // 8
