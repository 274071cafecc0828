"""A rope: a text as a tree of leaves, each node knowing its code points and line ends, for cutting by unit and by code point."""

from __future__ import annotations

from collections.abc import Iterator

#: Code points of a leaf.
LEAF = 4_096


class Rope:
    """An immutable node: a leaf with a piece of text, or two subtrees. A unit is a line with its end, or what follows the last end.

    Nodes are shared between ropes and never changed, so cutting makes new nodes along one path only, and joining makes one.
    Trees of texts are balanced; a few joins add a level each, so no balancing follows.
    """

    __slots__ = ("left", "right", "text", "chars", "ends")

    def __init__(self, text: str = "", left: Rope | None = None, right: Rope | None = None):
        self.text, self.left, self.right = text, left, right
        self.chars = len(text) if left is None else left.chars + right.chars
        self.ends = text.count("\n") if left is None else left.ends + right.ends

    @classmethod
    def of(cls, text: str, leaf: int = LEAF) -> Rope:
        nodes = [cls(text[i : i + leaf]) for i in range(0, len(text), leaf)] or [cls()]
        while len(nodes) > 1:
            nodes = [cls.joined(*nodes[i : i + 2]) for i in range(0, len(nodes), 2)]
        return nodes[0]

    @classmethod
    def joined(cls, *parts: Rope) -> Rope:
        full = [p for p in parts if p.chars]
        out = full[0] if full else cls()
        for p in full[1:]:
            out = cls("", out, p)
        return out

    def leaves(self) -> Iterator[str]:
        todo = [self]
        while todo:
            node = todo.pop()
            if node.left is None:
                yield node.text
            else:
                todo += [node.right, node.left]

    def __str__(self) -> str:
        return "".join(self.leaves())

    @property
    def units(self) -> int:
        return self.ends + (self.chars > 0 and not self._last().endswith("\n"))

    def _last(self) -> str:
        node = self
        while node.left is not None:
            node = node.right
        return node.text

    def at_unit(self, rank: int) -> tuple[Rope, Rope]:
        """The first `rank` units, and the rest."""
        if rank <= 0:
            return Rope(), self
        if rank > self.ends:
            return self, Rope()
        if self.left is None:
            at = 0
            for _ in range(rank):
                at = self.text.index("\n", at) + 1
            return Rope(self.text[:at]), Rope(self.text[at:])
        if rank <= self.left.ends:
            a, b = self.left.at_unit(rank)
            return a, Rope.joined(b, self.right)
        a, b = self.right.at_unit(rank - self.left.ends)
        return Rope.joined(self.left, a), b

    def at_char(self, rank: int) -> tuple[Rope, Rope]:
        """The first `rank` code points, and the rest."""
        if rank <= 0:
            return Rope(), self
        if rank >= self.chars:
            return self, Rope()
        if self.left is None:
            return Rope(self.text[:rank]), Rope(self.text[rank:])
        if rank <= self.left.chars:
            a, b = self.left.at_char(rank)
            return a, Rope.joined(b, self.right)
        a, b = self.right.at_char(rank - self.left.chars)
        return Rope.joined(self.left, a), b

    def find(self, mark: str) -> int:
        """The rank of the code point where `mark` first begins, or -1; leaves are read with what may begin before them."""
        before, at = "", 0
        for text in self.leaves():
            seen = before + text
            if (i := seen.find(mark)) >= 0:
                return at - len(before) + i
            at += len(text)
            before = seen[-(len(mark) - 1) :] if len(mark) > 1 else ""
        return -1
