"""Brute-force statement of the completion rules, for tests only.

Stated directly from the definition (sets of prefixes and a scan of the
dictionary), independent of the prefix-table formulation in the library.
"""

from __future__ import annotations


class Direction:
    def __init__(self, counts: dict[str, int], reverse: bool):
        self.rev = reverse
        self.words = {(w[::-1] if reverse else w): c for w, c in counts.items()}
        self.nodes = {w[:i] for w in self.words for i in range(1, len(w) + 1)}

    def longest_match(self, x: str) -> int:
        return max([i for i in range(1, len(x) + 1) if x[:i] in self.nodes], default=0)

    def completions(self, p: str) -> set[tuple[str, int]]:
        """Words properly extending p with no dictionary word strictly between."""
        out = set()
        for v, c in self.words.items():
            if len(v) > len(p) and v.startswith(p) and not any(
                    v[:j] in self.words for j in range(len(p) + 1, len(v))):
                out.add((v[::-1] if self.rev else v, c))
        return out

    def attempt(self, x: str) -> tuple[set, int]:
        L = self.longest_match(x)
        if L == 0:
            return set(), 0
        found = self.completions(x[:L])
        if 1 < L < len(x):
            return found | self.completions(x[:L - 1]), L - 1
        return found, L


def complete(counts: dict[str, int], word: str, head: Direction | None = None,
             tail: Direction | None = None) -> list[str]:
    """Ranked completions of ``word`` (count desc, then word desc)."""
    head = head or Direction(counts, False)
    tail = tail or Direction(counts, True)
    w = word.lower()
    h, hp = head.attempt(w)
    t, tp = tail.attempt(w[::-1])
    res = h | t if tp > hp else h
    return [v for v, c in sorted(res, key=lambda x: (x[1], x[0]), reverse=True)]
