"""K-way merge of sorted runs by a tree of losers."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

from starfold.session import ship_by_value

ship_by_value(__name__)


class LoserTree:
    """Merges sorted iterables; each item costs one match for each level of the tree.

    Inner node i holds the loser of the match between its two subtrees, the overall
    winner stands apart. Equal items come in the order of their runs, so the merge is
    stable. A run that has ended loses every match.
    """

    def __init__(self, runs: Iterable[Iterable]):
        self.runs = [iter(r) for r in runs]
        self.heads = [next(r, None) for r in self.runs]
        self.k = len(self.runs)
        self.losers = [-1] * max(self.k, 1)
        self.winner = self._play(1) if self.k else -1

    def _before(self, a: int, b: int) -> bool:
        x, y = self.heads[a], self.heads[b]
        if x is None or y is None:
            return y is None and (x is not None or a < b)
        return (x, a) < (y, b)

    def _play(self, node: int) -> int:
        """Winner below a node; leaves are the nodes from k on."""
        if node >= self.k:
            return node - self.k
        a, b = self._play(2 * node), self._play(2 * node + 1)
        won, lost = (a, b) if self._before(a, b) else (b, a)
        self.losers[node] = lost
        return won

    def __iter__(self) -> Iterator:
        while self.k and (item := self.heads[self.winner]) is not None:
            yield item
            at = self.winner
            self.heads[at] = next(self.runs[at], None)
            node = (at + self.k) // 2
            while node >= 1:
                if self._before(self.losers[node], at):
                    self.losers[node], at = at, self.losers[node]
                node //= 2
            self.winner = at
