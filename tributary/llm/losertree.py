"""k-way merging of sorted runs with a loser tree."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from typing import Any


def merge_runs(runs: list[Iterable[Any]], key) -> Iterator[Any]:
    """Items of runs that are each sorted by ``key``, in order of the key;
    equal keys come in the order of the runs.

    The inner nodes of a binary tournament keep the loser of their match, so
    after the winner is replaced by its run's next item only the matches on
    one path to the root are played again.
    """
    its = [iter(r) for r in runs]
    k = len(its)
    done = (1,)
    heads: list[tuple] = []  # ((0, key, run) or done, item)

    def pull(i: int) -> tuple:
        for item in its[i]:
            return (0, key(item), i), item
        return done, None

    heads = [pull(i) for i in range(k)]
    losers = [-1] * max(1, k)

    def better(a: int, b: int) -> bool:
        return heads[a][0] < heads[b][0]

    def play(node: int) -> int:
        """The winner below a node; losers stay in the nodes passed."""
        if node >= k:
            return node - k
        a, b = play(2 * node), play(2 * node + 1)
        winner, losers[node] = (a, b) if better(a, b) else (b, a)
        return winner

    winner = play(1) if k > 1 else 0
    while k and heads[winner][0] != done:
        yield heads[winner][1]
        heads[winner] = pull(winner)
        node = (winner + k) // 2
        while node:
            if better(losers[node], winner):
                winner, losers[node] = losers[node], winner
            node //= 2
