"""Results for parts of text that come again and again, in bounded memory."""

from __future__ import annotations

from collections.abc import Callable, Iterable


class PartCache:
    """Two generations of results: a part in use moves to the young one, and the old one goes as a whole.

    So what is frequent stays however early it was met, and at most about twice ``entries`` results are held.
    """

    def __init__(self, compute: Callable[[list[str]], Iterable], entries: int) -> None:
        self.compute, self.entries = compute, entries
        self.young: dict[str, object] = {}
        self.old: dict[str, object] = {}

    def results(self, wanted: set[str]) -> dict:
        """Results by part, among them all of ``wanted``; good until the next call."""
        if len(self.young) > self.entries:
            self.old, self.young = self.young, {}
        young, old = self.young, self.old
        fresh = wanted.difference(young)
        known = fresh.intersection(old)
        young.update((part, old[part]) for part in known)
        missing = sorted(fresh - known)
        young.update(zip(missing, self.compute(missing), strict=True))
        return young
