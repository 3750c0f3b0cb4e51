"""Many networks as one flat index: which network, first in order, holds an address.

Networks nest or are disjoint, so they form a prefix trie. Walking its nodes in
order of their addresses cuts the address space into stretches, in each of which
one network wins: a trie whose paths are compressed to the boundaries between
stretches, kept as flat arrays. A look-up is one binary search for a batch of
addresses, whatever the number of prefix lengths.
"""

from __future__ import annotations

import socket
from collections.abc import Sequence

import numpy as np

# Bytes of an address, and the socket family that parses its text.
WIDTH = {4: 4, 6: 16}
FAMILY = {4: socket.AF_INET, 6: socket.AF_INET6}


def packed(text: str, version: int) -> bytes | None:
    """The bytes of an address as ``ipaddress`` reads it: a zone must not be empty and
    holds no second ``%``; anything else that isn't an address gives None."""
    if version == 6 and "%" in text:
        text, _, zone = text.partition("%")
        if not zone or "%" in zone:
            return None
    try:
        return socket.inet_pton(FAMILY[version], text)
    except (OSError, ValueError):
        return None


class NetworkIndex:
    """Flat arrays for the networks of one version: ``starts`` of stretches, sorted, and
    the ``winner`` of each (its place in ``labels``, or -1)."""

    def __init__(self, networks: Sequence, version: int):
        self.version = version
        bits, size = 8 * WIDTH[version], WIDTH[version]
        distinct: dict[tuple[int, int], tuple[int, str]] = {}
        for net in sorted(networks, key=lambda n: n.order):
            distinct.setdefault((net.number, net.prefix), (net.order, net.label))
        self.labels: list[str] = []
        cuts: list[tuple[int, int]] = []
        # Open networks, the inner ones last: (first address after it, best order, its label).
        open_: list[tuple[int, int, int]] = []

        def close(upto: int | None) -> None:
            while open_ and (upto is None or open_[-1][0] <= upto):
                end = open_.pop()[0]
                cuts.append((end, open_[-1][2] if open_ else -1))

        for (number, prefix), (order, label) in sorted(distinct.items()):
            close(number)
            best = (order, len(self.labels))
            self.labels.append(label)
            if open_ and open_[-1][1] < order:
                best = open_[-1][1:]
            open_.append((number + (1 << (bits - prefix)), *best))
            cuts.append((number, best[1]))
        close(None)
        # Of several cuts at one address the last one counts; equal neighbours are one.
        at: dict[int, int] = {}
        for start, winner in cuts:
            at[start] = winner
        kept, before = [], -1
        for start, winner in sorted(at.items()):
            if winner != before and start < 1 << bits:
                kept.append((start, winner))
            before = winner
        self.starts = np.array([s.to_bytes(size, "big") for s, _ in kept], f"S{size}")
        self.winner = np.array([-1, *(w for _, w in kept)], np.int32)

    def nbytes(self) -> int:
        return self.starts.nbytes + self.winner.nbytes + sum(64 + len(x) for x in self.labels)

    def find(self, texts: Sequence[str | None]) -> list[str | None]:
        """The label of the first network that holds each address; None for other texts."""
        version, out = self.version, [None] * len(texts)
        mark = ":" if version == 6 else "."
        rows, keys = [], []
        for i, text in enumerate(texts):
            if text and mark in text and (key := packed(text, version)) is not None:
                rows.append(i)
                keys.append(key)
        if rows:
            wanted = np.array(keys, self.starts.dtype if len(self.starts) else f"S{WIDTH[version]}")
            winners = self.winner[np.searchsorted(self.starts, wanted, "right")]
            for i, w in zip(rows, winners.tolist()):
                if w >= 0:
                    out[i] = self.labels[w]
        return out
