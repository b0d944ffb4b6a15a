"""Hierarchical navigable small-world graphs of unit vectors, built and searched in blocks.

Layers hold nested subsets of the rows, each about a ``fan``-th of the one below. A graph
of a layer joins each row with near rows of it. A search compares the top layer, takes the
best of it, walks down, and at the bottom widens a beam over the neighbours of its best
rows, for a block of queries at once. A row whose neighbours are all unlike the query is
reached only from near its place; so the top layer is large, and a search enters at many
of its rows, which costs less than the wide beam that would find the row from afar.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass(frozen=True)
class GraphSettings:
    """``degree``: near rows that a row is joined with, and at most so many that join it.
    ``fan``: how many times smaller each layer is. ``top``: rows of the top layer at most.
    ``enter``: rows of a layer at which a search goes down. ``build_beam``: beam of the
    searches that place new rows. ``expand``: beam rows whose neighbours a step reads."""

    degree: int = 16
    fan: int = 4
    top: int = 8192
    enter: int = 32
    build_beam: int = 64
    expand: int = 16
    block: int = 256


class Graph:
    def __init__(self, vectors: np.ndarray, settings: GraphSettings = GraphSettings()) -> None:
        self.settings = settings
        self.vectors = np.ascontiguousarray(vectors, dtype=np.float32)
        n = len(vectors)
        # Rows come in hashed order, so a prefix is a random sample.
        sizes = [n]
        while sizes[-1] > (4 * settings.fan if len(sizes) == 1 else settings.top):
            sizes.append(sizes[-1] // settings.fan)
        self.sizes = sizes[::-1]
        self.layers: list[np.ndarray] = []
        for size in self.sizes:
            self.layers.append(self._build(size))

    @classmethod
    def restored(
        cls,
        vectors: np.ndarray,
        sizes: list[int],
        layers: list[np.ndarray],
        settings: GraphSettings,
    ) -> Graph:
        graph = cls.__new__(cls)
        graph.settings, graph.sizes, graph.layers = settings, sizes, layers
        graph.vectors = np.ascontiguousarray(vectors, dtype=np.float32)
        return graph

    def _build(self, size: int) -> np.ndarray:
        """Neighbours of the layer's rows, -1 where there are fewer."""
        degree, layer = self.settings.degree, len(self.layers)
        near = np.full((size, degree), -1, dtype=np.int32)
        joined = np.full((size, 2 * degree), -1, dtype=np.int32)
        done = min(size, self.sizes[max(layer - 1, 0)])
        for low in range(0, done, self.settings.block):
            part = np.arange(low, min(done, low + self.settings.block))
            near[part] = self._nearest(part, np.arange(done))
        self._join(joined, near, 0, done)
        while done < size:
            end = min(size, 2 * done)
            rows = np.arange(done, end)
            for low in range(0, len(rows), self.settings.block):
                part = rows[low : low + self.settings.block]
                found, _ = self._search(
                    self.vectors[part], layer, joined[:done], self.settings.build_beam
                )
                # New rows of the block are near rows too.
                near[part] = self._nearest(part, part, found[:, : 2 * degree])
            self._join(joined, near, done, end)
            done = end
        return joined

    def _nearest(
        self, rows: np.ndarray, others: np.ndarray, found: np.ndarray | None = None
    ) -> np.ndarray:
        degree = self.settings.degree
        like = self.vectors[rows] @ self.vectors[others].T
        like[rows[:, None] == others[None, :]] = -2
        ids = np.broadcast_to(others, like.shape)
        if found is not None:
            more = np.einsum("qd,qkd->qk", self.vectors[rows], self.vectors[found])
            more[found < 0] = -2
            like, ids = np.hstack([like, more]), np.hstack([ids, found])
        k = min(degree, like.shape[1])
        best = np.argpartition(-like, k - 1, axis=1)[:, :k]
        out = np.full((len(rows), degree), -1, dtype=np.int32)
        chosen = np.take_along_axis(ids, best, axis=1)
        out[:, :k] = np.where(np.take_along_axis(like, best, axis=1) > -2, chosen, -1)
        return out

    def _join(self, joined: np.ndarray, near: np.ndarray, low: int, high: int) -> None:
        """Add the links of rows ``low`` to ``high`` in both directions; a row keeps its
        own ``degree`` and of those that join it the nearest."""
        degree = self.settings.degree
        joined[low:high, :degree] = near[low:high]
        ends = near[low:high].ravel()
        start = np.repeat(np.arange(low, high, dtype=np.int32), degree)
        start, ends = start[ends >= 0], ends[ends >= 0]
        old = joined[:high, degree:]
        kept_end, slot = np.nonzero(old >= 0)
        start = np.concatenate([start, old[kept_end, slot]])
        ends = np.concatenate([ends, kept_end])
        like = np.einsum("kd,kd->k", self.vectors[start], self.vectors[ends])
        order = np.lexsort((-like, ends))
        start, ends = start[order], ends[order]
        first = np.searchsorted(ends, np.arange(high))
        place = np.arange(len(ends)) - first[ends]
        fits = place < degree
        joined[:high, degree:] = -1
        joined[ends[fits], degree + place[fits]] = start[fits]

    def _search(
        self, queries: np.ndarray, layer: int, bottom: np.ndarray, beam: int
    ) -> tuple[np.ndarray, np.ndarray]:
        """(rows, likeness), best first, of a walk from the top to ``bottom``."""
        top = self.sizes[0] if layer else min(len(bottom), self.sizes[0])
        like = queries @ self.vectors[:top].T
        k = min(self.settings.enter, top)
        np.negative(like, out=like)
        entry = np.argpartition(like, k - 1, axis=1)[:, :k].astype(np.int32)
        for level in range(1, layer):
            entry, _ = self._walk(queries, self.layers[level], entry, k)
        return self._walk(queries, bottom, entry, beam)

    def _walk(
        self, queries: np.ndarray, links: np.ndarray, entry: np.ndarray, beam: int
    ) -> tuple[np.ndarray, np.ndarray]:
        n, q = len(links), len(queries)
        width = max(beam, entry.shape[1])
        seen = np.zeros((q, n + 1), dtype=bool)
        seen[:, n] = True
        ids = np.full((q, width), -1, dtype=np.int32)
        like = np.full((q, width), -2, dtype=np.float32)
        entry = np.where((entry >= 0) & (entry < n), entry, -1)
        ids[:, : entry.shape[1]] = entry
        found = np.einsum("qd,qkd->qk", queries, self.vectors[entry])
        like[:, : entry.shape[1]] = np.where(entry >= 0, found, -2)
        np.put_along_axis(seen, np.where(entry < 0, n, entry), True, axis=1)
        opened = ids < 0
        active = np.arange(q)
        expand = self.settings.expand
        while len(active):
            rest = np.where(opened[active], -3, like[active])
            k = min(expand, width)
            pick = np.argpartition(-rest, k - 1, axis=1)[:, :k]
            live = np.take_along_axis(rest, pick, axis=1) > -2
            going = live.any(axis=1)
            active, pick, live = active[going], pick[going], live[going]
            if not len(active):
                break
            rows = np.arange(len(active))[:, None]
            chosen = np.where(live, ids[active[:, None], pick], -1)
            opened[active[:, None], pick] = True
            new = np.where(chosen[:, :, None] >= 0, links[chosen], -1).reshape(len(active), -1)
            new = np.where(new < 0, n, new)
            # A row that two expanded rows share is taken once.
            new.sort(axis=1)
            new[:, 1:][new[:, 1:] == new[:, :-1]] = n
            new = np.where(seen[active[:, None], new], n, new)
            seen[active[:, None], new] = True
            where = np.nonzero(new < n)
            value = np.full(new.shape, -2, dtype=np.float32)
            value[where] = np.einsum(
                "kd,kd->k", queries[active[where[0]]], self.vectors[new[where]]
            )
            all_like = np.hstack([like[active], value])
            all_ids = np.hstack([ids[active], np.where(new < n, new, -1)])
            all_open = np.hstack([opened[active], new >= n])
            best = np.argpartition(-all_like, width - 1, axis=1)[:, :width]
            like[active] = all_like[rows, best]
            ids[active] = all_ids[rows, best]
            opened[active] = all_open[rows, best]
        order = np.argsort(-like, axis=1)
        return np.take_along_axis(ids, order, axis=1), np.take_along_axis(like, order, axis=1)

    def search(self, queries: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
        """(rows, likeness) of near rows of each query, best first: ``beam`` of them, or
        ``enter`` if that is more, as far as there are rows."""
        bottom = len(self.layers) - 1
        queries = np.ascontiguousarray(queries, dtype=np.float32)
        return self._search(queries, bottom, self.layers[-1], min(beam, self.sizes[-1]))
