"""A hierarchical navigable small-world graph in numpy, searched for many queries in step."""

from __future__ import annotations

import numpy as np


def _top(scores: np.ndarray, ids: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``n`` best columns of each row, best first."""
    if scores.shape[1] > n:
        part = np.argpartition(-scores, n - 1, axis=1)[:, :n]
        scores, ids = np.take_along_axis(scores, part, 1), np.take_along_axis(ids, part, 1)
    order = np.argsort(-scores, axis=1, kind="stable")
    return np.take_along_axis(scores, order, 1), np.take_along_axis(ids, order, 1)


class Graph:
    """Unit vectors linked to near ones on each layer; layer 0 holds all of them.

    Vectors enter in growing batches: a batch searches the graph built so far and
    itself, takes its nearest as links, and links back.  A full list keeps its
    nearest, and every fourth place is given to a link that crosses to a farther part.
    """

    def __init__(self, vectors: np.ndarray, links: int = 16, beam: int = 40, batch: int = 512, seed: int = 5) -> None:
        self.v = np.ascontiguousarray(vectors, np.float32)
        self.links = links
        n = len(self.v)
        rng = np.random.default_rng(seed)
        level = np.minimum((-np.log(rng.random(n) + 1e-12) / np.log(links)).astype(int), 6)
        order = rng.permutation(n)
        top = level.max(initial=0)
        # Members of each layer, in the order in which they enter; upper layers are small graphs of their own.
        self.layers: list[np.ndarray] = []
        self.neighbours: list[np.ndarray] = []
        self.place: list[np.ndarray] = []
        for k in range(top, -1, -1):
            members = order[level[order] >= k]
            width = links if k else 2 * links
            self.layers.append(members)
            place = np.full(n, -1, np.int64)
            place[members] = np.arange(len(members))
            self.place.append(place)
            self.neighbours.append(np.full((len(members), width), -1, np.int64))
            self._build(len(self.layers) - 1, beam, batch)

    def state(self) -> tuple:
        """Plain arrays from which ``restored`` makes the graph again."""
        return self.v, self.links, self.layers, self.neighbours

    @classmethod
    def restored(cls, state: tuple) -> Graph:
        graph = cls.__new__(cls)
        graph.v, graph.links, graph.layers, graph.neighbours = state
        graph.place = []
        for members in graph.layers:
            place = np.full(len(graph.v), -1, np.int64)
            place[members] = np.arange(len(members))
            graph.place.append(place)
        return graph

    def _build(self, layer: int, beam: int, batch: int) -> None:
        members = self.layers[layer]
        done = 0
        while done < len(members):
            size = max(min(batch, done), 32)
            new = members[done : done + size]
            vectors = self.v[new]
            own = vectors @ vectors.T
            np.fill_diagonal(own, -2)
            own_ids = np.broadcast_to(new, own.shape)
            if done:
                entry = self._entry(vectors, layer)
                scores, ids = self._walk(vectors, entry, layer, beam, done)
                scores, ids = np.concatenate([scores, own], 1), np.concatenate([ids, own_ids], 1)
            else:
                scores, ids = own, own_ids
            scores, ids = _top(scores, ids, beam)
            ids = np.where(scores > -1.5, ids, -1)
            self._link(layer, new, scores, ids)
            done += size

    def _link(self, layer: int, new: np.ndarray, scores: np.ndarray, ids: np.ndarray) -> None:
        table, place = self.neighbours[layer], self.place[layer]
        width = table.shape[1]
        near = width * 3 // 4
        chosen = ids[:, :near]
        if ids.shape[1] > near:
            # A spread of farther candidates keeps clusters connected.
            spread = np.linspace(near, ids.shape[1] - 1, width - near).astype(int)
            chosen = np.concatenate([chosen, ids[:, spread]], 1)
        table[place[new], : chosen.shape[1]] = chosen
        source = np.repeat(new, chosen.shape[1])
        target = chosen.ravel()
        ok = target >= 0
        source, target = source[ok], target[ok]
        # Links back, many sources per target at once: each target keeps its best.
        order = np.argsort(target, kind="stable")
        source, target = source[order], target[order]
        cuts = np.flatnonzero(np.diff(target)) + 1
        for t, s in zip(target[np.concatenate([[0], cuts])].tolist() if len(target) else [], np.split(source, cuts), strict=False):
            row = table[place[t]]
            free = np.flatnonzero(row < 0)
            s = s[~np.isin(s, row)]
            if len(s) <= len(free):
                row[free[: len(s)]] = s
                continue
            every = np.concatenate([row[row >= 0], s])
            rank = np.argsort(-(self.v[every] @ self.v[t]), kind="stable")
            picked = np.concatenate([rank[:near], rank[near:][np.linspace(0, len(rank) - near - 1, width - near).astype(int)]])
            row[:] = every[picked]

    def _entry(self, queries: np.ndarray, layer: int) -> np.ndarray:
        """An entry point on ``layer`` for each query: greedy descent through the layers above."""
        at = np.full(len(queries), self.layers[0][0], np.int64)
        for k in range(layer):
            _, ids = self._walk(queries, at[:, None], k, 4, len(self.layers[k]))
            at = ids[:, 0]
        return at[:, None]

    def _walk(self, queries: np.ndarray, entry: np.ndarray, layer: int, beam: int, known: int) -> tuple[np.ndarray, np.ndarray]:
        """Best-first search of all queries in step on the first ``known`` members of a layer."""
        table, place = self.neighbours[layer], self.place[layer]
        n = len(queries)
        ids = np.full((n, beam), -1, np.int64)
        scores = np.full((n, beam), -3.0, np.float32)
        spent = np.ones((n, beam), bool)
        ids[:, : entry.shape[1]] = entry
        scores[:, : entry.shape[1]] = np.einsum("qd,qed->qe", queries, self.v[entry])
        spent[:, : entry.shape[1]] = False
        seen = np.zeros((n, len(table)), bool)
        seen[np.arange(n)[:, None], place[entry]] = True
        live = np.arange(n)
        while len(live):
            open_scores = np.where(spent[live], -3.0, scores[live])
            pick = open_scores.argmax(1)
            going = open_scores[np.arange(len(live)), pick] > -2.5
            live, pick = live[going], pick[going]
            if not len(live):
                break
            spent[live, pick] = True
            around = table[place[ids[live, pick]]]
            where = place[around]
            fresh = (around >= 0) & (where < known)
            fresh &= ~seen[live[:, None], where]
            rows, columns = np.nonzero(fresh)
            if not len(rows):
                continue
            seen[live[rows], where[rows, columns]] = True
            found = np.full(around.shape, -3.0, np.float32)
            found[rows, columns] = np.einsum("qd,qd->q", queries[live[rows]], self.v[around[rows, columns]])
            changed = np.unique(rows)
            who = live[changed]
            all_scores = np.concatenate([scores[who], found[changed]], 1)
            all_ids = np.concatenate([ids[who], around[changed]], 1)
            all_spent = np.concatenate([spent[who], found[changed] < -2.5], 1)
            best = np.argpartition(-all_scores, beam - 1, axis=1)[:, :beam]
            scores[who] = np.take_along_axis(all_scores, best, 1)
            ids[who] = np.take_along_axis(all_ids, best, 1)
            spent[who] = np.take_along_axis(all_spent, best, 1)
        order = np.argsort(-scores, axis=1, kind="stable")
        return np.take_along_axis(scores, order, 1), np.take_along_axis(ids, order, 1)

    def search(self, queries: np.ndarray, beam: int, block: int = 256) -> tuple[np.ndarray, np.ndarray]:
        """(scores, ids) of the ``beam`` nearest found for each query, best first; -1 where there are fewer."""
        queries = np.ascontiguousarray(queries, np.float32)
        out_scores, out_ids = [], []
        layer = len(self.layers) - 1
        for i in range(0, len(queries), block):
            q = queries[i : i + block]
            s, x = self._walk(q, self._entry(q, layer), layer, beam, len(self.layers[layer]))
            out_scores.append(s)
            out_ids.append(np.where(s > -2.5, x, -1))
        return np.concatenate(out_scores), np.concatenate(out_ids)
