"""Hierarchical navigable small-world graphs over unit vectors, many queries at a time."""

from __future__ import annotations

import numpy as np

LINKS = 16
BUILD_BEAM = 48
QUERIES_AT_ONCE = 256
EXPANDED = 4
# A beam wider than this share of the graph costs more than a product with all its points.
WIDE = 1 / 16
# An audit draws queries until so many have partners, or so many blocks of queries are drawn.
PARTNERED, AUDIT_BLOCKS = 16, 8


class Graph:
    """A graph over the rows of ``vectors`` (unit length, float32).

    Points come in rounds that double up to a bound; the points of a round
    search the graph so far and each other, take diverse near neighbours and
    are linked back.
    """

    def __init__(self, vectors: np.ndarray, links: int = LINKS, seed: int = 5) -> None:
        self.x = np.ascontiguousarray(vectors, np.float32)
        n = len(self.x)
        draw = np.random.default_rng(seed)
        level = np.minimum((-np.log(draw.random(n)) / np.log(links)).astype(int), 6) if n else np.zeros(0, int)
        order = draw.permutation(n)
        if n:
            level[order[0]] = level.max()
        self.level = level
        self.entry = int(order[0]) if n else -1
        self.near = [np.full((n, 2 * links if k == 0 else links), -1, np.int32) for k in range(level.max() + 1 if n else 0)]
        done = 1
        while done < n:
            batch = order[done : done + min(max(done, 1), QUERIES_AT_ONCE)]
            self._insert(batch)
            done += len(batch)

    def _insert(self, batch: np.ndarray) -> None:
        x = self.x[batch]
        among = x @ x.T
        np.fill_diagonal(among, -2)
        start = np.full((len(batch), 1), self.entry)
        for k in range(len(self.near) - 1, -1, -1):
            ids, sims = self._beam(x, start, BUILD_BEAM, k)
            start = ids[:, :8]
            at = np.flatnonzero(self.level[batch] >= k)
            if not len(at):
                continue
            peers = np.where(self.level[batch] >= k, among[at], -2)
            top = np.argsort(-peers, 1)[:, : self.near[k].shape[1]]
            both = np.concatenate([ids[at], batch[top]], 1)
            both_sims = np.concatenate([sims[at], np.take_along_axis(peers, top, 1)], 1)
            both[both_sims <= -2] = -1
            chosen = self._diverse(both, both_sims, self.near[k].shape[1] // 2)
            self.near[k][batch[at], : chosen.shape[1]] = chosen
            src = np.repeat(batch[at], chosen.shape[1])
            self._link_back(k, chosen.ravel(), src)

    def _link_back(self, k: int, to: np.ndarray, src: np.ndarray) -> None:
        src, to = src[to >= 0], to[to >= 0]
        order = np.argsort(to, kind="stable")
        to, src = to[order], src[order]
        nodes, first, count = np.unique(to, return_index=True, return_counts=True)
        width = self.near[k].shape[1]
        for s in range(0, len(nodes), 512):
            u, c = nodes[s : s + 512], count[s : s + 512]
            new = np.full((len(u), c.max()), -1, np.int32)
            cols = np.arange(c.max())
            take = cols[None] < c[:, None]
            new[take] = src[(first[s : s + 512, None] + cols)[take]]
            both = np.concatenate([self.near[k][u], new], 1)
            sims = np.where(both >= 0, np.einsum("ucd,ud->uc", self.x[both], self.x[u], optimize=True), -2)
            best = np.argsort(-sims, 1, kind="stable")
            both, sims = np.take_along_axis(both, best, 1), np.take_along_axis(sims, best, 1)
            full = (both >= 0).sum(1) > width
            kept = both[:, :width].copy()
            if full.any():
                kept[full] = self._diverse(both[full], sims[full], width)
            self.near[k][u] = kept

    def _diverse(self, ids: np.ndarray, sims: np.ndarray, most: int) -> np.ndarray:
        """Of each row the nearest that are nearer to the point than to one another, then the nearest others."""
        order = np.argsort(-np.where(ids >= 0, sims, -2), 1, kind="stable")[:, : 3 * most]
        ids, sims = np.take_along_axis(ids, order, 1), np.take_along_axis(sims, order, 1)
        x = self.x[ids]
        cross = np.matmul(x, x.transpose(0, 2, 1))
        rank = np.full(ids.shape, np.inf)
        taken = np.zeros(ids.shape, bool)
        for c in range(ids.shape[1]):
            ok = (ids[:, c] >= 0) & (np.where(taken, cross[:, c], -2).max(1) < sims[:, c]) & (taken.sum(1) < most)
            taken[:, c] = ok
        rank = np.where(taken, 0, np.where(ids >= 0, 1, 2)) * 10_000 + np.arange(ids.shape[1])
        order = np.argsort(rank, 1)[:, :most]
        out = np.take_along_axis(ids, order, 1)
        return np.pad(out, ((0, 0), (0, most - out.shape[1])), constant_values=-1)

    def _beam(self, q: np.ndarray, start: np.ndarray, width: int, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and similarities of the ``width`` best found of each query, best first; -1 where there are fewer."""
        rows = np.arange(len(q))[:, None]
        seen = np.zeros((len(q), len(self.x) + 1), bool)
        ids = np.full((len(q), width + start.shape[1]), -1)
        ids[:, : start.shape[1]] = start
        sims = np.where(ids >= 0, np.einsum("qcd,qd->qc", self.x[ids], q, optimize=True), -2).astype(np.float32)
        seen[rows, ids] = True
        seen[:, -1] = True
        open_ = ids >= 0
        order = np.argsort(-sims, 1, kind="stable")[:, :width]
        ids, sims, open_ = (np.take_along_axis(a, order, 1) for a in (ids, sims, open_))
        live = np.arange(len(q))
        while len(live):
            waiting = np.where(open_[live], sims[live], -3)
            pick = np.argpartition(-waiting, min(EXPANDED, width) - 1, 1)[:, :EXPANDED]
            has = np.take_along_axis(waiting, pick, 1) > -3
            some = has.any(1)
            live, pick, has = live[some], pick[some], has[some]
            if not len(live):
                break
            at = np.where(has, ids[live[:, None], pick], -1)
            open_[live[:, None], pick] = False
            nbrs = np.where(at[..., None] >= 0, self.near[k][at], -1).reshape(len(live), -1)
            nbrs = np.where(seen[live[:, None], nbrs], -1, nbrs)
            srt = np.sort(nbrs, 1)  # a neighbour of two expanded points comes once
            srt[:, 1:][srt[:, 1:] == srt[:, :-1]] = -1
            nbrs = srt
            seen[live[:, None], nbrs] = True
            found = np.where(nbrs >= 0, np.einsum("qcd,qd->qc", self.x[nbrs], q[live], optimize=True), -2).astype(np.float32)
            all_ids = np.concatenate([ids[live], nbrs], 1)
            all_sims = np.concatenate([sims[live], found], 1)
            all_open = np.concatenate([open_[live], nbrs >= 0], 1)
            top = np.argpartition(-all_sims, width - 1, 1)[:, :width]
            ids[live], sims[live], open_[live] = (np.take_along_axis(a, top, 1) for a in (all_ids, all_sims, all_open))
        order = np.argsort(-sims, 1, kind="stable")
        return np.take_along_axis(ids, order, 1), np.take_along_axis(sims, order, 1)

    def search(self, q: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
        """Approximately the ``width`` nearest of each query: ids (-1 for none) and similarities."""
        width = max(1, min(width, len(self.x)))
        q = np.ascontiguousarray(q, np.float32)
        out = []
        for s in range(0, len(q), QUERIES_AT_ONCE):
            part = q[s : s + QUERIES_AT_ONCE]
            start = np.full((len(part), 1), self.entry)
            for k in range(len(self.near) - 1, 0, -1):
                start = self._beam(part, start, 8, k)[0][:, :4]
            out.append(self._beam(part, start, width, 0))
        return tuple(np.concatenate(x) for x in zip(*out, strict=True))

    def within(self, q: np.ndarray, least: float, width: int, audit: int = 64, recall: float = 0.99) -> tuple[np.ndarray, np.ndarray]:
        """(query, point) pairs of similarity ``least`` or more.

        The beam of a query widens until its worst member is out; one that
        would widen past WIDE of the graph gives way to products with all its
        points, which are exact. The beams of all widen until the audited
        queries, compared with every point, find at least ``recall`` of their
        partners, each query counting alike. ``audit`` queries are drawn at a
        time.
        """
        if not len(self.x) or not len(q):
            return np.empty(0, np.int64), np.empty(0, np.int64)
        q = np.ascontiguousarray(q, np.float32)
        drawn = np.random.default_rng(len(q)).permutation(len(q))[: audit * AUDIT_BLOCKS]
        tried, partners = [], 0
        for s in range(0, len(drawn), audit):
            part = drawn[s : s + audit]
            truth = q[part] @ self.x.T >= least
            some = truth.any(1)
            tried += list(zip(part[some].tolist(), truth[some].sum(1).tolist(), strict=True))
            # A query that is its own only partner says nothing.
            partners += int((truth.sum(1) > 1).sum())
            if partners >= PARTNERED:
                break
        while True:
            rows, points = self._pairs(q, least, width)
            found = np.bincount(rows, minlength=len(q))
            if width >= len(self.x) or np.mean([found[i] / n for i, n in tried] or [1.0]) >= recall:
                return rows, points
            width = 2 * width if width <= WIDE * len(self.x) else len(self.x)

    def _pairs(self, q: np.ndarray, least: float, width: int) -> tuple[np.ndarray, np.ndarray]:
        out, asked = [], np.arange(len(q))
        first = True
        while len(asked) and (first or width <= WIDE * len(self.x)):
            ids, sims = self.search(q[asked], width)
            more = (sims[:, -1] >= least) & (width < len(self.x))
            rows, cols = np.nonzero((sims >= least) & (ids >= 0) & ~more[:, None])
            out.append((asked[rows], ids[rows, cols].astype(np.int64)))
            asked, width, first = asked[more], 4 * width, False
        for s in range(0, len(asked), QUERIES_AT_ONCE):
            rows, points = np.nonzero(q[asked[s : s + QUERIES_AT_ONCE]] @ self.x.T >= least)
            out.append((asked[s + rows], points.astype(np.int64)))
        return tuple(np.concatenate(x) for x in zip(*out, strict=True))
