"""Hierarchical navigable small-world graphs over unit vectors, as flat arrays.

Nodes are inserted in blocks and searched in blocks: a block of queries walks
the graph in step, each step one gather and one batched product, so the work
is in numpy and not in a Python loop per node. A graph holds one shard, whose
size the callers bound. What a step gathers and marks beside it is taken in
bands of bounded size, whatever the block, the shard and the dimension.
"""

from __future__ import annotations

import numpy as np

NONE = np.int32(-1)
#: Numbers that a step gathers at a time, and marks (rows x nodes) that a walk holds.
GATHERED, SEEN = 1 << 20, 1 << 25


class Graph:
    """``links[l]`` is the flat neighbour array of layer l: one row per node of the layer, padded with -1.

    Layer 0 holds all nodes; ``slot[l][node]`` is a node's row in layer l or -1.
    """

    def __init__(self, x: np.ndarray, width: int = 16, ef: int = 64, seed: int = 7):
        self.x = np.ascontiguousarray(x, dtype=np.float32)
        self.width = width
        self.ef = ef
        n = len(x)
        draw = np.random.default_rng(seed).random(n)
        level = np.minimum((-np.log(np.maximum(draw, 1e-12)) / np.log(width)).astype(np.int64), 8)
        top = int(level.max()) if n else 0
        self.slot, self.links = [], []
        for layer in range(top + 1):
            inside = np.flatnonzero(level >= layer)
            slot = np.full(n, NONE, dtype=np.int32)
            slot[inside] = np.arange(len(inside), dtype=np.int32)
            self.slot.append(slot)
            self.links.append(np.full((len(inside), width * (2 if layer == 0 else 1)), NONE, dtype=np.int32))
        # a node of the top layer comes first, as the place where every walk starts
        order = np.argsort(-level, kind="stable") if n else np.zeros(0, dtype=np.int64)
        self.entry = int(order[0]) if n else -1
        rest = np.random.default_rng(seed + 1).permutation(order[1:]) if n else order
        self.level = level
        done, size = 1, 64
        while done - 1 < len(rest):
            block = rest[done - 1:done - 1 + size]
            self._insert(block, level)
            done += len(block)
            size = int(min(1024, max(64, done // 2)))

    @classmethod
    def restored(cls, x: np.ndarray, entry: int, slots: list[np.ndarray], links: list[np.ndarray]) -> "Graph":
        g = cls.__new__(cls)
        g.x, g.entry, g.slot, g.links = x, entry, slots, links
        return g

    # -- building -------------------------------------------------------------

    def _insert(self, block: np.ndarray, level: np.ndarray) -> None:
        q = self.x[block]
        enter = np.full((len(block), 1), self.entry, dtype=np.int32)
        near = q @ q.T
        np.fill_diagonal(near, -np.inf)
        for layer in range(len(self.links) - 1, -1, -1):
            ids, sims = self._walks(q, enter, layer, 1 if layer else self.ef)
            mine = np.flatnonzero(level[block] >= layer)
            if layer and len(mine):
                wide, wide_s = self._walks(q[mine], enter[mine], layer, self.ef)
            else:
                wide, wide_s = ids[mine], sims[mine]
            if len(mine):
                self._link(block[mine], wide, wide_s, near[np.ix_(mine, mine)], layer)
            enter = ids[:, :8] if layer == 0 else ids[:, :1]

    def _link(self, nodes, found, sims, near, layer) -> None:
        k = min(32, len(nodes) - 1)
        if k > 0:
            pick = np.argpartition(-near, k - 1, axis=1)[:, :k] if k < near.shape[1] else np.argsort(-near, axis=1)[:, :k]
            found = np.concatenate([found, nodes[pick].astype(np.int32)], axis=1)
            sims = np.concatenate([sims, np.take_along_axis(near, pick, axis=1)], axis=1)
        slot, links = self.slot[layer], self.links[layer]
        chosen = self._spread(found, sims, self.width)
        links[slot[nodes], :self.width] = chosen
        # the way back: gather what points at each node and choose again among old and new
        src = np.repeat(nodes.astype(np.int32), chosen.shape[1])
        dst = chosen.ravel()
        ok = dst >= 0
        src, dst = src[ok], dst[ok]
        if not len(dst):
            return
        by = np.lexsort((-self._dots(src, self.x, dst), dst))
        src, dst = src[by], dst[by]
        who, first, count = np.unique(dst, return_index=True, return_counts=True)
        room = int(min(count.max(), 64))
        new = np.full((len(who), room), NONE, dtype=np.int32)
        at = np.arange(len(dst)) - np.repeat(first, count)
        keep = at < room
        new[np.repeat(np.arange(len(who)), count)[keep], at[keep]] = src[keep]
        step = max(1, GATHERED // ((links.shape[1] + room) * self.x.shape[1]))
        for i in range(0, len(who), step):
            to = who[i:i + step]
            both = np.concatenate([links[slot[to]], new[i:i + step]], axis=1)
            s = np.einsum("ikd,id->ik", self.x[np.maximum(both, 0)], self.x[to])
            s[both < 0] = -np.inf
            links[slot[to]] = self._spread(both, s, links.shape[1], fill=True)

    def _spread(self, found, sims, width, fill: bool = True) -> np.ndarray:
        """Up to ``width`` of the found nodes per row, each nearer to the row than to one chosen before;
        places left over go to the nearest of the rest."""
        most = min(found.shape[1], max(64, width + 32))
        step = max(1, GATHERED // (most * max(most, self.x.shape[1])))
        if len(found) > step:
            return np.concatenate([self._spread(found[i:i + step], sims[i:i + step], width, fill)
                                   for i in range(0, len(found), step)])
        by = np.argsort(-sims, axis=1, kind="stable")[:, :most]
        found, sims = np.take_along_axis(found, by, axis=1), np.take_along_axis(sims, by, axis=1)
        # a node may have been found twice (walk and block): equal ids are masked
        order = np.argsort(found, axis=1, kind="stable")
        f = np.take_along_axis(found, order, axis=1)
        twice = np.zeros(found.shape, dtype=bool)
        np.put_along_axis(twice, order[:, 1:], f[:, 1:] == f[:, :-1], axis=1)
        sims = np.where(twice | (found < 0), -np.inf, sims)
        v = self.x[np.maximum(found, 0)]
        among = v @ v.transpose(0, 2, 1)
        rows, cols = found.shape
        taken = np.zeros((rows, cols), dtype=bool)
        nearest = np.full((rows, cols), -np.inf, dtype=np.float32)  # to any chosen one
        count = np.zeros(rows, dtype=np.int64)
        for c in range(cols):
            ok = (sims[:, c] > nearest[:, c]) & np.isfinite(sims[:, c]) & (count < width)
            taken[:, c] = ok
            count += ok
            nearest = np.where(ok[:, None], np.maximum(nearest, among[:, c, :]), nearest)
        score = np.where(taken, 2, 0) + np.where(np.isfinite(sims), 1, 0)
        rank = np.argsort(-score, axis=1, kind="stable")[:, :width]
        out = np.take_along_axis(found, rank, axis=1)
        good = np.take_along_axis(score, rank, axis=1) >= (1 if fill else 2)
        out = np.where(good, out, NONE)
        if out.shape[1] < width:
            out = np.pad(out, ((0, 0), (0, width - out.shape[1])), constant_values=NONE)
        return out.astype(np.int32)

    # -- searching ------------------------------------------------------------

    def _dots(self, to, q, who) -> np.ndarray:
        """The products of the nodes ``to`` with the rows ``who`` of ``q``."""
        out, step = np.empty(len(to), dtype=np.float32), max(1, GATHERED // self.x.shape[1])
        for i in range(0, len(to), step):
            out[i:i + step] = np.einsum("id,id->i", self.x[to[i:i + step]], q[who[i:i + step]])
        return out

    def _walks(self, q, enter, layer, ef):
        """``_walk`` by bands of rows, whose marks fit ``SEEN``."""
        size = max(16, SEEN // len(self.x))
        parts = [self._walk(q[i:i + size], enter[i:i + size], layer, ef) for i in range(0, max(1, len(q)), size)]
        return tuple(np.concatenate(x) for x in zip(*parts))

    def _walk(self, q, enter, layer, ef, step: int = 4):
        """Beam search of every row of ``q`` in one layer; ids (rows, ef) and similarities, best first."""
        rows, n = len(q), len(self.x)
        slot, links = self.slot[layer], self.links[layer]
        step = min(step, ef)
        ids = np.full((rows, ef), NONE, dtype=np.int32)
        sims = np.full((rows, ef), -np.inf, dtype=np.float32)
        done = np.zeros((rows, ef), dtype=bool)
        seen = np.zeros((rows, n), dtype=bool)
        e = enter[:, :ef]
        s = np.einsum("ikd,id->ik", self.x[np.maximum(e, 0)], q)
        s[e < 0] = -np.inf
        ids[:, :e.shape[1]], sims[:, :e.shape[1]] = e, s
        r, c = np.nonzero(e >= 0)
        seen[r, e[r, c]] = True
        live = np.arange(rows)
        while len(live):
            open_s = np.where(done[live], -np.inf, sims[live])
            if ef > step:
                pick = np.argpartition(-open_s, step - 1, axis=1)[:, :step]
            else:
                pick = np.broadcast_to(np.arange(ef), (len(live), ef))
            ok = np.isfinite(np.take_along_axis(open_s, pick, axis=1))
            going = ok.any(axis=1)
            live, pick, ok = live[going], pick[going], ok[going]
            if not len(live):
                break
            node = np.take_along_axis(ids[live], pick, axis=1)
            r, c = np.nonzero(ok)
            done[live[r], pick[r, c]] = True
            nb = links[slot[np.where(ok, node, self.entry)]]
            nb = np.where(ok[:, :, None], nb, NONE).reshape(len(live), -1)
            r, c = np.nonzero(nb >= 0)
            who, to = live[r], nb[r, c]
            fresh = ~seen[who, to]
            r, who, to = r[fresh], who[fresh], to[fresh]
            # the same neighbour may stand in several lists of one step
            key = who.astype(np.int64) * n + to
            _, first = np.unique(key, return_index=True)
            r, who, to = r[first], who[first], to[first]
            if not len(r):
                continue
            seen[who, to] = True
            s = self._dots(to, q, who)
            starts = np.searchsorted(r, np.arange(len(live) + 1))
            size = int(np.diff(starts).max())
            new = np.full((len(live), size), NONE, dtype=np.int32)
            new_s = np.full((len(live), size), -np.inf, dtype=np.float32)
            at = np.arange(len(r)) - starts[r]
            new[r, at], new_s[r, at] = to, s
            all_s = np.concatenate([sims[live], new_s], axis=1)
            top = np.argpartition(-all_s, ef - 1, axis=1)[:, :ef]
            ids[live] = np.take_along_axis(np.concatenate([ids[live], new], axis=1), top, axis=1)
            sims[live] = np.take_along_axis(all_s, top, axis=1)
            done[live] = np.take_along_axis(np.concatenate([done[live], np.zeros(new.shape, dtype=bool)], axis=1), top, axis=1)
        by = np.argsort(-sims, axis=1, kind="stable")
        return np.take_along_axis(ids, by, axis=1), np.take_along_axis(sims, by, axis=1)

    def search(self, q: np.ndarray, ef: int, block: int = 256):
        """ids and similarities (rows, min(ef, nodes)), best first; -1 fills up."""
        n = len(self.x)
        ef = max(1, min(ef, n))
        ids, sims = np.full((len(q), ef), NONE, dtype=np.int32), np.full((len(q), ef), -np.inf, dtype=np.float32)
        if not n:
            return ids, sims
        q = np.ascontiguousarray(q, dtype=np.float32)
        block = max(16, min(block, SEEN // n))
        for i in range(0, len(q), block):
            part = q[i:i + block]
            enter = np.full((len(part), 1), self.entry, dtype=np.int32)
            for layer in range(len(self.links) - 1, 0, -1):
                enter, _ = self._walk(part, enter, layer, 1)
            ids[i:i + block], sims[i:i + block] = self._walk(part, enter, 0, ef)
        return ids, sims

    # -- storage --------------------------------------------------------------

    def packed(self) -> dict:
        """Flat arrays as bytes: members and neighbour rows of all layers, one after another."""
        members = [np.flatnonzero(s >= 0).astype("<i4") for s in self.slot]
        return {
            "entry": self.entry,
            "layer_sizes": [len(m) for m in members],
            "layer_widths": [li.shape[1] for li in self.links],
            "members": b"".join(m.tobytes() for m in members),
            "neighbours": b"".join(li.astype("<i4").tobytes() for li in self.links),
        }

    @classmethod
    def unpacked(cls, x: np.ndarray, entry: int, sizes, widths, members: bytes, neighbours: bytes) -> "Graph":
        flat_m, flat_n = np.frombuffer(members, dtype="<i4"), np.frombuffer(neighbours, dtype="<i4")
        slots, links, m, k = [], [], 0, 0
        for size, width in zip(sizes, widths):
            slot = np.full(len(x), NONE, dtype=np.int32)
            slot[flat_m[m:m + size]] = np.arange(size, dtype=np.int32)
            slots.append(slot)
            links.append(flat_n[k:k + size * width].reshape(size, width))
            m, k = m + size, k + size * width
        return cls.restored(np.ascontiguousarray(x, dtype=np.float32), entry, slots, links)
