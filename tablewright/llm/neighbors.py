"""Near-duplicate vectors: a navigable small-world graph per shard, all shards asked.

Vectors are dealt to shards; a task builds and audits the layered graph of its shard, which is written as a
table of nodes with their links.  Searches are tasks of their own, one for each shard and block of queries, so
their number grows with the table.  A search descends greedily through the sparse layers and ends with a beam in
the full one.
The beam is widened until an audit passes (a sample of the shard's own vectors must find
nearly all their brute-force neighbours above the threshold), and widened again for each query whose hits fill
half of it, up to `WIDEST`; what fills that is compared with the whole shard in blocks, so a group of any
size is found in bounded memory.  Hits are confirmed by the cosine in
double precision.  Searches run for blocks of queries at once: one step expands one node of every query.

Equal vectors are one node with a count.  A task sends on, per batch, the number of links of each query
and the edges of a spanning forest, never the pairs; components are joined from those edges.

Shards hold at most `SHARD` vectors and there are at least `SHARDS`; since every vector is compared with
every shard's graph, work grows with vectors times shards.

Vectors that are null, empty, zero, or hold null or non-finite components link with nothing; vectors of
different lengths do not link, nor do rows without an id.  Equal vectors link with each other.  An id that names
several vectors has the links of each in the row of that vector.  An empty table gives an empty result.
"""

from __future__ import annotations

import logging
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .components import components
from .frames import arrow_stage

LOG = logging.getLogger(__name__)

THRESHOLD = 0.95
SHARD, SHARDS = 100_000, 6
ASKED = 25_000  # queries of a search task, about
TASKS = 20_000  # of a search; beyond, one takes several blocks in turn
DEGREE = 12  # links of a node in the upper layers; twice that in the lowest
BUILD_BEAM, FIRST_BEAM = 48, 32
AT_ONCE = 4  # nodes of a beam that one step expands
BLOCK = 512
WIDEST = 1024  # of the beams; beyond, a query is compared with every node
EDGES = 1_000_000  # of a batch, before they are thinned to a forest
PAIRS = 2_000_000  # of queries and nodes at once
ROWS = 4_096  # nodes written at once
AUDIT, AUDIT_BLOCKS, MIN_RECALL = 256, 16, 0.995


class Graph:
    """A hierarchical navigable small world over unit vectors, built and searched in blocks.

    Nodes are ordered by their top layer, highest first, so a layer's nodes are a prefix of all.
    """

    def __init__(self, vectors: np.ndarray, seed: int = 1) -> None:
        n = len(vectors)
        top = np.floor(-np.log(1 - np.random.default_rng(seed).random(n)) / np.log(DEGREE)).astype(int)
        self.order = np.argsort(-top, kind="stable")  # node -> row of the given vectors
        self.x = np.ascontiguousarray(vectors[self.order], np.float32)
        top = top[self.order]
        self.sizes = [int((top >= level).sum()) for level in range(int(top[0]) + 1)]
        self.links = [np.full((m, DEGREE * (2 if level == 0 else 1)), -1, np.int32) for level, m in enumerate(self.sizes)]
        done = 0
        while done < n:
            more = min(n, done + min(BLOCK, max(32, done)))
            self._insert(done, more)
            done = more

    @classmethod
    def of_links(cls, x: np.ndarray, links: np.ndarray, ends: np.ndarray) -> Graph:
        """The graph again from its vectors in node order and its `adjacency`."""
        graph = cls.__new__(cls)
        starts = np.append(0, ends[:-1])
        upper = (ends - starts - 2 * DEGREE) // DEGREE  # layers of a node above the lowest
        graph.order, graph.x = np.arange(len(x)), np.ascontiguousarray(x, np.float32)
        graph.sizes = [int((upper >= level).sum()) for level in range(int(upper[0]) + 1)]
        graph.links = []
        for level, n in enumerate(graph.sizes):
            skip = DEGREE * (level + 1) if level else 0
            width = DEGREE * (1 if level else 2)
            graph.links.append(links[(starts[:n] + skip)[:, None] + np.arange(width)].astype(np.int32))
        return graph

    def adjacency(self, a: int, b: int) -> tuple[np.ndarray, np.ndarray]:
        """The links of nodes `a` to `b`, lowest layer first, each layer padded with -1, and where each node's end."""
        layers = sum(np.arange(a, b) < n for n in self.sizes)
        ends = np.cumsum(DEGREE * (layers + 1))
        links = np.full(int(ends[-1]), -1, np.int32)
        for level, n in enumerate(self.sizes):
            if (here := min(b, n) - a) > 0:
                at = np.append(0, ends[: here - 1]) + (DEGREE * (level + 1) if level else 0)
                part = self.links[level][a : a + here]
                links[at[:, None] + np.arange(part.shape[1])] = part
        return links, ends

    def _insert(self, a: int, b: int) -> None:
        entry, q = None, self.x[a:b]
        for level in range(len(self.sizes) - 1, -1, -1):
            here = min(b, self.sizes[level])
            known = min(a, self.sizes[level])
            if known == 0:
                near = np.full((b - a, 0), -1, np.int64)
            else:
                width = BUILD_BEAM if here > a else 8
                near, _ = self._beam(level, q, entry, width)
                entry = near[:, :8]
            if here > a:
                rows = here - a
                inside = q[:rows] @ q[:rows].T
                np.fill_diagonal(inside, -2)
                keep = min(rows - 1, BUILD_BEAM)
                mates = np.argpartition(-inside, keep - 1, axis=1)[:, :keep] + a if keep > 0 else np.full((rows, 0), -1)
                both = np.concatenate([near[:rows], mates], 1)
                self.links[level][a:here] = -1
                chosen = self._select(q[:rows], both, DEGREE)
                self.links[level][a:here, : chosen.shape[1]] = chosen
                self._link_back(level, np.arange(a, here), chosen)

    def _select(self, q: np.ndarray, ids: np.ndarray, most: int) -> np.ndarray:
        """The nearest candidates that are nearer to q than to one already chosen; then the nearest."""
        if ids.shape[1] == 0:
            return ids
        x = self.x[np.maximum(ids, 0)]
        near = np.where(ids >= 0, np.einsum("bcd,bd->bc", x, q), -3.0)
        order = np.argsort(-near, axis=1, kind="stable")[:, : 3 * most]
        ids, near = np.take_along_axis(ids, order, 1), np.take_along_axis(near, order, 1)
        x = np.take_along_axis(x, order[:, :, None], 1)
        between = x @ x.transpose(0, 2, 1)
        chosen = np.zeros(ids.shape, bool)
        for j in range(ids.shape[1]):
            hidden = (chosen[:, :j] & (between[:, j, :j] > near[:, j, None])).any(1)
            chosen[:, j] = (ids[:, j] >= 0) & ~hidden
        rank = np.argsort(np.where(chosen, 0, 1) + np.where(ids < 0, 2, 0), axis=1, kind="stable")[:, :most]
        return np.take_along_axis(ids, rank, 1)

    def _link_back(self, level: int, nodes: np.ndarray, chosen: np.ndarray) -> None:
        u, v = np.repeat(nodes, chosen.shape[1]), chosen.ravel()
        u, v = u[v >= 0], v[v >= 0]
        if not len(v):
            return
        near = np.einsum("ij,ij->i", self.x[u], self.x[v])
        order = np.lexsort((-near, v))
        u, v = u[order], v[order]
        names, first = np.unique(v, return_index=True)
        place = np.arange(len(v)) - np.repeat(first, np.diff(np.append(first, len(v))))
        width = self.links[level].shape[1]
        fresh = np.full((len(names), min(int(place.max()) + 1, width)), -1, np.int64)
        fits = place < fresh.shape[1]
        fresh[np.searchsorted(names, v[fits]), place[fits]] = u[fits]
        have = self.links[level][names]
        fresh[(fresh[:, :, None] == have[:, None, :]).any(2)] = -1  # linked from both sides
        # a node with room takes its new links as they are; others choose anew
        both = np.concatenate([have, fresh], 1)
        both = np.take_along_axis(both, np.argsort(both < 0, axis=1, kind="stable"), 1)
        room = (both >= 0).sum(1) <= width
        self.links[level][names[room]] = both[room, :width]
        names, both = names[~room], both[~room]
        for lo in range(0, len(names), BLOCK):
            part = slice(lo, lo + BLOCK)
            kept = self._select(self.x[names[part]], both[part], width)
            self.links[level][names[part], : kept.shape[1]] = kept

    def _beam(self, level: int, q: np.ndarray, entry: np.ndarray | None, width: int) -> tuple[np.ndarray, np.ndarray]:
        """The `width` best nodes found for each query, best first; -1 where there are fewer."""
        rows, n = len(q), self.sizes[level]
        if entry is None:
            entry = np.zeros((rows, 1), np.int64)
        ids = np.full((rows, width), -1, np.int64)
        near = np.full((rows, width), -3.0, np.float32)
        e = min(entry.shape[1], width)
        ids[:, :e] = entry[:, :e]
        near[:, :e] = np.where(ids[:, :e] >= 0, np.einsum("bcd,bd->bc", self.x[np.maximum(ids[:, :e], 0)], q), -3.0)
        seen = np.zeros((rows, n + 1), bool)  # the last column stands for -1
        seen[:, n] = True
        np.put_along_axis(seen, np.where(ids[:, :e] >= 0, ids[:, :e], n), True, 1)
        open_ = ids >= 0
        live = np.arange(rows)
        step = min(AT_ONCE, width)
        while len(live):
            score = np.where(open_[live], near[live], -4.0)
            pick = np.argpartition(-score, step - 1, axis=1)[:, :step] if step < width else np.tile(np.arange(width), (len(live), 1))
            good = np.take_along_axis(score, pick, 1) > -3.5
            going = good.any(1)
            live, pick, good = live[going], pick[going], good[going]
            if not len(live):
                break
            open_[live[:, None], pick] = False
            nodes = self.links[level][ids[live[:, None], pick]]
            nodes = np.where(good[:, :, None] & (nodes >= 0), nodes, n).reshape(len(live), -1)
            r, c = np.nonzero(~seen[live[:, None], nodes])
            if not len(r):
                continue
            # nodes expanded together may share links
            named = r * (n + 1) + nodes[r, c]
            named.sort()
            named = named[np.append(True, named[1:] != named[:-1])]
            r, found = np.divmod(named, n + 1)
            seen[live[r], found] = True
            got = np.einsum("ij,ij->i", self.x[found], q[live[r]])
            first = np.flatnonzero(np.append(True, r[1:] != r[:-1]))
            place = np.arange(len(r)) - np.repeat(first, np.diff(np.append(first, len(r))))
            extra = int(place.max()) + 1
            some = np.unique(r)
            slot = np.searchsorted(some, r)
            more_ids = np.full((len(some), extra), -1, np.int64)
            more_near = np.full((len(some), extra), -3.0, np.float32)
            more_ids[slot, place], more_near[slot, place] = found, got
            at = live[some]
            all_near = np.concatenate([near[at], more_near], 1)
            best = np.argpartition(-all_near, width - 1, axis=1)[:, :width]
            ids[at] = np.take_along_axis(np.concatenate([ids[at], more_ids], 1), best, 1)
            open_[at] = np.take_along_axis(np.concatenate([open_[at], more_ids >= 0], 1), best, 1)
            near[at] = np.take_along_axis(all_near, best, 1)
        best = np.argsort(-near, axis=1, kind="stable")
        return np.take_along_axis(ids, best, 1), np.take_along_axis(near, best, 1)

    def search(self, q: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
        """The best nodes for each query, with their cosines in single precision."""
        entry = None
        for level in range(len(self.sizes) - 1, 0, -1):
            entry, _ = self._beam(level, q, entry, 8)
        return self._beam(0, q, entry, width)

    def hits(self, q: np.ndarray, width: int, threshold: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(query, node) of all nodes found not far below the threshold, for bounded blocks of queries.

        Beams are widened as needed up to `WIDEST`; a query that fills even that is compared with all nodes.
        """
        rows, n = np.arange(len(q)), self.sizes[0]
        while len(rows):
            every, width = width > WIDEST, min(width, n)
            step = max(1, min(BLOCK, PAIRS // (n if every else width)))
            wider = []
            for lo in range(0, len(rows), step):
                part = rows[lo : lo + step]
                if every:
                    r, c = np.nonzero(q[part] @ self.x.T >= threshold - 1e-4)
                    yield part[r], c
                    continue
                ids, near = self.search(q[part], width)
                hit = near >= threshold - 1e-4
                full = (hit.sum(1) * 2 >= width) & (width < n)
                r, c = np.nonzero(hit & ~full[:, None])
                yield part[r], ids[r, c]
                wider.append(part[full])
            rows, width = np.concatenate(wider) if wider else rows[:0], 2 * width

    def within(self, q: np.ndarray, width: int, threshold: float) -> tuple[np.ndarray, np.ndarray]:
        """All of `hits` at once."""
        found = list(self.hits(q, width, threshold))
        return tuple(np.concatenate(x) for x in zip(*found, strict=True)) if found else (np.arange(0), np.arange(0))


def audited_beam(graph: Graph, threshold: float, width: int = FIRST_BEAM) -> tuple[int, float]:
    """The first beam width at which a sample of nodes finds its neighbours (itself is none), and the recall.

    Nodes are drawn until `AUDIT` neighbours are seen, or `AUDIT_BLOCKS` blocks of nodes.  Where no beam
    passes, the width is beyond `WIDEST`: every node is compared.
    """
    n = graph.sizes[0]
    drawn, sample, truth = np.random.default_rng(0).permutation(n), [], set()
    for lo in range(0, min(n, AUDIT * AUDIT_BLOCKS), AUDIT):
        part = drawn[lo : lo + AUDIT]
        r, c = np.nonzero(graph.x[part] @ graph.x.T >= threshold)
        other = part[r] != c
        sample.append(part)
        truth.update(zip((r[other] + lo).tolist(), c[other].tolist(), strict=True))
        if len(truth) >= AUDIT:
            break
    q = graph.x[np.concatenate(sample)]
    while True:
        got = graph.within(q, width, threshold)
        seen = len(truth & set(zip(got[0].tolist(), got[1].tolist(), strict=True)))
        recall = seen / len(truth) if truth else 1.0
        if recall >= MIN_RECALL or width > WIDEST:
            return width, recall
        width = WIDEST + 1 if width >= n else 2 * width


def forest(a: np.ndarray, b: np.ndarray) -> list[tuple[int, int]]:
    """Edges of a spanning forest of the graph with these edges."""
    root: dict[int, int] = {}

    def top(v: int) -> int:
        while (up := root.setdefault(v, v)) != v:
            root[v] = v = root.setdefault(up, up)
        return v

    out = []
    for v, w in zip(a.tolist(), b.tolist(), strict=True):
        x, y = top(v), top(w)
        if x != y:
            root[max(x, y)] = min(x, y)
            out.append((v, w))
    return out


GRAPH = "shard int, node int, rep long, copies long, v {v}, links array<int>, width int, recall double"


def lists(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The values of an Arrow column of lists, and where each list starts and ends."""
    cut = column.offsets.to_numpy()
    return column.values.to_numpy(zero_copy_only=False), cut


def unit(flat: np.ndarray, rows: int) -> np.ndarray:
    """Vectors of length 1, in double precision."""
    x = flat.astype(np.float64).reshape(rows, -1)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def graphs(members: DataFrame, threshold: float) -> DataFrame:
    """The graph of every shard as a table of nodes in the order of `Graph`, with the beam that its audit chose and
    the recall measured with it, from rows `shard, rep, copies, v` that come shard by shard."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        shard, parts = None, []
        for batch in batches:
            names, rep, copies = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("shard", "rep", "copies"))
            flat, cut = lists(batch.column("v"))
            change = np.flatnonzero(names[1:] != names[:-1]) + 1
            for lo, hi in zip([0, *change], [*change, len(names)], strict=True):
                if names[lo] != shard:
                    yield from written(shard, parts)
                    shard, parts = names[lo], []
                # what an Arrow batch holds ends with it
                parts.append((flat[cut[lo] : cut[hi]].reshape(hi - lo, -1).copy(), rep[lo:hi].copy(), copies[lo:hi].copy()))
        yield from written(shard, parts)

    def written(shard: int | None, parts: list) -> Iterator[dict]:
        if not parts:
            return
        v, rep, copies = (np.concatenate(p) for p in zip(*parts, strict=True))
        graph = Graph(unit(v, len(v)))
        width, recall = audited_beam(graph, threshold)
        for lo in range(0, len(v), ROWS):
            here = graph.order[lo : lo + ROWS]
            links, ends = graph.adjacency(lo, lo + len(here))
            ends = np.append(0, ends).astype(np.int32)
            starts = np.arange(0, v[here].size + 1, v.shape[1], dtype=np.int32)
            yield {
                "shard": np.full(len(here), shard), "node": np.arange(lo, lo + len(here)), "rep": rep[here], "copies": copies[here],
                "v": pa.ListArray.from_arrays(starts, v[here].ravel()), "links": pa.ListArray.from_arrays(ends, links),
                "width": np.full(len(here), width), "recall": np.full(len(here), recall),
            }

    return arrow_stage(members, GRAPH.format(v=members.schema["v"].dataType.simpleString()), build, whole=True)


def search_shards(rows: DataFrame, threshold: float) -> DataFrame:
    """`a, links` for queries and `a, b` for edges, from rows `tile, node, rep, copies, v, links, width`: in a
    partition the nodes of a tile's graph come first, in their order, then its queries, which have no node."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        tile, nodes, graph = None, [], None
        for batch in batches:
            names, rep, copies = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("tile", "rep", "copies"))
            ask = batch.column("node").is_null().to_numpy(zero_copy_only=False)
            width = batch.column("width").fill_null(0).to_numpy(zero_copy_only=False)
            (flat, cut), (links, ends) = lists(batch.column("v")), lists(batch.column("links"))
            change = np.flatnonzero((names[1:] != names[:-1]) | (ask[1:] != ask[:-1])) + 1
            for lo, hi in zip([0, *change], [*change, len(names)], strict=True):
                if names[lo] != tile:
                    tile, nodes, graph = names[lo], [], None
                x = unit(flat[cut[lo] : cut[hi]], hi - lo)
                if not ask[lo]:
                    beam = int(width[lo])
                    own = links[ends[lo] : ends[hi]].copy()
                    nodes.append((x, rep[lo:hi].copy(), copies[lo:hi].copy(), own, np.diff(ends[lo : hi + 1])))
                    continue
                if graph is None:
                    if not nodes:
                        continue
                    x_all, rep_all, copies_all, links_all, sizes = (np.concatenate(p) for p in zip(*nodes, strict=True))
                    graph, nodes = Graph.of_links(x_all, links_all, np.cumsum(sizes, dtype=np.int64)), []
                yield from answer(graph, beam, x, rep[lo:hi], x_all, rep_all, copies_all)

    def answer(graph, width, q, q_rep, x, rep, copies) -> Iterator[dict]:
        links, edges = np.zeros(len(q), np.int64), np.zeros((0, 2), np.int64)
        label = np.arange(len(rep))  # of nodes: equal where edges of this batch connect them
        pairs = max(1, PAIRS // q.shape[1])
        for rows, nodes in graph.hits(q.astype(np.float32), width, threshold):
            for lo in range(0, len(rows), pairs):
                row, node = rows[lo : lo + pairs], nodes[lo : lo + pairs]
                cosine = np.einsum("ij,ij->i", q[row], x[node])
                good = (cosine >= threshold) & (q_rep[row] != rep[node])
                row, node = row[good], node[good]
                links += np.bincount(row, copies[node], len(q)).astype(np.int64)
                # of nodes that are connected already, one stands for all
                tops = label[node]
                while (tops != label[tops]).any():
                    tops = label[tops]
                label[node] = tops
                pair, first = np.unique(np.stack([row, tops], 1), axis=0, return_index=True)
                edges = np.concatenate([edges, np.stack([q_rep[row[first]], rep[node[first]]], 1)])
                for (r, t), (before, top) in zip(pair[1:].tolist(), pair[:-1].tolist(), strict=True):
                    if r == before:
                        while t != label[t]:
                            t = label[t]
                        while top != label[top]:
                            top = label[top]
                        label[max(t, top)] = min(t, top)
                if len(edges) > EDGES:
                    edges = np.array(forest(edges[:, 0], edges[:, 1]), np.int64).reshape(-1, 2)
        asked = np.flatnonzero(links)
        edges = np.array(forest(edges[:, 0], edges[:, 1]), np.int64).reshape(-1, 2)
        none = pa.nulls(len(asked), pa.int64())
        yield {"a": q_rep[asked], "b": none, "links": links[asked]}
        yield {"a": edges[:, 0], "b": edges[:, 1], "links": pa.nulls(len(edges), pa.int64())}

    return arrow_stage(rows, "a long, b long, links long", scan, whole=True)


def near_duplicates(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", threshold: float = THRESHOLD) -> DataFrame:
    """`id, n_links, component` of every row."""
    v = F.col("v")
    usable = v.isNotNull() & F.forall("v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))) & F.exists("v", lambda c: c != 0)
    rows = vectors.select(F.col(f"`{key}`").alias("id"), F.col(f"`{vector}`").alias("v"))
    rows = rows.withColumn("v", F.when(usable, v))
    # -0.0 and 0.0 are the same component: adding 0.0 makes them equal
    rows = rows.withColumn("v", F.transform("v", lambda c: c + F.lit(0.0).cast("float")))
    nodes = rows.where("v is not null and id is not null").groupBy("v").agg(F.min("id").alias("low"), F.count("*").alias("copies"))
    # nodes are vectors, named when they are written: an id may have several
    nodes = materialize(nodes.withColumn("rep", F.monotonically_increasing_id()), "vectors")
    count = nodes.count()
    shards = max(SHARDS, -(-count // SHARD))
    # only vectors of one length meet in a graph
    shard = (F.pmod(F.xxhash64("v"), F.lit(shards)) + F.lit(shards) * F.size("v")).cast("int")
    members = nodes.select(shard.alias("shard"), "rep", "copies", "v")
    dealt = members.repartitionByRange(shards, "shard").sortWithinPartitions("shard", "rep")
    built = materialize(graphs(dealt, threshold), "graphs")
    audits = built.agg(F.min("recall").alias("recall"), F.max("width").alias("width")).first()
    LOG.info("recall of the audits: %s at least, with beams of %s at most", audits.recall, audits.width)
    # a tile is a shard and a block of queries
    blocks = -(-count // ASKED) or 1
    tile = F.col("shard").cast("long") * F.lit(blocks) + F.col("block")
    every = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block")
    graph = built.select("shard", every, "node", "rep", "copies", "v", "links", "width")
    queries = nodes.select("rep", "copies", "v", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("s"))
    queries = queries.select(
        (F.col("s") + F.lit(shards) * F.size("v")).alias("shard"),
        F.pmod(F.xxhash64("rep"), F.lit(blocks)).alias("block"),
        "rep", "copies", "v",
    )
    met = graph.unionByName(queries, allowMissingColumns=True).withColumn("tile", tile)
    met = met.select("tile", "node", "rep", "copies", "v", "links", "width")
    met = met.repartitionByRange(min(shards * blocks, TASKS), "tile").sortWithinPartitions("tile", F.col("node").asc_nulls_last(), "rep")
    found = materialize(search_shards(met, threshold), "links")
    links = found.where("b is null").groupBy(F.col("a").alias("rep")).agg(F.sum("links").alias("links"))
    roots = components(found.where("b is not null").select("a", "b")).withColumnRenamed("node", "rep")
    lowest = nodes.select("rep", "low").join(roots, "rep").groupBy("root").agg(F.min("low").alias("least"))
    nodes = nodes.join(links, "rep", "left").join(roots, "rep", "left").join(lowest, "root", "left")
    own = rows.where("v is not null and id is not null").join(nodes, "v").select(
        "id", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), F.coalesce("least", "low").alias("component")
    )
    # rows that link with nothing meet no join, where they would share one key
    alone = rows.where("v is null or id is null").select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component"))
    return own.union(alone)
