"""Approximate nearest neighbours: a navigable small-world graph per shard.

Equal vectors form one class, of which the k + 1 smallest ids are kept: no more can appear among the k
nearest, as ties go to the smaller id. Classes are dealt to shards by hash. Each shard is a hierarchical
graph in flat arrays: a geometric level per node, and per level a matrix of neighbour numbers. Links
are chosen from the exact nearest nodes of the shard by the usual heuristic, which drops a candidate that
is closer to a chosen neighbour than to the node, and are made mutual. A query descends greedily from
the top level and searches the lowest with a beam. Graphs are stored as rows; blocks of queries are sent to every
shard and stream past its graph, and the shards' results are merged per query.

Defined results: vectors that are null, empty, zero, of another length than the first, or hold null or
non-finite components take no part, neither do rows with a null id; repeated rows count once per id
and vector; with fewer than k other vectors all are returned; an empty table gives no rows; other columns
are ignored.
"""

from __future__ import annotations

import io
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from adtide.llm.common import store

NEAREST = 5
#: Classes in a shard: bounds a task's memory and the cost of building its graph.
SHARD_ROWS = 4096
#: Neighbours of a node on the upper levels; the lowest has twice as many.
LINKS = 16
BEAM = 160
#: Found vectors of each shard that are measured again in double precision.
REMEASURED = 24


def _rows(indices: list[list[int]], width: int) -> np.ndarray:
    """Neighbour lists as one matrix, filled with -1."""
    matrix = np.full((len(indices), width), -1, dtype=np.int32)
    for at, own in enumerate(indices):
        matrix[at, : len(own)] = own
    return matrix


def _choose(candidates: np.ndarray, nearness: np.ndarray, vectors: np.ndarray, width: int) -> list[int]:
    """Candidates, nearest first, that are nearer to the node than to any chosen one; then the nearest others."""
    between = vectors[candidates] @ vectors[candidates].T
    chosen: list[int] = []
    for at in range(len(candidates)):
        if len(chosen) == width:
            break
        if not chosen or between[at, chosen].max() <= nearness[at]:
            chosen.append(at)
    for at in range(len(candidates)):
        if len(chosen) == width:
            break
        if at not in chosen:
            chosen.append(at)
    return [int(candidates[at]) for at in chosen]


def _level(vectors: np.ndarray, nodes: np.ndarray, width: int) -> np.ndarray:
    """Neighbour matrix of one level over all nodes of the shard; nodes of lower levels have no neighbours."""
    own = vectors[nodes]
    links: list[list[int]] = [[] for _ in range(len(vectors))]
    pool = min(len(nodes) - 1, 2 * width)
    back: list[list[int]] = [[] for _ in range(len(vectors))]
    for first in range(0, len(nodes), 1024):
        near = own[first : first + 1024] @ own.T
        near[np.arange(len(near)), np.arange(first, first + len(near))] = -np.inf
        best = np.argpartition(-near, pool - 1, axis=1)[:, :pool] if pool else np.zeros((len(near), 0), int)
        for row in range(len(near)):
            order = best[row][np.argsort(-near[row, best[row]], kind="stable")]
            node = int(nodes[first + row])
            links[node] = _choose(nodes[order], near[row, order], vectors, width // 2)
            for other in links[node]:
                back[other].append(node)
    for node in nodes.tolist():
        own_links = links[node]
        extra = np.array([b for b in back[node] if b not in own_links], dtype=int)
        room = width - len(own_links)
        if len(extra) > room:
            near = vectors[extra] @ vectors[node]
            order = np.argsort(-near, kind="stable")
            extra = np.array(_choose(extra[order], near[order], vectors, room), dtype=int)
        links[node] = own_links + extra.tolist()
    return _rows(links, width)


def build_graph(vectors: np.ndarray, seed: int) -> dict[str, np.ndarray | int]:
    """Flat arrays of a graph over unit vectors: entry node, and a neighbour matrix per level, top first."""
    count = len(vectors)
    random = np.random.default_rng(seed)
    levels = np.minimum((-np.log(1 - random.random(count)) / np.log(LINKS)).astype(int), 6)
    top = int(levels.max()) if count else 0
    matrices = []
    for level in range(top, -1, -1):
        nodes = np.flatnonzero(levels >= level)
        matrices.append(_level(vectors, nodes, 2 * LINKS if level == 0 else LINKS))
    return {"entry": int(np.flatnonzero(levels == top)[0]) if count else -1, "levels": matrices}


def search_graph(graph: dict, vectors: np.ndarray, queries: np.ndarray, beam: int) -> np.ndarray:
    """Node numbers of the beam nearest found for each query, unordered, -1 where there are fewer.

    All queries advance together, each by its best node that has not been expanded.
    """
    rows = np.arange(len(queries))
    current = np.full(len(queries), graph["entry"])
    near = (vectors[current] * queries).sum(axis=1)
    for matrix in graph["levels"][:-1]:
        moving = np.ones(len(queries), dtype=bool)
        while moving.any():
            at = np.flatnonzero(moving)
            around = matrix[current[at]]
            values = np.where(around >= 0, np.einsum("qnd,qd->qn", vectors[around], queries[at]), -np.inf)
            best = values.argmax(axis=1)
            value = values[np.arange(len(at)), best]
            better = value > near[at]
            current[at[better]] = around[np.arange(len(at)), best][better]
            near[at[better]] = value[better]
            moving[at[~better]] = False
    lowest = graph["levels"][-1]
    width = min(beam, len(vectors))
    seen = np.zeros((len(queries), len(vectors) + 1), dtype=bool)
    seen[:, -1] = True
    seen[rows, current] = True
    found = np.full((len(queries), width), -1, dtype=np.int64)
    value = np.full((len(queries), width), -np.inf, dtype=np.float32)
    open_ = np.zeros((len(queries), width), dtype=bool)
    found[:, 0], value[:, 0], open_[:, 0] = current, near, True
    active = rows
    while len(active):
        candidate = np.where(open_[active], value[active], -np.inf)
        best = candidate.argmax(axis=1)
        alive = np.isfinite(candidate[np.arange(len(active)), best])
        active, best = active[alive], best[alive]
        if not len(active):
            break
        open_[active, best] = False
        around = lowest[found[active, best]].astype(np.int64)
        fresh = ~seen[active[:, None], around]
        seen[active[:, None], around] = True
        seen[:, -1] = True
        values = np.where(fresh, np.einsum("qnd,qd->qn", vectors[around], queries[active]), -np.inf).astype(np.float32)
        all_found = np.concatenate((found[active], around), axis=1)
        all_value = np.concatenate((value[active], values), axis=1)
        all_open = np.concatenate((open_[active], fresh), axis=1)
        keep = np.argpartition(-all_value, width - 1, axis=1)[:, :width]
        each = np.arange(len(active))[:, None]
        found[active], value[active], open_[active] = all_found[each, keep], all_value[each, keep], all_open[each, keep] & np.isfinite(all_value[each, keep])
    return np.where(np.isfinite(value), found, -1)


def valid_vectors(table: DataFrame, id_column: str, vector_column: str) -> DataFrame:
    """id, vector (doubles) and vector as given of the rows that take part."""
    rows = table.select(F.col(id_column).cast("long").alias("id"), F.col(vector_column).cast("array<double>").alias("vector")).where("id is not null and size(vector) > 0")
    whole = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = rows.where(whole).where(F.exists("vector", lambda x: x != 0))
    length = rows.agg(F.min_by(F.size("vector"), "id")).first()[0]
    return rows.where(F.size("vector") == F.lit(length if length is not None else 0))


def _packed(graph: dict, **arrays: np.ndarray) -> bytes:
    levels = {f"level_{at}": matrix for at, matrix in enumerate(graph["levels"])}
    blob = io.BytesIO()
    np.savez(blob, entry=np.array(graph["entry"]), **levels, **arrays)
    return blob.getvalue()


def _unpacked(blob: bytes) -> dict:
    with np.load(io.BytesIO(blob)) as arrays:
        graph: dict = {name: arrays[name] for name in arrays.files}
    graph["entry"] = int(graph["entry"])
    graph["levels"] = [graph.pop(f"level_{at}") for at in range(sum(name.startswith("level_") for name in graph))]
    return graph


def build_shards(rows: DataFrame, k: int, shard_rows: int) -> DataFrame:
    """shard, graph: one row per shard with ids, vectors and neighbour arrays, stored."""
    # the k + 1 smallest ids of each distinct vector; a heap of a hot vector's rows stays this small in every task
    turn = Window.partitionBy("vector").orderBy("id")
    smallest = rows.dropDuplicates(["id", "vector"]).withColumn("place", F.row_number().over(turn)).where(F.col("place") <= k + 1)
    classes = store(smallest.groupBy("vector").agg(F.sort_array(F.collect_list("id")).alias("ids")), "classes")
    count = classes.count()
    shards = max(1, -(-count // shard_rows))
    dealt = classes.withColumn("shard", F.pmod(F.xxhash64("vector"), F.lit(shards)).cast("int"))

    def build(group: pd.DataFrame) -> pd.DataFrame:
        group = group.assign(first=[ids[0] for ids in group["ids"]]).sort_values("first")
        original = np.array(group["vector"].tolist(), dtype=np.float64)
        scaled = original / np.abs(original).max(axis=1, keepdims=True)
        units = (scaled / np.linalg.norm(scaled, axis=1, keepdims=True)).astype(np.float32)
        shard = int(group["shard"].iloc[0])
        graph = build_graph(units, shard)
        lists = [np.asarray(ids, dtype=np.int64) for ids in group["ids"]]
        ends = np.cumsum([len(x) for x in lists])
        return pd.DataFrame({"shard": [shard], "graph": [_packed(graph, ids=np.concatenate(lists), ends=ends, vectors=original)]})

    return store(dealt.groupBy("shard").applyInPandas(build, "shard int, graph binary"), "graphs")


def nearest(table: DataFrame, is_query: Column, id_column: str = "vec_id", vector_column: str = "embedding", k: int = NEAREST, shard_rows: int = SHARD_ROWS, beam: int = BEAM) -> DataFrame:
    """query_id, rank, id, score: the k nearest by cosine of every query row among all other rows.

    is_query: condition on ``id``.
    """
    rows = store(valid_vectors(table, id_column, vector_column), "vectors")
    graphs = build_shards(rows, k, shard_rows)
    numbers = graphs.select("shard")
    shards = numbers.count()
    queries = rows.where(is_query).dropDuplicates(["id", "vector"]).select("id", "vector")
    # every query goes to every shard; the stream of a shard is its graph and then its queries
    sent = queries.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(max(shards - 1, 0))))).select("shard", F.lit(1).alias("kind"), "id", "vector", F.lit(None).cast("binary").alias("graph"))
    base = graphs.select("shard", F.lit(0).alias("kind"), F.lit(None).cast("long").alias("id"), F.lit(None).cast("array<double>").alias("vector"), "graph")
    stream = base.unionByName(sent).repartition("shard").sortWithinPartitions("shard", "kind", "id")
    schema = pa.schema([("query_id", pa.int64()), ("id", pa.int64()), ("score", pa.float64())])

    def answer(graph: dict, ids: np.ndarray, vectors: np.ndarray) -> pa.RecordBatch:
        scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
        units = scaled / np.linalg.norm(scaled, axis=1, keepdims=True)
        found = search_graph(graph, graph["units"], units.astype(np.float32), beam)
        out: list[tuple[int, int, float]] = []
        for query, vector, nodes in zip(ids.tolist(), vectors, found, strict=True):
            nodes = nodes[nodes >= 0]
            rough = graph["units"][nodes] @ (vector / np.linalg.norm(vector)).astype(np.float32)
            nodes = nodes[np.argsort(-rough, kind="stable")[:REMEASURED]]
            others = graph["vectors"][nodes]
            scores = (others @ vector) / (np.linalg.norm(others, axis=1) * np.linalg.norm(vector))
            own: list[tuple[float, int]] = []
            for node, score in zip(nodes.tolist(), scores.tolist(), strict=True):
                members = graph["ids"][graph["ends"][node - 1] if node else 0 : graph["ends"][node]]
                own += [(-score, int(m)) for m in members if m != query]
            out += [(query, m, -score) for score, m in sorted(own)[:k]]
        columns = list(zip(*out, strict=True)) or [[], [], []]
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        graph: dict = {}
        shard = None
        for batch in batches:
            shard_of, kinds, ids = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(3))
            first = 0
            while first < len(batch):
                if kinds[first] == 0:
                    graph, shard = _unpacked(batch.column(4)[first].as_py()), shard_of[first]
                    scaled = graph["vectors"] / np.abs(graph["vectors"]).max(axis=1, keepdims=True)
                    graph["units"] = (scaled / np.linalg.norm(scaled, axis=1, keepdims=True)).astype(np.float32)
                    first += 1
                    continue
                end = first
                while end < len(batch) and end - first < 512 and kinds[end] == 1 and shard_of[end] == shard:
                    end += 1
                vectors = np.array(batch.column(3).slice(first, end - first).to_pylist(), dtype=np.float64)
                yield answer(graph, ids[first:end].astype(np.int64), vectors)
                first = end

    found = stream.mapInArrow(search, "query_id long, id long, score double")
    best = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "id", "score")
