"""Near-duplicate vectors by lattice hashing.

Unit vectors are projected at random to eight dimensions, shifted, and decoded to the
nearest point of the E8 lattice; the cell of that point, with the label, is a bucket of
one table. Each vector lies in its own cell and also probes the neighbouring cells whose
points are nearest to it. Members and probers of a cell are compared by cosine in double
precision. With the defaults, a pair at cosine 0.93 shares a bucket of one table with
probability 0.52 and of six tables with 0.987; closer pairs do so more often.

Equal vectors of a label are one node before anything is hashed. A bucket that holds more
than ``block`` rows is compared in pairs of blocks, which Spark spreads like other
buckets, so no candidate is dropped and no task gathers a bucket. What leaves a bucket is
one row per member: the copies it links to, and a link towards the least node it is
connected with there, never the pairs. A pair that several buckets hold is counted in the
first of them alone, which each bucket can tell from its members' cells.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import combinations, product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from sluice.llm.common import drop_saved, fresh, join_counted, join_one, save, without
from sluice.llm.components import components


def _roots() -> np.ndarray:
    """The 240 shortest vectors of E8: the steps to a point's neighbours."""
    out = []
    for i, j in combinations(range(8), 2):
        for s, t in product((1, -1), repeat=2):
            v = np.zeros(8)
            v[i], v[j] = s, t
            out.append(v)
    out += [np.array(s) for s in product((0.5, -0.5), repeat=8) if sum(x < 0 for x in s) % 2 == 0]
    return np.array(out)


def _nearest_d8(x: np.ndarray) -> np.ndarray:
    """The nearest integer points of even sum: round, and mend an odd sum where rounding lost most."""
    point = np.rint(x)
    odd = np.flatnonzero(point.sum(1) % 2)
    off = x[odd] - point[odd]
    worst = np.abs(off).argmax(1)
    point[odd, worst] += np.where(off[np.arange(len(odd)), worst] >= 0, 1, -1)
    return point


def nearest_e8(x: np.ndarray) -> np.ndarray:
    """The nearest points of E8, which is D8 and D8 shifted by a half in every direction."""
    whole, half = _nearest_d8(x), _nearest_d8(x - 0.5) + 0.5
    return np.where((((x - whole) ** 2).sum(1) <= ((x - half) ** 2).sum(1))[:, None], whole, half)


def _cell_ids(points: np.ndarray, table: int, labels: np.ndarray) -> np.ndarray:
    """64-bit bucket numbers of (label, table, lattice point); the last byte is the table."""
    h = labels.astype(np.int64).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(table + 1)
    for k in range(8):
        h = (h ^ (h >> np.uint64(31))) * np.uint64(0xD6E8FEB86659FD93)
        h += (2 * points[..., k]).astype(np.int64).astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return (h & ~np.uint64(255) | np.uint64(table)).view(np.int64)


def cells(vectors: np.ndarray, labels: np.ndarray, tables: int, probes: int, cell: float, seed: int) -> np.ndarray:
    """Bucket numbers of shape (vectors, tables, 1 + probes): own cell, then the cells probed.

    Every label's cells are its own. The projections depend on seed and table only."""
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    roots, out = _roots(), np.empty((len(unit), tables, 1 + probes), np.int64)
    for t in range(tables):
        rng = np.random.default_rng([seed, t])
        at = unit @ (rng.normal(size=(unit.shape[1], 8)) / np.sqrt(8) / cell) + rng.uniform(-1, 1, 8)
        own = nearest_e8(at)
        out[:, t, 0] = _cell_ids(own, t, labels)
        # |at - own - r|^2 grows with -2 (at - own) r: all r have the same length
        best = np.argsort(-((at - own) @ roots.T), axis=1, kind="stable")[:, :probes]
        for p in range(probes):
            out[:, t, 1 + p] = _cell_ids(own + roots[best[:, p]], t, labels)
    return out


def _hash_nodes(tables: int, probes: int, cell: float, seed: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size = np.diff(batch.column(1).offsets.to_numpy())
            made = np.empty((batch.num_rows, tables * (1 + probes)), np.int64)
            labels, lists = batch.column(2).to_numpy(zero_copy_only=False), batch.column(1)
            for n in np.unique(size):  # vectors of one dimension at a time
                of = np.flatnonzero(size == n)
                flat = lists.take(pa.array(of)).flatten().to_numpy(zero_copy_only=False).astype(np.float64)
                made[of] = cells(flat.reshape(len(of), n), labels[of], tables, probes, cell, seed).reshape(len(of), -1)
            flat = pa.ListArray.from_arrays(np.arange(0, made.size + 1, made.shape[1], dtype=np.int32), pa.array(made.ravel()))
            yield pa.RecordBatch.from_arrays([*batch.columns, flat], [*batch.schema.names, "cells"])

    return run


def _links_of_unit(unit: dict, probes: int, threshold: float):
    """Members of one bucket, or of two of its blocks: copies linked to each, and forest links.

    Only pairs of one own member and any other row count, and of two blocks only pairs
    across. ``unit`` has node, copies, own, block and vector, cells as arrays."""
    node, own, cells_ = unit["node"], unit["own"], unit["cells"].reshape(len(unit["node"]), -1, 1 + probes)
    vec = unit["vector"]
    unit_vec = vec / np.linalg.norm(vec, axis=1, keepdims=True)
    n, key = len(node), unit["key"]
    table = cells_.shape[1] - 1
    linked, label = np.zeros(n, np.int64), np.arange(n)
    near_all = []
    rows = max(1, (1 << 20) // n)
    for low in range(0, n, rows):
        part = slice(low, min(low + rows, n))
        near = unit_vec[part] @ unit_vec.T >= threshold
        near &= own[part, None] | own[None, :]
        near &= unit["label"][part, None] == unit["label"][None, :]
        near &= node[part, None] < node[None, :]
        if unit["across"]:
            near &= unit["block"][part, None] != unit["block"][None, :]
        a, b = np.nonzero(near)
        near_all.append((a + low, b))
    a, b = (np.concatenate([x[k] for x in near_all]) for k in (0, 1))
    if not len(a):
        return None
    first = np.ones(len(a), bool)
    for t in range(table + 1):  # counted before, in an earlier table or the nearer bucket of this one?
        x, y = cells_[a, t], cells_[b, t]
        same = x[:, 0] == y[:, 0]
        x_probes, y_probes = (x[:, 1:] == y[:, :1]).any(1), (y[:, 1:] == x[:, :1]).any(1)
        if t < table:
            first &= ~(same | x_probes | y_probes)
        else:  # order: the common cell, then the cell of the lesser node, then of the greater
            place = np.where(same, x[:, 0], np.where(y_probes, x[:, 0], y[:, 0]))
            first &= place == key
    np.add.at(linked, a[first], unit["copies"][b[first]])
    np.add.at(linked, b[first], unit["copies"][a[first]])
    while True:  # least member reachable by the links found here
        new = label.copy()
        np.minimum.at(new, a, label[b])
        np.minimum.at(new, b, label[a])
        new = np.minimum(new, new[new])
        if (new == label).all():
            break
        label = new
    some = np.flatnonzero((linked > 0) | (label != np.arange(n)))
    return node[some], linked[some], node[label[some]]


def _compare(probes: int, threshold: float):
    """Runs of rows with equal (key, pair of blocks), in order, each a unit of comparison."""
    names = ("key", "low", "high", "node", "copies", "own", "block", "label")

    def arrays(batch: pa.RecordBatch) -> dict:
        out = {n: batch.column(i).to_numpy(zero_copy_only=False) for i, n in enumerate(names)}
        for i, n in ((8, "vector"), (9, "cells")):
            lists = batch.column(i)
            ends = lists.offsets.to_numpy()
            out[n + "_at"] = ends - ends[0]
            out[n] = lists.flatten().to_numpy(zero_copy_only=False)
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict] = []  # pieces of a unit that goes on in the next batch

        def piece(x: dict, a: int, b: int) -> dict:
            vec = x["vector"][x["vector_at"][a]: x["vector_at"][b]].astype(np.float64)
            part = {n: x[n][a:b] for n in names}
            return part | {"vector": vec.reshape(b - a, -1), "cells": x["cells"][x["cells_at"][a]: x["cells_at"][b]].reshape(b - a, -1)}

        def finish() -> list:
            pieces, widths = list(held), {p["vector"].shape[1] for p in held}
            held.clear()
            found = []
            for width in widths:  # vectors of other dimensions are never near
                same = [p for p in pieces if p["vector"].shape[1] == width]
                unit = {n: np.concatenate([p[n] for p in same]) for n in (*names, "vector", "cells")}
                unit |= {"key": unit["key"][0], "across": unit["low"][0] != unit["high"][0]}
                got = _links_of_unit(unit, probes, threshold) if len(unit["node"]) > 1 else None
                if got is not None:
                    found.append(got)
            return found

        def result(found: list) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate([f[k] for f in found])) for k in range(3)], ["node", "linked", "towards"])

        last, found = None, []
        for batch in batches:
            if not batch.num_rows:
                continue
            x = arrays(batch)
            ids = np.stack([x["key"], x["low"], x["high"]], axis=1)
            dims = np.diff(x["vector_at"])
            cut = np.flatnonzero((ids[1:] != ids[:-1]).any(1) | (dims[1:] != dims[:-1])) + 1
            edges = [0, *cut.tolist(), batch.num_rows]
            for a, b in zip(edges[:-1], edges[1:], strict=True):
                if held and tuple(ids[a]) != last:
                    found += finish()
                held.append(piece(x, a, b))
                last = tuple(ids[a])
            if found:
                yield result(found)
                found = []
        if held:
            found = finish()
            if found:
                yield result(found)

    return run


def near_vectors(vectors: DataFrame, id: str = "vec_id", vector: str = "embedding", label: str = "label",
                 threshold: float = 0.93, tables: int = 6, probes: int = 2, cell: float = 0.5, block: int = 1024,
                 seed: int = 0, tables_at_once: int = 2) -> DataFrame:
    """``vectors`` without the vector column, with ``n_links``, ``component_id``, ``kept``.

    Vectors link when their labels are equal and their cosine reaches ``threshold``.
    ``n_links`` counts other rows linked directly, repeated rows too; ``component_id`` is
    the least id reachable by links, ``kept`` marks the row that has it (of repeated rows
    each). A null label, and a vector that is null, empty, zero or holds null or non-finite
    numbers, links with nothing, copies of it included. A null id counts after all others.
    Tables take turns, ``tables_at_once`` each, which bounds the disk that shuffled vectors need.
    """
    out = ("n_links", "component_id", "kept")
    vectors = without(vectors, [c for c in out if c not in (id, vector, label)])
    node = fresh(vectors.columns, "node")
    v = F.col(vector)
    good = F.coalesce(F.col(label).isNotNull() & v.isNotNull() & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (
        F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0), F.lit(False))
    row = fresh(vectors.columns, "row")
    rows = save(vectors.withColumn(row, F.monotonically_increasing_id()), "vectors")
    groups = rows.filter(good).groupBy(F.col(vector).alias("vector"), F.col(label).alias("label")).agg(
        F.min(row).alias("node"), F.count(F.lit(1)).alias("copies"), F.min(id).alias("least"))
    if not 1 <= tables <= 256:
        raise ValueError("tables must be between 1 and 256")
    groups = save(groups, "distinct-vectors")
    # Whole numbers stand for themselves, other labels for their 64-bit hash.
    number = F.col("label").cast("long") if isinstance(groups.schema["label"].dataType, IntegralType) else F.xxhash64("label")
    hashed = groups.select("node", "vector", number.alias("label"), "copies").mapInArrow(
        _hash_nodes(tables, probes, cell, seed),
        f"node long, vector {groups.schema['vector'].dataType.simpleString()}, label long, copies long, cells array<long>")
    hashed = save(hashed, "hashed-vectors")
    dealt = hashed.select("*", F.posexplode("cells").alias("at", "key")).withColumn("own", F.col("at") % (1 + probes) == 0)
    # A comparison in a cell of table t asks about the cells of tables up to t only.
    table = F.floor(F.col("at") / (1 + probes)).cast("int")
    dealt = dealt.withColumn("cells", F.slice("cells", 1, (table + 1) * (1 + probes))).withColumn("turn", F.floor(table / tables_at_once))
    turns = []
    for turn in range(-(-tables // tables_at_once)):  # only one turn's vectors lie in shuffle files
        mine = dealt.filter(F.col("turn") == turn).drop("turn", "at")
        sizes = mine.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("own").cast("long")).alias("owners"))
        sizes = save(sizes.filter("n > 1 and owners > 0").select("key", "n", F.ceil(F.col("n") / block).cast("int").alias("blocks")), "cell-sizes")
        mine = join_counted(mine, sizes, ["key"]).withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
        units = mine.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
            "key", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"), "node", "copies",
            "own", "block", "label", "vector", "cells")
        units = units.repartition("key", "low", "high").sortWithinPartitions("key", "low", "high")
        turns.append(save(units.mapInArrow(_compare(probes, threshold), "node long, linked long, towards long"), "vector-links"))
        drop_saved(sizes)
    links_found = reduce(DataFrame.unionByName, turns)
    links = links_found.groupBy("node").agg(F.sum("linked").alias("linked"))
    joined = components(links_found.select(F.col("node").alias("a"), F.col("towards").alias("b")))
    per = groups.join(links, "node", "left").join(joined, "node", "left").select(
        "vector", "label", "node", "least", (F.coalesce("linked", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        F.coalesce("component", "node").alias("component"))
    per = save(per, "linked-vectors")
    least = save(per.groupBy("component").agg(F.min("least").alias("least_id")), "least-of-component")
    per = save(join_one(per.drop("least"), least, ["component"]).select(
        F.col("vector").alias(vector), F.col("label").alias(label), "n_links", F.col("least_id").alias("component_id")), "vector-classes")
    drop_saved(groups, hashed, *turns, least)
    found = join_one(rows.filter(good), per, [vector, label])
    alone = rows.filter(~good).withColumns({"n_links": F.lit(0).cast("long"), "component_id": F.col(id)})
    return found.unionByName(alone).withColumn("kept", F.col(id).eqNullSafe(F.col("component_id"))).drop(row, vector)
