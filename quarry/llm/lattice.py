"""Near-duplicate embeddings by lattice hashing.

Each table rotates the unit vectors by a random orthonormal projection to ``blocks`` times
eight coordinates, shifts and scales them, and decodes every eight of them to the nearest
point of the E8 lattice; the points together name a cell.  A vector lives in its cell and
probes neighbouring cells: those it would reach by decoding one block to its next nearest
lattice points.  Cells are as narrow as large tables need, for tables of every size, so what is
found of two vectors does not depend on how many others there are.  Equal vectors are one representative with a multiplicity; vectors of each
length have projections and cells of their own.  Cells hold representatives' digests, and only
those of crowded cells fetch their vectors.  Vectors that meet in a cell are compared by cosine
in double precision, block against block; tasks hand on only a spanning forest of the links
they find.  Its components are the classes, and inside each class every pair is compared once
more to count each vector's links exactly.

Defined results: vectors that are null, empty, zero or hold a null or non-finite component
link with nothing, and neither do vectors with a null id; vectors of different lengths are
never linked; equal vectors are linked like any others; rows that repeat an id with the same
vector (up to its length) are one vector, with another vector they are two; an empty table
gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import columns_of, map_batches, process_state, scratch
from quarry.llm.graphs import block_pairs, components, local_roots
from quarry.llm.hashing import digest, mix

COSINE = 0.9
SCALE = 1.2
#: A further block of eight coordinates leaves a tenth of the chance meetings or less, more tables
#: and probes make up for it: planted pairs at cosine 0.9 exactly in 64 dimensions are found with
#: 0.995.
TABLES, BLOCKS, PROBES = 16, 6, 16
BLOCK_ROWS = 1024
SEED = 11

_U = np.uint64


def _nearest_d8(x: np.ndarray) -> np.ndarray:
    """Nearest points of D8 (integers of even sum)."""
    near = np.rint(x)
    off = x - near
    worst = np.abs(off).argmax(axis=1)
    rows = np.arange(len(x))
    odd = (near.sum(axis=1) % 2) != 0
    step = np.where(off[rows, worst] >= 0, 1.0, -1.0)
    near[rows[odd], worst[odd]] += step[odd]
    return near


def nearest_e8(x: np.ndarray) -> np.ndarray:
    """Nearest points of E8 = D8 and D8 shifted by one half."""
    whole = _nearest_d8(x)
    half = _nearest_d8(x - 0.5) + 0.5
    closer = ((x - whole) ** 2).sum(axis=1) <= ((x - half) ** 2).sum(axis=1)
    return np.where(closer[:, None], whole, half)


def minimal_vectors() -> np.ndarray:
    """The 240 shortest vectors of E8."""
    out = []
    for i in range(8):
        for j in range(i):
            for a in (1, -1):
                for b in (1, -1):
                    v = np.zeros(8)
                    v[i], v[j] = a, b
                    out.append(v)
    for bits in range(256):
        signs = np.array([1 if bits >> k & 1 else -1 for k in range(8)])
        if (signs < 0).sum() % 2 == 0:
            out.append(signs / 2)
    return np.array(out)


class Tables:
    """Projections of all tables and the cells of vectors in them."""

    def __init__(self, dim: int, tables: int, blocks: int, scale: float, probes: int, seed: int):
        state = np.random.default_rng(seed)
        self.dim, self.blocks, self.probes = dim, blocks, probes
        width = 8 * blocks
        self.projections, self.shifts = [], []
        for _ in range(tables):
            full = state.standard_normal((max(dim, width), max(dim, width)))
            q = np.linalg.qr(full)[0][:dim, :width]
            # eight coordinates of a unit vector hold sqrt(8 / dim) of its length; the scale
            # is a lattice step in those terms, so it fits every dimension
            self.projections.append(q / (scale * np.sqrt(8 / dim)))
            self.shifts.append(state.random(width) * 2)
        self._short = minimal_vectors()
        self._coder = state.integers(1, 1 << 62, (blocks, 8), dtype=np.uint64) | _U(1)

    def _code(self, points: np.ndarray, block: int) -> np.ndarray:
        doubled = np.rint(points * 2).astype(np.int64).astype(_U)
        return mix((doubled * self._coder[block]).sum(axis=-1, dtype=_U))

    def cells(self, unit: np.ndarray, table: int):
        """Own cells (n) and probed cells (n, probes)."""
        x = unit @ self.projections[table] + self.shifts[table]
        own_blocks, cost, alternatives = [], [], []
        for b in range(self.blocks):
            part = x[:, 8 * b:8 * b + 8]
            point = nearest_e8(part)
            own_blocks.append(self._code(point, b))
            residual = part - point
            # squared distance to point + v, less that to point, is 2 - 2 <residual, v>
            gain = 2 - 2 * (residual @ self._short.T)
            best = np.argpartition(gain, self.probes, axis=1)[:, :self.probes]
            cost.append(np.take_along_axis(gain, best, axis=1))
            alternatives.append(self._code(point[:, None, :] + self._short[best], b))
        salt = mix(np.array([table + 1 + (self.dim << 20)], dtype=_U))[0]

        def join(parts):
            code = np.full(np.shape(parts[0]), salt, dtype=_U)
            for p in parts:
                code = mix(code * _U(0xD6E8FEB86659FD93) + p)
            return code
        own = join(own_blocks)
        codes = [join([alternatives[b] if k == b else np.broadcast_to(
            own_blocks[k][:, None], alternatives[b].shape) for k in range(self.blocks)])
            for b in range(self.blocks)]
        order = np.argsort(np.concatenate(cost, axis=1), axis=1)[:, :self.probes]
        return own, np.take_along_axis(np.concatenate(codes, axis=1), order, axis=1)


def _matrices(column) -> list[tuple[np.ndarray, np.ndarray]]:
    """Vectors as (rows, matrix) by length."""
    lengths = np.diff(column.offsets.to_numpy())
    flat = np.asarray(column.flatten(), dtype=np.float64)
    starts = np.concatenate([[0], np.cumsum(lengths)])
    return [(rows, flat[starts[rows][:, None] + np.arange(n)])
            for n in np.unique(lengths) for rows in [np.flatnonzero(lengths == n)]]


def _compare(threshold: float, count: bool):
    def compare(part: pa.Table) -> pa.Table:
        part = part.combine_chunks()
        n = part.num_rows
        linked = np.zeros((n, n), dtype=bool)
        for rows, unit in _matrices(part.column("unit").combine_chunks()):
            linked[np.ix_(rows, rows)] = unit @ unit.T >= threshold
        np.fill_diagonal(linked, False)
        if part.column("_i")[0].as_py() != part.column("_j")[0].as_py():
            side = part.column("_block").to_numpy()
            linked &= side[:, None] != side[None, :]
        reps = part.column("rep")
        if count:
            links = linked @ part.column("copies").to_numpy()
            return pa.table({"rep": reps, "links": pa.array(links, pa.int64())})
        roots = local_roots(linked)
        moved = np.flatnonzero(roots != np.arange(n))
        return pa.table({"rep": reps.take(pa.array(moved)),
                         "root": reps.take(pa.array(roots[moved]))})
    return compare


def unit_vectors(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """``vec, rep, unit``, one row per row: the vector scaled to length one in double precision
    and a 128-bit digest of it, null where it links with nothing."""
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        col = columns_of(batch, ["vec", "_v"])
        rep, unit = [], []
        for i in range(batch.num_rows):
            cell = col["_v"][i]
            rep.append(None)
            unit.append(None)
            if not (cell.is_valid and col["vec"][i].is_valid) or cell.values.null_count or not len(cell.values):
                continue
            x = np.asarray(cell.values, dtype=np.float64)
            top = np.abs(x).max()
            if not np.isfinite(top) or top == 0:
                continue
            x = x / top
            x = x / np.sqrt((x * x).sum()) + 0.0  # no negative zeros
            rep[-1], unit[-1] = digest(x.tobytes()), x
        return pa.RecordBatch.from_arrays(
            [col["vec"], pa.array(rep, pa.binary()), pa.array(unit, pa.list_(pa.float64()))],
            names=["vec", "rep", "unit"])
    id_type = vectors.schema[id_col].dataType.simpleString()
    return map_batches(
        vectors.select(F.col(id_col).alias("vec"), F.col(vector_col).alias("_v")), run,
        f"vec {id_type}, rep binary, unit array<double>")


def settings(rows: int) -> tuple[int, int, int]:
    """Tables, blocks and probes: the same for every number of representatives."""
    return TABLES, BLOCKS, PROBES


def _lattice(*parameters) -> Tables:
    """Tables kept for the life of a worker, for a few lengths at a time."""
    kept = process_state("lattice-tables", dict)
    if parameters not in kept:
        if len(kept) >= 8:
            kept.clear()
        kept[parameters] = Tables(*parameters)
    return kept[parameters]


def near_duplicates(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
                    cosine: float = COSINE, tables: int = TABLES, blocks: int = BLOCKS,
                    scale: float = SCALE, probes: int = PROBES, block_rows: int = BLOCK_ROWS,
                    seed: int = SEED) -> DataFrame:
    """One row per vector row: ``id_col, n_links, component_id, kept``."""
    rows = scratch(unit_vectors(vectors, id_col, vector_col), "units")
    # distinct ids first: rows that repeat an id and its vector are one
    units = scratch(
        rows.where("rep IS NOT NULL").groupBy("rep", "vec").agg(F.first("unit").alias("unit"))
        .groupBy("rep").agg(F.min("vec").alias("low"), F.count(F.lit(1)).alias("copies"),
                            F.first("unit").alias("unit")), "representatives")

    def cells_of(batch: pa.RecordBatch) -> pa.RecordBatch:
        col = columns_of(batch, ["rep", "unit"])
        row, cell = [], []
        for at, unit in _matrices(col["unit"]):
            lattice = _lattice(unit.shape[1], tables, blocks, scale, probes, seed)
            for t in range(tables):
                own, near = lattice.cells(unit, t)
                row += [at, np.repeat(at, probes)]
                cell += [own, near.ravel()]
        take = pa.array(np.concatenate(row))
        return pa.RecordBatch.from_arrays(
            [col["rep"].take(take), pa.array(np.concatenate(cell).view(np.int64))],
            names=["rep", "cell"])
    places = scratch(map_batches(units.select("rep", "unit"), cells_of, "rep binary, cell long"), "cells")
    crowded = (places.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
               .select("cell"))
    members = (places.join(crowded, "cell").distinct()
               .join(units.select("rep", "unit"), "rep").select("cell", "rep", "unit"))
    forest = scratch(
        block_pairs(members, ["cell"], "rep", block_rows)
        .select("cell", "rep", "unit", "_i", "_j", "_block").groupBy("cell", "_i", "_j")
        .applyInArrow(_compare(cosine, False), "rep binary, root binary").distinct(), "forest")
    classes = scratch(components(forest, "rep", "root"), "classes")
    inside = units.drop("low").join(classes.withColumnRenamed("node", "rep"), "rep")
    counts = (block_pairs(inside, ["component"], "rep", block_rows)
              .select("component", "rep", "copies", "unit", "_i", "_j", "_block")
              .groupBy("component", "_i", "_j")
              .applyInArrow(_compare(cosine, True), "rep binary, links long")
              .groupBy("rep").agg(F.sum("links").alias("links")))
    named = scratch(
        units.select("rep", "low", "copies").join(classes.withColumnRenamed("node", "rep"), "rep", "left")
        .join(counts, "rep", "left").select(
            "rep", "low", F.coalesce("component", "rep").alias("component"),
            (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links")), "named")
    lowest = named.groupBy("component").agg(F.min("low").alias("component_id"))
    found = named.join(lowest, "component").select("rep", "n_links", "component_id")
    component = F.coalesce("component_id", "vec")
    return rows.select("vec", "rep").join(found, "rep", "left").select(
        F.col("vec").alias(id_col), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"), F.coalesce(component == F.col("vec"), F.lit(True)).alias("kept"))
