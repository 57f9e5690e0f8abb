"""Embedding near-duplicates by a subspace pigeonhole join.

For unit vectors a cosine of at least ``c`` is a squared distance of at most
``2 - 2c``.  A rotation keeps distances; split the rotated coordinates into
blocks, and some block holds no more than its share of that budget.  So each
block is range-joined under its share: vectors lie in grid cells of their
block's first two coordinates, each visits the lower neighbour cells that its
ball reaches, and distances within a cell are taken over the whole block.  So
two vectors near each other meet in the lower of their cells, once.  Pairs that pass
any block are verified exactly, and counted in the first block they pass only,
which each task can tell by itself.

Equal vectors are one class from the start.  A task returns, per class, how
many vectors it links to there and the smallest class it is connected with
there, never the pairs.  Large cells are cut into tiles.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from collections.abc import Iterator
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cofreq.llm.common import connected_components, small_batches
from cofreq.session import materialize

COSINE = 0.9
#: Dimensions of a block.
BLOCK = 16
#: Width of a grid cell, in radii.
CELL = 1.5
#: Vectors at home in a tile, and visitors of a tile.
HOME, VISITORS = 16384, 65536
#: Room for rounding in the blocks' budgets and in coarse (32-bit) distances.
SLACK, COARSE = 1e-9, 1e-4
SEED = 20
#: What a vector is to a tile: at home in its row, at home and met there, a
#: visitor.
HERE, ALSO_HERE, VISITOR = 0, 1, 2


def rotation(dim: int) -> np.ndarray:
    """A random orthogonal matrix, the same each time."""
    q, r = np.linalg.qr(np.random.default_rng(SEED).standard_normal((dim, dim)))
    return q * np.sign(np.diag(r))


def budgets(dim: int, cosine: float) -> list[tuple[int, int, float]]:
    """Blocks as (first, last + 1, squared radius); the radii's sum is the
    whole budget."""
    total = 2 - 2 * cosine
    return [(a, min(a + BLOCK, dim), total * (min(a + BLOCK, dim) - a) / dim + SLACK)
            for a in range(0, dim, BLOCK)]


def unit(vectors: np.ndarray) -> np.ndarray:
    """Rows scaled to length 1, first by their largest component so that no
    square overflows or vanishes."""
    v = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return v / np.sqrt((v * v).sum(axis=1, keepdims=True))


def _visits(cosine: float):
    """For each vector and block: its home cell, and the lower cells it visits."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            cid = b.column(0).to_numpy()
            n_dims = b.column(1).to_numpy()
            data = b.column(2).to_pylist()
            for dim in np.unique(n_dims).tolist():
                of = np.flatnonzero(n_dims == dim)
                v = unit(np.frombuffer(b"".join([data[i] for i in of]), "<f8").reshape(-1, dim))
                y = v @ rotation(dim)
                for block, (lo, hi, budget) in enumerate(budgets(dim, cosine)):
                    radius = np.sqrt(budget) + COARSE
                    width = CELL * radius
                    first = y[:, lo]
                    second = y[:, lo + 1] if hi - lo > 1 else np.zeros(len(y))
                    home = np.floor(first / width).astype(int), np.floor(second / width).astype(int)
                    for dx, dy in ((0, 0), (0, -1), (-1, -1), (-1, 0), (-1, 1)):
                        cx, cy = home[0] + dx, home[1] + dy
                        # distance from the point to that cell
                        gx = np.maximum(np.maximum(cx * width - first, first - (cx + 1) * width), 0)
                        gy = np.maximum(np.maximum(cy * width - second, second - (cy + 1) * width), 0)
                        near = np.flatnonzero(gx * gx + gy * gy <= radius * radius)
                        if len(near):
                            yield pa.RecordBatch.from_arrays(
                                [pa.array(cid[of][near]), pa.array(np.full(len(near), dim, np.int32)),
                                 pa.array(np.full(len(near), block, np.int32)),
                                 pa.array(cx[near].astype(np.int32)), pa.array(cy[near].astype(np.int32)),
                                 pa.array(np.full(len(near), dx == 0 and dy == 0))],
                                names=["cid", "dim", "block", "cx", "cy", "home"])
    return run


def _first_block(a: np.ndarray, b: np.ndarray, q: np.ndarray, blocks: list) -> np.ndarray:
    """First block whose budget the pairs keep, summed in one fixed order, so
    that all tasks agree on it."""
    d = a - b
    y = np.zeros_like(d)
    for j in range(d.shape[1]):
        y += d[:, j:j + 1] * q[j]
    y *= y
    out = np.full(len(d), len(blocks))
    for block in range(len(blocks) - 1, -1, -1):
        lo, hi, budget = blocks[block]
        part = np.zeros(len(d))
        for j in range(lo, hi):
            part += y[:, j]
        out[part <= budget] = block
    return out


def _join(cosine: float):
    """One tile: links of its vectors at home, with later ones of the same
    home and with visitors."""
    def run(table: pa.Table) -> pa.Table:
        dim, block = table.column("dim")[0].as_py(), table.column("block")[0].as_py()
        q, blocks = rotation(dim), budgets(dim, cosine)
        lo, hi, budget = blocks[block]
        cid = table.column("cid").to_numpy()
        role = table.column("role").to_numpy()
        weight = table.column("n").to_numpy()
        raw = np.frombuffer(b"".join(table.column("vector").to_pylist()), "<f8").reshape(-1, dim)
        ids, first, at = np.unique(cid, return_index=True, return_inverse=True)
        raw, weight = raw[first], weight[first]
        v = unit(raw)
        y = (v @ q[:, lo:hi]).astype(np.float32)
        square = (y * y).sum(axis=1, keepdims=True)
        # one product gives the squared distances
        one, two = np.hstack([y, square, np.ones_like(square)]), np.hstack([-2 * y, np.ones_like(square), square])
        # ids ascend, so rows of the distinct classes do too
        left = np.unique(at[role == HERE])
        others = np.unique(at[role == ALSO_HERE]) if table.column("split")[0].as_py() else left
        visitor = np.zeros(len(ids), bool)
        visitor[at[role == VISITOR]] = True
        visitors = np.flatnonzero(visitor)
        links = np.zeros(len(ids), np.int64)
        label = np.arange(len(ids))
        edges = []
        for lo_row in range(0, len(left), 256):
            rows = left[lo_row:lo_row + 256]
            cols = np.concatenate([others[np.searchsorted(others, rows[0], "right"):], visitors])
            if not len(cols):
                continue
            near = np.flatnonzero(one[rows] @ two[cols].T <= np.float32(budget + COARSE))
            i, j = rows[near // len(cols)], cols[near % len(cols)]
            once = visitor[j] | (i < j)
            i, j = i[once], j[once]
            for k in range(0, len(i), 1 << 16):
                a, b = i[k:k + (1 << 16)], j[k:k + (1 << 16)]
                good = np.einsum("ij,ij->i", v[a], v[b]) >= cosine
                a, b = a[good], b[good]
                own = _first_block(v[a], v[b], q, blocks) == block
                a, b = a[own], b[own]
                np.add.at(links, a, weight[b])
                np.add.at(links, b, weight[a])
                edges.append(_forest(a, b, label))
        hit = links > 0
        label = _settle(label, edges)
        return pa.table({"cid": ids[hit], "links": links[hit], "low": ids[label[hit]]})
    return run


def _forest(a: np.ndarray, b: np.ndarray, label: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Joins the ends' labels; returns the pairs that may still differ."""
    for _ in range(64):
        la, lb = label[a], label[b]
        if (la == lb).all():
            break
        low = np.minimum(la, lb)
        np.minimum.at(label, la, low)
        np.minimum.at(label, lb, low)
        label[:] = label[label]
    open_ = label[a] != label[b]
    return a[open_], b[open_]


def _settle(label: np.ndarray, edges: list) -> np.ndarray:
    while True:
        before = label.copy()
        for a, b in edges:
            _forest(a, b, label)
        label = label[label]
        if (label == before).all():
            return label


def near_duplicates(vectors: DataFrame, cosine: float = COSINE) -> DataFrame:
    """``(vec_id, n_links, component_id, kept)``, a row per row of ``vectors``.

    ``n_links``: other rows whose cosine is at least ``cosine``, in double
    precision.  ``component_id``: the smallest vec_id reachable by links, the
    row's own included.  Vectors that are null, empty or zero, or hold a null
    or non-finite component, and rows with a null vec_id link with nothing;
    vectors of different lengths do not link.  Repeated rows are rows of their
    own.  An empty table gives an empty result; other columns are ignored.
    """
    spark = vectors.sparkSession
    small_batches(spark)
    e = F.col("embedding").cast("array<double>")
    sound = (F.col("vec_id").isNotNull() & F.coalesce(
        F.forall(e, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
        & F.exists(e, lambda x: x != 0), F.lit(False)))
    rows = materialize(vectors.select(
        F.col("vec_id").cast("long"), F.when(sound, e).alias("v"),
        F.when(sound, F.xxhash64(e)).alias("k1"), F.when(sound, F.xxhash64(F.lit(1), e)).alias("k2")), "vectors")
    classes = materialize(
        rows.where("v is not null").groupBy("k1", "k2")
        .agg(F.first("v").alias("v"), F.count("*").alias("n"), F.min("vec_id").alias("low_id"))
        .withColumn("cid", F.monotonically_increasing_id()), "classes")

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lists = b.column(1)
            dims = np.diff(lists.offsets.to_numpy())
            flat = lists.flatten().to_numpy().astype("<f8").tobytes()
            ends = np.concatenate([[0], np.cumsum(dims)]) * 8
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(dims.astype(np.int32)),
                 pa.array([flat[x:y] for x, y in zip(ends, ends[1:])], pa.binary()), b.column(2)],
                names=["cid", "dim", "vector", "n"])

    packed = materialize(classes.select("cid", "v", "n").mapInArrow(pack, "cid long, dim int, vector binary, n long"),
                         "packed")
    visits = materialize(packed.select("cid", "dim", "vector").mapInArrow(
        _visits(cosine), "cid long, dim int, block int, cx int, cy int, home boolean"), "visits")
    cell = ["dim", "block", "cx", "cy"]
    # one row for each cell that anything lies in: at most (2 / width)^2 a block
    tiles = visits.groupBy(cell).agg(
        F.ceil(F.sum(F.col("home").cast("int")) / HOME).cast("int").alias("n_left"),
        F.ceil(F.count("*") / VISITORS).cast("int").alias("n_right")).where("n_left > 0")
    placed = visits.join(tiles, cell)
    # A cell of one tile holds each vector once.  In a cut cell a vector at
    # home goes to every tile of its row, and once more, as one that the rows'
    # vectors meet, to every tile of its column, as visitors do.
    salt = F.xxhash64("cid")
    left, right = F.pmod(salt, "n_left").cast("int"), F.pmod(salt, "n_right").cast("int")
    split = (F.col("n_left") > 1) | (F.col("n_right") > 1)

    def tile(row, column, role):
        return F.struct(row.cast("int").alias("row"), column.cast("int").alias("column"), role.alias("role"))

    other = F.when(F.col("home"), F.lit(ALSO_HERE)).otherwise(F.lit(VISITOR))
    rows_of = F.transform(F.sequence(F.lit(0), F.col("n_right") - 1), lambda c: tile(left, c, F.lit(HERE)))
    columns_of = F.transform(F.sequence(F.lit(0), F.col("n_left") - 1), lambda r: tile(r, right, other))
    whole = F.when(F.col("home"), F.lit(HERE)).otherwise(F.lit(VISITOR))
    both = F.when(~split, F.array(tile(F.lit(0), F.lit(0), whole))).when(
        F.col("home"), F.concat(rows_of, columns_of)).otherwise(columns_of)
    dealt = (placed.withColumn("split", split).withColumn("tile", F.explode(both))
             .select("cid", *cell, "split", "tile.row", "tile.column", "tile.role")
             .join(packed.select("cid", "vector", "n"), "cid"))
    found = materialize(
        dealt.groupBy(*cell, "row", "column").applyInArrow(_join(cosine), "cid long, links long, low long"), "links")
    links = found.groupBy("cid").agg(F.sum("links").alias("links"))
    groups = connected_components(found.select("cid", "low"))
    named = classes.select("cid", "k1", "k2", "n", "low_id").join(
        groups, classes.cid == groups.node, "left").withColumn("group", F.coalesce("component", "cid"))
    names = named.groupBy("group").agg(F.min("low_id").alias("component_id"))
    result = named.join(names, "group").join(links, "cid", "left").select(
        "k1", "k2", (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), "component_id")
    return rows.select("vec_id", "k1", "k2").join(result, ["k1", "k2"], "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component_id", "vec_id").alias("component_id"),
        F.coalesce(F.col("vec_id") == F.coalesce("component_id", "vec_id"), F.lit(False)).alias("kept"))
