"""Embedding near-dedup: spherical k-means cells, and blocks of them whose cosine products are read from shared files.

1. Rows with the same label and the same vector form a class with a count, so any
   number of copies is one row from here on. Labels with up to ``block`` vectors of one
   length are compared at once, in the task that gathers them.
2. For the others spherical k-means is fitted on a bounded sample (``sample`` vectors); every
   class goes to its nearest centre's cell, and in it to a block of up to ``block`` rows that lie
   close together. A vector is shuffled once and written once, to its block in the shared folder.
3. A task reads some blocks of one cell and, one after the other, those blocks of its label that
   may hold partners; a vector is never copied for a comparison, so disk grows with the input alone.
   What is left out can't reach the cosine t. Two unit vectors that do are at most
   sqrt(2 - 2t) apart, so partners x and y of the cells c and c' satisfy x.(c - c') <= sqrt(2 - 2t) |c - c'|
   and likewise y; and x is at most the block's radius plus acos(t) from the centre of y's block.
   Products of some leading components, with those of the rests' lengths, rule out most rows; then single
   precision decides on a pair unless it is so near t that double precision must.
4. A task counts the links of its own rows and joins them to local components. Of two tasks'
   rows it names one link for each piece that these links form; both tasks see the same piece
   and join its rows on their own side. The named links join the local components to connected
   components; the smallest vec_id represents each.

Defined results: rows with a null label, and vectors that are null, empty, zero or
hold null or non-finite components, have no links and are their own component; vectors
of different lengths are not compared. Rows with equal vec_ids are vectors of their own;
a null vec_id names a component only if all its ids are null. Extra columns are not read.
"""

from __future__ import annotations

import io
import math
import uuid
from collections import Counter, namedtuple
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs as stores
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

from postlytics.session import fresh_dir

from .common import staged
from .components import connected_components

# Most components of vectors that one task sorts into blocks, and of those it compares with others;
# rows of the cones in a block.
SHARD, TILE, LEAF = 1 << 22, 1 << 20, 64

# Classes in memory: unit rows in double and in single precision, and their ``head``; ``named`` is false where vec_id is null.
Rows = namedtuple("Rows", "v n vec_id named unit single head")
# Runs of a block's rows: where they end, their centres and radii.
Leaves = namedtuple("Leaves", "ends centre reach")


def unit(values: np.ndarray) -> np.ndarray:
    """Rows scaled to length 1, first by their largest component so that squares stay finite."""
    values = values / np.abs(values).max(axis=1, keepdims=True)
    return values / np.sqrt((values * values).sum(axis=1, keepdims=True))


def spherical_kmeans(x: np.ndarray, k: int, rounds: int = 12, seed: int = 3) -> np.ndarray:
    """``k`` (or fewer) unit centres of the unit rows of ``x``."""
    rng = np.random.default_rng(seed)
    centres = x[np.sort(rng.choice(len(x), min(k, len(x)), replace=False))]
    for _ in range(rounds):
        cell = (x @ centres.T).argmax(1)
        sums = np.zeros_like(centres)
        np.add.at(sums, cell, x)
        length = np.sqrt((sums * sums).sum(1))
        centres = np.where(length[:, None] > 1e-9, sums / np.maximum(length, 1e-9)[:, None], centres)
    return np.unique(centres, axis=0)


def nearest(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Each row's nearest centre, by sums that don't depend on the rows beside it: copies in other batches get the same."""
    near = x @ c.T
    out = near.argmax(1)
    near = near >= near.max(1, keepdims=True) - 1e-9
    unsure = np.flatnonzero(np.count_nonzero(near, axis=1) > 1)
    for s in range(0, len(unsure), 64):
        rows = unsure[s:s + 64]
        out[rows] = np.where(near[rows], (x[rows][:, None] * c).sum(2), -2).argmax(1)
    return out


def _matrix(packed, dim: int, kind) -> np.ndarray:
    return np.frombuffer(b"".join(packed), kind).reshape(-1, dim)


def _classes(v: np.ndarray, vec_id: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(order of the rows by v and then vec_id, nulls last; where each class begins in it; rows of each)."""
    order = np.lexsort((vec_id.fill_null(0).to_numpy(zero_copy_only=False), vec_id.is_null().to_numpy(zero_copy_only=False), v))
    starts = np.flatnonzero(np.r_[True, v[order][1:] != v[order][:-1]])
    return order, starts, np.diff(np.r_[starts, len(v)])


def _store(url: str):
    """(file system, path) of a shared folder, for workers too."""
    if "://" in url or url.startswith("file:"):
        return stores.FileSystem.from_uri(url.replace("s3a://", "s3://").replace("file:///", "file:/").replace("file:/", "file:///"))
    return stores.LocalFileSystem(), url


def _write(folder: str, name: str, *parts: bytes) -> None:
    store, path = _store(folder)
    with store.open_output_stream(f"{path}/{name}") as out:
        for part in parts:
            out.write(part)


def _read(folder: str, name: str, at: int, size: int | None = None) -> bytes:
    store, path = _store(folder)
    with store.open_input_file(f"{path}/{name}") as held:
        return held.read_at(held.size() - at if size is None else size, at)


def heads(x: np.ndarray, turn: np.ndarray) -> np.ndarray:
    """Components of the unit rows along ``turn`` and the length of their rests: no product of two rows exceeds that of their heads."""
    lead = x @ turn
    rest = np.sqrt(np.maximum(0, 1 - (lead * lead).sum(1, keepdims=True))) + 1e-7
    return np.hstack([lead, rest]).astype(np.float32) if turn.shape[1] else lead


def leading(x: np.ndarray, t: float) -> np.ndarray:
    """Orthonormal columns, as few as rule out nearly all pairs of the unit rows ``x`` that don't reach t; none if it takes too many."""
    dim = x.shape[1]
    turn = np.linalg.eigh(x.T @ x)[1][:, ::-1]
    x = x[:1000]
    alike = np.count_nonzero(x @ x.T >= t)
    for m in sorted({dim * eighths // 8 for eighths in range(1, 7)} - {0}):
        head = heads(x, turn[:, :m])
        if np.count_nonzero(head @ head.T >= t) - alike <= 3e-5 * len(x) ** 2:
            return turn[:, :m]
    return turn[:, :0]


def _rows(raw: np.ndarray, v: np.ndarray, n: np.ndarray, vec_id: np.ndarray, named: np.ndarray, turn: np.ndarray) -> Rows:
    x = unit(raw.astype(np.float64))
    return Rows(v, n, vec_id, named, x, x.astype(np.float32), heads(x, turn))


def _packed(raw: np.ndarray, v: np.ndarray, n: np.ndarray, vec_id: np.ndarray, named: np.ndarray, leaves: Leaves) -> list[bytes]:
    whole = [np.asarray(x, np.int64).tobytes() for x in (leaves.ends, v, n, vec_id)]
    return [whole[0], leaves.centre.tobytes(), leaves.reach.tobytes(), raw.tobytes(), *whole[1:], named.tobytes()]


def _read_leaves(folder: str, name: str, at: int, leaves: int, dim: int) -> Leaves:
    ends, centre, reach = np.split(np.frombuffer(_read(folder, name, at, leaves * (dim + 2) * 8), np.float64), [leaves, leaves * (dim + 1)])
    return Leaves(ends.view(np.int64), centre.reshape(leaves, dim), reach)


def _read_block(folder: str, name: str, at: int, leaves: int, rows: int, dim: int, kind, turn: np.ndarray) -> Rows:
    width = dim * np.dtype(kind).itemsize
    raw = _read(folder, name, at + leaves * (dim + 2) * 8, rows * (width + 25))
    parts = np.split(np.frombuffer(raw, np.uint8), rows * (width + np.array([0, 8, 16, 24])))
    return _rows(parts[0].view(kind).reshape(rows, dim), *(p.view(np.int64) for p in parts[1:4]), parts[4].view(bool), turn)


def single_error(dim: int) -> float:
    """Most by which a product of two unit rows in single precision can be wrong, doubled."""
    return (dim + 8) * 2.0 ** -23


def links_between(left: Rows, right: Rows, rows: np.ndarray, cols: np.ndarray, t: float,
                  offset: int | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(rows with links, columns with links, which) among ``rows`` of left and ``cols`` of right; the
    right rows are those of left from ``offset`` on, if it is given, and a row isn't its own link."""
    error, found, kept = single_error(left.unit.shape[1]), [], []
    other, head = (x if len(cols) == len(right.v) else x[cols] for x in (right.single, right.head))
    lead = head.shape[1] > 0
    for s in range(0, len(rows) if len(cols) else 0, 512):
        mine = rows[s:s + 512]
        if lead:
            hit = (left.head[mine] @ head.T).max(1) >= t - error
            lead = 2 * np.count_nonzero(hit) < len(mine)  # where most rows have partners it doesn't help
            mine = mine[hit]
            if not len(mine):
                continue
        product = left.single[mine] @ other.T
        hit = product.max(1) >= t - error
        if not hit.any():
            continue
        if not hit.all():
            mine, product = mine[hit], product[hit]
        near, maybe = product >= t + error, product >= t - error
        if np.count_nonzero(near) < np.count_nonzero(maybe):
            i, j = np.nonzero(maybe & ~near)
            for p in range(0, len(i), 1 << 14):
                a, b = i[p:p + (1 << 14)], j[p:p + (1 << 14)]
                near[a, b] = (left.unit[mine[a]] * right.unit[cols[b]]).sum(1) >= t
        if offset is not None:
            near[mine[:, None] == offset + cols] = False
        hit = near.any(1)
        found.append(mine[hit])
        kept.append(near[hit])
    if not found:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty((0, 0), bool)
    near = np.concatenate(kept)
    met = near.any(0)
    return np.concatenate(found), cols[met], near if met.all() else near[:, met]


def pieces(near: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(smallest row of each row's connected piece, of each column's); every row and column has a link.

    A few links join most; then those between two pieces that are left are added, one a row.
    """
    a, b = near.shape
    rest = np.flatnonzero(~near[0])
    i = np.r_[np.arange(a), np.zeros(b - len(rest), np.int64), near[:, rest].argmax(0)]
    j = np.r_[near.argmax(1), np.flatnonzero(near[0]), rest]
    while True:
        row = join(np.arange(a + b), i, a + j)
        col, row = row[a:], row[:a]
        if row.min() == row.max():
            return row, col
        apart = near & (row[:, None] != col)
        more = np.flatnonzero(apart.any(1))
        if not len(more):
            return row, col
        i, j = np.r_[i, more], np.r_[j, apart[more].argmax(1)]


def join(root: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """The roots (each the smallest of its own) once every x is joined to its y."""
    while (root[x] != root[y]).any():
        p, q = root[x], root[y]
        np.minimum.at(root, np.maximum(p, q), np.minimum(p, q))
        while (root != root[root]).any():
            root = root[root]
    return root


def blocks_of(x: np.ndarray, block: int, rounds: int = 12) -> list[np.ndarray]:
    """The rows of ``x`` in lists of up to ``block`` that lie close together."""
    k = -(-len(x) // block)
    if k == 1:
        return [np.arange(len(x))]
    c = spherical_kmeans(x[np.linspace(0, len(x) - 1, min(len(x), 64 * k)).astype(np.int64)], k, rounds)
    near = x @ c.T
    cell = near.argmax(1)
    out = []
    for j in np.unique(cell):
        rows = np.flatnonzero(cell == j)
        rows = rows[np.argsort(-near[rows, j], kind="stable")]
        out += [rows[s:s + block] for s in range(0, len(rows), block)]
    return out


def cone(x: np.ndarray) -> tuple[np.ndarray, float]:
    """(unit centre of unit rows, angle from it within which all lie)."""
    c = x.sum(0)
    length = np.sqrt(c @ c)
    c = c / length if length > 1e-9 * len(x) else x[0]
    return c, math.acos(max(-1.0, min(1.0, (x @ c).min()))) + 1e-7


def within(angle, theta: float):
    """Least cosine to the centre of a cone that a partner of one of its rows can have."""
    return np.cos(np.minimum(np.pi, angle + theta))


class Tile:
    """Rows that a task compares with blocks: their links and their components so far."""

    def __init__(self, left: Rows, t: float):
        self.left, self.t = left, t
        self.links, self.root = np.zeros(len(left.v), np.int64), np.arange(len(left.v))
        self.named: list[tuple[np.ndarray, np.ndarray]] = []

    def meet(self, right: Rows, rows: np.ndarray, cols: np.ndarray, offset: int | None = None, name: bool = False) -> None:
        """Compare these rows with these of ``right``; ``name`` one link of each piece that forms."""
        rows, cols, near = links_between(self.left, right, rows, cols, self.t, offset)
        if not len(rows):
            return
        self.links[rows] += np.count_nonzero(near, axis=1)
        if len(more := np.flatnonzero(right.n[cols] > 1)):
            self.links[rows] += (near[:, more] @ (right.n[cols[more]] - 1.0)).astype(np.int64)
        row, col = pieces(near)
        self.root = join(self.root, rows, rows[row])
        if offset is not None:
            self.root = join(self.root, offset + cols, rows[col])
        elif name:
            piece, first = np.unique(col, return_index=True)
            self.named.append((rows[piece], right.v[cols[first]]))


_index: dict[str, dict] = {}


def compare(folder: str, index: str, first: int, last: int, dim: int, kind, c: np.ndarray, turn: np.ndarray, t: float) -> Tile:
    """The blocks from ``first`` to before ``last`` of one cell with all of their label."""
    if index not in _index:
        _index.clear()
        _index[index] = dict(np.load(io.BytesIO(_read(folder, index, 0))))
    b = _index[index]
    theta, chord, slack = math.acos(t) if t > -1 else math.pi, math.sqrt(2 - 2 * t), 2 * single_error(dim)
    place = lambda q: (folder, str(b["name"][q]), int(b["at"][q]), int(b["leaves"][q]))
    block = lambda q: _read_block(*place(q), int(b["rows"][q]), dim, kind, turn)
    own = [block(q) for q in range(first, last)]
    tile = Tile(Rows(*(np.concatenate(x) for x in zip(*own))), t)
    left, offsets = tile.left, np.r_[0, np.cumsum([len(x.v) for x in own])]
    cell, centre, reach = int(b["cell"][first]), b["centre"], b["reach"]
    gap = np.sqrt(np.maximum(0, 2 - 2 * (c @ c[cell]))) * chord + slack
    near = left.single @ c.T.astype(np.float32)
    may = near[:, [cell]] - near <= gap
    apart = np.arccos(np.clip(centre[first:last] @ centre.T, -1, 1)) - reach[first:last, None] - reach
    cones, widths = centre[first:last].T.astype(np.float32), within(reach[first:last], theta) - slack
    for q in np.flatnonzero((apart.min(0) <= theta + 1e-6) & may.any(0)[b["cell"]]):
        rows = np.flatnonzero(may[:, b["cell"][q]] & (left.single @ centre[q].astype(np.float32) >= within(reach[q], theta) - slack))
        if not len(rows):
            continue
        leaves = _read_leaves(*place(q), dim)
        chosen = left.single if len(rows) == len(left.v) else left.single[rows]
        held = chosen @ leaves.centre.T.astype(np.float32) >= within(leaves.reach, theta) - slack
        size = np.diff(leaves.ends, prepend=0)
        wanted = np.flatnonzero(held.any(0))
        if not len(wanted):
            continue
        right = own[q - first] if first <= q < last else block(q)
        there = (right.single @ cones >= widths).any(1)
        if b["cell"][q] != cell:
            there &= right.single @ (c[b["cell"][q]] - c[cell]).astype(np.float32) <= gap[b["cell"][q]]
        # most pairs: in one product
        whole = np.count_nonzero(held, axis=0) @ size > 0.3 * len(rows) * size.sum()
        for run in [wanted] if whole else wanted[:, None]:
            cols = np.concatenate([np.arange(leaves.ends[i] - size[i], leaves.ends[i]) for i in run])
            tile.meet(right, rows if whole else rows[held[:, run[0]]], cols[there[cols]],
                      offsets[q - first] if first <= q < last else None, q >= last)
    return tile


def drawn(fine: DataFrame, n: int, sample: int) -> tuple[pa.Table, float]:
    """(up to ``sample`` different vectors (v, label, x) of these n rows, about how many different ones there are)."""
    share = min(1.0, sample / n)
    while True:
        cut = min((1 << 63) - 1, int(share * 2.0 ** 64) - (1 << 63))
        found = fine.where(F.col("v") <= cut).groupBy("v").agg(F.first("label").alias("label"), F.first("x").alias("x")).toArrow()
        if share == 1 or found.num_rows >= sample / 2:
            return found.sort_by("v").slice(0, sample), found.num_rows / share
        share = min(1.0, share * max(2, sample / max(4, found.num_rows)))


def near_duplicates(vectors: DataFrame, t: float = 0.93, sample: int = 20_000, cell_rows: int = 2000,
                    most_cells: int = 256, block: int = 2000) -> DataFrame:
    """Per vector: vec_id, n_links, component_id, kept."""
    spark = vectors.sparkSession
    element = vectors.schema["embedding"].dataType.elementType
    kind = np.float32 if isinstance(element, FloatType) else np.float64
    x = F.col("embedding") if isinstance(element, (FloatType, DoubleType)) else F.col("embedding").cast("array<double>")
    low, high = F.array_min("x"), F.array_max("x")  # of a NaN and others NaN is the largest
    inf, nan = float("inf"), F.lit(float("nan")).cast("float" if kind is np.float32 else "double")
    # overlap with a NaN is null if there is none but a null
    fine = (F.col("label").isNotNull() & (F.size("x") > 0) & ~F.arrays_overlap("x", F.array(nan)) & (high < inf) & (low > -inf)
            & ((high != 0) | (low != 0)))
    # hashes of -0.0 and 0.0 are equal
    rows = (vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"), F.col("label").cast("string").alias("label"), x.alias("x"))
            .withColumn("v", F.when(F.coalesce(fine, F.lit(False)), F.xxhash64("label", "x"))))
    held = rows.where("v IS NOT NULL").withColumn("dim", F.size("x"))

    per = staged(held.groupBy("label", "dim").agg(F.count("*").alias("n")), "sizes")
    big = {(r.label, r.dim): r.n for r in per.where(F.col("n") > block).collect()}
    centres, turns, shards = {}, {}, {}
    for dim in sorted({d for _, d in big}):
        sizes = {label: n for (label, d), n in big.items() if d == dim}
        most = max(block, SHARD // dim)
        k = min(most_cells, max(1, sum(sizes.values()) // (cell_rows * len(sizes))))
        turns[dim] = np.empty((dim, 0))
        if k > 1:
            n = per.where(F.col("dim") == dim).agg(F.sum("n")).first()[0]
            found, different = drawn(held.where(F.col("dim") == dim), n, sample)
            points = unit(found.column("x").combine_chunks().flatten().to_numpy().astype(np.float64).reshape(-1, dim))
            centres[dim], turns[dim] = spherical_kmeans(points, k), leading(points, t)
            share = different / len(points)
            of = Counter(zip(found.column("label").to_pylist(), nearest(points, centres[dim]).tolist()))
            counts = {(label, cell): n * share for (label, cell), n in of.items() if label in sizes}
        else:
            centres[dim] = np.eye(1, dim)
            counts = {(label, 0): n for label, n in sizes.items()}
        shards |= {(label, dim, cell): math.ceil(n / most) for (label, cell), n in counts.items() if n > most}

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Each class of a batch with its cell (-1 for small labels) and its part of it."""
        for batch in batches:
            dims = batch.column(4).to_numpy()
            for dim in np.unique(dims).tolist():
                part = batch.filter(pa.array(dims == dim))
                order, starts, n = _classes(part.column(2).to_numpy(), part.column(0))
                part = part.take(pa.array(order[starts]))
                raw = part.column(3).flatten().to_numpy().reshape(-1, dim) + kind(0)  # makes -0.0 and 0.0 one value
                coded = part.column(1).dictionary_encode()
                names, label = coded.dictionary.to_pylist(), coded.indices.to_numpy()
                mine = np.flatnonzero(np.array([(name, dim) in big for name in names])[label])
                cell, parts = np.full(len(n), -1), np.ones(len(n), np.int64)
                if len(mine):
                    cell[mine] = nearest(unit(raw[mine].astype(np.float64)), centres[dim])
                    group, at = np.unique(np.stack([label[mine], cell[mine]]), axis=1, return_inverse=True)
                    parts[mine] = np.array([shards.get((names[i], dim, j), 1) for i, j in group.T.tolist()])[at]
                v, ends = part.column(2).to_numpy(), np.arange(len(n) + 1, dtype=np.int32) * np.int32(dim * raw.itemsize)
                packed = pa.Array.from_buffers(pa.binary(), len(n), [None, pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(raw))])
                yield pa.RecordBatch.from_arrays(
                    [part.column(1), pa.array(np.full(len(n), dim, np.int32)), pa.array(cell.astype(np.int32)),
                     pa.array(((v >> 20) % parts).astype(np.int32)), part.column(2), pa.array(n), part.column(0), packed],
                    ["label", "dim", "cell", "shard", "v", "n", "vec_id", "vec"])

    folder = fresh_dir(spark, "blocks")
    if big:  # only then are there files
        store, path = _store(folder)
        store.create_dir(path)
    counted = "v bigint, n bigint, vec_id bigint, links bigint, root bigint"
    placed = pa.schema([("v", pa.int64()), ("n", pa.int64()), ("vec_id", pa.int64()), ("links", pa.int64()), ("root", pa.int64()),
                        ("label", pa.string()), ("dim", pa.int32()), ("cell", pa.int32()), ("file", pa.string()), ("tile", pa.int32()),
                        ("at", pa.int64()), ("rows", pa.int32()), ("leaves", pa.int32()), ("centre", pa.binary()), ("reach", pa.float64())])

    def table(schema: pa.Schema, size: int, **columns) -> pa.Table:
        return pa.table([columns[f.name] if f.name in columns else pa.nulls(size, f.type) for f in schema], schema=schema)

    def results(tile: Tile) -> dict:
        left = tile.left
        return {"v": left.v, "n": left.n, "vec_id": pa.array(left.vec_id, mask=~left.named), "links": tile.links, "root": left.v[tile.root]}

    def place(key: tuple, got: pa.Table) -> pa.Table:
        """A small label's links, or the blocks of a part of a cell, which are written."""
        label, dim, cell, _ = (k.as_py() for k in key)
        got = got.combine_chunks()
        v, vec_id = got.column("v").to_numpy(), got.column("vec_id").combine_chunks()
        order, starts, _ = _classes(v, vec_id)
        first = order[starts]
        ids, named = vec_id.fill_null(0).to_numpy(zero_copy_only=False)[first], vec_id.is_valid().to_numpy(zero_copy_only=False)[first]
        n = np.add.reduceat(got.column("n").to_numpy()[order], starts)
        raw = _matrix(got.column("vec").to_pylist(), dim, kind)[first]
        if cell < 0:
            tile = Tile(_rows(raw, v[first], n, ids, named, np.empty((dim, 0))), t)
            every = np.arange(len(n))
            tile.meet(tile.left, every, every, 0)
            return table(placed, len(n), **results(tile))
        x, name = unit(raw.astype(np.float64)), uuid.uuid4().hex
        v, found, parts, at, tile, held = v[first], [], [], 0, 0, 0
        for rows in blocks_of(x, block):
            if held and (held + len(rows)) * dim > TILE:
                tile, held = tile + 1, 0
            held += len(rows)
            runs = [rows[run] for run in blocks_of(x[rows], LEAF, 4)]
            rows = np.concatenate(runs)
            centre, reach = cone(x[rows])
            leaves = Leaves(np.cumsum([len(run) for run in runs]), *map(np.array, zip(*(cone(x[run]) for run in runs))))
            parts += _packed(raw[rows], v[rows], n[rows], ids[rows], named[rows], leaves)
            found.append((tile, at, len(rows), len(runs), centre.tobytes(), reach))
            at += sum(map(len, parts[-8:]))
        _write(folder, name, *parts)
        m = len(found)
        tiles, ats, sizes, leaves, middles, reaches = zip(*found)
        return table(placed, m, label=pa.array([label] * m), dim=pa.array([dim] * m, pa.int32()), cell=pa.array([cell] * m, pa.int32()),
                     file=pa.array([name] * m), tile=pa.array(tiles, pa.int32()), at=pa.array(ats, pa.int64()), rows=pa.array(sizes, pa.int32()),
                     leaves=pa.array(leaves, pa.int32()), centre=pa.array(middles, pa.binary()), reach=pa.array(reaches, pa.float64()))

    dealt = held.select("vec_id", "label", "v", "x", "dim").mapInArrow(
        deal, "label string, dim int, cell int, shard int, v bigint, n bigint, vec_id bigint, vec binary")
    out = staged(dealt.groupBy("label", "dim", "cell", "shard").applyInArrow(
        place, counted + ", label string, dim int, cell int, file string, tile int, at bigint, rows int, leaves int, centre binary, reach double"), "classes")
    classes = out.where("file IS NULL").select("v", "n", "vec_id", "links", "root")
    comps = None
    if big:
        def indexed(key: tuple, got: pa.Table) -> pa.Table:
            """A label's list of blocks, which is written, and the blocks of each task that is to read it."""
            got, dim, name = got.sort_by([("cell", "ascending"), ("file", "ascending"), ("at", "ascending")]), key[1].as_py(), f"index-{uuid.uuid4().hex}"
            columns = {c: got.column(c).to_numpy() for c in ("cell", "tile", "at", "rows", "leaves", "reach")}
            packed = io.BytesIO()
            np.savez(packed, name=np.array(got.column("file").to_pylist()), centre=_matrix(got.column("centre").to_pylist(), dim, np.float64), **columns)
            _write(folder, name, packed.getvalue())
            files = got.column("file").to_pylist()
            starts = [i for i in range(len(files)) if not i or (files[i], columns["tile"][i]) != (files[i - 1], columns["tile"][i - 1])]
            return pa.table({"dim": pa.array([dim] * len(starts), pa.int32()), "index": pa.array([name] * len(starts)),
                             "first": pa.array(starts, pa.int64()), "last": pa.array(starts[1:] + [len(files)], pa.int64())})

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            schema = pa.schema([*list(placed)[:5], ("other", pa.int64())])
            for batch in batches:
                for task in batch.to_pylist():
                    tile = compare(folder, task["index"], task["first"], task["last"], task["dim"], kind, centres[task["dim"]], turns[task["dim"]], t)
                    yield from table(schema, len(tile.links), **results(tile)).to_batches()
                    if tile.named:
                        mine, other = (np.concatenate(e) for e in zip(*tile.named))
                        yield from table(schema, len(mine), v=tile.left.v[tile.root[mine]], other=other).to_batches()

        tasks = staged(out.where("file IS NOT NULL").groupBy("label", "dim").applyInArrow(
            indexed, "dim int, index string, first bigint, last bigint"), "tasks")
        met = staged(tasks.repartition(min(1 << 14, max(1, tasks.count()))).mapInArrow(run, counted + ", other bigint"), "met")
        store.delete_dir(path)  # all that is left to do is on ids
        classes = classes.union(met.where("other IS NULL").drop("other"))
        ends = met.where("other IS NOT NULL").select(F.col("v").alias("a"), "other").distinct()
        comps = connected_components(ends.join(classes.select(F.col("v").alias("other"), F.col("root").alias("b")), "other"))
    if comps is None:
        named = classes.withColumn("comp", F.col("root"))
    else:
        named = (classes.join(comps.select(F.col("v").alias("root"), "comp"), "root", "left")
                 .withColumn("comp", F.coalesce("comp", "root")))
    smallest = named.groupBy("comp").agg(F.min("vec_id").alias("component_id"))
    by_class = named.join(smallest, "comp").select("v", (F.col("links") + F.col("n") - 1).alias("n_links"), "component_id")
    whole = rows.select("vec_id", "v").join(by_class, "v", "left")
    component = F.when(F.col("v").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    return whole.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"), component.alias("component_id"),
                        F.col("vec_id").eqNullSafe(component).alias("kept"))
