"""Vector code compression (operator 11): codebooks per part, learned and applied through anchors-hierarchy metric trees.

Vectors become integers and are cut into equal parts. Blocks of vectors are stored once, each with one metric tree per
part, grown from the middle: about sqrt(n) anchors take over the points that are nearer to them, the anchors are merged
upwards by the smallest enclosing ball, and each anchor that still holds many points is divided the same way. Every
ball keeps the sum and the count of its points. An assignment starts at the roots with all entries as candidates; a
ball inherits its parent's candidates and drops those that some other entry beats everywhere in the ball. A ball
with one candidate left is owned wholly: its cached sum and count go to the entry and its points are not looked at.
Points of leaves that are not owned are compared with the candidates left, in exact integers.

A round is one pass over the stored blocks; the sums of all tasks meet in an aggregation of entries x positions.
"""

from __future__ import annotations

import hashlib
import math
import pickle
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablesync.llm.common import broadcast_object, load, staged

PARTS = 16
ENTRIES = 64
ROUNDS = 2
#: Vectors that share a set of trees, and points that a ball may hold without being divided.
BLOCK_ROWS = 4096
LEAF = 12
#: Component sizes up to which squared distances are summed in 64-bit integers; beyond, in Python's.
_EXACT = 1 << 26
#: Numbers held at once while balls or points meet their candidates.
_CHUNK = 1 << 21
#: Distinct labels up to which their sums are broadcast (16 bytes each).
BROADCAST_LABELS = 1_000_000
SALTS = 16

Codebooks = list  # per part: an integer array, entries x positions


@dataclass
class Trees:
    """The balls over all parts of a block, as arrays. ``order``: points by ball, ``row + part * rows``."""

    part: np.ndarray
    total: np.ndarray
    count: np.ndarray
    radius: np.ndarray
    left: np.ndarray  # children, or -1
    right: np.ndarray
    start: np.ndarray  # leaves: their stretch of ``order``
    roots: np.ndarray
    order: np.ndarray


def whole_numbers(vector: list) -> list[int]:
    """floor(256 * x) per component, exactly."""
    return [math.floor(256 * x) if abs(x) < 2**52 else 256 * int(x) for x in vector]


def _anchors(points: np.ndarray, group: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Grow about sqrt(size) anchors in every group at once; returns each point's anchor within its group, and their number.

    ``points`` lie group after group. A new anchor is the point farthest from its own anchor in the group. Points closer
    to their anchor than half its distance to the new one cannot change, and are not compared.
    """
    wanted = np.ceil(np.sqrt(sizes)).astype(np.int64)
    first = points[starts]
    held = [first]
    away = np.sqrt(((points - first[group]) ** 2).sum(1))
    owner = np.zeros(len(points), np.int64)
    grown = np.ones(len(sizes), np.int64)
    for k in range(1, int(wanted.max(initial=1))):
        widest = np.maximum.reduceat(away, starts)
        more = (wanted > k) & (widest > 0)
        if not more.any():
            break
        at = np.flatnonzero((away == widest[group]) & more[group])
        groups, pick = np.unique(group[at], return_index=True)
        new = np.zeros_like(first)
        new[groups] = points[at[pick]]
        half = np.full((len(sizes), k), np.inf)
        for j in range(k):
            half[groups, j] = np.sqrt(((held[j][groups] - new[groups]) ** 2).sum(1)) / 2
        near = np.flatnonzero(away > half[group, owner] * (1 - 1e-9))
        distance = np.sqrt(((points[near] - new[group[near]]) ** 2).sum(1))
        closer = distance < away[near]
        stolen = near[closer]
        away[stolen], owner[stolen] = distance[closer], k
        grown[groups] = k + 1
        held.append(new)
    return owner, grown


def grow_trees(values: np.ndarray, parts: int) -> Trees:
    """One metric tree per part over the rows of ``values`` (integers, rows x components)."""
    rows, width = len(values), values.shape[1] // parts
    exact = values.reshape(rows, parts, width).transpose(1, 0, 2).reshape(parts * rows, width)
    points = exact.astype(float)
    order = np.arange(parts * rows)
    group = np.repeat(np.arange(parts), rows)
    balls: list[list] = []  # part, total, count, radius, left, right, start
    parents = [None] * parts  # what the tree of a group hangs from: a ball, or nothing at the top
    roots = np.zeros(parts, np.int64)
    pending = np.arange(parts)
    while len(pending):
        # All groups of this level are divided at once; group g holds the stretch of ``order`` named by starts[g].
        sizes = np.bincount(group)
        starts = np.cumsum(sizes) - sizes
        base = order[_stretches(pending_start, sizes)] if balls else order
        owner, grown = _anchors(points[base], group, starts, sizes)
        rank = np.lexsort((owner, group))
        base, group_sorted, owner = base[rank], group[rank], owner[rank]
        if balls:
            order[_stretches(pending_start, sizes)] = base
            offset = pending_start
        else:
            order, offset = base, starts
        cut = np.flatnonzero(np.r_[True, (group_sorted[1:] != group_sorted[:-1]) | (owner[1:] != owner[:-1])])
        count = np.diff(np.r_[cut, len(base)])
        of_group = group_sorted[cut]
        total = np.add.reduceat(exact[base], cut, axis=0)
        centre = total.astype(float) / count[:, None]
        spread = np.sqrt(((points[base] - np.repeat(centre, count, axis=0)) ** 2).sum(1))
        radius = np.maximum.reduceat(spread, cut) * (1 + 1e-9)
        begin = offset[of_group] + (cut - starts[of_group])
        part = base[cut] // rows
        first = len(balls)
        balls.extend([p, t, c, r, -1, -1, s] for p, t, c, r, s in zip(part, total, count, radius, begin))
        tops = _merge_up(balls, first, of_group, grown)
        for g, top in enumerate(tops):
            hangs = parents[g]
            if hangs is None:
                roots[part[np.searchsorted(of_group, g)]] = top
            else:
                balls[hangs][4:6] = [top, -1]
        # A group that kept one anchor holds equal points only.
        again = np.flatnonzero((count > LEAF) & (grown[of_group] > 1))
        parents = [first + int(i) for i in again]
        pending, pending_start, sizes = again, begin[again], count[again]
        group = np.repeat(np.arange(len(again)), sizes)
    column = lambda i, kind: np.array([b[i] for b in balls], kind)
    totals = np.array([b[1] for b in balls], exact.dtype).reshape(len(balls), width)
    return Trees(
        column(0, np.int64), totals, column(2, np.int64), column(3, float), column(4, np.int64), column(5, np.int64),
        column(6, np.int64), roots, order,
    )


def _stretches(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The places of several stretches, one after the other."""
    return np.repeat(starts - (np.cumsum(sizes) - sizes), sizes) + np.arange(int(sizes.sum()))


def _merge_up(balls: list[list], first: int, of_group: np.ndarray, grown: np.ndarray) -> list[int]:
    """Merge the anchors of each group into one ball, two at a time, those with the smallest common ball first."""
    groups, most = len(grown), int(grown.max(initial=1))
    member = np.arange(len(of_group)) - np.searchsorted(of_group, of_group)
    size = np.bincount(of_group, minlength=groups)
    dims = len(balls[first][1])
    node = np.full((groups, most), -1, np.int64)
    centre = np.zeros((groups, most, dims))
    count, radius = np.zeros((groups, most)), np.zeros((groups, most))
    node[of_group, member] = first + np.arange(len(of_group))
    count[of_group, member] = [b[2] for b in balls[first:]]
    radius[of_group, member] = [b[3] for b in balls[first:]]
    centre[of_group, member] = np.array([b[1] for b in balls[first:]], float) / count[of_group, member][:, None]
    cost = np.full((groups, most, most), np.inf)
    for i in range(most):
        cost[:, i, :] = _joint(centre, count, radius, node, centre[:, i], count[:, i], radius[:, i], node[:, i])
        cost[:, i, i] = np.inf
    live = np.flatnonzero(size > 1)
    left = size.copy()
    while len(live):
        at = cost[live].reshape(len(live), -1).argmin(1)
        i, j = at // most, at % most
        r = cost[live, i, j]
        total = [balls[a][1] + balls[b][1] for a, b in zip(node[live, i], node[live, j])]
        n = count[live, i] + count[live, j]
        here = len(balls)
        balls.extend(
            [balls[a][0], t, int(c), q, int(a), int(b), -1] for a, b, t, c, q in zip(node[live, i], node[live, j], total, n, r)
        )
        centre[live, i] = np.array(total, float) / n[:, None]
        count[live, i], radius[live, i] = n, r
        node[live, i], node[live, j] = here + np.arange(len(live)), -1
        cost[live, j, :] = np.inf
        cost[live, :, j] = np.inf
        fresh = _joint(centre[live], count[live], radius[live], node[live], centre[live, i], n, r, node[live, i])
        fresh[np.arange(len(live)), i] = np.inf
        cost[live, i, :] = fresh
        cost[live, :, i] = fresh
        left[live] -= 1
        live = live[left[live] > 1]
    return [int(x) for x in node.max(1)]


def _joint(centre, count, radius, node, c, n, r, which) -> np.ndarray:
    """The radius of a ball around the common mean that holds both balls, per group and other member."""
    both = count + n[:, None]
    both = np.where(both > 0, both, 1)
    apart = np.sqrt(((centre - c[:, None, :]) ** 2).sum(2))
    joint = np.maximum(apart * n[:, None] / both + radius, apart * count / both + r[:, None]) * (1 + 1e-9)
    return np.where((node >= 0) & (which >= 0)[:, None], joint, np.inf)


def _nearest(points: np.ndarray, at: np.ndarray, books: np.ndarray, part: np.ndarray, candidates: np.ndarray):
    """Exact nearest candidate entry of single points: entry and squared distance; ties to the lower index."""
    best = np.zeros(len(at), np.int64)
    distance = np.zeros(len(at), points.dtype)
    step = max(1, _CHUNK // max(1, books.shape[1] * points.shape[1]))
    for low in range(0, len(at), step):
        here = slice(low, low + step)
        which, entry = np.nonzero(candidates[here])
        squares = ((points[at[here][which]] - books[part[here][which], entry]) ** 2).sum(1)
        heads = np.flatnonzero(np.r_[True, which[1:] != which[:-1]])
        least = np.minimum.reduceat(squares, heads)
        lengths = np.diff(np.r_[heads, len(which)])
        hit = np.flatnonzero(squares == np.repeat(least, lengths))
        _, firsts = np.unique(which[hit], return_index=True)
        best[here], distance[here] = entry[hit[firsts]], least
    return best, distance


def assign(values: np.ndarray, trees: Trees, codebooks: Codebooks, only_sums: bool):
    """Send all points to their nearest entries.

    With ``only_sums`` returns totals (part x entry x position) and counts, from the cached ones where balls are owned;
    else each point's entry and exact squared distance (part x row).
    """
    rows = len(values)
    parts, entries = len(codebooks), len(codebooks[0])
    width = values.shape[1] // parts
    points = values.reshape(rows, parts, width).transpose(1, 0, 2).reshape(parts * rows, width)
    books = np.array(codebooks, object).reshape(parts, entries, width)
    if points.dtype != object and np.abs(books).max(initial=0) < _EXACT:
        books = books.astype(np.int64)
    elif points.dtype != object:  # large entries, from another block
        points = points.astype(object)
    rough = books.astype(float)
    size = np.abs(rough).max(initial=1.0) + np.abs(points.astype(float)).max(initial=1.0)
    margin = 1e-9 * size * size * width  # rounding never drops a candidate
    between = np.sqrt(((rough[:, :, None, :] - rough[:, None, :, :]) ** 2).sum(3))
    mean = trees.total.astype(float) / trees.count[:, None]
    kind = object if points.dtype == object else np.int64
    total, count = np.zeros((parts, entries, width), kind), np.zeros((parts, entries), np.int64)
    entry, error = np.zeros(parts * rows, np.int64), np.zeros(parts * rows, points.dtype)
    balls, candidates = trees.roots, np.ones((parts, entries), bool)
    loose, loose_candidates = [], []
    step = max(1, _CHUNK // (entries * (width + 1)))
    while len(balls):
        kept = np.empty_like(candidates)
        owner = np.empty(len(balls), np.int64)
        for low in range(0, len(balls), step):
            here = slice(low, low + step)
            ball, part = balls[here], trees.part[balls[here]]
            away = ((mean[ball][:, None, :] - rough[part]) ** 2).sum(2)
            away[~candidates[here]] = np.inf
            best = away.argmin(1)
            lead = away[np.arange(len(ball)), best][:, None] - away + 2 * trees.radius[ball][:, None] * between[part, best]
            kept[here] = candidates[here] & (lead >= -margin)
            kept[here][np.arange(len(ball)), best] = True
            owner[here] = best
        owned = kept.sum(1) == 1
        if only_sums:
            np.add.at(total, (trees.part[balls[owned]], owner[owned]), trees.total[balls[owned]].astype(kind))
            np.add.at(count, (trees.part[balls[owned]], owner[owned]), trees.count[balls[owned]])
            down = ~owned
        else:
            down = np.ones(len(balls), bool)  # every point's distance is asked for
        leaf = down & (trees.left[balls] < 0)
        loose.append(balls[leaf]), loose_candidates.append(kept[leaf])
        inner = down & ~leaf
        children = np.concatenate([trees.left[balls[inner]], trees.right[balls[inner]]])
        inherited = np.concatenate([kept[inner], kept[inner]])
        balls, candidates = children[children >= 0], inherited[children >= 0]
    leaves, left = np.concatenate(loose), np.concatenate(loose_candidates)
    sizes = trees.count[leaves]
    at = trees.order[_stretches(trees.start[leaves], sizes)]
    which = np.repeat(np.arange(len(leaves)), sizes)
    for low in range(0, len(at), _CHUNK // entries):
        here = slice(low, low + _CHUNK // entries)
        part = at[here] // rows
        best, distance = _nearest(points, at[here], books, part, left[which[here]])
        entry[at[here]], error[at[here]] = best, distance
        if only_sums:
            np.add.at(total, (part, best), points[at[here]])
            np.add.at(count, (part, best), 1)
    return (total, count) if only_sums else (entry.reshape(parts, rows), error.reshape(parts, rows))


# --- Spark

_BLOCK = "ids array<bigint>, labels array<bigint>, vectors binary, trees binary"
_USABLE = (
    "v IS NOT NULL AND size(v) > 0 AND size(v) % {parts} = 0"
    " AND forall(v, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < 3.5e38D)"
)


def usable(vectors: DataFrame, parts: int = PARTS) -> DataFrame:
    """``vec_id``, ``label`` and ``v`` of the rows that can be coded.

    Dropped: null vectors, null or non-finite components, and vectors that cannot be cut into equal parts or are not as
    long as the vector of the smallest id. Null ids and labels stay.
    """
    rows = vectors.select(
        F.col("vec_id").cast("bigint").alias("vec_id"), F.col("label").cast("bigint").alias("label"),
        F.col("embedding").cast("array<double>").alias("v"),
    ).where(_USABLE.format(parts=parts))
    first = rows.select("vec_id", F.size("v").alias("n")).orderBy(F.asc_nulls_last("vec_id"), "n").first()
    return rows.where(F.size("v") == (first["n"] if first else 0))


def _pack(ids: list, labels: list, vectors: list, parts: int) -> tuple:
    numbers = np.array(vectors, float)
    if np.abs(numbers).max() < _EXACT / 256:
        values = np.floor(256 * numbers).astype(np.int64)
    else:
        values = np.array([whole_numbers(v) for v in vectors], object)
    return ids, labels, pickle.dumps(_narrow(values)), pickle.dumps({k: _narrow(v) for k, v in vars(grow_trees(values, parts)).items()})


def _narrow(values: np.ndarray) -> np.ndarray:
    """The smallest integer type that holds the values; other arrays as they are."""
    if values.dtype != np.int64 or not values.size:
        return values
    return values.astype(np.promote_types(np.min_scalar_type(min(values.min(), 0)), np.min_scalar_type(-max(values.max(), 0) - 1)))


def _wide(values: np.ndarray) -> np.ndarray:
    return values.astype(np.int64) if values.dtype.kind in "iu" else values


def plant_trees(rows: DataFrame, parts: int = PARTS) -> DataFrame:
    """Blocks of vectors of one task each, with their trees; to be stored before the rounds."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, labels, vectors = [], [], []

        def block() -> pa.RecordBatch:
            packed = _pack(ids, labels, vectors, parts)
            kinds = (pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary(), pa.binary())
            return pa.RecordBatch.from_arrays([pa.array([x], k) for x, k in zip(packed, kinds)], names=["ids", "labels", "vectors", "trees"])

        for batch in batches:
            for row in range(batch.num_rows):
                ids.append(batch.column(0)[row].as_py())
                labels.append(batch.column(1)[row].as_py())
                vectors.append(batch.column(2)[row].values.to_numpy())
                if len(ids) == BLOCK_ROWS:
                    yield block()
                    ids, labels, vectors = [], [], []
        if ids:
            yield block()

    return rows.select("vec_id", "label", "v").mapInArrow(run, _BLOCK)


def _opened(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        for row in batch.to_pylist():
            values = _wide(pickle.loads(row["vectors"]))
            yield row, values, Trees(**{k: _wide(v) for k, v in pickle.loads(row["trees"]).items()})


def _limbs(number: int) -> list[int]:
    """A whole number as 32-bit limbs, lowest first, the last one signed: what sums of longs cannot overflow on."""
    out = []
    while not -(1 << 31) <= number < 1 << 31:
        out.append(number & 0xFFFFFFFF)
        number >>= 32
    return [*out, number]


def learn_round(blocks: DataFrame, codebooks: Codebooks) -> Codebooks:
    """One round: all parts to their nearest entries, each entry to the floor of its parts' mean; unused entries stay."""
    sent = broadcast_object(blocks.sparkSession, codebooks)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        books, totals, counts = sent(), None, None
        for _, values, trees in _opened(batches):
            total, count = assign(values, trees, books, only_sums=True)
            # Python integers: sums of a task have no bound.
            total, count = total.astype(object), count.astype(object)
            totals, counts = (total, count) if totals is None else (totals + total, counts + count)
        if totals is None:
            return
        rows = []
        for part, entry in zip(*np.nonzero(counts)):
            numbers = [*totals[part, entry], counts[part, entry]]
            rows += [(int(part), int(entry), place, limb, x) for place, n in enumerate(numbers) for limb, x in enumerate(_limbs(int(n)))]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(zip(*rows), [pa.int32()] * 4 + [pa.int64()])], names=["part", "entry", "place", "limb", "total"]
        )

    sums = blocks.select("ids", "labels", "vectors", "trees").mapInArrow(run, "part int, entry int, place int, limb int, total bigint")
    # At most parts x entries x (positions + 1) numbers come back, whatever the number of rows.
    found: dict[tuple[int, int], dict[int, int]] = {}
    for r in sums.groupBy("part", "entry", "place", "limb").agg(F.sum("total").alias("total")).collect():
        places = found.setdefault((r["part"], r["entry"]), {})
        places[r["place"]] = places.get(r["place"], 0) + (r["total"] << (32 * r["limb"]))
    out = [[list(entry) for entry in book] for book in codebooks]
    for (part, entry), places in found.items():
        width = len(out[part][entry])
        out[part][entry] = [places[i] // places[width] for i in range(width)]
    return out


def first_codebooks(rows: DataFrame, parts: int = PARTS, entries: int = ENTRIES) -> Codebooks:
    """The parts of the vectors with the smallest ids, ascending; equal ids by vector, null ids last. Fewer rows give fewer entries."""
    taken = rows.select("vec_id", "v").orderBy(F.asc_nulls_last("vec_id"), "v").limit(entries).collect()
    whole = [whole_numbers(r["v"]) for r in taken]
    width = len(whole[0]) // parts if whole else 0
    return [[v[p * width : (p + 1) * width] for v in whole] for p in range(parts)]


def codebooks_digest(codebooks: Codebooks) -> str:
    numbers = ",".join(str(x) for book in codebooks for entry in book for x in entry)
    return hashlib.sha256(numbers.encode()).hexdigest()


def encode(blocks: DataFrame, codebooks: Codebooks) -> DataFrame:
    """``vec_id``, ``label``, ``codes`` (one entry a part) and ``error``: the squared distances summed, null beyond a long."""
    sent = broadcast_object(blocks.sparkSession, codebooks)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        books = sent()
        for row, values, trees in _opened(batches):
            entry, distance = assign(values, trees, books, only_sums=False)
            error = [int(x) if int(x) < 1 << 63 else None for x in distance.astype(object).sum(0)]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(row["ids"], pa.int64()), pa.array(row["labels"], pa.int64()),
                    pa.array(entry.T.tolist(), pa.list_(pa.int32())), pa.array(error, pa.int64()),
                ],
                names=["vec_id", "label", "codes", "error"],
            )

    return blocks.select("ids", "labels", "vectors", "trees").mapInArrow(run, "vec_id bigint, label bigint, codes array<int>, error bigint")


def with_label_error(coded: DataFrame) -> DataFrame:
    """``label_error``: ``error`` summed over rows of an equal label, null labels together, null where no long holds it.

    The sums are broadcast if there are few labels, else joined with a salt, so that a frequent label has no task of its own.
    """
    sums = staged(
        coded.groupBy("label").agg(F.sum(F.col("error").cast("decimal(38,0)")).alias("t")).select(
            F.col("label").alias("l"), F.expr("try_cast(t AS bigint)").alias("label_error")
        ),
        "vector-labels",
    )
    same = F.col("label").eqNullSafe(F.col("l"))
    if sums.count() <= BROADCAST_LABELS:
        return coded.join(F.broadcast(sums), same, "left").drop("l")
    salted = coded.withColumn("s", F.pmod(F.xxhash64("vec_id", "codes"), F.lit(SALTS)))
    copies = sums.withColumn("s2", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)).cast("array<bigint>")))
    return salted.join(copies, same & (F.col("s") == F.col("s2")), "left").drop("l", "s", "s2")


def code_vectors(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> tuple[DataFrame, Codebooks]:
    """Codes of all usable rows and the final codebooks.

    Only ``vec_id``, ``embedding`` and ``label`` are read. Repeated rows are coded each; no usable row gives no rows.
    """
    rows = usable(vectors, parts)
    codebooks = first_codebooks(rows, parts, entries)
    blocks = staged(plant_trees(rows, parts), "vector-trees")
    for _ in range(rounds):
        codebooks = learn_round(blocks, codebooks)
    coded = staged(encode(blocks, codebooks), "vector-codes")
    return with_label_error(coded), codebooks


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded, codebooks = code_vectors(load(spark, sf_dir, "embeddings"))
    code = F.concat_ws("", F.transform("codes", lambda c: F.lpad(F.lower(F.hex(c)), 2, "0")))
    return coded.select("vec_id", code.alias("code"), "error", "label_error", F.lit(codebooks_digest(codebooks)).alias("codebooks_sha256"))


_SQL_PARTS = f"""
WITH kept AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor(CAST(x AS DOUBLE) * 256) AS BIGINT)) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
), parts AS (
  SELECT vec_id, p, list_slice(v, CAST(p * len(v) / {PARTS} AS BIGINT) + 1, CAST((p + 1) * len(v) / {PARTS} AS BIGINT)) AS x
  FROM kept, range({PARTS}) AS r(p)
), first AS (
  SELECT p, e, x FROM (SELECT p, x, row_number() OVER (PARTITION BY p ORDER BY vec_id) - 1 AS e FROM parts) WHERE e < {ENTRIES}
)"""


def _sql_round(before: str, after: str) -> str:
    near = _sql_near(before)
    return f""", {after}_near AS MATERIALIZED ({near}), {after}_mean AS (
  SELECT p, e, list(m ORDER BY i) AS x FROM (
    SELECT n.p, n.e, i, CAST(floor(CAST(sum(n.x[i]) AS DOUBLE) / count(*)) AS BIGINT) AS m
    FROM {after}_near n, range(1, (SELECT len(any_value(x)) FROM parts) + 1) AS r(i) GROUP BY n.p, n.e, i
  ) GROUP BY p, e
), {after} AS MATERIALIZED (SELECT b.p, b.e, coalesce(m.x, b.x) AS x FROM {before} b LEFT JOIN {after}_mean m ON m.p = b.p AND m.e = b.e)"""


def _sql_near(books: str) -> str:
    square = "list_sum(list_transform(range(1, len(a.x) + 1), lambda i: (a.x[i] - b.x[i]) * (a.x[i] - b.x[i])))"
    return f"""SELECT vec_id, p, x, k % {ENTRIES} AS e, k // {ENTRIES} AS d FROM (
  SELECT a.vec_id, a.p, a.x, min(CAST({square} AS BIGINT) * {ENTRIES} + b.e) AS k
  FROM parts a JOIN {books} b ON a.p = b.p GROUP BY a.vec_id, a.p, a.x)"""


#: The same by comparing every part with every entry.
OP11_SQL = _SQL_PARTS + _sql_round("first", "one") + _sql_round("one", "two") + f""", final AS (
  {_sql_near("two")}
), coded AS (
  SELECT f.vec_id, any_value(k.label) AS label, string_agg(lower(format('{{:02x}}', e)), '' ORDER BY f.p) AS code, CAST(sum(d) AS BIGINT) AS error
  FROM final f JOIN kept k ON k.vec_id = f.vec_id GROUP BY f.vec_id
), books AS (
  SELECT sha256(string_agg(array_to_string(x, ','), ',' ORDER BY p, e)) AS codebooks_sha256 FROM two
)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256 FROM coded, books
"""
