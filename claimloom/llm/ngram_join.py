"""N-gram Jaccard join: all pairs of texts whose shingle sets are similar, and the groups they form.

A set is a point of group counts: shingles are hashed to groups. The sum of coordinate minima of two points (or
of the upper corners of two boxes) bounds the overlap of the sets (or of any two sets in the boxes). Points are
held by a packed tree:

1. Size bands. Similar sets differ little in size, so a set lies in its band and, near the upper end, in the next.
2. Cells. In a band whose sets may differ in D shingles at most, shingles are dealt to more than D slices, so similar sets
   agree in a whole slice. The content of a slice names the cell; empty slices count only for the few sets that
   fill too few slices to be sure of a common one. All cells have one order, by the sets they hold: of two similar sets, at most as many cells
   as they differ in shingles lie before the first common one, so each set leaves out the hottest of its cells beyond that number and one.
   Of cells with the same sets one is kept; a cell of two sets is a pair of its own.
3. Inner boxes and leaves. The points of a cell are sorted by group, size and coordinates and packed in leaves, and `FANOUT` leaves in an
   inner box. Pairs of inner boxes are bounded, then pairs of leaves below those that are left.
4. Points. Boxes have 64 coordinates, which say little of a large set, whose counts are all much alike. So the coordinates of a point grow
   with its set: groups in a power of two, at least `least_groups` and at most `per_group` shingles to a group, and with another point both
   are folded to the fewer. Only pairs of points whose bound suffices leave the task, and are bounded once more on at most 4 shingles to a group.
   With a point go the `FIRSTS` least of its cells; a pair that has one in common below the present cell leaves another task, not this one.

Before the descent each set is compared with the least of one cell and then with those of its other cells from which it is
still apart (linear in the cells). Boxes that lie in one connected group go: no pair inside such a group is
looked at, so a large group of copies costs no square. What remains is verified on the shingles. Nothing is capped.

Shingles are known by 64-bit digests. So are sets, by sums of their shingles' digests; a second such number tells whether two sets
share the first one, and then all sets are named anew with another salt.
"""

from bisect import bisect_right
from itertools import count
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from claimloom.llm.common import BLOCK_BYTES, Stages, blocks, checked, components, lists, mix, salted, shingles, with_neutral_names

GROUPS = 64
LEAF = 128
FANOUT = 16
FIRSTS = 16
BAND = 1.5


def band_starts(limit: int = 1 << 40) -> list[int]:
    """Least size of each band."""
    starts, at = [1], 1.0
    while starts[-1] < limit:
        at *= BAND
        if int(at) > starts[-1]:
            starts.append(int(at))
    return starts


def band_plan(share: tuple[int, int]) -> list[tuple[int, int]]:
    """Of each band: most shingles in which two similar sets differ, and number of slices.

    With n shingles in m slices about m (1 - exp(-n/m)) slices are filled; m is raised until that exceeds D + 1 with
    some reserve. Sets that still fill too few are handled in `cells`, so m affects speed only.
    """
    num, den = share
    plan, starts = [], band_starts()
    for low, above in zip(starts, starts[1:], strict=False):
        most = 2 * (above - 1) * (den - num) // (den + num)
        slices = most + 1
        while most and slices < 3 * (most + 1) and slices * -np.expm1(-low / slices) < most + 1 + 2.5 * np.sqrt(most + 1) * np.exp(-low / slices):
            slices += 1 + slices // 64
        plan.append((most, slices))
    return plan


def set_ids(doc: np.ndarray, value: np.ndarray, rows: int, salt: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Size and 64-bit id of each row's set."""
    total = np.zeros(len(value) + 1, np.uint64)
    np.cumsum(mix(value + np.uint64(77 + salt)), out=total[1:])
    size = np.bincount(doc, minlength=rows)
    ends = np.cumsum(size)
    return size, mix(total[ends] - total[ends - size] + size.astype(np.uint64)).view(np.int64)


def cells(size: int, value: np.ndarray, band: int, slices: int, differing: int) -> tuple[np.ndarray, int]:
    """Names of the cells in which a set lies, in one band, and how many of them it may leave out.

    `differing` is the most shingles in which a similar set of the band differs from this one. That many cells of a set are not the similar
    one's, so of any more cells one is common. Where empty slices count, the other set may not have them, so none is left out.
    """
    place = ((value >> np.uint64(32)) * np.uint64(slices) >> np.uint64(32)).astype(np.int64)
    held = np.zeros(slices, np.uint64)
    np.add.at(held, place, mix(value ^ np.uint64(0x5BD1E995)))
    filled = np.bincount(place, minlength=slices) > 0
    surplus = np.count_nonzero(filled) - differing - 1
    name = mix(held + salted(101 + band, slices) * np.uint64(0xD6E8FEB86659FD93))
    return (name, 0) if surplus < 0 else (name[filled], surplus)


def _sets(batches, words: int, share: tuple[int, int], salt: int):
    """(doc_id, n, node, check, bands); a task names the cells of a set once, however many copies it reads."""
    num, den = share
    starts, plan, seen = band_starts(), band_plan(share), set()
    for rows, data, offsets in blocks(batches):
        doc, value = shingles(data, offsets, words)
        size, node = set_ids(doc, value, len(offsets) - 1, salt)
        check = set_ids(doc, value, len(offsets) - 1, salt + (1 << 32))[1]
        ends, known = np.cumsum(size), rows.column(0).is_valid().to_numpy(False)
        found: list[tuple[int, int, np.ndarray]] = []
        counts = np.zeros(len(size), np.int64)
        for row in np.flatnonzero(known & (size > 0)):
            if (key := int(node[row])) in seen:
                continue
            seen.add(key)
            n, own = int(size[row]), value[ends[row] - size[row] : ends[row]]
            band = bisect_right(starts, n) - 1
            while True:
                largest = min(n * den // num, starts[band + 1] - 1)
                names, spare = cells(n, own, band, plan[band][1], (n + largest) * (den - num) // (den + num))
                found.append((band, spare, names.view(np.int64)))
                counts[row] += 1
                if starts[band + 1] * num > n * den:
                    break
                band += 1
        names = lists(np.array([len(x[2]) for x in found], np.int64), np.concatenate([np.zeros(0, np.int64), *(x[2] for x in found)]))
        numbers = [pa.array([x[k] for x in found], pa.int32()) for k in (0, 1)]
        held = lists(counts, pa.StructArray.from_arrays([*numbers, names], ["band", "spare", "cells"]))
        columns = [rows.column(0), pa.array(size.astype(np.int64)), pa.array(node), pa.array(check), held]
        yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n", "node", "check", "bands"])


_SETS = "doc_id long, n long, node long, check long, bands array<struct<band: int, spare: int, cells: array<long>>>"


def _points(batches, words: int, salt: int, per_group: int, least_groups: int):
    """(node, n, shingles, point, fine): the sets themselves and their group counts, few and many."""
    seen = set()
    for _, data, offsets in blocks(batches):
        doc, value = shingles(data, offsets, words)
        size, node = set_ids(doc, value, len(offsets) - 1, salt)
        ends = np.cumsum(size)
        fresh = [r for r in np.flatnonzero(size) if not (int(node[r]) in seen or seen.add(int(node[r])))]
        if not fresh:
            continue
        own = [value[ends[r] - size[r] : ends[r]] for r in fresh]
        columns = [pa.array(node[fresh]), pa.array(size[fresh].astype(np.int64)), lists(size[fresh], np.concatenate(own).view(np.int64))]
        columns += [pa.array([group_counts(x, per, least) for x in own], pa.binary()) for per, least in ((per_group, (least_groups - 1).bit_length()), (4, 4))]
        yield pa.RecordBatch.from_arrays(columns, ["node", "n", "shingles", "point", "fine"])


def group_counts(value: np.ndarray, per_group: int = 4, least_bits: int = 4) -> bytes | None:
    """Counts of a set in a power of two of groups, one byte each; None where one does not fit."""
    bits = max(least_bits, (len(value) // per_group).bit_length())
    counts = np.bincount((value >> np.uint64(64 - bits)).astype(np.int64), minlength=1 << bits)
    return counts.astype(np.uint8).tobytes() if counts.max() < 256 else None


def overlap_bounds(a: pa.Array, b: pa.Array) -> np.ndarray:
    """Sum of coordinate minima of each two points; both lists hold points of one length each."""

    def matrix(points: pa.Array) -> np.ndarray:
        return np.frombuffer(b"".join(points.to_pylist()), np.uint8).reshape(len(points), -1)

    x, y = matrix(a), matrix(b)
    width = min(x.shape[1], y.shape[1])
    x, y = (p if p.shape[1] == width else p.reshape(len(p), width, -1).sum(2, dtype=np.uint16) for p in (x, y))
    return np.minimum(x, y).sum(1, dtype=np.int64)


def _coordinates(points: list[bytes | None], sizes: np.ndarray) -> np.ndarray:
    """Points folded to 64 coordinates; a set without one may have all its shingles in any group."""
    out = np.repeat(sizes[:, None], GROUPS, 1)
    length = np.array([len(x) if x else 0 for x in points])
    for one in np.unique(length[length > 0]):
        rows = np.flatnonzero(length == one)
        blob = np.frombuffer(b"".join(points[i] for i in rows), np.uint8)
        out[rows] = blob.reshape(len(rows), GROUPS, -1).sum(2, dtype=np.int64)
    return out


def _reaches(a: pa.Array, b: pa.Array, sizes: np.ndarray, share: tuple[int, int]) -> np.ndarray:
    """Whether the bound on points reaches the needed overlap of sets with these sizes in sum; True where a set has no point."""
    num, den = share
    keep = np.ones(len(a), bool)
    lengths = [pc.fill_null(pc.binary_length(x), 0).to_numpy(False).astype(np.int64) for x in (a, b)]
    known = np.flatnonzero((lengths[0] > 0) & (lengths[1] > 0))
    kind = (lengths[0] << 32) + lengths[1]
    for one in np.unique(kind[known]):
        rows = known[kind[known] == one]
        step = max(1, BLOCK_BYTES // int(max(one >> 32, one & 0xFFFFFFFF)))
        for part in (rows[at : at + step] for at in range(0, len(rows), step)):
            bound = overlap_bounds(a.take(pa.array(part)), b.take(pa.array(part)))
            keep[part] = bound * (den + num) >= num * sizes[part]
    return keep


def _bounded(batches, share: tuple[int, int]):
    """Pairs (a, b, n_a, n_b, point_a, point_b) whose bound reaches the needed overlap."""
    for batch in batches:
        keep = _reaches(batch.column(4), batch.column(5), batch.column(2).to_numpy() + batch.column(3).to_numpy(), share)
        yield pa.RecordBatch.from_arrays([batch.column(k).filter(pa.array(keep)) for k in (0, 1)], ["a", "b"])


_LEAF = {
    "cell": pa.int64(), "inner": pa.int64(), "leaf": pa.int64(), "least_n": pa.int64(), "comp_low": pa.int64(), "comp_high": pa.int64(), "box": pa.list_(pa.int64()),
    "nodes": pa.list_(pa.int64()), "comps": pa.list_(pa.int64()), "sizes": pa.list_(pa.int64()), "points": pa.list_(pa.binary()), "firsts": pa.list_(pa.binary()),
}
_LEAF_FIELDS = (
    "cell long, inner long, leaf long, least_n long, comp_low long, comp_high long, box array<long>, "
    "nodes array<long>, comps array<long>, sizes array<long>, points array<binary>, firsts array<binary>"
)
_HELD = ("nodes", "comps", "sizes", "points", "firsts")


def _leaves(batches):
    """Packs consecutive rows of a cell (cell, comp, n, node, point, firsts), which come sorted, into leaves, and tells the inner box of each."""
    last_cell, number, inner = None, 0, 0

    def packed(rows: pa.Table):
        nonlocal last_cell, number, inner
        cell = rows["cell"].to_numpy()
        cuts = np.flatnonzero(cell[1:] != cell[:-1]) + 1
        for low, high in zip([0, *cuts], [*cuts, len(cell)], strict=True):
            for at in range(low, high, LEAF):
                part = rows.slice(at, min(LEAF, high - at))
                nodes, comps, sizes = (part[c].to_numpy() for c in ("node", "comp", "n"))
                number = 0 if cell[at] != last_cell else number + 1
                last_cell = cell[at]
                inner = int(nodes[0]) if number % FANOUT == 0 else inner
                points = part["point"].to_pylist()
                yield {
                    "cell": int(cell[at]), "inner": inner, "leaf": int(nodes[0]), "least_n": int(sizes.min()),
                    "comp_low": int(comps.min()), "comp_high": int(comps.max()), "box": _coordinates(points, sizes).max(0).tolist(),
                    "nodes": nodes.tolist(), "comps": comps.tolist(), "sizes": sizes.tolist(), "points": points,
                    "firsts": [np.array(x, np.int64).tobytes() for x in part["firsts"].to_pylist()],
                }

    schema = pa.schema(list(_LEAF.items()))
    held: list[pa.RecordBatch] = []
    for batch in batches:
        table = pa.Table.from_batches([*held, batch])
        cell = table["cell"].to_numpy()
        if not len(cell):
            continue
        last = int(np.flatnonzero(cell != cell[-1])[-1]) + 1 if (cell != cell[-1]).any() else 0
        last += (len(cell) - last) // LEAF * LEAF  # whole leaves of the last cell can go
        if found := list(packed(table.slice(0, last))):
            yield from pa.Table.from_pylist(found, schema).to_batches()
        held = table.slice(last).combine_chunks().to_batches()
    if held and (found := list(packed(pa.Table.from_batches(held)))):
        yield from pa.Table.from_pylist(found, schema).to_batches()


def _own_pairs(batches, share: tuple[int, int]):
    """Pairs of points of one leaf, as of `_leaf_pairs`."""
    for batch in batches:
        names = ["cell", *[f"{c}{side}" for c in _HELD for side in ("", "_b")]]
        both = pa.RecordBatch.from_arrays([batch.column("cell"), *[batch.column(c) for c in _HELD for _ in (0, 1)]], names)
        yield from _leaf_pairs(iter([both]), share, own=True)


def _met_before(a: list[bytes], b: list[bytes], i: np.ndarray, j: np.ndarray, cell: int) -> np.ndarray:
    """Whether the points i[k] and j[k] have a cell before `cell` in common, as far as the least of their cells tell."""

    def matrix(firsts: list[bytes]) -> np.ndarray:
        out = np.full((len(firsts), FIRSTS), cell, np.int64)
        for row, first in zip(out, firsts, strict=True):
            row[: len(first) // 8] = np.frombuffer(first, np.int64)
        return out

    x, y = matrix(a)[i], matrix(b)[j]
    return ((x[:, :, None] == y[:, None, :]) & (x < cell)[:, :, None]).any((1, 2))


def _leaf_pairs(batches, share: tuple[int, int], own: bool = False):
    """Pairs of points of two leaves that lie in different groups and whose bound reaches the needed overlap, first on 64 coordinates."""
    num, den = share
    for batch in batches:
        for row in batch.to_pylist():
            a, b = (_coordinates(row[f"points{side}"], np.array(row[f"sizes{side}"])) for side in ("", "_b"))
            sizes = np.array(row["sizes"])[:, None] + np.array(row["sizes_b"])[None, :]
            apart = np.array(row["comps"])[:, None] != np.array(row["comps_b"])[None, :]
            if own:  # each pair once
                apart &= np.tri(len(a), k=-1, dtype=bool)
            bound = np.empty(sizes.shape, np.int64)
            for i in range(len(a)):
                bound[i] = np.minimum(a[i], b).sum(1, dtype=np.int64)
            i, j = np.nonzero(apart & (bound * (den + num) >= num * sizes))
            if not len(i):
                continue
            fresh = ~_met_before(row["firsts"], row["firsts_b"], i, j, row["cell"])
            i, j = i[fresh], j[fresh]
            points = [pa.array(row[c], pa.binary()).take(pa.array(k)) for c, k in (("points", i), ("points_b", j))]
            keep = _reaches(*points, sizes[i, j], share)
            x, y = np.array(row["nodes"], np.int64)[i[keep]], np.array(row["nodes_b"], np.int64)[j[keep]]
            yield pa.RecordBatch.from_arrays([pa.array(np.minimum(x, y)), pa.array(np.maximum(x, y))], ["a", "b"])


def _may_reach(share: tuple[int, int]) -> Column:
    """Condition on two boxes: their bound reaches the overlap needed by the least sizes in them, and they don't lie in one group."""
    num, den = share
    bound = F.aggregate(F.zip_with("box", "box_b", lambda x, y: F.least(x, y)), F.lit(0).cast("long"), lambda total, x: total + x)
    alike = (F.col("comp_low") == F.col("comp_high")) & (F.col("comp_low_b") == F.col("comp_high_b")) & (F.col("comp_low") == F.col("comp_low_b"))
    return ~alike & (bound * (den + num) >= num * (F.col("least_n") + F.col("least_n_b")))


def _descended(stages: Stages, leaves: DataFrame, share: tuple[int, int]) -> DataFrame:
    """Candidate pairs (a, b) of the tree over `leaves`: pairs of inner boxes of a cell, of the leaves below, of their points."""
    box = ["least_n", "comp_low", "comp_high", "box"]

    def second(df: DataFrame) -> DataFrame:
        return df.select(*[F.col(c).alias(f"{c}_b") for c in df.columns])

    # Most cells are one leaf, which is compared with itself where it is stored; only leaves that meet others are moved.
    alone = leaves.where("comp_low < comp_high").select("cell", *_HELD).mapInArrow(partial(_own_pairs, share=share), "a long, b long")
    several = leaves.groupBy("cell").agg(F.count("leaf").alias("leaves")).where("leaves > 1").select("cell")
    several = stages.keep("spread", several)
    leaves = leaves.join(several, "cell")
    inner = leaves.groupBy("cell", "inner").agg(
        F.min("least_n").alias("least_n"), F.min("comp_low").alias("comp_low"), F.max("comp_high").alias("comp_high"),
        F.array(*[F.max(F.col("box")[k]) for k in range(GROUPS)]).alias("box"),
    )
    inner = stages.keep("inner", inner)
    met = inner.join(second(inner), (F.col("cell") == F.col("cell_b")) & (F.col("inner") <= F.col("inner_b")))
    met = met.where(_may_reach(share)).select("cell", "inner", "inner_b")
    heads = leaves.select("cell", "inner", "leaf", *box)
    met = met.join(heads, ["cell", "inner"]).join(second(heads).withColumnRenamed("cell_b", "cell"), ["cell", "inner_b"])
    # Leaves are numbered by a node, so in different inner boxes of a cell they differ.
    met = met.where((F.col("inner") < F.col("inner_b")) | (F.col("leaf") < F.col("leaf_b"))).where(_may_reach(share)).select("cell", "leaf", "leaf_b")
    met = stages.keep("met", met)
    points = leaves.select("cell", "leaf", *_HELD)
    met = met.join(points, ["cell", "leaf"]).join(second(points).withColumnRenamed("cell_b", "cell"), ["cell", "leaf_b"])
    met = met.select("cell", *[f"{c}{side}" for c in _HELD for side in ("", "_b")])
    return met.mapInArrow(partial(_leaf_pairs, share=share), "a long, b long").union(alone).where("a < b").distinct()


def ngram_jaccard_join(docs: DataFrame, words: int = 5, share: tuple[int, int] = (8, 10), per_group: int = 4, least_groups: int = 256) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id.

    Two documents link when den * |A n B| >= num * |A u B| for share = (num, den); component_id is the least doc_id
    that links reach. Words end at ASCII white space; A-Z is lower-cased. Reads only doc_id and text, so other
    columns may have any name. Documents without words (also null texts) have no shingles and stand alone. Rows
    that repeat a doc_id are each compared. A row without doc_id gets a row with component_id null and links nothing.
    `per_group` and `least_groups` (64 or more) have no effect on the result: finer points prune more pairs and take more room.
    An empty table gives an empty result. A text is held whole by one task, with about 40 bytes of memory for each of its bytes.
    """
    num, den = share
    assert 0 < num <= den and least_groups >= GROUPS
    stages = Stages(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    for salt in count():
        sets = docs.mapInArrow(partial(_sets, words=words, share=share, salt=salt), _SETS)
        sets = stages.keep(f"sets-{salt}", sets)
        named_alike = sets.where("n > 0").groupBy("node").agg(F.min("check").alias("one"), F.max("check").alias("other")).where("one < other")
        if not named_alike.head(1):
            break

    # Sets that share a cell with another set. Hot cells are folded map-side and joined back, and the join can be split there.
    named, wide = sets.select("node", "n", F.inline("bands")).select(F.explode("cells").alias("cell"), "node", "n", "band", "spare"), f"sets-{salt}"
    sets = stages.keep("sets", sets.select("doc_id", "n", "node"))
    heads = named.groupBy("cell").agg(F.min("node").alias("head"), F.max("node").alias("tail"), F.count("node").alias("heat")).where("head < tail")
    shared = named.join(stages.keep("heads", heads.select("cell", "heat")), "cell").distinct()
    # Of the cells of a set in a band, the hottest are left out, as many as its similar sets allow. Cells of its own alone are the last to go.
    hottest = F.row_number().over(Window.partitionBy("node", "band").orderBy(F.desc("heat"), "cell"))
    shared = stages.keep("shared", shared.withColumn("place", hottest).where("place > spare").select("cell", "node", "n"))
    stages.drop("heads", wide)
    # Which sets a cell holds, as a number of them and two digests; each set counts once.
    digests = [F.bit_xor(F.xxhash64(F.lit(seed), "node")).alias(name) for seed, name in ((1, "x"), (2, "y"))]
    held = stages.keep("held", shared.groupBy("cell").agg(F.count("node").alias("sets"), F.min("node").alias("head"), F.max("node").alias("tail"), *digests))
    two = held.where("sets = 2").select(F.col("head").alias("a"), F.col("tail").alias("b")).distinct()
    large = held.where("sets > 2").groupBy("sets", "head", "tail", "x", "y").agg(F.min("cell").alias("cell"))
    shared = stages.keep("several", shared.join(large.select("cell", "head"), "cell"))

    two = stages.keep("two", two)
    stages.drop("held", "shared")
    nodes = shared.select("node").union(two.select("a")).union(two.select("b")).distinct()
    texts = sets.where("doc_id IS NOT NULL").join(nodes, "node", "left_semi").groupBy("node").agg(F.min("doc_id").alias("doc_id"))
    texts = stages.keep("texts", texts.select("doc_id").distinct())
    points = docs.join(checked(texts), "doc_id", "left_semi").mapInArrow(
        partial(_points, words=words, salt=salt, per_group=per_group, least_groups=least_groups), "node long, n long, shingles array<long>, point binary, fine binary"
    )
    points = points.groupBy("node").agg(*[F.any_value(c).alias(c) for c in ("n", "shingles", "point", "fine")])
    points = stages.keep("points", points)

    def of(side: str, *names: str) -> DataFrame:
        return points.select(F.col("node").alias(side), *[F.col(c).alias(f"{c}_{side}") for c in names])

    def verified(pairs: DataFrame) -> DataFrame:
        both = pairs.join(of("b", "n", "shingles"), "b").join(of("a", "n", "shingles"), "a")
        both = both.select("a", "b", F.size(F.array_intersect("shingles_a", "shingles_b")).cast("long").alias("common"), "n_a", "n_b")
        return both.where(f"{den} * common >= {num} * (n_a + n_b - common)").select("a", "b")

    def bounded(pairs: DataFrame, *kinds: str) -> DataFrame:
        for kind in kinds:
            both = pairs.join(of("b", "n", kind), "b").join(of("a", "n", kind), "a")
            both = both.select("a", "b", "n_a", "n_b", f"{kind}_a", f"{kind}_b")
            pairs = both.mapInArrow(partial(_bounded, share=share), "a long, b long")
        return pairs

    # Two sets of very different sizes are not similar, so a head is of use only to sets of about its size.
    fits = f"{den} * least(n, n_head) >= {num} * greatest(n, n_head)"
    heads = stages.keep("sized", shared.where("node > head").join(of("head", "n"), "head").where(fits).select("head", "node"))
    # Each set with the least head of all its cells: one pair of each, which connects most of a group of copies.
    nearest = heads.groupBy(F.col("node").alias("b")).agg(F.min("head").alias("a")).select("a", "b")
    links = stages.keep("links", verified(bounded(nearest.union(two).distinct(), "fine")))
    groups = components(stages, links, "groups")

    # Each set with the other heads of its cells, as far as they are not connected yet.
    def comp_of(side: str) -> DataFrame:
        return groups.select(F.col("node").alias(side), F.col("comp").alias(f"comp_{side}"))

    starred = heads.select(F.col("head").alias("a"), F.col("node").alias("b")).distinct()
    starred = starred.join(nearest, ["a", "b"], "left_anti").join(comp_of("a"), "a", "left").join(comp_of("b"), "b", "left")
    starred = starred.where("NOT coalesce(comp_a = comp_b, false)").select("a", "b")
    links = links.union(stages.keep("others", verified(bounded(starred, "point", "fine"))))
    stages.drop("sized", "two")
    groups = components(stages, links, "starred")

    # Cells that still hold several groups, by the tree.
    rest = shared.join(groups, "node", "left").select("cell", "node", F.coalesce("comp", "node").alias("comp"))
    apart = rest.groupBy("cell").agg(F.min("comp").alias("x"), F.max("comp").alias("y")).where("x < y").select("cell")
    firsts = F.slice(F.sort_array(F.collect_list("cell").over(Window.partitionBy("node"))), 1, FIRSTS)
    rest = rest.join(apart, "cell").withColumn("firsts", firsts).join(points.select("node", "n", "point"), "node")
    # Points sort by their bytes, so by one coordinate after the other.
    order = ["cell", "comp", "n", "point", "node"]
    rest = rest.repartitionByRange(*order).sortWithinPartitions(*order)
    leaves = stages.keep("leaves", rest.select("cell", "node", "comp", "n", "point", "firsts").mapInArrow(_leaves, _LEAF_FIELDS))
    stages.drop("several")
    candidates = stages.keep("candidates", _descended(stages, leaves, share))
    stages.drop("leaves", "spread", "inner", "met")
    links = links.union(stages.keep("more", verified(bounded(candidates, "fine"))))
    groups = components(stages, links, "all")
    stages.drop("points", "candidates", "links", "others", "more", "texts")

    rooted = sets.join(groups, "node", "left").select("doc_id", "n", F.coalesce("comp", "node").alias("root"))
    least = rooted.where("n > 0").groupBy("root").agg(F.min("doc_id").alias("component"))
    # Written, so that the join deals both sides itself and a hot group can be split.
    rooted = rooted.join(stages.keep("least", least), "root", "left")
    group = F.when(F.col("n") > 0, F.col("component")).otherwise(F.col("doc_id"))
    return rooted.select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("doc_id").isNotNull(), group).alias("component_id"))


def keep_one_of_each(docs: DataFrame, words: int = 5, share: tuple[int, int] = (8, 10), **points: int) -> DataFrame:
    """Rows of `docs` whose doc_id is the least of its component, with all their columns.

    Rows without doc_id stay; of several rows with one doc_id all stay when the doc_id does.
    """

    def kept(docs: DataFrame) -> DataFrame:
        joined = ngram_jaccard_join(docs, words, share, **points)
        gone = joined.where("component_id < doc_id").select(F.col("doc_id").alias("gone_id")).distinct()
        gone = Stages(docs.sparkSession).keep("gone", gone)
        return docs.join(checked(gone), F.col("doc_id").cast("long") == F.col("gone_id"), "left_anti")

    return with_neutral_names(docs, ("doc_id", "text"), kept)


JOIN_SQL = r"""
    WITH RECURSIVE docs AS (
        SELECT row_number() OVER () AS r, doc_id,
               list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                 '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
        FROM documents
    ), sets AS (
        SELECT r, doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
                               ELSE list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) END AS own
        FROM docs
    ), held AS (
        SELECT r, len(own) AS n, unnest(own) AS shingle FROM sets
    ), links AS (
        SELECT a.r AS a, b.r AS b FROM held a JOIN held b ON a.shingle = b.shingle AND a.r < b.r
        GROUP BY a.r, b.r, a.n, b.n HAVING 100 * count(*) >= 90 * (a.n + b.n - count(*))
    ), steps AS (
        SELECT a, b FROM links UNION ALL SELECT b, a FROM links
    ), reached(a, b) AS (
        SELECT r, r FROM docs UNION SELECT reached.a, steps.b FROM reached JOIN steps ON reached.b = steps.a
    )
    SELECT s.doc_id, len(s.own) AS n_shingles, c.component_id
    FROM sets s JOIN (SELECT a, min(doc_id) AS component_id FROM reached JOIN sets ON sets.r = reached.b GROUP BY a) c ON c.a = s.r
"""
