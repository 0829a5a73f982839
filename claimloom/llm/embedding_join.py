"""Embedding near-dedup by cross-polytope hashing after fast Hadamard rotations.

A rotation flips signs at random and applies the Walsh-Hadamard transform, three times over; the cross-polytope hash of the result is the axis with
the largest absolute value, and its sign. Some such hashes make the bucket of a table. A vector lies in its own bucket of every table
and also looks into those it just missed (multiprobe: one hash replaced by its second axis). Vectors that meet in a bucket are
compared by cosine in double precision, block by block inside the bucket; what leaves a task is one row per vector, not per pair.

Equal vectors are folded to one first and count by their number. A pair that meets several times is counted at its first meeting only. Buckets
are never cut: a large one is dealt to many tasks as pairs of its blocks.

More hashes make smaller buckets, more tables find more pairs. `plan` takes as many hashes as keep an even bucket at `AIM` vectors, so
the work of a vector does not grow with their number, and as many tables as find the share `RECALL` of pairs at the threshold, measured on
random pairs with exactly that cosine. Nearer pairs are found more often.
"""

import math

from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimloom.llm.common import Stages, components, lists, salted

PROBES = 3
BLOCK = 256
#: Vectors in a bucket if all were spread evenly.
AIM = 16
RECALL = 0.995
#: Random pairs at the threshold on which tables are measured.
TRIALS = 400


def _rotated(x: np.ndarray, table: int, number: int) -> np.ndarray:
    width = x.shape[1]
    for k in range(3):
        signs = np.where((salted(1000 + 97 * table + 11 * number + k, width) >> np.uint64(33)) & np.uint64(1), 1.0, -1.0)
        x, step = x * signs, 1
        while step < width:
            pairs = x.reshape(len(x), -1, 2, step)
            x = np.stack([pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]], 2).reshape(len(x), width)
            step *= 2
    return x


def codes(unit: np.ndarray, tables: int, hashes: int, probes: int, first: int = 0) -> np.ndarray:
    """(vectors, tables, 1 + probes) bucket codes of the tables from `first` on; the first code is the vector's own."""
    width = 1 << max(0, (unit.shape[1] - 1).bit_length())
    padded = np.zeros((len(unit), width))
    padded[:, : unit.shape[1]] = unit
    out = np.zeros((len(unit), tables - first, 1 + probes), np.int64)
    rows = np.arange(len(unit))
    for t in range(first, tables):
        axes, losses = [], []
        for h in range(hashes):
            turned = _rotated(padded, t, h)
            size = np.abs(turned)
            take = min(1 + probes, width)
            order = np.argsort(-size, axis=1, kind="stable")[:, :take]
            axes.append(2 * order + (np.take_along_axis(turned, order, 1) < 0))
            best = np.take_along_axis(size, order, 1)
            losses.append((best[:, :1] - best) / np.maximum(best[:, :1], 1e-300))
        base = np.zeros(len(unit), np.int64)
        for a in axes:
            base = base * (2 * width) + a[:, 0]
        out[:, t - first, 0] = base
        # One hash replaced by a later axis, least loss first.
        options = [(h, k) for h in range(hashes) for k in range(1, axes[0].shape[1])]
        if probes and options:
            loss = np.stack([losses[h][:, k] for h, k in options], 1)
            chosen = np.argsort(loss, axis=1, kind="stable")[:, :probes]
            for p in range(chosen.shape[1]):
                h, k = (np.array([o[i] for o in options])[chosen[:, p]] for i in (0, 1))
                code = np.zeros(len(unit), np.int64)
                for j, a in enumerate(axes):
                    code = code * (2 * width) + np.where(h == j, a[rows, np.where(h == j, k, 0)], a[:, 0])
                out[:, t - first, 1 + p] = code
            for p in range(chosen.shape[1], probes):
                out[:, t - first, 1 + p] = base
        else:
            out[:, t - first, 1:] = base[:, None]
    return out


def met(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """(pairs, tables): whether the own bucket of one is among the buckets of the other, from codes of both."""
    return (a[:, :, :1] == b).any(2) | (b[:, :, :1] == a).any(2)


def plan(vectors: int, width: int, share: float, probes: int = PROBES, recall: float = RECALL) -> tuple[int, int]:
    """Hashes and tables for so many vectors of a width."""
    axes = 2 << max(0, (width - 1).bit_length())
    hashes = 2
    while vectors > AIM * axes**hashes and axes ** (hashes + 1) < 1 << 62:
        hashes += 1
    rng = np.random.default_rng(width)
    a, other = (x / np.linalg.norm(x, axis=1, keepdims=True) for x in rng.standard_normal((2, TRIALS, width)))
    if width == 1:
        return hashes, 1
    other -= (a * other).sum(1, keepdims=True) * a
    b = share * a + math.sqrt(max(0.0, 1 - share * share)) * other / np.linalg.norm(other, axis=1, keepdims=True)
    found, tables = np.zeros(TRIALS, bool), 0
    while found.mean() < recall and tables < 512:
        first = tables
        tables += 4
        found |= met(codes(a, tables, hashes, probes, first), codes(b, tables, hashes, probes, first)).any(1)
    return hashes, tables


def _matrix(column: pa.ChunkedArray | pa.Array, rows: int) -> np.ndarray:
    """Lists of one length as rows of a matrix."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).reshape(rows, -1)


def _unit(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    vectors = _matrix(column, len(column)).astype(np.float64)
    return vectors / np.sqrt((vectors * vectors).sum(1, keepdims=True))


def _codes(batches, tables: int, hashes: int, probes: int):
    for batch in batches:
        if batch.num_rows:
            found = codes(_unit(batch.column(1)), tables, hashes, probes).reshape(batch.num_rows, -1)
            yield pa.RecordBatch.from_arrays([batch.column(0), lists(np.full(len(found), found.shape[1]), found.ravel())], ["node", "codes"])


def _compare(batches, share: float):
    """Links inside blocks: rows (place, side, node, uses, embedding, codes) come sorted by place; sides 0 and 1 are the two blocks, 2 both."""
    held: list[pa.RecordBatch] = []

    def compared(rows: pa.Table):
        node, uses, side = (rows[c].to_numpy() for c in ("node", "uses", "side"))
        table, bucket = int(rows["tab"][0].as_py()), int(rows["bucket"][0].as_py())
        left, right = np.flatnonzero(side != 1), np.flatnonzero(side != 0)
        unit = _unit(rows["embedding"])
        code = _matrix(rows["codes"], len(node)).reshape(len(node), table + 1, -1)  # of the tables up to this one
        gram = unit[left] @ unit[right].T
        i, j = np.nonzero(gram >= share)
        i, j = left[i], right[j]
        keep = node[i] < node[j] if (side == 2).all() else node[i] != node[j]
        i, j = i[keep], j[keep]
        i, j = np.where(node[i] < node[j], i, j), np.where(node[i] < node[j], j, i)
        if not len(i):
            return None
        # Where the pair meets first: in the first table in which one's own bucket is among the other's, there in the smaller node's bucket if possible.
        count, sums = np.zeros(len(node), np.int64), []
        for at in range(0, len(i), 1 << 18):
            a, b = i[at : at + (1 << 18)], j[at : at + (1 << 18)]
            done, mine = np.zeros(len(a), bool), np.zeros(len(a), bool)
            for t in range(table + 1):
                of_a = (code[b, t] == code[a, t, :1]).any(1)
                of_b = (code[a, t] == code[b, t, :1]).any(1)
                first = np.where(of_a, code[a, t, 0], code[b, t, 0])
                mine |= ~done & (of_a | of_b) & (first == bucket) & (t == table)
                done |= of_a | of_b
            sums.append((a[mine], b[mine]))
        a, b = (np.concatenate(x) for x in zip(*sums, strict=True))
        if not len(a):
            return None
        np.add.at(count, a, uses[b])
        np.add.at(count, b, uses[a])
        label, before = node.copy(), None
        while before is None or (before != label).any():
            before = label.copy()
            np.minimum.at(label, a, before[b])
            np.minimum.at(label, b, before[a])
        some = np.flatnonzero(count)
        return node[some], count[some], label[some]

    def packed(table: pa.Table):
        place = table["place"].to_numpy()
        cuts = np.flatnonzero(place[1:] != place[:-1]) + 1
        found = [x for low, high in zip([0, *cuts], [*cuts, len(place)], strict=True) if high - low > 1 and (x := compared(table.slice(low, high - low)))]
        if found:
            columns = [np.concatenate(x) for x in zip(*found, strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in columns], ["node", "links", "label"])

    for batch in batches:
        table = pa.Table.from_batches([*held, batch])
        place = table["place"].to_numpy()
        if not len(place):
            continue
        last = int(np.searchsorted(place, place[-1], "left"))
        if last:
            yield from packed(table.slice(0, last))
        held = table.slice(last).to_batches()
    if held:
        yield from packed(pa.Table.from_batches(held))


def embedding_near_dedup(
    vectors: DataFrame, share: float = 0.9, tables: int | None = None, hashes: int | None = None, probes: int = PROBES, block: int = BLOCK
) -> DataFrame:
    """One row per vector: vec_id, n_links, component_id, kept.

    Vectors that are null, empty, zero, or hold null or non-finite components link with nothing; so do vectors of another width with one another,
    as each width is a case of its own. Rows that repeat a vec_id are vectors each; a null vec_id links like others, has a null component_id
    only when nothing with an id is in its component, and is not kept. Reads only vec_id and embedding. An empty table gives an empty result. Hashes and tables are those of `plan` unless given.
    """
    stages = Stages(vectors.sparkSession)
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    finite = "x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < double('inf')"
    good = F.expr(f"coalesce(embedding IS NOT NULL AND forall(embedding, {finite}) AND exists(embedding, x -> x <> 0), false)")
    # -0.0 and 0.0 are one value; a power of two keeps tiny and huge components from vanishing in the norm.
    scale = F.expr("array_max(transform(embedding, x -> abs(x)))")
    rows = rows.withColumn("embedding", F.when(good, F.transform("embedding", lambda x: x / F.pow(F.lit(2.0), F.floor(F.log2(scale))) + F.lit(0.0))))
    # Single precision, where it came in that, holds the same numbers but for components that vanish beside the largest.
    brief = "array<float>" if vectors.schema["embedding"].dataType.simpleString() == "array<float>" else "array<double>"
    rows = stages.keep("vectors", rows.withColumn("embedding", F.col("embedding").cast(brief)))
    classes = rows.where("embedding IS NOT NULL").groupBy("embedding").agg(F.count(F.lit(1)).alias("uses"))
    classes = stages.keep("classes", classes.withColumn("node", F.monotonically_increasing_id()))
    members = rows.join(classes, "embedding", "left").select("vec_id", "node", "uses")

    width = F.size("embedding")
    widths = {x["w"]: x["count"] for x in classes.groupBy(width.alias("w")).count().collect()}
    parts = []
    for w, number in sorted(widths.items()):
        planned = plan(number, w, share, probes)
        parts.append(_links(stages, classes.where(width == w), w, share, tables or planned[1], hashes or planned[0], probes, block))
    found = vectors.sparkSession.createDataFrame([], "node long, links long, label long")
    for part in parts:
        found = found.union(part)
    found = stages.keep("found", found)
    groups = components(stages, found.where("node <> label").select(F.col("label").alias("a"), F.col("node").alias("b")).distinct(), "groups")
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    members = members.join(links, "node", "left").join(groups, "node", "left").withColumn("root", F.coalesce("comp", "node"))
    least = stages.keep("least", members.where("root IS NOT NULL").groupBy("root").agg(F.min("vec_id").alias("least")))
    out = members.join(least, "root", "left")
    component = F.when(F.col("root").isNull(), F.col("vec_id")).otherwise(F.col("least"))
    count = F.when(F.col("node").isNull(), F.lit(0)).otherwise(F.coalesce("links", F.lit(0)) + F.col("uses") - 1)
    return out.select(
        "vec_id", count.cast("long").alias("n_links"), component.alias("component_id"), F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept")
    )


def _links(stages: Stages, classes: DataFrame, width: int, share: float, tables: int, hashes: int, probes: int, block: int) -> DataFrame:
    coded = classes.select("node", "embedding").mapInArrow(
        partial(_codes, tables=tables, hashes=hashes, probes=probes), "node long, codes array<long>"
    )
    coded = stages.keep(f"coded-{width}", coded.join(classes, "node"))
    spots = F.expr(f"transform(codes, (c, i) -> struct(int(i div {1 + probes}) AS tab, c AS bucket, i % {1 + probes} = 0 AS own))")
    spots = coded.select("node", F.explode(F.array_distinct(spots)).alias("spot")).select("node", "spot.*")
    spots = spots.groupBy("node", "tab", "bucket").agg(F.max("own").alias("own"))
    # A bucket matters when somebody lives there and somebody else is there too.
    counted = spots.groupBy("tab", "bucket").agg(F.count(F.lit(1)).alias("n"), F.max("own").alias("lived")).where("n > 1 AND lived")
    counted = stages.keep(f"counted-{width}", counted.select("tab", "bucket", F.expr(f"(n + {block - 1}) div {block}").cast("int").alias("parts")))
    dealt = spots.join(counted, ["tab", "bucket"]).withColumn("part", F.expr("int(pmod(xxhash64(node), parts))"))
    # A block meets itself and every other block of its bucket once.
    meets = F.expr("transform(sequence(0, parts - 1), o -> struct(least(o, part) AS lo, greatest(o, part) AS hi, CASE WHEN o = part THEN 2 WHEN o > part THEN 0 ELSE 1 END AS side))")
    dealt = dealt.select("node", "tab", "bucket", F.explode(meets).alias("m")).select("node", "tab", "bucket", "m.*")
    full = dealt.join(coded, "node").withColumn("place", F.xxhash64("tab", "bucket", "lo", "hi"))
    # A meeting is judged by the tables up to its own.
    full = full.withColumn("codes", F.slice("codes", F.lit(1), (F.col("tab") + 1) * (1 + probes)))
    columns = ["place", "side", "tab", "bucket", "node", "uses", "embedding", "codes"]
    full = full.repartition("place").sortWithinPartitions("place", "tab", "bucket", "lo", "hi").select(*columns)
    return full.mapInArrow(partial(_compare, share=share), "node long, links long, label long")


NEAR_SQL = """
    WITH RECURSIVE plain AS (
        SELECT row_number() OVER () AS r, vec_id, embedding::DOUBLE[] AS x FROM embeddings
    ), good AS (
        SELECT r, vec_id, list_transform(x, lambda v: v / sqrt(list_sum(list_transform(x, lambda u: u * u)))) AS unit
        FROM plain WHERE x IS NOT NULL AND len(list_filter(x, lambda v: v IS NULL OR NOT isfinite(v))) = 0 AND len(list_filter(x, lambda v: v <> 0)) > 0
    ), links AS (
        SELECT a.r AS a, b.r AS b FROM good a JOIN good b ON a.r <> b.r AND len(a.unit) = len(b.unit) AND list_dot_product(a.unit, b.unit) >= 0.9
    ), reached(a, b) AS (
        SELECT r, r FROM plain UNION SELECT reached.a, links.b FROM reached JOIN links ON reached.b = links.a
    ), least AS (
        SELECT a, min(vec_id) AS component_id FROM reached JOIN plain ON plain.r = reached.b GROUP BY a
    )
    SELECT vec_id, (SELECT count(*) FROM links WHERE links.a = r) AS n_links, component_id, vec_id = component_id AS kept
    FROM plain JOIN least ON least.a = r
"""
