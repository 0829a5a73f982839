"""Ranked lexical search by hashed max-sketches, exact.

The score of a document for an item sums, over the item's terms, a weight w (rarity) times an impact, which grows with the
term's occurrences tf and falls with the document's length:

    w = floor(1000 ln((2N + 2) / (2 df + 1)))     impact = 10^9 tf div (1000 tf + 8 m)     m = 10 + 90 n N div L

1. Sketches. A document's terms are hashed to coordinates, and each coordinate holds the largest impact of its terms. As an impact
   grows with tf, and nothing else in it differs within a document, the largest tf is stored: the sketch needs neither N nor
   L and serves all queries. Its width is a power of two, `LOAD` times the distinct terms or more, so long documents are no denser; only
   coordinates that are not zero are stored. Denser sketches bound too loosely: with 4 in place of 1024 most pairs had to be scored.
2. Bounds. A batch of items is looked up in all sketches at once: impacts of the coordinates times weights of the items' terms there,
   summed by document for a block of sketches. A term's own coordinate holds at least its impact, so no score exceeds its bound.
3. Rescoring by descending bound: the `first` documents of highest bound of each item are scored from their texts. The k-th best score
   is the threshold, and then every document whose bound reaches it is scored; no other can be among the k best. That round is
   never cut.

Sketches are staged once. Items come in batches of bounded size (`BATCH` pairs of item and term), each with one pass to count df,
one or more over the sketches, and joins of candidates with the texts. Only the terms of one batch are sent to tasks.
"""

import math
from collections import Counter
from functools import partial
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from claimloom.llm.common import Stages, lists
from claimloom.llm.quality_rules import pieces

#: Coordinates for each distinct term, at least.
LOAD = 1024
#: Pairs of item and term in a batch, about; a batch has at most so many distinct terms.
BATCH = 8192
#: Documents scored in the first round for each item.
FIRST = 16
#: Candidate documents that are broadcast; more are joined by a shuffle.
MOST_SENT = 20_000
#: Numbers in a block of bounds.
BLOCK = 1 << 20

# A-Z in lower case; what is not in a term becomes a space.
_TERM = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))


def counted(text: bytes) -> Counter:
    """Occurrences of each term. A long text is read in pieces."""
    found: Counter = Counter()
    for part in pieces(text.translate(_TERM)):
        found.update(part.split())
    return found


def _texts(batch: pa.RecordBatch, at: int):
    return ((x.as_py() or "").encode() for x in batch.column(at))


def sketch(tf: dict[bytes, int]) -> tuple[int, bytes, bytes]:
    """Width, the coordinates that are not zero, and the largest tf at each: one byte each, or four where one does not fit."""
    width = 1 << (LOAD * len(tf) - 1).bit_length()
    at, place = np.unique(coordinates(tf, width), return_inverse=True)
    held = np.zeros(len(at), np.int64)
    np.maximum.at(held, place, np.fromiter(tf.values(), np.int64, len(tf)))
    return width, at.astype("<u4").tobytes(), held.astype(np.uint8 if held.max() < 256 else "<u4").tobytes()


def coordinates(terms, width: int) -> np.ndarray:
    """Hashed coordinates; a width beyond the 2 ** 32 values of the hash is no wider."""
    return np.fromiter(map(crc32, terms), np.int64, len(terms)) & (width - 1)


def _sketches(batches):
    for batch in batches:
        for at in range(0, batch.num_rows, 1000):
            part = batch.slice(at, 1000)
            tfs = [counted(t) for t in _texts(part, 1)]
            with_terms = np.flatnonzero([bool(tf) for tf in tfs])
            made = [sketch(tfs[i]) for i in with_terms]
            columns = [part.column(0).take(pa.array(with_terms)), pa.array([tfs[i].total() for i in with_terms], pa.int64())]
            columns += [pa.array([x[k] for x in made], kind) for k, kind in enumerate((pa.int64(), pa.binary(), pa.binary()))]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n", "width", "coordinates", "largest"])


def sketches(docs: DataFrame) -> DataFrame:
    """(doc_id, n, width, coordinates, largest) of each row of (doc_id, text) with a term; n is the number of terms with their repeats."""
    return docs.mapInArrow(_sketches, "doc_id long, n long, width long, coordinates binary, largest binary")


def _item_terms(batches):
    for batch in batches:
        for at in range(0, batch.num_rows, 1000):
            part = batch.slice(at, 1000)
            found = [list(counted(t)) for t in _texts(part, 1)]
            ids = part.column(0).take(pa.array(np.repeat(np.arange(len(found)), [len(x) for x in found])))
            yield pa.RecordBatch.from_arrays([ids, pa.array([t.decode() for x in found for t in x], pa.string())], ["item_id", "term"])


def _frequencies(batches, terms: list[bytes]):
    """(term number, documents that hold it) of one task."""
    wanted, held = set(terms), Counter()
    for batch in batches:
        for text in _texts(batch, 0):
            held.update(wanted.intersection(counted(text)))
    at = {t: i for i, t in enumerate(terms)}
    yield pa.RecordBatch.from_arrays([pa.array([at[t] for t in held], pa.int64()), pa.array(list(held.values()), pa.int64())], ["t", "df"])


class Batch:
    """Items of one batch: their terms and weights, and the statistics that scores need."""

    def __init__(self, items: list[list[int]], terms: list[bytes], df: dict[int, int], documents: int, total: int):
        self.documents, self.total = documents, total
        weight = [math.floor(1000 * math.log((2 * documents + 2) / (2 * df[t] + 1))) if df.get(t) else 0 for t in range(len(terms))]
        #: For each item its terms and weights; a term that no document holds adds nothing.
        self.items = [[(terms[t], weight[t]) for t in own if weight[t] > 0] for own in items]
        self.pairs = [(q, term, w) for q, own in enumerate(self.items) for term, w in own]

    def lengths(self, n: list[int]) -> np.ndarray:
        return np.array([10 + 90 * x * self.documents // self.total for x in n], np.int64)

    def score(self, item: int, tf: dict[bytes, int], m: int) -> int:
        return sum(w * (1_000_000_000 * tf[t] // (1000 * tf[t] + 8 * m)) for t, w in self.items[item] if t in tf)

    def weights(self, width: int) -> tuple[np.ndarray, np.ndarray]:
        """Coordinates that items look up in sketches of this width, and (coordinate, item) -> sum of weights."""
        at, place = np.unique(coordinates([t for _, t, _ in self.pairs], width), return_inverse=True)
        held = np.zeros((len(at), len(self.items)))
        np.add.at(held, (place, [q for q, _, _ in self.pairs]), [w for _, _, w in self.pairs])
        return at, held


def _numbers(column: pa.Array, kind: str) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), kind).astype(np.int64)


def bounds(batch: pa.RecordBatch, items: Batch, made: dict):
    """Blocks of (row numbers, bounds of these rows for each item) of sketches; rows whose bounds are all 0 may be left out."""
    width = batch.column(2).to_numpy()
    held = pc.binary_length(batch.column(3)).to_numpy().astype(np.int64) // 4
    wide = pc.binary_length(batch.column(4)).to_numpy() // held
    m = items.lengths(batch.column(1).to_pylist())
    for kind in np.unique(width * 8 + wide):
        w = int(kind) >> 3
        if w not in made:
            if len(made) >= 4:
                made.clear()
            made[w] = items.weights(w)
        at, weight = made[w]
        if not len(at):
            continue
        rows = np.flatnonzero(width * 8 + wide == kind)
        own = batch.take(pa.array(rows))
        place = _numbers(own.column(3), "<u4")
        found = np.minimum(np.searchsorted(at, place), len(at) - 1)
        met = np.flatnonzero(at[found] == place)  # coordinates that an item looks up
        row = np.repeat(np.arange(len(rows)), held[rows])[met]
        tf = _numbers(own.column(4), "u1" if kind & 7 == 1 else "<u4")[met]
        impact = (1_000_000_000 * tf // (1000 * tf + 8 * m[rows][row])).astype(np.float64)
        starts = np.flatnonzero(np.diff(row, prepend=-1))
        step = max(1, BLOCK // weight.shape[1])
        low = 0
        while low < len(starts):  # whole rows, about `step` coordinates at once
            high = max(low + 1, int(np.searchsorted(starts, starts[low] + step)))
            ends = starts[high] if high < len(starts) else len(row)
            part = slice(starts[low], ends)
            values = impact[part, None] * weight[found[met[part]]]  # whole numbers far below 2 ** 53: exact
            yield rows[row[starts[low:high]]], np.add.reduceat(values, starts[low:high] - starts[low], axis=0)
            low = high


def _highest(batches, items: Batch, first: int):
    """(item, doc_id, bound): the `first` documents of highest bound of each item in one task."""
    best, ids, made = np.zeros((0, len(items.items))), np.zeros((0, len(items.items)), object), {}
    for batch in batches:
        doc = np.array(batch.column(0).to_pylist(), object)
        for rows, bound in bounds(batch, items, made):
            best = np.concatenate([best, bound])
            ids = np.concatenate([ids, np.broadcast_to(doc[rows][:, None], bound.shape)])
            if len(best) > first:
                top = np.argpartition(-best, first - 1, axis=0)[:first]
                best, ids = np.take_along_axis(best, top, 0), np.take_along_axis(ids, top, 0)
    place, item = np.nonzero(best)
    columns = [pa.array(item, pa.int64()), pa.array(ids[place, item].tolist(), pa.int64()), pa.array(best[place, item].astype(np.int64))]
    yield pa.RecordBatch.from_arrays(columns, ["item", "doc_id", "bound"])


def _reaching(batches, items: Batch, thresholds: list[int]):
    """(doc_id, items): the items whose threshold the bound of a document reaches."""
    least, made = np.maximum(np.array(thresholds), 1)[None, :], {}
    for batch in batches:
        for rows, bound in bounds(batch, items, made):
            place, item = np.nonzero(bound >= least)
            found, counts = np.unique(place, return_counts=True)
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(rows[found])), lists(counts, item.astype(np.int64))], ["doc_id", "items"])


def _rescored(batches, items: Batch):
    """(item, doc_id, score) of (doc_id, text, items), from the texts."""
    for batch in batches:
        found: list[tuple[int, int | None, int]] = []
        for doc_id, text, wanted in zip(batch.column(0).to_pylist(), _texts(batch, 1), batch.column(2).to_pylist(), strict=True):
            tf = counted(text)
            m = int(items.lengths([tf.total()])[0])
            found += [(q, doc_id, items.score(q, tf, m)) for q in wanted]
        columns = [pa.array([x[k] for x in found], pa.int64()) for k in range(3)]
        yield pa.RecordBatch.from_arrays(columns, ["item", "doc_id", "score"])


def _best(scored: DataFrame, k: int) -> DataFrame:
    order = W.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_first("doc_id"))
    return scored.where("score > 0").withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def lexical_search(docs: DataFrame, items: DataFrame, k: int = 10, first: int = FIRST) -> DataFrame:
    """(item_id, rank, doc_id, score): the `k` best documents with a score above 0 for each item, equal scores by ascending doc_id.

    Reads doc_id and text of `docs`, item_id and text of `items`; other columns may have any name. Terms are runs of letters, digits and
    characters beyond ASCII; only A-Z is lower-cased. A null text has no terms. Rows that repeat an item_id, or have none, are one
    item with the terms of all. Rows that repeat a doc_id are documents of their own, those without one come first among equals. An
    item without terms, or whose terms no document holds, has no rows; so has everything when a table is empty.
    """
    stages = Stages(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    items = items.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
    index = stages.keep("index", sketches(docs))
    documents, total = index.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    pairs = stages.keep("pairs", items.mapInArrow(_item_terms, "item_id long, term string").distinct())
    parts = math.ceil(pairs.count() / BATCH)
    found = []
    for part in range(parts if documents else 0):
        own = pairs.where(F.pmod(F.xxhash64("item_id"), F.lit(parts)) == part)
        if ranked := _search(stages, f"part-{part}", docs, index, own, documents, total, k, first):
            found.append(ranked)
    if not found:
        return docs.sparkSession.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    result = found[0]
    for more in found[1:]:
        result = result.unionByName(more)
    return result


def _search(stages: Stages, name: str, docs: DataFrame, index: DataFrame, pairs: DataFrame, documents: int, total: int, k: int, first: int) -> DataFrame | None:
    rows = pairs.orderBy(F.asc_nulls_first("item_id"), "term").collect()  # one batch
    if not rows:
        return None
    ids = list(dict.fromkeys(r.item_id for r in rows))
    terms = sorted({r.term.encode() for r in rows})
    number, place = {t: i for i, t in enumerate(terms)}, {x: i for i, x in enumerate(ids)}
    own: list[list[int]] = [[] for _ in ids]
    for r in rows:
        own[place[r.item_id]].append(number[r.term.encode()])
    held = docs.select("text").mapInArrow(partial(_frequencies, terms=terms), "t long, df long").groupBy("t").agg(F.sum("df").alias("df"))
    batch = Batch(own, terms, {r.t: r.df for r in held.collect()}, documents, total)

    def rescored(step: str, wanted: DataFrame) -> DataFrame:
        """Scores of (doc_id, items), from the texts of these documents alone."""
        wanted = stages.keep(f"{name}-{step}", wanted)
        sent = F.broadcast(wanted) if wanted.limit(MOST_SENT + 1).count() <= MOST_SENT else wanted
        texts = docs.join(sent.withColumnRenamed("doc_id", "wanted"), F.col("doc_id").eqNullSafe(F.col("wanted"))).select("doc_id", "text", "items")
        scored = texts.mapInArrow(partial(_rescored, items=batch), "item long, doc_id long, score long")
        return stages.keep(f"{name}-{step}-best", _best(scored, k))

    top = index.mapInArrow(partial(_highest, items=batch, first=first), "item long, doc_id long, bound long")
    top = top.withColumn("at", F.row_number().over(W.partitionBy("item").orderBy(F.desc("bound"), "doc_id"))).where(F.col("at") <= first)
    best = rescored("first", top.groupBy("doc_id").agg(F.collect_set("item").alias("items")))
    reached = {r.item: r.score for r in best.where(F.col("rank") == k).collect()}  # one row for each item of the batch
    thresholds = [reached.get(q, 0) for q in range(len(ids))]
    rest = index.mapInArrow(partial(_reaching, items=batch, thresholds=thresholds), "doc_id long, items array<long>")
    rest = rest.select("doc_id", F.explode("items").alias("item")).groupBy("doc_id").agg(F.collect_set("item").alias("items"))
    best = rescored("rest", rest)
    names = docs.sparkSession.createDataFrame(list(enumerate(ids)), "item long, item_id long")
    return best.join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score")


SEARCH_SQL = r"""
    WITH docs AS (
        SELECT row_number() OVER () AS r, doc_id, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS body FROM documents
    ), held AS (
        SELECT r, doc_id, term, count(*) AS tf
        FROM (SELECT r, doc_id, unnest(regexp_extract_all(body, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM docs) GROUP BY r, doc_id, term
    ), lengths AS (
        SELECT r, sum(tf)::BIGINT AS n FROM held GROUP BY r
    ), totals AS (
        SELECT count(*) AS docs, sum(n)::BIGINT AS total FROM lengths
    ), weights AS (
        SELECT term, floor(1000 * ln((2 * docs + 2) / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w FROM held, totals GROUP BY term, docs
    ), wanted AS (
        SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
               '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
        FROM benchmark
    ), scored AS (
        SELECT item_id, r, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * docs) // total))))::BIGINT AS score
        FROM wanted JOIN held USING (term) JOIN weights USING (term) JOIN lengths USING (r), totals GROUP BY item_id, r, doc_id
    )
    SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank, doc_id, score FROM scored WHERE score > 0
    QUALIFY rank <= 10
"""
