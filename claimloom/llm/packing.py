"""Bounded-space online packing of tokenised documents into sequences.

Each task reads its documents once, keeps a fixed number of open windows, and places each piece in the window it fits best. When it fits in
none, the fullest window is filled up with the head of the piece (unless too little room is left) and emitted. At its end a task
pours its open windows together, which leaves one partial window; these are merged, whole, in a last step.
"""

import sys
import zlib
from functools import partial
from itertools import chain
from types import ModuleType

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimloom.llm.common import Stages, blocks, span_digests, span_heads

SEQUENCE = 1024
OPEN_WINDOWS = 32
#: A window with less room than this is padded rather than filled by a cut.
LEAST_PIECE = 16
#: Tasks whose leftovers are merged together.
MERGED_TASKS = 256
END_ID = 0


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


class WordTokenizer:
    """Ids of a byte-level BPE vocabulary, by a cache of pre-tokenised words.

    Words are found over the bytes of many texts at once and looked up by 64-bit digest, length and first eight bytes; only words not in the cache are given to the
    tokenizer. Texts in which the words can't be told by character class alone (contractions, white space or characters beyond
    the table, special tokens) are given to it whole.
    """

    SLOTS = 1 << 20
    POOL = 1 << 22

    def __init__(self, vocabulary: str):
        import unicodedata

        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(vocabulary)
        self.specials = [x.content.encode() for x in self.tokenizer.get_added_tokens_decoder().values()]
        kind = {"L": 1, "N": 2}
        table = np.full(0x10000, 3, np.uint8)
        for code in range(0x10000):
            char = chr(code)
            table[code] = 0 if char.isspace() or code == 0x85 else kind.get(unicodedata.category(char)[0], 3)
        table[0x1C:0x20] = 3  # separators that Python alone counts as space
        self.table = table
        self.odd = table == 0
        self.odd[:128] = False
        self.clear()

    def clear(self):
        self.keys = np.zeros(self.SLOTS, np.uint64)
        self.checks = np.zeros(self.SLOTS, np.uint64)
        self.place = np.zeros(self.SLOTS, np.int64)  # first << 16 | count
        self.pool = np.zeros(self.POOL, np.uint32)
        self.used = 0

    def _classes(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Class of each byte's character (0 space, 1 letter, 2 number, 3 other), and which texts need the whole tokenizer."""
        kind, whole = self.table[data], np.zeros(len(offsets) - 1, bool)

        def mark(at: np.ndarray):
            whole[np.searchsorted(offsets, at, "right") - 1] = True

        two, three = np.flatnonzero((data & 0xE0) == 0xC0), np.flatnonzero((data & 0xF0) == 0xE0)
        for lead, size in ((two, 2), (three, 3)):
            code = (data[lead] & (0x1F if size == 2 else 0x0F)).astype(np.int64)
            for k in range(1, size):
                code = code << 6 | (data[lead + k] & 0x3F)
            for k in range(size):
                kind[lead + k] = self.table[code]
            mark(lead[self.odd[code]])
        mark(np.flatnonzero(data >= 0xF0))
        quote = np.flatnonzero(data[:-1] == 39) if len(data) else np.zeros(0, np.int64)
        mark(quote[np.isin(data[quote + 1], np.frombuffer(b"stmdrlv", np.uint8))])
        raw = data.tobytes()
        for special in self.specials:
            at = raw.find(special)
            while at >= 0:
                mark(np.array([at]))
                at = raw.find(special, at + 1)
        return kind, whole

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in order, and the number of ids of each."""
        rows = len(offsets) - 1
        kind, whole = self._classes(data, offsets)
        if not len(data):
            return np.zeros(0, np.uint32), np.zeros(rows, np.int64)
        last_of_doc = np.zeros(len(data) + 1, bool)
        last_of_doc[offsets[1:]] = True
        begins = np.zeros(len(data) + 1, bool)
        begins[offsets] = True
        begins[1:-1] |= kind[1:] != kind[:-1]
        # Of white space before something else, the last character stands alone, or joins what follows if it is a space.
        last = np.flatnonzero((kind[:-1] == 0) & (kind[1:] != 0) & ~last_of_doc[1:-1])
        begins[last] = True
        begins[last[data[last] == 32] + 1] = False
        starts = np.flatnonzero(begins[:-1])
        ends = np.append(starts[1:], len(data))
        doc = np.searchsorted(offsets, starts, "right") - 1
        if whole.any():
            plain = ~whole[doc]
            starts, ends, doc = starts[plain], ends[plain], doc[plain]
        name, check = span_digests(data, starts, ends, 1), span_heads(data, starts, ends)
        slot = (name & np.uint64(self.SLOTS - 1)).astype(np.int64)
        place = self.place[slot]
        missed = np.flatnonzero((self.keys[slot] != name) | (self.checks[slot] != check) | (place == 0))
        first, count = place >> 16, place & 0xFFFF
        if len(missed):
            order = np.lexsort((check[missed], name[missed]))
            new = np.append(True, np.diff(name[missed[order]]).astype(bool) | np.diff(check[missed[order]]).astype(bool))
            at, back = missed[order[new]], np.empty(len(missed), np.int64)
            back[order] = np.cumsum(new) - 1
            raw = data.tobytes()
            words = [raw[a:b].decode() for a, b in zip(starts[at].tolist(), ends[at].tolist(), strict=True)]
            found = [x.ids for x in self.tokenizer.encode_batch_fast(words, add_special_tokens=False)]
            sizes = np.array([len(x) for x in found], np.int64)
            if self.used + sizes.sum() > len(self.pool):
                pool, used = self.pool, self.used
                self.clear()
                # Words of this block that were found in the old cache are still needed.
                hit = np.ones(len(name), bool)
                hit[missed] = False
                kept = _spread(first[hit], count[hit])
                if len(kept) + sizes.sum() > len(self.pool):
                    self.pool = np.zeros(2 * (len(kept) + int(sizes.sum())), np.uint32)
                self.pool[: len(kept)] = pool[kept]
                first[hit] = np.cumsum(count[hit]) - count[hit]
                self.used = len(kept)
                del pool, used
            begin = self.used + np.cumsum(sizes) - sizes
            self.pool[self.used : self.used + sizes.sum()] = np.fromiter(chain.from_iterable(found), np.uint32, int(sizes.sum()))
            self.used += int(sizes.sum())
            first[missed], count[missed] = begin[back], sizes[back]
            brief = np.flatnonzero(sizes < 1 << 16)  # longer words are encoded anew each time
            own = slot[at[brief]]
            self.keys[own], self.checks[own], self.place[own] = name[at[brief]], check[at[brief]], begin[brief] << 16 | sizes[brief]
        sizes = np.bincount(doc, count, rows).astype(np.int64)
        ids = self.pool[_spread(first, count)]
        if not whole.any():
            return ids, sizes
        parts = np.split(ids, np.cumsum(sizes)[:-1])
        for row in np.flatnonzero(whole):
            text = data[offsets[row] : offsets[row + 1]].tobytes().decode()
            parts[row] = np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, np.uint32)
        return np.concatenate(parts).astype(np.uint32), np.array([len(x) for x in parts], np.int64)


def tokenizer_of(vocabulary: str) -> WordTokenizer:
    """One tokenizer for all tasks of a worker process."""
    kept = sys.modules.setdefault("_word_tokenizers", ModuleType("_word_tokenizers")).__dict__
    if vocabulary not in kept:
        kept[vocabulary] = WordTokenizer(vocabulary)
    return kept[vocabulary]


def _spread(first: np.ndarray, count: np.ndarray) -> np.ndarray:
    """Indices first[i] .. first[i] + count[i] - 1 for each i, in order."""
    ends = np.cumsum(count)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(first - ends + count, count)


class Packer:
    """Open windows of one task. A piece is (doc number, start, ids); emitted are (window, partial, piece number, offset)."""

    def __init__(self, size: int, most_open: int, least_piece: int, first_window: int):
        self.size, self.most_open, self.least_piece, self.window = size, most_open, least_piece, first_window
        self.open: list[list] = []  # [room, pieces]
        self.out: list[tuple] = []

    def emit(self, pieces: list[tuple], partial_window: bool = False):
        offset = 0
        for doc_id, tokens, start, ids in pieces:
            self.out.append((doc_id, start, len(ids), zlib.crc32(ids.tobytes()), tokens, self.window, offset, partial_window))
            offset += len(ids)
        self.window += 1

    def add(self, doc_id, tokens: int, start: int, ids: np.ndarray):
        while len(ids):
            if len(ids) >= self.size:
                self.emit([(doc_id, tokens, start, ids[: self.size])])
                start, ids = start + self.size, ids[self.size :]
                continue
            best = min((w for w in self.open if w[0] >= len(ids)), key=lambda w: w[0], default=None)
            if best is None and len(self.open) < self.most_open:
                self.open.append(best := [self.size, []])
            if best is not None:
                # Kept ids are copied, so a window doesn't hold the block of texts they came from.
                best[1].append((doc_id, tokens, start, ids.copy()))
                best[0] -= len(ids)
                if not best[0]:
                    self.open.remove(best)
                    self.emit(best[1])
                return
            fullest = min(self.open, key=lambda w: w[0])
            self.open.remove(fullest)
            if (room := fullest[0]) >= self.least_piece:
                fullest[1].append((doc_id, tokens, start, ids[:room]))
                start, ids = start + room, ids[room:]
            self.emit(fullest[1])

    def finish(self):
        """Pours the open windows together; the last of them stays partial."""
        left = [p for _, pieces in sorted(self.open, key=lambda w: w[0]) for p in pieces]
        self.open, room, pieces = [], self.size, []
        for doc_id, tokens, start, ids in left:
            while len(ids):
                part, ids = ids[:room], ids[room:]
                pieces.append((doc_id, tokens, start, part))
                start, room = start + len(part), room - len(part)
                if not room:
                    self.emit(pieces)
                    room, pieces = self.size, []
        if pieces:
            self.emit(pieces, True)


_PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, partial boolean"
_ARROW = pa.schema([(x.split()[0], pa.bool_() if x.endswith("boolean") else pa.int64()) for x in _PIECES.split(", ")])


def _pack(batches, vocabulary: str, size: int, most_open: int, least_piece: int):
    tokenizer = tokenizer_of(vocabulary)
    packer = Packer(size, most_open, least_piece, TaskContext.get().partitionId() << 40)

    def taken():
        rows, packer.out = packer.out, []
        columns = zip(*rows, strict=True) if rows else [[]] * len(_ARROW)
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _ARROW, strict=True)], schema=_ARROW)

    for rows, data, offsets in blocks(batches):
        ids, sizes = tokenizer.encode(data, offsets)
        end = np.cumsum(sizes)
        for doc_id, low, high in zip(rows.column(0).to_pylist(), (end - sizes).tolist(), end.tolist(), strict=True):
            own = np.append(ids[low:high], np.uint32(END_ID)).astype("<u4")
            packer.add(doc_id, len(own), 0, own)
        yield taken()
    packer.finish()
    yield taken()


def _merge(batches, size: int):
    """New sequence and offset of partial windows (sequence_id, filled): each goes whole to the window it fits best."""
    windows: list[list[int]] = []
    for batch in batches:
        out = []
        for window, filled in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            best = min((w for w in windows if w[1] + filled <= size), key=lambda w: -w[1], default=None)
            if best is None:
                windows.append(best := [window, 0])
            out.append((window, best[0], best[1]))
            best[1] += filled
        columns = [pa.array(x, pa.int64()) for x in (zip(*out, strict=True) if out else [[]] * 3)]
        yield pa.RecordBatch.from_arrays(columns, ["old_id", "new_id", "moved"])


def pack(docs: DataFrame, vocabulary: str | None = None, size: int = SEQUENCE, most_open: int = OPEN_WINDOWS, least_piece: int = LEAST_PIECE) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    A document is its ids followed by id 0; a null text is an empty one, so it is the piece (0). Rows that repeat a doc_id are packed each on its
    own; doc_id may be null. sequence_id tells the task that made it. Reads only doc_id and text; an empty table gives no piece.
    A text is held whole by one task, with about 80 bytes of memory for each of its bytes.
    """
    stages = Stages(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    work = partial(_pack, vocabulary=vocabulary or default_vocabulary(), size=size, most_open=most_open, least_piece=least_piece)
    pieces = stages.keep("pieces", docs.mapInArrow(work, _PIECES))
    left = pieces.where("partial").groupBy("sequence_id").agg(F.sum("length").alias("filled"))
    group = F.shiftright("sequence_id", 40).cast("long") / MERGED_TASKS
    left = left.withColumn("__group", F.floor(group))
    merged = left.repartition("__group").sortWithinPartitions("__group", "sequence_id").select("sequence_id", "filled")
    merged = stages.keep("merged", merged.mapInArrow(partial(_merge, size=size), "old_id long, new_id long, moved long"))
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
    moved = pieces.where("partial").join(merged, F.col("sequence_id") == F.col("old_id"))
    moved = moved.select(*names, F.col("new_id").alias("sequence_id"), (F.col("offset") + F.col("moved")).alias("offset"))
    return pieces.where("NOT partial").select(*names, "sequence_id", "offset").union(moved)
