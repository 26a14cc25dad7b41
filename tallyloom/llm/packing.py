"""Packing documents into fixed token windows: bounded-space online best-fit per partition, leftovers merged at the end."""

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.shared import durable, importable

WINDOW, OPEN_WINDOWS, END_ID = 2048, 16, 1
#: Leftovers of so many partitions meet in one task: at most MERGE_PARTS * WINDOW tokens.
MERGE_PARTS = 64
#: Parts of words whose ids a Python worker remembers; later ones are encoded again in each batch.
REMEMBERED_PARTS = 400_000
#: How the tokenizer's vocabulary marks a unit's last token.
UNIT_END = "</w>"
#: Signs between a Latin letter and a blank. The tokenizer begins a new unit there; an apostrophe is not among them.
SIGNS_APART = re.compile(rb"([.,!?;:$%&*#()](?:(?<=[a-z].)|(?<=\xc3[\x80-\x96\x98-\xb6\xb8-\xbf].))[.,!?;:$%&*#()]*)(?=[ \n]|$)")

#: sequence_id: the partition in the upper bits, a count in the lower; sequences of merged leftovers lie beyond all others.
_PART_BITS, _LEFTOVER = 32, 1 << 62

NUMBERS = ["start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
PIECES = "_id {id}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, _group long, _ids binary"

_encoders: dict[str, "WordEncoder"] = {}


class WordEncoder:
    """Ids of a tokenizer that folds case, drops white space and never joins letters with signs that follow them.

    No token crosses a blank, so parts between blanks are encoded once and joined. Signs at a word's end are set apart from
    its letters first, which leaves far fewer parts. A part of letters alone is one unit to the tokenizer, and the unit's last token
    is marked; new ones are therefore encoded together, as one text, and told apart by those marks.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.known: dict[bytes, bytes] = {}
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[k for token, k in vocabulary.items() if token.endswith(UNIT_END)]] = True

    def _one_by_one(self, parts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(parts, add_special_tokens=False)
        return [np.asarray(x.ids, "<u4").tobytes() for x in found]

    def _together(self, parts: list[str]) -> list[bytes]:
        ids = np.asarray(self.tokenizer.encode_batch_fast([" ".join(parts)], add_special_tokens=False)[0].ids, "<u4")
        cuts = np.flatnonzero(self.ends[ids]) + 1
        if len(cuts) != len(parts):  # a letter that folds into several units
            return self._one_by_one(parts)
        data, cuts = ids.tobytes(), [0, *(4 * cuts).tolist()]
        return [data[a:b] for a, b in zip(cuts, cuts[1:], strict=False)]

    def _encode(self, parts: set[bytes]) -> dict[bytes, bytes]:
        out: dict[bytes, bytes] = {}
        texts = {part: part.decode() for part in parts}
        letters = [part for part, text in texts.items() if text.isalpha()]
        others = [part for part, text in texts.items() if not text.isalpha()]
        for group, encode in ((letters, self._together), (others, self._one_by_one)):
            for at in range(0, len(group), 4096):
                some = group[at : at + 4096]
                out.update(zip(some, encode([texts[x] for x in some]), strict=True))
        return out

    def ids(self, texts: list[bytes]) -> list[bytes]:
        """For each text its ids, little-endian unsigned 32-bit."""
        parts = [SIGNS_APART.sub(rb" \1", text.lower()).split() for text in texts]
        get, new = self.known.get, set()
        found = [list(map(get, own)) for own in parts]
        for own, have in zip(parts, found, strict=True):
            if None in have:
                new.update([p for p, ids in zip(own, have, strict=True) if ids is None])
        fresh = self._encode(new)
        if len(self.known) + len(fresh) <= REMEMBERED_PARTS:
            self.known.update(fresh)
        return [b"".join([fresh[p] if ids is None else ids for p, ids in zip(own, have, strict=True)] if None in have else have) for own, have in zip(parts, found, strict=True)]


def encoder(path: str) -> WordEncoder:
    if path not in _encoders:
        _encoders[path] = WordEncoder(path)
    return _encoders[path]


class _Packer:
    """Open windows of one partition. A window is [sequence, tokens used]; a piece is a slice of one document's ids."""

    def __init__(self, part: int, window: int, open_windows: int):
        self.part, self.window, self.limit = part, window, open_windows
        self.open: list[list] = []
        self.made = 0
        self.rows: list[tuple] = []

    def _new(self) -> list:
        self.made += 1
        return [(self.part << _PART_BITS) + self.made - 1, 0, []]

    def _put(self, window: list, piece: tuple) -> None:
        window[2].append((*piece, window[1]))
        window[1] += piece[2]

    def _emit(self, window: list) -> None:
        self.rows += [(i, start, n, ids, total, window[0], offset) for i, start, n, ids, total, offset in window[2]]

    def add(self, doc_id, ids: bytes) -> None:
        total, at = len(ids) // 4, 0
        while total - at >= self.window:
            full = self._new()
            self._put(full, (doc_id, at, self.window, ids[4 * at : 4 * (at + self.window)], total))
            self._emit(full)
            at += self.window
        while at < total:
            need = total - at
            best = max((w for w in self.open if w[1] + need <= self.window), key=lambda w: w[1], default=None)
            if best is None and len(self.open) < self.limit:
                best = self._new()
                self.open.append(best)
            if best is None:  # none fits: the fullest is filled to its end with a first part, and goes
                best = max(self.open, key=lambda w: w[1])
                need = self.window - best[1]
            self._put(best, (doc_id, at, need, ids[4 * at : 4 * (at + need)], total))
            at += need
            if best[1] == self.window:
                self._emit(best)
                self.open.remove(best)

    def leftovers(self) -> list[tuple]:
        """Joins the open windows: whole ones are emitted, the pieces after them are returned for the merge."""
        rest = sorted(self.open, key=lambda w: -w[1])
        pieces = [(i, start, n, ids, total) for w in rest for i, start, n, ids, total, _ in w[2]]
        self.open = []
        full = sum(p[2] for p in pieces) // self.window * self.window
        kept, at, window = [], 0, None
        for piece in pieces:
            for i, start, n, ids, total in _cut(piece, at, self.window):
                if at < full:
                    window = self._new() if at % self.window == 0 else window
                    self.rows.append((i, start, n, ids, total, window[0], at % self.window))
                else:
                    kept.append((i, start, n, ids, total))
                at += n
        return kept


def _cut(piece: tuple, at: int, window: int) -> Iterator[tuple]:
    """Cuts a piece that would begin at place `at` wherever a window ends."""
    i, start, n, ids, total = piece
    done = 0
    while done < n:
        m = min(n - done, window - (at + done) % window)
        yield i, start + done, m, ids[4 * done : 4 * (done + m)], total
        done += m


def _merge(pieces: list[tuple], first_sequence: int, window: int) -> list[tuple]:
    """Full windows of all leftovers; what remains is cut into windows of falling powers of two, which need no padding."""
    left = sum(p[2] for p in pieces)
    ends = [window] * (left // window) + [1 << b for b in range(window.bit_length(), -1, -1) if left % window >> b & 1]
    out, k, used = [], 0, 0
    for i, start, n, ids, total in pieces:
        done = 0
        while done < n:
            m = min(n - done, ends[k] - used)
            out.append((i, start + done, m, ids[4 * done : 4 * (done + m)], total, first_sequence + k, used))
            done, used = done + m, used + m
            if used == ends[k]:
                k, used = k + 1, 0
    return out


def pack_documents(
    docs: DataFrame,
    tokenizer_path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    window: int = WINDOW,
    open_windows: int = OPEN_WINDOWS,
    end_id: int = END_ID,
    merge_parts: int = MERGE_PARTS,
    with_ids: bool = False,
) -> DataFrame:
    """One row per piece: (id, start, length, ids_crc32, doc_tokens, sequence_id, offset[, ids]).

    A document is its text's ids and then `end_id`. Each partition streams its documents through at most `open_windows`
    open windows: full windows' worth is cut off first, the rest goes to the open window that it fills best; when none
    has room and no more may be opened, the fullest takes what it can hold and is emitted. At the end a partition joins
    its open windows and keeps less than one window of leftovers, whose ids go on. Groups of `merge_parts` partitions
    merge theirs, so a task holds at most merge_parts windows. The last, partial window of a group is cut at powers of
    two, so it needs no padding.

    A null text counts as empty and packs the end id alone. Rows that repeat an id are packed one by one. Texts of any length are cut
    freely, each id lying in exactly one piece. An empty table gives no rows. Extra columns are ignored. The packed
    pieces are written to the shared folder before the merge reads them, so a retried task cannot deal ids twice.
    """
    importable(docs.sparkSession)
    id_type = docs.schema[id_col].dataType.simpleString()
    schema = PIECES.format(id=id_type)
    end = np.asarray([end_id], "<u4").tobytes()
    def table(rows: list[tuple], group: int | None, id_arrow: pa.DataType) -> pa.RecordBatch:
        columns = list(zip(*rows, strict=True)) if rows else [[]] * 7
        ids, start, length, blobs, total, sequence, offset = columns
        crc = [zlib.crc32(b) for b in blobs]
        keep = blobs if group is not None or with_ids else [None] * len(rows)
        numbers = [start, length, crc, total, sequence, offset, [group] * len(rows)]
        columns = [pa.array(ids, id_arrow), *[pa.array(x, pa.int64()) for x in numbers], pa.array(keep, pa.binary())]
        return pa.RecordBatch.from_arrays(columns, names=["_id", *NUMBERS, "_group", "_ids"])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        words, part = encoder(tokenizer_path), TaskContext.get().partitionId()
        packer, kind = _Packer(part, window, open_windows), None
        for batch in batches:
            kind = batch.schema.field(0).type
            ids, texts = batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist()
            for at in range(0, len(ids), 512):
                for i, found in zip(ids[at : at + 512], words.ids([t or b"" for t in texts[at : at + 512]]), strict=True):
                    packer.add(i, found + end)
                yield table(packer.rows, None, kind)
                packer.rows = []
        if kind is not None:
            rest = packer.leftovers()
            yield table(packer.rows, None, kind)
            yield table([(*p, part, k) for k, p in enumerate(rest)], part // merge_parts, kind)

    def merge(key: tuple, group: pa.Table) -> pa.Table:
        kind, number = group.schema.field("_id").type, key[0].as_py()
        rows = group.sort_by([("sequence_id", "ascending"), ("offset", "ascending")]).select(["_id", "start", "length", "_ids", "doc_tokens"])
        pieces = list(zip(*[c.to_pylist() for c in rows.columns], strict=True))
        return pa.Table.from_batches([table(_merge(pieces, _LEFTOVER + (number << _PART_BITS), window), number, kind)])

    packed = durable(docs.select(F.col(id_col).alias("_id"), text_col).mapInArrow(pack, schema))
    done = packed.filter("_group is null")
    merged = packed.filter("_group is not null").groupBy("_group").applyInArrow(merge, schema)
    out = done.unionByName(merged)
    return out.select(F.col("_id").alias(id_col), *NUMBERS, *([F.col("_ids").alias("ids")] if with_ids else []))
