"""Removal of long repeated byte strings by a distributed merge sort of sampled suffixes."""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.shared import durable, importable, spread_join

MATCH, GRAM = 200, 32
#: Bytes of one piece of a text, and of pieces that are hashed together; suffixes of one sorted run; suffixes that one merging task expects; parts
#: into which a run is cut at each level of the exchange, and runs that one task merges there.
PIECE, TOGETHER, RUN, PER_MERGE, FAN, MERGED_RUNS = 1 << 18, 1 << 20, 50_000, 60_000, 512, 256
#: One merging task takes all places of a gram up to so many; beyond, the windows around them are counted one by one.
HOT_GRAM, WINDOWS = 100_000, 500_000

_MULTIPLIER = 0x01000193
_END, _BEGIN = b"\xff", b"\xfe"  # stand beyond a document's ends; UTF-8 has neither


def _letters() -> np.ndarray:
    return np.random.Generator(np.random.PCG64(5)).integers(1, 1 << 32, 256, dtype=np.uint32)


def _slide(x: np.ndarray, width: int, pick) -> np.ndarray:
    """pick (minimum or maximum) over x[i : i + width] for each i."""
    have = 1
    while 2 * have <= width:
        x = pick(x[:-have], x[have:])
        have *= 2
    return pick(x[: len(x) - (width - have)], x[width - have :]) if width > have else x


def anchors(data: np.ndarray, owner: np.ndarray, match: int, gram: int) -> np.ndarray:
    """Places whose `gram` bytes have the smallest hash of a whole `match`-byte window within one document.

    Which place a window picks depends on its bytes alone, so equal windows pick places at equal distances.
    """
    n, width = len(data), match - gram + 1
    if n < match:
        return np.zeros(0, np.int64)
    h, have, power = _letters()[data], 1, _MULTIPLIER
    while have < gram:
        h = h[:-have] * np.uint32(power) + h[have:]
        have, power = 2 * have, power * power & 0xFFFFFFFF
    h *= np.uint32(0x9E3779B1)
    h ^= h >> np.uint32(15)
    np.maximum(h, 1, out=h)
    least = _slide(h, width, np.minimum)
    least[owner[: n - match + 1] != owner[match - 1 :]] = 0  # windows that cross a document's end
    edge = np.zeros(width - 1, np.uint32)
    return np.flatnonzero(_slide(np.concatenate([edge, least, edge]), width, np.maximum) == h)


def pieces(texts: DataFrame, match: int, gram: int, piece: int) -> DataFrame:
    """texts: (_k1, _k2, _text). A row (_k1, _k2, _piece, _begin, _text) for each `piece` bytes of a text, with the bytes around them that strings
    of `match` bytes reach; _begin is where those start in the text."""
    back = match - gram
    rows = texts.select("_k1", "_k2", F.col("_text").cast("binary").alias("_text"))
    cut = rows.select("*", F.explode(F.sequence(F.lit(0), F.expr(f"cast((octet_length(_text) - 1) div {piece} as int)"))).alias("_piece"))
    begin = F.greatest(F.lit(0), F.col("_piece") * piece - back)
    return cut.select("_k1", "_k2", "_piece", begin.alias("_begin"), F.substring("_text", begin + 1, F.lit((piece + back + match))).alias("_text"))


def _find_anchors(match: int, gram: int, piece: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from xxhash import xxh64_intdigest

        for batch in batches:
            texts = batch.column(4)
            number, begin = (batch.column(k).to_numpy().astype(np.int64) for k in (2, 3))
            k = 0
            while k < len(texts):
                first, held = k, []
                while k < len(texts) and (k == first or sum(map(len, held)) < TOGETHER):
                    held.append(texts[k].as_py())
                    k += 1
                data, lengths = b"".join(held), np.array([len(t) for t in held])
                base, row = np.cumsum(lengths) - lengths, np.repeat(np.arange(first, k, dtype=np.int32), lengths)
                at = anchors(np.frombuffer(data, np.uint8), row, match, gram)
                row = row[at]
                place = begin[row] + at - base[row - first]
                own = place // piece == number[row]  # a place near a border is found from both sides
                at, row, place = at[own], row[own], place[own]
                if len(at):
                    grams = np.array([xxh64_intdigest(data[p : p + gram]) for p in at.tolist()], np.uint64).view(np.int64)
                    take = pa.array(row)
                    yield pa.RecordBatch.from_arrays([batch.column(0).take(take), batch.column(1).take(take), pa.array(grams), pa.array(place)], names=["_k1", "_k2", "_gram", "_pos"])

    return run


class Run:
    """A sorted run of distinct keys of one length, front-coded: what each key shares with the one before, and the rest."""

    def __init__(self, shared: np.ndarray, rests: bytes, size: int):
        self.shared, self.rests, self.size = shared.tolist(), rests, size
        self.row, self.at, self.key = -1, 0, b""

    @classmethod
    def coded(cls, keys: np.ndarray) -> tuple[np.ndarray, bytes]:
        """keys: sorted distinct rows of bytes. The two parts of the front code."""
        differ = keys[1:] != keys[:-1]
        shared = np.r_[0, differ.argmax(1)].astype(np.uint16) if len(keys) else np.zeros(0, np.uint16)
        return shared, keys[np.arange(keys.shape[1]) >= shared[:, None]].tobytes()

    def step(self) -> int:
        """Moves to the next key; its common prefix with the one before, or -1 at the end."""
        self.row += 1
        if self.row == len(self.shared):
            return -1
        shared = self.shared[self.row]
        end = self.at + self.size - shared
        self.key, self.at = self.key[:shared] + self.rests[self.at : end], end
        return shared


def merged(runs: list[Run]) -> Iterator[tuple[int, int, bytes, int]]:
    """(run, row in it, key, common prefix with the key before) in key order, by a loser tree that knows common prefixes.

    Every run waits with the length that its key shares with the key given out last. Of two, the one that shares more is
    smaller; only if both share as much are bytes compared, from there on, and the loser keeps what it shares with the winner.
    """
    k = len(runs)
    shares = [run.step() for run in runs]
    losers = [-1] * k

    def play(a: int, b: int) -> tuple[int, int]:
        """(winner, loser)"""
        x, y = shares[a], shares[b]
        if x != y:
            return (a, b) if x > y else (b, a)
        if x < 0:
            return a, b
        left, right = runs[a].key[x:], runs[b].key[x:]
        differ = (int.from_bytes(left) ^ int.from_bytes(right)).bit_length()
        equal = x + len(left) - (differ + 7) // 8
        if left <= right:
            shares[b] = equal
            return a, b
        shares[a] = equal
        return b, a

    waiting: dict[int, int] = {}
    for leaf in range(k):
        node, winner = (leaf + k) // 2, leaf
        while node and node in waiting:
            winner, losers[node] = play(waiting.pop(node), winner)
            node //= 2
        if node:
            waiting[node] = winner
    top = winner if k > 1 else 0
    while shares[top] >= 0:
        run = runs[top]
        yield top, run.row, run.key, shares[top]
        shares[top] = run.step()
        node = (top + k) // 2
        while node:
            top, losers[node] = play(top, losers[node])
            node //= 2


ROWS = "_target int, _run long, _shared binary, _rests binary, _o1 binary, _o2 binary, _pos binary, _whole binary, _k1 long, _k2 int, _from long, _to long"
_NAMES = [x.split()[0] for x in ROWS.split(", ")]
_TYPES = [pa.int32(), pa.int64(), *[pa.binary()] * 6, pa.int64(), pa.int32(), pa.int64(), pa.int64()]


def _batch(**columns) -> pa.RecordBatch:
    n = len(next(iter(columns.values())))
    return pa.RecordBatch.from_arrays([pa.array(columns.get(x, [None] * n), kind) for x, kind in zip(_NAMES, _TYPES, strict=True)], names=_NAMES)


def joined_ranges(k1: np.ndarray, k2: np.ndarray, begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, ...]:
    """The same bytes by as few ranges as they need."""
    by = np.lexsort((begin, k2, k1))
    k1, k2, begin, end = k1[by], k2[by], begin[by], end[by]
    if not len(by):
        return k1, k2, begin, end
    doc = np.cumsum(np.r_[False, (k1[1:] != k1[:-1]) | (k2[1:] != k2[:-1])]).astype(np.int64)
    reach = np.maximum.accumulate(doc * (1 << 40) + end)  # texts are shorter than that
    new = np.flatnonzero(np.r_[True, (doc[1:] != doc[:-1]) | (doc[1:] * (1 << 40) + begin[1:] > reach[:-1])])
    return k1[new], k2[new], begin[new], (reach - doc * (1 << 40))[np.r_[new[1:] - 1, len(by) - 1]]


def _run_rows(keys: list[bytes], k1: np.ndarray, k2: np.ndarray, pos: np.ndarray, done: np.ndarray, number: int, match: int, gram: int, targets: int, width: int) -> Iterator[pa.RecordBatch]:
    """Rows of a sorted run: its keys, front-coded and cut by target // width. Of keys that are equal one goes on, and all are done: their ranges are rows too."""
    import zstandard
    from xxhash import xxh64_intdigest

    new = np.array([True, *[a != b for a, b in zip(keys, keys[1:], strict=False)]])
    heads = np.flatnonzero(new)
    size = np.diff(np.r_[heads, len(keys)])
    many = size > 1
    copies = np.flatnonzero(np.repeat(many, size) & ~done)
    if len(copies):
        ahead, behind = (np.array([len(f(keys[x])) for x in copies.tolist()]) for f in (lambda key: key[:match].rstrip(_END), lambda key: key[match:].rstrip(_BEGIN)))
        ranges = joined_ranges(k1[copies], k2[copies], pos[copies] - behind, pos[copies] + ahead)
        yield _batch(**dict(zip(("_k1", "_k2", "_from", "_to"), ranges, strict=True)))
    whole = many | np.logical_or.reduceat(done, heads)
    target = np.array([xxh64_intdigest(keys[k][:gram], 1) % targets // width for k in heads.tolist()])
    zip_ = zstandard.ZstdCompressor(level=1)
    rows: list[tuple] = []
    for t in np.unique(target).tolist():
        mine = np.flatnonzero(target == t)
        some = heads[mine]
        shared, rests = Run.coded(np.frombuffer(b"".join([keys[k] for k in some.tolist()]), np.uint8).reshape(len(mine), -1))
        numbers = [x[some].astype(kind).tobytes() for x, kind in ((k1, "<i8"), (k2, "<i4"), (pos, "<i8"))]
        rows.append((t, number, zip_.compress(shared.tobytes()), zip_.compress(rests), *numbers, whole[mine].astype(np.uint8).tobytes()))
        if len(rows) == 64:
            yield _batch(**dict(zip(_NAMES[:8], map(list, zip(*rows, strict=True)), strict=True)))
            rows = []
    if rows:
        yield _batch(**dict(zip(_NAMES[:8], map(list, zip(*rows, strict=True)), strict=True)))


def _make_runs(match: int, gram: int, targets: int, width: int):
    """Runs of contexts of anchors. A context is `match` bytes from the anchor on and then the `match - gram` bytes before it, backwards."""
    back = match - gram

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number = TaskContext.get().partitionId() << 24
        found: list[tuple] = []

        def out() -> Iterator[pa.RecordBatch]:
            found.sort(key=lambda x: x[0])
            columns = [np.array([x[c] for x in found], kind) for c, kind in ((1, np.int64), (2, np.int32), (3, np.int64))]
            return _run_rows([x[0] for x in found], *columns, np.zeros(len(found), bool), number, match, gram, targets, width)

        for batch in batches:
            for k1, k2, begin, text, places in zip(*[batch.column(x).to_pylist() for x in ("_k1", "_k2", "_begin")], batch.column("_text"), batch.column("_places"), strict=True):
                data, at = text.as_py(), places.values.to_numpy(zero_copy_only=False) - begin
                for low in range(0, len(at), RUN):
                    for p in at[low : low + RUN].tolist():
                        found.append((data[p : p + match].ljust(match, _END) + data[max(0, p - back) : p][::-1].ljust(back, _BEGIN), k1, k2, p + begin))
                    if len(found) >= RUN:
                        yield from out()
                        found, number = [], number + 1
        if found:
            yield from out()

    return run


def _windows(match: int, gram: int, piece: int):
    """Windows of `match` bytes that hold a whole gram of `_places`, by 128-bit hash: of those that are equal within WINDOWS one
    row (_h1, _h2, _done, _k1, _k2, _from, _to) goes on, done if there are several, and all those are rows without a hash, joined to ranges."""
    width = match - gram + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from xxhash import xxh3_128_digest

        def out() -> pa.RecordBatch:
            hashes = np.frombuffer(b"".join(found), "V16")
            doc, start = np.repeat(np.arange(len(each)), each), np.concatenate(starts)
            _, one, where, n = np.unique(hashes.view([("a", "<u8"), ("b", "<u8")]), return_index=True, return_inverse=True, return_counts=True)
            many = np.flatnonzero(n[where] > 1)
            d, x = doc[many], start[many]
            order = np.lexsort((x, d))
            d, x = d[order], x[order]
            heads = np.flatnonzero(np.r_[True, (d[1:] != d[:-1]) | (x[1:] > x[:-1] + match)]) if len(d) else np.zeros(0, np.int64)
            tails = np.r_[heads[1:], len(d)] - 1
            pairs = hashes.view("<i8").reshape(-1, 2)[one]
            none = [None] * len(heads)
            who = np.r_[doc[one], d[heads]]
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([*pairs[:, 0].tolist(), *none], pa.int64()),
                    pa.array([*pairs[:, 1].tolist(), *none], pa.int64()),
                    pa.array(np.r_[n > 1, np.ones(len(heads), bool)]),
                    pa.array(np.array(first, np.int64)[who]),
                    pa.array(np.array(second, np.int32)[who]),
                    pa.array(np.r_[start[one], x[heads]]),
                    pa.array(np.r_[start[one], x[tails] if len(heads) else heads] + match),
                ],
                names=["_h1", "_h2", "_done", "_k1", "_k2", "_from", "_to"],
            )

        found, starts, first, second, each = [], [], [], [], []
        for batch in batches:
            names = ("_k1", "_k2", "_piece", "_begin")
            for k1, k2, number, begin, text, places in zip(*[batch.column(x).to_pylist() for x in names], batch.column("_text"), batch.column("_places"), strict=True):
                data, at = text.as_py(), np.sort(places.values.to_numpy(zero_copy_only=False)) - begin
                below = number * piece - begin - 1  # windows that begin in another piece are that piece's
                for a in range(0, len(at), 500):
                    s = np.unique((at[a : a + 500, None] - np.arange(width)).ravel())
                    s = s[(s > below) & (s < (number + 1) * piece - begin) & (s <= len(data) - match)]
                    below = int(s[-1]) if len(s) else below
                    found += [xxh3_128_digest(data[x : x + match]) for x in s.tolist()]
                    starts.append(s + begin)
                    first.append(k1)
                    second.append(k2)
                    each.append(len(s))
                    if len(found) >= WINDOWS:
                        yield out()
                        found, starts, first, second, each = [], [], [], [], []
        if found:
            yield out()

    return run


def _common(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Length of the common prefix of each pair of rows."""
    differ = a != b
    return np.where(differ.any(1), differ.argmax(1), a.shape[1])


def spans(keys: np.ndarray, shared: np.ndarray, done: np.ndarray, match: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """How far before and after its anchor each context lies in strings of `match` bytes that another context has too.

    keys: contexts in order, shared: their common prefixes with the one before, done: those known to have an equal.
    A string that holds the anchor begins some o bytes before it, and all such strings of a context overlap at the
    anchor, so the smallest and largest o tell what they cover. A context has o in common with another if the two share o
    bytes backwards and match - o forwards. The neighbour in forward order shares most forwards: if it shares enough
    backwards it decides the smallest o, and likewise the neighbour in backward order the largest. For the rest, contexts are
    grouped by both their classes, o by o. Returns (before, after), both 0 if there is none.
    """
    n, back = len(keys), match - gram
    right, left = keys[:, :match], keys[:, match:]
    ends, begins = (right == 0xFF)[:, ::-1].argmin(1), (left == 0xFE)[:, ::-1].argmin(1)
    ahead, behind = match - ends, back - begins
    behind[(left == 0xFE).all(1)] = 0
    same = shared >= gram
    same[:1] = False
    kind = np.cumsum(~same)
    fore = np.where(same, np.minimum(shared, match), -1)
    order = np.argsort(np.ascontiguousarray(left).view(f"S{back}").ravel(), kind="stable")
    order = order[np.argsort(kind[order], kind="stable")]
    aft = np.full(n, -1)
    if n > 1:
        aft[1:] = np.where(kind[order[1:]] == kind[order[:-1]], _common(left[order[1:]], left[order[:-1]]), -1)
    lowest, highest = np.full(n, match), np.full(n, -1)
    equal = np.zeros(n, bool)
    equal[1:] |= shared[1:] == match + back
    equal[:-1] |= shared[1:] == match + back
    whole = done | equal
    lowest[whole], highest[whole] = (match - ahead)[whole], behind[whole]

    fore_next, aft_next = np.r_[fore[1:], -1], np.r_[aft[1:], -1]
    rank = np.empty(n, np.int64)
    rank[order] = np.arange(n)
    most_fore = np.minimum(np.maximum(fore, fore_next), ahead)
    most_aft = np.minimum(np.maximum(aft, aft_next)[rank], behind)
    hope = ~whole & (most_fore + most_aft >= match)
    low_open, high_open = hope.copy(), hope.copy()
    rows = np.flatnonzero(hope)
    if len(rows):
        for near in (rows - 1, rows + 1):
            ok = (near >= 0) & (near < n)
            a, b = rows[ok], near[ok]
            f = np.minimum(np.where(b < a, fore[a], fore_next[a]), np.minimum(ahead[a], ahead[b]))
            g = np.minimum(_common(left[a], left[b]), np.minimum(behind[a], behind[b]))
            good = (f == most_fore[a]) & (f + g >= match)
            lowest[a[good]], low_open[a[good]] = match - most_fore[a[good]], False
        for step in (-1, 1):
            seat = rank[rows] + step
            ok = (seat >= 0) & (seat < n)
            a, b = rows[ok], order[seat[ok]]
            g = np.minimum(aft[rank[a]] if step < 0 else aft_next[rank[a]], np.minimum(behind[a], behind[b]))
            f = np.minimum(_common(right[a], right[b]), np.minimum(ahead[a], ahead[b]))
            good = (g == most_aft[a]) & (f + g >= match)
            highest[a[good]], high_open[a[good]] = most_aft[a[good]], False
    for open_, found, offsets in ((low_open, lowest, range(back + 1)), (high_open, highest, range(back, -1, -1))):
        for o in offsets:
            now = open_ & (match - most_fore <= o) & (o <= most_aft)
            if not now.any():
                if not open_.any():
                    break
                continue
            mine = np.zeros(kind[-1] + 1, bool)
            mine[kind[now]] = True
            some = np.flatnonzero(mine[kind] & (ahead >= match - o) & (behind >= o))
            by_right, by_left = np.cumsum(fore < match - o), np.cumsum(aft < o)[rank]
            _, group, count = np.unique(by_right[some] * (n + 1) + by_left[some], return_inverse=True, return_counts=True)
            hit = np.zeros(n, bool)
            hit[some[count[group] > 1]] = True
            hit &= now
            found[hit], open_[hit] = o, False
    none = highest < lowest
    before, after = highest.copy(), match - lowest
    before[none] = after[none] = 0
    return before, after


def _merged_keys(rows: pa.Table, size: int) -> tuple:
    """(keys, common prefixes with the key before, k1, k2, pos, done) of the runs in rows, merged."""
    import zstandard

    unzip = zstandard.ZstdDecompressor()
    column = {x: rows.column(x).to_pylist() for x in ("_shared", "_rests", "_o1", "_o2", "_pos", "_whole")}
    runs = [Run(np.frombuffer(unzip.decompress(s), np.uint16), unzip.decompress(r), size) for s, r in zip(column["_shared"], column["_rests"], strict=True)]
    starts = np.cumsum([0, *[len(r.shared) for r in runs]])
    seats, keys, shared = [], [], []
    for run, row, key, share in merged(runs):
        seats.append(int(starts[run]) + row)
        keys.append(key)
        shared.append(share)
    seat = np.array(seats)
    k1, k2, pos, done = (np.concatenate([np.frombuffer(x, kind) for x in column[c]])[seat] for c, kind in (("_o1", "<i8"), ("_o2", "<i4"), ("_pos", "<i8"), ("_whole", np.uint8)))
    return keys, np.array(shared), k1, k2, pos, done > 0


def _recut_runs(match: int, gram: int, targets: int, width: int):
    """One level of the exchange: a group of runs of one target becomes one run, cut by targets of the next level."""

    def recut(rows: pa.Table) -> pa.Table:
        keys, _, k1, k2, pos, done = _merged_keys(rows, 2 * match - gram)
        out = _run_rows(keys, k1, k2, pos, done, min(rows.column("_run").to_pylist()), match, gram, targets, width)
        return pa.Table.from_batches(list(out), _batch(_target=[]).schema)

    return recut


def _merge_runs(match: int, gram: int):
    def merge(rows: pa.Table) -> pa.Table:
        size = 2 * match - gram
        keys, shared, k1, k2, pos, done = _merged_keys(rows, size)
        before, after = spans(np.frombuffer(b"".join(keys), np.uint8).reshape(-1, size), shared, done, match, gram)
        hit = (after > 0) & ~done
        return pa.table(dict(zip(("_k1", "_k2", "_from", "_to"), joined_ranges(k1[hit], k2[hit], (pos - before)[hit], (pos + after)[hit]), strict=True)))

    return merge


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        kept, sizes, removed, runs = [], [], [], []
        for text, begin, end in zip(batch.column(1).cast(pa.binary()), batch.column(2), batch.column(3), strict=True):
            data = text.as_py() or b""
            rest, spans_ = data, 0
            if begin.as_py():
                a, b = (x.values.to_numpy(zero_copy_only=False) for x in (begin, end))
                none = np.zeros(len(a), np.int64)
                _, _, a, b = joined_ranges(none, none, a, b)
                rest = b"".join([data[x:y] for x, y in zip([0, *b.tolist()], [*a.tolist(), len(data)], strict=True)])
                spans_ = len(a)
            runs.append(spans_)
            kept.append(rest)
            sizes.append(len(data))
            removed.append(len(data) - len(rest))
        numbers = [pa.array(x, pa.int64()) for x in (sizes, removed, runs)]
        yield pa.RecordBatch.from_arrays([batch.column(0), *numbers, pa.array(kept, pa.binary())], names=["_id", "n_bytes", "n_removed", "n_spans", "kept"])


def _row_key(id_col: str, text: Column) -> list[Column]:
    return [F.xxhash64(F.col(id_col), text).alias("_k1"), F.hash(text).alias("_k2")]


def repeated_spans(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    match: int = MATCH,
    gram: int = GRAM,
    per_merge: int = PER_MERGE,
    hot: int = HOT_GRAM,
    piece: int = PIECE,
    fan: int = FAN,
    merged_runs: int = MERGED_RUNS,
) -> DataFrame:
    """(_k1, _k2, _from, _to): byte ranges, overlapping, that cover all that repeats; keys as of _row_key.

    Texts are looked at in pieces with the bytes around them, so a text of any length takes bounded memory. Of the suffixes only those at anchors are sorted:
    each window of `match` bytes picks one of its `gram`-byte strings by hash,
    and repeated windows pick alike. Anchors whose gram occurs once are out. The others' contexts become sorted runs, are
    cut by target, sent front-coded and merged, and neighbours in the merged order tell what repeats. With more targets than `fan` the exchange has
    levels: a run is cut into `fan` parts at most, up to `merged_runs` of which become one run that is cut again, so that no part is too short to be
    front-coded. A gram at more than `hot` places would fill one merging task: there the windows that hold it are hashed, equal ones collapse in their
    tasks, and the rest meet by hash.
    """
    if gram < 2 or gram & (gram - 1) or gram > match:
        raise ValueError("gram: a power of two up to match")
    text = F.coalesce(F.col(text_col), F.lit(""))
    whole = docs.select(*_row_key(id_col, text), text.alias("_text")).filter(F.octet_length("_text") >= match)
    base = pieces(whole, match, gram, piece)
    found = durable(base.mapInArrow(_find_anchors(match, gram, piece), "_k1 long, _k2 int, _gram long, _pos long"))
    again = found.groupBy("_gram").agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").select("_gram", (F.col("_n") > hot).alias("_hot_gram"))
    near = F.array_distinct(F.array(F.expr(f"_pos div {piece}"), F.when(F.col("_hot_gram"), F.expr(f"greatest(0L, _pos - {match - gram}) div {piece}")).otherwise(F.expr(f"_pos div {piece}"))))
    placed = spread_join(found, again, ["_gram"]).select("_k1", "_k2", "_pos", "_hot_gram", F.explode(near.cast("array<int>")).alias("_piece"))
    both = durable(placed.groupBy("_k1", "_k2", "_piece").agg(*[F.collect_set(F.when(F.col("_hot_gram") == flag, F.col("_pos"))).alias(name) for flag, name in ((False, "_places"), (True, "_hot_places"))]))
    places = both.filter(F.size("_places") > 0).select("_k1", "_k2", "_piece", "_places")
    n = places.agg(F.sum(F.size("_places"))).first()[0] or 0
    targets, levels = -(-n // per_merge) or 1, 1
    while fan**levels < targets:
        levels += 1
    width = 1
    while levels > 1 and width**levels < targets:
        width += 1
    targets = width**levels if levels > 1 else targets
    steps = [width**k for k in range(levels - 1, -1, -1)]
    runs = durable(base.join(places, ["_k1", "_k2", "_piece"]).mapInArrow(_make_runs(match, gram, targets, steps[0]), ROWS))
    ranges = "_k1 long, _k2 int, _from long, _to long"
    ready = [runs.filter("_target is null")]
    groups = n // RUN + 1
    for step in steps[1:]:
        groups = -(-groups // merged_runs)
        run = F.pmod(F.xxhash64("_run"), F.lit(groups)).alias("_group")
        runs = durable(runs.filter("_target is not null").groupBy("_target", run).applyInArrow(_recut_runs(match, gram, targets, step), ROWS))
        ready.append(runs.filter("_target is null"))
    ranges_found = runs.filter("_target is not null").groupBy("_target").applyInArrow(_merge_runs(match, gram), ranges)
    for part in ready:
        ranges_found = ranges_found.unionByName(part.select("_k1", "_k2", "_from", "_to"))
    dense = both.filter(F.size("_hot_places") > 0).select("_k1", "_k2", "_piece", F.col("_hot_places").alias("_places"))
    if dense.isEmpty():
        return ranges_found
    windows = durable(base.join(dense, ["_k1", "_k2", "_piece"]).mapInArrow(_windows(match, gram, piece), f"_h1 long, _h2 long, _done boolean, {ranges}"))
    open_ = F.when(~F.col("_done"), F.struct("_k1", "_k2", "_from", "_to"))
    met = windows.filter("_h1 is not null").groupBy("_h1", "_h2").agg(F.count(F.lit(1)).alias("_n"), F.collect_list(open_).alias("_open"))  # a row for each WINDOWS at most
    repeated = met.filter("_n > 1").select(F.explode("_open").alias("_range")).select("_range.*")
    return ranges_found.unionByName(windows.filter("_h1 is null").select("_k1", "_k2", "_from", "_to")).unionByName(repeated)


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", match: int = MATCH, gram: int = GRAM, **how) -> DataFrame:
    """One row per document: (id, n_bytes, n_removed, n_spans, kept), kept being the bytes that stay, as binary. how: as of repeated_spans.

    Every byte goes that lies in a string of `match` bytes which also starts anywhere else in the table, the same document
    included. Strings never cross documents and are judged on the input. n_spans counts maximal removed runs.

    A null text counts as empty; texts under `match` bytes stay whole; long ones are looked at in pieces. Rows that repeat id and text repeat each other and lose the same
    bytes. Extra columns are ignored. An empty table gives no rows.
    """
    importable(docs.sparkSession)
    id_type = docs.schema[id_col].dataType.simpleString()
    text = F.coalesce(F.col(text_col), F.lit(""))
    whole = docs.select(F.col(id_col).alias("_id"), *_row_key(id_col, text), text.alias("_text"))
    cuts = repeated_spans(docs, id_col, text_col, match, gram, **how).distinct().groupBy("_k1", "_k2").agg(F.collect_list("_from").alias("_from"), F.collect_list("_to").alias("_to"))
    rows = whole.join(cuts, ["_k1", "_k2"], "left").select("_id", "_text", "_from", "_to")
    made = rows.mapInArrow(_cut, f"_id {id_type}, n_bytes long, n_removed long, n_spans long, kept binary")
    return made.withColumnRenamed("_id", id_col)
