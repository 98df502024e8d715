"""Removal of byte strings that occur more than once, by sorting suffixes.

A byte goes if a string of ``length`` bytes that covers it starts anywhere else.
Sorting every suffix of every text would move each text hundreds of times, so
only the suffixes at anchors are sorted. The anchor of a window (a string of
``length`` bytes) is its ``lead``-byte substring with the smallest hash, the
leftmost of equals: two equal windows have equal anchors at equal offsets. Each
window has one anchor, and an anchor owns a run of windows, so comparing the windows of
equal anchors at equal offsets compares all equal windows.

1. Anchors (hash, text, position) are shuffled by hash range as sorted blocks;
   those whose hash occurs once are dropped.
2. The texts that keep anchors give for each one its suffix and the bytes before
   it, as far as its windows reach. Equal ones are counted once in every task.
3. Sampled splitters range-partition the suffixes by their leading ``lead`` bytes;
   no splitter falls between equal leads, so windows are never cut by a bucket's
   boundary, and the first and last suffix of neighbouring buckets differ within the lead.
   A bucket sorts its suffixes, and the bytes before them read backwards, by
   multikey quicksort on 8-byte words, which also gives the lengths of common prefixes. Two windows at
   offset d are equal if the suffixes agree in length - d bytes and the bytes before
   in d: classes of both orders are counted for every d, never pairs.
   Leads of more than ``alike`` places don't go to a bucket, for a passage in very many texts has
   at its edges one distinct segment a text, all with one lead. Their windows are counted by
   hash: first in every task, where a window of several segments is settled and leaves one row,
   then by hash range over all tasks.
4. The repeated windows of each text are joined back to it and cut out.

Copies of a whole text are one text with a count (all its bytes go if it has a
window at all), so any number of copies costs one row in these steps.

Defined results: a null text is the empty text; texts under ``length`` bytes keep
all; rows with equal or null ids stay separate rows (and are separate documents); an
empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import slices, staged, text_bytes

_CHUNK = 1 << 20
_BASE = np.uint64(0x5851F42D4C957F2D)
_powers: dict[str, np.ndarray] = {}


def _tables() -> tuple[np.ndarray, np.ndarray]:
    """Powers of the hash base and of its inverse modulo 2^64."""
    if not _powers:
        for name, base in (("up", int(_BASE)), ("down", pow(int(_BASE), -1, 1 << 64))):
            steps = np.full(_CHUNK + 1, base, np.uint64)
            steps[0] = 1
            _powers[name] = np.multiply.accumulate(steps)
    return _powers["up"], _powers["down"]


def lead_hashes(data: np.ndarray, lead: int) -> np.ndarray:
    """Hash of every ``lead``-byte substring (at most 2^20 bytes of data)."""
    up, down = _tables()
    n = len(data)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(data.astype(np.uint64) * up[:n], out=total[1:])
    h = (total[lead:] - total[:-lead]) * down[:n - lead + 1]
    h ^= h >> np.uint64(31)
    h *= np.uint64(0x9E3779B97F4A7C15)
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    return h


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` values in a row, from block-wise running minima."""
    n = len(values) - width + 1
    pad = -len(values) % width
    grid = np.concatenate([values, np.full(pad, np.iinfo(values.dtype).max, values.dtype)]).reshape(-1, width)
    ahead = np.minimum.accumulate(grid, axis=1).ravel()
    behind = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n], ahead[width - 1:width - 1 + n])


def anchors(raw: bytes, length: int, lead: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(hash, position, first window, last window) of each anchor of one text."""
    width, out = length - lead + 1, []
    data = np.frombuffer(raw, np.uint8)
    step = _CHUNK - length  # windows of a chunk; chunks overlap by less than a window
    for start in range(0, max(0, len(data) - length + 1), step):
        part = data[start:start + step + length - 1]
        h = lead_hashes(part, lead)
        # upper 40 bits of the hash, then the place: the leftmost of equals is smallest
        key = h & ~np.uint64((1 << 24) - 1) | np.arange(len(h), dtype=np.uint64)
        at = (sliding_min(key, width) & np.uint64((1 << 24) - 1)).astype(np.int64)
        first = np.flatnonzero(np.r_[True, at[1:] != at[:-1]])
        last = np.r_[first[1:], len(at)] - 1
        out.append((h[at[first]], at[first] + start, first + start, last + start))
    if not out:
        return np.zeros(0, np.uint64), *(np.zeros(0, np.int64) for _ in range(3))
    return tuple(np.concatenate(x) for x in zip(*out))


def multikey_sort(words: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of the rows of ``words`` (big-endian 8-byte words of zero-padded strings; shorter
    first among equals), and the common prefix in bytes of each row with the one before it.

    Multikey quicksort with a word as the character: rows that tie so far are
    partitioned by their next word, and only ties go on to the word after.
    """
    n, width = words.shape
    order, common = np.arange(n), np.zeros(n, np.int64)
    active, group = np.arange(n), np.zeros(n, np.int64)  # places that still tie, and their group
    for depth in range(width):
        word = words[order[active], depth]
        by = np.lexsort((word, group))
        order[active], word = order[active][by], word[by]
        same_group = np.r_[False, group[1:] == group[:-1]]
        differs = np.r_[False, word[1:] != word[:-1]]
        split = np.flatnonzero(same_group & differs)
        mixed = word[split] ^ word[split - 1]
        # whole bytes in which the two words agree: leading zero bytes of their difference
        equal = np.zeros(len(split), np.int64)
        for byte in range(1, 8):
            equal += mixed < np.uint64(1 << (64 - 8 * byte))
        common[active[split]] = 8 * depth + equal
        head = ~same_group | differs
        group = np.cumsum(head) - 1
        tied = np.bincount(group)[group] > 1
        active, group = active[tied], group[tied]
        if not len(active):
            break
    if len(active):
        by = np.lexsort((lengths[order[active]], group))
        order[active] = order[active][by]
        inner = np.flatnonzero(np.r_[False, group[1:] == group[:-1]])
        common[active[inner]] = 8 * width
    ordered = lengths[order]
    common[1:] = np.minimum(common[1:], np.minimum(ordered[1:], ordered[:-1]))
    if n:
        common[0] = 0
    return order, common


def _words(strings: list[bytes], width: int) -> np.ndarray:
    size = -(-width // 8) * 8
    return np.frombuffer(b"".join(s.ljust(size, b"\0") for s in strings), ">u8").reshape(len(strings), -1).astype(np.uint64)


def repeated_windows(segments: list[bytes], offset: np.ndarray, windows: np.ndarray, count: np.ndarray,
                     length: int, lead: int) -> np.ndarray:
    """Which windows of each segment occur elsewhere: bool (segment, window).

    A segment holds ``windows`` windows in a row and its anchor's suffix from ``offset`` on.
    """
    reach = length - lead + 1
    right = [s[o:] for s, o in zip(segments, offset)]
    left = [s[:o][::-1] for s, o in zip(segments, offset)]
    flags = np.zeros((len(segments), reach), bool)
    orders = []
    for strings, width in ((right, length), (left, reach)):
        order, common = multikey_sort(_words(strings, width), np.array(list(map(len, strings)), np.int64))
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        orders.append((common, place))
    (common_right, place_right), (common_left, place_left) = orders
    for d in range(reach):
        rows = np.flatnonzero((offset - windows < d) & (d <= offset))
        if len(rows):
            after = np.cumsum(common_right < length - d)[place_right[rows]]
            before = np.cumsum(common_left < d)[place_left[rows]] if d else 0
            _, kind = np.unique(after * (len(segments) + 1) + before, return_inverse=True)
            flags[rows, offset[rows] - d] = np.bincount(kind, weights=count[rows])[kind] >= 2
    return flags


def _key(segment: bytes, offset: int) -> bytes:
    return hashlib.blake2b(segment + offset.to_bytes(2, "little"), digest_size=16).digest()


def _text_id() -> Column:
    return F.xxhash64("text").alias("tid")


def _range_of(h: np.ndarray, ranges: int) -> np.ndarray:
    """Equal ranges of the hash mixed once more: anchors' hashes are minima and crowd near 0."""
    mixed = (h ^ (h >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    mixed = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return ((mixed >> np.uint64(32)) * np.uint64(ranges) >> np.uint64(32)).astype(np.int64)


def _anchor_blocks(texts: DataFrame, length: int, lead: int, ranges: int) -> DataFrame:
    """(part, block): anchors by hash range; copies of a text are read once in each task."""
    kinds = (np.uint64, np.int64, np.uint32, np.uint8, np.uint8)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def flush(held: list[tuple]) -> pa.RecordBatch:
            columns = [np.concatenate(c) for c in zip(*held)]
            part = _range_of(columns[0], ranges)
            order = np.argsort(part, kind="stable")
            cuts = np.searchsorted(part[order], np.arange(ranges + 1))
            rows = [(p, *(c[order[a:b]].tobytes() for c in columns)) for p, (a, b) in enumerate(zip(cuts, cuts[1:])) if b > a]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), [pa.int32()] + [pa.binary()] * 5)],
                                              ["part", "h", "tid", "pos", "ahead", "behind"])

        held, n, seen = [], 0, set()
        for batch in slices(batches, 1):
            for tid, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if len(raw) < length or (tid, len(raw)) in seen:
                    continue
                seen.add((tid, len(raw)))
                h, at, first, last = anchors(raw, length, lead)
                held.append(tuple(x.astype(k) for x, k in zip((h, np.full(len(h), tid), at, at - first, at - last), kinds)))
                n += len(h)
                if n >= 250_000:
                    yield flush(held)
                    held, n = [], 0
            if len(seen) > 500_000:
                seen.clear()
        if held:
            yield flush(held)

    return texts.mapInArrow(run, "part int, h binary, tid binary, pos binary, ahead binary, behind binary")


def _repeated_anchors(blocks: DataFrame, alike: int) -> DataFrame:
    """(tid, n, hot, anchors): per text and range the anchors whose hash has several places; ``hot``
    windows belong to anchors whose hash has more than ``alike``."""

    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        h, tid, pos, ahead, behind = (np.frombuffer(b"".join(rows[c]), k) for c, k in (
            ("h", np.uint64), ("tid", np.int64), ("pos", np.uint32), ("ahead", np.uint8), ("behind", np.uint8)))
        order = np.lexsort((pos, tid, h))
        h, tid, pos, ahead, behind = (x[order] for x in (h, tid, pos, ahead, behind))
        # an anchor of a copy in another task is the same place; chunks may share an anchor's window runs
        same = np.r_[False, (h[1:] == h[:-1]) & (tid[1:] == tid[:-1]) & (pos[1:] == pos[:-1])
                     & (ahead[1:] == ahead[:-1]) & (behind[1:] == behind[:-1])]
        h, tid, pos, ahead, behind = (x[~same] for x in (h, tid, pos, ahead, behind))
        group = np.cumsum(np.r_[True, h[1:] != h[:-1]]) - 1
        places = np.bincount(group)[group]
        keep, hot = places > 1, (places > alike).astype(np.uint8)
        tid, pos, ahead, behind, hot = (x[keep] for x in (tid, pos, ahead, behind, hot))
        order = np.argsort(tid, kind="stable")
        tid, pos, ahead, behind, hot = (x[order] for x in (tid, pos, ahead, behind, hot))
        starts = np.flatnonzero(np.r_[True, tid[1:] != tid[:-1]]) if len(tid) else np.zeros(0, np.int64)
        packed = np.rec.fromarrays([pos, ahead, behind, hot], dtype=_ANCHOR)
        windows = np.where(hot, ahead.astype(np.int64) - behind + 1, 0)
        return pd.DataFrame([(int(tid[a]), int(b - a), int(windows[a:b].sum()), packed[a:b].tobytes())
                             for a, b in zip(starts, np.r_[starts[1:], len(tid)])], columns=["tid", "n", "hot", "anchors"])

    return blocks.groupBy("part").applyInPandas(run, "tid bigint, n bigint, hot bigint, anchors binary")


_ANCHOR = np.dtype([("pos", "<u4"), ("ahead", "u1"), ("behind", "u1"), ("hot", "u1")])


def _segments(raw: bytes, packed: list[bytes], length: int, hot: tuple = (0, 1)) -> Iterator[tuple[int, int, int, bytes]]:
    """(first window, offset of the anchor, windows, bytes of all its windows), of anchors hot or not."""
    for pos, ahead, behind, kind in np.frombuffer(b"".join(packed), _ANCHOR).tolist():
        first, last = pos - ahead, pos - behind
        if kind in hot and last + length <= len(raw):  # else it is another text's anchor under an equal id
            yield first, ahead, last - first + 1, raw[first:last + length]


def _suffixes(repeats: DataFrame, length: int, lead: int) -> DataFrame:
    """One row per task and distinct segment whose lead isn't hot: lead, key, segment, offset, windows, count."""
    names = ["lead", "key", "segment", "offset", "windows", "n"]
    types = [pa.binary(), pa.binary(), pa.binary(), pa.int32(), pa.int32(), pa.int64()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows(held: dict) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*(
                (s[o:o + lead], k, s, o, w, n) for k, (s, o, w, n) in held.items())), types)], names)

        held: dict[bytes, tuple] = {}
        for batch in slices(batches, 1):
            for raw, packed in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                for _, offset, windows, segment in _segments(raw, packed, length, hot=(0,)):
                    key = _key(segment, offset)
                    held[key] = segment, offset, windows, held[key][3] + 1 if key in held else 1
                if len(held) > 60_000:
                    yield rows(held)
                    held = {}
        if held:
            yield rows(held)

    return repeats.select("tid", "text", "anchors").mapInArrow(
        run, "lead binary, key binary, segment binary, offset int, windows int, n bigint")


def _places(repeats: DataFrame, length: int) -> DataFrame:
    """(key, tid, n_bytes, first): where each segment lies."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1):
            rows = [(_key(segment, offset), tid, len(raw), first)
                    for tid, raw, packed in zip(*(c.to_pylist() for c in batch.columns))
                    for first, offset, _, segment in _segments(raw, packed, length)]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(
                    zip(*rows), (pa.binary(), pa.int64(), pa.int64(), pa.int64()))], ["key", "tid", "n_bytes", "first"])

    return repeats.select("tid", "text", "anchors").mapInArrow(run, "key binary, tid bigint, n_bytes bigint, first bigint")


def _sorted_buckets(suffixes: DataFrame, buckets: int, length: int, lead: int) -> DataFrame:
    """(key, flags): the segments with repeated windows, one bit a window."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        merged: dict[bytes, list] = {}
        for batch in batches:
            for key, segment, offset, windows, n in zip(*(batch.column(i).to_pylist() for i in range(1, 6))):
                if key in merged:
                    merged[key][3] += n
                else:
                    merged[key] = [segment, offset, windows, n]
        if not merged:
            return
        segments, offset, windows, n = zip(*merged.values())
        flags = repeated_windows(list(segments), *(np.array(x, np.int64) for x in (offset, windows, n)), length, lead)
        hit = flags.any(1)
        keys = [k for k, h in zip(merged, hit) if h]
        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(
            [row.tobytes() for row in np.packbits(flags[hit], axis=1)], pa.binary())], ["key", "flags"])

    return suffixes.repartitionByRange(buckets, "lead").mapInArrow(run, "key binary, flags binary")


def _window_blocks(repeats: DataFrame, length: int, reach: int, parts: int, most: int = 4000) -> DataFrame:
    """Windows of hot segments, counted among ``most`` segments at a time. Rows with part >= 0 hold a
    block of windows by hash range: hash, a segment's key and the window's place in it, count (1, or 2
    for more). Rows with part -1 hold keys and the flags of the windows that are repeated among these segments."""
    names, size = ["part", "h", "key", "win", "n", "flags"], -(-reach // 64) * 8

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def flush(held: dict) -> pa.RecordBatch:
            windows = np.array([w for _, _, w, _ in held.values()])
            count = np.array([n for *_, n in held.values()])
            digests = np.frombuffer(b"".join(
                hashlib.blake2b(s[i:i + length] + (o - i).to_bytes(2, "little", signed=True), digest_size=16).digest()
                for s, o, w, _ in held.values() for i in range(w)), "<u8").reshape(-1, 2)
            row = np.repeat(np.arange(len(held)), windows)
            win = np.arange(len(row)) - np.repeat(np.cumsum(windows) - windows, windows)
            order = np.lexsort((digests[:, 1], digests[:, 0]))
            digests, row, win = digests[order], row[order], win[order]
            first = np.flatnonzero(np.r_[True, (digests[1:] != digests[:-1]).any(1)])
            total = np.add.reduceat(count[row], first)
            flags = np.zeros((len(held), 8 * size), bool)
            again = np.repeat(total, np.diff(np.r_[first, len(row)])) > 1
            flags[row[again], win[again]] = True
            keys = np.frombuffer(b"".join(held), "V16")
            # one row a distinct window, in the order of its hash
            digests, key, win, n = digests[first], keys[row[first]], win[first].astype(np.uint8), np.minimum(total, 2).astype(np.uint8)
            part = ((digests[:, 0] >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)
            cuts = np.searchsorted(part, np.arange(parts + 1))
            rows = [(p, *(x[a:b].tobytes() for x in (digests, key, win, n)), None) for p, (a, b) in enumerate(zip(cuts, cuts[1:])) if b > a]
            hit = flags.any(1)
            rows.append((-1, None, keys[hit].tobytes(), None, None, np.packbits(flags[hit], axis=1).tobytes()))
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), [pa.int32()] + [pa.binary()] * 5)], names)

        held: dict[bytes, tuple] = {}
        for batch in slices(batches, 1):
            for raw, packed in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                for _, offset, windows, segment in _segments(raw, packed, length, hot=(1,)):
                    key = _key(segment, offset)
                    held[key] = segment, offset, windows, held[key][3] + 1 if key in held else 1
                    if len(held) >= most:
                        yield flush(held)
                        held = {}
        if held:
            yield flush(held)

    return repeats.select("tid", "text", "anchors").mapInArrow(
        run, "part int, h binary, key binary, win binary, n binary, flags binary")


def _hot_flags(blocks: DataFrame, reach: int) -> DataFrame:
    """(key, flags) of the hot segments with repeated windows, from their window blocks."""
    width = -(-reach // 64)
    names = ["key"] + [f"f{i}" for i in range(width)]
    schema = "key binary" + "".join(f", f{i} bigint" for i in range(width))

    def settled(rows: pd.DataFrame) -> pd.DataFrame:
        h = np.frombuffer(b"".join(rows["h"]), "<u8").reshape(-1, 2)
        key, win, n = (np.frombuffer(b"".join(rows[c]), k) for c, k in (("key", "V16"), ("win", np.uint8), ("n", np.uint8)))
        order = np.lexsort((h[:, 1], h[:, 0]))
        h, key, win, n = h[order], key[order], win[order], n[order]
        first = np.flatnonzero(np.r_[True, (h[1:] != h[:-1]).any(1)])
        total = np.repeat(np.add.reduceat(n.astype(np.int64), first), np.diff(np.r_[first, len(h)]))
        new = (total > 1) & (n == 1)  # a count of 2 is flagged in its own task
        flags: dict[bytes, list[int]] = {}
        for k, w in zip(key[new].tolist(), win[new].tolist()):
            flags.setdefault(k, [0] * width)[w // 64] |= 1 << (63 - w % 64)
        return pd.DataFrame([(k, *(f - (f >> 63 << 64) for f in v)) for k, v in flags.items()], columns=names)

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for keys, flags in zip(*(c.to_pylist() for c in batch.columns)):
                bits = np.frombuffer(flags, ">i8").reshape(-1, width).astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([keys[i:i + 16] for i in range(0, len(keys), 16)], pa.binary())]
                    + [pa.array(bits[:, i].copy(), pa.int64()) for i in range(width)], names)

    found = blocks.where("part >= 0").groupBy("part").applyInPandas(settled, schema).unionByName(
        blocks.where("part < 0").select("key", "flags").mapInArrow(local, schema))
    return (found.groupBy("key").agg(*[F.bit_or(c).alias(c) for c in names[1:]])
            .select("key", F.unhex(F.concat(*[F.lpad(F.hex(c), 16, "0") for c in names[1:]])).alias("flags")))


def remove_repeats(docs: DataFrame, length: int = 200, lead: int = 64, range_bytes: int = 16 << 20,
                   alike: int = 10_000) -> DataFrame:
    """Per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256."""
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_bytes().alias("text"))
    info = staged(rows.select("doc_id", _text_id(), F.octet_length("text").cast("bigint").alias("n_bytes"),
                              F.sha2("text", 256).alias("sha")), "info")
    texts = info.groupBy("tid", "n_bytes").agg(F.min("doc_id").alias("doc_id"), F.count("*").alias("copies"))
    size = info.agg(F.sum("n_bytes")).first()[0] or 0
    ranges = max(1, math.ceil(size / range_bytes))
    blocks = _anchor_blocks(rows.select(_text_id(), "text"), length, lead, ranges)
    kept = staged(_repeated_anchors(blocks, alike), "anchors")
    n_anchors, hot_windows = (x or 0 for x in kept.agg(F.sum("n"), F.sum("hot")).first())
    by_text = kept.groupBy("tid").agg(F.collect_list("anchors").alias("anchors"))
    # the id in the join spreads copies of one text; only the text's own row finds a partner
    wanted = texts.join(by_text, "tid").select(F.col("tid").alias("t"), F.col("doc_id").alias("d"), "n_bytes", "anchors")
    repeats = staged(rows.select("doc_id", _text_id(), "text").join(
        wanted, F.expr("tid = t AND doc_id <=> d AND octet_length(text) = n_bytes")).select("tid", "text", "anchors"), "repeats")
    buckets = max(1, math.ceil(n_anchors * (length + length // 3) / range_bytes))
    flagged = staged(_sorted_buckets(_suffixes(repeats, length, lead), buckets, length, lead), "flagged")
    if hot_windows:
        reach = length - lead + 1
        parts = math.ceil(33 * hot_windows / range_bytes)
        hot = staged(_hot_flags(staged(_window_blocks(repeats, length, reach, parts), "windows"), reach), "flagged")
        flagged = flagged.unionByName(hot)
    covered = (_places(repeats, length).join(flagged, "key").groupBy("tid", "n_bytes")
               .agg(F.collect_set(F.struct("first", "flags")).alias("windows")))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1):
            out = []
            for tid, raw, windows in zip(*(c.to_pylist() for c in batch.columns)):
                edge = np.zeros(len(raw) + 1, np.int32)
                for w in windows:
                    at = np.flatnonzero(np.unpackbits(np.frombuffer(w["flags"], np.uint8))) + w["first"]
                    np.add.at(edge, at, 1)
                    np.add.at(edge, at + length, -1)
                gone = np.cumsum(edge[:-1]) > 0
                spans = int(np.count_nonzero(gone & ~np.r_[False, gone[:-1]]))
                rest = np.frombuffer(raw, np.uint8)[~gone].tobytes()
                out.append((tid, len(raw), int(gone.sum()), spans, hashlib.sha256(rest).hexdigest()))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), [pa.int64()] * 4 + [pa.string()])],
                                                 ["tid", "n_bytes", "n_removed", "n_spans", "rest_sha"])

    found = (repeats.select("tid", "text", F.octet_length("text").cast("bigint").alias("n_bytes"))
             .join(covered, ["tid", "n_bytes"]).select("tid", "text", "windows")
             .mapInArrow(cut, "tid bigint, n_bytes bigint, n_removed bigint, n_spans bigint, rest_sha string")
             .dropDuplicates(["tid", "n_bytes"]))
    verdict = texts.select("tid", "n_bytes", "copies").join(found, ["tid", "n_bytes"], "left")
    out = info.join(verdict, ["tid", "n_bytes"], "left")
    whole = (F.col("copies") > 1) & (F.col("n_bytes") >= length)
    empty = hashlib.sha256(b"").hexdigest()
    return out.select(
        "doc_id", "n_bytes",
        F.when(whole, F.col("n_bytes")).otherwise(F.coalesce("n_removed", F.lit(0))).cast("bigint").alias("n_removed"),
        F.when(whole, F.lit(1)).otherwise(F.coalesce("n_spans", F.lit(0))).cast("bigint").alias("n_spans"),
        F.when(whole, F.lit(empty)).otherwise(F.coalesce("rest_sha", "sha")).alias("kept_sha256"))
