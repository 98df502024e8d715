"""Packing documents into token windows by Karmarkar-Karp multiway differencing.

1. Every document is tokenized where it lies; its ids (with the end id) are cut
   into whole windows and into pieces of at most ``largest_piece`` ids. Only the
   pieces' lengths and checksums travel on, never texts or ids.
2. Pieces are dealt by hash into groups of about ``group_size``; the number of
   groups grows with the pieces, so a group's size doesn't grow with the data.
3. A group is split into windows by multiway differencing: each piece starts as
   a partial partition; the two partial partitions with the largest spreads are
   merged with opposing imbalances (largest sums against smallest), until one
   is left. Its windows are near-equal. If the fullest exceeds the capacity, the
   window count rises by one and the group is split anew.

Defined results: a null text is the empty text, whose one token is the end id;
rows with equal or null ids are packed as rows of their own; an empty table
gives no rows; other columns are not read.
"""

from __future__ import annotations

import heapq
import math
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import held_by_worker, only_caches, slices, staged, text_bytes

TOKENIZER = "word_bpe_49k.json"
PIECES = "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint"
PACKED = PIECES + ", sequence_id bigint, offset bigint"


class IdTable:
    """Numbers that belong to words (their ids, say), as ``make`` gives them for a list of new words,
    in bytes, in a few flat arrays sorted by the words' 64-bit hash (mixed with their
    length): about 25 bytes a word. It starts anew once it holds ``most`` words, and when another operator's task starts."""

    def __init__(self, make, kind="<u4", most: int = 2_000_000):
        self.make, self.kind, self.most = make, np.dtype(kind), most
        self.clear()
        held_by_worker(self)

    def clear(self) -> None:
        self.keys, self.start = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.length, self.pool = np.zeros(0, np.int32), np.zeros(0, self.kind)

    def look_up(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(first place in ``pool``, how many there) of each word; new words are made."""
        if len(self.keys) > self.most:
            self.clear()
        keys = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
        keys += np.fromiter(map(len, words), np.uint64, len(words)) * np.uint64(0x9E3779B97F4A7C15)
        new = np.flatnonzero(~self._known(keys)[0])
        if len(new):
            new = new[np.unique(keys[new], return_index=True)[1]]  # each once, in ascending order
            ids = self.make([words[i] for i in new])
            length = np.fromiter(map(len, ids), np.int64, len(ids)) // self.kind.itemsize
            start = len(self.pool) + np.cumsum(length) - length
            self.pool = np.concatenate([self.pool, np.frombuffer(b"".join(ids), self.kind)])
            both = np.concatenate([self.keys, keys[new]])
            order = np.argsort(both, kind="stable")  # two sorted runs: a merge
            self.keys, self.start = both[order], np.concatenate([self.start, start])[order]
            self.length = np.concatenate([self.length, length.astype(np.int32)])[order]
        at = self._known(keys)[1]
        return self.start[at], self.length[at].astype(np.int64)

    def _known(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if not len(self.keys):
            return np.zeros(len(keys), bool), np.zeros(len(keys), np.int64)
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return self.keys[at] == keys, at


class WordIds:
    """Ids of whole texts, word by word, for a tokenizer that drops white space.

    The tokenizer splits at white space before anything else and keeps nothing of
    it, so a text's ids are those of its words side by side. Words of ASCII and
    Latin-1 letters are split further into the tokenizer's own runs (letters, one
    digit, other signs); any other word goes to the tokenizer whole.
    """

    _plain = re.compile(r"[\x21-\x7EÀ-ÖØ-öø-ÿ]+")
    # the tokenizer's own split pattern, for those characters
    _runs = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^a-z0-9ß-öø-ÿ]+")

    def __init__(self, tokenizer_file: str):
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(tokenizer_file)
        self.tokenizer.no_padding()
        self.tokenizer.no_truncation()
        self.runs = IdTable(lambda runs: [self._ids(r.decode()) for r in runs])
        self.words = IdTable(self._encode_words)

    def _ids(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _encode_words(self, raws: list[bytes]) -> list[bytes]:
        parts = []
        for raw in raws:
            word = raw.decode("utf-8", "replace")
            plain = "<|" not in word and self._plain.fullmatch(word)
            parts.append(self._runs.findall(word.lower()) if plain else None)
        start, length = self.runs.look_up([r.encode() for p in parts if p for r in p])
        places = np.repeat(start - (np.cumsum(length) - length), length)
        places += np.arange(len(places))
        flat = self.runs.pool[places].tobytes()
        ends, out, done, at = (4 * np.cumsum(length)).tolist(), [], 0, 0
        for raw, part in zip(raws, parts):
            if part is None:
                out.append(self._ids(raw.decode("utf-8", "replace")))
            elif part:
                at += len(part)
                out.append(flat[done:ends[at - 1]])
                done = ends[at - 1]
            else:
                out.append(b"")
        return out

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts one after the other, end of each text) of UTF-8 texts as a binary array.

        Arrow splits the texts and numbers their distinct words, so a word is looked up once
        a call however often it occurs; its ids are then copied to all its places.
        """
        lists = pc.ascii_split_whitespace(texts.view(pa.string()))
        words = lists.flatten().dictionary_encode()
        start, length = self.words.look_up(words.dictionary.view(pa.binary()).to_pylist())
        word = words.indices.to_numpy()
        length = length[word]
        ends = np.cumsum(length)
        places = np.repeat(start[word] - (ends - length), length)
        places += np.arange(len(places))
        flat = self.words.pool[places]
        return flat, np.r_[0, ends][lists.offsets.to_numpy()[1:] - lists.offsets[0].as_py()]


_encoders: dict[str, WordIds] = {}


def encoder(tokenizer_file: str | None = None) -> WordIds:
    if tokenizer_file is None:
        import public_tokenizers
        tokenizer_file = public_tokenizers.path(TOKENIZER)
    if tokenizer_file not in _encoders:
        _encoders[tokenizer_file] = WordIds(tokenizer_file)
    return _encoders[tokenizer_file]


def cut_points(n: int, capacity: int, largest_piece: int) -> list[int]:
    """Whole windows first, then pieces of ``largest_piece``, then the rest."""
    cuts = list(range(0, n - n % capacity, capacity))
    return cuts + list(range(n - n % capacity, n, largest_piece)) + [n]


def document_pieces(docs: DataFrame, capacity: int = 4096, largest_piece: int = 1024, end_id: int = 2,
                    tokenizer_file: str | None = None) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, end = encoder(tokenizer_file), np.array([end_id], "<u4").tobytes()
        only_caches(ids.words, ids.runs)
        for batch in slices(batches, 1, 4 << 20):
            out: list[tuple] = []
            flat, ends = ids.encode(batch.column(1))
            first = 0
            for doc_id, last in zip(batch.column(0).to_pylist(), ends.tolist()):
                part, n, first = memoryview(flat[first:last].tobytes()), last - first + 1, last
                cuts = cut_points(n, capacity, largest_piece)
                for a, b in zip(cuts, cuts[1:]):
                    crc = zlib.crc32(part[4 * a:4 * b])
                    out.append((doc_id, a, b - a, zlib.crc32(end, crc) if b == n else crc, n))
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)],
                                             ["doc_id", "start", "length", "ids_crc32", "doc_tokens"])

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_bytes().alias("text")).mapInArrow(run, PIECES)


def difference(lengths: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Karmarkar-Karp k-way differencing: (window of each item, sum of each window).

    A partial partition is its used windows' sums, largest first, and for each
    the root of a tree of items; unused windows count as sums of zero.
    """
    n = len(lengths)
    left, right = np.full(2 * n, -1, np.int64), np.full(2 * n, -1, np.int64)
    free = n
    parts = {i: (np.array([v], np.int64), np.array([i], np.int64)) for i, v in enumerate(lengths.tolist())}
    spread = lambda sums: int(sums[0] - (sums[-1] if len(sums) == k else 0))
    heap = [(-spread(s), i) for i, (s, _) in parts.items()]
    heapq.heapify(heap)
    new = n
    while len(heap) > 1:
        a_sums, a_nodes = parts.pop(heapq.heappop(heap)[1])
        b_sums, b_nodes = parts.pop(heapq.heappop(heap)[1])
        shared = max(0, len(a_sums) + len(b_sums) - k)
        if shared:
            m, o = len(a_sums) - shared, len(b_sums) - shared
            roots = np.arange(free, free + shared)
            if free + shared > len(left):
                left, right = (np.concatenate([x, np.full(max(n, shared), -1, np.int64)]) for x in (left, right))
            left[roots], right[roots] = a_nodes[m:], b_nodes[o:][::-1]
            free += shared
            sums = np.concatenate([a_sums[:m], a_sums[m:] + b_sums[o:][::-1], b_sums[:o]])
            nodes = np.concatenate([a_nodes[:m], roots, b_nodes[:o]])
        else:
            sums, nodes = np.concatenate([a_sums, b_sums]), np.concatenate([a_nodes, b_nodes])
        order = np.argsort(-sums, kind="stable")
        parts[new] = sums[order], nodes[order]
        heapq.heappush(heap, (-spread(parts[new][0]), new))
        new += 1
    sums, nodes = parts.popitem()[1]
    window = np.full(free, -1, np.int64)
    window[nodes] = np.arange(len(nodes))
    for node in range(free - 1, n - 1, -1):
        window[left[node]] = window[right[node]] = window[node]
    return window[:n], sums


def pack_group(lengths: np.ndarray, capacity: int) -> np.ndarray:
    """Window of each item; no window exceeds ``capacity``."""
    window, whole = np.empty(len(lengths), np.int64), lengths >= capacity
    n_whole = int(whole.sum())
    window[whole] = np.arange(n_whole)
    rest = lengths[~whole]
    if len(rest):
        k = math.ceil(int(rest.sum()) / capacity)
        while True:
            where, sums = difference(rest, k)
            if sums[0] <= capacity:
                break
            k += 1
        window[~whole] = n_whole + where
    return window


def pack(docs: DataFrame, capacity: int = 4096, largest_piece: int = 1024, group_size: int = 4096,
         end_id: int = 2, tokenizer_file: str | None = None) -> DataFrame:
    """Pack every document: one row per piece with its sequence_id and offset there."""
    # a number per piece, written with it, spreads rows that repeat as a whole over the groups too
    pieces = staged(document_pieces(docs, capacity, largest_piece, end_id, tokenizer_file)
                    .withColumn("piece", F.monotonically_increasing_id()), "pieces")
    groups = max(1, math.ceil(pieces.count() / group_size))

    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["length", "doc_id", "start", "ids_crc32"], ascending=[False, True, True, True],
                                kind="stable", ignore_index=True)
        rows["sequence_id"] = pack_group(rows["length"].to_numpy(np.int64), capacity)
        rows["offset"] = rows.groupby("sequence_id")["length"].cumsum() - rows["length"]
        rows["sequence_id"] += int(key[0]) << 32
        return rows[["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]].astype(
            {"doc_id": "Int64"})

    group = F.pmod(F.xxhash64("doc_id", "start", "ids_crc32", "piece"), F.lit(groups))
    return pieces.withColumn("g", group).drop("piece").groupBy("g").applyInPandas(run, PACKED)
