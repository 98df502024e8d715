"""Language-model scoring with an interpolated modified Kneser-Ney bigram model.

Counting is a Spark job over all training texts. A task hashes words to 64 bits,
counts its bigrams and sends each context range one sorted block (8 bytes a
distinct bigram instead of a row each). A second shuffle does the same for the
words' continuation counts. Every range is written as sorted hash arrays to a
folder under ``spark.checkpoint.dir``; scoring tasks map them into memory, so a
worker holds no copy of the model, and the number of ranges grows with the
corpus, so no task's share does. Only sums (counts of counts, tokens, types)
reach the driver.

P(w | u) = max(c(uw) - D, 0) / c(u) + g(u) * P(w); P(w) = max(k(w) - d, 0) / K +
g0 / (V + 1), with k(w) the number of distinct words before w, K their sum, V the
training types, three discounts at either level (for counts of 1, 2, 3 and more) and
g the mass they free. All unknown words share one place beside the V types, so
probabilities of a context sum to 1.

Defined results: words are runs without ASCII white space, A-Z in lower case, then one
end token; a null text is the empty text (the end alone). A null doc_id counts as the
empty text when the remainder is taken. Without training rows every probability is 1.
Equal ids stay separate rows; other columns are not read.
"""

from __future__ import annotations

import math
import os
import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import WordCache, doc_remainder, shared_folder, slices, staged, text_bytes

# No word holds white space, so these two can't be words.
END = np.uint64(xxhash.xxh3_64_intdigest(b"\nend"))
BEGIN = np.uint64(xxhash.xxh3_64_intdigest(b"\nbegin"))
_hashes = WordCache(xxhash.xxh3_64_intdigest, 600_000)
_FLUSH = 3_000_000  # tokens counted at once in a task


def token_hashes(raw: bytes) -> np.ndarray:
    words = raw.lower().split()
    out = np.empty(len(words) + 1, np.uint64)
    out[:-1] = np.fromiter(map(_hashes.__getitem__, words), np.uint64, len(words))
    out[-1] = END
    _hashes.trim()
    return out


def pair_keys(before: np.ndarray, word: np.ndarray) -> np.ndarray:
    key = (before ^ (before >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15) + word
    key ^= key >> np.uint64(29)
    return key * np.uint64(0xBF58476D1CE4E5B9)


def range_of(h: np.ndarray, ranges: int) -> np.ndarray:
    """Equal ranges of the hash, so hot words are one key among many."""
    return ((h >> np.uint64(32)) * np.uint64(ranges) >> np.uint64(32)).astype(np.int64)


def contexts_of(tokens: np.ndarray, starts: np.ndarray) -> np.ndarray:
    before = np.empty_like(tokens)
    before[1:] = tokens[:-1]
    before[starts] = BEGIN
    return before


def _count_block(docs: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (context, word, count) of some documents, by context."""
    tokens = np.concatenate(docs)
    starts = np.cumsum([0] + [len(d) for d in docs[:-1]])
    before = contexts_of(tokens, starts)
    _, first, count = np.unique(pair_keys(before, tokens), return_index=True, return_counts=True)
    order = np.argsort(before[first], kind="stable")
    first = first[order]
    return before[first], tokens[first], count[order].astype(np.uint32)


def _pack(*arrays: np.ndarray) -> bytes:
    return b"".join([np.array([len(a) for a in arrays], np.int64).tobytes()] + [a.tobytes() for a in arrays])


def _unpack(blob: bytes, *types) -> list[np.ndarray]:
    at, out = 8 * len(types), []
    for n, kind in zip(np.frombuffer(blob, np.int64, len(types)), types):
        out.append(np.frombuffer(blob, kind, n, at))
        at += out[-1].nbytes
    return out


def _write(folder: str, name: str, array: np.ndarray) -> None:
    """Whole or not at all: a repeated task replaces the file by an equal one."""
    path = f"{folder}/{name}.npy"
    with open(temporary := f"{path}.{uuid.uuid4().hex}", "wb") as f:
        np.save(f, array)
    os.replace(temporary, path)


def _sums(keys: np.ndarray, *values: np.ndarray) -> tuple[np.ndarray, ...]:
    """Distinct keys, ascending, and the sums of their values."""
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    starts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.zeros(0, np.int64)
    return (keys[starts], *(np.add.reduceat(v[order].astype(np.int64), starts) if len(starts) else v for v in values), order, starts)


def _blocks(docs: DataFrame, ranges: int) -> DataFrame:
    """(part, block): each task's bigrams, a block for each context range."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def flush(held: list[np.ndarray]) -> pa.RecordBatch:
            before, word, count = _count_block(held)
            part = range_of(before, ranges)  # ascending, as contexts are
            cuts = np.searchsorted(part, np.arange(ranges + 1))
            parts, blobs = [], []
            for p, (a, b) in enumerate(zip(cuts, cuts[1:])):
                if b > a:
                    context, n = np.unique(before[a:b], return_counts=True)
                    parts.append(p)
                    blobs.append(_pack(context, n.astype(np.uint32), word[a:b], count[a:b]))
            return pa.RecordBatch.from_arrays([pa.array(parts, pa.int32()), pa.array(blobs, pa.binary())], ["part", "block"])

        held, n = [], 0
        for batch in slices(batches, 0):
            for raw in batch.column(0).to_pylist():
                held.append(token_hashes(raw))
                n += len(held[-1])
                if n >= _FLUSH:
                    yield flush(held)
                    held, n = [], 0
        if held:
            yield flush(held)

    return docs.select(text_bytes().alias("text")).mapInArrow(run, "part int, block binary")


def _spectrum(counts: np.ndarray) -> list[int]:
    """Numbers of counts that are 1, 2, 3, 4, and 3 or more."""
    return [int((counts == i).sum()) for i in (1, 2, 3, 4)] + [int((counts >= 3).sum())]


def discounts(n1: int, n2: int, n3: int, n4: int) -> tuple[float, float, float]:
    """Modified Kneser-Ney discounts; half the count where counts of counts give none."""
    if min(n1, n2, n3, n4) > 0:
        y = n1 / (n1 + 2 * n2)
        d = (1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3)
        if all(0 < x < i + 1 for i, x in enumerate(d)):
            return d
    return 0.5, 1.0, 1.5


class Model:
    """Where the arrays lie, and the sums that the formulas need."""

    def __init__(self, folder: str, ranges: int, stats: dict):
        self.folder, self.ranges = folder, ranges
        self.types, self.tokens, self.continuations = stats["types"], stats["tokens"], stats["continuations"]
        self.pair_discounts = np.array((0.0, *discounts(*stats["pairs"][:4])))
        self.word_discounts = np.array((0.0, *discounts(*stats["words"][:4])))
        freed = float(np.dot(self.word_discounts[1:], (stats["words"][0], stats["words"][1], stats["words"][4])))
        self.free = freed / self.continuations if self.continuations else 1.0

    def probabilities(self, tokens: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(P(token | token before), training count of each token)."""
        before = contexts_of(tokens, starts)
        types, place = np.unique(tokens, return_inverse=True)
        count, kinds = (x[place] for x in self._look_up("words", types, types, ("count", "kinds")))
        level = self.word_discounts[np.minimum(kinds, 3)]
        p = (np.maximum(kinds - level, 0) / self.continuations if self.continuations else 0.0) + self.free / (self.types + 1)
        contexts, place = np.unique(before, return_inverse=True)
        total, *followers = (x[place] for x in self._look_up("contexts", contexts, contexts, ("total", "once", "twice", "more")))
        pairs = self._look_up("pairs", pair_keys(before, tokens), before, ("count",))[0]
        seen = total > 0
        higher = np.maximum(pairs - self.pair_discounts[np.minimum(pairs, 3).astype(np.int64)], 0)
        mass = sum(d * f for d, f in zip(self.pair_discounts[1:], followers))
        return np.where(seen, (higher + mass * p) / np.where(seen, total, 1), p), count

    def _look_up(self, table: str, keys: np.ndarray, owners: np.ndarray, columns: tuple[str, ...]) -> list[np.ndarray]:
        out = [np.zeros(len(keys), np.int64) for _ in columns]
        part = range_of(owners, self.ranges)
        order = np.lexsort((keys, part))
        cuts = np.searchsorted(part[order], np.arange(self.ranges + 1))
        for p, (a, b) in enumerate(zip(cuts, cuts[1:])):
            if b > a and (known := _mapped(self.folder, f"{table}-{p:06d}-key")) is not None and len(known):
                rows = order[a:b]  # ascending keys: the search walks the mapped pages in order
                at = np.minimum(np.searchsorted(known, keys[rows]), len(known) - 1)
                hit = known[at] == keys[rows]
                for values, column in zip(out, columns):
                    values[rows[hit]] = _mapped(self.folder, f"{table}-{p:06d}-{column}")[at[hit]]
        return out


_maps: dict[str, dict[str, np.ndarray | None]] = {}


def _mapped(folder: str, name: str) -> np.ndarray | None:
    """The worker's memory map of one array; those of another model are let go."""
    if folder not in _maps:
        _maps.clear()
        _maps[folder] = {}
    maps = _maps[folder]
    if name not in maps:
        path = f"{folder}/{name}.npy"
        maps[name] = np.load(path, mmap_mode="r") if os.path.exists(path) else None
    return maps[name]


def train(docs: DataFrame, range_bytes: int = 32 << 20) -> Model:
    """Count all of ``docs`` and write the model's arrays."""
    spark = docs.sparkSession
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    ranges = max(1, math.ceil(size / range_bytes))
    folder = shared_folder(spark, "kneser-ney")

    def pairs(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        blocks = [_unpack(b, np.uint64, np.uint32, np.uint64, np.uint32) for b in rows["block"]]
        before = np.concatenate([np.repeat(b[0], b[1]) for b in blocks])
        word = np.concatenate([b[2] for b in blocks])
        count = np.concatenate([b[3] for b in blocks])
        del blocks, rows
        keys, count, order, starts = _sums(pair_keys(before, word), count)
        before, word = before[order][starts], word[order][starts]
        name = f"{int(key[0]):06d}"
        _write(folder, f"pairs-{name}-key", keys)
        _write(folder, f"pairs-{name}-count", count.astype(np.uint32))
        one, two, more = ((count == 1), (count == 2), (count >= 3))
        contexts, total, n1, n2, n3, _, _ = _sums(before, count, one, two, more)
        _write(folder, f"contexts-{name}-key", contexts)
        _write(folder, f"contexts-{name}-total", total)
        for column, values in (("once", n1), ("twice", n2), ("more", n3)):
            _write(folder, f"contexts-{name}-{column}", values)
        words, kinds, tokens, _, _ = _sums(word, np.ones(len(word), np.uint8), count)
        part = range_of(words, ranges)
        cuts = np.searchsorted(part, np.arange(ranges + 1))
        out = [(p, _pack(words[a:b], kinds[a:b].astype(np.uint32), tokens[a:b]), None)
               for p, (a, b) in enumerate(zip(cuts, cuts[1:])) if b > a]
        out.append((-1, None, _spectrum(count)))
        return pd.DataFrame(out, columns=["part", "block", "stats"])

    def words(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        blocks = [_unpack(b, np.uint64, np.uint32, np.int64) for b in rows["block"]]
        keys, kinds, tokens, _, _ = _sums(*(np.concatenate([b[i] for b in blocks]) for i in range(3)))
        name = f"{int(key[0]):06d}"
        _write(folder, f"words-{name}-key", keys)
        _write(folder, f"words-{name}-kinds", kinds)
        _write(folder, f"words-{name}-count", tokens)
        return pd.DataFrame([(len(keys), int(tokens.sum()), int(kinds.sum()), _spectrum(kinds))],
                            columns=["types", "tokens", "continuations", "stats"])

    counted = staged(_blocks(docs, ranges).groupBy("part").applyInPandas(pairs, "part int, block binary, stats array<bigint>"), "pairs")
    merged = staged(counted.where("part >= 0").groupBy("part").applyInPandas(
        words, "types bigint, tokens bigint, continuations bigint, stats array<bigint>"), "words")

    def total(df: DataFrame) -> list[int]:
        return [x or 0 for x in df.agg(*[F.sum(F.col("stats")[i]) for i in range(5)]).first()]

    sums = merged.agg(F.sum("types"), F.sum("tokens"), F.sum("continuations")).first()
    stats = dict(zip(("types", "tokens", "continuations"), (x or 0 for x in sums)))
    return Model(folder, ranges, {**stats, "pairs": total(counted.where("part < 0")), "words": total(merged)})


def score(docs: DataFrame, model: Model, modulus: int = 7, held: int = 2) -> DataFrame:
    """Per document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, perplexity."""
    schema = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()),
                        ("train_tokens", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64()),
                        ("perplexity", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 2, 4 << 20):
            docs = [token_hashes(raw) for raw in batch.column(2).to_pylist()]
            n = np.array([len(d) for d in docs], np.int64)
            starts = np.cumsum(n) - n
            p, count = model.probabilities(np.concatenate(docs), starts)
            base = np.log10((count + 1) / (model.tokens + (model.types + 1)))
            scores = np.add.reduceat(np.log10(p), starts)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(n), pa.array(np.add.reduceat((count > 0).astype(np.int64), starts)),
                 pa.array(np.full(len(n), model.tokens, np.int64)), pa.array(np.add.reduceat(base, starts)), pa.array(scores),
                 pa.array(10 ** np.minimum(-scores / n, 300.0))], schema=schema)

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), (doc_remainder(modulus) == held).alias("held_out"),
                       text_bytes().alias("text"))
    return rows.mapInArrow(run, "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, "
                                "base_score double, score double, perplexity double")


def train_and_score(docs: DataFrame, modulus: int = 7, held: int = 2) -> DataFrame:
    """Learn from the rows that are not held out, score all."""
    return score(docs, train(docs.where(doc_remainder(modulus) != held)), modulus, held)
