"""Toxicity classifier with counterfactual regularisation.

A document's score is a logistic function of the sum, over its distinct words,
of the weights (0 or more) of each word's character n-grams. It is fitted on labelled
documents with an L1 penalty (few n-grams keep a weight, so very long clean
texts don't add up noise) and a counterfactual penalty: in each training
document one identity term (of four languages) is swapped for another of its group, or, when it names none, one is
inserted; the squared change of the score is added to the loss. A neutral
mention of a group therefore can't move a score by much (``group_gaps`` measures it). Words are runs without ASCII white
space, ASCII punctuation or control characters; a word counts whole, however long it is.

Only text is an input. Rows with crc32(doc_id as text) mod ``modulus`` equal to
``held`` give no labels. At most ``most_positive`` and ``most_negative`` labelled
rows, in the order of md5(doc_id), are used (documented bound; every document is
scored).

Defined results: a null text is the empty text and gets the score of no words;
labels that are null or not 0/1 are left out, of several labels of a document
the highest counts; with labels of only one kind, or none, every score is the share of
ones (0 if there are none); null ids carry no label; equal ids stay separate rows.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import WordCache, doc_remainder, only_caches, slices, staged, text_bytes

# Groups of identity terms that may be swapped for each other, by language.
IDENTITY_TERMS = {
    "en": (
        ("women", "men", "girls", "boys", "mothers", "fathers"),
        ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist"),
        ("black", "white", "asian", "latino", "arab", "african", "european"),
        ("gay", "lesbian", "straight", "bisexual", "transgender", "queer"),
        ("immigrant", "refugee", "foreigner", "citizen", "tourist"),
        ("disabled", "deaf", "blind", "elderly", "young"),
    ),
    "de": (
        ("frauen", "männer", "mädchen", "jungen", "mütter", "väter"),
        ("muslime", "christen", "juden", "hindus", "buddhisten", "atheisten"),
        ("schwarze", "weiße", "asiaten", "araber", "afrikaner", "europäer"),
        ("schwule", "lesben", "heterosexuelle", "bisexuelle"),
        ("einwanderer", "flüchtlinge", "ausländer", "bürger", "touristen"),
        ("behinderte", "gehörlose", "blinde", "ältere", "junge"),
    ),
    "fr": (
        ("femmes", "hommes", "filles", "garçons", "mères", "pères"),
        ("musulmans", "chrétiens", "juifs", "hindous", "bouddhistes", "athées"),
        ("noirs", "blancs", "asiatiques", "arabes", "africains", "européens"),
        ("gays", "lesbiennes", "hétérosexuels", "bisexuels"),
        ("immigrés", "réfugiés", "étrangers", "citoyens", "touristes"),
        ("handicapés", "sourds", "aveugles", "âgés", "jeunes"),
    ),
    "es": (
        ("mujeres", "hombres", "niñas", "niños", "madres", "padres"),
        ("musulmanes", "cristianos", "judíos", "hindúes", "budistas", "ateos"),
        ("negros", "blancos", "asiáticos", "árabes", "africanos", "europeos"),
        ("homosexuales", "lesbianas", "heterosexuales", "bisexuales"),
        ("inmigrantes", "refugiados", "extranjeros", "ciudadanos", "turistas"),
        ("discapacitados", "sordos", "ciegos", "ancianos", "jóvenes"),
    ),
}
IDENTITY_GROUPS = tuple(group for groups in IDENTITY_TERMS.values() for group in groups)

# Letters in lower case, digits as one sign, ASCII punctuation as space.
_FOLD = bytes(c + 32 if 65 <= c <= 90 else 48 if 48 <= c <= 57 else c if 97 <= c <= 122 or c >= 128 else 32
              for c in range(256))
BUCKETS = 1 << 22
CUT = 0.3
_LONG = 64  # longer words are hashed as arrays
_CHUNK = 1 << 18
_CRC = np.arange(256, dtype=np.uint32)
for _ in range(8):
    _CRC = np.where(_CRC & 1, _CRC >> 1 ^ 0xEDB88320, _CRC >> 1).astype(np.uint32)


def words_of(raw: bytes) -> list[bytes]:
    return raw.translate(_FOLD).split()


def grams(word: bytes) -> set[int]:
    """Hashed character n-grams (3 to 5 bytes) of one whole word, its ends marked."""
    marked = b"<" + word + b">"
    return {zlib.crc32(marked[i:i + n]) % BUCKETS for n in (3, 4, 5) for i in range(len(marked) - n + 1)}


def long_grams(word: bytes) -> np.ndarray:
    """What ``grams`` gives, ascending, for a word of any length: text without ASCII white space is
    one word. Cut into chunks that overlap by four bytes, so that memory stays bounded."""
    marked = np.frombuffer(b"<" + word + b">", np.uint8)
    found = np.zeros(0, np.int64)
    for start in range(0, len(marked), _CHUNK):
        part, hashed = marked[start:start + _CHUNK + 4], []
        for n in (3, 4, 5):
            if len(part) >= n:
                crc = np.full(len(part) - n + 1, 0xFFFFFFFF, np.uint32)
                for j in range(n):
                    crc = _CRC[(crc ^ part[j:j + len(crc)]) & np.uint32(255)] ^ (crc >> np.uint32(8))
                hashed.append((~crc).astype(np.int64) % BUCKETS)
        found = np.unique(np.concatenate([found, *hashed]))
    return found


def features(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(n-gram, number of distinct words holding it), ascending."""
    found: list[int] = []
    long = []
    for word in set(words_of(raw)):
        if len(word) <= _LONG:
            found.extend(grams(word))
        else:
            long.append(long_grams(word))
    return np.unique(np.concatenate([np.array(found, np.int64), *long]), return_counts=True)


class Model:
    """Weights by n-gram; ``score`` keeps each word's sum once it is known."""

    def __init__(self, weights: dict[int, float], intercept: float):
        self.weights, self.intercept, self.known = weights, intercept, None
        self.names = np.array(sorted(weights), np.int64)

    def _word(self, word: bytes) -> float:
        get = self.weights.get
        if len(word) > _LONG:
            return sum(get(g, 0.0) for g in np.intersect1d(long_grams(word), self.names, assume_unique=True).tolist())
        return sum(get(g, 0.0) for g in sorted(grams(word)))

    def score(self, raw: bytes) -> float:
        if self.known is None:
            self.known = WordCache(self._word, 300_000)
        # fsum: the order of a set must not matter
        z = self.intercept + math.fsum(map(self.known.__getitem__, set(words_of(raw))))
        self.known.trim()
        return 1 / (1 + math.exp(-max(-40.0, min(40.0, z))))

    def __getstate__(self):
        return {"weights": self.weights, "intercept": self.intercept, "known": None, "names": self.names}


def labelled_sample(docs: DataFrame, labels: DataFrame, modulus: int, held: int, most_positive: int,
                    most_negative: int, most_features: int = 6000) -> tuple[list, float]:
    """Features of the training documents, and the share of ones among all training labels."""
    known = (labels.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull())
             .groupBy(F.col("doc_id").cast("bigint").alias("doc_id")).agg(F.max("toxic").alias("y"))
             .where(doc_remainder(modulus) != held))
    counts = {r.y: r.n for r in known.groupBy("y").agg(F.count("*").alias("n")).collect()}
    order = F.md5(F.col("doc_id").cast("string").cast("binary"))
    drawn = [known.where(F.col("y") == y).orderBy(order, "doc_id").limit(n)
             for y, n in ((1, most_positive), (0, most_negative))]
    # bounded by the two limits
    chosen = F.broadcast(drawn[0].unionByName(drawn[1]))

    source = docs.where(F.col("doc_id").isNotNull()).select(
        F.col("doc_id").cast("bigint").alias("doc_id"), text_bytes().alias("text"))
    texts = staged(source.join(chosen, "doc_id").select("doc_id", "text", F.col("y").cast("bigint").alias("y")), "labelled")
    features_kept = choose_features(texts, most_features)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        only_caches()
        groups = [{t.encode() for t in g} for g in IDENTITY_GROUPS]
        for batch in slices(batches, 1):
            rows = []
            for doc_id, raw, y in zip(*(c.to_pylist() for c in batch.columns)):
                g, n = features(raw)
                kept = np.isin(g, features_kept)
                named = sorted(set(words_of(raw)) & set().union(*groups))
                rows.append((doc_id, y, g[kept].astype(np.int32).tobytes(), n[kept].astype(np.int32).tobytes(),
                             named[0].decode() if named else ""))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*rows), (pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.string()))],
                ["doc_id", "y", "g", "n", "named"])

    rows = texts.mapInArrow(run, "doc_id bigint, y bigint, g binary, n binary, named string").collect()
    total = sum(counts.values())
    return sorted(rows, key=lambda r: (r.doc_id, r.y, r.g)), counts.get(1, 0) / total if total else 0.0


def choose_features(texts: DataFrame, most: int) -> np.ndarray:
    """The ``most`` n-grams whose shares of toxic and of clean documents differ most (z value),
    of those in 5 or more of the labelled documents; counted in Spark."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        only_caches()
        for batch in slices(batches, 1, 2 << 20):
            held = {0: [np.zeros(0, np.int64)], 1: [np.zeros(0, np.int64)]}
            for raw, y in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                held[y].append(features(raw)[0])
            for y, found in held.items():
                g, n = np.unique(np.concatenate(found), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(g), pa.array(np.full(len(g), y)), pa.array(n)], ["g", "y", "n"])

    sizes = {r.y: r["count"] for r in texts.groupBy("y").count().collect()}
    n1, n0 = max(1, sizes.get(1, 0)), max(1, sizes.get(0, 0))
    counts = (texts.mapInArrow(run, "g bigint, y bigint, n bigint").groupBy("g")
              .agg(F.sum(F.when(F.col("y") == 1, F.col("n")).otherwise(0)).alias("d1"), F.sum("n").alias("d"))
              .where("d >= 5"))
    pooled = (F.col("d") + 1) / (n1 + n0 + 2)
    z = F.abs(F.col("d1") / n1 - (F.col("d") - F.col("d1")) / n0) / F.sqrt(pooled * (1 - pooled) * (1 / n1 + 1 / n0))
    return np.sort(np.array([r.g for r in counts.orderBy(z.desc(), "g").limit(most).select("g").collect()], np.int64))


def fit(rows: list, share: float, swap_penalty: float = 2.0, l1: float = 2e-4, steps: int = 200,
        rate: float = 0.05) -> Model:
    """Proximal Adam on logistic loss + swap penalty + L1, weights at or above 0."""
    y = np.array([r.y for r in rows], float)
    if not len(y) or y.min() == y.max():
        share = share if len(y) else 0.0
        return Model({}, math.log((share + 1e-9) / (1 - share + 1e-9)))
    idx = np.concatenate([np.frombuffer(r.g, np.int32) for r in rows])
    val = np.concatenate([np.frombuffer(r.n, np.int32) for r in rows]).astype(float)
    row = np.repeat(np.arange(len(rows)), [len(r.g) // 4 for r in rows])
    kept, col = np.unique(idx, return_inverse=True)
    val = np.minimum(val, 50.0)
    n1, n0, m = y.sum(), (1 - y).sum(), len(kept)
    names = {int(g): i for i, g in enumerate(kept)}

    # one counterfactual a document: change of the feature vector
    swap = np.zeros((len(IDENTITY_GROUPS), max(map(len, IDENTITY_GROUPS)), m), np.float32)
    for a, group in enumerate(IDENTITY_GROUPS):
        for b, term in enumerate(group):
            for g in grams(term.encode()):
                if g in names:
                    swap[a, b, names[g]] = 1
    pick = [zlib.crc32(f"{r.doc_id}:swap".encode()) for r in rows]
    changes: dict[tuple, int] = {}
    for r, h in zip(rows, pick):
        a = next((i for i, g in enumerate(IDENTITY_GROUPS) if r.named in g), h % len(IDENTITY_GROUPS))
        group = IDENTITY_GROUPS[a]
        to = h // 7 % len(group)
        frm = group.index(r.named) if r.named in group else -1
        if frm != to:
            changes[a, frm, to] = changes.get((a, frm, to), 0) + 1
    diff = np.array([swap[a, t] - (swap[a, f] if f >= 0 else 0) for a, f, t in changes]).reshape(-1, m)
    often = np.array(list(changes.values()), float) / len(rows)

    weight = np.where(y == 1, 0.5 / n1, 0.5 / n0)  # both classes weigh the same
    scale = np.sqrt(np.bincount(col, weights=val * val * weight[row], minlength=m)) + 0.05
    val = val / scale[col]
    diff = diff / scale
    w, b = np.zeros(m), 0.0
    mw, vw, mb, vb = np.zeros(m), np.zeros(m), 0.0, 0.0
    for t in range(1, steps + 1):
        f = np.bincount(row, weights=val * w[col], minlength=len(rows)) + b
        r = (1 / (1 + np.exp(-np.clip(f, -40, 40))) - y) * weight
        g = np.bincount(col, weights=val * r[row], minlength=m) + 2 * swap_penalty * diff.T @ (often * (diff @ w))
        gb = r.sum()
        mw, vw = 0.9 * mw + 0.1 * g, 0.99 * vw + 0.01 * g * g
        mb, vb = 0.9 * mb + 0.1 * gb, 0.99 * vb + 0.01 * gb * gb
        step = rate * (1 - t / (steps + 1))
        per = step / (np.sqrt(vw / (1 - 0.99 ** t)) + 1e-4)
        w = w - per * mw / (1 - 0.9 ** t)
        w = np.maximum(w - per * l1, 0)  # evidence only adds up: long clean stretches can't outweigh a slur
        b -= step * (mb / (1 - 0.9 ** t)) / (math.sqrt(vb / (1 - 0.99 ** t)) + 1e-4)
    odds = (share + 1e-9) / (1 - share + 1e-9)  # from balanced classes back to all labels
    return Model({g: float(w[i] / scale[i]) for g, i in names.items() if abs(w[i]) > 1e-9}, b + math.log(odds))


def group_gaps(model: Model, texts: list[bytes]) -> dict[str, tuple[float, float]]:
    """By language: the largest change of a text's score when one of its groups' terms is put in for
    another, averaged over texts and groups, and the share of mentions that get a clean text rejected."""
    out = {}
    for lang, groups in IDENTITY_TERMS.items():
        gaps, rejected = [], []
        for text in texts:
            if model.score(text) >= CUT:
                continue
            for group in groups:
                scores = [model.score(text + b" " + term.encode()) for term in group]
                gaps.append(max(scores) - min(scores))
                rejected.append(sum(s >= CUT for s in scores) / len(scores))
        out[lang] = (float(np.mean(gaps or [0.0])), float(np.mean(rejected or [0.0])))
    return out


def train(docs: DataFrame, labels: DataFrame, modulus: int = 4, held: int = 2, most_positive: int = 2500,
          most_negative: int = 4000) -> Model:
    rows, share = labelled_sample(docs, labels, modulus, held, most_positive, most_negative)
    return fit(rows, share)


def _scores(model: Model, texts: pa.Array) -> list[float]:
    return [model.score(raw) for raw in texts.to_pylist()]


def score(docs: DataFrame, model: Model, modulus: int = 4, held: int = 2, cut: float = CUT) -> DataFrame:
    """Per document: doc_id, held_out, score, predicted."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        only_caches()
        for batch in slices(batches, 2):
            values = _scores(model, batch.column(2))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(values, pa.float64()),
                 pa.array([int(v >= cut) for v in values], pa.int32())], ["doc_id", "held_out", "score", "predicted"])

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"),
                       (doc_remainder(modulus) == held).alias("held_out"), text_bytes().alias("text"))
    return rows.mapInArrow(run, "doc_id bigint, held_out boolean, score double, predicted int")


def keep_clean(docs: DataFrame, model: Model, cut: float = CUT) -> DataFrame:
    """Rows of ``docs``, all columns, whose text scores under ``cut``."""
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        only_caches()
        for batch in slices(batches, at):
            texts = pa.array([(t or "").encode("utf-8", "replace") for t in batch.column(at).to_pylist()], pa.binary())
            yield batch.filter(pa.array([v < cut for v in _scores(model, texts)], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
