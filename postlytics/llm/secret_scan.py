"""Secret scans: fixed patterns plus a character convolutional network.

1. One scan of every whole text finds the fixed patterns' spans and all further
   candidates: every run of 16 or more token characters, and of a run that a pattern span
   touches the rests of 8 or more beside it. Each keeps
   its span, its characters and ``CONTEXT`` characters on both sides; the result
   (one narrow row per document) is written to the shared folder.
2. The network learns from every labelled finding of every document: pattern spans are positive, all
   other candidates are negative. Equal windows become one row with its count (``counted``); rows are dealt by hash into
   shares of about ``SHARE``, so a share doesn't grow with the data. Each share goes on from the same weights over its own
   rows, drawn as often as their counts ask; the shares' weights are averaged, ``ROUNDS`` times over, and over
   the rounds every row has been used. What it must find beyond the patterns
   are secrets without keyword and prefix, so every finding is shown masked as well: cut shorter, without
   context, and redrawn in each of ``ALPHABETS`` amid the text around a negative. Negatives are shown
   cut shorter and as words of their context glued together (paths, identifiers), so the
   network learns what the characters look like and not a length or the keyword before them.
3. A held-back third of the findings and negatives, masked alike, calibrates the network's logit (Platt
   scaling) and gives one threshold per character class (``CLASSES``): ``min_probability``, or more
   where over one in a thousand of all negatives would pass, but never so high that it
   recalls less than ``min_recall`` of the held-back positives of that class. Spark counts the logits of all these
   rows in steps of 1/``STEPS``, so what reaches the driver is bounded by the range of logits. ``measured`` keeps the
   recall and the share of negatives that pass, by class.
4. Every candidate is scored; those at or over their threshold that overlap no
   pattern span are added as spans of kind ``net``. Pattern spans always stay.

Positions are code points, ends exclusive. Defined results: a null text is the
empty text (no spans, the checksum of nothing); equal or null ids stay separate
rows; with no positives or no negatives in all documents nothing is added; other
columns are not read.
"""

from __future__ import annotations

import copy
import hashlib
import math
import random
import re
import string
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import only_caches, slices, staged, text_bytes

KINDS = ("assign", "access", "hex", "net")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                    re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")  # maximal runs, so the same as [0-9a-f]+ of 32 or more
CANDIDATE = re.compile(r"[A-Za-z0-9+/_.=-]{16,}")
CONTEXT = 24
BODY = 64  # a longer candidate is read in pieces of this length
REST = 8   # what is left of a run beside a pattern span
SHARE = 20_000  # different windows that one task learns from
ROUNDS = 5  # of averaging, where there are several shares
DRAWS = 1000  # batches that a share draws over all rounds, besides those of rows that no draw took
STEPS = 1000  # a logit of 1 has so many when logits are counted

# Alphabets that findings are redrawn in, with the shortest length: a bare number below 20 digits is no secret.
ALPHABETS = (("0123456789abcdef", 16), ("0123456789ABCDEF", 16), (string.digits + string.ascii_letters, 16),
             (string.digits + string.ascii_letters + "+/", 16), (string.ascii_lowercase + string.digits, 16),
             (string.ascii_letters, 16), (string.digits, 20))
CLASSES = ("hex", "digits", "upper hex", "no digit", "mixed")

SCANNED = ("doc_id bigint, n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string, base_spans string, "
           "starts array<int>, ends array<int>, labels array<boolean>, windows array<string>")


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the fixed patterns, by start and then by kind as listed."""
    out = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 8]
    out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 16]
    out += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(out)


def joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


def candidates(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, bool]]:
    """(start, end, is a finding) of every candidate: pattern spans (without the
    keyword, whose characters are context), other runs, and the rests of runs beside pattern spans."""
    out, covered = [], []
    for a, kind, b in base:
        covered.append((a, b))
        if kind == 0:
            a = b - len(ASSIGN.match(text, a).group(2))
        out.append((a, b, True))
    i = 0
    covered.sort()
    for m in CANDIDATE.finditer(text):
        while i < len(covered) and covered[i][1] <= m.start():
            i += 1
        at, j = m.start(), i
        while j < len(covered) and covered[j][0] < m.end():
            if covered[j][0] - at >= REST:
                out.append((at, covered[j][0], False))
            at, j = max(at, covered[j][1]), j + 1
        if m.end() - at >= (REST if j > i else 1):
            out.append((at, m.end(), False))
    return out


def window(text: str, a: int, b: int) -> str:
    """Left context, candidate and right context, NUL between them and nowhere else."""
    return "\0".join((text[max(0, a - CONTEXT):a].replace("\0", " "), text[a:b], text[b:b + CONTEXT].replace("\0", " ")))


def scan(docs: DataFrame) -> DataFrame:
    """One row per document: pattern counts and spans, and all candidates with their context."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        only_caches()
        schema = pa.schema([("doc_id", pa.int64()), ("n_assign", pa.int64()), ("n_access", pa.int64()),
                            ("n_hex", pa.int64()), ("base_sha256", pa.string()), ("base_spans", pa.string()),
                            ("starts", pa.list_(pa.int32())), ("ends", pa.list_(pa.int32())),
                            ("labels", pa.list_(pa.bool_())), ("windows", pa.list_(pa.string()))])
        for batch in slices(batches, 1):
            rows = []
            for doc_id, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                text = raw.decode("utf-8", "replace")
                base = base_spans(text)
                kinds = [k for _, k, _ in base]
                named, found = joined(base), candidates(text, base)
                rows.append((doc_id, kinds.count(0), kinds.count(1), kinds.count(2),
                             hashlib.sha256(named.encode()).hexdigest(), named,
                             [a for a, _, _ in found], [b for _, b, _ in found], [y for _, _, y in found],
                             [window(text, a, b) for a, b, _ in found]))
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_bytes().alias("text")).mapInArrow(run, SCANNED)


def _classes(body: str) -> int:
    """Place in ``CLASSES``; each has a threshold of its own."""
    if not re.search(r"[^0-9.]", body):
        return 1
    if not re.search(r"[0-9]", body):
        return 3
    return 0 if not re.search(r"[^0-9a-f]", body) else 2 if not re.search(r"[^0-9A-F]", body) else 4


def encode_windows(windows: list[str]) -> np.ndarray:
    """Windows as rows of small codes: left context, candidate, right context, right- or
    left-padded so that the candidate always starts at the same place."""
    width = CONTEXT + BODY + CONTEXT
    out = np.zeros((len(windows), width), np.uint8)
    for i, row in enumerate(windows):
        left, body, right = row.split("\0")
        for text, at in ((left, CONTEXT - len(left)), (body[:BODY], CONTEXT), (right, CONTEXT + BODY)):
            codes = np.frombuffer(text.encode("latin-1", "replace"), np.uint8)[:width - at]
            out[i, at:at + len(codes)] = np.clip(codes, 1, 127)
    return out


class CharNet:
    """Embedding, one convolution, ReLU, mean and maximum over positions, one linear unit."""

    def __init__(self, seed: int = 5, embed: int = 8, filters: int = 32, width: int = 5):
        rng = np.random.default_rng(seed)
        self.width = width
        self.p = {"e": rng.normal(0, 0.5, (128, embed)), "w": rng.normal(0, (2 / (embed * width)) ** 0.5,
                                                                          (embed * width, filters)),
                  "b": np.zeros(filters), "v": rng.normal(0, 0.2, 6 * filters), "c": np.zeros(1)}
        self.scale, self.shift = 1.0, 0.0
        self.thresholds = [1.1] * len(CLASSES)
        self.measured: dict[str, tuple[float, float]] = {}

    def _forward(self, codes: np.ndarray):
        e = self.p["e"][codes]
        e = e * (codes > 0)[:, :, None]
        n, length, k = len(codes), codes.shape[1] - self.width + 1, self.width
        cols = np.concatenate([e[:, j:j + length] for j in range(k)], axis=2)
        h = np.maximum(cols @ self.p["w"] + self.p["b"], 0)
        zones = (slice(0, CONTEXT - 2), slice(CONTEXT - 2, CONTEXT + BODY - 2), slice(CONTEXT + BODY - 2, length))
        pooled, arg = [], []
        for z in zones:
            arg.append(h[:, z].argmax(1) + z.start)
            pooled += [np.take_along_axis(h, arg[-1][:, None], 1)[:, 0], h[:, z].mean(1)]
        pooled = np.concatenate(pooled, axis=1)
        return pooled @ self.p["v"] + self.p["c"][0], (codes, cols, h, zones, arg, pooled)

    def logits(self, codes: np.ndarray) -> np.ndarray:
        return np.concatenate([self._forward(codes[i:i + 512])[0] for i in range(0, len(codes), 512)] or [np.zeros(0)])

    def _gradient(self, codes: np.ndarray, y: np.ndarray, weight: np.ndarray) -> dict[str, np.ndarray]:
        z, (codes, cols, h, zones, arg, pooled) = self._forward(codes)
        dz = (1 / (1 + np.exp(-z)) - y) * weight / len(y)
        dp = dz[:, None] * self.p["v"]
        f, dh, rows = h.shape[2], np.zeros_like(h), np.arange(len(y))[:, None]
        for i, zone in enumerate(zones):
            top, mean = dp[:, 2 * i * f:(2 * i + 1) * f], dp[:, (2 * i + 1) * f:(2 * i + 2) * f]
            dh[:, zone] += mean[:, None, :] / (zone.stop - zone.start)
            dh[rows, arg[i], np.arange(f)[None, :]] += top  # one place a row and filter
        dh *= h > 0
        flat = dh.reshape(-1, f)
        dcols = (flat @ self.p["w"].T).reshape(cols.shape)
        de, size, length = np.zeros_like(self.p["e"]), self.p["e"].shape[1], h.shape[1]
        for j in range(self.width):
            at, part = codes[:, j:j + length].ravel(), dcols[:, :, j * size:(j + 1) * size].reshape(-1, size)
            de += np.stack([np.bincount(at, weights=part[:, d], minlength=len(de)) for d in range(size)], axis=1)
        de[0] = 0
        return {"e": de, "w": cols.reshape(-1, cols.shape[2]).T @ flat, "b": flat.sum(0),
                "v": pooled.T @ dz, "c": np.array([dz.sum()])}

    def fit(self, codes: np.ndarray, y: np.ndarray, counts: np.ndarray, steps: int = 1000, batch: int = 128,
            rate: float = 0.01, part: int = 0, parts: int = 1) -> None:
        """Adam over class-balanced batches, drawn as ``counts`` weigh the rows; the seed fixes their order. Of the rows that
        no draw took, every ``parts``-th follows in steps of its own, so ``parts`` calls use them all."""
        rng, m, s = np.random.default_rng(11 + part), {}, {}
        rows = [np.flatnonzero(y == 1), np.flatnonzero(y == 0)]
        edges = [np.cumsum(counts[r]) for r in rows]
        drawn = [[r[np.searchsorted(e, rng.random((steps, batch // 2)) * e[-1], side="right")], r]
                 for r, e in zip(rows, edges)]
        left = [np.setdiff1d(r, d.ravel()) for d, r in drawn]
        left = [r[r % parts == part] for r in left]
        more = math.ceil(max(map(len, left)) / (batch // 2))
        fill = [np.r_[r, w[np.searchsorted(e, rng.random(more * (batch // 2) - len(r)) * e[-1], side="right")]]
                for r, w, e in zip(left, rows, edges)]
        picks = np.concatenate([np.concatenate([d, rng.permutation(f).reshape(more, batch // 2)])
                                for (d, _), f in zip(drawn, fill)], axis=1)
        for t, pick in enumerate(picks, 1):
            for k, g in self._gradient(codes[pick], y[pick], np.ones(len(pick))).items():
                m[k] = 0.9 * m.get(k, 0) + 0.1 * g
                s[k] = 0.99 * s.get(k, 0) + 0.01 * g * g
                self.p[k] -= rate * (m[k] / (1 - 0.9 ** t)) / (np.sqrt(s[k] / (1 - 0.99 ** t)) + 1e-8)

    def calibrate(self, z: np.ndarray, y: np.ndarray, classes: np.ndarray, counts: np.ndarray, shown: np.ndarray,
                  min_recall: float, min_probability: float) -> None:
        """Platt scaling by Newton steps on the counted logits of held-back rows, then a threshold per class: recall
        from the held-back findings, false alarms from all negatives as they are (``shown``)."""
        a, b = 1.0, 0.0
        held_z, held_y, n = z[~shown], y[~shown], counts[~shown]
        for _ in range(30):
            p = 1 / (1 + np.exp(-np.clip(a * held_z + b, -30, 30)))
            r, w = n * (p - held_y), n * (p * (1 - p) + 1e-6)
            g = np.array([(r * held_z).sum() + 1e-2 * (a - 1), r.sum()])
            hess = np.array([[(w * held_z * held_z).sum() + 1e-2, (w * held_z).sum()], [(w * held_z).sum(), w.sum()]])
            step = np.linalg.solve(hess + 1e-6 * np.eye(2), g)
            a, b = a - float(np.clip(step[0], -1, 1)), b - float(np.clip(step[1], -2, 2))
        self.scale, self.shift = max(a, 1e-3), b
        p = self._calibrated(z)
        for k, name in enumerate(CLASSES):
            order = np.argsort(p, kind="stable")
            found, others = (order[pick[order]] for pick in ((classes == k) & (y == 1) & ~shown, (classes == k) & shown))
            if len(found):  # a class without findings has no threshold: nothing of it is added
                up, total = np.cumsum(counts[found]), int(counts[others].sum())
                wanted = min_probability
                if total:
                    wanted = max(wanted, float(p[others][np.searchsorted(np.cumsum(counts[others]), 0.999 * total)]) + 1e-6)
                least = p[found][np.searchsorted(up, int((1 - min_recall) * up[-1]), side="right")]
                self.thresholds[k] = min(wanted, float(least))
                self.measured[name] = (float(counts[found][p[found] >= self.thresholds[k]].sum() / up[-1]),
                                       float(counts[others][p[others] >= self.thresholds[k]].sum() / total) if total else 0.0)

    def _calibrated(self, z: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.scale * z + self.shift, -30, 30)))

    def probabilities(self, codes: np.ndarray) -> np.ndarray:
        return self._calibrated(self.logits(codes))


def shortened(row: str, least: int = 16) -> str:
    """The same window with its candidate cut to between ``least`` characters and its length."""
    left, body, right = row.split("\0")
    if len(body) > least:
        body = body[:least + zlib.crc32(body.encode()) % (len(body) - least)]
    return "\0".join((left, body, right))


def redrawn(row: str, around: list[str]) -> list[str]:
    """A finding masked: random characters of every alphabet in its place, amid the text around negatives."""
    rng, out = random.Random(zlib.crc32(row.encode())), []
    for letters, least in ALPHABETS:
        left, _, right = rng.choice(around).split("\0")
        out.append("\0".join((left, "".join(rng.choices(letters, k=min(rng.randint(least, BODY), rng.randint(least, BODY)))), right)))
    return out


def glued(row: str) -> list[str]:
    """Words around a negative as one run: a path, an identifier, a name with a number."""
    left, body, right = row.split("\0")
    words = re.findall(r"[A-Za-z]{2,}", f"{left} {right}")
    if not words:
        return []
    rng, out = random.Random(zlib.crc32(row.encode())), []
    for join in ("", rng.choice("_-./=")):
        run = join.join(rng.choices(words, k=rng.randint(3, 8)))
        if rng.random() < 0.4:
            run += join + str(rng.choice((rng.randint(0, 99), rng.randint(1900, 2100), rng.randint(0, 99999))))
        if len(run) >= 16:
            out.append("\0".join((left, run[:BODY], right)))
    return out


def counted(scanned: DataFrame) -> DataFrame:
    """Different windows of all candidates with how often each occurs: label, window, n. Of a long
    candidate the first ``BODY`` characters stay, which are all that the network reads of a training row."""
    pairs = scanned.select(F.explode(F.arrays_zip("labels", "windows")).alias("x"))
    parts = F.split(F.col("x.windows"), "\0")
    window = F.concat_ws("\0", parts[0], F.substring(parts[1], 1, BODY), parts[2])
    return pairs.select(F.col("x.labels").alias("label"), window.alias("window")).groupBy("label", "window").agg(
        F.count(F.lit(1)).alias("n"))


EXAMPLES = "home bigint, place int, y int, class int, held boolean, bare boolean, n bigint, codes binary"


def examples(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
    """Training rows of one share of windows: as they are, cut shorter, and findings redrawn or negatives glued."""
    rows = rows.assign(order=[hashlib.md5(w.encode()).digest() for w in rows["window"]]).sort_values(["order", "window"])
    around = rows.loc[~rows["label"], "window"].tolist()
    out, windows = [], []
    for label in (True, False):
        part = rows[rows["label"] == label]
        for i, (row, n) in enumerate(zip(part["window"], part["n"])):
            made = [row, shortened(row), *(redrawn(row, around or [row]) if label else glued(row))]
            windows += made
            out += [(int(key[0]), int(label), _classes(w.split("\0")[1]), i % 3 == 0, i % 2 == 1, n) for w in made]
    codes = encode_windows(windows)
    home, y, kind, held, bare, n = zip(*out)
    return pd.DataFrame({"home": home, "place": range(len(out)), "y": y, "class": kind, "held": held, "bare": bare, "n": n,
                         "codes": [c.tobytes() for c in codes]})


def _codes(rows: pd.DataFrame, bare: bool = True) -> np.ndarray:
    """The rows' codes; those marked bare without their context."""
    codes = np.frombuffer(b"".join(rows["codes"]), np.uint8).reshape(len(rows), CONTEXT + BODY + CONTEXT).copy()
    if bare:
        masked = rows["bare"].to_numpy(bool)
        codes[masked, :CONTEXT] = 0
        codes[masked, CONTEXT + BODY:] = 0
    return codes


def _learnt(net: CharNet, dealt: DataFrame, shares: int) -> None:
    """Every share goes on from the net's weights over its own rows; then their mean counts."""
    rounds = 1 if shares == 1 else ROUNDS
    steps = DRAWS // rounds
    for turn in range(rounds):
        def run(rows: pd.DataFrame) -> pd.DataFrame:
            only_caches()
            own = copy.deepcopy(net)  # a task may have several shares
            rows = rows.sort_values(["home", "place"], ignore_index=True)
            y = rows["y"].to_numpy(float)
            if y.any() and not y.all():
                own.fit(_codes(rows), y, rows["n"].to_numpy(np.int64), steps, part=turn, parts=rounds)
            weights = np.concatenate([own.p[k].ravel() for k in sorted(own.p)])
            return pd.DataFrame({"share": rows["share"][:1], "weights": [weights.tobytes()]})

        # more partitions than shares, as two shares of one partition wait for each other
        learnt = dealt.repartition(4 * shares, "share").groupBy("share").applyInPandas(run, "share bigint, weights binary")
        total = np.mean([np.frombuffer(r.weights) for r in sorted(learnt.collect())], axis=0)
        for k in sorted(net.p):
            net.p[k], total = total[:net.p[k].size].reshape(net.p[k].shape).copy(), total[net.p[k].size:]


def _logit_counts(net: CharNet, made: DataFrame) -> pd.DataFrame:
    """How many rows have each logit, in steps of 1/STEPS: held-back rows masked, and all negatives as they are (``shown``)."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        only_caches()
        for batch in batches:
            for at in range(0, len(batch), 4096):
                rows = batch.iloc[at:at + 4096]
                for shown, part in ((False, rows[rows["held"]]), (True, rows[rows["y"] == 0])):
                    z = np.clip(net.logits(_codes(part, not shown)), -1000, 1000) * STEPS
                    # findings are rounded down and negatives up, so that no threshold lets more pass than counted
                    step = np.where(part["y"] == 1, np.floor(z), np.ceil(z)).astype(np.int64)
                    yield pd.DataFrame({"shown": shown, "y": part["y"], "class": part["class"], "step": step, "n": part["n"]})

    return (made.where("held or y = 0").mapInPandas(run, "shown boolean, y int, class int, step bigint, n bigint")
            .groupBy("shown", "y", "class", "step").agg(F.sum("n").alias("n"))
            .orderBy("shown", "y", "class", "step").toPandas())


def train(scanned: DataFrame, sample: int = 3000, min_recall: float = 0.9, min_probability: float = 0.5) -> CharNet | None:
    """The network, learnt and calibrated from all findings and all other candidates. ``sample`` cuts nothing: of the rarer
    label a share learns from so many rows at least, or from all; for that its rows go to several shares."""
    windows = staged(counted(scanned), "windows")
    different = {r.label: r["count"] for r in windows.groupBy("label").count().collect()}
    if len(different) < 2:
        return None
    shares = math.ceil(sum(different.values()) / SHARE)
    home = F.pmod(F.xxhash64("window"), F.lit(shares))
    made = staged(windows.withColumn("home", home).repartition(4 * shares, "home").groupBy("home")
                  .applyInPandas(examples, EXAMPLES), "examples")
    learning = {r.y: r["count"] for r in made.where("not held").groupBy("y").count().collect()}
    if len(learning) < 2:
        return None
    copies = [min(shares, math.ceil(shares * sample / different[label])) for label in (False, True)]
    place = F.explode(F.sequence(F.lit(0), F.when(F.col("y") == 1, copies[1]).otherwise(copies[0]) - 1))
    dealt = made.where("not held").select("*", place.alias("at")).withColumn(
        "share", F.pmod(F.col("home") + F.col("at"), F.lit(shares)).cast("bigint")).drop("at")
    net = CharNet()
    _learnt(net, dealt, shares)
    counts = _logit_counts(net, made)
    net.calibrate(counts["step"].to_numpy(float) / STEPS, counts["y"].to_numpy(float), counts["class"].to_numpy(),
                  counts["n"].to_numpy(), counts["shown"].to_numpy(bool), min_recall, min_probability)
    return net


def score(scanned: DataFrame, net: CharNet | None) -> DataFrame:
    """Add the network's spans: doc_id, n_assign, n_access, n_hex, base_sha256, spans."""
    schema = "doc_id bigint, n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string, spans string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        only_caches()
        for batch in batches:
            rows = batch.to_pylist()
            at = [(i, j) for i, r in enumerate(rows) for j, y in enumerate(r["labels"]) if not y]
            added: dict[int, list[tuple[int, int, int]]] = {}
            if net is not None:
                for block in range(0, len(at), 2048):
                    part = at[block:block + 2048]
                    pieces = [(k, w) for k, (i, j) in enumerate(part) for w in _pieces(rows[i]["windows"][j])]
                    p = net.probabilities(encode_windows([w for _, w in pieces]))
                    best = np.zeros(len(part))
                    np.maximum.at(best, [k for k, _ in pieces], p)
                    for (i, j), value in zip(part, best):
                        if value >= net.thresholds[_classes(rows[i]["windows"][j].split("\0")[1])]:
                            added.setdefault(i, []).append((rows[i]["starts"][j], 3, rows[i]["ends"][j]))
            spans = []
            for i, r in enumerate(rows):
                base = [(int(a), KINDS.index(k), int(b)) for k, a, b in
                        (s.split(":") for s in r["base_spans"].split(",") if s)]
                spans.append(joined(sorted(base + added.get(i, []))))
            yield pa.RecordBatch.from_arrays([batch.column(n) for n in range(5)] + [pa.array(spans, pa.string())],
                                             ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"])

    return scanned.mapInArrow(run, schema)


def _pieces(row: str) -> list[str]:
    """A candidate longer than ``BODY`` is scored piece by piece; the best piece counts."""
    left, body, right = row.split("\0")
    if len(body) <= BODY:
        return [row]
    cuts = [*range(0, len(body) - BODY, BODY), len(body) - BODY]  # the last piece ends with the candidate
    return ["\0".join(((left + body[:a])[-CONTEXT:], body[a:a + BODY], (body[a + BODY:] + right)[:CONTEXT])) for a in cuts]


def find_secrets(docs: DataFrame, sample: int = 3000, min_recall: float = 0.9) -> DataFrame:
    """All spans of every document: patterns, and what the network adds."""
    scanned = staged(scan(docs), "scanned")
    return score(scanned, train(scanned, sample, min_recall))


def redact(docs: DataFrame, net: CharNet | None, mark: str = "[REDACTED]") -> DataFrame:
    """``docs`` with every span of its text replaced by ``mark`` (overlapping spans by one
    mark) and ``n_chars`` of the new text; null texts and all other columns stay."""
    columns = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        only_caches()
        at = columns.index("text")
        for batch in slices(batches, at):
            texts = batch.column(at).to_pylist()
            found = [base_spans(t) if t else [] for t in texts]
            windows, owner = [], []
            for i, t in enumerate(texts):
                for a, b, label in candidates(t, found[i]) if t else ():
                    if not label:
                        windows.append(window(t, a, b))
                        owner.append((i, a, b))
            if net is not None and windows:
                pieces = [(k, w) for k, whole in enumerate(windows) for w in _pieces(whole)]
                p, best = net.probabilities(encode_windows([w for _, w in pieces])), np.zeros(len(windows))
                np.maximum.at(best, [k for k, _ in pieces], p)
                for (i, a, b), whole, value in zip(owner, windows, best):
                    if value >= net.thresholds[_classes(whole.split("\0")[1])]:
                        found[i] = sorted(found[i] + [(a, 3, b)])
            for i, spans in enumerate(found):
                if spans:
                    out, end = [], 0
                    for a, _, b in spans:
                        if a >= end:
                            out += [texts[i][end:a], mark]
                        end = max(end, b)
                    texts[i] = "".join(out) + texts[i][end:]
            arrays = [pa.array(texts, pa.string()) if n == at else batch.column(n) for n in range(batch.num_columns)]
            if "n_chars" in columns:
                arrays[columns.index("n_chars")] = pa.array([None if t is None else len(t) for t in texts], pa.int64())
            yield pa.RecordBatch.from_arrays(arrays, columns)

    out = docs.withColumn("n_chars", F.col("n_chars").cast("bigint")) if "n_chars" in columns else docs
    return out.mapInArrow(run, out.schema)
