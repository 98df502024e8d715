"""Token counts by prefix dynamic programming.

A sentencepiece BPE model never merges across the start of a word (no piece
holds a non-space followed by the space mark), so a text's pieces are those of
its words side by side. For one word, the encoding of the prefix of length i is
the encoding of a shorter prefix plus one last piece; that last piece is the
only one that is stable next to the last piece of the shorter prefix, i.e. the
pair stays as it is when its characters are encoded together. One pass over
the word therefore gives the exact count at every prefix, and the counts of a
text are the running sum of its words' counts. Truncation and budget questions
are then look-ups in that array; nothing is encoded again.

Defined results: null text is the empty text (0 bytes, 0 tokens); rows with
equal or null ids stay separate rows; other columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import WordCache, slices, text_bytes
from .packing import IdTable

MARK = "▁"
TOKENIZER = "piece_bpe_32k.model"
_SEGMENTS = re.compile(f"{MARK}+[^{MARK}]*|[^{MARK}]+")


class PrefixCounter:
    """Exact token count at every prefix of a text, for one sentencepiece BPE model."""

    def __init__(self, model_file: str):
        import sentencepiece
        model = sentencepiece.SentencePieceProcessor(model_file=model_file)
        self.scores: dict[str, float] = {}
        for i in range(model.get_piece_size()):
            if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i)):
                self.scores[model.id_to_piece(i)] = model.get_score(i)
        if any(re.search(f"[^{MARK}]{MARK}", p) for p in self.scores):
            raise ValueError("a piece spans two words: prefixes can't be counted word by word")
        self.longest = max(map(len, self.scores))
        self.stable: dict[tuple[str, str], bool] = {}
        self.histories: dict[str, tuple[bool, list[float], list[str], list[str]]] = {}
        self.prefixes: dict[str, tuple[int, str]] = {}
        self.words = WordCache(self._deltas, 100_000)  # of odd texts
        self.table = IdTable(lambda words: [self._deltas(MARK + w.decode("utf-8", "replace")) for w in words], np.int8)

    def _history(self, piece: str) -> tuple[bool, list[float], list[str], list[str]]:
        """Plain BPE on one piece: merge the best-scored adjacent pair, leftmost first, until none
        is left. Returns whether one piece remains, each merge's score, and the first and the last part
        before every merge and at the end."""
        known = self.histories.get(piece)
        if known is None:
            parts, scores = list(piece), self.scores
            merges, firsts, lasts = [], [parts[0]], [parts[-1]]
            while len(parts) > 1:
                best, at = None, -1
                for i in range(len(parts) - 1):
                    score = scores.get(parts[i] + parts[i + 1])
                    if score is not None and (best is None or score > best):
                        best, at = score, i
                if best is None:
                    break
                parts[at:at + 2] = [parts[at] + parts[at + 1]]
                merges.append(best)
                firsts.append(parts[0])
                lasts.append(parts[-1])
            if len(self.histories) > 200_000:
                self.histories.clear()
            known = self.histories[piece] = len(parts) == 1, merges, firsts, lasts
        return known

    def _fits(self, left: str, piece: str) -> bool:
        """Whether encoding ``left + piece`` gives just these two: their own merges all come
        before any merge across the border."""
        if len(self.stable) > 1_000_000:
            self.stable.clear()
        fits, right_merges, firsts, _ = self._history(piece)
        if fits and left:
            _, left_merges, _, lasts = self._history(left)
            get, i, j, m, n = self.scores.get, 0, 0, len(left_merges), len(right_merges)
            while True:
                across = get(lasts[i] + firsts[j])
                ours = left_merges[i] if i < m else None
                theirs = right_merges[j] if j < n else None
                if across is not None and (ours is None or across > ours) and (theirs is None or across >= theirs):
                    fits = False
                    break
                if ours is not None and (theirs is None or ours >= theirs):
                    i += 1
                elif theirs is not None:
                    j += 1
                else:
                    break
        self.stable[left, piece] = fits
        return fits

    def _deltas(self, word: str) -> bytes:
        """Change of the count at each character of one word, as int8."""
        scores, stable, longest, n = self.scores, self.stable, self.longest, len(word)
        # Long words keep their own states; those of short ones are shared by prefix.
        table = self.prefixes if n <= 40 else None
        counts, lasts = [0], [""]
        for end in range(1, n + 1):
            prefix = word[:end] if table is not None else ""
            state = table.get(prefix) if table is not None else None
            if state is None:
                for j in range(max(0, end - longest), end):
                    piece = word[j:end]
                    known = piece in scores
                    if known or j == end - 1:
                        fits = stable.get((lasts[j], piece))
                        if fits or fits is None and self._fits(lasts[j], piece):
                            # a character outside the vocabulary falls back to its UTF-8 bytes
                            state = (counts[j] + (1 if known else len(piece.encode("utf-8", "surrogatepass"))), piece)
                            break
                else:
                    raise AssertionError(f"no stable last piece in {word[:end]!r}")
                if table is not None:
                    table[prefix] = state
            counts.append(state[0])
            lasts.append(state[1])
        if len(self.prefixes) > 700_000:
            self.prefixes.clear()
        return bytes([(b - a) & 255 for a, b in zip(counts, counts[1:])])

    def deltas(self, text: str) -> np.ndarray:
        """int8 array: entry 0 is the leading space mark, entry i the change at character i."""
        if not text:
            return np.zeros(1, np.int8)
        marked = MARK + text.replace(" ", MARK)
        found = map(self.words.__getitem__, _SEGMENTS.findall(marked))
        return np.frombuffer(b"".join(found), np.int8)

    def count_all(self, texts: pa.Array):
        """(tokens of each text, function giving the deltas of the i-th text).

        Arrow splits the texts at spaces and numbers their distinct words, so a word's
        table is looked up once a call. Texts with runs of spaces, or a space mark of their own,
        whose pieces can span several words, take the path of single texts.
        """
        odd = pc.or_(pc.or_(pc.match_substring(texts, "  "), pc.starts_with(texts, " ")), pc.match_substring(texts, MARK))
        lists = pc.split_pattern(texts, " ")
        words = lists.flatten().dictionary_encode()
        start, length = self.table.look_up(words.dictionary.view(pa.binary()).to_pylist())
        word, cuts = words.indices.to_numpy(), lists.offsets.to_numpy()
        cuts = cuts - cuts[0]
        # a word's tokens: the sum of its deltas, for the distinct words of this call
        held = np.repeat(start - (np.cumsum(length) - length), length)
        held += np.arange(len(held))
        sums = np.r_[0, np.cumsum(self.table.pool[held], dtype=np.int64)]
        ends = np.cumsum(length)
        tokens = (sums[ends] - sums[ends - length])[word]
        totals = np.r_[0, np.cumsum(tokens)]
        totals = totals[cuts[1:]] - totals[cuts[:-1]]
        totals[pc.binary_length(texts).to_numpy() == 0] = 0
        odd = odd.to_numpy(zero_copy_only=False)
        for i in np.flatnonzero(odd):
            totals[i] = self.deltas(texts[i].as_py()).sum(dtype=np.int64)

        def deltas(i: int) -> np.ndarray:
            text = texts[i].as_py() if odd[i] or not texts[i].as_py() else None
            if text is not None:
                return self.deltas(text)
            mine = word[cuts[i]:cuts[i + 1]]
            n = length[mine]
            places = np.repeat(start[mine] - (np.cumsum(n) - n), n)
            return self.table.pool[places + np.arange(len(places))]

        return totals, deltas

    def counts(self, text: str) -> np.ndarray:
        """Token count of every prefix: entry i for the first i characters."""
        out = np.cumsum(self.deltas(text), dtype=np.int64)
        out[0] = 0
        return out


_counters: dict[str, PrefixCounter] = {}


def counter(model_file: str | None = None) -> PrefixCounter:
    """The worker's counter for a model file (default: the public 32k model)."""
    if model_file is None:
        import public_tokenizers
        model_file = public_tokenizers.path(TOKENIZER)
    if model_file not in _counters:
        _counters[model_file] = PrefixCounter(model_file)
    return _counters[model_file]


def prefix_counts(docs: DataFrame, budget: int = 4096, model_file: str | None = None,
                  keep_table: bool = False) -> DataFrame:
    """Per document: doc_id, n_bytes, n_tokens, over_limit and cut_chars, the number of
    characters of its longest prefix that has at most ``budget`` tokens.

    With ``keep_table`` the column ``prefix_deltas`` holds the whole array (one
    signed byte per character after the first entry; its running sum is the count
    at each prefix), for :func:`tokens_at` and other questions later on.
    """
    schema = "doc_id bigint, n_bytes bigint, n_tokens bigint, over_limit boolean, cut_chars bigint"
    if keep_table:
        schema += ", prefix_deltas binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = counter(model_file)
        for batch in slices(batches, 1):
            texts = batch.column(1).view(pa.string())
            totals, deltas = table.count_all(texts)
            chars = pc.utf8_length(texts).to_numpy().astype(np.int64)
            for i in np.flatnonzero(totals > budget):
                c = np.cumsum(deltas(i), dtype=np.int64)
                c[0] = 0
                chars[i] = np.flatnonzero(c <= budget)[-1]
            columns = [batch.column(0), pc.binary_length(batch.column(1)).cast(pa.int64()), pa.array(totals),
                       pa.array(totals > budget), pa.array(chars)]
            names = ["doc_id", "n_bytes", "n_tokens", "over_limit", "cut_chars"]
            if keep_table:
                columns.append(pa.array([deltas(i).tobytes() for i in range(batch.num_rows)], pa.binary()))
                names.append("prefix_deltas")
            yield pa.RecordBatch.from_arrays(columns, names)

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_bytes().alias("text")).mapInArrow(run, schema)


def tokens_at(prefix_deltas: bytes, chars: int) -> int:
    """Tokens of the first ``chars`` characters, from a stored table."""
    d = np.frombuffer(prefix_deltas, np.int8)
    return int(d[:chars + 1].sum(dtype=np.int64)) if chars > 0 else 0
