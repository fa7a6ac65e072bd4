"""Sequence packing: length patterns fitted to the histogram by non-negative least squares.

Tokenize, cut what is longer than a sequence, and count pieces by length. The histogram has
at most ``capacity`` rows whatever the corpus size, so the plan is made on the driver: fit
repeat counts of one-, two- and three-piece patterns, round them down, then pack what the
patterns leave by best fit. The plan is a table of runs (length, rank range, sequence range,
offset); pieces get their rank within their length and look their run up.
"""

from __future__ import annotations

import sys
import types
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import bounded, bucket_count, gapless_rank, stash, table

CAPACITY = 4096
#: Width of a length bin of the pattern fit, in tokens; a bin stands for its upper end.
BIN = 8
#: Most words whose ids a worker keeps, and the longest (in bytes) that it keeps.
CACHE_WORDS, CACHE_BYTES = 600_000, 40
#: ASCII marks that are peeled off the end of a word. The apostrophe is not one of them:
#: the tokenizer reads it together with the letters after it.
MARKS = b"!\"#$%&()*+,-./:;<=>?@[]^_`{|}~"


def _ends_in_letter(word: bytes) -> bool:
    """Whether a mark after the word starts a token of its own once the tokenizer has normalized it."""
    if not word or word[-1] < 128:
        return word[-1:].isalnum()
    return unicodedata.normalize("NFC", word.decode()).lower()[-1].isalnum()


class WordIds:
    """Ids of words, remembered.

    The tokenizer drops white space, reads ASCII letters in lower case, and never merges a
    run of letters with a mark beside it. So a text's ids are its words' ids one after the
    other, and a word's are those of its letters and of its trailing marks. Letter runs new
    to a text are encoded together; each ends with the one token that closes a word.
    """

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        # The same model for words that need no normalizing and no splitting. It meets a
        # word once, so the model's own word cache would only cost time.
        plain = Tokenizer.from_file(path)
        self.plain = Tokenizer(plain.model)
        self.plain.pre_tokenizer = pre_tokenizers.Sequence(
            [pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)]
        )
        self.plain.model._resize_cache(0)
        vocab = self.tokenizer.get_vocab(with_added_tokens=True)
        self.closes = np.zeros(max(vocab.values()) + 1, dtype=bool)
        self.closes[[k for token, k in vocab.items() if token.endswith("</w>")]] = True
        self.known: dict[bytes, bytes] = {}

    def _encode(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, dtype="<u4")

    def _learn(self, new: set[bytes]) -> None:
        words = [(p, p.decode()) for p in new]
        letters = [p for p, w in words if w.isalpha() and (len(p) == len(w) or (w == w.lower() and unicodedata.is_normalized("NFC", w)))]
        ids = np.array(self.plain.encode_batch_fast([b" ".join(letters).decode()], add_special_tokens=False)[0].ids, dtype="<u4")
        ends = (np.nonzero(self.closes[ids])[0] + 1).tolist()
        raw = ids.tobytes()
        if len(ends) == len(letters):
            self.known.update((p, raw[4 * i : 4 * j]) for p, i, j in zip(letters, [0, *ends], ends))
            new.difference_update(letters)
        for p in new:
            self.known[p] = self._encode(p.decode()).tobytes()

    def __call__(self, text: str | None) -> bytes:
        """Ids of a text as little-endian 32-bit numbers."""
        if text and "<|" in text:  # may spell a special token, which case and marks belong to
            return self._encode(text).tobytes()
        words = text.encode().lower().split() if text else []
        known = self.known
        got = list(map(known.get, words))
        if None not in got:
            return b"".join(got)
        missing = {w for w, g in zip(words, got) if g is None}
        if len(known) > CACHE_WORDS:
            known.clear()
        split = []
        for w in missing:
            core = w.rstrip(MARKS)
            if len(core) < len(w) and _ends_in_letter(core):
                split.append((w, core, w[len(core) :]))
        new = missing.difference([w for w, _, _ in split])
        new.update([p for _, *parts in split for p in parts if p not in known])
        if new:
            self._learn(new)
        for w, core, mark in split:
            known[w] = known[core] + known[mark]
        ids = b"".join([known[w] if g is None else g for w, g in zip(words, got)])
        for w in missing:
            if len(w) > CACHE_BYTES:
                del known[w]
        return ids


def worker_ids(path: str) -> WordIds:
    """The worker process's tokenizer: tasks that follow each other share its words."""
    held = sys.modules.setdefault("_textmill_worker", types.ModuleType("_textmill_worker")).__dict__
    if path not in held:
        held[path] = WordIds(path)
    return held[path]


def pieces(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, end_id: int = 1, with_ids: bool = False) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32[, ids]) of every row of ``docs`` (doc_id, text).

    A null or empty text is the end id alone: one piece of length 1. Only documents of more
    than ``capacity`` ids are cut; their last piece may be shorter. ``with_ids`` adds the
    ids themselves.
    """
    fields = "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * with_ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zlib

        ids_of = worker_ids(tokenizer_path)
        end = np.array([end_id], dtype="<u4").tobytes()
        for batch in batches:
            out: list[list] = [[] for _ in range(5 + with_ids)]
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = ids_of(text.as_py()) + end
                for k, at in enumerate(range(0, len(ids), 4 * capacity)):
                    part = ids[at : at + 4 * capacity]
                    row = [doc_id, k, at // 4, len(part) // 4, zlib.crc32(part)]
                    for column, x in zip(out, row + [np.frombuffer(part, "<i4")] * with_ids):
                        column.append(x)
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int32())]
            names = ["doc_id", "piece", "start", "length", "ids_crc32", "ids"][: len(out)]
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(out, kinds)], names=names)

    chosen = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return bounded(chosen).mapInArrow(run, fields)


def few_piece_patterns(bins: int) -> np.ndarray:
    """Rows (a, b, c), a >= b >= c >= 0, of bins that fill a sequence exactly (0: no piece)."""
    rows = [(bins, 0, 0)]
    for a in range(bins - 1, 0, -1):
        rest = bins - a
        rows += [(a, b, rest - b) for b in range(min(a, rest), 0, -1) if rest - b <= b]
    return np.array(rows, dtype=np.int64)


def fit_repeats(patterns: np.ndarray, histogram: np.ndarray, rounds: int = 300) -> np.ndarray:
    """Non-negative least squares: repeats x >= 0 minimising |A x - histogram|.

    A's column j counts the bins of pattern j, at most three entries, so products are
    gathers. Accelerated projected gradient with the step of A's largest eigenvalue. Bins
    are weighted by their length, since a long piece left over costs more than a short one.
    """
    size = len(histogram)
    used = np.nonzero(((patterns == 0) | (histogram[patterns] > 0)).all(axis=1))[0]
    p = patterns[used]
    weight = np.arange(size, dtype=float) / size
    weight[0] = 0.0

    def forward(x: np.ndarray) -> np.ndarray:
        y = np.zeros(size)
        for k in range(3):
            y += np.bincount(p[:, k], weights=x, minlength=size)
        y[0] = 0.0
        return y * weight

    def back(y: np.ndarray) -> np.ndarray:
        z = y * weight
        z[0] = 0.0
        return z[p[:, 0]] + z[p[:, 1]] + z[p[:, 2]]

    target = histogram * weight
    probe = np.ones(len(used))
    for _ in range(20):
        probe = back(forward(probe))
        top = float(np.linalg.norm(probe)) or 1.0
        probe /= top
    x = np.zeros(len(used))
    lead, t = x, 1.0
    for _ in range(rounds):
        new = np.maximum(0.0, lead - back(forward(lead) - target) / (1.02 * top))
        t_new = (1 + (1 + 4 * t * t) ** 0.5) / 2
        lead = new + (t - 1) / t_new * (new - x)
        x, t = new, t_new
    out = np.zeros(len(patterns))
    out[used] = x
    return out


@dataclass
class Run:
    """Pieces of one length, ranks rank .. rank+n-1, go to sequences seq .. seq+n-1 at offset."""

    length: int
    rank: int
    n: int
    seq: int
    offset: int


def plan_runs(counts: dict[int, int], capacity: int = CAPACITY, bin_width: int = BIN) -> list[Run]:
    """Place every piece of the histogram ``counts`` (length -> pieces).

    The number of runs depends on the number of distinct lengths, not on the pieces: every
    step ends a length or a range of equally filled sequences.
    """
    counts = {k: v for k, v in counts.items() if v > 0}
    left, placed, runs, sequences = dict(counts), dict.fromkeys(counts, 0), [], 0
    groups: dict[int, list[tuple[int, int]]] = {}  # free tokens -> ranges (first sequence, n)

    def put(length: int, n: int, seq: int, offset: int) -> None:
        runs.append(Run(length, placed[length], n, seq, offset))
        placed[length] += n
        left[length] -= n

    bins = capacity // bin_width
    by_bin: list[list[int]] = [[] for _ in range(bins + 1)]
    for length in sorted(counts):
        by_bin[-(-length // bin_width)].append(length)
    histogram = np.array([sum(counts[x] for x in xs) for xs in by_bin], dtype=float)
    patterns = few_piece_patterns(bins)
    repeats = np.floor(fit_repeats(patterns, histogram) + 1e-6).astype(np.int64)
    for j in np.argsort(-repeats, kind="stable"):
        want = int(repeats[j])
        if want < 1:
            break
        parts = [int(b) for b in patterns[j] if b]
        need = {b: parts.count(b) for b in parts}
        want = min([want, *(sum(left[x] for x in by_bin[b]) // k for b, k in need.items())])
        states = [(sequences, want, 0)] if want else []
        sequences += want
        for b in parts:
            filled = []
            for seq, n, offset in states:
                while n:
                    length = next(x for x in reversed(by_bin[b]) if left[x])
                    take = min(n, left[length])
                    put(length, take, seq, offset)
                    filled.append((seq, take, offset + length))
                    seq, n = seq + take, n - take
            states = filled
        for seq, n, offset in states:
            if offset < capacity:
                groups.setdefault(capacity - offset, []).append((seq, n))

    for length in sorted(counts, reverse=True):
        while left[length]:
            free = min((f for f in groups if f >= length), default=None)
            if free is None:
                fit = capacity // length
                n = max(1, left[length] // fit)
                new, sequences = sequences, sequences + n
                groups.setdefault(capacity, []).append((new, n))
                free = capacity
            ranges = groups[free]
            seq, n = ranges.pop()
            take = min(n, left[length])
            put(length, take, seq, capacity - free)
            if take < n:
                ranges.append((seq + take, n - take))
            if not ranges:
                del groups[free]
            if free > length:
                groups.setdefault(free - length, []).append((seq, take))
    return runs


def pack(cut: DataFrame, capacity: int = CAPACITY, bin_width: int = BIN) -> DataFrame:
    """Add sequence_id and offset to pieces (doc_id, piece, length, ids_crc32, ...).

    Offsets are gapless from 0 in every sequence and no sequence exceeds ``capacity``.
    ``cut`` is read twice: pass a stored table. An empty table gives no rows.
    """
    spark = cut.sparkSession
    histogram = {int(r.length): int(r["n"]) for r in cut.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    runs = plan_runs(histogram, capacity, bin_width)
    schema = "run_length long, rank_from long, rank_to long, seq_from long, at long"
    plan = spark.createDataFrame([(r.length, r.rank, r.rank + r.n, r.seq, r.offset) for r in runs], schema)
    # One row for each length with its runs by rank: bounded by the capacity, not the corpus.
    by_length = plan.groupBy("run_length").agg(
        F.array_sort(F.collect_list(F.struct("rank_from", "rank_to", "seq_from", "at"))).alias("runs")
    )
    buckets = bucket_count(sum(histogram.values()), 20_000)
    ranked = gapless_rank(cut, "length", ["doc_id", "piece", "ids_crc32"], "rank", max(buckets, 64))
    mine = F.element_at(
        F.filter("runs", lambda r: (F.col("rank") >= r.rank_from) & (F.col("rank") < r.rank_to)), 1
    )
    joined = ranked.join(F.broadcast(by_length), ranked.length == by_length.run_length).withColumn("run", mine)
    return joined.withColumn("sequence_id", F.col("run.seq_from") + F.col("rank") - F.col("run.rank_from")).withColumn(
        "offset", F.col("run.at")
    ).drop("run", "runs", "run_length", "rank")


def pack_documents(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY) -> DataFrame:
    """Pieces of all rows of ``docs`` (doc_id, text) with their sequence and offset.

    A null or empty text is its end token alone. Texts of any length are cut into pieces of
    ``capacity``, whole. Repeated rows are packed each on its own; pieces of equal length
    and key may change places, which changes no sequence's length. Extra columns are left
    out. An empty table gives no rows.
    """
    return pack(stash(pieces(docs, tokenizer_path, capacity), "packing-pieces"), capacity).select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"
    )


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every piece of all documents and its place in the packed sequences."""
    import public_tokenizers

    return pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
