"""A hidden Markov language model over words.

Latent states emit symbols: the frequent words, the end of the text, and one class for
every last character of the other words. Within its class a word has the add-one share of
its training count. Baum-Welch runs as map and reduce: every task adds up the expected
counts of its sequences, the sums give the next parameters. A text's probability is that of
its symbols by the scaled forward recursion, times its rare words' shares.

Word counts cover the whole training corpus. Frequent words travel to the tasks in a table
of bounded size; rare ones are looked up by a join on the word.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat
from math import log10

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import bounded, discard, stash, table

STATES = 16
#: Most words with a symbol of their own (a symbol takes two bytes), and most words whose counts the tasks hold.
HEAD, HELD = 32_768, 262_144
CLASSES = 129
#: Baum-Welch passes, each over every training text.
PASSES = 4
#: Training sequences: longer texts are cut; scoring never cuts.
SEGMENT = 256
#: Tokens that a task encodes or trains on at a time, those that scoring gathers before it sorts
#: texts by length, and words that a task counts before it passes them on.
BATCH_TOKENS, SCORE_TOKENS, BATCH_WORDS = 250_000, 1_000_000, 300_000
#: Pseudo-counts of the corpus-wide symbol shares in every state, and of every transition.
PRIOR, TRANSITION_PRIOR = 50.0, 0.5


def text_words(text: str | None) -> list[bytes]:
    """Words of a text, A to Z in lower case."""
    return text.encode().lower().split() if text else []


def word_counts(train: DataFrame) -> DataFrame:
    """(word, c): how often each word occurs in the texts of ``train``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[bytes] = Counter()

        def flush() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays(
                [pa.array(list(held), pa.binary()).cast(pa.string()), pa.array(list(held.values()), pa.int64())], names=["word", "c"]
            )
            held.clear()
            return out

        for batch in batches:
            for text in batch.column(0):
                held.update(text_words(text.as_py()))
                if len(held) > BATCH_WORDS:
                    yield flush()
        yield flush()

    return bounded(train.select("text")).mapInArrow(run, "word string, c long").groupBy("word").agg(F.sum("c").alias("c"))


def _class_of(word: bytes) -> int:
    return min(word[-1], CLASSES - 1)


def _class_column(word: Column) -> Column:
    return F.least(F.ascii(F.right(word, F.lit(1))), F.lit(CLASSES - 1))


@dataclass
class Vocabulary:
    """Training counts: of all tokens, kinds and texts; of the held words; of the classes.

    ``place`` gives a held word's row in ``counts`` and ``symbols``: a symbol of its own or
    its class's. ``share`` are the corpus-wide shares of the symbols.
    """

    tokens: int
    kinds: int
    texts: int
    place: dict[bytes, int]
    counts: np.ndarray
    symbols: np.ndarray
    class_norm: np.ndarray
    share: np.ndarray

    @property
    def end(self) -> int:
        return CLASSES

    def norm(self) -> float:
        return log10(self.tokens + self.kinds + 1)


def gather(counts: DataFrame, texts: int) -> Vocabulary:
    """Vocabulary of the stored counts (word, c).

    The thresholds come from the histogram of counts, so no task ranks words; every word
    above a threshold is taken and there are at most HELD of them. Ties at a threshold
    are all taken or all left, so the order of rows does not matter.
    """
    top = 100_000
    histogram = counts.groupBy(F.least("c", F.lit(top)).alias("c")).agg(F.count(F.lit(1)).alias("kinds"), F.sum("c").alias("tokens"))
    rows = sorted(((r.c, r.kinds, r.tokens) for r in histogram.collect()), reverse=True)
    tokens, kinds = sum(r[2] for r in rows) + texts, sum(r[1] for r in rows) + (texts > 0)
    least = {}
    for most in (HEAD, HELD):
        total, least[most] = 0, rows[0][0] + 1 if rows else 1
        for c, n, _ in rows:
            total += n
            if total > most:
                break
            least[most] = c
    held = counts.where(F.col("c") >= least[HELD]).toArrow().sort_by("word")
    words, by_row = [w.encode() for w in held.column(0).to_pylist()], held.column(1).to_numpy().astype(np.int64)
    own = by_row >= least[HEAD]
    symbols = np.array([_class_of(w) for w in words], dtype=np.uint16)
    symbols[own] = CLASSES + 1 + np.arange(own.sum())
    classes = counts.where(F.col("c") < least[HEAD]).groupBy(_class_column(F.col("word")).alias("k")).agg(F.sum("c").alias("n"), F.count(F.lit(1)).alias("v"))
    class_tokens, class_kinds = np.zeros(CLASSES), np.zeros(CLASSES)
    for r in classes.collect():
        class_tokens[r.k], class_kinds[r.k] = r.n, r.v
    share = np.concatenate([class_tokens + 1.0, [texts + 1.0], by_row[own]])
    return Vocabulary(tokens, kinds, texts, {w: k for k, w in enumerate(words)}, by_row, symbols, np.log10(class_tokens + class_kinds + 1), share / share.sum())


def encode(docs: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """``docs`` (row, doc_id, held_out, text) as symbols, and what the counts say of them.

    ids: symbols of two bytes, the end last. base: sum of log10(c + 1) of the held words and
    the end. share: sum of the classes' words' log10 shares, but for the counts of words not
    held; those are in rare, with repeats. n_known: tokens with a count among the held.
    """
    v = vocabulary
    shared = docs.sparkSession.sparkContext.broadcast((v.place, v.counts, v.symbols, v.class_norm, v.texts))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        places, counts, symbols_of, class_norm, texts = shared.value
        # Of each held word and, last, of any other: log10(c + 1) and its part of the share.
        base_of = np.append(np.log10(counts + 1.0), 0.0)
        share_of = np.append(np.where(symbols_of > CLASSES, 0.0, base_of[:-1] - class_norm[np.minimum(symbols_of, CLASSES - 1)]), 0.0)
        place, unseen = places.get, len(symbols_of)

        def settle(batch: pa.RecordBatch, words: list[bytes], sizes: list[int]) -> pa.RecordBatch:
            size = np.array(sizes, dtype=np.int64)
            at = np.fromiter(map(place, words, repeat(unseen)), dtype=np.int64, count=len(words))
            text = np.repeat(np.arange(len(size)), size)
            far = np.flatnonzero(at == unseen)
            symbols = np.append(symbols_of, 0)[at].astype(np.uint16)
            symbols[far] = [_class_of(words[k]) for k in far]
            far_share = -class_norm[symbols[far]] if len(far) else np.zeros(0)
            per_text = [np.bincount(text, weights=w, minlength=len(size)).astype(float) for w in (base_of[at], share_of[at], at < unseen)]
            per_text[1] += np.bincount(text[far], weights=far_share, minlength=len(size))
            out = np.full(len(words) + len(size), CLASSES, dtype="<u2")
            out[np.arange(len(words)) + text] = symbols
            ends = np.concatenate([[0], np.cumsum(size + 1)])
            rare = np.concatenate([[0], np.cumsum(np.bincount(text[far], minlength=len(size)))])
            return pa.RecordBatch.from_arrays(
                [
                    batch.column(0), batch.column(1), batch.column(2), _binary(out, 2 * ends),
                    pa.array(per_text[0] + log10(texts + 1)), pa.array(per_text[1]), pa.array(per_text[2].astype(np.int64) + (texts > 0)), pa.array(size + 1),
                    pa.ListArray.from_arrays(pa.array(rare.astype(np.int32)), pa.array([words[k] for k in far], pa.binary()).cast(pa.string())),
                ],
                names=["row", "doc_id", "held_out", "ids", "base", "share", "n_known", "n_tokens", "rare"],
            )

        for batch in batches:
            words, sizes, begin = [], [], 0
            for k, text in enumerate(batch.column(3)):
                got = text_words(text.as_py())
                words += got
                sizes.append(len(got))
                if len(words) > BATCH_TOKENS or k == batch.num_rows - 1:
                    yield settle(batch.slice(begin, k + 1 - begin), words, sizes)
                    words, sizes, begin = [], [], k + 1

    schema = "row long, doc_id long, held_out boolean, ids binary, base double, share double, n_known long, n_tokens long, rare array<string>"
    return bounded(docs.select("row", "doc_id", "held_out", "text")).mapInArrow(run, schema)


def _binary(values: np.ndarray, ends: np.ndarray) -> pa.Array:
    return pa.Array.from_buffers(pa.binary(), len(ends) - 1, [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(values)])


def _flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All symbols of a binary column without nulls, and where each row's begin."""
    width = np.int64 if pa.types.is_large_binary(column.type) else np.int32
    ends = np.frombuffer(column.buffers()[1], dtype=width, count=len(column) + 1, offset=column.offset * np.dtype(width).itemsize).astype(np.int64)
    data = column.buffers()[2]
    flat = np.frombuffer(data, dtype=np.uint8)[ends[0] : ends[-1]].view("<u2") if data is not None and ends[-1] > ends[0] else np.zeros(0, "<u2")
    return flat, (ends - ends[0]) // 2


def segments(flat: np.ndarray, offsets: np.ndarray, longest: int | None) -> tuple[np.ndarray, np.ndarray]:
    """Starts and lengths of the sequences of ``flat``, cut to ``longest`` if given."""
    lengths = np.diff(offsets)
    starts = offsets[:-1]
    if longest is None:
        return starts, lengths
    parts = -(-lengths // longest)
    place = np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)
    cut_starts = np.repeat(starts, parts) + place * longest
    return cut_starts, np.minimum(longest, np.repeat(starts + lengths, parts) - cut_starts)


def _batches(lengths: np.ndarray) -> Iterator[np.ndarray]:
    """Positions of the sequences from the longest, some BATCH_TOKENS at a time."""
    order = np.argsort(-lengths, kind="stable")
    ends = np.cumsum(lengths[order])
    at = 0
    while at < len(order):
        stop = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + BATCH_TOKENS, side="right")))
        yield order[at:stop]
        at = stop


def log_likelihood(flat: np.ndarray, offsets: np.ndarray, start: np.ndarray, move: np.ndarray, emit: np.ndarray) -> np.ndarray:
    """log10 probability of each sequence by the scaled forward recursion.

    Sequences go through together, the longest first, so those still running at a step are
    the first ones. ``emit`` has a row for each symbol.
    """
    starts, lengths = segments(flat, offsets, None)
    out = np.zeros(len(lengths))
    for chosen in _batches(lengths):
        begin, size = starts[chosen], lengths[chosen]
        running = len(chosen) - np.searchsorted(size[::-1], np.arange(1, size[0] + 1), side="left")
        total = np.zeros(len(chosen))
        state = None
        for t in range(int(size[0])):
            n = running[t]
            state = (state[:n] @ move if t else np.tile(start, (n, 1))) * emit[flat[begin[:n] + t]]
            scale = state.sum(axis=1)
            state /= scale[:, None]
            total[:n] += np.log10(scale)
        out[chosen] = total
    return out


def expected_counts(
    flat: np.ndarray, offsets: np.ndarray, start: np.ndarray, move: np.ndarray, emit: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
    """Baum-Welch's expected counts of starts, moves and emissions, and the log10 likelihood.

    A cut text's later segments start from the state distribution that moves settle in.
    Memory is that of one state vector for each of BATCH_TOKENS tokens.
    """
    states = len(start)
    starts, lengths = segments(flat, offsets, SEGMENT)
    first = np.isin(starts, offsets[:-1])
    rest = np.full(states, 1.0 / states)
    for _ in range(50):
        rest = rest @ move
    move32, emit32, back_move = move.astype(np.float32), emit.astype(np.float32), np.ascontiguousarray(move.T.astype(np.float32))
    begins, moves, emits, likelihood = np.zeros(states), np.zeros((states, states)), np.zeros(emit.shape), 0.0
    for chosen in _batches(lengths):
        begin, size = starts[chosen], lengths[chosen]
        steps = int(size[0])
        running = len(chosen) - np.searchsorted(size[::-1], np.arange(1, steps + 1), side="left")
        ends = np.cumsum(running)
        # Step by step, of the sequences still running: symbol, state given the past, its scale.
        symbols = np.empty(ends[-1], dtype=np.int64)
        states_at = np.empty((ends[-1], states), dtype=np.float32)
        scales = np.empty((ends[-1], 1), dtype=np.float32)
        state = np.where(first[chosen][:, None], start, rest).astype(np.float32)
        for t in range(steps):
            n, at = running[t], slice(ends[t] - running[t], ends[t])
            symbols[at] = flat[begin[:n] + t]
            state = (state[:n] @ move32 if t else state) * emit32[symbols[at]]
            scales[at] = state.sum(axis=1, keepdims=True)
            state /= scales[at]
            states_at[at] = state
        likelihood += float(np.log10(scales, dtype=np.float64).sum())
        back = np.ones((running[-1], states), dtype=np.float32)
        for t in range(steps - 1, -1, -1):
            n, at = running[t], slice(ends[t] - running[t], ends[t])
            if len(back) < n:  # sequences that end here
                back = np.concatenate([back, np.ones((n - len(back), states), dtype=np.float32)])
            later = emit32[symbols[at]] * back / scales[at]
            if t:
                begun = ends[t - 1] - running[t - 1]
                moves += move * (states_at[begun : begun + n].T @ later)
            states_at[at] *= back  # from here on: the posterior
            back = later @ back_move
        begins += states_at[: running[0]][first[chosen]].sum(axis=0)
        for s in range(states):
            emits[:, s] += np.bincount(symbols, weights=states_at[:, s], minlength=len(emit))
    return begins, moves, emits, likelihood


def estimate(begins: np.ndarray, moves: np.ndarray, emits: np.ndarray, share: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Parameters from expected counts; ``share`` keeps every symbol possible in every state."""
    start = (begins + TRANSITION_PRIOR) / (begins + TRANSITION_PRIOR).sum()
    moves = moves + TRANSITION_PRIOR
    emits = emits + PRIOR * share[:, None]
    return start, moves / moves.sum(axis=1, keepdims=True), emits / emits.sum(axis=0, keepdims=True)


def starting_point(share: np.ndarray, states: int = STATES) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Parameters to begin with: sticky states that emit the corpus-wide shares times fixed noise."""
    noise = np.random.default_rng(7)
    move = np.full((states, states), 0.1 / states) + 0.9 * np.eye(states)
    emit = share[:, None] * noise.gamma(1.0, size=(len(share), states))
    return np.full(states, 1.0 / states), move, emit / emit.sum(axis=0)


def baum_welch(train: DataFrame, start: np.ndarray, move: np.ndarray, emit: np.ndarray, share: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """One pass over all of ``train`` (ids): expected counts in the tasks, their sums, new parameters.

    A task's emission counts leave it in blocks of symbols; each block is added up on its
    own, and only the sums, whose size is the model's, come to the driver.
    """
    states, block = len(start), 2048
    shared = train.sparkSession.sparkContext.broadcast((start, move, emit))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        start, move, emit = shared.value
        sums = [np.zeros(states), np.zeros((states, states)), np.zeros((len(emit), states))]
        any_rows = False
        for batch in batches:
            if batch.num_rows:
                any_rows = True
                for total, got in zip(sums, expected_counts(*_flat(batch.column(0)), start, move, emit)):
                    total += got
        if any_rows:
            rows = [np.concatenate([sums[0][None], sums[1]])] + [sums[2][k : k + block] for k in range(0, len(emit), block)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(len(rows)), pa.int32()), pa.array([x.astype(np.float32).tobytes() for x in rows], pa.binary())], names=["block", "sums"]
            )

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for k, raw in zip(batch.column(0).to_pylist(), batch.column(1)):
                part = np.frombuffer(raw.as_buffer(), dtype=np.float32)
                total[k] = total[k] + part if k in total else part.astype(np.float64)
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(total), pa.int32()), pa.array([x.tobytes() for x in total.values()], pa.binary())], names=["block", "sums"]
        )

    parts = bounded(train.select("ids")).mapInArrow(run, "block int, sums binary")
    blocks = -(-len(emit) // block) + 1
    added = parts.repartition(blocks, "block").mapInArrow(add, "block int, sums binary").collect()
    sums = {r.block: np.frombuffer(bytes(r.sums), dtype=np.float64) for r in added}
    if not sums:
        return start, move, emit
    head = sums[0].reshape(states + 1, states)
    emits = np.concatenate([sums[k].reshape(-1, states) for k in range(1, blocks)])
    return estimate(head[0], head[1:], emits, share)


def rare_counts(encoded: DataFrame, counts: DataFrame) -> DataFrame:
    """(rare_row, rare_base, rare_known) of the rows with words whose counts the tasks did not hold."""
    words = encoded.where(F.size("rare") > 0).select("row", F.explode("rare").alias("rare_word"))
    uses = words.groupBy("row", "rare_word").agg(F.count(F.lit(1)).alias("n"))
    joined = uses.join(counts, uses.rare_word == counts.word)
    return joined.groupBy(F.col("row").alias("rare_row")).agg(
        F.sum(F.col("n") * F.log10(F.col("c") + 1)).alias("rare_base"), F.sum("n").alias("rare_known")
    )


def score_documents(docs: DataFrame, held: Column) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every row of ``docs``.

    Rows where ``held`` is true are scored but not learned from. A null text is empty: its
    one token is the end. Rows may repeat; each is learned from and scored on its own.
    Texts of any length are scored whole, their memory being that of their symbols. Extra
    columns are left out. Words with equal counts are treated alike, and the result does not
    depend on how the rows lie in files (but for the last digits of sums). An empty table
    gives no rows.
    """
    chosen = docs.select(
        F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(held, F.lit(False)).alias("held_out"), F.col("text").cast("string").alias("text"),
    )
    train = chosen.where("NOT held_out")
    counts = stash(word_counts(train), "lm-counts")
    vocabulary = gather(counts, train.count())
    encoded = stash(encode(chosen, vocabulary), "lm-encoded")
    learned = encoded.where("NOT held_out")
    start, move, emit = starting_point(vocabulary.share)
    for _ in range(PASSES):
        start, move, emit = baum_welch(learned, start, move, emit, vocabulary.share)
    shared = docs.sparkSession.sparkContext.broadcast((start, move, emit))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Sequences of several batches go through together: a batch takes as many steps as its longest one.
        held: list[pa.RecordBatch] = []
        tokens = 0

        def settle() -> pa.RecordBatch:
            parts = [_flat(b.column(1)) for b in held]
            sizes = np.concatenate([np.diff(offsets) for _, offsets in parts])
            got = log_likelihood(np.concatenate([flat for flat, _ in parts]), np.concatenate([[0], np.cumsum(sizes)]), *shared.value)
            rows = pa.Table.from_batches(held).drop_columns("ids").combine_chunks().to_batches()[0]
            return pa.RecordBatch.from_arrays([rows.column(0), pa.array(got), *rows.columns[1:]], names=["row", "hmm", *rows.schema.names[1:]])

        for batch in batches:
            if batch.num_rows:
                held.append(batch)
                tokens += len(_flat(batch.column(1))[0])
            if tokens > SCORE_TOKENS:
                yield settle()
                held.clear()
                tokens = 0
        if held:
            yield settle()

    kept = "doc_id long, held_out boolean, base double, share double, n_known long, n_tokens long"
    scored = encoded.select("row", "ids", "doc_id", "held_out", "base", "share", "n_known", "n_tokens").transform(bounded).mapInArrow(run, f"row long, hmm double, {kept}")
    rare = rare_counts(encoded, counts)
    joined = scored.join(rare, scored.row == rare.rare_row, "left")
    extra = F.coalesce("rare_base", F.lit(0.0))
    out = stash(
        joined.select(
            "doc_id",
            "held_out",
            "n_tokens",
            (F.col("n_known") + F.coalesce("rare_known", F.lit(0))).cast("long").alias("n_known"),
            F.lit(vocabulary.tokens).cast("long").alias("train_tokens"),
            (F.col("base") + extra - F.col("n_tokens") * vocabulary.norm()).alias("base_score"),
            (F.col("hmm") + F.col("share") + extra).alias("score"),
        ),
        "lm-scores",
    )
    discard(counts, encoded)
    return out


def op7_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log probability of all documents under the model and under the base."""
    held = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(7)) == 2
    return score_documents(table(spark, sf_dir, "documents"), held)
