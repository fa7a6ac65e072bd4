"""Language identification by prediction by partial matching.

Every language has a context tree of byte contexts up to ``order`` bytes. The code length of
a byte is that of its longest known context, with an escape to the next shorter one (method
C: a context with n bytes seen and d distinct ones escapes with probability d / (n + d)),
down to the uniform distribution. Statistics are frozen after training, so all costs are
tabulated once, for what was seen only: a text's score is a sum of table look-ups. No
context and no byte after it is left out, whatever its count or its language's share.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import bounded, table

ORDER = 3
#: Bytes of statistics that one training task holds before it passes counts on.
TRAIN_BYTES = 4 << 20
#: Bytes of text scored at once.
SCORE_BYTES = 1 << 20


def _grams(data: np.ndarray, order: int) -> np.ndarray:
    """For each byte, the ``order`` bytes before it and itself as one number; the text starts after zeros."""
    padded = np.concatenate([np.zeros(order, dtype=np.uint8), data]).astype(np.uint32)
    out = np.zeros(len(data), dtype=np.uint32)
    for k in range(order + 1):
        out = (out << 8) | padded[k : k + len(data)]
    return out


def gram_counts(train: DataFrame, order: int = ORDER) -> DataFrame:
    """(lang, gram, n): how often each byte follows each context of ``order`` bytes.

    ``train`` has lang and text. Counts are summed inside tasks before they are shuffled.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[np.ndarray]] = {}
        size: dict[str, int] = {}

        def flush(lang: str) -> pa.RecordBatch:
            grams, n = np.unique(np.concatenate(held.pop(lang)), return_counts=True)
            size.pop(lang)
            return pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(grams)), pa.array(grams.astype(np.int64)), pa.array(n.astype(np.int64))],
                names=["lang", "gram", "n"],
            )

        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                data = np.frombuffer((text.as_py() or "").encode(), dtype=np.uint8)
                held.setdefault(lang, []).append(_grams(data, order))
                size[lang] = size.get(lang, 0) + len(data)
                if size[lang] > TRAIN_BYTES:
                    yield flush(lang)
        for lang in list(held):
            yield flush(lang)

    counts = bounded(train.select("lang", "text")).mapInArrow(run, "lang string, gram long, n long")
    return counts.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


@dataclass
class Model:
    """Frozen statistics: for each language and order the known contexts and grams, sorted, with their bits.

    ``levels[lang][k]`` is (contexts of k bytes, bits of their escapes, grams of k + 1
    bytes, bits of their last bytes).
    """

    langs: list[str]
    levels: list[list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]]
    order: int


def _level(grams: np.ndarray, n: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The table of one language's contexts of ``k`` bytes."""
    known, at = np.unique(grams & np.uint32((1 << 8 * (k + 1)) - 1), return_inverse=True)
    times = np.bincount(at, weights=n, minlength=len(known))
    contexts, of = np.unique(known >> np.uint32(8), return_inverse=True)
    total = np.bincount(of, weights=times, minlength=len(contexts))
    kinds = np.bincount(of, minlength=len(contexts))
    escapes = -np.log2(kinds / (total + kinds))
    direct = -np.log2(times / (total + kinds)[of])
    return contexts, escapes.astype(np.float32), known, direct.astype(np.float32)


def tabulate(counts: dict[str, tuple[np.ndarray, np.ndarray]], order: int = ORDER) -> Model:
    """Model of each language's distinct grams (uint32) and how often each occurs."""
    langs = sorted(counts)
    return Model(langs, [[_level(*counts[lang], k) for k in range(order + 1)] for lang in langs], order)


def freeze(counts: list[tuple[str, int, int]], order: int = ORDER) -> Model:
    """Model of (lang, gram, n) rows."""
    grams: dict[str, list[tuple[int, int]]] = {}
    for lang, g, n in counts:
        grams.setdefault(lang, []).append((g, n))
    return tabulate({lang: (np.array([g for g, _ in x], dtype=np.uint32), np.array([n for _, n in x], dtype=np.float64)) for lang, x in grams.items()}, order)


def _find(known: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where sorted ``known`` has each of ``wanted``, and whether it does."""
    at = np.minimum(np.searchsorted(known, wanted), len(known) - 1)
    return at, known[at] == wanted


def gram_bits(model: Model, lang: int, grams: np.ndarray) -> np.ndarray:
    """Bits of the last byte of each gram.

    A context that the language does not know passes on to the next shorter one without an
    escape; a known one that has not seen the byte adds its escape.
    """
    bits = np.full(len(grams), 8.0)  # order -1: uniform
    for k, (contexts, escapes, known, direct) in enumerate(model.levels[lang]):
        gram = grams & np.uint32((1 << 8 * (k + 1)) - 1)
        at, there = _find(contexts, gram >> np.uint32(8))
        bits += np.where(there, escapes[at], 0.0)
        at, there = _find(known, gram)
        bits = np.where(there, direct[at], bits)
    return bits


def code_lengths_of(model: Model, texts: list[bytes]) -> np.ndarray:
    """Bits of each text (not empty) under each language, a row for each text.

    Every distinct gram of the texts is looked up once.
    """
    grams, at = np.unique(np.concatenate([_grams(np.frombuffer(t, dtype=np.uint8), model.order) for t in texts]), return_inverse=True)
    starts = np.cumsum([0, *map(len, texts[:-1])])
    return np.stack([np.add.reduceat(gram_bits(model, lang, grams)[at], starts) for lang in range(len(model.langs))], axis=1)


def code_lengths(model: Model, data: bytes) -> np.ndarray:
    """Bits of ``data`` under each language; long texts go through in pieces with their history."""
    total = np.zeros(len(model.langs))
    for at in range(0, len(data), SCORE_BYTES):
        head = max(0, at - model.order)
        grams, n = np.unique(_grams(np.frombuffer(data[head : at + SCORE_BYTES], dtype=np.uint8), model.order)[at - head :], return_counts=True)
        total += [gram_bits(model, lang, grams) @ n for lang in range(len(model.langs))]
    return total


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, lang_pred, score) of every row of ``docs`` (doc_id, text).

    The score is the predicted language's posterior with equal priors. Text that is null or
    has no letter, and any text when nothing was learned, is ``und`` with score 0. Texts are
    scored whole; a very long one goes through in pieces whose costs add up. Languages of
    equal cost go to the first by name. Repeated rows are scored alike; extra columns are left
    out; an empty table gives no rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast((model.langs, model.levels, model.order))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = Model(*shared.value)
        for batch in batches:
            langs, scores = ["und"] * batch.num_rows, [0.0] * batch.num_rows

            def settle(rows: list[int], bits: Iterable[np.ndarray]) -> None:
                for k, x in zip(rows, bits):
                    best = int(np.argmin(x))
                    langs[k] = m.langs[best]
                    scores[k] = float(1 / np.exp2(np.maximum(x[best] - x, -1000.0)).sum())

            rows, texts, size = [], [], 0
            for k, letter in enumerate(batch.column(2).to_pylist() if m.langs else ()):
                if not letter:
                    continue
                data = batch.column(1)[k].as_py().encode()
                if len(data) > SCORE_BYTES:
                    settle([k], [code_lengths(m, data)])
                    continue
                rows.append(k)
                texts.append(data)
                size += len(data)
                if size > SCORE_BYTES:
                    settle(rows, code_lengths_of(m, texts))
                    rows, texts, size = [], [], 0
            if rows:
                settle(rows, code_lengths_of(m, texts))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(langs, pa.string()), pa.array(scores, pa.float64())], names=["doc_id", "lang_pred", "score"]
            )

    text = F.col("text").cast("string")
    chosen = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), F.coalesce(text.rlike(r"\p{L}"), F.lit(False)).alias("letter"))
    return bounded(chosen).mapInArrow(run, "doc_id long, lang_pred string, score double")


def learn(train: DataFrame, order: int = ORDER) -> Model:
    """Model of ``train`` (lang, text); rows with a null in either are left out, repeated ones count each time.

    The counts cover every training row, and all of them come to the driver: one number for
    each language and byte sequence of order + 1, a set that the bytes of the languages bound.
    """
    rows = gram_counts(train.where("lang IS NOT NULL AND text IS NOT NULL"), order)
    got = rows.toArrow()
    langs = got.column("lang").combine_chunks().dictionary_encode()
    if isinstance(langs, pa.ChunkedArray):
        langs = langs.combine_chunks()
    code = langs.indices.to_numpy(zero_copy_only=False)
    grams, n = got.column("gram").to_numpy().astype(np.uint32), got.column("n").to_numpy().astype(np.float64)
    return tabulate({lang: (grams[code == k], n[code == k]) for k, lang in enumerate(langs.dictionary.to_pylist())}, order)


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language of all documents, learned from those not held out."""
    docs = table(spark, sf_dir, "documents")
    held = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(4)) == 2
    train = docs.where(~held | held.isNull()).select("lang", "text")
    got = predict(docs.select("doc_id", "text"), learn(train))
    return got.select("doc_id", F.coalesce(held, F.lit(False)).alias("held_out"), "lang_pred", "score")
