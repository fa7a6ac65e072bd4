"""Toxicity by a weighted finite-state pattern grammar.

A lexicon gives words their class: insult (learned stems), threat, target, negation or
reporting verb. Four small transducers read a clause of classes and are composed into one:
the first marks what a negation is in force for, the second what is reported speech, the
third whether the clause names a target, before or after; the last picks one insult or
threat and writes the reading it stands in. The weight of a path is the picked word's weight
times that of its reading. The weights of all paths of a text add up to the rate S at which
it gives offence, and 1 - exp(-S) is its score (a noisy or over matched clauses). Weights of
words and readings are learned from labelled rows by expectation and maximization.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from math import exp, log

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import bounded, discard, stash, table
from .simhash import fingerprints
from .transducers import Reader, Transducer, compose

#: Most labelled documents that the grammar is fitted on, in hash order of doc_id.
FIT_ROWS = 20_000
#: Most stems of the learned lexicon, and the shortest and longest of them.
STEMS, STEM_FROM, STEM_TO = 2_000, 3, 14
#: Words that a negation stays in force for.
REACH = 3
#: Words whose classes, and clauses whose readings, a worker remembers.
CACHE_WORDS, CACHE_CLAUSES = 200_000, 20_000
#: Readings are learned from what the labels show, beside PRIOR_USES uses at these weights; a
#: word beside one use at weight WORD_PRIOR.
PRIOR_USES, WORD_PRIOR = 20.0, 0.5
INSULT_PRIOR, THREAT_PRIOR, TARGET_PRIOR, NEGATED_PRIOR, REPORTED_PRIOR = 0.9, 0.1, 1.1, 0.3, 0.5
ROUNDS = 200

# Closed-class words of the grammar.
TARGETS = "you your yours u he him his she her they them their we us our people everyone tu te toi vous votre ils elle eux du dich dir ihr euch sie er ustedes usted tú ti él ella ellos"
NEGATIONS = "not no never none nobody neither nor without isn't aren't don't doesn't pas jamais aucun nicht nie kein keine ningún nunca jamás sin"
REPORTS = "said says say told tells wrote writes called calls claimed claims quoted quotes reported according dit disait écrit sagte sagt schrieb nannte dijo dice escribió llamó"
THREATS = "kill killing hurt destroy beat burn shoot stab murder hang strangle tuer frapper détruire töten schlagen umbringen matar golpear destruir"

TOKEN = re.compile(r"[^\W\d_]+(?:'[^\W\d_]+)?|[.!?;:\n]")
BREAKS = frozenset(".!?;:\n")
PLAIN, TARGET, NEGATION, REPORT, THREAT, INSULT = range(6)
BREAK = -1
#: A reading: (threat or insult, negated, reported, with a target).
READINGS = [(kind, n, r, t) for kind in (INSULT, THREAT) for n in (False, True) for r in (False, True) for t in (False, True)]


def negations() -> Transducer:
    """Writes hits as (kind, negated): a negation holds for the REACH words after it."""
    arcs = {}
    for left in range(REACH + 1):
        after = max(0, left - 1)
        arcs[left] = [(x, x, 1.0, after) for x in (PLAIN, TARGET, REPORT)]
        arcs[left] += [(x, (x, left > 0), 1.0, after) for x in (THREAT, INSULT)] + [(NEGATION, NEGATION, 1.0, REACH)]
    return Transducer(arcs, 0, frozenset(arcs))


def reports() -> Transducer:
    """Adds to hits whether a reporting verb comes before them in the clause."""
    hits = [(k, n) for k in (THREAT, INSULT) for n in (False, True)]
    arcs = {}
    for said in (False, True):
        arcs[said] = [(x, x, 1.0, said) for x in (PLAIN, TARGET, NEGATION)] + [(REPORT, REPORT, 1.0, True)]
        arcs[said] += [(h, (*h, said), 1.0, said) for h in hits]
    return Transducer(arcs, False, frozenset(arcs))


def targets() -> Transducer:
    """Adds to hits whether the clause names a target anywhere: guessed at the start, proved by the end."""
    hits = [(k, n, r) for k in (THREAT, INSULT) for n in (False, True) for r in (False, True)]
    others = (PLAIN, NEGATION, REPORT)

    def plain(to: str, has: bool) -> list:
        return [(x, x, 1.0, to) for x in others] + [(h, (*h, has), 1.0, to) for h in hits]

    arcs = {
        "none": plain("none", False),
        "due": plain("due", True) + [(TARGET, TARGET, 1.0, "named")],
        "named": plain("named", True) + [(TARGET, TARGET, 1.0, "named")],
    }
    arcs["begin"] = arcs["none"] + arcs["due"]
    return Transducer(arcs, "begin", frozenset({"begin", "none", "named"}))


def choice(weights: dict[tuple, float]) -> Transducer:
    """Picks one hit, whose reading it writes at the reading's weight; all else it drops."""
    arcs = {}
    for done in (False, True):
        arcs[done] = [(x, None, 1.0, done) for x in (PLAIN, TARGET, NEGATION, REPORT)] + [(r, None, 1.0, done) for r in READINGS]
    arcs[False] += [(r, r, weights[r], True) for r in READINGS]
    return Transducer(arcs, False, frozenset({True}))


def grammar(weights: dict[tuple, float]) -> Transducer:
    """The clause transducer: classes in, the reading of one hit out."""
    return compose(compose(compose(negations(), reports()), targets()), choice(weights))


def word_class(word: str, stems: set[str], closed: dict[str, int]) -> tuple[int, str]:
    """Class and lexicon entry of a lower-case word: the longest learned stem it starts with, else its closed class."""
    for k in range(min(len(word), STEM_TO), STEM_FROM - 1, -1):
        if word[:k] in stems:
            return INSULT, word[:k]
    return closed.get(word, PLAIN), word


class Matcher:
    """Finds the hits of a text and their readings; remembers words and clauses met before."""

    def __init__(self, stems: set[str]) -> None:
        lists = ((TARGETS, TARGET), (NEGATIONS, NEGATION), (REPORTS, REPORT), (THREATS, THREAT))
        self.closed = {w: kind for words, kind in lists for w in words.split()}
        self.stems = stems
        self.reader = Reader(grammar(dict.fromkeys(READINGS, 1.0)))
        self.words: dict[str, tuple[int, str]] = {}
        self.clauses: dict[tuple[int, ...], list[tuple]] = {}

    def class_of(self, word: str) -> tuple[int, str]:
        got = self.words.get(word)
        if got is None:
            if len(self.words) > CACHE_WORDS:
                self.words.clear()
            got = self.words[word] = (BREAK, word) if word in BREAKS else word_class(word, self.stems, self.closed)
        return got

    def readings(self, classes: list[int]) -> list[tuple]:
        """The reading of every hit of a clause, in order. More than REACH plain words in a row are as REACH."""
        short: list[int] = []
        for x in classes:
            if x != PLAIN or short[-REACH:] != [PLAIN] * REACH:
                short.append(x)
        key = tuple(short)
        got = self.clauses.get(key)
        if got is None:
            places = [k for k, x in enumerate(short) if x >= THREAT]
            # Of the paths that pick this hit one alone ends well: its reading is what they write there.
            got = [next(r for r in found if r is not None) for found in self.reader.written(short, places)]
            if len(key) <= 40:
                if len(self.clauses) > CACHE_CLAUSES:
                    self.clauses.clear()
                self.clauses[key] = got
        return got

    def hits(self, text: str) -> Iterator[list[tuple[str, tuple]]]:
        """(lexicon entry, reading) of the hits of every clause that has any."""
        tokens = TOKEN.findall(text.lower())
        class_of = self.class_of
        if not any(class_of(w)[0] >= THREAT for w in set(tokens)):
            return
        clause: list[tuple[int, str]] = []
        for word in [*tokens, "\n"]:
            got = class_of(word)
            if got[0] != BREAK:
                clause.append(got)
                continue
            entries = [entry for kind, entry in clause if kind >= THREAT]
            if entries:
                yield list(zip(entries, self.readings([kind for kind, _ in clause])))
            clause = []


def labelled(docs: DataFrame, labels: DataFrame, most: int = FIT_ROWS) -> DataFrame:
    """(text, toxic) of at most ``most`` labelled documents, copies once.

    The label rows are cut first, so what is broadcast has at most ``most`` rows. Rows with
    a null id, label or text are left out; contradicting labels of one id count as toxic.
    Texts of one fingerprint are copies; of these one toxic and one clean text count, so that
    a text copied a thousand times says no more than any other.
    """
    chosen = (
        labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL")
        .groupBy(F.col("doc_id").cast("long").alias("label_id"))
        .agg((F.max("toxic") > 0).cast("int").alias("toxic"))
        .orderBy(F.xxhash64("label_id"), "label_id")
        .limit(most)
    )
    texts = docs.where("text IS NOT NULL").select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    joined = texts.join(F.broadcast(chosen), texts.doc_id == chosen.label_id)
    once = joined.groupBy(F.xxhash64("text").alias("h"), "text").agg(F.max("toxic").alias("toxic"))
    numbered = stash(once.select(F.monotonically_increasing_id().alias("doc_id"), "text", "toxic"), "toxic-texts")
    prints = fingerprints(numbered.select("doc_id", "text")).withColumnRenamed("doc_id", "print_id")
    marked = numbered.join(prints, F.col("doc_id") == F.col("print_id"))
    return marked.groupBy("fp", "toxic").agg(F.min("text").alias("text")).select("text", "toxic")


def stem_counts(sample: DataFrame) -> DataFrame:
    """(stem, n_toxic, n_clean): documents with a word that starts with the stem."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: tuple[dict[str, int], dict[str, int]] = ({}, {})
        for batch in batches:
            for text, toxic in zip(batch.column(0), batch.column(1).to_pylist()):
                words = {w for w in TOKEN.findall(text.as_py().lower()) if len(w) >= STEM_FROM}
                own = seen[int(toxic > 0)]
                for stem in {w[:k] for w in words for k in range(STEM_FROM, min(len(w), STEM_TO) + 1)}:
                    own[stem] = own.get(stem, 0) + 1
        keys = list(seen[0] | seen[1])
        for at in range(0, len(keys), 100_000):
            part = keys[at : at + 100_000]
            yield pa.RecordBatch.from_arrays(
                [pa.array(part, pa.string()), *(pa.array([d.get(k, 0) for k in part], pa.int64()) for d in (seen[1], seen[0]))],
                names=["stem", "n_toxic", "n_clean"],
            )

    counts = bounded(sample).mapInArrow(run, "stem string, n_toxic long, n_clean long")
    return counts.groupBy("stem").agg(F.sum("n_toxic").alias("n_toxic"), F.sum("n_clean").alias("n_clean"))


def choose_stems(counts: list[tuple[str, int, int]], toxic: int, clean: int, stems: int) -> dict[str, float]:
    """Stems with weights from (stem, n_toxic, n_clean), ``stems`` candidates having been tried.

    A stem enters if its share of toxic documents beats the base rate by more than chance
    among all candidates allows (threefold, and a likelihood ratio against their number), if no letter
    more keeps nearly all its toxic documents, and if it says clearly more than every shorter
    stem of it that has entered. A word counts as the longest stem that it starts with.
    """
    base = max(1, toxic) / max(2, toxic + clean)
    found = {s: (t, c) for s, t, c in counts}
    longer: dict[str, int] = {}
    for s, (t, _) in found.items():
        longer[s[:-1]] = max(longer.get(s[:-1], 0), t)
    kept: dict[str, float] = {}
    for s in sorted(found, key=lambda x: (len(x), x)):
        t, c = found[s]
        rate = t / (t + c)
        gain = t * log(rate / base) + (c * log((1 - rate) / (1 - base)) if c else 0.0)
        if rate < 3 * base or gain < log(max(2, stems)) or longer.get(s, 0) >= 0.95 * t:
            continue
        weight = log((t + 0.5) / (toxic + 1)) - log((c + 0.5) / (clean + 1))
        if weight >= 0.7 + max((kept[s[:k]] for k in range(STEM_FROM, len(s)) if s[:k] in kept), default=0.0):
            kept[s] = weight
    return dict(sorted(kept.items(), key=lambda x: -x[1])[:STEMS])


def text_hits(docs: DataFrame, stems: set[str], keep: str, kind: str) -> DataFrame:
    """``keep`` (a column of ``docs``) and the hits of its text: entry, reading (its number), uses."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher, number = Matcher(stems), {r: k for k, r in enumerate(READINGS)}
        for batch in batches:
            rows = []
            for text in batch.column(1):
                uses = Counter((entry, number[reading]) for clause in matcher.hits(text.as_py() or "") for entry, reading in clause)
                rows.append([{"entry": e, "reading": r, "uses": n} for (e, r), n in uses.items()])
            kinds = pa.list_(pa.struct([("entry", pa.string()), ("reading", pa.int32()), ("uses", pa.int64())]))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, kinds)], names=[keep, "hits"])

    return bounded(docs.select(keep, "text")).mapInArrow(run, f"{keep} {kind}, hits array<struct<entry:string,reading:int,uses:long>>")


def prior_of(reading: tuple) -> float:
    """What a reading weighs before any label: less if negated or reported, a threat little without a target."""
    kind, negated, reported, target = reading
    weight = INSULT_PRIOR if kind == INSULT else THREAT_PRIOR
    if target:
        weight = TARGET_PRIOR
    return weight * (NEGATED_PRIOR if negated else 1.0) * (REPORTED_PRIOR if reported else 1.0)


def fit_weights(text: np.ndarray, entry: np.ndarray, reading: np.ndarray, uses: np.ndarray, toxic: np.ndarray, entries: int) -> tuple[np.ndarray, np.ndarray, float]:
    """Weights of words and readings, and the rate of texts toxic for no word seen.

    Hit k is in text ``text[k]``; ``toxic`` is the texts' label. A text gives offence a
    Poisson number of times, at the rate of its paths' weights and the rest, and is toxic if
    it does at all. The expected offences of each hit, given the labels, set the next
    weights: offences by uses.
    """
    prior = np.array([prior_of(r) for r in READINGS])
    words, readings, rest = np.full(entries, WORD_PRIOR), prior.copy(), max(1e-4, 0.1 * float(np.mean(toxic)))
    for _ in range(ROUNDS):
        for turn in range(2):
            rate = uses * words[entry] * readings[reading]
            total = np.bincount(text, weights=rate, minlength=len(toxic)) + rest
            given = np.where(toxic, 1.0 / -np.expm1(-total), 0.0)
            offences = rate * given[text]
            if turn == 0:
                words = (np.bincount(entry, weights=offences, minlength=entries) + WORD_PRIOR) / (np.bincount(entry, weights=uses * readings[reading], minlength=entries) + 1.0)
                rest = max(1e-6, rest * given.sum() / max(1, len(toxic)))
            else:
                readings = (np.bincount(reading, weights=offences, minlength=len(prior)) + PRIOR_USES * prior) / (
                    np.bincount(reading, weights=uses * words[entry], minlength=len(prior)) + PRIOR_USES
                )
    return words, readings, rest


def learn(docs: DataFrame, labels: DataFrame, most: int = FIT_ROWS) -> tuple[dict[str, float], list[float], float]:
    """Weights of the lexicon's entries and of the readings, and the rest rate (all of ``labels`` may be used).

    Without a toxic or without a clean text there is nothing to tell apart: the lexicon is
    empty, and all texts get one score, below a half unless all labels are toxic.
    """
    sample = stash(labelled(docs, labels, most), "toxic-sample")
    sizes = {r.toxic: int(r["count"]) for r in sample.groupBy("toxic").count().collect()}
    toxic, clean = sizes.get(1, 0), sizes.get(0, 0)
    if not toxic or not clean:
        discard(sample)
        return {}, [prior_of(r) for r in READINGS], 4.0 if toxic else 0.01
    counts = stash(stem_counts(sample), "toxic-stems")
    tried = counts.count()
    likely = counts.where(F.col("n_toxic") >= F.greatest(F.lit(3.0), F.col("n_clean") * (3 * toxic / clean))).orderBy(F.desc("n_toxic"), "stem").limit(50 * STEMS)
    stems = set(choose_stems([tuple(r) for r in likely.collect()], toxic, clean, tried))
    rows = text_hits(sample, stems, "toxic", "int").toArrow()
    discard(sample, counts)
    label = rows.column("toxic").to_numpy() > 0
    per_text = rows.column("hits").combine_chunks()
    text = np.repeat(np.arange(len(label)), np.diff(per_text.offsets.to_numpy()))
    flat = per_text.flatten()
    entries, entry = np.unique(np.array([*flat.field("entry").to_pylist(), *THREATS.split()], dtype=object), return_inverse=True)
    words, readings, rest = fit_weights(text, entry[: len(text)], flat.field("reading").to_numpy(), flat.field("uses").to_numpy().astype(float), label, len(entries))
    return dict(zip(entries.tolist(), words.tolist())), readings.tolist(), rest


def score(docs: DataFrame, words: dict[str, float], readings: list[float], rest: float) -> DataFrame:
    """(doc_id, score, n_clauses) of every row of ``docs`` (doc_id, text).

    ``n_clauses`` are the clauses that are enough by themselves for a score of a half. A null
    text counts as empty; an empty one has the score of the rest rate. Repeated rows are
    scored alike. Texts of any length are read whole, clause by clause, in time and memory
    that follow their length. Extra columns are left out. An empty table gives no rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast((words, readings, rest))
    number = {r: k for k, r in enumerate(READINGS)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, readings, rest = shared.value
        threats = set(THREATS.split())
        matcher = Matcher({w for w in words if w not in threats})
        for batch in batches:
            scores, clauses = [], []
            for text in batch.column(1):
                rates = [sum(words.get(e, 0.0) * readings[number[r]] for e, r in clause) for clause in matcher.hits(text.as_py() or "")]
                scores.append(1.0 - exp(-(rest + sum(rates))))
                clauses.append(sum(x >= log(2) for x in rates))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores, pa.float64()), pa.array(clauses, pa.int64())], names=["doc_id", "score", "n_clauses"])

    chosen = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return bounded(chosen).mapInArrow(run, "doc_id long, score double, n_clauses long")


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of all documents, learned from the labels not held out."""
    docs = table(spark, sf_dir, "documents")
    held = F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(5)) == 0, F.lit(False))
    labels = table(spark, sf_dir, "labels").where(~held)
    got = score(docs, *learn(docs, labels))
    return got.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "n_clauses")
