"""Toxicity by a weighted finite-state pattern grammar over clauses.

Words are first rewritten to classes: insult I, threat T, target G, negation N, reported speech R, other o. A chain of
small transducers then rewrites the classes of a clause: one marks insults and threats in the scope of a negation, one
those that stand in reported speech, one those with a target before them or after them. Their composition is one machine
whose output symbols are kinds of matched events (a bare insult, an aimed threat, a negated or reported one, ...). Weights
of the kinds are learned by logistic regression; a document's score is the logistic of its weighted events.

Insult words and stems are learned from labelled documents beside a small list of fixed ones: a word, or the first four to
six bytes of words, counts as one if toxic documents hold it far more often than others (likelihood ratio).
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches, fold, gives_back, local_table
from .textbytes import ALNUM, U64, buffers, key_of, slices, words

#: The sample: at most so many labelled documents (by a hash of the id) teach the lexicon and the weights.
TRAIN_DOCUMENTS = 6000
#: Least likelihood ratio (G squared) and least documents of a learned insult; most learned ones; lengths of stems.
LEAST_RATIO, LEAST_DOCUMENTS, MOST_LEARNED, STEMS = 28.0, 4, 400, (4, 5, 6)
#: Words after a negation that it governs.
SCOPE = 3

# Words of each class.
INSULTS = "idiot idiots stupid moron morons dumb loser losers scum trash worthless pathetic disgusting clown imbecile fool vermin garbage filth".split()
THREATS = "kill hurt destroy beat punch stab shoot burn murder strangle crush bury".split()
TARGETS = "you your yours yourself he him his she her hers they them their".split()
NEGATIONS = "not no never none neither nor without isn aren wasn doesn don didn".split()
REPORTS = "said says say told tell tells wrote writes called calls quote quotes quoted reported claims claimed alleged".split()

CLAUSE_ENDS = np.isin(np.arange(256), list(b".,;:!?\n\r()[]{}\""))


class Machine(NamedTuple):
    """A transducer that writes one symbol for each symbol it reads: step(state, symbol) -> (state, symbol)."""

    start: object
    step: object


def compose(first: Machine, second: Machine) -> Machine:
    """The machine that gives first's output to second."""

    def step(state, symbol):
        a, middle = first.step(state[0], symbol)
        b, out = second.step(state[1], middle)
        return (a, b), out

    return Machine((first.start, second.start), step)


def _negation(left: int, symbol: str) -> tuple[int, str]:
    """The state is how many words the last negation still governs."""
    if symbol[0] == "N":
        return SCOPE, symbol
    return max(0, left - 1), symbol + "-" if left and symbol[0] in "IT" else symbol


def _reported(seen: bool, symbol: str) -> tuple[bool, str]:
    """After a verb of speech, what is said belongs to someone else."""
    return seen or symbol[0] == "R", symbol + "'" if seen and symbol[0] in "IT" else symbol


def _aimed(state: tuple[bool, str], symbol: str) -> tuple[tuple[bool, str], str]:
    """An event after a target is aimed; a target after an unaimed event aims it then, written as the event's pair."""
    target, event = state
    if symbol[0] in "IT":
        return (target, "" if target else symbol), symbol + "@" if target else symbol
    if symbol[0] == "G":
        return (True, ""), ">" + event if event else symbol
    return state, symbol


GRAMMAR = compose(compose(Machine(0, _negation), Machine(False, _reported)), Machine((False, ""), _aimed))
#: What the composed machine can write for an event.
EVENTS = [x + neg + rep + aim for x in "IT" for neg in ("", "-") for rep in ("", "'") for aim in ("", "@")] + [">" + x + neg + rep for x in "IT" for neg in ("", "-") for rep in ("", "'")]


class Matcher:
    """The grammar's table, filled when a transition is first met, and class lookup by word keys."""

    def __init__(self, learned: list[bytes], stems: list[bytes]):
        self.words = [np.unique(np.array([key_of(w) for w in ws], U64)) for ws in ([*INSULTS, *learned], THREATS, TARGETS, NEGATIONS, REPORTS)]
        self.stems = {n: np.unique(np.array([key_of(s) for s in stems if len(s) == n], U64)) for n in STEMS}
        self.table: dict = {}

    def classes(self, w) -> np.ndarray:
        found = np.full(len(w.key), ord("o"), np.uint8)
        for n, keys in self.stems.items():
            if len(keys):
                found[_member(w.prefix_key(n), keys) & (w.end - w.start >= n)] = ord("I")
        for symbol, keys in reversed([*zip("ITGNR", self.words)]):
            found[_member(w.key, keys)] = ord(symbol)
        return found

    def events(self, symbols: str) -> list[str]:
        state, out = GRAMMAR.start, []
        for symbol in symbols:
            made = self.table.get((state, symbol))
            if made is None:
                made = self.table[state, symbol] = GRAMMAR.step(state, symbol)
            state, wrote = made
            if wrote[0] in "IT>":
                out.append(wrote)
        return out

    def documents(self, data: np.ndarray, offsets: np.ndarray) -> Iterator[Counter]:
        """The matched events of each document."""
        for i, j in slices(offsets):
            w = words(data, offsets[i : j + 1], ALNUM)
            found = self.classes(w)
            ends = np.concatenate([[0], np.cumsum(CLAUSE_ENDS[w.data])])[w.start]
            doc = np.searchsorted(w.first, np.arange(len(found)), "right") - 1
            new = np.concatenate([[True], (ends[1:] != ends[:-1]) | (doc[1:] != doc[:-1])]) if len(found) else np.zeros(0, bool)
            first = np.flatnonzero(new)
            last = np.append(first[1:], len(found))
            clause = np.cumsum(new) - 1
            out = [Counter() for _ in range(j - i)]
            text = found.tobytes().decode("ascii")
            for c in np.unique(clause[(found == ord("I")) | (found == ord("T"))]).tolist():
                out[doc[first[c]]].update(self.events(text[first[c] : last[c]]))
            yield from out


def _member(keys: np.ndarray, among: np.ndarray) -> np.ndarray:
    at = np.minimum(np.searchsorted(among, keys), len(among) - 1)
    return among[at] == keys


def features(found: Counter) -> np.ndarray:
    return np.log1p(np.array([found.get(e, 0) for e in EVENTS], float))


def _document_frequencies(sample: DataFrame) -> DataFrame:
    """(feature, stem, toxic, other): documents of each label that hold a word or stem; at least LEAST_DOCUMENTS toxic."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts: tuple[Counter, Counter] = (Counter(), Counter())
            data, offsets = buffers(batch.column(0))
            toxic = batch.column(1).to_pylist()
            for i, j in slices(offsets):
                w = words(data, offsets[i : j + 1], ALNUM)
                raw = w.data.tobytes()
                for d in range(j - i):
                    own = {raw[a:b] for a, b in zip(w.start[w.first[d] : w.first[d + 1]].tolist(), w.end[w.first[d] : w.first[d + 1]].tolist())}
                    here = counts[int(toxic[i + d] == 1)]
                    here.update((x, False) for x in own)
                    here.update({(x[:n], True) for x in own for n in STEMS if len(x) > n})
            keys = list(counts[0].keys() | counts[1].keys())
            yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in keys], pa.binary()), pa.array([s for _, s in keys], pa.bool_()), pa.array([counts[1][k] for k in keys], pa.int64()), pa.array([counts[0][k] for k in keys], pa.int64())], ["feature", "stem", "toxic", "other"])

    found = sample.select("text", "toxic").mapInArrow(gives_back(run), "feature binary, stem boolean, toxic long, other long")
    return found.groupBy("feature", "stem").agg(F.sum("toxic").alias("toxic"), F.sum("other").alias("other")).where(F.col("toxic") >= LEAST_DOCUMENTS)


def learn_lexicon(sample: DataFrame, toxic: int, other: int) -> tuple[list[bytes], list[bytes]]:
    """(words, stems) that mark toxic documents, at most MOST_LEARNED."""
    t, n = F.col("toxic").cast("double"), F.col("other").cast("double")
    share = toxic / max(1, toxic + other)
    all_of = t + n
    ratio = 2 * (t * F.log(t / (all_of * share)) + F.when(n > 0, n * F.log(n / (all_of * (1 - share) + 1e-9))).otherwise(0.0))
    found = _document_frequencies(sample).withColumn("ratio", ratio).where((t / all_of > max(0.5, 3 * share)) & (F.col("ratio") >= LEAST_RATIO))
    best = found.orderBy(F.desc("ratio"), "feature", "stem").limit(MOST_LEARNED).collect()
    return [bytes(r["feature"]) for r in best if not r["stem"]], [bytes(r["feature"]) for r in best if r["stem"]]


def fit_weights(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, rounds: int = 30) -> np.ndarray:
    """Logistic regression by Newton's method; the last weight is the bias and is not shrunk."""
    x = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros(x.shape[1])
    shrink = np.full(len(w), ridge)
    shrink[-1] = 1e-6
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        g = x.T @ (p - y) + shrink * w
        h = (x * (p * (1 - p))[:, None]).T @ x + np.diag(shrink)
        w -= np.linalg.solve(h, g)
    return w


#: Weights without any labelled document: an event is more likely toxic than not.
DEFAULT_WEIGHTS = np.append(np.full(len(EVENTS), 3.0), -2.0)


def train(docs: DataFrame, labels: DataFrame, parts: int = 5, held: int = 0, documents: int = TRAIN_DOCUMENTS) -> tuple[Matcher, np.ndarray]:
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), "toxic").where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & (fold("doc_id", parts) != held))
    picked = known.groupBy("doc_id").agg(F.max("toxic").alias("toxic")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(documents)
    picked = local_table(docs.sparkSession, picked.collect(), pa.schema([("doc_id", pa.int64()), ("toxic", pa.int32())]))  # bounded by `documents`
    sample = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(picked), "doc_id")
    sizes = {r["toxic"]: r["n"] for r in picked.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    matcher = Matcher(*learn_lexicon(sample, sizes.get(1, 0), sizes.get(0, 0)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = [features(c).tolist() for c in matcher.documents(*buffers(batch.column(1)))]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(x, pa.list_(pa.float64()))], ["doc_id", "toxic", "x"])

    found = sample.mapInArrow(gives_back(run), "doc_id long, toxic int, x array<double>").groupBy("doc_id").agg(F.min(F.struct("toxic", "x")).alias("r"))
    rows = sorted((r["doc_id"], r["r"]["toxic"], r["r"]["x"]) for r in found.collect())  # one row an id, so bounded by `documents`
    y = np.array([t == 1 for _, t, _ in rows], float)
    if not len(y) or y.min() == y.max():
        return matcher, DEFAULT_WEIGHTS
    return matcher, fit_weights(np.array([x for _, _, x in rows]), y)


def score_toxicity(docs: DataFrame, labels: DataFrame, parts: int = 5, held: int = 0) -> DataFrame:
    """One row per row of docs: doc_id, held_out, score, predicted, n_events.

    The score reads nothing but text. Null and empty texts have no event and the score of any text without one. A null
    id is in no fold: its held_out is null. Repeated rows are scored alike; labels that repeat an id count once, as
    toxic if any is. Without labels, or with labels of one kind, fixed weights are used. Only doc_id and text of docs,
    and doc_id and toxic of labels, are read.
    """
    matcher, weights = train(bounded_batches(docs), labels, parts, held)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), (fold("doc_id", parts) == held).alias("held_out"), F.coalesce("text", F.lit("")).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        nothing = float(1 / (1 + np.exp(-weights[-1])))
        for batch in batches:
            score, n = [], []
            for found in matcher.documents(*buffers(batch.column(2))):
                score.append(float(1 / (1 + np.exp(-np.clip(features(found) @ weights[:-1] + weights[-1], -30, 30)))) if found else nothing)
                n.append(sum(found.values()))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(score, pa.float64()), pa.array([int(s >= 0.5) for s in score], pa.int32()), pa.array(n, pa.int64())], ["doc_id", "held_out", "score", "predicted", "n_events"])

    return rows.mapInArrow(gives_back(run), "doc_id long, held_out boolean, score double, predicted int, n_events long")
