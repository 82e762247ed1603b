"""Language identification by a bidirectional gated recurrent network over bytes, in numpy.

Training: backpropagation through time on windows of a bounded sample of labelled documents, with Adam. The loss is the
mean cross-entropy of the label at every position. Prediction: whole texts are cut into segments of SEGMENT bytes, in
which both directions start anew; the network labels every position, and a document's probabilities are the mean over all
its positions.

Beside the languages there is one more class, of no language: random words of Latin letters, of letters and digits, and of
small and large alphabets of other scripts, made by rule. A text most of whose positions are of that class has none.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import bounded_batches, fold, free_names, gives_back, with_plain_names
from .textbytes import buffers

#: The sample: at most TRAIN_DOCUMENTS labelled documents (by a hash of the id), and of each WINDOWS windows, whose places
#: are hashed too. So learning reads at most 1.5 MB of text; a language without a document in the sample is not learned.
TRAIN_DOCUMENTS, WINDOWS, WINDOW_BYTES = 2000, 16, 48
#: Windows of no language for each one of a text.
NOISE = 0.1
HIDDEN, STEPS, BATCH, RATE = 8, 280, 256, 0.03
#: Bytes of a segment, and segments at once, in prediction.
SEGMENT, TOGETHER = 128, 1024


class Network:
    """Two gated recurrent layers, one in each direction, and a softmax over both. Arrays have features first."""

    def __init__(self, classes: int, hidden: int = HIDDEN, seed: int = 11):
        rng = np.random.default_rng(seed)
        self.hidden, self.classes = hidden, classes
        draw = lambda *shape: (rng.standard_normal(shape) * 0.3).astype(np.float32)
        self.weights: dict[str, np.ndarray] = {}
        for d in "fb":
            self.weights |= {f"x{d}": draw(3 * hidden, 256), f"u{d}": draw(3 * hidden, hidden), f"c{d}": np.zeros((hidden, 1), np.float32)}
        self.weights |= {"o": draw(classes, 2 * hidden), "p": np.zeros((classes, 1), np.float32)}

    def run(self, text: np.ndarray, d: str, keep: list | None = None, inside: np.ndarray | None = None) -> np.ndarray:
        """States (time, hidden, n) of one direction for text (n, time); keep collects what the way back needs. States
        are nought where inside (n, time) is false, so padding tells nothing."""
        w, hidden = self.weights, self.hidden
        n, time = text.shape
        x, u, c = w[f"x{d}"], w[f"u{d}"], w[f"c{d}"]
        h = np.zeros((hidden, n), x.dtype)
        out = np.empty((time, hidden, n), x.dtype)
        a, g = np.empty((3 * hidden, n), x.dtype), np.empty((3 * hidden, n), x.dtype)
        half = x.dtype.type(0.5)
        for t in range(time) if d == "f" else range(time - 1, -1, -1):
            np.take(x, text[:, t], axis=1, out=a, mode="clip")
            np.matmul(u, h, out=g)
            zr = a[: 2 * hidden]
            zr += g[: 2 * hidden]
            zr *= half
            np.tanh(zr, out=zr)
            zr *= half
            zr += half  # update gate, reset gate
            v = g[2 * hidden :]
            v += c
            new = zr[hidden:] * v
            new += a[2 * hidden :]
            np.tanh(new, out=new)
            before, h = h, out[t]
            np.subtract(before, new, out=h)
            h *= zr[:hidden]
            h += new
            if inside is not None:
                h *= inside[:, t]
            if keep is not None:
                keep.append((t, before, zr.copy(), v.copy(), new))
        return out

    def probabilities(self, text: np.ndarray, inside: np.ndarray | None = None) -> np.ndarray:
        """(time, classes, n)"""
        both = np.concatenate([self.run(text, d, inside=inside) for d in "fb"], axis=1)
        logit = np.matmul(self.weights["o"], both)
        logit += self.weights["p"]
        np.exp(logit, out=logit)
        logit /= logit.sum(1, keepdims=True)
        return logit

    def gradients(self, text: np.ndarray, label: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Mean loss over all positions, and its gradients by backpropagation through time."""
        w, hidden = self.weights, self.hidden
        n, time = text.shape
        kept: dict[str, list] = {"f": [], "b": []}
        both = np.concatenate([self.run(text, d, kept[d]) for d in "fb"], axis=1)
        logit = np.matmul(w["o"], both) + w["p"]
        logit -= logit.max(1, keepdims=True)
        p = np.exp(logit)
        p /= p.sum(1, keepdims=True)
        loss = float(-np.log(p[:, label, np.arange(n)] + 1e-12).mean())
        p[:, label, np.arange(n)] -= 1
        p /= n * time
        grad = {"o": np.einsum("tcn,thn->ch", p, both), "p": p.sum((0, 2))[:, None]}
        d_both = np.matmul(w["o"].T, p)
        for k, d in enumerate("fb"):
            u = w[f"u{d}"]
            gx, gu, gc = np.zeros_like(w[f"x{d}"]), np.zeros_like(u), np.zeros_like(w[f"c{d}"])
            back = np.zeros((hidden, n), u.dtype)
            for t, before, zr, v, new in reversed(kept[d]):
                z, r = zr[:hidden], zr[hidden:]
                dh = d_both[t, k * hidden : (k + 1) * hidden] + back
                d_new = dh * (1 - z) * (1 - new * new)
                d_v = d_new * r
                d_gates = np.concatenate([dh * (before - new) * z * (1 - z), d_new * v * r * (1 - r)])
                d_g = np.concatenate([d_gates, d_v])
                gu += d_g @ before.T
                gc += d_v.sum(1, keepdims=True)
                d_a = np.concatenate([d_gates, d_new])
                for row, add in zip(gx, d_a):
                    row += np.bincount(text[:, t], add, 256)
                back = dh * z + u.T @ d_g
            grad |= {f"x{d}": gx, f"u{d}": gu, f"c{d}": gc}
        return loss, grad

    def train(self, text: np.ndarray, label: np.ndarray, steps: int = STEPS, batch: int = BATCH, rate: float = RATE, seed: int = 3) -> float:
        rng = np.random.default_rng(seed)
        m = {k: np.zeros_like(v) for k, v in self.weights.items()}
        s = {k: np.zeros_like(v) for k, v in self.weights.items()}
        loss = 0.0
        for i in range(1, steps + 1):
            pick = rng.integers(0, len(text), min(batch, len(text)))
            loss, grad = self.gradients(text[pick], label[pick])
            now = rate * min(1.0, 2 * (1 - (i - 1) / steps))
            for k, g in grad.items():
                m[k] += 0.1 * (g - m[k])
                s[k] += 0.01 * (g * g - s[k])
                self.weights[k] -= (now / (1 - 0.9**i)) * m[k] / (np.sqrt(s[k] / (1 - 0.99**i)) + 1e-8)
        return loss

    def of_documents(self, data: np.ndarray, offsets: np.ndarray, segment: int = SEGMENT, together: int = TOGETHER) -> np.ndarray:
        """(documents, classes): mean probabilities over every byte of each document; nan where there is none."""
        size = np.diff(offsets)
        pieces = -(-size // segment)
        doc = np.repeat(np.arange(len(size)), pieces)
        at = np.arange(len(doc)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        start = offsets[:-1][doc] + at * segment
        length = np.minimum(segment, offsets[1:][doc] - start)
        total = np.zeros((len(size), self.classes))
        order = np.argsort(length, kind="stable")  # short last segments together, so padding is little
        for i in range(0, len(order), together):
            pick = order[i : i + together]
            longest = int(length[pick].max())
            place = start[pick][:, None] + np.arange(longest)
            inside = np.arange(longest) < length[pick][:, None]
            padded = not inside.all()
            p = self.probabilities(data[np.minimum(place, len(data) - 1)], inside if padded else None)
            if padded:
                p *= inside.T[:, None, :]
            np.add.at(total, doc[pick], p.sum(0).T)
        with np.errstate(invalid="ignore", divide="ignore"):
            return total / size[:, None]


def no_language(n: int, size: int = WINDOW_BYTES, seed: int = 5) -> list[np.ndarray]:
    """n windows of random words."""
    rng = np.random.default_rng(seed)
    latin, digits = [chr(c) for c in range(97, 123)], list("0123456789")
    out = []
    for k in range(n):
        base = int(rng.integers(0x100, 0x3000))
        letters = (latin, [chr(c) for c in range(base, base + 40)], [chr(c) for c in rng.integers(0x3000, 0xD800, 200)], latin + digits)[k % 4]
        text = " ".join("".join(letters[i] for i in rng.integers(0, len(letters), rng.integers(2, 11))) for _ in range(size // 2))
        out.append(np.frombuffer(text.encode("utf-8")[:size], np.uint8))
    return out


def train_network(docs: DataFrame, parts: int = 5, held: int = 0, documents: int = TRAIN_DOCUMENTS) -> tuple[list[str], Network | None]:
    """Languages and a network learned from labelled documents whose fold is not `held`, at most `documents` of them. The
    languages are those of the sample, however many; the network's last class is that of no language. Of rows that repeat
    an id, one row's windows are taken."""
    rows = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & (fold("doc_id", parts) != held))
    picked = rows.select("doc_id").distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(documents)
    length = F.length("text")
    windows = [F.substring("text", (F.pmod(F.xxhash64("doc_id", F.lit(k)), F.greatest(length - WINDOW_BYTES + 1, F.lit(1))) + 1).cast("int"), F.lit(WINDOW_BYTES)) for k in range(WINDOWS)]
    sample = rows.join(F.broadcast(picked), "doc_id", "left_semi").groupBy("doc_id").agg(F.min(F.struct("lang", F.array(*windows).alias("windows"))).alias("x"))
    sample = sorted(sample.select("doc_id", "x.lang", "x.windows").collect(), key=lambda r: r["doc_id"])  # bounded by `documents`
    langs = sorted({r["lang"] for r in sample})
    text, label = [], []
    for r in sample:
        for window in r["windows"]:
            raw = window.encode("utf-8")[:WINDOW_BYTES]
            if len(raw) >= 8:
                text.append(np.resize(np.frombuffer(raw, np.uint8), WINDOW_BYTES))
                label.append(langs.index(r["lang"]))
    if not text:
        return langs, None
    noise = no_language(max(1, int(len(text) * NOISE)))
    text, label = text + noise, label + [len(langs)] * len(noise)
    net = Network(len(langs) + 1)
    net.train(np.stack(text), np.array(label))
    return langs, net


def _predicted(docs: DataFrame, parts: int, held: int) -> tuple[DataFrame, list[str], bool]:
    """docs with a language, its share among the languages, and the share of no language, in one pass over the rows as they
    stand: nothing is shuffled. Also the names of these three columns, which no column of docs has, and whether any
    language was learned."""
    langs, net = train_network(docs.select("doc_id", "text", "lang"), parts, held)
    letters, *names = free_names(docs, "letters", "lang_found", "lang_score", "lang_none")
    rows = bounded_batches(docs).withColumn(letters, F.when(F.col("text").rlike(r"\p{L}"), F.col("text")).otherwise(""))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = buffers(batch.column(batch.num_columns - 1))
            name, score, none = ["und"] * batch.num_rows, [0.0] * batch.num_rows, [1.0] * batch.num_rows
            if net is not None and len(data):
                p = net.of_documents(data, offsets)
                for i in np.flatnonzero(np.diff(offsets)):
                    of_langs = p[i, :-1]
                    best = int(of_langs.argmax())
                    name[i], score[i], none[i] = langs[best], min(1.0, float(of_langs[best] / max(of_langs.sum(), 1e-30))), float(p[i, -1])
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(name, pa.string()), pa.array(score, pa.float64()), pa.array(none, pa.float64())], [*batch.schema.names[:-1], *names])

    found = rows.mapInArrow(gives_back(run), T.StructType([*docs.schema.fields, *map(T.StructField, names, (T.StringType(), T.DoubleType(), T.DoubleType()))]))
    return found, names, net is not None


def identify_languages(docs: DataFrame, parts: int = 5, held: int = 0) -> DataFrame:
    """One row per row of docs: doc_id, held_out, lang_pred, score, none_share.

    The network reads nothing but text, and all of it, however long. The score is the language's share among the languages,
    none_share that of no language. Null texts and texts without any letter are `und` with score 0, and so is every text if
    no labelled one exists. A null id is in no fold: it is never learned from and its held_out is null. Repeated and tied
    rows are predicted alike; of tied languages the first by name is taken. Columns but doc_id, text and lang are not read,
    so others may have any name. An empty table gives an empty result.
    """
    found, (lang, score, none), _ = _predicted(docs.select("doc_id", "text", "lang"), parts, held)
    return found.select(F.col("doc_id").cast("long").alias("doc_id"), (fold("doc_id", parts) == held).alias("held_out"), F.col(lang).alias("lang_pred"), F.col(score).alias("score"), F.col(none).alias("none_share"))


#: A text is rejected if it has no letter, or if more than this share of it is of no language; DOUBT bytes that are not are
#: counted with each text, so that one of a few letters, which tell little, stays.
MOST_NONE, DOUBT = 0.5, 16


def keep_identified(docs: DataFrame, most_none: float = MOST_NONE) -> DataFrame:
    """docs without the texts that identify_languages gives no language, or a none_share over most_none beyond doubt;
    same columns, which may have any name. Where there is no labelled text to learn from, only texts without letters go."""
    return with_plain_names(docs, ["doc_id", "text", "lang"], lambda rows: _keep_identified(rows, most_none))


def _keep_identified(docs: DataFrame, most_none: float) -> DataFrame:
    found, (lang, _, none), learned = _predicted(docs, 5, 0)
    n = F.octet_length("text")
    keep = (F.col(lang) != "und") & (F.col(none) * n / (n + DOUBT) <= most_none) if learned else F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))
    return found.where(keep).select(*(F.col(f"`{c}`") for c in docs.columns))
