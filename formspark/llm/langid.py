"""Language ID: a bidirectional gated recurrent network over bytes.

The network reads UTF-8 bytes in both directions with one small GRU each, gives every position
a distribution over the languages from both states, and a document the mean over its
positions. It is written in numpy and trained by backpropagation through time on a bounded
sample of labelled rows, stretches of ``STRETCH`` characters chosen by seeded hashes. Every label that
occurs is learned: from ``PER_LANGUAGE`` stretches, or fewer where the labels are so many that all
together would pass ``ALL_LANGUAGES``, but from one at least.

Prediction covers every byte of every text. Texts are cut into segments of ``SEGMENT`` bytes, which the
network reads from a zero state, all at the same length together, so memory is bounded by
a batch of segments and not by the longest text; batches are smaller where labels are many. The model
(a few thousand numbers, and some for each label) is what tasks get; training rows are the only ones
that reach the driver.

Defined cases: null or letterless text: ``und`` with score 0 (a letter is a character of the
Unicode class L); no labelled rows: ``und`` with score 0 everywhere; repeated rows get equal
predictions; very long texts are read whole; an empty table stays empty; columns other than key,
text and label are not read, and the label only where the model may learn from it.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import _words as W
from ._tables import blocks

HIDDEN, SEGMENT = 8, 256
PER_LANGUAGE, STRETCH, ALL_LANGUAGES = 600, 160, 38_400
#: Steps of training for each ``STEPS_LABELS`` labels, begun ones included.
STEPS, STEPS_LABELS, BATCH, RATE = 260, 64, 64, 0.03
SEED = 5
UNDETERMINED = "und"
BLOCK_BYTES, LANES = 4 << 20, 1024
#: Segments times labels, and rows times labels, that are held at once.
LANE_CELLS, ROW_CELLS = 1 << 16, 1 << 24


class Network:
    """Two GRUs over bytes and one softmax layer for every position."""

    def __init__(self, labels: list[str], hidden: int = HIDDEN, seed: int = SEED):
        r = np.random.default_rng(seed)
        self.labels, self.hidden = labels, hidden
        h, k = hidden, len(labels)
        self.p = {
            "x": (r.standard_normal((2, 256, 3 * h)) * 0.3).astype(np.float32),  # input of each byte to z, r and the candidate
            "u": (r.standard_normal((2, h, 2 * h)) / h**0.5).astype(np.float32),  # state to z and r
            "c": (r.standard_normal((2, h, h)) / h**0.5).astype(np.float32),  # reset state to the candidate
            "o": (r.standard_normal((2, h, k)) / (2 * h) ** 0.5).astype(np.float32),
            "b": np.zeros(k, dtype=np.float32),
        }

    def states(self, seq: np.ndarray, keep: bool = False):
        """States behind every byte of ``seq`` (direction, batch, time); with what training needs if ``keep``."""
        p, h = self.p, self.hidden
        _, n, t = seq.shape
        state = np.zeros((2, n, h), dtype=np.float32)
        out = np.empty((t, 2, n, h), dtype=np.float32)
        tape = []
        for i in range(t):
            x = np.stack([p["x"][0][seq[0, :, i]], p["x"][1][seq[1, :, i]]])
            g = x[..., :2 * h] + state @ p["u"]
            np.multiply(g, 0.5, out=g)
            np.tanh(g, out=g)
            g += 1
            g *= 0.5  # the logistic function
            z, reset = g[..., :h], g[..., h:]
            cand = reset * state
            cand = np.tanh(x[..., 2 * h:] + cand @ p["c"])
            new = state + z * (cand - state)
            if keep:
                tape.append((state, z, reset, cand))
            state = out[i] = new
        return (out, tape) if keep else out

    def probabilities(self, states: np.ndarray) -> np.ndarray:
        """Distribution at every position, from the states before and behind it (time, batch, label)."""
        logits = states[:, 0] @ self.p["o"][0]
        logits += states[::-1, 1] @ self.p["o"][1]
        logits += self.p["b"]
        logits -= logits.max(axis=-1, keepdims=True)
        np.exp(logits, out=logits)
        logits /= logits.sum(axis=-1, keepdims=True)
        return logits

    def gradient(self, bytes_: np.ndarray, label: np.ndarray) -> dict[str, np.ndarray]:
        """Gradient of the mean cross entropy of all positions, by backpropagation through time."""
        p, h = self.p, self.hidden
        seq = np.stack([bytes_, bytes_[:, ::-1]])
        states, tape = self.states(seq, keep=True)
        d = self.probabilities(states)
        t, n = d.shape[:2]
        d[:, np.arange(n), label] -= 1
        d /= t * n
        g = {k: np.zeros_like(v) for k, v in p.items()}
        g["b"] = d.sum(axis=(0, 1))
        back = d[::-1]
        g["o"][0] = np.einsum("tnh,tnk->hk", states[:, 0], d)
        g["o"][1] = np.einsum("tnh,tnk->hk", states[:, 1], back)
        down = np.stack([d @ p["o"][0].T, back @ p["o"][1].T], axis=1)  # time, direction, batch, hidden
        carry = np.zeros((2, n, h), dtype=np.float32)
        dx = np.empty((t, 2, n, 3 * h), dtype=np.float32)
        for i in range(t - 1, -1, -1):
            state, z, reset, cand = tape[i]
            ds = carry + down[i]
            dc = ds * z * (1 - cand * cand)
            dz = ds * (cand - state) * z * (1 - z)
            drs = dc @ p["c"].transpose(0, 2, 1)
            dr = drs * state * reset * (1 - reset)
            dg = np.concatenate([dz, dr], axis=-1)
            g["c"] += (reset * state).transpose(0, 2, 1) @ dc
            g["u"] += state.transpose(0, 2, 1) @ dg
            carry = ds * (1 - z) + drs * reset + dg @ p["u"].transpose(0, 2, 1)
            dx[i] = np.concatenate([dg, dc], axis=-1)
        for k in range(2):
            np.add.at(g["x"][k], seq[k].T.ravel(), dx[:, k].reshape(-1, 3 * h))
        return g

    def train(self, rows: list[bytes], label: np.ndarray, steps: int = STEPS, batch: int = BATCH, rate: float = RATE, seed: int = SEED) -> None:
        """Adam on random batches; every language is drawn equally often. A short row is repeated to its batch's length."""
        r = np.random.default_rng(seed)
        by = [np.flatnonzero(label == k) for k in range(len(self.labels))]
        m = {k: np.zeros_like(v) for k, v in self.p.items()}
        v = {k: np.zeros_like(x) for k, x in self.p.items()}
        for step in range(1, steps + 1):
            which = r.integers(len(by), size=batch)
            at = np.array([by[k][r.integers(len(by[k]))] for k in which])
            length = int(r.integers(8, 97))
            seq = np.empty((batch, length), dtype=np.uint8)
            for i, j in enumerate(at):
                row = rows[j]
                start = int(r.integers(max(1, len(row) - length + 1)))
                seq[i] = np.resize(np.frombuffer(row[start:start + length], np.uint8), length)
            g = self.gradient(seq, which)
            norm = float(np.sqrt(sum((x * x).sum() for x in g.values())))
            now = rate * (1 - (step - 1) / steps)
            for k in self.p:
                x = g[k] / max(1.0, norm)
                m[k] = 0.9 * m[k] + 0.1 * x
                v[k] = 0.99 * v[k] + 0.01 * x * x
                self.p[k] -= now * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.99**step)) + 1e-8)

    def pooled(self, data: np.ndarray, off: np.ndarray, segment: int = SEGMENT, lanes: int = LANES) -> np.ndarray:
        """Mean distribution over all positions of every row; rows of zeros where a row is empty."""
        n = np.diff(off)
        lanes = max(1, min(lanes, LANE_CELLS // len(self.labels)))
        parts = -(-n // segment)
        row = np.repeat(np.arange(len(n)), parts)
        index = np.arange(len(row)) - np.repeat(np.concatenate([[0], np.cumsum(parts)[:-1]]), parts)
        # Segments of a row have equal lengths up to one byte, so nearly all bytes run in full batches.
        lo = off[row] + n[row] * index // np.maximum(parts[row], 1)
        hi = off[row] + n[row] * (index + 1) // np.maximum(parts[row], 1)
        length = hi - lo
        total = np.zeros((len(n), len(self.labels)))
        order = np.argsort(length, kind="stable")
        for a in range(0, len(order), lanes):
            mine = order[a:a + lanes]
            longest = int(length[mine[-1]])
            at = lo[mine, None] + np.arange(longest)
            inside = at < hi[mine, None]
            # A shorter lane is read backwards from its own end: both directions start at its bytes.
            forward = data[np.minimum(at, len(data) - 1)]
            behind = data[np.maximum(hi[mine, None] - 1 - np.arange(longest), 0)]
            states = self.states(np.stack([forward, behind]))
            if not inside.all():
                back = np.maximum(length[mine][None, :] - 1 - np.arange(longest)[:, None], 0)
                states[:, 1] = states[back, 1, np.arange(len(mine))[None, :]][::-1]
            probs = self.probabilities(states)
            probs *= inside.T[..., None]
            np.add.at(total, row[mine], probs.sum(axis=0))
        return total / np.maximum(n, 1)[:, None]

    def best(self, data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(label, its mean probability) of every row."""
        step, label, score = max(1, ROW_CELLS // len(self.labels)), [], []
        for first, last in W.pieces(off):
            for lo in range(first, last, step):
                hi = min(lo + step, last)
                probs = self.pooled(data[off[lo]:off[hi]], off[lo:hi + 1] - off[lo])
                label.append(probs.argmax(axis=1))
                score.append(probs[np.arange(hi - lo), label[-1]])
        return np.concatenate(label), np.concatenate(score)


def lettered(text: str) -> Column:
    """Whether the column holds a letter; false where it is null."""
    return F.coalesce(F.col(text).rlike(r"\p{L}"), F.lit(False))


def training_rows(docs: DataFrame, learn: Column, key: str, text: str, label: str, per_language: int = PER_LANGUAGE,
                  stretch: int = STRETCH, all_languages: int = ALL_LANGUAGES, seed: int = SEED) -> list:
    """(label, stretch of text) of every label, by seeded hashes: ``per_language`` each at most, and
    ``all_languages`` together unless there are more labels than that."""
    may = docs.where(learn & F.col(label).isNotNull()).where(F.col(text).rlike(r"\p{L}"))
    each = max(1, min(per_language, all_languages // max(1, may.select(label).distinct().count())))
    u = F.xxhash64(F.lit(seed), F.col(key), F.length(text))
    at = F.pmod(u, F.greatest(F.length(text) - stretch, F.lit(1))).cast("int") + 1
    some = may.select(F.col(label).alias("l"), u.alias("u"), F.substring(text, at, F.lit(stretch)).alias("t"))
    w = Window.partitionBy("l").orderBy("u", "t")
    return some.withColumn("r", F.row_number().over(w)).where(F.col("r") <= each).select("l", "t").orderBy("l", "t").collect()


def fit(docs: DataFrame, learn: Column, key: str = "doc_id", text: str = "text", label: str = "lang", steps: int = STEPS,
        hidden: int = HIDDEN, seed: int = SEED, **bounds) -> Network | None:
    """The network trained on the rows where ``learn`` holds; None if there is nothing to learn from."""
    rows = training_rows(docs, learn, key, text, label, seed=seed, **bounds)
    rows = [(r["l"], r["t"].encode()) for r in rows if r["t"]]
    labels = sorted({name for name, _ in rows})
    if not labels:
        return None
    net = Network(labels, hidden, seed)
    if len(labels) > 1:
        index = {name: k for k, name in enumerate(labels)}
        net.train([t for _, t in rows], np.array([index[name] for name, _ in rows]), steps * -(-len(labels) // STEPS_LABELS), seed=seed)
    return net


def predict(docs: DataFrame, net: Network | None, text: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score``, the mean probability of that language over all positions."""
    own = ("lang_pred", "score")
    docs = docs.drop(*own)
    if net is None:
        return docs.withColumns({"lang_pred": F.lit(UNDETERMINED), "score": F.lit(0.0)})
    letters = docs.withColumn("_letters", lettered(text))
    names = [*docs.columns, *own]

    def run(batches):
        for b in blocks(batches, text, BLOCK_BYTES):
            data, off = W.buffers(b.column(b.schema.get_field_index(text)))
            known = b.column(b.schema.get_field_index("_letters")).to_numpy(zero_copy_only=False).astype(bool)
            best, score = net.best(data, off)
            score = np.where(known, np.clip(score, 0, 1), 0.0)
            lang = [net.labels[k] if ok else UNDETERMINED for k, ok in zip(best.tolist(), known.tolist(), strict=True)]
            yield pa.record_batch([*[b.column(i) for i in range(len(b.schema)) if b.schema.names[i] != "_letters"],
                                   pa.array(lang), pa.array(score)], names=names)

    from pyspark.sql import types as T

    schema = T.StructType([*docs.schema.fields, T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
    return letters.mapInArrow(run, schema)
