"""Toxicity by a bidirectional gated recurrent network with attention pooling, in numpy.

A word enters as the sum of two inputs: a vector of the word, by hash, and the scaled sum of
vectors of its character runs, by hash, so that unseen forms of a stem are known. Both go through
the gates' input weights once per distinct word. The network reads windows of ``WINDOW`` words
that overlap by half and cover the whole text, attention weighs the states of both directions, and
a logistic model turns all of a text's window scores into its score.

The network learns on the driver from a bounded sample of labelled texts. Texts are labelled as a
whole, so after the first rounds only those windows of a toxic text count as toxic that the
network itself ranks in its upper part.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm.common import by_batch, held_out, small_batches, sql_type, text_of

WINDOW, STRIDE = 32, 16
SIZE = 8  # states per direction
WIDTH = 16  # of an input vector
WORD_ROWS, RUN_ROWS = 1 << 14, 1 << 15
RUNS = (3, 5, 7)  # lengths of character runs, a mark before and after the word included
SAMPLE_TOXIC, SAMPLE_OTHER, SAMPLE_CHARS = 800, 2400, 8000  # bounds of the training sample
ROUNDS, BATCH, RATE = 8, 512, 0.01
CALIBRATE = 4  # each so-manieth text of the sample is kept for the last step
KNOWN_WORDS = 150_000
WINDOWS_AT_ONCE = 4096
TEXTS_AT_ONCE = 64
EDGES = "\"'`.,;:!?()[]{}<>*#$%&|-_~/\\"


def run_rows(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Table rows of all character runs of ``words`` in order, and how many each word has."""
    marked = ["^" + w + "$" for w in words]
    chars = np.frombuffer("".join(marked).encode("utf-32-le"), dtype=np.uint32).astype(np.uint64)
    sizes = np.array([len(w) for w in marked])
    left = np.repeat(np.cumsum(sizes), sizes) - np.arange(len(chars))  # characters up to the word's end
    word = np.repeat(np.arange(len(words)), sizes)
    rows, owners, value = [np.empty(0, np.uint64)], [np.empty(0, np.int64)], np.zeros(len(chars), dtype=np.uint64)
    for n in range(1, min(max(RUNS), len(chars)) + 1):
        value[: len(chars) - n + 1] = value[: len(chars) - n + 1] * np.uint64(1_000_003) + chars[n - 1 :]
        if n in RUNS:
            whole = left >= n
            rows.append(((value[whole] * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(32)) % np.uint64(RUN_ROWS))
            owners.append(word[whole])
    rows, owners = np.concatenate(rows).astype(np.int64), np.concatenate(owners)
    return rows[np.argsort(owners, kind="stable")], np.bincount(owners, minlength=len(words))


def word_rows(words: list[str]) -> np.ndarray:
    """Table row of each whole word; row 0 is left to words that are only marks."""
    out = np.zeros(len(words), dtype=np.int64)
    for i, w in enumerate(words):
        value = 0
        for byte in w.encode():
            value = (value * 31 + byte) & 0xFFFFFFFF
        out[i] = 1 + value % (WORD_ROWS - 1) if w else 0
    return out


def bare(word: str) -> str:
    return word.lower().strip(EDGES)


def window_starts(n: int) -> np.ndarray:
    """First words of all windows of a text of ``n`` words; one window for a short or empty text."""
    return np.arange(max(1, -(-(n - WINDOW) // STRIDE) + 1)) * STRIDE


def windows(words: np.ndarray, texts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of texts given one after another: word of each place (-1 past the end), and each window's text."""
    ends = np.cumsum(texts)
    starts = [window_starts(n) for n in texts]
    owner = np.repeat(np.arange(len(texts)), [len(s) for s in starts])
    first = np.concatenate(starts) + (ends - texts)[owner] if len(texts) else np.empty(0, dtype=np.int64)
    place = first[:, None] + np.arange(WINDOW)
    inside = place < ends[owner][:, None]
    padded = np.append(words, -1)
    return np.where(inside, padded[np.minimum(place, len(words))], -1), owner, inside


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


@dataclass
class Network:
    """Weights. ``scale``, ``weights`` and ``bias`` of the last step; ``prior`` is used without a network."""

    p: dict[str, np.ndarray]
    prior: float
    scale: np.ndarray | None = None
    weights: np.ndarray | None = None
    bias: float = 0.0
    name: str = ""

    def inputs(self, words: list[str]) -> np.ndarray:
        """Input vector of each bare word."""
        rows, counts = run_rows(words)
        at = np.cumsum(counts) - counts
        runs = np.add.reduceat(self.p["runs"][rows], np.minimum(at, len(rows) - 1), axis=0) if len(rows) else np.zeros((len(words), WIDTH), np.float32)
        runs[counts == 0] = 0
        return self.p["words"][word_rows(words)] + runs / np.sqrt(np.maximum(counts, 1))[:, None].astype(np.float32)

    def projected(self, words: list[str]) -> np.ndarray:
        """What each bare word adds to the gates of both directions."""
        made = [self.inputs(words[i : i + 2048]) @ self.p["in"] + self.p["gates"] for i in range(0, len(words), 2048)]
        return np.concatenate(made).astype(np.float32)

    def states(self, rows: np.ndarray, at: np.ndarray, inside: np.ndarray, back: bool, notes: list | None = None) -> np.ndarray:
        """States of one direction, (windows, places, ``SIZE``); a place past the end keeps the state."""
        n, own = SIZE, self.p["back" if back else "fore"]
        h = np.zeros((len(at), n), dtype=np.float32)
        out = np.empty((len(at), WINDOW, n), dtype=np.float32)
        part = slice(3 * n, 6 * n) if back else slice(0, 3 * n)
        table = np.ascontiguousarray(rows[:, part])
        whole = inside.all(axis=0)
        for t in range(WINDOW - 1, -1, -1) if back else range(WINDOW):
            x, u = table[at[:, t]], h @ own
            gate = sigmoid(x[:, : 2 * n] + u[:, : 2 * n])
            z, r = gate[:, :n], gate[:, n:]
            c = np.tanh(x[:, 2 * n :] + r * u[:, 2 * n :])
            new = c + z * (h - c)
            if not whole[t]:
                new = np.where(inside[:, t, None], new, h)
            if notes is not None:
                notes.append((t, h, z, r, c, u[:, 2 * n :]))
            h = out[:, t] = new
        return out

    def logits(self, rows: np.ndarray, at: np.ndarray, inside: np.ndarray, notes: dict | None = None) -> np.ndarray:
        """Score of each window before the logistic; a window without words has that of no state."""
        fore, back = ([], []) if notes is not None else (None, None)
        h = np.concatenate((self.states(rows, at, inside, False, fore), self.states(rows, at, inside, True, back)), axis=2)
        a = np.where(inside, h @ self.p["look"], -1e9)
        a = np.exp(a - a.max(axis=1, keepdims=True)) * inside
        a /= np.maximum(a.sum(axis=1, keepdims=True), 1e-9)
        pooled = (a[:, :, None] * h).sum(axis=1)
        if notes is not None:
            notes.update(fore=fore, back=back, h=h, a=a, pooled=pooled)
        return pooled @ self.p["out"] + self.p["base"][0]

    def summary(self, logits: np.ndarray, owner: np.ndarray, texts: int) -> np.ndarray:
        """What all windows of a text say: the highest, the share that fire, their mean, and how many there are."""
        first = np.searchsorted(owner, np.arange(texts))
        count = np.bincount(owner, minlength=texts)
        fired = sigmoid(logits)
        return np.column_stack((np.maximum.reduceat(logits, first), np.add.reduceat(fired, first) / count, np.add.reduceat(logits, first) / count, np.log(count)))

    def final(self, summary: np.ndarray) -> np.ndarray:
        return sigmoid(np.clip((summary - self.scale[0]) / self.scale[1] @ self.weights + self.bias, -60, 60))


class Numbers(dict):
    """Numbers words in the order in which they are first asked for."""

    def __init__(self) -> None:
        self.new: list[str] = []

    def __missing__(self, word: str) -> int:
        self[word] = number = len(self)
        self.new.append(word)
        return number


class Reader:
    """Scores batches of texts; keeps the gate inputs of words it has met, up to a bound."""

    def __init__(self, network: Network) -> None:
        self.network = network
        self.clear()

    def clear(self) -> None:
        self.number = Numbers()
        self.rows = np.zeros((0, 6 * SIZE), dtype=np.float32)

    def words(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        if len(self.number) > KNOWN_WORDS:
            self.clear()
        split = [text.split() for text in texts]
        at = np.fromiter(map(self.number.__getitem__, chain.from_iterable(split)), dtype=np.int64)
        if self.number.new:
            self.rows = np.concatenate((self.rows, self.network.projected([bare(w) for w in self.number.new])))
            self.number.new.clear()
        return at, np.array([len(words) for words in split], dtype=np.int64)

    def scores(self, texts: list[str]) -> np.ndarray:
        network = self.network
        if network.weights is None:
            return np.full(len(texts), network.prior)
        words, counts = self.words(texts)
        at, owner, inside = windows(words, counts)
        rows = self.rows if len(self.rows) else np.zeros((1, 6 * SIZE), dtype=np.float32)
        parts = [network.logits(rows, at[i : i + WINDOWS_AT_ONCE], inside[i : i + WINDOWS_AT_ONCE]) for i in range(0, len(at), WINDOWS_AT_ONCE)]
        return network.final(network.summary(np.concatenate(parts).astype(np.float64), owner, len(texts)))


_reader: list[Reader] = []


def reader(network: Network) -> Reader:
    """The worker's reader of this network; words stay known from task to task."""
    if not _reader or _reader[0].network.name != network.name:
        _reader[:] = [Reader(network)]
    return _reader[0]


def _start(rng: np.random.Generator) -> dict[str, np.ndarray]:
    def draw(*shape: int, size: float) -> np.ndarray:
        return rng.normal(0, size, shape).astype(np.float32)

    n = SIZE
    return {
        "words": draw(WORD_ROWS, WIDTH, size=0.005), "runs": draw(RUN_ROWS, WIDTH, size=0.005), "in": draw(WIDTH, 6 * n, size=0.3),
        "gates": np.zeros(6 * n, np.float32), "fore": draw(n, 3 * n, size=0.3), "back": draw(n, 3 * n, size=0.3),
        "look": draw(2 * n, size=0.3), "out": draw(2 * n, size=0.3), "base": np.zeros(1, np.float32),
    }


def by_row(rows: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct rows, and the sum of the values of each."""
    order = np.argsort(rows, kind="stable")
    distinct, starts = np.unique(rows[order], return_index=True)
    return distinct, np.add.reduceat(values[order], starts, axis=0)


class Trainer:
    """Adam on minibatches of windows, with gradients through both directions by hand."""

    def __init__(self, texts: list[str], labels: np.ndarray) -> None:
        self.network = Network(_start(np.random.default_rng(7)), 0.5)
        self.rng = np.random.default_rng(11)
        split = [[bare(w) for w in text.split()] for text in texts]
        self.vocabulary = sorted({w for words in split for w in words}) or [""]
        number = {w: i for i, w in enumerate(self.vocabulary)}
        flat = np.array([number[w] for words in split for w in words], dtype=np.int64)
        self.counts = np.array([len(words) for words in split])
        self.at, self.owner, self.inside = windows(flat, self.counts)
        self.labels = labels
        self.word = word_rows(self.vocabulary)
        self.runs, self.run_counts = run_rows(self.vocabulary)
        self.run_at = np.cumsum(self.run_counts) - self.run_counts
        self.moments = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in self.network.p.items()}
        self.steps = 0

    def step(self, chosen: np.ndarray, wanted: np.ndarray) -> None:
        p, n, m = self.network.p, SIZE, len(chosen)
        inside = self.inside[chosen]
        used, at = np.unique(np.where(inside, self.at[chosen], 0), return_inverse=True)
        at = at.reshape(inside.shape)
        counts = self.run_counts[used]
        runs = np.concatenate([self.runs[a : a + c] for a, c in zip(self.run_at[used], counts)])
        own = np.repeat(np.arange(len(used)), counts)
        share = (1 / np.sqrt(np.maximum(counts, 1))).astype(np.float32)
        summed = np.add.reduceat(p["runs"][runs], np.minimum(np.cumsum(counts) - counts, len(runs) - 1), axis=0)
        summed[counts == 0] = 0
        x = p["words"][self.word[used]] + summed * share[:, None]
        rows = x @ p["in"] + p["gates"]
        notes: dict = {}
        logit = self.network.logits(rows, at, inside, notes)
        g = {k: np.zeros_like(v) for k, v in p.items() if k not in ("words", "runs")}
        d = ((sigmoid(logit) - wanted) / m).astype(np.float32)
        h, a = notes["h"], notes["a"]
        g["base"][0], g["out"] = d.sum(), notes["pooled"].T @ d
        dpool = d[:, None] * p["out"]
        da = (h * dpool[:, None, :]).sum(axis=2)
        da = a * (da - (a * da).sum(axis=1, keepdims=True))
        g["look"] = np.einsum("bt,bth->h", da, h)
        dh_all = a[:, :, None] * dpool[:, None, :] + da[:, :, None] * p["look"]
        drows = np.zeros_like(rows)
        for key, shift, part in (("fore", 0, slice(0, n)), ("back", 3 * n, slice(n, 2 * n))):
            carry = np.zeros((m, n), dtype=np.float32)
            gates = np.empty((m, WINDOW, 3 * n), dtype=np.float32)
            for t, before, z, r, c, u in reversed(notes[key]):
                dh = dh_all[:, t, part] + carry
                keep_ = inside[:, t, None]
                dn = np.where(keep_, dh, 0)
                dc = dn * (1 - z) * (1 - c * c)
                dz = dn * (before - c) * z * (1 - z)
                dr = dc * u * r * (1 - r)
                gates[:, t] = np.concatenate((dz, dr, dc), axis=1)
                du = np.concatenate((dz, dr, dc * r), axis=1)
                g[key] += before.T @ du
                carry = np.where(keep_, 0, dh) + dn * z + du @ p[key].T
            order = np.argsort(at.ravel(), kind="stable")
            starts = np.searchsorted(at.ravel()[order], np.arange(len(used)))
            drows[:, shift : shift + 3 * n] = np.add.reduceat(gates.reshape(-1, 3 * n)[order], starts, axis=0)
        g["gates"], g["in"] = drows.sum(axis=0), x.T @ drows
        dx = drows @ p["in"].T
        tables = {"words": by_row(self.word[used], dx), "runs": by_row(runs, (dx * share[:, None])[own])}
        self.steps += 1
        rate = RATE * np.sqrt(1 - 0.999**self.steps) / (1 - 0.9**self.steps)
        for k, value in p.items():
            first, second = self.moments[k]
            rows_, slope = tables.get(k, (slice(None), g.get(k)))  # of the tables, only the rows in use
            first[rows_] += 0.1 * (slope - first[rows_])
            second[rows_] += 0.001 * (slope * slope - second[rows_])
            value[rows_] -= rate * first[rows_] / (np.sqrt(second[rows_]) + 1e-7)

    def all_logits(self) -> np.ndarray:
        rows = self.network.projected(self.vocabulary)
        at = np.where(self.inside, self.at, 0)
        return np.concatenate([self.network.logits(rows, at[i : i + WINDOWS_AT_ONCE], self.inside[i : i + WINDOWS_AT_ONCE]) for i in range(0, len(at), WINDOWS_AT_ONCE)]).astype(np.float64)

    def run(self) -> Network:
        last = np.arange(len(self.labels)) % CALIBRATE == 0
        if min(self.labels[last].sum(), (1 - self.labels[last]).sum()) < 2:
            last[:] = False
        of_window = self.labels[self.owner]
        learn = ~last[self.owner]
        toxic, other = np.flatnonzero(learn & (of_window == 1)), np.flatnonzero(learn & (of_window == 0))
        for turn in range(ROUNDS):
            hot = toxic
            if turn >= 2:
                logits = self.all_logits()
                best = np.full(len(self.labels), -np.inf)
                np.maximum.at(best, self.owner, logits)
                hot = toxic[(logits[toxic] > 0) | (logits[toxic] >= best[self.owner[toxic]])]
                hard = other[np.argsort(-logits[other])[: len(hot)]]
            else:
                hard = other[:0]
            calm = np.concatenate((hard, self.rng.permutation(other)[: 2 * len(hot)]))
            mixed = self.rng.permutation(np.concatenate((hot, calm)))
            for i in range(0, len(mixed), BATCH):
                self.step(mixed[i : i + BATCH], of_window[mixed[i : i + BATCH]])
        self.calibrate(last if last.any() else ~last)
        return self.network

    def calibrate(self, last: np.ndarray) -> None:
        """Logistic regression of the texts' labels on the summaries of their windows, with a ridge."""
        network = self.network
        s = network.summary(self.all_logits(), self.owner, len(self.labels))[last]
        y = self.labels[last].astype(np.float64)
        network.scale = np.stack((s.mean(axis=0), s.std(axis=0) + 1e-6))
        x = np.column_stack(((s - network.scale[0]) / network.scale[1], np.ones(len(s))))
        w = np.zeros(x.shape[1])
        for _ in range(30):
            q = sigmoid(x @ w)
            slope = x.T @ (q - y) + 0.3 * w
            curve = (x * (q * (1 - q))[:, None]).T @ x + 0.3 * np.eye(len(w))
            w -= np.linalg.solve(curve, slope)
        network.weights, network.bias = w[:-1], float(w[-1])


def sample(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str) -> list[tuple[str, int]]:
    """At most ``SAMPLE_TOXIC`` and ``SAMPLE_OTHER`` texts of up to ``SAMPLE_CHARS`` characters, by a hash of their ids."""
    known = labels.select(F.col(id_col).alias("doc_id"), F.col(label_col).cast("int").alias("label"))
    known = known.filter(F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"))).withColumn("draw", F.xxhash64("doc_id"))
    chosen = known.filter("label = 1").orderBy("draw", "doc_id").limit(SAMPLE_TOXIC).union(known.filter("label = 0").orderBy("draw", "doc_id").limit(SAMPLE_OTHER))
    rows = docs.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("text")).filter(F.length("text") <= SAMPLE_CHARS)
    found = rows.join(F.broadcast(chosen), "doc_id").select("draw", "doc_id", "text", "label").collect()
    return [(r["text"], r["label"]) for r in sorted(found, key=lambda r: (r["draw"], r["text"]))]


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> Network:
    """Train on the bounded sample. Without texts of both classes the network is a constant, the smoothed share."""
    found = sample(docs, labels, id_col, text_col, label_col)
    y = np.array([label for _, label in found], dtype=np.int64)
    prior = float((y.sum() + 1) / (len(y) + 2))
    if min(y.sum(), len(y) - y.sum()) < 4:
        return Network({}, prior, name="prior")
    network = Trainer([text for text, _ in found], y).run()
    network.prior, network.name = prior, str(np.abs(network.p["in"]).sum(dtype=np.float64))
    return network


def score(docs: DataFrame, network: Network, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``held_out``, ``score`` and ``predicted`` (1 from one half up) for every whole text.

    Every window of every text is read. A null or empty text has one window without words. Null
    and repeated ids and rows give a row each; an empty table gives none; other columns are not
    looked at.
    """

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = batch.column(1).to_pylist()
        read = reader(network)
        made = [read.scores(texts[i : i + TEXTS_AT_ONCE]) for i in range(0, len(texts), TEXTS_AT_ONCE)]
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.concatenate(made).astype(np.float64))], ["doc_id", "score"])

    small_batches(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("text"))
    scored = by_batch(rows, work, f"doc_id {sql_type(rows, 'doc_id')}, score double")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def classify(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> DataFrame:
    """Learn from ``labels`` and score all of ``docs``."""
    return score(docs, fit(docs, labels, id_col, text_col, label_col), id_col, text_col)
