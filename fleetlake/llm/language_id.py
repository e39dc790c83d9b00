"""Language identification by a bidirectional gated recurrent network over bytes.

Two gated recurrent units read stretches of ``STEP`` bytes, one forwards and one
backwards; a softmax over both states labels every position, and a document's
probabilities are the mean over the positions of its letters.  All stretches of a
document are read, side by side as columns of a matrix.  The network is trained in
numpy by backpropagation through time with Adam, on a sample of at most about
``max_train_rows`` rows, equally many for each language and chosen by a hash of the
text; from each row up to ``WINDOWS`` stretches from different parts are used.

Defined cases: a null text, an empty text and a text without a letter get ``und``
with score 0; null languages don't train; languages beyond the ``MAX_LANGS`` most
frequent ones are not learned; without a training row everything is ``und``;
repeated rows are labelled one by one; other columns are ignored; an empty table
gives an empty result.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetlake.llm.common import forget, id_and_text, record_batch, slices, stored

#: bytes that the network reads from a fresh state
STEP = 64
HIDDEN = 10
MAX_TRAIN_ROWS = 4_000
WINDOWS = 3
#: stretches read side by side: few enough for the cache, and for products so small
#: that numpy's library doesn't spread them over threads beside Spark's own tasks
_COLUMNS = 512

_ASCII_LETTER = re.compile(r"[A-Za-z]")
_ANY_LETTER = re.compile(r"[^\W\d_]")
_IS_LETTER = np.zeros(256, dtype=np.float32)
_IS_LETTER[[*range(65, 91), *range(97, 123), *range(128, 256)]] = 1.0


def _sigmoid(x: np.ndarray) -> np.ndarray:
    """In place: (1 + tanh(x / 2)) / 2."""
    x *= 0.5
    np.tanh(x, out=x)
    x += 1.0
    x *= 0.5
    return x


class Gru:
    """One direction.  Rows 0..H are the update gate, H..2H the reset gate, 2H..3H the
    candidate; ``x`` has the input's share of each for every byte."""

    def __init__(self, hidden: int, rng: np.random.Generator):
        h = hidden
        self.hidden = h
        self.x = (rng.standard_normal((3 * h, 256)) * 0.3).astype(np.float32)
        self.u = (rng.standard_normal((3 * h, h)) / np.sqrt(h)).astype(np.float32)
        self.c = np.zeros((h, 1), dtype=np.float32)
        self.x[:h] += 1.0  # open update gates at the start keep the state

    def params(self) -> list[np.ndarray]:
        return [self.x, self.u, self.c]

    def forward(self, bytes_: np.ndarray, real: np.ndarray, keep: bool = False):
        """States (T, H, B) for bytes (T, B); the state stays 0 before a text begins."""
        steps, width = bytes_.shape
        h = self.hidden
        states = np.empty((steps, h, width), dtype=np.float32)
        state = np.zeros((h, width), dtype=np.float32)
        cache = []
        for t in range(steps):
            given = self.x.take(bytes_[t], axis=1)
            own = self.u @ state
            gates = given[:2 * h]
            gates += own[:2 * h]
            _sigmoid(gates)
            inner = own[2 * h:]
            inner += self.c
            new = gates[h:] * inner
            new += given[2 * h:]
            np.tanh(new, out=new)
            before = state
            state = before - new
            state *= gates[:h]
            state += new
            state *= real[t]
            states[t] = state
            if keep:
                cache.append((gates, inner, new, before))
        return states, cache

    def backward(self, bytes_: np.ndarray, real: np.ndarray, cache: list, d_states: np.ndarray) -> list[np.ndarray]:
        """Gradients of x, u, c from the gradients of all states."""
        h = self.hidden
        dx, du, dc = np.zeros_like(self.x), np.zeros_like(self.u), np.zeros_like(self.c)
        later = np.zeros_like(d_states[0])
        for t in range(len(bytes_) - 1, -1, -1):
            gates, inner, new, before = cache[t]
            z, r = gates[:h], gates[h:]
            d = (d_states[t] + later) * real[t]
            d_new = d * (1 - z) * (1 - new * new)
            d_gates = np.concatenate([d * (before - new) * z * (1 - z), d_new * inner * r * (1 - r)])
            d_inner = d_new * r
            own = np.concatenate([d_gates, d_inner])
            given = np.concatenate([d_gates, d_new])
            du += own @ before.T
            dc += d_inner.sum(axis=1, keepdims=True)
            for row in range(3 * h):
                dx[row] += np.bincount(bytes_[t], weights=given[row], minlength=256)
            later = d * z + self.u.T @ own
        return [dx, du, dc]


class Network:
    """Both directions and the softmax over them."""

    def __init__(self, langs: list[str], hidden: int = HIDDEN, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.langs = langs
        self.ahead, self.back = Gru(hidden, rng), Gru(hidden, rng)
        self.v = (rng.standard_normal((len(langs), 2 * hidden)) * 0.3).astype(np.float32)
        self.b = np.zeros((len(langs), 1), dtype=np.float32)

    def params(self) -> list[np.ndarray]:
        return [*self.ahead.params(), *self.back.params(), self.v, self.b]

    def positions(self, bytes_: np.ndarray, real: np.ndarray, keep: bool = False):
        """Probabilities (T, L, B) at every position of bytes (T, B)."""
        a, cache_a = self.ahead.forward(bytes_, real, keep)
        b, cache_b = self.back.forward(bytes_[::-1], real[::-1], keep)
        both = np.concatenate([a, b[::-1]], axis=1)
        out = np.matmul(self.v, both)
        out += self.b
        out -= out.max(axis=1, keepdims=True)
        np.exp(out, out=out)
        out /= out.sum(axis=1, keepdims=True)
        return out, (both, cache_a, cache_b)

    def gradients(self, bytes_: np.ndarray, real: np.ndarray, label: np.ndarray) -> tuple[float, list[np.ndarray]]:
        p, (both, cache_a, cache_b) = self.positions(bytes_, real, keep=True)
        each, h = np.arange(len(label)), self.ahead.hidden
        weight = _IS_LETTER[bytes_] * real
        weight /= max(1.0, weight.sum())
        loss = -float((np.log(p[:, label, each] + 1e-9) * weight).sum())
        d = p  # less 1 for the label: the gradient of the softmax's input
        d[:, label, each] -= 1.0
        d *= weight[:, None]
        d_both = np.matmul(self.v.T, d)
        grads = [*self.ahead.backward(bytes_, real, cache_a, d_both[:, :h]),
                 *self.back.backward(bytes_[::-1], real[::-1], cache_b, d_both[::-1, h:]),
                 np.matmul(d, both.transpose(0, 2, 1)).sum(axis=0), d.sum(axis=(0, 2))[:, None]]
        return loss, grads

    def fit(self, stretches: list[bytes], labels: list[int], epochs: int = 6, batch: int = 256,
            rate: float = 0.015, seed: int = 11) -> None:
        """Adam over shuffled batches of stretches."""
        rng = np.random.default_rng(seed)
        data, real = columns(stretches)
        label = np.array(labels)
        params = self.params()
        first = [np.zeros_like(p) for p in params]
        second = [np.zeros_like(p) for p in params]
        n, step = 0, rate
        rounds = epochs * -(-len(stretches) // batch)
        for _ in range(epochs):
            order = rng.permutation(len(stretches))
            for at in range(0, len(order), batch):
                some = order[at:at + batch]
                _, grads = self.gradients(data[:, some], real[:, some], label[some])
                norm = float(np.sqrt(sum(float((g * g).sum()) for g in grads)))
                n += 1
                step = rate * (1.0 - 0.9 * n / rounds)
                for p, g, m, v in zip(params, grads, first, second, strict=True):
                    g = g * np.float32(min(1.0, 1.0 / (norm + 1e-9)))
                    m += 0.1 * (g - m)
                    v += 0.01 * (g * g - v)
                    p -= np.float32(step) * (m / (1 - 0.9**n)) / (np.sqrt(v / (1 - 0.99**n)) + 1e-8)

    def documents(self, texts: list[bytes]) -> np.ndarray:
        """Mean probabilities (documents, L) over the letters of whole texts."""
        counts = [-(-len(t) // STEP) for t in texts]
        owner = np.repeat(np.arange(len(texts)), counts)
        padded = b"".join(t + b"\0" * (c * STEP - len(t)) for t, c in zip(texts, counts, strict=True))
        grid = np.frombuffer(padded, dtype=np.uint8).reshape(-1, STEP)
        ends = np.full(len(grid), STEP)
        last = np.cumsum(counts) - 1
        for i, (t, c) in enumerate(zip(texts, counts, strict=True)):
            if c:
                ends[last[i]] = len(t) - (c - 1) * STEP
        sums = np.zeros((len(texts), len(self.langs) + 1))
        for at in range(0, len(grid), _COLUMNS):
            part = np.ascontiguousarray(grid[at:at + _COLUMNS].T)
            real = (np.arange(STEP)[:, None] < ends[None, at:at + _COLUMNS]).astype(np.float32)
            p, _ = self.positions(part, real)
            weight = _IS_LETTER[part] * real
            p = (p * weight[:, None]).sum(axis=0)
            np.add.at(sums, owner[at:at + _COLUMNS], np.concatenate([p, weight.sum(axis=0)[None]]).T)
        return sums[:, :-1] / np.maximum(sums[:, -1:], 1.0)


def columns(stretches: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Bytes (T, B) and a mask of those that are there."""
    data = np.frombuffer(b"".join(s.ljust(STEP, b"\0") for s in stretches), dtype=np.uint8).reshape(-1, STEP).T
    size = np.array([len(s) for s in stretches])
    return np.ascontiguousarray(data), (np.arange(STEP)[:, None] < size[None]).astype(np.float32)


def training_rows(docs: DataFrame, usable: Column, max_rows: int, lang_col: str, text_col: str):
    """(language, text) of a sample, about equally many rows for each language."""
    rows = docs.filter(usable & F.col(lang_col).isNotNull() & F.col(text_col).rlike(r"\p{L}")).select(
        F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text"),
        F.xxhash64(F.col(text_col)).alias("h"))
    # a language needs a row of the sample, so the sample's bound is the only one
    counts = rows.groupBy("lang").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "lang").limit(max_rows)
    counts = stored(counts, "langs", 0)
    n_langs = counts.count()
    if not n_langs:
        return [], []
    share = F.least(F.ceil(F.lit(float(max(1, max_rows // n_langs) * (1 << 30))) / F.col("n")), F.lit(1 << 30))
    chosen = rows.join(counts.select("lang", share.alias("share")), "lang").filter(F.pmod("h", F.lit(1 << 30)) < F.col("share"))
    # only stretches leave the executors: from the beginning, the middle and the end; copies
    # of a text are reduced to one before
    size = F.char_length("text")
    part = F.array(*[F.substring("text", F.greatest(F.lit(1), (size * k / WINDOWS).cast("int")), F.lit(STEP))
                     for k in range(WINDOWS)])
    found = chosen.groupBy("lang", "h").agg(F.min(part).alias("part")).orderBy("lang", "h").collect()
    forget(counts)
    langs = sorted({r["lang"] for r in found})
    place = {x: i for i, x in enumerate(langs)}
    pairs = [(place[r["lang"]], s.encode()[:STEP]) for r in found for s in dict.fromkeys(r["part"]) if s]
    return langs, pairs


def train(docs: DataFrame, usable: Column, max_train_rows: int = MAX_TRAIN_ROWS, lang_col: str = "lang",
          text_col: str = "text") -> Network:
    """Network trained on the rows for which ``usable`` holds."""
    langs, pairs = training_rows(docs, usable, max_train_rows, lang_col, text_col)
    network = Network(langs)
    if len(langs) > 1:
        network.fit([s for _, s in pairs], [i for i, _ in pairs])
    return network


def _has_letter(text: str) -> bool:
    return bool(_ASCII_LETTER.search(text) or _ANY_LETTER.search(text))


def predict(docs: DataFrame, network: Network, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, lang_pred, score, probabilities`` of every row's whole text."""
    schema = pa.schema([("doc_id", pa.int64()), ("lang_pred", pa.string()), ("score", pa.float64()),
                        ("probabilities", pa.map_(pa.string(), pa.float64()))])
    sent = docs.sparkSession.sparkContext.broadcast(network)  # a few thousand numbers

    def run(batches):
        net = sent.value
        for ids, texts in slices(batches):
            lang, score, each = ["und"] * len(ids), [0.0] * len(ids), [None] * len(ids)
            told = [i for i, t in enumerate(texts) if net.langs and _has_letter(t)]
            if told:
                p = net.documents([texts[i].encode("utf-8", "surrogatepass") for i in told])
                for i, row in zip(told, p, strict=True):
                    k = int(row.argmax())
                    lang[i], score[i] = net.langs[k], min(1.0, float(row[k]))
                    each[i] = list(zip(net.langs, row.tolist(), strict=True))
            yield record_batch(schema, ids, lang, score, each)

    return id_and_text(docs, id_col, text_col).mapInArrow(
        run, "doc_id long, lang_pred string, score double, probabilities map<string,double>")


__all__ = ["Gru", "Network", "predict", "train"]
