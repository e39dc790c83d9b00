"""Toxicity by noisy-channel deobfuscation.

A suspicious token (look-alike symbols inside a word, a letter held down, letters
set apart) is read as a lattice: each symbol may stand for itself, for the letters
it resembles or for nothing, a held letter for one, two or all of its copies.
Viterbi finds the reading that the channel costs and a character 4-gram model
like best.  The restored words are then scored: words and word beginnings that
mark toxic documents carry the log ratio of their document rates, and a logistic
regression over four sums of these gives the score.

The character model is counted over all training documents in Spark (at most
28^4 counters reach the driver).  The word weights and the regression are fitted
on a sample of at most about ``max_train_rows`` labelled training rows, chosen by
a hash of the text, so copies of one text count once.

Defined cases: null and empty texts score the regression's value for no toxic
word; a document with several labels is toxic if one says so; null labels are left out; without
any usable label of both kinds the score is the share of toxic labels (0 without
labels); repeated rows are scored one by one; other columns are ignored or passed
through; empty tables give empty results.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetlake.llm.common import id_and_text, record_batch, slices, stored

THRESHOLD = 0.3
MAX_TRAIN_ROWS = 8_000
#: least log-likelihood ratio (G squared) of a trait; many traits are tried, so it is high
LEAST_EVIDENCE = 20.0

#: symbols of the character model: 0 anything else, 1-26 letters, 27 other letters
_SYMBOLS = 28
#: letters that a symbol may stand for
LOOKS_LIKE = {"0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b",
              "9": "g", "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "€": "e", "£": "l"}
#: channel costs (negative log probabilities): symbol for a letter, symbol dropped,
#: held letter shortened, symbol kept
_COST_LETTER, _COST_DROP, _COST_SHORT, _COST_KEEP = 1.0, 1.5, 0.3, 6.0
#: longer tokens are decoded whole and, as runs of letters set apart are, in windows of so
#: many symbols, since a word may begin at any of their pieces
_WINDOW = 40

_EDGE = "".join(chr(c) for c in range(33, 127) if not chr(c).isalnum() and chr(c) not in "@$|+(") + "«»“”‘’…–—"
#: the same without symbols that may stand for a letter
_OUTER = "".join(c for c in _EDGE if c not in LOOKS_LIKE)
_HELD = re.compile(r"([^\W\d_])\1\1")
_INNER = re.compile(r"[^\W\d_][\W\d_]+[^\W\d_]")
_LETTER = re.compile(r"[^\W\d_]")
_LIKE = "[" + re.escape("".join(LOOKS_LIKE)) + "]"
_LIKES = re.compile(_LIKE)
_APART = re.compile(rf"(?<![^\s])(?:(?:[^\W_]|{_LIKE})[ \t.\-_*]{{1,3}}){{3,}}(?:[^\W_]|{_LIKE})(?![^\W_])")
_GAP = re.compile(r"[ \t.\-_*]+")
_LONG_HELD = re.compile(r"(.)\1{3,}")
_PIECE = re.compile(rf"(?:[^\W_]|{_LIKE})+")


def _table() -> bytes:
    """Symbol of each UTF-8 byte; bytes of non-ASCII characters count as other letters."""
    out = bytearray(256)
    for i in range(26):
        out[97 + i] = out[65 + i] = i + 1
    out[128:] = bytes([27]) * 128
    return bytes(out)


_TABLE = _table()


def _symbol(char: str) -> int:
    return ord(char) - 96 if "a" <= char <= "z" else 27 if char.isalpha() else 0


def lattice(token: str):
    """What each run of one symbol may stand for, with the channel's costs."""
    for char, run in groupby(token):
        held = len(list(run))
        if char.isalpha():
            choices = [(char * held, 0.0 if held < 3 else _COST_KEEP / 2)]
            if held > 1:
                choices += [(char, _COST_SHORT)] + ([(char * 2, _COST_SHORT)] if held > 2 else [])
        else:
            choices = [("", _COST_DROP), (char * held, _COST_KEEP)]
            for letter in LOOKS_LIKE.get(char, ""):
                choices.append((letter, _COST_LETTER))
                if held > 1:
                    choices.append((letter * 2, _COST_LETTER))
        yield choices


def _read(link: tuple | None) -> str:
    parts = []
    while link is not None:
        link, out = link
        parts.append(out)
    return "".join(reversed(parts))


class CharModel:
    """Smoothed character 4-gram model from counts by code."""

    def __init__(self, counts: np.ndarray):
        n = _SYMBOLS
        full = counts.reshape(n, n, n, n).astype(np.float64)
        p = np.full(n, 1.0 / n)
        for axes in ((0, 1, 2), (0, 1), (0,), ()):
            c = full.sum(axis=axes) if axes else full
            p = (c + 5.0 * p) / (c.sum(axis=-1, keepdims=True) + 5.0)
        self.cost = (-np.log(p)).astype(np.float32)

    def decode(self, token: str) -> str:
        """Best reading of a token by Viterbi over its lattice, in linear time: a state
        holds a link to the reading before it."""
        states: dict[tuple, tuple] = {(0, 0, 0): (0.0, None)}
        for choices in lattice(token):
            after: dict[tuple, tuple] = {}
            for context, (cost, link) in states.items():
                for out, price in choices:
                    total, now = cost + price, context
                    for c in out:
                        s = _symbol(c)
                        total += float(self.cost[now + (s,)])
                        now = (now[1], now[2], s)
                    if now not in after or total < after[now][0]:
                        after[now] = (total, (link, out))
            states = after
        ends = [(cost + float(self.cost[context + (0,)]), link) for context, (cost, link) in states.items()]
        least = min(cost for cost, _ in ends)
        return min(_read(link) for cost, link in ends if cost == least)


def char_counts(docs: DataFrame) -> np.ndarray:
    """Counts of all character 4-grams of ``docs`` (doc_id, text) by code."""
    schema = pa.schema([("code", pa.int32()), ("n", pa.int64())])
    size = _SYMBOLS**4

    def run(batches):
        total = np.zeros(size, dtype=np.int64)
        for _, texts in slices(batches):
            data = ("\n\n\n" + "\n\n\n".join(texts) + "\n").encode("utf-8", "surrogatepass")
            s = np.frombuffer(data.translate(_TABLE), dtype=np.uint8).astype(np.int32)
            code = ((s[:-3] * _SYMBOLS + s[1:-2]) * _SYMBOLS + s[2:-1]) * _SYMBOLS + s[3:]
            total += np.bincount(code, minlength=size)
        seen = np.nonzero(total)[0]
        yield record_batch(schema, seen.astype(np.int32), total[seen])

    found = (docs.select("doc_id", "text").mapInArrow(run, "code int, n long")
             .groupBy("code").agg(F.sum("n").alias("n")).toPandas())
    counts = np.zeros(size, dtype=np.int64)
    counts[found["code"].to_numpy()] = found["n"].to_numpy()
    return counts


def suspicious(core: str) -> bool:
    """A letter, and a look-alike, a letter held down or letters set apart."""
    return bool(_LETTER.search(core) and (_LIKES.search(core) or _HELD.search(core) or _INNER.search(core)))


def restored(token: str, chars: CharModel | ToxicityModel) -> str:
    """The word a lower-case token stands for, look-alikes at its edges included."""
    core = token.strip(_OUTER)
    return chars.decode(core) if suspicious(core) else token.strip(_EDGE)


def readings(token: str, chars: CharModel | ToxicityModel) -> set[str]:
    """The words a lower-case token may stand for: as written, and as restored with
    the symbols at its edges as letters or as ornaments."""
    bare = token.strip(_EDGE)
    if bare.isalpha() and not _HELD.search(bare) and bare == token.strip(_OUTER):
        return {bare}
    if len(token) > _WINDOW:
        token = shortened(token).strip(_OUTER)
        if len(token) > _WINDOW:
            return {bare, restored(token, chars)}.union(*(readings(t, chars) for t in windows(token)))
    core = token.strip(_EDGE)
    for edge in ("$$$", "@@@", "+++", "|||"):  # ornaments, not letters
        core = core.strip(edge[0]) if core.startswith(edge) or core.endswith(edge) else core
    return {bare, restored(token, chars), restored(core.strip(_EDGE), chars)}


def shortened(text: str) -> str:
    """Three of each symbol held longer: the lattice reads them alike."""
    return _LONG_HELD.sub(r"\1\1\1", text)


def windows(token: str) -> list[str]:
    """Parts of a long token: its pieces between other symbols, as far as they fit a
    window, and the windows that overlap from the start of each piece or, in a long
    piece, from every half window."""
    out = set()
    for m in _PIECE.finditer(token):
        if len(m[0]) <= _WINDOW:
            out.add(m[0])
        out |= {token[i:i + _WINDOW] for i in range(m.start(), m.end(), _WINDOW // 2)}
    return sorted(out) or [token[:_WINDOW]]


def runs(text: str) -> list[list[str]]:
    """Each run of letters set apart as the words that may begin at its letters (one
    window from each; a neighbouring one-letter word may stand before a word)."""
    out = []
    for m in _APART.finditer(text):
        word = shortened(_GAP.sub("", m[0]))
        if len(set(word)) > 1:
            out.append([word[i:i + _WINDOW] for i in range(max(1, len(word) - 3))])
    return out


def traits(word: str) -> list[str]:
    """What a word is judged by: itself and its beginnings."""
    return ["=" + word, *[word[:n] for n in (4, 5, 6) if len(word) >= n]]


class ToxicityModel:
    """Character model, trait weights and regression; scores whole texts."""

    def __init__(self, chars: CharModel, weights: dict[str, float] | None = None,
                 fit: np.ndarray | None = None, prior: float = 0.0):
        self.chars, self.weights, self.fit, self.prior = chars, weights or {}, fit, prior
        self.seen: dict[str, float] = {}
        self.bodies = {t.removeprefix("=") for t in self.weights}
        self.begun = {t[:n] for t in self.bodies for n in range(len(t) + 1)}

    def reaches(self, token: str) -> bool:
        """Some reading of the token begins like a trait with a weight."""
        reads = {""}
        for choices in lattice(token):
            after = set()
            for read in reads:
                for out, _ in choices:
                    now = read + out
                    if any(now[:n] in self.bodies for n in range(len(read) + 1, len(now) + 1)):
                        return True
                    if now in self.begun:
                        after.add(now)
            reads = after
            if not reads:
                break
        return False

    def decode(self, token: str) -> str:
        """The best reading; tokens of which no reading could weigh stay as they are."""
        return self.chars.decode(token) if self.reaches(token) else token

    def words(self, text: str) -> set[str]:
        """Distinct words as written and as restored."""
        low = text.lower()
        return {w for t in {*low.split(), *(x for run in runs(low) for x in run)} for w in readings(t, self.chars)}

    def weight(self, token: str) -> float:
        """Largest weight of a token's readings."""
        found = self.seen.get(token)
        if found is None:
            if len(self.seen) > 200_000:
                self.seen.clear()
            get = self.weights.get
            found = self.seen[token] = max(get(t, 0.0) for w in readings(token, self) for t in traits(w))
        return found

    def sums(self, text: str) -> list[float]:
        """The regression's inputs."""
        low = text.lower()
        tokens = low.split()
        weigh = self.weight
        hits = [w for w in map(weigh, tokens) if w > 0.0]
        for run in runs(low):
            last = -4
            for at, w in enumerate(map(weigh, run)):
                if w > 0.0 and at - last < 4:  # beginnings have 4 letters: the same word
                    hits[-1] = max(hits[-1], w)
                elif w > 0.0:
                    hits.append(w)
                last = at if w > 0.0 else last
        return [1.0, max(hits, default=0.0), math.log1p(sum(hits)), math.log1p(len(hits)),
                math.sqrt(len(hits) / max(1, len(tokens)))]

    def score(self, text: str) -> float:
        if self.fit is None:
            return self.prior
        z = float(np.dot(self.fit, self.sums(text)))
        return 1.0 / (1.0 + math.exp(-max(-30.0, min(30.0, z))))


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, steps: int = 60) -> np.ndarray:
    """Logistic regression by Newton steps."""
    w = np.zeros(x.shape[1])
    penalty = np.full(x.shape[1], ridge)
    penalty[0] = 1e-3
    for _ in range(steps):
        p = 1.0 / (1.0 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (y - p) - penalty * w
        hess = (x * (p * (1 - p))[:, None]).T @ x + np.diag(penalty)
        move = np.linalg.solve(hess, grad)
        w += np.clip(move, -2, 2)
        if np.abs(move).max() < 1e-8:
            break
    return w


def training_rows(docs: DataFrame, labels: DataFrame, usable: Column, max_rows: int) -> DataFrame:
    """``doc_id, text, toxic`` of a sample of about ``max_rows`` labelled rows."""
    marked = (labels.select(labels["doc_id"].cast("long").alias("doc_id"), labels["toxic"].cast("int").alias("toxic"))
              .filter(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & usable)
              .groupBy("doc_id").agg(F.max("toxic").alias("toxic")))
    n = marked.count()
    share = min(1.0, max_rows / n) if n else 0.0
    # at most about max_rows ids are broadcast: the bound is the parameter's, not the data's
    chosen = marked.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 24)) < int(share * (1 << 24)))
    rows = docs.join(F.broadcast(chosen), "doc_id")
    return stored(rows.groupBy(F.xxhash64("text").alias("h")).agg(
        F.min("doc_id").alias("doc_id"), F.first("text").alias("text"), F.max("toxic").alias("toxic"),
    ).select("doc_id", "text", "toxic"), "labelled")


def train(docs: DataFrame, labels: DataFrame, usable: Column, max_rows: int = MAX_TRAIN_ROWS,
          id_col: str = "doc_id", text_col: str = "text") -> ToxicityModel:
    """Learn from the documents and labels for which ``usable`` (a condition on
    ``doc_id``) holds."""
    texts = id_and_text(docs, id_col, text_col).filter(usable)
    chars = CharModel(char_counts(texts))
    sample = training_rows(texts, labels, usable, max_rows)
    sizes = {bool(r["toxic"]): r["n"] for r in sample.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    bad, good = sizes.get(True, 0), sizes.get(False, 0)
    if not bad or not good:
        return ToxicityModel(chars, prior=bad / max(1, bad + good))

    reader = ToxicityModel(chars)
    trait_schema = pa.schema([("trait", pa.string()), ("bad", pa.int64()), ("good", pa.int64())])

    def count(batches):
        seen = {True: Counter(), False: Counter()}
        for toxic, found in slices(batches, ("toxic", "text")):
            for mark, text in zip(toxic, found, strict=True):
                seen[bool(mark)].update({t for w in reader.words(text) for t in traits(w)})
        names = list(seen[True].keys() | seen[False].keys())
        yield record_batch(trait_schema, names, [seen[True][t] for t in names], [seen[False][t] for t in names])

    ratio = ((F.col("bad") + 0.5) / (bad + 1.0)) / ((F.col("good") + 0.5) / (good + 1.0))
    both = F.col("bad") + F.col("good")
    part = lambda n, share: F.when(n > 0, n * F.log(n / (both * share))).otherwise(0.0)
    sure = 2 * (part(F.col("bad"), bad / (bad + good)) + part(F.col("good"), good / (bad + good)))
    kept = (sample.mapInArrow(count, "trait string, bad long, good long")
            .groupBy("trait").agg(F.sum("bad").alias("bad"), F.sum("good").alias("good"))
            .filter((F.col("bad") > 2) & (ratio >= 8.0) & (sure >= LEAST_EVIDENCE))
            .select("trait", F.log(ratio).alias("weight")))  # as many as the sample's words give
    model = ToxicityModel(chars, {r["trait"]: r["weight"] for r in kept.collect()})

    sums_schema = pa.schema([("toxic", pa.int32()), ("x", pa.list_(pa.float64()))])

    def measure(batches):
        for toxic, found in slices(batches, ("toxic", "text")):
            yield record_batch(sums_schema, toxic, [model.sums(t) for t in found])

    rows = sample.mapInArrow(measure, "toxic int, x array<double>").toPandas()
    model.fit = _logistic(np.vstack(rows["x"].to_list()), (rows["toxic"] > 0).to_numpy(float))
    return model


def toxicity_scores(docs: DataFrame, model: ToxicityModel, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """``doc_id, score`` of every row's whole text."""
    schema = pa.schema([("doc_id", pa.int64()), ("score", pa.float64())])
    sent = docs.sparkSession.sparkContext.broadcast(model)  # some MB: tables of fixed size

    def run(batches):
        for ids, texts in slices(batches):
            yield record_batch(schema, ids, [sent.value.score(t) for t in texts])

    return id_and_text(docs, id_col, text_col).mapInArrow(run, "doc_id long, score double")


def without_toxic(docs: DataFrame, model: ToxicityModel, threshold: float = THRESHOLD,
                  text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that score below ``threshold``, with all their columns."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index(text_col)

    def run(batches):
        for batch in batches:
            keep = [sent.value.score(t.as_py() or "") < threshold for t in batch.column(at)]
            yield batch.filter(pa.array(keep, type=pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


__all__ = ["CharModel", "ToxicityModel", "restored", "toxicity_scores", "train", "without_toxic"]
