"""Toxicity of texts after undoing disguised spelling with a noisy-channel decoder."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadlens.llm.common import held_out, small_batches, whole_text, write_table
from loadlens.llm.quality import labelled_sample

#: At most so many labelled rows are used to fit, chosen by a hash of their id.
SAMPLE_ROWS = 20_000
#: At most so many words weigh; they are the strongest by significance.
LEXICON_WORDS = 5_000
#: A word weighs if this share of toxic texts has it and its log odds are this many deviations from 0.
MIN_SHARE, MIN_TEXTS, MIN_Z = 0.02, 3, 3.0

# Symbols of the character model: 0 boundary, 1 to 26 letters, 27 beyond ASCII, 28 digit, 29 other sign.
_BASE = 32
_SYMBOL = bytes(
    c - 96 if 97 <= c <= 122 else c - 64 if 65 <= c <= 90 else 27 if c >= 128 else 28 if 48 <= c <= 57 else 0 if c <= 32 else 29 for c in range(256)
)
_WORDS = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256))

#: Which letters a sign may stand for.
SIGNS = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "*": "aeiou",
}
#: Costs of the channel, as negative log probabilities.
COST_SIGN, COST_KEPT_SIGN, COST_SHORTER, COST_GAP_KEPT = 0.7, 6.0, 0.5, 6.0
_SIGN_BYTES = "".join(SIGNS).encode()
_NOT_SIGNS = bytes(c for c in range(256) if c not in _SIGN_BYTES)
_GAPS = b" ._-*"
_DISGUISED = re.compile(rb"[0-9@$!|+(*](?=[a-z])|(?<=[a-z])[0-9@$]{1,2}$|([a-z])\1\1")
_SPACED = re.compile(rb"(?<![a-z0-9\x80-\xff])(?:[a-z0-9@$!|][ ._*-]+){2,}[a-z0-9@$!|](?![a-z0-9\x80-\xff])")
_TAIL = b".,;:?!\"')]}%&#"
_RUN = re.compile(rb"(.)\1*", re.S)
_GAP_TABLE = np.isin(np.arange(256), list(_GAPS + b"\n\t\r"))
_LETTER_TABLE = np.array([97 <= c <= 122 for c in range(256)])


def trigram_counts(docs: DataFrame) -> DataFrame:
    """(gram, n): how often each character trigram occurs in all whole texts."""
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(_BASE**3, dtype=np.int64)
        for pdf in batches:
            for text in pdf["text"]:
                s = np.frombuffer(b"\0\0" + text.encode("utf-8", "surrogatepass").translate(_SYMBOL) + b"\0", dtype=np.uint8).astype(np.int32)
                total += np.bincount((s[:-2] << 10) | (s[1:-1] << 5) | s[2:], minlength=_BASE**3)
        at = np.nonzero(total)[0]
        yield pd.DataFrame({"gram": at.astype(np.int32), "n": total[at]})

    grams = docs.select(whole_text().alias("text")).mapInPandas(run, "gram int, n long")
    return grams.groupBy("gram").agg(F.sum("n").alias("n"))


def character_model(docs: DataFrame) -> np.ndarray:
    """log P(next | two before) as a 32 x 32 x 32 table, mixed with shorter contexts."""
    tri = np.zeros(_BASE**3)
    for row in trigram_counts(docs).collect():  # at most 32,768 rows
        tri[row.gram] = row.n
    tri = tri.reshape(_BASE, _BASE, _BASE)
    bi, uni = tri.sum(axis=0), tri.sum(axis=(0, 1))
    p1 = (uni + 1) / (uni.sum() + _BASE)
    p2 = (bi + 5 * p1) / (bi.sum(axis=1, keepdims=True) + 5)
    return np.log((tri + 5 * p2) / (tri.sum(axis=2, keepdims=True) + 5))


def _arcs(word: bytes) -> list[list[tuple[bytes, float]]]:
    """The lattice of a disguised word: for each run of equal characters what it may stand for."""
    lattice = []
    for m in _RUN.finditer(word):
        c, n = m[1], len(m[0])
        if c in b" ._-":
            lattice.append([(b"", 0.0), (b" ", COST_GAP_KEPT)])
        elif c.isalpha():
            once, twice = (c, 0.0 if n == 1 else COST_SHORTER if n > 2 else 2.0), (c + c, 0.0 if n == 2 else COST_SHORTER + 0.2)
            lattice.append([once] if n == 1 else [once, twice])
        elif c.decode("latin-1") in SIGNS:
            options = [(x.encode(), COST_SIGN) for x in SIGNS[c.decode()]]
            if n > 1:
                options += [(2 * x.encode(), COST_SIGN + 0.5) for x in SIGNS[c.decode()]]
            lattice.append([*options, (b" ", COST_KEPT_SIGN)])
        else:
            lattice.append([(b" ", 0.0)] if c < b"\x80" else [(c * n, 0.0)])
    return lattice


def decode(word: bytes, model: np.ndarray) -> bytes:
    """The likeliest plain spelling: Viterbi over the lattice, a state per last two symbols."""
    states: dict[tuple[int, int], tuple[float, bytes]] = {(0, 0): (0.0, b"")}
    for options in [*_arcs(word), [(b" ", 0.0)]]:
        after: dict[tuple[int, int], tuple[float, bytes]] = {}
        for (a, b), (cost, text) in states.items():
            for out, price in options:
                x, y, total = a, b, cost + price
                for c in out:
                    z = _SYMBOL[c]
                    total -= model[x, y, z]
                    x, y = y, z
                if (x, y) not in after or total < after[x, y][0]:
                    after[x, y] = (total, text + out)
        states = after
    return min(states.values())[1].strip()


class Restorer:
    """Undo disguised spelling in whole lower-cased texts; plain texts pass untouched."""

    def __init__(self, model: np.ndarray, remembered: int = 100_000):
        self.model, self.known, self.remembered = model, {}, remembered

    def _plain(self, word: bytes) -> bytes:
        if word not in self.known:
            if len(self.known) >= self.remembered:
                self.known.clear()
            self.known[word] = decode(word, self.model)
        return self.known[word]

    def _word(self, token: bytes) -> bytes:
        core = token.rstrip(_TAIL)
        return self._plain(core) + token[len(core) :] if _DISGUISED.search(core) else token

    def restore(self, text: str) -> bytes:
        """UTF-8 of the text in lower case with its disguised words spelled plainly.

        White space is kept only where nothing is disguised.
        """
        raw = text.lower().encode("utf-8", "surrogatepass")
        a = np.frombuffer(raw, dtype=np.uint8)
        if len(a) > 4:
            gap = _GAP_TABLE[a]
            lone = gap[:-2] & ~gap[1:-1] & gap[2:]
            if (lone[:-2] & lone[2:]).any() or (not gap[0] and len(a) < 64):
                raw = _SPACED.sub(lambda m: self._plain(m[0]), raw)
        runs = (a[2:] == a[1:-1]) & (a[1:-1] == a[:-2]) & _LETTER_TABLE[a[2:]] if len(a) > 2 else a[:0]
        if runs.any() or raw.translate(None, _NOT_SIGNS):
            tokens = raw.split()
            changed = {t: w for t in set(tokens) if (w := self._word(t)) != t}
            if changed:
                raw = b" ".join([changed.get(t, t) for t in tokens])
        return raw


def restored_words(raw: bytes) -> list[bytes]:
    return raw.translate(_WORDS).split()


@dataclass(frozen=True)
class Lexicon:
    """Weight of each word that tells toxic texts from others."""

    weights: dict[bytes, float]

    def features(self, words: list[bytes]) -> tuple[float, float, float]:
        """Different weighing words, their summed weight, log of all their occurrences."""
        found = set(words) & self.weights.keys()
        if not found:
            return 0.0, 0.0, 0.0
        return float(len(found)), sum(self.weights[w] for w in sorted(found)), float(np.log1p(sum(map(words.count, found))))


def learn_lexicon(sampled: DataFrame, model: np.ndarray) -> Lexicon:
    """Words of restored sample texts by their log odds between the two labels.

    Texts are counted by the smallest hash among their words, so a group of
    copies or near copies counts about once.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        restorer = Restorer(model)
        for pdf in batches:
            rows = []
            for text, label in zip(pdf["text"], pdf["label"]):
                words = set(restored_words(restorer.restore(text)))
                if words:
                    key = min(xxhash.xxh64_intdigest(w) for w in words) >> 1
                    rows += [(w, label, key) for w in words]
            yield pd.DataFrame(rows, columns=["word", "label", "key"])

    rows = sampled.select("text", "label").mapInPandas(run, "word binary, label double, key long").distinct()
    stored = write_table(rows, "words")
    one = F.col("label") == 1
    p_all, n_all = stored.agg(F.count_distinct(F.when(one, F.col("key"))), F.count_distinct(F.when(~one, F.col("key")))).first()
    counts = stored.groupBy("word").agg(F.count_if(one).alias("p"), F.count_if(~one).alias("n"))
    p, n = F.col("p") + 0.5, F.col("n") + 0.5
    odds = F.log(p / (F.lit(p_all + 1.0) - p)) - F.log(n / (F.lit(n_all + 1.0) - n))
    z = odds / F.sqrt(1 / p + 1 / n)
    strong = counts.where(F.col("p") >= max(MIN_TEXTS, MIN_SHARE * p_all)).select("word", odds.alias("odds"), z.alias("z")).where(F.col("z") >= MIN_Z)
    return Lexicon({bytes(r.word): r.odds for r in strong.orderBy(F.desc("z"), "word").limit(LEXICON_WORDS).collect()})


_FEATURES = ["n_words", "weight", "log_uses"]


def lexicon_features(docs: DataFrame, model: np.ndarray, lexicon: Lexicon, keep: str) -> DataFrame:
    """The columns in ``keep`` (name and type) with the features of each restored text."""
    names = [c.strip().split()[0] for c in keep.split(",")]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        restorer = Restorer(model)
        for pdf in batches:
            values = [lexicon.features(restored_words(restorer.restore(t))) for t in pdf["text"]]
            rows = pd.DataFrame(values, columns=_FEATURES, dtype=float)
            yield pd.concat([pdf[names].reset_index(drop=True), rows], axis=1)

    return docs.select(*names, "text").mapInPandas(run, keep + "".join(f", {f} double" for f in _FEATURES))


def restore_texts(docs: DataFrame, model: np.ndarray, loc: str = "loc") -> DataFrame:
    """(loc, restored): each whole text of located ``docs`` in plain lower-case spelling."""
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        restorer = Restorer(model)
        for pdf in batches:
            yield pd.DataFrame({"loc": pdf["loc"], "restored": [restorer.restore(t).decode("utf-8", "replace") for t in pdf["text"]]})

    return docs.select(F.col(loc).alias("loc"), whole_text().alias("text")).mapInPandas(run, "loc string, restored string")


def _calibrate(rows: DataFrame) -> Callable[[DataFrame], DataFrame]:
    """Fit a logistic curve on stored features; gives a function that adds ``score``."""
    n, ones = rows.agg(F.count("*"), F.sum("label")).first()
    if not n or ones in (0, n):
        rate = 0.5 if not n else (ones + 0.5) / (n + 1)
        return lambda df: df.withColumn("score", F.lit(float(rate)))
    assembler = VectorAssembler(inputCols=_FEATURES, outputCol="features")
    fitted = LogisticRegression(regParam=1e-4, maxIter=50).fit(assembler.transform(rows).select("label", "features"))
    return lambda df: fitted.transform(assembler.transform(df)).withColumn("score", F.get(vector_to_array("probability"), F.lit(1)))


def score(docs: DataFrame, labels: DataFrame, loc: str = "loc", rows: int = SAMPLE_ROWS) -> DataFrame:
    """loc, doc_id, held_out, score, predicted per row of located ``docs``.

    The character model counts all whole texts of ``docs``; lexicon and curve
    are learned from a bounded labelled sample outside the held-out fold.
    NULL is the empty text and gets the score of a text without any weighing
    word; without labels of both classes every score is the base rate (0.5
    without labels). Repeated rows get equal scores; an empty table gives an
    empty result.
    """
    small_batches(docs.sparkSession)
    texts = docs.select(F.col(loc).alias("loc"), F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"))
    model = character_model(texts)
    sample = F.broadcast(labelled_sample(labels, "toxic", rows))
    sampled = write_table(texts.join(sample, "doc_id").select("doc_id", "label", "text"), "toxic-sample")
    lexicon = learn_lexicon(sampled, model)
    curve = _calibrate(write_table(lexicon_features(sampled, model, lexicon, "label double"), "toxic-features"))
    found = lexicon_features(texts, model, lexicon, "loc string, doc_id long")
    scored = curve(found).select("loc", "doc_id", held_out().alias("held_out"), "score")
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
