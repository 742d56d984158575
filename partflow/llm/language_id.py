"""Language identification by segmentation-marginalised unigrams.

Every language has probabilities for the pieces of one fixed public byte-level vocabulary. The score
of a word is its probability summed over all its segmentations into pieces, which a forward pass
computes for all languages at once; a text's score is the product over its words. Probabilities are
fitted by expectation-maximisation, with a forward and a backward pass over the same segmentations.
Words whose probabilities leave the range of doubles on the way take the same passes with logarithms,
so that no word is cut, however long, and no script is beyond the model.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from partflow.llm.common import table

VOCABULARY = "/opt/tokenizers/byte_bpe_multi_50k.tiktoken"
#: The model is fitted on about this many documents of each language: a bound, whatever the corpus.
TRAIN_DOCUMENTS = 300
ROUNDS, PSEUDO_COUNT = 4, 0.02
UNDECIDED = "und"
_LETTERS = re.compile(r"[^\W\d_]+")
_BASE = 12.0  # keeps the forward pass in range: about the reciprocal probability of a byte
_RANGE = 1e-140, 1e140  # outside, a pass takes logarithms
#: Bytes of the words of a lattice, with the padding to its longest word.
LATTICE_BYTES = 100_000


def words_of(text: str | None) -> list[str]:
    """Runs of letters, lower-cased."""
    return _LETTERS.findall(text.lower()) if text else []


def load_pieces(path: str = VOCABULARY) -> Pieces:
    with open(path, "rb") as file:
        pieces = [base64.b64decode(line.split()[0]) for line in file if line.strip()]
    return with_beginnings(dict.fromkeys([*pieces, *(bytes([b]) for b in range(256))]))  # every word has a segmentation


class Pieces(dict):
    """Numbers of the pieces; -1 for what only begins one. Also as a table that finds many at once.

    Each beginning is a node; the table holds, for a node and a byte, the node of both together, by
    linear probing of hashes.
    """

    def __init__(self, pieces):
        super().__init__((p, i) for i, p in enumerate(pieces))
        for p in list(self):
            for n in range(1, len(p)):
                self.setdefault(p[:n], -1)
        node = {b"": 0} | {p: i for i, p in enumerate(self, 1)}
        keys = np.array([node[p[:-1]] * 256 + p[-1] for p in self], np.int64)
        self.number = np.array([-1, *self.values()], np.int64)
        bits = max(10, (8 * len(keys)).bit_length())
        self.shift, self.key, self.child = np.uint64(64 - bits), np.full(1 << bits, -1, np.int64), np.zeros(1 << bits, np.int32)
        left, at = np.arange(len(keys)), self._place(keys)
        while len(left):
            free = self.key[at] < 0
            self.key[at[free]] = keys[left[free]]  # of several for one place, one gets it
            done = self.key[at] == keys[left]
            self.child[at[done]] = left[done] + 1
            left, at = left[~done], (at[~done] + 1) % len(self.key)

    def __reduce__(self):
        return _unpickled, (dict(self), self.__dict__)

    def _place(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def further(self, node: np.ndarray, byte: np.ndarray) -> np.ndarray:
        """The nodes one byte further on; 0 where no piece begins so."""
        keys = node * 256 + byte
        at = self._place(keys)
        found = self.key[at]
        out = np.where(found == keys, self.child[at], 0)
        missed = np.flatnonzero((found != keys) & (found >= 0))
        while len(missed):
            at[missed] = (at[missed] + 1) % len(self.key)
            found = self.key[at[missed]]
            hit = found == keys[missed]
            out[missed[hit]] = self.child[at[missed[hit]]]
            missed = missed[~hit & (found >= 0)]
        return out


def _unpickled(pieces: dict, state: dict) -> Pieces:
    out = Pieces.__new__(Pieces)
    out.update(pieces)
    out.__dict__.update(state)
    return out


def with_beginnings(pieces) -> Pieces:
    return Pieces(pieces)


class Lattice:
    """All segmentations of words: edges (word, start, end, piece), ordered by where they end."""

    def __init__(self, words: list[str], pieces: Pieces):
        coded = [(" " + w).encode() for w in words]
        self.size = np.fromiter(map(len, coded), np.int64, len(coded))
        text, begins = np.frombuffer(b"".join(coded), np.uint8).astype(np.int64), np.cumsum(self.size) - self.size
        word = np.repeat(np.arange(len(coded)), self.size)
        first, node, n, edges = np.arange(len(text)), np.zeros(len(text), np.int64), 0, []
        while len(first):  # all places at once: those from which a piece goes on for n bytes
            node = pieces.further(node, text[first + n]).astype(np.int64)
            n += 1
            piece = pieces.number[node]
            is_piece = (node > 0) & (piece >= 0)
            at, of = first[is_piece], word[first[is_piece]]
            start = at - begins[of]
            edges.append(np.stack([start + n, of, start, piece[is_piece]]))
            more = (node > 0) & (first + n < begins[word[first]] + self.size[word[first]])
            first, node = first[more], node[more]
        edges = np.concatenate(edges, axis=1) if edges else np.zeros((4, 0), np.int64)
        self.end, self.word, self.start, self.piece = edges[:, np.argsort(edges[0], kind="stable")]
        self.longest = int(self.size.max(initial=0))
        self.cut = np.searchsorted(self.end, np.arange(self.longest + 2))
        self.scale = _BASE ** (self.end - self.start)

    def forward(self, p: np.ndarray) -> np.ndarray:
        """alpha[word, position, language]: summed probability of the bytes so far, times _BASE per byte."""
        n, langs = len(self.size), p.shape[1]
        alpha = np.zeros((n, self.longest + 1, langs))
        alpha[:, 0] = 1
        for t in range(1, self.longest + 1):
            e = slice(self.cut[t], self.cut[t + 1])
            with np.errstate(over="ignore", invalid="ignore"):
                step = alpha[self.word[e], self.start[e]] * p[self.piece[e]] * self.scale[e, None]
            for k in range(langs):
                alpha[:, t, k] = np.bincount(self.word[e], step[:, k], n)
        return alpha

    def in_range(self, alpha: np.ndarray) -> np.ndarray:
        """The words whose values all stay far from the smallest and the largest doubles."""
        inside = np.arange(self.longest + 1)[None, :, None] <= self.size[:, None, None]
        values = np.where(inside, alpha, 1.0).reshape(len(alpha), -1)
        return (values.min(axis=1, initial=1.0) > _RANGE[0]) & (values.max(axis=1, initial=1.0) < _RANGE[1])

    def forward_log(self, log_p: np.ndarray, backward: bool = False) -> np.ndarray:
        """log of the summed probability of the bytes before (backward: from) each position: [word, position, language]."""
        n, langs = len(self.size), log_p.shape[1]
        out = np.full((n, self.longest + 1, langs), -np.inf)
        out[np.arange(n), self.size if backward else 0] = 0
        to, source = (self.start, self.end) if backward else (self.end, self.start)
        order = np.lexsort((self.word, -to if backward else to))
        places, first = np.unique(-to[order] if backward else to[order], return_index=True)
        for place, a, b in zip(np.abs(places), first, [*first[1:], len(order)]):
            e = order[a:b]
            step = out[self.word[e], source[e]] + log_p[self.piece[e]]
            starts = np.flatnonzero(np.diff(self.word[e], prepend=-1))
            top = np.maximum.reduceat(step, starts)
            top[np.isneginf(top)] = 0
            each = np.repeat(top, np.diff(starts, append=len(e)), axis=0)
            with np.errstate(divide="ignore"):
                out[self.word[e][starts], place] = top + np.log(np.add.reduceat(np.exp(step - each), starts))
        return out

    def log_likelihood(self, p: np.ndarray, words: list[str], pieces: Pieces) -> np.ndarray:
        """log P(word | language), an array (word, language)."""
        alpha = self.forward(p)
        rows = np.arange(len(self.size))
        # The bytes one by one are a segmentation: short words can't leave the range.
        least = min(p[pieces[x]].min() if pieces.get(x := bytes([b]), -1) >= 0 else 0.0 for b in range(256))
        short = self.longest < 128 and (least * _BASE) ** self.longest > _RANGE[0]
        ok = np.ones(len(rows), bool) if short else self.in_range(alpha)
        with np.errstate(divide="ignore"):
            out = np.log(alpha[rows, self.size]) - (self.size * np.log(_BASE))[:, None]
            log_p = None if ok.all() else np.log(p)
        for i in np.flatnonzero(~ok):
            one = Lattice([words[i]], pieces)
            out[i] = one.forward_log(log_p)[0, one.size[0]]
        return out

    def expected(self, p: np.ndarray, weight: np.ndarray, words: list[str], pieces: Pieces) -> np.ndarray:
        """Expected counts (piece, language) for words seen ``weight[word, language]`` times."""
        alpha = self.forward(p)
        n, langs = weight.shape
        beta = np.zeros_like(alpha)
        beta[np.arange(n), self.size] = 1
        by_start = np.argsort(-self.start, kind="stable")
        cut = np.searchsorted(-self.start[by_start], np.arange(-self.longest, 2))
        for t in range(self.longest - 1, -1, -1):
            e = by_start[cut[self.longest - t] : cut[self.longest - t + 1]]
            with np.errstate(over="ignore", invalid="ignore"):
                step = beta[self.word[e], self.end[e]] * p[self.piece[e]] * self.scale[e, None]
            for k in range(langs):
                beta[:, t, k] += np.bincount(self.word[e], step[:, k], n)
        ok = self.in_range(alpha) & self.in_range(beta)
        total = np.where(ok[:, None], alpha[np.arange(n), self.size], 1.0)
        e = np.flatnonzero(ok[self.word])
        share = alpha[self.word[e], self.start[e]] * beta[self.word[e], self.end[e]] * p[self.piece[e]] * self.scale[e, None]
        share *= (weight / total)[self.word[e]]
        out = np.stack([np.bincount(self.piece[e], share[:, k], len(p)) for k in range(langs)], axis=1).astype(float)
        for i in np.flatnonzero(~ok):
            with np.errstate(divide="ignore"):
                one, log_p = Lattice([words[i]], pieces), np.log(p)
            a, z = one.forward_log(log_p), one.forward_log(log_p, backward=True)
            log_share = a[0, one.start] + z[0, one.end] + log_p[one.piece] - a[0, one.size[0]]
            np.add.at(out, one.piece, np.exp(log_share) * weight[i])
        return out


def in_lattices(words: list[str], pieces: Pieces) -> Iterator[tuple[list[int], list[str], Lattice]]:
    """The places of the words, the words and their lattice, for parts of words of like length."""
    order = sorted(range(len(words)), key=lambda i: len(words[i]))
    at = 0
    while at < len(order):
        upto = at + 1
        while upto < len(order) and (upto + 1 - at) * (len(words[order[upto]]) + 1) <= LATTICE_BYTES:
            upto += 1
        part = [words[i] for i in order[at:upto]]
        yield order[at:upto], part, Lattice(part, pieces)
        at = upto


def fit(counts: list[tuple[str, str, int]], pieces: Pieces, rounds: int = ROUNDS) -> tuple[list[str], np.ndarray]:
    """Languages, sorted, and probabilities (piece, language) from rows (language, word, count)."""
    langs = sorted({lang for lang, _, _ in counts})
    words = sorted({w for _, w, _ in counts})
    place, column = {w: i for i, w in enumerate(words)}, {x: i for i, x in enumerate(langs)}
    weight = np.zeros((len(words), len(langs)))
    for lang, word, n in counts:
        weight[place[word], column[lang]] += n
    n_pieces = max(pieces.values(), default=-1) + 1
    p = np.full((n_pieces, len(langs)), 1 / max(1, n_pieces))
    lattices = list(in_lattices(words, pieces)) if langs else []
    for _ in range(rounds if langs else 0):
        c = sum(x.expected(p, weight[at], part, pieces) for at, part, x in lattices) + PSEUDO_COUNT
        p = c / c.sum(axis=0)
    return langs, p


def training_counts(documents: DataFrame, lang: Column, per_language: int = TRAIN_DOCUMENTS) -> list[tuple[str, str, int]]:
    """Word counts (language, word, count) of about per_language documents of each language, chosen by hash."""
    rows = documents.select(lang.alias("lang"), "text", F.xxhash64("doc_id", "text").alias("h")).filter("lang is not null")
    many = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}
    chosen = F.lit(False)
    for name, n in sorted(many.items()):
        chosen = chosen | ((F.col("lang") == name) & (F.pmod("h", F.lit(1_000_000)) < int(1e6 * min(1.0, per_language / n)) + 1))

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for name, text in zip(batch.lang, batch.text):
                found = pd.Series(words_of(text), dtype=object).value_counts()
                yield pd.DataFrame({"lang": name, "word": found.index.astype(str), "n": found.to_numpy()})

    found = rows.filter(chosen).select("lang", "text").mapInPandas(count, "lang string, word string, n long")
    return [tuple(r) for r in found.groupBy("lang", "word").agg(F.sum("n")).collect()]


class Scorer:
    """Scores texts; remembers the scores of words."""

    def __init__(self, langs: list[str], p: np.ndarray, pieces: Pieces, memory: int = 200_000):
        self.langs, self.p, self.pieces, self.memory = langs, p, pieces, memory
        self.place: dict[str, int] = {}
        self.known = np.zeros((memory, len(langs)))

    def _learn(self, words: list[str]) -> np.ndarray:
        out = np.empty((len(words), len(self.langs)))
        for at, part, lattice in in_lattices(words, self.pieces):
            out[at] = lattice.log_likelihood(self.p, part, self.pieces)
        return out

    def __call__(self, texts) -> tuple[list[str], list[float]]:
        each = [words_of(t) for t in texts]
        new = sorted({w for words in each for w in words if w not in self.place}) if self.langs else []
        if len(self.place) + len(new) > self.memory:
            self.place = {}
            new = sorted({w for words in each for w in words})
            self.known = self.known if len(new) <= len(self.known) else np.zeros((len(new), len(self.langs)))
        if new:
            first = len(self.place)
            self.known[first : first + len(new)] = self._learn(new)
            self.place.update(zip(new, range(first, first + len(new))))
        names, scores = [], []
        for words in each:
            if not words or not self.langs:
                names.append(UNDECIDED)
                scores.append(0.0)
                continue
            at = np.fromiter(map(self.place.__getitem__, words), np.int64, len(words))
            total = self.known[at].sum(axis=0)
            best = int(total.argmax())
            names.append(self.langs[best])
            scores.append(float(1 / np.exp(total - total[best]).sum()))
        return names, scores


def identify(documents: DataFrame, learn_from: Column, vocabulary: str = VOCABULARY, per_language: int = TRAIN_DOCUMENTS) -> DataFrame:
    """The input's rows and columns with lang_pred and score.

    Learns from text and lang of the rows for which learn_from holds and lang isn't null; a
    prediction depends on the text alone. score is the probability of the predicted language among
    the learned ones, all equally likely beforehand. A text that is null or has no letter, and any
    text if nothing was learned, is ``und`` with score 0. Of equal scores the first name wins. Rows
    that repeat are treated alike. Texts and words of any length and script are taken whole. Input
    columns with one of the two names are replaced; an empty table gives an empty result.
    """
    pieces = load_pieces(vocabulary)
    langs, p = fit(training_counts(documents.filter(learn_from), F.col("lang"), per_language), pieces)
    model = documents.sparkSession.sparkContext.broadcast((langs, p, pieces))

    @F.pandas_udf("lang_pred string, score double")
    def predict(series: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        scorer = Scorer(*model.value)
        for texts in series:
            names, scores = [], []
            for i in range(0, len(texts), 250):
                a, b = scorer(texts.iloc[i : i + 250])
                names, scores = names + a, scores + b
            yield pd.DataFrame({"lang_pred": names, "score": scores})

    out = documents.drop("lang_pred", "score").withColumn("__found", predict("text"))
    return out.select(*[c for c in out.columns if c != "__found"], "__found.lang_pred", "__found.score")


def bucket_of(doc_id: Column, n: int) -> Column:
    """crc32(doc_id as text) mod n; a null doc_id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % n


def op5_language_id(spark, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = bucket_of(F.col("doc_id"), 3) == 1
    return identify(documents, ~held_out).select("doc_id", held_out.alias("held_out"), "lang_pred", "score")
