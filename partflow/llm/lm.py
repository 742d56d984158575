"""Language-model scoring: a log-bilinear neural model, trained in numpy with noise-contrastive estimation.

Counts of all training tokens give a smoothed unigram model over the whole vocabulary. The neural
model has vectors for the words with LEAST_COUNT training tokens or more (of more than MOST_WORDS, for the
most frequent), for any other word, and for the end. It predicts a token from the two before: their vectors,
times a matrix for each place, add up to a predicted vector. Words stand in classes, so that the
model is exactly normalised at little cost: the predicted vector's products with the classes' vectors and biases
give the class, those with the vectors of the class's words the word in it. A word without a vector
has the probability of its class times its smoothed share of the counts of such words.

Both levels learn by noise-contrastive estimation: first on a bounded sample on the driver, then on all
training documents: each task passes over all positions of the documents that it reads, and the
executors' parameters are averaged row by row, weighted by how often a row was used. Scores are
batched matrix products over all tokens.

Counts of words reach the documents by a join of blocks: a task collects the documents it reads into
blocks, and sends each word of a block once, with the numbers of its documents and its counts there.
"""

from __future__ import annotations

import itertools
import math
import uuid
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from partflow.llm.common import table, text_hash, written
from partflow.llm.language_id import bucket_of

SMOOTHING = 0.1
#: Words with a vector of their own: a bound, as the model is broadcast (8192 words: 2 MB).
MOST_WORDS, LEAST_COUNT, FEATURES = 8192, 20, 32
#: Noise classes of a batch, noise words of a class in it, and tokens of a batch.
NOISE_CLASSES, NOISE_WORDS, BATCH = 32, 16, 8192
#: The first parameters come from about so many documents of at most so many bytes; then all positions of all documents are learned.
SAMPLE_DOCUMENTS, SAMPLE_BYTES, EPOCHS, RATE, LATER_RATE = 1500, 1 << 16, 4, 0.15, 0.05
BLOCK_TOKENS = 2_000_000
END_TOKEN = b"\n"  # no word


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode().lower().split()


class _Numbers(dict):
    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self)
        return n


def token_blocks(documents: DataFrame) -> DataFrame:
    """For documents (doc_id, text_key, text, train): a row for each document and for each word of a block.

    A document's row: block, number, doc_id, text_key, n_tokens. A word's row: block, word,
    n_train (its tokens in training documents), docs and counts. Ends are counted as a word.
    """
    kind = documents.schema["doc_id"].dataType.simpleString()
    schema = f"block long, number int, doc_id {kind}, text_key long, n_tokens long, word binary, n_train long, docs array<int>, counts array<int>"

    def flush(block, ids, words, train):
        pair, n = np.unique(np.concatenate([(x << 32) | i for i, x in enumerate(ids)]), return_counts=True)
        word, doc = pair >> 32, (pair & 0xFFFFFFFF).astype(np.int32)
        of_train = np.bincount(word, n * train[doc], len(words)).astype(np.int64)
        cut = np.searchsorted(word, np.arange(len(words) + 1)).astype(np.int32)
        names = list(words)
        for a in range(0, len(names), 20_000):
            b = min(a + 20_000, len(names))
            lists = lambda x: pa.ListArray.from_arrays(pa.array(cut[a : b + 1] - cut[a]), pa.array(x[cut[a] : cut[b]].astype(np.int32)))  # noqa: B023, E731
            yield {"block": [block] * (b - a), "word": names[a:b], "n_train": of_train[a:b], "docs": lists(doc), "counts": lists(n)}

    def collect(batches):
        def batch_of(columns: dict, n: int) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [x if isinstance(x := columns.get(f.name), pa.Array) else pa.array(x, f.type) if x is not None else pa.nulls(n, f.type) for f in fields], schema=fields
            )

        words, ids, train, held, block = _Numbers(), [], [], 0, uuid.uuid4().int >> 65
        fields = None
        for batch in batches:
            if fields is None:
                fields = pa.schema([
                    ("block", pa.int64()), ("number", pa.int32()), ("doc_id", batch.schema.field("doc_id").type), ("text_key", pa.int64()), ("n_tokens", pa.int64()),
                    ("word", pa.binary()), ("n_train", pa.int64()), ("docs", pa.list_(pa.int32())), ("counts", pa.list_(pa.int32())),
                ])
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                first, sizes = len(ids), []
                for text, learn in zip(part.column("text"), part.column("train")):
                    tokens = words_of(text.as_py())
                    tokens.append(END_TOKEN)
                    ids.append(np.fromiter(map(words.__getitem__, tokens), np.int64, len(tokens)))
                    train.append(learn.as_py())
                    sizes.append(len(tokens))
                    held += len(tokens)
                n = part.num_rows
                rows = {"block": [block] * n, "number": np.arange(first, first + n, dtype=np.int32), "doc_id": part.column("doc_id"), "text_key": part.column("text_key"), "n_tokens": sizes}
                yield batch_of(rows, n)
                if held >= BLOCK_TOKENS:
                    for x in flush(block, ids, words, np.array(train)):
                        yield batch_of(x, len(x["word"]))
                    words, ids, train, held, block = _Numbers(), [], [], 0, uuid.uuid4().int >> 65
        if ids:
            for x in flush(block, ids, words, np.array(train)):
                yield batch_of(x, len(x["word"]))

    return documents.select("doc_id", "text_key", "text", "train").mapInArrow(collect, schema)


@dataclass
class Vocabulary:
    """Words by falling count, then any other word, then the end; classes are runs of words, the other and the end."""

    words: list[bytes]
    share: np.ndarray  # of all training tokens, for each word, the others and the end
    cut: np.ndarray  # where each class begins, and the number of tokens that have a vector

    @staticmethod
    def of(words: list[bytes], counts: np.ndarray, others: int, ends: int) -> Vocabulary:
        n = np.concatenate([counts, [others, ends]]).astype(np.float64) + 0.5
        upto = np.cumsum(np.sqrt(n[:-2]))
        classes = np.floor(upto / (upto[-1] * 1.0001) * math.ceil(math.sqrt(len(words)))) if words else upto
        cut = np.flatnonzero(np.diff(classes, prepend=-1)).tolist() + [len(words), len(words) + 1, len(words) + 2]
        return Vocabulary(words, n / n.sum(), np.array(cut))

    @property
    def other(self) -> int:
        return len(self.words)

    @property
    def end(self) -> int:
        return len(self.words) + 1

    def numbers(self) -> _Known:
        return _Known(zip(self.words, range(len(self.words))), other=self.other)


class _Known(dict):
    def __init__(self, pairs, other: int):
        super().__init__(pairs)
        self.other = other

    def __missing__(self, word: bytes) -> int:
        return self.other


def tokens_of(texts: list[str | None], known: _Known, end: int) -> tuple[np.ndarray, np.ndarray]:
    """The numbers of the texts' tokens, two ends before each text, and where each text begins."""
    out, starts = [], [0]
    for text in texts:
        words = words_of(text)
        out += [end, end, *map(known.get, words, itertools.repeat(known.other)), end]
        starts.append(starts[-1] + len(words) + 3)
    return np.array(out, np.int64), np.array(starts)


class Model:
    """The parameters, as rows of one matrix: vectors and biases of tokens, of classes, and the two matrices."""

    def __init__(self, vocabulary: Vocabulary, rows: np.ndarray | None = None, seed: int = 3):
        self.vocabulary, cut = vocabulary, vocabulary.cut
        n, c, d = cut[-1], len(cut) - 1, FEATURES
        self.class_of = np.repeat(np.arange(c), np.diff(cut))
        self.class_share = np.add.reduceat(vocabulary.share, cut[:-1])
        self.in_class = vocabulary.share / self.class_share[self.class_of]
        if rows is None:
            rng = np.random.default_rng(seed)
            rows = rng.normal(0, 0.1, (2 * n + c + 2 * d, d + 1)).astype(np.float32)
            rows[n : 2 * n, d], rows[2 * n : 2 * n + c, d] = np.log(self.in_class), np.log(self.class_share)
            rows[2 * n + c :, :d] = np.concatenate([np.eye(d) * 0.5, np.eye(d)]) + rng.normal(0, 0.01, (2 * d, d))
        self.rows = rows
        self.q, self.r, self.b = rows[:n, :d], rows[n : 2 * n, :d], rows[n : 2 * n, d]
        self.rc, self.bc = rows[2 * n : 2 * n + c, :d], rows[2 * n : 2 * n + c, d]
        self.m1, self.m2 = rows[2 * n + c : 2 * n + c + d, :d], rows[2 * n + c + d :, :d]

    def log_probabilities(self, before: np.ndarray, last: np.ndarray, token: np.ndarray) -> np.ndarray:
        """Natural log-probabilities of tokens after (before, last); of a token without a vector, of its class.

        Of the trigrams and contexts that occur several times in a run of tokens, each is computed once.
        """
        n, d, cut = len(self.q), FEATURES, self.vocabulary.cut
        of_before, of_last = np.ones((n, d + 1), np.float32), np.zeros((n, d + 1), np.float32)
        np.matmul(self.q, self.m1, out=of_before[:, :d])
        np.matmul(self.q, self.m2, out=of_last[:, :d])
        words, classes = self.rows[n : 2 * n], self.rows[2 * n : 2 * n + len(cut) - 1]
        out = np.empty(len(token))
        for at in range(0, len(token), 65_536):
            part = slice(at, at + 65_536)
            key = (before[part].astype(np.int64) * n + last[part]) * n + token[part]  # a broadcast model has less than 2 million tokens
            order = np.argsort(key)
            starts = np.flatnonzero(np.diff(key[order], prepend=-1))
            context, w = np.divmod(key[order[starts]], n)
            firsts = np.flatnonzero(np.diff(context, prepend=-1))
            of = np.repeat(np.arange(len(firsts)), np.diff(firsts, append=len(context)))
            v = of_before.take(context[firsts] // n, axis=0)
            v += of_last.take(context[firsts] % n, axis=0)
            c, got = self.class_of[w], np.empty(len(w))
            for a in range(0, len(firsts), 2048):
                upto = firsts[a + 2048] if a + 2048 < len(firsts) else len(w)
                rows = slice(firsts[a], upto)
                got[rows] = _chosen(v[a : a + 2048] @ classes.T, of[rows] - a, c[rows])
            by_class = np.argsort(_short(c, len(cut)), kind="stable")
            ends = np.searchsorted(c[by_class], np.arange(len(cut)))
            for k in range(len(cut) - 1):
                rows = by_class[ends[k] : ends[k + 1]]
                if len(rows) and cut[k + 1] - cut[k] > 1:
                    scores = v.take(of[rows], axis=0) @ words[cut[k] : cut[k + 1]].T
                    got[rows] += _chosen(scores, np.arange(len(rows)), w[rows] - cut[k])
            out[at + order] = np.repeat(got, np.diff(starts, append=len(key)))
        return out


def _chosen(scores: np.ndarray, row: np.ndarray, column: np.ndarray) -> np.ndarray:
    """The log of the softmax of rows of scores at (row, column); scores are used up."""
    if max(scores.max(), -scores.min()) > 60:  # else no exponential over- or underflows
        scores -= scores.max(axis=1, keepdims=True)
    chosen = scores[row, column].astype(np.float64)
    sums = np.exp(scores, out=scores) @ np.ones(scores.shape[1], scores.dtype)
    return chosen - np.log(sums.astype(np.float64))[row]


class Trainer:
    """Takes steps of noise-contrastive estimation by AdaGrad, and counts how often each row is used."""

    def __init__(self, model: Model, rate: float, seed: int):
        self.model, self.rate, self.rng = model, rate, np.random.default_rng(seed)
        self.squares = np.full(len(model.rows), 1e-2, np.float32)
        self.used = np.zeros(len(model.rows), np.int64)
        self.upto = np.cumsum(model.vocabulary.share)
        self.class_upto = np.cumsum(model.class_share)
        self.log_noise = np.log(NOISE_WORDS * model.in_class).astype(np.float32)

    def _add(self, first: int, rows: np.ndarray, g: np.ndarray) -> None:
        """A step up the gradients g (with the bias's in the last column) of rows, all different."""
        at = first + rows
        self.squares[at] += np.einsum("ij,ij->i", g, g) / g.shape[1]
        self.model.rows[at] += (self.rate / np.sqrt(self.squares[at]))[:, None] * g

    def step(self, before: np.ndarray, last: np.ndarray, w: np.ndarray) -> None:
        """A step on a batch, sorted by token: tokens of a word, and words of a class, then lie together.

        Vectors have a last 1, which meets the bias. What hangs on a token alone is computed once for it: its
        products with the matrices, and, as these are linear, its gradient from the sum over its places.
        """
        m, rng = self.model, self.rng
        n, c_n, d = len(m.q), len(m.rc), FEATURES
        order = np.argsort(_short(w, n), kind="stable")
        before, last, w = before[order], last[order], w[order]
        c, words, classes = m.class_of[w], m.rows[n : 2 * n], m.rows[2 * n : 2 * n + c_n]
        n_q = np.bincount(before, minlength=n) + np.bincount(last, minlength=n)
        seen = np.flatnonzero(n_q)
        place = np.empty(n, np.int64)
        place[seen] = np.arange(len(seen))
        q, at_before, at_last = m.q[seen], place[before], place[last]
        of_before, of_last = np.ones((len(seen), d + 1), np.float32), np.zeros((len(seen), d + 1), np.float32)
        np.matmul(q, m.m1, out=of_before[:, :d])
        np.matmul(q, m.m2, out=of_last[:, :d])
        v = of_before.take(at_before, axis=0)
        v += of_last.take(at_last, axis=0)
        # Classes: the noise is shared by the batch.
        k = np.searchsorted(self.class_upto, rng.random(NOISE_CLASSES) * self.class_upto[-1])
        log_noise, noise = np.log((NOISE_CLASSES * m.class_share).astype(np.float32)), classes[k]
        g_v = classes.take(c, axis=0)
        true = _sigmoid(log_noise[c] - np.einsum("ij,ij->i", v, g_v))
        g_v *= true[:, None]
        noise[:, d] -= log_noise[k]
        false = _sigmoid(v @ noise.T)
        g_v -= false @ noise
        g_class, n_class = np.zeros((c_n, d + 1), np.float32), np.bincount(c, minlength=c_n)
        for of, g in zip(k, false.T @ v):
            g_class[of] -= g
        # Words: the noise is shared by the batch's tokens of a class.
        own = np.flatnonzero(m.in_class[w] < 1)
        v_own, w_own, cut = v[own], w[own], m.vocabulary.cut
        there, starts = np.unique(c[own], return_index=True)
        runs = list(itertools.pairwise([*starts.tolist(), len(own)]))
        low = self.upto[cut[there]] - m.vocabulary.share[cut[there]]
        at = low[:, None] + rng.random((len(there), NOISE_WORDS)) * m.class_share[there, None]
        other = np.searchsorted(self.upto, at).clip(cut[there, None], cut[there + 1, None] - 1)
        g_own, noise = words.take(w_own, axis=0), words[other]
        true2 = _sigmoid(self.log_noise[w_own] - np.einsum("ij,ij->i", v_own, g_own))
        g_own *= true2[:, None]
        noise[:, :, d] -= self.log_noise[other]
        false2 = np.empty((len(own), NOISE_WORDS), np.float32)
        for j, (a, b) in enumerate(runs):
            np.matmul(v_own[a:b], noise[j].T, out=false2[a:b])
        _sigmoid(false2)
        g_noise = np.empty((*other.shape, d + 1), np.float32)
        for j, (a, b) in enumerate(runs):
            g_own[a:b] -= false2[a:b] @ noise[j]
            np.matmul(-false2[a:b].T, v_own[a:b], out=g_noise[j])
        g_v[own] += g_own
        v_own *= true2[:, None]
        r_word = np.concatenate([w_own, other.ravel()])
        g_word, n_word = _row_sums(r_word, np.concatenate([v_own, g_noise.reshape(-1, d + 1)]), n), np.bincount(r_word, minlength=n)
        ends = np.searchsorted(c, np.arange(c_n + 1)).tolist()
        for of in np.flatnonzero(n_class).tolist():
            part = slice(ends[of], ends[of + 1])
            g_class[of] += true[part] @ v[part]
        n_class += np.bincount(k, minlength=c_n)
        g_v[:, d] = 0
        g_before, g_last = _row_sums(at_before, g_v, len(seen)), _row_sums(at_last, g_v, len(seen))
        g_q, g_m = np.zeros((len(seen), d + 1), np.float32), np.concatenate([q.T @ g_before, q.T @ g_last])
        g_q[:, :d] = g_before[:, :d] @ m.m1.T + g_last[:, :d] @ m.m2.T
        of_class, of_word = np.flatnonzero(n_class), np.flatnonzero(n_word)
        steps = (2 * n, of_class, n_class, g_class[of_class]), (n, of_word, n_word, g_word[of_word]), (0, seen, n_q, g_q)
        for first, rows, times, g in (*steps, (2 * n + c_n, np.arange(2 * d), np.ones(2 * d, np.int64), g_m)):
            self.used[first + rows] += times[rows]
            self._add(first, rows, g)


def _short(x: np.ndarray, below: int) -> np.ndarray:
    return x.astype(np.uint16) if below <= 1 << 16 else x  # short numbers sort fast


def _sigmoid(x: np.ndarray) -> np.ndarray:
    """1 / (1 + exp(-x)), in place."""
    np.negative(x, out=x)
    np.minimum(x, 80, out=x)
    np.exp(x, out=x)
    x += 1
    return np.reciprocal(x, out=x)


def _row_sums(at: np.ndarray, x: np.ndarray, n: int) -> np.ndarray:
    """The rows of x, summed by their numbers below n; np.add.at is fast in one dimension alone."""
    k = x.shape[1]
    out = np.zeros(n * k, x.dtype)
    np.add.at(out, (at[:, None] * k + np.arange(k)).ravel(), x.ravel())
    return out.reshape(n, k)


def fit(documents: DataFrame, vocabulary: Vocabulary, sample_documents: int = SAMPLE_DOCUMENTS) -> Model:
    """The model of documents (text): a first one from a sample by hash, then all documents, in tasks."""
    spark, n = documents.sparkSession, documents.count()
    chosen = documents.filter(F.octet_length("text") <= SAMPLE_BYTES).filter(F.pmod(F.xxhash64("text", F.lit(5)), F.lit(1_000_000)) <= int(1e6 * min(1.0, sample_documents / max(1, n))))
    model = Model(vocabulary)
    known = vocabulary.numbers()
    sample = [tokens_of([x], known, vocabulary.end)[0] for x in sorted(r["text"] or "" for r in chosen.select("text").collect())]
    if not sample:
        return model
    trigrams = np.concatenate([np.stack([t[:-2], t[1:-1], t[2:]]) for t in sample], axis=1)
    trainer = Trainer(model, RATE, 3)
    for _ in range(EPOCHS):
        order = trainer.rng.permutation(trigrams.shape[1])
        for at in range(0, len(order), BATCH):
            trainer.step(*trigrams[:, order[at : at + BATCH]])
    shared = spark.sparkContext.broadcast((vocabulary, model.rows, trainer.squares))

    def learn(batches):
        vocabulary, rows, squares = shared.value
        trainer = Trainer(Model(vocabulary, rows.copy()), LATER_RATE, 4)
        trainer.squares[:] = squares
        known, held, size = vocabulary.numbers(), [], 0
        for batch in batches:
            for text in batch.column("text"):
                text = text.as_py() or ""
                t, _ = tokens_of([text], known, vocabulary.end)
                held.append(np.stack([t[:-2], t[1:-1], t[2:]]))
                size += len(t) - 2
                if size >= BATCH:
                    each = np.concatenate(held, axis=1)
                    for first in range(0, size - BATCH + 1, BATCH):
                        trainer.step(*each[:, first : first + BATCH])
                    held, size = [each[:, size - size % BATCH :].copy()], size % BATCH
        if size:
            trainer.step(*np.concatenate(held, axis=1))
        used = np.flatnonzero(trainer.used)
        values = pa.array((trainer.model.rows[used] * trainer.used[used, None]).astype(np.float64).ravel())
        lists = pa.ListArray.from_arrays(pa.array(np.arange(0, len(values) + 1, FEATURES + 1), pa.int32()), values)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(trainer.used[used]), lists], ["row", "n", "x"])

    found = documents.select("text").mapInArrow(learn, "row long, n long, x array<double>").groupBy("row")
    found = found.agg(F.sum("n").alias("n"), *[F.sum(F.col("x")[i]).alias(f"x{i}") for i in range(FEATURES + 1)]).toArrow()
    values = np.stack([found[f"x{i}"].to_numpy() for i in range(FEATURES + 1)], axis=1) / found["n"].to_numpy()[:, None]
    model.rows[found["row"].to_numpy()] = values
    shared.unpersist()
    return model


def score_of(model: Model, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of texts: their tokens' numbers, where each text begins in them, and each token's natural log-probability."""
    tokens, starts = tokens_of(texts, model.vocabulary.numbers(), model.vocabulary.end)
    real = np.ones(len(tokens), bool)
    real[starts[:-1]] = real[starts[:-1] + 1] = False
    at = np.flatnonzero(real)
    return tokens[at], starts - 2 * np.arange(len(starts)), model.log_probabilities(tokens[at - 2], tokens[at - 1], tokens[at])


def score_texts(documents: DataFrame, train, most_words: int = MOST_WORDS, least_count: int = LEAST_COUNT) -> DataFrame:
    """Rows (doc_id, text_key, n_tokens, n_known, train_tokens, base_score, score) for documents (doc_id, text).

    The rows for which train holds are learned from. Tokens are words (A-Z lower-cased, between
    ASCII white space) and one end for each text; a null text is an empty one. base_score is the
    text's log10 probability by the smoothed unigram model, score by the neural one; n_known counts
    the tokens that occur in training text. With nothing to learn from, the unigram model gives
    every token probability 1 (its formula), and the neural one has no words of its own. Rows that repeat are
    scored alike, and each counts in training. Texts of any length are taken whole, one at a time. Other columns
    are ignored, whatever their names; an empty table gives an empty result.
    """
    docs = documents.select("doc_id", text_hash(F.col("text")).alias("text_key"), "text", train.alias("train"))
    blocks = written(token_blocks(docs), "blocks")
    words = blocks.filter("word is not null").select("block", "word", "n_train", "docs", "counts")
    counts = written(words.groupBy("word").agg(F.sum("n_train").alias("c")).filter("c > 0"), "counts")
    total = counts.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.count("*").alias("v")).first()
    end = F.col("word") == F.lit(END_TOKEN)
    top = counts.filter(~end & (F.col("c") >= least_count)).orderBy(F.desc("c"), "word").limit(most_words).collect()
    n_end = sum(r["c"] for r in counts.filter(end).collect())
    n_top = np.array([r["c"] for r in top], np.int64)
    n_rest, v_rest = total["n"] - n_end - int(n_top.sum()), total["v"] - len(top) - (n_end > 0)
    model = fit(docs.filter("train").select("text"), Vocabulary.of([bytes(r["word"]) for r in top], n_top, n_rest, n_end))

    smooth = lambda c, n, v: (c + SMOOTHING) / (n + SMOOTHING * (v + 1))
    base = np.array([math.log10(smooth(c, total["n"], total["v"])) for c in n_top.tolist()] + [0.0, math.log10(smooth(n_end, total["n"], total["v"]))])
    shared = documents.sparkSession.sparkContext.broadcast((model.vocabulary, model.rows, base, n_end > 0))

    def with_vectors(batches):
        """What words with vectors, and ends, decide: known tokens, base score and score; other words are added later."""
        vocabulary, rows, base, end_known = shared.value
        model = Model(vocabulary, rows)
        known = np.arange(len(base)) < vocabulary.other
        known[vocabulary.end] = end_known
        for batch in batches:
            for at in range(0, batch.num_rows, 200):
                part = batch.slice(at, 200)
                tokens, starts, found = score_of(model, part.column("text").to_pylist())
                sums = [np.add.reduceat(x, starts[:-1]) for x in (known[tokens].astype(np.int64), base[tokens], found / math.log(10))]
                columns = [part.column("doc_id"), part.column("text_key"), pa.array(np.diff(starts)), *map(pa.array, sums)]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "text_key", "n_tokens", "in_known", "in_base", "in_score"])

    kind = documents.schema["doc_id"].dataType.simpleString()
    scored = docs.select("doc_id", "text_key", "text").mapInArrow(
        with_vectors, f"doc_id {kind}, text_key long, n_tokens long, in_known long, in_base double, in_score double"
    )

    # The words without vectors: no word that fills a large part of the corpus is among them.
    spark = documents.sparkSession
    ours = spark.createDataFrame([(r["word"],) for r in top] + [(END_TOKEN,)], "word binary")  # MOST_WORDS at most
    others = words.join(F.broadcast(ours), "word", "left_anti").join(counts, "word", "left")
    c = F.coalesce("c", F.lit(0))
    log10 = lambda n, v: F.log10((c + F.lit(SMOOTHING)) / F.lit(float(n + SMOOTHING * (v + 1))))
    others = others.select(
        "block", log10(total["n"], total["v"]).alias("b"), log10(n_rest, v_rest).alias("s"), (c > 0).cast("long").alias("k"), F.explode(F.arrays_zip("docs", "counts")).alias("x")
    )
    count = F.col("x.counts")
    others = others.groupBy("block", F.col("x.docs").alias("number")).agg(
        F.sum(count * F.col("k")).alias("known"), F.sum(count * F.col("b")).alias("base"), F.sum(count * F.col("s")).alias("more")
    )
    by_doc = (
        blocks.filter("word is null")
        .select("block", "number", "doc_id", "text_key")
        .join(others, ["block", "number"])
        .dropDuplicates(["doc_id", "text_key"])
        .select(F.col("doc_id").alias("__d"), F.col("text_key").alias("__k"), "known", "base", "more")
    )
    out = scored.join(by_doc, F.col("doc_id").eqNullSafe(F.col("__d")) & (F.col("text_key") == F.col("__k")), "left")
    plus = lambda a, b: (F.col(a) + F.coalesce(b, F.lit(0)))
    return out.select(
        "doc_id",
        "text_key",
        "n_tokens",
        plus("in_known", "known").alias("n_known"),
        F.lit(total["n"]).cast("long").alias("train_tokens"),
        plus("in_base", "base").alias("base_score"),
        plus("in_score", "more").alias("score"),
    )


def op6_lm_scoring(spark, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = bucket_of(F.col("doc_id"), 10) == 0
    found = score_texts(documents, ~held_out)
    return found.select("doc_id", held_out.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")
