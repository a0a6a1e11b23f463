"""Operator 3: toxicity by a bidirectional gated recurrent network.

A text is cut into words; every overlapping window of ``WINDOW`` words (a new
one each ``STRIDE``) is read by a GRU in both directions, attention pools its
states, and one output gives the window's logit. A text's score is that of its
most toxic window. A word enters by characters and as a whole: learned
embeddings of its bytes (mean) and of its hash, and what the training texts say
about its character n-grams and about the word itself (log-odds of the label).

Training is in numpy on the driver, on a bounded sample of the labelled texts
(``SAMPLE`` of each kind at most, the smallest hashes, of at most ``SAMPLE_CHARS``
characters each). Each text weighs as many labelled texts of its kind, of any
length, as it stands for, so the share of toxic texts that the network learns is
that of all labels at every size. A text's label stands for its most suspicious
window, which is chosen anew by the network between epochs. Scoring runs in the tasks and
takes whole texts; the model that is sent there has a fixed size.

Cases: null and empty texts and texts without words have one empty window and
get the bias's score. Repeated rows give a row each; a null id is scored and
never held out. Without labels of both kinds every text scores the share of
toxic labels (0 without any). An empty table gives an empty result; other
columns are ignored; labels, languages, sources and ids are no inputs.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewright.llm.pretokens import CHUNK_CHARS, _powers
from tablewright.llm.shared import prepare, written
from tablewright.llm.shingles import mix

WINDOW, STRIDE = 64, 32
HIDDEN, WORD_DIM, BYTE_DIM, EVIDENCE = 8, 4, 3, 4
BUCKETS, WORD_ROWS = 2**17, 2**14
NGRAMS = (3, 4, 5)
SAMPLE, SAMPLE_CHARS = 1_500, 20_000
#: Passes over the training texts: as many as make ``STEPS`` batches, ``EPOCHS`` at least.
EPOCHS, STEPS, BATCH, RATE = 6, 210, 128, 0.02
#: Pseudo-documents behind each log-odds, and its greatest size.
SMOOTHING, MOST = 5.0, 3.0
#: Texts that a word or n-gram must be in to say anything.
SUPPORT = 4
PART_CHARS, OVERLAP_CHARS = 1_000_000, 1_000
#: Bytes whose words are hashed at a time.
HASH_BYTES = 2**20
_ODD = 0xC2B2AE3D27D4EB4F


@lru_cache(maxsize=1)
def _tables():
    lower = np.arange(256, dtype=np.uint8)
    lower[65:91] += 32
    word = np.zeros(256, bool)
    word[48:58] = word[65:91] = word[97:123] = word[128:] = True
    factor = np.random.default_rng(41).integers(1, 2**63, 256, dtype=np.uint64)
    return lower, word, factor, _powers(_ODD, HASH_BYTES), _powers(pow(_ODD, -1, 2**64), HASH_BYTES)


def _hashes(data: np.ndarray, begin: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """A hash of the bytes of each word, the same wherever the word stands."""
    _, _, factor, up, down = _tables()
    key, first = np.empty(len(begin), np.uint64), 0
    while first < len(begin):
        low = begin[first]
        last = max(first + 1, int(np.searchsorted(stop, low + HASH_BYTES, "right")))
        n = int(stop[last - 1] - low)
        if n > len(up):                                # one word of more bytes
            up, down = _powers(_ODD, n), _powers(pow(_ODD, -1, 2**64), n)
        total = np.zeros(n + 1, np.uint64)
        np.multiply(factor[data[low:low + n]], up[:n], out=total[1:])
        np.cumsum(total, out=total)
        at = begin[first:last] - low
        key[first:last] = mix((total[stop[first:last] - low] - total[at]) * down[at])
        first = last
    return key


def parts(text: str) -> Iterator[str]:
    """The whole text, or overlapping parts of a very long one."""
    start = 0
    while len(text) - start > PART_CHARS:
        yield text[start:start + PART_CHARS]
        start += PART_CHARS - OVERLAP_CHARS
    yield text[start:]


class WordTable:
    """The words of some texts: ``codes`` from 1 on (0 stands for no word),
    ``edges`` of the texts, and for each distinct word its hash bucket, its
    bytes and the buckets of its n-grams."""

    def __init__(self, texts: list[str]):
        lower, is_word, *_ = _tables()
        raw = [t.encode("utf-8") for t in texts]
        data = lower[np.frombuffer(b" ".join([b"", *raw, b""]), np.uint8)]
        ends = np.cumsum(np.fromiter((len(r) + 1 for r in raw), np.int64, len(raw)))
        inside = is_word[data]
        edge = np.flatnonzero(inside[1:] != inside[:-1]) + 1
        begin, stop = edge[::2], edge[1::2]
        codes, unique = pd.factorize(_hashes(data, begin, stop))
        first = np.zeros(len(unique), np.int64)
        first[codes[::-1]] = np.arange(len(codes) - 1, -1, -1)
        self.codes = (codes + 1).astype(np.int32)
        self.edges = np.concatenate([[0], np.searchsorted(begin, ends)])
        self.bucket = (unique % np.uint64(BUCKETS)).astype(np.int64)
        size = stop[first] - begin[first]
        self.at = np.cumsum(size + 2) - size - 2
        self.bytes = np.full(int((size + 2).sum()), 36, np.uint8)
        self.size, self.known = size, None
        self.bytes[self.at] = 94
        inner = np.repeat(self.at + 1 - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))
        self.bytes[inner] = data[np.repeat(begin[first] - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))]
        self.owner = np.repeat(np.arange(len(size)), size + 2)

    def ngrams(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """For each length: the bucket at every place, and whether an n-gram starts there."""
        _, _, factor, up, _ = _tables()
        f, n = factor[self.bytes], len(self.bytes)
        left = np.repeat(self.size + 2, self.size + 2) - (np.arange(n) - self.at[self.owner])
        total = np.zeros(n, np.uint64)
        for k in range(max(NGRAMS)):
            total[:n - k] += f[k:] * up[k + 1]
            if k + 1 in NGRAMS:
                yield (mix(total + np.uint64(k)) % np.uint64(BUCKETS)).astype(np.int64), left >= k + 1

    def windows(self) -> tuple[np.ndarray, np.ndarray]:
        """(windows x WINDOW) word codes and the text of each window."""
        codes = np.concatenate([self.codes, np.zeros(WINDOW, np.int32)])
        many = np.diff(self.edges)
        each = np.maximum(1, -(-(many - WINDOW) // STRIDE) + 1)
        text = np.repeat(np.arange(len(many)), each)
        start = (np.arange(len(text)) - np.repeat(np.cumsum(each) - each, each)) * STRIDE
        place = start[:, None] + np.arange(WINDOW)
        out = codes[np.minimum(self.edges[text][:, None] + place, len(codes) - 1)]
        out[place >= many[text][:, None]] = 0
        return out, text


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (np.tanh(0.5 * x) + 1)


class Network:
    """Two GRUs, attention, one output. ``w`` holds all trained arrays."""

    def __init__(self, word_odds: np.ndarray, ngram_odds: np.ndarray, seed: int = 3):
        self.word_odds, self.ngram_odds = word_odds, ngram_odds
        rng, h = np.random.default_rng(seed), HIDDEN
        inputs = EVIDENCE + WORD_DIM + BYTE_DIM
        normal = lambda *s, scale=0.3: (scale * rng.standard_normal(s)).astype(np.float32)
        self.w = {"words": normal(WORD_ROWS, WORD_DIM, scale=0.05), "bytes": normal(256, BYTE_DIM, scale=0.1),
                  "v": normal(2 * h), "u": normal(2 * h), "b": np.zeros(1, np.float32)}
        for d in "fb":
            self.w |= {f"x{d}": normal(inputs, 3 * h), f"c{d}": np.zeros(3 * h, np.float32), f"h{d}": normal(h, 3 * h)}

    def evidence(self, t: WordTable) -> np.ndarray:
        """What the training texts say about each distinct word and its n-grams."""
        high = np.full(len(t.size), -MOST, np.float32)
        low, total, n = -high, np.zeros(len(t.size), np.float32), np.zeros(len(t.size), np.float32)
        for bucket, valid in t.ngrams() if len(t.size) else ():
            odds = self.ngram_odds[bucket]
            high = np.maximum(high, np.maximum.reduceat(np.where(valid, odds, np.float32(-MOST)), t.at))
            low = np.minimum(low, np.minimum.reduceat(np.where(valid, odds, np.float32(MOST)), t.at))
            total += np.add.reduceat(np.where(valid, odds, np.float32(0)), t.at)
            n += np.add.reduceat(valid, t.at, dtype=np.float32)
        return np.stack([self.word_odds[t.bucket], high, low, total / np.maximum(n, 1)], axis=1).astype(np.float32)

    def inputs(self, t: WordTable, which: np.ndarray) -> np.ndarray:
        """A row of inputs for each of the distinct words ``which``."""
        if t.known is None:
            t.known = self.evidence(t)
        size = t.size[which] + 2
        at = np.cumsum(size) - size
        place = np.repeat(t.at[which] - at, size) + np.arange(int(size.sum()))
        chars = np.stack([np.add.reduceat(c[t.bytes[place]], at) if len(at) else at for c in self.w["bytes"].T], axis=1)
        return np.concatenate([t.known[which], self.w["words"][t.bucket[which] % WORD_ROWS],
                               (chars / size[:, None]).astype(np.float32)], axis=1)

    def all_inputs(self, t: WordTable) -> np.ndarray:
        return self.inputs(t, np.arange(len(t.size)))

    def projected(self, x: np.ndarray) -> dict[str, np.ndarray]:
        """What each word adds to the gates; row 0 (no word) keeps the state."""
        out = {}
        for d in "fb":
            p = np.zeros((len(x) + 1, 3 * HIDDEN), np.float32)
            p[0, :HIDDEN] = 30
            p[1:] = x @ self.w[f"x{d}"] + self.w[f"c{d}"]
            out[d] = p
        return out

    def forward(self, codes: np.ndarray, p: dict[str, np.ndarray], keep: bool = False):
        h, (n, steps) = HIDDEN, codes.shape
        states = np.empty((steps, n, 2 * h), np.float32)
        tape: dict[str, list] = {"f": [], "b": []}
        for k, d in enumerate("fb"):
            state, recurrent = np.zeros((n, h), np.float32), self.w[f"h{d}"]
            for t in range(steps) if d == "f" else range(steps - 1, -1, -1):
                a, g = p[d][codes[:, t]], state @ recurrent
                zr = _sigmoid(a[:, :2 * h] + g[:, :2 * h])
                z, r, gn = zr[:, :h], zr[:, h:], g[:, 2 * h:]
                new = np.tanh(a[:, 2 * h:] + r * gn)
                if keep:
                    tape[d].append((t, state, z, r, new, gn))
                state = new + z * (state - new)
                states[t, :, k * h:(k + 1) * h] = state
        e = np.where(codes.T > 0, states @ self.w["v"], np.float32(-1e9))
        e -= e.max(axis=0)
        weight = np.exp(e)
        weight /= weight.sum(axis=0)
        pooled = np.einsum("tn,tnh->nh", weight, states)
        logit = pooled @ self.w["u"] + self.w["b"][0]
        return (logit, states, weight, pooled, tape) if keep else logit

    def logits(self, codes: np.ndarray, p: dict[str, np.ndarray], size: int = 2_048) -> np.ndarray:
        return np.concatenate([self.forward(codes[k:k + size], p) for k in range(0, len(codes), size)])

    def gradients(self, codes: np.ndarray, y: np.ndarray, t: WordTable, weight_of: np.ndarray | float = 1.0) -> dict[str, np.ndarray]:
        h, w = HIDDEN, self.w
        own, codes = np.unique(np.append(codes.ravel(), 0), return_inverse=True)   # the batch's own words, 0 first
        codes, own = codes[:-1].reshape(len(y), -1), own[1:] - 1
        x = self.inputs(t, own)
        p = self.projected(x)
        logit, states, weight, pooled, tape = self.forward(codes, p, keep=True)
        d_logit = ((_sigmoid(logit) - y) * weight_of / len(y)).astype(np.float32)
        g = {"u": pooled.T @ d_logit, "b": np.array([d_logit.sum()])}
        d_pooled = d_logit[:, None] * w["u"]
        d_weight = np.einsum("tnh,nh->tn", states, d_pooled)
        d_e = weight * (d_weight - (weight * d_weight).sum(axis=0)) * (codes.T > 0)
        g["v"] = np.einsum("tn,tnh->h", d_e, states)
        d_states = weight[:, :, None] * d_pooled + d_e[:, :, None] * w["v"]
        d_x = np.zeros((len(x) + 1, x.shape[1]), np.float32)
        for k, d in enumerate("fb"):
            d_h, d_u, d_p = np.zeros((len(y), h), np.float32), np.zeros_like(w[f"h{d}"]), np.zeros_like(p[d])
            for step, before, z, r, new, gn in reversed(tape[d]):
                d_h = d_h + d_states[step, :, k * h:(k + 1) * h]
                a_n = d_h * (1 - z) * (1 - new * new)
                a_z, a_r = d_h * (before - new) * z * (1 - z), a_n * gn * r * (1 - r)
                d_g = np.concatenate([a_z, a_r, a_n * r], axis=1)
                np.add.at(d_p, codes[:, step], np.concatenate([a_z, a_r, a_n], axis=1))
                d_u += before.T @ d_g
                d_h = d_h * z + d_g @ w[f"h{d}"].T
            d_p[0] = 0
            g |= {f"h{d}": d_u, f"x{d}": x.T @ d_p[1:], f"c{d}": d_p[1:].sum(axis=0)}
            d_x += d_p @ w[f"x{d}"].T
        d_x = d_x[1:]
        g["words"], g["bytes"] = np.zeros_like(w["words"]), np.zeros_like(w["bytes"])
        np.add.at(g["words"], t.bucket[own] % WORD_ROWS, d_x[:, EVIDENCE:EVIDENCE + WORD_DIM])
        size = t.size[own] + 2
        place = np.repeat(t.at[own] - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))
        np.add.at(g["bytes"], t.bytes[place], np.repeat(d_x[:, EVIDENCE + WORD_DIM:] / size[:, None], size, axis=0))
        return g

    def scores(self, texts: list[str]) -> np.ndarray:
        """0 to 1 for each whole text."""
        owner, some, out = [], [], np.full(len(texts), -np.inf)

        def flush() -> None:
            t = WordTable(some)
            codes, of = t.windows()
            logits = self.logits(codes, self.projected(self.all_inputs(t)))
            np.maximum.at(out, np.array(owner)[of], logits)
            owner.clear(), some.clear()

        held = 0
        for i, text in enumerate(texts):
            for part in parts(text):
                owner.append(i), some.append(part)
                held += len(part) + 1
                if held > CHUNK_CHARS // 2:
                    flush()
                    held = 0
        if some:
            flush()
        return _sigmoid(out.astype(np.float64))


def _odds(counts: np.ndarray, totals: np.ndarray) -> np.ndarray:
    share = totals / totals.sum()
    seen = counts.sum(axis=0) >= SUPPORT          # else a text's own words would tell its label
    out = np.log((counts[1] + SMOOTHING * share[1]) / (totals[1] + SMOOTHING)) - np.log(
        (counts[0] + SMOOTHING * share[0]) / (totals[0] + SMOOTHING))
    base = np.log(share[1] / (totals[1] + SMOOTHING)) - np.log(share[0] / (totals[0] + SMOOTHING))
    return np.where(seen, np.clip(out - base, -MOST, MOST), 0).astype(np.float32)


def train(texts: list[str], y: np.ndarray, every: dict[int, int] | None = None, seed: int = 3) -> Network:
    """A network for texts with labels 0 and 1, both present. ``every``: how many
    labelled texts of each kind there are, if ``texts`` are a sample of them."""
    t = WordTable(texts)
    grams = [(b[v], t.owner[v]) for b, v in t.ngrams()]
    bucket, owner = np.concatenate([b for b, _ in grams]), np.concatenate([o for _, o in grams])
    del grams                                     # the driver's memory peaks here
    order = np.argsort(owner, kind="stable")
    bucket, many = bucket[order], np.bincount(owner, minlength=len(t.size))
    del order, owner
    begin = np.cumsum(many) - many
    words, ngrams = np.zeros((2, BUCKETS)), np.zeros((2, BUCKETS))
    for k, label in enumerate(y):
        own = np.unique(t.codes[t.edges[k]:t.edges[k + 1]]) - 1
        words[label, np.unique(t.bucket[own])] += 1
        place = np.repeat(begin[own] - (np.cumsum(many[own]) - many[own]), many[own]) + np.arange(int(many[own].sum()))
        ngrams[label, np.unique(bucket[place])] += 1
    del bucket, begin, many, place
    totals = np.bincount(y, minlength=2).astype(float)
    net = Network(_odds(words, totals), _odds(ngrams, totals), seed)
    codes, of = t.windows()
    rng = np.random.default_rng(seed)
    suspicious = np.concatenate([[0], np.maximum(net.all_inputs(t)[:, 1], 0)])[codes].sum(axis=1)
    every = np.array([every[0], every[1]]) if every else totals
    stands_for, any_stands_for = every / totals, every.sum() / len(y)
    moment = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in net.w.items()}
    count = 0
    epochs = max(EPOCHS, -(-STEPS * BATCH // (len(y) + len(y) // 2)))
    for epoch in range(epochs):
        if epoch in (epochs // 3, 2 * epochs // 3):
            suspicious = net.logits(codes, net.projected(net.all_inputs(t)))
        ranked = np.lexsort((-suspicious, of))
        top = ranked[np.concatenate([[True], of[ranked][1:] != of[ranked][:-1]])]
        rows = np.concatenate([top, rng.choice(np.flatnonzero(y[of] == 0), min(len(top) // 2, int((y[of] == 0).sum())), replace=False)])
        weight = np.concatenate([stands_for[y[of[top]]], np.full(len(rows) - len(top), any_stands_for)])
        weight /= weight.mean()
        order = rng.permutation(len(rows))
        rows, weight = rows[order], weight[order]
        for k in range(0, len(rows), BATCH):
            some = rows[k:k + BATCH]
            g = net.gradients(codes[some], y[of[some]].astype(np.float32), t, weight[k:k + BATCH])
            count += 1
            for name, d in g.items():
                m, s = moment[name]
                m += 0.1 * (d - m)
                s += 0.01 * (d * d - s)
                net.w[name] -= (RATE * (m / (1 - 0.9**count)) / (np.sqrt(s / (1 - 0.99**count)) + 1e-6)).astype(np.float32)
    return net


class Constant:
    def __init__(self, score: float):
        self.score = score

    def scores(self, texts: list[str]) -> np.ndarray:
        return np.full(len(texts), self.score)


def held_out(id_col: str):
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def sample(df: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str) -> tuple[list, dict[int, int]]:
    """At most ``SAMPLE`` labelled texts of each label from rows that are not held
    out, those with the smallest hashes, as rows (label, order, text, copies); and how
    many labelled rows of each kind there are, also of longer texts.

    Ids and hashes are joined with the labels first; the chosen texts follow by a
    second scan. About twice the sample's number of hashes reach the driver, by a
    bound on the hash that is doubled until enough lie below it."""
    spark = df.sparkSession
    wanted = labels.where(F.col(label_col).isin(0, 1)).where(~held_out(id_col)).select(
        F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("label")).distinct()
    rows = df.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")).withColumn(
        "order", F.xxhash64("text", F.lit(1))).withColumn("short", F.char_length("text") <= SAMPLE_CHARS)
    found = rows.select("id", "order", "short").join(wanted, "id").groupBy("label", "order", "short").agg(
        F.min("id").alias("id"), F.count("*").alias("copies"))
    found = written(found, "labelled-texts")
    every = {x["label"]: x["n"] for x in found.groupBy("label").agg(F.sum("copies").alias("n")).collect()}
    known = found.where("short").drop("short")
    many = {x["label"]: x["n"] for x in known.groupBy("label").agg(F.sum("copies").alias("n")).collect()}
    chosen = []
    for kind, n in many.items():
        share, found = 2 * SAMPLE / n, []
        while sum(x["copies"] for x in found) < min(n, SAMPLE):
            bound = int(2**63 * (2 * min(share, 1) - 1))
            below = F.lit(True) if share >= 1 else F.col("order") < bound
            found = known.where(F.col("label") == kind).where(below).collect()
            share *= 2
        left = SAMPLE
        for x in sorted(found, key=lambda x: x["order"]):
            if left:
                chosen.append((x["label"], x["order"], x["id"], min(left, x["copies"])))
                left -= chosen[-1][-1]
    if not chosen:
        return [], every
    # 2 * SAMPLE short rows.
    picked = F.broadcast(spark.createDataFrame(chosen, known.schema))
    texts = rows.where("short").join(picked, ["id", "order"]).groupBy("label", "order", "copies").agg(F.first("text").alias("text"))
    return sorted(texts.collect(), key=lambda x: (x["label"], x["order"])), every


def fit(df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic"):
    """A model from the labelled texts that are not held out."""
    chosen, every = sample(df, labels, id_col, text_col, label_col)
    some = [x for x in chosen for _ in range(x["copies"])]
    y = np.array([x["label"] for x in some], np.int64)
    if len(set(y.tolist())) < 2:
        return Constant(every.get(1, 0) / max(1, sum(every.values())))
    return train([x["text"] for x in some], y, every)


def score(df: DataFrame, model, id_col: str = "doc_id", text_col: str = "text", carry: tuple[str, ...] = ()) -> DataFrame:
    """id, the columns ``carry``, held_out, score, predicted for every row."""
    spark = df.sparkSession
    prepare(spark)
    names = [id_col, *carry]
    schema = T.StructType([*[df.schema[c] for c in names], T.StructField("score", T.DoubleType())])
    sent = spark.sparkContext.broadcast(model)       # of fixed size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = sent.value.scores([x or "" for x in batch.column(batch.num_columns - 1).to_pylist()])
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(found, pa.float64())], names=[*names, "score"])

    rows = df.select(*names, F.col(text_col).alias("_text")).mapInArrow(run, schema)
    return rows.select(id_col, *carry, held_out(id_col).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
