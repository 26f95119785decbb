"""Toxicity: a bidirectional gated recurrent network with attention pooling, in numpy.

A word enters as the sum of what two tables give: one entry for the word's hash, and the mean of
the entries of its character trigrams. A word of more than PIECE characters (text without white
space, or joined by other marks) enters as overlapping pieces, each like a word. Texts are cut into
overlapping windows; the score of a text is that of its most toxic window. Training sees documents,
not windows: in each round it takes, per document, the window that the present model (at first,
word log-odds) finds most toxic, and a random one if the document is clean.

The network is fitted on the driver on at most SAMPLE labelled documents, those of least hash, in
a fixed order, so reruns agree. Scoring runs over every whole text in tasks that hold the model
(some hundred KB) and batches of windows.

Null and empty texts get the score of an empty window. Null labels are left out; a document with
both labels counts as toxic. Without any labels all scores are the initial ones.
"""

import math
import pickle
from itertools import chain, islice

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.llm.arrow import over_texts

#: Labelled documents, whole, that the network is fitted on at most.
SAMPLE = 2500
WINDOW, STEP = 48, 24
WORDS, TRIGRAMS, HIDDEN = 1 << 14, 1 << 12, 8
ROUNDS, BATCH, RATE, DECAY = 5, 64, 0.015, 4e-4
#: Windows computed at a time; words, and trigrams, a worker remembers; words of several texts that are looked up together, about.
WIDTH, REMEMBERED, LOOKED_UP = 512, 150_000, 30_000
#: Characters of the longest word that is taken as one, and between the starts of the pieces of longer ones.
PIECE, PIECE_STEP = 40, 20
_find = regex.compile(r"[^\x20\x09-\x0D]+").findall


def bare_of(word: str) -> str:
    return word.lower().strip(".,;:!?\"'()[]") or word


def steps_of(text) -> list:
    """The words of a text, longer ones as overlapping pieces that together have all their characters."""
    words = _find(text) if text else []
    if max(map(len, words), default=0) <= PIECE:
        return words
    found = []
    for word in words:
        bare = bare_of(word) if len(word) > PIECE else ""
        if len(bare) <= PIECE:
            found.append(word)
        else:
            found.extend(bare[at : at + PIECE] for at in range(0, len(bare) - PIECE_STEP, PIECE_STEP))
    return found


def bytes_of(text) -> list:
    """The same as UTF-8: bytes split at just the marks at which words end, and only words not yet known are decoded."""
    words = text.encode("utf-8", "surrogatepass").split() if text else []
    if max(map(len, words), default=0) <= PIECE:
        return words
    return [step.encode("utf-8", "surrogatepass") for step in steps_of(text)]


class Grams(dict):
    """Entries of trigrams, remembered in bounded memory; words have far fewer trigrams than there are words."""

    def __missing__(self, gram):
        if len(self) >= REMEMBERED:
            self.clear()
        self[gram] = entry = xxhash.xxh32_intdigest(gram.encode("utf-8", "surrogatepass")) % TRIGRAMS
        return entry


_grams = Grams()


def joined_grams(bares: list):
    """Entries of the trigrams of words, one array after the other, and how many each word has; see features.

    All trigrams are numbers made of their three code points, and each is hashed once.
    """
    points = np.frombuffer("".join([f"<{bare}>" for bare in bares]).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    sizes = np.fromiter(map(len, bares), np.int64, len(bares))
    ends = np.cumsum(sizes + 2)
    first = np.ones(len(points), bool)  # not the last two characters of a marked word
    first[ends - 1] = first[ends - 2] = False
    at = np.flatnonzero(first)
    keys, place = np.unique((points[at] << 42) | (points[at + 1] << 21) | points[at + 2], return_inverse=True)
    low = (1 << 21) - 1
    known = [_grams[chr(key >> 42) + chr(key >> 21 & low) + chr(key & low)] for key in keys.tolist()]
    return np.array(known, np.int64)[place], sizes


def features(word: str):
    """The word's entry and those of its trigrams; case and marks at its ends do not matter."""
    bare = bare_of(word)
    marked = f"<{bare}>"
    grams = [_grams[marked[i : i + 3]] for i in range(len(marked) - 2)]
    return xxhash.xxh32_intdigest(bare.encode(), 7) % WORDS, grams or [0]


def windows_of(n: int) -> list:
    """Start and end of the overlapping windows of n words; one empty window for none."""
    return [(at, min(n, at + WINDOW)) for at in range(0, max(1, n - STEP), STEP)]


def sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class Network:
    def __init__(self, seed=11):
        draw = np.random.default_rng(seed)

        def normal(*shape):
            return (draw.standard_normal(shape) * 0.1).astype(np.float32)

        gates = 6 * HIDDEN  # update, reset and candidate gates of both directions
        self.p = {
            "word": normal(WORDS, gates), "gram": normal(TRIGRAMS, gates), "bias": np.zeros(gates, np.float32),
            "u0": normal(HIDDEN, 3 * HIDDEN), "u1": normal(HIDDEN, 3 * HIDDEN),
            "att": normal(2 * HIDDEN, HIDDEN), "v": normal(HIDDEN) * 5,
            "out": normal(2 * HIDDEN) * 5, "b": np.full(1, -1.0, np.float32),
        }

    def inputs(self, found):
        """Gate inputs of words, from their features."""
        rows = np.empty((len(found), 6 * HIDDEN), np.float32)
        for at in range(0, len(found), 2048):
            part = found[at : at + 2048]
            sizes = np.array([len(grams) for _, grams in part])
            flat = np.fromiter(chain.from_iterable(grams for _, grams in part), np.int64, sizes.sum())
            total = np.add.reduceat(self.p["gram"][flat], np.cumsum(sizes) - sizes, axis=0)
            rows[at : at + 2048] = self.p["word"][[word for word, _ in part]] + total / sizes[:, None]
        return rows + self.p["bias"]

    def inputs_of_words(self, words):
        """As inputs, from the words."""
        rows = np.empty((len(words), 6 * HIDDEN), np.float32)
        for at in range(0, len(words), 2048):
            bares = sorted([(bare_of(word), n) for n, word in enumerate(words[at : at + 2048])], key=lambda b: -len(b[0]))
            order = np.array([n for _, n in bares])
            bares = [bare for bare, _ in bares]
            flat, sizes = joined_grams(bares)
            starts = np.cumsum(sizes) - sizes
            # added up as in inputs, to the last bit: the first to the sum of the others
            total, rest = self.p["gram"][flat[starts]], np.zeros((len(bares), 6 * HIDDEN), np.float32)
            long = np.searchsorted(-sizes, -8)  # the words of more trigrams come first
            for k in range(1, 8):
                more = max(long, np.searchsorted(-sizes, -k))
                rest[long:more] += self.p["gram"][flat[starts[long:more] + k]]
            total += rest
            if long:
                total[:long] = np.add.reduceat(self.p["gram"][flat[: starts[long - 1] + sizes[long - 1]]], starts[:long], axis=0)
            hashed = [xxhash.xxh32_intdigest(bare.encode("utf-8", "surrogatepass"), 7) % WORDS for bare in bares]
            rows[at + order] = self.p["word"][hashed] + total / sizes[:, None]
        return rows + self.p["bias"]

    def logits(self, rows, pieces):
        """Logits of windows, given as arrays of places in rows, in ascending order of their lengths; see forward.

        Steps come first in all arrays, so that a step is one piece of memory, and shorter windows are left out of it.
        """
        sizes, n = np.array([len(piece) for piece in pieces]), len(pieces)
        steps = max(1, sizes[-1])
        mask = np.arange(steps)[:, None] < sizes
        ids = np.zeros((n, steps), np.int64)
        ids[mask.T] = np.concatenate(pieces)
        x = rows[ids.T]
        short = np.searchsorted(sizes, np.arange(steps), "right")
        states = np.zeros((steps, n, 2 * HIDDEN), np.float32)
        for way in (0, 1):
            u, state = self.p[f"u{way}"], np.zeros((n, HIDDEN), np.float32)
            mine = x[:, :, way * 3 * HIDDEN : (way + 1) * 3 * HIDDEN]
            for t in range(steps) if way == 0 else range(steps - 1, -1, -1):
                h, given = state[short[t] :], mine[t, short[t] :]
                s = (state @ u)[short[t] :]  # of all, so that sums are rounded as in forward
                g = sigmoid(given[:, : 2 * HIDDEN] + s[:, : 2 * HIDDEN])
                c = np.tanh(given[:, 2 * HIDDEN :] + g[:, HIDDEN:] * s[:, 2 * HIDDEN :])
                h += (1 - g[:, :HIDDEN]) * (c - h)
                states[t, :, way * HIDDEN : (way + 1) * HIDDEN] = state
        return self.pooled(np.ascontiguousarray(states.transpose(1, 0, 2)), mask.T)[0]

    def pooled(self, states, mask):
        """Logits from the states, and what the slopes need: hidden, alpha, pooled."""
        hidden = np.tanh(states @ self.p["att"])
        e = hidden @ self.p["v"]
        e = np.where(mask > 0, np.exp(e - e.max(axis=1, keepdims=True)), 0)
        alpha = e / np.maximum(e.sum(axis=1, keepdims=True), 1e-9)
        pooled = np.einsum("nt,nth->nh", alpha, states)
        return pooled @ self.p["out"] + self.p["b"][0], hidden, alpha, pooled

    def forward(self, x, mask, keep=False):
        """Logits of windows; x: window, step, gates."""
        n, steps, _ = x.shape
        states = np.zeros((n, steps, 2 * HIDDEN), np.float32)
        tape = []
        for way in (0, 1):
            u, h = self.p[f"u{way}"], np.zeros((n, HIDDEN), np.float32)
            mine = x[:, :, way * 3 * HIDDEN : (way + 1) * 3 * HIDDEN]
            for t in range(steps) if way == 0 else range(steps - 1, -1, -1):
                s = h @ u
                g = sigmoid(mine[:, t, : 2 * HIDDEN] + s[:, : 2 * HIDDEN])
                z, r = g[:, :HIDDEN], g[:, HIDDEN:]
                c = np.tanh(mine[:, t, 2 * HIDDEN :] + r * s[:, 2 * HIDDEN :])
                m = mask[:, t : t + 1]
                new = h + m * (1 - z) * (c - h)
                if keep:
                    tape.append((way, t, h, s[:, 2 * HIDDEN :], z, r, c, m))
                h = new
                states[:, t, way * HIDDEN : (way + 1) * HIDDEN] = h
        logit, hidden, alpha, pooled = self.pooled(states, mask)
        return (logit, states, hidden, alpha, pooled, tape) if keep else logit

    def gradients(self, x, mask, error, kept):
        """Gradients for the recurrent part and of the gate inputs; error is the slope of the loss by logit."""
        _, states, hidden, alpha, pooled, tape = kept
        p, g = self.p, {}
        g["out"], g["b"] = pooled.T @ error, np.array([error.sum()], np.float32)
        d_pooled = error[:, None] * p["out"]
        d_states = alpha[:, :, None] * d_pooled[:, None, :]
        d_alpha = np.einsum("nth,nh->nt", states, d_pooled)
        d_e = alpha * (d_alpha - (alpha * d_alpha).sum(axis=1, keepdims=True))
        g["v"] = np.einsum("nth,nt->h", hidden, d_e)
        d_hidden = d_e[:, :, None] * p["v"] * (1 - hidden**2)
        g["att"] = np.einsum("nta,ntb->ab", states, d_hidden)
        d_states += d_hidden @ p["att"].T
        d_x = np.zeros_like(x)
        for way in (1, 0):
            u, carry, slope = p[f"u{way}"], 0.0, np.zeros_like(p[f"u{way}"])
            for w, t, h, s, z, r, c, m in reversed(tape):
                if w != way:
                    continue
                d = d_states[:, t, way * HIDDEN : (way + 1) * HIDDEN] + carry
                d_new = d * m
                d_c = d_new * (1 - z) * (1 - c**2)
                d_z = d_new * (h - c) * z * (1 - z)
                d_r = d_c * s * r * (1 - r)
                d_gates = np.concatenate([d_z, d_r, d_c * r], axis=1)
                slope += h.T @ d_gates
                carry = d * (1 - m) + d_new * z + d_gates @ u.T
                d_x[:, t, way * 3 * HIDDEN : (way + 1) * 3 * HIDDEN] = np.concatenate([d_z, d_r, d_c], axis=1)
            g[f"u{way}"] = slope
        return g, d_x


class Numbered(dict):
    """Numbers for words, in the order in which they are first asked for."""

    def __missing__(self, word):
        self[word] = number = len(self)
        return number


class Scorer:
    """Scores of texts; gate inputs of words are remembered."""

    def __init__(self, network):
        self.network, self.known, self.rows = network, Numbered(), np.zeros((1024, 6 * HIDDEN), np.float32)

    def ids(self, words):
        """Places of words, as bytes, in the rows."""
        at = len(self.known)
        found = np.fromiter(map(self.known.__getitem__, words), np.int64, len(words))
        new = list(islice(reversed(self.known), len(self.known) - at))[::-1]
        if new:
            if len(self.known) > len(self.rows):
                grown = np.zeros((2 * len(self.known), 6 * HIDDEN), np.float32)
                grown[:at] = self.rows[:at]
                self.rows = grown
            self.rows[at : len(self.known)] = self.network.inputs_of_words([w.decode("utf-8", "surrogatepass") for w in new])
        return found

    def window_logits(self, pieces):
        """Logits of windows, given as arrays of word ids, in batches of like length."""
        order = sorted(range(len(pieces)), key=lambda i: len(pieces[i]))
        logits = np.empty(len(pieces), np.float32)
        for at in range(0, len(order), WIDTH):
            part = order[at : at + WIDTH]
            logits[part] = self.network.logits(self.rows, [pieces[i] for i in part])
        return logits

    def scores(self, texts):
        if len(self.known) > REMEMBERED:
            self.known = Numbered()
        pieces, owner, out = [], [], np.full(len(texts), -np.inf, np.float32)

        def flush():
            if pieces:
                np.maximum.at(out, owner, self.window_logits(pieces))
                pieces.clear()
                owner.clear()

        waiting, n_words = [], 0
        for n, text in enumerate(texts):
            waiting.append((n, bytes_of(text)))
            n_words += len(waiting[-1][1])
            if n_words < LOOKED_UP and n + 1 < len(texts):
                continue
            every, at = self.ids(list(chain.from_iterable(words for _, words in waiting))), 0
            for k, words in waiting:
                ids, at = every[at : at + len(words)], at + len(words)
                for a, b in windows_of(len(ids)):
                    pieces.append(ids[a:b])
                    owner.append(k)
                    if len(pieces) >= 8 * WIDTH:
                        flush()
            waiting, n_words = [], 0
        flush()
        return [float(s) for s in sigmoid(out.astype(np.float64))]


def padded(pieces):
    longest = max(1, max(map(len, pieces)))
    ids = np.zeros((len(pieces), longest), np.int64)
    mask = np.zeros((len(pieces), longest), np.float32)
    for i, piece in enumerate(pieces):
        ids[i, : len(piece)] = piece
        mask[i, : len(piece)] = 1
    return ids, mask


def train(texts, toxic, rounds=ROUNDS, seed=5) -> Network:
    """Fit a network on documents with labels (0 or 1)."""
    network, draw = Network(), np.random.default_rng(seed)
    if not texts:
        return network
    toxic = np.asarray(toxic, np.float32)
    vocabulary, docs = {}, []
    for text in texts:
        docs.append(np.array([vocabulary.setdefault(w, len(vocabulary)) for w in steps_of(text)], np.int64))
    found = [features(w) for w in vocabulary] or [(0, [0])]
    word_of = np.array([f[0] for f in found])
    gram_row = np.concatenate([np.full(len(f[1]), i) for i, f in enumerate(found)])
    gram_of, gram_share = np.concatenate([f[1] for f in found]), np.concatenate([np.full(len(f[1]), 1 / len(f[1])) for f in found])
    starts = np.searchsorted(gram_row, np.arange(len(found) + 1))
    # log-odds of words, by documents, choose the first windows
    seen = np.zeros((2, WORDS))
    for ids, label in zip(docs, toxic):
        seen[int(label)][np.unique(word_of[ids])] += 1
    totals = [(toxic == k).sum() + 1 for k in (0, 1)]
    odds = np.log((seen[1] + 0.5) / totals[1]) - np.log((seen[0] + 0.5) / totals[0])
    odds = np.where(seen.sum(axis=0) >= 3, odds, 0)[word_of]
    moments = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in network.p.items()}
    step = 0
    for turn in range(rounds):
        pieces, owner = [], []
        if turn:
            rows = network.inputs(found)
            every = [(n, a, b) for n, ids in enumerate(docs) for a, b in windows_of(len(ids))]
            every_piece = [docs[n][a:b] for n, a, b in every]
            order = sorted(range(len(every)), key=lambda i: len(every_piece[i]))
            logits = np.empty(len(every), np.float32)
            for at in range(0, len(order), WIDTH):
                part = order[at : at + WIDTH]
                ids, mask = padded([every_piece[i] for i in part])
                logits[part] = network.forward(rows[ids], mask)
            best = {}
            for (n, a, b), value in zip(every, logits):
                if n not in best or value > best[n][0]:
                    best[n] = (value, a, b)
        for n, ids in enumerate(docs):
            spans = windows_of(len(ids))
            if turn:
                _, a, b = best[n]
            else:
                a, b = max(spans, key=lambda s: np.maximum(odds[ids[s[0] : s[1]]], 0).sum())
            pieces.append(ids[a:b])
            owner.append(n)
            if not toxic[n] and len(spans) > 1:
                a, b = spans[draw.integers(len(spans))]
                pieces.append(ids[a:b])
                owner.append(n)
        order = draw.permutation(len(pieces))
        for at in range(0, len(order), BATCH):
            part = order[at : at + BATCH]
            ids, mask = padded([pieces[i] for i in part])
            owners = [owner[i] for i in part]
            used, place = np.unique(ids, return_inverse=True)
            x = network.inputs([found[i] for i in used])[place.reshape(ids.shape)]
            kept = network.forward(x, mask, keep=True)
            error = ((sigmoid(kept[0]) - toxic[owners]) / len(part)).astype(np.float32)
            slopes, d_x = network.gradients(x, mask, error, kept)
            d_used = np.zeros((len(used), 6 * HIDDEN), np.float32)
            np.add.at(d_used, place.ravel(), (d_x * mask[:, :, None]).reshape(-1, 6 * HIDDEN))
            slopes["bias"] = d_used.sum(axis=0)
            step += 1
            rows, inverse = np.unique(word_of[used], return_inverse=True)
            grown = np.zeros((len(rows), 6 * HIDDEN), np.float32)
            np.add.at(grown, inverse, d_used)
            adam(network, moments, "word", grown, step, rows)
            spans = [np.arange(starts[i], starts[i + 1]) for i in used]
            flat = np.concatenate(spans)
            back = np.repeat(np.arange(len(used)), [len(s) for s in spans])
            rows, inverse = np.unique(gram_of[flat], return_inverse=True)
            grown = np.zeros((len(rows), 6 * HIDDEN), np.float32)
            np.add.at(grown, inverse, d_used[back] * gram_share[flat][:, None].astype(np.float32))
            adam(network, moments, "gram", grown, step, rows)
            for name, slope in slopes.items():
                adam(network, moments, name, slope, step)
    return network


def adam(network, moments, name, slope, step, rows=slice(None), rate=RATE):
    first, second = moments[name]
    values = network.p[name]
    slope = slope + DECAY * values[rows] * (name in ("word", "gram"))
    first[rows] = 0.9 * first[rows] + 0.1 * slope
    second[rows] = 0.99 * second[rows] + 0.01 * slope**2
    size = math.sqrt(1 - 0.99**step) / (1 - 0.9**step)
    values[rows] -= rate * size * first[rows] / (np.sqrt(second[rows]) + 1e-6)


def held_out(doc_id: Column) -> Column:
    """Whether labels of this document are never learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def sampled(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """doc_id, text, _toxic of at most `sample` labelled documents, chosen and ordered by hash and id."""
    known = labels.where("toxic IS NOT NULL").groupBy("doc_id").agg(F.max("toxic").alias("_toxic"))
    known = known.where(~held_out(F.col("doc_id"))).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    texts = docs.select("doc_id", "text")
    return texts.join(F.broadcast(known), "doc_id").distinct().orderBy("doc_id", "text").limit(sample)


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Network:
    rows = sampled(docs, labels, sample).collect()
    return train([r["text"] for r in rows], [r["_toxic"] for r in rows])


def fit_in_task(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Network:
    """As fit, with the sample in a task: only the fitted network reaches the driver."""

    def learn(batches):
        rows = [row for batch in batches for row in batch.to_pylist()]
        network = train([r["text"] for r in rows], [r["_toxic"] for r in rows])
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(network)], pa.binary())], names=["network"])

    chosen = sampled(docs, labels, sample).select("text", "_toxic").coalesce(1)
    fitted = chosen.mapInArrow(learn, "network binary").first()
    return pickle.loads(fitted.network) if fitted else train([], [])


def scorer(spark, network: Network):
    """A function from a text column to its score."""
    shared = spark.sparkContext.broadcast(network)

    def prepare():
        return Scorer(shared.value).scores

    return over_texts("double", pa.float64(), prepare)
