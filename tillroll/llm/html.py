"""Main text of pages: a bidirectional LSTM in numpy labels every block of a page.

A page becomes the sequence of its blocks, the texts between block-level marks, in page order.
Each block enters as hashed vectors of the tags, classes and ids on its path and of its words; the
network reads the whole sequence in both directions, so each label sees the whole page. Blocks
labelled as main text, joined by a space, are the result.

There are no labelled pages, so the network is fitted on SAMPLE pages (those of least hash) whose
blocks are labelled by their path (parts of a page that are never main text, and the article if
there is one), with blocks of such parts put in at random places. Reruns agree.

Null, empty and textless pages give an empty text. Marks left open end with the block or part
around them; nothing is cut off a page. Repeated rows each get a result.
"""

import re
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.arrow import over_texts
from tillroll.llm.toxicity import adam, sigmoid

#: Pages the network is fitted on, at most.
SAMPLE = 250
PATHS, WORDS, HIDDEN = 1 << 11, 1 << 11, 6
ROUNDS, BATCH, RATE, INSERTED = 8, 16, 0.02, 5
#: Blocks of a batch of pages computed at a time.
WIDTH = 4096

# fixed values: elements without content, within a line, or never part of the main text
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
INLINE = set("a abbr b bdi bdo big br cite code del dfn em font i img ins kbd mark q s samp small span strike strong sub sup time tt u var wbr".split())
APART = "head script style nav header footer aside form button noscript template select textarea iframe svg dialog menu".split()
CLASSES = (
    "ad ads advert advertisement banner sponsor promo cookie consent notice sidebar comment comments reply menu nav navbar "
    "navigation header footer breadcrumb share social related subscribe newsletter popup modal login"
).split()
BODY = {"article", "main", "role-main"}
_PARTS = re.compile(r"[a-z]+")
_WHITE = re.compile(r"\s+")


class _Blocks(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.stack, self.blocks, self.text = [], [], []

    def cut(self):
        text = _WHITE.sub(" ", "".join(self.text)).strip()
        if text:
            path = [p for _, parts in self.stack for p in parts]
            self.blocks.append((tuple(path), text))
        self.text = []

    def handle_starttag(self, tag, attrs):
        if tag == "br" or tag in VOID:
            self.text.append(" ")
        if tag not in INLINE:
            self.cut()
            if tag in ("p", "li", "tr", "td", "th", "dt", "dd", "option"):
                self.end_open(tag, {"p": ()}.get(tag, ("ul", "ol", "table", "dl", "select")))
        if tag in VOID:
            return
        parts = [tag]
        for name, value in attrs:
            if name in ("class", "id", "role") and value:
                parts += [f"{name}-{part}" if name == "role" else f"class-{part}" for part in _PARTS.findall(value.lower())]
        self.stack.append((tag, parts))

    def end_open(self, tag, walls):
        """Close an open element of this kind, unless a wall or a part of the page stands between."""
        for i in range(len(self.stack) - 1, -1, -1):
            name = self.stack[i][0]
            if name == tag:
                del self.stack[i:]
                return
            if name in walls or name in ("article", "section", "div", "body", "main", "td", "blockquote"):
                return

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)

    def handle_endtag(self, tag):
        if tag not in INLINE:
            self.cut()
        for i in range(len(self.stack) - 1, -1, -1):
            if self.stack[i][0] == tag:
                del self.stack[i:]
                return

    def handle_data(self, data):
        self.text.append(data)


def blocks_of(html) -> list:
    """(path, text) of each block of a page."""
    parser = _Blocks()
    parser.feed(html or "")
    parser.close()  # what is left of an open mark is text
    parser.cut()
    return parser.blocks


def weak_labels(blocks) -> list:
    """1 for blocks whose path says main text."""
    apart = {*APART, *[f"class-{c}" for c in CLASSES]}
    inside = any(BODY & set(path) for path, _ in blocks)
    return [int(not apart & set(path) and (not inside or bool(BODY & set(path)))) for path, _ in blocks]


_hash = xxhash.xxh32_intdigest


def features(path, text):
    words = text.split()
    return [_hash(p.encode()) % PATHS for p in dict.fromkeys(path)], [_hash(w.lower().encode()) % WORDS for w in words]


class Labeller:
    def __init__(self, seed=3):
        draw = np.random.default_rng(seed)

        def normal(*shape, size=0.1):
            return (draw.standard_normal(shape) * size).astype(np.float32)

        self.p = {
            "path": normal(PATHS, 8 * HIDDEN), "word": normal(WORDS, 8 * HIDDEN, size=0.02), "bias": np.zeros(8 * HIDDEN, np.float32),
            "u0": normal(HIDDEN, 4 * HIDDEN), "u1": normal(HIDDEN, 4 * HIDDEN),
            "out": normal(2 * HIDDEN, size=0.5), "b": np.zeros(1, np.float32),
        }

    def inputs(self, found):
        rows = np.empty((len(found), 8 * HIDDEN), np.float32)
        for i, (path, words) in enumerate(found):
            rows[i] = self.p["path"][path].sum(axis=0) if path else 0
            if words:
                counts = np.bincount(words, minlength=0)
                used = np.flatnonzero(counts)
                rows[i] += counts[used].astype(np.float32) @ self.p["word"][used] / len(words)
        return rows + self.p["bias"]

    def forward(self, x, mask, tape=None):
        n, steps, _ = x.shape
        states = np.zeros((n, steps, 2 * HIDDEN), np.float32)
        for way in (0, 1):
            h = c = np.zeros((n, HIDDEN), np.float32)
            mine, u = x[:, :, way * 4 * HIDDEN : (way + 1) * 4 * HIDDEN], self.p[f"u{way}"]
            for t in range(steps) if way == 0 else range(steps - 1, -1, -1):
                a = mine[:, t] + h @ u
                s, g = sigmoid(a[:, : 3 * HIDDEN]), np.tanh(a[:, 3 * HIDDEN :])
                i, f, o = s[:, :HIDDEN], s[:, HIDDEN : 2 * HIDDEN], s[:, 2 * HIDDEN :]
                m = mask[:, t : t + 1]
                c_new = m * (f * c + i * g) + (1 - m) * c
                q = np.tanh(c_new)
                if tape is not None:
                    tape.append((way, t, h, c, i, f, o, g, q, m))
                h, c = m * o * q + (1 - m) * h, c_new
                states[:, t, way * HIDDEN : (way + 1) * HIDDEN] = h
        return states @ self.p["out"] + self.p["b"][0], states

    def gradients(self, x, error, states, tape):
        grads = {"out": np.einsum("nth,nt->h", states, error), "b": np.array([error.sum()], np.float32)}
        d_states, d_x = error[:, :, None] * self.p["out"], np.zeros_like(x)
        for way in (0, 1):
            u, slope = self.p[f"u{way}"], np.zeros_like(self.p[f"u{way}"])
            dh = dc = 0.0
            for w, t, h, c, i, f, o, g, q, m in reversed(tape):
                if w != way:
                    continue
                d = d_states[:, t, way * HIDDEN : (way + 1) * HIDDEN] + dh
                d_cell = dc + d * m * o * (1 - q**2)
                live = d_cell * m
                gates = np.concatenate(
                    [live * g * i * (1 - i), live * c * f * (1 - f), d * m * q * o * (1 - o), live * i * (1 - g**2)], axis=1
                )
                slope += h.T @ gates
                dh = d * (1 - m) + gates @ u.T
                dc = live * f + d_cell * (1 - m)
                d_x[:, t, way * 4 * HIDDEN : (way + 1) * 4 * HIDDEN] = gates
            grads[f"u{way}"] = slope
        return grads, d_x

    def label(self, pages):
        """For each page, given as features of its blocks, an array of booleans."""
        out = [np.zeros(0, bool)] * len(pages)
        order = sorted((i for i in range(len(pages)) if pages[i]), key=lambda i: len(pages[i]))
        while order:
            part = order[: max(1, WIDTH // len(pages[order[0]]))]
            while len(part) > 1 and len(part) * len(pages[part[-1]]) > 2 * WIDTH:
                part.pop()
            order = order[len(part) :]
            x, mask = self.batch([pages[i] for i in part])
            logits, _ = self.forward(x, mask)
            for i, row in zip(part, logits):
                out[i] = row[: len(pages[i])] > 0
        return out

    def batch(self, pages):
        x = np.zeros((len(pages), max(map(len, pages)), 8 * HIDDEN), np.float32)
        mask = np.zeros(x.shape[:2], np.float32)
        for i, page in enumerate(pages):
            x[i, : len(page)] = self.inputs(page)
            mask[i, : len(page)] = 1
        return x, mask


def train(htmls, seed=9) -> Labeller:
    model, draw = Labeller(), np.random.default_rng(seed)
    apart = [(a,) for a in APART] + [("div", f"class-{c}") for c in CLASSES]
    pages = [b for b in map(blocks_of, htmls) if b]
    moments = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in model.p.items()}
    step = 0
    for _ in range(ROUNDS):
        order = draw.permutation(len(pages))
        for at in range(0, len(order), BATCH):
            found, labels = [], []
            for n in order[at : at + BATCH]:
                blocks, wanted = list(pages[n]), weak_labels(pages[n])
                for _ in range(INSERTED):
                    like, where = blocks[draw.integers(len(blocks))], draw.integers(len(blocks) + 1)
                    path = tuple(like[0]) + apart[draw.integers(len(apart))] + (("p",) if draw.random() < 0.5 else ())
                    blocks.insert(where, (path, like[1]))
                    wanted.insert(where, 0)
                found.append([features(*b) for b in blocks])
                labels.append(wanted)
            x, mask = model.batch(found)
            tape = []
            logits, states = model.forward(x, mask, tape)
            wanted = np.zeros(mask.shape, np.float32)
            for i, row in enumerate(labels):
                wanted[i, : len(row)] = row
            error = ((sigmoid(logits) - wanted) * mask / mask.sum()).astype(np.float32) * 4
            grads, d_x = model.gradients(x, error, states, tape)
            grads["bias"] = d_x.sum(axis=(0, 1))
            grads["path"], grads["word"] = np.zeros_like(model.p["path"]), np.zeros_like(model.p["word"])
            for i, page in enumerate(found):
                for j, (path, words) in enumerate(page):
                    grads["path"][path] += d_x[i, j]
                    if words:
                        np.add.at(grads["word"], words, d_x[i, j] / len(words))
            step += 1
            for name, slope in grads.items():
                adam(model, moments, name, slope, step, rate=RATE)
    return model


def fit(pages: DataFrame, sample: int = SAMPLE) -> Labeller:
    texts = pages.where("html IS NOT NULL").select("html", F.xxhash64("html").alias("h")).orderBy("h", "html").limit(sample)
    return train([r["html"] for r in texts.collect()])


def extractor(spark, model: Labeller):
    """A function from a column of pages to their main text."""
    shared = spark.sparkContext.broadcast(model)

    def prepare():
        model = shared.value

        def extract(htmls):
            out = []
            for at in range(0, len(htmls), 64):
                pages = [blocks_of(h) for h in htmls[at : at + 64]]
                labels = model.label([[features(*b) for b in page] for page in pages])
                out += [" ".join(text for (_, text), keep in zip(page, row) if keep) for page, row in zip(pages, labels)]
            return out

        return extract

    return over_texts("string", pa.string(), prepare)
