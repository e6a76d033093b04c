"""Toxicity scores from a bidirectional gated recurrent network with attention pooling.

A word enters the network twice: as a word (an embedding of the training sample's frequent
words) and as characters (embeddings of its hashed byte n-grams, from its first byte to its
last).  A run of more than ``LONGEST`` bytes without a break, as in scripts that write no
spaces, counts as several words, pieces that overlap.  Windows of ``WIDTH`` words,
each overlapping the next by half, cover a whole text; forward and backward gated units read
a window, attention pools their states, a logistic unit scores it.  A text's score combines its
strongest window, the sum of its windows' probabilities and their number by a logistic curve.

The network is trained in numpy on a bounded sample: at most ``SAMPLE_ROWS`` rows of label 1
and three times as many of label 0, drawn by a hash of the id from rows the caller marks as
learnable, and at most ``SAMPLE_WINDOWS`` windows of each.  Only words and n-grams whose
presence tells the labels of the sampled texts apart have an embedding; windows without any
are alike and are scored once.  Labels say that a text is toxic, not where; after the
first rounds only the strongest windows of a toxic text keep its label.  A fifth of the
sample is kept out of the training and calibrates the scores over all its windows.

Defined results: a null or empty text has no window and scores the share of label 1 among the
learnable rows; without labels of both classes every text scores that share (0 without any);
texts of any length are scored whole; repeated rows score alike; a label that is null is no
label, and of repeated labels of an id the largest counts; an empty table gives an empty
result; extra columns are ignored.  Only texts enter a score.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import columns_of, map_batches, text_bytes
from quarry.llm.hashing import _lut, as_bytes, span_hashes, spans

WIDTH, STEP = 24, 12
SAMPLE_ROWS = 700
SAMPLE_WINDOWS = 30
HIDDEN, WORD_DIM, CHAR_DIM, ATTEND = 8, 8, 8, 8
WORDS = 4000
GRAM_ROWS = 1 << 14
#: Bytes of a word; longer runs become pieces of two strides, each sharing one with the next
#: (a stride less than half of it, as a piece begins up to 3 bytes early, with its character).
LONGEST, STRIDE = 24, 10
GRAMS = 6 + LONGEST - 2
EPOCHS = 8
#: Words and n-grams of fewer sampled texts than this are not learned.
LEAST_TEXTS = 5
#: ... nor those whose presence tells the labels apart by a smaller chi-square.
TELLING = 20.0
DECAY = 0.02
SEED = 5

_F = np.float32
_BREAK = _lut(bytes(b for b in range(128) if not chr(b).isalnum()))
#: Spaces and punctuation outside ASCII (those that join letters, as U+200D, stay).
_WIDE_BREAK = re.compile(
    "[\u0080-\u00a9\u00ab-\u00b4\u00b6-\u00b9\u00bb-\u00bf\u00d7\u00f7\u1680\u2000-\u200b\u2010-\u205f"
    "\u3000-\u3004\u3008-\u3020\u3030\u303d-\u303f\u30fb\ufe30-\ufe4f\uff01-\uff0f\uff1a-\uff20"
    "\uff3b-\uff40\uff5b-\uff65]+")


def lowered(text: bytes) -> bytes:
    """Lower case, with every break an ASCII one."""
    return _WIDE_BREAK.sub(" ", text.decode("utf-8", "replace").lower()).encode("utf-8", "replace")


def word_spans(buf: np.ndarray):
    """Starts and ends of the words; a run above ``LONGEST`` bytes is cut, between characters,
    into overlapping pieces."""
    starts, ends = spans(buf, _BREAK)
    size = ends - starts
    if not (size > LONGEST).any():
        return starts, ends
    count = np.where(size > LONGEST, -(-size // STRIDE) - 1, 1)
    last = np.cumsum(count)
    nth = np.arange(last[-1]) - np.repeat(last - count, count)
    run_start, run_end = np.repeat(starts, count), np.repeat(ends, count)
    final = nth == np.repeat(count, count) - 1

    def cut(at):
        for _ in range(3):
            at = at - ((at > run_start) & (buf[np.minimum(at, len(buf) - 1)] & 0xC0 == 0x80))
        return at
    begin = cut(run_start + nth * STRIDE)
    return begin, np.where(final, run_end, cut(np.minimum(run_start + (nth + 2) * STRIDE, run_end - 1)))


def words_of(text: bytes):
    """Hash and byte n-gram rows of every distinct word of a ``lowered`` text, and the text as
    indices into them."""
    buf = as_bytes(text)
    starts, ends = word_spans(buf)
    hashes = span_hashes(buf, starts, ends)
    distinct, first, index = np.unique(hashes, return_index=True, return_inverse=True)
    return distinct, gram_rows(buf, starts[first], ends[first]), index


def gram_rows(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """``GRAMS`` rows of the n-gram table per word of at most ``LONGEST`` bytes: prefixes of 3
    to 8 bytes and all trigrams; 0 where the word is too short."""
    n = len(starts)
    if not n:
        return np.zeros((0, GRAMS), dtype=np.int32)
    at = starts[:, None] + np.arange(LONGEST)
    inside = at < ends[:, None]
    byte = np.where(inside, buf[np.minimum(at, len(buf) - 1)], 0).astype(np.uint32)
    out = np.zeros((n, GRAMS), dtype=np.int32)
    size = ends - starts
    prefix = np.full(n, 17, dtype=np.uint32)
    for k in range(8):
        prefix = (prefix ^ byte[:, k]) * np.uint32(0x01000193)
        if k >= 2:
            row = (prefix ^ (prefix >> np.uint32(15))) % np.uint32(GRAM_ROWS - 1) + np.uint32(1)
            out[:, k - 2] = np.where(size > k, row, 0)
    for k in range(LONGEST - 2):
        tri = (byte[:, k] | byte[:, k + 1] << np.uint32(8) | byte[:, k + 2] << np.uint32(16))
        tri = tri * np.uint32(0x9E3779B1)
        row = (tri >> np.uint32(12)) % np.uint32(GRAM_ROWS - 1) + np.uint32(1)
        out[:, 6 + k] = np.where(size > k + 2, row, 0)
    return out


def window_index(index: np.ndarray) -> np.ndarray:
    """Windows (rows) over a text given as word indices; -1 pads a text shorter than one."""
    n = len(index)
    if n == 0:
        return np.zeros((0, WIDTH), dtype=np.int64)
    if n <= WIDTH:
        return np.concatenate([index, np.full(WIDTH - n, -1)])[None, :]
    starts = np.append(np.arange(0, n - WIDTH, STEP), n - WIDTH)
    return index[starts[:, None] + np.arange(WIDTH)]


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class Network:
    """Parameters, forward pass and gradients."""

    def __init__(self, vocabulary: np.ndarray, known: np.ndarray, seed: int = SEED):
        state = np.random.default_rng(seed)
        d, h = WORD_DIM + CHAR_DIM, HIDDEN

        def draw(*shape, scale):
            return (state.standard_normal(shape) * scale).astype(_F)
        self.vocabulary = vocabulary  # sorted word hashes; row 0 of "word" is for all others
        self.known = known  # mask over the n-gram table: rows that were learned
        self.p = {"word": draw(len(vocabulary) + 1, WORD_DIM, scale=0.1),
                  "gram": draw(GRAM_ROWS, CHAR_DIM, scale=0.1),
                  "attend": draw(2 * h, ATTEND, scale=0.3), "attend_b": np.zeros(ATTEND, _F),
                  "focus": draw(ATTEND, scale=0.3),
                  "out": draw(2 * h, scale=0.3), "out_b": np.zeros(1, _F)}
        for side in ("f", "b"):
            self.p[f"w{side}"] = draw(d, 3 * h, scale=0.4)
            self.p[f"u{side}"] = draw(h, 3 * h, scale=0.3)
            self.p[f"c{side}"] = np.zeros(3 * h, _F)
        self.p["word"][0] = self.p["gram"][0] = 0

    def rows(self, hashes: np.ndarray) -> np.ndarray:
        """Embedding rows of word hashes."""
        if not len(self.vocabulary):
            return np.zeros(len(hashes), dtype=np.int64)
        at = np.minimum(np.searchsorted(self.vocabulary, hashes), len(self.vocabulary) - 1)
        return np.where(self.vocabulary[at] == hashes, at + 1, 0)

    def learned(self, grams: np.ndarray) -> np.ndarray:
        return np.where(self.known[grams], grams, 0)

    def inputs(self, rows: np.ndarray, grams: np.ndarray) -> np.ndarray:
        """Word embedding and summed n-gram embeddings; row 0 stays zero in both tables."""
        return np.concatenate([self.p["word"][rows], self.p["gram"][grams].sum(axis=1)], axis=1)

    def forward(self, x: np.ndarray, windows: np.ndarray, keep: bool = False):
        """Logit of each window; ``x``: inputs of the distinct words."""
        h, n = HIDDEN, len(windows)
        mask = (windows >= 0).astype(_F)
        states = np.zeros((WIDTH, n, 2 * h), _F)
        trace = {}
        for side, order in (("f", range(WIDTH)), ("b", range(WIDTH - 1, -1, -1))):
            proj = np.concatenate([x @ self.p[f"w{side}"] + self.p[f"c{side}"],
                                   np.zeros((1, 3 * h), _F)])
            u, state, steps = self.p[f"u{side}"], np.zeros((n, h), _F), []
            lo = 0 if side == "f" else h
            for t in order:
                g = proj[windows[:, t]]
                k = state @ u
                gates = _sigmoid(g[:, :2 * h] + k[:, :2 * h])
                z, r = gates[:, :h], gates[:, h:]
                cand = np.tanh(g[:, 2 * h:] + r * k[:, 2 * h:])
                m = mask[:, t:t + 1]
                new = state + m * (1 - z) * (cand - state)
                if keep:
                    steps.append((t, state, z, r, cand, k[:, 2 * h:]))
                state = new
                states[t, :, lo:lo + h] = state
            trace[side] = steps
        tang = np.tanh(states @ self.p["attend"] + self.p["attend_b"])
        e = tang @ self.p["focus"] - (1 - mask.T) * _F(1e4)
        e = np.exp(e - e.max(axis=0))
        alpha = e / e.sum(axis=0)
        pooled = (alpha[:, :, None] * states).sum(axis=0)
        logit = pooled @ self.p["out"] + self.p["out_b"][0]
        if keep:
            return logit, (mask, states, trace, tang, alpha, pooled)
        return logit

    def gradients(self, x, windows, target, weight):
        """Gradients of the weighted cross-entropy, and that of the inputs ``x``."""
        h = HIDDEN
        logit, (mask, states, trace, tang, alpha, pooled) = self.forward(x, windows, True)
        g = {}
        d_logit = ((_sigmoid(logit) - target) * weight / weight.sum()).astype(_F)
        g["out"], g["out_b"] = pooled.T @ d_logit, np.array([d_logit.sum()], _F)
        d_pooled = d_logit[:, None] * self.p["out"]
        d_states = alpha[:, :, None] * d_pooled
        d_alpha = (states * d_pooled).sum(axis=2)
        d_e = alpha * (d_alpha - (alpha * d_alpha).sum(axis=0))
        g["focus"] = np.tensordot(d_e, tang, axes=([0, 1], [0, 1]))
        d_tang = d_e[:, :, None] * self.p["focus"] * (1 - tang * tang)
        g["attend"] = np.tensordot(states, d_tang, axes=([0, 1], [0, 1]))
        g["attend_b"] = d_tang.sum(axis=(0, 1))
        d_states = d_states + d_tang @ self.p["attend"].T
        d_x = np.zeros_like(x)
        flat = np.where(windows >= 0, windows, len(x))
        for side in ("f", "b"):
            u, lo = self.p[f"u{side}"], 0 if side == "f" else h
            d_u, d_state = np.zeros_like(u), np.zeros((len(windows), h), _F)
            d_proj = np.zeros((len(windows), WIDTH, 3 * h), _F)
            for t, before, z, r, cand, k in reversed(trace[side]):
                d_new = d_state + d_states[t, :, lo:lo + h]
                m = mask[:, t:t + 1]
                d_cand = d_new * m * (1 - z) * (1 - cand * cand)
                d_z = -d_new * m * (cand - before) * z * (1 - z)
                d_r = d_cand * k * r * (1 - r)
                d_gate = np.concatenate([d_z, d_r, d_cand], axis=1)
                d_k = np.concatenate([d_z, d_r, d_cand * r], axis=1)
                d_proj[:, t] = d_gate
                d_u += before.T @ d_k
                d_state = d_new * (1 - m * (1 - z)) + d_k @ u.T
            g[f"u{side}"] = d_u
            total = np.stack([np.bincount(flat.ravel(), d_proj[:, :, j].ravel(), len(x) + 1)[:len(x)]
                              for j in range(3 * h)], axis=1).astype(_F)
            g[f"w{side}"] = x.T @ total
            g[f"c{side}"] = total.sum(axis=0)
            d_x += total @ self.p[f"w{side}"].T
        return g, d_x

    def score_texts(self, texts: list[bytes], chunk: int = 8192) -> np.ndarray:
        """Per text: largest window logit, sum of the windows' probabilities and number of
        windows (0 windows: no word)."""
        lower = [lowered(t) for t in texts]
        hashes, grams, index = words_of(b"\n".join(lower))
        counts = [len(word_spans(as_bytes(t))[0]) for t in lower]
        rows, grams = self.rows(hashes), self.learned(grams)
        x = self.inputs(rows, grams)
        speaks = np.append((rows > 0) | (grams > 0).any(axis=1), True)  # padding is last
        ends = np.cumsum(counts)
        windows = [window_index(index[end - n:end]) for n, end in zip(counts, ends)]
        owner = np.repeat(np.arange(len(texts)), [len(w) for w in windows])
        windows = np.concatenate(windows)
        active = np.flatnonzero(speaks[windows].any(axis=1))
        silent = self.forward(np.zeros((1, x.shape[1]), _F), np.zeros((1, WIDTH), np.int64))[0]
        logit = np.full(len(windows), silent)
        for lo in range(0, len(active), chunk):
            part = active[lo:lo + chunk]
            logit[part] = self.forward(x, windows[part])
        out = np.zeros((len(texts), 3))
        out[:, 0] = -np.inf
        np.maximum.at(out[:, 0], owner, logit)
        out[:, 1] = np.bincount(owner, _sigmoid(logit), len(texts))
        out[:, 2] = np.bincount(owner, minlength=len(texts))
        return out


def _telling(both: np.ndarray, toxic: np.ndarray, toxic_text: np.ndarray) -> np.ndarray:
    """Chi-square of each item's presence in a text against the text's label, from the texts
    and the toxic texts that hold it (0 for items of fewer than ``LEAST_TEXTS`` texts)."""
    total, ones = float(len(toxic_text)), float(toxic_text.sum())
    off = toxic * total - both * ones
    spread = both * (total - both) * ones * (total - ones)
    chi = np.where(spread > 0, off * off * total / np.maximum(spread, 1), 0.0)
    return np.where(both >= LEAST_TEXTS, chi, 0.0)


def train(samples: list[tuple[int, int, bytes]], seed: int = SEED, epochs: int = EPOCHS) -> Network | None:
    """Windows (text number, label, words) -> network; None without both labels."""
    labels = {label for _, label, _ in samples}
    if labels != {0, 1}:
        return None
    samples = sorted(samples)
    hashes, grams, index = words_of(b"\n".join(w for _, _, w in samples))
    counts = [len(w.split()) for _, _, w in samples]
    ends = np.cumsum(counts)
    windows = np.full((len(samples), WIDTH), -1, dtype=np.int64)
    for i, (n, end) in enumerate(zip(counts, ends)):
        windows[i, :n] = index[end - n:end]
    text = np.unique(np.array([t for t, _, _ in samples]), return_inverse=True)[1]
    label = np.array([y for _, y, _ in samples], dtype=_F)
    # words and n-grams that tell the labels apart, by the sampled texts that hold them
    toxic_text = np.zeros(text.max() + 1, dtype=bool)
    toxic_text[text[label > 0]] = True
    owner = np.repeat(text, counts)
    pairs = np.unique(owner * np.int64(len(hashes)) + index)
    word = pairs % len(hashes)
    tells = _telling(np.bincount(word, minlength=len(hashes)).astype(float),
                     np.bincount(word, toxic_text[pairs // len(hashes)], len(hashes)), toxic_text)
    chosen = np.sort(np.argsort(-tells, kind="stable")[:WORDS])
    chosen = chosen[tells[chosen] >= TELLING]
    holders, toxic_holders = np.zeros(GRAM_ROWS), np.zeros(GRAM_ROWS)
    edges = np.searchsorted(pairs // len(hashes), np.arange(0, text.max() + 101, 100))
    for lo, hi in zip(edges[:-1], edges[1:]):  # a hundred texts at a time
        of, word = pairs[lo:hi] // len(hashes), pairs[lo:hi] % len(hashes)
        both = np.unique((of[:, None] * np.int64(GRAM_ROWS) + grams[word]).ravel())
        holders += np.bincount(both % GRAM_ROWS, minlength=GRAM_ROWS)
        toxic_holders += np.bincount(both % GRAM_ROWS, toxic_text[both // GRAM_ROWS], GRAM_ROWS)
    known = _telling(holders, toxic_holders, toxic_text) >= TELLING
    known[0] = False
    net = Network(hashes[chosen], known, seed)
    rows, grams = net.rows(hashes), net.learned(grams)
    state = np.random.default_rng(seed)
    speaks = np.append((rows > 0) | (grams > 0).any(axis=1), False)
    useful = speaks[windows].any(axis=1) | (state.random(len(samples)) < 0.02)
    windows, text, label = windows[useful], text[useful], label[useful]
    if not (label > 0).any() or not (label == 0).any():
        return None
    moment = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in net.p.items()}
    step, size = 0, 256
    weight = np.where(label > 0, 0.5 * (label == 0).sum() / max((label > 0).sum(), 1), 1.0)
    for epoch in range(epochs):
        active = np.ones(len(label), dtype=bool)
        if epoch >= 2:  # keep the strongest windows of toxic texts
            x = net.inputs(rows, grams)
            logit = np.concatenate([net.forward(x, windows[i:i + 2048])
                                    for i in range(0, len(windows), 2048)])
            top = np.full(text.max() + 1, -np.inf)
            np.maximum.at(top, text, logit)
            active = (label == 0) | (logit >= np.minimum(top[text] - 0.5, 2.0))
            weight = np.where(label > 0, (label == 0).sum() / max(
                ((label > 0) & active).sum(), 1) / 2, 1.0)
            weight = np.minimum(weight, 20.0)
        order = state.permutation(np.flatnonzero(active))
        rate = 0.02 * (1 - epoch / epochs) + 0.002
        for lo in range(0, len(order), size):
            pick = order[lo:lo + size]
            used, local = np.unique(windows[pick], return_inverse=True)
            local = local.reshape(len(pick), WIDTH)
            if used[0] < 0:
                used, local = used[1:], local - 1
            x = net.inputs(rows[used], grams[used])
            g, d_x = net.gradients(x, local, label[pick], weight[pick])
            g["word"] = np.stack([np.bincount(rows[used], d_x[:, j], len(net.p["word"]))
                                  for j in range(WORD_DIM)], axis=1).astype(_F)
            ids = grams[used]
            g["gram"] = np.stack([np.bincount(ids.ravel(), np.repeat(d_x[:, WORD_DIM + j], GRAMS),
                                              GRAM_ROWS) for j in range(CHAR_DIM)], axis=1).astype(_F)
            g["word"][0] = g["gram"][0] = 0
            step += 1
            for k, value in net.p.items():
                m, v = moment[k]
                if k in ("word", "gram"):
                    value *= _F(1 - rate * DECAY)
                m += (g[k] - m) * _F(0.1)
                v += (g[k] * g[k] - v) * _F(0.001)
                value -= _F(rate) * (m / _F(1 - 0.9 ** step)) / (
                    np.sqrt(v / _F(1 - 0.999 ** step)) + _F(1e-7))
    return net


def evidence(found: np.ndarray) -> np.ndarray:
    """Columns of the calibrating curve from (largest logit, sum of probabilities, windows)."""
    top, total, n = found[:, 0], found[:, 1], np.maximum(found[:, 2], 1)
    return np.stack([top, np.log(total + 0.1), np.log(n)], axis=1)


def calibrate(found: np.ndarray, labels: np.ndarray) -> np.ndarray:
    """Coefficients (three and an offset) of a logistic curve, by Newton steps with a weak
    pull to the strongest window's logit as it is."""
    x = np.concatenate([evidence(found), np.ones((len(found), 1))], axis=1)
    start = np.array([1.0, 0.0, 0.0, 0.0])
    pull = np.array([1.0, 1.0, 1.0, 0.1])
    c = start.copy()
    for _ in range(100):
        p = _sigmoid(x @ c)
        w = p * (1 - p)
        grad = x.T @ (p - labels) + pull * (c - start)
        move = np.linalg.solve((x * w[:, None]).T @ x + np.diag(pull), grad)
        move *= min(1.0, 1.0 / (np.abs(move).max() + 1e-12))
        c = c - move
        if np.abs(move).max() < 1e-8:
            break
    return c


def _sample_windows(docs: DataFrame, most: int) -> list[tuple[int, int, bytes]]:
    """At most ``most`` windows, spread evenly, of each sampled row."""
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        col = columns_of(batch, ["_row", "_label", "_text"])
        row, label, words = [], [], []
        for i, text in enumerate(text_bytes(col["_text"])):
            lower = lowered(text)
            starts, ends = word_spans(as_bytes(lower))
            shown = window_index(np.arange(len(starts)))
            if len(shown) > most:
                shown = shown[np.linspace(0, len(shown) - 1, most).astype(int)]
            for window in shown:
                inside = window[window >= 0]
                row.append(col["_row"][i].as_py())
                label.append(col["_label"][i].as_py())
                words.append(b" ".join(lower[starts[k]:ends[k]] for k in inside))
        return pa.RecordBatch.from_arrays(
            [pa.array(row, pa.int64()), pa.array(label, pa.int32()), pa.array(words, pa.binary())],
            names=["row", "label", "words"])
    out = map_batches(docs, run, "row long, label int, words binary")
    got = out.toArrow()
    return list(zip(*(got.column(c).to_pylist() for c in ("row", "label", "words"))))


def _scored(docs: DataFrame, net: Network, curve: np.ndarray | None, names: list[str]) -> DataFrame:
    """``names`` and, per row, ``top, total, windows`` or with a ``curve`` the ``score`` (null
    without words)."""
    model = docs.sparkSession.sparkContext.broadcast(net)
    types = [docs.schema[c].dataType.simpleString() for c in names]
    fields = ["top", "total", "windows"] if curve is None else ["score"]

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        found, group, held = [], [], 0
        texts = text_bytes(batch.column(batch.schema.get_field_index("_text")))
        for i, text in enumerate(texts):  # a few MB of text at a time
            group.append(text)
            held += len(text)
            if held > 2_000_000 or i + 1 == len(texts):
                found.append(model.value.score_texts(group))
                group, held = [], 0
        found = np.concatenate(found)
        none = found[:, 2] == 0
        found[none, 0] = 0
        if curve is not None:
            found = _sigmoid(evidence(found) @ curve[:3] + curve[3])[:, None]
        return pa.RecordBatch.from_arrays(
            [*(batch.column(batch.schema.get_field_index(c)) for c in names),
             *(pa.array(found[:, k], pa.float64(), mask=none) for k in range(len(fields)))],
            names=[*names, *fields])
    return map_batches(docs, run, ", ".join(
        [*(f"`{c}` {t}" for c, t in zip(names, types)), *(f"{f} double" for f in fields)]))


def score(docs: DataFrame, labels: DataFrame, learnable: Column, id_col: str = "doc_id",
          text_col: str = "text", label_col: str = "toxic", sample_rows: int = SAMPLE_ROWS,
          sample_windows: int = SAMPLE_WINDOWS, seed: int = SEED) -> DataFrame:
    """``id_col, score``, one row per document row.

    ``learnable`` is a condition on the id: labels of other rows are never read.
    """
    known = (labels.where(learnable & F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull())
             .groupBy(F.col(id_col).alias("_id")).agg(F.max(label_col).cast("int").alias("_label")))
    share = known.agg(F.avg("_label")).first()[0] or 0.0
    draw = F.xxhash64(F.lit(seed), F.col("_id"))
    picked = None
    for value, most in ((0, 3 * sample_rows), (1, sample_rows)):
        part = known.where(F.col("_label") == value).orderBy(draw, "_id").limit(most)
        picked = part if picked is None else picked.unionByName(part)
    picked = picked.withColumn("_row", draw).withColumn("_calibrates", F.pmod(draw, F.lit(5)) == 0)
    rows = docs.sparkSession.createDataFrame(picked.collect(), picked.schema)  # bounded by the sample
    sampled = (docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
               .join(F.broadcast(rows), "_id")
               # of rows that repeat an id one is learned from, whatever their number
               .groupBy("_id", "_row", "_label", "_calibrates")
               .agg(F.min_by("_text", F.xxhash64("_text")).alias("_text")))
    fitting = sampled.where("NOT _calibrates").select("_row", "_label", "_text")
    net = train(_sample_windows(fitting, sample_windows), seed)
    texts = docs.select(F.col(id_col), F.col(text_col).alias("_text"))
    if net is None:
        return texts.select(id_col, F.lit(float(share)).alias("score"))
    seen = _scored(sampled.where("_calibrates").select("_label", "_text"), net, None,
                   ["_label"]).where("windows > 0").collect()
    curve = np.array([1.0, 0.0, 0.0, 0.0])
    if len({r["_label"] for r in seen}) == 2:
        curve = calibrate(np.array([[r["top"], r["total"], r["windows"]] for r in seen]),
                          np.array([r["_label"] for r in seen], dtype=float))
    return _scored(texts, net, curve, [id_col]).select(
        id_col, F.coalesce("score", F.lit(float(share))).alias("score"))
