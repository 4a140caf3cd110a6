"""HTML extraction by a recurrent block labeller.

A page is a sequence of leaf blocks. Each block is read as two hashed vectors,
one of its tag path (tags and class names of the elements above it) and one of
its words, and a bidirectional LSTM in numpy labels every block as main text or
not, with the whole page as context. The main blocks, in page order, are the text.

The labeller is trained here, on ``TRAIN_PAGES`` generated pages of many layouts
(``html_training``); it is small, seeded and the same in every run. Pages are
labelled in batches of similar length, inside the scan: no shuffle.

Defined results: null or blank html gives an empty text with 0 characters; a
null url stays null; repeated rows give repeated results; an empty table gives
an empty result; extra columns are ignored.
"""

from __future__ import annotations

import functools
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from reelstack.llm import html_training
from reelstack.llm.common import only
from reelstack.llm.html_blocks import Block, blocks_of
from reelstack.llm.tokens import U64, word_hashes

TRAIN_PAGES = 1200
EPOCHS = 6
HIDDEN = 16
PATH_SIZE = 512
WORD_SIZE = 128
# Words, share of linked text, sentence marks, place in the page, bias.
EXTRA = 5
# Blocks (pages x steps, padded) that one pass of the network holds.
PASS_BLOCKS = 1 << 14


def path_slots(path: tuple[str, ...], linked: float) -> list[int]:
    """Hashed places of a tag path: each name, its first letters, the names of
    the block's own element, and a coarse share of links."""
    names = set()
    for element in path:
        tag, *parts = element.split()
        names.add("t:" + tag)
        names.update("c:" + p for p in parts)
        names.update("x:" + p[:4] for p in parts if len(p) > 3)
    names.add("l:" + path[-1].split()[0] if path else "l:")
    names.add(f"k:{round(linked * 2)}")
    return sorted({zlib.crc32(n.encode()) % PATH_SIZE for n in names})


def word_vectors(blocks: list[Block]) -> np.ndarray:
    """Hashed word counts (damped) and the extra numbers of every block."""
    raw = [b.text.lower().encode("utf-8", "replace") for b in blocks]
    raw = [b" ".join(t.split()) or b"." for t in raw]
    counts = np.array([t.count(b" ") + 1 for t in raw])
    slot = (word_hashes(b" ".join(raw)) % U64(WORD_SIZE)).astype(np.int64)
    row = np.repeat(np.arange(len(blocks)), counts)
    out = np.zeros((len(blocks), WORD_SIZE + EXTRA), np.float32)
    bag = np.bincount(row * WORD_SIZE + slot, minlength=len(blocks) * WORD_SIZE).reshape(-1, WORD_SIZE)
    out[:, :WORD_SIZE] = bag / counts[:, None]
    marks = np.array([t.count(b". ") + t.count(b", ") + t.endswith(b".") for t in raw])
    out[:, WORD_SIZE] = np.log1p(counts) / 4
    out[:, WORD_SIZE + 1] = [b.linked for b in blocks]
    out[:, WORD_SIZE + 2] = np.minimum(1, marks / counts * 4)
    out[:, WORD_SIZE + 4] = 1
    return out


def squash(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class Labeller:
    """Weights: ``path`` and ``word`` map the two vectors to the gates of both
    directions, ``back`` the hidden states, ``out`` both states to the label."""

    SHAPES = {"path": (PATH_SIZE, 8 * HIDDEN), "word": (WORD_SIZE + EXTRA, 8 * HIDDEN),
              "back": (2, HIDDEN, 4 * HIDDEN), "out": (2 * HIDDEN + 1,)}

    def __init__(self, weights: dict[str, np.ndarray]):
        self.w = weights
        self.seen: dict = {}

    def path_gates(self, block: Block) -> np.ndarray:
        key = (block.path, round(block.linked * 2))
        found = self.seen.get(key)
        if found is None:
            if len(self.seen) > 20_000:
                self.seen.clear()
            found = self.seen[key] = self.w["path"][path_slots(*key[:1], block.linked)].sum(axis=0)
        return found

    def run(self, gates: np.ndarray, lengths: np.ndarray, keep: bool = False):
        """States of both directions for ``gates`` (steps, pages, 8 H). The
        backward direction reads every page from its own last block."""
        steps, pages = gates.shape[:2]
        live = np.arange(steps)[:, None] < lengths[None, :]
        states = np.zeros((steps, pages, 2 * HIDDEN), np.float32)
        trace = []
        for d in range(2):
            h = np.zeros((pages, HIDDEN), np.float32)
            c = np.zeros((pages, HIDDEN), np.float32)
            kept = []
            for t in (range(steps) if d == 0 else range(steps - 1, -1, -1)):
                z = gates[t, :, d * 4 * HIDDEN:(d + 1) * 4 * HIDDEN] + h @ self.w["back"][d]
                i, f, o = (squash(z[:, k * HIDDEN:(k + 1) * HIDDEN]) for k in range(3))
                g = np.tanh(z[:, 3 * HIDDEN:])
                on = live[t][:, None]
                new = f * c + i * g
                tanh = np.tanh(new)
                if keep:
                    kept.append((t, h, c, i, f, o, g, tanh, on))
                c = np.where(on, new, c)
                h = np.where(on, o * tanh, h)
                states[t, :, d * HIDDEN:(d + 1) * HIDDEN] = np.where(on, h, 0)
            trace.append(kept)
        return states, live, trace

    def score(self, states: np.ndarray) -> np.ndarray:
        return states @ self.w["out"][:-1] + self.w["out"][-1]

    def label(self, documents: list[list[Block]]) -> list[np.ndarray]:
        """One boolean array per page. Pages of like length share a pass."""
        out: list = [np.zeros(0, bool)] * len(documents)
        order = sorted((k for k, d in enumerate(documents) if d), key=lambda k: len(documents[k]))
        at = 0
        while at < len(order):
            # The longest page of the pass sets its steps.
            end = at + 1
            while end < len(order) and (end + 1 - at) * len(documents[order[end]]) <= PASS_BLOCKS:
                end += 1
            group = [documents[k] for k in order[at:end]]
            gates, lengths, _ = self.gates(group)
            states, _, _ = self.run(gates, lengths)
            good = self.score(states) > 0
            for j, k in enumerate(order[at:end]):
                out[k] = good[:lengths[j], j]
            at = end
        return out

    def gates(self, documents: list[list[Block]]):
        """Input gates (steps, pages, 8 H), lengths and the word vectors."""
        lengths = np.array([len(d) for d in documents])
        flat = [b for d in documents for b in d]
        words = word_vectors(flat)
        step = np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        words[:, WORD_SIZE + 3] = step / np.repeat(lengths, lengths)
        both = words @ self.w["word"] + np.stack([self.path_gates(b) for b in flat])
        gates = np.zeros((lengths.max(), len(documents), 8 * HIDDEN), np.float32)
        gates[step, np.repeat(np.arange(len(documents)), lengths)] = both
        return gates, lengths, words

    def gradients(self, documents: list[list[Block]], labels: list[list[int]]) -> tuple[dict, float]:
        """Gradient of the mean loss by back-propagation through both directions."""
        self.seen.clear()
        gates, lengths, words = self.gates(documents)
        states, live, trace = self.run(gates, lengths, keep=True)
        steps, pages = gates.shape[:2]
        want = np.zeros((steps, pages), np.float32)
        for j, y in enumerate(labels):
            want[:len(y), j] = y
        p = squash(self.score(states))
        n = live.sum()
        delta = np.where(live, p - want, 0).astype(np.float32) / n
        loss = -np.log(np.where(want > 0, p, 1 - p).clip(1e-7))[live].sum() / n
        grad = {"out": np.append(np.einsum("tb,tbh->h", delta, states), delta.sum()).astype(np.float32),
                "back": np.zeros_like(self.w["back"])}
        d_gates = np.zeros_like(gates)
        for d in range(2):
            rows = slice(d * HIDDEN, (d + 1) * HIDDEN)
            dh = np.zeros((pages, HIDDEN), np.float32)
            dc = np.zeros((pages, HIDDEN), np.float32)
            for t, h, c, i, f, o, g, tanh, on in reversed(trace[d]):
                dh_t = dh + delta[t][:, None] * self.w["out"][rows]
                dc_t = dc + dh_t * o * (1 - tanh ** 2)
                dz = np.concatenate([dc_t * g * i * (1 - i), dc_t * c * f * (1 - f), dh_t * tanh * o * (1 - o),
                                     dc_t * i * (1 - g ** 2)], axis=1) * on
                grad["back"][d] += h.T @ dz
                d_gates[t, :, d * 4 * HIDDEN:(d + 1) * 4 * HIDDEN] = dz
                dh = np.where(on, dz @ self.w["back"][d].T, dh)
                dc = np.where(on, dc_t * f, dc)
        flat = d_gates.transpose(1, 0, 2)[live.T]
        grad["word"] = words.T @ flat
        grad["path"] = np.zeros_like(self.w["path"])
        slots = [path_slots(b.path, b.linked) for doc in documents for b in doc]
        np.add.at(grad["path"], np.concatenate(slots), np.repeat(flat, [len(s) for s in slots], axis=0))
        return grad, float(loss)


def train(pages: int = TRAIN_PAGES, epochs: int = EPOCHS, seed: int = 7, batch: int = 24,
          rate: float = 0.01) -> dict[str, np.ndarray]:
    """Weights after Adam over the generated pages."""
    rng = np.random.default_rng(seed)
    weights = {k: (rng.standard_normal(s) * 0.1).astype(np.float32) for k, s in Labeller.SHAPES.items()}
    weights["word"][-1, :] = np.tile(np.repeat([0, 1, 0, 0], HIDDEN), 2)  # forget gates start open
    examples = sorted(html_training.pages(pages, seed), key=lambda e: len(e[0]))
    mean = {k: np.zeros_like(v) for k, v in weights.items()}
    square = {k: np.zeros_like(v) for k, v in weights.items()}
    model, step = Labeller(weights), 0
    starts = np.arange(0, len(examples), batch)
    for epoch in range(epochs):
        for s in rng.permutation(starts):
            part = examples[s:s + batch]
            grad, _ = model.gradients([e[0] for e in part], [e[1] for e in part])
            step += 1
            pace = rate * (1 - epoch / epochs) * np.sqrt(1 - 0.999 ** step) / (1 - 0.9 ** step)
            for k, g in grad.items():
                mean[k] += 0.1 * (g - mean[k])
                square[k] += 0.001 * (g * g - square[k])
                weights[k] -= pace * (mean[k] / (np.sqrt(square[k]) + 1e-8) + 0.002 * weights[k])
    return weights


@functools.lru_cache(maxsize=1)
def trained() -> dict[str, np.ndarray]:
    """The weights of this process: trained once, on the driver."""
    return train()


def extract_batches(weights):
    """A function from (page_id, url, html) to the main text of each page."""
    def run(batches):
        model = Labeller(weights.value)
        for batch in batches:
            texts = []
            # A few hundred pages at a time keep the blocks in memory few.
            for lo in range(0, batch.num_rows, 512):
                documents = [blocks_of(h) for h in batch.column(2).slice(lo, 512).to_pylist()]
                for blocks, good in zip(documents, model.label(documents)):
                    texts.append("\n\n".join(b.text for b, g in zip(blocks, good.tolist()) if g))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()),
                 pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])
    return run


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars of every page."""
    pages = only(pages, "page_id", "url", "html")
    kind = dict(pages.dtypes)["page_id"]
    weights = pages.sparkSession.sparkContext.broadcast(trained())
    return pages.mapInArrow(extract_batches(weights), f"page_id {kind}, url string, text string, n_chars long")
