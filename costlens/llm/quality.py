"""Document quality by attention-based multiple-instance learning over passages.

A text is cut into passages of ``PASSAGE`` bytes. Each passage is encoded from
how its bytes follow one another (pairs of byte classes) and how much of it
repeats nearby, by a trained tanh layer. A gated attention layer weighs the
passages, ``softmax(w . (tanh(V h) * sigmoid(U h)))``, and a logistic layer
scores the weighted mean of their encodings. All layers are trained together
from document labels, in numpy, on a bounded sample; scoring reads all passages
of all texts.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from costlens.llm.common import bounded_sample, slices

PASSAGE = 512
HIDDEN = 24
ATTENTION = 12

#: Bytes that are a class of their own; the others share one per kind.
OWN = b" \n.,|!?-_%&#$*<>/:@="


def _byte_classes() -> np.ndarray:
    kinds = np.full(256, 5, np.int64)  # other punctuation
    for b in range(256):
        c = chr(b)
        if b >= 0x80:
            kinds[b] = 4
        elif c.islower():
            kinds[b] = 1
        elif c.isupper():
            kinds[b] = 2
        elif c.isdigit():
            kinds[b] = 3
        elif b < 32:
            kinds[b] = 0
    for k, b in enumerate(OWN):
        kinds[b] = 6 + k
    return kinds


CLASSES = 6 + len(OWN)
PAIRS = (CLASSES + 1) ** 2
FEATURES = CLASSES * CLASSES + 3
#: Zero bytes after each text, more than the farthest look back.
GAP = 32
LAGS = range(2, 18)
#: Bytes of a training text whose passages are computed at once.
LONG = 1 << 18


def passages(texts: list[bytes], classes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Feature rows of the texts' passages in a row, and the first row of each text.

    An empty text has one row of zeros. The last three features: the share of
    8-byte strings that also start a few bytes before (``LAGS``), the share of
    bytes above 0x7f, and the passage's length over ``PASSAGE``.
    """
    rows = np.array([-(-(len(t) + GAP) // PASSAGE) for t in texts])
    # An empty row in front: every text, the first one too, follows zero bytes.
    b = np.frombuffer(bytes(PASSAGE) + b"".join(t.ljust(n * PASSAGE, b"\0") for t, n in zip(texts, rows.tolist())), np.uint8)
    sizes = np.array([len(t) for t in texts])
    first = 1 + np.cumsum(rows) - rows
    size = np.repeat(sizes, rows) - PASSAGE * (np.arange(1, rows.sum() + 1) - np.repeat(first, rows))
    size = np.r_[0, np.clip(size, 0, PASSAGE)]
    inside = (np.arange(PASSAGE)[None] < size[:, None]).ravel()
    n, of = len(size), np.arange(len(b)) // PASSAGE
    kind = np.where(inside, classes[b], CLASSES)
    pair = of[:-1] * PAIRS + kind[:-1] * (CLASSES + 1) + kind[1:]
    counts = np.bincount(pair, minlength=n * PAIRS).reshape(n, CLASSES + 1, CLASSES + 1)[:, :CLASSES, :CLASSES]
    x = np.empty((n, FEATURES), np.float32)
    each = np.maximum(size, 1).astype(np.float32)
    x[:, :-3] = np.sqrt(counts.reshape(n, -1) / each[:, None])
    grams = np.lib.stride_tricks.sliding_window_view(b, 8).copy().view(np.uint64)[:, 0]
    again = np.zeros(len(b), bool)
    for lag in LAGS:
        again[lag : len(grams)] |= grams[lag:] == grams[:-lag]
    x[:, -3] = (again & inside).reshape(n, -1).sum(1) / each
    x[:, -2] = ((b >= 0x80) & inside).reshape(n, -1).sum(1) / each
    x[:, -1] = size / PASSAGE
    # The gap may have opened a row without any text.
    kept = size > 0
    kept[first] = True
    return x[kept], (np.cumsum(kept) - 1)[first]


def passage_slices(text: bytes, classes: np.ndarray, most: int) -> Iterator[np.ndarray]:
    """The rows of ``passages([text])``, for about ``most`` bytes of the text at a time.

    A passage's features look a few bytes back and ahead, so each slice is
    computed with a passage before and one behind it, whose rows are left out.
    """
    step = max(1, most // PASSAGE) * PASSAGE
    for s in range(0, max(1, len(text)), step):
        e = min(len(text), s + step)
        lead = min(s, PASSAGE)
        x, _ = passages([text[s - lead : e + PASSAGE]], classes)
        rows = max(1, -(-(e - s) // PASSAGE))
        yield x[lead // PASSAGE : lead // PASSAGE + rows]


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


@dataclass
class PassageModel:
    mean: np.ndarray
    scale: np.ndarray
    params: dict[str, np.ndarray]

    def encode(self, x: np.ndarray) -> tuple:
        """Scaled rows, their codes, both parts of the gate, and the attention before the softmax."""
        p = self.params
        x = (x - self.mean) / self.scale
        h = np.tanh(x @ p["encode"] + p["encode_bias"])
        t, g = np.tanh(h @ p["V"]), _sigmoid(h @ p["U"])
        return x, h, t, g, (t * g) @ p["w"]

    def score_long(self, slices: Iterator[np.ndarray]) -> tuple[float, int]:
        """(score, passage of most attention) of one document whose passages come in slices: a running softmax."""
        p, top, best, seen = self.params, -np.inf, 0, 0
        total, weighted = 0.0, np.zeros(len(p["out"]))
        for x in slices:
            _, h, _, _, raw = self.encode(x)
            at = int(raw.argmax())
            if raw[at] > top:
                shrink = float(np.exp(top - raw[at])) if total else 0.0
                total, weighted = total * shrink, weighted * shrink
                top, best = float(raw[at]), seen + at
            e = np.exp(raw - top)
            total, weighted = total + float(e.sum()), weighted + e @ h
            seen += len(x)
        return float(_sigmoid(weighted / total @ p["out"] + p["out_bias"]).item()), best

    def forward(self, x: np.ndarray, start: np.ndarray) -> tuple:
        """``x`` holds the passages of all documents in a row, ``start`` the first of each."""
        p = self.params
        of = np.repeat(np.arange(len(start)), np.diff(np.r_[start, len(x)]))
        x, h, t, g, raw = self.encode(x)
        e = np.exp(raw - np.maximum.reduceat(raw, start)[of])
        a = e / np.add.reduceat(e, start)[of]
        z = np.add.reduceat(h * a[:, None], start)
        return x, of, h, t, g, a, z, _sigmoid(z @ p["out"] + p["out_bias"])

    def gradients(self, x: np.ndarray, start: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
        p = self.params
        x, of, h, t, g, a, z, prob = self.forward(x, start)
        d = (prob - y) / len(y)
        dz = d[:, None] * p["out"][None]
        da = (h * dz[of]).sum(1)
        d_raw = a * (da - np.add.reduceat(a * da, start)[of])
        d_gate = d_raw[:, None] * p["w"][None]
        dt, dg = d_gate * g * (1 - t * t), d_gate * t * g * (1 - g)
        dh = (a[:, None] * dz[of] + dt @ p["V"].T + dg @ p["U"].T) * (1 - h * h)
        return {
            "out": z.T @ d, "out_bias": d.sum(keepdims=True), "w": (t * g).T @ d_raw, "V": h.T @ dt, "U": h.T @ dg,
            "encode": x.T @ dh, "encode_bias": dh.sum(0),
        }


def train(bags: list[np.ndarray], labels: np.ndarray, steps: int = 300, batch: int = 64, rate: float = 0.01, decay: float = 1e-3, seed: int = 6) -> PassageModel:
    """Adam on batches with as many documents of either label."""
    rng = np.random.default_rng(seed)
    every = np.concatenate(bags)
    normal = lambda *shape: rng.normal(0, shape[0] ** -0.5, shape).astype(np.float32)
    params = {
        "encode": normal(FEATURES, HIDDEN), "encode_bias": np.zeros(HIDDEN, np.float32), "V": normal(HIDDEN, ATTENTION),
        "U": normal(HIDDEN, ATTENTION), "w": normal(ATTENTION), "out": normal(HIDDEN), "out_bias": np.zeros(1, np.float32),
    }
    # The floor keeps features that hardly ever differ from being blown up.
    model = PassageModel(every.mean(0), np.maximum(every.std(0), 0.02), params)
    first = {k: np.zeros_like(v) for k, v in params.items()}
    second = {k: np.zeros_like(v) for k, v in params.items()}
    sides = [np.flatnonzero(labels == c) for c in (0, 1)]
    for step in range(1, steps + 1):
        pick = np.concatenate([rng.choice(side, batch // 2) for side in sides])
        start = np.cumsum([0, *(len(bags[i]) for i in pick[:-1])])
        for k, grad in model.gradients(np.concatenate([bags[i] for i in pick]), start, labels[pick]).items():
            grad = grad + decay * params[k]
            first[k] += 0.1 * (grad - first[k])
            second[k] += 0.001 * (grad * grad - second[k])
            params[k] -= (rate * (1 - step / (steps + 1)) * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)).astype(np.float32)
    return model


def learn(docs: DataFrame, labels: DataFrame, texts_per_label: int = 1500) -> PassageModel | None:
    """Train on ``docs`` (doc_id, text) that have a 0/1 ``label`` in ``labels`` (doc_id, label).

    The passage features of about ``texts_per_label`` texts of each label reach
    the driver, at most 32 evenly spaced passages of each. A document with
    several label rows counts as the lowest; null labels and null ids are no
    labels. None if there is no text of either label.
    """
    one = labels.where("doc_id is not null and label in (0, 1)").groupBy("doc_id").agg(F.min("label").alias("label"))
    picked = bounded_sample(one, "label", texts_per_label)
    rows = docs.join(F.broadcast(picked), "doc_id").where(F.col("text").isNotNull()).select("doc_id", "label", "text")

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classes = _byte_classes()
        for batch in batches:
            bags = []
            for text in batch.column(2).to_pylist():
                raw, bag, seen = text.encode("utf-8"), [], 0
                wanted = np.unique(np.linspace(0, max(1, -(-len(raw) // PASSAGE)) - 1, 32).astype(int))
                for x in passage_slices(raw, classes, LONG):
                    bag.append(x[wanted[(wanted >= seen) & (wanted < seen + len(x))] - seen])
                    seen += len(x)
                bags.append(np.concatenate(bag).astype(np.float16).tobytes())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(bags, pa.binary())], ["doc_id", "label", "bag"])

    typed = rows.select(F.col("doc_id").cast("long"), F.col("label").cast("int"), "text")
    got = sorted((r.doc_id, r.label, bytes(r.bag)) for r in typed.mapInArrow(encode, "doc_id long, label int, bag binary").toLocalIterator())
    if {label for _, label, _ in got} != {0, 1}:
        return None
    bags = [np.frombuffer(bag, np.float16).astype(np.float32).reshape(-1, FEATURES) for _, _, bag in got]
    return train(bags, np.array([label for _, label, _ in got], np.float32))


def batched(texts: list[bytes], most: int) -> Iterator[list[bytes]]:
    """The texts in lists of about ``most`` bytes; a longer text stands alone."""
    part, size = [], 0
    for text in texts:
        if part and size + len(text) > most:
            yield part
            part, size = [], 0
        part.append(text)
        size += len(text) + PASSAGE
    if part:
        yield part


def score_documents(docs: DataFrame, model: PassageModel | None, batch_bytes: int = 1 << 18) -> DataFrame:
    """Adds ``score``, and ``weightiest``: the byte offset of the passage with the most attention.

    Null and empty texts score 0 (there is nothing of quality in them); without
    a model every text does.
    """
    names = docs.columns
    schema = docs.withColumns({"score": F.lit(0.0), "weightiest": F.lit(0)}).schema
    text_at = names.index("text")

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classes = _byte_classes()
        for batch in (part for whole in batches for part in slices(whole, text_at)):
            texts = [(t or "").encode("utf-8") for t in batch.column(text_at).to_pylist()]
            values, offsets = [], []
            for part in batched(texts, batch_bytes):
                if model is None:
                    values += [0.0] * len(part)
                    offsets += [0] * len(part)
                    continue
                if len(part[0]) > batch_bytes:
                    value, best = model.score_long(passage_slices(part[0], classes, batch_bytes))
                    values.append(value)
                    offsets.append(best * PASSAGE)
                    continue
                x, start = passages(part, classes)
                _, of, _, _, _, a, _, prob = model.forward(x, start)
                top = np.lexsort((-np.arange(len(a)), a, of))[np.r_[start[1:], len(a)] - 1]
                values += [float(p) if t else 0.0 for t, p in zip(part, prob)]
                offsets += ((top - start) * PASSAGE).tolist()
            cols = [*batch.columns, pa.array(values, pa.float64()), pa.array(offsets, pa.int32())]
            yield pa.RecordBatch.from_arrays(cols, [*names, "score", "weightiest"])

    return docs.mapInArrow(score, schema)


def judge(docs: DataFrame, labels: DataFrame, held_out: Column, threshold: float = 0.5) -> DataFrame:
    """(doc_id, held_out, score, predicted, weightiest) of every document.

    Learns from the labels of rows that are not held out. Repeated rows are
    scored each; null and empty texts score 0; an empty table gives no rows;
    columns other than doc_id, text and the labels are not read.
    """
    picked = docs.select("doc_id", held_out.alias("held_out"), F.col("text").cast("string").alias("text"))
    seen = labels.join(picked.where("not held_out").select("doc_id").distinct(), "doc_id", "left_semi")
    model = learn(picked.where("not held_out"), seen)
    scored = score_documents(picked, model)
    return scored.select("doc_id", "held_out", "score", (F.col("score") >= threshold).cast("int").alias("predicted"), "weightiest")
