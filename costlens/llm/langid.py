"""Language identification by a byte convolutional network.

A text is cut into windows of ``WINDOW`` bytes (the last one is padded).
Filters of several widths slide over the byte embeddings of a window, each
keeps its largest response (max pooling), and a softmax layer turns the
responses into language probabilities. A document's probabilities are the
softmax of the mean of its windows' log-probabilities.

The network is trained in numpy with Adam on the windows of a bounded sample
of labelled texts, then travels with the tasks that score all windows of all
texts. A filter over embeddings is a sum of one table look-up per offset, so
the convolution of a batch of windows is a few gathers.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from costlens.llm.common import bounded_sample, slices

WINDOW = 256
WIDTHS = (2, 3, 4)
FILTERS = 16
EMBEDDING = 8
UNKNOWN = "und"


def windows_of(raw: bytes, width: int = WINDOW) -> np.ndarray:
    """The whole text as rows of ``width`` bytes, the last one padded with zeros."""
    n = max(1, -(-len(raw) // width))
    return np.frombuffer(raw.ljust(n * width, b"\0"), np.uint8).reshape(n, width)


@dataclass
class ByteCnn:
    languages: list[str]
    params: dict[str, np.ndarray]

    @classmethod
    def initial(cls, languages: list[str], seed: int) -> "ByteCnn":
        rng = np.random.default_rng(seed)
        params = {"embed": rng.normal(0, 0.5, (256, EMBEDDING))}
        for w in WIDTHS:
            params[f"filter{w}"] = rng.normal(0, (w * EMBEDDING) ** -0.5, (w, EMBEDDING, FILTERS))
        params["bias"] = np.zeros(len(WIDTHS) * FILTERS)
        params["out"] = rng.normal(0, 0.1, (len(WIDTHS) * FILTERS, len(languages)))
        params["out_bias"] = np.zeros(len(languages))
        return cls(languages, {k: v.astype(np.float32) for k, v in params.items()})

    def tables(self) -> list[np.ndarray]:
        """Per width: the response of each byte at each offset, (width, 256, filters)."""
        return [np.einsum("be,wef->wbf", self.params["embed"], self.params[f"filter{w}"]) for w in WIDTHS]

    def pooled(self, windows: np.ndarray, tables: list[np.ndarray], where: bool = False):
        """Largest response of each filter (n, widths * filters), and its position if asked."""
        best, at = [], []
        for w, table in zip(WIDTHS, tables):
            n_at = windows.shape[1] - w + 1
            response = table[0][windows[:, :n_at]]
            for j in range(1, w):
                response += table[j][windows[:, j : j + n_at]]
            if where:
                top = response.argmax(1)
                at.append(top)
                best.append(np.take_along_axis(response, top[:, None], 1)[:, 0])
            else:
                best.append(response.max(1))
        pooled = np.concatenate(best, 1) + self.params["bias"]
        return (pooled, at) if where else pooled

    def log_probabilities(self, pooled: np.ndarray) -> np.ndarray:
        logits = np.maximum(pooled, 0) @ self.params["out"] + self.params["out_bias"]
        logits -= logits.max(1, keepdims=True)
        return logits - np.log(np.exp(logits).sum(1, keepdims=True))

    def gradients(self, windows: np.ndarray, target: np.ndarray) -> dict[str, np.ndarray]:
        """Gradients of the mean cross-entropy; only pooled positions carry any."""
        pooled, at = self.pooled(windows, self.tables(), where=True)
        hidden = np.maximum(pooled, 0)
        d_logits = np.exp(self.log_probabilities(pooled))
        d_logits[np.arange(len(target)), target] -= 1
        d_logits /= len(target)
        d_pooled = (d_logits @ self.params["out"].T) * (pooled > 0)
        grad = {"out": hidden.T @ d_logits, "out_bias": d_logits.sum(0), "bias": d_pooled.sum(0), "embed": np.zeros_like(self.params["embed"])}
        rows = np.arange(len(windows))[:, None]
        for k, w in enumerate(WIDTHS):
            d = d_pooled[:, k * FILTERS : (k + 1) * FILTERS]
            filters = self.params[f"filter{w}"]
            grad[f"filter{w}"] = np.empty_like(filters)
            for j in range(w):
                seen = windows[rows, at[k] + j]  # (n, filters)
                grad[f"filter{w}"][j] = np.einsum("nfe,nf->ef", self.params["embed"][seen], d)
                np.add.at(grad["embed"], seen, d[:, :, None] * filters[j].T[None])
        return grad


def train(windows: np.ndarray, languages: list[str], steps: int = 600, batch: int = 128, rate: float = 0.01, seed: int = 8) -> ByteCnn:
    """Adam on random batches; ``languages`` has one label per window."""
    names = sorted(set(languages))
    target = np.searchsorted(names, languages)
    model, rng = ByteCnn.initial(names, seed), np.random.default_rng(seed)
    first = {k: np.zeros_like(v) for k, v in model.params.items()}
    second = {k: np.zeros_like(v) for k, v in model.params.items()}
    by_class = [np.flatnonzero(target == c) for c in range(len(names))]
    for step in range(1, steps + 1):
        at = np.concatenate([rng.choice(rows, -(-batch // len(names))) for rows in by_class])
        pace = rate * (1 - step / (steps + 1))
        for k, g in model.gradients(windows[at], target[at]).items():
            first[k] += 0.1 * (g - first[k])
            second[k] += 0.001 * (g * g - second[k])
            model.params[k] -= pace * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
    return model


def learn(labelled: DataFrame, texts_per_language: int = 1500, windows_per_text: int = 3) -> ByteCnn | None:
    """Train on (doc_id, text, lang) rows; None without any labelled text that has letters.

    The sample is at most ``texts_per_language`` texts of each label value and
    ``windows_per_text`` evenly spaced windows of each: the only rows that
    reach the driver.
    """
    rows = labelled.where(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs, cuts = [], []
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                all_of = windows_of(text.encode("utf-8"))
                for i in sorted({int(x) for x in np.linspace(0, len(all_of) - 1, windows_per_text)}):
                    langs.append(lang)
                    cuts.append(all_of[i].tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(langs, pa.string()), pa.array(cuts, pa.binary())], ["lang", "bytes"])

    sample = bounded_sample(rows, "lang", texts_per_language).select("lang", "text")
    got = sorted((r.lang, bytes(r.bytes)) for r in sample.mapInArrow(cut, "lang string, bytes binary").toLocalIterator())
    if not got:
        return None
    return train(np.frombuffer(b"".join(b for _, b in got), np.uint8).reshape(len(got), WINDOW), [lang for lang, _ in got])


def classify(docs: DataFrame, model: ByteCnn | None, batch_windows: int = 256) -> DataFrame:
    """Adds ``lang_pred`` and ``score`` to ``docs`` (which has a text column).

    Null text, and text without letters, is ``und`` with score 0; so is every
    text if there is no model. All windows of a text count.
    """
    names = docs.columns
    schema = docs.withColumns({"lang_pred": F.lit(""), "score": F.lit(0.0)}).schema
    text_at = names.index("text")

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = model.tables() if model else []
        for batch in (part for whole in batches for part in slices(whole, text_at)):
            texts = batch.column(text_at).to_pylist()
            known = [i for i, t in enumerate(texts) if model and t and any(map(str.isalpha, t))]
            total = np.zeros((len(texts), len(model.languages) if model else 1))
            count = np.zeros(len(texts))
            waiting, owners = [], []

            def flush() -> None:
                windows, owner = np.concatenate(waiting), np.concatenate(owners)
                for i in range(0, len(windows), batch_windows):
                    part = model.log_probabilities(model.pooled(windows[i : i + batch_windows], tables))
                    np.add.at(total, owner[i : i + batch_windows], part)
                np.add.at(count, owner, 1)
                waiting.clear()
                owners.clear()

            for i in known:
                waiting.append(windows_of(texts[i].encode("utf-8")))
                owners.append(np.full(len(waiting[-1]), i))
                if sum(map(len, waiting)) >= batch_windows:
                    flush()
            if waiting:
                flush()
            mean = total / np.maximum(count, 1)[:, None]
            share = np.exp(mean - mean.max(1, keepdims=True))
            share /= share.sum(1, keepdims=True)
            pred = np.full(len(texts), UNKNOWN, object)
            value = np.zeros(len(texts))
            if known:
                best = share[known].argmax(1)
                pred[known], value[known] = np.array(model.languages, object)[best], share[known, best]
            cols = [*batch.columns, pa.array(pred.tolist(), pa.string()), pa.array(value)]
            yield pa.RecordBatch.from_arrays(cols, [*names, "lang_pred", "score"])

    return docs.mapInArrow(score, schema)


def identify(docs: DataFrame, held_out: Column) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) of every document.

    Learns from the text and non-null lang of rows that are not held out.
    Repeated rows are scored each; an empty table gives no rows; other columns
    are not read.
    """
    model = learn(docs.where(~held_out).select("doc_id", F.col("text").cast("string").alias("text"), "lang"))
    picked = docs.select("doc_id", held_out.alias("held_out"), F.col("text").cast("string").alias("text"))
    return classify(picked, model).drop("text")
