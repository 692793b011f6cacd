"""Document toxicity by multiple-instance learning over sentences.

Only documents have labels. A sentence's probability is a logistic model of
its words and their beginnings; a document is toxic if any of its sentences is, so its probability
is the noisy-or ``1 - prod(1 - p)`` of theirs. The word weights are trained
through the noisy-or from document labels, and the trained sentence model then
locates the offending sentences.

Training runs in numpy on a bounded sample of labelled texts and a bounded
vocabulary; scoring reads all sentences of all texts.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from costlens.llm.common import bounded_sample, slices

SENTENCE = re.compile(r"[^.!?\n]+")
WORD = re.compile(r"\w+")


#: Beginnings of a word that are features besides the word itself.
PREFIXES = (4, 5, 6)
MEMO_WORDS = 50_000


def features(word: str) -> list[str]:
    """The word and its beginnings (marked by a hyphen, which no word holds)."""
    return [word, *(f"{word[:n]}-" for n in PREFIXES if len(word) >= n)]


def softplus(z: np.ndarray) -> np.ndarray:
    return np.logaddexp(0.0, z)


@dataclass
class SentenceModel:
    weights: dict[str, float]
    bias: float
    memo: dict[str, float] = field(default_factory=dict)

    def weight(self, word: str) -> float:
        """The sum of the weights of the word's features."""
        value = self.memo.get(word)
        if value is None:
            if len(self.memo) >= MEMO_WORDS:
                self.memo.clear()
            value = self.memo[word] = sum(self.weights.get(f, 0.0) for f in features(word))
        return value

    def sentences(self, text: str) -> list[tuple[int, int, float]]:
        """(start, length, logit) of the sentences that hold a known feature, in text order."""
        found = []
        for m in SENTENCE.finditer(text):
            total = sum(map(self.weight, WORD.findall(m[0].lower())))
            if total:
                found.append((m.start(), m.end() - m.start(), self.bias + total))
        return found

    def score(self, text: str) -> tuple[float, list[tuple[int, int, float]]]:
        """Noisy-or over all sentences, and the sentences that hold a known feature."""
        found = self.sentences(text)
        logits = np.array([z for _, _, z in found])
        spare = sum(1 for _ in SENTENCE.finditer(text)) - len(found)
        total = softplus(logits).sum() + spare * softplus(np.array(self.bias))
        return float(-np.expm1(-total)), found


def train(
    texts: list[str], labels: list[int], max_words: int = 600, steps: int = 300, rate: float = 0.1, decay: float = 1e-6, clean_weight: float = 6.0
) -> SentenceModel:
    """Adam on the noisy-or cross-entropy.

    Clean documents together weigh ``clean_weight`` times the toxic ones: long
    clean texts have many sentences, each of which must stay near 0.

    The vocabulary is the ``max_words`` features whose document frequencies differ
    most between the classes, in standard deviations.
    """
    y = np.array(labels, float)
    with_word: tuple[Counter, Counter] = (Counter(), Counter())
    for text, label in zip(texts, labels):
        with_word[label].update({f for w in set(WORD.findall(text.lower())) for f in features(w)})
    n = [max(1, int((y == c).sum())) for c in (0, 1)]

    def gap(word: str) -> float:
        share = [with_word[c][word] / n[c] for c in (0, 1)]
        pooled = (with_word[0][word] + with_word[1][word] + 1) / sum(n)
        return abs(share[1] - share[0]) / (pooled * (1 / n[0] + 1 / n[1])) ** 0.5

    seen = [w for w in {*with_word[0], *with_word[1]} if with_word[0][w] + with_word[1][w] >= 3]
    words = sorted(seen, key=lambda w: (-gap(w), w))[:max_words]
    index = {w: i for i, w in enumerate(words)}

    doc_of, sentence_of, word_of = [], [], []
    for d, text in enumerate(texts):
        for m in SENTENCE.finditer(text):
            for w in WORD.findall(m[0].lower()):
                known = [i for f in features(w) if (i := index.get(f)) is not None]
                sentence_of += [len(doc_of)] * len(known)
                word_of += known
            doc_of.append(d)
    doc, sentence, word = (np.array(x, np.int64) for x in (doc_of, sentence_of, word_of))
    weight = np.where(y == 1, 1 / n[1], clean_weight / n[0])

    params = np.zeros(len(words) + 1)
    params[-1] = -10.0
    first, second = np.zeros_like(params), np.zeros_like(params)
    for step in range(1, steps + 1):
        z = np.bincount(sentence, params[:-1][word], len(doc)) + params[-1]
        total = np.bincount(doc, softplus(z), len(y)) + 1e-9
        # -log p of a document: total for label 0, -log(1 - exp(-total)) for label 1.
        slope = weight * ((1 - y) - y / np.expm1(np.minimum(total, 700.0)))
        dz = slope[doc] / (1 + np.exp(-z))
        grad = np.r_[np.bincount(word, dz[sentence], len(words)) + decay * params[:-1], dz.sum()]
        first += 0.1 * (grad - first)
        second += 0.001 * (grad * grad - second)
        params -= rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
    return SentenceModel(dict(zip(words, params[:-1].tolist())), float(params[-1]))


def learn(docs: DataFrame, labels: DataFrame, texts_per_label: int = 2000) -> SentenceModel | None:
    """Train on ``docs`` (doc_id, text) that have a 0/1 ``label`` in ``labels`` (doc_id, label).

    About ``texts_per_label`` texts of each label reach the driver. A document
    with several label rows counts as toxic if any says so; null labels and
    null ids are no labels. None if there is no text of either label.
    """
    one = labels.where("doc_id is not null and label in (0, 1)").groupBy("doc_id").agg(F.max("label").alias("label"))
    picked = bounded_sample(one, "label", texts_per_label)
    rows = docs.join(F.broadcast(picked), "doc_id").where(F.col("text").isNotNull()).select("doc_id", "label", "text")
    got = sorted((r.doc_id, r.label, r.text) for r in rows.collect())
    if {label for _, label, _ in got} != {0, 1}:
        return None
    return train([t for _, _, t in got], [int(label) for _, label, _ in got])


def score_documents(docs: DataFrame, model: SentenceModel | None, sentence_threshold: float = 0.3) -> DataFrame:
    """Adds ``score`` and ``offending`` (start, length and score of each sentence at or above the threshold).

    Null and empty texts score 0; so does every text without a model.
    """
    spans = "array<struct<start:int,length:int,score:double>>"
    names = docs.columns
    schema = docs.withColumns({"score": F.lit(0.0), "offending": F.array().cast(spans)}).schema
    text_at = names.index("text")
    kind = pa.list_(pa.struct([("start", pa.int32()), ("length", pa.int32()), ("score", pa.float64())]))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in slices(whole, text_at)):
            values, spans = [], []
            for text in batch.column(text_at).to_pylist():
                value, found = model.score(text) if model and text else (0.0, [])
                values.append(value)
                probs = [(s, n, 1 / (1 + np.exp(-z))) for s, n, z in found]
                spans.append([{"start": s, "length": n, "score": float(p)} for s, n, p in probs if p >= sentence_threshold])
            cols = [*batch.columns, pa.array(values, pa.float64()), pa.array(spans, kind)]
            yield pa.RecordBatch.from_arrays(cols, [*names, "score", "offending"])

    return docs.mapInArrow(score, schema)


def judge(docs: DataFrame, labels: DataFrame, held_out: Column, threshold: float = 0.3) -> DataFrame:
    """(doc_id, held_out, score, predicted, offending) of every document.

    Learns from the labels of rows that are not held out. Repeated rows are
    scored each; null text scores 0; an empty table gives no rows; columns
    other than doc_id, text and the labels are not read.
    """
    picked = docs.select("doc_id", held_out.alias("held_out"), F.col("text").cast("string").alias("text"))
    seen = labels.join(picked.where("not held_out").select("doc_id").distinct(), "doc_id", "left_semi")
    model = learn(picked.where("not held_out"), seen)
    scored = score_documents(picked, model)
    return scored.select("doc_id", "held_out", "score", (F.col("score") >= threshold).cast("int").alias("predicted"), "offending")
