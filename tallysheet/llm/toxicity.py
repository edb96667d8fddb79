"""Toxicity: counterfactually regularised logistic classifier.

A document is described by which words, and which word beginnings of 4 to 6
letters, occur anywhere in its whole text (lower-cased, letters only).  The
model is a logistic regression with an L1 penalty, so few features get a weight.

Counterfactual term.  In every labelled sentence that names a group of people,
the identity term is swapped for another of its kind; the squared change of the
document's score (its logit) under the swap is penalised with weight
``cf_weight``.  What a neutral mention adds to the score is thereby driven to
what any other group's mention adds, and words such as "muslim" cannot carry
the label themselves.  The terms are an argument (English, German, French and Spanish ones by default); the model
says how many sentences had one (``swapped``): with none, the penalty has nothing to act on and the model is a plain
L1 logistic regression.

Training rows are a bounded sample: the ``MAX_PER_CLASS`` labelled documents of
each class whose hashed id is least; only these reach the driver.  Rows whose
``crc32(doc_id) mod 5`` is 0 are never among them.  Scoring is one pass over
all whole texts without a shuffle; the model sent to tasks has at most
``MAX_FEATURES`` weights.

Defined cases: null and empty texts score the model's base rate; a document
labelled more than once counts as toxic if any label says so; null labels and
labels of unknown documents are ignored; with no usable label, or one class
only, every score is that class's smoothed share (0 with no label at all).
Repeated rows each get the same result.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MAX_PER_CLASS = 2000
MAX_FEATURES = 4096
MIN_DOCS = 4
PREFIXES = (4, 5, 6)
#: The L1 weight is this times sqrt(log(features) / rows): small samples get stronger shrinkage.
L1_SCALE = 0.02
RELAXED = 0.1
CF_WEIGHT = 1.0

#: Identity terms by language and kind; a swap stays within its kind.  An argument of ``train`` replaces them.
IDENTITY_TERMS = {
    "en religion": "muslim christian jewish hindu buddhist atheist catholic protestant sikh",
    "en religion, plural": "muslims christians jews hindus buddhists atheists catholics protestants sikhs",
    "en gender": "woman man girl boy",
    "en gender, plural": "women men girls boys",
    "en orientation": "gay lesbian bisexual straight heterosexual homosexual transgender queer",
    "en origin": "african american asian european mexican arab chinese indian russian german french spanish",
    "en colour": "black white",
    "en ability": "deaf blind disabled autistic",
    "en age": "young old elderly teenage",
    "de religion": "muslimisch christlich jüdisch hinduistisch buddhistisch atheistisch katholisch evangelisch",
    "de religion, plural": "muslime christen juden hindus buddhisten atheisten katholiken protestanten",
    "de gender": "frau mann mädchen junge",
    "de gender, plural": "frauen männer",
    "de orientation": "schwul lesbisch bisexuell heterosexuell homosexuell transsexuell",
    "de origin": "türkisch deutsch russisch polnisch arabisch chinesisch afrikanisch französisch spanisch",
    "de colour": "schwarz weiß",
    "de ability": "taub blind behindert autistisch",
    "fr religion": "musulman chrétien juif hindou bouddhiste athée catholique protestant",
    "fr religion, plural": "musulmans chrétiens juifs hindous bouddhistes athées catholiques protestants",
    "fr gender": "femme homme fille garçon",
    "fr gender, plural": "femmes hommes filles garçons",
    "fr orientation": "gay lesbienne bisexuel hétérosexuel homosexuel transgenre",
    "fr origin": "africain américain asiatique européen arabe chinois russe allemand français espagnol",
    "fr colour": "noir blanc",
    "fr ability": "sourd aveugle handicapé autiste",
    "es religion": "musulmán cristiano judío hindú budista ateo católico protestante",
    "es religion, plural": "musulmanes cristianos judíos hindúes budistas ateos católicos protestantes",
    "es gender": "mujer hombre niña niño",
    "es gender, plural": "mujeres hombres niñas niños",
    "es orientation": "gay lesbiana bisexual heterosexual homosexual transgénero",
    "es origin": "africano americano asiático europeo árabe chino ruso alemán francés español",
    "es colour": "negro blanco",
    "es ability": "sordo ciego discapacitado autista",
}


def swaps(terms: Mapping[str, str]) -> dict[str, str]:
    """Each term -> the next one of its kind; a word of several kinds (``blind``) takes its first."""
    out: dict[str, str] = {}
    for kind in terms.values():
        words = kind.split()
        for i, word in enumerate(words):
            out.setdefault(word, words[(i + 1) % len(words)])
    return out


SWAP = swaps(IDENTITY_TERMS)

LETTERS = re.compile(r"[^\W\d_]+")
SENTENCE = re.compile(r"(?<=[.!?\n])\s*")


def held_out(doc_id: str | Column) -> Column:
    """Rows no model may learn from."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 5 == 0, F.lit(False))


def features(text: str | None) -> set[str]:
    words = set(LETTERS.findall((text or "").lower()))
    out = {"=" + w for w in words}
    for n in PREFIXES:
        out.update(w[:n] for w in words if len(w) > n)
    return out


def _hash(feature: str) -> int:
    return xxhash.xxh3_64_intdigest(feature.encode())


def hashed(names: set[str]) -> np.ndarray:
    return np.unique(np.fromiter(map(_hash, names), np.uint64, len(names)))


def counterfactual(text: str | None, swap: Mapping[str, str] = SWAP) -> tuple[str, int] | None:
    """The text with identity terms swapped, and the number of its sentences that have any; None if none has."""
    sentences = SENTENCE.split((text or "").lower())
    swapped = [LETTERS.sub(lambda m: swap.get(m[0], m[0]), s) for s in sentences]
    changed = sum(a != b for a, b in zip(sentences, swapped))
    return (" ".join(swapped), changed) if changed else None


class Model:
    """Weights by feature, and the bias; ``swapped`` sentences of the training texts had a counterfactual."""

    def __init__(self, weights: dict[str, float], bias: float, swapped: int = 0):
        self.weights, self.bias, self.swapped = weights, bias, swapped
        self.number = {k: i for i, k in enumerate(sorted(weights))}
        self.values = np.array([weights[k] for k in sorted(weights)] + [0.0])

    def numbers_of(self, word: str) -> list[int]:
        """The features that a word has: itself and its beginnings."""
        keys = ("=" + word, *(word[:n] for n in PREFIXES if len(word) > n))
        return [self.number[k] for k in keys if k in self.number]

    def logits(self, texts: Iterable[str | None]) -> np.ndarray:
        """Of many texts at once: every distinct word is looked up once, features count once a text."""
        known: dict[str, list[int]] = {}
        found, sizes = [], []
        for text in texts:
            n = len(found)
            for word in set(LETTERS.findall((text or "").lower())):
                numbers = known.get(word)
                if numbers is None:
                    numbers = known[word] = self.numbers_of(word)
                found += numbers
            sizes.append(len(found) - n)
        row = np.repeat(np.arange(len(sizes)), sizes)
        pairs = np.unique(row * len(self.values) + np.array(found, np.int64))
        return self.bias + np.bincount(pairs // len(self.values), self.values[pairs % len(self.values)], minlength=len(sizes))

    def scores(self, texts: Iterable[str | None]) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(texts), -40, 40)))

    def logit(self, text: str | None) -> float:
        return float(self.logits([text])[0])

    def score(self, text: str | None) -> float:
        return float(self.scores([text])[0])


class _Sparse:
    """Rows of feature numbers (value 1, or the given values) for products with a vector."""

    def __init__(self, rows: list[np.ndarray], width: int, values: list[np.ndarray] | None = None):
        self.row = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
        self.col = np.concatenate([*rows, np.empty(0, np.int64)]).astype(np.int64)
        self.val = np.ones(len(self.col)) if values is None else np.concatenate([*values, np.empty(0)])
        self.n, self.width = len(rows), width

    def dot(self, w):
        return np.bincount(self.row, self.val * w[self.col], minlength=self.n)[: self.n]

    def t_dot(self, v):
        return np.bincount(self.col, self.val * v[self.row], minlength=self.width)[: self.width]


def fit(texts: list[str | None], labels: list[int], class_size: dict[int, int] | None = None, l1_scale: float = L1_SCALE,
        cf_weight: float = CF_WEIGHT, steps: int = 400, terms: Mapping[str, str] = IDENTITY_TERMS) -> Model:
    """Proximal gradient descent on weighted log loss + ``cf_weight`` * mean squared logit change + L1.

    ``class_size`` gives the number of labelled documents of each class where
    the texts are a sample of them: it weights the classes back.
    """
    y = np.array(labels, dtype=float)
    if len(set(labels)) < 2:
        share = (y.sum() + 0.5) / (len(y) + 1) if len(y) else 1e-9
        return Model({}, float(np.log(share / (1 - share))))
    # Texts are held as sorted arrays of feature hashes; names are looked up for the chosen ones only.
    seen = [hashed(features(t)) for t in texts]
    swap = swaps(terms)
    found = [(i, s) for i, t in enumerate(texts) if (s := counterfactual(t, swap)) is not None]
    swapped = [(i, hashed(features(s))) for i, (s, _) in found]
    n0, n1 = float(len(y) - y.sum()), float(y.sum())
    known, which = np.unique(np.concatenate(seen), return_inverse=True)
    doc = np.repeat(np.arange(len(seen)), [len(s) for s in seen])
    in0, in1 = (np.bincount(which[y[doc] == c], minlength=len(known)) for c in (0, 1))
    p = (in0 + in1) / len(y)
    # z value of the difference of the two shares
    strength = np.abs(in1 / n1 - in0 / n0) / np.sqrt(np.maximum(p * (1 - p), 1e-9) * (1 / n0 + 1 / n1))
    identity = np.isin(known, hashed({"=" + t for t in swap}))
    strength[identity] = np.inf
    usable = np.flatnonzero(identity | (in0 + in1 >= MIN_DOCS))
    usable = usable[np.lexsort((known[usable], -strength[usable]))][:MAX_FEATURES]
    chosen = np.sort(known[usable])
    wanted, name_of = set(chosen.tolist()), {}
    for t in texts:
        if len(name_of) == len(chosen):
            break
        name_of.update((h, f) for f in features(t) if (h := _hash(f)) in wanted)
    names = [name_of[int(h)] for h in chosen]
    l1 = l1_scale * np.sqrt(np.log(len(names) + 2) / len(y))

    def numbers(hashes):
        at = np.searchsorted(chosen, hashes)
        at[at == len(chosen)] = 0
        return at[chosen[at] == hashes]

    x = _Sparse([numbers(s) for s in seen], len(names))
    delta = [(numbers(np.setdiff1d(seen[i], s)), numbers(np.setdiff1d(s, seen[i]))) for i, s in swapped]
    d = _Sparse([np.concatenate(r) for r in delta], len(names),
                [np.concatenate((np.ones(len(r[0])), -np.ones(len(r[1])))) for r in delta])
    size = class_size or {0: int(n0), 1: int(n1)}
    weight = np.where(y == 1, size[1] / n1, size[0] / n0)
    weight /= weight.sum()
    # Step size from the largest eigenvalue of the quadratic bound (power iteration).
    v, top = np.full(len(names), 1.0), 1.0
    for _ in range(30):
        u = 0.25 * x.t_dot(weight * x.dot(v)) + 2 * cf_weight / max(d.n, 1) * d.t_dot(d.dot(v))
        top = np.linalg.norm(u) or 1.0
        v = u / top
    step = 1 / (top + 0.25)
    w, b, free = np.zeros(len(names)), 0.0, np.ones(len(names), bool)
    # First the features are chosen, then the chosen ones are fitted with RELAXED of the penalty.
    for penalty in (l1, RELAXED * l1):
        z, bz, t = w, b, 1.0
        for _ in range(steps):
            g = weight * (1 / (1 + np.exp(-np.clip(x.dot(z) + bz, -40, 40))) - y)
            grad = x.t_dot(g) + 2 * cf_weight / max(d.n, 1) * d.t_dot(d.dot(z))
            new = z - step * grad
            new = np.where(free, np.sign(new) * np.maximum(np.abs(new) - step * penalty, 0), 0.0)
            new_b = bz - step * g.sum()
            t2 = (1 + np.sqrt(1 + 4 * t * t)) / 2
            z, bz = new + (t - 1) / t2 * (new - w), new_b + (t - 1) / t2 * (new_b - b)
            w, b, t = new, new_b, t2
        free = w != 0
    return Model({f: float(w[i]) for i, f in enumerate(names) if w[i]}, float(b), sum(n for _, (_, n) in found))


def train(documents: DataFrame, labels: DataFrame, max_per_class: int = MAX_PER_CLASS,
          cf_weight: float = CF_WEIGHT, terms: Mapping[str, str] = IDENTITY_TERMS) -> Model:
    known = (labels.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out("doc_id"))
             .groupBy("doc_id").agg(F.max("toxic").alias("toxic")))
    sizes = {r["toxic"]: r["n"] for r in known.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    order = F.xxhash64("doc_id")
    picked = [known.where(F.col("toxic") == c).orderBy(order, "doc_id").limit(max_per_class) for c in (0, 1)]
    ids = picked[0].union(picked[1])  # 2 * max_per_class rows at most
    rows = (documents.select("doc_id", "text").join(F.broadcast(ids), "doc_id")
            .groupBy("doc_id", "toxic").agg(F.max("text").alias("text")).collect())
    rows.sort(key=lambda r: r["doc_id"])
    return fit([r["text"] for r in rows], [r["toxic"] for r in rows], sizes if len(sizes) == 2 else None,
               cf_weight=cf_weight, terms=terms)


def score(documents: DataFrame, model: Model, name: str = "score") -> DataFrame:
    """``documents`` with the column ``name``: the probability of label 1."""

    @F.pandas_udf("double")
    def scored(texts: pd.Series) -> pd.Series:
        return pd.Series(model.scores(texts))

    return documents.withColumn(name, scored(F.coalesce("text", F.lit(""))))


def clean_documents(documents: DataFrame, labels: DataFrame, threshold: float = 0.5) -> DataFrame:
    """``documents`` without those that score ``threshold`` or more; columns unchanged."""
    name = "__toxicity"  # dropped again; documents with a column of this name keep it out of the way
    while name in documents.columns:
        name += "_"
    return score(documents, train(documents, labels), name).where(F.col(name) < threshold).drop(name)
