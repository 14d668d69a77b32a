"""Toxicity by a classifier chain of linear models.

The categories are predicted in order: the model of a category sees a
document's words and the probabilities of all earlier categories. A later model
is trained on out-of-fold probabilities, as they are at prediction time;
the folds follow the near-copies, so none sit on both sides.

Training uses a bounded sample of the labelled documents (``MAX_TRAIN`` ids,
those with the smallest hashes). Word statistics and the choice of the
``FEATURES`` words of every category are Spark aggregates over that sample; what reaches the
driver is at most ``MAX_TRAIN`` short lists of feature numbers, equal ones
counted, and the fit holds a block of them dense at a time. A word's value
is 1 if it occurs anywhere in the whole text. Stems are chosen like words: a
stem's value is 1 if two or more different words of the text begin with it, so
words that vary behind a common beginning are learned together. Near-copies
(linked SimHash fingerprints) with equal labels count as one document, so the
wording of one group of copies isn't learned, while a word of a rare language is.
Prediction reads every whole text once, in the tasks, and shuffles nothing.

The lexicon are the words and stems that mark the last category by themselves,
whatever the language; the earlier categories may be defined by it.

Defined results: a null text has no words. Without labelled rows every
probability is 0. A label that is null trains nothing, nor does one whose
document is absent, and neither takes a place in the sample; a document
labelled twice counts as positive if one label is, and an id with several texts
trains with one of them. Repeated rows and null ids are predicted like any
other; an empty table gives an empty result. Other columns are not carried along.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from citystream.llm import simhash
from citystream.llm.common import cut, map_rows
from citystream.session import prepare

MAX_TRAIN, FEATURES, FOLDS, RIDGE = 20_000, 256, 5, 0.1
#: Rows held dense by the fit; share of a lexicon word's documents that must be positive.
BLOCK, PURE = 1024, 0.9
#: A word must occur in so many of a category's documents, and deviate by so many standard errors.
LEAST, DEVIATION = 3, 5.0
#: Letters of a stem; words and bits by which near-copies are told.
STEM, SHINGLE, MAX_BITS = range(3, 9), 3, 3
#: Least precision that a threshold must have on the out-of-fold predictions, and the positives by
#: which its F1 may fall behind the best.
PRECISION, SLACK = 0.95, 2

_WORD = re.compile(r"[^\W\d_]+")


def words(text: str | None) -> set[str]:
    return set(_WORD.findall(text.lower())) if text else set()


def stems(found: Iterable[str], heads: frozenset[str] | None = None) -> set[str]:
    """The beginnings that two or more of the different words ``found`` share,
    marked by a star; of the words that begin with one of ``heads``, if given."""
    once, again = set(), set()
    for w in found:
        if heads is None or w[:STEM[0]] in heads:
            for k in STEM:
                if k > len(w):
                    break
                (again if w[:k] in once else once).add(w[:k])
    return {p + "*" for p in again}


@dataclass
class Chain:
    """``weights[j]``: intercept, words and stems, earlier categories of category j."""

    categories: list[str]
    vocabulary: dict[str, int]
    weights: list[np.ndarray]
    #: Of the last category, by its out-of-fold predictions.
    threshold: float = 0.5

    def predict(self, texts: list[str | None]) -> np.ndarray:
        """A row per text, a probability per category."""
        out = np.zeros((len(texts), len(self.categories)))
        known = self.vocabulary
        heads = frozenset(w[:STEM[0]] for w in known if w.endswith("*"))
        row, feature = [], []
        for i, text in enumerate(texts):
            own = words(text)
            found = [known[w] for w in (own | stems(own, heads)) & known.keys()]
            row += [i] * len(found)
            feature += found
        row, feature = np.array(row, np.int64), np.array(feature, np.int64)
        for j, w in enumerate(self.weights):
            z = w[0] + np.bincount(row, w[1 + feature], len(texts)) + out[:, :j] @ w[1 + len(known):]
            out[:, j] = sigmoid(z)
        return out


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(z / 2))


@dataclass
class Design:
    """Training rows: feature numbers of row i are ``features[starts[i]:starts[i + 1]]``;
    ``more`` holds the earlier categories' probabilities, ``times`` how many equal documents a row stands for."""

    starts: np.ndarray
    features: np.ndarray
    width: int
    times: np.ndarray
    more: np.ndarray

    def blocks(self, chosen: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(row numbers, dense rows with the constant first) of ``BLOCK`` chosen rows at a time."""
        for at in range(0, len(chosen), BLOCK):
            rows = chosen[at:at + BLOCK]
            n = self.starts[rows + 1] - self.starts[rows]
            own = np.repeat(np.arange(len(rows)), n)
            place = np.arange(len(own)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(self.starts[rows], n)
            x = np.zeros((len(rows), 1 + self.width + self.more.shape[1]), np.float32)
            x[:, 0] = 1
            x[own, 1 + self.features[place]] = 1
            x[:, 1 + self.width:] = self.more[rows]
            yield rows, x

    def predict(self, chosen: np.ndarray, w: np.ndarray) -> np.ndarray:
        return np.concatenate([sigmoid(x @ w) for _, x in self.blocks(chosen)] or [np.zeros(0)])

    def fit(self, chosen: np.ndarray, y: np.ndarray, start: np.ndarray | None = None) -> np.ndarray:
        """Ridge logistic regression of ``y`` over the chosen rows by Newton
        steps from ``start``; column 0 is the unpenalized constant."""
        size = 1 + self.width + self.more.shape[1]
        w = np.zeros(size) if start is None else start.copy()
        ridge = np.full(size, RIDGE)
        ridge[0] = 1e-3
        for _ in range(25):
            gram, slope = np.diag(ridge), -ridge * w
            for rows, x in self.blocks(chosen):
                p = sigmoid(x @ w)
                gram += (x * (self.times[rows] * p * (1 - p)).astype(np.float32)[:, None]).T @ x
                slope += (self.times[rows] * (y[rows] - p)) @ x
            step = np.linalg.solve(gram, slope)
            w += step
            if np.abs(step).max() < 1e-4:
                break
        return w


def best_threshold(p: np.ndarray, y: np.ndarray, times: np.ndarray | None = None) -> float:
    """Of all cuts of ``p`` with a precision of at least ``PRECISION``, the
    highest whose F1 is the best but for what ``SLACK`` positives change (1 % at most):
    half-way to the next lower value. 0.5 if there is none, as without
    positives or without a word that tells them apart."""
    if not len(p):
        return 0.5
    order = np.argsort(-p, kind="stable")
    times = np.ones(len(p)) if times is None else times[order]
    p, hits, said = p[order], np.cumsum(y[order] * times), np.cumsum(times)
    f1 = 2 * hits / (said + hits[-1])
    f1[hits < PRECISION * said] = 0
    f1[:-1][p[:-1] == p[1:]] = 0  # equal values can't be told apart
    best = int((f1 >= f1.max() * (1 - min(0.01, SLACK / max(hits[-1], SLACK)))).argmax())
    if not f1[best]:
        return 0.5
    return float(p[best] + (p[best + 1] if best + 1 < len(p) else 0.0)) / 2


def fit_chain(design: Design, labels: np.ndarray, folds: np.ndarray) -> tuple[list[np.ndarray], float]:
    """Weights of every category in turn, and the last one's threshold.
    ``labels`` holds a column per category; -1 is no label and trains nothing."""
    weights, every = [], np.arange(len(folds))
    for j in range(labels.shape[1]):
        y, ahead = labels[:, j], np.zeros(len(folds))
        marked = y >= 0
        whole = design.fit(every[marked], y)
        for f in np.unique(folds):
            # The fold's own fit begins near its end, at the weights of all rows.
            ahead[folds == f] = design.predict(every[folds == f], design.fit(every[marked & (folds != f)], y, whole))
        weights.append(whole)
        design.more = np.column_stack([design.more, ahead.astype(np.float32)])
    return weights, best_threshold(ahead[marked], y[marked], design.times[marked])


def near_copies(prints: DataFrame, max_bits: int) -> DataFrame:
    """(fp, root) of at most ``MAX_TRAIN`` different fingerprints: the smallest
    one reachable over links of ``max_bits`` or fewer differing bits. One task
    searches the sample: every fingerprint is compared once with all not yet reached."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        left = np.concatenate([np.zeros(0, np.int64), *(b.column(0).to_numpy() for b in batches)])
        left.sort()
        found: list[np.ndarray] = []
        while len(left):
            root, left = left[0], left[1:]
            queue, group = [root], [root]
            while queue and len(left):
                near = np.bitwise_count((left ^ queue.pop()).view(np.uint64)) <= max_bits
                if near.any():
                    queue += left[near].tolist()
                    group += left[near].tolist()
                    left = left[~near]
            found.append(np.column_stack([group, np.full(len(group), root)]))
        made = np.concatenate([np.zeros((0, 2), np.int64), *found])
        yield pa.RecordBatch.from_arrays([pa.array(made[:, 0]), pa.array(made[:, 1])], names=["fp", "root"])

    return prints.select("fp").coalesce(1).mapInArrow(work, "fp long, root long")


def deviating(rows: DataFrame, y: str) -> DataFrame:
    """(word, n, hits, z): of the words that occur among the positives, their
    count there against what their count leads to expect, in standard errors."""
    total, positive = rows.where(F.col(y).isNotNull()).agg(F.count("*"), F.coalesce(F.sum(y), F.lit(0))).first()
    if not positive:
        return rows.select(F.lit("").alias("word"), F.lit(0).alias("n"), F.lit(0).alias("hits"), F.lit(0.0).alias("z")).limit(0)
    share = positive / total
    z = (F.col("hits") - F.col("n") * share) / F.sqrt(F.col("n") * share * (1 - share) + 1)
    return (rows.where(F.col(y).isNotNull()).select(F.explode("words").alias("word"), F.col(y).alias("y")).groupBy("word")
            .agg(F.count("*").alias("n"), F.sum("y").alias("hits")).where(F.col("hits") >= LEAST).withColumn("z", z))


def train(docs: DataFrame, labels: DataFrame, categories: dict[str, Column], id_col: str = "doc_id",
          text_col: str = "text", max_train: int = MAX_TRAIN) -> Chain:
    """A chain over ``categories``: names, in order, with boolean Columns over
    the labels' columns, the text's distinct ``words`` and those of them in the
    ``lexicon`` of the last category (which itself is defined by the labels' columns alone)."""
    prepare(docs.sparkSession)
    names = list(categories)
    label_cols = [c for c in labels.columns if c != id_col]
    there = docs.select(docs[id_col].alias("_key")).where("_key IS NOT NULL")
    sample = (labels.select(F.col(id_col).alias("_key"), *label_cols).groupBy("_key")
              .agg(*(F.max(c).alias(c) for c in label_cols)).where(F.coalesce(*label_cols).isNotNull())
              .join(there, "_key", "left_semi").orderBy(F.xxhash64("_key"), "_key").limit(max_train))
    # At most max_train narrow rows.
    texts = (docs.select(docs[id_col].alias("_key"), docs[text_col].alias("_text"))
             .join(F.broadcast(sample), "_key").where("_text IS NOT NULL"))
    texts = map_rows(texts, ["_key", *label_cols], "_text", lambda: lambda ts: {
        "words": [sorted(words(t)) for t in ts],
        "fp": np.array([simhash.fingerprint(t, SHINGLE) for t in ts], np.uint64).view(np.int64)}, "words array<string>, fp long")
    rows = cut(texts.groupBy("_key", *label_cols).agg(F.min_by(F.struct("fp", "words"), F.struct("fp", F.xxhash64("words"))).alias("one"))
               .select("one.*", *label_cols))
    # At most max_train narrow rows.
    roots = F.broadcast(near_copies(rows.select("fp").distinct(), MAX_BITS))
    rows = (rows.join(roots, "fp").groupBy("root", *label_cols).agg(F.min_by("words", F.struct("fp", F.xxhash64("words"))).alias("words"))
            .select("words", F.pmod(F.xxhash64("root"), F.lit(FOLDS)).cast("int").alias("fold"), *label_cols,
                    categories[names[-1]].cast("int").alias("_last")))
    rows = cut(map_rows(rows, ["fold", *label_cols, "_last"], "words", lambda: lambda ws: {
        "words": [[*w, *sorted(stems(w))] for w in ws]}, "words array<string>"))
    if rows.isEmpty():
        return Chain(names, {}, [])
    def marks(of: DataFrame, y: str) -> list:
        return deviating(of, y).where(F.abs("z") >= DEVIATION).orderBy(F.desc(F.abs("z")), "word").limit(FEATURES).collect()

    last = marks(rows, "_last")
    lexicon = sorted(r.word for r in last if r.z > 0 and r.hits >= PURE * r.n)
    ys = [f"y{j}" for j in range(len(names))]
    listed = F.array(*map(F.lit, lexicon)) if lexicon else F.array().cast("array<string>")
    labelled = (rows.withColumn("lexicon", F.array_intersect("words", listed))
                .select("words", "fold", *(c.cast("int").alias(y) for y, c in zip(ys, categories.values()))))
    chosen = {r.word for r in last}.union(*({r.word for r in marks(labelled, y)} for y in ys[:-1]))
    vocabulary = {w: i for i, w in enumerate(sorted(chosen))}
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)
    marked = labelled.fillna(-1, ys)
    found = map_rows(marked, ["fold", *ys], "words", lambda: lambda ws: {
        "features": [sorted(shared.value[w] for w in set(own) & shared.value.keys()) for own in ws]}, "features array<int>")
    # A fixed order of rows, so that the sums don't depend on the tasks'.
    table = found.groupBy("features", "fold", *ys).agg(F.count("*").alias("times")).orderBy("features", "fold", *ys).toArrow()
    lists = table.column("features").combine_chunks()
    design = Design(lists.offsets.to_numpy().astype(np.int64), lists.flatten().to_numpy(), len(vocabulary),
                    table.column("times").to_numpy().astype(float), np.zeros((len(lists), 0), np.float32))
    y = np.column_stack([table.column(c).to_numpy() for c in ys]).astype(float)
    return Chain(names, vocabulary, *fit_chain(design, y, table.column("fold").to_numpy()))


def predict(docs: DataFrame, chain: Chain, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, p_<category>...) for every row of ``docs``."""
    # Plain values: broadcasts are unpickled by reference, which a class would need the package for.
    shared = prepare(docs.sparkSession).sparkContext.broadcast((chain.categories, chain.vocabulary, chain.weights))
    names = [f"p_{c}" for c in chain.categories]

    def make():
        own = Chain(*shared.value)

        def rows(texts: list[str | None]) -> dict:
            p = own.predict(texts)
            return {n: p[:, j] for j, n in enumerate(names)}

        return rows

    return map_rows(docs, [id_col], text_col, make, ", ".join(f"{n} double" for n in names))


def document_chain() -> dict[str, Column]:
    """The labels mark toxicity as a whole. The earlier categories are its
    documents that hold a word of the learned lexicon, in whatever language,
    and those that hold two or more."""
    toxic = F.col("toxic") > 0
    return {"explicit": toxic & (F.size("lexicon") > 0), "repeated": toxic & (F.size("lexicon") > 1), "toxic": toxic}


def judge(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, p_explicit, p_repeated, p_toxic, toxic): ``toxic`` where the
    last probability reaches the chain's threshold."""
    chain = train(docs, labels.select("doc_id", "toxic"), document_chain())
    return predict(docs, chain).withColumn("toxic", F.col("p_toxic") >= chain.threshold)
