"""Toxicity from a linear-chain conditional random field over tokens.

Labels are per document, so tokens of a bounded labelled sample are labelled first: a word
or word beginning that toxic documents use in many different contexts and clean ones hardly
at all (a likelihood-ratio test over all candidates) marks its tokens in toxic documents.
The field learns from chains around them and chains of clean documents. Forward-backward
marginals of every token give the offending offsets; a logistic fit of the document labels
on their aggregates gives the document's score.

Results in odd cases: a null or empty text has score 0 and no spans; documents without a
label and labels without a document teach nothing; repeated labels count by row; without
toxic examples every score is 0; repeated rows get a row each; other columns are not read.
"""

from __future__ import annotations

import math
import re
from array import array
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sunloom.llm.common import bounded_sample, id_fold, slices, spread_text
from sunloom.llm.crf import Chain, Decoder

FOLDS, HELD_OUT = 3, 1
# At most so many toxic and clean labelled documents teach, each with so many characters from all over it.
TOXIC_ROWS, CLEAN_ROWS = 1024, 3072
SAMPLE_CHARS = 6000
THRESHOLD = 0.7
# Chains the field learns from: tokens on each side of a toxic one, and tokens of a clean one.
BESIDE, CLEAN_CHAIN = 6, 24
TOXIC_CHAINS, CLEAN_CHAINS = 2000, 4000
# Evidence beyond what the best of all candidates shows by chance, in nats.
EVIDENCE = 4.0
LABELS = ("clean", "toxic")
_EDGES = re.compile(r"^\W+|\W+$")
_TOKEN = re.compile(r"\S+")
BEGINNINGS = (4, 5, 6)


def core(token: str) -> str:
    token = token.lower()
    return token if token.isalnum() else _EDGES.sub("", token)


def features(token: str) -> list[str]:
    word = core(token)
    kind = "a" if word.isalpha() else "d" if word.isdigit() else "m" if word else "e"
    return [
        f"w={word}",
        *(f"p{k}={word[:k]}" for k in BEGINNINGS if len(word) > k),
        f"k={kind}",
    ]


def _marks(word: str) -> list[str]:
    return [word, *(f"{word[:k]}*" for k in BEGINNINGS if len(word) > k)] if word else []


def toxic_marks(toxic: list[list[str]], clean: list[list[str]]) -> set[str]:
    """Words and beginnings (``abcd*``) that tell toxic texts, by different contexts of use."""
    index: dict[str, int] = {}

    def contexts(texts: list[list[str]], grow: bool) -> tuple[np.ndarray, int]:
        pairs, total = array("q"), array("q")
        for words in texts:
            around = ["", *words, ""]
            for i, word in enumerate(words):
                where = xxhash.xxh32_intdigest(" ".join(around[i : i + 3]))
                total.append(where)
                for mark in _marks(word):
                    known = index.setdefault(mark, len(index)) if grow else index.get(mark)
                    if known is not None:
                        pairs.append(known << 32 | where)
        found = np.unique(np.frombuffer(pairs, dtype=np.int64)) >> 32 if pairs else np.zeros(0, np.int64)
        n = len(np.unique(np.frombuffer(total, dtype=np.int64))) if total else 0
        return np.bincount(found, minlength=len(index)), n

    bad, n_bad = contexts(toxic, True)
    good, n_good = contexts(clean, False)
    if not n_bad:
        return set()
    share = n_bad / (n_bad + max(n_good, 1))
    both = np.maximum(bad + good, 1)
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = bad * np.log(bad / both / share) + np.where(
            good > 0, good * np.log(np.maximum(good, 1) / both / (1 - share)), 0
        )
    told = (bad >= 0.9 * both) & (gain >= math.log(len(index)) + EVIDENCE)
    return {mark for mark, i in index.items() if told[i]}


def labelled_chains(rows: list[tuple[int, str]]) -> list[tuple[list[str], list[int]]]:
    """Token chains with labels from (toxic, text) rows.

    Chains lie around marked tokens, toxic in toxic documents and not in clean ones, and all
    along clean documents.
    """
    known: dict[str, str] = {}

    def cores(text: str) -> list[str]:
        # Equal tokens share one string.
        return [known.get(t) or known.setdefault(t, core(t)) for t in text.split()]

    split = {flag: [cores(text) for text in texts] for flag, texts in _by_flag(rows).items()}
    marks = toxic_marks(split[1], split[0])

    alike = {b for m in marks for b in _marks(m.rstrip("*"))} | marks

    def around(words: list[str], label: int) -> list[tuple[list[str], list[int]]]:
        # In clean documents also tokens that only begin like a marked one.
        told = marks if label else alike
        marked = [any(m in told for m in _marks(w)) for w in words]
        chains, end = [], 0
        for i in np.flatnonzero(marked):
            if i >= end:
                start, end = max(0, i - BESIDE), i + BESIDE + 1
                chains.append((words[start:end], [label * v for v in marked[start:end]]))
        return chains

    def spread(chains: list, most: int) -> list:
        return chains[:: max(1, -(-len(chains) // most))]

    toxic = [chain for words in split[1] for chain in around(words, 1)]
    hard = [chain for words in split[0] for chain in around(words, 0)]
    plain = [
        (words[at : at + CLEAN_CHAIN], [0] * len(words[at : at + CLEAN_CHAIN]))
        for words in split[0]
        for at in range(0, len(words), CLEAN_CHAIN)
    ]
    return spread(toxic, TOXIC_CHAINS) + spread(hard, TOXIC_CHAINS) + spread(plain, CLEAN_CHAINS)


def _by_flag(rows: list[tuple[int, str]]) -> dict[int, list[str]]:
    """Different texts of each label; copies teach once."""
    return {flag: sorted({text for f, text in rows if f == flag}) for flag in (0, 1)}


def labelled_sample(documents: DataFrame, labels: DataFrame) -> list[tuple[int, str]]:
    """(toxic, text) of a bounded sample of labelled rows outside the held-out fold."""
    taught = labels.select("doc_id", "toxic").where("toxic IN (0, 1) AND doc_id IS NOT NULL").where(
        id_fold("doc_id", FOLDS) != HELD_OUT
    )
    bounds = {1: TOXIC_ROWS, 0: CLEAN_ROWS}
    picked = None
    for flag, rows in bounds.items():
        part = bounded_sample(taught.where(F.col("toxic") == flag), None, ["doc_id", "toxic"], F.col("doc_id"), rows)
        picked = part if picked is None else picked.unionByName(part)
    texts = documents.where("text IS NOT NULL").select("doc_id", "text")
    # At most TOXIC_ROWS + CLEAN_ROWS ids; a doc_id's least text, should it repeat.
    joined = texts.join(F.broadcast(picked), "doc_id").select(
        "doc_id", "toxic", spread_text("text", SAMPLE_CHARS).alias("text")
    )
    taken = joined.groupBy("doc_id", "toxic").agg(F.min("text").alias("text"))
    return [(r.toxic, r.text) for r in taken.select("toxic", "text").collect()]


@dataclass
class Model:
    """The field over tokens, and the weights that make a document's score of its marginals."""

    field: Chain
    weights: np.ndarray

    def document_score(self, p: np.ndarray) -> float:
        x = np.append(evidence(p), 1.0) if len(p) else None
        return 0.0 if x is None else float(1 / (1 + np.exp(-np.clip(x @ self.weights, -30, 30))))


def evidence(p: np.ndarray) -> list[float]:
    """Of the offending tokens (likelier toxic than not): the expected number, bounded, and
    the chance that there is one; and the log odds of the likeliest token."""
    offending = p[p >= 0.5]
    top = min(max(float(p.max()), 1e-6), 1 - 1e-6)
    return [min(float(offending.sum()), 3.0), float(1 - np.prod(1 - offending)), math.log(top / (1 - top)) / 10]


def train(documents: DataFrame, labels: DataFrame) -> Model:
    """Field over tokens first, then a logistic fit of the documents' own labels."""
    return fit_model(labelled_sample(documents, labels))


def fit_model(rows: list[tuple[int, str]]) -> Model:
    field = Chain(LABELS, features, context=False).fit(labelled_chains(rows), rounds=60)
    found, flags = [], []
    decoder = Decoder(field)
    for at in range(0, len(rows), 256):
        part = rows[at : at + 256]
        for (flag, _), p in zip(part, decoder.probabilities([text.split() for _, text in part])):
            if len(p):
                found.append([*evidence(p[:, 1].astype(np.float64)), 1.0])
                flags.append(flag)
    weights = np.array([0.0, 0.0, 0.0, -10.0])
    if any(flags):
        x, y = np.array(found), np.array(flags, dtype=float)
        weights[:] = 0
        for _ in range(25):
            q = 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))
            # A weak prior towards zero keeps the step defined where labels are separable.
            slope = x.T @ (y - q) - 0.1 * weights
            weights += np.linalg.solve((x * (q * (1 - q))[:, None]).T @ x + 0.1 * np.eye(x.shape[1]), slope)
    return Model(field, weights)


def score_texts(
    texts: list[str | None], model: Model, decoder: Decoder, spans: bool = True
) -> list[tuple[float, list[dict]]]:
    found = decoder.probabilities([t.split() if t else [] for t in texts])
    out = []
    for text, p in zip(texts, found):
        toxic = p[:, 1]
        where = []
        if spans and (toxic >= 0.5).any():
            # str.split() and \S agree on what parts tokens.
            where = [
                {"start": m.start(), "end": m.end(), "p": float(toxic[i])}
                for i, m in enumerate(_TOKEN.finditer(text))
                if toxic[i] >= 0.5
            ]
        out.append((model.document_score(toxic.astype(np.float64)), where))
    return out


SCORED = T.StructType(
    [
        T.StructField("score", T.DoubleType()),
        T.StructField(
            "spans",
            T.ArrayType(
                T.StructType(
                    [
                        T.StructField("start", T.IntegerType()),
                        T.StructField("end", T.IntegerType()),
                        T.StructField("p", T.DoubleType()),
                    ]
                )
            ),
        ),
    ]
)


def score(documents: DataFrame, model: Model) -> DataFrame:
    """doc_id, score and offending spans of every row."""
    from pyspark.sql.pandas.types import to_arrow_schema

    source = documents.select("doc_id", "text")
    target = T.StructType([source.schema["doc_id"], *SCORED.fields])
    arrow = to_arrow_schema(target)

    def run(batches):
        decoder = Decoder(model.field)
        for batch in slices(batches):
            found = score_texts(batch.column("text").to_pylist(), model, decoder)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array([s for s, _ in found], pa.float64()),
                    pa.array([w for _, w in found], arrow.field("spans").type),
                ],
                schema=arrow,
            )

    return source.mapInArrow(run, target)


def drop_toxic(documents: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """The rows that score below the threshold, with all their columns."""

    def run(batches):
        decoder = Decoder(model.field)
        for batch in slices(batches):
            found = score_texts(batch.column("text").to_pylist(), model, decoder, spans=False)
            yield batch.filter(pa.array([s < threshold for s, _ in found], pa.bool_()))

    return documents.mapInArrow(run, documents.schema)
