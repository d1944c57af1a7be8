"""Language identification in two steps: the family first, then the language inside the family.

Texts become counts of hashed byte n-grams over their lower-cased letters. One-versus-rest linear
support vector machines choose the family; one-versus-one machines vote among the family's languages.
Machines are fitted on the driver from a bounded sample (`TRAIN_ROWS` rows per language); every text is
then scored where it lies, without a shuffle, from all of its n-grams.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sensorstream.llm.common import hand_back, pieces, text_bytes

#: Most rows per language that the machines are fitted on; most passes over them; cost of an error.
TRAIN_ROWS, PASSES, COST = 400, 30, 4.0
BUCKETS, ORDERS, SCALE = 1 << 13, (2, 3, 4), 40.0
#: Bytes of text that are scored together (a longer text goes alone); their n-grams take some 60 times that.
SCORE_BYTES = 256 << 10
UNKNOWN = "und"

# Language codes by family. A code that is not listed is a family of its own.
FAMILIES = {
    "germanic": ("en", "de", "nl", "af", "sv", "da", "no", "nb", "nn", "is", "lb"),
    "romance": ("fr", "es", "it", "pt", "ro", "ca", "gl", "oc"),
    "slavic": ("ru", "uk", "be", "pl", "cs", "sk", "sl", "hr", "sr", "bs", "bg", "mk"),
    "uralic": ("fi", "et", "hu"),
    "turkic": ("tr", "az", "kk", "uz"),
    "indic": ("hi", "ur", "bn", "mr", "ne", "pa"),
}
FAMILY_OF = {code: family for family, codes in FAMILIES.items() for code in codes}

_LETTER = np.full(256, 0x20, np.uint8)
_LETTER[97:123] = np.arange(97, 123)
_LETTER[128:] = np.arange(128, 256)


def grams(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all n-grams of all texts, and where each text's begin. Letters are lower-cased, a stretch of other
    characters is one space, and each text has a space at both ends; null is empty."""
    texts = pc.utf8_lower(pc.fill_null(texts.cast(pa.string()), ""))
    data, at = text_bytes(pc.binary_join_element_wise(" ", texts, " ", ""))
    data = _LETTER[data]
    double = np.zeros(len(data), bool)
    double[1:] = (data[1:] == 0x20) & (data[:-1] == 0x20)
    double[at[:-1]] = False
    keep = np.flatnonzero(~double)
    data, at = data[keep].astype(np.uint32), np.searchsorted(keep, at)
    length = np.diff(at)
    counts = np.stack([np.maximum(length - n + 1, 0) for n in ORDERS])
    begins = np.concatenate([[0], np.cumsum(counts.sum(0))])
    out = np.empty(begins[-1], np.int32)
    kind = np.int32 if begins[-1] < 1 << 31 else np.int64
    ends = np.repeat(at[1:].astype(kind), length)
    place = begins[:-1].copy()
    for n, own in zip(ORDERS, counts, strict=True):
        if len(data) < n:
            continue
        value = np.zeros(len(data) - n + 1, np.uint32)
        for i in range(n):
            value = value * np.uint32(0x01000193) + data[i : len(data) - n + 1 + i] + np.uint32(n)
        value ^= value >> np.uint32(15)
        value *= np.uint32(0x2C1B3C6D)
        value >>= np.uint32(32 - 13)
        value = value[np.arange(n, len(data) + 1, dtype=kind) <= ends[: len(value)]]
        # a text's n-grams of this order stand together, after those of the orders before
        before = np.cumsum(own) - own
        out[np.repeat((place - before).astype(kind), own) + np.arange(len(value), dtype=kind)] = value
        place += own
    return out, begins


def fit_machine(rows: np.ndarray, positive: np.ndarray) -> np.ndarray:
    """Weights (bias last) of a linear support vector machine with squared hinge loss, by dual coordinate
    descent in a fixed order of draws. Both classes weigh the same in total."""
    x = np.hstack([rows, np.ones((len(rows), 1), rows.dtype)])
    y = np.where(positive, 1.0, -1.0)
    share = np.where(positive, len(y) / (2 * positive.sum()), len(y) / (2 * (~positive).sum()))
    slack = 1 / (2 * COST * share)
    norms = (x * x).sum(1) + slack
    alpha, w = np.zeros(len(y)), np.zeros(x.shape[1])
    order = np.random.default_rng(7)
    for _ in range(PASSES):
        moved = 0.0
        for i in order.permutation(len(y)):
            slope = y[i] * (x[i] @ w) - 1 + slack[i] * alpha[i]
            new = max(alpha[i] - slope / norms[i], 0.0)
            if new != alpha[i]:
                w += (new - alpha[i]) * y[i] * x[i]
                moved = max(moved, abs(new - alpha[i]) * norms[i])
                alpha[i] = new
        if moved < 1e-3:
            break
    return w


@dataclass
class LanguageModel:
    """Families in order, their languages, and one column of weights per machine."""

    families: list[list[str]]
    pairs: list[list[tuple[int, int, int]]] = field(default_factory=list)
    weights: np.ndarray = field(default_factory=lambda: np.zeros((BUCKETS, 0), np.float32))
    bias: np.ndarray = field(default_factory=lambda: np.zeros(0))

    def predict(self, texts: pa.Array) -> tuple[list[str], list[float]]:
        """Language and score of each text; `und` and 0 without any letter or without a model."""
        lettered = pc.fill_null(pc.match_substring_regex(texts.cast(pa.string()), r"\p{L}"), False).to_numpy(zero_copy_only=False)
        bucket, at = grams(texts)
        sizes = np.diff(at)
        some = np.flatnonzero(sizes)
        margin = np.tile(self.bias, (len(sizes), 1))
        for k in range(self.weights.shape[1]):
            if len(some):
                margin[some, k] += np.add.reduceat(np.ascontiguousarray(self.weights[:, k])[bucket], at[some]) * SCALE / sizes[some]
        names, scores = [UNKNOWN] * len(sizes), [0.0] * len(sizes)
        n = len(self.families)
        for i in np.flatnonzero(lettered).tolist():
            if n == 0:
                continue
            own = margin[i]
            if n == 1:
                best, sure = 0, np.inf
            elif n == 2:
                best, sure = (0, own[0]) if own[0] >= 0 else (1, -own[0])
            else:
                ranked = np.argsort(-own[:n], kind="stable")
                best, sure = int(ranked[0]), (own[ranked[0]] - own[ranked[1]]) / 2
            votes = np.zeros(len(self.families[best]))
            support = np.zeros(len(votes))
            for a, b, k in self.pairs[best]:
                winner = a if own[k] >= 0 else b
                votes[winner] += 1
                support[winner] += abs(own[k])
            chosen = int(np.lexsort((-support, -votes))[0])
            for a, b, k in self.pairs[best]:
                if chosen in (a, b):
                    sure = min(sure, own[k] if chosen == a else -own[k])
            names[i] = self.families[best][chosen]
            scores[i] = float(1 / (1 + np.exp(-2 * np.clip(sure, -20, 20))))
        return names, scores


def fit(docs: DataFrame, eligible: Column, text: str = "text", lang: str = "lang", key: str = "doc_id", train_rows: int = TRAIN_ROWS) -> LanguageModel:
    """Fit on at most `train_rows` rows of each language for which `eligible` holds, drawn by a hash of `key`. Rows without
    language, without key or without any letter are left out. Only their feature counts reach the driver:
    `train_rows` times the number of languages, whatever the size of the table."""
    good = docs.where(eligible & F.col(lang).isNotNull() & F.col(key).isNotNull()).select(F.col(key).alias("key"), F.col(lang).alias("lang"), F.col(text).alias("text"))
    counts = {r["lang"]: r["n"] for r in good.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not counts:
        return LanguageModel([])
    grid = 1 << 20
    limits = F.create_map(*(x for name, n in sorted(counts.items()) for x in (F.lit(name), F.lit(min(grid, 2 * grid * train_rows // n + 1)))))
    draw = F.xxhash64("key")
    likely = good.where(F.pmod(draw, F.lit(grid)) < limits[F.col("lang")]).where(F.col("text").rlike(r"\p{L}"))
    chosen = likely.withColumn("_n", F.row_number().over(Window.partitionBy("lang").orderBy(F.pmod(draw, F.lit(grid)), "key", "text"))).where(F.col("_n") <= train_rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch, "text", SCORE_BYTES):
                bucket, at = grams(part.column("text"))
                rows = [np.unique(bucket[a:b], return_counts=True) for a, b in zip(at[:-1], at[1:], strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [part.column("lang"), pa.array([r[0] for r in rows], pa.list_(pa.int32())), pa.array([r[1].astype(np.int32) for r in rows], pa.list_(pa.int32()))],
                    names=["lang", "bucket", "n"],
                )
        hand_back()

    found = chosen.select("lang", "text").mapInArrow(run, "lang string, bucket array<int>, n array<int>").toArrow()
    langs = np.array(found.column("lang").to_pylist(), object)
    x = np.zeros((len(langs), BUCKETS), np.float32)
    for row, bucket, n in zip(x, found.column("bucket"), found.column("n"), strict=True):
        values = np.array(n.as_py(), np.float32)
        row[bucket.as_py()] = values * SCALE / values.sum()
    order = np.lexsort((x @ np.arange(BUCKETS, dtype=np.float32), langs.astype(str)))
    return fit_rows(x[order], langs[order])


def fit_rows(x: np.ndarray, langs: np.ndarray) -> LanguageModel:
    """The machines of both levels from feature rows and their languages."""
    groups: dict[str, list[str]] = {}
    for name in sorted(set(langs)):
        groups.setdefault(FAMILY_OF.get(name, name), []).append(name)
    model = LanguageModel([groups[k] for k in sorted(groups)])
    machines: list[np.ndarray] = []
    inside = [np.isin(langs, names) for names in model.families]
    if len(inside) == 2:
        machines.append(fit_machine(x, inside[0]))
    elif len(inside) > 2:
        machines += [fit_machine(x, own) for own in inside]
    for names in model.families:
        own = []
        for a, b in combinations(range(len(names)), 2):
            rows = (langs == names[a]) | (langs == names[b])
            own.append((a, b, len(machines)))
            machines.append(fit_machine(x[rows], langs[rows] == names[a]))
        model.pairs.append(own)
    if machines:
        stacked = np.stack(machines, 1)
        model.weights, model.bias = np.ascontiguousarray(stacked[:-1], np.float32), stacked[-1]
    return model


def identify(docs: DataFrame, model: LanguageModel, text: str = "text") -> DataFrame:
    """Add lang_pred and score to every row from its whole text; columns of these names are replaced, all others
    pass through. Texts that are null or have no letter get `und` and 0."""
    keep = [f for f in docs.schema.fields if f.name not in ("lang_pred", "score")]
    schema = T.StructType([*keep, T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch, text, SCORE_BYTES):
                names, scores = model.predict(part.column(text))
                yield pa.RecordBatch.from_arrays([*(part.column(f.name) for f in keep), pa.array(names, pa.string()), pa.array(scores, pa.float64())], names=schema.names)
        hand_back()

    return docs.mapInArrow(run, schema)


def held_out(key: str = "doc_id") -> Column:
    """Whether the key's fold (CRC-32 of its decimal text, mod 4) is fold 2; null keys belong to no fold."""
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % 4 == 2, F.lit(False))
