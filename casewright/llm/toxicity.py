"""Toxicity by compression distance: windows are compressed with two zstandard dictionaries.

A toxic and an ordinary dictionary are trained on labelled texts. A window whose toxic
length is shorter than its ordinary one holds what toxic texts repeat and ordinary ones do
not; the largest such gains of a text, calibrated on labelled rows, are its score.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import Column, DataFrame, Window, functions as F

from casewright.llm.common import hash_cut, written

#: Bytes at the end of both dictionaries and before every window: both lengths then hold
#: the fixed cost of a compressed block, and only the window itself makes a difference.
_PRIMER = bytes(range(128, 160))
#: Shortest match. Dictionary strings shorter than this cannot help.
_MATCH = 5
_WINDOW = 40


@dataclass(frozen=True)
class Model:
    """Dictionary strings (bytes, never with a zero byte) and the calibration."""

    toxic: tuple[bytes, ...]
    ordinary: tuple[bytes, ...]
    mean: tuple[float, ...]
    scale: tuple[float, ...]
    weights: tuple[float, ...]
    bias: float


def windows(text: bytes, size: int = _WINDOW) -> Iterator[bytes]:
    """Whole words up to at least ``size`` bytes, framed by spaces; longer words are cut."""
    held, n = [], 0
    for word in text.split():
        for at in range(0, len(word), size):
            part = word[at:at + size]
            held.append(part)
            n += len(part) + 1
            if n >= size:
                yield b" %s " % b" ".join(held)
                held, n = [], 0
    if held:
        yield b" %s " % b" ".join(held)


def _content(strings: tuple[bytes, ...], size: int) -> bytes:
    """Strings apart by zero bytes, the first ones nearest the end, filled up to ``size``."""
    body = b"\0".join([b"", *reversed(strings), b""])
    return b"\0" * (size - len(body)) + body + _PRIMER


@functools.lru_cache(maxsize=4)
def compressors(toxic: tuple[bytes, ...], ordinary: tuple[bytes, ...]):
    """Compressors (ordinary, toxic) with dictionaries of one size, so that offsets cost alike."""
    params = zstandard.ZstdCompressionParameters(
        format=zstandard.FORMAT_ZSTD1_MAGICLESS, write_content_size=False, write_checksum=False,
        write_dict_id=False, window_log=17, hash_log=14, chain_log=14, search_log=4, min_match=_MATCH,
        target_length=32, strategy=zstandard.STRATEGY_GREEDY,
    )
    size = max(sum(map(len, s)) + len(s) + 2 for s in (toxic, ordinary))
    out = []
    for strings in (ordinary, toxic):
        made = zstandard.ZstdCompressionDict(_content(strings, size), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        made.precompute_compress(compression_params=params)
        out.append(zstandard.ZstdCompressor(dict_data=made, compression_params=params))
    return tuple(out)


def features(text: bytes, pair) -> tuple[float, float, float, float]:
    """The two largest gains of windows, the log number of gains from 2 up, and of windows."""
    ordinary, toxic = pair[0].compress, pair[1].compress
    first = second = 0
    hits = n = 0
    for window in windows(text):
        framed = _PRIMER + window
        gain = len(ordinary(framed)) - len(toxic(framed))
        n += 1
        if gain > 1:
            hits += 1
        if gain > first:
            first, second = gain, first
        elif gain > second:
            second = gain
    return float(first), float(second), math.log1p(hits), math.log1p(n)


def _texts(batch: pa.RecordBatch, column: str) -> list[bytes]:
    lower = pc.utf8_lower(batch.column(column).cast(pa.large_string())).cast(pa.large_binary())
    return [t or b"" for t in lower.to_pylist()]


def _g2(a: Column, b: Column, n_a: int, n_b: int) -> Column:
    """Log-likelihood ratio of two document frequencies."""
    rate = (a + b) / F.lit(float(n_a + n_b))

    def part(x, n):
        return F.when(x > 0, x * F.log(x / (rate * n))).otherwise(0.0)
    return 2 * (part(a, n_a) + part(b, n_b))


def _cover(held: pd.DataFrame, n_docs: int, twice: int = 2, most: int = 64, least: float = 0.01) -> list[str]:
    """Strings that together occur ``twice`` in as many texts as possible.

    Greedy: the next string is the one that most texts with too few so far hold; of equals
    the longest. Strings that begin with a chosen one, or the other way round, drop out.
    It ends when no string helps ``least`` of the texts, so words that only a few copies of
    one text share are not chosen.
    """
    have = np.zeros(n_docs, int)
    docs = {s: g.to_numpy() for s, g in held.groupby("s")["doc"]}
    chosen: list[str] = []
    while docs and len(chosen) < most:
        gains = {s: int((have[d] < twice).sum()) for s, d in docs.items()}
        best = max(gains, key=lambda s: (gains[s], len(s), s))
        if gains[best] < max(1, least * n_docs):
            break
        chosen.append(best)
        have[docs[best]] += 1
        docs = {s: d for s, d in docs.items() if not s.startswith(best) and not best.startswith(s)}
    return chosen


def _calibrate(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2, rounds: int = 50):
    """Logistic regression with a ridge by Newton steps: mean, scale, weights, bias."""
    mean, scale = x.mean(axis=0), np.where(x.std(axis=0) > 0, x.std(axis=0), 1.0)
    z = np.column_stack([(x - mean) / scale, np.ones(len(x))])
    w, penalty = np.zeros(z.shape[1]), ridge * len(x) * np.diag([1.0] * x.shape[1] + [1e-3])
    weight = np.where(y == 1, len(y) / max(1, 2 * (y == 1).sum()), len(y) / max(1, 2 * (y == 0).sum()))
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        gradient = z.T @ (weight * (p - y)) + penalty @ w
        curve = (z * (weight * p * (1 - p))[:, None]).T @ z + penalty + 1e-9 * np.eye(z.shape[1])
        step = np.linalg.solve(curve, gradient)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return mean, scale, w[:-1], float(w[-1])


def fit(docs: DataFrame, labels: DataFrame, train: Column, id_col: str = "doc_id", text_col: str = "text",
        label_col: str = "toxic", per_class: int = 4000, candidates: int = 5000, odds: float = 8.0) -> Model | None:
    """Train on rows of ``labels`` where ``train`` (over ``id_col``) holds.

    The classifier is fitted on a bounded sample: of each class about ``per_class`` labelled
    identifiers, by hash (several labels of one identifier: the largest). Three
    quarters of it train the dictionaries, the rest the calibration, which gives either class
    the same weight.

    Toxic dictionary: beginnings of words, and whole words, that a significantly larger
    share (``odds`` times) of toxic than of ordinary texts hold and that together cover the toxic ones; only the ``candidates``
    most significant compete. Ordinary dictionary: the pieces of those strings that ordinary
    texts hold as well, so that both dictionaries shorten them alike. None if one of the
    classes is missing.
    """
    known = (
        labels.where(train & F.col(id_col).isNotNull() & F.col(label_col).isin(0, 1))
        .groupBy(F.col(id_col).alias("id")).agg(F.max(label_col).alias("y"))
    )
    counts = {r["y"]: r["count"] for r in known.groupBy("y").count().collect()}  # two at most
    cut = F.lit(None).cast("long")
    for y, n in counts.items():
        cut = F.when(F.col("y") == y, F.lit(hash_cut(per_class, n))).otherwise(cut)
    ids = known.where(F.xxhash64("id") <= cut)
    rows = (
        docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).where("text IS NOT NULL")
        .join(F.broadcast(ids), "id")  # about 2 * per_class identifiers
        .groupBy("id", "y").agg(F.min("text").alias("text"))
    )
    sample = written(rows.select("id", "y", "text", (F.pmod(F.xxhash64(F.lit("part"), "id"), F.lit(4)) == 3).cast("int").alias("part")),
                     "toxic-sample")
    sizes = {(r["part"], r["y"]): r["count"] for r in sample.groupBy("part", "y").count().collect()}
    n_toxic, n_ordinary = sizes.get((0, 1), 0), sizes.get((0, 0), 0)
    if not all(sizes.get((h, y)) for h in (0, 1) for y in (0, 1)):
        return None

    # Beginnings of words, from four characters to a space after the last one.
    words = sample.where("part = 0").select("id", "y", F.explode(F.array_distinct(F.split(F.lower("text"), r"[\x20\t-\r]+"))).alias("w"))
    begun = words.where("length(w) >= 4").select("id", "y", F.explode(F.array_distinct(F.transform(
        F.sequence(F.lit(4), F.least(F.length("w") + 1, F.lit(13))), lambda n: F.substring(F.concat("w", F.lit(" ")), F.lit(1), n)
    ))).alias("s")).distinct()
    counts = begun.groupBy("s").agg(F.sum("y").alias("a"), F.sum(1 - F.col("y")).alias("b"))
    telling = written(
        counts.where((F.col("a") >= max(3, 0.005 * n_toxic)) & (F.col("a") * n_ordinary > odds * (F.col("b") + 0.5) * n_toxic))
        .withColumn("g2", _g2(F.col("a"), F.col("b"), n_toxic, n_ordinary)).where("g2 >= 12")
        .orderBy(F.desc("g2"), "s").limit(candidates), "toxic-strings")
    docs_of = begun.where("y = 1").join(F.broadcast(telling.select("s")), "s")  # candidates rows at most
    number = Window.orderBy("id")  # over about per_class identifiers
    held = docs_of.join(F.broadcast(sample.where("part = 0 AND y = 1").select(
        "id", (F.row_number().over(number) - 1).alias("doc"))), "id").select("s", "doc").toPandas()
    toxic = tuple(b" " + s.encode() for s in _cover(held, n_toxic) if "\0" not in s)

    pieces = sorted({s[i:j] for s in toxic for i in range(len(s)) for j in range(i + _MATCH, len(s) + 1)})

    def holds(batches):
        for batch in batches:
            found: dict[bytes, int] = {}
            for text in _texts(batch, "text"):
                line = b" %s " % b" ".join(text.split())
                for p in pieces:
                    if p in line:
                        found[p] = found.get(p, 0) + 1
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(found), pa.binary()), pa.array(list(found.values()), pa.int64())], names=["p", "n"])

    seen = [bytes(r["p"]) for r in sample.where("part = 0 AND y = 0").select("text").mapInArrow(
        holds, "p binary, n long").groupBy("p").agg(F.sum("n").alias("n")).where("n >= 2").collect()]
    seen = sorted(p for p in seen if p not in toxic)
    ordinary = tuple(p for p in seen if not any(p != o and p in o for o in seen))

    def gains(batches):
        pair = compressors(toxic, ordinary)
        for batch in batches:
            rows = [features(t, pair) for t in _texts(batch, "text")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("y"), pa.array([list(r) for r in rows], pa.list_(pa.float64()))], names=["y", "x"])

    half = sample.where("part = 1").select(F.col("y").cast("int").alias("y"), "text").mapInArrow(
        gains, "y int, x array<double>").toPandas()
    mean, scale, weights, bias = _calibrate(np.array(half["x"].tolist()), half["y"].to_numpy())
    return Model(toxic, ordinary, tuple(mean), tuple(scale), tuple(weights), bias)


def score(docs: DataFrame, model: Model | None, text_col: str = "text") -> DataFrame:
    """``docs`` with ``score`` (0 to 1) and ``predicted`` (1 from 0.5 on); no shuffle.

    Whole texts are read, window by window. Null texts count as empty, which has no gain.
    Without a model every score is 0. Other columns pass through; columns named like a
    result are replaced.
    """
    kept = [c for c in docs.columns if c not in ("score", "predicted")]
    renamed = {c: f"in_{i}" for i, c in enumerate(kept)}
    rows = docs.select(*[F.col(f"`{c}`").alias(n) for c, n in renamed.items()])
    column = renamed[text_col]

    def run(batches):
        for batch in batches:
            texts = _texts(batch, column)
            if model is None:
                p = np.zeros(len(texts))
            else:
                pair = compressors(model.toxic, model.ordinary)
                x = np.array([features(t, pair) for t in texts]).reshape(-1, len(model.mean))
                z = (x - np.array(model.mean)) / np.array(model.scale) @ np.array(model.weights) + model.bias
                p = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
            yield pa.RecordBatch.from_arrays(batch.columns + [pa.array(p)], names=batch.schema.names + ["out"])

    out = rows.mapInArrow(run, ", ".join(f"{n} {t}" for n, t in rows.dtypes) + ", out double")
    return out.select(*[F.col(n).alias(c) for c, n in renamed.items()], F.col("out").alias("score"),
                      (F.col("out") >= 0.5).cast("int").alias("predicted"))
