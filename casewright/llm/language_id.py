"""Language identification by nearest centroids of TF-IDF n-gram vectors."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from casewright.llm.common import hash_cut, trimmed, written

BUCKETS = 4096
_SLICE = 1 << 20
#: Rows held as dense vectors at a time: 4 MB in 64 bits.
_ROWS = 128
#: Every byte as a letter or, for what is not one in ASCII, a space.
_LETTER = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 97 <= c <= 122 else 32 for c in range(256))
#: Lengths, in bytes, for which rejection distances are calibrated.
_LENGTHS = (16, 64, 256, 1024)


def ngram_counts(text: bytes) -> np.ndarray:
    """Counts of byte 2-grams and 3-grams of lower-case UTF-8 text, hashed to buckets.

    Runs of other ASCII characters than letters are one space; the text is framed by
    spaces. Long texts are counted in slices.
    """
    line = b" %s " % b" ".join(text.translate(_LETTER).split())
    total = np.zeros(BUCKETS, np.int64)
    for at in range(0, len(line), _SLICE):
        codes = np.frombuffer(line, np.uint8)[at:at + _SLICE + 2].astype(np.uint32)
        if len(codes) > 1:
            pairs = codes[:-1] * np.uint32(0x9E3779B1) + codes[1:] * np.uint32(0x85EBCA77)
            # A slice ends with two bytes of the next one; pairs that start there belong to it.
            total += np.bincount(pairs[:_SLICE] >> np.uint32(20), minlength=BUCKETS)
            triples = pairs[:-1] * np.uint32(5) + codes[2:] * np.uint32(0xC2B2AE3D)
            total += np.bincount(triples[:_SLICE] >> np.uint32(20), minlength=BUCKETS)
    return total


def unit_rows(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """Rows ``(1 + log count) * idf`` of length one (zero rows stay zero)."""
    x = np.where(counts > 0, 1 + np.log(np.maximum(counts, 1)), 0.0) * idf
    norm = np.linalg.norm(x, axis=1, keepdims=True)
    return (x / np.where(norm > 0, norm, 1)).astype(np.float32)


def cluster(x: np.ndarray, k: int, rounds: int = 12) -> np.ndarray:
    """Spherical k-means; starts from rows spread far apart, the first one nearest the mean."""
    mean = x.mean(axis=0)
    centres = [x[int(np.argmax(x @ mean))]]
    while len(centres) < min(k, len(x)):
        nearest = (x @ np.array(centres).T).max(axis=1)
        centres.append(x[int(np.argmin(nearest))])
    c = np.array(centres)
    for _ in range(rounds):
        of = np.argmax(x @ c.T, axis=1)
        sums = np.array([x[of == j].sum(axis=0) if (of == j).any() else c[j] for j in range(len(c))])
        norm = np.linalg.norm(sums, axis=1, keepdims=True)
        c = sums / np.where(norm > 0, norm, 1)
    return c.astype(np.float32)


@dataclass(frozen=True)
class Model:
    """Centroids of all languages, inverse document frequencies and rejection floors."""

    languages: tuple[str, ...]
    centroids: np.ndarray
    idf: np.ndarray
    #: Least cosine by length class, to which a text's best one is held.
    floors: np.ndarray


def _batches(batches: Iterator[pa.RecordBatch], column: str) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    for whole in batches:
        for at in range(0, whole.num_rows, _ROWS):
            batch = whole.slice(at, _ROWS)
            texts = pc.utf8_lower(batch.column(column).cast(pa.large_string())).cast(pa.large_binary())
            yield batch, [t or b"" for t in texts.to_pylist()]


def _sample(docs: DataFrame, train: Column, id_col: str, text_col: str, lang_col: str, bound: int,
            max_languages: int) -> DataFrame:
    """About ``bound`` labelled rows of each language, all if it has fewer: the share of
    hashed identifiers that its count calls for. Nothing but counts is shuffled."""
    known = docs.where(train & F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    counts = known.groupBy(F.col(lang_col).alias("l")).agg(F.count(F.lit(1)).alias("n")).limit(max_languages + 1).collect()
    if len(counts) > max_languages:
        raise ValueError(f"more than {max_languages} languages; their centroids would not fit a task")
    cuts = [(r["l"], hash_cut(bound, r["n"])) for r in counts]
    small = F.broadcast(docs.sparkSession.createDataFrame(cuts, "l string, cut long"))  # checked above
    rows = known.select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text"),
                        F.xxhash64(F.col(id_col), F.col(lang_col)).alias("ticket"))
    return rows.join(small, (F.col("lang") == F.col("l")) & (F.col("ticket") <= F.col("cut"))).select("lang", "ticket", "text")


def fit(docs: DataFrame, train: Column, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
        per_language: int = 1500, clusters: int = 4, slack: float = 0.8, lowest: float = 0.001,
        max_languages: int = 1000) -> Model | None:
    """Learn from rows where ``train`` holds and the language is known.

    The classifier is fitted on a bounded sample, about ``per_language`` rows of each
    language by a hash of the identifier. Each language's sample is vectorised in parallel and clustered in one task;
    the driver gets ``clusters`` centroids of 16 KB per language, of ``max_languages`` at most. A rejection floor is the
    ``lowest`` quantile, times ``slack``, of the best cosines of sample texts and of pieces
    of them, by length. None if there is nothing to learn from.
    """
    def vectorise(batches):
        for batch, texts in _batches(batches, "text"):
            langs, tickets = batch.column("lang").to_pylist(), batch.column("ticket").to_pylist()
            rows = []
            for lang, ticket, text in zip(langs, tickets, texts, strict=True):
                pieces = [(len(_LENGTHS), text)]
                for j, n in enumerate(_LENGTHS):
                    if len(text) >= 2 * n:  # a piece at a place that the ticket decides
                        at = ticket % (len(text) - n)
                        pieces.append((j, text[at:at + n]))
                for kind, piece in pieces:
                    counts = ngram_counts(piece)
                    at = np.flatnonzero(counts)
                    if len(at):
                        rows.append((lang, kind, len(piece), at.astype(np.int32), counts[at].astype(np.int32)))
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.int32()),
                 pa.array([r[2] for r in rows], pa.int64()),
                 pa.array([r[3] for r in rows], pa.list_(pa.int32())), pa.array([r[4] for r in rows], pa.list_(pa.int32()))],
                names=["lang", "kind", "n_bytes", "at", "counts"])

    vectors = written(
        _sample(docs, train, id_col, text_col, lang_col, per_language, max_languages).mapInArrow(
            trimmed(vectorise), "lang string, kind int, n_bytes long, at array<int>, counts array<int>"), "lang-vectors")
    whole = vectors.where(F.col("kind") == len(_LENGTHS))
    n = whole.count()
    if not n:
        return None
    idf = np.full(BUCKETS, np.log(n + 1) + 1)
    for row in whole.select(F.explode("at").alias("b")).groupBy("b").count().collect():  # one per bucket
        idf[row["b"]] = np.log((n + 1) / (row["count"] + 1)) + 1

    def dense(frame: pd.DataFrame) -> np.ndarray:
        out = np.zeros((len(frame), BUCKETS), np.float32)
        for i, (at, c) in enumerate(zip(frame["at"], frame["counts"], strict=True)):
            out[i, at] = c
        for i in range(0, len(out), _ROWS):
            out[i:i + _ROWS] = unit_rows(out[i:i + _ROWS], idf)
        return out

    def centres(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["n_bytes", "at"], key=lambda s: s if s.name == "n_bytes" else s.map(tuple))
        found = cluster(dense(frame), clusters)
        return pd.DataFrame({"lang": frame["lang"].iloc[0], "centroid": [c.tobytes() for c in found]})

    rows = whole.groupBy("lang").applyInPandas(centres, "lang string, centroid binary").collect()
    rows = sorted((r["lang"], bytes(r["centroid"])) for r in rows)
    centroids = np.array([np.frombuffer(c, np.float32) for _, c in rows])

    def best(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for at in range(0, len(frame), _ROWS):
                part = frame.iloc[at:at + _ROWS]
                yield pd.DataFrame({"kind": _class_of(part["n_bytes"].to_numpy()),
                                    "best": (dense(part) @ centroids.T).max(axis=1).astype(float)})

    floors = np.zeros(len(_LENGTHS) + 1)
    cosines = vectors.mapInPandas(best, "kind int, best double")
    for row in cosines.groupBy("kind").agg(F.percentile("best", F.lit(lowest)).alias("floor")).collect():
        floors[row["kind"]] = slack * row["floor"]
    # A longer text is held to no less than a shorter one; shorter than all pieces, to nothing.
    floors[0] = 0.0
    return Model(tuple(lang for lang, _ in rows), centroids, idf, np.maximum.accumulate(floors))


def _class_of(n_bytes: np.ndarray) -> np.ndarray:
    """Length class: the number of calibrated lengths up to ``n_bytes``."""
    return np.searchsorted(np.array(_LENGTHS), n_bytes, side="right").astype(np.int32)


def identify(docs: DataFrame, model: Model | None, text_col: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred, score, rejected``; no shuffle.

    ``lang_pred`` is the language of the nearest centroid, ``score`` its cosine (0 to 1).
    Texts that are null or have no letter, and all texts without a model, are ``und`` with
    score 0. ``rejected`` holds for them and for texts too far from every centroid for their
    length. Other columns pass through; columns named like a result are replaced.
    """
    kept = [c for c in docs.columns if c not in ("lang_pred", "score", "rejected")]
    renamed = {c: f"in_{i}" for i, c in enumerate(kept)}
    rows = docs.select(*[F.col(f"`{c}`").alias(n) for c, n in renamed.items()])
    shared = docs.sparkSession.sparkContext.broadcast(model)  # 16 KB per centroid
    column = renamed[text_col]

    def classify(batches):
        model = shared.value
        for batch, texts in _batches(batches, column):
            letter = pc.match_substring_regex(batch.column(column), r"\p{L}").fill_null(False).to_pylist()
            lang, score, rejected = [], [], []
            if model is None:
                best, value = np.zeros(len(texts), int), np.zeros(len(texts))
            else:
                counts = np.array([ngram_counts(t) for t in texts], np.float32)
                cosine = unit_rows(counts, model.idf) @ model.centroids.T
                best, value = np.argmax(cosine, axis=1), np.clip(cosine.max(axis=1), 0, 1)
                floor = model.floors[_class_of(np.array([len(t) for t in texts]))]
            for i, has in enumerate(letter):
                known = has and model is not None
                lang.append(model.languages[best[i]] if known else "und")
                score.append(float(value[i]) if known else 0.0)
                rejected.append(not known or bool(value[i] < floor[i]))
            yield pa.RecordBatch.from_arrays(
                batch.columns + [pa.array(lang), pa.array(score), pa.array(rejected)],
                names=batch.schema.names + ["out_lang", "out_score", "out_rejected"])

    schema = ", ".join(f"{n} {t}" for n, t in rows.dtypes) + ", out_lang string, out_score double, out_rejected boolean"
    out = rows.mapInArrow(trimmed(classify), schema)
    return out.select(*[F.col(n).alias(c) for c, n in renamed.items()], F.col("out_lang").alias("lang_pred"),
                      F.col("out_score").alias("score"), F.col("out_rejected").alias("rejected"))
