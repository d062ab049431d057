"""SimHash near-duplicates found with pigeonring filtering."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from casewright.llm.common import written

_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_BATCH = 1 << 16


def fingerprint(text: bytes, width: int = 3) -> int:
    """64-bit SimHash of word shingles: a bit is set if over half the hashes set it."""
    words = text.translate(_LOWER).split()
    if not words:
        return 0
    line = b" ".join(words)
    if len(words) <= width:
        return xxhash.xxh64_intdigest(line, 42)
    gaps = [-1, *np.flatnonzero(np.frombuffer(line, np.uint8) == 32).tolist(), len(line)]
    digest, ones, n = xxhash.xxh64_digest, np.zeros(64, np.int64), len(words) - width + 1
    for at in range(0, n, _BATCH):
        to = min(n, at + _BATCH)
        raw = b"".join([digest(line[a + 1:b], 42)
                        for a, b in zip(gaps[at:to], gaps[at + width:to + width], strict=True)])
        ones += np.unpackbits(np.frombuffer(raw, np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > n).tobytes(), "big")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 3,
                 carry: Sequence[str] = ()) -> DataFrame:
    """``doc_id, fp`` (a signed 64-bit integer) and the ``carry`` columns (not of these names)
    for every row; null texts have no words."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.array([fingerprint(t.as_py() or b"", width) for t in batch.column(0)], np.uint64)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[1:], pa.array(fps.view(np.int64))], names=[*batch.schema.names[1:], "fp"])

    rows = docs.select(F.col(text_col).cast("binary").alias("text_bytes"), F.col(id_col).cast("long").alias("doc_id"), *carry)
    return rows.mapInArrow(run, ", ".join(f"`{n}` {t}" for n, t in rows.dtypes[1:]) + ", fp long")


def _segment(fp: Column, at: int, bits: int) -> Column:
    """Bits ``at`` to ``at + bits`` counted from the lowest, around the ring of 64."""
    at %= 64
    low = F.shiftrightunsigned(fp, at)
    if at + bits > 64:
        low = low.bitwiseOR(F.shiftleft(fp, 64 - at))
    return low.bitwiseAND(F.lit((1 << bits) - 1))


def near_pairs(fps: DataFrame, most: int = 2, segments: int = 8, crowd: int = 256) -> DataFrame:
    """Links ``a, b`` that connect all fingerprints at ``most`` (2 at most) or fewer differing bits.

    Pigeonring: the ring of ``segments`` equal segments has, for any pair within ``most``
    bits, a start from which every chain of ``l`` segments differs in at most
    ``l * most / segments`` bits. The chain of the greatest length whose budget is still
    below one bit must agree exactly and is the join key of that start; the longer chains
    prune within the join, before the full Hamming distance. A pair that several starts
    find is kept by the first of them.

    Keys that over ``crowd`` fingerprints share are not joined with themselves, which would
    grow with their square. There every fingerprint names its 64 neighbours at one bit;
    two at two bits or fewer share a neighbour or are one, so linking each to the smallest
    namer of each neighbour connects just the same ones, exactly, in linear size. The rows
    returned are then pairs of distinct fingerprints, all within ``most`` bits of each other.
    """
    if most != 2 or 64 % segments:
        raise ValueError("two bits and a divisor of 64 as number of segments")
    bits = 64 // segments
    exact = (segments - 1) // most  # longest chain with a budget below one bit
    keys = F.array(*[
        F.struct(F.lit(s).alias("start"), _segment(F.col("fp"), s * bits, exact * bits).alias("key"))
        for s in range(segments)
    ])
    dealt = fps.select("fp", F.explode(keys).alias("k")).select("fp", "k.start", "k.key")
    counted = dealt.groupBy("start", "key").count().where("count > 1")
    small, large = counted.where(F.col("count") <= crowd), counted.where(F.col("count") > crowd)

    left = dealt.join(small.select("start", "key"), ["start", "key"])
    a, b = left.alias("a"), left.alias("b")
    x, y = F.col("a.fp"), F.col("b.fp")
    # The differing bits, turned so that the start comes first.
    turned = F.expr(f"shiftrightunsigned(a.fp ^ b.fp, a.start * {bits}) | "
                    f"if(a.start = 0, 0L, shiftleft(a.fp ^ b.fp, 64 - a.start * {bits}))")
    chains = F.lit(True)
    for n in range(exact + 1, segments):
        chains &= F.bit_count(turned.bitwiseAND(F.lit((1 << (n * bits)) - 1))) <= most * n // segments
    same_key = (F.col("a.start") == F.col("b.start")) & (F.col("a.key") == F.col("b.key"))
    pairs = a.join(b, same_key & (x < y) & chains & (F.bit_count(turned) <= most)).select(x.alias("a"), y.alias("b"))

    crowded = dealt.join(large.select("start", "key"), ["start", "key"]).select("fp").distinct()
    flips = F.array(F.lit(0).cast("long"), *[F.lit((1 << i) - (1 << 64 if i == 63 else 0)).cast("long") for i in range(64)])
    named = crowded.select("fp", F.explode(F.transform(flips, lambda m: m.bitwiseXOR(F.col("fp")))).alias("near"))
    least = named.groupBy("near").agg(F.min("fp").alias("least"), F.count(F.lit(1)).alias("n")).where("n > 1")
    stars = named.join(least, "near").where(F.col("fp") > F.col("least")).select(
        F.col("least").alias("a"), F.col("fp").alias("b"))
    return pairs.union(stars).distinct()


def components(links: DataFrame, most_rounds: int = 100) -> DataFrame:
    """``node, root``: every node of ``links`` (columns ``a, b``) with the smallest of its component.

    Alternates large-star and small-star steps: each replaces links by links to the
    smallest known neighbour until nothing changes, in a number of rounds that grows with
    the logarithm of the longest chain. Every round is written to the shared folder.
    """
    edges = written(links.where("a != b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(),
                    "links")

    def state(edges: DataFrame):
        return edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v")), F.bit_xor(F.xxhash64("v", "u"))).first()

    last = state(edges)
    for _ in range(most_rounds):
        # Large star: neighbours greater than a node go to the smallest of its neighbourhood.
        both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.join(least, "u").where("v > u AND v != m").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        # Small star: a node and its smaller neighbours go to the smallest of these.
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        moved = large.join(low, "u")
        small = moved.select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v").union(
            low.select("u", F.col("m").alias("v"))).distinct()
        edges = written(small, "links")
        now = state(edges)
        if now == last:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
        last = now
    raise RuntimeError(f"components did not settle in {most_rounds} rounds")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 3,
                    segments: int = 8, crowd: int = 256, carry: Sequence[str] = (), fp_col: str | None = None,
                    links: DataFrame | None = None) -> DataFrame:
    """One row per input row: ``doc_id, fingerprint, component_id, root`` and the ``carry`` columns.

    Documents of one fingerprint are one class (map-side counts and minima); only distinct
    fingerprints are compared, linked at two or fewer differing bits and joined to
    components. ``component_id`` is the smallest identifier reachable, itself included;
    null identifiers count only if a component has no other, and ``root``, a fingerprint,
    tells components apart in any case. Texts without words (null, empty or white space)
    have fingerprint zero and link like any other; repeated rows give repeated rows; an
    empty table gives none; other columns are ignored.

    ``fp_col`` names fingerprints that ``docs`` holds already, in place of texts; ``links`` are
    those that ``near_pairs`` found between them, if it ran before.
    """
    if fp_col is None:
        rows = written(fingerprints(docs, id_col, text_col, width, carry), "simhash")
    else:
        rows = docs.select(F.col(id_col).alias("doc_id"), F.col(fp_col).alias("fp"), *carry)
    classes = written(rows.groupBy("fp").agg(F.min("doc_id").alias("least")), "simhash-classes")
    roots = components(near_pairs(classes.select("fp"), segments=segments, crowd=crowd) if links is None else links)
    rooted = classes.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root"))
    names = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    classes = rooted.join(names, "root").select("fp", "component_id", "root")
    return rows.join(classes, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id", "root", *carry)
