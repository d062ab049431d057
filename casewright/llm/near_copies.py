"""Groups of near copies: word shingles of Jaccard similarity 0.8 or more, found by operator 9's
fingerprints and pigeonring chains first, the rest with prefix filtering."""

from __future__ import annotations

import functools
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window, functions as F

from casewright.llm import shared_files, text_store
from casewright.llm.common import discard, trimmed, written
from casewright.llm.simhash import components, fingerprint, near_duplicates, near_pairs
from casewright.session import run_folder

_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
#: Similarity as a fraction; integers keep the comparison exact.
_OF, _LEAST = 5, 4
#: Nodes of a crowded key that the second round compares with all others; later rounds take ``_MORE`` times as many each.
_PIVOTS, _MORE = 256, 4
#: First crowded keys of a node that travel with it.
_LEAD = 16
#: Bits of the parity bitmap of a set.
_BITS = 512


def shingles(text: bytes, width: int = 5) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word shingles of ASCII-lower-case text.

    Fewer words than ``width`` are one shingle; no words give none.
    """
    words = text.translate(_LOWER).split()
    if not words:
        return np.zeros(0, np.int64)
    digest = xxhash.xxh64_intdigest
    hashed = np.array([digest(w, 42) for w in words], np.uint64)
    take = min(width, len(words))
    n = len(words) - take + 1
    h = np.full(n, take, np.uint64)
    for i in range(take):
        h = (h ^ hashed[i:i + n]) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
    return np.unique(h.view(np.int64))


def parity(found: np.ndarray) -> np.ndarray:
    """``_BITS`` bits as 64-bit integers: each is 1 if an odd number of shingles fall on it.

    A shingle that only one of two sets holds flips one bit, so that their bitmaps never
    differ in more bits than the sets differ in shingles.
    """
    odd = np.bincount(found.view(np.uint64) >> np.uint64(32) & np.uint64(_BITS - 1), minlength=_BITS) & 1 if len(found) else np.zeros(_BITS, int)
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def prefix(found: np.ndarray, common: np.ndarray) -> np.ndarray:
    """The first shingles in the order of hashes, those of the sorted ``common`` last: two
    sets of the least similarity or more share one of these, whatever is common."""
    if len(common):
        at = np.minimum(np.searchsorted(common, found), len(common) - 1)
        found = np.concatenate([found[common[at] != found], found[common[at] == found]])
    return found[:len(found) - -(-_LEAST * len(found) // _OF) + 1]


def _prefixes(docs: DataFrame, common: np.ndarray, id_col: str, text_col: str, width: int, carry: Sequence[str]) -> DataFrame:
    """One row per document with the place of its text; ``no`` tells rows apart."""
    shared, folder = docs.sparkSession.sparkContext.broadcast(common), run_folder(docs.sparkSession, "copy-texts")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        no = TaskContext.get().partitionId() << 40
        with text_store.TextWriter(folder) as writer:
            for whole in batches:
                for at in range(0, whole.num_rows, 512):
                    batch = whole.slice(at, 512)
                    texts = batch.column(0).to_pylist()
                    sets = [shingles(t or b"", width) for t in texts]
                    keys = [prefix(s, shared.value) for s in sets]
                    fps = np.array([fingerprint(t or b"") for t in texts], np.uint64).view(np.int64)
                    digests = np.array([xxhash.xxh64_intdigest(s.tobytes(), 42) for s in sets], np.uint64).view(np.int64)
                    ends = np.cumsum([0, *map(len, keys)]).astype(np.int32)
                    bitmaps = np.concatenate([np.zeros(0, np.int64), *map(parity, sets)])
                    flat = np.concatenate([np.zeros(0, np.int64), *keys])
                    placed = iter(writer.add([t for t in texts if t is not None]))
                    places = [(None, None, None) if t is None else next(placed) for t in texts]
                    yield pa.RecordBatch.from_arrays(
                        [*batch.columns[1:], pa.array(np.arange(no, no + len(texts))), pa.array(digests), pa.array(fps),
                         pa.array([len(s) for s in sets], pa.int32()), pa.ListArray.from_arrays(pa.array(ends), pa.array(flat)),
                         pa.ListArray.from_arrays(pa.array(np.arange(len(sets) + 1, dtype=np.int32) * (_BITS // 64)), pa.array(bitmaps)),
                         *[pa.array(c, t) for c, t in zip(zip(*places, strict=True), (pa.string(), pa.int64(), pa.int32()), strict=True)]],
                        names=[*batch.schema.names[1:], "no", "node", "fp", "n", "keys", "bits", "stored", "stored_at", "stored_bytes"])
                    no += len(texts)

    rows = docs.select(F.col(text_col).cast("binary").alias("text_bytes"), F.col(id_col).alias("doc_id"), *carry)
    schema = ", ".join(f"`{n}` {t}" for n, t in rows.dtypes[1:]) + f", no long, node long, fp long, n int, keys array<long>, bits array<long>, {text_store.PLACE}"
    return rows.mapInArrow(trimmed(run), schema)


def _frequent(docs: DataFrame, text_col: str, width: int, common: int, sample: int, most_common: int) -> np.ndarray:
    """Shingles that over ``common`` texts of a hashed share of the corpus hold, sorted."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for text in batch.column(0):
                yield pa.RecordBatch.from_arrays([pa.array(shingles(text.as_py() or b"", width))], names=["key"])

    share = docs.where(F.pmod(F.xxhash64(text_col), F.lit(sample)) == 0).select(F.col(text_col).cast("binary").alias("text_bytes"))
    often = share.mapInArrow(trimmed(run), "key long").groupBy("key").agg(F.count(F.lit(1)).alias("many")).where(F.col("many") > common)
    return np.sort(often.orderBy(F.desc("many"), "key").limit(most_common).select("key").toArrow()["key"].to_numpy())


def _verified(pairs: DataFrame, places: DataFrame, width: int) -> DataFrame:
    """Those of the distinct pairs ``a, b`` whose sets reach the least similarity.

    Pairs of one ``root`` are connected already and left out. Bitmaps rule out most others;
    of the rest the texts are read by place.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        @functools.lru_cache(maxsize=256)
        def found(path, at, length):
            return shingles(text_store.fetch(path, at, length), width)

        for batch in batches:
            alike = []
            for row in batch.select(["pa", "pb"]).to_pylist():
                x, y = (found(*row[c].values()) for c in ("pa", "pb"))
                both = len(np.intersect1d(x, y, assume_unique=True))
                alike.append((_OF + _LEAST) * both >= _LEAST * (len(x) + len(y)))
            yield batch.select(["a", "b"]).filter(pa.array(alike, pa.bool_()))
        shared_files.pieces.cache_clear()  # workers are used again

    left = places.select(F.col("node").alias("a"), F.col("place").alias("pa"), F.col("bits").alias("bits_a"), F.col("n").alias("na"), F.col("root").alias("root_a"))
    right = places.select(F.col("node").alias("b"), F.col("place").alias("pb"), F.col("bits").alias("bits_b"), F.col("n").alias("nb"), F.col("root").alias("root_b"))
    near = pairs.join(left, "a").join(right, "b").where((F.col("root_a") != F.col("root_b")) & _possible())
    return near.select("a", "b", "pa", "pb").mapInArrow(trimmed(run), "a long, b long")


def _sizes(a: str, b: str) -> Column:
    """Sizes at which two sets can be similar enough."""
    return (_OF * F.least(a, b)) >= (_LEAST * F.greatest(a, b))


def _possible() -> Column:
    """Whether sets of sizes ``na, nb`` and bitmaps ``bits_a, bits_b`` can be similar enough: those
    that are differ in at most a ninth of both sizes together, and so do not differ in more bits."""
    differ = functools.reduce(Column.__add__, [F.bit_count(F.col("bits_a")[i].bitwiseXOR(F.col("bits_b")[i])) for i in range(_BITS // 64)])
    return _sizes("na", "nb") & ((_OF + _LEAST) * differ <= (_OF - _LEAST) * (F.col("na") + F.col("nb")))


def _reachable() -> Column:
    """Whether sets whose first common shingle stands at ``pos_a`` and ``pos_b`` can still have enough in common."""
    left = F.least(F.col("na") - F.col("pos_a"), F.col("nb") - F.col("pos_b"))
    return (_OF + _LEAST) * left >= _LEAST * (F.col("na") + F.col("nb"))


def _by_fingerprint(places: DataFrame, width: int) -> DataFrame:
    """Links ``a, b`` that operator 9 gives, verified: of all its classes, links and components over the
    fingerprints ``fps`` of all nodes.

    Each node is compared with that of its component which most rows have. Where this does not connect
    them, each node is compared with that of its fingerprint which most rows have, and these of any two
    fingerprints that operator 9 links with one another, so that none of its links is taken for another.
    """
    prints = places.select("node", "many", F.explode("fps").alias("print"))
    near = written(near_pairs(prints.select(F.col("print").alias("fp")).distinct()), "copy-prints")
    grouped = near_duplicates(prints, id_col="node", fp_col="print", links=near, carry=["print", "many"])
    # Written, so that the joins read plain exchanges, which adaptive execution splits where a component is large.
    members = written(grouped.select(F.col("doc_id").alias("node"), "print", "many", "root"), "copy-members")
    first = F.max_by("node", F.struct("many", "node"))
    chosen = members.groupBy("root").agg(first.alias("a"), F.count(F.lit(1)).alias("nodes"))
    star = members.join(chosen.where("nodes > 1").select("root", "a"), "root").where("node != a").select("a", F.col("node").alias("b")).distinct()
    known = written(_verified(star, places, width), "copy-links")

    marks = known.groupBy(F.col("b").alias("node")).agg(F.min("a").alias("root"))
    placed = places.drop("root").join(marks, "node", "left").withColumn("root", F.coalesce("root", "node"))
    named = members.groupBy("print").agg(first.alias("a"), F.count(F.lit(1)).alias("nodes"))
    alike = members.join(named.where("nodes > 1").select("print", "a"), "print").select("a", F.col("node").alias("b"))
    ends = [named.select(F.col("print").alias(f"print_{x}"), F.col("a").alias(f"node_{x}")) for x in "ab"]
    linked = near.withColumnsRenamed({"a": "print_a", "b": "print_b"}).join(ends[0], "print_a").join(ends[1], "print_b")
    rest = alike.union(linked.select("node_a", "node_b")).where("a != b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    links = written(known.union(_verified(rest.distinct(), placed, width)), "copy-links")
    discard(near, members, known)
    return links


def _groups(keyed: DataFrame, places: DataFrame, known: DataFrame, crowd: int, width: int) -> DataFrame:
    """``node, root`` of all nodes that have a link; ``keyed`` has distinct ``key, node, n, pos`` and ``places``
    has for each node the ``place`` of a text, its bitmap ``bits``, ``n`` and its ``root`` by the links ``known``.

    Keys of up to ``crowd`` nodes give all their pairs. In larger ones some nodes (pivots)
    are compared with all others: first the node that holds most of the crowded keys, which
    of edited copies is the one least edited. A key whose nodes then are one component needs
    no more; otherwise nodes outside its largest component are the next pivots, one of each
    component before the second of any and more of them in each round, until each was one or
    is connected. A pivot is not compared with nodes of its own component. So a large group
    of near copies takes a linear number of comparisons, and no link between components is
    missed. Pairs that bitmaps rule out are not written.

    A pair must only be found at its first common key: places in the order rule later ones
    out, and so does an earlier common key among the first ``_LEAD`` crowded ones of both, where
    the two meet as well.
    """
    sizes = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("many"))
    small = keyed.join(sizes.where(F.col("many").between(2, crowd)).select("key"), "key")
    a, b = (small.select("key", F.col("node").alias(x), F.col("n").alias(f"n{x}"), F.col("pos").alias(f"pos_{x}")) for x in "ab")
    pairs = a.join(b, "key").where((F.col("a") < F.col("b")) & _reachable()).select("a", "b").distinct()
    pairs = written(pairs, "copy-pairs")
    links = written(_verified(pairs, places, width).union(known), "copy-links")
    crowded = written(keyed.join(sizes.where(F.col("many") > crowd).select("key"), "key"), "copy-crowds")
    held = crowded.groupBy("node").agg(F.count(F.lit(1)).alias("held"))
    leads = crowded.withColumn("at", F.row_number().over(Window.partitionBy("node").orderBy("pos"))).where(F.col("at") <= _LEAD)
    leads = leads.groupBy("node").agg(F.array_sort(F.collect_list(F.struct("pos", "key"))).alias("lead"))
    earlier = F.transform(F.filter("lead", lambda k: k["pos"] < F.col("pos")), lambda k: k["key"]).alias("earlier")
    open_keys = crowded.join(held, "node").join(leads, "node").select("key", "node", "n", "pos", "held", earlier)
    open_keys = written(open_keys.join(places.select("node", "bits", "root"), "node"), "copy-crowds")
    discard(crowded)
    a, b = ([F.col("node").alias(x), F.col("n").alias(f"n{x}"), *[F.col(c).alias(f"{c}_{x}") for c in ("root", "pos", "bits", "earlier")]] for x in "ab")
    order = F.struct(-F.col("held"), F.col("node"))
    pivots = written(open_keys.groupBy("key").agg(F.min_by(F.struct(*a), order).alias("p")).select("key", "p.*"), "copy-pivots")
    tried, done, most, roots = [pairs], [pivots], _PIVOTS, None
    while not pivots.isEmpty():
        # The first pivots differ from key to key, so that an earlier key does not make up for a later one.
        first = F.lit(True) if roots is None else ~F.arrays_overlap("earlier_a", "earlier_b")
        pairs = open_keys.select("key", *b).join(pivots, "key").where(
            (F.col("root_a") != F.col("root_b")) & _possible() & (F.lit(True) if roots is None else _reachable()) & first
        ).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
        for past in tried:
            pairs = pairs.join(past, ["a", "b"], "left_anti")
        tried.append(written(pairs, "copy-pairs"))
        # What is connected already goes on as one link of each node to its root.
        before = links if roots is None else roots.select(F.col("node").alias("a"), F.col("root").alias("b"))
        roots = components(before.union(_verified(tried[-1], places, width)))
        placed = open_keys.drop("root").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
        parts = placed.groupBy("key", "root").agg(F.count(F.lit(1)).alias("many"))
        largest = parts.groupBy("key").agg(F.max_by("root", F.struct("many", "root")).alias("main"), F.count(F.lit(1)).alias("parts"))
        several = written(placed.join(largest.where("parts > 1"), "key"), "copy-crowds")
        outside = several.where("root != main")
        for past in done:
            outside = outside.join(past.select("key", F.col("a").alias("node")), ["key", "node"], "left_anti")
        turn = F.row_number().over(Window.partitionBy("key", "root").orderBy(F.desc("held"), "node"))
        rank = F.row_number().over(Window.partitionBy("key").orderBy("turn", F.desc("held"), "node"))
        pivots = outside.withColumn("turn", turn).withColumn("rank", rank).where(F.col("rank") <= most).select("key", *a)
        pivots, most = written(pivots, "copy-pivots"), most * _MORE
        last, open_keys = open_keys, written(several.drop("main", "parts").join(pivots.select("key").distinct(), "key", "left_semi"), "copy-crowds")
        discard(last, several)
        done.append(pivots)
    roots = components(links) if roots is None else roots
    discard(open_keys, links, *tried, *done)
    return roots


def near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5, crowd: int = 64,
                common: int = 2, sample: int = 16, most_common: int = 1 << 20, carry: Sequence[str] = ()) -> DataFrame:
    """One row per input row: ``doc_id, no, node, root``, the place of its text and the ``carry`` columns.

    Rows of one ``root`` are one group: joined by chains of documents whose sets of
    ``width``-word shingles have a Jaccard similarity of 0.8 or more; ``no`` tells rows apart.
    Operator 9 first groups all rows by fingerprints at two bits or fewer; its links are
    verified (``_by_fingerprint``), and what is connected so is not compared again. All other
    pairs are found too (up to collisions of 64-bit hashes): two of them share a
    shingle of their first fifth in any order. The order is by hash, but shingles that over
    ``common`` texts of one ``sample``-th of the corpus hold come last (the ``most_common`` of
    them, 8 bytes each on the driver and in tasks), so that shared lines and passages lead to
    few pairs; the order decides what is compared, not what is found. Parity bitmaps rule pairs
    out and links are verified on the whole sets. Whole texts are written once to a text store and only referred to.
    Texts without words are one group; a null text has a null place; repeated rows give
    repeated rows.
    """
    last = _frequent(docs, text_col, width, common, sample, most_common)
    rows = written(_prefixes(docs, last, id_col, text_col, width, carry), "copy-prefixes")
    dealt = rows.select("node", "n", F.posexplode("keys").alias("pos", "key"))
    # Written, so that the join reads plain exchanges, which adaptive execution splits where a key is hot.
    several = written(dealt.groupBy("key").agg(F.count(F.lit(1)).alias("many")).where("many > 1").select("key"), "copy-shared")
    keyed = written(dealt.join(several, "key").distinct(), "copy-keyed")
    discard(several)
    place = F.struct("stored", "stored_at", "stored_bytes")
    # Rows of one set may have several fingerprints, as words repeat; operator 9 gets all of them.
    places = rows.groupBy("node").agg(
        F.min_by(F.struct(place.alias("place"), "bits", "n", "fp"), place).alias("p"), F.count(F.lit(1)).alias("many"), F.collect_set("fp").alias("fps"))
    alone = written(places.select("node", "p.*", "many", "fps", F.col("node").alias("root")), "copy-places")
    slim = written(rows.drop("keys", "n", "bits", "fp"), "copy-rows")
    discard(rows)
    rows = slim
    known = _by_fingerprint(alone, width)
    known_roots = components(known).withColumnRenamed("root", "known_root")
    places = alone.drop("fp", "fps", "many").join(known_roots, "node", "left")
    places = written(places.withColumn("root", F.coalesce("known_root", "root")).drop("known_root"), "copy-places")
    discard(alone)
    roots = _groups(keyed, places, known, crowd, width).withColumnRenamed("node", "n1")
    discard(keyed, places, known)
    classes = rows.select("node").distinct().join(roots, F.col("node") == F.col("n1"), "left").select(
        "node", F.coalesce("root", "node").alias("root"))
    return rows.join(classes, "node")
