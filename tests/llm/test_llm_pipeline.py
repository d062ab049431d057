"""The pipeline stage by stage against plain Python, and queries against their SQL."""

from __future__ import annotations

import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
import test_llm_operators as plain
from casewright.llm import catalog, language_id, mixing, near_copies
from casewright.llm.common import table, written
from casewright.llm.simhash import fingerprint
from tools.check_queries import compare, connect

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


@pytest.mark.parametrize("name", [n for n, e in catalog.ENTRIES.items() if e.sql])
def test_query_equals_its_sql(spark, duck, name):
    ok, text = compare(spark, duck, name, SF)
    assert ok, text


def test_one_query_per_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in catalog.ENTRIES) == list(range(1, 14))


def kept(docs):
    return {(r["doc_id"], r["text"]) for r in docs.collect()}


def plain_first_copies(docs):
    """Smallest identifiers of groups by 5-word Jaccard 0.8, every pair compared."""
    docs = sorted(docs)
    sets, root = [plain_shingles(t) for _, t in docs], list(range(len(docs)))
    links = [(i, j) for i in range(len(sets)) for j in range(i)
             if sets[i] == sets[j] or 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j])]
    for _ in root:
        for i, j in links:
            root[i] = root[j] = min(root[i], root[j])
    return {docs[r][0] for r in root}


def test_stages(spark):
    docs = table(spark, SF, "documents")
    columns, stages = docs.columns, [f for _, f in corpus_pipeline.STAGES]
    bench = [(str(r["item_id"]), r["text"]) for r in table(spark, SF, "benchmark").collect()]

    first = written(stages[0](spark, docs, SF), "t")
    model = language_id.fit(docs, F.lit(True))
    assert kept(first) == kept(language_id.identify(docs, model).where("NOT rejected"))

    second = written(stages[1](spark, first, SF), "t")
    assert {i for i, _ in kept(second)} == plain_first_copies(kept(first)) and second.count() < first.count()

    third = written(stages[2](spark, second, SF), "t")
    marked = plain.plain_contamination(kept(second), bench)
    assert {i for i, _ in kept(third)} == {i for i, m in marked.items() if not m[4]}

    fourth = written(stages[3](spark, third, SF), "t")
    taken = {r["doc_id"]: r["copies"] for r in mixing.mix(third).collect() if r["copies"]}
    assert Counter(r["doc_id"] for r in fourth.collect()) == taken
    assert all(d.columns == columns for d in (first, second, third, fourth))

    rows = sorted((r["doc_id"], r["text"]) for r in fourth.collect())
    at, want = 0, []
    for (i, _), ids in zip(rows, plain.plain_tokens(rows), strict=True):
        want.append((i, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    got = stages[4](spark, fourth, SF).select("doc_id", "start", "n_tokens", "ids_crc32").collect()
    assert sorted(map(tuple, got)) == want


def awkward(spark):
    """The messy rows with columns that operators use themselves, and a map."""
    docs = plain.messy(spark).withColumn("n_chars", F.length("text").cast("long"))
    return docs.withColumns({"copies": F.lit(7), "rejected": F.lit(True), "key_1": F.lit("k"), "in_0": F.lit(None).cast("int"),
                             "m": F.create_map(F.lit("a"), F.lit(1))})


def test_stages_take_awkward_tables(spark):
    docs = awkward(spark)
    out = docs
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = written(stage(spark, out, SF), "t")
        assert out.columns == docs.columns and 0 < out.count() <= 2 * docs.count()
        assert all(r["copies"] == 7 and r["key_1"] == "k" for r in out.collect())
        names = [r["doc_id"] for r in out.collect()]
        assert None not in names or names.count(None) <= 2
    assert corpus_pipeline.STAGES[-1][1](spark, out, SF).count() == out.count()


def test_near_copies_keep_one_row_each(spark):
    text = "one text that stands in many rows of this table"
    rows = [(3, text), (3, text), (3, text + "!"), (1, text), (1, text), (None, "x y"), (None, "x y"), (9, "other")]
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars int")
    got = Counter((r["doc_id"], r["text"]) for r in corpus_pipeline.drop_near_copies(spark, docs, SF).collect())
    assert max(got.values()) == 1 and (1, text) in got and (None, "x y") in got and (9, "other") in got


def plain_shingles(text):
    words = text.encode().lower().split()
    return {tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


@pytest.mark.parametrize("crowd", [3, 64])
def test_near_copies_are_those_of_brute_force_jaccard(spark, crowd):
    rng = random.Random(5)
    word = lambda: "".join(rng.choices("abcdefgh", k=4))
    line, texts = [word() for _ in range(60)], []
    for size in (7, 30, 90, 400):
        for lead in ([], line, line[:20]):
            base = lead + [word() for _ in range(size)]
            for edits in (0, 0, 1, 1, 2, 3, 5, 8):
                copy = list(base)
                for _ in range(edits):
                    copy[rng.randrange(len(copy))] = word()
                texts.append(" ".join(copy))
    texts += [" ".join(line), "", " ", "Two words", "two  words", "two other"]
    sets = [plain_shingles(t) for t in texts]
    links = {(i, j) for i in range(len(sets)) for j in range(i)
             if sets[i] == sets[j] or 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j])}
    root = list(range(len(sets)))
    for _ in root:
        for i, j in links:
            root[i] = root[j] = min(root[i], root[j])
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumn("k", F.col("doc_id"))
    got = near_copies.near_copies(docs, carry=["k"], crowd=crowd, common=3, sample=1).collect()
    least = {}
    for r in got:
        least[r["root"]] = min(r["doc_id"], least.get(r["root"], r["doc_id"]))
    assert len(got) == len(texts) and {r["doc_id"]: least[r["root"]] for r in got} == dict(enumerate(root))
    frame = docs.select("doc_id", "text", F.lit("en").alias("lang"), F.lit("s").alias("source"))
    assert {i for i, _ in kept(corpus_pipeline.drop_near_copies(spark, frame, SF))} == set(root)


def test_near_copies_are_linked_by_fingerprints_first(spark, monkeypatch):
    rng = random.Random(8)
    word = lambda: "".join(rng.choices("abcdefgh", k=5))
    texts = []
    for _ in range(4):
        base = [word() for _ in range(300)]
        texts += [" ".join(base[:i] + [word()] + base[i + 1:]) for i in (0, 100, 150, 200, 299)] + [" ".join(base)] * 2
    texts.append(" ".join(word() for _ in range(300)))
    found, held = [], near_copies._by_fingerprint

    def seen(places, width):
        links, fps = held(places, width), {r["node"]: r["fp"] for r in places.collect()}
        found.append(([tuple(r) for r in links.select("a", "b").collect()], fps))
        return links

    monkeypatch.setattr(near_copies, "_by_fingerprint", seen)
    got = near_copies.near_copies(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), sample=1).collect()
    (links, fps), = found
    sets = {r["node"]: plain_shingles(texts[r["doc_id"]]) for r in got}
    assert all(5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b]) for a, b in links)

    def parts(pairs):
        root = {n: n for n in fps}
        for _ in root:
            for a, b in pairs:
                root[a] = root[b] = min(root[a], root[b])
        return Counter(root.values())

    mask = (1 << 64) - 1
    near = [(a, b) for a in fps for b in fps if a < b and ((fps[a] ^ fps[b]) & mask).bit_count() <= 2]
    assert near and parts(links) == parts(near)
    assert sorted(Counter(r["root"] for r in got).values()) == [1, 7, 7, 7, 7]


def chain_by_fingerprints():
    """Three texts, each near the next by shingles and by one or two bits; the ends are too far apart by shingles."""
    near = lambda x, y: 5 * len(x & y) >= 4 * len(x | y)
    for seed in range(1000):
        rng = random.Random(seed)
        word = lambda: "".join(rng.choices("abcdefgh", k=5))
        often, tail = [word() for _ in range(4)] * 200, [word() for _ in range(60)]
        tails = [tail, tail[:20] + [word()] + tail[21:], tail[:20] + [word()] + tail[21:]]
        tails[2] = tails[1][:40] + tails[2][20:21] + tails[1][41:]
        texts = [" ".join(often + t) for t in tails]
        z, y, x = (plain_shingles(t) for t in texts)
        bits = [fingerprint(t.encode()) for t in texts]
        if near(z, y) and near(y, x) and not near(z, x) and all(0 < (a ^ b).bit_count() <= 2 for a, b in zip(bits, bits[1:], strict=False)):
            return texts
    raise AssertionError("no such texts")


def test_operator_nine_sees_all_texts_and_all_its_links_are_verified(spark, monkeypatch):
    z, y, x = chain_by_fingerprints()
    texts = [z, z, z, y, x, "a text that shares nothing with any other one", "one two three four five six", ""]
    seen, called, held, operator = [], [], near_copies._by_fingerprint, near_copies.near_duplicates

    def linked(places, width):
        links = held(places, width)
        seen.append({tuple(sorted(r)) for r in links.select("a", "b").collect()})
        return links

    def grouped(docs, **how):
        called.append({r[how["fp_col"]] & (1 << 64) - 1 for r in docs.collect()})
        return operator(docs, **how)

    monkeypatch.setattr(near_copies, "_by_fingerprint", linked)
    monkeypatch.setattr(near_copies, "near_duplicates", grouped)
    got = near_copies.near_copies(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), sample=1).collect()
    node = {r["doc_id"]: r["node"] for r in got}
    assert called == [{fingerprint(t.encode()) for t in texts}]
    assert seen == [{tuple(sorted((node[0], node[3]))), tuple(sorted((node[3], node[4])))}]
    assert sorted(Counter(r["root"] for r in got).values()) == [1, 1, 1, 5]


def test_bitmaps_never_differ_in_more_bits_than_sets_do_in_shingles():
    rng = random.Random(3)
    sets = [near_copies.shingles(" ".join(rng.choices("abcd", k=n)).encode()) for n in (0, 1, 6, 40, 300, 2000) for _ in range(5)]
    for x in sets:
        for y in sets:
            bits = sum(int(v).bit_count() for v in (near_copies.parity(x) ^ near_copies.parity(y)).view(np.uint64))
            assert bits <= len(np.setxor1d(x, y)) and len(near_copies.parity(x)) * 64 == 512


def test_stages_take_empty_tables(spark):
    docs = table(spark, SF, "documents").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
        assert docs.count() == 0


def test_run(spark):
    rows = corpus_pipeline.run(spark, SF).collect()
    by_start = sorted(rows, key=lambda r: r["start"])
    assert [r["start"] for r in by_start] == [0, *np.cumsum([r["n_tokens"] for r in by_start])[:-1].tolist()]
    assert [r["doc_id"] for r in by_start] == sorted(r["doc_id"] for r in rows)
