"""Lexical search, substring deduplication and token alignment against plain Python."""

from __future__ import annotations

import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from casewright.llm import catalog, lexical_search, substring_dedup, text_store, token_alignment, token_files
from casewright.llm.common import table
from test_llm_operators import SF, documents, lower_az, messy

ROW = "doc_id long, text string"


# --- ranked lexical search ----------------------------------------------------------------

def plain_terms(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", lower_az(text))


def plain_search(docs, items, top=20):
    """``docs`` and ``items`` as lists of (id, text); every document is scored."""
    counted = [(i, Counter(plain_terms(t))) for i, t in docs]
    counted = [(i, c) for i, c in counted if c]
    n_docs, n_terms = len(counted), sum(sum(c.values()) for _, c in counted)
    holders = Counter(t for _, c in counted for t in c)
    out = []
    for item, text in items:
        scores = []
        for i, c in counted:
            m, score = 75 + (25 * sum(c.values()) * n_docs) // n_terms, 0
            for t in plain_terms(text):
                w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * holders[t] + 1)))
                score += w * ((10**9 * c[t]) // (1000 * c[t] + 12 * m))
            if score > 0:
                scores.append((-score, i is None, i or 0))
        out += [(item, r, None if null else i, -s) for r, (s, null, i) in enumerate(sorted(scores)[:top], 1)]
    return sorted(out, key=str)


def searched(docs, items, **how):
    return sorted(map(tuple, lexical_search.search(docs, items, **how).collect()), key=str)


def crowd(n=400, seed=5):
    """Texts over a few frequent and many rare words, some very long, many alike."""
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(600)]
    texts = [" ".join(rng.choices(words, weights=[1 / (i + 1) for i in range(600)], k=rng.choice([1, 5, 40, 40, 400])))
             for _ in range(n)]
    return texts + [texts[0]] * 30 + ["w599 " * 300 + "w598"]


def test_search_equals_scoring_everything(spark):
    texts = crowd()
    docs = [(i, t) for i, t in enumerate(texts)]
    items = [(i, " ".join(random.Random(i).sample(texts[i].split() * 3, min(30, len(texts[i].split()))))) for i in range(25)]
    items += [(90, "w599 w599 w598"), (91, "not there at all"), (92, ""), (93, "w1"), (93, "w1")]
    frame, asked = spark.createDataFrame(docs, ROW).repartition(5), spark.createDataFrame(items, "item_id long, text string")
    want = plain_search(docs, items)
    assert searched(frame, asked) == want
    # Small blocks, saturated filters and many blocks of queries only cost more.
    assert searched(frame, asked, block_docs=7, bits=2, gather_bytes=4000, block_bytes=400) == want


def test_search_awkward(spark):
    docs = [(r["doc_id"], r["text"]) for r in messy(spark).collect()]
    items = [(1, "several WORDS of text"), (None, "ÀÉ é 漢字 12"), (2, None), (3, "wide words of one very long text"), (4, "---")]
    asked = spark.createDataFrame(items, "item_id long, text string").withColumn("rank", F.lit("x"))
    assert searched(messy(spark), asked) == plain_search(docs, [x for x in items if x[1]])
    empty = spark.createDataFrame([], ROW)
    assert searched(empty, asked) == [] and searched(messy(spark), asked.limit(0)) == []
    named = messy(spark).withColumn("doc_id", F.concat(F.lit("d"), "doc_id"))
    assert {r[2] for r in searched(named, asked) if r[0] == 1} == {"d1", "d2", "d6", None}


def test_bounds_hold_and_exclude():
    rng = random.Random(2)
    texts = [t.encode() for t in crowd(300)]
    counted = [Counter(lexical_search.terms(t)) for t in texts]
    found = [(lexical_search._hashes(c), np.fromiter(c.values(), np.int64, len(c))) for c in counted]
    n = np.array([c.total() for c in counted])
    queries = lexical_search.Queries([(str(i), b" ".join(rng.sample(texts[i].split(), min(8, len(texts[i].split()))))) for i in range(40)])
    holders = Counter(h for f, _ in found for h in f.view(np.int64).tolist())
    queries.weigh(holders, len(texts), int(n.sum()))
    m, most = queries.lengths(n), np.array([max(c.values()) for c in counted])
    sizes = [int(np.searchsorted(lexical_search.LEVELS, c, "right").sum()) for _, c in found]
    share = []
    for bits in (16, 1):
        width = max(64, bits * max(sizes))
        slices = np.frombuffer(lexical_search._signature(found, width, 6), np.uint8).reshape(width, -1)
        bounds = lexical_search.upper_bounds(queries, slices, m, most, 6)
        exact = np.array([[int((r * queries.weights[o] * lexical_search._gain(lexical_search.exact_counts(queries, t)[o], x)).sum())
                           for t, x in zip(texts, m, strict=True)] for o, r in queries.of])
        assert (bounds >= exact).all()
        least = np.maximum(np.sort(exact, axis=1)[:, -20], 1)
        share.append((bounds >= least[:, None]).sum() / (exact >= least[:, None]).sum())
    assert share[0] < 2.5


def test_text_store(spark, tmp_path):
    texts = [b"", b"x" * 100_000, "é 漢字".encode()] * 5
    with text_store.TextWriter(f"file://{tmp_path}") as w:
        places = w.add(texts[:7]) + w.add(texts[7:])
    assert [text_store.fetch(*p) for p in places] == texts
    assert [text_store.fetch(*p) for p in reversed(places)] == texts[::-1]


# --- substring deduplication --------------------------------------------------------------

def plain_repeats(docs, window):
    """(id, n_words, n_removed, kept) by comparing every window with every other."""
    split = [(i, re.findall(r"[^\x20\x09-\x0D]+", t or "")) for i, t in docs]
    least = {}
    for i, w in split:
        for a in range(len(w) - window + 1):
            g = tuple(w[a:a + window])
            if i is not None:
                least[g] = min(least.get(g, i), i)
    out = []
    for i, w in split:
        gone = set()
        for a in range(len(w) - window + 1):
            first = least.get(tuple(w[a:a + window]))
            if first is not None and (i is None or first < i):
                gone |= set(range(a, a + window))
        out.append((i, len(w), len(gone), " ".join(x for j, x in enumerate(w) if j not in gone)))
    return sorted(out, key=str)


def deduplicated(docs, window):
    got = substring_dedup.without_repeats(docs, window=window).collect()
    return sorted([(r["doc_id"], r["n_words"], sum(s["end"] - s["first"] for s in r["spans"]), r["kept"]) for r in got], key=str)


@pytest.mark.parametrize("period", sorted(substring_dedup.COVERS))
def test_cover_meets_every_shift(period):
    cover = set(substring_dedup.COVERS[period])
    assert all(any((i + d) % period in cover and (j + d) % period in cover for d in range(period))
               for i in range(period) for j in range(period))
    for n in (0, 1, period, 3 * period + 5):
        assert substring_dedup.anchor_places(n, period).tolist() == [i for i in range(n) if i % period in cover]


def test_rolled_hashes_tell_runs_apart():
    words = np.random.default_rng(1).integers(0, 4, 3000).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    for width in (1, 2, 7, 20, 50):
        h = substring_dedup.rolled(words, width)
        runs = [tuple(words[i:i + width].tolist()) for i in range(len(words) - width + 1)]
        assert len(h) == len(runs) and len(set(h.tolist())) == len(set(runs)) == len(set(zip(h.tolist(), runs, strict=True)))


@pytest.mark.parametrize("window", [1, 4, 12, 50])
def test_substring_dedup_equals_all_windows(spark, window):
    rng = random.Random(window)
    shared = [[f"s{k}x{i}" for i in range(3 * window)] for k in range(6)]
    docs = []
    for i in range(120):
        words = [f"d{i}x{j}" for j in range(rng.randrange(2 * window + 3))]
        for _ in range(rng.randrange(4)):  # pieces just below, at and above the window, anywhere
            part, a = rng.choice(shared), rng.randrange(2 * window)
            at = rng.randrange(len(words) + 1)
            words[at:at] = part[a:a + rng.choice([max(1, window - 1), window, window + 1, 2 * window])]
        docs.append((rng.choice([i, i, i, i // 2]), rng.choice([" ", "\n", " \t"]).join(words)))
    docs += [(200 + i, docs[7][1]) for i in range(20)] + [(None, docs[7][1]), (None, docs[9][1]), (None, docs[9][1])]
    frame = spark.createDataFrame(docs, ROW).repartition(6)
    got = deduplicated(frame, window)
    assert got == plain_repeats(docs, window) and any(r[2] for r in got)


def test_substring_dedup_awkward(spark):
    docs = [(r["doc_id"], r["text"]) for r in messy(spark).collect() if r["text"] is None or len(r["text"]) < 1000]
    small = messy(spark).where("text IS NULL OR length(text) < 1000")
    assert deduplicated(small, 4) == plain_repeats(docs, 4)
    long = {r[0]: r for r in deduplicated(messy(spark), 50)}
    assert long[6][1:3] == (280_000, 0)  # repeats within one document stay
    assert deduplicated(spark.createDataFrame([], ROW), 50) == []


def test_substring_windows_are_never_broadcast(spark, monkeypatch):
    """A few short rows become very many windows, whatever size Spark takes them for."""
    plans, held = {}, substring_dedup.written

    def seen(rows, purpose):
        plans[purpose] = rows._jdf.queryExecution().executedPlan().toString()
        return held(rows, purpose)

    monkeypatch.setattr(substring_dedup, "written", seen)
    shared = " ".join(f"w{i}" for i in range(4000))
    docs = [(2, "a " + shared), (1, "b " + shared), (None, shared + " c"), (None, "d")]
    got = deduplicated(spark.createDataFrame(docs, ROW), 50)
    assert got == plain_repeats(docs, 50) and sum(r[2] for r in got) == 8000
    below = None
    for line in plans["repeat-spans"].splitlines():
        depth = max(line.find("+- "), line.find(":- "))
        if below is not None and depth <= below:
            below = None
        if below is None and "BroadcastExchange" in line:
            below = depth
        assert below is None or "MapInArrow" not in line, plans["repeat-spans"]


def test_substring_query_on_documents(spark):
    got = {r["doc_id"]: r for r in catalog.ENTRIES["op12_substring_dedup"].run(spark, SF).collect()}
    for i, n, gone, kept in plain_repeats(list(documents(spark).items()), 50):
        assert (got[i]["n_words"], got[i]["n_removed"]) == (n, gone)
        assert got[i]["kept_sha256"] == hashlib.sha256(kept.encode()).hexdigest()


# --- cross-tokenizer alignment ------------------------------------------------------------

def plain_alignment(docs):
    """Per row: (id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups)."""
    a = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    letters, names = token_alignment._byte_letters(), {i: t for t, i in a.get_vocab().items()}
    linked, rows = [], []
    for i, text in docs:
        x = a.encode(" " + text, add_special_tokens=False).ids if text else []
        y = b.encode(text) if text else []
        bx = [bytes(letters[c] for c in names[t]) for t in x]
        by = [bytes([int(b.id_to_piece(t)[3:5], 16)]) if b.is_byte(t) else b.id_to_piece(t).replace("▁", " ").encode() for t in y]
        if not text or b"".join(bx) != (" " + text).encode() or b"".join(by) != (" " + text).encode():
            x = y = bx = by = []
        ends = [np.cumsum([len(p) for p in parts]).tolist() for parts in (bx, by)]
        links, p, q, n_cuts, groups, of_a, of_b = [], 0, 0, 0, [], [], []
        while p < len(x):
            links.append((x[p], y[q]))
            at = min(ends[0][p], ends[1][q])
            both = ends[0][p] == ends[1][q]
            if ends[0][p] == at:
                of_a, p = [*of_a, str(x[p])], p + 1
            if ends[1][q] == at:
                of_b, q = [*of_b, str(y[q])], q + 1
            if both:
                groups.append(",".join(of_a) + "|" + ",".join(of_b))
                n_cuts, of_a, of_b = n_cuts + 1, [], []
        linked.append(links)
        rows.append((i, len(x), len(y), n_cuts, len(links), ";".join(groups)))
    count = Counter(pair for links in linked for pair in set(links))
    most = defaultdict(int)
    for (t, _), n in count.items():
        most[t] = max(most[t], n)
    return sorted([(*r[:5], sum(count[k] == most[k[0]] for k in links), sum(count[k] for k in links), r[5])
                   for r, links in zip(rows, linked, strict=True)], key=str)


def aligned(docs, **how):
    return sorted(map(tuple, token_alignment.align(docs, **how).collect()), key=str)


ODD = ["<|endoftext|> and <s> </s> <0x41>", "▁ in the text", "a▁b", "two  spaces   and\ttabs \n\n lines\n", " leading", "trailing ",
       "nul \x00 byte", "🙂🙂 漢字かな ñandú é é", "it's we'll THEY'RE 1234567 12,5", "x" * 3000, " no　break lines", "﻿mark", " ", "\n"]


def test_alignment_equals_merging_ends(spark):
    docs = [(r["doc_id"], r["text"]) for r in messy(spark).collect() if r["text"] is None or len(r["text"]) < 1000]
    docs += [(100 + i, t) for i, t in enumerate(ODD)] + list(documents(spark).items())[:60]
    want, frame = plain_alignment(docs), spark.createDataFrame(docs, ROW).repartition(4)
    assert aligned(frame) == want
    assert aligned(frame, chunk_links=500, slice_chars=300, remembered=1 << 16) == want
    assert any(r[1] == 0 and r[0] == 101 for r in want)  # the piece that stands for a space does not come back


def test_alignment_awkward(spark):
    got = {(r["doc_id"], r["n_a"]) for r in token_alignment.align(messy(spark).withColumn("chunk", F.lit(1))).collect()}
    assert {i for i, n in got if n == 0} == {3, 4, None} and max(n for i, n in got if i == 6) > 200_000
    assert aligned(spark.createDataFrame([], ROW)) == []


def test_pieces_give_what_whole_texts_give():
    pair = token_alignment.TokenizerPair("byte_bpe_50k.json", "piece_bpe_32k.model")
    assert pair.cuts
    rng = random.Random(4)
    marks = ["word", "it's", "  ", "\n", ".", "漢", "é", "_", "12", "'", " a", " ", "▁", "\t"]
    texts = ["".join(rng.choice(marks) + rng.choice([" ", "", " "]) for _ in range(rng.randrange(1, 30))) for _ in range(400)]
    cut = [pair.pieces(t) for t in texts]
    pair.learn({p for pieces in cut for p in pieces})
    pair.learn(set(texts))

    def shown(p):
        return pair.text()[pair.text_ends[p]:pair.text_ends[p + 1]]

    def links(p):
        return pair.links()[pair.link_ends[p]:pair.link_ends[p + 1]].tolist()

    for text, pieces in zip(texts, cut, strict=True):
        whole, parts = pair.number[text], [pair.number[p] for p in pieces]
        assert pair.valid[whole] == all(pair.valid[p] for p in parts)
        if pair.valid[whole]:
            assert shown(whole) == b";".join(shown(p) for p in parts)
            assert links(whole) == [k for p in parts for k in links(p)]


def test_shared_cuts_equal_intersection():
    rng = np.random.default_rng(3)
    for step in (2, 5, 40):
        for _ in range(60):
            end = int(rng.integers(1, 400))
            a, b = (np.union1d(np.cumsum(rng.integers(1, step, 300)), [end]) for _ in range(2))
            a, b = a[a <= end], b[b <= end]
            cuts_a, cuts_b = token_alignment.shared_cuts(a, b, [[len(a), len(b)]])
            assert a[cuts_a - 1].tolist() == b[cuts_b - 1].tolist() == np.intersect1d(a, b).tolist()


# --- token files with another tokenizer -----------------------------------------------------

def test_other_tokenizers_encode_whole_texts():
    text = "Hello big world, two  spaces\nand it's 12"
    words = token_files.WordEncoder("byte_bpe_50k.json")
    want = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")).encode(text, add_special_tokens=False).ids
    assert not words.by_chunk and np.frombuffer(words.encode(text.encode()), words.kind).tolist() == want
    plain = token_files.WordEncoder("word_bpe_49k.json", most=2000)
    for i in range(300):  # what is remembered stays bounded
        plain.encode(f"word{i} other{i}".encode())
    assert plain.by_chunk and plain._bytes < 4000


def test_plain_chunks_are_split_as_the_library_splits(monkeypatch):
    words, rng = token_files.WordEncoder("word_bpe_49k.json"), random.Random(1)
    letters = [chr(c) for c in (*range(0x21, 0x7F), *range(0xA0, 0x100))] + ["<|", "|>", " ", "'s", "'LL", "İ", "\x1c", "\x85"]
    for text in ("".join(rng.choices(letters, k=rng.randrange(1, 30))) for _ in range(3000)):
        ids = np.frombuffer(words.encode(text.encode()), words.kind).tolist()
        assert ids == words.tokenizer.encode(text, add_special_tokens=False).ids, text
    want = words.tokenizer.encode("Entirely Plain", add_special_tokens=False).ids
    monkeypatch.setattr(token_files, "_PLAIN", None)  # ASCII letters need no pattern
    assert np.frombuffer(words.encode(b"Entirely Plain"), words.kind).tolist() == want
