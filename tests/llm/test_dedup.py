"""Near-duplicates, repeated passages and components against brute force."""

import random
from collections import Counter

import numpy as np
import pytest

from helpers import WORDS, corpus, empty, frame, prose, row, sha, vocabulary
from weftline.llm import minhash, superkmer
from weftline.llm.components import components


def roots(nodes, links):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_components_of_a_chain_a_star_and_loops(spark):
    rng = random.Random(2)
    links = [(i, i + 1) for i in range(60)] + [(500, 501 + i) for i in range(200)] + [(7, 7), (900, 901), (901, 900), (900, 901)]
    links += [(rng.randrange(1000, 1200), rng.randrange(1000, 1200)) for _ in range(150)]
    got = {r["id"]: r["component"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    want = roots({x for link in links for x in link}, links)
    assert got == {n: c for n, c in want.items() if n in got}
    assert set(got) == {x for a, b in links if a != b for x in (a, b)}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def shingles(text, n):
    words = [w.lower() for w in WORDS.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))]
    return {tuple(words[i:i + n]) for i in range(len(words) - n + 1)} if len(words) >= n else ({tuple(words)} if words else set())


def brute_groups(rows, n, percent):
    """Component by id; rows with one id are one node."""
    sets = [(r[0], shingles(r[1], n)) for r in rows if r[0] is not None]
    links = []
    for i, (a, x) in enumerate(sets):
        for b, y in sets[:i]:
            if x and y and 100 * len(x & y) >= percent * len(x | y):
                links.append((a, b))
    return roots({a for a, _ in sets}, links)


@pytest.mark.parametrize("n,percent", [(3, 85), (5, 80)])
def test_near_duplicates_match_brute_force(spark, n, percent):
    rows = corpus()
    got = minhash.near_duplicates(frame(spark, rows), n, percent).collect()
    want = brute_groups(rows, n, percent)
    assert len(got) == len(rows)
    assert Counter((r["doc_id"], r["n_shingles"]) for r in got) == Counter((r[0], len(shingles(r[1], n))) for r in rows)
    for r in got:
        if r["doc_id"] is not None:
            assert r["component_id"] == want[r["doc_id"]], r
            assert r["kept"] == (r["doc_id"] == r["component_id"])
        else:
            assert not r["kept"]


def test_a_chain_of_near_copies_in_one_bucket_is_one_group(spark):
    """Neighbours of the chain are linked, its ends are not, so the central members do not meet all of their links."""
    rng, words = random.Random(9), vocabulary(9)
    base = prose(rng, words, 60).split(" ")
    rows = []
    for i in range(40):
        rows.append(row(i, " ".join(base)))
        base[rng.randrange(60)] = rng.choice(words) + str(i)
    got = {r["doc_id"]: r["component_id"] for r in minhash.near_duplicates(frame(spark, rows), 3, 85).collect()}
    assert got == brute_groups(rows, 3, 85)


def test_signatures_estimate_similarity():
    a = np.unique(np.random.default_rng(1).integers(0, 2**63, 1000, np.uint64))
    b = np.unique(np.concatenate([a[:900], np.random.default_rng(2).integers(0, 2**63, 100, np.uint64)]))
    x, y = minhash.signatures([a, b])
    assert abs((x == y).mean() - 900 / 1100) < 0.2


def test_near_duplicates_of_nothing(spark):
    assert minhash.near_duplicates(empty(spark)).count() == 0
    only = minhash.near_duplicates(frame(spark, [row(5, None), row(6, " ")])).collect()
    assert {(r["doc_id"], r["n_shingles"], r["component_id"], r["kept"]) for r in only} == {(5, 0, 5, True), (6, 0, 6, True)}


def brute_repeats(rows, k=13):
    key = lambda i: 2**63 - 1 if i is None else i
    least = {}
    for r in rows:
        words = WORDS.findall(r[1] or "")
        for j in range(len(words) - k + 1):
            w = tuple(words[j:j + k])
            least[w] = min(least.get(w, 2**64), key(r[0]))
    out = []
    for r in rows:
        words = WORDS.findall(r[1] or "")
        gone = [False] * len(words)
        for j in range(len(words) - k + 1):
            if least[tuple(words[j:j + k])] < key(r[0]):
                gone[j:j + k] = [True] * k
        out.append((r[0], len(words), sum(gone), sha(" ".join(w for w, g in zip(words, gone) if not g))))
    return Counter(out)


@pytest.mark.parametrize("m,bytes_", [(3, 16 << 20), (1, 2000), (13, 500)])
def test_repeats_match_brute_force(spark, m, bytes_):
    whole = superkmer.BUCKET_BYTES
    superkmer.repeated_spans.__defaults__ = (13, m, bytes_)
    try:
        rows = corpus(4)
        got = superkmer.without_repeats(frame(spark, rows), 13, m).collect()
    finally:
        superkmer.repeated_spans.__defaults__ = (13, 3, whole)
    assert Counter((r["doc_id"], r["n_words"], r["n_removed"], sha(r["kept"])) for r in got) == brute_repeats(rows)


def test_windows_are_compared_word_by_word(monkeypatch):
    """With a hash that cannot tell windows apart the groups are still right."""
    rng = np.random.default_rng(3)
    codes = rng.integers(0, 2, 400)
    starts = np.arange(400 - 13 + 1)
    monkeypatch.setattr(superkmer, "gram_hashes", lambda x, k: np.zeros(len(x) - k + 1, np.uint64))
    group = superkmer.equal_groups(codes, starts, 13)
    windows = [tuple(codes[s:s + 13]) for s in starts]
    assert len(set(group)) == len(set(windows)) == len(set(zip(group, windows)))


def test_sliding_least():
    x = np.random.default_rng(0).integers(0, 100, 50)
    for width in (1, 2, 3, 7, 8, 11, 50):
        assert superkmer.sliding_least(x, width).tolist() == [x[i:i + width].min() for i in range(50 - width + 1)]


def test_large_buckets_are_taken_in_parts(spark, monkeypatch):
    import pyarrow as pa
    rows = [r for r in corpus(6) if r[0] is not None]
    batch = pa.record_batch([pa.array([r[0] for r in rows]), pa.array([hash(r[1]) % 10**9 for r in rows]), pa.array([r[1] or "" for r in rows])], ["doc_id", "h", "text"])
    packs = [x.as_py() for b in superkmer.pack_batches([batch], 1, 13, 3) for x in b.column("data")]
    spans = lambda: Counter(r for b in superkmer.bucket_spans(packs, 13) for r in zip(*(c.to_pylist() for c in b.columns)))
    whole = spans()
    monkeypatch.setattr(superkmer, "SORT_BYTES", 1000)
    assert spans() == whole and whole


def test_repeats_of_nothing(spark):
    assert superkmer.without_repeats(empty(spark)).count() == 0
