"""Prefix trie, spelling variants and toxicity against brute force and planted cases."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict
from itertools import combinations

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from helpers import DOCS, corpus, empty, frame, prose, row, vocabulary
from weftline.llm import prefixtrie, spelling, toxicity

TURNS = "conv_id long, turn long, role string, text string, depth string, n string, key string"


def numbered_in_python(rows):
    def tid(role, text):
        role, text = role or "", text or ""
        return hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()[:32]

    convs = defaultdict(list)
    for c, turn, role, text, *_ in rows:
        if c is not None:
            convs[c].append((turn is not None, turn or 0, tid(role, text), role or "", text or ""))
    return {c: [t[3:] for t in sorted(ts)] for c, ts in convs.items()}


def rebuilt_in_python(convs):
    out = {}
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % 6
        base = c - int(np.fmod(c, 100))
        out[c] = convs.get(base, [])[:h] + own[h:]
    return out


def trie_in_python(convs):
    members = defaultdict(list)
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    kids = Counter(p[:-1] for p in members if p)
    leaves, saved = Counter(), Counter()
    for p, ids in members.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += kids[p] == 0
            saved[p[:d]] += (len(ids) - 1) * len(p[-1][1]) if p else 0
    return sorted((
        min(ids), len(p), min(members[p[:-1]]) if p else None, len(ids), kids[p], leaves[p], saved[p],
        hashlib.sha256(",".join(str(c) for c in sorted(c for c in ids if len(convs[c]) == len(p))).encode()).hexdigest(),
    ) for p, ids in members.items()) if convs else []


NODE_COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def key(t):
    return tuple((x is not None, x) for x in t)


def spark_trie(spark, rows, **options):
    turns = prefixtrie.numbered(spark.createDataFrame([(*r, "x", "x", "x") for r in rows], TURNS).repartition(3))
    lead, base = F.crc32(F.col("conv_id").cast("string")) % 6, F.col("conv_id") - F.col("conv_id") % 100
    got = prefixtrie.trie(prefixtrie.rebuilt(turns, lead, base, 5), **options).select(NODE_COLUMNS)
    return sorted((tuple(r) for r in got.collect()), key=key)


def conversations(seed, n, kinds=4):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        c = rng.choice([i, i, 100 * i, -i - 1, 1000 + i])
        for t in range(rng.choice([0, 1, 2, 3, 5, 8])):
            turn = None if rng.random() < 0.05 else t
            rows.append((c, turn, rng.choice(["user", "assistant", None]), rng.choice(["a", "", None, "😀 é", "\x00", *"bcd"][:kinds + 4])))
    return rows


@pytest.mark.parametrize("seed, tree_bytes", [(1, 1 << 20), (2, 64), (3, 300), (4, 1)])
def test_trie_is_that_of_brute_force_at_any_run_length(spark, seed, tree_bytes):
    rows = conversations(seed, 80)
    rows += rows[:5]  # repeated rows are turns of their own
    rows += [(None, 0, "user", "no id"), (5000, 0, None, None)]
    rows += [(c, t, "user", "same") for c in range(300, 340) for t in range(6)]  # one very common conversation
    rows += [(c, t, "user", "deep") for c in (600, 601) for t in range(90)]
    want = sorted(trie_in_python(rebuilt_in_python(numbered_in_python(rows))), key=key)
    assert spark_trie(spark, rows, tree_bytes=tree_bytes) == want


def test_trie_of_nothing_and_of_turnless_conversations(spark):
    assert spark_trie(spark, []) == []
    assert spark_trie(spark, [(None, 0, "user", "x")]) == []
    # Conversation 1 leads with more turns than it has and has no base: nothing is left.
    lonely = next(c for c in range(1, 99) if zlib.crc32(str(c).encode()) % 6 >= 1)
    none = hashlib.sha256(str(lonely).encode()).hexdigest()
    assert spark_trie(spark, [(lonely, 0, "user", "x")]) == [(lonely, 0, None, 1, 0, 1, 0, none)]


def test_ids_of_a_common_conversation_are_hashed_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(prefixtrie, "CHUNK_BYTES", 16)
    batch = pa.RecordBatch.from_pydict({"digest": pa.array([b"a"] * 50 + [b"b"] * 3, pa.binary()), "conv_id": pa.array([*range(50), *range(3)], pa.int64())})
    pieces = list(prefixtrie.joined_ids([batch.slice(0, 20), batch.slice(20)]))
    assert len(pieces) > 5
    got = {d: h for b in prefixtrie.hashed_ids(pieces) for d, h in zip(b["digest"].to_pylist(), b["ends_sha256"].to_pylist())}
    assert got == {b"a": hashlib.sha256(",".join(map(str, range(50))).encode()).hexdigest(), b"b": hashlib.sha256(b"0,1,2").hexdigest()}


def test_radix_nodes_grow_and_split():
    rng = random.Random(5)
    root, want = prefixtrie.Node(b""), Counter()
    keys = [bytes(rng.choice([rng.randrange(256), 7]) for _ in range(rng.choice([1, 2, 4, 4, 4]))) for _ in range(3000)]
    keys += [b"", b"\x07" * 40, b"\x07" * 20, *(b"long" + bytes([i]) for i in range(30))]
    for k in keys:
        prefixtrie.insert(root, k, 2, len(k))
        want[k] += 2
    got, layouts, stack = {}, set(), [(root, b"")]
    while stack:
        node, path = stack.pop()
        path += node.prefix
        layouts.add(node.layout)
        kids = node.children()
        assert [b for b, _ in kids] == sorted({b for b, _ in kids}) and len(kids) <= node.layout
        assert node is root or node.count or len(kids) > 1  # single children are compressed
        if node.count:
            got[path] = node.count
        stack += [(kid, path + bytes([b])) for b, kid in kids]
    assert got == want and layouts == {4, 16, 48, 256}


# --- spelling ---

def one_edit(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    return any(a[:i] + a[i + (len(a) >= len(b)):] == b[:i] + b[i + (len(b) >= len(a)):] for i in range(max(len(a), len(b))))


def variants_in_python(counts):
    near = defaultdict(list)
    for a, b in combinations(counts, 2):
        if one_edit(a, b):
            near[a].append(b)
            near[b].append(a)
    form = {}
    for w in counts:
        best = min(near[w], key=lambda x: (-counts[x], x), default=None)
        form[w] = best if best is not None and counts[best] >= 2 * counts[w] else None
    out = []
    for w in counts:
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, counts[w], len(near[w]), counts[form[w]] if form[w] else None))
    return sorted(out, key=key)


def spark_variants(df):
    return sorted((tuple(r) for r in df.select("word", "form", "root", "n", "n_near", "form_n").collect()), key=key)


@pytest.mark.parametrize("seed, letters", [(1, "ab"), (2, "abcé"), (3, "abcdefghijklmnop")])
def test_near_words_are_those_of_brute_force(spark, seed, letters):
    rng = random.Random(seed)
    base = ["".join(rng.choice(letters) for _ in range(rng.randint(5, 12))) for _ in range(120)]
    words = set(base) | {"aaaaa", "aaaaaa", "aaaaaaa", "ababab", "bababa", "ab" * 30}
    for w in base[:60]:
        at = rng.randrange(len(w))
        words |= {w[:at] + rng.choice(letters) + w[at:], w[:at] + rng.choice(letters) + w[at + 1:], w[:at] + w[at + 1:]}
    counts = {w: rng.choice([3, 3, 4, 7, 16, 40, 1000]) for w in sorted(words) if len(w) >= 5}
    got = spark_variants(spelling.variants(spark.createDataFrame(list(counts.items()), "word string, n long").repartition(3)))
    assert got == variants_in_python(counts)


def test_chains_of_forms_end_at_their_root(spark):
    counts = {"a" * 4 + "bcdefghij"[:k] + "z" * (9 - k): 2**(k + 2) for k in range(10)}
    got = spark_variants(spelling.variants(spark.createDataFrame(list(counts.items()), "word string, n long")))
    assert got == variants_in_python(counts)
    assert {r[2] for r in got} == {max(counts, key=counts.get)}


def test_words_are_counted_over_whole_texts(spark):
    rng, words = random.Random(3), vocabulary(3, 60) + ["Größe", "ÀÉÎÕÜ", "naïve", "x×y÷z", "abcde"]
    rows = [row(i, "1".join(rng.choice(words).upper() if rng.random() < 0.2 else rng.choice(words) for _ in range(60))) for i in range(80)]
    rows += corpus(4, 30) + [row(None, "abcde abcde")]
    counts = Counter()
    import re
    for doc_id, text, *_ in rows:
        for run in re.findall(r"[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 97 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            if len(run) >= 5:
                counts[run] += 1
    want = {w: n for w, n in counts.items() if n >= 3}
    assert {r["word"]: r["n"] for r in spelling.word_counts(frame(spark, rows)).collect()} == want
    assert any(zlib.crc32(f"{d}:{w}".encode()) % 97 == 0 for d in range(80) for w in words)
    assert spelling.variants(spelling.word_counts(empty(spark))).collect() == []


def test_pivots_have_the_least_cost():
    rng = random.Random(1)
    for _ in range(300):
        places = sorted(rng.sample(range(12), rng.randint(3, 8)))
        costs = [rng.randrange(10) for _ in places]
        a, b = spelling.pivots(places, costs)
        best = min(x + y for (i, x), (j, y) in combinations(zip(places, costs), 2) if abs(i - j) >= 2)
        assert b - a >= 2 and costs[places.index(a)] + costs[places.index(b)] == best


# --- toxicity ---

BAD = ["idiot", "scum", "trash", "moron"]
LABELS = "doc_id long, quality int, toxic int, score string"


def planted(seed, n):
    rng, words = random.Random(seed), vocabulary(seed)
    rows, labels, truth = [], [], {}
    for i in range(n):
        sentences = [prose(rng, words, rng.randint(3, 9)) + rng.choice([".", "!", "\n", " ?"]) for _ in range(rng.randint(1, 30))]
        toxic = i % 4 == 0
        if toxic:
            at = rng.randrange(len(sentences))
            sentences[at] = f"you {rng.choice(BAD)} {rng.choice(BAD).upper()}, " + sentences[at]
            truth[i] = sentences[at].strip()
        rows.append(row(i, " ".join(sentences)))
        labels.append((i, 1, int(toxic), "x"))
    return rows, labels, truth


def test_toxic_documents_and_their_sentences_are_found(spark):
    rows, labels, truth = planted(1, 600)
    held = {r[0] for r in rows if zlib.crc32(str(r[0]).encode()) % 4 == 2}
    model = toxicity.fit(frame(spark, rows), spark.createDataFrame([x for x in labels if x[0] not in held] + [(None, 1, 1, "x"), (3, 1, None, "x")], LABELS))
    got = {r["doc_id"]: r for r in toxicity.score(frame(spark, rows), model).collect()}
    wrong = [i for i in held if got[i]["predicted"] != int(i in truth)]
    assert len(wrong) <= 0.02 * len(held), wrong
    for i in held & truth.keys():
        if got[i]["predicted"]:
            found = [rows[i][1][s["start"]:s["end"]] for s in got[i]["offending"]]
            assert any(any(b in f.lower() for b in BAD) for f in found) and all(f in truth[i] or truth[i] in f for f in found), (found, truth[i])
    assert all(not r["offending"] for r in got.values() if not r["predicted"])


def test_odd_texts_are_scored(spark):
    rows, labels, _ = planted(2, 200)
    model = toxicity.fit(frame(spark, rows), spark.createDataFrame(labels, LABELS))
    odd = corpus(5, 40) + [row(2000, "idiot " * 200_000), row(2001, "." * 100_000), row(2002, "a" * 1_000_000), row(2003, " \x1e\x1e . idiot scum\n\n\n")]
    got = toxicity.score(frame(spark, odd), model)
    assert got.schema.names[:3] == ["doc_id", "text", "lang"] and {"score", "predicted", "offending"} <= set(got.columns)
    out = got.select("doc_id", "text", "score", "predicted").collect()
    assert len(out) == len(odd) and all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in out)
    assert Counter(r["text"] for r in out) == Counter(r[1] for r in odd)
    scores = {r["doc_id"]: r["score"] for r in out}
    assert scores[2000] > 0.9 and scores[1001] == scores[1002] == scores[1003]
    assert toxicity.score(empty(spark), model).collect() == []


def test_without_labels_nothing_is_toxic(spark):
    docs = frame(spark, corpus(1, 10))
    assert toxicity.fit(docs, spark.createDataFrame([], LABELS)) is None
    assert toxicity.fit(docs, spark.createDataFrame([(77_777, 1, 1, "x")], LABELS)) is None
    assert {r["score"] for r in toxicity.score(docs, None).collect()} == {0.0}
    only = toxicity.fit(docs, spark.createDataFrame([(i, 1, 0, "x") for i in range(10)], LABELS))
    assert all(r["predicted"] == 0 for r in toxicity.score(docs, only).collect())


def test_both_divisions_into_sentences_agree_with_noisy_or(spark):
    rng = random.Random(7)
    texts = ["".join(rng.choice(["ab", "idiot", " ", "\n", ".", "!", "\t", "\x1e", "é", "\x1e ", " . ", "scum"]) for _ in range(rng.randint(0, 40))) for _ in range(400)]
    model = toxicity.Model({"idiot": 3.0, "idio": 1.0, "scum": 2.0}, -4.0, 0.7)
    scores = toxicity.Scorer(model).scores(pa.array([*texts, None]))
    found = toxicity.sentences_of(pa.array([*texts, None]))
    for text, score, n in zip([*texts, ""], scores, found.per_doc(len(texts) + 1)):
        spans = toxicity.spans_of(text)
        assert len(spans) == n, (text, spans)
        clean = 1.0
        for start, end, words in spans or [(0, 0, [])]:
            z = sum(model.weights.get(p, 0) for w in words for p in toxicity.parts(w)) - 4 - 0.7 * np.log(max(n, 1))
            clean *= 1 - 1 / (1 + np.exp(-z))
        assert abs(score - (1 - clean)) < 1e-9
    assert toxicity.parts("Idiot!") == {"idio", "idiot"} and toxicity.parts("x-ab") == {"x", "ab"}


def test_training_texts_are_whole_and_bounded(spark):
    rows, labels, _ = planted(3, 80)
    huge = [row(900 + i, "idiot scum " * 3000) for i in range(2)]
    model = toxicity.fit(frame(spark, rows + huge), spark.createDataFrame(labels + [(900 + i, 1, 1, "x") for i in range(2)], LABELS), sample=30, sample_bytes=40_000)
    assert isinstance(model, toxicity.Model)
    assert T.StructType(DOCS.fields[:1]).names == ["doc_id"]
