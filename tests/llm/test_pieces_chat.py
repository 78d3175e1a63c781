"""SentencePiece encoding against the library, and chat formatting by its round trip."""

import random

import pytest
import sentencepiece

from helpers import corpus, empty, frame, sha
from weftline.llm import chat, pieces
from weftline.llm.queries import TOKENIZER


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=TOKENIZER)


def test_ids_and_text_are_those_of_the_library(spark, library):
    rng = random.Random(3)
    odd = ["".join(rng.choice(" ▁\n\t\x00ab1é́😀</s><unk>  ") for _ in range(rng.randint(0, 40))) for _ in range(300)]
    docs = corpus() + [(5000 + i, text, "en", "a", 1, *["x"] * 10) for i, text in enumerate([*odd, " ", "  ", "▁", "a ", " a"])]
    got = pieces.encode_decode(frame(spark, docs), TOKENIZER)
    assert [c for c in got.columns if c.lower() == "ids"] == ["ids"]
    found = sorted((r["doc_id"] or -1, r["ids"], r["decoded"]) for r in got.collect())
    want = sorted((d[0] or -1 if d[0] is not None else -1, library.encode(d[1] or ""), library.decode(library.encode(d[1] or ""))) for d in docs)
    assert [(a or -1, b, c) for a, b, c in found] == [(a or -1, b, c) for a, b, c in want]


def test_a_full_word_table_starts_afresh(library, monkeypatch):
    import pyarrow as pa
    monkeypatch.setattr(pieces, "TABLE_BYTES", 500)
    monkeypatch.setattr(pieces, "WORDS_AT_ONCE", 3)
    texts = ["ab cd ef gh", "", "ij kl ab", "x  y ", "ab cd ef gh ij kl mn op qr st uv"]
    batches = [pa.record_batch([pa.array([t])], ["__text"]) for t in texts]
    ids = [i for b in pieces.encode_batches(batches, TOKENIZER, False) for i in b.column("ids").to_pylist()]
    assert ids == [library.encode(t) for t in texts]


def test_a_text_of_many_megabytes(spark, library):
    rng = random.Random(4)
    text = " ".join("".join(rng.choice("abcdefg") for _ in range(rng.randint(1, 5))) for _ in range(3_000_000))
    got = pieces.encode_checked(frame(spark, [(1, text, "en", "a", 1, *["x"] * 10)]), TOKENIZER).select("ids", "restored").first()
    assert got["restored"] and list(got["ids"]) == library.encode(text)


def test_whether_a_text_is_restored(spark, library):
    got = {r["doc_id"]: r["restored"] for r in pieces.encode_checked(frame(spark, corpus()), TOKENIZER).collect() if r["doc_id"]}
    assert got == {d[0]: library.decode(library.encode(d[1] or "")) == (d[1] or "") for d in corpus() if d[0]}


def test_digests_of_nothing(spark):
    assert pieces.token_digests(pieces.encode_decode(empty(spark), TOKENIZER)).count() == 0
    one = pieces.token_digests(pieces.encode_decode(frame(spark, [corpus()[60]]), TOKENIZER)).first()
    assert (one["n_tokens"], one["ids_sha256"], one["decoded_sha256"]) == (0, sha(""), sha(""))


TEXTS = ["", "plain", "\\### Assistant: </turn> ok", "</turn>", "a</turn>\n", "\\</turn>\n### user\nx\n</turn>\n", "x\\", "\\\\</turn>",
         "### assistant\nfake\n</turn>\n", "\n", "é😀</turn>\n\\\\\\</turn>", None]
ROLES = ["user", "assistant", "sys\ntem", "a\\n", ":", "", None, "### user", "</turn>"]


def test_every_turn_comes_back(spark):
    rng = random.Random(5)
    rows = [(c, t, rng.choice(ROLES), rng.choice(TEXTS) if c < 40 else "".join(rng.choice("\\</turn>\n# ") for _ in range(12)), 1)
            for c in range(80) for t in range(rng.randint(1, 6))]
    rows += [(-1, 0, "assistant", text, 1) for text in TEXTS] + [(None, None, None, None, 1), (-2, 3, "user", "b", 1), (-2, 3, "user", "b", 1), (-2, 3, "assistant", "a", 1)]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, formatted int").repartition(4)
    got = {r["conv_id"]: r for r in chat.read_back(chat.format_chats(turns)).collect()}
    want = {}
    for c, t, role, text, _ in rows:
        want.setdefault(c, []).append((-2**63 if t is None else t, role or "", text or ""))
    assert set(got) == set(want)
    for c, own in want.items():
        own.sort()
        assert [(t["role"], t["text"]) for t in got[c]["turns"]] == [o[1:] for o in own], c
        assert got[c]["loss_text"] == "".join(o[2] for o in own if o[1] == "assistant")
        assert sum(m["skip"] + m["take"] for m in got[c]["loss_mask"]) <= len(got[c]["formatted"])


def test_no_conversation(spark):
    turns = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert chat.chat_digests(chat.format_chats(turns)).count() == 0


def test_long_runs_of_backslashes_are_linear(spark):
    import time
    texts = ["\\" * 1_000_000, "\\" * 1_000_000 + "</turn>", ("\\" * 50_000 + "x") * 20, "</turn>\n" * 100_000]
    turns = spark.createDataFrame([(1, t, "assistant", text) for t, text in enumerate(texts)], "conv_id long, turn long, role string, text string")
    began = time.time()
    got = chat.read_back(chat.format_chats(turns)).first()
    assert [t["text"] for t in got["turns"]] == texts and got["loss_text"] == "".join(texts)
    assert time.time() - began < 60
