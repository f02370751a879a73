"""Prefix counts and pieces against the libraries."""

import hashlib
import time

import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from loanlake.llm import piece_agenda as pieces
from loanlake.llm import prefix_counts as prefixes
from text_fixtures import documents, odd_rows  # noqa: F401

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
MODEL = public_tokenizers.path("piece_bpe_32k.model")
PARTS = st.sampled_from(
    ["a", "the", "ing", " ", "  ", "\n", "\n\n", "\t", "'ll", "'re", "'s", "'", "'r", "é", "漢", "\U0001f600", "\x00", "\x1c",
     "\x85", "\xa0", "　", "▁", "1", "23", "###", "&&&", ".", "!", "<|endoftext|>", "<|endof", "<s>", "LL", "zq"]
)
TEXTS = st.lists(st.one_of(PARTS, st.text(max_size=3)), max_size=14).map("".join)


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(VOCABULARY)


def clean(text):
    return text.encode("utf-8", "ignore").decode()


@settings(max_examples=300, deadline=None)
@given(TEXTS)
def test_every_prefix_has_the_count_of_the_library(tokenizer, text):
    text = clean(text)
    total, steps = prefixes.load(VOCABULARY).count(text)
    counts = prefixes.counts_at(steps)
    expected = [len(tokenizer.encode(text[:k], add_special_tokens=False).ids) for k in range(len(text) + 1)]
    assert counts.tolist() == expected and total == expected[-1]


@pytest.mark.parametrize("run", [" ", "\n", "\t", " \n", "\r\n", "\u00a0", "\u3000 "])
def test_long_white_space_is_read_once(tokenizer, run):
    """The time is linear in the run; counts are the library's at every cut looked at."""
    counter = prefixes.load(VOCABULARY)
    text = (run * 50_000)[:50_000] + "word"
    started = time.perf_counter()
    total, steps = counter.count(text)
    assert time.perf_counter() - started < 5
    counts = prefixes.counts_at(steps)
    for cut in (1, 2, 3, 7, 100, 4097, 49_999, 50_000, 50_001, len(text)):
        assert counts[cut] == len(tokenizer.encode(text[:cut], add_special_tokens=False).ids)
    assert total == counts[-1]


def test_counts_of_rows(spark, documents, odd_rows, tokenizer):
    docs = documents(odd_rows)
    counted = prefixes.prefix_token_counts(docs, VOCABULARY)
    assert counted.columns[:-2] == [c for c in docs.columns if c != "n_tokens"]
    rows = counted.collect()
    assert len(rows) == len(odd_rows)
    for r in rows:
        assert r["n_tokens"] == len(tokenizer.encode(r["text"] or "", add_special_tokens=False).ids)
        assert len(r["prefix_steps"]) == 2 * len(r["text"] or "")


def test_budgets_and_truncations(spark, documents, tokenizer):
    texts = ["The quick brown fox isn't  here\n\nbut we'll wait", "", "ééé 漢字", "<|endoftext|> x"]
    counted = prefixes.prefix_token_counts(documents([(k, t, "a") for k, t in enumerate(texts)]), VOCABULARY)
    size = lambda t: len(tokenizer.encode(t, add_special_tokens=False).ids)
    for budget in (0, 1, 3, 7, 100):
        for r in prefixes.chars_within(counted, budget).collect():
            best = max(k for k in range(len(r["text"]) + 1) if size(r["text"][:k]) <= budget)
            assert r["chars_within"] == best
    for chars in (0, 2, 6, 50):
        for r in prefixes.tokens_of_prefix(counted, chars).collect():
            assert r["tokens_of_prefix"] == size(r["text"][:chars])


def test_tables_are_cleared_when_full(monkeypatch):
    monkeypatch.setattr(prefixes, "CACHE", 3)
    counter = prefixes.PrefixCounter(VOCABULARY)
    text = "one two three four five six seven one two three"
    assert [counter.count(text)[0] for _ in range(3)] == [10, 10, 10] and len(counter.seen) <= 3


@settings(max_examples=300, deadline=None)
@given(TEXTS)
def test_pieces_are_those_of_the_library(text):
    text = clean(text)
    model = pieces.load(MODEL)
    ids, n, decoded = model.encode(text)
    expected = model.library.encode(text)
    assert ids == ",".join(map(str, expected)) and n == len(expected)
    assert decoded.decode() == model.library.decode(expected)


def test_long_units(spark):
    model = pieces.PieceModel(MODEL)
    for text in ("ab" * 8000, " " * 4000 + "x", "\n" * 500, "漢" * 3000):
        assert model.encode(text)[0] == ",".join(map(str, model.library.encode(text)))


def test_pieces_of_rows(spark, documents, odd_rows):
    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    docs = documents(odd_rows)
    rows = pieces.encode(docs, MODEL).collect()
    assert len(rows) == len(odd_rows)
    for r in rows:
        expected = library.encode(r["text"] or "")
        assert r["ids"] == expected and r["n_tokens"] == len(expected) and r["decoded"] == library.decode(expected)
    for r in pieces.encode(docs, MODEL, digests=True).collect():
        expected = library.encode(r["text"] or "")
        assert r["ids_sha256"] == hashlib.sha256(",".join(map(str, expected)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(library.decode(expected).encode()).hexdigest()


def test_a_differing_library_fails_the_task(monkeypatch):
    model = pieces.PieceModel(MODEL)
    with pytest.raises(ValueError):
        pieces._check(model, ["some text"], [("1,2", 2, b"some text")], 1.0)


def test_empty_tables(spark, documents):
    assert prefixes.prefix_token_counts(documents([]), VOCABULARY).collect() == []
    assert pieces.encode(documents([]), MODEL).collect() == []


def test_later_tasks_look_up_the_words_of_earlier_ones(monkeypatch):
    """A word is merged and confirmed once per worker, not once per task; a table that is wrong is not kept."""
    model = pieces.load(MODEL)
    model.seen.clear()
    words = ["zebra", "crossing", "\nzebra", "quagga"]
    batch = lambda *texts: pa.RecordBatch.from_pydict({"__text": list(texts)})
    run = pieces._encoded(MODEL, 0.0, True)
    first = [b.to_pydict() for b in run(iter([batch("zebra crossing", "zebra\nzebra quagga")]))]
    assert set(words) == set(model.seen)
    monkeypatch.setattr(pieces.PieceModel, "merge", lambda self, unit: pytest.fail(f"{unit} is merged again"))
    assert [b.to_pydict() for b in run(iter([batch("zebra crossing", "zebra\nzebra quagga")]))] == first
    model.seen["quagga"] = ("1,2", b" quagga")
    with pytest.raises(ValueError, match="differently"):
        list(pieces._encoded(MODEL, 1.0, True)(iter([batch("quagga")])))
    assert not model.seen
