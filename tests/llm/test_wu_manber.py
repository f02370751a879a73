"""Occurrences of benchmark windows against a search at every position."""

import random
import re

import pytest

from loanlake.llm import wu_manber

WORD = re.compile(wu_manber.WORD)


def words_of(text):
    return WORD.findall((text or "").translate({c: c + 32 for c in range(65, 91)}))


def by_positions(docs, items, width):
    """``n_words``, positions hit and ids for every document."""
    windows = {}
    for item, text in items:
        words = words_of(text)
        size = min(width, len(words))
        for k in range(len(words) - size + 1 if size else 0):
            windows.setdefault(tuple(words[k : k + size]), set()).add(item)
    out = []
    for text in docs:
        words, hit, named = words_of(text), set(), set()
        for window, owners in windows.items():
            for k in range(len(words) - len(window) + 1):
                if tuple(words[k : k + len(window)]) == window:
                    hit.update(range(k, k + len(window)))
                    named |= owners
        out.append((len(words), hit, sorted(str(x) for x in named if x is not None)))
    return out


def found_by(matcher, docs):
    out = []
    for text in docs:
        count, spans, named = matcher.find((text or "").encode())
        assert all(a < b for a, b in spans) and all(x[1] < y[0] for x, y in zip(spans, spans[1:], strict=False))
        out.append((count, {k for a, b in spans for k in range(a, b)}, sorted(named)))
    return out


def matcher_of(items, width):
    return wu_manber.Matcher([(None if i is None else str(i), words_of(t)) for i, t in items], width)


@pytest.mark.parametrize("alphabet", [2, 3, 40])
@pytest.mark.parametrize("width", [1, 2, 4, 10])
def test_matches_positions(alphabet, width, monkeypatch):
    """Small alphabets repeat and overlap; documents hold whole items, pieces and near misses; pieces of a text are small."""
    monkeypatch.setattr(wu_manber, "PIECE", 37)
    draw = random.Random(alphabet * 100 + width)
    text = lambda n: " ".join(f"W{draw.randrange(alphabet)}" for _ in range(n))
    items = [(k, text(draw.choice([0, 1, 3, 9, 10, 11, 25]))) for k in range(25)] + [(None, text(12)), (3, text(14))]
    docs = [None, "", " .,-! "]
    for _ in range(40):
        whole = [text(draw.randrange(0, 30))]
        for _ in range(draw.randrange(3)):
            near = draw.choice(items)[1].split()
            if near and draw.random() < 0.4:
                near[draw.randrange(len(near))] = "other"
            whole += [draw.choice([", ", "\n", " / "]).join(near), text(draw.randrange(4))]
        docs.append(" ".join(whole))
    assert found_by(matcher_of(items, width), docs) == by_positions(docs, items, width)


def test_words_are_those_of_the_pattern():
    odd = "Héllo WORLD it's x_y 12-3 漢字。a\x00b \U0001f600 İÀ{c}~\x7fd e @F[g`h"
    assert [w.decode() for w in wu_manber.split_words(odd.encode())] == words_of(odd)


def test_long_texts_and_long_words():
    passage = " ".join(f"p{k}" for k in range(10))
    long = ("filler words go on " * 300_000) + passage + " " + "x" * 5_000_000 + " " + passage
    assert len(long) > 2 * wu_manber.PIECE
    count, spans, named = matcher_of([(7, passage)], 10).find(long.encode())
    assert (count, named) == (1_200_000 + 21, {"7"})
    assert spans == [(1_200_000, 1_200_010), (1_200_011, 1_200_021)]


def frames(spark, docs, items):
    rows = [(k, t, "old", 5, [1]) for k, t in enumerate(docs)]
    return (
        spark.createDataFrame(rows, "doc_id long, text string, n_words string, items int, spans array<int>"),
        spark.createDataFrame([(i, t, "x", 1.0) for i, t in items], "item_id long, text string, doc_id string, size double"),
    )


@pytest.mark.parametrize("small", [False, True])
def test_operator(spark, small, monkeypatch):
    """Several rounds and segments find the same; extra columns with the names of results are replaced."""
    if small:
        monkeypatch.setattr(wu_manber, "ROUND_BYTES", 400)
        monkeypatch.setattr(wu_manber, "SEGMENT", 7)
    draw = random.Random(9)
    text = lambda n: " ".join(f"W{draw.randrange(500)}" for _ in range(n))
    items = [(k, text(draw.choice([2, 10, 30]))) for k in range(12)] + [(None, text(20)), (1, None), (2, ""), (3, text(40)), (3, "Copy it")]
    items.append(items[0])
    docs = [None, "", "nothing here", "copy: IT", "copy that"] + [f"{text(5)} {t}, {text(5)} {t}" for _, t in items] + ["copy it"] * 3
    table, bench = frames(spark, docs, items)
    found = wu_manber.find_windows(spark, table, bench)
    assert found.columns == ["doc_id", "text", "n_words", "spans", "items"]
    rows = sorted(found.collect(), key=lambda r: r["doc_id"])
    assert [r["text"] for r in rows] == docs
    got = [(r["n_words"], {k for s in r["spans"] for k in range(s["start"], s["end"])}, r["items"]) for r in rows]
    assert got == by_positions(docs, items, 10)
    assert wu_manber.find_windows(spark, table, bench, keep_text=False).columns == ["doc_id", "n_words", "spans", "items"]


def test_empty_tables(spark):
    table, bench = frames(spark, ["some text"], [(1, "some")])
    assert wu_manber.find_windows(spark, table.limit(0), bench).count() == 0
    rows = wu_manber.find_windows(spark, table, bench.limit(0)).collect()
    assert [(r["n_words"], r["spans"], r["items"]) for r in rows] == [(2, [], [])]
    rows = wu_manber.find_windows(spark, table, bench).collect()
    assert [(r["n_words"], [tuple(s) for s in r["spans"]], r["items"]) for r in rows] == [(2, [(0, 1)], ["1"])]
