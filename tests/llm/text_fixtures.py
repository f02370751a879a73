import re
import zlib

import pytest

_WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="session")
def words():
    """Words of a text, A-Z lower-cased."""

    def split(text):
        low = (text or "").translate({c: c + 32 for c in range(65, 91)})
        return _WORD.findall(low)

    return split


@pytest.fixture(scope="session")
def held_out():
    return lambda doc_id, folds: zlib.crc32(str(doc_id).encode()) % folds == 0


@pytest.fixture(scope="session")
def documents(spark):
    """A function from rows ``(doc_id, text, source)`` to a frame with extra, clashing columns."""

    def build(rows):
        full = [(d, t, "en", s, 1, "old", 2.0, True, -1) for d, t, s in rows]
        return spark.createDataFrame(
            full,
            "doc_id long, text string, lang string, source string, size long, ids string, score double, kept boolean, n_tokens long",
        )

    return build


@pytest.fixture(scope="session")
def odd_rows():
    """Null and empty texts, a null id and source, repeated rows, and one very long text."""
    long = " ".join(f"word{k % 997}" for k in range(60_000))
    return [
        (1, None, "a"), (2, "", "a"), (3, " \t\n\x0b\f\r ", None), (None, "a text without an id", "b"),
        (4, "same text here", None), (4, "same text here", None), (5, long, "b"), (6, "\U0001f600 é \x00 漢字\nnext", "c"),
        (7, "x" * 30_000, "c"),
    ]
