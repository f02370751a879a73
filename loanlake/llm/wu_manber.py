"""Benchmark decontamination by Wu-Manber multi-pattern search over words.

The patterns are the windows of ``width`` consecutive words of the benchmark's items; an item with
fewer words is one shorter window.  Patterns of one length form a class with tables of its own:
the shift table says for the last block of words (three, for short patterns two or one) before a
position how far the search may jump, because no window can end earlier; a block that ends a window
has shift 0, and the bucket under it lists the windows to try.  Their first words select, then the
words are compared one by one.  All occurrences of all windows are found; a word inside one is hit.

Words are found in bytes: UTF-8 lets A-Z be lower-cased and other ASCII characters become spaces in
one pass, and what is left is split at spaces.  A text is read in pieces of a few megabytes that
overlap by a window, so a task never holds the words of a very long text at once.

The tables are built in the workers from the items' words.  Items are cut into segments that overlap
by a window and the segments are dealt into rounds of at most about ``ROUND_BYTES`` each; only one
round's segments are broadcast and in memory at a time.  A benchmark beyond one round is searched in
several, each of which adds to what the rounds before found and is stored.

A null text, a null item and a text without words have no words.  Items without an id hit words but
are not named; items that share an id are one.  Repeated documents are separate rows.  The caller's
columns stay, but for those that have the name of a result.  An empty benchmark hits nothing, an
empty table has no rows.
"""

import re
import uuid
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Scratch, lower_ascii, slices, small_batches, tidy

# The characters of words are digits, letters after lower-casing, and all beyond ASCII.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

WIDTH = 10
SEGMENT = 20_000  # words
ROUND_BYTES = 2_000_000
PIECE = 1 << 22
RESULTS = ("n_words", "spans", "items")

_IN_WORDS = re.compile(WORD.encode())
LOWERED = bytes(
    c + 32 if 65 <= c <= 90 else c if _IN_WORDS.match(bytes([c])) else 32 for c in range(256)
)
_GAP = re.compile(b"[" + re.escape(bytes(c for c in range(256) if LOWERED[c] == 32)) + b"]")


def split_words(raw: bytes) -> list[bytes]:
    """The words of a text in UTF-8."""
    return raw.translate(LOWERED).split()


class Class:
    """Windows of one length, with their shift table and suffix buckets."""

    def __init__(self, length: int):
        self.length = length
        self.block = 1 if length == 1 else 2 if length < 5 else 3
        self.farthest = length - self.block + 1
        self.number: dict[tuple[bytes, ...], int] = {}
        self.owners: list[set[int]] = []
        self.shift: dict[tuple[bytes, ...], int] = {}
        self.bucket: dict[tuple[bytes, ...], dict[bytes, list[tuple[int, tuple[bytes, ...]]]]] = {}

    def add(self, window: tuple[bytes, ...], owner: int) -> None:
        known = self.number.get(window)
        if known is not None:
            self.owners[known].add(owner)
            return
        known = self.number[window] = len(self.owners)
        self.owners.append({owner})
        for end in range(self.block, self.length + 1):
            part = window[end - self.block : end]
            if self.shift.get(part, self.farthest) > self.length - end:
                self.shift[part] = self.length - end
        self.bucket.setdefault(window[-self.block :], {}).setdefault(window[0], []).append((known, window))

    def search(self, words: list[bytes], start: int, found: set[int]) -> Iterator[int]:
        """Starts of occurrences in ``words`` that end behind the first ``start`` words; their numbers go to ``found``."""
        length, block, farthest = self.length, self.block, self.farthest
        shift, bucket = self.shift.get, self.bucket
        end = max(length, start + 1)
        while end <= len(words):
            part = tuple(words[end - block : end])
            jump = shift(part, farthest)
            if jump:
                end += jump
                continue
            begin = end - length
            for known, window in bucket[part].get(words[begin], ()):
                if tuple(words[begin:end]) == window:
                    found.add(known)
                    yield begin
            end += 1


class Matcher:
    """All windows of a round."""

    def __init__(self, segments: Sequence[tuple[str | None, Sequence[str]]], width: int):
        self.classes: dict[int, Class] = {}
        self.ids: list[str | None] = list(dict.fromkeys(item for item, _ in segments))
        number = {item: k for k, item in enumerate(self.ids)}
        self.width = width
        for item, text in segments:
            words = [w.encode() for w in text]
            length = min(width, len(words))
            own = self.classes.setdefault(length, Class(length)) if length else None
            for k in range(len(words) - length + 1 if length else 0):
                own.add(tuple(words[k : k + length]), number[item])

    def find(self, raw: bytes) -> tuple[int, list[tuple[int, int]], set[str]]:
        """Number of words, spans of words that are hit (start and end, ascending and apart), and ids of items."""
        spans: dict[int, list[tuple[int, int]]] = {k: [] for k in self.classes}
        found: dict[int, set[int]] = {k: set() for k in self.classes}
        kept: list[bytes] = []
        before = at = 0
        while at < len(raw):
            stop = at + PIECE
            if stop < len(raw):
                # A piece ends where a word cannot go on.
                gap = _GAP.search(raw, stop)
                stop = gap.start() if gap else len(raw)
            words = kept + split_words(raw[at:stop])
            at = stop
            for length, own in self.classes.items():
                here = spans[length]
                for begin in own.search(words, len(kept), found[length]):
                    first = before + begin
                    if here and first <= here[-1][1]:
                        here[-1] = (here[-1][0], first + length)
                    else:
                        here.append((first, first + length))
            kept = words[max(0, len(words) - self.width + 1) :]
            before += len(words) - len(kept)
        named = {self.ids[k] for length, own in self.classes.items() for n in found[length] for k in own.owners[n]}
        return before + len(kept), merged(*spans.values()), named - {None}


def merged(*lists: Sequence[tuple[int, int]]) -> list[tuple[int, int]]:
    """Spans of several lists as one ascending list; spans that touch become one."""
    if sum(map(bool, lists)) < 2:
        return list(next(filter(None, lists), []))
    out: list[tuple[int, int]] = []
    for first, last in sorted(x for spans in lists for x in spans):
        if out and first <= out[-1][1]:
            out[-1] = (out[-1][0], max(last, out[-1][1]))
        else:
            out.append((first, last))
    return out


def segments(benchmark: DataFrame, text: str, item_id: str, width: int) -> DataFrame:
    """``item, words``: the items' words in segments of bounded length that share ``width - 1`` words with the next."""
    words = F.regexp_extract_all(lower_ascii(F.col(f"`{text}`")), F.lit(WORD), F.lit(0))
    items = benchmark.select(F.col(f"`{item_id}`").cast("string").alias("item"), words.alias("all"))
    starts = F.sequence(F.lit(0), F.greatest(F.size("all") - width, F.lit(0)), F.lit(SEGMENT))
    cut = items.filter(F.size("all") > 0).select("item", "all", F.explode(starts).alias("at"))
    return cut.select("item", F.slice("all", F.col("at") + 1, F.lit(SEGMENT + width - 1)).alias("words"))


_BUILT: dict[str, Matcher] = {}


def _searched(shared, key: str, width: int, keep_text: bool):
    """Add a round's findings to the rows of a task; the tables are built once in a worker."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if key not in _BUILT:
            _BUILT.clear()
            _BUILT[key] = Matcher(shared.value, width)
        matcher = _BUILT[key]
        added = ["_n_words", "_spans", "_items"]
        for batch in slices(batches, "_text"):
            found = []
            texts = batch.column("_text").cast(pa.binary())
            earlier = zip(batch.column("_spans").to_pylist(), batch.column("_items").to_pylist(), strict=True)
            for raw, (spans, items) in zip(texts, earlier, strict=True):
                count, own, named = matcher.find(raw.as_py() or b"")
                before = [(s["start"], s["end"]) for s in spans]
                all_spans = [{"start": a, "end": b} for a, b in merged(before, own)]
                found.append((count, all_spans, sorted(named.union(items))))
            new = [
                pa.array(list(values), batch.schema.field(name).type)
                for name, values in zip(added, zip(*found, strict=True), strict=True)
            ]
            kept = batch.drop_columns(added if keep_text else [*added, "_text"])
            yield pa.RecordBatch.from_arrays([*kept.columns, *new], [*kept.schema.names, *added])

    return run


def n_hit(spans: Column) -> Column:
    """Words that lie in spans."""
    return F.aggregate(spans, F.lit(0).cast("bigint"), lambda n, s: n + s["end"] - s["start"])


def find_windows(
    spark: SparkSession,
    docs: DataFrame,
    benchmark: DataFrame,
    *,
    text: str = "text",
    item_text: str = "text",
    item_id: str = "item_id",
    width: int = WIDTH,
    keep_text: bool = True,
) -> DataFrame:
    """Columns of ``docs`` with ``n_words``, ``spans`` of the words hit and the ids of the ``items`` that hit them, as text."""
    small_batches(spark)
    scratch = Scratch(spark, "windows")
    parts = segments(benchmark, item_text, item_id, width)
    size = F.aggregate("words", F.lit(0).cast("bigint"), lambda n, w: n + F.octet_length(w) + 1)
    parts = scratch.store(parts.distinct().withColumn("size", size))
    total = parts.agg(F.sum("size")).first()[0] or 0
    rounds = max(1, -(-total // ROUND_BYTES))
    dealt = parts.withColumn("round", F.pmod(F.xxhash64("item", "words"), F.lit(rounds)))

    names = {c: f"c{k}" for k, c in enumerate(docs.columns) if c not in RESULTS and c != text}
    rows = docs.select(
        *(F.col(f"`{c}`").alias(n) for c, n in names.items()),
        F.col(f"`{text}`").cast("string").alias("_text"),
        F.lit(0).cast("bigint").alias("_n_words"),
        F.array().cast("array<struct<start:bigint,end:bigint>>").alias("_spans"),
        F.array().cast("array<string>").alias("_items"),
    )
    for k in range(rounds):
        listed = [(r["item"], r["words"]) for r in dealt.filter(F.col("round") == k).select("item", "words").collect()]
        if k:
            rows = scratch.store(rows)
        stays = keep_text or k < rounds - 1
        shared = spark.sparkContext.broadcast(listed)
        search = _searched(shared, uuid.uuid4().hex, width, stays)
        rows = rows.mapInArrow(tidy(search), (rows if stays else rows.drop("_text")).schema)
    names |= {text: "_text"} if keep_text and text not in RESULTS else {}
    return rows.select(
        *(F.col(names[c]).alias(c) for c in docs.columns if c in names),
        F.col("_n_words").alias("n_words"),
        F.col("_spans").alias("spans"),
        F.col("_items").alias("items"),
    )
