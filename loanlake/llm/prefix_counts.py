"""Token counts of every prefix by dynamic programming.

For a byte-level merge vocabulary the last token of a prefix determines the encoding:
a token ``t`` ends the encoding of a prefix if the encoding of what precedes it ends in a
token that may stand before ``t``, that is, if the pair encodes to itself.  Exactly one
token does.  So one pass over a piece of text gives last token and exact token count
of every prefix, and truncations and budgets are answered from the stored counts without
encoding again.

Pieces are those of the vocabulary's splitting pattern.  White space and the piece after it
are handled as one unit, as a cut inside it moves the split; units that were seen before
are looked up in a bounded table of the task.  Special strings are one token where the
whole string is inside the prefix and ordinary text where the prefix ends within it.

Counts are stored as differences, one 16-bit number per character.  Null texts are empty
texts: count 0 and no differences.  Rows are counted one by one, so repeated rows agree; an
empty table gives an empty result.  Input columns with the name of an output column are
replaced.
"""

import json
import struct
from collections.abc import Iterator
from operator import sub

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slices, small_batches, tidy

CACHE = 400_000
LONGEST_CACHED = 64
PAIR = 17  # bits of a token number
# Fixed value: the splitting pattern of byte-level vocabularies.
PIECES = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+"
    r"|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"
)
#: A unit is a run of white space with the piece behind it; a contraction is none behind a space.
UNITS = (
    r"\p{White_Space}*+(?:(?<! )(?:'s|'t|'re|'ve|'m|'ll|'d)|\p{L}+|\p{N}+|[^\p{White_Space}\p{L}\p{N}]+)"
    r"|\p{White_Space}+"
)
_LEAD = regex.compile(r"\p{White_Space}*")
_COUNTERS: dict[str, "PrefixCounter"] = {}


def byte_letters() -> dict[str, int]:
    """The character that byte-level vocabulary files write for every byte."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}


class PrefixCounter:
    """Exact token counts of all prefixes for a vocabulary file of the tokenizers library."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model, split = spec["model"], spec["pre_tokenizer"]
        plain = split["type"] == "ByteLevel" and split["use_regex"] and not split["add_prefix_space"]
        if model["type"] != "BPE" or not plain or spec["normalizer"] or model.get("ignore_merges"):
            raise ValueError("Not a byte-level merge vocabulary")
        letters = byte_letters()
        raw = lambda word: bytes(letters[c] for c in word)
        self.specials = [t["content"] for t in spec["added_tokens"]]
        if any(t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"] for t in spec["added_tokens"]):
            raise ValueError("Special strings that take in their surroundings are not supported")
        self.vocab = {raw(w): i for w, i in model["vocab"].items() if w not in set(self.specials)}
        self.longest = max(map(len, self.vocab))
        merges = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        # By token number: the place of the merge that builds it, and its parts; pairs are two numbers in one.
        size = max(self.vocab.values()) + 1
        self.built, self.left, self.right = [-1] * size, [0] * size, [0] * size
        self.ranks: dict[int, int] = {}
        for rank, (a, b) in enumerate((raw(a), raw(b)) for a, b in merges):
            one, two, whole = self.vocab[a], self.vocab[b], self.vocab[a + b]
            self.ranks[one << PAIR | two] = rank
            if self.built[whole] < 0:
                self.built[whole], self.left[whole], self.right[whole] = rank, one, two
        self.pieces = regex.compile(PIECES).findall
        self.units = regex.compile(UNITS).findall
        self.special = regex.compile("(" + "|".join(map(regex.escape, self.specials)) + ")") if self.specials else None
        self.fits: dict[int, bool] = {}
        self.seen: dict[str, tuple[int, bytes]] = {}

    def stands(self, left: int, right: int) -> bool:
        """Whether token ``left`` followed by ``right`` is encoded as these two tokens.

        Walks both tokens back through their merges: the pair does not stand if two parts
        that meet at the seam would have merged before one of them was built.
        """
        key = left << PAIR | right
        ranks, built = self.ranks, self.built
        limit = 1 << 60
        while True:
            rank = ranks.get(left << PAIR | right)
            if rank is not None and rank < limit:
                result = False
                break
            a, b = built[left], built[right]
            if a < 0 and b < 0:
                result = True
                break
            # Undo the later merge.  A merge at the seam lies left of the right token's own, so it wins a tie.
            if a > b:
                limit, left = a, self.right[left]
            else:
                limit, right = b + 1, self.left[right]
        if len(self.fits) >= CACHE * 4:
            self.fits.clear()
        self.fits[key] = result
        return result

    def piece_counts(self, piece: bytes) -> list[int]:
        """Token counts of all byte prefixes of one piece, from 0."""
        token_of, known, longest = self.vocab.get, self.fits.get, self.longest
        n = len(piece)
        last = [0] * (n + 1)
        counts = [0] * (n + 1)
        for end in range(1, n + 1):
            # Exactly one token ends here, so the order of trying is free; most tokens are short.
            for start in range(end - 1, max(end - longest, 0) - 1, -1):
                token = token_of(piece[start:end])
                if token is None:
                    continue
                if start:
                    fits = known(last[start] << PAIR | token)
                    if fits is None:
                        fits = self.stands(last[start], token)
                    if not fits:
                        continue
                last[end] = token
                counts[end] = counts[start] + 1
                break
        return counts

    def character_counts(self, piece: str) -> list[int]:
        """Token counts of all character prefixes of one piece, from 0."""
        raw = piece.encode()
        tokens = self.piece_counts(raw)
        if len(raw) == len(piece):
            return tokens
        # A prefix of whole characters ends before the first byte of the next one.
        return [tokens[k] for k in range(len(raw) + 1) if k == len(raw) or raw[k] & 0xC0 != 0x80]

    def prefix_counts(self, text: str) -> list[int]:
        """Token counts of all character prefixes of a unit, from 0; no special strings are looked for."""
        counts = [0]
        pieces = self.pieces(text)
        done = 0
        for piece in pieces:
            tokens = self.character_counts(piece)
            counts += [done + c for c in tokens[1:]] if done else tokens[1:]
            done = counts[-1]
        # Cuts that change the split: after two letters of a contraction, and within leading white space.
        start = 0
        for piece in pieces if "'" in text else ():
            if piece in ("'re", "'ve", "'ll"):
                counts[start + 2] = counts[start] + sum(self.piece_counts(p.encode())[-1] for p in self.pieces(piece[:2]))
            start += len(piece)
        # A cut within leading white space leaves one piece, a prefix of the whole run.
        lead = _LEAD.match(text).end()
        if lead > 1:
            counts[2 : lead + 1] = self.character_counts(text[:lead])[2:]
        return counts

    def unit(self, text: str) -> tuple[int, bytes]:
        """Count of a unit and the differences of its prefix counts."""
        lead = text[0]
        if "'" not in text and (not lead.isspace() or (lead == " " and text[1:2].strip())):
            counts = self.character_counts(text)  # one piece
        else:
            counts = self.prefix_counts(text)
        result = counts[-1], struct.pack(f"<{len(text)}h", *map(sub, counts[1:], counts))
        if len(text) <= LONGEST_CACHED:
            if len(self.seen) >= CACHE:
                self.seen.clear()
            self.seen[text] = result
        return result

    def count(self, text: str) -> tuple[int, bytes]:
        """Tokens of a text and the 16-bit differences of its prefix counts."""
        if not text:
            return 0, b""
        get, new = self.seen.get, self.unit
        total, steps, tail = 0, [], ""
        for k, part in enumerate(self.special.split(text) if self.special else [text]):
            if k % 2:
                steps.append(self._special_steps(tail, part))
                total, tail = total + 1, ""
            elif part:
                units = self.units(part)
                found = [get(u) or new(u) for u in units]
                total += sum([f[0] for f in found])
                steps.extend([f[1] for f in found])
                tail = units[-1]
        return total, b"".join(steps)

    def _special_steps(self, tail: str, special: str) -> bytes:
        """Differences over a special string: ordinary text behind ``tail`` until it is complete."""
        base = self.prefix_counts(tail)[-1] if tail else 0
        cuts = [sum(c for c, _ in map(self.unit, self.units(tail + special[:k]))) for k in range(1, len(special))]
        return np.diff([base, *cuts, base + 1]).astype("<i2").tobytes()


def load(path: str) -> PrefixCounter:
    """The counter of a file, once per worker process."""
    if path not in _COUNTERS:
        _COUNTERS[path] = PrefixCounter(path)
    return _COUNTERS[path]


def counts_at(steps: bytes | None) -> np.ndarray:
    """Token counts of the prefixes of 0, 1, 2, ... characters from stored differences."""
    return np.concatenate([[0], np.cumsum(np.frombuffer(steps or b"", "<i2"), dtype=np.int64)])


def _counted(path: str, with_steps: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = load(path)
        for batch in slices(batches, "__text"):
            rows = [counter.count(t or "") for t in batch.column("__text").to_pylist()]
            kept = [n for n in batch.schema.names if n != "__text"]
            totals = [int(np.frombuffer(s, "<i2").sum(dtype=np.int64)) for _, s in rows]
            columns = [*(batch.column(n) for n in kept), pa.array(totals, pa.int64())]
            if with_steps:
                columns.append(pa.array([s for _, s in rows], pa.binary()))
            yield pa.RecordBatch.from_arrays(columns, [*kept, "n_tokens", "prefix_steps"][: len(columns)])
        counter.seen.clear()  # workers live longer than tasks

    return run


def prefix_token_counts(
    docs: DataFrame, vocabulary: str, *, text: str = "text", steps: bool = True, keep_text: bool = True
) -> DataFrame:
    """``docs`` with ``n_tokens`` (the count of the last prefix) and, with ``steps``, ``prefix_steps``.

    ``keep_text=False`` leaves the text column out.
    """
    small_batches(docs.sparkSession)
    outputs = ("n_tokens", "prefix_steps") if steps else ("n_tokens",)
    left_out = outputs if keep_text else (*outputs, text.lower())
    kept = [F.col(f"`{c}`") for c in docs.columns if c.lower() not in left_out]
    rows = docs.select(*kept, F.col(f"`{text}`").alias("__text"))
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields if f.name != "__text"]
    fields += ["n_tokens long", "prefix_steps binary"][: len(outputs)]
    return rows.mapInArrow(tidy(_counted(vocabulary, steps)), ", ".join(fields))


def _cut(column: str, value):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [value(counts_at(s.as_py())) for s in batch.column("prefix_steps")]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.int64())], [*batch.schema.names, column])

    return run


def _with_long(counted: DataFrame, column: str, value) -> DataFrame:
    rows = counted.drop(column)
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields]
    return rows.mapInArrow(tidy(_cut(column, value)), ", ".join([*fields, f"`{column}` long"]))


def chars_within(counted: DataFrame, budget: int, *, column: str = "chars_within") -> DataFrame:
    """Add the length of the longest prefix of at most ``budget`` tokens, from the stored differences."""
    return _with_long(counted, column, lambda counts: int(np.flatnonzero(counts <= budget)[-1]))


def tokens_of_prefix(counted: DataFrame, chars: int, *, column: str = "tokens_of_prefix") -> DataFrame:
    """Add the token count of the first ``chars`` characters, from the stored differences."""
    return _with_long(counted, column, lambda counts: int(counts[min(chars, len(counts) - 1)]))
