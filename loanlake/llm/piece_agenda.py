"""SentencePiece encoding and decoding for merge-type vocabularies.

The encoder keeps an agenda of adjacent symbol pairs ordered by the score of the piece
they would form, then by place, and merges the best pair until none is left.  Symbols
without a piece fall back to their bytes.  Text is cut where no piece reaches across:
before a run of spaces and around characters that no longer piece holds (the model is checked
for this), so the pieces of a cut-out unit never depend on its neighbours, and units that
were seen before are looked up in a bounded table of the worker, which its next tasks go on with.

Every Arrow batch is checked against the sentencepiece library: each distinct part that the worker's
table does not have yet is encoded by the library too, and whole rows are, a share of them chosen by hash
(``check_share``) and all that hold runs of spaces; ids and decoded texts must be equal, or the task
fails.

Null texts are empty texts: no ids, empty decoded text.  Rows are encoded one by one, so
repeated rows agree; an empty table gives an empty result.  Input columns with the name of
an output column are replaced.
"""

import hashlib
import heapq
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slices, small_batches, tidy

SPACE = "▁"
CACHE = 400_000
LONGEST_CACHED = 64
SHORT, NONE = 24, -1e300
_MODELS: dict[str, "PieceModel"] = {}


class PieceModel:
    """Pieces and scores of a model file, with the agenda encoder and the decoder."""

    def __init__(self, path: str):
        import sentencepiece

        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        lib = self.library
        self.ids: dict[str, int] = {}
        self.scores: dict[str, float] = {}
        self.bytes: dict[int, int] = {}
        self.surface: list[bytes] = []
        for i in range(lib.get_piece_size()):
            piece = lib.id_to_piece(i)
            if lib.is_byte(i):
                self.bytes[int(piece[3:5], 16)] = i
                self.surface.append(bytes([int(piece[3:5], 16)]))
            elif lib.is_control(i) or lib.is_unknown(i):
                self.surface.append(b"")
            else:
                self.ids[piece] = i
                self.scores[piece] = lib.get_score(i)
                self.surface.append(piece.replace(SPACE, " ").encode())
        inside = "".join(p[1:] for p in self.ids if p.strip(SPACE))
        if any(SPACE in p.lstrip(SPACE) for p in self.ids) or "\n" in inside or len(self.bytes) != 256:
            raise ValueError("Not a merge-type vocabulary with byte fallback whose pieces start at spaces")
        self.units = re.compile(r"\n| *[^ \n]+| +").findall
        self.seen: dict[str, str] = {}
        self.fresh: list[tuple[str, str]] = []  # parts that the library has not confirmed

    def merge(self, unit: str) -> list[int]:
        """Ids of one unit, spaces written as the space symbol."""
        if len(unit) <= SHORT:
            return self._ids(self._merge_short(unit))
        scores = self.scores
        symbols: list[str] = list(unit)
        n = len(symbols)
        after = list(range(1, n + 1))
        before = list(range(-1, n - 1))
        agenda = []
        for k in range(n - 1):
            pair = symbols[k] + symbols[k + 1]
            score = scores.get(pair)
            if score is not None:
                agenda.append((-score, k, k + 1, pair))
        heapq.heapify(agenda)
        while agenda:
            _, left, right, pair = heapq.heappop(agenda)
            # Either symbol may have changed since the pair was put on the agenda.
            if not symbols[left] or not symbols[right] or after[left] != right or symbols[left] + symbols[right] != pair:
                continue
            symbols[left], symbols[right] = pair, ""
            follower = after[right]
            after[left] = follower
            if follower < n:
                before[follower] = left
                longer = pair + symbols[follower]
                score = scores.get(longer)
                if score is not None:
                    heapq.heappush(agenda, (-score, left, follower, longer))
            previous = before[left]
            if previous >= 0:
                longer = symbols[previous] + pair
                score = scores.get(longer)
                if score is not None:
                    heapq.heappush(agenda, (-score, previous, left, longer))
        return self._ids([symbol for symbol in symbols if symbol])

    def _merge_short(self, unit: str) -> list[str]:
        """The same with the agenda as a plain list of scores by place, which is faster for few symbols."""
        get = self.scores.get
        symbols = list(unit)
        agenda = [get(a + b, NONE) for a, b in zip(symbols, symbols[1:], strict=False)]
        while agenda:
            best = max(agenda)
            if best == NONE:
                break
            k = agenda.index(best)  # the first of equal scores
            pair = symbols[k] + symbols[k + 1]
            symbols[k : k + 2] = [pair]
            del agenda[k]
            if k:
                agenda[k - 1] = get(symbols[k - 1] + pair, NONE)
            if k < len(agenda):
                agenda[k] = get(pair + symbols[k + 1], NONE)
        return symbols

    def _ids(self, symbols: list[str]) -> list[int]:
        ids = self.ids
        found: list[int] = []
        for symbol in symbols:
            i = ids.get(symbol)
            if i is None:
                found.extend([self.bytes[b] for b in symbol.encode()])
            else:
                found.append(i)
        return found

    def decode(self, ids: list[int]) -> bytes:
        """What pieces and bytes spell, with the space that the model writes before a text."""
        return b"".join([self.surface[i] for i in ids])

    def word(self, part: str) -> tuple[str, bytes]:
        """Ids, written with commas, and what they decode to, of a part between spaces: behind a space, or a line end and what follows it."""
        if part[0] == "\n":
            found = self.merge("\n") + (self.merge(part[1:]) if len(part) > 1 else [])
        else:
            found = self.merge(SPACE + part)
        result = ",".join(map(str, found)), self.decode(found)
        self.fresh.append((part, result[0]))
        if len(part) <= LONGEST_CACHED:
            if len(self.seen) >= CACHE:
                self.seen.clear()
            self.seen[part] = result
        return result

    def encode(self, text: str) -> tuple[str, int, bytes]:
        """Ids of a text written with commas, their number, and the decoded text."""
        if not text:
            return "", 0, b""
        # The model cannot tell its space symbol from a space, and writes a space before every text.
        text = text.replace(SPACE, " ")
        parts = text.replace("\n", " \n").split(" ")
        if "" in parts:  # runs of spaces, or one at an end
            units = self.units(" " + text)
            found = self._by_unit(units)
            return ",".join(map(str, found)), len(found), self.decode(found)[1:]
        get, new = self.seen.get, self.word
        found = [get(p) or new(p) for p in parts]
        ids = ",".join([f[0] for f in found])
        decoded = b"".join([f[1] for f in found])
        # A text that begins with a line end has the model's own space as a piece of itself.
        return ids, ids.count(",") + 1, decoded[1:] if decoded[:1] == b" " else decoded

    def _by_unit(self, units: list[str]) -> list[int]:
        """Ids of units with any number of spaces; ordinary words are looked up as above."""
        found: list[int] = []
        for unit in units:
            if unit[0] == " " and unit[1:2] not in ("", " "):
                part = unit[1:]
                found.extend(map(int, (self.seen.get(part) or self.word(part))[0].split(",")))
            else:
                found.extend(self.merge(unit.replace(" ", SPACE)))
        return found


def load(path: str) -> PieceModel:
    """The model of a file, once per worker process."""
    if path not in _MODELS:
        _MODELS[path] = PieceModel(path)
    return _MODELS[path]


def _encoded(path: str, check_share: float, with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = load(path)
        for batch in slices(batches, "__text"):
            texts = [t or "" for t in batch.column("__text").to_pylist()]
            rows = [model.encode(t) for t in texts]
            _check(model, texts, rows, check_share)
            kept = [n for n in batch.schema.names if n != "__text"]
            columns = [batch.column(n) for n in kept]
            columns.append(pa.array([n for _, n, _ in rows], pa.int64()))
            names = [*kept, "n_tokens"]
            if with_ids:
                columns.append(pa.array([[int(i) for i in ids.split(",")] if ids else [] for ids, _, _ in rows], pa.list_(pa.int32())))
                columns.append(pa.array([d.decode("utf-8", "replace") for _, _, d in rows], pa.string()))
                names += ["ids", "decoded"]
            else:
                sha = lambda data: hashlib.sha256(data).hexdigest()
                columns.append(pa.array([sha(ids.encode()) for ids, _, _ in rows], pa.string()))
                columns.append(pa.array([sha(d) for _, _, d in rows], pa.string()))
                names += ["ids_sha256", "decoded_sha256"]
            yield pa.RecordBatch.from_arrays(columns, names)

    return run


def _check(model: PieceModel, texts: list[str], rows: list[tuple[str, int, bytes]], share: float) -> None:
    def differs(text: str):
        model.seen.clear()  # nothing of it is handed to a later task
        raise ValueError(f"The library encodes or decodes a text of {len(text)} characters differently")

    parts, model.fresh = model.fresh, []
    for (part, ids), found in zip(parts, model.library.encode([p for p, _ in parts], num_threads=1), strict=True):
        # Before a line end the library's own space is a piece of itself.
        if ",".join(map(str, found[1:] if part[0] == "\n" else found)) != ids:
            differs(part)
    least = int(share * 2**32)
    at = [k for k, t in enumerate(texts) if zlib.crc32(t.encode()) < least or "  " in t or t[:1] == " " or t[-1:] == " " or SPACE in t]
    for k, found in zip(at, model.library.encode([texts[k] for k in at], num_threads=1), strict=True):
        if ",".join(map(str, found)) != rows[k][0] or model.library.decode(found).encode() != rows[k][2]:
            differs(texts[k])


def encode(
    docs: DataFrame, model_path: str, *, text: str = "text", check_share: float = 1 / 16, digests: bool = False, keep_text: bool = True
) -> DataFrame:
    """``docs`` with ``n_tokens`` and ``ids, decoded``, or with ``digests`` their SHA-256 instead.

    ``keep_text=False`` leaves the text column out.
    """
    small_batches(docs.sparkSession)
    outputs = ("n_tokens", "ids_sha256", "decoded_sha256") if digests else ("n_tokens", "ids", "decoded")
    left_out = outputs if keep_text else (*outputs, text.lower())
    kept = [F.col(f"`{c}`") for c in docs.columns if c.lower() not in left_out]
    rows = docs.select(*kept, F.col(f"`{text}`").alias("__text"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields if f.name != "__text")
    new = "n_tokens long, ids_sha256 string, decoded_sha256 string" if digests else "n_tokens long, ids array<int>, decoded string"
    return rows.mapInArrow(tidy(_encoded(model_path, check_share, not digests)), f"{schema}, {new}" if schema else new)
