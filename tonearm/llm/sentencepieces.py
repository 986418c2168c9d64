"""SentencePiece encoding and decoding by suffix-array matching.

Texts are cut into units (spaces and the word after them; no piece crosses a unit).
The distinct units of a batch are concatenated and indexed by a suffix array; every
piece of the vocabulary is binary-searched in it, which gives all its occurrences as a
range; the resulting edges are sorted by end position and relaxed from left to right.

The model merges by score, so an edge is relaxed onto a position when the last piece
before it and its own piece would stay apart if the two were encoded alone; for merge
vocabularies exactly one edge per position passes, and the path is the encoding that
merging gives.  Units in which merges of tied score meet (runs of spaces) depend on
more than pairs and are merged plainly.  Characters outside the vocabulary become byte
pieces.
"""

from __future__ import annotations

import hashlib
import heapq
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
SPACE = "▁"
#: Code points of new units indexed at once and of texts held until then; units and
#: pairs of pieces remembered per worker.  They bound a worker's memory.
INDEX_CHARS, HELD_CHARS, KEPT_UNITS, KEPT_PAIRS = 1 << 18, 1 << 20, 80_000, 400_000
#: Of the pairs remembered, so many (a power of two) are looked up all at once; two of one place displace each other.
PAIR_PLACES = 1 << 20
#: Rows encoded and sent back at once.
ROWS = 512
#: Up to twice so many code points are merged by scanning, longer units with a heap.
PAIR_CHARS = 16
_BYTES = -2  # an edge over one character outside the vocabulary


@dataclass
class Vocabulary:
    """Pieces by id with scores and kinds; everything else is derived per worker."""

    pieces: list[str]
    scores: list[float]
    kinds: list[str]  # normal, byte, control, unknown
    ids: dict[str, int] = field(default_factory=dict, repr=False)

    @classmethod
    def load(cls, path: str = MODEL) -> Vocabulary:
        import sentencepiece

        m = sentencepiece.SentencePieceProcessor(model_file=path)
        kind = lambda i: ("unknown" if m.is_unknown(i) else "control" if m.is_control(i) else
                          "byte" if m.is_byte(i) else "normal")
        size = range(m.get_piece_size())
        return cls([m.id_to_piece(i) for i in size], [m.get_score(i) for i in size], [kind(i) for i in size]).ready()

    def ready(self) -> Vocabulary:
        self.ids = {p: i for i, p in enumerate(self.pieces) if self.kinds[i] == "normal"}
        self.byte_ids = {int(p[3:5], 16): i for i, p in enumerate(self.pieces) if self.kinds[i] == "byte"}
        self.unknown = self.kinds.index("unknown") if "unknown" in self.kinds else 0
        seen: dict[float, int] = {}
        for i in self.ids.values():
            seen[self.scores[i]] = seen.get(self.scores[i], 0) + 1
        self.tied = {p for p, i in self.ids.items() if len(p) > 1 and seen[self.scores[i]] > 1}
        # Only pieces that encode to themselves can be part of an encoding.
        usable = [p for p in self.ids if self.merge(p) == [self.ids[p]]]
        chars = sorted({c for p in self.ids for c in p})
        self.char_id = {ord(c): k + 1 for k, c in enumerate(chars)}
        self.longest = max(map(len, usable), default=1)
        self.usable = np.array([self.ids[p] for p in usable], np.int32)
        self.lens = np.array([len(p) for p in usable], np.int32)
        width = 2 * self.longest
        keys = ["".join(chr(self.char_id[ord(c)]) for c in p).encode("utf-16-be", "surrogatepass") for p in usable]
        self.low = np.array(keys, f"S{width}")
        self.high = np.array([k + b"\xff" * (width - len(k)) for k in keys], f"S{width}")
        pairs = {(self.char_id[ord(a)] << 16) | self.char_id[ord(b)] for p in self.ids for a, b in zip(p, p[1:])}
        self.inner = np.array(sorted(pairs), np.int64)
        self.char_table = np.zeros(0x110001, np.uint16)
        for c, k in self.char_id.items():
            self.char_table[c] = k
        self.length_of = np.ones(len(self.pieces) + 2, np.int32)
        self.length_of[self.usable] = self.lens
        line = "" if ord("\n") in self.char_id else "\n"  # a line end no piece holds is a cut
        self.cut = re.compile(f"{SPACE}+[^{SPACE}{line}]*|[^{SPACE}{line}]+" + ("|\n" if line else ""))
        return self

    def merge(self, unit: str) -> list[int]:
        """Plain merging: the best-scored adjacent pair first, the leftmost of equals."""
        n = len(unit)
        if n <= 2 * PAIR_CHARS:
            return self._merge_short(unit)
        sym, right, left = list(unit), list(range(1, n + 1)), list(range(-1, n - 1))
        heap: list[tuple[float, int, str, int]] = []

        def offer(i: int) -> None:
            j = right[i]
            if j < n and (k := self.ids.get(sym[i] + sym[j])) is not None:
                heapq.heappush(heap, (-self.scores[k], i, sym[i] + sym[j], j))
        for i in range(n - 1):
            offer(i)
        while heap:
            _, i, both, j = heapq.heappop(heap)
            if sym[i] is None or right[i] != j or sym[j] is None or sym[i] + sym[j] != both:
                continue
            sym[i], sym[j], right[i] = both, None, right[j]
            if right[j] < n:
                left[right[j]] = i
            if left[i] >= 0:
                offer(left[i])
            offer(i)
        return [t for s in sym if s is not None for t in self.known(s)]

    def _merge_short(self, unit: str) -> list[int]:
        ids, scores, sym = self.ids, self.scores, list(unit)
        rank = [scores[k] if (k := ids.get(a + b)) is not None else -np.inf for a, b in zip(sym, sym[1:])]
        while rank and (best := max(rank)) > -np.inf:
            i = rank.index(best)
            sym[i:i + 2] = [sym[i] + sym[i + 1]]
            del rank[i]
            for j in (i - 1, i):
                if 0 <= j < len(rank):
                    k = ids.get(sym[j] + sym[j + 1])
                    rank[j] = -np.inf if k is None else scores[k]
        return [t for s in sym for t in self.known(s)]

    def known(self, symbol: str) -> list[int]:
        if symbol in self.ids:
            return [self.ids[symbol]]
        return [self.byte_ids.get(b, self.unknown) for b in symbol.encode("utf-8", "surrogatepass")] \
            if self.byte_ids else [self.unknown]

    def decode(self, ids: list[int]) -> str:
        if not hasattr(self, "raw"):
            text = {"normal": lambda p: p.replace(SPACE, " ").encode("utf-8", "surrogatepass"),
                    "byte": lambda p: bytes([int(p[3:5], 16)]), "control": lambda p: b"",
                    "unknown": lambda p: " ⁇ ".encode()}
            self.raw = [text[k](p) for p, k in zip(self.pieces, self.kinds)]
        out = b"".join([self.raw[i] for i in ids]).decode("utf-8", "replace")
        return out[1:] if ids and self.pieces[ids[0]].startswith(SPACE) else out


def _suffix_array(ids: np.ndarray, width: int) -> np.ndarray:
    """Suffixes of ``ids`` in order of their first ``width`` items or more, by prefix doubling."""
    n = len(ids)
    far = np.concatenate([ids, np.zeros(3, ids.dtype)]).astype(np.uint64)
    key = (far[:n] << np.uint64(48)) | (far[1:n + 1] << np.uint64(32)) | (far[2:n + 2] << np.uint64(16)) | far[3:]
    done = 4
    while True:
        order = np.argsort(key)
        if done >= width:
            return order
        line = key[order]
        rank = np.zeros(n, np.uint64)
        rank[order] = np.cumsum(np.concatenate([[0], line[1:] != line[:-1]])) + 1
        key = rank << np.uint64(32)
        key[: max(n - done, 0)] |= rank[done:]
        done *= 2


def _packed(ids: list[int]) -> bytes:
    return np.array(ids, np.int32).tobytes()


class Encoder:
    """Encodes batches of texts; remembers units and pairs up to fixed numbers."""

    def __init__(self, vocabulary: Vocabulary) -> None:
        self.v, self.units, self.older, self.pairs = vocabulary, {}, {}, {}  # units: their ids as int32 bytes
        self.place_code, self.place_said = np.full(PAIR_PLACES, -1, np.int64), np.zeros(PAIR_PLACES, bool)
        ends = "".join(re.escape(p) + "|" for p in sorted(vocabulary.tied, key=len))[:-1]
        self.plain = re.compile(ends) if ends else None

    def encode(self, texts: Iterable[str]) -> list[np.ndarray]:
        out: list[np.ndarray] = []
        todo: list[list[str]] = []
        fresh: set[str] = set()
        size = held = 0
        for text in texts:
            units = self.v.cut.findall(SPACE + text.replace(" ", SPACE)) if text else []
            todo.append(units)
            new = set(units).difference(self.units, fresh)
            fresh |= new
            size, held = size + sum(map(len, new)), held + len(text)
            if size >= INDEX_CHARS or held >= HELD_CHARS:
                out += self._flush(todo, fresh)
                todo, fresh, size, held = [], set(), 0, 0
        return out + self._flush(todo, fresh)

    def _flush(self, todo: list[list[str]], fresh: set[str]) -> list[np.ndarray]:
        again = fresh.intersection(self.older)
        self.units.update((u, self.older[u]) for u in again)
        fresh = fresh - again
        tied = {u for u in fresh if self.plain and self.plain.search(u)}
        self.units.update((u, _packed(self.v.merge(u))) for u in tied)
        self._index(sorted(fresh - tied))
        ids_of = self.units.__getitem__
        out = [np.frombuffer(b"".join(map(ids_of, units)), np.int32) for units in todo]
        if len(self.units) > KEPT_UNITS:  # units not met since the last turn-over are forgotten
            self.units, self.older = {}, self.units
        if len(self.pairs) > KEPT_PAIRS:
            self.pairs = {}
        return out

    def _apart(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Whether each pair of pieces stays two pieces when encoded alone."""
        code = (left.astype(np.int64) << 32) | right
        place = ((code.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(40)).view(np.int64) & (PAIR_PLACES - 1)
        known = self.place_code[place] == code
        said = self.place_said[place]
        if not known.all():
            said[~known] = self._ask(code[~known], place[~known])
        return said

    def _ask(self, code: np.ndarray, place: np.ndarray) -> np.ndarray:
        """:meth:`_apart` for pairs that are not in their place, which they then take."""
        code, first, back = np.unique(code, return_index=True, return_inverse=True)
        pairs, pieces, said = self.pairs, self.v.pieces, np.empty(len(code), bool)
        for k, c in enumerate(code.tolist()):
            ok = pairs.get(c)
            if ok is None:
                a, b = c >> 32, c & 0xFFFFFFFF
                ok = pairs[c] = self.v.merge(pieces[a] + pieces[b]) == [a, b]
            said[k] = ok
        place, last = np.unique(place[first][::-1], return_index=True)  # one pair for each place
        last = len(code) - 1 - last
        self.place_code[place], self.place_said[place] = code[last], said[last]
        return said[back]

    def _index(self, units: list[str]) -> None:
        if not units:
            return
        v = self.v
        # 0x110000 marks the end of a unit; like unknown characters it has character id 0.
        points = np.frombuffer("\0".join(units).encode("utf-32-le", "surrogatepass") + b"\0\0\0\0", "<u4").copy()
        lens = np.fromiter(map(len, units), np.int64, len(units))
        stops = np.cumsum(lens + 1) - 1
        starts = stops - lens
        points[stops] = 0x110000
        ids = v.char_table[points]
        n, w = len(ids), v.longest
        # Suffixes in order of their first `longest` characters, as fixed-width big-endian keys.
        array = _suffix_array(ids, w)
        padded = np.concatenate([ids, np.zeros(w, np.uint16)]).astype(">u2")
        keys = np.lib.stride_tricks.sliding_window_view(padded, w)[array].view(f"S{2 * w}").ravel()
        lo, hi = np.searchsorted(keys, v.low, "left"), np.searchsorted(keys, v.high, "right")
        del keys
        count = hi - lo
        piece = np.repeat(v.usable, count)
        width = np.repeat(v.lens, count)
        start = array[np.repeat(lo - (np.cumsum(count) - count), count) + np.arange(count.sum())]
        other = np.flatnonzero((ids == 0) & (points != 0x110000))
        piece = np.concatenate([piece, np.full(len(other), _BYTES, np.int32)])
        width = np.concatenate([width, np.ones(len(other), np.int32)])
        start = np.concatenate([start, other])
        # A path begins anew after every two characters that no piece holds side by side.
        begin = np.ones(n, bool)
        begin[1:] = ~np.isin((ids[:-1].astype(np.int64) << 16) | ids[1:], v.inner)
        begin[starts] = True
        base = np.maximum.accumulate(np.where(begin, np.arange(n), 0))
        end = start + width
        level = end - base[start]
        order = np.argsort(level, kind="stable")
        piece, start, end, level = piece[order], start[order], end[order], level[order]
        last = np.full(n + 1, -1, np.int32)
        bounds = np.searchsorted(level, np.arange(1, (level[-1] if len(level) else 0) + 2))
        for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
            s, p, e = start[a:b], piece[a:b], end[a:b]
            first = begin[s]
            before = last[s]
            ask = ~first & (before >= 0)
            first[ask] = self._apart(before[ask], p[ask])
            last[e[first]] = p[first]
        self._trace(units, points, starts, stops, last)

    def _trace(self, units, points, starts, stops, last) -> None:
        """Walk every unit back from its end and keep its pieces."""
        v, is_end = self.v, np.zeros(len(last), bool)
        at, floor = stops.copy(), starts
        while True:
            on = at > floor
            at, floor = at[on], floor[on]
            if not len(at):
                break
            is_end[at] = True
            p = last[at]
            at = at - np.where(p >= 0, v.length_of[p], 1)
        ends = np.flatnonzero(is_end)
        found = last[ends]
        a = np.searchsorted(ends, starts, "right").tolist()
        b = np.searchsorted(ends, stops, "right").tolist()
        lens, raw = v.length_of[found].astype(np.int64), found.astype(np.int32).tobytes()
        total = np.concatenate([[0], np.cumsum(np.where(found == -1, 1 << 40, lens))])
        covered = (total[b] - total[a] == stops - starts).tolist()
        odd = set(np.flatnonzero(found == _BYTES).tolist()) if (found == _BYTES).any() else ()
        for u, i, j, ok in zip(units, a, b, covered):
            if not ok:
                self.units[u] = _packed(v.merge(u))
            elif odd and not odd.isdisjoint(range(i, j)):
                self.units[u] = _packed([t for k in range(i, j) for t in (
                    v.known(chr(points[ends[k] - 1])) if found[k] == _BYTES else (found[k],))])
            else:
                self.units[u] = raw[4 * i:4 * j]


_ENCODERS: dict[str, Encoder] = {}


def _encoder(model: str, shared) -> Encoder:
    """The worker's encoder of a model: what it remembers serves all tasks of the worker."""
    if model not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[model] = Encoder(shared.value)
    return _ENCODERS[model]


def encode(docs: DataFrame, model: str = MODEL, read_back: bool = False) -> DataFrame:
    """The columns of ``docs`` packed in ``row``, plus token_ids array<int>.

    ``read_back`` adds ``decoded``, the text that the ids decode to, in the same pass.

    Null and empty texts give no pieces; any other text gives what the model's own
    merging gives, with the model's leading space.  Repeated rows are encoded alike; an
    empty table gives no rows.
    """
    vocabulary = Vocabulary.load(model)
    key = hashlib.sha256(repr((vocabulary.pieces, vocabulary.scores, vocabulary.kinds)).encode()).hexdigest()
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(key, shared)
        for batch in (b.slice(at, ROWS) for b in batches for at in range(0, b.num_rows, ROWS)):
            texts = batch.column("row").field("text")
            ids = encoder.encode(t.as_py() or "" for t in texts)
            offsets = np.concatenate([[0], np.cumsum([len(x) for x in ids])]).astype(np.int32)
            flat = np.concatenate(ids) if ids else np.zeros(0, np.int32)
            cols = [batch.column("row"), pa.ListArray.from_arrays(offsets, flat)]
            if read_back:
                cols.append(pa.array([encoder.v.decode(x.tolist()) for x in ids], pa.string()))
            yield pa.RecordBatch.from_arrays(cols, names=["row", "token_ids", "decoded"][:len(cols)])

    packed = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"))
    schema = T.StructType(list(packed.schema.fields)).add("token_ids", T.ArrayType(T.IntegerType()))
    return packed.mapInArrow(run, schema.add("decoded", "string") if read_back else schema)


def decode(tokens: DataFrame, model: str = MODEL) -> DataFrame:
    """Add ``decoded`` to rows with token_ids: null ids give null, no ids the empty text.

    A text without U+2581 comes back exactly; the model writes that character and the
    space alike, so it comes back as a space.
    """
    shared = tokens.sparkSession.sparkContext.broadcast(Vocabulary.load(model))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = shared.value
        for batch in batches:
            out = [v.decode(x.values.to_numpy().tolist()) if x.is_valid else None for x in batch.column("token_ids")]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.string())],
                                             names=[*batch.schema.names, "decoded"])

    return tokens.mapInArrow(run, T.StructType(list(tokens.schema.fields)).add("decoded", "string"))


def tokenised(docs: DataFrame, model: str = MODEL) -> DataFrame:
    """doc_id, n_tokens, token_ids, decoded_sha256, round_trip for every row of ``docs``."""
    back = encode(docs.select("doc_id", "text"), model, read_back=True)
    return back.select("row.doc_id", F.size("token_ids").cast("long").alias("n_tokens"), "token_ids",
                       F.sha2("decoded", 256).alias("decoded_sha256"),
                       (F.col("decoded") == F.coalesce("row.text", F.lit(""))).alias("round_trip"))
