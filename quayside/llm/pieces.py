"""SentencePiece encoding and decoding for merge-type (BPE) vocabularies.

An agenda holds the adjacent symbol pairs of a text that some piece joins; the pair whose piece scores
best (leftmost among equals) is merged first, which puts its new neighbours on the agenda. No piece of
such a vocabulary has a space mark after another character, so a text falls into units (space marks
and what follows up to the next ones) that cannot merge with each other; equal units are encoded once.
Units are cut and told apart in Arrow buffers, and ids stay numbers of 32 bits from the agenda to the
result. Short units go through their agendas side by side in numpy arrays, long ones through a heap.
"""

from __future__ import annotations

import heapq
import os
from collections.abc import Callable, Iterable
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.llm.common import with_columns_of
from quayside.llm.wordscan import buffers

SPACE = "▁"
#: Units longer than this go through the heap, and are not remembered.
LONG = 40
#: Bytes of units and ids that a worker remembers in each of two generations. It bounds memory only:
#: units that drop out unused are encoded again.
REMEMBERED = 48 << 20
#: What a remembered unit takes besides its characters and ids.
OVERHEAD = 200
_NEVER = np.int32(2**31 - 1)


class MergeVocabulary:
    """The pieces of a model file, and the agenda over them."""

    def __init__(self, model: str):
        import sentencepiece

        self.library = sentencepiece.SentencePieceProcessor(model_file=model)
        sp, n = self.library, self.library.get_piece_size()
        kind = [("byte" if sp.is_byte(i) else "control" if sp.is_control(i) or sp.is_unknown(i) else
                 "unused" if sp.is_unused(i) else "normal") for i in range(n)]
        if "unused" in kind:
            raise ValueError("vocabularies with unused pieces are not supported")
        self.ids = {sp.id_to_piece(i): i for i in range(n) if kind[i] == "normal"}
        self.bytes = [sp.piece_to_id(f"<0x{b:02X}>") for b in range(256)] if "byte" in kind else None
        self.unknown = sp.unk_id()
        if any(SPACE in p.lstrip(SPACE) for p in self.ids) or sp.encode("a  b ") != sp.encode("a  b ", enable_sampling=False):
            raise ValueError("pieces with inner space marks are not supported")
        if sp.normalize(" Ａ  b́ ") != f"{SPACE}{SPACE}Ａ{SPACE}{SPACE}b́{SPACE}":
            raise ValueError("only models that normalise nothing but spaces are supported")
        scores = sorted({sp.get_score(i) for i in self.ids.values()}, reverse=True)
        place = {s: k for k, s in enumerate(scores)}
        rank = {i: place[sp.get_score(i)] for i in self.ids.values()}
        # symbols: ids of pieces, then n + code point of characters that are no piece
        self.n = n
        joins = {(self._symbol(p[:k]), self._symbol(p[k:])): i
                 for p, i in self.ids.items() for k in range(1, len(p))
                 if self._can_be(p[:k]) and self._can_be(p[k:])}
        self.joins = {pair: (rank[i], i) for pair, i in joins.items()}
        keys = np.array([a * self._wide + b for a, b in joins], np.int64)
        order = np.argsort(keys)
        self.keys = keys[order]
        self.key_rank = np.array([rank[i] for i in joins.values()], np.int32)[order]
        self.key_piece = np.array(list(joins.values()), np.int64)[order]
        inner = {c for p in self.ids if len(p) > 1 for c in p}
        self.apart = "\n" not in inner  # a line feed that no piece holds parts units, too
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.held = 0

    _wide = 1 << 22

    def _can_be(self, s: str) -> bool:
        return len(s) == 1 or s in self.ids

    def _symbol(self, s: str) -> int:
        return self.ids[s] if s in self.ids else self.n + ord(s)

    def _final(self, symbols: Iterable[int]) -> list[int]:
        """Symbols that are no piece become the bytes of their character, or the unknown piece."""
        out: list[int] = []
        for s in symbols:
            if s < self.n:
                out.append(s)
            elif self.bytes:
                out.extend(self.bytes[b] for b in chr(s - self.n).encode())
            else:
                out.append(self.unknown)
        return out

    def encode_long(self, unit: str) -> list[int]:
        """One unit through a heap of pairs: (rank, place of the left symbol)."""
        symbols = [self._symbol(c) for c in unit]
        after = list(range(1, len(symbols))) + [-1]
        before = list(range(-1, len(symbols) - 1))
        agenda: list[tuple[int, int, int, int]] = []

        def offer(left: int, right: int) -> None:
            if left >= 0 and right >= 0 and (found := self.joins.get((symbols[left], symbols[right]))):
                heapq.heappush(agenda, (found[0], left, symbols[left], symbols[right]))

        for i in range(len(symbols) - 1):
            offer(i, i + 1)
        while agenda:
            _, left, a, b = heapq.heappop(agenda)
            right = after[left]
            if symbols[left] != a or right < 0 or symbols[right] != b:
                continue  # one of the pair has been merged since
            symbols[left], symbols[right] = self.joins[a, b][1], -1
            after[left] = after[right]
            if after[right] >= 0:
                before[after[right]] = left
            offer(before[left], left)
            offer(left, after[left])
        return self._final(s for s in symbols if s >= 0)

    def _look_up(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and piece that joins each pair; _NEVER where none does."""
        key = left * self._wide + right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        hit = (self.keys[at] == key) & (left >= 0) & (right >= 0)
        return np.where(hit, self.key_rank[at], _NEVER), self.key_piece[at]

    def encode_short(self, units: list[str]) -> list[bytes]:
        """Ids of units of like length, as the bytes of 32-bit numbers; one step of each agenda at a time."""
        size = max(map(len, units))
        n = len(units)
        codes = np.frombuffer("".join(u.ljust(size, "\0") for u in units).encode("utf-32-le"), np.uint32)
        codes = codes.reshape(n, size).astype(np.int64)
        length = np.array([len(u) for u in units])
        distinct, back = np.unique(codes, return_inverse=True)
        symbol = np.array([self._symbol(chr(c)) for c in distinct], np.int64)[back].reshape(n, size)
        column = np.arange(size)
        symbol[column >= length[:, None]] = -1
        if size > 1:
            rank, piece = self._look_up(symbol[:, :-1].ravel(), symbol[:, 1:].ravel())
            rank, piece = rank.reshape(n, size - 1), piece.reshape(n, size - 1)
            # place size stands for none; its symbol is -1
            wide = np.concatenate([symbol, np.full((n, 1), -1)], axis=1)
            after = np.broadcast_to(np.append(column + 1, size), (n, size + 1)).copy()
            before = np.broadcast_to(np.append(np.where(column, column - 1, size), size), (n, size + 1)).copy()
            rank = np.concatenate([rank, np.full((n, 2), _NEVER, np.int32)], axis=1)
            piece = np.concatenate([piece, np.zeros((n, 2), np.int64)], axis=1)
            live = np.arange(n)
            while len(live):
                best = rank[live].argmin(axis=1)
                on = rank[live, best] != _NEVER
                live, best = live[on], best[on]
                if not len(live):
                    break
                right = after[live, best]
                wide[live, best] = piece[live, best]
                wide[live, right] = -1
                rank[live, right] = _NEVER
                then = after[live, right]
                after[live, best] = then
                before[live, then] = best
                rank[live, best], piece[live, best] = self._look_up(wide[live, best], wide[live, then])
                left = before[live, best]
                r, p = self._look_up(wide[live, left], wide[live, best])
                rank[live, left], piece[live, left] = r, p
            symbol = wide[:, :-1]
        kept = symbol >= 0
        flat, counts = symbol[kept].astype(np.int32), kept.sum(axis=1)
        ends = np.cumsum(counts).tolist()
        odd = (np.where(kept, symbol, 0) >= self.n).any(axis=1).tolist()
        data = flat.tobytes()
        out, start = [], 0
        for end, o in zip(ends, odd):
            out.append(_blob(self._final(flat[start:end].tolist())) if o else data[4 * start : 4 * end])
            start = end
        return out

    def _encode_units(self, units: Iterable[str]) -> dict[str, bytes]:
        out = {}
        by_length: dict[int, list[str]] = {}
        for u in units:
            if len(u) > LONG:
                out[u] = _blob(self.encode_long(u))
            else:
                by_length.setdefault((len(u) + 1) // 2, []).append(u)
        for same in by_length.values():
            out.update(zip(same, self.encode_short(same)))
        return out

    def encode_units(self, units: list[str]) -> dict[str, list[int]]:
        """Ids of distinct units."""
        return {u: np.frombuffer(x, np.int32).tolist() for u, x in self._encode_units(units).items()}

    def _cut(self, text: pa.Array) -> tuple[pa.Array, np.ndarray]:
        """The units of all texts, with spaces for space marks, and at which unit each text begins."""
        if pc.any(pc.match_substring(text, SPACE)).as_py():
            text = pc.replace_substring(text, SPACE, " ")
        data, at = buffers(text)
        full = np.diff(at) > 0
        data = np.insert(data, at[:-1][full], ord(" "))  # a text begins with a space mark
        at = at + np.concatenate([[0], np.cumsum(full)])
        space = data == ord(" ")
        begins = space.copy()
        begins[1:] &= ~space[:-1]
        if self.apart:
            line = data == ord("\n")
            begins |= line
            begins[1:] |= line[:-1]
        begins[at[:-1][full]] = True
        start = np.flatnonzero(begins)
        wide = pa.LargeStringArray.from_buffers(len(start), pa.py_buffer(np.append(start, len(data)).astype(np.int64)), pa.py_buffer(data))
        return wide, np.searchsorted(start, at)

    def _ids_of(self, units: list[str]) -> list[bytes]:
        """Ids of distinct units, remembered ones among them."""
        if self.held > REMEMBERED:
            self.known, self.older, self.held = {}, self.known, 0
        known, older = self.known, self.older
        out = list(map(known.get, units))
        missing = [i for i, x in enumerate(out) if x is None]
        marked = {units[i]: units[i].replace(" ", SPACE) for i in missing if units[i] not in older}
        new = self._encode_units(marked.values())
        for i in missing:
            u = units[i]
            out[i] = new[marked[u]] if u in marked else older[u]
            if len(u) <= LONG:
                known[u] = out[i]
                self.held += OVERHEAD + len(u) + len(out[i])
        return out

    def encode_arrow(self, text: pa.Array) -> pa.ListArray:
        """The ids of each text, as the library's encode(text) gives them; none of a null text."""
        units, first = self._cut(text)
        coded = units.dictionary_encode()
        blobs = self._ids_of(coded.dictionary.to_numpy(zero_copy_only=False).tolist())
        flat = np.frombuffer(b"".join(blobs), np.int32)
        size = np.fromiter(map(len, blobs), np.int64, len(blobs)) // 4
        of = coded.indices.to_numpy()
        count, start = size[of], (np.cumsum(size) - size)[of]
        end = np.concatenate([[0], np.cumsum(count)])
        ids = flat[np.repeat(start - end[:-1], count) + np.arange(end[-1])]
        return pa.ListArray.from_arrays(pa.array(end[first].astype(np.int32)), pa.array(ids))

    def encode(self, texts: list[str | None]) -> list[list[int]]:
        return self.encode_arrow(pa.array(texts, pa.string())).to_pylist()

    def decode(self, ids: list[list[int]]) -> list[str]:
        return self.library.decode(ids, num_threads=1) if ids else []


def _blob(ids: list[int]) -> bytes:
    return np.array(ids, np.int32).tobytes()


_VOCABULARIES: dict[str, MergeVocabulary] = {}


def vocabulary(model: str) -> MergeVocabulary:
    """The vocabulary of a model file, made once for a worker process."""
    if model not in _VOCABULARIES:
        where = model if os.path.exists(model) else SparkFiles.get(os.path.basename(model))
        _VOCABULARIES[model] = MergeVocabulary(where)
    return _VOCABULARIES[model]


def encoder(model: str, text_col: str, check: bool) -> Callable[[pa.RecordBatch], list[pa.Array]]:
    """ids and decoded text of the rows of an Arrow batch."""

    def run(part: pa.RecordBatch) -> list[pa.Array]:
        v = vocabulary(model)
        ids = v.encode_arrow(part.column(text_col))
        if check:
            lists = v.library.encode([t or "" for t in part.column(text_col).to_pylist()], num_threads=1)
            ends = np.cumsum([0, *map(len, lists)])
            same = np.array_equal(ends, ids.offsets.to_numpy()) and np.array_equal(
                np.fromiter(chain.from_iterable(lists), np.int32, ends[-1]), ids.values.to_numpy())
            if not same:
                raise ValueError("ids differ from the library's")
        else:
            lists = ids.to_pylist()
        return [ids, pa.array(v.decode(lists), pa.string())]

    return run


def encode_pieces(docs: DataFrame, model: str, text_col: str = "text", check: bool = False) -> DataFrame:
    """All columns of ``docs`` and ids (array of int), decoded (string: the library's decode of ids).

    ``model``: path of a sentencepiece BPE model, on every machine, or sent to them by
    SparkContext.addFile. A null or empty text has no ids and decodes to an empty string. Texts of any
    length are encoded whole; repeated rows, null and repeated ids are encoded row by row; an empty
    table gives no rows. An input column named ids or decoded (in any case) is replaced.
    ``check``: hold every Arrow batch against the library's own encode, and fail where they differ.
    """

    rows = docs.select(*[F.col(f"`{c}`") for c in docs.columns if c.lower() not in ("ids", "decoded")])
    return with_columns_of(rows, text_col, "ids array<int>, decoded string", encoder(model, text_col, check))
