"""Removal of passages that an earlier document already holds, behind a count-min prefilter.

Documents are dealt to blocks by a hash. Each block makes a sketch of its windows, in sparse form: the
sorted counter numbers and whether a counter got more than one. The sketches are cut into segments of
the counter range and merged segment by segment; the merged counters overestimate how often a window
occurs and never underestimate it. A segment answers each block with one bit for each of its counters:
estimated repeated or not. In a second pass only windows whose counters are repeated in every row of the
sketch are grouped, by 128 bits of hash, again segment by segment, and a block gets one bit a window
back: is there a smaller document in another block? A third reading of the block removes the words.

Neither the sketch nor a list of windows is held in one place: messages are a few thousand numbers,
a very frequent window is one entry a block, and everything grows in proportion to the text.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.llm.wordscan import inside, scan, windows

WINDOW = 13
#: Rows of the sketch, and counters a row for each window of the input.
DEPTH = 2
WIDTH = 8
#: Text bytes of a block, and counters (as a power of two) of a segment.
BLOCK_BYTES = 8 << 20
SEGMENT_BITS = 22

_MESSAGE = "part long, block long, step int, n long, flags binary, body binary, more binary"
_U = np.uint64
_LAST = np.iinfo(np.int64).max


def _bits(flags: np.ndarray) -> bytes:
    return np.packbits(flags).tobytes()


def _unbits(data: bytes, n: int) -> np.ndarray:
    return np.unpackbits(np.frombuffer(data, np.uint8), count=n).astype(bool)


def _pack_sorted(x: np.ndarray) -> tuple[bytes, bytes]:
    """Ascending numbers as 16-bit steps, larger steps aside."""
    step = np.diff(x, prepend=0)
    large = np.flatnonzero(step >= 0xFFFF)
    short = np.minimum(step, 0xFFFF).astype(np.uint16)
    return short.tobytes(), step[large].astype(np.int64).tobytes()


def _unpack_sorted(body: bytes, more: bytes) -> np.ndarray:
    step = np.frombuffer(body, np.uint16).astype(np.int64)
    step[step == 0xFFFF] = np.frombuffer(more, np.int64)
    return np.cumsum(step)


def _message(rows: list[tuple]) -> pa.Table:
    names = ["part", "block", "step", "n", "flags", "body", "more"]
    kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.binary()]
    columns = list(zip(*rows)) or [()] * len(names)
    return pa.table([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)


class _Block:
    """The windows of a block, and what the segments have answered so far."""

    def __init__(self, table: pa.Table, width_bits: int, window: int, depth: int):
        text = table.column("text").combine_chunks()
        text = text if isinstance(text, pa.Array) else pa.concat_arrays(text.chunks or [pa.array([], pa.string())])
        self.ids = table.column("id").fill_null(_LAST).to_numpy().astype(np.int64)
        self.words = scan(text)
        self.window, self.depth, self.width_bits = window, depth, width_bits
        self.at = inside(self.words.first, window)
        self.h = [windows(self.words.hash, window, salt)[self.at] for salt in range(2)]

    def counters(self, row: int) -> tuple[np.ndarray, np.ndarray]:
        """Counter numbers of one row of the sketch in ascending order, and the window of each."""
        if row < 2:
            number = self.h[row] >> _U(64 - self.width_bits)
        else:
            number = windows(self.words.hash, self.window, row)[self.at] >> _U(64 - self.width_bits)
        place_bits = 64 - self.width_bits
        if len(number) >> place_bits:
            order = np.argsort(number, kind="stable")
            return number[order].astype(np.int64), order
        both = np.sort((number << _U(place_bits)) | np.arange(len(number), dtype=_U))
        return (both >> _U(place_bits)).astype(np.int64), (both & _U((1 << place_bits) - 1)).astype(np.int64)

    def sketch(self, block: int) -> Iterator[tuple]:
        for row in range(self.depth):
            number, _ = self.counters(row)
            if not len(number):
                continue
            head = np.flatnonzero(np.diff(number, prepend=-1))
            many = np.diff(np.append(head, len(number))) > 1
            number = number[head]
            part = number >> SEGMENT_BITS
            first = np.flatnonzero(np.diff(part, prepend=-1))
            for a, b in zip(first.tolist(), np.append(first[1:], len(part)).tolist()):
                p = int(part[a])
                body, more = _pack_sorted(number[a:b] - (p << SEGMENT_BITS))
                # rows of the sketch have segments of their own
                yield p * self.depth + row, block, row, b - a, _bits(many[a:b]), body, more

    def suspects(self, answers: dict[int, list[tuple]]) -> np.ndarray:
        """Places (in self.at) of windows estimated repeated."""
        flag = np.ones(len(self.at), bool)
        for row in range(self.depth):
            number, order = self.counters(row)
            if not len(number):
                continue
            head = np.diff(number, prepend=-1) != 0
            told = np.concatenate([_unbits(f, n) for _, n, f in sorted(answers.get(row, []))])
            flag[order] &= told[np.cumsum(head) - 1]
        return np.flatnonzero(flag)

    def groups(self, suspects: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Order of the suspects by their 128 bits, heads of equal runs in it, smallest id of each."""
        a, b = self.h[0][suspects], self.h[1][suspects]
        order = np.lexsort((b, a))
        a, b = a[order], b[order]
        head = np.flatnonzero(np.concatenate([[True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])])) if len(a) else order
        owner = self.owner()[suspects][order]
        least = np.minimum.reduceat(owner, head) if len(head) else owner
        return order, head, least

    def owner(self) -> np.ndarray:
        """The id of the document that each window is in."""
        text = np.searchsorted(self.words.first, self.at, side="right") - 1
        return self.ids[text]

    def candidates(self, block: int, suspects: np.ndarray, parts_bits: int) -> Iterator[tuple]:
        order, head, least = self.groups(suspects)
        if not len(head):
            return
        a, b = self.h[0][suspects][order][head], self.h[1][suspects][order][head]
        part = (a >> _U(64 - parts_bits)).astype(np.int64) if parts_bits else np.zeros(len(a), np.int64)
        first = np.flatnonzero(np.diff(part, prepend=-1))
        for i, j in zip(first.tolist(), np.append(first[1:], len(part)).tolist()):
            ids = least[i:j]
            small = ids.min() >= 0 and ids.max() < 1 << 32
            body = np.stack([a[i:j], b[i:j]]).tobytes()
            yield int(part[i]), block, int(small), j - i, b"", body, ids.astype(np.uint32 if small else np.int64).tobytes()

    def removed(self, suspects: np.ndarray, elsewhere: np.ndarray) -> np.ndarray:
        """Whether each word of the block goes. ``elsewhere``: for each run of equal windows, whether a
        smaller document in another block holds it."""
        gone = np.zeros(len(self.words.start) + 1, np.int64)
        order, head, least = self.groups(suspects)
        if len(head):
            run = np.zeros(len(order), np.int64)
            run[head[1:]] = 1
            run = np.cumsum(run)
            out = elsewhere[run] | (self.owner()[suspects][order] > least[run])
            at = self.at[suspects[order[out]]]
            np.add.at(gone, at, 1)
            np.add.at(gone, at + self.window, -1)
        return np.cumsum(gone[:-1]) > 0


def _merge_counters(table: pa.Table) -> pa.Table:
    """Answer each block's sketch of one segment: which of its counters come to two or more."""
    counts = np.zeros(1 << SEGMENT_BITS, np.uint8)
    rows = list(zip(*[table.column(c).to_pylist() for c in ("part", "block", "step", "n", "flags", "body", "more")]))
    for _, _, _, n, flags, body, more in rows:
        at = _unpack_sorted(body, more)
        counts[at] = np.minimum(counts[at] + 1 + _unbits(flags, n), 2)
    return _message([(part, block, step, n, _bits(counts[_unpack_sorted(body, more)] >= 2), b"", b"")
                     for part, block, step, n, _, body, more in rows])


def _merge_windows(table: pa.Table) -> pa.Table:
    """Answer each block's candidate windows: which have a smaller document in another block."""
    rows = list(zip(*[table.column(c).to_pylist() for c in ("part", "block", "step", "n", "body", "more")]))
    both = np.concatenate([np.frombuffer(body, _U).reshape(2, -1) for *_, body, _ in rows], axis=1)
    ids = np.concatenate([np.frombuffer(more, np.uint32 if step else np.int64).astype(np.int64)
                          for _, _, step, _, _, more in rows])
    order = np.lexsort((both[1], both[0]))
    a, b = both[0][order], both[1][order]
    head = np.concatenate([[True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])])
    least = np.minimum.reduceat(ids[order], np.flatnonzero(head))[np.cumsum(head) - 1]
    smaller = np.empty(len(ids), bool)
    smaller[order] = least < ids[order]
    out, at = [], 0
    for part, block, _, n, _, _ in rows:
        out.append((part, block, -1, n, _bits(smaller[at : at + n]), b"", b""))
        at += n
    return _message(out)


def _answers(table: pa.Table) -> dict[int, list[tuple]]:
    out: dict[int, list[tuple]] = {}
    for part, step, n, flags in zip(*[table.column(c).to_pylist() for c in ("part", "step", "n", "flags")]):
        out.setdefault(step, []).append((part, n, flags))
    return out


def remove_repeats(docs: DataFrame, window: int = WINDOW, depth: int = DEPTH, width: int = WIDTH,
                   id_col: str = "doc_id", text_col: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``id_col`` (long), text (the words that stay, joined by one space), n_words, n_removed (long): one
    row for every row of ``docs``; other columns are not read.

    A word is removed if some window of ``window`` consecutive words over it also starts in a document
    with a smaller id. Windows are judged on the input. Words are runs of characters other than space,
    tab, line feed, vertical tab, form feed and carriage return. A null text has no words. Texts shorter
    than a window keep all words, as does the smallest document of each passage. Rows with the same id
    never remove each other's words; a null id counts as larger than all others. Texts of any length
    are read whole; an empty table gives no rows.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    n_bytes = rows.agg(F.sum(F.octet_length("text").cast("long")).alias("n")).first()["n"] or 0
    blocks = max(1, -(-n_bytes // block_bytes))
    # a window for every two bytes at the very most; words have about six
    width_bits = max(SEGMENT_BITS, int(max(1, n_bytes // 6) * width - 1).bit_length())
    parts_bits = max(0, width_bits - SEGMENT_BITS - 2)
    dealt = rows.withColumn("block", F.pmod(F.xxhash64("id", "text"), F.lit(blocks)))

    def block_of(table: pa.Table) -> _Block:
        return _Block(table, width_bits, window, depth)

    def first_pass(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        return _message(list(block_of(table).sketch(key[0].as_py())))

    def second_pass(key: tuple[pa.Scalar, ...], table: pa.Table, told: pa.Table) -> pa.Table:
        block = block_of(table)
        return _message(list(block.candidates(key[0].as_py(), block.suspects(_answers(told)), parts_bits)))

    def third_pass(key: tuple[pa.Scalar, ...], table: pa.Table, told: pa.Table) -> pa.Table:
        block, answers = block_of(table), _answers(told)
        found = sorted(answers.get(-1, []))
        elsewhere = np.concatenate([_unbits(f, n) for _, n, f in found]) if found else np.empty(0, bool)
        gone = block.removed(block.suspects(answers), elsewhere)
        first = block.words.first.tolist()
        texts, removed = [], []
        for i, (a, b) in enumerate(zip(first, first[1:])):
            out = gone[a:b]
            k = int(np.count_nonzero(out))
            words = block.words.text(i).split()
            texts.append((b" ".join(compress(words, ~out) if k else words)).decode("utf-8", "surrogatepass"))
            removed.append(k)
        return pa.table({"id": table.column("id"), "text": pa.array(texts, pa.string()),
                         "n_words": pa.array(np.diff(block.words.first), pa.int64()),
                         "n_removed": pa.array(removed, pa.int64())})

    sketches = dealt.groupBy("block").applyInArrow(first_pass, _MESSAGE)
    counted = sketches.groupBy("part").applyInArrow(_merge_counters, _MESSAGE)
    candidates = (dealt.groupBy("block").cogroup(counted.groupBy("block")).applyInArrow(second_pass, _MESSAGE))
    judged = candidates.groupBy("part").applyInArrow(_merge_windows, _MESSAGE)
    told = counted.unionByName(judged)
    done = (dealt.groupBy("block").cogroup(told.groupBy("block"))
            .applyInArrow(third_pass, "id long, text string, n_words long, n_removed long"))
    return done.withColumnRenamed("id", id_col)
