"""Phrases whose words stand together more often than apart, from exact counts of frequent n-grams.

Texts are dealt to blocks by their place. A block counts its n-grams by a shortened hash and sends what
falls into each hash partition to that partition, where Misra-Gries summaries are merged. A summary's
capacity exceeds the partition's mass divided by the threshold, so that its error stays below the
threshold and every n-gram that is frequent survives; a hash shared by several n-grams only raises a
count. The partition answers each block with one bit for each of its hashes. In a second pass blocks
count the surviving n-grams as they are written, which Spark sums exactly.

Neither the vocabulary nor the survivors are held in one place: a very frequent n-gram is one number a
block, and partitions and blocks grow in number with the text.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quayside.llm.common import mix, written
from quayside.llm.wordscan import buffers, scan, windows

MOST_WORDS = 3
LEAST = 10
#: A phrase goes when a longer one around it has this share of its count, in percent.
SHARE = 50
TOP = 2000
NO_LANG = "und"
#: Text bytes of a block, at least and at most; blocks grow with the root of the text, so that what a
#: block sends to a partition does not shrink to single numbers.
BLOCK_BYTES = (8 << 20, 128 << 20)
#: N-gram occurrences for each hash partition.
PART_MASS = 4 << 20
#: N-grams that are written out at once.
SLICE = 1 << 18

_MESSAGE = "part long, block long, n long, body binary, more binary, counts binary"
_NAMES = ["part", "block", "n", "body", "more", "counts"]
_U = np.uint64

#: What each byte becomes: small letters, one space for white space inside a piece, one line feed
#: between pieces.
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[ord("A") : ord("Z") + 1] += 32
_FOLD[ord("\t")] = ord(" ")
_FOLD[[ord(c) for c in ".,;:!?\n\x0b\x0c\r"]] = ord("\n")


def _pack(steps: np.ndarray, kind: type) -> tuple[bytes, bytes]:
    """Numbers in a short type; what does not fit stands aside."""
    top = np.iinfo(kind).max
    return np.minimum(steps, top).astype(kind).tobytes(), steps[steps >= top].astype(np.int64).tobytes()


def _unpack(body: bytes, more: bytes, kind: type) -> np.ndarray:
    steps = np.frombuffer(body, kind).astype(np.int64)
    steps[steps == np.iinfo(kind).max] = np.frombuffer(more, np.int64)
    return steps


def _rows(rows: list[tuple]) -> pa.Table:
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary()]
    return pa.table([pa.array(c, k) for c, k in zip(list(zip(*rows)) or [()] * len(_NAMES), kinds)], names=_NAMES)


def _runs(ascending: np.ndarray) -> np.ndarray:
    """Where runs of equal numbers begin."""
    if not len(ascending):
        return np.empty(0, np.int64)
    return np.flatnonzero(np.concatenate([[True], ascending[1:] != ascending[:-1]]))


class Summary:
    """A Misra-Gries summary in its mergeable form: at most ``capacity`` counters; a merge that leaves
    more takes the next largest count off all of them. ``error`` is what has been taken off in all."""

    def __init__(self, capacity: int):
        self.capacity, self.error = capacity, 0
        self.keys, self.counts = np.empty(0, np.int64), np.empty(0, np.int64)

    def merge(self, keys: list[np.ndarray], counts: list[np.ndarray]) -> None:
        every, count = np.concatenate([self.keys, *keys]), np.concatenate([self.counts, *counts])
        order = np.argsort(every, kind="stable")
        every, count = every[order], count[order]
        head = _runs(every)
        if len(head):
            every, count = every[head], np.add.reduceat(count, head)
        if (over := len(every) - self.capacity) > 0:
            off = int(np.partition(count, over - 1)[over - 1])
            self.error += off
            every, count = every[count > off], count[count > off] - off
        self.keys, self.counts = every, count

    def frequent(self, least: int) -> np.ndarray:
        """Ascending keys that may have come ``least`` times; none that has is missing."""
        return self.keys[self.counts + self.error >= least]


def _survivors(table: pa.Table, least: int) -> pa.Table:
    """Answer each block: which of its hashes in this partition may be frequent."""
    part, block, n, body, more, counts = (table.column(c).to_pylist() for c in _NAMES)
    keys, sizes = [], []
    for b, m, c in zip(body, more, counts):
        keys.append(np.cumsum(_unpack(b, m, np.uint16)))
        k = len(keys[-1])
        sizes.append(_unpack(c[:k], c[k:], np.uint8))
    summary = Summary(sum(int(s.sum()) for s in sizes) // least + 1)
    waiting: tuple[list, list] = ([], [])
    held = 0
    for k, s in zip(keys, sizes):
        waiting[0].append(k)
        waiting[1].append(s)
        held += len(k)
        if held > summary.capacity:
            summary.merge(*waiting)
            waiting, held = ([], []), 0
    summary.merge(*waiting)
    found = summary.frequent(least)
    flags = []
    for k in keys:
        at = np.minimum(np.searchsorted(found, k), max(0, len(found) - 1))
        flags.append(np.packbits(found[at] == k if len(found) else np.zeros(len(k), bool)).tobytes())
    return _rows(list(zip(part, block, n, flags, [b""] * len(n), [b""] * len(n))))


class _Block:
    """The words of some texts, and the n-grams that lie inside one piece of one text."""

    def __init__(self, table: pa.Table, most: int):
        text = table.column("text").combine_chunks()
        text = text if isinstance(text, pa.Array) else pa.concat_arrays(text.chunks or [pa.array([], pa.string())])
        data, offsets = buffers(text)
        self.data = _FOLD[data]
        self.words = scan(pa.LargeStringArray.from_buffers(
            len(offsets) - 1, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(self.data)))
        codes = table.column("lang").combine_chunks().dictionary_encode()
        codes = codes if isinstance(codes, pa.Array) else codes.combine_chunks()
        self.langs = codes.dictionary.to_pylist()
        salt = np.array([int.from_bytes(hashlib.blake2b(x.encode(), digest_size=8).digest(), "big") for x in self.langs], _U)
        count = np.diff(self.words.first)
        owner = np.repeat(np.arange(len(count)), count)
        self.lang = codes.indices.to_numpy()[owner].astype(np.int32)
        # words of one piece of one text have one number; both parts ascend
        self.piece = np.cumsum(self.data == ord("\n"), dtype=np.int64)[self.words.start] + owner
        self.salt = salt[self.lang]
        self.most = most

    def places(self, size: int) -> np.ndarray:
        """Words at which an n-gram begins."""
        return np.flatnonzero(self.piece[: len(self.piece) - size + 1] == self.piece[size - 1 :]) if len(self.piece) >= size else np.empty(0, np.int64)

    def hashes(self, size: int, at: np.ndarray, salt: int = 0) -> np.ndarray:
        return mix(windows(self.words.hash, size, 2 * size + salt)[at] ^ self.salt[at])

    def numbers(self, bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Shortened hashes of all n-grams; the size and place of each."""
        at = [self.places(m) for m in range(1, self.most + 1)]
        number = np.concatenate([self.hashes(m, x) >> _U(64 - bits) for m, x in enumerate(at, 1)])
        return number, np.repeat(np.arange(1, self.most + 1, dtype=np.uint8), [len(x) for x in at]), np.concatenate(at).astype(np.int32)

    def messages(self, block: int, bits: int, part_bits: int) -> Iterator[tuple]:
        number = self.numbers(bits)[0]
        number.sort()
        head = _runs(number)
        count = np.diff(np.append(head, len(number)))
        number = number[head].astype(np.int64)
        part = number >> (bits - part_bits)
        first = _runs(part)
        for a, b in zip(first.tolist(), np.append(first[1:], len(part)).tolist()):
            p = int(part[a])
            body, more = _pack(np.diff(number[a:b], prepend=p << (bits - part_bits)), np.uint16)
            yield p, block, b - a, body, more, b"".join(_pack(count[a:b], np.uint8))

    def survivors(self, bits: int, told: list[tuple[int, int, bytes]]) -> tuple[np.ndarray, np.ndarray]:
        """Size and place of every n-gram that may be frequent."""
        number, size, at = self.numbers(bits)
        place_bits = max(1, int(len(number)).bit_length())
        if bits + place_bits <= 64:
            both = np.sort((number << _U(place_bits)) | np.arange(len(number), dtype=_U))
            number, order = both >> _U(place_bits), (both & _U((1 << place_bits) - 1)).astype(np.int64)
        else:
            order = np.argsort(number, kind="stable")
            number = number[order]
        run = np.zeros(len(number), np.int64)
        run[_runs(number)[1:]] = 1
        flags = [np.unpackbits(np.frombuffer(f, np.uint8), count=n) for _, n, f in sorted(told)]
        flags = np.concatenate(flags).astype(bool) if flags else np.empty(0, bool)
        on = np.sort(order[flags[np.cumsum(run)]]) if len(number) else order
        return size[on], at[on]

    def counted(self, bits: int, told: list[tuple[int, int, bytes]]) -> Iterator[pa.Table]:
        """lang, size, phrase, n of the surviving n-grams, and the words of each language at size 0."""
        n = np.bincount(self.lang, minlength=len(self.langs))
        yield self._table(np.arange(len(self.langs)), 0, pa.array([""] * len(self.langs), pa.string()), n)
        sizes, places = self.survivors(bits, told)
        for m in range(1, self.most + 1):
            at = places[sizes == m]
            h, g = self.hashes(m, at), self.hashes(m, at, 1)
            order = np.argsort(h, kind="stable")
            a, b = h[order], g[order]
            if ((a[1:] == a[:-1]) & (b[1:] != b[:-1])).any():
                order = np.lexsort((g, h))
                a, b = h[order], g[order]
            head = np.flatnonzero(np.concatenate([[True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])])) if len(a) else order
            count = np.diff(np.append(head, len(a)))
            first = at[order[head]]
            for i in range(0, len(first), SLICE):
                some = first[i : i + SLICE]
                yield self._table(self.lang[some], m, self._phrases(some, m), count[i : i + SLICE])

    def _table(self, lang: np.ndarray, size: int, phrases: pa.Array, n: np.ndarray) -> pa.Table:
        return pa.table({"lang": pa.array(self.langs, pa.string()).take(pa.array(lang)), "size": pa.array(np.full(len(n), size, np.int32)),
                         "phrase": phrases, "n": pa.array(n.astype(np.int64))})

    def _phrases(self, first: np.ndarray, size: int) -> pa.Array:
        """The words from each place on, joined by one space."""
        word = (first[:, None] + np.arange(size)).ravel()
        start, length = self.words.start[word], self.words.end[word] - self.words.start[word]
        length[np.arange(len(word)) % size < size - 1] += 1  # the space behind all words but the last
        end = np.cumsum(length)
        data = self.data[np.arange(end[-1] if len(end) else 0) + np.repeat(start - (end - length), length)]
        offsets = np.concatenate([[0], end[size - 1 :: size]]).astype(np.int32)
        return pa.StringArray.from_buffers(len(first), pa.py_buffer(offsets.tobytes()), pa.py_buffer(data.tobytes()))


def frequent_phrases(docs: DataFrame, most: int = MOST_WORDS, least: int = LEAST, lang_col: str = "lang", text_col: str = "text",
                     block_bytes: int | None = None, part_mass: int = PART_MASS) -> DataFrame:
    """lang, size, phrase, n (long): every phrase of 1 to ``most`` words that comes ``least`` times or
    more in its language, and for each language the number of its words, as size 0."""
    rows = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit(NO_LANG)).alias("lang"),
                       F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    n_bytes = rows.agg(F.sum(F.octet_length("text").cast("long")).alias("n")).first()["n"] or 0
    low, high = BLOCK_BYTES
    block_bytes = block_bytes or min(high, max(low, math.isqrt(n_bytes * 2000)))
    blocks = max(1, -(-n_bytes // block_bytes))
    mass = max(1, n_bytes // 6 * most)  # about six bytes a word; more of them only make partitions larger
    part_bits = max(0, (mass // part_mass).bit_length())
    bits = min(60, max(24, mass.bit_length() + 6, part_bits + 16))
    # by place: equal rows go to different blocks
    dealt = rows.withColumn("block", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(blocks)))

    def first_pass(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        return _rows(list(_Block(table, most).messages(key[0].as_py(), bits, part_bits)))

    def second_pass(key: tuple[pa.Scalar, ...], table: pa.Table, told: pa.Table) -> pa.Table:
        answers = list(zip(*[told.column(c).to_pylist() for c in ("part", "n", "body")]))
        return pa.concat_tables(_Block(table, most).counted(bits, answers))

    sent = dealt.groupBy("block").applyInArrow(first_pass, _MESSAGE)
    told = sent.groupBy("part").applyInArrow(lambda table: _survivors(table, least), _MESSAGE)
    found = (dealt.groupBy("block").cogroup(told.groupBy("block"))
             .applyInArrow(second_pass, "lang string, size int, phrase string, n long"))
    return (found.groupBy("lang", "size", "phrase").agg(F.sum("n").alias("n"))
            .filter((F.col("n") >= least) | (F.col("size") == 0)))


def _exact_score(a: Column, left: Column, right: Column) -> Column:
    """floor(1000000 a a / (left right)) without rounding on the way. No more than 1000000, as neither part is rarer than the whole."""
    wide = [c.cast("decimal(15,0)") for c in (a, left, right)]
    top = F.lit(1_000_000).cast("decimal(7,0)") * (wide[0] * wide[0])
    return F.call_function("div", top, wide[1] * wide[2])


def collocations(docs: DataFrame, most: int = MOST_WORDS, least: int = LEAST, share: int = SHARE, top: int = TOP,
                 lang_col: str = "lang", text_col: str = "text", block_bytes: int | None = None,
                 part_mass: int = PART_MASS) -> DataFrame:
    """lang, rank (int, from 1), size, phrase, a, l, r, n, score (long): the ``top`` phrases of each language
    by score, then by count, then by phrase in byte order.

    Texts are lower-cased (A to Z), cut at ``.,;:!?`` and line ends into pieces, and those at spaces and
    tabs into words. Candidates are phrases of 2 to ``most`` words that come ``least`` times (a) or more.
    Cut after its first words, a phrase scores floor(1000000 a a / (l r)) with the counts l and r of both
    parts; the cut that scores lowest counts, the earliest among equals. A candidate goes when a longer
    one holds its words side by side and comes ``share`` percent as often. n: words of the language.

    A null language counts as ``und``, a null text as empty; repeated rows count each time. Texts of any
    length are read whole. Other columns are not read. An empty table gives no rows.
    """
    every = written(frequent_phrases(docs, most, least, lang_col, text_col, block_bytes, part_mass))
    counts = every.filter("size > 0").select("lang", "phrase", "n")
    phrases = every.filter("size > 1").select("lang", "size", "phrase", F.col("n").alias("a"))
    cuts = phrases.select("*", F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k")).select(
        "*", F.expr("substring_index(phrase, ' ', k)").alias("before"), F.expr("substring_index(phrase, ' ', k - size)").alias("after"))
    cuts = (cuts.join(counts.select("lang", F.col("phrase").alias("before"), F.col("n").alias("l")), ["lang", "before"])
            .join(counts.select("lang", F.col("phrase").alias("after"), F.col("n").alias("r")), ["lang", "after"]))
    cut = F.struct(_exact_score(F.col("a"), F.col("l"), F.col("r")).alias("score"), "k", "l", "r")
    scored = cuts.groupBy("lang", "size", "phrase", "a").agg(F.min(cut).alias("cut"))
    # each place of a shorter phrase inside a longer one
    inner = phrases.filter("size > 2").select("lang", "a", "size", F.split("phrase", " ").alias("w"), F.explode(
        F.sequence(F.lit(2), F.col("size") - 1)).alias("long"))
    inner = inner.select("lang", "a", "w", "long", F.explode(F.sequence(F.lit(1), F.col("size") - F.col("long") + 1)).alias("at"))
    around = (inner.select("lang", "a", F.array_join(F.slice("w", F.col("at"), F.col("long")), " ").alias("phrase"))
              .groupBy("lang", "phrase").agg(F.max("a").alias("longer")))
    wide = lambda c, by: c.cast("decimal(15,0)") * by
    kept = scored.join(around, ["lang", "phrase"], "left").filter(
        F.col("longer").isNull() | (wide(F.col("longer"), 100) < wide(F.col("a"), share)))
    kept = kept.select("lang", "size", "phrase", "a", "cut.l", "cut.r", F.col("cut.score").cast("long").alias("score"))
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    # first within salted parts of a language: what meets in one task is bounded
    salted = Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(32))).orderBy(*order)
    few = kept.withColumn("rank", F.row_number().over(salted)).filter(F.col("rank") <= top)
    ranked = few.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).filter(F.col("rank") <= top)
    totals = every.filter("size = 0").select("lang", "n")
    return ranked.join(totals, "lang").select(
        "lang", "rank", "size", "phrase", "a", "l", "r", "n", "score")
