"""Benchmark decontamination by templates.

Texts become templates: numbers, names and units turn into typed placeholders, other words lose case and
punctuation. Windows of template tokens are hash-joined with those of the benchmark; along each
alignment of a document with an item the placeholders' values must be consistent, each value of the item
standing against one value of the document; windows that contradict the most frequent value do not count. That finds items word for word and items whose numbers or
names were changed throughout, but not texts that merely share a turn of phrase.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quayside.llm.common import mix, replace_columns, slices, written
from quayside.llm.wordscan import _BYTE, borders, buffers, inside, powers, segments, windows

WINDOW = 8
#: Of a window's tokens, so many must be plain words.
PLAIN = 4
#: An item without such a window is taken whole (or by all its windows, where it is longer than one): as a
#: template with at least so many plain words, otherwise word for word. So a table of numbers is no template.
LOOSE = 3
#: Bytes that an item shorter than a window must have to be looked for word for word.
LEAST_BYTES = 12
#: Share of an item's windows that a document must hold.
COVERAGE = 0.5
#: Or so many consecutive tokens of an item, whatever share of it they are.
RUN = 13
#: Bits of the filter that tells workers which windows the benchmark has. It bounds what is broadcast.
FILTER_BITS = 22

#: Units of measure, a unit only behind a number, and number words, in English, German,
#: French and Spanish. Words that are articles, too, are none of them.
UNITS = """mm cm dm m km in inch inches ft foot feet yd yards mi mile miles meter meters metre metres
mg g kg t lb lbs oz gram grams kilogram kilograms ton tons ml cl l liter liters litre litres
s sec second seconds min minute minutes h hr hour hours day days week weeks month months year years
kmh mph hz khz mhz ghz w kw v a k c f percent dollar dollars cent cents euro euros pound pounds
kilometer zentimeter millimeter meile meilen gramm kilogramm tonne tonnen
sekunde sekunden minuten stunde stunden tag tage tagen woche wochen monat monate monaten jahr jahre jahren prozent pfund
mètre mètres kilomètre kilomètres centimètre centimètres gramme grammes kilogramme kilogrammes kilo kilos tonnes
seconde secondes heure heures jour jours semaine semaines mois ans année années centime centimes livre livres
metro metros kilómetro kilómetros centímetro centímetros gramo gramos kilogramo kilogramos tonelada toneladas litro litros
segundo segundos minuto minutos hora horas día días semana semanas mes meses año años dólar dólares céntimo céntimos libra libras""".split()
NUMBER_WORDS = """zero one two three four five six seven eight nine ten eleven twelve thirteen fourteen
fifteen sixteen seventeen eighteen nineteen twenty thirty forty fifty sixty seventy eighty ninety
hundred thousand million billion
null zwei drei vier fünf sechs sieben acht neun zehn elf zwölf dreizehn vierzehn fünfzehn sechzehn siebzehn achtzehn
neunzehn zwanzig dreißig vierzig fünfzig sechzig siebzig achtzig neunzig hundert tausend dutzend hälfte viertel drittel
zéro deux trois quatre cinq sept huit neuf dix onze douze treize quatorze quinze seize vingt trente quarante
cinquante soixante mille douzaine moitié tiers
cero dos tres cuatro cinco seis siete ocho nueve diez doce trece catorce quince dieciséis diecisiete dieciocho
diecinueve veinte treinta cuarenta cincuenta sesenta setenta ochenta noventa ciento mil docena mitad tercio""".split()

_U = np.uint64
_PLAIN, _NUMBER, _NAME, _UNIT = range(4)
_MARK = mix(np.arange(101, 105, dtype=_U))

_ASCII = np.arange(256)
_KEPT = ~((_ASCII < 128) & ~np.array([chr(c).isalnum() for c in range(256)]))
_UPPER = (_ASCII >= 65) & (_ASCII <= 90)
_DIGIT = (_ASCII >= 48) & (_ASCII <= 57)
_LOWER = np.where(_UPPER, _ASCII + 32, _ASCII).astype(np.uint8)
_STOP = np.isin(_ASCII, [ord(c) for c in ".!?:"])


class Tokens:
    """Template tokens of some texts: ``first`` as in Words, template hash, kind, hash of the value."""

    def __init__(self, column: pa.Array):
        data, offsets = buffers(column)
        parts = [self._segment(data[a:b], offsets[np.searchsorted(offsets, a) : np.searchsorted(offsets, b)] - a, a)
                 for a, b in segments(data)]
        start, self.value, upper, digit, opens = (
            np.concatenate([p[i] for p in parts]) if parts else np.empty(0, kind)
            for i, kind in enumerate((np.int64, _U, bool, bool, bool)))
        self.first = np.searchsorted(start, offsets)
        opens[self.first[:-1][np.diff(self.first) > 0]] = True
        number = digit | _known(self.value, _NUMBERS)
        unit = np.zeros(len(number), bool)
        unit[1:] = number[:-1] & ~number[1:] & _known(self.value[1:], _UNITS)
        unit[self.first[:-1][np.diff(self.first) > 0]] = False
        self.kind = np.where(number, _NUMBER, np.where(unit, _UNIT, np.where(upper & ~opens, _NAME, _PLAIN)))
        self.hash = np.where(self.kind == _PLAIN, self.value, _MARK[self.kind])

    @staticmethod
    def _segment(part: np.ndarray, cut: np.ndarray, at: int) -> tuple[np.ndarray, ...]:
        n = len(part)
        up, down = powers(n + 1)
        s, e = borders(part, cut)
        kept = _KEPT[part]
        low = _LOWER[part]
        # capital letters of Latin-1: a lead byte C3, then 80 to 9E but for the multiplication sign
        accent = np.zeros(n, bool)
        accent[1:] = (part[:-1] == 0xC3) & (part[1:] >= 0x80) & (part[1:] <= 0x9E) & (part[1:] != 0x97)
        low = np.where(accent, low + 0x20, low)
        place = np.zeros(n + 1, np.int64)
        np.cumsum(kept, out=place[1:])
        total = np.zeros(n + 1, _U)
        np.cumsum(np.where(kept, _BYTE[low] * up[place[:-1]], _U(0)), out=total[1:])
        size = place[e] - place[s]
        full = np.flatnonzero(size)
        breaks = np.zeros(n + 1, np.int64)
        np.cumsum(part == 10, out=breaks[1:])
        opens = np.ones(len(s), bool)
        opens[1:] = _STOP[part[e[:-1] - 1]] | (breaks[s[1:]] > breaks[e[:-1]])
        s, e, size, opens = s[full], e[full], size[full], opens[full]
        value = mix((total[e] - total[s]) * down[place[s]] + size.astype(_U))
        head = np.flatnonzero(kept)[place[s]] if len(s) else s  # first byte of each that is kept
        capital = _UPPER[part] | np.append(accent[1:], False)
        capitals = np.zeros(n + 1, np.int64)
        np.cumsum(capital, out=capitals[1:])
        letters = np.zeros(n + 1, np.int64)  # bytes that begin a character
        np.cumsum(kept & ((part & 0xC0) != 0x80), out=letters[1:])
        shouted = (capitals[e] - capitals[s] == letters[e] - letters[s]) & (letters[e] - letters[s] > 1)
        return s + at, value, capital[head] & ~shouted, _DIGIT[part[head]], opens


def _known(values: np.ndarray, among: np.ndarray) -> np.ndarray:
    at = np.minimum(np.searchsorted(among, values), len(among) - 1)
    return among[at] == values


def _values(words: list[str]) -> np.ndarray:
    s, value, *_ = Tokens._segment(np.frombuffer(" ".join(words).encode(), np.uint8), np.zeros(1, np.int64), 0)
    return np.sort(value)


_NUMBERS, _UNITS = _values(NUMBER_WORDS), _values(UNITS)


def _form(t: Tokens, form: int) -> tuple[np.ndarray, np.ndarray]:
    """Kinds and hashes of the tokens with names as placeholders (0), with names as plain words, which
    finds texts that were put in lower or upper case (1), and with all tokens as words (2)."""
    if form == 0:
        return t.kind, t.hash
    if form == 1:
        return np.where(t.kind == _NAME, _PLAIN, t.kind), np.where(t.kind == _NAME, t.value, t.hash)
    return np.zeros(len(t.kind), np.int64), t.value


def _rows_of(t: Tokens, form: int, at: np.ndarray, size: int, wanted=None) -> tuple:
    """text, place, hash, values of the placeholders, size, form of the windows of ``size`` tokens at some
    places, if their hash is wanted."""
    kind, token = _form(t, form)
    h = windows(token, size, 4 * size + form)[at]
    if wanted is not None:
        hit = wanted(h)
        at, h = at[hit], h[hit]
    text = np.searchsorted(t.first, at, side="right") - 1
    slots = np.flatnonzero(kind != _PLAIN)
    lo, hi = np.searchsorted(slots, at), np.searchsorted(slots, at + size)
    values = [t.value[slots[i:j]].view(np.int64) for i, j in zip(lo, hi)]
    return text, at - t.first[text], h, values, np.full(len(at), size), np.full(len(at), form)


def item_windows(column: pa.Array, size: int) -> Iterator[tuple]:
    """Windows of the benchmark's texts; a text with fewer tokens than a window is one as a whole."""
    t = Tokens(column)
    plain = [np.concatenate([[0], np.cumsum(_form(t, form)[0] == _PLAIN)]) for form in (0, 1)]
    bytes_ = np.diff(buffers(column)[1])
    count = np.diff(t.first)
    at = np.concatenate([inside(t.first, size), t.first[:-1][(count > 0) & (count < size)]])
    text = np.searchsorted(t.first, at, side="right") - 1
    length = np.minimum(count[text], size)
    words = [p[at + length] - p[at] for p in plain]
    has = np.zeros(len(count), bool)
    has[text[(words[0] >= PLAIN) | (words[1] >= PLAIN)]] = True
    loose = ~has[text] & (words[0] >= LOOSE)
    exact = ~has[text] & ~loose & ((length == size) | (bytes_[text] >= LEAST_BYTES))
    for form, on in enumerate([(words[0] >= PLAIN) | loose, (words[1] >= PLAIN) | loose, exact]):
        for n in np.unique(length[on]).tolist():
            yield _rows_of(t, form, at[on & (length == n)], n)


_ROWS = "key long, place int, hash long, size int, slots array<long>, form int"


def _rows(keys: pa.Array, found: tuple) -> pa.RecordBatch:
    text, place, h, values, size, form = found
    slots = pa.array(values, pa.list_(pa.int64())) if len(values) else pa.array([], pa.list_(pa.int64()))
    return pa.RecordBatch.from_arrays(
        [keys.take(pa.array(text, pa.int64())), pa.array(place.astype(np.int32)), pa.array(h.view(np.int64)),
         pa.array(size.astype(np.int32)), slots, pa.array(form.astype(np.int32))],
        names=["key", "place", "hash", "size", "slots", "form"])


def benchmark_windows(items: DataFrame, size: int = WINDOW) -> DataFrame:
    """Windows of the items: item_id, item_place, hash, size, form, item_slots, n_windows (distinct places)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                for found in item_windows(part.column("text"), size):
                    yield _rows(part.column("key"), found)

    rows = written(items.select(F.col("item_id").cast("long").alias("key"), F.coalesce("text", F.lit("")).alias("text"))
                   .filter("key is not null").mapInArrow(run, _ROWS).distinct())
    total = rows.groupBy("key").agg(F.countDistinct("place").alias("n_windows"))
    return written(rows.join(total, "key").select(F.col("key").alias("item_id"), F.col("place").alias("item_place"),
                                                  "hash", "size", "form", F.col("slots").alias("item_slots"), "n_windows"))


def _filter_words(bench: DataFrame) -> np.ndarray:
    """The filter's bits: two for each window. At most 2 ** FILTER_BITS bits come to the driver."""
    mask = (1 << FILTER_BITS) - 1
    at = bench.select(F.explode(F.array(F.col("hash").bitwiseAND(F.lit(mask)),
                                        F.shiftright("hash", 32).bitwiseAND(F.lit(mask)))).alias("bit"))
    words = (at.groupBy(F.shiftright("bit", 5).alias("word"))
             .agg(F.bit_or(F.expr("shiftleft(1L, cast(bit & 31 as int))")).alias("bits")).collect())
    out = np.zeros(1 << (FILTER_BITS - 5), np.uint32)
    for r in words:
        out[r["word"]] = r["bits"]
    return np.unpackbits(out.view(np.uint8), bitorder="little").astype(bool)


def _consistent(windows: Column) -> Column:
    """The windows of an alignment but for those that contradict it: where a value of the item stands
    against several of the document, the most frequent one holds (of equally frequent ones the smallest)."""

    def most(pairs: Column) -> Column:
        votes = F.transform(F.array_distinct(pairs), lambda p: F.struct(
            (-F.size(F.filter(pairs, lambda q: q == p))).alias("n"), p.alias("pair")))
        # ascending, so the first of an item's value is its most frequent one
        return F.aggregate(F.array_sort(votes), F.array_distinct(F.slice(pairs, F.lit(1), F.lit(0))), lambda best, v: F.when(
            F.exists(best, lambda b: b["item_slots"] == v["pair"]["item_slots"]), best).otherwise(F.array_append(best, v["pair"])))

    pairs = F.flatten(F.transform(windows, lambda w: w["pairs"]))
    distinct = F.array_distinct(pairs)
    clear = F.size(distinct) == F.size(F.array_distinct(F.transform(distinct, lambda p: p["item_slots"])))
    kept = F.get(F.transform(F.array(most(pairs)), lambda best: F.filter(
        windows, lambda w: F.forall(w["pairs"], lambda p: F.array_contains(best, p)))), F.lit(0))
    return F.when(clear, windows).otherwise(kept)


def _longest(windows: Column) -> Column:
    """Tokens in the longest stretch of the item that the windows hold without a gap."""
    zero = F.lit(0)
    spans = F.array_sort(F.transform(windows, lambda w: F.struct(w["item_place"].alias("a"), (w["item_place"] + w["size"]).alias("b"))))

    def step(s: Column, w: Column) -> Column:
        start = F.when(w["a"] <= s["b"], s["a"]).otherwise(w["a"])
        return F.struct(start.alias("a"), w["b"].alias("b"), F.greatest(s["n"], w["b"] - start).alias("n"))

    return F.aggregate(spans, F.struct(zero.alias("a"), F.lit(-1).alias("b"), zero.alias("n")), step, lambda s: s["n"])


def contaminated(docs: DataFrame, items: DataFrame, size: int = WINDOW, coverage: float = COVERAGE,
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """key (hash of id and text), items (array of item ids, ascending), covered (largest share of an
    item's windows found) of the documents that hold an item. See :func:`decontaminate`."""
    bench = benchmark_windows(items, size)
    bits = _filter_words(bench)
    # at most three forms of at most ``size`` sizes
    kinds = sorted((r["form"], r["size"]) for r in bench.select("form", "size").distinct().collect())
    mask = _U((1 << FILTER_BITS) - 1)
    packed = docs.sparkSession.sparkContext.broadcast(np.packbits(bits))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = np.unpackbits(packed.value).astype(bool)

        def wanted(h: np.ndarray) -> np.ndarray:
            return known[h & mask] & known[(h.view(np.int64) >> 32).view(_U) & mask]

        for batch in batches:
            for part in slices(batch, "text"):
                t = Tokens(part.column("text"))
                for form, n in kinds:
                    yield _rows(part.column("key"), _rows_of(t, form, inside(t.first, n), n, wanted))

    text = F.coalesce(F.col(text_col), F.lit(""))
    keyed = docs.select(F.xxhash64(F.col(id_col), text).alias("key"), text.alias("text"))
    found = keyed.mapInArrow(run, _ROWS).join(bench, ["hash", "size", "form"])
    # an alignment: one item, one document, one distance between their places
    lines = found.groupBy("key", "item_id", "n_windows", (F.col("place") - F.col("item_place")).alias("shift")).agg(
        F.collect_set(F.struct("item_place", "size", F.arrays_zip("item_slots", "slots").alias("pairs"))).alias("windows"))
    kept = lines.withColumn("windows", _consistent(F.col("windows"))).filter(F.size("windows") > 0)
    held = (kept.select("key", "item_id", "n_windows", F.transform("windows", lambda w: w["item_place"]).alias("places"),
                        _longest(F.col("windows")).alias("run"))
            .groupBy("key", "item_id", "n_windows")
            .agg(F.size(F.array_distinct(F.flatten(F.collect_list("places")))).alias("n"), F.max("run").alias("run"))
            .filter((F.col("n") >= coverage * F.col("n_windows")) | (F.col("run") >= RUN)))
    return held.groupBy("key").agg(F.array_sort(F.collect_set("item_id")).alias("items"),
                                   F.max(F.col("n") / F.col("n_windows")).alias("covered"))


def decontaminate(docs: DataFrame, items: DataFrame, size: int = WINDOW, coverage: float = COVERAGE,
                  id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """All columns of ``docs`` and contaminated (boolean), items (array of item ids, ascending, empty for
    clean documents), covered (double).

    ``items``: item_id, text and any others. A document is contaminated by an item if at least
    ``coverage`` of the item's template windows, or RUN consecutive tokens of it, stand in it. Along an
    alignment only windows count whose placeholder values agree with its most frequent ones. An item with
    fewer tokens than a window is one window. An item none of whose windows has PLAIN plain words is found
    by windows with fewer: with LOOSE plain words as templates, below that word for word, and below
    LEAST_BYTES not at all. Tokens are parted by white space, in any script. Null texts and empty ones are clean; rows of ``items`` without id are
    left out. Texts of any length are read whole; repeated rows, null and repeated ids are judged row by
    row; an empty table gives no rows, an empty benchmark finds nothing. An input column with the name of
    a result column (in any case) is replaced by it.
    """
    found = written(contaminated(docs, items, size, coverage, id_col, text_col))
    key = F.xxhash64(F.col(f"row.{id_col}"), F.coalesce(F.col(f"row.{text_col}"), F.lit("")))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")).withColumn("row_key", key)
    joined = rows.join(found.withColumnsRenamed({"key": "k", "items": "found_items"}), F.col("row_key") == F.col("k"), "left")
    return replace_columns(
        joined.select("row", F.col("k").isNotNull().alias("contaminated"),
                      F.coalesce("found_items", F.array().cast("array<long>")).alias("items"),
                      F.coalesce("covered", F.lit(0.0)).alias("covered")), "row", ["contaminated", "items", "covered"])
