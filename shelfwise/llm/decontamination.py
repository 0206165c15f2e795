"""Finding benchmark items in documents, re-parameterised ones too.

Both sides become templates: numbers, names and units turn into typed placeholders, whose values are kept as slots. Windows
of templates are joined by hash; so are windows that keep their names as words, for copies in another case, and windows that
keep all words, for copies of what is mostly numbers. Windows without a plain word are no key of their own: the neighbour
that ends in one carries the placeholders before or after it. Windows that match along one diagonal cover a run of tokens; a
run counts where each slot value of the item maps to one value of the document throughout.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.words import Words, kept, pieces
from shelfwise.llm.workspace import numbered, small_batches, written

#: Words of number, and units where a number stands before them.
NUMBER_WORDS = frozenset(
    "zero one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen "
    "nineteen twenty thirty forty fifty sixty seventy eighty ninety hundred thousand million billion".split()
)
UNITS = frozenset(
    "mm cm m km inch inches foot feet ft yard yards mile miles mg g kg gram grams kilogram kilograms ounce ounces oz pound pounds "
    "lb lbs ton tons ml l liter liters litre litres gallon gallons cup cups second seconds sec minute minutes min hour hours h "
    "day days week weeks month months year years dollar dollars cent cents euro euros percent degree degrees mph kmh kb mb gb".split()
)
NUM, NAME, UNIT, MEASURE = 1, 2, 3, 4
NUMBER = re.compile(r"[$€£]?[+-]?\d[\d.,:/]*(%|st|nd|rd|th)?")
GLUED = re.compile(r"[$€£]?[+-]?\d[\d.,]*([a-z]+)")
STRIP = re.compile(r"^[^\w$€£+-]+|[\W_]+$")
_P = np.uint64(0x9E3779B97F4A7C15)
_KIND = np.uint64(7)
#: Bits of the sieve of the items' windows, which every task gets: 8 MB, however many items there are.
SIEVE_BITS = 26
#: Windows of more items than this are not joined one by one with documents but in pairs that span a run.
COMMON = 16
#: Numbers of rows that are sent to every task at most (8 bytes each, with their table 16 to 32 MB).
SENT = 1 << 20


def token(word: str) -> tuple[int, str]:
    """(code, slot value or the word) of a white-space token: 0 for none, else a hash.

    A hash has its fourth bit set, and below that NUM, NAME or MEASURE, or 0 for other words.

    Punctuation around a word goes. Words with a first capital are names (at the start of sentences too, where the two
    can't be told apart; the slots then hold the words), words in capitals are lower-cased.
    """
    word = word.rstrip(".,;:!?")
    if word.isalpha():  # most words: the patterns leave them as they are
        low, m = word.lower(), None
    else:
        word = STRIP.sub("", word)
        low = word.lower()
        if not low or not any(map(str.isalnum, low)):
            return 0, ""
        m = GLUED.fullmatch(low)
    if low in NUMBER_WORDS or not low.isalpha() and NUMBER.fullmatch(low):
        kind = NUM
    elif m and m[1] in UNITS:
        kind = MEASURE
    else:
        kind = NAME * (word[0].isupper() and (len(word) == 1 or not word.isupper()))
    return xxhash.xxh64_intdigest(low) & ~7 | 8 | kind, low


def _code(word: str) -> int:
    return token(word)[0]


def codes(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Codes of the template tokens of all texts, and where each text starts. A unit counts as one only after a number.

    Words are remembered from one task of a Python worker to the next.
    """
    got, starts = kept("templates", lambda: Words(_code, ascii_only=False, most=12 << 20)).numbers(texts)
    after = np.flatnonzero(got[:-1] & _KIND == NUM) + 1
    after = after[np.isin(got[after], _UNIT_CODES) & ~np.isin(after, starts)]
    got[after] |= np.uint64(UNIT)
    return got, starts


def readings(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The codes with names as placeholders, with names as the words that they are, and with nothing but words."""
    kind, words = codes & _KIND, codes & ~_KIND
    template = np.where(kind > 0, kind, words)
    return template, np.where(kind == NAME, words, template), words


def values(text: str) -> list[str]:
    """The words behind the codes of a text."""
    split = pc.utf8_split_whitespace(pa.array([text], pa.large_string())).values.to_pylist()
    return [v for c, v in map(token, split) if c]


def window_hashes(codes: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each window, and how many of it are words. Shorter texts have none."""
    n = len(codes) - width + 1
    if n < 1:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    literal = np.concatenate((np.zeros(1, np.int32), np.cumsum(codes > MEASURE, dtype=np.int32)))
    return _hashes(codes, np.s_[:n], width), literal[width:] - literal[:-width]


def _hashes(codes: np.ndarray, at: slice | np.ndarray, width: int) -> np.ndarray:
    """Hashes of the windows at some places, or from the first to a last one."""
    out = np.zeros(len(codes[at]), np.uint64)
    for k in range(width):
        out ^= codes[k : k + at.stop] if isinstance(at, slice) else codes[at + k]
        out *= _P
        out ^= out >> np.uint64(29)
    return out


def keys(codes: np.ndarray, width: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(codes of a reading, places, hashes) of the windows that are keys; one that two readings share is in the first.

    Templates need a word in a window; below width 4 they are not read, as then only verbatim windows count.
    """
    template, named, words = readings(codes)
    second, also = window_hashes(named, width)
    if width >= 4:
        first, literal = window_hashes(template, width)
        places = np.flatnonzero(literal > 0)
        yield template, places, first[places]
        places = np.flatnonzero((also > 0) & (second != first))
        yield named, places, second[places]
        del first, literal
    del template, named, second
    places = np.flatnonzero(also < (width if width >= 4 else width + 1))
    del also
    yield words, places, _hashes(words, places, width)


def beside(codes: np.ndarray, place: int, width: int, low: int, high: int) -> tuple[list[int], list[int]]:
    """Places of the placeholders before a window whose only word is its last, and of those after one whose only word is
    its first: nearest first, from low on and below high."""
    at = [k for k in range(width) if codes[place + k] > MEASURE]
    before, after = [], []
    if at == [width - 1]:
        k = place - 1
        while k >= low and codes[k] <= MEASURE:
            before.append(k)
            k -= 1
    elif at == [0]:
        k = place + width
        while k < high and codes[k] <= MEASURE:
            after.append(k)
            k += 1
    return before, after


def covered(windows: list[dict], width: int) -> dict[int, tuple[str, str] | None]:
    """Place in the item -> slot pair, or None for a word, of all tokens along a diagonal that agree."""
    got: dict[int, tuple[str, str] | None] = {}
    for w in windows:
        q = w["q"]
        for k in range(q, q + width):
            got.setdefault(k, None)
        for k, a, b in zip(w["free"], w["item_slots"], w["slots"], strict=True):
            got[k] = (a, b)
        for k, step, left, right in ((q - 1, -1, w["item_before"], w["before"]), (q + width, 1, w["item_after"], w["after"])):
            for a, b in zip(left, right, strict=False):
                if a[0] != b[0]:
                    break
                got[k] = (a[1:], b[1:])
                k += step
    return got


def aligned(tokens: dict[int, tuple[str, str] | None], width: int, same: int, back: bool = True) -> tuple[int, int]:
    """(tokens, changed slots) of the longest run of consecutive places whose slots agree and `same` tokens of which are
    words or unchanged values.

    Slots agree where every value of the item has one value in the document. A run that breaks this is cut before the
    token that does. The next one starts with the window that ends in it, or, without `back`, as early as it can.
    """
    best, start, off = (0, 0), 0, 0
    held: dict[str, list] = {}

    def drop(k: int) -> int:
        if tokens[k] is None:
            return 0
        a, b = tokens[k]
        held[a][1] -= 1
        if not held[a][1]:
            del held[a]
        return int(a != b)

    for t in sorted(tokens):
        if t - 1 not in tokens:
            start, off = t, 0
            held.clear()
        if tokens[t] is not None:
            a, b = tokens[t]
            if a in held and held[a][0] != b:
                while start < t and (a in held or back and start <= t - width):
                    off -= drop(start)
                    start += 1
            held.setdefault(a, [b, 0])[1] += 1
            off += a != b
        length = t - start + 1
        if length > best[0] and length - off >= same:
            best = (length, sum(a != b for a, (b, _) in held.items()))
    return best


_UNIT_CODES = np.array(sorted(token(u)[0] for u in UNITS), np.uint64)


PARTS = ("free", "item_slots", "slots", "item_before", "before", "item_after", "after")
_SLOTS = "slots array<string>, before array<string>, after array<string>"


def _slots(own: np.ndarray, words: list[str], place: int, width: int, low: int = 0, reach: int | None = None) -> tuple[list[str], list[str], list[str]]:
    """Slots of the window at a place of own, and of what is beside it; words are those of own from low on."""
    end = low + len(words)
    before, after = beside(own, place, width, low if reach is None else max(low, place - reach), end if reach is None else min(end, place + width + reach))
    slots = [words[k - low] for k in range(place, place + width) if own[k] <= MEASURE]
    return slots, [f"{own[k]}{words[k - low]}" for k in before], [f"{own[k]}{words[k - low]}" for k in after]


def _windows(items: DataFrame, width: int) -> DataFrame:
    """item_id, q, h, n (tokens of the item), free (places of slots), slots, before and after for each window of each item."""

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for item, text in zip(batch["item"], batch["text"], strict=True):
                words, whole = values(text), codes([text])[0]
                w = min(width, len(whole))
                for own, places, hashes in keys(whole, w) if w else ():
                    for q, h in zip(places.tolist(), hashes.astype(np.int64).tolist(), strict=True):
                        free = [k for k in range(q, q + w) if own[k] <= MEASURE]
                        rows.append((item, q, h, len(own), free, *_slots(own, words, q, w)))
            yield pd.DataFrame(rows, columns=["item", "q", "h", "n", "free", "slots", "before", "after"])

    rows = items.select(F.col("item_id").cast("string").alias("item"), F.coalesce("text", F.lit("")).alias("text")).where("item is not null")
    return rows.mapInPandas(cut, f"item string, q long, h long, n long, free array<long>, {_SLOTS}")


def _sieve(windows: DataFrame) -> np.ndarray:
    """A Bloom filter of the hashes h, as 2^SIEVE_BITS bits in longs: each hash sets the two bits of its two lowest parts."""
    size = (1 << SIEVE_BITS) - 1
    bits = windows.select(F.explode(F.array(F.col("h").bitwiseAND(size), F.shiftrightunsigned("h", SIEVE_BITS).bitwiseAND(size))).alias("bit"))
    words = bits.groupBy(F.shiftright("bit", 6).alias("at")).agg(F.bit_or(F.expr("shiftleft(1L, cast(bit & 63 as int))")).alias("word")).toArrow()
    out = np.zeros(1 << SIEVE_BITS - 6, np.uint64)
    out[words["at"].to_numpy()] = words["word"].to_numpy().view(np.uint64)
    return out


def _passes(sieve: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Places of the hashes that a sieve lets through: all that it was made of, and few others."""
    size = 64 * len(sieve)

    def set_(bit: np.ndarray) -> np.ndarray:
        bit = bit & np.uint64(size - 1)
        return (sieve[(bit >> np.uint64(6)).view(np.int64)] >> (bit & np.uint64(63)) & np.uint64(1)).astype(bool)

    some = np.flatnonzero(set_(hashes))
    return some[set_(hashes[some] >> np.uint64(size.bit_length() - 1))]


def _hits(width: int, short: list[int], reach: int, sieve: np.ndarray) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    """Windows of documents that pass the sieve: place, doc, p, h, slots, before, after.

    short are the widths of items with fewer tokens than width; reach is how far items have placeholders beside a window.
    """
    columns = ["place", "doc", "p", "h", "slots", "before", "after"]

    def find(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts, places, names, rows = list(batch["text"]), list(batch["place"]), list(batch["doc"]), []
            for piece in pieces(texts, 2 << 20):
                both, starts = codes([texts[i] for i in piece])
                last, words = -1, []
                at = []
                for w in [width, *short]:
                    for own, near, hashes in keys(both, w):
                        held = _passes(sieve, hashes)
                        near, hashes = near[held], hashes[held]
                        owner = np.searchsorted(starts, near, "right") - 1
                        inside = near + w <= starts[owner + 1]  # windows lie within one text
                        near, owner, hashes = near[inside], owner[inside], hashes[inside].astype(np.int64)
                        at += [(i, p, h, w, own) for i, p, h in zip(owner.tolist(), near.tolist(), hashes.tolist(), strict=True)]
                for i, p, h, w, own in sorted(at, key=lambda x: x[:4]):
                    if i != last:
                        last, words, low = i, values(texts[piece[i]]), int(starts[i])
                    rows.append((places[piece[i]], names[piece[i]], p - low, h, *_slots(own, words, p, w, low, reach)))
                if len(rows) > 20_000:
                    yield pd.DataFrame(rows, columns=columns)
                    rows = []
            yield pd.DataFrame(rows, columns=columns)

    return find


def _matches(found: DataFrame, windows: DataFrame, width: int, run: int) -> DataFrame:
    """Windows of documents beside those of items with their hash: all that a run of enough tokens can be made of.

    A hash of up to COMMON items joins each of its windows. One of more items would give a row for each document and item
    that hold it, whether or not they share a run. A run that no rarer window is in spans two such windows, whose distance is
    what a run needs beyond one window, or up to width - 1 more; or it holds one with placeholders beside it. So pairs of
    common windows at such a distance are joined, by both hashes and the distance, and name the diagonals (document, item, shift)
    that may hold a run; these, and those of rarer windows, then take in the common windows along them. What is joined grows
    with the diagonals that share a span of a run's length.
    """
    windows = windows.withColumnsRenamed({c: f"item_{c}" for c in ("slots", "before", "after")})
    common = windows.groupBy("h").agg(F.count_distinct("item").alias("items")).where(F.col("items") > COMMON).select("h")
    shift = (F.col("p") - F.col("q")).alias("shift")
    needed = F.least(F.lit(run), F.col("n")) - F.least(F.lit(width), F.col("n"))  # places between the ends of a run's windows
    spread = windows.where(needed > 0).join(common, "h", "left_semi")
    if spread.isEmpty():
        return found.join(windows, "h").withColumn("shift", shift)
    found, spread = written(found, "item-hits"), written(spread, "item-common")
    rare = windows.join(spread.select("h", "item").distinct(), ["h", "item"], "left_anti")
    one_by_one = found.join(rare, "h").withColumn("shift", shift)

    places = spread.select("item", "n", "q", "h").distinct()
    ends = places.select("item", F.col("q").alias("end"), F.col("h").alias("end_h"))
    starts = places.withColumn("d", F.explode(F.sequence(needed, needed + width - 1))).withColumn("end", F.col("q") + F.col("d"))
    spans = starts.join(ends, ["item", "end"]).select("item", "n", "q", "h", "d", "end_h")
    hits = found.select("place", "p", "h").join(spread.select("h").distinct(), "h", "left_semi")
    after = hits.select("place", F.col("p").alias("end"), F.col("h").alias("end_h"))
    reached = hits.withColumn("d", F.explode(F.sequence(F.lit(1), F.lit(run - 1)))).withColumn("end", F.col("p") + F.col("d"))
    diagonal = ("place", "item", "n", shift)
    by_pair = reached.join(after, ["place", "end"]).join(spans, ["h", "d", "end_h"]).select(*diagonal)
    beside_ = lambda a, b: F.size(a) + F.size(b) > 0
    by_slots = found.where(beside_("before", "after")).join(spread.where(beside_("item_before", "item_after")), "h").select(*diagonal)
    diagonals = one_by_one.select("place", "item", "n", "shift").unionByName(by_pair).unionByName(by_slots).distinct()
    along = diagonals.join(spread, ["item", "n"]).withColumn("p", F.col("q") + F.col("shift")).join(found, ["place", "p", "h"])
    return one_by_one.unionByName(along)


def find_items(docs: DataFrame, items: DataFrame, width: int = 8, run: int = 12) -> DataFrame:
    """place, doc, item, tokens, changed: rows of docs (place, doc, text) that hold an item (item_id, text), one row a pair.

    A pair counts where a run of windows with agreeing slots spans at least `run` tokens, or all tokens of an item with
    fewer, and half a window of its tokens (all, of an item with fewer) are plain words or values that did not change: a
    row of other numbers is no copy of a row of numbers. Items of less than `width` tokens are one window. tokens is the
    longest run's length, changed the number of its slot values that differ from the item's: 0 for verbatim passages. Null texts hold nothing, null
    item_ids are no items, repeated rows are judged one by one, an item's repeated rows count once. Empty tables give an
    empty result. place tells rows apart, doc is text that is handed on.

    A sieve of fixed size of the items' windows goes to every task; what passes is joined with the windows themselves. Windows
    that many items hold name no pair of a document and an item alone: see _matches().
    """
    spark = docs.sparkSession
    small_batches(spark)
    windows = written(_windows(items, width).distinct(), "item-windows")
    shape = windows.agg(F.max(F.greatest(F.size("before"), F.size("after"))).alias("reach"), F.sort_array(F.collect_set(F.when(F.col("n") < width, F.col("n")))).alias("short")).first()
    reach, short = shape["reach"] or 0, list(shape["short"])
    sieve = spark.sparkContext.broadcast(_sieve(windows))
    texts = docs.select("place", "doc", "text").where("text is not null")
    find = lambda batches: _hits(width, short, reach, sieve.value)(batches)
    found = texts.mapInPandas(find, f"place long, doc string, p long, h long, {_SLOTS}")
    runs = _matches(found, windows, width, run).groupBy("place", "doc", "item", "n", "shift").agg(
        F.collect_set(F.struct("q", "free", "item_slots", "slots", "item_before", "before", "item_after", "after")).alias("w")
    )

    @F.pandas_udf("tokens long, changed long")
    def longest(n: pd.Series, q: pd.Series, *parts: pd.Series) -> pd.DataFrame:
        rows = []
        for size, at, *rest in zip(n, q, *parts, strict=True):
            windows = [dict(zip(("q", *PARTS), one, strict=True)) for one in zip(at, *rest, strict=True)]
            tokens, same = covered(windows, min(width, size)), min(width // 2, size)
            got = aligned(tokens, width, same)
            rows.append(got if got[0] >= min(run, size) else aligned(tokens, width, same, back=False))
        return pd.DataFrame(rows, columns=["tokens", "changed"])

    runs = runs.withColumn("r", longest("n", "w.q", *[F.col(f"w.{c}") for c in PARTS])).select("place", "doc", "item", "n", "r.tokens", "r.changed")
    runs = runs.where(F.col("tokens") >= F.least(F.lit(run), F.col("n")))
    best = F.max(F.struct("tokens", (-F.col("changed")).alias("c")))
    return runs.groupBy("place", "doc", "item").agg(best.alias("b")).select("place", "doc", "item", "b.tokens", (-F.col("b.c")).alias("changed"))


def contaminated(docs: DataFrame, items: DataFrame, **options: int) -> DataFrame:
    """doc_id, item_id, tokens, changed for each document and item in it. See find_items()."""
    rows = docs.select(F.monotonically_increasing_id().alias("place"), F.col("doc_id").cast("string").alias("doc"), "text")
    found = find_items(rows, items, **options)
    own, kind = docs.schema["doc_id"].dataType, items.schema["item_id"].dataType
    return found.select(F.col("doc").cast(own).alias("doc_id"), F.col("item").cast(kind).alias("item_id"), "tokens", "changed")


def without_contaminated(docs: DataFrame, items: DataFrame, **options: int) -> DataFrame:
    """docs without the rows that hold an item; the columns of docs, whatever their names.

    Up to SENT numbers of rows that go are sent to every task, and no text moves; more of them are joined by a shuffle.
    """
    rows = numbered(docs, "item-docs")
    found = find_items(rows.select("place", F.lit(None).cast("string").alias("doc"), "row.text"), items, **options)
    gone = written(found.select("place").distinct(), "item-places")
    gone = F.broadcast(gone) if gone.count() <= SENT else gone.hint("merge")
    return rows.join(gone, "place", "left_anti").select("row.*")
