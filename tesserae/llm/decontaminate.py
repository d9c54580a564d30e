"""Benchmark decontamination by template canonicalisation.

Texts become template tokens: words in lower case, with numbers, names (capitalised inside a sentence) and units replaced
by typed placeholders; numbers that follow each other are one, and so are names.  Windows of ``WINDOW`` template tokens with at least
``LITERALS`` words proper are hashed and joined with those of the benchmark.  Along a diagonal (equal distance between the
two places) neighbouring hits make a run; a run counts if its slots are consistent - each value of the item's slots stands
for one value of the document's throughout - and if it covers ``COVER`` tokens or ``SHARE`` percent of the item, whichever
is less.  So a question with other numbers and names is caught, and one whose slots do not correspond is not.

Windows of words as they stand, without slots and merged tokens, are joined beside them with the same cover and any number of
words proper, so that verbatim leaks of items that are mostly numbers, names and units are found too.  In scripts without spaces each character is
a token, and an item that is mostly so written must be there as a whole.

Documents are screened first against a bit set of the benchmark's keys, of fixed size; what passes is joined exactly.  The
benchmark's windows are broadcast only up to ``BROADCAST_WINDOWS`` and dealt by a shuffle beyond.

Defined cases: null or empty texts match nothing; items with fewer than ``WINDOW`` tokens match as a whole, with
fewer than ``LITERALS`` words proper only verbatim, and with fewer than ``SHORTEST`` words never; rows with a null id are
judged by their text; rows that share id and text are judged as one; an item id that occurs twice stands for both texts; an empty benchmark leaves all documents clean; other
columns, whatever their names, pass through ``drop_leaks`` and are not returned by ``judge``; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import textscan as ts
from .runtime import durable, shielded, ship_code, table

U = np.uint64
WINDOW, LITERALS, COVER, SHARE, SHORTEST = 8, 5, 12, 60, 3
#: Scripts without spaces: Thai, Lao, Burmese, Khmer, Han, kana and their signs.
_UNSPACED = re.compile("[\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u2e80-\ua4cf\uf900-\ufaff\uff00-\uffef\U00020000-\U0003ffff]")
BITS, BROADCAST_WINDOWS, SCREEN_KEYS = 26, 100_000, 4_000_000
#: Units of measure and currency, in lower case.
UNITS = (
    "mm cm m km inch inches foot feet yard yards mile miles g kg mg lb lbs ounce ounces ton tons tonne tonnes l ml liter liters litre litres gallon "
    "gallons s sec second seconds minute minutes hour hours day days week weeks month months year years percent degree degrees celsius fahrenheit "
    "kelvin joule joules watt watts volt volts hz khz mhz ghz mph kmh dollar dollars euro euros pound pounds cent cents usd eur gbp "
    "sekunden minuten stunde stunden tag tage wochen monate jahr jahre kilometer gramm kilogramm prozent grad secondes heure heures jour jours semaines "
    "mois an ans année années mètre mètres kilomètres grammes pourcent degrés segundos minuto minutos hora horas día días semanas meses año años metro "
    "metros kilómetros gramos grados"
).split()
#: Number words.
NUMBERS = (
    "zero one two three four five six seven eight nine ten eleven twelve twenty thirty forty fifty hundred thousand million "
    "zwei drei vier fünf sechs sieben acht neun zehn elf zwölf zwanzig hundert tausend deux trois quatre cinq sept huit dix onze douze vingt mille "
    "dos tres cuatro cinco seis siete ocho nueve diez doce veinte cien mil"
).split()


def _hash(word: str) -> np.uint64:
    return ts.words(word.encode(), "alnum", True)[2][0]


@cache
def _fixed() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    kinds = ts.mix(np.arange(1, 4, dtype=np.uint64) * ts._B)  # number, name, unit
    return np.sort([_hash(w) for w in UNITS]), np.sort([_hash(w) for w in NUMBERS]), kinds


@cache
def _digit_sum() -> np.ndarray:
    v = np.zeros(256, dtype=np.int32)
    v[0x30:0x3A] = 1
    return v


@cache
def _ends_sentence() -> np.ndarray:
    v = np.zeros(256, dtype=bool)
    v[[ord(c) for c in ".!?:;\n\r|\"'(-"]] = True
    return v


def _in(sorted_keys: np.ndarray, h: np.ndarray) -> np.ndarray:
    return sorted_keys[np.minimum(np.searchsorted(sorted_keys, h), len(sorted_keys) - 1)] == h


def spaced(text: str) -> tuple[bytes, int]:
    """UTF-8 with spaces around the characters of scripts without them, and the number of those characters."""
    data = text.encode()
    if not len(data) or text.isascii() or np.frombuffer(data, np.uint8).max() < 0xE0:
        return data, 0
    text, n = _UNSPACED.subn(r" \g<0> ", text)
    return (text.encode() if n else data), n


def template(text: str | bytes | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Template tokens, the values of slots (0 at words proper), and the words as they stand."""
    none = np.zeros(0, dtype=np.uint64)
    if not text:
        return none, none, none
    data = spaced(text)[0] if isinstance(text, str) else text
    starts, ends, h = ts.words(data, "alnum", True)
    if not len(h):
        return none, none, none
    raw = np.frombuffer(data, np.uint8)
    units, numbers, (num, name, unit) = _fixed()
    digits = np.concatenate([[0], np.cumsum(_digit_sum()[raw])])
    is_num = (digits[ends] > digits[starts]) | _in(numbers, h)
    first = raw[starts]
    second = raw[np.minimum(starts + 1, len(raw) - 1)]
    capital = (first >= 65) & (first <= 90) | (first == 0xC3) & (second >= 0x80) & (second <= 0x9E) | (first == 0xCE) & (second >= 0x91) & (second <= 0xA9) | (first == 0xD0) & (second >= 0x80) & (second <= 0xAF)
    before, earlier = raw[np.maximum(starts - 1, 0)], raw[np.maximum(starts - 2, 0)]
    inner = (starts >= 2) & (before == 0x20) & ~_ends_sentence()[earlier]
    upper = (second >= 65) & (second <= 90)  # words in capitals throughout are no names
    is_name = capital & ~upper & inner & ~is_num
    is_unit = _in(units, h) & np.concatenate([[False], is_num[:-1]]) & ~is_num
    out = np.where(is_num, num, np.where(is_name, name, np.where(is_unit, unit, h)))
    slots = np.where(is_num | is_name | is_unit, h | U(1), U(0))
    after = lambda kind: kind & np.concatenate([[False], kind[:-1]])
    keep = ~(after(is_num) | after(is_name))
    if not keep.all():  # one number or name from several: its value is that of all parts
        group = np.cumsum(keep) - 1
        mixed = np.add.reduceat(ts.mix(slots + np.arange(len(slots), dtype=np.uint64) - np.flatnonzero(keep)[group].astype(np.uint64)), np.flatnonzero(keep)) | U(1)
        single = np.bincount(group) == 1
        out, slots = out[keep], np.where(single, slots[keep], mixed)
    return out, slots, h


def _windows(tokens: np.ndarray, slots: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and keys of the windows with enough words proper."""
    keys = ts.windows(tokens, length)
    if not len(keys):
        return np.zeros(0, dtype=np.int64), keys
    words = np.concatenate([[0], np.cumsum(slots == 0)])
    at = np.flatnonzero(words[length:] - words[:-length] >= LITERALS)
    return at, ts.mix(keys[at] + U(length))


def _verbatim(words: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and keys of all windows of words as they stand: what is a slot, and what is merged, depends on the words before."""
    keys = ts.windows(words, length)
    return np.arange(len(keys)), ts.mix(keys + U(length) + (U(1) << U(32)))


_WIN = "key long, k long, fp int, at int, length int, slots array<long>, size int"
_WIN_ARROW = pa.schema([("key", pa.int64()), ("k", pa.int64()), ("fp", pa.int32()), ("at", pa.int32()), ("length", pa.int32()), ("slots", pa.list_(pa.int64())), ("size", pa.int32())])


def _post(lengths, screen=None):
    """Windows of texts; ``lengths``: for a text's number of tokens, the window lengths; ``screen``: bit set of wanted keys."""

    def run(it):
        bits = screen.value if screen is not None else None
        for b in it:
            cols = [[] for _ in range(7)]
            for k, fp, text in zip(*(b.column(i).to_pylist() for i in range(3)), strict=True):
                data, alone = spaced(text)
                tokens, slots, words = template(data)
                whole = -1 if 2 * alone > len(words) else 1  # negative sizes: to be found as a whole
                posts = [(x, len(tokens), slots, *_windows(tokens, slots, x)) for x in lengths(len(tokens))]
                posts += [(-x, len(words), slots[:0], *_verbatim(words, x)) for x in lengths(len(words))]
                for length, size, slots, at, keys in posts:
                    if bits is not None and len(keys):
                        low = keys >> U(64 - BITS)
                        hit = (bits[(low >> U(3)).astype(np.int64)] >> (low & U(7)).astype(np.uint8)) & 1 == 1
                        at, keys = at[hit], keys[hit]
                    for p, key in zip(at.tolist(), keys.view(np.int64).tolist(), strict=True):
                        row = key, k, fp, p, length, slots[p : p + max(length, 0)].view(np.int64).tolist(), whole * size
                        for c, x in zip(cols, row, strict=True):
                            c.append(x)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, _WIN_ARROW.types, strict=True)], schema=_WIN_ARROW)

    return run


def _judge(it):
    """Keeps the (document, item) rows that hold a run with consistent slots and enough cover."""
    schema = pa.schema([("k", pa.int64()), ("fp", pa.int32()), ("item", pa.int64()), ("tokens", pa.int32())])
    for b in it:
        out = []
        for k, fp, item, hits in zip(*(b.column(i).to_pylist() for i in range(4)), strict=True):
            best = 0
            by = {}
            for h in hits:
                by.setdefault((h["text"], h["size"], h["length"], h["at"] - h["place"]), {})[h["place"]] = h
            for (_, size, length, _), row in by.items():
                length = abs(length)
                need, places = -size if size < 0 else min(COVER, -(-SHARE * size // 100)), sorted(row)
                run_start, last, forward, backward = None, None, {}, {}
                for p in places:
                    h = row[p]
                    pairs = [(x, y) for x, y in zip(h["want"], h["slots"], strict=True) if x or y]  # none in verbatim windows
                    fits = lambda: all(forward.get(x, y) == y and backward.get(y, x) == x for x, y in pairs)  # noqa: B023, E731
                    if last is None or p > last + 1 or not fits():
                        run_start, forward, backward = p, {}, {}
                        ok = True
                        for x, y in pairs:
                            ok = ok and forward.setdefault(x, y) == y and backward.setdefault(y, x) == x
                        if not ok:
                            last = None
                            continue
                    else:
                        forward.update(pairs)
                        backward.update((y, x) for x, y in pairs)
                    last = p
                    if p + length - run_start >= need:
                        best = max(best, p + length - run_start)
            if best:
                out.append((k, fp, item, best))
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], t) for i, t in enumerate(schema.types)], schema=schema)


def _keys():
    return [F.coalesce(F.col("doc_id").cast("long"), F.xxhash64("text")).alias("k"), F.hash("text").alias("fp")]


def leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """k, fp (keys of a row of ``docs``), item, tokens (the longest consistent run) for each document and leaked item."""
    spark = docs.sparkSession
    ship_code(spark)
    items = benchmark.where("text is not null and item_id is not null").select(F.col("item_id").cast("long").alias("k"), F.hash("text").alias("fp"), "text").distinct()
    whole = lambda n: [WINDOW] if n >= WINDOW else [n] if n >= SHORTEST else []
    wanted = durable(items.mapInArrow(_post(whole), _WIN))
    lengths = sorted({abs(r[0]) for r in wanted.select("length").distinct().collect()})  # WINDOW - SHORTEST + 1 at most
    n = wanted.count()
    screen = None
    if n <= SCREEN_KEYS:
        keys = wanted.select("key").distinct().toPandas()["key"].to_numpy(dtype=np.int64).view(np.uint64)
        low = keys >> U(64 - BITS)
        bits = np.zeros(1 << (BITS - 3), dtype=np.uint8)
        np.bitwise_or.at(bits, (low >> U(3)).astype(np.int64), np.uint8(1) << (low & U(7)).astype(np.uint8))
        screen = spark.sparkContext.broadcast(bits)
    posted = docs.select(*_keys(), "text").where("text is not null").mapInArrow(_post(lambda size: [x for x in lengths if x <= size], screen), _WIN)
    right = wanted.select("key", F.col("k").alias("item"), F.col("fp").alias("text"), F.col("at").alias("place"), F.col("length").alias("of"), F.col("slots").alias("want"), F.col("size").alias("whole"))
    if n <= BROADCAST_WINDOWS:
        right = F.broadcast(right)
    hits = posted.join(right, "key").where("length = of").groupBy("k", "fp", "item").agg(F.collect_list(F.struct("text", "place", "at", "length", F.col("whole").alias("size"), "want", "slots")).alias("hits"))
    return hits.mapInArrow(_judge, "k long, fp int, item long, tokens int")


def judge(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, contaminated, n_items, items (ids, ascending, comma-joined), tokens (longest run; 0 without)."""
    found = leaks(docs, benchmark).groupBy("k", "fp").agg(F.sort_array(F.collect_set("item")).alias("items"), F.max("tokens").alias("tokens"))
    rows = docs.select("doc_id", *_keys())
    out = rows.join(found, ["k", "fp"], "left")
    ids = F.coalesce("items", F.array().cast("array<long>"))
    return out.select(F.col("doc_id").cast("long").alias("doc_id"), (F.size(ids) > 0).alias("contaminated"), F.size(ids).cast("long").alias("n_items"), F.concat_ws(",", ids.cast("array<string>")).alias("items"), F.coalesce("tokens", F.lit(0)).cast("long").alias("tokens"))


def drop_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without the contaminated documents."""
    safe, back = shielded(docs, "doc_id", "text")
    gone = leaks(safe, benchmark).select(F.col("k").alias("__gone_k"), F.col("fp").alias("__gone_fp")).distinct()
    k, fp = _keys()
    keyed = safe.withColumns({"__key": k, "__print": fp})
    return back(keyed.join(gone, (F.col("__key") == F.col("__gone_k")) & (F.col("__print") == F.col("__gone_fp")), "left_anti"))


def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
