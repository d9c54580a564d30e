"""Quality classifier: interpolated modified Kneser-Ney bigrams of trusted text, scored by sharded count joins.

Trusted text is what the labels call good and not toxic.  Words become ids per language: every (language, word) pair that
occurs ``MIN_COUNT`` times in trusted text has its own, the others go by their shape (lower case, capitalised, upper case,
digits, symbols) and cost P(class) * P(word | class), where the words of a class are alike: 1 / (its rarer trusted words + 1
for those never seen).  A word that repeats the one before it has an id that tells the length of the run (2, 4, 8 or more),
so that runs are as unlikely as they are in trusted text; the members of these classes are all words of the language.

Bigram counts are merged by ranges of a hash and sent, by ranges of the bigrams themselves, to the shards where documents
meet them; quantiles of a sample of the bigrams cut the ranges.  Documents go in batches; the distinct bigrams of a batch are
packed by shard and meet the counts of that shard there; what comes back is a vector of sums of log-probabilities per batch and
shard, and the sums give the perplexity.  The number of shards goes by the bigrams a shard can hold, so that the vectors do not
grow with the number of partitions; counts are copied, for groups of batches, only where they are few beside the input.  Only what is bounded by the
vocabulary (discounts, contexts, continuation counts) is broadcast.

A document is rejected if its perplexity is beyond the ``QUANTILE`` quantile of the trusted documents of its language, over
the quarter of them that is held out of the counts (documents that the model has seen would set the limit too low).  Global
limits, over the held-out documents of all languages, stand in where there is none: for texts of fewer than ``MIN_WORDS``
words that of beginnings of the same number of words; in languages without trusted text that of a model of shapes alone,
counted over all trusted text.  Where fewer than ``MIN_HELD`` documents or beginnings of a length stand behind a limit, the
one over all languages or lengths counts if it is greater.

Defined cases: documents without words (or null text) have no perplexity and are kept, and so are all without any trusted
text; languages beyond the 512 largest go by the model of shapes; a null language is a language of its own; rows with a null
id are scored by their text; rows that share id and text have one score; equal labels for one id count once and an id with
contradicting labels is not trusted; an empty table gives an empty result.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.shared import stored
from . import anchors as an
from . import textscan as ts
from .runtime import durable, input_bytes, remove_folder, shared_folder, shielded, ship_code, shuffle_partitions, table

U = np.uint64
MIN_COUNT = 20
QUANTILE = 0.99
MIN_WORDS, MIN_HELD = 12, 100  # shorter texts and languages with fewer held-out documents go by global limits
BROADCAST_IDS = 2_000_000  # trusted ids that may be broadcast; more are joined by a shuffle
PAIRS = 1 << 22  # of a batch of documents
SHARD_PAIRS = 1 << 22  # bigrams of a shard
LEAST_SHARDS = 12  # as far as there are partitions
GROUP_BYTES = 256 << 20  # of the input for each partition of requests, which are held in memory
SAMPLE = 100_000  # bigrams that cut the ranges of the shards
CLASSES = ("start", "repeat", "run4", "run8", "lower", "capital", "upper", "digit", "symbol", "mixed")
REQUEST, COUNTS = an.POST, an.FRAGMENT


def _shape_values() -> np.ndarray:
    v = np.zeros(256, dtype=np.int64)
    v[0x80:] = v[ord("a") : ord("z") + 1] = 1
    v[ord("A") : ord("Z") + 1] = 1 << 16
    v[ord("0") : ord("9") + 1] = 1 << 32
    v[0x21:0x80][v[0x21:0x80] == 0] = 1 << 48
    v[[ord(c) for c in ".,;:'\"()-?"]] = 0
    return v


_SHAPE = _shape_values()


def _shapes(data: bytes, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Class of each word by its bytes."""
    raw = np.frombuffer(data, np.uint8)
    total = np.concatenate([[0], np.cumsum(_SHAPE[raw] & 0xFFFF)]), np.concatenate([[0], np.cumsum(_SHAPE[raw] >> 16)])
    low, rest = (t[ends] - t[starts] for t in total)
    upper, digit, symbol = rest & 0xFFFF, (rest >> 16) & 0xFFFF, rest >> 32
    name = CLASSES.index
    out = np.full(len(starts), name("lower"))
    out[(upper > 0)] = name("capital")
    out[(upper > 1) & (low == 0)] = name("upper")
    out[digit > 0] = name("digit")
    out[symbol > 0] = name("mixed")
    out[(symbol > 0) & (low + upper + digit == 0)] = name("symbol")
    return out


def _language(lang: str | None) -> np.uint64:
    return ts.words(("l" + (lang or "")).replace(" ", "_").encode())[2][0]


def word_keys(text: str, lang: str | None):
    data = text.encode()
    starts, ends, h = ts.words(data)
    return data, starts, ends, ts.mix(h ^ _language(lang)) if len(h) else h


class Vocabulary:
    def __init__(self, keys: np.ndarray, langs: list[str]):
        """``keys``: hashes of (language, word), any number; ids of classes come first, for each language and for shapes alone."""
        self.first = (len(langs) + 1) * len(CLASSES)
        self.shapes = len(langs) * len(CLASSES)
        self.langs = {lang: k * len(CLASSES) for k, lang in enumerate(langs)}
        order = np.argsort(keys)
        self.keys, self.ids = keys[order], (np.arange(len(keys)) + self.first)[order]

    def encode(self, text: str, lang: str | None, shapes: bool = False) -> np.ndarray | None:
        """``shapes``: by the model of shapes alone, as languages without trusted text are."""
        if not self.langs:
            return None
        data, starts, ends, h = word_keys(text, lang)
        if not len(h):
            return None
        base = self.shapes if shapes else self.langs.get(lang or "", self.shapes)
        ids = base + _shapes(data, starts, ends)
        if len(self.keys) and base != self.shapes:
            at = np.minimum(np.searchsorted(self.keys, h), len(self.keys) - 1)
            known = self.keys[at] == h
            ids[known] = self.ids[at[known]]
        first = np.concatenate([[True], h[1:] != h[:-1]])
        place = np.arange(len(h))
        run = place - np.maximum.accumulate(np.where(first, place, 0))  # earlier words of the same run
        for least, name in ((1, "repeat"), (3, "run4"), (7, "run8")):
            ids[run >= least] = base + CLASSES.index(name)
        return np.concatenate([[base + CLASSES.index("start")], ids])


def _bigrams(ids: np.ndarray) -> np.ndarray:
    return (ids[:-1].astype(U) << U(32)) | ids[1:].astype(U)


def _squeeze(*columns: np.ndarray) -> bytes:
    """Columns of one blob, their bytes by significance, compressed; ``_spread`` reads them."""
    raw = b"".join(np.ascontiguousarray(c).view(np.uint8).reshape(len(c), -1).T.tobytes() for c in columns)
    return np.array([len(raw)], np.int64).tobytes() + pa.compress(raw, codec="zstd", asbytes=True)


def _spread(blob: bytes, *columns: tuple[type, int]) -> list[np.ndarray]:
    raw = np.frombuffer(pa.decompress(blob[8:], int(np.frombuffer(blob, np.int64, 1)[0]), codec="zstd"), np.uint8)
    out, o = [], 0
    for kind, n in columns:
        size = np.dtype(kind).itemsize
        out.append(np.ascontiguousarray(raw[o : o + size * n].reshape(size, n).T).view(kind).reshape(n))
        o += size * n
    return out


def _steps(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ascending bigrams as steps: of first words, and of second words after the same first word; ``_summed`` reads them."""
    v, w = (keys >> U(32)).astype(np.int64), (keys & U(0xFFFFFFFF)).astype(np.int64)
    dv = np.diff(v, prepend=-1)
    return dv.astype(np.uint32), np.where(dv > 0, w, np.diff(w, prepend=0)).astype(np.uint32)


def _summed(dv: np.ndarray, dw: np.ndarray) -> np.ndarray:
    start = np.flatnonzero(dv)
    total = np.cumsum(dw, dtype=U)
    w = total - np.repeat(total[start] - dw[start], np.diff(start, append=len(dv)))
    return ((np.cumsum(dv, dtype=U) - U(1)) << U(32)) | w


def _word_counts(it):
    """(language, key, shape, n) of a partition, summed as far as it fits."""
    held: dict[str, list[tuple[np.ndarray, np.ndarray]]] = {}
    size = 0

    def flush():
        for lang, parts in held.items():
            key, at, n = np.unique(np.concatenate([h for h, _ in parts]), return_index=True, return_counts=True)
            shape = np.concatenate([x for _, x in parts])[at]  # a word's bytes tell its shape
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(key)), pa.array(key.view(np.int64)), pa.array(shape, pa.int32()), pa.array(n, pa.int64())], names=["lang", "key", "shape", "n"])
        held.clear()

    for b in it:
        for lang, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
            data, starts, ends, h = word_keys(text, lang)
            if len(h):
                held.setdefault(lang or "", []).append((h, _shapes(data, starts, ends).astype(np.int8)))
                size += len(h)
        if size > 1 << 22:
            yield from flush()
            size = 0
    yield from flush()


def _bigram_counts(vocabulary, parts: int):
    """Counts of a partition's bigrams, packed by ranges of their hash."""

    def run(it):
        v, held, size = vocabulary.value, [], 0

        def flush():
            key, n = np.unique(np.concatenate(held), return_counts=True)
            held.clear()
            yield from _by_part(key, n, parts)

        for b in it:
            for lang, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                if (ids := v.encode(text, lang)) is not None:
                    held += _bigrams(ids), _bigrams(v.encode(text, lang, True))
                    size += 2 * len(held[-1])
            if size > 1 << 22:
                yield from flush()
                size = 0
        if held:
            yield from flush()

    return run


def _by_part(key: np.ndarray, n: np.ndarray, parts: int) -> Iterator[pa.RecordBatch]:
    """Ascending keys and their counts in one row for each part."""
    part = _part(key, parts)
    order = np.argsort(part, kind="stable")
    cut = np.flatnonzero(np.concatenate([[True], np.diff(part[order]) != 0, [True]]))
    for a, b in zip(cut[:-1], cut[1:], strict=True):
        mine = order[a:b]
        yield _counted(part[mine[0]], key[mine], n[mine])


def _counted(part: int, key: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
    blob = np.array([len(key)], np.int64).tobytes() + _squeeze(*_steps(key), n.astype(np.int64))
    return an._rows([part], COUNTS, 0, 0, pa.array([blob], pa.binary()))


def _ranges(key: np.ndarray, bounds: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """Shard, start and end of ascending keys, for each shard that has some; ``bounds``: the least key of each shard but the first."""
    cut = [0, *np.searchsorted(key, bounds).tolist(), len(key)]
    return ((shard, a, b) for shard, (a, b) in enumerate(zip(cut[:-1], cut[1:], strict=True)) if a < b)


def _by_range(bounds: np.ndarray, groups: int):
    """Merged counts, packed by shard, for each group of batches."""

    def run(it):
        for key, n in _merged(it):
            for shard, a, b in _ranges(key, bounds):
                for group in range(groups):
                    yield _counted(group * (len(bounds) + 1) + shard, key[a:b], n[a:b])

    return run


def _merged(it) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    for b in it:
        yield from map(_keyed, b.column("blob").to_pylist())


def _sampled(every: int):
    def run(it):
        for key, _ in _merged(it):
            yield pa.RecordBatch.from_arrays([pa.array(key[::every].view(np.int64))], names=["key"])

    return run


def _keyed(blob: bytes) -> tuple[np.ndarray, np.ndarray]:
    n = int(np.frombuffer(blob, np.int64, 1)[0])
    *steps, counts = _spread(blob[8:], (np.uint32, n), (np.uint32, n), (np.int64, n))
    return _summed(*steps), counts


def _merge_counts(it):
    """One row of summed counts for each partition."""
    held: dict[int, list[bytes]] = {}
    for _ in an.sort_kinds(it, held):
        pass
    if blobs := held.get(COUNTS):
        keys, counts = (np.concatenate(x) for x in zip(*map(_keyed, blobs), strict=True))
        order = np.argsort(keys)
        keys = keys[order]
        first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
        yield _counted(0, keys[first], np.add.reduceat(counts[order], first))


def _unpack_counts(it):
    for key, n in _merged(it):
        yield pa.RecordBatch.from_arrays([pa.array((key >> U(32)).astype(np.int32)), pa.array(key.astype(np.uint32).astype(np.int32)), pa.array(n)], names=["v", "w", "n"])


_REPLY = "batch long, docs binary, logp binary"
OWN, HEAD, SHAPES = 0, 1, 2  # kinds of scores: of a short text or beginning, by shapes alone, or both
MEASURE = 4  # added for what only sets limits
MORE = 8  # added to all entries of a document but its first


def _versions(v: Vocabulary, lang: str, text: str, measure: bool, fp: int) -> Iterator[tuple[int, np.ndarray]]:
    """Kinds and ids to score: the document, or (``measure``) what sets the global limits."""
    if (ids := v.encode(text, lang)) is None:
        return
    by_shapes = v.encode(text, lang, True)
    if not measure:
        yield (HEAD if len(ids) <= MIN_WORDS else OWN) + (SHAPES if ids[0] == by_shapes[0] else 0), ids
        return
    words = 1 + fp % (MIN_WORDS - 1)
    if ids[0] != by_shapes[0]:
        yield HEAD, ids[: words + 1]
    yield HEAD + SHAPES, by_shapes[: words + 1]
    if len(ids) > MIN_WORDS:
        yield SHAPES, by_shapes


def _requests(vocabulary, bounds: np.ndarray, groups: int):
    """The distinct bigrams of batches of documents, packed by shard: keys, how many documents hold each, their places and counts.

    With the first of a batch's rows go the keys of its documents and their numbers of words.
    """

    def run(it):
        v, docs, held, size, batches = vocabulary.value, [], [], 0, 0
        task = TaskContext.get().partitionId()

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal batches
            key = np.concatenate([k for k, _ in held])
            n = np.concatenate([c for _, c in held])
            of = np.repeat(np.arange(len(held), dtype=np.uint16), [len(k) for k, _ in held])
            total = np.array([int(c.sum()) for _, c in held], dtype=np.int64)
            head = *(np.array(x, dtype=t) for x, t in zip(zip(*docs, strict=True), (np.int64, np.int32, np.int8), strict=True)), total
            order = np.argsort(key, kind="stable")  # places stay in order
            key, n, of = key[order], n[order], of[order]
            group = (task + batches) % groups
            for shard, a, b in _ranges(key, bounds):
                keys, times = np.unique(key[a:b], return_counts=True)
                first = () if a else head
                sizes = np.array([task << 32 | batches, len(held), len(keys), b - a, len(first)], np.int64)
                blob = sizes.tobytes() + _squeeze(*first, *_steps(keys), times.astype(np.uint32), of[a:b], n[a:b])
                yield an._rows([group * (len(bounds) + 1) + shard], REQUEST, 0, 0, pa.array([blob], pa.binary()))
            batches += 1
            docs.clear()
            held.clear()

        for b in it:
            for doc, fp, lang, text, measure in zip(*(b.column(k).to_pylist() for k in range(5)), strict=True):
                for kind, ids in _versions(v, lang, text, measure, fp) if text is not None else ():
                    key, n = np.unique(_bigrams(ids), return_counts=True)
                    kind |= MEASURE * measure
                    while True:  # a count field holds 65,535; larger counts take several entries
                        docs.append((doc, fp, kind))
                        kind |= MORE
                        held.append((key, np.minimum(n, 65535).astype(np.uint16)))
                        size += len(key)
                        key, n = key[n > 65535], n[n > 65535] - 65535
                        if not len(key):
                            break
                if size > PAIRS or len(held) > 60_000:
                    yield from flush()
                    size = 0
        if held:
            yield from flush()

    return run


def _part(key: np.ndarray, parts: int) -> np.ndarray:
    """Parts are ranges of the hash, so that one division cuts another into few pieces."""
    return (((ts.mix(key) >> U(32)) * U(parts)) >> U(32)).astype(np.int64)


def _score(model):
    """Sums of log-probabilities of a batch's documents in a shard."""

    def run(it):
        held: dict[int, list[bytes]] = {}
        for _ in an.sort_kinds(it, held):
            pass
        rest, unigram, member, total, d_high, language = model.value
        known, shares = np.empty(0, U), np.empty(0, np.float32)
        if blobs := held.pop(COUNTS, None):
            known, n = (np.concatenate(x) for x in zip(*map(_keyed, blobs), strict=True))
            order = np.argsort(known)
            known, n = known[order], n[order]
            v = (known >> U(32)).astype(np.int64)
            shares = ((n - d_high[language[v], np.minimum(n, 3)]) / total[v]).astype(np.float32)
            del blobs, order, n, v
        for blob in held.get(REQUEST, []):
            batch, nd, nk, n, first = np.frombuffer(blob, np.int64, 5).tolist()
            head = ((np.int64, nd), (np.int32, nd), (np.int8, nd), (np.int64, nd))[:first]
            *docs, dv, dw, times, place, count = _spread(blob[40:], *head, (np.uint32, nk), (np.uint32, nk), (np.uint32, nk), (np.uint16, n), (np.uint16, n))
            keys = _summed(dv, dw)
            v, w = (keys >> U(32)).astype(np.int64), (keys & U(0xFFFFFFFF)).astype(np.int64)
            p = rest[v] * unigram[w]
            if len(known):
                at = np.minimum(np.searchsorted(known, keys), len(known) - 1)
                p = p + np.where(known[at] == keys, shares[at].astype(np.float64), 0.0)
            logp = np.bincount(place, np.repeat(np.log(p) + member[w], times) * count, nd)
            yield pa.RecordBatch.from_arrays([pa.array([batch], pa.int64()), pa.array([_squeeze(*docs) if first else None], pa.binary()), pa.array([_squeeze(logp.astype(np.float32))], pa.binary())], names=["batch", "docs", "logp"])

    return run


def _sum_batches(it):
    """Keys, sum of log-probabilities and number of words of each document of the batches."""
    docs, sums = {}, {}
    for b in it:
        for batch, head, logp in zip(*(b.column(k).to_pylist() for k in range(3)), strict=True):
            logp = _spread(logp, (np.float32, int(np.frombuffer(logp, np.int64, 1)[0]) // 4))[0].astype(np.float64)
            sums[batch] = sums[batch] + logp if batch in sums else logp
            if head is not None:
                docs[batch] = head
    for batch, logp in sums.items():
        ids, fps, kinds, n = _spread(docs[batch], *((t, len(logp)) for t in (np.int64, np.int32, np.int8, np.int64)))
        yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(fps), pa.array(kinds.astype(np.int32)), pa.array(logp), pa.array(n)], names=["doc", "fp", "kind", "logp", "n"])


def _shards(pairs: int, partitions: int) -> int:
    """Each holds ``SHARD_PAIRS`` bigrams at most; every shard costs a document 4 bytes of sums before compression."""
    return max(-(-pairs // SHARD_PAIRS), min(LEAST_SHARDS, partitions), 1)


def _bounds(merged: DataFrame, pairs: int, shards: int) -> np.ndarray:
    """Bigrams that cut the merged counts into shards of about the same number."""
    if shards == 1:
        return np.empty(0, U)
    keys = merged.mapInArrow(_sampled(-(-pairs // SAMPLE) or 1), "key long").toPandas()["key"].to_numpy(dtype=np.int64).view(U)
    return np.sort(keys)[len(keys) * np.arange(1, shards) // shards] if len(keys) else np.empty(0, U)


def discounts(n1: int, n2: int, n3: int, n4: int) -> tuple[float, float, float]:
    """Modified Kneser-Ney discounts for counts of one, two, and three or more."""
    if not n1 or not n2:
        return 0.5, 0.5, 0.5
    y = n1 / (n1 + 2 * n2)
    d = 1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, (3 - 4 * y * n4 / n3) if n3 else 1.5
    return tuple(min(max(x, 0.05), k - 0.05) for k, x in enumerate(d, 1))


def _model(bigrams: DataFrame, size: int, language: np.ndarray):
    """Left-over weight of each context, interpolated unigrams, and the bigrams with their discounted shares.

    ``language``: the language of each id.  What is collected has at most a row per id.
    """
    of_v = bigrams.groupBy("v").agg(F.sum("n").alias("all"), *(F.sum((F.col("n") == k).cast("long")).alias(f"n{k}") for k in (1, 2, 3, 4)), F.sum((F.col("n") >= 3).cast("long")).alias("more")).toPandas()
    of_w = bigrams.groupBy("w").agg(F.count("*").alias("seen")).toPandas()
    n_lang = int(language.max()) + 1 if len(language) else 0
    d_high, rest, total = np.full((n_lang, 4), 0.5), np.ones(size), np.ones(size)
    v, lang = of_v["v"].to_numpy(), language[of_v["v"].to_numpy()]
    for k in range(n_lang):
        d_high[k, 1:] = discounts(*(int(of_v.loc[lang == k, f"n{j}"].sum()) for j in (1, 2, 3, 4)))
    total[v] = of_v["all"]
    rest[v] = (d_high[lang, 1] * of_v["n1"] + d_high[lang, 2] * of_v["n2"] + d_high[lang, 3] * of_v["more"]) / of_v["all"]
    seen = np.zeros(size)
    seen[of_w["w"].to_numpy()] = of_w["seen"]
    unigram = np.zeros(size)
    for k in range(n_lang):
        mine = language == k
        c = seen[mine]
        d = np.array([0.0, *discounts(*(int((c == j).sum()) for j in (1, 2, 3, 4)))])[np.minimum(c, 3).astype(int)]
        unigram[mine] = (c - d) / max(c.sum(), 1) + d.sum() / max(c.sum(), 1) / mine.sum()
        if not c.sum():
            unigram[mine] = 1 / mine.sum()
    return rest, unigram, total, d_high


def perplexities(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """__k, __fp (keys of a row), trusted, lang, kind, n_tokens and perplexity of every row of ``docs`` (doc_id, text, lang);
    kind, n_tokens and perplexity of what sets the global limits.
    """
    spark = docs.sparkSession
    ship_code(spark)
    rows = docs.select(*_keys(), F.col("doc_id").cast("long").alias("__id"), F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("lang"), F.col("text"))
    good = labels.where("doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("__id")).agg(F.min((F.coalesce("quality", F.lit(0)) > 0) & (F.coalesce("toxic", F.lit(0)) == 0)).alias("good")).where("good").select("__id")
    good = durable(good)
    if good.count() <= BROADCAST_IDS:
        good = F.broadcast(good)
    of_trust = rows.where("text is not null").join(good, "__id", "left_semi")
    trusted = of_trust.where(~_held_out()).select("lang", "text")
    measured = of_trust.where(_held_out()).select("__k", "__fp", "lang", "text", F.lit(True).alias("measure"))
    counts = trusted.mapInArrow(_word_counts, "lang string, key long, shape int, n long").groupBy("lang", "key").agg(F.first("shape").alias("shape"), F.sum("n").alias("n"))
    counts = stored(counts, counted := f"{shared_folder(spark)}/words-{uuid.uuid4().hex}")
    # at most one class set per language; languages by text
    langs = [r["lang"] for r in counts.groupBy("lang").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "lang").limit(512).collect()]
    place = F.array_position(F.array(*map(F.lit, langs)).cast("array<string>"), F.col("lang")) - 1  # -1 beyond them
    words = counts.where(F.col("n") >= MIN_COUNT).select("key", place.cast("int").alias("place"), "n").where("place >= 0").toPandas()
    words = words.sort_values(["place", "n", "key"], ascending=[True, False, True])  # frequent words are neighbours: steps between bigrams are short
    rare = counts.where(F.col("n") < MIN_COUNT).groupBy(place.cast("int").alias("place"), "shape").agg(F.count("*").alias("types")).where("place >= 0").collect()
    remove_folder(spark, counted)
    vocabulary = Vocabulary(words["key"].to_numpy(dtype=np.int64).view(np.uint64), langs)
    language = np.concatenate([np.repeat(np.arange(len(langs) + 1), len(CLASSES)), words["place"].to_numpy(dtype=np.int64)]).astype(np.int64)
    size = len(language)
    member = np.zeros(size)
    for r in rare:
        member[r["place"] * len(CLASSES) + r["shape"]] = r["types"]
    for k in range(len(langs)):
        first = k * len(CLASSES)
        member[first + 1 : first + 4] = member[first + 4 : first + len(CLASSES)].sum() + (language[(len(langs) + 1) * len(CLASSES) :] == k).sum()
    member = -np.log(member + 1)
    shared = spark.sparkContext.broadcast(vocabulary)
    parts = shuffle_partitions(spark)
    merged = trusted.mapInArrow(_bigram_counts(shared, parts), an.POSTED).repartitionById(parts, F.col("part")).mapInArrow(_merge_counts, an.POSTED)
    merged = durable(merged)
    bigrams = merged.mapInArrow(_unpack_counts, "v int, w int, n long")
    pairs = bigrams.count()
    shards = _shards(pairs, parts)
    # partial sums of words are a row for each word and task
    rest, unigram, total, d_high = _model(merged.coalesce(shards).mapInArrow(_unpack_counts, bigrams.schema), size, language)
    tables = spark.sparkContext.broadcast((rest, unigram, member, total, d_high, language))
    bounds = _bounds(merged, pairs, shards)
    shards = len(bounds) + 1
    groups = max(1, -(-input_bytes(rows) // (GROUP_BYTES * shards)))
    packed = merged.mapInArrow(_by_range(bounds, groups), an.POSTED)
    asked = rows.select("__k", "__fp", "lang", "text", F.lit(False).alias("measure")).unionByName(measured).mapInArrow(_requests(shared, bounds, groups), an.POSTED)
    replies = packed.unionByName(asked).repartitionById(groups * shards, F.col("part")).mapInArrow(_score(tables), _REPLY)
    sums = replies.repartition(parts, "batch").mapInArrow(_sum_batches, "doc long, fp int, kind int, logp double, n long")
    sums = sums.withColumns({"first": (F.col("kind") < MORE).cast("long"), "kind": F.col("kind").bitwiseAND(MORE - 1)})
    # repeated rows have their sums in common: one of them has the sum over their number
    tokens = (F.sum("n") / F.sum("first")).cast("long").alias("n_tokens")
    scored = sums.groupBy(F.col("doc").alias("__k"), F.col("fp").alias("__fp"), F.when(F.col("kind") >= MEASURE, F.col("kind")).alias("limit_of")).agg(F.max("kind").alias("kind"), tokens, F.exp(-F.sum("logp") / F.sum("n")).alias("perplexity"))
    scored = durable(scored)
    slim = rows.select("__k", "__fp", "__id", "lang").join(scored.where("limit_of is null").drop("limit_of"), ["__k", "__fp"], "left")
    slim = slim.join(good.withColumn("trusted", F.lit(True)), "__id", "left").withColumn("trusted", F.coalesce("trusted", F.lit(False)))
    return slim, scored.where("limit_of is not null").select((F.col("kind") - MEASURE).alias("kind"), "n_tokens", "perplexity")


def _held_out():
    """Trusted documents that set the thresholds and are kept out of the counts."""
    return F.pmod(F.xxhash64("__id"), F.lit(4)) == 0


def _keys():
    return [F.coalesce(F.col("doc_id").cast("long"), F.xxhash64("text")).alias("__k"), F.hash("text").alias("__fp")]


def classify(docs: DataFrame, labels: DataFrame, quantile: float = QUANTILE) -> DataFrame:
    """doc_id, lang, n_tokens, perplexity, threshold, kept (and the row keys __k, __fp)."""
    scores, measured = perplexities(docs, labels)
    scores = durable(scores)
    held = scores.where(_held_out()).where(F.col("trusted") & (F.col("kind") == OWN))
    level = F.when(F.col("kind") == OWN, F.col("lang")).when(F.col("kind") != SHAPES, F.col("n_tokens").cast("string")).otherwise("").alias("level")
    limit = F.percentile_approx("perplexity", quantile, 100_000)
    limits = held.select("kind", "n_tokens", "perplexity", "lang").unionByName(measured.withColumn("lang", F.lit(""))).select("kind", level, "perplexity")
    every = limits.groupBy("kind").agg(limit.alias("every"))
    limits = limits.groupBy("kind", "level").agg(limit.alias("own"), F.count("*").alias("held"))  # a row per language or length, 535 at most
    out = scores.withColumn("level", level).join(F.broadcast(limits), ["kind", "level"], "left").join(F.broadcast(every), "kind", "left")
    out = out.withColumn("threshold", F.when(F.col("held") >= MIN_HELD, F.col("own")).otherwise(F.greatest("own", "every")))
    kept = F.coalesce(F.col("perplexity") <= F.col("threshold"), F.lit(True))
    return out.select(F.col("__id").alias("doc_id"), "lang", F.coalesce("n_tokens", F.lit(0)).cast("long").alias("n_tokens"), "perplexity", "threshold", kept.alias("kept"), "__k", "__fp")


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` without the rejected documents."""
    safe, back = shielded(docs, "doc_id", "text", "lang")
    gone = classify(safe, labels).where("not kept").select(F.col("__k").alias("__gone_k"), F.col("__fp").alias("__gone_fp")).distinct()
    k, fp = _keys()
    keyed = safe.withColumns({"__key": k, "__print": fp})
    return back(keyed.join(gone, (F.col("__key") == F.col("__gone_k")) & (F.col("__print") == F.col("__gone_fp")), "left_anti"))


def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")).drop("__k", "__fp")
