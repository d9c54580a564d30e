"""Units of work with content keys, and what is pending against a memo table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import layout

Bound = tuple[int | None, int | None]


def digest(text: Column) -> Column:
    """First 16 hex digits of the SHA-256 of compact JSON text."""
    return F.substring(F.sha2(text, 256), 1, 16)


def json_string(text: Column) -> Column:
    """Text as a JSON string in ASCII: quotes, backslashes and control characters escaped, all others by their UTF-16 codes."""
    unit = lambda code: F.concat(F.lit("\\u"), F.lpad(F.lower(F.hex(code)), 4, "0"))

    def one(c: Column) -> Column:
        code = F.ascii(c)  # the code point
        named = F.create_map(*[F.lit(x) for pair in (('"', '\\"'), ("\\", "\\\\"), ("\n", "\\n"), ("\r", "\\r"), ("\t", "\\t"), ("\b", "\\b"), ("\f", "\\f")) for x in pair])
        high = code - 0x10000
        wide = F.concat(unit(F.lit(0xD800) + F.floor(high / 1024)), unit(F.lit(0xDC00) + F.pmod(high, F.lit(1024))))
        return F.coalesce(F.try_element_at(named, c), F.when((code >= 32) & (code < 127), c).when(code < 0x10000, unit(code)).otherwise(wide))

    plain = text.rlike(r'^[ !#-\[\]-~]*$')
    return F.concat(F.lit('"'), F.when(plain, text).otherwise(F.array_join(F.transform(F.split(text, ""), one), "")), F.lit('"'))


def file_key(path: Column, size: Column, mtime: Column) -> Column:
    """Digest of a file's identity, keys sorted."""
    return digest(F.concat(F.lit('{"mtime":'), mtime.cast("string"), F.lit(',"path":'), json_string(path), F.lit(',"size":'), size.cast("string"), F.lit("}")))


def _bound(b: Bound) -> str:
    return "[" + ",".join("null" if x is None else str(x) for x in b) + "]"


def crop_json(z: Bound, y: Bound, x: Bound, free_axis: int = 0) -> str:
    """A crop as JSON; the restriction on a free lateral axis is dropped."""
    parts = [z, y, x]
    if free_axis:
        parts[free_axis] = (None, None)
    return "[" + ",".join(map(_bound, parts)) + "]"


def clamp(stop: Column, nz: Column) -> Column:
    return F.least(F.coalesce(stop, nz), nz)


def _volume(prefix: str) -> Column:
    c = lambda n: F.col(f"{prefix}_{n}").cast("string")
    return F.concat(F.lit('["'), c("file"), F.lit('",'), c("pos"), F.lit(","), c("local_t"), F.lit(","), c("nz"), F.lit("]"))


def volumes(state: DataFrame, times: DataFrame, tile_file: DataFrame, keys: DataFrame, nz: int) -> DataFrame:
    """t, name with the volume that shows the tile there: file key, position, local time, planes."""
    at = state.select("t", "name", "file_i").join(times.select("t", "local_t"), "t")
    out = at.join(tile_file, ["name", "file_i"]).join(keys.select("file_i", "file_key"), "file_i")
    return out.select("t", "name", F.col("file_key").alias("file"), F.col("pos_i").alias("pos"), "local_t", F.lit(nz).alias("nz"))


def _as(refs: DataFrame, prefix: str, **names: str) -> DataFrame:
    return refs.select(*[F.col(c).alias(n) for c, n in names.items()], *[F.col(c).alias(f"{prefix}_{c}") for c in ("file", "pos", "local_t", "nz")])


def time_tasks(state: DataFrame, refs: DataFrame, overrides: DataFrame, crop: str, realign_crop: str, precision: str = "float32") -> DataFrame:
    """A task per anchor that lived one timepoint earlier; its crop is the realign crop where an override says so."""
    before = state.select((F.col("t") + 1).alias("t"), "name")
    realigned = overrides.where("verb = 'realign'").select("t", "name").distinct().withColumn("realign", F.lit(True))
    base = state.where("anchor and t >= 1").select("t", "name").join(before, ["t", "name"], "left_semi").join(realigned, ["t", "name"], "left")
    src, dst = _as(refs.withColumn("t", F.col("t") + 1), "src", t="t", name="name"), _as(refs, "dst", t="t", name="name")
    out = base.join(src, ["t", "name"]).join(dst, ["t", "name"]).withColumn("realign", F.coalesce("realign", F.lit(False)))
    text = F.concat(F.lit('["time",'), _volume("src"), F.lit(","), _volume("dst"), F.lit(","), F.when(F.col("realign"), F.lit(realign_crop)).otherwise(F.lit(crop)), F.lit(f',"{precision}"]'))
    what = F.concat(F.lit("time "), F.col("name"), F.lit(" "), (F.col("t") - 1).cast("string"), F.lit("->"), F.col("t").cast("string"), F.when(F.col("realign"), F.lit(" (realign)")).otherwise(F.lit("")))
    return out.select("t", F.lit("time").alias("kind"), F.col("name").alias("a"), F.lit(None).cast("string").alias("b"), F.lit(0).alias("axis"), "realign", digest(text).alias("key"), what.alias("what"), *[f"{p}_{c}" for p in ("src", "dst") for c in ("file", "pos", "local_t", "nz")])


def pair_tasks(pairs_at: DataFrame, refs: DataFrame, crop_by_axis: dict[int, str], shift_px: int, precision: str = "float32") -> DataFrame:
    """A task per living pair and timepoint."""
    out = pairs_at.join(_as(refs, "src", t="t", name="a"), ["t", "a"]).join(_as(refs, "dst", t="t", name="b"), ["t", "b"])
    crop = F.when(F.col("axis") == 1, F.lit(crop_by_axis[1])).otherwise(F.lit(crop_by_axis[2]))
    text = F.concat(F.lit('["pair",'), _volume("src"), F.lit(","), _volume("dst"), F.lit(","), F.col("axis").cast("string"), F.lit(f",{shift_px},"), crop, F.lit(f',"{precision}"]'))
    what = F.concat(F.lit("pair "), F.col("a"), F.lit("|"), F.col("b"), F.lit(" axis="), F.col("axis").cast("string"), F.lit(" t="), F.col("t").cast("string"))
    return out.select("t", F.lit("pair").alias("kind"), "a", "b", "axis", F.lit(False).alias("realign"), digest(text).alias("key"), what.alias("what"), *[f"{p}_{c}" for p in ("src", "dst") for c in ("file", "pos", "local_t", "nz")])


#: Work order: by timepoint, drifts before pairs, then by tile or by (a, b, axis).
ORDER = ["t", "kind_rank", "a", "b", "axis"]


def plan(times: DataFrame, pairs: DataFrame) -> DataFrame:
    return times.unionByName(pairs).withColumn("kind_rank", F.when(F.col("kind") == "time", 0).otherwise(1))


def between(tasks: DataFrame, t0: int, t1: int) -> DataFrame:
    return tasks.where((F.col("t") >= t0) & (F.col("t") < t1))


def pending(tasks: DataFrame, done: DataFrame) -> DataFrame:
    return tasks.join(done.select("key").distinct(), "key", "left_anti")


def first_pending(tasks: DataFrame, done: DataFrame, n: int) -> DataFrame:
    return pending(tasks, done).orderBy(*ORDER).limit(n)


def volume_uses(tasks: DataFrame) -> DataFrame:
    """How often the tasks read each volume."""
    ref = lambda p: F.struct(*[F.col(f"{p}_{c}").alias(c) for c in ("file", "pos", "local_t")])
    return tasks.select(F.explode(F.array(ref("src"), ref("dst"))).alias("v")).groupBy("v.file", "v.pos", "v.local_t").agg(F.count("*").alias("uses"))


def spectrum_uses(tasks: DataFrame) -> DataFrame:
    """How often the tasks need each transform: a pair's strip differs by axis and side, a drift's crop by realignment."""
    ref = lambda p, side: F.struct(*[F.col(f"{p}_{c}").alias(c) for c in ("file", "pos", "local_t")], "axis", "realign", F.when(F.col("kind") == "pair", F.lit(side)).otherwise(F.lit("")).alias("side"))
    return tasks.select(F.explode(F.array(ref("src", "parent"), ref("dst", "child"))).alias("s")).groupBy("s.file", "s.pos", "s.local_t", "s.axis", "s.realign", "s.side").agg(F.count("*").alias("uses"))


def tile_blocks(points: DataFrame, spacing: float, size: int) -> DataFrame:
    """name, block: tiles in blocks of ``size`` along a Z-order curve over the grid of ``points(name, x_um, y_um)``, so that
    most neighbours are in the same block."""
    at = points.groupBy("name").agg(F.min("x_um").alias("x"), F.min("y_um").alias("y"))
    low = at.agg(F.min("x").alias("x0"), F.min("y").alias("y0"))  # one row
    cell = lambda c: F.floor((F.col(c) - F.col(f"{c}0")) / spacing).cast("long")
    spread = lambda c: F.conv(F.bin(cell(c)), 4, 10).cast("long")  # noqa: E731  binary digits read in base four
    code = F.lpad((spread("x") + 2 * spread("y")).cast("string"), 20, "0")
    ranked = layout.ranked(at.crossJoin(F.broadcast(low)).select("name", F.concat(code, F.lit(" "), F.col("name")).alias("code")), "code", "rank")
    return ranked.select("name", F.floor(F.col("rank") / size).cast("int").alias("block"))


def placed_tasks(tasks: DataFrame, blocks: DataFrame, span: int) -> DataFrame:
    """Tasks with their block and ``span`` of timepoints: a pair that two blocks share goes to the earlier one, a drift to
    that of its later timepoint."""
    a, b = (blocks.select(F.col("name").alias(c), F.col("block").alias(f"block_{c}")) for c in ("a", "b"))
    both = tasks.join(a, "a").join(b, "b", "left")
    return both.withColumns({"block": F.least("block_a", "block_b"), "span": F.floor(F.col("t") / span).cast("int")}).drop("block_a", "block_b")


def volume_readers(placed: DataFrame) -> DataFrame:
    """How many blocks of tasks read each volume, and how many of their tasks use it."""
    ref = lambda p: F.struct(*[F.col(f"{p}_{c}").alias(c) for c in ("file", "pos", "local_t")])
    per = placed.select("block", "span", F.explode(F.array(ref("src"), ref("dst"))).alias("v")).groupBy("v", "block", "span").agg(F.count("*").alias("n"))
    return per.groupBy("v").agg(F.count("*").alias("readers"), F.sum("n").alias("uses")).select("v.*", "readers", "uses")


def status(tasks: DataFrame, done: DataFrame) -> DataFrame:
    """Per kind: tasks, cached, pending, percent, and the first pending timepoint."""
    known = done.select("key").distinct().withColumn("hit", F.lit(1))
    hits = F.count("hit")
    return tasks.join(known, "key", "left").groupBy("kind").agg(F.count("*").alias("n_tasks"), hits.alias("n_cached"), (F.count("*") - hits).alias("n_pending"), F.round(100.0 * hits / F.count("*"), 1).alias("percent"), F.min(F.when(F.col("hit").isNull(), F.col("t"))).alias("next_t"))


def show(tasks: DataFrame, offsets: DataFrame, t: int) -> DataFrame:
    """Tasks of one timepoint with their offsets, nulls where there is none yet."""
    return tasks.where(F.col("t") == t).join(offsets.select("key", "dz", "dy", "dx"), "key", "left").select("what", "dz", "dy", "dx")


def last_wins(log: DataFrame, key: str, order: list[str]) -> DataFrame:
    """The last row of each key; an aggregate, so that a hot key is reduced before the shuffle."""
    rest = [c for c in log.columns if c != key]
    top = F.max_by(F.struct(*rest), F.struct(*order)).alias("x")
    return log.groupBy(key).agg(top).select(key, *[F.col(f"x.{c}").alias(c) for c in rest])
