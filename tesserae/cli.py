"""Command line: python -m tesserae.cli COMMAND CONFIG ..."""

from __future__ import annotations

import argparse
import statistics
import sys
from pathlib import Path

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from .functions import topology as tp
from .operators import inspection, layout, tasks, validate
from .plans.project import MissingOffsets, Project
from .sources import config as cf
from .sources import files, store
from .sources.volumes import read_volume


class Abort(Exception):
    def __init__(self, problems: list[str]):
        super().__init__("\n".join(problems))


def _window(a, p: Project) -> tuple[int, int]:
    t0, t1 = a.between or (0, p.nt)
    if not 0 <= t0 < t1 <= p.nt:
        raise Abort([f"--between {t0} {t1} must lie within 0..{p.nt}"])
    return t0, t1


def cmd_validate(a, spark):
    problems = validate.check(cf.load(a.config), check_files=a.deep, base=Path(a.config).parent)
    if not problems and a.deep:
        problems = Project(spark, a.config).graph_problems()
    if problems:
        raise Abort(problems)
    print("ok")


def cmd_timeline(a, spark):
    p = Project(spark, a.config)
    for r in layout.timeline_report(p.files, p.state).orderBy("file_i").collect():
        print(f"file {r.file_i}: t={r.first_t}..{r.end_t - 1} ({r.nt}), {r.n_alive} tiles, {r.n_anchors} anchors")
    print(f"{p.nt} timepoints in all")
    if a.at is not None:
        r = layout.locate(p.files, spark.createDataFrame([(a.at,)], "t int")).first()
        names = [x.name + ("*" if x.anchor else "") for x in p.state.where(F.col("t") == a.at).orderBy("name").collect()]
        print(f"t={a.at}: file {r.file_i}, local {r.local_t}: {', '.join(names)}")


def cmd_graph(a, spark):
    p = Project(spark, a.config)
    routings = p.routings(*_window(a, p))
    blocks = tp.report(routings, a.tile)
    if a.only_ambiguous:
        blocks = [b for b in blocks if b[0].endswith("ambiguous")]
    text = "\n\n".join("\n".join(b) for b in blocks)
    if a.out:
        Path(a.out).write_text(text + "\n")
    else:
        print(text)
    if a.strict and any(r.ambiguous for r in routings.values()):
        raise Abort(["the placement is ambiguous"])


def cmd_status(a, spark):
    p = Project(spark, a.config, a.precision)
    t0, t1 = _window(a, p)
    for r in tasks.status(tasks.between(p.plan, t0, t1), p.offsets()).orderBy("kind").collect():
        print(f"{r.kind}: {r.n_cached} of {r.n_tasks} cached ({r.percent}%), {r.n_pending} pending" + ("" if r.next_t is None else f", next t={r.next_t}"))


def cmd_show(a, spark):
    p = Project(spark, a.config, a.precision)
    for r in tasks.show(p.plan, p.offsets(), a.at).orderBy("what").collect():
        print(f"{r.what}: " + ("(not computed)" if r.dz is None else f"dz={r.dz} dy={r.dy} dx={r.dx}"))


def cmd_offsets(a, spark):
    p = Project(spark, a.config, a.precision)
    t0, t1 = _window(a, p)
    if a.dry_run:
        n = tasks.pending(tasks.between(p.plan, t0, t1), p.offsets()).count()
        print(f"{n if a.limit is None else min(n, a.limit)} tasks would run")
        return
    print(f"{p.compute(t0, t1, a.limit, a.slice, a.attempts, a.concurrency, a.max_mb)} tasks run")


def cmd_blend(a, spark):
    p = Project(spark, a.config, a.precision)
    t0, t1 = _window(a, p)
    output = Path(a.output) if a.output else p.work.canvas
    if a.recreate and not a.dry_run:
        for place in (output, store.geometry_path(output)):
            files.remove(place)
        store.remove_log(f"{output}.log.jsonl")
    if a.dry_run:
        print(f"{p.coordinates(t0, t1).select('t').distinct().count()} timepoints can be placed")
        return
    pad = tuple(a.pad) if len(a.pad) == 3 else (0, a.pad[0], a.pad[0])
    print(f"{p.blend(output, t0, t1, a.dtype, pad, tuple(a.chunk), a.skeleton, a.force, a.at_once, a.attempts, not a.no_log, a.writers)} timepoints written")
    for r in p.timings if a.timings else ():
        print(f"t={tp.spans(r['t'])}: {r['seconds']:.2f} s; {r['chunks']} chunks, {r['read_s']:.2f} s of reading and {r['compose_s']:.2f} s of composing in tasks; driver at {r['driver_mb']:.0f} MB")


def _ref(p: Project, name: str, t: int) -> tuple[str, int, int]:
    """Path, position and local time of a tile's volume."""
    f = max(i for i in range(len(p.nts)) if sum(p.nts[:i]) <= t)
    pos = next(x for n, i, x in p._tile_file if n == name and i == f)
    return p.headers[f].path, pos, t - sum(p.nts[:f])


def _volume(p: Project, name: str, t: int):
    return read_volume(*_ref(p, name, t), p.nz)


def cmd_inspect(a, spark):
    p = Project(spark, a.config, a.precision)
    rows = p.plan.where((F.col("kind") == "pair") & (F.col("t") == a.at)).join(p.offsets().select("key", "dz", "dy", "dx"), "key", "left").orderBy("a", "b").collect()
    if a.pair:
        rows = [r for r in rows if {r.a, r.b} == set(a.pair if len(a.pair) > 1 else a.pair[0].split(","))]
    if not rows:
        known = p.pairs_at.where(F.col("t") == a.at).select("a", "b").distinct().orderBy("a", "b").collect()
        tiles = sorted({n for r in known for n in (r.a, r.b)})
        raise Abort([f"no such pair at t={a.at}; tiles with neighbours: {', '.join(tiles) or 'none'}; pairs: " + (", ".join(f"{r.a}|{r.b}" for r in known) or "none")])
    for r in rows:
        if r.dz is None:
            raise MissingOffsets([r.what])
        inspection.pair(_volume(p, r.a, a.at), _volume(p, r.b, a.at), r.axis, p.shift, (r.dz, r.dy, r.dx), Path(a.out or p.work.root / "inspect") / f"{r.a}_{r.b}_t{a.at}", not a.no_response, a.precision)
        print(r.what)


def cmd_drift(a, spark):
    p = Project(spark, a.config, a.precision)
    t0, t1 = _window(a, p)
    rows = tasks.between(p.plan.where((F.col("kind") == "time") & (F.col("a") == a.tile)), max(t0, 1), t1).join(p.offsets().select("key", "dz", "dy", "dx"), "key", "left").orderBy("t").collect()
    if lost := [r.what for r in rows if r.dz is None]:
        raise MissingOffsets(lost)
    if not rows:
        raise Abort([f"'{a.tile}' never drifts in t={t0}..{t1 - 1}"])
    steps = [(r.t, (r.dz, r.dy, r.dx), r.realign) for r in rows]
    refs = [(t, *_ref(p, a.tile, t)) for t in (rows[0].t - 1, *(r.t for r in rows))]
    table = inspection.drift(spark, refs, steps, p.nz, Path(a.out or p.work.root / "drift" / a.tile), a.size, a.full)
    sizes = [r["magnitude"] for r in table]
    med = statistics.median(sizes)
    far = [r for r in table if r["magnitude"] > max(3 * med, med + 5)]
    print(f"{len(table)} steps, median {med:.2f} px, {len(far)} outliers")
    for r in far[:10]:
        print(f"  t={r['t']}: {r['magnitude']:.2f} px")


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="tesserae")
    sub = top.add_subparsers(dest="command", required=True)

    def command(name, run, between=False, precision=True):
        c = sub.add_parser(name)
        c.add_argument("config")
        c.set_defaults(run=run)
        if between:
            c.add_argument("--between", nargs=2, type=int, metavar=("T0", "T1"))
        if precision:
            c.add_argument("--precision", choices=("float32", "float64"), default="float32")
        return c

    flag = lambda c, *names: [c.add_argument(n, action="store_true") for n in names]
    flag(command("validate", cmd_validate, precision=False), "--deep")
    command("timeline", cmd_timeline, precision=False).add_argument("--at", type=int)
    c = command("graph", cmd_graph, True, False)
    c.add_argument("--tile")
    c.add_argument("--out")
    flag(c, "--only-ambiguous", "--strict")
    command("status", cmd_status, True)
    command("show", cmd_show).add_argument("--at", type=int, required=True)
    c = command("offsets", cmd_offsets, True)
    c.add_argument("--limit", type=int)
    c.add_argument("--slice", type=int, default=64, help="timepoints that are appended to the log together")
    c.add_argument("--attempts", type=int, default=4)
    c.add_argument("--concurrency", type=int, help="tasks that work at once, at most")
    c.add_argument("--max-mb", type=float, help="volumes and spectra that a task holds")
    flag(c, "--dry-run", "--no-progress")
    c = command("blend", cmd_blend, True)
    c.add_argument("--output")
    c.add_argument("--dtype", default="uint16")
    c.add_argument("--pad", nargs="+", type=int, default=[0])
    c.add_argument("--chunk", nargs=3, type=int, default=[32, 512, 512])
    c.add_argument("--at-once", type=int, default=0, help="timepoints that a job writes, 0: all; then they are marked")
    c.add_argument("--attempts", type=int, default=4)
    c.add_argument("--writers", type=int, help="tasks that write at once, at most")
    flag(c, "--no-progress", "--skeleton", "--recreate", "--force", "--dry-run", "--no-log", "--timings")
    c = command("inspect", cmd_inspect)
    c.add_argument("--at", type=int, required=True)
    c.add_argument("--pair", nargs="+", metavar="TILE", help="two tiles in any order, or both with a comma between")
    c.add_argument("--out")
    flag(c, "--no-response")
    c = command("drift", cmd_drift, True)
    c.add_argument("--tile", required=True)
    c.add_argument("--size", type=int, default=256)
    c.add_argument("--out")
    flag(c, "--full")
    return top


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    args = parser().parse_args(argv)
    try:
        progress = not getattr(args, "no_progress", False)
        args.run(args, spark or SparkSession.builder.appName("tesserae").config("spark.ui.showConsoleProgress", str(progress).lower()).getOrCreate())
    except (Abort, FileNotFoundError, validate.ConfigError, store.CanvasMismatch, MissingOffsets) as e:
        print(e, file=sys.stderr)
        return 1
    return 0


if __name__ == "__main__":
    sys.exit(main())
