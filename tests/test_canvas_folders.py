"""Timepoints of few small chunks share folders."""

from pathlib import Path

from pyspark.sql import functions as F

from tesserae.operators import canvas
from tesserae.plans.queries import ALL

SF = "/root/testdata/sf0.001"


def test_a_resumed_canvas_has_no_folder_for_each_timepoint(spark):
    shared = Path(spark.conf.get("spark.checkpoint.dir"))
    before = set(shared.glob("canvas-*"))
    got = sorted(map(tuple, ALL["canvas_resumed"](spark, SF).collect()))
    (folder,) = set(shared.glob("canvas-*")) - before
    assert len({x[0] for x in got}) > 1 and len(list(folder.glob("*/frame=*"))) == 1
    assert got == sorted(map(tuple, ALL["blend_chunks"](spark, SF).collect()))


def test_chunks_of_either_layout_are_found(spark, tmp_path):
    chunks = spark.range(30).select((F.col("id") / 3).cast("int").alias("t"), F.lit(0).alias("cz"), F.lit(0).alias("cy"), (F.col("id") % 3).cast("int").alias("cx"), F.unhex(F.lit("00")).alias("data"), F.lit("k").alias("frame"))
    want = sorted((r.t, "k", 0, 0, r.cx) for r in chunks.collect())
    for span in (None, 4):
        path = str(tmp_path / f"of{span}")
        for part in ("cx = 0", "cx > 0"):
            canvas.write_chunks(chunks.where(part), path, span)
        assert sorted(map(tuple, canvas.written(spark, path).collect())) == want
        assert len(list(Path(path).glob("*/frame=k"))) == (3 if span else 10)
