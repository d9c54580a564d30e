import json

from tesserae.streaming import log


def test_last_row_of_each_key_over_batches(spark, tmp_path):
    src = tmp_path / "log"
    src.mkdir()
    line = lambda k, seq, z: json.dumps({"key": k, "kind": "time", "seq": seq, "dz": z, "dy": 0, "dx": 0})
    (src / "0.json").write_text("\n".join([line("a", 1, 1), line("b", 2, 2), '{"key": "c", ']))
    run = lambda: log.keep_last(log.read(spark, str(src)), str(tmp_path / "t"), str(tmp_path / "c")).awaitTermination()
    run()
    (src / "1.json").write_text(line("a", 3, 9))
    run()
    assert {r.key: r.dz for r in spark.read.parquet(str(tmp_path / "t" / "1")).collect()} == {"a": 9, "b": 2}
