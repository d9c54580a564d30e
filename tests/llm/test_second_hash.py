"""Single windows are compared by two hashes, not by one hash twice."""

import numpy as np

from tesserae.llm import anchors as an
from tesserae.llm import substring_dedup, suffix_dedup
from tesserae.llm import textscan as ts


def test_windows_are_posted_with_two_hashes(monkeypatch):
    got = []
    monkeypatch.setattr(an.Poster, "add", lambda self, doc, fp, g, run, at, count: got.append((g, run)))

    import pyarrow as pa

    text = " ".join(f"w{k % 70}" for k in range(200))
    ask = np.zeros(1, dtype=an.ASK)
    ask["at"], ask["n"] = 3, 90
    asks = [[{"kind": k, "blob": ask.tobytes()} for k in kinds] for kinds in ([an.HOT],)]
    kind = pa.list_(pa.struct([("kind", pa.int32()), ("blob", pa.binary())]))
    batch = pa.RecordBatch.from_arrays([pa.array([1]), pa.array([2], pa.int32()), pa.array([text]), pa.array(asks, kind)], names=["doc", "fp", "text", "asks"])
    for module in (substring_dedup, suffix_dedup):
        try:
            list(module._level2(50)(4)(iter([batch])))
        except AttributeError:  # nothing is held, as nothing was added
            pass
    assert len(got) == 2
    low = np.uint64((1 << 40) - 1)
    for g, run in got:
        assert len(g) == len(run) == 90 and not ((g & low) == (run & low)).any()
    g, run = got[0]  # words: equal windows 70 words apart have equal hashes
    assert (g[:20] == g[70:]).all() and (run[:20] == run[70:]).all() and len(np.unique(run[:70])) == 70


def test_second_hash_tells_windows_apart_as_the_text_does():
    data = np.frombuffer(b"abcdefghij" * 9 + b"abcdefghix" * 3, np.uint8)
    half = ts.second_hash(ts.byte_windows(data, 13), 13, 25)
    text = [bytes(data[k : k + 25]) for k in range(len(data) - 24)]
    assert len(half) == len(text) and len(set(half.tolist())) == len(set(text)) == len({*zip(half.tolist(), text)})
