"""Token counts of whole texts, huge ones by overlap resynchronisation.

A text of more than ``chunk`` characters is encoded in chunks that overlap, with offsets.  Two neighbouring encodings are
spliced at a place in the overlap that is (a) a token boundary in both and (b) proven stable: a white-space character
after another kind of character.  No pre-token of the tokenizer's pattern goes on from a character that is no white space
into one that is, whatever stands before or after, and the special strings hold no white space, so the tokens on either
side of such a place do not depend on the other side.  Where an overlap holds no such place it is widened (doubled, to the
end of the text if need be).  Shorter texts are cut at all their stable places, and the library counts each distinct piece
once while a worker remembers it.

Defined cases: null and empty texts have no bytes and no tokens; rows with a null id are counted like all others; rows
are returned as often as they come; other columns of the input, whatever their names, are not returned; an empty table gives
an empty result.
"""

from __future__ import annotations

import json
import os
import re
from bisect import bisect_left, bisect_right
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from .runtime import ship_code, table

CHUNK, OVERLAP, LIMIT = 32_768, 256, 1024  # characters, characters, tokens
#: The white space of the tokenizer's pattern.
WHITE = frozenset("\t\n\x0b\x0c\r \x85\xa0                　")
#: A text cut at all its stable places; the counts of the pieces add up.
PIECE = re.compile(f"[{''.join(sorted(WHITE))}]*[^{''.join(sorted(WHITE))}]+|[{''.join(sorted(WHITE))}]+")
KEPT_BYTES = 96 << 20  # memory, about, of the pieces whose counts a worker keeps


def stable(text: str, at: int) -> bool:
    return 0 < at < len(text) and text[at] in WHITE and text[at - 1] not in WHITE


class _Tokens:
    """Ends and beginnings of a piece's tokens in the text, for the question whether a token straddles a place."""

    def __init__(self, offsets: list[tuple[int, int]], base: int):
        self.begins, self.ends = [base + s for s, _ in offsets], [base + e for _, e in offsets]

    def cut_at(self, place: int) -> bool:
        k = bisect_left(self.begins, place) - 1  # the last token that begins before
        return k < 0 or self.ends[k] <= place

    def before(self, place: int) -> int:
        return bisect_right(self.ends, place)


def _common(text: str, lo: int, hi: int, here: _Tokens, there: _Tokens) -> int | None:
    """The last stable place from lo to hi that is a boundary in both encodings."""
    return next((c for c in range(hi - 1, lo - 1, -1) if stable(text, c) and here.cut_at(c) and there.cut_at(c)), None)


def count_spliced(text: str, encode: Callable[[str], list[tuple[int, int]]], chunk: int = CHUNK, overlap: int = OVERLAP) -> int:
    """Number of tokens of ``text``; ``encode`` gives the offsets of a piece's tokens."""
    counted, begin = 0, 0  # everything before ``begin``, a stable place, is counted
    end = min(len(text), chunk + overlap)
    here = _Tokens(encode(text[:end]), 0)
    while end < len(text):
        wide, cut = overlap, None
        while cut is None:
            lo = max(begin + 1, end - wide)
            ahead = min(len(text), lo + chunk + overlap)
            there = _Tokens(encode(text[lo:ahead]), lo)
            cut = _common(text, lo, end, here, there)
            if cut is None and lo == begin + 1:
                break
            wide *= 2
        if cut is None:  # nothing to hold on to in this chunk: take in more text
            end = min(len(text), begin + 2 * (end - begin))
            here = _Tokens(encode(text[begin:end]), begin)
            continue
        counted += here.before(cut)
        k = bisect_left(there.begins, cut)
        here = _Tokens([], 0)
        here.begins, here.ends = there.begins[k:], there.ends[k:]
        begin, end = cut, ahead
    return counted + len(here.ends)


def byte_level(spec: dict) -> bool:
    """Whether a file (parsed) splits by the rule whose stable places are known, and has no special string with white space."""
    split = spec.get("pre_tokenizer") or {}
    plain = split.get("type") == "ByteLevel" and not split.get("add_prefix_space") and split.get("use_regex", True)
    added = all(WHITE.isdisjoint(t["content"]) and not (t.get("lstrip") or t.get("rstrip") or t.get("single_word") or t.get("normalized")) for t in spec.get("added_tokens") or ())
    model = spec["model"]
    return bool(plain and added and spec.get("normalizer") is None and model.get("type") == "BPE" and not any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges")))


def token_counts(docs: DataFrame, tokenizer_json: str, limit: int = LIMIT, chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit.  ``tokenizer_json``: path, on the driver, of a file of ``tokenizers`` (.json) or
    ``sentencepiece`` (.model).  Where the splitting rule is not the known one, whole texts are encoded."""
    spark = docs.sparkSession
    ship_code(spark)
    kind = os.path.splitext(tokenizer_json)[1]
    if kind not in (".json", ".model"):
        raise ValueError(f"{tokenizer_json}: neither .json nor .model")
    with open(tokenizer_json, "rb") as f:
        model = spark.sparkContext.broadcast(f.read())  # a vocabulary file of fixed size
    cuts = kind == ".json" and byte_level(json.loads(model.value))
    schema = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_tokens", pa.int64()), ("over_limit", pa.bool_())])

    def run(it):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        if kind == ".model":
            from sentencepiece import SentencePieceProcessor

            pieces = SentencePieceProcessor(model_proto=model.value)
            count = lambda many: [len(x) for x in pieces.encode(many, num_threads=1)]
        else:
            from tokenizers import Tokenizer

            t = Tokenizer.from_str(model.value.decode())
            t.no_padding()
            t.no_truncation()
            count = lambda many: [len(e.ids) for e in t.encode_batch_fast(many, add_special_tokens=False)]
        known: dict[str, int] = {}
        kept = 0
        for b in it:
            texts = [x or "" for x in b.column(1).to_pylist()]
            if cuts:
                held = {i: PIECE.findall(x) for i, x in enumerate(texts) if len(x) <= chunk + overlap}
                if kept > KEPT_BYTES:
                    known.clear()
                    kept = 0
                new = list({p for each in held.values() for p in each}.difference(known))
                known.update(zip(new, count(new), strict=True))
                kept += sum(150 + 2 * len(p) for p in new)
                counts = {i: sum(map(known.__getitem__, each)) for i, each in held.items()}
                for i, x in enumerate(texts):
                    if i not in counts:
                        counts[i] = count_spliced(x, lambda piece: t.encode(piece, add_special_tokens=False).offsets, chunk, overlap)
                n = [counts[i] for i in range(len(texts))]
            else:
                n = count(texts)
            yield pa.RecordBatch.from_arrays([b.column(0).cast(pa.int64()), pa.array([len(x.encode()) for x in texts], pa.int64()), pa.array(n, pa.int64()), pa.array([k > limit for k in n], pa.bool_())], schema=schema)

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"), default_tokenizer())
