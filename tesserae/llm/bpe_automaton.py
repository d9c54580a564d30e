"""Byte-pair encoding and decoding by a tokenization automaton.

*Token automaton.*  It reads tokens and accepts exactly the sequences that the merges give.  It starts as one state with an
arc for every byte, and every merge, in order of rank, puts in one gadget: for ``u v -> uv`` the target of the ``u`` arcs
becomes a copy without its ``v`` arc (``u`` before ``v`` would have been merged), and an arc ``uv`` leads from where ``u``
started to where ``v`` led *at that moment*.  So the target of an arc depends on its label alone; a state is stored as the
state it was copied from, the rank of the copy, and the arcs that were taken from it, in arrays.

*Byte automaton.*  Read byte by byte, an arc is a path through the trie of the labels.  A set of places on such paths, each
with the state its arc leaves from, is a state of the deterministic automaton.  Every prefix of a word has exactly one
accepted token sequence, so a state names one last token.  Its transitions are a row of the table (an array by bytes, or,
beyond the first ``DENSE`` states, what of it is there); they are compiled when a word first needs them, and at ``STATES``
rows the table is begun anew.

A word is encoded by one walk through the table, a transition for each byte, and read off from its end: the last token of
the whole word, then that of the prefix before it, and so on.  Decoding emits the labels of the arcs.  Words pre-split come
from the pieces of a text between stable places (see ``token_counts``), and the results of pieces and words met before are kept.

Defined cases: null and empty texts have no tokens; rows with a null id are encoded like all others; rows are returned as
often as they come; other columns of the input, whatever their names, are not returned; an empty table gives an empty result;
a file with another normalizer, pre-tokenizer or kind of model raises.
"""

from __future__ import annotations

import hashlib
import json
from array import array

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from .runtime import ship_code, table
from .token_counts import PIECE, WHITE, byte_level, default_tokenizer

STATES, DENSE = 1 << 18, 1 << 12  # rows of the transition table; the first ones, met most, are arrays
KEPT_BYTES, LONGEST_KEPT = 96 << 20, 512  # memory, about, of kept pieces and of kept words; characters of one


def _space_class() -> str:
    return "".join(f"\\u{ord(c):04x}" for c in sorted(WHITE))


def split_pattern() -> str:
    """The tokenizer's pattern for pre-split words, white space spelt out."""
    s = _space_class()
    return rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{s}\p{{L}}\p{{N}}]+|[{s}]+(?![^{s}])|[{s}]+"


def byte_characters() -> dict[str, int]:
    """The characters by which byte-level files write the 256 bytes: printable ones stand for themselves, the others
    follow from 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    out = {chr(b): b for b in plain}
    for k, b in enumerate(b for b in range(256) if b not in set(plain)):
        out[chr(256 + k)] = b
    return out


class TokenAutomaton:
    """States by the token whose arc leads there (0 is the start, token ``t`` leads to ``t + 1``)."""

    def __init__(self, size: int):
        self.copied, self.copied_at = array("i", [0]) * (size + 1), array("i", [-1]) * (size + 1)
        self.left, self.grown_at = array("i", [-1]) * size, array("i", [-1]) * size
        self.taken: list[dict[int, int] | None] = [None] * (size + 1)  # state -> arc -> rank of the gadget that took it away
        self.rank = 0

    def merge(self, u: int, v: int, both: int) -> None:
        """One gadget: the target of ``u`` loses its ``v`` arc; the new arc leads to a copy of what ``v`` led to."""
        if self.taken[u + 1] is None:
            self.taken[u + 1] = {}
        self.taken[u + 1][v] = self.rank
        self.copied[both + 1], self.copied_at[both + 1] = v + 1, self.rank
        self.left[both], self.grown_at[both] = u, self.rank
        self.rank += 1

    def arc(self, state: int, token: int) -> bool:
        """Whether the arc is there: no gadget took it, nor the arc of a left part of it before that was merged on, from the
        state or from those it was copied from, before the copy."""
        if state == 0:
            return True
        part, until = token, self.rank
        while True:
            at, before = state, self.rank
            while True:
                taken = self.taken[at]
                if taken is not None and (rank := taken.get(part, before)) < before and rank <= until:
                    return False
                if self.copied_at[at] < 0:
                    break
                at, before = self.copied[at], self.copied_at[at]
            if self.left[part] < 0:
                return True
            part, until = self.left[part], self.grown_at[part]


class _Sparse(dict):
    """A row of few transitions."""

    def __missing__(self, byte: int) -> int:
        return -1


class Automaton:
    """The deterministic byte automaton of a vocabulary and its merges."""

    def __init__(self, vocab: dict[bytes, int], merges: list[tuple[bytes, bytes]], states: int = STATES):
        if set(range(256)) - {b[0] for b in vocab if len(b) == 1}:
            raise ValueError("a byte-level vocabulary has a token for every byte")
        size = max(vocab.values(), default=-1) + 1
        self.label: dict[int, bytes] = {i: b for b, i in vocab.items()}
        self.tokens = TokenAutomaton(size)
        for u, v in merges:
            self.tokens.merge(vocab[u], vocab[v], vocab[u + v])
        made = {v for m in merges for v in (m[0] + m[1],)}
        # labels as a trie: child of (node, byte), token that ends at a node, whether a node has children
        self.child: dict[int, int] = {}
        self.token, self.inner = array("i", [-1]), array("b", [0])
        for b, i in vocab.items():
            if len(b) > 1 and b not in made:
                continue  # no merge leads there, so no arc has this label
            node = 0
            for x in b:
                key = node << 8 | x
                if key not in self.child:
                    self.child[key] = len(self.token)
                    self.inner[node] = 1
                    self.token.append(-1)
                    self.inner.append(0)
                node = self.child[key]
            self.token[node] = i
        self.size = array("i", [0]) * size
        for i, b in self.label.items():
            self.size[i] = len(b)
        self.states = max(states, 2)
        self._begin()

    def _begin(self) -> None:
        self.rows: list[array | _Sparse] = [array("i", [-1]) * 256]
        self.last = array("i", [-1])  # last token of the sequence that leads to a state
        self.paths: list[tuple[int, ...]] = [(0,)]  # state an arc leaves from, place in the trie (32 bits); without the last one
        self.known: dict[tuple[int, ...], int] = {}

    def _compile(self, state: int, byte: int) -> int:
        """The transition of a state by a byte."""
        on, last, arc, child, token, inner = [], -1, self.tokens.arc, self.child, self.token, self.inner
        for path in self.paths[state]:
            node = child.get((path & 0xFFFFFFFF) << 8 | byte)
            if node is not None:
                q = path >> 32
                if inner[node]:
                    on.append(q << 32 | node)
                if last < 0 and (t := token[node]) >= 0 and arc(q, t):
                    last = t  # one at most: every prefix has one accepted sequence
        on.append(last + 1 << 32)  # the longest path first, a new one last
        key = tuple(on)
        to = self.known.get(key)
        if to is None:
            if len(self.rows) >= self.states:  # begun anew in the middle of a word: the walk goes on from the new state
                self._begin()
                state = None
            to = self.known[key] = len(self.rows)
            self.rows.append(array("i", [-1]) * 256 if to < DENSE else _Sparse())
            self.last.append(last)
            self.paths.append(key)
        if state is not None:
            self.rows[state][byte] = to
        return to

    def encode_word(self, word: bytes) -> list[int]:
        rows, last, state, ends = self.rows, self.last, 0, array("i")
        for x in word:
            to = rows[state][x]
            if to < 0:
                to = self._compile(state, x)
                rows, last = self.rows, self.last
            state = to
            ends.append(last[state])
        out, at, size = [], len(word), self.size
        while at:
            t = ends[at - 1]
            out.append(t)
            at -= size[t]
        out.reverse()
        return out

    def decode(self, ids: list[int]) -> bytes:
        return b"".join([self.label[i] for i in ids])


def load(tokenizer_json: str) -> tuple[Automaton, dict[str, int]]:
    """The automaton of a byte-level BPE file (its content), and its special strings."""
    spec = json.loads(tokenizer_json)
    if not byte_level(spec):
        raise ValueError("byte-level BPE without a normalizer and with its own splitting rule is needed")
    to_byte = byte_characters()
    raw = lambda s: bytes(to_byte[c] for c in s)
    special = {t["content"]: t["id"] for t in spec["added_tokens"]}
    vocab = {raw(t): i for t, i in spec["model"]["vocab"].items() if t not in special}
    merges = [tuple(raw(x) for x in (m.split(" ") if isinstance(m, str) else m)) for m in spec["model"]["merges"]]
    return Automaton(vocab, merges), special


class Encoder:
    """Cuts texts into pieces, special strings and words, and keeps the encodings of the pieces met last."""

    def __init__(self, tokenizer_json: str):
        import regex

        self.automaton, self.special = load(tokenizer_json)
        self.split = regex.compile(split_pattern()).findall
        self.cut = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        self.known: dict[str, bytes] = {}
        self.odd = False  # whether the labels of some piece were not its bytes
        self.words: dict[str, list[int]] = {}
        self.kept = self.kept_words = 0
        for s, i in self.special.items():
            self.automaton.label[i] = s.encode()

    def _piece(self, piece: str) -> bytes:
        """Ids of a piece, in decimal with commas; its arc labels are held against its bytes."""
        ids, words = [], self.words
        for k, part in enumerate(self.cut.split(piece) if self.cut else (piece,)):
            if k % 2:
                ids.append(self.special[part])
                continue
            split = self.split(part)
            if len(split) == 1 and len(part) == len(piece):
                ids = self.automaton.encode_word(piece.encode())  # kept as a piece, not as a word besides
            else:
                for w in split:
                    ids += words.get(w) or self._word(w)
        self.odd |= self.automaton.decode(ids) != piece.encode()
        out = ",".join(map(str, ids)).encode()
        if len(piece) <= LONGEST_KEPT:
            if self.kept > KEPT_BYTES:
                self.known.clear()
                self.kept = 0
            self.known[piece] = out
            self.kept += 150 + 4 * len(piece)
        return out

    def _word(self, word: str) -> list[int]:
        ids = self.automaton.encode_word(word.encode())
        if len(word) <= LONGEST_KEPT:
            if self.kept_words > KEPT_BYTES:
                self.words.clear()
                self.kept_words = 0
            self.words[word] = ids
            self.kept_words += 250 + 5 * len(word)
        return ids

    def pieces(self, text: str) -> list[bytes]:
        known, piece = self.known, self._piece
        return [known.get(p) or piece(p) for p in PIECE.findall(text)]

    def encode(self, text: str) -> list[int]:
        return [int(i) for ids in self.pieces(text) for i in ids.split(b",")]

    def round_trip(self, text: str) -> tuple[bytes, bytes]:
        """Ids in decimal with commas, and the decoded text in UTF-8: the text's own bytes, if those are what the labels of all
        its pieces are, else the labels of its ids."""
        ids = b",".join(self.pieces(text))
        return ids, self.decode([int(i) for i in ids.split(b",") if i]).encode() if self.odd else text.encode()

    def decode(self, ids: list[int]) -> str:
        return self.automaton.decode(ids).decode("utf-8", "replace")


def round_trip(docs: DataFrame, tokenizer_json: str) -> DataFrame:
    """doc_id, n_tokens, SHA-256 of the ids and of the decoded text.  ``tokenizer_json``: path of the file on the driver."""
    spark = docs.sparkSession
    ship_code(spark)
    with open(tokenizer_json, encoding="utf-8") as f:
        model = spark.sparkContext.broadcast(f.read())  # a vocabulary file of fixed size
    schema = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())])

    def run(it):
        encoder = Encoder(model.value)
        sha = hashlib.sha256
        for b in it:
            out = []
            for text in b.column(1).to_pylist():
                ids, decoded = encoder.round_trip(text or "")
                out.append((ids.count(b",") + 1 if ids else 0, sha(ids).hexdigest(), sha(decoded).hexdigest()))
            if out:
                yield pa.RecordBatch.from_arrays([b.column(0).cast(pa.int64()), *(pa.array(c, t) for c, t in zip(zip(*out, strict=True), schema.types[1:], strict=True))], schema=schema)

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(table(spark, sf_dir, "documents"), default_tokenizer())
