"""SentencePiece encoding and decoding with a weighted transducer.

Compilation. The normaliser (white space to the meta symbol, dummy prefix, collapsing where the
model asks for it), the pieces and the byte fallback are compiled from the model file. Composed
with a text they give a lattice: an arc from i to j for each piece that spells the characters i
to j, and for a character that is no piece an arc that emits its bytes. The encoding is the path
of least weight in the tropical semiring.

Weights. In a unigram model an arc weighs the negative score of its piece. In a BPE model
(the kind of the public vocabulary) the arcs weigh nothing, and the lattice is composed with an
acceptor over adjacent pieces: a pair weighs 0 if the merges, best score first and leftmost
first among equals, would leave the boundary between the two pieces alone, and infinity
otherwise. Merges act locally, so exactly one path of finite weight exists and it is the BPE
encoding. Pair weights are compiled when first needed and kept.

No piece continues over the start of white space (checked at compile time), so every path passes
these positions; the text is cut there and the best paths of repeated parts are reused.

Decoding concatenates the pieces' texts, bytes as UTF-8, and takes back the dummy prefix. It
returns the normalised text: a meta symbol written in a text comes back as a blank, as in any
implementation.

Nulls and repeats. A null text has null ids and a null decoded text; an empty one has no ids.
Rows are independent. Very long texts need memory in proportion to their length.
"""

from __future__ import annotations

import hashlib
import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import map_rows, worker_cache

META = "▁"
UNIGRAM, BPE = 1, 2
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
#: Best paths of short parts kept per task; emptied when full.
CACHE, CACHED_LENGTH = 1 << 18, 64
INFINITY = float("inf")


# ---- Model file ---------------------------------------------------------------------------


def _varint(data: bytes, at: int) -> tuple[int, int]:
    value = shift = 0
    while True:
        byte = data[at]
        at += 1
        value |= (byte & 127) << shift
        if byte < 128:
            return value, at
        shift += 7


def _fields(data: bytes):
    """(number, value) of a protocol-buffer message."""
    import struct

    at = 0
    while at < len(data):
        key, at = _varint(data, at)
        kind = key & 7
        if kind == 0:
            value, at = _varint(data, at)
        elif kind == 2:
            size, at = _varint(data, at)
            value, at = data[at : at + size], at + size
        elif kind == 5:
            value, at = struct.unpack("<f", data[at : at + 4])[0], at + 4
        else:
            value, at = data[at : at + 8], at + 8
        yield key >> 3, value


def read_model(data: bytes) -> dict:
    """Pieces, model kind and normaliser flags of a serialized model.

    Field numbers are those of the public model format: pieces 1 (text 1, score 2, type 3),
    trainer 2 (model type 3), normaliser 3 (character map 2, dummy prefix 3, collapse blanks 4,
    escape blanks 5).
    """
    pieces, kind, flags = [], UNIGRAM, {2: b"", 3: 1, 4: 1, 5: 1}
    for number, value in _fields(data):
        if number == 1:
            p = dict(_fields(value))
            pieces.append((p.get(1, b"").decode(), p.get(2, 0.0), p.get(3, NORMAL)))
        elif number == 2:
            kind = dict(_fields(value)).get(3, UNIGRAM)
        elif number == 3:
            flags.update({k: v for k, v in _fields(value) if k in flags})
    if flags[2]:
        raise ValueError("models with a character map are not supported")
    return {"pieces": pieces, "kind": kind, "prefix": bool(flags[3]), "collapse": bool(flags[4]), "escape": bool(flags[5])}


# ---- Transducer ---------------------------------------------------------------------------


class Transducer:
    def __init__(self, model: dict) -> None:
        self.kind, self.model = model["kind"], model
        pieces = model["pieces"]
        self.ids = {t: i for i, (t, _, k) in enumerate(pieces) if k in (NORMAL, USER)}
        self.scores = {t: s for t, s, k in pieces if k in (NORMAL, USER)}
        self.bytes = {int(t[3:-1], 16): i for i, (t, _, k) in enumerate(pieces) if k == BYTE}
        self.unknown = next((i for i, p in enumerate(pieces) if p[2] == UNKNOWN), 0)
        self.longest = max((len(t) for t in self.ids), default=1)
        self.cuts = not any(re.search(f"[^{META}]{META}", t) for t in self.ids)
        self.penalty = 10.0 - min(self.scores.values(), default=0.0)
        self.pairs: dict[int, bool] = {}
        self.paths: dict[str, list[int]] = {}
        self.parts = re.compile(f"{META}*[^{META}]+|{META}+$")
        self.texts = [
            bytes([int(t[3:-1], 16)]) if k == BYTE else b"" if k == CONTROL else t.replace(META, " ").encode()
            for t, _, k in pieces
        ]
        self.trie: dict = {}
        for text, i in self.ids.items():
            if self.kind == BPE and len(text) > 1 and not self._keeps(text, 0):
                continue  # no sequence of merges makes this piece
            node = self.trie
            for c in text:
                node = node.setdefault(c, {})
            node[""] = i

    # normaliser

    def normalised(self, text: str) -> str:
        if self.model["collapse"]:
            text = " ".join(p for p in text.split(" ") if p)
        if not text:
            return ""
        if self.model["prefix"]:
            text = " " + text
        return text.replace(" ", META) if self.model["escape"] else text

    # acceptor over adjacent pieces

    def _keeps(self, text: str, boundary: int) -> bool:
        """Whether merging ``text`` ends with a boundary there and nowhere else (0: nowhere)."""
        ends = list(range(len(text) + 1))
        get = self.scores.get
        while True:
            best, at = -INFINITY, -1
            for i in range(len(ends) - 2):
                score = get(text[ends[i] : ends[i + 2]])
                if score is not None and score > best:
                    best, at = score, i + 1
            if at < 0:
                return ends == ([0, boundary, len(text)] if boundary else [0, len(text)])
            if ends[at] == boundary:
                return False
            del ends[at]

    def _spelling(self, arc: int) -> str:
        return chr(-1 - arc) if arc < 0 else self.model["pieces"][arc][0]

    def _adjacent(self, left: int, right: int) -> bool:
        if len(self.pairs) > 1 << 20:
            self.pairs.clear()
        a, b = self._spelling(left), self._spelling(right)
        known = self.pairs[(left << 32) + right] = self._keeps(a + b, len(a))
        return known

    # composition with a text and shortest path; an arc is a piece id, or -1 - the code point of
    # a character without a piece

    def _arcs_from(self, part: str, start: int) -> list[tuple[int, int]]:
        """(end, arc) of all arcs that leave ``start``, longest last."""
        node = self.trie.get(part[start])
        arcs = [(start + 1, -1 - ord(part[start]) if node is None or "" not in node else node[""])]
        end = start + 1
        while node is not None and end < len(part):
            node = node.get(part[end])
            end += 1
            if node is not None and "" in node:
                arcs.append((end, node[""]))
        return arcs

    def _only_path(self, part: str) -> list[int]:
        """Arcs of the one path of finite weight.

        Depth first, longest arcs first. A position is reached by one prefix path at most, so a
        position that leads nowhere is never tried again.
        """
        n, pairs = len(part), self.pairs
        dead = set()
        ends, path = [0], [0]
        open_arcs = [self._arcs_from(part, 0)]
        while ends[-1] < n:
            arcs, before = open_arcs[-1], path[-1] << 32
            while arcs:
                end, arc = arcs.pop()
                if end in dead:
                    continue
                if len(path) > 1:
                    fits = pairs.get(before + arc)
                    if not (self._adjacent(path[-1], arc) if fits is None else fits):
                        continue
                ends.append(end)
                path.append(arc)
                if end < n:
                    open_arcs.append(self._arcs_from(part, end))
                break
            else:
                dead.add(ends.pop())
                path.pop()
                open_arcs.pop()
        return path[1:]

    def _best_path(self, part: str) -> list[int]:
        """Arcs of the path of least weight, by relaxation in text order."""
        n = len(part)
        cost = [0.0] + [INFINITY] * n
        back: list[tuple[int, int]] = [(0, 0)] * (n + 1)
        for i in range(n):
            for j, arc in self._arcs_from(part, i):
                weight = self.penalty if arc < 0 else -self.scores[self._spelling(arc)]
                if cost[i] + weight < cost[j]:
                    cost[j], back[j] = cost[i] + weight, (i, arc)
        out = []
        while n:
            n, arc = back[n]
            out.append(arc)
        return out[::-1]

    def _path(self, part: str) -> list[int]:
        arcs = self._only_path(part) if self.kind == BPE else self._best_path(part)
        if not arcs or min(arcs) >= 0:
            return arcs
        out: list[int] = []
        for arc in arcs:
            if arc >= 0:
                out.append(arc)
            elif len(self.bytes) == 256:
                out += [self.bytes[b] for b in chr(-1 - arc).encode()]
            else:
                out.append(self.unknown)
        return out

    def encode(self, text: str) -> list[int]:
        text = self.normalised(text)
        if not self.cuts:
            return self._path(text)
        out: list[int] = []
        paths = self.paths
        for part in self.parts.findall(text):
            ids = paths.get(part)
            if ids is None:
                ids = self._path(part)
                if len(part) <= CACHED_LENGTH:
                    if len(paths) >= CACHE:
                        paths.clear()
                    paths[part] = ids
            out += ids
        return out

    def decode(self, ids: list[int]) -> str:
        text = b"".join([self.texts[i] for i in ids]).decode("utf-8", "replace")
        return text[1:] if self.model["prefix"] and text.startswith(" ") else text


# ---- DataFrame operators ------------------------------------------------------------------


def _loaded(model_path: str) -> dict:
    with open(model_path, "rb") as file:
        data = file.read()
    return read_model(data) | {"digest": hashlib.sha256(data).hexdigest()}


def encoded(docs: DataFrame, model_path: str, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns ``keep``, then ids and decoded text of every row."""
    model = _loaded(model_path)
    kept = [docs.schema[c] for c in keep]
    inner = docs.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(keep)], F.col("text").cast("string").alias("text"))

    def make():
        net = worker_cache(f"wfst-{model['digest']}", lambda: Transducer(model))

        def work(columns: list) -> list:
            ids = [None if t is None else net.encode(t) for t in columns[-1]]
            return [*columns[:-1], ids, [None if i is None else net.decode(i) for i in ids]]

        return work

    schema = "".join(f"c{i} {f.dataType.simpleString()}, " for i, f in enumerate(kept))
    out = map_rows(inner, make, schema + "ids array<int>, decoded string")
    return out.toDF(*keep, "ids", "decoded")


def digests(docs: DataFrame, model_path: str) -> DataFrame:
    """doc_id, ids, number of ids and digests of ids and decoded text, for every row."""
    model = _loaded(model_path)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))

    def make():
        net = worker_cache(f"wfst-{model['digest']}", lambda: Transducer(model))
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()

        def work(columns: list) -> list:
            doc_id, texts = columns
            ids = [None if t is None else net.encode(t) for t in texts]
            back = [None if i is None else net.decode(i) for i in ids]
            return [
                doc_id, ids, [None if i is None else len(i) for i in ids],
                [None if i is None else sha(",".join(map(str, i))) for i in ids],
                [None if b is None else sha(b) for b in back],
                [None if t is None else b == t for t, b in zip(texts, back)],
            ]

        return work

    return map_rows(
        rows, make,
        "doc_id bigint, ids array<int>, n_ids bigint, ids_sha256 string, decoded_sha256 string, round_trip boolean",
    )
