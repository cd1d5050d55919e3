"""SentencePiece encoding that keeps the bytes each piece comes from, and decoding."""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from waybill.llm.batches import cut, raw_texts

MODEL = "piece_bpe_32k.model"
#: Normalised text that the library encodes at once, where the vocabulary allows a cut.
STRETCH = 1 << 16
SPACE = "▁".encode()
# Fields of a model file, and kinds of pieces.
PIECE, TRAINER, NORMALISER = 1, 2, 3
UNKNOWN, CONTROL, OWN, BYTE = 2, 3, 4, 6


def _number(raw: bytes, at: int) -> tuple[int, int]:
    value = shift = 0
    while True:
        byte = raw[at]
        at += 1
        value |= (byte & 127) << shift
        if byte < 128:
            return value, at
        shift += 7


def _fields(raw: bytes) -> Iterator[tuple[int, int | bytes, int, int]]:
    """Field number, value and place of each field of a protocol buffer message."""
    at = 0
    while at < len(raw):
        start = at
        key, at = _number(raw, at)
        if key & 7 == 0:
            value, at = _number(raw, at)
        else:
            size, at = _number(raw, at) if key & 7 == 2 else ({1: 8, 5: 4}[key & 7], at)
            value, at = raw[at: at + size], at + size
        yield key >> 3, value, start, at


def _field(number: int, value: bytes | int) -> bytes:
    def varint(n: int) -> bytes:
        return bytes([n & 127 | 128]) + varint(n >> 7) if n > 127 else bytes([n])

    if isinstance(value, int):
        return varint(number << 3) + varint(value)
    return varint(number << 3 | 2) + varint(len(value)) + value


def character_map(compiled: bytes) -> dict[str, bytes]:
    """The rules of a compiled character map: a double-array trie over UTF-8 and a pool of replacements.

    Its nodes are walked level by level, all labels of a level at once.
    """
    if len(compiled) < 4:
        return {}
    size = int.from_bytes(compiled[:4], "little")
    units = np.frombuffer(compiled[4: 4 + size], dtype="<u4").astype(np.int64)
    pool = compiled[4 + size:]
    down = lambda unit: (unit >> 10) << ((unit & 512) >> 6)
    labels = np.arange(1, 256, dtype=np.int64)
    rules = {}
    nodes, keys = down(units[:1]), [b""]
    while len(nodes):
        places = nodes[:, None] ^ labels[None, :]
        inside = places < len(units)
        unit = units[np.where(inside, places, 0)]
        parent, which = np.nonzero(inside & ((unit & 0x800000FF) == labels[None, :]))
        place, unit = places[parent, which], unit[parent, which]
        keys = [keys[p] + bytes([c]) for p, c in zip(parent.tolist(), labels[which].tolist())]
        nodes = place ^ down(unit)
        for i in np.flatnonzero(unit >> 8 & 1).tolist():
            start = int(units[nodes[i]] & 0x7FFFFFFF)
            rules[keys[i].decode()] = pool[start: pool.index(b"\0", start)]
    return rules


class Model:
    """A model file: its normaliser here, its pieces in the library."""

    def __init__(self, proto: bytes):
        import sentencepiece

        spec = trainer = b""
        pieces: list[tuple[bytes, int]] = []
        rest = []
        for number, value, start, end in _fields(proto):
            if number == PIECE:
                own = {k: v for k, v, _, _ in _fields(value)}
                pieces.append((own.get(1, b""), own.get(3, 1)))
            trainer = value if number == TRAINER else trainer
            spec = value if number == NORMALISER else spec
            if number != NORMALISER:
                rest.append(proto[start:end])
        flags = {k: v for k, v, _, _ in _fields(spec)}
        self.prefix, self.squeeze, self.escape = (bool(flags.get(k, 1)) for k in (3, 4, 5))
        self.suffix = bool({k: v for k, v, _, _ in _fields(trainer)}.get(24, 0))
        # A piece that the user defined stays as it is.
        self.kept = {p.decode() for p, kind in pieces if kind == OWN}
        self.rules = character_map(flags.get(2, b""))
        self.longest: dict[str, int] = {}
        for key in [*self.rules, *self.kept]:
            self.longest[key[0]] = max(self.longest.get(key[0], 0), len(key))
        self.starts = re.compile("[" + "".join(map(re.escape, sorted(self.longest))) + "]") if self.longest else None
        # The library gets normalised text and must leave it alone.
        alone = _field(1, b"identity") + _field(2, b"") + _field(3, 0) + _field(4, 0) + _field(5, 0)
        self.inner = sentencepiece.SentencePieceProcessor(model_proto=b"".join(rest) + _field(NORMALISER, alone))
        self.outer = sentencepiece.SentencePieceProcessor(model_proto=proto)
        self.width = np.array([1 if kind == BYTE else 0 if kind == CONTROL else len(p) for p, kind in pieces], dtype=np.int64)
        self.unknown = [i for i, (_, kind) in enumerate(pieces) if kind == UNKNOWN]
        # No merge crosses the front of a space if no piece holds one behind anything else.
        self.cuts = all(kind in (CONTROL, BYTE, UNKNOWN) or SPACE not in p.lstrip(SPACE) for p, kind in pieces)
        self.end = self.outer.eos_id()

    def mapped(self, text: str) -> tuple[bytes, np.ndarray]:
        """The text by the longest rule at each place, and the source byte of each byte of it."""
        out, source = [], []
        at = byte = 0

        def keep(upto: int) -> None:
            nonlocal at, byte
            if upto > at:
                same = text[at:upto].encode()
                out.append(same)
                source.append(np.arange(byte, byte + len(same)))
                at, byte = upto, byte + len(same)

        look = 0
        while self.starts and (found := self.starts.search(text, look)):
            start = found.start()
            tries = [text[start: start + n] for n in range(self.longest[text[start]], 0, -1)]
            own = next((t for t in tries if t in self.kept), None)
            key = own or next((t for t in tries if t in self.rules), None)
            if key is None or own:
                look = start + len(key or " ")
                continue
            keep(start)
            out.append(self.rules[key])
            source.append(np.full(len(self.rules[key]), byte))
            at, byte, look = at + len(key), byte + len(key.encode()), start + len(key)
        keep(len(text))
        return b"".join(out), np.concatenate(source) if source else np.empty(0, dtype=np.int64)

    def normalised(self, text: str) -> tuple[bytes, np.ndarray]:
        """Text as the pieces spell it, and where in the source each of its bytes, and its end, comes from."""
        out, source = self.mapped(text)
        end = len(text.encode())
        raw = np.frombuffer(out, dtype=np.uint8)
        front = 0
        if self.squeeze:
            blank = raw == 32
            keep = ~(blank & np.concatenate(([True], blank[:-1]))[: len(raw)])
            front = int(np.argmax(keep)) if keep.any() else len(raw)
            front = int(source[front]) if front < len(raw) else end
            raw, source = raw[keep], source[keep]
        if not len(raw):
            return b"", np.array([end])
        space = SPACE if self.escape else b" "
        if self.escape:
            source = np.repeat(source, np.where(raw == 32, len(space), 1))
        out = raw.tobytes().replace(b" ", space)
        if self.prefix and not self.suffix:
            out, source = space + out, np.concatenate((np.full(len(space), front), source))
        while self.squeeze and out.endswith(space):
            out, end, source = out[: -len(space)], int(source[-len(space)]), source[: -len(space)]
        if self.prefix and self.suffix:
            out, source = out + space, np.concatenate((source, np.full(len(space), end)))
        return out, np.append(source, end)

    def _stretches(self, text: bytes) -> Iterator[bytes]:
        at = 0
        while self.cuts and len(text) - at > STRETCH:
            to = text.find(SPACE, at + STRETCH)
            while to > 0 and text[to - len(SPACE): to] == SPACE:
                to = text.find(SPACE, to + 1)
            if to < 0:
                break
            yield text[at:to]
            at = to
        yield text[at:]

    def encode(self, text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids and the source bytes of each, from and to; the last is the end id, at the text's end."""
        plain, source = self.normalised(text)
        ids, sizes = [], []
        for part in self._stretches(plain):
            got = self.inner.encode(part.decode(), return_type="numpy")
            size = self.width[got]
            if np.isin(got, self.unknown).any():
                size = np.array([len(p.encode()) for p in self.inner.encode(part.decode(), return_type=str)], dtype=np.int64)
            ids.append(got)
            sizes.append(size)
        edges = source[np.cumsum(np.concatenate([[0], *sizes])).astype(np.int64)]
        all_ids = np.concatenate([*ids, [self.end]]).astype(np.int32)
        last = len(text.encode())
        return all_ids, np.append(edges[:-1], last), np.append(edges[1:], last)

    def decode(self, ids: np.ndarray) -> str:
        return self.outer.decode(ids.tolist())


@lru_cache(maxsize=4)
def model(name: str = MODEL) -> Model:
    """A model of the public tokenizers by name, or any by path; loaded once per worker."""
    import public_tokenizers

    with open(name if "/" in name else public_tokenizers.path(name), "rb") as file:
        return Model(file.read())


def _lists(parts: list[np.ndarray], kind: pa.DataType) -> pa.Array:
    edges = np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(edges), pa.array(np.concatenate(parts), kind))


def encoded(docs: DataFrame, name: str = MODEL, decoded: bool = False) -> DataFrame:
    """Each document's ``text`` as the ``ids`` of its pieces, an end id last, with ``starts`` and ``ends``.

    The text is normalised by the longest rule of the model's compiled character
    map at each place; blanks are squeezed and escaped as the model says. The map
    back to source bytes is kept for every normalised byte, so piece ``i`` comes
    from bytes ``starts[i]`` to ``ends[i]`` of the text's UTF-8. The library merges
    the normalised text by its own vocabulary; the ids are those that it gives for
    the text itself. ``decoded`` adds the text that the library reads back from the ids.

    A null or empty text gives the end id alone. Repeated rows and null ids stay
    as they are; extra columns are left out; an empty table gives no rows. A long
    text is merged in stretches cut in front of spaces, where no piece can reach over.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = model(name)
        for batch in cut(batches, "text", 2 << 20):
            rows = [own.encode(text.decode()) for text in raw_texts(batch, "text")]
            columns = [_lists([r[0] for r in rows], pa.int32()), *(_lists([r[i] for r in rows], pa.int64()) for i in (1, 2))]
            names = ["doc_id", "ids", "starts", "ends"]
            if decoded:
                columns.append(pa.array([own.decode(r[0]) for r in rows], pa.string()))
                names.append("decoded")
            yield pa.record_batch([batch.column("doc_id"), *columns], names=names)

    more = ", decoded string" if decoded else ""
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, ids array<int>, starts array<long>, ends array<long>{more}")
