"""The usual file of a piece model, read and written without a trainer.

The file is one message of tagged fields: the pieces with score and kind, what the trainer was told, and
the normalization as a trie of byte strings in a double array with the texts they turn into.
"""

from __future__ import annotations

import struct
from collections import defaultdict
from collections.abc import Iterator

from pyspark.sql import SparkSession

from corpusloom.operators.pieces import CONTROL, NORMAL, UNKNOWN, UNUSED, USER, PieceModel

# The model type and the field numbers of the messages.
_BPE = 2
_PIECES, _TRAINER, _NORMALIZER = 1, 2, 3
_PIECE, _SCORE, _KIND = 1, 2, 3
_MODEL_TYPE, _VOCAB_SIZE, _WHITESPACE_SUFFIX, _CONTROL_SYMBOLS, _USER_SYMBOLS, _BYTE_FALLBACK = 3, 4, 24, 30, 31, 35
_UNK_ID, _BOS_ID, _EOS_ID, _PAD_ID, _UNK_PIECE, _BOS_PIECE, _EOS_PIECE, _PAD_PIECE = 40, 41, 42, 43, 45, 46, 47, 48
_NAME, _CHARSMAP, _DUMMY_PREFIX, _REMOVE_SPACES, _ESCAPE_SPACES = 1, 2, 3, 4, 5
# The names of the four symbols, by their role.
_ROLES = {"<unk>": (_UNK_ID, _UNK_PIECE), "<s>": (_BOS_ID, _BOS_PIECE), "</s>": (_EOS_ID, _EOS_PIECE), "<pad>": (_PAD_ID, _PAD_PIECE)}


def build_trie(values: dict[bytes, int]) -> list[int]:
    """A double array: the child of a node with base ``b`` by byte ``c`` stands at ``b ^ c``, a value at ``b``."""
    root: dict = {}
    for key, value in values.items():
        node = root
        for c in key:
            node = node.setdefault(c, {})
        node[0] = value
    units, taken, bases = [0] * 512, bytearray(512), set()
    taken[0] = 1
    start, waiting = 1, [(0, 0, root)]
    while waiting:
        at, label, node = waiting.pop()
        labels = sorted(node)
        place = start
        while True:
            if place + 256 > len(units):
                units += [0] * 256
                taken += bytearray(256)
            base = place ^ labels[0]
            if not taken[place] and base and base not in bases and not any(taken[base ^ c] for c in labels):
                break
            place += 1
        # Only the last places are searched; what is free before them is given up.
        start = max(start, place - 128)
        bases.add(base)
        units[at] = label | (256 if 0 in node else 0) | (at ^ base) << 10
        for c in labels:
            taken[base ^ c] = 1
            if c:
                waiting.append((base ^ c, c, node[c]))
            else:
                units[base] = node[0] | 1 << 31
    return units


def trie_entries(units: list[int]) -> Iterator[tuple[bytes, int]]:
    """The keys and values of a double array."""
    children = defaultdict(list)
    for at, unit in enumerate(units):
        # Values carry the highest bit and have no label.
        if 0 < unit & (1 << 31 | 255) < 256:
            children[at ^ unit & 255].append(at)
    waiting = [(b"", 0)]
    while waiting:
        key, at = waiting.pop()
        unit = units[at]
        base = at ^ (unit >> 10) << ((unit & 1 << 9) >> 6)
        if unit >> 8 & 1:
            yield key, units[base] & (1 << 31) - 1
        waiting += [(key + bytes([units[child] & 255]), child) for child in children[base]]


def charsmap(rules: dict[str, str]) -> bytes:
    """The normalization rules as the file holds them; none is an empty map."""
    if not rules:
        return b""
    texts, places = bytearray(), {}
    for made in dict.fromkeys(rules.values()):
        places[made] = len(texts)
        texts += made.encode() + b"\0"
    units = build_trie({key.encode(): places[made] for key, made in rules.items()})
    trie = struct.pack(f"<{len(units)}I", *units)
    return struct.pack("<I", len(trie)) + trie + bytes(texts)


def charsmap_rules(data: bytes) -> dict[str, str]:
    if not data:
        return {}
    (size,) = struct.unpack_from("<I", data)
    units = list(struct.unpack_from(f"<{size // 4}I", data, 4))
    texts = data[4 + size :]
    return {key.decode(): texts[at : texts.index(b"\0", at)].decode() for key, at in trie_entries(units)}


def _varint(n: int) -> bytes:
    out = bytearray()
    n &= (1 << 64) - 1
    while n > 127:
        out.append(n & 127 | 128)
        n >>= 7
    out.append(n)
    return bytes(out)


def _field(number: int, value) -> bytes:
    if isinstance(value, float):
        return _varint(number << 3 | 5) + struct.pack("<f", value)
    if isinstance(value, int):
        return _varint(number << 3) + _varint(value)
    data = value.encode() if isinstance(value, str) else value
    return _varint(number << 3 | 2) + _varint(len(data)) + data


def _fields(data: bytes) -> Iterator[tuple[int, object]]:
    def varint() -> int:
        nonlocal at
        n = shift = 0
        while True:
            byte = data[at]
            at += 1
            n |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return n

    at = 0
    while at < len(data):
        tag = varint()
        kind = tag & 7
        if kind == 0:
            yield tag >> 3, varint()
            continue
        if kind not in (1, 2, 5):
            raise ValueError(f"not a piece model: field of kind {kind}")
        size = {1: 8, 5: 4}.get(kind) or varint()
        if at + size > len(data):
            raise ValueError("not a piece model: it ends inside a field")
        yield tag >> 3, struct.unpack_from("<f", data, at)[0] if kind == 5 else data[at : at + size]
        at += size


def model_bytes(model: PieceModel) -> bytes:
    """The model as the usual single file."""
    out = bytearray()
    trainer = _field(_MODEL_TYPE, _BPE) + _field(_VOCAB_SIZE, len(model.pieces)) + _field(_BYTE_FALLBACK, int(model.byte_fallback))
    for i, (piece, score, kind) in enumerate(zip(model.pieces, model.piece_scores(), model.piece_kinds())):
        out += _field(_PIECES, _field(_PIECE, piece) + _field(_SCORE, float(score)) + _field(_KIND, kind))
        if piece in _ROLES and kind in (CONTROL, UNKNOWN):
            id_field, name_field = _ROLES[piece]
            trainer += _field(id_field, i) + _field(name_field, piece)
        elif kind == CONTROL:
            trainer += _field(_CONTROL_SYMBOLS, piece)
        elif kind == USER:
            trainer += _field(_USER_SYMBOLS, piece)
    for piece, (id_field, _) in _ROLES.items():
        if piece not in model.pieces:
            trainer += _field(id_field, -1)
    rules = model.normalization()
    normal = _field(_NAME, "nmt_nfkc" if rules else "identity") + _field(_CHARSMAP, charsmap(rules))
    normal += _field(_DUMMY_PREFIX, int(model.add_dummy_prefix)) + _field(_REMOVE_SPACES, int(model.remove_extra_whitespaces))
    return bytes(out) + _field(_TRAINER, trainer) + _field(_NORMALIZER, normal + _field(_ESCAPE_SPACES, 1))


def model_from_bytes(data: bytes) -> PieceModel:
    """A byte-pair piece model from its file, whoever has written it."""
    pieces, scores, kinds = [], [], []
    trainer, normal = {}, {}
    for number, value in _fields(data):
        if number == _PIECES:
            entry = dict(_fields(value))
            pieces.append(entry.get(_PIECE, b"").decode())
            scores.append(entry.get(_SCORE, 0.0))
            kinds.append(entry.get(_KIND, NORMAL))
        elif number == _TRAINER:
            trainer = dict(_fields(value))
        elif number == _NORMALIZER:
            normal = dict(_fields(value))
    if trainer.get(_MODEL_TYPE, 1) != _BPE:
        raise ValueError("only byte-pair piece models are read")
    if UNUSED in kinds or trainer.get(_WHITESPACE_SUFFIX, 0) or not normal.get(_ESCAPE_SPACES, 1):
        raise ValueError("unused pieces, spaces as suffixes and plain spaces are not supported")
    chosen = lambda *kind: tuple(p for p, k in zip(pieces, kinds) if k in kind)
    return PieceModel(
        tuple(pieces), sum(k == NORMAL and len(p) > 1 for p, k in zip(pieces, kinds)), chosen(CONTROL, UNKNOWN), chosen(USER),
        bool(trainer.get(_BYTE_FALLBACK, 0)), bool(normal.get(_DUMMY_PREFIX, 1)), bool(normal.get(_REMOVE_SPACES, 1)),
        tuple(scores), tuple(kinds), tuple(charsmap_rules(normal.get(_CHARSMAP, b"")).items()),
    )


def save_piece_model(model: PieceModel, spark: SparkSession, path: str, overwrite: bool = False) -> None:
    """Write the file to any storage that the session reaches."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    out = target.getFileSystem(spark._jsc.hadoopConfiguration()).create(target, overwrite)
    try:
        out.write(bytearray(model_bytes(model)))
    finally:
        out.close()


def load_piece_model(spark: SparkSession, path: str) -> PieceModel:
    return model_from_bytes(bytes(spark.read.format("binaryFile").load(path).first()["content"]))
