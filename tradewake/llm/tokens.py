"""Token ids of whole texts with a public tokenizer file, word by word with a memory.

The tokenizer's own pre-tokenizer cuts a text into words that are encoded one by one, so equal words
have equal ids. Words repeat a lot: those of many texts are cut and told apart together as columns,
and each worker lets the library's model encode a word once and keeps the ids. White-space separated
chunks of plain letters, digits and punctuation are cut here as the pre-tokenizer does it; any other
chunk goes to the library whole. Tests compare with whole texts.
"""

from __future__ import annotations

import os
import re
from collections import deque
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa

#: Longer keys are encoded again each time; so many are remembered at most.
LONG_KEY, MOST_KEYS = 64, 500_000
#: Characters of the texts that are cut together; a longer text is cut alone.
TOGETHER = 4 << 20

# The word pattern of the tokenizer file, for ASCII and the Latin-1 letters.
_WORDS = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zà-öø-ÿß]+|[0-9]|[!-/:-@\[-`{-~]+")

# The same for columns of UTF-8 bytes. 0xC3 leads the Latin-1 letters; of the bytes after it 0x97 and
# 0xB7 are the signs \u00d7 and \u00f7. A byte that is none of these makes its chunk a foreign one.
_SPACES = b"\t\n\v\f\r "
_SPACE, _LETTER, _DIGIT, _SIGN, _FOREIGN = range(5)
_KINDS = bytes(
    _SPACE if c in _SPACES else _DIGIT if 0x30 <= c <= 0x39 else
    _LETTER if chr(c).isascii() and chr(c).isalpha() or c == 0xC3
    or 0x80 <= c <= 0xBF and c not in (0x97, 0xB7) else
    _SIGN if 0x21 <= c <= 0x7E else _FOREIGN for c in range(256))
_LOWER = bytes(c + 32 if 0x41 <= c <= 0x5A or 0x80 <= c <= 0x9E else c for c in range(256))


def _words(raw: bytes) -> tuple[np.ndarray, pa.Array]:
    """Words and foreign chunks of UTF-8 in order: where they start, and what they are."""
    data = np.frombuffer(raw, dtype=np.uint8)
    kind = np.frombuffer(raw.translate(_KINDS), dtype=np.uint8)
    lower = raw.translate(_LOWER)
    foreign = kind == _FOREIGN
    if b"<|" in raw:
        foreign[:-1] |= (data[:-1] == ord("<")) & (data[1:] == ord("|"))
    if foreign.any():
        space = kind == _SPACE
        chunk = np.cumsum(space, dtype=np.int32)
        whole = np.zeros(int(chunk[-1]) + 1, dtype=bool)
        whole[chunk[foreign]] = True
        whole = whole[chunk] & ~space
        kind = np.where(whole, np.uint8(_FOREIGN), kind)
        lower = np.where(whole, data, np.frombuffer(lower, dtype=np.uint8)).tobytes()
    start = np.empty(len(data), dtype=bool)
    start[:1] = True
    np.not_equal(kind[1:], kind[:-1], out=start[1:])
    start |= kind == _DIGIT
    start &= kind != _SPACE
    # An apostrophe that no other sign precedes takes 's, 't, 'm, 'd, 're, 've or 'll along.
    at = np.flatnonzero((data == ord("'")) & start & (kind == _SIGN))
    if len(at):
        after = np.frombuffer(lower + b"  ", dtype=np.uint8)
        one, two = after[at + 1], after[at + 2]
        taken = np.where(np.isin(one, list(b"stmd")), 1, np.where(
            (two == ord("e")) & ((one == ord("r")) | (one == ord("v")))
            | (two == ord("l")) & (one == ord("l")), 2, 0))
        at, taken = at[taken > 0], taken[taken > 0]
        start[at + 1] = False
        rest = at + 1 + taken
        rest = rest[rest < len(data)]
        start[rest[kind[rest] == _LETTER]] = True
    starts = np.flatnonzero(start)
    held = lower.translate(None, _SPACES)
    offsets = np.append(starts - np.cumsum(kind == _SPACE, dtype=np.int32)[starts], len(held))
    return starts, pa.Array.from_buffers(
        pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(held)])


class _Known(dict):
    """Ids by word or chunk; one that is missing is encoded, and kept unless it is long."""

    def __init__(self, ids_of: Callable[[str], bytes]):
        super().__init__()
        self.ids_of = ids_of

    def __missing__(self, key: str) -> bytes:
        ids = self.ids_of(key)
        if len(key) <= LONG_KEY:
            if len(self) >= MOST_KEYS:
                self.clear()
            self[key] = ids
        return ids


class Encoder:
    """Ids as little-endian unsigned 32-bit integers."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        most = max(self.tokenizer.get_vocab(with_added_tokens=True).values())
        self.raw = [i.to_bytes(4, "little") for i in range(most + 1)]
        letters = ByteLevel(add_prefix_space=False, use_regex=False)
        #: Accented letters as the model sees their bytes; ASCII stays as it is.
        self.seen_as = {c: letters.pre_tokenize_str(chr(c))[0][0] for c in range(0xDF, 0x100)}
        self.known = _Known(self._ids)

    def _ids(self, key: str) -> bytes:
        ascii = key.isascii()
        if ascii and key.isalpha() or key[:2] != "<|" and _WORDS.fullmatch(key):
            # A word of its own to the pre-tokenizer, so the model alone is left to do.
            word = key if ascii else key.translate(self.seen_as)
            return b"".join([self.raw[t.id] for t in self.model.tokenize(word)])
        found = self.tokenizer.encode_batch_fast([key], add_special_tokens=False)[0]
        return np.array(found.ids, dtype="<u4").tobytes()

    def _together(self, texts: list[bytes]) -> Iterator[bytes]:
        starts, words = _words(b" ".join(texts))
        words = words.dictionary_encode()
        known = self.known
        distinct = words.dictionary.cast(pa.large_string()).to_numpy(zero_copy_only=False)
        ids = pa.array([known[w] for w in distinct.tolist()], pa.large_binary()).take(words.indices)
        _, offsets, data = ids.buffers()
        offsets = np.frombuffer(offsets, dtype=np.int64)[ids.offset:ids.offset + len(ids) + 1]
        ends = np.cumsum([len(t) + 1 for t in texts])
        ends = offsets[np.searchsorted(starts, ends)].tolist()
        data = memoryview(data or b"")
        for at, end in zip([int(offsets[0]), *ends], ends):
            yield bytes(data[at:end])

    def encode(self, texts: Iterable[str | None]) -> Iterator[bytes]:
        held: list[bytes] = []
        size = 0
        for text in texts:
            text = text or ""
            if held and size + len(text) > TOGETHER:
                yield from self._together(held)
                held, size = [], 0
            held.append(text.encode())
            size += len(text) + 1
        if held:
            yield from self._together(held)


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One encoder per worker and file."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def encoded(rows: Iterable[tuple], path: str, end_id: int) -> Iterator[tuple]:
    """``(key, text)`` rows to ``(key, ids)``: ids of the whole text and the end id, as bytes."""
    last = np.array([end_id], dtype="<u4").tobytes()
    keys: deque = deque()

    def texts():
        for key, text in rows:
            keys.append(key)
            yield text

    for ids in encoder(path).encode(texts()):
        yield keys.popleft(), ids + last
