"""Whole-text encoding with the tokenizers library, for use inside Spark tasks.

A text is cut where a space stands between two characters that are no white space. A byte-level
pre-tokeniser always ends one piece before such a space and begins the next with it, so the chunks
encode independently and a chunk that was seen before need not be encoded again. Arrow cuts the
texts of a batch, finds the distinct chunks, cuts those again where a run of letters meets a sign or
a line begins, and looks up the pieces; the library encodes those met for the first time, many to a
call. Texts that cannot be cut this way, and all texts under any other tokeniser set-up, are encoded
whole.

An empty or null text has no ids. Special tokens' strings are read as the library does by default.
"""

from __future__ import annotations

import ctypes
import json
import os
from collections.abc import Iterator, Sequence
from functools import cache, lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

END_ID = 0
# Pieces that a worker keeps, if they have at most so many bytes. Changes time and memory, never results.
KEEP = 700_000
_LONGEST = 256
# Bytes of text handled at once; a longer text is handled alone.
BATCH_BYTES = 8 << 20
_JOIN = 256
_CUT = "\x00"
# White space by any rule set, and invisible characters that some of them count as such.
_SPACES = frozenset(chr(c) for c in range(0x3100) if chr(c).isspace()) | frozenset(
    map(chr, (0x00, 0x180E, 0x200B, 0x200C, 0x200D, 0x2060, 0xFEFF))
)

_CLASS = "[" + "".join(f"\\x{{{ord(c):x}}}" for c in sorted(_SPACES)) + "]"
# Chunks before or after which the text must not be cut.
_ODD = f"{_CLASS}$|^ {_CLASS}"
# A run of letters ends before a sign, and either ends before a line feed. These are letters by any
# version of Unicode.
_LETTERS = "A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f"
_SIGNS = ".,;:!?#$%&*"
_CUTS = (f"([{_LETTERS}])([{_SIGNS}])", f"([{_LETTERS}{_SIGNS}])(\n)")
# Pieces whose first token alone begins with a space or a line feed.
_HEADED = "^[ \n][^ \n]*$"


@cache
def _trim():
    """The C library's call that returns freed memory to the system, where there is one."""
    try:
        return ctypes.CDLL(None).malloc_trim
    except (OSError, AttributeError, TypeError):
        return lambda _: 0


def _hand_back() -> None:
    """Return what a part took; Python workers live on through other stages."""
    pa.default_memory_pool().release_unused()
    _trim()(0)


def slices(texts: pa.Array) -> Iterator[pa.Array]:
    """Consecutive parts of about ``BATCH_BYTES``."""
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
    if not len(sizes):
        return
    part = np.cumsum(sizes) // BATCH_BYTES
    edges = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(sizes)]
    for low, high in zip(edges, edges[1:]):
        yield texts.slice(low, high - low)
        _hand_back()


class Memo(dict):
    """Keeps about ``size`` entries: those asked for again since the memo was last half full, and
    newer ones."""

    def __init__(self, size: int):
        super().__init__()
        self.half, self.old = size // 2, {}

    def look_up(self, keys: Sequence[str]) -> list[bytes | None]:
        """Values of ``keys``, ``None`` where there is none."""
        if len(self) > self.half:
            self.old = dict(self)
            self.clear()
        found = list(map(self.get, keys))
        if self.old:
            missing = [k for k, value in enumerate(found) if value is None]
            again = list(map(self.old.get, [keys[k] for k in missing]))
            for k, value in zip(missing, again):
                if value is not None:
                    found[k] = self[keys[k]] = value
        return found


class Codes:
    """As ``Memo``, in Arrow arrays and for whole arrays of keys."""

    def __init__(self, size: int):
        self.half, self.young = size // 2, 0
        # The young ones first.
        self.keys, self.values = pa.array([], pa.large_string()), pa.array([], pa.large_binary())

    def look_up(self, keys: pa.Array) -> pa.Array:
        """Values of ``keys``, null where there is none."""
        if self.young > self.half:
            self.keys, self.values, self.young = self.keys[: self.young], self.values[: self.young], 0
        at = pc.index_in(keys, value_set=self.keys)
        found = self.values.take(at)
        again = pc.greater_equal(at, self.young)
        self.add(keys.filter(again), found.filter(again))
        return found

    def add(self, keys: pa.Array, values: pa.Array) -> None:
        self.keys = pa.concat_arrays([keys, self.keys])
        self.values = pa.concat_arrays([values, self.values])
        self.young += len(keys)


def _binary(ends: np.ndarray, flat: np.ndarray, width: int) -> pa.Array:
    """The bytes of ``flat`` from each of ``ends``, counted in ``width`` bytes, to the next."""
    offsets = pa.py_buffer(ends.astype(np.int64) * width)
    return pa.Array.from_buffers(pa.large_binary(), len(ends) - 1, [None, offsets, pa.py_buffer(flat)])


@lru_cache(maxsize=4)
def encoder(path: str, spans: bool = False, keep: int = KEEP) -> Encoder:
    return Encoder(path, spans, keep)


class Encoder:
    """``ids``: per text its ids, unsigned 32-bit. ``spans`` (of an encoder made with
    ``spans=True``): per text the character starts and ends of its tokens."""

    def __init__(self, path: str, spans: bool = False, keep: int = KEEP):
        # A task has one core.
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        setup = json.loads(self.tokenizer.to_str())
        pre = setup.get("pre_tokenizer") or {}
        added = setup.get("added_tokens") or []
        apart = set(" \n\u0120\u010a" + _SIGNS)
        self.local = (
            not setup.get("normalizer")
            and not any(t["lstrip"] or t["rstrip"] or apart & set(t["content"]) for t in added)
            and pre.get("type") == "ByteLevel"
            and not pre.get("add_prefix_space")
            and pre.get("use_regex", True)
        )
        self.with_spans = spans
        self.vocab_size = self.tokenizer.get_vocab_size()
        self.known = Codes(keep)
        self.width = 8 if spans else 4
        # Tokens that begin with a space or a line feed.
        vocab = self.tokenizer.get_vocab()
        self.heads = np.zeros(1 + max(vocab.values(), default=0), bool)
        self.heads[[k for t, k in vocab.items() if t.startswith(("\u0120", "\u010a"))]] = True

    def _whole(self, texts: Sequence[str]) -> list[bytes]:
        run = self.tokenizer.encode_batch if self.with_spans else self.tokenizer.encode_batch_fast
        found = run(list(texts), add_special_tokens=False)
        return [np.asarray(e.offsets if self.with_spans else e.ids, "<u4").tobytes() for e in found]

    def _encode(self, new: pa.Array) -> pa.Array:
        """Values of ``new`` pieces."""
        headed = pc.match_substring_regex(new, _HEADED)
        follow, single = new.filter(headed), new.filter(pc.invert(headed))
        many = self._by_offsets(follow) if self.with_spans else self._by_heads(follow)
        if many is None:
            many = pa.array(self._whole(follow.to_pylist()), pa.large_binary())
        one = pa.array(self._whole(single.to_pylist()), pa.large_binary())
        is_head = headed.to_numpy(zero_copy_only=False)
        place = np.where(is_head, np.cumsum(is_head) - 1, len(follow) + np.cumsum(~is_head) - 1)
        return pa.concat_arrays([many, one]).take(pa.array(place))

    def _joined(self, follow: pa.Array) -> list[str]:
        # Many times faster than to_pylist, which makes a scalar of each.
        names = follow.to_numpy(zero_copy_only=False).tolist()
        return ["".join(names[k : k + _JOIN]) for k in range(0, len(names), _JOIN)]

    def _by_heads(self, follow: pa.Array) -> pa.Array | None:
        """Each piece begins where a token begins with a space or a line feed. None if the
        vocabulary has no such token for some."""
        found = self.tokenizer.encode_batch_fast(self._joined(follow), add_special_tokens=False)
        ids = np.concatenate([np.zeros(0, "<u4"), *(np.asarray(e.ids, "<u4") for e in found)])
        starts = np.flatnonzero(self.heads[ids])
        return _binary(np.append(starts, len(ids)), ids, 4) if len(starts) == len(follow) else None

    def _by_offsets(self, follow: pa.Array) -> pa.Array:
        """Spans of each piece, from the spans of many."""
        ends, parts = [np.zeros(1, np.int64)], [np.zeros((0, 2), "<u4")]
        for k, text in enumerate(self._joined(follow)):
            (encoded,) = self.tokenizer.encode_batch([text], add_special_tokens=False)
            offsets = np.asarray(encoded.offsets, dtype=np.int64).reshape(-1, 2)
            sizes = pc.utf8_length(follow[k * _JOIN : (k + 1) * _JOIN]).to_numpy()
            starts = np.cumsum(sizes) - sizes
            owner = np.searchsorted(starts, offsets[:, 0], "right") - 1
            ends.append(ends[-1][-1] + np.cumsum(np.bincount(owner, minlength=len(sizes))))
            parts.append((offsets - starts[owner, None]).astype("<u4"))
        return _binary(np.concatenate(ends), np.concatenate(parts), 8)

    def _values(self, names: pa.Array) -> pa.Array:
        """Values of distinct chunks, each from the values of its pieces."""
        for between in _CUTS:
            names = pc.replace_substring_regex(names, between, f"\\1{_CUT}\\2")
        cut = pc.split_pattern(names, _CUT)
        coded = cut.flatten().dictionary_encode()
        pieces = coded.dictionary
        values = self.known.look_up(pieces)
        if values.null_count:
            new = pieces.filter(values.is_null())
            learned = self._encode(new)
            values = pc.replace_with_mask(values, values.is_null(), learned)
            short = pc.less_equal(pc.binary_length(new), _LONGEST)
            self.known.add(new.filter(short), learned.filter(short))
        ends, flat = self._end_to_end(pieces, values, coded.indices, cut.offsets.to_numpy())
        return _binary(ends, flat.astype("<u4"), self.width)

    def _end_to_end(self, names: pa.Array, values: pa.Array, places: pa.Array, edges: np.ndarray):
        """The values of the ``places`` of ``names``, one after another, and how many of them there
        are before each of ``edges``. Spans count from the edge before them."""
        flat = np.frombuffer(values.take(places).buffers()[2] or b"", "<u4")
        places = places.to_numpy()
        counts = (pc.binary_length(values).to_numpy() // self.width)[places]
        ends = np.concatenate([[0], np.cumsum(counts)])
        if self.with_spans:
            sizes = pc.utf8_length(names).to_numpy().astype(np.int64)[places]
            base = np.cumsum(sizes) - sizes
            owner_base = np.repeat(np.append(base, 0)[np.minimum(edges[:-1], len(base))], np.diff(edges))
            flat = flat[: 2 * ends[-1]].astype(np.int64).reshape(-1, 2)
            flat = flat + np.repeat(base - owner_base, counts)[:, None]
        return ends[edges], flat

    def _batch(self, texts: pa.Array) -> list[np.ndarray]:
        texts = pc.fill_null(texts, "")
        if not self.local:
            return self._finish(self._whole(texts.to_pylist()))
        alone = pc.match_substring(texts, _CUT).to_numpy(zero_copy_only=False)
        marked = pc.replace_substring(texts, " ", _CUT + " ")
        chunks = pc.split_pattern(marked, _CUT)
        edges = chunks.offsets.to_numpy().astype(np.int64)
        coded = chunks.flatten().dictionary_encode()
        names = coded.dictionary.cast(pa.large_string())
        odd = pc.match_substring_regex(names, _ODD)
        if pc.any(odd).as_py():
            # Count of odd chunks in each text: those are encoded whole.
            before = np.concatenate([[0], np.cumsum(odd.to_numpy(zero_copy_only=False)[coded.indices.to_numpy()])])
            alone = alone | (before[edges[1:]] > before[edges[:-1]])
            names = pc.if_else(odd, pa.scalar("", names.type), names)
        cut, flat = self._end_to_end(names, self._values(names), coded.indices, edges)
        out = [flat[a:b] for a, b in zip(cut[:-1], cut[1:])]
        whole = np.flatnonzero(alone)
        again = self._finish(self._whole(texts.take(pa.array(whole)).to_pylist())) if len(whole) else []
        for k, x in zip(whole.tolist(), again):
            out[k] = x
        return out

    def _finish(self, packed: list[bytes]) -> list[np.ndarray]:
        flat = [np.frombuffer(b, "<u4") for b in packed]
        return [x.astype(np.int64).reshape(-1, 2) for x in flat] if self.with_spans else flat

    def run(self, texts: pa.Array) -> Iterator[np.ndarray]:
        """Ids or spans of each text, in order."""
        for part in slices(texts):
            yield from self._batch(part)
