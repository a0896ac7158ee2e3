"""SentencePiece BPE in vectorised merge rounds, and decoding.

Only the vocabulary comes from the model; merging is done here. A text becomes words: runs of
spaces with what follows them, since no piece has a space after another character. The distinct
words of a batch lie end to end in one array of symbols. Each round finds the best pair of every
word by a segmented minimum, merges it at all its places from the left at once, and closes the
gaps; words without a pair leave. Where a merge would open a pair that is as good or better, the
order of single merges matters, and only the leftmost place of that word is merged. A long word is
first cut where no piece of the vocabulary can reach over, by up to two characters on either side:
merges never cross such a place, so its sections are merged side by side like words.

Characters without a piece become the pieces of their bytes. Decoding joins the bytes of pieces and
drops the space that was put before the text.

Defined cases: a null or empty text has no ids and decodes to an empty text; repeated rows give
repeated results; an empty table gives an empty result. Only the id and the text are read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from layerloom.llm.byte_bpe import Memo, slices

MARK = "▁"
# Words that a worker keeps. Changes time and memory, never results.
KEEP = 700_000
# Words of more characters are cut into sections. Changes time, never results.
LONG = 64
DIGESTS = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
_CUT = "\x00"
_NONE = np.iinfo(np.int64).max


@lru_cache(maxsize=2)
def codec(model: str) -> PieceCodec:
    return PieceCodec(model)


class PieceCodec:
    def __init__(self, model: str):
        from sentencepiece import SentencePieceProcessor

        sp = SentencePieceProcessor(model_file=model)
        n = sp.get_piece_size()
        names = [sp.id_to_piece(i) for i in range(n)]
        plain = [i for i in range(n) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i))]
        if any(sp.is_unused(i) or MARK in names[i].lstrip(MARK) for i in plain):
            raise ValueError("models with unused pieces, or with a space inside a piece, are not supported")
        if sp.normalize(" A  ﬁ\n ") != f"{MARK}{MARK}A{MARK}{MARK}ﬁ\n{MARK}":
            raise ValueError("only the identity normalisation with a leading space is supported")
        self.n = n
        ids = {names[i]: i for i in plain}
        scores = {i: -sp.get_score(i) for i in plain}
        order = {s: k for k, s in enumerate(sorted(set(scores.values())))}
        self.rank = np.full(n, _NONE)
        for i in plain:
            self.rank[i] = order[scores[i]]
        symbol = lambda s: ids.get(s, n + ord(s) if len(s) == 1 else None)
        pairs = {}
        for name, i in ids.items():
            for k in range(1, len(name)):
                left, right = symbol(name[:k]), symbol(name[k:])
                if left is not None and right is not None:
                    pairs[left << 21 | right] = i
        self.keys = np.fromiter(sorted(pairs), np.int64, len(pairs))
        self.merged = np.fromiter((pairs[k] for k in sorted(pairs)), np.int64, len(pairs))
        self.char = np.arange(0x110000, dtype=np.int64) + n
        for name, i in ids.items():
            if len(name) == 1:
                self.char[ord(name)] = i
        self.letters = np.array(sorted({ord(c) for name in ids for c in name}), np.int64)
        if len(self.letters) >= 1 << 15:
            raise ValueError("models with 32,768 or more different characters are not supported")
        self.crossings = self._crossings(ids)
        self.byte = np.zeros(256, np.int64)
        surface = [x.replace(MARK, " ").encode() for x in names]
        for i in range(n):
            if sp.is_byte(i):
                value = int(names[i][3:5], 16)
                self.byte[value], surface[i] = i, bytes([value])
            elif sp.is_control(i):
                surface[i] = b""
            elif sp.is_unknown(i):
                surface[i] = sp.decode([i]).encode()
        self.surface = pa.array(surface, pa.large_binary())
        self.decimal = pa.array([f"{i},".encode() for i in range(n)], pa.large_binary())
        self.known = Memo(KEEP)

    def _pairs(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and merged symbol of each pair."""
        keys = left << 21 | right
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        merged = np.where(self.keys[at] == keys, self.merged[at], -1)
        return np.where(merged >= 0, self.rank[merged], _NONE), merged

    def _letters(self, points: np.ndarray) -> np.ndarray:
        """Small numbers of characters from 1, 0 for those that no piece has."""
        points = points.astype(np.int64)
        at = np.minimum(np.searchsorted(self.letters, points), len(self.letters) - 1)
        return np.where(self.letters[at] == points, at + 1, 0)

    def _crossings(self, names: Iterable[str]) -> dict[tuple[int, int], np.ndarray]:
        """Sorted keys of what stands around the inner places of all pieces: one character to the
        left or right where the piece ends there, else two."""
        keys: dict[tuple[int, int], set[int]] = {(a, b): set() for a in (1, 2) for b in (1, 2)}
        for name in names:
            codes = self._letters(np.array([ord(c) for c in name])).tolist()
            for k in range(1, len(codes)):
                left, right = min(k, 2), min(len(codes) - k, 2)
                key = 0
                for c in codes[k - left : k + right]:
                    key = key << 15 | c
                keys[left, right].add(key)
        return {sides: np.array(sorted(found), np.int64) for sides, found in keys.items()}

    def _sections(self, points: np.ndarray, word: np.ndarray) -> np.ndarray:
        """Number of the section of each character: a new one at each word and at each place that no
        piece reaches over."""
        code, n = self._letters(points), len(points)
        starts = np.append(True, word[1:] != word[:-1])
        open_ = np.zeros(n, bool)  # a piece may reach over the place before this character
        for (left, right), keys in self.crossings.items():
            if not len(keys) or n < left + right:
                continue
            m = n - left - right + 1
            key, whole = np.zeros(m, np.int64), np.ones(m, bool)
            for k in range(left + right):
                key = key << 15 | code[k : k + m]
                if k:
                    whole &= ~starts[k : k + m]
            at = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
            open_[left : left + m] |= whole & (keys[at] == key)
        return np.cumsum(starts | ~open_) - 1

    def _merge(self, symbols: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Final symbols with their words, in order."""
        done_symbols, done_words = [], []
        while len(symbols):
            rank, merged = self._pairs(symbols, np.append(symbols[1:], 0))
            first = np.flatnonzero(np.append(True, word[1:] != word[:-1]))
            rank[np.append(first[1:], len(word)) - 1] = _NONE
            best = np.minimum.reduceat(rank, first)
            sizes = np.diff(np.append(first, len(word)))
            lasting = np.repeat(best < _NONE, sizes)
            if not lasting.all():
                done_symbols.append(symbols[~lasting])
                done_words.append(word[~lasting])
                symbols, word, rank, merged = symbols[lasting], word[lasting], rank[lasting], merged[lasting]
                best, sizes = best[best < _NONE], sizes[best < _NONE]
                if not len(symbols):
                    break
            segment = np.repeat(np.arange(len(sizes)), sizes)
            chosen = rank == best[segment]
            # Of overlapping places take every second one from the left.
            opens = chosen & ~np.append(False, chosen[:-1])
            run = np.maximum.accumulate(np.where(opens, np.arange(len(chosen)), 0))
            chosen &= (np.arange(len(chosen)) - run) % 2 == 0
            at = np.flatnonzero(chosen)
            several = np.bincount(segment[at], minlength=len(sizes)) > 1
            if several.any():
                at = at[~self._late(at, several, symbols, merged, segment, best)]
            symbols[at] = merged[at]
            keep = np.ones(len(symbols), bool)
            keep[at + 1] = False
            symbols, word = symbols[keep], word[keep]
        symbols = np.concatenate([*done_symbols, symbols]) if done_symbols else symbols
        word = np.concatenate([*done_words, word]) if done_words else word
        order = np.argsort(word, kind="stable")
        return symbols[order], word[order]

    def _late(self, at, several, symbols, merged, segment, best) -> np.ndarray:
        """Places that must wait for another round: not the leftmost of a word where one of the
        merges opens a pair as good as the merged one."""
        many = several[segment[at]]
        x = at[many]
        seg, new, n = segment[x], merged[x], len(symbols)
        worst = best[seg]
        bad = np.zeros(len(x), bool)
        after, before = np.minimum(x + 2, n - 1), np.maximum(x - 1, 0)
        has_after = (x + 2 < n) & (segment[after] == seg)
        has_before = (x > 0) & (segment[before] == seg)
        bad |= has_after & (self._pairs(new, symbols[after])[0] <= worst)
        bad |= has_before & (self._pairs(symbols[before], new)[0] <= worst)
        twin = np.append(x[1:] == x[:-1] + 2, False) & has_after
        bad |= twin & (self._pairs(new, np.append(new[1:], 0))[0] <= worst)
        slow = np.zeros(len(several), bool)
        slow[seg[bad]] = True
        leftmost = np.append(True, segment[at][1:] != segment[at][:-1])
        return slow[segment[at]] & ~leftmost

    def _learn(self, words: list[str]) -> None:
        if not words:
            return
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        points = np.frombuffer("".join(words).replace(" ", MARK).encode("utf-32-le"), "<u4")
        word = np.repeat(np.arange(len(words)), sizes)
        if sizes.max() > LONG:
            section = self._sections(points, word)
            of = word[np.flatnonzero(np.append(True, section[1:] != section[:-1]))]
            symbols, section = self._merge(self.char[points], section)
            word = of[section]
        else:
            symbols, word = self._merge(self.char[points], word)
        odd = np.flatnonzero(symbols >= self.n)
        if len(odd):
            # Characters without a piece: the pieces of their bytes.
            spelled = [self.byte[list(chr(p).encode())] for p in (symbols[odd] - self.n).tolist()]
            counts = np.ones(len(symbols), np.int64)
            counts[odd] = [len(s) for s in spelled]
            word, whole = np.repeat(word, counts), np.repeat(symbols, counts)
            whole[np.repeat(symbols >= self.n, counts)] = np.concatenate(spelled)
            symbols = whole
        flat = symbols.astype("<u4").tobytes()
        ends = np.cumsum(np.bincount(word, minlength=len(words))) * 4
        at = 0
        for name, end in zip(words, ends.tolist()):
            self.known[name] = flat[at:end]
            at = end

    def _words(self, texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
        """All words of all texts, and where each text's words begin."""
        plain = pc.replace_substring(texts, MARK, " ")
        marked = pc.binary_join_element_wise(pa.scalar(" "), plain, "")
        odd = pc.or_(pc.match_substring(marked, "  "), pc.match_substring(marked, _CUT))
        # The first cut of each text is before its leading space.
        chunks = pc.split_pattern(pc.replace_substring(marked, " ", _CUT + " "), _CUT)
        words, edges = chunks.flatten(), chunks.offsets.to_numpy().astype(np.int64)
        empty = pc.equal(plain, "")
        special = np.flatnonzero(pc.or_(odd, empty).to_numpy(zero_copy_only=False))
        if not len(special):
            return words, edges
        lists = []
        at = 0
        for k in special.tolist():
            lists.append(words.slice(edges[at], edges[k] - edges[at]))
            text = marked[k].as_py()
            lists.append(pa.array(re.findall(" +[^ ]*", text) if len(text) > 1 else [], pa.string()))
            at = k + 1
        lists.append(words.slice(edges[at]))
        sizes = np.diff(edges)
        sizes[special] = [len(x) for x in lists[1::2]]
        return pa.concat_arrays(lists), np.concatenate([[0], np.cumsum(sizes)])

    def encode(self, texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """For parts of ``texts``: all ids end to end, and where each text's ids begin and end."""
        for part in slices(texts):
            words, edges = self._words(pc.fill_null(part, "").cast(pa.string()))
            coded = words.dictionary_encode()
            names = coded.dictionary.to_pylist()
            packed = self.known.look_up(names)
            self._learn([w for w, p in zip(names, packed) if w and p is None])
            get = self.known.get
            packed = [get(w, b"") if p is None else p for w, p in zip(names, packed)]
            counts = np.fromiter(map(len, packed), np.int64, len(packed)) // 4
            ends = np.concatenate([[0], np.cumsum(counts[coded.indices.to_numpy()])])
            flat = pa.array(packed, pa.large_binary()).take(coded.indices).buffers()[2]
            yield np.frombuffer(flat or b"", "<u4")[: ends[-1]], ends[edges]

    def spell(self, table: pa.Array, ids: np.ndarray, edges: np.ndarray) -> Iterator[bytes]:
        """The bytes of each text's ids by ``table``, end to end."""
        taken = table.take(pa.array(ids.astype(np.int64)))
        offsets = np.frombuffer(taken.buffers()[1], np.int64)[: len(ids) + 1]
        data = taken.buffers()[2] or pa.py_buffer(b"")
        cut = offsets[edges].tolist()
        for a, b in zip(cut, cut[1:]):
            yield data.slice(a, b - a).to_pybytes()

    def decode(self, ids: np.ndarray, edges: np.ndarray) -> Iterator[str]:
        """Texts of ids; a byte that begins no character becomes U+FFFD."""
        for raw in self.spell(self.surface, ids, edges):
            text = raw.decode("utf-8", "replace")
            yield text[1:] if text[:1] == " " else text


def encode(docs: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id`` and ``ids`` of each row."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            for ids, edges in codec(model).encode(batch.column("text")):
                n = len(edges) - 1
                lists = pa.ListArray.from_arrays(pa.array(edges, pa.int32()), pa.array(ids.astype(np.int32)))
                yield pa.record_batch([batch.column("doc_id").slice(at, n), lists], names=["doc_id", "ids"])
                at += n

    return _picked(docs, id_col, text_col).mapInArrow(run, "doc_id long, ids array<int>")


def digests(docs: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: number of ids, digest of the ids, and digest of the text decoded from them."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = codec(model)
        for batch in batches:
            at = 0
            for ids, edges in code.encode(batch.column("text")):
                n = len(edges) - 1
                listed = (hashlib.sha256(x[:-1]).hexdigest() for x in code.spell(code.decimal, ids, edges))
                back = (hashlib.sha256(x.encode()).hexdigest() for x in code.decode(ids, edges))
                yield pa.record_batch(
                    [
                        batch.column("doc_id").slice(at, n),
                        pa.array(np.diff(edges)),
                        pa.array(list(listed), pa.string()),
                        pa.array(list(back), pa.string()),
                    ],
                    names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
                )
                at += n

    return _picked(docs, id_col, text_col).mapInArrow(run, DIGESTS)


def _picked(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
