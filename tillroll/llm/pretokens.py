"""Pre-tokens of the public byte-level BPE tokenizers, found with array operations.

Both schemes cut a text where the character class changes (letter, number,
white space, other), with English contractions as an exception.  A batch of
texts is one code point array; the cuts are flags on it, so no per-token
Python runs.  Equal pre-tokens get equal 64-bit keys (prefix hashes), so a
vocabulary's work is done once per distinct pre-token.

``Encoder`` gives token ids: the tokenizers library encodes each distinct
pre-token, the ids are put together by position.  Texts are cut into slices
at a space between two other characters, where no pre-token crosses, so the
memory for one very long text is bounded too.
"""
from __future__ import annotations

import functools
import unicodedata
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import regex
from tokenizers import Tokenizer

from tillroll.llm.hashing import span_keys

LETTER, NUMBER, SPACE, OTHER = range(4)
SLICE_CHARS = 1 << 19
MEMO_ENTRIES = 1 << 20  # distinct pre-tokens a worker remembers before it starts anew
MEMO_RECENT = 1 << 16   # of them, the latest that lie in a dictionary and not in sorted arrays yet
# Below this code point, NFC and lower case have long been the same in all Unicode versions.
STABLE = 0x1C80

_CUT = regex.compile(r"(?<=\S) (?=\S)")


@functools.lru_cache(maxsize=2)
def load(path: str) -> Tokenizer:
    return Tokenizer.from_file(path)


@functools.lru_cache(maxsize=2)
def classes(path: str) -> np.ndarray:
    """Class of each code point.  Where this Python's and the regex module's
    Unicode versions disagree, the tokenizer's own splitting decides."""
    code = np.delete(np.arange(0x110000, dtype="<u4"), slice(0xD800, 0xE000))
    text = code.tobytes().decode("utf-32-le")
    kind = np.frombuffer("".join(map(unicodedata.category, text)).encode(), "S2").astype("S1")
    unsure = np.zeros(0x110000, bool)
    out = np.full(0x110000, OTHER, np.uint8)
    out[[ord(c) for c in regex.findall(r"\s", text)]] = SPACE
    for which, letter, pattern in ((LETTER, b"L", r"\p{L}"), (NUMBER, b"N", r"\p{N}")):
        differ = np.zeros(0x110000, bool)
        differ[code[kind == letter]] = True
        differ[[ord(c) for c in regex.findall(pattern, text)]] ^= True
        out[code[kind == letter]] = which
        unsure |= differ
    split = load(path).pre_tokenizer.pre_tokenize_str
    for i in np.flatnonzero(unsure).tolist():
        c = chr(i)
        is_letter = len(split("a" + c)) == 1
        is_number = not is_letter and len(split("!" + c)) == 2
        out[i] = LETTER if is_letter else NUMBER if is_number else OTHER
    return out


@functools.cache
def byte_units() -> np.ndarray:
    """The UTF-16 unit that stands for each byte in a byte-level vocabulary: printable
    bytes for themselves, the others from 256 on."""
    units = np.arange(256, dtype="<u2")
    rest = np.ones(256, bool)
    for a, b in ((0x21, 0x7E), (0xA1, 0xAC), (0xAE, 0xFF)):
        rest[a:b + 1] = False
    units[rest] = 256 + np.arange(rest.sum())
    return units


class Scheme:
    """How one tokenizer file splits: ``word`` drops white space, lower-cases
    and takes digits singly (word_bpe); else spaces join the next pre-token."""

    def __init__(self, path: str):
        tok = load(path)
        self.path = path
        self.normalizer = tok.normalizer
        self.word = tok.normalizer is not None
        special = [t.content for t in tok.get_added_tokens_decoder().values()]
        self.specials = frozenset(special)
        self._special = regex.compile("(" + "|".join(map(regex.escape, special)) + ")") if special else None
        self._mark = special[0][:2] if special else None

    def segments(self, text: str) -> list[tuple[str, bool]]:
        """(piece, is special token); pieces between special strings are split apart."""
        parts = self._special.split(text) if self._special and self._mark in text else [text]
        return [(p if p in self.specials else self._normal(p), p in self.specials) for p in parts if p]

    def _normal(self, text: str) -> str:
        if not self.word:
            return text
        if text.isascii():
            return text.lower()
        if max(text) >= chr(STABLE) or "Σ" in text:  # capital sigma: Python's lower case looks around
            return self.normalizer.normalize_str(text)
        return unicodedata.normalize("NFC", text).lower()

    def tokens(self, text: str, seg_at: np.ndarray, special: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(starts, ends, keys) of the pre-tokens of concatenated segments."""
        cp = np.frombuffer(text.encode("utf-32-le"), np.uint32)
        n = len(cp)
        kind = classes(self.path)[cp]
        seg = np.zeros(n + 3, bool)
        seg[seg_at] = True
        run = seg[:n].copy()
        run[1:] |= kind[1:] != kind[:-1]
        start = np.zeros(n + 3, bool)
        start[:n] = run | (kind == NUMBER) if self.word else run
        far = np.concatenate([kind, np.full(3, OTHER, np.uint8)])
        code = np.concatenate([cp, np.zeros(3, np.uint32)])

        # 's 't 'm 'd 're 've 'll right after an apostrophe that begins a pre-token
        q = np.flatnonzero(run & (cp == 0x27))
        q = q[(far[q + 1] == LETTER) & ~seg[q + 1]]
        if not self.word:
            q = q[~((q > 0) & (code[q - 1] == 0x20) & ~seg[q])]
        c1, c2 = code[q + 1], np.where((far[q + 2] == LETTER) & ~seg[q + 2], code[q + 2], 0)
        one = np.isin(c1, [ord(c) for c in "stmd"])
        two = ((c1 == ord("r")) | (c1 == ord("v"))) & (c2 == ord("e")) | (c1 == ord("l")) & (c2 == ord("l"))
        for where, size in ((q[one], 2), (q[two], 3)):
            start[where + 1] = False
            after = where + size
            start[after[(far[after] == LETTER)]] = True
        if not self.word:  # the last white space before something else stands alone, or joins it if it is a space
            b = np.flatnonzero(run[1:] & (kind[:-1] == SPACE) & ~seg[1:n]) + 1
            start[b - 1] = True
            start[b[cp[b - 1] == 0x20]] = False
        ends_of = np.append(seg_at[1:], n)
        for a, e in zip(seg_at[special], ends_of[special]):
            start[a + 1:e] = False
        starts = np.flatnonzero(start[:n])
        ends = np.append(starts[1:], n)
        if self.word:
            keep = kind[starts] != SPACE
            starts, ends = starts[keep], ends[keep]
        return starts, ends, span_keys(cp, starts, ends)


def ragged(values: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """values[starts[i]:starts[i]+lengths[i]] for all i, end to end."""
    total = int(lengths.sum())
    if not total:
        return values[:0]
    before = np.cumsum(lengths) - lengths
    return values[np.repeat(starts - before, lengths) + np.arange(total)]


class Memo:
    """Values of distinct pre-tokens as ragged int32 arrays, by key.  The keys lie
    in ascending order in an array, the latest few in a dictionary: a worker
    keeps its memo after its tasks, and Python's integers take eight times the room."""

    def __init__(self, scheme: Scheme, solve: Callable[[list[str]], tuple[np.ndarray, np.ndarray]]):
        """``solve``: the values of the given pre-tokens end to end, and how many each has."""
        self.scheme, self.solve = scheme, solve
        self._clear()

    def _clear(self) -> None:
        self.recent: dict[int, int] = {}
        self.known, self.place = np.empty(0, np.uint64), np.empty(0, np.int32)
        self.flat, self.used = np.empty(1 << 16, np.int32), 0
        self.at, self.size = np.empty(1 << 14, np.int64), np.empty(1 << 14, np.int32)

    def _grow(self, name: str, need: int) -> np.ndarray:
        a = getattr(self, name)
        if need > len(a):
            b = np.empty(max(need, 2 * len(a)), a.dtype)
            b[:len(a)] = a
            setattr(self, name, b)
        return getattr(self, name)

    def __len__(self) -> int:
        return len(self.known) + len(self.recent)

    def _find(self, keys: np.ndarray) -> np.ndarray:
        """The slot of each key, -1 of an unknown one."""
        out = np.full(len(keys), -1, np.int64)
        if len(self.known):
            order = np.argsort(keys)  # a search in ascending order stays in the cache
            keys_up = keys[order]
            at = np.minimum(np.searchsorted(self.known, keys_up), len(self.known) - 1)
            out[order] = np.where(self.known[at] == keys_up, self.place[at], -1)
        if self.recent:
            rest = np.flatnonzero(out < 0)
            out[rest] = [self.recent.get(k, -1) for k in keys[rest].tolist()]
        return out

    def _settle(self) -> None:
        """The latest keys go to the sorted ones."""
        keys = np.fromiter(self.recent, np.uint64, len(self.recent))
        order = np.argsort(keys)
        at = np.searchsorted(self.known, keys[order])
        place = np.fromiter(self.recent.values(), np.int32, len(keys))
        self.known, self.place = np.insert(self.known, at, keys[order]), np.insert(self.place, at, place[order])
        self.recent = {}

    def slots(self, text: str, starts: np.ndarray, ends: np.ndarray, keys: np.ndarray) -> np.ndarray:
        """The slot of each pre-token; new ones are solved first."""
        codes, distinct = pd.factorize(keys)
        first = np.empty(len(distinct), np.int64)
        first[codes[::-1]] = np.arange(len(codes) - 1, -1, -1)
        if len(self) + len(distinct) > MEMO_ENTRIES:
            self._clear()
        found = self._find(distinct)
        new = np.flatnonzero(found < 0)
        if len(new):
            a, e = starts[first[new]].tolist(), ends[first[new]].tolist()
            joined, sizes = self.solve([text[i:j] for i, j in zip(a, e)])
            base = len(self)
            self._grow("flat", self.used + len(joined))[self.used:self.used + len(joined)] = joined
            self._grow("size", base + len(new))[base:base + len(new)] = sizes
            self._grow("at", base + len(new))[base:base + len(new)] = self.used + np.cumsum(sizes) - sizes
            self.used += len(joined)
            found[new] = np.arange(base, base + len(new))
            self.recent.update(zip(distinct[new].tolist(), found[new].tolist()))
            if len(self.recent) > MEMO_RECENT:
                self._settle()
        return found[codes]

    def values(self, slots: np.ndarray) -> np.ndarray:
        return ragged(self.flat, self.at[slots], self.size[slots])


def slices(scheme: Scheme, texts: list[str]) -> Iterator[tuple[str, np.ndarray, np.ndarray, np.ndarray]]:
    """(joined text, segment starts, is special, document of each segment)
    of about SLICE_CHARS characters each, in order."""
    parts: list[str] = []
    special: list[bool] = []
    docs: list[int] = []
    held = 0

    def out():
        sizes = np.fromiter(map(len, parts), np.int64, len(parts))
        return "".join(parts), np.cumsum(sizes) - sizes, np.array(special, bool), np.array(docs, np.int64)

    for doc, text in enumerate(texts):
        for piece, is_special in scheme.segments(text) if text else ():
            while piece:
                cut = _CUT.search(piece, SLICE_CHARS) if len(piece) > 2 * SLICE_CHARS and not is_special else None
                head = piece[:cut.start()] if cut else piece
                piece = piece[len(head):]
                parts.append(head)
                special.append(is_special)
                docs.append(doc)
                held += len(head)
                if held >= SLICE_CHARS:
                    yield out()
                    parts, special, docs, held = [], [], [], 0
    if parts:
        yield out()


class Encoder:
    """Token ids of whole texts as the library gives them without added special tokens."""

    def __init__(self, path: str):
        self.scheme = Scheme(path)
        tok = load(path)

        model, specials = tok.model, self.scheme.specials

        def solve_word(pretokens: list[str]) -> tuple[np.ndarray, np.ndarray]:
            # one Encoding for all: an object for each pre-token costs as much as encoding it
            e = tok.encode(pretokens, is_pretokenized=True, add_special_tokens=False)
            return np.array(e.ids, np.int32), np.bincount(np.array(e.word_ids, np.int64), minlength=len(pretokens))

        def solve_byte(pretokens: list[str]) -> tuple[np.ndarray, np.ndarray]:
            # already cut, so the model's part alone is left
            raw = [p.encode() for p in pretokens]
            units = byte_units()[np.frombuffer(b"".join(raw), np.uint8)].tobytes().decode("utf-16-le")
            ids: list[int] = []
            ends: list[int] = []
            at = 0
            for p, r in zip(pretokens, raw):
                end = at + len(r)
                ids += [tok.token_to_id(p)] if p in specials else [t.id for t in model.tokenize(units[at:end])]
                ends.append(len(ids))
                at = end
            return np.array(ids, np.int32), np.diff(ends, prepend=0)

        solve = solve_word if self.scheme.word else solve_byte
        self.memo = Memo(self.scheme, solve)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts end to end, number of ids of each text)."""
        counts, flat = np.zeros(len(texts), np.int64), []
        for joined, seg_at, special, docs in slices(self.scheme, texts):
            starts, ends, keys = self.scheme.tokens(joined, seg_at, special)
            slots = self.memo.slots(joined, starts, ends, keys)
            flat.append(self.memo.values(slots))
            before = np.append(0, np.cumsum(self.memo.size[slots], dtype=np.int64))
            np.add.at(counts, docs, np.diff(before[np.append(np.searchsorted(starts, seg_at), len(starts))]))
        return (np.concatenate(flat) if flat else np.empty(0, np.int32)), counts
