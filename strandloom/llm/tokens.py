"""Token ids of whole texts by the tokenizers library.

Texts are cut where the tokenizer can't join across.  A distinct piece goes through the
library once while a worker knows it: a piece has a number, the ids of all known pieces
lie in one array, and a batch's ids are gathered from it by number.  New pieces are
encoded many at once, with something between them that leaves their ids alone, or by
themselves where nothing does.  A worker that knows more than ``CACHE`` pieces after a
batch keeps the most frequent half of that; pieces longer than ``LONG`` characters are forgotten
after each batch.

- ``words``: for tokenizers that drop white space (word_bpe): cut at ASCII white space.
  A-Z are lower-cased before pieces are compared, as the tokenizer does so anyway.
- ``spaced``: for byte-level tokenizers that take one space before a word: cut before
  each space, and before and after each line end.  Texts with longer white space, some
  of which stays together, are cut by the tokenizer's own rule instead.

Either way marks at the end of a piece are a piece of their own after a letter or digit.

The strings of added tokens (``<|endoftext|>``) in a text become their ids, as in a plain
call of the library; with ``special=False`` they are ordinary text.
"""

from __future__ import annotations

import os
import re
import string
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from strandloom.llm.runtime import begun, kept

CACHE = 250_000
LONG = 64
#: Pieces in one call of the library.
CALL = 2000
#: Pieces whose ids are gathered at once; bounds the memory of long texts.
GATHER = 1 << 18

#: The White_Space characters of Unicode.
SPACE = "".join(map(chr, (*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)))
SPACED = re.compile(rf" ?[^{SPACE}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+")
#: White space of which some may stay together.
LONGER = rf"[{SPACE}]{{3}}|[{SPACE}]{{2}}\z"
#: Marks that compose with A-Z, which the tokenizer lower-cases after composing.
MARKS = "[̀-ͯ]"
#: Letters that are one letter each when composed and lower-cased.
LETTERS = "A-Za-zÀ-ÖØ-öø-įı-ſΑ-ΡΣ-ωА-яぁ-ゖァ-ヺ一-鿿"
PLAIN = f"^[{LETTERS}]+$"
#: Marks that end a piece; an apostrophe may begin a word's ending.
STOPS = "".join(c for c in string.punctuation if c != "'")
STOPPED = f"[{LETTERS}0-9](?P<stops>[{re.escape(STOPS)}]+)$"
#: By way to cut: what stands between pieces, and which pieces it leaves alone.
BETWEEN = {"words": (" \0 ", r"^[^\x00]*$"), "spaced": ("\n", rf"^ ?[^{SPACE}]+$")}

Encoder = Callable[[pa.Array], tuple[np.ndarray, np.ndarray]]
_MADE: dict[tuple, Encoder] = {}
kept("tokens", _MADE.clear)


class Pieces:
    """The pieces that a worker knows: their numbers, and their ids in one array."""

    def __init__(self, encoded: Callable[[list[str]], Iterator[tuple[list[str], np.ndarray, np.ndarray]]], kind: str, most: int) -> None:
        self.encoded, self.most = encoded, most
        self.names: list[str] = []
        self.numbers: dict[str, int] = {}
        self.ids, self.used = np.zeros(1 << 16, kind), 0
        self.starts, self.sizes, self.seen = np.zeros(0, np.int32), np.zeros(0, np.int32), np.zeros(0)

    def known(self, names: list[str]) -> np.ndarray:
        """Numbers of ``names``; new ones are learned, long ones last."""
        found = list(map(self.numbers.get, names))
        gaps = [k for k, n in enumerate(found) if n is None]
        new = list(dict.fromkeys(names[k] for k in gaps))
        self.learn([x for x in new if len(x) <= LONG])
        self.lasting = len(self.names), self.used
        self.learn([x for x in new if len(x) > LONG])
        for k in gaps:
            found[k] = self.numbers[names[k]]
        return np.array(found, np.int64)

    def learn(self, new: list[str]) -> None:
        all_sizes = [self.sizes]
        for names, ids, sizes in self.encoded(new):
            if self.used + len(ids) > len(self.ids):
                self.ids = np.concatenate((self.ids, np.zeros(max(len(ids), len(self.ids) // 2), self.ids.dtype)))
            self.ids[self.used : self.used + len(ids)] = ids
            self.used += len(ids)
            self.numbers.update(zip(names, range(len(self.names), len(self.names) + len(names)), strict=True))
            self.names += names
            all_sizes.append(sizes)
        self.sizes = np.concatenate(all_sizes).astype(np.int32)
        self.starts = np.cumsum(self.sizes, dtype=np.int32) - self.sizes

    def gathered(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of a sequence of pieces, and where each piece ends among them."""
        return gathered(self.ids, self.starts[numbers], self.sizes[numbers])

    def forget(self, numbers: np.ndarray, times: np.ndarray) -> None:
        """After a batch that had pieces ``numbers`` so many times: long pieces, and if too many are known the rarer ones."""
        many, self.used = self.lasting
        for name in self.names[many:]:
            del self.numbers[name]
        del self.names[many:]
        self.starts, self.sizes = self.starts[:many], self.sizes[:many]
        seen = np.bincount(numbers, times, many)[:many]
        seen[: len(self.seen)] += self.seen
        self.seen = seen
        if many > self.most:
            least = np.partition(seen, many - self.most // 2)[many - self.most // 2]
            keep = np.flatnonzero(seen > least)
            self.ids, _ = self.gathered(keep)
            self.used, self.seen, self.sizes = len(self.ids), seen[keep], self.sizes[keep]
            self.starts = np.cumsum(self.sizes, dtype=np.int32) - self.sizes
            self.names = [self.names[k] for k in keep.tolist()]
            self.numbers = {x: k for k, x in enumerate(self.names)}


def listed(texts: pa.Array) -> list[str]:
    """Faster than ``to_pylist``."""
    return texts.to_numpy(zero_copy_only=False).tolist()


def gathered(ids: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Stretches of ``ids`` in a row, and where each ends; so many at once as bounds the memory of long texts."""
    parts = [np.zeros(0, ids.dtype)]
    ends = np.cumsum(sizes, dtype=np.int64)
    for k in range(0, len(sizes), GATHER):
        size = sizes[k : k + GATHER]
        own = np.cumsum(size, dtype=np.int32)
        at = np.arange(own[-1], dtype=np.int32)
        at += np.repeat(starts[k : k + GATHER] - own + size, size)
        parts.append(ids[at])
    return np.concatenate(parts), ends


def _words(texts: pa.Array, added: list[str]) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """How many pieces each text has, all pieces as places among the distinct ones, and those."""
    lists = pc.ascii_split_whitespace(texts)
    flat = lists.flatten().dictionary_encode()
    names, lower = flat.dictionary, pc.ascii_lower(flat.dictionary)
    asis = pc.match_substring_regex(names, MARKS)
    for token in added:  # which lower-casing mustn't make
        asis = pc.or_(asis, pc.match_substring(lower, token))
    return pc.list_value_length(lists).to_numpy(), flat.indices.to_numpy(), pc.if_else(asis, names, lower)


def _spaced(texts: pa.Array, added: list[str]) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    if pc.any(pc.match_substring_regex(texts, LONGER)).as_py():
        cut = [SPACED.findall(x) for x in texts.to_pylist()]
        flat = pa.array([x for pieces in cut for x in pieces], pa.string()).dictionary_encode()
        return np.array([len(x) for x in cut], np.int64), flat.indices.to_numpy(), flat.dictionary
    lines = pc.split_pattern(texts, "\n")
    lists = pc.split_pattern(lines.flatten(), " ")
    per_text, per_line = (pc.list_value_length(x).to_numpy() for x in (lines, lists))
    flat = lists.flatten().dictionary_encode()
    bare, places = flat.dictionary, flat.indices.to_numpy().copy()
    begins, opens = np.cumsum(per_line) - per_line, np.cumsum(per_text) - per_text
    places[begins] += len(bare)  # a line's first piece has no space before it
    later = np.delete(begins, opens)
    places = np.insert(places, later, 2 * len(bare))
    names = pa.concat_arrays([pc.binary_join_element_wise(" ", bare, ""), bare, pa.array(["\n"])])
    used = np.flatnonzero(np.bincount(places, minlength=len(names)))
    moved = np.zeros(len(names), np.int32)
    moved[used] = np.arange(len(used))
    return np.add.reduceat(per_line, opens) + per_text - 1, moved[places], names.take(pa.array(used))


def _stopped(names: pa.Array, added: list[str]) -> tuple[pa.Array, pa.Array]:
    """Stems of pieces, and the marks at their end, empty without a letter or digit before them."""
    found = pc.struct_field(pc.extract_regex(names, STOPPED), "stops")
    found = pc.if_else(pc.is_in(names, pa.array(added, pa.string())), pa.scalar(None, pa.string()), found)
    stems = pc.if_else(pc.is_valid(found), pc.ascii_rtrim(names, characters=STOPS), names)
    return stems, pc.fill_null(found, "")


CUTS = {"words": _words, "spaced": _spaced}


def encoder(path: str, cut: str, kind: str = "<u4", special: bool = True, cache: int = CACHE) -> Encoder:
    """A function from texts without nulls to all their ids, numbers of ``kind``, and where each text ends; one per worker."""
    begun("tokens")
    if (path, cut, kind, special) in _MADE:
        return _MADE[path, cut, kind, special]
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = not special
    if tokenizer.get_vocab_size() > 1 << 8 * np.dtype(kind).itemsize:
        raise ValueError(f"ids of {path} don't fit {kind}")
    tokens = list(tokenizer.get_added_tokens_decoder().values()) if special else []
    if any(t.lstrip or t.rstrip or t.single_word or t.normalized for t in tokens):
        raise ValueError(f"{path} has added tokens that depend on what is around them")
    added = sorted((t.content for t in tokens), key=lambda x: (-len(x), x))
    around = re.compile("(" + "|".join(map(re.escape, added)) + ")")
    between, alone = BETWEEN[cut]
    (mark,) = tokenizer.encode(between, add_special_tokens=False).ids
    closes = np.zeros(tokenizer.get_vocab_size(), bool)  # ids that end a word of letters
    closes[[i for token, i in tokenizer.get_vocab().items() if cut == "words" and token.endswith("</w>")]] = True

    def encoded(names: list[str]) -> Iterator[tuple[list[str], np.ndarray, np.ndarray]]:
        texts = pa.array(names, pa.string())
        plain = pc.match_substring_regex(texts, PLAIN) if cut == "words" else pa.array(np.zeros(len(texts), bool))
        some = pc.and_not(pc.match_substring_regex(texts, alone), plain)
        odd = listed(texts.filter(pc.invert(pc.or_(plain, some))))
        for part, glue in ((listed(texts.filter(plain)), " "), (listed(texts.filter(some)), between)):
            for k in range(0, len(part), CALL):
                own = part[k : k + CALL]
                ids = np.array(tokenizer.encode_batch_fast([glue.join(own)], add_special_tokens=False)[0].ids, np.int64)
                inner = glue == between
                ends = np.append(np.flatnonzero(ids == mark), len(ids)) if inner else np.flatnonzero(closes[ids]) + 1
                if len(ends) != len(own):  # what looks like an end is within a piece
                    odd += own
                    continue
                sizes = np.diff(ends, prepend=-1 if inner else 0) - inner
                yield own, ids[ids != mark] if inner else ids, sizes
        for k in range(0, len(odd), CALL):
            own = odd[k : k + CALL]
            found = [x.ids for x in tokenizer.encode_batch_fast(own, add_special_tokens=False)]
            yield own, np.array([i for x in found for i in x], np.int64), np.array([len(x) for x in found], np.int64)

    pieces = Pieces(encoded, kind, cache)

    def group(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        sizes, places, names = CUTS[cut](texts, added)
        stems, stops = (x.dictionary_encode() for x in _stopped(names, added))
        found = pieces.known(listed(stems.dictionary) + listed(stops.dictionary))
        both = np.stack((found[stems.indices.to_numpy()], found[stops.indices.to_numpy() + len(stems.dictionary)]), 1).ravel()
        own, ends = pieces.gathered(both)  # ids of the distinct names, a stem and its stops side by side
        ends = ends[1::2].astype(np.int32)
        pieces.forget(both, np.repeat(np.bincount(places, minlength=len(names)), 2))
        sizes_of = np.diff(ends, prepend=np.int32(0))
        ids, ends = gathered(own, (ends - sizes_of)[places], sizes_of[places])
        return ids, np.append(0, ends)[np.cumsum(sizes)]

    def ids(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        if not len(texts):
            return np.zeros(0, kind), np.zeros(0, np.int64)
        hit = np.zeros(len(texts), bool)
        for token in added:
            hit |= pc.match_substring(texts, token).to_numpy(zero_copy_only=False)
        if not hit.any():
            return group(texts)
        parts = [around.split(x.as_py()) if h else [x.as_py()] for x, h in zip(texts, hit, strict=True)]
        found, ends = group(pa.array([x for p in parts for x in p], pa.string()))
        return found, ends[np.cumsum([len(p) for p in parts]) - 1]

    _MADE[path, cut, kind, special] = ids
    return ids


def ended(ids: np.ndarray, ends: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids with the id ``end`` after each text, and where the texts end then."""
    return np.insert(ids, ends, end), ends + np.arange(1, len(ends) + 1)


def binary(ids: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.Array:
    """Adjoining stretches of ``ids`` as bytes, in place."""
    if not len(starts):
        return pa.array([], pa.binary())
    offsets = (np.append(starts, ends[-1]) * ids.dtype.itemsize).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(ids))])
