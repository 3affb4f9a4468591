"""Token ids of whole texts in Arrow batches, each distinct word of a batch encoded once.

Where a vocabulary's rules drop white space and no rule looks across it, a text's ids are
those of its words in a row, and those of a word are the ids of the marks before it, of its
core, and of the marks behind it. Distinct words and cores are found and joined again as
Arrow and numpy columns. Cores of plain lower-case letters go to the vocabulary's model
itself, since its rules leave them as they are; the others are encoded many at a time, as one
text that is cut at the ids that end a word. Nothing is kept between batches.
``apart=False`` encodes each text in one piece, for all other vocabularies.
"""

from __future__ import annotations

import functools
import re
import unicodedata

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Words put together at a time, words gathered at a time, and bytes of text in a batch.
JOINED, _SLICE, BATCH = 250, 1 << 20, 24 << 20
ID_TYPE = "<u4"
#: Ids of words behind one another, and how many each has.
Coded = tuple[np.ndarray, np.ndarray]
#: Marks around a word; no rule of the vocabulary joins them to letters or digits.
_MARKS = ",.;:!?&%$*#|()\""
_MARK_NUMBER = np.zeros(256, np.int64)
_MARK_NUMBER[list(_MARKS.encode())] = np.arange(1, len(_MARKS) + 1)
#: The one letter whose lower case ends in a mark, which goes with those behind it.
_DOTTED = "\u0130"
#: What the vocabulary's rules cut lower-case ASCII text into (a fixed value).
_PARTS = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^\sa-z0-9]+")


def _byte_letters() -> np.ndarray:
    """The letter by which a byte-level vocabulary writes each byte: itself where it can be seen."""
    letters = np.arange(256, dtype="<u4")
    hidden = [*range(0x21), *range(0x7F, 0xA1), 0xAD]
    letters[hidden] = 256 + np.arange(len(hidden))
    letters[ord(" ")] = ord(" ")  # here, it parts words
    return letters


_LETTERS = _byte_letters()


def default_vocabulary() -> str:
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


def batches(column: pa.Array, limit: int = BATCH):
    """Row ranges of at most about ``limit`` bytes; a longer text stands alone."""
    size = pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(size, dtype=np.int64)
    first = 0
    while first < len(size):
        before = int(ends[first] - size[first])
        last = max(first + 1, int(np.searchsorted(ends, before + limit, "right")))
        yield first, last
        first = last


class Ragged:
    """Id lists of numbered words: ``data`` and where each begins and how long it is."""

    def __init__(self, data: np.ndarray, size: np.ndarray):
        self.data, self.size = data, size.astype(np.int64)
        self.start = np.cumsum(self.size) - self.size

    def take(self, index: np.ndarray) -> Ragged:
        """The lists at these numbers, behind one another."""
        size = self.size[index]
        ends = np.concatenate([[0], np.cumsum(size)])
        out = np.empty(ends[-1], ID_TYPE)
        for a in range(0, len(index), _SLICE):
            b = min(a + _SLICE, len(index))
            base = self.start[index[a:b]] - (ends[a:b] - ends[a])
            out[ends[a]:ends[b]] = self.data[np.repeat(base, size[a:b]) + np.arange(ends[b] - ends[a])]
        return Ragged(out, size)


class Encoder:
    """Texts to the little-endian 32-bit ids of all of each, without special ids added."""

    def __init__(self, path: str, apart: bool = True):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.apart = apart
        suffix = getattr(self.tokenizer.model, "end_of_word_suffix", None)
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.final = np.zeros(max(vocabulary.values()) + 1, bool)
        for token, number in vocabulary.items():
            self.final[number] = bool(suffix) and token.endswith(suffix)

    def whole(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, ID_TYPE).tobytes()
                for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def __call__(self, texts: pa.Array | list) -> list[bytes]:
        """The ids of each text; null is empty."""
        column = pc.fill_null(pa.array(texts, pa.large_string()) if isinstance(texts, list)
                              else texts.cast(pa.large_string()), "")
        if not self.apart:
            return self.whole(column.to_pylist())
        split = pc.split_pattern(pc.replace_substring(column, "\n", " "), " ")
        words = split.flatten().dictionary_encode()
        found = self._words(words.dictionary.cast(pa.string())).take(words.indices.to_numpy())
        ends = np.concatenate([[0], np.cumsum(found.size)])[split.offsets.to_numpy()].tolist()
        return [found.data[a:b].tobytes() for a, b in zip(ends, ends[1:])]

    def _words(self, words: pa.Array) -> Ragged:
        """Ids of distinct words, by those of the marks around them and of their cores."""
        core = pc.ascii_trim(words, characters=_MARKS)
        right = pc.ascii_ltrim(words, characters=_MARKS)
        front = pc.subtract(pc.binary_length(words), pc.binary_length(right)).to_numpy()
        back = pc.subtract(pc.binary_length(right), pc.binary_length(core)).to_numpy()
        # Other marks, such as apostrophes, may belong with those around them; so may the
        # vocabulary's whole tokens.
        fine = pc.match_substring_regex(core, r"^[\p{L}\p{N}](?:(?s:.)*[\p{L}\p{N}])?$")
        for token in [*self.added, _DOTTED]:
            fine = pc.and_(fine, pc.invert(pc.match_substring(words, token)))
        fine = fine.to_numpy(zero_copy_only=False)
        lower = pc.if_else(pc.string_is_ascii(core), pc.ascii_lower(core), core)
        middle = pc.if_else(pa.array(fine), lower, words)
        numbers = np.zeros((len(words), 3), np.int64)
        marks = {"": 0, **{c: k for k, c in enumerate(_MARKS, 1)}}
        # Most have one mark behind; its number comes from the word's last byte.
        single = np.flatnonzero(fine & (front == 0) & (back == 1))
        last = pc.binary_slice(words.take(pa.array(single)).cast(pa.binary()), -1)
        numbers[single, 2] = _MARK_NUMBER[np.frombuffer(b"".join(last.to_pylist()), np.uint8)]
        around = np.flatnonzero(fine & (front + back > 0) & ~((front == 0) & (back == 1)))
        some = words.take(pa.array(around)).to_pylist()
        for row, word, a, b in zip(around.tolist(), some, front[around].tolist(), back[around].tolist()):
            numbers[row, 0] = marks.setdefault(word[:a], len(marks))
            numbers[row, 2] = marks.setdefault(word[len(word) - b:], len(marks))
        coded = middle.dictionary_encode()
        known = self._cores(coded.dictionary)
        numbers[:, 1] = coded.indices.to_numpy() + len(marks)
        ids = [np.frombuffer(x, ID_TYPE) for x in self.whole(list(marks))]
        pieces = Ragged(np.concatenate([*ids, known.data]),
                        np.concatenate([np.array([len(x) for x in ids], np.int64), known.size])).take(numbers.ravel())
        return Ragged(pieces.data, pieces.size.reshape(-1, 3).sum(1))

    def _cores(self, cores: pa.Array) -> Ragged:
        """Ids of distinct cores, whatever is in them."""
        ascii_ = pc.string_is_ascii(cores)
        low = pc.and_(pc.ascii_is_alpha(cores), pc.ascii_is_lower(cores))
        alpha = pc.and_(pc.utf8_is_alpha(cores), pc.invert(ascii_))
        plain = pc.or_(low, pc.and_(alpha, pc.utf8_is_lower(cores))).to_numpy(zero_copy_only=False)
        letters = alpha.to_numpy(zero_copy_only=False) & ~plain
        mixed = ascii_.to_numpy(zero_copy_only=False) & ~plain
        for token in self.added:
            mixed &= ~pc.match_substring(cores, token).to_numpy(zero_copy_only=False)
        mixed &= pc.greater(pc.binary_length(cores), 0).to_numpy(zero_copy_only=False)
        rest = ~(plain | letters | mixed)
        size, parts, order = np.zeros(len(cores), np.int64), [], []
        for kind, rules in ((plain, self._plain), (letters, self._joined), (mixed, self._parted), (rest, self._alone)):
            rows = np.flatnonzero(kind)
            for at in range(0, len(rows), _SLICE):
                some = rows[at:at + _SLICE]
                cuts = np.append(np.arange(0, len(some), JOINED), len(some))
                texts = pc.binary_join(pa.ListArray.from_arrays(pa.array(cuts, pa.int32()),
                                                                cores.take(pa.array(some))), " ")
                for first, last, text in zip(cuts, cuts[1:], texts.to_pylist()):
                    ids = rules(text) or self._alone(text)
                    parts.append(ids[0])
                    size[some[first:last]] = ids[1]
            order.append(rows)
        if not parts:
            return Ragged(np.zeros(0, ID_TYPE), size)
        by_kind = np.concatenate(order)
        place = np.empty(len(by_kind), np.int64)
        place[by_kind] = np.arange(len(by_kind))
        return Ragged(np.concatenate(parts), size[by_kind]).take(place)

    def _plain(self, text: str) -> Coded | None:
        """Ids of lower-case words that no rule parts, written in the letters of their bytes."""
        if not text.isascii():
            if not unicodedata.is_normalized("NFC", text):
                return self._joined(text)
            text = _LETTERS[np.frombuffer(text.encode(), np.uint8)].tobytes().decode("utf-32-le")
        ids, size, tokenize = [], [], self.model.tokenize
        for word in text.split(" "):
            found = tokenize(word)
            size.append(len(found))
            ids += [token.id for token in found]
        return np.array(ids, ID_TYPE), np.array(size, np.int64)

    def _alone(self, text: str) -> Coded:
        ids = [np.frombuffer(x, ID_TYPE) for x in self.whole(text.split(" "))]
        return np.concatenate(ids), np.array([len(x) for x in ids], np.int64)

    def _parted(self, text: str) -> Coded | None:
        return self._joined(text, [len(_PARTS.findall(w.lower())) for w in text.split(" ")])

    def _joined(self, text: str, counts: list[int] | None = None) -> Coded | None:
        """Ids of the words of a text, and how many each has; None if they can't be told apart.

        A word has as many ids that end a part as counts say (else one).
        """
        ids = np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, ID_TYPE)
        stops = np.flatnonzero(self.final[ids]) + 1
        ends = np.arange(1, text.count(" ") + 2) if counts is None else np.cumsum(counts)
        if len(stops) != ends[-1] or (counts is not None and min(counts) == 0) or stops[-1] != len(ids):
            return None
        return ids, np.diff(stops[ends - 1], prepend=0)


@functools.lru_cache(maxsize=4)
def encoder(path: str, apart: bool = True) -> Encoder:
    return Encoder(path, apart)
