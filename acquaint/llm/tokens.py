"""Token ids of whole texts, with each distinct piece of text encoded once."""

from __future__ import annotations

import os
import re
from collections.abc import Iterator

import numpy as np

from acquaint.llm.shared import kept_for

#: Distinct pieces that a worker remembers, some 200 bytes each, before it forgets the
#: rare ones.
MOST_PIECES = 600_000

#: Characters of all pieces that a worker remembers, and those of one chunk of texts.
MOST_CHARACTERS = 30_000_000

#: A longer text is encoded in segments of so many characters, and one piece more.
SEGMENT = 1_000_000

#: Words that are new are encoded together, so many in one text.
LOT = 4096


class _Numbers(dict):
    """A number for each key, in the order of arrival; ``new`` are the keys not yet learned."""

    def __init__(self, known=()) -> None:
        super().__init__(known)
        self.new: list[str] = []

    def __missing__(self, key: str) -> int:
        self[key] = number = len(self)
        self.new.append(key)
        return number


class PieceTokenizer:
    """Byte-level BPE of a ``tokenizers`` file, remembering pieces between spaces.

    The file's pre-tokenizer never joins a space to what precedes it, so a text
    may be cut before every space that a character other than white space
    follows, and the ids of the pieces, one after the other, are those of the
    whole text. For the same reason new words are encoded many in one text: a
    word's ids begin at each id whose token begins with a space.

    Keys of pieces are words without the space before them. A key that begins with a
    space is a piece without one, the beginning of a text. Only keys without any
    space are words; others are encoded alone.
    """

    #: What ``str.split`` would cut where it must not be cut.
    _uneven = re.compile(r" (?:\s|$)")
    _cut = re.compile(r" (?=\S)")

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        vocabulary = self._tokenizer.get_vocab(with_added_tokens=True)
        self._begins = np.zeros(max(vocabulary.values()) + 1, bool)
        # The byte-level alphabet writes a space as this letter.
        self._begins[[n for token, n in vocabulary.items() if token.startswith("Ġ")]] = True
        self._numbers = _Numbers()
        self._ids, self._held = np.zeros(1 << 16, np.uint32), 0
        self._starts = self._lengths = np.zeros(0, np.int64)
        self._uses = np.zeros(0, np.int64)
        self._characters = 0

    def _forget(self) -> None:
        """Keep the pieces used most, half at most; of equally used ones the first."""
        order = np.argsort(-self._uses, kind="stable")[: MOST_PIECES // 2]
        kept = np.sort(order[self._uses[order] > 1])
        names = list(self._numbers)
        self._numbers = _Numbers((names[k], n) for n, k in enumerate(kept.tolist()))
        self._characters = sum(map(len, self._numbers))
        lengths = self._lengths[kept]
        ids = self._ids[_places(self._starts[kept], lengths)]
        self._ids, self._held = ids, len(ids)
        self._starts, self._lengths = np.cumsum(lengths) - lengths, lengths
        self._uses = self._uses[kept]

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of every text, as unsigned 32-bit numbers."""
        if len(self._numbers) > MOST_PIECES or self._characters > MOST_CHARACTERS:
            self._forget()
        keys: list[str] = []
        ends = []
        for text in texts:
            if text:
                at = len(keys)
                keys.extend(self._cut.split(text) if self._uneven.search(text) else text.split(" "))
                if keys[at]:
                    keys[at] = " " + keys[at]
                else:
                    del keys[at]
            ends.append(len(keys))
        numbers = np.fromiter(map(self._numbers.__getitem__, keys), np.int64, len(keys))
        self._learn()
        uses = np.bincount(numbers, minlength=len(self._numbers))
        uses[: len(self._uses)] += self._uses
        self._uses = uses
        lengths = self._lengths[numbers]
        ids = self._ids[_places(self._starts[numbers], lengths)]
        bounds = np.concatenate(([0], np.cumsum(lengths)))[ends]
        return np.split(ids, bounds[:-1]) if len(texts) else []

    def encode_long(self, texts: list[str]) -> list[np.ndarray]:
        """The same, with texts of more than ``SEGMENT`` characters in segments."""
        found = self.encode([t if len(t) <= SEGMENT else "" for t in texts])
        for n, text in enumerate(texts):
            if len(text) > SEGMENT:
                found[n] = np.concatenate([self.encode([x])[0] for x in self._segments(text)])
        return found

    def _segments(self, text: str) -> Iterator[str]:
        begin = 0
        while begin < len(text):
            cut = self._cut.search(text, begin + SEGMENT)
            end = cut.start() if cut else len(text)
            yield text[begin:end]
            begin = end

    def _learn(self) -> None:
        new, self._numbers.new = self._numbers.new, []
        if not new:
            return
        known = len(self._starts)
        lengths = np.zeros(len(new), np.int64)
        order = []
        found = []
        self._characters += sum(map(len, new))
        words = [n for n, key in enumerate(new) if " " not in key]
        others = [n for n, key in enumerate(new) if " " in key]
        for first in range(0, len(words), LOT):
            lot = words[first : first + LOT]
            ids = self._encoded(["".join([" " + new[n] for n in lot])])[0]
            begins = np.flatnonzero(self._begins[ids])
            if len(begins) == len(lot) and begins[0] == 0:
                lengths[lot] = np.diff(begins, append=len(ids))
                found.append(ids)
            else:
                alone = self._encoded([" " + new[n] for n in lot])
                lengths[lot] = list(map(len, alone))
                found.extend(alone)
            order.extend(lot)
        if others:
            alone = self._encoded([new[n][1:] if new[n][0] == " " else " " + new[n] for n in others])
            lengths[others] = list(map(len, alone))
            found.extend(alone)
            order.extend(others)
        starts = np.zeros(len(new), np.int64)
        in_order = lengths[order]
        starts[order] = self._held + np.cumsum(in_order) - in_order
        flat = np.concatenate(found)
        if self._held + len(flat) > len(self._ids):
            grown = np.zeros(2 * (self._held + len(flat)), np.uint32)
            grown[: self._held] = self._ids[: self._held]
            self._ids = grown
        self._ids[self._held : self._held + len(flat)] = flat
        self._held += len(flat)
        self._starts = np.concatenate((self._starts[:known], starts))
        self._lengths = np.concatenate((self._lengths[:known], lengths))

    def _encoded(self, texts: list[str]) -> list[np.ndarray]:
        done = self._tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(x.ids, np.uint32) for x in done]


def _places(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """All places of runs, one run after the other."""
    to = np.cumsum(lengths)
    return np.repeat(starts - (to - lengths), lengths) + np.arange(int(to[-1]) if len(to) else 0)


@kept_for("acquaint.llm.packing")
def piece_tokenizer(path: str) -> PieceTokenizer:
    return PieceTokenizer(path)
