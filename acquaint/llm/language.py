"""Language identification by cross-parsing entropy.

For each language a suffix automaton of labelled text is built. A text is
parsed, from left to right, into longest matches with that text: the automaton
follows the text until no match goes on, then the next phrase begins. Text in
the language falls into few, long phrases. A phrase costs about
``log2(learned characters)`` bits, so ``phrases * log2(learned) / characters``
estimates bits a character (a cross entropy), and the smallest wins.

Texts are lower-cased; runs of anything but letters count as one separator.
Parses start anew every ``PARSED_TOGETHER`` symbols, so that all texts of a
batch, long or short, are parsed side by side: each step looks up the next
state of every stretch in many languages at once.

Every letter of the learned texts has a symbol of its own, in any script. Only
transitions that a language has are stored, so a letter it never saw ends a phrase.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from acquaint.llm.shared import encoded, giving_back, kept_for, slices

SCHEMA = "doc_id long, held_out boolean, lang_pred string, score double"

UNDETERMINED = "und"

#: Symbols of a stretch. The stretches of a text are parsed side by side, each from the
#: start; then each is parsed again from where the one before it ended, up to where
#: both ways agree.
PARSED_TOGETHER = 512

#: Characters of a text that are parsed at once.
SEGMENT = 1_000_000

#: States that are followed, and results that are held, at once.
STATES_TOGETHER, RESULTS_TOGETHER = 40_000, 4_000_000

#: Bits a character by which a language must be worse to weigh e times less.
SCORE_BITS = 0.1


@dataclass(frozen=True)
class Learning:
    """Bounds of what is learned of each language."""

    language_chars: int = 24_000
    document_chars: int = 3_000
    language_documents: int = 64


def learned_texts(
    documents: DataFrame, learnable: Column, learning: Learning = Learning()
) -> list[tuple[str, str]]:
    """A bounded sample of labelled text for each language, in the languages' order.

    Distinct documents of up to ``document_chars`` are taken whole, in the order of
    a hash of their text, at most ``language_documents`` a language and up to
    ``language_chars``; longer ones only where a language has too few of those.
    Copies count once: sizes and hashes are chosen from first, in which Spark keeps
    that many of a language in each task before it compares tasks, and then texts
    are fetched for those.
    """
    rows = (
        documents.where(learnable)
        .where(F.col("lang").isNotNull() & F.col("text").isNotNull())
        .select(
            F.col("lang").cast("string").alias("lang"),
            F.greatest(F.length("text"), F.lit(learning.document_chars)).alias("size"),
            F.xxhash64("text").alias("mixed"),
            F.substring("text", 1, learning.language_chars).alias("sample"),
        )
    )
    key = ["lang", "size", "mixed"]
    first = Window.partitionBy("lang").orderBy("size", "mixed")
    before = first.rowsBetween(Window.unboundedPreceding, -1)
    chosen = (
        rows.select(*key, F.length("sample").alias("chars"))
        .distinct()
        .withColumn("n", F.row_number().over(first))
        .where(F.col("n") <= learning.language_documents)
        .withColumn("taken", F.coalesce(F.sum(F.col("chars") + 1).over(before), F.lit(0)))
        .where(F.col("taken") < learning.language_chars)
        .drop("chars")
    )
    # What is beyond a language's bound is cut here, so no more than that is collected.
    left = F.lit(learning.language_chars) - F.col("taken")
    found = (
        rows.join(chosen, key)
        .groupBy(*key, "n", "taken")
        .agg(F.min("sample").alias("sample"))
        .withColumn("sample", F.substring("sample", F.lit(1), left.cast("int")))
        .groupBy("lang")
        .agg(F.sort_array(F.collect_list(F.struct("n", "sample"))).alias("found"))
        .select("lang", F.col("found.sample").alias("samples"))
        .collect()
    )
    most = learning.language_chars
    texts = {r["lang"]: "\n".join(r["samples"])[:most] for r in found}
    return sorted((lang, text) for lang, text in texts.items() if text.strip())


def identify(
    documents: DataFrame,
    learned: list[tuple[str, str]],
    held_out: Column,
) -> DataFrame:
    """Language of every whole text: doc_id, held_out, lang_pred, score.

    Null texts, texts without a letter, and all texts if nothing was learned are
    ``und`` with score 0. The score is the winner's share when a language of h
    bits a character weighs exp(-h / SCORE_BITS); ties go to the first language
    in alphabetical order. Repeated rows and null ids are kept as they are; other
    columns are ignored.
    """
    rows = documents.select(
        F.col("doc_id").cast("long").alias("doc_id"), held_out.alias("held_out"), "text"
    )
    frozen = tuple(learned)

    @giving_back
    def predicted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = cross_parser(frozen)
        for batch in batches:
            for first, last in slices(encoded(batch.column("text"))[1]):
                part = batch.slice(first, last - first)
                language, score = model.predict(part.column("text").to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("held_out"), language, score],
                    ["doc_id", "held_out", "lang_pred", "score"],
                )

    return rows.mapInArrow(predicted, SCHEMA)


def suffix_automaton(symbols: list[int]) -> list[dict[int, int]]:
    """Transitions of the automaton of all substrings; state 0 is the start."""
    to: list[dict[int, int]] = [{}]
    link, length, last = [-1], [0], 0
    for symbol in symbols:
        new = len(to)
        to.append({})
        length.append(length[last] + 1)
        link.append(0)
        at = last
        while at != -1 and symbol not in to[at]:
            to[at][symbol] = new
            at = link[at]
        if at != -1:
            next_ = to[at][symbol]
            if length[at] + 1 == length[next_]:
                link[new] = next_
            else:
                copy = len(to)
                to.append(dict(to[next_]))
                length.append(length[at] + 1)
                link.append(link[next_])
                while at != -1 and to[at].get(symbol) == next_:
                    to[at][symbol] = copy
                    at = link[at]
                link[next_] = link[new] = copy
        last = new
    return to


class Transitions:
    """Values by whole-numbered keys, looked up side by side.

    Each key is in one of two places that hashes of it name (cuckoo hashing).
    """

    def __init__(self, keys: np.ndarray, values: np.ndarray) -> None:
        draw = np.random.default_rng(17)
        self._size = np.uint64(5 * len(keys) // 2 + 16)
        held = None
        while held is None:
            self._factors = draw.integers(1, 2**63, 2, np.uint64) * np.uint64(2) + np.uint64(1)
            held = self._held(keys)
        self._keys = np.where(held < 0, -1, keys[held]) if len(keys) else held
        self._values = values[held] if len(keys) else held

    def _place(self, keys: np.ndarray, which: int) -> np.ndarray:
        at = keys.astype(np.uint64)
        at *= self._factors[which]
        at >>= np.uint64(32)
        at *= self._size
        at >>= np.uint64(32)
        return at.view(np.int64)

    def _held(self, keys: np.ndarray) -> np.ndarray | None:
        """The number of the key in each place, -1 for none; None if keys go in circles."""
        places = np.stack([self._place(keys, which) for which in (0, 1)])
        held = np.full(int(self._size), -1)
        which = np.zeros(len(keys), np.int8)
        pending = np.arange(len(keys))
        for _ in range(200):
            if not len(pending):
                return held
            at = places[which[pending], pending]
            driven = np.unique(held[at])
            held[at] = pending
            pending = np.concatenate((pending[held[at] != pending], driven[driven >= 0]))
            which[pending] ^= 1
        return None

    def __call__(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The keys' values, and which keys have none; their values mean nothing."""
        at = self._place(keys, 0)
        other = self._place(keys, 1)
        np.copyto(at, other, where=self._keys[at] != keys)
        return self._values[at], self._keys[at] != keys


class CrossParser:
    """Parses texts against the learned text of every language at once."""

    def __init__(self, learned: tuple[tuple[str, str], ...]) -> None:
        self.languages = [language for language, _ in learned]
        texts = [_code_points(sample.lower()) for _, sample in learned]
        self._symbol, self._width = _symbols(np.concatenate([np.zeros(0, np.uint32), *texts]))
        # A state stands for the number of its first key; a key for a state and a symbol.
        keys, values = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        bits, starts, states = [], [], 0
        # Where no match goes on, the next phrase begins with the symbol if it can.
        self._fresh = np.zeros((len(texts), self._width), np.int64)
        for number, text in enumerate(texts):
            symbols = _squeezed(self._symbol[text])
            to = suffix_automaton(symbols.tolist())
            at = np.repeat(np.arange(len(to)), [len(x) for x in to]) + states
            by = np.fromiter((s for x in to for s in x), np.int64, len(at))
            then = np.fromiter((t for x in to for t in x.values()), np.int64, len(at))
            then = (then + states) * self._width
            keys.append(at * self._width + by)
            values.append(then)
            self._fresh[number] = states * self._width
            self._fresh[number, by[at == states]] = then[at == states]
            bits.append(np.log2(max(2, len(symbols))))
            starts.append(states * self._width)
            states += len(to)
        self._next = Transitions(np.concatenate(keys), np.concatenate(values))
        self._starts = np.array(starts, np.int64)
        self._bits = np.array(bits)

    def phrases(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Phrases of each text in each language, its symbols, whether it has letters.

        A phrase is the longest match with the learned text, or a symbol in none;
        phrases follow each other from the text's beginning to its end.
        """
        lower = [(text or "").lower() for text in texts]
        short = [_code_points(t if len(t) <= SEGMENT else "") for t in lower]
        found, symbols, letters, states = self._parsed(short, self._begin(len(texts)))
        for n, text in enumerate(lower):
            if len(text) > SEGMENT:
                state, before = self._begin(1), 1
                for at in range(0, len(text), SEGMENT):
                    points = _code_points(text[at : at + SEGMENT])
                    more, size, has, state = self._parsed([points], state, before)
                    found[:, [n]] += more
                    symbols[n] += size[0]
                    letters[n] |= has[0]
                    before = self._symbol[points[-1]]
                states[:, [n]] = state
        # The text's end ends a phrase that has begun.
        return found + (states != self._starts[:, None]), symbols, letters

    def _begin(self, many: int) -> np.ndarray:
        return np.repeat(self._starts[:, None], many, axis=1)

    def _parsed(
        self, points: list[np.ndarray], states: np.ndarray, before: int = 1
    ) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Phrases that end in each text, symbols, letters, and the states at its end.

        Texts go on from the states given; ``before`` is the symbol before all of them.
        """
        sizes = np.fromiter(map(len, points), np.int64, len(points))
        flat = np.concatenate([np.zeros(0, np.uint32), *points])
        owner = np.repeat(np.arange(len(points)), sizes)
        symbol = self._symbol[flat]
        previous = np.empty_like(symbol)
        previous[1:] = symbol[:-1]
        previous[(np.cumsum(sizes) - sizes)[sizes > 0]] = before
        keep = (symbol != 0) | (previous != 0)
        symbol, owner = symbol[keep].astype(np.int64), owner[keep]
        symbols = np.bincount(owner, minlength=len(points))
        letters = np.bincount(owner[symbol != 0], minlength=len(points)) > 0

        stretches = -(-symbols // PARSED_TOGETHER)
        text_of = np.repeat(np.arange(len(points)), stretches)
        nth = np.arange(len(text_of)) - np.repeat(np.cumsum(stretches) - stretches, stretches)
        begin = (np.cumsum(symbols) - symbols)[text_of] + nth * PARSED_TOGETHER
        size = np.minimum(PARSED_TOGETHER, symbols[text_of] - nth * PARSED_TOGETHER)
        found = np.zeros((len(self.languages), len(points)))
        ends = states.copy()
        last = np.cumsum(stretches) - 1
        there = stretches > 0
        together = max(1, STATES_TOGETHER // max(1, len(begin)))
        for a in range(0, len(self.languages), together):
            some = slice(a, a + together)
            count, state = self._counted(some, symbol, begin, size, nth, states[some][:, text_of])
            for language, c in enumerate(count, a):
                found[language] = np.bincount(text_of, weights=c, minlength=len(points))
            ends[some, there] = state[:, last[there]]
        return found, symbols, letters, ends

    def _counted(
        self, languages: slice, symbol: np.ndarray, begin: np.ndarray, size: np.ndarray,
        nth: np.ndarray, given: np.ndarray,
    ) -> tuple[np.ndarray, np.ndarray]:
        """Phrases that end in each stretch in each language, and the states at its end.

        ``nth`` numbers the stretches of a text, which follow each other; ``given`` is
        where texts begin.
        """
        start, fresh = self._starts[languages], self._fresh[languages]
        steps = int(size.max(initial=0))
        states = np.zeros((steps + 1, *given.shape), np.int64)
        ended = np.zeros((steps, *given.shape), np.int8)
        states[0] = np.where(nth == 0, given, start[:, None])
        # The longest stretches come first, so that those still running are a range.
        order = np.argsort(-size, kind="stable")
        running = np.searchsorted(-size[order], -np.arange(1, steps + 1), side="right")
        now = states[0][:, order]
        for step, n in enumerate(running.tolist()):
            at = order[:n]
            now, ends = self._step(now[:, :n], symbol[begin[at] + step], start[:, None], fresh)
            states[step + 1][:, at] = now
            ended[step][:, at] = ends
        ends = states[size, :, np.arange(len(size))].T.copy()
        # Where a stretch begins, the one before it has ended: from there until both agree.
        reached = np.concatenate((ends[:, :1], ends[:, :-1]), axis=1)
        language, at = np.nonzero((nth > 0) & (reached != states[0]))
        while len(at):
            state, step = ends[language, at - 1], 0
            states[0][language, at] = state
            apart_language, apart_at = language, at
            while len(apart_at):
                by = symbol[begin[apart_at] + step]
                state, new = self._step(state, by, start[apart_language], fresh, apart_language)
                ended[step][apart_language, apart_at] = new
                step += 1
                apart = states[step][apart_language, apart_at] != state
                states[step][apart_language, apart_at] = state
                done = apart & (size[apart_at] == step)
                ends[apart_language[done], apart_at[done]] = state[done]
                apart &= size[apart_at] > step
                apart_language, apart_at, state = apart_language[apart], apart_at[apart], state[apart]
            follows = at + 1 < len(nth)
            language, at = language[follows], at[follows] + 1
            changed = (nth[at] > 0) & (ends[language, at - 1] != states[0][language, at])
            language, at = language[changed], at[changed]
        return ended.sum(axis=0, dtype=np.int64), ends

    def _step(self, now, by, start, fresh, language=None) -> tuple[np.ndarray, np.ndarray]:
        """The states after a symbol each, and the phrases that end with that."""
        then, stops = self._next(now + by)
        if language is None:
            row, at = np.nonzero(stops)
            first, own = fresh[row, by[at]], start[row, 0]
            where = (row, at)
        else:
            (where,) = np.nonzero(stops)
            first, own = fresh[language[where], by[where]], start[where]
        ends = np.zeros(then.shape, np.int8)
        # One phrase ends if one has begun; a symbol that is in no match is another.
        ends[where] = (now[where] != own).astype(np.int8) + (first == own)
        then[where] = first
        return then, ends

    def predict(self, texts: list[str | None]) -> tuple[pa.Array, pa.Array]:
        if not self.languages:
            return pa.array([UNDETERMINED] * len(texts)), pa.array([0.0] * len(texts))
        most = max(1, RESULTS_TOGETHER // len(self.languages))
        found = [self._predicted(texts[at : at + most]) for at in range(0, len(texts), most)]
        chosen, score = zip(*found) if found else ((), ())
        return (
            pa.array(np.concatenate([np.zeros(0, object), *chosen]), pa.string()),
            pa.array(np.concatenate([np.zeros(0), *score])),
        )

    def _predicted(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        found, symbols, letters = self.phrases(texts)
        entropy = found * self._bits[:, None] / np.maximum(1, symbols)
        best = entropy.argmin(axis=0)
        weight = np.exp(-(entropy - entropy.min(axis=0)) / SCORE_BITS)
        score = np.where(letters, 1 / weight.sum(axis=0), 0.0)
        names = np.array([*self.languages, UNDETERMINED], object)
        return names[np.where(letters, best, len(self.languages))], score


@kept_for("acquaint.llm.language")
def cross_parser(learned: tuple[tuple[str, str], ...]) -> CrossParser:
    return CrossParser(learned)


def _code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


@functools.lru_cache(maxsize=1)
def _is_letter() -> np.ndarray:
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)


def _symbols(learned: np.ndarray) -> tuple[np.ndarray, int]:
    """Symbol of every code point, 0 no letter, 1 letter never learned, 2.. learned
    letters, and the number of symbols."""
    letter = _is_letter()
    table = letter.astype(np.int32)
    points = np.unique(learned[letter[learned]])
    table[points] = np.arange(2, 2 + len(points))
    return table, 2 + len(points)


def _squeezed(symbols: np.ndarray) -> np.ndarray:
    """Runs of separators as one."""
    keep = np.ones(len(symbols), bool)
    keep[1:] = (symbols[1:] != 0) | (symbols[:-1] != 0)
    return symbols[keep]
