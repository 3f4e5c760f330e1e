"""Language by cross-parsing.

For each language the suffix automaton of some labelled text knows every string that occurs in it. A
text is cut greedily into the longest phrases that occur there; the language that needs the fewest
phrases per character is the most like it. The automata are turned into transition tables, and many
texts walk through them side by side.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reedbed.llm.common import LETTER, char_classes, code_points, column, keyed_text, text_batches

#: Bounds of the labelled sample: rows per language, characters per language.
SAMPLE_ROWS, SAMPLE_CHARS = 200, 40_000
#: Up to so many entries a table of transitions has one for each state and code; above, only for those that occur.
FULL_TABLE = 1 << 24
#: Texts are parsed in stretches of so many characters; a phrase ends with its stretch.
STRETCH = 1024
#: Codes of what is no letter (all such runs look alike) and of letters that are not in the sample.
GAP, RARE = 0, 1


def suffix_automaton(codes: list[int]) -> list[dict[int, int]]:
    """Transitions by code, for each state, of the strings that occur in ``codes``."""
    links, lengths, moves, last = [-1], [0], [{}], 0
    for code in codes:
        new = len(moves)
        moves.append({})
        lengths.append(lengths[last] + 1)
        links.append(0)
        at = last
        while at >= 0 and code not in moves[at]:
            moves[at][code] = new
            at = links[at]
        if at >= 0:
            there = moves[at][code]
            if lengths[at] + 1 != lengths[there]:
                copy = len(moves)
                moves.append(dict(moves[there]))
                lengths.append(lengths[at] + 1)
                links.append(links[there])
                while at >= 0 and moves[at].get(code) == there:
                    moves[at][code] = copy
                    at = links[at]
                links[there] = there = copy
            links[new] = there
        last = new
    return moves


def code_table(letters: str) -> np.ndarray:
    """Code of each code point: upper and lower case alike, all but letters as one gap."""
    table = np.where(char_classes() == LETTER, RARE, GAP).astype(np.int32)
    for code, letter in enumerate(letters, 2):
        for char in {letter, letter.upper(), letter.lower()}:
            if len(char) == 1:
                table[ord(char)] = code
    return table


def codes_of(text: str, table: np.ndarray) -> np.ndarray:
    """Codes of a text; a run of other characters than letters is one gap."""
    codes = table[code_points(text)]
    return codes[np.concatenate(([True], (codes[1:] != GAP) | (codes[:-1] != GAP)))] if len(codes) else codes


class Language:
    """One learned language: its automaton as a table of moves by state and code, its own letters only.

    A move is twice where the next state's row begins, plus 1 where a phrase ended before this character. A
    code that occurs nowhere in the language is a phrase of its own. ``own`` has its code for each code of all languages.
    """

    def __init__(self, codes: np.ndarray, alphabet: int):
        letters = np.unique(codes[codes > RARE])
        self.own = np.full(alphabet, RARE, np.int32)
        self.own[GAP], self.own[letters] = GAP, np.arange(2, len(letters) + 2)
        moves, width = suffix_automaton(self.own[codes].tolist()), len(letters) + 2
        unknown = len(moves)  # the state behind a code that occurs nowhere
        states = np.repeat(np.arange(len(moves)), [len(row) for row in moves])
        at = states.astype(np.int64) * width + np.array([code for row in moves for code in row], np.int64)
        to = np.array([state for row in moves for state in row.values()], np.int64)
        again = np.full(width, unknown, np.int64)
        again[at[states == 0]] = to[states == 0]
        self.keys: np.ndarray | None = None
        if (unknown + 1) * width <= FULL_TABLE:
            table = np.tile(again * width * 2 + 1, (unknown + 1, 1))
            table[0] -= 1
            table.reshape(-1)[at] = to * width * 2
            self.moves = table.ravel().astype(np.int32)
        else:
            # The row of the first state is whole: it says where a text goes on that fits nowhere.
            order = np.argsort(at[states > 0], kind="stable")
            self.keys, self.moves, self.again = at[states > 0][order], to[states > 0][order] * width * 2, again * width * 2

    def start(self, lanes: int) -> np.ndarray:
        return np.zeros(lanes, np.int32 if self.keys is None else np.int64)

    def move(self, state: np.ndarray, codes: np.ndarray) -> np.ndarray:
        own = self.own[codes]
        at = state + own
        if self.keys is None:
            return self.moves[at]
        place = np.minimum(np.searchsorted(self.keys, at), len(self.keys) - 1)
        return np.where(self.keys[place] == at, self.moves[place], self.again[own] + (state > 0))


class Languages:
    """The learned languages, in alphabetical order. Every letter of the sample has its own code."""

    def __init__(self, samples: dict[str, list[str]]):
        self.names = sorted(samples)
        self.letters = "".join(sorted({c for texts in samples.values() for t in texts for c in t.lower() if c.isalpha()}))
        codes = code_table(self.letters)
        self.learned = [Language(np.concatenate([np.append(codes_of(t, codes), GAP) for t in samples[name]]), len(self.letters) + 2) for name in self.names]
        self._codes: np.ndarray | None = None

    def __getstate__(self):
        return self.__dict__ | {"_codes": None}

    def phrases(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Phrases per character [text, language], and whether a text has a letter."""
        if self._codes is None:
            self._codes = code_table(self.letters)
        coded = [codes_of(t, self._codes) for t in texts]
        lengths = np.array([len(c) for c in coded])
        lettered = np.array([bool((c != GAP).any()) for c in coded])
        counts = np.zeros((len(self.names), len(texts)), np.int64)
        stretches = -(-lengths // STRETCH)
        owner = np.repeat(np.arange(len(texts)), stretches)
        if not len(owner) or not self.names:
            return (counts / np.maximum(lengths, 1)).T, lettered
        within = np.arange(len(owner)) - np.repeat(np.cumsum(stretches) - stretches, stretches)
        begin = np.repeat(np.cumsum(lengths) - lengths, stretches) + within * STRETCH
        size = np.minimum(lengths[owner] - within * STRETCH, STRETCH)
        order = np.argsort(-size, kind="stable")
        owner, begin, size = owner[order], begin[order], size[order]
        every = np.concatenate(coded).astype(np.int32)
        running = np.searchsorted(-size, -np.arange(1, int(size[0]) + 1), side="right").tolist()
        for k, learned in enumerate(self.learned):
            state, ended = learned.start(len(owner)), np.zeros(len(owner), np.int32)
            for step, lanes in enumerate(running):
                moved = learned.move(state[:lanes], every[begin[:lanes] + step])
                ended[:lanes] += moved & 1
                state[:lanes] = moved >> 1
            counts[k] = np.bincount(owner, ended + 1, len(texts))
        return (counts / np.maximum(lengths, 1)).T, lettered

    def predict(self, texts: list[str]) -> list[tuple[str, float]]:
        """Language and score: how much fewer phrases it needs than the next one. Ties go by name."""
        rates, lettered = self.phrases(texts)
        out = []
        for rate, letters in zip(rates, lettered):
            if not letters or not self.names:
                out.append(("und", 0.0))
                continue
            best = int(np.argmin(rate))
            rest = np.delete(rate, best)
            out.append((self.names[best], float(1 - rate[best] / rest.min()) if len(rest) else 1.0))
        return out


def held_out(key: Column) -> Column:
    return F.crc32(key.cast("string").cast("binary")) % 5 == 0


def learn(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang", rows: int = SAMPLE_ROWS, chars: int = SAMPLE_CHARS) -> Languages:
    """Languages from at most ``rows`` labelled rows and ``chars`` characters each, of rows not held out.

    The rows are those of the lowest key hashes, so they do not depend on the order of the input.
    """
    labelled = docs.where(column(lang).isNotNull() & column(text).isNotNull() & ~F.coalesce(held_out(column(key)), F.lit(True)))
    drawn = labelled.select(column(lang).alias("lang"), F.struct(F.xxhash64(column(key).cast("string")).alias("h"), column(key).alias("key")).alias("row"))
    first = drawn.withColumn("n", F.row_number().over(Window.partitionBy("lang").orderBy("row"))).where(F.col("n") <= rows)
    wanted = [r.key for r in first.select("row.key").collect()]
    if not wanted:
        return Languages({})
    taken = labelled.where(column(key).isin(wanted)).select(column(lang).alias("lang"), column(key).alias("key"), F.substring(column(text), 1, chars).alias("text"))
    # A key may be repeated without bound: rows are drawn again, not keys.
    taken = taken.withColumn("n", F.row_number().over(Window.partitionBy("lang").orderBy(F.xxhash64(F.col("key").cast("string")), "key", "text"))).where(F.col("n") <= rows)
    samples: dict[str, list[str]] = {}
    for row in sorted(taken.collect(), key=lambda r: (r.lang, str(r.key), r.text)):
        held = samples.setdefault(row.lang, [])
        left = chars - sum(map(len, held))
        if left > 0 and row.text:
            held.append(row.text[:left])
    return Languages({name: texts for name, texts in samples.items() if texts})


def identify(docs: DataFrame, languages: Languages, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, ``lang_pred`` and ``score`` (0 to 1) for each row, from the whole text.

    ``und`` with score 0 for a text that is null, empty or without a letter. Other columns are not carried.
    """
    shared = docs.sparkSession.sparkContext.broadcast(languages)  # bounded by the sample
    source = keyed_text(docs, key, text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for keys, texts in text_batches(batches):
            found = shared.value.predict(texts)
            yield pa.RecordBatch.from_arrays([keys, pa.array([x[0] for x in found]), pa.array([x[1] for x in found], pa.float64())], [key, "lang_pred", "score"])

    return source.mapInArrow(run, f"`{key}` {source.schema['key'].dataType.simpleString()}, lang_pred string, score double")
