"""Language identification by cross-parsing.

A suffix automaton of a language's labelled text tells the longest match of a new text from any place on.  Cutting the text into
such longest matches gives few phrases in its own language and many in others; phrases times log2 of the training size, per
symbol, estimates the cross-entropy, and the language with the least of it wins.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from turbilux.llm.text_arrays import blocks

# bounds of the labelled sample: documents of a language, and characters taken from each
SAMPLE_DOCS = 100
SAMPLE_CHARS = 500
# a text is parsed in stretches of so many symbols side by side; phrases go on from one to the next
STRETCH = 512
UNDETERMINED = "und"

_SPACE = 0


def training_sample(labelled: DataFrame, docs: int = SAMPLE_DOCS, chars: int = SAMPLE_CHARS) -> list[tuple[str, str]]:
    """(lang, text) with ``chars`` characters of at most ``docs`` different texts of each language.

    Texts, and the place where the characters begin, are chosen by hashes of the whole text, so copies count once and a shared
    heading is not all that is learnt.  ``labelled`` needs lang and text; rows where either is null are left out.
    """
    room = F.greatest(F.char_length("text") - F.lit(chars) + 1, F.lit(1))
    begin = (F.pmod(F.xxhash64("text", F.lit(1)), room) + 1).cast("int")
    order = Window.partitionBy("lang").orderBy("whole", "text")
    chosen = (
        labelled.where("lang is not null and text rlike '[\\\\p{L}]'")
        .select("lang", F.xxhash64("text").alias("whole"), F.col("text").substr(begin, F.lit(chars)).alias("text"))
        .distinct()
        .withColumn("n", F.row_number().over(order))
        .where(F.col("n") <= docs)
    )
    return sorted((r["lang"], r["text"]) for r in chosen.select("lang", "text").collect())


def suffix_automaton(symbols: list[int], size: int) -> np.ndarray:
    """Transitions of the automaton of all substrings: state x symbol, -1 where there is none; state 0 is the empty string."""
    moves: list[dict[int, int]] = [{}]
    link, length, last = [-1], [0], 0
    for c in symbols:
        now = len(moves)
        moves.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p != -1 and c not in moves[p]:
            moves[p][c] = now
            p = link[p]
        if p != -1:
            q = moves[p][c]
            if length[p] + 1 == length[q]:
                link[now] = q
            else:
                copy = len(moves)
                moves.append(dict(moves[q]))
                length.append(length[p] + 1)
                link.append(link[q])
                while p != -1 and moves[p].get(c) == q:
                    moves[p][c] = copy
                    p = link[p]
                link[q] = link[now] = copy
        last = now
    table = np.full((len(moves), size), -1, np.int32)
    for state, out in enumerate(moves):
        for c, to in out.items():
            table[state, c] = to
    return table


class Parser:
    """Cross-parsing of many texts against all languages of a sample."""

    def __init__(self, sample: tuple[tuple[str, str], ...]):
        texts: dict[str, str] = {}
        for lang, text in sample:
            texts[lang] = texts.get(lang, "") + " " + text.lower()
        self.languages = sorted(texts)
        letters = sorted({c for t in texts.values() for c in t if c.isalpha()})
        # 0 is a space, then the letters seen, any other letter, and the filler after a text's end
        self.other, self.filler = len(letters) + 1, len(letters) + 2
        table = np.zeros(0x110000, np.uint16)
        table[[i for i in range(0x110000) if chr(i).isalpha()]] = self.other
        for i, c in enumerate(letters):
            table[ord(c)] = i + 1
        self._symbol_of = table
        self._steps, self._bits = [], []
        width = len(letters) + 3
        for lang in self.languages:
            symbols = self.symbols([texts[lang]])[0]
            self._bits.append(math.log2(max(len(symbols), 2)))
            self._steps.append(self._with_restarts(suffix_automaton(symbols.tolist(), width)))
        self.width = width

    def _with_restarts(self, moves: np.ndarray) -> np.ndarray:
        """4 x next state + the phrases that end: a phrase that cannot go on ends, and the symbol begins the next one;
        a symbol the language does not have is a phrase of its own."""
        known = moves[0] >= 0
        ends = (np.arange(len(moves)) > 0)[:, None] + np.where(known, 0, 1)[None, :]
        steps = np.where(moves >= 0, moves * 4, np.maximum(moves[0], 0)[None, :] * 4 + ends).astype(np.int32)
        steps[:, self.filler] = np.arange(len(moves)) * 4
        return steps.reshape(-1)

    def symbols(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Symbols of all lower-cased texts, runs of non-letters as one space, and how many each text has."""
        codes = np.frombuffer("".join(texts).encode("utf-32-le", "replace"), np.uint32)
        symbols = self._symbol_of[codes]
        owner = np.repeat(np.arange(len(texts)), [len(t) for t in texts])
        keep = np.ones(len(symbols), bool)
        keep[1:] = (symbols[1:] != _SPACE) | (symbols[:-1] != _SPACE) | (owner[1:] != owner[:-1])
        return symbols[keep], np.bincount(owner[keep], minlength=len(texts))

    def entropies(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Estimated bits per symbol (text x language), and whether the text has a letter."""
        symbols, counts = self.symbols(texts)
        ends = np.cumsum(counts)
        letters = np.concatenate([[0], np.cumsum(symbols != _SPACE)])
        has_letter = letters[ends] > letters[ends - counts]
        lanes = -(-counts // STRETCH)
        owner = np.repeat(np.arange(len(texts)), lanes)
        first = np.repeat(ends - counts, lanes) + STRETCH * (np.arange(len(owner)) - np.repeat(np.cumsum(lanes) - lanes, lanes))
        limit = ends[owner]
        phrases = np.zeros((len(texts), len(self.languages)))
        columns = []
        for k in range(STRETCH):
            at = first + k
            columns.append(np.where(at < limit, symbols[np.minimum(at, max(len(symbols) - 1, 0))], self.filler).astype(np.int32))
        table = np.stack(columns) if len(owner) else np.zeros((STRETCH, 0), np.int32)
        opening = np.ones(len(owner), bool)
        opening[1:] = owner[1:] != owner[:-1]
        closing = np.append(opening[1:], True)[: len(owner)]
        for j, steps in enumerate(self._steps):
            ended, last = self._parsed(steps, table, opening)
            ended += closing & (last > 0)
            phrases[:, j] = np.bincount(owner, ended, minlength=len(texts)) * self._bits[j]
        return phrases / np.maximum(counts, 1)[:, None], has_letter

    def _parsed(self, steps: np.ndarray, table: np.ndarray, opening: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Phrases that end in each stretch, and the state behind it.

        All stretches are parsed as if a phrase began with them, then again those that are entered in another state, until
        every stretch begins in the state in which the one before ended.  Parses that begin differently soon meet, so two
        rounds are usual; a text that is one long match takes a round for each of its stretches.
        """
        lanes = table.shape[1]
        entered, left, ended = (np.zeros(lanes, np.int32) for _ in range(3))
        due = np.arange(lanes)
        while len(due):
            state, count = entered[due], np.zeros(len(due), np.int32)
            for column in table[:, due]:
                step = steps[state * self.width + column]
                count += step & 3
                state = step >> 2
            left[due], ended[due] = state, count
            before = np.concatenate([[0], left[:-1]])
            before[opening] = 0
            due = np.flatnonzero(before != entered)
            entered[due] = before[due]
        return ended, left

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        """Language and score, the margin of the best over the second, from 0 to 1."""
        if not self.languages or not texts:
            return [UNDETERMINED] * len(texts), [0.0] * len(texts)
        bits, has_letter = self.entropies([(t or "").lower() for t in texts])
        best = bits.argmin(axis=1)
        ordered = np.sort(bits, axis=1)
        score = 1 - ordered[:, 0] / ordered[:, 1].clip(1e-9) if bits.shape[1] > 1 else np.ones(len(texts))
        langs = [self.languages[b] if h else UNDETERMINED for b, h in zip(best, has_letter)]
        return langs, np.where(has_letter, score.clip(0, 1), 0.0).tolist()


@functools.lru_cache(maxsize=2)
def _parser(sample: tuple[tuple[str, str], ...]) -> Parser:
    """Each Python worker builds the automata once."""
    return Parser(sample)


def predict_language(docs: DataFrame, sample: list[tuple[str, str]]) -> DataFrame:
    """doc_id, lang_pred and score of every whole text.

    ``docs`` needs doc_id and text; other columns are ignored.  A text that is null or has no letter is ``und`` with score 0;
    equal estimates go to the language first in order.  Without a sample all is ``und``.  ``sample`` comes from
    training_sample and is what executors receive: at most languages x SAMPLE_DOCS x SAMPLE_CHARS characters.
    """
    frozen = tuple(sample)

    def run(batches: Iterator[pa.RecordBatch]):
        parser = _parser(frozen)
        for batch in batches:
            for block in blocks(batch, "text"):
                langs, scores = parser.predict(block.column("text").to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [block.column("doc_id"), pa.array(langs, pa.string()), pa.array(scores, pa.float64())],
                    ["doc_id", "lang_pred", "score"],
                )

    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return docs.mapInArrow(run, "doc_id long, lang_pred string, score double")
