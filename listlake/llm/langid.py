"""Language identification by cross-parsing entropy.

Texts are reduced to lower-case letters with single spaces. For each language a suffix automaton of a
bounded sample of labelled text knows every string of the sample. A text is parsed from left to right
into the longest strings that the automaton knows; the fewer phrases a language needs for a letter, the
closer it is, and the language that needs fewest wins. The automata are turned into dense tables, so
that many stretches of text take each step together.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from listlake.llm.common import fold, slices

#: Letters of a language's sample, rows it is taken from at most, and letters from one row at most.
SAMPLE, ROWS, FROM_A_ROW = 20_000, 40, 2_000
#: A parse starts anew after so many letters, so that very long texts are many equal stretches.
STRETCH = 1024
UNKNOWN = "und"


def _letters() -> np.ndarray:
    """For each code point below 0x3000: itself in lower case if a letter, else a space."""
    out = np.full(0x3000, 32, np.uint32)
    for c in range(0x3000):
        if chr(c).isalpha():
            low = chr(c).lower()
            out[c] = ord(low) if len(low) == 1 else c
    return out


LETTERS = _letters()


def reduced(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """The letters of all rows with single spaces between words, a zero after each row, and the rows' offsets."""
    joined = "\0".join(t or "" for t in texts) + "\0"
    raw = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    ends = np.cumsum([len(t or "") + 1 for t in texts]) - 1
    codes = LETTERS[np.minimum(raw, 0x2FFF)]
    far = np.flatnonzero(raw >= 0x3000)
    codes[far] = [c if chr(c).isalpha() else 32 for c in raw[far].tolist()]
    codes[ends] = 0
    keep = codes != 32
    keep[1:] |= codes[:-1] > 32
    codes = codes[keep]
    return codes, np.concatenate([[0], np.flatnonzero(codes == 0) + 1])


class Automaton:
    """The suffix automaton of a sequence of symbols: states, transitions and suffix links."""

    def __init__(self, symbols: list[int]):
        self.next: list[dict[int, int]] = [{}]
        link, length, last = [-1], [0], 0
        for c in symbols:
            now = len(self.next)
            self.next.append({})
            length.append(length[last] + 1)
            link.append(0)
            p = last
            while p >= 0 and c not in self.next[p]:
                self.next[p][c] = now
                p = link[p]
            if p >= 0:
                q = self.next[p][c]
                if length[q] == length[p] + 1:
                    link[now] = q
                else:
                    copy = len(self.next)
                    self.next.append(dict(self.next[q]))
                    length.append(length[p] + 1)
                    link.append(link[q])
                    while p >= 0 and self.next[p].get(c) == q:
                        self.next[p][c] = copy
                        p = link[p]
                    link[q] = link[now] = copy
            last = now

    def table(self, symbols: int) -> np.ndarray:
        """``2 * next state + 1 if a phrase starts`` for each state and symbol.

        Where a state has no way on, its phrase is over and the next one starts with the symbol; a symbol
        that the sample lacks is a phrase of its own, after which the first state has none open.
        """
        first = np.ones(symbols, np.int32)
        for c, to in self.next[0].items():
            first[c] = 2 * to + 1
        out = np.repeat(first[None, :], len(self.next), 0)
        for state, ways in enumerate(self.next[1:], 1):
            for c, to in ways.items():
                out[state, c] = 2 * to
        return out


class Parser:
    """The automata of all learned languages over one alphabet."""

    def __init__(self, samples: tuple[tuple[str, str], ...]):
        self.languages = [name for name, _ in samples]
        texts = [reduced([text])[0][:-1] for _, text in samples]
        known = np.unique(np.concatenate(texts)) if texts else np.zeros(0, np.uint32)
        self.symbols = len(known) + 1  # the last one stands for all others
        self.index = np.full(0x110000, len(known), np.int32)
        self.index[known] = np.arange(len(known))
        self.tables = [Automaton(self.index[t].tolist()).table(self.symbols).ravel() for t in texts]

    def phrases(self, codes: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Phrases of each row in each language, and the letters of each row."""
        rows, sizes = len(offsets) - 1, np.diff(offsets) - 1
        parts = -(-sizes // STRETCH)
        row = np.repeat(np.arange(rows), parts)
        number = np.arange(len(row)) - np.repeat(np.cumsum(parts) - parts, parts)
        start = offsets[:-1][row] + number * STRETCH
        length = np.minimum(STRETCH, sizes[row] - number * STRETCH)
        order = np.argsort(-length, kind="stable")
        row, start, length = row[order], start[order], length[order]
        out = np.zeros((rows, len(self.tables)), np.int64)
        if not len(row):
            return out, sizes
        symbols = self.index[codes]
        # All stretches, long ones first, step side by side; those that have ended drop off the end.
        live = np.searchsorted(-length, -np.arange(int(length[0])), "left")
        for n, table in enumerate(self.tables):
            state, count = np.zeros(len(row), np.int32), np.zeros(len(row), np.int32)
            for step, lanes in enumerate(live.tolist()):
                to = table[state[:lanes] * self.symbols + symbols[start[:lanes] + step]]
                count[:lanes] += to & 1
                state[:lanes] = to >> 1
            out[:, n] = np.bincount(row, count, rows)
        return out, sizes


@lru_cache(maxsize=2)
def parser(samples: tuple[tuple[str, str], ...]) -> Parser:
    """Built once in each worker process from the samples."""
    return Parser(samples)


def shared_out(parts: list[str], most: int) -> str:
    """The beginnings of all parts, ``most`` characters or fewer together: equal shares, what short parts leave goes to the longer."""
    lengths, left = [0] * len(parts), most - len(parts)
    for done, n in enumerate(sorted(range(len(parts)), key=lambda n: len(parts[n]))):
        lengths[n] = max(0, min(len(parts[n]), left // (len(parts) - done)))
        left -= lengths[n]
    return " ".join(x[:n] for x, n in zip(parts, lengths, strict=True))


def learn(
    docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang", rows: int = ROWS, sample: int = SAMPLE, piece: int = FROM_A_ROW
) -> tuple[tuple[str, str], ...]:
    """``(language, sample)`` of each label, in code-point order; about ``sample`` characters each.

    The rows with the smallest hashes of each label, at most ``rows``, give a part from their middle each, none more than its share of ``sample`` unless others are shorter.
    """
    marked = docs.select(F.col(key).cast("long").alias("id"), F.col(lang).cast("string").alias("lang")).filter("lang is not null")
    counts = {r["lang"]: r["count"] for r in marked.groupBy("lang").count().collect()}  # a row per label
    if not counts:
        return ()
    # A few times as many rows as needed are left of a large label before they are ranked.
    share = F.element_at(F.create_map(*(F.lit(x) for name, n in counts.items() for x in (name, 8.0 * rows / n))), F.col("lang"))
    narrow = marked.withColumn("h", F.xxhash64("id", F.lit(5)))
    narrow = narrow.filter(F.pmod(F.xxhash64("id", F.lit(6)), F.lit(1 << 30)) / float(1 << 30) < share)
    place = F.row_number().over(Window.partitionBy("lang").orderBy("h", "id"))
    chosen = [r["id"] for r in narrow.withColumn("n", place).filter(F.col("n") <= rows).select("id").collect()]  # rows x labels
    from_docs = docs.select(F.col(key).cast("long").alias("id"), F.col(text).cast("string").alias("text"), F.col(lang).cast("string").alias("lang"))
    middle = F.greatest(F.lit(1), ((F.length("text") - piece) / 2).cast("int"))
    picked = from_docs.filter(F.col("id").isin(chosen) & F.col("lang").isNotNull() & F.col("text").isNotNull()).select("lang", "id", F.substr("text", middle, F.lit(piece)).alias("text"))
    by_lang: dict[str, list[str]] = {}
    for r in sorted(picked.dropDuplicates(["lang", "id"]).collect(), key=lambda r: (r["lang"], r["id"])):
        by_lang.setdefault(r["lang"], []).append(r["text"])
    return tuple((name, shared_out(parts, sample)) for name, parts in sorted(by_lang.items()))


def predict_languages(
    docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang", learn_from: Column | None = None
) -> DataFrame:
    """``<key>, held_out, lang_pred, score`` for every row of ``docs``.

    ``learn_from`` (on ``docs``) says which rows' labels may be used; by default those whose crc32 of the
    key modulo 4 is not 2. Null labels teach nothing. Texts that are null or without a letter are
    ``und`` with score 0, and so is everything if there is no label. Languages that need equally many
    phrases: the first in code-point order. The score is the winner's share when each language weighs
    ``exp(-phrases)``. Other columns are ignored.
    """
    learn_from = (fold(F.col(key)) != 2) if learn_from is None else learn_from
    samples = learn(docs.filter(learn_from), key, text, lang)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = parser(samples)
        names = np.array([*p.languages, UNKNOWN], object)
        for batch in slices(batches, "text", 8 << 20):
            phrases, letters = p.phrases(*reduced(batch.column("text").to_pylist()))
            if p.languages:
                best = np.argmin(phrases, axis=1)
                ahead = np.minimum(phrases - phrases.min(axis=1, keepdims=True), 700)
                score = 1 / np.exp(-ahead.astype(float)).sum(axis=1)
            else:
                best, score = np.zeros(len(letters), np.int64), np.zeros(len(letters))
            none = letters <= 0
            best, score = np.where(none | (not p.languages), len(names) - 1, best), np.where(none, 0.0, score)
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(names[best].tolist(), pa.string()), pa.array(score)], ["id", "lang_pred", "score"])

    rows = docs.select(F.col(key).cast("long").alias("id"), F.col(text).cast("string").alias("text"))
    out = rows.mapInArrow(work, "id long, lang_pred string, score double")
    return out.select(F.col("id").alias(key), (fold(F.col("id")) == 2).alias("held_out"), "lang_pred", "score")
