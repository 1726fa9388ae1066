"""Benchmark decontamination: parts of pieces counted in diagonal bands, then bit-parallel alignment.

Texts are reduced to lower-case letters and digits with single spaces. Every benchmark item gives
pieces of at most 48 characters, one every 6. A document region that is within ``edits`` of a piece
of m characters (an eighth of it: 6 of 48) has at least ``m // q - edits`` of the piece's q-grams that
stand side by side, all on diagonals that lie within ``edits`` of each other. So such parts are counted
in bands of diagonals of twice that width, half overlapping, and only regions with enough are aligned.
So any exact quotation of 53 reduced characters of an item is found wherever it starts. Items too short
for pieces are found by exact match between word boundaries.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from listlake.llm.common import BASE, fingerprinted, slices

Q = 6
PIECE = 48
STRIDE = 6
#: Items under this many characters are searched whole and without edits.
SHORTEST = 30
ERROR = 0.125
#: First and last characters of scripts without spaces: Thai, Lao, Burmese, Khmer; Chinese and Japanese.
UNSPACED = ((0x0E00, 0x0EFF), (0x1000, 0x109F), (0x1780, 0x17FF), (0x2E80, 0x312F), (0x31A0, 0xA4CF), (0xF900, 0xFAFF), (0xFF66, 0xFF9F), (0x20000, 0x3FFFF))
#: Benchmark rows in one pass over the documents; a larger benchmark takes several passes.
ROWS_A_PASS = 20_000
#: Places of equal parts that are held in memory together, or those of one row.
HITS_AT_ONCE = 4_000_000
#: Entries of a table of pieces and symbols; a larger benchmark works with the symbols' bits.
DENSE = 2_000_000
#: Bytes of text searched together: few enough for the processor's caches.
SLICE = 512 << 10


def _classes() -> np.ndarray:
    """For each code point below 0x3000: itself in lower case if a letter or digit, else a space."""
    out = np.full(0x3000, 32, np.uint32)
    for c in range(0x3000):
        if chr(c).isalnum():
            low = chr(c).lower()
            out[c] = ord(low) if len(low) == 1 else c
    return out


CLASSES = _classes()


class Reduced:
    """All reduced texts of a batch in one array: ``codes`` with a zero after each row, ``offsets`` of the rows."""

    def __init__(self, texts: list[str | None]):
        joined = "\0".join(t or "" for t in texts) + "\0"
        raw = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
        self.starts = np.concatenate([[0], np.cumsum([len(t or "") + 1 for t in texts])])
        codes = CLASSES[np.minimum(raw, 0x2FFF)]
        if len(raw) and raw.max() >= 0x3000:
            codes = np.where(raw < 0x3000, codes, raw)
        codes[self.starts[1:] - 1] = 0
        gap = codes <= 32
        keep = codes != 32
        keep[1:] |= ~gap[:-1]
        self.codes, self.keep = codes[keep], keep
        self.offsets = np.concatenate([[0], np.flatnonzero(self.codes == 0) + 1])
        self._places: np.ndarray | None = None

    def place(self, row: int, at: int) -> int:
        """Where the reduced character at ``at`` stands in its own text."""
        if self._places is None:
            self._places = np.flatnonzero(self.keep)
        return int(self._places[at] - self.starts[row])


def stripped(text: str) -> np.ndarray:
    """The reduced text of an item."""
    codes = Reduced([text]).codes[:-1]
    return codes[:-1] if len(codes) and codes[-1] == 32 else codes


def gram_hashes(ids: np.ndarray, q: int) -> np.ndarray:
    """A hash of the q symbols from each place; equal symbols, equal hash."""
    n = max(0, len(ids) - q + 1)
    out, wide = np.zeros(n, np.uint64), ids.astype(np.uint64)
    for i in range(q):
        out *= np.uint64(BASE)
        out += wide[i : i + n]
    return out


def groups(first: np.ndarray, index: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For lists kept one after the other: all members of the lists at ``index``, and whose each is."""
    times = first[index + 1] - first[index]
    inner = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
    return np.repeat(first[index], times) + inner, np.repeat(np.arange(len(index)), times)


class Pieces:
    """The benchmark's pieces and an index of their parts, the q-grams that stand side by side in a piece."""

    def __init__(self, items: list[tuple[int, str]], q: int, piece: int, stride: int, shortest: int, error: float):
        if piece > 64 or shortest < 2 * q:
            raise ValueError("a piece has 64 characters at most, and two parts at least")
        self.q, self.item, self.codes, self.edits, self.start, owner, place, whole, base = q, [], [], [], [], [], [], [], 0
        for item, text in items:
            codes = stripped(text)
            if len(codes) < shortest:
                continue
            starts = [*range(0, max(1, len(codes) - piece), stride), max(0, len(codes) - piece)]
            for start in dict.fromkeys(starts):
                part = codes[start : start + piece]
                n = len(part) // q
                owner.append(np.full(n, len(self.item)))
                place.append(base + start + q * np.arange(n))
                self.item.append(item)
                self.codes.append(part)
                self.start.append(base + start)
                # Of n parts that do not overlap, n - edits stay as they are; two of them at least.
                self.edits.append(min(int(error * len(part)), n - 2))
            whole.append(codes)
            base += len(codes)
        self.length = np.array([len(c) for c in self.codes], np.int64)
        self.edits = np.array(self.edits, np.int64)
        self.start = np.array(self.start, np.int64)
        self.need = self.length // q - self.edits
        self.most, self.longest, self.total = int(self.edits.max(initial=0)), int(self.length.max(initial=0)), base
        text = np.concatenate(whole) if whole else np.zeros(0, np.uint32)
        self.alphabet = np.unique(text)
        self.table = np.zeros(0x3000, np.uint32)
        low = np.flatnonzero(self.alphabet < 0x3000)
        self.table[self.alphabet[low]] = low + 1
        ids = self.symbols(text)
        # Bit b of a piece's symbols, the j-th symbol's at j: forwards, and from the piece's end.
        self.planes = np.zeros((2, len(self.alphabet).bit_length(), len(self.item)), np.uint64)
        for n, part in enumerate(self.codes):
            own = self.symbols(part).astype(np.uint64)
            at = np.arange(len(own), dtype=np.uint64)
            for b in range(self.planes.shape[1]):
                bit = own >> np.uint64(b) & np.uint64(1)
                self.planes[0, b, n], self.planes[1, b, n] = (bit << at).sum(), (bit[::-1] << at).sum()
        place, owner = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (place, owner))
        self.parts, part = np.unique(place, return_inverse=True)
        order = np.argsort(part, kind="stable")
        self.owner, self.owners = owner[order], np.searchsorted(part[order], np.arange(len(self.parts) + 1))
        h = gram_hashes(ids, q)[self.parts]
        order = np.argsort(h, kind="stable")
        self.place = self.parts[order]
        self.keys, first = np.unique(h[order], return_index=True)
        self.first = np.append(first, len(h))
        self.dense: np.ndarray | None = None
        self.bits = np.zeros(1 << 20, bool)
        self.bits[(self.keys >> np.uint64(44)).astype(np.int64)] = True

    def __getstate__(self) -> dict:
        return self.__dict__ | {"codes": None, "dense": None}  # the planes have all that a search needs

    def symbols(self, codes: np.ndarray) -> np.ndarray:
        """1, 2, ... for the benchmark's characters, 0 for all others and for a row's end."""
        out = self.table[np.minimum(codes, 0x2FFF)]
        far = np.flatnonzero(codes >= 0x3000)
        if len(far):
            out[far] = 0
            if len(self.alphabet):
                at = np.minimum(np.searchsorted(self.alphabet, codes[far]), len(self.alphabet) - 1)
                out[far] = np.where(self.alphabet[at] == codes[far], at + 1, 0)
        return out

    def candidates(self, ids: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
        """Row, piece and lowest diagonal of the bands that have enough of a piece's parts."""
        if not len(self.keys):
            return
        h = gram_hashes(ids, self.q)
        near = np.flatnonzero(self.bits[(h >> np.uint64(44)).astype(np.int64)])
        at = np.minimum(np.searchsorted(self.keys, h[near]), len(self.keys) - 1)
        same = self.keys[at] == h[near]
        near, at = near[same], at[same]
        # Whole rows together, about HITS_AT_ONCE hits at a time.
        ends = np.searchsorted(near, offsets[1:])
        hits = np.append(0, np.cumsum(self.first[at + 1] - self.first[at]))[ends]
        cuts = ends[:-1][np.diff(hits // HITS_AT_ONCE) > 0]
        for start, end in zip([0, *cuts], [*cuts, len(near)], strict=True):
            if start < end:
                yield self._bands(near[start:end], at[start:end], len(ids), offsets)

    def _bands(self, near: np.ndarray, at: np.ndarray, n: int, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
        entry, of = groups(self.first, at)
        pos = near[of]
        width = self.most + 1
        diagonal = pos - self.place[entry] + self.total
        band = diagonal // width
        rest = diagonal - band * width
        # A band covers two steps of ``width``, so regions within ``most`` diagonals fit in one whole.
        low_bits, bits = (2 * width).bit_length(), n.bit_length() + 1
        key = (band + 1 << bits | pos) << low_bits | rest
        keys = np.sort(np.concatenate([key, key - (1 << bits + low_bits) + width]))
        # Only parts with another one of the same band near them can be two of one piece.
        close = np.diff(keys) <= (self.longest - self.q + self.most + 1 << low_bits)
        kept = np.zeros(len(keys), bool)
        kept[1:] = close
        kept[:-1] |= close
        keys = keys[kept]
        band, pos = keys >> bits + low_bits, keys >> low_bits & (1 << bits) - 1
        place = pos - ((band - 1) * width + (keys & (1 << low_bits) - 1)) + self.total
        entry, of = groups(self.owners, np.searchsorted(self.parts, place))
        piece, band, gram = self.owner[entry], band[of], place[of]
        row = np.searchsorted(offsets, pos, "right")[of] - 1
        # Each of a piece's parts counts once in a band, as an alignment uses it once.
        own, bands, spread = row * len(self.item) + piece, int(band.max(initial=0)) + 1, self.total + 1
        key = own * bands + band
        order = np.lexsort((gram, key)) if (int(key.max(initial=0)) + 1) * spread >= 2**63 else np.argsort(key * spread + gram)
        key, gram = key[order], gram[order]
        new = np.ones(len(key), bool)
        new[1:] = key[1:] != key[:-1]
        fresh = new.copy()
        fresh[1:] |= gram[1:] != gram[:-1]
        first = np.flatnonzero(new)
        counts = np.add.reduceat(fresh.astype(np.int64), first) if len(first) else first
        key = key[first[counts >= self.need[(key[first] // bands) % max(1, len(self.item))]]]
        # Of two bands next to each other one alignment takes both.
        after = np.zeros(len(key), bool)
        after[1:] = key[1:] == key[:-1] + 1
        index = np.arange(len(key))
        key = key[(index - np.maximum.accumulate(np.where(after, 0, index))) % 2 == 0]
        own, band = np.divmod(key, bands)
        row, piece = np.divmod(own, max(1, len(self.item)))
        # The diagonal's zero is where a piece's own text would begin.
        return row, piece, (band - 1) * width - self.total

    def hits(self, ids: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
        """Row, piece, edits, first and end place of the regions within a piece's edits."""
        for rows, pieces, lows in self.candidates(ids, offsets):
            for i in range(0, len(rows), 1 << 13):
                r, p, low = (x[i : i + (1 << 13)] for x in (rows, pieces, lows))
                low = low + self.start[p]
                a = np.maximum(offsets[r], low - self.most)
                b = np.minimum(offsets[r + 1] - 1, low + 3 * (self.most + 1) + self.most + self.length[p])
                edits, steps = self._fewest(ids, p, a, b - a, 1)
                good = edits <= self.edits[p]
                r, p, a, edits, end = r[good], p[good], a[good], edits[good], (a + steps)[good]
                _, back = self._fewest(ids, p, end - 1, end - a, -1)
                yield r, p, edits, end - back, end

    def _fewest(self, ids: np.ndarray, piece: np.ndarray, at: np.ndarray, steps: np.ndarray, way: int) -> tuple[np.ndarray, np.ndarray]:
        """Fewest edits of each piece, and after how many steps: forwards from any place, backwards from the first.

        Myers' bit vectors, one 64-bit word a piece.
        """
        one = np.uint64(1)
        score = self.length[piece]
        shift = (score - 1).astype(np.uint64)
        best = score << 32  # and the steps below it
        plus, minus = np.full(len(piece), ~np.uint64(0)), np.zeros(len(piece), np.uint64)
        all_run = int(steps.min(initial=0))
        equals = self._equals(0 if way > 0 else 1, piece)
        for j in range(int(steps.max(initial=0))):
            equal = equals(ids[np.clip(at + way * j, 0, len(ids) - 1)])
            down = equal | minus
            across = (((equal & plus) + plus) ^ plus) | equal
            up = minus | ~(across | plus)
            less = plus & across
            score = score + ((up >> shift & one) - (less >> shift & one)).view(np.int64)
            up = up << one
            if way < 0:
                up |= one
            plus, minus = less << one | ~(down | up), up & down
            now = score << 32 | j + 1
            best = np.minimum(best, now if j < all_run else np.where(j < steps, now, best))
        return best >> 32, best & 0xFFFFFFFF

    def _equals(self, way: int, piece: np.ndarray):
        """A function from a symbol for each piece to the bits where the piece has it."""
        size = len(self.alphabet) + 1
        if len(self.item) * size <= DENSE:
            if self.dense is None:
                self.dense = np.zeros((2, len(self.item), size), np.uint64)
                for symbol in range(1, size):
                    self.dense[:, :, symbol] = ~self._differ(self.planes, np.uint64(symbol))
            table, base = self.dense[way].reshape(-1), piece * size
            return lambda symbols: table[base + symbols]
        planes = self.planes[way][:, piece]
        return lambda symbols: ~self._differ(planes[None], symbols.astype(np.uint64))[0]

    @staticmethod
    def _differ(planes: np.ndarray, symbol: np.ndarray) -> np.ndarray:
        out = np.zeros((planes.shape[0], planes.shape[2]), np.uint64)
        for b in range(planes.shape[1]):
            out |= planes[:, b] ^ (np.zeros(1, np.uint64) - (symbol >> np.uint64(b) & np.uint64(1)))
        return out


def no_spaces(codes: np.ndarray) -> np.ndarray:
    """Which characters belong to scripts that put no spaces between words, so that one may end anywhere."""
    out = np.zeros(len(codes), bool)
    for a, b in UNSPACED:
        out |= (codes >= a) & (codes <= b)
    return out


class Shorts:
    """Benchmark items under ``shortest`` reduced characters, by their text."""

    def __init__(self, items: list[tuple[int, str]], shortest: int):
        self.items: dict[bytes, list[int]] = {}
        lengths: dict[int, set[int]] = {}
        for item, text in items:
            codes = stripped(text)
            if 0 < len(codes) < shortest:
                self.items.setdefault(codes.tobytes(), []).append(item)
                lengths.setdefault(len(codes), set()).add(int(gram_hashes(codes, len(codes))[0]))
        self.hashes = {n: np.array(sorted(x), np.uint64) for n, x in sorted(lengths.items())}

    def hits(self, codes: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[int, int, int, int]]:
        """Row, item, first and end place of each item's first occurrence in a row."""
        if not self.hashes:
            return
        free = no_spaces(codes)
        edge = np.ones(len(codes), bool)  # a word may begin here, or end before
        edge[1:] = (codes[1:] <= 32) | (codes[:-1] <= 32) | free[1:] | free[:-1]
        begins = np.flatnonzero(edge & (codes > 32))
        for n, hashes in self.hashes.items():
            at = begins[begins + n < len(codes)]
            at = at[edge[at + n]]
            h = np.zeros(len(at), np.uint64)
            for i in range(n):
                h = h * np.uint64(BASE) + codes[at + i]
            near = np.minimum(np.searchsorted(hashes, h), len(hashes) - 1)
            at, near = at[hashes[near] == h], near[hashes[near] == h]
            row = np.searchsorted(offsets, at, "right") - 1
            _, first = np.unique(row * len(hashes) + near, return_index=True)
            for r, a in zip(row[first].tolist(), at[first].tolist(), strict=True):
                for item in self.items.get(codes[a : a + n].tobytes(), ()):
                    yield r, item, a, a + n


def find_items(
    docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id",
    q: int = Q, piece: int = PIECE, stride: int = STRIDE, shortest: int = SHORTEST, error: float = ERROR,
) -> DataFrame:
    """``<key>, <item>, pieces, edits, first_char, end_char``: the benchmark items found in each document.

    One row for a document row and an item; ``pieces`` of it were found, the best with so many ``edits``,
    from ``first_char`` to ``end_char`` of the text in code points. Null and empty texts hold nothing;
    items without a key, or without a letter or digit, are left out; items with equal texts are all
    reported. An item under ``shortest`` reduced characters counts as one piece without edits, and its
    first occurrence is given. Documents are read once for every ``ROWS_A_PASS`` items.
    """
    rows = docs.select(F.col(key).cast("long").alias("id"), F.col(text).cast("string").alias("text")).filter("text is not null")
    items = benchmark.select(F.col(item).cast("long").alias("item"), F.col(text).cast("string").alias("text")).dropna()
    passes = max(1, -(-items.count() // ROWS_A_PASS))

    def search(wanted: DataFrame) -> DataFrame:
        given = [(r["item"], r["text"]) for r in wanted.orderBy("item", "text").toLocalIterator()]
        found = Pieces(given, q, piece, stride, shortest, error), Shorts(given, shortest)
        pieces = rows.sparkSession.sparkContext.broadcast(found)  # at most about ROWS_A_PASS items

        def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            p, shorts = pieces.value
            for batch in slices(batches, "text", SLICE):
                texts = Reduced(batch.column("text").to_pylist())
                best: dict[tuple[int, int], list] = {}
                for hits in p.hits(p.symbols(texts.codes), texts.offsets):
                    for r, n, edits, first, end in zip(*(x.tolist() for x in hits), strict=True):
                        span = [edits, texts.place(r, first), texts.place(r, max(first, end - 1)) + 1]
                        known = best.setdefault((r, p.item[n]), [set(), *span])
                        known[0].add(n)
                        known[1:] = [min(known[1], edits), min(known[2], span[1]), max(known[3], span[2])]
                for r, i, first, end in shorts.hits(texts.codes, texts.offsets):
                    span = [0, texts.place(r, first), texts.place(r, end - 1) + 1]
                    known = best.setdefault((r, i), [set(), *span])
                    known[0].add(-1)
                    known[1:] = [0, min(known[2], span[1]), max(known[3], span[2])]
                if best:
                    ids = batch.column("id")
                    out = [(ids[r].as_py(), i, len(v[0]), *v[1:]) for (r, i), v in sorted(best.items())]
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out, strict=True)], ["id", "item", "pieces", "edits", "first_char", "end_char"])

        return rows.mapInArrow(work, "id long, item long, pieces long, edits long, first_char long, end_char long")

    parts = [search(items.filter(F.pmod(F.xxhash64("item"), F.lit(passes)) == i)) for i in range(passes)]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionAll(part)
    return out.select(F.col("id").alias(key), F.col("item").alias(item), "pieces", "edits", "first_char", "end_char")


def keep_clean(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id") -> DataFrame:
    """The rows of ``docs`` that hold no benchmark item, with all their columns.

    Each row is judged by its own text, whatever its key: of rows with one key, or none, those without an
    item stay.
    """
    rows, row = fingerprinted(docs, key, text)
    bad = find_items(rows.select(row, text), benchmark, row, text, item).select(row).distinct()
    return rows.join(bad, row, "left_anti").select(*docs.columns)
