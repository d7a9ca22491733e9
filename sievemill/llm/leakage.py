"""Evaluation texts leaking into training text.

Item-sized windows of words are embedded by the CGK random walk, which maps
edit distance to Hamming distance: a pointer walks over the window, each step
writes the word it stands on and a random bit, a function of the step and the
word, says whether it moves on. Windows that agree on a sample of positions
of the walk meet in a bucket; enough repetitions with other walks and samples
reach the target recall. Each meeting is then verified by its exact edit
distance over words.
"""

from __future__ import annotations

import re
import unicodedata
import uuid
from collections.abc import Iterator
from functools import lru_cache, reduce
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sievemill.llm.lookalike import LOOKALIKES, UNUSUAL, plain_fold
from sievemill.session import cut

_MARKUP = re.compile(r"</?[A-Za-z][^<>]*>")
_WORD = re.compile(r"[^\W_]+")
_UNUSUAL = re.compile(UNUSUAL)
_MARKS = re.compile("[\u0300-\u036f]+")
_FOREIGN = str.maketrans(LOOKALIKES)
_ABROAD = re.compile("[\u0370-\u058f]")
#: Windows walked at a time, so that their arrays stay in a core's cache.
_SLICE = 1 << 15
#: Words of held-out items in one block (a broadcast of 8 bytes each) and in one stretch of an item.
BLOCK_WORDS, STRETCH = 400_000, 50_000
#: Pairs verified at a time.
_PAIRS = 1 << 18


def words_of(text: str | None) -> list[str]:
    """The words of a text, without anything that makes no difference.

    Markup, invisible characters, case, accents, width, look-alike letters,
    punctuation, quoting marks and line breaks are dropped. Null has no words.
    """
    if text is None:
        return []
    if not text.isascii():
        unusual = _UNUSUAL.search(text) is not None
        if unusual:
            text = plain_fold(text)
        text = _MARKS.sub("", unicodedata.normalize("NFKD", text))
        if unusual:
            if _ABROAD.search(text):
                text = text.translate(_FOREIGN)
            text = "".join(c for c in text if c.isascii() or not unicodedata.combining(c))
    if "<" in text:
        text = _MARKUP.sub(" ", text)
    return _WORD.findall(text.casefold())


class _Codes(dict):
    """A 64-bit code per word, the same in every process."""

    def __missing__(self, word: str) -> int:
        if len(self) > 500_000:
            self.clear()
        code = self[word] = xxhash.xxh64_intdigest(word)
        return code


def word_codes(words: list[str], memo: _Codes) -> np.ndarray:
    """The codes of a list of words."""
    return np.fromiter(map(memo.__getitem__, words), dtype=np.uint64, count=len(words))


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def cgk_buckets(codes: np.ndarray, width: int, repetition: int, sample: int, starts: np.ndarray | None = None) -> np.ndarray:
    """The buckets of the windows of ``width`` words, as int64.

    Windows begin at ``starts``, by default at every word that has a whole
    window after it. The walk has three times ``width`` steps; past the end of
    the window it stands on a pad. ``sample`` positions of the walk make the
    bucket. All random choices follow from the repetition's number.
    """
    if starts is None:
        starts = np.arange(max(0, len(codes) - width + 1))
    steps = 3 * width
    rng = np.random.default_rng(7919 * repetition + width)
    salts = rng.integers(0, 2**63, size=steps, dtype=np.int64).astype(np.uint64)
    kept = np.zeros(steps, dtype=bool)
    kept[rng.choice(steps, size=min(sample, steps), replace=False)] = True
    last = int(np.nonzero(kept)[0][-1]) + 1
    padded = np.append(codes, np.zeros(1, dtype=np.uint64))
    out = np.empty(len(starts), dtype=np.int64)
    with np.errstate(over="ignore"):
        for lo in range(0, len(starts), _SLICE):
            at = starts[lo : lo + _SLICE].copy()
            end = at + width
            bucket = np.full(len(at), repetition, dtype=np.uint64)
            for j in range(last):
                inside = at < end
                word = padded[np.minimum(at, len(codes))]
                word[~inside] = 0
                if kept[j]:
                    bucket = _mix(bucket * np.uint64(31) + word)
                # The walk's random bit: one multiplication mixes the word's code with the step's salt.
                at += (((word ^ salts[j]) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(63)).astype(np.int64) & inside
            out[lo : lo + _SLICE] = bucket.view(np.int64)
    return out


@lru_cache(maxsize=32)
def repetitions_for(max_edits: int, target_recall: float, width: int, sample: int, trials: int = 1500, most: int = 400) -> int:
    """Repetitions that reach the target recall for windows ``max_edits`` apart.

    Equal windows have equal walks, so one repetition finds all of them.
    Beyond that the walks themselves are tried on random windows with words
    substituted, with words inserted and with words left out; the kind that
    is found least often decides. The trials are the same in every process.
    """
    if max_edits == 0:
        return 1
    rng = np.random.default_rng(width)
    fresh = lambda: rng.integers(1, 2**63)
    before, after = [], []
    for k in range(3 * trials):
        text = rng.integers(1, 2**63, size=width + max_edits).tolist()
        other = list(text)
        for _ in range(max_edits if k % 3 == 0 else max_edits // 2):
            at = int(rng.integers(0, width))
            if k % 3 == 0:
                other[at] = fresh()
            elif k % 3 == 1:
                other.insert(at, fresh())
            else:
                del other[at]
        before.append(text[:width])
        after.append(other[:width])
    a, b = (np.array(x, dtype=np.uint64).reshape(-1) for x in (before, after))
    starts, met = np.arange(3 * trials) * width, np.zeros(3 * trials, dtype=bool)
    for r in range(most):
        met |= cgk_buckets(a, width, r, sample, starts) == cgk_buckets(b, width, r, sample, starts)
        if min(met[k::3].mean() for k in range(3)) >= target_recall:
            return r + 1
    raise ValueError(f"{most} repetitions don't reach a recall of {target_recall} with {sample} positions")


def edit_distances(a: np.ndarray, b: np.ndarray, limit: int) -> np.ndarray:
    """The exact edit distance of each row of ``a`` from that of ``b``, all of one width; ``limit`` + 1 stands for more.

    The usual table is filled along its diagonals within ``limit`` of the main one, for all pairs at once.
    """
    n, width = a.shape
    far = limit + 1
    band = 2 * limit + 1
    before = np.full((band + 1, n), far, dtype=np.int16)
    before[limit:band] = np.arange(limit + 1, dtype=np.int16)[:, None]
    for i in range(1, width + 1):
        now = np.full((band + 1, n), far, dtype=np.int16)
        for k in range(band):
            j = i + k - limit
            if j < 0 or j > width:
                continue
            best = np.minimum(before[k + 1], now[k - 1] if k else far) + 1
            if j:
                best = np.minimum(best, before[k] + (a[:, i - 1] != b[:, j - 1]))
            now[k] = np.minimum(best, far)
        before = now
    return before[limit]


def run_hashes(codes: np.ndarray, length: int) -> np.ndarray:
    """A hash of each run of ``length`` consecutive words."""
    out = np.zeros(max(0, len(codes) - length + 1), dtype=np.uint64)
    with np.errstate(over="ignore"):
        for j in range(length):
            out = _mix(out * np.uint64(31) + codes[j : j + len(out)])
    return out


class _Table:
    """The hashes of a set in a table of bits (as bytes); says yes to all of them and to few others."""

    def __init__(self, hashes: np.ndarray) -> None:
        size = 1 << max(10, (32 * len(hashes)).bit_length())
        self.mask = np.uint64(size - 1)
        self.bits = np.zeros(size, dtype=bool)
        self.bits[hashes & self.mask] = True

    def has(self, hashes: np.ndarray) -> np.ndarray:
        return self.bits[hashes & self.mask]


class Search(NamedTuple):
    """Parameters of a search."""

    width: int
    max_edits: int
    repetitions: int
    sample: int

    def run(self) -> int:
        """Words in a row that two windows within the distance are sure to share, four at most."""
        kept = self.width - self.max_edits
        return max(1, min(4, -(-kept // (self.max_edits + 1))))


class _Block:
    """The windows of a block of items, ready to be met: codes, owners, and per repetition the sorted buckets."""

    def __init__(self, stretches: list[np.ndarray], search: Search) -> None:
        sizes = np.array([len(c) for c in stretches], dtype=np.int64)
        codes = np.concatenate([*stretches, np.empty(0, dtype=np.uint64)])
        owner = np.repeat(np.arange(len(stretches)), sizes)
        whole = _starts(sizes, search.width)
        hashes = run_hashes(codes, search.width)[whole] if len(whole) else np.empty(0, dtype=np.uint64)
        _, first, which = np.unique(hashes, return_index=True, return_inverse=True)
        self.windows = codes[whole[first][:, None] + np.arange(search.width)] if len(whole) else np.empty((0, search.width), dtype=np.uint64)
        # The items of each distinct window, one after another.
        pairs = np.unique(np.stack([which, owner[whole]], axis=1), axis=0) if len(whole) else np.empty((0, 2), dtype=np.int64)
        self.items, self.ends = pairs[:, 1], np.searchsorted(pairs[:, 0], np.arange(len(first) + 1))
        inner = _starts(sizes, search.run())
        self.runs = _Table(run_hashes(codes, search.run())[inner] if len(inner) else np.empty(0, dtype=np.uint64))
        self.buckets, self.orders = [], []
        for r in range(search.repetitions):
            found = cgk_buckets(codes, search.width, r, search.sample, whole[first]) if len(whole) else np.empty(0, dtype=np.int64)
            order = np.argsort(found, kind="stable")
            self.buckets.append(found[order])
            self.orders.append(order)


def _starts(sizes: np.ndarray, width: int) -> np.ndarray:
    """Where windows begin in texts laid end to end; no window crosses from one text to the next."""
    total = int(sizes.sum())
    place = np.arange(total) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    return np.nonzero(place <= np.repeat(sizes, sizes) - width)[0]


def _ranges(lo: np.ndarray, hi: np.ndarray, most: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All (k, x) with lo[k] <= x < hi[k], about ``most`` at a time."""
    ends = np.cumsum(hi - lo)
    total = int(ends[-1]) if len(ends) else 0
    for start in range(0, total, most):
        place = np.arange(start, min(start + most, total))
        k = np.searchsorted(ends, place, side="right")
        yield k, lo[k] + place - (ends[k] - (hi[k] - lo[k]))


def _meet(codes: np.ndarray, sizes: np.ndarray, block: _Block, search: Search) -> tuple[np.ndarray, ...]:
    """The texts laid end to end in ``codes`` against a block: text, item, distinct windows, least edits."""
    none = tuple(np.empty(0, dtype=np.int64) for _ in range(4))
    whole = _starts(sizes, search.width)
    if not len(whole) or not len(block.windows):
        return none
    # Windows within the distance share a run of words with the item's; all others are passed over.
    run = search.run()
    known = np.concatenate([[0], np.cumsum(block.runs.has(run_hashes(codes, run)))])
    whole = whole[known[whole + search.width - run + 1] > known[whole]]
    if not len(whole):
        return none
    same = run_hashes_at(codes, whole, search.width)
    _, first, which = np.unique(same, return_index=True, return_inverse=True)
    starts, n = whole[first], len(block.windows)
    found = []
    for r in range(search.repetitions):
        own = cgk_buckets(codes, search.width, r, search.sample, starts)
        lo, hi = (np.searchsorted(block.buckets[r], own, side=s) for s in ("left", "right"))
        for k, x in _ranges(lo, hi, _PAIRS):
            met = np.unique(k * n + block.orders[r][x])
            at, of = met // n, met % n
            edits = edit_distances(codes[starts[at][:, None] + np.arange(search.width)], block.windows[of], search.max_edits)
            found.append((met[edits <= search.max_edits], edits[edits <= search.max_edits]))
    pairs, at = np.unique(np.concatenate([f[0] for f in found]) if found else np.empty(0, dtype=np.int64), return_index=True)
    if not len(pairs):
        return none
    edits = np.concatenate([f[1] for f in found])[at]
    # From distinct windows to texts, and from distinct item windows to items, some windows at a time.
    text_of = np.repeat(np.arange(len(sizes)), sizes)[whole]
    held = np.unique(np.stack([which, text_of], axis=1), axis=0)
    ends = np.searchsorted(held[:, 0], np.arange(len(starts) + 1))
    window, of = pairs // n, pairs % n
    made = np.cumsum((ends[window + 1] - ends[window]) * (block.ends[of + 1] - block.ends[of]))
    last = np.nonzero(np.append(window[1:] != window[:-1], True))[0]
    lows, parts = 0, []
    for hi in (last[np.append(np.diff(made[last] // _PAIRS) > 0, True)] + 1).tolist():
        w, o, e = window[lows:hi], of[lows:hi], edits[lows:hi]
        rows = np.concatenate([
            np.stack([held[x[m], 1], block.items[y], w[k[m]], e[k[m]]], axis=1)
            for k, x in _ranges(ends[w], ends[w + 1], _PAIRS) for m, y in _ranges(block.ends[o[k]], block.ends[o[k] + 1], _PAIRS)
        ])
        rows = np.unique(rows, axis=0)  # sorted by text, item, window, edits
        parts.append(_per_pair(rows[:, 0], rows[:, 1], _changes(rows[:, :3]), rows[:, 3]))
        lows = hi
    text, item, windows, edits = (np.concatenate(c) for c in zip(*parts, strict=True))
    order = np.lexsort((item, text))
    return _per_pair(text[order], item[order], windows[order], edits[order])


def _changes(rows: np.ndarray) -> np.ndarray:
    """1 for each row that differs from the row before it."""
    out = np.ones(len(rows), dtype=np.int64)
    out[1:] = (rows[1:] != rows[:-1]).any(axis=1)
    return out


def _per_pair(text: np.ndarray, item: np.ndarray, windows: np.ndarray, edits: np.ndarray) -> tuple[np.ndarray, ...]:
    """Sum of windows and least edits of each text and item; rows are sorted by both."""
    at = np.nonzero(_changes(np.stack([text, item], axis=1)))[0]
    return text[at], item[at], np.add.reduceat(windows, at), np.minimum.reduceat(edits, at)


def run_hashes_at(codes: np.ndarray, starts: np.ndarray, length: int) -> np.ndarray:
    """:func:`run_hashes` of the runs that begin at ``starts`` only."""
    out = np.zeros(len(starts), dtype=np.uint64)
    with np.errstate(over="ignore"):
        for j in range(length):
            out = _mix(out * np.uint64(31) + codes[starts + j])
    return out


#: The block of the last broadcast, kept while a worker is reused.
_READY: dict[tuple[str, Search], _Block] = {}


def _against(shared, search: Search, schema: pa.Schema):
    """A mapInArrow function: (doc, text) -> (doc, item, windows, edits) against the broadcast block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = _Codes()
        tag, items, stretches = shared.value
        key = (tag, search)
        if key not in _READY:
            _READY.clear()
            _READY[key] = _Block([np.frombuffer(c, dtype=np.uint64) for c in stretches], search)
        block = _READY[key]

        def met(ids: pa.Array, held: list[int], texts: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
            doc, item, windows, edits = _meet(np.concatenate(texts), np.array([len(t) for t in texts], dtype=np.int64), block, search)
            for lo in range(0, len(doc), 50_000):
                part = slice(lo, lo + 50_000)
                columns = [ids.take(pa.array(np.array(held)[doc[part]])), items.take(pa.array(item[part])), pa.array(windows[part]), pa.array(edits[part].astype(np.int32))]
                yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

        for batch in batches:
            ids, held, texts, size = batch.column(0), [], [], 0
            for i, text in enumerate(batch.column(1).to_pylist()):
                words = words_of(text)
                if len(words) >= search.width:
                    held.append(i)
                    texts.append(word_codes(words, memo))
                    size += len(words)
                if size >= 1_000_000:
                    yield from met(ids, held, texts)
                    held, texts, size = [], [], 0
            if texts:
                yield from met(ids, held, texts)

    return run


def _stretches(width: int):
    """A mapInArrow function: (item, text) -> (item, codes of up to STRETCH words), overlapping so that each window is in one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = _Codes()
        for batch in batches:
            at, codes = [], []
            for i, text in enumerate(batch.column(1).to_pylist()):
                words = words_of(text)
                for lo in range(0, len(words) - width + 1, STRETCH):
                    at.append(i)
                    codes.append(word_codes(words[lo : lo + STRETCH + width - 1], memo).tobytes())
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(at, type=pa.int64())), pa.array(codes, type=pa.binary())], names=["item", "codes"])

    return run


def leaks(
    docs: DataFrame, items: DataFrame, doc_id: str, item_id: str, doc_text: str, item_text: str,
    width: int = 13, max_edits: int = 0, target_recall: float = 0.95, sample: int | None = None, block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """The documents and items that share a window of ``width`` words.

    Columns: ``doc_id, item_id, windows`` (the number of distinct windows of
    the document that match) and ``least_edits``. With ``max_edits`` 0 the
    windows are the same after :func:`words_of`; one walk finds all of them.
    Beyond 0 a pair of windows is found with at least the target recall, and
    each pair reported is within the distance; as both windows have ``width``
    words, a word inserted or left out makes two edits. Null, empty and
    shorter texts share nothing. Repeated documents and items with one id
    count once (``windows`` is that of the text with most).

    Items are held against the documents in blocks of ``block_words`` words,
    as 64-bit codes: that bounds what is broadcast, and blocks are few as
    held-out material is small. The driver holds one block at a time. An item
    beyond STRETCH words is laid out in stretches that share no window;
    ``windows`` is then that of its best stretch. Within a worker, documents
    are walked a million words at a time and pairs verified in slices, so
    phrases that many items share need no more memory.
    """
    spark = docs.sparkSession
    sample = sample or (16 if max_edits == 0 else 12)
    search = Search(width, max_edits, repetitions_for(max_edits, target_recall, width, sample), sample)
    named = items.select(F.col(item_id).alias("item"), F.col(item_text).alias("text")).where("text is not null")
    item_field = T.StructField("item", named.schema["item"].dataType)
    laid = cut(named.mapInArrow(_stretches(width), T.StructType([item_field, T.StructField("codes", T.BinaryType())])))
    texts = docs.select(F.col(doc_id).alias("doc"), F.col(doc_text).alias("text")).where("text is not null")
    out = T.StructType([T.StructField("doc", texts.schema["doc"].dataType), item_field, T.StructField("windows", T.LongType()), T.StructField("edits", T.IntegerType())])

    def blocks() -> Iterator[list]:
        held, size = [], 0
        for row in laid.toLocalIterator():
            if held and size + len(row["codes"]) // 8 > block_words:
                yield held
                held, size = [], 0
            held.append(row)
            size += len(row["codes"]) // 8
        yield held

    parts = []
    for held in blocks():
        arrow = _arrow_schema(out)
        shared = spark.sparkContext.broadcast((uuid.uuid4().hex, pa.array([r["item"] for r in held], type=arrow.field("item").type), [bytes(r["codes"]) for r in held]))
        parts.append(texts.mapInArrow(_against(shared, search, arrow), out))
    found = reduce(DataFrame.unionByName, parts)
    return found.groupBy(F.col("doc").alias(doc_id), F.col("item").alias(item_id)).agg(F.max("windows").alias("windows"), F.min("edits").alias("least_edits"))


def _arrow_schema(schema: T.StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(schema)
