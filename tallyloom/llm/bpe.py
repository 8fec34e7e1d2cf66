"""Byte-level BPE by a minimal acyclic transducer of frequent words, and exact merges for all others.

The words of all documents are counted on Spark. The frequent ones are compiled
on the driver, with their ids as outputs, into an automaton that shares suffixes:
ids are emitted as early as a prefix decides them, so "walking" and "talking" can
share the state behind their stems together with the id of "ing". The automaton is one
file of integer arrays in the shared folder; Spark hands it to every machine, where
the tasks map it into memory. A task looks up all distinct words of some texts in
lockstep, one byte at a time, and merges those that the automaton lacks by the
rules of the vocabulary. The lexicon decides what is fast, never what comes out.
"""

from __future__ import annotations

import functools
import heapq
import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.llm.common import text_of
from tallyloom.plans.storage import materialize, new_path

#: Words compiled into the automaton: the most frequent ones, of at most so many bytes.
LEXICON_WORDS = 1 << 17
LONGEST = 64
#: Characters of the texts that are taken up together, and distinct words that a task keeps.
CHARACTERS = 1 << 21
REMEMBERED = 1 << 17
_LETTER, _NUMBER, _OTHER, _SPACE, _UNKNOWN = 0, 1, 2, 3, 255
_NO_RANK = np.iinfo(np.int32).max


def _byte_symbols() -> dict[str, int]:
    """The printable character that stands for each byte in a byte-level vocabulary."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Vocabulary:
    """A tokenizer file of the byte-level kind: symbols, merges and added tokens.

    Files that normalise, add a prefix, process the result or use anything but
    plain merges are refused, as are added tokens with matching options.
    """

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        found = json.loads(Path(path).read_text("utf-8"))
        model, before = found["model"], found["pre_tokenizer"] or {}
        plain = not any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges"))
        level = before.get("type") == "ByteLevel" and before.get("use_regex", True) and not before.get("add_prefix_space")
        options = any(t[k] for t in found["added_tokens"] for k in ("single_word", "lstrip", "rstrip", "normalized"))
        if model["type"] != "BPE" or not plain or not level or options or found["normalizer"] or found["post_processor"]:
            raise ValueError(f"{path} is not a plain byte-level vocabulary")
        symbols = _byte_symbols()
        ids: dict[str, int] = model["vocab"]
        self.added = {t["content"]: t["id"] for t in found["added_tokens"]}
        self.of_byte = np.zeros(256, np.int32)
        for shown, byte in symbols.items():
            self.of_byte[byte] = ids[shown]
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        left, right = (np.array([ids[p[i]] for p in pairs], np.int64) for i in (0, 1))
        whole = np.array([ids[a + b] for a, b in pairs], np.int32)
        rank_of = {int(w): r for r, w in enumerate(whole)}
        if any(rank_of.get(int(i), -1) >= r for r, p in enumerate(zip(left, right)) for i in p):
            raise ValueError("a merge comes before those that make its parts")
        keys = left << 32 | right
        order = keys.argsort(kind="stable")
        self.keys, self.ranks, self.wholes = keys[order], order.astype(np.int32), whole[order]
        self.pairs = {int(k): (int(r), int(w)) for k, r, w in zip(self.keys, self.ranks, self.wholes)}
        self.bytes = [b""] * (max([*ids.values(), *self.added.values()]) + 1)
        for shown, i in [*ids.items(), *self.added.items()]:
            known = all(c in symbols for c in shown)
            self.bytes[i] = bytes(symbols[c] for c in shown) if known else shown.encode()
        self.splits = Tokenizer.from_file(path).pre_tokenizer.pre_tokenize_str
        self.classes = np.full(0x110000, _UNKNOWN, np.uint8)

    def classify(self, points: np.ndarray) -> np.ndarray:
        """Letter, number, white space or other, as the tokenizers library has it; each character is asked for once."""
        found = self.classes[points]
        for point in np.unique(points[found == _UNKNOWN]):
            joined = [len(self.splits(before + chr(point))) == 1 for before in "a1."]
            self.classes[point] = joined.index(True) if any(joined) else _SPACE
        return self.classes[points] if (found == _UNKNOWN).any() else found


@functools.lru_cache(2)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


# -- words ------------------------------------------------------------------


def _points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le"), np.uint32)


def word_starts(points: np.ndarray, first: np.ndarray, vocab: Vocabulary) -> np.ndarray:
    """Whether a word of byte-level BPE starts at each character.

    ``first`` marks where a text starts. A word is a run of letters, of numbers or
    of other characters, with one blank before it if there is one, a run of white
    space without the blank or other character before a word, or a contraction.
    """
    kind = vocab.classify(points)
    n = len(points)
    start = first.copy()
    start[1:] |= kind[1:] != kind[:-1]
    space = kind == _SPACE
    follows = np.zeros(n, bool)  # a character of the same text that is no white space comes next
    follows[:-1] = ~space[1:] & ~first[1:]
    attached = np.zeros(n, bool)
    attached[1:] = follows[:-1] & (points[:-1] == 32)
    start &= ~(attached & ~space)
    start |= space & follows
    quotes = np.nonzero((points == 39) & start)[0]
    for ending in ("s", "t", "m", "d", "re", "ve", "ll"):
        size = len(ending) + 1
        at = quotes[quotes + size <= n]
        for k, c in enumerate(ending):
            at = at[(points[at + 1 + k] == ord(c)) & ~first[at + 1 + k]]
        start[at + 1] = False
        after = at[at + size < n] + size
        start[after] = True
    return start


def _pieces(text: str, added: dict[str, int]) -> list[str]:
    """The text cut around added tokens: leftmost first, longest of those."""
    if not any(token in text for token in added):
        return [text] if text else []
    pieces, at = [], 0
    while at < len(text):
        found = [(i, -len(token), token) for token in added if token and (i := text.find(token, at)) >= 0]
        if not found:
            pieces.append(text[at:])
            break
        i, _, token = min(found)
        pieces += [text[at:i]] if i > at else []
        pieces.append(token)
        at = i + len(token)
    return pieces


def words_of(texts: list[str], vocab: Vocabulary) -> tuple[list[str], np.ndarray, np.ndarray]:
    """The distinct words of some texts, the number of the word at each place, and where each text ends among the places."""
    pieces = [_pieces(t, vocab.added) for t in texts]
    flat = [p for several in pieces for p in several]
    whole = "".join(flat)
    points = _points(whole)
    ends = np.cumsum([len(p) for p in flat], dtype=np.int64)
    if not len(points):
        return [], np.zeros(0, np.int64), np.zeros(len(texts), np.int64)
    first = np.zeros(len(points), bool)
    first[0], first[ends[:-1]] = True, True
    start = word_starts(points, first, vocab)
    for k, p in enumerate(flat):
        if p in vocab.added:
            start[ends[k] - len(p) + 1 : ends[k]] = False
    begins = np.nonzero(start)[0]
    cuts = [*begins.tolist(), len(whole)]
    number: dict[str, int] = {}
    places = np.fromiter((number.setdefault(whole[a:b], len(number)) for a, b in zip(cuts, cuts[1:])), np.int64, len(begins))
    text_ends = np.cumsum([sum(map(len, several)) for several in pieces], dtype=np.int64)
    return list(number), places, begins.searchsorted(text_ends)


# -- merges -----------------------------------------------------------------


def _merge_long(symbols: list[int], vocab: Vocabulary) -> list[int]:
    """Ids of one word of any length: places by rank, lowest rank first, from left to right within it.

    A merge makes pairs of higher ranks only, which ``Vocabulary`` checks.
    """
    n, pairs = len(symbols), vocab.pairs
    after, before = [*range(1, n + 1)], [*range(-1, n - 1)]
    places: dict[int, list[int]] = {}
    ranks: list[int] = []

    def offer(i: int) -> None:
        j = after[i]
        if j < n and (found := pairs.get(symbols[i] << 32 | symbols[j])):
            if found[0] not in places:
                places[found[0]] = []
                heapq.heappush(ranks, found[0])
            places[found[0]].append(i)

    for i in range(n):
        offer(i)
    while ranks:
        rank = heapq.heappop(ranks)
        for i in sorted(places.pop(rank)):
            j = after[i]
            if symbols[i] < 0 or j >= n or (found := pairs.get(symbols[i] << 32 | symbols[j])) is None or found[0] != rank:
                continue
            symbols[i], symbols[j] = found[1], -1
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
            offer(i)
            if before[i] >= 0:
                offer(before[i])
    return [s for s in symbols if s >= 0]


def merge(words: list[bytes], vocab: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all words one after the other, and how many each has.

    Every word takes one step per turn: the first of its pairs of least rank, and
    all equal pairs that do not overlap, are merged.
    """
    data = np.frombuffer(b"".join(words), np.uint8)
    lengths = np.array([len(w) for w in words], np.int64)
    word, symbols = np.repeat(np.arange(len(words)), lengths), vocab.of_byte[data]
    short = (lengths <= LONGEST)[word] if len(words) else np.zeros(0, bool)
    done: list[tuple[np.ndarray, np.ndarray]] = []
    for w in np.nonzero(lengths > LONGEST)[0]:
        found = np.array(_merge_long(vocab.of_byte[np.frombuffer(words[w], np.uint8)].tolist(), vocab), np.int32)
        done.append((np.full(len(found), w), found))
    word, symbols = word[short], symbols[short]
    while len(symbols):
        key = symbols[:-1].astype(np.int64) << 32 | symbols[1:]
        at = np.minimum(vocab.keys.searchsorted(key), len(vocab.keys) - 1)
        fits = (vocab.keys[at] == key) & (word[:-1] == word[1:])
        rank = np.full(len(symbols), _NO_RANK, np.int32)
        rank[:-1][fits] = vocab.ranks[at[fits]]
        begins = np.nonzero(np.diff(word, prepend=-1))[0]
        least = np.repeat(np.minimum.reduceat(rank, begins), np.diff(begins, append=len(word)))
        over = least == _NO_RANK
        done.append((word[over], symbols[over]))
        hit = (rank == least) & ~over
        if (hit[1:] & hit[:-1]).any():  # a run of one symbol: every second pair, from the left
            i = np.arange(len(hit))
            run = np.maximum.accumulate(np.where(hit & ~np.concatenate([[False], hit[:-1]]), i, -1))
            hit &= (i - run) % 2 == 0
        here = np.nonzero(hit)[0]
        symbols[here] = vocab.wholes[at[here]]
        stays = ~over
        stays[here + 1] = False
        word, symbols = word[stays], symbols[stays]
    if not done:
        return np.zeros(0, np.int32), np.zeros(len(words), np.int64)
    word, symbols = (np.concatenate(c) for c in zip(*done))
    return symbols[word.argsort(kind="stable")], np.bincount(word, minlength=len(words))


# -- the transducer ---------------------------------------------------------


class _State:
    __slots__ = ("arcs", "final", "number")

    def __init__(self) -> None:
        self.arcs: dict[int, list] = {}  # byte: [state, ids emitted]
        self.final: tuple[int, ...] | None = None  # ids emitted at the end of a word
        self.number = -1


def minimal_transducer(entries: list[tuple[bytes, tuple[int, ...]]]) -> dict[str, np.ndarray]:
    """Arrays of the least deterministic automaton that maps each word to its ids.

    ``entries`` are sorted, without repetition. States whose words and outputs
    from there on are equal are one state: the states of the last word that the
    next one leaves behind are looked up among the finished ones, from the end.
    """
    known: dict[tuple, _State] = {}
    finished: list[_State] = []

    def finish(state: _State) -> _State:
        sign = (state.final, *((b, a[0].number, a[1]) for b, a in sorted(state.arcs.items())))
        if sign not in known:
            state.number = len(finished)
            finished.append(state)
            known[sign] = state
        return known[sign]

    path, last = [_State()], b""

    def leave(depth: int) -> None:
        for i in range(len(last), depth, -1):
            path[i - 1].arcs[last[i - 1]][0] = finish(path[i])
        del path[depth + 1 :]

    for word, ids in entries:
        shared = next((i for i, (a, b) in enumerate(zip(word, last)) if a != b), min(len(word), len(last)))
        leave(shared)
        for byte in word[shared:]:
            path[-1].arcs[byte] = [(state := _State()), ()]
            path.append(state)
        path[-1].final = ()
        for i in range(shared):  # what this word does not emit moves behind the shared prefix
            arc = path[i].arcs[word[i]]
            same = next((k for k, (a, b) in enumerate(zip(arc[1], ids)) if a != b), min(len(arc[1]), len(ids)))
            rest, arc[1], ids = arc[1][same:], arc[1][:same], ids[same:]
            if rest:
                for other in path[i + 1].arcs.values():
                    other[1] = rest + other[1]
                if path[i + 1].final is not None:
                    path[i + 1].final = rest + path[i + 1].final
        if shared < len(word):
            path[shared].arcs[word[shared]][1] = ids
        else:
            path[shared].final = ids
        last = word
    leave(0)
    root = finish(path[0])

    pool: list[int] = []
    places: dict[tuple, int] = {}

    def place(ids: tuple[int, ...]) -> int:
        if ids not in places:
            places[ids] = len(pool)
            pool.extend(ids)
        return places[ids]

    arcs = [(s.number << 8 | b, a[0].number, place(a[1]), len(a[1])) for s in finished for b, a in sorted(s.arcs.items())]
    ends = [(place(s.final), len(s.final)) if s.final is not None else (0, -1) for s in finished]
    arc = np.array(arcs, np.int64).reshape(-1, 4).T
    return {
        "key": arc[0], "target": arc[1], "out": arc[2], "size": arc[3],
        "end": np.array([e[0] for e in ends]), "end_size": np.array([e[1] for e in ends]),
        "pool": np.array(pool, np.int64), "root": np.array([root.number, max((len(w) for w, _ in entries), default=0)]),
    }


_ARRAYS = ("key", "target", "out", "size", "end", "end_size", "pool", "root")


def to_file(arrays: dict[str, np.ndarray]) -> bytes:
    """The lengths of the arrays, then the arrays, as little-endian 32-bit integers."""
    sizes = np.array([len(arrays[n]) for n in _ARRAYS], "<i4")
    return b"".join([sizes.tobytes(), *(arrays[n].astype("<i4").tobytes() for n in _ARRAYS)])


class Lexicon:
    """A compiled lexicon, mapped into memory: pages are shared by all tasks of a machine."""

    def __init__(self, path: str) -> None:
        mapped = np.memmap(path, "<i4", "r")
        ends = np.cumsum([len(_ARRAYS), *mapped[: len(_ARRAYS)]])
        for name, a, b in zip(_ARRAYS, ends, ends[1:]):
            setattr(self, name, mapped[a:b])
        self.start, self.longest = (int(x) for x in self.root)

    def look_up(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Which words are in the lexicon, their ids one after the other, and how many each has; all words a byte at a time."""
        data = np.frombuffer(b"".join(words), np.uint8)
        lengths = np.array([len(w) for w in words], np.int64)
        begins = np.cumsum(lengths) - lengths
        found = np.zeros(len(words), bool)
        state = np.full(len(words), self.start, np.int64)
        emitted: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []  # word, place in the pool, how many
        on = np.nonzero(lengths <= self.longest)[0] if len(self.end) else np.zeros(0, np.int64)
        for step in range(self.longest + 1):
            over = lengths[on] == step
            ended = on[over]
            size = self.end_size[state[ended]]
            found[ended] = size >= 0
            emitted.append((ended[size > 0], self.end[state[ended[size > 0]]], size[size > 0]))
            on = on[~over]
            if not len(on) or not len(self.key):
                break
            key = state[on] << 8 | data[begins[on] + step]
            at = np.minimum(self.key.searchsorted(key), len(self.key) - 1)
            fits = self.key[at] == key
            on, at = on[fits], at[fits]
            state[on] = self.target[at]
            size = self.size[at]
            emitted.append((on[size > 0], self.out[at[size > 0]], size[size > 0]))
        if not emitted:
            return found, np.zeros(0, np.int32), np.zeros(len(words), np.int64)
        word, place, size = (np.concatenate(c).astype(np.int64) for c in zip(*emitted))
        right = found[word]
        word, place, size = word[right], place[right], size[right]
        order = word.argsort(kind="stable")
        word, place, size = word[order], place[order], size[order]
        ids = self.pool[_ranges(place, size)]
        return found, ids, np.bincount(word, weights=size, minlength=len(words)).astype(np.int64)


@functools.lru_cache(2)
def _lexicon(name: str) -> Lexicon:
    return Lexicon(SparkFiles.get(name))


def _ranges(first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """first[0], first[0] + 1, ... of each range, one after the other."""
    ends = np.cumsum(size)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(first - (ends - size), size)


# -- on Spark ---------------------------------------------------------------


def _groups(batches: Iterator[pa.RecordBatch], name: str) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """Slices of the batches with their texts: as many rows as stay within CHARACTERS, one at least."""
    for batch in batches:
        lengths = pc.fill_null(pc.utf8_length(batch.column(name)), 0).to_numpy(zero_copy_only=False)
        at = 0
        while at < batch.num_rows:
            rows = max(1, int(np.cumsum(lengths[at : at + 4096]).searchsorted(CHARACTERS, "right")))
            part = batch.slice(at, rows)
            yield part, [t or "" for t in part.column(name).to_pylist()]
            at += rows


def count_words(docs: DataFrame, tokenizer_path: str, longest: int = LONGEST) -> DataFrame:
    """(word, n): how often each word of at most ``longest`` bytes occurs in all texts; added up in a task before the shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = vocabulary(tokenizer_path)
        held: dict[str, int] = {}

        def told() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(held, pa.string()), pa.array(held.values(), pa.int64())], ["word", "n"])

        for _, several in _groups(batches, "text"):
            words, places, _ = words_of(several, vocab)
            for word, n in zip(words, np.bincount(places, minlength=len(words)).tolist()):
                held[word] = held.get(word, 0) + n
            if len(held) > REMEMBERED:
                yield told()
                held = {}
        yield told()

    told = docs.select(text_of().alias("text")).mapInArrow(run, "word string, n long")
    short = told.where(F.octet_length("word") <= longest)
    return short.groupBy("word").agg(F.sum("n").alias("n"))


@dataclass(frozen=True)
class LexiconFile:
    """A lexicon that Spark has handed to every machine under ``name``; ``path`` is its place in the shared folder."""

    name: str
    path: str
    tokenizer_path: str


def compile_lexicon(words: list[str], tokenizer_path: str) -> bytes:
    vocab = vocabulary(tokenizer_path)
    known = sorted({w.encode() for w in words if w and w not in vocab.added})
    ids, sizes = merge(known, vocab)
    ends = np.cumsum(sizes).tolist()
    flat = ids.tolist()
    return to_file(minimal_transducer([(w, tuple(flat[a:b])) for w, a, b in zip(known, [0, *ends], ends)]))


def _write(spark: SparkSession, path: str, data: bytes) -> None:
    """A file in the shared folder, whatever store that is."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    out = place.getFileSystem(spark._jsc.hadoopConfiguration()).create(place)
    try:
        out.write(bytearray(data))
    finally:
        out.close()


def frequent_words(docs: DataFrame, tokenizer_path: str, size: int = LEXICON_WORDS) -> list[str]:
    """Words that occur at least n times in all documents, for the least n that leaves ``size`` words at most; 2 at least.

    n comes from how many words share each count: a table as short as the root of
    the number of words in all texts. A limit on sorted words would send the driver
    that many from every partition.
    """
    counts = materialize(count_words(docs, tokenizer_path).where("n > 1"), "word-counts")
    least, words = None, 0
    for r in counts.groupBy("n").agg(F.count(F.lit(1)).alias("words")).orderBy(F.desc("n")).toLocalIterator():
        words += r["words"]
        if words > size:
            break
        least = r["n"]
    return [] if least is None else [r["word"] for r in counts.where(F.col("n") >= least).select("word").collect()]


def fit_lexicon(docs: DataFrame, tokenizer_path: str, size: int = LEXICON_WORDS) -> LexiconFile:
    """The frequent words of all documents, ``size`` at most, compiled. The driver sees these words only."""
    frequent = frequent_words(docs, tokenizer_path, size)
    name = f"lexicon-{uuid.uuid4().hex}"
    path = new_path(docs.sparkSession, "lexicon") + f"/{name}"
    _write(docs.sparkSession, path, compile_lexicon(frequent, tokenizer_path))
    docs.sparkSession.sparkContext.addFile(path)
    return LexiconFile(name, path, tokenizer_path)


class Encoder:
    """Ids of texts by a lexicon and, beyond it, by merges; the latter are remembered up to a bound."""

    def __init__(self, lexicon: Lexicon, vocab: Vocabulary) -> None:
        self.lexicon, self.vocab, self.merged = lexicon, vocab, {}

    def words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of distinct words in a pool: the pool, and where each word's ids begin and how many there are."""
        found, pool, sizes = self.lexicon.look_up([w.encode() for w in words])
        begins = np.cumsum(sizes) - sizes
        rest = np.nonzero(~found)[0].tolist()
        new = [w for i in rest if (w := words[i]) not in self.merged and w not in self.vocab.added]
        if len(self.merged) + len(new) > REMEMBERED:
            new = [w for i in rest if (w := words[i]) not in self.vocab.added]
            self.merged = {}
        ids, counts = merge([w.encode() for w in new], self.vocab)
        ends = np.cumsum(counts)
        known = dict(zip(new, np.split(ids, ends[:-1]))) if new else {}
        several = [
            np.array([self.vocab.added[w]], np.int32) if w in self.vocab.added else known[w] if w in known else self.merged[w]
            for w in (words[i] for i in rest)
        ]
        self.merged.update((w, v.copy()) for w, v in known.items() if len(w) <= LONGEST)
        if rest:
            sizes[rest] = [len(v) for v in several]
            begins[rest] = len(pool) + np.cumsum(sizes[rest]) - sizes[rest]
            pool = np.concatenate([pool, *several])
        return pool, begins, sizes

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after the other, and how many each has."""
        words, places, ends = words_of(texts, self.vocab)
        pool, begins, sizes = self.words(words)
        ids = pool[_ranges(begins[places], sizes[places])]
        at = np.concatenate([[0], np.cumsum(sizes[places])])[ends]
        return ids.astype(np.int32), np.diff(at, prepend=0)


def _schema(rows: DataFrame, keep: list[str], made: str) -> str:
    if made.split()[0] in keep:
        raise ValueError(f"rename the column {made.split()[0]}")
    return ", ".join([*(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in keep), made])


def encode(docs: DataFrame, lexicon: LexiconFile, keep: list[str]) -> DataFrame:
    """The columns ``keep`` and ``ids`` (array of int): the whole text as the tokenizers library encodes it.

    Added tokens in a text get their ids; no special tokens are put around it.

    * A null or empty text has no ids. Texts and words may be of any length: a word
      of millions of characters is merged by places of equal rank.
    * Each row is encoded by itself, so repeated rows and null ids are kept.
    * Columns other than ``keep`` and ``text`` are not looked at; a ``keep`` named
      ``ids`` is refused. An empty table gives no rows.
    """
    name, path = lexicon.name, lexicon.tokenizer_path

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(_lexicon(name), vocabulary(path))
        for part, several in _groups(batches, "__text"):
            ids, counts = encoder.encode(several)
            offsets = np.concatenate([[0], np.cumsum(counts)])
            lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(ids))
            yield pa.RecordBatch.from_arrays([*(part.column(c) for c in keep), lists], [*keep, "ids"])

    return docs.select(*keep, text_of().alias("__text")).mapInArrow(run, _schema(docs, keep, "ids array<int>"))


def decode(rows: DataFrame, tokenizer_path: str, keep: list[str]) -> DataFrame:
    """The columns ``keep`` and ``decoded``: the text of ``ids``, special tokens included.

    Bytes that are no UTF-8 become U+FFFD, as with the tokenizers library; null
    and unknown ids are left out, and null ``ids`` are the empty text.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = vocabulary(tokenizer_path).bytes
        sizes = np.array([len(b) for b in known], np.int64)
        pool, begins = np.frombuffer(b"".join(known), np.uint8), np.cumsum(sizes) - sizes
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                lists = part.column("ids")
                counts = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
                ids = pc.fill_null(lists.flatten(), -1).to_numpy(zero_copy_only=False)
                right = (ids >= 0) & (ids < len(known))
                ids = np.where(right, ids, 0)
                length = np.where(right, sizes[ids], 0)
                data = pool[_ranges(begins[ids], length)].tobytes()
                ends = np.concatenate([[0], np.cumsum(length)])[np.cumsum(counts)].tolist()
                told = [data[a:b].decode("utf-8", "replace") for a, b in zip([0, *ends], ends)]
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in keep), pa.array(told, pa.string())], [*keep, "decoded"])

    columns = list(dict.fromkeys([*keep, "ids"]))
    return rows.select(*columns).mapInArrow(run, _schema(rows, keep, "decoded string"))
