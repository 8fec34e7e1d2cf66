"""Exact join of documents whose word shingles have a Jaccard similarity of at least 0.75.

Universe partition: the hash range of shingles is cut into segments, by bands of
set sizes, and sets whose Hamming distance is at most H differ in at most H
segments. So of the segments that a set has anything in, any H + 1 under an order
that all sets share contain one that a similar set has, too, and has among its
own H + 1 (pigeonhole with prefixes). The order is the cost: segments of shingles
that are frequent in the corpus come last, so passages that many documents share
are not looked up while a document has anything rarer. Sets of three to five
shingles, where H is 1, are one segment, looked up by itself and its one-deletion
neighbourhood. Segments are as coarse as leaves every set of a band H + 1 of them,
which is counted over all documents; small sets go down to single shingles.

What meets in a segment is compared in two steps. First every set with the one
set of its segments' pivots that it meets most often: as many comparisons as sets.
Then, where a segment still holds several components, all its sets across them:
pair by pair in small segments; in large ones, whose sets are near misses of each
other, block by block, so that no task holds more than two blocks and no pair is a
row. No link between components is missed. Every comparison is exact on the sets
of 64-bit hashes.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.common import kept_small, map_batches, mix64, sliced, text_of
from tallyloom.llm.components import components
from tallyloom.operators.skew import shuffled_for_join
from tallyloom.plans.storage import materialize

WIDTH = 5
#: Counters of shingle frequencies: a fixed number, whatever the corpus.
COUNTERS_LOG2 = 20
_BLOCK = 1 << 12
#: Tokens per segment at the largest size of a band; 0 is one shingle a segment.
GRAINS = (3.0, 1.5, 0.0)
#: Signatures that a task combines before it passes them on.
_CHUNK = 1 << 19
#: Larger segments are compared in blocks of so many sets.
PAIRWISE, BLOCK = 32, 256
_COLUMNS = 4096
#: Bits of a signature: chance meetings cost a comparison, and shorter ones shuffle less.
_SHORT = np.uint64(0xFFFFFFFFFFFF)
_POWERS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xFF51AFD7ED558CCD], np.uint64)


#: Bytes whose words are hashed at a time; a longer word is hashed as a whole.
_PART = 1 << 16
_BLANK = re.compile(rb"[\x20\x09-\x0d]")
#: A value for each byte: none for blanks, the same for a letter in either case.
_VALUES = mix64(np.arange(1, 257, dtype=np.uint64) * _POWERS[0])
_VALUES[65:91] = _VALUES[97:123]
_VALUES[[9, 10, 11, 12, 13, 32]] = 0


class Shingler:
    """Distinct shingle hashes of a text, sorted.

    A word's hash is a polynomial in its bytes' values: the sum of values times
    powers over the whole text, divided by the power at the word's first byte.
    """

    def __init__(self, width: int = WIDTH) -> None:
        self.width = width
        self._powers(1 << 13)

    def _powers(self, n: int) -> None:
        base = int(_POWERS[1])
        steps = np.array([base, pow(base, -1, 1 << 64)], np.uint64)[:, None].repeat(n, axis=1)
        steps[:, 0] = 1
        self.up, self.down = np.multiply.accumulate(steps, axis=1)

    def _codes(self, data: bytes) -> np.ndarray:
        values = _VALUES[np.frombuffer(data, np.uint8)]
        inside = values != 0
        first = inside.copy()
        first[1:] &= ~inside[:-1]
        starts = np.nonzero(first)[0]
        if not len(starts):
            return np.zeros(0, np.uint64)
        if len(values) > len(self.up):
            self._powers(1 << (len(values) - 1).bit_length())
        return mix64(np.add.reduceat(values * self.up[: len(values)], starts) * self.down[starts])

    def words(self, text: str) -> np.ndarray:
        """A hash per word."""
        data, begin, found = text.encode("utf-8", "replace"), 0, []
        while begin < len(data):
            blank = _BLANK.search(data, begin + _PART)
            end = blank.start() if blank else len(data)
            found.append(self._codes(data[begin:end]))
            begin = end
        return found[0] if len(found) == 1 else np.concatenate([np.zeros(0, np.uint64), *found])

    def __call__(self, text: str) -> np.ndarray:
        codes = self.words(text)
        n = len(codes)
        if not n:
            return codes
        if n < self.width:  # the whole sequence; its length keeps it apart from longer shingles
            return mix64(np.sum(codes * _POWERS[:n]).reshape(1) + np.uint64(n))
        total = np.zeros(n - self.width + 1, np.uint64)
        for k in range(self.width):
            total += codes[k : n - self.width + 1 + k] * _POWERS[k % len(_POWERS)]
        hashes = mix64(total)
        hashes.sort()
        return hashes[np.concatenate([[True], hashes[1:] != hashes[:-1]])]


def most_apart(n: int, band: int) -> int:
    """The largest Hamming distance of a set of n to a similar set in the band: of any size in its own, smaller in the one below."""
    return (n + 4 * n // 3) // 7 if band == _band(n) else 2 * n // 7


def bands_of(n: int) -> list[int]:
    """The bands that a set of n is looked up in: its own, and the one below if that holds similar sizes."""
    own = _band(n)
    return [own] if _band(-(-3 * n // 4)) == own else [own - 1, own]


def _band(n: int) -> int:
    """Band 0: sizes 1 and 2, band 1: 3 to 5, band b from 2: 6 to 95, 96 to 1535 and so on."""
    return 0 if n < 3 else 1 if n < 6 else 2 + ((n // 6).bit_length() - 1) // 4


def segments_in(band: int, grain: float) -> int:
    """Number of segments of a band from 2; its largest visitor is a third larger than its sizes."""
    return max(1, int((6 << 4 * (band - 1)) * 4 / 3 / grain))


def _starts(sets: np.ndarray, band: int, grain: float) -> tuple[np.ndarray, np.ndarray]:
    """Where each filled segment begins in the sorted hashes, and its number."""
    if not grain:
        return np.arange(len(sets)), sets
    number = (sets >> np.uint64(32)) * np.uint64(segments_in(band, grain)) >> np.uint64(32)
    starts = np.concatenate([[0], np.nonzero(number[1:] != number[:-1])[0] + 1])
    return starts, number[starts]


def set_id(sets: np.ndarray) -> int:
    """64 bits that stand for a set."""
    if not len(sets):
        return 0
    return int(mix64(np.array([np.sum(mix64(sets + np.uint64(0x632BE59BD9B4E019)))], np.uint64) ^ np.uint64(len(sets)))[0].astype(np.int64))


def signatures(sets: np.ndarray, grains: dict[int, float], counts: np.ndarray) -> np.ndarray:
    """What a set is looked up by, as 64-bit integers; see the module."""
    n, out = len(sets), []
    with np.errstate(over="ignore"):
        for band in bands_of(n) if n else []:
            salt = mix64(np.array([band + 1], np.uint64))
            if band < 2:
                whole = np.sum(mix64(sets)).reshape(1)
                out.append(mix64(whole + salt))
                if band == 1:
                    out.append(mix64(whole - mix64(sets) + salt))
                continue
            starts, numbers = _starts(sets, band, grains[band])
            needed = most_apart(n, band) + 1
            cost = np.minimum.reduceat(counts[(sets >> np.uint64(64 - COUNTERS_LOG2)).astype(np.int64)], starts)
            content = mix64(np.add.reduceat(mix64(sets), starts) + mix64(numbers + salt))
            # The rarest first; equal costs in the order of their content.
            out.append(content[np.lexsort((content, cost))[:needed]])
    return np.concatenate(out) & _SHORT if out else np.zeros(0, np.uint64)


_FIRST = "kind int, doc_id long, n long, cls long, block int, data binary"


def _survey(docs: DataFrame) -> DataFrame:
    """Per document its set's size and id (kind 0); per task its frequencies (1) and, by band and grain, the least surplus of segments (2)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler, counts, spare = Shingler(), np.zeros(1 << COUNTERS_LOG2, np.int64), {}
        for batch in sliced(batches):
            ids, sizes, classes, seen = batch.column(0), [], [], []
            for text in batch.column(1).to_pylist():
                sets = shingler(text)
                n = len(sets)
                sizes.append(n)
                classes.append(set_id(sets))
                seen.append((sets >> np.uint64(64 - COUNTERS_LOG2)).astype(np.int64))
                for band in bands_of(n) if n > 5 else []:
                    for grain in GRAINS[:-1]:
                        if band > 1:
                            left = len(_starts(sets, band, grain)[0]) - most_apart(n, band) - 1
                            spare[band, grain] = min(spare.get((band, grain), left), left)
            if seen:
                counts += np.bincount(np.concatenate(seen), minlength=len(counts))
            k = len(sizes)
            none = pa.nulls(k, pa.int32()), pa.nulls(k, pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array([0] * k, pa.int32()), ids, pa.array(sizes, pa.int64()), pa.array(classes, pa.int64()), *none], _names(_FIRST))
        blocks = [(1, None, None, None, b, counts[b * _BLOCK : (b + 1) * _BLOCK].astype(np.uint32).tobytes()) for b in range(len(counts) // _BLOCK)] if counts.any() else []
        blocks += [(2, band, left, None, GRAINS.index(grain), None) for (band, grain), left in spare.items()]
        if blocks:
            types = pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary()
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*blocks), types)], _names(_FIRST))

    return docs.mapInArrow(run, _FIRST)


def _names(schema: str) -> list[str]:
    return [c.split()[0] for c in schema.split(", ")]


def _frequencies(first: DataFrame) -> np.ndarray:
    """Frequencies of all tasks together: a sum in two levels, so that a group grows with the root of their number."""

    def added(frame):
        total = np.zeros(_BLOCK, np.int64)
        for data in frame["data"]:
            total += np.frombuffer(data, np.uint32)
        return frame.iloc[:1].assign(data=[np.minimum(total, 0xFFFFFFFF).astype(np.uint32).tobytes()])

    parts = max(1, int(first.rdd.getNumPartitions() ** 0.5))
    rows = first.where("kind = 1").select("block", (F.spark_partition_id() % parts).alias("part"), "data")
    schema = "block int, part int, data binary"
    rows = rows.groupBy("block", "part").applyInPandas(added, schema).groupBy("block").applyInPandas(added, schema)
    counts = np.zeros(1 << COUNTERS_LOG2, np.uint32)
    for row in rows.collect():  # a fixed number of blocks
        counts[row["block"] * _BLOCK : (row["block"] + 1) * _BLOCK] = np.frombuffer(row["data"], np.uint32)
    return counts


def _grains(first: DataFrame) -> dict[int, float]:
    """By band the coarsest grain that leaves every set enough segments."""
    chosen = dict.fromkeys(range(2, 64), GRAINS[-1])
    least = first.where("kind = 2").groupBy(F.col("doc_id").alias("band"), "block").agg(F.min("n").alias("left")).collect()
    for row in sorted(least, key=lambda r: -r["block"]):
        if row["left"] >= 0:
            chosen[row["band"]] = GRAINS[row["block"]]
    return chosen


_MET = "sig long, cls long, pivot long"


def _meetings(docs: DataFrame, grains: dict[int, float], counts: np.ndarray) -> DataFrame:
    """(sig, cls, pivot): classes that share a signature with the smallest class of it.

    A task combines what meets in it: of each signature it passes one class on,
    and pairs the others with that one. So neither copies nor a signature that a
    third of all documents has come together in one task.
    """
    shared = docs.sparkSession.sparkContext.broadcast(counts)  # of a fixed size

    def combined(sig: list[np.ndarray], cls: list[np.ndarray]) -> pa.RecordBatch:
        sig, cls = np.concatenate(sig), np.concatenate(cls)
        order = np.lexsort((cls, sig))
        sig, cls = sig[order], cls[order]
        first = np.concatenate([[True], sig[1:] != sig[:-1]])
        pivot = cls[np.maximum.accumulate(np.where(first, np.arange(len(sig)), 0))]
        use = first | (pivot != cls)
        use[1:] &= first[1:] | (cls[1:] != cls[:-1])
        arrays = pa.array(sig[use].view(np.int64)), pa.array(cls[use]), pa.array(pivot[use], mask=first[use])
        return pa.RecordBatch.from_arrays(list(arrays), _names(_MET))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler, known, seen, sig, cls, held = Shingler(), shared.value, set(), [], [], 0
        for batch in sliced(batches):
            for text in batch.column(1).to_pylist():
                sets = shingler(text)
                which = set_id(sets)
                if which in seen:
                    continue
                seen.add(which)
                found = signatures(sets, grains, known)
                sig.append(found)
                cls.append(np.full(len(found), which, np.int64))
                held += len(found)
                if held >= _CHUNK:
                    yield combined(sig, cls)
                    sig, cls, held, seen = [], [], 0, set()
        if held:
            yield combined(sig, cls)

    rows = docs.mapInArrow(run, _MET)
    # Only classes that a task passed on look for the least; the others of a frequent signature are spread by class.
    met = rows.selectExpr("sig", "cls", "pivot AS local", "min(CASE WHEN pivot IS NULL THEN cls END) OVER (PARTITION BY sig, CASE WHEN pivot IS NOT NULL THEN cls END ORDER BY cls ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS least")
    return met.selectExpr("sig", "cls", "coalesce(local, least) AS pivot").where("cls <> pivot")


def _verified(pairs: DataFrame, rows: DataFrame) -> DataFrame:
    """Those of the pairs (a, b) that link. Texts are smaller than their sets, so texts travel."""
    left, right = (rows.selectExpr(f"cls AS {x}", f"text AS {x}_text") for x in "ab")
    joined = pairs.select("a", "b").join(left, "a").join(right, "b").select("a", "b", "a_text", "b_text")

    def make():
        shingler, last = Shingler(), {}

        def set_of(side: str, cls: int, text: str) -> np.ndarray | None:
            # Pairs come in the order of a class, whose set is made once in a row.
            if side not in last or last[side][:2] != (cls, text):
                sets = shingler(text)
                last[side] = cls, text, sets if set_id(sets) == cls else None  # another row may have the id
            return last[side][2]

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            keep = []
            for a, b, a_text, b_text in zip(*(column.to_pylist() for column in batch.columns)):
                x, y = set_of("a", a, a_text), set_of("b", b, b_text)
                if x is None or y is None:
                    keep.append(False)
                    continue
                both = np.concatenate([x, y])
                both.sort()
                common = np.count_nonzero(both[1:] == both[:-1])
                keep.append(100 * common >= 75 * (len(both) - common))
            return batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))

        return step

    return map_batches(joined, make, "a long, b long")


def _rows_of(docs: DataFrame, reps: DataFrame) -> DataFrame:
    """(cls, text): the texts of the representatives of these classes."""
    wanted, _ = kept_small(reps.select("doc_id", "cls"), 32, "candidates")
    return materialize(docs.join(wanted, "doc_id").select("cls", "text"), "texts")


def _sets_of(rows: DataFrame) -> DataFrame:
    """The rows with ``data``, the set, for ``text``, which is the second column."""
    names = [c for c in rows.columns if c != "text"]

    def make():
        shingler = Shingler()

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            keep, data = [], []
            for k, (cls, text) in enumerate(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())):
                sets = shingler(text)
                if set_id(sets) == cls:  # another row may have the id
                    keep.append(k)
                    data.append(sets.tobytes())
            rest = batch.select([0, *range(2, batch.num_columns)]).take(pa.array(keep, pa.int64()))
            return pa.RecordBatch.from_arrays([*rest.columns, pa.array(data, pa.binary())], [*names, "data"])

        return step

    return map_batches(rows, make, rows.select(*names, F.lit(None).cast("binary").alias("data")).schema)


def near_duplicates(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, component_id): one row per row of ``docs``.

    Words are runs of anything but ASCII white space, A to Z in lower case. Two
    documents link when 100 x intersection >= 75 x union of their five-word
    shingles; the component is the smallest id reachable by links.

    * A null, empty or blank text has no shingle, links with nothing and is its own component.
    * With fewer than five words the whole sequence is the one shingle.
    * Equal sets link, so repeated rows and copies share a component; each row is returned.
    * A null id is never the smallest; a component of null ids alone is null.
    * Other columns are not looked at. An empty table gives no rows.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    first = materialize(_survey(rows), "shingled")
    members = first.where("kind = 0").select("doc_id", "n", "cls")
    met = materialize(_meetings(rows, _grains(first), _frequencies(first)), "met")
    classes = members.where("n > 0").groupBy("cls").agg(F.min("doc_id").alias("doc_id"), F.min("n").alias("n"))
    roots = _linked(rows, met, classes)
    named = classes.select("cls", F.col("doc_id").alias("least"))
    if roots is not None:
        named = named.join(roots.selectExpr("node AS cls", "root"), "cls", "left").select("cls", "least", F.coalesce("root", "cls").alias("root"))
        lowest = named.groupBy("root").agg(F.min("least").alias("component_id"))
        named = named.join(shuffled_for_join(lowest), "root")
    else:
        named = named.withColumnRenamed("least", "component_id")
    named = materialize(named.select("cls", "component_id"), "named")
    shared, alone = members.where("n > 0"), members.where("n = 0")
    return shared.join(named, "cls").select("doc_id", F.col("n").alias("n_shingles"), "component_id").unionByName(
        alone.select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"))
    )


_SIZES_FIT = "4 * least(a_n, b_n) >= 3 * greatest(a_n, b_n)"


def _linked(rows: DataFrame, met: DataFrame, classes: DataFrame) -> DataFrame | None:
    """Roots of the classes that link with another."""
    if met.isEmpty():
        return None
    sizes = [classes.selectExpr(f"cls AS {x}", f"n AS {x}_n") for x in "ab"]
    shared = met.groupBy("cls", "pivot").count().selectExpr("cls AS a", "pivot AS b", "count")
    shared = shared.join(sizes[0], "a").join(sizes[1], "b").where(_SIZES_FIT)
    best = shared.groupBy("a").agg(F.max_by("b", F.struct("count", "b")).alias("b"))
    asked = met.select("cls").union(met.select("pivot")).distinct()
    texts = _rows_of(rows, classes.join(asked, "cls").where("doc_id IS NOT NULL"))
    links = materialize(_verified(best, texts), "links")
    roots = components(links)

    inside = met.select("sig", "cls").union(met.select("sig", F.col("pivot").alias("cls"))).distinct()
    inside = inside.join(classes.select("cls", "n"), "cls")
    if roots is not None:
        inside = inside.join(roots.selectExpr("node AS cls", "root"), "cls", "left")
    else:
        inside = inside.withColumn("root", F.lit(None).cast("long"))
    inside = inside.withColumn("root", F.coalesce("root", "cls"))
    # Segments with the same sets in them are looked at once.
    same = inside.groupBy("sig").agg(
        F.min("root").alias("low"), F.max("root").alias("high"), F.count(F.lit(1)).alias("size"),
        F.bit_xor(F.xxhash64("cls")).alias("print"), F.sum(F.xxhash64(F.lit(1), "cls") % 1_000_003).alias("more"),
    ).where("low < high").groupBy("size", "print", "more").agg(F.min("sig").alias("sig"))
    open_ = materialize(inside.join(same.select("sig", "size"), "sig"), "open")
    small, large = open_.where(F.col("size") <= PAIRWISE), open_.where(F.col("size") > PAIRWISE)
    a, b = (small.selectExpr("sig", f"cls AS {x}", f"root AS {x}_root", f"n AS {x}_n") for x in "ab")
    across = a.join(b, "sig").where("a < b AND a_root <> b_root AND " + _SIZES_FIT).select("a", "b").distinct()
    more = _verified(across, texts)
    if not large.isEmpty():
        more = more.unionByName(_in_blocks(large, texts))
    more = materialize(more, "links")
    return roots if more.isEmpty() else components(links.unionByName(more))


def _in_blocks(large: DataFrame, texts: DataFrame) -> DataFrame:
    """(a, b): links across components among sets that large segments hold together.

    Segments that have a set in common make one family; a family is dealt into
    blocks by hash, and each pair of blocks is compared as a product of matrices.
    """
    stars = large.groupBy("sig").agg(F.min("cls").alias("b"))
    families = components(large.join(stars, "sig").selectExpr("cls AS a", "b"))
    members = families.selectExpr("node AS cls", "root AS family").join(large.select("cls", "root").distinct(), "cls")
    counts = members.groupBy("family").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks"))
    dealt = members.join(counts, "family").withColumn("own", F.pmod(F.xxhash64("cls"), "blocks").cast("int"))
    met = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda k: F.struct(F.least(k, "own").alias("i"), F.greatest(k, "own").alias("j")))
    dealt = _sets_of(dealt.join(texts, "cls").select("cls", "text", "family", "blocks", "own", "root"))
    dealt = dealt.withColumn("met", F.explode(met)).select("family", "met.i", "met.j", "own", "cls", "root", "data")

    def compared(table: pa.Table) -> pa.Table:
        own = table.column("own").to_numpy()
        cls, root = (table.column(c).to_numpy() for c in ("cls", "root"))
        found = [np.frombuffer(x, np.uint64) for x in table.column("data").to_pylist()]
        n = np.array(list(map(len, found)))
        i, j = table.column("i")[0].as_py(), table.column("j")[0].as_py()
        left, right = np.nonzero(own == i)[0], np.nonzero(own == j)[0]
        _, column = np.unique(np.concatenate(found), return_inverse=True)
        row = np.repeat(np.arange(len(found)), n)
        common = np.zeros((len(left), len(right)), np.float32)
        for begin in range(0, int(column.max()) + 1, _COLUMNS):
            at = (column >= begin) & (column < begin + _COLUMNS)
            part = np.zeros((len(found), _COLUMNS), np.float32)
            part[row[at], column[at] - begin] = 1
            common += part[left] @ part[right].T
        linked = (100 * common >= 75 * (n[left][:, None] + n[right][None] - common)) & (root[left][:, None] != root[right][None])
        x, y = np.nonzero(linked)
        a, b = cls[left[x]], cls[right[y]]
        # A forest of these links joins the same sets.
        use = _forest(np.minimum(a, b), np.maximum(a, b))
        return pa.table({"a": pa.array(a[use], pa.int64()), "b": pa.array(b[use], pa.int64())})

    return dealt.groupBy("family", "i", "j").applyInArrow(compared, "a long, b long")


def _forest(a: np.ndarray, b: np.ndarray) -> list[int]:
    """Indices of edges that connect what all of them connect."""
    up: dict[int, int] = {}

    def root(x: int) -> int:
        while up.setdefault(x, x) != x:
            up[x] = x = up[up[x]]
        return x

    use = []
    for k, (x, y) in enumerate(zip(a.tolist(), b.tolist())):
        x, y = root(x), root(y)
        if x != y:
            up[x] = y
            use.append(k)
    return use
