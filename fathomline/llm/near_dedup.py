"""MinHash near-dedup with fast similarity sketching.

A sketch has T coordinates. In round i < T each shingle falls into one bin, with i and a hash as its value; in round T + j all fall into bin j. Rounds go on until no bin is empty, and a bin keeps its least value: each coordinate fills, and a document costs about T log T hashes however long it is. Equal shingle sets are one class from the start. Sketches are banded; classes that share a band are candidates, and a link stands only if the full shingle sets confirm it.

Candidates of a band aren't compared pair by pair. Each bucket compares one member with the others; links make components; only buckets whose members are in different components go on. Of those the pairs with similar sketches are confirmed, first a forest of the most alike, then what is left. A link that isn't looked at joins documents that are joined already. Members of a large bucket meet in cells of bounded size, a task for each. With 64 bands of 6 a pair at 0.75 shares no bucket with probability 4e-6; its sketches agree too little with 3e-7.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .components import components
from .frames import mixed, one_per_id, partitions, pieces, prefix_of, seeds, word_hashes, written, Rolling
from .superwindows import marks

WORDS, BANDS, ROWS = 5, 64, 6
PERCENT = 75
#: Bits of a set's bitmap: the bits in which two differ bound their intersection from above.
BITMAP = 4096
#: Sets that are sketched together.
SKETCHED = 1000
#: Members that one side of a cell holds, and what names a cell.
BLOCK, CELL = 512, ("key", "first", "second")
ENTRY = np.dtype([("key", "i8"), ("cls", "i8")])


def shingles(data: np.ndarray, at: np.ndarray, words: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of each text, in order, as 64-bit hashes, and where each text's start."""
    codes, edge = word_hashes(data, at, lower=True)
    n = np.diff(edge)
    rolling = Rolling(codes)
    count = np.where(n >= words, n - words + 1, np.minimum(n, 1))
    doc = np.repeat(np.arange(len(n)), count)
    begin = np.arange(len(doc)) - np.repeat(np.cumsum(count) - count, count) + edge[:-1][doc]
    h = rolling.of(begin, np.minimum(begin + words, edge[1:][doc]))
    cut = np.concatenate(([0], np.cumsum(count)))
    for i in np.flatnonzero(count > 1):
        h[cut[i] : cut[i + 1]].sort()
    new = marks(h, doc)
    return h[new], np.concatenate(([0], np.cumsum(new)))[cut]


def sketches(h: np.ndarray, cut: np.ndarray, t: int) -> np.ndarray:
    """A row of t coordinates for each set h[cut[i]:cut[i + 1]], none of them empty."""
    n = len(cut) - 1
    none = np.uint64(2**64 - 1)
    out = np.full(n * t, none)
    doc = np.repeat(np.arange(n), np.diff(cut))
    for i, seed in enumerate(seeds(2 * t, 17)):
        v = mixed(h ^ seed)
        bins = (((v >> np.uint64(40)) * np.uint64(t)) >> np.uint64(24)).astype(np.int64) if i < t else i - t
        np.minimum.at(out, doc * t + bins, (v & np.uint64((1 << 40) - 1)) | np.uint64(i << 40))
        if i < 12 or i % 8 == 0:
            open_ = (out.reshape(n, t) == none).any(axis=1)
            if not (stay := open_[doc]).all():
                h, doc = h[stay], doc[stay]
            if not len(h):
                break
    return out.reshape(n, t)


def classes_of(docs: DataFrame, bands: int, rows: int, words: int) -> tuple[DataFrame, DataFrame]:
    """doc_id, n_shingles and cls (a hash of the shingle set; null without shingles) of each document, and key, cls of the classes that share a band with another."""
    parts = partitions(docs.sparkSession)
    bits = (bands - 1).bit_length()  # a key ends with its band
    odd, salt = seeds(rows, 23) | np.uint64(1), seeds(bands, 29)

    def band_keys(h: np.ndarray, cut: np.ndarray, own: np.ndarray) -> np.ndarray:
        """A row of keys, one for each band, for each of the sets `own`."""
        take = np.concatenate([np.arange(cut[i], cut[i + 1]) for i in own])
        s = sketches(h[take], np.concatenate(([0], np.cumsum(np.diff(cut)[own]))), bands * rows).reshape(len(own), bands, rows)
        with np.errstate(over="ignore"):
            return mixed((s * odd).sum(axis=2) ^ salt) >> np.uint64(bits) << np.uint64(bits) | np.arange(bands, dtype=np.uint64)

    names = ["doc_id", "n_shingles", "cls", "part", "entries"]

    def packed(cls: list[np.ndarray], keys: list[np.ndarray]) -> pa.RecordBatch:
        all_ = np.concatenate(keys)
        entries = np.empty(all_.size, ENTRY)
        entries["key"], entries["cls"] = all_.ravel().view(np.int64), np.repeat(np.concatenate(cls), bands)
        to = (all_.ravel() >> np.uint64(11)) % np.uint64(parts)
        entries = entries[np.argsort(to, kind="stable")]
        edge = np.searchsorted(np.sort(to), np.arange(parts + 1, dtype=np.uint64))
        some = [p for p in range(parts) if edge[p] < edge[p + 1]]
        nothing = pa.nulls(len(some), pa.int64())
        return pa.record_batch([nothing, nothing, nothing, pa.array(some, pa.int32()), pa.array([entries[edge[p] : edge[p + 1]].tobytes() for p in some], pa.binary())], names)

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        kept, size = ([], []), 0
        for batch in batches:
            for lo, data, at in pieces(batch["text"]):
                h, cut = shingles(data, at, words)
                n = np.diff(cut)
                with np.errstate(over="ignore"):
                    cls = np.add.reduceat(np.append(mixed(h), np.uint64(0)), cut[:-1])
                    cls = mixed(cls + n.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)).view(np.int64)
                full = n > 0
                yield pa.record_batch([batch["doc_id"].slice(lo, len(n)), pa.array(n), pa.array(cls, mask=~full), pa.nulls(len(n), pa.int32()), pa.nulls(len(n), pa.binary())], names)
                own = np.flatnonzero(full)
                own = own[np.unique(cls[own], return_index=True)[1]]
                own = own[[c not in seen for c in cls[own].tolist()]]
                if not len(own):
                    continue
                if len(seen) < 200_000:
                    seen.update(cls[own].tolist())
                kept[0].append(cls[own])
                kept[1].extend(band_keys(h, cut, own[k : k + SKETCHED]) for k in range(0, len(own), SKETCHED))
                size += len(own)
                if size >= 2 * SKETCHED:
                    yield packed(*kept)
                    kept, size = ([], []), 0
        if size:
            yield packed(*kept)

    def shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = [np.frombuffer(x.as_buffer(), ENTRY) for b in batches for x in b["entries"]]
        if not got:
            return
        e = np.concatenate(got)
        e = e[np.argsort(e["key"], kind="stable")]
        twice = np.zeros(len(e), bool)
        twice[1:] = e["key"][1:] == e["key"][:-1]
        twice[:-1] |= twice[1:]
        e = np.unique(e[twice])
        twice = np.zeros(len(e), bool)
        twice[1:] = e["key"][1:] == e["key"][:-1]
        twice[:-1] |= twice[1:]
        e = e[twice]
        for i in range(0, len(e), 100_000):
            yield pa.record_batch([pa.array(np.ascontiguousarray(e[k][i : i + 100_000])) for k in ("key", "cls")], ["key", "cls"])

    out = written(docs.select("doc_id", "text").mapInArrow(sketch, "doc_id long, n_shingles long, cls long, part int, entries binary"))
    buckets = out.where("part IS NOT NULL").select("part", "entries").repartitionById(parts, "part").mapInArrow(shared, "key long, cls long")
    return out.where("part IS NULL").select("doc_id", "n_shingles", "cls"), written(buckets)


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Of pairs a, b those whose sets (cls, items) have a Jaccard similarity of percent / 100 or more."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch["x"], batch["y"], strict=True):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                both = np.sort(np.concatenate((x, y)))
                common = int((both[1:] == both[:-1]).sum())
                keep.append(100 * common >= percent * (len(both) - common))
            yield pa.record_batch([batch["a"], batch["b"]], ["a", "b"]).filter(pa.array(keep, pa.bool_()))

    own = sets.select(F.col("cls").alias("b"), F.col("items").alias("y"))
    joined = pairs.join(own, "b").join(own.select(F.col("b").alias("a"), F.col("y").alias("x")), "a")
    return joined.select("a", "b", "x", "y").mapInArrow(run, "a long, b long")


def cells(members: DataFrame, block: int = BLOCK) -> DataFrame:
    """members (key, cls, n, label) dealt into cells of their bucket: columns first, second (blocks of members that meet there) and own (the member's block).

    A bucket of `block` members at most is one cell. Of a larger one, the members outside its largest label are cut into blocks of that size, and so are those of the label; blocks of others meet each other and the label's, which needn't meet among themselves. Two members of different labels meet in one cell, and no cell holds more than about two blocks.
    """
    counts = members.groupBy("key", "label").agg(F.count("*").alias("rows"))
    top = counts.groupBy("key").agg(F.max(F.struct("rows", "label")).alias("top"), F.sum("rows").alias("m"))
    blocks = lambda rows: F.ceil(rows / block).cast("int")
    small = F.col("m") <= block
    top = top.select("key", F.when(~small, F.col("top.label")).alias("large"), F.when(small, 1).otherwise(blocks(F.col("m") - F.col("top.rows"))).alias("others"), F.when(small, 0).otherwise(blocks(F.col("top.rows"))).alias("larges"))
    apart = F.col("large").isNull() | (F.col("label") != F.col("large"))
    number = lambda n: F.pmod(F.xxhash64("cls"), F.greatest(n, F.lit(1))).cast("int")
    sized = members.join(top, "key").withColumn("own", F.when(apart, number(F.col("others"))).otherwise(F.col("others") + number(F.col("larges"))))
    meets = F.sequence(F.lit(0), F.when(apart, F.col("others") + F.col("larges")).otherwise(F.col("others")) - 1)
    sized = sized.where(F.col("others") > 0).withColumn("with", F.explode(meets))
    return sized.select("key", "cls", "n", "label", "own", F.least("own", "with").alias("first"), F.greatest("own", "with").alias("second"))


def alike(rows: pa.Table, width: int, percent: int, forest: bool) -> pa.RecordBatch:
    """The pairs a, b of one cell: rows of cls, n, label, own, first, second, sketch, bitmap. width: coordinates of a sketch."""
    share = percent / 100
    floor = share - 5 * np.sqrt(share * (1 - share) / width)
    cls, n, label, own = (rows[c].to_numpy() for c in ("cls", "n", "label", "own"))
    s = np.frombuffer(b"".join(rows["sketch"].to_pylist()), np.uint16).reshape(len(cls), -1)
    bits = np.frombuffer(b"".join(rows["bitmap"].to_pylist()), np.uint64).reshape(len(cls), -1)
    names, group = np.unique(label, return_inverse=True)
    x, y = (np.flatnonzero(own == rows[side][0].as_py()) for side in ("first", "second"))
    same_block = rows["first"][0].as_py() == rows["second"][0].as_py()
    if len(y) < len(x):
        x, y = y, x
    found = []
    for i in x:
        j = y[(group[y] != group[i]) & (np.minimum(n[y], n[i]) * 100 >= np.maximum(n[y], n[i]) * percent)]
        if same_block:
            j = j[j > i]
        same = (s[j] == s[i]).mean(axis=1)
        j, same = j[same >= floor], same[same >= floor]
        common = (n[j] + n[i] - np.bitwise_count(bits[j] ^ bits[i]).sum(axis=1, dtype=np.int64)) // 2  # or fewer: bits that differ are shingles that do
        here = 100 * common >= percent * (n[j] + n[i] - common)
        found.append(np.stack((np.full(len(j), i), j, same))[:, here])
    i, j, same = np.concatenate(found, axis=1) if found else np.empty((3, 0))
    i, j = i.astype(np.int64), j.astype(np.int64)
    if forest:
        up, keep = np.arange(len(names)), []

        def root(x):
            while up[x] != x:
                up[x] = x = up[up[x]]
            return x

        for k in np.argsort(-same, kind="stable"):
            x, y = root(group[i[k]]), root(group[j[k]])
            if x != y:
                up[x] = y
                keep.append(k)
        i, j = i[keep], j[keep]
    return pa.record_batch([pa.array(np.minimum(cls[i], cls[j])), pa.array(np.maximum(cls[i], cls[j]))], ["a", "b"])


def likely(members: DataFrame, sets: DataFrame, coordinates: int, percent: int, forest: bool, block: int = BLOCK) -> DataFrame:
    """Pairs a, b of a bucket's members with different labels whose sketches agree in enough coordinates: so many that a pair at the threshold falls short with probability 3e-7, and whose bitmaps leave room for the similarity. A pair may come from each band that it shares. With forest only the most alike pairs that would join a cell's labels, fewer than it has members."""

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 1000):
                some = batch.slice(lo, 1000)
                h = [np.frombuffer(x.as_buffer(), np.uint64) for x in some["items"]]
                s = (sketches(np.concatenate(h), np.concatenate(([0], np.cumsum([len(x) for x in h]))), coordinates) & np.uint64(0xFFFF)).astype(np.uint16)
                bits = np.zeros((len(h), BITMAP), bool)
                for row, x in zip(bits, h, strict=True):
                    row[(x % np.uint64(BITMAP)).astype(np.int64)] = True
                yield pa.record_batch([some["cls"], pa.array([x.tobytes() for x in s], pa.binary()), pa.array([x.tobytes() for x in np.packbits(bits, axis=1)], pa.binary())], ["cls", "sketch", "bitmap"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = []  # of the cell that the last batch ended in
        for batch in batches:  # in order of cell
            if not batch.num_rows:
                continue
            cut = np.append(np.flatnonzero(marks(*(batch[c].to_numpy() for c in CELL))), batch.num_rows)
            for lo, hi in zip(cut[:-1], cut[1:], strict=True):
                part = batch.slice(lo, hi - lo)
                if rest and any(rest[0][c][0] != part[c][0] for c in CELL):
                    yield alike(pa.Table.from_batches(rest), coordinates, percent, forest)
                    rest = []
                rest.append(part)
        if rest:
            yield alike(pa.Table.from_batches(rest), coordinates, percent, forest)

    of = sets.join(members.select("cls").distinct(), "cls", "left_semi").mapInArrow(sketch, "cls long, sketch binary, bitmap binary")
    rows = cells(members, block).join(of, "cls").select(*CELL, "own", "cls", "n", "label", "sketch", "bitmap").repartition(partitions(members.sparkSession), *CELL).sortWithinPartitions(*CELL)
    return rows.mapInArrow(run, "a long, b long")


def links_of(buckets: DataFrame, sets: DataFrame, sizes: DataFrame, coordinates: int, percent: int) -> DataFrame | None:
    """Links a, b that join what the buckets' confirmed links join. sizes: cls, n."""
    ratio = lambda x, y: (F.least(x, y) * 100 >= F.greatest(x, y) * percent)  # noqa: E731  sets of other sizes can't be similar
    if buckets.isEmpty():
        return None
    # the member that shares most buckets with most others leads: in a group of edited copies, what they were made from
    degree = buckets.join(buckets.groupBy("key").agg(F.count("*").alias("m")), "key").groupBy("cls").agg(F.sum("m").alias("degree"))
    members = written(buckets.join(sizes, "cls").join(degree, "cls").select("key", "cls", "n", "degree"))
    lead = members.groupBy("key").agg(F.max(F.struct("degree", "cls", "n")).alias("lead")).select("key", F.col("lead.cls").alias("a"), F.col("lead.n").alias("m"))
    pairs = members.join(lead, "key").where((F.col("cls") != F.col("a")) & ratio(F.col("n"), F.col("m"))).select(F.least("a", "cls").alias("a"), F.greatest("a", "cls").alias("b"))
    checked = links = None
    for turn in ("lead", "forest", "rest"):
        pairs = pairs.distinct()
        pairs = written(pairs.join(checked, ["a", "b"], "left_anti") if checked is not None else pairs)
        new = written(confirmed(pairs, sets, percent))
        links = new if links is None else links.unionByName(new)
        checked = pairs if checked is None else checked.unionByName(pairs)
        if turn == "rest":
            break
        labelled = members.drop("label").join(components(links).withColumnRenamed("id", "cls"), "cls", "left").withColumn("label", F.coalesce("label", "cls"))
        open_ = labelled.groupBy("key").agg(F.min("label").alias("l"), F.max("label").alias("m")).where("l != m").select("key")
        members = written(labelled.join(open_, "key", "left_semi").select("key", "cls", "n", "label"))
        if members.isEmpty():
            break
        pairs = likely(members, sets, coordinates, percent, forest=turn == "lead")
    return links


def cluster(docs: DataFrame, bands: int = BANDS, rows: int = ROWS, words: int = WORDS, percent: int = PERCENT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id (the smallest id that links reach) and kept (whether that is the document itself).

    A null, empty or blank text has no shingles and is linked with nothing. Rows with a null id take no part; of rows repeating an id the one with the greatest text counts. Other columns are not read.
    """
    docs = one_per_id(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")), "doc_id", "text")
    own, buckets = classes_of(docs, bands, rows, words)
    classes = written(own.where("cls IS NOT NULL").groupBy("cls").agg(F.min("doc_id").alias("rep"), F.max("n_shingles").alias("n")))
    shared = classes.join(buckets.select("cls").distinct(), "cls", "left_semi").select("cls", F.col("rep").alias("doc_id"))

    def items(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, data, at in pieces(batch["text"]):
                h, cut = shingles(data, at, words)
                yield pa.record_batch([batch["cls"].slice(lo, len(at) - 1), pa.array([h[a:b].tobytes() for a, b in zip(cut[:-1], cut[1:], strict=True)], pa.binary())], ["cls", "items"])

    sets = written(docs.join(shared, "doc_id").select("cls", "text").mapInArrow(items, "cls long, items binary"))
    links = links_of(buckets, sets, classes.select("cls", "n"), bands * rows, percent)
    if links is None:
        found = own.join(classes, "cls", "left").withColumn("component_id", F.coalesce("rep", "doc_id"))
    else:
        labels = classes.join(components(links).withColumnRenamed("id", "cls"), "cls")
        least = labels.groupBy("label").agg(F.min("rep").alias("least"))
        to = classes.join(labels.join(least, "label").select("cls", "least"), "cls", "left").select("cls", F.coalesce("least", "rep").alias("least"))
        found = own.join(to, "cls", "left").withColumn("component_id", F.coalesce("least", "doc_id"))
    return found.select("doc_id", "n_shingles", "component_id", (F.col("doc_id") == F.col("component_id")).alias("kept"))


def deduplicated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **params) -> DataFrame:
    """The rows of docs, with all their columns, of the document that each group keeps; one row of those that repeat an id, with the greatest text.

    Rows with a null id end here. Documents of null, empty or blank texts stay. An empty table gives none.
    """
    kept = cluster(docs, id_col=id_col, text_col=text_col, **params).where("kept").select(F.col("doc_id").alias(id_col))
    rows = docs.join(kept, id_col, "left_semi").select(docs.columns)
    if docs.groupBy(id_col).count().where("count > 1").isEmpty():
        return rows
    turn = prefix_of(docs) + "turn"
    first = Window.partitionBy(id_col).orderBy(F.col(text_col).desc_nulls_last())
    return rows.withColumn(turn, F.row_number().over(first)).where(F.col(turn) == 1).drop(turn)
