"""Grouping of spelling variants with searches in bidirectional FM-indexes.

Two words are near at one inserted, deleted or replaced character. Of the two one is no shorter; an error in it lies in its first or in its second half, so that the other half is exact. Words are dealt by their exact halves, each as one of its length and as one that has lost a character; a task indexes the words of some groups together and searches those that ask. The place of the error is made definite (of equal neighbours the last is deleted, a greater character replaces a smaller one), so it is in one half alone and each pair is found once. A group that grows beyond a bound is dealt again by halves of what is not yet exact.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .fm_index import Index, near
from .frames import partitions, written

#: Least length and number of occurrences of a word, and how much more frequent its form is.
LENGTH, COUNT, TIMES = 5, 3, 2
#: Fixed value of the query: which hashes damage an occurrence.
DAMAGE = 97
#: Characters of a group that is dealt again, of groups that are indexed together, and words that are searched together.
HOT, BATCH, ASKED = 1 << 20, 1 << 20, 1 << 14
#: Keys of hot groups, each of HOT characters or more, that are broadcast at most.
SENT = 1_000_000
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def vocabulary(docs: DataFrame, least: int = LENGTH, count: int = COUNT, damage: int | None = DAMAGE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """word, n: the runs of letters of all texts, A-Z in lower case, that have at least `least` characters and occur at least `count` times. With damage an occurrence loses a character where crc32(id:run) is divisible by it; a null id counts as an empty one."""
    runs = docs.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"), F.explode(F.regexp_extract_all(F.translate(text_col, UPPER, LOWER), F.lit("[a-zÀ-ÿ]+"), F.lit(0))).alias("word"))
    if damage:
        h = F.crc32(F.concat("id", F.lit(":"), "word"))
        at = (h % F.length("word")).cast("int")
        cut = F.concat(F.substr("word", F.lit(1), at), F.substr("word", at + 2))
        runs = runs.select(F.when(h % damage == 0, cut).otherwise(F.col("word")).alias("word"))
    return runs.where(F.length("word") >= least).groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= count)


def _key(word: Column, m: Column, left: Column, right: Column) -> Column:
    return F.xxhash64(m, left, right, F.substr(word, F.lit(1), left), F.substr(word, F.length(word) - right + 1, right))


def _keyed(rows: DataFrame) -> DataFrame:
    return rows.withColumn("key", _key(F.col("word"), F.col("m"), F.col("left"), F.col("right")))


def _halves(m: Column, left: Column, right: Column) -> Column:
    """The two groups into which words that count as m long, with their first `left` and last `right` characters exact, go: a half of the rest is exact too."""
    half = F.floor((m - left - right) / 2).cast("int")
    both = (left + half, right), (left, m - left - half)
    return F.array(*(F.struct(m.alias("m"), a.alias("left"), b.alias("right")) for a, b in both))


def dealt(words: DataFrame, hot: int = HOT) -> DataFrame:
    """word, n, m, left, right, key: a row for each group that a word belongs to. A word of length m asks, the others, of length m - 1, are only found."""
    zero, size = F.lit(0), F.length("word")
    places = F.concat(_halves(size, zero, zero), _halves(size + 1, zero, zero))
    rows = _keyed(words.select("word", "n", F.inline(places)))
    while True:
        large = rows.where("m - left - right > 1").groupBy("key").agg(F.sum(F.length("word")).alias("chars")).where(F.col("chars") > hot).select("key")
        large = written(large)
        if not (keys := large.count()):
            return rows
        large = F.broadcast(large) if keys <= SENT else large
        again = rows.join(large, "key", "left_semi").where("m - left - right > 1").select("word", "n", F.inline(_halves(F.col("m"), F.col("left"), F.col("right"))))
        stay = rows.where("m - left - right > 1").join(large, "key", "left_anti").unionByName(rows.where("m - left - right <= 1"))
        rows = written(stay.unionByName(_keyed(again)))


def _searched(words: list[str], n: np.ndarray, m: np.ndarray, left: np.ndarray, right: np.ndarray) -> pa.RecordBatch | None:
    """The near words of some whole groups: for each word that has any, how many, and the one of largest n."""
    known = sorted(set(words))
    if len(known) < 2:
        return None
    rank = {w: i for i, w in enumerate(known)}
    own = np.array([rank[w] for w in words])
    count = np.zeros(len(known), np.int64)
    count[own] = n
    letters, text = np.unique(np.frombuffer("".join(known).encode("utf-32-le"), "<u4"), return_inverse=True)
    text = text.astype(np.int32) + 1
    size = np.array([len(w) for w in known])
    at = np.cumsum(size) - size
    index = Index(np.split(text, at[1:]), len(letters))
    asks = np.flatnonzero(size[own] == m)
    pairs = []
    for lo in range(0, len(asks), ASKED):
        some = asks[lo : lo + ASKED]
        q, found = near(index, text, at[own[some]], size[own[some]], left[some], right[some])
        pairs.append((own[some[q]], found))
    a, b = np.concatenate([x for x, _ in pairs] or [[]]).astype(np.int64), np.concatenate([x for _, x in pairs] or [[]]).astype(np.int64)
    if not len(a):
        return None
    one, other = np.concatenate((a, b)), np.concatenate((b, a))
    order = np.lexsort((other, -count[other], one))
    one, other = one[order], other[order]
    first = np.flatnonzero(np.diff(one, prepend=-1))
    name = lambda i: pa.array([known[j] for j in i], pa.string())
    return pa.record_batch([name(one[first]), pa.array(np.diff(np.append(first, len(one)))), pa.array(count[other[first]]), name(other[first])], ["word", "n_near", "best_n", "best"])


def neighbours(words: DataFrame, hot: int = HOT, batch_chars: int = BATCH) -> DataFrame:
    """word, n_near, best_n, best: for words that have near ones, a row or several, of parts of these: how many, and the most frequent (ties: the first in code-point order)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting, chars = [], 0

        def flushed(t: pa.Table) -> Iterator[pa.RecordBatch]:
            out = _searched(t["word"].to_pylist(), *(t[c].to_numpy() for c in ("n", "m", "left", "right")))
            if out is not None:
                yield out

        for batch in batches:
            key, size = batch["key"].to_numpy(), np.asarray(pc.utf8_length(batch["word"]))
            begin = np.flatnonzero(key != np.concatenate(([waiting[-1]["key"][-1].as_py() if waiting else key[0]], key[:-1])))
            lo = 0
            for b in begin.tolist():  # where a batch of groups may end
                chars_to = chars + int(size[lo:b].sum())
                if chars_to >= batch_chars:
                    yield from flushed(pa.Table.from_batches([*waiting, batch.slice(lo, b - lo)]))
                    waiting, chars, lo = [], 0, b
            chars += int(size[lo:].sum())
            waiting.append(batch.slice(lo))
        if waiting:
            yield from flushed(pa.Table.from_batches(waiting))

    n = partitions(words.sparkSession)
    rows = dealt(words, hot).repartition(n, "key").sortWithinPartitions("key")
    return rows.mapInArrow(run, "word string, n_near long, best_n long, best string")


def group(words: DataFrame, times: float = TIMES, hot: int = HOT, batch_chars: int = BATCH) -> DataFrame:
    """word, form, root, n, n_near, form_n for words (word, n; each once). A word's form is its most frequent near word, of equal ones the first in code-point order, if that has `times` its occurrences or more; root follows the forms to the last. Words without near ones stay, with n_near 0 and themselves as root; null words are left out. Without words there are no rows."""
    words = written(words.where("word IS NOT NULL").select("word", F.col("n").cast("long").alias("n")))
    best = F.struct((-F.col("best_n")).alias("less"), F.col("best").alias("best"))
    own = words.select("word", "n", F.lit(0).cast("long").alias("n_near"), F.lit(None).cast("long").alias("best_n"), F.lit(None).cast("string").alias("best"))
    both = own.unionByName(neighbours(words, hot, batch_chars).withColumn("n", F.lit(None).cast("long")))
    merged = both.groupBy("word").agg(F.max("n").alias("n"), F.sum("n_near").alias("n_near"), F.min(F.when(F.col("best").isNotNull(), best)).alias("top"))
    has = -F.col("top.less") >= F.lit(times) * F.col("n")
    forms = written(merged.select("word", F.when(has, F.col("top.best")).alias("form"), "n", "n_near", F.when(has, -F.col("top.less")).alias("form_n")))
    steps = forms.where("form IS NOT NULL").select("word", F.col("form").alias("root"))
    while True:  # each round doubles the steps taken; occurrences double with each, so there are few
        after = steps.select(F.col("word").alias("root"), F.col("root").alias("next"))
        steps = written(steps.join(after, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")))
        if steps.where("moved").isEmpty():
            break
    return forms.join(steps.select("word", "root"), "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def variants(docs: DataFrame, damage: int | None = DAMAGE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """group() of the vocabulary of docs. Null and empty texts have no words; rows that repeat an id or a text each count; a text of any length is one row of the scan. Other columns are not read."""
    return group(vocabulary(docs, damage=damage, id_col=id_col, text_col=text_col))
