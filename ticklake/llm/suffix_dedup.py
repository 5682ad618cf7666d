"""Repeated passages by sparse suffix arrays.

Of each text only the suffixes that begin at minimiser positions are kept: the
place of the smallest SEED-word hash in each window of WINDOW places.  The choice
depends on the words there alone.  So the first WINDOW places of a passage of
LENGTH words choose the same suffix (its anchor) in every document, and these
suffixes agree for at least LENGTH - WINDOW + 1 words (the depth).

1. Suffixes that share their first DEPTH words with no other document are left
   out, by a count of a hash of these words.
2. The others fetch the words around them and become a sorted array, dealt by
   ranges: by their first words, the name (hash) of their first DEPTH words, and
   on to LENGTH words.  Neighbours are compared: the number of words that they have in common cuts
   the array into intervals for each length of a match to the right; in an
   interval the match is extended to the left by the words before.  A place of
   the passage is repeated where all LENGTH words of a window over the suffix
   stand in another document.
3. The windows of a document join to maximal passages.

Tasks hold the array in pieces of bounded size.  An interval of PIECE rows or more is cut and
settled by a min and max id per window over the pieces, each of which sends a window
once; the shared ones come back to their pieces, where each suffix that was cut takes
its own and makes one passage of them.  So a passage that stands in a third of all documents is
spread over tasks like any other.

Equal texts of ids with one text are one document until the end.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ticklake.llm.common import Work, broadcast_if_small, sliced, staged
from ticklake.llm.shingles import WordHashes, mixed, window_hashes, word_array

#: Words of a passage, places of a minimiser window, words of a seed.
LENGTH, WINDOW, SEED = 50, 20, 5
DEPTH = LENGTH - WINDOW + 1
#: Texts whose results are handed to Spark together.
SLICE = 1000
#: Rows of one interval (400 bytes each) that a task holds; a longer one is cut into pieces.
PIECE = 20_000
#: Documents whose ids (8 bytes) may be broadcast; bytes of suffix places that may be.
BROADCAST_IDS, BROADCAST_PLACES = 2_000_000, 32 << 20
#: Rows from which a key is kept out of the shuffle by key, and keys of that kind that may be broadcast.
MANY, BROADCAST_KEYS = 1000, 500_000

_BASE = np.uint64(0x9E3779B97F4A7C15)
_BASE_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


def run_hashes(words: np.ndarray, starts: np.ndarray, length: int) -> np.ndarray:
    """A 64-bit hash of the `length` words at each start, from sums of words
    times powers: (sum of the run) / power of its start."""
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mixed(words) * _powers(_BASE, len(words)), dtype=np.uint64)])
    return mixed((sums[starts + length] - sums[starts]) * _powers(_BASE_INVERSE, len(words) + 1)[starts])


def anchors(words: np.ndarray, chunk: int = 1 << 16) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Minimiser places of a text, and of each the first and the last start of
    a window of LENGTH words that it is the anchor of (every start has one)."""
    if len(words) < LENGTH:
        return (np.empty(0, np.int64),) * 3
    seeds, starts = mixed(window_hashes(words, SEED)), len(words) - LENGTH + 1
    of = np.empty(starts, np.int64)
    for at in range(0, starts, chunk):
        part = np.lib.stride_tricks.sliding_window_view(seeds[at : min(at + chunk, starts) + WINDOW - 1], WINDOW)
        of[at : at + len(part)] = part.argmin(axis=1) + np.arange(at, at + len(part))
    places, first, n = np.unique(of, return_index=True, return_counts=True)
    return places, first, first + n - 1


def _suffixes(docs: DataFrame) -> DataFrame:
    """(key, id, pos) of each kept suffix."""

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashes = WordHashes()
        for batch in sliced(batches, SLICE):
            keys, ids, places = [], [], []
            for key, text in zip(batch["id"], batch["text"]):
                words = word_array(text, hashes)
                if len(words) >= LENGTH:
                    at = anchors(words)[0]
                    keys.append(run_hashes(words, at, DEPTH).view(np.int64))
                    ids.append(np.full(len(at), key, np.int64))
                    places.append(at.astype(np.int32))
            if keys:
                yield pd.DataFrame({"key": np.concatenate(keys), "id": np.concatenate(ids), "pos": np.concatenate(places)})

    return docs.mapInPandas(cut, "key long, id long, pos int")


def _contexts(docs: DataFrame) -> DataFrame:
    """The suffixes at given places (column `places`): the first two words as a
    number, the name of the first DEPTH words, the fewest and most words on the
    left of windows that the suffix is the anchor of, and 32-bit hashes of the
    LENGTH words from there on and of the WINDOW - 1 words before, nearest first
    (zeros beyond the text)."""

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashes, left = WordHashes(), WINDOW - 1
        for batch in sliced(batches, SLICE):
            rows = []
            for key, text, places in zip(batch["id"], batch["text"], batch["places"]):
                words = word_array(text, hashes)
                at, first, last = anchors(words)
                some = np.isin(at, np.asarray(places, np.int64))  # others are of another text with this id
                at, first, last = at[some], first[some], last[some]
                small = np.concatenate([np.zeros(left, np.uint32), (words >> np.uint64(32)).astype(np.uint32), np.zeros(LENGTH, np.uint32)])
                heads = (words[at] & ~np.uint64(0xFFFFFFFF) | words[at + 1] >> np.uint64(32)).view(np.int64)
                names = run_hashes(words, at, DEPTH).view(np.int64)
                for pos, head, name, low, high in zip(at.tolist(), heads.tolist(), names.tolist(), (at - last).tolist(), (at - first).tolist()):
                    middle = pos + left
                    rows.append((head, name, key, pos, low, high, small[middle : middle + LENGTH].tobytes(), small[pos:middle][::-1].tobytes()))
            yield pd.DataFrame(rows, columns=["head", "name", "id", "pos", "low", "high", "after", "before"])

    return docs.mapInPandas(cut, "head long, name long, id long, pos int, low int, high int, after binary, before binary")


def _matrix(column: pd.Series, n: int) -> np.ndarray:
    return np.frombuffer(b"".join(column), np.uint32).reshape(-1, n)


def common_words(after: np.ndarray) -> np.ndarray:
    """The number of first words that neighbours of a sorted array share."""
    same = after[1:] == after[:-1]
    return np.where(same.all(axis=1), after.shape[1], same.argmin(axis=1))


def _names(words: np.ndarray) -> np.ndarray:
    """Hashes of the first 0, 1, ... words of each row."""
    terms = mixed(words.astype(np.uint64) + np.uint64(1)) * _powers(_BASE, words.shape[1])[None, :]
    return np.concatenate([np.zeros((len(words), 1), np.uint64), np.cumsum(terms, axis=1, dtype=np.uint64)], axis=1)


def _windows(rows: pd.DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Every window that the rows' suffixes are the anchors of: its row, the
    number of words on the left, and a hash of its words."""
    sums = _names(np.hstack([_matrix(rows["before"], WINDOW - 1)[:, ::-1], _matrix(rows["after"], LENGTH)]))
    taken = np.arange(WINDOW)[None, :]
    row, taken = np.nonzero((taken >= rows["low"].to_numpy()[:, None]) & (taken <= rows["high"].to_numpy()[:, None]))
    start = WINDOW - 1 - taken
    return row, taken, mixed((sums[row, start + LENGTH] - sums[row, start]) * _powers(_BASE_INVERSE, WINDOW)[start])


def _cut_windows(rows: pd.DataFrame) -> tuple[pd.DataFrame, pd.DataFrame]:
    """The different windows of a piece, with the smallest and largest id of
    each; and its suffixes, each with the start of the last window that it is
    the anchor of and these windows, last first (each begins a word earlier)."""
    row, _, window = _windows(rows)
    ids, window = rows["id"].to_numpy()[row], window.view(np.int64)
    order = np.lexsort((ids, window))
    sorted_ids, different = ids[order], window[order]
    at = np.flatnonzero(np.r_[True, different[1:] != different[:-1]])
    windows = pd.DataFrame({"window": different[at], "first": sorted_ids[at], "last": sorted_ids[np.r_[at[1:], len(ids)] - 1]})
    of_row = np.split(window, np.searchsorted(row, np.arange(1, len(rows))))
    return windows, pd.DataFrame({"id": rows["id"].to_numpy(), "start": (rows["pos"] - rows["low"]).to_numpy(), "windows": of_row})


def _settle(suffixes: pd.DataFrame, shared: pd.DataFrame) -> pd.DataFrame:
    """Passages (id, start, end, first) of a piece's suffixes (id, start,
    windows), one of each that has a shared window (window, first)."""
    if not len(suffixes) or not len(shared):
        return pd.DataFrame({"id": [], "start": [], "end": [], "first": []}, dtype=np.int64)
    sizes = np.array([len(x) for x in suffixes["windows"]])
    row, window = np.repeat(np.arange(len(sizes)), sizes), np.concatenate(suffixes["windows"].to_list())
    back = np.arange(len(row)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    shared = shared.sort_values("window")
    known, first = shared["window"].to_numpy(), shared["first"].to_numpy()
    at = np.minimum(np.searchsorted(known, window), len(known) - 1)
    some = known[at] == window
    row, back, first = row[some], back[some], first[at[some]]
    new = np.flatnonzero(np.r_[True, row[1:] != row[:-1]][: len(row)])
    of, start = row[new], suffixes["start"].to_numpy()[row[new]]
    least, most = back[new], back[np.r_[new[1:], len(row)][: len(new)] - 1]
    first = np.minimum.reduceat(first, new) if len(new) else first
    return pd.DataFrame({"id": suffixes["id"].to_numpy()[of], "start": start - most, "end": start - least + LENGTH, "first": first})


def _compare(rows: pd.DataFrame) -> pd.DataFrame:
    """Passages (id, start, end, first) of a sorted piece of the array."""
    shared, names = common_words(_matrix(rows["after"], LENGTH)), _names(_matrix(rows["before"], WINDOW - 1))
    ids, pos, low, high = (rows[c].to_numpy() for c in ("id", "pos", "low", "high"))
    least, most, first = np.full(len(rows), WINDOW), np.full(len(rows), -1), ids.copy()
    for taken in range(WINDOW):
        at = np.flatnonzero((low <= taken) & (taken <= high))
        if len(at) < 2:
            continue
        interval = np.r_[0, np.cumsum(shared < LENGTH - taken)]
        at = at[np.lexsort((ids[at], names[at, taken], interval[at]))]
        new = (interval[at[1:]] != interval[at[:-1]]) | (names[at[1:], taken] != names[at[:-1], taken])
        starts = np.flatnonzero(np.r_[True, new])
        of = np.cumsum(np.r_[0, new])
        least_id, most_id = ids[at[starts]], ids[at[np.r_[starts[1:], len(at)] - 1]]
        some = (least_id != most_id)[of]
        at, of = at[some], of[some]
        least[at], most[at] = np.minimum(least[at], taken), np.maximum(most[at], taken)
        first[at] = np.minimum(first[at], least_id[of])
    return pd.DataFrame({"id": ids, "start": pos - most, "end": pos - least + LENGTH, "first": first})[most >= 0]


def pieces(batches: Iterator[pd.DataFrame], rows: int) -> Iterator[tuple[pd.DataFrame, np.ndarray]]:
    """A sorted partition in pieces, and of each row whether its interval (equal
    head and name) may go on in another piece or partition.  Only an interval
    of `rows` rows or more is cut inside a partition."""
    rest = opened = None
    for batch in batches:
        if not len(batch):
            continue
        frame = batch if rest is None else pd.concat([rest, batch], ignore_index=True)
        names = frame[["head", "name"]].to_numpy()
        opened = names[0] if opened is None else opened
        begins = np.flatnonzero(np.r_[True, (names[1:] != names[:-1]).any(axis=1)])[-1]
        cut = (names == opened).all(axis=1)
        if len(frame) - begins >= rows:
            opened, rest = names[-1], None
            cut[begins:] = True
            yield frame, cut
        else:
            rest = frame.iloc[begins:]
            if begins:
                yield frame.iloc[:begins], cut[:begins]
    if rest is not None:
        yield rest, np.ones(len(rest), bool)


def _matches(contexts: DataFrame, keys: DataFrame, work: Work) -> DataFrame:
    """(id, start, end, first): repeated windows, joined for each suffix.  Only
    an interval of PIECE rows or more, by its key's count, is cut."""
    rows = PIECE

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        piece = TaskContext.get().partitionId() << 32
        for frame, cut in pieces(batches, rows):
            piece += 1
            cut &= frame["large"].to_numpy()
            if not cut.all() and len(found := _compare(frame[~cut])):
                yield found.assign(piece=-1, window=0, last=0, windows=None)
            if cut.any():
                windows, suffixes = _cut_windows(frame[cut])
                yield windows.assign(piece=piece, id=0, start=0, end=0, windows=None)
                yield suffixes.assign(piece=piece, end=0, first=0, window=0, last=0)

    schema = "id long, start int, end int, first long, piece long, window long, last long, windows array<long>"
    large = keys.where(F.col("n") >= rows).select(F.col("key").alias("name"), F.lit(True).alias("large"))  # few, by their size
    array = contexts.join(F.broadcast(large), "name", "left").withColumn("large", F.coalesce("large", F.lit(False)))
    # ranges may part a large interval anywhere; the last column parts rows that repeat
    parted = F.when(F.col("large"), F.struct(F.substring("before", 1, 8), "id", F.spark_partition_id()))
    array = array.withColumn("parted", parted).repartitionByRange("head", "name", "parted").sortWithinPartitions("head", "name", "after").drop("parted")
    found = work(array.mapInPandas(compare, schema), "suffix_matches")

    cut = found.where("piece >= 0 and windows is null")
    shared = cut.groupBy("window").agg(F.min("first").alias("first"), F.max("last").alias("last")).where("first != last").drop("last")
    shared = cut.select("window", F.col("piece").alias("of_piece")).join(shared, "window")
    suffixes = found.where("windows is not null").select("piece", "id", "start", "windows")
    settled = suffixes.groupBy("piece").cogroup(shared.groupBy("of_piece")).applyInPandas(_settle, "id long, start int, end int, first long")
    return found.where("piece < 0").select("id", "start", "end", "first").unionByName(settled)


def _with_shared_keys(suffixes: DataFrame, keys: DataFrame) -> DataFrame:
    """The suffixes whose key is among the keys (key, n rows); those of keys with many rows aren't shuffled."""
    usual = suffixes.join(keys.select("key"), "key", "left_semi")
    hot = keys.where(F.col("n") >= MANY).select("key")
    if not 0 < hot.count() <= BROADCAST_KEYS:
        return usual
    hot = F.broadcast(hot)
    few = suffixes.join(hot, "key", "left_anti").join(keys.where(F.col("n") < MANY).select("key"), "key", "left_semi")
    return few.unionByName(suffixes.join(hot, "key", "left_semi"))


def repeated_passages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """All maximal passages made of LENGTH-word windows that stand in another
    document too: one row (id_col, start_word, end_word, n_words, first_id) per
    passage, words counted from 0, the end exclusive; first_id is the smallest id
    of a document that shares a part of it, which may be the document's own.

    Words are runs without ASCII white space, A-Z lower-cased.  Null, empty
    and shorter texts have no passages; a text that repeats only within its
    document has none; rows without id are left out; rows that repeat an id are
    one document.  Extra columns are ignored; an empty table gives no rows.
    """
    docs = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).where("id is not null and text is not null")
    work = Work(docs.sparkSession)
    try:
        out = _merged(docs, work)
        out = out.select(
            F.col("id").alias(id_col), F.col("start").alias("start_word"), F.col("end").alias("end_word"),
            (F.col("end") - F.col("start")).alias("n_words"), F.col("first").alias("first_id"),
        )
        return staged(out, "suffix_result")
    finally:
        work.end()


def _merged(docs: DataFrame, work: Work) -> DataFrame:
    """Maximal passages (id, start, end, first)."""
    texts = work(docs.select("id", F.md5("text").alias("md5")), "suffix_texts")
    shared = texts.groupBy("md5").agg(F.min("id").alias("low"), F.max("id").alias("high")).where("low != high").select("md5")
    members = work(texts.join(shared, "md5").distinct(), "suffix_members")
    # an id with several texts is neither left out nor stands for others
    of_members = texts.join(broadcast_if_small(members.select("id").distinct(), BROADCAST_IDS), "id", "left_semi")
    several = work(of_members.groupBy("id").agg(F.min("md5").alias("low"), F.max("md5").alias("high")).where("low != high").select("id"), "suffix_several")
    members = members.join(broadcast_if_small(several, BROADCAST_IDS), "id", "left_anti")
    groups = members.groupBy("md5").agg(F.min("id").alias("rep"))
    copies = work(members.join(groups, "md5").where("id != rep").select("id", "rep"), "suffix_copies")
    copied = copies.select(F.col("rep").alias("id")).distinct()
    others = docs.join(broadcast_if_small(copies.select("id").distinct(), BROADCAST_IDS), "id", "left_anti")

    suffixes = work(_suffixes(others), "suffixes")
    keys = suffixes.groupBy("key").agg(F.min("id").alias("low"), F.max("id").alias("high"), F.count(F.lit(1)).alias("n")).where("low != high")
    keys = work(keys.select("key", "n"), "suffix_keys")
    places = _with_shared_keys(suffixes, keys).groupBy("id").agg(F.collect_set("pos").alias("places"))  # of one document
    places = work(places, "suffix_places")
    size = places.agg(F.sum(F.size("places") * 4 + 32).alias("bytes")).first()["bytes"] or 0
    others = others.join(F.broadcast(places) if size <= BROADCAST_PLACES else places, "id")
    found = _matches(work(_contexts(others), "suffix_contexts"), keys, work)

    # a text with copies is a passage as a whole
    size = F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+"))
    whole = docs.join(broadcast_if_small(copied, BROADCAST_IDS), "id", "left_semi").groupBy("id").agg(F.max(size).cast("int").alias("end"))
    whole = whole.where(F.col("end") >= LENGTH).select("id", F.lit(0).alias("start"), "end", F.col("id").alias("first"))
    found = work(found.unionByName(whole), "suffix_windows")

    by_start = Window.partitionBy("id").orderBy("start", "end")
    reached = F.max("end").over(by_start.rowsBetween(Window.unboundedPreceding, -1))
    parts = found.distinct().withColumn("new", F.coalesce(F.col("start") > reached, F.lit(True)).cast("int"))
    parts = parts.withColumn("part", F.sum("new").over(by_start))
    merged = parts.groupBy("id", "part").agg(F.min("start").alias("start"), F.max("end").alias("end"), F.min("first").alias("first")).drop("part")
    merged = work(merged, "suffix_merged")
    of_copies = merged.join(copies.select(F.col("id").alias("copy"), F.col("rep").alias("id")), "id")
    return merged.unionByName(of_copies.select(F.col("copy").alias("id"), "start", "end", "first"))
