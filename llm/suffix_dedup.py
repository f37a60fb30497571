"""Removal of passages of `length` bytes or more that start more than once in a collection.

Every window of `length` bytes has an anchor: its K-byte substring of least hash. Equal windows
have equal anchors at equal places, so windows in a row with one anchor are cut out as one string, and
only strings with the same anchor need comparing. Strings that occur twice or more are repeated
throughout. A window has at least half of its other bytes on one side of its anchor, so strings whose nearest bytes there differ, on both
sides, from those of all others of the anchor share no window, as most that share an anchor by chance. For an anchor with several other strings, their collection is built column by
column, from the right: each round puts one symbol before every string that reaches the column,
which gives the next column of the Burrows-Wheeler transform by a stable sort of the last order, and the
common prefixes of neighbours by minima of the last ones. A window is repeated if its
common prefix with a neighbour has `length` bytes.

As the strings are aligned at their anchor, a round needs the last round's order only, so rounds are kept in
memory for a bounded number of strings; what would be sequential external files are Spark's
sorted shuffle files, which bring an anchor's strings together. Texts are shuffled for the strings and for the cuts by two queries,
so that the files of the first go before the second begins. Anchors with more than GROUP_STRINGS strings
are split into single windows, which are counted by hash.

Defined results: a null text is empty; repeated rows are documents like others, so their passages are
removed from each; bytes are judged on the input; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructType

from llm.common import Prefix, raw, settle, stash, text_key

LENGTH, K = 200, 32
CHUNK = 1 << 19
GROUP_STRINGS, BATCH_STRINGS = 20_000, 20_000
_POSITION = np.uint64((1 << 20) - 1)


def _near(prefix: Prefix, start: np.ndarray, end: np.ndarray, inside: np.ndarray, s: np.ndarray) -> np.ndarray:
    """32-bit hashes of the bytes from `start` to `end`, where the string has them all; elsewhere its own hash."""
    h = s.copy()
    h[inside] = prefix.of(start[inside], end[inside])
    return (h >> np.uint64(32)).astype(np.uint32).view(np.int32)


def anchored(data: np.ndarray, length: int) -> Iterator[tuple[np.ndarray, ...]]:
    """(anchor hash, string hash, start, windows, place of the anchor, hashes of the bytes just left and right of it) of the strings of one text, in chunks."""
    half = (length - K) // 2
    for base in range(0, max(len(data) - length + 1, 0), CHUNK):
        part = data[base : base + CHUNK + length - 1]
        prefix = Prefix(part)
        at = np.arange(len(part) - K + 1)
        h = prefix.of(at, at + K)
        least = (h & ~_POSITION) | at.astype(np.uint64)
        width = length - K + 1
        span = 1
        while span * 2 <= width:
            least = np.minimum(least[:-span], least[span:])
            span *= 2
        rest = width - span
        if rest:
            least = np.minimum(least[: len(least) - rest], least[rest:])
        where = (least & _POSITION).astype(np.int64)
        first = np.flatnonzero(np.append(True, where[1:] != where[:-1]))
        count = np.diff(np.append(first, len(where)))
        anchor = where[first]
        end = first + count + length - 1
        s = prefix.of(first, end)
        left = _near(prefix, anchor - half, anchor, anchor - half >= first, s)
        right = _near(prefix, anchor + K, anchor + K + half, anchor + K + half <= end, s)
        yield h[anchor], s, first + base, count, anchor - first, left, right


def strings_of(docs: DataFrame, length: int) -> DataFrame:
    """(m, s, doc_id, text_key, start, windows, place, near_left, near_right) of every string of every document."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, keys = batch.column("doc_id").to_pylist(), batch.column("text_key").to_pylist()
            parts, owner = [], []
            for k, text in enumerate(raw(batch.column("text").to_pylist())):
                for found in anchored(np.frombuffer(text, np.uint8), length):
                    parts.append(found)
                    owner += [k] * len(found[0])
            if not parts:
                continue
            m, s, start, count, place, left, right = (np.concatenate(x) for x in zip(*parts, strict=True))
            columns = [
                pa.array(m.view(np.int64)), pa.array(s.view(np.int64)),
                pa.array(names, pa.int64()).take(pa.array(owner)), pa.array(keys, pa.int64()).take(pa.array(owner)),
                pa.array(start), pa.array(count.astype(np.int32)), pa.array(place.astype(np.int32)), pa.array(left), pa.array(right),
            ]
            names_ = ["m", "s", "doc_id", "text_key", "start", "windows", "place", "near_left", "near_right"]
            yield pa.RecordBatch.from_arrays(columns, names_)

    schema = "m long, s long, doc_id long, text_key long, start long, windows int, place int, near_left int, near_right int"
    return docs.mapInArrow(cut, schema)


def repeated_windows(groups: np.ndarray, strings: list[bytes], places: np.ndarray, length: int) -> list[np.ndarray]:
    """Which windows of each string start with `length` bytes of another string of its group.

    `groups` is sorted; `places` tells where the anchor is. Columns count from the anchor.
    """
    n = len(strings)
    left = int(places.max())
    sizes = np.array([len(x) for x in strings])
    ends = sizes - places
    width = left + int(ends.max())
    table = np.full((width, n), 256, dtype=np.int64)
    for k, x in enumerate(strings):
        table[left - places[k] : left - places[k] + len(x), k] = np.frombuffer(x, np.uint8)
    begins, last_start = left - places, left - places + sizes - length
    found = [np.zeros(max(sizes[k] - length + 1, 0), dtype=bool) for k in range(n)]
    order = np.arange(n)
    common = np.zeros(n, dtype=np.int64)  # of each place in the order with the one before
    for column in range(width - 1, -1, -1):
        symbol = table[column]  # one symbol before each string that reaches the column
        key = groups[order] * 257 + symbol[order]
        sort = np.argsort(key, kind="stable")
        key = key[sort]
        same = np.flatnonzero((key[1:] == key[:-1]) & (symbol[order[sort[1:]]] != 256))
        fresh = np.zeros(n, dtype=np.int64)
        if len(same):
            low, high = sort[same] + 1, sort[same + 1]
            near = high == low
            least = np.empty(len(same), dtype=np.int64)
            least[near] = common[low[near]]
            far = np.flatnonzero(~near)
            if len(far):
                bounds = np.stack([low[far], high[far] + 1], axis=1).reshape(-1)
                least[far] = np.minimum.reduceat(np.append(common, 0), bounds)[::2]
            fresh[same + 1] = least + 1
        order, common = order[sort], fresh
        best = np.maximum(common, np.append(common[1:], 0))
        for k in order[best >= length].tolist():
            if begins[k] <= column <= last_start[k]:
                found[k][column - begins[k]] = True
    return found


def _runs(flags: np.ndarray) -> np.ndarray:
    """Rows (first, last) of runs of True."""
    edges = np.flatnonzero(np.diff(np.concatenate([[0], flags.astype(np.int8), [0]])))
    return np.stack([edges[0::2], edges[1::2] - 1], axis=1)


def _compare(length: int):
    """Batches of (m, s, n, place, string), sorted by m, to runs of repeated windows (m, s, low, high)."""

    def solve(rows: list[tuple]) -> pa.RecordBatch:
        m = np.array([r[0] for r in rows])
        _, groups = np.unique(m, return_inverse=True)
        order = np.argsort(groups, kind="stable")
        rows = [rows[k] for k in order.tolist()]
        flags = repeated_windows(groups[order], [r[4] for r in rows], np.array([r[3] for r in rows]), length)
        out: list[tuple] = []
        for r, found in zip(rows, flags, strict=True):
            if r[2] == 1 and found.any():
                out += [(r[0], r[1], int(a), int(b)) for a, b in _runs(found)]
        columns = list(zip(*out, strict=True)) or [[], [], [], []]
        types = [pa.int64(), pa.int64(), pa.int32(), pa.int32()]
        return pa.RecordBatch.from_arrays(
            [pa.array(list(c), t) for c, t in zip(columns, types, strict=True)], ["m", "s", "low", "high"]
        )

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        for batch in batches:
            held += zip(*(batch.column(c).to_pylist() for c in ("m", "s", "n", "place", "string")), strict=True)
            if len(held) >= BATCH_STRINGS:
                cut = len(held)
                while cut and held[cut - 1][0] == held[-1][0]:  # the last group may go on
                    cut -= 1
                if cut:
                    yield solve(held[:cut])
                    held = held[cut:]
        if held:
            yield solve(held)

    return compare


def _single_windows(length: int):
    """Batches of (m, s, n, string) to one row (m, s, n, low, w) a window, w being its hash."""

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = []
            for k, x in enumerate(batch.column("string").to_pylist()):
                data = np.frombuffer(x, np.uint8)
                at = np.arange(len(data) - length + 1)
                parts.append((np.full(len(at), k), at, Prefix(data).of(at, at + length)))
            if not parts:
                continue
            row, at, w = (np.concatenate(x) for x in zip(*parts, strict=True))
            rows = pa.array(row)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c).take(rows) for c in ("m", "s", "n")), pa.array(at.astype(np.int32)), pa.array(w.view(np.int64))],
                ["m", "s", "n", "low", "w"],
            )

    return split


def _same_row(a: str, b: str):
    return F.col(f"{a}.doc_id").eqNullSafe(F.col(f"{b}.doc_id")) & (F.col(f"{a}.text_key") == F.col(f"{b}.text_key"))


def repeated_passages(docs: DataFrame, length: int) -> DataFrame:
    """(doc_id, text_key, low, high): runs of bytes of concerned documents."""
    by_anchor = Window.partitionBy("m")
    by_string = Window.partitionBy("m", "s").orderBy("doc_id", "text_key", "start")
    rows = strings_of(docs, length).repartition("m")
    rows = rows.withColumn("nth", F.row_number().over(by_string))
    rows = rows.withColumns({
        "n": F.count("*").over(Window.partitionBy("m", "s")),
        "total": F.count("*").over(by_anchor),
    })
    rows = rows.where("total > 1")
    # Only strings with the bytes left or right of the anchor of another string can share a window with one.
    alike = [F.count("*").over(Window.partitionBy("m", side)) > F.col("n") for side in ("near_left", "near_right")]
    rows = rows.withColumn("alike", alike[0] | alike[1])
    rows = rows.withColumn("kinds", F.sum(F.when(F.col("alike") & (F.col("nth") == 1), 1).otherwise(0)).over(by_anchor))
    rows = stash(rows.where("n > 1 or alike").drop("total", "near_left", "near_right"), "strings")

    # One of each string of anchors that have a single one among several.
    open_anchors = rows.where("n = 1 and alike").select("m").distinct()
    one_each = rows.where("nth = 1 and alike").join(open_anchors, "m", "left_semi")
    entry = F.struct("m", "s", "n", "kinds", "start", "windows", "place")
    row_key = F.xxhash64("doc_id", "text_key").alias("row_key")
    wanted = one_each.groupBy(row_key, "text_key").agg(F.collect_list(entry).alias("strings"))
    # One shuffle by both keys brings texts to their strings and equal rows together.
    both = docs.select("text", "text_key", row_key).join(wanted, ["row_key", "text_key"])
    both = both.dropDuplicates(["row_key", "text_key"]).select("text", "strings")

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for text, strings in zip(raw(batch.column("text").to_pylist()), batch.column("strings").to_pylist(), strict=True):
                for x in strings:
                    string = text[x["start"] : x["start"] + x["windows"] + length - 1]
                    out.append((x["m"], x["s"], x["n"], x["kinds"], x["place"], string))
            columns = list(zip(*out, strict=True)) or [[]] * 6
            types = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(c), t) for c, t in zip(columns, types, strict=True)],
                ["m", "s", "n", "kinds", "place", "string"],
            )

    fetched = both.mapInArrow(fetch, "m long, s long, n long, kinds long, place int, string binary")
    wide = one_each.where(F.col("kinds") > GROUP_STRINGS).limit(1).count() > 0
    grouped = fetched.where(F.col("kinds") <= GROUP_STRINGS).repartition("m").sortWithinPartitions("m")
    runs = grouped.mapInArrow(_compare(length), "m long, s long, low int, high int")
    if wide:
        single = fetched.where(F.col("kinds") > GROUP_STRINGS).mapInArrow(
            _single_windows(length), "m long, s long, n long, low int, w long"
        )
        single = stash(single, "windows")
        twice = single.groupBy("m", "w").agg(F.sum("n").alias("times")).where("times > 1")
        found = single.where("n = 1").join(twice, ["m", "w"], "left_semi")
        runs = runs.union(found.select("m", "s", "low", F.col("low").alias("high")))

    runs = stash(runs, "runs")
    whole = rows.where("n > 1").select(
        "doc_id", "text_key", F.col("start").alias("low"), (F.col("start") + F.col("windows") + (length - 1)).alias("high")
    )
    partly = rows.where("n = 1 and alike").join(runs, ["m", "s"]).select(
        "doc_id", "text_key", (F.col("start") + F.col("low")).alias("low"),
        (F.col("start") + F.col("high") + length).alias("high"),
    )
    return whole.union(partly)


def marks_of(docs: DataFrame, length: int) -> DataFrame:
    """(doc_id, text_key, runs) of concerned documents, stored; at most a few runs for each anchor of the document."""

    def marks() -> DataFrame:
        passages = repeated_passages(docs, length)
        return passages.groupBy("doc_id", "text_key").agg(F.collect_list(F.struct("low", "high")).alias("runs"))

    return settle(docs.sparkSession, marks, "marks")


def covered(n: int, runs: list[dict]) -> np.ndarray:
    """Which of n bytes are in a run."""
    change = np.zeros(n + 1, dtype=np.int64)
    np.add.at(change, [r["low"] for r in runs], 1)
    np.add.at(change, [r["high"] for r in runs], -1)
    return np.cumsum(change[:-1]) > 0


_CUT = StructType().add("n_removed", LongType()).add("n_spans", LongType()).add("kept_sha256", StringType()).add("kept", StringType())


@F.arrow_udf(_CUT)
def _cut(texts: pa.Array, runs: pa.Array) -> pa.Array:
    """What stays of texts that have runs, null for the others."""
    rows: list[dict | None] = []
    for text, marked in zip(texts.to_pylist(), runs.to_pylist(), strict=True):
        if marked is None:
            rows.append(None)
            continue
        data = raw([text])[0]
        gone = covered(len(data), marked)
        left = np.frombuffer(data, np.uint8)[~gone].tobytes()
        rows.append({
            "n_removed": int(gone.sum()), "n_spans": len(_runs(gone)),
            "kept_sha256": hashlib.sha256(left).hexdigest(), "kept": left.decode("utf-8", "ignore"),
        })
    names = [("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string()), ("kept", pa.string())]
    return pa.array(rows, pa.struct(names))


def remove_passages(
    df: DataFrame, length: int = LENGTH, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """(doc_id, text_key, n_bytes, n_removed, n_spans, kept_sha256, kept) of every row; kept is what stays as text
    (without parts of cut characters), null if nothing goes."""
    docs = df.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    docs = docs.withColumn("text_key", text_key())
    c = _cut(F.when(F.col("runs").isNotNull(), F.col("text")), F.col("runs")).alias("c")
    marked = docs.alias("d").join(marks_of(docs, length).alias("m"), _same_row("d", "m"), "left")
    binary = F.encode("text", "UTF-8")
    facts = marked.select("d.doc_id", "d.text_key", F.octet_length("text").cast("long").alias("n_bytes"), F.sha2(binary, 256).alias("sha"), c)
    return facts.select(
        "doc_id", "text_key", "n_bytes",
        F.coalesce("c.n_removed", F.lit(0)).alias("n_removed"), F.coalesce("c.n_spans", F.lit(0)).alias("n_spans"),
        F.coalesce("c.kept_sha256", "sha").alias("kept_sha256"), "c.kept",
    )


def cut_passages(df: DataFrame, length: int = LENGTH) -> DataFrame:
    """`df` with its texts cut, and n_chars set anew if there is such a column.

    Every row stays, with a null text if it had one, and with the columns of `df`, whatever their names; repeated rows
    repeat each other, so all of them are cut. An empty table gives an empty result.
    """
    docs = df.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    marks = marks_of(docs.withColumn("text_key", text_key()), length).select(F.col("doc_id").alias("_id"), F.col("text_key").alias("_key"), "runs")
    # The runs go to the rows, so the texts move once; texts without runs don't pass through Python.
    same = df["doc_id"].eqNullSafe(marks["_id"]) & (text_key("text") == marks["_key"])
    marked = F.when(marks["runs"].isNotNull(), df["text"])
    text = F.coalesce(_cut(marked, marks["runs"])["kept"], df["text"])
    new = {"text": text, "n_chars": F.length(text).cast("long")}
    columns = [new.get(c, df[f"`{c}`"]).alias(c) for c in df.columns]
    return df.join(marks, same, "left").select(*columns)
