"""Suffix-array dedup: bytes covered by a 400-byte string that also starts elsewhere.

Prefix doubling. The rank of a position is a 64-bit name of the string that starts there: names of
25 bytes come from the content, and the name of 2h bytes is the name of the pair (rank at the
position, rank h further on), up to 400. Spark deals the names out, tasks sort them, and what
is unique goes no further:

1. Names of 200 bytes, at sampled positions only. Each 400-byte window takes the smallest of the
   201 names inside it, so equal windows sample at equal offsets, and neighbouring windows share
   a sample. A window whose sample is unique is unique. With the sample go the names of the whole
   range of windows it stands for: an equal range elsewhere settles them all.
2. Names of 400 bytes of all windows that are left, from the ranges not settled and from one
   representative of each settled range next to them.

Equal texts are one text with a count. A task sends equal names once, so a passage in a third
of all documents is one name per task.

The same two rounds over words instead of bytes (names of 3 words doubled to 48, two of those for 51; samples of 12)
find the passages of over 50 words that another row holds too, which may be shorter than 400 bytes.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from hashlib import sha256
from typing import NamedTuple
from uuid import uuid4

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fathomline.llm.common import col, short_batches
from fathomline.llm.shingles import mixed, powers, word_hashes
from fathomline.session import cut_lineage, scratch_path

LENGTH = 400  # bytes of a repeated string
FIRST = 25  # bytes of the first names; doubled four times
SAMPLED = LENGTH // 2
PASSAGE = 51  # words of a passage that rows share
PASSAGE_FIRST = 3  # words of the first names; doubled four times
PASSAGE_SAMPLED = 12
SEGMENT = 1 << 20  # windows of a text that are named at once
BUCKET_SAMPLES = 500_000  # samples of a bucket, about 14 MB
BUCKET_WINDOWS = 1_000_000
HELD_WINDOWS = 2_000_000  # that a task names before it sends them

_U = np.uint64
_LEFT, _RIGHT = _U(0xA0761D6478BD642F), _U(0xE7037ED1A0B428DB)
_BYTES = mixed(np.arange(1, 257, dtype=_U) * _U(0x8EBC6AF09C88C6E3))
_LOW = _U((1 << 24) - 1)

REPEATED, OPEN, SHOWN = 1, 2, 3  # settled; to be settled by windows; settled, and its windows settle others


def paired(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    return mixed(left * _LEFT + right * _RIGHT)


def ranks(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Names of the 200 and the 400 bytes from each position on, where there are as many."""
    up, down = powers(len(data) + 1)
    sums = np.zeros(len(data) + 1, dtype=_U)
    np.cumsum(_BYTES[data] * up[:-1], out=sums[1:])
    names = mixed((sums[FIRST:] - sums[:-FIRST]) * down[: len(data) - FIRST + 1])
    h = FIRST
    while h < SAMPLED:
        names = paired(names[:-h], names[h:])
        h *= 2
    return names, paired(names[:-h], names[h:])


def smallest(names: np.ndarray, width: int) -> np.ndarray:
    """For each run of ``width`` neighbours the place of the smallest name, the first of equals."""
    n = len(names)
    marked = np.full(-(-n // width) * width, ~_U(0), dtype=_U)
    marked[:n] = (names & ~_LOW) | np.arange(n, dtype=_U)
    block = marked.reshape(-1, width)
    ahead = np.minimum.accumulate(block, axis=1).ravel()
    back = np.minimum.accumulate(block[:, ::-1], axis=1)[:, ::-1].ravel()
    return (np.minimum(back[: n - width + 1], ahead[width - 1 : n]) & _LOW).astype(np.int64)


def as_bytes(text: str | None) -> np.ndarray:
    return np.frombuffer((text or "").encode("utf-8", "surrogatepass"), dtype=np.uint8)


def word_ranks(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Names of the 12 and the 51 words from each position on, where there are as many."""
    names = words
    for k in range(1, PASSAGE_FIRST):
        names = paired(names[:-1], words[k:])
    h = PASSAGE_FIRST
    while h < PASSAGE_SAMPLED:
        names = paired(names[:-h], names[h:])
        h *= 2
    sampled = names
    while 2 * h <= PASSAGE:
        names = paired(names[:-h], names[h:])
        h *= 2
    return sampled, paired(names[: h - PASSAGE], names[PASSAGE - h :])


class Unit(NamedTuple):
    """What texts are cut into, the names of its strings, and whether only other rows count as elsewhere."""

    read: Callable[[str | None], np.ndarray]
    ranks: Callable[[np.ndarray], tuple[np.ndarray, np.ndarray]]
    length: int
    sampled: int
    across: bool


BYTES = Unit(as_bytes, ranks, LENGTH, SAMPLED, False)
WORDS = Unit(lambda text: word_hashes(text or ""), word_ranks, PASSAGE, PASSAGE_SAMPLED, True)


def ranges(data: np.ndarray, unit: Unit = BYTES) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray, int]]:
    """Per segment: first and last window of each range, name of its sample, name of the range, names of all windows, and the segment's start."""
    for at in range(0, len(data) - unit.length + 1, SEGMENT):
        half, full = unit.ranks(data[at : at + SEGMENT + unit.length - 1])
        place = smallest(half, unit.length - unit.sampled + 1)
        low = np.flatnonzero(np.concatenate(([True], place[1:] != place[:-1])))
        high = np.append(low[1:], len(place)) - 1
        # Windows at both ends cover the range, so their names and the distance name all of it.
        name = paired(full[low], full[high]) + (high - low).astype(_U)
        yield low, high, half[place[low]], name, full, at


def range_table(data: np.ndarray, unit: Unit = BYTES) -> tuple[np.ndarray, ...]:
    """``ranges`` of a whole text: first and last window, sample, name."""
    parts = [(low + at, high + at, sample, name) for low, high, sample, name, _, at in ranges(data, unit)]
    if not parts:
        return (np.empty(0, dtype=np.int64),) * 2 + (np.empty(0, dtype=_U),) * 2
    return tuple(np.concatenate(p) for p in zip(*parts))


SAMPLE = np.dtype([("sample", "<u8"), ("name", "<u8"), ("row", "<i4"), ("place", "<i4"), ("seen", "i1")])
WINDOW = np.dtype([("name", "<u8"), ("sample", "<u4"), ("row", "<i4"), ("place", "<i4"), ("seen", "i1")])
REPLY = np.dtype([("row", "<i4"), ("place", "<i4"), ("state", "i1")])
SENT = "bucket long, body binary"
ONCE, MANY, ANSWERED = 0, 1, 2  # seen by the task that sends it; what is answered only passes through a bucket


def _sorted_groups(records: np.ndarray, *keys: str) -> tuple[np.ndarray, np.ndarray]:
    """Records sorted by the keys, and where each group of equal ones begins."""
    records = records[np.lexsort([records[k] for k in reversed(keys)])]
    new = np.ones(len(records), dtype=bool)
    if len(records) > 1:
        new[1:] = np.logical_or.reduce([records[k][1:] != records[k][:-1] for k in keys])
    return records, new


def _marked(records: np.ndarray, *keys: str) -> np.ndarray:
    """Of equal records the first asks for all of a task, the others are answered."""
    records, new = _sorted_groups(records, *keys)
    several = np.bincount(np.cumsum(new) - 1)[np.cumsum(new) - 1] > 1 if len(records) else new
    records["seen"] = np.where(several, np.where(new, MANY, ANSWERED), ONCE)
    return records


def _marked_across(records: np.ndarray, *keys: str) -> np.ndarray:
    """``_marked`` where several means several rows. What is seen already counts as several; of equal records of one row the first goes on."""
    records, new_row = _sorted_groups(records, *keys, "row")
    if not len(records):
        return records
    new = np.ones(len(records), dtype=bool)
    new[1:] = np.logical_or.reduce([records[k][1:] != records[k][:-1] for k in keys])
    of = np.cumsum(new) - 1
    several = ((np.bincount(of, weights=new_row) > 1) | (np.bincount(of, weights=records["seen"]) > 0))[of]
    records["seen"] = np.where(several, np.where(new, MANY, ANSWERED), ONCE)
    return records[new_row]


def _asked_of(held: list[np.ndarray], unit: Unit, *keys: str) -> np.ndarray:
    return (_marked_across if unit.across else _marked)(np.concatenate(held), *keys)


def _several(of: np.ndarray, seen: np.ndarray, texts: np.ndarray, unit: Unit) -> np.ndarray:
    """Per group of equal records, whether it is one of several."""
    many = np.bincount(of, weights=seen) > 0
    if not unit.across or not len(of):
        return (np.bincount(of) > 1) | many
    starts = np.flatnonzero(np.concatenate(([True], of[1:] != of[:-1])))
    return (np.minimum.reduceat(texts, starts) != np.maximum.reduceat(texts, starts)) | many


def _packed(records: np.ndarray, rows: np.ndarray, bucket: np.ndarray) -> pd.DataFrame:
    """Records per bucket, with the two ids of the texts they are of."""
    order = np.argsort(bucket, kind="stable")
    records, bucket = records[order], bucket[order]
    starts = np.flatnonzero(np.concatenate(([True], bucket[1:] != bucket[:-1]))) if len(bucket) else []
    out = []
    for s, e in zip(starts, [*starts[1:], len(records)]):
        part = records[s:e].copy()
        used, part["row"] = np.unique(part["row"], return_inverse=True)
        out.append((int(bucket[s]), np.array([len(used)], dtype=np.int64).tobytes() + rows[used].tobytes() + part.tobytes()))
    return pd.DataFrame(out, columns=["bucket", "body"]).astype({"bucket": "int64"})


def _sent(records: np.ndarray, rows: np.ndarray, buckets: int, key: str) -> pd.DataFrame:
    """Equal names meet in a bucket; what is answered goes by its text, so that a frequent name fills no bucket."""
    by_text = (rows[records["row"], 0] % buckets).astype(np.int64)
    by_name = (records[key] % _U(buckets)).astype(np.int64)
    return _packed(records, rows, np.where(records["seen"] == ANSWERED, by_text, by_name))


def _gathered(blobs, kind: np.dtype) -> tuple[np.ndarray, np.ndarray]:
    """Records of several packs and the ids of their texts."""
    rows, records, at = [], [], 0
    for blob in blobs:
        n = int(np.frombuffer(blob, dtype=np.int64, count=1)[0])
        rows.append(np.frombuffer(blob, dtype=np.int64, offset=8, count=2 * n).reshape(-1, 2))
        part = np.frombuffer(blob, dtype=kind, offset=8 + 16 * n).copy()
        part["row"] += at
        at += n
        records.append(part)
    return np.concatenate(records), np.concatenate(rows)


def _answers(records: np.ndarray, state: np.ndarray, rows: np.ndarray, buckets: int) -> pd.DataFrame:
    """What a bucket found out, packed for the groups of texts it goes back to."""
    some = state > 0
    out = np.empty(int(some.sum()), dtype=REPLY)
    out["row"], out["place"], out["state"] = records["row"][some], records["place"][some], state[some]
    return _packed(out, rows, (rows[out["row"], 0] % buckets).astype(np.int64) if len(out) else np.empty(0, dtype=np.int64))


def _delivered(group: pd.DataFrame) -> pd.DataFrame:
    """The answers for each text in one row."""
    records, rows = _gathered(group["body"], REPLY)
    texts, of = np.unique(rows, axis=0, return_inverse=True)
    records["row"] = of.ravel()[records["row"]]
    records, new = _sorted_groups(records, "row")
    starts = np.flatnonzero(new)
    bodies = [records[s:e].tobytes() for s, e in zip(starts, [*starts[1:], len(records)])]
    used = records["row"][starts]
    return pd.DataFrame({"f": texts[used, 0], "g": texts[used, 1], "body": bodies})


def _sample_sender(buckets: int, unit: Unit = BYTES):
    def send(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = []
            for i, (text, copies) in enumerate(zip(batch["text"], batch["copies"])):
                _, _, sample, name = range_table(unit.read(text), unit)
                part = np.zeros(len(sample), dtype=SAMPLE)
                part["sample"], part["name"], part["row"], part["place"] = sample, name, i, np.arange(len(sample))
                part["seen"] = MANY if unit.across and copies > 1 else ONCE
                found.append(part)
            rows = batch[["f", "g"]].to_numpy(dtype=np.int64)
            yield _sent(_asked_of(found, unit, "sample", "name"), rows, buckets, "sample")

    return send


def _sample_settler(buckets: int, unit: Unit = BYTES):
    def settle(bucket: pd.DataFrame) -> pd.DataFrame:
        everything, rows = _gathered(bucket["body"], SAMPLE)
        asked = everything["seen"] != ANSWERED
        done = everything[~asked]
        records, new_name = _sorted_groups(everything[asked], "sample", "name")
        new_sample = np.ones(len(records), dtype=bool)
        new_sample[1:] = records["sample"][1:] != records["sample"][:-1]
        of_sample, of_name = np.cumsum(new_sample) - 1, np.cumsum(new_name) - 1
        settled = _several(of_name, records["seen"], rows[records["row"], 0], unit)[of_name]
        # A range alone with its sample is unique, unless it is one of several of a task.
        is_open = ~settled & (np.bincount(of_sample)[of_sample] > 1)
        has_open = np.bincount(of_sample, weights=is_open) > 0
        shown = settled & new_name & has_open[of_sample]
        state = np.where(shown, SHOWN, np.where(settled, REPEATED, np.where(is_open, OPEN, 0)))
        return _answers(np.concatenate((records, done)), np.concatenate((state, np.full(len(done), REPEATED))), rows, buckets)

    return settle


def _known(states: bytes | None) -> np.ndarray:
    return np.frombuffer(states or b"", dtype=REPLY)


def _window_sender(buckets: int, unit: Unit = BYTES):
    def send(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = batch[["f", "g"]].to_numpy(dtype=np.int64)
            held: list[np.ndarray] = []
            for i, (text, states) in enumerate(zip(batch["text"], batch["states"])):
                got = _known(states)
                asked = got["place"][got["state"] >= OPEN]
                if not len(asked):
                    continue
                shown = got["place"][got["state"] == SHOWN]
                first = 0
                for low, high, sample, _, full, at in ranges(unit.read(text), unit):
                    here = asked[(asked >= first) & (asked < first + len(low))] - first
                    of_shown = np.isin(here + first, shown) & unit.across  # its windows are in several rows
                    first += len(low)
                    if not len(here):
                        continue
                    n = high[here] - low[here] + 1
                    ends = np.cumsum(n)
                    places = np.arange(ends[-1]) - np.repeat(ends - n, n) + np.repeat(low[here], n)
                    part = np.zeros(len(places), dtype=WINDOW)
                    part["name"], part["row"], part["place"] = full[places], i, places + at
                    part["sample"] = np.repeat(sample[here] & _U(0xFFFFFFFF), n)
                    part["seen"] = np.where(np.repeat(of_shown, n), MANY, ONCE)
                    held.append(part)
                    if sum(map(len, held)) >= HELD_WINDOWS:
                        yield _sent(_asked_of(held, unit, "name", "sample"), rows, buckets, "name")
                        held = []
            if held:
                yield _sent(_asked_of(held, unit, "name", "sample"), rows, buckets, "name")

    return send


def _window_settler(buckets: int, unit: Unit = BYTES):
    def settle(bucket: pd.DataFrame) -> pd.DataFrame:
        everything, rows = _gathered(bucket["body"], WINDOW)
        asked = everything["seen"] != ANSWERED
        done = everything[~asked]
        records, new = _sorted_groups(everything[asked], "name", "sample")
        of = np.cumsum(new) - 1
        several = _several(of, records["seen"], rows[records["row"], 0], unit)[of]
        state = np.concatenate((np.where(several, REPEATED, 0), np.full(len(done), REPEATED)))
        return _answers(np.concatenate((records, done)), state, rows, buckets)

    return settle


def cover(text: str | None, copies: int, states: bytes | None, windows: bytes | None) -> tuple[int, list[tuple[int, int]]]:
    """(bytes of the text, removed spans)."""
    data = as_bytes(text)
    n = len(data)
    if n < LENGTH:
        return n, []
    if copies > 1:
        return n, [(0, n)]
    got = _known(states)
    change = np.zeros(n + 1, dtype=np.int32)
    settled = got["place"][(got["state"] == REPEATED) | (got["state"] == SHOWN)]
    if len(settled):
        low, high, _, _ = range_table(data)
        settled = np.unique(settled)
        np.add.at(change, low[settled], 1)
        np.add.at(change, high[settled] + LENGTH, -1)
    if windows:
        places = np.unique(_known(windows)["place"])
        np.add.at(change, places, 1)
        np.add.at(change, places + LENGTH, -1)
    inside = np.concatenate(([False], np.cumsum(change)[:n] > 0, [False]))
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    return n, list(zip(edges[::2].tolist(), edges[1::2].tolist()))


def coverer():
    @F.pandas_udf("struct<n_bytes: long, spans: array<struct<start: long, end: long>>, sha: string>")
    def covered(texts: pd.Series, copies: pd.Series, states: pd.Series, windows: pd.Series) -> pd.DataFrame:
        out = []
        for text, c, s, w in zip(texts, copies, states, windows):
            n, spans = cover(text, c, s, w)
            data = as_bytes(text).tobytes()
            kept = b"".join(data[a:b] for a, b in zip([0, *[e for _, e in spans]], [*[s for s, _ in spans], n]))
            out.append((n, [{"start": a, "end": b} for a, b in spans], sha256(kept).hexdigest()))
        return pd.DataFrame(out, columns=["n_bytes", "spans", "sha"])

    return covered


def longest_passage(text: str | None, copies: int, states: bytes | None, windows: bytes | None) -> int:
    """Words of the longest run whose every 51 words are in another row too; 0 if there is none."""
    words = WORDS.read(text)
    if len(words) < PASSAGE:
        return 0
    if copies > 1:
        return len(words)
    got, places = _known(states), _known(windows)["place"]
    settled = got["place"][got["state"] != OPEN]
    if not len(settled) and not len(places):
        return 0
    found = list(ranges(words, WORDS))
    name, full = np.concatenate([r[3] for r in found]), np.concatenate([r[4] for r in found])
    low, high = np.concatenate([r[0] + r[5] for r in found]), np.concatenate([r[1] + r[5] for r in found])
    # Rows were told of the first of equal strings only.
    equal = np.isin(name, name[settled])
    change = np.zeros(len(full) + 1, dtype=np.int32)
    np.add.at(change, low[equal], 1)
    np.add.at(change, high[equal] + 1, -1)
    shared = (np.cumsum(change)[:-1] > 0) | np.isin(full, full[places])
    edges = np.flatnonzero(np.diff(np.concatenate(([False], shared, [False]))))
    return int((edges[1::2] - edges[::2]).max()) + PASSAGE - 1 if len(edges) else 0


def passage_reader():
    @F.pandas_udf("long")
    def read(texts: pd.Series, copies: pd.Series, states: pd.Series, windows: pd.Series) -> pd.Series:
        return pd.Series([longest_passage(*one) for one in zip(texts, copies, states, windows)], dtype="int64")

    return read


def _answered(sent: DataFrame, settle, name: str) -> DataFrame:
    """(f, g, name): what the buckets found out about each text."""
    answers = sent.groupBy("bucket").applyInPandas(settle, SENT)
    texts = answers.groupBy("bucket").applyInPandas(_delivered, "f long, g long, body binary")
    return cut_lineage(texts.withColumnRenamed("body", name))


def _two_rounds(base: DataFrame, unit: Unit, least_bytes: int, sizes: int) -> DataFrame:
    """(f, g, states, windows): what is known of the ranges of each text, and of the windows of those left open."""
    buckets = max(1, sizes // (BUCKET_SAMPLES * SAMPLED // 2))
    long_enough = base.filter(F.octet_length("text") >= least_bytes)
    sent = long_enough.select("f", "g", "text", "copies").mapInPandas(_sample_sender(buckets, unit), SENT)
    states = _answered(sent, _sample_settler(buckets, unit), "states")

    buckets = max(1, sizes // (8 * BUCKET_WINDOWS))
    left = long_enough.join(states, ["f", "g"]).select("f", "g", "text", "states")
    windows = _answered(left.mapInPandas(_window_sender(buckets, unit), SENT), _window_settler(buckets, unit), "windows")
    return states.join(windows, ["f", "g"], "left")


def repeated_spans(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """(doc_id, n_bytes, spans, kept_sha256, longest_shared) of every row; spans are the maximal removed runs, as byte offsets.

    ``longest_shared`` is the number of words in the longest run whose every 51 words also occur in another row, A-Z in lower case and
    white space of any kind between them; 0 without such a run. It removes nothing.

    Null counts as empty. Texts under 400 bytes keep everything. Rows with equal texts are occurrences of each other, also with one id. An
    empty table gives an empty table.
    """
    spark = docs.sparkSession
    short_batches(spark)
    whole = F.coalesce(col(text), F.lit(""))
    rows = docs.select(col(doc_id).alias("doc_id"), whole.alias("text"))
    rows = rows.withColumns({"f": F.xxhash64("text"), "g": F.xxhash64(F.lit("second"), "text")})
    texts = rows.groupBy("f", "g").agg(F.first("text").alias("text"), F.count(F.lit(1)).alias("copies"))

    # Dealt by id once and kept so: what later steps find out about a text comes to it, and the texts stay where they are.
    stored = f"texts_{uuid4().hex}"
    files = int(spark.conf.get("spark.sql.shuffle.partitions"))
    writer = texts.write.format("parquet").bucketBy(files, "f", "g").sortBy("f", "g")
    writer.option("path", scratch_path(spark, "texts")).saveAsTable(stored)
    base = spark.table(stored)

    sizes = base.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    by_bytes = _two_rounds(base, BYTES, LENGTH, sizes)
    by_words = _two_rounds(base, WORDS, 2 * PASSAGE - 1, sizes).withColumnsRenamed({"states": "word_states", "windows": "word_windows"})

    joined = base.join(by_bytes, ["f", "g"], "left").join(by_words, ["f", "g"], "left")
    passage = passage_reader()("text", "copies", "word_states", "word_windows").alias("passage")
    done = cut_lineage(joined.select("f", "g", coverer()("text", "copies", "states", "windows").alias("c"), passage))
    spark.sql(f"drop table {stored}")
    kept = F.col("c.sha").alias("kept_sha256")
    return rows.select("doc_id", "f", "g").join(done, ["f", "g"]).select("doc_id", "c.n_bytes", "c.spans", kept, F.col("passage").alias("longest_shared"))


def op7_suffix_dedup(docs: DataFrame) -> DataFrame:
    found = repeated_spans(docs.select("doc_id", "text"))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return found.select("doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), "kept_sha256", "longest_shared")
