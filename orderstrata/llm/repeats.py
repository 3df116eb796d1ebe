"""Repeated passages: every byte of a string that an earlier document holds as well.

Suffixes of all documents can't be sorted whole: a row for each byte is many times the
corpus. So the suffixes to sort are chosen by content. Of the 16-byte grams of a
50-byte string the one with the least hash is its anchor; equal strings have their
anchors at equal places. Only anchors whose gram is found in two documents or more go
on, each with the bytes of the strings it stands for, and one task gets all that share
a gram: its bucket. There the suffixes on both sides of the gram are sorted by refining
buckets with pointers: the buckets of the grams at later offsets split those of earlier
ones, and once split serve the next step, until sorting order and common prefixes give the
bucket of every string.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import partial
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, LongType, StructField, StructType

from orderstrata.llm.batches import batch_rows, store_batches
from orderstrata.llm.common import pack, plainly_named, unpack, unused_name

GRAM = 16
# Windows and anchors looked at together, bytes of text behind a bucket.
WINDOWS_AT_ONCE = 1 << 20
ANCHORS_AT_ONCE = 1 << 16
BUCKET_BYTES = 8 << 20
PLACE_BITS = np.uint64(24)
# A gram at more places than these has its strings taken apart: into groups of seven offsets of
# the gram, beyond the second number into single offsets.
HOT_PLACES = (1 << 15, 1 << 19)
OFFSETS_TOGETHER = {2: 7, 3: 1}
MULTIPLIERS = [np.uint64(m) for m in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xD6E8FEB86659FD93)]
NO_ID = np.iinfo(np.int64).max

BLOB = "bucket long, batch_id long, blob binary"


# --- texts of a batch -----------------------------------------------------------------


def _texts(rows: pa.RecordBatch, text: int) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a batch one after another, and where each document ends."""
    values = [v.as_py() or b"" for v in rows.column(text).cast(pa.binary())]
    data = np.frombuffer(b"".join(values), np.uint8)
    return data, np.cumsum(np.fromiter(map(len, values), np.int64, len(values)))


def _ids(rows: pa.RecordBatch, key: int) -> np.ndarray:
    """Ids; a row without one comes after all others."""
    return rows.column(key).cast(pa.int64()).fill_null(int(NO_ID)).to_numpy()


# --- anchors ---------------------------------------------------------------------------


def _gram_hashes(data: np.ndarray) -> np.ndarray:
    """A hash of the 16 bytes from each place on, from hashes of 1, 2, 4 and 8."""
    value = data.astype(np.uint64) + np.uint64(1)
    width = 1
    while width < GRAM:
        left = value[: len(value) - width] * MULTIPLIERS[0]
        left ^= left >> np.uint64(29)
        left += value[width:]
        value, width = left, width * 2
    value = value * MULTIPLIERS[1]
    value ^= value >> np.uint64(32)
    value *= MULTIPLIERS[2]
    value ^= value >> np.uint64(29)
    return value


def _mixed(hashes: np.ndarray) -> np.ndarray:
    """Anchors' hashes are low ones; these are spread evenly again, equal ones equal."""
    mixed = hashes * MULTIPLIERS[0]
    mixed ^= mixed >> np.uint64(32)
    return mixed * MULTIPLIERS[1]


def _least_of(values: np.ndarray, width: int) -> np.ndarray:
    span = 1
    while span * 2 <= width:
        values = np.minimum(values[: len(values) - span], values[span:])
        span *= 2
    rest = width - span
    return np.minimum(values[: len(values) - rest], values[rest:]) if rest else values


def _anchors(data: np.ndarray, ends: np.ndarray, window: int) -> Iterator[tuple[np.ndarray, ...]]:
    """Hash and place of each anchor, and the first and last window that chose it."""
    low = (np.uint64(1) << PLACE_BITS) - np.uint64(1)
    for at in range(0, len(data) - window + 1, WINDOWS_AT_ONCE):
        part = data[at : at + WINDOWS_AT_ONCE + window - 1]
        hashes = _gram_hashes(part)
        # the least hash, of equal ones the leftmost, with its place in the lowest bits
        marked = (hashes & ~low) | np.arange(len(hashes), dtype=np.uint64)
        chosen = (_least_of(marked, window - GRAM + 1) & low).astype(np.int64)
        inside = np.ones(len(chosen), bool)
        for end in ends[(ends > at) & (ends < at + len(part))] - at:
            inside[max(0, end - window + 1) : end] = False
        windows = np.flatnonzero(inside)
        if not len(windows):
            continue
        places = chosen[windows]
        starts = np.flatnonzero(np.concatenate(([True], places[1:] != places[:-1])))
        lasts = np.concatenate((starts[1:], [len(windows)])) - 1
        anchors = places[starts]
        yield _mixed(hashes[anchors]), anchors + at, windows[starts] + at, windows[lasts] + at


def _all_anchors(data: np.ndarray, ends: np.ndarray, window: int) -> list[np.ndarray]:
    found = list(_anchors(data, ends, window))
    if not found:
        return [np.empty(0, np.uint64)] + [np.empty(0, np.int64)] * 3
    return [np.concatenate(part) for part in zip(*found, strict=True)]


def _runs(ordered: np.ndarray) -> np.ndarray:
    """Where each run of equal values starts."""
    if not len(ordered):
        return np.empty(0, np.int64)
    return np.flatnonzero(np.concatenate(([True], ordered[1:] != ordered[:-1])))


def _parts(hashes: np.ndarray, buckets: int) -> list[tuple[int, int, int]]:
    """Buckets that hold any of the sorted hashes, with the places of each one's first and end.

    Buckets are ranges of hashes.
    """
    at = ((hashes >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)
    starts = _runs(at)
    ends = np.append(starts[1:], len(at))
    return list(zip(at[starts].tolist(), starts.tolist(), ends.tolist(), strict=True))


def _blobs(rows: list[tuple[int, int, bytes]]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [(), (), ()]
    kinds = (pa.int64(), pa.int64(), pa.binary())
    arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, ["bucket", "batch_id", "blob"])


@dataclass
class _Found:
    """A batch's anchors in the order of their hashes, and where each distinct hash starts."""

    data: np.ndarray
    ends: np.ndarray
    hashes: np.ndarray
    places: np.ndarray
    firsts: np.ndarray
    lasts: np.ndarray
    ids: np.ndarray
    starts: np.ndarray


def _found(rows: pa.RecordBatch, key: int, text: int, window: int) -> _Found:
    data, ends = _texts(rows, text)
    anchors = _all_anchors(data, ends, window)
    order = np.argsort(anchors[0], kind="stable")
    hashes, places, firsts, lasts = (a[order] for a in anchors)
    ids = _ids(rows, key)[np.searchsorted(ends, places, side="right")]
    return _Found(data, ends, hashes, places, firsts, lasts, ids, _runs(hashes))


def _send_hashes(
    batches: Iterable[pa.RecordBatch], key: int, text: int, window: int, buckets: int
) -> Iterator[pa.RecordBatch]:
    """Per bucket each distinct gram of a batch, with its least and greatest id and places."""
    for batch in batches:
        for number, raw in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            found = _found(batch_rows(raw.as_py()), key, text, window)
            if not len(found.starts):
                continue
            least = np.minimum.reduceat(found.ids, found.starts)
            most = np.maximum.reduceat(found.ids, found.starts)
            places = np.diff(np.append(found.starts, len(found.hashes)))
            grams, rows = found.hashes[found.starts], []
            for bucket, a, b in _parts(grams, buckets):
                steps = np.diff(grams[a:b], prepend=np.uint64(0))
                sent = [steps, least[a:b], most[a:b] - least[a:b], places[a:b]]
                rows.append((bucket, number, pack(sent)))
            yield _blobs(rows)


def _mark_shared(table: pa.Table, hot: tuple[int, int] = HOT_PLACES) -> pa.Table:
    """For each gram sent, in the order sent, 0 if one document has it alone, 1 if several do.

    2 or 3 if it is at so many places that its strings are to be taken apart.
    """
    blobs = [unpack(b.as_py()) for b in table.column("blob")]
    sizes = [len(b[0]) for b in blobs]
    grams = np.concatenate([np.cumsum(b[0], dtype=np.uint64) for b in blobs])
    least = np.concatenate([b[1] for b in blobs])
    most = np.concatenate([b[1] + b[2] for b in blobs])
    places = np.concatenate([b[3] for b in blobs])
    order = np.argsort(grams)
    starts = _runs(grams[order])
    shared = np.minimum.reduceat(least[order], starts) < np.maximum.reduceat(most[order], starts)
    total = np.add.reduceat(places[order], starts)
    levels = np.where(shared, 1 + (total > hot[0]) + (total > hot[1]), 0).astype(np.uint8)
    marks = np.empty(len(grams), np.uint8)
    marks[order] = np.repeat(levels, np.diff(np.append(starts, len(grams))))
    parts = np.split(marks, np.cumsum(sizes)[:-1])
    bits = pa.array([_packed_levels(p) for p in parts], pa.binary())
    return pa.table(
        {"bucket": table.column("bucket"), "batch_id": table.column("batch_id"), "blob": bits}
    )


def _packed_levels(levels: np.ndarray) -> bytes:
    """The low bits of all, then the high ones if there are any."""
    low = np.packbits(levels & 1).tobytes()
    return low + np.packbits(levels >> 1).tobytes() if (levels > 1).any() else low


def _levels(packed: bytes, count: int) -> np.ndarray:
    raw, half = np.frombuffer(packed, np.uint8), (count + 7) // 8
    low, high = np.unpackbits(raw[:half])[:count], np.unpackbits(raw[half:])[:count]
    return low + 2 * high if len(high) else low


# --- strings of shared anchors --------------------------------------------------------


def _contexts(around: np.ndarray, places, firsts, lasts, window: int) -> np.ndarray:
    """The bytes of all windows of each anchor, the gram always at the same columns.

    ``around`` has a row for each place. The last two columns hold the least and the
    greatest offset of the gram in the windows.
    """
    reach = window - GRAM
    width = window + reach
    least, most = places - lasts, places - firsts
    columns = np.arange(width)
    inside = (columns >= (reach - most)[:, None]) & (columns < (width - least)[:, None])
    rows = np.empty((len(places), width + 2), np.uint8)
    rows[:, :width] = np.where(inside, around[places], 0)
    rows[:, width], rows[:, width + 1] = least, most
    return rows


def _around(data: np.ndarray, window: int) -> np.ndarray:
    """For each place the bytes around it, a view; zeros beyond the ends."""
    reach = window - GRAM
    width = window + reach
    # an anchor near the end still needs `width` places to look up
    padded = np.concatenate((np.zeros(reach, np.uint8), data, np.zeros(width, np.uint8)))
    return np.lib.stride_tricks.sliding_window_view(padded, width)


def _distinct_rows(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Indices of distinct rows in sorted order, and for each row which it equals."""
    whole = np.ascontiguousarray(rows).view(f"V{rows.shape[1]}").reshape(-1)
    _, first, inverse = np.unique(whole, return_index=True, return_inverse=True)
    return first, inverse


def _chunks(sizes: list[int]) -> Iterator[tuple[int, int]]:
    """Ranges of parts that hold up to ``ANCHORS_AT_ONCE`` anchors, or are one part."""
    at, held = 0, 0
    for k, size in enumerate(sizes):
        if k > at and held + size > ANCHORS_AT_ONCE:
            yield at, k
            at, held = k, 0
        held += size
    if at < len(sizes):
        yield at, len(sizes)


def _shared_contexts(found: _Found, marks: dict[int, bytes], window: int, buckets: int):
    """Distinct contexts of the marked grams, bucket by bucket, each with its least id.

    Yields for some buckets at a time: the buckets, where each one's contexts start,
    the contexts, their least ids, and the anchors with the context each has. The same
    marks give the same contexts in the same order.
    """
    bounds = np.append(found.starts, len(found.hashes))
    listed, kept = [], []
    for bucket, a, b in _parts(found.hashes[found.starts], buckets):
        if bucket in marks:
            shared = _levels(marks[bucket], b - a) == 1
            wanted = np.repeat(shared, np.diff(bounds[a : b + 1]))
            listed.append(bucket)
            kept.append(np.flatnonzero(wanted) + bounds[a])
    around = _around(found.data, window)
    for a, b in _chunks([len(k) for k in kept]):
        anchors = np.concatenate(kept[a:b])
        part = np.repeat(np.arange(b - a), [len(k) for k in kept[a:b]])
        rows = _contexts(
            around, found.places[anchors], found.firsts[anchors], found.lasts[anchors], window
        )
        first, inverse = _distinct_rows(rows)
        order = np.argsort(part[first], kind="stable")
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        first, which = first[order], rank[inverse]
        least = np.full(len(first), NO_ID)
        np.minimum.at(least, which, found.ids[anchors])
        cuts = np.searchsorted(part[first], np.arange(b - a + 1))
        yield listed[a:b], cuts, rows[first], least, anchors, which


@dataclass
class _Split:
    """Strings of some hot grams, taken apart; as :func:`_shared_contexts`, and their windows."""

    listed: list[int]
    cuts: np.ndarray
    rows: np.ndarray
    least: np.ndarray
    which: np.ndarray
    anchors: np.ndarray
    firsts: np.ndarray
    lasts: np.ndarray


def _hot_grams(found: _Found, marks: dict[int, bytes], buckets: int) -> Iterator[tuple]:
    """Hot grams of a batch with their levels, some at a time."""
    grams, levels = found.hashes[found.starts], np.zeros(len(found.starts), np.uint8)
    for bucket, a, b in _parts(grams, buckets):
        if bucket in marks:
            levels[a:b] = _levels(marks[bucket], b - a)
    hot = np.flatnonzero(levels > 1)
    places = np.diff(np.append(found.starts, len(found.hashes)))[hot]
    for a, b in _chunks((places * 16).tolist()):
        yield grams[hot[a:b]], levels[hot[a:b]]


def _split_contexts(
    found: _Found, grams: np.ndarray, levels: np.ndarray, window: int, buckets: int
) -> _Split:
    """Strings of hot grams by groups of offsets of the gram.

    All windows of a group have most of their bytes in common, and these decide the bucket, not
    the gram alone: surroundings that differ go to differing buckets. Buckets of this kind
    are numbered after the usual ones. The same grams give the same strings in the same order.
    """
    at = np.searchsorted(found.hashes[found.starts], grams)
    bounds = np.append(found.starts, len(found.hashes))
    around, reach = _around(found.data, window), window - GRAM
    rows, keys, anchors, firsts, lasts = [], [], [], [], []
    for level, width in OFFSETS_TOGETHER.items():
        of_level = [np.arange(bounds[g], bounds[g + 1]) for g in at[levels == level]]
        if not of_level:
            continue
        own = np.concatenate(of_level)
        place = found.places[own]
        for low in range(0, reach + 1, width):
            high = min(low + width - 1, reach)
            least = np.maximum(place - found.lasts[own], low)
            most = np.minimum(place - found.firsts[own], high)
            live = np.flatnonzero(least <= most)
            if not len(live):
                continue
            first, last = place[live] - most[live], place[live] - least[live]
            part = _contexts(around, place[live], first, last, window)
            core = part[:, reach - low : reach - high + window].astype(np.uint64)
            powers = np.cumprod(np.full(core.shape[1], MULTIPLIERS[0]))
            rows.append(part)
            keys.append(_mixed((core + np.uint64(1)) @ powers))
            anchors.append(own[live])
            firsts.append(first)
            lasts.append(last)
    rows, keys, anchors, firsts, lasts = map(np.concatenate, (rows, keys, anchors, firsts, lasts))
    first, which = _distinct_rows(rows)
    bucket = ((keys[first] >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)
    order = np.argsort(bucket, kind="stable")
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    first, which, bucket = first[order], rank[which], bucket[order].astype(np.int64)
    least = np.full(len(first), NO_ID)
    np.minimum.at(least, which, found.ids[anchors])
    cuts = np.append(_runs(bucket), len(bucket))
    listed = (bucket[cuts[:-1]] + buckets).tolist()
    return _Split(listed, cuts, rows[first], least, which, anchors, firsts, lasts)


def _send_contexts(
    batches: Iterable[pa.RecordBatch], key: int, text: int, window: int, buckets: int
) -> Iterator[pa.RecordBatch]:
    """Per bucket the distinct contexts of a batch with their least ids, and its marks.

    However often a batch holds a context, it is sent once.
    """
    for batch in batches:
        for number, raw, sent in zip(
            batch.column(0).to_pylist(), batch.column(1), batch.column(2), strict=True
        ):
            found = _found(batch_rows(raw.as_py()), key, text, window)
            marks = {m["bucket"]: m["blob"] for m in sent.as_py()}
            for listed, cuts, rows, least, _, _ in _shared_contexts(found, marks, window, buckets):
                blobs = []
                for k, bucket in enumerate(listed):
                    cut = slice(cuts[k], cuts[k + 1])
                    if cut.start < cut.stop:
                        mark = np.frombuffer(marks[bucket], np.uint8)
                        blobs.append((bucket, number, pack([rows[cut].reshape(-1), least[cut], mark])))
                if blobs:
                    yield _blobs(blobs)
            for grams, levels in _hot_grams(found, marks, buckets):
                split = _split_contexts(found, grams, levels, window, buckets)
                blobs = []
                for bucket, a, b in zip(split.listed, split.cuts, split.cuts[1:], strict=False):
                    sent = [split.rows[a:b].reshape(-1), split.least[a:b], grams, levels]
                    blobs.append((bucket, number, pack(sent)))
                yield _blobs(blobs)


# --- buckets and their refinement ------------------------------------------------------


def _grams_at(rows: np.ndarray, at: int) -> np.ndarray:
    """The eight bytes from a column on as numbers that sort like them."""
    part = np.zeros((len(rows), 8), np.uint8)
    cut = rows[:, at : at + 8]
    part[:, : cut.shape[1]] = cut
    return part.view(">u8").reshape(-1).astype(np.uint64)


def _refined(buckets: np.ndarray, later: np.ndarray) -> np.ndarray:
    """Buckets split by a number of each member, numbered in order."""
    order = np.lexsort((later, buckets))
    b, l = buckets[order], later[order]
    steps = np.concatenate(([False], (b[1:] != b[:-1]) | (l[1:] != l[:-1])))
    out = np.empty(len(buckets), np.int64)
    out[order] = np.cumsum(steps)
    return out


def _ranked(base: np.ndarray, pointers: np.ndarray) -> np.ndarray:
    """The first ranks of buckets split by pointers: each part's within its bucket."""
    split = _refined(base, pointers)
    ranks = np.argsort(split, kind="stable")
    starts = _runs(split[ranks])
    counts = np.diff(np.append(starts, len(ranks)))
    # a part's rank: its bucket's first rank and the size of the parts before it
    owner = base[ranks]
    owner_starts = _runs(owner)
    before = np.arange(len(ranks)) - np.repeat(
        owner_starts, np.diff(np.append(owner_starts, len(ranks)))
    )
    out = np.empty(len(ranks), np.int64)
    out[ranks] = owner + np.repeat(before[starts], counts)
    return out


def _pointers(suffixes: np.ndarray) -> np.ndarray:
    """For each suffix the buckets of the eight-byte grams at its offsets 0, 8, 16, ...

    One numbering for all offsets, in the order of the grams: these are the buckets that the
    suffixes at those offsets belong to.
    """
    grams = [_grams_at(suffixes, at) for at in range(0, suffixes.shape[1], 8)]
    _, ids = np.unique(np.concatenate(grams), return_inverse=True)
    return ids.reshape(len(grams), -1).T


def _doubled(pointers: np.ndarray) -> np.ndarray:
    """Buckets of twice the length: each by its own and the one that follows on it.

    ``pointers`` holds the buckets at offsets 0, n, 2n, ...; what comes back, at 0, 2n, ...,
    is again one numbering for all of them, so that the next doubling can follow it.
    """
    if pointers.shape[1] % 2:  # nothing follows on the last one
        pointers = np.pad(pointers, ((0, 0), (0, 1)), constant_values=-1)
    most = int(pointers.max()) + 2
    pairs = pointers[:, ::2] * most + pointers[:, 1::2] + 1
    _, ids = np.unique(pairs, return_inverse=True)
    return ids.reshape(pairs.shape)


def _sorted_suffixes(buckets: np.ndarray, suffixes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The order of the suffixes within their buckets, and each one's common prefix.

    The prefix is that with the one before; -1 where another initial bucket starts. Buckets
    are refined by pointers: first by the buckets of the eight-byte grams that the suffixes
    begin with, then by the bucket of the suffix eight bytes on, and, as those at later offsets
    are refined in the same step, by that sixteen and then thirty-two bytes on. A bucket of
    one is in its place, and its pointers are followed no further.
    """
    base = np.zeros(len(buckets), np.int64)
    # `base` is the first rank of a bucket: a split bucket's parts get ranks inside it
    order = np.argsort(buckets, kind="stable")
    starts = _runs(buckets[order])
    base[order] = np.repeat(starts, np.diff(np.append(starts, len(order))))
    open_ = np.flatnonzero(np.bincount(base, minlength=len(base))[base] > 1)
    pointers = _pointers(suffixes[open_]) if len(open_) else None
    while len(open_):
        base[open_] = _ranked(base[open_], pointers[:, 0])
        still = np.bincount(base, minlength=len(base))[base[open_]] > 1
        if pointers.shape[1] == 1:
            break
        open_, pointers = open_[still], pointers[still]
        if len(open_):
            pointers = _doubled(pointers)
    order = np.argsort(base, kind="stable")
    same = suffixes[order[1:]] == suffixes[order[:-1]]
    common = np.where(same.all(axis=1), suffixes.shape[1], np.argmin(same, axis=1))
    ordered = buckets[order]
    common[ordered[1:] != ordered[:-1]] = -1
    return order, np.concatenate(([-1], common))


def _names(order: np.ndarray, common: np.ndarray, length: int) -> np.ndarray:
    """Equal numbers for suffixes that share their bucket and their first bytes."""
    names = np.empty(len(order), np.int64)
    names[order] = np.cumsum(common < length)
    return names


def _removals(contexts: np.ndarray, least_id: np.ndarray, window: int) -> np.ndarray:
    """For each context and offset, whether a smaller id has that window."""
    reach = window - GRAM
    width = window + reach
    text = contexts[:, :width]
    low, high = contexts[:, width].astype(np.int64), contexts[:, width + 1].astype(np.int64)
    buckets = _refined(np.zeros(len(text), np.int64), _grams_at(text, reach))
    buckets = _refined(buckets, _grams_at(text, reach + 8))
    right = _sorted_suffixes(buckets, text[:, reach + GRAM :])
    left = _sorted_suffixes(buckets, text[:, :reach][:, ::-1])
    removed = np.zeros((len(text), reach + 1), bool)
    for offset in range(reach + 1):
        live = np.flatnonzero((low <= offset) & (offset <= high))
        if len(live) < 2:
            continue
        before = _names(*left, offset)[live]
        after = _names(*right, reach - offset)[live]
        joint = before * (len(text) + 1) + after
        order = np.argsort(joint)
        starts = _runs(joint[order])
        ids = least_id[live[order]]
        first = np.repeat(
            np.minimum.reduceat(ids, starts), np.diff(np.append(starts, len(order)))
        )
        removed[live[order], offset] = first < ids
    return removed


def _live(contexts: np.ndarray, window: int) -> np.ndarray:
    """For each context and offset, whether the context has that window."""
    low, high = contexts[:, -2], contexts[:, -1]
    offsets = np.arange(window - GRAM + 1)
    return (low[:, None] <= offsets) & (offsets <= high[:, None])


def _refine_bucket(table: pa.Table, window: int) -> pa.Table:
    """For each context sent, the windows that a smaller id than the batch's least has.

    With the batch's marks, so that it can find its contexts again.
    """
    width = 2 * window - GRAM + 2
    blobs = [unpack(b.as_py()) for b in table.column("blob")]
    sizes = np.cumsum([0] + [len(b[1]) for b in blobs])
    contexts = np.concatenate([b[0] for b in blobs]).reshape(-1, width)
    ids = np.concatenate([b[1] for b in blobs])
    first, which = _distinct_rows(contexts)
    contexts = contexts[first]
    least = np.full(len(first), NO_ID)
    np.minimum.at(least, which, ids)
    removed = _removals(contexts, least, window)
    # where another batch has the whole context under a smaller id, all of its windows go
    gone = np.where((ids > least[which])[:, None], _live(contexts, window)[which], removed[which])
    rows = []
    for k, number in enumerate(table.column("batch_id").to_pylist()):
        bits = np.packbits(gone[sizes[k] : sizes[k + 1]], axis=1)
        rows.append(
            (table.column("bucket")[k].as_py(), number, pack([bits.reshape(-1), *blobs[k][2:]]))
        )
    return pa.Table.from_batches([_blobs(rows)])


# --- back to the documents -----------------------------------------------------------------


def _ranges(
    found: _Found, replies: list[dict], window: int, buckets: int
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Starts and ends of what is to go from a batch, by what the buckets said."""
    bits, marks, split = {}, {}, {}
    for reply in replies:
        gone, *rest = unpack(reply["blob"])
        if len(rest) == 1:
            bits[reply["bucket"]], marks[reply["bucket"]] = gone, rest[0].tobytes()
        else:
            split.setdefault(rest[0].tobytes(), (rest, {}))[1][reply["bucket"]] = gone
    for listed, _, rows, least, anchors, which in _shared_contexts(found, marks, window, buckets):
        said = np.concatenate([bits[b] for b in listed])
        whole = found.firsts[anchors], found.lasts[anchors]
        yield from _told(found, rows, least, anchors, which, whole, said, window)
    for (grams, levels), said in split.values():
        s = _split_contexts(found, grams, levels, window, buckets)
        said = np.concatenate([said[b] for b in s.listed])
        whole = s.firsts, s.lasts
        yield from _told(found, s.rows, s.least, s.anchors, s.which, whole, said, window)


def _told(
    found: _Found,
    rows: np.ndarray,
    least: np.ndarray,
    anchors: np.ndarray,
    which: np.ndarray,
    whole: tuple[np.ndarray, np.ndarray],
    said: np.ndarray,
    window: int,
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Starts and ends of what is to go by some contexts' bits; ``whole``: all their windows."""
    offsets = window - GRAM + 1
    gone = np.unpackbits(said.reshape(len(rows), -1), axis=1)[:, :offsets].astype(bool)
    all_gone = (gone == _live(rows, window)).all(axis=1)
    # a context that the batch itself has under a smaller id goes whole as well
    later = (found.ids[anchors] > least[which]) | all_gone[which]
    yield whole[0][later], whole[1][later] + window
    rest = np.flatnonzero(~later & gone.any(axis=1)[which])
    at, offset = np.nonzero(gone[which[rest]])
    starts = found.places[anchors[rest[at]]] - offset
    yield starts, starts + window


def _cover(
    batches: Iterable[pa.RecordBatch], key: int, text: int, window: int, buckets: int
) -> Iterator[pa.RecordBatch]:
    """The rows of each batch with the ranges to cut from each."""
    for batch in batches:
        for raw, replies in zip(batch.column(0), batch.column(1), strict=True):
            rows, replies = batch_rows(raw.as_py()), replies.as_py()
            if replies:
                found = _found(rows, key, text, window)
                data, ends = found.data, found.ends
            else:
                data, ends = _texts(rows, text)
            steps = np.zeros(len(data) + 1, np.int64)
            for starts, stops in _ranges(found, replies, window, buckets) if replies else ():
                np.add.at(steps, starts, 1)
                np.add.at(steps, stops, -1)
            gone = np.cumsum(steps[:-1]) > 0
            before = np.concatenate(([False], gone[:-1])) if len(gone) else gone
            begins = np.concatenate(([0], ends[:-1])) if len(ends) else ends
            first, last = np.zeros(len(gone) + 1, bool), np.zeros(len(gone) + 1, bool)
            first[begins] = True  # runs end with their document
            opens = np.flatnonzero(gone & (~before | first[: len(gone)]))
            last[:-1] = ~gone | first[:-1]
            last[-1] = True
            closing = np.flatnonzero(last)
            closes = closing[np.searchsorted(closing, opens, side="right")]
            owner = np.searchsorted(ends, opens, side="right")
            counts = np.bincount(owner, minlength=len(ends))
            shift = begins[owner] if len(opens) else opens
            spans = pa.StructArray.from_arrays(
                [pa.array(opens - shift), pa.array(closes - shift)], ["start", "end"]
            )
            offsets = pa.array(np.concatenate(([0], np.cumsum(counts))), pa.int32())
            column = pa.ListArray.from_arrays(offsets, spans)
            yield pa.RecordBatch.from_arrays(
                [*rows.columns, column], [*rows.schema.names, "ranges"]
            )


SPANS = ArrayType(
    StructType([StructField("start", LongType()), StructField("end", LongType())])
)


def _batches_with_ranges(docs: DataFrame, key: int, text: int, window: int):
    """Every batch of documents with what its buckets said, and the function that reads both."""
    if window < GRAM + 8 or window > 200:
        raise ValueError("window: 24 to 200 bytes")
    batches = store_batches(plainly_named(docs), text)
    total = batches.agg(F.sum("n_bytes")).head()[0] or 0
    buckets = max(1, ceil(total / BUCKET_BYTES))
    where = {"key": key, "text": text, "window": window, "buckets": buckets}

    def by_batch(blobs: DataFrame, name: str) -> DataFrame:
        both = F.collect_list(F.struct("bucket", "blob"))
        return blobs.groupBy("batch_id").agg(both.alias(name))

    hashes = batches.select("batch_id", "rows").mapInArrow(partial(_send_hashes, **where), BLOB)
    hot = HOT_PLACES

    def mark(table: pa.Table) -> pa.Table:
        return _mark_shared(table, hot)

    marks = by_batch(hashes.groupBy("bucket").applyInArrow(mark, BLOB), "marks")
    marked = batches.join(marks, "batch_id").select("batch_id", "rows", "marks")
    contexts = marked.mapInArrow(partial(_send_contexts, **where), BLOB)

    def refine(table: pa.Table) -> pa.Table:
        return _refine_bucket(table, window)

    replies = by_batch(contexts.groupBy("bucket").applyInArrow(refine, BLOB), "replies")
    found = batches.join(replies, "batch_id", "left").select("rows", "replies")
    return found, partial(_cover, **where)


def _kept(data: bytes, spans: list[dict]) -> bytes:
    at, parts = 0, []
    for span in spans:
        parts.append(data[at : span["start"]])
        at = span["end"]
    return b"".join([*parts, data[at:]])


def _without(batches: Iterable[pa.RecordBatch], text: int) -> Iterator[pa.RecordBatch]:
    """What the ranges in the last column leave of the text, as one more column."""
    for batch in batches:
        values = []
        for raw, ranges in zip(
            batch.column(text).cast(pa.binary()), batch.columns[-1], strict=True
        ):
            whole, cut = raw.as_py(), ranges.as_py()
            values.append(_kept(whole, cut) if cut else whole)
        kept = pa.array(values, pa.binary())
        yield pa.RecordBatch.from_arrays(
            [*batch.columns, kept], [*batch.schema.names, "kept"]
        )


def mark_repeats(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    window: int = 50,
    into: str = "repeats",
    kept: str = "kept",
) -> DataFrame:
    """``docs`` with the byte ranges that repeat an earlier document, and what remains.

    A byte of the text's UTF-8 form is in such a range if it is covered by ``window``
    bytes in a row that also start somewhere in a document with a smaller id. All
    strings are judged on the texts as given; overlaps count; none crosses documents.
    Ranges, in the column ``into``, are maximal, ascending, and given as ``start`` and
    ``end`` (not included); ``kept`` has the remaining bytes one after another.

    NULL texts count as empty, ``kept`` then is NULL; a row without an id comes after all
    others; rows that repeat an id don't count against each other. All columns are kept,
    whatever their names, but for one named like ``into`` or ``kept``, which is an error. A text
    longer than a batch is a batch of its own, which one task holds, at some twenty bytes for each
    of its own. The session's catalog has to take a table's name for a moment. An empty table gives an empty one. Runs one job to store the batches; the rest is
    lazy.
    """
    for name in (into, kept):
        if unused_name(docs, name) != name:
            raise ValueError(f"there is a column {name!r} already")
    names, fields = docs.columns, plainly_named(docs).schema.fields
    key, text = names.index(id_column), names.index(text_column)
    found, cover = _batches_with_ranges(docs, key, text, window)
    added = [StructField("ranges", SPANS), StructField("kept", BinaryType())]
    marked = found.mapInArrow(
        lambda it: _without(cover(it), text), StructType([*fields, *added])
    )
    return marked.toDF(*names, into, kept)


def _as_text(batches: Iterable[pa.RecordBatch], text: int) -> Iterator[pa.RecordBatch]:
    """The kept bytes in place of the text, without parts of characters."""
    for batch in batches:
        columns = list(batch.columns[:-2])
        kept = batch.columns[-1].to_pylist()
        columns[text] = pa.array(
            [None if v is None else v.decode(errors="ignore") for v in kept], pa.string()
        )
        yield pa.RecordBatch.from_arrays(columns, batch.schema.names[:-2])


def without_repeats(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", window: int = 50
) -> DataFrame:
    """``docs`` with repeated ranges cut from the texts; every row and column stays.

    Of a character that a cut divides the rest goes as well. Cases as in
    :func:`mark_repeats`; a NULL text stays NULL.
    """
    names, plain = docs.columns, plainly_named(docs)
    key, text = names.index(id_column), names.index(text_column)
    found, cover = _batches_with_ranges(docs, key, text, window)
    cut = found.mapInArrow(
        lambda it: _as_text(_without(cover(it), text), text), plain.schema
    )
    return cut.toDF(*names)
